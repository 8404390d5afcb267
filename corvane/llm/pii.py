"""Personal data in texts by weak supervision, with DataFrame functions only.

Strict patterns give the base spans, which always stay. Loose patterns give more candidates: written-out mail addresses,
IPv6 and defanged addresses, card numbers with other separators or lengths, national phone numbers. Labelers of three
kinds (patterns, gazetteers, words in the context) vote on every span for, against, or not at all.

1. One pass over the texts finds spans and votes, and writes places and votes only.
2. One aggregate counts spans by kind and votes; there are few patterns of votes whatever the input (PATTERNS).
3. On these counts expectation-maximisation estimates how reliable each labeler is for each kind (the probability of
   each vote given the truth), and the probability that each pattern of votes is personal data.
4. These probabilities train the span classifier of each kind, a logistic regression over the votes and the shape of a
   span. It doesn't see whether a span is strict, so what it learns there carries over to the loose ones.
5. A pass over the written places keeps the loose spans that the classifier accepts.

Everything stays inside a row but the counts; nothing is shuffled but them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import bind, running
from .common import Scratch, table, whole_id

KINDS = ("email", "ip", "card", "phone")
# The strict patterns, as the contract has them. Repetitions that can't give anything back are possessive and starts inside a
# run of the first class, which can't match where the run's start did not, are not tried: so long runs cost linear time.
_LOCAL = r"[A-Za-z0-9._%+-]"
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold before the pattern is tried on it.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
_AT = r" {0,2}(?:[(\[{<](?:at|AT)[)\]}>]|@| (?:at|AT) ) {0,2}"
_DOT = r"(?: {0,2}(?:[(\[{<](?:dot|DOT)[)\]}>]| (?:dot|DOT|punkt|punto|point) ) {0,2}|\.)"
_EDGE = r"(?![0-9A-Za-z])"
LOOSE = {
    "email": rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]++{_AT}[\p{{L}}\p{{N}}-]++(?:{_DOT}[\p{{L}}\p{{N}}-]++)++",
    "ip": rf"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}}|(?:[0-9A-Fa-f]{{1,4}}:){{1,6}}(?::[0-9A-Fa-f]{{1,4}}){{1,6}}|[0-9]{{1,3}}(?: ?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)) ?[0-9]{{1,3}}){{3}}){_EDGE}",
    "card": rf"(?<![0-9A-Za-z])[0-9](?:[ ./_\x{{A0}}-]?[0-9]){{12,18}}{_EDGE}",
    "phone": rf"(?<![0-9A-Za-z.,/+-])(?:\(0?[0-9]{{2,4}}\) ?|0[0-9]{{1,4}}[ /-]|[2-9][0-9]{{2}}[-. ]|00 ?[1-9])[0-9](?:[ ./-]?[0-9]){{5,12}}(?![0-9A-Za-z]|[.,][0-9])",
}
LOOSE_NEEDS = {"email": r"@|[(\[{<](?:at|AT)[)\]}>]| (?:at|AT) ", "ip": r":[0-9A-Fa-f]{0,4}:|[0-9] ?[(\[](?:\.|dot)", "card": r"[0-9](?:[ ./_\x{A0}-]?[0-9]){12}", "phone": r"[0-9](?:[ ./)-]{0,2}[0-9]){6}"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

# Gazetteers and words of the context, in English, German, French and Spanish.
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "co", "dev", "app", "de", "at", "ch", "fr", "be", "es", "mx", "ar", "it", "nl", "uk", "ie", "eu", "us", "ca", "au", "nz", "in", "jp", "cn", "ru", "br", "pl", "pt", "se", "no", "dk", "fi")
MAIL_NAMES = ("info", "contact", "kontakt", "contacto", "support", "admin", "sales", "office", "service", "hello", "team", "press", "john", "jane", "anna", "maria", "marie", "peter", "paul", "david", "michael", "thomas", "juan", "jose", "carlos", "pierre", "jean", "hans", "klaus")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "351", "352", "353", "354", "358", "359", "370", "371", "372", "380", "385", "386", "420", "421", "852", "886", "971", "972")
CONTEXT = {
    "email": ("mail", "contact", "write to", "reach", "kontakt", "schreib", "courriel", "écri", "correo", "escrib"),
    "ip": ("ip", "address", "host", "server", "login", "client", "adresse", "rechner", "serveur", "dirección", "servidor"),
    "card": ("card", "visa", "mastercard", "amex", "payment", "paid", "cvv", "karte", "zahlung", "carte", "paiement", "tarjeta", "pago"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "cell", "whatsapp", "anruf", "rufnummer", "handy", "appel", "móvil", "llam"),
}
AGAINST = {
    "email": ("import", "decorator", "commit", "look", "arriv", "stay"),
    "ip": ("version", "release", "section", "chapter", "figure", "kapitel", "abschnitt", "chapitre", "capítulo", "time", "uhr"),
    "card": ("order", "isbn", "invoice", "tracking", "imei", "serial", "token", "bestell", "rechnung", "commande", "facture", "pedido", "factura"),
    "phone": ("order", "isbn", "invoice", "serial", "page", "date", "token", "bestell", "rechnung", "seite", "datum", "commande", "pedido", "página", "fecha"),
}
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|38|30|6011|62|64|65)"

#: Votes for and against by each labeler, then the features of shape; the last bit says that a span is strict.
LABELERS = ("pattern", "valid", "gazetteer", "context", "edges", "company")
SHAPES = ("twice", "line_start", "long", "spaced")
BITS = 2 * len(LABELERS) + len(SHAPES)
#: At most so many patterns of votes and shapes are counted: three votes of each labeler, two values of each shape, strict or not.
PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 2 ** len(SHAPES) * 2
#: A loose span is kept from this probability on: at the first reliabilities, three votes for it more than against it.
LEAST = 0.95
#: What is taken to have been seen of each labeler before the data: votes against, none and for, given no and yes.
SEEN = ((4.0, 5.0, 1.0), (1.0, 5.0, 4.0))

_SPAN = "struct<start:int,end:int,s:string,before:string,after:string,strict:boolean>"
_NONE = f"cast(array() as array<{_SPAN}>)"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _holds(kind: str, s: Column, strict: bool = True) -> Column:
    """Whether a match of the strict, or the loose, pattern counts."""
    if not strict:
        return F.call_function("luhn_check", _digits(s)) if kind == "card" else F.lit(True)
    if kind == "ip":
        return s.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(_digits(s)).between(16, 19) & F.call_function("luhn_check", _digits(s))
    return F.length(_digits(s)).between(8, 15) if kind == "phone" else F.lit(True)


def _cut(text: Column, pattern: str, needs: str) -> Column:
    """The matches of a pattern and the pieces between them, one more than matches; both empty without a match."""
    some = text.rlike(needs) & text.rlike(pattern)
    none = F.expr("cast(array() as array<string>)")
    return F.struct(F.when(some, F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(none).alias("hits"), F.when(some, F.split(text, pattern, -1)).otherwise(none).alias("gaps"))


def _placed(cut: Column, strict: bool) -> Column:
    """Matches with their place in code points and what stands around them: pieces are measured, never the text."""
    hits, gaps = cut["hits"], cut["gaps"]
    starts = running(F.transform(hits, lambda h, i: F.length(h) + F.length(F.get(gaps, i))))

    def span(at: Column, h: Column, i: Column) -> Column:
        start = F.get(at, i) + F.length(F.get(gaps, i))
        return F.struct(start.cast("int").alias("start"), (start + F.length(h)).cast("int").alias("end"), h.alias("s"), F.right(F.get(gaps, i), F.lit(40)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(2)).alias("after"), F.lit(strict).alias("strict"))

    return F.when(F.size(hits) > 0, bind(starts, lambda at: F.transform(hits, lambda h, i: span(at, h, i)))).otherwise(F.expr(_NONE))


def _held(kind: str, cut: str, strict: bool) -> Column:
    return F.filter(_placed(F.col(cut), strict), lambda c: _holds(kind, c["s"], strict))


def _hidden(cut: Column, text: Column, kind: str, strict: bool) -> Column:
    """The text with its accepted matches replaced by as many control characters, so that no other kind takes them."""
    pieces = F.transform(cut["hits"], lambda h, i: F.concat(F.get(cut["gaps"], i), F.when(_holds(kind, h, strict), F.repeat(F.lit("\x01"), F.length(h))).otherwise(h)))
    return F.when(F.size(cut["hits"]) > 0, F.concat(F.array_join(pieces, ""), F.get(cut["gaps"], F.size(cut["hits"])))).otherwise(text)


def _any(x: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(x, F.lit(w)) for w in words))


def _votes(kind: str, c: Column, company: Column) -> list[tuple[Column, Column]]:
    """For each labeler whether it votes for and against a span."""
    s, digits, no = c["s"], _digits(c["s"]), F.lit(False)
    near = F.lower(c["before"])
    context = (_any(near, CONTEXT[kind]), _any(near, AGAINST[kind]))
    glued = c["before"].rlike(r"[\p{L}\p{N}_=#$/\\]$") | c["after"].rlike(r"^[\p{L}\p{N}_=/\\]")
    # a sentence's last mark may touch a mail address in front, as its own class of characters takes the mark in
    edges = (~glued, glued)
    if kind == "email":
        top = F.lower(F.regexp_extract(s, r"([\p{L}\p{N}-]+)$", 1))
        local = F.lower(F.regexp_extract(s, r"^[^@(\[{< ]+", 0))
        return [(s.rlike(r"@|[(\[{<](?:at|AT)"), s.rlike(r" (?:at|AT) ") & ~s.rlike("(?i)dot|punkt|punto|point")), (top.rlike(r"^\p{L}{2,}$"), ~top.rlike(r"^\p{L}{2,}$")), (top.isin(*TOP_DOMAINS), ~top.isin(*TOP_DOMAINS)), context, edges, (company | _any(local, MAIL_NAMES), no)]
    if kind == "ip":
        quad, time = s.rlike(r"\.|dot"), s.rlike(r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2}|:)")
        parts = F.regexp_replace(s, r"[^0-9]+", ".")
        bad = quad & ~parts.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$") | quad & parts.rlike(r"^0|^[0-9]\.[0-9]\.[0-9]\.[0-9]$")
        own = parts.rlike(r"^(?:10|127|0|255)\.|^192\.168\.|^169\.254\.") & quad
        return [(quad | s.rlike("(?::.*){3}"), time), (~bad & ~time, bad | time), (~own, own), context, edges, (company, no)]
    if kind == "card":
        n = F.length(digits)
        grouped = s.rlike(r"^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$|^[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}$") | s.rlike(r"^[0-9]+$") & n.isin(15, 16)
        luhn = F.call_function("luhn_check", digits)
        return [(grouped, ~grouped), (luhn, ~luhn), (digits.rlike(ISSUERS), ~digits.rlike(ISSUERS)), context, edges, (company, no)]
    code = F.regexp_extract(s, r"^(?:\+|00) ?([1-9][0-9]{0,2})", 1)
    known = F.exists(F.array(*map(F.lit, CALLING_CODES)), lambda x: F.startswith(code, x))
    plain = s.rlike(r"^\+|^00|^\(|^[2-9][0-9]{2}[-.][0-9]{3}[-.][0-9]{4}$|^0[0-9]{2,4}[ /-][0-9]{3}")
    dated = s.rlike(r"^[0-9]{2,4}[-./][0-9]{1,2}[-./][0-9]{1,4}$")
    fits = F.length(digits).between(8, 15)
    return [(plain, dated), (fits, ~fits), ((code != "") & known | s.rlike(r"^\([2-9][0-9]{2}\) ?[2-9]|^[2-9][0-9]{2}[-.][2-9]|^\(?0[1-9]"), (code != "") & ~known), context, edges, (company, no)]


def _masked(kind: str, spans: Column, company: Column) -> Column:
    """Places with kind and mask: bits of votes and shapes."""

    def of(c: Column, i: Column) -> Column:
        bits = [b for pair in _votes(kind, c, company) for b in pair]
        twice = F.coalesce(F.get(spans, i - 1)["s"] == c["s"], F.lit(False)) | F.coalesce(F.get(spans, i + 1)["s"] == c["s"], F.lit(False))
        bits += [twice, c["before"].rlike(r"(^|\n)[ \t]*$"), F.length(c["s"]) >= 16, c["s"].contains(" "), c["strict"]]
        mask = reduce(add, (F.when(b, 1 << k).otherwise(0) for k, b in enumerate(bits)))
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), mask.alias("mask"))

    return F.transform(spans, of)


def find_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, strict and loose: arrays of (kind, start, end, mask) in order of kind and start."""
    rows = docs.select(whole_id(docs, id_col).alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    cut = rows.select("*", *[_cut(F.col("text"), STRICT[k], NEEDS[k]).alias(f"cut_{k}") for k in KINDS])
    spans = cut.select("doc_id", "text", "cut_email", *[_held(k, f"cut_{k}", True).alias(k) for k in KINDS])
    some = reduce(lambda a, b: a | b, (F.size(k) > 0 for k in KINDS))
    # strict spans are hidden one kind after the other, then loose ones, so that what is left is looked at once
    left = spans.withColumn("some", some).withColumn("left", F.when(F.col("some"), _hidden(F.col("cut_email"), F.col("text"), "email", True)).otherwise(F.col("text"))).drop("text", "cut_email")
    for k in KINDS[1:]:
        left = left.withColumn("cut", F.when(F.col("some"), _cut(F.col("left"), STRICT[k], NEEDS[k]))).withColumn("left", F.when(F.col("some"), _hidden(F.col("cut"), F.col("left"), k, True)).otherwise(F.col("left"))).drop("cut")
    for k in KINDS:
        left = left.withColumn("cut", _cut(F.col("left"), LOOSE[k], LOOSE_NEEDS[k]))
        left = left.withColumn(f"loose_{k}", _held(k, "cut", False)).withColumn("left", _hidden(F.col("cut"), F.col("left"), k, False)).drop("cut")
    marks = lambda front: F.concat(*[_masked(k, F.col(f"{front}{k}"), reduce(lambda a, b: a | b, (F.size(o) > 0 for o in KINDS if o != k))) for k in KINDS])
    return left.select("doc_id", marks("").alias("strict"), marks("loose_").alias("loose"))


@dataclass(frozen=True)
class SpanModel:
    """Of each kind the reliabilities of the labelers (probability of a vote against, none, for; given no and yes), the share
    of personal data, and the classifier's bias and weight of each bit."""

    reliability: Mapping[str, np.ndarray]
    share: Mapping[str, float]
    bias: Mapping[str, float]
    weights: Mapping[str, np.ndarray]


def _expectation_maximisation(votes: np.ndarray, n: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float, np.ndarray]:
    """votes: one row per pattern, -1, 0 or 1 by labeler; n: how often. Gives the probability of each vote given the truth,
    the share of true spans, and of each pattern the probability that it is one. Labelers are first taken to be right in
    four of five votes (SEEN), and the rest is learned."""
    prior = np.array([SEEN] * votes.shape[1])
    chance = prior / prior.sum(2, keepdims=True)
    share, belief = 0.5, np.zeros(len(n))
    at = votes + 1
    for _ in range(rounds):
        logs = np.log(chance)[np.arange(votes.shape[1]), :, at].sum(1)  # pattern by truth
        odds = logs[:, 1] - logs[:, 0] + np.log(share) - np.log1p(-share)
        was, belief = belief, 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        share = float((n * belief).sum() + 1) / float(n.sum() + 2)
        for truth, weight in enumerate((n * (1 - belief), n * belief)):
            for v in range(3):
                chance[:, truth, v] = ((at == v) * weight[:, None]).sum(0) + prior[:, truth, v]
        chance /= chance.sum(2, keepdims=True)
        if np.abs(belief - was).max(initial=0) < 1e-10:
            break
    return chance, share, belief


def _logistic(x: np.ndarray, n: np.ndarray, belief: np.ndarray, first: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights, the bias first, of the regression of the beliefs on the bits; each pattern counts n times. Weights are held
    near `first`, so that votes which the data never show keep their sense."""
    x = np.column_stack([np.ones(len(x)), x])
    w = first.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (n * (belief - p)) - ridge * (w - first))
        w = w + step * min(1.0, 4 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return w


def _first_weights() -> np.ndarray:
    """What SEEN says of each vote, and nothing of shapes."""
    no, yes = SEEN
    return np.array([0.0, *[np.log(yes[v] / no[v]) for _ in LABELERS for v in (2, 0)], *[0.0 for _ in SHAPES]])


def learn_spans(spans: DataFrame) -> SpanModel:
    """The model of the spans of find_spans. What comes to the driver are counts of at most PATTERNS patterns."""
    counts = spans.select(F.explode(F.concat("strict", "loose")).alias("s")).groupBy("s.kind", "s.mask").agg(F.count("*").alias("n")).collect()
    reliability, share, bias, weights = {}, {}, {}, {}
    for k, kind in enumerate(KINDS):
        own = sorted((r["mask"], r["n"]) for r in counts if r["kind"] == k)
        mask, n = np.array([m for m, _ in own], np.int64), np.array([c for _, c in own], float)
        bits = (mask[:, None] >> np.arange(BITS + 1)) & 1
        votes = np.column_stack([bits[:, 0 : 2 * len(LABELERS) : 2] - bits[:, 1 : 2 * len(LABELERS) : 2], bits[:, BITS]])  # a strict pattern votes for, or not at all
        chance, part, belief = _expectation_maximisation(votes, n)
        w = _logistic(bits[:, :BITS].astype(float), n, belief, _first_weights())
        reliability[kind], share[kind], bias[kind], weights[kind] = chance, part, float(w[0]), w[1:]
    return SpanModel(reliability, share, bias, weights)


def _probability(model: SpanModel) -> Callable[[Column], Column]:
    """The classifier as an expression over a span."""
    biases = F.array(*[F.lit(model.bias[k]) for k in KINDS])
    tables = F.array(*[F.array(*[F.lit(float(w)) for w in model.weights[k]]) for k in KINDS])

    def of(span: Column) -> Column:
        own = F.get(tables, span["kind"])
        total = reduce(add, (F.when(span["mask"].bitwiseAND(F.lit(1 << b)) > 0, F.get(own, F.lit(b))).otherwise(0.0) for b in range(BITS)), F.get(biases, span["kind"]))
        return 1 / (1 + F.exp(-total))

    return of


def keep_spans(spans: DataFrame, model: SpanModel, least: float = LEAST) -> DataFrame:
    """doc_id, strict and spans: strict as given, spans with the loose ones of enough probability, by kind and start."""
    chance = _probability(model)
    rows = spans.select("doc_id", "strict", F.filter("loose", lambda c: chance(c) >= least).alias("more"))
    return rows.select("doc_id", "strict", F.sort_array(F.concat("strict", "more")).alias("spans"))


def find_private(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """One row per input row: doc_id, strict and spans, arrays of (kind, start, end, mask) by kind and start.

    kind is a place in KINDS, start and end are code points, end exclusive. strict holds the matches of the strict
    patterns that count, spans these and the loose ones that the classifier accepts; strict spans of different kinds may
    overlap, loose ones overlap nothing that was found before them. A null or empty text has none. Texts are searched
    whole, whatever their length. Repeated rows are searched each for itself and count each in the model; ids may be null.
    Without any span nothing is learned and nothing kept; an empty table gives an empty result. Other columns are ignored.
    """
    spans = Scratch(docs.sparkSession, "private").write(find_spans(docs, id_col=id_col, text_col=text_col), "spans")
    return keep_spans(spans, learn_spans(spans), least)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.get(names, c["kind"]), c["start"].cast("string"), c["end"].cast("string"))), ",")


def op12_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("strict", lambda c: c["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)], F.sha2(_listed(F.col("strict")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))

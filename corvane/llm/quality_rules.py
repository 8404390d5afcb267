"""Line-first quality rules, with DataFrame functions only.

Each line is judged alone; failing lines are taken out of the text; a document that loses too many of its words is
rejected. The rules for one line:

- punctuation: more than nine marks of `#*$%&|<>` for ten words, or a line of eight words or more in a script that ends
  its sentences with a mark and no such mark anywhere in it;
- navigation: a list of links, that is `|`, `>`, `»` or `·` standing alone between at least three entries, or fewer than
  five words in 120 characters at most, without a closing mark, holding a navigation word;
- boilerplate: a licence, copyright, cookie, script or sign-up notice.

Words of the last two rules are looked for in English, German, French and Spanish. Everything is computed inside a row:
no shuffle, no explode.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, WORD, fresh, n_words, table

SYMBOLS = "#*$%&|<>"
BLANKS = r"\x20\x09-\x0D"
NAVIGATION = r"(?i)(^|[^a-z])(home|menu|login|log in|sign in|sign up|next|previous|prev|back to top|skip to|contact us|about us|sitemap|search|startseite|anmelden|impressum|accueil|connexion|plan du site|inicio|iniciar sesión|mapa del sitio)([^a-z]|$)"
#: Looked for in the line in lower case.
BOILERPLATE = (
    "all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy", "cookie policy", "cookies policy",
    "uses cookies", "accept cookies", "accept all cookies", "enable javascript", "javascript is disabled", "javascript is required",
    "lorem ipsum", "subscribe to our", "copyright (c)", "copyright ©", "powered by wordpress", "alle rechte vorbehalten", "datenschutzerklärung", "verwendet cookies",
    "tous droits réservés", "politique de confidentialité", "utilise des cookies", "todos los derechos reservados", "política de privacidad", "utiliza cookies",
)
SEPARATOR = r"(^|[ \t])[|>»·]([ \t]|$)"
CLOSING = r"[.!?…:;。！？\"”»)\]'’]\s*$"
#: Letters of scripts that end sentences with a mark, and the marks; a long line with such a letter and without a mark fails.
LETTERS = r"[A-Za-zÀ-ɏͰ-ϿЀ-ӿ]"
MARKS = r"[.!?…:;]"
PROSE_WORDS = 8
#: A document may lose this share of its words, in hundredths.
MOST_LOST = 50


def _bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value computed once: a lambda variable is never inlined by the optimizer."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more.

    Each window gives one number, its hash with the window's place written over the lowest part, so that one sort of
    plain numbers brings equal windows side by side. Neighbours with equal hashes are held against each other word by word.
    Their places, sorted, cover three words each, less where the next one starts sooner.
    """

    def covered(starts: Column) -> Column:
        return F.aggregate(F.transform(starts, lambda p, k: F.least(F.lit(3).cast("long"), F.coalesce(F.get(starts, k + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)

    def by_words(w: Column) -> Column:
        triples = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.cast("long").alias("i")))
        same = lambda x, y: F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))
        return _bind(F.sort_array(triples), lambda s: F.array_sort(F.transform(F.filter(s, lambda x, k: same(x, F.get(s, k + 1)) | same(x, F.get(s, k - 1))), lambda x: x["i"])))

    def repeats(w: Column) -> Column:
        n = F.size(w).cast("long")
        place = lambda x: F.pmod(x, n)
        at = lambda x, k: F.get(w, (place(x) + k).cast("int"))
        near = lambda x, y: x - place(x) == y - place(y)
        equal = lambda x, y: (at(x, 0) == at(y, 0)) & (at(x, 1) == at(y, 1)) & (at(x, 2) == at(y, 2))
        same = lambda x, y: near(x, y) & equal(x, y)
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: _bind(F.shiftright(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), 1), lambda h: h - F.pmod(h, n) + i))
        found = lambda s: F.array_sort(F.transform(F.filter(s, lambda x, k: F.coalesce(same(x, F.get(s, k + 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, k - 1)), F.lit(False))), place))
        # Different windows with one high part can stand between equal ones: then, rarely, windows are sorted by their words.
        mixed = lambda s: F.exists(F.transform(s, lambda x, k: F.coalesce(near(x, F.get(s, k + 1)) & ~equal(x, F.get(s, k + 1)), F.lit(False))), lambda x: x)
        starts = _bind(F.sort_array(windows), lambda s: F.when(mixed(s), by_words(w)).otherwise(found(s)))
        return _bind(starts, covered)

    return _bind(words, lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(repeats(w)))


def _n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long")


def line_fails(line: Column) -> Column:
    """True if a rule fails the line, which holds a word. Cheap tests come first, as they decide most lines."""
    symbols = line.rlike(f"[{SYMBOLS}]") & (_n_symbols(line) * 10 > n_words(line) * 9)
    links = line.rlike("[|>»·]") & (F.regexp_count(line, F.lit(SEPARATOR)) >= 3)
    menu = (F.length(line) < 120) & ~line.rlike(CLOSING) & (n_words(line) < 5) & line.rlike(NAVIGATION)
    notice = _bind(F.lower(line), lambda x: reduce(or_, (F.contains(x, F.lit(p)) for p in BOILERPLATE)))
    bare = (n_words(line) >= PROSE_WORDS) & ~line.rlike(MARKS) & line.rlike(LETTERS)
    return symbols | links | menu | notice | bare


def clean_lines(text: Column) -> Column:
    """The text without the lines that a rule fails. Lines without a word stay; a null text stays null."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~(x.rlike(WORD) & line_fails(x))), "\n")


def quality_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", most_lost: int = MOST_LOST) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lost_words,
    cleaned (the text without its failing lines).

    A null or empty text has no words, so it fails the base. Repeated rows are judged each for itself, ids may be null
    or repeat, other columns are ignored, and an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    measured = rows.select(
        "doc_id",
        n_words(text).alias("n_words"),
        (F.length(text) - F.regexp_count(text, F.lit(f"[{BLANKS}]"))).cast("long").alias("word_chars"),
        _n_symbols(text).cast("long").alias("n_symbols"),
        _repeated_words(words).alias("n_repeat_words"),
        _bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _bind(clean_lines(text), lambda x: F.struct(x.alias("text"), F.when(F.length(x) == F.length(text), F.lit(None)).otherwise(n_words(x)).alias("words"))).alias("cleaned"),
    )
    lost = F.col("n_words") - F.coalesce("cleaned.words", "n_words")
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    kept = ~base & (lost * 100 <= F.col("n_words") * most_lost)
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), kept.alias("kept"), lost.alias("n_lost_words"), F.col("cleaned.text").alias("cleaned"))


def clean_documents(docs: DataFrame, *, text_col: str = "text", most_lost: int = MOST_LOST) -> DataFrame:
    """The rows of docs, with all columns, whose text keeps enough of its words, without the lines that fail. Texts that are
    null or hold no word lose nothing and stay. Columns may have any names."""
    (kept,) = fresh(docs.columns, "kept")
    text = F.col(f"`{text_col}`")
    rows = docs.withColumn(kept, clean_lines(text))
    few = (n_words(text) - n_words(F.col(kept))) * 100 <= n_words(text) * most_lost
    return rows.where(few).select(*[F.col(kept).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).withColumn("cleaned_sha256", F.sha2("cleaned", 256)).drop("cleaned")


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
g AS (SELECT r, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS tri FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS c FROM g WHERE tri IS NOT NULL) WHERE c > 1),
reps AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
ln AS (SELECT r, i, line, CAST(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS BIGINT) AS words FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM d)),
judged AS (
  SELECT r, i, line, words,
    (length(line) - length(translate(line, '#*$%&|<>', ''))) * 10 > words * 9
    OR len(regexp_extract_all(line, '(^|[ \t])[|>»·]([ \t]|$)')) >= 3
    OR (words < 5 AND length(line) < 120 AND NOT regexp_matches(line, '[.!?…:;。！？"”»)\]''’]\s*$') AND regexp_matches(line, '(?i)(^|[^a-z])(home|menu|login|log in|sign in|sign up|next|previous|prev|back to top|skip to|contact us|about us|sitemap|search|startseite|anmelden|impressum|accueil|connexion|plan du site|inicio|iniciar sesión|mapa del sitio)([^a-z]|$)'))
    OR regexp_matches(lower(line), 'all rights reserved|licensed under|terms of (use|service)|privacy policy|cookie(s)? policy|uses cookies|accept (all )?cookies|enable javascript|javascript is (disabled|required)|lorem ipsum|subscribe to our|copyright \(c\)|copyright ©|powered by wordpress|alle rechte vorbehalten|datenschutzerklärung|verwendet cookies|tous droits réservés|politique de confidentialité|utilise des cookies|todos los derechos reservados|política de privacidad|utiliza cookies')
    OR (words >= 8 AND NOT regexp_matches(line, '[.!?…:;]') AND regexp_matches(line, '[A-Za-zÀ-ɏͰ-ϿЀ-ӿ]')) AS fails
  FROM ln WHERE words > 0),
byline AS (SELECT r, count(*) - count(DISTINCT line) AS dup, coalesce(sum(words) FILTER (fails), 0) AS lost FROM judged GROUP BY r),
cleaned AS (SELECT l.r, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (NOT coalesce(j.fails, false)), '') AS cleaned FROM ln l LEFT JOIN judged j ON l.r = j.r AND l.i = j.i GROUP BY l.r),
m AS (
  SELECT doc_id, CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost, 0) AS BIGINT) AS n_lost_words, sha256(cleaned) AS cleaned_sha256
  FROM d LEFT JOIN reps USING (r) LEFT JOIN byline USING (r) LEFT JOIN cleaned USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
  NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AND n_lost_words * 100 <= n_words * 50 AS kept, n_lost_words, cleaned_sha256
FROM m
"""

"""Passages: paragraphs, packed sentence by sentence into windows of at most so many words, short ones merged forward.

All of it happens inside a row; nothing is exploded or shuffled until the caller asks for one row per passage. Sentences are
folded into windows paragraph by paragraph; full windows go into blocks, so that none of the arrays that grow is long.
Merging resets as well when a passage is full, so it is a chain of jumps: from any window, sums of words give the one at which
its passage ends, by binary search; which windows begin a passage follows from the table of jumps, composed with itself until
it spans the text. Text is cut and its white space counted once, so a long text costs little more than in proportion to its
length. Offsets are code points; `text[start, end)` is the passage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import bind, running
from ..functions.text import WS, WS_RUN, WS_SET, trim_ws
from ..session import spread

MOST_WORDS, LEAST_WORDS = 220, 55
#: Fixed value. A sentence with its closing marks and the white space after it; a closing mark that no sentence takes stands alone.
SENTENCE = rf"[^.!?]+(?:[.!?]+[\"']?|\z){WS}*|[.!?]"
#: A paragraph with the blank lines in front; or white space at the end; or what can't begin one, a first line break and all up to blank lines.
#: Lines are taken whole, as looking ahead at each character costs twice as much; possessive, so that many lines need no deep stack.
PARAGRAPH = rf"(?:^|\n{WS}*\n)[^\n]++(?:\n(?!{WS}*\n)[^\n]*+)*+|{WS}++\z|(?s:.+?)(?=\n{WS}*\n[^\n]|\z)"
NO_PARAGRAPH = rf"^\n(?!{WS}*\n)"
#: How many windows a block holds.
BLOCK = 256
_WINDOWS = "array<struct<start:int,end:int,first:int,last:int>>"


def _between(text: Column, start: Column, end: Column) -> Column:
    return F.substr(text, start + 1, end - start)


def _first_where(low: Column, high: Column, holds: Callable[[Column], Column]) -> Column:
    """The least place in [low, high) where holds is true, as it is for all places after it; high if there is none."""
    bounds = F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))

    def halve(b: Column, _: Column) -> Column:
        middle = F.shiftright(b["low"] + b["high"], 1)
        return F.when(b["low"] >= b["high"], b).when(holds(middle), F.struct(b["low"].alias("low"), middle.alias("high"))).otherwise(F.struct((middle + 1).alias("low"), b["high"].alias("high")))

    rounds = F.ceil(F.log2(high - low + 1)).cast("int") + 1
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), rounds)), bounds, halve, lambda b: b["low"])


def _with(name: str, f: Callable[..., Column], *cols: str) -> Callable[[DataFrame], DataFrame]:
    """Adds f of some columns. The columns are bound first, so that none of them is computed again for each element."""
    return lambda rows: rows.withColumn(name, bind(F.struct(*cols), lambda s: f(*[s[c] for c in cols])))


def _levels(jumps: Column) -> Column:
    """The table of jumps with its own size as a last place that stays, then composed with itself: of 2, 4, 8 ... jumps, until it spans the array."""
    twice = lambda levels: bind(F.element_at(levels, -1), lambda j: F.transform(j, lambda to: F.get(j, to)))
    rounds = F.slice(F.sequence(F.lit(1), F.lit(32)), F.lit(1), F.greatest(F.lit(0), F.ceil(F.log2(F.size(jumps) + 1)).cast("int") - 1))
    return F.aggregate(rounds, F.array(F.concat(jumps, F.array(F.size(jumps)))), lambda levels, _: F.concat(levels, F.array(twice(levels))))


def _places(levels: Column) -> Column:
    """The places that are reached from 0, by the table of jumps: the k-th is a jump for each bit of k."""
    n = F.size(F.get(levels, 0)) - 1
    bits = F.size(levels) - 1
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("k"))

    def farther(s: Column, b: Column) -> Column:
        to = F.get(F.get(levels, b), s["at"])
        return F.when(to < n, F.struct(to.alias("at"), (s["k"] + F.call_function("shiftleft", F.lit(1), b)).alias("k"))).otherwise(s)

    last = F.aggregate(F.sequence(bits, F.lit(0)), start, farther, lambda s: s["k"])
    bit = lambda k, b: F.call_function("shiftright", k, b).bitwiseAND(F.lit(1)) == 1
    place = lambda k: F.aggregate(F.sequence(F.lit(0), bits), F.lit(0), lambda at, b: F.when(bit(k, b), F.get(F.get(levels, b), at)).otherwise(at))
    return F.when(n == 0, F.expr("cast(array() as array<int>)")).otherwise(F.transform(F.sequence(F.lit(0), last), place))


def follow(rows: DataFrame, name: str, jumps: str) -> DataFrame:
    """Adds the places that are reached from 0 by a column of jumps: from each place of an array to a later one, at most to its size."""
    return rows.transform(_with(name, _levels, jumps)).transform(_with(name, _places, name))


def _groups(rows: DataFrame, name: str, items: str, jump: Callable[..., Column], make: Callable[[Column, Column], Column], *sums: str) -> DataFrame:
    """Adds make(first, last) of the successive groups of an array; jump(array, *sums, i) is where the group that begins at i ends."""
    jumps = rows.transform(_with(name, lambda s, *w: F.transform(s, lambda _, i: jump(s, *w, i).cast("int")), items, *sums))
    made = lambda s, at: F.transform(at, lambda i, k: make(F.get(s, i), F.get(s, F.coalesce(F.get(at, k + 1), F.size(s)) - 1)))
    return follow(jumps, name, name).transform(_with(name, made, items, name))


def _record(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _measured(body: Column) -> Column:
    """The pieces of a paragraph: their length, the white space in front, the length without white space around them, the runs of
    white space in all, whether one is in front, and the words; a piece that is no sentence has no words."""
    sizes = lambda t: _record(n=F.length(t), lead=F.length(t) - F.length(F.ltrim(t, F.lit(WS_SET))), size=F.length(trim_ws(t)), gaps=F.regexp_count(t, F.lit(WS_RUN)), mark=F.ascii(t).isin(*map(ord, ".!?")))
    front, open_ = lambda t: (t["lead"] > 0).cast("int"), lambda t: (t["size"] + t["lead"] < t["n"]).cast("int")
    words = lambda t: F.when(t["mark"] | (t["size"] == 0), 0).otherwise(t["gaps"] - front(t) - open_(t) + 1)
    tiles = F.transform(F.regexp_extract_all(body, F.lit(SENTENCE), 0), sizes)
    return F.transform(tiles, lambda t: _record(n=t["n"], lead=t["lead"], size=t["size"], gaps=t["gaps"], front=front(t), words=words(t)))


def _packed(tiles: Column, most: int) -> Column:
    """Windows of successive sentences with at most so many words together, or one sentence: start and end from the paragraph's
    beginning on, and the number of runs of white space in front of the first and the last word."""
    zero, none, blocks = F.lit(0), F.expr(f"cast(array() as {_WINDOWS})"), F.expr(f"cast(array() as array<{_WINDOWS}>)")
    start = _record(at=zero, gaps=zero, words=zero, window=_record(start=zero, end=zero, first=zero, last=zero), block=none, blocks=blocks)

    def add(s: Column, t: Column) -> Column:
        begins, first = s["at"] + t["lead"], s["gaps"] + t["front"]
        at, gaps, end, last = s["at"] + t["n"], s["gaps"] + t["gaps"], begins + t["size"], first + t["words"] - 1
        joined = _record(at=at, gaps=gaps, words=s["words"] + t["words"], window=_record(start=s["window"]["start"], end=end, first=s["window"]["first"], last=last), block=s["block"], blocks=s["blocks"])
        begun = lambda block, blocks: _record(at=at, gaps=gaps, words=t["words"], window=_record(start=begins, end=end, first=first, last=last), block=block, blocks=blocks)
        grown = F.concat(s["block"], F.array(s["window"]))
        passed = _record(at=at, gaps=gaps, words=s["words"], window=s["window"], block=s["block"], blocks=s["blocks"])
        return (
            F.when(t["words"] == 0, passed).when((s["words"] > 0) & (s["words"] + t["words"] <= most), joined).when(s["words"] == 0, begun(s["block"], s["blocks"]))
            .when(F.size(s["block"]) < BLOCK, begun(grown, s["blocks"])).otherwise(begun(none, F.concat(s["blocks"], F.array(grown))))
        )

    last = lambda s: F.when(s["words"] > 0, F.concat(s["block"], F.array(s["window"]))).otherwise(s["block"])
    return F.aggregate(tiles, start, add, lambda s: F.flatten(F.concat(s["blocks"], F.array(last(s)))))


def with_slices(rows: DataFrame, text: str, name: str, most: int = MOST_WORDS, least: int = LEAST_WORDS) -> DataFrame:
    """Adds array<struct<start, end, words>> of a text's passages; null and blank texts have none.

    Runs of white space are numbered through the whole text, so that the words between any two places are a difference:
    between paragraphs there is one run, so each paragraph counts for one more than its sentences say.
    """
    def paragraphs(tiles: Column, starts: Column) -> Column:
        found = F.transform(tiles, lambda t, i: F.struct((F.get(starts, i) + F.length(t) - F.length(F.ltrim(t, F.lit(WS_SET)))).cast("int").alias("start"), trim_ws(t).alias("body"), t.rlike(NO_PARAGRAPH).alias("none")))
        kept = F.filter(found, lambda p: (p["body"] != "") & ~p["none"])
        return F.transform(kept, lambda p: F.struct(p["start"], p["body"]))

    def windows(ps: Column) -> Column:
        """By paragraph its start, its runs of white space and its windows; a paragraph within the limit is one, whatever it holds."""

        def cut(p: Column) -> Column:
            whole = lambda gaps: F.array(_record(start=F.lit(0), end=F.length(p["body"]), first=F.lit(0), last=gaps))
            total = lambda ts: F.aggregate(ts, F.lit(0), lambda a, t: a + t["gaps"])
            counted = lambda ts: bind(total(ts), lambda gaps: _record(start=p["start"], gaps=gaps, windows=F.when(gaps < most, whole(gaps)).otherwise(_packed(ts, most))))
            return bind(_measured(p["body"]), counted)

        return F.transform(ps, cut)

    def placed(ps: Column, gaps: Column) -> Column:
        def one(p: Column, k: Column) -> Column:
            return bind(F.get(gaps, k).cast("int"), lambda g: F.transform(p["windows"], lambda w: _record(start=p["start"] + w["start"], end=p["start"] + w["end"], first=g + w["first"], last=g + w["last"])))

        return F.flatten(F.transform(ps, one))

    words = lambda a, z: z["last"] - a["first"] + 1

    def merged(s: Column, i: Column) -> Column:
        own = lambda j: words(F.get(s, i), F.get(s, j))
        return _first_where(i, F.size(s) - 1, lambda j: (own(j) >= least) | (own(j) + words(F.get(s, j + 1), F.get(s, j + 1)) > most)) + 1

    taken = {c.lower() for c in rows.columns}
    tiles, ps, at, gaps, found = (f"{n}{'_' * len(taken)}" if n in taken else n for n in ("_tiles", "_ps", "_at", "_gaps", "_found"))
    cut = rows.withColumn(tiles, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(PARAGRAPH), 0))
    cut = cut.transform(_with(at, lambda t: running(F.transform(t, F.length)), tiles)).transform(_with(ps, paragraphs, tiles, at)).transform(_with(ps, windows, ps))
    cut = cut.transform(_with(gaps, lambda p: running(F.transform(p, lambda x: x["gaps"] + 1)), ps)).transform(_with(found, placed, ps, gaps)).drop(tiles, ps, at, gaps)
    return _groups(cut, name, found, merged, lambda a, z: _record(start=a["start"], end=z["end"], words=words(a, z))).drop(found)


def passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_WORDS, least: int = LEAST_WORDS) -> DataFrame:
    """One row per passage: the id, ordinal from 1, start, end, words, text."""
    rows = spread(docs.select(F.col(id_col), F.col(text_col).alias("_text")))
    # the outer form: the plain one makes a filter of the slices, which would compute them all a second time below
    sliced = with_slices(rows, "_text", "_slices", most, least).select(id_col, "_text", F.posexplode_outer("_slices").alias("_k", "_s")).where("_k IS NOT NULL")
    return sliced.select(id_col, (F.col("_k") + 1).alias("ordinal"), F.col("_s.start").alias("start"), F.col("_s.end").alias("end"), F.col("_s.words").cast("long").alias("words"), _between(F.col("_text"), F.col("_s.start"), F.col("_s.end")).alias("text"))

"""Repair of the role structure of conversations by error-correcting Earley parsing.

The roles of a good conversation are nothing, or an optional system turn and then pairs of user and assistant. That is
written as left-linear productions, and each gets error productions beside it: a turn can be deleted, given another
role, or inserted. Chart items keep the least (cost, audit), the audit being the edits' letters in order; as all items
begin at the first turn, a column has one completed item for each symbol, and a conversation costs a time in proportion
to its length. The completed chart's least final item is the repair.

Texts are not needed to parse. Spark sends the parser a skeleton of each turn (role, digest, two flags, how often it
occurs), sorted, and marks the first turn of each role and text by an aggregate; a second sorted pass meets each audit
with the texts. Neither holds more than a batch of texts and one audit. Repeated turns travel as one row with a number.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table, whole_id

#: A role's initial, the symbol that a turn of this role completes, and the symbols that it may follow.
START, SYSTEM, OPEN, CLOSED = "start", "system", "open", "closed"
GRAMMAR = ((SYSTEM, START, "s"), (OPEN, START, "u"), (OPEN, SYSTEM, "u"), (OPEN, CLOSED, "u"), (CLOSED, OPEN, "a"))
FINAL = (START, CLOSED)
#: Roles that a turn can be given and that can be inserted, by initial.
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = ("su", "ua", "au")
#: After so many turns, what all items agree on leaves the chart.
COLUMN_SPAN = 256

Item = tuple[int, str]


class Chart:
    """The last column of an Earley chart over one conversation: symbol to least (cost, audit) of its completed item.

    Items `lhs -> before . role` are those whose `before` is completed here; scanning a turn, or inserting one, completes
    them. What the audits of all items share is moved to `settled`, so that a column's strings stay short.
    """

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.column: dict[str, Item] = {START: (0, "")}
        self.turns = 0
        self._insert()

    def _insert(self) -> None:
        """Insert productions complete items in the same column; as each costs something, this ends."""
        column, changed = self.column, True
        while changed:
            changed = False
            for lhs, before, role in GRAMMAR:
                if role in ROLES and before in column:
                    cost, audit = column[before]
                    new = (cost + INSERT, audit + "I")
                    if lhs not in column or new < column[lhs]:
                        column[lhs], changed = new, True

    def delete(self, n: int = 1) -> None:
        """n turns that must go. Among equal costs deletions before insertions are least, so all n can go at once."""
        self.column = {symbol: (cost + DELETE * n, audit + "D" * n) for symbol, (cost, audit) in self.column.items()}
        self._close(n)

    def scan(self, role: str, truncated: bool = False) -> None:
        """A turn whose role has this initial."""
        extra = TRUNCATED * truncated
        new = {symbol: (cost + DELETE, audit + "D") for symbol, (cost, audit) in self.column.items()}
        for lhs, before, wanted in GRAMMAR:
            if before not in self.column:
                continue
            cost, audit = self.column[before]
            if wanted == role:
                found = (cost + extra, audit + "K")
                if lhs not in new or found < new[lhs]:
                    new[lhs] = found
            elif wanted in ROLES:
                found = (cost + extra + REROLE, audit + "R")
                if lhs not in new or found < new[lhs]:
                    new[lhs] = found
        self.column = new
        self._close(1)

    def _close(self, n: int) -> None:
        self._insert()
        self.turns += n
        if self.turns >= COLUMN_SPAN:
            self.turns = 0
            self._settle()

    def _settle(self) -> None:
        """Items that can't win any more go: from the closed symbol all can be done that the first two symbols can, at the
        cost of one deletion if a system turn is still to come. Then the shared part of the audits goes to `settled`."""
        closed = self.column[CLOSED][0]
        live = {symbol: item for symbol, item in self.column.items() if not (symbol == START and item[0] > closed + DELETE or symbol == SYSTEM and item[0] > closed)}
        shared = len(os.path.commonprefix([audit for _, audit in live.values()]))
        if shared:
            self.settled.append(next(iter(live.values()))[1][:shared])
        self.column = {symbol: (cost, audit[shared:]) for symbol, (cost, audit) in live.items()}

    def repair(self) -> Item:
        cost, audit = min(self.column[symbol] for symbol in FINAL if symbol in self.column)
        return cost, "".join(self.settled) + audit


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int] = lambda _: 64, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a few megabytes."""
    held: list[tuple] = []
    n = 0
    for row in rows:
        held.append(row)
        n += size(row)
        if n >= most:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, n = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_MOST = (1 << 63) - 1


def _parsed(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Sorted (conv, known, turn, role, digest, kind, blank, cut, n) to one row of counts, cost and audit for each
    conversation. kind 0 marks that the next row is the first of its role and text."""
    conv: object = None
    chart: Chart | None = None
    first = False
    for c, known, turn, role, _, kind, is_blank, is_cut, n in rows:
        if chart is None or c != conv:
            if chart is not None:
                yield conv, min(_MOST, gaps), blank, duplicate, truncated, illegal, *chart.repair()
            conv, chart = c, Chart()
            gaps = blank = duplicate = truncated = illegal = 0
            least = last = before = None
            first = False
        if kind == 0:
            first = True
            continue
        if not n:
            first = False
            continue
        initial = role[:1]
        illegal += (before is not None and before + initial not in LEGAL) + (n - 1) * (initial * 2 not in LEGAL)
        before = initial
        if known and turn != last:
            gaps += turn - last - 1 if least is not None else 0
            least, last = turn if least is None else least, turn
        if is_blank:
            blank += n
            chart.delete(n)
        else:
            rest = n
            if first:
                rest -= 1
                truncated += is_cut
                chart.scan(initial, is_cut)
            duplicate += rest
            if rest:
                chart.delete(rest)
        first = False
    if chart is not None:
        yield conv, min(_MOST, gaps), blank, duplicate, truncated, illegal, *chart.repair()


def _repaired(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Sorted (conv, known, turn, role, digest, kind, n, text, *summary): first the summary of a conversation, then its
    texts and turns. Gives (conv, summary, None, None, None, None) for each conversation and (conv, None, place, role, text, edit)
    for each turn of its repair; place counts from 1, and deleted turns are left out."""
    audit, at, place, expected, text = "", 0, 0, "u", None
    for conv, _, _, role, _, kind, n, found, *summary in rows:
        if kind < 0:
            audit, at, place, expected, text = summary[-1], 0, 0, "u", None
            yield conv, tuple(summary), None, None, None, None
            while at < len(audit) and audit[at] == "I":
                place, at = place + 1, at + 1
                yield conv, None, place, ROLES[expected], "", "I"
                expected = "a" if expected == "u" else "u"
            continue
        if kind == 0:
            text = found
            continue
        for k in range(n):
            edit = audit[at]
            at += 1
            if edit == "D":
                if audit.startswith("D", at):  # the rest of a run of copies
                    run = min(n - k - 1, len(audit) - at)
                    if run and audit.startswith("D" * run, at):
                        at += run
                        n = 0
            else:
                place += 1
                if edit == "K" and role[:1] == "s":
                    expected = "a"
                yield conv, None, place, role if edit == "K" else ROLES[expected], text, edit
                expected = "a" if expected == "u" else "u"
            while at < len(audit) and audit[at] == "I":
                place, at = place + 1, at + 1
                yield conv, None, place, ROLES[expected], "", "I"
                expected = "a" if expected == "u" else "u"
            if not n:
                break
        text = None


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_SUMMARY = [c.split()[0] for c in SUMMARY.split(", ")]
_LONGS = [(c, pa.int64()) for c in _SUMMARY[:-1]]


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), *_LONGS, ("audit", pa.string())])
    return _batches(_parsed(_rows(batches)), schema, lambda r: 64 + len(r[-1]))


def _turns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
    return _batches(((conv, *turn) for conv, summary, *turn in _repaired(_rows(batches)) if summary is None), schema, lambda r: 64 + len(r[3]))


def _hashed(rows: Iterable[tuple]) -> Iterator[tuple]:
    held: tuple | None = None
    for conv, summary, place, role, text, _ in _repaired(rows):
        if summary is not None:
            if held is not None:
                yield *held, sha.hexdigest()
            held, sha = (conv, *summary), hashlib.sha256()
        else:
            sha.update(f"{'' if place == 1 else chr(10)}{role}:{text}".encode())
    if held is not None:
        yield *held, sha.hexdigest()


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), *_LONGS, ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return _batches(_hashed(_rows(batches)), schema, lambda r: 128 + len(r[-2]))


#: ASCII white space.
BLANKS = " \t\n\x0b\x0c\r"


class Conversations:
    """Turns of conversations, made ready for parsing: summary(), turns() and digests() give the repair.

    Turns are taken by turn, nulls first; turns of one number by role, then by the digest of their text. Null roles and
    texts are one space. A null id is a conversation of its own. Turns that are equal in all columns are repeats, so all
    but the first of them are deleted; times names a column that says how often a row occurs (0: not at all, but its
    conversation does). Texts may be of any length; other columns are ignored, whatever their names. An empty table has
    no conversations. Ids and turns must be whole numbers.
    """

    def __init__(self, turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", times: str | None = None) -> None:
        self.scratch = Scratch(turns.sparkSession, "conversations")
        text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" "))
        turn = whole_id(turns, turn_col)
        n = F.col(f"`{times}`").cast("long") if times else F.lit(1).cast("long")
        self.rows = turns.select(whole_id(turns, conv_col).alias("conv_id"), turn.isNotNull().alias("known"), turn.alias("turn"), F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" ")).alias("role"), text.alias("text"), F.coalesce(n, F.lit(0)).alias("n"))
        flags = self.rows.select("conv_id", "known", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), F.rtrim(F.col("text"), F.lit(BLANKS)).alias("ending"), "n")
        self.keys = ["conv_id", "known", "turn", "role", "digest"]
        flags = flags.select(*self.keys, (F.col("ending") == "").alias("blank"), (~F.substring("ending", -1, 1).isin(".", "!", "?")).alias("cut"), "n")
        self.skeleton = self.scratch.write(flags.groupBy(*self.keys, "blank", "cut").agg(F.sum("n").alias("n")), "skeleton")
        self._summary: DataFrame | None = None

    def _first(self, rows: DataFrame, key: str) -> DataFrame:
        """For each role and text of a conversation the place where it stands first."""
        firsts = rows.where("n > 0").groupBy("conv_id", "role", key).agg(F.min(F.struct("known", "turn")).alias("first"))
        return firsts.select("conv_id", "first.known", "first.turn", "role", key)

    def _sorted(self, rows: DataFrame) -> DataFrame:
        """The rows of a conversation together and in order: heads, then for each turn its mark or text before the turn."""
        return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("kind") >= 0, *self.keys[1:], "kind")

    def summary(self) -> DataFrame:
        """One row per conversation: conv_id, gaps (numbers missing between its first and last turn), blank, duplicate and
        truncated turns, illegal neighbours, and the cost and audit of the cheapest repair."""
        if self._summary is None:
            none = F.lit(False)
            marks = self._first(self.skeleton.where("NOT blank"), "digest").select(*self.keys, F.lit(0).alias("kind"), none.alias("blank"), none.alias("cut"), F.lit(0).cast("long").alias("n"))
            rows = marks.unionAll(self.skeleton.select(*self.keys, F.lit(1).alias("kind"), "blank", "cut", "n"))
            self._summary = self.scratch.write(self._sorted(rows).mapInArrow(_parse, f"conv_id long, {SUMMARY}"), "summary")
        return self._summary

    def _met(self) -> DataFrame:
        """Summaries, texts and turns, sorted: what the second pass reads."""
        null = lambda kind: F.lit(None).cast(kind)
        none = [null(c.split()[1]).alias(c.split()[0]) for c in SUMMARY.split(", ")]
        first = F.lit(False).alias("known"), null("long").alias("turn"), F.lit("").alias("role"), null("binary").alias("digest")
        heads = self.summary().select("conv_id", *first, F.lit(-1).alias("kind"), F.lit(0).cast("long").alias("n"), null("string").alias("text"), *_SUMMARY)
        texts = self._first(self.rows.where(F.rtrim(F.col("text"), F.lit(BLANKS)) != ""), "text").withColumn("digest", F.unhex(F.sha2("text", 256)))
        texts = texts.select(*self.keys, F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n"), "text", *none)
        marks = self.skeleton.where("n > 0").select(*self.keys, F.lit(1).alias("kind"), "n", null("string").alias("text"), *none)
        return self._sorted(heads.unionAll(texts).unionAll(marks))

    def turns(self) -> DataFrame:
        """The repaired conversations, one row per turn: conv_id, place (from 1), role, text, edit (K, R or I)."""
        return self._met().mapInArrow(_turns, "conv_id long, place long, role string, text string, edit string")

    def digests(self) -> DataFrame:
        """The summary and repaired_sha256, the digest of the repaired turns as lines `role:text`."""
        return self._met().mapInArrow(_digest, f"conv_id long, {SUMMARY}, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults, by the crc32 of `conv_id:turn` modulo 20: 0 drops a turn (times 0), 1 empties its text, 2 takes out its
    closing marks, 3 repeats it (times 2), 4 makes its role user. Nulls are one space in the key, the role and the text."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn"))) % 20
    text = F.when(k == 1, "").when(k == 2, F.regexp_replace(some("text"), "[.!?]", "")).otherwise(some("text"))
    times: Column = F.when(k == 0, 0).when(k == 3, 2).otherwise(1)
    return turns.select("conv_id", "turn", F.when(k == 4, "user").otherwise(some("role")).alias("role"), text.alias("text"), times.alias("times"))


def repair_conversations(turns: DataFrame, **how) -> DataFrame:
    """One row per conversation with its faults and the cheapest repair; see Conversations for the arguments and the cases."""
    return Conversations(turns, **how).summary()


def repaired_turns(turns: DataFrame, **how) -> DataFrame:
    """The turns of the repaired conversations; see Conversations for the arguments and the cases."""
    return Conversations(turns, **how).turns()


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Conversations(damaged(table(spark, sf_dir, "conversations")), times="times").digests()


_ADD = "lpad(CAST(CAST(substr({x}, 1, 9) AS BIGINT) + {c} AS VARCHAR), 9, '0') || substr({x}, 10) || '{e}'"


def _add(x: str, c: str | int, e: str) -> str:
    return _ADD.format(x=x, c=c, e=e)


def _scan(x: str, role: str) -> str:
    return f"CASE WHEN NOT t.must THEN CASE WHEN t.ini = '{role}' THEN {_add(x, 't.extra', 'K')} ELSE {_add(x, 't.extra + 3', 'R')} END END"


#: A least item is a string: the cost in nine digits, then the audit. least() skips nulls, which stand for no item.
OP13_SQL = rf"""
WITH RECURSIVE tab(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) AS t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM tab WHERE k < 8),
crc AS (SELECT list(CAST(c AS BIGINT) ORDER BY i) AS tab FROM tab WHERE k = 8),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS x FROM conversations),
dealt AS (
  SELECT conv_id, turn, role, text, CAST(xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(x)), lambda i: CAST(ascii(substr(x, CAST(i + 1 AS BIGINT), 1)) AS BIGINT))),
    lambda a, y: xor(a >> 8, tab[CAST((xor(a, y) & 255) + 1 AS BIGINT)]))) AS BIGINT) % 20 AS d
  FROM keyed, crc),
rows_ AS (
  SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE d WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM dealt),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM rows_),
judged AS (
  SELECT *, substr(role, 1, 1) AS ini, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ending, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
turns AS (
  SELECT *, ending = '' AS is_blank, ending <> '' AND again AS is_again, ending <> '' AND NOT again AND right(ending, 1) NOT IN ('.', '!', '?') AS is_cut FROM judged),
t AS (SELECT *, is_blank OR is_again AS must, CASE WHEN is_cut THEN 3 ELSE 0 END AS extra FROM turns),
convs AS (SELECT DISTINCT conv_id FROM conversations),
chart AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS st, CAST(NULL AS VARCHAR) AS sy, '000000003I' AS op, '000000006II' AS cl FROM convs
  UNION ALL
  SELECT conv_id, i, st, sy, op, least(cl, {_add("op", 3, "I")}) FROM (
    SELECT conv_id, i, st, sy, least(op, {_add("st", 3, "I")}, {_add("sy", 3, "I")}, {_add("cl", 3, "I")}) AS op, cl FROM (
      SELECT p.conv_id, t.i, {_add("p.st", 4, "D")} AS st,
        least({_add("p.sy", 4, "D")}, CASE WHEN NOT t.must AND t.ini = 's' THEN {_add("p.st", "t.extra", "K")} END) AS sy,
        least({_add("p.op", 4, "D")}, {_scan("p.st", "u")}, {_scan("p.sy", "u")}, {_scan("p.cl", "u")}) AS op,
        least({_add("p.cl", 4, "D")}, {_scan("p.op", "a")}) AS cl
      FROM chart p JOIN t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1))),
best AS (SELECT conv_id, least(st, cl) AS item FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS r FROM chart) WHERE r = 1),
edits AS (SELECT conv_id, unnest(string_split(substr(item, 10), '')) AS e, unnest(range(length(item) - 9)) AS p FROM best WHERE length(item) > 9),
counted AS (SELECT *, sum(CASE e WHEN 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE e WHEN 'D' THEN 0 ELSE 1 END) OVER w AS o FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY p ROWS UNBOUNDED PRECEDING)),
met AS (
  SELECT c.conv_id, c.p, c.e, c.o, t.role, CASE c.e WHEN 'I' THEN '' ELSE t.text END AS text, bool_or(c.o = 1 AND c.e = 'K' AND t.ini = 's') OVER (PARTITION BY c.conv_id) AS sys
  FROM counted c LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id AND t.i = c.i),
fixed AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o % 2 = 1) <> sys THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS body FROM met WHERE e <> 'D' GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_again) AS duplicate, count(*) FILTER (is_cut) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM t GROUP BY conv_id)
SELECT b.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(substr(item, 1, 9) AS BIGINT) AS cost, substr(item, 10) AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN fixed f ON f.conv_id IS NOT DISTINCT FROM b.conv_id
"""

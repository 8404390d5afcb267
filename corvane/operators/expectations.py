"""Constraints as tables of violations: (check, key, detail), empty when they hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import trim_ws


def _violations(rows: DataFrame, check: str, key: Column, detail: Column) -> DataFrame:
    return rows.select(F.lit(check).alias("check"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def unique(rows: DataFrame, check: str, *cols: str) -> DataFrame:
    """Keys that occur more than once; nulls don't collide."""
    full = rows.dropna(subset=list(cols)).groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")
    return _violations(full, check, F.concat_ws("|", *cols), F.col("n"))


def references(rows: DataFrame, check: str, cols: list[str], targets: DataFrame, target_cols: list[str], key: str) -> DataFrame:
    """Rows whose non-null reference has no target."""
    wanted = targets.select(*[F.col(c).alias(f"_t{k}") for k, c in enumerate(target_cols)]).distinct()
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_t{k}") for k, c in enumerate(cols)])
    return _violations(rows.dropna(subset=cols).join(wanted, on, "left_anti"), check, F.col(key), F.concat_ws("|", *cols))


def holds(rows: DataFrame, check: str, condition: Column, key: str) -> DataFrame:
    """Rows for which the condition is false; unknown passes, as in a CHECK constraint."""
    return _violations(rows.where(~F.coalesce(condition, F.lit(True))), check, F.col(key), F.lit(None))


def present(rows: DataFrame, check: str, col: str, key: str) -> DataFrame:
    return _violations(rows.where(F.col(col).isNull()), check, F.col(key), F.lit(col))


def same_set(left: DataFrame, right: DataFrame, check: str, col: str) -> DataFrame:
    """Values on one side only, with the side."""
    a, b = left.select(F.col(col).alias("v")).distinct(), right.select(F.col(col).alias("v")).distinct()
    return _violations(a.join(b, "v", "left_anti"), check, F.col("v"), F.lit("left only")).union(_violations(b.join(a, "v", "left_anti"), check, F.col("v"), F.lit("right only")))


def declared_counts(declared: DataFrame, actual: DataFrame, check: str) -> DataFrame:
    """(kind, n) on both sides: kinds whose counts differ; a kind without rows counts 0."""
    both = declared.select("kind", F.col("n").alias("declared")).join(actual.select("kind", F.col("n").alias("actual")), "kind", "full").fillna(0, ["declared", "actual"])
    return _violations(both.where("declared <> actual"), check, F.col("kind"), F.concat_ws("/", "declared", "actual"))


def sweep(spans: DataFrame, texts: DataFrame, owner: str = "owner", key: str = "key", text: str = "text") -> DataFrame:
    """Spans [start, end) of a text in order of place: (check, key, detail) of those that are empty, end outside the text, begin before
    an earlier one ends, or leave text between that is not white space; and of texts with such a rest after their last
    span, by owner. spans: owner, key, start, end. texts: owner, text; one row for each owner."""
    order = Window.partitionBy(owner).orderBy("start", "end", key)
    upto = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    swept = spans.select(owner, F.col(key).cast("string").alias("_key"), "start", "end", upto.alias("_upto"))
    own = swept.groupBy(owner).agg(F.max("end").alias("_last"), F.collect_list(F.struct("_key", "start", "end", "_upto")).alias("_spans"))  # as many as a text has passages
    rows = texts.select(owner, F.coalesce(F.col(text), F.lit("")).alias("_text")).join(own, owner, "left")
    size, last = F.length("_text"), F.coalesce("_last", F.lit(0))
    inked = lambda a, z: (z > a) & (F.coalesce(trim_ws(F.substr("_text", a + 1, z - a)), F.lit("")) != "")
    told = lambda check, k, detail: F.struct(F.lit(check).alias("check"), k.cast("string").alias("key"), detail.alias("detail"))
    place = lambda a, z: F.concat_ws("-", a.cast("string"), z.cast("string"))

    def faults(s: Column) -> Column:
        return F.array_compact(F.array(
            F.when((s["start"] < 0) | (s["end"] <= s["start"]), told("span-empty", s["_key"], place(s["start"], s["end"]))),
            F.when(s["end"] > size, told("span-outside", s["_key"], place(s["start"], s["end"]))),
            F.when(s["start"] < s["_upto"], told("span-overlap", s["_key"], place(s["start"], s["_upto"]))),
            F.when(inked(s["_upto"], s["start"]), told("span-gap", s["_key"], place(s["_upto"], s["start"]))),
        ))

    found = F.concat(F.flatten(F.transform(F.coalesce("_spans", F.array()), faults)), F.array_compact(F.array(F.when(inked(last, size), told("span-rest", F.col(owner), place(last, size))))))
    return rows.select(F.explode(found).alias("f")).select("f.check", "f.key", "f.detail")


def all_of(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionAll, checks)


class ExpectationError(ValueError):
    pass


def require(violations: DataFrame, most: int = 20) -> None:
    """Raises with the first few violations, if any."""
    if found := violations.take(most):
        raise ExpectationError("; ".join(f"{r['check']}: {r['key']} ({r['detail']})" for r in found))

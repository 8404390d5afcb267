"""Exact near-duplicates among embeddings by cover trees and a dual traversal.

Unit vectors with a cosine of c or more lie within sqrt(2 - 2c) of each other. A cover tree has nested levels with halving
radii: the nodes of a level are more than its radius apart and every point lies within the radius of a node. The dual
traversal walks two trees at once and drops a pair of nodes when the distance of their points, less both covering
radii, is beyond the threshold; what reaches the leaves is tested by cosine in double precision.

Vectors of a large label are first dealt to cells around pivots, each to its nearest one. A vector within the threshold of
one in another cell lies within the threshold of the plane between their pivots, so it visits only the cells whose plane is
that near, and of two cells the later one receives the visits: each pair that can link meets once, and far cells never meet.
A cell is a task: a tree of its own vectors, one of the visitors, a dual traversal of each. Cells above a bounded size are
cut into shards, whose pairs are tasks.

Equal vectors are one class from the start, so that copies cost one row however many they are. A task never holds the
pairs that link: each block of them is added to a count for each vector and contracted to one edge for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table, whole_id
from .graph import components, union_find

COSINE = 0.98
SHARD_ROWS = 8192
#: Vectors that a cell should have, and the most pivots of all labels together: what is broadcast is bounded by them.
CELL_ROWS, MOST_PIVOTS = 2048, 4096
#: Distances are computed in double precision; bounds are widened by this much, and the cosine decides.
SLACK = 1e-6
#: Pairs of vectors that are tested at once.
BLOCK_CELLS = 2_000_000


class CoverTree:
    """Levels of a batch-built cover tree. level 0 has one node with the radius of all points; the radius halves at
    each level; a point that is a node stays a node further down (nesting)."""

    def __init__(self, points: np.ndarray, least_radius: float) -> None:
        if not np.isfinite(points).all():
            raise ValueError("points of a cover tree must be finite")
        self.points = points
        radius = float(np.sqrt(((points - points[0]) ** 2).sum(1)).max()) if len(points) else 0.0
        members = [np.arange(len(points))]  # of each node of the level
        nodes = [0] if len(points) else []
        self.levels: list[tuple[np.ndarray, list[np.ndarray], np.ndarray]] = []  # node points, children, covering radius
        while nodes:
            cover = np.array([float(np.sqrt(((points[m] - points[n]) ** 2).sum(1)).max()) for n, m in zip(nodes, members, strict=True)])
            radius /= 2
            if cover.max() <= least_radius or radius <= least_radius / 4:
                self.levels.append((np.array(nodes), members, cover))
                break
            below, below_members, children = [], [], []
            for n, m in zip(nodes, members, strict=True):
                first = len(below)
                rest, centre = m, n
                while len(rest):
                    d = np.sqrt(((points[rest] - points[centre]) ** 2).sum(1))
                    near = d <= radius
                    below.append(centre)
                    below_members.append(rest[near])
                    rest, d = rest[~near], d[~near]
                    if len(rest):
                        centre = rest[np.argmax(d)]
                children.append(np.arange(first, len(below)))
            self.levels.append((np.array(nodes), children, cover))
            nodes, members = below, below_members

    @property
    def depth(self) -> int:
        return len(self.levels)


def _close(p: np.ndarray, q: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Whether unit vectors p (rows) and q (columns) are within reach, by a matrix product."""
    return 2 - 2 * (p @ q.T) <= (reach + SLACK) ** 2


def dual_pairs(a: CoverTree, b: CoverTree, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Index arrays of points of a and b, covering every pair within reach: the members of a leaf of a, and those of all leaves
    of b that are left with it. With b the same tree as a, each unordered pair of leaves comes once, and a leaf with itself
    comes alone, marked by True."""
    if not a.depth or not b.depth:
        return
    same = a is b
    px = py = np.zeros(1, np.int64)
    la = lb = 0
    while len(px) and (la < a.depth - 1 or lb < b.depth - 1):
        down_a = la < a.depth - 1 and (same or lb == b.depth - 1 or a.levels[la][2].max() >= b.levels[lb][2].max())
        down_b = lb < b.depth - 1 and (same or not down_a)
        ca, cb = a.levels[la][1], b.levels[lb][1]
        la, lb = la + down_a, lb + down_b
        na, _, ra = a.levels[la]
        nb, _, rb = b.levels[lb]
        left_x, left_y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        cuts = np.flatnonzero(np.diff(px, prepend=-1))
        for at, end in zip(cuts, [*cuts[1:], len(px)], strict=True):  # a node of a with all nodes of b that it is paired with
            x = px[at]
            i = ca[x] if down_a else np.array([x])
            j = np.concatenate([cb[y] for y in py[at:end]]) if down_b else py[at:end]
            for k in range(0, len(i), 512):  # row blocks bound the memory of the product
                part = i[k : k + 512]
                u, v = np.nonzero(_close(a.points[na[part]], b.points[nb[j]], ra[part][:, None] + rb[j][None, :] + reach))
                u, v = part[u], j[v]
                if same:
                    u, v = u[u <= v], v[u <= v]
                left_x.append(u)
                left_y.append(v)
        px, py = np.concatenate(left_x), np.concatenate(left_y)
        order = np.lexsort((py, px))
        px, py = px[order], py[order]
    members = b.levels[-1][1]
    cuts = np.flatnonzero(np.diff(px, prepend=-1))
    for at, end in zip(cuts, [*cuts[1:], len(px)] if len(px) else [], strict=True):
        x, others = px[at], py[at:end]
        p = a.levels[-1][1][x]
        if same and others[0] == x:
            yield p, p, True
            others = others[1:]
        if len(others):
            yield p, np.concatenate([members[y] for y in others]), False


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows times the power of two that brings their largest component to between 0.5 and 1, which is exact, and their
    norms: the squares of extreme finite values neither vanish nor overflow."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0))[1][:, None])
    return x, np.sqrt((x * x).sum(1))


def link_blocks(x: np.ndarray, y: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(rows of x, rows of y, whether they link, whether the block counts for both orders) for rows that are finite and
    not zero, covering all that link; with y the same array as x, each block of two leaves comes once."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    (sx, nx), (sy, ny) = scaled(x), scaled(y)
    one = CoverTree(sx / nx[:, None], reach / 4)
    two = one if y is x else CoverTree(sy / ny[:, None], reach / 4)
    for p, q, itself in dual_pairs(one, two, reach):
        step = max(1, BLOCK_CELLS // len(q))
        for k in range(0, len(p), step):
            part = p[k : k + step]
            yield part, q, (sx[part] @ sy[q].T) / (nx[part][:, None] * ny[q][None, :]) >= cosine, y is x and not itself


def linked_pairs(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with cosine(x[i], y[j]) >= cosine; with y the same array as x, each pair in both orders, and rows with
    themselves."""
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p, q, linked, twice in link_blocks(x, y, cosine):
        i, j = np.nonzero(linked)
        out_i += [p[i], q[j]][: 1 + twice]
        out_j += [q[j], p[i]][: 1 + twice]
    return np.concatenate(out_i), np.concatenate(out_j)


def link_counts(x: np.ndarray, y: np.ndarray, cosine: float, copies_x: np.ndarray, copies_y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Copies that each row of x and each row of y links with, and a component's first row for each row of x, then of y.
    With y the same array as x, the second count is the first, and rows count once.

    Of a block's links only those between rows not yet known to be connected are looked at one by one."""
    same = y is x
    nx, ny = np.zeros(len(x)), np.zeros(len(y))
    if same:
        ny = nx
    after = 0 if same else len(x)
    label = np.arange(after + len(y))
    for p, q, linked, twice in link_blocks(x, y, cosine):
        if not linked.any():
            continue
        nx[p] += linked @ copies_y[q]
        if twice or not same:
            ny[q] += copies_x[p] @ linked
        a, b = label[p], label[after + q]
        i, j = np.nonzero(linked & (a[:, None] != b[None, :]))
        if len(i):
            nodes, low = union_find(a[i], b[j])
            to = np.arange(len(label))
            to[nodes] = low
            label = to[label]
    return nx, ny, label


def cells_of(v: np.ndarray, pivots: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cell of each vector, and its visits as (row, cell): to later cells whose plane is within reach. pivots: unit rows."""
    x, norm = scaled(v)
    x = x / norm[:, None]
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    along = x @ pivots.T
    home = along.argmax(1)
    gap = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))
    # the distance from a unit vector to the plane between unit pivots p and q is <x, p - q> / |p - q|
    near = along[np.arange(len(x)), home][:, None] - along <= (reach + SLACK) * gap[home] + SLACK
    row, cell = np.nonzero(near & (np.arange(len(pivots))[None, :] > home[:, None]))
    return home, row, cell


def _pivots(grouped: DataFrame, cell_rows: int, most: int) -> dict[int, np.ndarray]:
    """Pivots of each group (group, node, copies, v) with more than two cells' rows, as unit rows: vectors with the smallest hashes,
    at most twice `most` in all, shared out by size. Any choice gives the same links."""
    sizes = grouped.groupBy("group").agg(F.count("*").alias("rows"))
    large = sizes.where(F.col("rows") > 2 * cell_rows).withColumn("share", F.least(F.lit(1.0 / cell_rows), F.lit(float(most)) / (sizes.agg(F.sum("rows").alias("t")).first()["t"] or 1)))
    chosen = grouped.join(large, "group").where(F.pmod(F.xxhash64("node"), F.lit(1 << 40)) < F.col("share") * float(1 << 40)).select("group", "v").limit(2 * most).toArrow()
    group = chosen["group"].to_numpy()
    out = {}
    for g in np.unique(group):
        v = chosen["v"].take(np.flatnonzero(group == g)).combine_chunks()
        x, norm = scaled(np.array(v.flatten()).reshape(len(v), -1))
        if len(x) > 1:
            out[int(g)] = x / norm[:, None]
    return out


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, shard_rows: int = SHARD_ROWS, cell_rows: int = CELL_ROWS, most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id (smallest id reachable by links), kept (vec_id = component_id).

    Rows link only when labels are equal and not null, and vectors have the same length. A vector that is null, empty,
    zero, or holds a null or non-finite component links with nothing and is its own component; so does one with a null
    label. A row with a null id has no links, a null component and a null kept. Rows that share an id are linked like
    others, each counting as one vector. Ids must be of a whole-number type. Other columns are ignored, and an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    rows = vectors.select(whole_id(vectors, id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable).withColumn("c1", F.when(F.col("usable"), F.xxhash64("label", "v"))).withColumn("c2", F.when(F.col("usable"), F.hash("v", "label")))
    rows = scratch.write(rows, "rows")
    classes = rows.where("usable").groupBy("label", "c1", "c2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("v").alias("v"))
    classes = scratch.write(classes, "classes")
    grouped = classes.select(F.xxhash64("label", F.size("v")).alias("group"), "node", "copies", "v")
    pivots = spark.sparkContext.broadcast(_pivots(grouped, cell_rows, most_pivots))

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            group = batch.column(0).to_numpy()
            cell, rows, visited = np.zeros(len(group), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for g in np.intersect1d(group, list(pivots.value)):
                at = np.flatnonzero(group == g)
                own = batch.column(3).take(pa.array(at))
                cell[at], row, to = cells_of(np.array(own.flatten()).reshape(len(at), -1), pivots.value[g], cosine)
                rows.append(at[row])
                visited.append(to)
            order = np.concatenate([np.arange(len(group)), *rows])
            visits = np.arange(len(order)) >= len(group)
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(order)) for c in batch.columns), pa.array(np.concatenate([cell, *visited])), pa.array(visits)], names=["group", "node", "copies", "v", "cell", "visits"])

    placed = scratch.write(grouped.mapInArrow(place, "group long, node long, copies long, v array<double>, cell long, visits boolean"), "placed")
    shards = lambda own: F.ceil(F.count_if(own) / shard_rows).cast("long")
    sizes = placed.groupBy("group", "cell").agg(shards(~F.col("visits")).alias("own"), shards(F.col("visits")).alias("guests"))
    dealt = placed.join(sizes, ["group", "cell"]).withColumn("shard", F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("visits"), F.col("guests")).otherwise(F.col("own"))))
    # Shards of a cell's own vectors meet each other, and each meets the shards of the visitors.
    up_to = lambda n: F.transform(F.when(F.col(n) > 0, F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).otherwise(F.array().cast("array<long>")), lambda k: F.struct(F.lit(n).alias("with"), k.alias("other")))
    tasks = dealt.withColumn("m", F.explode(F.when(F.col("visits"), up_to("own")).otherwise(F.concat(up_to("own"), up_to("guests")))))
    among = ~F.col("visits") & (F.col("m.with") == "own")
    lo, hi = F.least("shard", "m.other"), F.greatest("shard", "m.other")
    guest, own = F.when(F.col("visits"), F.col("shard")).otherwise(F.col("m.other")), F.when(F.col("visits"), F.col("m.other")).otherwise(F.col("shard"))
    task = F.when(among, F.xxhash64("group", "cell", lo, hi)).otherwise(F.xxhash64("group", "cell", guest, own, F.lit("visit")))
    tasks = tasks.select(task.alias("task"), F.when(among, F.col("shard") == lo).otherwise(F.col("visits")).alias("left"), F.when(among, F.col("shard") == hi).otherwise(~F.col("visits")).alias("right"), "node", "copies", "v")

    def links(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            node, copies = t["node"].to_numpy(), t["copies"].to_numpy().astype(np.float64)
            v = np.array(t["v"].combine_chunks().flatten()).reshape(len(node), -1)
            left, right = np.flatnonzero(t["left"].to_numpy()), np.flatnonzero(t["right"].to_numpy())
            n = np.zeros(len(node))
            if len(left) == len(right) == len(node):  # a shard with itself
                n, _, label = link_counts(v, v, cosine, copies, copies)
                n -= copies  # each row links with itself
                at = np.arange(len(node))
            else:
                n[left], n[right], label = link_counts(v[left], v[right], cosine, copies[left], copies[right])
                at = np.concatenate([left, right])
            seen = np.flatnonzero(n[at] > 0)
            return pa.RecordBatch.from_arrays([pa.array(node[at[seen]]), pa.array(node[at[label[seen]]]), pa.array(np.rint(n[at[seen]]).astype(np.int64))], names=["a", "b", "n"])

        now = None
        for batch in it:
            task = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(task)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(task)], strict=True):
                if a == b:
                    continue
                if held and task[a] != now:
                    yield flush()
                    held = []
                now = task[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield flush()

    found = tasks.repartition("task").sortWithinPartitions("task").mapInArrow(links, "a long, b long, n long")
    found = scratch.write(found, "found")
    labels = components(found.select("a", "b"), scratch, "components")
    counts = found.groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "node")
    marked = classes.join(counts, "node", "left").join(labels.withColumnRenamed("label", "root"), "node", "left")
    marked = marked.select("label", "c1", "c2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    out = rows.where("usable").select("vec_id", "label", "c1", "c2").join(marked, ["label", "c1", "c2"]).select("vec_id", "n_links", "component_id")
    rest = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (
  SELECT r, vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b, a.vec_id AS va, b.vec_id AS vb FROM u a JOIN u b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach AS (SELECT DISTINCT va AS f, va AS t FROM links UNION SELECT reach.f, links.vb FROM reach JOIN links ON reach.t = links.va),
comp AS (SELECT f, min(t) AS component_id FROM reach GROUP BY f),
n AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, CAST(coalesce(comp.component_id, v.vec_id) AS BIGINT) AS component_id,
  v.vec_id = coalesce(comp.component_id, v.vec_id) AS kept
FROM v LEFT JOIN n ON v.r = n.r LEFT JOIN comp ON v.vec_id = comp.f
"""

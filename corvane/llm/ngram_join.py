"""Documents whose sets of word shingles have a Jaccard similarity of a threshold or more, by PartEnum signatures.

Sizes fall into bands inside which the threshold allows any two; a structure covers a band and the next one, and every
set is signed in the structure of its own band and in the one below, so any two sets that can link share a structure.
In a structure, linked sets differ in at most k elements. The hashed domain is cut into groups, more than k / 2 of them,
so that a group holds at most one difference, and each group into two parts; one of the two then agrees, so the contents
of each part (the subsets of one out of two) are signatures. A signature over a single shingle brings unrelated texts
together; a few spare groups make those needless, and only a set with more weak groups than that has them signed too.

Exact copies are one class throughout: signatures carry the hash of the set, and only a class's first document is signed.
Most signatures belong to one class and tell nothing. So they are looked for twice: first only some bits of each are
dealt out, sorted and packed to two or three bytes, and a bitmap tells which were seen again; then those signatures
alone are dealt out, with their classes.
Sets that share a signature are not paired: a bucket falls apart where sketches prove that its members can't link, and
each part of m sets is chained by m - 1 edges. The components of these edges are families,
and the exact test runs inside a family, in blocks of bounded size, as products of incidence matrices. A family of
more than one block is tested block by block; then connecting members of all blocks are tested with each other; then every
member outside the largest component is tested against all. Only pairs that are known to be in one component go untested,
so no link between components is lost, and no step emits pairs: each gives at most one edge for each document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain as chain_of

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, fresh, join_counted, table, whole_id
from .graph import components, union_find
from .wordhash import buffers, distinct, mix, runs, shingle_hashes, word_hashes

WORDS, NUM, DEN = 4, 85, 100
#: Of each so many groups one is added to those that the differences ask for, and one more, so that weak ones need not be signed.
SPARE_PART = 8
#: A signature over fewer shingles than this is weak: one common phrase would bring unrelated texts together.
STRONG = 2
#: A block of a family, which one task tests: at most so many sets, with about so many shingles in all.
BLOCK_ROWS, BLOCK_SHINGLES = 1500, 1_200_000
ALL_PAIRS, MATRIX_ROWS, SPLITS = 16, 4096, 100
#: Rows of buckets that a task takes at once; a bucket beyond it is chained without sketches.
BUCKET_ROWS = 100_000
CONNECTORS = 48
#: Shingles of all classes for each task that sorts their signatures, of which there are about half as many.
SORTED_SHINGLES = 3_000_000
#: Signatures that a task packs at once, shingles for each part of the packed ones, most places (as a power of 2) of a bitmap that tells of signatures.
PACKED, PART_SHINGLES, SEEN_BITS = 1 << 21, 1 << 20, 28
#: Bits of a packed signature beyond those that would number all of them: of the single ones, one in so many powers of 2 looks repeated.
SPARE_BITS = 6
#: Places of the bitmap of rows that may go.
SLOTS = 1 << 22
_LOW = np.uint64((1 << 26) - 1)


def bands(num: int, den: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest size of each band, and the most differences between linked sets of a structure (this band and the next)."""
    lows, diffs, low = [], [], 1
    while low <= most or not lows:
        high = den * low // num
        lows.append(low)
        diffs.append((den - num) * (high + den * high // num) // (den + num))
        low = high + 1
    return np.array(lows), np.array(diffs)


def _sums(hashes: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Order-free 52-bit sums of hashes by key, exact in doubles."""
    a = np.bincount(keys, weights=(hashes & _LOW).astype(np.float64), minlength=n).astype(np.uint64)
    b = np.bincount(keys, weights=((hashes >> np.uint64(32)) & _LOW).astype(np.float64), minlength=n).astype(np.uint64)
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + mix(b))


def set_hashes(rows: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two independent hashes of each row's set."""
    size = np.bincount(rows, minlength=n)
    one = mix(_sums(values, rows, n) + size.astype(np.uint64))
    two = mix(_sums(mix(values + np.uint64(1)), rows, n) ^ size.astype(np.uint64))
    return size, one.view(np.int64), two.view(np.int64)


def signatures(rows: np.ndarray, values: np.ndarray, size: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of all sets; rows sorted, values distinct inside a row."""
    low, diffs = bands(num, den, int(size.max(initial=1)))
    band = np.searchsorted(low, np.maximum(size, 1), "right") - 1
    out_rows, out = [], []
    for down in (0, 1):
        structure = band - down
        k = np.where((structure >= 0) & (size > 0), diffs[np.maximum(structure, 0)], 0)
        bad = k // 2  # groups that can hold two differences or more
        groups = np.where(k > 0, bad + 1 + (bad + 1) // SPARE_PART + 1, 0)  # k = 0: only equal sets can link, and those are one class
        base = np.concatenate([[0], np.cumsum(groups)])
        used = groups[rows] > 0
        r, v = rows[used], values[used]
        salt = mix(structure.astype(np.uint64) + np.uint64(77))
        place = mix(v ^ salt[r])
        part = ((place >> np.uint64(32)) * (2 * groups[r]).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        key = 2 * base[r] + part
        n = int(base[-1])
        weak = np.bincount(key, minlength=2 * n).reshape(n, 2) < STRONG
        owner = np.repeat(np.arange(len(size)), groups)
        weak_groups = np.bincount(owner, weights=weak.any(1), minlength=len(size)) if n else np.zeros(len(size))
        keep = (~weak | (weak_groups >= groups - bad)[owner][:, None]).ravel()
        sums = _sums(place, key, 2 * n)
        number = np.arange(2 * n) - 2 * np.repeat(base[owner], 2)
        owner = np.repeat(owner, 2)
        out_rows.append(owner[keep])
        out.append(mix(sums + mix(salt[owner] + number.astype(np.uint64)))[keep])
    return np.concatenate(out_rows), np.concatenate(out)


def packed(values: np.ndarray) -> bytes:
    """Sorted whole numbers as the differences between them: all lowest bytes, then all next ones, as far as any is used."""
    gaps = np.diff(values.astype("<u8"), prepend=np.uint64(0))
    width = max(1, (int(gaps.max(initial=0)).bit_length() + 7) // 8)
    return gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(-1, n)
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, : len(planes)] = planes.T
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64)


def power(n: int) -> int:
    """The least power of 2, as its exponent, that is n or more."""
    return max(0, int(n) - 1).bit_length()


def bitmap(rows: DataFrame, place: Column, bits: int) -> np.ndarray:
    """2 ** bits places, set where a row has one, as words of 64; no more than these words reach the driver."""
    words = rows.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 AS int))")).alias("bits")).toArrow()
    out = np.zeros(max(1, 1 << bits >> 6), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def sketch(values: np.ndarray) -> bytes:
    """Elements of a set in bins, cut off at 255; large sets have more bins. The sum of absolute differences of two
    sketches, summed up to equal numbers of bins, never exceeds the number of differences between the sets."""
    bits = 7 if len(values) <= 1200 else 9 if len(values) <= 4800 else 11
    counts = np.bincount((mix(values ^ np.uint64(0x5DEECE66D)) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def squeezed(drawn: bytes) -> bytes:
    """A sketch as it travels: its counts are small, and it goes along with each bucket that its class is in."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -15, strategy=zlib.Z_RLE)
    return pack.compress(drawn) + pack.flush()


def _folded(sketches: list[bytes], rows: np.ndarray) -> np.ndarray:
    """The sketches of these rows with as many bins as the smallest has."""
    found = [np.frombuffer(sketches[r], np.uint8) for r in rows]
    bins = min(map(len, found))
    return np.stack([f if len(f) == bins else f.reshape(bins, -1).sum(1) for f in found]).astype(np.int16)


def split_buckets(bucket: np.ndarray, sketches: list[bytes], size: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by bucket. Pairs of rows (i, j) that connect all members of a bucket which may link.

    Two members whose sketches differ by more than a link allows for their sizes can't link. In buckets of up to MATRIX_ROWS
    members all pairs of sketches are compared, in small ones many buckets at once; in larger ones a comparison with a
    first member splits the rest, as distances of sketches are a metric: sorted by their distance from it, members on either
    side of a gap above the allowed difference can't link. What is together after SPLITS of these is chained, which is
    always safe.
    """
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    allowed = lambda i, j: (den - num) * (size[i] + size[j]) // (den + num)
    wide = np.array([len(x) for x in sketches]) > 128
    plain = np.frombuffer(b"".join(x if not w else b"\0" * 128 for x, w in zip(sketches, wide, strict=True)), np.uint8).reshape(-1, 128)
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    counts = np.diff(np.concatenate([starts, [len(bucket)]]))
    has_wide = np.add.reduceat(wide, starts) > 0
    for m in np.unique(counts[(counts <= ALL_PAIRS) & (counts > 1)]):
        of = starts[(counts == m) & ~has_wide]
        x, y = np.triu_indices(m, 1)
        step = max(1, 200_000 // len(x))
        for k in range(0, len(of), step):
            i, j = (of[k : k + step, None] + x).ravel(), (of[k : k + step, None] + y).ravel()
            away = np.abs(plain[i].astype(np.int16) - plain[j]).sum(1)
            near = away <= allowed(i, j)
            out_i.append(i[near])
            out_j.append(j[near])
    for at, m in zip(starts, counts, strict=True):
        if m == 1 or (m <= ALL_PAIRS and not has_wide[np.searchsorted(starts, at)]):
            continue
        waiting = [np.arange(at, at + m)]
        for _ in range(SPLITS):
            if not waiting:
                break
            rows = waiting.pop()
            drawn = _folded(sketches, rows)
            if len(rows) <= MATRIX_ROWS:
                step, label = max(1, 4_000_000 // drawn.size), np.arange(len(rows))
                for k in range(0, len(rows), step):
                    away = np.abs(drawn[k : k + step, None, :] - drawn[None, k:, :]).sum(2, dtype=np.int32)
                    i, j = np.nonzero(away <= allowed(rows[k : k + step, None], rows[None, k:]))
                    # what is known and what is new, as one label for each member: pairs don't pile up
                    _, label = union_find(np.concatenate([np.arange(len(rows)), i + k]), np.concatenate([label, j + k]))
                joined = np.flatnonzero(label != np.arange(len(rows)))
                out_i.append(rows[joined])
                out_j.append(rows[label[joined]])
                continue
            away = np.abs(drawn - drawn[0]).sum(1, dtype=np.int64)
            order = np.argsort(away, kind="stable")
            rows, away = rows[order], away[order]
            most = (den - num) * 2 * int(size[rows].max()) // (den + num)
            parts = np.split(rows, np.flatnonzero(np.diff(away) > most) + 1)
            if len(parts) == 1:
                out_i.append(rows[:-1])
                out_j.append(rows[1:])
            else:
                waiting += [p for p in parts if len(p) > 1]
        for rows in waiting:
            out_i.append(rows[:-1])
            out_j.append(rows[1:])
    return np.concatenate(out_i), np.concatenate(out_j)


def _sets(texts: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, at = buffers(texts)
    for a, b, part, offsets in runs(raw, at):
        yield a, b, *distinct(*shingle_hashes(*word_hashes(part, offsets), words))


def link_labels(sets: list[np.ndarray], num: int, den: int, asks: np.ndarray | None = None) -> np.ndarray:
    """For each set the first set of its component among these. asks: only pairs with at least one such set are tested.

    Intersections of all pairs come from products of incidence matrices over the shingles that two sets or more hold, a
    few thousand columns at a time; the matrices stay within block size, however long the sets are.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(n), size)
    values, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen >= 2
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    q = np.arange(n) if asks is None else np.flatnonzero(asks)
    both = np.zeros((len(q), n), np.float32)
    width = 4096
    for c in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [c, c + width])
        x = np.zeros((n, min(width, int(shared.sum()) - c)), np.float32)
        x[row[a:b], column[a:b] - c] = 1
        used = x.any(1)
        qi, ti = np.flatnonzero(used[q]), np.flatnonzero(used)
        both[np.ix_(qi, ti)] += x[q[qi]] @ x[ti].T
    i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(0, len(q), 256):  # row blocks bound the memory of whole numbers
        inter = both[k : k + 256].astype(np.int64)
        a, b = np.nonzero(den * inter >= num * (size[q[k : k + 256]][:, None] + size[None, :] - inter))
        i.append(a + k)
        j.append(b)
    i, j = np.concatenate(i), np.concatenate(j)
    nodes, label = union_find(np.concatenate([q[i], np.arange(n)]), np.concatenate([j, np.arange(n)]))
    return label


def _verify(tasks: DataFrame, num: int, den: int) -> DataFrame:
    """tasks: (task long, node long, asks boolean, shingles binary). Edges (a, b) that span the links found in each task."""

    def edges(task: list[tuple[int, bool, np.ndarray]]) -> pa.RecordBatch | None:
        nodes = np.array([t[0] for t in task], np.int64)
        order = np.argsort(nodes, kind="stable")
        label = link_labels([task[i][2] for i in order], num, den, np.array([task[i][1] for i in order]))
        nodes = nodes[order]
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["a", "b"])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in it:
            for task, node, asks, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                if task != now and held:
                    yield edges(held)
                    held = []
                now = task
                held.append((node, asks, np.frombuffer(data.as_buffer(), np.uint64).copy()))
        if held:
            yield edges(held)

    return tasks.repartition("task").sortWithinPartitions("task").select("task", "node", "asks", "shingles").mapInArrow(batches, "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, num: int = NUM, den: int = DEN, block_rows: int = BLOCK_ROWS, connectors: int = CONNECTORS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest id reachable by links, itself included).

    Two documents link when den * |intersection| >= num * |union| of their sets of distinct shingles of `words` words; a
    shorter text has its whole sequence as its only shingle. A null, empty or blank text has no shingle and links with
    nothing. A row with a null id gets a null component and no links. Rows that share an id count as one node, as ids are
    what components are made of. Ids must be of a whole-number type. Other columns are ignored, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    texts = docs.select(whole_id(docs, id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def describe(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids = batch.column(0)
            for a, b, rows, values in _sets(batch.column(1), words):
                size, one, two = set_hashes(rows, values, b - a)
                ends = np.searchsorted(rows, np.arange(b - a + 1))
                drawn = pa.array([squeezed(sketch(values[x:y])) for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(size), pa.array(one), pa.array(two), drawn], names=["doc_id", "n", "c1", "c2", "sketch"])

    described = scratch.write(texts.mapInArrow(describe, "doc_id long, n long, c1 long, c2 long, sketch binary"), "described")
    classes = described.where("doc_id is not null and n > 0").groupBy("c1", "c2").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.count("*").alias("copies"))
    classes = scratch.write(classes, "classes")
    total, n_classes = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    first_bits = min(26, power(4 * n_classes))
    firsts = spark.sparkContext.broadcast(bitmap(classes, F.expr(f"(c1 ^ node) & {(1 << first_bits) - 1}L"), first_bits))

    def sign(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Signatures and classes of the first documents of classes, each pair once."""
        done: set[int] = set()  # nor is a copy signed that the bitmap lets through, if it is in the same task
        for batch in it:
            ids = batch.column(0).to_numpy()
            for a, b, rows, values in _sets(batch.column(1), words):
                size, one, _ = set_hashes(rows, values, b - a)
                place = (one ^ ids[a:b]) & ((1 << first_bits) - 1)
                new = (firsts.value[place >> 6] >> (place & 63) & 1 > 0) & (size > 0)
                for k in np.flatnonzero(new).tolist():
                    c = int(one[k])
                    new[k] = c not in done
                    done.add(c)
                keep = new[rows]
                owner, signature = signatures(rows[keep], values[keep], np.where(new, size, 0), num, den)
                both = np.unique(np.stack([signature.view(np.int64), one[owner]]), axis=1)
                yield both[0].view(np.uint64), both[1]

    # Which signatures were seen more than once, by their first bits: a part of all these is one task's, which gives its piece of the bitmap.
    part_bits = power(-(-total // PART_SHINGLES))
    bits = max(power(total) + SPARE_BITS, part_bits + 8)
    seen_bits = max(min(SEEN_BITS, power(total) - 1), part_bits + 3)
    low = np.uint64(bits - part_bits)

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for signature in chain_of((x for x, _ in sign(it)), [None]):
            if signature is not None:
                held.append(signature >> np.uint64(64 - bits))
                n += len(signature)
            if held and (signature is None or n >= PACKED):
                every = np.sort(np.concatenate(held))
                ends = np.searchsorted(every, np.arange(1, 1 << part_bits, dtype=np.uint64) << low)
                pieces = np.split(every & ((np.uint64(1) << low) - np.uint64(1)), ends)
                own = [k for k, piece in enumerate(pieces) if len(piece)]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array([len(pieces[k]) for k in own], pa.int32()), pa.array([packed(pieces[k]) for k in own], pa.binary())], names=["part", "n", "gaps"])
                held, n = [], 0

    def again(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece(part: int, held: list[np.ndarray]) -> pa.RecordBatch:
            every = np.sort(np.concatenate(held))
            places = np.zeros(1 << (seen_bits - part_bits), bool)
            places[every[1:][every[1:] == every[:-1]] >> np.uint64(bits - seen_bits)] = True
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(places, bitorder="little").tobytes()], pa.binary())], names=["part", "places"])

        held, now = [], None
        for batch in it:
            for part, n, gaps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now and held:
                    yield piece(now, held)
                    held = []
                now = part
                held.append(unpacked(gaps, n))
        if held:
            yield piece(now, held)

    known = texts.where("doc_id is not null")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << part_bits)
    pieces = known.mapInArrow(pack, "part int, n int, gaps binary").repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(again, "part int, places binary").toArrow()
    seen = np.zeros((1 << part_bits, 1 << (seen_bits - part_bits - 3)), np.uint8)
    for part, places in zip(pieces["part"].to_pylist(), pieces["places"], strict=True):
        seen[part] = np.frombuffer(places.as_buffer(), np.uint8)
    del pieces
    met = spark.sparkContext.broadcast(seen.ravel())

    def sign_met(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for signature, c1 in sign(it):
            place = (signature >> np.uint64(64 - seen_bits)).astype(np.int64)
            keep = met.value[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0
            yield pa.RecordBatch.from_arrays([pa.array(signature[keep].view(np.int64)), pa.array(c1[keep])], names=["sig", "c1"])

    signed = known.mapInArrow(sign_met, "sig long, c1 long")
    # Dealt so that a task sorts a bounded number of them in memory, whatever the input: what is spilled is written again.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    signed = signed.repartition(max(parts, total // SORTED_SHINGLES), "sig")

    def listed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by sig and c1. Buckets of more than one class as lists of their classes. A bucket beyond bucket_rows comes in
        pieces, of which each begins with the class that the one before ended with."""
        sig = c1 = np.zeros(0, np.int64)
        pieces = 0  # of the first bucket that is held, those that went out before
        for batch in chain_of(it, [None]):
            last = batch is None
            if not last:
                sig, c1 = np.concatenate([sig, batch.column(0).to_numpy()]), np.concatenate([c1, batch.column(1).to_numpy()])
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (c1[1:] != c1[:-1])]) if len(sig) else np.zeros(0, bool)
            sig, c1 = sig[new], c1[new]
            starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
            if not len(starts):
                continue
            full = not last and len(sig) - starts[-1] > bucket_rows  # the last bucket is too large to be held
            upto = len(sig) if last or full else starts[-1]
            own = starts[starts < upto]
            if len(own):
                ends = np.append(own[1:], upto)
                piece = np.zeros(len(own), np.int64)
                piece[0] = pieces
                big = np.flatnonzero((ends - own > 1) | (piece > 0))
                sizes = (ends - own)[big]
                rows = np.repeat(own[big] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(c1[rows]))
                in_pieces = (piece > 0)[big]
                if full:
                    in_pieces[-1] = True
                yield pa.RecordBatch.from_arrays([pa.array(sig[own[big]]), lists, pa.array(in_pieces)], names=["sig", "members", "large"])
                if full:
                    pieces = pieces + 1 if len(own) == 1 else 1
                else:
                    pieces = 0
            sig, c1 = (sig[-1:], c1[-1:]) if full else (sig[upto:], c1[upto:])

    ordered = signed.sortWithinPartitions("sig", "c1")
    lists = scratch.write(ordered.mapInArrow(listed, "sig long, members array<long>, large boolean"), "lists")
    # A bucket beyond the size that a task holds is chained as it stands, member to member, which is always safe: the exact test comes later.
    steps = F.explode(F.transform("members", lambda c, k: F.struct(c.alias("a"), F.get("members", k - 1).alias("b")))).alias("e")
    whole = lists.where("large").select(steps).select("e.a", "e.b").where("b is not null")
    # Near copies meet in hundreds of buckets that hold the same classes; one of these says all that the others do.
    small = lists.where("not large").groupBy("members").agg(F.min("sig").alias("sig"))
    shared = small.select("sig", F.explode("members").alias("c1"))
    drawn = described.where("n > 0").groupBy("c1").agg(F.first("sketch").alias("sketch"), F.max("n").alias("n"))

    def chain(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            drawing = [zlib.decompress(d, -15) for d in t["sketch"].to_pylist()]
            c1 = t["c1"].to_numpy()
            i, j = split_buckets(t["sig"].to_numpy(), drawing, t["n"].to_numpy(), num, den)
            node, label = union_find(c1[i], c1[j])  # at most one edge for each class
            return pa.RecordBatch.from_arrays([pa.array(node[node != label]), pa.array(label[node != label])], names=["a", "b"])

        held, rows = [], 0
        for batch in it:
            sig = batch.column(0).to_numpy()
            if rows >= bucket_rows:  # a bucket is never cut: wait for the next one's first row
                change = np.flatnonzero(sig != held[-1].column(0)[-1].as_py())
                if len(change):
                    held.append(batch.slice(0, change[0]))
                    yield edges(held)
                    held, rows, batch = [], 0, batch.slice(change[0])
            held.append(batch)
            rows += batch.num_rows
        if rows:
            yield edges(held)

    buckets = shared.join(drawn, "c1").select("sig", "c1", "n", "sketch").repartition("sig").sortWithinPartitions("sig", "c1")
    chained = buckets.mapInArrow(chain, "a long, b long").union(whole).distinct()
    families = scratch.write(components(chained, scratch, "families"), "families")
    members = classes.join(families.select(F.col("node").alias("c1"), F.col("label").alias("family")), "c1")
    members = scratch.write(members.select("node", "family", "n"), "members")

    slots = 1 << 22
    wanted = np.zeros(slots // 8, np.uint8)  # a bitmap of fixed size that spares most other texts the way to the join
    found = members.select(F.pmod(F.xxhash64("node"), F.lit(slots)).cast("int").alias("slot")).distinct().toArrow()["slot"].to_numpy()
    np.bitwise_or.at(wanted, found >> 3, (1 << (found & 7)).astype(np.uint8))
    sent = spark.sparkContext.broadcast(wanted)

    def sets_of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            slot = batch.column(2).to_numpy()
            picked = pa.array(sent.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0)
            batch = batch.filter(picked)
            for a, b, rows, values in _sets(batch.column(1), words):
                ends = np.searchsorted(rows, np.arange(b - a + 1))
                data = [values[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)]
                _, one, two = set_hashes(rows, values, b - a)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(data, pa.binary()), pa.array(one), pa.array(two)], names=["node", "shingles", "c1", "c2"])

    some = texts.where("doc_id is not null").select(F.col("doc_id"), "text", F.pmod(F.xxhash64("doc_id"), F.lit(slots)).cast("int").alias("slot"))
    sets = some.mapInArrow(sets_of, "node long, shingles binary, c1 long, c2 long").select("node", "shingles")

    # Families in blocks of bounded size, dealt by hash: no task sees a whole family.
    parts = members.groupBy("family").agg(F.ceil(F.greatest(F.count("*") / block_rows, F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("parts"), F.count("*").alias("rows"))
    blocks = join_counted(members, scratch.write(parts, "parts"), ["family"], "rows")
    blocks = scratch.write(blocks.select("node", "family", F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).alias("block")), "blocks")
    task = F.xxhash64("family", "block")
    first = scratch.write(_verify(sets.join(blocks, "node").select(task.alias("task"), "node", F.lit(True).alias("asks"), "shingles"), num, den).where("a <> b"), "links-1")
    links = first
    large = blocks.groupBy("family").agg(F.max("block").alias("last")).where("last > 0")
    if large.head(1):
        wide = scratch.write(sets.join(blocks.join(large, "family"), "node"), "wide")
        picked = wide.withColumn("r", F.row_number().over(Window.partitionBy("family", "block").orderBy(F.xxhash64("node")))).where(F.col("r") <= connectors)
        links = links.union(scratch.write(_verify(picked.select(F.xxhash64("family", F.floor(F.col("block") / 32)).alias("task"), "node", F.lit(True).alias("asks"), "shingles"), num, den).where("a <> b"), "links-2"))
        so_far = scratch.write(components(links, scratch, "so-far"), "so-far")
        labelled = wide.select("node", "family", "block").join(so_far, "node", "left").withColumn("label", F.coalesce("label", "node"))
        counts = labelled.groupBy("family", "label").count()
        top = counts.groupBy("family").agg(F.max_by("label", F.struct("count", -F.col("label"))).alias("top"))
        asking = labelled.join(top, "family").where("label <> top").select("node", "family", F.col("block").alias("from_block"))
        asking = scratch.write(asking, "asking")
        pairs = asking.select("family", "from_block").distinct().join(wide.select("family", "block").distinct(), "family")
        ask = asking.join(pairs, ["family", "from_block"]).select("family", "from_block", "block", "node", F.lit(True).alias("asks"))
        answer = wide.select("family", "block", "node").join(pairs, ["family", "block"]).where("block <> from_block").select("family", "from_block", "block", "node", F.lit(False).alias("asks"))
        tasks = ask.where("block <> from_block").union(answer).join(wide.select("node", "shingles"), "node").select(F.xxhash64("family", "from_block", "block").alias("task"), "node", "asks", "shingles")
        links = links.union(scratch.write(_verify(tasks, num, den).where("a <> b"), "links-3"))
    labels = components(links, scratch, "components")
    rooted = classes.select("c1", "c2", "node", "copies").join(labels, "node", "left").select("c1", "c2", "copies", F.coalesce("label", "node").alias("component_id"))
    rows = described.where("doc_id is not null and n > 0").select("doc_id", F.col("n").alias("n_shingles"), "c1", "c2")
    found = join_counted(rows, scratch.write(rooted, "rooted"), ["c1", "c2"], "copies").select("doc_id", "n_shingles", "component_id")
    rest = described.where("doc_id is null or n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.union(rest)


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs, with all their columns: of each group of linked texts the one with the smallest id stays.

    Each id and text is a node of its own, so rows of one id only go when their texts link or are equal; of such rows the
    one with the smallest hash of id and text stays. Rows with a null id, which are in no group, stay.
    """
    node, own, head, place, word, bits = fresh(docs.columns, "node", "own", "head", "place", "word", "bits")
    scratch = Scratch(docs.sparkSession, "keep")
    number = whole_id(docs, id_col)
    keyed = docs.where(F.col(f"`{id_col}`").isNotNull()).withColumn(node, F.xxhash64(number, F.col(f"`{text_col}`")))
    found = near_duplicates(keyed, id_col=node, text_col=text_col, words=words, num=num, den=den)
    found = scratch.write(found.groupBy(F.col("doc_id").alias(node), F.col("component_id").alias(head)).agg(F.count("*").alias("n")), "found")
    ids = keyed.select(node, number.alias(own)).distinct()
    heads = found.join(ids, node).groupBy(head).agg(F.min(F.struct(own, node)).alias(place)).select(F.col(place)[node].alias(node))
    heads = scratch.write(heads, "heads")
    # Most rows are alone in their group and stay where they are; a bitmap of fixed size, as rows of 64 places, tells those that may go.
    some = found.join(heads, node, "left_anti").select(node).union(found.where("n > 1").select(node))
    slot = F.pmod(F.xxhash64(node), F.lit(SLOTS))
    marked = some.select(slot.alias(place)).groupBy(F.shiftright(place, 6).alias(word)).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(`{place}` % 64 AS int))")).alias(bits))
    asked = keyed.withColumn(word, F.shiftright(slot, 6)).join(F.broadcast(scratch.write(marked, "marked")), word, "left")
    may_go = F.coalesce(F.getbit(F.col(bits), (slot % 64).cast("int")) == 1, F.lit(False))
    first = Window.partitionBy(node).orderBy(node)
    kept = asked.where(may_go).join(heads.hint("merge"), node).withColumn(place, F.row_number().over(first)).where(F.col(place) == 1)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns).union(asked.where(~may_go).select(*columns)).union(docs.where(F.col(f"`{id_col}`").isNull()).select(*columns))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

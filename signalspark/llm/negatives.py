"""Operator 13, hard-negative mining with angular triangle filtering.

Scores are inner products of the vectors ``floor(256 x)``. ``build_index`` stores, for
every row, its norm and its angles to ``DIRECTIONS`` fixed directions, in blocks of up
to ``BLOCK`` rows that lie close to one direction. For an anchor at angle a and a row
at angle t to the same direction, the angle between them is at least ``|a - t|`` and at
most ``min(a + t, 2 pi - a - t)`` (the triangle inequality on the sphere), so each
direction gives an interval for the cosine; the intersection of all, times the norms
and widened by what the doubles may round, bounds the score. Whole blocks are judged
first, then rows; only rows whose interval overlaps a window that is still open are
scored, exactly.

Two passes over the blocks, each joined with the anchors in blocks. The first finds an
anchor's positives: its window reaches up from the worst of the best ``positives`` rows
so far. The second finds the negatives: a positive of score p has the window from
``low`` p to ``high`` p (hundredths), whose lower end rises to the worst of its best
``negatives`` rows so far. A task returns the best of what it met, a window ranks them.
The score decides, then the smaller id; rows with equal vectors are ranked like any
others. No row is left out for lack of room: a bound only drops rows that cannot win.

Edge cases: rows with a null id, label or vector, or a null or non-finite component
take no part; equal rows (id, label and vector) count once; rows with an anchor's own
id are neither its positives nor its negatives; an id with several vectors or labels is
that many rows; vectors meet vectors of their own length only (an empty one scores 0);
zero vectors score 0; a score beyond 64 bits counts as the nearest 64-bit integer, and
a component whose 256-fold is no finite double as not finite; an anchor without
positives, and an empty table, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalspark.llm.neighbours import _matrix
from signalspark.session import checkpoint_table

DIRECTIONS = 12
SEED = 13_013
#: rows of one block, of the index and of anchors
BLOCK, ANCHORS = 2048, 256
#: groups that index blocks are dealt to; every anchor block goes to each
GROUPS = 48
EXACT = float(1 << 53)
TOP = (1 << 63) - 1


def directions(dim: int) -> np.ndarray:
    """Fixed unit directions of one length."""
    x = np.random.default_rng([SEED, dim]).normal(size=(DIRECTIONS, dim))
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300)


def measures(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norms, angles to the directions); a zero vector has angle 0 to all, which its norm makes harmless."""
    scale = np.abs(x).max(1, initial=0)
    unit = x / np.where(scale > 0, scale, 1)[:, None]
    size = np.sqrt((unit * unit).sum(1))
    cosine = (unit @ directions(x.shape[1]).T) / np.where(size > 0, size, 1)[:, None]
    return size * scale, np.where(size[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0)


def slack(dim: int) -> float:
    """What an angle computed in doubles may be off: the arc cosine turns an error e near 1 into sqrt(2 e)."""
    return 4 * float(np.sqrt((dim + 16) * 2.0 ** -52))


def scores(x: np.ndarray, anchor: np.ndarray, size: float) -> np.ndarray:
    """Integer inner products; ``size`` bounds the product of the norms.

    Doubles are exact while every partial sum is below 2^53; beyond that integers of any
    size are added and the sum is cut to 64 bits.
    """
    if size < EXACT / 2:
        return (x @ anchor).astype(np.int64)
    a = [int(v) for v in anchor.tolist()]
    return np.array([max(-TOP, min(TOP, sum(int(v) * w for v, w in zip(row, a)))) for row in x.tolist()], np.int64)


class Block:
    """Many vectors of one length, with their norms and angles."""

    def __init__(self, dim: int, ids: bytes, labels: bytes, vectors: bytes, norms: bytes, angles: bytes):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.vectors = np.frombuffer(vectors).reshape(len(self.ids), dim)
        self.norms, self.angles = np.frombuffer(norms), np.frombuffer(angles).reshape(len(self.ids), DIRECTIONS)
        self.low, self.high = self.angles.min(0, keepdims=True), self.angles.max(0, keepdims=True)
        self.least, self.most = self.norms.min(keepdims=True), self.norms.max(keepdims=True)
        self.slack = slack(dim)

    def _bounds(self, norm: float, angles: np.ndarray, low, high, least, most) -> tuple[np.ndarray, np.ndarray]:
        nearest = np.maximum(np.maximum(low - angles, angles - high), 0).max(1)
        farthest = np.where(angles + low > np.pi, 2 * np.pi - angles - low, np.minimum(angles + high, np.pi)).min(1)
        upper = np.cos(np.clip(nearest - self.slack, 0, np.pi))
        lower = np.cos(np.clip(farthest + self.slack, 0, np.pi))
        with np.errstate(over="ignore", invalid="ignore"):  # norms whose product is no double bound nothing
            room = 1e-9 * norm * most + 1
            lo = norm * np.where(lower < 0, most, least) * lower - room
            hi = norm * np.where(upper < 0, least, most) * upper + room
        # no further than the scores themselves are cut
        return np.nan_to_num(np.clip(lo, -TOP, TOP), nan=-TOP), np.nan_to_num(np.clip(hi, -TOP, TOP), nan=TOP)

    def whole(self, norm: float, angles: np.ndarray) -> tuple[float, float]:
        """Least and largest score that any row of the block can have with an anchor."""
        lo, hi = self._bounds(norm, angles, self.low, self.high, self.least, self.most)
        return float(lo[0]), float(hi[0])

    def rows(self, norm: float, angles: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for each of the rows ``at``."""
        t = self.angles[at]
        return self._bounds(norm, angles, t, t, self.norms[at], self.norms[at])


def _usable(rows: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * F.lit(256.0)) < float("inf")))
    return (rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("vector"),
                        finite.alias("finite"))
            .filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND finite").drop("finite").distinct())


def _measured(rows: DataFrame) -> DataFrame:
    """``id, label, dim``, the scaled vector, its norm and angles, and the nearest direction."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("id", "label"))
            for at, raw in _matrix(batch.column("vector")):
                x = np.floor(256 * raw)
                norms, angles = measures(x)
                near = angles.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(labels[at]), pa.array(np.full(len(at), x.shape[1], np.int32)),
                     pa.array([v.tobytes() for v in x], pa.binary()), pa.array(norms),
                     pa.array([v.tobytes() for v in angles], pa.binary()), pa.array(near.astype(np.int32)),
                     pa.array(angles[np.arange(len(at)), near])],
                    names=["id", "label", "dim", "vector", "norm", "angles", "near", "angle"])

    return rows.select("id", "label", "vector").mapInArrow(
        measure, "id bigint, label bigint, dim int, vector binary, norm double, angles binary, near int, angle double")


def _packed(size: int, columns: list[str]):
    """Consecutive rows of one length as packed rows of at most ``size``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            dim, longs, norms, vectors, angles = rows[0][0], *([r[i] for r in rows] for i in (1, 2, 3, 4))
            packed = {"dim": pa.array([dim], pa.int32()), "n": pa.array([len(rows)], pa.int32())}
            numbers = np.array(longs, np.int64).T
            for c, column in zip(columns, numbers):
                packed[c] = pa.array([np.ascontiguousarray(column).tobytes()], pa.binary())
            for c, values in (("vectors", vectors), ("angles", angles)):
                packed[c] = pa.array([b"".join(values)], pa.binary())
            packed["norms"] = pa.array([np.array(norms).tobytes()], pa.binary())
            rows.clear()
            return pa.RecordBatch.from_pydict(packed)

        for batch in batches:
            read = {c: batch.column(c).to_pylist() for c in ("dim", "norm", "vector", "angles", *columns)}
            for i in range(batch.num_rows):
                if rows and (read["dim"][i] != rows[0][0] or len(rows) == size):
                    yield flush()
                rows.append((read["dim"][i], [read[c][i] for c in columns], read["norm"][i], read["vector"][i],
                             read["angles"][i]))
        if rows:
            yield flush()

    names = ", ".join(f"{c} binary" for c in (*columns, "vectors", "angles", "norms"))
    return pack, f"dim int, n int, {names}"


def build_index(rows: DataFrame) -> DataFrame:
    """Blocks of rows that lie close together, dealt to ``GROUPS`` parts; written once."""
    near = ["dim", "near", "angle", "id"]  # the id splits a crowd of equal vectors
    pack, schema = _packed(BLOCK, ["id", "label"])
    blocks = _measured(rows).repartitionByRange(*near).sortWithinPartitions(*near).mapInArrow(pack, schema)
    return checkpoint_table(blocks.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(GROUPS))), "negatives-index")


def _met(index: DataFrame, anchors: DataFrame, columns: list[str]) -> DataFrame:
    """Every block of the index with every block of anchors of its length."""
    pack, schema = _packed(ANCHORS, columns)
    blocks = anchors.sortWithinPartitions("dim").mapInArrow(pack, schema)
    dealt = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(GROUPS - 1).cast("long"))).alias("part"),
                          "dim", *[F.col(c).alias(f"a_{c}") for c in (*columns, "vectors", "angles", "norms")])
    return index.join(dealt, ["part", "dim"])


def _pairs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[Block, np.ndarray, np.ndarray, float, list[int]]]:
    """(block, anchor vector, its angles, its norm, its numbers) of each block and anchor that met."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
            block = Block(row["dim"], row["id"], row["label"], row["vectors"], row["norms"], row["angles"])
            norms = np.frombuffer(row["a_norms"])
            numbers = np.array([np.frombuffer(row[f"a_{c}"], np.int64) for c in columns]).T.tolist()
            vectors = np.frombuffer(row["a_vectors"]).reshape(len(norms), row["dim"])
            angles = np.frombuffer(row["a_angles"]).reshape(len(norms), DIRECTIONS)
            for i in range(len(norms)):
                yield block, vectors[i], angles[i], float(norms[i]), numbers[i]


def _merged(best: list[tuple[int, int]], score: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The best ``k`` of (-score, id) pairs."""
    if len(score) > k:
        top = np.lexsort((ids, -score))[:k]
        score, ids = score[top], ids[top]
    return sorted(best + list(zip((-score).tolist(), ids.tolist())))[:k]


#: anchors whose best a task holds before it hands them on
HELD = 20_000
_ANCHOR = ["anchor_key", "id", "label"]


def find_positives(index: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """``anchor_key, anchor_id, label, place, vec_id, score``: the best ``k`` other rows of each anchor's label."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, list[tuple[int, int]]] = {}

        def flush() -> pa.RecordBatch:
            rows = [(*a, i, -s) for a, found in best.items() for s, i in found]
            best.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(5)],
                                              names=["anchor_key", "anchor_id", "label", "vec_id", "score"])

        for block, vector, angles, norm, numbers in _pairs(batches, _ANCHOR):
            if len(best) >= HELD:
                yield flush()
            found = best.setdefault(tuple(numbers), [])
            floor = -found[-1][0] if len(found) == k else -np.inf
            if block.whole(norm, angles)[1] < floor:
                continue
            at = np.flatnonzero((block.labels == numbers[2]) & (block.ids != numbers[1]))
            lo, hi = block.rows(norm, angles, at)
            if len(at) > k:  # k rows score at least the k-th largest lower bound
                floor = max(floor, np.partition(lo, len(lo) - k)[len(lo) - k])
            at = at[hi >= floor]
            if len(at):
                score = scores(block.vectors[at], vector, norm * float(block.most[0]))
                best[tuple(numbers)] = _merged(found, score, block.ids[at], k)
        yield flush()

    rows = _met(index, anchors, _ANCHOR).mapInArrow(
        nearest, "anchor_key bigint, anchor_id bigint, label bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("anchor_key", "anchor_id", "label").orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def find_negatives(index: DataFrame, anchors: DataFrame, n_positives: int, k: int, low: int, high: int) -> DataFrame:
    """Best ``k`` rows of another label in the window of each positive; ``anchors`` carry ``pos<i>`` and ``top<i>``."""
    sought = [f"{c}{i}" for i in range(1, n_positives + 1) for c in ("pos", "top")]
    columns = _ANCHOR + ["held"] + sought

    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, list] = {}  # of each anchor: [least, largest, best] of each positive's window

        def flush() -> pa.RecordBatch:
            rows = [(a[0], a[1], p + 1, a[4 + 2 * p], a[5 + 2 * p], i, -s)
                    for a, windows in best.items() for p, w in enumerate(windows) for s, i in w[2]]
            best.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], pa.int64()) for c in range(7)],
                names=["anchor_key", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"])

        for block, vector, angles, norm, numbers in _pairs(batches, columns):
            if len(best) >= HELD:
                yield flush()
            windows = best.get(tuple(numbers))
            if windows is None:
                tops = [numbers[5 + 2 * p] for p in range(numbers[3])]
                windows = best[tuple(numbers)] = [[-(-low * t // 100), high * t // 100, []] for t in tops]
            lo, hi = block.whole(norm, angles)
            open_ = [w for w in windows if w[0] <= w[1] and lo <= w[1] and hi >= w[0]]
            if not open_:
                continue
            at = np.flatnonzero((block.labels != numbers[2]) & (block.ids != numbers[1]))
            lo, hi = block.rows(norm, angles, at)
            overlaps = np.zeros(len(at), bool)
            for w in open_:
                overlaps |= (lo <= w[1]) & (hi >= w[0])
            at = at[overlaps]
            if not len(at):
                continue
            score, ids = scores(block.vectors[at], vector, norm * float(block.most[0])), block.ids[at]
            for w in open_:
                inside = (score >= w[0]) & (score <= w[1])
                if inside.any():
                    w[2] = _merged(w[2], score[inside], ids[inside], k)
                    if len(w[2]) == k:
                        w[0] = max(w[0], -w[2][-1][0])
        yield flush()

    rows = _met(index, anchors, columns).mapInArrow(
        mined, "anchor_key bigint, anchor_id bigint, place bigint, positive_id bigint, positive_score bigint, "
               "negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor_key", "anchor_id", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of all anchors.

    ``is_anchor`` is a condition on the column ``id``; ``low`` and ``high`` are hundredths of
    the positive's score.
    """
    rows = checkpoint_table(_usable(vectors, key, vector, F.col("label") if label is None else label), "negatives-rows")
    index = build_index(rows)
    chosen = rows.filter(is_anchor)
    anchors = checkpoint_table(
        _measured(chosen).withColumn("anchor_key", F.xxhash64("id", "label", "vector")), "negatives-anchors")
    found = checkpoint_table(find_positives(index, anchors, positives), "negatives-positives")
    columns = [F.count(F.lit(1)).alias("held")]
    for p in range(1, positives + 1):
        here = F.col("place") == p
        columns += [F.coalesce(F.max(F.when(here, F.col("vec_id"))), F.lit(0)).alias(f"pos{p}"),
                    F.coalesce(F.max(F.when(here, F.col("score"))), F.lit(0)).alias(f"top{p}")]
    per_anchor = found.groupBy("anchor_key", F.col("anchor_id").alias("id"), "label").agg(*columns)
    mined = find_negatives(index, anchors.join(per_anchor, ["anchor_key", "id", "label"]), positives, negatives, low, high)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

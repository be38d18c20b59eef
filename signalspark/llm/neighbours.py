"""Operator 4, approximate nearest neighbours by multiprobe p-stable hashing.

``TABLES`` tables hash a vector by ``PROJECTIONS`` Gaussian projections, each cut
into cells of one width. A query visits, in every table, its own bucket and
``PROBES`` perturbed ones, in the order of the estimated chance that a neighbour
lies there: the squared distances of the query to the cell borders it crosses,
smallest sum first. Candidates of all tables merge by exact Euclidean distance in
double precision, ties to the smaller id.

The cell width is ``WIDTH`` times the median distance in a bounded sample of
``SAMPLE`` vectors; every vector is indexed. Buckets travel as packed chunks of
vectors and of probing queries, joined by bucket in a merge join (nothing that grows with
the queries is broadcast), so a bucket that holds a third of all vectors is many rows that
Spark may split; a task keeps only the best ``k`` of each query it meets. Equal vectors are indexed once with their ``k + 1`` smallest
ids, which loses nothing because ties go to the smaller id. Queries that find fewer
than ``k`` candidates are searched against all vectors, in blocks.

Measured recall at 10 against brute force: 0.97 and more on the given tables
(tests hold 0.9).

Edge cases: vectors that are null, empty, all zero, or hold a null or non-finite
component take no part; vectors are compared with vectors of their own length;
repeated rows count once; an id with several vectors counts with its nearest;
null ids take no part; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalspark.llm.common import hashed_sample
from signalspark.llm.grams import mix
from signalspark.session import checkpoint_table

TABLES, PROJECTIONS, PROBES = 8, 6, 40
WIDTH = 1.42
SAMPLE = 512
SEED = 4_004
#: vectors or queries of one packed row
CHUNK = 2048
#: blocks of the exact search
BLOCKS = 48
PACKED = "bucket long, ids binary, counts binary, vectors binary, dim int"
FOUND = "query_id long, vec_id long, score double"


def usable(vector: str) -> Column:
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def _matrix(col: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each vector length in a list column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    sizes = pa.compute.list_value_length(col).to_numpy(zero_copy_only=False)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    out = []
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        out.append((rows, flat[(ends[rows] - n)[:, None] + np.arange(n)[None, :]]))
    return out


def _project(x: np.ndarray, table: int, width: float) -> np.ndarray:
    rng = np.random.default_rng([SEED, table, x.shape[1]])
    return x @ rng.normal(size=(x.shape[1], PROJECTIONS)) / width + rng.uniform(size=PROJECTIONS)


def _bucket(cells: np.ndarray, table: int, dim: int) -> np.ndarray:
    h = np.full(len(cells), (table << 32) + dim, np.uint64)
    for j in range(cells.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + cells[:, j].astype(np.int64).view(np.uint64))
    return h.view(np.int64)


def probe_order(inside: np.ndarray, probes: int) -> list[list[tuple[int, int]]]:
    """Perturbations (coordinate, step) of a query at ``inside`` its cell, likeliest first, itself excluded."""
    moves = sorted([(f * f, i, -1) for i, f in enumerate(inside)] + [((1 - f) ** 2, i, 1) for i, f in enumerate(inside)])
    out, heap = [], [(moves[0][0], (0,))]
    while heap and len(out) < probes:
        cost, chosen = heapq.heappop(heap)
        if len({moves[c][1] for c in chosen}) == len(chosen):
            out.append([moves[c][1:] for c in chosen])
        last = chosen[-1] + 1
        if last < len(moves):  # replace the last move by the next one, or add the next one
            heapq.heappush(heap, (cost - moves[last - 1][0] + moves[last][0], (*chosen[:-1], last)))
            heapq.heappush(heap, (cost + moves[last][0], (*chosen, last)))
    return out


_SCHEMA = pa.schema([("bucket", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary()),
                     ("vectors", pa.binary()), ("dim", pa.int32())])


def _flat(buckets: np.ndarray, which: np.ndarray, ids: list[list[int]], x: np.ndarray, kind: str) -> Iterator[pa.RecordBatch]:
    """One row for each vector and bucket, with components of ``kind``."""
    names = [np.array(i, np.int64).tobytes() for i in ids]
    counts = [np.array([len(i)], np.int32).tobytes() for i in ids]
    vectors = [v.tobytes() for v in x.astype(kind)]
    for i in range(0, len(buckets), 4096):
        some = which[i:i + 4096].tolist()
        yield pa.RecordBatch.from_arrays([
            pa.array(buckets[i:i + 4096]), pa.array([names[w] for w in some], pa.binary()),
            pa.array([counts[w] for w in some], pa.binary()), pa.array([vectors[w] for w in some], pa.binary()),
            pa.array([x.shape[1]] * len(some), pa.int32())], schema=_SCHEMA)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and length, packed into chunks."""
    key, rows = None, []

    def flush() -> pa.RecordBatch:
        parts = [b"".join(column) for column in zip(*rows)]
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([key[0], *parts, key[1]], _SCHEMA)],
                                          schema=_SCHEMA)

    for batch in batches:
        for bucket, *row, dim in zip(*(batch.column(c).to_pylist() for c in range(5))):
            if rows and ((bucket, dim) != key or len(rows) == CHUNK):
                yield flush()
            key = (bucket, dim)
            rows.append(row)
    if rows:
        yield flush()


def _hashed(vectors: DataFrame, width: float, probes: int | None, kind: str, blocks: int = 0) -> DataFrame:
    """Packed rows by bucket: of the index (``probes`` None) or of probing queries.

    With ``blocks`` the buckets are that many blocks: a vector is in one, a query in all.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids = batch.column("ids").to_pylist()
            for at, x in _matrix(batch.column("vector")):
                ids, dim = [all_ids[i] for i in at], x.shape[1]
                found, which = [], []
                if blocks:
                    own = np.arange(len(x))
                    block = mix(np.array([i[0] for i in ids], np.int64).view(np.uint64)) % np.uint64(blocks)
                    for b in range(blocks) if probes is not None else [None]:
                        cells = (block if b is None else np.full(len(x), b, np.uint64)).astype(np.int64)
                        found.append(_bucket(cells[:, None], TABLES, dim))
                        which.append(own)
                for t in range(0 if blocks else TABLES):
                    y = _project(x, t, width)
                    cells = np.floor(y).astype(np.int64)
                    found.append(_bucket(cells, t, dim))
                    which.append(np.arange(len(x)))
                    if probes is None:
                        continue
                    steps = []
                    for i, inside in enumerate(y - cells):
                        for moves in probe_order(inside, probes):
                            cell = cells[i].copy()
                            for j, s in moves:
                                cell[j] += s
                            steps.append(cell)
                            which.append(np.array([i]))
                    if steps:
                        found.append(_bucket(np.array(steps), t, dim))
                yield from _flat(np.concatenate(found), np.concatenate(which), ids, x, kind)

    # dealt by bucket and id, so that a large bucket spans tasks and a small one is one chunk
    return (vectors.select("ids", "vector").mapInArrow(rows, PACKED).repartitionByRange("bucket", "ids")
            .sortWithinPartitions("bucket", "dim").mapInArrow(_packed, PACKED))


def _search(index: DataFrame, queries: DataFrame, k: int, kind: str) -> DataFrame:
    """Best ``k`` of each query in the buckets it shares, per task."""
    names = ("bucket", "q_ids", "q_counts", "q_vectors", "q_dim")
    # Spark takes a probing query's rows for as large as the query alone, and would send all probes through the driver
    pairs = index.join(queries.toDF(*names).hint("merge"), "bucket").filter("dim = q_dim")

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, dict[int, float]] = {}

        def flush() -> pa.RecordBatch:
            got = [(q, v, d) for q, found in best.items() for v, d in found.items()]
            best.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([g[2] for g in got], pa.float64())], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for ids, counts, raw, dim, q_ids, q_raw in zip(*(batch.column(c).to_pylist() for c in range(6))):
                x = np.frombuffer(raw, kind).reshape(-1, dim).astype(np.float64)
                ids, counts = np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int32)
                first = np.cumsum(counts) - counts
                queries_here, qx = np.frombuffer(q_ids, np.int64), np.frombuffer(q_raw, kind).reshape(-1, dim).astype(np.float64)
                size = (x * x).sum(1)
                for i in range(0, len(qx), 256):
                    some = qx[i:i + 256]
                    rough = size[None, :] - 2 * some @ x.T  # squared distance less the query's own size
                    take = min(k + 1, rough.shape[1])
                    limit = np.partition(rough, take - 1, axis=1)[:, take - 1]
                    slack = 1e-9 * (size.max() + (some * some).sum(1) + 1e-300)
                    for j, q in enumerate(queries_here[i:i + 256].tolist()):
                        near = np.flatnonzero(rough[j] <= limit[j] + slack[j])
                        exact = np.sqrt(((x[near] - some[j]) ** 2).sum(1))
                        kept = best.setdefault(q, {})
                        for n, d in zip(near.tolist(), exact.tolist()):
                            for v in ids[first[n]:first[n] + counts[n]].tolist():
                                if v != q and d < kept.get(v, np.inf):
                                    kept[v] = d
                        if len(kept) > 8 * k:
                            best[q] = dict(sorted(kept.items(), key=lambda e: (e[1], e[0]))[:k])
                if len(best) > 20_000:
                    yield flush()
            for q, kept in best.items():
                if len(kept) > k:
                    best[q] = dict(sorted(kept.items(), key=lambda e: (e[1], e[0]))[:k])
        yield flush()

    return pairs.select("ids", "counts", "vectors", "dim", "q_ids", "q_vectors").mapInArrow(nearest, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def search(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           probes: int = PROBES) -> DataFrame:
    """The ``k`` nearest found of every row that ``is_query`` selects, the row itself excluded."""
    rows = (vectors.filter(F.col(key).isNotNull() & usable(vector))
            .select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
                    is_query.alias("is_query")).distinct())
    smallest = Window.partitionBy("vector").orderBy("id")
    index = (rows.select("id", "vector").distinct().withColumn("_n", F.row_number().over(smallest))
             .filter(F.col("_n") <= k + 1).groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    queries = rows.filter("is_query").select(F.array("id").alias("ids"), "vector")
    picked = hashed_sample(rows.select("id").distinct(), "id", SAMPLE, SEED)
    sample = rows.join(picked, "id").groupBy("id").agg(F.min("vector").alias("vector")).select("vector").collect()
    width = WIDTH * median_distance([r.vector for r in sample])
    # floats travel as such: half the bytes, and the same doubles where they are compared
    kind = "f4" if vectors.select(vector).dtypes[0][1] == "array<float>" else "f8"
    found = checkpoint_table(_search(_hashed(index, width, None, kind), _hashed(queries, width, probes, kind), k, kind), "ann-found")
    enough = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")).filter(F.col("n") >= k)
    short = queries.join(enough.select(F.array("query_id").alias("ids")), "ids", "left_anti")
    blocks = max(1, BLOCKS)
    rest = _search(_hashed(index, width, None, kind, blocks), _hashed(short, width, 0, kind, blocks), k, kind)
    return _ranked(found.unionByName(rest), k)


def median_distance(vectors: list[list[float]]) -> float:
    """Median distance over pairs of equal length in a sample; 1 without such pairs."""
    by_size: dict[int, list] = {}
    for v in vectors:
        by_size.setdefault(len(v), []).append(v)
    x = np.array(max(by_size.values(), key=len)) if by_size else np.zeros((0, 1))
    d = np.concatenate([np.zeros(0), *(np.sqrt(((x[i + 1:] - v) ** 2).sum(1)) for i, v in enumerate(x))])
    d = d[d > 0]
    return float(np.median(d)) if len(d) else 1.0

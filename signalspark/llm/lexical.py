"""Operator 11, ranked lexical search by accumulator-limited term-at-a-time scoring.

``build_index`` cuts the documents, where they lie, into segments of about
``SEGMENT_BYTES`` of text. A segment is one row: its sorted terms, the postings of
each (document number and frequency, packed), and each document's length. Nothing is
shuffled, and the segments of any number of documents are independent rows.

``search`` takes the items in blocks of about ``QUERY_BYTES`` of distinct text, the
only data that travels to every task. For a block it counts the document frequencies
from the segments' term columns alone, then scores every segment term at a time,
rarest first. A term's contributions are exact, so the largest one bounds what the
term can still add to any document of the segment. Once the bounds of the terms that
remain add up to less than the ``k``-th best score so far, no further document can
reach the result: no accumulators are created from then on, those that cannot reach
that score go, and the survivors are updated exactly with the remaining terms. The
``k``-th best score carries over to the next segment of the task. Tasks return the
best ``k`` of each item; two rounds of ranking merge them, so no task meets the
results of all segments of an item.

A document that is dropped could only have scored strictly less than ``k`` others,
hence results, ties included, are those of scoring every document.

Edge cases: a null text has no terms, neither in items nor in documents; a null or
repeated ``doc_id`` is a document of its own, nulls last among equal scores; items
with equal texts are searched once and each gets the result; items without terms and
empty tables give no rows; a document of any length is one segment or part of one;
other columns of both tables are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalspark.llm.common import utf8
from signalspark.session import checkpoint_table

SEGMENT_BYTES, SEGMENT_DOCS = 4 << 20, 1 << 16
QUERY_BYTES = 4 << 20
#: groups of the first merging round
SALTS = 16

_LOWER = bytes(range(0x41, 0x5B))
#: separators become spaces, A-Z lower case, all else stays
_FOLD = bytes(b if chr(b).isdigit() or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if b in _LOWER else 32
              for b in range(256))

SEGMENT = ("ids array<bigint>, lengths array<int>, terms array<binary>, df array<int>, docs binary, tfs binary, "
           "with_terms bigint, total bigint")
FOUND = "query string, doc_id bigint, score bigint"


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of digits, letters (A-Z lowered) and bytes from 0x80 on."""
    return text.translate(_FOLD).split()


def _segment(ids: list, words: list[list[bytes]]) -> pa.RecordBatch:
    lengths = np.array([len(w) for w in words], np.int32)
    flat = pa.array([t for w in words for t in w], pa.binary()).dictionary_encode()
    order = pc.sort_indices(flat.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    codes = place[flat.indices.to_numpy()] if len(flat) else np.empty(0, np.int64)
    keys, tf = np.unique(codes * SEGMENT_DOCS + np.repeat(np.arange(len(words)), lengths), return_counts=True)
    df = np.bincount(keys // SEGMENT_DOCS, minlength=len(order)).astype(np.int32)
    values = [pa.array([x]) for x in (int((lengths > 0).sum()), int(lengths.sum()))]

    def one(x) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)

    return pa.RecordBatch.from_arrays(
        [one(pa.array(ids, pa.int64())), one(pa.array(lengths)), one(flat.dictionary.take(pa.array(order))),
         one(pa.array(df)), pa.array([(keys % SEGMENT_DOCS).astype(np.uint16).tobytes()], pa.binary()),
         pa.array([tf.astype(np.int32).tobytes()], pa.binary()), *values],
        names=["ids", "lengths", "terms", "df", "docs", "tfs", "with_terms", "total"])


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per segment of documents, written once as Parquet."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, size = [], [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                for doc, body in zip(part.column(0).to_pylist(), utf8(part.column(1))):
                    if ids and (size + len(body) > SEGMENT_BYTES or len(ids) == SEGMENT_DOCS):
                        yield _segment(ids, words)
                        ids, words, size = [], [], 0
                    ids.append(doc)
                    words.append(terms_of(body))
                    size += len(body)
        if ids:
            yield _segment(ids, words)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return checkpoint_table(rows.mapInArrow(segments, SEGMENT), "lexical-index")


def _row(batch: pa.RecordBatch, name: str, r: int) -> pa.Array:
    return batch.column(name)[r].values


def document_frequencies(index: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """Documents that hold each of ``terms``; reads the segments' dictionaries, not their postings."""
    asked = pa.array(terms, pa.binary())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(asked), np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                at = pc.index_in(asked, value_set=_row(batch, "terms", r))
                found = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                total[found] += _row(batch, "df", r).to_numpy()[at.drop_null().to_numpy()]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["t", "n"])

    rows = index.select("terms", "df").mapInArrow(counted, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n"))
    return {terms[r.t]: r.n for r in rows.collect()}


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Segment:
    """One index row and the exact contributions (without weights) of the asked terms."""

    def __init__(self, batch: pa.RecordBatch, r: int, asked: pa.Array, n_docs: int, total: int):
        ids = _row(batch, "ids", r)
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        lengths = _row(batch, "lengths", r).to_numpy().astype(np.int64)
        self.m = 25 + (75 * n_docs * lengths) // max(total, 1)
        self.at = pc.index_in(asked, value_set=_row(batch, "terms", r)).fill_null(-1).to_numpy()
        self.ends = np.cumsum(_row(batch, "df", r).to_numpy(), dtype=np.int64)
        self.docs = np.frombuffer(batch.column("docs")[r].as_py(), np.uint16)
        self.tfs = np.frombuffer(batch.column("tfs")[r].as_py(), np.int32)
        self.cache: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray, int] | None:
        """(documents, contribution of weight 1 to each, the largest one) of an asked term, None if absent."""
        at = self.at[term]
        if at < 0:
            return None
        if term not in self.cache:
            lo, hi = self.ends[at - 1] if at else 0, self.ends[at]
            docs, tf = self.docs[lo:hi].astype(np.int64), self.tfs[lo:hi].astype(np.int64)
            gain = (1_000_000_000 * tf) // (1000 * tf + 8 * self.m[docs])
            self.cache[term] = docs, gain, int(gain.max())
        return self.cache[term]


def score_segment(seg: Segment, terms: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the segment that may be among the best ``k``, given that ``k`` others have ``floor``.

    ``terms`` are (asked term, weight times repeats), rarest first.
    """
    found = [(p, w) for t, w in terms if w and (p := seg.postings(t)) is not None]
    left = np.zeros(len(found) + 1, np.int64)  # what the terms from the i-th on can add at most
    left[:-1] = np.cumsum([w * p[2] for p, w in reversed(found)])[::-1] if found else 0
    score = np.zeros(len(seg.ids), np.int64)
    kth, i = floor, 0
    while i < len(found) and left[i] >= kth:
        (docs, gain, _), w = found[i]
        score[docs] += w * gain
        i += 1
        if len(score) >= k and left[i] <= score.max():  # only then may the bound fall below the k-th score
            kth = max(kth, int(np.partition(score, len(score) - k)[len(score) - k]))
    alive = np.flatnonzero((score > 0) & (score + left[i] >= kth))
    for (docs, gain, _), w in found[i:]:
        if not len(alive):
            break
        at = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
        score[alive] += np.where(docs[at] == alive, w * gain[at], 0)
    return alive, score[alive]


def _best(rows: list[tuple], k: int) -> list[tuple]:
    return sorted(rows)[:k]


def _search_block(index: DataFrame, queries: dict[str, Counter], k: int, n_docs: int, total: int) -> DataFrame:
    """Best ``k`` of each query per task."""
    df = document_frequencies(index, sorted({t for c in queries.values() for t in c}))
    asked = sorted(df, key=lambda t: (df[t], t))  # rarest first
    number = {t: i for i, t in enumerate(asked)}
    weights = [weight(n_docs, df[t]) for t in asked]
    plans = {q: sorted((number[t], weights[number[t]] * n) for t, n in c.items() if t in number)
             for q, c in queries.items()}
    names = pa.array(asked, pa.binary())

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, list[tuple]] = {q: [] for q in plans}  # (-score, no id, id)
        for batch in batches:
            for r in range(batch.num_rows):
                seg = Segment(batch, r, names, n_docs, total)
                for q, terms in plans.items():
                    floor = -best[q][-1][0] if len(best[q]) == k else 0
                    docs, score = score_segment(seg, terms, k, floor)
                    if len(docs) > k:
                        top = np.lexsort((seg.ids[docs], seg.no_id[docs], -score))[:k]
                        docs, score = docs[top], score[top]
                    if len(docs):
                        best[q] = _best(best[q] + list(zip((-score).tolist(), seg.no_id[docs].tolist(),
                                                           seg.ids[docs].tolist())), k)
        rows = [(q, None if none else i, -s) for q, found in best.items() for s, none, i in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.int64()),
             pa.array([x[2] for x in rows], pa.int64())], names=["query", "doc_id", "score"])

    return index.mapInArrow(scored, FOUND).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of each item, scores above 0 only."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_key).alias("item_id"), F.col(item_text).cast("string").alias("text")) \
        .filter(F.col("text").isNotNull()).withColumn("query", F.sha2("text", 256))
    texts = checkpoint_table(asked.select("query", "text").distinct(), "lexical-items")
    index = build_index(docs, key, text)
    n = index.agg(F.sum("with_terms").alias("docs"), F.sum("total").alias("terms")).first()
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // QUERY_BYTES) if n.docs else 0
    found = spark.createDataFrame([], FOUND + ", salt int")
    for b in range(blocks):
        rows = texts.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).collect()
        queries = {r.query: Counter(terms_of(r.text.encode())) for r in rows}
        found = found.unionByName(checkpoint_table(_search_block(index, queries, k, n.docs, n.terms), "lexical-found"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = found.withColumn("r", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))) \
        .filter(F.col("r") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))) \
        .filter(F.col("rank") <= k)
    return asked.drop("text").join(ranked, "query").select("item_id", "rank", "doc_id", "score")

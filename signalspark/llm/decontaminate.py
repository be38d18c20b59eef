"""Operator 5, benchmark decontamination by winnowing.

Training texts and benchmark items are cut into words; of every 10-word window
the smallest of its six 5-gram hashes is its fingerprint, so a span of ten or
more shared words always yields an equal fingerprint on both sides. Training
fingerprints are joined with the benchmark's; a hit carries the names of the
windows that chose it, and these are matched against the benchmark windows with
that fingerprint. A run of matching windows is the extended hit.

The training texts are read once and are never shuffled whole: a fingerprint
row carries only its position and window names. Whether the benchmark side is
broadcast is Spark's decision from the written index's real size; otherwise
both sides shuffle by fingerprint.

Items shorter than a window (but not empty) are one window of their own length;
positions with such a window are looked up directly in the training texts when
the benchmark has items of that length. Their names are shipped to the tasks up to
``SHORT_ITEMS`` of them; beyond that every window of these lengths joins.

Edge cases: null or empty texts have no words and no hits; null item ids are
items named by the empty string; repeated items count once per id; rows that
repeat a doc_id are judged each on their own; empty tables give no hits or no
rows; extra columns are ignored by the report and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalspark.llm.common import record, text_of
from signalspark.llm.grams import ALNUM, LOWER, Windows, pair, room, text_buffers, texts_of_words, word_names, word_spans
from signalspark.llm.tokens import forget_encoders, small_batches
from signalspark.session import checkpoint_table

WINDOW, GRAM = 10, 5
SHORT_ITEMS = 500_000
#: windows of one fingerprint row
RUN = 64
REPORT = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    buf, offsets = text_buffers(texts)
    buf = LOWER[buf]
    starts, ends = word_spans(buf, offsets, ALNUM)
    return word_names(buf, starts, ends), texts_of_words(starts, offsets)


def _fingerprints(grams: np.ndarray, n: int) -> np.ndarray:
    """Minimum of the window's grams, for each of ``n`` windows."""
    two = np.minimum(grams[:-1], grams[1:])
    four = np.minimum(two[:-2], two[2:])
    return np.minimum(four[:n], two[4:4 + n])


def _windows(words: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, fingerprints, names) of the full windows."""
    at = np.flatnonzero(left >= WINDOW)
    if not len(at):
        none = np.empty(0, np.uint64)
        return at, none, none
    w = Windows(words)
    names = w[WINDOW]
    return at, _fingerprints(w[GRAM], len(names))[at], names[at]


def _short(words: np.ndarray, left: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, names) of windows of ``n`` words."""
    at = np.flatnonzero(left >= n)
    return at, Windows(words)[n][at] if len(at) else np.empty(0, np.uint64)


def _tag(names: np.ndarray, n: int) -> np.ndarray:
    """The fingerprint of a short window: its name, kept apart from other lengths."""
    return pair(names, np.full(1, n, np.uint64))


def benchmark_index(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Written table of (fp, name, n, items): the windows of all items, each once, with the ids that hold it."""
    schema = pa.schema([("item", pa.string()), ("fp", pa.int64()), ("name", pa.int64()), ("n", pa.int32())])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                words, offsets = _words(part.column("text"))
                left, counts, items = room(offsets), np.diff(offsets), part.column("item")
                at, fps, names = _windows(words, left)
                owner = np.searchsorted(offsets, at, side="right") - 1
                ns = np.full(len(at), WINDOW, np.int32)
                for n in np.unique(counts[(counts > 0) & (counts < WINDOW)]).tolist():
                    whole = np.flatnonzero(counts == n)
                    own = Windows(words)[n][offsets[whole]]
                    owner = np.concatenate([owner, whole])
                    fps, names = np.concatenate([fps, _tag(own, n)]), np.concatenate([names, own])
                    ns = np.concatenate([ns, np.full(len(whole), n, np.int32)])
                yield pa.RecordBatch.from_arrays(
                    [items.take(pa.array(owner)), pa.array(fps.view(np.int64)), pa.array(names.view(np.int64)),
                     pa.array(ns)], schema=schema)

    rows = (benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
                             F.col(text).alias("text"))
            .mapInArrow(index, "item string, fp long, name long, n int"))
    return checkpoint_table(rows.groupBy("fp", "name", "n").agg(F.collect_set("item").alias("items")), "bench-index")


def _document_rows(docs: DataFrame, key: str, text: str, lengths: list[int], short: np.ndarray | None) -> DataFrame:
    """One row per text with its word count, and one per fingerprint with the windows that chose it."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("fp", pa.int64()),
                        ("n", pa.int32()), ("at", pa.int32()), ("names", pa.list_(pa.int64()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in small_batches(batch, "text"):
                words, offsets = _words(part.column("text"))
                left, keys, k = room(offsets), part.column("key"), part.num_rows
                at, fps, names = _windows(words, left)
                owner = np.searchsorted(offsets, at, side="right") - 1
                # runs of neighbouring windows with one fingerprint
                new = np.ones(len(at), bool)
                new[1:] = (fps[1:] != fps[:-1]) | (owner[1:] != owner[:-1])
                run = np.flatnonzero(new)
                new[(np.arange(len(at)) - run[np.cumsum(new) - 1]) % RUN == 0 if len(at) else []] = True
                run = np.flatnonzero(new)
                ns = np.full(len(run), WINDOW, np.int32)
                first, cuts = at[run], np.append(run, len(at))
                owner, fps, values = owner[run], fps[run], [names]
                for n in lengths:
                    there, own = _short(words, left, n)
                    if short is not None and len(there):
                        found = short[np.minimum(np.searchsorted(short, own), len(short) - 1)] == own
                        there, own = there[found], own[found]
                    first, ns = np.concatenate([first, there]), np.concatenate([ns, np.full(len(there), n, np.int32)])
                    owner = np.concatenate([owner, np.searchsorted(offsets, there, side="right") - 1])
                    fps = np.concatenate([fps, _tag(own, n)])
                    cuts = np.concatenate([cuts, cuts[-1] + 1 + np.arange(len(there))])
                    values.append(own)
                m, ids = len(first), number + np.arange(k)
                number += k
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([np.zeros(k, np.int32), cuts]).astype(np.int32)),
                                                 pa.array(np.concatenate(values).view(np.int64)))
                nothing = np.zeros(m, bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids, ids[owner]])), pa.concat_arrays([keys, keys.take(pa.array(owner))]),
                     pa.array(np.concatenate([np.diff(offsets), np.zeros(m, np.int64)]),
                              mask=np.concatenate([np.zeros(k, bool), ~nothing])),
                     pa.array(np.concatenate([np.zeros(k, np.uint64), fps]).view(np.int64),
                              mask=np.concatenate([np.ones(k, bool), nothing])),
                     pa.array(np.concatenate([np.zeros(k, np.int32), ns])),
                     pa.array(np.concatenate([np.zeros(k, np.int64), first - offsets[owner]]).astype(np.int32)), lists],
                    schema=schema)

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(
        rows, "row long, doc_id long, n_words long, fp long, n int, at int, names array<long>")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: words, hit words, items with occurring windows (count and digest), and the hit spans."""
    index = benchmark_index(benchmark, item, item_text)
    lengths = [r.n for r in index.filter(F.col("n") < WINDOW).select("n").distinct().collect()]  # at most nine
    short = None
    if lengths:
        named = index.filter(F.col("n") < WINDOW).select("name").limit(SHORT_ITEMS + 1).collect()
        if len(named) <= SHORT_ITEMS:
            short = np.sort(np.array([r.name for r in named], np.int64).view(np.uint64))
    rows = _document_rows(docs, key, text, sorted(lengths), short)
    marks = index.select("fp").distinct().withColumn("_hit", F.lit(True))
    candidates = (rows.join(marks, "fp", "left").filter("_hit or n_words is not null")
                  .select("row", "doc_id", "n_words", "fp", "n", "at", F.posexplode_outer("names").alias("_i", "name")))
    hits = (candidates.join(index, ["fp", "name", "n"], "left")
            .filter("items is not null or n_words is not null")
            .groupBy("row", "doc_id")
            .agg(F.max("n_words").alias("n_words"),
                 F.array_sort(F.collect_set(F.when(F.col("items").isNotNull(), F.struct(
                     (F.col("at") + F.col("_i")).alias("start"), (F.col("at") + F.col("_i") + F.col("n")).alias("end")))))
                 .alias("windows"),
                 F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")))
    spans = F.aggregate(
        "windows", F.expr("cast(array() as array<struct<start:int,end:int>>)"),
        lambda acc, w: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= w["start"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1)["start"].alias("start"),
                                  F.greatest(F.element_at(acc, -1)["end"], w["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(w))))
    hits = hits.withColumn("spans", F.when(F.size("windows") > 0, spans))
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0), lambda acc, s: acc + s["end"] - s["start"]), F.lit(0))
    names = F.array_join(F.array_sort("items"), ",")
    return hits.select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "spans", "items")


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark window; all columns kept.

    A row is judged by its own text alone (named by a 64-bit hash), whatever its id: rows that
    share an id, or have none, go or stay one by one.
    """
    named = F.xxhash64(text_of(text))
    bad = (contamination(docs.select(named.alias("doc_id"), F.col(text).alias("text")), benchmark).filter("contaminated")
           .select(F.col("doc_id").alias("name")).distinct())
    return docs.select(record(docs), named.alias("name")).join(bad, "name", "left_anti").select("_rec.*")

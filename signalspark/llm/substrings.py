"""Operator 1, substring dedup by recompression.

Texts are symbol sequences. In each round every symbol falls on a left or right
side by a seeded bit of its name, and a left symbol followed by a right one is
replaced by one symbol named by the pair, so equal substrings get equal interior
symbols wherever they stand. Names are content hashes, hence global without an
exchange; a symbol never pairs with an equal neighbour, and the whole inside of a
run of one word shares one anchor name, so a run costs one entry.

After ``ROUNDS`` = 3 rounds a symbol spans at most 8 words, and what lies outside
a window can reach at most 1 + 2 + 4 = 7 words into it. So in every 20-word window
a symbol boundary at one of its first eight places depends on the window alone, and
the 13 words that follow it lie inside the window: the boundary's anchor. Two Spark
rounds then work on names only:

1. anchors: each block of documents sends the distinct anchor names it holds to the
   name's bucket; a bucket answers which of them other blocks hold too;
2. windows: windows that contain a shared anchor send their names the same way, with
   the smallest document of the block that holds them; a bucket answers which block
   holds the first occurrence. Every other occurrence is a repeat.

A block is a set of documents of about ``BLOCK_BYTES`` chosen by hashed id, packed in
one row; names travel as packed arrays, once per block, so a passage that a third of
all documents share costs one name per block and no bucket grows with it. Documents
with one id always share a block, so ties between blocks cannot occur.

Edge cases: null or empty text has no words and stays empty; texts of fewer than a
window's words are kept whole; a null id takes a place given by its text's hash; rows
that repeat an id are ordered by text, and of equal rows one counts as the first; a
very long text makes a block of its own; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalspark.llm.grams import NOT_SPACE, Windows, mix, pair, room, text_buffers, texts_of_words, word_names, word_spans

WINDOW, ROUNDS = 20, 3
REACH = (1 << ROUNDS) - 1  # words that a neighbour can reach into a window
ANCHOR = WINDOW - REACH
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
#: names per byte of text, about: one word in six bytes, 0.42 symbols a word, eight bytes a name
NAMED = 8 * 0.42 / 6
_SIDES = [np.uint64(x) for x in (0x51F15E, 0xA11CE5, 0x0DDB17)]
OUT = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start:int,end:int>>"


def boundaries(names: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Word positions where a symbol starts after some rounds. ``first`` marks the texts' first words."""
    at = np.arange(len(names))
    for r in range(rounds):
        if len(at) < 2:
            break
        left = (mix(names ^ _SIDES[r]) >> np.uint64(63)).astype(bool)
        join = left[:-1] & ~left[1:] & ~first[at[1:]]
        merged = names.copy()
        merged[:-1][join] = pair(names[:-1][join], names[1:][join])
        keep = np.concatenate([[True], ~join])
        names, at = merged[keep], at[keep]
    return at


class Block:
    """The words of a block's texts, in document order."""

    def __init__(self, docs: pa.StructArray, bits: int) -> None:
        keys, texts = docs.field("k").to_numpy(zero_copy_only=False), docs.field("text")
        order = np.argsort(keys, kind="stable")
        if len(np.unique(keys)) < len(keys):  # rows that repeat an id go by text
            raw = texts.cast(pa.binary()).to_pylist()
            order = np.array(sorted(range(len(keys)), key=lambda i: (keys[i], raw[i] is not None, raw[i] or b"")))
        self.docs, self.keys, self.bits = docs.take(pa.array(order)), keys[order], bits
        buf, offsets = text_buffers(self.docs.field("text"))
        starts, ends = word_spans(buf, offsets, NOT_SPACE)
        self.words, self.offsets = word_names(buf, starts, ends), texts_of_words(starts, offsets)
        self.left = room(self.offsets)
        self.grams = Windows(self.words)
        first = np.zeros(len(self.words) + 1, bool)
        first[self.offsets[:-1]] = True
        at = boundaries(self.words, first[:-1])
        self.at = at[self.left[at] >= ANCHOR] if len(at) else at
        self.anchors, self.anchor_of = np.unique(self.grams[ANCHOR][self.at], return_inverse=True)

    def buckets(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, start) of the runs of sorted names that share their leading bits."""
        top = (names >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(names), np.int64)
        return np.unique(top, return_index=True)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Windows with a shared anchor at one of their first places; ``shared`` is per distinct anchor."""
        repeated = shared | (np.bincount(self.anchor_of, minlength=len(self.anchors)) > 1)
        marks = np.zeros(len(self.words) + WINDOW + 1, np.int32)
        marks[self.at[repeated[self.anchor_of]] + 1] = 1
        count = np.cumsum(marks)
        p = np.flatnonzero(self.left >= WINDOW)
        return p[count[p + REACH + 1] > count[p]]

    def windows(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(candidate positions, distinct names, first candidate of each name, name of each candidate)."""
        p = self.candidates(shared)
        return p, *np.unique(self.grams[WINDOW][p] if len(p) else np.empty(0, np.uint64),
                             return_index=True, return_inverse=True)

    def owner(self, p: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, p, side="right") - 1


def _answers(rows: list, n: int) -> np.ndarray:
    """The packed bits of all buckets, in name order."""
    if not n:
        return np.zeros(0, bool)
    parts = [np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]) for r in sorted(rows, key=lambda r: r["bucket"])]
    return np.concatenate(parts).astype(bool)


def _blocks(batches: Iterator[pa.RecordBatch], bits: int):
    for batch in batches:
        for i in range(batch.num_rows):
            docs = batch.column("docs").slice(i, 1).flatten()
            yield batch, i, Block(docs, bits)


_NAMES = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("names", pa.binary()), ("docs", pa.binary())])
_BITS = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("n", pa.int32()), ("bits", pa.binary())])


def _name_rows(block: int, b: Block, names: np.ndarray, docs: np.ndarray | None) -> pa.RecordBatch:
    bucket, cut = b.buckets(names)
    cut = np.append(cut, len(names))
    spans = list(zip(cut[:-1], cut[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * len(spans), pa.int64()), pa.array(bucket, pa.int64()),
         pa.array([names[i:j].tobytes() for i, j in spans], pa.binary()),
         pa.array([docs[i:j].tobytes() if docs is not None else b"" for i, j in spans], pa.binary())], schema=_NAMES)


def _bit_rows(table: pa.Table, flags: np.ndarray, cut: np.ndarray) -> pa.Table:
    return pa.table([table["block"], table["bucket"], pa.array(np.diff(cut).astype(np.int32)),
                     pa.array([np.packbits(flags[i:j]).tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary())],
                    schema=_BITS)


def _joined(table: pa.Table, column: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    raw = table[column].to_pylist()
    cut = np.concatenate([[0], np.cumsum([len(x) // 8 for x in raw])])
    return np.frombuffer(b"".join(raw), dtype), cut


def _shared(table: pa.Table) -> pa.Table:
    """Which names of a bucket more than one block holds."""
    names, cut = _joined(table, "names", np.uint64)
    _, at, n = np.unique(names, return_inverse=True, return_counts=True)
    return _bit_rows(table, n[at] > 1, cut)


def _first(table: pa.Table) -> pa.Table:
    """Whether a block's first occurrence of a name comes before all others."""
    names, cut = _joined(table, "names", np.uint64)
    docs, _ = _joined(table, "docs", np.int64)
    order = np.lexsort((docs, names))
    first = np.ones(len(names), bool)
    first[1:] = names[order][1:] != names[order][:-1]
    flags = np.empty(len(names), bool)
    flags[order] = first
    return _bit_rows(table, flags, cut)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: words, removed words, the kept words joined by one space, and the removed word spans."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // block_bytes))
    bits = max(0, (int(size * NAMED) // BUCKET_BYTES).bit_length())
    place = F.coalesce(F.col(key).cast("long"), F.xxhash64(F.col(text)))
    blocks = (docs.select(place.alias("k"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
              .withColumn("block", F.pmod(F.xxhash64("k"), F.lit(n_blocks)))
              .groupBy("block").agg(F.collect_list(F.struct("k", "doc_id", "text")).alias("docs")))
    names_ddl, bits_ddl = ("block long, bucket long, names binary, docs binary",
                           "block long, bucket long, n int, bits binary")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, b in _blocks(batches, bits):
            yield _name_rows(batch.column("block")[i].as_py(), b, b.anchors, None)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, b in _blocks(batches, bits):
            shared = _answers(batch.column("shared")[i].as_py() or [], len(b.anchors))
            p, names, first, _ = b.windows(shared)
            yield _name_rows(batch.column("block")[i].as_py(), b, names, b.keys[b.owner(p[first])].astype(np.int64))

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, b in _blocks(batches, bits):
            shared = _answers(batch.column("shared")[i].as_py() or [], len(b.anchors))
            p, names, first, which = b.windows(shared)
            repeat = np.ones(len(p), bool)
            repeat[first[_answers(batch.column("first")[i].as_py() or [], len(names))]] = False
            cover = np.zeros(len(b.words) + 1, np.int64)
            np.add.at(cover, p[repeat], 1)
            np.add.at(cover, p[repeat] + WINDOW, -1)
            gone = np.cumsum(cover[:-1]) > 0
            yield from _result_rows(b, gone)

    answer = lambda rows, name: rows.groupBy("block").agg(
        F.collect_list(F.struct("bucket", "n", "bits")).alias(name))
    shared = answer(blocks.mapInArrow(anchors, names_ddl).groupBy("bucket").applyInArrow(_shared, bits_ddl), "shared")
    with_shared = blocks.join(shared, "block", "left")
    first = answer(with_shared.mapInArrow(windows, names_ddl).groupBy("bucket").applyInArrow(_first, bits_ddl), "first")
    return blocks.join(shared, "block", "left").join(first, "block", "left").mapInArrow(results, OUT)


def _result_rows(b: Block, gone: np.ndarray, step: int = 256) -> Iterator[pa.RecordBatch]:
    """Kept texts of a block, a few hundred documents at a time."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept", pa.string()), ("removed", pa.list_(span))])
    counts = np.diff(b.offsets)
    for i in range(0, len(b.docs), step):
        some = b.docs.slice(i, step)
        removed, kept, spans = [], [], []
        for j, t in enumerate(some.field("text").cast(pa.binary()).to_pylist(), i):
            out = gone[b.offsets[j]:b.offsets[j + 1]]
            words, n = (t or b"").split(), int(out.sum())
            removed.append(n)
            kept.append(b" ".join(compress(words, ~out) if n else words))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], out.view(np.int8), [0]]))) if n else np.empty(0, int)
            spans.append([{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
        yield pa.RecordBatch.from_arrays(
            [some.field("doc_id"), pa.array(counts[i:i + len(some)].astype(np.int64)), pa.array(removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, schema.field("removed").type)], schema=schema)

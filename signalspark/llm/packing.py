"""Operator 6, packing: first-fit decreasing over a tournament tree, in randomised groups.

Documents are encoded whole, closed with an end id and cut into pieces of at
most ``capacity`` ids. A seeded hash deals the pieces into groups of about
``GROUP_DOCS`` documents; each group is packed on its own: pieces in decreasing
length go to the first bin with room, found in O(log bins) by a tournament tree
whose nodes hold the largest free capacity below them. Groups are independent
tasks, so packing scales out and a lost executor repeats only its own groups.

A group stays small whatever the documents are. The full pieces of a long
document beyond its first ``RUN`` ones are dealt by runs of ``RUN`` pieces into
groups of their own, so a group holds at most about ``GROUP_DOCS * (RUN + 1)``
pieces (150 MB of ids at 2048 a piece); full pieces leave no padding wherever they
lie. The hash takes the row's place (task and slice of at most 4 MiB of text) besides
the id, so rows that share an id, null included, meet in one group only as far
as one slice holds them. Documents should therefore come from a stored table, whose rows a
repeated task reads in the same order.

Edge cases: null or empty text is one piece of the end id; a null id is hashed
like a value; rows that repeat are packed each on their own; an empty table
gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalspark.llm.common import utf8
from signalspark.llm.tokens import encoder, small_batches

CAPACITY = 2048
GROUP_DOCS = 2048
#: full pieces of one document that are dealt together
RUN = 8
#: runs after which families of groups repeat, and bits for the bins of a group
FAMILIES, BIN_BITS = 16_384, 24
SEED = 77_001
PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary"
PIECES = PIECE + ", place long"
PACKED = PIECE + ", sequence_id long, offset long"


class Tournament:
    """First bin with room: a binary tree of maxima over the bins' free capacities."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.size = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.size)

    def place(self, length: int) -> tuple[int, int]:
        """(bin, free capacity before) of the leftmost bin that takes ``length``."""
        free, node = self.free, 1
        while node < self.size:
            node *= 2
            if free[node] < length:
                node += 1
        room = free[node]
        at = node - self.size
        free[node] = room - length
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
        return at, room


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; ties keep their order."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree = Tournament(len(lengths), capacity)
    for i in order.tolist():
        bins[i], room = tree.place(int(lengths[i]))
        offsets[i] = capacity - room
    return bins, offsets


def cut_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, and the place of their row (task and slice)."""
    tail = struct.pack("<I", end_id)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("place", pa.int64())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = encoder(vocabulary)
        place = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in small_batches(batch, "text", 4 << 20):
                rows, place = [], place + 1
                for k, ids in zip(part.column("key").to_pylist(), lib.encode_all(utf8(part.column("text")))):
                    ids += tail
                    total = len(ids) // 4
                    rows += [(k, at, min(capacity, total - at), total, ids[4 * at:4 * (at + capacity)], place)
                             for at in range(0, total, capacity)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in
                                                  zip(zip(*rows) if rows else [[]] * 6, schema)], schema=schema)

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(pieces, PIECES)


def pack(pieces: DataFrame, groups: int, capacity: int = CAPACITY, seed: int = SEED) -> DataFrame:
    """``pieces`` with ``sequence_id`` (group in the high bits) and ``offset``."""
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("sequence_id", pa.int64()),
                     ("offset", pa.int64())])

    def packed(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        order = np.lexsort((group["start"].to_numpy(), group["doc_id"].fill_null(-1).to_numpy()))
        group = group.take(order)
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        ids = (group["_g"][0].as_py() << BIN_BITS) + bins
        group = group.drop_columns(["_g", "place"])
        return pa.Table.from_arrays([*group.columns, pa.array(ids), pa.array(offsets)], schema=out)

    run = F.floor(F.col("start") / (capacity * RUN))
    long_run = (run > 0) & (F.col("length") == capacity)
    dealt = F.xxhash64(F.lit(seed), "doc_id", F.when(long_run, run).otherwise(F.col("start")), "place")
    family = F.when(long_run, 1 + F.pmod(run, F.lit(FAMILIES))).otherwise(F.lit(0))
    return pieces.withColumn("_g", family * groups + F.pmod(dealt, F.lit(groups))).groupBy("_g").applyInArrow(packed, PACKED)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY,
                   group_docs: int = GROUP_DOCS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut and pack all documents; ``ids`` are little-endian uint32 bytes."""
    groups = max(1, -(-docs.count() // group_docs))
    return pack(cut_documents(docs, vocabulary, end_id, capacity, key, text), groups, capacity)

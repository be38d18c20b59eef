"""Operator 10, token ids in binary files with a shared zstandard dictionary.

Documents are range-partitioned and sorted by id, encoded whole, closed with an
end id, and every document's little-endian uint32 ids become one zstandard
frame compressed with a dictionary trained on serialized id arrays. A file's
bytes (column ``blob``) stand on their own:

    8 bytes magic | 32 bytes SHA-256 of the dictionary | uint64 documents
    | int64 offsets (documents + 1, from the start of the frames)
    | uint64 token counts | frames

so one short document is read with one offset lookup and one frame. Spark's
Parquet writer carries the files (one row each, with its first and last id for
pruning and the dictionary beside them), so commit and retry are Spark's own and
any shared store works.

The dictionary is fitted on a bounded sample: the ``TRAIN_DOCS`` documents of
smallest hashed id, at most ``TRAIN_IDS`` ids of each. Everything else covers
all documents.

Edge cases: null text is empty (only the end id); a null id sorts first; rows
that repeat an id are each kept, ordered by text; an empty table gives no rows.
Files are cut at ``FILE_BYTES`` of frames; a longer document is a file of its own.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from signalspark.llm.common import hashed_sample, utf8
from signalspark.llm.tokens import encoder, small_batches
from signalspark.session import work_dir

MAGIC = b"TOKIDZ01"
DICT_BYTES = 64 << 10
TRAIN_DOCS = 1000
TRAIN_IDS = 4096
LEVEL = 3
SEED = 10_010
FILE_BYTES = 32 << 20
FILES = "file_no long, first_id long, last_id long, documents long, tokens long, doc_ids binary, null_ids long, blob binary"


def train_dictionary(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                     n_docs: int = TRAIN_DOCS) -> bytes:
    """Dictionary bytes; empty when the sample is too small to train on."""
    ids_of = docs.filter(F.octet_length(text) > 0).select(F.col(key).alias("_k")).distinct()
    chosen = hashed_sample(ids_of, "_k", n_docs, SEED)
    sample = sorted(r.t for r in docs.select(F.col(key).alias("_k"), F.substring(text, 1, 8 * TRAIN_IDS).alias("t"))
                    .join(chosen, "_k").groupBy("_k").agg(F.min("t").alias("t")).collect())
    ids = encoder(vocabulary).encode_all([t.encode() for t in sample])
    try:
        return zstandard.train_dictionary(DICT_BYTES, [x[:4 * TRAIN_IDS] for x in ids if x]).as_bytes()
    except zstandard.ZstdError:
        return b""


def _blob(frames: list[bytes], counts: list[int], digest: bytes) -> bytes:
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<i8")
    return b"".join([MAGIC, digest, struct.pack("<Q", len(frames)), offsets.tobytes(),
                     np.array(counts, dtype="<u8").tobytes(), *frames])


def read_document(blob: bytes, i: int, dictionary: bytes) -> bytes:
    """The ids of the ``i``-th document of one file, as uint32 bytes."""
    n, digest = struct.unpack_from("<Q", blob, 40)[0], hashlib.sha256(dictionary).digest()
    if blob[:8] != MAGIC or blob[8:40] != digest:
        raise ValueError("not a token file of this dictionary")
    start, end = struct.unpack_from("<2q", blob, 48 + 8 * i)
    frames = 48 + 8 * (n + 1) + 8 * n
    z = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return z.decompress(blob[frames + start:frames + end])


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int, dictionary: bytes,
              key: str = "doc_id", text: str = "text") -> None:
    """Token files of all documents in ascending id order."""
    tail, digest = struct.pack("<I", end_id), hashlib.sha256(dictionary).digest()
    schema = pa.schema([("file_no", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("documents", pa.int64()),
                        ("tokens", pa.int64()), ("doc_ids", pa.binary()), ("null_ids", pa.int64()),
                        ("blob", pa.binary())])

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        lib, keys, frames, counts, size = encoder(vocabulary), [], [], [], 0
        number = itertools.count(TaskContext.get().partitionId() << 32)  # partitions follow the id order

        def flush() -> pa.RecordBatch:
            known = [k for k in keys if k is not None]
            row = [next(number), known[0] if known else None, known[-1] if known else None, len(keys),
                   sum(counts), np.array(known, dtype="<i8").tobytes(), len(keys) - len(known), _blob(frames, counts, digest)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for part in small_batches(batch, "text", 4 << 20):
                for k, ids in zip(part.column("key").to_pylist(), lib.encode_all(utf8(part.column("text")))):
                    frame = z.compress(ids + tail)
                    if frames and size + len(frame) > FILE_BYTES:
                        yield flush()
                        keys, frames, counts, size = [], [], [], 0
                    keys.append(k)
                    frames.append(frame)
                    counts.append(len(ids) // 4 + 1)
                    size += len(frame)
        if frames:
            yield flush()

    (docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
     .repartitionByRange("key").sortWithinPartitions("key", "text")
     .mapInArrow(files, FILES).write.option("compression", "uncompressed").parquet(path))


def read_ids(spark: SparkSession, path: str, dictionary: bytes) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids`` (binary) of every document, from the files."""
    files = spark.read.schema(FILES).parquet(path)
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    heads = files.select("file_no", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids", pa.binary())])
    digest = hashlib.sha256(dictionary).digest()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            for base, nulls, keys, blob in zip(*(batch.column(i).to_pylist() for i in range(4))):
                n = struct.unpack_from("<Q", blob, 40)[0]
                if blob[:8] != MAGIC or blob[8:40] != digest:
                    raise ValueError("not a token file of this dictionary")
                offsets = np.frombuffer(blob, "<i8", n + 1, 48)
                counts = np.frombuffer(blob, "<u8", n, 48 + 8 * (n + 1)).astype(np.int64)
                frames = 48 + 8 * (n + 1) + 8 * n
                starts = base + np.cumsum(counts) - counts
                ids = [None] * nulls + np.frombuffer(keys, "<i8").tolist()
                for i in range(0, n, 512):
                    some = [z.decompress(blob[frames + a:frames + b])
                            for a, b in zip(offsets[i:i + 512], offsets[i + 1:i + 513])]
                    j = slice(i, i + len(some))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[j], pa.int64()), pa.array(starts[j]), pa.array(counts[j]),
                         pa.array(some, pa.binary())], schema=schema)

    return (files.join(heads, "file_no").select("base", "null_ids", "doc_ids", "blob")
            .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary"))


def store_ids(docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None,
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """Train, write and read back; ``path`` defaults to a folder under the shared checkpoint root."""
    spark = docs.sparkSession
    path = path or work_dir(spark, "token-ids")
    dictionary = train_dictionary(docs, vocabulary, key, text)
    write_ids(docs, f"{path}/files", vocabulary, end_id, dictionary, key, text)
    (spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))],
                           "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary"))
    stored = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    return read_ids(spark, f"{path}/files", stored)

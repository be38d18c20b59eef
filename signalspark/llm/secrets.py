"""Operator 12, secret scans over an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its UTF-8 bytes. The
ledger is a Parquet table below a shared folder with one row for each blob and scan:
the rule versions that the scan applied and what they found. A scan compares the
blobs of its input with the ledger and reads only blobs that some current rule
version has not seen, with those rules; it adds its rows as a folder of their own,
whole or not at all. Findings of the current rule versions are then joined back to
every path and version that holds the blob.

A text crosses the network once, to its blob's place, after equal texts of a task have
become one; all that is joined afterwards is digests and findings. A blob that a third
of all paths share is scanned once, and the final join is between two written tables,
so Spark can split it.

Rules are (kind, version, pattern, group, least length). A kind's matches are leftmost
and do not overlap; a match counts if the group has the least length, else it is
dropped (the text it covers is not searched again). Raising a rule's version, or adding
a rule, makes the next scan apply that rule alone to the known blobs.

Edge cases: a null text is the empty blob; null and repeated paths are rows of their
own and each gets the findings; all columns of the input but ``text`` are kept, those
named like a result column give way; an empty table gives no rows and adds no ledger
row; blobs of earlier scans stay in the ledger when their paths are gone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import record, text_of, unpacked
from signalspark.session import checkpoint_table, work_dir


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    group: int
    least: int
    #: ASCII words of which a text must hold one, in any case, to be searched at all; none: always searched
    hints: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def any_case(word: str) -> str:
    """A pattern for an ASCII word in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
BASE = (
    Rule("assign", 1, "(" + "|".join(any_case(k) for k in KEYWORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, ("passw", "secret", "token", "api")),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    Rule("hex", 1, "[0-9a-f]{24,}", 0, 24),
)

SPANS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, rules array<string>, spans {SPANS}"


def spans_of(text: str, rules: list[Rule]) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then in the order of the rules."""
    found, folded = [], None
    for at, rule in enumerate(rules):
        if rule.hints:
            folded = text.lower() if folded is None else folded
            if not any(h in folded for h in rule.hints):
                continue
        for m in re.finditer(rule.pattern, text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((m.start(), at, m.end()))
    return [(rules[at].kind, start, end) for start, at, end in sorted(found)]


def blob_of(text: str = "text") -> F.Column:
    return F.sha2(text_of(text).cast("binary"), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the ledger; None before the first scan."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{path}/scan=*")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan_unseen(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = BASE, text: str = "text") -> None:
    """Bring the ledger up to date: one row for every blob that some rule had not seen."""
    spark = versions.sparkSession
    by_name = {r.name: r for r in rules}
    blobs = versions.select(blob_of(text).alias("blob"), text_of(text).alias("text")).dropDuplicates(["blob"])
    wanted = F.array(*[F.lit(n) for n in by_name])
    known = read_ledger(spark, ledger)
    if known is None:
        todo = blobs.withColumn("rules", wanted)
    else:
        seen = known.select("blob", F.explode("rules").alias("rule")).groupBy("blob") \
            .agg(F.collect_set("rule").alias("seen"))
        rest = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        todo = blobs.join(seen, "blob", "left").select("blob", "text", rest.alias("rules")).filter(F.size("rules") > 0)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = []
                for body, names in zip(part.column("text").to_pylist(), part.column("rules").to_pylist()):
                    spans = spans_of(body, [by_name[n] for n in names])
                    found.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
                yield pa.RecordBatch.from_arrays([part.column("blob"), part.column("rules"), pa.array(found, kinds)],
                                                 names=["blob", "rules", "spans"])

    folder = work_dir(spark, "scan").rpartition("-")[2]
    todo.select("blob", "text", "rules").mapInArrow(scanned, LEDGER).write.parquet(f"{ledger}/scan={folder}")


def findings(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = BASE, text: str = "text") -> DataFrame:
    """Every row of ``versions`` (without its text) with ``blob`` and ``spans`` of the given rules."""
    spark = versions.sparkSession
    known = read_ledger(spark, ledger)
    if known is None:
        known = spark.createDataFrame([], LEDGER)
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = F.array(*[F.lit(r.name) for r in rules])
    # a ledger row counts for the kinds whose current version its scan applied
    applied = F.transform(F.array_intersect("rules", current), lambda r: F.substring_index(r, "@", 1))
    s = F.col("s")
    ordered = F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"),
                       s["kind"].alias("kind"))
    spans = (known.withColumn("kinds", applied).select("blob", "kinds", F.explode("spans").alias("s"))
             .filter(F.array_contains("kinds", s["kind"])).groupBy("blob")
             .agg(F.sort_array(F.collect_set(ordered)).alias("found")))
    spans = checkpoint_table(spans, "secret-findings")
    listed = F.transform("found", lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"),
                                                     f["end"].alias("end")))
    paths = versions.select(record(versions), blob_of(text).alias("blob")).withColumn("_rec", F.col("_rec").dropFields(text))
    joined = paths.join(spans, "blob", "left").withColumn("spans", F.coalesce(listed, F.array().cast(SPANS)))
    return unpacked(joined, versions.drop(text).schema, ["blob", "spans"])


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = BASE, text: str = "text") -> DataFrame:
    """Scan what the ledger has not seen, then report every path and version."""
    scan_unseen(versions, ledger, rules, text)
    return findings(versions, ledger, rules, text)

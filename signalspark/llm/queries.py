"""One registered query per operator, over its whole table, and the DuckDB oracles."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import ship, table, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn
    return register


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.sharding import external_shuffle, record_size

    shuffled = external_shuffle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return shuffled.select(
        "doc_id", record_size("text").alias("size"), F.crc32(text_of("text").cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_warc", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), h AS (
  SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p
), g AS (
  SELECT payload_digest AS d, max(page_id) AS response FROM h WHERE payload_bytes >= 1000 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM h LEFT JOIN g ON payload_digest = d""")
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.warc import archive_pages

    return archive_pages(table(spark, sf_dir, "pages"))


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; ``SIGNALSPARK_TOKENIZERS`` names another folder."""
    folder = os.environ.get("SIGNALSPARK_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.packing import pack_documents

    packed = pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=1)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query("op10_token_ids")
def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.binary_ids import store_ids

    stored = store_ids(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op5_decontaminate", f"""
WITH d AS (
  SELECT doc_id, {_ITEM_WORDS.format("text")} AS w FROM documents
), b AS (
  SELECT item_id, {_ITEM_WORDS.format("text")} AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), h AS (
  SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (n, g)
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(x, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.decontaminate import REPORT, contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(*REPORT)


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.quality import classify

    scored = classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op1_substring_dedup", r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM g)
  WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r
), kept AS (
  SELECT doc_id, p, w[p] AS word, gone.p IS NOT NULL AS out
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d) LEFT JOIN gone USING (doc_id, p)
), s AS (
  SELECT doc_id, count(*) FILTER (out) AS n, string_agg(word, ' ' ORDER BY p) FILTER (NOT out) AS t
  FROM kept GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.substrings import remove_repeats

    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op4_neighbours")
def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.neighbours import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op2_near_duplicates")
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.near import classes

    found = classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("place").alias("doc_id"), "class_id", (F.col("place") == F.col("class_id")).alias("kept"))


@query("op7_line_dedup")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.lines import report

    return report(table(spark, sf_dir, "documents"))


_TERMS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op11_lexical_search", f"""
WITH d AS (
  SELECT doc_id, {_TERMS.format("text")} AS t FROM documents
), st AS (
  SELECT CAST(count(*) FILTER (len(t) > 0) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS total FROM d
), tf AS (
  SELECT doc_id, CAST(any_value(n) AS BIGINT) AS n, term, count(*) AS tf
  FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY doc_id, term
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), st
), q AS (
  SELECT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark
), s AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // total))))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), st GROUP BY 1, 2
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.lexical import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _positions(kind: str, pattern: str, group: int, least: int) -> str:
    """DuckDB spans of one kind: texts between the matches and the matches themselves add up to positions."""
    return f"""
  SELECT doc_id, '{kind}' AS kind, gaps + texts AS s, gaps + texts + length(m) AS e FROM (
    SELECT doc_id, unnest(m) AS m, unnest(g) AS g, unnest(list_transform(range(1, len(m) + 1),
             lambda i: coalesce(list_sum(list_transform(gap[1:i], lambda x: length(x))), 0))) AS gaps,
           unnest(list_transform(range(1, len(m) + 1),
             lambda i: coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))) AS texts
    FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS gap, regexp_extract_all(t, '{pattern}') AS m,
                 regexp_extract_all(t, '{pattern}', {group}) AS g
          FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))) WHERE length(g) >= {least}"""


_ASSIGN = ("((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
           """|[aA][pP][iI]_?[kK][eE][yY]))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""")


@query("op12_secret_scan", f"""
WITH f AS ({_positions("assign", _ASSIGN, 2, 6)}
  UNION ALL {_positions("access", "AKIA[A-Z0-9]+", 0, 20)}
  UNION ALL {_positions("hex", "[0-9a-f]{24,}", 0, 24)}
), p AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ','
                    ORDER BY s, CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 ELSE 2 END) AS spans
  FROM f GROUP BY 1
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN p USING (doc_id)""")
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.secrets import scan
    from signalspark.session import work_dir

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), work_dir(spark, "secret-ledger"))
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, ("assign", "access", "hex")),
                        F.sha2(listed.cast("binary"), 256).alias("base_sha256"), listed.alias("spans"))


@query("op13_hard_negatives", """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same)
  WHERE r <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
WHERE rank <= 5""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from signalspark.llm.negatives import mine

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)

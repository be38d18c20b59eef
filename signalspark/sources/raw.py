"""Raw stream entries: ``(stream, entry_id, data, ingest_ts)``.

``stream`` is the per-tenant log name ``di:signals:{tenant}``, ``data`` the JSON
payload as sent by a producer, ``ingest_ts`` the arrival time. The fixture
builds them from the events-derived signals with a fixed set of faults
(FIXTURES.md 3.3), keyed on the numeric event id; everything is a projection
plus a union of the few re-sent copies, so it scales with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.schema import RAW_ENVELOPE, STREAM_PREFIX
from signalspark.sources.events import load_signals, read_table

# --- fixed values of the raw fixture: event_id % 97 -> fault ---
FAULT_MOD = 97
F_NOT_JSON, F_EMPTY, F_NO_SESSION, F_FUTURE, F_UNKNOWN_KEY, F_BAD_TS, F_NO_TS, F_TOO_LARGE, \
    F_RESEND_1H, F_RESEND_20_30H, F_NO_EVENT = range(1, 12)
PAD_BYTES = 70_000
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# --- end of fixed values ---

JSON_OPTS = {"timestampFormat": TS_FORMAT}


def _body(s: Column, f: Column) -> Column:
    """JSON text of a signal struct with the field-level fault for ``f`` applied."""
    ts_str = F.date_format(s["ts"], TS_FORMAT)
    fields = {
        "event_id": F.when(f != F_NO_EVENT, s["event_id"]),
        "tenant_id": s["tenant_id"],
        "session_id": F.when(f == F_NO_SESSION, F.lit("")).otherwise(s["session_id"]),
        "ts": F.when(f == F_FUTURE, F.date_format(s["ts"] + F.expr("INTERVAL 10 MINUTES"), TS_FORMAT))
               .when(f == F_BAD_TS, F.lit("garbage"))
               .when(f == F_NO_TS, F.lit(None).cast("string"))
               .otherwise(ts_str),
        "device": s["device"],
        "behavioral": s["behavioral"],
    }
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), JSON_OPTS)


def _payload(body: Column, f: Column) -> Column:
    """Whole-payload faults: not JSON, empty, unknown key, oversized."""
    with_extra = F.concat(F.expr("substring(__b, 1, length(__b) - 1)"), F.lit(',"extra_field":1}'))
    return (F.when(f == F_NOT_JSON, F.lit("not-json"))
            .when(f == F_EMPTY, F.lit(""))
            .when(f == F_UNKNOWN_KEY, with_extra)
            .when(f == F_TOO_LARGE, F.concat(body, F.repeat(F.lit(" "), PAD_BYTES)))
            .otherwise(body))


def raw_from_signals(signals: DataFrame) -> DataFrame:
    """RAW entries for SIGNAL rows, faults applied, re-sent copies appended."""
    num = F.substring("event_id", 2, 40).cast("bigint")
    s = signals.select(F.struct(*signals.columns).alias("s"), (num % FAULT_MOD).alias("__f"), num.alias("__n"))
    s = s.withColumn("__b", _body(F.col("s"), F.col("__f")))
    base = s.select(
        F.concat(F.lit(STREAM_PREFIX), F.col("s.tenant_id")).alias("stream"),
        F.format_string("%d-0", "__n").alias("entry_id"),
        _payload(F.col("__b"), F.col("__f")).alias("data"),
        (F.col("s.ts") + F.expr("INTERVAL 1 SECOND")).alias("ingest_ts"),
        "__f", "__n",
    )
    hours = (F.when(F.col("__f") == F_RESEND_1H, F.array(F.lit(1)))
             .otherwise(F.array(F.lit(20), F.lit(30))))
    copies = base.filter(F.col("__f").isin(F_RESEND_1H, F_RESEND_20_30H)).select(
        "stream", "data", "ingest_ts", "__n", F.explode(hours).alias("__h"))
    copies = copies.select(
        "stream", F.format_string("%d-%d", "__n", "__h").alias("entry_id"), "data",
        (F.col("ingest_ts") + F.make_interval(hours=F.col("__h"))).alias("ingest_ts"))
    return base.select(*RAW_ENVELOPE.fieldNames()).unionByName(copies)


def raw_from_records(records: DataFrame, stream_col: str = "topic", value_col: str = "value",
                     time_col: str = "timestamp", id_cols: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """Any record frame (e.g. a Kafka-shaped ``topic, partition, offset, value, timestamp``)
    to the RAW columns. Payload bytes are decoded as UTF-8 with invalid sequences
    replaced (S4); the entry id is built from ``id_cols``. Works on batch and stream frames.
    """
    eid = F.concat_ws("-", *[F.col(c).cast("string") for c in id_cols])
    return records.select(
        F.col(stream_col).cast("string").alias("stream"),
        eid.alias("entry_id"),
        F.make_valid_utf8(F.col(value_col).cast("string")).alias("data"),
        F.col(time_col).cast("timestamp").alias("ingest_ts"),
    )


#: events of a partition of raw entries: below 100 MB of payloads, however many events there are
PARTITION_EVENTS = 50_000


def raw_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of the fixture: the session's default parallelism, more when there are many events."""
    events = read_table(spark, sf_dir, "events").count()  # from the files' footers
    return max(spark.sparkContext.defaultParallelism, -(-events // PARTITION_EVENTS))


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw-entry fixture, spread like a real many-partition source."""
    return raw_from_signals(load_signals(spark, sf_dir, partitions=raw_partitions(spark, sf_dir)))


def write_raw_files(raw: DataFrame, path: str, files: int | None = None, share: int = 1) -> None:
    """Land raw entries as JSON-lines files (the file form of a stream source).

    With ``share`` above 1 each of the ``files`` is that many, compressed and written where the rows are, unshuffled.
    """
    out = raw if not files else raw.repartition(files) if share == 1 else raw.coalesce(files * share)
    w = out.write.mode("overwrite").option("timestampFormat", TS_FORMAT)
    (w if share == 1 else w.option("compression", "gzip")).json(path)


def read_raw_files(spark: SparkSession, path: str, stream: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw entries from JSON-lines files; new files are picked up per trigger."""
    if stream:
        r = spark.readStream.schema(RAW_ENVELOPE).option("timestampFormat", TS_FORMAT)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.json(path)
    return spark.read.schema(RAW_ENVELOPE).option("timestampFormat", TS_FORMAT).json(path)


# --- DuckDB oracle: its own payload text, classified by its own JSON functions ---
JSON_TS = "%Y-%m-%dT%H:%M:%S.%fZ"
RFC3339_SQL = r"[0-9]{4}(-[0-9][0-9]){2}T[0-9][0-9](:[0-9][0-9]){2}([.][0-9]+)?(Z|[-+][0-9][0-9]:[0-9][0-9])"


def _not_in(keys) -> str:
    return "(" + ", ".join(f"'{k}'" for k in keys) + ")"


def entries_sql() -> str:
    """DuckDB CTEs (after ``SIGNALS_SQL``): ``ent`` = every raw entry with its outcome
    before the replay guard, ``ge``/``gr`` = the guard as a recursive fold,
    ``outc`` = final outcome. Payloads are built with ``json_object`` and checked
    with ``json_valid``, ``json_type``, ``json_keys`` and casts, independently of Spark."""
    from signalspark.schema import BEHAVIORAL, DEVICE, MAX_PAYLOAD_BYTES, SIGNAL
    from signalspark.sources.events import OS_VERSION
    m = FAULT_MOD
    top, dev, beh = _not_in(SIGNAL.fieldNames()), _not_in(DEVICE.fieldNames()), _not_in(BEHAVIORAL.fieldNames())
    text_types = "('VARCHAR', 'NULL')"
    wrong = [f"coalesce(json_type(obj, '$.{k}') NOT IN {text_types}, false)"
             for k in ("event_id", "tenant_id", "session_id", "ts")]
    wrong += [f"coalesce(json_type(obj, '$.device.{k}') NOT IN {text_types}, false)"
              for k in ("os", "os_version", "ip", "fingerprint")]
    wrong += [f"coalesce(list_bool_or(list_transform(json_extract(obj, '$.behavioral[*]'), "
              f"lambda e: coalesce(json_type(e, '$.{k}') NOT IN {text_types}, false))), false)"
              for k in ("kind", "target_elem")]
    wrong_type = "(" + " OR ".join(wrong) + ")"
    return f"""
, pay AS (
  SELECT s.*, CAST(json_object(
      'event_id', CASE WHEN eid % {m} = {F_NO_EVENT} THEN NULL ELSE event_id END,
      'tenant_id', tenant_id,
      'session_id', CASE WHEN eid % {m} = {F_NO_SESSION} THEN '' ELSE session_id END,
      'ts', CASE eid % {m} WHEN {F_FUTURE} THEN strftime(ts + INTERVAL 10 MINUTE, '{JSON_TS}')
                           WHEN {F_BAD_TS} THEN 'garbage' WHEN {F_NO_TS} THEN NULL
                           ELSE strftime(ts, '{JSON_TS}') END,
      'device', json_object('os', os, 'os_version', '{OS_VERSION}', 'ip', ip, 'fingerprint', fingerprint,
                            'battery', battery, 'geo_lat', geo_lat, 'geo_lon', geo_lon),
      'behavioral', CASE event_type
        WHEN 'click' THEN json_array(json_object('kind', 'click', 'dwell_ms', k * 10))
        WHEN 'purchase' THEN json_array(json_object('kind', 'submit'),
                                        json_object('kind', 'type', 'typing_cps', value / 50.0::DOUBLE))
        WHEN 'error' THEN json_array(json_object('kind', 'scroll', 'mouse_entropy', k / 100.0::DOUBLE),
                                     json_object('kind', 'type', 'typing_cps', value / 50.0::DOUBLE))
        WHEN 'view' THEN json_array() END) AS VARCHAR) AS body
  FROM sig s
), raw_e AS (
  SELECT '{STREAM_PREFIX}' || tenant_id AS stream, eid || '-0' AS entry_id, eid, ts + INTERVAL 1 SECOND AS ingest_ts,
         CASE eid % {m} WHEN {F_NOT_JSON} THEN 'not-json' WHEN {F_EMPTY} THEN ''
                        WHEN {F_UNKNOWN_KEY} THEN CAST(json_merge_patch(body, '{{"extra_field":1}}') AS VARCHAR)
                        WHEN {F_TOO_LARGE} THEN body || repeat(' ', {PAD_BYTES}) ELSE body END AS data
  FROM pay
  UNION ALL
  SELECT '{STREAM_PREFIX}' || tenant_id, eid || '-' || hv.h, eid,
         ts + INTERVAL 1 SECOND + to_hours(CAST(hv.h AS BIGINT)), body
  FROM pay, (VALUES (1), (20), (30)) hv(h)
  WHERE (eid % {m} = {F_RESEND_1H} AND hv.h = 1) OR (eid % {m} = {F_RESEND_20_30H} AND hv.h IN (20, 30))
), js AS (
  SELECT *, strlen(data) > {MAX_PAYLOAD_BYTES} AS too_large, trim(data, ' ' || chr(9) || chr(10) || chr(13)) = '' AS empty,
         CASE WHEN strlen(data) <= {MAX_PAYLOAD_BYTES} AND json_valid(data) AND json_type(data) = 'OBJECT'
              THEN data END AS obj
  FROM raw_e
), cls AS (
  SELECT *, string_split(stream, ':')[-1] AS tenant_id, obj IS NULL AS not_object,
         json_extract_string(obj, '$.event_id') AS p_event_id,
         json_extract_string(obj, '$.session_id') AS p_session_id,
         json_extract_string(obj, '$.ts') AS p_ts_text,
         CASE WHEN regexp_full_match(json_extract_string(obj, '$.ts'), '{RFC3339_SQL}')
              THEN timezone('UTC', try_cast(json_extract_string(obj, '$.ts') AS TIMESTAMPTZ)) END AS p_ts,
         coalesce(len(list_filter(json_keys(obj), lambda x: lower(x) NOT IN {top})) > 0, false)
           OR coalesce(len(list_filter(json_keys(obj, '$.device'), lambda x: lower(x) NOT IN {dev})) > 0, false)
           OR coalesce(list_bool_or(list_transform(json_extract(obj, '$.behavioral[*]'),
                lambda e: len(list_filter(json_keys(e), lambda x: lower(x) NOT IN {beh})) > 0)), false) AS unknown
  FROM js
), cls2 AS (
  SELECT *, (p_ts_text IS NOT NULL AND p_ts IS NULL) OR {wrong_type} AS malformed,
         coalesce(p_ts, ingest_ts) AS eff_ts FROM cls
), cls3 AS (
  SELECT *, CASE WHEN coalesce(p_event_id, '') = '' THEN 'missing_event_id'
                 WHEN coalesce(tenant_id, '') = '' THEN 'missing_tenant'
                 WHEN coalesce(p_session_id, '') = '' THEN 'missing_session'
                 WHEN eff_ts > ingest_ts + INTERVAL 5 MINUTE THEN 'future_timestamp' END AS reason_signal,
            CASE WHEN too_large THEN 'payload_too_large' WHEN empty THEN 'empty_body'
                 WHEN not_object OR malformed OR unknown THEN 'invalid_json' END AS early
  FROM cls2
), ent AS (
  SELECT stream, entry_id, tenant_id, p_event_id AS event_id, p_session_id AS session_id, eid, ingest_ts,
         eff_ts, obj,
         coalesce(early, CASE WHEN reason_signal IS NOT NULL THEN 'invalid_signal' ELSE 'accepted' END)
           AS v_outcome,
         CASE WHEN early = 'invalid_json' THEN CASE WHEN not_object THEN 'not_an_object'
                                                   WHEN malformed THEN 'malformed' ELSE 'unknown_field' END
              WHEN early IS NOT NULL THEN early
              ELSE coalesce(reason_signal, 'accepted') END AS v_reason
  FROM cls3
), ge AS (
  SELECT tenant_id, event_id, entry_id, ingest_ts,
         row_number() OVER (PARTITION BY tenant_id, event_id ORDER BY ingest_ts, entry_id) AS rn
  FROM ent WHERE v_outcome = 'accepted'
), gr AS (
  SELECT tenant_id, event_id, entry_id, rn, ingest_ts AS last_acc, TRUE AS first_seen FROM ge WHERE rn = 1
  UNION ALL
  SELECT ge.tenant_id, ge.event_id, ge.entry_id, ge.rn,
         CASE WHEN ge.ingest_ts >= gr.last_acc + INTERVAL 24 HOUR THEN ge.ingest_ts ELSE gr.last_acc END,
         ge.ingest_ts >= gr.last_acc + INTERVAL 24 HOUR
  FROM gr JOIN ge ON ge.tenant_id = gr.tenant_id AND ge.event_id = gr.event_id AND ge.rn = gr.rn + 1
), outc AS (
  SELECT e.*, CASE WHEN e.v_outcome = 'accepted' AND NOT gr.first_seen THEN 'duplicate' ELSE e.v_outcome END
         AS outcome
  FROM ent e LEFT JOIN gr ON e.entry_id = gr.entry_id AND e.tenant_id = gr.tenant_id
)"""

"""Parse, validate and classify raw entries (V1-V13, V15), one projection.

The edge rules (payload cap, empty body, strict JSON with unknown fields
rejected, tenant override, default time, required fields, clock skew) are
column expressions over the raw frame, so classification is a single narrow
stage. Outcome precedence: no_tenant, rate_limited, payload_too_large,
empty_body, invalid_json, invalid_signal, duplicate, accepted.

Decoding is strict: double quotes only, no NaN or Infinity, and ``ts`` is RFC 3339
text with a zone. A JSON number, boolean, object or array where the contract has a
string is malformed (Go's decoder rejects it, Spark's parser would read its text).
A pattern over the payload finds the few entries where that may be so; only these
have their first value's types checked, so data after it does not count. Keys match
the contract ignoring case, as in Go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from signalspark.schema import BEHAVIORAL, DEVICE, MAX_CLOCK_SKEW, MAX_PAYLOAD_BYTES, SIGNAL

CORRUPT = "_corrupt_record"
# ``ts`` is read as text and checked, since Spark's own parser takes looser forms
PARSE_SCHEMA = StructType([StructField(f.name, StringType()) if f.name == "ts" else f for f in SIGNAL.fields]
                          + [StructField(CORRUPT, StringType())])
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
PARSE_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **STRICT}
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$"
JSON_SPACE = " \t\n\r"
TOP_KEYS = SIGNAL.fieldNames()
DEVICE_KEYS = DEVICE.fieldNames()
BEHAVIORAL_KEYS = BEHAVIORAL.fieldNames()
# Go's zero value for time.Time; a payload carrying it counts as "no time"
ZERO_TS = "0001-01-01 00:00:00"
NUMERIC_OMITEMPTY = ["battery", "geo_lat", "geo_lon"]
# keys whose JSON value must be a string: the string fields, and ts (RFC 3339 text)
STRING_KEYS = [f.name for st in (SIGNAL, DEVICE, BEHAVIORAL) for f in st.fields
               if f.dataType.simpleString() in ("string", "timestamp")]
# a string key followed by a value that is neither a string nor null
NON_STRING_VALUE = r'"(?i:' + "|".join(STRING_KEYS) + r')"\s*:\s*[-0-9tf\[{]'


def tenant_hint(stream: Column | str = "stream") -> Column:
    """V4: tenant = last ``:`` segment of the stream name."""
    s = F.col(stream) if isinstance(stream, str) else stream
    return F.element_at(F.split(s, ":"), -1)


def _not_text(values: Column, keys: list[str]) -> Column:
    """Whether one of ``keys`` holds a value that is neither a string nor null."""
    return F.exists(F.array(*[F.lit(k) for k in keys]), lambda k: F.coalesce(
        ~F.schema_of_variant(F.element_at(values, k)).isin("STRING", "VOID"), F.lit(False)))


def wrong_types(payload: Column) -> Column:
    """True if a string field of the payload's first value holds another JSON type."""
    def text_keys(fields: StructType) -> list[str]:
        return [f.name for f in fields.fields if f.name in STRING_KEYS]

    top = F.from_json(payload, "map<string,variant>", STRICT)
    device = F.try_variant_get(top["device"], "$", "map<string,variant>")
    elements = F.try_variant_get(top["behavioral"], "$", "array<map<string,variant>>")
    return F.coalesce(
        _not_text(top, text_keys(SIGNAL)) | F.coalesce(_not_text(device, text_keys(DEVICE)), F.lit(False))
        | F.coalesce(F.exists(elements, lambda e: _not_text(e, text_keys(BEHAVIORAL))), F.lit(False)), F.lit(False))


def _unknown(keys: Column, known: list[str]) -> Column:
    allowed = F.array(*[F.lit(k) for k in known])
    return F.exists(F.coalesce(keys, F.array().cast("array<string>")),
                    lambda k: ~F.array_contains(allowed, F.lower(k)))


def _maybe_unknown(text: Column, known: list[str]) -> Column:
    """Whether JSON text may hold a key, at any depth, that is not spelled as one of ``known``: most texts hold none
    and need no parse for their keys."""
    return text.rlike('"(?!(?:' + "|".join(known) + r')")[^"\\]*"\s*:') | F.contains(text, F.lit("\\"))


def unknown_fields(top: Column) -> Column:
    """True if any object level carries a key outside the contract.

    ``top`` is the payload parsed as ``map<string,string>``; nested objects
    arrive as their JSON text and are parsed only here (they are small), and only
    if they may hold such a key.
    """
    dev = F.from_json(top["device"], "map<string,string>", STRICT)
    beh = F.from_json(top["behavioral"], "array<map<string,string>>", STRICT)
    in_device = F.when(_maybe_unknown(top["device"], DEVICE_KEYS), _unknown(F.map_keys(dev), DEVICE_KEYS))
    in_behavioral = F.when(_maybe_unknown(top["behavioral"], BEHAVIORAL_KEYS),
                           F.exists(beh, lambda m: _unknown(F.map_keys(m), BEHAVIORAL_KEYS)))
    return (_unknown(F.map_keys(top), TOP_KEYS) | F.coalesce(in_device, F.lit(False))
            | F.coalesce(in_behavioral, F.lit(False)))


_ALL_KEYS = "|".join(sorted(set(TOP_KEYS + DEVICE_KEYS + BEHAVIORAL_KEYS), key=len, reverse=True))
# a JSON key equal to a contract key when case is ignored, but not spelled exactly like it
CASE_VARIANT_KEY = f'"(?!(?:{_ALL_KEYS})")(?i:(?:{_ALL_KEYS}))"\\s*:'


def _normalise_keys(d: Column) -> Column:
    """Rewrite every contract key, in any letter case, to its contract spelling."""
    for k in sorted(set(TOP_KEYS + DEVICE_KEYS + BEHAVIORAL_KEYS), key=len, reverse=True):
        d = F.regexp_replace(d, f'"(?i:{k})"(\\s*:)', f'"{k}"$1')
    return d


def parse_once(raw: DataFrame, data: str = "data") -> DataFrame:
    """Add ``_p`` (typed parse with corrupt-record flag), ``_top`` (key map) and ``_wrong``
    (a string field of another type).

    The parses sit in one ``Generate`` (inline of a one-element array): later
    filters and projections refer to its output and are never pushed below
    it, so each payload is parsed twice however many rules use it (its nested objects
    once more for their keys).
    Payloads over the size cap are not parsed at all: that outcome precedes
    every parse-based one. Keys are matched to the contract ignoring case, as
    the Go decoder does: a payload with such a key has its keys normalised
    before parsing (one pattern test per payload; only those payloads pay for
    the rewrite).
    """
    d = F.when(F.octet_length(F.col(data)) <= MAX_PAYLOAD_BYTES, F.col(data))
    d = F.when(d.rlike(CASE_VARIANT_KEY), _normalise_keys(d)).otherwise(d)
    raw = raw.select("*", F.inline(F.array(F.struct(d.alias("_d")))))  # three parses read it: tested for keys once
    d = F.col("_d")
    parsed = F.struct(F.from_json(d, PARSE_SCHEMA, PARSE_OPTS).alias("_p"),
                      F.from_json(d, "map<string,string>", STRICT).alias("_top"),
                      F.when(d.rlike(NON_STRING_VALUE), wrong_types(d)).otherwise(False).alias("_wrong"))
    return raw.select("*", F.inline(F.array(parsed))).drop("_d")


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def wire_normalise(sig: Column) -> Column:
    """The wire's zero-value behaviour (omitted zeros, empty strings)."""
    d = sig["device"]
    dev = F.struct(
        *[F.coalesce(d[c], F.lit("")).alias(c) for c in ["os", "os_version", "ip", "fingerprint"]],
        *[F.nullif(d[c], F.lit(0.0)).alias(c) for c in NUMERIC_OMITEMPTY])
    beh = F.transform(sig["behavioral"], lambda b: F.struct(
        b["kind"].alias("kind"), F.nullif(b["dwell_ms"], F.lit(0)).alias("dwell_ms"),
        F.nullif(b["typing_cps"], F.lit(0.0)).alias("typing_cps"),
        F.nullif(b["mouse_entropy"], F.lit(0.0)).alias("mouse_entropy"),
        F.nullif(b["target_elem"], F.lit("")).alias("target_elem")))
    return F.struct(sig["event_id"].alias("event_id"), sig["tenant_id"].alias("tenant_id"),
                    sig["session_id"].alias("session_id"), sig["ts"].alias("ts"),
                    dev.alias("device"), beh.alias("behavioral"))


def classify(raw: DataFrame, wire_compat: bool = False, admitted: Column | None = None) -> DataFrame:
    """Add ``tenant_id_hint``, ``sig`` (normalised SIGNAL struct), ``outcome``, ``reason``.

    ``admitted`` is an optional boolean column from a quota operator (V18);
    ``duplicate`` is not decided here (see :mod:`signalspark.operators.dedup`).
    The time used for the skew check is ``ingest_ts`` (arrival), not the wall
    clock, so a replay classifies exactly as the first run did.
    """
    data = F.col("data")
    df = parse_once(raw.withColumn("tenant_id_hint", tenant_hint("stream")))
    p, top = F.col("_p"), F.col("_top")
    too_large = F.octet_length(data) > MAX_PAYLOAD_BYTES
    # a payload over the cap is neither blank nor a literal; trimming it costs more than all other rules
    trimmed = F.when(too_large, data).otherwise(F.btrim(data, F.lit(JSON_SPACE)))
    is_null_literal = trimmed == "null"  # decodes to an empty signal, no error
    raw_ts = F.when(p["ts"].rlike(RFC3339), p["ts"].try_cast("timestamp"))
    ts = F.when(raw_ts.isNull() | (raw_ts == F.lit(ZERO_TS).cast("timestamp")), F.col("ingest_ts")) \
        .otherwise(raw_ts)  # V12
    tenant = F.col("tenant_id_hint")  # V11: the authenticated tenant wins
    future = ts > F.col("ingest_ts") + F.expr(f"INTERVAL {MAX_CLOCK_SKEW}")  # V7
    # every rule is evaluated once per row, inside a Generate; outcome and reason
    # below only combine these plain columns
    rules = F.struct(
        too_large.alias("_too_large"),
        (data.isNull() | (trimmed == "")).alias("_empty"),
        (top.isNull() & ~is_null_literal).alias("_not_object"),
        ((p[CORRUPT].isNotNull() & ~is_null_literal) | (p["ts"].isNotNull() & raw_ts.isNull())
         | (top.isNotNull() & F.col("_wrong"))).alias("_corrupt"),
        raw_ts.alias("_sent_ts"),
        unknown_fields(top).alias("_unknown"),
        ts.alias("_ts"),
        (F.when(_blank(p["event_id"]), "missing_event_id")
         .when(_blank(tenant), "missing_tenant")
         .when(_blank(p["session_id"]), "missing_session")
         .when(future, "future_timestamp")).alias("_reason_signal"),  # V6 precedence
    )
    df = df.select("*", F.inline(F.array(rules)))
    not_object, corrupt = F.col("_not_object"), F.col("_corrupt")
    reason_signal = F.col("_reason_signal")
    bad_json = not_object | corrupt | F.col("_unknown")
    outcome = (F.when(tenant.isNull(), "no_tenant")
               .when(F.lit(False) if admitted is None else ~admitted, "rate_limited")
               .when(F.col("_too_large"), "payload_too_large")
               .when(F.col("_empty"), "empty_body")
               .when(bad_json, "invalid_json")
               .when(reason_signal.isNotNull(), "invalid_signal")
               .otherwise("accepted"))
    df = df.withColumn("outcome", outcome)
    reason = (F.when(F.col("outcome") == "invalid_json",
                     F.when(not_object, "not_an_object").when(corrupt, "malformed").otherwise("unknown_field"))
              .when(F.col("outcome") == "invalid_signal", reason_signal)
              .otherwise(F.col("outcome")))
    ts = F.col("_ts")
    sig = F.struct(p["event_id"].alias("event_id"), tenant.alias("tenant_id"),
                   p["session_id"].alias("session_id"), ts.alias("ts"),
                   p["device"].alias("device"), p["behavioral"].alias("behavioral"))
    if wire_compat:
        sig = wire_normalise(sig)
    sent = {f: F.col("_sent_ts") if f == "ts" else p[f] for f in SIGNAL.fieldNames()}
    body = F.struct(*[c.alias(f) for f, c in sent.items()])  # values as sent
    return df.withColumn("sig", sig).withColumn("reason", reason).withColumn("body", body) \
        .drop("_p", "_top", "_wrong", "_sent_ts", "_too_large", "_empty", "_not_object", "_corrupt", "_unknown", "_ts",
              "_reason_signal")


def parse_and_split(raw: DataFrame, strict: bool = True, wire_compat: bool = False):
    """V2: ``(good, bad)``. Good rows are SIGNAL + ``dt``; bad rows keep the raw text.

    ``strict=True`` lands only rows that pass every edge rule. ``strict=False``
    is the original landing rule: parsed and ``event_id`` present, body values
    kept as sent.
    """
    return split_classified(classify(raw, wire_compat), strict)


def lands(strict: bool = True) -> tuple[Column, str]:
    """Whether a classified row lands, and the column that holds what lands of it."""
    if strict:
        return F.col("outcome") == "accepted", "sig"
    # the original landing rule: parsed with an event id, body values as sent
    return F.col("body.event_id").isNotNull(), "body"


def landing_columns(c: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """What :func:`split_classified` needs of a classified frame: the signal of a row that lands, the raw text of others."""
    ok, kept = lands(strict)
    return c.select(*keep, *(["ingest_ts"] if "ingest_ts" not in keep else []), "tenant_id_hint", "outcome", "reason",
                    F.when(ok, F.col(kept)).alias(kept), F.when(~ok, F.col("data")).alias("data"))


def split_classified(c: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()):
    """:func:`parse_and_split` on an already classified frame; good rows also ``keep`` these columns."""
    ok, kept = lands(strict)
    good_sig = F.col(kept)
    good = c.filter(ok).select(good_sig.alias("s"), *keep).select("s.*", *keep).withColumn("dt", F.to_date("ts"))
    bad = c.filter(~ok).select(
        "tenant_id_hint", F.col("data").alias("raw"),
        F.when(F.col("outcome") == "accepted", "no_event_id").otherwise(F.col("reason")).alias("reason"),
        "ingest_ts", F.current_timestamp().alias("quarantined_at"))
    return good, bad


def outcome_counts(classified: DataFrame) -> DataFrame:
    """Entries per (tenant, outcome)."""
    return classified.groupBy(F.col("tenant_id_hint").alias("tenant_id"), "outcome") \
        .agg(F.count(F.lit(1)).alias("n"))

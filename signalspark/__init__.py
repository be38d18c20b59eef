"""signalspark: a Spark-native signal feature engine.

Raw device and behaviour signals -> parse, validate, classify, de-duplicate ->
landed Parquet + quarantine -> per-session features -> idempotent feature table
-> incremental decision payloads. Batch and Structured Streaming.

Layout: ``functions`` (column expressions), ``sources`` (readers and sinks),
``operators`` (DataFrame -> DataFrame operators), ``plans`` (multi-operator
plans: feature set, backfill), ``streaming`` (stream jobs), ``jobs`` (CLI).
"""

__version__ = "0.1.0"

"""The sample table: one row per clip, open maps for what operators add."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT_MAP = T.MapType(T.StringType(), T.StringType())
TRANSCRIPT = T.StructType(
    [*[T.StructField(n, T.StringType()) for n in ("text", "model", "version")], T.StructField("confidence", T.DoubleType()), T.StructField("status", T.StringType()), T.StructField("extra", TEXT_MAP)]
)
LINEAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("operator", "version", "params", "input_key", "output_key", "output_path", "cache_key")])

SAMPLE = (
    T.StructType()
    .add("id", T.StringType())
    .add("source_path", T.StringType())
    .add("sha256", T.StringType())
    .add("sample_rate", T.IntegerType())
    .add("channels", T.IntegerType())
    .add("duration", T.DoubleType())
    .add("audio", TEXT_MAP)
    .add("transcripts", T.MapType(T.StringType(), TRANSCRIPT))
    .add("quality", TEXT_MAP)
    .add("labels", TEXT_MAP)
    .add("lineage", T.ArrayType(LINEAGE))
    .add("status", TEXT_MAP)
    .add("errors", TEXT_MAP)
)

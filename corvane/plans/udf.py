"""User code per row: ``process(sample, params) -> partial update``, in Arrow batches, failures kept per row."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.maps import upsert
from corvane.schema import SAMPLE, TEXT_MAP

#: Fields that user code may update: maps of text, the transcripts, and single values.
MAPS, VALUES = ("audio", "quality", "labels"), ("source_path", "sha256", "sample_rate", "channels", "duration")
ALLOWED = {*MAPS, *VALUES, "transcripts"}


def _plain(value: Any, kind: T.DataType) -> Any:
    """A value as Arrow gives it, with maps as dicts."""
    if value is None:
        return None
    if isinstance(kind, T.MapType):
        return {k: _plain(v, kind.valueType) for k, v in (value.items() if isinstance(value, dict) else value)}
    if isinstance(kind, T.StructType):
        return {f.name: _plain(value.get(f.name), f.dataType) for f in kind}
    if isinstance(kind, T.ArrayType):
        return [_plain(v, kind.elementType) for v in value]
    return value


def _as_text(value: Any) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def apply_script(df: DataFrame, process: Callable[[dict[str, Any], dict[str, Any]], dict[str, Any]], params: dict[str, Any] | None = None, name: str = "script.python", key: str = "id") -> DataFrame:
    """Applies what ``process`` returns for each sample; a row that raises keeps its values and gets an error.

    The function gets a sample's fields as plain values. It may return entries
    of audio, quality and labels, transcripts (model -> text or fields), and new
    single values. A field that is not allowed, not a column of the table or not
    of its column's type is an error of that row. Rows pass through one by one:
    ids may repeat or be null, and the row count does not change.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    params, kinds = params or {}, {f.name: f.dataType for f in df.schema}
    transcript = kinds["transcripts"].valueType if "transcripts" in kinds else SAMPLE["transcripts"].dataType.valueType
    numbers = (T.IntegerType, T.LongType, T.ShortType, T.FloatType, T.DoubleType)

    def checked(update: dict[str, Any]) -> dict[str, Any]:
        if bad := set(update) - ALLOWED:
            raise ValueError(f"fields not allowed: {sorted(bad)}")
        if bad := set(update) - set(kinds):
            raise ValueError(f"fields not in the table: {sorted(bad)}")
        out: dict[str, Any] = {m: [(str(k), _as_text(v)) for k, v in (update.get(m) or {}).items()] for m in MAPS}
        spoken = []
        for model, v in (update.get("transcripts") or {}).items():
            v = {"text": v} if v is None or isinstance(v, str) else dict(v)
            if bad := set(v) - set(transcript.names):
                raise ValueError(f"transcript fields not known: {sorted(bad)}")
            if v.get("extra") is not None:
                v["extra"] = [(str(k), _as_text(x)) for k, x in v["extra"].items()]
            spoken.append((str(model), {f: v.get(f) for f in transcript.names}))
        out["transcripts"] = spoken
        values = {}
        for f in VALUES:
            if f in update:
                v = update[f]
                if v is not None and isinstance(kinds[f], numbers):
                    v = str(int(v) if not isinstance(kinds[f], (T.FloatType, T.DoubleType)) else float(v))
                values[f] = _as_text(v)
        out["values"] = list(values.items())
        return out

    made = T.StructType([*df.schema, *(T.StructField(f"_new_{m}", TEXT_MAP) for m in MAPS), T.StructField("_new_transcripts", T.MapType(T.StringType(), transcript)), T.StructField("_new_values", TEXT_MAP), T.StructField("_error", T.StringType())])
    parts = [*MAPS, "transcripts", "values"]

    def run(batches):
        types = [to_arrow_type(f.dataType) for f in made][len(kinds) :]
        for b in batches:
            rows, errors = [], []
            for row in b.to_pylist():
                try:
                    rows.append(checked(process({k: _plain(v, kinds[k]) for k, v in row.items()}, params) or {}))
                    errors.append(None)
                except Exception as e:
                    rows.append({p: [] for p in parts})
                    errors.append(str(e)[:500])
            new = [pa.array([r[p] for r in rows], t) for p, t in zip(parts, types)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new, pa.array(errors, pa.string())], made.names)

    got = df.mapInArrow(run, made)
    out = {m: upsert(F.col(m), F.col(f"_new_{m}")) for m in MAPS if m in kinds}
    if "transcripts" in kinds:
        out["transcripts"] = upsert(F.col("transcripts"), F.col("_new_transcripts"))
    for f in VALUES:
        if f in kinds:
            out[f] = F.when(F.map_contains_key("_new_values", F.lit(f)), F.try_element_at("_new_values", F.lit(f)).cast(kinds[f])).otherwise(F.col(f))
    failed = F.col("_error").isNotNull()
    old = lambda c: F.col(c) if c in kinds else F.lit(None).cast(TEXT_MAP)
    out["status"] = upsert(old("status"), F.create_map(F.lit(name), F.when(failed, "failed").otherwise("completed")))
    out["errors"] = F.when(failed, upsert(old("errors"), F.create_map(F.lit(name), F.col("_error")))).otherwise(old("errors"))
    return got.withColumns(out).drop(*[f"_new_{p}" for p in parts], "_error")

"""Model calls: a pluggable ``transcribe(batch) -> texts`` inside Arrow batches, with failures kept per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.maps import upsert

Transcribe = Callable[[list[str]], list[str]]


def mock_transcribe(paths: list[str]) -> list[str]:
    """Deterministic stand-in: a text made of the path's digest."""
    import hashlib

    return [f"mock {hashlib.sha256(p.encode()).hexdigest()[:8]}" for p in paths]


def transcribe(df: DataFrame, model: str, call: Transcribe = mock_transcribe, path: str = "source_path", key: str = "id", batch: int = 64) -> DataFrame:
    """Rows (key, text, status, error). A batch that fails is tried row by row, so one bad file fails alone."""
    import pandas as pd

    kind = df.schema[key].dataType.simpleString()

    def run(frames):
        for f in frames:
            out = []
            for at in range(0, len(f), batch):
                part = f.iloc[at : at + batch]
                try:
                    got = [(t, "completed", None) for t in call(list(part["p"]))]
                except Exception:
                    got = []
                    for p in part["p"]:
                        try:
                            got.append((call([p])[0], "completed", None))
                        except Exception as e:
                            got.append(("", "failed", str(e)[:500]))
                out += got
            yield pd.DataFrame({"k": f["k"], "text": [o[0] for o in out], "status": [o[1] for o in out], "error": [o[2] for o in out]})

    return df.select(F.col(key).alias("k"), F.coalesce(F.col(path), F.lit("")).alias("p")).mapInPandas(run, f"k {kind}, text string, status string, error string").withColumnRenamed("k", key)


def add_transcripts(df: DataFrame, model: str, call: Transcribe = mock_transcribe, cache: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Upserts the model's entry. Rows with text already are skipped unless forced; rows whose content digest is in
    ``cache`` (sha256, text) take it from there, and each content is sent to the model once."""
    old = F.coalesce(F.try_element_at("transcripts", F.lit(model))["text"], F.lit(""))
    todo = df if force else df.where(F.trim(old) == "")
    todo = todo.select("sha256", "source_path").dropDuplicates(["sha256"])
    if cache is not None:
        todo = todo.join(cache.select("sha256"), "sha256", "left_anti")
    fresh = transcribe(todo, model, call, key="sha256").select("sha256", "text", "status", "error")
    if cache is not None:
        fresh = fresh.unionByName(cache.select("sha256", "text", F.lit("completed").alias("status"), F.lit(None).cast("string").alias("error")))
    kind = df.schema["transcripts"].dataType.valueType
    new = F.struct(*[(F.col("_t") if n == "text" else F.lit(model) if n == "model" else F.col("_s") if n == "status" else F.lit(None)).cast(f.dataType).alias(n) for n, f in zip(kind.names, kind.fields)])
    out = df.join(fresh.select("sha256", F.col("text").alias("_t"), F.col("status").alias("_s"), F.col("error").alias("_e")), "sha256", "left")
    take = F.col("_s").isNotNull() & (F.lit(force) | (F.trim(old) == ""))
    return out.withColumn("transcripts", F.when(take, upsert(F.col("transcripts"), F.create_map(F.lit(model), new))).otherwise(F.col("transcripts"))).drop("_t", "_s", "_e")

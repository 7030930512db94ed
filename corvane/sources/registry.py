"""Logical names of sources and tables, re-probing of files, and the folder of a run."""

from __future__ import annotations

import json
from collections.abc import Iterable

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.maps import put, upsert
from corvane.sources.manifest import wav_header, write_samples

#: Forms of a table in the order in which they are looked for.
FORMS = (".parquet", ".jsonl", "")


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _file_system(spark, path)
    return fs.exists(at)


def _read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())  # a small configuration file


def load_sources(spark: SparkSession, registry: str) -> list[dict]:
    """The entries of a registry (YAML, ``sources``); none if there is no such file."""
    return list((yaml.safe_load(_read_text(spark, registry)) or {}).get("sources") or []) if exists(spark, registry) else []


def lookup(spark: SparkSession, registry: str, source_id: str) -> dict:
    for entry in load_sources(spark, registry):
        if entry.get("source_id") == source_id:
            return entry
    raise KeyError(f"{source_id} is not registered in {registry}")


def resolve_source(spark: SparkSession, registry: str, source_id: str, indexes: Iterable[str] = ()) -> dict[str, str]:
    """Where a registered source is read from: the first sample index that exists (``{id}`` stands for its name), else its folder."""
    entry = lookup(spark, registry, source_id)
    for pattern in indexes:
        path = pattern.replace("{id}", source_id)
        if exists(spark, path):
            return {"manifest": path, "source_id": source_id}
    if not entry.get("path"):
        raise ValueError(f"{source_id} has no folder and no sample index")
    return {"source_dir": str(entry["path"]), "source_id": source_id}


def resolve_table(spark: SparkSession, name: str, roots: Iterable[str] = ()) -> str:
    """The first table of that name: the path as given, then under each root; Parquet before JSON lines."""
    text = name.strip()
    if not text:
        raise ValueError("the name is empty")
    stem = text.removesuffix(".parquet").removesuffix(".jsonl")
    first = [text] if stem != text else [stem + f for f in FORMS]
    base = stem.rsplit("/", 1)[-1]
    wanted = FORMS[:2] if not text.endswith(".jsonl") else (FORMS[1], FORMS[0])
    tried = [*first, *(f"{r.rstrip('/')}/{base}{f}" for r in roots for f in wanted)]
    for path in dict.fromkeys(tried):
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"{name}: none of {tried[:12]}")


def probe(samples: DataFrame, audio_key: str = "raw", name: str = "quality.probe") -> DataFrame:
    """Reads the header of each sample's file again: rate, channels and duration, ``labels.broken``, ``quality.probe_valid`` and ``probe_error``.

    A file that is missing or no WAV keeps the sample's old measures and is
    broken. Only the files' first bytes are kept; samples meet files by path.
    """
    spark = samples.sparkSession
    path = F.coalesce(F.try_element_at("audio", F.lit(audio_key)), F.col("source_path"))
    d = samples.withColumn("_path", F.regexp_replace(path, "^file:/*", "/"))
    folders = [r[0] for r in d.where("_path is not null").select(F.regexp_extract("_path", "^(.*)/[^/]*$", 1)).distinct().collect()]  # one row a folder
    there = [f for f in folders if f and exists(spark, f)]
    kind = "_file string, h struct<rate:bigint,channels:bigint,width:bigint,bytes:bigint>"
    files = (
        spark.read.format("binaryFile").load(there).select(F.regexp_replace("path", "^file:/*", "/").alias("_file"), wav_header(F.substring("content", 1, 4096), F.col("length")).alias("h"))
        if there else spark.createDataFrame([], kind)
    )
    j = d.join(files, F.col("_path") == F.col("_file"), "left")
    good = F.coalesce((F.col("h")["width"] > 0) & (F.col("h")["bytes"] >= 0), F.lit(False))
    error = F.when(F.col("_file").isNull(), "missing file").when(~good, "no readable header").otherwise("")
    out = j.withColumns({
        "sample_rate": F.when(good, F.col("h")["rate"].cast("int")).otherwise(F.col("sample_rate")), "channels": F.when(good, F.col("h")["channels"].cast("int")).otherwise(F.col("channels")),
        "duration": F.when(good, F.col("h")["bytes"] / F.col("h")["width"]).otherwise(F.col("duration")), "labels": put(F.col("labels"), broken=F.when(good, "false").otherwise("true")),
        "quality": put(F.col("quality"), probe_valid=F.when(good, "true").otherwise("false"), probe_error=error), "status": upsert(F.col("status"), F.create_map(F.lit(name), F.lit("completed"))),
    })
    return out.select(*samples.columns)


def write_run(rows: DataFrame, folder: str, config: dict, metrics: dict | None = None, log: Iterable[str] = ()) -> dict[str, str]:
    """The folder of a run: its rows, its configuration with a digest, its metrics and its log, each moved to its place when whole."""
    import hashlib

    spark = rows.sparkSession
    digest = hashlib.sha256(json.dumps(config, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    root = folder.rstrip("/")
    out = {"manifest": f"{root}/manifest.parquet", "config": f"{root}/config.yaml", "metrics": f"{root}/metrics.json", "log": f"{root}/run.log"}
    write_samples(rows, out["manifest"])
    texts = {"config": yaml.safe_dump(config | {"config_digest": digest}, allow_unicode=True, sort_keys=False), "metrics": json.dumps(metrics or {}, ensure_ascii=False, indent=2), "log": "\n".join(log)}
    for name, body in texts.items():
        at, fs = _file_system(spark, f"{out[name]}.tmp")
        stream = fs.create(at, True)
        try:
            stream.write(bytearray(body.encode()))
        finally:
            stream.close()
        final = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out[name])
        fs.delete(final, False)
        if not fs.rename(at, final):
            raise OSError(f"cannot write {out[name]}")
    return out | {"config_digest": digest}

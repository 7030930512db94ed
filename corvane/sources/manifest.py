"""Sample tables in files: Parquet and JSON lines, plain or with nested fields as JSON text."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.runtime import drop_path
from corvane.schema import SAMPLE

AUDIO_EXT = ("wav", "flac", "mp3", "m4a", "ogg", "pcm")


def read_samples(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Samples in the schema of ``corvane.schema``.

    JSON lines: blank and broken lines are left out. Parquet: nested columns may be
    JSON text, of which broken cells become empty; a flat ``{model}_text`` column fills
    a route that is missing or blank; columns that are absent are null.
    """
    if fmt == "jsonl":
        raw = spark.read.schema(T.StructType([*SAMPLE.fields, T.StructField("_corrupt_record", T.StringType())])).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
        # the broken-line column is read beside another one, so the parser fills it without a cache
        return raw.where(F.col("_corrupt_record").isNull() & (F.col("id").isNull() | F.col("id").isNotNull())).drop("_corrupt_record")
    raw = spark.read.parquet(path)
    out = []
    for f in SAMPLE.fields:
        if f.name == "_corrupt_record":
            continue
        if f.name not in raw.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.dataType.typeName() in ("map", "array") and raw.schema[f.name].dataType.typeName() == "string":
            empty = F.array() if f.dataType.typeName() == "array" else F.create_map()
            out.append(F.coalesce(F.from_json(F.col(f.name), f.dataType), empty.cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    flat = [c for c in raw.columns if c.endswith("_text") and c != "gold_text"]
    d = raw.select(*out, *flat)
    kind = SAMPLE["transcripts"].dataType.valueType
    for c in flat:
        model = c.removesuffix("_text")
        old = F.try_element_at(F.col("transcripts"), F.lit(model))["text"]
        entry = F.struct(*[(F.col(c) if n == "text" else F.lit(model) if n == "model" else F.lit(None)).cast(k.dataType).alias(n) for n, k in zip(kind.names, kind.fields)])
        fill = (F.trim(F.coalesce(old, F.lit(""))) == "") & F.col(c).isNotNull()
        rest = F.map_filter(F.coalesce("transcripts", F.create_map().cast(SAMPLE["transcripts"].dataType)), lambda k, _: k != model)
        d = d.withColumn("transcripts", F.when(fill, F.map_concat(rest, F.create_map(F.lit(model), entry))).otherwise(F.col("transcripts")))
    return d.drop(*flat)


def write_samples(df: DataFrame, path: str, fmt: str = "parquet", nested_text: bool = False) -> None:
    """Write beside the target and move, so a reader never sees half a table.

    A table that stands there is moved aside first and deleted last; if the new
    one cannot take its place, it is put back.
    """
    tmp = f"{path.rstrip('/')}.tmp-{uuid.uuid4().hex}"
    if nested_text:
        df = df.select(*[F.to_json(c).alias(c) if df.schema[c].dataType.typeName() in ("map", "array", "struct") else F.col(c) for c in df.columns])
    (df.write.parquet if fmt == "parquet" else df.write.option("ignoreNullFields", "false").json)(tmp)
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    here, there = jvm.org.apache.hadoop.fs.Path(tmp), jvm.org.apache.hadoop.fs.Path(path)
    fs = there.getFileSystem(conf)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    stood = fs.exists(there)
    if stood and not fs.rename(there, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(here, there):
        if stood:
            fs.rename(aside, there)
        raise OSError(f"cannot publish {path}")
    if stood:
        drop_path(df.sparkSession, aside.toString())


def export_scp(df: DataFrame, path: str, audio_key: str = "raw") -> None:
    """Lines ``id path``; the raw audio falls back to the source path."""
    df.select(F.concat_ws(" ", "id", F.coalesce(F.try_element_at("audio", F.lit(audio_key)), F.col("source_path"))).alias("value")).write.text(path)


def export_parts(df: DataFrame, path: str, most: int = 20_000) -> None:
    """CSV in parts of at most ``most`` rows."""
    df.write.option("header", True).option("maxRecordsPerFile", most).csv(path)


#: Chunks of a WAV header that are walked at most.
CHUNKS = 32


def wav_header(head: Column, length: Column) -> Column:
    """struct(rate, channels, width, bytes): the format and data chunks of a RIFF file's first bytes, wherever they stand; null fields if absent.

    ``width`` is bytes a second, ``bytes`` those of sound; a data chunk that
    claims more than the file has counts what is there.
    """
    le = lambda at, n: F.conv(F.hex(F.reverse(F.substring(head, at, n))), 16, 10).cast("long")
    tag = lambda at, name: F.substring(head, at, 4) == F.lit(name).cast("binary")
    none = F.lit(None).cast("long")
    start = F.struct(F.lit(13).cast("int").alias("at"), none.alias("rate"), none.alias("channels"), none.alias("width"), none.alias("bytes"))

    def step(s, _):
        at = s["at"]
        size = le(at + 4, F.lit(4))
        there = (at + 7 <= F.length(head)) & s["bytes"].isNull()
        fmt, data = there & tag(at, "fmt "), there & tag(at, "data")
        nxt = F.when(there & ~data, F.least(at + 8 + size + size % 2, F.lit(1 << 30))).otherwise(at).cast("int")
        return F.struct(
            nxt.alias("at"), F.when(fmt, le(at + 12, F.lit(4))).otherwise(s["rate"]).alias("rate"), F.when(fmt, le(at + 10, F.lit(2))).otherwise(s["channels"]).alias("channels"),
            F.when(fmt, le(at + 16, F.lit(4))).otherwise(s["width"]).alias("width"), F.when(data, F.least(size, length - (at + 7))).otherwise(s["bytes"]).alias("bytes"),
        )

    riff = tag(F.lit(1), "RIFF") & tag(F.lit(9), "WAVE")
    found = F.aggregate(F.sequence(F.lit(1), F.lit(CHUNKS)), start, step)
    return F.when(riff, F.struct(*[found[c].alias(c) for c in ("rate", "channels", "width", "bytes")]))


def ingest(spark: SparkSession, folder: str, known: DataFrame | None = None, extensions: Iterable[str] = AUDIO_EXT, recursive: bool = True) -> DataFrame:
    """Samples for the files of a folder whose content is not known yet.

    The id is the file's stem, the digest that of its bytes; the header of WAV
    files gives rate, channels and duration, and unreadable ones are labelled
    broken. Copies inside one scan are all kept.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.{" + ",".join(extensions) + "}").load(folder)
    d = files.select(F.col("path").alias("source_path"), F.sha2("content", 256).alias("sha256"), F.substring("content", 1, 4096).alias("head"), F.col("length"))
    if known is not None:
        d = d.join(known.where("sha256 is not null").select("sha256").distinct(), "sha256", "left_anti")
    stem = F.regexp_replace(F.regexp_extract("source_path", r"([^/]*)$", 1), r"\.[^.]*$", "")
    d = d.withColumn("h", wav_header(F.col("head"), F.col("length")))
    ok = F.coalesce((F.col("h")["width"] > 0) & (F.col("h")["bytes"] >= 0), F.lit(False))
    rate, channels = F.col("h")["rate"], F.col("h")["channels"]
    labels = F.when(~ok & F.lower("source_path").endswith(".wav"), F.create_map(F.lit("broken"), F.lit("true"))).otherwise(F.create_map().cast("map<string,string>"))
    return d.select(
        stem.alias("id"), "source_path", "sha256", F.when(ok, rate).cast("int").alias("sample_rate"), F.when(ok, channels).cast("int").alias("channels"),
        F.when(ok, F.col("h")["bytes"] / F.col("h")["width"]).alias("duration"), F.create_map(F.lit("raw"), F.col("source_path")).alias("audio"), labels.alias("labels"),
    ).orderBy("source_path")

"""Other readers: spreadsheets as CSV, JSON with an envelope, reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pick_column(names: list[str], candidates: list[str]) -> str | None:
    """The first candidate that is a column, ignoring case and outer blanks."""
    have = {n.strip().lower(): n for n in names}
    return next((have[c.lower()] for c in candidates if c.lower() in have), None)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A sheet saved as CSV; all cells are text, blank cells empty."""
    d = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return d.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c.strip()) for c in d.columns])


def read_json_results(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, or one document whose rows are under ``data`` or ``results``."""
    d = spark.read.json(path)
    if d.columns == ["_corrupt_record"] or set(d.columns) & {"data", "results"}:
        d = spark.read.option("multiLine", True).json(path)
    for name in ("data", "results"):
        if name in d.columns and d.schema[name].dataType.typeName() == "array":
            return d.select(F.explode(name).alias("r")).select("r.*")
    return d


def read_gold(spark: SparkSession, path: str, summary_ids: tuple[str, ...] = ("总计", "合计", "total")) -> DataFrame:
    """Rows (id, gold_text, gold_type) of a reference sheet; blank and summary ids are left out, a repeated id raises."""
    d = read_sheet(spark, path)
    key, label, kind = pick_column(d.columns, ["id", "sample_id", "音频id", "文件名"]), pick_column(d.columns, ["label", "gold", "gold_text", "标注"]), pick_column(d.columns, ["type", "类型"])
    if key is None or label is None:
        raise ValueError("the sheet needs an id and a label column")
    out = d.select(F.trim(F.col(key)).alias("id"), F.col(label).alias("gold_text"), (F.col(kind) if kind else F.lit("")).alias("gold_type"))
    out = out.where((F.col("id") != "") & ~F.lower("id").isin(*[s.lower() for s in summary_ids]))
    twice = out.groupBy("id").count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"duplicate ids: {[r['id'] for r in twice]}")
    return out


def catalog_record(spark: SparkSession, catalog: str, kind: str, name: str, payload: str) -> str:
    """Store an immutable record; the same payload again is harmless, another under the same name raises. Returns its id.

    Two writers at once may both append: the record is read again after the
    write, and every writer but that of the least digest raises.
    """
    import hashlib

    digest = hashlib.sha256(payload.encode()).hexdigest()
    rid = f"{kind}_{name}"
    row = spark.createDataFrame([(rid, digest, payload)], "id string, digest string, payload string")
    try:
        old = spark.read.parquet(catalog).where(F.col("id") == rid).select("digest").first()
    except Exception as e:  # no catalog yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = None
    if old is None:
        row.write.mode("append").parquet(catalog)
        least = spark.read.parquet(catalog).where(F.col("id") == rid).agg(F.min("digest")).first()[0]
        if least != digest:
            raise ValueError(f"{rid} was stored by another writer with another payload")
    elif old["digest"] != digest:
        raise ValueError(f"{rid} exists with another payload")
    return rid


def verify_catalog(spark: SparkSession, catalog: str) -> DataFrame:
    """Records whose payload does not have the stored digest."""
    return spark.read.parquet(catalog).where(F.sha2("payload", 256) != F.col("digest"))

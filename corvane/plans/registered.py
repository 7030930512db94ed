"""The operators of plans under their names: thin forms over the operator modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions import text
from corvane.functions.maps import put
from corvane.operators import classify, inference, relational, sampling, signal
from corvane.operators.metrics import edit_metrics
from corvane.plans.pipeline import operator
from corvane.sources import manifest


def _route(c: str):
    return F.try_element_at("transcripts", F.lit(c))["text"]


@operator("ingest.scan")
def ingest_scan(df: DataFrame, source_dir: str, recursive: bool = True) -> DataFrame:
    """New files of a folder after the rows there are; a content that is known is not added."""
    return df.unionByName(manifest.ingest(df.sparkSession, source_dir, df, recursive=recursive), allowMissingColumns=True)


@operator("quality.normalize_transcripts")
def normalize_transcripts(df: DataFrame, models: list[str] | str = "*", blank_words: list[str] = (), keep_raw: bool = True, unicode: bool = True) -> DataFrame:
    """Rewrite texts in normal form; the first raw text is kept in ``extra.raw_text``; whole hot-words become empty."""

    def one(k, t):
        chosen = F.lit(True) if models in ("*", "all") or "*" in models else k.isin(list(models))
        raw = F.coalesce(F.try_element_at(t["extra"], F.lit("raw_text")), t["text"])
        made = text.blank_exact(text.normalize_text(t["text"], unicode=False), blank_words)
        extra = F.when(F.lit(keep_raw) & raw.isNotNull(), put(F.coalesce(t["extra"], F.create_map().cast("map<string,string>")), raw_text=raw)).otherwise(t["extra"])
        return F.when(chosen & t["text"].isNotNull(), F.struct(made.alias("text"), t["model"].alias("model"), t["version"].alias("version"), t["confidence"].alias("confidence"), t["status"].alias("status"), extra.alias("extra"))).otherwise(t)

    return df.withColumn("transcripts", F.transform_values("transcripts", one))


@operator("quality.text_metrics")
def text_metrics(df: DataFrame, base: str | None = None, hypotheses: list[str] = (), reference_label: str = "gold_text", overwrite: bool = False, unicode: bool = True) -> DataFrame:
    """Adds ``{model}_vs_gold`` and ``{model}_vs_base`` edits to the quality map, and ``max_vs_base_agreement_cer``.

    Missing references are skipped; entries that exist raise unless overwritten.
    """
    gold = F.coalesce(F.try_element_at("labels", F.lit(reference_label)), F.try_element_at("labels", F.lit("label")), _route("gold"))
    cols = {m: _route(m).alias(f"h_{m}") for m in hypotheses}
    wide = df.select("id", gold.alias("r_gold"), *([_route(base).alias("r_base")] if base else []), *cols.values())
    parts = [("gold", list(hypotheses))] + ([("base", [m for m in hypotheses if m != base])] if base else [])
    if not overwrite:
        names = [f"{m}_vs_{k}_cer" for k, ms in parts for m in ms]
        clash = F.exists(F.map_keys("quality"), lambda k: k.isin(names))
        if not df.where(F.coalesce(clash, F.lit(False))).isEmpty():
            raise ValueError("metrics exist already")
    long = None
    for kind, models in parts:
        if not models:
            continue
        part = edit_metrics(wide.where(F.col(f"r_{kind}").isNotNull()), f"r_{kind}", {f"{m}_vs_{kind}": f"h_{m}" for m in models}, unicode).where("scored")
        part = part.select("id", "model", "substitutions", "deletions", "insertions", "reference_length", "cer")
        long = part if long is None else long.unionByName(part)
    if long is None:
        return df
    entry = lambda f: F.struct(F.concat("model", F.lit(f"_{f}")).alias("k"), F.col(f).cast("string").alias("v"))
    flat = long.select("id", F.explode(F.array(*[entry(f) for f in ("cer", "substitutions", "deletions", "insertions", "reference_length")])).alias("e"))
    worst = long.where(F.col("model").endswith("_vs_base")).groupBy("id").agg(F.max("cer").cast("string").alias("v")).select("id", F.struct(F.lit("max_vs_base_agreement_cer").alias("k"), "v").alias("e"))
    maps = flat.union(worst).groupBy("id").agg(F.map_from_entries(F.collect_list("e")).alias("_m"))
    from corvane.functions.maps import upsert

    return df.join(maps, "id", "left").withColumn("quality", upsert(F.col("quality"), F.col("_m"))).drop("_m")


@operator("quality.cer")
def cer(df: DataFrame, hypothesis: str, reference: str = "gold_text", unicode: bool = True) -> DataFrame:
    return text_metrics(df, None, [hypothesis], reference, True, unicode)


@operator("quality.asr_edit_distance")
def asr_edit_distance(df: DataFrame, baseline_model: str, compare_models: list[str], unicode: bool = True) -> DataFrame:
    return text_metrics(df, baseline_model, list(compare_models), overwrite=True, unicode=unicode)


@operator("quality.split_dataset")
def split_dataset(df: DataFrame, group_key: str = "speaker_id", ratios: dict[str, float] | None = None, seed: int = 0, stratify_key: str | None = None) -> DataFrame:
    """Adds ``split`` to the labels; a label without the group raises."""
    d = df.withColumn("_group", F.try_element_at("labels", F.lit(group_key)))
    if stratify_key:
        d = d.withColumn("_stratum", F.try_element_at("labels", F.lit(stratify_key)))
    d = sampling.group_split(d, "_group", ratios or {"train": 0.8, "dev": 0.1, "test": 0.1}, seed, "_stratum" if stratify_key else None)
    return d.withColumn("labels", put(F.col("labels"), split=F.col("split"), split_seed=F.lit(str(seed)))).drop("_group", "_stratum", "split")


@operator("quality.classify")
def classify_rules(df: DataFrame, rules: list[list[str]], default: str = "review_queue") -> DataFrame:
    return classify.classify_by_expressions(df, [tuple(r) for r in rules], default)


operator("quality.classify_v1")(classify.classify_v1)
operator("quality.classify_v2")(classify.classify_v2)
operator("quality.compare")(relational.compare)
operator("quality.energy")(signal.energy_evidence)


def _signal(name: str, f):
    @operator(name)
    def run(df: DataFrame, column: str = "signal", output: str | None = None, **params) -> DataFrame:
        return df.withColumn(output or column, f(F.col(column), **params))


_signal("audio.resample", signal.resample)
_signal("audio.denoise", signal.denoise)
_signal("audio.vad", signal.vad_ratio)
_signal("audio.duration_pad", signal.pad_to_bucket)
_signal("audio.pcm_to_wav", signal.pcm_to_wav)
_signal("augmentation.speed_perturb", signal.change_speed)
_signal("augmentation.volume_perturb", signal.change_volume)
_signal("quality.snr", signal.snr_db)


@operator("augmentation.add_noise")
def add_noise(df: DataFrame, snr: float, column: str = "signal", key: str = "id", seed: int = 0) -> DataFrame:
    return df.withColumn(column, signal.add_noise(F.col(column), F.col(key), snr, seed))


@operator("asr.mock")
def asr_mock(df: DataFrame, model: str, force: bool = False) -> DataFrame:
    return inference.add_transcripts(df, model, force=force)

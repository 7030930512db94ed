"""Labels proposed from two transcripts, their edits by matching blocks, and samples from label sheets."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text

#: Everything but letters, digits and underscores is left out before texts are compared.
STRIP = r"[^\p{L}\p{N}_]+"


def bare(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.clean_control_tags(text.text_or_empty(c)), F.lit("")), STRIP, "")


def block_ratio(a: str, b: str) -> float:
    """Share of the characters in matching blocks; both empty 1, one empty 0."""
    from difflib import SequenceMatcher

    return 1.0 if a == b == "" else 0.0 if "" in (a, b) else SequenceMatcher(None, a, b).ratio()


def block_edits(ref: str, hyp: str) -> tuple[float, int, int, int]:
    """(accuracy, missing, extra, wrong) by matching blocks: a replaced stretch is wrong as far as both reach, the rest missing or extra."""
    from difflib import SequenceMatcher

    if ref == hyp == "":
        return 1.0, 0, 0, 0
    if ref == "" or hyp == "":
        return 0.0, len(ref), len(hyp), 0
    missing = extra = wrong = 0
    for tag, i, j, k, m in SequenceMatcher(None, ref, hyp).get_opcodes():
        if tag != "equal":
            a, b = j - i, m - k
            both = min(a, b) if tag == "replace" else 0
            wrong, missing, extra = wrong + both, missing + a - both, extra + b - both
    return round(1 - (missing + extra + wrong) / len(ref), 6), missing, extra, wrong


def propose_labels(df: DataFrame, first: str, second: str, interjections: Iterable[str], voicemail: str, voicemail_label: str, threshold: float = 0.8, noise_label: str = "/") -> DataFrame:
    """Adds gold_label, same_flag, char_acc, missing, extra, wrong.

    In order: both empty, or the first a single interjection and the second
    empty: noise; the second a voicemail text: its label; alike by matching
    blocks: the first text, else the second; otherwise empty (to be read).
    """
    @F.pandas_udf("struct<ratio:double,char_acc:double,missing:int,extra:int,wrong:int>")
    def compared(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [(block_ratio(x, y), *block_edits(x, y)) for x, y in zip(a, b)]
        return pd.DataFrame(rows, columns=["ratio", "char_acc", "missing", "extra", "wrong"])

    d = df.withColumns({"_a": bare(F.col(first)), "_b": bare(F.col(second)), "_s": text.clean_control_tags(text.text_or_empty(F.col(second)))}).withColumn("_c", compared("_a", "_b"))
    noise = (F.col("_b") == "") & ((F.col("_a") == "") | F.col("_a").isin(*interjections))
    label = F.when(noise, noise_label).when(F.col("_s").rlike(voicemail), voicemail_label).when(F.col("_c")["ratio"] >= threshold, F.when(F.col("_a") != "", F.col("_a")).otherwise(F.col("_b"))).otherwise("")
    return d.withColumns({"gold_label": label, "same_flag": F.col("_a") == F.col("_b")}).select(*df.columns, "gold_label", "same_flag", *[F.col("_c")[c].alias(c) for c in ("char_acc", "missing", "extra", "wrong")])


def sheet_rows(sheet: DataFrame, key: str, label: str, models: dict[str, str], type_: str | None = None) -> DataFrame:
    """A wide sheet as rows (id, type, gold_text, model, hypothesis): one for each sample and model column; blank ids are left out."""
    cells = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("hypothesis")) for m, c in models.items()])
    kind = F.coalesce(F.col(type_), F.lit("")) if type_ else F.lit("")
    d = sheet.where(F.trim(F.coalesce(F.col(key), F.lit(""))) != "").select(F.trim(F.col(key)).alias("id"), kind.alias("type"), F.coalesce(F.col(label), F.lit("")).alias("gold_text"), F.explode(cells).alias("c"))
    return d.select("id", "type", "gold_text", "c.*")


def align_external(rows: DataFrame, base: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched) rows of another system against the base ids: by id, then by file stem, then by the stem behind a prefix.

    A stem or suffix that several base ids share matches none.
    """
    stem = lambda c: F.lower(F.regexp_replace(F.regexp_extract(c, r"([^/\\]*)$", 1), r"\.[^.]*$", ""))
    tail = lambda c: F.regexp_extract(stem(c), r"([^_\-]+)$", 1)
    b = base.select(F.col(key).alias("_id"))
    rest, out = rows.withColumn("_m", F.lit(None).cast("string")), None
    for how, form in (("id", lambda c: c), ("stem", stem), ("suffix", tail)):
        known = b.groupBy(form(F.col("_id")).alias("_k")).agg(F.min("_id").alias("_id"), F.count("*").alias("_n")).where("_n = 1 and _k <> ''")
        met = rest.drop("_m").join(known, form(F.col(key)) == F.col("_k"), "left")
        got = met.where("_id is not null").select(*rows.columns, F.col("_id").alias("base_id"), F.lit(how).alias("matched_by"))
        out = got if out is None else out.union(got)
        rest = met.where("_id is null").select(*rows.columns, F.lit(None).cast("string").alias("_m"))
    return out, rest.drop("_m")

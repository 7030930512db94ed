"""Registry, name resolution, probing, run folders; proposed labels, sheets and external alignment."""

import json
import struct
from difflib import SequenceMatcher

import pytest
import yaml
from pyspark.sql import functions as F

from corvane.operators import labels
from corvane.schema import SAMPLE
from corvane.sources import registry


def test_registered_sources(spark, tmp_path):
    reg = tmp_path / "sources.yaml"
    assert registry.load_sources(spark, str(reg)) == []
    reg.write_text(yaml.safe_dump({"sources": [{"source_id": "a", "path": "/data/a"}, {"source_id": "b"}]}))
    assert registry.resolve_source(spark, str(reg), "a") == {"source_dir": "/data/a", "source_id": "a"}
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "samples.jsonl").write_text("{}")
    assert registry.resolve_source(spark, str(reg), "a", [f"{tmp_path}/none/{{id}}", f"{tmp_path}/{{id}}/samples.jsonl"])["manifest"] == f"{tmp_path}/a/samples.jsonl"
    with pytest.raises(ValueError):
        registry.resolve_source(spark, str(reg), "b")
    with pytest.raises(KeyError):
        registry.resolve_source(spark, str(reg), "c")


def test_table_names(spark, tmp_path):
    old, new = tmp_path / "old", tmp_path / "new"
    for at, name in ((old, "t.parquet"), (new, "t.jsonl"), (new, "u.parquet"), (new, "u.jsonl")):
        at.mkdir(exist_ok=True)
        (at / name).write_text("x")
    find = lambda n: registry.resolve_table(spark, n, [str(new), str(old)])
    assert find("t") == f"{new}/t.jsonl" and find("u") == f"{new}/u.parquet" and find("u.jsonl") == f"{new}/u.jsonl" and find("t.parquet") == f"{new}/t.jsonl"
    assert registry.resolve_table(spark, f"{old}/t") == f"{old}/t.parquet"
    for bad, kind in (("", ValueError), ("none", FileNotFoundError)):
        with pytest.raises(kind):
            find(bad)


def test_probe_reads_headers_again(spark, tmp_path):
    data = b"\0" * 32000
    body = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 16000, 32000, 2, 16) + b"data" + struct.pack("<I", len(data)) + data
    (tmp_path / "good.wav").write_bytes(b"RIFF" + struct.pack("<I", len(body)) + body)
    (tmp_path / "bad.wav").write_bytes(b"noise")
    row = lambda i, path: tuple({**dict.fromkeys(SAMPLE.names), "id": i, "source_path": path, "duration": 9.0, "labels": {"k": "v"}}[c] for c in SAMPLE.names)
    d = spark.createDataFrame([row("g", f"{tmp_path}/good.wav"), row("b", f"file://{tmp_path}/bad.wav"), row("m", f"{tmp_path}/no/none.wav"), row("n", None)], SAMPLE)
    got = {r["id"]: (r["duration"], r["sample_rate"], r["labels"], r["quality"]["probe_error"]) for r in registry.probe(d).collect()}
    assert got == {
        "g": (1.0, 16000, {"k": "v", "broken": "false"}, ""), "b": (9.0, None, {"k": "v", "broken": "true"}, "no readable header"),
        "m": (9.0, None, {"k": "v", "broken": "true"}, "missing file"), "n": (9.0, None, {"k": "v", "broken": "true"}, "missing file"),
    }


def test_run_folder(spark, tmp_path):
    d = spark.createDataFrame([("a",)], "id string")
    for n in (1, 2):
        got = registry.write_run(d, str(tmp_path / "run"), {"name": "é", "steps": [1]}, {"rows": n}, ["one", "two"])
    assert spark.read.parquet(got["manifest"]).count() == 1 and json.loads((tmp_path / "run" / "metrics.json").read_text()) == {"rows": 2}
    config = yaml.safe_load((tmp_path / "run" / "config.yaml").read_text())
    assert config["name"] == "é" and config["config_digest"] == got["config_digest"] and (tmp_path / "run" / "run.log").read_text() == "one\ntwo"


def test_proposed_labels(spark):
    rows = [("a", "你好，世界", "你好世界。"), ("b", "", " ，"), ("c", "嗯。", ""), ("d", "你好", "语音信箱请留言"), ("e", "完全不同", "另外的话"), ("f", None, "<|zh|>你好"), ("g", "今天天气很好", "今天天气真好")]
    d = spark.createDataFrame(rows, "id string, q string, s string")
    got = {r["id"]: r for r in labels.propose_labels(d, "q", "s", ["嗯", "啊"], "语音信箱", "mail").collect()}
    assert {k: r["gold_label"] for k, r in got.items()} == {"a": "你好世界", "b": "/", "c": "/", "d": "mail", "e": "", "f": "", "g": "今天天气很好"}
    assert got["a"]["same_flag"] and (got["g"]["char_acc"], got["g"]["wrong"]) == (round(1 - 1 / 6, 6), 1) and got["f"]["extra"] == 2
    assert labels.block_ratio("今天天气很好", "今天天气真好") == SequenceMatcher(None, "今天天气很好", "今天天气真好").ratio() >= 0.8


def test_sheets_and_external_alignment(spark):
    sheet = spark.createDataFrame([(" a ", "x", "p", None), ("", "y", "q", "r")], "name string, label string, m1 string, m2 string")
    assert sorted(map(tuple, labels.sheet_rows(sheet, "name", "label", {"one": "m1", "two": "m2"}).collect()), key=str) == [("a", "", "x", "one", "p"), ("a", "", "x", "two", None)]
    base = spark.createDataFrame([("x1",), ("call_7",), ("k_9",), ("j_9",)], "id string")
    rows = spark.createDataFrame([("x1", 1), ("dir/CALL_7.wav", 2), ("other-7", 3), ("z_9", 4), ("none", 5)], "id string, v int")
    got, rest = labels.align_external(rows, base)
    assert {(r["v"], r["base_id"], r["matched_by"]) for r in got.collect()} == {(1, "x1", "id"), (2, "call_7", "stem"), (3, "call_7", "suffix")} and sorted(r["v"] for r in rest.collect()) == [4, 5]

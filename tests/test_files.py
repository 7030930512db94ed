import struct

import pytest
from pyspark.sql import functions as F

from corvane.operators import inference, signal
from corvane.plans import pipeline, udf
from corvane.sources import manifest, tables
from corvane.streaming import incremental


def wav(path, seconds=1, rate=16000):
    data = b"\0\1" * (seconds * rate)
    path.write_bytes(b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate * 2, 2, 16) + b"data" + struct.pack("<I", len(data)) + data)


def test_ingest_and_round_trip(spark, tmp_path):
    d = tmp_path / "audio"
    d.mkdir()
    wav(d / "a.wav")
    wav(d / "b.wav")
    (d / "c.wav").write_bytes(b"nope")
    got = {r["id"]: r for r in manifest.ingest(spark, str(d)).collect()}
    assert got["a"]["sample_rate"] == 16000 and got["a"]["duration"] == pytest.approx(1.0) and got["c"]["labels"] == {"broken": "true"}
    known = manifest.ingest(spark, str(d)).where("id = 'c'")
    assert {r["id"] for r in manifest.ingest(spark, str(d), known).collect()} == {"a", "b"}
    path = str(tmp_path / "m")
    manifest.write_samples(manifest.ingest(spark, str(d)), path, nested_text=True)
    back = manifest.read_samples(spark, path)
    assert {r["id"]: r["audio"]["raw"] for r in back.collect()}["a"].endswith("a.wav")
    manifest.write_samples(back, str(tmp_path / "j"), "jsonl")
    assert manifest.read_samples(spark, str(tmp_path / "j"), "jsonl").count() == 3


def test_flat_text_fills_blank_routes(spark, tmp_path):
    p = str(tmp_path / "f")
    spark.createDataFrame([("a", '{"m":{"text":" "}}', "filled"), ("b", "broken{", "new")], "id string, transcripts string, m_text string").write.parquet(p)
    got = {r["id"]: r["transcripts"]["m"]["text"] for r in manifest.read_samples(spark, p).collect()}
    assert got == {"a": "filled", "b": "new"}


def test_sheets_and_catalog(spark, tmp_path):
    (tmp_path / "g.csv").write_text("ID,label,type\na,x,t\n,y,t\n总计,z,\n")
    assert [tuple(r) for r in tables.read_gold(spark, str(tmp_path / "g.csv")).collect()] == [("a", "x", "t")]
    (tmp_path / "d.csv").write_text("id,label\na,x\na,y\n")
    with pytest.raises(ValueError, match="duplicate"):
        tables.read_gold(spark, str(tmp_path / "d.csv"))
    (tmp_path / "r.json").write_text('{"data": [{"id": "a"}, {"id": "b"}]}')
    assert tables.read_json_results(spark, str(tmp_path / "r.json")).count() == 2
    c = str(tmp_path / "cat")
    assert tables.catalog_record(spark, c, "manifest", "x", "p") == tables.catalog_record(spark, c, "manifest", "x", "p")
    with pytest.raises(ValueError):
        tables.catalog_record(spark, c, "manifest", "x", "other")
    assert tables.verify_catalog(spark, c).count() == 0


def test_signals(spark):
    d = spark.createDataFrame([(1, [0.5, -0.5] * 50), (2, [0.0] * 100), (3, [])], "id int, x array<double>")
    got = {r["id"]: r for r in signal.energy_evidence(d, "x", 100).collect()}
    assert got[1]["energy_state"] == "audible" and got[2]["energy_state"] == "inaudible" and got[3]["energy_state"] == "failed"
    assert got[1]["rms_dbfs"] == pytest.approx(-6.0206, abs=1e-3)
    r = d.where("id = 1").select(F.size(signal.resample(F.col("x"), 100, 50)).alias("n"), F.size(signal.pad_to_bucket(F.col("x"), [64, 128])).alias("p"), F.size(signal.change_speed(F.col("x"), 2.0)).alias("s"), signal.vad_ratio(F.col("x"), 10).alias("v")).first()
    assert (r["n"], r["p"], r["s"], r["v"]) == (50, 128, 50, 1.0)
    two = [d.where("id = 1").select(signal.add_noise(F.col("x"), F.col("id"), 10).alias("y")).first()["y"] for _ in range(2)]
    assert two[0] == two[1]


def test_plans_scripts_and_models(spark):
    d = spark.createDataFrame([("a", 1.0), ("b", 9.0)], "id string, duration double").withColumns({c: F.create_map().cast("map<string,string>") for c in ("quality", "labels", "status", "errors")})

    def process(s, p):
        if s["id"] == "b":
            raise RuntimeError("boom")
        return {"quality": {"twice": 2 * s["duration"]}}

    got = {r["id"]: r for r in udf.apply_script(d, process).collect()}
    assert got["a"]["quality"] == {"twice": "2.0"} and got["b"]["status"] == {"script.python": "failed"} and "boom" in got["b"]["errors"]["script.python"]
    plan = pipeline.load("steps:\n  - {operator: quality.select, params: {expr: 'duration > 5'}}")
    assert [r["id"] for r in pipeline.run(d, plan).collect()] == ["b"]
    assert pipeline.fingerprint(plan) != pipeline.fingerprint(pipeline.load("steps:\n  - {operator: quality.select, params: {expr: 'duration > 6'}}"))
    with pytest.raises(ValueError):
        pipeline.load("steps: [{operator: nope}]")
    t = inference.transcribe(spark.createDataFrame([("a", "p"), ("b", "bad")], "id string, source_path string"), "m", lambda ps: [1 / 0 if p == "bad" else p.upper() for p in ps])
    assert {r["id"]: (r["text"], r["status"]) for r in t.collect()} == {"a": ("P", "completed"), "b": ("", "failed")}


def test_stream_of_new_content(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("h1", "2024-01-01 00:00:00"), ("h1", "2024-01-01 00:10:00"), ("h2", "2024-01-01 01:00:00")], "sha256 string, t string").selectExpr("sha256", "cast(t as timestamp) ts").write.parquet(src)
    out = str(tmp_path / "out")
    stream = incremental.unseen(incremental.parquet_stream(spark, src), "sha256", "ts")
    incremental.run_once(stream, str(tmp_path / "cp"), lambda d, i: d.write.mode("overwrite").parquet(f"{out}/b={i}"))
    assert sorted(r["sha256"] for r in spark.read.parquet(out).collect()) == ["h1", "h2"]


def test_registered_operators(spark):
    from corvane.plans import registered  # noqa: F401  registers them

    entry = "struct<text:string,model:string,version:string,confidence:double,status:string,extra:map<string,string>>"
    t = lambda x: (x, "m", None, None, None, None)
    rows = [("a", "s1", "p1", {"q": t("不需要"), "s": t("需要!"), "b": t("不需要")}, {}, {"gold_text": "不需要", "spk": "x"}), ("b", "s2", "p2", {"q": t("词"), "s": t(None)}, {}, {"spk": "y"})]
    d = spark.createDataFrame(rows, f"id string, sha256 string, source_path string, transcripts map<string,{entry}>, quality map<string,string>, labels map<string,string>")
    plan = pipeline.load("""
steps:
  - {operator: quality.normalize_transcripts, params: {models: ['q', 's'], blank_words: ['词']}}
  - {operator: quality.text_metrics, params: {base: b, hypotheses: ['q', 's']}}
  - {operator: quality.split_dataset, params: {group_key: spk, seed: 1}}
  - {operator: asr.mock, params: {model: mock}}
""")
    got = {r["id"]: r for r in pipeline.run(d, plan).collect()}
    q = got["a"]["quality"]
    assert (q["s_vs_gold_cer"], q["s_vs_gold_deletions"], q["q_vs_base_cer"], q["max_vs_base_agreement_cer"]) == ("0.333333", "1", "0.0", "0.333333")
    assert got["a"]["transcripts"]["s"]["text"] == "需要" and got["a"]["transcripts"]["s"]["extra"]["raw_text"] == "需要!"
    assert got["b"]["transcripts"]["q"]["text"] == "" and got["b"]["transcripts"]["mock"]["text"].startswith("mock ") and got["b"]["labels"]["split"]
    with pytest.raises(ValueError, match="exist"):
        pipeline.run(pipeline.run(d, plan), pipeline.load("steps: [{operator: quality.text_metrics, params: {base: b, hypotheses: ['q']}}]"))
    assert {"asr.mock", "audio.vad", "quality.cer", "ingest.scan"} <= set(pipeline.operators())

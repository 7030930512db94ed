"""Rules that must not change with size, and the forms that replaced them."""

import hashlib
import heapq
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from corvane.functions import similarity, text
from corvane.operators import dataset, metrics, relational, reports, sampling, semantics
from corvane.plans import udf
from corvane.schema import SAMPLE


def plain_levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_distances_by_bands(spark):
    rnd = random.Random(3)
    pairs = []
    for n in (0, 1, 5, 40, 120):
        for _ in range(20):
            a = "".join(rnd.choice("abé日 ") for _ in range(n))
            b = list(a)
            for _ in range(rnd.choice([0, 1, 3, 12, n])):
                if b:
                    b[rnd.randrange(len(b))] = rnd.choice(["x", "", "yy"])
            pairs.append((a, "".join(b)))
    d = spark.createDataFrame(pairs, "a string, b string")
    got = d.select("a", "b", similarity.edits(F.col("a"), F.col("b")).alias("d"), *[similarity.within(F.col("a"), F.col("b"), t).alias(f"w{i}") for i, t in enumerate((0.5, 0.8, 0.95))]).collect()
    for r in got:
        want = plain_levenshtein(r["a"], r["b"])
        longer = max(len(r["a"]), len(r["b"]))
        sim = 1.0 if not longer else 0.0 if not r["a"] or not r["b"] else round(1 - want / longer, 6)
        assert r["d"] == want and [r["w0"], r["w1"], r["w2"]] == [sim >= t for t in (0.5, 0.8, 0.95)], (r, want)


def test_quota_pick_beyond_two_hundred_rounds(spark):
    # a chain: each row shares its duplicate key with the one before it, or its call with the next
    rows = [(f"r{i}", f"c{i // 2}", f"d{(i + 1) // 2}") for i in range(60)]
    got = {r["id"] for r in sampling.pick_quota(spark.createDataFrame(rows, "id string, call string, dup string"), 60, 1, "s", max_per_call=1).collect()}
    order = sorted(rows, key=lambda r: _rank(spark, r[0]))
    calls, dups, want = {}, set(), set()
    for i, c, d in order:
        if calls.get(c, 0) < 1 and d not in dups:
            calls[c] = calls.get(c, 0) + 1
            dups.add(d)
            want.add(i)
    assert got == want


def _rank(spark, key, seen={}):
    if key not in seen:
        from corvane.functions import hashing

        d = spark.createDataFrame([(f"r{i}",) for i in range(60)], "id string")
        for r in d.select("id", F.struct(*hashing.rank_key(1, "s", F.col("id"))).alias("k")).collect():
            seen[r["id"]] = tuple(r["k"])
    return seen[key]


@pytest.mark.parametrize("step", [1_000, 7])
def test_balanced_shards_equal_the_plain_rule(spark, step):
    rnd = random.Random(4)
    rows = [(i, f"{rnd.getrandbits(64):064x}", "p", rnd.choice([None, 1.0, 2.5, 2.5, 7.25, 0.5])) for i in range(60)]
    d = spark.createDataFrame(rows, "id long, sha256 string, source_path string, duration double").repartition(3)
    from corvane.functions import hashing

    digest = {r["id"]: r["d"] for r in d.select("id", hashing.sample_digest(F.col("sha256"), F.col("source_path")).alias("d")).collect()}
    heap, want = [(0.0, i) for i in range(5)], {}
    for k, _, _, w in sorted(rows, key=lambda r: (-(1.0 if r[3] is None else r[3]), digest[r[0]])):
        load, i = heapq.heappop(heap)
        want[k] = i
        heapq.heappush(heap, (load + (1.0 if w is None else w), i))
    assert {r["id"]: r["shard"] for r in relational.balanced_shards(d, 5, step_rows=step).collect()} == want
    assert relational.balanced_shards(d.limit(0), 5).count() == 0


def test_snapshot_digest_equals_a_plain_program(spark):
    rows = [(i % 50, t, None if i % 3 else "x") for i, t in enumerate(["a", "", "é~", "1:a", None, "b"] * 20)]
    d = spark.createDataFrame(rows, "k long, t string, s string").repartition(4)
    field = lambda v: "~" if v is None else f"{len(str(v))}:{v}"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    buckets = {}
    for r in rows:
        buckets.setdefault(int(sha(str(r[0]))[:8], 16) % 16, []).append((str(r[0]), sha("".join(map(field, r)))))
    want = sha("".join(sha("".join(h for _, h in sorted(b))) for _, b in sorted(buckets.items())))
    assert tuple(dataset.snapshot_digest(d, "k", ["t", "s"], fan=16).first()) == (120, want)
    assert dataset.snapshot_digest(d.where("k <> 0"), "k", ["t", "s"], fan=16).first()["digest"] != want
    assert dataset.snapshot_digest(d.limit(0), "k", ["t", "s"]).first()["rows"] == 0


def test_bootstrap_has_one_form_unless_a_bound_is_named(spark):
    rnd = random.Random(1)
    rows = [(f"g{i:03}", rnd.random(), 1.0, rnd.random(), 1.0) for i in range(50)]
    d = spark.createDataFrame(rows, "g string, na double, da double, nb double, db double")
    args = (d, "g", ("na", "da"), ("nb", "db"), 100, 7)
    rng, deltas = random.Random(7), []
    for _ in range(100):
        pick = [rows[rng.randrange(50)] for _ in range(50)]
        deltas.append(sum(p[3] for p in pick) / 50 - sum(p[1] for p in pick) / 50)
    deltas.sort()
    got = metrics.bootstrap_delta(*args).first()
    assert (got["low"], got["high"]) == pytest.approx((deltas[2], deltas[96]))
    assert metrics.bootstrap_delta(*args, exact_groups=10).first() == metrics.poisson_delta(*args).first()


def test_script_applies_all_allowed_fields(spark):
    row = lambda i, **k: {**dict.fromkeys(SAMPLE.names), "id": i, **k}
    rows = [row("a", duration=1.0, audio={"raw": "x.wav"}, transcripts={"m": dict(text="old", model="m", version=None, confidence=None, status=None, extra={"k": "v"})}), row("a", duration=2.0), row(None, duration=3.0), row("bad", duration=-1.0, quality={"q": "1"})]
    d = spark.createDataFrame([tuple(r[c] for c in SAMPLE.names) for r in rows], SAMPLE)

    def process(s, p):
        if s["duration"] < 0:
            raise ValueError("negative")
        if s["duration"] == 3.0:
            return {"sample_rate": "many"}
        seen = (s["transcripts"] or {}).get("m", {}).get("text")
        return {"audio": {"clean": "y.wav"}, "quality": {"n": 3}, "labels": {"seen": seen}, "transcripts": {"new": "text", "m": {"text": "fixed", "confidence": 0.5}}, "duration": s["duration"] * 2, "sample_rate": 16000}

    got = sorted(udf.apply_script(d, process).collect(), key=lambda r: (r["id"] is None, str(r["id"]), r["duration"]))
    assert [(r["id"], r["duration"], r["sample_rate"]) for r in got] == [("a", 2.0, 16000), ("a", 4.0, 16000), ("bad", -1.0, None), (None, 3.0, None)]
    assert got[0]["audio"] == {"raw": "x.wav", "clean": "y.wav"} and got[0]["labels"] == {"seen": "old"} and got[1]["labels"] == {"seen": None} and got[0]["quality"] == {"n": "3"}
    assert got[0]["transcripts"]["m"]["text"] == "fixed" and got[0]["transcripts"]["m"]["confidence"] == 0.5 and got[0]["transcripts"]["new"]["text"] == "text"
    assert got[2]["quality"] == {"q": "1"} and got[2]["errors"] == {"script.python": "negative"} and [r["status"]["script.python"] for r in got] == ["completed", "completed", "failed", "failed"]


def test_spot_audit_equals_one_rank(spark):
    rnd = random.Random(2)
    rows = [(f"i{i}", rnd.choice("ab"), rnd.choice("xyz")) for i in range(400)]
    d = spark.createDataFrame(rows, "id string, category string, stratum string").repartition(5)
    got = sampling.spot_audit(d, share=0.1, least=20).collect()
    for c in "ab":
        own = [r for r in got if r["category"] == c]
        assert sum(r["spot_selected"] for r in own) == max(20, -(-len(own) // 10))
        assert {r["stratum"] for r in own if r["spot_selected"]} == set("xyz")


def test_abbreviations_are_not_foreign_speech(spark):
    assert len(semantics.ABBREVIATIONS) == 19 and {"WIFI", "VIP", "QR"} <= set(semantics.ABBREVIATIONS)


def test_language_by_shares(spark):
    rows = [("你好吗", "zh"), ("hello there", "en"), ("你好 abcd", "mixed"), ("", "empty"), (" \n", "empty"), ("123", "unknown"), (None, "empty"), ("你好你好你好a", "zh"), ("a" * 5000 + "你", "en")]
    got = spark.createDataFrame(rows, "t string, w string").select(text.detect_language(F.col("t")).alias("g"), "w").collect()
    assert [r["g"] for r in got] == [r["w"] for r in got]


def test_roles_and_groups_by_all_their_names(spark):
    rows = [("a", None, " EVAL_core ", None, None, "g"), ("b", "dev", None, "train", "eval_random", " "), ("c", "eval_random", "eval_core", None, None, None)]
    d = spark.createDataFrame(rows, "id string, dataset_role string, eval_role string, split string, reservation_role string, source_group_id string")
    d = d.withColumns({c: F.lit(None).cast("string") for c in ("gold_text", "gold_kind", "type", "human_semantic", "polarity")})
    got = {r["id"]: (r["role"], r["group_key"]) for r in metrics.gold_facts(d).collect()}
    assert got == {"a": ("eval_core", "g"), "b": ("eval_random", "b"), "c": ("eval_random", "c")}


def test_wav_chunks_are_walked(spark, tmp_path):
    import struct

    from corvane.sources import manifest

    def wav(extra=b"", claim=None, fmt=True, odd=False):
        data = b"\0" * 32000
        body = b"WAVE" + (b"LIST" + struct.pack("<I", len(extra)) + extra + (b"\0" if len(extra) % 2 else b"") if extra else b"")
        body += b"fmt " + struct.pack("<IHHIIHH", 16, 1, 2, 8000, 32000, 4, 16) if fmt else b""
        body += b"data" + struct.pack("<I", len(data) if claim is None else claim) + data
        return b"RIFF" + struct.pack("<I", len(body)) + body

    for name, raw in {"plain": wav(), "list": wav(b"x" * 37), "claims": wav(claim=1 << 30), "none": wav(fmt=False), "text": b"no sound"}.items():
        (tmp_path / f"{name}.wav").write_bytes(raw)
    got = {r["id"]: (r["sample_rate"], r["channels"], r["duration"], "broken" in (r["labels"] or {})) for r in manifest.ingest(spark, str(tmp_path)).collect()}
    assert got == {"plain": (8000, 2, 1.0, False), "list": (8000, 2, 1.0, False), "claims": (8000, 2, 1.0, False), "none": (None, None, None, True), "text": (None, None, None, True)}


def test_write_samples_keeps_the_old_table_until_the_new_one_stands(spark, tmp_path):
    from corvane.sources import manifest

    path = str(tmp_path / "t")
    manifest.write_samples(spark.createDataFrame([("a",)], "id string"), path)
    manifest.write_samples(spark.createDataFrame([("b",), ("c",)], "id string"), path)
    assert spark.read.parquet(path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_components_are_the_same_by_rounds(spark):
    from corvane.operators.components import connected_components

    rnd = random.Random(7)
    e = spark.createDataFrame([(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)], "u long, v long")
    a, b = ({r["node"]: r["component"] for r in connected_components(e, local_edges=n).collect()} for n in (0, 10**6))
    assert a == b and len(set(a.values())) > 5


def test_representative_of_long_texts(spark):
    """The distances of a row come once from the bit vectors; as nested expressions these rows took minutes."""
    rnd = random.Random(11)
    word = lambda n: "".join(rnd.choice("abé日𝄞 ") for _ in range(n))
    rows = [tuple(None if rnd.random() < 0.1 else word(rnd.choice([0, 1, 3, 30])) for _ in range(3)) for _ in range(60)] + [("ab", "ab", "b"), ("", "", "x"), ("", "", "")]
    long = [tuple(word(6000) for _ in range(3)) for _ in range(24)]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows + long)], "i int, a string, b string, c string").repartition(4)
    reps = F.array(*[F.struct(F.lit(f).alias("family"), F.col(c).alias("text"), F.col(c).alias("key")) for f, c in (("x", "a"), ("y", "b"), ("z", "c"))])
    began = time.time()
    got = {r["i"]: r["r"] for r in d.select("i", reports.representative(reps, ["z", "y", "x"]).alias("r")).collect()}
    assert len(got) == len(rows) + len(long) and time.time() - began < 25
    rounded = lambda v: math.floor(v * 1e6 + 0.5) / 1e6
    for i, texts in enumerate(rows):
        apart = lambda a, b: 1.0 if not a or not b else rounded(plain_levenshtein(a, b) / max(len(a), len(b)))
        means = [rounded(sum(apart(a, b) for k, b in enumerate(texts) if k != j) / 2) for j, a in enumerate(texts)]
        same = [sum(b is not None and a == b for b in texts) for a in texts]
        mean, _, _, at = min((means[j], -same[j], -j, j) for j in range(3))
        assert (got[i]["family"], got[i]["text"], got[i]["distance"], got[i]["support"]) == ("xyz"[at], texts[at], mean, same[at]), (texts, got[i])
    assert spark.range(1).select(reports.representative(F.array(F.struct(F.lit("x").alias("family"), F.lit("t").alias("text"), F.lit("t").alias("key"))), ["x"]).alias("r")).first()["r"] is None

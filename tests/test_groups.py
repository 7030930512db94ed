import hashlib
import random

from pyspark.sql import functions as F

from corvane.functions import stats
from corvane.operators import components, dataset, metrics, sampling


def plain_components(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


def test_components_both_ways(spark, monkeypatch):
    rnd = random.Random(3)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7)]
    want = {k: v for k, v in plain_components([e for e in edges if e[0] != e[1]]).items()}
    d = spark.createDataFrame(edges + [(None, 1)], "u long, v long")
    assert {r["node"]: r["component"] for r in components.connected_components(d).collect()} == want
    monkeypatch.setattr(components, "LOCAL_EDGES", 0)
    assert {r["node"]: r["component"] for r in components.connected_components(d).collect()} == want
    assert components.connected_components(d.limit(0)).count() == 0


def test_leakage_groups(spark):
    d = spark.createDataFrame([("a", "c1", None), ("b", "c1", "h"), ("c", " ", "h"), ("d", "", ""), ("e", None, None)], "id string, call string, h string")
    g = dataset.leakage_groups(d, {"call": ["call"], "file": ["h"]})
    assert {r["id"]: r["component"] for r in g.collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e"}
    names = {r["id"]: r["group_id"] for r in dataset.group_ids(g).collect()}
    assert names["a"] == names["c"] == "lg_" + hashlib.sha256(b"a|b|c").hexdigest()[:16]
    assert {r["size"]: r["groups"] for r in dataset.size_histogram(g).collect()} == {3: 1, 1: 2}


def test_large_groups_are_named_by_all_members(spark):
    n = 100_002
    g = spark.range(n).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") == 5, "5").otherwise("0").alias("component"))
    want = "lg_" + hashlib.sha256("|".join(sorted(str(i) for i in range(n) if i != 5)).encode()).hexdigest()[:16]
    got = {r["group_id"]: r["count"] for r in dataset.group_ids(g).groupBy("group_id").count().collect()}
    assert got == {want: n - 1, "lg_" + hashlib.sha256(b"5").hexdigest()[:16]: 1}


def unit(*parts):
    return int.from_bytes(hashlib.sha256("\0".join(map(str, parts)).encode()).digest()[:8], "big") / 2**64


def test_group_split_is_whole_and_stable(spark):
    d = spark.createDataFrame([(i, f"p{i // 2}", "x" if i % 3 else "y") for i in range(40)], "id int, g string, s string")
    a = sampling.group_split(d, "g", {"train": 0.7, "dev": 0.2, "test": 0.1}, 42, "s")
    b = sampling.group_split(d.repartition(7).orderBy(F.desc("id")), "g", {"train": 0.7, "dev": 0.2, "test": 0.1}, 42, "s")
    one = {r["id"]: r["split"] for r in a.collect()}
    assert one == {r["id"]: r["split"] for r in b.collect()}
    assert all(one[i] == one[i + 1] for i in range(0, 40, 2))


def test_reservation_locks_groups(spark):
    rows = [(f"s{i}", f"g{i // 3}", i == 0) for i in range(60)]
    got = sampling.reserve(spark.createDataFrame(rows, "id string, group_id string, hold boolean"), 7, 4, 0.25, 3, 0.2).collect()
    role = {r["id"]: r["role"] for r in got}
    assert {role[f"s{i}"] for i in range(3)} == {"governance_hold"}
    free = sorted((f"s{i}" for i in range(3, 60)), key=lambda s: (unit(7, "eval_random", s), s))[:4]
    assert {r["id"] for r in got if r["drawn"] and r["role"] == "eval_random"} == set(free)
    by = {}
    for r in got:
        by.setdefault(r["group_id"], set()).add(r["role"])
    assert all(len(v) == 1 for v in by.values())


def plain_quota(rows, n, seed, salt, most):
    used, calls, out = set(), {}, []
    for i, call, dup in sorted(rows, key=lambda r: (unit(seed, salt, r[0]), f"{seed}|{salt}|{r[0]}")):
        if len(out) == n or (dup and dup in used) or (call and calls.get(call, 0) >= most):
            continue
        out.append(i)
        used.add(dup)
        if call:
            calls[call] = calls.get(call, 0) + 1
    return out


def test_quota_equals_the_sequential_rule(spark):
    rnd = random.Random(5)
    rows = [(f"s{i}", rnd.choice([None, *"abcdefg"]), rnd.choice([None, *map(str, range(12))])) for i in range(60)]
    d = spark.createDataFrame(rows, "id string, call string, dup string")
    for n, most in ((8, 2), (60, 1)):
        got = [r["id"] for r in sampling.pick_quota(d, n, 42, "x", most).collect()]
        assert sorted(got) == sorted(plain_quota(rows, n, 42, "x", most))


def test_spot_audit_covers_strata_first(spark):
    d = spark.createDataFrame([(i, "c", f"s{i % 5}") for i in range(50)], "id int, category string, stratum string")
    got = sampling.spot_audit(d, share=0.01, least=7).where("spot_selected").collect()
    assert len(got) == 7 and {r["stratum"] for r in got} == {f"s{k}" for k in range(5)}


def test_rates_and_gates(spark):
    d = spark.createDataFrame([(3, 10), (0, 0)], "k int, n int").select(stats.wilson(F.col("k"), F.col("n")).alias("w"), stats.rate(F.col("k"), F.col("n")).alias("r")).collect()
    assert round(d[0]["w"]["lower"], 4) == 0.1078 and d[0]["r"] == 0.3 and d[1]["w"]["upper"] is None and d[1]["r"] is None
    m = spark.createDataFrame([("nfr", 0.02, 100), ("far", 0.5, 100), ("x", None, 0)], "metric string, value double, denominator long")
    assert metrics.release_gate(m, {"nfr": ("max", 0.1)}).first()["verdict"] == "pass"
    assert metrics.release_gate(m, {"nfr": ("max", 0.1), "far": ("max", 0.1)}).first()["verdict"] == "fail"
    assert metrics.release_gate(m, {"nfr": ("max", None)}).first()["verdict"] == "needs_review"
    assert metrics.release_gate(m, {"gone": ("max", 1.0)}).first()["verdict"] == "incomplete"


def test_business_rates_by_hand(spark):
    rows = [("speech", "negative", "success_text", "positive"), ("speech", "negative", "success_text", "positive"), ("speech", "negative", "success_text", "negative"), ("speech", "negative", "failed", "unknown")]
    d = spark.createDataFrame([(*r, "x", ["noise"], "t") for r in rows], "kind string, semantic string, status string, pred_polarity string, gold_text string, tags array<string>, pred_text string")
    got = {r["metric"]: (r["numerator"], r["denominator"], r["value"]) for r in metrics.business_rates(d, metrics.business_flags(d, ["noise"], ["silence"])).collect()}
    assert got["nfr"] == (2, 3, 0.666667) and got["nahr"] == (0, 0, None) and got["inference_failure_rate"] == (1, 4, 0.25)


def test_bootstrap_forms_agree(spark):
    rows = [(f"g{i}", i % 3, 10, i % 2, 10) for i in range(60)]
    d = spark.createDataFrame(rows, "g string, na int, da int, nb int, db int")
    a = metrics.bootstrap_delta(d, "g", ("na", "da"), ("nb", "db"), 200).first()
    b = metrics.bootstrap_delta(d, "g", ("na", "da"), ("nb", "db"), 200, exact_groups=10).first()
    assert a["low"] < -0.05 < a["high"] and abs(a["low"] - b["low"]) < 0.03 and abs(a["high"] - b["high"]) < 0.03

"""The registered queries over the common tables, each with the SQL that gives the same rows.

Samples are documents or conversation turns. Machine transcripts ("routes") of a
turn are its own text after fixed edits, so routes agree, differ slightly, are
empty or are missing by known rules; all use whole tables and whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import hashing, similarity, stats, text
from corvane.operators import classify, consensus, dataset, metrics, relational, routes, sampling, signal
from corvane.operators.components import connected_components
from corvane.runtime import scratch, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# --- derived tables ----------------------------------------------------------------

FAMILIES = routes.Families({"kimi": ["kimi_1", "kimi_2"], "glm": ["glm_1", "glm_2"], "qwen": ["qwen_1", "qwen_2"]}, target="qwen")

_PLAIN = "regexp_replace(lower(text), '[^a-z0-9 ]', '')"

#: Turns as samples with six routes; also the head of the SQL twins.
_TURNS_SQL = r"""
turns AS (
  SELECT conv_id || '-' || turn AS id, conv_id, turn, role, regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g') AS t, length(text) / 10.0 AS duration FROM conversations),
routes AS (
  SELECT id, conv_id, turn, role, duration, t AS kimi_1, t AS kimi_2,
    CASE WHEN turn % 2 = 1 THEN replace(t, ' the ', ' ') ELSE t END AS glm_1,
    CASE WHEN conv_id % 13 = 0 THEN '' WHEN turn % 2 = 1 THEN replace(t, ' the ', ' ') ELSE t END AS glm_2,
    CASE WHEN (conv_id + turn) % 11 = 0 THEN NULL WHEN conv_id % 7 = 0 THEN '' ELSE replace(t, ' of ', ' off ') END AS qwen_1,
    CASE WHEN conv_id % 7 = 0 THEN '' WHEN conv_id % 17 = 3 THEN replace(t, 'th', 'd') ELSE replace(t, ' of ', ' off ') END AS qwen_2
  FROM turns)"""


def turn_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per turn with its route texts as columns."""
    d = table(spark, sf_dir, "conversations")
    d = d.select(F.concat_ws("-", "conv_id", "turn").alias("id"), "conv_id", "turn", "role", F.expr(_PLAIN).alias("t"), (F.length("text") / 10.0).alias("duration"))
    c, n = F.col("conv_id"), F.col("turn")
    glm = F.when(n % 2 == 1, F.replace("t", F.lit(" the "), F.lit(" "))).otherwise(F.col("t"))
    off = F.replace("t", F.lit(" of "), F.lit(" off "))
    return d.select(
        "id", "conv_id", "turn", "role", "duration", F.col("t").alias("kimi_1"), F.col("t").alias("kimi_2"), glm.alias("glm_1"), F.when(c % 13 == 0, "").otherwise(glm).alias("glm_2"),
        F.when((c + n) % 11 == 0, None).when(c % 7 == 0, "").otherwise(off).alias("qwen_1"), F.when(c % 7 == 0, "").when(c % 17 == 3, F.replace("t", F.lit("th"), F.lit("d"))).otherwise(off).alias("qwen_2"),
    )


RUNS = ["kimi_1", "kimi_2", "glm_1", "glm_2", "qwen_1", "qwen_2"]


def route_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as samples: id, duration and the transcripts map; a null text is a missing route."""
    d = turn_routes(spark, sf_dir)
    entry = lambda c: F.struct(F.col(c).alias("text"), F.lit(c).alias("model"), F.lit(None).cast("string").alias("version"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("status"), F.lit(None).cast("map<string,string>").alias("extra"))
    return d.select("id", "conv_id", "turn", "role", "duration", F.create_map(*[x for r in RUNS for x in (F.lit(r), entry(r))]).alias("transcripts"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels and content digest."""
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left").withColumn("sha256", F.sha2("text", 256))


_DOCS_SQL = "docs AS (SELECT d.*, l.quality, l.toxic, sha256(d.text) AS sha256 FROM documents d LEFT JOIN labels l USING (doc_id))"
_UNIT = "(('0x' || substr(sha256({}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0)"


def _unit_sql(*parts: str) -> str:
    return _UNIT.format(" || chr(0) || ".join(parts))


# --- filters, projections, joins ------------------------------------------------------


@query("manifest_stats", """SELECT source, count(*) AS files, round(sum(n_chars) / 10.0 / 3600, 2) AS hours, count(*) FILTER (lang IS NULL) AS unknown_lang, count(DISTINCT lang) AS langs
  FROM documents GROUP BY source""")
def manifest_stats(spark, sf):
    d = table(spark, sf, "documents")
    return d.groupBy("source").agg(F.count("*").alias("files"), F.round(F.sum("n_chars") / 10.0 / 3600, 2).alias("hours"), F.count_if(F.col("lang").isNull()).alias("unknown_lang"), F.countDistinct("lang").alias("langs"))


@query("histogram", "SELECT coalesce(lang, 'unknown') AS value, count(*) AS n FROM documents GROUP BY 1")
def histogram(spark, sf):
    return relational.histogram(table(spark, sf, "documents"), F.col("lang"))


@query("select_nullsafe", f"WITH {_DOCS_SQL} SELECT doc_id, quality FROM docs WHERE quality IS DISTINCT FROM 1 AND coalesce(n_chars > 300, false)")
def select_nullsafe(spark, sf):
    return relational.select_rows(documents(spark, sf), "quality != 1 and n_chars > 300").select("doc_id", "quality")


@query("filter_mark", f"WITH {_DOCS_SQL} SELECT doc_id, coalesce(quality = 0, false) OR NOT coalesce(lang IN ('en', 'de'), false) AS filter_pass FROM docs")
def filter_mark(spark, sf):
    return relational.mark_rows(documents(spark, sf), "quality == 0 or lang not in ['en', 'de']").select("doc_id", "filter_pass")


@query("filter_by_id", "SELECT conv_id, turn, role FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations WHERE length(text) > 900)")
def filter_by_id(spark, sf):
    d = table(spark, sf, "conversations").withColumn("size", F.length("text"))
    return relational.filter_by_id(d, "size > 900", "conv_id").select("conv_id", "turn", "role")


@query("transcript_diff", f"WITH {_TURNS_SQL} SELECT id, CASE WHEN coalesce(qwen_1, '') = coalesce(qwen_2, '') THEN 'match' ELSE 'mismatch' END AS transcript_diff FROM routes")
def transcript_diff(spark, sf):
    return relational.transcript_diff(route_samples(spark, sf), "qwen_1", "qwen_2").select("id", "transcript_diff")


@query("copy_transcripts", f"WITH {_TURNS_SQL} SELECT id, CASE WHEN trim(coalesce(qwen_1, '')) = '' THEN kimi_1 ELSE qwen_1 END AS qwen_1, kimi_1 AS backup FROM routes")
def copy_transcripts(spark, sf):
    d = relational.copy_transcripts(route_samples(spark, sf), {"kimi_1": "qwen_1"})
    d = relational.copy_transcripts(d, {"kimi_1": "backup"})
    of = lambda m: F.try_element_at("transcripts", F.lit(m))["text"]
    return d.select("id", of("qwen_1").alias("qwen_1"), of("backup").alias("backup"))


@query("route_compare", f"""WITH {_TURNS_SQL} SELECT count(*) AS total, count(*) FILTER (coalesce(kimi_1, '') = coalesce(qwen_1, '')) AS match,
  count(*) FILTER (coalesce(kimi_1, '') <> coalesce(qwen_1, '')) AS mismatch, round(count(*) FILTER (coalesce(kimi_1, '') = coalesce(qwen_1, '')) / count(*), 4) AS match_rate FROM routes""")
def route_compare(spark, sf):
    return relational.compare(turn_routes(spark, sf), "kimi_1", "qwen_1")


@query("join_exact_report", """WITH a AS (SELECT doc_id AS k, sha256(text) AS da FROM documents), b AS (SELECT l.doc_id AS k, CASE WHEN toxic = 1 THEN 'x' WHEN quality = 1 THEN '' ELSE sha256(d.text) END AS db FROM labels l JOIN documents d USING (doc_id)
  UNION ALL SELECT -1 - item_id, NULL FROM benchmark),
  j AS (SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'extra' WHEN coalesce(da, '') = '' OR coalesce(db, '') = '' THEN 'unchecked' WHEN da <> db THEN 'mismatch' ELSE 'same' END AS kind FROM a FULL JOIN b ON a.k = b.k)
  SELECT count(*) FILTER (kind = 'missing') AS missing_ids, count(*) FILTER (kind = 'extra') AS extra_ids, count(*) FILTER (kind = 'mismatch') AS hash_mismatches, count(*) FILTER (kind = 'unchecked') AS hash_unchecked, count(*) FILTER (kind = 'same') AS hash_equal,
  (SELECT string_agg(k::VARCHAR, ',' ORDER BY k) FROM (SELECT k FROM j WHERE kind = 'missing' ORDER BY k LIMIT 20)) AS missing_examples FROM j""")
def join_exact_report(spark, sf):
    d, lab, b = table(spark, sf, "documents"), table(spark, sf, "labels"), table(spark, sf, "benchmark")
    base = d.select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("sha256"))
    other = lab.join(base, lab["doc_id"] == base["id"]).select("id", F.when(F.col("toxic") == 1, "x").when(F.col("quality") == 1, "").otherwise(F.col("sha256")).alias("sha256"))
    other = other.union(b.select((-1 - F.col("item_id")).alias("id"), F.lit(None).cast("string").alias("sha256")))
    r = relational.alignment_report(base, other)
    return r.select("missing_ids", "extra_ids", "hash_mismatches", "hash_unchecked", "hash_equal", F.array_join(F.transform("missing_examples", lambda x: x.cast("string")), ",").alias("missing_examples"))


@query("route_integrity", f"""WITH {_TURNS_SQL}, l AS (SELECT unnest(['kimi_1', 'kimi_2', 'glm_1', 'glm_2', 'qwen_1', 'qwen_2']) AS run_id, unnest([kimi_1, kimi_2, glm_1, glm_2, qwen_1, qwen_2]) AS t FROM routes)
  SELECT run_id, count(t) AS success, count(*) FILTER (t IS NULL) AS missing, 0::BIGINT AS failed FROM l GROUP BY run_id""")
def route_integrity(spark, sf):
    return routes.route_integrity(routes.explode_routes(route_samples(spark, sf), FAMILIES, unicode=False))


@query("join_left_missing", """SELECT d.source, count(*) AS total, count(l.doc_id) AS joined, count(*) FILTER (l.doc_id IS NULL) AS missing, sum(l.toxic) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.source""")
def join_left_missing(spark, sf):
    d = documents(spark, sf)
    return d.groupBy("source").agg(F.count("*").alias("total"), F.count("quality").alias("joined"), F.count_if(F.col("quality").isNull()).alias("missing"), F.sum("toxic").alias("toxic"))


@query("sidecar_merge", f"WITH {_DOCS_SQL} SELECT doc_id AS id, sha256, CASE WHEN quality IS NOT NULL THEN toxic * 2 + quality END AS score FROM docs")
def sidecar_merge(spark, sf):
    d = documents(spark, sf)
    side = d.where("quality is not null").select(F.col("doc_id").alias("id"), "sha256", (F.col("toxic") * 2 + F.col("quality")).alias("score"))
    return relational.sidecar_merge(d.select(F.col("doc_id").alias("id"), "sha256"), side, columns=["score"]).select("id", "sha256", "score")


@query("inject_gold", "SELECT d.doc_id AS id, d.lang, 'q' || l.quality AS gold_text FROM documents d JOIN labels l USING (doc_id)")
def inject_gold(spark, sf):
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    return relational.inject_gold(d.select(F.col("doc_id").alias("id"), "lang"), lab.select(F.col("doc_id").alias("id"), F.concat(F.lit("q"), "quality").alias("gold_text"))).select("id", "lang", "gold_text")


@query("id_set_diff", "SELECT doc_id AS id, 'left' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'right' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def id_set_diff(spark, sf):
    k = lambda n: table(spark, sf, n).select(F.col("doc_id").alias("id"))
    return relational.one_sided(k("documents"), k("labels"))


@query("union_sources", "SELECT 'documents' AS origin, count(*) AS n, sum(length(text)) AS chars FROM documents UNION ALL SELECT 'benchmark', count(*), sum(length(text)) FROM benchmark UNION ALL SELECT 'conversations', count(*), sum(length(text)) FROM conversations")
def union_sources(spark, sf):
    out = None
    for n in ("documents", "benchmark", "conversations"):
        d = table(spark, sf, n).select(F.lit(n).alias("origin"), "text")
        out = d if out is None else out.unionByName(d)
    return out.groupBy("origin").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("id_intersect", "SELECT c_custkey AS id FROM customer INTERSECT SELECT o_custkey FROM orders")
def id_intersect(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id")).intersect(table(spark, sf, "orders").select("o_custkey"))


@query("merge_dedup", "SELECT DISTINCT sha256(text) AS sha256, source AS id FROM documents")
def merge_dedup(spark, sf):
    d = table(spark, sf, "documents").select(F.col("source").alias("id"), F.sha2("text", 256).alias("sha256"), F.lit("p").alias("source_path"))
    return relational.merge_dedup(d, d).select("id", "sha256")


@query("shard_hash", "SELECT (('0x' || substr(sha256(text), 1, 16))::UBIGINT % 7)::INT AS shard, count(*) AS n FROM documents GROUP BY 1")
def shard_hash(spark, sf):
    d = table(spark, sf, "documents").select(F.sha2("text", 256).alias("sha256"), F.lit("p").alias("source_path"))
    return relational.with_shard(d, 7).groupBy("shard").agg(F.count("*").alias("n"))


@query("balanced_shards", """WITH RECURSIVE o AS (SELECT row_number() OVER (ORDER BY n_chars DESC NULLS LAST, coalesce(sha256(text), sha256('p')), doc_id) AS i, doc_id AS id, coalesce(n_chars / 10.0, 1.0)::DOUBLE AS w FROM documents),
  r AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS id, 0 AS shard, [0.0::DOUBLE, 0, 0, 0, 0, 0, 0, 0] AS loads UNION ALL SELECT o.i, o.id, (list_position(loads, list_min(loads)) - 1)::INT, list_transform(loads, lambda x, j: CASE WHEN j = list_position(loads, list_min(loads)) THEN x + w ELSE x END) FROM r JOIN o ON o.i = r.i + 1)
  SELECT id, shard FROM r WHERE i > 0""")
def balanced_shards(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("sha256"), F.lit("p").alias("source_path"), (F.col("n_chars") / 10.0).alias("duration"))
    return relational.balanced_shards(d, 8)


@query("snapshot_alignment", """WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders), b AS (SELECT l_orderkey AS k, CASE WHEN bool_and(l_linestatus = 'F') THEN 'F' WHEN bool_and(l_linestatus = 'O') THEN 'O' ELSE 'P' END AS s FROM lineitem GROUP BY 1)
  SELECT problem, count(*) AS n FROM (SELECT CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'extra' WHEN a.s IS DISTINCT FROM b.s THEN 's_differs' END AS problem FROM a FULL JOIN b ON a.k = b.k) WHERE problem IS NOT NULL GROUP BY 1""")
def snapshot_alignment(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.when(F.bool_and(F.col("l_linestatus") == "F"), "F").when(F.bool_and(F.col("l_linestatus") == "O"), "O").otherwise("P").alias("s"))
    return relational.snapshot_alignment(a, li, "k", ["s"])


@query("leak_semi", f"""WITH {_DOCS_SQL}, s AS (SELECT *, doc_id % 10 < 2 AS held FROM docs), t AS (SELECT * FROM s WHERE NOT held), h AS (SELECT * FROM s WHERE held)
  SELECT 'sha256' AS kind, count(*) AS train_rows, count(DISTINCT sha256) AS keys FROM t WHERE sha256 IN (SELECT sha256 FROM h)
  UNION ALL SELECT 'source', count(*), count(DISTINCT source) FROM t WHERE source IN (SELECT source FROM h WHERE source <> '')
  UNION ALL SELECT 'doc_id', count(*), count(DISTINCT doc_id) FROM t WHERE doc_id IN (SELECT doc_id FROM h)""")
def leak_semi(spark, sf):
    d = documents(spark, sf).withColumn("held", F.col("doc_id") % 10 < 2)
    return relational.leakage(d.where("not held"), d.where("held"), ["sha256", "source", "doc_id"])


@query("cross_split_leak", f"""WITH {_DOCS_SQL}, s AS (SELECT *, CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'dev' ELSE 'test' END AS split FROM docs)
  SELECT 'sha256' AS kind, sha256 AS value, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM s GROUP BY sha256 HAVING count(DISTINCT split) > 1""")
def cross_split_leak(spark, sf):
    r = F.col("doc_id") % 10
    d = documents(spark, sf).withColumn("split", F.when(r < 7, "train").when(r < 9, "dev").otherwise("test"))
    return relational.cross_split(d, "split", ["sha256"]).select("kind", "value", F.array_join("splits", ",").alias("splits"))


@query("score_once", "WITH u AS (SELECT DISTINCT sha256(text) AS h, length(text) % 97 AS score FROM documents) SELECT doc_id, u.score FROM documents JOIN u ON sha256(text) = u.h")
def score_once(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", F.sha2("text", 256).alias("h"))
    return relational.score_once(d, "h", lambda one: one.select("h", (F.length("text") % 97).cast("long").alias("score"))).select("doc_id", "score")


@query("reconcile", f"""WITH {_TURNS_SQL}, j AS (SELECT id, kimi_1 AS a0, qwen_2 AS b0, turn % 3 <> 2 AS there FROM routes), n AS (SELECT id, replace(a0, ' ', '') AS a, CASE WHEN there THEN replace(coalesce(b0, ''), ' ', '') ELSE '' END AS b, there FROM j),
  s AS (SELECT *, CASE WHEN greatest(length(a), length(b)) = 0 THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 ELSE round(1 - levenshtein(a, b) / greatest(length(a), length(b)), 4) END AS similarity FROM n)
  SELECT id, similarity, CASE WHEN NOT there THEN 'no_result' WHEN a = '' AND b = '' THEN 'both_empty' WHEN a = '' OR b = '' THEN 'one_empty' WHEN similarity >= 0.98 THEN 'similar' ELSE 'different' END AS reason FROM s""")
def reconcile(spark, sf):
    d = turn_routes(spark, sf)
    return relational.reconcile(d.select("id", "kimi_1"), d.where("turn % 3 <> 2").select("id", "qwen_2"), "id", "kimi_1", "qwen_2", 0.98, unicode=False).select("id", "similarity", "reason")


# --- text and similarity ------------------------------------------------------------------


@query("text_normalize", r"""SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(lower(text), '<\|.*?\|>', '', 'g'), '\p{P}', '', 'g'), '\s+', '', 'g')) AS digest FROM documents""")
def text_normalize(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(text.normalize_text(F.col("text"), unicode=False), 256).alias("digest"))


@query("comparison_text", r"""SELECT doc_id, length(regexp_replace(translate(trim(text), '，。！？、；：""''''（）【】《》…—·,.!?;:''"()[]{}', ''), '\s+', '', 'g')) AS n FROM documents""")
def comparison_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.length(text.comparison_text(F.col("text"), unicode=False)).cast("long").alias("n"))


@query("lang_detect", r"""WITH c AS (SELECT doc_id, length(regexp_replace(text, '[^一-鿿]', '', 'g')) AS cjk, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS latin, trim(text) = '' AS blank FROM documents)
  SELECT doc_id, CASE WHEN blank THEN 'empty' WHEN cjk + latin = 0 THEN 'unknown' WHEN cjk / (cjk + latin) >= 0.2 AND latin / (cjk + latin) >= 0.2 THEN 'mixed' WHEN cjk / (cjk + latin) >= 0.8 THEN 'zh' WHEN latin / (cjk + latin) >= 0.8 THEN 'en' ELSE 'unknown' END AS language FROM c""")
def lang_detect(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.detect_language(F.col("text")).alias("language"))


_NEG, _POS = ["not", "never", "nothing"], ["the", "and", "yes"]


@query("semantic_class", "SELECT doc_id, CASE WHEN trim(text) = '' THEN 'none' WHEN regexp_matches(text, 'nothing|never|not') THEN 'negative' WHEN regexp_matches(text, 'and|the|yes') THEN 'positive' ELSE 'none' END AS class FROM documents")
def semantic_class(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.semantic_class(F.col("text"), _NEG, _POS).alias("class"))


@query("polarity", r"""WITH v AS (SELECT doc_id, trim(text) AS t FROM documents), p AS (SELECT doc_id, t, regexp_matches(t, 'nothing|never|not') AS neg, regexp_matches(regexp_replace(t, 'nothing|never|not', '', 'g'), 'and|the|yes') AS pos FROM v)
  SELECT doc_id, CASE WHEN t = '' THEN 'unknown' WHEN neg AND pos THEN 'mixed' WHEN neg THEN 'negative' WHEN pos THEN 'positive' ELSE 'unknown' END AS polarity FROM p""")
def polarity(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.polarity(F.col("text"), _NEG, _POS, ["hm"]).alias("polarity"))


@query("number_set", r"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[0-9]+(?:\.[0-9]+)?'))), ',') AS numbers FROM documents")
def number_set(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(text.number_set(F.col("text")), ",").alias("numbers"))


@query("resolve_family", f"""WITH {_TURNS_SQL}, l AS (SELECT unnest(['kimi_1', 'glm_2', 'qwen1', 'sensevoice9', 'other', ' ']) AS model FROM routes) SELECT model, CASE model WHEN 'kimi_1' THEN 'kimi' WHEN 'glm_2' THEN 'glm_2' WHEN 'qwen1' THEN 'qwen' WHEN 'sensevoice9' THEN 'sensevoice' WHEN 'other' THEN 'other' ELSE 'unknown' END AS family, count(*) AS n FROM l GROUP BY 1, 2""")
def resolve_family(spark, sf):
    from corvane.operators import lexicon

    d = turn_routes(spark, sf).select(F.explode(F.array(*[F.lit(x) for x in ("kimi_1", "glm_2", "qwen1", "sensevoice9", "other", " ")])).alias("model"))
    return d.select("model", text.resolve_family(F.col("model"), lexicon.FAMILIES).alias("family")).groupBy("model", "family").agg(F.count("*").alias("n"))


@query("similarity_pairs", f"""WITH {_TURNS_SQL}, s AS (SELECT id, kimi_1 AS a, coalesce(qwen_2, '') AS b, levenshtein(kimi_1, coalesce(qwen_2, '')) AS d FROM routes)
  SELECT id, d::INT AS edits, CASE WHEN greatest(length(a), length(b)) = 0 THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 ELSE round(1 - d / greatest(length(a), length(b)), 6) END AS similarity,
  CASE WHEN greatest(length(a), length(b)) = 0 THEN NULL WHEN a = '' OR b = '' THEN 1.0 ELSE round(d / greatest(length(a), length(b)), 6) END AS distance FROM s""")
def similarity_pairs(spark, sf):
    a, b = F.col("kimi_1"), F.coalesce("qwen_2", F.lit(""))
    return turn_routes(spark, sf).select("id", similarity.edits(a, b).alias("edits"), similarity.text_similarity(a, b).alias("similarity"), similarity.symmetric_distance(a, b).alias("distance"))


@query("pairwise_min", f"""WITH {_TURNS_SQL}, l AS (SELECT id, unnest(['kimi_1', 'glm_1', 'qwen_2']) AS k, unnest([kimi_1, glm_1, qwen_2]) AS t FROM routes), v AS (SELECT * FROM l WHERE t <> ''),
  p AS (SELECT x.id, min(CASE WHEN x.t = y.t THEN 1.0 ELSE round(1 - levenshtein(x.t, y.t) / greatest(length(x.t), length(y.t)), 6) END) AS m FROM v x JOIN v y ON x.id = y.id AND x.k < y.k GROUP BY 1), n AS (SELECT id, count(*) AS c FROM v GROUP BY 1)
  SELECT r.id, CASE WHEN n.c IS NULL THEN NULL WHEN n.c = 1 THEN 1.0 ELSE p.m END AS min_similarity FROM routes r LEFT JOIN n USING (id) LEFT JOIN p USING (id)""")
def pairwise_min(spark, sf):
    t = F.filter(F.array("kimi_1", "glm_1", "qwen_2"), lambda x: F.coalesce(x, F.lit("")) != "")
    return turn_routes(spark, sf).select("id", similarity.pairwise_min(t).alias("min_similarity"))


# --- metrics --------------------------------------------------------------------------------


def _scored(spark, sf) -> DataFrame:
    d = turn_routes(spark, sf).withColumn("type", F.col("role"))
    return metrics.edit_metrics(d.select("id", "type", "kimi_1", "glm_1", "qwen_1", "qwen_2"), "kimi_1", {"glm": "glm_1", "qwen": "qwen_2"}, unicode=False)


_SCORED_SQL = _TURNS_SQL + """, l AS (SELECT id, role AS type, unnest(['glm', 'qwen']) AS model, replace(kimi_1, ' ', '') AS r, replace(coalesce(unnest([glm_1, qwen_2]), ''), ' ', '') AS h FROM routes),
s AS (SELECT *, levenshtein(r, h) AS d, length(r) AS n FROM l)"""


@query("cer_corpus", f"WITH {_SCORED_SQL} SELECT model, count(*) AS samples, sum(d)::BIGINT AS errors, sum(n)::BIGINT AS reference_length, round(sum(d) / greatest(sum(n), 1), 9) AS corpus_cer FROM s GROUP BY model")
def cer_corpus(spark, sf):
    return metrics.corpus(_scored(spark, sf), "model").select("model", "samples", "errors", "reference_length", F.round("corpus_cer", 9).alias("corpus_cer"))


@query("edit_kinds")
def edit_kinds(spark, sf):
    """Edits by kind; the oracle of the sum is cer_corpus, the kinds are tested against a plain program."""
    return _scored(spark, sf).select("id", "model", "substitutions", "deletions", "insertions", "reference_length", "cer")


@query("cer_rollup", f"""WITH {_SCORED_SQL}, g AS (SELECT model, coalesce(type, 'all') AS grp, count(*) AS rows, 0::BIGINT AS skipped, sum(d)::BIGINT AS edits, sum(n)::BIGINT AS reference_length,
  avg(greatest(0.0, 1 - round(d / greatest(n, 1), 6))) AS m FROM s GROUP BY GROUPING SETS ((model, type), (model)))
  SELECT model, grp, rows, skipped, edits, reference_length, CASE WHEN reference_length = 0 THEN CASE WHEN edits > 0 THEN 0.0 ELSE 1.0 END ELSE round(greatest(0.0, 1 - edits / reference_length), 6) END AS overall_acc, round(m, 5) AS mean_acc FROM g""")
def cer_rollup(spark, sf):
    return metrics.summary(_scored(spark, sf)).withColumn("mean_acc", F.round("mean_acc", 5))


@query("vs_base_delta", f"""WITH {_SCORED_SQL}, g AS (SELECT model, coalesce(type, 'all') AS grp, round(greatest(0.0, 1 - sum(d) / sum(n)), 6) AS acc FROM s GROUP BY GROUPING SETS ((model, type), (model)))
  SELECT model, grp, CASE WHEN model <> 'glm' THEN round(acc - max(CASE WHEN model = 'glm' THEN acc END) OVER (PARTITION BY grp), 6) END AS overall_delta FROM g""")
def vs_base_delta(spark, sf):
    return metrics.vs_base(metrics.summary(_scored(spark, sf)), "glm").select("model", "grp", "overall_delta")


def _facts(spark, sf) -> DataFrame:
    """Reference facts from labels and length, predictions from the routes of turns of the same number."""
    d = documents(spark, sf)
    n = F.col("doc_id") % 5
    return d.select(
        F.col("doc_id").alias("id"), F.col("source"), F.when(F.col("toxic") == 1, "non_speech").otherwise("speech").alias("kind"),
        F.when(F.col("quality").isNull(), "unknown").when(F.col("quality") == 1, "positive").when(F.col("toxic") == 0, "negative").otherwise("neutral").alias("semantic"),
        F.when(F.col("toxic") == 1, "").otherwise(F.substring("lang", 1, 2)).alias("gold_text"), F.array(F.when(n == 0, "silence").when(n == 1, "noise").otherwise("other")).alias("tags"),
        F.when(n == 4, "failed").when(n == 3, "success_empty").otherwise("success_text").alias("status"), F.when(n >= 3, "unknown").when(F.col("n_chars") % 3 == 0, "positive").when(F.col("n_chars") % 3 == 1, "negative").otherwise("mixed").alias("pred_polarity"),
        F.when(n >= 3, "").otherwise(F.col("lang")).alias("pred_text"),
    )


_FACTS_SQL = _DOCS_SQL + """, f AS (SELECT doc_id AS id, source, CASE WHEN toxic = 1 THEN 'non_speech' ELSE 'speech' END AS kind,
  CASE WHEN quality IS NULL THEN 'unknown' WHEN quality = 1 THEN 'positive' WHEN toxic = 0 THEN 'negative' ELSE 'neutral' END AS semantic, CASE WHEN doc_id % 5 = 0 THEN 'silence' WHEN doc_id % 5 = 1 THEN 'noise' ELSE 'other' END AS tag,
  CASE doc_id % 5 WHEN 4 THEN 'failed' WHEN 3 THEN 'success_empty' ELSE 'success_text' END AS status, CASE WHEN doc_id % 5 >= 3 THEN 'unknown' WHEN n_chars % 3 = 0 THEN 'positive' WHEN n_chars % 3 = 1 THEN 'negative' ELSE 'mixed' END AS pol,
  CASE WHEN doc_id % 5 >= 3 THEN '' ELSE lang END AS ptext FROM docs),
m AS (SELECT source, unnest([
  {'metric': 'nfr', 'hit': pol = 'positive', 'ok': semantic = 'negative' AND status <> 'failed'}, {'metric': 'far', 'hit': pol = 'positive', 'ok': status <> 'failed' AND semantic NOT IN ('mixed', 'unknown') AND (kind = 'non_speech' OR semantic IN ('negative', 'neutral'))},
  {'metric': 'nahr', 'hit': pol = 'positive', 'ok': kind = 'non_speech' AND tag = 'noise' AND status <> 'failed'}, {'metric': 'nahr_silence', 'hit': pol = 'positive', 'ok': kind = 'non_speech' AND tag = 'silence' AND status <> 'failed'},
  {'metric': 'faer', 'hit': false, 'ok': false}, {'metric': 'nshr', 'hit': trim(ptext) <> '', 'ok': kind = 'non_speech' AND status <> 'failed'},
  {'metric': 'positive_retention', 'hit': pol = 'positive', 'ok': semantic = 'positive' AND status <> 'failed'}, {'metric': 'inference_failure_rate', 'hit': status = 'failed', 'ok': true},
  {'metric': 'semantic_unk_rate', 'hit': pol IN ('mixed', 'unknown'), 'ok': status <> 'failed'},
  {'metric': 'far_unk_as_risk_upper', 'hit': pol IN ('positive', 'mixed', 'unknown'), 'ok': status <> 'failed' AND semantic NOT IN ('mixed', 'unknown') AND (kind = 'non_speech' OR semantic IN ('negative', 'neutral'))}], recursive := true) FROM f)"""


def _rates(d: DataFrame, *by: str) -> DataFrame:
    return metrics.business_rates(d, metrics.business_flags(d, ["noise"], ["silence"]), *by)


@query("business_rates", f"""WITH {_FACTS_SQL} SELECT source, metric, count(*) FILTER (coalesce(hit AND ok, false)) AS numerator, count(*) FILTER (ok) AS denominator,
  CASE WHEN count(*) FILTER (ok) > 0 THEN round(count(*) FILTER (coalesce(hit AND ok, false)) / count(*) FILTER (ok), 6) END AS value FROM m GROUP BY source, metric""")
def business_rates(spark, sf):
    return _rates(_facts(spark, sf), "source")


@query("business_slices", f"WITH {_DOCS_SQL}, s AS (SELECT unnest(list_filter(['all', CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN n_chars <= 200 THEN 'short' END], lambda x: x IS NOT NULL)) AS slice FROM docs) SELECT slice, count(*) AS n FROM s GROUP BY slice")
def business_slices(spark, sf):
    return metrics.sliced(documents(spark, sf), {"toxic": F.col("toxic") == 1, "short": F.col("n_chars") <= 200}).groupBy("slice").agg(F.count("*").alias("n"))


@query("wilson_by_source", f"""WITH {_DOCS_SQL}, a AS (SELECT source, count(quality) AS n, sum(quality) AS k FROM docs GROUP BY source), b AS (SELECT *, k / n AS p FROM a WHERE n > 0)
  SELECT source, n, k, round(greatest((p + 3.8416 / (2 * n)) / (1 + 3.8416 / n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n), 0), 9) AS lower,
  round(least((p + 3.8416 / (2 * n)) / (1 + 3.8416 / n) + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n), 1), 9) AS upper FROM b UNION ALL SELECT source, n, k, NULL, NULL FROM a WHERE n = 0""")
def wilson_by_source(spark, sf):
    a = documents(spark, sf).groupBy("source").agg(F.count("quality").alias("n"), F.sum("quality").alias("k")).withColumn("w", stats.wilson(F.col("k"), F.col("n")))
    return a.select("source", "n", "k", F.round(F.col("w")["lower"], 9).alias("lower"), F.round(F.col("w")["upper"], 9).alias("upper"))


@query("completeness", f"""WITH {_FACTS_SQL} SELECT count(*) AS expected, count(*) FILTER (status <> 'failed') AS complete, count(*) FILTER (status = 'failed') AS incomplete,
  (SELECT string_agg(id::VARCHAR, ',' ORDER BY id) FROM (SELECT id FROM f WHERE status = 'failed' ORDER BY id LIMIT 200)) AS incomplete_examples FROM f""")
def completeness(spark, sf):
    r = metrics.completeness(_facts(spark, sf))
    return r.select("expected", "complete", "incomplete", F.array_join(F.transform("incomplete_examples", lambda x: x.cast("string")), ",").alias("incomplete_examples"))


@query("bootstrap_delta")
def bootstrap_delta(spark, sf):
    d = _scored(spark, sf).groupBy("id").pivot("model", ["glm", "qwen"]).agg(F.sum(F.col("substitutions") + F.col("deletions") + F.col("insertions")).alias("e"), F.sum("reference_length").alias("n"))
    return metrics.bootstrap_delta(d, "id", ("glm_e", "glm_n"), ("qwen_e", "qwen_n"), 200)


@query("release_gate", f"""WITH {_FACTS_SQL}, r AS (SELECT metric, count(*) FILTER (ok) AS d, count(*) FILTER (coalesce(hit AND ok, false)) / nullif(count(*) FILTER (ok), 0) AS v FROM m GROUP BY metric),
  t AS (SELECT * FROM (VALUES ('nfr', 'max', 0.9), ('far', 'max', 0.01), ('faer', 'max', 0.5), ('positive_retention', 'min', NULL)) x(metric, how, lim)),
  s AS (SELECT metric, CASE WHEN d IS NULL THEN 'incomplete' WHEN lim IS NULL OR d < 30 OR v IS NULL THEN 'needs_review' WHEN (how = 'max' AND round(v, 6) <= lim) OR (how = 'min' AND round(v, 6) >= lim) THEN 'pass' ELSE 'fail' END AS state FROM t LEFT JOIN r USING (metric))
  SELECT CASE WHEN bool_or(state = 'incomplete') THEN 'incomplete' WHEN bool_or(state = 'fail') THEN 'fail' WHEN bool_or(state = 'needs_review') THEN 'needs_review' ELSE 'pass' END AS verdict, coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (state = 'fail'), '') AS failed, coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (state = 'needs_review'), '') AS open FROM s""")
def release_gate(spark, sf):
    g = metrics.release_gate(_rates(_facts(spark, sf)), {"nfr": ("max", 0.9), "far": ("max", 0.01), "faer": ("max", 0.5), "positive_retention": ("min", None)})
    return g.select("verdict", F.array_join("failed", ",").alias("failed"), F.array_join("open", ",").alias("open"))


# --- draws -----------------------------------------------------------------------------------


@query("split_grouped", f"""WITH g AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2), p AS (SELECT source, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS r FROM g) WHERE r = 1),
  s AS (SELECT source, {_unit_sql("'42'", "lang", "source")} AS u FROM p)
  SELECT CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.8999999999999999 THEN 'dev' ELSE 'test' END AS split, count(*) AS n, count(DISTINCT d.source) AS groups FROM documents d JOIN s USING (source) GROUP BY 1""")
def split_grouped(spark, sf):
    d = sampling.group_split(table(spark, sf, "documents"), "source", {"train": 0.7, "dev": 0.2, "test": 0.1}, 42, "lang")
    return d.groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("source").alias("groups"))


_RESERVE_SQL = f"""
s AS (SELECT conv_id || '-' || turn AS id, 'g' || conv_id AS gid, conv_id % 19 = 0 AND turn = 0 AS hold FROM conversations),
held AS (SELECT DISTINCT gid FROM s WHERE hold), free AS (SELECT * FROM s WHERE gid NOT IN (SELECT gid FROM held)),
drawn AS (SELECT id, gid FROM free ORDER BY {_unit_sql("'42'", "'eval_random'", "id")}, id LIMIT 20), taken AS (SELECT DISTINCT gid FROM drawn),
rest AS (SELECT gid, {_unit_sql("'42'", "'eval_core_reserve'", "gid")} < 0.15 AS core FROM (SELECT DISTINCT gid FROM free WHERE gid NOT IN (SELECT gid FROM taken))),
cal AS (SELECT gid FROM rest WHERE NOT core ORDER BY {_unit_sql("'42'", "'calibration_group'", "gid")}, gid LIMIT 10),
aft AS (SELECT gid, row_number() OVER (ORDER BY {_unit_sql("'42'", "'dev_group'", "gid")}, gid) AS r, count(*) OVER () AS n FROM rest WHERE NOT core AND gid NOT IN (SELECT gid FROM cal)),
picks AS (SELECT id FROM (SELECT id, gid, row_number() OVER (PARTITION BY gid ORDER BY {_unit_sql("'42'", "'calibration_sample'", "id")}, id) AS r FROM free WHERE gid IN (SELECT gid FROM cal)) WHERE r = 1)"""


def _reservation(spark, sf) -> DataFrame:
    s = table(spark, sf, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), F.concat(F.lit("g"), "conv_id").alias("group_id"), ((F.col("conv_id") % 19 == 0) & (F.col("turn") == 0)).alias("hold"))
    return sampling.reserve(s, 42, 20, 0.15, 10, 0.1)


@query("reservation", f"""WITH {_RESERVE_SQL} SELECT s.id, s.gid AS group_id, CASE WHEN s.gid IN (SELECT gid FROM held) THEN 'governance_hold' WHEN s.gid IN (SELECT gid FROM taken) THEN 'eval_random' WHEN s.gid IN (SELECT gid FROM rest WHERE core) THEN 'eval_core_reserve'
  WHEN s.gid IN (SELECT gid FROM cal) THEN 'calibration' WHEN s.gid IN (SELECT gid FROM aft WHERE r <= floor(n * 0.1)) THEN 'dev' ELSE 'train_pool' END AS role, s.id IN (SELECT id FROM drawn UNION ALL SELECT id FROM picks) AS drawn FROM s""")
def reservation(spark, sf):
    return _reservation(spark, sf)


@query("group_balanced", f"""WITH g AS (SELECT source FROM (SELECT DISTINCT source FROM documents) ORDER BY {_unit_sql("'7'", "'audit_group'", "source")}, source LIMIT 12)
  SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY {_unit_sql("'7'", "'audit_sample'", "doc_id::VARCHAR")}, doc_id::VARCHAR) AS r FROM documents WHERE source IN (SELECT source FROM g)) WHERE r = 1""")
def group_balanced(spark, sf):
    return sampling.one_per_group(table(spark, sf, "documents"), "source", 12, 7, "audit", "doc_id")


@query("spot_audit", """WITH d AS (SELECT doc_id, lang AS category, source AS stratum FROM documents), f AS (SELECT *, row_number() OVER (PARTITION BY category, stratum ORDER BY sha256('spot_audit' || chr(0) || category || chr(0) || doc_id), doc_id) = 1 AS lead, count(*) OVER (PARTITION BY category) AS n FROM d),
  r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY lead DESC, CASE WHEN lead THEN stratum END, sha256('spot_audit' || chr(0) || category || chr(0) || 'fill' || chr(0) || doc_id), doc_id) AS rk, least(n, greatest(100, ceil(n * 0.01)))::BIGINT AS spot_quota FROM f)
  SELECT doc_id, spot_quota, rk <= spot_quota AS spot_selected FROM r""")
def spot_audit(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("category"), F.col("source").alias("stratum"))
    return sampling.spot_audit(d, key="doc_id").select("doc_id", "spot_quota", "spot_selected")


@query("weighted_pick", f"""WITH {_TURNS_SQL}, l AS (SELECT id, unnest(['kimi', 'glm', 'qwen']) AS family, unnest([1, 2, 3]) AS k, unnest([kimi_1, glm_1, qwen_2]) AS t FROM routes), v AS (SELECT *, CASE WHEN family = 'qwen' THEN 2.0 ELSE 1.0 END AS w FROM l WHERE t <> ''),
  c AS (SELECT *, sum(w) OVER (PARTITION BY id ORDER BY k) AS e, sum(w) OVER (PARTITION BY id) AS total, (('0x' || substr(sha256('seed' || chr(0) || id || chr(0) || 'v1'), 1, 13))::UBIGINT::DOUBLE / 4503599627370496.0) AS draw FROM v)
  SELECT id, family FROM c WHERE draw * total >= e - w AND draw * total < e""")
def weighted_pick(spark, sf):
    d = turn_routes(spark, sf)
    long = d.select("id", F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(k).alias("k"), F.col(c).alias("t")) for k, (f, c) in enumerate((("kimi", "kimi_1"), ("glm", "glm_1"), ("qwen", "qwen_2")))])).alias("r")).select("id", "r.*").where("t <> ''")
    return consensus.weighted_pick(long, "id", "id", [F.col("k")], F.when(F.col("family") == "qwen", 2.0).otherwise(1.0), "v1", "seed").select("id", "family")


@query("review_topk", """WITH d AS (SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 'P0' WHEN quality = 0 THEN 'P1' WHEN quality = 1 THEN 'P2' ELSE '' END AS p, n_chars % 5 AS score FROM documents LEFT JOIN labels USING (doc_id)),
  k AS (SELECT id, p, CASE p WHEN 'P0' THEN 0 WHEN 'P1' THEN 1 WHEN 'P2' THEN 2 ELSE 3 END AS a, CASE WHEN p = 'P1' THEN -score ELSE 0 END AS b, sha256(CASE p WHEN 'P0' THEN 'review_batch_v3|p0' WHEN 'P1' THEN 'review_batch_v3' WHEN 'P2' THEN 'review_batch_v3|p2' ELSE 'review_batch_v3|o' END || chr(0) || id) AS h FROM d)
  SELECT id, p AS review_priority FROM k ORDER BY a, b, h, id LIMIT 300""")
def review_topk(spark, sf):
    d = documents(spark, sf).select(F.col("doc_id").alias("id"), F.when(F.col("toxic") == 1, "P0").when(F.col("quality") == 0, "P1").when(F.col("quality") == 1, "P2").otherwise("").alias("review_priority"), (F.col("n_chars") % 5).alias("score"), F.lit("pending").alias("annotation_state"))
    return sampling.review_batch(d, F.col("score"), 300).select("id", "review_priority")


_QUOTA_SQL = f"""WITH RECURSIVE o AS (SELECT row_number() OVER (ORDER BY CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 ELSE 3 END, {_unit_sql("'42'", "lang", "doc_id::VARCHAR")}, '42|' || lang || '|' || doc_id) AS i, doc_id AS id, source AS call, sha256(text) AS dup, lang AS stratum, CASE lang WHEN 'en' THEN 40 ELSE 10 END AS quota FROM documents WHERE lang IN ('en', 'de', 'fr')),
  r AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS id, NULL::VARCHAR AS call, NULL::VARCHAR AS dup, '' AS stratum, false AS took, 0 AS n, []::VARCHAR[] AS calls, []::VARCHAR[] AS dups UNION ALL
    SELECT i, id, call, dup, stratum, took, had + took::INT, CASE WHEN took AND call IS NOT NULL THEN list_append(calls, call) ELSE calls END, CASE WHEN took AND dup IS NOT NULL THEN list_append(dups, dup) ELSE dups END FROM (
      SELECT o.i, o.id, o.call, o.dup, o.stratum, r.calls, r.dups, CASE WHEN o.stratum = r.stratum THEN r.n ELSE 0 END AS had, CASE WHEN o.stratum = r.stratum THEN r.n ELSE 0 END < o.quota AND (o.dup IS NULL OR NOT list_contains(r.dups, o.dup)) AND (o.call IS NULL OR len(list_filter(r.calls, lambda x: x = o.call)) < 3) AS took FROM r JOIN o ON o.i = r.i + 1))
  SELECT id, call, dup, stratum FROM r WHERE took"""


@query("quota_pick", _QUOTA_SQL)
def quota_pick(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("call"), F.sha2("text", 256).alias("dup"), F.col("lang").alias("stratum"))
    return sampling.quota_plan(d, [("en", 40), ("de", 10), ("fr", 10)], 42, 3)[0]


# --- consensus and classes -------------------------------------------------------------------


def _gathered(spark, sf) -> DataFrame:
    d = consensus.gather(routes.explode_routes(route_samples(spark, sf), FAMILIES, unicode=False))
    n = lambda kind: F.lit(None).cast(kind)
    return d.withColumns({"broken": F.lit(False), "noise_band": F.lit("clean"), "noise_risk": F.lit(False), "dnsmos_status": F.lit("success"), "crosstalk": n("boolean"), "governance_hold": n("boolean")})


_SIM = "CASE WHEN {a} = {b} THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE round(1 - levenshtein({a}, {b}) / greatest(length({a}), length({b})), 6) END"
_FAMILY_SQL = _TURNS_SQL + ", f AS (" + " UNION ALL ".join(
    f"SELECT id, '{f}' AS family, replace({f}_1, ' ', '') AS a, replace({f}_2, ' ', '') AS b, least(length(replace(coalesce(kimi_1, ''), ' ', ''))) AS n, duration, role FROM routes" for f in ("kimi", "glm", "qwen")
) + ")"


@query("family_state_v3", f"""WITH {_FAMILY_SQL}, sh AS (SELECT id, duration <= 2.0 OR bool_or((a <> '' AND length(a) <= 6) OR (b <> '' AND length(b) <= 6)) AS short FROM f GROUP BY id, duration),
  st AS (SELECT f.id, family, CASE WHEN a IS NULL OR b IS NULL THEN 'incomplete' WHEN a = '' AND b = '' THEN 'stable_empty' WHEN a = '' OR b = '' THEN 'unstable_presence'
  WHEN array_to_string(list_sort(list_distinct(regexp_extract_all(a, '[0-9]+'))), ',') <> array_to_string(list_sort(list_distinct(regexp_extract_all(b, '[0-9]+'))), ',') THEN 'unstable_semantic'
  WHEN CASE WHEN short THEN a = b ELSE {_SIM.format(a='a', b='b')} >= 0.98 END THEN 'stable_text' ELSE 'unstable_text' END AS status FROM f JOIN sh USING (id))
  SELECT family, status, count(*) AS n FROM st GROUP BY 1, 2""")
def family_state_v3(spark, sf):
    d = _gathered(spark, sf).withColumn("short", consensus.is_short(F.col("duration"), F.col("routes")))
    d = consensus.family_states(d, FAMILIES).select(F.explode("families").alias("f"))
    return d.groupBy(F.col("f")["family"].alias("family"), F.col("f")["status"].alias("status")).agg(F.count("*").alias("n"))


@query("cluster_v1")
def cluster_v1(spark, sf):
    d = classify.v1_features(route_samples(spark, sf).withColumn("broken", F.lit(False)), FAMILIES.runs)
    return d.select("id", F.array_join(F.transform("cluster", lambda m: m["model"]), ",").alias("members"), "min_said")


@query("classify_v1")
def classify_v1(spark, sf):
    return classify.classify_v1(route_samples(spark, sf).withColumn("broken", F.lit(False)), FAMILIES.runs, secondary="glm").select("id", "type", "decision", "reason", "selected_model", "support_count", "min_similarity")


@query("classify_v2")
def classify_v2(spark, sf):
    n = F.lit(None)
    d = route_samples(spark, sf).withColumns({"broken": F.lit(False), "speech_ratio": n.cast("double"), "vad_edge_risk": n.cast("boolean"), "overlap_risk": F.lit(False), "has_speech": n.cast("boolean")})
    return classify.classify_v2(d, FAMILIES.runs).select("id", "type", "decision", "reason", "dataset_role")


@query("classify_v3")
def classify_v3(spark, sf):
    return classify.classify_v3(_gathered(spark, sf), FAMILIES).select("id", "type", "decision", "reason", "review_priority", "review_queue", "disposition", "polarity", "support_families", "min_similarity")


@query("classify_five")
def classify_five(spark, sf):
    n = F.lit(None).cast("double")
    d = _gathered(spark, sf).withColumns({"energy": F.when(F.col("duration") < 5, "audio_too_short").otherwise("audible"), "dnsmos_bak": n, "dnsmos_ovrl": n, "dnsmos_sig": n, "crosstalk_confirmed": F.lit(False)})
    return classify.classify_five(d, FAMILIES).select("id", "category", "reason", "noise_kind", "confidence", "selected_run_id", "review_priority")


@query("classify_tolerant")
def classify_tolerant(spark, sf):
    from corvane.operators import classify_semantic

    n = F.lit(None)
    d = _gathered(spark, sf).withColumns({"acoustic": n.cast("string"), "speech_absent": n.cast("boolean"), "retry_count": F.lit(0)})
    return classify_semantic.classify_tolerant(d, FAMILIES).select("id", "category", "status", "reason")


@query("classify_business")
def classify_business(spark, sf):
    from corvane.operators import classify_semantic

    n = F.lit(None)
    d = _gathered(spark, sf).withColumns({"presence": n.cast("string"), "retry_open": F.lit(False)})
    return classify_semantic.classify_business(d, FAMILIES).select("id", "category", "status", "reason", "coverage", "label_grade")


@query("business_acts", "SELECT doc_id, CASE WHEN n_chars = 0 THEN 'empty' ELSE 'unknown' END AS act FROM documents")
def business_acts(spark, sf):
    from corvane.operators import semantics

    return table(spark, sf, "documents").select("doc_id", semantics.business_fields(F.col("text"), unicode=False)["act"].alias("act"))


@query("speech_language", r"SELECT doc_id, CASE WHEN regexp_replace(text, '[^\p{L}\p{N}]', '', 'g') = '' THEN 'empty' WHEN len(list_filter(regexp_extract_all(text, '[A-Za-z]+'), lambda t: length(t) >= 3)) > 0 THEN 'non_zh' ELSE 'unknown' END AS language FROM documents")
def speech_language(spark, sf):
    from corvane.operators import semantics

    return table(spark, sf, "documents").select("doc_id", semantics.speech_language(F.col("text")).alias("language"))


@query("classify_expressions", f"""WITH {_DOCS_SQL} SELECT CASE WHEN coalesce(toxic = 1, false) THEN 'exclude' WHEN coalesce(quality = 1, false) AND coalesce(n_chars > 500, false) THEN 'gold' WHEN lang IS DISTINCT FROM 'en' THEN 'other_language' ELSE 'review_queue' END AS classification_bucket, count(*) AS n FROM docs GROUP BY 1""")
def classify_expressions(spark, sf):
    d = classify.classify_by_expressions(documents(spark, sf), [("exclude", "toxic == 1"), ("gold", "quality == 1 and n_chars > 500"), ("other_language", "lang != 'en'")])
    return d.groupBy("classification_bucket").agg(F.count("*").alias("n"))


@query("classify_external", f"""WITH {_TURNS_SQL}, d AS (SELECT id, CASE WHEN conv_id % 29 = 0 THEN 'held' ELSE '' END AS g, replace(coalesce(qwen_2, ''), ' ', '') AS a, replace(glm_2, ' ', '') AS b FROM routes)
  SELECT id, CASE WHEN g <> '' THEN g WHEN a = '' AND b = '' THEN 'noise' WHEN b = '' THEN 'hardcase' WHEN a = b THEN 'auto_gold' ELSE 'hardcase' END AS type,
  CASE WHEN g <> '' THEN 'preassigned_type' WHEN a = '' AND b = '' THEN 'both_blank' WHEN b = '' THEN 'blank_reference' WHEN a = b THEN 'exact_match' ELSE 'texts_differ' END AS reason FROM d""")
def classify_external(spark, sf):
    d = turn_routes(spark, sf).withColumn("preassigned", F.when(F.col("conv_id") % 29 == 0, "held").otherwise(""))
    return classify.classify_external(d, "qwen_2", "glm_2", unicode=False).select("id", "type", "reason")


# --- groups, releases, governance ---------------------------------------------------------------


_EDGE_SQL = """d AS (SELECT doc_id AS id, sha256(text) AS h FROM documents), c AS (SELECT id, min(id) OVER (PARTITION BY h) AS component FROM d)"""


@query("leakage_groups", f"WITH {_EDGE_SQL} SELECT id, component FROM c")
def leakage_groups(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("h"), F.lit("").alias("call"))
    return dataset.leakage_groups(d, {"file": ["h"], "call": ["call"]})


@query("leakage_group_ids", f"""WITH {_EDGE_SQL}, m AS (SELECT component, 'lg_' || substr(sha256(string_agg(id::VARCHAR, '|' ORDER BY id::VARCHAR)), 1, 16) AS group_id FROM c GROUP BY component) SELECT id, group_id FROM c JOIN m USING (component)""")
def leakage_group_ids(spark, sf):
    return dataset.group_ids(leakage_groups(spark, sf))


@query("group_size_histogram", f"WITH {_EDGE_SQL} SELECT size, count(*) AS groups FROM (SELECT component, count(*) AS size FROM c GROUP BY 1) GROUP BY 1")
def group_size_histogram(spark, sf):
    return dataset.size_histogram(leakage_groups(spark, sf))


@query("components_sparse", """WITH RECURSIVE e AS (SELECT 'u' || user_id AS a, 'e' || event_type AS b FROM events UNION SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier),
  s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS node, a AS root FROM s UNION SELECT s.b, r.root FROM r JOIN s ON r.node = s.a) SELECT node, min(root) AS component FROM r GROUP BY node""")
def components_sparse(spark, sf):
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    name = lambda p, k: F.concat(F.lit(p), k)
    e = c.select(name("c", "c_custkey").alias("u"), name("n", "c_nationkey").alias("v")).union(s.select(name("s", "s_suppkey"), name("n", "s_nationkey")))
    e = e.union(table(spark, sf, "events").select(name("u", "user_id"), name("e", "event_type")))
    return connected_components(e)


_CHAIN_SQL = """WITH RECURSIVE e AS (SELECT 'd' || doc_id AS a, 'd' || (doc_id + 1) AS b FROM documents WHERE doc_id % 7 <> 6 AND doc_id + 1 IN (SELECT doc_id FROM documents) UNION SELECT 'd' || doc_id, 'l' || lang FROM documents WHERE doc_id % 21 = 0),
  s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS node, a AS root FROM s UNION SELECT s.b, r.root FROM r JOIN s ON r.node = s.a) SELECT node, min(root) AS component FROM r GROUP BY node"""


@query("components_rounds", _CHAIN_SQL)
def components_rounds(spark, sf):
    """Chains of rows that meet at hubs, by the distributed rounds whatever the size."""
    d = table(spark, sf, "documents").select("doc_id", "lang")
    name = lambda p, k: F.concat(F.lit(p), k)
    step = d.where("doc_id % 7 <> 6").select((F.col("doc_id") + 1).alias("next"), "doc_id").join(d.select(F.col("doc_id").alias("next")), "next")
    e = step.select(name("d", "doc_id").alias("u"), name("d", "next").alias("v")).union(d.where("doc_id % 21 = 0").select(name("d", "doc_id"), name("l", "lang")))
    return connected_components(e, local_edges=0)


@query("warehouse_counts", """WITH d AS (SELECT lang AS category, CASE WHEN l.doc_id IS NULL THEN 'pending' ELSE 'annotated' END AS state, CASE WHEN toxic = 1 THEN 'toxic' WHEN toxic = 0 THEN 'clean' END AS kind FROM documents d LEFT JOIN labels l USING (doc_id))
  SELECT 'category' AS field, category AS value, count(*) AS n FROM d GROUP BY 2 UNION ALL SELECT 'state', state, count(*) FROM d GROUP BY 2 UNION ALL SELECT 'kind', coalesce(kind, 'unknown'), count(*) FROM d GROUP BY 2""")
def warehouse_counts(spark, sf):
    d = documents(spark, sf).select(F.col("lang").alias("category"), F.when(F.col("quality").isNull(), "pending").otherwise("annotated").alias("state"), F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean").alias("kind"))
    return dataset.warehouse_counts(d)


@query("conservation", f"WITH {_DOCS_SQL} SELECT count(*) AS total, count(quality) AS classifiable, count(*) FILTER (quality IS NULL) AS incomplete, true AS conserved FROM docs")
def conservation(spark, sf):
    return dataset.conservation(documents(spark, sf), {"classifiable": F.col("quality").isNotNull(), "incomplete": F.col("quality").isNull()})


@query("coverage", f"WITH {_DOCS_SQL} SELECT CASE WHEN quality = 1 THEN 'A' WHEN toxic = 1 THEN 'H' ELSE 'U' END AS bucket, count(*) AS n FROM docs GROUP BY 1")
def coverage(spark, sf):
    return dataset.coverage(documents(spark, sf), F.col("quality") == 1, F.col("toxic") == 1)


@query("eval_ready", """SELECT count(*) AS rows, count(l.doc_id) AS gold, 0::BIGINT AS duplicate_ids, 0::BIGINT AS missing_audio, round(count(l.doc_id) / count(*), 4) AS gold_ratio, 'legacy' AS trust FROM documents d LEFT JOIN labels l USING (doc_id)""")
def eval_ready(spark, sf):
    d = documents(spark, sf).select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("source_path"), F.when(F.col("quality").isNotNull(), "x").alias("gold_text"), F.lit(False).alias("is_human_verified"), F.lit("none").alias("label_source"))
    return dataset.eval_ready(d).select("rows", "gold", "duplicate_ids", "missing_audio", "gold_ratio", "trust")


@query("snapshot_digest", """WITH f AS (SELECT doc_id::VARCHAR AS k, length(doc_id::VARCHAR) || ':' || doc_id || coalesce(length(lang) || ':' || lang, '~') || coalesce(length(source) || ':' || source, '~') || coalesce(length(text) || ':' || text, '~') AS line FROM documents),
  r AS (SELECT k, sha256(line) AS h, ('0x' || substr(sha256(k), 1, 8))::BIGINT % 4096 AS b FROM f), g AS (SELECT b, count(*) AS n, sha256(string_agg(h, '' ORDER BY k, h)) AS d FROM r GROUP BY b)
  SELECT sum(n)::BIGINT AS rows, sha256(string_agg(d, '' ORDER BY b)) AS digest FROM g""")
def snapshot_digest(spark, sf):
    return dataset.snapshot_digest(table(spark, sf, "documents"), "doc_id", ["lang", "source", "text"])


@query("dual_review", f"WITH {_DOCS_SQL} SELECT doc_id, coalesce(toxic = 1, false) OR coalesce(quality = 0, false) AS dual FROM docs")
def dual_review(spark, sf):
    d, n = documents(spark, sf), F.lit(None).cast("string")
    cols = {"role": n, "priority": F.when(F.col("toxic") == 1, "P0"), "category": F.when(F.col("quality") == 0, "hardcase"), "coverage": n, "queue": n, "type": n, "tags": F.lit(None).cast("array<string>")}
    return d.select("doc_id", dataset.requires_dual_review(cols).alias("dual"))


_STEP_SQL = """d AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'first' WHEN 1 THEN 'second' WHEN 2 THEN 'adjudicate' ELSE 'spot_check' END AS stage, CASE WHEN doc_id % 3 = 0 THEN 'conflict' ELSE 'annotated' END AS state,
  CASE WHEN n_chars % 5 = 0 THEN 'reject' ELSE 'accept' END AS decision, n_chars % 3 = 0 AS conflict, n_chars % 2 = 0 AS dual, 'p' || (n_chars % 3) AS person, CASE WHEN n_chars % 7 > 0 THEN 'p0' END AS first_person, 'p1' AS second_person FROM documents),
r AS (SELECT *, CASE WHEN stage = 'second' AND first_person IS NULL THEN 'needs_first' WHEN stage = 'second' AND coalesce(person = first_person, false) THEN 'same_person' WHEN stage = 'adjudicate' AND state <> 'conflict' THEN 'not_in_conflict'
  WHEN stage = 'adjudicate' AND (coalesce(person = first_person, false) OR person = second_person) THEN 'same_person' END AS refused FROM d)"""


@query("review_step", f"""WITH {_STEP_SQL} SELECT doc_id, refused, CASE WHEN refused IS NOT NULL THEN state WHEN stage = 'first' THEN CASE WHEN decision = 'reject' THEN 'rejected' ELSE 'annotated' END WHEN stage = 'second' THEN CASE WHEN conflict THEN 'conflict' ELSE 'second_review' END
  WHEN stage = 'adjudicate' THEN CASE WHEN decision = 'reject' THEN 'rejected' ELSE 'adjudicated' END ELSE CASE WHEN conflict THEN 'conflict' ELSE 'passed' END END AS next_state,
  refused IS NULL AND ((stage = 'first' AND decision <> 'reject' AND NOT dual) OR (stage = 'second' AND NOT conflict) OR (stage = 'adjudicate' AND decision <> 'reject')) AS promoted FROM r""")
def review_step(spark, sf):
    i, n = F.col("doc_id"), F.col("n_chars")
    d = table(spark, sf, "documents").select(
        "doc_id", F.when(i % 4 == 0, "first").when(i % 4 == 1, "second").when(i % 4 == 2, "adjudicate").otherwise("spot_check").alias("stage"), F.when(i % 3 == 0, "conflict").otherwise("annotated").alias("state"),
        F.when(n % 5 == 0, "reject").otherwise("accept").alias("decision"), (n % 3 == 0).alias("conflict"), (n % 2 == 0).alias("dual"), F.concat(F.lit("p"), n % 3).alias("person"), F.when(n % 7 > 0, "p0").alias("first_person"), F.lit("p1").alias("second_person"),
    )
    return dataset.review_step(d).select("doc_id", "refused", "next_state", "promoted")


@query("annotation_tasks", "SELECT conv_id AS id, string_agg(DISTINCT role, ',' ORDER BY role) AS questions FROM conversations GROUP BY conv_id")
def annotation_tasks(spark, sf):
    d = dataset.annotation_tasks(table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), F.col("role").alias("question")))
    return d.select("id", F.array_join("questions", ",").alias("questions"))


# --- relational primitives on the star schema ----------------------------------------------------


@query("revenue_rollup", """SELECT coalesce(l_returnflag, 'all') AS returnflag, coalesce(l_linestatus, 'all') AS linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def revenue_rollup(spark, sf):
    d = table(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
    return d.select(F.coalesce("l_returnflag", F.lit("all")).alias("returnflag"), F.coalesce("l_linestatus", F.lit("all")).alias("linestatus"), "n", "qty", "revenue")


@query("nation_revenue", """SELECT n_name, r_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def nation_revenue(spark, sf):
    t = lambda n: table(spark, sf, n)
    j = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("n_name", "r_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("top_orders", """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3""")
def top_orders(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, sf, "orders").withColumn("r", F.row_number().over(w)).where("r <= 3").select("o_custkey", "o_orderkey", "o_totalprice")


# --- signals, scripts, streams --------------------------------------------------------------------


@query("signal_levels", """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), s AS (SELECT vec_id, sqrt(list_sum(list_transform(e, lambda x: x * x)) / len(e)) AS rms, list_max(list_transform(e, lambda x: abs(x))) AS peak FROM v)
  SELECT vec_id, round(CASE WHEN rms > 1e-6 THEN 20 * log10(rms) ELSE -120 END, 4) AS rms_dbfs, round(CASE WHEN peak > 1e-6 THEN 20 * log10(peak) ELSE -120 END, 4) AS peak_dbfs FROM s""")
def signal_levels(spark, sf):
    d = table(spark, sf, "embeddings")
    return d.select("vec_id", signal.rms_dbfs(F.col("embedding")).alias("rms_dbfs"), signal.peak_dbfs(F.col("embedding")).alias("peak_dbfs"))


@query("signal_evidence")
def signal_evidence(spark, sf):
    d = signal.energy_evidence(table(spark, sf, "embeddings"), "embedding", 100)
    return d.select("vec_id", "duration_ms", "rms_dbfs", "peak_dbfs", "non_silent_ratio", "energy_state", signal.snr_db(F.col("embedding"), 4).alias("snr"), signal.vad_ratio(F.col("embedding"), 4).alias("vad"))


@query("script_udf", "SELECT doc_id AS id, CASE WHEN n_chars < 500 THEN 'short' ELSE 'long' END AS length_class FROM documents")
def script_udf(spark, sf):
    from corvane.plans.udf import apply_script

    empty = lambda: F.create_map().cast("map<string,string>")
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), (F.col("n_chars") / 10.0).alias("duration"), empty().alias("quality"), empty().alias("labels"), empty().alias("status"), empty().alias("errors"))
    got = apply_script(d, lambda s, p: {"labels": {"length_class": "short" if s["duration"] < p["limit"] else "long"}}, {"limit": 50.0})
    return got.select("id", F.try_element_at("labels", F.lit("length_class")).alias("length_class"))


@query("pipeline_plan", f"WITH {_DOCS_SQL} SELECT doc_id, n_chars > 1000 AS long_text FROM docs WHERE quality IS DISTINCT FROM 0 AND coalesce(n_chars > 100, false)")
def pipeline_plan(spark, sf):
    from corvane.plans import pipeline

    plan = pipeline.load("name: demo\nsteps:\n  - operator: quality.select\n    params: {expr: 'quality != 0 and n_chars > 100'}\n  - operator: quality.filter\n    params: {expr: 'n_chars > 1000', label: long_text}\n")
    return pipeline.run(documents(spark, sf), plan).select("doc_id", "long_text")


@query("stream_counts", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_counts(spark, sf):
    """The stream over the table's files, run until it is drained; batches replace by their number."""
    from corvane.streaming.incremental import run_once, window_counts

    root = scratch(spark, "stream")
    source = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events*.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    run_once(window_counts(source, "ts", "event_type", "1 hour", "3650 days"), f"{root}/state", lambda d, i: d.write.mode("overwrite").parquet(f"{root}/out/batch={i}"), "update")
    got = spark.read.parquet(f"{root}/out")
    last = got.groupBy("start", "event_type").agg(F.max_by(F.struct("n", "total"), "batch").alias("v"))
    return last.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", F.col("v")["n"].alias("n"), F.round(F.col("v")["total"], 4).alias("total"))


from corvane.plans import catalog_build  # noqa: E402,F401  (registers its queries here)

"""Registered queries of reports, alignment and data-set building, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import similarity, stats, text
from corvane.operators import building, classify, consensus, dataset, evidence, five_class, metrics, relational, reports, routes, semantics
from corvane.plans.catalog import _DOCS_SQL, _FACTS_SQL, _SCORED_SQL, _TURNS_SQL, FAMILIES, _facts, _rates, _scored, _unit_sql, documents, query, turn_routes
from corvane.runtime import table

_EVAL_SQL = _SCORED_SQL + """, e AS (SELECT *, split_part(id, '-', 1)::BIGINT AS c, split_part(id, '-', 2)::BIGINT AS t FROM s),
b AS (SELECT *, CASE WHEN c % 11 = 0 THEN 'noise' WHEN c % 5 = 0 THEN NULL ELSE type END AS main, CASE WHEN t % 3 = 0 THEN 'short' END AS sub FROM e WHERE NOT (model = 'qwen' AND c % 13 = 5)),
x AS (SELECT *, main = 'noise' AS no_ref, CASE WHEN main IS NULL THEN coalesce(sub, 'unclassified') WHEN sub IS NOT NULL THEN main || '/' || sub ELSE main END AS bucket FROM b),
g AS (SELECT CASE WHEN grouping(bucket) = 0 THEN 'bucket' WHEN coalesce(no_ref, false) THEN 'empty_ref' ELSE 'overall' END AS section, bucket, model, count(*) AS samples, sum(d)::BIGINT AS errors, sum(n)::BIGINT AS reference_length,
  sum(d) / greatest(sum(n), 1) AS cer FROM (SELECT * REPLACE (coalesce(no_ref, false) AS no_ref) FROM x) GROUP BY GROUPING SETS ((model, no_ref), (model, bucket)))"""


def _eval_rows(spark, sf):
    d = _scored(spark, sf)
    c, t = (F.split("id", "-")[i].cast("long") for i in (0, 1))
    main = F.when(c % 11 == 0, "noise").when(c % 5 == 0, None).otherwise(F.col("type"))
    scored = ~((F.col("model") == "qwen") & (c % 13 == 5))
    return d.withColumns({"scored": scored, "bucket": main, "subtype": F.when(t % 3 == 0, "short"), "type": F.lit(None).cast("string")})


@query("eval_report_corpus", f"WITH {_EVAL_SQL} SELECT section, bucket, model, samples, errors, reference_length, round(cer, 9) AS corpus_cer, CASE WHEN reference_length > 0 THEN round(greatest(0.0, 1 - cer), 9) END AS char_acc FROM g")
def eval_report_corpus(spark, sf):
    r = reports.evaluation_report(_eval_rows(spark, sf)).corpus
    return r.select("section", "bucket", "model", "samples", "errors", "reference_length", F.round("corpus_cer", 9).alias("corpus_cer"), F.round("char_acc", 9).alias("char_acc"))


@query("eval_report_coverage", f"""WITH {_EVAL_SQL} SELECT model, (SELECT count(DISTINCT id) FROM s) AS total, (SELECT count(DISTINCT id) FROM s) - (SELECT count(DISTINCT id) FROM b) AS missing_gold, count(*) AS scored,
  count(*) FILTER (coalesce(no_ref, false)) AS empty_ref_excluded FROM x GROUP BY model""")
def eval_report_coverage(spark, sf):
    return reports.evaluation_report(_eval_rows(spark, sf)).coverage


@query("eval_report_gates", f"""WITH {_EVAL_SQL}, w AS (SELECT * FROM (VALUES ('overall', NULL, 0.0), ('user', 'user', 1.0), ('none', 'no such bucket', 0.0)) v(name, bucket, threshold)),
  p AS (SELECT section, bucket, max(cer) FILTER (model = 'qwen') - max(cer) FILTER (model = 'glm') AS delta FROM g WHERE section <> 'empty_ref' GROUP BY section, bucket),
  j AS (SELECT w.*, p.section, p.delta FROM w LEFT JOIN p ON (w.bucket IS NULL AND p.section = 'overall') OR (p.section = 'bucket' AND p.bucket = w.bucket))
  SELECT name, bucket, round(delta, 9) AS delta_cer, threshold::DOUBLE AS threshold, bucket IS NOT NULL AND section IS NULL AS skipped, (bucket IS NOT NULL AND section IS NULL) OR coalesce(delta <= threshold, false) AS passed FROM j""")
def eval_report_gates(spark, sf):
    r = reports.evaluation_report(_eval_rows(spark, sf), "glm", "qwen", [("overall", None, 0.0), ("user", "user", 1.0), ("none", "no such bucket", 0.0)], 50)
    return r.gates.withColumn("delta_cer", F.round("delta_cer", 9))


@query("exact_by_type", f"""WITH {_SCORED_SQL}, g AS (SELECT model, coalesce(type, 'all') AS grp, count(*) AS rows, sum((round(greatest(0.0, 1 - round(d / greatest(n, 1), 6)), 6) = 1.0)::BIGINT)::BIGINT AS exact, sum(d) AS e, sum(n) AS m FROM s GROUP BY GROUPING SETS ((model, type), (model))),
  a AS (SELECT model, grp, rows, exact, round(exact / rows, 6) AS exact_rate, CASE WHEN m = 0 THEN CASE WHEN e = 0 THEN 1.0 ELSE 0.0 END ELSE round(greatest(0.0, 1 - e / m), 6) END AS overall_acc FROM g)
  SELECT *, CASE WHEN model <> 'glm' THEN round(exact_rate - max(CASE WHEN model = 'glm' THEN exact_rate END) OVER (PARTITION BY grp), 6) END AS exact_delta,
  CASE WHEN model <> 'glm' THEN round(overall_acc - max(CASE WHEN model = 'glm' THEN overall_acc END) OVER (PARTITION BY grp), 6) END AS overall_delta FROM a""")
def exact_by_type(spark, sf):
    return reports.exact_by_type(_scored(spark, sf), "glm")


_REF_SQL = _TURNS_SQL + """, p AS (SELECT id, CASE conv_id % 4 WHEN 0 THEN kimi_1 || repeat('好', length(kimi_1)) WHEN 1 THEN '' ELSE kimi_1 END AS r, glm_2 AS h, conv_id % 4 <> 3 AS ok FROM routes),
q AS (SELECT *, length(regexp_replace(r, '[^a-z]', '', 'g')) AS latin, length(regexp_replace(r, '[^好]', '', 'g')) AS cjk FROM p),
z AS (SELECT *, CASE WHEN latin > 0 AND cjk > 0 AND latin / (latin + cjk) >= 0.2 AND cjk / (latin + cjk) >= 0.2 THEN 'mixed_language' WHEN NOT ok THEN 'language_mismatch' WHEN r = '' THEN 'empty_reference' ELSE 'reference_length' END AS reason FROM q)"""


@query("reference_metrics", f"WITH {_REF_SQL} SELECT id, reason, CASE WHEN reason = 'reference_length' THEN round(levenshtein(r, h) / length(r), 9) END AS cer, CASE WHEN reason = 'empty_reference' THEN length(h) END AS insertions, length(r) AS reference_length FROM z")
def reference_metrics(spark, sf):
    d, c = turn_routes(spark, sf), F.col("conv_id") % 4
    ref = F.when(c == 0, F.concat("kimi_1", F.expr("repeat('好', length(kimi_1))"))).when(c == 1, "").otherwise(F.col("kimi_1"))
    m = d.select("id", reports.reference_metrics(ref, F.col("glm_2"), c != 3).alias("m"))
    return m.select("id", "m.reason", F.round("m.cer", 9).alias("cer"), "m.insertions", "m.reference_length")


_TRIGGER_SQL = _TURNS_SQL + """, n AS (SELECT id, coalesce(qwen_1, '') = '' AND coalesce(qwen_2, '') = '' AND glm_2 = '' AS none, turn % 4 = 1 AS far, conv_id FROM routes),
k AS (SELECT *, CASE WHEN none AND far THEN 'both' WHEN none THEN 'all_families_no_valid_transcript' WHEN far THEN 'non_chinese_transcript' END AS trigger, CASE WHEN NOT (none OR far) THEN 'not_required' WHEN conv_id % 3 = 0 THEN 'failed' ELSE 'success' END AS status FROM n)"""


@query("noise_report", f"WITH {_TRIGGER_SQL} SELECT 'status' AS kind, status AS value, count(*) AS n FROM k GROUP BY status UNION ALL SELECT 'trigger', trigger, count(*) FROM k WHERE trigger IS NOT NULL GROUP BY trigger")
def noise_report(spark, sf):
    d = turn_routes(spark, sf)
    why = reports.noise_trigger({"glm": [F.col("glm_2")], "qwen": [F.col("qwen_1"), F.col("qwen_2")]}, F.col("turn") % 4 == 1)
    d = d.select("id", why.alias("reasons"), F.concat(F.lit("s"), "conv_id").alias("sha256"))
    scored = reports.score_distinct(d, lambda x: x.where(F.substring("sha256", 2, 20).cast("long") % 3 != 0).withColumn("bak", F.lit(3.0)))
    return reports.noise_report(scored.withColumn("status", F.col("noise_status")))


@query("noise_bands", f"""WITH {_DOCS_SQL}, v AS (SELECT doc_id, CASE WHEN n_chars % 7 = 0 THEN NULL ELSE 1 + n_chars % 40 / 10.0 END AS bak, 1 + doc_id % 35 / 10.0 AS ovrl, CASE WHEN doc_id % 9 = 0 THEN 'failed' ELSE 'success' END AS st FROM docs)
  SELECT doc_id, CASE WHEN st <> 'success' OR bak IS NULL THEN 'unknown' WHEN bak < 2.5 OR ovrl < 2.0 THEN 'noisy' WHEN bak >= 3.0 AND ovrl >= 2.5 THEN 'clean' ELSE 'moderate' END AS band, CASE WHEN st = 'success' AND bak IS NOT NULL THEN bak < 2.5 OR ovrl < 2.0 END AS risk FROM v""")
def noise_bands(spark, sf):
    d = documents(spark, sf)
    bak = F.when(F.col("n_chars") % 7 == 0, None).otherwise(1 + F.col("n_chars") % 40 / 10.0)
    b = reports.noise_band(bak, 1 + F.col("doc_id") % 35 / 10.0, F.when(F.col("doc_id") % 9 == 0, "failed").otherwise("success"), (2.5, 2.0))
    return d.select("doc_id", b["band"].alias("band"), b["risk"].alias("risk"))


@query("dnsmos_candidates", f"""WITH {_TURNS_SQL}, a AS (SELECT id, list_transform([kimi_1, glm_2, qwen_2], lambda x: CASE WHEN x = '' THEN 'stable_empty' ELSE 'stable_text' END) AS st, turn % 5 AS t, CASE turn % 3 WHEN 0 THEN 'audible' WHEN 1 THEN 'borderline' ELSE 'silence' END AS e FROM routes),
  c AS (SELECT id, CASE WHEN t = 0 THEN ['stable_empty', 'stable_empty', 'stable_empty'] WHEN t = 1 THEN ['stable_empty', st[2], 'unstable'] ELSE st END AS st, e FROM a),
  n AS (SELECT id, e, len(list_filter(st, lambda x: x = 'stable_empty')) AS em, len(list_filter(st, lambda x: x = 'stable_text')) AS tx, len(list_filter(st, lambda x: x = 'unstable')) AS un FROM c)
  SELECT id, CASE WHEN e = 'silence' OR un > 0 THEN '' WHEN em = 3 THEN 'all_stable_empty_audible_or_borderline' WHEN em >= 2 AND tx = 1 THEN 'two_empty_one_text_audible_or_borderline' ELSE '' END AS reasons FROM n""")
def dnsmos_candidates(spark, sf):
    d, t = turn_routes(spark, sf), F.col("turn") % 5
    state = lambda c: F.when(F.col(c) == "", "stable_empty").otherwise("stable_text")
    states = [F.when(t <= 1, "stable_empty").otherwise(state("kimi_1")), F.when(t == 0, "stable_empty").otherwise(state("glm_2")), F.when(t == 0, "stable_empty").when(t == 1, "unstable").otherwise(state("qwen_2"))]
    energy = F.when(F.col("turn") % 3 == 0, "audible").when(F.col("turn") % 3 == 1, "borderline").otherwise("silence")
    return d.select("id", F.array_join(reports.dnsmos_candidates(states, energy), ",").alias("reasons"))


@query("attach_routes", f"WITH {_TURNS_SQL} SELECT id, CASE WHEN turn % 6 = 5 THEN NULL ELSE glm_1 END AS glm_1, qwen_2 FROM routes")
def attach_routes(spark, sf):
    d = turn_routes(spark, sf).withColumn("sha256", F.sha2("kimi_1", 256))
    own = d.select("id", "sha256")
    digest = dataset.snapshot_digest(own, "id", ["sha256"]).first()["digest"]
    runs = spark.createDataFrame([("glm_1", "glm", "a1", "e1", digest), ("qwen_2", "qwen", "a2", "e2", digest)], "run string, family string, artifact string, execution string, snapshot string")
    tables = {"glm_1": d.where(F.col("turn") % 6 != 5).select("id", "sha256", F.col("glm_1").alias("text")), "qwen_2": d.select("id", "sha256", F.col("qwen_2").alias("text"))}
    return reports.attach_routes(own, runs, tables).select("id", "glm_1", "qwen_2")


@query("delivery_reconcile", """WITH c AS (SELECT doc_id AS k FROM documents), s AS (SELECT 'cleaned' AS stage, doc_id AS k FROM documents UNION ALL SELECT 'route', doc_id FROM documents WHERE doc_id % 7 <> 0 UNION ALL SELECT 'classified', doc_id FROM labels
  UNION ALL SELECT 'sheet', doc_id FROM documents UNION ALL SELECT 'sheet', -1 - item_id FROM benchmark UNION ALL SELECT 'sheet', doc_id FROM labels), u AS (SELECT stage, k, count(*) AS n FROM s GROUP BY stage, k)
  SELECT stage, sum(n)::BIGINT AS rows, count(*) AS ids, (SELECT count(DISTINCT k) FROM c) - count(*) FILTER (k IN (SELECT k FROM c)) AS missing, count(*) FILTER (k NOT IN (SELECT k FROM c)) AS extra, count(*) FILTER (n > 1) AS repeated FROM u GROUP BY stage""")
def delivery_reconcile(spark, sf):
    d, lab = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id")
    extra = table(spark, sf, "benchmark").select((-1 - F.col("item_id")).alias("doc_id"))
    return reports.delivery_reconcile(d, {"route": d.where("doc_id % 7 <> 0")}, lab, d.union(extra).union(lab), "doc_id")


@query("outer_merge", """WITH a AS (SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE doc_id % 3 < 2), b AS (SELECT doc_id, source, 9 AS quality FROM documents WHERE doc_id % 3 > 0)
  SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.lang, coalesce(a.quality, b.quality) AS quality, b.source FROM a FULL JOIN b ON a.doc_id = b.doc_id""")
def outer_merge(spark, sf):
    d = documents(spark, sf)
    return reports.outer_merge(d.where("doc_id % 3 < 2").select("doc_id", "lang", "quality"), d.where("doc_id % 3 > 0").select("doc_id", "source", F.lit(9).alias("quality")), "doc_id")


@query("align_to_order", """WITH o AS (SELECT doc_id, n_chars AS position FROM documents WHERE doc_id % 2 = 0), r AS (SELECT doc_id, lang FROM documents WHERE doc_id % 3 = 0)
  SELECT coalesce(o.doc_id, r.doc_id) AS doc_id, position, lang FROM o FULL JOIN r ON o.doc_id = r.doc_id""")
def align_to_order(spark, sf):
    d = table(spark, sf, "documents")
    return reports.align_to_order(d.where("doc_id % 2 = 0").select("doc_id", F.col("n_chars").alias("position")), d.where("doc_id % 3 = 0").select("doc_id", "lang"), "outer", "doc_id").select("doc_id", "position", "lang")


@query("shadow_compare", f"WITH {_DOCS_SQL} SELECT old, new, count(*) AS n, old <> new AS changed FROM (SELECT coalesce(CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'bad' END, 'none') AS old, CASE WHEN toxic = 1 THEN 'bad' WHEN n_chars > 500 THEN 'good' ELSE 'none' END AS new FROM docs) GROUP BY old, new")
def shadow_compare(spark, sf):
    d = documents(spark, sf)
    return reports.shadow_compare(d, F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad"), F.when(F.col("toxic") == 1, "bad").when(F.col("n_chars") > 500, "good"))


@query("availability", f"WITH {_DOCS_SQL} SELECT count(*) AS rows, count(*) FILTER (quality IS NOT NULL) AS labelled, count(*) FILTER (quality IS NOT NULL AND toxic = 0) AS clean, count(*) FILTER (quality IS NOT NULL AND toxic = 0) + count(*) FILTER (quality = 0 AND toxic = 0) AS review_jobs FROM docs")
def availability(spark, sf):
    return reports.availability(documents(spark, sf), {"labelled": F.col("quality").isNotNull(), "clean": F.col("toxic") == 0}, F.col("quality") == 0)


@query("review_summary", f"WITH {_TURNS_SQL} SELECT role AS type, count(*) AS n FROM routes GROUP BY role")
def review_summary(spark, sf):
    from corvane.plans.catalog import route_samples

    return reports.review_summary(route_samples(spark, sf).withColumn("type", F.col("role")), ["glm_1", "qwen_1"], ["conv_id"])[1]


@query("pairwise_accuracy", f"""WITH {_TURNS_SQL}, p AS (SELECT id, replace(kimi_1, ' ', '') AS k, replace(glm_2, ' ', '') AS g, replace(coalesce(qwen_1, ''), ' ', '') AS q FROM routes)
  SELECT id, CASE WHEN k <> '' THEN round(greatest(0.0, 1 - levenshtein(k, g) / length(k)), 6) END AS glm_2_vs_kimi_1_acc, CASE WHEN g <> '' THEN round(greatest(0.0, 1 - levenshtein(g, q) / length(g)), 6) END AS qwen_1_vs_glm_2_acc FROM p""")
def pairwise_accuracy(spark, sf):
    return reports.pairwise_accuracy(turn_routes(spark, sf), [("kimi_1", "glm_2"), ("glm_2", "qwen_1")], unicode=False).select("id", "glm_2_vs_kimi_1_acc", "qwen_1_vs_glm_2_acc")


@query("candidate_order", f"""WITH {_TURNS_SQL}, u AS (SELECT id, unnest(['kimi_1', 'glm_1', 'qwen_2']) AS source FROM routes), o AS (SELECT id, source, sha256('blind' || chr(0) || id || chr(0) || source) AS h FROM u)
  SELECT id, string_agg(source, ',' ORDER BY h) AS sources FROM o GROUP BY id""")
def candidate_order(spark, sf):
    d = reports.candidate_order(turn_routes(spark, sf), ["kimi_1", "glm_1", "qwen_2"])
    return d.select("id", F.array_join(F.transform("blind", lambda x: x["source"]), ",").alias("sources"))


@query("bucket_windows", """WITH b AS (SELECT doc_id, n_chars // 500 AS bucket, (('0x' || substr(sha256(doc_id::VARCHAR), 1, 16))::UBIGINT % 64)::INT AS s FROM documents),
  r AS (SELECT *, (row_number() OVER (PARTITION BY bucket, s ORDER BY doc_id) - 1) // 4 AS n FROM b) SELECT doc_id, bucket::BIGINT AS bucket, bucket || '-' || s || '-' || n AS batch FROM r""")
def bucket_windows(spark, sf):
    return reports.bucket_windows(table(spark, sf, "documents"), F.floor(F.col("n_chars") / 500), 4, "doc_id").select("doc_id", "bucket", "batch")


@query("random_subset", f"SELECT doc_id FROM documents ORDER BY {_unit_sql(chr(39) + '42' + chr(39), chr(39) + 'subset' + chr(39), 'doc_id::VARCHAR')}, doc_id LIMIT 100")
def random_subset(spark, sf):
    return reports.random_subset(table(spark, sf, "documents"), 100, key="doc_id").select("doc_id")


_REP_SQL = _TURNS_SQL + """, f AS (SELECT id, unnest(['kimi', 'glm', 'qwen']) AS fam, unnest([1, 2, 3]) AS place, unnest([kimi_1, glm_1, qwen_2]) AS t FROM routes),
m AS (SELECT a.id, a.fam, a.place, a.t, round(avg(CASE WHEN a.t = '' AND b.t = '' THEN 1.0 WHEN a.t = '' OR b.t = '' THEN 1.0 ELSE round(levenshtein(a.t, b.t) / greatest(length(a.t), length(b.t)), 6) END), 6) AS distance, sum((a.t = b.t)::INT)::INT + 1 AS support FROM f a JOIN f b ON a.id = b.id AND a.fam <> b.fam GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, support DESC, place) AS rk, min(distance) OVER (PARTITION BY id) AS best FROM m),
t AS (SELECT id, count(*) FILTER (distance = best) AS tied, max(support) FILTER (distance = best) AS top FROM r GROUP BY id), w AS (SELECT r.id, count(*) AS sup FROM r JOIN t USING (id) WHERE distance = best AND support = top GROUP BY r.id)"""


@query("representative", f"""WITH {_REP_SQL} SELECT r.id, fam AS family, round(distance, 4) AS distance, support, CASE WHEN tied = 1 THEN 'min_mean_tolerant_distance' WHEN sup < tied THEN 'exact_transcript_support' ELSE 'configured_family_order' END AS reason FROM r JOIN t USING (id) JOIN w USING (id) WHERE rk = 1""")
def representative(spark, sf):
    d = turn_routes(spark, sf)
    reps = F.array(*[F.struct(F.lit(f).alias("family"), F.col(c).alias("text"), F.col(c).alias("key")) for f, c in (("kimi", "kimi_1"), ("glm", "glm_1"), ("qwen", "qwen_2"))])
    return d.select("id", reports.representative(reps, ["kimi", "glm", "qwen"]).alias("r")).select("id", "r.family", similarity.round_binary(F.col("r.distance"), 4).alias("distance"), "r.support", "r.reason")


# --- building ---------------------------------------------------------------------

_GOLD_SQL = _DOCS_SQL + """, gold AS (SELECT doc_id, doc_id::VARCHAR AS id, CASE WHEN toxic = 1 THEN 'non_speech' WHEN quality IS NOT NULL THEN 'speech' END AS gold_kind, CASE doc_id % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'neutral' ELSE 'mixed' END AS human_semantic,
  CASE WHEN n_chars % 5 = 0 THEN 'noisy' ELSE 'clean' END AS human_noise, CASE WHEN n_chars % 9 = 0 THEN 'yes' END AS human_crosstalk, CASE WHEN toxic = 1 THEN '' ELSE substr(lang, 1, 1 + (doc_id % 9)::INT) || repeat('x', (doc_id % 8)::INT) END AS gold_text,
  n_chars / 100.0 AS duration, CASE WHEN n_chars % 11 = 0 THEN ['short_utterance'] END AS risk_tags, quality = 1 AS is_human_verified, CASE WHEN n_chars % 3 = 0 THEN 'noise' WHEN n_chars % 3 = 1 THEN 'hardcase' END AS category,
  CASE WHEN doc_id % 6 = 0 THEN 'auto_classified' WHEN doc_id % 6 = 1 THEN 'hold' END AS status, CASE WHEN n_chars % 13 = 0 THEN 'semantic_only' WHEN n_chars % 13 = 1 THEN 'pseudo_verbatim_high' WHEN n_chars % 13 = 2 THEN 'pseudo_high' END AS label_tier,
  CASE WHEN doc_id % 7 = 0 THEN 'model_consensus' END AS label_source, doc_id % 5 = 0 AS pseudo_audit_passed, lang AS candidate_text FROM docs),
k AS (SELECT *, CASE WHEN gold_kind = 'non_speech' THEN 'confirmed_non_speech' WHEN human_semantic = 'negative' THEN 'negative_reject' WHEN human_semantic = 'neutral' AND (duration <= 2.0 OR length(coalesce(gold_text, '')) <= 6 OR risk_tags IS NOT NULL) THEN 'filler_neutral'
  WHEN gold_kind = 'speech' AND (human_noise = 'noisy' OR human_crosstalk = 'yes') THEN 'noisy_crosstalk_speech' WHEN human_semantic = 'positive' THEN 'positive' ELSE 'other' END AS stratum, coalesce(is_human_verified, false) AS hv,
  (risk_tags IS NOT NULL OR human_semantic IN ('negative', 'mixed') OR human_noise = 'noisy' OR coalesce(human_crosstalk = 'yes', false) OR duration <= 2.0 OR length(coalesce(gold_text, '')) BETWEEN 1 AND 6) AS risky FROM gold),
l AS (SELECT *, CASE WHEN label_tier = 'semantic_only' THEN 'semantic_layer_not_verbatim' WHEN label_tier = 'pseudo_verbatim_high' AND NOT pseudo_audit_passed THEN 'pseudo_verbatim_pending_audit' WHEN status = 'auto_classified' AND NOT hv THEN 'auto_classified_not_accepted'
  WHEN category IS NULL AND status IS NULL THEN NULL WHEN category = 'noise' AND NOT hv THEN 'noise_not_speech_target' WHEN category = 'hardcase' AND NOT hv THEN 'unreviewed_manual' WHEN status = 'hold' AND NOT hv THEN 'status_hold_not_accepted'
  WHEN label_source = 'model_consensus' AND NOT hv THEN 'model_candidate_not_human' END AS blocked FROM k),
q AS (SELECT *, CASE WHEN blocked IS NOT NULL THEN NULL WHEN hv AND ((gold_kind = 'speech' AND trim(coalesce(gold_text, '')) <> '') OR (gold_kind = 'non_speech' AND gold_text = '')) THEN CASE WHEN n_chars % 4 = 0 THEN 'qwen_error_fix' WHEN risky THEN 'human_high_risk' ELSE 'human_ordinary' END
  WHEN label_tier = 'pseudo_high' AND trim(coalesce(candidate_text, '')) <> '' AND pseudo_audit_passed THEN 'pseudo_high_audited' END AS pool FROM l JOIN (SELECT doc_id, n_chars FROM documents) USING (doc_id))"""


def _gold(spark, sf):
    d = documents(spark, sf)
    n, c = F.col("doc_id"), F.col("n_chars")
    return d.select(
        "doc_id", F.col("doc_id").cast("string").alias("id"), "sha256", "lang", "n_chars", F.when(F.col("toxic") == 1, "non_speech").when(F.col("quality").isNotNull(), "speech").alias("gold_kind"), F.when(n % 4 == 0, "positive").when(n % 4 == 1, "negative").when(n % 4 == 2, "neutral").otherwise("mixed").alias("human_semantic"),
        F.when(c % 5 == 0, "noisy").otherwise("clean").alias("human_noise"), F.when(c % 9 == 0, "yes").alias("human_crosstalk"), F.when(F.col("toxic") == 1, "").otherwise(F.expr("concat(substring(lang, 1, cast(1 + doc_id % 9 as int)), repeat('x', cast(doc_id % 8 as int)))")).alias("gold_text"),
        (c / 100.0).alias("duration"), F.when(c % 11 == 0, F.array(F.lit("short_utterance"))).alias("risk_tags"), (F.col("quality") == 1).alias("is_human_verified"), F.when(c % 3 == 0, "noise").when(c % 3 == 1, "hardcase").alias("category"),
        F.when(n % 6 == 0, "auto_classified").when(n % 6 == 1, "hold").alias("status"), F.when(c % 13 == 0, "semantic_only").when(c % 13 == 1, "pseudo_verbatim_high").when(c % 13 == 2, "pseudo_high").alias("label_tier"), F.lit(None).cast("string").alias("label_grade"),
        F.when(n % 7 == 0, "model_consensus").alias("label_source"), (n % 5 == 0).alias("pseudo_audit_passed"), F.lit(False).alias("pseudo_audit_stopped"), F.col("lang").alias("candidate_text"), F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("decision"),
    )


def _pooled(spark, sf):
    d = _gold(spark, sf)
    return d.withColumns({"stratum": building.eval_stratum(), "blocked": building.blocked_target(), "pool": building.train_pool(F.col("n_chars") % 4 == 0, F.lit(True))})


@query("eval_strata", f"WITH {_GOLD_SQL} SELECT doc_id, stratum, blocked, pool FROM q")
def eval_strata(spark, sf):
    return _pooled(spark, sf).select("doc_id", "stratum", "blocked", "pool")


_PLAN_SQL = _GOLD_SQL + f""", s AS (SELECT q.*, CASE WHEN doc_id // 10 % 5 = 0 THEN 'eval_random' WHEN doc_id // 10 % 5 = 1 THEN 'eval_core_reserve' WHEN doc_id // 10 % 5 = 2 THEN 'dev' ELSE 'train_pool' END AS role, gold_kind IS NOT NULL AS formal, n_chars % 17 = 0 AS abstain, doc_id % 2 = 0 AS drawn FROM q),
er AS (SELECT id, 'eval_random' AS split, 'overall' AS stratum FROM s WHERE role = 'eval_random' AND formal AND NOT abstain ORDER BY NOT drawn, {_unit_sql("'42'", "'eval_random'", "id")}, '42|eval_random|' || id LIMIT 15),
ec AS (SELECT id, 'eval_core' AS split, stratum FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {_unit_sql("'42'", "'eval_core:' || stratum", "id")}) AS r FROM s WHERE role = 'eval_core_reserve' AND formal AND NOT abstain) WHERE (stratum = 'negative_reject' AND r <= 6) OR (stratum = 'positive' AND r <= 4)),
dv AS (SELECT id, 'dev' AS split, 'overall' AS stratum FROM s WHERE role = 'dev' AND formal AND NOT abstain),
tr AS (SELECT id, 'train' AS split, pool AS stratum FROM (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY {_unit_sql("'42'", "'train:' || pool", "id")}) AS r FROM s WHERE role = 'train_pool') WHERE r <= CASE pool WHEN 'qwen_error_fix' THEN 8 WHEN 'human_high_risk' THEN 6 WHEN 'human_ordinary' THEN 4 WHEN 'pseudo_high_audited' THEN 2 END),
al AS (SELECT * FROM er UNION ALL SELECT * FROM ec UNION ALL SELECT * FROM dv UNION ALL SELECT * FROM tr)"""


def _plan(spark, sf):
    d, g = _pooled(spark, sf), F.floor(F.col("doc_id") / 10)
    role = F.when(g % 5 == 0, "eval_random").when(g % 5 == 1, "eval_core_reserve").when(g % 5 == 2, "dev").otherwise("train_pool")
    none = F.lit(None).cast("string")
    s = d.withColumns({"role": role, "group_id": g.cast("string"), "drawn": F.col("doc_id") % 2 == 0, "call": F.col("id"), "dup": none, "formal": F.col("gold_kind").isNotNull(), "abstain": F.col("n_chars") % 17 == 0, "disturbed": (F.col("human_noise") == "noisy") | F.col("human_crosstalk").isNotNull()})
    limits = {"min_positive": 0.2, "min_negative": 0.2, "min_disturbed": 0.5, "max_non_speech": 0.1, "max_pseudo": 0.05}
    return s, building.sampling_plan(s, 15, {"negative_reject": 6, "positive": 4}, 20, {"qwen_error_fix": 0.4, "human_high_risk": 0.3, "human_ordinary": 0.2, "pseudo_high_audited": 0.1}, limits=limits)


@query("sampling_plan", f"WITH {_PLAN_SQL} SELECT id, split, stratum FROM al")
def sampling_plan(spark, sf):
    return _plan(spark, sf)[1].rows


@query("plan_shortfalls", f"""WITH {_PLAN_SQL}, w AS (SELECT * FROM (VALUES ('eval_random', 'overall', 15, 'insufficient_dual_reviewed_evaluable_samples'), ('eval_core', 'negative_reject', 6, 'stratum_quota_shortfall'), ('eval_core', 'positive', 4, 'stratum_quota_shortfall'),
    ('train', 'qwen_error_fix', 8, 'train_pool_quota_shortfall'), ('train', 'human_high_risk', 6, 'train_pool_quota_shortfall'), ('train', 'human_ordinary', 4, 'train_pool_quota_shortfall'), ('train', 'pseudo_high_audited', 2, 'train_pool_quota_shortfall')) v(split, stratum, requested, reason)),
  c AS (SELECT w.*, (SELECT count(*) FROM al WHERE al.split = w.split AND al.stratum = w.stratum) AS available FROM w), t AS (SELECT s.* FROM al JOIN s USING (id) WHERE al.split = 'train'), h AS (SELECT count(*) FILTER (human_semantic = 'positive') AS p, count(*) FILTER (human_semantic = 'negative') AS n,
    count(*) FILTER (gold_kind = 'speech' AND (human_noise = 'noisy' OR human_crosstalk IS NOT NULL)) AS d, count(*) FILTER (gold_kind = 'non_speech') AS e, (SELECT count(*) FROM al WHERE stratum = 'pseudo_high_audited') AS u FROM t)
  SELECT split, stratum, requested::BIGINT AS requested, available, reason FROM c WHERE available < requested UNION ALL SELECT 'train', 'cross:positive', 4, p, 'cross_constraint_min_positive' FROM h WHERE p < 4 UNION ALL SELECT 'train', 'cross:negative', 4, n, 'cross_constraint_min_negative' FROM h WHERE n < 4
  UNION ALL SELECT 'train', 'cross:disturbed', 10, d, 'cross_constraint_min_disturbed' FROM h WHERE d < 10 UNION ALL SELECT 'train', 'cross:non_speech', 2, e, 'cross_constraint_max_non_speech_exceeded' FROM h WHERE e > 2 UNION ALL SELECT 'train', 'cross:pseudo', 1, u, 'cross_constraint_max_pseudo_exceeded' FROM h WHERE u > 1""")
def plan_shortfalls(spark, sf):
    return _plan(spark, sf)[1].shortfalls


@query("stamp_plan", f"WITH {_PLAN_SQL} SELECT al.id, al.split, al.stratum, CASE WHEN al.stratum = 'pseudo_high_audited' THEN candidate_text ELSE gold_text END AS target_text FROM al JOIN s USING (id)")
def stamp_plan(spark, sf):
    s, plan = _plan(spark, sf)
    return building.stamp_plan(s, plan.rows, F.col("gold_text"), F.col("blocked")).select("id", "split", "stratum", "target_text")


@query("audit_plan", f"""WITH p AS (SELECT doc_id AS id, source AS g, n_chars FROM documents), o AS (SELECT DISTINCT g FROM p ORDER BY {_unit_sql("'42'", "'overall_group'", "g")}, '42|overall_group|' || g LIMIT 8), y AS (SELECT DISTINCT g FROM p WHERE n_chars <= 300 ORDER BY {_unit_sql("'42'", "'layer:short_group'", "g")}, '42|layer:short_group|' || g LIMIT 4),
  a AS (SELECT 'overall' AS draw, id, row_number() OVER (PARTITION BY g ORDER BY {_unit_sql("'42'", "'overall_sample'", "id::VARCHAR")}) AS r FROM p WHERE g IN (SELECT g FROM o)), b AS (SELECT 'short' AS draw, id, row_number() OVER (PARTITION BY g ORDER BY {_unit_sql("'42'", "'layer:short_sample'", "id::VARCHAR")}) AS r FROM p WHERE n_chars <= 300 AND g IN (SELECT g FROM y))
  SELECT draw, id FROM a WHERE r = 1 UNION ALL SELECT draw, id FROM b WHERE r = 1""")
def audit_plan(spark, sf):
    d = documents(spark, sf).where("source is not null").select(F.col("doc_id").alias("id"), F.col("source").alias("group_id"), F.coalesce("sha256", F.lit("none")).alias("sha256"), "n_chars", F.lit(False).alias("is_human_verified"))
    return building.audit_plan(d, {"short": (F.col("n_chars") <= 300, 4)}, 8)


_FREEZE_SQL = _DOCS_SQL + """, r AS (SELECT doc_id AS k, CASE WHEN doc_id % 10 = 3 THEN 'x' || doc_id ELSE sha256 END AS h, CASE doc_id % 7 WHEN 0 THEN 'pending' WHEN 1 THEN 'conflict' WHEN 2 THEN 'annotated' WHEN 3 THEN 'second_review' WHEN 4 THEN 'rejected' WHEN 5 THEN 'odd' ELSE 'adjudicated' END AS st,
  CASE WHEN toxic = 1 THEN 'invalid' WHEN quality = 1 THEN 'speech' END AS kind, CASE WHEN n_chars % 3 = 0 THEN 'speech' WHEN n_chars % 3 = 1 THEN ' ' ELSE 'other' END AS cat, n_chars % 2 = 0 AS dual FROM docs WHERE doc_id % 13 <> 0 UNION ALL SELECT -1 - item_id, 'b' || item_id, 'rejected', NULL, 'speech', false FROM benchmark),
p AS (SELECT CASE WHEN r.k IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'extra' WHEN r.h IS DISTINCT FROM d.sha256 THEN 'changed_audio' END AS problem FROM r FULL JOIN docs d ON r.k = d.doc_id UNION ALL SELECT 'duplicate_audio' FROM (SELECT h FROM r WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1)
  UNION ALL SELECT 'category_not_allowed' FROM r WHERE cat <> 'speech' UNION ALL SELECT CASE WHEN st = 'pending' THEN 'pending_annotation' WHEN st = 'conflict' THEN 'unresolved_conflict' WHEN st = 'odd' THEN 'incomplete_state:odd' WHEN dual AND st = 'annotated' THEN 'dual_review_incomplete'
    WHEN st = 'rejected' OR coalesce(kind = 'invalid', false) THEN NULL WHEN kind IS NULL THEN 'missing_gold_kind' END FROM r)"""


@query("freeze_problems", f"WITH {_FREEZE_SQL} SELECT problem, count(*) AS n FROM p WHERE problem IS NOT NULL GROUP BY problem")
def freeze_problems(spark, sf):
    d, n = documents(spark, sf), F.col("doc_id")
    state = F.when(n % 7 == 0, "pending").when(n % 7 == 1, "conflict").when(n % 7 == 2, "annotated").when(n % 7 == 3, "second_review").when(n % 7 == 4, "rejected").when(n % 7 == 5, "odd").otherwise("adjudicated")
    rows = d.where("doc_id % 13 <> 0").select(
        n.alias("id"), F.when(n % 10 == 3, F.concat(F.lit("x"), n.cast("string"))).otherwise(F.col("sha256")).alias("sha256"), state.alias("annotation_state"), F.when(F.col("toxic") == 1, "invalid").when(F.col("quality") == 1, "speech").alias("gold_kind"),
        F.when(F.col("n_chars") % 3 == 0, "speech").when(F.col("n_chars") % 3 == 1, " ").otherwise("other").alias("reviewed_category"), (F.col("n_chars") % 2 == 0).alias("dual"),
    )
    extra = table(spark, sf, "benchmark").select((-1 - F.col("item_id")).alias("id"), F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("sha256"), F.lit("rejected").alias("annotation_state"), F.lit(None).cast("string").alias("gold_kind"), F.lit("speech").alias("reviewed_category"), F.lit(False).alias("dual"))
    rows = rows.unionByName(extra).withColumns({"category": F.lit(None).cast("string"), "decision": F.lit(None).cast("string")})
    return building.freeze_problems(rows, d.select(n.alias("id"), "sha256"), ["speech"], F.col("dual"))


@query("annotation_package", f"""WITH {_TURNS_SQL}, u AS (SELECT id, unnest(['glm_1', 'qwen_1']) AS source, unnest([glm_1, qwen_1]) AS t FROM routes), o AS (SELECT id, t, sha256('batch1' || chr(0) || id || chr(0) || source) AS h FROM u)
  SELECT id, string_agg(coalesce(t, ''), '|' ORDER BY h) AS texts FROM o GROUP BY id""")
def annotation_package(spark, sf):
    d = turn_routes(spark, sf).withColumns({"sha256": F.sha2("kimi_1", 256), "review_queue": F.lit("main")})
    return building.annotation_package(d, ["glm_1", "qwen_1"], "batch1").select("id", F.array_join(F.transform("candidates", lambda x: x["text"]), "|").alias("texts"))


# --- rule sets over Chinese answers -------------------------------------------------

_SAID, _ELSE = "今天下午三点我们在公司会议室见面讨论合同", "明天上午九点他们到机场接人然后回去"
#: Code of a family's text -> text; 1 is the turn's own text with a sentence behind it, 5 a route that is missing.
_CODES = {"kimi": "(conv_id + turn * 3) % 6", "glm": "((conv_id // 2) + turn) % 6", "qwen": "((conv_id // 3) + turn * 2) % 6"}
_CASE = f"CASE {{c}} WHEN 0 THEN '' WHEN 1 THEN t || '{_SAID}' WHEN 2 THEN '需要' WHEN 3 THEN '不需要' WHEN 4 THEN '{_ELSE}' END"
_ANSWER_SQL = (
    _TURNS_SQL + ", x AS (SELECT id, conv_id, turn, t FROM turns), y AS (" + " UNION ALL ".join(f"SELECT id, conv_id, turn, {i} AS place, '{f}' AS fam, {_CASE.format(c=c)} AS a, {_CASE.format(c=c if f != 'glm' else f'CASE WHEN (conv_id + turn) % 9 = 0 THEN 1 ELSE {c} END')} AS b FROM x" for i, (f, c) in enumerate(_CODES.items()))
    + """), s AS (SELECT *, CASE WHEN a IS NULL OR b IS NULL THEN 'unavailable' WHEN a = '' AND b = '' THEN 'stable_empty' WHEN a = b THEN 'stable_text' ELSE 'unstable' END AS st,
  CASE WHEN conv_id % 13 = 0 OR (conv_id % 13 = 1 AND fam = 'kimi') THEN 'unavailable' WHEN coalesce(a, '') <> '' AND a = b THEN 'stable_text' WHEN coalesce(a, '') <> '' OR coalesce(b, '') <> '' THEN 'unstable' WHEN a = '' AND b = '' THEN 'stable_empty' ELSE 'unavailable' END AS st1,
  CASE WHEN conv_id % 13 = 0 OR (conv_id % 13 = 1 AND fam = 'kimi') THEN NULL ELSE coalesce(nullif(a, ''), nullif(b, '')) END AS said, conv_id % 13 <> 0 AND NOT (conv_id % 13 = 1 AND fam = 'kimi') AND (a IS NOT NULL OR b IS NOT NULL) AS able FROM y),
n AS (SELECT id, conv_id, turn, CASE turn % 5 WHEN 2 THEN 'inaudible' WHEN 3 THEN 'borderline' WHEN 4 THEN CASE WHEN conv_id % 2 = 0 THEN 'audio_too_short' ELSE 'failed' END ELSE 'audible' END AS e, conv_id % 4 = 2 AS env,
  count(*) FILTER (st = 'stable_text') AS nt, count(*) FILTER (st = 'stable_empty') AS se, count(*) FILTER (st = 'unstable') AS un, count(*) FILTER (st = 'unavailable') AS na, count(DISTINCT a) FILTER (st = 'stable_text') AS kinds,
  count(*) FILTER (st = 'stable_text' AND a = '需要') AS pos, count(*) FILTER (st = 'stable_text' AND a = '不需要') AS neg, count(*) FILTER (st1 = 'stable_text') AS nt1, count(*) FILTER (st1 = 'stable_empty') AS se1, count(*) FILTER (st1 = 'unstable') AS un1,
  count(DISTINCT a) FILTER (st1 = 'stable_text') AS kinds1, count(*) FILTER (st1 = 'stable_text' AND a = '需要') AS pos1, count(*) FILTER (st1 = 'stable_text' AND a = '不需要') AS neg1, count(DISTINCT said) AS said1, count(*) FILTER (able) AS able FROM s GROUP BY id, conv_id, turn)"""
)


def _answers(spark, sf):
    d = turn_routes(spark, sf)
    said = lambda c: f"CASE {c} WHEN 0 THEN '' WHEN 1 THEN concat(kimi_1, '{_SAID}') WHEN 2 THEN '需要' WHEN 3 THEN '不需要' WHEN 4 THEN '{_ELSE}' END".replace("//", "DIV")
    entry = lambda e: F.struct(F.expr(e).alias("text"), *[F.lit(None).cast(k).alias(n) for n, k in (("model", "string"), ("version", "string"), ("confidence", "double"), ("status", "string"), ("extra", "map<string,string>"))])
    cells = []
    for f, c in _CODES.items():
        second = c if f != "glm" else f"CASE WHEN (conv_id + turn) % 9 = 0 THEN 1 ELSE {c} END"
        cells += [F.lit(f"{f}_1"), entry(said(c)), F.lit(f"{f}_2"), entry(said(second))]
    d = d.select("id", "conv_id", "turn", F.lit(10.0).alias("duration"), F.create_map(*cells).alias("transcripts"))
    g = consensus.gather(routes.explode_routes(d, FAMILIES)).join(d.select("id", "conv_id", "turn", "transcripts"), "id")
    t, c = F.col("turn") % 5, F.col("conv_id")
    energy = F.when(t == 2, "inaudible").when(t == 3, "borderline").when(t == 4, F.when(c % 2 == 0, "audio_too_short").otherwise("failed")).otherwise("audible")
    runs = F.transform("routes", lambda r: r["run_id"])
    none = {n: F.lit(None).cast(k) for n, k in (("no_target_speech", "boolean"), ("target_speech_present", "boolean"), ("short_response_missed", "boolean"), ("unclear_polarity", "boolean"), ("human_no_target", "boolean"), ("dnsmos_bak", "double"), ("dnsmos_ovrl", "double"), ("dnsmos_sig", "double"), ("dnsmos_status", "string"), ("crosstalk_confirmed", "boolean"))}
    return g.withColumns({"broken": F.lit(False), "energy": energy, "acoustic_state": F.when(c % 4 == 2, "environment_confirmed"), "excluded_runs": F.when(c % 13 == 0, runs).when(c % 13 == 1, F.filter(runs, lambda r: F.startswith(r, F.lit("kimi")))), **none})


_TAIL_SQL = """WHEN e = 'borderline' THEN 'energy_borderline' WHEN e = 'failed' THEN 'energy_failed' WHEN un > 0 THEN 'family_unstable' {short} WHEN se >= 2 AND nt = 1 THEN 'single_text_family_not_auto_noise'
  WHEN kinds >= 2 THEN 'substantive_divergence_non_strict_risk' WHEN na > 0 OR nt + se < 3 THEN 'insufficient_family_evidence' ELSE 'unresolved_rules' END"""


@query("classify_five_v1", f"""WITH {_ANSWER_SQL} SELECT id, CASE WHEN conv_id % 13 = 0 THEN 'all_routes_excluded' WHEN able = 0 THEN 'partial_exclude_rest_failed' WHEN se1 > 0 AND pos1 + neg1 > 0 AND env THEN 'hallucinated_assertion' WHEN pos1 > 0 AND neg1 > 0 THEN 'semantic_reversal'
  WHEN env THEN 'environment_noise_confirmed' WHEN nt1 >= 3 AND kinds1 = 1 AND un1 = 0 THEN 'gold_candidate' WHEN said1 >= 2 THEN 'hardcase_substantive_divergence' ELSE 'manual_annotation_insufficient_evidence' END AS reason FROM n""")
def classify_five_v1(spark, sf):
    return five_class.classify_five_v1(_answers(spark, sf), FAMILIES).select("id", "reason")


@query("classify_five_v2", f"""WITH {_ANSWER_SQL} SELECT id, CASE WHEN pos > 0 AND neg > 0 THEN 'semantic_reversal' WHEN e = 'audio_too_short' THEN 'environment_noise_audio_too_short' WHEN se = 3 AND e = 'audible' THEN 'environment_noise_background' WHEN se = 3 AND e = 'inaudible' THEN 'environment_noise_silence'
  WHEN se = 2 AND nt = 1 AND e = 'audible' AND pos + neg = 0 THEN 'environment_noise_human_noise' WHEN nt >= 2 AND kinds = 1 AND un = 0 THEN 'gold_candidate' {_TAIL_SQL.format(short="WHEN se = 2 AND nt = 1 AND pos + neg > 0 THEN 'critical_short_response_unsupported'")} AS reason FROM n""")
def classify_five_v2(spark, sf):
    return five_class.classify_five_v2(_answers(spark, sf), FAMILIES).select("id", "reason")


@query("classify_five_v2_2", f"""WITH {_ANSWER_SQL} SELECT id, CASE WHEN pos > 0 AND neg > 0 THEN 'semantic_reversal' WHEN e = 'audio_too_short' THEN 'environment_noise_audio_too_short' WHEN se = 3 AND e = 'audible' THEN 'environment_noise_background' WHEN se = 3 AND e = 'inaudible' THEN 'environment_noise_silence'
  WHEN se = 2 AND nt = 1 AND e = 'audible' AND pos + neg = 0 THEN 'environment_noise_human_noise' WHEN nt >= 2 AND kinds = 1 AND un = 0 THEN 'gold_candidate' {_TAIL_SQL.format(short="WHEN se >= 2 AND nt = 1 AND pos + neg > 0 THEN 'critical_short_response_unsupported'")} AS reason FROM n""")
def classify_five_v2_2(spark, sf):
    return classify.classify_five(_answers(spark, sf), FAMILIES).select("id", "reason")


# --- evidence and counts ------------------------------------------------------------

_ACOUSTIC_SQL = _DOCS_SQL + """, v AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'no' WHEN 2 THEN 'YES' END AS gone, CASE WHEN n_chars % 3 = 0 THEN '1' END AS sure, CASE WHEN n_chars % 5 = 0 THEN 'true' END AS over, CASE WHEN n_chars % 2 = 0 THEN 'true' ELSE 'false' END AS over_sure,
  CASE WHEN doc_id % 11 = 0 THEN 'true' END AS human, CASE doc_id % 7 WHEN 0 THEN 'music' WHEN 1 THEN 'voice' END AS back FROM docs)"""


@query("acoustic_evidence", f"""WITH {_ACOUSTIC_SQL} SELECT doc_id, CASE WHEN gone IN ('true', 'YES') AND sure = '1' THEN 'environment_confirmed' WHEN (over = 'true' AND over_sure = 'true') OR human = 'true' THEN 'crosstalk_confirmed' WHEN back = 'music' THEN 'background_only' ELSE 'unknown' END AS state,
  concat_ws(',', CASE WHEN gone IN ('true', 'YES') THEN CASE WHEN sure IS NULL THEN 'no_target_speech_untrusted' END ELSE 'no_target_speech_missing' END, CASE WHEN over = 'true' THEN CASE WHEN over_sure = 'false' THEN 'overlap_untrusted' END ELSE 'overlap_detector_missing' END, 'vad_uncalibrated', 'dnsmos_uncalibrated') AS gaps FROM v""")
def acoustic_evidence(spark, sf):
    d, i, n = documents(spark, sf), F.col("doc_id"), F.col("n_chars")
    cells = {
        "no_target_speech": F.when(i % 4 == 0, "true").when(i % 4 == 1, "no").when(i % 4 == 2, "YES"), "no_target_speech_trusted": F.when(n % 3 == 0, "1"), "overlap_detected": F.when(n % 5 == 0, "true"), "overlap_detected_trusted": F.when(n % 2 == 0, "true").otherwise("false"),
        "human_crosstalk_confirmed": F.when(i % 11 == 0, "true"), "background_label": F.when(i % 7 == 0, "music").when(i % 7 == 1, "voice"),
    }
    d = d.withColumns({"quality": F.create_map(*[x for k, v in cells.items() for x in (F.lit(k), v)]), "labels": F.create_map().cast("map<string,string>")})
    e = d.select("doc_id", evidence.acoustic_evidence().alias("e"))
    return e.select("doc_id", "e.state", F.array_join("e.gaps", ",").alias("gaps"))


@query("older_names", f"""WITH {_DOCS_SQL}, v AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'gold' WHEN 1 THEN 'noise' WHEN 2 THEN 'voicemail' WHEN 3 THEN 'hardcase' WHEN 4 THEN 'semantic_risk' END AS c, CASE n_chars % 4 WHEN 0 THEN 'candidate' WHEN 1 THEN 'manual_review' WHEN 2 THEN 'retry' ELSE 'excluded' END AS s, CASE WHEN doc_id % 5 = 0 THEN 'route_quarantine_x' END AS why FROM docs)
  SELECT doc_id, CASE WHEN s = 'excluded' THEN 'invalid_audio' WHEN c IN ('semantic_risk', 'hardcase') AND s = 'manual_review' THEN c WHEN c IN ('noise', 'voicemail', 'gold') AND s = 'candidate' THEN c WHEN s = 'retry' THEN CASE WHEN why IS NULL THEN 'inference_incomplete' ELSE 'route_quarantine' END ELSE 'hold_unclassified' END AS type,
  CASE WHEN s = 'excluded' THEN 'exclude' WHEN c IN ('semantic_risk', 'hardcase') AND s = 'manual_review' THEN 'manual_review' WHEN c = 'noise' AND s = 'candidate' THEN 'noise_archive' WHEN c = 'voicemail' AND s = 'candidate' THEN 'voicemail_spot_audit' WHEN c = 'gold' AND s = 'candidate' THEN 'spot_audit' WHEN s = 'retry' THEN 'retry' ELSE 'hold' END AS review_queue FROM v""")
def older_names(spark, sf):
    d, i, n = documents(spark, sf), F.col("doc_id"), F.col("n_chars")
    c = F.when(i % 6 == 0, "gold").when(i % 6 == 1, "noise").when(i % 6 == 2, "voicemail").when(i % 6 == 3, "hardcase").when(i % 6 == 4, "semantic_risk")
    s = F.when(n % 4 == 0, "candidate").when(n % 4 == 1, "manual_review").when(n % 4 == 2, "retry").otherwise("excluded")
    m = d.select("doc_id", evidence.older_names(c, s, F.when(i % 5 == 0, "route_quarantine_x")).alias("m"))
    return m.select("doc_id", "m.type", "m.review_queue")


@query("batch_counts", f"""WITH {_DOCS_SQL} SELECT 'lang' AS field, coalesce(lang, 'None') AS value, count(*) AS n FROM docs GROUP BY 2 UNION ALL SELECT 'quality', coalesce(quality::VARCHAR, 'None'), count(*) FROM docs GROUP BY 2
  UNION ALL SELECT 'tags', t, count(*) FROM (SELECT unnest(CASE WHEN toxic = 1 THEN ['toxic', 'held'] WHEN n_chars < 300 THEN ['short'] ELSE [] END) AS t FROM docs) GROUP BY t""")
def batch_counts(spark, sf):
    tags = F.when(F.col("toxic") == 1, F.array(F.lit("toxic"), F.lit("held"))).when(F.col("n_chars") < 300, F.array(F.lit("short")))
    return evidence.batch_counts(documents(spark, sf).withColumn("tags", tags), ["lang", "quality"], ["tags"])


@query("package_checks", "SELECT count(*) FILTER (doc_id % 6 = 0) AS parts_overlap, count(*) FILTER (doc_id % 2 <> 0 AND doc_id % 3 <> 0) = 0 AS parts_cover FROM documents")
def package_checks(spark, sf):
    d = table(spark, sf, "documents")
    return evidence.package_checks(d, {"a": d.where("doc_id % 2 = 0"), "b": d.where("doc_id % 3 = 0")}, "doc_id")


_VOTES_SQL = (
    _ANSWER_SQL + """, v AS (SELECT id, fam, coalesce(a, '') AS t FROM y UNION ALL SELECT id, fam, coalesce(b, '') FROM y), w AS (SELECT *, CASE WHEN t = '不需要' THEN 'negative' WHEN t = '需要' THEN 'positive' ELSE 'none' END AS cls FROM v WHERE t <> ''),
f AS (SELECT id, fam, count(*) AS k, count(DISTINCT t) AS kinds, min(t) AS t, CASE WHEN count(DISTINCT cls) FILTER (cls <> 'none') = 1 THEN min(cls) FILTER (cls <> 'none') WHEN count(DISTINCT cls) FILTER (cls <> 'none') = 0 THEN 'none' ELSE 'conflict' END AS sem FROM w GROUP BY id, fam),
p AS (SELECT id, count(*) AS fams, count(*) FILTER (sem = 'positive') AS pos, count(*) FILTER (sem = 'negative') AS neg, coalesce(max(sem) FILTER (fam = 'qwen'), 'none') AS prim, coalesce(max(sem) FILTER (fam = 'glm'), 'none') AS sec, count(*) FILTER (fam = 'qwen') AS has_prim,
  count(*) FILTER (kinds > 1) AS torn, count(*) FILTER (kinds = 1) AS voters, count(DISTINCT t) FILTER (kinds = 1) AS voter_kinds FROM f GROUP BY id),
b AS (SELECT id, count(*) AS said, count(DISTINCT t) AS kinds, count(DISTINCT cls) FILTER (cls <> 'none') AS classes, count(DISTINCT cls) AS groups, count(*) FILTER (length(t) <= 6) AS short FROM w GROUP BY id), c AS (SELECT id, max(k) AS best FROM (SELECT id, t, count(*) AS k, count(DISTINCT fam) AS fs FROM w GROUP BY id, t) WHERE fs >= 2 GROUP BY id),
z AS (SELECT t.id, coalesce(said, 0) AS said, coalesce(b.kinds, 0) AS kinds, coalesce(classes, 0) AS classes, coalesce(groups, 0) AS groups, coalesce(short, 0) AS short, coalesce(fams, 0) AS fams, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg, coalesce(prim, 'none') AS prim, coalesce(sec, 'none') AS sec, coalesce(has_prim, 0) AS has_prim, coalesce(torn, 0) AS torn,
  coalesce(voters, 0) AS voters, coalesce(voter_kinds, 0) AS voter_kinds, coalesce(best, 0) AS best FROM turns t LEFT JOIN b USING (id) LEFT JOIN p USING (id) LEFT JOIN c USING (id))"""
)


@query("classify_v1_answers", f"""WITH {_VOTES_SQL} SELECT id, CASE WHEN said = 0 THEN 'empty_asr_transcripts' WHEN prim IN ('positive', 'negative') AND sec IN ('positive', 'negative') AND prim <> sec THEN CASE WHEN (pos >= 2 AND pos > neg) OR (neg >= 2 AND neg > pos) THEN 'semantic_inversion_majority' ELSE 'semantic_inversion_unresolved' END
  WHEN has_prim = 0 AND said > 0 THEN 'primary_family_empty_conflict' WHEN said <= 1 AND fams = 1 THEN 'hallucination_other_families_empty' WHEN said < 2 OR fams < 2 THEN 'insufficient_independent_families' WHEN said = 6 AND kinds = 1 THEN 'all_models_strict_consensus'
  WHEN best >= 5 THEN 'dominant_cross_family_cluster' ELSE 'no_reliable_consensus' END AS reason FROM z""")
def classify_v1_answers(spark, sf):
    d = _answers(spark, sf).withColumn("broken", F.lit(False))
    return classify.classify_v1(d, FAMILIES.runs, secondary="glm").select("id", "reason")


@query("classify_v2_answers", f"""WITH {_VOTES_SQL} SELECT id, CASE WHEN said = 0 THEN 'all_empty_possible_speech_or_unknown' WHEN pos > 0 AND neg > 0 THEN 'semantic_polarity_family_conflict' WHEN groups > 1 THEN 'critical_token_presence_conflict' WHEN short > 0 AND fams < 2 THEN 'short_utterance_without_strict_agreement'
  WHEN said <= 1 AND fams = 1 THEN 'empty_majority_single_family_with_speech_or_unknown' WHEN has_prim = 0 AND said > 0 THEN 'primary_family_empty_conflict' WHEN torn > 0 AND voters < 2 THEN 'family_internal_conflict_blocks_voting' WHEN said < 2 OR fams < 2 THEN 'insufficient_independent_families'
  WHEN (said = 6 AND kinds = 1) OR (said < 6 AND voters >= 2 AND voter_kinds = 1) OR (said < 6 AND voters < 2 AND kinds = 1) THEN 'strict_cross_family_consensus' WHEN best >= 5 THEN 'dominant_cross_family_cluster' ELSE 'no_reliable_consensus' END AS reason FROM z""")
def classify_v2_answers(spark, sf):
    d = _answers(spark, sf).withColumns({"broken": F.lit(False), "speech_ratio": F.lit(None).cast("double"), "vad_edge_risk": F.lit(None).cast("boolean"), "overlap_risk": F.lit(False), "has_speech": F.lit(None).cast("boolean")})
    return classify.classify_v2(d, FAMILIES.runs).select("id", "reason")


#: Short answers, one for each act; the last is the turn's own text with a time and an amount behind it.
_SHORT = ["", "转至语音信箱", "他不在", "我不需要", "回头再打", "你是谁", "你说", "嗯", "需要", "你好", "我同意"]
_ACTS_SQL = _TURNS_SQL + """, k AS (SELECT id, (conv_id * 5 + turn) % 12 AS k FROM turns), a AS (SELECT id, k, ['empty', 'voicemail', 'absence', 'refusal', 'callback', 'identity_inquiry', 'continue_listening', 'brief_response', 'affirmation_undetermined', 'greeting', 'acceptance', 'unknown'][k + 1] AS act FROM k)"""


@query("business_answers", f"""WITH {_ACTS_SQL} SELECT id, act, CASE act WHEN 'empty' THEN 'none' WHEN 'voicemail' THEN 'mailbox_prompt' WHEN 'absence' THEN 'third_party_unavailable' WHEN 'refusal' THEN 'decline_offer' WHEN 'callback' THEN 'defer_contact' WHEN 'identity_inquiry' THEN 'ask_identity' WHEN 'continue_listening' THEN 'yield_floor'
    WHEN 'brief_response' THEN 'backchannel' WHEN 'affirmation_undetermined' THEN 'possible_assent' WHEN 'greeting' THEN 'greeting' WHEN 'acceptance' THEN 'stated_assent' ELSE 'unknown' END AS intent,
  CASE WHEN act = 'refusal' THEN 'negative' WHEN act IN ('affirmation_undetermined', 'acceptance') THEN 'positive' WHEN act = 'unknown' THEN 'unknown' ELSE 'neutral' END AS polarity, CASE WHEN act = 'empty' THEN 'none' WHEN act = 'voicemail' THEN 'system' WHEN act = 'absence' THEN 'third_party' WHEN act = 'continue_listening' THEN 'other' WHEN act IN ('refusal', 'acceptance') THEN 'caller' ELSE 'unspecified' END AS subject,
  CASE WHEN act = 'unknown' THEN 'amount:100元,time:三点,time:明天' ELSE '' END AS slots, CASE act WHEN 'empty' THEN 'none' WHEN 'voicemail' THEN 'none' WHEN 'absence' THEN 'none' WHEN 'refusal' THEN 'stated_refusal' WHEN 'unknown' THEN 'unknown' ELSE 'undetermined' END AS commitment,
  CASE act WHEN 'refusal' THEN 'predicate' WHEN 'unknown' THEN 'unknown' ELSE 'none' END AS negation_scope, CASE act WHEN 'empty' THEN 'no_speech_text' WHEN 'voicemail' THEN 'automated_prompt' WHEN 'absence' THEN 'party_unavailable' WHEN 'refusal' THEN 'closed' WHEN 'callback' THEN 'deferred' WHEN 'identity_inquiry' THEN 'opening'
    WHEN 'greeting' THEN 'opening' WHEN 'acceptance' THEN 'open' WHEN 'unknown' THEN 'unknown' ELSE 'listen' END AS dialogue_state FROM a""")
def business_answers(spark, sf):
    d, k = turn_routes(spark, sf), (F.col("conv_id") * 5 + F.col("turn")) % 12
    said = F.coalesce(*[F.when(k == i, t) for i, t in enumerate(_SHORT)], F.concat("kimi_1", F.lit("明天三点100元")))
    f = d.select("id", semantics.business_fields(said).alias("f"))
    return f.select("id", "f.act", "f.intent", "f.polarity", "f.subject", F.array_join("f.slots", ",").alias("slots"), "f.commitment", "f.negation_scope", "f.dialogue_state")


@query("speech_language_answers", f"""WITH {_TURNS_SQL} SELECT id, CASE conv_id % 4 WHEN 0 THEN 'zh' WHEN 1 THEN 'zh' ELSE CASE WHEN regexp_matches(t, '[a-z]') THEN 'en' ELSE 'unknown' END END AS language FROM turns WHERE conv_id % 4 < 2 OR regexp_matches(t, '[a-z]')""")
def speech_language_answers(spark, sf):
    """Languages by shares over Chinese answers with a short Latin part, and over the turns' own texts."""
    d, c = turn_routes(spark, sf).where("conv_id % 4 < 2 or kimi_1 rlike '[a-z]'"), F.col("conv_id") % 4
    said = F.when(c == 0, "我们明天下午在公司见面").when(c == 1, "请打开这个网络的wifi现在连接一下好吗谢谢了").otherwise(F.col("kimi_1"))
    return d.select("id", text.detect_language(said).alias("language"))


# --- text forms, measures and gates over values in which each outcome occurs ----------

_FORM_SQL = _TURNS_SQL + """, k AS (SELECT id, t, (conv_id + turn) % 6 AS k FROM turns), s AS (SELECT id, CASE k WHEN 0 THEN '您現在需要嗎' WHEN 1 THEN '對啊' WHEN 2 THEN '啊' WHEN 3 THEN '<|zh|><|HAPPY|>电话' || t WHEN 4 THEN '請問時間呢' ELSE t END AS s, k FROM k)"""


@query("text_forms", f"""WITH {_FORM_SQL}, f AS (SELECT id, s, k, translate(s, '現麼嗎為這個後對說話請問時間電', '现么吗为这个后对说话请问时间电') AS sim FROM s), g AS (SELECT *, replace(sim, '您', '你') AS you FROM f)
  SELECT id, sim AS simplified, regexp_replace(you, '^(.+)[啊呀呢]$', '\\1', 's') AS tolerant, CASE k WHEN 0 THEN 6 WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 5 ELSE 0 END AS han, CASE WHEN k IN (0, 1, 4) THEN 'zh-Hant' WHEN k IN (2, 3) THEN 'zh-Hans' ELSE '' END AS script,
  CASE WHEN k = 3 THEN 'zh,HAPPY' ELSE '' END AS tags, trim(CASE WHEN k = 3 THEN substr(s, 16) ELSE s END) AS body FROM g""")
def text_forms(spark, sf):
    d, k = turn_routes(spark, sf), (F.col("conv_id") + F.col("turn")) % 6
    s = F.when(k == 0, "您現在需要嗎").when(k == 1, "對啊").when(k == 2, "啊").when(k == 3, F.concat(F.lit("<|zh|><|HAPPY|>电话"), "kimi_1")).when(k == 4, "請問時間呢").otherwise(F.col("kimi_1"))
    d = d.withColumn("s", s)
    c = F.col("s")
    tags = text.split_tags(c)
    return d.select("id", text.to_simplified(c).alias("simplified"), text.tolerance_key(text.to_simplified(c)).alias("tolerant"), text.han_chars(c).alias("han"), text.detect_script(c).alias("script"), F.array_join(tags["tags"], ",").alias("tags"), tags["text"].alias("body"))


@query("energy_states", f"""WITH {_DOCS_SQL}, v AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE n_chars END AS ms, -70 + doc_id % 40 AS rms, -60 + doc_id % 50 AS peak, (n_chars % 10) / 100.0 AS share FROM docs)
  SELECT doc_id, CASE WHEN ms IS NULL THEN 'failed' WHEN ms < 300 THEN 'audio_too_short' WHEN rms >= -47 AND peak >= -37 AND share >= 0.02 THEN 'audible' WHEN (rms < -53 AND peak < -43) OR share = 0 THEN 'inaudible' ELSE 'borderline' END AS energy FROM v""")
def energy_states(spark, sf):
    d, i = documents(spark, sf), F.col("doc_id")
    ms = F.when(i % 11 == 0, None).otherwise(F.col("n_chars"))
    return d.select("doc_id", classify.energy_state(ms, -70 + i % 40, -60 + i % 50, F.col("n_chars") % 10 / 100.0).alias("energy"))


@query("dnsmos_states", f"""WITH {_DOCS_SQL}, v AS (SELECT doc_id, 2.5 + doc_id % 15 / 10.0 AS bak, 2.5 + n_chars % 10 / 10.0 AS ovrl, CASE WHEN doc_id % 6 > 0 THEN 2.5 + n_chars % 13 / 10.0 END AS sig, CASE WHEN doc_id % 8 = 0 THEN 'failed' ELSE 'success' END AS st FROM docs)
  SELECT doc_id, CASE WHEN st = 'failed' THEN 'unavailable' WHEN bak < 3.0 OR ovrl < 2.8 THEN 'noisy' WHEN bak >= 3.5 AND ovrl >= 3.2 THEN 'clean' ELSE 'moderate' END AS noise, CASE WHEN st = 'failed' OR sig IS NULL THEN 'unavailable' WHEN sig >= 3.5 THEN 'strong' WHEN sig <= 2.8 THEN 'weak' ELSE 'unknown' END AS speech FROM v""")
def dnsmos_states(spark, sf):
    d, i, n = documents(spark, sf), F.col("doc_id"), F.col("n_chars")
    tenth = lambda c: F.lit(2.5).cast("decimal(10,1)") + (c / 10).cast("decimal(10,1)")
    x = classify.dnsmos_states(tenth(i % 15), tenth(n % 10), F.when(i % 6 > 0, tenth(n % 13)), F.when(i % 8 == 0, "failed").otherwise("success"))
    return d.select("doc_id", x["noise"].alias("noise"), x["speech"].alias("speech"))


@query("quality_states", f"""WITH {_DOCS_SQL}, v AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'noisy' WHEN 1 THEN 'clean' WHEN 2 THEN 'moderate' END AS band, CASE n_chars % 3 WHEN 0 THEN true WHEN 1 THEN false END AS risk, CASE doc_id % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'unsupported' WHEN 2 THEN NULL ELSE 'success' END AS st, n_chars % 7 <> 0 AS cal FROM docs)
  SELECT doc_id, CASE WHEN st IN ('failed', 'unsupported') THEN st WHEN st IS NULL THEN 'not_scored' WHEN NOT cal THEN 'uncalibrated' WHEN coalesce(band = 'noisy', false) OR coalesce(risk, false) THEN 'scored_noisy' ELSE 'scored_ok' END AS state FROM v""")
def quality_states(spark, sf):
    d, i, n = documents(spark, sf), F.col("doc_id"), F.col("n_chars")
    band, risk = F.when(i % 4 == 0, "noisy").when(i % 4 == 1, "clean").when(i % 4 == 2, "moderate"), F.when(n % 3 == 0, True).when(n % 3 == 1, False)
    status = F.when(i % 5 == 0, "failed").when(i % 5 == 1, "unsupported").when(i % 5 == 2, None).otherwise("success")
    return d.select("doc_id", classify.quality_state(band, risk, status, n % 7 != 0).alias("state"))


@query("formal_gold", f"""WITH {_DOCS_SQL}, v AS (SELECT doc_id, quality = 1 AS ver, CASE doc_id % 3 WHEN 0 THEN 'second_review' WHEN 1 THEN 'adjudicated' ELSE 'annotated' END AS st, CASE WHEN n_chars % 4 = 0 THEN '' WHEN n_chars % 4 < 3 THEN 'x' END AS gold, CASE WHEN toxic = 1 THEN 'non_speech' ELSE 'speech' END AS kind,
  'p1' AS a, CASE WHEN doc_id % 5 = 0 THEN 'p1' ELSE 'p2' END AS b, CASE WHEN n_chars % 2 = 0 THEN 'p3' END AS c FROM docs)
  SELECT doc_id, coalesce(ver, false) AND st <> 'annotated' AND gold IS NOT NULL AND (kind = 'speech') = (gold <> '') AND a <> b AND (st <> 'adjudicated' OR c IS NOT NULL) AS formal FROM v""")
def formal_gold(spark, sf):
    d, i, n = documents(spark, sf), F.col("doc_id"), F.col("n_chars")
    cols = {
        "verified": F.col("quality") == 1, "state": F.when(i % 3 == 0, "second_review").when(i % 3 == 1, "adjudicated").otherwise("annotated"), "gold_text": F.when(n % 4 == 0, "").when(n % 4 < 3, "x"), "kind": F.when(F.col("toxic") == 1, "non_speech").otherwise("speech"),
        "annotator": F.lit("p1"), "reviewer": F.when(i % 5 == 0, "p1").otherwise("p2"), "adjudicator": F.when(n % 2 == 0, "p3"),
    }
    return d.select("doc_id", F.coalesce(dataset.formal_gold(cols), F.lit(False)).alias("formal"))


@query("regression_gates", f"""WITH {_SCORED_SQL}, c AS (SELECT type AS bucket, sum(d) FILTER (model = 'glm') / greatest(sum(n) FILTER (model = 'glm'), 1) AS b, sum(d) FILTER (model = 'qwen') / greatest(sum(n) FILTER (model = 'qwen'), 1) AS q FROM s GROUP BY type),
  t AS (SELECT * FROM (VALUES ('user', 1.0), ('assistant', 0.0), ('nobody', 0.0)) v(bucket, threshold)) SELECT bucket, round(q - b, 9) AS delta, threshold::DOUBLE AS threshold, CASE WHEN b IS NULL THEN 'skipped' WHEN q - b <= threshold THEN 'pass' ELSE 'fail' END AS state FROM t LEFT JOIN c USING (bucket)""")
def regression_gates(spark, sf):
    rows = _scored(spark, sf)
    side = lambda m: metrics.corpus(rows.where(F.col("model") == m), "type").withColumnRenamed("type", "bucket")
    return metrics.regression_gate(side("glm"), side("qwen"), {"user": 1.0, "assistant": 0.0, "nobody": 0.0}).withColumn("delta", F.round("delta", 9))


@query("wilson_gate", f"""WITH {_DOCS_SQL}, g AS (SELECT lang AS layer, source, max((quality = 0)::INT) AS bad, max((toxic = 1)::INT) AS crit FROM docs WHERE quality IS NOT NULL GROUP BY 1, 2), a AS (SELECT coalesce(layer, 'all') AS layer, grouping(layer) AS whole, count(*) AS n, sum(bad)::BIGINT AS k, sum(crit)::BIGINT AS critical FROM g GROUP BY GROUPING SETS ((layer), ())),
  w AS (SELECT *, least((k / n + 3.8416 / (2 * n)) / (1 + 3.8416 / n) + 1.96 * sqrt((k / n) * (1 - k / n) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n), 1) AS upper FROM a)
  SELECT layer, n AS groups, k AS errors, round(upper, 9) AS upper, critical, n >= CASE WHEN whole = 1 THEN 5 ELSE 2 END AND upper <= CASE WHEN whole = 1 THEN 0.9 ELSE 0.95 END AND critical = 0 AS passed FROM w""")
def wilson_gate(spark, sf):
    d = documents(spark, sf).where("quality is not null").withColumns({"bad": F.col("quality") == 0, "crit": F.col("toxic") == 1})
    return metrics.wilson_gate(d, "lang", "bad", "source", "crit", 5, 0.9, 2, 0.95).withColumn("upper", F.round("upper", 9))


@query("faer_answers", f"""WITH {_FACTS_SQL}, v AS (SELECT source, CASE id % 3 WHEN 0 THEN '嗯' WHEN 1 THEN '好的我知道' ELSE '哦' END AS gold, id % 4 = 0 AS neutral, kind <> 'non_speech' AS spoken, status <> 'failed' AS ok, pol = 'positive' AS hit FROM f), e AS (SELECT source, hit, neutral AND spoken AND ok AND gold IN ('嗯', '哦') AS elig FROM v)
  SELECT source, count(*) FILTER (hit AND elig) AS numerator, count(*) FILTER (elig) AS denominator FROM e GROUP BY source""")
def faer_answers(spark, sf):
    d, i = _facts(spark, sf), F.col("id")
    d = d.withColumns({"gold_text": F.when(i % 3 == 0, "嗯").when(i % 3 == 1, "好的我知道").otherwise("哦"), "semantic": F.when(i % 4 == 0, "neutral").otherwise("negative")})
    return _rates(d, "source").where("metric = 'faer'").select("source", "numerator", "denominator")


@query("manifest_totals", "SELECT count(*) AS files, round(sum(CASE WHEN doc_id % 5 > 0 THEN n_chars / 10.0 END) / 3600, 2) AS hours, count(*) FILTER (doc_id % 5 = 0 AND doc_id % 2 = 0) AS broken FROM documents")
def manifest_totals(spark, sf):
    d, i = table(spark, sf, "documents"), F.col("doc_id")
    return relational.manifest_stats(d.select(F.when(i % 5 > 0, F.col("n_chars") / 10.0).alias("duration"), F.when(i % 2 == 0, "a/b.WAV").otherwise("a/b.txt").alias("source_path")))


_ENTRY = "struct<text:string,model:string,version:string,confidence:double,status:string,extra:map<string,string>>"


@query("run_statuses", f"""WITH {_TURNS_SQL}, k AS (SELECT id, t, (conv_id + turn) % 9 AS k FROM turns)
  SELECT id, CASE k WHEN 0 THEN 'missing' WHEN 1 THEN 'missing' WHEN 2 THEN 'success_empty' WHEN 3 THEN 'failed' WHEN 4 THEN 'missing' WHEN 5 THEN 'failed' WHEN 6 THEN 'success_empty' WHEN 7 THEN CASE WHEN trim(t) = '' THEN 'success_empty' ELSE 'success_text' END ELSE 'success_text' END AS status FROM k""")
def run_statuses(spark, sf):
    """Absent entry, null text, blank text, failed, pending, failed inside, blank raw text, text, raw text beside an empty one."""
    d, k = turn_routes(spark, sf), (F.col("conv_id") + F.col("turn")) % 9
    none = F.lit(None).cast("map<string,string>")
    cell = lambda t, s=None, x=none: F.struct(t.cast("string").alias("text"), F.lit("m").alias("model"), F.lit(None).cast("string").alias("version"), F.lit(None).cast("double").alias("confidence"), F.lit(s).cast("string").alias("status"), x.alias("extra")).cast(_ENTRY)
    inner = lambda n, v: F.create_map(F.lit(n), F.lit(v))
    t = F.col("kimi_1")
    entry = (
        F.when(k == 1, cell(F.lit(None))).when(k == 2, cell(F.lit("  "))).when(k == 3, cell(t, "Failed")).when(k == 4, cell(t, " pending")).when(k == 5, cell(t, None, inner("inference_status", "error")))
        .when(k == 6, cell(t, None, inner("raw_text", " "))).when(k == 7, cell(t)).when(k == 8, cell(F.lit(""), None, inner("raw_text", "said")))
    )
    return d.select("id", routes.run_status(entry).alias("status"))


@query("attach_two_routes", f"WITH {_TURNS_SQL} SELECT id, CASE WHEN turn % 4 = 1 THEN NULL ELSE glm_1 END AS glm, CASE WHEN turn % 4 = 1 THEN 'missing' END AS glm_state, qwen_2 AS qwen FROM routes")
def attach_two_routes(spark, sf):
    """The N-way join: routes attached one after another, ids that lack a row get an explicit missing entry."""
    d = turn_routes(spark, sf).withColumns({"sha256": F.sha2("kimi_1", 256), "errors": F.create_map().cast("map<string,string>")})
    none = F.create_map().cast(f"map<string,{_ENTRY}>")
    of = lambda m, c: F.create_map(F.lit(m), F.struct(F.col(c).alias("text"), F.lit(m).alias("model"), *[F.lit(None).cast(k).alias(n) for n, k in (("version", "string"), ("confidence", "double"), ("status", "string"), ("extra", "map<string,string>"))]).cast(_ENTRY))
    base = d.select("id", "sha256", none.alias("transcripts"))
    for m, c, rows in (("glm", "glm_1", d.where("turn % 4 <> 1")), ("qwen", "qwen_2", d)):
        base = relational.attach_route(base, rows.select("id", "sha256", "errors", of(m, c).alias("transcripts")), m, m, "left" if m == "glm" else "exact")
    get = lambda m, f: F.try_element_at("transcripts", F.lit(m))[f]
    return base.select("id", get("glm", "text").alias("glm"), get("glm", "status").alias("glm_state"), get("qwen", "text").alias("qwen"))


@query("small_forms", f"""WITH {_DOCS_SQL}, v AS (SELECT doc_id, 'dir/' || lang || '_' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.tar.wav' ELSE '' END AS path, CASE doc_id % 3 WHEN 0 THEN 'b, a,,b' WHEN 1 THEN 'y|x| ' ELSE ' one ' END AS tags, CASE WHEN doc_id % 4 = 0 THEN ' hot ' ELSE lang END AS word, quality FROM docs)
  SELECT doc_id, lang || '_' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.tar' ELSE '' END AS stem, CASE doc_id % 3 WHEN 0 THEN 'a,b' WHEN 1 THEN 'x,y' ELSE 'one' END AS tags, CASE WHEN doc_id % 4 = 0 THEN '' ELSE word END AS word, 3 * (doc_id % 5) >= 2 * (n_chars % 6) AS enough, 'n' || doc_id AS id FROM v JOIN (SELECT doc_id, lang, n_chars FROM documents) USING (doc_id)""")
def small_forms(spark, sf):
    d, i = documents(spark, sf), F.col("doc_id")
    path = F.concat(F.lit("dir/"), "lang", F.lit("_"), i.cast("string"), F.when(i % 2 == 0, ".tar.wav").otherwise(""))
    tags = F.when(i % 3 == 0, "b, a,,b").when(i % 3 == 1, "y|x| ").otherwise(" one ")
    word = F.when(i % 4 == 0, " hot ").otherwise(F.col("lang"))
    return d.select(
        "doc_id", text.audio_stem(path).alias("stem"), F.array_join(text.tag_list(tags), ",").alias("tags"), text.blank_exact(word, text.hotwords("cold/hot，x")).alias("word"),
        stats.ratio_rule(i % 5, F.col("n_chars") % 6).alias("enough"), text.export_id(F.concat(F.lit("0123456789abcdef_n"), i.cast("string"))).alias("id"),
    )

"""Text metrics, metric blocks, paired comparison, plan scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance import adapters as A
from parlance.plans import reports as R
from parlance.plans import scoring as P
from parlance.plans import textmetrics as T
from parlance.showcase import draw_of, md5_of, query, words_of

PRED = """p AS (SELECT 'doc:' || doc_id AS pair_id, text AS predict, coalesce(lag(text) OVER (PARTITION BY lang ORDER BY doc_id),
    last_value(text) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS label FROM documents
  UNION ALL SELECT 'turn:' || conv_id || ':' || turn, text, label FROM (
    SELECT *, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS label FROM conversations) WHERE role = 'assistant')"""


def _ngrams(text: str, n: int) -> str:
    return f"list_transform(range(1, greatest(length({text}) - {n - 2}, 1)), lambda i: substr({text}, i, {n}))"


def _side(column: str, mark: int) -> str:
    return " UNION ALL ".join(f"SELECT pair_id, {n} AS n, {mark} AS m, unnest({_ngrams(column, n)}) AS g FROM p" for n in range(1, 5))


BLEU_SQL = f"""WITH {PRED}, x AS ({_side('predict', 1)} UNION ALL {_side('label', 0)}), c AS (SELECT pair_id, n, g, sum(m) AS h, sum(1 - m) AS r FROM x GROUP BY ALL),
  k AS (SELECT pair_id, n, sum(least(h, r)) AS hit, greatest(sum(h), 1) AS total FROM c GROUP BY ALL),
  z AS (SELECT *, sum(CASE WHEN hit = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY pair_id ORDER BY n) AS zeros FROM k),
  b AS (SELECT pair_id, sum(0.25 * ln(CASE WHEN hit = 0 THEN 1 / (pow(2, zeros) * total) ELSE hit / total::DOUBLE END)) AS logs, max(CASE WHEN n = 1 THEN hit END) AS first FROM z GROUP BY 1)
  SELECT pair_id, round(CASE WHEN first = 0 THEN 0 ELSE CASE WHEN length(predict) > length(label) THEN 1 ELSE exp(1 - length(label) / length(predict)::DOUBLE) END * exp(logs) END * 100, 4) AS bleu_4
  FROM b JOIN p USING (pair_id)"""


@query(BLEU_SQL)
def text_bleu(spark, sf):
    return T.bleu4(A.predictions(spark, sf), "pair_id")


def _pairs_of(w: str) -> str:
    return f"CASE WHEN len({w}) >= 2 THEN list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1])) ELSE [] END"


ROUGE_SQL = f"""WITH {PRED}, w AS (SELECT pair_id, {words_of('predict')} AS a, {words_of('label')} AS b FROM p),
  g AS (SELECT pair_id, list_distinct(a) AS a1, list_distinct(b) AS b1, {_pairs_of('a')} AS a2, {_pairs_of('b')} AS b2 FROM w),
  s AS (SELECT pair_id, len(list_intersect(a1, b1)) AS h1, len(a1) AS p1, len(b1) AS r1, len(list_intersect(a2, b2)) AS h2, len(a2) AS p2, len(b2) AS r2 FROM g)
  SELECT pair_id, round(coalesce(2 * (h1 / nullif(p1, 0)) * (h1 / nullif(r1, 0)) / (h1 / nullif(p1, 0) + h1 / nullif(r1, 0) + 1e-8), 0) * 100, 4) AS rouge_1,
  round(coalesce(2 * (h2 / nullif(p2, 0)) * (h2 / nullif(r2, 0)) / (h2 / nullif(p2, 0) + h2 / nullif(r2, 0) + 1e-8), 0) * 100, 4) AS rouge_2 FROM s"""


@query(ROUGE_SQL)
def text_rouge(spark, sf):
    return T.rouge_scores(A.predictions(spark, sf), "pair_id", lcs=False)


@query(f"""SELECT round(avg(bleu_4), 3) AS bleu_4, round(avg(rouge_1), 3) AS rouge_1, round(avg(rouge_2), 3) AS rouge_2, count(*) AS rows
  FROM ({BLEU_SQL}) JOIN ({ROUGE_SQL}) USING (pair_id)""")
def text_means(spark, sf):
    """The scores' means over all pairs."""
    scores = T.rouge_scores(A.predictions(spark, sf), "pair_id", lcs=False, bleu=True)
    columns = ("bleu_4", "rouge_1", "rouge_2")
    return T.mean_scores(scores, columns).select(*[F.round(c, 3).alias(c) for c in columns], "rows")


@query()
def text_scores(spark, sf):
    """All scores, the common subsequence included."""
    return T.text_scores(A.predictions(spark, sf), "pair_id")


@query("""SELECT vec_id, round(count(*) FILTER (CASE WHEN e > 0 THEN 1 ELSE 0 END = y)::DOUBLE / count(*), 6) AS token_accuracy FROM (
  SELECT vec_id, unnest(embedding[1:63]) AS e, unnest(list_transform(embedding[2:64], lambda x: CASE WHEN x > 0.1 THEN 1 WHEN x < -0.1 THEN 0 ELSE -100 END)) AS y FROM embeddings) WHERE y <> -100 GROUP BY 1""")
def token_accuracy(spark, sf):
    """Signs of a vector as predictions for the next entry's sign; small entries carry no label."""
    rows = A.table(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: F.when(x > 0, 1).otherwise(0)).alias("predictions"),
        F.transform("embedding", lambda x: F.when(x > F.lit(0.1).cast("float"), 1).when(x < F.lit(-0.1).cast("float"), 0).otherwise(-100)).alias("labels"),
    )
    return T.token_accuracy(rows).select("vec_id", F.round("token_accuracy", 6).alias("token_accuracy"))


@query("""SELECT round(avg((embedding[1] > embedding[2])::INTEGER), 6) AS accuracy, count(*) AS pairs FROM embeddings""")
def preference_accuracy(spark, sf):
    e = A.table(spark, sf, "embeddings").select(F.get("embedding", F.lit(0)).alias("chosen_score"), F.get("embedding", F.lit(1)).alias("rejected_score"))
    return T.pair_accuracy(e).withColumn("accuracy", F.round("accuracy", 6))


@query("""WITH x AS (SELECT 'cat' || label AS category, list_position(embedding[1:4], list_max(embedding[1:4])) = label % 4 + 1 AS ok FROM embeddings)
  SELECT coalesce(category, 'Average') AS category, round(avg(ok::INTEGER) * 100, 6) AS accuracy, count(*) AS rows FROM x GROUP BY ROLLUP (category)""")
def choice_accuracy(spark, sf):
    return T.mcq_accuracy(A.choice_rows(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


RESULTS = """k AS (SELECT *, (props->>'$.k')::INTEGER AS k, event_type <> 'error' AS ok, 'v' || (user_id % 3) AS variant, 'c' || (event_id // 3) AS case_id FROM events),
  r AS (SELECT *, CASE WHEN ok THEN 'passed' WHEN k < 50 THEN 'invalid_json' ELSE 'task_count_mismatch' END AS reason, CASE WHEN k % 4 <> 0 THEN ok END AS pm,
   k % 10 = 0 AS exact, k % 3 = 0 AS seen, k % 7 = 0 AS novel, CASE WHEN k < 30 THEN 'easy' WHEN k < 70 THEN 'medium' ELSE 'hard' END AS difficulty,
   CASE WHEN user_id % 2 = 0 THEN 'zh' ELSE 'en' END AS language, 'L' || (user_id % 4 + 1) AS level, CASE WHEN event_type = 'view' THEN 'negative' ELSE 'positive' END AS polarity FROM k)"""


def _metrics_sql(by: str, source: str) -> str:
    return f"""o AS (SELECT {by}, value, row_number() OVER (PARTITION BY {by} ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY {by}) AS n FROM {source}),
  q AS (SELECT {by}, max(value) FILTER (i = greatest(0, least(n - 1, ceil(0.5 * (n + 1)) - 1))) AS latency_p50, max(value) FILTER (i = greatest(0, least(n - 1, ceil(0.95 * (n + 1)) - 1))) AS latency_p95 FROM o GROUP BY {by}),
  a AS (SELECT {by}, count(*) AS count, round(avg(ok::INT), 6) AS strict_sequence_accuracy, round(avg((k >= 5)::INT), 6) AS valid_json_rate, round(avg(pm::INT), 6) AS parameter_accuracy,
   count(pm) AS parameter_accuracy_denominator, round(avg((k = 42)::INT), 6) AS forbidden_tool_violation_rate, round(avg(value), 4) AS latency_mean, sum(k)::BIGINT AS prompt_total,
   round(sum(k * 2) / (sum(value) / 1000), 3) AS output_tokens_per_second, count(*) FILTER (NOT ok) AS failures FROM {source} GROUP BY {by})
  SELECT a.*, latency_p50, latency_p95 FROM a JOIN q USING ({by})"""


def _metric_columns(rows, *by):
    return rows.select(
        *by, "count", *[F.round(c, 6).alias(c) for c in ("strict_sequence_accuracy", "valid_json_rate", "parameter_accuracy")],
        "parameter_accuracy_denominator", F.round("forbidden_tool_violation_rate", 6).alias("forbidden_tool_violation_rate"),
        F.round("latency_mean", 4).alias("latency_mean"), "prompt_total", F.round("output_tokens_per_second", 3).alias("output_tokens_per_second"),
        F.aggregate(F.map_values("failure_reasons"), F.lit(0).cast("long"), lambda a, x: a + x).alias("failures"), "latency_p50", "latency_p95",
    )


@query(f"WITH {RESULTS}, {_metrics_sql('variant', 'r')}")
def metric_block(spark, sf):
    return _metric_columns(R.metrics(A.results(spark, sf), ["variant"]), "variant")


@query(f"""WITH {RESULTS}, f AS (SELECT *, unnest(list_filter([{{'facet': 'difficulty', 'fv': difficulty}}, {{'facet': 'language', 'fv': language}}, {{'facet': 'level', 'fv': level}}, {{'facet': 'polarity', 'fv': polarity}},
   {{'facet': 'expected_tools', 'fv': event_type}}, {{'facet': 'overlap', 'fv': 'all'}}, {{'facet': 'overlap', 'fv': CASE WHEN exact THEN 'exact_train' ELSE 'non_exact_train' END}},
   {{'facet': 'overlap', 'fv': CASE WHEN NOT exact AND seen THEN 'composition_seen_atoms' END}}, {{'facet': 'overlap', 'fv': CASE WHEN novel THEN 'has_novel_atom' END}}], lambda x: x.fv IS NOT NULL), recursive := true) FROM r),
  g AS (SELECT *, facet || '=' || fv AS slice FROM f), {_metrics_sql('slice', 'g')}""")
def metric_slices(spark, sf):
    rows = R.metrics_by_slice(A.results(spark, sf))
    return _metric_columns(rows.withColumn("slice", F.concat("facet", F.lit("="), "value")), "slice")


@query(f"""WITH {RESULTS}, s AS (SELECT variant, level, count(*) AS count, sum(least(3, k % 5)) AS m, sum(k % 5) AS p, sum(3) AS e, count(*) FILTER (k = 13) AS failed, max(value) AS latency_max FROM r GROUP BY ALL),
  o AS (SELECT variant, level, value, row_number() OVER (PARTITION BY variant, level ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY variant, level) AS n FROM r),
  q AS (SELECT variant, level, max(value) FILTER (i = greatest(0, ceil(0.5 * n) - 1)) AS latency_p50, max(value) FILTER (i = greatest(0, ceil(0.99 * n) - 1)) AS latency_p99 FROM o GROUP BY ALL)
  SELECT variant, level, count, round(m / p::DOUBLE, 6) AS step_precision, round(m / e::DOUBLE, 6) AS step_recall, round(2 * (m / p::DOUBLE) * (m / e::DOUBLE) / (m / p::DOUBLE + m / e::DOUBLE), 6) AS step_f1,
  failed, latency_max, latency_p50, latency_p99 FROM s JOIN q USING (variant, level)""")
def model_summary(spark, sf):
    rows = R.summarize_model(A.results(spark, sf), ["variant", "level"], 60000.0)
    return rows.select(
        "variant", "level", "count", *[F.round(c, 6).alias(c) for c in ("step_precision", "step_recall", "step_f1")],
        "failed", "latency_max", "latency_p50", "latency_p99",
    )


PAIRED = f"""{RESULTS}, d AS (SELECT case_id, max(ok::INT) FILTER (variant = 'v0') AS l, max(ok::INT) FILTER (variant = 'v1') AS r FROM r GROUP BY 1)"""


@query(f"""WITH {PAIRED} SELECT count(*) AS paired_count, count(*) FILTER (l = 1 AND r = 1) AS both_pass, count(*) FILTER (l = 1 AND r = 0) AS left_only_pass,
  count(*) FILTER (l = 0 AND r = 1) AS right_only_pass, count(*) FILTER (l = 0 AND r = 0) AS both_fail, round(avg(l), 6) AS left_accuracy, round(avg(r), 6) AS right_accuracy,
  round((sum(l) - sum(r)) / count(*), 6) AS accuracy_delta FROM d WHERE l IS NOT NULL AND r IS NOT NULL""")
def paired_comparison(spark, sf):
    rows = R.paired(A.results(spark, sf), "v0", "v1")
    return rows.select(
        "paired_count", "both_pass", "left_only_pass", "right_only_pass", "both_fail",
        *[F.round(c, 6).alias(c) for c in ("left_accuracy", "right_accuracy", "accuracy_delta")],
    )


@query()
def bootstrap_interval(spark, sf):
    return R.bootstrap_ci(R.paired(A.results(spark, sf), "v0", "v1"), 2000, 7)


@query(f"""WITH {PAIRED}, c AS (SELECT count(*) FILTER (l = 1 AND r = 0) AS a, count(*) FILTER (l = 0 AND r = 1) AS b FROM d WHERE l IS NOT NULL AND r IS NOT NULL),
  t AS (SELECT a, b, sum(exp(lgamma(a + b + 1) - lgamma(i + 1) - lgamma(a + b - i + 1) - (a + b) * ln(2))) AS s FROM c, LATERAL (SELECT unnest(range(0, least(a, b) + 1)) AS i) GROUP BY ALL)
  SELECT a AS left_only_pass, b AS right_only_pass, round(least(1.0, 2 * s), 6) AS p_value FROM t""")
def mcnemar_test(spark, sf):
    rows = R.mcnemar(A.results(spark, sf), "v0", "v1")
    return rows.select("left_only_pass", "right_only_pass", F.round("p_value", 6).alias("p_value"))


@query(f"""WITH {RESULTS}, b AS (SELECT ok, unnest(list_filter([CASE WHEN k >= 80 THEN 'nn>=0.8' WHEN k >= 50 THEN '0.5<=nn<0.8' ELSE 'nn<0.5' END, CASE WHEN seen THEN 'signature seen' ELSE 'signature unseen' END,
   CASE WHEN novel THEN 'values unseen' END], lambda x: x IS NOT NULL)) AS bucket FROM r) SELECT bucket, count(*) FILTER (ok) AS passed, count(*) AS rows, round(avg(ok::INT), 6) AS accuracy FROM b GROUP BY 1""")
def accuracy_buckets(spark, sf):
    rows = A.results(spark, sf).select(
        "strict_pass", (F.col("prompt_tokens") / 100.0).alias("min_nn"), F.col("all_atoms_seen_train").cast("int").alias("signature_seen"),
        F.col("has_novel_atom").alias("has_unseen"),
    )
    return R.accuracy_by_bucket(rows).withColumn("accuracy", F.round("accuracy", 6))


@query("""SELECT event_id::VARCHAR AS record_id, CASE WHEN (props->>'$.k')::INTEGER < 50 THEN 'invalid_json' ELSE 'task_count_mismatch' END AS reason FROM events WHERE event_type = 'error'""")
def failure_extract(spark, sf):
    return R.failures(A.results(spark, sf)).select("record_id", "reason")


@query("""WITH x AS (SELECT event_id, event_id - (CASE WHEN event_id % 1000 = 7 THEN 1 ELSE 0 END) AS rid, 'v' || (user_id % 3) AS variant, 'c' || (event_id // 3) AS c, value FROM events)
  SELECT rid::VARCHAR AS subject, 'request_id must match record_id' AS problem FROM x WHERE rid <> event_id UNION ALL
  SELECT rid::VARCHAR, 'duplicate record_id' FROM x GROUP BY rid HAVING count(*) > 1 UNION ALL
  SELECT 'f0|' || variant || '|' || c, 'duplicate case key' FROM x GROUP BY variant, c HAVING count(*) > 1""")
def result_integrity(spark, sf):
    """Every thousandth record carries the id of the one before."""
    rows = A.results(spark, sf).withColumn("record_id", F.when(
        F.col("record_id").cast("long") % 1000 == 7, (F.col("record_id").cast("long") - 1).cast("string")
    ).otherwise(F.col("record_id")))
    return R.validate_results(rows)


# ---- plans --------------------------------------------------------------------------------------------

PLAN = f"""e AS (SELECT event_id // 4 AS case_id, event_id, (props->>'$.k')::INTEGER AS k, event_type AS t FROM events),
  m AS (SELECT case_id, {draw_of("'plan'", 'case_id')} % 9 AS mutation, count(*) AS n, bool_or(t <> 'error') AS calls, bool_or(t IN ('click', 'view')) AS queries,
   bool_or(t = 'purchase') AS moves, bool_or(t = 'signup') AS bows, list(t ORDER BY event_id) AS ts,
   list(CASE t WHEN 'purchase' THEN 'm' || (k % 2) || (k % 5) WHEN 'signup' THEN 'g' || (k % 2) WHEN 'click' THEN 'c' || k ELSE '' END ORDER BY event_id) AS args FROM e GROUP BY 1),
  c AS (SELECT *, list_transform(ts, lambda x: CASE x WHEN 'error' THEN 'r' WHEN 'click' THEN 'q' WHEN 'view' THEN 'q' ELSE 'a' END) AS kinds, list_transform(args, lambda x: CASE WHEN x[1] = 'm' THEN x[1:2] || x[3:] ELSE x END) AS plain FROM m)"""


@query(f"""WITH {PLAN} SELECT case_id, CASE WHEN case_id % 50 = 7 THEN 'backend_error' ELSE CASE mutation WHEN 0 THEN 'passed' WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'task_count_mismatch'
   WHEN 3 THEN CASE WHEN calls THEN 'contract_violation' ELSE 'passed' END WHEN 4 THEN CASE WHEN queries THEN 'contract_violation' ELSE 'passed' END
   WHEN 5 THEN CASE WHEN moves THEN 'task_parameter_mismatch' ELSE 'passed' END WHEN 6 THEN CASE WHEN case_id % 2 = 0 AND NOT bows THEN 'forbidden_tool' ELSE 'task_count_mismatch' END
   WHEN 7 THEN CASE WHEN kinds <> list_reverse(kinds) THEN 'task_kind_mismatch' WHEN ts <> list_reverse(ts) THEN 'task_name_mismatch'
     WHEN args <> list_reverse(args) THEN 'task_parameter_mismatch' ELSE 'passed' END
   ELSE 'invalid_task_schema' END END AS reason FROM c""")
def strict_plan_score(spark, sf):
    """Each case's output is its plan with one kind of damage."""
    return P.score_strict(A.plan_cases(spark, sf), A.contract(spark)).select("case_id", "reason")


@query()
def compatible_plan_score(spark, sf):
    rows = P.score_compatible(A.plan_cases(spark, sf), A.contract(spark))
    return rows.select("case_id", "compatible_reason", "compatible_parameter_match", "predicted_tool_count")


@query(f"""WITH {PLAN} SELECT case_id, mutation NOT IN (1) AS valid_json, CASE mutation WHEN 1 THEN false WHEN 3 THEN NOT calls WHEN 4 THEN NOT queries WHEN 8 THEN false ELSE true END AS contract_valid,
  CASE mutation WHEN 1 THEN 'missing JSON array' WHEN 8 THEN 'task[0]: unexpected keys ["extra"]' END AS shape_error FROM c""")
def parsed_plans(spark, sf):
    rows = P.parse_plans(A.plan_cases(spark, sf), A.contract(spark))
    return rows.select(
        "case_id", "valid_json", "contract_valid", F.when(~F.col("contract_error"), F.col("parse_error")).alias("shape_error")
    )


@query(f"""WITH {PLAN} SELECT case_id, CASE WHEN mutation = 7 THEN len(list_filter(list_zip(list_filter(list_zip(ts, args), lambda x: x[1] <> 'error'), list_reverse(list_filter(list_zip(ts, args), lambda x: x[1] <> 'error'))),
   lambda z: z[1][1] = 'purchase' AND (z[2][1] <> 'purchase' OR z[1][2][3:] <> z[2][2][3:]))) ELSE 0 END AS step_errors FROM c WHERE mutation NOT IN (1, 3, 4, 8)""")
def exact_step_checks(spark, sf):
    """Step values of valid plans against the expected ones by position."""
    rows = P.parse_plans(A.plan_cases(spark, sf), A.contract(spark)).where(~F.col("mutation").isin(1, 3, 4, 8))
    return P.strict_extra(rows).select("case_id", F.size(F.filter("extra_errors", lambda x: x == "step")).cast("long").alias("step_errors"))


@query("""SELECT event_id // 4 AS case_id, sum(CASE WHEN event_type = 'signup' THEN (props->>'$.k')::INTEGER % 3 + 1 ELSE 1 END)::BIGINT AS tasks FROM events GROUP BY 1""")
def adjusted_plans(spark, sf):
    """Gestures repeated one to three times become as many tasks."""
    rows = A.table(spark, sf, "events").withColumn("task", A.task_columns())
    repeated = F.col("task").withField("arguments", F.when(
        F.col("event_type") == "signup", F.concat(F.lit('{"gesture":"bow","latitude":1,"repeat":'), F.get_json_object("props", "$.k").cast("int") % 3 + 1, F.lit("}"))
    ).otherwise(F.col("task.arguments")))
    plans = rows.groupBy(F.floor(F.col("event_id") / 4).alias("case_id")).agg(F.collect_list(repeated).alias("tasks"))
    return P.adjust_plan(plans).select("case_id", F.size("tasks").cast("long").alias("tasks"))


@query("""WITH e AS (SELECT event_id // 4 AS case_id, event_id, event_type AS t, (props->>'$.k')::INTEGER AS k FROM events)
  SELECT 'c' || case_id AS case_id, string_agg(CASE t WHEN 'error' THEN 'reply' WHEN 'click' THEN 'query' WHEN 'view' THEN 'query' ELSE 'action' END, ',' ORDER BY event_id) AS kinds,
  string_agg(CASE t WHEN 'error' THEN '-' WHEN 'purchase' THEN '{"action":"walk","parameters":{"step":' || k || '}}' WHEN 'signup' THEN '{"repeat":' || k || ',"gesture":"bow"}' ELSE '{"query":' || k || '}' END, ' ' ORDER BY event_id) AS arguments,
  CASE WHEN bool_or(t = 'error') THEN 'negative' ELSE 'positive' END AS polarity, count(DISTINCT t) AS atoms FROM e GROUP BY case_id""")
def projected_cases(spark, sf):
    """Events as intents of source cases."""
    t, k = F.col("event_type"), F.get_json_object("props", "$.k")
    tool = F.when(t == "purchase", "HumanAction").when(t == "signup", "RobotGesture").when(t == "click", "robot_status").when(t == "view", "web_search")
    params = F.when(t == "purchase", F.concat(F.lit('{"step":'), k, F.lit("}"))).when(t == "signup", F.concat(F.lit('{"repeat":'), k, F.lit("}"))).otherwise(
        F.concat(F.lit('{"query":'), k, F.lit("}"))
    )
    intent = F.struct(
        tool.alias("tool"), F.when(t == "purchase", "walk").when(t == "signup", "bow").alias("action"), params.alias("params"),
        t.alias("source_atom_id"), F.array().cast("array<string>").alias("source_atom_ids"), (t == "error").alias("negative"),
    )
    e = A.table(spark, sf, "events").select(F.floor(F.col("event_id") / 4).alias("c"), F.struct("event_id", intent.alias("i")).alias("x"))
    cases = e.groupBy("c").agg(F.array_sort(F.collect_list("x")).alias("x")).select(
        F.concat(F.lit("c"), "c").alias("case_id"), F.lit("do it").alias("query"), F.transform("x", lambda x: x["i"]).alias("intents"),
        F.lit(False).alias("negative"), F.array().cast("array<string>").alias("forbidden_functions"),
        F.array().cast("array<string>").alias("source_atom_ids"), F.lit(None).cast("string").alias("difficulty"),
    )
    rows = P.project_cases(cases)
    return rows.select(
        "case_id", F.array_join(F.transform("expected", lambda t: t["kind"]), ",").alias("kinds"),
        F.array_join(F.transform("expected", lambda t: F.coalesce(t["arguments"], F.lit("-"))), " ").alias("arguments"),
        "polarity", F.size("source_atom_ids").cast("long").alias("atoms"),
    )


@query()
def rescored_results(spark, sf):
    cases = A.plan_cases(spark, sf)
    stored = cases.select("case_id", "output", "error", F.lit("old").alias("reason"), F.lit("m1").alias("model"))
    rows = P.rescore(stored, cases, A.contract(spark))
    return rows.groupBy("model", "reason", "compatible_reason").agg(F.count(F.lit(1)).alias("rows"))


@query(f"""WITH c AS (SELECT DISTINCT event_id // 4 AS case_id FROM events), s AS (SELECT contract, variant, case_id, {md5_of("'0'", 'contract', 'variant', 'case_id')} AS record_id
   FROM c, (SELECT unnest(['k1', 'k2']) AS contract), (SELECT unnest(['base', 'tuned']) AS variant))
  SELECT record_id, contract, variant, case_id FROM s WHERE NOT (case_id % 3 = 0 AND contract = 'k1')""")
def pending_schedule(spark, sf):
    cases = A.table(spark, sf, "events").select(F.floor(F.col("event_id") / 4).alias("case_id")).distinct()
    everything = P.pending(cases, ["k1", "k2"], ["base", "tuned"])
    done = everything.where("case_id % 3 = 0 AND contract = 'k1'")
    return P.pending(cases, ["k1", "k2"], ["base", "tuned"], done).select("record_id", "contract", "variant", "case_id")


class EchoBackend:
    """Stand-in backend: answers in upper case."""

    def generate(self, prompts):
        return [p.upper() for p in prompts]


@query("SELECT conv_id, turn, upper(text) AS output, NULL::VARCHAR AS error FROM conversations WHERE role = 'user' AND regexp_matches(text, '^[\\x00-\\x7F]*$')")
def generated_outputs(spark, sf):
    rows = A.table(spark, sf, "conversations").where(F.col("role") == "user").where(F.col("text").rlike(r"^[\x00-\x7F]*$"))
    return P.generate(rows, EchoBackend(), "text").select("conv_id", "turn", "output", "error")

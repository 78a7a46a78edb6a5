"""Screening, derived labels, composition, augmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance import adapters as A
from parlance.operators import screening as Q
from parlance.operators.checks import assert_roles
from parlance.plans import compose as C
from parlance.plans import labels as L
from parlance.showcase import DIALOGUES, draw_of, md5_of, query
from parlance.showcase.similarity import norm_sql
from parlance.sources import sinks

def wording(spark, sf):
    """(event_id, query, expected_function): a fixed wording per event type with the event's number in it."""
    k = F.get_json_object("props", "$.k")
    t = F.col("event_type")
    text = F.when(t == "purchase", F.concat(F.lit("往前走"), k, F.lit("步"))).when(t == "signup", "鞠个躬").when(t == "click", "电量还有多少").when(
        t == "view", "今天北京的天气"
    ).otherwise("左转一下")
    tool = F.when(t.isin("purchase", "error"), "HumanAction").when(t == "signup", "RobotGesture").when(t == "click", "robot_status").otherwise("get_weather")
    return A.table(spark, sf, "events").select("event_id", text.alias("query"), tool.alias("expected_function"), k.cast("int").alias("k"))


DERIVED = """CASE event_type WHEN 'purchase' THEN '{"action":"walk","parameters":{"x":0.6,"y":0,"yaw":0,"step":' || (props->>'$.k') || '}}' WHEN 'signup' THEN '{"gesture":"bow"}'
  WHEN 'click' THEN '{"query":"电量"}' WHEN 'view' THEN '{"city":"北京","query_type":"now"}' ELSE '{"action":"walk","parameters":{"x":0,"y":0,"yaw":1,"degree":15,"step":1}}' END"""


@query(f"SELECT event_id, {DERIVED} AS derived FROM events")
def derived_labels(spark, sf):
    return L.derive_labels(wording(spark, sf), cities=["北京", "上海"]).select("event_id", "derived")


@query("""SELECT event_id, CASE event_type WHEN 'purchase' THEN CASE WHEN (props->>'$.k')::INT = 0 THEN '{"action":"walk","parameters":{"x":0}}' ELSE '{"action":"walk","parameters":{"x":0.6}}' END
  ELSE '{"action":"walk","parameters":{"degree":15,"yaw":1}}' END AS params FROM events WHERE event_type IN ('purchase', 'error')""")
def canonical_motion(spark, sf):
    rows = wording(spark, sf).where(F.col("expected_function") == "HumanAction").withColumn("expected_params", F.when(
        F.col("query").startswith("往前"), F.concat(F.lit('{"action":"walk","parameters":{"x":'), F.col("k"), F.lit("}}"))
    ).otherwise('{"action":"walk","parameters":{"yaw":1,"degree":40}}'))
    return L.canonical_params(rows, texts="query").select("event_id", F.col("expected_params").alias("params"))


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS steps, CASE WHEN event_type = 'view' THEN '{"query":"please ' || event_id || '"}' WHEN event_type <> 'error' THEN props END AS params,
  NULL::VARCHAR AS atom_error FROM events""")
def normalized_atoms(spark, sf):
    t = F.col("event_type")
    rows = A.table(spark, sf, "events").select(
        "event_id", F.concat(F.lit(" please "), "event_id").alias("query"), F.lit(None).cast("string").alias("test_input"),
        F.when(t == "error", "reply").otherwise("query").alias("kind"), F.when(t == "view", "rag_query").otherwise(t).alias("expected_function"),
        F.when(t != "view", F.col("props")).alias("expected_params"),
        F.lit(None).cast("array<struct<expected_function:string,expected_params:string>>").alias("steps"),
    )
    rows = L.normalize_atoms(rows)
    return rows.select("event_id", F.size("steps").alias("steps"), F.col("expected_params").alias("params"), "atom_error")


@query("""SELECT event_id, CASE WHEN event_type = 'signup' THEN 'gesture:bow' WHEN event_type = 'error' THEN 'error_' || event_id % 7 ELSE event_type END AS topic FROM events""")
def atom_topics(spark, sf):
    cells = spark.createDataFrame([("signup", "bow", None), ("click", None, None)], "cell_id string, gesture string, dance string")
    t = F.col("event_type")
    rows = A.table(spark, sf, "events").select(
        "event_id", F.when(t == "error", F.concat(F.lit("neg_x_error_"), F.col("event_id") % 7)).otherwise(t).alias("atom_name"),
        (t == "error").alias("negative_sample"),
    )
    return L.source_cell(rows, cells).select("event_id", "topic")


@query(f"""WITH x AS (SELECT doc_id, {norm_sql('text')} AS n, text = '' AS e, contains(text, '"') AS q, contains(text, '|') AS t FROM documents),
  f AS (SELECT n, min(doc_id) AS first FROM x WHERE NOT (e OR q OR t) GROUP BY n)
  SELECT doc_id, concat_ws(',', CASE WHEN e THEN 'empty field' END, CASE WHEN q THEN 'quotes' END, CASE WHEN t THEN 'table' END, CASE WHEN doc_id > first THEN 'duplicate' END) AS issues FROM x LEFT JOIN f USING (n)""")
def screened_pool(spark, sf):
    rows = Q.screen_pool(A.table(spark, sf, "documents"), "text", "doc_id", patterns=(("quotes", '"'), ("table", r"\|")))
    return rows.select("doc_id", F.array_join("issues", ",").alias("issues"))


@query("""SELECT event_id, CASE event_type WHEN 'purchase' THEN 'no marker' WHEN 'view' THEN 'no ability marker' ELSE '' END AS issues FROM events WHERE event_type IN ('purchase', 'view', 'click')""")
def screened_rewrites(spark, sf):
    """Three variants: one wants a marker, one an ability question, one nothing."""
    rules = spark.createDataFrame([
        ("purchase", "之前|以前", False, None, None), ("view", None, True, None, None), ("click", None, False, None, "电量"),
    ], "variant string, marker string, ability boolean, keeps boolean, name_pattern string")
    rows = wording(spark, sf).join(A.table(spark, sf, "events").select("event_id", F.col("event_type").alias("variant")), "event_id")
    rows = rows.where(F.col("variant").isin("purchase", "view", "click")).withColumn("source_query", F.concat(F.lit("请"), "query"))
    rows = rows.withColumn("derived", F.lit(None).cast("string")).withColumn("label", F.lit(None).cast("string"))
    return Q.screen_rewrites(rows, rules).select("event_id", F.array_join("issues", ",").alias("issues"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'name lost' WHEN 'view' THEN 'city' WHEN 'error' THEN 'source script left' END AS reason FROM events""")
def screened_translations(spark, sf):
    names = spark.createDataFrame([("电量", "battery"), ("机械舞", "popping")], "name string, translated string")
    rows = wording(spark, sf).withColumn("source_query", F.col("query"))
    rows = rows.withColumn("instruction", F.lit("say it")).withColumn("span", F.lit(None).cast("string"))
    rows = rows.withColumn("city", F.when(F.col("query").contains("北京"), "Beijing"))
    rows = rows.withColumn("query", F.when(F.col("query").startswith("左转"), "turn 左").otherwise("go now"))
    return Q.screen_translation(rows, names).select("event_id", "reason")


# the walk of check_quotes: each quote is looked for from behind the start of the one before it
QUOTES = """x AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS m FROM conversations GROUP BY conv_id),
  d AS (SELECT conv_id, lower(coalesce(array_to_string(list_transform(m, lambda t: t.content), ' '), '')) AS whole FROM x),
  i AS (SELECT conv_id, len(m) AS n, unnest(m) AS t, generate_subscripts(m, 1) AS p FROM x),
  q AS (SELECT conv_id, CASE WHEN conv_id % 2 = 1 THEN n + 1 - p ELSE p END AS k, substr(t.content, 1, 12) AS label, lower(trim(coalesce(substr(t.content, 1, 12), ''), ' ')) AS quote FROM i),
  w AS (SELECT conv_id, 1::BIGINT AS k, 0::BIGINT AS place, NULL::VARCHAR AS reason FROM d UNION ALL
    SELECT conv_id, k + 1, place + f, CASE WHEN quote = '' OR NOT contains(whole, quote) THEN 'quote not found' WHEN f = 0 THEN 'order' END
    FROM (SELECT w.conv_id, w.k, place, quote, whole, strpos(substr(whole, place + 1), quote) AS f FROM w JOIN q ON q.conv_id = w.conv_id AND q.k = w.k JOIN d ON d.conv_id = w.conv_id WHERE reason IS NULL)),
  r AS (SELECT conv_id, max(reason) AS reason FROM w GROUP BY 1)"""


def _merged(spark, sf):
    """Turns joined into one text; each turn's first twelve characters are its quote, odd dialogues in reverse order."""
    rows = A.dialogues(spark, sf)
    items = F.transform("messages", lambda m: F.struct(F.lit(True).alias("kept"), F.substring(m["content"], 1, 12).alias("quote")))
    rows = rows.withColumn("query", F.array_join(F.transform("messages", lambda m: m["content"]), " ")).withColumn(
        "items", F.when(F.col("conv_id") % 2 == 1, F.reverse(items)).otherwise(items)
    ).withColumn("labels", F.transform("items", lambda x: x["quote"])).withColumn("extra", F.array().cast("array<string>"))
    return Q.check_quotes(rows)


@query(f"WITH RECURSIVE {QUOTES} SELECT conv_id, reason FROM r")
def quote_order(spark, sf):
    return _merged(spark, sf).select("conv_id", "reason")


@query(f"""WITH RECURSIVE {QUOTES}, s AS (SELECT q.conv_id, label, CASE WHEN reason = 'order' THEN strpos(whole, quote) ELSE 0 END AS spot, k FROM q JOIN d USING (conv_id) JOIN r USING (conv_id))
  SELECT conv_id, coalesce(string_agg(label, '|' ORDER BY spot, k), '') AS labels FROM s GROUP BY 1""")
def reordered_labels(spark, sf):
    return Q.reorder_by_quote(_merged(spark, sf)).select("conv_id", F.array_join("labels", "|").alias("labels"))


def judged(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    params = F.concat(F.lit('{"action":"walk","parameters":{"x":'), k - 50, F.lit(',"step":'), k % 3 + 1, F.lit("}}"))
    verdict = F.concat(F.lit('{"action":"walk","x":'), F.when(k < 40, -1).otherwise(1), F.lit(',"step":'), k % 3 + 1, F.lit("}"))
    t = F.col("event_type")
    tool = F.when(t == "error", "reply").when(t == "view", "web_search").otherwise("HumanAction")
    return A.table(spark, sf, "events").select(
        "event_id", t.alias("t"), F.struct(tool.alias("tool"), params.alias("params")).alias("label"),
        F.struct(F.when(k % 10 == 0, "web_search").otherwise(tool).alias("tool"), verdict.alias("params")).alias("verdict"),
    )


AGREE = """CASE WHEN event_type = 'view' THEN true WHEN (props->>'$.k')::INT % 10 = 0 THEN false WHEN event_type = 'error' THEN true ELSE
  sign((props->>'$.k')::INT - 50) = CASE WHEN (props->>'$.k')::INT < 40 THEN -1 ELSE 1 END END"""


@query(f"SELECT event_id, {AGREE} AS agree FROM events")
def label_verdicts(spark, sf):
    return Q.label_agreement(judged(spark, sf)).select("event_id", "agree")


@query(f"SELECT event_id, NOT ({AGREE}) AS disputed FROM events")
def reviewer_consensus(spark, sf):
    """Replies are doubled on the label side only; merging makes both sides equal again."""
    rows = judged(spark, sf).withColumn("labels", F.when(
        F.col("t") == "error", F.array("label", "label")
    ).otherwise(F.array("label"))).withColumn("verdicts", F.array(F.array("verdict"), F.array("verdict")))
    return Q.consensus(rows).select("event_id", "disputed")


@query()
def composed_cases(spark, sf):
    """As many three-slot cases as a tenth of the atoms."""
    atoms = A.atoms(spark, sf)
    return C.compose_cases(atoms, 3, max(atoms.count() // 10, 1), 1, 0.3).select("case_no", "level", F.array_join("ids", ",").alias("ids"), "missing")


@query()
def relation_pairs(spark, sf):
    atoms = A.atoms(spark, sf).where("part = 'positive'")
    return C.sample_pairs(atoms, atoms.count() // 10, 2)


@query()
def challenge_specs(spark, sf):
    atoms = A.atoms(spark, sf)
    n = max(atoms.count() // 200, 1)
    plan = {"zh": {"pos": n, "neg": n, "multi": n, "max_level": 2, "rel": n}, "en": {"pos": n, "neg": n}}
    rows = C.challenge_grid(atoms, plan, 3)
    return rows.select("category", "language", "k", F.array_join("ids", ",").alias("ids"), F.array_join("tags", ",").alias("tags"), "missing")


@query(f"""WITH x AS (SELECT event_id, event_type || ' ' || (props->>'$.k') AS q, CASE (event_id % 3) WHEN 0 THEN 'before' WHEN 1 THEN 'count' ELSE 'only' END AS op, event_id % 4 + 1 AS n FROM events),
  f AS (SELECT *, row_number() OVER (PARTITION BY {norm_sql('q')} ORDER BY event_id) AS r FROM x)
  SELECT event_id AS order_no, CASE op WHEN 'before' THEN 'a' || event_id || ',b' WHEN 'only' THEN 'a' || event_id ELSE array_to_string(list_transform(range(0, n), lambda i: 'a' || event_id), ',') END AS labels,
  CASE WHEN CASE op WHEN 'before' THEN 'AB' WHEN 'only' THEN 'A' ELSE repeat('A', n::INT) END <> 'A' THEN 'judge A' END AS reason FROM f WHERE r = 1""")
def relation_verdicts(spark, sf):
    ops = spark.createDataFrame([("only", ["A"]), ("before", ["A", "B"]), ("count", ["A*"])], "op string, letters array<string>")
    e = A.table(spark, sf, "events").select(
        F.col("event_id").alias("order_no"), F.concat("event_type", F.lit(" "), F.get_json_object("props", "$.k")).alias("query"),
        F.get(F.array(F.lit("before"), F.lit("count"), F.lit("only")), (F.col("event_id") % 3).cast("int")).alias("op"),
        (F.col("event_id") % 4 + 1).alias("n"), F.concat(F.lit("a"), "event_id").alias("a"), F.lit("b").alias("b"), F.array(F.lit(" a")).alias("verdict"),
    )
    return C.relation_labels(e, ops, "verdict").select("order_no", F.array_join("labels", ",").alias("labels"), "reason")


def event_plans(spark, sf):
    cases = A.table(spark, sf, "events").groupBy(F.floor(F.col("event_id") / 4).alias("case_no")).agg(
        F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")).alias("ids")
    )
    return C.compile_plans(cases, A.atoms(spark, sf), A.contract(spark))


SLOTS = """e AS (SELECT event_id // 4 AS case_no, event_id, event_type AS t, (props->>'$.k')::INTEGER AS k FROM events),
  s AS (SELECT *, CASE t WHEN 'purchase' THEN '{"action":"walk","parameters":{"x":' || CASE WHEN k % 2 = 0 THEN '0.6' ELSE '-0.6' END || ',"step":' || (k % 5 + 1) || '}}'
   WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN '{"gesture":"bow","repeat":1}' ELSE '{"gesture":"nod"}' END WHEN 'click' THEN '{"query":"status ' || k || '"}' WHEN 'view' THEN '{"query":"topic ' || k || '"}' END AS args,
   CASE t WHEN 'purchase' THEN 'HumanAction' WHEN 'signup' THEN 'RobotGesture' WHEN 'click' THEN 'robot_status' WHEN 'view' THEN 'web_search' END AS name,
   CASE t WHEN 'error' THEN 'reply' WHEN 'click' THEN 'query' WHEN 'view' THEN 'query' ELSE 'action' END AS kind FROM e)"""


@query(f"""WITH {SLOTS}, g AS (SELECT case_no, string_agg('"' || event_id || '"', ',' ORDER BY event_id) AS ids, count(*) AS tasks,
   string_agg('{{' || CASE WHEN name IS NULL THEN '' ELSE '"arguments":' || args || ',' END || '"kind":"' || kind || '"' || CASE WHEN name IS NULL THEN '' ELSE ',"name":"' || name || '"' END || '}}', ',' ORDER BY event_id) AS slots FROM s GROUP BY 1)
  SELECT case_no, tasks, 'sha256:' || sha256('{{"atom_ids":[' || ids || '],"schema":"semantic-program/v1","slots":[' || slots || ']}}') AS semantic_id, NULL::VARCHAR AS compile_error FROM g""")
def compiled_plans(spark, sf):
    return event_plans(spark, sf).select("case_no", F.size("tasks").cast("long").alias("tasks"), "semantic_id", "compile_error")


@query(f"""WITH {SLOTS} SELECT case_no, '[' || string_agg('{{"kind": "' || kind || '", "instruction": "do ' || t || ' ' || k || '"' || CASE WHEN name IS NULL THEN '' ELSE ', "name": "' || name || '", "arguments": ' || args END || '}}', ', ' ORDER BY event_id) || ']' AS target,
  CASE WHEN bool_or(t = 'error') THEN 'negative' ELSE 'positive' END AS polarity, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds, coalesce(string_agg(DISTINCT name, ',' ORDER BY name), '') AS tools FROM s GROUP BY 1""")
def rendered_rows(spark, sf):
    rows = C.render_rows(event_plans(spark, sf).withColumn("query", F.array_join("source_queries", " ")), system="You plan.")
    return assert_roles(rows).select(
        "case_no", F.get("messages", F.lit(2))["content"].alias("target"), "polarity", F.array_join("kinds", ",").alias("kinds"),
        F.array_join("tools_used", ",").alias("tools"),
    )


@query(f"""WITH r AS (SELECT event_id // 4 AS case_no, count(*) FILTER (event_type IS NOT NULL) AS level, bool_or(event_type = 'view') AS big FROM events GROUP BY 1),
  k AS (SELECT case_no, row_number() OVER (ORDER BY {md5_of("'5'", 'case_no')}) AS o FROM r WHERE big), m AS (SELECT CASE WHEN coalesce(o <= 100, false) THEN 'validation' ELSE 'train' END AS s, CASE WHEN big THEN 2 ELSE 1 END AS level FROM r LEFT JOIN k USING (case_no))
  SELECT 'splits' AS section, s AS name, count(*) AS rows FROM m GROUP BY s UNION ALL SELECT 'levels', level::VARCHAR, count(*) FROM m GROUP BY level""")
def release_manifest(spark, sf):
    rows = C.render_rows(event_plans(spark, sf).withColumn("query", F.array_join("source_queries", " ")))
    rows = rows.withColumn("level", F.when(F.array_contains("tools_used", "web_search"), 2).otherwise(1))
    train, val = sinks.release_tables(rows, "case_no", 100, 2, 5)
    return sinks.manifest(train, val, "1.0", 5).select("section", "name", "rows")


@query(f"""WITH {DIALOGUES}, r AS (SELECT h, h || ':' || count(*) AS e FROM (SELECT sha256(to_json({{'messages': m}})::VARCHAR) AS h FROM d) GROUP BY h),
  a AS (SELECT substr(h, 1, 4) AS p, sha256(string_agg(e, ',' ORDER BY e)) AS d FROM r GROUP BY 1),
  b AS (SELECT substr(p, 1, 2) AS p, sha256(string_agg(p || '=' || d, ',' ORDER BY p)) AS d FROM a GROUP BY 1)
  SELECT sha256(string_agg(p || '=' || d, ',' ORDER BY p)) AS digest FROM b""")
def content_digest(spark, sf):
    return sinks.content_digest(A.dialogues(spark, sf))


def tool_rows(spark, sf):
    tools = F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind"), F.lit("Takes a query or gesture").alias("description"), F.lit(s).alias("arguments_schema"))
        for n, k, s in A.CONTRACT
    ])
    return event_plans(spark, sf).select(
        F.col("case_no").cast("string").alias("example_id"), tools.alias("tools"), "tasks", "language", F.lit("real").alias("tool_naming"),
        F.array_join("source_queries", " ").alias("instruction"),
    )


CALLED = f"""{SLOTS}, n AS (SELECT DISTINCT case_no, name FROM s WHERE name IS NOT NULL)"""


@query(f"""WITH {CALLED}, d AS (SELECT case_no, arg_min(name, md5(concat_ws(':', '3', case_no, name))) AS gone FROM n GROUP BY 1)
  SELECT d.case_no::VARCHAR AS example_id, gone AS dropped, 3 AS tools, count(*) FILTER (s.name IS NULL OR s.name = gone) AS replies FROM d JOIN s USING (case_no) GROUP BY ALL""")
def without_used_tool(spark, sf):
    rows = C.drop_used(tool_rows(spark, sf), 3)
    return rows.select(
        "example_id", F.get("dropped_tools", F.lit(0)).alias("dropped"), F.size("tools").cast("long").alias("tools"),
        F.size(F.filter("tasks", lambda t: t["kind"] == "reply")).cast("long").alias("replies"),
    )


@query(f"""WITH {CALLED}, c AS (SELECT case_no, (SELECT count(*) FROM n WHERE n.case_no = x.case_no) AS used FROM (SELECT DISTINCT case_no FROM s) x), m AS (SELECT case_no, least(4 - used, 3) AS most FROM c)
  SELECT case_no::VARCHAR AS example_id, 4 - (1 + {draw_of("'3:count'", 'case_no')} % most) AS tools FROM m WHERE most >= 1""")
def without_unused_tools(spark, sf):
    return C.drop_unused(tool_rows(spark, sf), 3).select("example_id", F.size("tools").cast("long").alias("tools"))


@query(f"""WITH {SLOTS} SELECT case_no::VARCHAR AS example_id, 4 AS tools, count(name) AS calls, 0 AS real_names FROM s GROUP BY 1""")
def masked_names(spark, sf):
    rows = C.mask_names(tool_rows(spark, sf), 3)
    real = [n for n, _, _ in A.CONTRACT]
    return rows.select(
        "example_id", F.size("tools").cast("long").alias("tools"),
        F.size(F.filter("tasks", lambda t: t["kind"] != "reply")).cast("long").alias("calls"),
        F.size(F.filter("tasks", lambda t: F.coalesce(t["name"].isin(real), F.lit(False)))).cast("long").alias("real_names"),
    )


@query(f"""WITH {CALLED}, c AS (SELECT case_no, (SELECT count(*) FROM n WHERE n.case_no = x.case_no) AS used FROM (SELECT DISTINCT case_no FROM s) x),
  v AS (SELECT 'masked' AS variant, case_no FROM c WHERE {draw_of("'4:masked:rate'", 'case_no')} / 4294967296.0 < 0.5 UNION ALL SELECT 'drop_used', case_no FROM c WHERE used > 0 AND {draw_of("'4:drop_used:rate'", 'case_no')} / 4294967296.0 < 0.4
   UNION ALL SELECT 'drop_unused', case_no FROM c WHERE used < 4 AND {draw_of("'4:drop_unused:rate'", 'case_no')} / 4294967296.0 < 0.3)
  SELECT variant, true AS valid, count(*) AS rows FROM v GROUP BY 1""")
def augmented_rows(spark, sf):
    rows = C.augment(tool_rows(spark, sf), {"masked": 0.5, "drop_used": 0.4, "drop_unused": 0.3}, 4)
    return rows.groupBy("variant", "valid").agg(F.count(F.lit(1)).alias("rows"))


@query(f"""WITH a AS (SELECT event_id, 'walk ' || (props->>'$.k') || ' steps' AS q, props->>'$.k' AS value FROM events), v AS (SELECT DISTINCT n_chars::VARCHAR AS s FROM documents WHERE n_chars < 1000),
  r AS (SELECT event_id, s, row_number() OVER (PARTITION BY event_id ORDER BY {md5_of("'0:train'", 'event_id', 's')}) AS o FROM a JOIN v ON s <> value)
  SELECT event_id, 'walk ' || s || ' steps' AS new_text FROM r WHERE o <= 2""")
def slot_variants(spark, sf):
    """Document lengths below 1000 are the value list of the slot."""
    k = F.get_json_object("props", "$.k")
    atoms = A.table(spark, sf, "events").select("event_id", F.concat(F.lit("walk "), k, F.lit(" steps")).alias("query"), F.lit("step").alias("slot"), k.alias("value"))
    values = A.table(spark, sf, "documents").where("n_chars < 1000").select(
        F.lit("step").alias("slot"), F.lit("train").alias("part"), F.col("n_chars").cast("string").alias("surface")
    )
    return C.slot_variants(atoms, values, "train", 2, key="event_id").select("event_id", "new_text")


@query("""SELECT event_id, event_type IN ('click', 'view') AS surfaces_ok FROM events""")
def shown_surfaces(spark, sf):
    slots = F.array(
        F.struct(F.lit("city").alias("slot"), F.array(F.when(F.col("event_type") == "error", "city").otherwise("City")).alias("surfaces")),
        F.struct(F.lit("step").alias("slot"), F.array(F.lit("CLICK"), F.lit("view")).alias("surfaces")),
    )
    rows = A.table(spark, sf, "events").select("event_id", F.concat(F.lit("City "), "event_type").alias("query"), slots.alias("slot_values"))
    return C.surfaces_present(rows).select("event_id", "surfaces_ok")

"""Alignment, checks, exports and rendering."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance import adapters as A
from parlance.functions.text import count_of, let
from parlance.model import DatasetSpec
from parlance.operators import align, blocks, checks, dialogues, media, render
from parlance.showcase import DIALOGUES, query
from parlance.sources import sinks

SHAREGPT = DatasetSpec(formatting="sharegpt")
ALPACA = DatasetSpec(history="history", system="system")
CHAT = DatasetSpec(
    formatting="openai", messages="messages", role_tag="role", content_tag="content", user_tag="user",
    assistant_tag="assistant", observation_tag="tool", function_tag="function", system_tag="system",
)


def aligned(spark, sf):
    return align.align(A.tagged_dialogues(spark, sf), SHAREGPT, ["conv_id"])


@query(f"""WITH {DIALOGUES} SELECT conv_id, CASE WHEN good THEN greatest(len(b) - 1, 0) ELSE 0 END AS prompt_turns,
  CASE WHEN good AND len(b) > 0 THEN 1 ELSE 0 END AS response_turns, sys AS system_text,
  CASE WHEN good THEN b[len(b)].content END AS answer FROM v""")
def align_sharegpt(spark, sf):
    return aligned(spark, sf).select(
        "conv_id", F.size("_prompt").cast("long").alias("prompt_turns"), F.size("_response").cast("long").alias("response_turns"),
        F.col("_system").alias("system_text"), F.get("_response", F.lit(0))["content"].alias("answer"),
    )


@query(f"""WITH {DIALOGUES}, f AS (SELECT conv_id, list_filter(m, lambda x: x.role <> 'system') AS b,
    list_filter(m, lambda x: x.role = 'system')[1].content AS sys FROM d), n AS (SELECT *, len(b) // 2 AS n FROM f)
  SELECT conv_id, 2 * n - 1 AS prompt_turns, b[2 * n - 1].content AS question, b[2 * n].content AS answer, sys AS system_text
  FROM n WHERE n > 0""")
def align_alpaca(spark, sf):
    rows = align.align(A.alpaca_rows(spark, sf), ALPACA, ["conv_id"])
    return rows.select(
        "conv_id", F.size("_prompt").cast("long").alias("prompt_turns"), F.element_at("_prompt", -1)["content"].alias("question"),
        F.get("_response", F.lit(0))["content"].alias("answer"), F.col("_system").alias("system_text"),
    )


@query(f"""WITH {DIALOGUES} SELECT conv_id, CASE WHEN good THEN len(b) ELSE 0 END AS turns,
  CASE WHEN sys = '' THEN 'detailed thinking off' ELSE sys || chr(10) || 'detailed thinking off' END AS system_text FROM v""")
def align_openai(spark, sf):
    rows = align.align(A.dialogues(spark, sf), CHAT, ["conv_id"])
    return rows.select(
        "conv_id", (F.size("_prompt") + F.size("_response")).cast("long").alias("turns"), F.col("_system").alias("system_text")
    )


@query("""SELECT l.doc_id, 1 AS prompt_turns, 2 AS response_turns, CASE WHEN quality = 1 THEN text ELSE '' END AS first_answer,
  CASE WHEN quality = 1 THEN '' ELSE text END AS second_answer FROM labels l JOIN documents d USING (doc_id)""")
def align_kto(spark, sf):
    docs = A.labelled_documents(spark, sf).select(
        "doc_id", F.col("lang").alias("instruction"), F.col("text").alias("output"), (F.col("quality") == 1).alias("tag")
    )
    rows = align.align(docs, DatasetSpec(query=None, kto_tag="tag"), ["doc_id"])
    return rows.select(
        "doc_id", F.size("_prompt").alias("prompt_turns"), F.size("_response").alias("response_turns"),
        F.get("_response", F.lit(0))["content"].alias("first_answer"), F.get("_response", F.lit(1))["content"].alias("second_answer"),
    )


PAIRS = """x AS (SELECT doc_id, lang, text, quality, row_number() OVER (PARTITION BY lang, quality ORDER BY doc_id) AS r
  FROM documents JOIN labels USING (doc_id)), p AS (
  SELECT g.lang, g.r - 1 AS ordinal, g.doc_id AS chosen_id, b.doc_id AS rejected_id, g.text AS chosen, b.text AS rejected,
  'Write in ' || g.lang AS instruction FROM x g JOIN x b ON g.lang = b.lang AND g.r = b.r AND g.quality = 1 AND b.quality = 0)"""


@query(f"""WITH {PAIRS} SELECT chosen_id, rejected_id, instruction AS question, md5(chosen) AS chosen_md5, md5(rejected) AS rejected_md5 FROM p""")
def align_ranking(spark, sf):
    pairs = A.preference_pairs(spark, sf)
    spec = DatasetSpec(query=None, ranking=True, chosen="chosen", rejected="rejected", response=None)
    rows = align.align(pairs, spec, ["chosen_id", "rejected_id"])
    answer = lambda i: F.md5(F.get("_response", F.lit(i))["content"].cast("binary"))
    return rows.select(
        "chosen_id", "rejected_id", F.get("_prompt", F.lit(0))["content"].alias("question"),
        answer(0).alias("chosen_md5"), answer(1).alias("rejected_md5"),
    )


@query("""SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn, role, text AS content FROM conversations""")
def dialogue_turns(spark, sf):
    return dialogues.turns(A.dialogues(spark, sf), "conv_id").withColumn("turn", F.col("turn").cast("long"))


@query("""SELECT conv_id, count(*) AS messages, count(*) FILTER (role = 'assistant') AS supervised,
  sum(length(text)) AS characters FROM conversations GROUP BY conv_id""")
def blocks_sharegpt(spark, sf):
    rows = blocks.to_blocks_sharegpt(A.tagged_dialogues(spark, sf), ["conv_id"])
    return rows.select(
        "conv_id", F.size("messages").cast("long").alias("messages"),
        F.aggregate("messages", F.lit(0.0), lambda n, m: n + m["loss_weight"]).cast("long").alias("supervised"),
        F.aggregate("messages", F.lit(0), lambda n, m: n + F.length(m["content"][0]["value"])).cast("long").alias("characters"),
    )


@query(f"""WITH {DIALOGUES}, f AS (SELECT conv_id, list_filter(m, lambda x: x.role <> 'system') AS b,
    list_filter(m, lambda x: x.role = 'system')[1].content AS sys FROM d), n AS (SELECT *, len(b) // 2 AS n FROM f)
  SELECT conv_id, CASE WHEN sys IS NULL THEN 2 ELSE 3 END AS messages, length(b[2 * n - 1].content) AS asked,
  length(b[2 * n].content) AS answered FROM n WHERE n > 0""")
def blocks_alpaca(spark, sf):
    rows = blocks.to_blocks_alpaca(A.alpaca_rows(spark, sf), ["conv_id"])
    text = lambda role: F.get(F.filter("messages", lambda m: m["role"] == role), F.lit(0))["content"][0]["value"]
    return rows.select(
        "conv_id", F.size("messages").cast("long").alias("messages"), F.length(text("user")).cast("long").alias("asked"),
        F.length(text("assistant")).cast("long").alias("answered"),
    )


@query(f"""WITH {PAIRS} SELECT chosen_id, rejected_id, length(chosen) AS chosen_chars, length(rejected) AS rejected_chars,
  1.0::DOUBLE AS weight FROM p""")
def blocks_pair(spark, sf):
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    pairs = A.preference_pairs(spark, sf).select(
        "chosen_id", "rejected_id",
        *[F.array(turn("user", "instruction"), turn("assistant", c)).alias(c) for c in ("chosen", "rejected")],
    )
    rows = blocks.to_blocks_pair(pairs, ["chosen_id", "rejected_id"])
    chars = lambda c: F.length(F.element_at(c, -1)["content"][0]["value"]).cast("long")
    return rows.select(
        "chosen_id", "rejected_id", chars("chosen_messages").alias("chosen_chars"),
        chars("rejected_messages").alias("rejected_chars"), F.element_at("chosen_messages", -1)["loss_weight"].alias("weight"),
    )


def tagged_media(spark, sf):
    """Documents whose " en " and " de " became image and audio tags; every fifth row lacks one image file."""
    docs = A.table(spark, sf, "documents").select(
        "doc_id", F.replace(F.replace("text", F.lit(" en "), F.lit("<image>")), F.lit(" de "), F.lit("<audio>")).alias("text")
    )
    paths = lambda tag, gap: let(count_of(F.col("text"), tag) - gap, lambda n: F.when(n > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.concat(F.lit("f"), i)
    )).otherwise(F.array().cast("array<string>")))
    return docs.withColumn("images", paths("<image>", F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0))).withColumn(
        "audios", paths("<audio>", F.lit(0))
    )


MEDIA_SQL = """t AS (SELECT doc_id, replace(replace(text, ' en ', '<image>'), ' de ', '<audio>') AS text FROM documents),
  c AS (SELECT *, (length(text) - length(replace(text, '<image>', ''))) // 7 AS i, (length(text) - length(replace(text, '<audio>', ''))) // 7 AS a FROM t)"""


@query(f"""WITH {MEDIA_SQL} SELECT doc_id, i + a AS media_blocks,
  len(CASE WHEN i + a = 0 THEN [text] ELSE list_filter(regexp_split_to_array(text, '<image>|<audio>'), lambda x: x <> '') END) AS text_blocks,
  CASE WHEN doc_id % 5 = 0 AND i > 0 THEN 'More <image> tags than provided media files.' END AS media_error FROM c""")
def media_blocks(spark, sf):
    rows = blocks.split_media_blocks(tagged_media(spark, sf))
    kinds = lambda kind: F.size(F.filter("blocks", lambda b: (b["type"] == "text") == F.lit(kind))).cast("long")
    return rows.select("doc_id", kinds(False).alias("media_blocks"), kinds(True).alias("text_blocks"), "media_error")


@query(f"""WITH {MEDIA_SQL} SELECT doc_id, NOT (doc_id % 5 = 0 AND i > 0) AS media_ok FROM c""")
def media_counts(spark, sf):
    rows = tagged_media(spark, sf).withColumn("messages", F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))))
    return checks.validate_media(rows).select("doc_id", "media_ok")


@query("""SELECT page_id, CASE WHEN url IN (SELECT url FROM pages WHERE page_id % 2 = 0) THEN '/media/' || url ELSE url END AS first_path,
  url || '?x' AS second_path FROM pages""")
def media_paths(spark, sf):
    pages = A.table(spark, sf, "pages").select("page_id", F.array("url", F.concat("url", F.lit("?x"))).alias("images"))
    files = A.table(spark, sf, "pages").where("page_id % 2 = 0").select(F.col("url").alias("path"))
    rows = media.resolve_media(pages, files, "/media", "images", "page_id")
    return rows.select("page_id", F.get("images", F.lit(0)).alias("first_path"), F.get("images", F.lit(1)).alias("second_path"))


@query("""SELECT conv_id, rank AS cut FROM (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rank FROM conversations)
  WHERE role = 'assistant' UNION ALL SELECT conv_id, NULL FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'assistant') = 0""")
def prefix_expansion(spark, sf):
    rows = blocks.to_blocks_sharegpt(A.tagged_dialogues(spark, sf), ["conv_id"])
    return blocks.expand_prefixes(rows).select("conv_id", F.col("cut").cast("long").alias("cut"))


@query("""SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles, sum(length(text)) AS characters, false AS call_error
  FROM conversations GROUP BY conv_id""")
def chat_rows(spark, sf):
    rows = blocks.to_chat_rows(blocks.to_blocks_sharegpt(A.tagged_dialogues(spark, sf), ["conv_id"]))
    return rows.select(
        "conv_id", F.array_join(F.transform("chat", lambda m: m["role"]), ",").alias("roles"),
        F.aggregate("chat", F.lit(0), lambda n, m: n + F.length(m["content"])).cast("long").alias("characters"), "call_error",
    )


@query(f"""WITH {DIALOGUES} SELECT 'sft' AS stage, count(*) FILTER (good AND len(b) > 0) AS kept FROM v
  UNION ALL SELECT 'kto', 0 UNION ALL SELECT 'unsupervised', count(*) FILTER (good AND len(b) > 0) FROM v""")
def stage_filter(spark, sf):
    rows = aligned(spark, sf)
    stages = F.array(*[
        F.struct(F.lit(s).alias("stage"), checks.stage_valid(s).alias("ok")) for s in ("sft", "kto", "unsupervised")
    ])
    return rows.select(F.explode(stages).alias("s")).groupBy("s.stage").agg(F.count_if("s.ok").alias("kept"))


@query("""SELECT count(*) FILTER (quality = 1 AND text <> '') AS desired, count(*) FILTER (NOT (quality = 1 AND text <> '')) AS undesired,
  false AS one_class_only FROM labels JOIN documents USING (doc_id)""")
def kto_balance(spark, sf):
    docs = A.labelled_documents(spark, sf).select(
        "doc_id", F.col("lang").alias("instruction"), F.col("text").alias("output"), (F.col("quality") == 1).alias("tag")
    )
    return checks.kto_balance(align.align(docs, DatasetSpec(query=None, kto_tag="tag")))


@query("""SELECT conv_id, string_agg(role, ',' ORDER BY turn) = 'system,user,assistant' AS shape_ok FROM conversations GROUP BY conv_id""")
def role_shape(spark, sf):
    return A.dialogues(spark, sf).select("conv_id", checks.role_shape_ok(("system", "user", "assistant")).alias("shape_ok"))


@query("""WITH t AS (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS n FROM documents)
  SELECT doc_id, n AS tokens FROM t WHERE n <= 100 OR n // 2 < 100""")
def supervision_left(spark, sf):
    """The first half of the words is prompt; rows whose answer lies beyond the cutoff are dropped."""
    from parlance.operators.encode import hash_ids, tokenize

    docs = hash_ids(tokenize(A.table(spark, sf, "documents"), "text"))
    docs = docs.withColumn("loss_weights", let(F.col("input_ids"), lambda ids: F.transform(
        ids, lambda x, i: F.when(i >= F.floor(F.size(ids) / 2), 1.0).otherwise(0.0)
    )))
    return checks.drop_unsupervised(docs, 100).select("doc_id", F.size("input_ids").cast("long").alias("tokens"))


@query(f"""WITH {DIALOGUES} SELECT conv_id, len(b) + CASE WHEN sys <> '' THEN 1 ELSE 0 END AS messages,
  CASE WHEN sys <> '' THEN 'system' ELSE 'user' END AS first_role FROM v WHERE good AND len(b) > 0""")
def export_messages(spark, sf):
    return sinks.export_records(aligned(spark, sf), "messages", ["conv_id"]).select(
        "conv_id", F.size("messages").cast("long").alias("messages"), F.get("messages", F.lit(0))["role"].alias("first_role")
    )


@query(f"""WITH {DIALOGUES} SELECT conv_id, sys AS system_text, array_to_string(list_transform(b, lambda x:
  CASE WHEN x.role = 'user' THEN 'User' ELSE 'Assistant' END), ',') AS names, 'User' AS mask FROM v WHERE good AND len(b) > 0""")
def export_conversations(spark, sf):
    return sinks.export_records(aligned(spark, sf), "conversations", ["conv_id"]).select(
        "conv_id", F.col("system").alias("system_text"), F.array_join(F.transform("conversations", lambda m: m["from"]), ",").alias("names"), "mask"
    )


@query(f"""WITH {DIALOGUES} SELECT conv_id, b[1].content AS text FROM v WHERE good AND len(b) > 0""")
def export_text(spark, sf):
    return sinks.export_records(aligned(spark, sf), "text", ["conv_id"])


@query("""SELECT doc_id, lang, (SELECT count(*) FROM documents) AS total FROM documents ORDER BY doc_id LIMIT 10 OFFSET 20""")
def page_preview(spark, sf):
    return sinks.preview(A.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 2, 10)


@query("""WITH e AS (SELECT event_id // 4 AS case_id, event_id, CASE event_type WHEN 'purchase' THEN 'HumanAction' WHEN 'signup' THEN 'RobotGesture'
  WHEN 'click' THEN 'robot_status' WHEN 'view' THEN 'web_search' END AS name FROM events)
  SELECT case_id, string_agg(CASE WHEN name = 'web_search' THEN 'unaliased:x_web_search' ELSE name END, ',' ORDER BY event_id) AS names,
  bool_or(coalesce(name = 'web_search', false)) AS alias_error FROM e GROUP BY case_id""")
def dealias_plans(spark, sf):
    """Names carry a prefix; the alias map leaves one tool out."""
    real = ("HumanAction", "RobotGesture", "robot_status")
    cases = A.plan_cases(spark, sf).select("case_id", F.transform(
        "expected", lambda t: t.withField("name", F.concat(F.lit("x_"), t["name"]))
    ).alias("plan"))
    cases = cases.withColumn("tools", F.filter("plan", lambda t: t["name"].isNotNull())).withColumn(
        "aliases", F.create_map(*[F.lit(x) for n in real for x in (n, "x_" + n)])
    )
    rows = align.dealias(cases, "plan", "tools", "aliases")
    return rows.select(
        "case_id", F.nullif(F.array_join(F.array_compact(F.transform("plan", lambda t: t["name"])), ","), F.lit("")).alias("names"), "alias_error"
    )


@query("""SELECT CASE WHEN quality = 1 AND toxic = 0 THEN 'accepted' ELSE 'rejected' END AS side, count(*) AS rows FROM labels GROUP BY 1""")
def accept_reject(spark, sf):
    issues = F.array_compact(F.array(F.when(F.col("quality") == 0, "low quality"), F.when(F.col("toxic") == 1, "toxic")))
    good, bad = sinks.split_accept_reject(A.table(spark, sf, "labels").withColumn("issues", issues))
    return good.agg(F.count(F.lit(1)).alias("rows")).withColumn("side", F.lit("accepted")).unionByName(
        bad.agg(F.count(F.lit(1)).alias("rows")).withColumn("side", F.lit("rejected"))
    )


# ---- rendering ---------------------------------------------------------------------------------------

TEMPLATE = [("plain", "<s>", "[SYS]{{content}}\n", "Q{{idx}}: {{content}}\n", "A: {{content}}</s>", "O: {{content}}\n", "F: {{content}}", "Be brief.")]


@query(f"""WITH {DIALOGUES} SELECT conv_id, array_to_string(list_transform(b, lambda x, i: CASE WHEN i = 1 THEN '<s>[SYS]' ||
  CASE WHEN sys = '' THEN 'Be brief.' ELSE sys END || chr(10) ELSE '' END || CASE WHEN x.role = 'user' THEN 'Q' || ((i - 1) // 2) || ': ' || x.content || chr(10)
  ELSE 'A: ' || x.content || '</s>' END), '') AS text FROM v WHERE good AND len(b) > 0""")
def render_dialogues(spark, sf):
    names = "template string, prefix string, system string, user string, assistant string, observation string, function string, default_system string"
    templates = spark.createDataFrame(TEMPLATE, names)
    rows = checks.drop_invalid(aligned(spark, sf), "sft").withColumn("messages", F.concat("_prompt", "_response"))
    rows = render.render(rows.withColumn("template", F.lit("plain")), templates)
    return rows.select("conv_id", F.array_join("segments", "").alias("text"))


@query("""SELECT event_id, 'Action: ' || event_type || chr(10) || 'Action Input: {"k": ' || (props->>'$.k') || '}' AS call_text,
  '<tool_call>' || chr(10) || '{"name": "' || event_type || '", "arguments": {"k": ' || (props->>'$.k') || '}}' || chr(10) || '</tool_call>' AS tagged_text FROM events""")
def render_calls(spark, sf):
    e = A.table(spark, sf, "events").select(
        "event_id", F.concat(F.lit('{"name": "'), "event_type", F.lit('", "arguments": '), "props", F.lit("}")).alias("content")
    )
    rows = render.render_calls(e, layout="default")
    return render.render_calls(rows, layout="tagged", out="tagged_text").select("event_id", "call_text", "tagged_text")


@query("""SELECT conv_id, turn, 'search' AS name, json_extract_string(to_json({'q': text}), '$.q') AS q FROM conversations WHERE role = 'assistant'""")
def extract_calls(spark, sf):
    """Assistant texts wrapped into call text and read back."""
    rows = A.table(spark, sf, "conversations").where("role = 'assistant'").select(
        "conv_id", "turn", F.concat(F.lit('<tool_call>\n{"name": "search", "arguments": '), F.to_json(F.struct(F.col("text").alias("q"))), F.lit("}\n</tool_call>")).alias("content")
    )
    rows = render.extract_calls(rows, layout="tagged").select("conv_id", "turn", F.explode("calls").alias("c"))
    return rows.select("conv_id", "turn", "c.name", F.get_json_object("c.arguments", "$.q").alias("q"))


@query("""SELECT event_id, 'You have access to the following tools:' || chr(10) || '> Tool Name: ' || event_type || chr(10) || 'Tool Description: does ' || event_type || chr(10)
  || 'Tool Args:' || chr(10) || '  - k (integer, required): a number' || chr(10) || chr(10) AS head FROM events""")
def render_tools(spark, sf):
    e = A.table(spark, sf, "events").select("event_id", F.concat(
        F.lit('[{"type":"function","function":{"name":"'), "event_type", F.lit('","description":"does '), "event_type",
        F.lit('","parameters":{"type":"object","properties":{"k":{"type":"integer","description":"a number"}},"required":["k"]}}}]'),
    ).alias("_tools"))
    rows = render.render_tools(e)
    return rows.select("event_id", F.substring_index("tool_text", "Use the following", 1).alias("head"))


@query(f"""WITH {DIALOGUES} SELECT conv_id, sum(length(content)) AS characters, count(*) FILTER (i < n) AS stripped FROM (
  SELECT conv_id, unnest(list_transform(b, lambda x, i: {{'i': i, 'role': x.role, 'content': CASE WHEN x.role = 'assistant' AND i = len(b) THEN '<think>' || chr(10) || 'hm' || chr(10) || '</think>' || chr(10) || chr(10) || x.content ELSE x.content END}}), recursive := true), len(b) AS n
  FROM v WHERE good AND len(b) > 0) WHERE true GROUP BY conv_id""")
def strip_thoughts(spark, sf):
    """Every answer starts with a thought; all but the last one lose it."""
    rows = checks.drop_invalid(aligned(spark, sf), "sft")
    body = F.transform(F.concat("_prompt", "_response"), lambda m: m.withField("content", F.when(
        m["role"] == "assistant", F.concat(F.lit("<think>\nhm\n</think>\n\n"), m["content"])
    ).otherwise(m["content"])))
    rows = render.thoughts(rows.select("conv_id", body.alias("messages")), "history")
    return rows.select(
        "conv_id", F.aggregate("messages", F.lit(0), lambda n, m: n + F.length(m["content"])).cast("long").alias("characters"),
        (F.size("messages") - 1).cast("long").alias("stripped"),
    )


@query("""SELECT doc_id, md5(replace(replace(text, 'tion', 't' || chr(8203) || 'ion'), 'the', 't' || chr(8203) || 'he')) AS text_md5 FROM documents""")
def neutralise_tokens(spark, sf):
    rows = render.neutralise(A.table(spark, sf, "documents").select("doc_id", "text"), ["the", "tion", "x"])
    return rows.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("""WITH q AS (SELECT vec_id, 'cat' || label AS subject, 'Vector ' || vec_id || '?' AS question, ['A','B'][label % 2 + 1] AS answer FROM embeddings),
  r AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY md5(concat_ws(':', '7', vec_id))) AS o FROM q)
  SELECT vec_id, (SELECT 2 * count(*) FROM r WHERE r.subject = q.subject AND o <= 2) + 2 AS messages,
  'The following are multiple choice questions (with answers) about ' || subject || '.' || chr(10) || chr(10) ||
  (SELECT question FROM r WHERE r.subject = q.subject AND o = 1) || chr(10) || 'A. yes' || chr(10) || 'B. no' || chr(10) || 'Answer:' AS first_text FROM q""")
def fewshot_prompts(spark, sf):
    rows = A.table(spark, sf, "embeddings").select(
        "vec_id", F.concat(F.lit("cat"), "label").alias("subject"), F.concat(F.lit("Vector "), "vec_id", F.lit("?")).alias("question"),
        F.lit("yes").alias("A"), F.lit("no").alias("B"), F.when(F.col("label") % 2 == 0, "A").otherwise("B").alias("answer"),
    )
    out = render.fewshot(rows, rows, 2, "vec_id", "vec_id", seed=7)
    return out.select("vec_id", F.size("messages").cast("long").alias("messages"), F.get("messages", F.lit(0))["content"].alias("first_text"))

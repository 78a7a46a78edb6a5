"""Operator inputs derived from the test tables (whole tables, no subsets)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.functions.hashing import draw_int
from parlance.operators.dialogues import collect_dialogues

ROLE_TAGS = {"user": "human", "assistant": "gpt", "system": "system"}


TEXT_TABLES = ("documents", "conversations", "benchmark")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table. A text table of fewer splits than cores (one small file) is spread, so that per-row text work
    uses all cores; a table of many splits is read as it is."""
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in TEXT_TABLES and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def dialogues(spark, sf) -> DataFrame:
    """(conv_id, messages): role/content turns."""
    return collect_dialogues(table(spark, sf, "conversations"))


def tagged_dialogues(spark, sf) -> DataFrame:
    """(conv_id, conversations): from/value turns."""
    return dialogues(spark, sf).select("conv_id", F.transform("messages", lambda m: F.struct(
        F.when(m["role"] == "user", "human").when(m["role"] == "assistant", "gpt").otherwise(m["role"]).alias("from"),
        m["content"].alias("value"),
    )).alias("conversations"))


def alpaca_rows(spark, sf) -> DataFrame:
    """(conv_id, instruction, input, output, system, history): last pair asked, earlier pairs as history."""
    rows = dialogues(spark, sf)
    body = F.filter("messages", lambda m: m["role"] != "system")
    rows = rows.withColumn("b", body).withColumn("system", F.get(F.filter("messages", lambda m: m["role"] == "system"), F.lit(0))["content"])
    n = F.floor(F.size("b") / 2).cast("int")
    rows = rows.withColumn("n", n).where(F.col("n") > 0)
    past = F.when(F.col("n") > 1, F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("n") - 2, F.lit(0))),
        lambda k: F.array(F.get("b", k * 2)["content"], F.get("b", k * 2 + 1)["content"]),
    ))
    return rows.select(
        "conv_id", F.get("b", (F.col("n") - 1) * 2)["content"].alias("instruction"), F.lit("").alias("input"),
        F.get("b", (F.col("n") - 1) * 2 + 1)["content"].alias("output"), "system", past.alias("history"),
    )


def labelled_documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")


def preference_pairs(spark, sf) -> DataFrame:
    """(lang, ordinal, instruction, chosen, rejected): quality 1 against 0 of a language, matched by rank."""
    from parlance.functions.ranks import rank_by_int

    docs = labelled_documents(spark, sf)
    good = rank_by_int(docs.where("quality = 1"), "doc_id", ["lang"]).select("lang", "ordinal", F.col("doc_id").alias("chosen_id"), F.col("text").alias("chosen"))
    bad = rank_by_int(docs.where("quality = 0"), "doc_id", ["lang"]).select("lang", "ordinal", F.col("doc_id").alias("rejected_id"), F.col("text").alias("rejected"))
    return good.join(bad, ["lang", "ordinal"]).withColumn("instruction", F.concat(F.lit("Write in "), F.col("lang")))


def lines(spark, sf) -> DataFrame:
    """(line_id, doc_id, lang, source, line): every non-empty line of every document."""
    docs = table(spark, sf, "documents")
    rows = docs.select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return rows.where(F.length("line") > 0).withColumn("line_id", F.col("doc_id") * 1000000 + F.col("i"))


def benchmark_lines(spark, sf) -> DataFrame:
    rows = table(spark, sf, "benchmark").select("item_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return rows.where(F.length("line") > 0).withColumn("case_id", F.col("item_id") * 1000000 + F.col("i"))


def predictions(spark, sf) -> DataFrame:
    """(pair_id, predict, label): each document against the one before it in its language (the first against the last), and each
    assistant turn against the turn before it."""
    from parlance.functions.ranks import rank_by_int

    docs = rank_by_int(table(spark, sf, "documents").select("doc_id", "lang", "text"), "doc_id", ["lang"])
    counts = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    labels = docs.join(counts, "lang").select("lang", ((F.col("ordinal") + 1) % F.col("n")).alias("ordinal"), F.col("text").alias("label"))
    first = docs.join(labels, ["lang", "ordinal"]).select(
        F.concat(F.lit("doc:"), F.col("doc_id")).alias("pair_id"), F.col("text").alias("predict"), "label"
    )
    # turns of a dialogue are few and lie together
    before = W.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf, "conversations").withColumn("label", F.coalesce(F.lag("text").over(before), F.lit("")))
    second = turns.where("role = 'assistant'").select(
        F.concat(F.lit("turn:"), F.col("conv_id"), F.lit(":"), F.col("turn")).alias("pair_id"), F.col("text").alias("predict"), "label"
    )
    return first.unionByName(second)


def results(spark, sf) -> DataFrame:
    """Flat score rows from events: variant = user mod 3, an error event fails, value = latency, k = tokens."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    ok = F.col("event_type") != "error"
    return e.select(
        F.col("event_id").cast("string").alias("record_id"), F.col("event_id").cast("string").alias("request_id"),
        F.lit("base").alias("contract_name"), F.lit("f0").alias("contract_fingerprint"),
        F.concat(F.lit("v"), F.col("user_id") % 3).alias("variant"),
        F.concat(F.lit("c"), F.floor(F.col("event_id") / 3)).alias("case_id"),
        F.concat(F.lit("L"), F.col("user_id") % 4 + 1).alias("level"),
        F.when(F.col("user_id") % 2 == 0, "zh").otherwise("en").alias("language"),
        F.when(k < 30, "easy").when(k < 70, "medium").otherwise("hard").alias("difficulty"),
        F.when(F.col("event_type") == "view", "negative").otherwise("positive").alias("polarity"),
        (k % 10 == 0).alias("exact_train"), (k % 3 == 0).alias("all_atoms_seen_train"), (k % 7 == 0).alias("has_novel_atom"),
        ok.alias("strict_pass"), (k >= 5).alias("valid_json"), (k >= 10).alias("contract_valid"),
        (k >= 15).alias("task_count_match"), (k >= 20).alias("ordered_kind_name_match"),
        F.when(k % 4 != 0, ok).alias("parameter_match"), (k == 42).alias("forbidden_tool_violation"),
        F.col("value").alias("latency_ms"), k.alias("prompt_tokens"), (k * 2).alias("output_tokens"),
        F.when(ok, "passed").when(k < 50, "invalid_json").otherwise("task_count_mismatch").alias("reason"),
        F.array("event_type").alias("expected_tools"),
        ok.alias("compatible_pass"), (k >= 5).alias("parser_valid"), (k >= 15).alias("tool_sequence_match"),
        F.lit(3).alias("expected_step_count"), (k % 5).cast("int").alias("predicted_step_count"),
        F.least(F.lit(3), (k % 5).cast("int")).alias("aligned_kind_name_matches"),
        F.when(k == 13, "timeout").alias("error"),
    )


CONTRACT = (
    ("HumanAction", "action", '{"type":"object","required":["action"],"additionalProperties":false,"properties":{'
     '"action":{"enum":["walk","sit_down"]},"parameters":{"type":"object","properties":{"x":{"type":"number","minimum":-1,'
     '"maximum":1},"step":{"type":"integer","minimum":1}},"additionalProperties":false}}}'),
    ("RobotGesture", "action", '{"type":"object","required":["gesture"],"additionalProperties":false,"properties":{'
     '"gesture":{"enum":["bow","nod"]},"repeat":{"type":"integer","minimum":1}}}'),
    ("web_search", "query", '{"type":"object","required":["query"],"properties":{"query":{"type":"string"}}}'),
    ("robot_status", "query", '{"type":"object","required":["query"],"properties":{"query":{"type":"string"}}}'),
)


def contract(spark) -> DataFrame:
    return spark.createDataFrame(list(CONTRACT), "tool string, kind string, arguments_schema string")


def task_columns():
    """(kind, instruction, name, arguments) of one event as a planning task."""
    k = F.get_json_object("props", "$.k").cast("int")
    name = F.when(F.col("event_type") == "purchase", "HumanAction").when(F.col("event_type") == "signup", "RobotGesture").when(
        F.col("event_type") == "click", "robot_status"
    ).when(F.col("event_type") == "view", "web_search")
    kind = F.when(F.col("event_type") == "error", "reply").when(F.col("event_type").isin("purchase", "signup"), "action").otherwise("query")
    x = F.when(k % 2 == 0, "0.6").otherwise("-0.6")
    arguments = (
        F.when(F.col("event_type") == "purchase", F.concat(F.lit('{"action":"walk","parameters":{"x":'), x, F.lit(',"step":'), k % 5 + 1, F.lit("}}")))
        .when(F.col("event_type") == "signup", F.when(k % 2 == 0, '{"gesture":"bow","repeat":1}').otherwise('{"gesture":"nod"}'))
        .when(F.col("event_type") == "click", F.concat(F.lit('{"query":"status '), k, F.lit('"}')))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"query":"topic '), k, F.lit('"}')))
    )
    return F.struct(
        kind.alias("kind"), F.concat(F.lit("do "), F.col("event_type"), F.lit(" "), k).alias("instruction"),
        name.alias("name"), arguments.alias("arguments"),
    )


def plan_cases(spark, sf) -> DataFrame:
    """(case_id, expected, output, forbidden_functions, mutation): four events per case; the output is the plan,
    changed by the mutation the case number names."""
    from parlance.plans.compose import task_json
    from parlance.plans.scoring import TASKS

    e = table(spark, sf, "events").withColumn("case_id", F.floor(F.col("event_id") / 4)).withColumn("task", task_columns())
    cases = e.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "task"))).alias("t"))
    cases = cases.select("case_id", F.transform("t", lambda t: t["task"]).cast(TASKS).alias("expected"))
    cases = cases.withColumn("mutation", draw_int("plan", F.col("case_id")) % 9)
    m = F.col("mutation")
    got = F.col("expected")
    bow = F.array(F.struct(
        F.lit("action").alias("kind"), F.lit("bow too").alias("instruction"), F.lit("RobotGesture").alias("name"),
        F.lit('{"gesture":"bow"}').alias("arguments"),
    )).cast(TASKS)
    call = lambda t: t["kind"] != "reply"
    changed = (
        F.when(m == 2, F.slice(got, F.lit(1), F.size(got) - 1))
        .when(m == 3, F.transform(got, lambda t: F.when(call(t), t.withField("name", F.lit("nope"))).otherwise(t)))
        .when(m == 4, F.transform(got, lambda t: F.when(t["kind"] == "query", t.withField("kind", F.lit("action"))).otherwise(t)))
        .when(m == 5, F.transform(got, lambda t: t.withField("arguments", F.replace(t["arguments"], F.lit('"x":'), F.lit('"x":-')))))
        .when(m == 6, F.concat(got, bow))
        .when(m == 7, F.reverse(got))
        .otherwise(got)
    )
    text = F.replace(task_json(changed.cast(TASKS)), F.lit('"x":--'), F.lit('"x":'))
    output = F.when(m == 1, F.substr(text, F.lit(1), F.length(text) - 1)).when(
        m == 8, F.replace(text, F.lit('"kind"'), F.lit('"extra": 1, "kind"'))
    ).otherwise(text)
    return cases.withColumn("output", output).withColumn(
        "forbidden_functions", F.when(F.col("case_id") % 2 == 0, F.array(F.lit("RobotGesture"))).otherwise(F.array().cast("array<string>"))
    ).withColumn("error", F.when(F.col("case_id") % 50 == 7, F.lit("timeout")))


def run_log(spark, sf) -> DataFrame:
    """Run-log rows from events: user = run, event = step, value = loss."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run"), F.col("event_id").alias("current_steps"),
        F.lit(1000000).cast("long").alias("total_steps"), F.col("value").alias("loss"),
    )


def choice_rows(spark, sf) -> DataFrame:
    """(vec_id, scores, answer, category): the first four vector entries as choice scores."""
    e = table(spark, sf, "embeddings")
    return e.select(
        "vec_id", F.slice("embedding", 1, 4).alias("scores"),
        F.get(F.array(*[F.lit(c) for c in "ABCD"]), F.col("label") % 4).alias("answer"),
        F.concat(F.lit("cat"), F.col("label")).alias("category"),
    )


def atoms(spark, sf) -> DataFrame:
    """Planning atoms from events: negatives are error events, their flip is the token count mod 5."""
    k = F.get_json_object("props", "$.k").cast("int")
    t = F.col("task")
    return table(spark, sf, "events").withColumn("task", task_columns()).select(
        F.col("event_id").alias("id"), F.when(t["kind"] == "reply", "negative").otherwise("positive").alias("part"),
        t["kind"].alias("kind"), t["instruction"].alias("instruction"), t["name"].alias("expected_function"),
        t["arguments"].alias("expected_params"), F.concat(F.lit("please "), t["instruction"]).alias("query"),
        F.when(t["kind"] == "reply", F.concat(F.lit("flip"), k % 5)).alias("flip"), (t["kind"] == "reply").alias("negative_sample"),
        F.concat("event_type", F.lit("_"), k % 10).alias("cell"), F.concat("event_type", F.lit("_"), k % 10).alias("topic"),
        F.coalesce(t["name"], F.lit("reply")).alias("tool"), F.concat(F.lit("v"), k).alias("value"),
    )

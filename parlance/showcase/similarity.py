"""Duplicates, similarity, novelty, contamination."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance import adapters as A
from parlance.functions.text import grams, norm_text, shape
from parlance.operators import similarity as S
from parlance.plans.openjson import canonical_json, identity
from parlance.plans.scoring import plan_signature, signature_seen
from parlance.showcase import query

EDGES = "'。.!！？?，,、；;：: ' || chr(9) || chr(10)"


def norm_sql(text: str) -> str:
    return f"trim(regexp_replace({text}, '\\s+', '', 'g'), {EDGES})"


def shape_sql(text: str) -> str:
    marks = """[\\s，。！？、,.!?;；:：~～…"''“”‘’（）()]+"""
    return f"regexp_replace(regexp_replace({text}, '{marks}', '', 'g'), '[0-9零一二两三四五六七八九十百]+', '#', 'g')"


def grams_sql(shape: str, n: int) -> str:
    return (
        f"CASE WHEN length({shape}) >= {n} THEN list_distinct(list_transform(range(1, length({shape}) - {n} + 2), lambda i: substr({shape}, i, {n}))) ELSE [{shape}] END"
    )


LINES = """l AS (SELECT doc_id * 1000000 + i - 1 AS line_id, lang, line FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE length(line) > 0)"""
CASES = """c AS (SELECT item_id * 1000000 + i - 1 AS case_id, line FROM (SELECT item_id, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM benchmark) WHERE length(line) > 0)"""


@query(f"""WITH k AS (SELECT doc_id, {norm_sql('line')} AS n FROM (SELECT line_id AS doc_id, line FROM (WITH {LINES} SELECT * FROM l)))
  SELECT min(doc_id) AS line_id, count(*) - 1 AS copies FROM k GROUP BY n""")
def keep_first(spark, sf):
    return S.dedup_first(A.lines(spark, sf).select("line_id", "line"), "line", "line_id").select("line_id", "copies")


@query(f"""SELECT md5(n) AS norm_md5, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, count(*) AS rows FROM (
  SELECT {norm_sql('text')} AS n, quality || '/' || toxic AS label FROM documents JOIN labels USING (doc_id)) GROUP BY n HAVING count(DISTINCT label) > 1
  UNION ALL SELECT md5(n), string_agg(DISTINCT source, ',' ORDER BY source), count(*) FROM (SELECT {norm_sql('text')} AS n, source FROM documents) GROUP BY n HAVING count(DISTINCT source) > 1""")
def conflicting_labels(spark, sf):
    """Texts with two quality labels, and texts held by two pools."""
    a = A.labelled_documents(spark, sf).select("text", F.concat("quality", F.lit("/"), "toxic").alias("label"))
    b = A.table(spark, sf, "documents").select("text", F.col("source").alias("label"))
    parts = [S.label_conflicts(x, "text", "label") for x in (a, b)]
    return parts[0].unionByName(parts[1]).select(
        F.md5(F.col("norm").cast("binary")).alias("norm_md5"), F.array_join("labels", ",").alias("labels"), "rows"
    )


@query(f"""SELECT sum(c - 1)::BIGINT AS duplicates_across_pools FROM (SELECT count(*) AS c FROM documents GROUP BY {norm_sql('text')})""")
def duplicates_across_pools(spark, sf):
    return S.duplicate_count(A.table(spark, sf, "documents"), "text")


@query(f"""WITH s AS (SELECT doc_id, {shape_sql('text')} AS h, {norm_sql('text')} AS n FROM documents)
  SELECT doc_id, md5(h) AS shape_md5, md5(n) AS norm_md5, len({grams_sql('h', 2)}) AS bigrams FROM s""")
def shapes_and_grams(spark, sf):
    d = A.table(spark, sf, "documents")
    return d.select(
        "doc_id", F.md5(shape(F.col("text")).cast("binary")).alias("shape_md5"), F.md5(norm_text(F.col("text")).cast("binary")).alias("norm_md5"),
        F.size(grams(F.col("text"))).cast("long").alias("bigrams"),
    )


def bits_sql(rows: str, key: str, grams: str = "g") -> str:
    """(key, bits, n): the grams of each row as bits of their number among all grams."""
    return f"""SELECT {key}, bitstring_agg(p, 0, {VOCABULARY}) AS bits, count(*) AS n FROM (SELECT {key}, unnest({grams}) AS w FROM {rows}) JOIN v USING (w) GROUP BY ALL"""


#: Most different grams of a SQL oracle.
VOCABULARY = 8191
NUMBERS = "v AS (SELECT w, row_number() OVER () - 1 AS p FROM (SELECT DISTINCT w FROM ({0})))"
RATIO = "max(bit_count(a.bits & b.bits) / (a.n + b.n - bit_count(a.bits & b.bits))::DOUBLE)"


@query(f"""WITH {LINES}, s AS (SELECT line_id, lang, {shape_sql('line')} AS h FROM l), f AS (SELECT lang, h, min(line_id) AS line_id FROM s GROUP BY ALL),
  g AS (SELECT line_id, lang, {grams_sql('h', 2)} AS g FROM f), {NUMBERS.format('SELECT unnest(g) AS w FROM g')}, b AS ({bits_sql('g', 'line_id, lang')}),
  m AS (SELECT a.line_id, {RATIO} AS best FROM b a JOIN b ON a.lang = b.lang AND b.line_id < a.line_id GROUP BY 1)
  SELECT s.line_id, CASE WHEN s.line_id <> f.line_id THEN 1 ELSE coalesce(round(best, 6), 0) END AS max_sim FROM s JOIN f USING (lang, h) LEFT JOIN m ON m.line_id = f.line_id""")
def similarity_to_earlier(spark, sf):
    """Every line of every document against all earlier lines of its language, by grams of two."""
    return S.max_sim_prior(A.lines(spark, sf), "line_id", "line", ["lang"]).select("line_id", F.round("max_sim", 6).alias("max_sim"))


def to_pool_sql(base: str, grams: str) -> str:
    return f"""WITH {LINES}, {CASES}, x AS (SELECT case_id, {grams} AS g FROM (SELECT case_id, {base} AS h FROM c)),
  y AS (SELECT h AS y, {grams} AS g FROM (SELECT DISTINCT {base} AS h FROM l)),
  {NUMBERS.format('SELECT unnest(g) AS w FROM x UNION ALL SELECT unnest(g) FROM y')}, bx AS ({bits_sql('x', 'case_id')}), b AS ({bits_sql('y', 'y')}),
  m AS (SELECT case_id, {RATIO} AS best FROM bx a, b GROUP BY 1)"""


LETTERS = "regexp_replace(lower(line), '[^\\p{L}\\p{N}]+', '', 'g')"
LETTER_PAIRS = "list_distinct(list_transform(range(1, length(h)), lambda i: substr(h, i, 2)))"


@query(f"""{to_pool_sql(LETTERS, LETTER_PAIRS)} SELECT c.case_id, coalesce(best > 0.6, false) AS near, coalesce(round(best, 6), 0) AS max_sim FROM c LEFT JOIN m USING (case_id)""")
def contamination(spark, sf):
    """Benchmark lines too close to a line of the training pool, by bigrams of lower-cased letters and digits."""
    rows = S.reject_near(A.benchmark_lines(spark, sf), A.lines(spark, sf), "case_id", "line", "line_id", "line", 0.6)
    return rows.select("case_id", "near", F.round("max_sim", 6).alias("max_sim"))


@query(f"""{to_pool_sql(shape_sql('line'), grams_sql('h', 2))} SELECT c.case_id, coalesce(round(best, 6), 0) AS max_sim FROM c LEFT JOIN m USING (case_id)""")
def similarity_to_pool(spark, sf):
    """Benchmark lines against all lines of the documents, by grams of two."""
    rows = S.max_sim_to(A.benchmark_lines(spark, sf), A.lines(spark, sf), "case_id", "line", "line_id", "line")
    return rows.select("case_id", F.round("max_sim", 6).alias("max_sim"))


@query()
def greedy_novelty(spark, sf):
    """Lines that a greedy pass over a language keeps, per threshold, by grams of two."""
    return S.greedy_novel(A.lines(spark, sf), "line_id", "line", ["lang"])


def clauses_sql(key: str, source: str) -> str:
    cut = f"""list_filter(list_transform(regexp_split_to_array(text, '[，。！？；,.!?;、\\n:：]+|然后|接着|再|and then|then|also'), lambda c: trim(c, ' 　' || chr(9) || chr(10) || chr(13))),
    lambda c: length(regexp_replace(c, '[^\\p{{L}}\\p{{N}}]+', '', 'g')) >= 2)"""
    return f"SELECT {key}, unnest(CASE WHEN len(c) > 0 THEN c ELSE [text] END) AS clause FROM (SELECT {key}, text, {cut} AS c FROM {source})"


def word_grams_sql(rows: str) -> str:
    base = "regexp_replace(lower(clause), '[^\\p{L}\\p{N}]+', '', 'g')"
    many = "list_distinct(list_transform(range(1, length(b)), lambda i: substr(b, i, 2)))"
    return f"""SELECT clause, len(g) AS n, unnest(g) AS w FROM (SELECT clause, CASE WHEN length(b) >= 2 THEN {many} WHEN length(b) = 1 THEN [b] ELSE [] END AS g
    FROM (SELECT clause, {base} AS b FROM (SELECT DISTINCT clause FROM {rows})))"""


@query(f"""WITH k AS ({clauses_sql('item_id', 'benchmark')}), v AS ({clauses_sql('doc_id', 'documents')}), xa AS ({word_grams_sql('k')}), xb AS ({word_grams_sql('v')}),
  j AS (SELECT xa.clause AS a, xb.clause AS b, any_value(xa.n) AS na, any_value(xb.n) AS nb, count(*) AS i FROM xa JOIN xb USING (w) GROUP BY 1, 2),
  m AS (SELECT a AS clause, max(i / (na + nb - i)::DOUBLE) AS best FROM j GROUP BY 1)
  SELECT item_id, min(coalesce(best, 0)) AS min_nn, round(avg(coalesce(best, 0)), 6) AS mean_nn, count(*) AS clauses FROM k LEFT JOIN m USING (clause) GROUP BY 1""")
def clause_neighbours(spark, sf):
    """Each benchmark item's clauses against all clauses of the documents."""
    rows = S.clause_nn(A.table(spark, sf, "benchmark"), A.table(spark, sf, "documents"), "item_id", "text", "doc_id", "text")
    return rows.withColumn("mean_nn", F.round("mean_nn", 6))


@query("""WITH t AS (SELECT DISTINCT text FROM documents WHERE doc_id % 2 = 0), v AS (SELECT DISTINCT text FROM documents WHERE doc_id % 2 = 1),
  a AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS w FROM benchmark WHERE item_id % 2 = 0) WHERE w <> ''),
  x AS (SELECT DISTINCT item_id, w FROM (SELECT item_id, unnest(regexp_split_to_array(text, '\\s+')) AS w FROM benchmark) WHERE w <> '')
  SELECT b.item_id, b.text IN (SELECT text FROM t) AS exact_train, b.text IN (SELECT text FROM v) AS exact_validation,
  (SELECT bool_and(w IN (SELECT w FROM a)) FROM x WHERE x.item_id = b.item_id) AS all_atoms_seen_train,
  (SELECT bool_or(w NOT IN (SELECT w FROM a)) FROM x WHERE x.item_id = b.item_id) AS has_novel_atom FROM benchmark b""")
def overlap_flags(spark, sf):
    """Benchmark items as cases, their words as atoms, half of the documents as training texts."""
    from parlance.functions.text import words

    b = A.table(spark, sf, "benchmark")
    cases = b.select("item_id", F.col("text").alias("query"), words(F.col("text")).alias("source_atom_ids"))
    d = A.table(spark, sf, "documents")
    train, val = d.where("doc_id % 2 = 0"), d.where("doc_id % 2 = 1")
    seen = b.where("item_id % 2 = 0").select(F.explode(words(F.col("text"))).alias("source_atom_id"))
    rows = S.annotate_overlap(
        cases, train.select(F.col("text").alias("instruction")), val.select(F.col("text").alias("instruction")), seen, "item_id"
    )
    return rows.select("item_id", "exact_train", "exact_validation", "all_atoms_seen_train", "has_novel_atom")


@query(f"""WITH {LINES}, {CASES}, k AS (SELECT DISTINCT line FROM l) SELECT count(*) AS total, count(*) - count(DISTINCT case_id) AS duplicate_case_ids,
  count(*) - count(DISTINCT line) AS duplicate_queries, count(*) FILTER (line IN (SELECT line FROM k)) AS exact_query_overlap,
  count(*) FILTER (line IN (SELECT line FROM k)) AS exact_expected_plan_overlap, count(*) FILTER (line IN (SELECT line FROM k)) AS exact_tool_plan_overlap,
  count(*) AS strict_pass_count, count(*) > 0 AND count(*) = count(DISTINCT case_id) AND count(*) = count(DISTINCT line) AND count(*) FILTER (line IN (SELECT line FROM k)) = 0 AS ready FROM c""")
def challenge_audit(spark, sf):
    cases = A.benchmark_lines(spark, sf).select("case_id", F.col("line").alias("query"), F.md5(F.col("line").cast("binary")).alias("plan"),
                                                F.sha1(F.col("line").cast("binary")).alias("tool_plan"), F.lit(True).alias("strict_pass"))
    corpus = A.lines(spark, sf).select(F.col("line").alias("query"), F.md5(F.col("line").cast("binary")).alias("plan"), F.sha1(F.col("line").cast("binary")).alias("tool_plan"))
    return S.audit_challenge(cases, corpus, checks=("strict_pass",))


@query("""SELECT event_id, '{"a":"' || event_type || '","b":{"k":' || (props->>'$.k') || '}}' AS canonical,
  'sha256:' || sha256('{"a":"' || event_type || '","b":{"k":' || (props->>'$.k') || '}}') AS id FROM events""")
def canonical_identity(spark, sf):
    e = A.table(spark, sf, "events").select("event_id", F.concat(F.lit('{"b": '), "props", F.lit(', "a": "'), "event_type", F.lit('"}')).alias("raw"))
    return e.select("event_id", canonical_json("raw").alias("canonical"), identity("raw").alias("id"))


SIGNATURE = """e AS (SELECT event_id // 4 AS case_id, event_id, (props->>'$.k')::INTEGER AS k, event_type FROM events),
  p AS (SELECT case_id, event_id, CASE event_type WHEN 'error' THEN 'reply' WHEN 'purchase' THEN 'HumanAction|walk|x=' || CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END
   WHEN 'signup' THEN 'RobotGesture|' || CASE WHEN k % 2 = 0 THEN 'bow' ELSE 'nod' END WHEN 'click' THEN 'robot_status|status ' || k ELSE 'web_search' END AS part FROM e),
  q AS (SELECT *, lag(part) OVER (PARTITION BY case_id ORDER BY event_id) AS before FROM p),
  g AS (SELECT case_id, string_agg(part, ';' ORDER BY event_id) FILTER (NOT (part = 'reply' AND before IS NOT DISTINCT FROM 'reply')) AS signature FROM q GROUP BY 1)"""


@query(f"""WITH {SIGNATURE} SELECT case_id, signature, (SELECT count(*) FROM g h WHERE h.signature = g.signature AND h.case_id % 2 = 0) AS signature_seen FROM g""")
def plan_signatures(spark, sf):
    """Plans by shape; the even cases stand for the training plans."""
    rows = plan_signature(A.plan_cases(spark, sf).select("case_id", F.col("expected").alias("tasks")))
    train = rows.where("case_id % 2 = 0")
    return signature_seen(rows, train).select("case_id", "signature", "signature_seen")


@query("""WITH v AS (SELECT event_id, user_id, 'k' AS name, props->>'$.k' AS value FROM events UNION ALL SELECT event_id, user_id, 'type', event_type || (event_id % 997) FROM events)
  SELECT event_id, name, value FROM v WHERE user_id % 3 <> 0 AND (name, value) NOT IN (SELECT (name, value) FROM v WHERE user_id % 3 = 0)""")
def values_unseen(spark, sf):
    """Values of two thirds of the users that the other third never has."""
    e = A.table(spark, sf, "events").select("event_id", "user_id", F.create_map(
        F.lit("k"), F.get_json_object("props", "$.k"), F.lit("type"), F.concat("event_type", (F.col("event_id") % 997).cast("string"))
    ).alias("values"))
    return S.unseen_values(e.where("user_id % 3 <> 0"), e.where("user_id % 3 = 0"), "event_id")


BIGRAMS = "CASE WHEN length({0}) >= 2 THEN list_distinct(list_transform(range(1, length({0})), lambda i: substr({0}, i, 2))) ELSE list_distinct([{0}]) END"


@query(f"""WITH t AS (SELECT conv_id, turn, regexp_replace(text, '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS s, regexp_replace(substr(text, 1, 30), '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS q FROM conversations),
  g AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, {BIGRAMS.format('s')} AS s, {BIGRAMS.format('q')} AS q FROM t),
  m AS (SELECT a.conv_id, a.i, max(len(list_intersect(a.q, b.s))) AS top, max(CASE WHEN a.i = b.i THEN len(list_intersect(a.q, b.s)) END) AS own FROM g a JOIN g b USING (conv_id) GROUP BY ALL)
  SELECT conv_id, coalesce(string_agg(i::VARCHAR, ',' ORDER BY i) FILTER (own = 0 OR top > own), '') AS bad FROM m GROUP BY 1""")
def misattributed_quotes(spark, sf):
    """The first thirty characters of each turn as its quote."""
    rows = A.dialogues(spark, sf).select(
        "conv_id", F.transform("messages", lambda m: m["content"]).alias("sources"),
        F.transform("messages", lambda m: F.substring(m["content"], 1, 30)).alias("quotes"),
    )
    return S.misattributed(rows).select("conv_id", F.array_join("bad", ",").alias("bad"))


@query(f"""SELECT source, count(*) AS valid, count(DISTINCT {shape_sql("split_part(text, chr(10), 1)")}) AS cores,
  count(DISTINCT {shape_sql('substr(text, 1, 12)')}) AS kernels, count(*) FILTER (contains(text, 'pathetic')) AS leaks FROM documents GROUP BY 1""")
def pool_diversity(spark, sf):
    d = A.table(spark, sf, "documents")
    return S.diversity(
        d, "source", F.substring_index("text", "\n", 1), F.substring("text", 1, 12), F.col("text").contains("pathetic"), "text"
    )

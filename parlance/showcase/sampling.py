"""Mixing, sampling and splitting on whole tables; draws are md5 values, so SQL can repeat them."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance import adapters as A
from parlance.operators import sampling as S
from parlance.showcase import draw_of, md5_of, query


def docs(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")


LANGS, SHARES = ("en", "fr", "de", "es"), (0.4, 0.3, 0.2, 0.1)


def by_lang(spark, sf):
    return [docs(spark, sf).where(F.col("lang") == x) for x in LANGS]


@query("SELECT lang, count(*) AS rows FROM documents GROUP BY 1")
def mix_concat(spark, sf):
    return S.mix(by_lang(spark, sf), "concat").groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))


def _interleave(strategy: str) -> str:
    own = [f"(SELECT count(*) FROM x WHERE source = {i})" for i in range(len(LANGS))]
    over = f"ceil(greatest({', '.join(f'{c} / {p} + 10 * sqrt({c}) / {p}' for c, p in zip(own, SHARES, strict=True))}))::BIGINT + 100"
    n = f"(SELECT count(*) - {len(LANGS) - 1} FROM x)" if strategy == "under" else over
    stop = {"under": "(SELECT min(e) FROM ends)", "over": "(SELECT max(e) FROM ends)", "once": "(SELECT max(e) FROM ends)"}[strategy]
    extra = "AND pick < q.size" if strategy == "once" else ""
    u = draw_of("'5'", "i")
    dealt = " ".join(f"WHEN u < {round(sum(SHARES[:i + 1]), 6)} THEN {i}" for i in range(len(LANGS) - 1))
    return f"""WITH x AS (SELECT doc_id, list_position({list(LANGS)}, lang) - 1 AS source FROM documents),
  r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS o, count(*) OVER (PARTITION BY source) AS size FROM x),
  g AS (SELECT i AS draw, CASE {dealt} ELSE {len(LANGS) - 1} END AS source FROM (SELECT i, {u} / 4294967296.0 AS u FROM (SELECT unnest(range(0, {n})) AS i))),
  p AS (SELECT draw, source, row_number() OVER (PARTITION BY source ORDER BY draw) - 1 AS pick FROM g),
  q AS (SELECT p.*, s.size FROM p JOIN (SELECT DISTINCT source, size FROM r) s USING (source)),
  ends AS (SELECT source, min(draw) AS e FROM q WHERE pick = size - 1 GROUP BY 1)
  SELECT draw, source, doc_id FROM q JOIN r USING (source) WHERE draw <= {stop} AND pick % q.size = o {extra}"""


@query(_interleave("under"))
def interleave_under(spark, sf):
    return S.mix(by_lang(spark, sf), "interleave_under", list(SHARES), 5, "doc_id").select("draw", "source", "doc_id")


@query(_interleave("over"))
def interleave_over(spark, sf):
    return S.mix(by_lang(spark, sf), "interleave_over", list(SHARES), 5, "doc_id").select("draw", "source", "doc_id")


@query(_interleave("once"))
def interleave_once(spark, sf):
    return S.mix(by_lang(spark, sf), "interleave_once", list(SHARES), 5, "doc_id").select("draw", "source", "doc_id")


RANKED = f"""r AS (SELECT doc_id, lang, source, n_chars, row_number() OVER (ORDER BY {md5_of("'1'", 'doc_id')}) - 1 AS o, count(*) OVER () AS n FROM documents)"""


@query(f"""WITH {RANKED}, w AS (SELECT i AS position, CASE WHEN i < (SELECT max(n) FROM r) THEN i ELSE {draw_of("'1:again'", 'i')} % (SELECT max(n) FROM r) END AS o
   FROM (SELECT unnest(range(0, 1500)) AS i)) SELECT position, doc_id FROM w JOIN r USING (o)""")
def fixed_count_sample(spark, sf):
    return S.sample_n(docs(spark, sf), 1500, "doc_id", 1).select("position", "doc_id")


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def truncate_rows(spark, sf):
    return S.head_n(docs(spark, sf), 100, "doc_id").select("doc_id", "lang")


@query(f"""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o, count(*) OVER () AS n FROM documents),
  w AS (SELECT i AS position, floor({draw_of("'3:weight'", 'i')} / 4294967296.0 * 700)::BIGINT AS spot FROM (SELECT unnest(range(0, 1050)) AS i)),
  z AS (SELECT position, floor({draw_of("'3:size'", 'spot')} / 4294967296.0 * (SELECT max(n) FROM r))::BIGINT AS o FROM w)
  SELECT position, doc_id FROM z JOIN r USING (o)""")
def size_and_weight(spark, sf):
    return S.reweight(docs(spark, sf), "doc_id", 700, 1.5, 3).select("position", "doc_id")


@query(f"""WITH {RANKED} SELECT doc_id, o AS ordinal FROM r""")
def shuffled_order(spark, sf):
    return S.shuffled(docs(spark, sf), "doc_id", 1).select("doc_id", "ordinal")


@query(f"""WITH {RANKED} SELECT doc_id, CASE WHEN o < ceil(n * 0.15) THEN 'validation' ELSE 'train' END AS part FROM r""")
def train_validation_split(spark, sf):
    train, val = S.split(docs(spark, sf), 0.15, "doc_id", 1)
    return train["train"].select("doc_id", F.lit("train").alias("part")).unionByName(
        val["validation"].select("doc_id", F.lit("validation").alias("part"))
    )


@query(f"""WITH k AS (SELECT doc_id, row_number() OVER (ORDER BY {md5_of("'2'", 'doc_id')}) AS o FROM documents WHERE n_chars >= 2000)
  SELECT doc_id, coalesce(o <= 50, false) AS held FROM documents LEFT JOIN k USING (doc_id)""")
def restricted_holdout(spark, sf):
    rest, held = S.holdout(docs(spark, sf), 50, F.col("n_chars") >= 2000, "doc_id", 2)
    return rest.select("doc_id", F.lit(False).alias("held")).unionByName(held.select("doc_id", F.lit(True).alias("held")))


@query(f"""WITH c AS (SELECT lang, count(*) AS rows, row_number() OVER (ORDER BY lang) - 1 AS place, count(*) OVER () AS levels FROM documents GROUP BY lang),
  q AS (SELECT *, 602 // levels + CASE WHEN place < 602 % levels THEN 1 ELSE 0 END AS quota FROM c), b AS (SELECT *, least(rows, quota) AS base FROM q),
  s AS (SELECT *, rows - base AS spare, sum(quota - base) OVER () AS short, coalesce(sum(rows - base) OVER (ORDER BY lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b),
  t AS (SELECT lang, base + greatest(0, least(spare, short - before)) AS take FROM s),
  r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {md5_of("'4'", 'doc_id')}) AS o FROM documents)
  SELECT doc_id, lang FROM r JOIN t USING (lang) WHERE o <= take""")
def stratified_quota(spark, sf):
    return S.stratified(docs(spark, sf), 602, "lang", "doc_id", 4).select("doc_id", "lang")


@query(f"""SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {md5_of("'6'", 'doc_id')}) AS o FROM documents) WHERE o <= 7""")
def capped_groups(spark, sf):
    return S.cap_per_group(docs(spark, sf), ["source"], 7, "doc_id", 6).select("doc_id", "source")


@query(f"""WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {md5_of("'8'", 'doc_id')}) - 1 AS o FROM documents),
  v AS (SELECT source, variant, row_number() OVER (PARTITION BY source ORDER BY {md5_of("'8'", 'source', 'variant')}) - 1 AS k
   FROM (SELECT DISTINCT source FROM documents), (SELECT unnest(['ability', 'later', 'teach']) AS variant))
  SELECT doc_id, variant FROM r JOIN v ON r.source = v.source AND r.o % 3 = v.k""")
def dealt_variants(spark, sf):
    return S.assign_round_robin(docs(spark, sf), "source", ["ability", "later", "teach"], "doc_id", 8).select("doc_id", "variant")


@query(f"""SELECT DISTINCT 'degree' AS slot, n_chars AS value, CASE WHEN n_chars % 15 = 0 AND n_chars <= 360 THEN 'train' ELSE
  CASE ('0x' || substr(md5('degree:' || n_chars), 1, 8))::BIGINT % 10 WHEN 8 THEN 'dev' WHEN 9 THEN 'test' ELSE 'train' END END AS part FROM documents
  UNION ALL SELECT DISTINCT 'step', length(text), CASE WHEN length(text) IN (12, 17, 23, 28) THEN 'dev' WHEN length(text) IN (13, 19, 25, 29) THEN 'test' ELSE 'train' END FROM conversations""")
def value_parts(spark, sf):
    a = docs(spark, sf).select(F.lit("degree").alias("slot"), F.col("n_chars").alias("value")).distinct()
    b = A.table(spark, sf, "conversations").select(F.lit("step").alias("slot"), F.length("text").cast("long").alias("value")).distinct()
    return S.value_split(a.unionByName(b))


@query(f"""SELECT doc_id FROM documents WHERE {draw_of("'9'", 'doc_id')} / 4294967296.0 < 0.3""")
def gated_rows(spark, sf):
    return S.gate(docs(spark, sf), 0.3, "doc_id", 9).select("doc_id")


@query(f"""WITH {RANKED} SELECT doc_id, (o % 7)::INTEGER AS shard, o // 7 AS place FROM r WHERE o < n - n % 7""")
def rank_shards(spark, sf):
    return S.shard(docs(spark, sf), 7, "doc_id", 1).select("doc_id", "shard", "place")


@query("""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o FROM documents)
  SELECT 'slice' AS kind, (o - 5) // 3 AS position, doc_id FROM r WHERE o >= 5 AND (o - 5) % 3 = 0
  UNION ALL SELECT 'list', p, doc_id FROM (VALUES (0, 9), (1, 2), (2, 9)) w(p, o) JOIN r USING (o)""")
def selected_rows(spark, sf):
    a = S.select_rows(docs(spark, sf), slice(5, None, 3), "doc_id").select(F.lit("slice").alias("kind"), "position", "doc_id")
    b = S.select_rows(docs(spark, sf), [9, 2, 9], "doc_id").select(F.lit("list").alias("kind"), "position", "doc_id")
    return a.unionByName(b)

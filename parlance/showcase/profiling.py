"""Length profiles, pool profiles, yield reports, token statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance import adapters as A
from parlance.operators import pack, profiles as P
from parlance.operators.encode import tokenize
from parlance.operators.ordered import cap_openers
from parlance.showcase import DIALOGUES, query, words_of
from parlance.showcase.encoding import TOKENS, encoded_dialogues, token_rows
from parlance.showcase.similarity import norm_sql, shape_sql

OPENER = "substr(regexp_replace({0}, '^[\\s，,。.!！?？~～…、]+', ''), 1, 2)"


@query(f"""WITH x AS (SELECT len({words_of('text')}) AS n FROM documents), k AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS r, count(*) OVER () AS c FROM x)
  SELECT count(*) AS rows, max(n) AS max, round(avg(n), 6) AS mean, count(*) FILTER (n > 500) AS over_cutoff, max(n) FILTER (r = least(c - 1, floor(c * 0.5))) AS p50,
  max(n) FILTER (r = least(c - 1, floor(c * 0.9))) AS p90, max(n) FILTER (r = least(c - 1, floor(c * 0.99))) AS p99 FROM k""")
def length_summary(spark, sf):
    docs = tokenize(A.table(spark, sf, "documents"), "text").select("doc_id", F.size("tokens").alias("n"))
    return P.length_summary(docs, "n", "doc_id", 500).withColumn("mean", F.round("mean", 6))


@query(f"""WITH d AS (SELECT source, lang, length(text) AS n, {norm_sql('text')} AS k FROM documents), c AS (SELECT source, lang, count(*) AS n FROM d GROUP BY ALL),
  r AS (SELECT source, n, row_number() OVER (PARTITION BY source ORDER BY n) - 1 AS o, count(*) OVER (PARTITION BY source) AS c FROM d)
  SELECT source, sum(n)::BIGINT AS rows, count(*) AS cells, min(n) AS cell_min, quantile_cont(n, 0.5) AS cell_median, max(n) AS cell_max,
  (SELECT count(DISTINCT k) FROM d WHERE d.source = c.source) AS unique_norm, (SELECT quantile_cont(n, 0.5) FROM d WHERE d.source = c.source) AS len_median,
  (SELECT max(n) FROM r WHERE r.source = c.source AND o = floor(0.9 * r.c)) AS len_p90 FROM c GROUP BY source""")
def pool_profile(spark, sf):
    return P.pool_profile(A.table(spark, sf, "documents"), "source", "lang", "text")


@query(f"""WITH c AS (SELECT source, {OPENER.format('text')} AS opener, count(*) AS rows FROM documents GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY rows DESC, opener) AS rank FROM c) SELECT * FROM r WHERE rank <= 6""")
def top_openers(spark, sf):
    return P.top_openers(A.table(spark, sf, "documents"), "source", "text")


@query(f"""WITH g AS (SELECT lang, unnest(CASE WHEN length(h) >= 4 THEN list_distinct(list_transform(range(1, length(h) - 2), lambda i: substr(h, i, 4))) ELSE [] END) AS gram
   FROM (SELECT lang, {shape_sql('text')} AS h FROM documents)), c AS (SELECT lang, gram, count(*) AS rows FROM g GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY rows DESC, gram) AS rank FROM c) SELECT * FROM r WHERE rank <= 8""")
def top_grams(spark, sf):
    return P.top_grams(A.table(spark, sf, "documents"), "lang", "text")


@query(f"""WITH RECURSIVE k AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i, {OPENER.format('text')} AS o FROM documents),
  r AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS doc_id, 0 AS total, MAP {{'': 0}} AS held, true AS accepted
    UNION ALL SELECT k.i, k.doc_id, CASE WHEN full_ THEN total ELSE total + 1 END,
      CASE WHEN full_ THEN held ELSE map_concat(held, MAP {{k.o: coalesce(held[k.o], 0) + 1}}) END, NOT full_
    FROM r JOIN k ON k.i = r.i + 1, LATERAL (SELECT total >= 50 AND coalesce(held[k.o], 0) >= 0.05::DOUBLE * total AS full_))
  SELECT doc_id, accepted FROM r WHERE i > 0""")
def capped_openers(spark, sf):
    """Documents in order, each accepted unless its opener already has 5 % of the accepted ones."""
    rows = cap_openers(A.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text", 0.05)
    return rows.select("doc_id", "accepted")


@query("SELECT source, lang, count(*) AS rows FROM documents GROUP BY ALL")
def label_counts(spark, sf):
    return P.label_counts(A.table(spark, sf, "documents"), "source", "lang")


@query("""WITH x AS (SELECT d.lang, d.source, quality = 1 AS good, toxic = 0 AS novel FROM documents d JOIN labels USING (doc_id)),
  y AS (SELECT 'lang' AS dimension, lang AS value, good, novel FROM x UNION ALL SELECT 'source', source, good, novel FROM x)
  SELECT dimension, value, count(*) FILTER (good) AS valid, CASE WHEN count(*) FILTER (good) > 0 THEN round(count(*) FILTER (good AND novel) / (count(*) FILTER (good))::DOUBLE, 3) ELSE 0.0 END AS novel_rate,
  round(count(*) FILTER (NOT good) / count(*)::DOUBLE, 3) AS reject_rate FROM y GROUP BY ALL""")
def yield_by_dimension(spark, sf):
    docs = A.labelled_documents(spark, sf)
    good = docs.where("quality = 1").withColumn("novel", F.col("toxic") == 0)
    return P.yield_by_dimension(good, docs.where("quality <> 1"), ["lang", "source"])


@query("""WITH r AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS v, count(*) FILTER (event_type = 'signup') AS n FROM events GROUP BY ALL),
  w AS (SELECT *, sum(v) OVER u AS valid_total, sum(n) OVER u AS novel_total, sum(CASE WHEN n >= 1 THEN 1 ELSE 0 END) OVER u AS island FROM r WINDOW u AS (PARTITION BY user_id ORDER BY day)),
  q AS (SELECT *, sum(CASE WHEN n >= 1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, island ORDER BY day) AS quiet FROM w),
  s AS (SELECT *, min(CASE WHEN quiet >= 4 THEN day END) OVER (PARTITION BY user_id) AS stop FROM q)
  SELECT user_id, day, valid_total::BIGINT AS valid_total, novel_total::BIGINT AS novel_total, quiet::BIGINT AS quiet, coalesce(day = stop, false) AS stopped FROM s""")
def growth_saturation(spark, sf):
    """Days as rounds, users as cells, sign-ups as novel rows."""
    rounds = A.table(spark, sf, "events").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("new_valid"), F.count_if(F.col("event_type") == "signup").alias("new_novel")
    )
    rows = P.saturation(rounds, 1, 4, "user_id", "day")
    return rows.select("user_id", "day", "valid_total", "novel_total", "quiet", "stopped")


@query(f"""WITH {TOKENS}, n AS (SELECT len(w) AS n, least(max(len(w)) OVER (PARTITION BY ordinal // 8), 400) AS m FROM t), x AS (SELECT sum(least(n, m))::BIGINT AS valid_tokens, sum(m)::BIGINT AS total_tokens FROM n)
  SELECT *, round(valid_tokens / total_tokens::DOUBLE, 6) AS valid_ratio, round(400 * 8 * valid_tokens / total_tokens::DOUBLE, 4) AS token_batch_size,
  round(3e-4 * sqrt(400 * 8 * valid_tokens / total_tokens::DOUBLE / 4000000), 9) AS learning_rate FROM x""")
def learning_rate_hint(spark, sf):
    from parlance.operators.encode import pad_batches

    rows = pack.with_batches(token_rows(spark, sf).drop("ordinal", "batch_id"), "doc_id", 8).withColumn("labels", F.col("input_ids"))
    out = P.lr_hint(pad_batches(rows, 400, columns=("labels",)), 400, 8)
    return out.select(
        "valid_tokens", "total_tokens", F.round("valid_ratio", 6).alias("valid_ratio"), F.round("token_batch_size", 4).alias("token_batch_size"),
        F.round("learning_rate", 9).alias("learning_rate"),
    )


@query("""SELECT 'lang' AS facet, lang AS value, count(*) AS rows FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source
  UNION ALL SELECT 'marks', mark, count(*) FROM (SELECT unnest(CASE WHEN n_chars > 2000 THEN ['any', 'long'] ELSE ['any'] END) AS mark FROM documents) GROUP BY mark""")
def composition_counts(spark, sf):
    docs = A.table(spark, sf, "documents").withColumn(
        "marks", F.when(F.col("n_chars") > 2000, F.array(F.lit("any"), F.lit("long"))).otherwise(F.array(F.lit("any")))
    )
    return P.composition(docs, ["lang", "source"], ["marks"])


@query("""WITH x AS (SELECT source AS flip, quality, CASE WHEN toxic = 1 THEN 'toxic' ELSE lang END AS reason FROM documents JOIN labels USING (doc_id)),
  n AS (SELECT flip, reason, count(*) AS n FROM x WHERE quality = 0 GROUP BY flip, reason), c AS (SELECT *, row_number() OVER (PARTITION BY flip ORDER BY n DESC, reason) AS r FROM n)
  SELECT flip, count(*) AS asked, count(*) FILTER (quality = 1) AS valid, coalesce(any_value(t.top), '') AS top_rejects
  FROM x LEFT JOIN (SELECT flip AS f, string_agg(reason || ':' || n, ', ' ORDER BY r) AS top FROM c WHERE r <= 3 GROUP BY flip) t ON t.f = x.flip GROUP BY flip""")
def reject_reasons(spark, sf):
    docs = A.labelled_documents(spark, sf).select(
        F.col("source").alias("flip"), "quality", F.when(F.col("toxic") == 1, "toxic").otherwise(F.col("lang")).alias("reason")
    )
    return P.reject_report(docs, docs.where("quality = 1"), docs.where("quality = 0"))


@query("""SELECT vec_id, round(exp(list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / len(embedding)), 6) AS perplexity FROM embeddings""")
def token_perplexity(spark, sf):
    rows = P.perplexity(A.table(spark, sf, "embeddings"), "embedding")
    return rows.select("vec_id", F.round("perplexity", 6).alias("perplexity"))


@query("""SELECT round(avg(exp(list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / len(embedding))), 6) AS mean_perplexity, count(*) AS rows FROM embeddings""")
def corpus_perplexity(spark, sf):
    out = P.mean_perplexity(P.perplexity(A.table(spark, sf, "embeddings"), "embedding"))
    return out.withColumn("mean_perplexity", F.round("mean_perplexity", 6))


@query(f"""WITH {DIALOGUES}, n AS (SELECT list_sum(list_transform(b, lambda x: len({words_of('x.content')}))) AS n FROM v WHERE good AND len(b) > 0)
  SELECT sum(n)::BIGINT AS tokens, round(sum(n) * 3.0 / 12.5 / 4, 6) AS tokens_per_second FROM n""")
def token_throughput(spark, sf):
    out = P.tokens_per_second(encoded_dialogues(spark, sf, cutoff=1_000_000), 3.0, 12.5, 4)
    return out.withColumn("tokens", F.col("tokens").cast("long")).withColumn("tokens_per_second", F.round("tokens_per_second", 6))


@query("""WITH RECURSIVE p AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
  w AS (SELECT *, 1.8 * (1 / (1 + exp(-0.05 * n)) - 0.5) AS w FROM p), f AS (SELECT user_id, event_id, i, value AS s FROM w WHERE i = 1 UNION ALL
  SELECT w.user_id, w.event_id, w.i, f.s * w.w + (1 - w.w) * w.value FROM f JOIN w ON w.user_id = f.user_id AND w.i = f.i + 1)
  SELECT f.user_id::VARCHAR AS run, event_id AS current_steps, round(s, 4) AS smoothed FROM f""")
def smoothed_loss(spark, sf):
    rows = P.ema(A.run_log(spark, sf), "run", "current_steps", "loss")
    return rows.select("run", "current_steps", F.round("smoothed", 4).alias("smoothed"))

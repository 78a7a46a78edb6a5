"""Tokens, budgets, labels, packs and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance import adapters as A
from parlance.operators import checks, encode, pack, profiles
from parlance.operators.align import turn
from parlance.showcase import DIALOGUES, hash_of, query, words_of
from parlance.showcase.preparing import PAIRS, aligned

CUTOFF = 300


def encoded_dialogues(spark, sf, **kw):
    rows = checks.drop_invalid(aligned(spark, sf), "sft")
    rows = encode.turn_pairs(rows.select("conv_id", F.concat("_prompt", "_response").alias("messages")))
    return encode.encode_sft(rows, **kw)


def token_rows(spark, sf):
    """Documents as token ids: (doc_id, input_ids, ordinal, batch_id)."""
    docs = A.table(spark, sf, "documents").select("doc_id", "text")
    rows = encode.hash_ids(encode.tokenize(docs, "text")).select("doc_id", "input_ids")
    return pack.with_batches(rows, "doc_id")


def pair_tokens(spark, sf):
    rows = A.preference_pairs(spark, sf)
    for c in ("instruction", "chosen", "rejected"):
        rows = encode.hash_ids(encode.tokenize(rows, c), out={"instruction": "prompt_ids"}.get(c, f"{c}_ids"))
    return rows.select("lang", "ordinal", "chosen_id", "rejected_id", "prompt_ids", "chosen_ids", "rejected_ids")


def pair_batches(spark, sf):
    rows = encode.encode_pairs(pair_tokens(spark, sf), CUTOFF)
    return pack.with_batches(rows.drop("ordinal"), "chosen_id", 16)


def total(column):
    return F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x)


TOKENS = f"""t AS (SELECT doc_id, {words_of('text')} AS w, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents)"""
BUDGET = """CASE WHEN {t} * 2 < {c} THEN {c} WHEN {s} * 2 < {c} THEN {c} - {s} ELSE floor({c} * ({t} / ({s} + {t})::DOUBLE))::BIGINT END"""


def budget(s: str, t: str, c: str) -> tuple[str, str]:
    """SQL of the kept (source, target) lengths."""
    target = f"least({BUDGET.format(s=s, t=t, c=c)}, {t})"
    return f"least(greatest({c} - {target}, 0), {s})", target


@query(f"""WITH {DIALOGUES}, n AS (SELECT conv_id, list_sum(list_transform(b, lambda x: len({words_of('x.content')}))) AS n FROM v WHERE good AND len(b) > 0),
  h AS (SELECT n // 50 * 50 AS length, count(*) AS rows FROM n GROUP BY 1)
  SELECT length::BIGINT AS length, rows, (sum(rows) OVER (ORDER BY length))::BIGINT AS rows_below,
  round(sum(rows) OVER (ORDER BY length) * 100.0 / sum(rows) OVER (), 6) AS percent_below FROM h""")
def dialogue_length_cdf(spark, sf):
    """Turn table to dialogues, alignment, stage filter, encoding, length distribution."""
    rows = encoded_dialogues(spark, sf, cutoff=1_000_000)
    out = profiles.length_cdf(rows, F.size("input_ids"), 50)
    return out.withColumn("length", F.col("length").cast("long")).withColumn("percent_below", F.round("percent_below", 6))


_S, _T = budget("s", "t", f"({CUTOFF} - used)")


@query(f"""WITH RECURSIVE {DIALOGUES}, p AS (SELECT conv_id, i, len({words_of('b[2 * i + 1].content')}) AS s, len({words_of('b[2 * i + 2].content')}) AS t
  FROM v, range(0, 100) r(i) WHERE good AND i < len(b) // 2),
  f AS (SELECT conv_id, -1::BIGINT AS i, 0::BIGINT AS used, 0::BIGINT AS supervised FROM p WHERE i = 0 UNION ALL
   SELECT conv_id, i, used + ks + kt, supervised + kt FROM (SELECT f.conv_id, f.i + 1 AS i, used, supervised,
     CASE WHEN used >= {CUTOFF} THEN 0 ELSE {_S} END AS ks, CASE WHEN used >= {CUTOFF} THEN 0 ELSE {_T} END AS kt
     FROM f JOIN p ON f.conv_id = p.conv_id AND p.i = f.i + 1))
  SELECT conv_id, max(used) AS tokens, max(supervised) AS supervised FROM f GROUP BY conv_id""")
def encode_sft(spark, sf):
    rows = encoded_dialogues(spark, sf, cutoff=CUTOFF)
    return rows.select(
        "conv_id", F.size("input_ids").cast("long").alias("tokens"),
        F.size(F.filter("labels", lambda x: x != -100)).cast("long").alias("supervised"),
    )


_LS, _LT = budget("s", "t", str(CUTOFF))


@query(f"""WITH {DIALOGUES}, p AS (SELECT conv_id, len({words_of('b[len(b) - 1].content')}) AS s, len({words_of('b[len(b)].content')}) AS t,
   {words_of('b[len(b)].content')} AS w FROM v WHERE good AND len(b) > 0)
  SELECT conv_id, {_LT} AS supervised, list_sum(list_transform(w[1:{_LT}], lambda x: {hash_of('x')}))::BIGINT AS label_sum FROM p""")
def encode_sft_last_turn(spark, sf):
    """History masked: only the last answer is trained, and it is budgeted first."""
    rows = encoded_dialogues(spark, sf, cutoff=CUTOFF, mask_history=True)
    trained = F.filter("labels", lambda x: x != -100)
    return rows.select("conv_id", F.size(trained).cast("long").alias("supervised"), total(trained).alias("label_sum"))


@query(f"""WITH {TOKENS} SELECT doc_id, len(w) AS tokens, coalesce(list_sum(list_transform(w, lambda x: {hash_of('x')})), 0)::BIGINT AS id_sum FROM t""")
def tokenize_words(spark, sf):
    return token_rows(spark, sf).select("doc_id", F.size("input_ids").cast("long").alias("tokens"), total("input_ids").alias("id_sum"))


@query(f"""WITH {TOKENS}, x AS (SELECT doc_id, unnest(w) AS token FROM t), f AS (SELECT token, count(*) AS n FROM x GROUP BY 1),
  k AS (SELECT token, row_number() OVER (ORDER BY md5(token)) AS id FROM f WHERE n >= 5)
  SELECT doc_id, coalesce(sum(id), 0)::BIGINT AS id_sum, count(*) - count(id) AS unknown FROM x LEFT JOIN k USING (token) GROUP BY doc_id""")
def vocabulary_ids(spark, sf):
    """Ids from a vocabulary table of words seen five times, numbered in hash order."""
    from parlance.functions.ranks import rank_by_hash

    docs = encode.tokenize(A.table(spark, sf, "documents").select("doc_id", "text"), "text").where(F.size("tokens") > 0)
    counts = docs.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")
    vocabulary = rank_by_hash(counts.withColumn("h", F.md5(F.col("token").cast("binary"))), "h", out="o").select("token", (F.col("o") + 1).alias("id"))
    rows = encode.vocab_ids(docs, vocabulary, "doc_id")
    return rows.select(
        "doc_id", total("input_ids").alias("id_sum"), F.size(F.filter("input_ids", lambda x: x == 0)).cast("long").alias("unknown")
    )


_IS, _IT = budget("s", "t", "500")


@query(f"""WITH {PAIRS}, q AS (SELECT chosen_id, rejected_id, len({words_of('chosen')}) AS s, len({words_of('rejected')}) AS t FROM p)
  SELECT chosen_id, rejected_id, {_IS} AS source_len, {_IT} AS target_len FROM q""")
def infer_seqlen(spark, sf):
    rows = pair_tokens(spark, sf).withColumn("s", F.size("chosen_ids")).withColumn("t", F.size("rejected_ids"))
    return encode.infer_seqlen(rows, "s", "t", 500).select(
        "chosen_id", "rejected_id", F.col("source_len").cast("long").alias("source_len"), F.col("target_len").cast("long").alias("target_len")
    )


@query(f"""WITH {TOKENS} SELECT doc_id, least(len(w) + 2, 200) AS tokens FROM t""")
def encode_pretrain(spark, sf):
    rows = encode.encode_pt(token_rows(spark, sf), 200, bos_id=1, eos_id=2)
    return rows.select("doc_id", F.size("input_ids").cast("long").alias("tokens"))


@query(f"""WITH {TOKENS}, x AS (SELECT ordinal // 1000 AS batch_id, unnest(w) AS token, ordinal, generate_subscripts(w, 1) AS pos FROM t),
  n AS (SELECT batch_id, token, (row_number() OVER (PARTITION BY batch_id ORDER BY ordinal, pos) - 1) // 512 AS block FROM x)
  SELECT batch_id, block, sum({hash_of('token')})::BIGINT AS id_sum FROM n GROUP BY ALL HAVING count(*) = 512""")
def pretrain_chunks(spark, sf):
    rows = pack.chunk_pt(token_rows(spark, sf), 512)
    return rows.select("batch_id", F.col("block").cast("long").alias("block"), total("input_ids").alias("id_sum"))


@query()
def pack_knapsack(spark, sf):
    rows = pack.pack(token_rows(spark, sf), 2048, "doc_id")
    return rows.groupBy("batch_id", "pack_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("input_ids")).alias("tokens"))


@query()
def pack_assembled(spark, sf):
    rows = pack.pack(token_rows(spark, sf), 2048, "doc_id").withColumn("labels", F.col("input_ids"))
    packs = pack.assemble_packs(rows, 2048, neat=True)
    return packs.select(
        "batch_id", "pack_id", F.size("input_ids").alias("tokens"), F.array_max("attention_mask").alias("members"), "right_padding_length",
    )


_PS, _PT = budget("s", "greatest(c, r)", str(CUTOFF))


@query(f"""WITH {PAIRS}, q AS (SELECT chosen_id, rejected_id, len({words_of('instruction')}) AS s, len({words_of('chosen')}) AS c, len({words_of('rejected')}) AS r FROM p)
  SELECT chosen_id, rejected_id, {_PS} + least(c, {_PT}) AS chosen_tokens, {_PS} + least(r, {_PT}) AS rejected_tokens FROM q""")
def encode_preference(spark, sf):
    rows = encode.encode_pairs(pair_tokens(spark, sf), CUTOFF)
    return rows.select(
        "chosen_id", "rejected_id", F.size("chosen_input_ids").cast("long").alias("chosen_tokens"),
        F.size("rejected_labels").cast("long").alias("rejected_tokens"),
    )


_OS, _OT = budget("s", "t", "100")
_KS, _KT = budget("s", "o", "100")


@query(f"""WITH x AS (SELECT d.doc_id, len({words_of('lang')}) AS s, len({words_of('text')}) AS t, (row_number() OVER (ORDER BY d.doc_id) - 1) // 1000 AS b
   FROM documents d JOIN labels USING (doc_id)), y AS (SELECT *, coalesce(lag(t) OVER (PARTITION BY b ORDER BY doc_id),
   last(t) OVER (PARTITION BY b ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS o FROM x)
  SELECT doc_id, {_OS} + {_OT} AS tokens, {_KS} + {_KT} AS kl_tokens FROM y""")
def encode_feedback(spark, sf):
    """The mismatched answer is the one of the row before in the batch."""
    docs = A.labelled_documents(spark, sf).select("doc_id", "lang", "text")
    rows = encode.hash_ids(encode.tokenize(docs, "lang"), out="prompt_ids")
    rows = encode.hash_ids(encode.tokenize(rows, "text"), out="response_ids").select("doc_id", "prompt_ids", "response_ids")
    rows = encode.encode_kto(pack.with_batches(rows, "doc_id"), 100)
    return rows.select("doc_id", F.size("input_ids").cast("long").alias("tokens"), F.size("kl_labels").cast("long").alias("kl_tokens"))


_US, _UT = budget("c", "r", "200")


@query(f"""WITH {PAIRS}, q AS (SELECT chosen_id, rejected_id, len({words_of('chosen')}) AS c, len({words_of('rejected')}) AS r FROM p)
  SELECT chosen_id, rejected_id, {_US} AS input_tokens, {_UT} AS label_tokens FROM q""")
def encode_generation(spark, sf):
    rows = encode.encode_prompt_only(pair_tokens(spark, sf), 200, "chosen_ids", "rejected_ids")
    return rows.select(
        "chosen_id", "rejected_id", F.size("input_ids").cast("long").alias("input_tokens"), F.size("labels").cast("long").alias("label_tokens")
    )


@query(f"""WITH {PAIRS}, q AS (SELECT chosen_id, rejected_id, len({words_of('instruction')}) AS s, len({words_of('chosen')}) AS c FROM p)
  SELECT chosen_id, rejected_id, s + c AS tokens, c AS supervised, c * 0.5 AS weight, false AS prefix_error FROM q""")
def prefix_labels(spark, sf):
    rows = pair_tokens(spark, sf).withColumn("full_ids", F.concat("prompt_ids", "chosen_ids")).withColumn("loss_weight", F.lit(0.5))
    rows = encode.label_by_prefix(rows)
    return rows.select(
        "chosen_id", "rejected_id", F.size("input_ids").cast("long").alias("tokens"),
        F.size(F.filter("labels", lambda x: x != -100)).cast("long").alias("supervised"),
        F.aggregate("loss_weights", F.lit(0.0), lambda a, x: a + x).alias("weight"), "prefix_error",
    )


@query(f"""WITH {PAIRS}, q AS (SELECT chosen_id, rejected_id, len({words_of('instruction')}) AS s, len({words_of('chosen')}) AS c, len({words_of('rejected')}) AS r FROM p),
  k AS (SELECT chosen_id, rejected_id, {_PS} + least(c, {_PT}) AS a, {_PS} + least(r, {_PT}) AS b FROM q)
  SELECT chosen_id, rejected_id, a + b AS tokens, (a + 2 * b)::BIGINT AS type_sum, ((a * (a + 1) + b * (b + 1)) // 2)::BIGINT AS position_sum FROM k""")
def preference_rows(spark, sf):
    rows = encode.encode_pairs(pair_tokens(spark, sf), CUTOFF).drop("chosen_ids", "rejected_ids")
    rows = rows.withColumn("pair", F.struct("chosen_id", "rejected_id"))
    rows = encode.concat_pair(rows)
    return rows.select(
        "pair.*", F.size("input_ids").cast("long").alias("tokens"), total("token_type_ids").alias("type_sum"), total("position_ids").alias("position_sum")
    )


@query(f"""WITH {TOKENS}, n AS (SELECT doc_id, len(w) AS n, least(max(len(w)) OVER (PARTITION BY ordinal // 8), 400) AS m FROM t)
  SELECT doc_id, m AS padded, greatest(m - n, 0) AS gap FROM n""")
def padded_batches(spark, sf):
    rows = pack.with_batches(token_rows(spark, sf).drop("ordinal", "batch_id"), "doc_id", 8)
    rows = rows.withColumn("labels", F.col("input_ids")).withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
    rows = encode.pad_batches(rows, 400)
    return rows.select(
        "doc_id", F.size("labels").cast("long").alias("padded"), F.size(F.filter("labels", lambda x: x == -100)).cast("long").alias("gap")
    )


@query(f"""WITH RECURSIVE {TOKENS}, n AS (SELECT ordinal, least(len(w), 1024) AS n FROM t),
  r AS (SELECT 0 AS i, 0 AS b, n AS m, 1 AS u FROM n WHERE ordinal = 0
    UNION ALL SELECT i + 1, CASE WHEN greatest(m, n) * (u + 1) > 4096 THEN b + 1 ELSE b END,
      CASE WHEN greatest(m, n) * (u + 1) > 4096 THEN n ELSE greatest(m, n) END, CASE WHEN greatest(m, n) * (u + 1) > 4096 THEN 1 ELSE u + 1 END
    FROM r JOIN n ON ordinal = i + 1)
  SELECT b AS micro_batch, count(*) AS rows, max(m) AS longest, b < (SELECT max(b) FROM r) OR max(m) * max(u) >= 4096 AS complete FROM r GROUP BY b""")
def padded_budget_batches(spark, sf):
    """Batches by padded size over the whole table, none restarted."""
    rows = pack.dynamic_batches(token_rows(spark, sf), 1024, 4, "doc_id")
    return rows.groupBy("micro_batch", "complete").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.least(F.size("input_ids"), F.lit(1024))).alias("longest")
    )


@query(f"""WITH RECURSIVE {TOKENS}, n AS (SELECT ordinal, least(len(w), 1024) AS n FROM t),
  r AS (SELECT 0 AS i, 0 AS b, n AS s, n FROM n WHERE ordinal = 0
    UNION ALL SELECT i + 1, CASE WHEN s + n.n > 4096 THEN b + 1 ELSE b END, CASE WHEN s + n.n > 4096 THEN n.n ELSE s + n.n END, n.n
    FROM r JOIN n ON ordinal = i + 1)
  SELECT b AS micro_batch, count(*) AS rows, sum(n)::BIGINT AS tokens, b < (SELECT max(b) FROM r) AS complete FROM r GROUP BY b""")
def summed_budget_batches(spark, sf):
    """Batches by summed size over the whole table, none restarted."""
    rows = pack.token_batches(token_rows(spark, sf), 1024, 4, "doc_id")
    return rows.groupBy("micro_batch", "complete").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.least(F.size("input_ids"), F.lit(1024))).alias("tokens")
    )


@query(f"""WITH {TOKENS}, n AS (SELECT ordinal // 8 AS batch_id, doc_id, least(len(w), 400) AS n FROM t WHERE len(w) > 0)
  SELECT batch_id, sum(n)::BIGINT AS tokens, (count(*) - max(CASE WHEN doc_id % 8 = 0 THEN 1 ELSE 0 END))::BIGINT AS masked, sum(n * (n - 1) // 2)::BIGINT AS position_sum FROM n GROUP BY 1""")
def joined_batches(spark, sf):
    rows = pack.with_batches(token_rows(spark, sf).drop("ordinal", "batch_id"), "doc_id", 8).withColumn("labels", F.col("input_ids"))
    rows = pack.concat_batches(rows, 400)
    return rows.select(
        "batch_id", F.size("input_ids").cast("long").alias("tokens"),
        F.size(F.filter("labels", lambda x: x == -100)).cast("long").alias("masked"), total("position_ids").alias("position_sum"),
    )


@query(f"""WITH {PAIRS}, n AS (SELECT chosen_id, (row_number() OVER (ORDER BY chosen_id) - 1) AS o FROM p), b AS (SELECT *, o // 16 AS batch_id, count(*) OVER (PARTITION BY o // 16) AS c FROM n)
  SELECT batch_id, chosen_id, 0 AS side, o % 16 AS position FROM b UNION ALL SELECT batch_id, chosen_id, 1, c + o % 16 FROM b""")
def stacked_pairs(spark, sf):
    rows = pair_batches(spark, sf).drop("rejected_id", "chosen_ids", "rejected_ids").withColumnRenamed("chosen_id", "pair_id")
    rows = encode.stack_pairs(rows)
    return rows.select("batch_id", F.col("pair_id").alias("chosen_id"), "side", F.col("position").cast("long").alias("position"))

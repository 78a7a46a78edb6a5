"""The registered queries of this package, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parlance.llm import audit, embeddings, exactdup, extraction, linedup, merkle, mixing, packing, personal, simhash, tokencount, toxicity, warc
from parlance.llm.tables import table


def op1_simhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("clauses")


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokencount.token_counts(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, the text without repeated lines, n_lines, n_dropped."""
    return linedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), equal_from=1)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.copies(table(spark, folder, "documents")).drop("copies")


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.main_text(table(spark, folder, "pages"))


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdup.exact_duplicates(table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified_leaves(table(spark, folder, "documents"))


def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal.span_digests(personal.personal_spans(table(spark, folder, "documents")))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def merkle_sql(depth: int = 8) -> str:
    """The same digests level by level, for up to 8^depth leaves of a language and 8^2 languages."""

    def framed(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, start: str, levels: int) -> list[str]:
        """Nodes (g, i, h, n) of each level, and their runs (g, p, hs, n)."""
        out = [f"{name}0 AS ({start})"]
        for k in range(levels):
            out.append(f"{name}r{k} AS (SELECT g, i // 8 AS p, list(h ORDER BY i) AS hs, any_value(n) AS n FROM {name}{k} GROUP BY ALL)")
            out.append(f"""{name}{k + 1} AS (SELECT g, p AS i, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h,
  (n + 7) // 8 AS n FROM {name}r{k})""")
        return out

    def climb(name: str, rows: str, place: str, group: str, levels: int) -> list[str]:
        """Rows with the siblings added to proof, and f folded, level by level."""
        out, last = [], rows
        for k in range(levels):
            at = f"({place} // {8 ** k} % 8)"
            sides = [f"array_to_string(hs[:{at}], '')", f"array_to_string(hs[{at} + 2:], '')"]
            out.append(f"""{name}c{k} AS (SELECT x.* EXCLUDE (proof, f), proof || CASE WHEN n > 1 THEN {sides[0]} || {sides[1]} ELSE '' END AS proof,
  CASE WHEN n > 1 THEN sha256({sides[0]} || f || {sides[1]}) ELSE f END AS f
  FROM {last} x JOIN {name}r{k} r ON r.g = {group} AND r.p = {place} // {8 ** (k + 1)})""")
            last = f"{name}c{k}"
        return out

    bits = "list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    crc = f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {bits}), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"""d AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS gg, {leaf('text')} AS leaf,
  CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS f FROM documents)""",
        "e AS (SELECT *, row_number() OVER (PARTITION BY gg ORDER BY doc_id) - 1 AS ii, '' AS proof FROM d)",
        *tree("t", "SELECT gg AS g, ii AS i, leaf AS h, count(*) OVER (PARTITION BY gg) AS n FROM e", depth),
        *tree("u", f"SELECT 0 AS g, g AS i, h, count(*) OVER () AS n FROM t{depth}", 2),
        *climb("t", "e", "ii", "gg", depth),
        *climb("u", f"tc{depth - 1}", "gg", "0", 2),
    ]
    return "WITH " + ", ".join(parts) + f""" SELECT doc_id, leaf, t.h AS subroot, u.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = u.h AS verified
  FROM uc1 JOIN t{depth} t ON t.g = gg JOIN u2 u ON true"""


QUERIES = {f.__name__: f for f in (
    op1_simhash_neardup, op2_toxicity, op3_token_counts, op4_packing, op5_embedding_neardup, op6_warc, op7_line_dedup,
    op8_mixing, op9_main_text, op10_exact_dedup, op11_merkle_manifest, op12_personal_data, op13_filter_audit,
)}

ORACLES = {
    "op13_filter_audit": """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), m AS (
  SELECT doc_id, part, (len(w) < 200)::INT AS a, (100 * len(list_distinct(w)) < 50 * len(w))::INT AS b,
         (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT AS c,
         regexp_matches(t, '[#$%&*|]')::INT AS d, (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS e FROM d
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), k AS (
  SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f), o AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order FROM x p JOIN x q ON q.f <> p.f JOIN x r ON r.f NOT IN (p.f, q.f)
  JOIN x s ON s.f NOT IN (p.f, q.f, r.f) JOIN x t ON t.f NOT IN (p.f, q.f, r.f, s.f)
), z AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, n, good, toxic, fails[ascii(f) - 64] = 1 AS now,
         len(list_filter(range(1, step), lambda i: fails[ascii(substr(filter_order, i, 1)) - 64] = 1)) > 0 AS before,
         list_sum(fails) = 1 AS one
  FROM k, o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT now AND NOT before), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (now AND NOT before), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (now AND before), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (now AND one), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (now AND NOT before), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (now AND NOT before), 0)::BIGINT AS toxic_lost FROM z GROUP BY ALL
)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r""",
    "op11_merkle_manifest": merkle_sql(),
    "op5_embedding_neardup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), g AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), p AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    AND list_cosine_similarity(a.e, b.e) >= 0.95
), r AS (
  SELECT vec_id AS node, vec_id AS low FROM v UNION SELECT r.node, p.y FROM r JOIN p ON p.x = r.low
)
SELECT v.vec_id, (SELECT count(*) FROM p WHERE p.x = v.vec_id) AS n_links, min(r.low) AS component_id,
       v.vec_id = min(r.low) AS kept
FROM v JOIN r ON r.node = v.vec_id GROUP BY v.vec_id""",
    "op6_warc": """
WITH d AS (
  SELECT page_id, coalesce(strlen(html), 0) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)""",
    "op10_exact_dedup": """
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""",
}

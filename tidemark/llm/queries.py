"""The operators over the tables of a folder: one query each, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, chosen_path, embeddings, filters_audit, gif, lm, mixing, packing, pii, quality, toxicity, url_rules
from .common import remainder, stage, table

#: The rules of op5 (host, path, action).
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.with_score(docs.select("doc_id", "text"), quality.fit(docs, table(spark, sf_dir, "labels")))
    held = remainder("doc_id", quality.FOLDS) == quality.HELD_OUT
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.describe(gif.store_text(table(spark, sf_dir, "documents")))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = stage(pii.search(docs).drop("text"), "pii-found")
    return pii.select(found, pii.fit_found(found)).select("doc_id", *(c.alias(n) for n, c in pii.digest().items()))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    records = chat.conversations_as_records(rows)
    return chat.digests(chat.format_records(records, "conv_id", "record"), "conv_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.with_score(docs.select("doc_id", "text"), toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held = remainder("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_embeddings, op2_quality, op3_lm, op4_media, op5_url_rules, op6_pii, op7_mixing, op8_chat, op9_packing, op10_jaccard, op11_toxicity, op12_filter_audit, op13_alignment)}

#: Components of ``links`` (a, b both ways) over ``nodes`` (n): the smallest node that links reach.
_REACH = """
reach(n, c) AS (
  SELECT n, n FROM nodes
  UNION
  SELECT reach.n, links.b FROM reach JOIN links ON links.a = reach.c),
least AS (SELECT n, min(c) AS c FROM reach GROUP BY n)"""

ORACLE_SQL: dict[str, str] = {
    "op1_embeddings": f"""
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
nodes(n) AS (SELECT vec_id FROM embeddings),{_REACH}
SELECT n AS vec_id, (SELECT count(*) FROM links WHERE a = n) AS n_links, c AS component_id, n = c AS kept FROM least
""",
    "op10_jaccard": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 10 * k >= 8 * (x.n + y.n - k)),
nodes(n) AS (SELECT doc_id FROM documents),{_REACH},
exact AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY g) AS copy_id FROM (SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS g FROM sets GROUP BY doc_id))
SELECT n AS doc_id, c AS class_id, (SELECT count(*) FROM links WHERE a = n) AS n_links, coalesce(copy_id, n) AS copy_id, n = c AS kept FROM least LEFT JOIN exact ON n = exact.doc_id
""",
    "op5_url_rules": r"""
WITH parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(h, p, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
hits AS (
  SELECT page_id, host, path, arg_max(struct_pack(r := h || p, a := action), length(h || p)) AS best
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY ALL)
SELECT page_id, host, path, best.r AS rule, coalesce(best.a, 'allow') AS verdict FROM hits
""",
    "op8_chat": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
sized AS (
  SELECT *, length(role) + length(text) + 15 + length(regexp_replace(role || text, '[^\\#<:]', '', 'g')) AS size FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op12_filter_audit": r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN words.doc_id > min(words.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS mask
  FROM words LEFT JOIN marks ON marks.doc_id = words.doc_id),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l)
  JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)),
steps AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, n, good, toxic, mask,
         length(translate(mask, substr(filter_order, step, 5), '')) > 0 AS gone
  FROM counts, orders, (SELECT unnest(range(1, 6)) AS step)),
per AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, f,
         sum(CASE WHEN NOT gone AND NOT contains(mask, f) THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND contains(mask, f) THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND contains(mask, f) THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND contains(mask, f) THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND contains(mask, f) THEN toxic ELSE 0 END) AS toxic_lost
  FROM steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM per
""",
}

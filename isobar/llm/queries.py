"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, bpe, collocations, hard_negatives, line_dedup, mixing, ngram_join, simhash, suffix_dedup, tool_calls, \
    topk_search, toxicity, url_filter
from .common import table

# The rules of the url query, as (verdict, host, path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
             ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def vocabulary_path() -> str:
    """The installed byte-level BPE vocabulary; the path is a parameter of the operator."""
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


# The tools of the derived calls.
TOOLS = {"search": {"query": ("string", True), "limit": ("integer", False)},
         "count": {"text": ("string", True), "words": ("integer", True)},
         "note": {"done": ("boolean", True), "text": ("string", True)}}


def tool_messages(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from the turns: every assistant turn makes a call that
    needs the one two turns before, every later user turn is the result of the turn before it."""
    t = conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL").withColumn("n", F.length("text"))
    head = F.regexp_extract("text", r"^[A-Za-z]*", 0)
    kind = F.expr("pmod(turn + conv_id, 4)")
    name = F.when(kind == 0, "search").when(kind == 1, "count").when(kind == 2, "note").otherwise("lookup")
    faulty = F.col("n") % 11 == 0
    args = (F.when(F.col("n") % 13 == 0, F.lit("[1,"))
            .when(kind == 0, F.concat(F.lit('{"query": "'), head, F.lit('", "limit": '),
                                      F.when(faulty, F.lit('"x"')).otherwise(F.col("n").cast("string")), F.lit("}")))
            .when(kind == 1, F.concat(F.lit('{"words": '), F.col("n").cast("string"),
                                      F.when(faulty, F.lit("")).otherwise(F.concat(F.lit(', "text": "'), head, F.lit('"'))),
                                      F.lit("}")))
            .when(kind == 2, F.concat(F.lit('{"text": "'), head, F.lit('", "done": true'),
                                      F.when(faulty, F.lit(', "extra": 1')).otherwise(F.lit("")), F.lit("}")))
            .otherwise(F.lit("{}")))
    call_id = F.concat(F.lit("call-"), F.col("turn").cast("string"))
    calls = t.filter("role = 'assistant'").select(
        "conv_id", "turn", call_id.alias("call_id"), name.alias("name"), args.alias("arguments"),
        F.concat(F.lit("call-"), (F.col("turn") - 2).cast("string")).alias("after"))
    results = t.filter("role = 'user' AND turn > 0").select(
        "conv_id", "turn", F.concat(F.lit("call-"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        F.concat(F.lit("chars "), F.col("n").cast("string")).alias("content"))
    return calls, results


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_messages(table(spark, sf_dir, "conversations"))
    return tool_calls.link_calls(calls, results, TOOLS)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(table(spark, sf_dir, "documents"), vocabulary_path())


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_digest(table(spark, sf_dir, "documents"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_digest(table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # fixed rule: every seventh row counts as of the next label
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 50 == 0)


QUERIES = {q.__name__: q for q in (op1_mix_sources, op2_toxicity, op3_topk, op4_url_filter, op5_tool_calls, op6_bpe, op7_ngram_join,
                               op8_suffix_dedup, op9_ann, op10_line_dedup, op11_simhash, op12_collocations,
                               op13_hard_negatives)}


def _rules_sql() -> str:
    return ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)


ORACLES = {
    "op5_tool_calls": """
WITH RECURSIVE t AS (
  SELECT *, length(text) AS n, regexp_extract(text, '^[A-Za-z]*') AS head, (turn + conv_id) % 4 AS kind
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
calls AS (
  SELECT conv_id, turn, 'call-' || turn AS call_id, 'call-' || (turn - 2) AS after, kind, n % 13 = 0 AS broken,
         n % 11 = 0 AS faulty, ['search', 'count', 'note', 'lookup'][kind + 1] AS name,
         CASE WHEN n % 13 = 0 THEN NULL
              WHEN kind = 0 THEN '{"limit":' || CASE WHEN n % 11 = 0 THEN '"x"' ELSE CAST(n AS VARCHAR) END
                                 || ',"query":"' || head || '"}'
              WHEN kind = 1 THEN '{' || CASE WHEN n % 11 = 0 THEN '' ELSE '"text":"' || head || '",' END
                                 || '"words":' || n || '}'
              WHEN kind = 2 THEN '{"done":true,' || CASE WHEN n % 11 = 0 THEN '"extra":1,' ELSE '' END
                                 || '"text":"' || head || '"}'
              ELSE '{}' END AS args
  FROM t WHERE role = 'assistant'),
lv AS (
  SELECT conv_id, call_id, 1 AS level FROM calls c
  WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.after)
  UNION ALL
  SELECT c.conv_id, c.call_id, lv.level + 1 FROM calls c JOIN lv ON lv.conv_id = c.conv_id AND lv.call_id = c.after),
res AS (
  SELECT conv_id, turn, 'call-' || (turn - 1) AS call_id, 'chars ' || n AS content
  FROM t WHERE role = 'user' AND turn > 0)
SELECT conv_id, call_id, CAST(lv.level AS BIGINT) AS level,
  CASE WHEN c.turn IS NULL THEN 'orphan' WHEN kind = 3 THEN 'unknown_tool' WHEN broken THEN 'bad_json'
       WHEN faulty AND kind = 1 THEN 'missing_field' WHEN faulty AND kind = 2 THEN 'unknown_field'
       WHEN faulty THEN 'bad_type' WHEN r.turn IS NULL THEN 'missing_result' ELSE 'ok' END AS status,
  CASE WHEN c.turn IS NULL THEN 0 ELSE 1 END AS calls, CASE WHEN r.turn IS NULL THEN 0 ELSE 1 END AS results,
  '{' || CASE WHEN args IS NULL THEN '' ELSE '"arguments":' || args || ',' END || '"id":"' || call_id || '"'
      || CASE WHEN name IS NULL THEN '' ELSE ',"name":"' || name || '"' END
      || CASE WHEN content IS NULL THEN '' ELSE ',"result":"' || content || '"' END || '}' AS json
FROM calls c FULL JOIN res r USING (conv_id, call_id) LEFT JOIN lv USING (conv_id, call_id)
""",
    "op1_mix_sources": mixing.ORACLE,
    "op7_ngram_join": ngram_join.ORACLE,
    "op8_suffix_dedup": suffix_dedup.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
    "op3_topk": """
WITH terms AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(
           CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
  FROM terms q JOIN terms d ON q.vec_id % 100 = 0 AND d.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 10
""",
    "op4_url_filter": f"""
WITH parts AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
         row_number() OVER () AS rid
  FROM pages),
rules(verdict, rhost, rpath) AS (VALUES {_rules_sql()}),
fits AS (
  SELECT p.rid, rhost || rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.rid ORDER BY length(rhost || rpath) DESC) AS k
  FROM parts p JOIN rules r
    ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.rid = f.rid AND f.k = 1
""",
}

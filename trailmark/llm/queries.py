"""Driver queries of the corpus operators: thin calls with production
parameters over whole tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    conversations,
    embedding_dedup,
    importance,
    licenses,
    neighbours,
    packing,
    pii,
    simhash,
    token_counts,
    topk,
    toxicity,
    urls,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.encode_decode(table(spark, sf_dir, "documents"))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    found = topk.top_k(vectors, vectors.where("id % 50 = 0"), k=5)
    return found.withColumnRenamed("id", "vec_id")


URL_RULES = [
    urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"), urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/"),
]


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), across_lines=True)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = neighbours.usable_vectors(table(spark, sf_dir, "embeddings"))
    found = neighbours.nearest(vectors, vectors.where("id % 20 = 0"), k=20)
    return found.withColumnRenamed("id", "vec_id")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(conversations.rows_of(
        table(spark, sf_dir, "conversations"), code=conversations.damage_code()))
    found = conversations.with_digest(rows, conversations.analyse(rows))
    return found.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                        "audit", "repaired_sha256")


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_packing, op3_simhash, op4_toxicity, op5_pii, op6_topk, op7_urls, op8_licenses,
    op9_token_counts, op10_embedding_dedup, op11_importance,
    op12_neighbours, op13_conversations)}

# -- DuckDB SQL -----------------------------------------------------------------

_VECTORS = """
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _topk_sql() -> str:
    return f"""
        WITH u AS ({_VECTORS}),
        w AS (SELECT vec_id, list_transform(v, lambda x: floor(256 * x)) AS v FROM u WHERE vec_id IS NOT NULL),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
              FROM w q JOIN w c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def _embedding_dedup_sql() -> str:
    """Exact for tables of at most ``LEAF`` classes, which the operator compares whole."""
    return f"""
        WITH RECURSIVE u AS ({_VECTORS}),
        n AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS n FROM u),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
              AND a.n > 0 AND b.n > 0 AND isfinite(a.n) AND isfinite(b.n)
              AND list_inner_product(a.v, b.v) / (a.n * b.n) >= 0.95),
        r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS b FROM r GROUP BY a),
        k AS (SELECT a, count(*) AS links FROM l GROUP BY a)
        SELECT vec_id, coalesce(links, 0) AS n_links, least(vec_id, coalesce(c.b, vec_id)) AS component_id,
               vec_id = component_id AS kept
        FROM embeddings e LEFT JOIN c ON c.a = vec_id LEFT JOIN k ON k.a = vec_id"""


def _urls_sql() -> str:
    rules = ", ".join(f"('{r.text}', '{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)
    quoted = lambda pattern: pattern.replace("'", "''")
    tag = lambda t, u: f"regexp_extract(regexp_extract(shown, '{quoted(t)}'), '{quoted(u)}', 1)"
    rest = "CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    host = "translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = f"""{host} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                {host} || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS key"""
    return f"""
        WITH RECURSIVE rules AS (SELECT * FROM (VALUES {rules}) AS t(rule, verdict, h, p)),
        found AS (SELECT url AS source, unnest([{tag(urls.CANONICAL_TAG, urls.HREF)},
                         {tag(urls.REFRESH_TAG, urls.REFRESH_URL)}]) AS t
                  FROM (SELECT url, regexp_replace(html, '{quoted(urls.COMMENT)}', '', 'g') AS shown FROM pages)
                  WHERE url LIKE '%://%'),
        links AS (SELECT source, CASE WHEN t LIKE '%://%' THEN t
                         WHEN t LIKE '//%' THEN regexp_extract(source, '^[^:/?#]*:') || t
                         WHEN t LIKE '/%' THEN regexp_extract(source, '^[^:/?#]*://[^/?#]*') || t END AS target FROM found),
        every AS (SELECT DISTINCT coalesce(url, '') AS url FROM (
                    SELECT url FROM pages UNION ALL SELECT target FROM links WHERE target IS NOT NULL)),
        nodes AS (SELECT url, {parts} FROM (SELECT url, {rest} AS rest FROM every)),
        judged AS (SELECT url, any_value(host) AS host, any_value(path) AS path, any_value(key) AS key,
                          arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
                   FROM nodes LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
                   GROUP BY url),
        edges AS (SELECT a.key AS a, b.key AS b FROM links JOIN judged a ON a.url = source JOIN judged b ON b.url = target
                  WHERE a.key <> '' AND b.key <> ''
                  UNION SELECT b.key, a.key FROM links JOIN judged a ON a.url = source JOIN judged b ON b.url = target
                  WHERE a.key <> '' AND b.key <> ''),
        hit AS (SELECT DISTINCT key FROM judged JOIN edges ON key = a WHERE verdict = 'block'
                UNION SELECT b FROM hit JOIN edges ON key = a)
        SELECT page_id, host, path, rule,
               coalesce(verdict, CASE WHEN key IN (SELECT key FROM hit) THEN 'block' ELSE 'allow' END) AS verdict
        FROM pages JOIN judged ON coalesce(pages.url, '') = judged.url"""


def _licenses_sql() -> str:
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    phrases = ", ".join(f"({p.split()}, '{x}')" for p, x in licenses.PHRASES.items())
    templates = ", ".join(f"({sorted({*t.split()})}, '{x}')" for t, x in licenses.TEMPLATES.items())
    half = licenses.WINDOW // 2
    return f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS row,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
        w AS (SELECT doc_id, row, low, {words.format('low')} AS words FROM d),
        p AS (SELECT * FROM (VALUES {phrases}) AS t(phrase, label)),
        hits AS (SELECT row, label, unnest(list_filter(range(len(words)),
                        lambda i: list_slice(words, i + 1, i + len(phrase)) = phrase)) AS place FROM w, p),
        base AS (SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
                        list_sort(list(DISTINCT label)) AS labels FROM hits GROUP BY row),
        lines AS (SELECT row, {words.format('line')} AS words FROM (SELECT row, unnest(string_split(low, chr(10))) AS line FROM d)),
        blocks AS (SELECT row, list_slice(words, s + 1, s + {licenses.WINDOW}) AS block FROM (
                    SELECT row, words, unnest(range(0, greatest(len(words) - {half}, 1), {half})) AS s FROM lines)),
        t AS (SELECT * FROM (VALUES {templates}) AS t(own, label)),
        shares AS (SELECT row, label, len(list_intersect(own, block)) / len(own) AS share FROM blocks, t
                   WHERE list_has_any(own, block)),
        method AS (SELECT row, list(DISTINCT label) AS labels, max(share) AS share FROM shares
                   WHERE share >= {licenses.CONTAINMENT} GROUP BY row)
        SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(array_to_string(base.labels, ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []),
                   coalesce(method.labels, [])))), ','), '') AS labels,
               greatest(coalesce(share, 0.0), CASE WHEN n_base > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score
        FROM w LEFT JOIN base USING (row) LEFT JOIN method USING (row)"""


ORACLE_SQL: dict[str, str] = {
    "op6_topk": _topk_sql(), "op7_urls": _urls_sql(), "op8_licenses": _licenses_sql(),
    "op10_embedding_dedup": _embedding_dedup_sql()}

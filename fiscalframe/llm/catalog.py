"""Registered queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalframe.llm import (
    alignment,
    decontaminate,
    exact_dedup,
    language_id,
    line_dedup,
    lsh_forest,
    mixing,
    phrases,
    pivot_topk,
    sharding,
    surrogates,
    url_filter,
    warc,
)
from fiscalframe.llm.shared import table

#: The rules of the url query: host/path and verdict.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

#: For these queries over invented data only; a real key is a secret.
SURROGATE_KEY = b"key of the example tables"


def topk_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.pivot_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    return surrogates.pseudonymized(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def judged_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.kept_lines(table(spark, sf_dir, "documents"))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per region of a document that is a benchmark item; clean documents have none."""
    return decontaminate.leaked_regions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).drop("payload", "url")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from three quarters of the documents, predicted for all."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    marked = documents.withColumn("held_out", held_out)
    model = language_id.fit(marked.filter(~F.col("held_out")))
    return language_id.predict(marked, model).select("doc_id", "held_out", "lang_pred", "score")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The half with the lower ids is the history, the other half and rows without id are looked up in it."""
    documents = table(spark, sf_dir, "documents")
    middle = documents.agg((F.floor(F.min("doc_id") / 2) + F.floor(F.max("doc_id") / 2)).cast("long")).scalar()
    return exact_dedup.grouped(documents, F.col("doc_id") <= middle)


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_figures(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_topk_pivots": topk_pivots,
    "op2_surrogates": personal_data,
    "op3_source_mix": source_mix,
    "op4_url_filter": judged_urls,
    "op5_line_dedup": repeated_lines,
    "op6_benchmark_leaks": benchmark_leaks,
    "op7_warc": warc_archives,
    "op8_languages": languages,
    "op9_near_duplicates": near_duplicates,
    "op10_shards": shards,
    "op11_collocations": collocations,
    "op12_exact_dedup": exact_copies,
    "op13_token_alignment": token_alignment,
}

ORACLES = {
    "op1_topk_pivots": """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 10""",
    "op3_source_mix": """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS hashed FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sized GROUP BY source),
stepped AS (
  SELECT *, 3 * source_size AS stop,
         row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS place,
         sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM sources),
level AS (
  SELECT CAST(arg_min(total - held, place) AS DOUBLE) / CAST(arg_min(open_weight, place) AS DOUBLE) AS l
  FROM stepped WHERE stop * open_weight >= weight * (total - held)),
targets AS (
  SELECT source, source_size,
         CASE WHEN CAST(weight AS DOUBLE) * l > stop THEN CAST(stop AS DOUBLE) ELSE CAST(weight AS DOUBLE) * l END AS target
  FROM stepped, level),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         CAST(CAST('0x' || substr(hashed, 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
taken AS (
  SELECT *, CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM rated)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM taken""",
    "op4_url_filter": """
WITH split AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
ruled AS (
  SELECT *, CASE
    WHEN '.' || host LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN '.' || host LIKE '%.com' AND starts_with(path, '/') THEN 'com/'
    WHEN '.' || host LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN '.' || host LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/' END AS rule FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled""",
    "op7_warc": """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
  SELECT *, list_aggregate([lpad(bin(CAST('0x' || substr(hex, i, 1) AS INTEGER)), 4, '0') FOR i IN range(1, 41)], 'string_agg', '') AS b,
         max(page_id) OVER (PARTITION BY hex) AS latest FROM p)
SELECT page_id, payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(16 * substr(b, 5 * i + 1, 1)::INT + 8 * substr(b, 5 * i + 2, 1)::INT + 4 * substr(b, 5 * i + 3, 1)::INT
              + 2 * substr(b, 5 * i + 4, 1)::INT + substr(b, 5 * i + 5, 1)::INT + 1 AS INTEGER), 1) FOR i IN range(0, 32)], 'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM latest THEN latest END AS refers_to,
       CAST(NULL AS VARCHAR) AS error
FROM bits""",
    "op9_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
  FROM words, (VALUES (1), (2), (3), (4)) AS lengths(m)),
counted AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE m = 1 GROUP BY 1),
often AS (SELECT * FROM counted WHERE f >= 30),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM often WHERE m >= 2),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, first.f AS l, rest.f AS r, (2000000 * CAST(c.f AS HUGEINT)) // (first.f + rest.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN often first ON first.lang = c.lang AND first.phrase = array_to_string(c.w[1:k], ' ')
  JOIN often rest ON rest.lang = c.lang AND rest.phrase = array_to_string(c.w[k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covers AS (
  SELECT lang, inside, max(f) AS longer
  FROM (SELECT lang, f, unnest([array_to_string(w[1:m - 1], ' '), array_to_string(w[2:], ' ')]) AS inside FROM candidates WHERE m >= 3) GROUP BY 1, 2),
surviving AS (
  SELECT lowest.* FROM lowest LEFT JOIN covers ON covers.lang = lowest.lang AND inside = phrase
  WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM surviving JOIN total USING (lang) QUALIFY rank <= 2000""",
    "op12_exact_dedup": r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents),
g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM t JOIN g USING (h)""",
}

"""Registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.llm import (
    decontamination, hamming_search, html_text, lexical_search, license_scan, near_duplicates, packing, quality, sharding, spelling, token_counts, toxicity,
    url_filter,
)
from locusweave.llm.common import stored, table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract_pages(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.context_totals(stored(token_counts.length_histogram(table(spark, sf_dir, "documents"))))


def op9_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_search.top_k(table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filter, op2_decontamination, op3_html_text, op4_sharding, op5_near_duplicates, op6_packing, op7_toxicity, op8_token_counts,
        op9_top_k_search, op10_quality, op11_license_scan, op12_spelling_variants, op13_lexical_search)
}

_URL_PARTS = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
)"""


def _sql_words(column: str) -> str:
    return f"""list_filter(regexp_split_to_array(translate(coalesce({column}, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"""


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATES = ",\n    ".join(
    f"({i}, {_sql_text(label)}, {base}, {_sql_text(text)})"
    for i, (label, text, base) in enumerate([(*p, True) for p in license_scan.PHRASES] + [(*n, False) for n in license_scan.NOTICES]))

SQL: dict[str, str] = {
    "op1_url_filter": _URL_PARTS + """, ruled AS (
  SELECT *, '.' || host AS dotted, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN dotted LIKE '%.casino-%' OR dotted LIKE '%.cheap-pills.%' OR dotted LIKE '%.adult-%' THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
    "op2_decontamination": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents
), items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS n, array_to_string(words[s:s + 12], ' ') AS gram
  FROM (SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 12, 1))) AS s FROM items WHERE len(words) > 0)
), starts AS (
  SELECT r, words, unnest(generate_series(1, len(words))) AS s FROM docs WHERE len(words) > 0
), grams AS (
  SELECT r, s, n, array_to_string(words[s:s + n - 1], ' ') AS gram
  FROM starts CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE s + n - 1 <= len(words)
), found AS (
  SELECT r, s, n, item_id FROM grams JOIN windows USING (n, gram)
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS p FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
    "op9_top_k_search": """
WITH vectors AS (
  SELECT DISTINCT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id,
         CAST(len(list_filter(range(1, 65), lambda i: coalesce(q.embedding[i] > 0, false) <> coalesce(v.embedding[i] > 0, false))) AS INTEGER) AS distance
  FROM vectors q JOIN vectors v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank FROM pairs
)
SELECT * FROM ranked WHERE rank <= 10""",
    "op11_license_scan": f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_sql_words('text')} AS words FROM documents
), templates AS (
  SELECT template, label, base, {_sql_words('text')} AS words, CASE WHEN base THEN 2 ELSE 4 END AS k FROM (VALUES
    {_TEMPLATES}) AS t (template, label, base, text)
), grams AS (
  SELECT template, base, label, k, len(words) AS size, place, words[place + 1:place + k] AS gram
  FROM (SELECT *, unnest(generate_series(0, len(words) - k)) AS place FROM templates)
), starts AS (
  SELECT r, words, unnest(generate_series(0, len(words) - 2)) AS pos FROM docs WHERE len(words) > 1
), said AS (
  SELECT r, pos, 2 AS k, words[pos + 1:pos + 2] AS gram FROM starts UNION ALL
  SELECT r, pos, 4, words[pos + 1:pos + 4] FROM starts WHERE pos + 4 <= len(words)
), votes AS (
  SELECT r, template, base, label, k, size, pos - place AS diagonal, place FROM said JOIN grams USING (k, gram)
), phrases AS (
  SELECT r, label, diagonal FROM votes WHERE base GROUP BY r, template, label, size, k, diagonal HAVING count(DISTINCT place) = size - k + 1
), notices AS (
  SELECT r, label, max(share) AS share FROM (
    SELECT a.r, a.label, a.template, a.diagonal, count(DISTINCT b.place + o.o) / any_value(a.size) AS share
    FROM (SELECT DISTINCT r, template, label, size, diagonal FROM votes WHERE NOT base) a
    JOIN votes b ON a.r = b.r AND a.template = b.template AND b.diagonal BETWEEN a.diagonal - 8 AND a.diagonal + 8, (SELECT unnest([0, 1, 2, 3]) AS o) o
    GROUP BY ALL)
  WHERE share >= 0.75 GROUP BY r, label
), base AS (
  SELECT r, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM phrases GROUP BY r
), every AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT r, label, 1.0::DOUBLE AS share FROM phrases UNION ALL SELECT r, label, share FROM notices) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN every USING (r)""",
    "op12_spelling_variants": r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), counted AS (
  SELECT id, run, count(*) AS times FROM runs WHERE length(run) >= 6 GROUP BY ALL
), bytes AS (
  SELECT run, times, flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b
  FROM counted
), hashed AS (
  SELECT run, times, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b), lambda s, x:
    list_reduce(list_concat([xor(s, CAST(x AS BIGINT))], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda r, zero: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295) AS h
  FROM bytes
), words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
  FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)
), shorter AS (
  SELECT DISTINCT h.word, h.n, w.word AS other, w.n AS other_n FROM holes h JOIN words w ON w.word = h.head || h.tail
), pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION ALL SELECT word, n, other, other_n FROM shorter
  UNION ALL SELECT other, other_n, word, n FROM shorter
), near AS (
  SELECT word, n, count(*) AS n_near, min(struct_pack(less := -other_n, other := other)) AS best FROM pairs GROUP BY word, n
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 5 * w.n THEN best.other END AS form,
         CASE WHEN -best.less >= 5 * w.n THEN -best.less END AS form_n
  FROM words w LEFT JOIN near USING (word)
), chains AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, max_by(root, steps) AS root FROM chains GROUP BY word) USING (word)""",
    "op13_lexical_search": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents
), items AS (
  SELECT row_number() OVER () AS i, item_id, list_distinct(list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS words
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_terms FROM docs WHERE len(words) > 0
), asked AS (
  SELECT i, item_id, unnest(words) AS term FROM items
), held AS (
  SELECT r, doc_id, len(words) AS n, unnest(words) AS term FROM docs
), tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term, n_docs
), scores AS (
  SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), totals GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}

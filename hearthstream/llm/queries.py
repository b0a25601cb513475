"""The numbered operators applied to whole tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearthstream.llm import bpe, cross_tokens, ego_join, main_text, merkle, minhash, packing, repair, suffix_dedup, url_rules, weak_label, whitening, window_dedup
from hearthstream.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def vocabulary_path() -> str:
    """The byte-level vocabulary of the installed tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_main_text(table(spark, sf_dir, "pages"), ["page_id", "url"])


@query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


ORACLES["op2_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 2 THEN [words[1]]
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS grams
  FROM w
), t AS (
  SELECT doc_id, unnest(grams) AS gram FROM s
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
        FROM t x JOIN t y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN s x ON x.doc_id = p.a JOIN s y ON y.doc_id = p.b
  WHERE 100 * c >= 80 * (len(x.grams) + len(y.grams) - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT s.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id"""


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op4_similar_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.similar_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op4_similar_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT a AS vec_id, (SELECT count(*) FROM links l WHERE l.a = r.a) AS n_links,
  min(b) AS component_id, a = min(b) AS kept
FROM reach r GROUP BY a"""


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary_path())


VOCABULARY_SIZE = 50_257


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.token_file_digests(
        table(spark, sf_dir, "documents"), vocabulary_path(), VOCABULARY_SIZE
    )


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_label.judge_quality(table(spark, sf_dir, "documents"))


@query
def op8_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.remove_repeats(table(spark, sf_dir, "documents"))


ORACLES["op8_window_dedup"] = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), p AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i, words FROM w
), keyed AS (
  SELECT doc_id, word, i, CASE WHEN i + 49 <= len(words) THEN md5(array_to_string(words[i:i + 49], ' ')) END AS k FROM p
), firsts AS (
  SELECT k, min(doc_id) AS f FROM keyed WHERE k IS NOT NULL GROUP BY k
), hits AS (
  SELECT a.doc_id, a.word, a.i, CASE WHEN f < a.doc_id THEN a.i END AS hit FROM keyed a LEFT JOIN firsts USING (k)
), cut AS (
  SELECT doc_id, word, i, coalesce(max(hit) OVER (PARTITION BY doc_id ORDER BY i) > i - 50, false) AS gone FROM hits
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(count(i) FILTER (gone) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id) GROUP BY w.doc_id, len(words)"""


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_spans(table(spark, sf_dir, "documents"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


# (verdict, host, path) of the rules that every page is judged by.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


@query
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rules_frame(spark, URL_RULES)
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules, ["page_id"])


ORACLES["op11_url_filter"] = r"""
WITH rules(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), cut AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT row_number() OVER () AS k, page_id,
    translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), won AS (
  SELECT k, arg_max(h || p, length(h || p)) AS rule, arg_max(r.verdict, length(h || p)) AS verdict
  FROM parts, rules r
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY k
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN won USING (k)"""


def piece_model_path() -> str:
    """The sentencepiece model of the installed tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op12_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return cross_tokens.align_documents(documents, vocabulary_path(), piece_model_path())


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_vectors(table(spark, sf_dir, "embeddings"))

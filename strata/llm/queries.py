"""The operators' registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.html import extract
    return extract(table(spark, sf_dir, "pages"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from strata.llm.pieces import encoded
    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.lm import scored
    return scored(table(spark, sf_dir, "documents"), min_count=1)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.decontaminate import leaks
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.urls import filter_urls
    return filter_urls(table(spark, sf_dir, "pages"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.quality import quality_report
    return quality_report(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.passages import repeated_passages
    return repeated_passages(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.sharding import shards
    return shards(table(spark, sf_dir, "documents"), 40)


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from strata.llm.tokens import token_output
    return token_output(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.secrets import secret_report
    return secret_report(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.spelling import spelling_variants
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.search import search
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_decontamination": op4_decontamination,
    "op5_url_filter": op5_url_filter,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sharding": op9_sharding,
    "op10_token_output": op10_token_output,
    "op11_secret_scan": op11_secret_scan,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_ranked_search": op13_ranked_search,
}


def _url_sql() -> str:
    """The listed rules by suffix and prefix tests, the rest by LIKE."""
    from strata.llm.urls import GENERAL, LISTED
    fits, names, verdicts = [], [], []
    for r in sorted(LISTED, key=lambda r: -r.weight):
        host, slash, path = r.name.partition("/")
        fit = f"(('.' || host) LIKE '%.{host}' AND starts_with(path, '{slash}{path}'))"
        names.append(f"WHEN {fit} THEN '{r.name}'")
        verdicts.append(f"WHEN {fit} THEN '{r.verdict}'")
    for r in GENERAL:
        verdicts.append(f"WHEN host LIKE '%{r.glob.split('*')[1]}%' THEN '{r.verdict}'")
    return f"""
    WITH parts AS (
      SELECT page_id,
             translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
      FROM pages)
    SELECT page_id, host, path, CASE {' '.join(names)} END AS rule,
           CASE {' '.join(verdicts)} ELSE 'allow' END AS verdict
    FROM parts"""


def _search_sql(k: int = 10) -> str:
    """The score term by term, over all documents that hold a term of an item."""
    def found(column):
        lowered = f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
    WITH held AS (
      SELECT row_number() OVER () AS r, doc_id, {found('text')} AS ts FROM documents),
    sized AS (SELECT r, doc_id, ts, len(ts)::BIGINT AS n FROM held WHERE len(ts) > 0),
    total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sized),
    items AS (SELECT row_number() OVER () AS i, item_id, {found('text')} AS ts
              FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    asked AS (SELECT i, item_id, t, count(*)::BIGINT AS times
              FROM (SELECT i, item_id, unnest(ts) AS t FROM items) GROUP BY i, item_id, t),
    posted AS (SELECT r, doc_id, n, t, count(*)::BIGINT AS tf
               FROM (SELECT r, doc_id, n, unnest(ts) AS t FROM sized)
               WHERE t IN (SELECT t FROM asked) GROUP BY r, doc_id, n, t),
    weights AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
                FROM posted, total GROUP BY t),
    gains AS (SELECT r, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS gain
              FROM posted JOIN weights USING (t), total),
    scores AS (SELECT i, item_id, r, doc_id, sum(times * gain)::BIGINT AS score
               FROM asked JOIN gains USING (t) GROUP BY i, item_id, r, doc_id),
    ranked AS (SELECT item_id, doc_id, score, row_number() OVER (
                 PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
               FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}"""


SQL: dict[str, str] = {"op5_url_filter": _url_sql(), "op13_ranked_search": _search_sql()}

"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termfit.llm import backoff, bpe, chat, collocations, credentials, jaccard, licenses, quality, ranking, repeats, superkmers, tiling, urls

#: Where the public vocabularies are, unless the environment or the package of that name says otherwise.
TOKENIZERS = "/opt/tokenizers"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def bpe_path() -> str:
    """The vocabulary file, which the driver reads."""
    try:
        from public_tokenizers import path
    except ImportError:
        return os.path.join(TOKENIZERS, "word_bpe_49k.json")
    return path("word_bpe_49k.json")


def fitted_quality(spark: SparkSession, docs: DataFrame, sf: str, carry: list[str] | None = None) -> DataFrame:
    """Quality rules with multinomials and threshold fitted to ``docs``; the trusted target comes from ``labels``."""
    trusted = quality.trusted_ids(_table(spark, sf, "labels"))
    counts = quality.fit_counts(docs, trusted)
    threshold = quality.fit_threshold(docs, trusted, *counts)
    return quality.quality_rules(docs, quality.ratio_of(*counts), threshold, carry)


#: The rules of the URL query.
URL_RULES = [
    urls.Rule("org", "/", "allow"),
    urls.Rule("example.org", "/es/", "block"),
    urls.Rule("example.org", "/en/1", "block"),
    urls.Rule("com", "/fr/", "allow"),
    urls.Rule("com", "/de/", "block"),
]


def op1_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Rules decide first; URLs without a rule get the verdict of a model fitted to those with one."""
    pages = _table(spark, sf, "pages")
    return urls.judge(pages, URL_RULES, urls.train(urls.ruled_urls(pages, URL_RULES)))


def op2_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat.digests(chat.read_back(chat.format_conversations(rows.unionByName(more))))


def op3_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = tiling.leaked_items(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered_words", "coverage", F.size("tiles").alias("n_tiles"))


def op5_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return credentials.summary(credentials.scan(docs, F.col("source"), F.concat_ws("/", "source", "lang")))


def op6_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(_table(spark, sf, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.digests(repeats.remove_repeats(_table(spark, sf, "documents")))


def op8_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return backoff.score(_table(spark, sf, "documents"))


def op10_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = bpe_path()
    decoded = bpe.decode(bpe.encode(_table(spark, sf, "documents"), path), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return fitted_quality(spark, _table(spark, sf, "documents"), sf)


def op4_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    members, _ = jaccard.jaccard_components(_table(spark, sf, "documents"), 3, Fraction(9, 10))
    return members


def op11_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = superkmers.remove_repeats(_table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf, "documents"))


def op13_ranked_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.search(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES = {
    query.__name__: query
    for query in (
        op1_url_filters,
        op2_chat_formatting,
        op3_benchmark_decontamination,
        op4_ngram_jaccard_join,
        op5_secret_scans,
        op6_license_scans,
        op7_suffix_array_dedup,
        op8_lm_scoring,
        op9_quality_rules,
        op10_bpe,
        op11_substring_dedup,
        op12_phrase_collocations,
        op13_ranked_lexical_search,
        pipeline,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), w AS (
  SELECT *, length(text) - length(replace(text, '\', ''))
    + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0)
    + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS escapes,
    length(role) - length(replace(role, '\', ''))
    + coalesce(list_sum(list_transform(regexp_extract_all(role, '#{3,}'), lambda x: length(x) - 2)), 0)
    + (length(role) - length(replace(role, '</turn>', ''))) // 7
    + (length(role) - length(replace(role, ': ', ''))) // 2 AS role_escapes
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + role_escapes + length(text) + escapes + 14)::BIGINT AS formatted_chars,
  regexp_matches(string_agg(role || ',', '' ORDER BY turn NULLS FIRST, role, text), '^(system,)?(user,assistant,)+$') AS valid
FROM w GROUP BY conv_id""",
    "op11_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS p FROM d),
x AS (
  SELECT doc_id, p, string_agg(word, ' ') OVER frame AS passage, count(*) OVER frame AS n FROM w
  WINDOW frame AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), r AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY passage ORDER BY doc_id, p) > 1 AS again FROM x WHERE n = 20
), c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM r WHERE again),
k AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS kept FROM w ANTI JOIN c USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
    "op12_phrase_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
i AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (SELECT lang, words[i] AS w1, words[i + 1] AS w2, words[i + 2] AS w3 FROM i),
c1 AS (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL),
c2 AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
c3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c1 GROUP BY lang),
k AS (
  SELECT lang, w1 || ' ' || w2 AS phrase, 1 AS k, c2.f AS a, x.f AS l, y.f AS r
  FROM c2 JOIN c1 x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, f FROM c1) y USING (lang, w2)
  WHERE c2.f >= 10 AND NOT EXISTS (
    SELECT 1 FROM c3 WHERE c3.lang = c2.lang AND 100 * c3.f >= 50 * c2.f
      AND (c3.w1 = c2.w1 AND c3.w2 = c2.w2 OR c3.w2 = c2.w1 AND c3.w3 = c2.w2))
  UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3, 1, c3.f, x.f, y.f
  FROM c3 JOIN c1 x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, w2 AS w3, f FROM c2) y USING (lang, w2, w3)
  UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3, 2, c3.f, x.f, y.f
  FROM c3 JOIN c2 x USING (lang, w1, w2) JOIN (SELECT lang, w1 AS w3, f FROM c1) y USING (lang, w3)
), s AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM k),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS worst FROM s),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM b WHERE worst = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_ranked_lexical_search": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), s AS (SELECT count(*) FILTER (len(terms) > 0) AS n, sum(len(terms))::BIGINT AS total FROM d),
t AS (SELECT doc_id, len(terms) AS length, unnest(terms) AS term FROM d),
f AS (SELECT doc_id, term, any_value(length) AS length, count(*) AS tf FROM t GROUP BY doc_id, term),
w AS (
  SELECT term, floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM f, s GROUP BY term
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), r AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * length * n) // total))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN f USING (term), s GROUP BY item_id, doc_id
), k AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM r WHERE score > 0
)
SELECT * FROM k WHERE rank <= 50""",
}

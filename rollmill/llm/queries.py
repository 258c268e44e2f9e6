"""The corpus operators over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.llm import (
    centroids,
    compress_quality,
    conversations,
    decontaminate,
    line_runs,
    near_dup,
    packing,
    pseudonyms,
    rule_lists,
    token_counts,
    token_files,
    toxicity,
    url_rules,
)
from rollmill.llm.base import table
from rollmill.llm.samples import folded, labelled_sample
from rollmill.session import scratch_path, stage
from workloads.base import Workload

BYTE_BPE = "byte_bpe_50k.json"
# Edits of a cleaning pass: long numbers become one digit, runs of a symbol one symbol.
CLEANING = [(r"\d{4,}", "0"), (r"([!#*$%&])\1+", r"\1")]


def op1_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component and kept document of every document, by sets of five-word shingles at 0.75."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), near_dup.MinHash(width=5, percent=75))


def op2_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document, before and after the edits of a cleaning pass."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(BYTE_BPE)
    trees = token_counts.build_trees(docs, path)
    folder = scratch_path(spark, "token-trees")
    trees.write.option("compression", "zstd").parquet(folder)
    return token_counts.apply_rules(spark.read.schema(trees.schema).parquet(folder), CLEANING, path)


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of whole documents in sequences of 1024 tokens, each document ended by id 0."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path(BYTE_BPE), capacity=1024, end_id=0)


def op4_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with personal numbers, dates and e-mail names replaced, and counts by kind."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, key="corpus-2024")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Learnt from the labelled rows outside the held-out fifth."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.fit(labelled_sample(docs, labels, "toxic", folded("doc_id", 5) != 0))


def op5_toxic_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document, as the noisy-or of its sentences."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored, score, _ = toxicity.score_toxicity(docs, toxicity_model(spark, docs, sf_dir), spans=False)
    return scored.select("doc_id", *verdict(5, 0, score))


def verdict(folds: int, out: int, score: str) -> list:
    return [
        (folded("doc_id", folds) == out).alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= 0.5).cast("int").alias("predicted"),
    ]


def op6_line_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents without the later copies of repeated line runs of 50 words or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.drop_later_copies(docs, min_words=50)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as token ids in seekable files and read back from them."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "token-files")
    files = token_files.write_token_files(docs, public_tokenizers.path(BYTE_BPE), folder, end_id=2)
    return token_files.read_token_files(files, with_ids=False)


def op8_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item's question and answer, with the item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole document, by dictionaries of good and bad text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = compress_quality.fit(labelled_sample(docs, labels, "quality", folded("doc_id", 3) != 1))
    scored, score = compress_quality.score_quality(docs, model)
    return scored.select("doc_id", *verdict(3, 1, score))


def op10_rule_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every whole document, the base rules, and the verdict of the learnt rules."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = rule_lists.text_statistics(docs).drop("text")
    stats = stage(stats, scratch_path(spark, "statistics"))
    rules = rule_lists.fit(stats, table(spark, sf_dir, "labels"))
    failed = rule_lists.base_failed()
    return stats.select(
        "doc_id",
        *rule_lists.COUNTS[:5],
        failed.alias("base_failed"),
        (~failed & rule_lists.verdict(rules)).alias("kept"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    turns = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair(turns)


URL_RULES = [
    url_rules.HostRule("block", "net", "/"),
    url_rules.HostRule("allow", "example.net", "/en/"),
    url_rules.HostRule("block", "example.com", "/de/"),
    url_rules.HostRule("allow", "org", "/fr/"),
    # pages that are no text of their own: listings, logins, sessions, archives and programs
    url_rules.GlobRule("block", "**[?&]page=**"),
    url_rules.GlobRule("block", "**[?&]sessionid=**"),
    url_rules.GlobRule("block", "**/login*"),
    url_rules.GlobRule("block", "**/cgi-bin/**"),
    url_rules.GlobRule("block", "**.zip"),
    url_rules.GlobRule("block", "**.exe"),
    url_rules.GlobRule("allow", "**[?]page=1"),
    # copies of pages that are reached by their main host as well
    url_rules.GlobRule("block", "m.*/**"),
]


def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the address of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, URL_RULES).drop("url")


# Longest host rule first, then longest glob first; ** is .*, * is [^/?]*.
OP12_SQL = r"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^?#]*(\?[^#]*)', 1), '') AS query
  FROM pages),
fitted AS (
  SELECT *, host || path || query AS address,
    CASE
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM parts),
globbed AS (
  SELECT *,
    CASE
      WHEN rule IS NOT NULL THEN NULL
      WHEN regexp_full_match(address, '(?s).*[?&]sessionid=.*') THEN '**[?&]sessionid=**'
      WHEN regexp_full_match(address, '(?s).*[?&]page=.*') THEN '**[?&]page=**'
      WHEN regexp_full_match(address, '(?s).*/cgi-bin/.*') THEN '**/cgi-bin/**'
      WHEN regexp_full_match(address, '(?s).*[?]page=1') THEN '**[?]page=1'
      WHEN regexp_full_match(address, '(?s).*/login[^/?]*') THEN '**/login*'
      WHEN regexp_full_match(address, '(?s)m\.[^/?]*/.*') THEN 'm.*/**'
      WHEN regexp_full_match(address, '(?s).*\.zip') THEN '**.zip'
      WHEN regexp_full_match(address, '(?s).*\.exe') THEN '**.exe'
    END AS pattern
  FROM fitted)
SELECT page_id, host, path, rule, pattern,
  CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') OR pattern = '**[?]page=1' THEN 'allow'
    WHEN rule IS NULL AND pattern IS NULL THEN 'allow'
    ELSE 'block'
  END AS verdict
FROM globbed
"""


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty clusters of all embeddings after five rounds."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found, _ = centroids.cluster(vectors, "vec_id", "embedding", k=40, rounds=5, size=64, factor=256, seed=2)
    return found


def op13_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds as one subquery after the other."""
    steps = [
        """v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), c) - 1 AS INTEGER) AS cluster, c
  FROM v WHERE vec_id IS NOT NULL ORDER BY cluster LIMIT {k})""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""d{n} AS (
  SELECT v.vec_id, v.c, k.cluster,
    CAST(list_sum(list_transform(list_zip(v.c, k.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
  FROM v, c{n} k
  QUALIFY row_number() OVER (PARTITION BY v.vec_id, v.c ORDER BY distance, k.cluster) = 1)""")
        if n < rounds:
            steps.append(f"""m{n} AS (
  SELECT cluster, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(c) AS x, unnest(range(64)) AS i FROM d{n}) GROUP BY cluster, i),
c{n + 1} AS (
  SELECT k.cluster, coalesce(any_value(g.c), any_value(k.c)) AS c
  FROM c{n} k LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM m{n} GROUP BY cluster) g
  ON k.cluster = g.cluster GROUP BY k.cluster)""")
    return f"""WITH {", ".join(steps)}
SELECT d.vec_id, d.cluster, d.distance,
  CAST(sum(d.distance) OVER (PARTITION BY d.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(k.c, ',')) AS centroid_sha256
FROM d{rounds} d JOIN c{rounds} k ON d.cluster = k.cluster
"""


WORKLOADS: dict[str, Workload] = {
    "op1_bbit_minhash": Workload(op1_bbit_minhash),
    "op2_edit_token_counts": Workload(op2_edit_token_counts),
    "op3_harmonic_packing": Workload(op3_harmonic_packing),
    "op4_feistel_pseudonyms": Workload(op4_feistel_pseudonyms),
    "op5_toxic_sentences": Workload(op5_toxic_sentences),
    "op6_line_suffix_array": Workload(op6_line_suffix_array),
    "op7_token_files": Workload(op7_token_files),
    "op8_benchmark_passages": Workload(op8_benchmark_passages),
    "op9_compression_quality": Workload(op9_compression_quality),
    "op10_rule_list": Workload(op10_rule_list),
    "op11_conversation_repair": Workload(op11_conversation_repair),
    "op12_url_rules": Workload(op12_url_rules, OP12_SQL),
    "op13_centroids": Workload(op13_centroids, op13_sql()),
}

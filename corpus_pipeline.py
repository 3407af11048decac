"""The corpus pipeline: documents to encoded training text in five stages.

1. language: documents without letters, or most of whose letters no language's labelled text has, go.
2. exact duplicates: of equal texts (A-Z in lower case) the row with the largest id stays.
3. near duplicates: of each component of documents with 80 % equal five-word shingles, the least id stays. Where an
   id has several texts, each of them is judged by itself.
4. mixing: sources are repeated towards equal weights, none more than twice as often as any other; every
   document is passed over at least once.
5. encoding: each pass over a document becomes one row with its tokens.

Every stage reads what its predecessor wrote, works on all of it, and returns the columns of the documents; the
last adds ``n_tokens``, ``ids`` (decimal, joined by commas) and ``decoded_sha256`` and drops the text. Nulls,
empty tables and repeated rows have the results that the operators state: a null or empty text has no letter and
goes in the first stage; rows that repeat an id and a text leave one row after the second; a null source is a
source of its own. Rows with a null id are kept by the near-duplicate stage. Other columns are carried along to
the end, whatever their names, except that the last stage's own names replace columns of the same name.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import byte_bpe, exact_dedup, language_id, mixing, near_dedup
from starmart.llm.columns import free_name, if_small, in_class
from starmart.llm.shipping import ship_package
from starmart.session import scratch_path

#: Share of a document's letters that must occur in some language's labelled text.
KNOWN_LETTERS = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the language column stays as it was."""
    ship_package(spark)
    model = language_id.fit(docs, ~in_class(F.col("doc_id"), 3, 1))
    if not model.samples:  # nothing is labelled, so nothing can be rejected for its language
        return docs.filter(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    found = language_id.identify(model)(F.col("text"))
    return docs.filter((found["lang"] != language_id.UNKNOWN) & (found["known"] >= KNOWN_LETTERS))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, by the digest index."""
    found = exact_dedup.deduplicate(docs, exact_dedup.DigestIndex.temporary(spark))
    path = scratch_path(spark, "exact")
    ident, digest = free_name(docs, "id"), free_name(docs, "digest")
    marked = found.filter("NOT kept OR keep_rows > 1")
    marked.select(F.col("id").alias(ident), F.col("digest").alias(digest + "_"), "kept").distinct().write.parquet(path)
    marked = spark.read.parquet(path)
    rows = docs.withColumn(digest, exact_dedup.digest_of(F.col("text")))
    same = docs["doc_id"].eqNullSafe(marked[ident]) & (rows[digest] == marked[digest + "_"])
    marked = if_small(marked, marked.count())
    kept = rows.join(marked, same, "left_anti")
    again = marked.filter("kept")
    if not again.isEmpty():  # rows that repeat both an id and a text
        repeated = rows.join(again, same, "left_semi").dropDuplicates(["doc_id", digest])
        kept = kept.unionByName(repeated)
    return kept.drop(digest)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    ship_package(spark)
    found = near_dedup.near_duplicates(docs)
    path = scratch_path(spark, "dropped")
    ident, digest = free_name(docs, "id"), free_name(docs, "digest")
    found.filter("NOT kept").select(F.col("id").alias(ident), F.col("digest").alias(digest + "_")).distinct().write.parquet(path)
    dropped = spark.read.parquet(path)
    dropped = if_small(dropped, dropped.count())
    rows = docs.withColumn(digest, exact_dedup.digest_of(F.col("text")))
    same = (rows["doc_id"] == dropped[ident]) & (rows[digest] == dropped[digest + "_"])
    return rows.join(dropped, same, "left_anti").drop(digest)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once for each pass over them."""
    number = free_name(docs, "pass")
    mix = mixing.plan_mix(docs, mixing.word_count(F.col("text")))
    return mix.apply(docs, as_pass=number).drop(number)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row's text, and the digest of what they decode to."""
    ship_package(spark)
    bpe = byte_bpe.round_trip(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    column = free_name(docs, "bpe")
    added = {
        "n_tokens": F.col(f"{column}.n_tokens"),
        "ids": F.col(f"{column}.ids"),
        "decoded_sha256": F.sha2(F.col(f"{column}.decoded"), 256),
    }
    return docs.withColumn(column, bpe(F.col("text"))).withColumns(added).drop(column, "text")


STAGES = [("language", language), ("exact", exact), ("near", near), ("mixed", mixed), ("encoded", encoded)]

#: Languages, shingle signatures and byte-pair merges are not for SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

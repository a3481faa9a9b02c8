"""A training corpus from raw documents: stages that each read what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import decontaminate, jaccard_join, language, mixing, queries
from tidemart.llm.text import table
from tidemart.session import pin

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Words in a shingle and percent of similarity from which documents are near duplicates.
SHINGLE_WORDS, SIMILAR = 5, 80


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that are like no language: null or without letters, or of cosine 0 with all profiles."""
    # Columns of documents that are named like a result step aside meanwhile.
    aside = {c: f"{c} of documents" for c in docs.columns if c in ("held_out", "lang_pred", "score")}
    told = queries.with_languages(docs.withColumnsRenamed(aside))
    known = told.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") > 0))
    return known.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: that of the smallest id, rows without id after all others.

    Rows that repeat an id are one document, of which the row with the least
    hash of its columns stays. Rows without id take part by a number of their
    own. Rows without words are like nothing and stay, but for repeated ids.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key, mark = (f"_{name}" + "_" * max(map(len, docs.columns)) for name in ("key", "mark"))
    ids = docs.agg(F.max(F.col("doc_id").cast("long")).alias("most"), F.count_if(F.col("doc_id").isNull()).alias("unnamed")).first()
    rows = docs.withColumn(key, F.col("doc_id").cast("long"))
    if ids.unnamed:
        after = F.lit((ids.most or 0) + 1).cast("long") + F.monotonically_increasing_id()
        unnamed = pin(docs.filter("doc_id is null").withColumn(key, after), "without-id")
        rows = rows.filter("doc_id is not null").unionByName(unnamed)
    linked = jaccard_join.link(rows, width=SHINGLE_WORDS, percent=SIMILAR, id_column=key)
    others = pin(linked.filter("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct(), "near-duplicates")
    kept = rows.join(others, key, "left_anti")
    repeated = pin(kept.groupBy(key).count().filter("count > 1").select(key), "repeated-ids")
    if repeated.isEmpty():
        return kept.select(columns)
    # Equal rows have equal hashes; of those any one is the same.
    several = kept.join(repeated, key, "left_semi").withColumn(mark, F.xxhash64(F.to_json(F.struct(*columns))))
    least = several.groupBy(key).agg(F.min(mark).alias(mark))
    one = several.join(least, [key, mark], "left_semi").dropDuplicates([key])
    return kept.join(repeated, key, "left_anti").unionByName(one.drop(mark)).select(columns)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark, other numbers, names or units included."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources does: not at all, or up to three times."""
    return mixing.mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write all documents as token files; a row per document as read back from them."""
    return queries.token_files_of(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", remove_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

#: SQL has neither the language profiles nor the tokenizer, so stages are tested against plain versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), name)
    return docs

"""The queries of the operators in this folder, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (
    alignment,
    bpe_stream,
    decontaminate,
    embeddings,
    html_text,
    jaccard_join,
    kneser_ney,
    language,
    mixing,
    quotations,
    ranked_search,
    suffix_dedup,
    token_files,
)
from tidemart.llm.text import table
from tidemart.session import fresh_path

#: Where tokenizers lie on this machine and on its executors.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The two vocabularies that are aligned.
MERGES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
END_ID = 1
#: Languages are learned from documents whose crc32 of the id leaves another remainder than this one.
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 4, 2
#: The scoring model learns from documents whose crc32 of the id leaves another remainder than this one.
SCORING_FOLDS, SCORING_HELD_OUT = 10, 0


def with_languages(docs: DataFrame) -> DataFrame:
    """``docs`` with held_out, lang_pred and score; learned from the rows that are not held out."""
    held_out = F.coalesce(language.fold(F.col("doc_id"), LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT, F.lit(False))
    folds = docs.withColumn("held_out", held_out)
    learned = folds.filter(~F.col("held_out") & F.col("doc_id").isNotNull())
    return language.predict(folds, language.learn(learned))


def language_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return with_languages(docs).select("doc_id", "held_out", "lang_pred", "score")


def text_of_pages(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def scores_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    remainder = language.fold(F.col("doc_id"), SCORING_FOLDS)
    scored = kneser_ney.score(docs, remainder != SCORING_HELD_OUT)
    held_out = F.coalesce(remainder == SCORING_HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def token_files_of(docs: DataFrame) -> DataFrame:
    """Write ``docs`` as token files, read them back, and describe each document."""
    spark = docs.sparkSession
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(docs, path, TOKENIZER, END_ID)
    read = token_files.with_starts(token_files.read_token_files(spark, path))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def encoded_and_decoded(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_stream.digests(bpe_stream.encode(table(spark, folder, "documents"), TOKENIZER))


def alignments_of(docs: DataFrame) -> DataFrame:
    """Counts of each document's aligned tokens, and a digest of its groups."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return alignment.align(docs, MERGES, PIECES, notes={"groups_sha256": digest})


def best_documents(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard": lambda s, f: jaccard_join.link(table(s, f, "documents")),
    "op2_decontaminate": lambda s, f: decontaminate.matches(table(s, f, "documents"), table(s, f, "benchmark")),
    "op3_mixing": lambda s, f: mixing.taken_words(table(s, f, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    ),
    "op4_quotations": lambda s, f: quotations.link_quotations(table(s, f, "conversations")),
    "op5_embeddings": lambda s, f: embeddings.near_duplicates(table(s, f, "embeddings")),
    "op6_language": language_of_documents,
    "op7_kneser_ney": scores_of_documents,
    "op8_token_files": lambda s, f: token_files_of(table(s, f, "documents")),
    "op9_main_text": text_of_pages,
    "op10_suffixes": lambda s, f: suffix_dedup.remove_repeats(table(s, f, "documents")).drop("spans"),
    "op11_bpe_stream": encoded_and_decoded,
    "op12_alignment": lambda s, f: alignments_of(table(s, f, "documents")),
    "op13_ranked_search": best_documents,
}

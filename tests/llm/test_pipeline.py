"""The pipeline's stages one after the other, and the statements of this folder's queries."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemart.llm import jaccard_join, queries
from tidemart.llm.oracles import ORACLES
from tidemart.llm.text import table
from tidemart.session import pin
from tools.verify import connect, difference, rows_of

FOLDER = "/root/testdata/sf0.001"
NUMBERS = {"language": 6, "near_duplicates": 1, "decontamination": 2, "mixing": 3, "token_files": 8}


@pytest.fixture(scope="module")
def stages(spark):
    docs, kept = table(spark, FOLDER, "documents"), {}
    kept["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = pin(stage(spark, docs, FOLDER), name)
    return kept


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns_of_documents(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == list(NUMBERS)
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_one_of_each_group_stays(spark, stages):
    linked = jaccard_join.link(stages["language"], width=5, percent=80)
    assert ids(stages["near_duplicates"]) == {r.component_id for r in linked.collect()}


def test_leaks_go_and_others_stay(spark, stages):
    items = {" ".join(r.text.split()) for r in table(spark, FOLDER, "benchmark").collect()}
    before = {r.doc_id: " ".join(r.text.split()) for r in stages["near_duplicates"].collect()}
    leaks = {i for i, text in before.items() if any(item in text for item in items)}
    assert ids(stages["decontamination"]) == set(before) - leaks


def test_last_stage_has_every_document_of_the_mix(stages):
    mixed, written = stages["mixing"], stages["token_files"]
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in written.collect())
    assert ids(mixed) <= ids(stages["decontamination"])


def test_language_rejects_what_has_no_letters(spark):
    docs = table(spark, FOLDER, "documents").limit(30)
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "12 !", "en", "s", 4), (-3, "", "en", "s", 0)], docs.schema)
    kept = corpus_pipeline.keep_known_languages(spark, docs.unionByName(odd), FOLDER)
    assert ids(kept) == ids(docs)


def test_stages_keep_columns_named_like_their_results(spark):
    docs = table(spark, FOLDER, "documents").limit(40)
    more = {c: F.lit(c) for c in ("score", "held_out", "lang_pred", "component_id", "times", "hash", "chunk", "_gone", "_bad")}
    docs = pin(docs.withColumns(more), "more-columns")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns
        assert {tuple(r) for r in kept.select(*more).collect()} == {tuple(more)}


def test_copies_go_whatever_their_ids(spark):
    docs = table(spark, FOLDER, "documents").limit(12).withColumn("tags", F.create_map(F.lit("a"), F.lit(1)))
    docs = pin(docs, "some")
    unnamed = docs.withColumn("doc_id", F.lit(None).cast("long"))
    empty = unnamed.limit(2).withColumn("text", F.lit(None).cast("string"))
    few = docs.orderBy("doc_id").limit(3)
    other = few.withColumn("text", F.concat("text", F.lit(" and quite another end")))
    rows = docs.unionByName(docs).unionByName(unnamed.limit(4)).unionByName(empty).unionByName(other)
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, pin(rows, "copies"), FOLDER)
    assert kept.columns == docs.columns
    got = kept.collect()
    alone = ids(corpus_pipeline.keep_one_of_near_duplicates(spark, docs, FOLDER))
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(alone)
    assert [r.text for r in got if r.doc_id is None] == [None, None]


def test_queries_are_named_by_their_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_its_statement(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    result = connect(FOLDER).execute(ORACLES[name])
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    assert difference(rows_of(df.columns, df.collect()), theirs) is None


def test_statements_are_valid_on_empty_tables(spark):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet' LIMIT 0")
    for sql in ORACLES.values():
        assert con.execute(sql).fetchall() == []

"""Physical plans: what must not be shuffled or read."""

import re

import pytest
from pyspark.sql import functions as F

from foliant.functions import structure as S
from foliant.functions import text as T
from foliant.operators import classification as K
from foliant.operators import vectors as V
from foliant.operators.cleaning import clean_documents, prepare_corpus
from foliant.plans.process import process_documents
from foliant.registry.base import table
from foliant.registry.text_queries import loaded_documents


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def schema_read(df):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def test_text_functions_are_map_only(docs):
    text = F.col("text")
    out = docs.select(
        "doc_id", T.clean_text(text), T.word_frequency(text), T.text_stats(text),
        S.document_structure(text))
    assert "Exchange" not in plan(out) and "Python" not in plan(out)
    assert schema_read(out) == ["doc_id:bigint,text:string"]


def test_processing_is_map_only(spark, sf_dir, docs):
    loaded = loaded_documents(spark, sf_dir)
    assert plan(process_documents(loaded)).count("Exchange") <= plan(loaded).count("Exchange")


def test_raw_length_filter_runs_before_cleaning(docs):
    text = plan(prepare_corpus(docs).select("doc_id", "prepared"))
    assert "length(text" in text and "Exchange" not in text
    assert "IsNotNull(text)" in text


def test_vectors_need_no_shuffle(docs):
    model = V.fit_vocabulary(docs.select("doc_id", "text"), max_features=50)
    assert "Exchange" not in plan(model.tfidf_vectors(docs.select("doc_id", "text")))
    # Every text is split and counted once, whatever is made of the counts.
    for make in (model.weights, model.term_rows, model.weight_rows):
        long = plan(make(docs.select("doc_id", "text")))
        assert "Exchange" not in long
        assert long.count("regexp_extract_all") == 1 and long.count("UDF(") == 1


def test_validation_joins_no_file_body(spark, tmp_path):
    from foliant.operators.validation import validate_requested
    from foliant.sources.files import read_files

    (tmp_path / "a.txt").write_text("x" * 200)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        files = read_files(spark, str(tmp_path))
        found = files.select("path").unionByName(spark.createDataFrame([("/no.txt",)], "path string"))
        text = plan(validate_requested(found, files))
        lines = text.splitlines()
        below = [lines[k + 1] for k, line in enumerate(lines) if "Exchange hashpartitioning(path" in line]
        assert len(below) == 2 and not any(re.search(r"[\[ ]content#\d+[,\]]", line) for line in below)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_extracted_text_reads_the_files_once(spark, tmp_path):
    from foliant.operators.assembly import extracted_text
    from foliant.sources.files import load_documents

    (tmp_path / "a.txt").write_text("x" * 200)
    assert "binaryFile" not in plan(extracted_text(load_documents(spark, str(tmp_path))))


def test_split_does_not_shuffle_the_text(spark, sf_dir, docs):
    labelled = docs.select("doc_id", "text", F.col("lang").alias("label"))
    split = K.stratified_split(K.encode_labels(labelled))
    assert "Exchange hash" not in plan(split) and "Window" not in plan(split)


def test_no_cartesian_products(spark, sf_dir):
    import __spark_entry__ as entry

    for name in ["J5_neighbor_counts", "E7_silhouette", "E2_confusion_matrix", "C2_assign_to_centers"]:
        text = plan(entry.queries()[name](spark, sf_dir))
        assert "Cartesian" not in text and "NestedLoop" not in text, name


def test_lemma_join_survives_a_large_dictionary(spark, monkeypatch):
    from foliant.operators import cleaning

    original = cleaning.lookup
    monkeypatch.setattr(
        cleaning, "lookup",
        lambda l, r, k, how: original(l, r, k, how, max_rows=1, hot_rows=2))
    df = spark.createDataFrame([(i, "cats chase mice " * 3) for i in range(5)], "doc_id long, text string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog"), ("x", "y")], "surface string, lemma string")
    got = clean_documents(df, lemmas).collect()
    assert len(got) == 5 and {r.cleaned_text for r in got} == {" ".join(["cat chase mice"] * 3)}


def test_processing_computes_the_parts_that_are_read(spark, sf_dir):
    """The result of X8 has the line count alone; a struct is computed whole."""
    import __spark_entry__ as entry
    from foliant.plans.process import process_documents
    from foliant.registry.text_queries import loaded_documents

    query = entry.queries()["X8_process_document"](spark, sf_dir)
    plan = query._jdf.queryExecution().optimizedPlan().toString()
    assert "line_count" in plan and "executive summary" not in plan and "keywords" not in plan
    every = process_documents(loaded_documents(spark, sf_dir))
    assert every.schema["structure"].dataType.names == ["entities", "dates", "sections", "tables", "keywords", "metadata"]
    lines = every.select("doc_id", "structure.metadata.line_count")
    assert lines.exceptAll(query.select("doc_id", "line_count")).isEmpty()


def test_the_silhouette_copies_no_vectors(spark):
    """Some blocks at a time go to all others: only sums of distances are shuffled."""
    from foliant.operators import cluster_metrics as Q

    rows = [(i, [float(i % 7), float(i)], i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, cluster int")
    text = plan(Q.silhouette_samples(df, block_rows=40))
    assert "Cartesian" not in text and not re.search(r"hashpartitioning\(a#", text)


def test_dates_are_found_in_one_search(docs):
    text = plan(docs.select(S.dates(F.col("text"))))
    assert text.count("regexp_replace(") <= 2 and "Exchange" not in text  # the operator, and its line in the list

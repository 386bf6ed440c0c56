import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.operators import embeddings as E
from foliant.operators import reduction as R
from foliant.operators import vectors as V
from foliant.operators.cleaning import clean_documents, prepare_corpus
from foliant.operators.joins import unmatched


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_tfidf_fixture(spark):
    df = docs(spark, "aa bb aa", "aa cc")
    model = V.fit_vocabulary(df)
    got = {(r.doc_id, r.term): r.weight for r in model.weights(df).collect()}
    want = {(0, "aa"): 0.818180, (0, "bb"): 0.574962, (1, "aa"): 0.579739, (1, "cc"): 0.814802}
    assert got == pytest.approx(want, abs=1e-6)
    vectors = {r.doc_id: r.features.toArray() for r in model.tfidf_vectors(df).collect()}
    for (doc, term), w in got.items():
        assert vectors[doc][model.terms.index(term)] == pytest.approx(w)
    unseen = model.weights(docs(spark, "zz aa")).collect()
    assert [(r.term, r.weight) for r in unseen] == [("aa", 1.0)]


def test_limits_and_ngrams(spark):
    df = docs(spark, "red fox runs", "red fox sleeps", "red cat", "red dog", "red fox")
    model = V.fit_tfidf(df, stopwords=[])
    assert model.terms == ["fox", "red fox"]  # "red" is in all documents
    assert V.fit_vocabulary(df, max_features=2).terms == ["fox", "red"]
    with pytest.raises(ValueError):
        V.fit_vocabulary(df, min_df=9)


def test_counts_agree_with_count_vectorizer(spark, sf_dir):
    from pyspark.ml.feature import CountVectorizer

    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = V.fit_counts(df, max_features=300)
    tokens = df.withColumn("t", model.tokens(F.col("text")))
    theirs = CountVectorizer(inputCol="t", outputCol="v", vocabSize=300).fit(tokens)
    cf = {r.term: r.cf for r in model.table.collect()}
    floor = min(cf.values())
    assert {t for t in theirs.vocabulary if cf.get(t, 0) > floor} == {
        t for t, n in cf.items() if n > floor}
    total = model.term_rows(df).agg(F.sum("tf")).first()[0]
    assert total == sum(cf.values())


def test_corpus_and_lemma_table(spark):
    long = "word " * 12
    df = docs(spark, "short", long, "the " * 30, None)
    assert [r.doc_id for r in prepare_corpus(df).collect()] == [1]
    assert prepare_corpus(df, clean=False).count() == 2
    lemmas = spark.createDataFrame([("cats", "cat"), ("mice", "m")], "surface string, lemma string")
    got = clean_documents(docs(spark, "Cats and cats", "mice", "the"), lemmas).collect()
    assert {r.doc_id: r.cleaned_text for r in got} == {0: "cat cat", 1: "", 2: ""}


def test_svd_reconstructs_norms(spark):
    df = docs(spark, "aa bb cc", "aa bb", "cc dd", "dd ee aa")
    model = V.fit_vocabulary(df)
    vectors = model.tfidf_vectors(df)
    reduced = R.svd(model.weight_rows(df), len(model.terms), 3)
    got = np.array([r.reduced for r in reduced.orderBy("doc_id").collect()])
    x = np.array([r.features.toArray() for r in vectors.orderBy("doc_id").collect()])
    s = np.linalg.svd(x, compute_uv=False)
    assert np.linalg.norm(got, axis=0) == pytest.approx(s[:3])
    assert got.T @ got == pytest.approx(np.diag(s[:3] ** 2), abs=1e-8)
    # Most of these partitions are empty, whatever the number of cores.
    spread = R.svd(model.weight_rows(df.repartition(23)), len(model.terms), 3)
    again = np.array([r.reduced for r in spread.orderBy("doc_id").collect()])
    assert np.abs(again) == pytest.approx(np.abs(got))
    none = R.svd(model.weight_rows(df.limit(0)), len(model.terms), 3)
    assert none.collect() == []


def test_pca_is_centred_and_ordered(spark):
    rng = np.random.default_rng(0)
    x = rng.random((40, 5)) * [5, 1, 1, 3, 1] + 10
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>")
    got = np.array([r.embedding for r in R.pca(df, 3).orderBy("id").collect()])
    assert got.mean(axis=0) == pytest.approx([0, 0, 0], abs=1e-9)
    want = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1][:3]
    assert got.var(axis=0, ddof=1) == pytest.approx(want)
    assert R.projection(df, 2).columns == ["id", "component_1", "component_2"]
    assert R.projection(df, 5).orderBy("id").first().component_1 == x[0][0]


def test_lda_rows_sum_to_one(spark):
    df = docs(spark, "aa bb cc", "aa bb", "cc dd", "dd ee aa")
    model = V.fit_vocabulary(df)
    topics = R.lda(model.count_vectors(df, output="features"), 2).collect()
    assert [sum(r.topics) for r in topics] == pytest.approx([1.0] * 4)


def test_embed(spark):
    df = docs(spark, "aa bb", "", None).withColumnRenamed("text", "cleaned_text")
    hashed = {r.doc_id: np.array(r.embedding) for r in E.embed(df, width=16).collect()}
    assert np.linalg.norm(hashed[0]) == pytest.approx(1) and not hashed[1].any()
    sizes = []

    def encode(texts):
        assert len(texts) <= 2
        sizes.append(len(texts))
        return np.array([[len(t), 1.0] for t in texts])

    got = E.embed(df, encode, batch_size=2).collect()
    assert {r.doc_id: r.embedding for r in got} == {0: [5, 1], 1: [0, 1], 2: [0, 1]}


def test_pooling(spark):
    rows = [(1, 0, 1, [1.0, 2.0]), (1, 1, 1, [3.0, 4.0]), (1, 2, 0, [9.0, 9.0]), (2, 0, 0, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "doc_id long, tok_pos int, mask int, vec array<double>")
    mean = {r.doc_id: r.embedding for r in E.pool_tokens(df).collect()}
    assert mean == {1: [2, 3], 2: [0, 0]}
    first = {r.doc_id: r.embedding for r in E.pool_tokens(df, "cls").collect()}
    assert first == {1: [1, 2], 2: [5, 5]}
    with pytest.raises(ValueError):
        E.pool_tokens(df, "max")


def test_unmatched(spark):
    a = spark.createDataFrame([(1,), (2,)], "doc_id long")
    b = spark.createDataFrame([(2,), (3,)], "doc_id long")
    assert {tuple(r) for r in unmatched(a, b, "doc_id").collect()} == {(1, "left"), (3, "right")}


def test_products_of_sparse_rows_add_no_element_one_by_one(monkeypatch):
    from foliant.operators import reduction as R

    class Add:
        reduceat = staticmethod(np.add.reduceat)

    rng = np.random.default_rng(4)
    indices, values = rng.integers(0, 7, 40), rng.random(40)
    row_of = np.sort(rng.choice([0, 2, 3, 5], 40))  # rows 1 and 4 have no value
    basis = rng.random((7, 3))
    monkeypatch.setattr(R.np, "add", Add)
    got = R._times(indices, values, row_of, 6, basis)
    dense = np.zeros((6, 7))
    for i, v, r in zip(indices, values, row_of, strict=True):
        dense[r, i] = dense[r, i] + v
    assert np.allclose(got, dense @ basis)
    assert R._times(indices[:0], values[:0], row_of[:0], 2, basis).tolist() == [[0.0] * 3] * 2

"""Bag-of-words and TF-IDF: vocabulary fitting, long form and vector form.

Counting happens inside the row, so fitting costs one shuffle of (term, counts)
with map-side combine, and turning documents into vectors costs none.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.arrays import let, ngrams, token_counts
from foliant.functions.text import ENGLISH_STOPWORDS, WORD

MAX_FEATURES = 5000


def vector_tokens(
    text: Column, ngram: tuple[int, int] = (1, 1), stopwords: Sequence[str] = ()
) -> Column:
    """Lower-cased runs of two or more word characters, then n-grams of the kept ones."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(rf"[{WORD}]{{2,}}"), F.lit(0))
    if stopwords:
        tokens = F.filter(tokens, lambda t: ~t.isin(list(stopwords)))
    return ngrams(tokens, *ngram)


def _to_length_one(entries: Column) -> Column:
    """array<struct<index, tf, weight>> of array<struct<index, tf, raw>>."""
    norm = F.sqrt(F.aggregate(entries, F.lit(0.0), lambda acc, t: acc + t["raw"] * t["raw"]))
    return let(
        norm,
        lambda n: F.transform(
            entries, lambda t: F.struct(t["index"], t["tf"], (t["raw"] / n).alias("weight"))
        ),
    )


@dataclass
class Vocabulary:
    """A fitted vocabulary: at most ``max_features`` rows, hence broadcastable.

    ``table`` has term, index (alphabetical), cf, df, idf.
    """

    table: DataFrame
    terms: list[str]
    idf: list[float]
    n_docs: int
    ngram: tuple[int, int]
    stopwords: list[str]

    def tokens(self, text: Column) -> Column:
        return vector_tokens(text, self.ngram, self.stopwords)

    def _entries(self, docs: DataFrame, id_col: str, text: str, finish) -> tuple[DataFrame, Column]:
        """Rows, and the array that ``finish`` makes of their array<struct<index, tf, raw>>, by index.

        Map-only. The counted vector is bound once, and neither a filter nor a generator
        sees the array as a column: its conditions would move below the counting and
        count every text again.
        """
        known = docs.select(id_col, text).filter(F.col(text).isNotNull())
        idf = F.split(F.lit("\n".join(map(repr, self.idf))), "\n").cast("array<double>")

        def entries(v: Column) -> Column:
            return F.zip_with(
                v["indices"],
                v["values"],
                lambda i, n: F.struct(
                    i.alias("index"), n.cast("long").alias("tf"), (n * F.get(idf, i)).alias("raw")
                ),
            )

        counted = self.count_vectors(known, text=text, output="_counts")
        return counted, let(F.unwrap_udt("_counts"), lambda v: let(entries(v), finish))

    def _named(self, rows: DataFrame, entries: Column, id_col: str, *columns: Column | str) -> DataFrame:
        """One row per entry, with its term."""
        terms = F.split(F.lit("\n".join(self.terms)), "\n")
        long = rows.select(id_col, F.inline(entries))
        return long.select(id_col, F.get(terms, F.col("index")).alias("term"), "index", *columns)

    def term_rows(self, docs: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
        """id, term, index, tf, idf of the known terms; unseen terms vanish."""
        rows, entries = self._entries(docs, id_col, text, lambda e: e)
        return self._named(rows, entries, id_col, "tf", (F.col("raw") / F.col("tf")).alias("idf"))

    def weight_rows(
        self, docs: DataFrame, *, id_col: str = "doc_id", text: str = "text"
    ) -> DataFrame:
        """id, terms: array<struct<index, tf, weight>> scaled to length 1; empty without known terms."""

        rows, entries = self._entries(docs, id_col, text, _to_length_one)
        return rows.select(id_col, entries.alias("terms"))

    def weights(self, docs: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
        """Long TF-IDF: id, term, index, tf, weight."""
        rows, entries = self._entries(docs, id_col, text, _to_length_one)
        return self._named(rows, entries, id_col, "tf", "weight")

    def count_stage(self, output: str = "counts") -> CountVectorizerModel:
        return CountVectorizerModel.from_vocabulary(
            self.terms, inputCol="_tokens", outputCol=output
        )

    def tfidf_stages(self, output: str = "features") -> PipelineModel:
        """Map-only vector form: counts, times idf, scaled to length 1."""
        scale = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol="_counts", outputCol="_weighted"
        )
        norm = Normalizer(p=2.0, inputCol="_weighted", outputCol=output)
        return PipelineModel([self.count_stage("_counts"), scale, norm])

    def count_vectors(self, docs: DataFrame, *, text: str = "text", output: str = "counts") -> DataFrame:
        tokens = docs.withColumn("_tokens", self.tokens(F.col(text)))
        return self.count_stage(output).transform(tokens).drop("_tokens")

    def tfidf_vectors(
        self, docs: DataFrame, *, text: str = "text", output: str = "features"
    ) -> DataFrame:
        tokens = docs.withColumn("_tokens", self.tokens(F.col(text)))
        done = self.tfidf_stages(output).transform(tokens)
        return done.drop("_tokens", "_counts", "_weighted")


def fit_vocabulary(
    docs: DataFrame,
    *,
    text: str = "text",
    max_features: int = MAX_FEATURES,
    ngram: tuple[int, int] = (1, 1),
    min_df: int = 1,
    max_df: float = 1.0,
    stopwords: Sequence[str] = (),
) -> Vocabulary:
    """Most frequent terms within the document frequency limits, ties by term."""
    n_docs = docs.count()
    terms = docs.select(F.inline(token_counts(vector_tokens(F.col(text), ngram, stopwords))))
    stats = terms.groupBy(F.col("token").alias("term")).agg(
        F.sum("n").alias("cf"), F.count("*").alias("df")
    )
    kept = stats.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))
    # Only the capped vocabulary reaches the driver: it is the fitted model.
    top = kept.orderBy(F.desc("cf"), "term").limit(max_features).collect()
    if not top:
        raise ValueError("empty vocabulary; no term passed the document frequency limits")
    rows = [
        (r["term"], i, r["cf"], r["df"], math.log((1 + n_docs) / (1 + r["df"])) + 1)
        for i, r in enumerate(sorted(top, key=lambda r: r["term"]))
    ]
    table = docs.sparkSession.createDataFrame(
        rows, "term string, index int, cf long, df long, idf double"
    )
    return Vocabulary(
        table, [r[0] for r in rows], [r[4] for r in rows], n_docs, ngram, list(stopwords)
    )


def fit_counts(docs: DataFrame, **options) -> Vocabulary:
    """Bag-of-words preset: English stopwords, unigrams, 5,000 features."""
    return fit_vocabulary(docs, **{"stopwords": ENGLISH_STOPWORDS, **options})


def fit_tfidf(docs: DataFrame, **options) -> Vocabulary:
    """TF-IDF preset: uni- and bigrams in 2 documents or more and 80 % at most."""
    preset = {
        "stopwords": ENGLISH_STOPWORDS,
        "ngram": (1, 2),
        "min_df": 2,
        "max_df": 0.8,
    }
    return fit_vocabulary(docs, **{**preset, **options})

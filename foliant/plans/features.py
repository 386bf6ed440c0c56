"""All feature representations of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators.cleaning import prepare_corpus
from foliant.operators.reduction import svd
from foliant.operators.vectors import fit_counts, fit_tfidf
from foliant.session import durable

SVD_COMPONENTS = 50


def document_features(documents: DataFrame) -> DataFrame:
    """(doc_id, text) -> prepared text, TF-IDF, counts, SVD and statistics.

    Statistics cover every document, vectors only the prepared ones; the rest
    keeps null vectors.
    """
    # Cleaned once; fitting and transforming read the stored text.
    prepared = durable(prepare_corpus(documents).select("doc_id", "prepared"))
    tfidf, counts = fit_tfidf(prepared, text="prepared"), fit_counts(prepared, text="prepared")
    vectors = counts.count_vectors(
        tfidf.tfidf_vectors(prepared, text="prepared", output="tfidf"), text="prepared"
    )
    reduced = svd(
        tfidf.weight_rows(prepared, text="prepared"), len(tfidf.terms), SVD_COMPONENTS
    )
    stats = documents.select("doc_id", T.text_stats(F.col("text")).alias("stats"))
    return stats.join(vectors.join(reduced, "doc_id", "left"), "doc_id", "left")

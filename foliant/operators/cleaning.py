"""Corpus preparation and dictionary lemmas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators.joins import lookup
from foliant.session import durable


def prepare_corpus(
    documents: DataFrame,
    *,
    text: str = "text",
    clean: bool = True,
    min_length: int = 50,
    **options,
) -> DataFrame:
    """Drop empty and short documents, clean the rest, drop what became short.

    The first length test runs on the raw text, before any cleaning. The result
    has the column ``prepared``.
    """
    raw = F.col(text)
    long_enough = documents.filter((raw != "") & (F.length(raw) >= min_length))
    if not clean:
        return long_enough.withColumn("prepared", raw)
    cleaned = long_enough.withColumn("prepared", T.clean_text(raw, **options))
    return cleaned.filter((F.col("prepared") != "") & (F.length("prepared") >= min_length))


def clean_documents(
    documents: DataFrame,
    lemmas: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    stopwords: Sequence[str] | None = None,
    min_word_length: int = 2,
) -> DataFrame:
    """Clean with a lemma table (surface, lemma) of any size: id, cleaned_text.

    The dictionary is broadcast when its row count is proven small; otherwise
    the join shuffles, frequent words aside, see ``joins.lookup``.
    """
    words = stopwords if stopwords is not None else T.stopwords_for()
    tokens = T.normalized_tokens(F.col(text), stopwords=words)
    exploded = documents.select(id_col, F.posexplode_outer(tokens).alias("pos", "surface"))
    table = durable(lemmas.groupBy("surface").agg(F.min("lemma").alias("lemma")))
    kept = F.coalesce("lemma", "surface")
    joined = lookup(exploded, table, "surface", "left").select(
        id_col,
        F.when(F.length(kept) >= min_word_length, F.struct("pos", kept.alias("token"))).alias(
            "item"
        ),
    )
    # collect_list skips nulls, so a document without tokens ends up empty.
    return joined.groupBy(id_col).agg(
        F.array_join(F.sort_array(F.collect_list("item"))["token"], " ").alias("cleaned_text")
    )

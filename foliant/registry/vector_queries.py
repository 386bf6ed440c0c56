"""Vectors and embeddings (V*, D*, J2-J4)."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from foliant.functions.arrays import token_counts
from foliant.functions.text import ENGLISH_STOPWORDS
from foliant.operators import embeddings as E
from foliant.operators import reduction as R
from foliant.operators import vectors as V
from foliant.operators.cleaning import prepare_corpus
from foliant.operators.joins import unmatched
from foliant.plans.features import document_features
from foliant.registry.base import query, sql_list, table, texts
from foliant.registry.text_queries import RAW_WORDS, sql_clean


def terms_sql(source: str, *, stop: bool, bigrams: bool, prefix: str = "") -> str:
    """CTEs <prefix>c (doc_id, term, tf) over ``source`` (doc_id, text)."""
    keep = f"list_filter({{w}}, lambda w: w NOT IN ({sql_list(ENGLISH_STOPWORDS)}))" if stop else "{w}"
    words = keep.format(w=r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')")
    grams = f"SELECT doc_id, term FROM {prefix}t"
    if bigrams:
        grams += f""" UNION ALL SELECT doc_id, term || ' ' || next_term FROM (
          SELECT doc_id, term, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS next_term
          FROM {prefix}t) WHERE next_term IS NOT NULL"""
    return f"""{prefix}w AS (SELECT doc_id, {words} AS items FROM {source}),
      {prefix}t AS (SELECT doc_id, unnest(generate_series(1, len(items))) AS pos, unnest(items) AS term FROM {prefix}w),
      {prefix}c AS (SELECT doc_id, term, count(*) AS tf FROM ({grams}) GROUP BY ALL)"""


def vocabulary_sql(prefix: str, source: str, min_df: int = 1, max_df: float = 1.0) -> str:
    return f"""{prefix}n AS (SELECT count(*) AS n FROM {source}),
      {prefix}v AS (SELECT term, sum(tf) AS cf, count(*) AS df, ln((1 + any_value(n)) / (1.0 + count(*))) + 1 AS idf
        FROM {prefix}c, {prefix}n GROUP BY term
        HAVING count(*) >= {min_df} AND count(*) <= {max_df}::DOUBLE * any_value(n)
        ORDER BY cf DESC, term LIMIT 5000)"""


def weights_sql(terms: str, vocabulary: str) -> str:
    return f"""SELECT doc_id, term, tf, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS weight
      FROM {terms} JOIN {vocabulary} USING (term)"""


COUNT_SQL = f"""WITH {terms_sql('documents', stop=True, bigrams=False)}, {vocabulary_sql('', 'documents')}
  SELECT doc_id, term, tf FROM c SEMI JOIN v USING (term)"""

TFIDF_CTE = (
    f"{terms_sql('documents', stop=True, bigrams=True)}, {vocabulary_sql('', 'documents', 2, 0.8)}"
)
TFIDF_SQL = f"WITH {TFIDF_CTE} SELECT doc_id, term, tf, round(weight, 6) AS weight FROM ({weights_sql('c', 'v')})"


def documents(spark, sf_dir):
    return texts(spark, sf_dir, "documents").select("doc_id", "text")


@query("V1_count_vectors", COUNT_SQL)
def count_vectors(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return V.fit_counts(docs).term_rows(docs).select("doc_id", "term", "tf")


@query("V2_tfidf", TFIDF_SQL)
def tfidf(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = V.fit_tfidf(docs).weights(docs)
    return rows.select("doc_id", "term", "tf", F.round("weight", 6).alias("weight"))


@query(
    "V3_ngrams",
    f"""WITH {terms_sql('documents', stop=True, bigrams=True)}
    SELECT doc_id, term, tf FROM c WHERE contains(term, ' ')""",
)
def bigrams(spark, sf_dir):
    tokens = V.vector_tokens(F.col("text"), (2, 2), ENGLISH_STOPWORDS)
    return documents(spark, sf_dir).select("doc_id", F.inline(token_counts(tokens))).select(
        "doc_id", F.col("token").alias("term"), F.col("n").alias("tf")
    )


LABELLED_SQL = """train AS (SELECT d.doc_id, d.text, l.quality AS label FROM documents d JOIN labels l USING (doc_id)),
  test AS (SELECT doc_id, text FROM documents ANTI JOIN labels USING (doc_id))"""


def labelled(spark, sf_dir, label="quality"):
    """Documents with their label, and the documents nobody labelled."""
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label"))
    return docs.join(labels, "doc_id"), docs.join(labels, "doc_id", "left_anti")


@query(
    "V4_fit_transform",
    f"""WITH {LABELLED_SQL}, {terms_sql('train', stop=False, bigrams=False)},
      {vocabulary_sql('', 'train')}, {terms_sql('test', stop=False, bigrams=False, prefix='x')}
    SELECT doc_id, term, round(weight, 6) AS weight FROM ({weights_sql('xc', 'v')})""",
)
def fit_transform(spark, sf_dir):
    train, test = labelled(spark, sf_dir)
    rows = V.fit_vocabulary(train).weights(test)
    return rows.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("V5_reduce_svd")
def reduce_svd(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = V.fit_tfidf(docs)
    return R.svd(model.weight_rows(docs), len(model.terms), 50)


@query(
    "V5_full_rank",
    f"""WITH {terms_sql('documents', stop=False, bigrams=False)}, {vocabulary_sql('', 'documents').replace('LIMIT 5000', 'LIMIT 40')},
      weighted AS ({weights_sql('c', 'v')}), s AS (SELECT term, sum(weight) AS total FROM weighted GROUP BY term)
    SELECT doc_id, round(sum(weight * total), 6) AS with_all FROM weighted JOIN s USING (term) GROUP BY doc_id""",
)
def full_rank(spark, sf_dir):
    """With as many components as terms the products of the rows are kept: each with the sum of all."""
    docs = documents(spark, sf_dir)
    model = V.fit_vocabulary(docs, max_features=40)
    rows = R.svd(model.weight_rows(docs), len(model.terms), 40)
    total = rows.agg(vector_to_array(Summarizer.sum(array_to_vector("reduced"))).alias("s")).first()["s"]
    product = F.aggregate(
        F.zip_with("reduced", F.array(*map(F.lit, total)), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x
    )
    return rows.select("doc_id", F.round(product, 6).alias("with_all"))


@query("V6_reduce_lda")
def reduce_lda(spark, sf_dir):
    docs = documents(spark, sf_dir)
    vectors = V.fit_counts(docs).count_vectors(docs, output="features")
    return R.lda(vectors, 10).select("doc_id", "topics")


@query("V7_pca")
def reduce_pca(spark, sf_dir):
    return R.pca(texts(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 50)


@query(
    "V7_pca_norms",
    """WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(generate_series(1, len(embedding))) AS dim FROM embeddings)
    SELECT vec_id, round(sum((x - m) * (x - m)), 6) AS squared_norm
    FROM x JOIN (SELECT dim, avg(x) AS m FROM x GROUP BY dim) USING (dim) GROUP BY vec_id""",
)
def pca_norms(spark, sf_dir):
    """With all components the distances from the mean are kept."""
    rows = texts(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    width = rows.select(F.size("embedding").alias("d")).first()["d"]
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    return R.pca(rows, width).select("vec_id", F.round(square, 6).alias("squared_norm"))


@query(
    "V8_document_features",
    f"""WITH prep AS (SELECT doc_id, text FROM (SELECT doc_id, {sql_clean()} AS text FROM documents
        WHERE length(text) >= 50) WHERE length(text) >= 50),
      {terms_sql('prep', stop=True, bigrams=False)}, {vocabulary_sql('', 'prep')},
      k AS (SELECT doc_id, count(*) AS n FROM c SEMI JOIN v USING (term) GROUP BY doc_id)
    SELECT d.doc_id, len({RAW_WORDS.replace("text", "d.text")}) AS word_count,
      p.doc_id IS NOT NULL AS prepared, CASE WHEN p.doc_id IS NOT NULL THEN coalesce(k.n, 0) END AS count_terms
    FROM documents d LEFT JOIN prep p ON p.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id""",
)
def features(spark, sf_dir):
    bundle = document_features(documents(spark, sf_dir))
    terms = F.size(F.filter(vector_to_array("counts"), lambda x: x > 0))
    return bundle.select(
        "doc_id",
        "stats.word_count",
        F.col("prepared").isNotNull().alias("prepared"),
        F.when(F.col("reduced").isNotNull() | F.col("prepared").isNotNull(), terms).alias("count_terms"),
    )


@query(
    "D1_embed",
    """SELECT doc_id, CAST(length(text) AS DOUBLE) AS dim_0,
      CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS dim_1 FROM documents""",
)
def embed_with_encoder(spark, sf_dir):
    def encode(batch):
        return np.array([[len(t), t.count("e")] for t in batch], dtype=np.float32)

    rows = E.embed(documents(spark, sf_dir), encode, text="text")
    axes = [F.get("embedding", F.lit(i)).cast("double").alias(f"dim_{i}") for i in range(2)]
    return rows.select("doc_id", *axes)


@query("D1_embed_hashed")
def embed_hashed(spark, sf_dir):
    corpus = prepare_corpus(documents(spark, sf_dir))
    return E.embed(corpus, text="prepared")


@query(
    "J4_carry_columns",
    "SELECT doc_id, lang, source, CAST(length(text) AS DOUBLE) AS dim_0 FROM documents",
)
def carry_columns(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents")

    def encode(batch):
        return np.array([[len(t)] for t in batch], dtype=np.float32)

    rows = E.embed(docs, encode, text="text", keep=["doc_id", "lang", "source"])
    return rows.select(
        "doc_id", "lang", "source", F.get("embedding", F.lit(0)).cast("double").alias("dim_0")
    )


def turn_vectors(spark, sf_dir):
    """Every turn as a token with a two-dimensional vector."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").alias("tok_pos"),
        (F.col("role") != "system").cast("int").alias("mask"),
        F.array(F.length("text").cast("double"), F.col("turn").cast("double")).alias("vec"),
    )


@query(
    "D2_pool_tokens",
    """WITH t AS (SELECT conv_id AS doc_id, length(text) AS a, turn AS b,
        CAST(role <> 'system' AS INT) AS m, turn FROM conversations)
    SELECT doc_id, 'mean' AS method, round(sum(a * m) / greatest(sum(m), 1e-9), 6) AS dim_0,
      round(sum(b * m) / greatest(sum(m), 1e-9), 6) AS dim_1 FROM t GROUP BY doc_id
    UNION ALL SELECT doc_id, 'cls', arg_min(a, turn), arg_min(b, turn) FROM t GROUP BY doc_id""",
)
def pool(spark, sf_dir):
    tokens, parts = turn_vectors(spark, sf_dir), []
    for method in ("mean", "cls"):
        axes = [F.round(F.get("embedding", F.lit(i)), 6).alias(f"dim_{i}") for i in range(2)]
        parts.append(
            E.pool_tokens(tokens, method).select("doc_id", F.lit(method).alias("method"), *axes)
        )
    return parts[0].unionByName(parts[1])


@query(
    "D3_tfidf_weighted_embeddings",
    f"""WITH {TFIDF_CTE}, weighted AS ({weights_sql('c', 'v')}),
      s AS (SELECT doc_id, sum(weight) / (sqrt(sum(weight * weight)) + 1e-8) / (SELECT count(*) FROM v) AS scale
            FROM weighted GROUP BY doc_id)
    SELECT vec_id AS doc_id, unnest(generate_series(1, len(embedding))) AS pos,
      unnest(list_transform(embedding, lambda x: round(CAST(x AS DOUBLE) * coalesce(scale, 0), 9))) AS value
    FROM embeddings JOIN documents d ON vec_id = d.doc_id LEFT JOIN s ON vec_id = s.doc_id""",
)
def weighted_embeddings(spark, sf_dir):
    docs = documents(spark, sf_dir)
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding"
    )
    model = V.fit_tfidf(docs)
    paired = vectors.join(docs.select("doc_id"), "doc_id")
    scaled = E.tfidf_weighted_embeddings(paired, model.weights(docs), len(model.terms))
    rows = scaled.select("doc_id", F.posexplode("embedding").alias("pos", "value"))
    return rows.select("doc_id", (F.col("pos") + 1).alias("pos"), F.round("value", 9).alias("value"))


@query(
    "D4_embedding_summary",
    """SELECT 'table' AS method, 'given' AS model_name, max(len(embedding)) AS embedding_dim,
      count(*) AS num_documents FROM embeddings""",
)
def embedding_summary(spark, sf_dir):
    return E.embedding_summary(table(spark, sf_dir, "embeddings"), "table", "given")


@query("J2_text_with_label", "SELECT doc_id, length(text) AS chars, quality FROM documents JOIN labels USING (doc_id)")
def text_with_label(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("chars"))
    return docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")


@query(
    "J3_unmatched",
    """SELECT doc_id, 'left' AS side FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)
    UNION ALL SELECT vec_id, 'right' FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)""",
)
def positional_pairs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return unmatched(docs, vectors, "doc_id")

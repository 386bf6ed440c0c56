"""One query per training-data operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import (
    byte_bpe,
    chat,
    divergence,
    embed_dedup,
    exact_kmeans,
    fingerprints,
    mixing,
    packing,
    quality,
    sharding,
    simhash,
    token_store,
    toxicity,
)
from foliant.llm.common import read, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORDS = "word_bpe_49k.json"
RANKS = "byte_bpe_50k.tiktoken"
# A conversation whose texts look like control strings.
ESCAPED = [
    (-7, 0, "user", "\\### Assistant: </turn> ok"),
    (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _labelled(spark: SparkSession, sf_dir: str, label: str) -> tuple[DataFrame, DataFrame]:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col(label).alias("label"))
    return docs, labels


@query("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query("op2_quality_classifier")
def op2_quality_classifier(spark, sf_dir):
    docs, labels = _labelled(spark, sf_dir, "quality")
    return quality.classify(docs, labels).withColumnRenamed("id", "doc_id")


@query("op3_document_fingerprints")
def op3_document_fingerprints(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return fingerprints.fingerprint_documents(docs).withColumnRenamed("id", "doc_id")


@query(
    "op4_chat_formatting",
    """
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
    ),
    placed AS (
        SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
            sum(length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))
                + length(replace(replace(text, '&', '&amp;'), '<', '&lt;'))
                + length('<turn ></turn>') + 1) OVER w AS so_far
        FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(so_far) FILTER (WHERE role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars
    FROM placed GROUP BY conv_id
    """,
)
def op4_chat_formatting(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(ESCAPED, "conv_id long, turn long, role string, text string")
    examples = chat.prefix_targets(turns.unionByName(extra))
    return chat.read_back(examples).withColumnRenamed("id", "conv_id")


@query("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    docs, labels = _labelled(spark, sf_dir, "toxic")
    return toxicity.classify(docs, labels).withColumnRenamed("id", "doc_id")


@query("op6_token_store")
def op6_token_store(spark, sf_dir):
    rows = token_store.roundtrip(read(spark, sf_dir, "documents"), tokenizer_path(WORDS))
    return rows.select(
        F.col("id").alias("doc_id"), "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )


@query("op7_sharding")
def op7_sharding(spark, sf_dir):
    rows = sharding.shard_by_bytes(read(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op8_byte_bpe")
def op8_byte_bpe(spark, sf_dir):
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    rows = byte_bpe.roundtrip(docs, tokenizer_path(RANKS), public_tokenizers.PATTERN)
    return rows.withColumnRenamed("id", "doc_id")


@query(
    "op9_embedding_near_dedup",
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
    ),
    links AS (
        SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
    ),
    reach(u, v) AS (
        SELECT vec_id, vec_id FROM embeddings
        UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
    )
    SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.u = e.vec_id) AS n_links,
        min(r.v) AS component_id, min(r.v) = e.vec_id AS kept
    FROM embeddings e JOIN reach r ON r.u = e.vec_id GROUP BY e.vec_id
    """,
)
def op9_embedding_near_dedup(spark, sf_dir):
    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op10_packing")
def op10_packing(spark, sf_dir):
    rows = packing.pack(read(spark, sf_dir, "documents"), tokenizer_path(WORDS))
    return rows.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        F.col("n").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )


@query("op11_source_mixing")
def op11_source_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents")).taken().withColumnRenamed("id", "doc_id")


def _kmeans_sql(k: int, rounds: int) -> str:
    """Plain k-means on integers: every distance anew in every round."""
    steps = [
        """
        v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                list_transform(embedding, lambda c: CAST(floor(c::DOUBLE * 256) AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        )""",
        f"""
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, x) - 1 AS cluster, x AS c
            FROM v ORDER BY cluster LIMIT {k}
        )""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""
        a{n} AS MATERIALIZED (
            SELECT r, min_by(cluster, d * 1000 + cluster) AS cluster, min(d) AS d
            FROM (SELECT r, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
                AS HUGEINT) AS d FROM v, c{n})
            GROUP BY r
        )""")
        if n < rounds:
            steps.append(f"""
        c{n + 1} AS MATERIALIZED (
            SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{n} o LEFT JOIN (
                SELECT cluster, list(CAST(CASE WHEN s < 0 THEN -((-s + n - 1) // n) ELSE s // n END AS BIGINT) ORDER BY i) AS c
                FROM (
                    SELECT cluster, i, sum(y)::HUGEINT AS s, count(*)::HUGEINT AS n
                    FROM (SELECT cluster, unnest(x) AS y, unnest(range(64)) AS i FROM a{n} JOIN v USING (r))
                    GROUP BY cluster, i
                ) GROUP BY cluster
            ) m USING (cluster)
        )""")
    return f"""
        WITH {",".join(steps)}
        SELECT v.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
            CAST(sum(a.d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
            CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(c.c, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} c ON c.cluster = a.cluster
    """


@query("op12_centroid_clustering", _kmeans_sql(exact_kmeans.CENTROIDS, exact_kmeans.ROUNDS))
def op12_centroid_clustering(spark, sf_dir):
    found, centroids = exact_kmeans.cluster_vectors(read(spark, sf_dir, "embeddings"))
    return exact_kmeans.describe_clusters(found, centroids).drop("x").withColumnRenamed("id", "vec_id")


@query(
    "op13_source_divergence",
    """
    WITH d AS MATERIALIZED (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ),
    w AS MATERIALIZED (
        SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
    ),
    kept AS MATERIALIZED (
        SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10
    ),
    size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    grp AS (SELECT DISTINCT lang, source FROM d),
    seen AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
    dense AS (
        SELECT g.lang, g.source, k.term, coalesce(s.n, 0)::HUGEINT AS n
        FROM grp g JOIN kept k ON g.lang = k.lang
        LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
    ),
    p AS MATERIALIZED (
        SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
        FROM dense JOIN size USING (lang)
    ),
    q AS (
        SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
        FROM kept JOIN size USING (lang)
    ),
    pair AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY a.lang, a.source, b.source
    ),
    found AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0) AS value
        FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q)
        FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
    )
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
        FROM found
    ) WHERE part = 'pair' OR rank <= 10
    """,
)
def op13_source_divergence(spark, sf_dir):
    return divergence.divergence(read(spark, sf_dir, "documents"))

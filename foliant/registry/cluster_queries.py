"""Clustering, cluster scores and plot data (C*, E7-E12, E16, F7, J1, J5, U2, P3, P4)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliant.functions import charts
from foliant.operators import cluster_metrics as Q
from foliant.operators import clustering as C
from foliant.operators import pairs
from foliant.operators.merge_tree import ward_merges
from foliant.operators.reduction import projection
from foliant.registry.base import query, table, texts
from foliant.registry.metric_queries import CENTERS_SQL, rounded

EPS, MIN_SAMPLES = 1.15, 5


def vectors(spark, sf_dir):
    return texts(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def by_label(spark, sf_dir):
    """The given labels as a clustering."""
    return vectors(spark, sf_dir).withColumn("cluster", F.col("label"))


def label_centers(spark, sf_dir):
    return C.centroids(vectors(spark, sf_dir), cluster="label").select("cluster", "center")


def nearest(spark, sf_dir):
    points = vectors(spark, sf_dir)
    return points.join(C.assign_to_centers(points, label_centers(spark, sf_dir)), "id")


NEAREST_SQL = f"""{CENTERS_SQL}, nearest AS (
  SELECT vec_id AS id, arg_min(c.label, gap) AS cluster, min(gap) AS gap, any_value(truth) AS label
  FROM (SELECT vec_id, e.label AS truth, c.label, list_distance(embedding::DOUBLE[], center) AS gap
        FROM embeddings e, centers c) c GROUP BY vec_id)"""


@query("C1_kmeans")
def kmeans(spark, sf_dir):
    points = vectors(spark, sf_dir)
    labels, _, inertia = C.kmeans(points, 5)
    return labels.withColumn("inertia", F.lit(inertia))


@query(
    "C1_lloyd_step",
    f"""WITH {NEAREST_SQL}, dims AS (
      SELECT cluster, unnest(generate_series(1, len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x
      FROM nearest JOIN embeddings ON id = vec_id)
    SELECT cluster, dim, round(avg(x), 6) AS value FROM dims GROUP BY ALL""",
)
def lloyd_step(spark, sf_dir):
    moved = C.lloyd_step(vectors(spark, sf_dir), label_centers(spark, sf_dir))
    rows = moved.select("cluster", F.posexplode("center").alias("dim", "value"))
    return rounded(rows.withColumn("dim", F.col("dim") + 1))


@query(
    "C2_assign_to_centers",
    f"WITH {NEAREST_SQL} SELECT id, cluster, round(gap * gap, 6) AS squared_distance FROM nearest",
)
def assign(spark, sf_dir):
    return rounded(C.assign_to_centers(vectors(spark, sf_dir), label_centers(spark, sf_dir)))


EDGES_SQL = f"""near AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM embeddings a JOIN embeddings b
  ON list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) <= {EPS}),
degree AS (SELECT u, count(*) AS n FROM near GROUP BY u)"""


@query(
    "C3_dbscan",
    f"""WITH RECURSIVE {EDGES_SQL},
    core AS (SELECT u AS id FROM degree WHERE n >= {MIN_SAMPLES}),
    links AS (SELECT u, v FROM near WHERE u IN (SELECT id FROM core) AND v IN (SELECT id FROM core)),
    reach AS (SELECT id, id AS root FROM core
              UNION SELECT v, root FROM reach JOIN links ON u = reach.id),
    comp AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
    joined AS (SELECT id, root FROM comp UNION ALL
      SELECT near.u, min(root) FROM near JOIN comp ON comp.id = near.v
      WHERE near.u NOT IN (SELECT id FROM core) GROUP BY near.u),
    numbered AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM joined)
    SELECT vec_id AS id, coalesce(cluster, -1) AS cluster FROM embeddings LEFT JOIN numbered ON id = vec_id""",
)
def dbscan(spark, sf_dir):
    return C.dbscan(vectors(spark, sf_dir), EPS, MIN_SAMPLES)


@query(
    "J5_neighbor_counts",
    f"WITH {EDGES_SQL} SELECT u AS id, n AS degree FROM degree",
)
def neighbor_counts(spark, sf_dir):
    points = vectors(spark, sf_dir).select(
        "id", F.col("embedding").cast("array<double>").alias("vec"), F.lit(1).cast("long").alias("weight")
    )
    return pairs.neighbor_counts(points, EPS)


@query("C4_hierarchical")
def hierarchical(spark, sf_dir):
    return C.hierarchical(vectors(spark, sf_dir), 5)


@query("C4_bisecting")
def bisecting(spark, sf_dir):
    return C.hierarchical(vectors(spark, sf_dir), 5, linkage="bisecting")


@query(
    "C4_ward_heights",
    """WITH x AS (SELECT unnest(embedding)::DOUBLE AS x, unnest(generate_series(1, len(embedding))) AS dim FROM embeddings)
    SELECT (SELECT count(*) - 1 FROM embeddings) AS merges,
      (SELECT count(*) - count(DISTINCT embedding) FROM embeddings) AS copies,
      round((SELECT sum((x - m) * (x - m)) FROM x JOIN (SELECT dim, avg(x) AS m FROM x GROUP BY dim) USING (dim)), 6)
        AS total_height""",
)
def ward_heights(spark, sf_dir):
    """All merges together grow the sum of squares from nothing to the whole."""
    tree = ward_merges(vectors(spark, sf_dir))
    return tree.agg(
        F.count("*").alias("merges"),
        F.count_if(F.col("height") == 0).alias("copies"),
        F.round(F.sum("height"), 6).alias("total_height"),
    )


def planted(spark, sf_dir):
    """Vectors with their labels moved far apart on a further axis."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        "label",
        F.concat(F.col("embedding").cast("array<double>"), F.array(F.col("label") * 1000.0)).alias("embedding"),
    )


PLANTED_SQL = """SELECT vec_id AS id, CAST(dense_rank() OVER (ORDER BY first) - 1 AS INTEGER) AS cluster
    FROM (SELECT vec_id, min(vec_id) OVER (PARTITION BY label) AS first FROM embeddings)"""


@query("C4_ward_planted", PLANTED_SQL)
def ward_planted(spark, sf_dir):
    """Labels moved far apart are what the tree cuts last."""
    moved = planted(spark, sf_dir)
    groups = moved.select("label").distinct().count()
    return C.ward(moved.select("id", "embedding"), groups)


@query(
    "C5_planted_methods",
    f"""SELECT method, id, cluster FROM ({PLANTED_SQL}), (SELECT unnest(['kmeans', 'dbscan', 'hierarchical', 'bisecting']) AS method)""",
)
def planted_methods(spark, sf_dir):
    """Every method finds groups that lie far apart; numbered by their first id."""
    moved = planted(spark, sf_dir)
    groups, parts = moved.select("label").distinct().count(), None
    for method in ("kmeans", "dbscan", "hierarchical", "bisecting"):
        found = C.cluster_documents(moved.select("id", "embedding"), method, groups, eps=100.0)
        firsts = found.groupBy("cluster").agg(F.min("id").alias("first"))
        order = Window.orderBy("first")  # one row per cluster
        numbers = firsts.select("cluster", (F.row_number().over(order) - 1).alias("number"))
        part = found.join(numbers, "cluster").select(F.lit(method).alias("method"), "id", F.col("number").alias("cluster"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query("C5_cluster_documents")
def cluster_documents(spark, sf_dir):
    return C.cluster_documents(vectors(spark, sf_dir), "kmeans", 5).select("id", "cluster")


@query("C6_compare_clusterings")
def compare_clusterings(spark, sf_dir):
    methods = ["kmeans", "dbscan", "hierarchical", "bisecting"]
    return C.compare_clusterings(vectors(spark, sf_dir), methods, reduce=False, eps=EPS, min_samples=MIN_SAMPLES)


ASSIGNED_SQL = """WITH docs AS (SELECT doc_id, source || '/' || doc_id || '.txt' AS file_path FROM documents),
  labels_ AS (SELECT vec_id AS doc_id, label - 1 AS cluster FROM embeddings)"""


def assignments(spark, sf_dir):
    path = F.concat_ws("/", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    docs = table(spark, sf_dir, "documents").select("doc_id", path.alias("file_path"))
    labels = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), (F.col("label") - 1).alias("cluster")
    )
    return C.cluster_assignments(labels, docs)


@query(
    "C7_cluster_assignments",
    f"""{ASSIGNED_SQL} SELECT doc_id, file_path, cluster, cluster = -1 AS is_noise
    FROM docs JOIN labels_ USING (doc_id)""",
)
def cluster_assignments(spark, sf_dir):
    return assignments(spark, sf_dir)


@query(
    "J1_label_with_document",
    f"""{ASSIGNED_SQL} SELECT cluster, count(*) AS documents, min(file_path) AS first_path
    FROM docs JOIN labels_ USING (doc_id) GROUP BY cluster""",
)
def label_with_document(spark, sf_dir):
    return assignments(spark, sf_dir).groupBy("cluster").agg(
        F.count("*").alias("documents"), F.min("file_path").alias("first_path")
    )


# Cluster numbers shifted by one, so that label 0 plays the noise.
NOISY_SQL = "noisy AS (SELECT vec_id AS id, embedding, label, label - 1 AS cluster FROM embeddings)"


def noisy(spark, sf_dir):
    return vectors(spark, sf_dir).withColumn("cluster", F.col("label") - 1)


@query("F7_noise_mask", f"WITH {NOISY_SQL} SELECT id, cluster FROM noisy WHERE cluster <> -1")
def noise_mask(spark, sf_dir):
    return Q.without_noise(noisy(spark, sf_dir)).select("id", "cluster")


@query(
    "U2_distinct_clusters",
    f"WITH {NOISY_SQL} SELECT count(DISTINCT cluster) FILTER (cluster <> -1) AS n_clusters FROM noisy",
)
def distinct_clusters(spark, sf_dir):
    return Q.cluster_counts(noisy(spark, sf_dir)).select("n_clusters")


def silhouette_sql(source: str) -> str:
    """Per-point silhouette of <source> (id, embedding, cluster)."""
    return f"""valid AS (SELECT * FROM {source} WHERE cluster <> -1),
    sizes AS (SELECT cluster, count(*) AS size FROM valid GROUP BY cluster),
    sums AS (SELECT a.id, a.cluster AS own, b.cluster AS other,
        sum(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS total
      FROM valid a, valid b GROUP BY ALL),
    ab AS (SELECT id, max(size) FILTER (own = other) AS own_size,
        max(total / nullif(size - 1, 0)) FILTER (own = other) AS a,
        min(total / size) FILTER (own <> other) AS b
      FROM sums JOIN sizes ON sizes.cluster = other GROUP BY id),
    samples AS (SELECT id, CASE WHEN own_size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab)"""


@query(
    "E7_silhouette_samples",
    f"WITH {NOISY_SQL}, {silhouette_sql('noisy')} SELECT id, round(silhouette, 6) AS silhouette FROM samples",
)
def silhouette_samples(spark, sf_dir):
    return rounded(Q.silhouette_samples(noisy(spark, sf_dir)))


@query(
    "E7_silhouette",
    f"WITH {NOISY_SQL}, {silhouette_sql('noisy')} SELECT round(avg(silhouette), 6) AS silhouette_score FROM samples",
)
def silhouette(spark, sf_dir):
    return rounded(Q.silhouette_score(noisy(spark, sf_dir)))


SQUARED_SQL = silhouette_sql("noisy").replace("sum(list_distance(", "sum(pow(list_distance(").replace(
    "b.embedding::DOUBLE[])) AS total", "b.embedding::DOUBLE[]), 2)) AS total"
)


@query(
    "E7_silhouette_squared",
    f"WITH {NOISY_SQL}, {SQUARED_SQL} SELECT round(avg(silhouette), 6) AS silhouette_score FROM samples",
)
def silhouette_squared(spark, sf_dir):
    points = noisy(spark, sf_dir)
    score = Q.silhouette_squared(points)
    return points.agg(F.round(F.max(F.lit(score)), 6).alias("silhouette_score"))


DISPERSION_SQL = f"""{NOISY_SQL}, dims AS (
  SELECT id, cluster, unnest(generate_series(1, len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x
  FROM noisy WHERE cluster <> -1),
centers AS (SELECT cluster, dim, avg(x) AS c, count(*) AS n FROM dims GROUP BY ALL),
means AS (SELECT dim, avg(x) AS m FROM dims GROUP BY dim),
gaps AS (SELECT id, cluster, sum((x - c) * (x - c)) AS sq FROM dims JOIN centers USING (cluster, dim) GROUP BY ALL)"""


@query(
    "E8_calinski_harabasz",
    f"""WITH {DISPERSION_SQL}, t AS (SELECT
        (SELECT sum(n * (c - m) * (c - m)) FROM centers JOIN means USING (dim)) AS between_,
        (SELECT sum(sq) FROM gaps) AS within_, (SELECT count(*) FROM gaps) AS n,
        (SELECT count(DISTINCT cluster) FROM gaps) AS k)
    SELECT round((between_ / (k - 1)) / (within_ / (n - k)), 6) AS calinski_harabasz_score FROM t""",
)
def calinski_harabasz(spark, sf_dir):
    return rounded(Q.calinski_harabasz(noisy(spark, sf_dir)))


@query(
    "E9_davies_bouldin",
    f"""WITH {DISPERSION_SQL}, s AS (SELECT cluster, avg(sqrt(sq)) AS s FROM gaps GROUP BY cluster),
    d AS (SELECT a.cluster AS i, b.cluster AS j, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS d
          FROM centers a JOIN centers b ON a.dim = b.dim AND a.cluster <> b.cluster GROUP BY ALL),
    worst AS (SELECT i, max((x.s + y.s) / d) AS w FROM d JOIN s x ON x.cluster = i JOIN s y ON y.cluster = j GROUP BY i)
    SELECT round(avg(w), 6) AS davies_bouldin_score FROM worst""",
)
def davies_bouldin(spark, sf_dir):
    return rounded(Q.davies_bouldin(noisy(spark, sf_dir)))


@query(
    "E10_score_guards",
    """SELECT 'all_noise' AS clustering, -1.0::DOUBLE AS silhouette_score, -1.0::DOUBLE AS calinski_harabasz_score,
      'inf'::DOUBLE AS davies_bouldin_score, 0 AS n_clusters, 1.0::DOUBLE AS outlier_ratio FROM (SELECT count(*) FROM embeddings)
    UNION ALL SELECT 'one_cluster', -1, -1, 'inf'::DOUBLE, count(DISTINCT label > -1),
      avg(CAST(label < 0 AS INT)) FROM embeddings""",
)
def score_guards(spark, sf_dir):
    points = vectors(spark, sf_dir)
    noise = Q.internal_scores(points.withColumn("cluster", F.lit(-1)))
    single = Q.internal_scores(points.withColumn("cluster", F.lit(0)))
    return noise.select(F.lit("all_noise").alias("clustering"), "*").unionByName(
        single.select(F.lit("one_cluster").alias("clustering"), "*")
    )


@query(
    "E11_external_scores",
    f"""WITH {NEAREST_SQL}, cells AS (SELECT label AS t, cluster AS c, count(*)::DOUBLE AS n FROM nearest GROUP BY ALL),
    a AS (SELECT t, sum(n) AS m FROM cells GROUP BY t), b AS (SELECT c, sum(n) AS m FROM cells GROUP BY c),
    s AS (SELECT (SELECT sum(n) FROM cells) AS n,
      (SELECT sum(n * (n - 1) / 2) FROM cells) AS pn, (SELECT sum(m * (m - 1) / 2) FROM a) AS pa,
      (SELECT sum(m * (m - 1) / 2) FROM b) AS pb),
    e AS (SELECT n, pn, pa, pb, pa * pb / (n * (n - 1) / 2) AS expected,
      (SELECT -sum(m / n * ln(m / n)) FROM a) AS ht, (SELECT -sum(m / n * ln(m / n)) FROM b) AS hc,
      (SELECT sum(x.n / s.n * ln(x.n * s.n / (a.m * b.m))) FROM cells x JOIN a ON a.t = x.t JOIN b ON b.c = x.c) AS mi FROM s)
    SELECT round((pn - expected) / ((pa + pb) / 2 - expected), 6) AS adjusted_rand_score,
      round(mi / ((ht + hc) / 2), 6) AS normalized_mutual_info, round(mi / ht, 6) AS homogeneity_score,
      round(mi / hc, 6) AS completeness_score, round(2 * (mi / ht) * (mi / hc) / (mi / ht + mi / hc), 6) AS v_measure_score
    FROM e""",
)
def external_scores(spark, sf_dir):
    return rounded(Q.external_scores(nearest(spark, sf_dir)))


@query(
    "E12_cluster_statistics",
    f"""WITH {NOISY_SQL}, sizes AS (SELECT cluster, count(*) AS n FROM noisy GROUP BY cluster)
    SELECT count(*) FILTER (cluster <> -1) AS num_clusters,
      CAST(sum(n) FILTER (cluster = -1) AS BIGINT) AS num_noise_points,
      round(sum(n) FILTER (cluster = -1) / sum(n), 6) AS noise_ratio,
      round(avg(n) FILTER (cluster <> -1), 6) AS avg_cluster_size,
      round(stddev_pop(n) FILTER (cluster <> -1), 6) AS std_cluster_size FROM sizes""",
)
def cluster_statistics(spark, sf_dir):
    return rounded(Q.cluster_statistics(noisy(spark, sf_dir)))


@query("E16_evaluate_clustering")
def evaluate_clustering(spark, sf_dir):
    parts = Q.evaluate_clustering(noisy(spark, sf_dir), "label")
    merged = None
    for name, df in parts.items():
        row = df.select(F.lit(name).alias("part"), F.to_json(F.struct("*")).alias("value"))
        merged = row if merged is None else merged.unionByName(row)
    return merged


@query("P3_projection")
def plot_projection(spark, sf_dir):
    points = noisy(spark, sf_dir).select("id", "embedding", "cluster")
    return projection(points, 2).withColumn("is_noise", F.col("cluster") == C.NOISE)


@query(
    "P3_raw_axes",
    """SELECT vec_id AS id, embedding[1]::DOUBLE AS component_1, embedding[2]::DOUBLE AS component_2 FROM embeddings""",
)
def plot_raw_axes(spark, sf_dir):
    """Vectors of no more axes than the plot are shown as they are."""
    short = vectors(spark, sf_dir).select("id", F.slice(F.col("embedding").cast("array<double>"), 1, 2).alias("embedding"))
    return projection(short, 3)


@query("P3_projection_3d")
def plot_projection_3d(spark, sf_dir):
    return projection(noisy(spark, sf_dir).select("id", "embedding", "cluster"), 3)


@query(
    "P4_hover_text",
    """SELECT doc_id, left(text, 100) || '...' AS hover, 'Point ' || doc_id AS plain FROM documents""",
)
def hover_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        charts.hover_text(F.col("doc_id"), F.col("text")).alias("hover"),
        charts.hover_text(F.col("doc_id")).alias("plain"),
    )

"""Files, validation and extraction (S*, F1-F4) and stored folders (L1-L3, L6)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foliant.operators import extraction as X
from foliant.operators import metrics as M
from foliant.operators import validation as V
from foliant.operators.embeddings import embed
from foliant.operators.vectors import fit_counts
from foliant.plans import workflow
from foliant.plans.process import process_documents
from foliant.registry.base import query, table, texts
from foliant.registry.metric_queries import METRICS_SQL, all_preds, rounded
from foliant.registry.text_queries import loaded_documents, sql_tokens
from foliant.registry.vector_queries import COUNT_SQL
from foliant.session import durable, scratch_folder
from foliant.sources import files as S
from foliant.sources import sinks

# Ten kinds of files made from the documents: suffix, leading bytes (hex).
KINDS = [
    (".txt", ""),
    (".TXT", ""),
    (".csv", ""),
    (".json", ""),
    (".png", "89504E470D0A1A0A"),
    (".jpg", ""),
    (".pdf", "255044462D312E340A2F54797065202F506167650A"),
    ("", ""),
    (".docx", ""),
    (".pdf", "255044462D312E340A"),
]


def document_files(spark, sf_dir):
    """Every document as a file: path, length, content. Images without a
    signature and PDFs without a page are among them."""
    docs = texts(spark, sf_dir, "documents").select("doc_id", "text")
    kind = (F.col("doc_id") % len(KINDS)).cast("int")
    suffix = F.get(F.array(*[F.lit(s) for s, _ in KINDS]), kind)
    magic = F.unhex(F.get(F.array(*[F.lit(m) for _, m in KINDS]), kind))
    key = F.col("doc_id").cast("string")
    body = (
        F.when(
            suffix == ".csv",
            F.concat(
                F.lit("doc_id,text\n"), key, F.lit(',"'),
                F.replace("text", F.lit('"'), F.lit('""')), F.lit('"\n'),
            ),
        )
        .when(suffix == ".json", F.to_json(F.struct("doc_id", "text")))
        .otherwise(F.col("text"))
    )
    content = F.concat(magic, F.encode(body, "UTF-8"))
    return docs.select(
        F.concat(F.lit("/data/in/doc."), key, suffix).alias("path"),
        F.octet_length(content).cast("long").alias("length"),
        content.alias("content"),
    )


_SUFFIX = "CASE doc_id % 10 " + " ".join(f"WHEN {i} THEN '{s}'" for i, (s, _) in enumerate(KINDS)) + " END"
_MAGIC = "CASE doc_id % 10 " + " ".join(f"WHEN {i} THEN {len(m) // 2}" for i, (_, m) in enumerate(KINDS)) + " END"
FILES_SQL = f"""files AS (
  SELECT doc_id, text, '/data/in/doc.' || doc_id || {_SUFFIX} AS path,
    CASE WHEN {_SUFFIX} = '' THEN '.' || doc_id ELSE lower({_SUFFIX}) END AS extension, doc_id % 10 AS kind,
    {_MAGIC} + strlen(CASE {_SUFFIX} WHEN '.csv' THEN 'doc_id,text' || chr(10) || doc_id || ',"' || replace(text, '"', '""') || '"' || chr(10)
      WHEN '.json' THEN CAST(json_object('doc_id', doc_id, 'text', text) AS VARCHAR) ELSE text END) AS size
  FROM documents)"""
TYPE_SQL = """CASE WHEN extension = '.pdf' THEN 'PDF' WHEN extension IN ('.jpg', '.png') THEN 'Image'
  WHEN extension = '.txt' THEN 'Text' WHEN extension = '.csv' THEN 'CSV'
  WHEN extension = '.json' THEN 'JSON' ELSE 'Unknown' END"""


@query("S1_list_files")
def list_files(spark, sf_dir):
    found = S.list_files(spark, sf_dir, [".parquet"])
    return S.classify_files(found).select("file_name", "extension", "file_type", "length")


@query("S7_binary_source")
def binary_source(spark, sf_dir):
    return S.inspect_files(spark, sf_dir).select(
        S.file_name(F.col("path")).alias("file_name"),
        (F.col("read") == F.col("length")).alias("complete"),
        "mime",
    )


@query(
    "S2_classify_files",
    f"""WITH {FILES_SQL} SELECT path, regexp_extract(path, '[^/]*$') AS file_name, extension,
      {TYPE_SQL} AS file_type FROM files""",
)
def classify(spark, sf_dir):
    found = document_files(spark, sf_dir).select("path")
    return S.classify_files(found).select("path", "file_name", "extension", "file_type")


@query(
    "S8_sniff_mime",
    rf"""WITH {FILES_SQL} SELECT path, CASE WHEN kind = 4 THEN 'image/png' WHEN kind IN (6, 9) THEN 'application/pdf'
        WHEN starts_with(text, 'BM') AND kind NOT IN (2, 3) THEN 'image/bmp' ELSE 'text/plain' END AS mime FROM files
    UNION ALL SELECT 'page/' || page_id, CASE WHEN regexp_matches(lower(ltrim(html)), '^(<!doctype html|<html)')
        THEN 'text/html' ELSE 'text/plain' END FROM pages""",
)
def sniff(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("path"),
        F.encode("html", "UTF-8").alias("content"),
    )
    both = document_files(spark, sf_dir).select("path", "content").unionByName(pages)
    return both.select("path", S.sniff_mime(F.col("content")).alias("mime"))


def validated(spark, sf_dir):
    """All document files plus one requested but absent path per benchmark item."""
    found = document_files(spark, sf_dir)
    absent = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("/data/absent/"), F.col("item_id").cast("string"), F.lit(".txt")).alias("path")
    )
    return V.validate_requested(found.select("path").unionByName(absent), found)


VALIDATED_SQL = f"""{FILES_SQL}, checked AS (
  SELECT path, size,
    concat_ws('; ', CASE WHEN size < 100 THEN 'File too small (' || size || ' bytes)' END,
      CASE WHEN kind = 5 AND NOT starts_with(text, 'BM') THEN 'Invalid image: unknown signature' END) AS issues,
    concat_ws('; ', CASE WHEN size > 52428800 THEN 'File very large (' || size || ' bytes)' END,
      CASE WHEN extension = '' THEN 'No file extension' END,
      CASE WHEN kind = 9 THEN 'PDF has no pages' END) AS warnings FROM files
  UNION ALL SELECT '/data/absent/' || item_id || '.txt', NULL, 'File does not exist', '' FROM benchmark)"""


@query(
    "F1_validate",
    f"WITH {VALIDATED_SQL} SELECT path, issues = '' AS is_valid, issues, warnings FROM checked",
)
def validate(spark, sf_dir):
    return validated(spark, sf_dir).select(
        "path",
        "is_valid",
        F.array_join("issues", "; ").alias("issues"),
        F.array_join("warnings", "; ").alias("warnings"),
    )


@query(
    "F2_validate_batch",
    f"""WITH {VALIDATED_SQL} SELECT count(*) AS total_files, count(*) FILTER (issues = '') AS valid_files,
      count(*) FILTER (issues <> '') AS invalid_files FROM checked""",
)
def validate_batch(spark, sf_dir):
    return V.validate_batch(validated(spark, sf_dir))


def decoded(spark, sf_dir):
    return S.decode_documents(document_files(spark, sf_dir))


DECODED_SQL = f"""{FILES_SQL}, decoded AS (
  SELECT path, {TYPE_SQL} AS file_type,
    CASE WHEN kind IN (0, 1, 3) THEN text WHEN kind = 2 THEN 'doc_id text' || chr(10) || doc_id || ' ' || text END AS text
  FROM files)"""


@query(
    "S3_decode_documents",
    f"""WITH {DECODED_SQL} SELECT path, file_type, text, true AS success FROM decoded""",
)
def decode_documents(spark, sf_dir):
    return decoded(spark, sf_dir).select(
        F.col("metadata.file_path").alias("path"), "metadata.file_type", "text", "success"
    )


@query(
    "F3_usable_documents",
    f"WITH {DECODED_SQL} SELECT path, length(text) AS chars FROM decoded WHERE length(text) > 0",
)
def usable(spark, sf_dir):
    return V.usable_documents(decoded(spark, sf_dir)).select(
        F.col("metadata.file_path").alias("path"), F.length("text").alias("chars")
    )


@query(
    "F4_process_summary",
    f"""WITH {DECODED_SQL} SELECT count(*) AS total_documents,
      count(*) FILTER (length(text) > 0) AS processed_documents,
      (SELECT count(*) FROM benchmark) AS failed_documents
    FROM (SELECT text FROM decoded UNION ALL SELECT NULL FROM benchmark)""",
)
def process_summary(spark, sf_dir):
    absent = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("/data/absent/"), F.col("item_id").cast("string"), F.lit(".txt")).alias("path"),
        F.lit(None).cast("long").alias("length"),
        F.lit(None).cast("binary").alias("content"),
    )
    return V.process_summary(
        S.decode_documents(document_files(spark, sf_dir).unionByName(absent))
    )


def turns_as_pages(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    ok = F.col("role") != "system"
    return turns.select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").cast("int").alias("page"),
        ok.alias("success"),
        "text",
        (F.length("text") % 100).cast("double").alias("confidence"),
        F.when(~ok, "unreadable").alias("error"),
    )


ASSEMBLED_SQL = r"""assembled AS (
  SELECT conv_id AS doc_id,
    regexp_replace(coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (role <> 'system'), ''), '^\s+|\s+$', '', 'g') AS text,
    count(*) AS pages,
    coalesce(round(avg(length(text) % 100) FILTER (role <> 'system'), 6), 0) AS confidence,
    CAST(coalesce(sum(len(regexp_extract_all(text, '\S+'))) FILTER (role <> 'system'), 0) AS BIGINT) AS word_count,
    CAST(coalesce(sum(length(text) + 2) FILTER (role <> 'system'), 0) AS BIGINT) AS char_count,
    count(*) FILTER (role = 'system') AS failed_pages
  FROM conversations GROUP BY conv_id)"""


@query("S9_assemble_pages", f"WITH {ASSEMBLED_SQL} SELECT * FROM assembled")
def assemble_pages(spark, sf_dir):
    done = X.assemble_pages(turns_as_pages(spark, sf_dir))
    return rounded(
        done.select(
            "doc_id",
            "text",
            "pages",
            "confidence",
            "word_count",
            "char_count",
            F.size(F.filter("page_results", lambda p: ~p["success"])).alias("failed_pages"),
        )
    )


@query(
    "S10_choose_extraction",
    f"""WITH {ASSEMBLED_SQL}, direct AS (SELECT doc_id, text FROM documents)
    SELECT d.doc_id, CASE WHEN length(d.text) >= 50 THEN d.text ELSE coalesce(a.text, '') END AS text,
      CASE WHEN length(d.text) >= 50 THEN 'direct' WHEN a.doc_id IS NOT NULL THEN 'ocr' ELSE 'none' END AS method
    FROM direct d LEFT JOIN assembled a ON a.doc_id = d.doc_id""",
)
def choose_extraction(spark, sf_dir):
    direct = table(spark, sf_dir, "documents").select(
        "doc_id", F.lit(True).alias("success"), "text", F.lit("direct").alias("method")
    )
    chosen = X.choose_extraction(direct, X.assemble_pages(turns_as_pages(spark, sf_dir)))
    return chosen.select("doc_id", "text", "method")


@query(
    "S11_ocr_confidence",
    """SELECT l_orderkey AS image, round(avg(l_linenumber - 2) FILTER (l_linenumber > 2), 6) AS confidence
    FROM lineitem GROUP BY l_orderkey""",
)
def ocr_confidence(spark, sf_dir):
    words = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("image"), (F.col("l_linenumber") - 2).alias("conf")
    )
    return rounded(X.ocr_confidence(words))


@query(
    "S12_batch_with_path",
    f"""WITH {ASSEMBLED_SQL} SELECT 'scan/' || doc_id || '.pdf' AS file_path, 'ocr' AS method, pages, word_count
    FROM assembled""",
)
def batch_with_path(spark, sf_dir):
    path = F.concat(F.lit("scan/"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    return X.assemble_pages(turns_as_pages(spark, sf_dir)).select(
        path.alias("file_path"), "method", "pages", "word_count"
    )


def item_folder(spark, sf_dir) -> str:
    """Every benchmark item as a text, a CSV and a JSON file of its own."""
    items, folder = table(spark, sf_dir, "benchmark"), scratch_folder(spark)
    one = {"maxRecordsPerFile": 1}
    items.select("text").write.options(**one).text(f"{folder}/texts")
    items.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **one
    ).csv(f"{folder}/tables")
    items.write.options(**one).json(f"{folder}/records")
    return folder


@query("S4_text_source", "SELECT text || chr(10) AS text FROM benchmark")
def text_source(spark, sf_dir):
    return S.read_text(spark, f"{item_folder(spark, sf_dir)}/texts").select("text")


@query("S5_csv_source", "SELECT item_id, text FROM benchmark")
def csv_source(spark, sf_dir):
    return S.read_csv(spark, f"{item_folder(spark, sf_dir)}/tables")


@query("S6_json_source", "SELECT item_id, text FROM benchmark")
def json_source(spark, sf_dir):
    return S.read_json(spark, f"{item_folder(spark, sf_dir)}/records")


@query(
    "S3_load_documents",
    """SELECT 'Text' AS file_type, text || chr(10) AS text, true AS success FROM benchmark
    UNION ALL SELECT 'CSV', 'item_id text' || chr(10) || item_id || ' ' || text, true FROM benchmark
    UNION ALL SELECT 'JSON', text, true FROM benchmark""",
)
def load_documents(spark, sf_dir):
    loaded = S.load_documents(spark, item_folder(spark, sf_dir))
    return loaded.select("metadata.file_type", "text", "success")


def processed(spark, sf_dir):
    return process_documents(loaded_documents(spark, sf_dir))


@query(
    "S13_json_sink",
    f"""SELECT doc_id, source || '/' || doc_id || '.txt' AS file_path,
      array_to_string(toks, ' ') AS cleaned_text, len(toks) AS word_count
    FROM (SELECT *, {sql_tokens()} AS toks FROM documents WHERE length(text) > 0)""",
)
def json_sink(spark, sf_dir):
    target = sinks.write_processed(processed(spark, sf_dir), scratch_folder(spark))
    return spark.read.json(target).select(
        "doc_id", "file_path", "cleaned_text", "metadata.word_count"
    )


@query(
    "S14_embedding_sink",
    """SELECT 'given' AS method, max(len(embedding)) AS embedding_dim, count(*) AS num_documents,
      (SELECT count(DISTINCT vec_id) FROM embeddings) AS ids FROM embeddings""",
)
def embedding_sink(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    target = sinks.write_embeddings(vectors, scratch_folder(spark), "given", "table", "vec_id")
    ids = spark.read.parquet(f"{target}/ids").agg(F.count_distinct("vec_id").alias("ids"))
    sidecar = spark.read.json(f"{target}/metadata")
    return sidecar.withColumn("ids", F.lit(ids.first()["ids"])).select(
        "method", "embedding_dim", "num_documents", "ids"
    )


@query(
    "S15_report_sink",
    f"WITH {METRICS_SQL} SELECT model, " + ", ".join(f"round({m}, 6) AS {m}" for m in M.METRICS) + " FROM metrics",
)
def report_sink(spark, sf_dir):
    metrics = rounded(M.classification_metrics(all_preds(spark, sf_dir)))
    path = sinks.write_report(metrics, f"{scratch_folder(spark)}/report")
    return sinks.read_report(spark, path).select("model", *M.METRICS)


@query(
    "S16_model_store",
    COUNT_SQL.replace("SELECT doc_id, term, tf FROM c SEMI JOIN v USING (term)", "")
    + """SELECT d.doc_id, count(k.term) AS terms FROM documents d
      LEFT JOIN (SELECT doc_id, term FROM c SEMI JOIN v USING (term)) k ON k.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def model_store(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = fit_counts(docs)
    path = f"{scratch_folder(spark)}/model"
    sinks.save_model(vocabulary.tfidf_stages(), path)
    tokens = docs.withColumn("_tokens", vocabulary.tokens(F.col("text")))
    return sinks.load_model(path).transform(tokens).select(
        "doc_id", F.size(F.filter(vector_to_array("features"), lambda x: x > 0)).alias("terms")
    )


@query(
    "L1_process_folder",
    """SELECT 3 * count(*) AS total_documents, 3 * count(*) AS processed_documents, 0 AS failed_documents
    FROM benchmark""",
)
def process_folder(spark, sf_dir):
    folder = item_folder(spark, sf_dir)
    return workflow.process_folder(spark, folder, f"{scratch_folder(spark)}/out")[1]


@query("L2_generate_embeddings")
def generate_embeddings(spark, sf_dir):
    return workflow.generate_embeddings(processed(spark, sf_dir), scratch_folder(spark))


@query("L3_cluster_documents")
def cluster_documents(spark, sf_dir):
    done = processed(spark, sf_dir)
    vectors = durable(embed(done))
    parts = workflow.cluster_embeddings(vectors, done, scratch_folder(spark), "kmeans", 5)
    return parts["assignments"]


@query("L6_run_all")
def run_all(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    labelled = table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")
    return workflow.run_all(
        spark,
        item_folder(spark, sf_dir),
        f"{scratch_folder(spark)}/out",
        labelled=labelled,
    )

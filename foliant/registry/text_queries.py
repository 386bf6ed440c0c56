"""Cleaning, counting and structure extraction (T*, X*, F5, F6, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import structure as S
from foliant.functions import text as T
from foliant.operators.cleaning import clean_documents, prepare_corpus
from foliant.plans.process import process_documents
from foliant.registry.base import ORACLES, query, sql_list, texts
from foliant.registry.reports import REPORTS_SQL, reports

STOP_SQL = sql_list(T.ENGLISH_STOPWORDS)
SQUEEZED = (
    r"trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), '\p{{Nd}}+', ' ', 'g'),"
    r" '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
)


def sql_fused(expr: str) -> str:
    for head, tail in T.FUSED_WORDS:
        expr = rf"regexp_replace({expr}, '\b({head})({tail})\b', '\1 \2', 'g')"
    return expr


def sql_tokens(column: str = "text", stop: bool = True, min_length: int = 2) -> str:
    keep = f"length(w) >= {min_length}" + (f" AND w NOT IN ({STOP_SQL})" if stop else "")
    words = f"string_split({sql_fused(SQUEEZED.format(c=column))}, ' ')"
    return f"list_filter({words}, lambda w: {keep})"


def sql_clean(column: str = "text") -> str:
    return f"array_to_string({sql_tokens(column)}, ' ')"


def doc_column(name, expr, sql, *, source="documents", key="doc_id", column="text"):
    """Register a one-column scalar query over a whole table."""

    @query(name, f"SELECT {key}, {sql} AS value FROM {source}")
    def run(spark, sf_dir):
        return texts(spark, sf_dir, source).select(key, expr(F.col(column)).alias("value"))


doc_column("T1_clean_text", T.clean_text, sql_clean())
doc_column("T1a_remove_digits", T.remove_digits, r"regexp_replace(text, '\p{Nd}+', ' ', 'g')")
doc_column(
    "T1b_remove_punctuation",
    T.remove_punctuation,
    r"regexp_replace(text, '[^\p{L}\p{N}_\s]', ' ', 'g')",
)
doc_column(
    "T1c_squeeze_spaces", T.squeeze_spaces, r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
)
doc_column(
    "T2_remove_html_tags",
    T.remove_html_tags,
    "regexp_replace(html, '<.*?>', '', 'g')",
    source="pages",
    key="page_id",
    column="html",
)
doc_column(
    "T3_remove_urls",
    T.remove_urls,
    r"regexp_replace(html, 'https?://\S+|www\.\S+', '', 'g')",
    source="pages",
    key="page_id",
    column="html",
)
doc_column("T4_remove_emails", T.remove_emails, r"regexp_replace(text, '\S+@\S+', '', 'g')")
doc_column(
    "T9_doc_counts",
    lambda t: T.word_count(T.clean_text(t)),
    f"len({sql_tokens()})",
)
doc_column(
    "F5_preview",
    T.preview,
    "CASE WHEN length(text) > 1000 THEN left(text, 1000) || '...' ELSE text END",
)


def token_rows(name, expr, sql_list_expr, source="documents", key="doc_id", column="text"):
    """Register an array-valued function as (key, pos, token) rows."""

    @query(
        name,
        f"""WITH a AS (SELECT {key}, {sql_list_expr} AS items FROM {source})
        SELECT {key}, unnest(generate_series(1, len(items))) AS pos, unnest(items) AS token
        FROM a""",
    )
    def run(spark, sf_dir):
        rows = texts(spark, sf_dir, source).select(
            key, F.posexplode(expr(F.col(column))).alias("pos", "token")
        )
        return rows.withColumn("pos", F.col("pos") + 1)


RAW_TOKENS = sql_fused("text")
token_rows(
    "T1d_tokenize",
    lambda t: T.word_tokens(T.remove_punctuation(t)),
    "list_filter(regexp_split_to_array("
    + sql_fused(r"regexp_replace(text, '[^\p{L}\p{N}_\s]', ' ', 'g')")
    + r", '\s+'), lambda w: w <> '')",
)
token_rows(
    "T1e_stopwords",
    lambda t: T.normalized_tokens(t, stopwords=T.stopwords_for()),
    sql_tokens(min_length=1),
)
token_rows(
    "T1g_min_length",
    lambda t: T.clean_tokens(t, remove_stopwords=False, min_word_length=4),
    sql_tokens(stop=False, min_length=4),
)
SENTENCES = (
    r"list_filter(string_split(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'),"
    r" '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: s <> '')"
)
PARAGRAPHS = (
    r"list_filter(list_transform(string_split(text, chr(10) || chr(10)),"
    r" lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> '')"
)
token_rows("T5_sentences", T.sentences, SENTENCES)


@query(
    "T6_paragraphs",
    f"""WITH {REPORTS_SQL}, a AS (SELECT doc_id, {PARAGRAPHS} AS items FROM reports)
    SELECT doc_id, unnest(generate_series(1, len(items))) AS pos, unnest(items) AS paragraph FROM a""",
)
def paragraphs(spark, sf_dir, rows=reports):
    rows = rows(spark, sf_dir).select(
        "doc_id", F.posexplode(T.paragraphs(F.col("text"))).alias("pos", "paragraph")
    )
    return rows.withColumn("pos", F.col("pos") + 1)


# A lemma table derived from the corpus: words of five or more letters ending
# in "s" lose the ending.
LEMMAS_SQL = f"""lemmas AS (
  SELECT DISTINCT w AS surface, left(w, length(w) - 1) AS lemma
  FROM (SELECT unnest({sql_tokens()}) AS w FROM documents)
  WHERE length(w) >= 5 AND w LIKE '%s')"""


@query(
    "T1f_lemmatize",
    f"""WITH {LEMMAS_SQL},
    t AS (SELECT doc_id, unnest(generate_series(1, len(items))) AS pos, unnest(items) AS w
          FROM (SELECT doc_id, {sql_tokens(min_length=1)} AS items FROM documents)),
    l AS (SELECT doc_id, pos, coalesce(lemma, w) AS token FROM t LEFT JOIN lemmas ON w = surface)
    SELECT d.doc_id, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS cleaned_text
    FROM documents d LEFT JOIN (SELECT * FROM l WHERE length(token) >= 2) k ON d.doc_id = k.doc_id
    GROUP BY d.doc_id""",
)
def lemmatize(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents")
    words = docs.select(F.explode(T.clean_tokens(F.col("text"))).alias("surface"))
    lemmas = (
        words.filter((F.length("surface") >= 5) & F.col("surface").endswith("s"))
        .distinct()
        .withColumn("lemma", F.expr("substring(surface, 1, length(surface) - 1)"))
    )
    return clean_documents(docs, lemmas)


def ranked_sql(tokens: str, top: int) -> str:
    return f"""WITH t AS (SELECT doc_id, unnest(generate_series(1, len(items))) AS pos, unnest(items) AS token
      FROM (SELECT doc_id, {tokens} AS items FROM documents)),
    c AS (SELECT doc_id, token, count(*) AS n, min(pos) AS f FROM t GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS rank FROM c)
    SELECT doc_id, rank, token, n FROM r WHERE rank <= {top}"""


def ranked_rows(docs, expr):
    return docs.select("doc_id", F.posexplode(expr).alias("pos", "item")).select(
        "doc_id", (F.col("pos") + 1).alias("rank"), "item.token", "item.n"
    )


@query("T7_word_frequency", ranked_sql(sql_tokens(stop=False), 20))
def word_frequency(spark, sf_dir):
    return ranked_rows(texts(spark, sf_dir, "documents"), T.word_frequency(F.col("text")))


KEYWORD_TOKENS = (
    r"list_filter(regexp_split_to_array(regexp_replace(lower(text), '[[:punct:]]', '', 'g'), '\s+'),"
    f" lambda w: length(w) > 2 AND w NOT IN ({sql_list(S.KEYWORD_STOPWORDS)}))"
)


@query("X5_keywords", ranked_sql(KEYWORD_TOKENS, 10))
def keywords(spark, sf_dir):
    return ranked_rows(texts(spark, sf_dir, "documents"), S.keyword_counts(F.col("text")))


RAW_WORDS = rf"regexp_extract_all({sql_fused('text')}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')"


@query(
    "T8_text_stats",
    f"""WITH p AS (SELECT doc_id, text, {sql_tokens()} AS toks, {SENTENCES} AS sents,
        {PARAGRAPHS} AS paras, {RAW_WORDS} AS words FROM documents)
    SELECT doc_id, length(text) AS original_length,
      length(array_to_string(toks, ' ')) AS cleaned_length,
      len(sents) AS sentence_count, len(paras) AS paragraph_count, len(words) AS word_count,
      len(toks) AS cleaned_word_count,
      round(len(words) / greatest(len(sents), 1), 6) AS avg_sentence_length,
      round(length(array_to_string(words, '')) / greatest(len(words), 1), 6) AS avg_word_length
    FROM p""",
)
def text_stats(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents")
    stats = docs.select("doc_id", T.text_stats(F.col("text")).alias("s")).select("doc_id", "s.*")
    return stats.withColumns(
        {c: F.round(c, 6) for c in ("avg_sentence_length", "avg_word_length")}
    )


@query(
    "F6_prepare_corpus",
    f"""SELECT * FROM (SELECT doc_id, {sql_clean()} AS prepared FROM documents
      WHERE length(text) >= 50) WHERE length(prepared) >= 50""",
)
def corpus(spark, sf_dir):
    return prepare_corpus(texts(spark, sf_dir, "documents")).select("doc_id", "prepared")


# The entity patterns as they are defined, for the oracle's engine.
SQL_PATTERNS = {
    "email": r"(?i)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"(\+\d{1,3}[-\.\s]??)?\d{3}[-\.\s]??\d{3}[-\.\s]??\d{4}",
    "url": r"(?i)https?://(?:[-\p{L}\p{N}_.]|(?:%[\da-fA-F]{2}))+",
    "date": r"\b(?:\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{4}[-/]\d{1,2}[-/]\d{1,2}"
    r"|[\p{L}\p{N}_]+\s+\d{1,2},?\s+\d{4})\b",
    "ssn": r"\b\d{3}[-]?\d{2}[-]?\d{4}\b",
    "amount": r"\$\s?\d+(?:,\d{3})*(?:\.\d{2})?",
    "percentage": r"\d+(?:\.\d+)?%",
}
LETTERS = dict(zip(SQL_PATTERNS, "abcdefg", strict=True))
# Documents, pages and reports together: every type has matches in one of them.
CORPUS_SQL = f"""{REPORTS_SQL}, corpus AS (
  SELECT 'document' AS kind, doc_id, text FROM documents
  UNION ALL SELECT 'page', page_id, html FROM pages
  UNION ALL SELECT 'report', doc_id, text FROM reports)"""


def mixed_corpus(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), "doc_id", "text")
    pages = texts(spark, sf_dir, "pages").select(F.lit("page"), "page_id", "html")
    orders = reports(spark, sf_dir).select(F.lit("report"), "doc_id", "text")
    return docs.union(pages).union(orders)


def entity_query(entity):
    pattern = SQL_PATTERNS[entity]

    @query(
        f"X1{LETTERS[entity]}_{entity}",
        f"""WITH {CORPUS_SQL} SELECT DISTINCT kind, doc_id, m AS match FROM (
          SELECT kind, doc_id, unnest(regexp_extract_all(text, '{pattern}')) AS m FROM corpus)""",
    )
    def run(spark, sf_dir):
        return mixed_corpus(spark, sf_dir).select(
            "kind", "doc_id", F.explode(S.entity_matches(F.col("text"), entity)).alias("match")
        )


for _entity in S.ENTITY_PATTERNS:
    entity_query(_entity)


@query(
    "X1_entities",
    "WITH " + CORPUS_SQL + " SELECT DISTINCT kind, doc_id, entity, m AS match FROM ("
    + " UNION ALL ".join(
        f"SELECT kind, doc_id, '{e}' AS entity, unnest(regexp_extract_all(text, '{p}')) AS m FROM corpus"
        for e, p in SQL_PATTERNS.items()
    )
    + ")",
)
def entities(spark, sf_dir):
    found = mixed_corpus(spark, sf_dir).select(
        "kind", "doc_id", F.explode(S.entities(F.col("text"))).alias("entity", "matches")
    )
    return found.select("kind", "doc_id", "entity", F.explode("matches").alias("match"))


@query(
    "U1_distinct_matches",
    rf"""WITH {CORPUS_SQL} SELECT kind, doc_id, len(regexp_extract_all(text, '\d+')) AS matches,
      len(list_distinct(regexp_extract_all(text, '\d+'))) AS distinct_matches FROM corpus""",
)
def distinct_matches(spark, sf_dir):
    found = F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0))
    return mixed_corpus(spark, sf_dir).select(
        "kind",
        "doc_id",
        F.size(found).alias("matches"),
        F.size(F.array_distinct(found)).alias("distinct_matches"),
    )


_MONTH_SQL = (
    "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]* [0-9]{1,2},? [0-9]{4}"
)
_DATE_SQL = [
    ("iso", "[0-9]{4}-[0-9]{2}-[0-9]{2}", "try_strptime(m, '%Y-%m-%d')"),
    (
        "slash",
        "[0-9]{2}/[0-9]{2}/[0-9]{4}",
        "coalesce(try_strptime(m, '%m/%d/%Y'), try_strptime(m, '%d/%m/%Y'))",
    ),
    (
        "dash",
        "[0-9]{2}-[0-9]{2}-[0-9]{4}",
        "coalesce(try_strptime(m, '%m-%d-%Y'), try_strptime(m, '%d-%m-%Y'))",
    ),
    ("month_name", _MONTH_SQL, "try_strptime(m, '%B %-d, %Y')"),
]


def _dates_sql(name: str, pattern: str, parse: str) -> str:
    # Offsets by cutting the text at the k-th match, independent of the
    # interleaving used on the Spark side.
    return rf"""SELECT doc_id, m AS found, strftime({parse}, '%Y-%m-%dT%H:%M:%S') AS date,
      length(array_to_string(p[1:k], '')) + length(array_to_string(a[1:k - 1], '')) AS position,
      '{name}' AS format
    FROM (SELECT doc_id, a, p, unnest(generate_series(1, len(a))) AS k, unnest(a) AS m
      FROM (SELECT doc_id, regexp_extract_all(text, '(?i)\b{pattern}\b') AS a,
              regexp_split_to_array(text, '(?i)\b{pattern}\b') AS p FROM reports)
      WHERE len(a) > 0) WHERE {parse} IS NOT NULL"""


@query(
    "X2_dates",
    f"WITH {REPORTS_SQL} " + " UNION ALL ".join(_dates_sql(*spec) for spec in _DATE_SQL),
)
def dates(spark, sf_dir, rows=reports):
    return (
        rows(spark, sf_dir)
        .select("doc_id", F.explode(S.dates(F.col("text"))).alias("d"))
        .select("doc_id", F.col("d.text").alias("found"), "d.date", "d.position", "d.format")
    )


@query(
    "X3_sections",
    rf"""WITH RECURSIVE {REPORTS_SQL},
    lines AS (SELECT doc_id, unnest(generate_series(1, len(l))) AS pos, unnest(l) AS line
              FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM reports)),
    marked AS (SELECT *, lower(trim(line)) AS low,
        regexp_matches(lower(line), '{"|".join(S.SECTION_WORDS)}')
        AND len(regexp_extract_all(line, '\S+')) < 10 AS candidate FROM lines),
    -- sequential rule: n = lines held by the running section
    walk AS (
      SELECT doc_id, pos, 'header' AS section, 0 AS no, 1 AS n, line AS body FROM marked WHERE pos = 1
      UNION ALL
      SELECT m.doc_id, m.pos,
        CASE WHEN candidate AND n > 0 THEN low ELSE section END,
        CASE WHEN candidate AND n > 0 THEN no + 1 ELSE no END,
        CASE WHEN candidate AND n > 0 THEN 0 ELSE n + 1 END,
        CASE WHEN candidate AND n > 0 THEN NULL ELSE line END
      FROM walk w JOIN marked m ON m.doc_id = w.doc_id AND m.pos = w.pos + 1),
    parts AS (SELECT doc_id, section, no, string_agg(body, chr(10) ORDER BY pos) AS content
              FROM walk WHERE body IS NOT NULL GROUP BY ALL)
    SELECT doc_id, section, max_by(content, no) AS content FROM parts GROUP BY ALL""",
)
def sections(spark, sf_dir, rows=reports):
    return (
        rows(spark, sf_dir)
        .select("doc_id", F.explode(S.sections(F.col("text"))).alias("s"))
        .select("doc_id", "s.section", "s.content")
    )


@query(
    "X4_tables",
    rf"""WITH {REPORTS_SQL},
    lines AS (SELECT doc_id, len(l) AS total, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS line
              FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM reports)),
    hits AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM lines
             WHERE regexp_matches(line, '[\t|]{{2,}}|\s{{2,}}.+\s{{2,}}'))
    SELECT doc_id, count(*) AS "rows", string_agg(line, chr(10) ORDER BY pos) AS content,
      min(pos) AS start_line, max(pos) AS end_line
    FROM hits GROUP BY doc_id, island, total HAVING count(*) >= 2 AND max(pos) < total - 1""",
)
def tables(spark, sf_dir, rows=reports):
    return (
        rows(spark, sf_dir)
        .select("doc_id", F.explode(S.tables(F.col("text"))).alias("t"))
        .select("doc_id", "t.*")
    )


@query(
    "X6_doc_metadata",
    f"""WITH {REPORTS_SQL}, both_kinds AS (
      SELECT 'document' AS kind, doc_id, text FROM documents
      UNION ALL SELECT 'report', doc_id, text FROM reports)
    SELECT kind, doc_id, len(string_split(text, chr(10))) AS line_count,
      len({PARAGRAPHS}) AS paragraph_count,
      greatest(1, length(text) // 2500) AS estimated_pages FROM both_kinds""",
)
def doc_metadata(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), "doc_id", "text")
    both = docs.union(reports(spark, sf_dir).select(F.lit("report"), "doc_id", "text"))
    return both.select("kind", "doc_id", S.doc_metadata(F.col("text")).alias("m")).select(
        "kind", "doc_id", "m.*"
    )


@query("X7_document_structure")
def document_structure(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents").select("doc_id", "text")
    both = docs.union(reports(spark, sf_dir).select(-F.col("doc_id") - 1, "text"))
    # JSON keeps the nested result comparable from run to run.
    return both.select("doc_id", F.to_json(S.document_structure(F.col("text"))).alias("structure"))


@query(
    "X8_process_document",
    f"""SELECT doc_id, source || '/' || doc_id || '.txt' AS file_path, 'Text' AS file_type,
      CASE WHEN length(text) > 1000 THEN left(text, 1000) || '...' ELSE text END AS original_text,
      array_to_string(toks, ' ') AS cleaned_text, 'direct' AS extraction_method,
      len(toks) AS word_count, length(array_to_string(toks, ' ')) AS char_count,
      len(string_split(text, chr(10))) AS line_count
    FROM (SELECT *, {sql_tokens()} AS toks FROM documents WHERE length(text) > 0)""",
)
def process_document(spark, sf_dir):
    # Of the structure the result has the number of lines alone.
    done = process_documents(loaded_documents(spark, sf_dir), ("metadata",))
    return done.select(
        "doc_id",
        "file_path",
        "file_type",
        "original_text",
        "cleaned_text",
        "metadata.extraction_method",
        "metadata.word_count",
        "metadata.char_count",
        "structure.metadata.line_count",
    )


def loaded_documents(spark, sf_dir):
    """The documents table in the shape of loaded text files."""
    docs = texts(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.select(
        "doc_id",
        path.alias("file_path"),
        F.lit("Text").alias("file_type"),
        "text",
        F.lit(True).alias("success"),
        F.lit("direct").alias("method"),
        F.lit(0.0).alias("confidence"),
    )


# The same over all documents and pages: long, irregular texts beside the short reports.
TEXTS_SQL = """reports AS (
  SELECT doc_id, text FROM documents UNION ALL SELECT -1 - page_id, html FROM pages)"""


def whole_texts(spark, sf_dir):
    pages = texts(spark, sf_dir, "pages").select((-1 - F.col("page_id")).alias("doc_id"), F.col("html").alias("text"))
    return texts(spark, sf_dir, "documents").select("doc_id", "text").unionByName(pages)


def _over_texts(name, fn):
    @query(f"{name}_of_texts", ORACLES[name].replace(REPORTS_SQL, TEXTS_SQL))
    def run(spark, sf_dir):
        return fn(spark, sf_dir, whole_texts)


for _name, _fn in (
    ("T6_paragraphs", paragraphs),
    ("X2_dates", dates),
    ("X3_sections", sections),
    ("X4_tables", tables),
):
    _over_texts(_name, _fn)

_COUNTED = ("sections", "dates", "tables", "metadata")
_SECTIONS_CTE = ORACLES["X3_sections"].split("SELECT doc_id, section, max_by")[0].split(f"{REPORTS_SQL},")[1]


@query(
    "X7_structure_counts",
    rf"""WITH RECURSIVE {REPORTS_SQL.replace("reports AS", "orders_ AS")},
    reports AS (SELECT doc_id, text FROM documents UNION ALL SELECT -1 - doc_id, text FROM orders_),
    {_SECTIONS_CTE},
    s AS (SELECT doc_id, count(DISTINCT section) AS n FROM parts GROUP BY doc_id),
    d AS (SELECT doc_id, count(*) AS n FROM ({" UNION ALL ".join(_dates_sql(*spec) for spec in _DATE_SQL)}) GROUP BY doc_id),
    islands AS (SELECT doc_id, count(*) AS rows_, max(pos) AS last, total FROM (
        SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM (
          SELECT doc_id, len(l) AS total, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS line
          FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM reports))
        WHERE regexp_matches(line, '[\t|]{{2,}}|\s{{2,}}.+\s{{2,}}')) GROUP BY doc_id, island, total),
    t AS (SELECT doc_id, count(*) AS n FROM islands WHERE rows_ >= 2 AND last < total - 1 GROUP BY doc_id)
    SELECT r.doc_id, coalesce(s.n, 0) AS sections, coalesce(d.n, 0) AS dates, coalesce(t.n, 0) AS tables,
      len(string_split(text, chr(10))) AS line_count, len({PARAGRAPHS}) AS paragraph_count,
      greatest(1, length(text) // 2500) AS estimated_pages
    FROM reports r LEFT JOIN s USING (doc_id) LEFT JOIN d USING (doc_id) LEFT JOIN t USING (doc_id)""",
)
def structure_counts(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents").select("doc_id", "text")
    both = docs.union(reports(spark, sf_dir).select(-1 - F.col("doc_id"), "text"))
    found = both.select("doc_id", S.document_structure(F.col("text"), _COUNTED).alias("s"))
    return found.select(
        "doc_id",
        F.size("s.sections").alias("sections"),
        F.size("s.dates").alias("dates"),
        F.size("s.tables").alias("tables"),
        F.col("s.metadata.line_count").alias("line_count"),
        F.col("s.metadata.paragraph_count").alias("paragraph_count"),
        F.col("s.metadata.estimated_pages").alias("estimated_pages"),
    )

from pyspark.sql import functions as F

from foliant.functions import structure as S
from foliant.functions import text as T


def one(spark, text, expr):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(expr(F.col("t")).alias("r")).first()["r"]


def test_clean_fixtures(spark):
    def clean(text, **kw):
        return one(spark, text, lambda c: T.clean_text(c, **kw))

    assert clean("The 3 Cats_sat, on mats!", stopwords=["the", "on"]) == "cats_sat mats"
    assert clean("a b cd", stopwords=[]) == "cd"
    assert clean("") == ""
    assert clean(None) == ""
    assert clean("Äpfel-Öl 12", stopwords=[]) == "äpfel öl"
    assert clean("I cannot, gonna go", remove_stopwords=False) == "can not gon na go"
    assert clean("cats in mats", lemmas={"cats": "cat", "mats": "m"}) == "cat"


def test_clean_options(spark):
    def clean(text, **kw):
        return one(spark, text, lambda c: T.clean_text(c, remove_stopwords=False, **kw))

    assert clean("ab 12 c3", remove_numbers=False) == "ab 12 c3"
    assert clean("ab, cd!", strip_punctuation=False, min_word_length=1) == "ab , cd !"
    assert clean("ab  cd", remove_extra_spaces=False) == "ab cd"


def test_step_by_step_equals_single_pass(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fused = T.clean_text(F.col("text"))
    steps = T.squeeze_spaces(T.remove_punctuation(T.remove_digits(F.lower("text"))))
    stepwise = F.array_join(
        F.filter(
            T.word_tokens(steps),
            lambda t: ~t.isin(T.ENGLISH_STOPWORDS) & (F.length(t) >= 2),
        ),
        " ",
    )
    assert docs.filter(fused != stepwise).count() == 0


def test_removers(spark):
    assert one(spark, "<p>a<b\n>c</p>", T.remove_html_tags) == "a<b\n>c"
    assert one(spark, "see https://x.org/a?b, or www.y.de now", T.remove_urls) == "see  or  now"
    assert one(spark, "to <a@b.c>, or @x or y@ or @a@b", T.remove_emails) == "to  or @x or y@ or "


def test_sentences_and_paragraphs(spark):
    assert one(spark, " One. Two!  Three? four", T.sentences) == ["One.", "Two!", "Three?", "four"]
    assert one(spark, "", T.sentences) == []
    assert one(spark, "a\n\n b \n\n\n\nc", T.paragraphs) == ["a", "b", "c"]


def test_word_frequency(spark):
    got = one(spark, "beta alpha beta alpha gamma", lambda c: T.word_frequency(c, 2))
    assert [(r.token, r.n) for r in got] == [("beta", 2), ("alpha", 2)]
    assert one(spark, "", T.word_frequency) == []


def sections(spark, text):
    return one(spark, text, S.section_map)


def test_sections(spark):
    assert sections(spark, "Title line\nIntroduction\nhello\nResults\nworld") == {
        "header": "Title line", "introduction": "hello", "results": "world"}
    assert sections(spark, "Introduction\nResults\nbody") == {
        "header": "Introduction", "results": "body"}
    assert sections(spark, "x\nResults\nDiscussion\ny") == {"header": "x", "results": "Discussion\ny"}
    assert sections(spark, "x\nResults\na\nResults\nb") == {"header": "x", "results": "b"}
    assert sections(spark, "x\nConclusion") == {"header": "x"}
    long = "x\nthe results of this test were seen by us all\ny"
    assert sections(spark, long) == {"header": long}
    assert sections(spark, "") == {"header": ""}


def test_sections_against_sequential_rule(spark):
    from itertools import product

    texts = ["\n".join("Results" if c else "x" for c in bits)
             for n in range(1, 8) for bits in product([0, 1], repeat=n)]

    def rule(text):
        out, name, body = {}, "header", []
        for line in text.split("\n"):
            if line == "Results" and body:
                out[name], name, body = "\n".join(body), "results", []
            else:
                body.append(line)
        if body:
            out[name] = "\n".join(body)
        return out

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", S.section_map(F.col("t")).alias("m")).collect():
        assert row.m == rule(row.t), row.t


def tables(spark, text, **kw):
    got = one(spark, text, lambda c: S.tables(c, **kw))
    return [(r["rows"], r["start_line"], r["end_line"]) for r in got]


def test_tables(spark):
    assert tables(spark, "a||b\nc||d\nend") == [(2, 0, 1)]
    assert tables(spark, "a||b\nc||d") == []
    assert tables(spark, "a||b\nc||d", flush_last=True) == [(2, 0, 1)]
    assert tables(spark, "a||b\nend") == []
    assert tables(spark, "p\n  x  \n  y  \nq") == [(2, 1, 2)]
    assert tables(spark, "| a | b |\n| c | d |\nend") == []


def test_dates(spark):
    def dates(text):
        return [(r["date"][:10], r["position"]) for r in one(spark, text, S.dates)]

    assert dates("Due 2024-01-03, was 03/01/2024") == [("2024-01-03", 4), ("2024-03-01", 20)]
    assert dates("25-12-2023") == [("2023-12-25", 0)]
    assert dates("2024-02-30") == []
    assert dates("January 5, 2024") == [("2024-01-05", 0)]
    assert dates("12024-01-02 on 2024-01-02") == [("2024-01-02", 15)]
    assert dates("Marching 12 2020, sept 3 2021") == [("2021-09-03", 18)]
    assert dates("2024-01-02 2024-01-02 é 2024-01-05") == [
        ("2024-01-02", 0), ("2024-01-02", 11), ("2024-01-05", 24)]


def test_entities(spark):
    def ent(text):
        return one(spark, text, S.entities)

    assert ent("a.b@x.org A.B@x.org") == {"email": ["a.b@x.org", "A.B@x.org"]}
    assert ent("https://ex.org/path?q=1")["url"] == ["https://ex.org"]
    assert ent("+1 555-123-4567")["phone"] == ["+1 555-123-4567"]
    assert ent("123456789 123-45-6789")["ssn"] == ["123456789", "123-45-6789"]
    got = ent("pay $1,234.50 or 12.5%")
    assert got["amount"] == ["$1,234.50"] and got["percentage"] == ["12.5%"]
    assert one(spark, "555-123-4567", lambda c: S.entity_matches(c, "phone", 1)) == [""]


def test_metadata_and_keywords(spark):
    got = one(spark, "a\n\nb\n", S.doc_metadata)
    assert (got.line_count, got.paragraph_count, got.estimated_pages) == (4, 2, 1)
    assert one(spark, "The cat's hat, the cats hat", S.keywords) == ["cats", "hat"]


def test_stats(spark):
    got = one(spark, "Ab cd. Ef!", T.text_stats)
    assert got.sentence_count == 2 and got.word_count == 5
    assert got.avg_sentence_length == 2.5 and got.avg_word_length == 8 / 5


def test_a_large_dictionary_of_lemmas_in_the_plan(spark):
    lemmas = {f"wörd{i}": f"base{i}" for i in range(3000)}
    df = spark.createDataFrame([("wörd7 wörd2999 tree",)], "text string")
    got = df.select(T.clean_text(F.col("text"), lemmas=lemmas, remove_numbers=False).alias("t")).first().t
    assert got == "base7 base2999 tree"


def test_marks_in_texts_with_dates(spark):
    from foliant.functions import structure as S

    text = "\x01a 2020-02-29\x01 2021-02-29 31/12/2020\x01, 12/31/2020 May 3, 2021x mAy 3, 2021 12-13-2001"
    found = spark.createDataFrame([(text,)], ["t"]).select(F.inline(S.dates(F.col("t")))).collect()
    assert [(r.format, r.text, r.date[:10]) for r in found] == [
        ("iso", "2020-02-29", "2020-02-29"), ("slash", "31/12/2020", "2020-12-31"),
        ("slash", "12/31/2020", "2020-12-31"), ("dash", "12-13-2001", "2001-12-13"),
        ("month_name", "mAy 3, 2021", "2021-05-03")]
    assert all(text[r.position :].startswith(r.text) for r in found)


def test_reports_are_spread_over_the_cores(spark, sf_dir):
    from foliant.registry.reports import reports

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        parts = reports(spark, sf_dir).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", before)
    assert parts >= spark.sparkContext.defaultParallelism


def test_structure_counts_compute_only_what_they_count(spark, sf_dir):
    import __spark_entry__ as entry

    plan = entry.queries()["X7_structure_counts"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "email" not in plan and "Punct" not in plan


def test_dates_of_two_formats_may_overlap(spark):
    from foliant.functions import structure as S

    rows = [("due May 1, 2020-01-02-2021 or 03/04/2020", ), ("2020-02-30 31-12-1999", )]
    df = spark.createDataFrame(rows, "text string").select(S.dates(F.col("text")).alias("d"))
    got = [[(r.format, r.text, r.position) for r in x.d] for x in df.collect()]
    assert got == [
        [("iso", "2020-01-02", 11), ("slash", "03/04/2020", 30), ("dash", "01-02-2021", 16), ("month_name", "May 1, 2020", 4)],
        [("dash", "31-12-1999", 11)],
    ]

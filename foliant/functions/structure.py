"""Entities, dates, sections, tables and keywords of a text, without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.arrays import indices, let, prefix_sums, top_tokens
from foliant.functions.text import SPACE, WORD, paragraphs, strip

_EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
_OPEN = rf"(?<![{WORD}])"
_CLOSE = rf"(?![{WORD}])"
_D = r"\p{Nd}"

# What counts as an entity. Word edges are spelled out because \b differs between JVM
# versions; disjoint repeats are possessive so long runs stay linear.
ENTITY_PATTERNS = {
    "email": rf"(?i){_EDGE}[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}{_EDGE}",
    "phone": rf"(\+{_D}{{1,3}}[-.{SPACE}]??)?{_D}{{3}}[-.{SPACE}]??{_D}{{3}}[-.{SPACE}]??{_D}{{4}}",
    "url": rf"(?i)https?://(?:[-{WORD}.]++|%[{_D}a-f]{{2}})+",
    "date": (
        rf"{_OPEN}(?:{_D}{{1,2}}[-/]{_D}{{1,2}}[-/]{_D}{{2,4}}"
        rf"|{_D}{{4}}[-/]{_D}{{1,2}}[-/]{_D}{{1,2}}"
        rf"|[{WORD}]++[{SPACE}]++{_D}{{1,2}},?[{SPACE}]++{_D}{{4}}){_CLOSE}"
    ),
    "ssn": rf"{_OPEN}{_D}{{3}}-?{_D}{{2}}-?{_D}{{4}}{_CLOSE}",
    "amount": rf"\$[{SPACE}]?{_D}+(?:,{_D}{{3}})*(?:\.{_D}{{2}})?",
    "percentage": rf"(?<!{_D}){_D}++(?:\.{_D}++)?%",
}

_MONTHS = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)

# (format name, pattern) in the order results are reported.
DATE_PATTERNS = [
    ("iso", r"[0-9]{4}-[0-9]{2}-[0-9]{2}"),
    ("slash", r"[0-9]{2}/[0-9]{2}/[0-9]{4}"),
    ("dash", r"[0-9]{2}-[0-9]{2}-[0-9]{4}"),
    ("month_name", rf"(?i)(?:{_MONTHS}) [0-9]{{1,2}},? [0-9]{{4}}"),
]

# Of the longest date, "september 30, 2000".
_DATE_LENGTH = 18

_DATES_TYPE = "array<struct<text:string,date:string,position:int,format:string>>"

# Words that mark a section header line.
SECTION_WORDS = [
    "abstract",
    "introduction",
    "methodology",
    "results",
    "discussion",
    "conclusion",
    "references",
    "appendix",
    "executive summary",
    "background",
    "analysis",
    "recommendations",
]

# Words never reported as keywords.
KEYWORD_STOPWORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by",
    "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "do", "does", "did",
]


# A plain substring every match must contain: a cheap test that keeps the
# regular expression away from most texts.
_REQUIRED = {"email": "@", "url": "://", "amount": "$", "percentage": "%"}


def entity_matches(text: Column, entity: str, group: int = 0) -> Column:
    """Distinct matches of one entity type, in order of first appearance."""
    found = F.array_distinct(
        F.regexp_extract_all(text, F.lit(ENTITY_PATTERNS[entity]), F.lit(group))
    )
    if entity not in _REQUIRED:
        return found
    return F.when(text.contains(_REQUIRED[entity]), found).otherwise(
        F.array().cast("array<string>")
    )


def entities(text: Column) -> Column:
    """map<type, array<match>>; types without a match are absent."""
    pairs = [x for name in ENTITY_PATTERNS for x in (F.lit(name), entity_matches(text, name))]
    return F.map_filter(F.create_map(*pairs), lambda _, found: F.size(found) > 0)


_MONTH_STARTS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _iso_date(year: Column, month: Column, day: Column) -> Column:
    """ISO text of a valid calendar date, else null; plain arithmetic, because a
    failing date parser costs an exception per value. Takes values bound by ``let``:
    each is used several times."""
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    last = (
        F.when(month == 2, F.when(leap, 29).otherwise(28))
        .when(month.isin(4, 6, 9, 11), 30)
        .otherwise(31)
    )
    valid = (year >= 1) & month.between(1, 12) & (day >= 1) & (day <= last)
    return F.when(
        valid,
        F.concat(
            F.lpad(year.cast("string"), 4, "0"),
            F.lit("-"),
            F.lpad(month.cast("string"), 2, "0"),
            F.lit("-"),
            F.lpad(day.cast("string"), 2, "0"),
            F.lit("T00:00:00"),
        ),
    )


def _parse_date(name: str, found: Column) -> Column:
    def number(start: int, length: int) -> Column:
        return F.substring(found, start, length).cast("int")

    def bound(numbers: Column, *orders: tuple[int, int, int]) -> Column:
        return let(
            numbers,
            lambda n: F.coalesce(*[_iso_date(*[F.get(n, F.lit(i)) for i in order]) for order in orders]),
        )

    if name == "iso":
        return bound(F.array(number(1, 4), number(6, 2), number(9, 2)), (0, 1, 2))
    if name in ("slash", "dash"):
        # Month first; the other way round when that is no date.
        return bound(F.array(number(1, 2), number(4, 2), number(7, 4)), (2, 0, 1), (2, 1, 0))
    start = F.lower(F.substring(found, 1, 3))
    month = ((F.instr(F.lit(_MONTH_STARTS), start) + 2) / 3).cast("int")

    def numbers(parts: Column) -> Column:
        day = F.replace(F.get(parts, F.lit(1)), F.lit(","), F.lit("")).cast("int")
        return bound(F.array(F.get(parts, F.lit(2)).cast("int"), month, day), (0, 1, 2))

    return let(F.split(found, " "), numbers)


def _date_starts() -> str:
    """Matches nothing wide at the start of every date. Two dates never start at one place, and none
    inside another of its own format, so that one search finds what a search per format would."""
    # The first character is tested before the look behind it, which costs far more.
    ahead = "|".join(rf"(?={pattern.replace('(?i)', '')}{_CLOSE})" for _, pattern in DATE_PATTERNS)
    return rf"(?=[0-9jfmasondJFMASOND]){_OPEN}(?i:{ahead})"


def _date_row(piece: Column, position: Column) -> Column:
    """The date a piece of text starts with; the formats differ in their third or fifth character."""
    third, fifth = F.substring(piece, 3, 1), F.substring(piece, 5, 1)
    number = F.substring(piece, 1, 10)
    month = F.regexp_extract(piece, rf"^{dict(DATE_PATTERNS)['month_name']}{_CLOSE}", 0)

    def row(name: str, found: Column) -> Column:
        return let(
            found,
            lambda m: F.struct(
                m.alias("text"), _parse_date(name, m).alias("date"), position.alias("position"), F.lit(name).alias("format")
            ),
        )

    return (
        F.when(fifth == "-", row("iso", number))
        .when(third == "/", row("slash", number))
        .when(third == "-", row("dash", number))
        .otherwise(row("month_name", month))
    )


def dates(text: Column) -> Column:
    """array<struct<text, date, position, format>>, by pattern, then position."""

    def located(pieces: Column) -> Column:
        # The running length of the pieces gives every offset.
        def rows(starts: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(1), F.size(pieces) - 1),
                lambda i: let(whole(i), lambda p: _date_row(p, F.get(starts, i))),
            )

        def whole(i: Column) -> Column:
            # A date of another format may start inside this one: then its end is in later pieces.
            most = F.lit(_DATE_LENGTH + 1)
            return let(
                F.get(pieces, i),
                lambda p: F.when(F.length(p) >= most, p).otherwise(F.array_join(F.slice(pieces, i + 1, most), "")),
            )

        def of(found: Column, name: str) -> Column:
            return F.filter(found, lambda r: (r["format"] == name) & r["date"].isNotNull())

        def by_format(found: Column) -> Column:
            return F.concat(*[of(found, name) for name, _ in DATE_PATTERNS])

        lengths = F.transform(pieces, lambda p: F.length(p))
        return let(let(prefix_sums(lengths), rows), by_format)

    # The text holds no U+0001 then, which marks the starts, and a plain split takes it apart.
    # The common case, a text without dates, never reaches the offset work.
    marked = F.regexp_replace(F.replace(text, F.lit("\x01"), F.lit("\x02")), _date_starts(), "\x01")
    found = let(
        F.split(marked, "\x01", -1),
        lambda pieces: F.when(F.size(pieces) > 1, located(pieces)).otherwise(F.array().cast(_DATES_TYPE)),
    )
    return F.when(text.rlike("[0-9]{4}"), found).otherwise(F.array().cast(_DATES_TYPE))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def sections(text: Column) -> Column:
    """array<struct<section_no, section, content>>; the last of equal names wins."""

    def is_candidate(line: Column) -> Column:
        # Substring tests are far cheaper than an alternation of twelve words, and no
        # line shorter than the shortest word has one.
        def named(low: Column) -> Column:
            return reduce(lambda a, b: a | b, [low.contains(w) for w in SECTION_WORDS])

        short = min(map(len, SECTION_WORDS))
        return (
            (F.length(line) >= short)
            & let(F.lower(line), named)
            & (F.regexp_count(strip(line), F.lit(rf"[{SPACE}]+")) + 1 < 10)
        )

    def flags(lines: Column) -> Column:
        # One letter per line. A candidate right after a header is content, and
        # so is line 0: read left to right, each "cc?" starts with a header.
        marks = F.array_join(
            F.transform(
                lines,
                lambda line, i: F.when((i > 0) & is_candidate(line), "c").otherwise("n"),
            ),
            "",
        )
        return F.split(F.regexp_replace(marks, "c(c?)", "H$1"), "")

    def build(lines: Column, starts: Column) -> Column:
        def one(start: Column, j: Column) -> Column:
            stop = F.coalesce(F.get(starts, j + 1), F.size(lines))
            return F.struct(
                F.when(j == 0, "header")
                .otherwise(F.lower(strip(F.get(lines, start))))
                .alias("section"),
                j.alias("section_no"),
                (stop - start - 1).alias("n_lines"),
                F.array_join(F.slice(lines, start + 2, stop - start - 1), "\n").alias("content"),
            )

        kept = F.filter(F.transform(starts, one), lambda s: s["n_lines"] > 0)
        return let(
            F.sort_array(kept),
            lambda s: F.filter(
                s,
                lambda x, i: ~F.coalesce(
                    F.get(s, i + 1)["section"] == x["section"], F.lit(False)
                ),
            ),
        )

    def over_lines(lines: Column) -> Column:
        heads = let(
            flags(lines),
            lambda f: F.filter(indices(F.size(lines)), lambda i: F.get(f, i) == "H"),
        )
        return let(
            F.concat(F.array(F.lit(-1)), heads), lambda starts: build(lines, starts)
        )

    ordered = F.sort_array(
        F.transform(
            let(lines_of(text), over_lines),
            lambda s: F.struct(s["section_no"], s["section"], s["content"]),
        )
    )
    return ordered


def tables(text: Column, flush_last: bool = False) -> Column:
    """array<struct<rows, content, start_line, end_line>> of tabular line runs.

    A run that touches the end of the text is only reported with ``flush_last``.
    """
    tabular = rf"[\t|]{{2}}|[{SPACE}]{{2}}[^\n]+[{SPACE}]{{2}}"

    def over_lines(lines: Column, flags: Column) -> Column:
        def edge(step: int) -> Column:
            return F.filter(
                indices(F.size(lines)),
                lambda i: F.get(flags, i)
                & ~F.coalesce(F.when(i + step >= 0, F.get(flags, i + step)), F.lit(False)),
            )

        runs = F.zip_with(
            edge(-1),
            edge(1),
            lambda a, b: F.struct(a.alias("first"), b.alias("last")),
        )
        found = F.filter(
            runs,
            lambda r: (r["last"] > r["first"])
            & (F.lit(flush_last) | (r["last"] < F.size(lines) - 1)),
        )
        return F.transform(
            found,
            lambda r: F.struct(
                (r["last"] - r["first"] + 1).alias("rows"),
                F.array_join(
                    F.slice(lines, r["first"] + 1, r["last"] - r["first"] + 1), "\n"
                ).alias("content"),
                r["first"].alias("start_line"),
                r["last"].alias("end_line"),
            ),
        )

    return let(
        lines_of(text),
        lambda lines: let(
            F.transform(lines, lambda line: line.rlike(tabular)),
            lambda flags: over_lines(lines, flags),
        ),
    )


def keyword_counts(text: Column, top_n: int = 10) -> Column:
    """array<struct<token, n>> behind :func:`keywords`."""
    bare = F.regexp_replace(F.lower(text), r"\p{Punct}+", "")
    words = F.filter(
        F.regexp_extract_all(bare, F.lit(rf"[^{SPACE}]+"), F.lit(0)),
        lambda w: (F.length(w) > 2) & ~w.isin(KEYWORD_STOPWORDS),
    )
    return top_tokens(words, top_n)


def keywords(text: Column, top_n: int = 10) -> Column:
    return F.transform(keyword_counts(text, top_n), lambda k: k["token"])


def doc_metadata(text: Column) -> Column:
    return F.struct(
        F.size(lines_of(text)).alias("line_count"),
        F.size(paragraphs(text)).alias("paragraph_count"),
        F.greatest(F.lit(1), F.floor(F.length(text) / 2500).cast("int")).alias(
            "estimated_pages"
        ),
    )


def section_map(text: Column) -> Column:
    return F.map_from_entries(
        F.transform(sections(text), lambda s: F.struct(s["section"], s["content"]))
    )


def document_structure(text: Column, parts: Sequence[str] | None = None) -> Column:
    """Everything above as one struct, or the named parts of it: Spark computes a struct
    whole, whichever of its fields are read."""
    known = {
        "entities": entities,
        "dates": dates,
        "sections": section_map,
        "tables": tables,
        "keywords": keywords,
        "metadata": doc_metadata,
    }
    return F.struct(*[fn(text).alias(name) for name, fn in known.items() if parts is None or name in parts])

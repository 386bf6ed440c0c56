"""Source divergence audit: term frequencies by bytes.translate, compared exactly.

``bytes.translate`` lowers A-Z and blanks every ASCII byte that is no letter in one
pass, ``bytes.split`` cuts the rest and a Counter per document gives its frequencies.
A worker adds the Counters up per (lang, source) and hands the sums to Spark whenever
it holds ``MOST_TERMS`` of them, so only partial sums are shuffled and a source of any
size is spread over all tasks.

Within a language every pair of sources is compared over all kept terms. Only terms
that one of the two has are visited: the others share one value, which is multiplied by
their number. Sources are dealt into tiles of about ``TILE_SOURCES`` and terms into
chunks of about ``CHUNK_TERMS`` by hash; a task gets two tiles and one chunk and returns
one sum for each pair of their sources, never a row for each pair and term.

Defined cases: null text, lang and source are ''; a group without terms, or a language
without kept terms, still has its rows (value 0 where no term is kept); a very long text
is counted whole in one task; repeated rows count as often as they occur; equal values
are ranked by the bytes of the item; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import stored
from foliant.operators.joins import lookup

LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
MOST_TERMS = 200_000
TILE_SOURCES = 256
CHUNK_TERMS = 2_048

# ASCII letters (lowered) and all bytes of longer characters stay, the rest is blank.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_COUNTS = "lang string, source string, term binary, n long, docs long"


def term_counts(text: bytes | None) -> Counter:
    """term (UTF-8, lowered) -> occurrences in one text."""
    return Counter((text or b"").translate(_TABLE).split())


def _rows(held: dict) -> pa.RecordBatch:
    langs, sources, terms, ns, docs = [], [], [], [], []
    for (lang, source), (occurs, appears) in held.items():
        # One row without a term says that the group exists.
        size = len(occurs) + 1
        langs += [lang] * size
        sources += [source] * size
        terms += [None, *occurs]
        ns += [0, *occurs.values()]
        docs += [0, *(appears[t] for t in occurs)]
    columns = [
        pa.array(langs, pa.string()),
        pa.array(sources, pa.string()),
        pa.array(terms, pa.binary()),
        pa.array(ns, pa.int64()),
        pa.array(docs, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def source_counts(docs: DataFrame, most_terms: int = MOST_TERMS) -> DataFrame:
    """lang, source, term, n, docs (that hold it); a row with a null term for every group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = defaultdict(lambda: (Counter(), Counter()))
        size = 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "source", "text"))
            for lang, source, text in zip(*columns, strict=True):
                occurs, appears = held[lang, source]
                before = len(appears)
                found = term_counts(text)
                appears.update(found.keys())
                for term, n in found.items():
                    occurs[term] += n
                size += len(appears) - before
                if size >= most_terms:
                    yield _rows(held)
                    held.clear()
                    size = 0
        if held:
            yield _rows(held)

    def named(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    texts = docs.select(named("lang"), named("source"), F.col("text").cast("binary").alias("text"))
    sums = texts.mapInArrow(run, _COUNTS).groupBy("lang", "source", "term")
    return sums.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact beyond 64 bits."""
    top = f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0))"
    return F.expr(f"CAST(1 + ({top}) div CAST(nullif({total} + 2 * {terms}, 0) AS DECIMAL(20,0)) AS BIGINT)")


def _difference(p, q):
    return (p - q) * (p - q) // (p + q)


def _tile_sums(group: pd.DataFrame) -> pd.DataFrame:
    """lang, source, item, value: the chunk's share of every pair's sum, both ways round.

    ``group`` has the rows of two tiles (or of one) and a row without a term for
    each of their sources, which carries the share of absent terms.
    """
    lang, chunk, kept = group["lang"].iat[0], group["chunk"].iat[0], int(group["terms"].iat[0])
    left, right = group["left"].iat[0], group["right"].iat[0]
    anchors = group[group["term"].isna()].drop_duplicates("source")
    names = anchors["source"].to_numpy()
    place = {s: k for k, s in enumerate(names)}
    # Without kept terms no share is defined and every sum is 0.
    absent = anchors["p0"].fillna(1).to_numpy(np.int64)
    found = group[group["term"].notna()]
    column, terms = pd.factorize(found["term"].map(bytes))
    p = np.repeat(absent[:, None], len(terms), axis=1)
    p[found["source"].map(place).to_numpy(np.int64), column] = found["p"].to_numpy(np.int64)
    tile, number = anchors["tile"].to_numpy(), np.arange(len(names))
    out = [pd.DataFrame({"source": names[:0], "item": names[:0], "value": np.empty(0, np.int64)})]
    for i in np.flatnonzero(tile == left):
        # Each pair once: within a tile the later sources, else those of the other tile.
        partners = np.flatnonzero((tile == right) & ((left != right) | (number > i)))
        base = _difference(absent[i], absent[partners])
        totals = _difference(p[i], p[partners]).sum(axis=1) - base * len(terms)
        if chunk == 0:
            totals += base * kept
        out.append(pd.DataFrame({"source": names[i], "item": names[partners], "value": totals}))
    once = pd.concat(out)
    both = pd.concat([once, once.rename(columns={"source": "item", "item": "source"})])
    return both.assign(lang=lang)[["lang", "source", "item", "value"]]


def _pairs(shares: DataFrame, groups: DataFrame, tile_sources: int, chunk_terms: int) -> DataFrame:
    """lang, source, item, value of every ordered pair of sources of a language."""
    tiles = F.ceil(F.col("sources") / tile_sources).cast("int")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("terms") / chunk_terms)).cast("int")
    tile = F.pmod(F.xxhash64("source"), tiles).cast("int").alias("tile")
    columns = ["lang", "source", "term", "p", "p0", "terms", "tile", "tiles", "chunk"]
    rows = shares.select(
        "*", tile, tiles.alias("tiles"), F.pmod(F.xxhash64("term"), chunks).cast("int").alias("chunk")
    ).select(*columns)
    anchors = groups.select(
        "*",
        tile,
        tiles.alias("tiles"),
        F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"),
        F.lit(None).cast("binary").alias("term"),
        F.lit(None).cast("long").alias("p"),
    ).select(*columns)
    dealt = (
        rows.unionByName(anchors)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "*", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right")
        )
        .drop("tiles", "other")
    )
    sums = dealt.groupBy("lang", "left", "right", "chunk").applyInPandas(
        _tile_sums, "lang string, source string, item string, value long"
    )
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
    tile_sources: int = TILE_SOURCES,
    chunk_terms: int = CHUNK_TERMS,
) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank.

    ``pair``: how far each other source of the language is; ``term``: the terms by
    which a source differs most from its language. ``docs`` has text, lang, source.
    """
    counts = stored(source_counts(docs))
    kept = stored(
        counts.filter("term IS NOT NULL")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= least_docs)
        .drop("docs")
    )
    found = stored(counts.filter("term IS NOT NULL").select("lang", "source", "term", "n").join(kept, ["lang", "term"]))
    named = counts.filter("term IS NULL").select("lang", "source")
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = (
        named.groupBy("lang")
        .agg(F.count("*").alias("sources"))
        .join(kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total")), "lang", "left")
        .na.fill(0)
    )
    groups = named.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(langs, "lang")
    groups = stored(groups.select("*", _share("0", "total", "terms").alias("p0")))
    key = F.struct("lang", "source").alias("key")
    known = groups.select(key, "total", "sources", "terms", "lang_total", "p0")
    shares = lookup(found.select("*", key), known, "key").select(
        "*",
        _share("n", "total", "terms").alias("p"),
        _share("lang_n", "lang_total", "terms").alias("q"),
    )

    distance = "((p - q) * (p - q)) div (p + q)"
    above = shares.filter("n > 0 AND p > q").select(
        "lang", "source", F.col("term").cast("string").alias("item"), F.expr(distance).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    pairs = _pairs(shares, groups, tile_sources, chunk_terms).withColumn("rank", F.row_number().over(order))

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(pairs, "pair").unionByName(part(terms, "term"))

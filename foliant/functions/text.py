"""Text cleaning and counting as native expressions."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.arrays import top_tokens

# Word and space character classes, Unicode-wide and the same on every JVM.
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\p{Z}\x1c-\x1f\x85"

# The common English stopword list used for cleaning.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Fused words a word tokenizer splits, as (head, tail).
FUSED_WORDS = [
    ("can", "not"),
    ("gim", "me"),
    ("gon", "na"),
    ("got", "ta"),
    ("lem", "me"),
    ("wan", "na"),
]

LEMMAS_PER_MAP = 50


def stopwords_for(language: str = "english") -> list[str]:
    """Stopword list of a language; unknown languages fall back to English."""
    if language == "english":
        return ENGLISH_STOPWORDS
    try:
        return list(StopWordsRemover.loadDefaultStopWords(language))
    except Exception:  # noqa: BLE001 - the JVM raises for an unknown language
        return ENGLISH_STOPWORDS


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def remove_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{Nd}+", " ")


def remove_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, rf"[^{WORD}{SPACE}]", " ")


def squeeze_spaces(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def split_fused(text: Column) -> Column:
    heads = "|".join(rf"{a}(?={b}(?![{WORD}]))" for a, b in FUSED_WORDS)
    return F.regexp_replace(text, rf"(?=[cglw])(?<![{WORD}])({heads})", "$1 ")


def raw_tokens(text: Column) -> Column:
    """Word runs and single punctuation marks."""
    return F.regexp_extract_all(
        split_fused(text), F.lit(rf"[{WORD}]+|[^{WORD}{SPACE}]"), F.lit(0)
    )


def word_tokens(text: Column) -> Column:
    """Tokens of text whose punctuation is already gone."""
    return F.regexp_extract_all(split_fused(text), F.lit(rf"[^{SPACE}]+"), F.lit(0))


def normalized_tokens(
    text: Column,
    *,
    remove_numbers: bool = True,
    strip_punctuation: bool = True,
    remove_extra_spaces: bool = True,
    stopwords: Sequence[str] | None = None,
) -> Column:
    """Lower-case, strip, tokenize, drop stopwords (no length test yet)."""
    cleaned = F.lower(text)
    if remove_numbers and strip_punctuation and remove_extra_spaces:
        # One regex pass instead of three: whatever is neither a letter, a
        # non-decimal number nor "_" ends up as a single space.
        cleaned = F.btrim(F.regexp_replace(cleaned, r"[^\p{L}\p{Nl}\p{No}_]+", " "))
        tokens = F.filter(F.split(split_fused(cleaned), " "), lambda t: t != "")
    else:
        if remove_numbers:
            cleaned = remove_digits(cleaned)
        if strip_punctuation:
            cleaned = remove_punctuation(cleaned)
        if remove_extra_spaces:
            cleaned = squeeze_spaces(cleaned)
        tokens = word_tokens(cleaned) if strip_punctuation else raw_tokens(cleaned)
    if stopwords:
        tokens = F.filter(tokens, lambda t: ~t.isin(list(stopwords)))
    return tokens


def lemma_finder(lemmas: Mapping[str, str]) -> Callable[[Column], Column]:
    """Token -> its lemma or null.

    A map is searched from end to end, so the dictionary is dealt to small maps by
    the checksum of the token.
    """
    n = -(-len(lemmas) // LEMMAS_PER_MAP)
    maps: list[dict[str, str]] = [{} for _ in range(n)]
    for surface, lemma in lemmas.items():
        maps[zlib.crc32(surface.encode()) % n][surface] = lemma
    table = F.from_json(F.lit(json.dumps(maps)), "array<map<string,string>>")
    return lambda t: F.get(table, (F.crc32(t) % n).cast("int"))[t]


def clean_tokens(
    text: Column,
    *,
    remove_stopwords: bool = True,
    lemmas: Mapping[str, str] | None = None,
    remove_numbers: bool = True,
    strip_punctuation: bool = True,
    remove_extra_spaces: bool = True,
    min_word_length: int = 2,
    stopwords: Sequence[str] | None = None,
    language: str = "english",
) -> Column:
    """Cleaned tokens; stopwords go before lemmas, the length test comes last.

    ``lemmas`` is a dictionary of the caller, written into the plan; a dictionary
    kept as a table is joined instead, see ``operators.cleaning.clean_documents``.
    """
    words = stopwords if stopwords is not None else stopwords_for(language)
    tokens = normalized_tokens(
        text,
        remove_numbers=remove_numbers,
        strip_punctuation=strip_punctuation,
        remove_extra_spaces=remove_extra_spaces,
        stopwords=words if remove_stopwords else None,
    )
    if lemmas:
        find = lemma_finder(lemmas)
        tokens = F.transform(tokens, lambda t: F.coalesce(find(t), t))
    return F.filter(tokens, lambda t: F.length(t) >= min_word_length)


def clean_text(text: Column, **options) -> Column:
    """Cleaned text; null and empty become the empty string."""
    return F.coalesce(F.array_join(clean_tokens(text, **options), " "), F.lit(""))


def remove_html_tags(html: Column) -> Column:
    """Delete tags that open and close on one line; entities and bodies stay."""
    return F.regexp_replace(html, r"<[^>\n]*>", "")


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+", "")


def remove_emails(text: Column) -> Column:
    """Delete every non-space run that holds an inner ``@``.

    Same result as a greedy ``\\S+@\\S+``, but anchored at the start of the run
    and possessive, so a long run without ``@`` costs linear, not squared time.
    """
    run_start = rf"(?<![^{SPACE}])[^{SPACE}]"
    return F.regexp_replace(text, rf"{run_start}[^{SPACE}@]*+@[^{SPACE}]+", "")


def sentences(text: Column) -> Column:
    """Split after ``. ! ?`` followed by space; empty pieces are dropped."""
    return F.filter(
        F.split(strip(text), rf"(?<=[.!?])[{SPACE}]+", -1), lambda s: s != ""
    )


def paragraphs(text: Column) -> Column:
    """Split on blank lines, strip, drop empty."""
    return F.filter(F.transform(F.split(text, "\n\n", -1), strip), lambda p: p != "")


def word_frequency(text: Column, top_n: int = 20) -> Column:
    """array<struct<token, n>>: most frequent first, ties by first appearance."""
    return top_tokens(clean_tokens(text, remove_stopwords=False), top_n)


def text_stats(text: Column, cleaned_tokens: Column | None = None, **options) -> Column:
    """struct of length, sentence, paragraph and word counts and averages."""
    tokens = cleaned_tokens if cleaned_tokens is not None else clean_tokens(text, **options)
    words = F.size(raw_tokens(text))
    n_sentences = F.size(sentences(text))
    visible = F.length(F.regexp_replace(text, rf"[{SPACE}]+", ""))
    return F.struct(
        F.length(text).alias("original_length"),
        F.length(F.array_join(tokens, " ")).alias("cleaned_length"),
        n_sentences.alias("sentence_count"),
        F.size(paragraphs(text)).alias("paragraph_count"),
        words.alias("word_count"),
        F.size(tokens).alias("cleaned_word_count"),
        (words / F.greatest(n_sentences, F.lit(1))).alias("avg_sentence_length"),
        (visible / F.greatest(words, F.lit(1))).alias("avg_word_length"),
    )


def word_count(cleaned: Column) -> Column:
    """Words of an already cleaned text."""
    return F.when(cleaned == "", 0).otherwise(F.size(F.split(cleaned, " ")))


def preview(text: Column, limit: int = 1000) -> Column:
    """First ``limit`` characters, followed by ``...`` when cut."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))
    ).otherwise(text)

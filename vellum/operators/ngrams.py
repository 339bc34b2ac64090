"""Segments, tokens and n-gram counts of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that end a segment.
SEGMENT_CHARACTERS = "!(),.:;?[]{}"


def segments(text: Column, characters: str = SEGMENT_CHARACTERS) -> Column:
    """Trimmed, non-empty parts between segmentation characters."""
    cls = "".join("\\" + c for c in characters)
    parts = F.transform(F.split(text, f"[{cls}]"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    return F.filter(parts, lambda s: s != "")


def tokens(segment: Column, keep_empty: bool = False) -> Column:
    parts = F.split(segment, "[ \n]")
    return parts if keep_empty else F.filter(parts, lambda t: t != "")


def spans(words: Column, max_n: int = 5) -> Column:
    """struct(ngram, n, first, last) of all runs of up to max_n words."""
    size = F.size(words)
    starts = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))

    def from_start(i: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.least(F.lit(max_n), size - i + 1)), lambda n: F.struct(F.array_join(F.slice(words, i, n), " ").alias("ngram"), n.alias("n"), F.get(words, i - 1).alias("first"), F.get(words, i + n - 2).alias("last")))

    return F.flatten(F.transform(starts, from_start))


def stop_forms(words: list[str], any_capitalization: bool = True) -> list[str]:
    if not any_capitalization:
        return sorted(set(words))
    return sorted({f for w in words for f in (w.lower(), w.capitalize(), w.upper())})


def segment_counts(df: DataFrame, text: str, characters: str = SEGMENT_CHARACTERS) -> DataFrame:
    return df.select(F.explode(segments(F.col(text), characters)).alias("segment")).groupBy("segment").agg(F.count("*").alias("count"))


def token_counts(df: DataFrame, text: str, characters: str = SEGMENT_CHARACTERS) -> DataFrame:
    cls = "".join("\\" + c for c in characters)
    return df.select(F.explode(F.filter(F.split(F.col(text), f"[ \n{cls}]"), lambda t: t != "")).alias("token")).groupBy("token").agg(F.count("*").alias("count"))


def ngram_counts(df: DataFrame, text: str, max_n: int = 5, minimum: int = 25, stop_words: list[str] = (), any_capitalization: bool = True, characters: str = SEGMENT_CHARACTERS) -> DataFrame:
    """ngram, n, count over distinct texts, for counts above the minimum.

    N-grams stay within a segment. Equal segments are counted before they are opened, so
    each distinct segment is taken apart once. Those that begin or end with a stop word go.
    """
    distinct = segment_counts(df.select(text).distinct(), text, characters)
    out = distinct.select(F.explode(spans(tokens(F.col("segment")), max_n)).alias("g"), "count").select("g.*", "count")
    if stop_words:
        stop = stop_forms(list(stop_words), any_capitalization)
        out = out.where(~F.col("first").isin(stop) & ~F.col("last").isin(stop))
    return out.groupBy("ngram", "n").agg(F.sum("count").alias("count")).where(F.col("count") > minimum)


def ngram_tables(df: DataFrame, text: str, max_n: int = 5, minimum: int = 25, stop_words: list[str] = (), any_capitalization: bool = True, characters: str = SEGMENT_CHARACTERS) -> dict[str, DataFrame]:
    """What an n-gram study of captions needs, by one call: ``segments``, ``tokens`` and ``ngrams`` with their counts over distinct texts."""
    distinct = df.select(text).distinct()
    return {
        "segments": segment_counts(distinct, text, characters),
        "tokens": token_counts(distinct, text, characters),
        "ngrams": ngram_counts(df, text, max_n, minimum, stop_words, any_capitalization, characters),
    }

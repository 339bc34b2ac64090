"""Reconciliation of filtered article, case and image levels by semi-joins."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.operators.sequences import row_ids

#: Dataset types whose cases must have an image.
NEEDS_IMAGE = {"text": True, "case_series": True, "image": False, "multimodal": False}


class Levels(NamedTuple):
    articles: DataFrame
    cases: DataFrame
    images: DataFrame


def harmonize(articles: DataFrame, cases: DataFrame, images: DataFrame, article_key: str, case_key: str, dataset_type: str = "multimodal", require_images: bool | None = None) -> Levels:
    """Keep what the other levels allow.

    ``cases`` has both keys, ``images`` has both too. Articles stay that have a kept case;
    where images are required, also a kept image, be it of another of their cases. Cases
    stay whose article stays; where images are required, those with an image. Images stay
    whose article and case stay. Nothing is gathered: every step is an equi semi-join.
    """
    if dataset_type not in NEEDS_IMAGE:
        raise ValueError(f"dataset_type must be one of {tuple(NEEDS_IMAGE)}, not {dataset_type!r}")
    strict = NEEDS_IMAGE[dataset_type] if require_images is None else require_images
    kept = articles.join(cases.select(article_key), article_key, "left_semi")
    if strict:
        kept = kept.join(images.select(article_key), article_key, "left_semi")
    keys = kept.select(article_key)
    good = cases.join(keys, article_key, "left_semi")
    if strict:
        good = good.join(images.select(case_key), case_key, "left_semi")
    shown = images.join(keys, article_key, "left_semi").join(good.select(case_key), case_key, "left_semi")
    return Levels(kept, good, shown)


def with_image_counts(cases: DataFrame, images: DataFrame, case_key: str, name: str = "amount_of_images") -> DataFrame:
    """Cases that have images, with their number."""
    return cases.join(images.groupBy(case_key).agg(F.count("*").alias(name)), case_key)


def drop_ambiguous(df: DataFrame, key: str) -> DataFrame:
    """Drop all rows of a key that is null or occurs more than once. The rows are made and shuffled once, with their counts."""
    others = [F.first(F.col(f"`{c}`")).alias(c) for c in df.columns if c != key]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"), *others).where("__n = 1").select(*[f"`{c}`" for c in df.columns])


def class_subsets(subsets: dict[str, DataFrame], key: str, name: str = "class") -> DataFrame:
    """The subsets under one another with their class; keys in several of them are dropped."""
    out = None
    for label, df in subsets.items():
        df = df.withColumn(name, F.lit(label))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return drop_ambiguous(out, key)


def new_rows(incoming: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't known yet."""
    return incoming.join(known.select(key), key, "left_anti")


def merge_update(previous: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The previous table and the new rows; columns that one lacks are null."""
    return previous.unionByName(new_rows(incoming, previous, key), allowMissingColumns=True)


def update(previous: DataFrame, incoming: DataFrame, key: str, year: str, order: list[str], prefix: str, width: int, name: str = "file_id") -> DataFrame:
    """One update: new rows of the last known year and later are appended, and all rows numbered anew.

    ``previous`` has a row at least; rows of the incoming table whose year is null or no number don't count as late.
    """
    last = previous.agg(F.max(F.col(year).try_cast("int"))).first()[0]
    late = incoming.where(F.col(year).try_cast("int") >= F.lit(last))
    return row_ids(merge_update(previous, late, key).drop(name), order, prefix, width, name)


def fill_from(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join; null values of ``columns`` are filled from the right side."""
    other = right.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = left.join(other, key, "left")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in columns else F.col(c) for c in left.columns])

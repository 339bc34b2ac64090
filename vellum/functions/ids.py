"""Key grammar of articles, cases and image files as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def article_of(case_id: Column) -> Column:
    """The article key: what stands before the first underscore of a case key."""
    return F.substring_index(case_id, "_", 1)


def case_of(image_id: Column) -> Column:
    """The case key: the first two underscore-separated parts of an image key."""
    return F.substring_index(image_id, "_", 2)


def file_part(file: Column, from_end: int) -> Column:
    """A part of a file name counted from its end; null if there are fewer parts."""
    return F.try_element_at(F.split(file, "_"), F.lit(-from_end))


def image_component(file: Column) -> Column:
    return F.lower(file_part(file, 3))


def shard_path(file: Column, first: int = 4, second: int = 5) -> Column:
    """Two folder levels cut from a file's name, then the file."""
    return F.concat_ws("/", F.substring(file, 1, first), F.substring(file, 1, second), file)


def numbered(prefix: str, number: Column, width: int) -> Column:
    """prefix and a zero-padded number; a longer number keeps its last digits."""
    return F.concat(F.lit(prefix), F.right(F.concat(F.lit("0" * width), number.cast("string")), F.lit(width)))


def subcaption_file(stem: Column, reference: Column, order: Column, amount: Column, extension: Column) -> Column:
    return F.concat(F.concat_ws("_", stem, reference, order.cast("string"), amount.cast("string")), F.lit("."), extension)


def parse_subcaption_file(file: Column) -> Column:
    """struct(stem, reference, order, amount, extension) of such a name; the stem may hold underscores."""
    parts = F.split(F.regexp_replace(file, r"\.[^.]*$", ""), "_")
    return F.struct(
        F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 3, F.lit(0))), "_").alias("stem"),
        F.try_element_at(parts, F.lit(-3)).alias("reference"),
        F.try_element_at(parts, F.lit(-2)).try_cast("int").alias("order"),
        F.try_element_at(parts, F.lit(-1)).try_cast("int").alias("amount"),
        F.regexp_extract(file, r"\.([^.]*)$", 1).alias("extension"),
    )

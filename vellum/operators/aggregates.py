"""Aggregations: value domains, counts, merged maps, label weights, confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values; arrays are opened first."""
    c = F.explode(column) if dict(df.dtypes)[column].startswith("array") else F.col(column)
    return df.select(c.alias("value")).where("value is not null").distinct()


def label_counts(df: DataFrame, labels: str) -> DataFrame:
    return df.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count("*").alias("amount"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """1 / sqrt(rows) for each label."""
    return df.groupBy(label).agg((1 / F.sqrt(F.count("*"))).alias("weight"))


def label_stats(df: DataFrame, label: str, measures: dict[str, str], digits: int = 1) -> DataFrame:
    """Rows and rounded means for each label."""
    means = [F.round(F.avg(c), digits).alias(name) for name, c in measures.items()]
    return df.groupBy(label).agg(F.count("*").alias("amount"), *means)


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Counts of (truth, predicted) and their share of the truth's rows."""
    counts = df.groupBy(truth, predicted).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(truth)))


def repeated(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def varied(df: DataFrame, key: str, column: str) -> DataFrame:
    """Whether a key has more than one value of a column."""
    return df.groupBy(key).agg((F.countDistinct(column) > 1).alias("varied"))


def merged_maps(df: DataFrame, key: str, entry_key: str, value: str, order: Column) -> DataFrame:
    """For each key the map from entry to its values, in order."""
    per = df.groupBy(key, entry_key).agg(F.min(order).alias("first"), F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col(value).alias("v")))), lambda p: p["v"]).alias("values"))
    entries = F.array_sort(F.collect_list(F.struct("first", F.col(entry_key).alias("k"), "values")))
    return per.groupBy(key).agg(F.transform(entries, lambda e: F.struct(e["k"].alias("k"), e["values"].alias("v"))).alias("entries"))


def replace_tokens(text: Column, entries: Column, token: str | None = None) -> Column:
    """Replace each mention, in order, by its files in angle brackets, or by the token once a file."""
    by = lambda f: F.lit(token) if token else F.concat(F.lit("<"), f, F.lit(">"))
    return F.aggregate(entries, text, lambda t, e: F.replace(t, e["k"], F.array_join(F.transform(e["v"], by), "")))

"""Readers of nested parquet, CSV with list cells, JSON and binary files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.ids import article_of, case_of
from vellum.functions.text import parse_list_column


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """One row per article with its metadata opened."""
    df = spark.read.parquet(path)
    fields = [f for f in df.schema["article_metadata"].dataType.names if f != "pmcid"]
    return df.select(F.col("article_id").alias("pmcid"), *[F.col("article_metadata").getField(f).alias(f) for f in fields])


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """One row per case, with its article's key."""
    return spark.read.parquet(path).select(F.inline("cases")).withColumn("pmcid", article_of(F.col("case_id")))


def read_case_images(spark: SparkSession, path: str) -> DataFrame:
    """One row per image of the three-level nesting."""
    outer = spark.read.parquet(path).select("article_id", F.explode("case_images").alias("c"))
    return outer.select("article_id", F.col("c.case_id").alias("case_id"), F.explode("c.case_image_list").alias("i")).select("article_id", "case_id", "i.*")


def read_captions(spark: SparkSession, path: str, list_columns: tuple[str, ...] = (), key: str = "main_image") -> DataFrame:
    """Image rows of a CSV whose list cells are Python literals; keys are derived from the image key."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    for c in list_columns:
        df = df.withColumn(c, parse_list_column(F.col(c)))
    return df.withColumn("case_id", case_of(F.col(key))).withColumn("pmcid", article_of(F.col(key)))


def read_json(spark: SparkSession, path: str, lines: bool = True, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path, multiLine=not lines)


def read_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, file and size of all files below a folder; contents aren't read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("file_size"))


def search_string(term: str, synonyms: list[str], exclude: list[str] = ()) -> str:
    """A boolean query: the term or any synonym, and none of the excluded."""
    wanted = " OR ".join(f'"{t}"' for t in [term, *synonyms])
    return f"({wanted})" + "".join(f' NOT "{x}"' for x in exclude)

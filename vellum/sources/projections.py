"""The tables of an exported dataset, projected from the reconciled levels, and image tokens in case texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.ids import article_of, image_component, shard_path
from vellum.operators.aggregates import merged_maps, replace_tokens

#: The fields of each exported table, in order.
CITATION = ["pmcid", "doi", "pmid", "title", "year", "authors", "journal", "journal_detail", "link", "license"]
ARTICLE = ["pmcid", "license", "keywords", "mesh_terms", "major_mesh_terms"]
CASE = ["case_id", "pmcid", "gender", "age", "case_text"]
IMAGE = ["file_id", "file", "file_path", "main_image", "case_id", "license", "file_size", "split_during_preprocessing", "caption", "image_type", "image_subtype", "radiology_region", "radiology_region_granular", "radiology_view", "ml_labels_for_supervised_classification", "gt_labels_for_semisupervised_classification"]
#: Fixed value: where an article is read online.
ARTICLE_LINK = "https://www.ncbi.nlm.nih.gov/pmc/articles/"


def fields_of(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns in order; those that the table lacks are null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in names])


def citations(articles: DataFrame) -> DataFrame:
    return fields_of(articles, CITATION)


def article_metadata(articles: DataFrame) -> DataFrame:
    return fields_of(articles, ARTICLE)


def case_table(cases: DataFrame) -> DataFrame:
    """The cases with their article's key, which their own begins with."""
    return fields_of(cases.withColumn("pmcid", article_of(F.col("case_id"))), CASE)


def was_split(component: Column) -> Column:
    """Whether an image is part of one that was cut."""
    return F.coalesce(component != "undivided", F.lit(False))


def image_table(images: DataFrame, folder: str, labels: list[str] = (), component: str = "image_component") -> DataFrame:
    """The images with their path in the dataset; ``labels`` are further label columns to keep.

    Where there is no ``component`` column, the file's name tells it.
    """
    part = F.col(component) if component in images.columns else image_component(F.col("file"))
    out = images.withColumn("file_path", F.concat_ws("/", F.lit(folder), F.lit("images"), shard_path(F.col("file"))))
    if "case_id" not in out.columns and "patient_id" in out.columns:
        out = out.withColumnRenamed("patient_id", "case_id")
    return fields_of(out.withColumn("split_during_preprocessing", was_split(part)), [*IMAGE, *labels])


def case_link(article: Column) -> Column:
    return F.concat(F.lit(ARTICLE_LINK), article, F.lit("/"))


def case_folder(case_id: Column) -> Column:
    """Two folder levels cut from the case's key, then the case."""
    return F.concat(F.lit("images/"), shard_path(case_id))


def case_series_table(cases: DataFrame, images: DataFrame) -> DataFrame:
    """Cases that have images, with their number, the article's link and the images' folder."""
    counts = images.groupBy("case_id").agg(F.count("*").alias("amount_of_images"))
    return case_table(cases).withColumn("link", case_link(F.col("pmcid"))).join(counts, "case_id").withColumn("image_folder", case_folder(F.col("case_id")))


def with_image_tokens(cases: DataFrame, images: DataFrame, mentions: str = "case_substring", token: str | None = None) -> DataFrame:
    """Case texts with each mention of a figure replaced by its files in angle brackets, or by the token once a file.

    Mentions are replaced one after the other, in the order of the files that first hold
    them. All images of a case count, not only those that a filter left.
    """
    opened = images.select("case_id", "file", F.posexplode(mentions).alias("__place", "__mention"))
    entries = merged_maps(opened, "case_id", "__mention", "file", F.struct("file", "__place"))
    joined = cases.join(entries.withColumnRenamed("entries", "__entries"), "case_id", "left")
    replaced = replace_tokens(F.col("case_text"), F.col("__entries"), token)
    return joined.withColumn("case_text", F.coalesce(replaced, F.col("case_text"))).select(*cases.columns)


def vertical_split(articles: DataFrame, key: str = "pmcid") -> dict[str, DataFrame]:
    """The four tables of nested articles: metadata, abstracts, cases, case images."""
    nested = {"abstract", "cases", "case_images"}
    metadata = articles.select(F.col(key).alias("article_id"), F.struct(*[c for c in articles.columns if c not in nested]).alias("article_metadata"))
    one = lambda c: articles.select(F.col(key).alias("article_id"), c)
    return {"metadata": metadata, **{name: one(c) for name, c in (("abstracts", "abstract"), ("cases", "cases"), ("case_images", "case_images")) if c in articles.columns}}


def with_extension(file: Column, new: str, old: str = "jpg") -> Column:
    """The file's name with another extension, if it ends with the old one."""
    return F.regexp_replace(file, rf"\.{old}$", f".{new}")

"""Mentions of figures in case texts, joined to the images and parts they speak of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import extract_figure_numbers, figure_sentences

#: Fixed value: the component of an image that wasn't cut.
UNDIVIDED = "undivided"


def sentence_figures(cases: DataFrame, images: DataFrame, case: str, text: str, order: str) -> DataFrame:
    """The images with ``text_references``: the sentences of their case that mention their figure number, in the text's order.

    Sentences are opened to one row a mentioned number and meet the images in an equi-join;
    each image has its own list. Images that no sentence mentions have an empty one.
    """
    opened = cases.select(case, F.posexplode(figure_sentences(F.col(text))).alias("__place", "__sentence"))
    numbered = opened.withColumn(order, F.explode(F.array_distinct(extract_figure_numbers(F.col("__sentence")))))
    lists = numbered.groupBy(case, order).agg(F.transform(F.array_sort(F.collect_list(F.struct("__place", "__sentence"))), lambda s: s["__sentence"]).alias("text_references"))
    out = images.join(lists, [case, order], "left")
    return out.withColumn("text_references", F.coalesce("text_references", F.array().cast("array<string>")))


def highest_figure(numbers: Column) -> Column:
    """The highest number in an array of arrays of figure numbers; null if there is none."""
    return F.array_max(F.flatten(numbers))


def mention_rows(images: DataFrame, image: str, mentions: str) -> DataFrame:
    """image, image_component, mention of array<struct<mention, letters>>; a mention without letters is of the whole image."""
    opened = images.select(image, F.explode(mentions).alias("m")).select(image, "m.mention", "m.letters")
    letters = F.when(F.size("letters") > 0, F.col("letters")).otherwise(F.array(F.lit(UNDIVIDED)))
    return opened.select(image, F.explode(letters).alias("image_component"), "mention")


def join_figure_references(files: DataFrame, mentions: DataFrame, image: str, component: str = "image_component", name: str = "case_substring") -> DataFrame:
    """The files with the mentions of their component and of their whole image, distinct and sorted.

    Two left joins: on image and component, then on the image alone for mentions of the undivided one.
    """
    own = mentions.groupBy(image, component).agg(F.collect_set("mention").alias("__own"))
    whole = mentions.where(F.col(component) == UNDIVIDED).groupBy(image).agg(F.collect_set("mention").alias("__whole"))
    none = F.array().cast("array<string>")
    joined = files.join(own, [image, component], "left").join(whole, image, "left")
    return joined.withColumn(name, F.array_sort(F.array_union(F.coalesce("__own", none), F.coalesce("__whole", none)))).drop("__own", "__whole")


def clean_references(references: Column) -> Column:
    """References of a caption's parts without a lone comma and without those that hold a space."""
    return F.filter(references, lambda r: (r != ",") & ~r.contains(" "))


def downloaded(captions: DataFrame, inventory: DataFrame, file: str) -> DataFrame:
    """The captions whose file is in the inventory; each caption once, however often a file is listed."""
    return captions.join(inventory.select(file), file, "left_semi")


def join_license(captions: DataFrame, articles: DataFrame, case_key: str, article_key: str = "pmcid", name: str = "license") -> DataFrame:
    """Left join of the article's licence on the article key that a case key begins with; of several the first by name."""
    keyed = captions.withColumn(article_key, F.substring_index(case_key, "_", 1))
    return keyed.join(articles.groupBy(article_key).agg(F.min(name).alias(name)), article_key, "left")

"""A dataset built from articles in XML: content, cases and caption parts, each a stage that resumes where it was cut off."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.captions import segment_caption
from vellum.functions.text import extract_age, extract_figure_numbers, extract_gender, fix_caption
from vellum.sources.acquisition import parse_articles
from vellum.streaming.updates import run_stage


@dataclass(frozen=True)
class Built:
    """articles: one row an article, malformed ones with an error; cases: one a case; parts: one a part of a case's image."""

    articles: DataFrame
    cases: DataFrame
    parts: DataFrame


def case_structs(pmcid: Column, cases: Column) -> Column:
    """array<struct<case_id, gender, age, figures, case_text>> of an article's case texts, numbered from 01."""

    def one(text: Column, i: Column) -> Column:
        number = F.lpad((i + 1).cast("string"), 2, "0")
        return F.struct(F.concat(pmcid, F.lit("_"), number).alias("case_id"), extract_gender(text).alias("gender"), extract_age(text).alias("age"), text.alias("case_text"))

    return F.transform(cases, one)


def cases_of(content: DataFrame, key: str) -> DataFrame:
    """key, cases: array<struct<case_id, gender, age, case_text, figures>>; figures are the numbers that the text mentions."""
    rows = content.select(key, F.explode(case_structs(F.col("pmcid"), F.col("cases"))).alias("c")).select(key, "c.*")
    rows = rows.withColumn("figures", extract_figure_numbers(F.col("case_text")))
    own = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("case_id", "gender", "age", "case_text", "figures"))).alias("cases"))
    # An article without cases has a row as well: it is done.
    return content.select(key).join(own, key, "left").withColumn("cases", F.coalesce("cases", F.array().cast("array<struct<case_id: string, gender: string, age: int, case_text: string, figures: array<int>>>")))


def parts_of(content: DataFrame, key: str) -> DataFrame:
    """key, parts: array<struct<file, tag, caption_order, image_component, caption>> of the captions with a file, split by part."""
    opened = content.select(key, F.explode("captions").alias("c")).where(F.col("c.file").isNotNull() & F.col("c.caption").isNotNull())
    split = opened.select(key, "c.file", "c.tag", "c.caption_order", F.explode(segment_caption(F.col("c.caption"))).alias("p"))
    named = split.select(key, F.struct("caption_order", F.col("p.reference").alias("image_component"), "file", "tag", fix_caption(F.col("p.caption")).alias("caption")).alias("part"))
    own = named.groupBy(key).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return content.select(key).join(own, key, "left").withColumn("parts", F.coalesce("parts", F.array().cast("array<struct<caption_order: int, image_component: string, file: string, tag: string, caption: string>>")))


def build_dataset(spark: SparkSession, source: DataFrame, folder: str, key: str = "pmcid", xml: str = "xml", licenses: list[str] = ()) -> Built:
    """Read the articles of ``source`` (key, xml) that ``folder`` hasn't yet, stage by stage, and give the whole dataset.

    Stages publish whole parts under ``folder``: a run that breaks off leaves every stage's table readable as it was, and
    the next run does what is missing, in each stage from the table of the one before. Keys are distinct and not null.
    """
    base = folder.rstrip("/")
    content = run_stage(spark, source.select(F.col(key).alias("article"), F.col(xml).alias("xml")), f"{base}/content", "article", lambda new: parse_articles(new, "xml", "article", licenses))
    cases = run_stage(spark, content, f"{base}/cases", "article", lambda new: cases_of(new, "article"))
    parts = run_stage(spark, content, f"{base}/parts", "article", lambda new: parts_of(new, "article"))
    rows = cases.select("article", F.explode("cases").alias("c")).select("article", "c.*")
    return Built(content, rows, assign_parts(content, cases, parts))


def assign_parts(content: DataFrame, cases: DataFrame, parts: DataFrame) -> DataFrame:
    """article, case_id and the fields of each part that a case's text mentions by its figure's number.

    Where an article has fewer captions than the highest number that its cases mention, some are missing and places don't
    tell numbers: then the number in a caption's tag does, and a caption without one belongs to no case.
    """
    highest = cases.select("article", F.array_max(F.flatten(F.transform("cases", lambda c: c["figures"]))).alias("highest"), "cases")
    known = content.select("article", F.size("captions").alias("captions")).join(highest, "article").where("highest is not null")
    wanted = known.select("article", (F.col("captions") < F.col("highest")).alias("by_tag"), F.explode("cases").alias("c")).select("article", "by_tag", "c.case_id", F.explode(F.array_distinct("c.figures")).alias("number"))
    images = parts.select("article", F.explode("parts").alias("p")).select("article", "p.*")
    tagged = F.expr("try_cast(nullif(regexp_extract(tag, '[0-9]+', 0), '') as int)")
    numbered = images.select("*", F.explode(F.array(F.struct(F.lit(False).alias("by_tag"), F.col("caption_order").alias("number")), F.struct(F.lit(True).alias("by_tag"), tagged.alias("number")))).alias("n")).select("*", "n.*").drop("n")
    return wanted.join(numbered, ["article", "by_tag", "number"]).select("article", "case_id", "file", "tag", "caption_order", "image_component", "caption")

"""Cases and captions of an article's sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import AGED, OLD
from vellum.operators.sequences import rank_within


def case_paragraphs(sections: Column) -> Column:
    """Paragraphs that may hold cases, of array<struct<kind, title, text>>.

    Those of sections of kind CASE; else those under titles with the word case; else those
    that tell an age. A section without text is none. No sections: an empty list.
    """
    texts = lambda test: F.transform(F.filter(sections, lambda s: s["text"].isNotNull() & test(s)), lambda s: s["text"])
    levels = [
        texts(lambda s: F.upper(s["kind"]) == "CASE"),
        texts(lambda s: F.contains(F.lower(s["title"]), F.lit("case"))),
        texts(lambda s: s["text"].rlike(OLD) | s["text"].rlike(AGED)),
    ]
    return F.coalesce(*[F.when(F.size(c) > 0, c) for c in levels], F.array().cast("array<string>"))


#: How the beginning of another case is told, and the paragraphs of an article without case sections (in lower case and as they stand).
AGE_MENTION = r"[\s-](year|yr|month|day)s?(\s?-+|-?\s+)old"
PERSON_MENTION = r" (man|woman|male|female|gentleman|lady|boy|girl|child|baby|patient)( |,)"
AGED_PARAGRAPH = r"[\s-](year|yr|month|day)s?[\s-]old"


def merge_paragraphs(paragraphs: Column) -> Column:
    """Cases of a list of paragraphs: a mention of an age begins one; if no paragraph has any, one of a person does.

    Paragraphs before the first mention belong to no case. A case's paragraphs are joined by newlines.
    """

    def fold(ps: Column) -> Column:
        aged = lambda p: F.lower(p).rlike(AGE_MENTION)
        begins = lambda p: F.when(F.exists(ps, aged), aged(p)).otherwise(F.lower(p).rlike(PERSON_MENTION))
        # Where cases begin; each runs to the next beginning.
        marks = F.filter(F.transform(ps, lambda p, i: F.when(begins(p), i)), lambda i: i.isNotNull())
        return F.transform(marks, lambda at, k: F.array_join(F.slice(ps, at + 1, F.coalesce(F.get(marks, k + 1), F.size(ps)) - at), "\n"))

    return F.get(F.transform(F.array(F.filter(paragraphs, lambda p: p.isNotNull())), fold), 0)


def article_cases(sections: Column) -> Column:
    """Cases of an article's paragraphs, of array<struct<kind, title, title_number, text>>; null sections have none.

    Of kind CASE if there are such; else each run of paragraphs below a title with the word case is one; else
    those of the kind of the first paragraph that tells an age, unless that is an abstract. Then
    paragraphs are merged to cases. A paragraph without text decides nothing and is in no case.
    """
    none = F.array().cast("array<string>")

    def choose(s: Column) -> Column:
        texts = lambda test: F.transform(F.filter(s, test), lambda x: x["text"])
        marked = texts(lambda x: x["kind"] == "CASE")
        titled = F.filter(s, lambda x: F.contains(F.lower(x["title"]), F.lit("case")))
        runs = F.transform(F.array_distinct(F.transform(titled, lambda x: x["title_number"])), lambda n: F.array_join(F.transform(F.filter(titled, lambda x: x["title_number"] == n), lambda x: x["text"]), "\n"))
        kind = F.get(F.filter(s, lambda x: x["text"].rlike(AGED_PARAGRAPH) & (F.lower(x["kind"]) != "abstract")), 0)["kind"]
        own = texts(lambda x: x["kind"] == kind)
        # Runs are merged like paragraphs: one that begins with no mention goes on with the case before it.
        return F.when(F.size(marked) > 0, merge_paragraphs(marked)).when(F.size(runs) > 0, merge_paragraphs(runs)).when(kind.isNotNull(), merge_paragraphs(own)).otherwise(none)

    told = F.filter(F.coalesce(sections, F.array().cast("array<struct<kind: string, title: string, title_number: int, text: string>>")), lambda x: x["text"].isNotNull())
    return F.get(F.transform(F.array(told), choose), 0)


def one_caption_a_file(captions: Column) -> Column:
    """Captions of array<struct<tag, file, caption, caption_order>> with those of a file joined by '. ', renumbered in order; without a file each stays."""
    key = lambda c: F.coalesce(c["file"], F.concat(F.lit("\n"), c["caption_order"].cast("string")))

    def merge(all_: Column) -> Column:
        keys = F.array_distinct(F.transform(all_, key))

        def one(k: Column, i: Column) -> Column:
            own = F.filter(all_, lambda c: key(c) == k)
            text = F.array_join(F.transform(own, lambda c: c["caption"]), ". ")
            return F.struct(F.get(own, 0)["tag"].alias("tag"), F.get(own, 0)["file"].alias("file"), F.trim(text).alias("caption"), (i + 1).alias("caption_order"))

        return F.transform(keys, one)

    return F.get(F.transform(F.array(captions), merge), 0)


def is_noise(title: Column) -> Column:
    """Titles of reviews and studies that name no case; a null title is none of them."""
    t = F.lower(F.coalesce(title, F.lit("")))
    return (F.contains(t, F.lit("review")) | F.contains(t, F.lit("study"))) & ~F.contains(t, F.lit("case"))


def captions_with_cases(cases: Column, captions: Column) -> Column:
    """An article without cases has no captions."""
    return F.when(F.coalesce(F.size(cases), F.lit(0)) > 0, captions).otherwise(F.slice(captions, 1, 0))


def merge_captions(df: DataFrame, article: str, file: str, order: str, text: str, tag: str) -> DataFrame:
    """One row for each file of an article: texts in order joined by '. ', the first tag, the place renumbered from 1."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    merged = df.groupBy(article, file).agg(
        F.array_join(F.transform(parts, lambda p: p["t"]), ". ").alias(text),
        F.min_by(tag, F.struct(order, tag)).alias(tag),
        F.min(order).alias("__first"),
    )
    return rank_within(merged, article, ["__first", file], order).drop("__first")


def match_cases(cases: DataFrame, captions: DataFrame, article: str, numbers: str, order: str) -> DataFrame:
    """Captions of each case: those of its article whose number is among the figures that its text mentions."""
    return cases.withColumn(order, F.explode(F.array_distinct(numbers))).join(captions, [article, order])


def group_images(parts: DataFrame, article: str, image: str, columns: list[str]) -> DataFrame:
    """article, images: array<struct<image, parts array<struct<columns>>>>, sorted."""
    by_image = parts.groupBy(article, image).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("parts"))
    return by_image.groupBy(article).agg(F.array_sort(F.collect_list(F.struct(image, "parts"))).alias("images"))

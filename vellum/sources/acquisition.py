"""Planning of searches, and articles read from their XML and HTML: what acquisition does without a network."""

from __future__ import annotations

import calendar
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: Fixed value: as many results as one search returns at most.
SEARCH_LIMIT = 9_999


def plan_searches(first_year: int, last_year: int, count: Callable[[str], int], limit: int = SEARCH_LIMIT) -> tuple[list[str], list[str]]:
    """(date ranges to search, those of them that still return too many): years, opened to months, these to days.

    ``count`` tells how many results a range such as 2001, 2001/02 or 2001/02/28 has. A day can't be opened.
    """
    ranges, over = [], []
    for year in range(first_year, last_year + 1):
        if count(str(year)) < limit:
            ranges.append(str(year))
            continue
        for month in range(1, 13):
            at = f"{year}/{month:02d}"
            if count(at) < limit:
                ranges.append(at)
                continue
            days = [f"{at}/{day:02d}" for day in range(1, calendar.monthrange(year, month)[1] + 1)]
            ranges += days
            over += [d for d in days if count(d) > limit]
    return ranges, over


def resolve_version(version: str, known: list[str], refused: list[str] = ()) -> str:
    """``latest`` is the last of the known versions; versions of another format are refused."""
    if version in refused:
        raise ValueError(f"version {version!r} has another format")
    if version != "latest" and version not in known:
        raise ValueError(f"unknown version {version!r}; known are {', '.join(known)}")
    return known[-1] if version == "latest" else version


def unpack_archive(path: str, folder: str) -> list[str]:
    """Unpack a local archive and the archives inside it; the files' paths. Names that lead out of the folder are refused."""
    base, out, todo = Path(folder).resolve(), [], [(Path(path), Path(folder).resolve())]
    while todo:
        archive, target = todo.pop()
        with zipfile.ZipFile(archive) as z:
            for name in z.namelist():
                if not (target / name).resolve().is_relative_to(base):
                    raise ValueError(f"{archive} holds the name {name!r}")
            z.extractall(target)
            files = [target / n for n in z.namelist() if not n.endswith("/")]
        inner = [f for f in files if f.suffix == ".zip"]
        out += [str(f) for f in files if f.suffix != ".zip"]
        todo += [(f, f.parent) for f in inner]
    return sorted(out)


def map_ids(wanted: DataFrame, mapping: DataFrame, key: str = "pmid", needed: str = "pmcid") -> DataFrame:
    """Left join of the identifiers; ``comment`` says where none was found, and is null elsewhere."""
    out = wanted.select(key).distinct().join(mapping, key, "left")
    return out.withColumn("comment", F.when(F.col(needed).isNull(), F.lit("Mapping error.")))


#: What is read of BioC XML: everything else is skipped by the parser.
_BIOC = "document struct<id string, passage array<struct<infon: array<struct<_key: string, _VALUE: string>>, text: string>>>"
_SECTIONS = "array<struct<kind: string, title: string, title_number: int, text: string>>"


def article_xml(xml: Column) -> Column:
    """struct(pmcid, title, license, keywords, sections, captions, error) of an article in BioC XML, parsed once.

    sections: array<struct<kind, title, title_number, text>> of the paragraphs in order, with the last title before
    each and how many titles came until then; captions: array<struct<tag, file, caption, caption_order>> of the
    figure passages. A field that a passage lacks is null and shifts no other. What is malformed, or has no
    document, is a struct of nulls with an ``error``; null is all null.
    """
    # A transformed array of one gives the parsed document a name: it is parsed once however often its fields are used.
    parsed = F.array(F.from_xml(xml, _BIOC, {"ignoreSurroundingSpaces": "false"}))
    return F.get(F.transform(parsed, lambda a: _article(a["document"], xml.isNotNull())), 0)


def _article(document: Column, given: Column) -> Column:
    def infon(passage: Column, key: str) -> Column:
        return F.get(F.filter(passage["infon"], lambda i: i["_key"] == key), 0)["_VALUE"]

    keys = ["type", "section_type", "id", "file", "license", "kwd"]
    passages = F.transform(document["passage"], lambda p: F.struct(*[infon(p, k).alias(k) for k in keys], p["text"].alias("text")))

    def fields(found: Column) -> Column:
        first = lambda test, what: F.get(F.filter(found, test), 0)[what]
        start = F.struct(F.lit(None).cast("string").alias("title"), F.lit(0).alias("n"), F.array().cast(_SECTIONS).alias("out"))

        def step(acc: Column, p: Column) -> Column:
            paragraph = F.struct(p["section_type"].alias("kind"), acc["title"].alias("title"), acc["n"].alias("title_number"), p["text"].alias("text"))
            return (
                F.when(F.contains(F.lower(p["type"]), F.lit("title")), F.struct(p["text"].alias("title"), (acc["n"] + 1).alias("n"), acc["out"].alias("out")))
                .when(p["type"] == "paragraph", F.struct(acc["title"].alias("title"), acc["n"].alias("n"), F.concat(acc["out"], F.array(paragraph)).alias("out")))
                .otherwise(acc)
            )

        figures = F.filter(found, lambda p: F.contains(p["type"], F.lit("fig_")))
        return F.struct(
            F.concat(F.lit("PMC"), document["id"]).alias("pmcid"),
            first(lambda p: p["section_type"] == "TITLE", "text").alias("title"),
            first(lambda p: p["license"].isNotNull(), "license").alias("license"),
            F.split(first(lambda p: p["kwd"].isNotNull(), "kwd"), ", ").alias("keywords"),
            F.aggregate(found, start, step, lambda acc: acc["out"]).alias("sections"),
            F.transform(figures, lambda p, i: F.struct(p["id"].alias("tag"), p["file"].alias("file"), p["text"].alias("caption"), (i + 1).alias("caption_order"))).alias("captions"),
            F.when(given & document.isNull(), F.lit("malformed, or without a document")).alias("error"),
        )

    return F.get(F.transform(F.array(passages), fields), 0)


def parse_articles(df: DataFrame, xml: str, key: str, licenses: list[str] = ()) -> DataFrame:
    """key, pmcid, title, license, keywords, cases, case_amount, captions, error: articles read to their cases in one pass.

    Paragraphs are chosen and merged to cases (``article_cases``); reviews and studies whose title names no
    case have none, and an article without cases has no captions. Captions of one file are one. With
    ``licenses``, articles of another licence are left out; malformed ones stay as rows with an error.
    """
    from vellum.operators.articles import article_cases, captions_with_cases, is_noise, one_caption_a_file

    read = df.select(key, article_xml(F.col(xml)).alias("a")).select(key, "a.*")
    if licenses:
        read = read.where(F.col("license").isin(list(licenses)) | F.col("error").isNotNull())
    cases = F.when(is_noise(F.col("title")), F.array().cast("array<string>")).otherwise(article_cases(F.col("sections")))
    read = read.withColumn("cases", F.when(F.col("error").isNull(), cases))
    captions = captions_with_cases(F.col("cases"), one_caption_a_file(F.col("captions")))
    return read.select(key, "pmcid", "title", "license", "keywords", "cases", F.size("cases").alias("case_amount"), captions.alias("captions"), "error")


_LISTS = ["authors", "mesh_terms", "major_mesh_terms", "keywords"]
_CITATION = StructType([StructField(f, ArrayType(StringType()) if f in _LISTS else StringType()) for f in ["title", "authors", "journal", "journal_detail", "year", "mesh_terms", "major_mesh_terms", "keywords", "abstract", "link"]])


class _Page(HTMLParser):
    """Texts of the elements that an abstract's page is read for, by the element's name and classes, however they are nested."""

    #: Fixed values: (element, class) -> field.
    FIELDS = {("h1", "heading-title"): "title", ("a", "full-name"): "authors", ("button", "journal-actions-trigger"): "journal", ("span", "cit"): "journal_detail", ("button", "keyword-link"): "terms", ("div", "abstract-content"): "abstract", ("p", ""): "paragraphs", ("strong", "sub-title"): "subtitles"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: dict[str, list[tuple[str, bool]]] = {f: [] for f in self.FIELDS.values()}
        self.link: str | None = None
        #: Open captures: [element, how many of its name are open in it, field, marked, texts].
        self.open: list[list] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = dict(attrs)
        classes = (given.get("class") or "").split()
        if tag == "meta" and given.get("name") == "citation_abstract_html_url":
            self.link = self.link or given.get("content")
        for x in self.open:
            x[1] += x[0] == tag
        for (name, cls), field in self.FIELDS.items():
            if name == tag and (not cls or cls in classes) and (field != "abstract" or "selected" in classes):
                self.open.append([tag, 1, field, "major" in classes, []])

    def handle_endtag(self, tag: str) -> None:
        for x in self.open:
            x[1] -= x[0] == tag
        for x in [x for x in self.open if x[1] <= 0]:
            self.found[x[2]].append((" ".join("".join(x[4]).split()), x[3]))
        self.open = [x for x in self.open if x[1] > 0]

    def handle_data(self, data: str) -> None:
        for x in self.open:
            x[4].append(data)


def citation_page(html: str | None) -> dict:
    """The fields of one abstract's page; what is missing is null, or an empty list. Unclosed elements are left out."""
    page = _Page()
    page.feed(html or "")
    page.close()
    one = lambda field: next((t for t, _ in page.found[field] if t), None)
    terms = [(t.replace("*", "").strip(), major) for t, major in page.found["terms"]]
    major = [t for t, m in terms if m and t]
    words = next((t.partition("Keywords:")[2] for t, _ in page.found["paragraphs"] if t.startswith("Keywords:")), None) if any(t == "Keywords:" for t, _ in page.found["subtitles"]) else None
    return {
        "title": one("title"), "authors": list(dict.fromkeys(t for t, _ in page.found["authors"] if t)), "journal": one("journal"),
        "journal_detail": one("journal_detail"), "year": (one("journal_detail") or "")[:4] or None,
        "mesh_terms": major + [t for t, m in terms if not m and t], "major_mesh_terms": major,
        "keywords": [k.strip() for k in words.replace(".", "").lower().split(";")] if words is not None else None,
        "abstract": one("abstract"), "link": page.link,
    }


#: Characters of pages that are parsed at a time.
_PAGES = 1 << 20


@F.arrow_udf(_CITATION)
def citation_html(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """struct(title, authors, journal, journal_detail, year, mesh_terms, major_mesh_terms, keywords, abstract, link) of an abstract's page.

    A batch's pages are parsed a bounded number of characters at a time, a longer page alone, so a worker holds the
    parsed fields of few pages however large the batches are.
    """
    kind = to_arrow_type(_CITATION)
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.utf8_length(b), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(b):
            until = max(at + 1, int(np.searchsorted(ends, (int(ends[at - 1]) if at else 0) + _PAGES, side="right")))
            yield pa.array([citation_page(h) for h in b.slice(at, until - at).to_pylist()], kind)
            at = until


def join_content(metadata: DataFrame, content: DataFrame, key: str = "pmcid") -> DataFrame:
    """Metadata and content of each article; where the metadata's keywords are null or empty, those of the content."""
    right = content.select(key, *[F.col(c).alias(f"__{c}" if c in metadata.columns else c) for c in content.columns if c != key])
    joined = metadata.join(right, key)
    shared = [c for c in content.columns if c != key and c in metadata.columns]

    def filled(c: str) -> Column:
        own = F.when(F.size(c) > 0, F.col(c)) if dict(metadata.dtypes)[c].startswith("array") else F.col(c)
        return F.coalesce(own, F.col(f"__{c}"))

    return joined.select(*[filled(c).alias(c) if c in shared else F.col(c) for c in joined.columns if not c.startswith("__")])


#: Fixed value: the picture that stands for one that can't be read, one pixel by one.
_BLANK = ("RGB", (1, 1), (255, 255, 255))


def reencode(extension: str = "webp"):
    """A function of binary images: the same picture in another format, a blank pixel if it can't be read. Needs Pillow."""

    @F.pandas_udf("binary")
    def run(data: pd.Series) -> pd.Series:
        import io

        from PIL import Image

        def one(x: bytes | None) -> bytes:
            try:
                picture = Image.open(io.BytesIO(x)).convert("RGB")
            except Exception:  # whatever a broken file raises
                picture = Image.new(*_BLANK)
            out = io.BytesIO()
            picture.save(out, extension)
            return out.getvalue()

        return data.map(one)

    return run


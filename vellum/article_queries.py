"""Queries over articles in XML that are made of ``documents``: passages with missing fields and malformed rows, cases, captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.session import table
from vellum.sources import acquisition as Q


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _infon(key: str, value: Column) -> Column:
    """An infon element, nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f'<infon key="{key}">'), value, F.lit("</infon>")), F.lit(""))


def _text(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("<text>"), _escaped(value), F.lit("</text>")), F.lit(""))


def _passage(*parts: Column) -> Column:
    return F.concat(F.lit("<passage>"), *parts, F.lit("</passage>"))


def articles_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, xml: an article for each document, a passage for each of its lines.

    Every fourth line is a title; some paragraphs lack a section type or their text, some figures their
    file; of some articles the end is cut off.
    """
    k, lines = F.col("doc_id"), F.filter(F.split(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x00-\x09\x0b-\x1f]", " "), "\n"), lambda x: F.trim(x) != "")

    def passages(line: Column, i: Column) -> Column:
        title = i % 4 == 0
        kind = F.when((k + i) % 5 == 0, None).when((k % 3 == 0) & (i % 4).isin(1, 2), "CASE").when(i % 9 == 1, "ABSTRACT").otherwise("INTRO")
        text = F.when(title, F.concat(F.when((i % 8 == 0) & (k % 3 == 1), "The Case of ").otherwise(""), line)).when((k + i) % 13 == 0, None)
        text = text.otherwise(F.concat(F.when((k + i) % 7 == 0, "A 45-year-old one. ").when((k + i) % 11 == 0, "This woman, it is said. ").otherwise(""), line))
        one = _passage(_infon("type", F.when(title, "title_2").otherwise("paragraph")), _infon("section_type", kind), _text(text))
        file = F.when((k + i) % 4 != 0, F.concat(F.lit("f"), F.floor(i / 12).cast("string"), F.lit(".jpg")))
        figure = _passage(_infon("type", F.lit("fig_caption")), _infon("id", F.concat(F.lit("F"), i.cast("string"))), _infon("file", file), _text(F.concat(F.lit("Scan "), i.cast("string"))))
        return F.concat(one, F.when(i % 6 == 0, figure).otherwise(""))

    front = _passage(_infon("type", F.lit("front")), _infon("section_type", F.lit("TITLE")), _infon("license", F.col("lang")), _infon("kwd", F.when(k % 2 == 0, "a, b")), _text(F.concat(F.when(k % 10 == 0, "A Review of ").otherwise("On "), "lang")))
    xml = F.concat(F.lit("<collection><document><id>"), k.cast("string"), F.lit("</id>"), front, F.array_join(F.transform(lines, passages), ""), F.lit("</document></collection>"))
    cut = F.when(k % 17 == 3, F.expr("substring(xml, 1, length(xml) - 20)")).otherwise(F.col("xml"))
    return table(spark, sf, "documents").select("doc_id", "lang", xml.alias("xml")).select("doc_id", cut.alias("xml"))


_ARTICLES = r"""
  WITH d AS (SELECT doc_id AS k, lang, list_filter(string_split(regexp_replace(coalesce(text, ''), '[\x00-\x09\x0b-\x1f]', ' ', 'g'), chr(10)), lambda x: trim(x) <> '') AS ls FROM documents),
  a AS (SELECT k, lang, k % 17 = 3 AS bad, CASE WHEN k % 10 = 0 THEN 'A Review of ' ELSE 'On ' END || lang AS title FROM d),
  l AS (SELECT k, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
  t AS (SELECT k, i // 4 + 1 AS n, CASE WHEN i % 8 = 0 AND k % 3 = 1 THEN 'The Case of ' ELSE '' END || line AS title FROM l WHERE i % 4 = 0),
  p AS (SELECT k, i, n, title, CASE WHEN (k + i) % 5 = 0 THEN NULL WHEN k % 3 = 0 AND i % 4 IN (1, 2) THEN 'CASE' WHEN i % 9 = 1 THEN 'ABSTRACT' ELSE 'INTRO' END AS kind,
      CASE WHEN (k + i) % 13 = 0 THEN NULL ELSE CASE WHEN (k + i) % 7 = 0 THEN 'A 45-year-old one. ' WHEN (k + i) % 11 = 0 THEN 'This woman, it is said. ' ELSE '' END || line END AS text
    FROM l JOIN t USING (k) WHERE i % 4 <> 0 AND n = i // 4 + 1),
  f AS (SELECT k, i, CASE WHEN (k + i) % 4 <> 0 THEN 'f' || (i // 12) || '.jpg' END AS file, row_number() OVER (PARTITION BY k ORDER BY i) AS o FROM l WHERE i % 6 = 0)"""

ARTICLE_PASSAGES = _ARTICLES + """,
  s AS (SELECT k, count(*) AS n, string_agg(coalesce(kind, '-') || '|' || title || '|' || n || '|' || coalesce(text, '-'), chr(10) ORDER BY i) AS s FROM p GROUP BY 1),
  c AS (SELECT k, string_agg('F' || i || '|' || coalesce(file, '-') || '|Scan ' || i || '|' || o, ',' ORDER BY i) AS c FROM f GROUP BY 1)
  SELECT k AS doc_id, CASE WHEN NOT bad THEN 'PMC' || k END AS pmcid, CASE WHEN NOT bad THEN title END AS title, CASE WHEN NOT bad THEN lang END AS license,
    CASE WHEN NOT bad AND k % 2 = 0 THEN 'a/b' ELSE '' END AS keywords, CASE WHEN NOT bad THEN coalesce(n, 0) END AS n_sections,
    sha256(CASE WHEN NOT bad THEN coalesce(s, '') ELSE '' END) AS sections, CASE WHEN NOT bad THEN coalesce(c, '') ELSE '' END AS captions, bad AS malformed
  FROM a LEFT JOIN s USING (k) LEFT JOIN c USING (k)"""


def article_passages(spark: SparkSession, sf: str) -> DataFrame:
    a = articles_of_documents(spark, sf).select("doc_id", Q.article_xml(F.col("xml")).alias("a")).select("doc_id", "a.*")
    or_dash = lambda c: F.coalesce(c, F.lit("-"))
    sections = F.transform("sections", lambda s: F.concat_ws("|", or_dash(s["kind"]), s["title"], s["title_number"].cast("string"), or_dash(s["text"])))
    captions = F.transform("captions", lambda c: F.concat_ws("|", c["tag"], or_dash(c["file"]), c["caption"], c["caption_order"].cast("string")))
    joined = lambda c, by: F.coalesce(F.array_join(c, by), F.lit(""))
    return a.select("doc_id", "pmcid", "title", "license", joined(F.col("keywords"), "/").alias("keywords"), F.size("sections").cast("bigint").alias("n_sections"), F.sha2(joined(sections, "\n"), 256).alias("sections"), joined(captions, ",").alias("captions"), F.col("error").isNotNull().alias("malformed"))


_AGED, _PERSON = r"[\s-](year|yr|month|day)s?(\s?-+|-?\s+)old", " (man|woman|male|female|gentleman|lady|boy|girl|child|baby|patient)( |,)"
ARTICLE_CASES = (
    _ARTICLES
    + rf""",
  q AS (SELECT * FROM p WHERE text IS NOT NULL),
  r AS (SELECT k, min(i) AS i, string_agg(text, chr(10) ORDER BY i) AS text FROM q WHERE contains(lower(title), 'case') GROUP BY k, n),
  o AS (SELECT k, arg_min(kind, i) AS own FROM q WHERE regexp_matches(text, '[\s-](year|yr|month|day)s?[\s-]old') AND lower(kind) <> 'abstract' GROUP BY k),
  g AS (SELECT k, i, text, 1 AS level FROM q WHERE kind = 'CASE' UNION ALL SELECT k, i, text, 2 FROM r UNION ALL SELECT k, i, text, 3 FROM q JOIN o USING (k) WHERE kind = own),
  h AS (SELECT k, i, text FROM g JOIN (SELECT k, min(level) AS level FROM g GROUP BY 1) USING (k, level)),
  m AS (SELECT *, CASE WHEN bool_or(regexp_matches(lower(text), '{_AGED}')) OVER (PARTITION BY k) THEN regexp_matches(lower(text), '{_AGED}') ELSE regexp_matches(lower(text), '{_PERSON}') END AS b FROM h),
  w AS (SELECT k, i, text, sum(CASE WHEN b THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY i ROWS UNBOUNDED PRECEDING) AS c FROM m),
  x AS (SELECT k, c, string_agg(text, chr(10) ORDER BY i) AS t FROM w WHERE c > 0 GROUP BY 1, 2),
  y AS (SELECT k, count(*) AS n, string_agg(t, '#' ORDER BY c) AS t FROM x JOIN a USING (k) WHERE NOT (contains(lower(title), 'review') AND NOT contains(lower(title), 'case')) AND NOT bad GROUP BY 1),
  e AS (SELECT k, coalesce(file, 'F' || i) AS file, min(o) AS o, min(i) AS i, string_agg('Scan ' || i, '. ' ORDER BY i) AS c FROM f GROUP BY 1, 2),
  u AS (SELECT k, string_agg('F' || i || '|' || c || '|' || rn, ',' ORDER BY rn) AS captions FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o) AS rn FROM e) GROUP BY 1)
  SELECT k AS doc_id, CASE WHEN NOT bad THEN coalesce(n, 0) END AS case_amount, sha256(coalesce(t, '')) AS cases, CASE WHEN n > 0 THEN coalesce(captions, '') ELSE '' END AS captions FROM a LEFT JOIN y USING (k) LEFT JOIN u USING (k)"""
)


def article_cases(spark: SparkSession, sf: str) -> DataFrame:
    a = Q.parse_articles(articles_of_documents(spark, sf), "xml", "doc_id")
    captions = F.transform("captions", lambda c: F.concat_ws("|", c["tag"], c["caption"], c["caption_order"].cast("string")))
    joined = lambda c, by: F.coalesce(F.array_join(c, by), F.lit(""))
    return a.select("doc_id", F.col("case_amount").cast("bigint").alias("case_amount"), F.sha2(joined(F.col("cases"), "#"), 256).alias("cases"), joined(captions, ",").alias("captions"))

"""Queries of single columns and small joins over the test tables: texts, labels, nested tables, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions import predicates as P
from vellum.functions import text as T
from vellum.operators import figures as G
from vellum.operators import taxonomy as X
from vellum.session import table
from vellum.sources import acquisition as Q
from vellum.sources import projections as J
from vellum.sources import readers as D
from vellum.storage import materialize

NORMALIZED_LABELS = "SELECT p_partkey FROM part WHERE list_has_any(string_split(lower(p_type), ' '), ['tin', 'small'])"


def normalized_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Normalized extractions, which are in lower case, against labels in any case."""
    return table(spark, sf, "part").where(P.has_labels(F.split(F.lower("p_type"), " "), ["Tin", "sMall"], "any", True)).select("p_partkey")


FIGURE_NUMBER_LISTS = """SELECT doc_id, array_to_string(list_distinct_ordered, ',') AS numbers FROM (
    SELECT doc_id, list_filter(l, lambda x, i: x < 16 AND list_position(l, x) = i) AS list_distinct_ordered
    FROM (SELECT doc_id, list_concat([1 + doc_id % 4, 3 + doc_id % 5], range(2 + doc_id % 3, 6 + doc_id % 14), CASE WHEN doc_id % 2 = 0 THEN [9] ELSE [] END) AS l FROM documents))"""


def figure_number_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers that whole texts mention: lists, ranges, ages that are none, a mention in another sentence."""
    k, s = F.col("doc_id"), lambda c: c.cast("string")
    told = F.concat(F.lit(" As shown in Fig. "), s(1 + k % 4), F.lit(" and "), s(3 + k % 5), F.lit(". Of a 45-year-old. See figs. "), s(2 + k % 3), F.lit("-"), s(5 + k % 14), F.lit(" at 12 years. "), F.when(k % 2 == 0, "Figure 9 shows it.").otherwise("No 9 at all."))
    return table(spark, sf, "documents").select("doc_id", F.array_join(T.extract_figure_numbers(F.concat(F.coalesce("text", F.lit("")), told)), ",").alias("numbers"))


HIGHEST_FIGURES = "SELECT l_orderkey, max(CASE WHEN l_linenumber % 3 <> 0 THEN greatest(l_linenumber, CAST(l_quantity AS INTEGER) % 12) END) AS highest FROM lineitem GROUP BY 1"


def highest_figures(spark: SparkSession, sf: str) -> DataFrame:
    numbers = F.when(F.col("l_linenumber") % 3 != 0, F.array("l_linenumber", (F.col("l_quantity").cast("int") % 12).cast("int"))).otherwise(F.array().cast("array<int>"))
    nested = table(spark, sf, "lineitem").select("l_orderkey", numbers.alias("n")).groupBy("l_orderkey").agg(F.collect_list("n").alias("numbers"))
    return nested.select("l_orderkey", G.highest_figure(F.col("numbers")).alias("highest"))


COMPATIBLE_MENTIONS = """WITH m AS (SELECT doc_id, ['Fig. ' || (doc_id % 3) || ' and ' || (doc_id % 5), 'Fig. ' || (doc_id % 2), 'Figs. ' || (doc_id % 2) || ', ' || (doc_id % 7)] AS m FROM documents)
  SELECT doc_id, CASE WHEN list_contains([doc_id % 3, doc_id % 5], doc_id % 2) OR (doc_id % 2 IN (doc_id % 3, doc_id % 5)) THEN array_to_string(m, '|') ELSE '' END AS mentions FROM m"""


def compatible_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Mentions of one image stay where some number of the first is in all others."""
    s = lambda n: (F.col("doc_id") % n).cast("string")
    mentions = F.array(F.concat(F.lit("Fig. "), s(3), F.lit(" and "), s(5)), F.concat(F.lit("Fig. "), s(2)), F.concat(F.lit("Figs. "), s(2), F.lit(", "), s(7)))
    return table(spark, sf, "documents").select("doc_id", mentions.alias("m")).select("doc_id", F.array_join(T.compatible_mentions(F.col("m")), "|").alias("mentions"))


SPACES_OF_PAGES = r"SELECT page_id, sha256(trim(regexp_replace(html, '\s+', ' ', 'g'))) AS text FROM pages"


def spaces_of_pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.sha2(T.clean_spaces(F.col("html")), 256).alias("text"))


FIXED_CAPTIONS = r"""WITH c AS (SELECT item_id, CASE item_id % 4 WHEN 0 THEN ' and (' || text || ' or ' WHEN 1 THEN '; ' || text || ' ,' WHEN 2 THEN left(text, 3) ELSE '' END AS c FROM benchmark),
  t AS (SELECT item_id, regexp_replace(regexp_replace(regexp_replace(c, '^[^\pL\pN(]+|[^\pL\pN)]+$', '', 'g'), '(?i)^(?:and|or)\s+|\s+(?:and|or)$', '', 'g'), '^[^\pL\pN(]+|[^\pL\pN)]+$', '', 'g') AS t FROM c),
  f AS (SELECT item_id, upper(t[1]) || t[2:] || '.' AS f FROM t)
  SELECT item_id, CASE WHEN len(f) > 5 THEN f ELSE 'Medical image.' END AS caption FROM f"""


def fixed_captions(spark: SparkSession, sf: str) -> DataFrame:
    k, t = F.col("item_id") % 4, F.col("text")
    odd = F.when(k == 0, F.concat(F.lit(" and ("), t, F.lit(" or "))).when(k == 1, F.concat(F.lit("; "), t, F.lit(" ,"))).when(k == 2, F.substring(t, 1, 3)).otherwise("")
    return table(spark, sf, "benchmark").select("item_id", T.fix_caption(odd).alias("caption"))


CONTENT_OF_ARTICLES = """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'own' ELSE 'content' END AS keywords, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'other' END AS license FROM customer WHERE c_custkey % 5 <> 0"""


def content_of_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata and content joined: keywords and licences from the content where the metadata has none."""
    k = F.col("c_custkey")
    c = table(spark, sf, "customer")
    metadata = c.select("c_custkey", F.when(k % 3 == 0, F.array(F.lit("own"))).when(k % 3 == 1, F.array().cast("array<string>")).alias("keywords"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("license"))
    content = c.where(k % 5 != 0).select("c_custkey", F.array(F.lit("content")).alias("keywords"), F.lit("other").alias("license"))
    return Q.join_content(metadata, content, "c_custkey").select("c_custkey", F.array_join("keywords", ",").alias("keywords"), "license")


NESTED_CASES = "SELECT 'P' || o_custkey || '_' || o_orderkey AS case_id, o_orderpriority AS case_text, 'P' || o_custkey AS pmcid FROM orders"


def nested_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with nested cases, split into tables, written and read back as rows."""
    key = F.concat(F.lit("P"), F.col("o_custkey").cast("string"))
    cases = table(spark, sf, "orders").select(key.alias("pmcid"), F.struct(F.concat(key, F.lit("_"), F.col("o_orderkey").cast("string")).alias("case_id"), F.col("o_orderpriority").alias("case_text")).alias("c"))
    nested = cases.groupBy("pmcid").agg(F.collect_list("c").alias("cases")).withColumn("title", F.lit("T"))
    _, path = materialize(J.vertical_split(nested)["cases"], "nested-cases")
    return D.read_cases(spark, path).select("case_id", "case_text", F.col("pmcid").alias("pmcid"))


LAST_OF_GROUPS = """WITH b AS (SELECT p_partkey, string_split(p_type, ' ') AS l FROM part),
  g AS (SELECT p_partkey, list_filter(l, lambda x: x IN ('TIN', 'BRASS', 'COPPER')) AS a, list_filter(l, lambda x: x IN ('SMALL', 'LARGE')) AS c FROM b)
  SELECT p_partkey, coalesce(a[-1], '') AS metal, coalesce(c[-1], '') AS size FROM g"""


def last_of_groups(spark: SparkSession, sf: str) -> DataFrame:
    """One column a group of classes."""
    groups = {"metal": ["TIN", "BRASS", "COPPER"], "size": ["SMALL", "LARGE"]}
    return table(spark, sf, "part").select("p_partkey", *X.multiclass_columns(F.split("p_type", " "), groups))


LARGEST_PLACES = """SELECT vec_id, ['first', 'second', 'third', 'fourth'][list_position(embedding[1:4], list_max(embedding[1:4]))] AS label
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding[1:4], lambda x: x IS NOT NULL AND isfinite(x))) = 4"""


def largest_places(spark: SparkSession, sf: str) -> DataFrame:
    """The name of the largest of a vector's first four numbers."""
    first = F.slice("embedding", 1, 4)
    sound = F.size(F.filter(first, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))) == 4
    return table(spark, sf, "embeddings").where(F.col("embedding").isNotNull() & sound).select("vec_id", X.argmax_label(first, ["first", "second", "third", "fourth"]).alias("label"))


CITATION_PAGES = """SELECT doc_id, 'Title ' || doc_id || ' of ' || lang AS title, 'A. ' || lang || '/B. ' || source AS authors, CASE WHEN doc_id % 3 <> 0 THEN 'J ' || source END AS journal, '20' || (10 + doc_id % 10) AS year,
  'Major' || (doc_id % 7) || '/Minor' AS mesh_terms, 'Major' || (doc_id % 7) AS major, CASE WHEN doc_id % 4 = 0 THEN 'one/' || lang END AS keywords,
  nullif(trim(regexp_replace(regexp_replace(coalesce(text, ''), '[\\x00-\\x1f]', ' ', 'g') || CASE WHEN doc_id % 2 = 0 THEN ' inner' ELSE '' END, '\\s+', ' ', 'g')), '') AS abstract, 'http://x/' || doc_id AS link FROM documents"""


def citation_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of abstracts made of the documents, with nested elements and fields that are missing, read by the page parser."""
    k, s = F.col("doc_id"), F.col("doc_id").cast("string")
    escape = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    text = escape(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x00-\x1f]", " "))
    html = F.concat(
        F.lit('<html><meta content="http://x/'), s, F.lit('" name="citation_abstract_html_url"><h1 class="heading-title">Title <b>'), s, F.lit("</b> of "), F.col("lang"),
        F.lit('</h1><a class="full-name">A. '), F.col("lang"), F.lit('</a><a href="#" class="x full-name">B. '), F.col("source"), F.lit('</a><a class="full-name">A. '), F.col("lang"), F.lit("</a>"),
        F.when(k % 3 != 0, F.concat(F.lit('<button class="journal-actions-trigger">J '), F.col("source"), F.lit("</button>"))).otherwise(""),
        F.lit('<span class="cit">20'), (10 + k % 10).cast("string"), F.lit(' Jan;1(2)</span><button class="keyword-link">Minor</button><button class="keyword-link major">Major'), (k % 7).cast("string"), F.lit("*</button>"),
        F.lit('<div id="abstract" class="abstract-content selected"><p>'), text, F.lit("</p>"), F.when(k % 2 == 0, "<div> inner</div>").otherwise(""), F.lit("</div>"),
        F.when(k % 4 == 0, F.concat(F.lit('<p><strong class="sub-title">Keywords:</strong> One; '), F.col("lang"), F.lit(".</p>"))).otherwise(""), F.lit("</html>"),
    )
    m = table(spark, sf, "documents").select("doc_id", Q.citation_html(html).alias("m")).select("doc_id", "m.*")
    joined = lambda c: F.array_join(c, "/")
    return m.select("doc_id", "title", joined("authors").alias("authors"), "journal", "year", joined("mesh_terms").alias("mesh_terms"), joined("major_mesh_terms").alias("major"), joined("keywords").alias("keywords"), "abstract", "link")


QUERIES = {f.__name__: f for f in (normalized_labels, figure_number_lists, highest_figures, compatible_mentions, spaces_of_pages, fixed_captions, content_of_articles, nested_cases, last_of_groups, largest_places, citation_pages)}
ORACLE_SQL = {
    "normalized_labels": NORMALIZED_LABELS, "figure_number_lists": FIGURE_NUMBER_LISTS, "highest_figures": HIGHEST_FIGURES, "compatible_mentions": COMPATIBLE_MENTIONS,
    "spaces_of_pages": SPACES_OF_PAGES, "fixed_captions": FIXED_CAPTIONS, "content_of_articles": CONTENT_OF_ARTICLES, "nested_cases": NESTED_CASES,
    "last_of_groups": LAST_OF_GROUPS, "largest_places": LARGEST_PLACES, "citation_pages": CITATION_PAGES,
}

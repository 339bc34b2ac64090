"""Registered queries of the reference's operators over the test tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from vellum import column_queries
from vellum.article_queries import ARTICLE_CASES, ARTICLE_PASSAGES, article_cases, article_passages
from vellum.functions import captions as C
from vellum.functions import ids, predicates as P, text as T
from vellum.operators import aggregates as A
from vellum.operators import articles as R
from vellum.operators import figures as G
from vellum.operators import folds as O
from vellum.operators import harmonize as H
from vellum.operators import inference as M
from vellum.operators import labels as L
from vellum.operators import ngrams as N
from vellum.operators import pixels as I
from vellum.operators import sequences as S
from vellum.operators import taxonomy as X
from vellum.plans.query import DatasetBuilder, Field
from vellum.session import table
from vellum.sources import acquisition as Q
from vellum.sources import exports as E
from vellum.sources import projections as J

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


FIELDS = {
    "segment": Field("article", "member_ci", "c_mktsegment"),
    "min_balance": Field("article", "min", "c_acctbal"),
    "min_year": Field("case", "min", "year"),
    "max_year": Field("case", "max", "year"),
    "priority": Field("case", "patterns", "o_orderpriority"),
    "flag": Field("image", "member", "l_returnflag"),
    "label": Field("image", "labels", "labels"),
}
FILTERS = [{"field": "segment", "string_list": ["building", "machinery"]}, {"field": "min_year", "string_list": ["1995"]}, {"field": "priority", "string_list": ["urgent", "high"], "operator": "any"}, {"field": "flag", "string_list": ["R"]}]


def levels(spark: SparkSession, sf: str) -> DatasetBuilder:
    """Customers as articles, orders as cases, line items as images."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority", "o_totalprice", F.year("o_orderdate").alias("year"))
    # An image's article stands in its case: the line items carry no customer.
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag", "l_linestatus", F.array("l_returnflag", "l_linestatus").alias("labels"))
    items = items.join(orders.select("o_orderkey", "c_custkey"), "o_orderkey")
    return DatasetBuilder(table(spark, sf, "customer"), orders, items, "c_custkey", "o_orderkey", FIELDS)


_LEVELS = """
  WITH art AS (SELECT * FROM customer WHERE lower(c_mktsegment) IN ('building', 'machinery')),
  cas AS (SELECT *, o_custkey AS c_custkey FROM orders WHERE year(o_orderdate) >= 1995 AND regexp_matches(lower(o_orderpriority), 'urgent|high')),
  img AS (SELECT l.*, o.o_custkey AS c_custkey FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')"""
_STRICT = """, pm AS (SELECT c_custkey FROM art WHERE c_custkey IN (SELECT c_custkey FROM cas) AND c_custkey IN (SELECT c_custkey FROM img)),
  gc AS (SELECT * FROM cas WHERE c_custkey IN (SELECT c_custkey FROM pm) AND o_orderkey IN (SELECT l_orderkey FROM img))"""
_LOOSE = """, pm AS (SELECT c_custkey FROM art WHERE c_custkey IN (SELECT c_custkey FROM cas)),
  gc AS (SELECT * FROM cas WHERE c_custkey IN (SELECT c_custkey FROM pm))"""


@query(_LEVELS + _STRICT + " SELECT c_custkey, o_orderkey, o_totalprice FROM gc")
def harmonize_text(spark, sf):
    return levels(spark, sf).query(FILTERS, "text").cases.select("c_custkey", "o_orderkey", "o_totalprice")


@query(_LEVELS + _LOOSE + " SELECT c_custkey, o_orderkey, o_totalprice FROM gc")
def harmonize_multimodal(spark, sf):
    return levels(spark, sf).query(FILTERS, "multimodal").cases.select("c_custkey", "o_orderkey", "o_totalprice")


@query(_LEVELS + _LOOSE + " SELECT l_orderkey AS o_orderkey, l_linenumber FROM img WHERE c_custkey IN (SELECT c_custkey FROM pm) AND l_orderkey IN (SELECT o_orderkey FROM gc)")
def harmonize_images(spark, sf):
    return levels(spark, sf).query(FILTERS, "image").images.select("o_orderkey", "l_linenumber")


@query(_LEVELS + _LOOSE + " SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey IN (SELECT c_custkey FROM pm)")
def citation_projection(spark, sf):
    return levels(spark, sf).query(FILTERS, "multimodal").articles.select("c_custkey", "c_name", "c_mktsegment")


@query(_LEVELS + _STRICT + ", n AS (SELECT l_orderkey, count(*) AS k FROM img WHERE c_custkey IN (SELECT c_custkey FROM pm) GROUP BY 1) SELECT o_orderkey, k AS amount_of_images FROM gc JOIN n ON l_orderkey = o_orderkey")
def case_series_counts(spark, sf):
    out = levels(spark, sf).query(FILTERS, "case_series")
    return H.with_image_counts(out.cases, out.images, "o_orderkey").select("o_orderkey", "amount_of_images")


@query("SELECT p_partkey FROM part WHERE p_size >= 10 AND p_size <= 30")
def range_min_max(spark, sf):
    return table(spark, sf, "part").where(P.at_least(F.col("p_size"), ["10", "12"]) & P.at_most(F.col("p_size"), ["20", "30"])).select("p_partkey")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'machinery')")
def isin_exact(spark, sf):
    return table(spark, sf, "customer").where(P.member(F.col("c_mktsegment"), ["BUILDING", "machinery"])).select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE lower(c_mktsegment) IN ('building', 'machinery')")
def isin_ci(spark, sf):
    return table(spark, sf, "customer").where(P.member(F.col("c_mktsegment"), ["Building", "machinery"], True)).select("c_custkey")


def _texts(name: str, test, sql: str) -> None:
    QUERIES[name] = lambda spark, sf: table(spark, sf, "documents").where(test(F.col("text"))).select("doc_id")
    ORACLE_SQL[name] = f"SELECT doc_id FROM documents WHERE {sql}"


_texts("substr_all", lambda c: P.has_substrings(c, [" The ", "and"]), "contains(lower(text), ' the ') AND contains(lower(text), 'and')")
_texts("substr_any", lambda c: P.has_substrings(c, [" die ", " les "], "any"), "contains(lower(text), ' die ') OR contains(lower(text), ' les ')")
_texts("substr_none", lambda c: P.has_substrings(c, [" the ", " que "], "none"), "NOT (contains(lower(text), ' the ') OR contains(lower(text), ' que '))")
_texts("regex_all", lambda c: P.has_patterns(c, ["th.n", r"\band\b"]), r"regexp_matches(text, '(?i)th.n') AND regexp_matches(text, '(?i)\band\b')")
_texts("regex_any", lambda c: P.has_patterns(c, ["ing[.]", "ung[.]"], "any"), "regexp_matches(text, '(?i)ing[.]|ung[.]')")
_texts("regex_none", lambda c: P.has_patterns(c, ["ing[.]", "ung[.]"], "none"), "NOT regexp_matches(text, '(?i)ing[.]|ung[.]')")
_texts("regex_case", lambda c: P.has_patterns(c, ["The ", "Die "], "any", matching_case=True), "regexp_matches(text, 'The |Die ')")

_TERMS = "string_split(lower(p_type || ' ' || p_name), ' ')"


def _terms(name: str, operator: str, match_type: str, sql: str) -> None:
    QUERIES[name] = lambda spark, sf: table(spark, sf, "part").where(P.has_terms(F.split(F.concat_ws(" ", "p_type", "p_name"), " "), NEEDLES[match_type], operator, match_type)).select("p_partkey")
    ORACLE_SQL[name] = f"SELECT p_partkey FROM part WHERE {sql}"


NEEDLES = {"full_match": ["Small", "ring"], "partial_match": ["STA", "in"]}
_FULL = ["list_contains(%s, 'small')" % _TERMS, "list_contains(%s, 'ring')" % _TERMS]
_PART = ["len(list_filter(%s, lambda t: contains(t, '%s'))) > 0" % (_TERMS, n) for n in ("sta", "in")]
for _m, _tests in (("full", _FULL), ("partial", _PART)):
    _terms(f"array_{_m}_all", "all", f"{_m}_match", " AND ".join(_tests))
    _terms(f"array_{_m}_any", "any", f"{_m}_match", " OR ".join(_tests))
    _terms(f"array_{_m}_none", "none", f"{_m}_match", "NOT (" + " OR ".join(_tests) + ")")

_BAGS = "SELECT d.doc_id, list_concat([lang], CASE WHEN quality = 1 THEN ['good'] ELSE [] END) AS gt, CASE WHEN toxic = 1 THEN ['toxic', lang] ELSE ['clean'] END AS ml FROM documents d JOIN labels l USING (doc_id)"


def bags(spark, sf):
    """Two label lists for each labelled document."""
    d = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id")
    none = F.array().cast("array<string>")
    gt = F.concat(F.array("lang"), F.when(F.col("quality") == 1, F.array(F.lit("good"))).otherwise(none))
    ml = F.when(F.col("toxic") == 1, F.array(F.lit("toxic"), F.col("lang"))).otherwise(F.array(F.lit("clean")))
    return d.select("doc_id", gt.alias("gt"), ml.alias("ml"))


def _labels(name: str, wanted: list[str], operator: str, sql: str, both: bool = False) -> None:
    QUERIES[name] = lambda spark, sf: bags(spark, sf).where(P.has_labels(P.both_labels(F.col("gt"), F.col("ml")) if both else F.col("gt"), wanted, operator)).select("doc_id")
    ORACLE_SQL[name] = f"WITH b AS ({_BAGS}) SELECT doc_id FROM b WHERE {sql}"


_labels("label_all", ["en", "good"], "all", "list_has_all(gt, ['en', 'good'])")
_labels("label_any", ["fr", "good"], "any", "list_has_any(gt, ['fr', 'good'])")
_labels("label_none", ["fr", "good"], "none", "NOT list_has_any(gt, ['fr', 'good'])")
_labels("label_both_columns", ["good", "clean"], "all", "list_has_all(list_concat(gt, ml), ['good', 'clean'])", True)


def _constraint(name: str, column, sql: str) -> None:
    QUERIES[name] = lambda spark, sf: bags(spark, sf).select("doc_id", F.array_join(column(F.concat("gt", "ml")), ",").alias("labels"))
    ORACLE_SQL[name] = f"WITH b AS (SELECT doc_id, list_concat(gt, ml) AS x FROM ({_BAGS})) SELECT doc_id, array_to_string({sql}, ',') AS labels FROM b"


_constraint("label_remove", lambda c: L.remove_label(c, "clean"), "list_filter(x, lambda e: e <> 'clean')")
_constraint("label_incompat", lambda c: L.remove_incompatibilities(c, ["good"], ["toxic", "fr"]), "CASE WHEN list_has_any(x, ['good']) AND list_has_any(x, ['toxic', 'fr']) THEN list_filter(x, lambda e: e NOT IN ('good', 'toxic', 'fr')) ELSE x END")
_constraint("label_require", lambda c: L.check_requirements(c, ["clean", "en"], ["good"]), "CASE WHEN list_has_any(x, ['good']) THEN x ELSE list_filter(x, lambda e: e NOT IN ('clean', 'en')) END")
_constraint("compound_add", lambda c: L.add_compounds(c, {"good_en": ["good", "en"], "bad_fr": ["toxic", "fr"]}), "list_concat(x, CASE WHEN list_has_all(x, ['good', 'en']) THEN ['good_en'] ELSE [] END, CASE WHEN list_has_all(x, ['toxic', 'fr']) THEN ['bad_fr'] ELSE [] END)")
_constraint("label_replace", lambda c: L.replace_labels(c, {"clean": "ok", "en": "english"}), "list_transform(x, lambda e: CASE e WHEN 'clean' THEN 'ok' WHEN 'en' THEN 'english' ELSE e END)")
_constraint("first_match_column", lambda c: F.array(L.first_match(c, ["en", "fr", "toxic"])), "[coalesce(list_filter(x, lambda e: e IN ('en', 'fr', 'toxic'))[-1], '')]")


@query(f"WITH b AS ({_BAGS}) SELECT doc_id, array_to_string(CASE WHEN len(list_intersect(list_distinct(list_concat(gt, ml)), ['good', 'toxic'])) > 1 THEN [] ELSE gt END, ',') AS labels FROM b")
def exclusive_group_filter(spark, sf):
    return bags(spark, sf).select("doc_id", F.array_join(L.exclusive_groups(F.col("gt"), F.col("ml"), [["good", "toxic"]]), ",").alias("labels"))


@query("SELECT event_id, user_id, event_type FROM events WHERE user_id % 2 = 0 UNION ALL SELECT event_id, user_id, event_type FROM events WHERE user_id % 3 = 0 AND user_id % 2 <> 0")
def antijoin_update(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return H.merge_update(e.where("user_id % 2 = 0"), e.where("user_id % 3 = 0"), "event_id")


@query("SELECT 'size' AS field, CAST(p_size AS VARCHAR) AS value FROM part GROUP BY ALL UNION ALL SELECT 'brand', p_brand FROM part GROUP BY ALL UNION ALL SELECT 'term', t FROM (SELECT unnest(string_split(p_type, ' ')) AS t FROM part) GROUP BY ALL")
def domain_lists(spark, sf):
    part = table(spark, sf, "part").withColumn("terms", F.split("p_type", " "))
    named = lambda c, n: A.distinct_values(part, c).select(F.lit(n).alias("field"), F.col("value").cast("string"))
    return named("p_size", "size").unionByName(named("p_brand", "brand")).unionByName(named("terms", "term"))


@query("WITH u AS (SELECT doc_id, 'long' AS class FROM documents WHERE n_chars > 2000 UNION ALL SELECT doc_id, 'english' FROM documents WHERE lang = 'en') SELECT doc_id, class FROM u WHERE doc_id IN (SELECT doc_id FROM u GROUP BY 1 HAVING count(*) = 1)")
def class_union_exclusive(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return H.class_subsets({"long": d.where("n_chars > 2000"), "english": d.where("lang = 'en'")}, "doc_id").select("doc_id", "class")


def _ngram_sql(n: int, minimum: int, stop: str) -> str:
    return rf"""
      WITH seg AS (SELECT trim(s, ' ' || chr(10) || chr(13) || chr(9)) AS s FROM (SELECT unnest(regexp_split_to_array(text, '[!(),.:;?\[\]{{}}]')) AS s FROM (SELECT DISTINCT text FROM benchmark))),
      c AS (SELECT s, count(*) AS k FROM seg WHERE s <> '' GROUP BY 1),
      w AS (SELECT list_filter(regexp_split_to_array(s, '[ \n]'), lambda t: t <> '') AS w, k FROM c),
      i AS (SELECT w, k, unnest(range(1, len(w) + 1)) AS i FROM w),
      g AS (SELECT w, k, i, unnest(range(1, least({n}, len(w) - i + 1) + 1)) AS n FROM i),
      o AS (SELECT array_to_string(w[i:i + n - 1], ' ') AS ngram, CAST(n AS INTEGER) AS n, k FROM g WHERE w[i] NOT IN ({stop}) AND w[i + n - 1] NOT IN ({stop}))
      SELECT ngram, n, CAST(sum(k) AS BIGINT) AS count FROM o GROUP BY 1, 2 HAVING sum(k) > {minimum}"""


@query(_ngram_sql(4, 2, "''"))
def ngram_counts(spark, sf):
    return N.ngram_counts(table(spark, sf, "benchmark"), "text", 4, 2)


@query(_ngram_sql(3, 1, "'the', 'The', 'THE', 'of', 'Of', 'OF'"))
def ngram_stopword(spark, sf):
    return N.ngram_counts(table(spark, sf, "benchmark"), "text", 3, 1, ["the", "of"])


DICTIONARY = {"the": ["article"], "of the": ["preposition", "article"], "in the": ["preposition"], "and": ["conjunction"], "and the": ["conjunction", "article"], "is": ["verb"]}


@query(r"""
  WITH t AS (SELECT item_id, regexp_replace(' ' || regexp_replace(lower(text), '\s+', '  ', 'g') || ' ', '([!(),.:;?\[\]{}])', ' \1 ', 'g') AS x FROM benchmark),
  m AS (SELECT item_id, regexp_extract_all(x, ' (of  the|in  the|and  the|the|and|is) ', 1) AS m FROM t),
  l AS (SELECT item_id, flatten(list_transform(m, lambda k: CASE replace(k, '  ', ' ') WHEN 'the' THEN ['article'] WHEN 'of the' THEN ['preposition', 'article'] WHEN 'in the' THEN ['preposition'] WHEN 'and' THEN ['conjunction'] WHEN 'and the' THEN ['conjunction', 'article'] ELSE ['verb'] END)) AS l FROM m)
  SELECT item_id, array_to_string(list_sort(list_distinct(l)), ',') AS labels FROM l""")
def dict_label_longest(spark, sf):
    d = spark.createDataFrame(list(DICTIONARY.items()), "ngram string, labels array<string>")
    return L.label_texts(table(spark, sf, "benchmark"), "item_id", "text", d).select("item_id", F.array_join("label_list", ",").alias("labels"))


@query(r"""
  WITH RECURSIVE w AS (SELECT item_id, regexp_extract_all(lower(text), '([^\s!(),.:;?\[\]{}]+|[^\s])', 1)[1:1 + item_id % 12] AS w FROM benchmark),
  k AS (SELECT w, max('b' || item_id % 7) AS label FROM w WHERE len(w) > 0 GROUP BY 1),
  d AS (SELECT doc_id, regexp_extract_all(lower(text), '([^\s!(),.:;?\[\]{}]+|[^\s])', 1) AS t FROM documents),
  p AS (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS s FROM d),
  m AS MATERIALIZED (SELECT doc_id, s, s + len(w) AS e, label FROM p JOIN k ON t[s] = w[1] AND t[s:s + len(w) - 1] = w),
  g AS MATERIALIZED (SELECT doc_id, s, max(e) AS e, arg_max(label, e) AS label FROM m GROUP BY 1, 2),
  r AS (SELECT doc_id, min(s) AS s FROM g GROUP BY 1
    UNION ALL SELECT r.doc_id, (SELECT min(n.s) FROM g n WHERE n.doc_id = r.doc_id AND n.s >= g.e) FROM r JOIN g ON g.doc_id = r.doc_id AND g.s = r.s),
  l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM r JOIN g USING (doc_id, s) GROUP BY 1)
  SELECT doc_id, coalesce(labels, '') AS labels FROM documents LEFT JOIN l USING (doc_id)""")
def dict_label_phrases(spark, sf):
    """The first one to twelve words of every benchmark item, found in all documents."""
    words = F.slice(L.words_with_places(F.col("text")), F.lit(1), (1 + F.col("item_id") % 12).cast("int"))
    d = table(spark, sf, "benchmark").select(F.array_join(words, " ").alias("ngram"), F.concat(F.lit("b"), (F.col("item_id") % 7).cast("string")).alias("label"))
    d = d.groupBy("ngram").agg(F.array(F.max("label")).alias("labels"))
    return L.label_texts(table(spark, sf, "documents"), "doc_id", "text", d).select("doc_id", F.array_join("label_list", ",").alias("labels"))


@query("""
  WITH s AS (SELECT conv_id, turn, text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS session FROM conversations)
  SELECT conv_id, CAST(session AS BIGINT) AS session, string_agg(text, chr(10) ORDER BY turn, text) AS text FROM s WHERE session > 0 GROUP BY 1, 2""")
def paragraph_sessions(spark, sf):
    c = table(spark, sf, "conversations")
    return S.session_texts(S.sessions(c, "conv_id", "turn", F.col("role") == "user"), "conv_id", "session", "turn", "text")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events")
def carry_forward(spark, sf):
    e = table(spark, sf, "events").withColumn("seen", F.when(F.col("event_type") == "click", F.col("value")))
    return S.carry_forward(e, "user_id", "event_id", "seen", "carried").select("event_id", "carried")


@query("SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS INTEGER) AS rank FROM lineitem")
def rank_dense(spark, sf):
    return S.rank_within(table(spark, sf, "lineitem"), "l_orderkey", ["l_partkey"], dense=True).select("l_orderkey", "l_linenumber", "rank")


@query("SELECT l_orderkey, l_linenumber, 'file_' || right('000000000' || CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS VARCHAR), 9) AS file_id FROM lineitem")
def row_ids(spark, sf):
    return S.row_ids(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], "file_", 9, "file_id")


@query("WITH t AS (SELECT event_id, user_id, event_type = 'click' AS f, lag(event_type = 'click') OVER w AS b, lead(event_id) OVER w AS a, row_number() OVER w AS r FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT event_id, user_id FROM t WHERE r = 1 OR a IS NULL OR f IS DISTINCT FROM b")
def transitions(spark, sf):
    return S.transitions(table(spark, sf, "events"), "user_id", "event_id", F.col("event_type") == "click").select("event_id", "user_id")


@query("WITH t AS (SELECT user_id, event_id AS low, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS high FROM events) SELECT * FROM t WHERE high - low >= 20")
def interval_threshold(spark, sf):
    return S.wide_intervals(table(spark, sf, "events"), "user_id", "event_id", 20)


@query("SELECT l_orderkey, l_linenumber, CAST(ntile(7) OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS INTEGER) AS shard FROM lineitem")
def shard_split(spark, sf):
    return S.shards(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), 7, ["l_orderkey", "l_linenumber"])


_PROSE = "SELECT doc_id AS id, CASE doc_id % 8 WHEN 0 THEN 'A 45-year-old man came.' WHEN 1 THEN 'She was aged sixty two and well.' WHEN 2 THEN 'An 8 months old girl.' WHEN 3 THEN 'A seventy three years old woman.' WHEN 4 THEN 'A 140-year-old male.' WHEN 5 THEN 'Patient was seen. He left.' WHEN 6 THEN 'A transgender man, aged 30.' ELSE 'No data here' END AS t FROM documents"


def prose(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.expr(_PROSE[_PROSE.index("CASE") : _PROSE.index(" AS t")]).alias("t"))


@query(f"WITH p AS ({_PROSE}) SELECT id, CAST(CASE id % 8 WHEN 0 THEN 45 WHEN 1 THEN 62 WHEN 2 THEN 0 WHEN 3 THEN 73 WHEN 6 THEN 30 END AS INTEGER) AS age FROM p")
def age_extract(spark, sf):
    return prose(spark, sf).select("id", T.extract_age(F.col("t")).alias("age"))


#: Behind every text stands one of these; what the text itself says comes first.
_AGES = ["A 5 years, 3 months and 10 days old boy.", "A 30-year previously healthy and very well woman, not old at all", "Of 3 months. She was sixty-two years of age, and old.", "Aged 40, he was seen after 2 weeks, old scars", "a 45 yo f", "Twenty one y/o", "For 10 years. Old scars", "one hundred and thirty one years old", "one hundred and five-year-old", "at the age of ninety", "no age", "It took 5 days; an old friend"]
_AGE_WORDS = {**T.NUMBER_WORDS, "and": 0}


def _age_number(c: str) -> str:
    """SQL: the number that digits or number words say."""
    known = " ".join(f"WHEN '{w}' THEN {n}" for w, n in _AGE_WORDS.items())
    return f"list_reduce(list_prepend(0, list_transform(regexp_split_to_array(lower({c}), '[- ]+'), lambda w: CASE w WHEN 'hundred' THEN -1 {known} ELSE coalesce(TRY_CAST(w AS INTEGER), 0) END)), lambda a, x: CASE WHEN x = -1 THEN greatest(a, 1) * 100 ELSE a + x END)"


@query(f"""WITH t AS (SELECT doc_id, coalesce(text, '') || ' ' || ({_AGES!r})[1 + doc_id % {len(_AGES)}] AS t FROM documents),
  e AS (SELECT doc_id, regexp_extract(t, '{T.OLD}', ['n', 'y', 'u']) AS o, regexp_extract(t, '{T.AGED}', ['n', 'u']) AS g FROM t),
  a AS (SELECT doc_id, CASE WHEN o.n <> '' THEN CASE WHEN regexp_matches(lower(o.u), '^(month|week|day)') THEN 0 ELSE {_age_number('o.n')} END
    WHEN g.n <> '' THEN CASE WHEN regexp_matches(lower(g.u), '^(month|week|day)') THEN 0 ELSE {_age_number('g.n')} END END AS a FROM e)
  SELECT doc_id, CAST(CASE WHEN a <= 130 THEN a END AS INTEGER) AS age FROM a""")
def age_of_texts(spark, sf):
    told = F.get(F.array(*map(F.lit, _AGES)), (F.col("doc_id") % len(_AGES)).cast("int"))
    return table(spark, sf, "documents").select("doc_id", T.extract_age(F.concat(F.coalesce("text", F.lit("")), F.lit(" "), told)).alias("age"))


_GENDER = "CASE " + f"WHEN regexp_matches(a, '{T.whole_words(T.ACRONYMS)}') THEN 'Transgender' " + " ".join(f"WHEN regexp_matches(%s, '{pattern}') THEN '{name}'" for name, pattern in T.GENDERS) + " END"


@query(f"""WITH p AS (SELECT id, lower(t || ' ' || coalesce(text, '')) AS t FROM ({_PROSE.replace(' FROM documents', ', text FROM documents')})),
  f AS (SELECT id, t, split_part(t, '.', 1) AS a FROM p)
  SELECT id, coalesce({_GENDER.replace('%s', 'a')}, {_GENDER.replace('%s', 't')}, 'Unknown') AS gender FROM f""")
def gender_extract(spark, sf):
    case = F.expr(_PROSE[_PROSE.index("CASE") : _PROSE.index(" AS t")])
    t = F.concat(case, F.lit(" "), F.coalesce("text", F.lit("")))
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), T.extract_gender(t).alias("gender"))


@query("SELECT doc_id, sha256(replace(replace(text, ' the ', '<a.webp><b.webp>'), ' la ', '<c.webp>')) AS replaced FROM documents")
def token_replace(spark, sf):
    entries = F.array(F.struct(F.lit(" the ").alias("k"), F.array(F.lit("a.webp"), F.lit("b.webp")).alias("v")), F.struct(F.lit(" la ").alias("k"), F.array(F.lit("c.webp")).alias("v")))
    return table(spark, sf, "documents").select("doc_id", F.sha2(A.replace_tokens(F.col("text"), entries), 256).alias("replaced"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS title,
  trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS heading,
  regexp_extract(html, '(?i)<html[^>]*\blang="([^"]*)"', 1) AS lang, CAST(len(regexp_extract_all(html, '(?i)(<p[ >])', 1)) AS INTEGER) AS paragraphs,
  CAST(len(regexp_extract_all(html, '(?i)(<a )', 1)) AS INTEGER) AS links FROM pages""")
def html_metadata(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.html_metadata(F.col("html")).alias("m")).select("page_id", "m.*")


@query("SELECT lang, count(*) AS amount, round(avg(n_chars), 1) AS avg_chars FROM documents GROUP BY 1")
def per_label_stats(spark, sf):
    return A.label_stats(table(spark, sf, "documents"), "lang", {"avg_chars": "n_chars"})


@query("SELECT quality, toxic, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY quality), 9) AS share FROM labels GROUP BY 1, 2")
def confusion_counts(spark, sf):
    return A.confusion(table(spark, sf, "labels"), "quality", "toxic").withColumn("share", F.round("share", 9))


@query("SELECT lang, round(1 / sqrt(count(*)), 9) AS weight FROM documents GROUP BY 1")
def class_weights(spark, sf):
    return A.class_weights(table(spark, sf, "documents"), "lang").withColumn("weight", F.round("weight", 9))


@query("SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark, sf):
    return A.repeated(table(spark, sf, "customer"), "c_nationkey").withColumnRenamed("c_nationkey", "k")


@query("SELECT s_suppkey, coalesce(n_name, 'none') AS nation FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON s_nationkey = n_nationkey")
def join_first_non_null(spark, sf):
    left = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"), F.lit(None).cast("string").alias("nation"))
    right = table(spark, sf, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("nation"))
    return H.fill_from(left, right, "k", ["nation"]).select("s_suppkey", F.coalesce("nation", F.lit("none")).alias("nation"))


@query("SELECT p_partkey, 'PMC' || p_partkey || '_01' AS case_id, 'PMC' || p_partkey AS article, CAST(p_size AS INTEGER) AS order_, 'PMC' || p_partkey || '_a_b' AS stem FROM part")
def file_keys(spark, sf):
    base = table(spark, sf, "part").select("p_partkey", "p_size", F.concat(F.lit("PMC"), F.col("p_partkey").cast("string")).alias("a"))
    named = base.select("p_partkey", "a", ids.subcaption_file(F.concat("a", F.lit("_a_b")), F.lit("A"), F.col("p_size"), F.lit(3), F.lit("webp")).alias("file"))
    parsed = named.select("p_partkey", F.concat("a", F.lit("_01")).alias("case_id"), ids.parse_subcaption_file(F.col("file")).alias("p"))
    return parsed.select("p_partkey", "case_id", ids.article_of(F.col("case_id")).alias("article"), F.col("p.order").alias("order_"), F.col("p.stem").alias("stem"))


#: Regions hold nations; one nation has a subsidiary tree of sizes.
TAXONOMY = X.Taxonomy(
    {"place": ["taxonomy"], "west": ["place"], "east": ["place"], "north_west": ["west"], "south_west": ["west"], "size": ["taxonomy"], "small": ["size"], "large": ["size"]},
    subsidiary={"west": ["size"]}, maps_to={"small_west": ["small", "north_west"]}, composed_by={"large_south": ["large", "south_west"]},
)


def _part_labels(spark, sf):
    one = lambda c, name: F.when(c, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    k, s = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf, "part").select("p_partkey", F.concat(one(k % 2 == 0, "south_west"), one(k % 3 == 0, "east"), one(k % 5 == 0, "small_west"), one(s > 25, "large")).alias("labels"))


_PART_LABELS = """WITH l AS (SELECT p_partkey, unnest(list_concat(CASE WHEN p_partkey % 2 = 0 THEN ['south_west'] ELSE [] END, CASE WHEN p_partkey % 3 = 0 THEN ['east'] ELSE [] END, CASE WHEN p_partkey % 5 = 0 THEN ['small', 'north_west'] ELSE [] END, CASE WHEN p_size > 25 THEN ['large'] ELSE [] END)) AS c FROM part),
  t(c, task, value) AS (VALUES ('south_west', 'place', 'west'), ('south_west', 'place:west', 'south_west'), ('north_west', 'place', 'west'), ('north_west', 'place:west', 'north_west'), ('east', 'place', 'east'), ('small', 'place', 'west'), ('small', 'place:west~size', 'small'), ('large', 'place', 'west'), ('large', 'place:west~size', 'large')),
  v AS (SELECT DISTINCT p_partkey, task, value FROM l JOIN t USING (c)),
  bad AS (SELECT p_partkey, task FROM v GROUP BY 1, 2 HAVING count(*) > 1),
  ok AS (SELECT * FROM v WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.p_partkey = v.p_partkey AND (v.task = b.task OR (starts_with(v.task, b.task) AND substr(v.task, len(b.task) + 1, 1) IN (':', '.', '~')))))"""


@query(_PART_LABELS + " SELECT p_partkey, task, value FROM ok")
def conflict_resolve(spark, sf):
    tasks = X.resolve(X.label_tasks(X.preprocess(F.col("labels"), TAXONOMY.maps_to), TAXONOMY.class_paths()))
    return _part_labels(spark, sf).select("p_partkey", F.explode(tasks).alias("t")).select("p_partkey", "t.task", "t.value")


@query(_PART_LABELS + """, m AS (SELECT p_partkey, max(value) FILTER (task = 'place') AS a, max(value) FILTER (task = 'place:west') AS b, max(value) FILTER (task = 'place:west~size') AS c FROM ok GROUP BY 1)
  SELECT p_partkey, coalesce(a, '') AS place, coalesce(b, CASE WHEN a = 'west' THEN 'other_west' ELSE '' END) AS west, coalesce(c, '') AS size FROM part LEFT JOIN m USING (p_partkey)""")
def task_pivot(spark, sf):
    out = X.multiplex(_part_labels(spark, sf), "labels", TAXONOMY, "multiplex_without_merging", {"place:west": ("west", "other_west")})
    west = TAXONOMY._named("place:west", TAXONOMY.children())
    return out.select("p_partkey", "place", F.col(f"`{west}`").alias("west"), F.col("`place:west~size`").alias("size"))


@query(_PART_LABELS + ", k AS (SELECT p_partkey, list(DISTINCT value) AS l FROM ok GROUP BY 1) SELECT p_partkey, array_to_string(list_sort(list_concat(coalesce(l, []), CASE WHEN list_has_all(coalesce(l, []), ['large', 'south_west']) THEN ['large_south'] ELSE [] END)), ',') AS labels FROM part LEFT JOIN k USING (p_partkey)")
def multilabel_compounds(spark, sf):
    return X.multiplex(_part_labels(spark, sf), "labels", TAXONOMY, "multilabel").select("p_partkey", F.array_join(F.array_sort("postprocessed_label_list"), ",").alias("labels"))


@query("SELECT * FROM (VALUES ('east', 'place:east', 'place', 'place'), ('large', 'place:west~size:large', 'place:west~size', 'size'), ('north_west', 'place:west.north_west', 'place:west~main', 'west'), ('small', 'place:west~size:small', 'place:west~size', 'size'), ('south_west', 'place:west.south_west', 'place:west~main', 'west'), ('west', 'place:west', 'place', 'place')) t(class_name, class_path, column_name, parent_class)")
def taxonomy_paths(spark, sf):
    return X.dimensions(spark, TAXONOMY)["class_map"].select("class_name", "class_path", "column_name", "parent_class")


@query()
def fig_numbers(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.extract_figure_numbers(F.concat(F.lit("As shown in Fig. 1 and 2, figs. 4-7. "), "text")).alias("numbers"))


@query("SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY floor(l_quantity / 10), floor(l_partkey / 10), l_linenumber, l_suppkey) AS INTEGER) AS rank FROM lineitem")
def grid_sort(spark, sf):
    return S.grid_rank(table(spark, sf, "lineitem"), "l_orderkey", "l_quantity", "l_partkey", ["l_linenumber", "l_suppkey"], 10).select("l_orderkey", "l_linenumber", "rank")


@query("""WITH m AS (SELECT conv_id, role, min(turn) AS first, string_agg(text, '. ' ORDER BY turn, text) AS text FROM conversations GROUP BY 1, 2)
  SELECT conv_id, role, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY first, role) AS INTEGER) AS turn, text, role || first AS tag FROM m""")
def merge_captions(spark, sf):
    c = table(spark, sf, "conversations").withColumn("tag", F.concat("role", F.col("turn").cast("string")))
    return R.merge_captions(c, "conv_id", "role", "turn", "text", "tag").select("conv_id", "role", "turn", "text", "tag")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'one ' || lang WHEN doc_id % 2 = 0 THEN 'two ' || lang ELSE 'A 40-year-old man.' END AS paragraphs FROM documents")
def case_fallback(spark, sf):
    one = lambda kind, title, text: F.struct(kind.alias("kind"), title.alias("title"), text.alias("text"))
    k = F.col("doc_id")
    sections = F.array(
        one(F.when(k % 3 == 0, "case").otherwise("intro"), F.lit("x"), F.concat(F.lit("one "), "lang")),
        one(F.lit("intro"), F.when(k % 2 == 0, "A Case").otherwise("none"), F.concat(F.lit("two "), "lang")),
        one(F.lit("intro"), F.lit("x"), F.lit("A 40-year-old man.")),
    )
    return table(spark, sf, "documents").select("doc_id", F.array_join(R.case_paragraphs(sections), "|").alias("paragraphs"))


@query("""SELECT p_partkey, reference, replace(caption, '#', p_brand) AS caption FROM part JOIN (VALUES (0, 'A', 'Scan of #. A mass.'), (0, 'B', 'Scan of #. A mass.'), (0, 'C', 'Scan of #. A mass. A cyst.'), (0, 'D', 'Scan of #. A cyst.'), (1, 'a', 'Chest of #.'), (1, 'b', 'Leg. It is normal.'), (2, 'undivided', '# alone'))
  t(k, reference, caption) ON p_partkey % 3 = k""")
def segment_caption(spark, sf):
    b, k = F.col("p_brand"), F.col("p_partkey") % 3
    caption = F.when(k == 0, F.concat(F.lit("Scan of "), b, F.lit(". A mass (A-C) and a cyst (C and D)."))).when(k == 1, F.concat(F.lit("a: Chest of "), b, F.lit(". b: Leg. It is normal."))).otherwise(F.concat(b, F.lit(" alone")))
    return table(spark, sf, "part").select("p_partkey", F.explode(C.segment_caption(caption)).alias("p")).select("p_partkey", "p.reference", "p.caption")


@query("""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[A-Za-z]{4,}') AS w, doc_id % 4 AS k FROM documents),
  n AS (SELECT *, least(2 + doc_id % 5, len(w) // 3) AS n FROM d),
  j AS (SELECT doc_id, k, n, i, CASE WHEN k = 3 THEN (['above', 'below', 'centre', 'left', 'right', 'upper'])[i + 1] ELSE chr(CAST(97 + i AS INTEGER)) END AS reference, upper(w[3 * i + 1][:1]) || lower(w[3 * i + 1][2:]) || ' ' || lower(w[3 * i + 2]) || ' ' || lower(w[3 * i + 3]) AS c FROM (SELECT *, unnest(range(n)) AS i FROM n)),
  p AS (SELECT doc_id, reference, 'Study of it. ' || c || '.' AS caption FROM j WHERE n > 1),
  u AS (SELECT doc_id, coalesce('Study of it. ' || CASE k WHEN 0 THEN reference || ' ' || c || '.' WHEN 1 THEN reference || ': ' || c || '.' WHEN 2 THEN c || ' (' || reference || ').' ELSE reference || ': ' || c || '.' END, 'Study of it. ') AS caption FROM n LEFT JOIN j USING (doc_id, k) WHERE n.n < 2)
  SELECT * FROM p UNION ALL SELECT doc_id, 'undivided', caption FROM u""")
def caption_parts(spark, sf):
    """Captions of two to six parts made of the documents' words: bare letters, marked letters, letters in brackets, places."""
    k, w = F.col("doc_id") % 4, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([A-Za-z]{4,})"), F.lit(1))
    n = F.least(2 + F.col("doc_id") % 5, F.floor(F.size("w") / 3))

    def part(i):
        word = lambda j: F.get(F.col("w"), (3 * i + j).cast("int"))
        c = F.concat(F.upper(F.substring(word(0), 1, 1)), F.lower(F.substring(word(0), 2, 10_000)), F.lit(" "), F.lower(word(1)), F.lit(" "), F.lower(word(2)))
        letter = F.when(k == 3, F.get(F.array(*map(F.lit, ["above", "below", "centre", "left", "right", "upper"])), i.cast("int"))).otherwise(F.char(97 + i))
        return F.when(k == 0, F.concat(letter, F.lit(" "), c, F.lit("."))).when(k == 2, F.concat(c, F.lit(" ("), letter, F.lit(")."))).otherwise(F.concat(letter, F.lit(": "), c, F.lit(".")))

    d = table(spark, sf, "documents").select("doc_id", w.alias("w")).withColumn("n", n)
    caption = F.concat(F.lit("Study of it. "), F.array_join(F.transform(F.when(F.col("n") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).otherwise(F.array().cast("array<bigint>")), part), " "))
    return d.select("doc_id", F.explode(C.segment_caption(caption)).alias("p")).select("doc_id", "p.reference", "p.caption")


@F.pandas_udf(BinaryType())
def _panels(key: pd.Series) -> pd.Series:
    """White images of 60 rows with one to three grey panels of noise, side by side."""

    def draw(k: int) -> bytes:
        a = np.full((60, 70 * (k % 3 + 1) + 20), 255, np.uint8)
        noise = np.random.default_rng(k).integers(0, 255, (40, 40))
        for i in range(k % 3 + 1):
            a[10:50, 20 + 70 * i : 60 + 70 * i] = noise
        return a.tobytes()

    return key.map(draw)


@query("SELECT p_partkey, p_partkey % 3 + 1 AS parts, CASE WHEN p_partkey % 3 = 1 THEN 'ok' ELSE 'incorrect-output-amount' END AS status FROM part")
def image_parts(spark, sf):
    width = (70 * (F.col("p_partkey") % 3 + 1) + 20).cast("int")
    image = F.struct(F.lit(60).alias("height"), width.alias("width"), F.lit(1).alias("nChannels"), _panels("p_partkey").alias("data"))
    # A small file of keys becomes a great many pixels: keys are dealt to all cores before they are drawn.
    keys = table(spark, sf, "part").select("p_partkey").repartition(8 * spark.sparkContext.defaultParallelism, "p_partkey")
    drawn = keys.select("p_partkey", image.alias("image"))
    counts = I.split_images(drawn).groupBy("p_partkey").agg(F.count("*").alias("parts"))
    return counts.withColumn("status", I.split_status(F.col("parts"), F.lit(2)))


@query("SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber = 1 OR l_linenumber = o_orderkey % 4")
def match_cases(spark, sf):
    cases = table(spark, sf, "orders").select("o_orderkey", F.array(F.lit(1), (F.col("o_orderkey") % 4).cast("int")).alias("numbers"))
    images = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    return R.match_cases(cases, images, "o_orderkey", "numbers", "l_linenumber").select("o_orderkey", "l_linenumber")


@query("""WITH p AS (SELECT l_orderkey, l_returnflag, list({'l_linenumber': l_linenumber} ORDER BY l_linenumber) AS parts FROM lineitem GROUP BY 1, 2)
  SELECT l_orderkey, CAST(to_json(list({'l_returnflag': l_returnflag, 'parts': parts} ORDER BY l_returnflag)) AS VARCHAR) AS images FROM p GROUP BY 1""")
def group_images(spark, sf):
    return R.group_images(table(spark, sf, "lineitem"), "l_orderkey", "l_returnflag", ["l_linenumber"]).select("l_orderkey", F.to_json("images").alias("images"))


@query("""SELECT l_orderkey AS o_orderkey, l_linenumber, o_totalprice, c_name FROM (SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY 1, 2 LIMIT 1 OFFSET 5) JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def point_lookup(spark, sf):
    return levels(spark, sf).example(5, ["o_orderkey", "l_linenumber"]).select("o_orderkey", "l_linenumber", "o_totalprice", "c_name")


def clinical(spark: SparkSession, sf: str):
    """Customers as articles, orders as their cases, line items as the cases' images, under the clinical names."""
    key = lambda c: F.concat(F.lit("PMC"), c.cast("string"))
    articles = table(spark, sf, "customer").select(key(F.col("c_custkey")).alias("pmcid"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("license"), F.array("c_mktsegment").alias("keywords"))
    orders = table(spark, sf, "orders").select("o_orderkey", F.concat(key(F.col("o_custkey")), F.lit("_"), F.col("o_orderkey").cast("string")).alias("case_id"), F.year("o_orderdate").alias("age"), F.col("o_orderpriority").alias("gender"), F.concat(F.lit("See fig 1 and fig 2 here. Of "), "o_orderpriority").alias("case_text"))
    items = table(spark, sf, "lineitem").join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "case_id"), "l_orderkey")
    file = F.concat("case_id", F.lit("_"), F.col("l_linenumber").cast("string"), F.lit(".jpg"))
    images = items.select("case_id", "l_linenumber", file.alias("file"), F.concat(F.lit("in/"), file).alias("file_path"), F.when(F.col("l_linenumber") % 2 == 0, "a").otherwise("undivided").alias("image_component"), F.concat(F.lit("fig "), F.col("l_linenumber").cast("string")).alias("mention"))
    return articles, orders.drop("o_orderkey"), images.withColumn("case_substring", F.array("mention"))


_CLINICAL = """WITH cas AS (SELECT 'PMC' || o_custkey || '_' || o_orderkey AS case_id, 'PMC' || o_custkey AS pmcid, o_orderkey, o_orderpriority AS gender, CAST(year(o_orderdate) AS INTEGER) AS age, 'See fig 1 and fig 2 here. Of ' || o_orderpriority AS case_text FROM orders),
  img AS (SELECT case_id, pmcid, o_orderkey, l_linenumber, case_id || '_' || l_linenumber || '.jpg' AS file FROM lineitem JOIN cas ON l_orderkey = o_orderkey)"""


@query("SELECT 'PMC' || c_custkey AS pmcid, c_mktsegment AS license, c_mktsegment AS keywords, 2 AS nulls FROM customer")
def project_article_metadata(spark, sf):
    out = J.article_metadata(clinical(spark, sf)[0])
    return out.select("pmcid", "license", F.array_join("keywords", ",").alias("keywords"), (F.col("mesh_terms").isNull().cast("int") + F.col("major_mesh_terms").isNull().cast("int")).alias("nulls"))


@query("SELECT 'PMC' || c_custkey AS pmcid, c_name AS title, c_mktsegment AS license, 10 AS columns FROM customer")
def project_citations(spark, sf):
    out = J.citations(clinical(spark, sf)[0])
    return out.select("pmcid", "title", "license", F.lit(len(out.columns)).alias("columns"))


@query(_CLINICAL + " SELECT case_id, pmcid, gender, age, case_text FROM cas")
def project_cases(spark, sf):
    return J.case_table(clinical(spark, sf)[1])


@query(_CLINICAL + " SELECT file, case_id, 'ds/images/' || file[:4] || '/' || file[:5] || '/' || file AS file_path, l_linenumber % 2 = 0 AS split_during_preprocessing, 16 AS columns FROM img")
def project_images(spark, sf):
    out = J.image_table(clinical(spark, sf)[2], "ds")
    return out.select("file", "case_id", "file_path", "split_during_preprocessing", F.lit(len(out.columns)).alias("columns"))


@query(_CLINICAL + ", n AS (SELECT case_id, count(*) AS k FROM img GROUP BY 1) SELECT case_id, 'https://www.ncbi.nlm.nih.gov/pmc/articles/' || pmcid || '/' AS link, k AS amount_of_images, 'images/' || case_id[:4] || '/' || case_id[:5] || '/' || case_id AS image_folder FROM cas JOIN n USING (case_id)")
def case_series_table(spark, sf):
    _, cases, images = clinical(spark, sf)
    return J.case_series_table(cases, images).select("case_id", "link", "amount_of_images", "image_folder")


@query(_CLINICAL + """, m AS (SELECT case_id, string_agg('<' || file || '>', '' ORDER BY file) FILTER (l_linenumber = 1) AS a, string_agg('<' || file || '>', '' ORDER BY file) FILTER (l_linenumber = 2) AS b FROM img GROUP BY 1)
  SELECT case_id, 'See ' || coalesce(a, 'fig 1') || ' and ' || coalesce(b, 'fig 2') || ' here. Of ' || gender AS case_text FROM cas LEFT JOIN m USING (case_id)""")
def image_token_cases(spark, sf):
    _, cases, images = clinical(spark, sf)
    return J.with_image_tokens(cases, images).select("case_id", "case_text")


@query(_CLINICAL + " SELECT case_id, file, CASE WHEN l_linenumber IN (1, 2) THEN 'See fig 1 and fig 2 here.' ELSE '' END AS text_references FROM img")
def sentence_figures(spark, sf):
    _, cases, images = clinical(spark, sf)
    return G.sentence_figures(cases, images, "case_id", "case_text", "l_linenumber").select("case_id", "file", F.array_join("text_references", "|").alias("text_references"))


@query("""WITH m AS (SELECT l_orderkey AS k, CASE WHEN l_linenumber = 1 THEN 'undivided' ELSE l_returnflag END AS c, strftime(l_shipdate, '%Y-%m-%d') AS mention FROM lineitem),
  f AS (SELECT DISTINCT l_orderkey AS k, l_returnflag AS c FROM lineitem)
  SELECT k, c, (SELECT coalesce(string_agg(DISTINCT mention, ',' ORDER BY mention), '') FROM m WHERE m.k = f.k AND m.c IN (f.c, 'undivided')) AS mentions FROM f""")
def join_figure_refs(spark, sf):
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("c"), "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("mention"))
    mentions = items.withColumn("c", F.when(F.col("l_linenumber") == 1, "undivided").otherwise(F.col("c")))
    return G.join_figure_references(items.select("k", "c").distinct(), mentions, "k", "c", "mentions").select("k", "c", F.array_join("mentions", ",").alias("mentions"))


@query("SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 1)")
def downloaded(spark, sf):
    return G.downloaded(table(spark, sf, "part"), table(spark, sf, "lineitem").where("l_linenumber = 1").select(F.col("l_partkey").alias("p_partkey")), "p_partkey").select("p_partkey")


@query(_CLINICAL + " SELECT case_id, c_mktsegment AS license FROM cas LEFT JOIN customer ON 'PMC' || c_custkey = pmcid")
def join_license(spark, sf):
    articles, cases, _ = clinical(spark, sf)
    return G.join_license(cases, articles, "case_id").select("case_id", "license")


@query("SELECT DISTINCT c AS char FROM (SELECT unnest(string_split(regexp_replace(text, '[a-zA-Z0-9\\s]', '', 'g'), '')) AS c FROM documents) WHERE c <> ''")
def special_chars(spark, sf):
    return L.special_chars(table(spark, sf, "documents"), "text")


@query("""WITH s AS (SELECT DISTINCT c AS char FROM (SELECT unnest(string_split(regexp_replace(text, '[a-zA-Z0-9\\s]', '', 'g'), '')) AS c FROM documents) WHERE c <> '')
  SELECT char FROM s WHERE char NOT IN (SELECT text[1] FROM benchmark UNION ALL SELECT text[-1] FROM benchmark)""")
def boundary_chars(spark, sf):
    return L.boundary_chars(table(spark, sf, "documents"), "text", table(spark, sf, "benchmark"), "text")


@query("""WITH x AS (SELECT p_partkey, list_concat(CASE WHEN p_size % 2 = 0 THEN ['_assertion_absent'] ELSE [] END, CASE WHEN p_size % 3 = 0 THEN ['mass'] ELSE [] END, ['_LABEL_BLOCKER', 'ct'], CASE WHEN p_size % 5 = 0 THEN ['axial'] ELSE [] END) AS x FROM part),
  y AS (SELECT p_partkey, CASE WHEN list_has_all(x, ['mass', '_assertion_absent']) THEN list_filter(x, lambda e: e NOT IN ('mass', '_assertion_absent', '_LABEL_BLOCKER')) ELSE list_filter(x, lambda e: e NOT IN ('_LABEL_BLOCKER', '_assertion_absent')) END AS y FROM x)
  SELECT p_partkey, array_to_string(CASE WHEN list_contains(y, 'mass') THEN y ELSE list_filter(y, lambda e: e <> 'axial') END, ',') AS labels FROM y""")
def label_pipeline(spark, sf):
    one = lambda test, name: F.when(test, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    k = F.col("p_size")
    labels = F.concat(one(k % 2 == 0, "_assertion_absent"), one(k % 3 == 0, "mass"), F.array(F.lit("_LABEL_BLOCKER"), F.lit("ct")), one(k % 5 == 0, "axial"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(L.label_pipeline(labels, [(["axial"], ["mass"])]), ",").alias("labels"))


@query("SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING') AND c_custkey >= 0")
def license_whitelist(spark, sf):
    return table(spark, sf, "customer").where(P.whitelisted(F.col("c_mktsegment"), ["BUILDING"]) & P.whitelisted(F.col("c_name"), [])).select("c_custkey")


@query("SELECT c_nationkey AS k, count(DISTINCT c_mktsegment) > 1 AS varied FROM customer GROUP BY 1")
def varied(spark, sf):
    return A.varied(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment").withColumnRenamed("c_nationkey", "k")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 100")
def most_first(spark, sf):
    return O.most_first(table(spark, sf, "lineitem"), "l_extendedprice", "l_orderkey", "l_linenumber", limit=100).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT doc_id, 'PMC' || doc_id AS pmcid, 'Title ' || lang AS title, lang AS license, len(coalesce(text, '')) > 0 AS has_text, 2 AS n_captions, 'f2.jpg' AS second_file FROM documents")
def article_xml(spark, sf):
    escaped = F.regexp_replace(F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    info = lambda k, v: F.concat(F.lit(f'<infon key="{k}">'), v if not isinstance(v, str) else F.lit(v), F.lit("</infon>"))
    passage = lambda *parts: F.concat(F.lit("<passage>"), *parts, F.lit("</passage>"))
    text = lambda t: F.concat(F.lit("<text>"), t, F.lit("</text>"))
    figure = lambda n: passage(info("type", "fig_caption"), info("id", f"F{n}"), info("file", f"f{n}.jpg"), text(F.lit(f"Scan {n}.")))
    xml = F.concat(F.lit("<collection><document><id>"), F.col("doc_id").cast("string"), F.lit("</id>"), passage(info("section_type", "TITLE"), info("type", "front"), info("license", F.col("lang")), text(F.concat(F.lit("Title "), "lang"))), passage(info("section_type", "CASE"), info("type", "paragraph"), text(escaped)), figure(1), figure(2), F.lit("</document></collection>"))
    one = Q.article_xml(F.col("xml"))
    out = table(spark, sf, "documents").select("doc_id", xml.alias("xml")).select("doc_id", one.alias("a"))
    return out.select("doc_id", "a.pmcid", "a.title", "a.license", (F.length(F.get("a.sections", 0)["text"]) > 0).alias("has_text"), F.size("a.captions").alias("n_captions"), F.get("a.captions", 1)["file"].alias("second_file"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'PMC' || c_custkey END AS pmcid, CASE WHEN c_custkey % 3 <> 0 THEN 'Mapping error.' END AS comment FROM customer")
def map_ids(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    known = c.where("c_custkey % 3 = 0").select("c_custkey", F.concat(F.lit("PMC"), F.col("c_custkey").cast("string")).alias("pmcid"))
    return Q.map_ids(c, known, "c_custkey")


@query("SELECT p_partkey, regexp_replace(p_name || '.jpg', '\\.jpg$', '.webp') AS file FROM part")
def replace_suffix(spark, sf):
    return table(spark, sf, "part").select("p_partkey", J.with_extension(F.concat("p_name", F.lit(".jpg")), "webp").alias("file"))


@query("""WITH b AS (SELECT event_id, year(ts) + event_id % 3 AS y FROM events), p AS (SELECT * FROM b WHERE event_id % 2 = 0 AND y < 2026),
  u AS (SELECT * FROM p UNION ALL SELECT * FROM b WHERE event_id % 3 = 0 AND y >= (SELECT max(y) FROM p) AND event_id NOT IN (SELECT event_id FROM p))
  SELECT event_id, 'file_' || right('0000000' || CAST(row_number() OVER (ORDER BY event_id) - 1 AS VARCHAR), 7) AS file_id FROM u""")
def update_dataset(spark, sf):
    e = table(spark, sf, "events").select("event_id", (F.year("ts") + F.col("event_id") % 3).cast("string").alias("y"), F.lit("x").alias("file_id"))
    return H.update(e.where("event_id % 2 = 0 and y < 2026"), e.where("event_id % 3 = 0"), "event_id", "y", ["event_id"], "file_", 7).select("event_id", "file_id")


@query("SELECT event_id, coalesce(p, 'seen') AS label FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_type END AS p FROM events)")
def fill_predictions(spark, sf):
    e = table(spark, sf, "events")
    known = e.select("event_id", F.when(F.col("event_id") % 4 == 0, F.col("event_type")).alias("label"))
    return O.fill_predictions(known, e.select("event_id"), "event_id", ["label"], lambda images: images.withColumn("label", F.lit("seen")))


query(ARTICLE_PASSAGES)(article_passages)
query(ARTICLE_CASES)(article_cases)


@query("""WITH c AS (SELECT o_custkey AS g, o_orderpriority AS l, count(*) AS n FROM orders GROUP BY 1, 2),
  m AS (SELECT g, arg_min(l, (-n, l)) AS l, sum(n) AS n FROM c GROUP BY 1),
  p AS (SELECT g, row_number() OVER (PARTITION BY l ORDER BY n DESC, g) - 1 AS i FROM m),
  f AS (SELECT g, CAST(CASE WHEN i // 10 % 2 = 0 THEN i % 10 ELSE 9 - i % 10 END AS INTEGER) AS fold FROM p)
  SELECT o_orderkey, fold, fold < 2 AS is_valid FROM orders JOIN f ON o_custkey = g""")
def group_folds(spark, sf):
    """Folds of the customers' orders, balanced by priority."""
    out = O.stratified_group_folds(table(spark, sf, "orders"), "o_custkey", "o_orderpriority", order=F.col("o_custkey"))
    return out.select("o_orderkey", "fold", "is_valid")


@query("""WITH w AS (SELECT kind, 1 / sqrt(count(*)) AS w FROM items GROUP BY 1),
  i AS (SELECT item_id, CAST(greatest(round(w.w / (SELECT max(w.w) FROM w JOIN items USING (kind)) * 1073741824), 1) AS HUGEINT) AS u FROM items i JOIN w USING (kind)),
  p AS (SELECT item_id, u, sum(u) OVER (ORDER BY item_id) - u AS b, sum(u) OVER () AS t FROM i),
  d AS (SELECT item_id, CAST(((b + u) * 5000 + t // 2) // t - (b * 5000 + t // 2) // t AS BIGINT) AS copies FROM p)
  SELECT item_id, copies FROM d WHERE copies > 0""")
def weighted_draw(spark, sf):
    """5,000 items drawn with replacement, rare kinds more often."""
    items = table(spark, sf, "items")
    weighted = items.join(A.class_weights(items, "kind"), "kind").select("item_id", "weight")
    return O.weighted_draw(weighted, ["item_id"], "weight", 5000, order=F.col("item_id"), offset=0.5).select("item_id", "copies")


def class_edges(spark, sf):
    """Subclass edges over the clients: three below each, some pairs in a circle, some with their master as a second parent, some twice."""
    c = table(spark, sf, "clients").select("client_id", "master_id")
    k, name = F.col("client_id"), lambda x: F.concat(F.lit("c"), x.cast("string"))
    parent = F.when(k == 0, "taxonomy").when(k % 97 == 45, name(k + 1)).when(k % 97 == 46, name(k - 1)).otherwise(name(F.expr("client_id div 3")))
    more = F.when((k % 25 == 7) & (F.col("master_id") != k), F.array(parent, name(F.col("master_id")))).when(k % 50 == 9, F.array(parent, parent)).otherwise(F.array(parent))
    return c.select(name(k).alias("child"), F.explode(more).alias("parent"))


_CLASS_EDGES = """WITH RECURSIVE b AS (SELECT client_id AS k, master_id AS m, 'c' || client_id AS child,
    CASE WHEN client_id = 0 THEN 'taxonomy' WHEN client_id % 97 = 45 THEN 'c' || (client_id + 1) WHEN client_id % 97 = 46 THEN 'c' || (client_id - 1) ELSE 'c' || (client_id // 3) END AS parent FROM clients),
  e AS (SELECT child, parent FROM b UNION ALL SELECT child, CASE WHEN k % 25 = 7 THEN 'c' || m ELSE parent END FROM b WHERE (k % 25 = 7 AND m <> k) OR (k % 50 = 9 AND NOT (k % 25 = 7 AND m <> k))),
  r AS (SELECT DISTINCT child AS class, parent AS ancestor, 1 AS distance FROM e UNION SELECT e.child, ancestor, distance + 1 FROM r JOIN e ON class = parent WHERE distance < 40),
  z AS (SELECT class, ancestor, CAST(min(distance) AS INTEGER) AS distance FROM r GROUP BY 1, 2)"""


@query(_CLASS_EDGES + " SELECT * FROM z")
def class_closure(spark, sf):
    return X.subclass_closure(class_edges(spark, sf))


@query(_CLASS_EDGES + """, d AS (SELECT DISTINCT * FROM e)
  SELECT 'several parents' AS kind, child AS class_name FROM d GROUP BY child HAVING count(*) > 1
  UNION ALL SELECT 'recursion', class FROM z WHERE class = ancestor
  UNION ALL SELECT 'empty tree', child FROM d WHERE parent = 'taxonomy' AND child NOT IN (SELECT parent FROM d)
  UNION ALL SELECT 'single child', min(child) FROM d WHERE parent <> 'taxonomy' GROUP BY parent HAVING count(*) = 1
  UNION ALL SELECT 'repeated edge', child FROM e GROUP BY child, parent HAVING count(*) > 1""")
def class_errors(spark, sf):
    return X.taxonomy_errors(class_edges(spark, sf), "taxonomy")


#: The same regions and sizes, each task with a class for what is none of the others.
OPEN_TAXONOMY = X.Taxonomy(
    {"place": ["taxonomy"], "west": ["place"], "east": ["place"], "other_place": ["place"], "north_west": ["west"], "south_west": ["west"], "other_west": ["west"], "size": ["taxonomy"], "small": ["size"], "large": ["size"], "no_size": ["size"]},
    subsidiary={"west": ["size"]}, maps_to={"small_west": ["small", "north_west"]},
)


@query(_PART_LABELS + """, m AS (SELECT p_partkey, max(value) FILTER (task = 'place') AS a, max(value) FILTER (task = 'place:west') AS b, max(value) FILTER (task = 'place:west~size') AS c FROM ok GROUP BY 1)
  SELECT p_partkey, coalesce(a, 'other_place') AS place, coalesce(b, CASE WHEN a = 'west' THEN 'other_west' ELSE '' END) AS west, coalesce(c, CASE WHEN a = 'west' THEN 'no_size' ELSE '' END) AS size FROM part LEFT JOIN m USING (p_partkey)""")
def exclusion_columns(spark, sf):
    """Missing tasks filled by the classes that their names make exclusion classes."""
    out = X.multiplex(_part_labels(spark, sf), "labels", OPEN_TAXONOMY, "multiplex_without_merging", X.exclusion_defaults(OPEN_TAXONOMY))
    west = OPEN_TAXONOMY._named("place:west", OPEN_TAXONOMY.children())
    return out.select("p_partkey", "place", F.col(f"`{west}`").alias("west"), F.col("`place:west~size`").alias("size"))


_SEGMENTS = r"""WITH d AS (SELECT DISTINCT text FROM benchmark), x AS (SELECT unnest(regexp_split_to_array(text, '[!(),.:;?\[\]{}]')) AS s FROM d)"""


@query(_SEGMENTS + r"""
  SELECT 'segment' AS kind, sha256(s) AS item, count(*) AS count FROM (SELECT trim(s, ' ' || chr(9) || chr(10) || chr(13)) AS s FROM x) WHERE s <> '' GROUP BY ALL
  UNION ALL SELECT 'token', sha256(t), count(*) FROM (SELECT unnest(regexp_split_to_array(s, '[ \n]')) AS t FROM x) WHERE t <> '' GROUP BY ALL""")
def segments_and_tokens(spark, sf):
    tables = N.ngram_tables(table(spark, sf, "benchmark"), "text", 3, 1)
    named = lambda kind: tables[f"{kind}s"].select(F.lit(kind).alias("kind"), F.sha2(kind, 256).alias("item"), "count")
    return named("segment").unionByName(named("token"))


@query(_CLINICAL + """, c AS (SELECT file, 'early' AS class, age FROM img JOIN cas USING (case_id) WHERE age <= 1995 UNION ALL SELECT file, 'urgent', age FROM img JOIN cas USING (case_id) WHERE gender IN ('1-URGENT', '2-HIGH'))
  SELECT file, 'ds/all_' || class || '/images/' || file[:4] || '/' || file[:5] || '/' || file AS file_path, class, 1 AS unlabelled FROM c WHERE file IN (SELECT file FROM c GROUP BY 1 HAVING count(*) = 1)""")
def image_classes(spark, sf):
    """Two classes of images by filters on their cases; those of both are dropped."""
    articles, cases, images = clinical(spark, sf)
    cases = cases.withColumn("pmcid", F.substring_index("case_id", "_", 1))
    builder = DatasetBuilder(articles, cases, images.withColumn("pmcid", F.substring_index("case_id", "_", 1)))
    classes = {"early": [{"field": "max_age", "string_list": ["1995"]}], "urgent": [{"field": "gender", "string_list": ["1-urgent", "2-high"]}]}
    out = E.classification_table(builder, "ds/all", [], classes, keep_label_columns=True)
    return out.select("file", "file_path", "class", F.col("image_type").isNull().cast("int").alias("unlabelled"))


@query("""WITH d AS (SELECT doc_id, 'i' || doc_id AS image, 1 + doc_id % 3 AS a, 2 + doc_id % 4 AS b FROM documents),
  m AS (SELECT image, chr(CAST(96 + a + k AS INTEGER)) AS c, 'Figs. ' || a || chr(CAST(96 + a AS INTEGER)) || '-' || chr(CAST(96 + a + b AS INTEGER)) AS mention FROM d, range(0, 6) t(k) WHERE k <= b
    UNION ALL SELECT image, 'undivided', 'figure 9' FROM d WHERE doc_id % 2 = 0 UNION ALL SELECT image, 'b', 'Fig 4 B' FROM d WHERE doc_id % 5 = 0),
  f AS (SELECT image, c FROM d, (VALUES ('a'), ('b'), ('e'), ('undivided')) t(c))
  SELECT image, c AS image_component, (SELECT coalesce(string_agg(DISTINCT mention, '|' ORDER BY mention), '') FROM m WHERE m.image = f.image AND m.c IN (f.c, 'undivided')) AS case_substring FROM f""")
def mentioned_parts(spark, sf):
    """Figures that whole texts mention, with ranges of letters, joined to the parts of images."""
    k, s = F.col("doc_id"), lambda c: c.cast("string")
    a, b = 1 + k % 3, 2 + k % 4
    first = F.concat(F.lit(" Figs. "), s(a), F.char(96 + a), F.lit("-"), F.char(96 + a + b), F.lit(" show it."))
    text = F.concat(F.coalesce("text", F.lit("")), first, F.when(k % 2 == 0, " See figure 9.").otherwise(""), F.when(k % 5 == 0, " In Fig 4 B it is.").otherwise(""))
    d = table(spark, sf, "documents").select(F.concat(F.lit("i"), s(k)).alias("image"), T.extract_figure_mentions(text).alias("m"))
    files = d.select("image", F.explode(F.array(*map(F.lit, ["a", "b", "e", "undivided"]))).alias("image_component"))
    out = G.join_figure_references(files, G.mention_rows(d, "image", "m"), "image")
    return out.select("image", "image_component", F.array_join("case_substring", "|").alias("case_substring"))


@query("""WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
  o AS (SELECT vec_id, label, unnest(v) AS x, unnest(range(len(v))) AS i FROM e),
  t AS (SELECT vec_id, CASE WHEN label < 5 THEN 'low' ELSE 'high' END AS half, 'l' || label AS leaf FROM e WHERE label IS NOT NULL),
  h AS (SELECT half AS c, i, avg(x) AS m FROM o JOIN t USING (vec_id) GROUP BY 1, 2),
  l AS (SELECT half, leaf AS c, i, avg(x) AS m FROM o JOIN t USING (vec_id) GROUP BY 1, 2, 3),
  a AS (SELECT vec_id, arg_min(c, (d, c)) AS half FROM (SELECT vec_id, c, sum((x - m) ** 2) AS d FROM o JOIN h USING (i) GROUP BY 1, 2) GROUP BY 1),
  b AS (SELECT vec_id, arg_min(c, (d, c)) AS leaf FROM (SELECT vec_id, c, sum((x - m) ** 2) AS d FROM o JOIN a USING (vec_id) JOIN l USING (i, half) GROUP BY 1, 2) GROUP BY 1)
  SELECT vec_id, half, CASE WHEN half = 'low' THEN leaf END AS low, CASE WHEN half = 'high' THEN leaf END AS high FROM embeddings LEFT JOIN a USING (vec_id) LEFT JOIN b USING (vec_id)""")
def centroid_levels(spark, sf):
    """All vectors classified by the nearest class mean, first into halves, then within the half."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    half = F.when(F.col("label").isNotNull(), F.when(F.col("label") < 5, "low").otherwise("high"))
    e = e.withColumn("half", half).withColumn("leaf", F.concat(F.lit("l"), F.col("label").cast("string")))
    model = lambda label, part: M.nearest_centroid(M.centroids(part, "embedding", label))
    tasks = {"half": M.Task(model("half", e))} | {h: M.Task(model("leaf", e.where(F.col("half") == h)), "half", h) for h in ("low", "high")}
    return M.score_levels(e, "vec_id", "embedding", tasks)


QUERIES.update(column_queries.QUERIES)
ORACLE_SQL.update(column_queries.ORACLE_SQL)


@query("""WITH l AS (SELECT p_partkey, unnest(list_concat(CASE WHEN p_partkey % 2 = 0 THEN ['south_west'] ELSE [] END, CASE WHEN p_partkey % 7 = 0 THEN ['north_west', 'north_west'] ELSE [] END, CASE WHEN p_partkey % 3 = 0 THEN ['east'] ELSE [] END, CASE WHEN p_partkey % 5 = 0 THEN ['west', 'unknown'] ELSE [] END, CASE WHEN p_size > 25 THEN ['large'] ELSE [] END, CASE WHEN p_size < 30 THEN ['small'] ELSE [] END)) AS c FROM part),
  p(c, parent_class) AS (VALUES ('south_west', 'west'), ('north_west', 'west'), ('east', 'place'), ('west', 'place'), ('large', 'size'), ('small', 'size'))
  SELECT p_partkey, parent_class, count(DISTINCT c) AS n FROM l JOIN p USING (c) GROUP BY 1, 2 HAVING count(DISTINCT c) > 1""")
def disjoint_labels(spark, sf):
    """Rows with several labels below one parent."""
    one = lambda test, *names: F.when(test, F.array(*map(F.lit, names))).otherwise(F.array().cast("array<string>"))
    k, s = F.col("p_partkey"), F.col("p_size")
    labels = F.concat(one(k % 2 == 0, "south_west"), one(k % 7 == 0, "north_west", "north_west"), one(k % 3 == 0, "east"), one(k % 5 == 0, "west", "unknown"), one(s > 25, "large"), one(s < 30, "small"))
    class_map = X.dimensions(spark, TAXONOMY)["class_map"]
    return X.disjoint_violations(table(spark, sf, "part").select("p_partkey", labels.alias("labels")), "p_partkey", "labels", class_map)


@query(_PART_LABELS + """, m AS (SELECT p_partkey, max(value) FILTER (task = 'place') AS a, max(value) FILTER (task = 'place:west') AS b, max(value) FILTER (task = 'place:west~size') AS c FROM ok GROUP BY 1)
  SELECT p_partkey, array_to_string(list_filter([a, c], lambda x: x IS NOT NULL), ',') AS packed, coalesce(b, '') AS west FROM part LEFT JOIN m USING (p_partkey)""")
def packed_columns(spark, sf):
    """Two task columns packed into one list, a third left as it is."""
    west = TAXONOMY._named("place:west", TAXONOMY.children())
    out = X.multiplex(_part_labels(spark, sf), "labels", TAXONOMY, "multiplex", merged={"packed": ["place", "place:west~size"]})
    return out.select("p_partkey", F.array_join("packed", ",").alias("packed"), F.col(f"`{west}`").alias("west"))

"""Literal fixtures for extraction, labels, taxonomies, the filter list and exports."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.functions import captions as C
from vellum.functions import predicates as P
from vellum.functions import text as T
from vellum.operators import articles as R
from vellum.operators import labels as L
from vellum.operators import pixels as I
from vellum.operators import sequences as S
from vellum.operators import taxonomy as X
from vellum.plans.query import CLINICAL, DatasetBuilder, validate
from vellum.sources.exports import export


def test_figure_numbers_to_the_end_of_the_sentence():
    assert T.figure_numbers("Figures labelled 3 and 4.") == [3, 4]
    assert T.figure_numbers("Fig. 2 shows x and 3. Then 5.") == [2, 3]
    assert T.figure_numbers("Figs. " + ", ".join(f"{i} (first  part)"[:-1] for i in range(1, 13)) + ".") == list(range(1, 13))
    assert T.figure_numbers("Fig 1 one two three four 2 one two three four five 3") == [1, 2]
    assert T.figure_numbers("Figure shows one two three four five 6.") == []
    assert T.figure_numbers("(Fig. 1) of 3 men") == [1]
    assert T.figure_numbers("Fig. 1 and a 5-year-old, and 7 years") == [1]
    assert T.figure_numbers("Fig. 2A-C and 5, 7 through 9") == [2, 5, 7, 8, 9]


def test_figure_numbers_and_mentions():
    assert T.figure_numbers("as shown in Fig. 1 and 2.") == [1, 2]
    assert T.figure_numbers("(figs. 4-7).") == [4, 5, 6, 7]
    assert T.figure_numbers("Figure 16 and figure 3") == [3]
    assert T.figure_numbers(None) == []
    assert T.figure_mentions("see Figure 2A-C") == [{"mention": "Figure 2A-C", "letters": ["a", "b", "c"]}]


@pytest.mark.parametrize(("terms", "want"), [(["Diabetes Mellitus", "Stroke"], [False, True, False, True, True, False]), (None, [False, False, True, False, False, True])])
def test_array_terms(spark, terms, want):
    df = spark.createDataFrame([(terms,)], "t array<string>")
    tests = [P.has_terms(F.col("t"), ["diabetes", "stroke"], o, m) for m in ("full_match", "partial_match") for o in ("all", "any", "none")]
    assert list(df.select(*[t.alias(f"c{i}") for i, t in enumerate(tests)]).first()) == want


def test_longest_match_and_constraints(spark):
    d = spark.createDataFrame([("lung", ["Body_Part"]), ("lung cancer", ["Clinical_Finding"]), ("mass", ["Clinical_Finding"]), ("no mass", ["_LABEL_BLOCKER"])], "ngram string, labels array<string>")
    t = spark.createDataFrame([(1, "Lung cancer."), (2, "no mass"), (3, "massive"), (4, "lung, cancer")], "id int, text string")
    got = {r["id"]: r["label_list"] for r in L.label_texts(t, "id", "text", d).collect()}
    assert got == {1: ["Clinical_Finding"], 2: ["_LABEL_BLOCKER"], 3: [], 4: ["Body_Part"]}
    row = spark.range(1).select(F.array(*map(F.lit, ["_assertion_absent", "mass", "ct"])).alias("l"))
    out = L.remove_label(L.remove_incompatibilities(F.col("l"), ["_assertion_absent"], ["mass"]), "_assertion_absent")
    assert row.select(out.alias("x")).first()["x"] == ["ct"]


def test_paths_and_errors():
    path = "vehicle:boat.ferry~size:large"
    assert X.path_tasks(path) == [("vehicle", "boat"), ("vehicle:boat", "ferry"), ("vehicle:boat.ferry~size", "large")]
    good = {"t": ["taxonomy"], "a": ["t"], "b": ["t"]}
    X.Taxonomy(good).validate()
    for bad, word in (({**good, "c": ["a"]}, "single child"), ({**good, "b": ["t", "a"]}, "graph"), ({"t": ["taxonomy"]}, "empty"), ({**good, "x": ["y"], "y": ["x"]}, "recursion")):
        with pytest.raises(X.TaxonomyError, match=word):
            X.Taxonomy(bad).validate()


def test_reconciliation_and_export(spark, tmp_path):
    art = spark.createDataFrame([("A1", "2000"), ("A2", "2001"), ("A3", "2002")], "pmcid string, year string")
    cas = spark.createDataFrame([("A1", "A1_01", 40), ("A1", "A1_02", 40), ("A2", "A2_01", 40), ("A3", "A3_01", 4)], "pmcid string, case_id string, age int")
    img = spark.createDataFrame([("A1", "A1_01", "f1", "p/f1"), ("A3", "A3_01", "f2", "p/f2")], "pmcid string, case_id string, file string, file_path string")
    b = DatasetBuilder(art, cas, img)
    f = {"field": "min_age", "string_list": ["18"]}
    for kind, cases, articles in (("text", {"A1_01"}, {"A1"}), ("case_series", {"A1_01"}, {"A1"}), ("image", {"A1_01", "A1_02", "A2_01"}, {"A1", "A2"}), ("multimodal", {"A1_01", "A1_02", "A2_01"}, {"A1", "A2"})):
        out = b.query(f, kind)
        assert {r["case_id"] for r in out.cases.collect()} == cases and {r["pmcid"] for r in out.articles.collect()} == articles
    path = str(tmp_path / "ds")
    export(b.query(f, "multimodal"), path, "multimodal", [f], "ds")
    assert {r["pmcid"] for r in json.load(open(f"{path}/case_report_citations.json"))} == {"A1", "A2"}
    with pytest.raises(ValueError, match="exists"):
        export(b.query(f), path, "multimodal", [f], "ds")
    for bad in ([{"field": "min_age"}], [{"field": "nope", "string_list": []}], ["x"]):
        with pytest.raises(ValueError):
            validate(bad, CLINICAL)


def test_captions(spark):
    df = spark.createDataFrame([(", and a mass in the lung;",), ("x",)], "c string")
    assert [r[0] for r in df.select(T.fix_caption(F.col("c"))).collect()] == ["A mass in the lung.", "Medical image."]
    df = spark.createDataFrame([("['mri', \"it's\"]",), ("plain",), (None,)], "c string")
    assert [r[0] for r in df.select(T.parse_list_column(F.col("c"))).collect()] == [["mri", "it's"], ["plain"], None]


def test_caption_parts(spark):
    caption = "Chest film of the patient. We see a cyst near the hilum (A-C) and a broken rib on the other side (C and D)."
    mass, bleed = "We see a cyst near the hilum.", "A broken rib on the other side."
    want = {"A": [mass], "B": [mass], "C": [mass, bleed], "D": [bleed]}
    assert {p["reference"]: p["caption"] for p in C.segment(caption)} == {r: " ".join(["Chest film of the patient.", *t]) for r, t in want.items()}
    got = C.segment("a: Chest X-ray of 2.5 cm. b: Abdomen. It is normal.")
    assert got == [{"reference": "a", "caption": "Chest X-ray of 2.5 cm."}, {"reference": "b", "caption": "Abdomen. It is normal."}]
    assert [p["reference"] for p in C.segment("Lung (left) and liver (right).")] == ["left", "right"]
    assert C.segment("One scan.") == [{"reference": "undivided", "caption": "One scan."}]
    assert C.segment(None) == [] and C.expand("D-A") == ["D", "manual_review_needed"]
    df = spark.createDataFrame([("Ct (A). Mri (B).",), (None,)], "t string")
    rows = [r[0] for r in df.select(C.segment_caption("t")).collect()]
    assert [[p["reference"] for p in r or []] for r in rows] == [["A", "B"], []]


def test_case_paragraphs_and_captions(spark):
    rows = [(1, [("CASE", "x", "p1"), ("INTRO", "case", "p2")]), (2, [("INTRO", "A case", "p3")]), (3, [("INTRO", "x", "A 40-year-old man."), ("INTRO", None, "no")]), (4, []), (5, None)]
    df = spark.createDataFrame(rows, "id int, s array<struct<kind string, title string, text string>>")
    got = {r[0]: r[1] for r in df.select("id", R.case_paragraphs(F.col("s"))).collect()}
    assert got == {1: ["p1"], 2: ["p3"], 3: ["A 40-year-old man."], 4: [], 5: []}
    c = spark.createDataFrame([("a", "f", 3, "two", "t3"), ("a", "f", 1, "one", "t1"), ("a", "g", 2, "x", "t2"), ("b", "f", 9, "y", "t9")], "article string, file string, o int, text string, tag string")
    merged = {tuple(r) for r in R.merge_captions(c, "article", "file", "o", "text", "tag").select("article", "file", "o", "text", "tag").collect()}
    assert merged == {("a", "f", 1, "one. two", "t1"), ("a", "g", 2, "x", "t2"), ("b", "f", 1, "y", "t9")}
    t = spark.createDataFrame([("A review",), ("Case review",), ("Study",), (None,)], "t string")
    assert [r[0] for r in t.select(R.is_noise(F.col("t"))).collect()] == [True, False, True, False]


def test_images_of_one_size_are_cut_in_stacks(spark):
    rng = np.random.default_rng(3)
    stack = np.full((5, 60, 130), 255.0)
    for i in range(5):
        stack[i, 10 : 45 + i, 5:50] = rng.integers(0, 255, (35 + i, 45))
        stack[i, 12:55, 80 : 115 + i] = 40 * i
    whole = I.edges(I.blur(stack))
    for i in range(5):
        assert (whole[i] == I.edges(I.blur(stack[i]))).all()
    small = stack[:, :, :60].astype(np.uint8)
    rows = [(k, (60, 130, 1, stack[k % 5].astype(np.uint8).tobytes()) if k % 2 else (60, 60, 1, small[k % 5].tobytes())) for k in range(40)]
    df = spark.createDataFrame([*rows, (40, None)], "k int, image struct<height: int, width: int, nChannels: int, data: binary>").coalesce(1)
    got = [tuple(r)[:6] for r in I.split_images(df).collect()]
    alone = [(k, *r[1:]) for k, *_ in rows for r in (got_one for got_one in got if got_one[0] == k % 10)]
    assert got == alone and len(got) > 40 and {r[0] for r in got} == set(range(40))


def test_image_parts(spark):
    rng = np.random.default_rng(0)
    a = np.full((220, 320, 3), 255, np.uint8)
    for y, x in ((10, 10), (10, 170), (120, 10)):
        a[y : y + 80, x : x + 120] = rng.integers(0, 255, (80, 120, 1))
    image = lambda v: {"height": v.shape[0], "width": v.shape[1], "nChannels": v.shape[2], "data": v.tobytes()}
    schema = "id int, image struct<height int, width int, nChannels int, data binary>"
    df = spark.createDataFrame([(1, image(a)), (2, image(np.full((60, 60, 1), 255, np.uint8))), (3, None)], schema)
    got = sorted(I.split_images(df).drop("data").collect())
    assert [(r["id"], r["part"]) for r in got] == [(1, 1), (1, 2), (1, 3)]
    for r, (y, x) in zip(got, ((10, 10), (10, 170), (120, 10)), strict=True):
        assert max(abs(r["y0"] - y), abs(r["x0"] - x), abs(r["y1"] - y - 80), abs(r["x1"] - x - 120)) <= 12
    s = spark.createDataFrame([(None, 2), (0, 2), (2, 2), (3, 2)], "f int, w int").select(I.split_status(F.col("f"), F.col("w")))
    assert [r[0] for r in s.collect()] == ["image-not-found", "zero-output-amount", "ok", "incorrect-output-amount"]


def test_owl_round_trip():
    t = X.Taxonomy({"tree": ["taxonomy"], "a": ["tree"], "b": ["tree"], "size": ["taxonomy"], "s": ["size"], "l": ["size"]}, {"a": ["size"]}, {"sa": ["s", "a"]}, {"lb": ["l", "b"]})
    text = X.to_owl(t, {"a": {"Description": "<first> & one"}})
    assert X.parse_owl(text) == t and "DisjointUnion" in text and "&lt;first&gt; &amp; one" in text


def test_row_numbers_are_dense_over_many_partitions(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select("l_orderkey", "l_linenumber").repartition(7)
    n = df.count()
    for parts in (3, 40):
        out = S.dense_numbers(df, ["l_orderkey", "l_linenumber"], "k", parts)
        low, high, many = out.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first()
        assert (low, high, many) == (1, n, n)
    assert sorted(r["count"] for r in S.shards(df, 7, ["l_orderkey", "l_linenumber"]).groupBy("shard").count().collect()) == sorted(n // 7 + (i < n % 7) for i in range(7))
    assert S.dense_numbers(df.where("false"), ["l_orderkey"]).count() == 0


def test_label_lists_are_opened_once_a_row(spark):
    tree = X.Taxonomy({"place": ["taxonomy"], "west": ["place"], "east": ["place"], "other_place": ["place"], "size": ["taxonomy"], "small": ["size"], "no_size": ["size"]}, subsidiary={"west": ["size"]})
    df = spark.createDataFrame([(1, ["west"]), (2, ["west", "east"]), (3, ["west", "small"]), (4, []), (5, None), (6, ["east", "unknown"])], "k int, labels array<string>")
    out = X.multiplex(df, "labels", tree, "multiplex_without_merging", X.exclusion_defaults(tree))
    got = {r["k"]: (r["place"], r["place:west~size"]) for r in out.collect()}
    assert got == {1: ("west", "no_size"), 2: ("other_place", ""), 3: ("west", "small"), 4: ("other_place", ""), 5: ("other_place", ""), 6: ("east", "")}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("coalesce(labels") == 1

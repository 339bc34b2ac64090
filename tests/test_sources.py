"""Readers, exports read back, acquisition without a network, resumable updates, folds and figures on literal fixtures."""

import calendar
import csv
import json
import zipfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vellum.functions import predicates as P
from vellum.functions import text as T
from vellum.operators import aggregates as A
from vellum.operators import articles as R
from vellum.operators import figures as G
from vellum.operators import folds as O
from vellum.operators import labels as L
from vellum.operators import sequences as S
from vellum.operators import taxonomy as X
from vellum.plans.query import DatasetBuilder
from vellum.sources import acquisition as Q
from vellum.sources import exports as E
from vellum.sources import projections as J
from vellum.sources import readers as D
from vellum.streaming.updates import run_stage, stream_updates


def test_nested_readers_and_vertical_split(spark, tmp_path):
    schema = "pmcid string, title string, year string, abstract string, cases array<struct<case_id string, case_text string>>, case_images array<struct<case_id string, case_image_list array<struct<file string, tag string>>>>"
    rows = [("P1", "T", "2001", "ab", [("P1_01", "one"), ("P1_02", "two")], [("P1_01", [("f1", "t1"), ("f2", "t2")]), ("P1_02", [])]), ("P2", "U", "2002", None, [], [])]
    parts = J.vertical_split(spark.createDataFrame(rows, schema))
    assert set(parts) == {"metadata", "abstracts", "cases", "case_images"}
    for name, df in parts.items():
        df.write.parquet(str(tmp_path / name))
    assert {tuple(r) for r in D.read_articles(spark, str(tmp_path / "metadata")).select("pmcid", "title", "year").collect()} == {("P1", "T", "2001"), ("P2", "U", "2002")}
    assert {tuple(r) for r in D.read_cases(spark, str(tmp_path / "cases")).collect()} == {("P1_01", "one", "P1"), ("P1_02", "two", "P1")}
    assert {tuple(r) for r in D.read_case_images(spark, str(tmp_path / "case_images")).collect()} == {("P1", "P1_01", "f1", "t1"), ("P1", "P1_01", "f2", "t2")}


def test_csv_json_and_inventory_readers(spark, tmp_path):
    path = tmp_path / "captions.csv"
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([["main_image", "caption", "labels"], ["P1_01_x.jpg", 'a "quoted",\nline', "['ct', \"it's\"]"], ["P2_03_y.jpg", "c", "[unclosed"], ["P3_01_z.jpg", "d", ""]])
    got = {r["main_image"]: r for r in D.read_captions(spark, str(path), ("labels",)).collect()}
    assert got["P1_01_x.jpg"]["labels"] == ["ct", "it's"] and got["P1_01_x.jpg"]["case_id"] == "P1_01" and got["P1_01_x.jpg"]["pmcid"] == "P1"
    assert got["P2_03_y.jpg"]["labels"] == ["[unclosed"] and got["P1_01_x.jpg"]["caption"] == 'a "quoted",\nline'
    (tmp_path / "a.json").write_text('[{"k": 1}, {"k": 2}]')
    (tmp_path / "b.json").write_text('{"k": 3}\n{"k": 4}\n')
    assert [r["k"] for r in D.read_json(spark, str(tmp_path / "a.json"), lines=False).collect()] == [1, 2]
    assert [r["k"] for r in D.read_json(spark, str(tmp_path / "b.json")).collect()] == [3, 4]
    (tmp_path / "images/x").mkdir(parents=True)
    (tmp_path / "images/x/f.bin").write_bytes(b"12345")
    assert [(r["file"], r["file_size"]) for r in D.read_inventory(spark, str(tmp_path / "images")).collect()] == [("f.bin", 5)]
    assert D.search_string("a", ["b"], ["c"]) == '("a" OR "b") NOT "c"'


def test_list_cells(spark):
    cells = ["['a','b']", "plain", None, "[unclosed", "", "[]", "['a', None, 3]", '["x"]', "['it\\'s']", "[1 +]"]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in cells], "c string").select(T.parse_list_column(F.col("c"))).collect()]
    assert got == [["a", "b"], ["plain"], None, ["[unclosed"], [], [], ["a", "3"], ["x"], ["it's"], ["[1 +]"]]


def levels(spark, folder):
    articles = spark.createDataFrame([("PMC1", "T", "2001", ["k"]), ("PMC2", "U", "2001a", None)], "pmcid string, title string, year string, keywords array<string>")
    cases = spark.createDataFrame([("PMC1_01", "Female", 40, "See fig 1, fig 1a.", "PMC1"), ("PMC2_01", "Male", 50, "None.", "PMC2")], "case_id string, gender string, age int, case_text string, pmcid string")
    images = spark.createDataFrame([("PMC1_01", "PMC1", f"PMC1_f{i}.webp", f"{folder}/PMC1_f{i}.webp", part, m) for i, part, m in ((1, "undivided", ["fig 1"]), (2, "a", ["fig 1a"]), (3, "undivided", []))], "case_id string, pmcid string, file string, file_path string, image_component string, case_substring array<string>")
    return DatasetBuilder(articles, cases, images), images


def test_exports_are_read_back(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"PMC1_f{i}.webp").write_bytes(b"x" * i)
    builder, images = levels(spark, tmp_path)
    for kind in ("text", "image", "multimodal", "case_series"):
        out = str(tmp_path / kind)
        E.export(builder.query([], kind), out, kind, [], kind, all_images=images, copy_images=True)
        cited = json.load(open(f"{out}/case_report_citations.json"))
        about = json.load(open(f"{out}/article_metadata.json"))
        want = {"PMC1"} if kind in ("text", "case_series") else {"PMC1", "PMC2"}
        assert {r["pmcid"] for r in cited} == {r["pmcid"] for r in about} == want
        assert list(cited[0]) == J.CITATION and list(about[0]) == J.ARTICLE
        if kind != "image":
            cases = {r["case_id"]: r for r in spark.read.csv(f"{out}/cases.csv", header=True, quote='"', escape='"').collect()}
            assert cases["PMC1_01"]["case_text"] == ("See <PMC1_f1.webp>, <PMC1_f1.webp>a." if kind == "multimodal" else "See fig 1, fig 1a.")
        if kind == "case_series":
            assert (cases["PMC1_01"]["amount_of_images"], cases["PMC1_01"]["image_folder"]) == ("3", "images/PMC1/PMC1_/PMC1_01")
        if kind in ("image", "multimodal"):
            got = [json.loads(x) for p in sorted(Path(f"{out}/image_metadata.json").glob("part-*")) for x in open(p)]
            assert {(r["file"], r["split_during_preprocessing"]) for r in got} == {("PMC1_f1.webp", False), ("PMC1_f2.webp", True), ("PMC1_f3.webp", False)}
        if kind != "text":
            status = sorted(r["status"] for r in spark.read.parquet(f"{out}/image_status").collect())
            assert status == ["image-not-found", "ok", "ok"]
            assert Path(f"{out}/images/PMC1/PMC1_/" + ("PMC1_01/f2.webp" if kind == "case_series" else "PMC1_f2.webp")).read_bytes() == b"xx"
        assert "Dataset type: " + kind in open(f"{out}/readme.txt").read()
    E.write_json_array(builder.articles.where("false"), str(tmp_path / "none.json"))
    assert json.load(open(tmp_path / "none.json")) == []
    assert E.remove_leftovers(spark, str(tmp_path), ["none.json", "not there"]) == ["none.json"]


def test_image_tokens(spark):
    builder, images = levels(spark, "x")
    assert [r["case_text"] for r in J.with_image_tokens(builder.cases, images, token="[I]").orderBy("case_id").collect()] == ["See [I], [I]a.", "None."]


def test_search_plan():
    days = {}
    at = datetime(2019, 1, 1)
    while at.year < 2021:
        days[f"{at:%Y/%m/%d}"] = 2000 if at.month == 2 and at.year == 2020 else 12_000 if at == datetime(2020, 7, 1) else 3
        at += timedelta(1)
    ranges, over = Q.plan_searches(2019, 2020, lambda r: sum(n for d, n in days.items() if d.startswith(r)))
    assert ranges[0] == "2019" and "2020/01" in ranges and "2020/02/29" in ranges and "2020/02" not in ranges and over == ["2020/07/01"]
    found = [d for r in ranges for d in days if d.startswith(r)]
    assert sorted(found) == sorted(days) and len(ranges) == 1 + 10 + calendar.monthrange(2020, 2)[1] + 31


def test_versions_and_archives(tmp_path):
    assert Q.resolve_version("latest", ["1", "2"]) == "2" and Q.resolve_version("1", ["1", "2"]) == "1"
    for bad in ("3", "0"):
        with pytest.raises(ValueError):
            Q.resolve_version(bad, ["1", "2"], ["0"])
    with zipfile.ZipFile(tmp_path / "inner.zip", "w") as z:
        z.writestr("b.txt", "b")
    with zipfile.ZipFile(tmp_path / "outer.zip", "w") as z:
        z.writestr("a.txt", "a")
        z.write(tmp_path / "inner.zip", "in/inner.zip")
    assert [Path(p).name for p in Q.unpack_archive(str(tmp_path / "outer.zip"), str(tmp_path / "out"))] == ["a.txt", "b.txt"]
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("../c.txt", "c")
    with pytest.raises(ValueError, match="holds the name"):
        Q.unpack_archive(str(tmp_path / "bad.zip"), str(tmp_path / "out2"))


def test_citation_page_and_content(spark):
    html = """<meta name="citation_abstract_html_url" content="http://x/1"><h1 class="heading-title">
      A  <b>title</b></h1><a class="full-name" href="#">Ann A</a><a class="full-name">Bo B</a><a class="full-name">Ann A</a>
      <button class="journal-actions-trigger trigger">J Med</button><span class="cit">2020 Jan;1(2)</span>
      <button class="keyword-actions-trigger trigger keyword-link major">Heart*</button><button class="keyword-actions-trigger trigger keyword-link">Lung</button>
      <div class="abstract-content selected"><p>Some text.</p></div><p><strong class="sub-title">Keywords: </strong>One; Two.</p>"""
    one = spark.createDataFrame([(html,), ("<p>none</p>",)], "h string").select(Q.citation_html(F.col("h")).alias("m")).select("m.*").collect()
    got = one[0].asDict()
    assert got == {"title": "A title", "authors": ["Ann A", "Bo B"], "journal": "J Med", "journal_detail": "2020 Jan;1(2)", "year": "2020", "mesh_terms": ["Heart", "Lung"], "major_mesh_terms": ["Heart"], "keywords": ["one", "two"], "abstract": "Some text.", "link": "http://x/1"}
    assert one[1]["title"] is None and one[1]["authors"] == []
    metadata = spark.createDataFrame([("P1", ["k"]), ("P2", []), ("P3", None)], "pmcid string, keywords array<string>")
    content = spark.createDataFrame([(p, ["z"], "MIT") for p in ("P1", "P2", "P3")], "pmcid string, keywords array<string>, license string")
    assert {tuple(map(str, r)) for r in Q.join_content(metadata, content).select("pmcid", "keywords", "license").collect()} == {("P1", "['k']", "MIT"), ("P2", "['z']", "MIT"), ("P3", "['z']", "MIT")}


def test_ages_and_genders(spark):
    cases = [("A one hundred year old man.", 100, "Male"), ("one hundred and five-year-old lady", 105, "Female"), ("aged twenty one", 21, "Unknown"), ("A female-to-male patient", None, "Transgender"), ("An MTF patient, aged 30", 30, "Transgender"), ("Seen. MTF was noted. She left", None, "Female"), ("a 45 yo f with", 45, "Female"), ("Herself", None, "Female"), ("The mister and the mistress", None, "Female"), ("A cushion", None, "Unknown"), (None, None, "Unknown"), ("a 140-year-old", None, "Unknown"), ("twenty-one-year-old boys", 21, "Male")]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    got = {r["i"]: (r["a"], r["g"]) for r in df.select("i", T.extract_age(F.col("t")).alias("a"), T.extract_gender(F.col("t")).alias("g")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[1:] for c in cases]


def test_predicates_with_odd_values(spark):
    df = spark.createDataFrame([("2000",), ("2001a",), (None,), ("1999",)], "y string")
    assert [r["y"] for r in df.where(P.at_least(F.col("y"), [2000])).collect()] == ["2000"]
    assert df.where(P.whitelisted(F.col("y"), [])).count() == 4 and df.where(P.member(F.col("y"), [])).count() == 0


def test_labels_of_rows_that_share_a_key(spark):
    d = spark.createDataFrame([(1, "lung", "Body", None), (2, "mass", "Old", None), (3, "Mass", "Finding", "More"), (4, "none", None, "")], "place int, ngram string, label_a string, Label_b string")
    assert {r["ngram"]: r["labels"] for r in L.annotations(d, "place").collect()} == {"lung": ["Body"], "mass": ["Finding", "More"]}
    t = spark.createDataFrame([(1, "a lung"), (1, "a mass"), (1, "a mass"), (2, None)], "id int, text string")
    got = sorted((r["id"], r["label_list"]) for r in L.label_captions(t, "id", "text", d, "place").collect())
    assert got == [(1, ["Body"]), (1, ["Finding", "More"]), (1, ["Finding", "More"]), (2, [])]


def test_folds_keep_groups_and_balance_labels(spark):
    rows = [(g, f"l{g % 3}", k) for g in range(300) for k in range(1 + g % 4)]
    df = spark.createDataFrame(rows, "g int, l string, k int")
    out = O.stratified_group_folds(df, "g", "l").collect()
    folds = {}
    for r in out:
        assert folds.setdefault(r["g"], r["fold"]) == r["fold"] and r["is_valid"] == (r["fold"] < 2)
    assert len(out) == len(rows)
    for label in range(3):
        many = [sum(f == fold and g % 3 == label for g, f in folds.items()) for fold in range(10)]
        assert max(many) - min(many) <= 1 and sum(many) == 100
    ids = spark.createDataFrame([(i % 50,) for i in range(100)], "i int")
    first = [r["i"] for r in O.shuffled(ids, "i", 3).collect()]
    assert sorted(first) == list(range(50)) and first != sorted(first) and first == [r["i"] for r in O.shuffled(ids.repartition(7), "i", 3).collect()]


def test_figures(spark):
    df = spark.createDataFrame([([",", "a", "b c"], [[1, 4], [], [2]])], "r array<string>, n array<array<int>>")
    assert tuple(df.select(G.clean_references(F.col("r")), G.highest_figure(F.col("n"))).first()) == (["a"], 4)
    images = spark.createDataFrame([("i", [("fig 1a", ["a", "b"]), ("fig 1", [])])], "image string, m array<struct<mention string, letters array<string>>>")
    mentions = G.mention_rows(images, "image", "m")
    assert {tuple(r) for r in mentions.collect()} == {("i", "a", "fig 1a"), ("i", "b", "fig 1a"), ("i", "undivided", "fig 1")}
    files = spark.createDataFrame([("i", "a"), ("i", "undivided"), ("j", "a")], "image string, image_component string")
    got = {(r["image"], r["image_component"]): r["case_substring"] for r in G.join_figure_references(files, mentions, "image").collect()}
    assert got == {("i", "a"): ["fig 1", "fig 1a"], ("i", "undivided"): ["fig 1"], ("j", "a"): []}
    s = spark.createDataFrame([(["Fig. 1 and 2", "Fig. 2"],), (["Fig. 1", "Fig. 2"],), (["x"],)], "m array<string>")
    assert [r[0] for r in s.select(T.compatible_mentions(F.col("m"))).collect()] == [["Fig. 1 and 2", "Fig. 2"], [], ["x"]]


def test_sessions_by_the_first_rule_that_holds(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "case"), ("a", 3, "y"), ("b", 1, "x"), ("b", 2, "old"), ("b", 3, "old"), ("c", 1, "x")], "g string, o int, t string")
    out = S.sessions_first_rule(df, "g", "o", [F.col("t") == "case", F.col("t") == "old"]).collect()
    assert {(r["g"], r["o"], r["session"]) for r in out} == {("a", 2, 1), ("a", 3, 1), ("b", 2, 1), ("b", 3, 2)}


def test_captions_of_articles_with_cases(spark):
    df = spark.createDataFrame([([], ["a"]), (["x"], ["a"]), (None, ["a"])], "c array<string>, t array<string>")
    assert [r[0] for r in df.select(R.captions_with_cases(F.col("c"), F.col("t"))).collect()] == [[], ["a"], []]


def test_aggregates(spark):
    df = spark.createDataFrame([("k", "m2", "f3", 3), ("k", "m1", "f1", 1), ("k", "m1", "f2", 2)], "k string, m string, f string, o int")
    got = A.merged_maps(df, "k", "m", "f", F.col("o")).first()
    assert [(e["k"], e["v"]) for e in got["entries"]] == [("m1", ["f1", "f2"]), ("m2", ["f3"])]
    assert {r["label"]: r["amount"] for r in A.label_counts(spark.createDataFrame([(["a", "b"],), (["a"],)], "l array<string>"), "l").collect()} == {"a": 2, "b": 1}


def test_taxonomy_tables(spark):
    t = X.Taxonomy({"tree": ["taxonomy"], "a": ["tree"], "b": ["tree"], "size": ["taxonomy"], "s": ["size"], "l": ["size"]}, {"a": ["size"]})
    notes = {"a": {"SNOMED_ID": "12", "Description": "one"}, "s": {"Synonym": "small"}}
    assert X.parse_notes(X.to_owl(t, notes)) == notes
    cm = X.dimensions(spark, t)["class_map"]
    got = {r["class_name"]: (r["SNOMED_ID"], r["Synonym"]) for r in X.with_properties(cm, X.property_table(spark, notes)).collect()}
    assert got["a"] == ("12", None) and got["s"] == (None, "small") and got["b"] == (None, None)
    assert {r["class_name"]: r["subsidiary"] for r in X.subsidiary_flags(cm).collect()}["a"] is False
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "s"])], "k int, l array<string>")
    assert [(r["k"], r["parent_class"], r["n"]) for r in X.disjoint_violations(rows, "k", "l", cm).collect()] == [(1, "tree", 2)]
    assert rows.select(*X.multiclass_columns(F.col("l"), {"x": ["a", "b"], "y": ["s"]})).collect() == [("b", ""), ("a", "s")]
    packed = X.multiplex(rows, "l", t, "multiplex", merged={"all": ["tree", "tree:a~size"]}).collect()
    assert {r["k"]: r["all"] for r in packed} == {1: [], 2: ["a", "s"]}


def test_inference_by_levels(spark):
    df = spark.createDataFrame([(1, [0.2, 0.8], [0.5, 0.5]), (2, [0.9, 0.1], [0.1, 0.9])], "k int, p array<double>, q array<double>")
    models = {"t": (None, None, X.argmax_label(F.col("p"), ["a", "b"])), "t:b": ("t", "b", X.argmax_label(F.col("q"), ["c", "d"]))}
    got = {r["k"]: (r["t"], r["t:b"]) for r in X.hierarchical_inference(df, models).collect()}
    assert got == {1: ("b", "c"), 2: ("a", None)} and X.parent_model("t:b.c") == "t:b" and X.parent_model("t") == ""


def test_resumable_stage_and_stream(spark, tmp_path):
    asked = []

    def stage(df):
        asked.append(df.count())
        return df.withColumn("done", F.lit(True))

    source = spark.range(10).withColumnRenamed("id", "k")
    for df, n in ((source.where("k < 6"), 6), (source, 10), (source, 10)):
        assert run_stage(spark, df, str(tmp_path / "stage"), "k", stage).count() == n
    assert asked == [6, 4, 0]
    source.unionByName(source).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long").parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream_updates(stream, str(tmp_path / "out"), "k", str(tmp_path / "check")).awaitTermination(120)
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(10))

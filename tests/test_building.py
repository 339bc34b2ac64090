"""Articles parsed to cases, labels of long phrases, prefix sums, draws, closures, inference, exports and stages, on literal fixtures."""

import csv
import json
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.functions.captions import segment
from vellum.operators import articles as R
from vellum.operators import folds as O
from vellum.operators import inference as M
from vellum.operators import labels as L
from vellum.operators import sequences as S
from vellum.operators import taxonomy as X
from vellum.plans.build import build_dataset
from vellum.plans.query import DatasetBuilder
from vellum.sources import acquisition as Q
from vellum.sources import exports as E
from vellum.sources.search import SearchSource, search_ids
from vellum.streaming import updates as U


def passage(text=None, **infons):
    tags = "".join(f'<infon key="{k}">{v}</infon>' for k, v in infons.items())
    return f"<passage>{tags}{'' if text is None else f'<text>{text}</text>'}</passage>"


def article(number, *passages, title="A case"):
    return f"<collection><document><id>{number}</id>{passage(title, section_type='TITLE', type='front', license='MIT')}{''.join(passages)}</document></collection>"


def test_missing_fields_shift_nothing_and_bad_articles_are_rows(spark):
    xml = article(1, passage("Intro &amp; more", type="paragraph"), passage("The Case", type="title_2"), passage("one", type="paragraph", section_type="CASE"), passage(type="paragraph", section_type="INTRO"), passage("S1", type="fig_caption", id="F1"), passage("S2", type="fig", id="x"), passage("S3", type="fig_title_caption", file="f3.jpg", id="F3"), passage(type="ref", kwd="a, b"))
    rows = spark.createDataFrame([(1, xml), (2, xml[:-9]), (3, "no xml"), (4, None), (5, "<other/>")], "k int, x string").select("k", Q.article_xml(F.col("x")).alias("a")).orderBy("k").collect()
    a = rows[0]["a"]
    assert (a["pmcid"], a["title"], a["license"], a["keywords"], a["error"]) == ("PMC1", "A case", "MIT", ["a", "b"], None)
    assert [tuple(s) for s in a["sections"]] == [(None, None, 0, "Intro & more"), ("CASE", "The Case", 1, "one"), ("INTRO", "The Case", 1, None)]
    assert [tuple(c) for c in a["captions"]] == [("F1", None, "S1", 1), ("F3", "f3.jpg", "S3", 2)]
    assert [r["a"] is not None and r["a"]["error"] is not None for r in rows] == [False, True, True, False, True]
    assert rows[1]["a"]["sections"] is None and rows[3]["a"]["pmcid"] is None


def test_paragraphs_become_cases(spark):
    cases = [
        (["x", "A 40-year-old man", "went on", "A 3 day old girl"], ["A 40-year-old man\nwent on", "A 3 day old girl"]),
        (["A woman came", "then", "her boy, aged"], ["A woman came\nthen", "her boy, aged"]),
        (["A man is here", "of 5 years old", "end"], ["of 5 years old\nend"]),
        (["none"], []), ([], []), ([None, "the patient slept"], ["the patient slept"]), (None, None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, p array<string>")
    got = {r["i"]: r["c"] for r in df.select("i", R.merge_paragraphs(F.col("p")).alias("c")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[1] for c in cases]
    text = "a 30 year old one"
    sections = [
        ([("CASE", None, 0, text), ("INTRO", "case", 1, text + " b")], [text]),
        ([("INTRO", "Case 1", 1, "A man came"), ("INTRO", "Case 1", 1, "more"), ("INTRO", "Case 2", 2, "A girl came"), ("INTRO", "End", 3, text)], ["A man came\nmore", "A girl came"]),
        ([("ABSTRACT", None, 0, text), ("RESULTS", "x", 1, text), ("RESULTS", "x", 1, "more"), ("INTRO", "x", 1, "other")], [text + "\nmore"]),
        ([("ABSTRACT", None, 0, text)], []), (None, []),
    ]
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(sections)], "i int, s array<struct<kind string, title string, title_number int, text string>>")
    got = {r["i"]: r["c"] for r in df.select("i", R.article_cases(F.col("s")).alias("c")).collect()}
    assert [got[i] for i in range(len(sections))] == [s[1] for s in sections]


def test_paragraphs_without_text_choose_no_cases(spark):
    text = "a 30 year old one"
    sections = [
        ([("CASE", None, 0, None), ("INTRO", "x", 1, text)], [text]),
        ([("INTRO", "Case 1", 1, None), ("INTRO", "x", 2, text)], [text]),
        ([("INTRO", "Case 1", 1, "A man came"), ("INTRO", "Case 2", 2, None), ("INTRO", "Case 3", 3, "more")], ["A man came\nmore"]),
        ([("CASE", "x", 0, None)], []),
    ]
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(sections)], "i int, s array<struct<kind string, title string, title_number int, text string>>")
    rows = {r["i"]: r for r in df.select("i", R.article_cases(F.col("s")).alias("c"), R.case_paragraphs(F.col("s")).alias("p")).collect()}
    assert [rows[i]["c"] for i in range(len(sections))] == [s[1] for s in sections]
    assert [rows[i]["p"] for i in range(len(sections))] == [[text], [text], ["A man came", "more"], []]


def test_captions_of_a_file_are_one(spark):
    df = spark.createDataFrame([([("F1", "a", " x", 1), ("F2", None, "y", 2), ("F3", "a", "z", 3), ("F4", None, "w", 4)],)], "c array<struct<tag string, file string, caption string, caption_order int>>")
    got = df.select(R.one_caption_a_file(F.col("c"))).first()[0]
    assert [tuple(c) for c in got] == [("F1", "a", "x. z", 1), ("F2", None, "y", 2), ("F4", None, "w", 3)]


def test_a_dataset_is_built_and_resumed(spark, tmp_path, monkeypatch):
    figures = [passage("Scan. a Chest X-ray. b Abdominal CT.", type="fig_caption", id="F1", file="p1.jpg"), passage("A lone scan", type="fig_caption", id="F3", file="p3.jpg")]
    one = article(1, passage("A 40-year-old man, see Fig. 1.", type="paragraph", section_type="CASE"), passage("A 5-day-old girl, see Fig. 3.", type="paragraph", section_type="CASE"), *figures)
    two = article(2, passage("A 9-year-old boy, see Fig. 1.", type="paragraph", section_type="CASE"), *figures)
    review = article(3, passage("A 9-year-old boy", type="paragraph", section_type="CASE"), *figures, title="A review")
    source = spark.createDataFrame([("1", one), ("2", two), ("3", review), ("4", "broken")], "pmcid string, xml string")
    folder = str(tmp_path / "set")
    build_dataset(spark, source.where("pmcid < '2'"), folder)
    # A run breaks off behind the first stage: its table is whole, the others are as they were.
    import vellum.plans.build as B

    with monkeypatch.context() as m:
        m.setattr(B, "cases_of", lambda *a: spark.range(1).select(F.raise_error(F.lit("lost")).alias("article")))
        with pytest.raises(Exception, match="lost"):
            build_dataset(spark, source, folder)
    assert U.read_table(spark, f"{folder}/content").count() == 4 and U.read_table(spark, f"{folder}/cases").count() == 1
    assert U.sweep(spark, f"{folder}/cases") == 1 and U.sweep(spark, f"{folder}/cases") == 0
    built = build_dataset(spark, source, folder)
    assert {r["article"]: r["error"] is not None for r in built.articles.collect()} == {"1": False, "2": False, "3": False, "4": True}
    assert {(r["case_id"], r["gender"], r["age"]) for r in built.cases.collect()} == {("PMC1_01", "Male", 40), ("PMC1_02", "Female", 0), ("PMC2_01", "Male", 9)}
    got = {(r["case_id"], r["file"], r["image_component"], r["caption"]) for r in built.parts.collect()}
    # Two captions but a third figure: tags tell the numbers of article 1.
    assert got == {("PMC1_01", "p1.jpg", "a", "Scan. Chest X-ray."), ("PMC1_01", "p1.jpg", "b", "Scan. Abdominal CT."), ("PMC1_02", "p3.jpg", "undivided", "A lone scan."), ("PMC2_01", "p1.jpg", "a", "Scan. Chest X-ray."), ("PMC2_01", "p1.jpg", "b", "Scan. Abdominal CT.")}
    parts = {s: U.published_parts(spark, f"{folder}/{s}") for s in ("content", "cases", "parts")}
    build_dataset(spark, source, folder)
    assert parts == {s: U.published_parts(spark, f"{folder}/{s}") for s in parts}


def test_phrases_of_any_length_and_boundaries_of_the_corpus(spark):
    words = [f"w{i}" for i in range(12)]
    d = spark.createDataFrame([(" ".join(words), ["long"]), ("w0", ["short"]), ("w0 w1 w2", ["middle"]), ("x-ray", ["scan"]), ("ray", ["fish"])], "ngram string, labels array<string>")
    texts = [(1, " ".join(words)), (2, " ".join(words[:11])), (3, "w0, w1 w2"), (4, "an X-Ray."), (5, "ray (x-ray)"), (6, None), (7, ""), (8, "w0 " + " ".join(words) + " w0 w1 w2")]
    df = spark.createDataFrame(texts, "id int, text string")
    got = {r["id"]: r["label_list"] for r in L.label_texts(df, "id", "text", d).collect()}
    assert got == {1: ["long"], 2: ["middle"], 3: ["short"], 4: ["scan"], 5: ["fish", "scan"], 6: [], 7: [], 8: ["long", "middle", "short"]}
    # A hyphen parts words only where no phrase begins or ends with it and it is named a boundary.
    assert L.corpus_boundaries(df.where("text is not null"), "text", d) == "(),-."
    cut = {r["id"]: r["label_list"] for r in L.label_texts(df, "id", "text", d.where("ngram <> 'x-ray'"), boundaries="(),-.").collect()}
    assert cut[4] == ["fish"] and cut[3] == ["short"]
    assert L.label_texts(df, "id", "text", d.limit(0)).where("size(label_list) > 0").count() == 0


def test_prefix_sums_over_any_partitions(spark):
    rows = [(g, i, (i * 7) % 5) for g, n in (("hot", 900), ("b", 3), (None, 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, x int")
    want, total = {}, Counter()
    for g, i, x in rows:
        want[g, i], total[g] = total[g], total[g] + x
    for parts in (1, 13):
        got = S.prefix_sums(df.repartition(5), ["g"], ["i"], "x", parts=parts).collect()
        assert {(r["g"], r["i"]): r["before"] for r in got} == want and all(r["total"] == total[r["g"]] for r in got)


def test_folds_are_balanced_by_rows(spark):
    # A label of most rows, groups of very different sizes.
    rows = [(g, "hot" if g % 10 else "rare") for g in range(400) for _ in range(1 + (g * g) % 37)]
    out = O.stratified_group_folds(spark.createDataFrame(rows, "g int, l string"), "g", "l", folds=5).collect()
    fold, n = {r["g"]: r["fold"] for r in out}, Counter((r["l"], r["fold"]) for r in out)
    assert len(out) == len(rows) and len({(r["g"], r["fold"]) for r in out}) == 400 and len(set(fold.values())) == 5
    for label in ("hot", "rare"):
        sizes = [n[label, f] for f in range(5)]
        assert max(sizes) - min(sizes) <= 2 * 37, sizes


def test_draws_are_exact_and_the_same_for_any_partitioning(spark):
    rows = [(i, w) for i, w in enumerate([1.0, 3.0, 0.5, 0.0, None, float("nan"), -1.0, float("inf"), *[0.25] * 200])]
    df = spark.createDataFrame(rows, "i int, w double")
    draws = [{r["i"]: r["copies"] for r in O.weighted_draw(df.repartition(n), ["i"], "w", 1000, seed=4).collect()} for n in (1, 7)]
    assert draws[0] == draws[1] and sum(draws[0].values()) == 1000
    total = 4.5 + 50
    for i, w in rows:
        expected = 1000 * w / total if w is not None and 0 < w < float("inf") else 0
        assert abs(draws[0].get(i, 0) - expected) < 1.001, (i, w)
    assert O.drawn_rows(O.weighted_draw(df, ["i"], "w", 1000, seed=4)).count() == 1000
    assert draws[0] != {r["i"]: r["copies"] for r in O.weighted_draw(df, ["i"], "w", 1000, seed=5).collect()}
    assert O.weighted_draw(df.where("w < 0"), ["i"], "w", 10).count() == 0


def test_closure_and_errors_of_edges(spark):
    edges = [("t", "root"), ("e", "root"), ("a", "t"), ("b", "t"), ("c", "a"), ("x", "y"), ("y", "x"), ("b", "a"), ("a", "t"), (None, "t"), ("q", None)]
    df = spark.createDataFrame(edges, "child string, parent string")
    got = {(r["class"], r["ancestor"]): r["distance"] for r in X.subclass_closure(df).collect()}
    assert got == {("t", "root"): 1, ("e", "root"): 1, ("a", "t"): 1, ("b", "t"): 1, ("c", "a"): 1, ("x", "y"): 1, ("y", "x"): 1, ("b", "a"): 1, ("a", "root"): 2, ("b", "root"): 2, ("c", "t"): 2, ("c", "root"): 3, ("x", "x"): 2, ("y", "y"): 2}
    assert {tuple(r) for r in X.taxonomy_errors(df, "root").collect()} == {("several parents", "b"), ("recursion", "x"), ("recursion", "y"), ("empty tree", "e"), ("single child", "x"), ("single child", "y"), ("repeated edge", "a")}
    assert X.subclass_closure(df.limit(0)).collect() == []


def test_exclusion_defaults_come_from_names():
    t = X.Taxonomy({"place": ["taxonomy"], "west": ["place"], "no_place": ["place"], "other_place": ["place"], "nw": ["west"], "other_west": ["west"], "size": ["taxonomy"], "big": ["size"], "no_size": ["size"]}, {"west": ["size"]})
    assert X.exclusion_defaults(t) == {"place": ("", "no_place"), "place:west": ("west", "other_west"), "place:west~size": ("west", "no_size")}
    assert X.exclusion_defaults(t, ["big"]) == {"place:west~size": ("west", "big")}


def test_levels_are_scored_once(spark, tmp_path):
    rng = np.random.default_rng(1)
    means = {"a": np.zeros(3), "b": np.full(3, 4.0)}
    inner = {"b1": np.full(3, 3.0), "b2": np.full(3, 5.0)}
    rows = [(i, [float(x) for x in rng.normal(4 * (i % 2), 1, 3)]) for i in range(50)] + [(50, None), (51, [1.0, None, 2.0]), (52, [1.0, float("nan"), 2.0])]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    asked = []

    def counted(loader):
        def load():
            predict = loader()
            return lambda x: (Path(tmp_path / f"asked-{len(x)}-{rng.integers(1 << 40)}").touch(), predict(x))[1]

        return load

    tasks = {"t:b": M.Task(counted(M.nearest_centroid(inner)), "t", "b"), "t": M.Task(M.nearest_centroid(means))}
    path = str(tmp_path / "scores")
    first = {r["k"]: (r["t"], r["t:b"]) for r in M.score_new(df.where("k < 30"), path, "k", "v", tasks, 3).collect()}
    asked = len(list(tmp_path.glob("asked-*")))
    second = {r["k"]: (r["t"], r["t:b"]) for r in M.score_new(df, path, "k", "v", tasks, 3).collect()}
    assert len(first) == 30 and {k: second[k] for k in first} == first and len(second) == 53
    more = len(list(tmp_path.glob("asked-*")))
    M.score_new(df, path, "k", "v", tasks, 3)
    assert asked > 0 and len(list(tmp_path.glob("asked-*"))) == more
    for k, v in rows:
        if k < 50:
            top = min(means, key=lambda c: (((np.array(v) - means[c]) ** 2).sum(), c))
            assert second[k] == (top, min(inner, key=lambda c: (((np.array(v) - inner[c]) ** 2).sum(), c)) if top == "b" else None)
        else:
            assert second[k] == (None, None)
    with pytest.raises(ValueError):
        M.score_levels(df, "k", "v", {"x": M.Task(None, "y", "z")})


def test_classification_export_is_read_back(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"PMC1_f{i}.webp").write_bytes(b"x" * (i + 1))
    articles = spark.createDataFrame([("PMC1", "T")], "pmcid string, title string")
    cases = spark.createDataFrame([("PMC1_01", "Female", 40, "text", "PMC1")], "case_id string, gender string, age int, case_text string, pmcid string")
    images = spark.createDataFrame([("PMC1_01", "PMC1", f"file_{i}", f"PMC1_f{i}.webp", str(tmp_path / f"PMC1_f{i}.webp"), "undivided", c, f"type{i}") for i, c in enumerate(["a ct scan", "an mri", "ct and mri", "a photo"])], "case_id string, pmcid string, file_id string, file string, file_path string, image_component string, caption string, image_type string")
    builder = DatasetBuilder(articles, cases, images)
    classes = {c: [{"field": "caption", "string_list": [c]}] for c in ("ct", "mri")}
    for keep in (False, True):
        name = f"set{keep}"
        E.export_classification(builder, str(tmp_path), name, [{"field": "gender", "string_list": ["female"]}], classes, keep_label_columns=keep, version="3", copy_images=True)
        rows = [r for p in Path(tmp_path / name / f"{name}.csv").glob("part-*.csv") for r in csv.DictReader(open(p))]
        assert {(r["file_id"], r["file"], r["class"]) for r in rows} == {("file_0", "PMC1_f0.webp", "ct"), ("file_1", "PMC1_f1.webp", "mri")}
        assert list(rows[0])[:4] == ["file_id", "file", "file_path", "class"] and len(rows[0]) == (11 if keep else 4)
        assert all(Path(r["file_path"]).read_bytes() for r in rows) and (not keep or {r["image_type"] for r in rows} == {"type0", "type1"})
        about = open(tmp_path / name / "readme.txt").read()
        assert "image classification" in about and "Version: 3" in about and "'class': 'mri'" in about
        listed = [json.loads(x)["file"] for p in Path(tmp_path / f"{name}_ct" / "image_metadata.json").glob("part-*") for x in open(p)]
        assert sorted(listed) == ["PMC1_f0.webp", "PMC1_f2.webp"]
    with pytest.raises(ValueError, match="exists"):
        E.export_classification(builder, str(tmp_path), "setTrue", [], classes)


def test_search_is_read_by_ranges(spark, tmp_path):
    days = {"2019/03/01": 3, "2019/05/02": 2, "2020/01/01": 6, "2020/01/02": 1, "2020/07/09": 3}
    for day, n in days.items():
        path = tmp_path / f"{day}.txt"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(f"{day}-{i}\n" for i in range(n)))
    df = search_ids(spark, 2018, 2020, folder=str(tmp_path), limit="6")
    rows = df.collect()
    assert sorted(r["id"] for r in rows) == sorted(f"{d}-{i}" for d, n in days.items() for i in range(n))
    assert {r["dates"] for r in rows} == {"2019", "2020/01/01", "2020/01/02", "2020/07"}
    assert {r["dates"] for r in search_ids(spark, 2018, 2020, folder=str(tmp_path), limit="5").where("over").collect()} == {"2020/01/01"}
    # 2018 and 2019 whole, eleven months, 31 days.
    assert df.rdd.getNumPartitions() == 2 + 11 + 31 and SearchSource.name() == "vellum_search"


def test_captions_with_bare_letters_and_further_places():
    assert segment("a Chest X-ray. b Abdominal CT.") == [{"reference": "a", "caption": "Chest X-ray."}, {"reference": "b", "caption": "Abdominal CT."}]
    assert segment("B MRI of it. C CT of it.") == [{"reference": "B", "caption": "MRI of it."}, {"reference": "C", "caption": "CT of it."}]
    assert segment("a MRI of it.")[0]["reference"] == "undivided" and segment("A Chest radiograph.") == [{"reference": "undivided", "caption": "A Chest radiograph."}]
    assert [p["reference"] for p in segment("Above: a mass. Below: a cyst. Centre: none.")] == ["above", "below", "centre"]


def test_pages_with_nested_elements_and_any_order_of_attributes():
    html = '<meta content="u" name="citation_abstract_html_url"><div class="abstract-content selected" id="a"><div>One</div><div>two &amp; three</div></div><h1 id="x" class="big heading-title">T <i>t</i></h1><button class="keyword-link">Lung</button><div class="abstract-content">other</div>'
    got = Q.citation_page(html)
    assert got["abstract"].split() == ["Onetwo", "&", "three"] and got["link"] == "u" and got["title"] == "T t" and got["mesh_terms"] == ["Lung"] and got["major_mesh_terms"] == []
    assert Q.citation_page(None)["title"] is None and Q.citation_page("<h1 class=heading-title>open")["title"] is None


def test_pages_are_parsed_in_bounded_blocks():
    import pyarrow as pa

    page = '<h1 class="heading-title">T %d</h1><p>' + "x" * 300_000 + "</p>"
    pages = [page % i for i in range(9)] + [None, ""]
    blocks = list(Q.citation_html.func(iter([pa.array(pages, pa.string()).slice(1), pa.array([], pa.string())])))
    assert max(map(len, blocks)) <= 5 and len(blocks) >= 3
    assert [x["title"] for b in blocks for x in b.to_pylist()] == [f"T {i}" for i in range(1, 9)] + [None, None]


def test_ambiguous_files_are_dropped_in_one_shuffle(spark):
    from vellum.operators.harmonize import class_subsets

    a = spark.createDataFrame([("x", 1), ("y", None), (None, 3), ("v", 7), ("v", 8)], "file string, n int")
    b = spark.createDataFrame([("y", 4), ("z", 5)], "file string, n int")
    out = class_subsets({"a": a, "b": b}, "file")
    assert out.columns == ["file", "n", "class"] and sorted(map(tuple, out.collect())) == [("x", 1, "a"), ("z", 5, "b")]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()

"""Operators 11 to 13 against brute force, held-out labels and edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from vellum.llm import funnels, spelling, toxicity
from vellum.llm.queries import ORACLE_SQL, QUERIES

DAY = datetime(2024, 3, 31, 1, 58)


def naive_funnels(rows, fs, limit):
    """Each attempt walked through its client's events, one by one."""
    by = defaultdict(lambda: defaultdict(set))
    for c, k, t in rows:
        if c is not None and k is not None and t is not None:
            by[c][k].add(t)
    out = {}
    for f in fs:
        for c, kinds in by.items():
            times, n = [[] for _ in f.steps], [0] * len(f.steps)
            for t1 in kinds[f.steps[0]]:
                at, n[0] = t1, n[0] + 1
                for k, kind in enumerate(f.steps[1:], start=1):
                    later = [t for t in kinds[kind] if t > at]
                    if not later or min(later) > t1 + limit or any(at < x <= min(later) for x in kinds[f.excluded]):
                        break
                    times[k].append(min(later) - at)
                    at, n[k] = min(later), n[k] + 1
            if n[0]:
                smallest = [sorted(x)[-(-25 * len(x) // 100) - 1] if x else None for x in times[1:]]
                out[f.name, c] = (*n, max(i + 1 for i, x in enumerate(n) if x), *smallest)
    depth = Counter((f, v[len(fs[0].steps)]) for (f, _), v in out.items())
    return {k: (*v, depth[k[0], v[len(fs[0].steps)]]) for k, v in out.items()}


def micro(t):
    return None if t is None else round((t - datetime(1970, 1, 1)) / timedelta(microseconds=1))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_funnels_against_brute_force(spark, kind):
    rng = random.Random(3)
    kinds = ["view", "view", "click", "click", "purchase", "signup", "error", "other", None]
    # One client has most rows; steps of 20 s make ties, and some times lie exactly at the limit or one microsecond beyond.
    rows = [(0 if rng.random() < 0.6 else rng.choice([1, 2, None]), rng.choice(kinds), DAY + timedelta(seconds=20 * rng.randrange(400), microseconds=rng.choice([0, 0, 1]))) for _ in range(900)]
    rows += rows[:100] + [(5, "view", None), (6, "view", DAY), (7, "click", DAY), (7, "click", DAY + timedelta(minutes=5)), (8, "click", DAY), (8, "click", DAY + timedelta(minutes=5, microseconds=1))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "client_id bigint, kind string, arrived_at timestamp_ntz, pair string, t int").withColumn("arrived_at", funnels.F.col("arrived_at").cast(kind))
    got = {(r[0], r[1]): tuple(r)[2:] for r in funnels.funnel_counts(df).collect()}
    assert got == naive_funnels([(c, k, micro(t)) for c, k, t in rows], funnels.FUNNELS, 300_000_000)
    assert got["C", 7][:2] == (2, 1) and got["C", 8][:2] == (2, 0)


def test_funnels_of_other_lengths_and_other_zones(spark):
    rows = [(1, "a", DAY), (1, "b", DAY + timedelta(seconds=1)), (1, "c", DAY + timedelta(minutes=3)), (2, "b", DAY)]
    fs = (funnels.Funnel("long", ("a", "b", "c")), funnels.Funnel("short", ("b", "a"), "c"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # This zone skips the hour in which the rows lie.
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = spark.createDataFrame(rows, "client_id bigint, kind string, arrived_at timestamp_ntz")
        got = {(r["funnel"], r["client_id"]): r for r in funnels.funnel_counts(df, fs).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got["long", 1][2:] == (1, 1, 1, 3, 1_000_000, 179_000_000, 1)
    assert got["short", 1][2:] == (1, 0, 0, 1, None, None, 2) and set(got) == {("long", 1), ("short", 1), ("short", 2)}


def test_funnels_without_rows(spark):
    none = spark.createDataFrame([], "client_id bigint, kind string, arrived_at timestamp")
    assert funnels.funnel_counts(none).collect() == []
    assert funnels.funnel_counts(spark.createDataFrame([(None, "view", DAY), (1, None, DAY)], "client_id bigint, kind string, arrived_at timestamp")).collect() == []


def test_funnel_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW clicks AS SELECT * FROM '{sf}/clicks.parquet'")
    want = con.execute(ORACLE_SQL["op13_funnels"])
    columns = [d[0] for d in want.description]
    df = QUERIES["op13_funnels"](spark, sf)
    assert sorted(df.columns) == sorted(columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, df.select(*columns).collect()), key=key) == sorted(want.fetchall(), key=key)


def all_neighbours(word, alphabet):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))} | {word[:i] + a + word[i + 1 :] for i in range(len(word)) for a in alphabet}
    return (out | {word[:i] + a + word[i:] for i in range(len(word) + 1) for a in alphabet}) - {word}


@pytest.mark.parametrize("at_a_time", [400_000, 40])
def test_neighbourhoods_are_whole_and_distinct(at_a_time):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abç") for _ in range(rng.randint(1, 6))) for _ in range(300)})
    full = np.full(1 << 10, -1, np.int64)
    got = Counter(spelling.neighbours(words, "abç", full, 16, at_a_time))
    assert set(got) == {(i, c) for i, w in enumerate(words) for c in all_neighbours(w, "abç")} and max(got.values()) == 1


def naive_spelling(rows, least_length=6, least_count=5, ratio=5, damage=199):
    counts = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]+", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if doc_id is not None and h % damage == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    known = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    alphabet = sorted({c for w in known for c in w})
    near = {w: [x for x in all_neighbours(w, alphabet) if x in known] for w in known}
    form = {}
    for w, n in known.items():
        best = min(near[w], key=lambda x: (-known[x], x), default=None)
        form[w] = best if best is not None and known[best] >= ratio * n else None
    out = {}
    for w, n in known.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (w, form[w], root, n, len(near[w]), known.get(form[w]))
    return out


def spelled(df, **kw):
    return {r["word"]: tuple(r) for r in spelling.spelling_variants(df, **kw).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_spelling_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = spelled(docs)
    assert got == naive_spelling([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert any(v[1] for v in got.values())


def test_spelling_paths_ties_and_odd_rows(spark):
    # aaaaaa <- baaaaa <- bcaaaa <- bcdaaa: a path of forms; of equally frequent near words the smallest wins.
    texts = ["aaaaaa " * 700, "baaaaa " * 130, "bcaaaa " * 26, "bcdaaa " * 5, "zzzzzz " * 50, "zzzzzy " * 50, "zzzzzÿ " * 5, "ÀBCDEF " * 5, "àbcdef " * 5, "short " * 9, None, "", "x" * 100_000, "1qqqqqq2" * 4]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "aaaaaa"), (3, "bcdaaa " * 5)] + [(20, "long" * 20_000)] * 5
    df = spark.createDataFrame([(i, t, "w", 3) for i, t in rows], "doc_id bigint, text string, word string, n int")
    for most_bits in (29, 16):
        got = spelled(df, most_bits=most_bits)
        want = naive_spelling([r for r in rows if r[0] != 20])
        long = "long" * 20_000
        assert {w: v for w, v in got.items() if len(w) < 1000} == want
        assert got[long] == (long, None, long, 5, 0, None)
    assert got["bcaaaa"][2] == "aaaaaa" and got["bcdaaa"][3] == 10 and got["bcdaaa"][1] is None
    assert got["zzzzzÿ"][:3] == ("zzzzzÿ", "zzzzzy", "zzzzzy") and "Àbcdef" in got and "àbcdef" in got
    assert spelled(spark.createDataFrame([], "doc_id bigint, text string")) == {}
    with pytest.raises(ValueError):
        spelling.spelling_variants(df, ratio=1)


STEMS = {"en": ["rotten", "vile"], "de": ["mist", "pfui"]}


def speech(rng, lang, toxic):
    words = ["".join(rng.choice("aeioubcdfg" if lang == "en" else "äöüwzkpt") for _ in range(rng.randint(3, 8))) for _ in range(rng.randint(5, 60))]
    if toxic:
        words.insert(rng.randrange(len(words)), rng.choice(STEMS[lang]) + rng.choice(["", "er", "es", "ung", "ish"]))
    return " ".join(words)


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(5)
    rows = [(i, "en" if i % 2 else "de", int(i % 5 == 1)) for i in range(1500)]
    return [(i, lang, toxic, speech(rng, lang, toxic)) for i, lang, toxic in rows]


def test_toxicity_learns_stems_of_each_language(spark, spoken):
    docs = spark.createDataFrame([(i, t, lang, "s") for i, lang, _, t in spoken], "doc_id bigint, text string, lang string, score string")
    labels = spark.createDataFrame([(i, x, 0) for i, _, x, _ in spoken], "doc_id bigint, toxic int, quality int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    test = [r for r in spoken if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    right = [got[i]["predicted"] == x for i, _, x, _ in test]
    assert np.mean(right) > 0.97, np.mean(right)
    for lang in STEMS:
        assert np.mean([got[i]["predicted"] for i, k, x, _ in test if x and k == lang]) > 0.9


def test_toxicity_learns_from_every_labelled_document(spark):
    rng = random.Random(6)
    rows = [(i, "de" if i % 8 == 3 else "en", int(i % 10 == 1)) for i in range(9000)]
    rows = [(i, lang, x, speech(rng, lang, x)) for i, lang, x in rows]
    docs = spark.createDataFrame([(i, t, lang) for i, lang, _, t in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, x) for i, _, x, _ in rows], "doc_id bigint, toxic int")
    m = toxicity.train(docs, labels)
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    n = np.array([sum(r[1] == lang for r in learned) for lang in ("de", "en")])
    assert m.langs == ["de", "en"] and np.allclose(m.prior, np.log(n / n.sum()))
    # Frequencies of features, from all texts too.
    for k, lang in enumerate(m.langs):
        corpus = toxicity.Corpus.of(pa.array([r[3] for r in learned if r[1] == lang]))
        counts = toxicity.speech_counts(corpus, np.arange(n[k])) + 1
        assert np.allclose(m.speech[:, k], np.log(counts / counts.sum()), atol=1e-5)
    test = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    right = (m.score(pa.array([r[3] for r in test])) >= 0.5) == np.array([r[2] for r in test])
    assert right.mean() > 0.97, right.mean()


def test_toxicity_shards_and_tasks_learn_one_model(spark, spoken):
    docs = spark.createDataFrame([(i, t, lang) for i, lang, _, t in spoken], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, x) for i, _, x, _ in spoken], "doc_id bigint, toxic int")
    test = [r for r in spoken if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    a, b = (toxicity.train(docs, labels, size=300) for _ in range(2))
    s = a.score(pa.array([r[3] for r in test]))
    assert np.array_equal(s, b.score(pa.array([r[3] for r in test])))
    assert ((s >= 0.5) == np.array([r[2] for r in test])).mean() > 0.95


def test_sums_of_rows_and_thresholds_equal_plain_loops():
    rng = np.random.default_rng(3)
    many = np.r_[0, rng.integers(0, 30, 5000), 250, 100, 99]
    starts, table = np.cumsum(many) - many, rng.normal(size=(500, 4)).astype(np.float32)
    features = rng.integers(0, 500, many.sum())
    want = [table[features[a : a + n]].sum(axis=0) / np.sqrt(max(n, 1)) for a, n in zip(starts, many, strict=True)]
    assert np.allclose(toxicity.sum_rows(table, features, starts, many), want, atol=1e-4)
    z, toxic, clean = np.arange(6) / 2, np.array([0, 1, 0, 3, 0, 2]), np.array([5, 0, 2, 1, 0, 0])

    def f1(t):
        hit = toxic[z >= t].sum()
        return 2 * hit / (hit + clean[z >= t].sum() + toxic.sum())

    assert toxicity.best_threshold(z, toxic, clean) == max((z[1:] + z[:-1]) / 2, key=f1)


def test_toxicity_depends_on_text_alone_and_on_all_of_it(spoken):
    m = toxicity.fit([r[3] for r in spoken], [r[2] for r in spoken], [r[1] for r in spoken])
    clean = " ".join(r[3] for r in spoken if not r[2] and r[1] == "en")
    texts = [clean, clean + " rotten", "", " \n", "rotten", "ROTTEN!!!", "x" * 300_000, None]
    s = m.score(pa.array([t or "" for t in texts]))
    assert s[0] < 0.5 < s[1] and s[4] > 0.5 and abs(s[4] - s[5]) < 1e-6 and s[2] == s[3] == s[7] and np.isfinite(s).all()
    # Scores don't depend on what stands in the same block.
    alone = np.array([m.score(pa.array([t or ""]))[0] for t in texts])
    assert np.allclose(s, alone, atol=1e-5)


def test_pooling_in_parts_equals_plain_loops(monkeypatch):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(size=(9, toxicity.DIM)), np.zeros((1, toxicity.DIM))]).astype(np.float32)
    sizes = np.array([0, 1, 2, 7, 0, 25, 3])
    ids = rng.integers(0, 9, sizes.sum())
    flat, first = toxicity.padded(ids, sizes, 9)
    filters = rng.normal(size=(3, toxicity.DIM, 4)).astype(np.float32)
    want, ends = [], np.cumsum(sizes)
    for n, e in zip(sizes, ends, strict=True):
        words = [*ids[e - n : e], 9, 9, 9]
        want.append(np.max([sum(x[words[i + j]] @ filters[j] for j in range(3)) for i in range(n + 1)], axis=0))
    for part in (4, 1000):
        monkeypatch.setattr(toxicity, "POSITIONS", part)
        assert np.allclose(toxicity.pool(x, flat, first, sizes + 1, filters), np.array(want), atol=1e-5)


def test_toxicity_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "en"), (None, "abc", None), (2, "", "de"), (2, "abc " * 50_000, "de")], "doc_id bigint, text string, lang string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    rows = toxicity.toxicity(docs, none).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 for r in rows) and sum(r["held_out"] for r in rows if r["doc_id"] is None) == 0
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0), (2, 7)], "doc_id bigint, toxic int")
    assert toxicity.toxicity(docs, one).count() == 4
    assert toxicity.toxicity(docs.limit(0), none).collect() == []


def test_toxicity_query_on_held_out_labels(spark):
    docs = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r["predicted"] for r in QUERIES["op12_toxicity"](spark, docs).where("held_out").collect()}
    marked = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{docs}/labels.parquet").collect() if r["doc_id"] in got and r["toxic"] is not None]
    toxic = [got[i] for i, x in marked if x]
    clean = [got[i] for i, x in marked if not x]
    assert len(toxic) > 50 and np.mean(toxic) > 0.85 and np.mean(clean) < 0.02

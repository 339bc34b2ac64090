"""The ten operators against brute force, round trips and the tokenizers' own libraries, on small tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from vellum.llm import bpe, embedding_dedup, exact_dedup, langid, license_scan, line_dedup, packing, sentencepiece_scan, simhash, token_counts, token_records, unigram
from vellum.llm.components import connected_components

#: Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with the operators' own.
ODD = [(1, "same text", "en"), (2, "same text", "en"), (2, "same text", "en"), (3, None, None), (4, "", "fr"), (5, "é" * 5 + " long" * 30_000, "fr"), (None, "no id", None), (None, "same text", "en"), (6, " \n\t ", "en"), (7, "1 2 3 !", "de"), (-8, "MIT License, cc BY; GNU General-Public\nLicense", "en"), (9, "a  b\n\nc <|endoftext|> 你好", "en")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, "src0", i, "x", "y", "z") for i, t, lang in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, h long, keep_id string, ids string, row string").repartition(3)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def groups_of(edges, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, None), (7, 7)] + [(2000, 2001 + i) for i in range(200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    real = [(a, b) for a, b in edges if b is not None and a != b]
    want = groups_of(real, {x for e in real for x in e})
    assert got == {n: c for n, c in want.items() if n != c}


@pytest.mark.parametrize("table_bytes", [exact_dedup.TABLE_BYTES, 600])
def test_exact_dedup(odd, docs, table_bytes):
    for df in (odd, docs):
        rows = texts(df)
        by = defaultdict(list)
        for i, t in rows:
            by[t].append(i)
        top = {t: max((i for i in ids if i is not None), default=None) for t, ids in by.items()}
        want = sorted((str(i), str(top[t]), len(by[t]), i == top[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
        got = sorted((str(r[0]), str(r[1]), *r[2:]) for r in exact_dedup.exact_dedup(df, table_bytes=table_bytes).collect())
        assert got == want


def test_content_table_compares_contents():
    table = exact_dedup.ContentTable(1 << 20)
    for text in ("a", "b", "a", "c"):
        assert table.add(b"12345678", text, 1, 1)
    assert table.count == [2, 1, 1]
    for i in range(3000):
        table.add(i.to_bytes(8, "little"), str(i), i, 1)
    assert table.add((17).to_bytes(8, "little"), "17", 99, 1) and table.top[table.keys.index(((17).to_bytes(8, "little"), "17"))] == 99


def brute_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(odd, docs):
    for df in (docs, odd.where("doc_id is not null")):
        rows = texts(df)
        fp = {i: brute_fingerprint(t[:200_000]) for i, t in rows}
        want = groups_of([(a, b) for a, b in combinations(fp, 2) if (fp[a] ^ fp[b]).bit_count() <= 4], fp)
        got = simhash.simhash_dedup(df).collect()
        assert len(got) == len(rows)
        assert all(r["fingerprint"] == f"{fp[r['doc_id']]:016x}" and r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert simhash.simhash_dedup(odd).count() == len(ODD)


def test_simhash_finds_all_near_links(spark):
    rng = random.Random(5)
    fps = []
    for _ in range(150):
        base = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 6)):
            x = base
            for b in rng.sample(range(64), rng.randrange(0, 5)):
                x ^= 1 << b
            fps.append(x)
    df = spark.createDataFrame([(i, simhash._signed(x)) for i, x in enumerate(fps)], "doc_id long, fp long")
    got = {r["fp"] & (2**64 - 1): r["component_id"] for r in simhash.near_groups(df).collect()}
    want = groups_of([(a, b) for a, b in combinations(range(len(fps)), 2) if (fps[a] ^ fps[b]).bit_count() <= 4], range(len(fps)))
    assert all(got[x] == want[i] for i, x in enumerate(fps))


@pytest.mark.parametrize("blocks", [5, 6])
def test_simhash_splits_large_shards_again(spark, blocks):
    """Values that share most bits meet in a few shards; every link is found, however the shards are split."""
    rng = random.Random(8)
    hot = rng.getrandbits(64)
    fps = {hot ^ (rng.getrandbits(20) << 5) for _ in range(700)} | {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    df = spark.createDataFrame([(i, simhash._signed(x)) for i, x in enumerate(fps)], "doc_id long, fp long")
    got = {r["fp"] & (2**64 - 1): r["component_id"] for r in simhash.near_groups(df, 3, blocks - 1, large=30).collect()}
    want = groups_of([(a, b) for a, b in combinations(range(len(fps)), 2) if (fps[a] ^ fps[b]).bit_count() <= 3], range(len(fps)))
    assert len(set(want.values())) > 20 and all(got[x] == want[i] for i, x in enumerate(fps))


def test_a_dense_group_is_not_compared_in_all_pairs():
    rng = random.Random(2)
    base, looked = rng.getrandbits(64), 0

    class Counted(int):
        def __xor__(self, other):
            nonlocal looked
            looked += 1
            return int(self) ^ int(other)

    tree, n = simhash.BKTree(), 4000
    for _ in range(n):
        x = base
        for b in rng.sample(range(64), 2):
            x ^= 1 << b
        tree.add(Counted(x), 4)
    assert len({tree.root(i) for i in range(n)}) == 1 and looked < n * 100


def jaccard_groups(rows, least=0.8):
    """Links and groups by comparing all pairs of texts."""
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for i, t in rows}
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])]
    return links, groups_of(links, sets)


def edited(rng, words, changes):
    words = list(words)
    for k in rng.sample(range(len(words)), changes):
        words[k] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_copies(spark, sf):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, passage = [], rng.choices(vocabulary, k=60)
    for _ in range(60):
        base = rng.choices(vocabulary, k=rng.randrange(30, 400))
        rows.append(" ".join(base))
        for _ in range(rng.randrange(0, 5)):
            rows.append(edited(rng, base, rng.randrange(0, max(2, len(base) // 25))))
    rows += [" ".join(passage + rng.choices(vocabulary, k=60)) for _ in range(80)]
    rows += ["", None, "  ", "one two", "ONE\ttwo", "one two three"]
    rows = list(enumerate(rows))
    links, want = jaccard_groups(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, keys string, fp int").repartition(5)
    got = {r["doc_id"]: r for r in simhash.near_copies(df).collect()}
    assert len(links) > 60 and {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    docs = spark.read.parquet(sf.replace("sf0.001", "sf0.01") + "/documents.parquet")
    links, want = jaccard_groups(texts(docs))
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs).collect()}
    assert sum(found[a] == found[b] for a, b in links) >= 0.99 * len(links)
    assert all(want[i] == want[c] for i, c in found.items())


def test_near_copies_odd(odd, empty):
    got = simhash.near_copies(odd).collect()
    assert len(got) == len(ODD) and simhash.near_copies(empty).count() == 0
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] in (1, 2, 3, 4, 6)} == {1: 1, 2: 1, 3: 3, 4: 3, 6: 3}
    assert all(r["kept"] for r in got if r["doc_id"] is None)


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_every_block_choice_keeps_pairs_together(blocks):
    rng = random.Random(1)
    masks = simhash.block_masks(blocks, 4)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, label int, rep string, n int")


def brute_links(rows, threshold=0.93):
    good = []
    for i, v, label in rows:
        if v and label is not None and i is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.append((i, np.array(v) / np.linalg.norm(v), label))
    return [(a[0], b[0]) for a, b in combinations(good, 2) if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] >= threshold]


@pytest.mark.parametrize(("size", "least"), [(2000, 1.0), (120, 0.97)])
def test_embedding_dedup(spark, size, least):
    rng = np.random.default_rng(0)
    rows, i = [], 0
    for label in (0, 1):
        for _ in range(180):
            base = rng.normal(size=16)
            for _ in range(rng.integers(1, 4)):
                rows.append((i, (base + rng.normal(size=16) * 0.08).tolist(), label))
                i += 1
    heart = rng.normal(size=16)
    for _ in range(150):
        rows.append((i, (heart + rng.normal(size=16) * 0.05).tolist(), 1))
        i += 1
    rows += [(i, rows[0][1], 0), (i + 1, None, 0), (i + 2, [0.0] * 16, 0), (i + 3, [float("nan")] * 16, 1), (i + 4, rows[0][1], None), (i + 5, [], 0), (i + 6, [1.0, 2.0], 0), (i + 7, [None] * 16, 0)]
    df = vectors(spark, rows)
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_dedup(df, shard_size=size).collect()}
    links = brute_links(rows)
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    want = groups_of(links, [r[0] for r in rows])
    assert set(got) == {r[0] for r in rows}
    assert all(r["n_links"] <= count[k] for k, r in got.items())
    assert sum(r["n_links"] for r in got.values()) >= least * 2 * len(links)
    assert np.mean([got[k]["component_id"] == want[k] for k in want]) >= least
    assert all(r["kept"] == (k == r["component_id"]) for k, r in got.items())
    audit = embedding_dedup.audit_recall(df, embedding_dedup.embedding_dedup(df, shard_size=size), every=5).first()
    assert audit["recall"] >= min(least, 0.97)


def planted(n, others, dims=32, spread=0.03, seed=4):
    """A dense group of distinct vectors, all pairs linked, among others that link with nothing."""
    rng = np.random.default_rng(seed)
    heart = rng.normal(size=dims)
    x = np.concatenate([heart / np.linalg.norm(heart) + rng.normal(size=(n, dims)) * spread, rng.normal(size=(others, dims))])
    return [(i, v, 0) for i, v in enumerate(x.tolist())]


def test_embedding_dedup_counts_all_links_of_a_large_dense_group(spark):
    rows = planted(2600, 400)
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.93).sum(axis=1) - 1
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_dedup(vectors(spark, rows)).collect()}
    assert want[:2600].sum() > 2500 * 2599
    assert [got[i]["n_links"] for i in range(3000)] == want.tolist()
    assert {got[i]["component_id"] for i in range(2600)} == {0}


def test_embedding_dedup_keeps_dense_groups_whole_beyond_the_first_split(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CENTRES", 16)
    rows = planted(300, 1200)
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_dedup(vectors(spark, rows), shard_size=80).collect()}
    want = 2 * len(brute_links(rows[:300]))
    assert want > 290 * 299
    assert sum(got[i]["n_links"] for i in range(300)) >= 0.999 * want


def test_bpe_words_equal_whole_texts():
    enc = bpe.WordEncoder(bpe.default_path(), cache_words=200)
    rng = random.Random(1)
    parts = [*" \n\t\r a's't1,.é 　\x85\x1c​ ß你!'ll <|x", "  ", "<|endoftext|>", "'ll", " \n", "\0", "\n", "the", "nation"]
    for _ in range(10):
        batch = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(300)]
        for text, ids in zip(batch, enc.encode_many(batch), strict=True):
            assert enc.tokenizer.encode(text, add_special_tokens=False).ids == np.frombuffer(ids, enc.dtype).tolist(), text


def test_bpe_keeps_the_library_default_for_added_tokens(spark):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(bpe.default_path())
    enc = bpe.WordEncoder(bpe.default_path())
    cases = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>b the nation, a", "no token <|endof text|>", "the nation\n<|endoftext|><|endoftext|> \n z"]
    for text, ids in zip(cases, enc.encode_many(cases), strict=True):
        assert fresh.encode(text, add_special_tokens=False).ids == np.frombuffer(ids, enc.dtype).tolist(), text
    assert np.frombuffer(enc.encode(cases[0]), enc.dtype).tolist() == [87, 220, 50256, 331]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    want = {i: len(fresh.encode(x, add_special_tokens=False).ids) + 1 for i, x in enumerate(cases)}
    assert {r["doc_id"]: r["doc_tokens"] for r in packing.pack(df).collect()} == want
    assert {r["doc_id"]: r["n_tokens"] for r in token_records.token_records(df).collect()} == want


def direct_ids(rows, end):
    t = bpe.encoder(bpe.default_path()).tokenizer
    return [(i, [*t.encode(x, add_special_tokens=False).ids, end]) for i, x in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_packing(odd, docs):
    for df in (odd, docs):
        want = direct_ids(texts(df), 1)
        got = packing.pack(df, with_ids=True).collect()
        place, stream = {}, {}
        for r in got:
            ids = np.frombuffer(r["ids"], "<u4").tolist()
            assert len(ids) == r["length"] > 0 and crc(ids) == r["ids_crc32"]
            for k, x in enumerate(ids):
                assert (r["sequence_id"], r["offset"] + k) not in place
                place[r["sequence_id"], r["offset"] + k] = x
                stream[r["sequence_id"] * 2048 + r["offset"] + k] = (r["doc_id"], r["start"] + k)
        total = sum(len(x) for _, x in want)
        assert sorted(stream) == list(range(total)) and all(0 <= o < 2048 for _, o in place)
        by = defaultdict(list)
        for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
            if r["start"] == 0:
                by[r["doc_id"]].append([])
            by[r["doc_id"]][-1] += np.frombuffer(r["ids"], "<u4").tolist()
        assert sorted((str(i), x) for i, many in by.items() for x in many) == sorted((str(i), x) for i, x in want)


def test_token_records(spark, odd, docs, tmp_path):
    for df in (odd, docs):
        rows = sorted(texts(df), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        want, at = [], 0
        for i, ids in direct_ids(rows, 2):
            want.append((i, at, len(ids), crc(ids)))
            at += len(ids)
        got = sorted(map(tuple, token_records.token_records(df).collect()), key=lambda r: r[1])
        assert got == want
    uri, manifest = token_records.write_records(docs, str(tmp_path / "out"))
    filesystem, folder = token_records._fs(uri)
    for shard in [r["shard"] for r in manifest.collect()]:
        plain = {k: (i, x.tolist()) for k, i, x in token_records.read_shard(filesystem, folder, shard)}
        mixed = [(k, (i, x.tolist())) for k, i, x in token_records.read_shard(filesystem, folder, shard, seed=1)]
        assert dict(mixed) == plain and len(mixed) == len(plain)
    name = token_records._names(folder, 0)[0]
    data = bytearray(open(name, "rb").read())
    data[40] ^= 1
    open(name, "wb").write(data)
    with pytest.raises(ValueError, match="corrupt"):
        list(token_records.read_shard(filesystem, folder, 0))


def test_license_scan(odd, docs, spark):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(["Permission is hereby granted, free of charge, to any person", "GNU GNU General Public License general public license", "the mit, license cc cc by by", "x" * 9 + " Apache\x00License 2", "MİT license mit éLicense"])], "doc_id long, text string")
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for df in (odd, docs, more):
        rows = texts(df)
        got = license_scan.license_scan(df).collect()
        assert len(got) == len(rows)
        want = []
        for i, t in rows:
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
            places = [(k, label) for p, label in phrases.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
            at = [k for k, _ in places]
            want.append((str(i), len(words), len(at), str(min(at, default=None)), str(max(at, default=None)), ",".join(sorted({x for _, x in places}))))
        assert sorted((str(r["doc_id"]), r["n_words"], r["n_base"], str(r["first_word"]), str(r["last_word"]), r["base_labels"]) for r in got) == sorted(want)
        assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)
    assert license_scan.license_scan(more).where("doc_id = 100").first()["labels"] == "mit"


def test_language_id(odd, spark, sf):
    docs = spark.read.parquet(sf.replace("sf0.001", "sf0.01") + "/documents.parquet")
    got = {r["doc_id"]: r for r in langid.language_id(docs).collect()}
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r["held_out"]} == set(held)
    right = [got[i]["lang_pred"] == lang[i] for i in held]
    assert np.mean(right) >= 0.95
    assert abs(np.mean([got[i]["score"] for i in held]) - np.mean(right)) < 0.05
    rows = langid.language_id(odd).collect()
    assert len(rows) == len(ODD)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 6, 7)} == {"und"}
    model = langid.train(docs)
    assert len(model.values) < 0.7 * (1 << langid.BITS) * len(model.langs) and (model.values != 0).all()
    assert langid.train(docs.where("false")).predict("abc") == ("und", 0.0)


def reference_features(text, bits):
    """Counts of the hashed runs, one run at a time, in whole numbers."""
    low, counts = 1 << 32, defaultdict(int)
    c = [ord(x) for x in text.lower()]
    for i, x in enumerate(c):
        a = x * 2654435761 % low
        counts[a >> 32 - bits] += 1
        if i + 1 < len(c):
            b = (a ^ c[i + 1] * 2246822519 % low) * 3266489917 % low
            counts[b >> 32 - bits] += 1
            if i + 2 < len(c):
                counts[((b ^ c[i + 2] * 668265263 % low) * 374761393 % low) >> 32 - bits] += 1
    return counts


def test_language_features_equal_a_plain_count():
    for text in ("", "a", "Ab", "The nation — naïve 你好!", "aaa" * 50):
        at, tf = langid.features(text, 12)
        want = reference_features(text, 12)
        assert at.tolist() == sorted(want) and np.allclose(tf, [1 + np.log(want[k]) for k in sorted(want)], atol=1e-5)


def test_ftrl_equals_a_coordinate_wise_computation():
    rng = np.random.default_rng(3)
    examples = [(np.sort(rng.choice(12, 4, replace=False)).astype(np.int32), rng.random(4), int(rng.integers(3))) for _ in range(25)]
    alpha, beta, l1, l2 = 0.5, 1.0, 0.6, 0.02
    w, b = langid.ftrl(examples, 12, 3, alpha, beta, l1, l2, epochs=2)
    z, n = [[0.0] * 3 for _ in range(13)], [[0.0] * 3 for _ in range(13)]

    def weight(f, k):
        if abs(z[f][k]) <= l1:
            return 0.0
        return -(z[f][k] - (l1 if z[f][k] > 0 else -l1)) / ((beta + n[f][k] ** 0.5) / alpha + l2)

    order = np.random.default_rng(0)
    for _ in range(2):
        for i in order.permutation(len(examples)):
            at, x, y = examples[i]
            pairs = [*zip(at.tolist(), x.tolist(), strict=True), (12, 1.0)]
            s = [sum(v * weight(f, k) for f, v in pairs) for k in range(3)]
            e = [np.exp(v - max(s)) for v in s]
            step = [((f, k), v * (e[k] / sum(e) - (k == y)), weight(f, k)) for f, v in pairs for k in range(3)]
            for (f, k), g, old in step:
                z[f][k] += g - ((n[f][k] + g * g) ** 0.5 - n[f][k] ** 0.5) / alpha * old
                n[f][k] += g * g
    assert np.allclose(w, [[weight(f, k) for k in range(3)] for f in range(12)]) and np.allclose(b, [weight(12, k) for k in range(3)])
    assert (w == 0).any()


def test_calibration_and_sparse_logits():
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 3, 300)
    logits = rng.normal(size=(300, 3)) + 2.0 * np.eye(3)[labels]
    loss = lambda t: float(np.mean([np.log(np.exp(z / t).sum()) - z[y] / t for z, y in zip(logits, labels, strict=True)]))
    best = langid.calibrate(logits, labels)
    assert loss(best) <= min(loss(t) for t in np.geomspace(0.1, 10, 400)) + 1e-6 and langid.calibrate(np.zeros((0, 3)), np.zeros(0)) == 1.0
    dense = rng.normal(size=(1 << 8, 3)) * (rng.random((1 << 8, 3)) < 0.3)
    row, column = np.nonzero(dense)
    model = langid.Model(["a", "b", "c"], np.ones(1 << 8, np.float32), np.searchsorted(row, np.arange((1 << 8) + 1)), column, dense[row, column], np.array([0.1, 0.2, 0.3]), 1.0, 8)
    at, tf = langid.features("some words of a text", 8)
    want = langid.unit_tfidf(at, tf, model.idf).astype(float) @ dense[at] + model.bias
    assert np.allclose(model.logits(at, tf), want)
    p = np.exp(want - want.max())
    assert model.predict("some words of a text") == ("abc"[int(want.argmax())], pytest.approx(p.max() / p.sum()))


def test_every_language_is_learned(spark):
    rng = random.Random(6)
    alphabet = lambda k: [chr(0x4E00 + 12 * k + j) for j in range(12)]
    rows = [(100 * k + i, "".join(rng.choices(alphabet(k), k=60)), f"l{k:02d}") for k in range(70) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df)
    assert model.langs == [f"l{k:02d}" for k in range(70)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.language_id(df, model=model).collect()}
    assert np.mean([got[i] == lang for i, _, lang in rows]) > 0.98
    with pytest.raises(ValueError, match="70 languages"):
        langid.train(df, max_langs=64)


def test_language_of_a_prediction_is_no_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.train(docs)
    blind = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    key = lambda r: r["doc_id"]
    assert sorted(langid.language_id(docs, model=model).collect(), key=key) == sorted(langid.language_id(blind, model=model).collect(), key=key)


def test_line_dedup(spark):
    page = "<html><head><script>var a='<p>x</p>'</script></head><body><ul><li>Menu</li><li> Home  page </li></ul><p>{}</p><p>Menu</p><div>own {}</div></body></html>"
    rows = [(i, "http://Site.example:80/a", page.format("shared" if i < 2 else f"text {i}", i), "x") for i in range(10)] + [(50, None, None, "x"), (51, "odd", "<p>Menu", "x"), (52, "odd", "", "x"), (None, "https://u@two.example/", "<p>Menu<p>One", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, bad string")
    got = {r["page_id"]: r for r in line_dedup.line_dedup(df).collect()}
    assert len(got) == len(rows)
    assert got[0]["host"] == "site.example" and got[0]["lines"] == ["Menu", "Home page", "shared", "Menu", "own 0"]
    assert got[0]["kept"] == ["shared", "own 0"] and got[7]["kept"] == ["text 7", "own 7"]
    assert got[50]["lines"] == [] and got[51]["kept"] == ["Menu"] and got[None]["kept"] == ["Menu", "One"]


def modified_model(tmp_path_factory):
    """The public vocabulary as a unigram model whose scores single-precision sums hold exactly."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb.ModelProto()
    proto.ParseFromString(open(unigram.default_path(), "rb").read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -40000)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


@pytest.fixture(scope="module")
def model_path(tmp_path_factory):
    return modified_model(tmp_path_factory)


def test_unigram_equals_the_library(model_path, docs):
    from sentencepiece import SentencePieceProcessor

    library, model = SentencePieceProcessor(model_file=model_path), unigram.unigram(model_path)
    rng = random.Random(2)
    parts = [*" \n\té'st1. 你aaeethin ", "  ", "the", " \n", "ing"]
    cache = unigram.UnitCache(model, model.segment, lambda xs: [i for x in xs for i in x])
    counts = unigram.UnitCache(model, lambda u: token_counts.count_pieces(model, u), sum)
    for text in ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(800)] + [t for _, t in texts(docs) if len(t) < 3000][:60]:
        normal, want = model.normalize(text), library.encode(text)
        assert model.segment(normal) == cache.value(normal) == want
        assert counts.value(normal) == len(want)
        assert model.decode(want) == text
        if len(normal) < 200:
            for size in (16, 25):
                starts = range(0, max(1, len(normal)), size)
                chunks = [(normal[s : s + size + model.longest - 1], min(size, len(normal) - s)) for s in starts]
                scores = sentencepiece_scan.border_scores([sentencepiece_scan.transfer(model, b, z) for b, z in chunks])
                states = sentencepiece_scan.exit_states([sentencepiece_scan.entry_of_exit(model, b, z, s) for (b, z), s in zip(chunks, scores, strict=True)])
                assert want == [i for (b, z), s, e in zip(chunks, scores, states, strict=True) for i in sentencepiece_scan.trace(model, b, z, s, e)]


def test_sentencepiece_scan(odd, docs):
    for df in (odd, docs):
        whole = sentencepiece_scan.encode(df).select("doc_id", "ids").collect()
        cut = sentencepiece_scan.encode(df, chunk_chars=700, span=3).collect()
        key = lambda r: (str(r["doc_id"]), r["ids"])
        assert sorted(map(key, whole)) == sorted(map(key, cut))
        assert any(r["n_chunks"] > 1 for r in cut)
        model = unigram.unigram(unigram.default_path())
        want = [(str(d), np.array(model.segment(model.normalize(t)), "<u4").tobytes()) for d, t in texts(df)]
        assert sorted(map(key, whole)) == sorted(want)
        once = sentencepiece_scan.encode(df, chunk_chars=700, decoded=True).collect()
        apart = sentencepiece_scan.decode(sentencepiece_scan.encode(df)).collect()
        assert sorted((*key(r), r["decoded"]) for r in once) == sorted((*key(r), r["decoded"]) for r in apart)
        digest = sentencepiece_scan.encode_digest(df).collect()
        assert all(r["round_trip"] for r in digest)
        counts = {(str(r["doc_id"]), r["n_tokens"]) for r in token_counts.token_counts(df).collect()}
        assert counts == {(str(r["doc_id"]), r["n_tokens"]) for r in digest}


def test_sentencepiece_of_empty_texts_alone(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (None, "")], "doc_id long, text string").coalesce(1)
    got = sentencepiece_scan.encode_digest(df).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["round_trip"]) for r in got) == [("1", 0, True), ("2", 0, True), ("None", 0, True)]


def test_empty_tables(spark, empty):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vecs = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for out in (sentencepiece_scan.encode_digest(empty), line_dedup.line_dedup_digest(pages), embedding_dedup.embedding_dedup(vecs), exact_dedup.exact_dedup(empty), langid.language_id(empty), packing.pack(empty), token_counts.token_counts(empty), token_records.token_records(empty), license_scan.license_scan(empty), simhash.simhash_dedup(empty)):
        assert out.count() == 0


def test_line_dedup_edges(spark):
    """A line at exactly the ratio stays; repeated rows are pages; a very long page; a site of one page; a line beyond the ratio goes."""
    shared = lambda i: ("<p>often</p>" if i < 4 else "") + ("<p>at ratio</p>" if i < 3 else "") + f"<p>own {i}</p>"
    rows = [(i, "http://a.example/", shared(i)) for i in range(10)] + [(20, "http://b.example/x", "<p>same</p>")] * 2 + [(30, "http://c.example/", "<p>" + "long word " * 200_000 + "</p>"), (31, "http://d.example/", "<p>alone</p>")]
    got = {}
    for r in line_dedup.line_dedup(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        got.setdefault(r["page_id"], []).append(r["kept"])
    assert got[0] == [["at ratio", "own 0"]] and got[3] == [["own 3"]] and got[9] == [["own 9"]]
    assert got[20] == [[], []] and len(got[30][0][0]) > 1_900_000 and got[31] == [["alone"]]


def test_line_dedup_does_not_move_pages_for_a_small_table_of_lines(spark, sf):
    plan = line_dedup.line_dedup(spark.read.parquet(f"{sf}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(host" not in plan


def brute_license(words, idf):
    """Labels and score by trying every template at every place, without an index."""
    labels, best = set(), 0.0
    for t in license_scan.TEMPLATES:
        w = list(t.words)
        key = w[t.key[0] : t.key[1]]
        if not t.body:
            labels |= {t.label} if any(words[i : i + len(w)] == w for i in range(len(words))) else set()
            continue
        rarest = sorted(set(w), key=lambda x: (-idf[x], x))[: license_scan.ANCHORS]
        votes = sorted((p - at, x) for p, x in enumerate(words) if x in rarest for at, y in enumerate(w) if x == y)
        groups = []
        for v in votes:
            if groups and v[0] - groups[-1][-1][0] <= license_scan.DRIFT:
                groups[-1].append(v)
            else:
                groups.append([v])
        for g in groups:
            if sum(idf[x] for x in {x for _, x in g}) < license_scan.LEAST_VOTES * sum(idf[x] for x in rarest):
                continue
            window = words[max(0, g[0][0] - license_scan.DRIFT) : max(0, g[-1][0] + len(w) + license_scan.DRIFT)]
            if not any(window[i : i + len(key)] == key for i in range(len(window))):
                continue
            near = {(a, b) for a, b in zip(window, window[1:])}
            pairs = [(a, b) for a, b in zip(w, w[1:])]
            score = sum(idf[a] + idf[b] for a, b in pairs if (a, b) in near) / sum(idf[a] + idf[b] for a, b in pairs)
            if score >= license_scan.LEAST_SCORE:
                labels.add(t.label)
                best = max(best, min(1.0, score))
    return labels, best


def test_license_labels_and_scores_equal_brute_force(spark, docs):
    rng = random.Random(9)
    made = []
    for label, _, text in license_scan.BODIES:
        w = text.split()
        made += [text, "x " * 40 + text + " y" * 30 + " " + text.upper(), " ".join(x for x in w if rng.random() > 0.05), " ".join(w[: len(w) // 2]), " ".join(rng.sample(w, len(w)))]
    made += ["The MIT License is short.", "Licensed under CC BY-NC 4.0.", "creative commons attribution", "", None, "license " * 3000]
    made = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(made)], "doc_id long, text string")
    both = made.unionByName(docs.select("doc_id", "text"))
    rows = texts(both)
    split = {i: [x.encode() for x in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))] for i, t in rows}
    sets = [set(w) for w in split.values()]
    idf = {w: np.log((1 + len(sets)) / (1 + sum(w in s for s in sets))) + 1 for t in license_scan.TEMPLATES for w in t.words}
    got = {r["doc_id"]: r for r in license_scan.license_scan(both).collect()}
    for i, words in split.items():
        labels, score = brute_license(words, idf)
        assert got[i]["labels"] == ",".join(sorted(labels)) and abs(got[i]["score"] - score) < 1e-9, i
    for k, (label, _, _) in enumerate(license_scan.BODIES):
        assert label in got[10_000 + 5 * k]["labels"].split(",") and got[10_000 + 5 * k]["score"] > 0.99
    name = got[10_000 + 5 * len(license_scan.BODIES)]
    assert (name["labels"], name["score"]) == ("mit", 0.0)
    assert got[10_001 + 5 * len(license_scan.BODIES)]["labels"] == "cc-by,cc-by-nc"

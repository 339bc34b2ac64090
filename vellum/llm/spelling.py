"""Operator 11, spelling variant grouping: full neighbourhoods of words, joined with the vocabulary.

The vocabulary is the distinct words of all texts with their counts. Every word emits its whole
neighbourhood: each distinct string that one deletion, one replacement or one insertion of a
character of the observed alphabet makes of it. A candidate that equals a vocabulary word is
near by construction, so an equi-join finds all near words and no distance is computed.

A word of ten characters has some thousand candidates, of which few are words. Their hashes come from
those of the word's prefixes and suffixes, whole arrays at a time, and only candidates that a
Bloom filter of the vocabulary may hold are spelled out and shuffled. The filter has a fixed
largest size: over a vocabulary that outgrows it, more candidates are shuffled, and the
result stays the same.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import batch, forget, id_text, materialize, rows

#: Words that a task counts before it hands them on, and the largest Bloom filter (2**29 bits are 64 MB).
HELD_WORDS, MOST_BITS = 400_000, 29
_COUNT = pa.schema([("word", pa.string()), ("n", pa.int64())])
_BITS = pa.schema([("place", pa.int32()), ("bits", pa.int64())])
_CANDIDATE = pa.schema([("candidate", pa.string()), ("word", pa.string()), ("n", pa.int64())])
#: Odd factor of the polynomial hash of a word's code points, and the two of its final mix.
_BASE, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _counts(least_length: int, damage: int):
    find = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}").findall

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        crc32 = zlib.crc32
        for ids, texts in rows(batches, ["doc_id", "text"]):
            for doc_id, text in zip(ids, texts, strict=True):
                # bytes.lower() changes A-Z alone.
                found = Counter(find(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                if damage and doc_id is not None:
                    start = crc32(f"{doc_id}:".encode())
                    for word in list(found):
                        h = crc32(word.encode(), start)
                        if not h % damage:
                            at, n = h % len(word), found.pop(word)
                            if len(word) > least_length:
                                counts[word[:at] + word[at + 1 :]] += n
                counts.update(found)
            if len(counts) > HELD_WORDS:
                yield batch(_COUNT, [list(counts), list(counts.values())])
                counts = Counter()
        if counts:
            yield batch(_COUNT, [list(counts), list(counts.values())])

    return run


def vocabulary(docs: DataFrame, least_length: int = 6, least_count: int = 5, damage: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: runs of ASCII letters and U+00C0 to U+00FF of at least ``least_length`` characters, A-Z lower-cased.

    With ``damage`` a run loses a character in every document where the CRC-32 of
    ``<doc_id>:<run>`` is divisible by it: planted misspellings, the same on every run. Runs of
    documents without an id stay as they are.
    """
    counted = id_text(docs, id_col, text_col).mapInArrow(_counts(least_length, damage), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``words``, matrix of code points) of the words of each length; none is empty."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        joined = "".join([words[i] for i in at.tolist()])
        yield at, np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(-1, n).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumprod(np.full(n, _BASE), out=out[1:])
    return out


def word_hashes(codes: np.ndarray) -> np.ndarray:
    """Unmixed hash of each row: the sum of code * BASE ** (characters behind it)."""
    return (codes * _powers(codes.shape[1])[codes.shape[1] - 1 :: -1][: codes.shape[1]]).sum(axis=1, dtype=np.uint64)


def _probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mixed(h)
    return h >> np.uint64(64 - bits), h & np.uint64((1 << bits) - 1)


def _filter_rows(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (words,) in rows(batches, ["word"], 50_000):
            h = np.concatenate([np.concatenate(_probes(word_hashes(codes), bits)) for _, codes in by_length(words)])
            yield batch(_BITS, [(h >> np.uint64(6)).astype(np.int32), (np.uint64(1) << (h & np.uint64(63))).view(np.int64)])

    return run


def bloom_filter(words: DataFrame, bits: int) -> np.ndarray:
    """A filter of 2**bits bits with two probes a word, as 64-bit integers: its size is fixed, and so is what the driver gathers."""
    found = words.select("word").mapInArrow(_filter_rows(bits), "place int, bits bigint").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found.column("place").to_numpy()] = found.column("bits").to_numpy()
    return out


def filter_bits(words: int, most: int = MOST_BITS) -> int:
    """At least 32 bits a word, up to the largest size."""
    return min(most, max(16, (32 * words).bit_length()))


def _holds(h: np.ndarray, seen: np.ndarray, bits: int) -> np.ndarray:
    """Places in the flat ``h`` whose both probes are set."""
    h = mixed(h.ravel())
    a = h >> np.uint64(64 - bits)
    at = np.flatnonzero(seen[a >> np.uint64(6)] >> (a & np.uint64(63)).view(np.int64) & 1)
    b = h[at] & np.uint64((1 << bits) - 1)
    return at[(seen[b >> np.uint64(6)] >> (b & np.uint64(63)).view(np.int64) & 1) != 0]


def neighbours(words: list[str], alphabet: str, seen: np.ndarray, bits: int, at_a_time: int = 400_000) -> Iterator[tuple[int, str]]:
    """(number of the word, candidate) of the whole neighbourhood of each word, without those that the filter rules out; each once."""
    letters = np.frombuffer(alphabet.encode("utf-32-le"), np.uint32).astype(np.uint64)
    for places, codes in by_length(words):
        n, power = codes.shape[1], _powers(codes.shape[1] + 1)
        step = max(1, at_a_time // ((n + 1) * max(len(letters), 1)))
        # Of a very long word a part of the alphabet is taken at a time.
        part = max(1, at_a_time // (n + 1))
        for lo in range(0, len(codes), step):
            c, of = codes[lo : lo + step], [words[i] for i in places[lo : lo + step].tolist()]
            number = places[lo : lo + step].tolist()
            term = c * power[n - 1 :: -1][:n]
            # What stands before place i, as it is hashed in the word, and what stands from i on.
            before = np.concatenate([np.zeros((len(c), 1), np.uint64), np.cumsum(term, axis=1, dtype=np.uint64)], axis=1)
            behind = before[:, -1:] - before
            # A deletion takes one power from the part before it.
            shorter = np.zeros((len(c), n), np.uint64)
            if n > 1:
                shorter[:, 1:] = np.cumsum(c[:, :-1] * power[n - 2 :: -1][: n - 1], axis=1, dtype=np.uint64)
            for k in _holds(shorter + behind[:, 1:], seen, bits).tolist():
                w, i = divmod(k, n)
                # In a run of one character all deletions are one string.
                if not i or of[w][i] != of[w][i - 1]:
                    yield number[w], of[w][:i] + of[w][i + 1 :]
            for first in range(0, len(letters), part):
                some = letters[first : first + part]
                other = (before[:, -1:] - term)[:, :, None] + some * power[n - 1 :: -1][:n][:, None]
                for k in _holds(other, seen, bits).tolist():
                    w, i, a = k // len(some) // n, k // len(some) % n, alphabet[first + k % len(some)]
                    if of[w][i] != a:
                        yield number[w], of[w][:i] + a + of[w][i + 1 :]
                more = (before * _BASE + behind)[:, :, None] + some * power[n::-1][: n + 1][:, None]
                for k in _holds(more, seen, bits).tolist():
                    w, i, a = k // len(some) // (n + 1), k // len(some) % (n + 1), alphabet[first + k % len(some)]
                    # Behind an equal character it is the same string as before it.
                    if not i or of[w][i - 1] != a:
                        yield number[w], of[w][:i] + a + of[w][i:]


def _candidates(alphabet: str, shared, bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, counts in rows(batches, ["word", "n"], 20_000):
            out: list[tuple[int, str]] = []
            for hit in neighbours(words, alphabet, shared.value, bits):
                out.append(hit)
                if len(out) >= 20_000:
                    yield batch(_CANDIDATE, [[c for _, c in out], [words[i] for i, _ in out], [counts[i] for i, _ in out]])
                    out = []
            if out:
                yield batch(_CANDIDATE, [[c for _, c in out], [words[i] for i, _ in out], [counts[i] for i, _ in out]])

    return run


def near_words(words: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """word, n, near, near_n: all pairs (both ways) of (word, n) that differ by one inserted, deleted or replaced character.

    Words are distinct, not null and not empty. Each word meets its candidates by an equi-join; a
    word has as many partners as its neighbourhood allows, so no key is hot.
    """
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    # At most the characters that words may have.
    alphabet = "".join(sorted(r["c"] for r in letters.collect()))
    bits = filter_bits(words.count(), most_bits)
    shared = words.sparkSession.sparkContext.broadcast(bloom_filter(words, bits))
    made = words.mapInArrow(_candidates(alphabet, shared, bits), "candidate string, word string, n bigint")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return made.join(known, F.col("candidate") == F.col("near")).select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of (word, form) without nulls, whose forms lead to no circle: the last form that a word's forms lead to.

    Each round replaces what a word points to by what that points to, so a path is walked in as
    many rounds as its length has binary digits. Tables are written each round.
    """
    spark = forms.sparkSession
    now, path = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        after, after_path = materialize(now.join(step, F.col("root") == F.col("__w"), "left").select("word", F.coalesce("__r", "root").alias("root"), F.col("__r").isNotNull().alias("moved")), "spelling-roots")
        done = after.where("moved").isEmpty()
        forget(spark, path)
        now, path = after.select("word", "root"), after_path
        if done:
            return now


def spelling_variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, ratio: int = 5, damage: int = 199, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """One row for each vocabulary word: word, form, root, n, n_near, form_n.

    Words are those of ``vocabulary``. Near words differ by one inserted, deleted or replaced
    character; n_near counts them. form is the near word with the largest count (of
    equals the smallest by code points), if that is at least ``ratio`` times the word's own, else null; form_n is its count. root
    is the end of the forms' path, the word itself where it has no form. Since counts grow
    along a path (``ratio`` is 2 or more), it ends.

    Null and empty texts have no words; very long texts and words are taken whole. Rows that repeat are
    counted as often as they stand; a null id leaves its runs undamaged. An empty table gives an empty result; other
    columns are ignored.
    """
    if ratio < 2:
        raise ValueError("ratio is 2 or more: else forms could lead in a circle")
    words, _ = materialize(vocabulary(docs, least_length, least_count, damage, id_col, text_col), "spelling-words")
    pairs = near_words(words, most_bits).select("word", "n", F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")).alias("near"))
    alone = words.select("word", "n", F.lit(None).cast("struct<m:bigint,w:string>").alias("near"))
    best = pairs.unionByName(alone).groupBy("word", "n").agg(F.count("near").alias("n_near"), F.min("near").alias("near"))
    good = -F.col("near.m") >= ratio * F.col("n")
    found, _ = materialize(best.select("word", "n", "n_near", F.when(good, F.col("near.w")).alias("form"), F.when(good, -F.col("near.m")).alias("form_n")), "spelling-forms")
    last = roots(found.where("form is not null").select("word", "form"))
    out = found.join(last, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

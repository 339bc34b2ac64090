"""Operator 12, toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of hashed rows for the word itself and its runs of three to five
characters, so forms of a word that training never showed lie near those it did. Filters
of several widths slide over a text's words, the largest response of each over the whole
text is kept (max pooling), and a logistic unit weighs these. A filter's response is a sum of
one projection per word of its window; projections are made once for each distinct word of a
block of texts.

Thresholds are calibrated by language: the language is guessed from the text itself, by
multinomial naive Bayes over the same hashed features, and each language's threshold
becomes a score of 0.5. The model is fitted on all labelled documents, by tasks whose models are averaged after every
round; its size is fixed but for one column a language, and it is broadcast.
"""

from __future__ import annotations

import copy
import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import batch, forget, id_text, materialize, text_blocks
from vellum.llm.simhash import MOST_BITS, _id_filter

#: Hashed rows (2**BITS) and their length, filter widths, filters of each width.
BITS, DIM, WIDTHS, FILTERS = 17, 16, (1, 2, 3), 16
#: Labelled texts and characters of a shard, on average.
SHARD_TEXTS, SHARD_CHARS = 5000, 16_000_000
#: Texts that a feature must be in.
LEAST_TEXTS = 3
EPOCHS, BATCH, RATE = 4, 32, 0.08
#: Toxic documents of a language in the calibration set from which it has a threshold of its own.
LEAST_TOXIC = 8
#: Bytes of text scored at a time, positions whose responses are held at a time.
BLOCK_BYTES, POSITIONS = 4 << 20, 1 << 17
#: Words of so many features are summed one by one.
LONG_WORD = 100
#: Thresholds are set on logits in steps of 1 / STEPS, up to MOST_LOGIT from zero.
STEPS, MOST_LOGIT = 1024, 64
#: Numbers of an array that are added up as one row; languages whose counts a task holds.
SLICE, LANGS_HELD = 1 << 15, 16
PADDING = max(WIDTHS)
_PLAIN = pa.schema([("id", pa.int64()), ("lang", pa.string()), ("text", pa.string())])
_SLICES, _SLICES_DDL = pa.schema([("source", pa.int32()), ("key", pa.string()), ("slice", pa.int32()), ("values", pa.binary())]), "source int, key string, slice int, values binary"
_LOGITS = pa.schema([(x, pa.int64()) for x in ("guessed", "label", "step", "n")])
_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def held_out(doc_id: int | None) -> bool:
    """Whether CRC-32 of the id as text is divisible by 5; never for a null id."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def word_features(words: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the words one after the other, and where each word's begin: the word, and its runs of 3 to 5 characters with a mark at both ends."""
    joined = "".join([f"\x02{w}\x03" for w in words])
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    shift = np.uint32(32 - bits)
    power = np.uint32(2654435761) ** (np.arange(len(c)) - starts[word]).astype(np.uint32)
    whole = np.add.reduceat((c + np.uint32(1)) * power, starts, dtype=np.uint32)
    hashes, of = [(whole ^ (whole >> np.uint32(15))) * np.uint32(2246822519) >> shift], [np.arange(len(words))]
    h = c
    for n in range(2, 6):
        h = (h[:-1] ^ (c[n - 1 :] * np.uint32(668265263))) * np.uint32(374761393)
        h ^= h >> np.uint32(13)
        if n > 2:
            inside = np.flatnonzero(word[: len(h)] == word[n - 1 :])
            hashes.append((h[inside] * np.uint32(3266489917)) >> shift)
            of.append(word[inside])
    hashes, of = np.concatenate(hashes), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return hashes[order].astype(np.int64), np.searchsorted(of[order], np.arange(len(words)))


def sum_rows(table: np.ndarray, features: np.ndarray, starts: np.ndarray, many: np.ndarray, roots: np.ndarray | None = None) -> np.ndarray:
    """For each word the sum of its features' rows, divided by ``roots``, or the root of their number: of all words' first features, then the second ones."""
    out = np.zeros((len(starts), table.shape[1]), np.float32)
    order = np.argsort(-many, kind="stable")
    counts, first = many[order], starts[order]
    # Few words are that long; each is summed by itself.
    long = int(np.searchsorted(-counts, -LONG_WORD))
    for k in range(long):
        for lo in range(0, counts[k], 1 << 16):
            out[order[k]] += table[features[first[k] + lo : first[k] + min(lo + (1 << 16), counts[k])]].sum(axis=0)
    for lo in range(long, len(order), 1 << 12):
        hi = min(lo + (1 << 12), len(order))
        some = np.zeros((hi - lo, table.shape[1]), np.float32)
        ends = np.searchsorted(-counts[lo:hi], -np.arange(counts[lo]))
        for j, n in enumerate(ends.tolist()):
            some[:n] += table.take(features[first[lo : lo + n] + j], axis=0, mode="clip")
        out[order[lo:hi]] = some
    return out / (np.sqrt(np.maximum(many, 1), dtype=np.float32) if roots is None else roots)[:, None]


def plain_texts(texts: pa.Array) -> pa.Array:
    """Texts lower-cased, with a space for all that is between runs of letters, digits and low lines. No text is null."""
    return pc.replace_substring_regex(pc.utf8_lower(texts.cast(pa.string())), r"[^\pL\pN_]+", " ")


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``plain_words`` of texts; words are runs of letters, digits and low lines, lower-cased. No text is null."""
    return plain_words(plain_texts(texts))


def plain_words(plain: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, the texts' words as places in them, how many each text has) of texts between spaces."""
    split = pc.split_pattern(plain, " ")
    coded = split.flatten().dictionary_encode()
    words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    sizes = np.diff(split.offsets.to_numpy())
    if "" in words:
        # What stands before the first and behind the last word.
        empty = words.index("")
        keep = codes != empty
        before = np.r_[0, np.cumsum(keep)]
        ends = np.cumsum(sizes)
        sizes = before[ends] - before[ends - sizes]
        del words[empty]
        codes = codes[keep]
        codes = codes - (codes > empty)
    return words, codes.astype(np.int64), sizes.astype(np.int64)


def padded(ids: np.ndarray, sizes: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts with PADDING pads behind each, and where each begins: windows begin at every word and at the first pad."""
    ends = np.cumsum(sizes)
    return np.insert(ids, np.repeat(ends, PADDING), pad), np.arange(len(sizes)) * PADDING + ends - sizes


@dataclass
class Model:
    """Of filters f of width k and place j in their window, ``filters[k][j]`` is DIM x FILTERS."""

    rows: np.ndarray
    filters: list[np.ndarray]
    offsets: np.ndarray
    weights: np.ndarray
    bias: float
    langs: list[str] = field(default_factory=list)
    speech: np.ndarray | None = None
    prior: np.ndarray | None = None
    thresholds: np.ndarray | None = None
    temperature: float = 1.0

    def embed(self, words: list[str]) -> np.ndarray:
        """Embeddings of the words, with what they say of the language behind, and a zero row at the end."""
        table = self.rows if self.speech is None else np.concatenate([self.rows, self.speech], axis=1)
        out = np.zeros((len(words) + 1, table.shape[1]), np.float32)
        if words:
            features, starts = word_features(words)
            out[:-1] = sum_rows(table, features, starts, np.diff(np.r_[starts, len(features)]))
        return out

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(logit, number of the guessed language) of each text; none is null."""
        words, ids, sizes = words_of(texts)
        x = self.embed(words)
        flat, first = padded(ids, sizes, len(words))
        pooled = np.concatenate([pool(x[:, :DIM], flat, first, sizes + 1, w) for w in self.filters], axis=1)
        z = np.maximum(pooled + self.offsets, 0) @ self.weights + self.bias
        if not self.langs:
            return z, np.zeros(len(texts), np.int64)
        spoken, ends = x[:, DIM:], np.cumsum(sizes)
        lang = np.tile(self.prior, (len(texts), 1))
        for lo in range(0, len(ids), POSITIONS):
            hi = min(lo + POSITIONS, len(ids))
            some = np.flatnonzero((ends > lo) & (ends - sizes < hi) & (sizes > 0))
            lang[some] += np.add.reduceat(spoken[ids[lo:hi]], np.maximum(ends[some] - sizes[some] - lo, 0))
        return z, lang.argmax(axis=1)

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability-like scores: 0.5 is the threshold of the guessed language."""
        z, lang = self.scores(texts)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(z - self.thresholds[lang]) / self.temperature))


def pool(x: np.ndarray, flat: np.ndarray, first: np.ndarray, windows: np.ndarray, filters: np.ndarray) -> np.ndarray:
    """The largest response of each filter of one width over each text's windows, a bounded number of positions at a time."""
    projected = [x @ f for f in filters]
    out = np.full((len(first), filters.shape[2]), -np.inf, np.float32)
    ends = first + windows
    for lo in range(0, len(flat), POSITIONS):
        hi = min(lo + POSITIONS, len(flat))
        some = np.flatnonzero((ends > lo) & (first < hi))
        if not len(some):
            continue
        response = projected[0].take(flat[lo:hi], axis=0, mode="clip")
        for j in range(1, len(filters)):
            behind = flat[lo + j : hi + j]
            response[: len(behind)] += projected[j].take(behind, axis=0, mode="clip")
        edges = np.stack([np.maximum(first[some], lo) - lo, np.minimum(ends[some], hi) - lo], axis=1).ravel()
        # reduceat takes no end at the array's end: a row that nothing reads stands behind it.
        response = np.vstack([response, np.full((1, response.shape[1]), -np.inf, np.float32)])
        out[some] = np.maximum(out[some], np.maximum.reduceat(response, edges)[::2])
    return out


def untrained(seed: int = 0) -> Model:
    rng = np.random.default_rng(seed)
    rows = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    filters = [rng.normal(0, 1 / np.sqrt(k * DIM), (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
    n = FILTERS * len(WIDTHS)
    return Model(rows, filters, np.zeros(n, np.float32), rng.normal(0, 0.3, n).astype(np.float32), 0.0, thresholds=np.zeros(1))


@dataclass
class Corpus:
    """Texts as numbers of distinct words, text i's up to ``ends[i]``; features of word w from ``starts[w]`` on, ``many[w]`` of them. ``roots[w]`` is the root of their number before any were left out."""

    words: list[str]
    ids: np.ndarray
    sizes: np.ndarray
    features: np.ndarray
    starts: np.ndarray
    many: np.ndarray
    roots: np.ndarray

    @classmethod
    def of(cls, plain: pa.Array, common: np.ndarray | None = None, at_a_time: int = 50_000) -> Corpus:
        """Of texts as ``plain_texts`` gives them; with only their ``common`` features, if given."""
        words, ids, sizes = plain_words(plain)
        found, many, roots = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
        for lo in range(0, len(words), at_a_time):
            features, starts = word_features(words[lo : lo + at_a_time])
            n = np.diff(np.r_[starts, len(features)])
            roots.append(np.sqrt(n, dtype=np.float32))
            if common is not None:
                keep = common[features]
                features, n = features[keep], np.add.reduceat(keep, starts, dtype=np.int64)
            found.append(features.astype(np.int32))
            many.append(n)
        many = np.concatenate(many)
        return cls(words, ids.astype(np.int32), sizes, np.concatenate(found), np.cumsum(many) - many, many, np.concatenate(roots))

    def __post_init__(self) -> None:
        self.ends = np.cumsum(self.sizes)

    def text(self, i: int) -> np.ndarray:
        return self.ids[self.ends[i] - self.sizes[i] : self.ends[i]]

    def features_of(self, words: np.ndarray) -> np.ndarray:
        """The features of some words, one word after the other."""
        n = self.many[words]
        return self.features[np.repeat(self.starts[words] - np.cumsum(n) + n, n) + np.arange(n.sum())]


def texts_with(corpus: Corpus, texts: Iterable[int]) -> np.ndarray:
    """For each feature, in how many of the numbered texts it is."""
    met, seen = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, bool)
    for i in texts:
        seen[:] = False
        seen[corpus.features_of(np.unique(corpus.text(i)))] = True
        met += seen
    return met


def speech_counts(corpus: Corpus, texts: np.ndarray, at_a_time: int = 50_000) -> np.ndarray:
    """How often each feature occurs in the numbered texts."""
    seen = np.bincount(np.concatenate([corpus.text(i) for i in texts.tolist()]), minlength=len(corpus.words))
    used, out = np.flatnonzero(seen), np.zeros(1 << BITS, np.int64)
    for lo in range(0, len(used), at_a_time):
        some = used[lo : lo + at_a_time]
        out += np.bincount(corpus.features_of(some), np.repeat(seen[some], corpus.many[some]), minlength=1 << BITS).astype(np.int64)
    return out


def set_languages(m: Model, counts: dict[str, np.ndarray], docs: dict[str, int]) -> None:
    """Log-probabilities of features in each language, with add-one smoothing.

    A word's is a sum over its features, divided by the root of their number like its embedding.
    """
    m.langs = sorted(docs)
    if not m.langs:
        return
    m.speech = np.empty((1 << BITS, len(m.langs)), np.float32)
    for k, lang in enumerate(m.langs):
        n = counts.get(lang, np.zeros(1 << BITS, np.int64)) + 1.0
        m.speech[:, k] = np.log(n / n.sum())
    many = np.array([docs[x] for x in m.langs])
    m.prior = np.log(many / many.sum())


class Learner:
    """A model in training: Adagrad on the logistic loss, both labels with equal weight. A maximum's gradient goes to the window that holds it.

    ``common`` marks the features with a row. A feature of few texts tells these texts apart, not the labels: its row is zero and stays so.
    """

    def __init__(self, common: np.ndarray, share: float, seed: int = 0) -> None:
        self.model, self.common, self.share = untrained(seed), common, share
        m = self.model
        m.rows[~common] = 0
        self.squares = {"rows": np.full(1 << BITS, 1e-6, np.float32), "offsets": np.full(len(m.offsets), 1e-6), "weights": np.full(len(m.weights), 1e-6), "bias": np.full(1, 1e-6)}
        self.squares |= {k: np.full(f.shape, 1e-6) for k, f in enumerate(m.filters)}

    def small(self) -> np.ndarray:
        """Everything but the rows and their squares, one after the other."""
        m, q = self.model, self.squares
        return np.concatenate([np.ravel(x) for x in (*m.filters, m.offsets, m.weights, m.bias, *(q[k] for k in (*range(len(m.filters)), "offsets", "weights", "bias")))])

    def set_small(self, values: np.ndarray) -> None:
        m, at = self.model, 0

        def take(like: np.ndarray) -> np.ndarray:
            nonlocal at
            at += like.size
            return values[at - like.size : at].reshape(like.shape).astype(like.dtype)

        m.filters = [take(f) for f in m.filters]
        m.offsets, m.weights, m.bias = take(m.offsets), take(m.weights), float(take(np.zeros(1))[0])
        self.squares |= {k: take(self.squares[k]) for k in (*range(len(m.filters)), "offsets", "weights", "bias")}

    def learn(self, corpus: Corpus, labels: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over the texts of a corpus of common features, in random order."""
        m, q = self.model, self.squares
        weight = np.where(labels == 1, 0.5 / self.share, 0.5 / (1 - self.share))

        def step(name: str | int, value: np.ndarray, grad: np.ndarray) -> np.ndarray:
            q[name] += grad * grad
            return (value - RATE * grad / np.sqrt(q[name])).astype(np.float32)

        for some in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // BATCH)):
            lines = [corpus.text(i) for i in some.tolist()]
            sizes = np.array(list(map(len, lines)))
            used, local = np.unique(np.concatenate(lines), return_inverse=True)
            lengths = corpus.many[used]
            x = np.zeros((len(used) + 1, DIM), np.float32)
            x[:-1] = sum_rows(m.rows, corpus.features, corpus.starts[used], lengths, corpus.roots[used])
            flat, first = padded(local, sizes, len(used))
            found = [tops(x, flat, first, sizes + 1, f) for f in m.filters]
            pooled = np.concatenate([best for best, _ in found], axis=1) + m.offsets
            active = np.maximum(pooled, 0)
            z = active @ m.weights + m.bias
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]) * weight[some] / len(some)).astype(np.float32)
            back = np.where(pooled > 0, g[:, None] * m.weights, 0).astype(np.float32)
            dx = np.zeros_like(x)
            grads = []
            for k, (f, (_, top)) in enumerate(zip(m.filters, found, strict=True)):
                mine = back[:, k * FILTERS : (k + 1) * FILTERS]
                df = np.zeros_like(f)
                for j in range(len(f)):
                    hit = flat[top + j]
                    df[j] = np.einsum("ifd,if->df", x[hit], mine)
                    np.add.at(dx, hit.ravel(), (mine[:, :, None] * f[j].T[None]).reshape(-1, DIM))
                grads.append(df)
            m.filters = [step(k, f, df) for k, (f, df) in enumerate(zip(m.filters, grads, strict=True))]
            m.weights = step("weights", m.weights, active.T @ g)
            m.offsets = step("offsets", m.offsets, back.sum(axis=0))
            m.bias = float(step("bias", np.array([m.bias]), g.sum(keepdims=True))[0])
            touched = np.flatnonzero(np.any(dx[:-1], axis=1) & (lengths > 0))
            if len(touched):
                grad = np.repeat(dx[touched] / corpus.roots[used[touched]][:, None], lengths[touched], axis=0)
                rows, inverse = np.unique(corpus.features_of(used[touched]), return_inverse=True)
                total = np.zeros((len(rows), DIM), np.float32)
                np.add.at(total, inverse, grad)
                q["rows"][rows] += (total * total).mean(axis=1)
                m.rows[rows] -= RATE * total / np.sqrt(q["rows"][rows])[:, None]


def tops(x: np.ndarray, flat: np.ndarray, first: np.ndarray, windows: np.ndarray, filters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like ``pool``, with the place in ``flat`` where each largest response begins."""
    projected = [x @ f for f in filters]
    best, top = np.full((len(first), filters.shape[2]), -np.inf, np.float32), np.zeros((len(first), filters.shape[2]), np.int64)
    ends = first + windows
    for lo in range(0, len(flat), POSITIONS):
        hi = min(lo + POSITIONS, len(flat))
        response = projected[0].take(flat[lo:hi], axis=0, mode="clip")
        for j in range(1, len(filters)):
            behind = flat[lo + j : hi + j]
            response[: len(behind)] += projected[j].take(behind, axis=0, mode="clip")
        for i in np.flatnonzero((ends > lo) & (first < hi)).tolist():
            a = max(int(first[i]), lo) - lo
            mine = response[a : min(int(ends[i]), hi) - lo]
            at = mine.argmax(axis=0)
            value = mine[at, np.arange(mine.shape[1])]
            better = value > best[i]
            best[i][better], top[i][better] = value[better], at[better] + a + lo
    return best, top


def best_threshold(z: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The middle of the gap between two logits that gives label 1 the best F1 measure; of equals the widest gap. ``z`` ascends without repeats, with the numbers of texts of either label."""
    if len(z) == 1:
        return float(z[0])
    s, y, n = z[::-1], toxic[::-1], (toxic + clean)[::-1]
    f1 = 2 * np.cumsum(y)[:-1] / (np.cumsum(n)[:-1] + y.sum())
    k = int(np.lexsort((s[1:] - s[:-1], -f1))[0])
    return float((s[k] + s[k + 1]) / 2)


def steps_of(z: np.ndarray) -> np.ndarray:
    """Logits as whole numbers of 1 / STEPS."""
    return np.rint(np.clip(z, -MOST_LOGIT, MOST_LOGIT) * STEPS).astype(np.int64)


def calibrate(m: Model, guessed: np.ndarray, labels: np.ndarray, steps: np.ndarray, n: np.ndarray) -> None:
    """A threshold for each language with enough toxic documents, that of all texts for the others; and one temperature.

    ``n`` texts of a language, a label and a logit in ``steps_of``, of all texts that thresholds are set on.
    """

    def threshold(some: np.ndarray) -> float:
        z, place = np.unique(steps[some], return_inverse=True)
        toxic = np.bincount(place, n[some] * labels[some], len(z))
        return best_threshold(z / STEPS, toxic, np.bincount(place, n[some], len(z)) - toxic)

    both = (labels == 1).any() and (labels == 0).any()
    m.thresholds = np.full(max(1, len(m.langs)), threshold(np.ones(len(n), bool)) if both else 0.0)
    for k in range(len(m.langs)):
        mine = guessed == k
        if n[mine & (labels == 1)].sum() >= LEAST_TOXIC and (labels[mine] == 0).any():
            m.thresholds[k] = threshold(mine)
    if both:
        s = steps / STEPS - m.thresholds[guessed]

        def loss(t: float) -> float:
            return float(np.average(np.logaddexp(0, np.where(labels == 1, -s, s) / t), weights=n))

        m.temperature = min(np.exp(np.linspace(np.log(0.2), np.log(20), 60)).tolist(), key=loss)


def one_label(label: int | None) -> Model:
    """The model where all labels are equal, or none is given."""
    m = untrained()
    m.weights[:] = 0
    m.bias = 0.0 if label is None else (4.0 if label else -4.0)
    return m


def fit(texts: list[str], labels: list[int], langs: list[str | None], epochs: int = EPOCHS, seed: int = 0) -> Model:
    """The model of texts in memory, a single shard: every fifth is kept from the filters and sets thresholds and temperature."""
    y = np.array(labels, np.int64)
    rest = np.arange(len(y)) % 5 == 0
    if not kept_apart([(int(a), int(b), 1) for a, b in zip(y, rest, strict=True)]):
        rest = np.zeros(len(y), bool)
    plain = plain_texts(pa.array(texts, pa.string()))
    corpus, learn = Corpus.of(plain), np.flatnonzero(~rest)
    if len(set(y[learn].tolist())) < 2:
        m = one_label(int(y[0]) if len(y) else None)
    else:
        learner = Learner(texts_with(corpus, learn.tolist()) >= LEAST_TEXTS, y[learn].mean(), seed)
        mine = Corpus.of(plain.take(pa.array(learn)), learner.common)
        for k in range(epochs):
            learner.learn(mine, y[learn], np.random.default_rng((seed, k)))
        m = learner.model
    spoken = {x: np.flatnonzero([x == y for y in langs]) for x in set(langs) - {None}}
    set_languages(m, {x: speech_counts(corpus, i) for x, i in spoken.items()}, {x: len(i) for x, i in spoken.items()})
    test = np.flatnonzero(rest) if rest.any() else learn
    z, guessed = m.scores(plain.take(pa.array(test)))
    calibrate(m, guessed, y[test], steps_of(z), np.ones(len(test), np.int64))
    return m


def kept_apart(counts: list[tuple[int, int, int]]) -> bool:
    """Whether thresholds are set on texts of their own: of (label, whether kept apart, number of texts) either side has both labels."""
    return sum(n for _, _, n in counts) >= 10 and all({label for label, apart, _ in counts if apart == side} == {0, 1} for side in (True, False))


def _asked(shared, bits: int):
    """Of documents (id, h, lang, text), as plain texts, those whose h, the first ``bits`` bits of their id's hash, is in the filter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(b.schema.get_field_index("h")).to_numpy()
            for part in text_blocks([b.filter(pa.array((shared.value[h >> 6] >> (h & 63) & 1).astype(bool)))], limit=BLOCK_BYTES):
                yield batch(_PLAIN, [part.column(part.schema.get_field_index(c)) for c in ("id", "lang")] + [plain_texts(part.column(part.schema.get_field_index("text")))])

    return run


def _slices(source: int, key: str | None, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k, lo in enumerate(range(0, len(values), SLICE)):
        yield batch(_SLICES, [[source], [key], [k], [values[lo : lo + SLICE].tobytes()]])


def summed(parts: DataFrame, dtype: type) -> dict[str | None, np.ndarray]:
    """Arrays by key, added up by Spark: the driver gathers one array a key. ``parts``: source, key, slice, values of the dtype."""

    def add(table: pa.Table) -> pa.Table:
        # In the order of the sources: a sum of floats depends on it.
        table = table.sort_by("source")
        total = np.sum([np.frombuffer(v.as_buffer(), dtype) for v in table.column("values")], axis=0, dtype=dtype)
        return pa.table({"key": table.column("key").slice(0, 1), "slice": table.column("slice").slice(0, 1), "values": pa.array([total.tobytes()], pa.binary())})

    out: dict[str | None, list] = {}
    for r in parts.groupBy("key", "slice").applyInArrow(add, "key string, slice int, values binary").toArrow().sort_by("slice").to_pylist():
        out.setdefault(r["key"], []).append(np.frombuffer(r["values"], dtype))
    return {k: np.concatenate(v) for k, v in out.items()}


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often features occur by language; for key null, in how many of the texts that filters learn from."""
    met, spoken, source = np.zeros(1 << BITS, np.int64), {}, None
    for part in text_blocks(batches, limit=BLOCK_BYTES):
        source = TaskContext.get().partitionId()
        corpus = Corpus.of(part.column(part.schema.get_field_index("text")))
        met += texts_with(corpus, np.flatnonzero(~np.array(part.column(part.schema.get_field_index("rest")))).tolist())
        langs = part.column(part.schema.get_field_index("lang")).dictionary_encode()
        codes = langs.indices.fill_null(-1).to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            spoken[lang] = spoken.get(lang, 0) + speech_counts(corpus, np.flatnonzero(codes == k))
            if len(spoken) >= LANGS_HELD:
                for x in sorted(spoken):
                    yield from _slices(source, x, spoken[x])
                spoken = {}
    if source is not None:
        for x in sorted(spoken):
            yield from _slices(source, x, spoken[x])
        yield from _slices(source, None, met)


def _learned(shared, round_: int, seed: int):
    """What a task's pass changes in the learner, times its texts: rows, squares of rows, texts of a task that changed a row, everything else, texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, source, n = shared.value, TaskContext.get().partitionId(), 0
        mine, rng = copy.deepcopy(given), np.random.default_rng((seed, round_, source))
        for part in text_blocks(batches, limit=BLOCK_BYTES):
            mine.learn(Corpus.of(part.column(part.schema.get_field_index("text")), given.common), part.column(part.schema.get_field_index("label")).to_numpy(), rng)
            n += part.num_rows
        if n:
            squares = mine.squares["rows"] - given.squares["rows"]
            change = np.concatenate([(mine.model.rows - given.model.rows).ravel(), squares, squares > 0, mine.small() - given.small(), [1.0]]) * n
            yield from _slices(source, None, change.astype(np.float32))

    return run


def join_learned(learner: Learner, total: np.ndarray) -> None:
    """The learner of the next round: the mean of the tasks, weighted by their texts; of a row that of the tasks that changed it."""
    n = 1 << BITS
    rows, squares, by, small = np.split(total, [n * DIM, n * (DIM + 1), n * (DIM + 2)])
    by = np.maximum(by, 1)
    learner.model.rows += (rows.reshape(n, DIM) / by[:, None]).astype(np.float32)
    learner.squares["rows"] += (squares / by).astype(np.float32)
    learner.set_small(learner.small() + small[:-1] / small[-1])


def _logits(shared):
    """(guessed language, label, step, texts) of the texts of each block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_blocks(batches, limit=BLOCK_BYTES):
            z, guessed = shared.value.scores(part.column(part.schema.get_field_index("text")))
            found, n = np.unique(np.stack([guessed, part.column(part.schema.get_field_index("label")).to_numpy(), steps_of(z)]), axis=1, return_counts=True)
            yield batch(_LOGITS, [*found, n])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", size: int = SHARD_TEXTS, chars: int = SHARD_CHARS, epochs: int = EPOCHS, seed: int = 0) -> Model:
    """The model of all labelled documents whose CRC-32 of the id isn't divisible by 5.

    They are dealt by their id to shards of about ``size`` texts or ``chars`` characters, and these to tasks. In each of ``epochs`` rounds
    every task learns all its texts, from the model of the round before, and the models of the tasks are averaged. A fifth of the
    documents, by another hash, is kept from the filters and sets thresholds and temperature; counts of features by language
    are of all. The driver holds the model and sums, no texts. Labels other than 0 and 1, null labels, ids and texts
    aren't learned from; a row of ``docs`` counts each time it stands there. Without labels the model scores everything 0.5 or less.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1) and crc32(encode(cast(id as string), 'UTF-8')) % 5 <> 0").distinct()
    own = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("id is not null and text is not null")
    rest = F.pmod(F.xxhash64("id", F.lit("rest")), F.lit(5)) == 0
    known, known_path = materialize(own.select("id", "lang", F.char_length("text").alias("size")).join(marked, "id").withColumn("rest", rest), "toxic-labelled")
    found = known.groupBy("label", "rest", "lang").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    if not found:
        return one_label(None)
    apart = kept_apart([(r["label"], r["rest"], r["n"]) for r in found])
    n = sum(r["n"] for r in found)
    shards = max(1, -(-n // size), -(-sum(r["size"] for r in found) // chars))
    # Texts without a label aren't shuffled: a filter of bounded size tells most of them, the join the rest.
    bits = min(MOST_BITS, max(16, (32 * n).bit_length()))
    asked = spark.sparkContext.broadcast(_id_filter(known.select(F.col("id").alias("rep")), bits))
    plain = own.select("id", F.shiftrightunsigned(F.xxhash64("id"), 64 - bits).alias("h"), "lang", "text").mapInArrow(_asked(asked, bits), "id bigint, lang string, text string")
    # Both sides are dealt to the shards, so that the join moves a text once; the table has a file a shard.
    dealt = plain.repartition(shards, "id").join(marked.repartition(shards, "id"), "id").select((rest if apart else F.lit(False)).alias("rest"), "id", "label", "lang", "text")
    ordered = dealt.sortWithinPartitions("rest", F.xxhash64("id", F.lit("order")), "id", "label", "lang", "text")
    table, table_path = materialize(ordered.drop("id"), "toxic-shards")
    # What tasks hand over is as large as the model, so their number grows only with the root of that of the shards.
    table = table.coalesce(min(shards, 2 * math.ceil(math.sqrt(shards))))
    forget(spark, known_path)
    learn = [r for r in found if not (apart and r["rest"])]
    toxic = sum(r["n"] for r in learn if r["label"])
    counts = summed(table.mapInArrow(_counts, _SLICES_DDL), np.int64)
    if len({r["label"] for r in learn}) < 2:
        m = one_label(learn[0]["label"])
    else:
        learner = Learner(counts[None] >= LEAST_TEXTS, toxic / sum(r["n"] for r in learn), seed)
        for k in range(epochs):
            shared = spark.sparkContext.broadcast(learner)
            join_learned(learner, summed(table.where("not rest").mapInArrow(_learned(shared, k, seed), _SLICES_DDL), np.float32)[None])
            shared.destroy()
        m = learner.model
    docs_of: dict[str, int] = {}
    for r in found:
        if r["lang"] is not None:
            docs_of[r["lang"]] = docs_of.get(r["lang"], 0) + r["n"]
    set_languages(m, counts, docs_of)
    shared = spark.sparkContext.broadcast(m)
    logits = table.where("rest" if apart else "true").mapInArrow(_logits(shared), "guessed bigint, label bigint, step bigint, n bigint").groupBy("guessed", "label", "step").agg(F.sum("n").alias("n")).toArrow()
    calibrate(m, *(logits.column(c).to_numpy() for c in ("guessed", "label", "step", "n")))
    shared.destroy()
    forget(spark, table_path)
    return m


def toxicity(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", model: Model | None = None) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted (1 if score >= 0.5).

    Only the text is scored, all of it, whatever its length; null counts as empty, and texts without words have the
    score of an empty one. held_out rows (CRC-32 of the id as text divisible by 5) are never learned from. Rows that repeat an id are scored each by
    its own text; a null id is not held out. An empty table gives an empty result; other
    columns are ignored. ``model`` stands in for one trained on ``labels``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels, id_col, text_col, lang_col, label_col))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_blocks(batches, limit=BLOCK_BYTES):
            ids = part.column(part.schema.get_field_index("doc_id"))
            s = shared.value.score(part.column(part.schema.get_field_index("text"))).astype(np.float64)
            yield batch(_OUT, [ids, [held_out(i) for i in ids.to_pylist()], s, (s >= 0.5).astype(np.int32)])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")

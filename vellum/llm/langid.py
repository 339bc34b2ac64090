"""Operator 5, language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters of the lower-cased text in runs of one to three are hashed to ``2**bits``
features. Document frequencies are counted over all training documents. The weights are
fitted by follow-the-regularised-leader (FTRL-proximal) with L1 and L2 penalties on a
bounded sample of them, drawn by a hash at a rate for each language; a part of the sample
that the fit doesn't see sets the temperature. The model holds the weights that aren't zero, by
feature, and is broadcast; its size depends on the number of languages, not of documents, and is
``2**bits`` times that number at most. Every language of the training documents is learned.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import batch, rows

BITS = 15
#: Expected number of sampled training documents of one language, and of all the sample's features: they go to the driver.
SAMPLE_PER_LANG, SAMPLE_FEATURES = 600, 30_000_000
#: Expected sampled documents of a language at least, however many languages there are.
LEAST_PER_LANG = 20
_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
_FEATURES = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("lang", pa.string()), ("feature", pa.list_(pa.int32())), ("tf", pa.list_(pa.float32()))])
_DF = pa.schema([("feature", pa.int32()), ("n", pa.int64())])


def held_out(doc_id: int | None) -> bool:
    """Whether crc32 of the id as text leaves 2 on division by 4; never for a null id."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def features(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 1- to 3-grams of a text's characters and 1 + log of their counts."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(c):
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    shift = np.uint32(32 - bits)
    a = c * np.uint32(2654435761)
    codes = [a >> shift]
    if len(c) > 1:
        b = (a[:-1] ^ (c[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
        codes.append(b >> shift)
        if len(c) > 2:
            codes.append(((b[:-1] ^ (c[2:] * np.uint32(668265263))) * np.uint32(374761393)) >> shift)
    counts = np.bincount(np.concatenate(codes), minlength=1 << bits)
    at = np.flatnonzero(counts)
    return at.astype(np.int32), (1 + np.log(counts[at])).astype(np.float32)


def unit_tfidf(at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = tf * idf[at]
    norm = np.linalg.norm(x)
    return x / norm if norm else x


@dataclass
class Model:
    """Weight k of a feature f stands at ``edges[f] <= k < edges[f + 1]``, for the language ``columns[k]``; others are zero."""

    langs: list[str]
    idf: np.ndarray
    edges: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    bits: int = BITS

    def logits(self, at: np.ndarray, tf: np.ndarray) -> np.ndarray:
        x, low = unit_tfidf(at, tf, self.idf).astype(np.float64), self.edges[at]
        many = self.edges[at + 1] - low
        where = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.bincount(self.columns[where], self.values[where] * np.repeat(x, many), minlength=len(self.langs)) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language (of equals the first by name) and its calibrated probability; ('und', 0) without a letter or a model."""
        if not self.langs or not has_letter(text):
            return "und", 0.0
        z = self.logits(*features(text, self.bits)) / self.temperature
        p = np.exp(z - z.max())
        best = int(p.argmax())
        return self.langs[best], float(p[best] / p.sum())


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], n_features: int, n_classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, epochs: int = 4, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal for softmax regression; (weights, bias). L1 keeps most weights at exactly zero."""
    z, n = np.zeros((n_features + 1, n_classes)), np.zeros((n_features + 1, n_classes))

    def weights(at):
        zz = z[at]
        w = -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zz) <= l1, 0.0, w)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            at, x, y = examples[i]
            at, x = np.append(at, n_features), np.append(x, 1.0)
            w = weights(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(slice(None))
    return w[:-1], w[-1]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        s = logits / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(labels)), labels]).mean())

    a, b, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _training(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Documents to learn from: not held out, with a language and a text."""
    out = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return out.where("doc_id is not null and lang is not null and text is not null and crc32(encode(cast(doc_id as string), 'UTF-8')) % 4 <> 2")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_per_lang: int = SAMPLE_PER_LANG, max_langs: int | None = None, bits: int = BITS) -> Model:
    """Fit the model; an empty one if there is nothing to learn from.

    The driver gathers one row a language, one a feature, and the sparse features of about
    ``sample_per_lang`` documents of each language, or fewer if documents are so long or
    languages so many that these would be over ``SAMPLE_FEATURES`` in all, but no fewer than
    ``LEAST_PER_LANG`` (or all that it has): beyond that, the sample grows with the number of languages, not of documents. Rows that repeat
    an id and its text are one document of the sample. More languages than ``max_langs``, if
    it is given, are an error: none is left out.
    """
    learn = _training(docs, id_col, text_col, lang_col)
    per_lang = {r["lang"]: (r["n"], r["size"]) for r in learn.groupBy("lang").agg(F.count("*").alias("n"), F.avg(F.char_length("text")).alias("size")).collect()}
    if max_langs is not None and len(per_lang) > max_langs:
        raise ValueError(f"{len(per_lang)} languages, but max_langs is {max_langs}")
    langs = sorted(per_lang)
    if not langs:
        return Model([], np.ones(1 << bits, np.float32), np.zeros((1 << bits) + 1, np.int64), np.zeros(0, np.int32), np.zeros(0), np.zeros(0), 1.0, bits)

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        for (texts,) in rows(batches, ["text"]):
            for t in texts:
                counts[features(t, bits)[0]] += 1
        at = np.flatnonzero(counts)
        if len(at):
            yield batch(_DF, [at.astype(np.int32), counts[at]])

    df = np.zeros(1 << bits, np.int64)
    for r in learn.select("text").mapInArrow(frequencies, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        df[r["feature"]] = r["n"]
    idf = (np.log((1 + sum(n for n, _ in per_lang.values())) / (1 + df)) + 1).astype(np.float32)

    # A share of each language, by a hash of id and text: no sort, the same documents every time.
    # A document has three features a character at most. One small row a language is broadcast.
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    wanted = {lang: min(sample_per_lang, max(LEAST_PER_LANG, SAMPLE_FEATURES / len(langs) / min(1 << bits, 3 * size + 1))) for lang, (_, size) in per_lang.items()}
    shares = docs.sparkSession.createDataFrame([(lang, int((1 << 30) * min(1.0, wanted[lang] / n))) for lang, (n, _) in per_lang.items()], "lang string, share long")
    chosen = learn.join(F.broadcast(shares), "lang").where(draw < F.col("share")).select("doc_id", "lang", "text").distinct()

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, names, texts in rows(batches, ["doc_id", "h", "lang", "text"]):
            found = [features(t, bits) for t in texts]
            yield batch(_FEATURES, [ids, hashes, names, [a for a, _ in found], [x for _, x in found]])

    sample = chosen.select("doc_id", F.xxhash64("text").alias("h"), "lang", "text").mapInArrow(extract, "doc_id bigint, h bigint, lang string, feature array<int>, tf array<float>").toArrow()
    order = np.lexsort((sample.column("h").to_numpy(), sample.column("doc_id").to_numpy()))
    feature, tf, lang = sample.column("feature").combine_chunks(), sample.column("tf").combine_chunks(), sample.column("lang").to_pylist()
    number = {x: i for i, x in enumerate(langs)}
    examples = []
    for i in order.tolist():
        at = feature[i].values.to_numpy()
        examples.append((at, unit_tfidf(at, tf[i].values.to_numpy(), idf), number[lang[i]]))
    fit = [e for i, e in enumerate(examples) if i % 5] or examples
    weights, bias = ftrl(fit, 1 << bits, len(langs))
    rest = examples[::5]
    temperature = calibrate(np.array([x.astype(np.float64) @ weights[at] + bias for at, x, _ in rest]), np.array([y for _, _, y in rest]))
    row, column = np.nonzero(weights)
    edges = np.searchsorted(row, np.arange((1 << bits) + 1))
    return Model(langs, idf, edges, column.astype(np.int32), weights[row, column], bias, temperature, bits)


def language_column(model: Model):
    """A function of a text column: struct(lang_pred, score), as in ``language_id``."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return run


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: Model | None = None) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    lang_pred is a learned language (of equally likely ones the first by name), or ``und`` with score 0 if the text is null, has no
    letter, or nothing could be learned. Whole texts are read. Ids may repeat; a null id is
    neither held out nor learned from. An empty table gives an empty result; other columns
    are ignored, and language, source and id are no inputs of a prediction.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, id_col, text_col, lang_col))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows(batches, ["doc_id", "text"]):
            found = [shared.value.predict(t) for t in texts]
            yield batch(_OUT, [ids, [held_out(i) for i in ids], [x for x, _ in found], [x for _, x in found]])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")

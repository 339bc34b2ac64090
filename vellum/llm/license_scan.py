"""Operator 9, license scans: a positional index of rare licence words.

Templates are the operative words of licences, each with a mandatory key phrase, and the
names of licences, which are their own key phrase. The rarity of the templates' words is
counted over all documents. The index holds the rarest words of each template, with all
their places in it. A file's indexed words are looked up, the rarest first; each place of
such a word says where the template would begin. Beginnings that lie close together are one
place (words may have been left out or put in between), and it counts if the words that vote
for it have half the weight of the template's indexed words. There the key phrase is verified in full,
and the share of the template's neighbouring words that also stand side by side there is the
score. A name has no slack: its two rarest words must agree on one beginning.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import batch, id_text, rows
from vellum.llm.license_texts import BASE_PHRASES, BODIES, PHRASES

#: Indexed words of a body, words by which the beginnings of one place differ at most from the next, least share of votes and of a score.
ANCHORS, DRIFT, LEAST_VOTES, LEAST_SCORE = 16, 12, 0.5, 0.6

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])
_OUT_DDL = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
_DF = pa.schema([("word", pa.string()), ("n", pa.int64())])


def words_of(text: str) -> list[bytes]:
    """Runs of digits, ASCII letters (lower-cased) and characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split()


@dataclass(frozen=True)
class Template:
    """``words`` with the key phrase at ``key[0]:key[1]``; names (``body`` false) are their key phrase alone."""

    label: str
    words: tuple[bytes, ...]
    key: tuple[int, int]
    body: bool = True
    base: bool = False


def template(label: str, text: str, key: str | None = None, base: bool = False) -> Template:
    words, phrase = tuple(words_of(text)), tuple(words_of(key or text))
    at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
    return Template(label, words, (at, at + len(phrase)), key is not None, base)


TEMPLATES = (*(template(label, text, base=i < BASE_PHRASES) for i, (label, text) in enumerate(PHRASES)), *(template(label, text, key) for label, key, text in BODIES))


class RareIndex:
    """Postings (template, place) of the rarest words of each template; of equally rare ones the first by spelling."""

    def __init__(self, templates: tuple[Template, ...], idf: dict[bytes, float]):
        self.templates, self.idf = templates, idf
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.anchors: list[list[bytes]] = []
        for i, t in enumerate(templates):
            rarest = sorted(set(t.words), key=lambda w: (-idf[w], w))[: ANCHORS if t.body else 2]
            self.anchors.append(rarest)
            for at, w in enumerate(t.words):
                if w in rarest:
                    self.postings.setdefault(w, []).append((i, at))
        self.weight = [sum(idf[w] for w in a) for a in self.anchors]
        self.pairs = [[(w, v, idf[w] + idf[v]) for w, v in zip(t.words, t.words[1:], strict=False)] for t in templates]

    def begins(self, words: list[bytes]) -> dict[int, list[tuple[int, bytes]]]:
        """Template -> (where it would begin, the word that says so), of the templates that enough indexed words could vote for."""
        met = self.postings.keys() & set(words)
        could = [0.0] * len(self.templates)
        for i in {i for w in met for i, _ in self.postings[w]}:
            could[i] = sum(self.idf[w] for w in self.anchors[i] if w in met)
        alive = {i for i, t in enumerate(self.templates) if could[i] and could[i] >= (LEAST_VOTES if t.body else 1) * self.weight[i]}
        out: dict[int, list[tuple[int, bytes]]] = {i: [] for i in alive}
        for w in sorted(met, key=lambda w: (-self.idf[w], w)):
            wanted = [(i, at) for i, at in self.postings[w] if i in alive]
            if not wanted:
                continue
            places, p = [], -1
            for _ in range(words.count(w)):
                p = words.index(w, p + 1)
                places.append(p)
            for i, at in wanted:
                if not self.templates[i].body and out[i]:
                    # Names: the beginnings must agree, so only those that rarer words gave are kept.
                    known = {b for b, x in out[i] if x != w}
                    out[i] = [(b, w) for b in (p - at for p in places) if b in known] if known else out[i] + [(p - at, w) for p in places]
                else:
                    out[i] += [(p - at, w) for p in places]
        return out

    def places(self, i: int, begins: list[tuple[int, bytes]]) -> Iterator[tuple[int, int]]:
        """(first, last) beginning of each place that has votes enough."""
        begins.sort()
        k = 0
        while k < len(begins):
            j = k + 1
            while j < len(begins) and begins[j][0] - begins[j - 1][0] <= DRIFT:
                j += 1
            if sum(self.idf[w] for w in {w for _, w in begins[k:j]}) >= LEAST_VOTES * self.weight[i]:
                yield begins[k][0], begins[j - 1][0]
            k = j

    def scan(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, place of its key phrase, score) of every verified place; names have score 0."""
        found = []
        for i, begins in sorted(self.begins(words).items()):
            t = self.templates[i]
            a, b = t.key
            key, n = list(t.words[a:b]), len(t.words)
            if not t.body:
                found += [(i, p, 0.0) for p in sorted({p for p, _ in begins}) if p >= 0 and words[p : p + n] == key]
                continue
            for low, high in self.places(i, begins):
                window = words[max(0, low - DRIFT) : max(0, high + n + DRIFT)]
                at = next((p for p in range(len(window) - (b - a) + 1) if window[p] == key[0] and window[p : p + b - a] == key), None)
                if at is None:
                    continue
                side_by_side = set(zip(window, window[1:], strict=False))
                total = sum(x for _, _, x in self.pairs[i])
                score = sum(x for w, v, x in self.pairs[i] if (w, v) in side_by_side) / total
                if score >= LEAST_SCORE:
                    found.append((i, max(0, low - DRIFT) + at, min(1.0, score)))
        return found


def word_rarity(docs: DataFrame, templates: tuple[Template, ...], id_col: str = "doc_id", text_col: str = "text") -> dict[bytes, float]:
    """Inverse document frequency of the templates' words over all documents; the driver gets one row a word."""
    wanted = {w for t in templates for w in t.words}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, Counter()
        for _, texts in rows(batches, ["doc_id", "text"]):
            n += len(texts)
            for t in texts:
                seen.update(wanted.intersection(words_of(t)))
        yield batch(_DF, [[None, *(w.decode() for w in seen)], [n, *seen.values()]])

    counts = {r["word"]: r["n"] for r in id_text(docs, id_col, text_col).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    n = counts.get(None) or 0
    return {w: math.log((1 + n) / (1 + counts.get(w.decode(), 0))) + 1 for w in wanted}


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of base phrases, first_word and last_word are the smallest and
    largest of their starts (null if none). labels also has what the other templates found:
    names that stand in full, and bodies at a verified place. score is the rarity-weighted share
    of the best body that stands at a verified place; 0 if none does, so a name alone scores 0.
    Null text counts as empty: no words, empty labels, score 0. Whole texts are read. Ids may
    repeat or be null. An empty table gives an empty result; other columns are ignored.
    """
    idf = word_rarity(docs, templates, id_col, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RareIndex(templates, idf)
        for ids, texts in rows(batches, ["doc_id", "text"]):
            out = []
            for doc_id, text in zip(ids, texts, strict=True):
                words = words_of(text)
                found = index.scan(words)
                base = [p for i, p, _ in found if templates[i].base]
                out.append((doc_id, len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted({templates[i].label for i, _, _ in found if templates[i].base})), ",".join(sorted({templates[i].label for i, _, _ in found})), max((s for _, _, s in found), default=0.0)))
            yield batch(_OUT, list(map(list, zip(*out, strict=True))))

    return id_text(docs, id_col, text_col).mapInArrow(run, _OUT_DDL)

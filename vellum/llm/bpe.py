"""Byte-level BPE ids from the tokenizers library, with a bounded cache of words.

A byte-level BPE splits a text into words before it merges. A single space or newline
between two visible characters always parts words, so the text between two of them is
encoded alike wherever it stands. Such a unit of common characters is split by the
tokenizer's own word pattern, and the library's model merges each word; the ids of units
that come again are kept, as bytes, until the cache is full. Units with doubtful borders
(runs of white space, unusual characters) go through the whole library together with their
neighbours, and so does a text that holds the string of an added token.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vellum.llm.common import gather

CACHE_WORDS, RECENT_MARKS = 600_000, 50_000
#: Bytes of text that are encoded at a time; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
_VISIBLE = frozenset(map(chr, range(33, 127)))
#: Letters and other visible characters whose class no Unicode version changes.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-Ωά-ώЀ-ҁҊ-ԣא-תء-غف-يぁ-ゖァ-ヺ一-龥가-힣"
_MARK = "!-/:-@\\[-`{-~¡-©«¬®-±´¶-¸»¿×÷‐-‧‰-⁞€、。，！？：；（）「」"
_COMMON = re.compile(rf"[\n\0]?[0-9{_LETTER}{_MARK}]+").fullmatch
_USUAL = re.compile(rf"([{_LETTER}]+)([!-&(-/:-@\[-`{{-~]*)").fullmatch
#: Fixed value: the pattern by which a byte-level tokenizer splits words, for these characters.
_WORDS = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[0-9]+| ?[^\s0-9{_LETTER}]+").findall


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def id_dtype(vocab: int) -> np.dtype:
    return np.dtype("<u2") if vocab <= 1 << 16 else np.dtype("<u4")


def byte_characters() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class WordEncoder:
    """encode_many(texts) gives the library's ids, as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Units of different texts could together make an added token that holds white space;
        # and only this way of splitting is known here.
        plain = re.match(r"ByteLevel\(add_prefix_space=False.*use_regex=True\)", str(self.tokenizer.pre_tokenizer)) and self.tokenizer.normalizer is None
        self.whole = not plain or any(c.isspace() for t in self.added for c in t)
        self.dtype = id_dtype(self.tokenizer.get_vocab_size())
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.bytes_as = byte_characters()
        # Units that came again (behind a space, or with the mark that they begin with), and short words.
        self.cache: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.cache_words = cache_words
        self.met = bytearray(1 << 24)

    def blocks(self, texts: pa.Array, end_id: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the first text, ids one after the other, how many each text has) of runs of texts; ``end_id`` stands behind each text. None is null."""
        texts, at = texts.cast(pa.string()), 0
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        while at < len(texts):
            until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_BYTES, side="right")))
            yield at, *self._block(texts.slice(at, until - at), end_id)
            at = until

    def encode_many(self, texts: list[str]) -> list[bytes]:
        out = []
        for _, ids, sizes in self.blocks(pa.array(texts, pa.string())):
            ends = np.cumsum(sizes)
            out += [ids[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def _block(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Each distinct piece of the block's texts is encoded once; the texts' ids are gathered from these."""
        odd = np.full(len(texts), self.whole)
        for mark in (*self.added, "\0"):
            odd |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        # A piece that begins with a newline stands for itself, one with a zero is a text's first, any other stands behind a space.
        split = pc.split_pattern(pc.binary_join_element_wise("\0", pc.replace_substring(texts, "\n", " \n"), ""), " ")
        first = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        codes, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known: list = list(map(self.cache.get, names))
        often, common = np.bincount(codes, minlength=len(names)) > 1, np.ones(len(names), bool)
        for i in [i for i, x in enumerate(known) if x is None]:
            known[i] = self._unit(names[i], often[i])
            if known[i] is None:
                known[i], common[i] = b"", False
        odd |= ~np.logical_and.reduceat(common[codes], first)
        odd &= pc.not_equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(odd)
        if len(at):
            # All of such a text is one piece.
            keep = ~np.repeat(odd, np.diff(np.r_[first, len(codes)]))
            keep[first[at]], codes[first[at]] = True, len(known) + np.arange(len(at))
            known += self._odd([texts[i].as_py() for i in at.tolist()])
            codes, first = codes[keep], np.cumsum(keep)[first] - 1
        if end_id is not None:
            codes = np.insert(codes, np.r_[first[1:], len(codes)], len(known))
            first = first + np.arange(len(first))
            known.append(np.array([end_id], self.dtype).tobytes())
        return gather(known, codes, first, self.dtype)

    def _odd(self, texts: list[str]) -> list[bytes]:
        """Texts with doubtful borders, unit by unit."""
        asked: dict[tuple[str], bytes] = {}
        plans = [self._plan_odd(t, asked) for t in texts]
        for unit, e in zip(asked, self.tokenizer.encode_batch_fast([u for (u,) in asked], add_special_tokens=False), strict=True):
            asked[unit] = np.array(e.ids, dtype=self.dtype).tobytes()
        return [b"".join([asked[x] if type(x) is tuple else x for x in plan]) for plan in plans]

    def _plan_odd(self, text: str, odd: dict) -> list:
        """The text's units in order: their ids, or where the library has to be asked (the unit,)."""
        if self.whole or any(t in text for t in self.added):
            odd[(text,)] = b""
            return [(text,)]
        pieces = text.replace("\n", " \n").split(" ")
        ok = [_clean(p[1:] if i and p[:1] == "\n" else p) for i, p in enumerate(pieces)]
        plan, n, i = [], len(pieces), 0
        while i < n:
            j = i + 1
            while j < n and not (ok[j - 1] and ok[j]):
                j += 1
            if i and j == i + 1 and ok[i] and (ids := self.cache.get(pieces[i]) or self._unit(pieces[i])):
                plan.append(ids)
            else:
                unit = " ".join(pieces[i:j])
                if i and unit[:1] != "\n":
                    unit = " " + unit
                unit = unit.replace(" \n", "\n")
                odd[(unit,)] = b""
                plan.append((unit,))
            i = j
        return plan

    def _unit(self, piece: str, often: bool = False) -> bytes | None:
        """The ids of a piece: behind a space, from its newline, or behind the zero that marks a text's first. None if its characters aren't common."""
        if parts := _USUAL(piece):
            word, marks = parts.groups()
            ids = self.cache.get(word) if marks else None
            if ids is None:
                ids = self._merge("Ġ" + word if word.isascii() else self._spell(" " + word))
            if marks:
                ids += self._mark(marks)
        elif not _COMMON(piece):
            return None
        else:
            kind = piece[0]
            words = _WORDS(" " + piece) if kind > " " else ["\n", *_WORDS(piece[1:])] if kind == "\n" else _WORDS(piece[1:])
            ids = b"".join([self._mark(w) if len(w) < 5 else self._merge(self._spell(w)) for w in words])
        if len(piece) <= 64:
            at = hash(piece) & 0xFFFFFF
            if often or self.met[at]:
                if len(self.cache) >= self.cache_words:
                    self.cache.clear()
                self.cache[piece] = ids
            else:
                self.met[at] = 1
        return ids

    def _spell(self, word: str) -> str:
        return word.encode("utf-8").decode("latin-1").translate(self.bytes_as)

    def _merge(self, spelled: str) -> bytes:
        """The library's ids of one word in the vocabulary's spelling."""
        ids = array(self.code, [t.id for t in self.model.tokenize(spelled)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _mark(self, word: str) -> bytes:
        """The ids of a short word, most often marks, that is met again and again."""
        ids = self.marks.get(word)
        if ids is None:
            if len(self.marks) >= RECENT_MARKS:
                self.marks.clear()
            ids = self.marks[word] = self._merge(self._spell(word))
        return ids


def _clean(piece: str) -> bool:
    """Whether white space on either side of the piece surely parts words."""
    return bool(piece) and (piece[0] in _VISIBLE or piece[0].isalnum()) and (piece[-1] in _VISIBLE or piece[-1].isalnum())


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]

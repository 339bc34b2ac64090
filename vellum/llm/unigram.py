"""A unigram piece vocabulary, read from a SentencePiece model file, and its exact segmentation.

The text is normalised by the library. A segmentation's score is the sum of its pieces'
scores, in exact arithmetic (the vocabulary's scores are whole numbers or short binary
fractions, summed as doubles). Ties go as in the reference tokenizer: for each place, the
piece that starts first, that is the longest. A character that is no piece scores 10 less
than the worst piece and becomes one id per UTF-8 byte where the vocabulary has bytes.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = "▁"
NEG = float("-inf")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Unigram:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.sp = sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.unk_id = sp.unk_id()
        self.raw: list[bytes] = [b""] * n
        self.byte_id: dict[int, int] = {}
        self.pieces: dict[str, tuple[int, float]] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.raw[i] = bytes([int(piece[1:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.pieces[piece] = (i, sp.get_score(i))
                self.raw[i] = piece.encode()
        self.raw[self.unk_id] = b" \xe2\x81\x87 "
        self.unk_score = min((s for _, s in self.pieces.values()), default=0.0) - 10
        self.longest = max(map(len, self.pieces), default=1)
        self.single = frozenset(p for p in self.pieces if len(p) == 1)
        self.fallback = len(self.byte_id) == 256
        self.matcher = ahocorasick.Automaton()
        for piece, (i, score) in self.pieces.items():
            self.matcher.add_word(piece, (len(piece), score, i))
        if self.pieces:
            self.matcher.make_automaton()
        self.dtype = np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")
        # Where no piece goes on over the mark of a space, or holds a newline, the text falls apart there.
        self.splits = not any(SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1) for p in self.pieces)
        self.size = n

    def normalize(self, text: str) -> str:
        return self.sp.normalize(text) if text else ""

    def unknown(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode("utf-8", "surrogatepass")] if self.fallback else [self.unk_id]

    def matches(self, text: str):
        """(end, length, score, id) by ascending end, the longest piece first."""
        if not self.pieces:
            return
        for last, (length, score, i) in self.matcher.iter(text):
            yield last + 1, length, score, i

    def lattice(self, text: str) -> list[list[tuple[int, float, int]]]:
        """For each end: (start, score, id or -1 for an unknown character), by ascending start."""
        into: list[list[tuple[int, float, int]]] = [[] for _ in range(len(text) + 1)]
        for end, length, score, i in self.matches(text):
            into[end].append((end - length, score, i))
        for end in range(1, len(text) + 1):
            found = into[end]
            if len(found) > 1:
                found.sort()
            if not found or found[-1][0] != end - 1:
                found.append((end - 1, self.unk_score, -1))
        return into

    def segment(self, text: str) -> list[int]:
        """The ids of the best segmentation of a normalised text."""
        if text and self.single.issuperset(text):
            return self._segment_known(text)
        n, pieces, unk = len(text), self.pieces, self.unk_score
        best, back, ids, done = [0.0] + [NEG] * n, [0] * (n + 1), [-1] * (n + 1), 0

        def settle(upto: int) -> None:
            """Places up to ``upto`` have had all pieces: let a character that is none compete there."""
            nonlocal done
            for k in range(done, upto):
                if best[k] + unk > best[k + 1] and text[k] not in pieces:
                    best[k + 1], back[k + 1], ids[k + 1] = best[k] + unk, k, -1
            done = upto

        if pieces:
            for last, (length, score, i) in self.matcher.iter(text):
                if done < last:
                    settle(last)
                end = last + 1
                start = end - length
                candidate = best[start] + score
                # The longest match of a place comes first, so it wins ties.
                if candidate > best[end]:
                    best[end], back[end], ids[end] = candidate, start, i
        settle(n)
        out, end = [], n
        while end:
            start = back[end]
            out.append(ids[end] if ids[end] >= 0 else text[start])
            end = start
        out.reverse()
        if str in map(type, out):
            return [i for x in out for i in ([x] if type(x) is int else self.unknown(x))]
        return out

    def _segment_known(self, text: str) -> list[int]:
        """The same where every character is a piece, so that no place needs an unknown one. Places go by their last character; -1 is the beginning."""
        best, chosen = [NEG] * len(text) + [0.0], [None] * len(text)
        for last, found in self.matcher.iter(text):
            length, score, _ = found
            candidate = best[last - length] + score
            if candidate > best[last]:
                best[last], chosen[last] = candidate, found
        out, last = [], len(text) - 1
        while last >= 0:
            length, _, i = chosen[last]
            out.append(i)
            last -= length
        out.reverse()
        return out

    def units(self, normal: str) -> list[str]:
        """Parts that segment on their own; a part that begins with neither mark nor newline stands behind a mark."""
        return normal.replace("\n", SPACE + "\n").split(SPACE)

    def decode(self, ids) -> str:
        """The text of ids: bytes are joined, marks become spaces, the mark put before a text goes."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=4)
def unigram(path: str) -> Unigram:
    """One model for each Python worker."""
    return Unigram(path)


class UnitCache:
    """value(text): the joined values of a normalised text's units, of which those that come again are kept.

    ``make`` gives a unit's value, ``join`` those of a text's units together.
    """

    def __init__(self, model: Unigram, make, join, size: int = 400_000):
        self.model, self.make, self.join, self.size = model, make, join, size
        self.cache: dict = {}
        self.met = bytearray(1 << 22)

    def value(self, normal: str):
        if not normal:
            return self.join([])
        if not self.model.splits:
            return self.join([self.make(normal)])
        parts = self.model.units(normal)
        # The text's first mark leaves an empty part in front; without it the first part has no mark.
        first = [] if parts[0] == "" else [self.make(parts[0])]
        del parts[0]
        found = list(map(self.cache.get, parts))
        if None in found:
            marks, out = "", []
            for part, x in zip(parts, found, strict=True):
                if part == "":
                    marks += SPACE
                    continue
                if marks or x is None:
                    x = self._new(part, marks)
                    marks = ""
                out.append(x)
            if marks:
                out.append(self.make(marks))
            found = out
        return self.join(first + found)

    def coded(self, normals: list[str]) -> tuple[list, np.ndarray, np.ndarray]:
        """The values of distinct units, for each unit of the texts the number of its value, and where each text's units begin.

        Each distinct unit is looked up once. A text with an empty unit (marks that follow each
        other, one at the end, none in front) is one unit.
        """
        texts = pc.replace_substring(pa.array(normals, pa.string()), "\n", SPACE + "\n")
        whole = pc.or_(pc.match_substring(texts, SPACE + SPACE), pc.or_(pc.invert(pc.starts_with(texts, SPACE)), pc.ends_with(texts, SPACE))).to_numpy(zero_copy_only=False)
        if not self.model.splits:
            whole[:] = True
        split = pc.split_pattern(pc.if_else(pa.array(whole), "", pc.utf8_slice_codeunits(texts, 1)), SPACE)
        first = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
        units = split.flatten().dictionary_encode()
        codes, names = units.indices.to_numpy().astype(np.int64), units.dictionary.to_numpy(zero_copy_only=False).tolist()
        often = np.bincount(codes, minlength=len(names)) > 1
        known = list(map(self.cache.get, names))
        for i in [i for i, x in enumerate(known) if x is None]:
            known[i] = self._known(names[i], often[i]) if names[i] else None
        at = np.flatnonzero(whole)
        codes[first[at]] = len(known) + np.arange(len(at))
        known += [self.value(normals[i]) for i in at.tolist()]
        empty = self.join([])
        return [empty if x is None else x for x in known], codes, first

    def _new(self, part: str, marks: str):
        if part[0] == "\n":
            # Marks before a newline are a unit of their own.
            x = self._known(part)
            return self.join([self.make(marks), x]) if marks else x
        return self.make(marks + SPACE + part) if marks else self._known(part)

    def _known(self, part: str, often: bool = False):
        x = self.cache.get(part)
        if x is None:
            x = self.make(part if part[0] == "\n" else SPACE + part)
            if len(part) <= 64:
                mark = hash(part) & 0x3FFFFF
                if often or self.met[mark]:
                    if len(self.cache) >= self.size:
                        self.cache.clear()
                    self.cache[part] = x
                else:
                    self.met[mark] = 1
        return x

"""Operator 7, token counts: Viterbi that carries only the best score and its piece count.

An Aho-Corasick automaton enumerates the vocabulary's matches in one pass. For each place
the best score and the number of pieces of the path that has it are kept, nothing to trace
back. Ties go as in the tokenizer: to the piece that starts first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from vellum.llm.common import batch, id_text, text_blocks
from vellum.llm.unigram import NEG, Unigram, UnitCache, default_path, unigram

_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_chars", pa.int64())])


def count_pieces(model: Unigram, text: str) -> int:
    """Number of ids of the best segmentation of a normalised text."""
    n = len(text)
    if text and model.single.issuperset(text):
        # Every character is a piece. Places go by their last character; -1 is the beginning.
        best, count = [NEG] * n + [0.0], [0] * (n + 1)
        for last, (length, score, _) in model.matcher.iter(text):
            candidate = best[last - length] + score
            if candidate > best[last]:
                best[last], count[last] = candidate, count[last - length] + 1
        return count[n - 1]
    best, count, done = [0.0] + [NEG] * n, [0] * (n + 1), 0
    pieces, unk = model.pieces, model.unk_score

    def settle(upto: int) -> None:
        """Places up to ``upto`` have had all pieces: let a character that is none compete there."""
        nonlocal done
        for k in range(done, upto):
            if best[k] + unk > best[k + 1] and text[k] not in pieces:
                best[k + 1], count[k + 1] = best[k] + unk, count[k] + len(model.unknown(text[k]))
        done = upto

    if pieces:
        for last, (length, score, _) in model.matcher.iter(text):
            if done < last:
                settle(last)
            end = last + 1
            start = end - length
            candidate = best[start] + score
            # The longest match of a place comes first, so it wins ties.
            if candidate > best[end]:
                best[end], count[end] = candidate, count[start] + 1
    settle(n)
    return count[n]


@lru_cache(maxsize=4)
def _count_cache(path: str) -> UnitCache:
    """One cache for each Python worker."""
    model = unigram(path)
    return UnitCache(model, lambda unit: count_pieces(model, unit), sum)


def token_counts(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, n_chars.

    Null text counts as empty: no tokens. Ids may repeat or be null. An empty table gives
    an empty result; other columns are ignored. A long text needs memory for two numbers a
    character of its longest unit, not for a lattice.
    """
    path = model_path or default_path()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = unigram(path), _count_cache(path)
        for b in text_blocks(batches):
            ids, texts = (b.column(b.schema.get_field_index(c)) for c in ("doc_id", "text"))
            known, codes, first = cache.coded([model.normalize(t) for t in texts.to_numpy(zero_copy_only=False).tolist()])
            yield batch(_OUT, [ids, np.add.reduceat(np.array(known, np.int64)[codes], first), pc.utf8_length(texts).cast(pa.int64())])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_tokens bigint, n_chars bigint")

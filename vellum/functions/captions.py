"""Split a figure's caption into the captions of its parts."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

_PARTS = ArrayType(StructType([StructField("reference", StringType()), StructField("caption", StringType())]))

#: Places that name a part, the default reference, the mark of a range that can't be opened.
PLACES = ["left", "right", "top", "bottom", "upper", "lower", "above", "below", "center", "centre", "middle"]
#: Letters that may name a part without a mark behind them.
BARE_LETTERS = "abcdefghijklABCDEFGHIJKL"
UNDIVIDED, REVIEW = "undivided", "manual_review_needed"
#: Shortened words whose full stops don't end a sentence.
SHORT = ["i.e.", "e.g.", "vs.", "Fig.", "fig.", "Dr.", "approx."]

_JOIN = r"\s*(?:[-–,&/]|and\b|to\b|through\b)\s*"
#: Classes of references in order of preference: one capital, one small letter, a place.
_CLASSES = [r"[A-Z]", r"[a-z]", r"(?:" + "|".join(PLACES) + ")"]


def _pattern(one: str) -> re.Pattern:
    """A list of references in brackets, or one at the start of a sentence or clause that a mark follows."""
    flags = re.I if len(one) > 8 else 0
    several = rf"{one}(?:{_JOIN}{one})*"
    return re.compile(rf"[(\[]\s*({several})\s*[)\]]|(?:^|(?<=[.;,] ))({several})\s*[:).]\s|^({several}),\s", flags)


_PATTERNS = [_pattern(c) for c in _CLASSES]


def expand(references: str) -> list[str]:
    """The references of a list such as ``A-C, E``: ranges opened; a range that runs backwards or between cases is for review."""
    tokens = re.findall(r"[A-Za-z]{3,}(?<!and)(?<!through)|[-–]|\bto\b|\bthrough\b|\b[A-Za-z]\b", references)
    out: list[str] = []
    for k, token in enumerate(tokens):
        if token in ("-", "–", "to", "through"):
            continue
        opened = k >= 2 and tokens[k - 1] in ("-", "–", "to", "through") and len(token) == 1
        if opened and out and out[-1] != REVIEW:
            low, high = ord(out[-1]), ord(token)
            same = out[-1].isupper() == token.isupper()
            out += [chr(c) for c in range(low + 1, high + 1)] if same and low < high else [REVIEW]
        else:
            out.append(token if len(token) == 1 else token.lower())
    return list(dict.fromkeys(out))


def caption_sentences(caption: str) -> list[str]:
    """Sentences of a caption; one of four characters or less joins the next."""
    hidden = re.sub(r"(?<=\d)\.(?=\d)", "\0", caption)
    for word in SHORT:
        hidden = hidden.replace(word, word.replace(".", "\0"))
    out, short = [], ""
    for piece in re.split(r"(?<=[.;])\s+", hidden):
        piece = f"{short} {piece}".strip()
        short = piece if len(piece) <= 4 else ""
        if piece and not short:
            out.append(piece.replace("\0", "."))
    return out + ([short.replace("\0", ".")] if short else [])


def mark_reference(sentence: str) -> str:
    """A sentence that begins with a bare letter and a capitalised word gets a colon behind the letter; behind ``a`` a word all in capitals isn't enough."""
    letter, gap, rest = sentence.partition(" ")
    word = rest.split(maxsplit=1)[0] if rest.split() else ""
    bare = len(letter) == 1 and letter in BARE_LETTERS and gap
    return f"{letter}: {rest}" if bare and (word.istitle() or (letter != "a" and word.isupper())) else sentence


def _clean(text: str) -> str:
    text = re.sub(r"^[\W_]+|[^\w)\]%]+$", "", text)
    text = re.sub(r"^(?:and|or)\s+|\s+(?:and|or)$", "", text, flags=re.I).strip(" ,;:")
    return re.sub(r"\s+", " ", text[:1].upper() + text[1:] + ".") if text else ""


def segment(caption: str | None) -> list[dict]:
    """References and their captions, by reference; one ``undivided`` caption if there are fewer than two references.

    A sentence that begins with a reference gives each one the text behind it, another
    sentence the text before it. Sentences before all references are common to all parts;
    a later one without a reference belongs to the references before it. A letter without a mark is a
    reference where a capitalised word follows it at the start of a sentence. Null has no parts.
    """
    if caption is None:
        return []
    sentences = [mark_reference(s) for s in caption_sentences(caption)]
    marked = " ".join(sentences)
    pattern = next((p for p in _PATTERNS if len({r for m in p.finditer(marked) for r in expand(m[1] or m[2] or m[3])} - {REVIEW}) > 1), None)
    if pattern is None:
        return [{"reference": UNDIVIDED, "caption": caption}]
    common: list[str] = []
    parts: dict[str, list[str]] = {}
    last: list[str] = []
    for sentence in sentences:
        marks = list(pattern.finditer(sentence))
        if not marks:
            if not last:
                common.append(_clean(sentence))
            for r in last:
                parts[r].append(_clean(sentence))
            continue
        leading = not sentence[: marks[0].start()].strip()
        edges = [0, *(m.end() for m in marks)]
        for k, mark in enumerate(marks):
            last = expand(mark[1] or mark[2] or mark[3])
            end = marks[k + 1].start() if k + 1 < len(marks) else len(sentence)
            text = sentence[mark.end() : end] if leading else sentence[edges[k] : mark.start()]
            if not leading and k + 1 == len(marks):
                text += sentence[mark.end() :]
            for r in last:
                parts.setdefault(r, []).append(_clean(text))
    return [{"reference": r, "caption": " ".join(filter(None, [*common, *parts[r]]))} for r in sorted(parts)]


@F.pandas_udf(_PARTS)
def segment_caption(caption: pd.Series) -> pd.Series:
    return caption.map(segment)

"""Extraction of ages, genders, figure numbers and sentences from clinical prose; clean-up of captions and HTML."""

from __future__ import annotations

import ast
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

_STRINGS, _INTS = ArrayType(StringType()), ArrayType(IntegerType())
_MENTIONS = ArrayType(StructType([StructField("mention", StringType()), StructField("letters", _STRINGS)]))

#: Number words.
ONES = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen"]
TENS = {"twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90}
NUMBER_WORDS = {**{w: i + 1 for i, w in enumerate(ONES)}, **TENS}
HUNDRED = "hundred"
_WORD = "(?:" + "|".join(sorted([*NUMBER_WORDS, HUNDRED], key=len, reverse=True)) + ")"
_NUMBER = rf"(\d+|{_WORD}(?:[- ](?:and[- ])?{_WORD}){{0,3}})"
#: Units of an age; ``yo`` and ``y/o`` say old themselves, behind the others ``old`` stands somewhere in the sentence.
OLD = rf"(?i)\b{_NUMBER}[- ]*(?:(yo|y/o)\b|(years?|yrs?|months?|weeks?|days?)\b[^.]*?[\s-](?:old|o)\b)"
AGED = rf"(?i)\b(?:aged|age of|age)[: ]+{_NUMBER}\b(?:[- ]*(yo|y/o|years?|yrs?|months?|weeks?|days?))?"
LIMIT = 130


def words_to_number(words: Column) -> Column:
    """The number that a phrase of number words (or digits) says, such as one hundred and five; 0 if it says none."""
    table = F.create_map(*[F.lit(x) for kv in NUMBER_WORDS.items() for x in kv])
    parts = F.split(F.lower(words), "[- ]+")
    return F.aggregate(parts, F.lit(0), lambda a, w: F.when(w == HUNDRED, F.greatest(a, F.lit(1)) * 100).otherwise(a + F.coalesce(w.try_cast("int"), table[w], F.lit(0))))


def extract_age(text: Column) -> Column:
    """Age in whole years: '... years old' first, then 'aged ...'; months, weeks and days are 0; null beyond 130 or if there is none.

    A number, its unit and ``old`` stand in one sentence, however far apart; the first unit decides
    (5 years, 3 months and 10 days old is 5).
    """

    def years(pattern: str, units: list[int]) -> Column:
        number, unit = F.regexp_extract(text, pattern, 1), F.lower(F.concat(*[F.regexp_extract(text, pattern, u) for u in units]))
        return F.when(number == "", None).when(unit.rlike("^(month|week|day)"), F.lit(0)).otherwise(words_to_number(number))

    age = F.coalesce(years(OLD, [2, 3]), years(AGED, [2]))
    return F.when(age <= LIMIT, age)


#: The words that tell a gender, in lower case.
TRANSGENDER = ["transgender", "transexual", "transsexual", "trans man", "trans woman", "trans male", "trans female", "female-to-male", "female to male", "male-to-female", "male to female"]
ACRONYMS = ["mtf", "ftm"]
FEMALE = ["woman", "women", "girl", "girls", "mistress", "mistresses", "lady", "ladies", "female", "females", "puerpera", "primigravida", "multigravida", "pregnant"]
MALE = ["man", "men", "boy", "boys", "gentleman", "gentlemen", "mister", "male", "males"]
SHE, HE = ["she", "her", "hers", "herself"], ["he", "his", "him", "himself"]


def whole_words(words: list[str]) -> str:
    """A pattern for any of the words, with no ASCII letter or digit on either side; for lower-cased text."""
    return "(?:^|[^a-z0-9])(?:" + "|".join(words) + ")(?:[^a-z0-9]|$)"


#: Classes in order: the first whose pattern is found decides. Acronyms count in a text's first sentence alone.
GENDERS = [("Transgender", whole_words(TRANSGENDER)), ("Female", whole_words(FEMALE)), ("Male", whole_words(MALE)), ("Female", whole_words(SHE) + r"|\sf\s"), ("Male", whole_words(HE) + r"|\sm\s")]


def extract_gender(text: Column) -> Column:
    """Female, Male, Transgender or Unknown: the first sentence decides, then the whole text; nouns go before pronouns."""
    whole = F.lower(F.coalesce(text, F.lit("")))
    first = F.get(F.split(whole, r"\."), 0)

    def find(t: Column) -> Column:
        out = F.when(first.rlike(whole_words(ACRONYMS)), "Transgender")
        for name, pattern in GENDERS:
            out = out.when(t.rlike(pattern), name)
        return out

    return F.coalesce(find(first), find(whole), F.lit("Unknown"))


_FIG = re.compile(r"\bfig(?:ure)?s?\b\.?", re.I)
_FIG_PART = re.compile(r"\d+|[-–]|[A-Za-z]+")
_FIG_STOP = re.compile(r"[^A-Za-z0-9(,.\-–&]")


def figure_numbers(text: str | None, below: int = 16, gap: int = 5) -> list[int]:
    """Numbers behind mentions of figures, ranges opened; those of ``below`` and more go; in order, once each.

    A mention reaches to the full stop or the next mention. It ends earlier behind a token
    with any other mark, and where more than ``gap`` tokens hold no number. Numbers of years don't count.
    """
    out: list[int] = []
    text = text or ""
    mentions = list(_FIG.finditer(text))
    for mention, after in zip(mentions, [*mentions[1:], None], strict=False):
        stop = text.find(".", mention.end(), after.start() if after else len(text))
        rest = text[mention.end() : stop if stop >= 0 else after.start() if after else len(text)]
        last, at, dash = None, 0, False
        for k, token in enumerate(re.split(r"\s+", rest)):
            if k - at > gap:
                break
            if "year" in token.lower():
                # '45-year-old' has its number in the token, '45 years' in the one before.
                if last is not None and at == k - 1 and token.lower().startswith("year"):
                    out.pop()
                dash = False
                continue
            for part in _FIG_PART.findall(token):
                if part.isdigit():
                    n = int(part)
                    # What a range holds from ``below`` on goes in any case.
                    out += range(last + 1, min(n + 1, below)) if dash and last is not None and last < n else [n]
                    last, at, dash = n, k, False
                else:
                    dash = last is not None and part.lower() in ("-", "–", "to", "through")
            if _FIG_STOP.search(token):
                break
    return list(dict.fromkeys(n for n in out if n < below))


@F.pandas_udf(_INTS)
def extract_figure_numbers(text: pd.Series) -> pd.Series:
    return text.map(figure_numbers)


def figure_mentions(text: str | None) -> list[dict]:
    """Mentions of figures with the letters behind their number; a range of letters is opened."""
    out = []
    for m in re.finditer(r"\bfig(?:ure)?s?\.?\s*(\d+)\s*([A-Za-z](?:\s*(?:[-–,]|and|to)\s*[A-Za-z])*)?(?![A-Za-z])", text or "", re.I):
        letters: list[str] = []
        parts = re.findall(r"[-–,]|and|to|[A-Za-z](?![A-Za-z])", m[2] or "")
        for i, p in enumerate(parts):
            if len(p) == 1 and p.isalpha():
                p = p.lower()
                if i >= 2 and parts[i - 1] in ("-", "–", "to") and letters:
                    letters += [chr(c) for c in range(ord(letters[-1]) + 1, ord(p) + 1)]
                else:
                    letters.append(p)
        out.append({"mention": m[0].strip(), "letters": list(dict.fromkeys(letters))})
    return out


@F.pandas_udf(_MENTIONS)
def extract_figure_mentions(text: pd.Series) -> pd.Series:
    return text.map(figure_mentions)


def sentences(text: Column) -> Column:
    """Sentences of each line: cut behind '. ' before a capital; a line without such a cut is one sentence."""
    return F.filter(F.flatten(F.transform(F.split(text, "\n"), lambda p: F.split(p, r"(?<=\.) (?=[A-Z])"))), lambda s: F.trim(s) != "")


def figure_sentences(text: Column) -> Column:
    return F.filter(sentences(text), lambda s: s.rlike(r"(?i)\bfig(ure)?s?\b"))


def compatible_mentions(mentions: Column) -> Column:
    """The mentions if some number of the first is in all others, else none."""
    numbers = lambda s: F.regexp_extract_all(s, F.lit(r"(\d+)"), F.lit(1))
    first = numbers(F.get(mentions, 0))
    rest = F.slice(mentions, 2, F.greatest(F.size(mentions) - 1, F.lit(0)))
    ok = F.exists(first, lambda n: F.forall(rest, lambda m: F.array_contains(numbers(m), n)))
    return F.when((F.size(mentions) < 2) | ok, mentions).otherwise(F.array().cast("array<string>"))


def fix_caption(caption: Column, least: int = 5, default: str = "Medical image.") -> Column:
    """Trim odd ends and leading or trailing conjunctions, capitalise, end with a full stop; too short ones become the default."""
    t = F.regexp_replace(caption, r"^[^\p{L}\p{N}(]+|[^\p{L}\p{N})]+$", "")
    t = F.regexp_replace(t, r"(?i)^(?:and|or)\s+|\s+(?:and|or)$", "")
    t = F.regexp_replace(t, r"^[^\p{L}\p{N}(]+|[^\p{L}\p{N})]+$", "")
    t = F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, F.lit(2), F.length(t)), F.lit("."))
    return F.when(F.length(t) > least, t).otherwise(F.lit(default))


def clean_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def _literal(x: str) -> list[str]:
    try:
        found = ast.literal_eval(x)
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return [x]
    return [str(v) for v in found if v is not None] if isinstance(found, (list, tuple)) else [x]


@F.pandas_udf(_STRINGS)
def _odd_lists(column: pd.Series) -> pd.Series:
    return column.map(lambda x: None if x is None else _literal(x))


def parse_list_column(column: Column) -> Column:
    """Lists written as Python literals: a JSON reader takes those of plain quoted strings, Python the odd rest.

    A cell that isn't a list, or a malformed one, is a list of itself; an empty cell an empty list; null stays null.
    """
    quoted = r"^\[\s*(?:'[^'\"\\\\]*'|\"[^\"\\\\]*\")?(?:\s*,\s*(?:'[^'\"\\\\]*'|\"[^\"\\\\]*\"))*\s*\]$"
    plain = F.from_json(column, _STRINGS, {"allowSingleQuotes": "true"})
    none = F.array().cast(_STRINGS)
    odd = _odd_lists(F.when(column.startswith("[") & ~column.rlike(quoted), column))
    return F.when(column.isNull(), None).when(column == "", none).when(~column.startswith("["), F.array(column)).when(column.rlike(quoted), plain).otherwise(odd)


def html_metadata(html: Column) -> Column:
    """struct(title, heading, lang, paragraphs, links) of a page."""
    strip = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", ""), r"\s+", " "))
    return F.struct(
        strip(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"),
        strip(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)).alias("heading"),
        F.regexp_extract(html, r'(?i)<html[^>]*\blang="([^"]*)"', 1).alias("lang"),
        F.size(F.regexp_extract_all(html, F.lit(r"(?i)(<p[ >])"), F.lit(1))).alias("paragraphs"),
        F.size(F.regexp_extract_all(html, F.lit(r"(?i)(<a )"), F.lit(1))).alias("links"),
    )

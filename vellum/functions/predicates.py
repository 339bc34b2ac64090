"""Predicates of the filter language over any columns: never null, so that `none` is a true complement."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

OPERATORS = ("all", "any", "none")


def _combine(tests: list[Column], operator: str) -> Column:
    """all of nothing and none of nothing are true, any of nothing is false."""
    if operator not in OPERATORS:
        raise ValueError(f"operator must be one of {OPERATORS}, not {operator!r}")
    if operator == "all":
        return reduce(lambda a, b: a & b, tests, F.lit(True))
    some = reduce(lambda a, b: a | b, tests, F.lit(False))
    return ~some if operator == "none" else some


def _sure(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def at_least(value: Column, bounds: list) -> Column:
    """value >= the smallest bound; null, and what isn't a number, is false."""
    return _sure(value.try_cast("int") >= F.lit(min(map(int, bounds))))


def at_most(value: Column, bounds: list) -> Column:
    """value <= the largest bound; null, and what isn't a number, is false."""
    return _sure(value.try_cast("int") <= F.lit(max(map(int, bounds))))


def member(value: Column, members: list[str], ignore_case: bool = False) -> Column:
    if ignore_case:
        value, members = F.lower(value), [m.lower() for m in members]
    return _sure(value.isin(members))


def whitelisted(value: Column, allowed: list[str]) -> Column:
    """One of the allowed values; an empty list allows all."""
    return member(value, list(allowed)) if allowed else F.lit(True)


def has_substrings(text: Column, needles: list[str], operator: str = "all") -> Column:
    """Literal substrings, ignoring case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return _combine([low.contains(n.lower()) for n in needles], operator)


def has_patterns(text: Column, patterns: list[str], operator: str = "all", matching_case: bool = False, literal: bool = False) -> Column:
    """Regular expressions found anywhere; null text has none of them."""
    flag = "" if matching_case else "(?i)"
    patterns = [re.escape(p) if literal else p for p in patterns]
    if operator != "all" and patterns:
        patterns = ["|".join(f"(?:{p})" for p in patterns)]
    return _combine([_sure(text.rlike(flag + p)) for p in patterns], operator)


def has_terms(terms: Column, needles: list[str], operator: str = "all", match_type: str = "full_match") -> Column:
    """Terms of an array, ignoring case: whole terms, or parts of them. A null array is empty.

    With no needles `any` holds wherever there are terms at all or not, as `all` does.
    """
    if match_type not in ("full_match", "partial_match"):
        raise ValueError(f"match_type must be full_match or partial_match, not {match_type!r}")
    low = F.transform(F.coalesce(terms, F.array().cast("array<string>")), F.lower)
    if not needles:
        return F.lit(True)
    if match_type == "full_match":
        tests = [_sure(F.array_contains(low, n.lower())) for n in needles]
    else:
        tests = [_sure(F.exists(low, _contains(n.lower()))) for n in needles]
    return _combine(tests, operator)


def _contains(needle: str):
    return lambda term: term.contains(needle)


def has_labels(labels: Column, wanted: list[str], operator: str = "all", lower_needles: bool = False) -> Column:
    """Exact members of a label array, minding case."""
    wanted = [w.lower() for w in wanted] if lower_needles else list(wanted)
    return _combine([_sure(F.array_contains(labels, w)) for w in wanted], operator)


def both_labels(*columns: Column) -> Column:
    """The columns' labels one after the other; null counts as none."""
    return F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in columns])

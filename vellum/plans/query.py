"""The declarative filter list: validation, planning onto three levels, and dataset building."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions import predicates as P
from vellum.operators.harmonize import Levels, class_subsets, harmonize

LEVELS = ("article", "case", "image")
KINDS = ("min", "max", "member", "member_ci", "terms", "substrings", "patterns", "labels", "labels_lower")


@dataclass(frozen=True)
class Field:
    """A filterable field: its level, the kind of its predicate, and its column."""

    level: str
    kind: str
    column: str


#: The fields of the clinical façade; any other set of fields over any columns works as well.
CLINICAL = {
    "min_year": Field("article", "min", "year"),
    "max_year": Field("article", "max", "year"),
    "license": Field("article", "member", "license"),
    "keywords": Field("article", "terms", "keywords"),
    "mesh_terms": Field("article", "terms", "mesh_terms"),
    "min_age": Field("case", "min", "age"),
    "max_age": Field("case", "max", "age"),
    "gender": Field("case", "member_ci", "gender"),
    "case_strings": Field("case", "substrings", "case_text"),
    "caption": Field("image", "patterns", "caption"),
    "label": Field("image", "labels", "labels"),
    "normalized_extractions": Field("image", "labels_lower", "normalized_extractions"),
}


def validate(filters: dict | list[dict], fields: dict[str, Field]) -> list[dict]:
    """A list of well-formed filters; a single filter is wrapped. The caller's filters aren't changed."""
    filters = [filters] if isinstance(filters, dict) else list(filters)
    for f in filters:
        if not isinstance(f, dict) or "field" not in f or "string_list" not in f:
            raise ValueError(f"a filter is a dict with field and string_list, not {f!r}")
        if f["field"] not in fields:
            raise ValueError(f"unknown field {f['field']!r}; known are {', '.join(sorted(fields))}")
    return filters


def predicate(f: dict, field: Field) -> Column:
    values, column = f["string_list"], F.col(field.column)
    operator = f.get("operator") or "all"
    match field.kind:
        case "min":
            return P.at_least(column, values)
        case "max":
            return P.at_most(column, values)
        case "member":
            return P.member(column, values)
        case "member_ci":
            return P.member(column, values, ignore_case=True)
        case "terms":
            return P.has_terms(column, values, operator, f.get("match_type") or "full_match")
        case "substrings":
            return P.has_substrings(column, values, operator)
        case "patterns":
            return P.has_patterns(column, values, operator, bool(f.get("matching_case")), bool(f.get("literal")))
        case "labels" | "labels_lower":
            return P.has_labels(column, values, operator, field.kind == "labels_lower")
    raise ValueError(f"unknown kind {field.kind!r}")


_CHEAP = {k: i for i, k in enumerate(("min", "max", "member", "member_ci", "labels", "labels_lower", "terms", "substrings", "patterns"))}


def level_predicates(filters: list[dict], fields: dict[str, Field]) -> dict[str, Column]:
    """One conjunction per level, cheap comparisons before text searches."""
    out = {level: F.lit(True) for level in LEVELS}
    for f in sorted(filters, key=lambda f: _CHEAP[fields[f["field"]].kind]):
        field = fields[f["field"]]
        out[field.level] = out[field.level] & predicate(f, field)
    return out


@dataclass(frozen=True)
class DatasetBuilder:
    """Three levels with their keys and fields; ``query`` filters and reconciles them in one lazy plan.

    ``articles`` has article_key, ``cases`` and ``images`` have article_key and case_key.
    """

    articles: DataFrame
    cases: DataFrame
    images: DataFrame
    article_key: str = "pmcid"
    case_key: str = "case_id"
    fields: dict[str, Field] | None = None
    label_columns: tuple[str, ...] = ()

    def query(self, filters: dict | list[dict] = (), dataset_type: str = "multimodal", label_filter_column: str = "both", require_images: bool | None = None) -> Levels:
        fields = dict(self.fields or CLINICAL)
        filters = validate(filters, fields)
        images = self.images
        if self.label_columns:
            if label_filter_column != "both" and label_filter_column not in images.columns:
                raise ValueError(f"there is no label column {label_filter_column!r}")
            chosen = self.label_columns if label_filter_column == "both" else (label_filter_column,)
            images = images.withColumn("__labels", P.both_labels(*map(F.col, chosen)))
            fields = {k: replace(f, column="__labels") if f.kind == "labels" else f for k, f in fields.items()}
        by = level_predicates(filters, fields)
        out = harmonize(self.articles.where(by["article"]), self.cases.where(by["case"]), images.where(by["image"]), self.article_key, self.case_key, dataset_type, require_images)
        return out._replace(images=out.images.drop("__labels"))

    def classification(self, common: list[dict], classes: dict[str, list[dict]], file_key: str = "file", label_filter_column: str = "both") -> DataFrame:
        """Images of each class under common and own filters, in one plan; files of several classes are dropped."""
        return class_subsets({name: self.query([*validate(common, self.fields or CLINICAL), *validate(own, self.fields or CLINICAL)], "image", label_filter_column).images for name, own in classes.items()}, file_key)

    def domains(self) -> dict[str, DataFrame]:
        """The distinct values of every field's column."""
        from vellum.operators.aggregates import distinct_values

        level = {"article": self.articles, "case": self.cases, "image": self.images}
        return {name: distinct_values(level[f.level], f.column) for name, f in (self.fields or CLINICAL).items() if f.column in level[f.level].columns}

    def example(self, number: int = 0, order: str | list[str] | None = None) -> DataFrame:
        """The image with this number, with its case and its article."""
        image = self.images.orderBy(order or self.case_key).offset(number).limit(1)
        shared = [c for c in self.cases.columns if c in self.images.columns and c != self.case_key]
        return image.join(self.cases.drop(*shared), self.case_key, "left").join(self.articles, self.article_key, "left")

"""Class hierarchies with disjoint siblings: parsing, validation, class paths, and consistent task columns."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections import Counter, defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.storage import forget, materialize

BOUNDARIES = (":", ".", "~")


class TaxonomyError(ValueError):
    """The taxonomy isn't a forest of well-formed class trees."""


@dataclass
class Taxonomy:
    """parent: class -> parents below a root label; the rest are the three properties."""

    parents: dict[str, list[str]]
    subsidiary: dict[str, list[str]] = field(default_factory=dict)
    maps_to: dict[str, list[str]] = field(default_factory=dict)
    composed_by: dict[str, list[str]] = field(default_factory=dict)
    root: str = "taxonomy"

    def children(self) -> dict[str, list[str]]:
        out = defaultdict(list)
        for c, ps in self.parents.items():
            for p in ps:
                out[p].append(c)
        return out

    def trees(self) -> list[str]:
        return [c for c, ps in self.parents.items() if self.root in ps]

    def validate(self) -> None:
        """Raise for classes with several parents, cycles, trees without classes, single children and repeated names."""
        kids = self.children()
        for c, ps in self.parents.items():
            if len(ps) > 1:
                raise TaxonomyError(f"graph structure: {c} has the parents {', '.join(ps)}")
        for c in self.parents:
            seen, at = set(), c
            while at in self.parents and self.parents[at]:
                if at in seen:
                    raise TaxonomyError(f"recursion at {c}")
                seen.add(at)
                at = self.parents[at][0]
        for t in self.trees():
            if not kids[t]:
                raise TaxonomyError(f"empty tree: {t}")
        below = [t for t in self.trees() for t in self._walk(t, kids)]
        for name, n in Counter(below).items():
            if n > 1:
                raise TaxonomyError(f"repeated name: {name}")
        for name in below:
            if len(kids[name]) == 1:
                raise TaxonomyError(f"single child: {kids[name][0]} of {name}")

    def _walk(self, top: str, kids: dict[str, list[str]]) -> list[str]:
        out, todo = [], [top]
        while todo:
            c = todo.pop()
            out.append(c)
            todo += kids[c]
        return out

    def class_paths(self) -> dict[str, str]:
        """class -> path: ':' from tree to class, '.' to a subclass, '~' to a subsidiary tree."""
        kids, out = self.children(), {}
        owned = {t for ts in self.subsidiary.values() for t in ts}
        todo = [(t, t) for t in self.trees() if t not in owned]
        seen = set()
        while todo:
            tree, prefix = todo.pop()
            if tree in seen:
                raise TaxonomyError(f"recursion at tree {tree}")
            seen.add(tree)
            level = [(c, f"{prefix}:{c}") for c in kids[tree]]
            todo += [(t, f"{prefix}~{t}") for t in self.subsidiary.get(tree, [])]
            while level:
                c, path = level.pop()
                out[c] = path
                level += [(k, f"{path}.{k}") for k in kids[c]]
                todo += [(t, f"{path}~{t}") for t in self.subsidiary.get(c, [])]
        return out

    def class_map(self) -> list[tuple[str, str, str, str, str, str]]:
        """(class, path, column, conditioning class, parent class, tree) of each class."""
        paths, kids = self.class_paths(), self.children()
        out = []
        for c, path in sorted(paths.items()):
            column = path[: max(path.rfind(":"), path.rfind("."))]
            out.append((c, path, self._named(column, kids), conditioning(column), self.parents[c][0], column[max(column.rfind("~"), -1) + 1 :].split(":")[0]))
        return out

    def _named(self, column: str, kids: dict[str, list[str]]) -> str:
        """A class with a task of its own and subsidiary trees: the task of its subclasses is named ~main."""
        last = column[max(column.rfind(b) for b in BOUNDARIES) + 1 :]
        return f"{column}~main" if self.subsidiary.get(last) and kids[last] and ":" in column.rpartition("~")[2] else column


def conditioning(column: str) -> str:
    """The class that a task hangs on: before the last '~' if that comes last, else the task's own last part; empty at a root."""
    last = {b: column.rfind(b) for b in BOUNDARIES}
    if max(last.values()) < 0:
        return ""
    upto = column[: last["~"]] if last["~"] > max(last[":"], last["."]) else column
    return upto[max(upto.rfind(b) for b in BOUNDARIES) + 1 :]


def path_tasks(path: str) -> list[tuple[str, str]]:
    """(task, class) of every level of a class path."""
    out = []
    for i, ch in enumerate(path):
        if ch in ":.":
            end = min((j for j in (path.find(b, i + 1) for b in BOUNDARIES) if j >= 0), default=len(path))
            out.append((path[:i], path[i + 1 : end]))
    return out


def parse_owl(text: str, root: str = "taxonomy") -> Taxonomy:
    """Read asserted subclass axioms and existential restrictions of the three properties from OWL/XML."""
    names, out = {}, Taxonomy({}, root=root)
    top = ET.fromstring(text)
    tag = lambda e: e.tag.rpartition("}")[2]
    iri = lambda e: (e.get("IRI") or e.get("abbreviatedIRI") or "").rpartition("#")[2]
    for e in top:
        if tag(e) == "AnnotationAssertion" and any(tag(x) == "AnnotationProperty" and "label" in (x.get("abbreviatedIRI") or x.get("IRI") or "") for x in e):
            subject = next((x.text or "" for x in e if tag(x) == "IRI"), "").rpartition("#")[2]
            names[subject] = next((x.text or "" for x in e if tag(x) == "Literal"), subject)
    name = lambda e: names.get(iri(e), iri(e))
    for e in top:
        if tag(e) != "SubClassOf":
            continue
        parts = [x for x in e if tag(x) in ("Class", "ObjectSomeValuesFrom")]
        if len(parts) != 2 or tag(parts[0]) != "Class":
            continue
        if tag(parts[1]) == "Class":
            out.parents.setdefault(name(parts[0]), []).append(name(parts[1]))
        else:
            prop, target = list(parts[1])
            table = {"has_subsidiary_tree": out.subsidiary, "maps_to": out.maps_to, "is_composed_by": out.composed_by}.get(name(prop))
            if table is not None:
                table.setdefault(name(parts[0]), []).append(name(target))
    return out


def to_owl(taxonomy: Taxonomy, notes: dict[str, dict[str, str]] | None = None, base: str = "urn:taxonomy") -> str:
    """OWL/XML that ``parse_owl`` reads back: subclass axioms, restrictions, disjoint unions of siblings, labels and ``notes``."""
    top = ET.Element("Ontology", {"xmlns": "http://www.w3.org/2002/07/owl#", "ontologyIRI": base})
    iri = lambda name: f"{base}#{name}"
    props = {"has_subsidiary_tree": taxonomy.subsidiary, "maps_to": taxonomy.maps_to, "is_composed_by": taxonomy.composed_by}
    kids = taxonomy.children()
    named = [taxonomy.root, *taxonomy.parents]
    named += sorted({c for table in props.values() for s, ds in table.items() for c in (s, *ds)} - set(named))

    def add(parent: ET.Element, kind: str, name: str | None = None) -> ET.Element:
        return ET.SubElement(parent, kind, {"IRI": iri(name)} if name else {})

    for kind, names in (("Class", named), ("ObjectProperty", list(props))):
        for name in names:
            add(add(top, "Declaration"), kind, name)
    for child, parents in taxonomy.parents.items():
        for parent in parents:
            axiom = add(top, "SubClassOf")
            add(axiom, "Class", child)
            add(axiom, "Class", parent)
    for prop, table in props.items():
        for source, targets in table.items():
            for target in targets:
                axiom = add(top, "SubClassOf")
                add(axiom, "Class", source)
                some = add(axiom, "ObjectSomeValuesFrom")
                add(some, "ObjectProperty", prop)
                add(some, "Class", target)
    for parent in named:
        if parent != taxonomy.root and len(kids.get(parent, [])) > 1:
            union = add(top, "DisjointUnion")
            for name in (parent, *kids[parent]):
                add(union, "Class", name)
    for name in named:
        for key, value in {"label": name, **(notes or {}).get(name, {})}.items():
            axiom = add(top, "AnnotationAssertion")
            ET.SubElement(axiom, "AnnotationProperty", {"abbreviatedIRI": "rdfs:label"} if key == "label" else {"IRI": iri(key)})
            ET.SubElement(axiom, "IRI").text = iri(name)
            ET.SubElement(axiom, "Literal").text = value
    return ET.tostring(top, encoding="unicode")


def parse_notes(text: str) -> dict[str, dict[str, str]]:
    """class -> annotation -> value of an OWL/XML file, labels aside: what ``to_owl`` takes as ``notes``."""
    out: dict[str, dict[str, str]] = defaultdict(dict)
    names: dict[str, str] = {}
    found = []
    for e in ET.fromstring(text):
        if e.tag.rpartition("}")[2] != "AnnotationAssertion":
            continue
        part = {x.tag.rpartition("}")[2]: x for x in e}
        if not {"AnnotationProperty", "IRI", "Literal"} <= part.keys():
            continue
        kind = part["AnnotationProperty"].get("IRI") or part["AnnotationProperty"].get("abbreviatedIRI") or ""
        subject, value = (part["IRI"].text or "").rpartition("#")[2], part["Literal"].text or ""
        if kind.endswith("label"):
            names[subject] = value
        else:
            found.append((subject, kind.rpartition("#")[2] or kind, value))
    for subject, kind, value in found:
        out[names.get(subject, subject)][kind] = value
    return dict(out)


#: The annotations of a class.
PROPERTIES = ["SNOMED_ID", "Synonym", "auxiliary_class", "Description"]


def property_table(spark: SparkSession, notes: dict[str, dict[str, str]], properties: list[str] = PROPERTIES) -> DataFrame:
    """One row a class with its annotations; as small as the taxonomy."""
    return spark.createDataFrame([(c, *[v.get(p) for p in properties]) for c, v in sorted(notes.items())], "class_name string, " + ", ".join(f"`{p}` string" for p in properties))


def with_properties(class_map: DataFrame, properties: DataFrame) -> DataFrame:
    return class_map.join(properties, "class_name", "left")


def subsidiary_flags(class_map: DataFrame) -> DataFrame:
    """The classes with ``subsidiary``: whether tasks of more than one column hang on their conditioning class."""
    flags = class_map.groupBy("conditioning_class").agg((F.countDistinct("column_name") > 1).alias("subsidiary"))
    return class_map.join(flags, "conditioning_class", "left")


def multiclass_columns(labels: Column, groups: dict[str, list[str]]) -> list[Column]:
    """One column a group of classes: the last label of the list that is in it, empty if none is."""
    from vellum.operators.labels import first_match

    return [first_match(labels, classes).alias(name) for name, classes in groups.items()]


def dimensions(spark: SparkSession, taxonomy: Taxonomy) -> dict[str, DataFrame]:
    """class_map, maps_to and compound as small tables: their size is the taxonomy's."""
    cm = spark.createDataFrame(taxonomy.class_map() or [], "class_name string, class_path string, column_name string, conditioning_class string, parent_class string, tree_name string")
    mt = spark.createDataFrame([(s, d) for s, ds in taxonomy.maps_to.items() for d in ds], "src string, dst string")
    cp = spark.createDataFrame(list(taxonomy.composed_by.items()), "class string, components array<string>")
    return {"class_map": cm, "maps_to": mt, "compound": cp}


def preprocess(labels: Column, maps_to: dict[str, list[str]]) -> Column:
    """Each label becomes the labels it maps to, itself if there are none."""
    if not maps_to:
        return labels
    table = F.create_map(*[x for s, ds in maps_to.items() for x in (F.lit(s), F.array(*map(F.lit, ds)))])
    return F.array_distinct(F.flatten(F.transform(labels, lambda x: F.coalesce(table[x], F.array(x)))))


def label_tasks(labels: Column, paths: dict[str, str]) -> Column:
    """Distinct struct(task, value) of all levels of the labels' paths, sorted; unknown labels give none."""
    kind = "array<struct<task:string,value:string>>"
    rows = {c: path_tasks(p) for c, p in paths.items()}
    if not rows:
        return F.array().cast(kind)
    table = F.create_map(*[x for c, ts in rows.items() for x in (F.lit(c), F.array(*[F.struct(F.lit(t).alias("task"), F.lit(v).alias("value")) for t, v in ts]))])
    return F.array_sort(F.array_distinct(F.flatten(F.transform(labels, lambda x: F.coalesce(table[x], F.array().cast(kind))))))


def _below(task: Column, top: Column) -> Column:
    return (task == top) | (task.startswith(top) & F.substring(task, F.length(top) + 1, F.lit(1)).isin(*BOUNDARIES))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once a row, however often it is used: the only element of an array has a name."""
    return F.get(F.transform(F.array(value), then), 0)


def resolve(tasks: Column) -> Column:
    """Drop tasks with more than one value, and all that hang below them."""

    def keep(all_: Column, bad: Column) -> Column:
        return F.when(F.size(bad) == 0, all_).otherwise(F.filter(all_, lambda t: ~F.exists(bad, lambda b: _below(t["task"], b))))

    def drop(all_: Column) -> Column:
        def repeated(names: Column) -> Column:
            return F.array_distinct(F.filter(names, lambda n: F.size(F.filter(names, lambda m: m == n)) > 1))

        return _once(_once(F.transform(all_, lambda t: t["task"]), repeated), lambda bad: keep(all_, bad))

    return _once(tasks, drop)


def task_map(tasks: Column) -> Column:
    return F.map_from_entries(tasks)


def fill_exclusions(tasks: Column, defaults: dict[str, tuple[str, str]]) -> Column:
    """For each task that is missing: its default, where its conditioning class is among the values (or it has none)."""
    if not defaults:
        return tasks

    def fill(all_: Column) -> Column:
        def missing(names: Column, values: Column) -> Column:
            extra = []
            for task, (condition, default) in sorted(defaults.items()):
                holds = F.lit(True) if not condition else F.array_contains(values, condition)
                extra.append(F.when(~F.array_contains(names, task) & holds, F.struct(F.lit(task).alias("task"), F.lit(default).alias("value"))))
            return F.filter(F.array(*extra), lambda x: x.isNotNull())

        names, values = F.transform(all_, lambda t: t["task"]), F.transform(all_, lambda t: t["value"])
        return F.array_sort(F.concat(all_, _once(names, lambda n: _once(values, lambda v: missing(n, v)))))

    return _once(tasks, fill)


def is_exclusion(name: str) -> bool:
    """Whether a class by its name stands for none of its siblings."""
    return name == "exclusion_class" or name.startswith(("other_", "no_"))


def exclusion_defaults(taxonomy: Taxonomy, classes: list[str] | None = None) -> dict[str, tuple[str, str]]:
    """Task -> (class it hangs on, default class), as ``fill_exclusions`` takes them, of a taxonomy's exclusion classes.

    These are ``classes``, or those that ``is_exclusion`` tells by name; of several in a task the first in the
    taxonomy's order. Tasks that are named ~main as columns are meant by their paths.
    """
    out: dict[str, tuple[str, str]] = {}
    paths = taxonomy.class_paths()
    for name in taxonomy.parents:
        if name in paths and (name in classes if classes is not None else is_exclusion(name)):
            task = path_tasks(paths[name])[-1][0]
            out.setdefault(task, (conditioning(task), name))
    return out


def multilabel(tasks: Column) -> Column:
    """The values of the tasks: the consistent label list."""
    return F.array_distinct(F.transform(tasks, lambda t: t["value"]))


def multiplex(df: DataFrame, labels: str, taxonomy: Taxonomy, output_format: str = "multiplex", defaults: dict[str, tuple[str, str]] | None = None, merged: dict[str, list[str]] | None = None) -> DataFrame:
    """Consistent task columns (or one list) of a label list: map, open paths, resolve conflicts, fill, widen, recompose.

    ``multiplex`` packs the columns of ``merged`` into lists, ``multiplex_without_merging`` keeps
    one column per task, ``multilabel`` gives label_list and postprocessed_label_list. Unknown
    formats are ``multiplex``. A row is resolved within itself: no shuffle.
    """
    from vellum.operators.labels import add_compounds

    paths = taxonomy.class_paths()
    tasks = resolve(label_tasks(preprocess(F.coalesce(F.col(labels), F.array().cast("array<string>")), taxonomy.maps_to), paths))
    out = df.withColumn("__tasks", fill_exclusions(tasks, defaults or {}))
    if output_format == "multilabel":
        out = out.withColumn("label_list", multilabel(F.col("__tasks")))
        return out.withColumn("postprocessed_label_list", add_compounds(F.col("label_list"), taxonomy.composed_by)).drop("__tasks")
    kids = taxonomy.children()
    names = sorted({t for p in paths.values() for t, _ in path_tasks(p)})
    out = out.withColumn("__tasks", task_map(F.col("__tasks")))
    out = out.select("*", *[F.coalesce(F.try_element_at(F.col("__tasks"), F.lit(t)), F.lit("")).alias(taxonomy._named(t, kids)) for t in names])
    if output_format != "multiplex_without_merging":
        for name, columns in (merged or {}).items():
            out = out.withColumn(name, F.filter(F.array(*[F.col(f"`{c}`") for c in columns]), lambda x: x != "")).drop(*columns)
    return out.drop("__tasks")


def disjoint_violations(df: DataFrame, key: str, labels: str, class_map: DataFrame) -> DataFrame:
    """(key, parent_class, n) of rows with several labels under one parent: siblings are disjoint.

    Spark broadcasts the classes if they are small, as a taxonomy's are; nothing is forced.
    """
    opened = df.select(key, F.explode(labels).alias("class_name")).distinct()
    return opened.join((class_map.select("class_name", "parent_class")), "class_name").groupBy(key, "parent_class").agg(F.count("*").alias("n")).where("n > 1")


def parent_model(task: str) -> str:
    """What a task's model hangs on: the task without what follows its last ':' or '.'."""
    at = max(task.rfind(":"), task.rfind("."))
    return task[:at] if at >= 0 else ""


def hierarchical_inference(df: DataFrame, models: dict[str, tuple[str | None, str | None, Column]]) -> DataFrame:
    """Score models level by level: {task: (parent task, parent's class that it needs, prediction column)}."""
    for task in sorted(models, key=lambda t: (t.count(":") + t.count("."), t)):
        parent, needs, prediction = models[task]
        df = df.withColumn(task, prediction if parent is None else F.when(F.col(f"`{parent}`") == needs, prediction))
    return df


def argmax_label(probabilities: Column, names: list[str]) -> Column:
    """The name at the highest probability, the first of equals."""
    return F.get(F.array(*map(F.lit, names)), (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int"))


def subclass_closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """class, ancestor, distance (the shortest) of every pair that subclass edges connect, from a table of any size.

    One round for each level: pairs found last are carried on to the children of their class, so a class
    meets no more rows than it has ancestors. A pair that is known isn't followed again, which ends
    cycles; a class in one is its own ancestor. Tables are written each round. Null ends and repeated edges change nothing.
    """
    spark = edges.sparkSession
    known = edges.select(F.col(child).alias("__child"), F.col(parent).alias("__parent")).where("__child is not null and __parent is not null").distinct()
    known, known_path = materialize(known, "taxonomy-edges")
    now, path = materialize(known.select(F.col("__child").alias("class"), F.col("__parent").alias("ancestor"), F.lit(1).alias("distance")), "taxonomy-pairs")
    found, paths = now, [path]
    while not now.isEmpty():
        below = now.join(known, F.col("class") == F.col("__parent")).select(F.col("__child").alias("class"), "ancestor", (F.col("distance") + 1).alias("distance")).distinct()
        now, path = materialize(below.join(found, ["class", "ancestor"], "left_anti"), "taxonomy-pairs")
        found = found.unionByName(now)
        paths.append(path)
    out, _ = materialize(found, "taxonomy-closure")
    forget(spark, known_path, *paths)
    return out


def taxonomy_errors(edges: DataFrame, root: str, child: str = "child", parent: str = "parent") -> DataFrame:
    """kind, class_name: every fault of a table of subclass edges below ``root``, none if it is a forest of well-formed trees.

    ``several parents``; ``recursion`` (a class below itself); ``empty tree`` (a child of the root without children);
    ``single child`` (the only child of a class other than the root); ``repeated edge``.
    """
    known = edges.select(F.col(child).alias("c"), F.col(parent).alias("p")).where("c is not null and p is not null")
    distinct = known.distinct()
    named = lambda df, kind, column="c": df.select(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("class_name"))
    top = distinct.where(F.col("p") == root)
    parts = [
        named(distinct.groupBy("c").agg(F.count("*").alias("n")).where("n > 1"), "several parents"),
        named(subclass_closure(known, "c", "p").where("class = ancestor"), "recursion", "class"),
        named(top.join(distinct.select(F.col("p").alias("__p")).distinct(), F.col("c") == F.col("__p"), "left_anti"), "empty tree"),
        named(distinct.where(F.col("p") != root).groupBy("p").agg(F.count("*").alias("n"), F.min("c").alias("c")).where("n = 1"), "single child"),
        named(known.groupBy("c", "p").agg(F.count("*").alias("n")).where("n > 1"), "repeated edge"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

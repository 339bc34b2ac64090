"""Models of a task hierarchy over vectors: trained as class means, scored level by level in one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.streaming.updates import run_stage


@dataclass(frozen=True)
class Task:
    """A task's model: ``load`` makes the function from vectors (rows) to class names, once a Spark task.

    A row is asked where its ``parent`` task's class is ``needs``; without a parent every row is.
    """

    load: Callable[[], Callable[[np.ndarray], list[str]]]
    parent: str | None = None
    needs: str | None = None


def usable(vector: Column, length: int | None = None) -> Column:
    """Whether a vector has no null and no element that isn't finite, and the given length."""
    v = vector.cast("array<double>")
    ok = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return ok if length is None else ok & (F.size(v) == length)


def centroids(df: DataFrame, vector: str, label: str) -> dict[str, np.ndarray]:
    """label -> mean vector over the usable rows with a label. The driver gathers one number for each label and place."""
    opened = df.where(F.col(label).isNotNull() & usable(F.col(vector))).select(F.col(label).cast("string").alias("label"), F.posexplode(F.col(vector).cast("array<double>")).alias("at", "x"))
    out: dict[str, list[tuple[int, float]]] = {}
    for r in opened.groupBy("label", "at").agg(F.avg("x").alias("x")).collect():
        out.setdefault(r["label"], []).append((r["at"], r["x"]))
    return {k: np.array([x for _, x in sorted(v)]) for k, v in out.items()}


def nearest_centroid(means: dict[str, np.ndarray]) -> Callable[[], Callable[[np.ndarray], list[str]]]:
    """A loader of the model that takes the class with the nearest mean; of equals the first by name."""

    def load() -> Callable[[np.ndarray], list[str]]:
        names = sorted(means)
        table = np.stack([means[n] for n in names])

        def predict(x: np.ndarray) -> list[str]:
            far = ((x[:, None, :] - table[None]) ** 2).sum(axis=2)
            return [names[i] for i in far.argmin(axis=1)]

        return predict

    return load


def _order(tasks: dict[str, Task]) -> list[str]:
    """Parents before what hangs on them."""
    out: list[str] = []
    while len(out) < len(tasks):
        ready = [t for t in sorted(tasks) if t not in out and (tasks[t].parent is None or tasks[t].parent in out)]
        if not ready:
            raise ValueError("the tasks' parents are unknown or lead in a circle")
        out += ready
    return out


def score_levels(df: DataFrame, key: str, vector: str, tasks: dict[str, Task], length: int | None = None, at_a_time: int = 1024) -> DataFrame:
    """key and a string column for each task: its class, null where it isn't asked or the vector isn't usable.

    One pass over the rows: every model is loaded once a Spark task, and a level asks only the rows whose parent
    class calls for it. Nothing is shuffled.
    """
    order = _order(tasks)
    schema = df.select(F.col(key)).schema.simpleString()[len("struct<") : -1].replace(":", " ", 1) + "".join(f", `{t}` string" for t in order)
    good = F.when(usable(F.col(vector), length), F.col(vector).cast("array<double>"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = None
        for whole in batches:
            for lo in range(0, whole.num_rows, at_a_time):
                b = whole.slice(lo, at_a_time)
                models = models or {t: tasks[t].load() for t in order}
                vectors = b.column(1).to_pylist()
                found: dict[str, list[str | None]] = {}
                for t in order:
                    task = tasks[t]
                    asked = [i for i, v in enumerate(vectors) if v is not None and (task.parent is None or found[task.parent][i] == task.needs)]
                    found[t] = [None] * len(vectors)
                    if asked:
                        for i, c in zip(asked, models[t](np.array([vectors[i] for i in asked])), strict=True):
                            found[t][i] = c
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(found[t], pa.string()) for t in order]], names=[key, *order])

    return df.select(F.col(key), good.alias("__vector")).mapInArrow(run, schema)


def score_new(df: DataFrame, path: str, key: str, vector: str, tasks: dict[str, Task], length: int | None = None) -> DataFrame:
    """The scores of all rows, of which only those not in the table at ``path`` yet are scored, and added to it."""
    return run_stage(df.sparkSession, df, path, key, lambda new: score_levels(new, key, vector, tasks, length))

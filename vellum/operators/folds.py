"""Folds and batches for training: groups stay together, labels stay balanced."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.operators.sequences import prefix_sums


def stratified_group_folds(df: DataFrame, group: str, label: str, folds: int = 10, validation: int = 2, seed: int = 0, order: Column | None = None) -> DataFrame:
    """The rows with ``fold`` and ``is_valid`` (fold below ``validation``): a group's rows share a fold.

    A group belongs to its most frequent label (of equals the first). The groups of a label, larger ones first and
    equals in an order drawn by ``seed`` (or by ``order``), are dealt to the folds forwards and backwards in turn: folds of a label
    differ by one group, and in rows by those of its largest group at most. Places come from prefix sums
    over range partitions, so a label of any size is many tasks. Null groups and labels are a group and a label.
    """
    counts = df.groupBy(group, label).agg(F.count("*").alias("n"))
    first = F.min_by(F.struct(F.col(label).alias("l")), F.struct(-F.col("n"), F.col(label)))["l"]
    main = counts.groupBy(group).agg(first.alias("__main"), F.sum("n").alias("__rows"))
    main = main.withColumns({"__order": F.xxhash64(F.lit(seed), F.col(group)) if order is None else order, "__less": -F.col("__rows"), "__one": F.lit(1)})
    placed = prefix_sums(main, ["__main"], ["__less", "__order", group], "__one", "__place", "__total")
    forwards = F.pmod("__place", F.lit(folds))
    fold = F.when(F.expr(f"__place div {folds}") % 2 == 0, forwards).otherwise(folds - 1 - forwards)
    if order is None:
        # Another start for each label, so that the first folds don't get all remainders.
        fold = F.pmod(fold + F.pmod(F.xxhash64(F.lit(seed), "__main"), F.lit(folds)), F.lit(folds))
    dealt = placed.select(F.col(group).alias("__group"), fold.cast("int").alias("fold"))
    return df.join(dealt, F.col(group).eqNullSafe(F.col("__group"))).drop("__group").withColumn("is_valid", F.col("fold") < validation)


#: Units of the largest weight: sums of up to 2**33 such weights are exact.
WEIGHT_UNITS = 1 << 30


def weighted_draw(df: DataFrame, key: list[str], weight: str, n: int, seed: int = 0, order: Column | None = None, offset: float | None = None, copies: str = "copies") -> DataFrame:
    """Exactly ``n`` draws with replacement, by weight: the drawn rows with ``copies``, how often each is drawn.

    Systematic resampling: rows stand in an order drawn by ``seed`` (or by ``order``; ties by ``key``, which is
    distinct), each as long as its weight, and n equally spaced points fall on them. A row is drawn n * weight / total
    times, rounded up or down. Weights are taken in whole units of the largest, so the draw is the same for any
    partitioning; those that are null, not finite or not positive are never drawn. Without weights nothing is drawn.
    """
    given = F.col(weight).cast("double")
    usable = df.where((given > 0) & (given < float("inf")) & ~F.isnan(given))
    most = usable.agg(F.max(given)).first()[0]
    if most is None or n <= 0:
        return df.limit(0).withColumn(copies, F.lit(0).cast("bigint"))
    units = F.greatest(F.round(given / F.lit(most) * WEIGHT_UNITS), F.lit(1)).cast("decimal(20,0)")
    dealt = usable.withColumns({"__units": units, "__all": F.lit(0), "__order": F.xxhash64(F.lit(seed), *key) if order is None else order})
    placed = prefix_sums(dealt, ["__all"], ["__order", *key], "__units", "__before", "__total")
    start = F.lit(offset) if offset is not None else F.pmod(F.xxhash64(F.lit(seed)), F.lit(1 << 20)) / (1 << 20)
    wide = lambda c: c.cast("decimal(38,0)")
    placed = placed.withColumns({"__n": F.lit(n).cast("decimal(10,0)"), "__start": F.floor(wide(F.col("__total")).cast("double") * start).cast("decimal(28,0)"), "__b": F.col("__before").cast("decimal(28,0)"), "__t": F.col("__total").cast("decimal(28,0)"), "__u": F.col("__units").cast("decimal(28,0)")})
    # The points below a place: how many fall on a row is the difference at its ends.
    drawn = F.expr("((__b + __u) * __n + __start) div __t - (__b * __n + __start) div __t")
    return placed.withColumn(copies, drawn.cast("bigint")).where(F.col(copies) > 0).select(*df.columns, copies)


def drawn_rows(draw: DataFrame, copies: str = "copies") -> DataFrame:
    """A row for each draw of ``weighted_draw``."""
    return draw.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop("__copy", copies)


def most_first(df: DataFrame, measure: str, *ties: str, limit: int | None = None) -> DataFrame:
    """Rows by a measure, the largest first (counts, losses), ties by the other columns; a limit takes the top."""
    out = df.orderBy(F.desc(measure), *ties)
    return out if limit is None else out.limit(limit)


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """The distinct keys in an order drawn by the seed, the same every time."""
    return df.select(key).distinct().orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key))


def fill_predictions(known: DataFrame, images: DataFrame, key: str, columns: list[str], predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``known`` with null ``columns`` filled by ``predict``, which sees only the images still without them.

    What was predicted before isn't asked again, so a run that was cut off goes on where it stopped.
    """
    missing = known.where(F.coalesce(*columns).isNull()).select(key)
    found = predict(images.join(missing, key, "left_semi")).select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = known.join(found, key, "left")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in columns else F.col(c) for c in known.columns])

"""Ordered operators: sessions, carried values, ranks, row ids, transitions, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.ids import numbered
from vellum.storage import materialize


def sessions(df: DataFrame, group: str, order: str, marker: Column, name: str = "session") -> DataFrame:
    """Number the runs that begin at a marked row of each group; rows before the first mark are dropped."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.coalesce(marker, F.lit(False)).cast("int")).over(w)).where(F.col(name) > 0)


def sessions_first_rule(df: DataFrame, group: str, order: str, rules: list[Column], name: str = "session") -> DataFrame:
    """As ``sessions``; each group's marker is the first rule that any of its rows meets."""
    whole = Window.partitionBy(group)
    marker = F.lit(False)
    for rule in reversed(rules):
        rule = F.coalesce(rule, F.lit(False))
        marker = F.when(F.max(rule).over(whole), rule).otherwise(marker)
    return sessions(df.withColumn("__marker", marker), group, order, F.col("__marker"), name).drop("__marker")


def session_texts(df: DataFrame, group: str, session: str, order: str, text: str, glue: str = "\n") -> DataFrame:
    """One row per session: its texts in order, joined."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return df.groupBy(group, session).agg(F.array_join(F.transform(parts, lambda p: p["t"]), glue).alias(text))


def carry_forward(df: DataFrame, group: str, order: str, column: str, name: str | None = None) -> DataFrame:
    """The last value that isn't null, up to and with the row."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name or column, F.last(column, ignorenulls=True).over(w))


def rank_within(df: DataFrame, group: str, order: list[str], name: str = "rank", dense: bool = False) -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, (F.dense_rank() if dense else F.row_number()).over(w))


def transitions(df: DataFrame, group: str, order: str, flag: Column) -> DataFrame:
    """Rows at which a flag differs from the row before, and each group's first and last row."""
    w = Window.partitionBy(group).orderBy(order)
    out = df.withColumn("__flag", flag)
    out = out.withColumn("__before", F.lag("__flag").over(w)).withColumn("__after", F.lead(F.lit(1)).over(w))
    first = F.row_number().over(w) == 1
    return out.withColumn("__first", first).where("__first or __after is null or not (__flag <=> __before)").drop("__flag", "__before", "__after", "__first")


def wide_intervals(df: DataFrame, group: str, position: str, least: int) -> DataFrame:
    """(group, low, high) of neighbouring positions that lie at least ``least`` apart."""
    w = Window.partitionBy(group).orderBy(position)
    out = df.select(group, F.col(position).alias("low"), F.lead(position).over(w).alias("high"))
    return out.where(F.col("high") - F.col("low") >= least)


def _in_partitions(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """The rows with __part and __at: range partitions in order, and the place in each.

    The bounds of range partitions are sampled anew whenever their plan runs, so the table
    is written once; sizes and rows are both read from what was written.
    """
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    dealt = dealt.sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    return materialize(dealt.withColumn("__at", F.monotonically_increasing_id() - F.shiftleft(F.col("__part").cast("bigint"), 33)), "numbered")[0]


def _sizes(placed: DataFrame) -> list[tuple[int, int]]:
    """(partition, rows): one row a partition, however many rows there are."""
    return [(r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count("*").alias("n")).orderBy("__part").collect()]


def _numbered(placed: DataFrame, sizes: list[tuple[int, int]], name: str) -> DataFrame:
    before, at = [], 0
    for part, n in sizes:
        before.append((part, at))
        at += n
    # One small row a partition: its size is that of the job's plan, not of the data.
    table = F.broadcast(placed.sparkSession.createDataFrame(before or [(0, 0)], "__part int, __before long"))
    return placed.join(table, "__part").withColumn(name, F.col("__before") + F.col("__at") + 1).drop("__part", "__at", "__before")


def dense_numbers(df: DataFrame, order: list[str], name: str = "number", parts: int | None = None) -> DataFrame:
    """Number all rows from 1 in the given total order, without one window over the whole table.

    Rows are range-partitioned, sorted and written; the partitions' sizes give each its
    first number. The driver gathers one size per partition. Rows that tie in ``order`` get
    numbers of their own in some order.
    """
    placed = _in_partitions(df, order, parts)
    return _numbered(placed, _sizes(placed), name)


def prefix_sums(df: DataFrame, groups: list[str], order: list[str], amount: str, name: str = "before", total: str = "total", parts: int | None = None) -> DataFrame:
    """The rows with the sum of ``amount`` over the rows of their group that come before them, and over all rows of the group.

    No window holds a group: rows are range-partitioned by group and order and written, a window sums within the
    part of a group that one partition holds, another the partitions' sums, of which a group has one a partition.
    ``order`` is total within a group, amounts are integers or decimals, so sums don't depend on the partitions.
    """
    placed = _in_partitions(df, [*groups, *order], parts).drop("__at")
    sums = placed.groupBy(*groups, "__part").agg(F.sum(amount).alias("__sum"))
    whole = Window.partitionBy(*groups)
    ahead = F.sum("__sum").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.col("__part").alias("__p"), F.coalesce(ahead, F.lit(0)).alias("__ahead"), F.sum("__sum").over(whole).alias(total))
    own = F.sum(amount).over(Window.partitionBy("__part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    on = F.col("__part") == F.col("__p")
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    out = placed.withColumn("__own", F.coalesce(own, F.lit(0))).join(sums, on).withColumn(name, F.col("__ahead") + F.col("__own"))
    return out.select(*df.columns, name, total)


def row_ids(df: DataFrame, order: list[str], prefix: str, width: int, name: str) -> DataFrame:
    """prefix and zero-padded row number in the given order, from 0."""
    return dense_numbers(df, order, "__number").withColumn(name, numbered(prefix, F.col("__number") - 1, width)).drop("__number")


def shards(df: DataFrame, n: int, order: list[str], name: str = "shard") -> DataFrame:
    """Deal the rows in order to n shards whose sizes differ by one at most; none is lost."""
    placed = _in_partitions(df, order)
    sizes = _sizes(placed)
    total = sum(size for _, size in sizes)
    big, size = total % n, total // n
    at = F.col("__number") - 1
    edge = big * (size + 1)
    late = F.floor((at - edge) / F.lit(max(size, 1))) + big
    return _numbered(placed, sizes, "__number").withColumn(name, F.when(at < edge, F.floor(at / F.lit(size + 1))).otherwise(late).cast("int")).drop("__number")


def grid_order(df: DataFrame, y: str, x: str, cell: int = 50) -> DataFrame:
    """Rows by cell: top to bottom, then left to right."""
    return df.orderBy(F.floor(F.col(y) / cell), F.floor(F.col(x) / cell), y, x)


def grid_rank(df: DataFrame, group: str, y: str, x: str, ties: list[str], cell: int = 50, name: str = "rank") -> DataFrame:
    """Place of each box in its group's reading order: rows of cells from above, then from the left."""
    w = Window.partitionBy(group).orderBy(F.floor(F.col(y) / cell), F.floor(F.col(x) / cell), *ties)
    return df.withColumn(name, F.row_number().over(w))

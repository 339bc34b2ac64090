"""Operator 13, ordered funnel counting: a successor-edge table, composed edge by edge for each funnel.

``successor_edges`` finds, for every event and every kind that may follow it in some funnel, the
client's earliest later event of that kind, and which excluded kinds lie between. It is made
and written once for the distinct pairs of kinds of all funnels. A funnel then joins edges from its
last pair to its first: what follows a target is composed once, however many attempts share
the target, and the attempts' times collapse into weighted histograms, from which counts and
percentiles come.

A funnel ends ``limit`` after its first step, so a successor farther off than that is of no
use, and no client needs one task: events are dealt by client and time bucket, and those at a
bucket's beginning also to the bucket before. A task's group holds the events of one
client in a few minutes. Percentiles are found in two steps, by a coarse and a fine part of a
time, so their windows hold some 17,000 rows at most, whatever a client has.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import materialize

MINUTE = 60_000_000


@dataclass(frozen=True)
class Funnel:
    """Steps in order (two or more), and the kind that ends an attempt when it comes between two of them (None: nothing does)."""

    name: str
    steps: tuple[str, ...]
    excluded: str | None = None

    @property
    def pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.steps, self.steps[1:], strict=False))


#: The funnels of the query.
FUNNELS = (
    Funnel("A", ("view", "click", "view", "purchase"), "error"),
    Funnel("B", ("signup", "view", "click", "purchase"), "error"),
    Funnel("C", ("click", "click", "purchase", "view"), "signup"),
)
#: Length of a time bucket, in limits: events in a bucket's first limit are dealt twice.
BUCKET_LIMITS = 4


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a timestamp column; one without a zone is taken as it stands, whatever the session's zone."""
    c = F.col(column)
    if df.schema[column].dataType.typeName() != "timestamp_ntz":
        return F.unix_micros(c.cast("timestamp"))
    second = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return ((F.unix_date(F.to_date(c)).cast("bigint") * 24 + F.hour(c)) * 60 + F.minute(c)) * MINUTE + second


def events_of(df: DataFrame, client_col: str, kind_col: str, time_col: str) -> DataFrame:
    """client, kind, t (microseconds) of the rows without a null; repeated rows are still there."""
    out = df.select(F.col(client_col).alias("client"), F.col(kind_col).cast("string").alias("kind"), micros(df, time_col).alias("t"))
    return out.where("client is not null and kind is not null and t is not null")


def successor_edges(events: DataFrame, pairs: list[tuple[str, str]], excluded: list[str], limit: int) -> DataFrame:
    """client, pair (number in ``pairs``), t, next_t, x0, x1, ...: one row for each distinct event and pair that begins with its kind.

    next_t is the time of the client's earliest later event of the pair's second kind, null if
    there is none within ``limit``. x<i> tells whether an event of ``excluded[i]`` lies
    after t and not after next_t.
    """
    span = BUCKET_LIMITS * limit
    kinds = sorted({k for pair in pairs for k in pair} | set(excluded))
    bucket = F.expr(f"(t - pmod(t, {span})) div {span}")
    dealt = events.where(F.col("kind").isin(kinds)).withColumn("b", bucket)
    early = F.pmod("t", F.lit(span)) <= limit
    dealt = dealt.select("client", "kind", "t", F.posexplode(F.when(early, F.array("b", F.col("b") - 1)).otherwise(F.array("b"))).alias("ahead", "b"))
    dealt = dealt.repartition("client", "b").dropDuplicates(["client", "b", "kind", "t", "ahead"])
    later = Window.partitionBy("client", "b").orderBy(F.desc("t")).rangeBetween(Window.unboundedPreceding, -1)
    # Repeats within a group don't change a minimum, and every group is some minutes of one client.
    near = dealt.select("client", "kind", "t", "ahead", *[F.min(F.when(F.col("kind") == k, F.col("t"))).over(later).alias(f"next_{i}") for i, k in enumerate(kinds)]).where("ahead = 0")

    def edge(number: int, to: str) -> Column:
        next_t = F.col(f"next_{kinds.index(to)}")
        next_t = F.when(next_t - F.col("t") <= limit, next_t)
        seen = [F.coalesce(F.col(f"next_{kinds.index(x)}") <= next_t, F.lit(False)).alias(f"x{i}") for i, x in enumerate(excluded)]
        return F.struct(F.lit(number).alias("pair"), next_t.alias("next_t"), *seen)

    out = None
    for kind in kinds:
        own = [edge(i, b) for i, (a, b) in enumerate(pairs) if a == kind]
        if own:
            out = F.when(F.col("kind") == kind, F.array(*own)) if out is None else out.when(F.col("kind") == kind, F.array(*own))
    return near.select("client", "t", F.explode(out).alias("e")).select("client", "e.pair", "t", "e.next_t", *[f"e.x{i}" for i in range(len(excluded))])


def compose(edges: DataFrame, funnel: Funnel, pairs: list[tuple[str, str]], excluded: list[str], limit: int) -> DataFrame:
    """client, step (2 and later), d, w: how many attempts reach a step d microseconds behind the step before.

    Chains are composed from the last pair to the first, once for each target.
    """
    open_to = F.lit(True) if funnel.excluded is None else ~F.col(f"x{excluded.index(funnel.excluded)}")
    steps = [edges.where(F.col("pair") == pairs.index(p)).where(F.col("next_t").isNotNull() & open_to).select("client", "t", F.col("next_t").alias(f"s{k}")) for k, p in enumerate(funnel.pairs, start=2)]
    chain = steps[-1]
    for k in range(len(steps) - 2, -1, -1):
        reached = [c for c in chain.columns if c.startswith("s")]
        rest = chain.select(F.col("client").alias("__c"), F.col("t").alias("__t"), *reached)
        joined = steps[k].join(rest, (F.col("client") == F.col("__c")) & (F.col(f"s{k + 2}") == F.col("__t")), "left")
        chain = joined.select("client", "t", f"s{k + 2}", *[F.when(F.col(c) - F.col("t") <= limit, F.col(c)).alias(c) for c in reached])
    last = len(funnel.steps)
    took = [F.struct(F.lit(k).alias("step"), (F.col(f"s{k}") - F.col("t" if k == 2 else f"s{k - 1}")).alias("d")) for k in range(2, last + 1)]
    out = chain.select("client", F.explode(F.filter(F.array(*took), lambda x: x["d"].isNotNull())).alias("x"))
    return out.groupBy("client", "x.step", "x.d").agg(F.count("*").alias("w"))


def weighted_percentiles(hist: DataFrame, keys: list[str], percent: int, limit: int) -> DataFrame:
    """keys, n, value: the sum of w, and the ceil(percent * n / 100)-th smallest d, of a histogram (keys, d, w) with 0 <= d <= limit.

    First the coarse part of d that holds the value is found, then the value among those
    with this part: both windows hold at most sqrt(limit) + 1 rows.
    """
    width = math.isqrt(limit) + 1
    parted = hist.withColumn("coarse", F.expr(f"d div {width}"))
    rank = F.expr(f"(n * {percent} + 99) div 100")
    rows = parted.groupBy(*keys, "coarse").agg(F.sum("w").alias("w"))
    whole = Window.partitionBy(*keys)
    rows = rows.select(*keys, "coarse", "w", F.sum("w").over(whole.orderBy("coarse").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("w").over(whole).alias("n")).withColumn("rank", rank)
    at, _ = materialize(rows.where("upto >= rank and upto - w < rank").select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("coarse").alias("__coarse"), "n", (F.col("rank") - F.col("upto") + F.col("w")).alias("rank")), "funnel-ranks")
    on = F.col("coarse") == F.col("__coarse")
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    inside = parted.join(at, on).select(*keys, "coarse", "d", "w", "n", "rank")
    upto = F.sum("w").over(Window.partitionBy(*keys, "coarse").orderBy("d").rowsBetween(Window.unboundedPreceding, 0))
    return inside.withColumn("upto", upto).where("upto >= rank and upto - w < rank").select(*keys, "n", F.col("d").alias("value"))


def funnel_counts(events: DataFrame, funnels: tuple[Funnel, ...] = FUNNELS, limit: int = 5 * MINUTE, percent: int = 25, client_col: str = "client_id", kind_col: str = "kind", time_col: str = "arrived_at") -> DataFrame:
    """One row for each funnel and client with attempts: funnel, client_id, n1 to nK, deepest, t2 to tK, same_depth.

    An event of the first step's kind starts an attempt. The next step is the client's
    earliest event of its kind later than the step before (events of one time don't follow each other); it is
    reached unless it lies over ``limit`` microseconds after the first step, or an excluded
    event lies after the step before and not after the next. n<k> counts the attempts that reach
    step k, t<k> is the ``percent``-th percentile (the ceil(percent * n / 100)-th smallest) of the
    times from step k - 1, null where none reached it. deepest is the last step that any attempt reached, same_depth the number of
    clients of the funnel with this deepest. K is the number of steps of the longest funnel;
    n<k> beyond a funnel's own steps is 0.

    Rows with a null client, kind or time are left out, rows that repeat all three are one; an empty
    table gives an empty result; other columns are ignored, whatever their names. Edges,
    histograms and counts are written to the shared folder. Nothing that grows goes to the driver or is broadcast.
    """
    longest = max(len(f.steps) for f in funnels)
    pairs = sorted({p for f in funnels for p in f.pairs})
    excluded = sorted({f.excluded for f in funnels if f.excluded is not None})
    edges, _ = materialize(successor_edges(events_of(events, client_col, kind_col, time_col), pairs, excluded, limit), "funnel-edges")
    hists, starts = None, None
    for f in funnels:
        name = F.lit(f.name).alias("funnel")
        hist = compose(edges, f, pairs, excluded, limit).select(name, "client", "step", "d", "w")
        first = edges.where(F.col("pair") == pairs.index(f.pairs[0])).groupBy("client").agg(F.count("*").alias("n1")).select(name, "client", "n1")
        hists, starts = (hist, first) if hists is None else (hists.unionByName(hist), starts.unionByName(first))
    hist, _ = materialize(hists, "funnel-histograms")
    later = weighted_percentiles(hist, ["funnel", "client", "step"], percent, limit)
    # One row for each step that a client reached: its counts become columns.
    wide = later.unionByName(starts.select("funnel", "client", F.lit(1).alias("step"), F.col("n1").alias("n"), F.lit(None).cast("bigint").alias("value"))).groupBy("funnel", "client").agg(
        *[F.coalesce(F.max(F.when(F.col("step") == k, F.col("n"))), F.lit(0).cast("bigint")).alias(f"n{k}") for k in range(1, longest + 1)],
        F.max("step").cast("int").alias("deepest"),
        *[F.max(F.when(F.col("step") == k, F.col("value"))).alias(f"t{k}") for k in range(2, longest + 1)],
    )
    wide, _ = materialize(wide, "funnel-clients")
    # At most one row for each funnel and step.
    depths = wide.groupBy("funnel", "deepest").agg(F.count("*").alias("same_depth"))
    return wide.join(F.broadcast(depths), ["funnel", "deepest"]).select("funnel", F.col("client").alias("client_id"), *[f"n{k}" for k in range(1, longest + 1)], "deepest", *[f"t{k}" for k in range(2, longest + 1)], "same_depth")


def _oracle(funnel: Funnel) -> str:
    """DuckDB: attempts walked by as-of joins, one a step."""
    a, b, c, d = funnel.steps
    step = lambda k, kind: f"""
      f{k} AS (SELECT p.*, CASE WHEN p.t{k - 1} IS NOT NULL AND n.t <= p.t1 + 300000000 AND (x.t IS NULL OR x.t > n.t) THEN n.t END AS t{k}
        FROM f{k - 1} p ASOF LEFT JOIN (SELECT * FROM ev WHERE kind = '{kind}') n ON p.client_id = n.client_id AND p.t{k - 1} < n.t
        ASOF LEFT JOIN (SELECT * FROM ev WHERE kind = '{funnel.excluded}') x ON p.client_id = x.client_id AND p.t{k - 1} < x.t)"""  # noqa: E731
    at = lambda k: f"list_sort(list(t{k} - t{k - 1}) FILTER (t{k} IS NOT NULL))[CAST(ceil(25 * count(t{k}) / 100.0) AS BIGINT)] AS t{k}"
    return f"""SELECT * FROM (WITH f1 AS (SELECT client_id, t AS t1 FROM ev WHERE kind = '{a}'),{step(2, b)},{step(3, c)},{step(4, d)}
      SELECT '{funnel.name}' AS funnel, client_id, count(*) AS n1, count(t2) AS n2, count(t3) AS n3, count(t4) AS n4, {at(2)}, {at(3)}, {at(4)} FROM f4 GROUP BY client_id)"""


ORACLE = f"""
  WITH ev AS MATERIALIZED (SELECT DISTINCT client_id, kind, epoch_us(arrived_at) AS t FROM clicks WHERE client_id IS NOT NULL AND kind IS NOT NULL AND arrived_at IS NOT NULL),
  u AS ({" UNION ALL ".join(map(_oracle, FUNNELS))}),
  r AS (SELECT *, CAST(CASE WHEN n4 > 0 THEN 4 WHEN n3 > 0 THEN 3 WHEN n2 > 0 THEN 2 ELSE 1 END AS INTEGER) AS deepest FROM u)
  SELECT *, count(*) OVER (PARTITION BY funnel, deepest) AS same_depth FROM r
"""

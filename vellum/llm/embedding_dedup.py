"""Operator 3, embedding near-dedup: a robust-pruned flat graph over overlapping cluster shards.

Vectors of one label and dimension are split into shards around sampled centres, each
vector going to its three nearest; shards that are still large are split again. Dense groups
aren't cut: shards that stay too large for them are compared exactly, block by block. In any
other shard a flat graph is built: nodes search for their place from the medoid, keep neighbours by
robust pruning and are linked back. The adjacency lists that a vector got in its shards
are united. On the united lists every vector searches from its shard's medoid with a
beam, then expands through all nodes in range. Each pair found is verified by its cosine
in double precision. Equal vectors are one node with a multiplicity, and a pair that two
shards hold is counted in the lower one, so links are counted without listing them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import batch, materialize, rows
from vellum.llm.components import connected_components

DEGREE, BEAM, ALPHA, BATCH = 16, 32, 1.2, 256
#: Members a shard has on average, shards that a vector goes to, and centres of one split at most.
SHARD, COPIES, CENTRES = 600, 3, 256
#: Members of a block and of a tile in the exact comparison; what the name of a shard that goes there begins with (it sorts before all others).
BLOCK, TILE, EXACT = 4096, 512, "!"
_VEC = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("vec", pa.binary())])


def unit(x: list | None) -> bytes | None:
    """The vector at length 1 as doubles; None if it is null, zero, or holds a null or non-finite component."""
    if not x or None in x:
        return None
    v = np.array(x, dtype=np.float64)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v /= top
    v /= np.sqrt(v @ v)
    return (v + 0.0).tobytes()


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, labels, vectors in rows(batches, ["vec_id", "label", "embedding"]):
        found = [unit(v) for v in vectors]
        yield batch(_VEC, [ids, labels, [None if v is None else len(v) // 8 for v in found], found])


def greedy(x: np.ndarray, adjacent: np.ndarray, queries: np.ndarray, start: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of many queries in step: (beam nodes, their similarities)."""
    b, n = len(queries), len(x)
    node = np.full((b, beam), -1)
    sim = np.full((b, beam), -np.inf)
    open_ = np.zeros((b, beam), bool)
    seen = np.zeros((b, n), bool)
    node[:, 0], sim[:, 0], open_[:, 0], seen[:, start] = start, queries @ x[start], True, True
    every = np.arange(b)
    while len(every):
        best = np.where(open_[every], sim[every], -np.inf).argmax(axis=1)
        every, best = every[m := open_[every, best]], best[m]
        if not len(every):
            break
        open_[every, best] = False
        near = adjacent[node[every, best]]
        fresh = (near >= 0) & ~seen[every[:, None], near]
        seen[np.repeat(every, near.shape[1])[fresh.ravel()], near[fresh]] = True
        s = np.where(fresh, np.einsum("qd,qkd->qk", queries[every], x[near]), -np.inf)
        nodes, sims = np.concatenate([node[every], near], axis=1), np.concatenate([sim[every], s], axis=1)
        opens = np.concatenate([open_[every], fresh], axis=1)
        top = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
        node[every], sim[every], open_[every] = (np.take_along_axis(v, top, axis=1) for v in (nodes, sims, opens))
        open_[every] &= sim[every] > -np.inf
    return node, sim


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each point: the nearest candidate, then the next one that no kept one covers, ...; free places go to the nearest rest."""
    valid = (candidates >= 0) & (candidates != points[:, None])
    c = np.where(valid, candidates, 0)
    far = np.where(valid, 1 - np.einsum("pd,pcd->pc", x[points], x[c]), np.inf)
    order = np.argsort(far, axis=1, kind="stable")
    c, far = np.take_along_axis(c, order, axis=1), np.take_along_axis(far, order, axis=1)
    # Repeated candidates stand side by side only if equally far; strike them out wherever they are.
    between = 1 - np.einsum("pcd,ped->pce", x[c], x[c])
    alive = np.isfinite(far)
    twice = (c[:, :, None] == c[:, None, :]) & alive[:, :, None] & alive[:, None, :]
    alive &= ~np.tril(twice, -1).any(axis=2)
    usable, kept = alive.copy(), np.full((len(points), degree), -1)
    every = np.arange(len(points))
    for k in range(degree):
        first = alive.argmax(axis=1)
        some = alive[every, first]
        if not some.any():
            break
        kept[some, k] = c[every, first][some]
        usable[every[some], first[some]] = False
        alive &= ~(alpha * between[every, first] <= far) | ~some[:, None]
        alive[every[some], first[some]] = False
    free = kept < 0
    rest = np.where(usable, np.arange(c.shape[1]), c.shape[1])
    rest = np.sort(rest, axis=1)[:, :degree]
    rank = np.cumsum(free, axis=1) - 1
    at = np.take_along_axis(np.pad(rest, ((0, 0), (0, max(0, degree - rest.shape[1]))), constant_values=c.shape[1]), np.clip(rank, 0, degree - 1), axis=1)
    filled = np.take_along_axis(np.pad(c, ((0, 0), (0, 1)), constant_values=-1), at, axis=1)
    return np.where(free, filled, kept)


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(axis=0)).argmax())


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> np.ndarray:
    """Adjacency lists (padded with -1) of the flat graph over unit vectors."""
    n = len(x)
    adjacent = np.full((n, degree), -1)
    if n < 2:
        return adjacent
    rng = np.random.default_rng(0)
    some = min(degree, n - 1)
    adjacent[:, :some] = (np.arange(n)[:, None] + rng.integers(1, n, (n, some))) % n
    start, order = medoid(x), rng.permutation(n)
    for i in range(0, n, BATCH):
        points = order[i : i + BATCH]
        found, _ = greedy(x, adjacent, x[points], start, beam)
        adjacent[points] = robust_prune(x, points, np.concatenate([found, adjacent[points]], axis=1), degree, alpha)
        # Link back: the new neighbours of each target, at most `degree` of them at a time.
        source, target = np.repeat(points, degree), adjacent[points].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        rank = np.arange(len(target)) - np.repeat(first, np.diff(np.r_[first, len(target)]))
        for low in range(0, int(rank.max(initial=-1)) + 1, degree):
            part = (rank >= low) & (rank < low + degree)
            targets, row = np.unique(target[part], return_inverse=True)
            extra = np.full((len(targets), degree), -1)
            extra[row, rank[part] - low] = source[part]
            for k in range(0, len(targets), BATCH):
                t = targets[k : k + BATCH]
                adjacent[t] = robust_prune(x, t, np.concatenate([adjacent[t], extra[k : k + BATCH]], axis=1), degree, alpha)
    return adjacent


def range_search(x: np.ndarray, adjacent: np.ndarray, threshold: float, beam: int = BEAM, margin: float = 0.03) -> np.ndarray:
    """Symmetric matrix of the pairs found: greedy search from the medoid, then expansion through all nodes in range."""
    n = len(x)
    found = np.zeros((n, n), bool)
    start = medoid(x)
    for i in range(0, n, BATCH):
        q = np.arange(i, min(n, i + BATCH))
        node, sim = greedy(x, adjacent, x[q], start, beam)
        # Nodes that a full beam dropped may be in range: only the beam counts as visited.
        seen = np.zeros((len(q), n + 1), bool)
        seen[np.arange(len(q))[:, None], node] = True
        a, k = np.nonzero(sim >= threshold - margin)
        front = node[a, k]
        found[q[a], front] |= sim[a, k] >= threshold
        # The query is a node of the graph itself: its own neighbours count as reached.
        a, front = np.concatenate([a, np.arange(len(q))]), np.concatenate([front, q])
        seen[np.arange(len(q)), q] = True
        while len(a):
            near = adjacent[front]
            b, near = np.repeat(a, near.shape[1]), near.ravel()
            ok = near >= 0
            ok[ok] = ~seen[b[ok], near[ok]]
            key = np.unique(b[ok] * n + near[ok])
            b, near = key // n, key % n
            seen[b, near] = True
            s = np.concatenate([np.einsum("ij,ij->i", x[q[b[j : j + 65536]]], x[near[j : j + 65536]]) for j in range(0, len(b), 65536)] or [np.zeros(0)])
            found[q[b], near] |= s >= threshold
            a, front = b[m := s >= threshold - margin], near[m]
    found |= found.T
    np.fill_diagonal(found, False)
    return found


def _matrix(column) -> np.ndarray:
    return np.stack([np.frombuffer(v) for v in column])


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    ids = pdf["rep"].to_numpy()
    return pd.DataFrame({"rep": ids, "near": [ids[a[a >= 0]] for a in build(_matrix(pdf["vec"]))]})


def _search_shard(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", ignore_index=True)
        ids, n = pdf["rep"].to_numpy(), len(pdf)
        place = {r: i for i, r in enumerate(ids.tolist())}
        lists = [[place[r] for r in near if r in place] for near in pdf["near"]]
        adjacent = np.full((n, max(1, max(map(len, lists)))), -1)
        for i, near in enumerate(lists):
            adjacent[i, : len(near)] = near
        found = range_search(_matrix(pdf["vec"]), adjacent, threshold)
        # A pair counts in the first of the shards that both are in.
        me = pdf["shard"].iloc[0]
        first = {frozenset(s): s for s in map(tuple, map(sorted, pdf["shards"]))}
        kinds = list(first.values())
        kind = np.array([kinds.index(tuple(sorted(s))) for s in pdf["shards"]])
        owns = np.array([[min(set(a) & set(b)) == me for b in kinds] for a in kinds])
        weight = pdf["n"].to_numpy()
        links = np.array([(weight[j] * owns[kind[i], kind[j]]).sum() for i, j in ((i, np.flatnonzero(found[i])) for i in range(n))], dtype=np.int64)
        group = np.arange(n)
        while True:
            low = np.array([min(group[i], group[found[i]].min(initial=n)) for i in range(n)])
            low = low[low]
            if (low == group).all():
                break
            group = low
        return pd.DataFrame({"rep": ids, "links": links, "root": ids[group]})

    return run


def spread(centres: np.ndarray, closest: float = 0.9) -> np.ndarray:
    """The centres without those that lie close to an earlier one: a dense group then has one centre and stays together."""
    kept: list[int] = []
    for i, s in enumerate(centres @ centres.T):
        if not (s[kept] >= closest).any():
            kept.append(i)
    return centres[kept]


def _thin(copies: int, level: int):
    """The drawn centres of a shard without close ones; none if the shard can't be split without cutting a dense group.

    Behind the first level that is so if over half of the drawn centres lie around a single one.
    """

    def kept(centres) -> list[bytes]:
        c = _matrix(centres)
        few = spread(c)
        if len(few) <= copies or level and (c @ few.T >= 0.9).mean(axis=0).max() > 0.5:
            return []
        return [v.tobytes() for v in few]

    @F.pandas_udf("array<binary>")
    def run(centres: pd.Series) -> pd.Series:
        return centres.map(kept)

    return run


def _assign(copies: int):
    def run(members: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if members.empty or centres.empty:
            return pd.DataFrame({"shard": [], "rep": [], "vec": [], "n": []})
        c = _matrix(centres["centres"].iloc[0])
        top = np.argsort(-(_matrix(members["vec"]) @ c.T), axis=1, kind="stable")[:, : max(1, min(copies, len(c) - 1))]
        out = members[["shard", "rep", "vec", "n"]].loc[members.index.repeat(top.shape[1])]
        return out.assign(shard=[f"{s}.{k:03d}" for s, k in zip(out["shard"], top.ravel().tolist(), strict=True)])

    return run


def _shards(groups: DataFrame, size: int, copies: int) -> DataFrame:
    """shard, rep, vec, n: groups of over ``size`` members are split, then shards of over four times ``size``.

    Centres are thinned at every level, so a dense group stays together. Shards that are
    still over the limit at the end get a name that begins with ``EXACT``.
    """
    members = groups.select(F.concat_ws("/", F.hex("label"), F.col("dim").cast("string")).alias("shard"), "rep", "vec", "n")
    whole = None
    for level in range(8):
        sizes = members.groupBy("shard").agg(F.count("*").alias("size"))
        large, _ = materialize(sizes.where(F.col("size") > (size if level == 0 else 4 * size)), "shard-sizes")
        if large.isEmpty():
            break
        # Centres are drawn by a hash, so many that a shard has about `size` members; their number is bounded, the next level goes on.
        drawn = members.join(large, "shard").where(F.pmod(F.xxhash64(F.lit(level), "rep"), F.col("size")) < F.least(F.lit(CENTRES), F.ceil(F.col("size") * copies / size) + 1))
        centres = drawn.groupBy("shard").agg(F.transform(F.array_sort(F.collect_list(F.struct("rep", "vec"))), lambda s: s["vec"]).alias("centres"), F.ceil(F.first("size") / BLOCK).alias("salts"))
        centres, path = materialize(centres.withColumn("centres", _thin(copies, level)("centres")).where(F.size("centres") > copies), "shard-centres")
        salted = members.join(centres.select("shard", "salts"), "shard").withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("salts")))
        # Read anew: both sides of the cogroup come from this table.
        dealt = centres.sparkSession.read.schema(centres.schema).parquet(path).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)))
        split = salted.groupBy("shard", "salt").cogroup(dealt.groupBy("shard", "salt")).applyInPandas(_assign(copies), "shard string, rep bigint, vec binary, n bigint")
        # What can't be split stays as it is and is not tried again.
        rest = members.join(centres.select("shard"), "shard", "left_anti")
        if level:
            done = rest if whole is None else whole.unionByName(rest)
            whole, _ = materialize(done, "shard-members")
            members, _ = materialize(split, "shard-members")
        else:
            members, _ = materialize(rest.unionByName(split), "shard-members")
    members = members if whole is None else whole.unionByName(members)
    over = members.groupBy("shard").agg(F.count("*").alias("size")).where(F.col("size") > 4 * size).select("shard", F.lit(True).alias("over"))
    named = members.join(over, "shard", "left").withColumn("shard", F.when(F.col("over"), F.concat(F.lit(EXACT), "shard")).otherwise(F.col("shard")))
    return materialize(named.select("shard", "rep", "vec", "n"), "shard-members")[0]


def _forest(found: np.ndarray) -> np.ndarray:
    """For rows and columns of a matrix of links, numbered on: the first of those that links join."""
    n, m = found.shape
    turned = np.ascontiguousarray(found.T)
    root = np.full(n + m, -1)
    for i in range(n):
        if root[i] >= 0:
            continue
        root[i], front = i, np.array([i])
        while len(front):
            columns = np.flatnonzero(found[front].any(axis=0) & (root[n:] < 0))
            root[n + columns] = i
            front = np.flatnonzero(turned[columns].any(axis=0) & (root[:n] < 0))
            root[front] = i
    return np.where(root < 0, np.arange(n + m), root)


def _compare_blocks(threshold: float):
    """All pairs of two blocks of one shard (or of one block): each member's links, and one link to the first of its group."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        me, low, high = pdf["shard"].iloc[0], pdf["low"].iloc[0], pdf["high"].iloc[0]
        # A pair counts in the first of the shards that both are in: members with a common earlier shard are no pair here.
        earlier = [tuple(sorted(s for s in a if s < me)) for a in pdf["shards"]]
        kinds = sorted(set(earlier))
        names = {s: i for i, s in enumerate(sorted({s for k in kinds for s in k}))}
        holds = np.zeros((len(kinds), len(names)), np.float32)
        for i, k in enumerate(kinds):
            holds[i, [names[s] for s in k]] = 1
        number = {k: i for i, k in enumerate(kinds)}
        pdf = pdf.assign(kind=[number[e] for e in earlier]).sort_values(["kind", "rep"], ignore_index=True)
        left, right = (pdf[pdf["block"] == b] for b in (low, high))
        if left.empty or right.empty:
            return pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
        x, y, kx, ky = _matrix(left["vec"]), _matrix(right["vec"]), left["kind"].to_numpy(), right["kind"].to_numpy()
        found = np.zeros((len(x), len(y)), bool)
        for i in range(0, len(x), TILE):
            for j in range(0, len(y), TILE):
                (p, a), (q, b) = (np.unique(k, return_inverse=True) for k in (kx[i : i + TILE], ky[j : j + TILE]))
                owned = holds[p] @ holds[q].T == 0
                if owned.any():
                    hit = x[i : i + TILE] @ y[j : j + TILE].T >= threshold
                    found[i : i + TILE, j : j + TILE] = hit if owned.all() else hit & owned[a[:, None], b[None, :]]
        if low == high:
            np.fill_diagonal(found, False)
        count = lambda f, w: np.concatenate([f[i : i + TILE].astype(np.float64) @ w for i in range(0, len(f), TILE)])
        links, ids = count(found, right["n"].to_numpy(np.float64)), left["rep"].to_numpy()
        if low == high:
            # Rows and columns are the same members.
            found |= np.eye(len(x), dtype=bool)
            root = _forest(found)[: len(x)]
        else:
            root = _forest(found)
            links = np.concatenate([links, count(found.T, left["n"].to_numpy(np.float64))])
            ids = np.concatenate([ids, right["rep"].to_numpy()])
        return pd.DataFrame({"rep": ids, "links": links.astype(np.int64), "root": ids[root]}).query("links > 0 or rep != root")

    return run


def _exact(members: DataFrame, where: DataFrame, threshold: float) -> DataFrame:
    """rep, links, root of oversized shards: blocks of about ``BLOCK`` members, by a hash, each against each."""
    blocks = members.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = members.join(blocks, "shard").join(where, "rep").withColumn("block", F.pmod(F.xxhash64(F.lit(-1), "rep"), F.col("blocks")))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    pairs = pairs.select("shard", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep", "vec", "n", "shards")
    return pairs.groupBy("shard", "low", "high").applyInPandas(_compare_blocks(threshold), "rep bigint, links bigint, root bigint")


def embedding_dedup(embeddings: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", shard_size: int = SHARD, copies: int = COPIES) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept (vec_id = component_id).

    Two vectors link when their labels are equal and not null, their dimensions agree and
    their cosine is at least ``threshold``. A vector that is null, empty, zero or holds null
    or non-finite components links with nothing, as does one whose id is null (its component
    is null). Rows that repeat an id are vectors of their own and count as links of each
    other if they are alike. An empty table gives an empty result; other columns are ignored.
    """
    wanted = embeddings.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    units, _ = materialize(wanted.mapInArrow(_units, "vec_id bigint, label string, dim int, vec binary"), "units")
    valid = units.where("vec is not null and label is not null and vec_id is not null")
    groups, _ = materialize(valid.groupBy("label", "dim", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vectors")
    # One id may stand for several vectors: nodes have numbers of their own.
    groups, _ = materialize(groups.withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = _shards(groups.select("label", "dim", "vec", F.col("node").alias("rep"), "n"), shard_size, copies)
    small, over = members.where(~F.col("shard").startswith(EXACT)), members.where(F.col("shard").startswith(EXACT))
    near = small.groupBy("shard").applyInPandas(_build_shard, "rep bigint, near array<bigint>")
    united = near.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    where = members.groupBy("rep").agg(F.collect_set("shard").alias("shards"))
    searched = small.join(united.join(where, "rep"), "rep").groupBy("shard").applyInPandas(_search_shard(threshold), "rep bigint, links bigint, root bigint")
    if not over.isEmpty():
        searched = searched.unionByName(_exact(over, where, threshold))
    searched, _ = materialize(searched, "links")
    ids = groups.select(F.col("node"), F.col("rep").alias("low"))
    roots = searched.where("rep <> root").join(ids, searched.rep == ids.node).select(F.col("low").alias("u"), "root").join(ids, F.col("root") == ids.node).select("u", F.col("low").alias("v"))
    component = connected_components(roots)
    links = searched.groupBy(F.col("rep").alias("node")).agg(F.sum("links").alias("links"))
    known = groups.join(links, "node", "left").join(component.withColumnRenamed("node", "c"), F.col("rep") == F.col("c"), "left")
    known = known.select("label", "dim", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    linked = units.where("vec is not null and label is not null and vec_id is not null").join(known, ["label", "dim", "vec"]).select("vec_id", "n_links", "component")
    alone = units.where("vec is null or label is null or vec_id is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component"))
    return linked.unionByName(alone).select("vec_id", "n_links", F.col("component").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"))


def audit_recall(embeddings: DataFrame, result: DataFrame, threshold: float = 0.93, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row: links of the vectors whose id is divisible by ``every`` by brute force against all, links counted, recall.

    The queries are a stated share of the rows. Queries and rows of a label meet in blocks of bounded size, each block of
    queries with each of rows, so no task holds a label. Rows that repeat an id count together. Without queries the recall is 1.
    """
    wanted = embeddings.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    units, _ = materialize(wanted.mapInArrow(_units, "vec_id bigint, label string, dim int, vec binary").where("vec is not null and label is not null and vec_id is not null"), "audit-units")
    asked = F.col("vec_id") % every == 0
    blocks = units.groupBy("label", "dim").agg(F.ceil(F.count("*") / BLOCK).alias("rows"), F.greatest(F.lit(1).cast("bigint"), F.ceil(F.count(F.when(asked, 1)) / BLOCK)).alias("queries"))
    # Which rows are dealt to a block is a matter of size alone.
    dealt, _ = materialize(units.withColumn("h", F.xxhash64("vec_id", "vec")).join(blocks, ["label", "dim"]), "audit-blocks")
    one, all_ = lambda n: F.pmod("h", F.col(n)), lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = dealt.where(asked).withColumn("q", one("queries")).withColumn("r", all_("rows")).select("label", "dim", "q", "r", "vec_id", "vec")
    right = dealt.withColumn("r", one("rows")).withColumn("q", all_("queries")).select(F.col("label").alias("l"), F.col("dim").alias("d"), F.col("q").alias("q2"), F.col("r").alias("r2"), F.col("vec").alias("vec"))

    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"vec_id": [], "true": []}).astype("int64")
        s = _matrix(left["vec"]) @ _matrix(right["vec"]).T >= threshold
        return pd.DataFrame({"vec_id": left["vec_id"], "true": s.sum(axis=1)})

    true = left.groupBy("label", "dim", "q", "r").cogroup(right.groupBy("l", "d", "q2", "r2")).applyInPandas(count, "vec_id bigint, true bigint").groupBy("vec_id").agg(F.sum("true").alias("true"))
    # Each row finds itself once.
    true = true.join(units.where(asked).groupBy("vec_id").agg(F.count("*").alias("own")), "vec_id").withColumn("true", F.col("true") - F.col("own"))
    both = true.join(result.groupBy("vec_id").agg(F.sum("n_links").alias("n_links")), "vec_id")
    return both.agg(F.sum("true").alias("true_links"), F.sum("n_links").alias("found_links")).withColumn("recall", F.when(F.col("true_links") > 0, F.col("found_links") / F.col("true_links")).otherwise(F.lit(1.0)))

"""Operator 10, SimHash near-dedup: BK-trees over shards of equal fingerprint blocks.

Fingerprints of 64 bits that differ in at most ``radius`` bits agree in whole on at least
``blocks - radius`` of ``blocks`` bit blocks. So each distinct fingerprint goes to one
shard for every choice of that many blocks, keyed by their bits, and every pair within
the radius meets in a shard. A shard that is too large is split again by blocks of the bits
that it doesn't share, which keeps all its pairs. A shard is a BK-tree: a child hangs at its
integer Hamming distance to its parent, and a search follows only edges whose distance can
hold a match, and leaves out subtrees that are in the searched value's group already, so a
dense group isn't compared in all pairs. Only links that join two groups leave a shard.

A tree for the whole corpus can't be broadcast, since it grows with the corpus: shards
reach their tree by a shuffle, and a task holds one shard's tree at a time.

``near_copies`` is the form for a Jaccard similarity of five-word shingles. Copies at 0.8
differ in some 15 % of the bits of a fingerprint, a radius for which blocks of bits hold no
choice that parts a corpus. So fingerprints are wider (256 bits), shards are keyed by minima of
the shingles' hashes, and a pair that a tree finds is compared on its shingles' hashes, within the shard
and before it joins two groups: what only looks near never hides a link.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import batch, forget, id_text, materialize, rows, shared_runs
from vellum.llm.components import connected_components

#: Fingerprints that chance puts into a shard at most, and those above which a shard is split again.
SHARD_SIZE, LARGE_SHARD = 512, 4096
_FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64())])
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash: bit = 1 if set in over half the shingles' XXH64."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < words else map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False))
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), dtype=np.uint64)
    places = h.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).astype(np.int64) + 256 * np.arange(8)
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits((2 * counts > len(h)).ravel(), bitorder="little").tobytes(), "little")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(words: int, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows(batches, ["doc_id", "text"]):
            yield batch(_FP, [ids, [_signed(fingerprint(t, words, seed)) for t in texts]])

    return run


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed 64-bit). Null text counts as empty; a text without words has fingerprint zero."""
    return id_text(docs, id_col, text_col).mapInArrow(_fingerprints(words, seed), "doc_id bigint, fp bigint")


class BKTree:
    """Children are keyed by their Hamming distance to the parent. Values that links join are one group."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.group: list[int] = []
        #: Whether all values below a node are surely in the node's group.
        self.uniform: list[bool] = []

    def root(self, i: int) -> int:
        group = self.group
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    def add(self, value: int, radius: int, sure: int | None = None) -> list[tuple[int, int]]:
        """Add a value; (number, distance) of one link to each group within the radius, which are then one group.

        To a group that holds a value within ``sure`` (by default all of the radius) the link
        is the first such one found, and what is known to be of that group isn't searched on.
        To any other group it is the nearest.
        """
        values, children, group, uniform = self.values, self.children, self.group, self.uniform
        sure = radius if sure is None else sure
        me, mine, links, nearest = len(values), -1, [], {}
        todo = [0] if me else []
        while todo:
            i = todo.pop()
            if mine >= 0 and uniform[i] and self.root(i) == mine:
                continue
            d = (values[i] ^ value).bit_count()
            if d <= radius:
                r = self.root(i)
                if d > sure:
                    if r != mine and (r not in nearest or d < nearest[r][1]):
                        nearest[r] = (i, d)
                elif r != mine:
                    links.append((i, d))
                    if mine >= 0:
                        group[r] = mine
                    else:
                        mine = r
            below = children[i]
            if len(below) <= 2 * radius:
                todo.extend([c for k, c in below.items() if d - radius <= k <= d + radius])
            else:
                todo.extend([below[k] for k in range(d - radius, d + radius + 1) if k in below])
        for i, d in sorted(nearest.values(), key=lambda x: x[1]):
            r = self.root(i)
            if r != mine:
                links.append((i, d))
                if mine >= 0:
                    group[r] = mine
                else:
                    mine = r
        values.append(value)
        children.append({})
        group.append(me if mine < 0 else mine)
        uniform.append(True)
        if me:
            mine, i = self.root(me), 0
            while True:
                if uniform[i] and self.root(i) != mine:
                    uniform[i] = False
                d = (values[i] ^ value).bit_count()
                if d not in children[i]:
                    break
                i = children[i][d]
            children[i][d] = me
        return links


def shard_links(fps: list[int], reps: list[int], radius: int) -> list[tuple[int, int]]:
    """(rep, smallest rep of its group) for the fingerprints of one shard that have a partner."""
    tree, low = BKTree(), {}
    for fp in fps:
        tree.add(fp & 0xFFFFFFFFFFFFFFFF, radius)
    roots = [tree.root(i) for i in range(len(fps))]
    for r, rep in zip(roots, reps, strict=True):
        low[r] = min(rep, low.get(r, rep))
    return [(rep, low[r]) for r, rep in zip(roots, reps, strict=True) if rep != low[r]]


def _search(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []
        for shard in shared_runs(batches, ["choice", "key", "part", "rest"]):
            held += shard_links(shard.column("fp").to_pylist(), shard.column("rep").to_pylist(), radius)
            if len(held) >= 10_000:
                yield batch(_EDGE, list(map(list, zip(*held, strict=True))))
                held = []
        if held:
            yield batch(_EDGE, list(map(list, zip(*held, strict=True))))

    return run


def block_masks(blocks: int, radius: int) -> list[int]:
    """A mask of bits for each choice of blocks - radius of the blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(masks, blocks - radius)]


def blocks_for(distinct: int, radius: int) -> int:
    """Fewest blocks at which chance puts about SHARD_SIZE fingerprints into a shard; any number finds all links."""
    blocks = radius + 1
    while blocks < 2 * radius and distinct > SHARD_SIZE << (64 * (blocks - radius) // blocks):
        blocks += 1
    return blocks


def _split_again(choices: list[int], radius: int) -> Column:
    """array<struct<part, rest>> of a row of a large shard: the bits that its choice leaves free, in radius + 1 blocks.

    Two values of the shard differ in these bits alone, at most ``radius`` of them, so they agree on a whole block.
    """
    by_choice = []
    for chosen in choices:
        free = [b for b in range(64) if not chosen >> b & 1]
        masks = [sum(1 << b for b in free[len(free) * i // (radius + 1) : len(free) * (i + 1) // (radius + 1)]) for i in range(radius + 1)]
        by_choice.append(F.array(*[F.struct(F.lit(1 + i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("bigint")).alias("rest")) for i, m in enumerate(masks)]))
    return F.get(F.array(*by_choice), F.col("choice"))


def near_groups(fp: DataFrame, radius: int = 4, blocks: int | None = None, large: int = LARGE_SHARD) -> DataFrame:
    """fp, component_id for each distinct fingerprint of (doc_id, fp): the smallest id reachable by links."""
    groups, _ = materialize(fp.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-groups")
    choices = block_masks(blocks or blocks_for(groups.count(), radius), radius)
    keyed = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("bigint")).alias("key")) for i, m in enumerate(choices)])
    shards = groups.select("fp", "rep", F.explode(keyed).alias("s")).select("s.choice", "s.key", "fp", "rep")
    # At most one row for every `large` rows.
    over, _ = materialize(shards.groupBy("choice", "key").agg(F.count("*").alias("size")).where(F.col("size") > large).select("choice", "key"), "simhash-large")
    whole = shards.withColumn("part", F.lit(0)).withColumn("rest", F.lit(0).cast("bigint"))
    if not over.isEmpty():
        again = shards.join(over, ["choice", "key"]).withColumn("s", F.explode(_split_again(choices, radius))).select("choice", "key", "fp", "rep", "s.part", "s.rest")
        whole = whole.join(over, ["choice", "key"], "left_anti").unionByName(again)
    dealt = whole.repartition("choice", "key", "part", "rest").sortWithinPartitions("choice", "key", "part", "rest", "rep")
    links = connected_components(dealt.mapInArrow(_search(radius), "u bigint, v bigint"))
    return groups.join(links, groups.rep == links.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))


def simhash_dedup(docs: DataFrame, radius: int = 4, words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, kept.

    Documents link when their fingerprints differ in at most ``radius`` bits; component_id
    is the smallest id reachable, kept is doc_id = component_id. Null text counts as empty;
    texts without words have fingerprint zero and link like any other. Rows with a null id
    get a fingerprint and the component of their fingerprint, if another row has it (else
    null), link nothing and are kept only if that is null. Rows that repeat an id are all
    kept or all dropped. ``blocks`` sets the number of bit blocks (by default as few as the
    number of fingerprints allows); the result is the same. An empty table gives an empty
    result; other columns are ignored.
    """
    fp, _ = materialize(fingerprints(docs, words, seed, id_col, text_col), "simhash")
    return fp.join(near_groups(fp, radius, blocks), "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: Of ``near_copies``: 64-bit words of a fingerprint, bits in which candidates differ at most (a pair at 0.8 differs in
#: 39 +- 6), shards of a document, minima of a shard's key, members of a shard that one task compares.
WIDE, WIDE_RADIUS, BANDS, ROWS, SHARD_ROWS = 4, 58, 12, 4, 4096
#: Members of a shard up to which all their fingerprints are compared before their sets of hashes are fetched.
FEW = 64
#: Largest filter of the ids whose texts are asked for: 2**29 bits are 64 MB.
MOST_BITS = 29
_SEEDS = np.array([xxhash.xxh64_intdigest(f"minimum {i}") for i in range(BANDS * ROWS)], dtype=np.uint64)
_ODD = np.array([xxhash.xxh64_intdigest(f"factor {i}") | 1 for i in range(BANDS * ROWS)], dtype=np.uint64)
_WORD_SEEDS = [np.uint64(xxhash.xxh64_intdigest(f"word {i}")) for i in range(WIDE)]
_SKETCH = pa.schema([("doc_id", pa.int64()), ("content", pa.binary()), ("fp", pa.binary()), ("keys", pa.list_(pa.int64()))])
_SET = pa.schema([("doc_id", pa.int64()), ("content", pa.binary()), ("hashes", pa.binary())])


def shingle_hashes(text: str, words: int = 5, seed: int = 42) -> np.ndarray:
    """Distinct hashes of a text's shingles, sorted; a text of fewer words is one shingle, one without words has none."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    shingles = [b" ".join(w)] if len(w) < words else map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), dtype=np.uint64))


def sketch(h: np.ndarray) -> tuple[bytes, list[int]]:
    """The wide fingerprint of a set of hashes, and the keys of its shards."""
    counts, low = np.zeros((WIDE, 64), np.int64), np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for i in range(0, len(h), 2048):
        part = h[i : i + 2048]
        low = np.minimum(low, ((part[None, :] ^ _SEEDS[:, None]) * _ODD[:, None]).min(axis=1))
        for k, s in enumerate(_WORD_SEEDS):
            v = (part ^ s) * np.uint64(0xFF51AFD7ED558CCD)
            v ^= v >> np.uint64(33)
            v *= np.uint64(0xC4CEB9FE1A85EC53)
            v ^= v >> np.uint64(33)
            counts[k] += np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    keys = [_signed(xxhash.xxh64_intdigest(low[k * ROWS : (k + 1) * ROWS].tobytes(), k)) for k in range(BANDS)]
    return np.packbits((2 * counts > len(h)).ravel()).tobytes(), keys


def _sketches(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows(batches, ["doc_id", "text"]):
            found = [shingle_hashes(t, words) for t in texts]
            drawn = [sketch(h) for h in found]
            yield batch(_SKETCH, [ids, [xxhash.xxh3_128_digest(h.tobytes()) for h in found], [f for f, _ in drawn], [k for _, k in drawn]])

    return run


class VerifiedTree(BKTree):
    """A BK-tree of wide fingerprints whose groups are joined by verified links alone.

    ``same`` compares two members, given by their numbers; it is asked only for members of different groups.
    """

    def insert(self, value: int, group: int | None = None) -> int:
        """Add a value, to the group of an earlier number if one is given; its number."""
        me = len(self.values)
        self.values.append(value)
        self.children.append({})
        self.group.append(me if group is None else self.root(group))
        self.uniform.append(True)
        if me:
            mine, i = self.root(me), 0
            while True:
                if self.uniform[i] and self.root(i) != mine:
                    self.uniform[i] = False
                d = (self.values[i] ^ value).bit_count()
                if d not in self.children[i]:
                    break
                i = self.children[i][d]
            self.children[i][d] = me
        return me

    def link(self, value: int, mine: int | None, radius: int, same) -> list[int]:
        """Numbers of one member of each group that the value is linked to, apart from ``mine``; those groups and ``mine`` are one from then on."""
        links, todo = [], [0] if self.values else []
        mine = None if mine is None else self.root(mine)
        while todo:
            i = todo.pop()
            r = self.root(i)
            if r == mine and self.uniform[i]:
                continue
            d = (self.values[i] ^ value).bit_count()
            if d <= radius and r != mine and same(i):
                links.append(i)
                if mine is None:
                    mine = r
                else:
                    self.group[r] = mine
            todo.extend([c for k, c in self.children[i].items() if d - radius <= k <= d + radius])
        return links


class ShardSets:
    """Sets of 32-bit hashes, compared by their Jaccard similarity.

    In a shard of many, the hashes that most members share are bits of one integer a member: that gives a bound of what two
    have in common, and mostly the number itself. Hashes of one member alone count for nothing but its size.
    """

    MANY, FREQUENT = 32, 4096

    def __init__(self, hashes: list[bytes], similarity: float):
        self.arrays = [np.frombuffer(h, np.uint32) for h in hashes]
        self.sizes = list(map(len, self.arrays))
        self.similarity = similarity
        self.own = lru_cache(2048)(lambda i: frozenset(self.arrays[i].tolist()))
        self.masks: list[int] = []
        if len(hashes) >= self.MANY:
            found, place, count = np.unique(np.concatenate(self.arrays), return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")[: self.FREQUENT]
            bit = np.full(len(found), -1, np.int64)
            bit[order] = np.arange(len(order))
            bit[count < 2] = -2
            of, ends = bit[place], np.cumsum(self.sizes)
            for n, e in zip(self.sizes, ends.tolist(), strict=True):
                mine = of[e - n : e]
                flags = np.zeros(self.FREQUENT, np.uint8)
                flags[mine[mine >= 0]] = 1
                self.masks.append(int.from_bytes(np.packbits(flags).tobytes(), "big"))
            #: Hashes of each member that another has too, but that are no bits.
            self.rest = np.add.reduceat(np.r_[of == -1, False], np.r_[0, ends[:-1]]).tolist() if len(found) else [0] * len(hashes)
            self.rest = [r if n else 0 for r, n in zip(self.rest, self.sizes, strict=True)]

    def alike(self, i: int, j: int) -> bool:
        a, b, s = self.sizes[i], self.sizes[j], self.similarity
        most = min(a, b)
        if most < s * max(a, b):
            return False
        if self.masks:
            rest = min(self.rest[i], self.rest[j])
            bits = (self.masks[i] & self.masks[j]).bit_count()
            most = bits + rest
            if most < s * (a + b - most):
                return False
            if not rest or bits >= s * (a + b - bits):
                return True
        both = len(self.own(i).intersection(self.own(j)))
        return both >= s * (a + b - both)


def shard_pairs(fps: list[bytes], keys: list[list[int]], hashes: list[bytes], key: int, comps: list[int], probes: list[bool], similarity: float, radius: int = WIDE_RADIUS) -> Iterator[tuple[int, int]]:
    """Pairs of places whose sets of hashes are ``similarity`` alike, enough of them to join all that are.

    Members that share a component in ``comps`` are joined already. Where there are ``probes``, the other members have been
    compared with each other, and probes with each other: only probes are looked up. A pair that shares an earlier key than this shard's meets there.
    """
    sets = ShardSets(hashes, similarity)

    def alike(i: int, j: int) -> bool:
        # The shard's own key is one that they share: an earlier one is where they meet.
        return sets.alike(i, j) and next(x for x, y in zip(keys[i], keys[j], strict=True) if x == y) == key

    tree, first, at = VerifiedTree(), {}, []
    order = [i for i, p in enumerate(probes) if not p] + [i for i, p in enumerate(probes) if p]
    searched = any(probes)
    for i in order:
        value = int.from_bytes(fps[i], "big")
        known = first.get(comps[i])
        if probes[i] or not searched:
            for j in tree.link(value, known, radius, lambda n, i=i: alike(i, at[n])):
                yield i, at[j]
                known = j if known is None else known
        if not probes[i]:
            n = tree.insert(value, known)
            at.append(i)
            first.setdefault(comps[i], n)


def _near_search(similarity: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []
        for shard in shared_runs(batches, ["key", "chunk", "block"]):
            reps, fps, keys, hashes, comps, probes = (shard.column(c).to_pylist() for c in ("rep", "fp", "keys", "hashes", "comp", "probe"))
            for i, j in shard_pairs(fps, keys, hashes, shard.column("key")[0].as_py(), comps, probes, similarity):
                held.append((max(reps[i], reps[j]), min(reps[i], reps[j])))
            if len(held) >= 10_000:
                yield batch(_EDGE, list(map(list, zip(*held, strict=True))))
                held = []
        if held:
            yield batch(_EDGE, list(map(list, zip(*held, strict=True))))

    return run


def _within_radius(radius: int):
    """Of shards of few members (key, rep, n, fp): those rows that have another within the radius."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shared_runs(batches, ["key"]):
            fp = np.frombuffer(b"".join(shard.column("fp").to_pylist()), np.uint64).reshape(-1, WIDE)
            near = np.bitwise_count(fp[:, None] ^ fp[None]).sum(axis=2, dtype=np.int64) <= radius
            at = np.flatnonzero(near.sum(axis=1) > 1)
            if len(at):
                yield from shard.select(["key", "rep", "n"]).take(pa.array(at)).combine_chunks().to_batches()

    return run


def _id_filter(ids: DataFrame, bits: int) -> np.ndarray:
    """A set of 2**bits bits, as 64-bit integers, with those of the ids' hashes set: what the driver gathers is bounded by its size."""
    h = F.shiftrightunsigned(F.xxhash64("rep"), 64 - bits)
    found = ids.select(F.shiftrightunsigned(h, 6).alias("place"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(rep), {64 - bits}) & 63 as int))").alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found.column("place").to_numpy()] = found.column("bits").to_numpy()
    return out


def _sets(words: int, shared, bits: int):
    """Sets of the documents (doc_id, h, text) whose h, the first ``bits`` bits of their id's hash, is in the filter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(b.schema.get_field_index("h")).to_numpy()
            wanted = b.filter(pa.array((shared.value[h >> 6] >> (h & 63) & 1).astype(bool)))
            for ids, texts in rows([wanted] if wanted.num_rows else [], ["doc_id", "text"]):
                found = [shingle_hashes(t, words) for t in texts]
                yield batch(_SET, [ids, [xxhash.xxh3_128_digest(h.tobytes()) for h in found], [np.unique((h >> np.uint64(32)).astype(np.uint32)).tobytes() for h in found]])

    return run


def _links(members: DataFrame, similarity: float, name: str) -> DataFrame:
    """The written links of members (key, chunk, block, probe, comp, rep, fp, keys, hashes), shard by shard."""
    dealt = members.repartition("key", "chunk", "block").sortWithinPartitions("key", "chunk", "block", "probe", F.xxhash64("key", "rep"), "rep")
    return materialize(dealt.mapInArrow(_near_search(similarity), "u bigint, v bigint"), name)[0]


def _across_chunks(placed: DataFrame, links: DataFrame, similarity: float, size: int) -> DataFrame:
    """Links between the chunks of large shards. ``placed``: key, chunks, chunk and a member's own columns.

    A chunk's groups have joined most of a dense shard's members; one member of each is compared first, which joins the
    groups of the chunks. Then the members outside a shard's largest group are looked up in its other chunks: few in a
    dense shard. Where they are many, they are dealt to blocks, and the work grows with their number times the shard's.
    """
    component = connected_components(links)
    known = lambda edges: placed.join(edges.withColumnRenamed("component", "__comp"), F.col("rep") == F.col("node"), "left").select(*placed.columns, F.coalesce("__comp", "rep").alias("comp"))
    first = known(component).select("key", "chunk", "comp", "rep").groupBy("key", "chunk", "comp").agg(F.min("rep").alias("rep"), F.count("*").alias("n")).where("n > 1")
    leaders = placed.join(first.select("key", "rep"), ["key", "rep"]).select("key", F.pmod(F.xxhash64("rep"), F.greatest(F.lit(1), F.expr(f"chunks div {size}"))).cast("int").alias("chunk"), F.lit(0).alias("block"), F.lit(False).alias("probe"), F.col("rep").alias("comp"), "rep", "fp", "keys", "hashes")
    joined = _links(leaders, similarity, "near-leaders")
    component = connected_components(links.unionByName(joined))
    members, _ = materialize(known(component), "near-members")
    largest = members.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("largest"))
    outside = members.join(largest, "key").where("comp <> largest")
    counts = outside.groupBy("key").agg(F.count("*").alias("probes"))
    columns = ["key", "chunk", "block", "probe", "comp", "rep", "fp", "keys", "hashes"]
    blocks = F.expr(f"cast((probes + {size - 1}) div {size} as int)")
    own = members.join(counts, "key").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("probe", F.lit(False))
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: c != F.col("__own"))
    probes = outside.join(counts, "key").withColumn("block", F.pmod(F.xxhash64("rep", "key"), blocks).cast("int")).withColumnRenamed("chunk", "__own").withColumn("chunk", F.explode(others)).withColumn("probe", F.lit(True))
    return joined.unionByName(_links(own.select(columns).unionByName(probes.select(columns)), similarity, "near-probes"))


def near_copies(docs: DataFrame, similarity: float = 0.8, words: int = 5, id_col: str = "doc_id", text_col: str = "text", size: int = SHARD_ROWS) -> DataFrame:
    """One row per input row: doc_id, component_id (smallest id reachable), kept (doc_id = component_id).

    Documents link when the sets of their ``words``-word shingles (lower-cased A-Z, words
    between white space) have a Jaccard similarity of ``similarity`` or more. Equal sets always
    meet; a pair at 0.8 shares a shard with a probability of 0.998, and its fingerprints are within the trees' radius
    with one of 0.999. Every pair that meets is compared on 32-bit hashes of its shingles, unless it is joined already; none below the
    similarity is linked. A shard of over ``size`` documents is dealt to several tasks (``_across_chunks``).

    Null text counts as empty; texts without words are equal to each other. Rows with a null
    id are their own and kept. Rows that repeat an id are all kept or all dropped. An empty
    table gives an empty result; other columns are ignored.
    """
    wanted = id_text(docs, id_col, text_col)
    drawn, _ = materialize(wanted.mapInArrow(_sketches(words), "doc_id bigint, content binary, fp binary, keys array<bigint>"), "sketches")
    groups, _ = materialize(drawn.where("doc_id is not null").groupBy("content").agg(F.min("doc_id").alias("rep"), F.first("fp").alias("fp"), F.first("keys").alias("keys")), "sketch-groups")
    # A document without a shard in common with another stays out of all that follows.
    keyed = groups.select(F.explode("keys").alias("key"), "rep")
    counts, counts_path = materialize(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "near-keys")
    shared = keyed.join(counts, "key").groupBy("rep").agg(F.collect_list(F.struct("key", "n")).alias("at"))
    found, found_path = materialize(groups.join(shared, "rep").select("rep", "content", "fp", "keys", "at"), "near-found")
    # Most shards hold a few documents that share a passage: their fingerprints tell them apart, and their sets stay where they are.
    opened = found.select("rep", "fp", F.explode("at").alias("x")).select("x.key", "rep", "x.n", "fp")
    few = opened.where(F.col("n") <= FEW).repartition("key").sortWithinPartitions("key").mapInArrow(_within_radius(WIDE_RADIUS), "key bigint, rep bigint, n bigint")
    left = few.unionByName(opened.where(F.col("n") > FEW).drop("fp")).groupBy("rep").agg(F.collect_list(F.struct("key", "n")).alias("at"))
    found, near_path = materialize(found.drop("at").join(left, "rep"), "near-candidates")
    # Rows that share an id may have other texts; the one that the group stands for is told by its content.
    # Texts aren't shuffled: a filter of bounded size tells most of those that aren't asked for, the join the rest.
    bits = min(MOST_BITS, max(16, (32 * found.count()).bit_length()))
    asked = docs.sparkSession.sparkContext.broadcast(_id_filter(found.select("rep"), bits))
    hashed = wanted.where("doc_id is not null").select("doc_id", F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - bits).alias("h"), "text")
    sets = hashed.mapInArrow(_sets(words, asked, bits), "doc_id bigint, content binary, hashes binary")
    sets = sets.groupBy(F.col("doc_id").alias("rep"), "content").agg(F.first("hashes").alias("hashes"))
    members, members_path = materialize(found.join(sets, ["rep", "content"]).select("rep", "fp", "keys", "hashes", "at"), "near-sets")
    placed = members.select("rep", "fp", "keys", "hashes", F.explode("at").alias("x")).select("x.key", F.expr(f"cast((x.n + {size - 1}) div {size} as int)").alias("chunks"), "rep", "fp", "keys", "hashes")
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("rep", "key"), F.col("chunks")).cast("int"))
    columns = ["key", "chunk", F.lit(0).alias("block"), F.lit(False).alias("probe"), F.col("rep").alias("comp"), "rep", "fp", "keys", "hashes"]
    edges = _links(placed.select(columns), similarity, "near-links")
    if not counts.where(F.col("n") > size).isEmpty():
        edges = edges.unionByName(_across_chunks(placed.where("chunks > 1"), edges, similarity, size))
    forget(docs.sparkSession, counts_path, found_path, near_path, members_path)
    # Rows that share an id but not their text link the groups of both.
    reps = drawn.where("doc_id is not null").join(groups.select("content", "rep"), "content").select("doc_id", "rep")
    twice = reps.where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    component = connected_components(edges.unionByName(twice))
    out = drawn.select("doc_id").join(component, F.col("doc_id") == F.col("node"), "left").select("doc_id", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

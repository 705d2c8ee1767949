"""Near-duplicate vectors by a robust-pruned flat graph over cluster shards.

1. Equal vectors become one node. Centroids come from a bounded sample.
2. Every node joins the shards of its two nearest centroids (the nearest one is
   its home). Each shard builds a graph: near and random members are pruned so
   that no kept neighbour is much closer to a nearer kept one.
3. The adjacency lists that a node has in several shards are united.
4. Every node is searched for in the shards of its nearest centroids: a greedy
   beam starts at the shard's medoid (and at the node itself where it is a
   member) and, once inside the range, expands every node in range.
5. Shards that a node was not searched for in are swept: blocks of shards meet in
   tasks that compare what neither a shard's radius nor the plane between two
   centroids rules out, so no shard that can hold a neighbour is left out.
6. Cosines are computed in double precision, so links are verified as they are
   found. A link counts in the neighbour's home shard alone, hence once.

Shards over a bound are dealt into parts by hash, and a shard's searches into
chunks; every search visits all parts. What tasks emit is a count for each node
and links that connect the same nodes as all links do, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import settle, ship_package
from .common import in_tasks
from .components import connected_components, local_stars

THRESHOLD = 0.9
#: Rows that fit the centroids, at most (about, drawn by a hash).
SAMPLE = 20_000
#: Nodes for each centroid, and centroids at most.
SHARD, MAX_CENTROIDS = 1_000, 4_096
MEMBER_SHARDS, SEARCH_SHARDS = 2, 4
#: Members of a part and searches of a chunk, at most.
PART, CHUNK = 4_096, 16_384
DEGREE, POOL, ALPHA = 24, 64, 1.2
BEAM, BATCH, WIDE = 24, 512, 8
ROUNDS = 8
#: Numbers in the vectors of a block of the sweep; rows of a packed slice.
BLOCK_NUMBERS, SLICE = 1 << 20, 2_048
#: Links that a task of the sweep holds before it contracts them.
HELD = 1 << 20
#: What the bounds of the sweep allow for rounding.
SLACK = 1e-6


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spherical_centroids(sample: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """k centroids of unit vectors; a centroid without members keeps its place."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.permutation(len(sample))[:k]].copy()
    for _ in range(ROUNDS):
        sums = np.zeros_like(centroids)
        for at in range(0, len(sample), 1024):
            some = sample[at : at + 1024]
            np.add.at(sums, (some @ centroids.T).argmax(axis=1), some)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centroids)
    return centroids


def build_graph(vectors: np.ndarray, seed: int = 3) -> np.ndarray:
    """Adjacency of one shard part: DEGREE pruned neighbours and up to as many
    nodes that chose this one, least chosen first; -1 fills up."""
    m = len(vectors)
    if m == 1:
        return np.full((1, 2 * DEGREE), -1)
    near = vectors.astype(np.float32) @ vectors.astype(np.float32).T
    np.fill_diagonal(near, -2)
    size = min(POOL, m - 1)
    pool = np.argpartition(-near, size - 1, axis=1)[:, :size]
    rng = np.random.default_rng(seed)
    pool = np.concatenate([pool, rng.integers(0, m, (m, size))], axis=1)
    rows = np.arange(m)
    sims = near[rows[:, None], pool]
    order = np.argsort(-sims, axis=1, kind="stable")
    pool, sims = np.take_along_axis(pool, order, 1), np.take_along_axis(sims, order, 1)
    apart = 2 - 2 * sims  # squared distances
    alive = pool != rows[:, None]
    chosen = np.full((m, DEGREE), -1)
    for i in range(DEGREE):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        picked = pool[rows, first]
        chosen[some, i] = picked[some]
        between = 2 - 2 * near[picked[:, None], pool]
        alive &= ~((ALPHA * ALPHA * between <= apart) | (pool == picked[:, None])) | ~some[:, None]
        alive[rows, first] = False
    source, column = np.nonzero(chosen >= 0)
    target = chosen[source, column]
    known = np.bincount(target, minlength=m)
    order = np.lexsort((known[source], target))
    source, target = source[order], target[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    back = np.full((m, DEGREE), -1)
    kept = place < DEGREE
    back[target[kept], place[kept]] = source[kept]
    return np.concatenate([chosen, back], axis=1)


def range_search(
    queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, graph: np.ndarray, threshold: float
) -> np.ndarray:
    """Which members each query finds at ``threshold`` or above (a Boolean matrix).

    ``own`` is the query's place among the members, or -1. Each step expands, for
    every query, up to WIDE unexpanded members in range, or else the best
    unexpanded one of the beam; a query ends when it has neither.
    """
    n, m = len(queries), len(vectors)
    mean = vectors.mean(axis=0)
    medoid = int((vectors @ mean).argmax())
    seen = np.zeros((n, m), dtype=bool)
    hits = np.zeros((n, m), dtype=bool)
    todo = np.zeros((n, m), dtype=bool)  # in range and not expanded
    beam = np.full((n, BEAM), -1)
    sims = np.full((n, BEAM), -3.0)
    open_ = np.zeros((n, BEAM), dtype=bool)

    def meet(rows, nodes):
        """Rows meet nodes (a matrix, -1 for none): verify, mark, merge into beams."""
        fresh = (nodes >= 0) & ~seen[rows[:, None], nodes]
        ordered = np.sort(np.where(fresh, nodes, m), axis=1)
        nodes = np.where(np.diff(ordered, axis=1, prepend=-1) > 0, ordered, m)
        fresh = nodes < m
        nodes = np.where(fresh, nodes, 0)
        r, c = np.nonzero(fresh)
        found = np.full(nodes.shape, -3.0)
        cosine = np.einsum("ij,ij->i", vectors[nodes[r, c]], queries[rows[r]])
        found[r, c] = cosine
        seen[rows[r], nodes[r, c]] = True
        inside = cosine >= threshold
        hits[rows[r[inside]], nodes[r[inside], c[inside]]] = True
        todo[rows[r[inside]], nodes[r[inside], c[inside]]] = True
        every = np.concatenate([sims[rows], found], axis=1)
        best = np.argpartition(-every, BEAM - 1, axis=1)[:, :BEAM]
        sims[rows] = np.take_along_axis(every, best, 1)
        beam[rows] = np.take_along_axis(np.concatenate([beam[rows], np.where(fresh, nodes, -1)], axis=1), best, 1)
        open_[rows] = np.take_along_axis(np.concatenate([open_[rows], fresh], axis=1), best, 1)

    rows = np.arange(n)
    meet(rows, np.stack([np.full(n, medoid), np.where(own == medoid, -1, own)], axis=1))
    while len(rows):
        ranged = todo[rows].any(axis=1)
        some = rows[ranged]
        if len(some):
            # the first WIDE in-range members of each row
            r, c = np.nonzero(todo[some])
            place = np.arange(len(r)) - np.searchsorted(r, r)
            r, c, place = r[place < WIDE], c[place < WIDE], place[place < WIDE]
            todo[some[r], c] = False
            next_ = np.full((len(some), WIDE), -1)
            next_[r, place] = c
            around = np.where(next_[:, :, None] >= 0, graph[next_], -1).reshape(len(some), -1)
            open_[some] &= sims[some] < threshold  # members in range are in todo
            meet(some, around)
        some = rows[~ranged]
        if len(some):
            best = np.where(open_[some], sims[some], -3.0).argmax(axis=1)
            alive = open_[some, best]
            rows = np.concatenate([rows[ranged], some[alive]])
            some, best = some[alive], best[alive]
            if len(some):
                open_[some, best] = False
                meet(some, graph[beam[some, best]])
    return hits


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return unit(flat.flatten().to_numpy().reshape(len(flat), -1))


def _adjacency(group: pa.Table) -> pa.Table:
    nodes = group["node"].to_numpy()
    graph = build_graph(_matrix(group["vector"]))
    neighbours = [nodes[row[row >= 0]] for row in graph]
    return pa.table({"node": pa.array(nodes), "neighbours": pa.array(neighbours, pa.list_(pa.int64()))})


def _searched(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        member = group["member"].to_numpy()
        asks = group["asks"].to_numpy()
        nodes, vectors = group["node"].to_numpy(), _matrix(group["vector"])
        place = np.flatnonzero(member)
        known, index = np.unique(nodes[place], return_index=True)
        place = place[index]
        if not len(place) or not asks.any():
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        home = group["home"].to_numpy()[place]
        copies = group["copies"].to_numpy()[place]
        lists = group["neighbours"].take(pa.array(place)).combine_chunks()
        counts = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy()
        at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
        row = np.repeat(np.arange(len(place)), counts)
        inside = known[at] == flat
        row, at = row[inside], at[inside]
        column = np.arange(len(row)) - np.searchsorted(row, row)
        graph = np.full((len(place), max(1, int(column.max(initial=0)) + 1)), -1)
        graph[row, column] = at
        asking = np.flatnonzero(asks)
        a, b, who, how_many = [], [], [], []
        for start in range(0, len(asking), BATCH):
            some = asking[start : start + BATCH]
            own = np.minimum(np.searchsorted(known, nodes[some]), len(known) - 1)
            own = np.where(known[own] == nodes[some], own, -1)
            hits = range_search(vectors[some], own, vectors[place], graph, threshold)
            hits[np.flatnonzero(own >= 0), own[own >= 0]] = False
            who.append(nodes[some])
            how_many.append((hits & home[None, :]) @ copies)
            q, x = np.nonzero(hits)
            if len(q):
                ends, low = local_stars(nodes[some][q], known[x])
                a.append(ends[ends != low])
                b.append(low[ends != low])
        who, how_many = np.concatenate(who), np.concatenate(how_many)
        who, how_many = who[how_many > 0], how_many[how_many > 0]
        a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in (a, b))
        return pa.table(
            {
                "a": pa.array(np.concatenate([who, a])),
                "b": pa.concat_arrays([pa.nulls(len(who), pa.int64()), pa.array(b, pa.int64())]),
                "n": pa.concat_arrays([pa.array(how_many, pa.int64()), pa.nulls(len(a), pa.int64())]),
            }
        )

    return run


def _routed(centroids: dict[int, np.ndarray]):
    """Each node with the shards of its nearest centroids, nearest first, and its
    cosine with the nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["size"].to_numpy()
            shards: list = [None] * len(sizes)
            own = np.zeros(len(sizes))
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                some = batch["vector"].take(pa.array(rows))
                vectors = unit(some.flatten().to_numpy().reshape(len(rows), -1))
                mine = centroids.get(int(size))
                for at in range(0, len(rows), 1024):
                    if mine is None:  # no row of this size was in the sample
                        order = np.zeros((len(rows[at : at + 1024]), 1), dtype=np.int64)
                    else:
                        near = vectors[at : at + 1024] @ mine.T
                        order = np.argsort(-near, axis=1)[:, :SEARCH_SHARDS]
                        own[rows[at : at + 1024]] = np.take_along_axis(near, order[:, :1], 1)[:, 0]
                    for row, near in zip(rows[at : at + 1024], order):
                        shards[row] = near
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shards, pa.list_(pa.int64())), pa.array(own)],
                [*batch.schema.names, "shards", "own"],
            )

    return run


def distinct_nodes(vectors: DataFrame) -> DataFrame:
    """(node, first, copies, size, vector): equal vectors are one node. Vectors
    that are null, empty or zero, or that hold nulls or non-finite numbers, are none."""
    return (
        vectors.where("node is not null")
        .groupBy("node")
        .agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector"))
        .select("node", "first", "copies", F.size("vector").alias("size"), "vector")
    )


def with_node(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (doubles) and node: a 64-bit hash of the vector, or null."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    fine = F.expr(
        """size(vector) > 0
           AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))
           AND exists(vector, x -> x != 0)"""
    )
    plain = F.transform("vector", lambda x: x + F.lit(0.0))  # one zero
    return rows.withColumn("node", F.when(F.coalesce(fine, F.lit(False)), F.xxhash64(plain)))


def star_links(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What connects all that a Boolean matrix of links connects: (row, column)
    and (row, row) pairs. A column that a wide row has claimed is not paired
    again, so a dense matrix gives about one pair for each row and column."""
    wide = hits.sum(axis=1) > 4
    row, column = np.nonzero(hits & ~wide[:, None])
    rows, columns, one, other = [row], [column], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    names = np.flatnonzero(wide)
    left = hits[names]
    while len(names):
        mine = np.flatnonzero(left[0])
        rows.append(np.full(len(mine), names[0]))
        columns.append(mine)
        met = names[1:][left[1:, mine].any(axis=1)]
        one.append(np.full(len(met), names[0]))
        other.append(met)
        left[:, mine] = False
        more = left.any(axis=1)
        names, left = names[more], left[more]
    return tuple(np.concatenate(x) for x in (rows, columns, one, other))


def _packed(group: pa.Table) -> pa.Table:
    """The nodes of a block in a row for each slice; floats stay as short as they are."""
    rows: dict[str, list] = {"nodes": [], "copies": [], "ranks": [], "shards": [], "short": [], "vectors": []}
    for at in range(0, len(group), SLICE):
        some = group.slice(at, SLICE)
        flat = some["vector"].combine_chunks().flatten().to_numpy()
        with np.errstate(over="ignore"):
            short = flat.astype(np.float32)
        fits = bool((short == flat).all())
        shards = some["shards"].combine_chunks()
        rows["nodes"].append(some["node"].to_numpy().tobytes())
        rows["copies"].append(some["copies"].to_numpy().tobytes())
        rows["ranks"].append(len(shards.flatten()) // len(shards))
        rows["shards"].append(shards.flatten().to_numpy().astype(np.int32).tobytes())
        rows["short"].append(fits)
        rows["vectors"].append((short if fits else flat).tobytes())
    kinds = [pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.bool_(), pa.binary()]
    columns = {name: pa.array(values, kind) for (name, values), kind in zip(rows.items(), kinds)}
    keys = {name: group[name].slice(0, len(rows["nodes"])) for name in ("size", "block")}
    return pa.table({**keys, **columns})


PACKED = "size int, block int, nodes binary, copies binary, ranks int, shards binary, short boolean, vectors binary"


class _Side:
    """The nodes of a block, sorted by home shard, beside what bounds them."""

    def __init__(self, group: pa.Table, size: int, centroids: np.ndarray):
        slices = group.to_pylist()
        shards = np.concatenate([np.frombuffer(x["shards"], np.int32).reshape(-1, x["ranks"]) for x in slices])
        order = np.argsort(shards[:, 0], kind="stable")
        self.shards = shards[order]
        self.nodes = np.concatenate([np.frombuffer(x["nodes"], np.int64) for x in slices])[order]
        self.copies = np.concatenate([np.frombuffer(x["copies"], np.int64) for x in slices])[order]
        kinds = {True: np.float32, False: np.float64}
        vectors = [np.frombuffer(x["vectors"], kinds[x["short"]]).astype(np.float64) for x in slices]
        self.vectors = unit(np.concatenate(vectors).reshape(-1, size))[order]
        self.homes, starts = np.unique(self.shards[:, 0], return_index=True)
        self.spans = [slice(a, b) for a, b in zip(starts, [*starts[1:], len(order)])]
        self.own = np.einsum("ij,ij->i", self.vectors, centroids[self.shards[:, 0]])
        self.radius = [np.arccos(np.clip(self.own[x].min(), -1, 1)) for x in self.spans]
        self.counts = np.zeros(len(order), np.int64)

    def within_reach(self, span: slice, near: np.ndarray, radius: float, apart: float, threshold: float) -> np.ndarray:
        """Places in the span that can have a neighbour in a shard: ``near`` are the
        cosines with its centroid, ``apart`` is how far the two centroids are apart."""
        angle = np.arccos(np.clip(near, -1, 1))
        reach = np.sqrt(max(0.0, 2 - 2 * threshold))
        fine = (angle <= radius + np.arccos(threshold) + SLACK) & (self.own[span] - near <= reach * apart + SLACK)
        return span.start + np.flatnonzero(fine)


def _swept(centroids: dict[int, np.ndarray], threshold: float):
    """Counts and spanning links between two blocks, for shards not searched."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        size, i, j = (k.as_py() for k in key)
        mine = centroids[size]
        blocks = group["block"].to_numpy()
        left = _Side(group.take(pa.array(np.flatnonzero(blocks == i))), size, mine)
        right = left if i == j else _Side(group.take(pa.array(np.flatnonzero(blocks == j))), size, mine)
        near_right = left.vectors @ mine[right.homes].T
        near_left = near_right if i == j else right.vectors @ mine[left.homes].T
        a, b, held = [], [], 0
        for x, one in enumerate(left.homes):
            for y, other in enumerate(right.homes):
                if one == other and i != j:  # a shard in several blocks is searched as a whole
                    continue
                if i == j and y <= x:
                    continue
                apart = float(np.linalg.norm(mine[one] - mine[other]))
                span, across = left.spans[x], right.spans[y]
                rows = left.within_reach(span, near_right[span, y], right.radius[y], apart, threshold)
                columns = right.within_reach(across, near_left[across, x], left.radius[x], apart, threshold)
                ask = ~(left.shards[rows] == other).any(axis=1)
                asked = ~(right.shards[columns] == one).any(axis=1)
                if not len(rows) or not len(columns) or not (ask.any() or asked.any()):
                    continue
                hits = left.vectors[rows] @ right.vectors[columns].T >= threshold
                r, c = hits.any(axis=1), hits.any(axis=0)
                if not r.any():
                    continue
                hits, rows, columns, ask, asked = hits[np.ix_(r, c)], rows[r], columns[c], ask[r], asked[c]
                left.counts[rows] += np.where(ask, hits @ right.copies[columns], 0)
                right.counts[columns] += np.where(asked, left.copies[rows] @ hits, 0)
                p, q, s, t = star_links(hits)
                a += [left.nodes[rows[p]], left.nodes[rows[s]]]
                b += [right.nodes[columns[q]], left.nodes[rows[t]]]
                held += len(p) + len(s)
                if held > HELD:
                    ends, low = local_stars(np.concatenate(a), np.concatenate(b))
                    a, b, held = [ends[ends != low]], [low[ends != low]], 0
        if a:
            ends, low = local_stars(np.concatenate(a), np.concatenate(b))
            a, b = ends[ends != low], low[ends != low]
        a, b = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)
        sides = [left] if i == j else [left, right]
        who = np.concatenate([x.nodes[x.counts > 0] for x in sides])
        how_many = np.concatenate([x.counts[x.counts > 0] for x in sides])
        return pa.table(
            {
                "a": pa.array(np.concatenate([who, a])),
                "b": pa.concat_arrays([pa.nulls(len(who), pa.int64()), pa.array(b, pa.int64())]),
                "n": pa.concat_arrays([pa.array(how_many, pa.int64()), pa.nulls(len(a), pa.int64())]),
            }
        )

    return run


def block_plan(
    shards: np.ndarray, counts: np.ndarray, radius: np.ndarray, centroids: np.ndarray, rows: int, threshold: float
) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(shard, first block, blocks) of each shard, and the pairs of blocks that can
    hold a link between different shards. Near shards share blocks of about ``rows``
    nodes; a larger shard is dealt over several."""
    mine = centroids[shards]
    around = mine - mine.mean(axis=0)
    order = np.argsort(around @ np.linalg.svd(around, full_matrices=False)[2][0], kind="stable")
    dealt, members, filled = [], [], rows
    for at in order:
        n = -(-int(counts[at]) // rows)
        if filled + counts[at] > rows:
            members += [[] for _ in range(n)]
            filled = 0
            dealt.append((int(shards[at]), len(members) - n, n))
        else:
            dealt.append((int(shards[at]), len(members) - 1, 1))
        filled += counts[at]
        for block in members[dealt[-1][1] :]:
            block.append(at)
    angle = np.arccos(np.clip(mine @ mine.T, -1, 1))
    can = angle <= radius[:, None] + radius[None, :] + np.arccos(threshold) + SLACK
    np.fill_diagonal(can, False)
    pairs = [
        (i, j) for i in range(len(members)) for j in range(i, len(members)) if can[np.ix_(members[i], members[j])].any()
    ]
    return dealt, pairs


def swept_links(
    routed: DataFrame, centroids: dict[int, np.ndarray], threshold: float, numbers: int = BLOCK_NUMBERS
) -> DataFrame | None:
    """(a, b, n) like the searches give, from the shards that each node was not
    searched for in; None if every node was searched for in all shards."""
    many = [size for size, mine in centroids.items() if len(mine) > SEARCH_SHARDS]
    if not many:
        return None
    spark = routed.sparkSession
    homes = routed.where(F.col("size").isin(many)).withColumn("shard", F.element_at("shards", 1))
    stats = homes.groupBy("size", "shard").agg(F.count(F.lit(1)).alias("n"), F.min("own").alias("own"))
    by_size: dict[int, list] = {}
    for row in stats.collect():  # a row for each centroid at most
        by_size.setdefault(row["size"], []).append((row["shard"], row["n"], row["own"]))
    dealt, meetings = [], []
    for size, rows in by_size.items():
        shards, counts, own = (np.array(x) for x in zip(*rows))
        radius = np.arccos(np.clip(own, -1, 1))
        places, pairs = block_plan(shards, counts, radius, centroids[size], max(1, numbers // size), threshold)
        dealt += [(size, *place) for place in places]
        meetings += [(size, block, i, j) for i, j in pairs for block in sorted({i, j})]
    if not meetings:
        return None
    places = spark.createDataFrame(dealt, "size int, shard long, base int, blocks int")
    block = (F.col("base") + F.pmod(F.xxhash64("node", F.lit(4)), "blocks")).cast("int")
    homes = homes.join(F.broadcast(places), ["size", "shard"]).select(
        "size", block.alias("block"), "node", "copies", "vector", "shards"
    )
    packed = homes.groupBy("size", "block").applyInArrow(_packed, PACKED)
    met = packed.join(
        F.broadcast(spark.createDataFrame(meetings, "size int, block int, i int, j int")), ["size", "block"]
    )
    return met.groupBy("size", "i", "j").applyInArrow(_swept(centroids, threshold), "a long, b long, n long")


def shard_rows(
    nodes: DataFrame, shard: int = SHARD, part: int = PART, chunk: int = CHUNK
) -> tuple[DataFrame, DataFrame, DataFrame, dict[int, np.ndarray]]:
    """Member rows and search rows of every shard part, routed nodes and centroids."""
    n = nodes.count()
    share = min(1.0, SAMPLE / max(1, n))
    drawn = nodes.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1_000_003)) < share * 1_000_003)
    sample: dict[int, list] = {}
    for row in drawn.select("size", "vector").collect():  # about SAMPLE rows at most
        sample.setdefault(row["size"], []).append(row["vector"])
    k = max(1, min(MAX_CENTROIDS, -(-n // shard)))
    centroids = {
        size: spherical_centroids(unit(np.array(rows)), max(1, min(len(rows), k))) for size, rows in sample.items()
    }
    kinds = "node long, copies long, size int, vector array<double>, shards array<long>, own double"
    routed = in_tasks(nodes.select("node", "copies", "size", "vector"), _routed(centroids), kinds)
    placed = routed.select(
        "node", "copies", "size", "vector", F.posexplode("shards").alias("rank", "shard")
    )
    member = F.col("rank") < MEMBER_SHARDS
    counts = placed.groupBy("size", "shard").agg(F.count_if(member).alias("members"), F.count(F.lit(1)).alias("searches"))
    counts = settle(
        counts.select(
            "size",
            "shard",
            F.greatest(F.lit(1), F.ceil(F.col("members") / part)).cast("int").alias("parts"),
            F.ceil(F.col("searches") / chunk).cast("int").alias("chunks"),
        )
    )  # a row for each centroid at most
    placed = placed.join(F.broadcast(counts), ["size", "shard"])
    placed = placed.withColumn("own_part", F.pmod(F.xxhash64("node", F.lit(2)), "parts"))
    members = placed.where(member).withColumn("home", F.col("rank") == 0)
    return members, placed, routed, centroids


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    shard: int = SHARD,
    part: int = PART,
    chunk: int = CHUNK,
    numbers: int = BLOCK_NUMBERS,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding).

    n_links counts the other rows at a cosine of ``threshold`` or above that the
    search found, copies included. Vectors of different lengths don't link, nor
    do those that have no direction: null, empty, zero, or with a null, NaN or
    infinite component; they are their own component. Rows without vec_id link
    and count, but name no component and are not kept. Repeated rows stay and
    count as copies. Other columns are ignored. An empty table gives no rows.
    """
    ship_package(vectors.sparkSession)
    rows = with_node(vectors)
    nodes = settle(distinct_nodes(rows))
    members, placed, routed, centroids = shard_rows(nodes, shard, part, chunk)
    built = members.groupBy("size", "shard", "own_part").applyInArrow(
        lambda group: _adjacency(group.select(["node", "vector"])), "node long, neighbours array<long>"
    )
    united = settle(built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours")))
    own_chunk = F.pmod(F.xxhash64("node", F.lit(3)), "chunks")
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))
    every_chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1))
    no_list = F.lit(None).cast("array<long>")
    inside = members.join(united, "node").select(
        "size", "shard", F.col("own_part").alias("part"), every_chunk.alias("chunk"), "node", "copies", "vector",
        "neighbours", "home", F.lit(True).alias("member"), F.lit(False).alias("asks"),
    )
    asked = placed.select(
        "size", "shard", every_part.alias("part"), own_chunk.alias("chunk"), "node", "copies", "vector",
        no_list.alias("neighbours"), F.lit(False).alias("home"), F.lit(False).alias("member"), F.lit(True).alias("asks"),
    )
    keys = ["size", "shard", "part", "chunk"]
    searched = inside.union(asked).groupBy(*keys).applyInArrow(_searched(threshold), "a long, b long, n long")
    swept = swept_links(routed, centroids, threshold, numbers)
    found = settle(searched if swept is None else searched.union(swept))
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    labels = connected_components(found.where("b is not null").select("a", "b"))
    groups = nodes.select("node", "first", "copies").join(links, "node", "left").join(labels, "node", "left")
    groups = settle(groups.withColumn("component", F.coalesce("component", "node")))
    ids = groups.groupBy("component").agg(F.min("first").alias("component_id"))
    groups = groups.join(ids, "component").select(
        "node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    judged = rows.select("vec_id", "node").join(groups, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return judged.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def audit_recall(vectors: DataFrame, judged: DataFrame, every: int = 50, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(links found, true links) of the rows whose vec_id is divisible by ``every``,
    by brute force in blocks against all rows. Only the stated queries travel to
    the tasks, in blocks of bounded size."""
    rows = with_node(vectors).where("node is not null and vec_id is not null")
    queries = rows.where(F.col("vec_id") % every == 0)
    true = 0
    blocks = max(1, -(-queries.count() // 4096))
    for block in range(blocks):
        some = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block)
        own: dict[int, list] = {}
        for row in some.collect():
            own.setdefault(len(row["vector"]), []).append(row["vector"])
        units = {size: unit(np.array(v)) for size, v in own.items()}

        def run(batches, units=units):
            n = 0
            for batch in batches:
                sizes = batch["size"].to_numpy()
                for size in np.unique(sizes):
                    mine = batch["vector"].take(pa.array(np.flatnonzero(sizes == size)))
                    if int(size) in units and len(mine):
                        others = unit(mine.flatten().to_numpy().reshape(len(mine), -1))
                        n += int((others @ units[int(size)].T >= threshold).sum())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

        counted = in_tasks(rows.select("vector", F.size("vector").alias("size")), run, "n long")
        true += (counted.agg(F.sum("n")).first()[0] or 0) - some.count()  # without itself
    found = judged.where((F.col("vec_id") % every == 0)).agg(F.sum("n_links")).first()[0] or 0
    return int(found), int(true)

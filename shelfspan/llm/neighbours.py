"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Equal vectors are one node, which keeps the few vec_ids that can be answers.
Every node gets first neighbours from blocks of vectors that lie near each
other along random hyperplanes. Then, round by round, every node compares its
neighbours and the nodes that name it with each other, and each of those keeps
what is nearer than it had. Queries start from the neighbours of their node and
from the vectors of the greatest norms, and follow the graph greedily.

Nearness is the inner product everywhere. A vector travels as the 8-bit code of
its direction and its norm as a float, so one very long vector takes nothing
from the others; the own norm of a node or query orders nothing and is left
out. The last scores are inner products of the original vectors in double
precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspan.session import settle

K = 20
#: Neighbours of a node in the graph; blocks of the first round: their size, and how many orders of all nodes.
DEGREE, BLOCK, TREES = 40, 1024, 20
#: Rounds go on until no more than this share of all neighbours changed in the last one.
SETTLED = 0.01
#: Nearest nodes a query keeps, how many of them it follows in a step; steps go on until it has followed all it keeps.
BEAM, FOLLOW = 80, 40
#: Nodes of the greatest norms that every query starts from too.
SEEDS = 32
SEED = 5
LISTS = "node long, ids array<long>, sims array<float>"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` (doubles) of the vectors that take part: of the commonest length, finite, not zero, with an id."""
    v = F.col("embedding").cast("array<double>")
    good = vectors.select("vec_id", v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)) & F.exists("v", lambda x: x != 0)
    )
    sizes = good.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return good.where(F.size("v") == (sizes["size"] if sizes else 0))


def nodes_of(good: DataFrame, k: int) -> DataFrame:
    """``node, v, members``: one row per different vector; members are its k + 1 smallest vec_ids.

    More can't be among the k nearest of any query. The limit on the row number
    is applied before the shuffle, so a vector with very many copies sends few rows.
    """
    order = Window.partitionBy("v").orderBy("vec_id")
    first = good.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    return first.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("members")).select(F.col("members")[0].alias("node"), "v", "members")


def matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    return np.array(column.flatten(), kind).reshape(len(column), -1)


def coded(nodes: DataFrame, dims: int, trees: int, leaf: int, count: int) -> DataFrame:
    """``node, code, keys, norm``: 8-bit direction and norm, and the place of the direction in each order."""
    # Norms are of vectors divided by the greatest component, so no square overflows.
    top = nodes.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    depth = max(0, int(np.ceil(np.log2(max(count, 1) / leaf))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.Generator(np.random.PCG64(SEED))
        planes = random.standard_normal((trees, depth + 1, dims))
        for batch in batches:
            x = matrix(batch.column(1))
            own = np.abs(x).max(1, keepdims=True)
            unit = x / own
            length = np.sqrt((unit * unit).sum(1, keepdims=True))
            unit /= length
            norm = (own / top * length).ravel()
            step = np.abs(unit).max(1, keepdims=True) / 127
            code = np.rint(unit / step).astype(np.int8)
            sizes = np.stack([step.ravel(), np.maximum(norm, np.finfo(np.float32).tiny)], 1).astype(np.float32)
            side = np.einsum("nd,tkd->ntk", unit, planes)
            bits = (side[:, :, :depth] > 0) @ (1 << np.arange(depth)[::-1]) if depth else np.zeros(side.shape[:2])
            # Inside a leaf, order by one more direction.
            keys = bits + 1 / (1 + np.exp(-side[:, :, depth]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([s.tobytes() + c.tobytes() for s, c in zip(sizes, code, strict=True)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * trees, pa.int32()), pa.array(keys.ravel().astype(np.float64))), pa.array(norm),
                ],
                ["node", "code", "keys", "norm"],
            )

    return nodes.select("node", "v").mapInArrow(run, "node long, code binary, keys array<double>, norm double")


def decode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Directions and norms."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(len(column), -1)
    sizes = np.ascontiguousarray(raw[:, :8]).view(np.float32)
    return raw[:, 8:].astype(np.float32) * sizes[:, :1], sizes[:, 1]


def best(of: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` nearest different ids of each ``of``, nearest first, ties to the smaller id."""
    order = np.lexsort((-sims, ids, of))
    of, ids, sims = of[order], ids[order], sims[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (ids[1:] != ids[:-1])
    of, ids, sims = of[new], ids[new], sims[new]
    order = np.lexsort((ids, -sims, of))
    of, ids, sims = of[order], ids[order], sims[order]
    start = np.searchsorted(of, of, "left")
    near = np.arange(len(of)) - start < keep
    return of[near], ids[near], sims[near]


def as_lists(of: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> pa.RecordBatch:
    """Rows ``node, ids, sims`` of sorted entries."""
    node, first = np.unique(of, return_index=True)
    ends = pa.array(np.append(first, len(of)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(node, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int64())), pa.ListArray.from_arrays(ends, pa.array(sims.astype(np.float32)))], ["node", "ids", "sims"]
    )


def whole_groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """Tables of sorted rows that never cut a run of equal keys; memory follows a batch and the longest run."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if held and (cut or held[-1].column(key)[-1].as_py() != keys[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def merge(lists: DataFrame, keep: int) -> DataFrame:
    """One list of the ``keep`` nearest per node out of many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches):
            t = t.combine_chunks()
            ids = t["ids"].combine_chunks()
            sizes = np.diff(ids.offsets.to_numpy())
            of = np.repeat(t["node"].to_numpy(), sizes)
            yield as_lists(*best(of, ids.flatten().to_numpy(), t["sims"].combine_chunks().flatten().to_numpy(), keep))

    return lists.repartition("node").sortWithinPartitions("node").mapInArrow(run, LISTS)


def first_graph(codes: DataFrame, degree: int, block: int) -> DataFrame:
    """Neighbours within blocks of every order; blocks are cut from sorted ranges, so none is larger than ``block``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(nodes: np.ndarray, x: np.ndarray, norm: np.ndarray) -> pa.RecordBatch:
            s = (x @ x.T) * norm
            np.fill_diagonal(s, -np.inf)
            n = min(degree, len(nodes) - 1)
            near = np.argpartition(-s, n - 1, 1)[:, :n] if n else np.zeros((len(nodes), 0), int)
            of = np.repeat(nodes, n)
            return as_lists(*best(of, nodes[near].ravel(), np.take_along_axis(s, near, 1).ravel(), degree))

        def cut() -> pa.RecordBatch:
            block_ = out(*[np.concatenate([h[i] for h in held]) for i in (1, 2, 3)])
            held.clear()
            return block_

        held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            tree, node, (x, norm) = batch.column(0).to_numpy(), batch.column(1).to_numpy(), decode(batch.column(2))
            cuts = [0, *(np.flatnonzero(np.diff(tree)) + 1).tolist(), len(tree)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                while a < b:
                    if held and held[0][0] != tree[a]:
                        yield cut()
                    room = block - sum(len(h[1]) for h in held)
                    stop = min(b, a + room)
                    held.append((int(tree[a]), node[a:stop], x[a:stop], norm[a:stop]))
                    a = stop
                    if sum(len(h[1]) for h in held) >= block:
                        yield cut()
        if held:
            yield cut()

    placed = codes.select("node", "code", F.posexplode("keys").alias("tree", "key")).select("tree", "node", "code", "key")
    ordered = placed.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node").drop("key")
    return merge(ordered.mapInArrow(compare, LISTS), degree)


def descend(graph: DataFrame, codes: DataFrame, degree: int, turn: int = 0) -> DataFrame:
    """One round: neighbours of the same node are compared; what is nearer than a node's worst is sent to it.

    A node that very many name is met through ``degree`` of them, others in each
    round, chosen by a hash; the limit is applied before the shuffle.
    """
    worst = F.when(F.size("ids") >= degree, F.element_at("sims", -1)).otherwise(F.lit(float("-inf"))).cast("float")
    pairs = graph.select("node", F.explode("ids").alias("near"))
    turned = pairs.select(F.col("near").alias("owner"), F.col("node").alias("member"))
    order = Window.partitionBy("owner").orderBy(F.xxhash64("owner", "member", F.lit(turn)), "member")
    turned = turned.withColumn("place", F.row_number().over(order)).where(F.col("place") <= degree).drop("place")
    known = pairs.select(F.col("node").alias("owner"), F.col("near").alias("member")).unionByName(turned).unionByName(graph.select(F.col("node").alias("owner"), F.col("node").alias("member"))).distinct()
    carried = codes.select("node", "code").join(graph.select("node", worst.alias("worst")), "node").withColumnRenamed("node", "member")
    rows = known.join(carried, "member").select("owner", "member", "code", "worst").repartition("owner").sortWithinPartitions("owner", "member")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches):
            t = t.combine_chunks()
            owner, member, worst, (x, norm) = t["owner"].to_numpy(), t["member"].to_numpy(), t["worst"].to_numpy(), decode(t["code"].combine_chunks())
            of, ids, sims = [], [], []
            cuts = [*np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]).tolist(), len(owner)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                s = (x[a:b] @ x[a:b].T) * norm[a:b]
                i, j = np.nonzero(s > worst[a:b, None])
                real = i != j
                i, j = i[real], j[real]
                of.append(member[a + i])
                ids.append(member[a + j])
                sims.append(s[i, j])
            found = best(np.concatenate(of), np.concatenate(ids), np.concatenate(sims), degree)
            if len(found[0]):
                yield as_lists(*found)

    return merge(graph.unionByName(rows.mapInArrow(compare, LISTS)), degree)


def search(starts: DataFrame, graph: DataFrame, codes: DataFrame, beam: int, follow: int) -> DataFrame:
    """Nearest nodes found for each query node, which starts from its own list and ends when all it keeps were followed."""
    now = starts
    asked = settle(starts.select("node").join(codes.select("node", F.col("code").alias("asked")), "node"), "asked")
    last: DataFrame | None = None
    while True:
        # The nearest not yet followed are followed; each step's were followed before.
        fresh = now if last is None else now.join(last, "node").select("node", F.array_except("ids", "done").alias("ids")).where(F.size("ids") > 0)
        if last is not None:
            fresh = settle(fresh, "fresh")
            if fresh.isEmpty():
                return now
        front = fresh.select("node", F.explode(F.slice("ids", 1, follow)).alias("at"))
        reached = front.join(graph.select(F.col("node").alias("at"), F.col("ids").alias("next")), "at").select("node", F.explode("next").alias("member"))
        if last is None:
            # What a query starts from is scored too.
            reached = reached.unionByName(starts.select("node", F.explode("ids").alias("member")))
        reached = reached.distinct()
        rows = reached.where("member <> node").join(codes.select(F.col("node").alias("member"), "code"), "member")
        # All that a query has reached comes together, so it is scored into one list.
        rows = rows.repartition("node").join(asked, "node").select("node", "member", "code", "asked").sortWithinPartitions("node")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in whole_groups(batches):
                t = t.combine_chunks()
                asked, _ = decode(t["asked"].combine_chunks())
                code, norm = decode(t["code"].combine_chunks())
                sims = (code * asked).sum(1) * norm
                yield as_lists(*best(t["node"].to_numpy(), t["member"].to_numpy(), sims, beam))

        found = rows.mapInArrow(compare, LISTS)
        done = front.groupBy("node").agg(F.collect_list("at").alias("done"))
        if last is not None:
            done = done.unionByName(last).groupBy("node").agg(F.flatten(F.collect_list("done")).alias("done"))
        now = settle(merge(found if last is None else now.unionByName(found), beam), "beam")
        last = settle(done, "followed")


def build_graph(codes: DataFrame, degree: int = DEGREE, block: int = BLOCK, settled: float = SETTLED) -> DataFrame:
    """``node, ids, sims``: the neighbour graph, written after every round, until few neighbours change.

    Lists only get nearer, so the rounds end.
    """
    graph = settle(first_graph(codes, degree, block), "graph")
    turn = 0
    while True:
        turn += 1
        before, graph = graph, settle(descend(graph, codes, degree, turn), "graph")
        both = graph.join(before.select("node", F.col("ids").alias("were")), "node", "left")
        new = F.size(F.array_except("ids", F.coalesce("were", F.array().cast("array<long>"))))
        counts = both.agg(F.sum(new).alias("new"), F.sum(F.size("ids")).alias("all")).first()
        if (counts["new"] or 0) <= settled * (counts["all"] or 0):
            return graph


def nearest(vectors: DataFrame, is_query: Column, k: int = K, degree: int = DEGREE, block: int = BLOCK, trees: int = TREES, settled: float = SETTLED) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for every row that ``is_query`` names.

    Vectors that are null, zero, of another length than most, or hold null or
    non-finite components take no part, as queries or answers. Ties go to the
    smaller vec_id; a row is never its own answer, an equal vector is. Rows that
    repeat a vec_id with the same vector count once.
    """
    good = settle(usable(vectors).dropDuplicates(["vec_id", "v"]), "vectors")
    first = good.first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    nodes = settle(nodes_of(good, k), "nodes")
    codes = settle(coded(nodes, len(first["v"]), trees, block, nodes.count()), "codes")
    graph = build_graph(codes.select("node", "code", "keys"), degree, block, settled)
    queries = settle(good.where(is_query).join(nodes.select("node", "v"), "v").select("vec_id", "node"), "queries")
    seeds = [r["node"] for r in codes.orderBy(F.desc("norm"), "node").limit(SEEDS).select("node").collect()]
    named = F.array_distinct(F.concat(F.coalesce("ids", F.array().cast("array<long>")), F.array(*[F.lit(x) for x in seeds])))
    asking = queries.select("node").distinct()
    starts = asking.join(graph, "node", "left").select("node", F.array_remove(named, F.col("node")).alias("ids"))
    found = search(starts, graph, codes, max(BEAM, k + 1), FOLLOW)
    # A node that has no other still has its own members.
    asked = asking.join(found, "node", "left").join(nodes.select("node", F.col("v").alias("q")), "node")
    near = asked.select("node", "q", F.explode(F.concat(F.array("node"), F.coalesce("ids", F.array().cast("array<long>")))).alias("near"))
    own = nodes.select(F.col("node").alias("near"), "v", "members")
    dot = F.aggregate(F.zip_with("q", "v", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    # A node's answers: at most beam + 1 nodes with k + 1 members each.
    scored = near.join(own, "near").select("node", dot.alias("score"), F.explode("members").alias("vec_id"))
    order = Window.partitionBy("node").orderBy(F.desc("score"), "vec_id")
    top = scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    lists = settle(top.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("answers")), "answers")
    # A query that isn't among the k + 1 kept is still not its own answer.
    each = queries.join(lists, "node").select(F.col("vec_id").alias("query_id"), F.slice(F.filter("answers", lambda a: a["vec_id"] != F.col("vec_id")), 1, k).alias("answers"))
    return each.select("query_id", F.posexplode("answers").alias("at", "a")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("a.vec_id").alias("vec_id"), F.col("a.score").alias("score"))

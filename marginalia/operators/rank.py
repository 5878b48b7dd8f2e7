"""PageRank and the neighbourhood of the best-ranked vertices.

The rounds of ``power_rounds`` hand on all ranks. ``page_rank`` to a tolerance hands on what is left
to be handed on: every vertex has a rank so far and a residual that its neighbours have not seen yet.
Blocks of vertices with neighbouring ids settle among themselves what stays inside, each in one
task, and only what crosses blocks is sent, from vertices that still move. Two layouts of blocks take
turns, the cuts of one in the middle of the blocks of the other, so that no group of pages stays cut.

Where links run to and fro between blocks, each round leaves a fixed share of what it got. So every
few rounds the next state is made of all the last ones, with the weights that leave least of their
residuals (reduced rank extrapolation). A weighted mean of states is a state like any other: whatever
the weights, what is missing in its ranks is what its residuals still lead to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.operators.graph import Graph, both_directions, edge_ends, induced_subgraph
from marginalia.operators.skew import SALT, SPLITS, hot_keys, salt_rows, shuffle_width
from marginalia.scratch import Scratch

TOLERANCE = 1e-10
RESET = 0.15
TOP = 10

# Equal ranks may differ in their last bits by the order of summation. Sorting on fewer digits
# leaves such ties to the label.
SORT_DIGITS = 7
ROUNDS_PER_WRITE = 5

# So many rounds make a new state of theirs, and run without a write in between unless there are hubs.
ROUNDS = 10

# A block has about so many edges, 24 bytes each while its task works on it.
BLOCK_EDGES = 1_000_000

BLOCK = "block int, ids binary, src binary, dst binary, share binary, far binary, far_block binary"
# A letter holds amounts for vertices of a block; with states it brings what they held back, their
# ranks, and then ranks and residuals of former rounds, a row each.
MAIL = "block int, ids binary, amounts binary, states binary, moving double, products array<double>, hub long, hub_amount double"


def _rank_edges(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The edges as PageRank reads them each round, and the state of the vertices at the start.

    Parallel edges become one row with their number. Every vertex gets one more row to itself
    with no edge behind it, so that its state flows through the same join as the ranks do and
    no round needs a second one.
    """
    pieces = shuffle_width(edges)
    pairs = scratch.keep(edges.groupBy("src", "dst").agg(F.count("*").alias("n")), "pairs")
    out = pairs.groupBy("src").agg(F.sum("n").alias("out_degree"), F.count("*").alias("rows"))
    hot = hot_keys(out, "src", "rows", pieces)
    if hot is None:
        sources = out.withColumn(SPLITS, F.lit(1))
        salted = pairs.withColumn(SALT, F.lit(0))
    else:
        sources = out.join(F.broadcast(hot), "src", "left")
        salted = salt_rows(pairs, "src", hot, ["dst"])
    vertices = scratch.keep(
        edge_ends(pairs, "id")
        .distinct()
        .join(sources.withColumnRenamed("src", "id"), "id", "left")
        .select("id", "out_degree", F.coalesce(SPLITS, F.lit(1)).alias(SPLITS)),
        "rank_vertices",
    )
    keepers = vertices.select(
        F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0).cast("bigint").alias("n"),
        F.lit(0).alias(SALT), "out_degree", SPLITS,
    )
    return salted.unionByName(keepers, allowMissingColumns=True), vertices


def power_rounds(edges: DataFrame, scratch: Scratch, rounds: int, reset: float = RESET) -> DataFrame:
    """``(id, rank)`` after that many rounds in which every vertex hands its rank on.

    The edges are laid out once by source, hub sources split, and kept that way: a round
    shuffles the ranks and the partial sums, never the edges.
    """
    laid_out, vertices = _rank_edges(edges, scratch)
    width = shuffle_width(edges)
    laid_out = laid_out.repartition(width, "src", SALT).sortWithinPartitions("src", SALT)
    laid_out = laid_out.persist(StorageLevel.MEMORY_AND_DISK)
    laid_out.count()  # only a filled cache tells the planner its size and partitioning

    def one_round(state: DataFrame) -> DataFrame:
        copies = state.select(
            F.col("id").alias("src"),
            (F.col("rank") / F.col("out_degree")).alias("share"),
            F.explode(F.sequence(F.lit(0), F.col(SPLITS) - 1)).alias(SALT),
        )
        received = F.coalesce(F.sum(F.col("share") * F.col("n")), F.lit(0.0))
        return (
            laid_out.join(copies, ["src", SALT])
            .groupBy(F.col("dst").alias("id"))
            .agg(
                (F.lit(reset) + F.lit(1 - reset) * received).alias("rank"),
                F.max("out_degree").alias("out_degree"),
                F.max(SPLITS).alias(SPLITS),
            )
        )

    state, done, written = vertices.withColumn("rank", F.lit(reset)), 0, None
    while done < rounds:
        some = min(ROUNDS_PER_WRITE, rounds - done)
        for _ in range(some):
            state = one_round(state)
        done += some
        state, before = scratch.keep(state, "ranks"), written
        written = state
        scratch.drop(before)
    laid_out.unpersist()
    return state.select("id", "rank")


# --- blocks --------------------------------------------------------------------------------


def _bytes(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def _pack_blocks(next_cuts: np.ndarray) -> Callable:
    """``BLOCK`` per block from its edges ``(block, src, dst, share)``, sorted by block: vertices by
    their number in the block, and behind them those of other blocks that edges lead to, with the
    blocks they will be in next."""

    def packed(block: int, src: np.ndarray, dst: np.ndarray, share: np.ndarray) -> pa.RecordBatch:
        ids = np.unique(src)
        real = share > 0  # each vertex has a row without an edge
        src, dst, share = src[real], dst[real], share[real]
        to = np.minimum(np.searchsorted(ids, dst), len(ids) - 1)
        away = ids[to] != dst
        far = np.unique(dst[away])
        to[away] = len(ids) + np.searchsorted(far, dst[away])
        row = [_bytes(ids, "<i8"), _bytes(np.searchsorted(ids, src), "<i4"), _bytes(to, "<i4"), _bytes(share, "<f8"), _bytes(far, "<i8"), _bytes(np.searchsorted(next_cuts, far, "right"), "<i4")]
        return pa.record_batch([pa.array([block], pa.int32()), *(pa.array([x], pa.binary()) for x in row)], ["block", "ids", "src", "dst", "share", "far", "far_block"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = None, []
        for batch in batches:
            blocks, *columns = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "src", "dst", "share"))
            for first, end in _stretches(blocks):
                if parts and blocks[first] != block:
                    yield packed(block, *map(np.concatenate, zip(*parts, strict=True)))
                    parts = []
                block = int(blocks[first])
                parts.append([c[first:end] for c in columns])
        if parts:
            yield packed(block, *map(np.concatenate, zip(*parts, strict=True)))

    return run


def _stretches(values: np.ndarray) -> list[tuple[int, int]]:
    """Where each run of equal values starts and ends."""
    if not len(values):
        return []
    starts = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1]
    return list(zip(starts.tolist(), [*starts[1:].tolist(), len(values)], strict=True))


def settle(n: int, src: np.ndarray, dst: np.ndarray, share: np.ndarray, held: np.ndarray, floor: float, damping: float) -> tuple[np.ndarray, np.ndarray]:
    """Hand on what each of ``n`` vertices holds until none holds more than ``floor``, above zero or
    below: what each has handed on, and what each place beyond ``n`` that edges lead to got. ``held``
    is left with the rest."""
    handed, places = np.zeros(n), max(n, int(dst.max(initial=-1)) + 1)
    sent = np.zeros(places)
    while (moving := np.abs(held) > floor).any():
        amount = np.where(moving, held, 0.0)
        held[moving] = 0.0
        handed += amount
        from_moving = np.flatnonzero(moving[src])
        got = np.bincount(dst[from_moving], damping * amount[src[from_moving]] * share[from_moving], places)
        held += got[:n]
        sent += got
    return handed, sent[n:]


def _numbers(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(data, kind)


def _numbers(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(data, kind)


class Round(NamedTuple):
    """What a round is to do: the weights for the last states if a new one is to be made of them, and
    whether to work out the products of their residuals for the weights of the next."""

    weights: list[float] | None
    products: bool


def _settle_blocks(next_cuts: np.ndarray, hubs: np.ndarray, floor: float, reset: float, todo: Round) -> Callable:
    """One round: a block takes its mail in, settles, and writes ``MAIL`` to the blocks of the other
    layout that its vertices will be in, and to those its edges lead to."""
    names = ["block", "ids", "amounts", "states", "moving", "products", "hub", "hub_amount"]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.float64()]

    def received(row: dict, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranks, residuals, and the states before as rows of ranks and residuals in turn."""
        if row["mail"] is None:
            return np.zeros(len(ids)), np.full(len(ids), reset), np.zeros((0, len(ids)))
        rank, held, former = np.zeros(len(ids)), np.zeros(len(ids)), None
        for letter in row["mail"]:
            at = np.searchsorted(ids, _numbers(letter["ids"], "<i8"))
            held[at] += _numbers(letter["amounts"], "<f8")  # no vertex twice in a letter
            if letter["states"] is not None:
                states = _numbers(letter["states"], "<f8").reshape(-1, len(at))
                former = np.zeros((len(states) - 1, len(ids))) if former is None else former
                rank[at], former[:, at] = states[0], states[1:]
        return rank, held, former

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, far, far_block = _numbers(row["ids"], "<i8"), _numbers(row["far"], "<i8"), _numbers(row["far_block"], "<i4")
                rank, held, former = received(row, ids)
                former = np.vstack([former, rank, held])
                if todo.weights is not None:
                    # Of the states whose products gave the weights, all but the one just received.
                    rank, held = (np.array(todo.weights) @ former[first:-2:2] for first in (0, 1))
                    former = np.vstack([rank, held])
                moving = float(np.abs(held).max(initial=0.0))
                products = (former[1::2] @ former[1::2].T).ravel().tolist() if todo.products else None
                edges = _numbers(row["src"], "<i4"), _numbers(row["dst"], "<i4"), _numbers(row["share"], "<f8")
                handed, sent = settle(len(ids), *edges, held := held.copy(), floor, 1 - reset)
                states = np.vstack([rank + handed, former])
                out, to = [], np.searchsorted(next_cuts, ids, "right")
                for a, b in _stretches(to):
                    out.append([int(to[a]), _bytes(ids[a:b], "<i8"), _bytes(held[a:b], "<f8"), _bytes(states[:, a:b], "<f8"), moving, None if a else products, None, None])
                some = np.flatnonzero(np.r_[sent, np.zeros(len(far) - len(sent))])
                for a, b in _stretches(far_block[some]):
                    out.append([int(far_block[some[a]]), _bytes(far[some[a:b]], "<i8"), _bytes(sent[some[a:b]], "<f8"), *[None] * 5])
                at = np.flatnonzero(np.isin(ids, hubs) & (handed != 0)) if len(hubs) else []
                out += [[*[None] * 6, int(ids[i]), float(handed[i])] for i in at]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def least_weights(products: np.ndarray) -> list[float]:
    """Weights that add up to 1 for vectors with these inner products, whose weighted sum is short."""
    lengths = np.sqrt(np.maximum(np.diag(products), 1e-300))
    scaled = products / np.outer(lengths, lengths)
    # Where the vectors depend on each other, the little that is added leaves what makes zero of them.
    found = np.linalg.solve(scaled + 1e-13 * np.eye(len(scaled)), 1 / lengths) / lengths
    found = found / found.sum() if abs(found.sum()) > 0 else found
    last = np.eye(len(products))[-1]
    good = np.isfinite(found).all() and np.abs(found).max() < 1e6 and found @ products @ found < products[-1, -1]
    return (found if good else last).tolist()


def _pack_mail(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letters from ``(block, src, id, amount)``: one for each block and source in a batch."""
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("block", "src", "id", "amount")]
        order = np.lexsort(columns[2::-1])
        blocks, sources, ids, amounts = (c[order] for c in columns)
        runs = [(a + c, a + d) for a, b in _stretches(blocks) for c, d in _stretches(sources[a:b])]
        letters = [[int(blocks[a]), _bytes(ids[a:b], "<i8"), _bytes(amounts[a:b], "<f8")] for a, b in runs]
        if letters:
            found = zip(zip(*letters, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)
            yield pa.record_batch([pa.array(c, k) for c, k in found], ["block", "ids", "amounts"])


def _block_of(cuts: list[int], key: str) -> Column:
    """The block of an id: the number of cuts at or below it."""
    if not cuts:
        return F.lit(0)

    def find(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(key) < cuts[middle], find(low, middle)).otherwise(find(middle + 1, high))

    return find(0, len(cuts))


def _laid_out(edges: DataFrame, scratch: Scratch, block_edges: int) -> tuple[list[DataFrame], DataFrame | None, list[list[int]], list[int]]:
    """The packed blocks of both layouts, the edges of hub sources with the blocks they lead to, or
    None, the cuts of both layouts, and the hubs.

    Blocks are cut along the ids so that each has about as many rows. A hub's edges are in no block:
    they stay spread over all tasks.
    """
    width = shuffle_width(edges)
    pairs = scratch.keep(edges.groupBy("src", "dst").agg(F.count("*").alias("n")), "pairs")
    out = pairs.groupBy("src").agg(F.sum("n").alias("out_degree"), F.count("*").alias("rows"))
    # A hub has more edges than a block should hold; there are fewer hubs than blocks.
    full = ceil(pairs.count() / block_edges)
    hot = hot_keys(out, "src", "rows", full) if full > 1 else None
    hubs = sorted(r["src"] for r in hot.collect()) if hot else []
    weighted = pairs.join(out.select("src", "out_degree"), "src").select("src", "dst", (F.col("n") / F.col("out_degree")).alias("share"))
    keepers = edge_ends(pairs, "src").distinct().select("src", F.col("src").alias("dst"), F.lit(0.0).alias("share"))
    rows = scratch.keep(weighted.unionByName(keepers), "rank_edges")
    inner = rows.filter(~F.col("src").isin(hubs) | (F.col("share") == 0)) if hubs else rows
    blocks = max(width, full)
    shares = [i / (2 * blocks) for i in range(1, 2 * blocks)]
    found = inner.agg(F.percentile_approx("src", shares, max(10_000, 20 * blocks)).alias("cuts")).first()["cuts"] or []
    cuts = [sorted(set(found[1::2])), sorted(set(found[::2]))]
    layouts = []
    for own, following in (cuts, cuts[::-1]):
        edges_of = inner.withColumn("block", _block_of(own, "src")).select("block", "src", "dst", "share")
        sorted_edges = edges_of.repartition(width, "block").sortWithinPartitions("block")
        layouts.append(sorted_edges.mapInArrow(_pack_blocks(np.array(following, np.int64)), BLOCK).repartition(width, "block"))
    if not hubs:
        return layouts, None, cuts, hubs
    hub_edges = rows.filter(F.col("src").isin(hubs) & (F.col("share") > 0))
    return layouts, scratch.keep(hub_edges.withColumns({f"block{i}": _block_of(c, "dst") for i, c in enumerate(cuts)}), "hub_edges"), cuts, hubs


def page_rank(
    edges: DataFrame,
    scratch: Scratch,
    tol: float | None = TOLERANCE,
    max_iter: int | None = None,
    reset: float = RESET,
    block_edges: int = BLOCK_EDGES,
) -> DataFrame:
    """``(id, rank)`` with ``rank = reset + (1 - reset) * Σ rank(u) * edges(u, v) / out_degree(u)``.

    The rank of a vertex without links out is not handed on. With ``tol``, rounds go on until no rank
    lies more than the share ``tol`` of it off the fixed point, or for ``max_iter`` rounds. Without
    it, all ranks start at ``reset`` and are handed on ``max_iter`` times.

    The bound: where no vertex holds back more than ``tol * reset``, what is missing is at most what a
    graph of that ``reset`` would rank, which is ``tol`` times the rank. Rounds with no hub run on
    without a write in between, since each reads what the last one sends only once.
    """
    if tol is None and max_iter is None:
        raise ValueError("give tol, max_iter or both")
    if tol is None:
        return power_rounds(edges, scratch, max_iter, reset)
    layouts, hub_edges, cuts, hubs = _laid_out(edges, scratch, block_edges)
    layouts = [packed.persist(StorageLevel.MEMORY_AND_DISK) for packed in layouts]
    for packed in layouts:
        packed.count()  # only a filled cache tells the planner its size and partitioning
    floor = tol * reset
    letter = F.when(F.col("ids").isNotNull(), F.struct("ids", "amounts", "states"))

    def one_round(mail: DataFrame | None, number: int, weights: list[float] | None) -> DataFrame:
        todo = Round(weights if number % ROUNDS == 0 else None, number % ROUNDS == ROUNDS - 1)
        packed = layouts[number % 2]
        step = _settle_blocks(np.array(cuts[1 - number % 2], np.int64), np.array(hubs, np.int64), floor, reset, todo)
        if mail is None:
            no_mail = F.lit(None).cast("array<struct<ids:binary,amounts:binary,states:binary>>").alias("mail")
            return packed.select("*", no_mail).mapInArrow(step, MAIL)
        letters = mail
        if hub_edges is not None:
            pushed = mail.filter("hub is not null").select(F.col("hub").alias("src"), "hub_amount")
            amount = (F.col("hub_amount") * (1 - reset) * F.col("share")).alias("amount")
            sent = hub_edges.join(F.broadcast(pushed), "src").select(F.col(f"block{number % 2}").alias("block"), "src", F.col("dst").alias("id"), amount)
            from_hubs = sent.mapInArrow(_pack_mail, "block int, ids binary, amounts binary")
            letters = mail.filter("hub is null").unionByName(from_hubs, allowMissingColumns=True)
        taken_in = letters.groupBy("block").agg(F.collect_list(letter).alias("mail")).hint("merge")
        return packed.join(taken_in, "block").mapInArrow(step, MAIL)

    mail, done, weights = None, 0, None
    while True:
        some = 1 if hubs else ROUNDS
        some = some if max_iter is None else min(some, max_iter - done)
        before, sent = mail, mail
        for number in range(done, done + some):
            sent = one_round(sent, number, weights)
        done += some
        mail = scratch.keep(sent, "mail")
        scratch.drop(before)
        moving = mail.agg(F.max("moving")).first()[0]
        if moving is None or moving <= floor or done == max_iter:
            break
        if done % ROUNDS == 0:
            summed = mail.select(F.posexplode("products")).groupBy("pos").agg(F.sum("col").alias("total")).collect()
            weights = least_weights(np.array([r.total for r in sorted(summed)]).reshape(ROUNDS, ROUNDS))
    ranks = scratch.keep(mail.filter("states is not null").mapInArrow(_unpack_ranks, "id long, rank double"), "ranks")
    for packed in layouts:
        packed.unpersist()
    scratch.drop(mail)
    return ranks


def _unpack_ranks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, held = _numbers(row["ids"], "<i8"), _numbers(row["amounts"], "<f8")
            yield pa.record_batch([pa.array(ids), pa.array(_numbers(row["states"], "<f8")[: len(ids)] + held)], ["id", "rank"])


def _by_rank(ascending: bool = False) -> list[Column]:
    rank = F.round("rank", SORT_DIGITS)
    return [rank.asc() if ascending else rank.desc(), F.col("label").asc()]


def labelled_ranks(ranks: DataFrame, vertices: DataFrame) -> DataFrame:
    return ranks.join(vertices.select("id", "label"), "id")


def top_ranked(ranked: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best of ``ranked(id, rank, label)``; the label decides between equals."""
    return ranked.orderBy(*_by_rank()).limit(k)


def top_neighbours(
    edges: DataFrame, ranked: DataFrame, top: DataFrame, k: int = TOP, neighbour_order: str = "asc"
) -> DataFrame:
    """``(id, neighbour, label, rank, place)``: ``k`` neighbours of each vertex in ``top(id)``.

    A neighbour joined by several edges takes several places. ``neighbour_order="asc"`` begins
    with the lowest rank, ``"desc"`` with the highest.
    """
    if neighbour_order not in ("asc", "desc"):
        raise ValueError(f"neighbour_order must be 'asc' or 'desc', not {neighbour_order!r}")
    around = both_directions(edges).join(top.select("id"), "id", "left_semi")
    counts = around.groupBy("id", "neighbour").agg(F.count("*").alias("n"))
    # A neighbour has one row per vertex in top, so no key of this join is hot.
    found = counts.join(ranked.withColumnRenamed("id", "neighbour"), "neighbour")
    # No neighbour can take more than k places.
    places = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)))))
    order = Window.partitionBy("id").orderBy(*_by_rank(neighbour_order == "asc"))
    return (
        places.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k)
        .select("id", "neighbour", "label", "rank", "place")
    )


def neighbourhood_ids(neighbours: DataFrame) -> DataFrame:
    """Distinct ids of the vertices and of their chosen neighbours."""
    return neighbours.select(F.explode(F.array("id", "neighbour")).alias("id")).distinct()


def top_rank_ids(
    graph: Graph, ranks: DataFrame, k: int = TOP, neighbour_order: str = "asc"
) -> DataFrame:
    """Ids of the ``k`` best vertices and ``k`` neighbours of each: at most ``k + k * k``."""
    ranked = labelled_ranks(ranks, graph.vertices)
    top = top_ranked(ranked, k)
    return neighbourhood_ids(top_neighbours(graph.edges, ranked, top, k, neighbour_order))


def top_rank_subgraph(
    graph: Graph, ranks: DataFrame, scratch: Scratch, k: int = TOP, neighbour_order: str = "asc"
) -> Graph:
    """The graph between the best-ranked vertices and their neighbours.

    The few ids are written first, as three joins need them.
    """
    ids = scratch.keep(top_rank_ids(graph, ranks, k, neighbour_order), "top_rank_ids")
    return induced_subgraph(graph, ids)


def viewable(graph: Graph) -> Graph:
    """The graph under the names a viewer reads: edges ``(from, to)``, vertices ``(id, label)``."""
    edges = graph.edges.select(F.col("src").alias("from"), F.col("dst").alias("to"))
    return Graph(graph.vertices.select("id", "label"), edges)

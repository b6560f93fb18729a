"""Exact hard negatives by a multiway hyperplane tree that prunes by distance ranges.

An anchor's positives are its best rows of the same label; the negatives of a positive are the best rows of other labels whose
score lies in a window below the positive's score. One more coordinate, ``sqrt(M**2 - |x|**2)`` with M the greatest length,
gives all rows the length M, so a window of inner products is an annulus of Euclidean distances around the anchor.

The tree has two levels of ``ways`` split points, taken farthest first from a bounded sample; a row goes to the nearest split
point, so subtrees are divided by hyperplanes. Every split point keeps the least and greatest distance to the rows of every
subtree beside it, its own included. From an anchor's distance to a split point and these ranges follow bounds on its
distance to a sibling subtree, which is eliminated if they miss all of the anchor's annuli. Leaves are stored in blocks by
distance from their split point; a block has its own ranges and is eliminated in the same way, and what is left is computed
exactly. A search has two rounds: the leaf that promises most gives lowest scores that still matter, which narrow the annuli;
then all other leaves that are still met are searched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultrail.functions.numbers import floor_div
from vaultrail.llm.blocks import matrix, sound
from vaultrail.llm.topk import _dot
from vaultrail.session import materialise

#: Rows of the sample that split points come from, rows in a leaf that the number of ways aims at, and most ways of a split.
SAMPLE, LEAF, WAYS = 20_000, 4096, 64
#: Rows in a block of a leaf, anchors looked at together.
BLOCK, ANCHORS = 512, 256

_WINDOWS = "array<struct<low:long,high:long,least:long>>"
_LEAST, _MOST = -(1 << 62), 1 << 62


@dataclass(frozen=True)
class Tree:
    """Split points of both levels with the lifted coordinate last, and the distance ranges to every leaf.

    ``low`` and ``high`` have a row per leaf: ranges of the first level's points, then of the points beside the leaf's own.
    """

    top: np.ndarray
    below: np.ndarray
    length: float
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    @property
    def ways(self) -> int:
        return len(self.top)

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([rows, np.sqrt(np.maximum(self.length**2 - np.square(rows).sum(1), 0))[:, None]], 1)

    def distances(self, rows: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """Of lifted rows to the points of the first level, and to those beside each row's leaf."""
        out = np.empty((len(rows), 2 * self.ways))
        out[:, : self.ways] = _distance(rows, self.top)
        for cell in np.unique(leaves // self.ways):
            at = leaves // self.ways == cell
            out[at, self.ways :] = _distance(rows[at], self.below[cell])
        return out

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each lifted row."""
        first = _distance(rows, self.top).argmin(1)
        out = np.empty(len(rows), np.int64)
        for cell in np.unique(first):
            at = first == cell
            out[at] = cell * self.ways + _distance(rows[at], self.below[cell]).argmin(1)
        return out

    def reach(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds on the distance of each lifted anchor to the rows of each leaf; leaves without rows are out of reach."""
        near = np.zeros((len(anchors), len(self.low)))
        far = np.full((len(anchors), len(self.low)), np.inf)
        first = _distance(anchors, self.top)
        for leaf in range(len(self.low)):
            if not np.isfinite(self.low[leaf, 0]):
                near[:, leaf] = np.inf
                continue
            both = np.concatenate([first, _distance(anchors, self.below[leaf // self.ways])], 1)
            near[:, leaf], far[:, leaf] = bounds(both, self.low[leaf], self.high[leaf])
        return near, far


def _distance(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of rows to points; infinite to a point that is missing (not a number)."""
    square = np.square(rows).sum(1)[:, None] + np.square(points).sum(1)[None, :] - 2 * rows @ points.T
    return np.where(np.isnan(square), np.inf, np.sqrt(np.maximum(square, 0)))


def bounds(distances: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible distance of anchors to rows that lie from ``low`` to ``high`` of split points.

    ``distances`` has those of the anchors (rows) to the split points (columns).
    """
    there = np.isfinite(high)
    distances, low, high = distances[:, there], low[there], high[there]
    near = np.maximum(distances - high, low - distances).max(1)
    return np.maximum(near, 0), (distances + high).min(1)


def farthest_first(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the points, each as far as possible from those before; the first is the longest."""
    chosen = [int(np.square(points).sum(1).argmax())]
    away = _distance(points, points[chosen])[:, 0]
    while len(chosen) < n and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _distance(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def _filled(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` points; those that are missing are no numbers."""
    return np.concatenate([points, np.full((n - len(points), points.shape[1]), np.nan)]) if len(points) < n else points


def plant(sample: np.ndarray, length: float, ways: int) -> Tree:
    """Split points from lifted sample rows, without ranges."""
    empty = Tree(np.empty((0, sample.shape[1])), np.empty((0, 0, sample.shape[1])), length)
    lifted = empty.lifted(sample)
    top = _filled(farthest_first(lifted, ways), ways)
    own = _distance(lifted, top).argmin(1)
    below = [_filled(farthest_first(lifted[own == c], ways) if (own == c).any() else top[c : c + 1], ways) for c in range(ways)]
    return Tree(top, np.stack(below), length)


def _placed(tree: Tree, width: int):
    """Per row its leaf, and the distance to the leaf's own split point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = tree.lifted(matrix(batch.column("vector"), width))
            leaves = tree.leaf(rows)
            away = tree.distances(rows, leaves)[np.arange(len(rows)), tree.ways + leaves % tree.ways]
            yield pa.RecordBatch.from_arrays([pa.array(leaves.astype(np.int32)), pa.array(away), *(batch.column(n) for n in ("vec_id", "label", "vector"))], names=["leaf", "away", "vec_id", "label", "vector"])

    return run


def _blocks(tree: Tree, width: int, size: int):
    """Blocks (leaf, ids, labels, data, low, high) of rows that come by leaf and distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        leaf, n = -1, 0

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                ids, labels, data = (np.concatenate(x) for x in zip(*held, strict=True))
                away = tree.distances(tree.lifted(data), np.full(len(ids), leaf))
                columns = {"leaf": leaf, "ids": ids.tobytes(), "labels": labels.tobytes(), "data": data.tobytes(), "low": away.min(0).tobytes(), "high": away.max(0).tobytes()}
                yield pa.RecordBatch.from_arrays([pa.array([columns["leaf"]], pa.int32()), *(pa.array([v], pa.binary()) for k, v in columns.items() if k != "leaf")], names=list(columns))

        for batch in batches:
            leaves, ids, labels = (batch.column(c).to_numpy() for c in ("leaf", "vec_id", "label"))
            data = matrix(batch.column("vector"), width)
            at = 0
            while at < len(ids):
                end = at + int(np.searchsorted(leaves[at:], leaves[at], "right"))
                if leaves[at] != leaf or n >= size:
                    yield from close()
                    held, leaf, n = [], int(leaves[at]), 0
                end = min(end, at + size - n)
                held.append((ids[at:end], labels[at:end], data[at:end]))
                n += end - at
                at = end
        yield from close()

    return run


def _radii(squares: np.ndarray, length: float, low: np.ndarray, high: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner and outer radius of the annulus of each window of scores; a little wider, since distances are rounded."""
    both = squares[:, None] + length**2
    inner = np.sqrt(np.maximum(both - 2.0 * high, 0))
    outer = np.sqrt(np.maximum(both - 2.0 * low, 0))
    outer[both * (1 + 1e-12) + 1e-9 < 2.0 * low] = -np.inf
    return inner - slack[:, None], outer + slack[:, None]


def _open(rows: list[dict], width: int) -> tuple[np.ndarray, ...]:
    """Anchors of rows (query_id, label, vector, windows) as arrays; windows that can hold nothing get low above high."""
    most = max(len(r["windows"]) for r in rows)
    low, high, least = np.full((len(rows), most), _MOST), np.full((len(rows), most), _LEAST), np.full((len(rows), most), _LEAST)
    for i, r in enumerate(rows):
        for j, w in enumerate(r["windows"]):
            low[i, j], high[i, j], least[i, j] = w["low"], w["high"], w["least"]
    data = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        data[i, : len(r["vector"])] = r["vector"]
    return np.array([r["query_id"] for r in rows], np.int64), np.array([r["label"] for r in rows], np.int64), data, low, high, least


def _routed(tree: Tree, width: int, first: bool):
    """Anchors that meet each leaf, together. ``first`` gives the one that promises most, else all others that are met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), ANCHORS):
                ids, labels, data, low, high, least = _open(batch.slice(begin, ANCHORS).to_pylist(), width)
                squares = np.square(data).sum(1)
                near, far = tree.reach(np.concatenate([data, np.zeros((len(data), 1))], 1))
                slack = 1e-6 * (1 + tree.length + np.sqrt(squares))

                def met(least: np.ndarray) -> np.ndarray:
                    inner, outer = _radii(squares, tree.length, np.maximum(low, least), high, slack)
                    alive = np.zeros(near.shape, bool)
                    for j in range(low.shape[1]):
                        alive |= ((near <= outer[:, j : j + 1]) & (far >= inner[:, j : j + 1])) & (low[:, j] <= high[:, j])[:, None]
                    return alive

                # By what is known before any search, so both rounds choose the same one.
                start = met(np.full_like(least, _LEAST))
                inner, _ = _radii(squares, tree.length, low, high, slack)
                aim = np.where(low <= high, inner, np.inf).min(1)
                best = np.where(start, np.abs((near + np.minimum(far, near + 4 * tree.length)) / 2 - np.where(np.isfinite(aim), aim, 0)[:, None]), np.inf).argmin(1)
                alive = start & (np.arange(near.shape[1])[None, :] == best[:, None]) if first else met(least) & (np.arange(near.shape[1])[None, :] != best[:, None])
                for leaf in np.flatnonzero(alive.any(0)).tolist():
                    at = alive[:, leaf]
                    parts = (ids[at], labels[at], data[at], low[at], high[at], least[at])
                    yield pa.RecordBatch.from_arrays([pa.array([leaf], pa.int32()), *(pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts)], names=["leaf", "q_ids", "q_labels", "q_data", "q_low", "q_high", "q_least"])

    return run


def _solved(tree: Tree, width: int, k: int, same: bool):
    """The best ``k`` of each anchor and window over the blocks that follow each other for the same anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def close() -> pa.RecordBatch:
            ids, best, owners = state[0], state[5], state[6]
            q, w, _ = np.nonzero(best > _LEAST)
            return pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(w.astype(np.int32)), pa.array(owners[best > _LEAST]), pa.array(best[best > _LEAST])], names=["query_id", "window", "vec_id", "score"])

        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                if (row["leaf"], row["q_ids"]) != now:
                    if state is not None:
                        yield close()
                    now = (row["leaf"], row["q_ids"])
                    n = len(row["q_ids"]) // 8
                    ids, labels = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_labels"], np.int64)
                    data = np.frombuffer(row["q_data"]).reshape(n, width)
                    low, high, least = (np.frombuffer(row[c], np.int64).reshape(n, -1) for c in ("q_low", "q_high", "q_least"))
                    lifted = np.concatenate([data, np.zeros((n, 1))], 1)
                    away = tree.distances(lifted, np.full(n, row["leaf"]))
                    shape = (*low.shape, k)
                    state = [ids, labels, data, np.maximum(low, least), high, np.full(shape, _LEAST, np.int64), np.zeros(shape, np.int64), away]
                _meet(tree, state, row, width, k, same)
        if state is not None:
            yield close()

    return run


def _meet(tree: Tree, state: list, row: dict, width: int, k: int, same: bool) -> None:
    """Put a block's rows that belong there among the best of each anchor and window."""
    ids, labels, data, floor, high, best, owners, away = state
    squares = np.square(data).sum(1)
    near, far = bounds(away, np.frombuffer(row["low"]), np.frombuffer(row["high"]))
    slack = 1e-6 * (1 + tree.length + np.sqrt(squares))
    # Once k are found, the k-th is the least score that matters; an equal one may win by its id.
    lowest = np.maximum(floor, best[:, :, -1])
    inner, outer = _radii(squares, tree.length, lowest, high, slack)
    alive = (near[:, None] <= outer) & (far[:, None] >= inner) & (lowest <= high)
    at = np.flatnonzero(alive.any(1))
    if not len(at):
        return
    other, owner = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
    scores = _dot(data[at], np.frombuffer(row["data"]).reshape(-1, width)).astype(np.int64)
    fits = ((labels[at][:, None] == owner[None, :]) == same) & (ids[at][:, None] != other[None, :])
    for w in range(high.shape[1]):
        held = fits & (scores >= lowest[at, w][:, None]) & (scores <= high[at, w][:, None])
        hit = held.any(1)
        for i in np.flatnonzero(hit).tolist():
            q, c = at[i], np.flatnonzero(held[i])
            s, v = np.concatenate([best[q, w], scores[i, c]]), np.concatenate([owners[q, w], other[c]])
            order = np.lexsort((v, -s))[:k]
            best[q, w], owners[q, w] = s[order], v[order]


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "window").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(tree: Tree, blocks: DataFrame, asked: DataFrame, width: int, k: int, same: bool) -> DataFrame:
    """(query_id, window, vec_id, score, rank): the ``k`` best of each window of ``asked`` (query_id, label, vector, windows)."""
    schema = "leaf int, q_ids binary, q_labels binary, q_data binary, q_low binary, q_high binary, q_least binary"

    def sweep(rows: DataFrame, first: bool) -> DataFrame:
        routes = rows.mapInArrow(_routed(tree, width, first), schema)
        # Skewed leaves are split by the planner; the anchors' side is the one that is streamed.
        met = routes.hint("merge").join(blocks, "leaf")
        return met.mapInArrow(_solved(tree, width, k, same), "query_id long, window int, vec_id long, score long")

    start = _best(materialise(sweep(asked, True), "negatives-first"), k)
    found = start.where(F.col("rank") == k).groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("kth"))
    raised = F.transform("windows", lambda w, i: F.struct(w["low"].alias("low"), w["high"].alias("high"), F.coalesce(F.try_element_at("kth", i), w["least"]).alias("least")))
    narrowed = asked.join(found, "query_id", "left").withColumn("windows", raised.cast(_WINDOWS)).drop("kth")
    rest = materialise(sweep(narrowed.repartition("query_id").select(asked.columns), False), "negatives-rest")
    return _best(start.drop("rank").unionByName(rest), k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, n_positives: int = 5, k: int = 10, low: int = 30, high: int = 90, scale: float = 256.0,
    id_name: str = "vec_id", vector_name: str = "embedding", sample: int = SAMPLE, leaf: int = LEAF, block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exactly.

    Components are ``floor(scale * x)`` of x as a double and scores are inner products. A negative's score is from ``low`` to
    ``high`` per cent of the positive's; ranks go by score and then by smaller id. Rows with a null id, label or vector, an empty
    vector, or a null or non-finite component take no part; a shorter vector is filled up with zeros. Rows of the anchor's own id
    are neither positives nor negatives; of several anchor rows with one id, the one of smallest (label, vector) asks; other
    rows that repeat an id count once each. An anchor without positives, or a positive without negatives, gives no row. Other
    columns are ignored. The split points come from at most ``sample`` rows; all rows are indexed.
    """
    spark = vectors.sparkSession
    named = vectors.select(vectors[id_name].cast("long").alias("vec_id"), label.cast("long").alias("label"), vectors[vector_name].alias("vector"), is_anchor.alias("asked"))
    named = named.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound(F.col("vector")))
    whole = materialise(named.withColumn("vector", F.transform("vector", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))), "negatives-vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    shape = whole.agg(F.max(F.size("vector")), F.count("*"), F.max(square)).first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not shape[1]:
        return spark.createDataFrame([], out)
    width, rows = shape[0], shape[1]
    ways = int(min(WAYS, max(2, np.ceil(np.sqrt(rows / leaf)))))
    taken = whole.orderBy(F.xxhash64("vec_id", "label"), "vec_id", "vector").limit(sample).select("vector").toArrow()
    tree = plant(matrix(taken.column("vector").combine_chunks(), width), float(np.sqrt(shape[2])), ways)
    placed = whole.select("vec_id", "label", "vector").mapInArrow(_placed(tree, width), "leaf int, away double, vec_id long, label long, vector array<double>")
    ordered = placed.repartitionByRange("leaf", "away", "vec_id").sortWithinPartitions("leaf", "away", "vec_id")
    blocks = materialise(ordered.mapInArrow(_blocks(tree, width, block), "leaf int, ids binary, labels binary, data binary, low binary, high binary"), "negatives-blocks")
    tree = _ranged(tree, blocks)
    anchors = whole.where("asked").groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("label", "vector")).alias("own")).select("query_id", "own.*")
    any_score = F.array(F.struct(F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high"), F.lit(_LEAST).alias("least"))).cast(_WINDOWS)
    anchors = materialise(anchors.repartition("query_id"), "negatives-anchors")
    positives = _search(tree, blocks, anchors.withColumn("windows", any_score), width, n_positives, same=True)
    positives = materialise(positives.select("query_id", "vec_id", "score", "rank"), "negatives-positives")
    # 100 * score from low to high times the positive's, as whole numbers.
    edge = F.struct((-floor_div(-(F.col("score") * low), 100)).alias("low"), floor_div(F.col("score") * high, 100).alias("high"), F.lit(_LEAST).alias("least"))
    windows = positives.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", edge.alias("w")))).alias("all"))
    windows = windows.select("query_id", F.transform("all", lambda x: x["w"]).cast(_WINDOWS).alias("windows"))
    found = _search(tree, blocks, anchors.join(windows, "query_id"), width, k, same=False)
    by_rank = positives.select("query_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(by_rank, ["query_id", "window"]).select(
        F.col("query_id").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _ranged(tree: Tree, blocks: DataFrame) -> Tree:
    """The tree with the ranges of its leaves, from those of their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                low, high = np.frombuffer(row["low"]), np.frombuffer(row["high"])
                own = ranges.setdefault(row["leaf"], [low, high])
                own[:] = np.minimum(own[0], low), np.maximum(own[1], high)
        for leaf, (low, high) in ranges.items():
            yield pa.RecordBatch.from_pydict({"leaf": pa.array([leaf] * len(low), pa.int32()), "point": pa.array(range(len(low)), pa.int32()), "low": pa.array(low), "high": pa.array(high)})

    cells = blocks.select("leaf", "low", "high").mapInArrow(run, "leaf int, point int, low double, high double").groupBy("leaf", "point").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas()
    low = np.full((tree.ways**2, 2 * tree.ways), np.inf)
    high = np.full((tree.ways**2, 2 * tree.ways), np.inf)
    low[cells["leaf"], cells["point"]], high[cells["leaf"], cells["point"]] = cells["low"], cells["high"]
    return Tree(tree.top, tree.below, tree.length, low, high)

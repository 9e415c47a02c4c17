"""Operator 5: approximate nearest neighbours from low-dimensional stable projections.

Vectors of length 1 are projected to a few dimensions by a Gaussian (2-stable) matrix: the square of a
projected distance over that of the true one is chi-square distributed. The projections are parted into the cells of
a kd-tree fitted to a sample, and the rows of a cell are indexed by a kd-tree of their own. A query first searches its own cell, then
those that can hold points within the distance that its answers so far allow. In a cell it takes points in the order of their
projected distance, verifies their vectors, and stops once a vector nearer than its current k-th would, by the
chi-square test, have been met already. Of equal vectors only as many as an answer can hold are indexed, those with the least ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.common import mark, result, stored, tidy
from hourlake.llm.minhash import groups
from hourlake.llm.vectors import matrix, unit, valid

#: Projected dimensions (even), the share of vectors as near as the k-th that must have been met, rows of a leaf, and points verified at once at first and later.
PROJECTED, CONFIDENCE, LEAF, STEP, MOST_STEP = 32, 0.91, 32, 16, 512
#: What rounding may add to the square of a projected distance: points as near as this to the bound are still verified.
ROUNDING = 1e-9
#: Rows of a cell about, cells at least and at most, rows that the cells are fitted on about, and rows of a cell from which several tasks part them.
CELL_ROWS, LEAST_CELLS, MOST_CELLS, SAMPLE, PART_ROWS = 10_000, 2, 2048, 20_000, 60_000


def chi_square(x: float, degrees: int) -> float:
    """The distribution function for an even number of degrees."""
    half, term, total = x / 2, 1.0, 0.0
    for k in range(degrees // 2):
        total += term
        term *= half / (k + 1)
    return 1 - exp(-half) * total


def quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < share else (low, middle)
    return high


def projection(dims: int, into: int = PROJECTED) -> np.ndarray:
    """The same Gaussian matrix in every task."""
    return np.random.default_rng(dims).normal(size=(dims, into))


class KdTree:
    """A kd-tree of points: split at the median of the widest dimension down to leaves, with the bounding box of each node."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, int, int]] = []  # first, last, left child, right child
        low, high = [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            first, last, parent, side = todo.pop()
            own = points[self.order[first:last]]
            low.append(own.min(0))
            high.append(own.max(0))
            at = len(self.nodes)
            self.nodes.append((first, last, -1, -1))
            if parent >= 0:
                f, n, a, b = self.nodes[parent]
                self.nodes[parent] = (f, n, at, b) if side == 0 else (f, n, a, at)
            if last - first > leaf:
                axis = int((high[-1] - low[-1]).argmax())
                if high[-1][axis] > low[-1][axis]:
                    middle = (last - first) // 2
                    self.order[first:last] = self.order[first:last][np.argpartition(own[:, axis], middle)]
                    todo += [(first, first + middle, at, 0), (first + middle, last, at, 1)]
        self.low, self.high = np.array(low), np.array(high)

    def leaves(self, point: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """The square of the least distance to each leaf and its rows, nearest leaf first: one box test for each node that is opened."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        least = (gap * gap).sum(1).tolist()
        heap = [(least[0], 0)]
        while heap:
            d, at = heapq.heappop(heap)
            first, last, left, right = self.nodes[at]
            if left < 0:
                yield d, self.order[first:last]
            else:
                heapq.heappush(heap, (least[left], left))
                heapq.heappush(heap, (least[right], right))

    def bounds(self, point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The squares of the least distances to all leaves in their order, and the leaves' nodes."""
        at = np.flatnonzero([node[2] < 0 for node in self.nodes]) if not hasattr(self, "ends") else self.ends
        self.ends = at
        gap = np.maximum(np.maximum(self.low[at] - point, point - self.high[at]), 0)
        least = (gap * gap).sum(1)
        order = np.argsort(least, kind="stable")
        return least[order], at[order]


def search(tree: KdTree, points: np.ndarray, rows: np.ndarray, ids: np.ndarray, query: np.ndarray, point: np.ndarray, own: int | None, k: int, limit: float, known: float | None = None) -> tuple[list[tuple[float, int]], int]:
    """The k nearest verified rows as (cosine, place), and how many were verified; stops by the chi-square test with quantile `limit`.

    points are the projections that the tree was built of. known: the cosine of the k-th answer from elsewhere, if there is one;
    rows below it are no answers.
    """
    best_cos, best_at, verified = np.empty(0), np.empty(0, np.int64), 0

    def reach() -> float:
        cos = max([c for c in (known, best_cos[-1] if len(best_cos) >= k else None) if c is not None], default=None)
        return np.inf if cos is None else limit * max(2 - 2 * cos, 0) + ROUNDING

    def verify(at: np.ndarray) -> None:
        nonlocal best_cos, best_at, verified
        if own is not None:
            at = at[ids[at] != own]
        verified += len(at)
        cos = (rows[at] * query).sum(1)  # unlike a matrix product the same for equal rows, wherever they stand
        least = max([c for c in (known, best_cos[-1] if len(best_cos) >= k else None) if c is not None], default=-2.0)
        near = cos >= least
        cos, at = np.concatenate([best_cos, cos[near]]), np.concatenate([best_at, at[near]])
        top = np.lexsort((ids[at], -cos))[:k]
        best_cos, best_at = cos[top], at[top]

    bounds, leaves = tree.bounds(point)
    opened = 0
    while opened < len(leaves) and bounds[opened] <= reach():
        # Leaves one by one until the reach is known, then all within it: their points in the order of their distance.
        last = opened + 1 if reach() == np.inf else int(np.searchsorted(bounds, reach(), "right"))
        at = np.concatenate([tree.order[tree.nodes[n][0] : tree.nodes[n][1]] for n in leaves[opened:last]])
        gap = points[at] - point
        far = (gap * gap).sum(1)
        at, far = at[far <= reach()], far[far <= reach()]
        order = np.argsort(far, kind="stable")
        at, far = at[order], far[order]
        step, width = 0, STEP
        while step < len(at) and far[step] <= reach():
            some = slice(step, step + width)
            verify(at[some][far[some] <= reach()])
            step, width = step + width, min(2 * width, MOST_STEP)
        opened = last
    return list(zip(best_cos.tolist(), best_at.tolist(), strict=True)), verified


class Cells:
    """Splits of projected space at medians of a sample, down to a power of two of cells."""

    def __init__(self, points: np.ndarray, cells: int):
        self.depth = max(cells - 1, 0).bit_length()
        self.axis, self.value = np.zeros(1 << self.depth, np.int64), np.zeros(1 << self.depth)
        parts = {1: points}
        for _ in range(self.depth):
            below = {}
            for at, part in parts.items():
                if len(part):
                    self.axis[at] = (part.max(0) - part.min(0)).argmax()
                    self.value[at] = np.median(part[:, self.axis[at]])
                side = part[:, self.axis[at]] > self.value[at]
                below |= {2 * at: part[~side], 2 * at + 1: part[side]}
            parts = below

    def of(self, points: np.ndarray) -> np.ndarray:
        at = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            at = 2 * at + (points[np.arange(len(points)), self.axis[at]] > self.value[at])
        return at - (1 << self.depth)


def _projected(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    units = unit(matrix(vectors))
    return units, units @ projection(units.shape[1])


def _fitted(index: DataFrame) -> dict[int, Cells]:
    """The cells of each vector length, fitted on executors to about SAMPLE rows that a hash chooses."""
    sizes = stored(index.groupBy("dims").agg(F.count("*").alias("n")), "neighbour-sizes")
    sample = index.join(sizes, "dims").where(F.pmod(F.xxhash64("vec_id", "v"), F.col("n")) < SAMPLE)
    sample = sample.repartition("dims").sortWithinPartitions("dims", "vec_id").select("dims", "n", "v")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, 1):
            cells = Cells(_projected(g["v"])[1], min(MOST_CELLS, max(LEAST_CELLS, -(-g["n"][0] // CELL_ROWS))))
            yield pa.RecordBatch.from_arrays([pa.array([g["dims"][0]], pa.int32()), pa.array([cells.axis.tobytes()], pa.binary()), pa.array([cells.value.tobytes()], pa.binary())], ["dims", "axis", "value"])

    out = {}
    with tidy(index.sparkSession):
        for row in sample.mapInArrow(work, "dims int, axis binary, value binary").collect():
            cells = Cells.__new__(Cells)
            cells.axis, cells.value = np.frombuffer(row["axis"], np.int64), np.frombuffer(row["value"])
            cells.depth = len(cells.axis).bit_length() - 1
            out[row["dims"]] = cells
    return out


def _in_cells(rows: DataFrame, fitted: dict[int, Cells]) -> DataFrame:
    """rows (vec_id, v, asks, dims, of) with their cells."""
    held = rows.sparkSession.sparkContext.broadcast(fitted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_dims, cell = batch.column("dims").to_numpy(), np.zeros(batch.num_rows, np.int32)
            for dims in np.unique(all_dims).tolist():
                at = np.flatnonzero(all_dims == dims)
                cell[at] = held.value[dims].of(_projected(batch.column("v").take(pa.array(at)).to_pylist())[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(work, f"{kinds}, cell int")


def _boxes(index: DataFrame) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray, int]]:
    """(least and largest projections, rows) of each (dims, cell)."""

    def boxes(parts: Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray, int]]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple] = {}
        for key, low, high, n in parts:
            a, b, m = held.get(key, (low, high, 0))
            held[key] = np.minimum(a, low), np.maximum(b, high), m + n
        rows = [{"dims": d, "cell": c, "low": a.tobytes(), "high": b.tobytes(), "n": n} for (d, c), (a, b, n) in held.items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("dims", pa.int32()), ("cell", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("n", pa.int64())]))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                keys = np.stack([batch.column("dims").to_numpy(), batch.column("cell").to_numpy()], 1)
                for dims, cell in np.unique(keys, axis=0).tolist() if len(keys) else []:
                    at = np.flatnonzero((keys == (dims, cell)).all(1))
                    points = _projected(batch.column("v").take(pa.array(at)).to_pylist())[1]
                    yield (dims, cell), points.min(0), points.max(0), len(at)

        yield from boxes(parts())

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        yield from boxes(((r["dims"], r["cell"]), np.frombuffer(r["low"]), np.frombuffer(r["high"]), r["n"]) for r in rows)

    kind = "dims int, cell int, low binary, high binary, n long"
    with tidy(index.sparkSession):
        rows = index.select("dims", "cell", "v").mapInArrow(own, kind).repartition("dims", "cell").mapInArrow(joined, kind).collect()
    return {(r["dims"], r["cell"]): (np.frombuffer(r["low"]), np.frombuffer(r["high"]), r["n"]) for r in rows}


ANSWER = "query_id long, of long, vec_id long, score double, verified long"


def _answers(index: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """Rows of ANSWER for queries (dims, cell, part, vec_id, of, v, known) in the parts of the index; verified in one row of each query and part, whose vec_id may be null."""
    columns = ["dims", "cell", "part", "query", "vec_id", "of", "v", "known"]
    rows = index.withColumn("query", F.lit(False)).withColumn("known", F.lit(None).cast("double")).select(columns).union(asking.withColumn("query", F.lit(True)).select(columns))
    rows = rows.repartition("dims", "cell", "part").sortWithinPartitions("dims", "cell", "part", "query")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors, tree = None, [], [], None
        limit = quantile(CONFIDENCE, PROJECTED)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        for whole in batches:
            out: list[list] = [[], [], [], [], []]
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                for dims, cell, part, query, vec_id, of, v, known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if (dims, cell, part) != key:
                        key, ids, vectors, tree = (dims, cell, part), [], [], None
                    if not query:
                        ids.append(vec_id)
                        vectors.append(np.array(v, np.float64))
                        continue
                    if tree is None and ids:  # the rows of the index come first; queries are streamed through
                        units, points = _projected(vectors)
                        names, tree, vectors = np.array(ids, np.int64), KdTree(points), []
                    found, verified = [], 0
                    if tree is not None:
                        one, point = _projected([v])
                        found, verified = search(tree, points, units, names, one[0], point[0], vec_id, k, limit, known)
                    for place, (score, row) in enumerate(found or [(None, None)]):
                        for column, value in zip(out, (vec_id, of, None if row is None else int(names[row]), score, 0 if place else verified), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ANSWER.replace(",", "").split()[::2])

    return rows.mapInArrow(work, ANSWER)


def nearest(df: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score, verified): the k nearest rows found for each row that is_query selects, by cosine, nearest first.

    verified: how many vectors the query was compared with. Every vector is indexed, with the k + 1 least ids of its copies (one may be the query's
    own). A query's answers from its own cell bound the distance at which others are searched; all are merged, ties to the smaller id. A query's own
    id is no answer to it.

    Nulls: rows with a null id or a vector that is null, empty, zero or has null or non-finite components take no part. Vectors of
    different lengths are never compared. Rows repeated in id and vector count once. With fewer than k other rows all are
    given. An empty table gives an empty result. Other columns of df are only read by is_query.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(valid(F.col("v")) & F.col("vec_id").isNotNull()).withColumn("dims", F.size("v")).withColumn("of", F.xxhash64("v"))
    since = mark()
    rows = stored(rows.dropDuplicates(["vec_id", "v"]), "neighbour-rows")
    least = Window.partitionBy("v").orderBy("vec_id")
    index = rows.withColumn("copy", F.row_number().over(least)).where(F.col("copy") <= k + 1).drop("copy")
    fitted = _fitted(rows)
    index = stored(_in_cells(index, fitted), "neighbour-index")
    boxes = _boxes(index)
    spark = df.sparkSession
    parts = stored(spark.createDataFrame([(d, c, -(-n // PART_ROWS)) for (d, c), (_, _, n) in boxes.items()], "dims int, cell int, parts long"), "neighbour-parts")
    index = stored(index.join(parts, ["dims", "cell"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts"))), "neighbour-index")
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))

    asking = stored(_in_cells(rows.where("asks"), fitted), "neighbour-queries")
    first = asking.join(parts, ["dims", "cell"]).withColumn("part", everywhere).withColumn("known", F.lit(None).cast("double"))
    near = stored(_answers(index, first, k), "neighbour-near")
    best = Window.partitionBy("query_id", "of").orderBy(F.col("score").desc_nulls_last(), "vec_id")
    kth = near.where("vec_id is not null").withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", "of", F.col("score").alias("known"))
    asking = asking.withColumnRenamed("cell", "home").join(kth.withColumnRenamed("query_id", "vec_id"), ["vec_id", "of"], "left")
    rest = _allowed(asking, boxes).join(parts, ["dims", "cell"]).withColumn("part", everywhere)
    answers = result(near.union(_answers(index, rest, k)), "neighbour-answers", since)
    verified = F.sum("verified").over(Window.partitionBy("query_id", "of")).alias("verified")
    out = answers.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score", verified)
    return out.where((F.col("rank") <= k) & F.col("vec_id").isNotNull())


def _allowed(asking: DataFrame, boxes: dict) -> DataFrame:
    """Queries (vec_id, of, v, dims, home, known) once for each cell but their own that can hold points within the distance that `known` allows."""
    held = asking.sparkSession.sparkContext.broadcast(boxes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit, sides = quantile(CONFIDENCE, PROJECTED), {}
        for (dims, cell), (low, high, _) in held.value.items():
            sides.setdefault(dims, []).append((cell, low, high))
        sides = {d: (np.array([c for c, _, _ in x]), np.array([a for _, a, _ in x]), np.array([b for _, _, b in x])) for d, x in sides.items()}
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                rows, to = [], []
                for k, (dims, home, known, v) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("dims", "home", "known", "v")), strict=True)):
                    cells, low, high = sides[dims]
                    point = _projected([v])[1][0]
                    gap = np.maximum(np.maximum(low - point, point - high), 0)
                    reach = np.inf if known is None else limit * max(2 - 2 * known, 0) + ROUNDING
                    go = cells[((gap * gap).sum(1) <= reach) & (cells != home)]
                    rows += [k] * len(go)
                    to += go.tolist()
                out = batch.select(["dims", "vec_id", "of", "v", "known"]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(to, pa.int32())], [*out.schema.names, "cell"])

    kind = asking.schema["v"].dataType.simpleString()
    return asking.mapInArrow(work, f"dims int, vec_id long, of long, v {kind}, known double, cell int")

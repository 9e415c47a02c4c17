"""Operator 4: near-duplicate embeddings by spherical k-means cells.

Centroids are fitted to a bounded sample; every vector has the cell of its nearest centroid and visits each
cell whose bisector with its own is near enough that a linked vector may lie beyond it, so that no link
is lost at a border. Cells that hold many rows are parted in the same way by centroids of their own. Inside a cell, vectors of
one label are compared by blocked cosine products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import mark, result, stored, tidy
from hourlake.llm.graph import components
from hourlake.llm.minhash import _with_roots, groups
from hourlake.llm.vectors import matrix, unit, valid

#: Vectors that a set of centroids is fitted on, about (chosen by a hash), and rounds of k-means.
SAMPLE, ROUNDS = 20_000, 8
#: Vectors for each cell; cells at least and at most of a set of centroids; rows from which a cell is parted again.
CELL_ROWS, LEAST_CELLS, MOST_CELLS, PARTED = 4096, 8, 1024, 32_768
#: Numbers of all centroids of parted cells together, which bounds what is broadcast (4 bytes each).
CENTROID_NUMBERS = 1 << 23
#: Rows of a block: groups are compared in pairs of blocks.
BLOCK = 1024
THRESHOLD = 0.98


def k_means(rows: np.ndarray, k: int) -> np.ndarray:
    """Centroids of length 1: assign by largest cosine, replace by the direction of the sum; an empty cell keeps its centroid."""
    rng = np.random.default_rng(7)
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = (rows @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        length = np.sqrt((sums * sums).sum(1))
        centres[length > 1e-12] = sums[length > 1e-12] / length[length > 1e-12, None]
    return centres


def cells_of(rows: np.ndarray, centres: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each row, and a matrix that marks the cells it is compared in: its own, and those whose bisector is within reach."""
    near = rows @ centres.T
    home = near.argmax(1)
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    return home, near[np.arange(len(rows)), home][:, None] - near <= reach * apart[home] + 1e-6


def counted(home: np.ndarray, visits: np.ndarray, cell: int) -> np.ndarray:
    """Which pairs of a cell's rows count here: in the lesser of their two cells where both are there, else in the other."""
    here = home == cell
    once = np.zeros((len(home), len(home)), bool)
    once[np.ix_(here, here)] = True
    x, y = np.flatnonzero(here), np.flatnonzero(~here)
    if len(x) and len(y):
        mixed = (cell < home[y])[None, :] | ~visits[np.ix_(x, home[y])]
        once[np.ix_(x, y)] = mixed
        once[np.ix_(y, x)] = mixed.T
    return once


def spanning(hit: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric matrix of links."""
    left, out = hit.any(1), []
    for start in np.flatnonzero(left).tolist():
        todo = [start] if left[start] else []
        left[start] = False
        while todo:
            at = todo.pop()
            new = np.flatnonzero(hit[at] & left).tolist()
            left[new] = False
            out += [(at, k) for k in new]
            todo += new
    return out


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row: links are pairs of equal, not null labels with cosine >= threshold.

    Equal vectors of one label are one node with a count, so a vector that very many rows hold is compared once. A group is
    cut into blocks, and each task compares two blocks.

    Nulls: a vector that is null, empty, zero or has null or non-finite components, and one with a null label, links with nothing: its
    component is itself. Vectors of different lengths are never compared. Repeated rows are rows of one node; a row with a null
    id has its node's component. An empty table gives an empty result.
    """
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("v"))
    part = valid(F.col("v")) & F.col("label").isNotNull()
    node = F.when(part, F.concat_ws("-", F.hex(F.xxhash64("label", "v")), F.hex(F.xxhash64(F.lit(1), "v", "label"))))
    nodes = rows.withColumn("node", node)
    classes = nodes.where("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"), F.first("label").alias("label"), F.first("v").alias("v"))
    since = mark()
    classes = stored(classes.withColumn("dims", F.size("v")), "vector-classes")
    found = stored(_compared(classes, threshold), "vector-found")
    counts = stored(found.where("b is null").groupBy("a").agg(F.sum("links").alias("links")), "vector-counts")
    roots = stored(_with_roots(components(found.where("b is not null").select("a", "b"), "vector-components")), "vector-roots")
    ids = classes.select("node", "copies", "least_id").join(roots, "node", "left").join(counts, F.col("node") == F.col("a"), "left")
    ids = stored(ids.select("node", "copies", "least_id", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "vector-nodes")
    least = stored(ids.groupBy("root").agg(F.min("least_id").alias("component_id")), "vector-least")
    ids = result(ids.join(least, "root").select("node", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"), "vector-ids", since)
    out = nodes.select("vec_id", "node").join(ids, "node", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _fitted(rows: DataFrame, keys: list[str]) -> dict[tuple, np.ndarray]:
    """Centroids for each group of rows (*keys, n, cells, node, unit), fitted on executors to about SAMPLE rows of each; n is a group's rows."""
    sample = rows.where(F.pmod(F.xxhash64("node"), F.col("n")) < SAMPLE).select(*keys, "cells", "node", "unit")
    sample = sample.repartition(*keys).sortWithinPartitions(*keys, "node").select(*keys, "cells", "unit")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, len(keys)):
            units = np.frombuffer(b"".join(g["unit"]), np.float64).reshape(len(g["unit"]), -1)
            k = min(MOST_CELLS, max(LEAST_CELLS, g["cells"][0]))
            centres = k_means(units, k).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([g[c][0]], pa.int32()) for c in keys] + [pa.array([centres.tobytes()], pa.binary())], [*keys, "centres"])

    with tidy(rows.sparkSession):
        made = sample.mapInArrow(work, ", ".join(f"{c} int" for c in keys) + ", centres binary").collect()
    return {tuple(r[c] for c in keys): np.frombuffer(r["centres"], np.float32).reshape(-1, r["dims"]).astype(np.float64) for r in made}


_PLACED = "cell int, home int, visits binary"


def _placed(rows: DataFrame, centres: dict[tuple, np.ndarray], keys: list[str], level: int, reach: float) -> DataFrame:
    """rows, each once for every cell that it visits, with cell, home and visits (a bit for each cell) of a level; cell 0 alone where no centroids are fitted."""
    held = rows.sparkSession.sparkContext.broadcast({k: v.astype(np.float32) for k, v in centres.items()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                names = list(zip(*(batch.column(c).to_pylist() for c in keys), strict=True))
                units = batch.column("unit")
                for name in set(names):
                    at = np.array([k for k, x in enumerate(names) if x == name])
                    if name in held.value:
                        rows = np.frombuffer(b"".join(units.take(pa.array(at)).to_pylist()), np.float64).reshape(len(at), -1)
                        home, visits = cells_of(rows, held.value[name].astype(np.float64), reach)
                    else:
                        home, visits = np.zeros(len(at), int), np.ones((len(at), 1), bool)
                    bits = [b.tobytes() for b in np.packbits(visits, axis=1)]
                    row, cell = np.nonzero(visits)
                    more = [pa.array(cell.astype(np.int32)), pa.array(home[row].astype(np.int32)), pa.array([bits[k] for k in row], pa.binary())]
                    out = batch.take(pa.array(at[row]))
                    yield pa.RecordBatch.from_arrays([*out.columns, *more], [*out.schema.names, f"cell{level}", f"home{level}", f"visits{level}"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(work, f"{kinds}, " + ", ".join(f"{n}{level} {k}" for n, k in (c.split() for c in _PLACED.split(", "))))


def _units(classes: DataFrame) -> DataFrame:
    """classes with their vectors scaled to length 1, in double precision, as bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["node", "label", "copies", "dims"]
            packed: list = [None] * batch.num_rows
            for dims in set(all_dims := batch.column("dims").to_pylist()):
                at = [k for k, d in enumerate(all_dims) if d == dims]
                for k, row in zip(at, unit(matrix([batch.column("v")[k].as_py() for k in at])), strict=True):
                    packed[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(packed, pa.binary())], [*names, "unit"])

    kind = classes.schema["label"].dataType.simpleString()
    return stored(classes.select("node", "label", "copies", "dims", "v").mapInArrow(work, f"node string, label {kind}, copies long, dims int, unit binary"), "vector-units")


def _in_cells(units: DataFrame, reach: float) -> DataFrame:
    """units in the cells that they visit, of two levels, stored."""
    cells = F.ceil(F.col("n") / CELL_ROWS).cast("long")
    sizes = stored(units.groupBy("dims").agg(F.count("*").alias("n")).withColumn("cells", cells), "vector-dims")
    placed = stored(_placed(units, _fitted(units.join(sizes, "dims"), ["dims"]), ["dims"], 1, reach), "vector-cells")
    keys = ["dims", "cell1"]
    large = stored(placed.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > PARTED).withColumn("cells", cells), "vector-large")
    numbers = large.agg(F.sum(F.col("dims") * F.col("cells"))).first()[0]
    if numbers is None:
        return placed.select("*", F.lit(0).alias("cell2"), F.lit(0).alias("home2"), F.lit(b"\x80").alias("visits2"))
    share = max(1.0, numbers / CENTROID_NUMBERS)  # of cells that would be too many together each gets fewer
    fewer = large.withColumn("cells", F.ceil(F.col("cells") / share).cast("long"))
    return stored(_placed(placed, _fitted(placed.join(fewer, keys), keys), keys, 2, reach), "vector-parts")


def _bits(packed: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1), axis=1).astype(bool)


def _compared(classes: DataFrame, threshold: float) -> DataFrame:
    """Rows (a, null, links) with links found for node a, and (a, b, null) of a spanning forest of the links, for each pair of blocks."""
    # Two vectors with this cosine are so far apart; one of them is within half of it of the bisector between their cells.
    reach = float(np.sqrt(max(2 - 2 * threshold, 0))) / 2 + 1e-6
    placed = _in_cells(_units(classes), reach)
    keys = ["label", "dims", "cell1", "cell2"]
    sizes = stored(placed.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), "vector-sizes")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = placed.join(sizes, keys).withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    keys += ["i", "j"]
    rows = rows.select(*keys, "block", "node", "copies", "home1", "visits1", "home2", "visits2", "unit")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, len(keys)):
            units = np.frombuffer(b"".join(g["unit"]), np.float64).reshape(len(g["node"]), -1)
            hit = units @ units.T >= threshold
            np.fill_diagonal(hit, False)
            if not hit.any():
                continue
            some = np.flatnonzero(hit.any(1))  # the others have no part in what follows
            hit = hit[np.ix_(some, some)]
            for level in "12":
                home, visits = np.array(g[f"home{level}"])[some], _bits([g[f"visits{level}"][k] for k in some])
                hit &= counted(home, visits, g[f"cell{level}"][0])
            if g["i"][0] != g["j"][0]:  # pairs inside a block belong to the task of that block alone
                block = np.array(g["block"])[some]
                hit &= block[:, None] != block[None, :]
            names, counts = [g["node"][k] for k in some], hit @ np.array(g["copies"])[some]
            linked, edges = np.flatnonzero(counts), spanning(hit)
            a = [names[k] for k in linked] + [names[e[0]] for e in edges]
            b = [None] * len(linked) + [names[e[1]] for e in edges]
            links = counts[linked].tolist() + [None] * len(edges)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(links, pa.int64())], ["a", "b", "links"])

    return rows.mapInArrow(work, "a string, b string, links long")

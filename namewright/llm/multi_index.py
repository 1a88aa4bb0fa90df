"""Near-duplicate vectors by an inverted multi-index.

Each half of a unit vector has a codebook of its own (k-means on a bounded sample); pairs of codewords are the
cells of a product grid.  A vector lives in its nearest cell and visits the nearest cells in multi-sequence order.  How
many it visits is set from the target recall: enough that a vector at exactly the threshold's
cosine, the hardest case, is met from one side or the other.  Vectors of each width have a grid of their own.

What travels to the cells is a code of one byte a component with a proven bound of its error.  Pairs whose codes are far
enough from the threshold are decided by them; the vectors themselves follow for those rows of a cell that are in
a pair too close to call, which is verified by cosine in double precision.  Links found are therefore true.

Cells are joined in blocks of bounded size, each pair of blocks a task of its own; a block writes for
each vector its number of links and one link into its block component, never its pairs.  Equal
vectors are one vertex with a weight.

Rules: vectors that are null, zero, or hold null or non-finite components link with nothing; so do null ids
(component null, not kept).  Vectors of different widths do not link.  Rows that repeat an id are one
vertex.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from namewright.llm.components import components
from namewright.llm.storage import drop, keep

#: Codewords of a half at most: 2 ** 24 cells.  Beyond 1.7e10 vectors cells grow, and are cut into more blocks.
MOST_CODEWORDS = 4096
#: Vectors that a cell holds on average.
CELL_ROWS = 1024
#: Rows whose cells are found at a time.
PART_ROWS = 2048


@dataclass
class Grid:
    """Codebooks of both halves and the number of cells that a vector visits."""

    first: np.ndarray
    second: np.ndarray
    visits: int

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def near(self, unit: np.ndarray, visits: int | None = None) -> np.ndarray:
        """The cells that each row visits, nearest first."""
        visits = min(visits or self.visits, self.cells)
        h = self.first.shape[1]
        d1 = (self.first**2).sum(1) - 2 * unit[:, :h] @ self.first.T
        d2 = (self.second**2).sum(1) - 2 * unit[:, h:] @ self.second.T
        o1, o2 = np.argsort(d1, axis=1, kind="stable")[:, :visits], np.argsort(d2, axis=1, kind="stable")[:, :visits]
        s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
        # Cells at ranks (a, b) come after all (a' <= a, b' <= b): only these can be among the first ones.
        widths = np.minimum(visits // np.arange(1, o1.shape[1] + 1), o2.shape[1])
        a = np.repeat(np.arange(len(widths)), widths)
        b = np.arange(len(a)) - np.repeat(np.cumsum(widths) - widths, widths)
        order = np.argsort(s1[:, a] + s2[:, b], axis=1, kind="stable")[:, :visits]
        return np.take_along_axis(o1, a[order], 1) * len(self.second) + np.take_along_axis(o2, b[order], 1)


def kmeans(sample: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    centres = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([((centres**2).sum(1) - 2 * part @ centres.T).argmin(1) for part in np.array_split(sample, -(-len(sample) // PART_ROWS))])
        order = np.argsort(nearest, kind="stable")
        own, begin = np.unique(nearest[order], return_index=True)
        centres[own] = np.add.reduceat(sample[order], begin, axis=0) / np.diff(np.append(begin, len(order)))[:, None]
    return np.ascontiguousarray(centres)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def fit(sample: np.ndarray, codewords: int, cosine: float, recall: float, seed: int = 0) -> Grid:
    """Codebooks from a sample of vectors; the fewest visits that reach ``recall`` at the threshold."""
    rng = np.random.default_rng(seed)
    sample = unit_rows(sample)
    half = sample.shape[1] // 2
    grid = Grid(kmeans(sample[:, :half], codewords, rng), kmeans(sample[:, half:], codewords, rng), 1)
    x = sample[:2000]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    if sample.shape[1] > 1:
        z /= np.maximum(np.sqrt((z * z).sum(1, keepdims=True)), 1e-300)
    v = cosine * x + math.sqrt(1 - cosine * cosine) * z
    looked = 16
    while True:
        near_x, near_v = grid.near(x, looked), grid.near(v, looked)
        met = np.logical_or.accumulate((near_x == near_v[:, :1]) | (near_v == near_x[:, :1]), axis=1).mean(0)
        enough = np.flatnonzero(met >= recall)
        if len(enough) or looked >= grid.cells:
            grid.visits = int(enough[0]) + 1 if len(enough) else grid.cells
            return grid
        looked = min(2 * looked, grid.cells)


# ---- codes ------------------------------------------------------------------------------------------------------------


def encode(unit: np.ndarray) -> np.ndarray:
    """Codes of unit rows: a byte a component, the scale, and a bound of what rounding loses (as bytes of each row)."""
    scale = np.abs(unit).max(axis=1).astype(np.float32)
    scale = np.maximum(scale, np.float32(1e-30))
    q = np.clip(np.rint(unit * (127 / scale.astype(np.float64))[:, None]), -127, 127)
    lost = np.sqrt(((unit - q * (scale.astype(np.float64) / 127)[:, None]) ** 2).sum(1)) * (1 + 1e-6) + 1e-9
    return np.concatenate([q.astype(np.int8).view(np.uint8), scale.view(np.uint8).reshape(-1, 4), lost.astype(np.float32).view(np.uint8).reshape(-1, 4)], axis=1)


def decode(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole components, scales and bounds of rows of codes."""
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    tail = np.ascontiguousarray(raw[:, -8:]).view(np.float32).astype(np.float64)
    return raw[:, :-8].view(np.int8).astype(np.float64), tail[:, 0] / 127, tail[:, 1] * (1 + 1e-6)


def pair_ranges(codes: list[bytes], homes: np.ndarray, visits: list[list[int] | None], cell: int, threshold: float, split: int | None):
    """Pairs of one pair of blocks that may link, in slices: (i, j, certain).

    Rows from ``split`` on are the second block and are compared with the first only; without it every pair of
    the block is compared.  ``visits`` holds the cells of those rows that live here.  A pair whose vectors visit each
    other's home is taken in the smaller one.  The products of codes are whole numbers, so a pair is judged alike wherever it is seen.
    """
    q, scale, lost = decode(codes)
    n = len(q)
    seen = np.full((n, max((len(v) for v in visits if v), default=0)), -1)
    for k, v in enumerate(visits):
        if v:
            seen[k] = v
    first, second = (n, 0) if split is None else (split, split)
    for at in range(0, first, 256):
        rows = np.arange(at, min(at + 256, first))
        close = q[rows] @ q[second:].T
        close *= scale[rows][:, None]
        close *= scale[second:][None, :]
        slack = lost[rows][:, None] + lost[second:][None, :]
        slack = slack * 1.05 + 1e-9  # a code is no longer than 1 + lost, and lost is far below 0.02
        wide = np.maximum(lost[rows][:, None], lost[second:][None, :]) > 0.02
        i, j = np.nonzero((close + slack >= threshold) | wide)
        certain = (close[i, j] - slack[i, j] >= threshold) & ~wide[i, j]
        i, j = rows[i], j + second
        if split is None:
            later = i < j
            i, j, certain = i[later], j[later], certain[later]
        # Both are seen from this cell; are they from the other's home as well?
        other = np.where(homes[i] == cell, homes[j], homes[i])
        host = np.where(homes[i] == cell, i, j)
        good = (homes[i] == cell) | (homes[j] == cell)
        maybe = np.flatnonzero(good & (other < cell))
        for part in np.array_split(maybe, 1 + len(maybe) // (1 << 18)):
            good[part[(seen[host[part]] == other[part][:, None]).any(1)]] = False
        yield i[good], j[good], certain[good]


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the classes of linked rows; ``label`` holds the smallest row of each class."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.9,
    recall: float = 0.97,
    sample_rows: int = 8192,
    block_rows: int = 8192,
    cell_rows: int = CELL_ROWS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id`` and ``kept`` (it is the smallest id of its component).

    A grid is fitted to at most ``max(sample_rows, 16 * codewords)`` vectors of its width; every vector is indexed.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vec_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, (FloatType, DoubleType))
    x = F.col(vec_col) if single else F.col(vec_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(math.inf))) & F.exists(x, lambda e: e != 0)
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v"), F.coalesce(fine, F.lit(False)).alias("fine"), F.xxhash64(x).alias("h1"), F.xxhash64(x, F.lit(1)).alias("h2"))
    usable = own.where("fine")
    classes = keep(usable.groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("v").alias("v")).withColumn("width", F.size("v")))
    grids = _grids(classes, cosine, recall, sample_rows, cell_rows)
    shared = spark.sparkContext.broadcast(grids)
    vector = classes.schema["v"].dataType.simpleString()

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, PART_ROWS):
                batch = whole.slice(at, PART_ROWS)
                widths = batch.column("width").to_numpy()
                for width in np.unique(widths).tolist():
                    part = batch.filter(pa.array(widths == width))
                    unit = unit_rows(part.column("v").flatten().to_numpy().astype(np.float64).reshape(part.num_rows, width))
                    grid = grids.get(width)
                    cells = grid.near(unit).astype(np.int32) if grid else np.zeros((part.num_rows, 1), np.int32)
                    ends = pa.array(np.arange(0, cells.size + 1, cells.shape[1], dtype=np.int32))
                    codes = pa.array([c.tobytes() for c in encode(unit)], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in ("id", "weight", "width", "v")), codes, pa.ListArray.from_arrays(ends, pa.array(cells.ravel()))],
                        ["id", "weight", "width", "v", "code", "cells"],
                    )

    seen = keep(classes.select("id", "weight", "width", "v").mapInArrow(visit, f"id long, weight long, width int, v {vector}, code binary, cells array<int>"))
    homes = F.col("cells")[0]
    visits = seen.select("id", "weight", "width", "code", homes.alias("lives"), "cells", F.posexplode("cells").alias("rank", "cell")).withColumn("home", F.col("rank") == 0)
    # Only those who live in a cell bring the list of the cells that they visit.
    visits = visits.withColumn("cells", F.when(F.col("home"), F.col("cells")))
    count = lambda home: F.ceil(F.count_if(F.col("home") == F.lit(home)) / block_rows).cast("int")
    sizes = visits.groupBy("width", "cell").agg(count(True).alias("hb"), count(False).alias("vb")).where("hb > 0")
    placed = visits.join(sizes, ["width", "cell"])
    span = lambda a, b: F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    block = F.pmod(F.xxhash64("id"), F.when(F.col("home"), F.col("hb")).otherwise(F.greatest("vb", F.lit(1)))).cast("int")
    partners = F.when(F.col("home"), span(F.lit(0), F.col("hb") + F.col("vb") - 1)).otherwise(span(F.lit(0), F.col("hb") - 1))
    placed = placed.withColumn("block", F.when(F.col("home"), block).otherwise(block + F.col("hb"))).withColumn("other", F.explode(partners))
    key = ["width", "cell", "i", "j"]
    placed = placed.select(
        "width", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") <= F.col("other")).alias("left"), "id", "weight", "code", "lives", "cells"
    )
    names = pa.schema([*((k, pa.int32()) for k in key), ("left", pa.bool_()), ("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("open", pa.bool_())])
    made = "width int, cell int, i int, j int, left boolean, id long, links long, root long, open boolean"

    def join(table: pa.Table, exact: bool = False) -> pa.Table:
        """Links of a pair of blocks.  First by code, where rows of open pairs are named; then those pairs alone, exactly."""
        table = table.sort_by([("left", "descending"), ("id", "ascending")])
        ids, weight, left = table.column("id").to_numpy(), table.column("weight").to_numpy(), table.column("left").to_numpy(zero_copy_only=False)
        width, cell, a, b = (table.column(k)[0].as_py() for k in key)
        split = int(left.sum()) if a != b else None
        unit = None
        if exact:
            unit = unit_rows(table.column("v").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(ids), width))
        links, label, open_ = np.zeros(len(ids), np.int64), np.arange(len(ids)), np.zeros(len(ids), bool)
        lives = table.column("lives").to_numpy()
        for i, j, certain in pair_ranges(table.column("code").to_pylist(), lives, table.column("cells").to_pylist(), cell, cosine, split):
            if exact:
                i, j = i[~certain], j[~certain]
                for at in range(0, len(i), 1 << 16):
                    p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                    true = np.einsum("ij,ij->i", unit[p], unit[q]) >= cosine
                    _add(links, label, weight, p[true], q[true])
            else:
                open_[i[~certain]] = open_[j[~certain]] = True
                _add(links, label, weight, i[certain], j[certain])
        some = np.flatnonzero((links > 0) | open_)
        same = lambda v, t: pa.array(np.full(len(some), v), t)
        return pa.Table.from_arrays(
            [*(same(v, pa.int32()) for v in (width, cell, a, b)), pa.array(left[some]), pa.array(ids[some]), pa.array(links[some]), pa.array(ids[label[some]]), pa.array(open_[some])], schema=names
        )

    found = keep(placed.groupBy(*key).applyInArrow(lambda t: join(t), made))
    unsure = found.where("open").select(*key, "left", "id").join(seen.select("id", "width", "weight", "code", "v", "cells"), ["id", "width"])
    unsure = unsure.select(*key, "left", "id", "weight", "code", "v", F.col("cells")[0].alias("lives"), "cells")
    proved = keep(unsure.groupBy(*key).applyInArrow(lambda t: join(t, True), made))
    every = found.unionByName(proved).where("links > 0").select("id", "links", "root")
    totals = every.groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(every.select("id", "root"), "id", "root").withColumnRenamed("node", "id")
    result = classes.select("h1", "h2", "id", "weight").join(totals, "id", "left").join(labels, "id", "left")
    result = keep(result.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("label", "id").alias("component_id")))
    drop(classes, seen, found, proved)
    met = usable.select("vec_id", "h1", "h2").join(result, ["h1", "h2"], "left")
    met = met.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    rest = own.where("not fine").select("vec_id", F.lit(0).cast("long"), "vec_id", F.col("vec_id").isNotNull())
    return met.union(rest)


def _add(links: np.ndarray, label: np.ndarray, weight: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    links += np.bincount(i, weight[j], len(links)).astype(np.int64) + np.bincount(j, weight[i], len(links)).astype(np.int64)
    merge(label, i, j)


def _grids(classes: DataFrame, cosine: float, recall: float, sample_rows: int, cell_rows: int) -> dict[int, Grid]:
    """A grid for each width that has more vectors than a cell; the others are one cell."""
    widths = {r["width"]: r["count"] for r in classes.groupBy("width").count().where(F.col("count") > cell_rows).collect()}
    codewords = {w: min(MOST_CODEWORDS, max(2, round(math.sqrt(n / cell_rows)))) for w, n in widths.items()}
    out = {}
    for width, k in sorted(codewords.items()):
        if width < 2:
            continue  # unit vectors of one component are two points: one cell
        rows = max(sample_rows, 16 * k)
        # The sample is bounded: the rows whose hash is smallest.
        sample = classes.where(F.col("width") == width).orderBy(F.xxhash64("id", F.lit(7)), "id").limit(rows).select("v").toArrow().column("v").combine_chunks()
        out[width] = fit(sample.flatten().to_numpy().astype(np.float64).reshape(-1, width), k, cosine, recall)
    return out

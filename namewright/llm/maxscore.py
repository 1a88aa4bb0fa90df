"""Exact top-k inner-product search by MaxScore over sharded postings.

Vectors are integers.  A term is a dimension; its postings are the values of a shard's vectors there, in blocks with the
greatest and least value of each.  A query term's bound is the most that any vector of a block can gain from it.
With the threshold (the k-th best score known so far) the terms fall into non-essential ones, whose
bounds together stay below it, and essential ones.  Essential postings are traversed and summed;
vectors that cannot reach the threshold with all other bounds added are left, and the rest
probe the remaining terms from the largest bound down, dropping out as soon as they cannot
compete.  Each block raises the threshold for the next.  Nothing is approximate.

Vectors are shuffled once, into shards of bounded size.  A shard reads the queries in blocks from the shared folder, so nothing is
multiplied by the number of queries.  Shards are searched in waves that grow by ``growth``: what a wave found
is merged (ties to the smaller id), and its k-th scores are the thresholds that the next wave begins with, so a
wave passes on few vectors that a later merge drops.

Vectors that are null or hold null or non-finite components take no part; a null id takes none
either.  Shorter vectors count as 0 in the places they lack.  A query's own id is no candidate;
repeated rows are candidates each, and repeated query rows are answered once (query rows that share an id and differ
are answered together).  Products beyond the exact range of doubles are summed in integers of any size.  A
component beyond 2**62, or a score among the best that a long cannot hold, is an error.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namewright.llm.storage import drop, keep

RESULT = "query_id long, vec_id long, score long"
#: Rows of a block of postings, and queries compared with it at a time.
BLOCK_ROWS, BLOCK_QUERIES = 2048, 256
#: Queries that a task has at least where a wave has fewer shards than there are cores and queries are dealt over several tasks.
TASK_QUERIES = 1 << 14
#: Below this share of pairs still alive, they probe term by term; above, the block's remaining terms are summed at once.
FEW = 0.05


def usable(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, v): components as floor(scale * x) in double precision; rows that take no part are gone."""
    x = F.col(vec_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(math.inf)))

    def whole(e: F.Column) -> F.Column:
        scaled = e * F.lit(float(scale))
        return F.when(F.abs(scaled) < F.lit(2.0**62), F.floor(scaled)).otherwise(F.raise_error(F.lit("a component is beyond 2**62")).cast("long"))

    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.transform(x, whole).alias("v"))


def matrix_of(rows: pa.ListArray) -> np.ndarray:
    """Lists as rows of a matrix, zeros where they are shorter."""
    offsets = rows.offsets.to_numpy()
    width, flat = np.diff(offsets), rows.values.to_numpy()[offsets[0] : offsets[-1]]
    out = np.zeros((len(rows), int(width.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(rows)), width), np.arange(len(flat)) - np.repeat(np.cumsum(width) - width, width)] = flat
    return out


def widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return matrix if matrix.shape[1] >= width else np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def exact_type(a: np.ndarray, b: np.ndarray):
    """The fastest number type in which all sums of products of rows are exact."""
    most = [float(np.abs(m.astype(np.float64)).max(initial=0)) for m in (a, b)]
    bound = most[0] * most[1] * max(1, a.shape[1])
    return np.float64 if bound < 2**52 else np.int64 if bound < 2**61 else object


class Best:
    """The k best (score, id) of each of some queries, and the thresholds that they give."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.threshold = k, floor.copy()
        self.owner, self.ids, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, floor.dtype)

    def add(self, owner: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(owner):
            return
        owner, ids, score = np.concatenate([self.owner, owner]), np.concatenate([self.ids, ids]), np.concatenate([self.score, score])
        order = np.lexsort((ids, -score, owner)) if score.dtype != object else np.array(sorted(range(len(owner)), key=lambda i: (owner[i], -score[i], ids[i])))
        owner, ids, score = owner[order], ids[order], score[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        kth = place == self.k - 1
        self.threshold[owner[kth]] = np.maximum(self.threshold[owner[kth]], score[kth])
        top = place < self.k
        self.owner, self.ids, self.score = owner[top], ids[top], score[top]


class Shard:
    """Postings of one shard: for each block of rows a column of values a term, with its greatest and least value."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix

    def best(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> Best:
        """The k best of each query that reach its ``floor``, a k-th score known from elsewhere (-inf if none)."""
        width = max(self.matrix.shape[1], queries.shape[1])
        kind = exact_type(widened(self.matrix, width), widened(queries, width))
        queries = widened(queries, width).astype(kind)
        found = Best(floor.astype(np.float64 if kind is np.float64 else object), k)
        for at in range(0, len(self.ids), BLOCK_ROWS):
            ids, block = self.ids[at : at + BLOCK_ROWS], widened(self.matrix[at : at + BLOCK_ROWS], width).astype(kind)
            self._search(query_ids, queries, ids, block, found)
        return found

    @staticmethod
    def _search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, block: np.ndarray, found: Best) -> None:
        threshold = found.threshold
        bounds = np.maximum(queries * block.max(axis=0, initial=0), queries * block.min(axis=0, initial=0))
        order = np.argsort(bounds, axis=1, kind="stable")
        ranked = np.take_along_axis(bounds, order, 1)
        below = np.concatenate([ranked[:, :0].sum(axis=1, keepdims=True), np.cumsum(ranked, axis=1)], axis=1)  # what the r smallest bounds give together
        spare = (below[:, 1:] < threshold[:, None]).sum(axis=1)  # the non-essential terms are the first ones
        rest = np.take_along_axis(below, spare[:, None], 1)
        essential = np.empty(bounds.shape, bool)
        np.put_along_axis(essential, order, np.arange(bounds.shape[1]) >= spare[:, None], 1)
        used = np.flatnonzero(essential.any(axis=0))
        partial = np.where(essential[:, used], queries[:, used], 0) @ block[:, used].T
        alive = (partial + rest >= threshold[:, None]) & (query_ids[:, None] != ids[None, :])
        if alive.mean() > FEW:
            others = np.flatnonzero(~essential.all(axis=0))
            partial = partial + np.where(essential[:, others], 0, queries[:, others]) @ block[:, others].T
            q, r = np.nonzero(alive & (partial >= threshold[:, None]))
            found.add(q, ids[r], partial[q, r])
            return
        q, r = np.nonzero(alive)
        score = partial[q, r]
        for step in range(int(spare.max(initial=0))):
            # The largest bound that is left; queries with fewer terms are done.
            left = spare[q] - 1 - step
            some = left >= 0
            term = order[q[some], left[some]]
            score[some] += queries[q[some], term] * block[r[some], term]
            stay = score + below[q, np.maximum(left, 0)] >= threshold[q]
            q, r, score = q[stay], r[stay], score[stay]
        good = score >= threshold[q]
        found.add(q[good], ids[r[good]], score[good])


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    shard_rows: int = 1 << 16,
    growth: int = 4,
) -> DataFrame:
    """The k best vectors of each query: query_id, rank (from 1), vec_id, score."""
    spark = vectors.sparkSession
    base, asked = usable(vectors, id_col, vec_col, scale), keep(usable(queries, id_col, vec_col, scale).distinct())
    n, n_asked = base.count(), asked.count()
    cores = spark.sparkContext.defaultParallelism
    # A shard for each core where that leaves some thousand rows each; no shard is larger than its bound.
    shards = max(1, math.ceil(n / shard_rows), min(cores, math.ceil(n / (4 * BLOCK_ROWS))))
    dealt = keep(base.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int")).repartition(shards, "shard"))
    found, begin, size = None, 0, 1
    while begin < shards:
        # Waves of a growing number of shards; each begins with the thresholds of all before it.
        parts = max(1, min(math.ceil(cores / min(size, shards - begin)), math.ceil(n_asked / TASK_QUERIES)))
        part = dealt.where(F.col("shard").between(begin, begin + size - 1)).select("shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "id", "v")
        known = asked if found is None else asked.join(_thresholds(found, k), "id", "left")
        known = keep(known.select("id", "v", (F.col("floor") if found is not None else F.lit(None).cast("long")).alias("floor")).coalesce(shards))
        fresh = keep(part.groupBy("shard", "part").applyInArrow(_searcher(known, k, parts), RESULT))
        merged = fresh if found is None else found.unionByName(fresh)
        old, found = found, keep(_ranked(merged, k).drop("rank"))
        drop(old, fresh, known)
        begin, size = begin + size, max(1, begin + size) * (growth - 1)
    drop(asked, dealt)
    if found is None:
        found = spark.createDataFrame([], RESULT)
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _thresholds(found: DataFrame, k: int) -> DataFrame:
    """(id, floor): the k-th best score of each query that has k."""
    return found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k).drop("n")


def _searcher(known: DataFrame, k: int, parts: int):
    """A function that searches the queries of a kept table, or one of several parts of them, in one shard."""
    path = known._kept_at

    def work(table: pa.Table) -> pa.Table:
        ids, columns = table.column("id").to_numpy(), [[], [], []]
        shard, own = Shard(ids, matrix_of(table.column("v").combine_chunks())), table.column("part")[0].as_py()
        for number, batch in enumerate(stored_batches(path, BLOCK_QUERIES)):
            if number % parts != own:
                continue
            floor = batch.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
            asked = batch.column("id").to_numpy()
            exact = np.array([-math.inf if f is None else f for f in batch.column("floor").to_pylist()], object) if np.abs(np.nan_to_num(floor)).max(initial=0) >= 2**52 else np.where(np.isnan(floor), -math.inf, floor)
            best = shard.best(asked, matrix_of(batch.column("v")), exact, k)
            if any(abs(s) >= 2**63 for s in best.score.tolist()):
                raise OverflowError("a score among the best does not fit a long")
            for column, values in zip(columns, (asked[best.owner], best.ids, best.score.astype(np.int64)), strict=True):
                column.append(values)
        made = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("query_id", "vec_id", "score"), made, strict=True)})

    return work


def stored_batches(path: str, rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of a kept table, read by an executor from the shared folder in batches of bounded size."""
    from pyarrow import dataset, fs

    store, folder = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)
    for batch in dataset.dataset(folder, filesystem=store, format="parquet").to_batches(batch_size=rows, batch_readahead=1, fragment_readahead=1):
        if batch.num_rows:
            yield batch

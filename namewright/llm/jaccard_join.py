"""Exact Jaccard join of word-shingle sets by pivots, Voronoi regions and triangle-inequality windows.

Jaccard distance between unrelated texts is exactly 1, so documents taken as pivots at random would leave every
text at distance 1 from every pivot and each window would hold the whole table.  The first level
therefore takes one-shingle sets as pivots.  A text is at distance below 1 of exactly the pivots
of its own shingles; ranked from rare to common, its nearest is its rarest, and a text within
distance t of it shares one of its first ``n - ceil((1 - t) n) + 1``.  These are the text's
window: it is replicated to those regions and every link falls into a common one.  Ranks come
from a count sketch of fixed size over all shingles; any ranking keeps the join exact.

A region is joined around a document of its own: distances to that pivot are verified exactly, and
texts within t of it need no comparison with each other to be known as connected.  What is still
apart is joined recursively: texts of a region in different classes, in blocks, by further pivots and
their windows where these shrink the work, otherwise pair by pair as a matrix
product inside the task, which writes links only.  The largest class of a region is never compared with itself, so a group of copies
costs its size times what differs from it.  Small regions (``FEW``) compare what differs in class
directly.  Before two sets are compared, a coarser metric that never exceeds theirs (bucket counts) rules
most pairs out.  Nothing is capped.

Equal sets are one node from the start; membership returns them at the end.

Rules: null and empty texts and texts of blanks have an empty set and link with nothing, not even with each
other; null ids get a component of their own (null); repeated rows are equal sets; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.batches import slices
from namewright.llm.components import components
from namewright.llm.storage import drop, keep

#: Text bytes shingled at a time; the arrays for them take about fifty times as much.
PART_BYTES = 2 << 20
#: Counters of the rank sketch, and rows in which they travel.  16 MB whatever the input.
SKETCH_BITS, PARTS = 22, 64
#: Bits of the filter that tells which sets later steps need.  4 MB whatever the input.
FILTER_BITS = 25
#: A shingle counted more often is dealt over several tasks.
HOT = 1 << 20
#: Shingles, and documents, of a block of a region.
BLOCK_SHINGLES, BLOCK_DOCS = 1 << 20, 1024
#: Buckets of the counts that rule pairs out before their sets are compared.
BUCKETS = 256
#: Texts of a smaller region that are still apart are compared pair by pair, each with at most this many others.
FEW = 64


def need(n: int, percent: int) -> int:
    """Shingles of a set of n that a linked set shares at least."""
    return -(-n * percent // 100)


def sizes_fit(a: F.Column, b: F.Column, percent: int) -> F.Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def describe(docs: DataFrame, width: int) -> DataFrame:
    """A row per document (doc_id, n, node, fp) and, from each task, the parts of its sketch (task, part, counts)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np
        from pyspark import TaskContext

        from namewright.llm.shingles import fingerprint, shingle_sets

        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        seen: set[bytes] = set()
        for batch in slices(batches, "text", PART_BYTES):
            sizes, marks, fresh = [], [], []
            for s in shingle_sets(batch.column("text"), width):
                mark = fingerprint(s) if len(s) else None
                sizes.append(len(s))
                marks.append(mark)
                if mark and mark not in seen:
                    seen.add(mark)
                    fresh.append(s)
            if fresh:
                sketch += np.bincount(np.concatenate(fresh) >> np.uint64(64 - SKETCH_BITS), minlength=len(sketch)).astype(np.uint32)
            nodes = [int.from_bytes(m[:8], "little", signed=True) if m else None for m in marks]
            empty = pa.nulls(len(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(marks, pa.binary()), empty, empty, pa.nulls(len(sizes), pa.binary())],
                ["doc_id", "n", "node", "fp", "task", "part", "counts"],
            )
        if seen:
            task = TaskContext.get().partitionId()
            cells = sketch.reshape(PARTS, -1)
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": None, "n": None, "node": None, "fp": None, "task": task, "part": i, "counts": zlib.compress(c.tobytes(), 1)} for i, c in enumerate(cells)],
                pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("fp", pa.binary()), ("task", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())]),
            )

    return keep(docs.mapInArrow(work, "doc_id long, n long, node long, fp binary, task int, part int, counts binary"))


def merged_sketch(parts: DataFrame):
    """The sum of all tasks' sketches, as an array of the fixed size; added up in groups of bounded size."""
    import zlib

    import numpy as np

    def add(table: pa.Table) -> pa.Table:
        total = None
        for raw in table.column("counts"):
            cells = np.frombuffer(zlib.decompress(raw.as_py()), np.uint32)
            total = cells.astype(np.uint64) if total is None else total + cells
        out = zlib.compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes(), 1)
        return pa.table({"task": pa.array([table.column("task")[0].as_py() // 256], pa.int32()), "part": table.column("part")[:1].cast(pa.int32()), "counts": pa.array([out], pa.binary())})

    tasks = parts.agg(F.max("task")).first()[0]
    parts = parts.select("task", "part", "counts")
    rest = (tasks or 0) + 1
    while rest > 1:
        parts = parts.groupBy("part", F.floor(F.col("task") / 256)).applyInArrow(add, "task int, part int, counts binary")
        rest = math.ceil(rest / 256)
    sketch = np.zeros((PARTS, (1 << SKETCH_BITS) // PARTS), np.uint32)
    for row in parts.collect():
        sketch[row["part"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
    return sketch.reshape(-1)


def windows(docs: DataFrame, sketch, width: int, percent: int, partitions: int) -> DataFrame:
    """(region, node): the members of every region of two or more nodes."""
    import numpy as np


    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    buckets = 4 * partitions
    # The upper 48 bits of a shingle and a node: 14 bytes.
    kind = np.dtype([("high", "<u4"), ("low", "<u2"), ("node", "<u8")])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from namewright.llm.shingles import BASE, fingerprint, mix, shingle_sets

        counts, seen = shared.value, set()
        for batch in slices(batches, "text", PART_BYTES):
            keys, nodes = [], []
            for s in shingle_sets(batch.column("text"), width):
                if not len(s) or (mark := fingerprint(s)) in seen:
                    continue
                seen.add(mark)
                window = len(s) - need(len(s), percent) + 1
                order = np.lexsort((s, counts[s >> np.uint64(64 - SKETCH_BITS)]))[:window]
                keys.append(s[order])
                nodes.append(np.full(window, np.frombuffer(mark[:8], np.uint64)[0]))
            if not keys:
                continue
            key, node = np.concatenate(keys), np.concatenate(nodes)
            rows = np.zeros(len(key), kind)
            rows["high"], rows["low"], rows["node"] = key >> np.uint64(32), (key >> np.uint64(16)) & np.uint64(0xFFFF), node
            salts = counts[key >> np.uint64(64 - SKETCH_BITS)].astype(np.uint64) // np.uint64(HOT) + np.uint64(1)
            bucket = (mix(key + (node % salts) * BASE) % np.uint64(buckets)).astype(np.int64)
            rows = rows[np.argsort(bucket, kind="stable")]
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            parts = [(b, rows[(ends[b - 1] if b else 0) : ends[b]].tobytes()) for b in np.unique(bucket).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())], ["bucket", "rows"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from namewright.llm.shingles import mix

        parts = [np.frombuffer(raw, kind) for batch in batches for raw in batch.column("rows").to_pylist()]
        if not parts:
            return
        rows = np.concatenate(parts)
        parts.clear()
        key, node = (rows["high"].astype(np.uint64) << np.uint64(32)) | (rows["low"].astype(np.uint64) << np.uint64(16)), rows["node"]
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        once = ~np.append(False, (key[1:] == key[:-1]) & (node[1:] == node[:-1]))
        key, node = key[once], node[once]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count = np.diff(np.append(begin, len(key)))
        hot = shared.value[key[begin] >> np.uint64(64 - SKETCH_BITS)] >= HOT
        # Regions of the same members are one; a region that is dealt over tasks goes by its key.
        name = np.where(hot, mix(key[begin]), mix(np.add.reduceat(mix(node), begin) + count.astype(np.uint64)))
        chosen = np.flatnonzero((count >= 2) | hot)
        _, once = np.unique(name[chosen], return_index=True)
        chosen = chosen[np.sort(once)]
        for at in range(0, len(chosen), 50_000):
            part = chosen[at : at + 50_000]
            index = np.repeat(begin[part] - np.append(0, np.cumsum(count[part])[:-1]), count[part]) + np.arange(count[part].sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(name[part], count[part]).view(np.int64)), pa.array(node[index].view(np.int64))], ["region", "node"]
            )

    dealt = docs.select("text").mapInArrow(deal, "bucket int, rows binary").repartition(partitions, "bucket")
    return dealt.mapInArrow(gather, "region long, node long")


def chosen_rows(docs: DataFrame, wanted: DataFrame, width: int, made, kind: str) -> DataFrame:
    """(doc, value): ``made(set)`` of the documents in ``wanted``; a few others may come along.

    A filter of fixed size tells each task which texts to look at, so no text is shuffled.
    """
    import numpy as np

    bits = F.pmod(F.xxhash64("doc"), F.lit(1 << FILTER_BITS))
    words = wanted.select((bits / 32).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (bits % 32).cast("int")).alias("b"))
    # At most 2 ** (FILTER_BITS - 5) words whatever the number of documents.
    rows = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    filled = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    if rows.num_rows:
        filled[rows.column("w").to_numpy()] = rows.column("b").to_numpy().astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        from namewright.llm.shingles import shingle_sets

        for batch in slices(batches, "text", PART_BYTES):
            bit = batch.column("bit").to_numpy()
            hit = (shared.value[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1
            part = batch.filter(pa.array(hit & pc.is_valid(batch.column("doc_id")).to_numpy(zero_copy_only=False)))
            if part.num_rows:
                values = [made(s) for s in shingle_sets(part.column("text"), width)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values, pa.binary())], ["doc", "value"])

    rows = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS)).alias("bit"))
    return rows.mapInArrow(work, f"doc long, value {kind}")


def packed(shingles) -> bytes:
    """All 64 bits of each shingle's hash, ascending."""
    import numpy as np

    return np.ascontiguousarray(shingles, "<u8").tobytes()


def unpacked(raw: bytes):
    import numpy as np

    return np.frombuffer(raw, "<u8")


def counted(shingles) -> bytes | None:
    """How many shingles fall into each of ``BUCKETS`` buckets, or None if a count is too large to hold.

    The Jaccard similarity of two such multisets (sum of least over sum of greatest counts) is never below that
    of the sets: merging elements can only bring sets closer.
    """
    import numpy as np

    counts = np.bincount((shingles & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    return counts.astype("<u2").tobytes() if counts.max(initial=0) < 1 << 16 else None


def tested(pairs: DataFrame, values: DataFrame, test) -> DataFrame:
    """The (doc, other) pairs whose two values pass ``test``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [test(a, b) for a, b in zip(batch.column("value").to_pylist(), batch.column("value2").to_pylist(), strict=True)]
            yield batch.filter(pa.array(good, pa.bool_())).select(["doc", "other"])

    both = pairs.join(values, "doc").join(values.select(F.col("doc").alias("other"), F.col("value").alias("value2")), "other")
    return both.select("doc", "other", "value", "value2").mapInArrow(work, "doc long, other long")


def verified(docs: DataFrame, pairs: DataFrame, counts: DataFrame, width: int, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` as a kept table (a, b): bucket counts first, then the sets."""
    import numpy as np

    def possible(a, b) -> bool:
        if a is None or b is None:
            return True
        x, y = np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(b, "<u2").astype(np.int64)
        return 100 * np.minimum(x, y).sum() >= percent * np.maximum(x, y).sum()

    def exact(a: bytes, b: bytes) -> bool:
        shared = len(np.intersect1d(unpacked(a), unpacked(b), assume_unique=True))
        return 100 * shared >= percent * ((len(a) + len(b)) // 8 - shared)

    close = keep(tested(pairs, counts, possible))
    wanted = close.select(F.explode(F.array("doc", "other")).alias("doc")).distinct()
    sets = keep(chosen_rows(docs, wanted, width, packed, "binary"))
    links = keep(tested(close, sets, exact).select(F.col("doc").alias("a"), F.col("other").alias("b")).distinct())
    drop(sets)
    drop(close)
    return links


def region_links(arrays: list, labels, percent: int, left=None) -> list[tuple[int, int]]:
    """Linked pairs of one region with different labels: (i, j) as places in ``arrays``.

    ``left`` marks the members of the first of two blocks: then pairs within a block are not compared.
    """
    import numpy as np

    sizes = np.array([len(a) for a in arrays])
    owner = np.repeat(np.arange(len(arrays)), sizes)
    _, column, count = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
    common = count[column] > 1
    owner, column = owner[common], (np.cumsum(count > 1) - 1)[column[common]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out: list[tuple[int, int]] = []

    def shared(rows, others):
        """Shingles that each of ``rows`` and each of ``others`` have in common."""
        total = np.zeros((len(rows), len(others)), np.float32)
        at_row, at_other = np.full(len(arrays), -1), np.full(len(arrays), -1)
        at_row[rows], at_other[others] = np.arange(len(rows)), np.arange(len(others))
        width = 1 << 13
        for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [begin, begin + width])
            own, col = owner[a:b], column[a:b] - begin
            x, y = np.zeros((len(rows), width), np.float32), np.zeros((len(others), width), np.float32)
            mine, theirs = at_row[own] >= 0, at_other[own] >= 0
            x[at_row[own[mine]], col[mine]] = 1
            y[at_other[own[theirs]], col[theirs]] = 1
            total += x @ y.T
        return total.astype(np.int64)

    def compare(core, window):
        inter = shared(core, window)
        union = sizes[core][:, None] + sizes[window][None, :] - inter
        hit = (100 * inter >= percent * union) & (labels[core][:, None] != labels[window][None, :])
        if left is not None:
            hit &= left[core][:, None] != left[window][None, :]
        i, j = np.nonzero(hit)
        out.extend(zip(np.asarray(core)[i].tolist(), np.asarray(window)[j].tolist(), strict=True))

    def join(core, window, depth: int) -> None:
        """All links from ``core`` into ``window``."""
        if len(core) <= 64 or depth > 6:
            compare(core, window)
            return
        pivots = core[:: max(1, len(core) // 8)][:8]
        everyone = np.unique(np.concatenate([core, window]))
        inter = shared(everyone, pivots)
        far = 1 - inter / (sizes[everyone][:, None] + sizes[pivots][None, :] - inter)
        place = np.full(len(arrays), -1)
        place[everyone] = np.arange(len(everyone))
        nearest = far.min(axis=1)
        region = far[place[core]].argmin(axis=1)
        reach = 2 * (1 - percent / 100) + 1e-9
        cells = [(core[region == k], window[far[place[window], k] <= nearest[place[window]] + reach]) for k in range(len(pivots))]
        if sum(len(c) * len(w) for c, w in cells) > 0.6 * len(core) * len(window):
            compare(core, window)
            return
        for c, w in cells:
            if len(c) and len(w):
                join(c, w, depth + 1)

    every = np.arange(len(arrays))
    if left is None:
        join(every, every, 0)
    else:
        join(every[left], every[~left], 0)
    return list({(min(p), max(p)) for p in out})


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", carry: str | None = None) -> DataFrame:
    """Per document: ``n_shingles`` and ``component_id``, the smallest id that it is connected with by links.

    Two sets link when 100 * shared >= percent * union.  With ``carry``, a column of ``docs`` that comes along under its name, the id's
    column is called ``row``; otherwise ``doc_id``.
    """
    spark = docs.sparkSession
    extra = None if carry is None else docs.select(F.col(id_col).cast("long").alias("row"), carry)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    described = describe(docs, width)
    sketch = merged_sketch(described.where("part is not null"))
    own = described.where("part is null").select("doc_id", "n", "node", "fp")
    full = own.where("n > 0 and doc_id is not null")
    reps = keep(full.groupBy("fp").agg(F.min("doc_id").alias("doc"), F.first("node").alias("node"), F.first("n").alias("n")))
    total = reps.agg(F.sum("n")).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / 5 * 14 / (24 << 20)))
    regions = windows(docs, sketch, width, percent, partitions)
    members = keep(regions.join(reps.select("node", "doc", "n"), "node").select("region", "doc", "n").distinct())
    heads = members.groupBy("region").agg(F.min(F.struct("doc", "n")).alias("head"), F.count("*").alias("m"))
    heads = keep(heads.where("m > 1").select("region", F.col("head.doc").alias("other"), F.col("head.n").alias("other_n"), "m"))
    counts = keep(chosen_rows(docs, members.join(heads, "region", "left_semi").select("doc").distinct(), width, counted, "binary"))

    # Round 1: each region around one of its documents.
    spokes = members.join(heads, "region").where(F.col("doc") != F.col("other")).where(sizes_fit(F.col("n"), F.col("other_n"), percent))
    links = verified(docs, spokes.select("doc", "other").distinct(), counts, width, percent)
    labels = components(links)
    made = [reps, members, heads, counts, links, labels]

    # Round 2: what is still apart in regions of three and more.
    several = members.join(heads.where("m > 2").select("region", "m"), "region")
    apart = several.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select("region", "m", "doc", "n", F.coalesce("label", "doc").alias("label"))
    apart = apart_ = keep(apart)
    state = apart.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    state = keep(state.where("lo < hi").select("region"))
    apart = apart.join(state, "region")
    few = apart.where(F.col("m") <= FEW).select("region", "doc", "n", "label")
    x, y = few.alias("x"), few.alias("y")
    differ = (F.col("x.region") == F.col("y.region")) & (F.col("x.doc") > F.col("y.doc")) & (F.col("x.label") != F.col("y.label"))
    crossing = x.join(y, differ & sizes_fit(F.col("x.n"), F.col("y.n"), percent)).select(F.col("x.doc").alias("doc"), F.col("y.doc").alias("other")).distinct()
    made.append(verified(docs, crossing, counts, width, percent))
    links = links.unionByName(made[-1])

    # In larger ones the members of the most frequent class need no comparison with each other: those of all other classes are
    # dealt in blocks that meet everyone, those of that class in blocks that meet only the others.  Classes are those of all links so far.
    joined = components(links)
    large = apart.where(F.col("m") > FEW).select("region", "doc", "n").join(joined.withColumnRenamed("node", "doc"), "doc", "left")
    large = keep(large.select("region", "doc", "n", F.coalesce("label", "doc").alias("label")))
    sizes = large.groupBy("region", "label").agg(F.count("*").alias("docs"), F.sum("n").alias("all_n"))
    whole = sizes.groupBy("region").agg(F.max_by("label", F.struct("docs", "label")).alias("major"), F.max(F.struct("docs", "label", "all_n")).alias("top"), F.sum("docs").alias("docs"), F.sum("all_n").alias("all_n"))
    blocks = lambda docs, shingles: F.greatest(F.ceil(docs / BLOCK_DOCS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int")
    whole = whole.where(F.col("docs") > F.col("top.docs")).select(
        "region", "major", blocks(F.col("docs") - F.col("top.docs"), F.col("all_n") - F.col("top.all_n")).alias("others"), blocks(F.col("top.docs"), F.col("top.all_n")).alias("own")
    )
    many = large.join(whole, "region")
    alike = F.col("label") == F.col("major")
    block = F.when(alike, F.col("others") + F.pmod(F.xxhash64("doc"), "own")).otherwise(F.pmod(F.xxhash64("doc"), "others")).cast("int")
    meets = F.sequence(F.lit(0), F.when(alike, F.col("others") - 1).otherwise(F.col("others") + F.col("own") - 1))
    many = many.withColumn("block", block).withColumn("with", F.explode(meets))
    many = keep(many.select("region", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), (F.col("block") <= F.col("with")).alias("left"), "doc", "label"))

    def join(table: pa.Table) -> pa.Table:
        import numpy as np

        docs, labels = table.column("doc").to_numpy(), table.column("label").to_numpy()
        arrays = [unpacked(raw) for raw in table.column("value").to_pylist()]
        left = table.column("left").to_numpy(zero_copy_only=False) if table.column("i")[0] != table.column("j")[0] else None
        found = region_links(arrays, labels, percent, left)
        return pa.table({"a": pa.array(np.array([docs[i] for i, _ in found], np.int64)), "b": pa.array(np.array([docs[j] for _, j in found], np.int64))})

    sets = keep(chosen_rows(docs, many.select("doc").distinct(), width, packed, "binary"))
    more = many.join(sets, "doc").groupBy("region", "i", "j").applyInArrow(join, "a long, b long")
    made += [keep(more.distinct()), sets, many, large, apart_, state]
    drop(joined)
    links = links.unionByName(made[-6])
    labels = components(links)
    made.append(labels)
    named = reps.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select("fp", F.coalesce("label", "doc").alias("component_id"))
    named = keep(named)
    drop(*made)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    found = own.join(named, "fp", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return found if extra is None else found.withColumnRenamed("doc_id", "row").join(extra, "row")

"""SentencePiece encoding and decoding with a max-plus scan over giant documents.

A document of up to ``giant_chars`` characters is encoded by its task.  A longer one is dealt
out in chunks.  A chunk's boundary state is how far a piece that began in the chunk before
reaches into it (0 up to the longest piece less one); the chunk yields the matrix of best scores
from each state at its left end to each state at its right end.  Max-plus products of these
matrices are associative: they are multiplied up a tree of ``fan`` matrices a node, and vectors of scores come back
down it, so that each chunk gets its exact scores at the left end and no task sees more than ``fan`` chunks of a document.
With them every chunk finds, by itself, the best path into each right state and the left state
that it comes from; following the left states from the document's end
picks one path of each chunk.  The result is that of one Viterbi pass over the document,
ties included.

No piece crosses certain positions (a space after another character, line breaks).  What a chunk holds between the first and
the last of them is the same on every path: it is encoded once, and only the ends are traced again.

Texts are whole documents.  Null and empty texts have no ids and decode to an empty text; a
null id stays null and repeated rows are encoded once each; other columns are ignored.
Round trips are exact unless a text holds U+2581, which decodes to a space.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from namewright.llm import unigram
from namewright.llm.batches import slices
from namewright.llm.storage import drop, keep
from namewright.llm.unigram import LOW, SPACE, Unigram

SCHEMA = "doc_id long, ids binary, score long"
#: Text or ids worked on at a time; segments of a text take about twenty times as much.
PART_BYTES = 2 << 20


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def safe_cuts(text: str, n: int, model: Unigram) -> tuple[int, int] | None:
    """The first and last position in [longest - 1, n] that no piece crosses, if there are any."""
    if not model.splits:
        return None

    def safe(i: int) -> bool:
        return text[i - 1] == "\n" or text[i] == "\n" or (text[i] == SPACE and text[i - 1] != SPACE)

    lo = max(1, model.longest - 1)
    first = next((i for i in range(lo, min(n, len(text) - 1) + 1) if safe(i)), None)
    if first is None:
        return None
    last = next(i for i in range(min(n, len(text) - 1), first - 1, -1) if safe(i))
    return first, last


def ends(best: list[int], n: int, size: int) -> list[int]:
    """Scores of the ``size`` states at position n: a piece that ends there or beyond."""
    out = best[n : n + size]
    return out + [LOW] * (size - len(out))


def transfer(text: str, n: int, model: Unigram, middle: int | None = None) -> np.ndarray:
    """Best score from each left state to each right state of the chunk ``text[:n]``; the rest of text is what follows it.

    ``middle`` is the score between the chunk's first and last safe cut, if it is known already.
    """
    size = model.longest

    def from_state(s: int, text: str, n: int) -> list[int]:
        # A state past the chunk's end stays past the end of the next one's begin.
        return model.forward(text, [LOW] * s + [0], n)[0] if s <= len(text) else [LOW]

    cuts = safe_cuts(text, n, model)
    if cuts is None:
        return np.array([ends(from_state(s, text, n), n, size) for s in range(size)], np.int64)
    a, b = cuts
    right = np.array(ends(from_state(0, text[b:], n - b), n - b, size), np.int64)
    left = np.array(model.backward(text[:a])[:size], np.int64)  # the cut is not before the last state
    score = model.encode(text[a:b])[0] if middle is None else middle
    return np.where((left[:, None] > LOW) & (right > LOW), left[:, None] + score + right, LOW)


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Max-plus product of two matrices, or of a row vector and a matrix; also of many at once.  Associative."""
    if left.ndim == right.ndim:
        right = right[..., None, :, :]
    return np.maximum((left[..., :, None] + right).max(axis=-2), LOW)


def paths(text: str, n: int, begin: list[int], final: bool, model: Unigram, middle: int | None = None) -> list[tuple[int, int, int, bytes, bytes]]:
    """For each right state that can be reached: (state, left state of the best path, its score, ids).

    The ids are those before the chunk's first safe cut and those after its last one; the second is empty where there is none.
    """
    size = range(min(model.longest, len(text) - n + 1))
    pack = lambda ids: struct.pack(f"<{len(ids)}I", *ids)
    cuts = safe_cuts(text, n, model)
    if cuts is None:
        best, last = model.forward(text, begin[: len(text) + 1], n)
        spelled = [(e, best[n + e], *model.spell(text, last, n + e)) for e in ([0] if final else size) if best[n + e] > LOW]
        return [(e, at, score, pack(ids), b"") for e, score, ids, at in spelled]
    a, b = cuts
    best, last = model.forward(text[:a], begin[: a + 1], a)
    ids, at = model.spell(text, last, a)
    score = best[a] + (model.encode(text[a:b])[0] if middle is None else middle)
    best, last = model.forward(text[b:], [0], n - b)
    reached = [e for e in ([0] if final else size) if best[n - b + e] > LOW]
    return [(e, at, score + best[n - b + e], pack(ids), pack(model.spell(text[b:], last, n - b + e)[0])) for e in reached]


def encode_documents(
    docs: DataFrame,
    model_path: str | None = None,
    giant_chars: int = 1 << 13,
    chunk_chars: int = 1 << 13,
    fan: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: ``ids`` (little-endian uint32) and ``score`` of the best segmentation.

    ``chunk_chars`` is at least the longest piece.
    """
    path = model_path or default_model()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    giant = F.coalesce(F.length("text") > giant_chars, F.lit(False))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram.load(path)
        for batch in slices(batches, "text", PART_BYTES):
            made = model.encode_texts([model.normal(t or "") for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([m[1] for m in made], pa.binary()), pa.array([m[0] for m in made], pa.int64())],
                ["doc_id", "ids", "score"],
            )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of giant documents, each with what may follow a piece that begins in it."""
        kinds = pa.schema([("row", pa.string()), ("doc_id", pa.int64()), ("k", pa.int32()), ("n", pa.int32()), ("final", pa.bool_()), ("part", pa.string())])
        model = unigram.load(path)
        chunk = max(chunk_chars, model.longest)
        for batch in slices(batches, "text", PART_BYTES):
            for doc, row, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text")), strict=True):
                text = model.normal(text)
                made = []
                for k, at in enumerate(range(0, len(text), chunk)):
                    n = min(chunk, len(text) - at)
                    made.append({"row": row, "doc_id": doc, "k": k, "n": n, "final": at + n == len(text), "part": text[at : at + chunk + model.longest - 1]})
                    if len(made) * chunk > PART_BYTES or made[-1]["final"]:
                        yield pa.RecordBatch.from_pylist(made, kinds)
                        made = []

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each chunk's matrix, the ids and score between its safe cuts, and the text at its ends."""
        model = unigram.load(path)
        for batch in slices(batches, "part", PART_BYTES):
            texts, sizes = batch.column("part").to_pylist(), batch.column("n").to_pylist()
            cuts = [safe_cuts(t, n, model) for t, n in zip(texts, sizes, strict=True)]
            middle = model.encode_texts([t[c[0] : c[1]] if c else "" for t, c in zip(texts, cuts, strict=True)])
            made = [transfer(t, n, model, m[0]).tobytes() for t, n, m in zip(texts, sizes, middle, strict=True)]
            # What lies between the cuts is not needed again: a line break stands for it, at which the ends are cut alike.
            outer = [t if c is None else t[: c[0]] + ("\n" if c[1] > c[0] else "") + t[c[1] :] for t, c in zip(texts, cuts, strict=True)]
            rest = [n if c is None else n - (c[1] - c[0]) + (c[1] > c[0]) for n, c in zip(sizes, cuts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "doc_id", "k", "final")), pa.array(outer, pa.string()), pa.array(rest, pa.int32()),
                    pa.array([m[0] for m in middle], pa.int64()), pa.array([m[1] for m in middle], pa.binary()), pa.array(made, pa.binary()),
                ],
                ["row", "doc_id", "k", "final", "ends", "n", "middle", "ids", "matrix"],
            )

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram.load(path)
        kind = pa.list_(pa.struct([("to", pa.int32()), ("from", pa.int32()), ("score", pa.int64()), ("before", pa.binary()), ("after", pa.binary())]))
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("ends", "n", "begin", "final", "middle")]
            found = [paths(t, n, np.frombuffer(b, np.int64).tolist(), f, model, m) for t, n, b, f, m in zip(*cols, strict=True)]
            made = [[dict(zip(("to", "from", "score", "before", "after"), p, strict=True)) for p in f] for f in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "k")), pa.array(made, kind)], ["row", "k", "paths"])

    def join(payload: pa.Table, traced: pa.Table) -> pa.Table:
        """The ids of each document: in each chunk the path into the state that the chunk behind it comes from."""
        order = [("row", "ascending"), ("k", "descending")]
        payload, traced = payload.sort_by(order), traced.sort_by(order)
        docs, ids, scores, before = [], [], [], None
        state, parts = 0, []
        columns = (payload.column("row").to_pylist(), payload.column("doc_id").to_pylist(), traced.column("paths").to_pylist(), payload.column("ids").to_pylist())
        for row, doc, made, middle in zip(*columns, strict=True):
            if row != before:
                if before is not None:
                    ids.append(b"".join(reversed(parts)))
                docs.append(doc)
                before, state, parts = row, 0, []
            chosen = next(p for p in made if p["to"] == state)
            if not parts:
                scores.append(chosen["score"])
            parts += [chosen["after"], middle, chosen["before"]]
            state = chosen["from"]
        ids += [b"".join(reversed(parts))] if docs else []
        return pa.table({"doc_id": pa.array(docs, pa.int64()), "ids": pa.array(ids, pa.binary()), "score": pa.array(scores, pa.int64())})

    chunks = (
        rows.where(giant)
        .withColumn("row", F.struct(F.xxhash64("doc_id", "text"), F.monotonically_increasing_id()).cast("string"))
        .mapInArrow(deal, "row string, doc_id long, k int, n int, final boolean, part string")
        .repartition(F.col("row"), F.col("k"))
    )
    chunks = keep(chunks.mapInArrow(summarise, "row string, doc_id long, k int, final boolean, ends string, n int, middle long, ids binary, matrix binary"))
    most, n = chunks.agg(F.max("k"), F.count("*")).first()
    begins = scan(chunks.select("row", "k", "matrix"), fan, most or 0, n)
    traced = chunks.join(begins, ["row", "k"]).select("row", "k", "ends", "n", "final", "middle", "begin")
    traced = traced.mapInArrow(trace, "row string, k int, paths array<struct<to:int,from:int,score:long,before:binary,after:binary>>")
    # Some documents at a time: a group holds about as many chunks whatever the table, or one document.
    group = F.pmod(F.xxhash64("row"), F.lit(max(1, n // 256)))
    giants = chunks.select("row", "doc_id", "k", "ids").groupBy(group).cogroup(traced.groupBy(group)).applyInArrow(join, SCHEMA)
    return rows.where(~giant).mapInArrow(whole, SCHEMA).unionByName(giants)


def scan(matrices: DataFrame, fan: int, most: int, n: int, nodes: int = 1024) -> DataFrame:
    """(row, k, begin): the scores of all states before matrix k of a row, a prefix of the max-plus product.

    Up a tree, each node multiplies ``fan`` matrices; down it, each hands its own prefix on, vector by matrix.  ``most`` is the largest
    k, ``n`` the number of matrices; a task works on about ``nodes`` nodes at a time, all of them at once.
    """

    def of_nodes(table: pa.Table):
        """The table by node, its matrices, and where its nodes begin and how many rows they have."""
        table = table.sort_by([("row", "ascending"), ("k", "ascending")])
        code = table.column("row").combine_chunks().dictionary_encode().indices.to_numpy()
        node = table.column("k").to_numpy() // fan
        flat = np.frombuffer(b"".join(table.column("matrix").to_pylist()), np.int64)
        size = math.isqrt(len(flat) // len(code))
        first = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (node[1:] != node[:-1])))
        return table, flat.reshape(-1, size, size), first, np.diff(np.append(first, len(code)))

    def up(table: pa.Table) -> pa.Table:
        table, matrix, first, count = of_nodes(table)
        made = matrix[first]
        for p in range(1, fan):
            more = np.flatnonzero(count > p)
            for part in np.array_split(more, 1 + len(more) // 256):
                made[part] = product(made[part], matrix[first[part] + p])
        k = table.column("k").to_numpy()[first] // fan
        return pa.table({"row": table.column("row").take(pa.array(first)), "k": pa.array(k, pa.int32()), "matrix": pa.array([m.tobytes() for m in made], pa.binary())})

    def down(table: pa.Table) -> pa.Table:
        table, matrix, first, count = of_nodes(table)
        begins = np.full(matrix.shape[:2], LOW)
        begins[first, 0] = 0
        given = table.column("start").combine_chunks()
        if given.null_count == 0:
            begins[first] = np.frombuffer(b"".join(given.take(pa.array(first)).to_pylist()), np.int64).reshape(len(first), -1)
        for p in range(1, fan):
            at = first[count > p] + p
            begins[at] = product(begins[at - 1], matrix[at - 1])
        return pa.table({"row": table.column("row"), "k": table.column("k"), "begin": pa.array([b.tobytes() for b in begins], pa.binary())})

    node = F.floor(F.col("k") / fan).cast("int")
    group = F.pmod(F.xxhash64("row", node), F.lit(max(1, n // (fan * nodes))))
    levels = [matrices]
    while fan ** len(levels) <= most:
        levels.append(keep(levels[-1].groupBy(group).applyInArrow(up, "row string, k int, matrix binary")))
    begins = None
    for level in reversed(levels):
        if begins is None:
            started = level.select("row", "k", "matrix", F.lit(None).cast("binary").alias("start"))
        else:
            started = level.withColumn("node", node).join(begins.select("row", F.col("k").alias("node"), F.col("begin").alias("start")), ["row", "node"]).select("row", "k", "matrix", "start")
        begins = started.groupBy(group).applyInArrow(down, "row string, k int, begin binary")
    kept = keep(begins)
    drop(*levels[1:])
    return kept


def path_score(ids: bytes, model: Unigram) -> int:
    """The score of a sequence of ids: each spelled character counts once."""
    total, pending = 0, 0
    spelled = {v: k for k, v in model.byte.items()}
    for (i,) in struct.iter_unpack("<I", ids):
        if i not in spelled:
            total += model.score[model.names[i]]
        elif pending == 0:
            lead = spelled[i]
            pending = (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            total += model.unknown
        else:
            pending -= 1
    return total


def decode_ids(encoded: DataFrame, model_path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``, the text that the ids spell."""
    path = model_path or default_model()
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram.load(path)
        spell = [n.replace(SPACE, " ").encode() for n in model.names]
        for b, i in model.byte.items():
            spell[i] = bytes([b])
        for batch in slices(batches, ids_col, PART_BYTES):
            texts = []
            for raw in batch.column(ids_col).to_pylist():
                text = b"".join([spell[i] for i in np.frombuffer(raw or b"", "<u4").tolist()]).decode("utf-8", "replace")
                texts.append(text[1:] if text[:1] == " " else text)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return encoded.mapInArrow(work, schema)

"""Harmonic packing of tokenised documents into fixed-capacity sequences.

A piece of length L belongs to class ``k = capacity // L`` and a bin of class k takes
exactly k pieces, so it never needs to look at other bins: every task fills its own
bins in one narrow pass without a shuffle.  Documents are cut before that: whole
sequences first, then powers of two down to ``smallest_cut``; pieces of a power of two
fill their class's bins completely, and only tails shorter than ``smallest_cut`` leave
a gap (below ``smallest_cut / capacity`` of a bin).  What remains in open bins when a
task ends is laid end to end and cut into powers of two, so that it needs no padding.

Rules for special input: a null or empty text is the end token alone; a null id
stays null; repeated rows are packed once each; an empty table gives no rows; other
columns of ``docs`` are ignored.  Long documents are cut, never truncated.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.batches import slices

SCHEMA = "doc_id long, start long, ids binary, length long, doc_tokens long, sequence_id long, offset long, padded_to long"
#: Text that the tokenizer file maps to a special id.
SPECIAL = "<|endoftext|>"


def default_tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_encoder(json_path: str, ranks_path: str | None):
    """Text -> ids of the ``tokenizers`` file.

    With ``ranks_path`` (the same vocabulary as merge ranks) ordinary texts go through
    tiktoken, which gives the same ids three to four times faster; texts that hold a special
    token's string always go through ``tokenizers`` itself.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(json_path)

    def plain(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    if ranks_path is None:
        return plain
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: plain(text) if SPECIAL in text else fast.encode_ordinary(text)


def cut_lengths(n: int, capacity: int, smallest_cut: int) -> list[int]:
    """Piece lengths of a document of n tokens, in order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    size = capacity
    while rest >= smallest_cut:
        while size > rest:
            size //= 2
        out.append(size)
        rest -= size
    return out + [rest] * (rest > 0)


class HarmonicBins:
    """Open bins by class; ``add`` returns a full bin, ``rest`` the sequences left at the end."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: dict[int, list] = {}

    def add(self, piece: tuple):
        """piece: (doc_id, start, ids, doc_tokens)."""
        k = self.capacity // len(piece[2])
        bin_ = self.open.setdefault(k, [])
        bin_.append(piece)
        if len(bin_) == k:
            return self.open.pop(k)
        return None

    def rest(self) -> Iterator[list]:
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        total = sum(len(p[2]) for p in left)
        room, sequence = 0, []
        for doc, start, ids, n in left:
            while len(ids):
                if room == 0:
                    if sequence:
                        yield sequence
                    sequence = []
                    room = self.capacity if total >= self.capacity else 1 << (total.bit_length() - 1)
                    total -= room
                take = min(room, len(ids))
                sequence.append((doc, start, ids[:take], n))
                ids, start, room = ids[take:], start + take, room - take
        if sequence:
            yield sequence


def pack_documents(
    docs: DataFrame,
    capacity: int = 2048,
    end_id: int = 1,
    smallest_cut: int = 128,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: tuple[str, str | None] | None = None,
) -> DataFrame:
    """One row per piece: its document, place there, ids (little-endian uint32) and place in a sequence.

    ``capacity`` is a power of two.  A sequence of fewer than ``capacity`` ids is padded to ``padded_to``.
    Sequence ids are unique over all tasks and the same when a task runs again.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    json_path, ranks_path = tokenizer or default_tokenizer()
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        encode = token_encoder(json_path, ranks_path)
        bins = HarmonicBins(capacity)
        sequence_id = TaskContext.get().partitionId() << 40
        rows: list[list] = [[] for _ in names]
        kinds = [pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]

        def put(sequence: list) -> None:
            nonlocal sequence_id
            offset = 0
            total = sum(len(p[2]) for p in sequence)
            padded = total if total & (total - 1) == 0 else capacity
            for doc, start, ids, n in sequence:
                for column, value in zip(rows, (doc, start, ids.tobytes(), len(ids), n, sequence_id, offset, padded), strict=True):
                    column.append(value)
                offset += len(ids)
            sequence_id += 1

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names)
            for c in rows:
                c.clear()
            return out

        for batch in slices(batches, "text", 4 << 20):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.asarray([*encode(text or ""), end_id], "<u4")
                start = 0
                for n in cut_lengths(len(ids), capacity, smallest_cut):
                    if full := bins.add((doc, start, ids[start : start + n], len(ids))):
                        put(full)
                    start += n
            if rows[0]:
                yield flush()
        for sequence in bins.rest():
            put(sequence)
        if rows[0]:
            yield flush()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, SCHEMA)

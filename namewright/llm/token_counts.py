"""Token counts by a count-only Viterbi pass over a unigram vocabulary.

An Aho-Corasick automaton of the pieces lists every match of a text in one pass; the dynamic
program keeps only the best score and the number of ids at each position.  Ties follow the
tokenizer (see :mod:`namewright.llm.unigram`): of equal scores the longest last piece wins, so
the count is that of the ids the encoder gives.

Null and empty texts have 0 tokens and score 0; a null id stays null; repeated rows are counted
once each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm import unigram
from namewright.llm.batches import slices
from namewright.llm.sentencepiece_scan import default_model
from namewright.llm.unigram import LOW, MEMO, MEMO_CHARS, Unigram


def piece_automaton(model: Unigram):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for piece, score in model.score.items():
        automaton.add_word(piece, (len(piece), score))
    automaton.make_automaton()
    return automaton


def count_segment(segment: str, automaton, unknown: int) -> tuple[int, int]:
    """Best score of a text and the number of ids of the path that the tie rule picks."""
    n = len(segment)
    best, count = [0] + [LOW] * n, [0] * (n + 1)
    matches: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for last, match in automaton.iter(segment):
        matches[last].append(match)
    for end in range(1, n + 1):
        found = matches[end - 1]
        # Longest first: a later, shorter piece has to be better.
        found.sort(reverse=True)
        top, ids = LOW, 0
        for width, score in found:
            if best[end - width] + score > top:
                top, ids = best[end - width] + score, count[end - width] + 1
        if not found or found[-1][0] != 1:
            if best[end - 1] + unknown > top:
                top, ids = best[end - 1] + unknown, count[end - 1] + len(segment[end - 1].encode())
        best[end], count[end] = top, ids
    return best[n], count[n]


def count_tokens(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``n_tokens`` and ``score``."""
    path = model_path or default_model()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram.load(path)
        automaton = piece_automaton(model)
        memo: dict[str, tuple[int, int]] = {}
        for batch in slices(batches):
            scores, counts = [], []
            for text in batch.column("text").to_pylist():
                score = count = 0
                for segment in model.segments(model.normal(text or "")):
                    hit = memo.get(segment)
                    if hit is None:
                        hit = count_segment(segment, automaton, model.unknown)
                        if len(segment) <= MEMO_CHARS:
                            if len(memo) >= MEMO:
                                memo.clear()
                            memo[segment] = hit
                    score += hit[0]
                    count += hit[1]
                scores.append(score)
                counts.append(count)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(scores, pa.int64())], ["doc_id", "n_tokens", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_tokens long, score long")

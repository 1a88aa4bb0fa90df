"""Language identification of whole texts by a linear-chain conditional random field over words.

Every word of a text gets a language by forward-backward, with affix, character n-gram and lexicon
features and learned transitions, so code-switched texts are labelled word by word; a text's language is the one with the
largest sum of word probabilities, and its score is the mean probability of that language.

A word is a white-space token in lower case, stripped of everything but letters; tokens without letters are left out.
A text is one chain, whatever its length: its blocks are joined by messages at their borders (see
:func:`namewright.llm.crf.chain_marginals`).

Training sees documents whose language is not null, never their id or source.  Each language gives its ``per_language``
distinct texts with the smallest hashes (all, if it has fewer), so copies count once and no language is lost; that number of labelled
rows is the bound of the sample, and their texts are learned from whole.  Training chains join stretches of different
languages, from which the transitions learn switches.

Rules: a null text, or one without letters, is ``und`` with score 0; ties go to the first language in
alphabetical order; repeated rows are labelled once each; an empty table, or one without languages, gives
``und`` for every row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.batches import slices
from namewright.llm.crf import Trainer, chain_marginals, gathered, marginals, scattered

UNKNOWN = "und"
BITS = 19
#: Text bytes whose words are scored at a time; the features of their distinct words take about a hundred times as much.
PART_BYTES = 1 << 20

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def hashed(*parts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for k, p in enumerate(parts):
        out = (out ^ p.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def word_features(words: list[str], lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of each distinct word, where each word's begin, which words have letters, and word hashes."""
    points = np.frombuffer(("\n".join(words) + "\n").lower().encode("utf-32-le"), np.uint32)
    ends = points == 10
    chars = points[letter_table()[points] | ends]
    stop = np.flatnonzero(chars == 10)
    begin = np.append(0, stop[:-1] + 1)
    size = stop - begin
    # Letters of the words with a boundary (10) on both sides; position i holds the i-th character.
    full = np.append(np.uint32(10), chars)
    where = np.repeat(np.arange(len(stop)), size + 1)  # the word of each bigram (boundary or letter, then what follows)
    pair = hashed(full[:-1], full[1:], np.full(len(chars), 2))
    owner = [where]
    found = [pair]
    three = np.flatnonzero((full[1:-1] != 10))
    owner.append(where[three])
    found.append(hashed(full[three], full[three + 1], full[three + 2], np.full(len(three), 3)))
    index = np.arange(len(size))
    for k in (1, 2, 3):
        long = size >= k
        at, to = begin[long], stop[long]
        found.append(hashed(*(chars[at + i] for i in range(k)), np.full(len(at), 10 + k)))
        found.append(hashed(*(chars[to - 1 - i] for i in range(k)), np.full(len(at), 20 + k)))
        owner += [index[long]] * 2
    numbers = [(f >> np.uint64(64 - BITS)).astype(np.int64) for f in found]
    # The whole word, as a sum of mixed characters and places.
    places = np.arange(len(chars)) - np.repeat(begin, size + 1)
    whole = np.add.reduceat(hashed(chars, places, np.full(len(chars), 5)), begin) if len(begin) else np.zeros(0, np.uint64)
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)
        known = lexicon[at] == whole
        numbers.append((1 << BITS) + at[known])
        owner.append(index[known])
    owner_, number = np.concatenate(owner), np.concatenate(numbers)
    order = np.argsort(owner_, kind="stable")
    return number[order], np.searchsorted(owner_[order], np.arange(len(size) + 1)), size > 0, whole


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    change: np.ndarray
    lexicon: np.ndarray

    def emissions(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        numbers, begin, letters, _ = word_features(words, self.lexicon)
        return gathered(self.weights, numbers, begin), letters

    def probabilities(self, scores: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Label probabilities of words in order; ``owner`` is the text of each word (ascending)."""
        return chain_marginals(scores, np.flatnonzero(np.append(True, owner[1:] != owner[:-1])), self.change)

    def label_words(self, text: str) -> list[tuple[str, str, float]]:
        """(word, language, probability) of each token with letters."""
        tokens = (text or "").split()
        if not tokens or not self.languages:
            return []
        scores, letters = self.emissions(tokens)
        kept = [t for t, ok in zip(tokens, letters, strict=True) if ok]
        if not kept:
            return []
        p = self.probabilities(scores[letters], np.zeros(len(kept), np.int64))
        return [(w, self.languages[k], float(q)) for w, k, q in zip(kept, p.argmax(1), p.max(1), strict=True)]


def sample_texts(docs: DataFrame, per_language: int) -> list[tuple[str, str]]:
    """``per_language`` distinct texts of each language (all, if there are fewer), the same whatever the partitions."""
    hashed = docs.select("lang", "text", F.xxhash64("text", F.lit(11)).alias("h"))
    # Hashes alone choose: each partition keeps its smallest of a language, whose union holds the smallest of all.
    kind = pa.schema([("lang", pa.string()), ("h", pa.int64())])

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            code, values = coded.indices.to_numpy(), batch.column("h").to_numpy()
            for k, lang in enumerate(coded.dictionary.to_pylist()):
                own = np.concatenate([kept.get(lang, np.zeros(0, np.int64)), values[code == k]])
                kept[lang] = np.unique(own)[:per_language]
        for lang, own in sorted(kept.items()):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own)], schema=kind)

    found: dict[str, set[int]] = {}
    some = hashed.select("lang", "h").mapInArrow(least, "lang string, h long")
    # Again over a fixed number of tasks, so that what reaches the driver does not grow with the partitions.
    for r in some.repartition(16, "h").mapInArrow(least, "lang string, h long").collect():
        found.setdefault(r["lang"], set()).add(r["h"])
    chosen = [(lang, h) for lang, own in sorted(found.items()) for h in sorted(own)[:per_language]]
    if not chosen:
        return []
    wanted = docs.sparkSession.createDataFrame(chosen, "lang string, h long")
    # At most ``per_language`` hashes of each language.
    rows = hashed.join(F.broadcast(wanted), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.min("text").alias("text"))
    return sorted((r["lang"], r["text"]) for r in rows.collect())


def train(
    docs: DataFrame,
    per_language: int = 100,
    rounds: int = 25,
    chain_words: int = 24,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """A model from the rows of ``docs`` with a language; the caller chooses which rows may be seen."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    sample = sample_texts(rows, per_language)
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0, np.uint64))
    rng = np.random.default_rng(seed)
    # Stretches of 6 to 18 words of one text; their random order makes code-switched chains.
    stretches = []
    for lang, text in sample:
        words, at = text.split(), 0
        while at < len(words):
            size = int(rng.integers(6, 19))
            stretches.append((languages.index(lang), words[at : at + size]))
            at += size
    order = rng.permutation(len(stretches))
    if len(order) > 1:
        # Most neighbours keep their language, so that switches stay rarer than words.
        order = np.array(sorted(order.tolist(), key=lambda i: (stretches[i][0] if i % 4 else 10**6 + i)))
    tokens = [w for i in order for w in stretches[i][1]]
    labels = np.array([stretches[i][0] for i in order for _ in stretches[i][1]])
    types: dict[str, int] = {}
    code = np.array([types.setdefault(w, len(types)) for w in tokens])
    words = list(types)
    *_, letters, whole = word_features(words, np.zeros(0, np.uint64))
    keep = letters[code]
    code, labels = code[keep], labels[keep]
    uses = np.bincount(code, minlength=len(words))
    hashes, index = np.unique(whole, return_inverse=True)
    lexicon = hashes[np.bincount(index, uses, len(hashes)) >= 3]
    numbers, begin, _, _ = word_features(words, lexicon)
    size = (1 << BITS) + len(lexicon)
    trainer = Trainer(size, len(languages))
    chains = -(-len(code) // chain_words)
    slots = np.arange(chains * chain_words).reshape(chains, chain_words)
    mask = slots < len(code)
    slots = np.minimum(slots, max(0, len(code) - 1))
    truth = np.eye(len(languages))[labels]
    flat = slots[mask]
    seen = np.zeros((len(languages), len(languages)))
    pairs = mask[:, 1:]
    np.add.at(seen, (labels[slots[:, :-1][pairs]], labels[slots[:, 1:][pairs]]), 1)
    if len(code) == 0:
        rounds = 0
    for _ in range(rounds):
        scores = gathered(trainer.weights, numbers, begin)
        p, expected = marginals(scores[code][slots], mask, trainer.change)
        gap = truth[flat] - p[mask]
        by_type = np.stack([np.bincount(code[flat], gap[:, k], len(words)) for k in range(len(languages))], axis=1)
        trainer.step(scattered(by_type, numbers, begin, size), seen - expected)
    return Model(languages, trainer.weights.astype(np.float32), trainer.change.astype(np.float32), lexicon)


def identify(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_columns: tuple[str, ...] = (),
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """Per row: ``doc_id``, language and score (called ``names``), with ``keep_columns`` of the input in front."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # The text travels once, also where it is kept.
    column = text_col if text_col in keep_columns else "__text"
    text = [] if text_col in keep_columns else [F.col(text_col).alias("__text")]
    rows = docs.select(*keep_columns, F.col(id_col).cast("long").alias("__id"), *text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        model = shared.value
        for batch in slices(batches, column, PART_BYTES):
            n = batch.num_rows
            best, score = np.full(n, -1), np.zeros(n)
            lists = pc.utf8_split_whitespace(pc.fill_null(batch.column(column), ""))
            owner = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy())
            coded = pc.dictionary_encode(lists.flatten())
            words = coded.dictionary.to_pylist()
            if words and model.languages:
                scores, letters = model.emissions(words)
                code = coded.indices.to_numpy()
                kept = letters[code]
                owner, code = owner[kept], code[kept]
                if len(code):
                    p = model.probabilities(scores[code], owner)
                    texts, first, count = np.unique(owner, return_index=True, return_counts=True)
                    mean = np.add.reduceat(p.astype(np.float64), first, axis=0) / count[:, None]
                    best[texts], score[texts] = mean.argmax(1), np.clip(mean.max(1), 0, 1)
            found = [model.languages[k] if k >= 0 else UNKNOWN for k in best]
            columns = [*(batch.column(c) for c in keep_columns), batch.column("__id"), pa.array(found, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [*keep_columns, "__id", *names])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep_columns).schema) if keep_columns else ""
    out = rows.mapInArrow(work, (kinds + ", " if kinds else "") + f"__id long, `{names[0]}` string, `{names[1]}` double")
    return out.withColumnRenamed("__id", "doc_id") if "doc_id" not in keep_columns else out.drop("__id")


def held_out(id_col: str = "doc_id") -> F.Column:
    """True for documents that training must not see."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0

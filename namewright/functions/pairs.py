"""Pair features (F-1 to F-10) and deterministic decisions (D-1 to D-7)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from namewright.config import Settings
from namewright.functions.text import tokens

AUTO_SAME, FURTHER = "AUTO_SAME", "NEEDS_FURTHER_RESOLUTION"
RULES = {
    "legal_suffix_format_equivalence": "terminal_legal_suffix_formatting_only",
    "legal_suffix_addition_equivalence": "terminal_legal_suffix_addition_or_removal_only",
    "whitespace_only_equivalence": "whitespace_boundary_difference_only",
    "unique_source_truncation_equivalence": "unique_exact_source_truncation_continuation",
}
NO_RULE = "no_deterministic_equivalence"


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix, by halving the span that is still open."""
    short = F.least(F.length(a), F.length(b))
    state = F.struct(F.lit(0).alias("lo"), short.alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.ceil((s["lo"] + s["hi"]) / 2).cast("int")
        same = F.substring(a, F.lit(1), middle) == F.substring(b, F.lit(1), middle)
        return F.struct(F.when(same, middle).otherwise(s["lo"]).alias("lo"), F.when(same, s["hi"]).otherwise(middle - 1).alias("hi"))

    rounds = F.sequence(F.lit(1), F.greatest(F.ceil(F.log2(short + 1)).cast("int"), F.lit(1)) + 1)
    return F.aggregate(rounds, state, lambda s, i: F.when(s["lo"] < s["hi"], halve(s, i)).otherwise(s), lambda s: s["lo"])


def numeric_relation(a: Column, b: Column) -> Column:
    """Ordered standalone numbers of both names: none, one_sided, same or conflict."""
    numbers = lambda v: F.filter(tokens(v), lambda t: t.rlike(r"^\p{Nd}+\z"))
    x, y = numbers(a), numbers(b)
    return F.when((F.size(x) == 0) & (F.size(y) == 0), "none").when((F.size(x) == 0) | (F.size(y) == 0), "one_sided").when(x == y, "same").otherwise("conflict")


# ---- string ratios: an Arrow kernel, as Spark has no longest common subsequence ---------------------------------


#: Pairs of strings compared at a time, and the longest string whose positions fit the bits of a word.
TOGETHER, BITS = 512, 63


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & places.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts as rows, zeros behind them, and their lengths."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), int(size.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return out, size


def lcs_windows(short: list[str], long: list[str], owner: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Longest common subsequences of ``short[owner]`` and the windows ``long[owner][start : start + size]``.

    All windows walk together: bit i of a window's state stands for character i of its short text, which has at most BITS.
    """
    a, n = codes(short)
    b, _ = codes(long)
    if not a.shape[1] or not b.shape[1] or not len(owner):
        return np.zeros(len(owner), np.int64)
    bit = np.uint64(1) << np.arange(a.shape[1], dtype=np.uint64)
    inside = np.arange(a.shape[1]) < n[:, None]
    hits = np.zeros(b.shape, np.uint64)  # where each character of the long text occurs in the short one
    for i in range(a.shape[1]):
        hits |= np.where((b == a[:, i : i + 1]) & inside[:, i : i + 1], bit[i], np.uint64(0))
    full = (np.uint64(1) << n[owner].astype(np.uint64)) - np.uint64(1)
    state = full.copy()
    order = np.argsort(-size, kind="stable")  # those still walking are always the first ones
    owner_, start_, state, full_ = owner[order], start[order], state[order], full[order]
    live = np.searchsorted(-size[order], -np.arange(1, int(size.max()) + 1), side="right")
    for j, k in enumerate(live.tolist()):
        now = state[:k]
        hit = now & hits[owner_[:k], start_[:k] + j]
        state[:k] = ((now + hit) | (now - hit)) & full_[:k]
    out = np.empty(len(owner), np.int64)
    out[order] = n[owner_] - np.bitwise_count(state).astype(np.int64)
    return out


def ratio_of(common: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.where(total > 0, 200.0 * common / np.maximum(total, 1), 100.0)


def ratios_of(a: list[str], b: list[str]) -> np.ndarray:
    """200 * common subsequence / both lengths of each pair of strings."""
    la, lb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    short = [x if len(x) <= len(y) else y for x, y in zip(a, b, strict=True)]
    long = [y if len(x) <= len(y) else x for x, y in zip(a, b, strict=True)]
    fits = np.flatnonzero(np.minimum(la, lb) <= BITS)
    common = np.zeros(len(a), np.int64)
    common[fits] = lcs_windows([short[i] for i in fits], [long[i] for i in fits], np.arange(len(fits)), np.zeros(len(fits), np.int64), np.maximum(la, lb)[fits])
    for i in np.flatnonzero(np.minimum(la, lb) > BITS).tolist():
        common[i] = lcs(short[i], long[i])
    return ratio_of(common, la + lb)


def token_sets(a: str, b: str) -> tuple[str, str, str, bool, bool]:
    """Shared tokens, each side's shared and own tokens, whether one side has no own token, whether one has none at all."""
    x, y = set(a.split()), set(b.split())
    both, only_x, only_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    join = lambda rest: f"{both} {rest}" if both else rest
    return both, join(only_x), join(only_y), bool(both) and (not only_x or not only_y), not x or not y


def token_set_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """The best of the ratios between shared tokens and each side's shared and own tokens."""
    made = [token_sets(x, y) for x, y in zip(a, b, strict=True)]
    shared, left, right = (np.array([len(m[k]) for m in made], float) for k in range(3))
    best = ratios_of([m[1] for m in made], [m[2] for m in made])
    for side in (left, right):
        best = np.maximum(best, np.where(shared > 0, 200.0 * shared / np.maximum(shared + side, 1), 0.0))
    return np.where([m[4] for m in made], 0.0, np.where([m[3] for m in made], 100.0, best))


def lcs_prefixes(short: list[str], long: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Longest common subsequences of each short text (at most BITS characters) and every beginning of its long one that is shorter than
    it: what a walk has found after each character.  Rows of a matrix and the lengths of the beginnings, zeros where there is none."""
    a, n = codes(short)
    b, _ = codes([t[: len(s)] for s, t in zip(short, long, strict=True)])
    width = max(a.shape[1] - 1, 0)
    found, size = np.zeros((len(short), width), np.int64), np.zeros((len(short), width), np.int64)
    bit = np.uint64(1) << np.arange(a.shape[1], dtype=np.uint64)
    inside = np.arange(a.shape[1]) < n[:, None]
    full = (np.uint64(1) << n.astype(np.uint64)) - np.uint64(1)
    state = full.copy()
    for j in range(width):
        hit = state & np.bitwise_or.reduce(np.where((a == b[:, j : j + 1]) & inside, bit, np.uint64(0)), axis=1)
        state = ((state + hit) | (state - hit)) & full
        some = j + 1 < n
        found[:, j] = np.where(some, n - np.bitwise_count(state).astype(np.int64), 0)
        size[:, j] = np.where(some, j + 1, 0)
    return found, size


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """The best ratio of the shorter text and a window of the longer one of its length, or a shorter one at an end; of equally
    long texts in both directions."""
    out = np.zeros(len(a))
    rows, short, long = [], [], []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if len(x) > len(y):
            x, y = y, x
        if not x:
            out[i] = 0.0 if y else 100.0
            continue
        for s, t in ((x, y), (y, x))[: 1 + (len(x) == len(y))]:
            if len(s) > BITS:
                out[i] = max(out[i], partial_long(s, t))
                continue
            rows.append(i)
            short.append(s)
            long.append(t)
    if not rows:
        return out
    n, m = (np.fromiter(map(len, x), np.int64, len(x)) for x in (short, long))
    at = np.array(rows)
    # Windows of full length walk on their own; all shorter ones at the beginning are passed by one walk, and all at the end by one backwards.
    count = m - n + 1
    owner = np.repeat(np.arange(len(rows)), count)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    np.maximum.at(out, at[owner], ratio_of(lcs_windows(short, long, owner, start, n[owner]), 2 * n[owner]))
    for s, t in ((short, long), ([x[::-1] for x in short], [x[::-1] for x in long])):
        common, size = lcs_prefixes(s, t)
        if size.shape[1]:
            np.maximum.at(out, at, np.where(size > 0, ratio_of(common, n[:, None] + size), 0.0).max(axis=1))
    return out


def lcs_beginnings(a: str, b: str) -> list[int]:
    """:func:`lcs` of ``a`` and each beginning of ``b`` that is shorter than ``a``, from one walk."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = state = (1 << len(a)) - 1
    out = []
    for c in b[: len(a) - 1]:
        hit = state & places.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
        out.append(len(a) - state.bit_count())
    return out


def partial_long(short: str, long: str) -> float:
    """The best window for a text of more than BITS characters and one that is no shorter."""
    n = len(short)
    ends = lcs_beginnings(short, long), lcs_beginnings(short[::-1], long[::-1])
    best = max(200.0 * lcs(short, long[k : k + n]) / (2 * n) for k in range(len(long) - n + 1))
    return max(best, *(200.0 * common / (n + k) for found in ends for k, common in enumerate(found, 1)))


def ratio(a: str, b: str) -> float:
    return float(ratios_of([a], [b])[0])


def token_set_ratio(a: str, b: str) -> float:
    return float(token_set_ratios([a], [b])[0])


def partial_ratio(a: str, b: str) -> float:
    return float(partial_ratios([a], [b])[0])


RATIOS = StructType([StructField(n, DoubleType()) for n in ("char_ratio", "token_sort_ratio", "token_set_ratio", "partial_ratio")])


@F.pandas_udf(RATIOS)
def ratios(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    made = []
    for at in range(0, len(a), TOGETHER):
        x, y = a.iloc[at : at + TOGETHER].tolist(), b.iloc[at : at + TOGETHER].tolist()
        ordered = [[" ".join(sorted(s.split())) for s in side] for side in (x, y)]
        made.append(np.stack([ratios_of(x, y), ratios_of(*ordered), token_set_ratios(x, y), partial_ratios(x, y)], axis=1))
    found = np.concatenate(made) if made else np.zeros((0, 4))
    return pd.DataFrame([[round(v, 6) for v in row] for row in found.tolist()], columns=RATIOS.names)


def features(pairs: DataFrame, with_ratios: bool = True) -> DataFrame:
    """``pairs`` with their ten features, rounded half-even to six digits."""
    a, b = F.col("name_a"), F.col("name_b")
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    six = lambda c: F.bround(c, 6)
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    out = pairs.withColumn("blocking_method_count", F.size(F.array_distinct("blocking_methods")).cast("short"))
    if with_ratios:
        out = out.withColumn("__r", ratios(a, b)).select("*", "__r.*").drop("__r")
    return out.withColumns(
        {
            "length_ratio": six(short / long),
            "common_prefix_ratio": six(common_prefix(a, b) / short),
            "token_jaccard": six(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))),
            "same_first_token": F.get(tokens(a), F.lit(0)) == F.get(tokens(b), F.lit(0)),
            "numeric_relation": numeric_relation(a, b),
        }
    )


# ---- decisions ---------------------------------------------------------------------------------------------------


def terminal_suffix(name: Column, aliases: dict[str, tuple[str, ...]]) -> Column:
    """struct(canonical, variant, base) of the first configured suffix of a strict name with a base; else null."""
    out = F.lit(None).cast("struct<canonical:string,variant:string,base:string>")
    for canonical, variants in reversed(list(aliases.items())):
        for variant in reversed(variants):
            text = " ".join(variant.upper().split())
            base = F.substring(name, F.lit(1), F.length(name) - len(text) - 1)
            found = F.struct(F.lit(canonical.upper()).alias("canonical"), F.lit(text).alias("variant"), base.alias("base"))
            out = F.when(name.endswith(" " + text) & (F.length(name) > len(text) + 1), found).otherwise(out)
    return out


def truncation_side(a: Column, b: Column, cut_a: Column, cut_b: Column, relation: Column, lengths: tuple[int, ...]) -> Column:
    """'a' or 'b' if that name is the other's exact beginning, cut at a source boundary; else null."""
    usable = relation.isin("none", "same") & (F.length(a) != F.length(b))
    is_cut = lambda s, t, flag: (F.length(s) < F.length(t)) & flag & F.length(s).isin(*lengths) & t.startswith(s)
    return F.when(usable & is_cut(a, b, cut_a), "a").when(usable & is_cut(b, a, cut_b), "b")


def decide(pairs: DataFrame, keys: DataFrame, settings: Settings) -> DataFrame:
    """Status, rule, evidence and all supporting rules of each pair; a pair that no rule supports is left open.

    A truncated key's continuation counts as unique only among the pairs at hand.
    """
    flags = keys.select("resolution_key", "possible_truncation")
    for side in "ab":
        named = flags.select(F.col("resolution_key").alias(f"key_{side}"), F.col("possible_truncation").alias(f"__cut_{side}"))
        pairs = pairs.join(named, f"key_{side}")
    a, b, relation = F.col("name_a"), F.col("name_b"), F.col("numeric_relation")
    aliases = settings.normalization.corporate_suffix_aliases
    lengths = settings.normalization.possible_truncation_content_lengths
    pairs = pairs.withColumns(
        {
            "__a": terminal_suffix(a, aliases),
            "__b": terminal_suffix(b, aliases),
            "__side": truncation_side(a, b, F.col("__cut_a"), F.col("__cut_b"), relation, lengths),
        }
    )
    shorter = F.when(F.col("__side") == "a", F.col("key_a")).when(F.col("__side") == "b", F.col("key_b"))
    # Pairs without a truncation get groups of their own: a common null group would be one task.
    group = F.coalesce(shorter, F.concat_ws("\x1f", F.lit(""), "key_a", "key_b"))
    unique = F.col("__side").isNotNull() & (F.count(F.lit(1)).over(Window.partitionBy(group)) == 1)
    has_a, has_b = F.col("__a").isNotNull(), F.col("__b").isNotNull()
    format_only = has_a & has_b & (F.col("__a.canonical") == F.col("__b.canonical")) & (F.col("__a.base") == F.col("__b.base")) & (F.col("__a.variant") != F.col("__b.variant"))
    added = (has_a & ~has_b & (F.col("__a.base") == b)) | (has_b & ~has_a & (F.col("__b.base") == a))
    compact_a, compact_b = F.replace(a, F.lit(" "), F.lit("")), F.replace(b, F.lit(" "), F.lit(""))
    spaces = (a != b) & (compact_a == compact_b) & (F.length(compact_a) >= settings.minimum_whitespace_compact_length) & relation.isin("none", "same")
    holds = (format_only, added, spaces, unique)
    rules = F.array_compact(F.array(*(F.when(F.coalesce(h, F.lit(False)), r) for h, r in zip(holds, RULES, strict=True))))
    pairs = pairs.withColumn("supporting_rules", rules)
    rule = F.get("supporting_rules", F.lit(0))
    evidence = F.lit(NO_RULE)
    for name, text in RULES.items():
        evidence = F.when(rule == name, text).otherwise(evidence)
    out = pairs.withColumns(
        {"decision_status": F.when(rule.isNotNull(), AUTO_SAME).otherwise(FURTHER), "decision_rule": F.coalesce(rule, F.lit(NO_RULE)), "decision_evidence": evidence}
    )
    return out.drop(*(c for c in out.columns if c.startswith("__")))

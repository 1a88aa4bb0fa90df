"""Candidate pairs by blocking (J-4 to J-12).

Block limits are part of the semantics: the members of a block are counted before it is joined with itself, so
a common value never expands.  Pairs come out as key_a < key_b with the methods that found them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.config import GENERIC_TOKENS, Candidates
from namewright.functions.text import tokens
from namewright.functions.typing import words
from namewright.operators.graph import kept
from namewright.sources.shared import drop, together

METHODS = ("relaxed_key", "trailing_numeric", "truncation_prefix", "informative_token", "prefix_signature", "typo_token", "typo_context")


def informative(config: Candidates, minimum: int, digits: bool) -> Column:
    """Distinct tokens of a key that are long enough and not generic."""
    keep = lambda t: (F.length(t) >= minimum) & ~F.array_contains(words(GENERIC_TOKENS), t) & (F.lit(digits) | ~t.rlike(r"^\p{Nd}+\z"))
    return F.filter(F.array_distinct(tokens(F.col("resolution_key"))), keep)


def ordered(pairs: DataFrame, x: str, y: str, method: str) -> DataFrame:
    return pairs.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("key_a"), F.greatest(x, y).alias("key_b"), F.lit(method).alias("method"))


def bounded(members: DataFrame, limit: int, most: str = "block") -> DataFrame:
    """Members (block, key) of blocks of 2 to ``limit`` keys; the sizes are grouped, then joined back."""
    sizes = members.groupBy(most).agg(F.count("*").alias("size")).where(F.col("size").between(2, limit))
    return members.join(sizes, most)


def within_blocks(members: DataFrame, limit: int, method: str) -> DataFrame:
    """All pairs of each block of at most ``limit`` keys."""
    block = bounded(members.select("block", F.col("resolution_key").alias("key")), limit).select("block", "key")
    pairs = block.alias("x").join(block.alias("y"), (F.col("x.block") == F.col("y.block")) & (F.col("x.key") < F.col("y.key")))
    return pairs.select(F.col("x.key").alias("key_a"), F.col("y.key").alias("key_b"), F.lit(method).alias("method"))


def relaxed_pairs(keys: DataFrame, config: Candidates) -> DataFrame:
    return within_blocks(keys.where("relaxed_key is not null").withColumn("block", F.col("relaxed_key")), config.maximum_block_size, "relaxed_key")


def trailing_pairs(keys: DataFrame, config: Candidates) -> DataFrame:
    targets = keys.select(F.col("resolution_key").alias("trailing_numeric_candidate"), F.col("resolution_key").alias("target"))
    return ordered(keys.join(targets, "trailing_numeric_candidate"), "resolution_key", "target", "trailing_numeric")


def truncation_pairs(keys: DataFrame, config: Candidates) -> DataFrame:
    size = config.minimum_truncation_prefix_length
    universe = keys.where(F.length("resolution_key") >= size).select(F.substring("resolution_key", 1, size).alias("block"), F.col("resolution_key").alias("key"), "possible_truncation")
    inside = bounded(universe, config.maximum_block_size).select("block", "key", "possible_truncation")
    asked = inside.where("possible_truncation").select("block", F.col("key").alias("query"))
    return ordered(asked.join(inside, "block"), "query", "key", "truncation_prefix")


def token_members(keys: DataFrame, config: Candidates) -> DataFrame:
    """(block, resolution_key): each informative token of each key; digits count."""
    return keys.select("resolution_key", F.explode(informative(config, config.minimum_informative_token_length, True)).alias("block"))


def token_pairs(keys: DataFrame, config: Candidates) -> DataFrame:
    return within_blocks(token_members(keys, config), min(config.maximum_token_frequency, config.maximum_block_size), "informative_token")


def prefix_pairs(keys: DataFrame, config: Candidates) -> DataFrame:
    size = config.prefix_signature_length
    signature = F.substring(F.regexp_replace("resolution_key", "[^A-Z0-9]+", ""), 1, size)
    return within_blocks(keys.withColumn("block", signature).where(F.length("block") == size), config.maximum_block_size, "prefix_signature")


def signatures(token: Column) -> Column:
    """The token and each of its one-character deletions."""
    places = F.sequence(F.lit(1), F.length(token))
    cut = F.transform(places, lambda i: F.concat(F.substring(token, F.lit(1), i - 1), F.substring(token, i + 1, F.length(token))))
    return F.array_distinct(F.concat(F.array(token), cut))


def without_pairs(keys: DataFrame, pairs: DataFrame) -> DataFrame:
    used = pairs.select(F.explode(F.array("key_a", "key_b")).alias("resolution_key")).distinct()
    return keys.join(used, "resolution_key", "left_anti")


def typo_members(keys: DataFrame, config: Candidates) -> DataFrame:
    """(block, key): deletion signatures held by few keys."""
    minimum = max(config.minimum_typo_token_length, config.minimum_informative_token_length)
    marks = keys.select("resolution_key", F.explode(informative(config, minimum, False)).alias("token"))
    marks = marks.select("resolution_key", F.explode(signatures(F.col("token"))).alias("block")).distinct()
    return bounded(marks.select("block", F.col("resolution_key").alias("key")), config.maximum_typo_signature_frequency).select("block", "key")


def typo_pairs(keys: DataFrame, pairs: DataFrame, config: Candidates, narrow: DataFrame | None = None) -> DataFrame:
    """For keys without a pair: keys that share a deletion signature held by few keys.  ``narrow``: :func:`typo_members`, if at hand."""
    narrow = typo_members(keys, config) if narrow is None else narrow
    asked = narrow.join(without_pairs(keys, pairs).select(F.col("resolution_key").alias("key")), "key", "left_semi").select("block", F.col("key").alias("query"))
    return ordered(asked.join(narrow, "block"), "query", "key", "typo_token").distinct()


def context_pairs(keys: DataFrame, pairs: DataFrame, config: Candidates) -> DataFrame:
    """For keys still without a pair: keys that share an exact context token and nearly share another one."""
    toks = keys.select("resolution_key", informative(config, config.minimum_informative_token_length, False).alias("tokens"))
    # The pool of a context token counts its keys; tokens of digits are no context.
    sizes = toks.select(F.explode("tokens").alias("context")).groupBy("context").agg(F.count("*").alias("size")).where(F.col("size") <= config.maximum_typo_context_frequency)
    zero = without_pairs(keys, pairs).select("resolution_key")
    asked = toks.join(zero, "resolution_key", "left_semi").select(F.col("resolution_key").alias("query"), "tokens", F.explode("tokens").alias("context")).join(sizes, "context")
    # Only contexts that are asked for are indexed.
    pool = toks.select("resolution_key", "tokens", F.explode("tokens").alias("context")).join(asked.select("context").distinct(), "context", "left_semi")

    def marked(df: DataFrame, key: str, name: str) -> DataFrame:
        other = df.select(key, "context", F.explode("tokens").alias(name)).where(F.col(name) != F.col("context"))
        return other.select(key, "context", name, F.explode(signatures(F.col(name))).alias("mark"))

    found = marked(asked.drop("size"), "query", "qt").join(marked(pool, "resolution_key", "ct"), ["context", "mark"])
    return ordered(found.where("qt <> ct"), "query", "resolution_key", "typo_context").distinct()


def candidate_pairs(keys: DataFrame, config: Candidates) -> DataFrame:
    """Pairs of all blockers with their methods in fixed order."""
    found = relaxed_pairs(keys, config)
    for more in (trailing_pairs, truncation_pairs, token_pairs, prefix_pairs):
        found = found.unionByName(more(keys, config))
    # The fallbacks look at what is left over: each round is worked out once and written.
    found, narrow = together(keys.sparkSession, lambda: kept(found.distinct()), lambda: kept(typo_members(keys, config)))
    found = found.unionByName(kept(typo_pairs(keys, found, config, narrow)))
    drop(narrow)
    found = found.unionByName(context_pairs(keys, found, config))
    held = F.collect_set("method")
    methods = F.filter(F.array(*(F.lit(m) for m in METHODS)), lambda m: F.array_contains("held", m))
    pairs = found.groupBy("key_a", "key_b").agg(held.alias("held"))
    return pairs.select("key_a", "key_b", F.col("key_a").alias("name_a"), F.col("key_b").alias("name_b"), methods.alias("blocking_methods"))

"""Orthographic, structural, rarity and combined evidence of candidate pairs (O-*, R-*, V-*, M-*).

Everything is a projection over the two names, apart from the token supports and the context variants, which are
grouped from the employer universe and joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.config import GENERIC_TOKENS, Settings
from namewright.functions.pairs import truncation_side
from namewright.functions.text import tokens
from namewright.functions.typing import words
from namewright.operators.graph import kept
from namewright.sources.shared import together

ALPHA = r"^\p{L}+\z"
STRUCTURAL = (
    "EXACT_TOKEN_REORDER", "SINGLE_TOKEN_ADDITION_REMOVAL", "MULTI_TOKEN_ADDITION_REMOVAL", "EXACT_TOKEN_CONTAINMENT_NONALIGNED",
    "POSSIBLE_TRUNCATION_RELATIONSHIP",
)
LOCALIZED = (
    "edit_distance_not_one", "short_typo_token", "terminal_edit_requires_further_resolution", "no_exact_informative_context",
    "no_distinctive_exact_context", "multi_variant_context", "both_differing_tokens_established",
)


def legal_suffixes(settings: Settings) -> list[tuple[str, ...]]:
    """Every spelling of a suffix, longest first, then in order."""
    aliases = settings.normalization.corporate_suffix_aliases
    return sorted({tuple(v.upper().split()) for k, vs in aliases.items() for v in (k, *vs) if v.strip()}, key=lambda t: (-len(t), t))


def legal_tokens(settings: Settings) -> tuple[str, ...]:
    return tuple(sorted({t for s in legal_suffixes(settings) for t in s}))


def core_tokens(name: Column, settings: Settings) -> Column:
    """The name's tokens without one terminal suffix, if something is left."""
    toks = tokens(name)
    drop = F.lit(0)
    for suffix in reversed(legal_suffixes(settings)):
        ends = name.endswith(" " + " ".join(suffix)) & (F.size(toks) > len(suffix))
        drop = F.when(ends, len(suffix)).otherwise(drop)
    return F.slice(toks, F.lit(1), F.size(toks) - drop)


def with_cores(pairs: DataFrame, settings: Settings) -> DataFrame:
    return pairs.withColumns({"core_a": core_tokens(F.col("name_a"), settings), "core_b": core_tokens(F.col("name_b"), settings)})


def occurrences(array: Column, token: Column) -> Column:
    return F.size(F.filter(array, lambda t: t == token))


def shared_tokens(a: Column, b: Column) -> Column:
    """Common tokens with multiplicity, sorted."""
    return F.flatten(F.transform(F.array_sort(F.array_intersect(a, b)), lambda t: F.array_repeat(t, F.least(occurrences(a, t), occurrences(b, t)))))


def differences(a: Column, b: Column) -> Column:
    """(position, token of a, token of b) where the aligned tokens differ."""
    places = F.sequence(F.lit(0), F.least(F.size(a), F.size(b)) - 1)
    at = F.transform(places, lambda i: F.struct(i.alias("i"), F.get(a, i).alias("x"), F.get(b, i).alias("y")))
    return F.filter(F.when(F.least(F.size(a), F.size(b)) > 0, at).otherwise(F.array().cast("array<struct<i:int,x:string,y:string>>")), lambda s: s["x"] != s["y"])


def alphabetic(token: Column) -> Column:
    return token.rlike(ALPHA)


# ---- populations -------------------------------------------------------------------------------------------------


def employer_cores(keys: DataFrame, eligibility: DataFrame, settings: Settings) -> DataFrame:
    """(resolution_key, core) of the employer universe."""
    employers = eligibility.where("eligibility_status = 'EMPLOYER_CANDIDATE'").select("resolution_key")
    return keys.join(employers, "resolution_key", "left_semi").select("resolution_key", core_tokens(F.col("representative_name"), settings).alias("core"))


def token_support(cores: DataFrame) -> DataFrame:
    """(token, support): keys of the universe whose core holds the token."""
    return cores.select(F.explode(F.array_distinct("core")).alias("token")).groupBy("token").agg(F.count("*").alias("support"))


def _universe(keys: DataFrame, eligibility: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Both populations, written once: each is joined more than once."""
    cores = kept(employer_cores(keys, eligibility, settings))
    return cores, kept(token_support(cores))


def context_variants(cores: DataFrame, signatures: DataFrame) -> DataFrame:
    """(context_signature, context_variant_count): distinct tokens that fill the gap of each wanted signature."""
    gap = cores.select("core", F.posexplode("core").alias("i", "token"))
    signature = F.array_join(F.transform("core", lambda t, k: F.when(k == F.col("i"), "<DIFF>").otherwise(t)), " ")
    filled = gap.select(signature.alias("context_signature"), "token").join(signatures.select("context_signature").distinct(), "context_signature", "left_semi")
    return filled.groupBy("context_signature").agg(F.count_distinct("token").cast("int").alias("context_variant_count"))


# ---- orthographic ------------------------------------------------------------------------------------------------


def edit_kind(a: Column, b: Column) -> tuple[Column, Column]:
    """Operation and place of the one edit from token a to token b."""
    short = F.when(F.length(a) < F.length(b), a).otherwise(b)
    long = F.when(F.length(a) < F.length(b), b).otherwise(a)
    places = F.sequence(F.lit(1), F.greatest(F.length(short), F.lit(1)))
    first = F.array_min(F.filter(places, lambda i: F.substring(short, i, F.lit(1)) != F.substring(long, i, F.lit(1))))
    index = F.coalesce(first - 1, F.length(short))
    kind = F.when(F.length(a) == F.length(b), "substitution").when(F.length(a) < F.length(b), "insertion").otherwise("deletion")
    return kind, F.when(index == 0, "beginning").when(index == F.length(long) - 1, "end").otherwise("inside")


def orthographic(pairs: DataFrame, keys: DataFrame, eligibility: DataFrame, settings: Settings, universe: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Evidence of a single one-letter edit, for pairs with key, name and numeric_relation.

    ``universe``: employer cores and token support, if they are at hand.
    """
    limits = settings.candidates
    status = eligibility.select("resolution_key", (F.col("eligibility_status") == "EMPLOYER_CANDIDATE").alias("ok"))
    df = pairs
    for s in "ab":
        df = df.join(status.select(F.col("resolution_key").alias(f"key_{s}"), F.col("ok").alias(f"ok_{s}")), f"key_{s}")
    df = with_cores(df, settings).withColumn("diff", differences(F.col("core_a"), F.col("core_b")))
    x, y = F.col("diff")[0]["x"], F.col("diff")[0]["y"]
    legal, generic = words(legal_tokens(settings)), words(GENERIC_TOKENS)
    df = df.withColumns({"x": F.when(F.size("diff") == 1, F.get("diff", F.lit(0))["x"]), "y": F.when(F.size("diff") == 1, F.get("diff", F.lit(0))["y"])})
    x, y = F.col("x"), F.col("y")
    kind, place = edit_kind(x, y)
    at = F.get("diff", F.lit(0))["i"]
    context = F.filter(
        F.transform("core_a", lambda t, k: F.when(k != at, t)),
        lambda t: t.isNotNull() & alphabetic(t) & (F.length(t) >= limits.minimum_informative_token_length) & ~F.array_contains(generic, t) & ~F.array_contains(legal, t),
    )
    gates = (
        (~(F.col("ok_a") & F.col("ok_b")), "not_both_employer_candidate"),
        (~F.col("numeric_relation").isin("none", "same"), "numeric_evidence_incompatible"),
        (F.size("core_a") != F.size("core_b"), "core_token_count_mismatch"),
        (F.size("diff") == 0, "no_core_token_difference"),
        (F.size("diff") > 1, "multiple_core_token_differences"),
        (~(alphabetic(x) & alphabetic(y)), "differing_token_not_alphabetic"),
        (F.array_contains(legal, x) | F.array_contains(legal, y), "legal_designator_is_differing_token"),
        (F.array_contains(generic, x) | F.array_contains(generic, y), "generic_token_is_differing_token"),
        (F.least(F.length(x), F.length(y)) < limits.minimum_typo_token_length, "short_typo_token"),
        (F.levenshtein(x, y) != 1, "edit_distance_not_one"),
        (F.size(context) == 0, "no_exact_informative_context"),
    )
    gate = F.lit(None).cast("string")
    for condition, name in reversed(gates):
        gate = F.when(condition, name).otherwise(gate)
    signature = F.array_join(F.transform("core_a", lambda t, k: F.when(k == at, "<DIFF>").otherwise(t)), " ")
    df = df.select(*pairs.columns, "x", "y", gate.alias("gate"), context.alias("context"), kind.alias("kind"), place.alias("place"), signature.alias("context_signature"))
    # Few pairs pass the gates.  Only those are compared with the populations; all others have their answer.
    open_gates = df.withColumns({c: F.when(F.col("gate").isNull(), F.col(c)) for c in ("context", "context_signature")})
    gated, (cores, support) = together(df.sparkSession, lambda: kept(open_gates), lambda: universe or _universe(keys, eligibility, settings))
    passed = gated.where("gate is null")

    rare = passed.select("key_a", "key_b", F.explode("context").alias("token")).join(support, "token").groupBy("key_a", "key_b").agg(F.min("support").alias("rarest"))
    passed = passed.join(rare, ["key_a", "key_b"], "left").join(context_variants(cores, passed), "context_signature", "left")
    for s, token in (("a", "x"), ("b", "y")):
        passed = passed.join(support.select(F.col("token").alias(token), F.col("support").alias(f"token_support_{s}")), token, "left")
    limit = limits.maximum_token_frequency
    later = (
        (F.col("place") == "end", "terminal_edit_requires_further_resolution"),
        (F.col("rarest") > limit, "no_distinctive_exact_context"),
        (F.col("context_variant_count") >= 3, "multi_variant_context"),
        ((F.col("token_support_a") > limit) & (F.col("token_support_b") > limit), "both_differing_tokens_established"),
    )
    strong = "one_alphabetic_token_edit_distance_1_with_exact_context"
    evidence = F.lit(strong)
    for condition, name in reversed(later):
        evidence = F.when(condition, name).otherwise(evidence)
    passed = passed.select(*gated.columns, evidence.alias("evidence"), "context_variant_count", "token_support_a", "token_support_b")
    closed = gated.where("gate is not null").withColumns(
        {"evidence": F.col("gate"), "context_variant_count": F.lit(None).cast("int"), "token_support_a": F.lit(None).cast("long"), "token_support_b": F.lit(None).cast("long")}
    )
    df, found = closed.unionByName(passed), F.col("evidence")
    eligible = found != "not_both_employer_candidate"
    edited = F.col("gate").isNull() | (F.col("gate") == "no_exact_informative_context")
    shown = edited | F.col("gate").isin("differing_token_not_alphabetic", "legal_designator_is_differing_token", "generic_token_is_differing_token", "short_typo_token", "edit_distance_not_one")
    return df.select(
        *pairs.columns,
        F.when(~eligible, "NOT_ELIGIBLE_FOR_ORTHOGRAPHIC").when(found == strong, "STRONG_ORTHOGRAPHIC_EVIDENCE").otherwise("NEEDS_FURTHER_RESOLUTION").alias("orthographic_status"),
        F.when(~eligible, "not_eligible_for_orthographic").when(found == strong, "single_token_edit_equivalence").otherwise("no_orthographic_equivalence").alias("orthographic_rule"),
        found.alias("orthographic_evidence"),
        F.when(shown, F.col("x")).alias("differing_token_a"),
        F.when(shown, F.col("y")).alias("differing_token_b"),
        F.when(edited, F.col("kind")).alias("edit_operation"),
        "context_signature",
        "context_variant_count",
        "token_support_a",
        "token_support_b",
    )


# ---- structure ---------------------------------------------------------------------------------------------------


def subsequence_extras(short: Column, long: Column) -> Column:
    """Tokens of ``long`` left over when ``short`` is matched greedily in order; null if it is no proper subsequence."""
    start = F.struct(F.lit(0).alias("i"), F.array().cast("array<string>").alias("extra"))
    walked = F.aggregate(
        long,
        start,
        lambda s, t: F.when(F.get(short, s["i"]).eqNullSafe(t), F.struct((s["i"] + 1).alias("i"), s["extra"].alias("extra"))).otherwise(
            F.struct(s["i"].alias("i"), F.array_append(s["extra"], t).alias("extra"))
        ),
    )
    return F.when((F.size(short) < F.size(long)) & (walked["i"] == F.size(short)), walked["extra"])


def initialism(short: Column, long: Column, settings: Settings) -> Column:
    legal = words(legal_tokens(settings))
    real = F.filter(long, lambda t: alphabetic(t) & ~F.array_contains(legal, t))
    word = F.get(short, F.lit(0))
    return (
        (F.size(short) == 1) & (F.size(long) >= 2) & alphabetic(word) & F.length(word).between(2, 10) & (F.size(real) >= 2)
        & (word == F.array_join(F.transform(real, lambda t: F.substring(t, 1, 1)), ""))
    )


def residual(pairs: DataFrame, keys: DataFrame, settings: Settings) -> DataFrame:
    """The structural family of pairs with orthographic_evidence and numeric_relation."""
    cuts = keys.select("resolution_key", "possible_truncation")
    df = pairs
    for s in "ab":
        df = df.join(cuts.select(F.col("resolution_key").alias(f"key_{s}"), F.col("possible_truncation").alias(f"possible_truncation_{s}")), f"key_{s}")
    df = with_cores(df, settings)
    a, b = F.col("core_a"), F.col("core_b")
    contained = lambda s, t: F.forall(s, lambda v: occurrences(s, v) <= occurrences(t, v))
    df = df.withColumns(
        {
            "diff": differences(a, b),
            "shared_exact_token_count": F.size(shared_tokens(a, b)),
            "is_token_reorder": (a != b) & (F.array_sort(a) == F.array_sort(b)),
            "extras": F.coalesce(subsequence_extras(a, b), subsequence_extras(b, a)),
            "is_token_multiset_containment": contained(a, b) | contained(b, a),
            "has_initialism_pattern": initialism(a, b, settings) | initialism(b, a, settings),
            "side": truncation_side(
                F.col("name_a"), F.col("name_b"), F.col("possible_truncation_a"), F.col("possible_truncation_b"), F.col("numeric_relation"),
                settings.normalization.possible_truncation_content_lengths,
            ),
        }
    )
    df = df.withColumn("edits", F.transform("diff", lambda d: F.levenshtein(d["x"], d["y"])))
    n, extra = F.size("diff"), F.size("extras")
    most, total = F.array_max("edits"), F.aggregate("edits", F.lit(0), lambda s, v: s + v)
    equal = F.size(a) == F.size(b)
    families = (
        (F.col("numeric_relation").isin("one_sided", "conflict"), "NUMERIC_VARIATION", F.concat(F.lit("persisted_numeric_relation="), "numeric_relation")),
        (F.col("side").isNotNull(), "POSSIBLE_TRUNCATION_RELATIONSHIP", F.concat(F.lit("exact_source_boundary_prefix;truncated_side="), "side")),
        (F.col("is_token_reorder"), "EXACT_TOKEN_REORDER", F.lit("equal_token_multiset_with_different_sequence")),
        (F.col("extras").isNotNull() & (extra == 1), "SINGLE_TOKEN_ADDITION_REMOVAL", F.concat(F.lit("ordered_subsequence;additional_token="), F.get("extras", F.lit(0)))),
        (F.col("extras").isNotNull() & (extra >= 2), "MULTI_TOKEN_ADDITION_REMOVAL", F.concat(F.lit("ordered_subsequence;additional_token_count="), extra.cast("string"))),
        (F.col("is_token_multiset_containment") & ~equal, "EXACT_TOKEN_CONTAINMENT_NONALIGNED", F.lit("multiplicity_preserving_containment_without_ordered_subsequence")),
        (F.col("has_initialism_pattern"), "ACRONYM_INITIALISM_PATTERN", F.lit("single_token_equals_nonlegal_token_initials")),
        (
            equal & (n >= 2) & F.forall("diff", lambda d: alphabetic(d["x"]) & alphabetic(d["y"])) & (most <= 2),
            "MULTIPLE_SMALL_TOKEN_EDITS",
            F.format_string("aligned_differences=%d;maximum_edit_distance=%d;total_edit_distance=%d", n, most, total),
        ),
        (
            equal & (n == 1),
            "SINGLE_TOKEN_LARGER_EDIT",
            F.concat(F.lit("single_aligned_token_difference;edit_distance="), most.cast("string"), F.lit(";orthographic_evidence="), "orthographic_evidence"),
        ),
        (
            (equal & (n >= 2)) | (~equal & ((F.col("shared_exact_token_count") > 0) | F.exists("edits", lambda e: e <= 2))),
            "MIXED_STRUCTURAL_RELATIONSHIP",
            F.lit("multiple_structural_transformations_required"),
        ),
    )
    family, evidence = F.lit("OTHER_RESIDUAL"), F.lit("no_supported_deterministic_structural_family")
    for condition, name, text in reversed(families):
        family, evidence = F.when(condition, name).otherwise(family), F.when(condition, text).otherwise(evidence)
    return df.select(
        *pairs.columns,
        family.alias("primary_family"),
        evidence.alias("family_evidence"),
        F.size(a).alias("core_token_count_a"),
        F.size(b).alias("core_token_count_b"),
        "shared_exact_token_count",
        F.when(n > 0, F.array_join(F.transform("diff", lambda d: d["i"].cast("string")), ",")).alias("differing_token_positions"),
        n.alias("differing_token_count"),
        F.when(F.col("extras").isNotNull() & (extra == 1), F.get("extras", F.lit(0))).alias("added_removed_token"),
        F.abs(F.size(a) - F.size(b)).alias("added_removed_token_count"),
        F.when(n > 0, most).alias("maximum_token_edit_distance"),
        F.when(n > 0, total).alias("total_token_edit_distance"),
        "is_token_reorder",
        F.col("extras").isNotNull().alias("is_ordered_subsequence"),
        "is_token_multiset_containment",
        "has_initialism_pattern",
        "possible_truncation_a",
        "possible_truncation_b",
    )


# ---- rarity ------------------------------------------------------------------------------------------------------


def distinctive(pairs: DataFrame, keys: DataFrame, eligibility: DataFrame, settings: Settings, universe: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Exact token overlap of pairs and how rare it is in the employer universe; a shared token without support is an error."""
    _, support = universe or _universe(keys, eligibility, settings)
    df = with_cores(pairs, settings).withColumn("shared", shared_tokens(F.col("core_a"), F.col("core_b")))
    one = df.select("key_a", "key_b", F.explode(F.array_distinct("shared")).alias("token")).join(support, "token", "left")
    one = one.withColumn("support", F.when(F.col("support").isNull(), F.raise_error(F.concat(F.lit("shared token without support: "), "token"))).otherwise(F.col("support")))
    legal, generic = words(legal_tokens(settings)), words(GENERIC_TOKENS)
    t, limits = F.col("token"), settings.candidates
    real = ~F.array_contains(legal, t)
    rare = alphabetic(t) & (F.length(t) >= limits.minimum_informative_token_length) & real & ~F.array_contains(generic, t) & (F.col("support") <= limits.maximum_token_frequency)
    facts = one.groupBy("key_a", "key_b").agg(
        F.collect_set(F.when(rare, t)).alias("rare"),
        *(f(F.when(c, F.col("support"))).alias(n) for n, f, c in (
            ("minimum_shared_token_support", F.min, real), ("maximum_shared_token_support", F.max, real),
            ("minimum_distinctive_token_support", F.min, rare), ("maximum_distinctive_token_support", F.max, rare),
        )),
    )
    df = df.join(facts, ["key_a", "key_b"], "left")
    kept = F.filter("shared", lambda v: F.coalesce(F.array_contains("rare", v), F.lit(False)))
    n, d = F.size("shared"), F.size(kept)
    cover = lambda k, core: F.when(F.size(core) > 0, F.bround(k / F.size(core), 6)).otherwise(F.lit(0.0))
    a_short = F.size("core_a") <= F.size("core_b")
    pick = lambda k, short: F.when(a_short if short else ~a_short, cover(k, "core_a")).otherwise(cover(k, "core_b"))
    return df.select(
        *pairs.columns,
        F.array_join("shared", "|").alias("shared_exact_tokens"),
        F.array_join(kept, "|").alias("shared_distinctive_tokens"),
        n.alias("shared_exact_token_count"),
        d.alias("shared_distinctive_token_count"),
        F.size(F.filter("shared", lambda v: F.array_contains(generic, v))).alias("shared_generic_token_count"),
        "minimum_shared_token_support", "maximum_shared_token_support", "minimum_distinctive_token_support", "maximum_distinctive_token_support",
        cover(n, "core_a").alias("exact_coverage_a"), cover(n, "core_b").alias("exact_coverage_b"),
        cover(d, "core_a").alias("distinctive_coverage_a"), cover(d, "core_b").alias("distinctive_coverage_b"),
        pick(n, True).alias("shorter_name_exact_coverage"), pick(n, False).alias("longer_name_exact_coverage"),
        pick(d, True).alias("shorter_name_distinctive_coverage"), pick(d, False).alias("longer_name_distinctive_coverage"),
        (n > 0).alias("has_shared_exact_token"), (d > 0).alias("has_shared_distinctive_token"),
        (d >= 2).alias("has_multiple_shared_distinctive_tokens"), ((n > 0) & (d == 0)).alias("has_exact_overlap_without_distinctive_token"),
    )


# ---- combined ----------------------------------------------------------------------------------------------------


def multi_evidence(pairs: DataFrame) -> DataFrame:
    """The combined family of pairs that carry structural, rarity and orthographic evidence; contradictions are errors."""
    n, d = F.col("shared_exact_token_count"), F.col("shared_distinctive_token_count")
    sound = (
        (n >= 0) & (d >= 0) & (d <= n) & (F.col("has_shared_distinctive_token") == (d > 0)) & (F.col("has_multiple_shared_distinctive_tokens") == (d >= 2))
        & F.col("shorter_name_exact_coverage").between(0, 1) & F.col("shorter_name_distinctive_coverage").between(0, 1)
    )
    structural = F.col("primary_family").isin(*STRUCTURAL)
    local = F.col("orthographic_evidence").isin(*LOCALIZED)
    rare, several = F.col("has_shared_distinctive_token"), F.col("has_multiple_shared_distinctive_tokens")
    numeric = F.col("numeric_relation").isin("one_sided", "conflict")
    full = F.col("shorter_name_exact_coverage") == 1.0
    cases = (
        (numeric & (n > 0), "NUMERIC_RISK_WITH_NAME_EVIDENCE"),
        (structural & several, "STRUCTURE_WITH_MULTIPLE_DISTINCTIVE_TOKENS"),
        (structural & rare, "STRUCTURE_WITH_DISTINCTIVE_TOKEN"),
        (local & rare, "LOCAL_ORTHOGRAPHIC_WITH_DISTINCTIVE_CONTEXT"),
        ((F.col("primary_family") == "MULTIPLE_SMALL_TOKEN_EDITS") & rare, "MULTI_EDIT_WITH_DISTINCTIVE_CONTEXT"),
        (full, "FULL_SHORTER_NAME_OVERLAP"),
        (rare, "DISTINCTIVE_SINGLE_SIGNAL"),
        (numeric, "WEAK_OR_MIXED_EVIDENCE"),
        (n > 0, "EXACT_OVERLAP_WITHOUT_DISTINCTIVE_EVIDENCE"),
    )
    family = F.lit("ZERO_EXACT_OVERLAP")
    for condition, name in reversed(cases):
        family = F.when(condition, name).otherwise(family)
    family = F.when(~sound, F.raise_error(F.lit("contradictory pair evidence"))).otherwise(family)
    evidence = F.format_string(
        "primary_family=%s;numeric_relation=%s;shared_exact_tokens=%d;shared_distinctive_tokens=%d;shorter_exact_coverage=%.6f;orthographic_evidence=%s",
        "primary_family", "numeric_relation", n, d, "shorter_name_exact_coverage", "orthographic_evidence",
    )
    return pairs.select(
        "*",
        family.alias("assessment_family"), evidence.alias("assessment_evidence"),
        structural.alias("has_structural_exact_relation"), local.alias("has_orthographic_signal"),
        rare.alias("has_distinctive_exact_overlap"), several.alias("has_multiple_distinctive_exact_overlap"),
        numeric.alias("has_numeric_risk"), (n == 0).alias("has_zero_exact_overlap"),
        full.alias("has_full_shorter_exact_coverage"), (F.col("shorter_name_distinctive_coverage") == 1.0).alias("has_full_shorter_distinctive_coverage"),
    )

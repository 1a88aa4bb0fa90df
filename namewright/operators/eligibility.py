"""Mention type of resolution keys (A-2, E-1, E-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.config import Settings
from namewright.functions.text import tokens
from namewright.functions.typing import words

STRENGTHS = ("none", "weak", "moderate", "strong")
FLAGS = (
    "is_blank", "is_numeric_only", "has_address_signal", "has_occupation_signal", "has_activity_description_signal", "has_corporate_suffix",
    "has_organization_like_tokens", "mixed_address_organization_signal", "mixed_occupation_organization_signal",
)


def strength(column: str) -> Column:
    known = F.array(*(F.lit(s) for s in STRENGTHS))
    rank = F.array_position(known, F.col(column)) - 1
    return F.when(rank < 0, F.raise_error(F.concat(F.lit("invalid strength "), column))).otherwise(rank)


def evidence(preprocessed: DataFrame, keys: DataFrame) -> DataFrame:
    """What the source rows of each key show; a key without source rows is an error."""
    rows = preprocessed.where("nombre_normalizado is not null").groupBy(F.col("nombre_normalizado").alias("resolution_key")).agg(
        F.count("*").alias("source_rows"),
        F.collect_set("route").alias("routes"),
        *(F.bool_or(f).alias(f) for f in FLAGS),
        F.max(strength("address_signal_strength")).alias("address_strength"),
        F.max(strength("occupation_signal_strength")).alias("occupation_strength"),
    )
    df = keys.select("resolution_key", "representative_name", "representative_route").join(rows, "resolution_key", "left")
    return df.withColumn("source_rows", F.when(F.col("source_rows").isNull(), F.raise_error(F.concat(F.lit("key without rows: "), "resolution_key"))).otherwise(F.col("source_rows")))


def street_address(name: Column, road_types: tuple[str, ...]) -> Column:
    """Number first, a road type, a five-digit code from the fourth token on, a two-letter region, then a place."""
    toks = tokens(name)
    at = lambda i: F.get(toks, i)
    code = lambda i: (
        at(i).rlike(r"^\p{Nd}{5}\z")
        & F.exists(F.slice(toks, F.lit(2), i - 1), lambda t: F.array_contains(words(road_types), t))
        & at(i + 1).rlike(r"^\p{L}{2}\z")
        & F.exists(F.slice(toks, i + 3, F.greatest(F.size(toks) - i - 2, F.lit(0))), lambda t: t.rlike(r"^\p{L}+\z"))
    )
    places = F.sequence(F.lit(3), F.greatest(F.size(toks) - 3, F.lit(3)))
    return F.coalesce((F.size(toks) >= 6) & at(F.lit(0)).rlike(r"^\p{Nd}+\z") & F.exists(places, lambda i: F.coalesce(code(i), F.lit(False))), F.lit(False))


def classify(preprocessed: DataFrame, keys: DataFrame, settings: Settings) -> DataFrame:
    """Status, rule and evidence of each key, in fail-closed order."""
    df = evidence(preprocessed, keys)
    route = lambda r: F.array_contains("routes", r)
    organization = F.col("has_corporate_suffix") | F.col("has_organization_like_tokens")
    street = street_address(F.col("representative_name"), settings.road_type_tokens)
    address = (F.col("address_strength") >= 2) | route("address_candidate")
    other = (F.col("occupation_strength") == 3) | route("non_employer_status_candidate")
    work = F.col("has_occupation_signal") | other
    mixed = (
        F.col("mixed_address_organization_signal") | F.col("mixed_occupation_organization_signal")
        | ((street | address) & work) | ((street | address) & organization) | (work & organization)
    )
    cases = (
        (F.col("is_blank") | F.col("is_numeric_only") | route("blank_candidate"), "AMBIGUOUS", "invalid_content_abstention", "blank_or_numeric_only_content"),
        (mixed, "AMBIGUOUS", "mixed_evidence_abstention", "conflicting_address_occupation_or_organization_evidence"),
        (street, "ADDRESS", "structural_street_zip_region_address", "leading_number_road_type_zip_region_and_locality"),
        (address, "ADDRESS", "existing_address_signal", "existing_moderate_or_strong_address_evidence"),
        (other, "NON_EMPLOYER_STATUS", "existing_non_employer_status", "existing_pure_status_or_non_employer_route"),
        (F.col("has_occupation_signal") | F.col("has_activity_description_signal"), "AMBIGUOUS", "descriptive_activity_abstention", "descriptive_occupation_or_activity_requires_abstention"),
        (F.col("has_address_signal"), "AMBIGUOUS", "insufficient_evidence_abstention", "weak_or_prior_ambiguous_evidence"),
        (organization, "EMPLOYER_CANDIDATE", "organization_compatible", "corporate_suffix_or_organization_token_without_exclusion"),
        (F.col("representative_route") == "employer_resolution_candidate", "EMPLOYER_CANDIDATE", "prior_employer_route", "prior_employer_route_without_stronger_exclusion"),
    )
    status, rule, why = F.lit("AMBIGUOUS"), F.lit("insufficient_evidence_abstention"), F.lit("insufficient_evidence_for_safe_mention_type")
    for condition, s, r, w in reversed(cases):
        status, rule, why = F.when(condition, s).otherwise(status), F.when(condition, r).otherwise(rule), F.when(condition, w).otherwise(why)
    return df.select("resolution_key", "representative_name", status.alias("eligibility_status"), rule.alias("eligibility_rule"), why.alias("eligibility_evidence"))

"""Record typing (T-1 to T-15): signals and route of a name, as one projection over its relaxed form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.config import Typing
from namewright.functions.text import tokens

# Spellings of employment status that fill a whole value ...
PURE_STATUS = (
    r"DESEMPLEAD(?:O|A|0)[A-Z0-9]*(?:\s+.*)?",
    r"AMA DE CASA[A-Z0-9]*(?:\s+.*)?",
    r"(?:DEPENDIENTE ECON[A-Z0-9]*|DEPENDE ECON[A-Z0-9]*|DEPEND ECON[A-Z0-9]*|DENEDE ECON[A-Z0-9]*)(?:\s+.*)?",
    r"(?:NO LABOR[A-Z0-9]*|NO TRABAJ[A-Z0-9]*|NO ESTA(?:\s+[A-Z0-9]+){0,2}\s+(?:TRABAJ|LABOR)[A-Z0-9]*)(?:\s+.*)?",
    r"ACTUAL(?:MENTE|METE)\s+NO\s+(?:(?:ESTA\s+)?(?:TRABAJ|LABOR)[A-Z0-9]*|EJERCE\s+PROFESION)(?:\s+.*)?",
    r"(?:(?:EN ESTOS MOMENTOS\s+)?(?:AUN\s+)?NO\s+(?:TIENE|TENGO)\s+EMPLEO|NO\s+TIENE\s+TRABAJO|SIN\s+(?:EMPLEO|TRABAJO))(?:\s+.*)?",
    r"ACTUALMENTE(?:\s+ACABA\s+DE\s+QUEDAR)?\s+CESANTE",
    r"CESANTE(?:\s+ACTUALMENTE)?",
    r"CESANTE\s+EL\s+[A-Z0-9]+",
    r"CESANTE\s+PERCIBE\s+INGRESO(?:\s+DE\s+SU(?:\s+ESPOSO)?)?",
    r"ESTA\s+CESANTE(?:\s+.*)?",
    r"(?:JUBILAD|JUBLAD)[A-Z0-9]*",
    r"PENSIONAD[A-Z0-9]*",
    r"ESTUDIANT[A-Z0-9]*",
)
# ... or stand inside of one ...
EMBEDDED_STATUS = (
    r"(?<![A-Z0-9])(?:JUBILAD|JUBLAD)[A-Z0-9]*(?![A-Z0-9])",
    r"(?<![A-Z0-9])PENSIONAD[A-Z0-9]*(?![A-Z0-9])",
    r"(?<![A-Z0-9])ESTUDIANT[A-Z0-9]*(?![A-Z0-9])",
    r"(?<![A-Z0-9])NO\s+(?:LABOR|TRABAJ)[A-Z0-9]*(?![A-Z0-9])",
    r"(?<![A-Z0-9])NO\s+ESTA(?:\s+[A-Z0-9]+){0,2}\s+(?:TRABAJ|LABOR)[A-Z0-9]*(?![A-Z0-9])",
    r"(?<![A-Z0-9])(?:DEPENDIENTE ECON|DEPENDE ECON|DEPEND ECON|DENEDE ECON)[A-Z0-9]*(?![A-Z0-9])",
    r"(?<![A-Z0-9])AMA DE CASA[A-Z0-9]*(?![A-Z0-9])",
    r"[A-Z]+(?:JUBILAD|JUBLAD)[A-Z0-9]*(?![A-Z0-9])",
    r"(?<![A-Z0-9])CESANTE(?![A-Z0-9])",
)
# ... occupations, and statements of not working.
OCCUPATIONS = (
    r"(?<![A-Z0-9])AGRICULTOR(?:A|ES)?(?![A-Z0-9])",
    r"(?<![A-Z0-9])AGRONOM(?:O|A|OS|AS)(?![A-Z0-9])",
    r"(?<![A-Z0-9])COMERCIANTE(?:S)?(?![A-Z0-9])",
    r"(?<![A-Z0-9])ESTILISTA(?:S)?(?![A-Z0-9])",
    r"(?<![A-Z0-9])LOCUTOR(?:A|ES|AS)?(?![A-Z0-9])",
    r"(?<![A-Z0-9])INDEPEN\s+DIENTE(?![A-Z0-9])",
    r"(?<![A-Z0-9])INDEPENDINETE(?![A-Z0-9])",
)
NEGATED_WORK = (
    r"(?:NO\s+(?:LABOR|TRABAJ)[A-Z0-9]*|NO\s+ESTA(?:\s+[A-Z0-9]+){0,2}\s+(?:TRABAJ|LABOR)[A-Z0-9]*|"
    r"ACTUAL(?:MENTE|METE)\s+NO\s+(?:(?:ESTA\s+)?(?:TRABAJ|LABOR)[A-Z0-9]*|EJERCE\s+PROFESION))(?:\s+.*)?"
)
COMPANY_WORDS = ("EMPRESA", "EMPRESAS")


def words(values: tuple[str, ...]) -> Column:
    return F.array(*(F.lit(v) for v in values))


def has_phrase(value: Column, phrase: str) -> Column:
    return F.concat(F.lit(" "), value, F.lit(" ")).contains(f" {' '.join(phrase.split())} ")


def any_of(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def address_score(value: Column, toks: Column, config: Typing) -> Column:
    """2 explicit + 1 contextual + 2 a number near an address word + 3 an intersection + 1 several address words."""
    explicit = F.array_intersect(toks, words(config.explicit_tokens))
    contextual = F.array_intersect(toks, words(config.contextual_tokens))
    address = words(config.explicit_tokens + config.contextual_tokens)
    number = F.exists(
        F.sequence(F.lit(1), F.greatest(F.size(toks), F.lit(1))),
        lambda i: F.array_contains(address, F.get(toks, i - 1))
        & F.exists(F.array(F.get(toks, i - 2), F.get(toks, i), F.get(toks, i + 1)), lambda n: F.coalesce(n.rlike(r"^\p{Nd}+(\p{Nd}|\p{L})?\z"), F.lit(False))),
    )
    crossing = any_of([has_phrase(value, m) for m in config.intersection_markers])
    one = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return 2 * one(F.size(explicit) > 0) + one(F.size(contextual) > 0) + 2 * one(number) + 3 * one(crossing) + one(F.size(F.array_union(explicit, contextual)) > 1)


def status_match(value: Column, config: Typing) -> Column:
    """The configured phrase, else the whole value of a pure variant, else the embedded variant; null if none."""
    found = [F.when(has_phrase(value, p), p) for p in sorted(config.status_phrases, key=lambda p: (-len(p.split()), p))]
    found.append(F.when(value.rlike("^(?:" + "|".join(f"(?:{p})" for p in PURE_STATUS) + r")\z"), value))
    found += [F.when(value.rlike(p), F.regexp_extract(value, f"({p})", 1)) for p in EMBEDDED_STATUS]
    return F.when(value != "", F.coalesce(*found))


def typed(df: DataFrame, config: Typing, strict: str = "nombre_normalizado", relaxed: str = "nombre_matching") -> DataFrame:
    """``df`` with the 15 typing columns."""
    df = df.withColumn("__value", F.trim(F.coalesce(relaxed, F.lit("")))).withColumn("__tokens", tokens(F.col("__value")))
    value, toks = F.col("__value"), F.col("__tokens")
    df = df.select(
        "*",
        F.coalesce(F.length(F.trim(strict)), F.lit(0)).alias("normalized_length"),
        F.size(toks).alias("token_count"),
        F.coalesce(value.rlike(r"^\p{Nd}+( \p{Nd}+)*\z"), F.lit(False)).alias("is_numeric_only"),
        address_score(value, toks, config).alias("__score"),
        status_match(value, config).alias("__status"),
        (any_of([value.rlike(p) for p in OCCUPATIONS]) & (value != "")).alias("__occupation"),
        F.coalesce(F.array_contains(words(config.corporate_suffix_tokens), F.get(toks, F.size(toks) - 1)), F.lit(False)).alias("has_corporate_suffix"),
        F.array_intersect(toks, words(config.organization_tokens)).alias("__organization"),
    )
    pure = F.coalesce(F.col("__status") == value, F.lit(False))
    status, occupation = F.col("__status").isNotNull(), F.col("__occupation")
    only_company = F.size(F.array_except("__organization", words(COMPANY_WORDS))) == 0
    ignored = pure & ~F.col("has_corporate_suffix") & only_company & value.rlike(f"^(?:{NEGATED_WORK})\\z")
    score = F.col("__score")
    df = df.select(
        "*",
        (F.col("normalized_length") == 0).alias("is_blank"),
        (score > 0).alias("has_address_signal"),
        F.when(score <= 0, "none").when(score >= config.strong_score, "strong").when(score >= config.moderate_score, "moderate").otherwise("weak").alias("address_signal_strength"),
        (status | occupation).alias("has_occupation_signal"),
        F.when(pure, "strong").when(status | occupation, "moderate").otherwise("none").alias("occupation_signal_strength"),
        ((status | occupation) & ~pure).alias("has_activity_description_signal"),
        (F.col("has_corporate_suffix") | ((F.size("__organization") > 0) & ~ignored)).alias("has_organization_like_tokens"),
        pure.alias("__pure"),
    )
    organization, address, work = F.col("has_organization_like_tokens"), F.col("has_address_signal"), F.col("has_occupation_signal")
    df = df.withColumns({"mixed_address_organization_signal": address & organization, "mixed_occupation_organization_signal": work & organization})
    mixed = F.col("mixed_address_organization_signal") | F.col("mixed_occupation_organization_signal")
    cases = (
        (F.col("is_blank"), "blank_candidate", "blank_preserved_for_later_validation"),
        (F.col("is_numeric_only"), "ambiguous_review_candidate", "numeric_only_is_ambiguous"),
        (mixed, "employer_resolution_candidate", "organization_signal_preserves_resolution_eligibility"),
        (address & work, "ambiguous_review_candidate", "conflicting_address_and_occupation_signals"),
        (F.col("__pure"), "non_employer_status_candidate", "complete_value_matches_status_phrase"),
        (F.col("address_signal_strength").isin("moderate", "strong"), "address_candidate", "corroborated_address_without_organization_signal"),
        (address | work, "ambiguous_review_candidate", "weak_or_descriptive_nonorganization_signal"),
    )
    route, reason = F.lit("employer_resolution_candidate"), F.lit("no_signal_justifies_exclusion_from_resolution")
    for condition, name, why in reversed(cases):
        route, reason = F.when(condition, name).otherwise(route), F.when(condition, why).otherwise(reason)
    df = df.withColumns({"route": route, "route_reason": reason})
    return df.drop(*(c for c in df.columns if c.startswith("__")))

"""Corporate master, aliases, quality gate and reference promotion (A-8 to A-11, Q-1 to Q-4, X-1 to X-4, J-23, J-24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.operators.preprocess import checked

# Statuses of outcomes, and methods of exact reuse.
STATUS = {"EMPRESA_VALIDADA_PUBLICAMENTE": "PUBLIC_VALIDATED", "EMPRESA_CANONICALIZADA_AUTO": "AUTO_CANONICALIZED", "EMPRESA_NORMALIZADA_SIN_VALIDACION_PUBLICA": "NORMALIZED_CANDIDATE"}
EXACT = ("exact_reference_alias", "exact_reference_canonical")
SINGLE = (
    "nombre_propuesto", "sector_propuesto", "resultado_final", "confianza_resolucion", "score_confianza_resolucion", "canonical_resolution_key",
    "component_key_count", "component_source_row_count", "public_entity_id", "public_source_url", "public_validation_date",
)


def corporate_master(final: DataFrame) -> DataFrame:
    """One row per entity; rows of an entity that contradict each other, or its counts, are an error."""
    outcome = F.col("resultado_final").isin(*STATUS)
    rows = checked(final, outcome != F.col("entity_id").isNotNull(), F.concat(F.lit("outcome and entity disagree in "), "record_id")).where(outcome)
    # Rows that say the same count as one: what is compared are the values of each key, and a hot entity is no single task.
    same = rows.groupBy("entity_id", "resolution_key", "metodo_resolucion", *SINGLE).agg(F.count("*").alias("rows"))
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))
    one = same.groupBy("entity_id").agg(
        *(F.max(c).alias(c) for c in SINGLE),
        *((F.min(shown(c)) != F.max(shown(c))).alias(f"several_{c}") for c in SINGLE),
        F.min("metodo_resolucion").alias("method"),
        F.coalesce(F.min("metodo_resolucion") != F.max("metodo_resolucion"), F.lit(False)).alias("several_methods"),
        (~F.coalesce(F.bool_or(~F.col("metodo_resolucion").isin(*EXACT)), F.lit(False))).alias("reuse"),
        F.sum("rows").alias("rows"),
        F.count_distinct("resolution_key").alias("keys"),
        F.bool_or(F.col("resolution_key") == F.col("canonical_resolution_key")).alias("has_canonical"),
    )
    reuse = F.col("reuse")
    public = [F.col(c).isNull() for c in ("public_entity_id", "public_source_url", "public_validation_date")]
    several = F.lit(False)
    for c in SINGLE:
        several = several | F.col(f"several_{c}")
    wrong = (
        several | (~reuse & F.col("several_methods")) | (F.col("rows") != F.col("component_source_row_count")) | (F.col("keys") != F.col("component_key_count"))
        | (~reuse & ~F.col("has_canonical")) | (public[0] != public[1]) | (public[1] != public[2])
    )
    one = checked(one, wrong, F.concat(F.lit("contradictory rows of entity "), "entity_id"))
    status = F.lit(None).cast("string")
    for result, name in STATUS.items():
        status = F.when(F.col("resultado_final") == result, name).otherwise(status)
    return one.select(
        "entity_id", F.col("nombre_propuesto").alias("canonical_name"), F.col("sector_propuesto").alias("sector"), status.alias("resolution_status"),
        F.when(reuse, "reference_exact_reuse").otherwise(F.col("method")).alias("resolution_method"),
        F.col("confianza_resolucion").alias("confidence_level"), F.col("score_confianza_resolucion").alias("confidence_score"),
        "component_key_count", F.col("component_source_row_count").alias("source_row_count"),
        F.when(public[0], "NOT_PUBLIC_VALIDATED").otherwise("PUBLIC_VALIDATED").alias("public_validation_status"),
        "public_entity_id", "public_source_url", "public_validation_date",
    )


def alias_dictionary(final: DataFrame, master: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per entity and key; a key of two entities, or a frequency that differs from the key's, is an error."""
    seen = final.where("entity_id is not null").groupBy("entity_id", "resolution_key").agg(F.count("*").alias("seen"))
    owners = seen.groupBy("resolution_key").agg(F.count("*").alias("owners"))
    df = seen.join(owners, "resolution_key").join(keys.select("resolution_key", "representative_name", "source_row_frequency"), "resolution_key", "left")
    wrong = (F.col("owners") > 1) | (F.col("source_row_frequency") != F.col("seen"))
    df = checked(df, wrong, F.concat(F.lit("key of two entities or of another frequency: "), "resolution_key"))
    df = df.join(master.select("entity_id", "resolution_method", "confidence_score"), "entity_id")
    return df.select(
        "entity_id", "resolution_key", F.coalesce("representative_name", "resolution_key").alias("representative_name"), F.col("resolution_method").alias("alias_method"),
        F.col("confidence_score").alias("alias_confidence_score"), F.coalesce("source_row_frequency", "seen").alias("source_row_frequency"),
    )


def alias_rollup(aliases: DataFrame, master: DataFrame) -> DataFrame:
    """(entity_id, keys, rows) of the aliases; an entity whose aliases do not add up to its master row is an error."""
    rolled = aliases.groupBy("entity_id").agg(F.count("*").alias("keys"), F.sum("source_row_frequency").alias("rows"))
    df = master.select("entity_id", "component_key_count", "source_row_count").join(rolled, "entity_id", "left")
    off = F.coalesce((F.col("keys") != F.col("component_key_count")) | (F.col("rows") != F.col("source_row_count")), F.lit(True))
    return checked(df, off, F.concat(F.lit("aliases do not add up for "), "entity_id")).select("entity_id", "keys", "rows")


# Endings that a number may follow.
SUFFIX_NUMBER = r"(?i)(?:\bSA|\bS\s+A|\bCA|\bC\s+A|\bSPA|\bINC|\bLLC|\bLTD|\bCORP|\bSRL|\bS\s+R\s+L)\s+\p{Nd}+\z"


def canonical_quality(master: DataFrame) -> DataFrame:
    """Quality status and reason of each canonical name, and whether it may be promoted."""
    name, status = F.col("canonical_name"), F.col("resolution_status")
    invalid, trailing, suffixed = name.rlike(r"[\p{Cc}\x{FFFD}]"), name.rlike(r"\s+\p{Nd}+\z"), name.rlike(SUFFIX_NUMBER)

    def by_case(*values: str) -> Column:
        conditions = (invalid, status == "PUBLIC_VALIDATED", status == "NORMALIZED_CANDIDATE", status != "AUTO_CANONICALIZED", suffixed, trailing)
        out = F.lit(values[-1])
        for condition, value in reversed(list(zip(conditions, values[:-1], strict=True))):
            out = F.when(condition, F.raise_error(F.concat(F.lit("unknown status "), status)) if value == "!" else value).otherwise(out)
        return out

    quality = by_case("SUSPICIOUS", "PUBLIC_VALIDATED", "NOT_PROMOTABLE", "!", "SUSPICIOUS", "SUSPICIOUS", "ACCEPTABLE")
    reason = by_case(
        "invalid_control_or_replacement_character", "public_validated_name", "normalized_candidate_not_promotable", "!", "legal_suffix_trailing_numeric",
        "trailing_numeric", "auto_canonical_name_acceptable",
    )
    return master.select(
        "entity_id", "canonical_name", "resolution_status", "confidence_score", quality.alias("quality_status"), reason.alias("quality_reason"),
        trailing.alias("has_trailing_numeric"), suffixed.alias("legal_suffix_trailing_numeric"), invalid.alias("has_invalid_character"),
        quality.isin("PUBLIC_VALIDATED", "ACCEPTABLE").alias("promotion_eligible"),
    )


def unique_entities(quality: DataFrame) -> DataFrame:
    """``quality``, failing on an entity with two rows."""
    n = quality.groupBy("entity_id").agg(F.count("*").alias("n"))
    return checked(quality.join(n, "entity_id"), F.col("n") > 1, F.concat(F.lit("entity with two quality rows: "), "entity_id")).drop("n")


def promotable(master: DataFrame, quality: DataFrame) -> DataFrame:
    """(entity_id, canonical_name) that may become references; the two tables have to hold the same entities."""
    both = master.select("entity_id", "canonical_name", "resolution_status").join(
        quality.select("entity_id", "quality_status", "promotion_eligible", F.lit(True).alias("assessed")), "entity_id", "full"
    )
    pair = (F.col("quality_status") == F.when(F.col("resolution_status") == "PUBLIC_VALIDATED", "PUBLIC_VALIDATED").otherwise("ACCEPTABLE"))
    wrong = F.col("assessed").isNull() | (F.col("promotion_eligible") & (F.col("canonical_name").isNull() | ~pair))
    both = checked(both, wrong, F.concat(F.lit("master and quality disagree on "), "entity_id"))
    return both.where("promotion_eligible").select("entity_id", "canonical_name")


def promoted_aliases(aliases: DataFrame, eligible: DataFrame) -> DataFrame:
    """(entity_id, alias_name): each name belongs to one entity, and each eligible entity has one at least."""
    df = eligible.select("entity_id").join(aliases.select("entity_id", F.col("representative_name").alias("alias_name")).distinct(), "entity_id", "left")
    df = checked(df, F.col("alias_name").isNull(), F.concat(F.lit("no alias of "), "entity_id"))
    n = df.groupBy("alias_name").agg(F.count_distinct("entity_id").alias("n"))
    return checked(df.join(n, "alias_name"), F.col("n") > 1, F.concat(F.lit("alias of two entities: "), "alias_name")).select("entity_id", "alias_name")


def merged_references(existing: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Union of references; a key with two values is an error.  Merging the same rows again changes nothing."""
    rows = existing.select(key, value).unionByName(new.select(key, value)).distinct()
    n = rows.groupBy(key).agg(F.count("*").alias("n"))
    return checked(rows.join(n, key), F.col("n") > 1, F.concat(F.lit("conflicting reference: "), key)).select(key, value)


def newly_promoted(existing: DataFrame, merged: DataFrame) -> DataFrame:
    return merged.join(existing.select("entity_id").distinct(), "entity_id", "left_anti")


def promote(master: DataFrame, quality: DataFrame, aliases: DataFrame, old_master: DataFrame, old_aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The next version of (master references, alias references)."""
    eligible = promotable(master, quality)
    names = promoted_aliases(aliases, eligible)
    return merged_references(old_master, eligible, "entity_id", "canonical_name"), merged_references(old_aliases, names, "alias_name", "entity_id").select("entity_id", "alias_name")

"""Ingest, normalise and type source rows; resolve them against exact references; aggregate resolution keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.config import Settings
from namewright.functions.text import normalized, strict_name
from namewright.functions.typing import typed

PREPROCESSED = (
    "record_id", "source_row_number", "nombre_original", "nombre_normalizado", "nombre_matching", "has_trailing_numeric_token",
    "trailing_numeric_candidate", "possible_truncation", "is_blank", "is_numeric_only", "has_address_signal",
    "address_signal_strength", "has_occupation_signal", "occupation_signal_strength", "has_corporate_suffix",
    "has_organization_like_tokens", "mixed_address_organization_signal", "mixed_occupation_organization_signal",
    "has_activity_description_signal", "token_count", "normalized_length", "route", "route_reason",
)
ENTITY_ID = r"^(EMP-\d{6}|PUB-\d{6}|ENT-[0-9A-F]{16})\z"


def record_id(sha256: str, sheet: str, row: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit("record-v1"), F.lit(sha256.upper()), F.lit(sheet), row.cast("string")), 256)


def preprocess(rows: DataFrame, settings: Settings, source_sha256: str = "0" * 64) -> DataFrame:
    """The 23 columns of each (source_row_number, nombre_original).

    All but the ids follow from the name alone: each distinct name is normalised and typed once, in as many tasks as a shuffle has
    (the files of a name column are few and small, and so would be the tasks), and its rows take the result over.
    """
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    names = typed(normalized(rows.select("nombre_original").distinct().repartition(tasks), settings.normalization), settings.typing)
    names = names.withColumnRenamed("nombre_original", "__name")
    df = rows.select("source_row_number", "nombre_original").withColumn("record_id", record_id(source_sha256, settings.source.sheet_name, F.col("source_row_number")))
    return df.join(names.hint("shuffle_hash"), F.col("nombre_original").eqNullSafe(F.col("__name"))).select(*PREPROCESSED)


def checked(df: DataFrame, wrong: Column, message: Column) -> DataFrame:
    """``df``, failing at the first row for which ``wrong`` holds.

    The partition id makes the condition non-deterministic, so the optimizer moves no later filter below it: such a filter
    could drop the very rows that have to fail, or turn an outer join into an inner one.
    """
    flag = F.when(F.coalesce(wrong, F.lit(False)), F.raise_error(message).cast("boolean")).otherwise(F.spark_partition_id() >= 0)
    return df.where(flag)


def exact_index(master: DataFrame, aliases: DataFrame) -> DataFrame:
    """(nombre_normalizado, entity_id, canonical_name, match_source): one row per strict reference name.

    Bad ids, blank names, duplicate entities, aliases without a master row and names of two entities are errors.
    A canonical name wins over an alias of the same entity.
    """
    master = checked(master, ~F.col("entity_id").rlike(ENTITY_ID) | (F.trim("canonical_name") == ""), F.concat(F.lit("invalid master row: "), F.coalesce("entity_id", F.lit("null"))))
    one = master.groupBy("entity_id").agg(F.min("canonical_name").alias("canonical_name"), F.count_distinct("canonical_name").alias("n"))
    one = checked(one, F.col("n") > 1, F.concat(F.lit("entity with two names: "), "entity_id")).drop("n")
    named = aliases.select("entity_id", "alias_name").distinct().join(one, "entity_id", "left")
    named = checked(named, F.col("canonical_name").isNull() | (F.trim("alias_name") == ""), F.concat(F.lit("invalid alias of "), "entity_id"))
    both = one.select("entity_id", "canonical_name", strict_name(F.col("canonical_name")).alias("nombre_normalizado"), F.lit(0).alias("rank")).unionByName(
        named.select("entity_id", "canonical_name", strict_name(F.col("alias_name")).alias("nombre_normalizado"), F.lit(1).alias("rank"))
    )
    index = both.groupBy("nombre_normalizado").agg(
        F.count_distinct("entity_id").alias("n"), F.min_by(F.struct("entity_id", "canonical_name"), F.struct("rank", "entity_id")).alias("e"), F.min("rank").alias("rank")
    )
    index = checked(index, F.col("n") > 1, F.concat(F.lit("name of two entities: "), "nombre_normalizado"))
    return index.select("nombre_normalizado", "e.entity_id", "e.canonical_name", F.when(F.col("rank") == 0, "canonical").otherwise("alias").alias("match_source"))


def resolve(preprocessed: DataFrame, index: DataFrame) -> DataFrame:
    """``preprocessed`` with five columns of exact resolution; the route plays no part.

    The join is left to the optimizer: a small index is broadcast by its measured size, a large one is shuffled.
    """
    df = preprocessed.join(index, "nombre_normalizado", "left")
    hit = F.col("match_source").isNotNull()
    return df.select(
        *preprocessed.columns,
        "entity_id",
        "canonical_name",
        F.when(hit, "resolved").otherwise("unresolved").alias("resolution_status"),
        F.when(hit, F.concat(F.lit("exact_"), "match_source")).alias("resolution_method"),
        F.when(hit, F.concat(F.lit("exact_match_validated_"), "match_source")).otherwise("no_validated_exact_match").alias("resolution_reason"),
    )


def exclusion_reason() -> Column:
    """Why a resolved row takes no part in discovery; null if it does."""
    return (
        F.when(F.col("resolution_status") != "unresolved", "already_resolved")
        .when(F.col("is_blank"), "blank")
        .when(F.col("is_numeric_only"), "numeric_only")
        .when(F.col("route") == "non_employer_status_candidate", "non_employer_status")
        .when(F.col("route") == "address_candidate", "address_candidate")
        .when(~F.col("route").isin("employer_resolution_candidate", "ambiguous_review_candidate"), "ineligible_route")
        .when(F.coalesce("nombre_normalizado", F.lit("")) == "", "missing_strict_key")
    )


def resolution_keys(resolved: DataFrame) -> DataFrame:
    """One row per strict name that takes part; its lowest source row represents it."""
    first = F.struct("source_row_number", "record_id", "route")
    keys = (
        resolved.where(exclusion_reason().isNull())
        .groupBy(F.col("nombre_normalizado").alias("resolution_key"))
        .agg(
            F.min_by(F.col("nombre_matching"), "source_row_number").alias("relaxed_key"),
            F.count("*").alias("source_row_frequency"),
            F.min(first).alias("first"),
            F.min("trailing_numeric_candidate").alias("trailing_numeric_candidate"),
            F.bool_or("possible_truncation").alias("possible_truncation"),
            F.max("token_count").alias("token_count"),
        )
    )
    return keys.select(
        "resolution_key",
        F.col("resolution_key").alias("representative_name"),
        F.when(F.col("relaxed_key") != "", F.col("relaxed_key")).alias("relaxed_key"),
        "source_row_frequency",
        F.col("first.record_id").alias("representative_record_id"),
        F.col("first.source_row_number").alias("representative_source_row_number"),
        F.col("first.route").alias("representative_route"),
        "trailing_numeric_candidate",
        "possible_truncation",
        "token_count",
    )

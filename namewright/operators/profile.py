"""Profiles, percentiles, cross-tabs and reconciliation checks (A-12 to A-21, W-2, W-6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from namewright.sources.shared import together



def counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, rows: str, columns: str, values: tuple[str, ...]) -> DataFrame:
    """Counts by two columns; values without rows are 0."""
    return df.groupBy(rows).pivot(columns, list(values)).count().na.fill(0)


def nearest_rank(df: DataFrame, column: str, shares: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """The ceil(p * n)-th smallest value for each share."""
    return df.agg(*(F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {column})").cast(df.schema[column].dataType).alias(f"p{round(p * 100)}") for p in shares))


SHARES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def spread(column: str, shares: tuple[float, ...]) -> list[Column]:
    """Aggregates of :func:`interpolated`; all shares are read from one percentile."""
    at = F.percentile(column, list(shares))
    values = [F.bround(F.get(at, F.lit(i)), 6).alias(f"p{round(p * 100)}") for i, p in enumerate(shares)]
    return [F.bround(F.min(column).cast("double"), 6).alias("minimum"), *values, F.bround(F.max(column).cast("double"), 6).alias("maximum")]


def interpolated(df: DataFrame, column: str, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """Linearly interpolated percentiles, minimum and maximum, to six digits."""
    return df.agg(*spread(column, shares))


def candidates_per_key(keys: DataFrame, pairs: DataFrame) -> DataFrame:
    """Keys with and without candidates; minimum, median, p95, maximum over those with; mean over all."""
    n = pairs.select(F.explode(F.array("key_a", "key_b")).alias("resolution_key")).groupBy("resolution_key").agg(F.count("*").alias("n"))
    full = keys.select("resolution_key").join(n, "resolution_key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    some = F.when(F.col("n") > 0, F.col("n"))
    disc = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY CASE WHEN n > 0 THEN n END)")
    return full.agg(
        F.count_if(F.col("n") == 0).alias("zero"), F.count(some).alias("positive"), F.coalesce(F.min(some), F.lit(0)).alias("minimum"),
        F.coalesce(disc(0.5), F.lit(0)).cast("long").alias("median"), F.coalesce(disc(0.95), F.lit(0)).cast("long").alias("p95"),
        F.coalesce(F.max(some), F.lit(0)).alias("maximum"), F.coalesce(F.bround(F.avg("n"), 6), F.lit(0.0)).alias("mean"),
    )


def pair_reduction(keys: DataFrame, pairs: DataFrame) -> DataFrame:
    """The share of all possible pairs that blocking spares."""
    k, p = keys.agg(F.count("*").alias("keys")), pairs.agg(F.count("*").alias("pairs"))
    possible = F.col("keys") * (F.col("keys") - 1) / 2
    # Two tables of one row each.
    return k.join(p).select("keys", "pairs", F.when(possible > 0, F.bround(1 - F.col("pairs") / possible, 6)).otherwise(F.lit(0.0)).alias("reduction"))


def support_band(support: Column) -> Column:
    out = F.lit("101+")
    for high, name in ((100, "51-100"), (50, "26-50"), (25, "11-25"), (10, "6-10"), (5, "2-5"), (1, "1")):
        out = F.when(support <= high, name).otherwise(out)
    return out


def fingerprint(df: DataFrame, *columns: str) -> DataFrame:
    """An order-free digest of rows: their number, and sum and exclusive-or of sixty bits of their SHA-256."""
    text = F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")
    return df.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("xor"), F.coalesce(F.sum(F.pmod(h, F.lit(1 << 31))), F.lit(0)).alias("total"))


def counters(df: DataFrame, *columns: str) -> DataFrame:
    """(counter, value, n): how often each value of each column occurs, in one pass."""
    pairs = F.array(*(F.struct(F.lit(c).alias("counter"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("p")).groupBy("p.counter", "p.value").agg(F.count("*").alias("n"))


def weighted_summary(df: DataFrame, value: str, weight: str) -> DataFrame:
    """Count, minimum, nearest-rank median and 95th percentile, maximum of ``value``, each row counted ``weight`` times."""
    by_value = df.groupBy(F.col(value).alias("v")).agg(F.sum(weight).alias("w")).where("w > 0")
    # One row a distinct value: what is ranked in one task are the values of a counter, not rows.
    order = Window.orderBy("v")
    placed = by_value.withColumns({"upto": F.sum("w").over(order), "total": F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    at = lambda p: F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * F.lit(p)), F.col("v")))
    return placed.agg(F.coalesce(F.sum("w"), F.lit(0)).alias("n"), F.min("v").alias("minimum"), at(0.5).alias("p50"), at(0.95).alias("p95"), F.max("v").alias("maximum"))


#: What is counted of each stage's table: single columns, pairs of columns, and summaries of numbers.
COUNTED: dict[str, tuple[str, ...]] = {
    "preprocessed": ("route", "route_reason", "address_signal_strength", "occupation_signal_strength", "is_blank", "is_numeric_only", "possible_truncation", "has_corporate_suffix"),
    "resolved": ("resolution_status", "resolution_method", "resolution_reason"),
    "resolution_keys": ("representative_route", "possible_truncation"),
    "candidate_pair_features": ("numeric_relation", "blocking_method_count", "same_first_token"),
    "pair_resolution_decisions": ("decision_status", "decision_rule"),
    "employer_eligibility": ("eligibility_status", "eligibility_rule"),
    "orthographic_pair_decisions": ("orthographic_status", "orthographic_rule", "orthographic_evidence", "edit_operation"),
    "residual_relationship_profile": ("primary_family", "numeric_relation"),
    "distinctive_name_evidence": ("shared_distinctive_token_count", "has_shared_exact_token", "has_shared_distinctive_token"),
    "multi_evidence_assessment": ("assessment_family", "has_numeric_risk", "has_structural_exact_relation"),
    "employer_resolution_final": ("resultado_final", "metodo_resolucion", "confianza_resolucion", "confianza_sector", "sector_propuesto", "metodo_sector"),
    "corporate_master": ("resolution_status", "resolution_method", "public_validation_status", "confidence_level", "sector"),
    "corporate_aliases": ("alias_method",),
    "canonical_quality": ("quality_status", "quality_reason", "promotion_eligible"),
}
CROSSED: dict[str, tuple[tuple[str, str], ...]] = {
    "preprocessed": (("route", "address_signal_strength"), ("route", "occupation_signal_strength")),
    "candidate_pair_features": (("numeric_relation", "blocking_method_count"),),
    "residual_relationship_profile": (("primary_family", "numeric_relation"), ("primary_family", "orthographic_evidence")),
    "employer_resolution_final": (("resultado_final", "eligibility_status"), ("resultado_final", "confianza_sector")),
    "canonical_quality": (("resolution_status", "quality_status"),),
}
SUMMED: dict[str, tuple[str, ...]] = {
    "resolution_keys": ("source_row_frequency", "token_count"),
    "candidate_pair_features": ("length_ratio", "common_prefix_ratio", "token_jaccard", "char_ratio", "token_sort_ratio", "token_set_ratio", "partial_ratio"),
    "distinctive_name_evidence": ("shared_exact_token_count", "shared_distinctive_token_count"),
    "corporate_master": ("component_key_count", "source_row_count"),
}


def pair_counts(df: DataFrame, pairs: tuple[tuple[str, str], ...]) -> DataFrame:
    """(counter, value, n) of pairs of columns; values are joined by "|"."""
    joined = {f"{a} x {b}": F.concat_ws("|", F.coalesce(F.col(a).cast("string"), F.lit("")), F.coalesce(F.col(b).cast("string"), F.lit(""))) for a, b in pairs}
    return counters(df.select(*(v.alias(k) for k, v in joined.items())), *(f"`{k}`" for k in joined)).withColumn("counter", F.translate("counter", "`", ""))


def combinations(name: str, df: DataFrame) -> DataFrame:
    """(kind, counter, value, n) of a stage's counters and cross-tabs.

    Rows are counted by all their counted values together, in one pass; only the combinations found are taken apart.
    """
    single, crossed = COUNTED.get(name, ()), CROSSED.get(name, ())
    used = list(dict.fromkeys([*single, *(c for pair in crossed for c in pair)]))
    joint = df.groupBy(*(F.col(c).cast("string").alias(c) for c in used)).agg(F.count("*").alias("n"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    mark = lambda kind, counter, value: F.struct(F.lit(kind).alias("kind"), F.lit(counter).alias("counter"), value.alias("value"))
    marks = [mark("counters", c, text(c)) for c in single] + [mark("crosstabs", f"{a} x {b}", F.concat_ws("|", text(a), text(b))) for a, b in crossed]
    return joint.select("n", F.explode(F.array(*marks)).alias("m")).groupBy("m.kind", "m.counter", "m.value").agg(F.sum("n").alias("n"))


def metrics(name: str, df: DataFrame) -> dict[str, object]:
    """Counters, cross-tabs and summaries of a stage's table, for its metrics file."""
    out: dict[str, object] = {}
    kinds = [k for k, tables in (("counters", COUNTED), ("crosstabs", CROSSED)) if name in tables]
    summed = [c for c in SUMMED.get(name, ()) if c in df.columns]

    def count() -> list[Row]:
        return combinations(name, df).collect() if kinds else []

    def summarise() -> Row | None:
        return df.agg(*(F.struct(*spread(c, SHARES)).alias(c) for c in summed)).first() if summed else None

    rows, summary = together(df.sparkSession, count, summarise)
    for kind in kinds:
        found: dict[str, dict[str, int]] = {}
        for r in rows:
            if r["kind"] == kind:
                found.setdefault(r["counter"], {})[r["value"]] = r["n"]
        out[kind] = found
    if name in SUMMED:
        out["summaries"] = {c: summary[c].asDict() for c in summed}
    return out


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def out_of_order(df: DataFrame, partition: str, *order: str) -> DataFrame:
    """Rows that do not follow the one before them strictly: within ``partition``, they repeat its ``order`` columns."""
    window = Window.partitionBy(partition).orderBy(*order)
    same = F.lit(True)
    for c in order:
        same = same & F.lag(c).over(window).eqNullSafe(F.col(c))
    return df.withColumn("__repeats", same & (F.row_number().over(window) > 1)).where("__repeats").drop("__repeats")


def profile(preprocessed: DataFrame) -> DataFrame:
    """(measure, value, n): rows, null sources, routes and normalised lengths."""
    one = lambda m, c: preprocessed.groupBy(F.lit(m).alias("measure"), c.cast("string").alias("value")).agg(F.count("*").alias("n"))
    nulls = preprocessed.agg(F.count_if(F.col("nombre_original").isNull()).alias("n")).select(F.lit("null_source_values").alias("measure"), F.lit("").alias("value"), "n")
    return one("rows", F.lit("")).unionByName(nulls).unionByName(one("route", F.col("route"))).unionByName(one("normalized_length", F.col("normalized_length")))

"""A deterministic feed of made-up names, for demonstrations and load tests of any size.

Every value depends on a hash of its row number alone, so partitions are generated independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Parts of names, statuses, addresses, ways of leaving a value out, and the shares of kinds and variants.
HEADS = ("BANCO", "GRUPO", "CLINICA", "CONSTRUCTORA", "HOTEL", "FARMACIA", "COLEGIO", "TRANSPORTE", "AGRO", "SOFTWARE")
MIDDLES = ("ISTMO", "PACIFICO", "CARIBE", "CENTRAL", "NACIONAL", "AURORA", "ESTRELLA", "HORIZONTE", "COLINAS", "ALBORADA")
TAILS = ("DEL NORTE", "DEL SUR", "INTERNACIONAL", "UNIDOS", "HERMANOS", "ASOCIADOS", "PREMIER", "GLOBAL")
STATUSES = ("ESTUDIANTE", "JUBILADO", "AMA DE CASA", "NO LABORA", "DESEMPLEADA")
PLACES = ("CALLE 50", "AVENIDA BALBOA EDIFICIO 7", "PLAZA CENTRAL", "VIA ESPANA")
NOTHING = (None, "", "NA", "SIN INFORMACION", "12345")
KINDS = (78, 7, 5, 6, 4)  # names, statuses, addresses, nothing, names of people
VARIANTS = (20, 15, 13, 18, 9, 7, 10, 8)


def pick(choices: tuple, seed: int) -> Column:
    return F.element_at(F.array(*(F.lit(c).cast("string") for c in choices)), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(len(choices))).cast("int") + 1)


def weighted(weights: tuple[int, ...], seed: int, *results: Column) -> Column:
    """One of ``results``, each with its share."""
    draw, total, out = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(sum(weights))), sum(weights), results[-1]
    for weight, result in reversed(list(zip(weights, results, strict=True))):
        total -= weight
        out = F.when((draw >= total) & (draw < total + weight), result).otherwise(out)
    return out


def names(spark: SparkSession, rows: int, seed: int = 20260818, partitions: int | None = None) -> DataFrame:
    """(source_row_number, nombre_original), numbered from 2; about a fifth as many names as rows."""
    row = spark.range(0, rows, 1, partitions).withColumn("row", F.col("id")).withColumn("id", F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(max(1, rows // 5))))
    base = F.concat_ws(" ", pick(HEADS, 1), pick(MIDDLES, 2), pick(TAILS, 3), F.col("id").cast("string"))
    named = row.withColumn("base", base).withColumn("id", F.col("row"))
    b = F.col("base")
    variant = weighted(
        VARIANTS, 5, b, F.concat(b, F.lit(" SA")), F.concat(b, F.lit(" S A")), F.regexp_replace(b, " ", "  "), F.lower(b), F.substring(b, 1, 30),
        F.concat(F.substring(b, 1, 7), F.substring(b, 9, 100)), F.concat(F.lit("'"), b),
    )
    value = weighted(KINDS, 4, variant, pick(STATUSES, 6), pick(PLACES, 7), pick(NOTHING, 8), F.concat(F.lit("INDEPENDIENTE "), b))
    return named.select((F.col("row") + 2).alias("source_row_number"), value.alias("nombre_original"))

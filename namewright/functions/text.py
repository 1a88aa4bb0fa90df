"""Name normalisation as Spark column expressions (N-1 to N-10)."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from namewright.config import Normalization

# Quotes and dashes that become ' " -.
QUOTES = {"'": "‘’ʼ`", '"': "“”", "-": "‐‑‒–—−"}
#: What Python's \s matches.
BLANKS = r"[\p{IsWhite_Space}\x{1c}-\x{1f}]+"


@F.pandas_udf(StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def nfkc(value: Column) -> Column:
    """Compatibility composition.  ASCII values, which it leaves as they are, never reach Python."""
    return F.when(value.rlike(r"^[\x00-\x7f]*\z"), value).otherwise(_nfkc(F.when(~value.rlike(r"^[\x00-\x7f]*\z"), value)))


def squeezed(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, BLANKS, " "))


def tokens(value: Column) -> Column:
    """Tokens between spaces; none for an empty value."""
    return F.filter(F.split(value, " "), lambda t: t != "")


def strict_name(value: Column, unicode_forms: bool = True) -> Column:
    bare = F.regexp_replace(value, "^'", "")
    bare = nfkc(bare) if unicode_forms else bare
    source, target = "".join(QUOTES.values()), "".join(k * len(v) for k, v in QUOTES.items())
    return squeezed(F.upper(F.translate(bare, source, target)))


def with_terminal_suffix(value: Column, aliases: dict[str, tuple[str, ...]]) -> Column:
    """The first configured variant that ends the value, in its canonical spelling; the value may be the suffix alone."""
    out = value
    for canonical, variants in reversed(list(aliases.items())):
        for variant in reversed(variants):
            pattern = f"(^| ){re.escape(' '.join(variant.upper().split()))}\\z".replace("\\ ", " ")
            out = F.when(value.rlike(pattern), F.regexp_replace(value, pattern, "$1" + canonical.upper())).otherwise(out)
    return out


def relaxed_name(strict: Column, aliases: dict[str, tuple[str, ...]]) -> Column:
    return with_terminal_suffix(squeezed(F.regexp_replace(strict, r"\p{P}", " ")), aliases)


def normalized(df: DataFrame, config: Normalization, column: str = "nombre_original", unicode_forms: bool = True) -> DataFrame:
    """``df`` with strict and relaxed names, the trailing-number candidate and the truncation flag."""
    df = df.withColumn("nombre_normalizado", strict_name(F.col(column), unicode_forms))
    strict = F.col("nombre_normalizado")
    number = F.regexp_extract(strict, r"(?:^| )(\p{Nd}+)\z", 1)
    before = F.rtrim(F.regexp_extract(strict, r"^(.*?) ?\p{Nd}+\z", 1))
    candidate = (number != "") & (before != "") & (F.length(number) <= config.trailing_numeric_candidate_max_digits)
    content = F.length(F.regexp_replace(F.col(column), "^'", ""))
    return df.select(
        "*",
        relaxed_name(strict, config.corporate_suffix_aliases).alias("nombre_matching"),
        F.coalesce(number != "", F.lit(False)).alias("has_trailing_numeric_token"),
        F.when(candidate, before).alias("trailing_numeric_candidate"),
        F.coalesce(content.isin(*config.possible_truncation_content_lengths), F.lit(False)).alias("possible_truncation"),
    )

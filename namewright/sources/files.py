"""Readers and writers: reference CSV files, Parquet stages, metrics, and the source contract."""

from __future__ import annotations

import csv
import io
import json
import os
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from namewright.operators.preprocess import checked

MASTER = "entity_id string, canonical_name string"
ALIASES = "entity_id string, alias_name string"
ENRICHMENT = "public_entity_id string, resolution_key string, canonical_name string, sector string, source_url string, validated_on string"


def read_csv(spark: SparkSession, path: str, schema: str, missing_ok: bool = False) -> DataFrame:
    """A CSV file with exactly the schema's header; a byte order mark is accepted, a missing file is empty if ``missing_ok``."""
    if not exists(spark, path):
        if missing_ok:
            return spark.createDataFrame([], schema)
        raise FileNotFoundError(path)
    names = [x.split()[0] for x in schema.split(", ")]
    head = spark.read.text(path).limit(1).collect()
    found = head[0][0].removeprefix("﻿").rstrip("\r").split(",") if head else []
    if [h.strip('"') for h in found] != names:
        raise ValueError(f"{path} must have the columns {names}, not {found}")
    rows = spark.read.csv(path, header=True, schema=schema, enforceSchema=True, multiLine=True, escape='"')
    blank = F.lit(False)
    for n in names:
        blank = blank | F.col(n).isNull() | (F.trim(n) == "")
    return checked(rows, blank, F.lit(f"blank value in {os.path.basename(path)}"))


def read_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The named columns of a stage's table; one that is missing is an error.

    A writer that died between the two renames of :func:`publish_table` leaves the table under its former name.
    """
    if not exists(spark, path) and exists(spark, path + FORMER):
        path += FORMER
    df = spark.read.parquet(path)
    if gone := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"{path} lacks the columns {gone}")
    return df.select(*columns) if columns else df


def distinct_paths(inputs: list[str], outputs: list[str]) -> None:
    """No output may be an input."""
    norm = {os.path.normpath(p) for p in inputs}
    if same := [p for p in outputs if os.path.normpath(p) in norm]:
        raise ValueError(f"output would overwrite an input: {same}")


FORMER = ".former"


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _store(spark, path)
    return store.exists(where)


def stage_table(df: DataFrame, path: str, codec: str = "zstd") -> str:
    """Write a table beside the place where it will be published, and return where it is until then."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    df.write.option("compression", codec).parquet(part)
    return part


def publish_table(spark: SparkSession, part: str, path: str) -> None:
    """Put a staged table in its place.  At every moment the old one or the new one can be read (:func:`read_parquet`)."""
    store, where = _store(spark, path)
    _, former = _store(spark, path + FORMER)
    _, source = _store(spark, part)
    if store.exists(where):
        store.delete(former, True)
        if not store.rename(where, former):
            raise OSError(f"could not set aside {path}")
    if not store.rename(source, where):
        raise OSError(f"could not publish {path}")
    store.delete(former, True)


def discard(spark: SparkSession, path: str) -> None:
    store, where = _store(spark, path)
    store.delete(where, True)


class Output:
    """A file in any store that Spark can write, published by one atomic rename once it is complete."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.store, self.path = _store(spark, path)
        _, self.part = _store(spark, f"{path}.tmp")
        self.out = self.store.create(self.part, True)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def publish(self) -> None:
        self.out.close()
        jvm = self.spark._jvm
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        full = self.store.makeQualified(self.path)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(full.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(self.store.makeQualified(self.part), full, options)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    out = Output(spark, path)
    out.write(text.encode())
    out.publish()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    if not exists(spark, path):
        return None
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def write_csv(df: DataFrame, path: str, order: list[str], mark: bool = True) -> None:
    """One CSV file of a small table (references, samples, reports), rows in order, streamed by partition.

    With ``mark`` it begins with a byte order mark, which spreadsheets expect.
    """
    out, text = Output(df.sparkSession, path), io.StringIO(newline="")
    rows = csv.writer(text)
    out.write(b"\xef\xbb\xbf" if mark else b"")
    rows.writerow(df.columns)
    for row in df.orderBy(*order).toLocalIterator():
        rows.writerow(["" if v is None else "|".join(v) if isinstance(v, list) else v for v in row])
        if text.tell() > 1 << 20:
            out.write(text.getvalue().encode())
            text.seek(0)
            text.truncate()
    out.write(text.getvalue().encode())
    out.publish()


def write_csv_table(df: DataFrame, path: str, order: list[str], mark: bool = True) -> None:
    """A large table as a folder of CSV files with a header each, rows in order over all of them; published as a whole.

    With ``mark`` each file begins with a byte order mark.  Lists are joined by "|".
    """
    flat = df.select(*(F.array_join(c, "|").alias(c) if isinstance(df.schema[c].dataType, ArrayType) else F.col(c) for c in df.columns))
    head = [("\ufeff" if mark and i == 0 else "") + c for i, c in enumerate(df.columns)]
    part = f"{path}.{uuid.uuid4().hex}.part"
    flat.orderBy(*order).toDF(*head).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(part)
    publish_table(df.sparkSession, part, path)


def write_json(spark: SparkSession, values: dict[str, Any], path: str) -> None:
    out = Output(spark, path)
    out.write(json.dumps(values, ensure_ascii=False, indent=2, sort_keys=True).encode())
    out.publish()

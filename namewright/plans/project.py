"""The stages of the command line over the feed: every table, CSV file and metrics file as a run of a project leaves them.

The project lies in the shared folder.  Its public catalogue names, of the entities that the run finds, those whose id begins with
``ENT-0``; two in a row share one public id, which joins their components.
"""

from __future__ import annotations

import dataclasses
import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namewright.operators import finalize, stages
from namewright.plans.feed import CONFIG, alias_references, feed, master_references, state_of, table
from namewright.sources import files, workbook
from namewright.sources.shared import shared_dir, together

SETTINGS = dataclasses.replace(CONFIG, source=dataclasses.replace(CONFIG.source, workbook="table"))


def public_catalogue(parts: DataFrame) -> DataFrame:
    """The catalogue over the components of a run.  Public ids have six digits, so it is a small table by nature."""
    own = parts.where("entity_id like 'ENT-0%'").select("component", "canonical_resolution_key").distinct()
    numbered = own.withColumn("n", F.floor((F.row_number().over(Window.orderBy("component")) - 1) / 2))
    keys = numbered.select("n", F.col("canonical_resolution_key").alias("resolution_key")).union(numbered.select("n", "component")).distinct()
    text = F.col("n").cast("string")
    return keys.select(
        F.concat(F.lit("PUB-"), F.lpad(text, 6, "0")).alias("public_entity_id"), "resolution_key",
        F.concat(F.min("resolution_key").over(Window.partitionBy("n")), F.lit(" PUBLICA")).alias("canonical_name"),
        F.when(F.col("n") % 2 == 0, "Educación").otherwise("Finanzas").alias("sector"), F.concat(F.lit("https://example.org/"), text).alias("source_url"), F.lit("2024-01-15").alias("validated_on"),
    )


def dealt(df: DataFrame) -> DataFrame:
    """Rows of a file or two spread over all cores: names are made of them by dozens of string functions each."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


class Project:
    """A project folder whose stages run when a query first needs them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.store = stages.Store(spark, shared_dir(spark), SETTINGS)
        self.done: list[str] = []

    def begin(self) -> None:
        source = self.store.path("source")
        masters, names = master_references(self.spark, self.sf_dir), alias_references(self.spark, self.sf_dir)
        together(
            self.spark,
            lambda: files.publish_table(self.spark, files.stage_table(feed(self.spark, self.sf_dir, dealt), source), source),
            lambda: files.write_csv(masters, self.store.reference("employer_master"), ["entity_id"]),
            lambda: files.write_csv(names, self.store.reference("employer_aliases"), ["alias_name"]),
        )

    def catalogue(self) -> None:
        s = self.store
        parts = finalize.components(s.read("resolution_keys"), s.read("employer_eligibility"), s.read("pair_resolution_decisions"), s.settings)
        files.write_csv(public_catalogue(parts), f"{s.root}/reference/public_employer_enrichment.csv", ["resolution_key"])

    def needed(self, stage: str) -> list[str]:
        """``stage`` and all stages whose tables it reads, in the order of the command line."""
        found = {stage}.union(*(self.needed(n) for n in stages.NEEDS[stage]))
        return [n for n in stages.STAGES if n in found]

    def upto(self, stage: str) -> stages.Store:
        """The store after ``stage`` and all that it needs; stages that it reads nothing of are left for when they are asked for.

        Stages that only wait for tables that are there run side by side.
        """
        while stage not in self.done:
            ready = [n for n in self.needed(stage) if n not in self.done and all(m in self.done for m in stages.NEEDS[n])]
            if "preprocess" in ready:
                self.begin()
            if "finalize" in ready:
                self.catalogue()
            together(self.spark, *(functools.partial(stages.STAGES[n], self.store) for n in ready))
            self.done += ready
        return self.store

    def again(self) -> DataFrame:
        """What the next run resolves with the promoted references, read from the version that the pointer names."""
        store = self.upto("promote-references")
        return stages.preprocess.resolve(store.read("preprocessed"), stages.preprocess.exact_index(*store.references()))

    def csv(self, name: str) -> DataFrame:
        """A table written as CSV files, read back as text."""
        return self.csv_file(f"output/{name}.csv")

    def csv_file(self, path: str) -> DataFrame:
        rows = self.spark.read.csv(f"{self.store.root}/{path}", header=True, multiLine=True, escape='"')
        return rows.toDF(*(c.removeprefix("﻿") for c in rows.columns))

    def metrics(self, name: str) -> DataFrame:
        """(counter, value, n) of a stage's metrics file."""
        raw = self.spark.read.text(f"{self.store.root}/metrics/{name}.json", wholetext=True)
        found = raw.select(F.explode(F.from_json("value", "counters map<string,map<string,long>>")["counters"]).alias("counter", "values"))
        return found.select("counter", F.explode("values").alias("value", "n"))


_projects: dict[tuple, Project] = {}


def project_of(spark: SparkSession, sf_dir: str) -> Project:
    key = (spark.sparkContext.applicationId, sf_dir, state_of(spark, sf_dir))
    if key not in _projects:
        _projects[key] = Project(spark, sf_dir)
    return _projects[key]


def forget() -> None:
    _projects.clear()


# ---- names that are not plain ASCII ---------------------------------------------------------------------------------

WIDE = "".join(chr(0xFF21 + k) for k in range(26))
PLAIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE = "'CAFÉ CENTRAL ' || chr(CAST(65 + s_suppkey % 26 AS INT)) || chr(CAST(65 + s_suppkey % 7 AS INT))"
STRANGE = (
    "'‘' || b || '’'", "b || ' — NORTE'", f"translate(b, '{PLAIN}', '{WIDE}')", "'ﬁnca ' || b", "b || ' №5'", "b || ' SA'", "'“' || b || '” S.A.'", "'NO LABORA EN NINGUNA EMPRESA'",
    "'NO TRABAJA EN EMPRESA'", "b || ' ①'", "'Ñandú ' || b", "b || '²'", "b || ' ‐ 7'", "'ACTUALMENTE NO TRABAJA EN LA EMPRESA'", "'EMPRESA ' || b", "'NO LABORA'", "b || '  S A'", "'``' || b",
)


def strange_sql() -> str:
    """SELECT of (source_row_number, nombre_original) over view supplier, for both engines."""
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(STRANGE))
    return f"SELECT CAST(s_suppkey + 1 AS BIGINT) AS source_row_number, CASE CAST(s_suppkey % {len(STRANGE)} AS INT) {cases} END AS nombre_original FROM (SELECT s_suppkey, {BASE} AS b FROM supplier) AS base"


#: Names that the quality gate must tell apart: control characters, the replacement character, numbers behind suffixes.
MARKED = ("b || '\x07'", "b || '�'", "b || ' SA 1'", "b || ' 9'", "b", "b || ' s  a 22'", "b || '\x85x'")


def marked_sql() -> str:
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(MARKED))
    status = "CASE CAST(s_suppkey % 3 AS INT) WHEN 0 THEN 'PUBLIC_VALIDATED' WHEN 1 THEN 'AUTO_CANONICALIZED' ELSE 'NORMALIZED_CANDIDATE' END"
    return f"SELECT 'ENT-' || lpad(CAST(s_suppkey AS {{s}}), 16, '0') AS entity_id, CASE CAST(s_suppkey % {len(MARKED)} AS INT) {cases} END AS canonical_name, {status} AS resolution_status, CAST(92 AS INT) AS confidence_score FROM (SELECT s_suppkey, {BASE} AS b FROM supplier) AS base"


def over_suppliers(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("FROM supplier)", "FROM {supplier})"), supplier=table(spark, sf_dir, "supplier"))


def workbook_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names over the suppliers, written as a workbook, checked against its contract and read back."""
    path = shared_dir(spark) + "/names.xlsx"
    workbook.write(spark, over_suppliers(spark, sf_dir, strange_sql()).orderBy("source_row_number").select("nombre_original"), path, CONFIG.source)
    digest = workbook.validate(spark, path, CONFIG.source)
    return workbook.read(spark, path, CONFIG.source.sheet_name).withColumn("digest_size", F.lit(len(digest)))

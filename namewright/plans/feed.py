"""A feed of organisation-like names over the test tables.

The tables hold no names, so part names and the opening words of all documents stand in for them, with deterministic variants
by row: suffixes, digits, typos, doubled spaces, dashes, apostrophes, cut names, statuses, addresses and missing values.
The expressions are SQL that both engines read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from namewright.config import Settings
from namewright.functions.evidence import distinctive, employer_cores, multi_evidence, orthographic, residual, token_support
from namewright.functions.pairs import decide, features
from namewright.operators import eligibility as eligible
from namewright.operators import finalize as final
from namewright.operators import master as masters
from namewright.operators import preprocess as pre
from namewright.operators.blocking import candidate_pairs
from namewright.operators.graph import kept

PART = "upper(p_name) || ' ' || p_type || ' ' || upper(p_brand)"
#: A document's name is its opening words: the letters of A to Z of its first sixty characters; all else parts words.  Only ASCII is
#: turned into capitals, as the two engines differ on some other letters.
WORDS = "trim(regexp_replace(upper(regexp_replace(substr(text, 1, 60), '[^ -~]+', ' '{g})), '[^A-Z]+', ' '{g}))"
#: Variants by the remainder of id / 24, on a base name b.
VARIANTS = (
    "b", "b || ' SA'", "b || ' S A'", "b || ' 7'", "substr(b, 1, 7) || substr(b, 9)", "replace(b, ' ', '  ')", "replace(b, ' ', '-')",
    "'''' || b", "substr(b, 1, 30)", "lower(b)", "b || ' HOLDING INC'", "replace(b, ' ', '')", "b || ', S.A.'", "'GRUPO ' || b", "b || ' 2024'",
    "CASE id % 7 WHEN 0 THEN 'ESTUDIANTE' WHEN 1 THEN 'AMA DE CASA' WHEN 2 THEN 'NO LABORA' WHEN 3 THEN 'JUBILADO MEDICO' WHEN 4 THEN 'ACTUALMENTE NO TRABAJA' WHEN 5 THEN 'SIN EMPLEO' ELSE 'CESANTE' END",
    "CASE id % 5 WHEN 0 THEN 'CALLE ' || CAST(id AS STRING) WHEN 1 THEN 'PLAZA CENTRAL' WHEN 2 THEN '548 MARKET ST 18590 CA SAN FRANCISCO' WHEN 3 THEN 'AVENIDA BALBOA EDIFICIO ' || substr(b, 1, 9) ELSE 'VIA ESPANA CON CALLE 50' END",
    "CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'N A' WHEN 3 THEN 'SIN INFORMACION' WHEN 4 THEN '12345' ELSE 'NINGUNO' END",
    "'BANCO ' || b", "b || ' Y ' || substr(b, 1, 5)", "substr(b, 4)", "b || ' TRADE LLC'", "'AGRICULTOR ' || substr(b, 1, 6)", "b || ' S A'",
)


def feed_sql(spark: bool) -> str:
    """SELECT of (source_row_number, nombre_original) over views part and documents."""
    words = WORDS.format(g="" if spark else ", 'g'")
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(VARIANTS))
    kind = "STRING" if spark else "VARCHAR"
    # Each name occurs in its variant; two of three also as they are.  "twice" has two rows.
    return (
        "SELECT CAST(2 * id + plain + 2 AS BIGINT) AS source_row_number, CASE CASE WHEN plain = 1 THEN 0 ELSE CAST(id % 24 AS INT) END "
        + cases.replace("STRING", kind) + " END AS nombre_original FROM ("
        f"SELECT 2 * p_partkey AS id, {PART} AS b FROM part UNION ALL SELECT 2 * doc_id + 1 AS id, {words} AS b FROM documents) AS base "
        "CROSS JOIN (SELECT 0 AS plain UNION ALL SELECT 1) AS twice WHERE plain = 0 OR id % 3 <> 0"
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def state_of(spark: SparkSession, sf_dir: str) -> tuple:
    """Sizes and times of the files that the linkage queries read: what is remembered of a folder holds while these do."""
    out = []
    for name in ("part", "documents", "supplier"):
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        store = where.getFileSystem(spark._jsc.hadoopConfiguration())
        for f in store.listStatus(where) if store.exists(where) else ():
            out.append((f.getPath().getName(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def feed(spark: SparkSession, sf_dir: str, dealt: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The rows of the feed; ``dealt`` may spread those of part and of documents (of whose texts only the beginnings are read) first."""
    parts = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand"))
    documents = dealt(table(spark, sf_dir, "documents").selectExpr("doc_id", "substr(text, 1, 60) AS text"))
    return spark.sql(feed_sql(True).replace("FROM part ", "FROM {part} ").replace("FROM documents)", "FROM {documents})"), part=parts, documents=documents)


#: The check's SQL of the references, for keys below a million; :func:`master_references` has no such bound.
MASTER_SQL = "SELECT 'EMP-' || lpad(CAST(p_partkey AS {s}), 6, '0') AS entity_id, {part} AS canonical_name FROM part WHERE p_partkey % 40 = 0 AND p_partkey < 1000000"


def master_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fortieth part name is a known entity, if no earlier one has its name.

    EMP ids have exactly six digits (the reference accepts no others); keys that need more get an ENT id, their 16 hex digits.
    """
    parts = table(spark, sf_dir, "part").where("p_partkey % 40 = 0").selectExpr("CAST(p_partkey AS BIGINT) AS p_partkey", f"{PART} AS canonical_name")
    first = parts.groupBy("canonical_name").agg({"p_partkey": "min"}).toDF("canonical_name", "key")
    entity = "CASE WHEN key BETWEEN 0 AND 999999 THEN 'EMP-' || lpad(CAST(key AS STRING), 6, '0') ELSE 'ENT-' || lpad(hex(key), 16, '0') END"
    return first.selectExpr(f"{entity} AS entity_id", "canonical_name")


def alias_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master_references(spark, sf_dir).selectExpr("entity_id", "canonical_name || ' SA' AS alias_name")


CONFIG = Settings()


class Run:
    """All stages over the feed.  Stages that several later ones read are written once to the shared folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings = CONFIG):
        self.spark, self.sf_dir, self.settings = spark, sf_dir, settings
        self.made: dict[str, DataFrame] = {}

    def stage(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = getattr(self, name)()
        return self.made[name]

    def preprocessed(self) -> DataFrame:
        return pre.preprocess(feed(self.spark, self.sf_dir), self.settings)

    def index(self) -> DataFrame:
        return pre.exact_index(master_references(self.spark, self.sf_dir), alias_references(self.spark, self.sf_dir))

    def resolved(self) -> DataFrame:
        return pre.resolve(self.stage("preprocessed"), self.stage("index"))

    def keys(self) -> DataFrame:
        return kept(pre.resolution_keys(self.stage("resolved")))

    def pairs(self) -> DataFrame:
        return kept(candidate_pairs(self.stage("keys"), self.settings.candidates))

    def scored(self) -> DataFrame:
        return features(self.stage("pairs"), with_ratios=False)

    def decisions(self) -> DataFrame:
        return decide(self.stage("scored"), self.stage("keys"), self.settings)

    def eligibility(self) -> DataFrame:
        return eligible.classify(self.stage("preprocessed"), self.stage("keys"), self.settings)

    def universe(self) -> tuple[DataFrame, DataFrame]:
        """Employer cores and the support of their tokens."""
        cores = kept(employer_cores(self.stage("keys"), self.stage("eligibility"), self.settings))
        return cores, kept(token_support(cores))

    def orthographic(self) -> DataFrame:
        open_pairs = kept(self.stage("decisions").where("decision_status <> 'AUTO_SAME'").select("key_a", "key_b", "name_a", "name_b", "numeric_relation"))
        return kept(orthographic(open_pairs, self.stage("keys"), self.stage("eligibility"), self.settings, self.stage("universe")))

    def further(self) -> DataFrame:
        return self.stage("orthographic").where("orthographic_status = 'NEEDS_FURTHER_RESOLUTION'").select("key_a", "key_b", "name_a", "name_b", "numeric_relation", "orthographic_evidence")

    def residual(self) -> DataFrame:
        return residual(self.stage("further"), self.stage("keys"), self.settings)

    def distinctive(self) -> DataFrame:
        pairs = self.stage("further").select("key_a", "key_b", "name_a", "name_b")
        return distinctive(pairs, self.stage("keys"), self.stage("eligibility"), self.settings, self.stage("universe"))

    def assessed(self) -> DataFrame:
        rare = self.stage("distinctive").drop("name_a", "name_b", "shared_exact_token_count")
        return multi_evidence(self.stage("residual").join(rare, ["key_a", "key_b"]))

    def parts(self) -> DataFrame:
        return kept(final.components(self.stage("keys"), self.stage("eligibility"), self.stage("decisions"), self.settings))

    def final(self) -> DataFrame:
        reuse = final.exact_reuse(self.stage("resolved"), self.settings)
        return kept(final.finalize(self.stage("resolved"), self.stage("eligibility"), self.stage("parts"), reuse))

    def master(self) -> DataFrame:
        return kept(masters.corporate_master(self.stage("final")))

    def aliases(self) -> DataFrame:
        return masters.alias_dictionary(self.stage("final"), self.stage("master"), self.stage("keys"))

    def quality(self) -> DataFrame:
        return masters.canonical_quality(self.stage("master"))

    def promoted(self) -> tuple[DataFrame, DataFrame]:
        old = master_references(self.spark, self.sf_dir), alias_references(self.spark, self.sf_dir)
        new = masters.promote(self.stage("master"), self.stage("quality"), self.stage("aliases"), *old)
        return kept(new[0]), kept(new[1])

    def second(self) -> Run:
        """The next run, which knows what this one promoted."""
        again = Run(self.spark, self.sf_dir, self.settings)
        again.made["preprocessed"] = self.stage("preprocessed")
        again.made["index"] = pre.exact_index(*self.stage("promoted"))
        return again


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)

"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.
The result of a stage is written and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm import jaccard_join, langid, packing, secrets
from namewright.llm.storage import drop, keep

#: Texts are rejected whose best language stands out from chance by less than this share of the way to certainty.
LEAST_LEAD = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in which a language is found: texts without letters, and those that fit no language, go.

    The score of a text is the mean probability of its best language, for n learned languages 1 / n by chance.
    """
    model = langid.train(docs.where(~langid.held_out()))
    chance = 1 / max(1, len(model.languages))
    found = langid.identify(docs, model, keep_columns=tuple(docs.columns), names=("__language", "__score"))
    return found.where((F.col("__language") != langid.UNKNOWN) & (F.col("__score") >= chance + LEAST_LEAD * (1 - chance))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of linked documents.

    Rows are what is grouped, not ids: rows that share an id and differ in their texts are documents each, and rows without an
    id stand behind all others of their group.  Documents without words are in no group and stay.
    """
    keyed = keep(docs.withColumn("__row", F.monotonically_increasing_id()))
    groups = jaccard_join.near_groups(keyed, id_col="__row", carry="doc_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    chosen = keep(groups.groupBy("component_id").agg(first).select(F.col("first.row").alias("__row")))
    drop(groups)
    # The chosen rows grow with the table, so they are never broadcast; the join is of one kind at every size.
    return keyed.join(chosen.hint("merge"), "__row", "left_semi").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in place of every secret; no document goes."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 ids; the ids come along as little-endian uint32."""
    return packing.pack_documents(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to", "ids"
    )


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: No SQL: the models and the tokenizer can't be expressed in it.  Tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, keep(stage(spark, docs, sf_dir))
        drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)

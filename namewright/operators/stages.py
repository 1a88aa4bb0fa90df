"""Stages over stored tables: each reads its inputs, checks them, writes its output and returns counts (C-1 to C-16)."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.config import Settings
from namewright.functions import evidence
from namewright.functions.pairs import decide, features
from namewright.operators import blocking, eligibility, finalize, master, preprocess, profile, sampling
from namewright.sources import files, workbook
from namewright.sources.shared import together

Counts = dict[str, object]


@dataclass(frozen=True)
class Store:
    """Where the tables of a project are; every name is a folder of Parquet files below ``root``."""

    spark: SparkSession
    root: str
    settings: Settings

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, *columns: str) -> DataFrame:
        return files.read_parquet(self.spark, self.path(name), *columns)

    def version(self) -> str | None:
        """The folder of the current references: one pointer names both files, so they always belong together."""
        text = files.read_text(self.spark, f"{self.root}/reference/CURRENT")
        return text.strip() if text else None

    def reference(self, name: str, version: str | None = None) -> str:
        folder = version or self.version()
        return f"{self.root}/reference/{folder + '/' if folder else ''}{name}.csv"

    def references(self, missing_ok: bool = False) -> tuple[DataFrame, DataFrame]:
        """Master and alias references.  A missing file is an error; only promotion may begin with nothing."""
        return (
            files.read_csv(self.spark, self.reference("employer_master"), files.MASTER, missing_ok),
            files.read_csv(self.spark, self.reference("employer_aliases"), files.ALIASES, missing_ok),
        )

    def catalogue(self) -> DataFrame:
        return files.read_csv(self.spark, f"{self.root}/reference/public_employer_enrichment.csv", files.ENRICHMENT, missing_ok=True)

    def write(self, df: DataFrame, name: str, *key: str, inputs: tuple[str, ...] = ()) -> Counts:
        """Write a table beside its place, check what was written (the key is unique and not null), then publish it with its metrics."""
        began = time.time()
        files.distinct_paths([self.path(i) for i in inputs], [self.path(name)])
        part = files.stage_table(df, self.path(name))
        done = files.read_parquet(self.spark, part)
        try:
            (total, distinct, missing), measured = together(self.spark, lambda: key_counts(done, *key), lambda: profile.metrics(name, done))
        except Exception:
            files.discard(self.spark, part)
            raise
        if missing or distinct != total:
            files.discard(self.spark, part)
            raise ValueError(f"{name}: {total} rows, {distinct} distinct keys, {missing} null keys")
        files.publish_table(self.spark, part, self.path(name))
        counts = {"table": name, "rows": total, "seconds": round(time.time() - began, 3), "settings": self.settings.fingerprint()}
        files.write_json(self.spark, counts | measured, f"{self.root}/metrics/{name}.json")
        return counts


def key_counts(df: DataFrame, *key: str) -> tuple[int, int, int]:
    """Rows, distinct keys without nulls, and rows with a null in the key.

    As many distinct hashes as rows prove that all keys differ, and hashes are cheaper to compare than keys; only where there are fewer,
    the keys themselves are counted.
    """
    null = F.greatest(*(F.col(k).isNull().cast("int") for k in (*key, key[0]))) == 1
    total, hashes, missing = df.agg(F.count("*"), F.count_distinct(F.xxhash64(*key)), F.count_if(null)).first()
    if hashes == total and not missing:
        return total, total, 0
    return total, df.agg(F.count_distinct(*key)).first()[0], missing


def ingest(s: Store) -> Counts:
    """Source workbook (or, without one, the stored ``source`` table) to ``preprocessed``."""
    path = s.settings.source.workbook
    if path.endswith(".xlsx"):
        digest = workbook.validate(s.spark, path, s.settings.source)
        rows = workbook.read(s.spark, path, s.settings.source.sheet_name)
    else:
        digest, rows = "0" * 64, s.read("source", "source_row_number", "nombre_original")
    return s.write(preprocess.preprocess(rows, s.settings, digest), "preprocessed", "record_id", inputs=("source",))


def resolve(s: Store) -> Counts:
    return s.write(preprocess.resolve(s.read("preprocessed"), preprocess.exact_index(*s.references())), "resolved", "record_id", inputs=("preprocessed",))


def candidates(s: Store) -> Counts:
    keys = s.write(preprocess.resolution_keys(s.read("resolved")), "resolution_keys", "resolution_key", inputs=("resolved",))
    pairs = s.write(blocking.candidate_pairs(s.read("resolution_keys"), s.settings.candidates), "candidate_pairs", "key_a", "key_b", inputs=("resolution_keys",))
    return pairs | {"keys": keys["rows"]}


def score(s: Store) -> Counts:
    return s.write(features(s.read("candidate_pairs")), "candidate_pair_features", "key_a", "key_b", inputs=("candidate_pairs",))


def decide_pairs(s: Store) -> Counts:
    decided = decide(s.read("candidate_pair_features"), s.read("resolution_keys"), s.settings)
    return s.write(decided.select("key_a", "key_b", "name_a", "name_b", "blocking_methods", "decision_status", "decision_rule", "decision_evidence"), "pair_resolution_decisions", "key_a", "key_b")


def classify(s: Store) -> Counts:
    return s.write(eligibility.classify(s.read("preprocessed"), s.read("resolution_keys"), s.settings), "employer_eligibility", "resolution_key")


def aligned(left: DataFrame, right: DataFrame, *key: str) -> None:
    """Both tables hold the same keys, each once."""
    mark = lambda df, n: df.select(*key).withColumn(n, F.lit(1))
    one = mark(left, "l").unionByName(mark(right, "r"), allowMissingColumns=True).groupBy(*key).agg(F.count("l").alias("l"), F.count("r").alias("r"))
    if not one.where("l <> 1 or r <> 1").isEmpty():
        raise ValueError(f"tables disagree on {', '.join(key)}")


def resolve_orthographic(s: Store) -> Counts:
    scored, decisions = s.read("candidate_pair_features"), s.read("pair_resolution_decisions")
    open_pairs = scored.join(decisions.where("decision_status <> 'AUTO_SAME'").select("key_a", "key_b"), ["key_a", "key_b"], "left_semi")
    pairs = open_pairs.select("key_a", "key_b", "name_a", "name_b", "blocking_methods", "numeric_relation")
    keys, status = s.read("resolution_keys"), s.read("employer_eligibility")
    *_, found = together(
        s.spark,
        lambda: aligned(scored, decisions, "key_a", "key_b"),
        lambda: aligned(keys, status, "resolution_key"),
        lambda: evidence.orthographic(pairs, keys, status, s.settings),
    )
    return s.write(found, "orthographic_pair_decisions", "key_a", "key_b")


def profile_residuals(s: Store) -> Counts:
    pairs = s.read("orthographic_pair_decisions").where("orthographic_status = 'NEEDS_FURTHER_RESOLUTION'")
    pairs = pairs.select("key_a", "key_b", "name_a", "name_b", "blocking_methods", "numeric_relation", "orthographic_evidence")
    return s.write(evidence.residual(pairs, s.read("resolution_keys"), s.settings), "residual_relationship_profile", "key_a", "key_b")


def distinctive(s: Store) -> Counts:
    pairs = s.read("residual_relationship_profile", "key_a", "key_b", "name_a", "name_b")
    return s.write(evidence.distinctive(pairs, s.read("resolution_keys"), s.read("employer_eligibility"), s.settings), "distinctive_name_evidence", "key_a", "key_b")


#: What the four tables of a pair have to agree on, beside its key.
SHARED = ("name_a", "name_b", "blocking_methods", "numeric_relation")


def consistent(shape: DataFrame, rare: DataFrame, scored: DataFrame, spelled: DataFrame) -> DataFrame:
    """Residual and distinctive rows side by side, checked against features and orthographic decisions.

    Both hold the same pairs; each of these is among the scored and the orthographic ones; names, methods, numeric relation, status,
    evidence, token counts and flags agree.
    """
    aligned(shape, rare, "key_a", "key_b")
    key = ["key_a", "key_b"]
    struct = lambda df, name: df.select(*key, F.struct(*(c for c in df.columns if c not in key)).alias(name))
    df = shape.join(struct(rare, "r"), key).join(struct(scored, "f"), key, "left").join(struct(spelled, "o"), key, "left")
    differ = lambda a, b: ~a.eqNullSafe(b)
    c = F.col
    checks = {
        "no features": c("f").isNull(),
        "no orthographic decision": c("o").isNull(),
        "identity": differ(c("name_a"), c("r.name_a")) | differ(c("name_b"), c("r.name_b")),
        "status": c("o.orthographic_status") != "NEEDS_FURTHER_RESOLUTION",
        "evidence": differ(c("orthographic_evidence"), c("o.orthographic_evidence")),
        "token counts": differ(c("shared_exact_token_count"), c("r.shared_exact_token_count")),
        "overlap flags": (c("r.has_shared_exact_token") != (c("shared_exact_token_count") > 0)) | (c("r.has_shared_distinctive_token") != (c("r.shared_distinctive_token_count") > 0)),
    }
    for n in SHARED:
        for side, table in (("f", scored), ("o", spelled)):
            if n in shape.columns and n in table.columns:
                checks[f"{n} of {side}"] = differ(c(n), c(f"{side}.{n}"))
    for what, wrong in checks.items():
        df = preprocess.checked(df, wrong, F.concat(F.lit(f"tables disagree on {what} for "), "key_a", F.lit(" / "), "key_b"))
    return df.select(*shape.columns, *(c(f"r.{n}").alias(n) for n in rare.columns if n not in shape.columns))


def assess(s: Store) -> Counts:
    tables = ("residual_relationship_profile", "distinctive_name_evidence", "candidate_pair_features", "orthographic_pair_decisions")
    both = consistent(*(s.read(t) for t in tables))
    return s.write(evidence.multi_evidence(both), "multi_evidence_assessment", "key_a", "key_b", inputs=tables)


def finalize_rows(s: Store) -> Counts:
    resolved, keys, status = s.read("resolved"), s.read("resolution_keys"), s.read("employer_eligibility")
    aligned(keys, status, "resolution_key")
    catalogue = s.catalogue()
    exact = resolved.where("resolution_status = 'resolved'").select("entity_id")
    public = finalize.usable_links(catalogue, keys, status, exact)
    parts = finalize.components(keys, status, s.read("pair_resolution_decisions"), s.settings, public)
    final = finalize.finalize(resolved, status, parts, finalize.exact_reuse(resolved, s.settings, catalogue))
    counts = s.write(final, "employer_resolution_final", "record_id")
    before = profile.fingerprint(resolved, "record_id", "source_row_number", "nombre_original", "nombre_normalizado", "route", "route_reason").first()
    after = profile.fingerprint(s.read("employer_resolution_final"), "record_id", "source_row_number", "nombre_original", "nombre_normalizado", "route", "route_reason").first()
    if before != after:
        raise ValueError("source rows changed on the way")
    files.write_csv_table(s.read("employer_resolution_final"), f"{s.root}/output/employer_resolution_final.csv", ["source_row_number"])
    files.write_csv(finalize.top_keys(final, keys, s.settings.top_key_limit), f"{s.root}/output/top_keys.csv", ["resolution_key"])
    return counts


def build_master(s: Store) -> Counts:
    final = s.read("employer_resolution_final")
    counts = s.write(master.corporate_master(final), "corporate_master", "entity_id")
    s.write(master.alias_dictionary(final, s.read("corporate_master"), s.read("resolution_keys")), "corporate_aliases", "entity_id", "resolution_key")
    master.alias_rollup(s.read("corporate_aliases"), s.read("corporate_master")).count()
    files.write_csv_table(s.read("corporate_master"), f"{s.root}/output/corporate_master.csv", ["entity_id"])
    files.write_csv_table(s.read("corporate_aliases"), f"{s.root}/output/corporate_aliases.csv", ["entity_id", "resolution_key"])
    return counts


def assess_quality(s: Store) -> Counts:
    counts = s.write(master.unique_entities(master.canonical_quality(s.read("corporate_master"))), "canonical_quality", "entity_id", inputs=("corporate_master",))
    files.write_csv_table(s.read("canonical_quality"), f"{s.root}/output/canonical_quality.csv", ["entity_id"], mark=False)
    return counts


def promote(s: Store) -> Counts:
    """Write the next version of both reference files into a folder of its own; then one pointer is replaced."""
    new = master.promote(s.read("corporate_master"), s.read("canonical_quality"), s.read("corporate_aliases"), *s.references(missing_ok=True))
    version = uuid.uuid4().hex
    for df, name, order in zip(new, ("employer_master", "employer_aliases"), ("entity_id", "alias_name"), strict=True):
        files.write_csv(df, s.reference(name, version), [order])
    # What was written has to load before it is made current.
    written = [files.read_csv(s.spark, s.reference(n, version), k) for n, k in (("employer_master", files.MASTER), ("employer_aliases", files.ALIASES))]
    rows = preprocess.exact_index(*written).count()
    files.write_text(s.spark, version, f"{s.root}/reference/CURRENT")
    return {"table": "reference", "rows": written[0].count(), "names": rows}


def review_sample(s: Store) -> Counts:
    pairs = sampling.review_pairs(s.read("candidate_pair_features"), s.settings.pair_sample_size, s.settings.random_seed)
    zero = sampling.zero_candidate_keys(s.read("resolution_keys"), s.read("candidate_pairs"))
    misses = sampling.blocking_misses(zero, s.settings.blocking_miss_sample_size, s.settings.random_seed)
    blank = [F.lit("").alias(n) for n in ("reviewed_label", "reviewer_notes")]
    where = f"{s.root}/evaluation"
    files.write_csv(pairs.select("*", *blank), f"{where}/pair_review.csv", ["sample_id"])
    files.write_csv(misses.select("*", *blank), f"{where}/blocking_audit.csv", ["sample_id"])
    return {"table": "evaluation", "rows": pairs.count() + misses.count()}


def development_sample(s: Store) -> Counts:
    return s.write(sampling.evaluation_sample(s.read("preprocessed"), seed=s.settings.random_seed), "evaluation_sample", "record_id")


STAGES: dict[str, Callable[[Store], Counts]] = {
    "preprocess": ingest, "resolve": resolve, "candidates": candidates, "score-candidates": score, "decide-pairs": decide_pairs,
    "classify-eligibility": classify, "resolve-orthographic": resolve_orthographic, "profile-residuals": profile_residuals,
    "compute-distinctive-evidence": distinctive, "assess-evidence": assess, "finalize": finalize_rows, "build-corporate-master": build_master,
    "canonical-quality": assess_quality, "promote-references": promote, "build-evaluation-sample": review_sample, "evaluation-sample": development_sample,
}
#: The stages whose tables a stage reads.
NEEDS: dict[str, tuple[str, ...]] = {
    "preprocess": (), "resolve": ("preprocess",), "candidates": ("resolve",), "score-candidates": ("candidates",), "decide-pairs": ("candidates", "score-candidates"),
    "classify-eligibility": ("preprocess", "candidates"), "resolve-orthographic": ("candidates", "score-candidates", "decide-pairs", "classify-eligibility"),
    "profile-residuals": ("candidates", "resolve-orthographic"), "compute-distinctive-evidence": ("candidates", "classify-eligibility", "profile-residuals"),
    "assess-evidence": ("score-candidates", "resolve-orthographic", "profile-residuals", "compute-distinctive-evidence"),
    "finalize": ("resolve", "candidates", "decide-pairs", "classify-eligibility"), "build-corporate-master": ("candidates", "finalize"),
    "canonical-quality": ("build-corporate-master",), "promote-references": ("build-corporate-master", "canonical-quality"),
    "build-evaluation-sample": ("candidates", "score-candidates"), "evaluation-sample": ("preprocess",),
}

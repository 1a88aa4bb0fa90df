"""One query per linkage operator over the feed, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.functions import evidence
from namewright.functions.pairs import features
from namewright.operators import blocking, finalize, graph, master, preprocess, profile, sampling
from namewright.plans import oracle
from namewright.plans import project as _project
from namewright.plans.feed import CONFIG, Run, alias_references, feed, master_references, state_of
from namewright.plans.project import Project, marked_sql, over_suppliers, project_of, strange_sql, workbook_rows
from namewright.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_runs: dict[tuple, Run] = {}


def run_of(spark: SparkSession, sf_dir: str) -> Run:
    """Stages are shared by the queries of one application over one folder, as long as its files stay as they are."""
    key = (spark.sparkContext.applicationId, sf_dir, state_of(spark, sf_dir))
    if key not in _runs:
        _runs[key] = Run(spark, sf_dir)
    return _runs[key]


def forget() -> None:
    _runs.clear()
    _project.forget()


def query(name: str, sql: str | None = None):
    """Register a function of a Run; ``sql`` ends the oracle's chain of subqueries."""

    def put(make: Callable[[Run], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: make(run_of(spark, sf_dir))
        if sql is not None:
            SQL[name] = oracle.sql(sql)
        return make

    return put


def joined(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.array_join(c, "|") for c in columns})


# ---- sources, normalisation, typing --------------------------------------------------------------------------------
query("name_feed", "SELECT source_row_number, nombre_original FROM feed")(lambda r: feed(r.spark, r.sf_dir))
query("reference_master", "SELECT entity_id, canonical_name FROM refs")(lambda r: master_references(r.spark, r.sf_dir))
query("reference_aliases", "SELECT entity_id, alias_name FROM alias_refs")(lambda r: alias_references(r.spark, r.sf_dir))
query("norm_strict", "SELECT source_row_number, nombre_normalizado FROM norm")(lambda r: r.stage("preprocessed").select("source_row_number", "nombre_normalizado"))
query("norm_relaxed", "SELECT source_row_number, nombre_matching FROM norm")(lambda r: r.stage("preprocessed").select("source_row_number", "nombre_matching"))
FLAGS = ("source_row_number", "has_trailing_numeric_token", "trailing_numeric_candidate", "possible_truncation")
query("norm_flags", f"SELECT {', '.join(FLAGS)} FROM norm")(lambda r: r.stage("preprocessed").select(*FLAGS))
ADDRESS = ("source_row_number", "has_address_signal", "address_signal_strength")
query("typing_address", f"SELECT {', '.join(ADDRESS)} FROM pre")(lambda r: r.stage("preprocessed").select(*ADDRESS))
WORK = ("source_row_number", "has_occupation_signal", "occupation_signal_strength", "has_activity_description_signal")
query("typing_occupation", f"SELECT {', '.join(WORK)} FROM pre")(lambda r: r.stage("preprocessed").select(*WORK))
ORGANIZATION = ("source_row_number", "has_corporate_suffix", "has_organization_like_tokens", "mixed_address_organization_signal", "mixed_occupation_organization_signal")
query("typing_organization", f"SELECT {', '.join(ORGANIZATION)} FROM pre")(lambda r: r.stage("preprocessed").select(*ORGANIZATION))
ROUTE = ("source_row_number", "is_blank", "is_numeric_only", "token_count", "normalized_length", "route", "route_reason")
query("typing_route", f"SELECT {', '.join(ROUTE)} FROM pre")(lambda r: r.stage("preprocessed").select(*ROUTE))
query("preprocess", "SELECT * FROM pre")(lambda r: r.stage("preprocessed"))

# ---- exact resolution and keys -------------------------------------------------------------------------------------
query("exact_index", "SELECT * FROM idx")(lambda r: r.stage("index"))
query("exact_resolve", "SELECT * FROM resolved")(lambda r: r.stage("resolved"))
query("resolution_status_counts", "SELECT resolution_status, resolution_method, count(*) AS n FROM resolved GROUP BY ALL")(lambda r: profile.counts(r.stage("resolved"), "resolution_status", "resolution_method"))
query("exclusion_counts", f"SELECT {oracle.EXCLUSION} AS reason, count(*) AS n FROM resolved GROUP BY ALL")(
    lambda r: profile.counts(r.stage("resolved").withColumn("reason", preprocess.exclusion_reason()), "reason")
)
query("resolution_keys", "SELECT * FROM keys")(lambda r: r.stage("keys"))

# ---- candidates ----------------------------------------------------------------------------------------------------
PAIR = "key_a, key_b, method"
query("block_relaxed", f"SELECT {PAIR} FROM b1")(lambda r: blocking.relaxed_pairs(r.stage("keys"), r.settings.candidates))
query("block_trailing", f"SELECT {PAIR} FROM b2")(lambda r: blocking.trailing_pairs(r.stage("keys"), r.settings.candidates).distinct())
query("block_truncation", f"SELECT {PAIR} FROM b3")(lambda r: blocking.truncation_pairs(r.stage("keys"), r.settings.candidates).distinct())
query("block_token", f"SELECT {PAIR} FROM b4")(lambda r: blocking.token_pairs(r.stage("keys"), r.settings.candidates).distinct())
query("block_prefix", f"SELECT {PAIR} FROM b5")(lambda r: blocking.prefix_pairs(r.stage("keys"), r.settings.candidates))


def by_method(run: Run, method: str) -> DataFrame:
    found = run.stage("pairs").where(F.array_contains("blocking_methods", method))
    return found.select("key_a", "key_b", F.lit(method).alias("method"))


query("typo_token", f"SELECT {PAIR} FROM b6")(lambda r: by_method(r, "typo_token"))
query("typo_context", f"SELECT {PAIR} FROM b7")(lambda r: by_method(r, "typo_context"))
LISTED = "array_to_string(blocking_methods, '|') AS blocking_methods"
query("pair_union", f"SELECT key_a, key_b, name_a, name_b, {LISTED} FROM pairs")(lambda r: joined(r.stage("pairs"), "blocking_methods"))
query("zero_candidates", "SELECT * FROM zero")(lambda r: sampling.zero_candidate_keys(r.stage("keys"), r.stage("pairs")))
COUNTED = (
    "SELECT count(*) FILTER (n = 0) AS zero, count(*) FILTER (n > 0) AS positive, coalesce(min(n) FILTER (n > 0), 0) AS minimum, coalesce(quantile_disc(n, 0.5) FILTER (n > 0), 0) AS median, "
    "coalesce(quantile_disc(n, 0.95) FILTER (n > 0), 0) AS p95, coalesce(max(n), 0) AS maximum, CAST(round_even(avg(n), 6) AS DOUBLE) AS mean FROM (SELECT resolution_key, count(k) AS n FROM keys "
    "LEFT JOIN (SELECT key_a AS k FROM pairs UNION ALL SELECT key_b FROM pairs) u ON u.k = resolution_key GROUP BY resolution_key)"
)
query("candidates_per_key", COUNTED)(lambda r: profile.candidates_per_key(r.stage("keys"), r.stage("pairs")))
REDUCED = "SELECT k AS keys, p AS pairs, CAST(round_even(1 - p / (k * (k - 1) / 2), 6) AS DOUBLE) AS reduction FROM (SELECT (SELECT count(*) FROM {k}) AS k, (SELECT count(*) FROM {p}) AS p)"
query("pair_reduction", REDUCED.format(k="keys", p="pairs"))(lambda r: profile.pair_reduction(r.stage("keys"), r.stage("pairs")))

# ---- single expressions ------------------------------------------------------------------------------------------------
query("typo_signatures", f"SELECT resolution_key, token, array_to_string(list_sort({oracle.SIGNATURES}), '|') AS marks FROM (SELECT resolution_key, unnest({oracle.informative(6, False)}) AS token FROM keys)")(
    lambda r: r.stage("keys").select("resolution_key", F.explode(blocking.informative(r.settings.candidates, 6, False)).alias("token")).withColumn("marks", F.array_join(F.array_sort(blocking.signatures(F.col("token"))), "|"))
)
query("core_tokens", f"SELECT resolution_key, array_to_string({oracle.core('resolution_key')}, ' ') AS core FROM keys")(
    lambda r: r.stage("keys").select("resolution_key", F.array_join(evidence.core_tokens(F.col("resolution_key"), r.settings), " ").alias("core"))
)
query("legal_forms", f"SELECT resolution_key, {oracle.form_sql('resolution_key')} AS form FROM keys")(lambda r: r.stage("keys").select("resolution_key", graph.legal_form(F.col("resolution_key")).alias("form")))
query("explicit_missing", f"SELECT source_row_number, {oracle.MISSING.format('nombre_normalizado')} AS missing FROM pre")(
    lambda r: r.stage("preprocessed").select("source_row_number", finalize.is_missing(F.col("nombre_normalizado")).alias("missing"))
)
query("employer_universe", "SELECT resolution_key FROM employers")(lambda r: finalize.employer_keys(r.stage("keys"), r.stage("eligibility")).select("resolution_key"))
STATUSES = ("EMPLOYER_CANDIDATE", "ADDRESS", "NON_EMPLOYER_STATUS", "AMBIGUOUS")
query("crosstab_route_status", "SELECT representative_route, " + ", ".join(f"count(*) FILTER (eligibility_status = '{v}') AS \"{v}\"" for v in STATUSES) + " FROM keys JOIN elig USING (resolution_key) GROUP BY ALL")(
    lambda r: profile.crosstab(r.stage("keys").select("resolution_key", "representative_route").join(r.stage("eligibility"), "resolution_key"), "representative_route", "eligibility_status", STATUSES)
)

# ---- features and decisions ------------------------------------------------------------------------------------------
query("feat_struct", f"SELECT * EXCLUDE (blocking_methods), {LISTED} FROM scored")(lambda r: joined(r.stage("scored"), "blocking_methods"))
query("feat_ratios", "SELECT * FROM ratios")(lambda r: features(r.stage("pairs")).select("key_a", "key_b", "char_ratio", "token_sort_ratio", "token_set_ratio"))
query("feat_fuzzy")(lambda r: joined(features(r.stage("pairs")), "blocking_methods"))
DECIDED = ("key_a", "key_b", "decision_status", "decision_rule", "decision_evidence", "supporting_rules")
DECIDED_SQL = "SELECT key_a, key_b, decision_status, decision_rule, decision_evidence, array_to_string(supporting_rules, '|') AS supporting_rules FROM decisions"
query("decide_all", DECIDED_SQL)(lambda r: joined(r.stage("decisions").select(*DECIDED), "supporting_rules"))
for rules, name in ((("legal_suffix_format_equivalence", "legal_suffix_addition_equivalence"), "suffix"), (("whitespace_only_equivalence",), "whitespace"), (("unique_source_truncation_equivalence",), "truncation")):
    query(f"decide_{name}", DECIDED_SQL + f" WHERE list_has_any(supporting_rules, {oracle.items(rules)})")(
        lambda r, rules=rules: joined(r.stage("decisions").where(F.arrays_overlap("supporting_rules", F.array(*(F.lit(x) for x in rules)))).select(*DECIDED), "supporting_rules")
    )
query("decision_counts", "SELECT decision_status, decision_rule, count(*) AS n FROM decisions GROUP BY ALL")(lambda r: profile.counts(r.stage("decisions"), "decision_status", "decision_rule"))
query("eligibility", "SELECT * FROM elig")(lambda r: r.stage("eligibility"))

# ---- evidence --------------------------------------------------------------------------------------------------------
query("token_support", "SELECT token, support FROM support")(lambda r: evidence.token_support(evidence.employer_cores(r.stage("keys"), r.stage("eligibility"), r.settings)))
query("support_bands", "SELECT CASE WHEN support <= 1 THEN '1' WHEN support <= 5 THEN '2-5' WHEN support <= 10 THEN '6-10' WHEN support <= 25 THEN '11-25' WHEN support <= 50 THEN '26-50' WHEN support <= 100 THEN '51-100' ELSE '101+' END AS band, count(*) AS n FROM support GROUP BY ALL")(
    lambda r: profile.counts(evidence.token_support(evidence.employer_cores(r.stage("keys"), r.stage("eligibility"), r.settings)).withColumn("band", profile.support_band(F.col("support"))), "band")
)
ALL_GAPS = (
    "SELECT signature AS context_signature, CAST(count(DISTINCT token) AS INT) AS context_variant_count FROM (SELECT core[i] AS token, array_to_string(list_transform(range(1, len(core) + 1), lambda j: CASE WHEN j = i THEN '<DIFF>' ELSE core[j] END), ' ') AS signature "
    "FROM (SELECT core, unnest(range(1, len(core) + 1)) AS i FROM cores)) GROUP BY signature"
)


@query("context_variants", ALL_GAPS)
def context_variants(r: Run) -> DataFrame:
    """Every signature of the universe, as if each were asked for."""
    cores = evidence.employer_cores(r.stage("keys"), r.stage("eligibility"), r.settings)
    places = cores.select("core", F.explode(F.sequence(F.lit(0), F.size("core") - 1)).alias("i"))
    wanted = places.select(F.array_join(F.transform("core", lambda t, k: F.when(k == F.col("i"), "<DIFF>").otherwise(t)), " ").alias("context_signature"))
    return evidence.context_variants(cores, wanted)


query("orthographic", "SELECT * FROM ortho")(lambda r: r.stage("orthographic"))
query("residual", "SELECT * FROM resid")(lambda r: r.stage("residual"))
query("distinctive", "SELECT * FROM dist")(lambda r: r.stage("distinctive"))
ASSESSED = (
    "key_a", "key_b", "assessment_family", "assessment_evidence", "has_structural_exact_relation", "has_orthographic_signal", "has_distinctive_exact_overlap",
    "has_multiple_distinctive_exact_overlap", "has_numeric_risk", "has_zero_exact_overlap", "has_full_shorter_exact_coverage", "has_full_shorter_distinctive_coverage",
)
query("multi_evidence", "SELECT * FROM multi")(lambda r: r.stage("assessed").select(*ASSESSED))
RELATIONS = ("none", "same", "one_sided", "conflict")
query("crosstab_family_numeric", "SELECT primary_family, " + ", ".join(f"count(*) FILTER (numeric_relation = '{v}') AS \"{v}\"" for v in RELATIONS) + " FROM resid GROUP BY primary_family")(
    lambda r: profile.crosstab(r.stage("residual"), "primary_family", "numeric_relation", RELATIONS)
)
query("percentiles", "SELECT quantile_disc(source_row_frequency, 0.5) AS p50, quantile_disc(source_row_frequency, 0.95) AS p95 FROM keys")(lambda r: profile.nearest_rank(r.stage("keys"), "source_row_frequency"))
SHARES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
query(
    "feature_summary",
    "SELECT " + ", ".join(f"CAST(round_even(quantile_cont(length_ratio, {p}), 6) AS DOUBLE) AS p{round(p * 100)}" for p in SHARES)
    + ", CAST(round_even(min(length_ratio), 6) AS DOUBLE) AS minimum, CAST(round_even(max(length_ratio), 6) AS DOUBLE) AS maximum FROM scored",
)(lambda r: profile.interpolated(r.stage("scored"), "length_ratio", SHARES))

# ---- entities, master, promotion ---------------------------------------------------------------------------------------
query("components", "SELECT resolution_key, component, entity_id, canonical_resolution_key, component_key_count, component_source_row_count, decision_rules FROM parts")(
    lambda r: r.stage("parts").select("resolution_key", "component", "entity_id", "canonical_resolution_key", "component_key_count", "component_source_row_count", "decision_rules")
)
query("sector", f"SELECT resolution_key, {oracle.sector_sql('resolution_key', 'sector')} AS sector, {oracle.sector_sql('resolution_key', 'method')} AS method, {oracle.sector_sql('resolution_key', 'evidence')} AS evidence FROM keys")(
    lambda r: r.stage("keys").select("resolution_key", finalize.sector(F.col("resolution_key"), r.settings.sectors).alias("s")).select("resolution_key", "s.*")
)
query("exact_reuse", "SELECT entity_id, canonical_name, component_key_count, component_source_row_count, decision_rules FROM reuse")(
    lambda r: finalize.exact_reuse(r.stage("resolved"), r.settings).select("entity_id", "canonical_name", "component_key_count", "component_source_row_count", "decision_rules")
)
query("final", "SELECT * FROM final")(lambda r: r.stage("final"))
query("final_outcomes", "SELECT resultado_final, metodo_resolucion, count(*) AS n FROM final GROUP BY ALL")(lambda r: profile.counts(r.stage("final"), "resultado_final", "metodo_resolucion"))
query("top_keys", "SELECT resolution_key, source_row_frequency FROM keys ORDER BY source_row_frequency DESC, resolution_key LIMIT 40")(lambda r: finalize.top_keys(r.stage("final"), r.stage("keys"), r.settings.top_key_limit))
query("corporate_master", "SELECT * FROM master")(lambda r: r.stage("master"))
query("aliases", "SELECT * FROM aliases")(lambda r: r.stage("aliases"))
query("alias_rollup", "SELECT entity_id, count(*) AS keys, CAST(sum(source_row_frequency) AS BIGINT) AS rows FROM aliases GROUP BY entity_id")(lambda r: master.alias_rollup(r.stage("aliases"), r.stage("master")))
query("canonical_quality", "SELECT * FROM quality")(lambda r: master.unique_entities(r.stage("quality")))
query("promoted_master", "SELECT * FROM refs2")(lambda r: r.stage("promoted")[0])
query("promoted_aliases", "SELECT * FROM alias_refs2")(lambda r: r.stage("promoted")[1])
query("newly_promoted", "SELECT * FROM refs2 WHERE entity_id NOT IN (SELECT entity_id FROM refs)")(lambda r: master.newly_promoted(master_references(r.spark, r.sf_dir), r.stage("promoted")[0]))
query("second_resolve", "SELECT resolution_status, resolution_method, count(*) AS n FROM resolved2 GROUP BY ALL")(lambda r: profile.counts(r.stage("second").stage("resolved"), "resolution_status", "resolution_method"))
query("second_run_reduction", REDUCED.format(k="keys2", p="s_pairs"))(lambda r: profile.pair_reduction(r.stage("second").stage("keys"), r.stage("second").stage("pairs")))

# ---- profiles and samples ----------------------------------------------------------------------------------------------
query(
    "profile",
    "SELECT 'rows' AS measure, '' AS value, count(*) AS n FROM pre UNION ALL SELECT 'null_source_values', '', count(*) FILTER (nombre_original IS NULL) FROM pre "
    "UNION ALL SELECT 'route', route, count(*) FROM pre GROUP BY route UNION ALL SELECT 'normalized_length', CAST(normalized_length AS VARCHAR), count(*) FROM pre GROUP BY normalized_length",
)(lambda r: profile.profile(r.stage("preprocessed")))
query("unique_pairs", "SELECT key_a, key_b, count(*) AS n FROM pairs GROUP BY ALL HAVING count(*) > 1")(lambda r: profile.duplicates(r.stage("pairs"), "key_a", "key_b"))
_digest = "CAST('0x' || substr(sha256(key_a || chr(31) || key_b || chr(31) || decision_rule), 1, 15) AS BIGINT)"
query("fingerprint", f"SELECT count(*) AS n, coalesce(bit_xor({_digest}), 0) AS xor, CAST(coalesce(sum({_digest} % 2147483648), 0) AS BIGINT) AS total FROM decisions")(
    lambda r: profile.fingerprint(r.stage("decisions"), "key_a", "key_b", "decision_rule")
)
_again = "lag(nombre_original) OVER w IS NOT DISTINCT FROM nombre_original AND row_number() OVER w > 1"
query("repeated_neighbours", f"SELECT nombre_normalizado, count(*) AS n FROM (SELECT *, {_again} AS again FROM pre WINDOW w AS (PARTITION BY nombre_normalizado ORDER BY nombre_original NULLS FIRST)) WHERE again GROUP BY ALL")(
    lambda r: profile.counts(profile.out_of_order(r.stage("preprocessed").select("nombre_normalizado", "nombre_original"), "nombre_normalizado", "nombre_original"), "nombre_normalizado")
)
query(
    "support_summary",
    "SELECT CAST(count(*) AS BIGINT) AS n, min(support) AS minimum, quantile_disc(support, 0.5) AS p50, quantile_disc(support, 0.95) AS p95, max(support) AS maximum FROM (SELECT support, unnest(range(support)) FROM support)",
)(lambda r: profile.weighted_summary(evidence.token_support(evidence.employer_cores(r.stage("keys"), r.stage("eligibility"), r.settings)), "support", "support"))


def crossed(table: str, pairs: tuple[tuple[str, str], ...]) -> str:
    """SQL of the cross-tabs that :func:`profile.pair_counts` makes."""
    shown = lambda c: f"coalesce(CAST({c} AS VARCHAR), '')"
    return " UNION ALL ".join(f"SELECT '{a} x {b}' AS counter, {shown(a)} || '|' || {shown(b)} AS value, count(*) AS n FROM {table} GROUP BY ALL" for a, b in pairs)


for _table, _name, _stage in (("residual_relationship_profile", "resid", "residual"), ("employer_resolution_final", "final", "final"), ("canonical_quality", "quality", "quality")):
    query(f"crosstabs_{_stage}", crossed(_name, profile.CROSSED[_table]))(lambda r, t=_table, s=_stage: profile.pair_counts(r.stage(s), profile.CROSSED[t]))
_strata = " UNION ALL ".join(f"SELECT record_id, '{s}' AS stratum, {sampling.QUOTAS[s]} AS quota FROM pre WHERE {c}" for s, c in oracle.STRATA.items())
query(
    "sample_strata",
    "SELECT record_id, string_agg(stratum, '|' ORDER BY stratum) AS evaluation_strata FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY substr(sha256('20260813|' || stratum || '|' || record_id), 1, 16), record_id DESC) AS rank "
    f"FROM ({_strata})) WHERE rank <= quota GROUP BY record_id",
)(lambda r: joined(sampling.evaluation_sample(r.stage("preprocessed")).select("record_id", "evaluation_strata"), "evaluation_strata"))
query("pair_strata")(lambda r: joined(sampling.review_pairs(features(r.stage("pairs"))), "blocking_methods"))
_order = "CASE stratum " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(sampling.AUDIT_STRATA)) + " END"
_mark = "sha256('20260813' || chr(31) || {0} || chr(31) || resolution_key)"
_targets = "CASE stratum " + " ".join(f"WHEN '{s}' THEN {n}" for s, n in sampling.even_targets(150, sampling.AUDIT_STRATA[:-1]).items()) + " ELSE 0 END"
query(
    "audit_strata",
    f"SELECT 'AUDIT-' || lpad(CAST(row_number() OVER (ORDER BY {_order}, mark, resolution_key) AS VARCHAR), 4, '0') AS sample_id, stratum, resolution_key FROM ("
    f"SELECT *, row_number() OVER (ORDER BY first, {_mark.format(oracle.text('audit_backfill'))}, resolution_key) AS k FROM (SELECT *, CASE WHEN n <= {_targets} THEN 0 ELSE 1 END AS first FROM ("
    f"SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY mark, resolution_key) AS n FROM (SELECT *, {_mark.format('stratum')} AS mark FROM (SELECT resolution_key, {oracle.AUDIT} AS stratum FROM zero))))) WHERE k <= 150",
)(lambda r: sampling.blocking_misses(sampling.zero_candidate_keys(r.stage("keys"), r.stage("pairs"))).select("sample_id", "stratum", "resolution_key"))

# ---- names that are not ASCII, workbooks -------------------------------------------------------------------------------


def strange(r: Run) -> DataFrame:
    return preprocess.preprocess(over_suppliers(r.spark, r.sf_dir, strange_sql()), CONFIG)


query("norm_unicode", "SELECT source_row_number, nombre_original, nombre_normalizado, nombre_matching FROM norm_u")(lambda r: strange(r).select("source_row_number", "nombre_original", "nombre_normalizado", "nombre_matching"))
query("preprocess_unicode", "SELECT * FROM pre_u")(strange)
query("quality_marks", oracle.quality_sql("marked_q"))(lambda r: master.canonical_quality(over_suppliers(r.spark, r.sf_dir, marked_sql().format(s="STRING"))))
query("workbook_rows", "SELECT row_number() OVER (ORDER BY source_row_number) + 1 AS source_row_number, nombre_original, 64 AS digest_size FROM feed_u")(lambda r: workbook_rows(r.spark, r.sf_dir))

# ---- the stages of the command line, over a project with a public catalogue ----------------------------------------------


def staged(name: str, stage: str, sql: str | None, make: Callable[[Project], DataFrame]) -> None:
    """A query over what a project holds after ``stage``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        project = project_of(spark, sf_dir)
        project.upto(stage)
        return make(project)

    QUERIES[name] = run
    if sql is not None:
        SQL[name] = oracle.sql(sql)


def stored(table: str, *lists: str) -> Callable[[Project], DataFrame]:
    return lambda p: joined(p.store.read(table), *lists)


def known(p: Project) -> DataFrame:
    masters, names = p.store.references()
    return masters.selectExpr("'master' AS kind", "entity_id", "canonical_name AS name").unionByName(names.selectExpr("'alias' AS kind", "entity_id", "alias_name AS name"))


KNOWN = "SELECT 'master' AS kind, entity_id, canonical_name AS name FROM {0} UNION ALL SELECT 'alias', entity_id, alias_name FROM {1}"
TEXTS = ("record_id", "entity_id", "nombre_propuesto", "sector_propuesto", "resultado_final", "metodo_resolucion", "explicacion", "decision_rules", "public_entity_id", "public_source_url")
LISTS = "blocking_methods"
staged("stage_preprocess", "preprocess", "SELECT * FROM pre", stored("preprocessed"))
staged("stage_resolve", "resolve", "SELECT * FROM resolved", stored("resolved"))
staged("stage_references", "resolve", "SELECT 'alias' AS kind, entity_id, alias_name AS name FROM alias_refs", lambda p: files.read_csv(p.spark, f"{p.store.root}/reference/employer_aliases.csv", files.ALIASES).selectExpr("'alias' AS kind", "entity_id", "alias_name AS name"))
staged("stage_keys", "candidates", "SELECT * FROM keys", stored("resolution_keys"))
staged("stage_candidates", "candidates", f"SELECT key_a, key_b, name_a, name_b, {LISTED} FROM pairs", stored("candidate_pairs", LISTS))
staged(
    "stage_score", "score-candidates", f"SELECT s.* EXCLUDE (blocking_methods), {LISTED}, char_ratio, token_sort_ratio, token_set_ratio FROM scored s JOIN ratios USING (key_a, key_b)",
    lambda p: joined(p.store.read("candidate_pair_features").drop("partial_ratio"), LISTS),
)
staged("stage_decide", "decide-pairs", f"SELECT key_a, key_b, name_a, name_b, {LISTED}, decision_status, decision_rule, decision_evidence FROM decisions", stored("pair_resolution_decisions", LISTS))
staged("stage_eligibility", "classify-eligibility", "SELECT * FROM elig", stored("employer_eligibility"))
staged("stage_orthographic", "resolve-orthographic", f"SELECT o.*, {LISTED} FROM ortho o JOIN pairs USING (key_a, key_b, name_a, name_b)", stored("orthographic_pair_decisions", LISTS))
staged("stage_residual", "profile-residuals", f"SELECT r.*, {LISTED} FROM resid r JOIN pairs USING (key_a, key_b, name_a, name_b)", stored("residual_relationship_profile", LISTS))
staged("stage_distinctive", "compute-distinctive-evidence", "SELECT * FROM dist", stored("distinctive_name_evidence"))
staged("stage_assess", "assess-evidence", "SELECT * FROM multi", lambda p: p.store.read("multi_evidence_assessment").select(*ASSESSED))
staged("public_catalogue", "finalize", "SELECT * FROM catalogue", lambda p: finalize.checked_enrichment(p.store.catalogue()))
staged("stage_final", "finalize", "SELECT * FROM final_p", stored("employer_resolution_final"))
staged(
    "stage_final_metrics", "finalize", " UNION ALL ".join(f"SELECT '{c}' AS counter, coalesce({c}, '') AS value, count(*) AS n FROM final_p GROUP BY ALL" for c in profile.COUNTED["employer_resolution_final"]),
    lambda p: p.metrics("employer_resolution_final"),
)
staged(
    "csv_final", "finalize", f"SELECT {', '.join(TEXTS)}, CAST(score_confianza_resolucion AS VARCHAR) AS score FROM final_p",
    lambda p: p.csv("employer_resolution_final").selectExpr(*TEXTS, "score_confianza_resolucion AS score"),
)
staged("csv_top_keys", "finalize", "SELECT resolution_key, CAST(n AS VARCHAR) AS source_row_frequency FROM (SELECT resolution_key, source_row_frequency AS n FROM keys ORDER BY n DESC, resolution_key LIMIT 40)", lambda p: p.csv("top_keys"))
staged("stage_master", "build-corporate-master", "SELECT * FROM master_p", stored("corporate_master"))
staged("stage_aliases", "build-corporate-master", "SELECT * FROM aliases_p", stored("corporate_aliases"))
OWN = "entity_id, canonical_name, resolution_status, public_entity_id"
staged("csv_master", "build-corporate-master", f"SELECT {OWN}, CAST(source_row_count AS VARCHAR) AS source_row_count FROM master_p", lambda p: p.csv("corporate_master").select(*OWN.split(", "), "source_row_count"))
staged("stage_quality", "canonical-quality", "SELECT * FROM quality_p", stored("canonical_quality"))
GATED = "entity_id, canonical_name, quality_status, quality_reason"
staged("csv_quality", "canonical-quality", f"SELECT {GATED} FROM quality_p", lambda p: p.csv("canonical_quality").select(*GATED.split(", ")))
staged("stage_promoted", "promote-references", KNOWN.format("refs_p", "alias_refs_p"), known)
staged("stage_second_resolve", "promote-references", "SELECT * FROM resolved_p", lambda p: p.again())
staged("stage_review_pairs", "build-evaluation-sample", None, lambda p: p.csv_file("evaluation/pair_review.csv"))
# The two samples show what two queries above show directly.
staged("stage_review_sample", "build-evaluation-sample", None, lambda p: p.csv_file("evaluation/blocking_audit.csv").select("sample_id", "stratum", "resolution_key"))
staged("stage_sample", "evaluation-sample", None, lambda p: joined(p.store.read("evaluation_sample").select("record_id", "evaluation_strata"), "evaluation_strata"))
SQL["stage_review_sample"], SQL["stage_sample"] = SQL["audit_strata"], SQL["sample_strata"]

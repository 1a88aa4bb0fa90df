import datetime
import hashlib
import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from namewright import cli
from namewright.config import Settings, Source, load_settings
from namewright.operators import finalize, graph, master, preprocess, profile, sampling, stages
from namewright.sources import files, workbook

CONFIG = Settings()
KEYS = "resolution_key string, representative_name string, source_row_frequency long, possible_truncation boolean, token_count int"


def keys_of(spark, names):
    return spark.createDataFrame([(n, n, 1, False, len(n.split())) for n in names], KEYS)


def decisions_of(spark, pairs):
    return spark.createDataFrame([(*sorted(p), "AUTO_SAME", "legal_suffix_addition_equivalence") for p in pairs], "key_a string, key_b string, decision_status string, decision_rule string")


def eligible(spark, names):
    return spark.createDataFrame([(n, n, "EMPLOYER_CANDIDATE", "r", "e") for n in names], "resolution_key string, representative_name string, eligibility_status string, eligibility_rule string, eligibility_evidence string")


def groups(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.component, set()).add(r.resolution_key)
    return sorted(map(sorted, out.values()))


def test_disjoint_legal_forms_stay_apart(spark):
    names = ["CHIQUITA PANAMA", "CHIQUITA PANAMA SA", "CHIQUITA PANAMA LLC"]
    found = graph.constrained_components(keys_of(spark, names), decisions_of(spark, [(names[0], names[1]), (names[0], names[2])]))
    # The LLC pair comes first in key order.
    assert groups(found) == [["CHIQUITA PANAMA", "CHIQUITA PANAMA LLC"], ["CHIQUITA PANAMA SA"]]
    assert found.agg(F.sum("blocked")).first()[0] == 1


def test_same_form_merges(spark):
    names = ["ACME", "ACME SA", "ACME S A"]
    assert groups(graph.constrained_components(keys_of(spark, names), decisions_of(spark, [(names[0], names[1]), (names[0], names[2]), (names[1], names[2])]))) == [sorted(names)]


def test_components_equal_a_global_replay(spark):
    rng = random.Random(5)
    names = [f"N{i} {rng.choice(['SA', 'LLC', 'X', 'INC'])}" for i in range(60)]
    pairs = sorted({tuple(sorted(rng.sample(names, 2))) for _ in range(70)})
    forms = {n: n.split()[1] if n.split()[1] != "X" else None for n in names}
    # A plain replay over lists of members.
    sets = {n: [n] for n in names}
    blocked = 0
    for a, b in pairs:
        x, y = sets[a], sets[b]
        one, two = ({forms[n] for n in part} - {None} for part in (x, y))
        if x is not y and one and two and not one & two:
            blocked += 1
        elif x is not y:
            x += y
            sets |= dict.fromkeys(y, x)
    expected = {id(x): x for x in sets.values()}
    found = graph.constrained_components(keys_of(spark, names), decisions_of(spark, pairs))
    assert groups(found) == sorted(map(sorted, expected.values()))
    assert found.agg(F.sum("blocked")).first()[0] == blocked


def test_connected(spark):
    edges = spark.createDataFrame([("c", "d"), ("a", "b"), ("b", "c"), ("x", "y"), ("z", "z")], "a string, b string")
    assert {(r.node, r.label) for r in graph.connected(edges, "a", "b").collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "a"), ("x", "x"), ("y", "x")}


@pytest.mark.parametrize(("name", "sector", "evidence"), [("BANCO SCHOOL", "Educación", "SCHOOL"), ("BANCORP", "No determinado", None), ("SALUD HOSPITAL", "Salud", "HOSPITAL|SALUD")])
def test_sector(spark, name, sector, evidence):
    row = spark.createDataFrame([(name,)], "n string").select(finalize.sector(F.col("n"), CONFIG.sectors).alias("s")).first().s
    assert (row.sector, row.evidence) == (sector, evidence)


CATALOGUE = "public_entity_id string, resolution_key string, canonical_name string, sector string, source_url string, validated_on string"


@pytest.mark.parametrize(
    "row",
    [("PUB-1", "K", "N", "S", "https://a.b", "2024-01-01"), ("PUB-000001", "K", "N", "S", "ftp://a.b", "2024-01-01"), ("PUB-000001", "K", "N", "S", "https://a.b", "2024-02-30"), ("PUB-000001", " ", "N", "S", "https://a.b", "2024-01-01")],
)
def test_bad_catalogue_rows_fail(spark, row):
    with pytest.raises(Exception, match="invalid public row"):
        finalize.checked_enrichment(spark.createDataFrame([row], CATALOGUE)).collect()


def test_public_links_ignore_forms_and_conflicts_fail(spark):
    names = ["ACME SA", "ACME LLC", "OTHER"]
    rows = [("PUB-000001", n, "Acme", "Salud", "https://a.b/c", "2024-01-01") for n in names[:2]]
    parts = finalize.components(keys_of(spark, names), eligible(spark, names), decisions_of(spark, [("OTHER", "OTHER2")]), CONFIG, spark.createDataFrame(rows, CATALOGUE))
    assert {r.resolution_key: r.entity_id for r in parts.collect() if r.public_entity_id} == {"ACME SA": "PUB-000001", "ACME LLC": "PUB-000001"}
    bad = [(f"PUB-00000{i}", n, f"N{i}", "Salud", "https://a.b/c", "2024-01-01") for i, n in enumerate(names[:2])]
    linked = decisions_of(spark, [("ACME LLC", "OTHER")])
    two = finalize.components(keys_of(spark, ["OTHER", "ACME LLC"]), eligible(spark, ["OTHER", "ACME LLC"]), linked, CONFIG, spark.createDataFrame([(*bad[1],), ("PUB-000009", "OTHER", "Z", "S", "https://a.b", "2024-01-01")], CATALOGUE))
    with pytest.raises(Exception, match="several public ids"):
        two.collect()


def test_unknown_public_key_fails(spark):
    rows = spark.createDataFrame([("PUB-000001", "NOPE", "N", "S", "https://a.b", "2024-01-01")], CATALOGUE)
    keys, status = keys_of(spark, ["ACME"]), eligible(spark, ["ACME"])
    with pytest.raises(Exception, match="unknown or no employer"):
        finalize.usable_links(rows, keys, status).collect()
    assert finalize.usable_links(rows, keys, status, spark.createDataFrame([("PUB-000001",)], "entity_id string")).count() == 0


def test_index_conflicts_fail(spark):
    m = spark.createDataFrame([("EMP-000001", "ACME"), ("EMP-000002", "OTHER")], files.MASTER)
    index = preprocess.exact_index(m, spark.createDataFrame([("EMP-000001", "acme co"), ("EMP-000001", "ACME")], files.ALIASES))
    assert {(r.nombre_normalizado, r.match_source) for r in index.collect()} == {("ACME", "canonical"), ("ACME CO", "alias"), ("OTHER", "canonical")}
    for aliases, message in (([("EMP-000002", "acme")], "two entities"), ([("EMP-000009", "x")], "invalid alias")):
        with pytest.raises(Exception, match=message):
            preprocess.exact_index(m, spark.createDataFrame(aliases, files.ALIASES)).collect()


@pytest.mark.parametrize(
    ("name", "status", "reason"),
    [
        ("CITIBANK PANAMA SA 1", "AUTO_CANONICALIZED", "legal_suffix_trailing_numeric"), ("NIKOS CAFE 1", "AUTO_CANONICALIZED", "trailing_numeric"),
        ("BAD � NAME", "PUBLIC_VALIDATED", "invalid_control_or_replacement_character"), ("Metro de Panamá, S.A.", "AUTO_CANONICALIZED", "auto_canonical_name_acceptable"),
        ("X", "NORMALIZED_CANDIDATE", "normalized_candidate_not_promotable"), ("X 1", "PUBLIC_VALIDATED", "public_validated_name"),
    ],
)
def test_quality(spark, name, status, reason):
    df = spark.createDataFrame([("ENT-1", name, status, 92)], "entity_id string, canonical_name string, resolution_status string, confidence_score int")
    assert master.canonical_quality(df).first().quality_reason == reason


def test_unknown_status_fails(spark):
    df = spark.createDataFrame([("ENT-1", "X", "WHAT", 92)], "entity_id string, canonical_name string, resolution_status string, confidence_score int")
    with pytest.raises(Exception, match="unknown status"):
        master.canonical_quality(df).collect()


def test_master_without_quality_fails(spark):
    rows = spark.createDataFrame([("E1", "A", "AUTO_CANONICALIZED", 92), ("E2", "B", "AUTO_CANONICALIZED", 92)], "entity_id string, canonical_name string, resolution_status string, confidence_score int")
    quality = master.canonical_quality(rows)
    assert master.promotable(rows, quality).count() == 2
    with pytest.raises(Exception, match="disagree"):
        master.promotable(rows, quality.where("entity_id = 'E1'")).collect()
    names = spark.createDataFrame([("E1", "A")], "entity_id string, representative_name string")
    with pytest.raises(Exception, match="no alias"):
        master.promoted_aliases(names, rows).collect()


def test_references_merge_once_and_conflict(spark):
    a = spark.createDataFrame([("E1", "A")], "entity_id string, canonical_name string")
    merged = master.merged_references(a, a, "entity_id", "canonical_name")
    assert merged.count() == 1 and master.newly_promoted(a, merged).count() == 0
    with pytest.raises(Exception, match="conflicting"):
        master.merged_references(a, spark.createDataFrame([("E1", "B")], a.schema), "entity_id", "canonical_name").collect()


def test_samples_do_not_depend_on_partitions(spark):
    names = [f"NAME {i} {'SA' if i % 3 else 'CALLE 1'}" for i in range(300)]
    rows = spark.createDataFrame(list(enumerate(names, 2)), "source_row_number long, nombre_original string")
    samples = []
    for n in (1, 7):
        pre = preprocess.preprocess(rows.repartition(n), CONFIG)
        samples.append({(r.record_id, tuple(r.evaluation_strata)) for r in sampling.evaluation_sample(pre).collect()})
    assert samples[0] == samples[1] and len(samples[0]) > 50
    assert sum("corporate-suffix" in s for _, s in samples[0]) >= sampling.QUOTAS["corporate-suffix"]


def test_even_targets():
    assert list(sampling.even_targets(10, ("a", "b", "c")).values()) == [4, 3, 3]


def test_profile_of_empty_table(spark):
    pre = preprocess.preprocess(spark.createDataFrame([], "source_row_number long, nombre_original string"), CONFIG)
    assert {r.measure: r.n for r in profile.profile(pre).collect()} == {"null_source_values": 0}


def test_settings_are_strict(tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"candidates": {"maximum_block_size": 9}, "random_seed": 1}))
    assert load_settings(str(path)).candidates.maximum_block_size == 9
    path.write_text(json.dumps({"nonsense": 1}))
    with pytest.raises(ValueError, match="unknown settings"):
        load_settings(str(path))
    path.write_text(json.dumps({"typing": {"strong_score": 2}}))
    with pytest.raises(ValueError, match="above"):
        load_settings(str(path))


def book(values):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rows = "".join(f'<row r="{i}"><c r="A{i}" t="inlineStr"><is><t xml:space="preserve">{v}</t></is></c></row>' if v is not None else f'<row r="{i}"/>' for i, v in enumerate(["nombre_original", *values], 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{rows}</sheetData></worksheet>")
    return out.getvalue()


def test_workbook(spark, tmp_path):
    path = tmp_path / "names.xlsx"
    path.write_bytes(book(["  ACME  ", None, "'", "CALLE 10", "ESTUDIANTE", "EMPRESA S A"]))
    digest = workbook.validate(spark, str(path), Source())
    assert digest == hashlib.sha256(path.read_bytes()).hexdigest().upper()
    for source, message in ((Source(expected_sha256="00"), "SHA-256"), (Source(expected_sheet_names=("Other",)), "sheets"), (Source(column="other"), "header")):
        with pytest.raises(ValueError, match=message):
            workbook.validate(spark, str(path), source)
    # A second column far below the first rows is found as well.
    wide = tmp_path / "wide.xlsx"
    with zipfile.ZipFile(path) as old, zipfile.ZipFile(wide, "w") as new:
        for name in old.namelist():
            new.writestr(name, old.read(name).decode().replace('<row r="6">', '<row r="6"><c r="B6" t="inlineStr"><is><t>x</t></is></c>'))
    with pytest.raises(ValueError, match="more than one column"):
        workbook.validate(spark, str(wide), Source())
    rows = workbook.read(spark, str(path))
    copy = str(tmp_path / "copy.xlsx")
    workbook.write(spark, rows.orderBy("source_row_number").select("nombre_original"), copy, Source())
    assert workbook.read(spark, copy).collect() == rows.collect()
    pre = preprocess.preprocess(rows, CONFIG, digest).orderBy("source_row_number").collect()
    assert [r.source_row_number for r in pre] == [2, 3, 4, 5, 6, 7]
    assert [r.route for r in pre] == [
        "employer_resolution_candidate", "blank_candidate", "blank_candidate", "address_candidate", "non_employer_status_candidate", "employer_resolution_candidate",
    ]


def test_reference_csv(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("﻿entity_id,canonical_name\nEMP-000001,\"ACME, SA\"\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_csv(spark, str(path), files.MASTER).collect()] == [("EMP-000001", "ACME, SA")]
    with pytest.raises(ValueError, match="columns"):
        files.read_csv(spark, str(path), files.ALIASES)
    assert files.read_csv(spark, str(tmp_path / "none.csv"), files.MASTER, missing_ok=True).count() == 0
    with pytest.raises(ValueError, match="overwrite an input"):
        files.distinct_paths(["/a/b"], ["/a/./b"])


def test_stages_from_command_line_and_second_run(spark, tmp_path):
    root = str(tmp_path)
    names = ["ACME HOLDING", "ACME HOLDING SA", "ACME HOLDING S A", "BANCO UNO", "BANCO UN0", "CALLE 10", None, "NA", "ESTUDIANTE", "548 MARKET ST 18590 CA SAN FRANCISCO", "ACME HOLDING"]
    spark.createDataFrame(list(enumerate(names, 2)), "source_row_number long, nombre_original string").write.parquet(f"{root}/source")
    settings = tmp_path / "s.json"
    settings.write_text(json.dumps({"source": {"workbook": "table"}}))
    run = ["--root", root, "--settings", str(settings)]
    # Missing references are an error, not an empty table.
    assert cli.main([*run, "preprocess", "resolve"]) == 1 and not (tmp_path / "resolved").exists()
    (tmp_path / "reference").mkdir()
    (tmp_path / "reference" / "employer_master.csv").write_text("entity_id,canonical_name\n")
    (tmp_path / "reference" / "employer_aliases.csv").write_text("entity_id,alias_name\n")
    assert cli.main([*run, "all"]) == 0
    assert {f.name for f in (tmp_path / "output").iterdir()} >= {"employer_resolution_final.csv", "corporate_master.csv", "corporate_aliases.csv", "canonical_quality.csv", "top_keys.csv"}
    for name, mark in (("employer_resolution_final", True), ("corporate_master", True), ("canonical_quality", False)):
        part = next((tmp_path / "output" / f"{name}.csv").glob("part-*")).read_bytes()
        assert part.startswith(b"\xef\xbb\xbf") == mark
    metrics = json.loads((tmp_path / "metrics" / "employer_resolution_final.json").read_text())
    assert metrics["rows"] == len(names) and sum(metrics["counters"]["resultado_final"].values()) == len(names)
    assert sum(metrics["crosstabs"]["resultado_final x eligibility_status"].values()) == len(names)
    assert "p50" in json.loads((tmp_path / "metrics" / "candidate_pair_features.json").read_text())["summaries"]["length_ratio"]
    final = {r.source_row_number: r for r in spark.read.parquet(f"{root}/employer_resolution_final").collect()}
    assert final[2].resultado_final == "EMPRESA_CANONICALIZADA_AUTO" and final[2].entity_id == final[3].entity_id == final[4].entity_id
    assert final[9].metodo_resolucion == "explicit_missing_information" and final[7].resultado_final == "NO_IDENTIFICABLE_DIRECCION"
    assert final[8].score_confianza_resolucion == 40
    pairs = spark.read.parquet(f"{root}/candidate_pairs").count()
    # What was promoted is known to the next run.
    assert cli.main([*run, "preprocess", "resolve", "candidates"]) == 0
    assert spark.read.parquet(f"{root}/resolved").where("resolution_status = 'resolved'").count() == 4
    assert spark.read.parquet(f"{root}/candidate_pairs").count() < pairs
    assert cli.main([*run, "--settings", str(tmp_path / "missing.json"), "resolve"]) == 1


def test_a_bad_table_is_not_published(spark, tmp_path):
    store = stages.Store(spark, str(tmp_path), CONFIG)
    good = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    store.write(good, "numbers", "k")
    with pytest.raises(ValueError, match="distinct keys"):
        store.write(good.union(good), "numbers", "k")
    assert store.read("numbers").count() == 2 and [f.name for f in tmp_path.iterdir() if f.name.startswith("numbers")] == ["numbers"]
    with pytest.raises(ValueError, match="overwrite an input"):
        store.write(good, "numbers", "k", inputs=("numbers",))


def test_a_crash_between_the_steps_loses_nothing(spark, tmp_path, monkeypatch):
    store = stages.Store(spark, str(tmp_path), CONFIG)
    store.write(spark.createDataFrame([("a", 1)], "k string, n int"), "numbers", "k")
    # The old table was set aside, the new one not yet put in its place.
    (tmp_path / "numbers").rename(tmp_path / "numbers.former")
    assert [tuple(r) for r in store.read("numbers").collect()] == [("a", 1)]
    store.write(spark.createDataFrame([("b", 2)], "k string, n int"), "numbers", "k")
    assert [tuple(r) for r in store.read("numbers").collect()] == [("b", 2)]
    # Promotion that dies before the pointer moves leaves the references as they were.
    one = spark.createDataFrame([("EMP-000001", "ACME")], files.MASTER)
    for version, names in (("v1", one), ("v2", one.where("false"))):
        files.write_csv(names, store.reference("employer_master", version), ["entity_id"])
        files.write_csv(spark.createDataFrame([], files.ALIASES), store.reference("employer_aliases", version), ["alias_name"])
        if version == "v1":
            files.write_text(spark, version, f"{tmp_path}/reference/CURRENT")
    assert store.references()[0].count() == 1
    files.write_text(spark, "v2", f"{tmp_path}/reference/CURRENT")
    assert store.references()[0].count() == 0


def test_tables_that_disagree_are_not_assessed(spark):
    shape = spark.createDataFrame([("A", "B", "A", "B", ["m"], "none", "e", 1)], "key_a string, key_b string, name_a string, name_b string, blocking_methods array<string>, numeric_relation string, orthographic_evidence string, shared_exact_token_count int")
    rare = spark.createDataFrame([("A", "B", "A", "B", 1, 0, True, False)], "key_a string, key_b string, name_a string, name_b string, shared_exact_token_count int, shared_distinctive_token_count int, has_shared_exact_token boolean, has_shared_distinctive_token boolean")
    scored = shape.select("key_a", "key_b", "name_a", "name_b", "blocking_methods", "numeric_relation")
    spelled = shape.select("key_a", "key_b", "name_a", "name_b", "blocking_methods", "numeric_relation", "orthographic_evidence", F.lit("NEEDS_FURTHER_RESOLUTION").alias("orthographic_status"))
    assert stages.consistent(shape, rare, scored, spelled).count() == 1
    broken = (
        (shape, rare, scored.withColumn("numeric_relation", F.lit("same")), spelled, "numeric_relation of f"), (shape, rare, scored.where("false"), spelled, "no features"),
        (shape, rare, scored, spelled.withColumn("orthographic_evidence", F.lit("x")), "evidence"), (shape, rare, scored, spelled.withColumn("blocking_methods", F.array(F.lit("x"))), "blocking_methods of o"),
        (shape, rare.withColumn("shared_exact_token_count", F.lit(2)), scored, spelled, "token counts"), (shape, rare.where("false"), scored, spelled, "disagree on key_a"),
        (shape, rare.withColumn("has_shared_distinctive_token", F.lit(True)), scored, spelled, "overlap flags"), (shape, rare.withColumn("name_a", F.lit("Z")), scored, spelled, "identity"),
    )
    for *tables, message in broken:
        with pytest.raises(Exception, match=message):
            stages.consistent(*tables).collect()


def test_weighted_summary_equals_repeated_rows(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 40), rng.randint(0, 5)) for _ in range(200)]
    found = profile.weighted_summary(spark.createDataFrame(rows, "v int, w int"), "v", "w").first()
    full = sorted(v for v, w in rows for _ in range(w))
    rank = lambda p: full[-(-len(full) * int(p * 100) // 100) - 1]
    assert tuple(found) == (len(full), full[0], rank(0.5), rank(0.95), full[-1])


def test_stream(spark, tmp_path):
    from namewright.streaming.incremental import resolve_stream

    schema = "source_row_number long, nombre_original string"
    spark.createDataFrame([(2, "acme"), (3, "other")], schema).write.parquet(str(tmp_path / "in"))
    references = lambda: (spark.createDataFrame([("EMP-000001", "ACME")], files.MASTER), spark.createDataFrame([], files.ALIASES))
    query = resolve_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), references, str(tmp_path / "out"), str(tmp_path / "log"))
    query.awaitTermination(60)
    assert {(r.source_row_number, r.resolution_status) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(2, "resolved"), (3, "unresolved")}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert datetime.date.fromisoformat("2024-01-01")


def test_synthetic_feed(spark):
    from namewright.sources.synthetic import KINDS, VARIANTS, names

    assert sum(KINDS) == sum(VARIANTS) == 100
    one, two = (names(spark, 3000, partitions=n).orderBy("source_row_number").collect() for n in (1, 5))
    assert one == two and one[0].source_row_number == 2 and len(one) == 3000
    routes = {r.route: r["count"] for r in preprocess.preprocess(names(spark, 3000), CONFIG).groupBy("route").count().collect()}
    assert routes["employer_resolution_candidate"] > 2000 and len(routes) == 5


def test_references_of_large_part_tables(spark, tmp_path):
    from namewright.plans import feed

    keys = [40, 41, 999_960, 1_000_000, 10_000_040, 80, 2_000_000]
    rows = [(k, f"name {k if k not in (80, 2_000_000) else 'twice'}", "T", "B") for k in keys]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    found = {r.canonical_name: r.entity_id for r in feed.master_references(spark, str(tmp_path)).collect()}
    assert found == {
        "NAME 40 T B": "EMP-000040",
        "NAME 999960 T B": "EMP-999960",
        "NAME 1000000 T B": "ENT-00000000000F4240",
        "NAME 10000040 T B": "ENT-00000000009896A8",
        "NAME TWICE T B": "EMP-000080",
    }
    index = preprocess.exact_index(feed.master_references(spark, str(tmp_path)), feed.alias_references(spark, str(tmp_path)))
    assert {r.entity_id for r in index.collect()} == set(found.values())


def test_each_distinct_name_is_typed_once(spark):
    rows = spark.createDataFrame([(2, "ACME SA"), (3, "ACME SA"), (4, None), (5, None), (6, "")], "source_row_number long, nombre_original string")
    df = preprocess.preprocess(rows, CONFIG)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [nombre_original" in plan.split("Join", 1)[1]
    found = {r.source_row_number: (r.nombre_normalizado, r.route) for r in df.collect()}
    assert len(found) == 5 == df.count() and found[2] == found[3] == ("ACME SA", "employer_resolution_candidate")
    assert found[4] == found[5] == (None, "blank_candidate") and found[6] == ("", "blank_candidate")


def test_a_project_runs_the_stages_that_a_query_needs(spark, sf):
    from namewright.operators import stages
    from namewright.plans.project import Project

    assert list(stages.NEEDS) == list(stages.STAGES)
    project = Project(spark, sf)
    project.upto("evaluation-sample")
    assert project.done == ["preprocess", "evaluation-sample"]
    project.upto("decide-pairs")
    assert project.done == ["preprocess", "evaluation-sample", "resolve", "candidates", "score-candidates", "decide-pairs"]


@pytest.fixture
def as_planned(spark):
    """Joins shuffle both sides and keep the tasks that they were planned with."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rows_without_name_or_exact_id_are_no_single_task(spark, as_planned):
    names = [(k, None if k % 2 else f"ACME {k}") for k in range(2, 402)]
    rows = preprocess.preprocess(spark.createDataFrame(names, "source_row_number long, nombre_original string"), CONFIG)
    index = preprocess.exact_index(*(spark.createDataFrame([("EMP-000001", n)], f"entity_id string, {c} string") for n, c in (("ACME 2", "canonical_name"), ("ACME 4", "alias_name"))))
    resolved = preprocess.resolve(rows, index)
    status = eligible(spark, [n for _, n in names if n and n not in ("ACME 2", "ACME 4")])
    keys = preprocess.resolution_keys(resolved)
    parts = finalize.components(keys, status, decisions_of(spark, [("ACME 6", "ACME 8")]), CONFIG)
    final = finalize.finalize(resolved, status, parts, finalize.exact_reuse(resolved, CONFIG))
    sizes = [r.n for r in final.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 400 and max(sizes) < 200
    found = {r.source_row_number: (r.resultado_final, r.entity_id, r.nombre_normalizado) for r in final.collect()}
    assert found[2] == (finalize.AUTOMATIC, "EMP-000001", "ACME 2") and found[4] == (finalize.AUTOMATIC, "EMP-000001", "ACME 4")
    assert found[6][0] == found[8][0] == finalize.AUTOMATIC and found[6][1] == found[8][1] != found[10][1]
    assert found[10][0] == finalize.NORMALIZED and found[3] == (finalize.NO_INFORMATION, None, None)


def test_master_compares_the_rows_of_an_entity_without_multiplying_them(spark):
    schema = (
        "record_id string, entity_id string, resolution_key string, metodo_resolucion string, nombre_propuesto string, sector_propuesto string, resultado_final string, confianza_resolucion string, "
        "score_confianza_resolucion int, canonical_resolution_key string, component_key_count int, component_source_row_count long, public_entity_id string, public_source_url string, public_validation_date string"
    )

    def row(i, key="ACME", method="deterministic_auto_same_component", name="ACME", keys=2, public=None, url="u", day="2024-01-15"):
        outcome = "EMPRESA_CANONICALIZADA_AUTO" if public is None else "EMPRESA_VALIDADA_PUBLICAMENTE"
        return (str(i), "ENT-1", key, method, name, "s", outcome, "ALTA", 92, "ACME", keys, 3, public, url if public else None, day if public else None)

    made = lambda *rows: master.corporate_master(spark.createDataFrame(list(rows), schema))
    good = made(row(1), row(2), row(3, "ACME SA"))
    assert "Expand" not in good._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.canonical_name, r.resolution_method, r.component_key_count, r.source_row_count) for r in good.collect()] == [("ACME", "deterministic_auto_same_component", 2, 3)]
    reused = made(*(row(i, method=m, name="ACME", keys=1) for i, m in enumerate(("exact_reference_alias", "exact_reference_canonical", "exact_reference_alias"))))
    assert reused.first().resolution_method == "reference_exact_reuse"
    for bad in (
        (row(1), row(2), row(3, "ACME SA", name="OTHER")),
        (row(1), row(2), row(3, "ACME SA", name=None)),
        (row(1), row(2), row(3, "ACME SA", method="normalized_employer_key")),
        (row(1), row(2), row(3, "ACME SA", method="exact_reference_alias")),
        (row(1), row(2), row(3)),
        (row(1), row(2, "ACME SA")),
        (row(1, public="PUB-000001"), row(2, public="PUB-000001"), row(3, "ACME SA", public="PUB-000002")),
        (row(1, public="PUB-000001"), row(2, public="PUB-000001"), row(3, "ACME SA", public="PUB-000001", day=None)),
    ):
        with pytest.raises(Exception, match="contradictory rows of entity ENT-1"):
            made(*bad).collect()


def test_stages_that_wait_for_nothing_run_side_by_side(spark, sf, monkeypatch):
    import threading

    from namewright.operators import stages
    from namewright.plans.project import Project

    meeting, order = threading.Barrier(2, timeout=30), []
    for name in stages.STAGES:
        meets = name in ("score-candidates", "classify-eligibility")
        monkeypatch.setitem(stages.STAGES, name, lambda s, n=name, m=meets: (m and meeting.wait(), order.append(n)))
    monkeypatch.setattr(Project, "begin", lambda self: order.append("begin"))
    project = Project(spark, sf)
    project.upto("assess-evidence")
    assert order[:4] == ["begin", "preprocess", "resolve", "candidates"] and set(order[4:6]) == {"score-candidates", "classify-eligibility"}
    assert order[6:] == ["decide-pairs", "resolve-orthographic", "profile-residuals", "compute-distinctive-evidence", "assess-evidence"]
    assert sorted(project.done) == sorted(order[1:])


def test_steps_side_by_side_end_before_an_error_is_raised(spark):
    from namewright.sources.shared import together

    ended = []

    def fail():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        together(spark, fail, lambda: ended.append(spark.range(10).count()))
    assert ended == [10] and together(spark, lambda: 1, lambda: 2) == [1, 2]


def test_keys_are_compared_where_their_hashes_do_not_settle_it(spark, monkeypatch):
    from namewright.operators import stages

    df = lambda *rows: spark.createDataFrame(rows, "a string, b string")
    assert stages.key_counts(df(("x", "y"), ("xy", ""), ("", "xy")), "a", "b") == (3, 3, 0)
    assert stages.key_counts(df(("x", "y"), ("x", "y"), ("x", None), (None, "z")), "a", "b") == (4, 1, 2)
    monkeypatch.setattr(stages.F, "xxhash64", lambda *c: F.lit(1))
    assert stages.key_counts(df(("x", "y"), ("xy", ""), ("", "xy")), "a", "b") == (3, 3, 0)


def test_counters_and_cross_tabs_are_one_pass_over_the_combinations(spark, monkeypatch):
    monkeypatch.setitem(profile.COUNTED, "t", ("a", "b"))
    monkeypatch.setitem(profile.CROSSED, "t", (("a", "c"),))
    monkeypatch.setitem(profile.SUMMED, "t", ("n", "c"))
    df = spark.createDataFrame([("x", True, 1, 5.0), ("x", None, 2, 1.0), (None, True, 1, 2.0), ("", False, 1, 2.0)], "a string, b boolean, c int, n double")
    made = profile.metrics("t", df)
    assert made["counters"] == {"a": {"x": 2, "": 2}, "b": {"true": 2, "": 1, "false": 1}} and made["crosstabs"] == {"a x c": {"x|1": 1, "x|2": 1, "|1": 2}}
    assert made["summaries"] == {c: profile.interpolated(df, c).first().asDict() for c in ("n", "c")} and made["summaries"]["n"]["p50"] == 2.0
    # The rows are not multiplied: they are grouped before values are taken apart.
    plan = profile.combinations("t", df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.rindex("Aggregate [")

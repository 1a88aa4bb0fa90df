import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from namewright.config import Normalization, Settings
from namewright.functions.text import normalized
from namewright.functions.typing import typed

CONFIG = Settings()


def norm(spark, values, config=CONFIG.normalization):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, nombre_original string")
    return [r.asDict() for r in normalized(df, config).orderBy("i").collect()]


def kind(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, nombre_original string")
    return [r.asDict() for r in typed(normalized(df, CONFIG.normalization), CONFIG.typing).orderBy("i").collect()]


def test_names(spark):
    a, none, empty = norm(spark, ["'  Café—Norte, S A  ", None, "'"])
    assert (a["nombre_normalizado"], a["nombre_matching"]) == ("CAFÉ-NORTE, S A", "CAFÉ NORTE SA")
    assert none["nombre_normalizado"] is None and none["nombre_matching"] is None and not none["possible_truncation"]
    assert empty["nombre_normalizado"] == "" and empty["nombre_matching"] == ""


def test_compatibility_forms(spark):
    a, b, c = norm(spark, ["ＡＢＣ ﬁn", "x\x1cy z", "A$B+C"])
    assert a["nombre_normalizado"] == "ABC FIN"
    assert b["nombre_normalizado"] == "X Y Z"
    assert c["nombre_matching"] == "A$B+C"


@pytest.mark.parametrize(
    ("value", "flag", "candidate"),
    [("EMPRESA 7", True, "EMPRESA"), ("EMPRESA 77", True, None), ("7 EMPRESA", False, None), ("7", True, None), ("X7", False, None)],
)
def test_trailing_number(spark, value, flag, candidate):
    (row,) = norm(spark, [value])
    assert (row["has_trailing_numeric_token"], row["trailing_numeric_candidate"]) == (flag, candidate)


def test_truncation_counts_the_raw_value(spark):
    rows = norm(spark, ["A" * 30, "'" + "A" * 30, "A" * 29, " " + "A" * 29])
    assert [r["possible_truncation"] for r in rows] == [True, True, False, True]


def test_suffix_order_and_whole_name(spark):
    rows = norm(spark, ["ACME S A", "S A", "ACME S A S", "ACME L L C", "PASA"])
    assert [r["nombre_matching"] for r in rows] == ["ACME SA", "SA", "ACME SAS", "ACME LLC", "PASA"]


def test_suffixes_are_settings(spark):
    (row,) = norm(spark, ["ACME GMBH"], Normalization(corporate_suffix_aliases={"LTD": ("GMBH",)}))
    assert row["nombre_matching"] == "ACME LTD"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=20), min_size=1, max_size=30))
def test_strict_against_plain_python(spark, values):
    def plain(v):
        v = unicodedata.normalize("NFKC", v[1:] if v.startswith("'") else v)
        table = {ord(c): k for k, cs in {"'": "‘’ʼ`", '"': "“”", "-": "‐‑‒–—−"}.items() for c in cs}
        return re.sub(r"\s+", " ", v.translate(table).upper().strip())

    for v, row in zip(values, norm(spark, values), strict=True):
        # The engines disagree on the upper case of a few letters; compare where Python's is stable.
        if plain(v).isascii():
            assert row["nombre_normalizado"] == plain(v)


@pytest.mark.parametrize(
    ("value", "route"),
    [
        (None, "blank_candidate"), ("", "blank_candidate"), ("12345", "ambiguous_review_candidate"), ("ESTUDIANTE", "non_employer_status_candidate"),
        ("CALLE 10", "address_candidate"), ("ACME", "employer_resolution_candidate"), ("UNIVERSIDAD ESTUDIANTE CALLE 10", "employer_resolution_candidate"),
        ("PLAZA CENTRAL", "ambiguous_review_candidate"),
    ],
)
def test_routes(spark, value, route):
    assert kind(spark, [value])[0]["route"] == route


def test_status_strengths(spark):
    rows = kind(spark, ["DESEMPLEAD0", "AMA DE CASA1", "NO LABORO", "HOSPITAL DEL NINO LABORATORIO", "SEGURIDAD CESANTE", "XJUBILADO"])
    assert [r["occupation_signal_strength"] for r in rows] == ["strong", "strong", "strong", "none", "moderate", "strong"]


def test_mixed_and_weak(spark):
    a, b = kind(spark, ["UNIVERSIDAD ESTUDIANTE CALLE 10", "PLAZA CENTRAL"])
    assert a["mixed_address_organization_signal"] and a["mixed_occupation_organization_signal"]
    assert b["address_signal_strength"] == "weak"


def test_company_word_in_no_work_statement(spark):
    a, b = kind(spark, ["NO TRABAJA EN EMPRESA", "NO TRABAJA EN BANCO"])
    assert not a["has_organization_like_tokens"] and b["has_organization_like_tokens"]

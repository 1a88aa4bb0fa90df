import itertools
import random

import pytest
from pyspark.sql import functions as F

from namewright.config import Candidates, Settings
from namewright.functions import evidence, pairs
from namewright.functions.pairs import decide, features, lcs, partial_ratio, ratio, token_set_ratio
from namewright.operators import blocking
from namewright.operators.eligibility import street_address

CONFIG = Settings()
KEYS = "resolution_key string, representative_name string, relaxed_key string, trailing_numeric_candidate string, possible_truncation boolean"


def keys_of(spark, names, cut=(), relaxed=None, trailing=None):
    return spark.createDataFrame([(n, n, (relaxed or {}).get(n), (trailing or {}).get(n), n in cut) for n in names], KEYS)


def pairs_of(spark, *pairs):
    return spark.createDataFrame([(*sorted(p), *sorted(p), ["informative_token"]) for p in pairs], "key_a string, key_b string, name_a string, name_b string, blocking_methods array<string>")


def found(df):
    return {(r.key_a, r.key_b) for r in df.collect()}


def test_features(spark):
    rows = {r.key_a: r for r in features(pairs_of(spark, ("ABCD", "ABXYZZZZ"), ("ALPHA BETA", "ALPHA GAMMA"), ("BANCO GENERAL", "GENERAL BANCO"))).collect()}
    assert (rows["ABCD"].length_ratio, rows["ABCD"].common_prefix_ratio) == (0.5, 0.5)
    assert rows["ALPHA BETA"].token_jaccard == round(1 / 3, 6)
    assert rows["BANCO GENERAL"].token_sort_ratio == 100


@pytest.mark.parametrize(
    ("a", "b", "relation"),
    [("STUDIO 507", "STUDIO 508", "conflict"), ("GRUPO 2 SUCURSAL 7", "GRUPO 7 SUCURSAL 2", "conflict"), ("A 1", "A", "one_sided"), ("A 1", "B 1", "same"), ("A", "B", "none")],
)
def test_numeric_relation(spark, a, b, relation):
    assert features(pairs_of(spark, (a, b)), with_ratios=False).first().numeric_relation == relation


def test_lcs_against_dynamic_program():
    rng = random.Random(0)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 9))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert lcs(a, b) == table[-1][-1]
    assert ratio("", "") == 100 and token_set_ratio("A B", "A B C") == 100 and partial_ratio("BC", "ABCD") == 100


def test_blockers(spark):
    config = Candidates(maximum_block_size=3)
    keys = keys_of(
        spark, ["BANCO GENERAL S.A.", "BANCO GENERAL S A", "BANCO GENERAL 4", "BANCO GENERAL"],
        relaxed={"BANCO GENERAL S.A.": "BANCO GENERAL SA", "BANCO GENERAL S A": "BANCO GENERAL SA"}, trailing={"BANCO GENERAL 4": "BANCO GENERAL"},
    )
    assert found(blocking.relaxed_pairs(keys, config)) == {("BANCO GENERAL S A", "BANCO GENERAL S.A.")}
    assert found(blocking.trailing_pairs(keys, config)) == {("BANCO GENERAL", "BANCO GENERAL 4")}
    # Four keys share the token and the signature: more than the block limit.
    assert not found(blocking.token_pairs(keys, config)) and not found(blocking.prefix_pairs(keys, config))


def test_token_block_skips_generic(spark):
    keys = keys_of(spark, ["ALPHA TECNOSERV", "BETA TECNOSERV", "GRUPO UNO", "GRUPO DOS"])
    assert found(blocking.token_pairs(keys, Candidates())) == {("ALPHA TECNOSERV", "BETA TECNOSERV")}


def test_truncation_block(spark):
    cut = "COMPANIA NACIONAL DE ALIMENTOS"
    keys = keys_of(spark, [cut, cut + " Y BEBIDAS", "COMPANIA NACIONAL MARINA DEL SUR"], cut=[cut])
    assert found(blocking.truncation_pairs(keys, Candidates())) == {(cut, cut + " Y BEBIDAS")}


def test_context_typo_only(spark):
    keys = keys_of(spark, ["AER0NAUTICA CIVIL", "AERONAUTICA CIVIL"])
    assert {(r.key_a, tuple(r.blocking_methods)) for r in blocking.candidate_pairs(keys, Candidates(maximum_token_frequency=1, minimum_typo_token_length=20)).collect()} == {
        ("AER0NAUTICA CIVIL", ("typo_context",))
    }


def test_methods_are_united_in_order(spark):
    keys = keys_of(spark, ["ACME-SOUTH", "ACME SOUTH"], relaxed={"ACME-SOUTH": "ACME SOUTH", "ACME SOUTH": "ACME SOUTH"})
    (row,) = blocking.candidate_pairs(keys, Candidates()).collect()
    assert row.blocking_methods == ["relaxed_key", "prefix_signature"]


def naive_typo(names, limit, minimum=6):
    marks = {n: {m for t in n.split() if len(t) >= minimum and t not in blocking.GENERIC_TOKENS and not t.isdigit() for m in (t, *(t[:i] + t[i + 1 :] for i in range(len(t))))} for n in names}
    held = {}
    for n, ms in marks.items():
        for m in ms:
            held.setdefault(m, set()).add(n)
    return {(min(a, b), max(a, b)) for a in names for m in marks[a] if 2 <= len(held[m]) <= limit for b in held[m] if a != b}


def test_typo_pairs_against_plain_python(spark):
    rng = random.Random(3)
    names = sorted({" ".join("".join(rng.choice("ABC") for _ in range(rng.randint(5, 8))) for _ in range(2)) for _ in range(120)})
    empty = pairs_of(spark, ("A", "B")).where("false")
    assert found(blocking.typo_pairs(keys_of(spark, names), empty, Candidates(maximum_typo_signature_frequency=4))) == naive_typo(names, 4)


@pytest.mark.parametrize(
    ("a", "b", "rule"),
    [
        ("EMPRESA S A", "EMPRESA SA", "legal_suffix_format_equivalence"), ("ELECTROCENTRO", "ELECTROCENTRO S A", "legal_suffix_addition_equivalence"),
        ("MOBIL PHONE", "MOBILPHONE", "whitespace_only_equivalence"), ("A B", "AB", "no_deterministic_equivalence"),
        ("10 PM CURFEW", "10PM CURFEW", "no_deterministic_equivalence"), ("ACME S.A.", "ACME", "no_deterministic_equivalence"),
    ],
)
def test_decisions(spark, a, b, rule):
    row = decide(features(pairs_of(spark, (a, b)), with_ratios=False), keys_of(spark, [a, b]), CONFIG).first()
    assert row.decision_rule == rule and (row.decision_status == "AUTO_SAME") == (rule != "no_deterministic_equivalence")


def test_truncation_has_to_be_unique(spark):
    cut = "COMPANIA NACIONAL DE ALIMENTOS"
    one, two = cut + " Y BEBIDAS", cut + " DEL SUR"
    alone = decide(features(pairs_of(spark, (cut, one)), with_ratios=False), keys_of(spark, [cut, one], cut=[cut]), CONFIG).first()
    assert alone.decision_rule == "unique_source_truncation_equivalence"
    both = decide(features(pairs_of(spark, (cut, one), (cut, two)), with_ratios=False), keys_of(spark, [cut, one, two], cut=[cut]), CONFIG).collect()
    assert {r.decision_status for r in both} == {"NEEDS_FURTHER_RESOLUTION"}


@pytest.mark.parametrize(
    ("name", "holds"),
    [("548 MARKET ST 18590 CA SAN FRANCISCO", True), ("548 MARKET ST", False), ("548 MARKET XX 18590 CA SAN FRANCISCO", False), ("548 MARKET ST 18590 CAL SAN FRANCISCO", False), ("", False)],
)
def test_street_address(spark, name, holds):
    assert spark.createDataFrame([(name,)], "n string").select(street_address(F.col("n"), CONFIG.road_type_tokens)).first()[0] is holds


def employers(spark, names):
    return spark.createDataFrame([(n, "EMPLOYER_CANDIDATE") for n in names], "resolution_key string, eligibility_status string")


@pytest.mark.parametrize(
    ("a", "b", "more", "expected"),
    [
        ("FARMACIA SHEKAINAH CENTRAL", "FARMACIA SHEKINAH CENTRAL", [], "one_alphabetic_token_edit_distance_1_with_exact_context"),
        ("AMERICA CAPITAL", "AMERICAN CAPITAL", [], "terminal_edit_requires_further_resolution"),
        ("FARMACIA SHEKAINAH", "FARMACIA SHEKINAH", ["FARMACIA SHEKOINAH"], "multi_variant_context"),
        ("ACME ONE", "ACME ONE TWO", [], "core_token_count_mismatch"),
        ("ALPHA ROBERTO", "ALPHA RUBERTA", [], "edit_distance_not_one"),
        ("ACME SA", "ACME", [], "no_core_token_difference"),
    ],
)
def test_orthographic(spark, a, b, more, expected):
    pairs = features(pairs_of(spark, (a, b)), with_ratios=False)
    row = evidence.orthographic(pairs, keys_of(spark, [a, b, *more]), employers(spark, [a, b, *more]), CONFIG).first()
    assert row.orthographic_evidence == expected


@pytest.mark.parametrize(
    ("a", "b", "family"),
    [
        ("BANCO GENERAL", "GENERAL BANCO", "EXACT_TOKEN_REORDER"), ("ALPHA BETA", "ALPHA BETA GAMMA", "SINGLE_TOKEN_ADDITION_REMOVAL"),
        ("ALPHA", "ALPHA BETA GAMMA", "MULTI_TOKEN_ADDITION_REMOVAL"), ("IBM", "INTERNATIONAL BUSINESS MACHINES", "ACRONYM_INITIALISM_PATTERN"),
        ("COMPAIA PANAMEA", "COMPANIA PANAMENA", "MULTIPLE_SMALL_TOKEN_EDITS"), ("ALPHA 1", "ALPHA 2", "NUMERIC_VARIATION"),
        ("BETA ALPHA", "ALPHA X BETA", "EXACT_TOKEN_CONTAINMENT_NONALIGNED"), ("ALPHA UNO", "ALPHA DOSCIENTOS", "SINGLE_TOKEN_LARGER_EDIT"), ("XX", "YYYYY ZZZZZ", "OTHER_RESIDUAL"),
    ],
)
def test_families(spark, a, b, family):
    pairs = features(pairs_of(spark, (a, b)), with_ratios=False).withColumn("orthographic_evidence", F.lit("x"))
    assert evidence.residual(pairs, keys_of(spark, [a, b]), CONFIG).first().primary_family == family


def test_distinctive_counts_multiplicity(spark):
    a, b = "DELTA DELTA OMEGA", "DELTA DELTA"
    row = evidence.distinctive(pairs_of(spark, (a, b)), keys_of(spark, [a, b]), employers(spark, [a, b]), CONFIG).first()
    assert (row.shared_exact_tokens, row.shared_distinctive_token_count, row.shorter_name_exact_coverage) == ("DELTA|DELTA", 2, 1.0)


def test_shared_token_without_support_fails(spark):
    df = evidence.distinctive(pairs_of(spark, ("DELTA UNO", "DELTA DOS")), keys_of(spark, ["X"]), employers(spark, ["X"]), CONFIG)
    with pytest.raises(Exception, match="without support"):
        df.collect()


def test_contradictory_evidence_fails(spark):
    row = ("EXACT_TOKEN_REORDER", "none", 1, 2, True, True, 1.0, 1.0, "x")
    names = "primary_family string, numeric_relation string, shared_exact_token_count int, shared_distinctive_token_count int, has_shared_distinctive_token boolean, has_multiple_shared_distinctive_tokens boolean, shorter_name_exact_coverage double, shorter_name_distinctive_coverage double, orthographic_evidence string"
    with pytest.raises(Exception, match="contradictory"):
        evidence.multi_evidence(spark.createDataFrame([row], names)).collect()


def plain_ratio(a, b):
    """By the table of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b)) if a or b else 100.0


def plain_partial(a, b):
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.0 if b else 100.0
    best = 0.0
    for s, t in ((a, b), (b, a))[: 1 + (len(a) == len(b))]:
        n = len(s)
        best = max(best, *(plain_ratio(s, w) for w in {t[:k] for k in range(1, n)} | {t[i : i + n] for i in range(len(t) - n + 1)} | {t[-k:] for k in range(1, n)}))
    return best


def test_batched_ratios_equal_plain_ones():
    rng = random.Random(0)
    words = ["ACME", "BANCO", "SA", "S", "A", "GENERAL", "ÑANDU", "X1", "HOLDING"]
    a, b = ([" ".join(rng.choices(words, k=rng.randint(0, 5))) for _ in range(150)] + extra for extra in (["LONG " * 20, "", "AB"], ["LONGER " * 13, "", "BA"]))
    close = lambda x, y: all(abs(p - q) < 1e-9 for p, q in zip(x.tolist(), y, strict=True))
    assert close(pairs.ratios_of(a, b), map(plain_ratio, a, b)) and close(pairs.partial_ratios(a, b), map(plain_partial, a, b))
    assert pairs.token_set_ratios(["A B", "A B C", "", "X"], ["B A", "C Q", "A", "Y"]).tolist() == [100.0, 50.0, 0.0, 0.0]


def test_windows_at_the_ends_of_a_text_share_a_walk(monkeypatch):
    walked, calls, windows, alone = [], [], pairs.lcs_windows, pairs.lcs
    monkeypatch.setattr(pairs, "lcs_windows", lambda s, t, owner, start, size: walked.append(int(size.sum())) or windows(s, t, owner, start, size))
    monkeypatch.setattr(pairs, "lcs", lambda s, t: calls.append(len(t)) or alone(s, t))
    # Of texts of n and m characters, only the m - n + 1 windows of full length walk on their own, in each direction if both are equally long.
    assert pairs.partial_ratios(["ABCDEFGH" * 5], ["XBCDEFGH" * 5 + "Y"])[0] > 80 and sum(walked) == 2 * 40
    assert pairs.partial_ratios(["ABCDEFGH" * 9], ["XBCDEFGH" * 9])[0] > 80 and sum(calls) == 2 * 72
    # A window that begins before the text or ends behind it can be the best one.
    for a, b in (("BCDX", "QQABCD"), ("XABC", "ABCQQQ"), ("BCDX" * 20, "Q" * 90 + "BCDX" * 10), ("A", "B"), ("AB", "B")):
        assert pairs.partial_ratios([a], [b])[0] == pytest.approx(plain_partial(a, b), abs=1e-9)

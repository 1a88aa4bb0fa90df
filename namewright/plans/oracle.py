"""DuckDB SQL for the linkage stages, as one chain of named subqueries over the test tables."""

from __future__ import annotations

from namewright.config import GENERIC_TOKENS, Settings
from namewright.functions import evidence, typing
from namewright.functions.pairs import RULES
from namewright.functions.text import QUOTES
from namewright.operators import blocking, finalize, graph, sampling
from namewright.plans.feed import MASTER_SQL, PART, feed_sql
from namewright.plans.project import PLAIN, WIDE, marked_sql, strange_sql

S = Settings()
N, T, C = S.normalization, S.typing, S.candidates


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def items(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def cases(pairs, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {otherwise} END"


def phrase(value: str, p: str) -> str:
    return f"contains(' ' || {value} || ' ', {text(' ' + p + ' ')})"


def suffix_sql(x: str) -> str:
    found = []
    for canonical, variants in N.corporate_suffix_aliases.items():
        for v in variants:
            p = text(f"(^| ){v}$")
            found.append((f"regexp_matches({x}, {p})", f"regexp_replace({x}, {p}, {text(chr(92) + '1' + canonical)})"))
    return cases(found, x)


def re2(pattern: str) -> tuple[str, int]:
    """A pattern without look-around, and the group that is the match."""
    inner = pattern.replace("(?<![A-Z0-9])", "").replace("(?![A-Z0-9])", "")
    before = "(^|[^A-Z0-9])" if pattern.startswith("(?<!") else "()"
    return f"{before}({inner})([^A-Z0-9]|$)", 2


QUOTE_FROM, QUOTE_TO = "".join(QUOTES.values()), "".join(k * len(v) for k, v in QUOTES.items())
STATUS = ", ".join(f"CASE WHEN {phrase('value', p)} THEN {text(p)} END" for p in sorted(T.status_phrases, key=lambda p: (-len(p.split()), p)))
PURE = " OR ".join(f"regexp_full_match(value, {text(p)})" for p in typing.PURE_STATUS)
EMBEDDED = ", ".join(f"CASE WHEN regexp_matches(value, {text(re2(p)[0])}) THEN regexp_extract(value, {text(re2(p)[0])}, {re2(p)[1]}) END" for p in typing.EMBEDDED_STATUS)
OCCUPATION = " OR ".join(f"regexp_matches(value, {text(re2(p)[0])})" for p in typing.OCCUPATIONS)
NUMBERED = "'^[0-9]+([0-9]|[A-Za-z])?$'"
ADDRESS = items(T.explicit_tokens + T.contextual_tokens)
NEAR = " OR ".join(f"regexp_matches(coalesce(toks[i{d}], ''), {NUMBERED})" for d in ("-1", "+1", "+2"))

CTE: dict[str, str] = {}
CTE["feed"] = feed_sql(False)
CTE["n1"] = (
    "SELECT *, trim(regexp_replace(upper(translate(regexp_replace(nombre_original, '^''', ''), " + text(QUOTE_FROM) + ", " + text(QUOTE_TO) + r")), '\s+', ' ', 'g')) AS nombre_normalizado FROM feed"
)
CTE["n2"] = r"SELECT *, trim(regexp_replace(regexp_replace(nombre_normalizado, '\p{P}', ' ', 'g'), '\s+', ' ', 'g')) AS bare FROM n1"
CTE["n3"] = (
    f"SELECT source_row_number, nombre_original, nombre_normalizado, {suffix_sql('bare')} AS nombre_matching, "
    r"regexp_extract(nombre_normalizado, '(?:^| )(\d+)$', 1) AS num, rtrim(regexp_extract(nombre_normalizado, '^(.*?) ?\d+$', 1)) AS before, "
    "sha256('record-v1|' || repeat('0', 64) || '|Sheet1|' || source_row_number) AS record_id FROM n2"
)
CTE["norm"] = (
    "SELECT record_id, source_row_number, nombre_original, nombre_normalizado, nombre_matching, coalesce(num <> '', false) AS has_trailing_numeric_token, "
    f"CASE WHEN num <> '' AND before <> '' AND length(num) <= {N.trailing_numeric_candidate_max_digits} THEN before END AS trailing_numeric_candidate, "
    f"coalesce(length(regexp_replace(nombre_original, '^''', '')) IN ({', '.join(map(str, N.possible_truncation_content_lengths))}), false) AS possible_truncation FROM n3"
)
CTE["t1"] = f"SELECT *, trim(coalesce(nombre_matching, '')) AS value, {tokens('trim(coalesce(nombre_matching, %s))' % text(''))} AS toks FROM norm"
CTE["t2"] = (
    "SELECT *, coalesce(length(trim(nombre_normalizado)), 0) AS normalized_length, len(toks) AS token_count, regexp_matches(value, '^[0-9]+( [0-9]+)*$') AS is_numeric_only, "
    f"2 * CAST(list_has_any(toks, {items(T.explicit_tokens)}) AS INT) + CAST(list_has_any(toks, {items(T.contextual_tokens)}) AS INT) "
    f"+ 2 * CAST(len(list_filter(range(1, len(toks) + 1), lambda i: list_contains({ADDRESS}, toks[i]) AND ({NEAR}))) > 0 AS INT) "
    f"+ 3 * CAST({' OR '.join(phrase('value', m) for m in T.intersection_markers)} AS INT) "
    f"+ CAST(len(list_distinct(list_intersect(toks, {ADDRESS}))) > 1 AS INT) AS score, "
    f"CASE WHEN value <> '' THEN coalesce({STATUS}, CASE WHEN {PURE} THEN value END, {EMBEDDED}) END AS status, "
    f"({OCCUPATION}) AND value <> '' AS occupation, coalesce(list_contains({items(T.corporate_suffix_tokens)}, toks[-1]), false) AS has_corporate_suffix, "
    f"list_distinct(list_intersect(toks, {items(T.organization_tokens)})) AS orgs FROM t1"
)
CTE["t3"] = "SELECT *, coalesce(status = value, false) AS pure FROM t2"
CTE["t4"] = (
    "SELECT *, normalized_length = 0 AS is_blank, score > 0 AS has_address_signal, "
    f"CASE WHEN score <= 0 THEN 'none' WHEN score >= {T.strong_score} THEN 'strong' WHEN score >= {T.moderate_score} THEN 'moderate' ELSE 'weak' END AS address_signal_strength, "
    "status IS NOT NULL OR occupation AS has_occupation_signal, "
    "CASE WHEN pure THEN 'strong' WHEN status IS NOT NULL OR occupation THEN 'moderate' ELSE 'none' END AS occupation_signal_strength, "
    "(status IS NOT NULL OR occupation) AND NOT pure AS has_activity_description_signal, "
    "has_corporate_suffix OR (len(orgs) > 0 AND NOT (pure AND NOT has_corporate_suffix AND len(list_filter(orgs, lambda o: o NOT IN ('EMPRESA', 'EMPRESAS'))) = 0 "
    f"AND regexp_full_match(value, {text(typing.NEGATED_WORK)}))) AS has_organization_like_tokens FROM t3"
)
ROUTES = (
    ("is_blank", "blank_candidate", "blank_preserved_for_later_validation"),
    ("is_numeric_only", "ambiguous_review_candidate", "numeric_only_is_ambiguous"),
    ("(has_address_signal OR has_occupation_signal) AND has_organization_like_tokens", "employer_resolution_candidate", "organization_signal_preserves_resolution_eligibility"),
    ("has_address_signal AND has_occupation_signal", "ambiguous_review_candidate", "conflicting_address_and_occupation_signals"),
    ("pure", "non_employer_status_candidate", "complete_value_matches_status_phrase"),
    ("address_signal_strength IN ('moderate', 'strong')", "address_candidate", "corroborated_address_without_organization_signal"),
    ("has_address_signal OR has_occupation_signal", "ambiguous_review_candidate", "weak_or_descriptive_nonorganization_signal"),
)
CTE["pre"] = (
    "SELECT record_id, source_row_number, nombre_original, nombre_normalizado, nombre_matching, has_trailing_numeric_token, trailing_numeric_candidate, possible_truncation, "
    "is_blank, is_numeric_only, has_address_signal, address_signal_strength, has_occupation_signal, occupation_signal_strength, has_corporate_suffix, has_organization_like_tokens, "
    "has_address_signal AND has_organization_like_tokens AS mixed_address_organization_signal, has_occupation_signal AND has_organization_like_tokens AS mixed_occupation_organization_signal, "
    "has_activity_description_signal, CAST(token_count AS INT) AS token_count, CAST(normalized_length AS INT) AS normalized_length, "
    f"{cases([(c, text(r)) for c, r, _ in ROUTES], text('employer_resolution_candidate'))} AS route, "
    f"{cases([(c, text(w)) for c, _, w in ROUTES], text('no_signal_justifies_exclusion_from_resolution'))} AS route_reason FROM t4"
)
CTE["refs"] = f"SELECT min(entity_id) AS entity_id, canonical_name FROM ({MASTER_SQL.format(s='VARCHAR', part=PART)}) GROUP BY canonical_name"
CTE["alias_refs"] = "SELECT entity_id, canonical_name || ' SA' AS alias_name FROM refs"


def strict_sql(x: str) -> str:
    return f"trim(regexp_replace(upper({x}), '\\s+', ' ', 'g'))"


def index_sql(master: str, aliases: str) -> str:
    return (
        f"SELECT name AS nombre_normalizado, arg_min(entity_id, (rank, entity_id)) AS entity_id, arg_min(canonical_name, (rank, entity_id)) AS canonical_name, "
        f"CASE WHEN min(rank) = 0 THEN 'canonical' ELSE 'alias' END AS match_source FROM ("
        f"SELECT entity_id, canonical_name, {strict_sql('canonical_name')} AS name, 0 AS rank FROM {master} UNION ALL "
        f"SELECT a.entity_id, m.canonical_name, {strict_sql('a.alias_name')}, 1 FROM {aliases} a JOIN {master} m USING (entity_id)) GROUP BY name"
    )


def resolved_sql(index: str) -> str:
    return (
        f"SELECT p.*, i.entity_id, i.canonical_name, CASE WHEN i.entity_id IS NULL THEN 'unresolved' ELSE 'resolved' END AS resolution_status, "
        f"'exact_' || i.match_source AS resolution_method, coalesce('exact_match_validated_' || i.match_source, 'no_validated_exact_match') AS resolution_reason "
        f"FROM pre p LEFT JOIN {index} i ON p.nombre_normalizado = i.nombre_normalizado"
    )


EXCLUSION = cases(
    [
        ("resolution_status <> 'unresolved'", "'already_resolved'"), ("is_blank", "'blank'"), ("is_numeric_only", "'numeric_only'"),
        ("route = 'non_employer_status_candidate'", "'non_employer_status'"), ("route = 'address_candidate'", "'address_candidate'"),
        ("route NOT IN ('employer_resolution_candidate', 'ambiguous_review_candidate')", "'ineligible_route'"), ("coalesce(nombre_normalizado, '') = ''", "'missing_strict_key'"),
    ],
    "NULL",
)


def keys_sql(resolved: str) -> str:
    return (
        "SELECT nombre_normalizado AS resolution_key, nombre_normalizado AS representative_name, nullif(arg_min(nombre_matching, source_row_number), '') AS relaxed_key, count(*) AS source_row_frequency, "
        "arg_min(record_id, source_row_number) AS representative_record_id, min(source_row_number) AS representative_source_row_number, arg_min(route, source_row_number) AS representative_route, "
        "min(trailing_numeric_candidate) AS trailing_numeric_candidate, bool_or(possible_truncation) AS possible_truncation, max(token_count) AS token_count "
        f"FROM {resolved} WHERE {EXCLUSION} IS NULL GROUP BY nombre_normalizado"
    )


def informative(minimum: int, digits: bool) -> str:
    return f"list_filter(list_distinct({tokens('resolution_key')}), lambda t: length(t) >= {minimum} AND t NOT IN ({', '.join(map(text, GENERIC_TOKENS))}){'' if digits else ' AND NOT regexp_matches(t, %s)' % text('^[0-9]+$')})"


SIGNATURES = "list_distinct(list_concat([token], list_transform(range(1, length(token) + 1), lambda i: substr(token, 1, i - 1) || substr(token, i + 1))))"


def blocks(members: str, limit: int, method: str, keys: str) -> str:
    return (
        f"SELECT DISTINCT x.k AS key_a, y.k AS key_b, {text(method)} AS method FROM (SELECT *, count(*) OVER (PARTITION BY block) AS size FROM ({members.format(keys=keys)})) x "
        f"JOIN ({members.format(keys=keys)}) y ON x.block = y.block AND x.k < y.k WHERE x.size <= {limit}"
    )


def found(sql: str, x: str, y: str, method: str) -> str:
    return f"SELECT DISTINCT least({x}, {y}) AS key_a, greatest({x}, {y}) AS key_b, {text(method)} AS method FROM ({sql}) WHERE {x} <> {y}"


def blocking_ctes(keys: str, pre: str) -> dict[str, str]:
    """Subqueries of candidate generation from ``keys``, each named with the prefix ``pre``."""
    prefix = f"SELECT * FROM (SELECT substr(regexp_replace(resolution_key, '[^A-Z0-9]+', '', 'g'), 1, {C.prefix_signature_length}) AS block, resolution_key AS k FROM {{keys}}) WHERE length(block) = {C.prefix_signature_length}"
    token = f"SELECT unnest({informative(C.minimum_informative_token_length, True)}) AS block, resolution_key AS k FROM {{keys}}"
    cut = C.minimum_truncation_prefix_length
    universe = f"SELECT *, count(*) OVER (PARTITION BY block) AS size FROM (SELECT substr(resolution_key, 1, {cut}) AS block, resolution_key AS k, possible_truncation FROM {keys} WHERE length(resolution_key) >= {cut})"
    typo = max(C.minimum_typo_token_length, C.minimum_informative_token_length)
    used = "(SELECT key_a AS k FROM {0} UNION SELECT key_b FROM {0})"
    marks = f"SELECT DISTINCT k, unnest({SIGNATURES}) AS block FROM (SELECT resolution_key AS k, unnest({informative(typo, False)}) AS token FROM {keys})"
    context = f"SELECT k, toks, unnest(toks) AS context FROM (SELECT resolution_key AS k, {informative(C.minimum_informative_token_length, False)} AS toks FROM {keys})"
    marked = f"SELECT k, context, token, unnest({SIGNATURES}) AS mark FROM (SELECT k, context, unnest(toks) AS token FROM {{0}}) WHERE token <> context"
    out = {
        "b1": blocks("SELECT relaxed_key AS block, resolution_key AS k FROM {keys} WHERE relaxed_key IS NOT NULL", C.maximum_block_size, "relaxed_key", keys),
        "b2": found(f"SELECT a.resolution_key AS x, b.resolution_key AS y FROM {keys} a JOIN {keys} b ON a.trailing_numeric_candidate = b.resolution_key", "x", "y", "trailing_numeric"),
        "b3": found(f"SELECT q.k AS x, u.k AS y FROM ({universe}) q JOIN ({universe}) u ON q.block = u.block WHERE q.possible_truncation AND q.size <= {C.maximum_block_size}", "x", "y", "truncation_prefix"),
        "b4": blocks(token, min(C.maximum_token_frequency, C.maximum_block_size), "informative_token", keys),
        "b5": blocks(prefix, C.maximum_block_size, "prefix_signature", keys),
    }
    out = {pre + k: v for k, v in out.items()}
    out[pre + "u1"] = " UNION ALL ".join(f"SELECT * FROM {k}" for k in out)
    out[pre + "narrow"] = f"SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY block) AS size FROM ({marks})) WHERE size <= {C.maximum_typo_signature_frequency}"
    out[pre + "b6"] = found(f"SELECT a.k AS x, b.k AS y FROM {pre}narrow a JOIN {pre}narrow b ON a.block = b.block WHERE a.k NOT IN {used.format(pre + 'u1')}", "x", "y", "typo_token")
    out[pre + "u2"] = f"SELECT * FROM {pre}u1 UNION ALL SELECT * FROM {pre}b6"
    out[pre + "pool"] = f"SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY context) AS size FROM ({context})) WHERE size <= {C.maximum_typo_context_frequency}"
    out[pre + "asked"] = f"SELECT * FROM {pre}pool WHERE k NOT IN {used.format(pre + 'u2')}"
    out[pre + "b7"] = found(
        f"SELECT q.k AS x, c.k AS y FROM ({marked.format(pre + 'asked')}) q JOIN ({marked.format(pre + 'pool')}) c ON q.context = c.context AND q.mark = c.mark AND q.token <> c.token", "x", "y", "typo_context"
    )
    out[pre + "pairs"] = (
        f"SELECT key_a, key_b, key_a AS name_a, key_b AS name_b, list_filter({items(blocking.METHODS)}, lambda m: list_contains(held, m)) AS blocking_methods "
        f"FROM (SELECT key_a, key_b, list(DISTINCT method) AS held FROM (SELECT * FROM {pre}u2 UNION ALL SELECT * FROM {pre}b7) GROUP BY key_a, key_b)"
    )
    return out


CTE["idx"] = index_sql("refs", "alias_refs")
CTE["resolved"] = resolved_sql("idx")
CTE["keys"] = keys_sql("resolved")
CTE |= blocking_ctes("keys", "")


def numbers(x: str) -> str:
    return f"list_filter({tokens(x)}, lambda t: regexp_matches(t, '^[0-9]+$'))"


def six(x: str) -> str:
    return f"CAST(round_even({x}, 6) AS DOUBLE)"


CTE["f1"] = f"SELECT *, list_distinct({tokens('name_a')}) AS ta, list_distinct({tokens('name_b')}) AS tb, {numbers('name_a')} AS na, {numbers('name_b')} AS nb, least(length(name_a), length(name_b)) AS short, greatest(length(name_a), length(name_b)) AS long FROM pairs"
CTE["scored"] = (
    "SELECT key_a, key_b, name_a, name_b, blocking_methods, CAST(len(blocking_methods) AS SMALLINT) AS blocking_method_count, "
    f"{six('short / long')} AS length_ratio, {six('len(list_filter(range(1, short + 1), lambda i: substr(name_a, 1, i) = substr(name_b, 1, i))) / short')} AS common_prefix_ratio, "
    f"{six('len(list_distinct(list_intersect(ta, tb))) / len(list_distinct(list_concat(ta, tb)))')} AS token_jaccard, "
    "string_split(name_a, ' ')[1] = string_split(name_b, ' ')[1] AS same_first_token, "
    "CASE WHEN len(na) = 0 AND len(nb) = 0 THEN 'none' WHEN len(na) = 0 OR len(nb) = 0 THEN 'one_sided' WHEN na = nb THEN 'same' ELSE 'conflict' END AS numeric_relation FROM f1"
)


def suffix_part(name: str, part: str) -> str:
    found = []
    for canonical, variants in N.corporate_suffix_aliases.items():
        for v in variants:
            value = {"canonical": text(canonical), "variant": text(v), "base": f"substr({name}, 1, length({name}) - {len(v) + 1})"}[part]
            found.append((f"ends_with({name}, {text(' ' + v)}) AND length({name}) > {len(v) + 1}", value))
    return cases(found, "NULL")


LENGTHS = ", ".join(map(str, N.possible_truncation_content_lengths))


def side_sql(a: str, b: str, cut_a: str, cut_b: str) -> str:
    one = lambda s, t, c: f"length({s}) < length({t}) AND {c} AND length({s}) IN ({LENGTHS}) AND starts_with({t}, {s})"
    ok = "numeric_relation IN ('none', 'same') AND "
    return f"CASE WHEN {ok}{one(a, b, cut_a)} THEN 'a' WHEN {ok}{one(b, a, cut_b)} THEN 'b' END"


CTE["d1"] = (
    "SELECT s.*, ka.possible_truncation AS cut_a, kb.possible_truncation AS cut_b, "
    + ", ".join(f"{suffix_part('s.name_' + x, p)} AS {p}_{x}" for x in "ab" for p in ("canonical", "variant", "base"))
    + " FROM scored s JOIN keys ka ON s.key_a = ka.resolution_key JOIN keys kb ON s.key_b = kb.resolution_key"
)
CTE["d2"] = f"SELECT *, {side_sql('name_a', 'name_b', 'cut_a', 'cut_b')} AS side, replace(name_a, ' ', '') AS ca, replace(name_b, ' ', '') AS cb FROM d1"
CTE["d3"] = "SELECT *, count(*) OVER (PARTITION BY CASE side WHEN 'a' THEN key_a WHEN 'b' THEN key_b ELSE key_a || chr(31) || key_b END) AS continuations FROM d2"
HOLDS = (
    "canonical_a = canonical_b AND base_a = base_b AND variant_a <> variant_b",
    "(canonical_a IS NOT NULL AND canonical_b IS NULL AND base_a = name_b) OR (canonical_b IS NOT NULL AND canonical_a IS NULL AND base_b = name_a)",
    f"name_a <> name_b AND ca = cb AND length(ca) >= {S.minimum_whitespace_compact_length} AND numeric_relation IN ('none', 'same')",
    "side IS NOT NULL AND continuations = 1",
)
RULE_LIST = "list_filter([" + ", ".join(f"CASE WHEN {h} THEN {text(r)} END" for h, r in zip(HOLDS, RULES, strict=True)) + "], lambda r: r IS NOT NULL)"
CTE["d4"] = f"SELECT *, {RULE_LIST} AS rules FROM d3"
CTE["decisions"] = (
    "SELECT key_a, key_b, name_a, name_b, blocking_methods, numeric_relation, rules AS supporting_rules, CASE WHEN len(rules) > 0 THEN 'AUTO_SAME' ELSE 'NEEDS_FURTHER_RESOLUTION' END AS decision_status, "
    f"coalesce(rules[1], 'no_deterministic_equivalence') AS decision_rule, {cases([(f'rules[1] = {text(r)}', text(e)) for r, e in RULES.items()], text('no_deterministic_equivalence'))} AS decision_evidence FROM d4"
)

# ---- eligibility ---------------------------------------------------------------------------------------------------
STRENGTH = "CASE {0} WHEN 'none' THEN 0 WHEN 'weak' THEN 1 WHEN 'moderate' THEN 2 ELSE 3 END"
FLAGS = ("is_blank", "is_numeric_only", "has_address_signal", "has_occupation_signal", "has_activity_description_signal", "has_corporate_suffix", "has_organization_like_tokens", "mixed_address_organization_signal", "mixed_occupation_organization_signal")
CTE["e1"] = (
    "SELECT k.resolution_key, k.representative_name, k.representative_route, " + ", ".join(f"bool_or(p.{f}) AS {f}" for f in FLAGS)
    + f", max({STRENGTH.format('p.address_signal_strength')}) AS address_strength, max({STRENGTH.format('p.occupation_signal_strength')}) AS occupation_strength, "
    + ", ".join(f"bool_or(p.route = '{r}') AS r_{r}" for r in ("address_candidate", "non_employer_status_candidate", "blank_candidate"))
    + f", {tokens('k.representative_name')} AS toks FROM keys k JOIN pre p ON p.nombre_normalizado = k.resolution_key GROUP BY ALL"
)
CTE["e2"] = (
    "SELECT *, has_corporate_suffix OR has_organization_like_tokens AS org, address_strength >= 2 OR r_address_candidate AS addr, occupation_strength = 3 OR r_non_employer_status_candidate AS other, "
    "coalesce(len(toks) >= 6 AND regexp_matches(toks[1], '^[0-9]+$') AND len(list_filter(range(4, len(toks) - 1), lambda i: regexp_matches(toks[i], '^[0-9]{5}$') "
    f"AND list_has_any(toks[2:i-1], {items(S.road_type_tokens)}) AND regexp_matches(toks[i+1], '^[A-Za-z]{{2}}$') AND len(list_filter(toks[i+2:], lambda t: regexp_matches(t, '^[A-Za-z]+$'))) > 0)) > 0, false) AS street FROM e1"
)
ELIGIBLE = (
    ("is_blank OR is_numeric_only OR r_blank_candidate", "AMBIGUOUS", "invalid_content_abstention", "blank_or_numeric_only_content"),
    ("mixed_address_organization_signal OR mixed_occupation_organization_signal OR ((street OR addr) AND (has_occupation_signal OR other)) OR ((street OR addr) AND org) OR ((has_occupation_signal OR other) AND org)", "AMBIGUOUS", "mixed_evidence_abstention", "conflicting_address_occupation_or_organization_evidence"),
    ("street", "ADDRESS", "structural_street_zip_region_address", "leading_number_road_type_zip_region_and_locality"),
    ("addr", "ADDRESS", "existing_address_signal", "existing_moderate_or_strong_address_evidence"),
    ("other", "NON_EMPLOYER_STATUS", "existing_non_employer_status", "existing_pure_status_or_non_employer_route"),
    ("has_occupation_signal OR has_activity_description_signal", "AMBIGUOUS", "descriptive_activity_abstention", "descriptive_occupation_or_activity_requires_abstention"),
    ("has_address_signal", "AMBIGUOUS", "insufficient_evidence_abstention", "weak_or_prior_ambiguous_evidence"),
    ("org", "EMPLOYER_CANDIDATE", "organization_compatible", "corporate_suffix_or_organization_token_without_exclusion"),
    ("representative_route = 'employer_resolution_candidate'", "EMPLOYER_CANDIDATE", "prior_employer_route", "prior_employer_route_without_stronger_exclusion"),
)
CTE["elig"] = (
    f"SELECT resolution_key, representative_name, {cases([(c, text(s)) for c, s, _, _ in ELIGIBLE], text('AMBIGUOUS'))} AS eligibility_status, "
    f"{cases([(c, text(r)) for c, _, r, _ in ELIGIBLE], text('insufficient_evidence_abstention'))} AS eligibility_rule, "
    f"{cases([(c, text(w)) for c, _, _, w in ELIGIBLE], text('insufficient_evidence_for_safe_mention_type'))} AS eligibility_evidence FROM e2"
)

# ---- evidence ------------------------------------------------------------------------------------------------------
LEGAL, GENERIC = items(evidence.legal_tokens(S)), items(GENERIC_TOKENS)


def core(name: str) -> str:
    drop = cases([(f"ends_with({name}, {text(' ' + ' '.join(s))}) AND len({tokens(name)}) > {len(s)}", str(len(s))) for s in evidence.legal_suffixes(S)], "0")
    return f"{tokens(name)}[1:len({tokens(name)}) - ({drop})]"


def alpha(x: str) -> str:
    return f"regexp_matches({x}, '^\\p{{L}}+$')"


CTE["cores"] = f"SELECT k.resolution_key, {core('k.representative_name')} AS core FROM keys k JOIN elig e USING (resolution_key) WHERE e.eligibility_status = 'EMPLOYER_CANDIDATE'"
CTE["support"] = "SELECT token, count(*) AS support FROM (SELECT unnest(list_distinct(core)) AS token FROM cores) GROUP BY token"
CTE["o1"] = (
    f"SELECT d.key_a, d.key_b, d.name_a, d.name_b, d.numeric_relation, ea.eligibility_status = 'EMPLOYER_CANDIDATE' AND eb.eligibility_status = 'EMPLOYER_CANDIDATE' AS ok, {core('d.name_a')} AS a, {core('d.name_b')} AS b "
    "FROM decisions d JOIN elig ea ON d.key_a = ea.resolution_key JOIN elig eb ON d.key_b = eb.resolution_key WHERE d.decision_status <> 'AUTO_SAME'"
)
CTE["o2"] = "SELECT *, list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i]) AS diff FROM o1"
CTE["o3"] = "SELECT *, CASE WHEN len(diff) = 1 THEN a[diff[1]] END AS x, CASE WHEN len(diff) = 1 THEN b[diff[1]] END AS y FROM o2"
CTE["o4"] = (
    f"SELECT *, list_filter(list_transform(range(1, len(a) + 1), lambda i: CASE WHEN i <> diff[1] THEN a[i] END), lambda t: t IS NOT NULL AND {alpha('t')} AND length(t) >= {C.minimum_informative_token_length} "
    f"AND NOT list_contains({GENERIC}, t) AND NOT list_contains({LEGAL}, t)) AS context, "
    "CASE WHEN length(x) <= length(y) THEN x ELSE y END AS s, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS l FROM o3"
)
CTE["o5"] = "SELECT *, coalesce(list_filter(range(1, length(s) + 1), lambda i: substr(s, i, 1) <> substr(l, i, 1))[1] - 1, length(s)) AS spot FROM o4"
GATES = (
    ("NOT ok", "not_both_employer_candidate"),
    ("numeric_relation NOT IN ('none', 'same')", "numeric_evidence_incompatible"),
    ("len(a) <> len(b)", "core_token_count_mismatch"),
    ("len(diff) = 0", "no_core_token_difference"),
    ("len(diff) > 1", "multiple_core_token_differences"),
    (f"NOT ({alpha('x')} AND {alpha('y')})", "differing_token_not_alphabetic"),
    (f"list_contains({LEGAL}, x) OR list_contains({LEGAL}, y)", "legal_designator_is_differing_token"),
    (f"list_contains({GENERIC}, x) OR list_contains({GENERIC}, y)", "generic_token_is_differing_token"),
    (f"least(length(x), length(y)) < {C.minimum_typo_token_length}", "short_typo_token"),
    ("levenshtein(x, y) <> 1", "edit_distance_not_one"),
    ("len(context) = 0", "no_exact_informative_context"),
)
CTE["o6"] = f"SELECT *, {cases([(c, text(g)) for c, g in GATES], 'NULL')} AS gate FROM o5"
CTE["o7"] = "SELECT *, CASE WHEN gate IS NULL THEN array_to_string(list_transform(range(1, len(a) + 1), lambda i: CASE WHEN i = diff[1] THEN '<DIFF>' ELSE a[i] END), ' ') END AS context_signature FROM o6"
CTE["gaps"] = (
    "SELECT signature, count(DISTINCT token) AS variants FROM (SELECT core[i] AS token, array_to_string(list_transform(range(1, len(core) + 1), lambda j: CASE WHEN j = i THEN '<DIFF>' ELSE core[j] END), ' ') AS signature "
    "FROM (SELECT core, unnest(range(1, len(core) + 1)) AS i FROM cores)) WHERE signature IN (SELECT context_signature FROM o7) GROUP BY signature"
)
CTE["rarest"] = "SELECT key_a, key_b, min(support) AS rarest FROM (SELECT key_a, key_b, unnest(context) AS token FROM o7 WHERE gate IS NULL) JOIN support USING (token) GROUP BY key_a, key_b"
LATER = (
    ("spot = length(l) - 1 AND spot <> 0", "terminal_edit_requires_further_resolution"),
    (f"rarest > {C.maximum_token_frequency}", "no_distinctive_exact_context"),
    ("variants >= 3", "multi_variant_context"),
    (f"sa.support > {C.maximum_token_frequency} AND sb.support > {C.maximum_token_frequency}", "both_differing_tokens_established"),
)
STRONG = "one_alphabetic_token_edit_distance_1_with_exact_context"
CTE["o8"] = (
    f"SELECT o7.*, variants, sa.support AS support_a, sb.support AS support_b, coalesce(gate, {cases([(c, text(v)) for c, v in LATER], text(STRONG))}) AS evidence FROM o7 LEFT JOIN gaps ON signature = context_signature "
    "LEFT JOIN rarest USING (key_a, key_b) LEFT JOIN support sa ON sa.token = x LEFT JOIN support sb ON sb.token = y"
)
SHOWN = "gate IS NULL OR gate IN ('no_exact_informative_context', 'differing_token_not_alphabetic', 'legal_designator_is_differing_token', 'generic_token_is_differing_token', 'short_typo_token', 'edit_distance_not_one')"
CTE["ortho"] = (
    "SELECT key_a, key_b, name_a, name_b, numeric_relation, "
    f"CASE WHEN NOT ok THEN 'NOT_ELIGIBLE_FOR_ORTHOGRAPHIC' WHEN evidence = '{STRONG}' THEN 'STRONG_ORTHOGRAPHIC_EVIDENCE' ELSE 'NEEDS_FURTHER_RESOLUTION' END AS orthographic_status, "
    f"CASE WHEN NOT ok THEN 'not_eligible_for_orthographic' WHEN evidence = '{STRONG}' THEN 'single_token_edit_equivalence' ELSE 'no_orthographic_equivalence' END AS orthographic_rule, evidence AS orthographic_evidence, "
    f"CASE WHEN {SHOWN} THEN x END AS differing_token_a, CASE WHEN {SHOWN} THEN y END AS differing_token_b, "
    "CASE WHEN gate IS NULL OR gate = 'no_exact_informative_context' THEN CASE WHEN length(x) = length(y) THEN 'substitution' WHEN length(x) < length(y) THEN 'insertion' ELSE 'deletion' END END AS edit_operation, "
    "context_signature, CASE WHEN gate IS NULL THEN CAST(variants AS INT) END AS context_variant_count, CASE WHEN gate IS NULL THEN support_a END AS token_support_a, CASE WHEN gate IS NULL THEN support_b END AS token_support_b FROM o8"
)


def times(lst: str, t: str) -> str:
    return f"len(list_filter({lst}, lambda u: u = {t}))"


def extras(short: str, long: str) -> str:
    walked = (
        f"list_reduce(list_transform({long}, lambda t: {{'i': 0, 'e': [t]}}), lambda acc, v: CASE WHEN {short}[acc.i + 1] IS NOT DISTINCT FROM v.e[1] THEN {{'i': acc.i + 1, 'e': acc.e}} "
        f"ELSE {{'i': acc.i, 'e': list_append(acc.e, v.e[1])}} END, {{'i': 0, 'e': CAST([] AS VARCHAR[])}})"
    )
    return f"CASE WHEN len({short}) < len({long}) AND ({walked}).i = len({short}) THEN ({walked}).e END"


def initials(short: str, long: str) -> str:
    real = f"list_filter({long}, lambda t: {alpha('t')} AND NOT list_contains({LEGAL}, t))"
    return f"len({short}) = 1 AND len({long}) >= 2 AND {alpha(short + '[1]')} AND length({short}[1]) BETWEEN 2 AND 10 AND len({real}) >= 2 AND {short}[1] = array_to_string(list_transform({real}, lambda t: substr(t, 1, 1)), '')"


CTE["r1"] = (
    f"SELECT o.key_a, o.key_b, o.name_a, o.name_b, o.numeric_relation, o.orthographic_evidence, {core('o.name_a')} AS a, {core('o.name_b')} AS b, ka.possible_truncation AS possible_truncation_a, kb.possible_truncation AS possible_truncation_b "
    "FROM ortho o JOIN keys ka ON ka.resolution_key = o.key_a JOIN keys kb ON kb.resolution_key = o.key_b WHERE o.orthographic_status = 'NEEDS_FURTHER_RESOLUTION'"
)
CTE["r2"] = (
    "SELECT *, list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i]) AS diff, "
    f"list_filter(list_distinct(a), lambda t: list_contains(b, t)) AS common, a <> b AND list_sort(a) = list_sort(b) AS is_token_reorder, coalesce({extras('a', 'b')}, {extras('b', 'a')}) AS extra, "
    f"len(list_filter(a, lambda t: {times('a', 't')} > {times('b', 't')})) = 0 OR len(list_filter(b, lambda t: {times('b', 't')} > {times('a', 't')})) = 0 AS is_token_multiset_containment, "
    f"coalesce({initials('a', 'b')}, false) OR coalesce({initials('b', 'a')}, false) AS has_initialism_pattern, {side_sql('name_a', 'name_b', 'possible_truncation_a', 'possible_truncation_b')} AS side FROM r1"
)
CTE["r3"] = f"SELECT *, list_transform(diff, lambda i: levenshtein(a[i], b[i])) AS edits, CAST(coalesce(list_sum(list_transform(common, lambda t: least({times('a', 't')}, {times('b', 't')}))), 0) AS INT) AS shared_exact_token_count FROM r2"
FAMILIES = (
    ("numeric_relation IN ('one_sided', 'conflict')", "NUMERIC_VARIATION", "'persisted_numeric_relation=' || numeric_relation"),
    ("side IS NOT NULL", "POSSIBLE_TRUNCATION_RELATIONSHIP", "'exact_source_boundary_prefix;truncated_side=' || side"),
    ("is_token_reorder", "EXACT_TOKEN_REORDER", "'equal_token_multiset_with_different_sequence'"),
    ("len(extra) = 1", "SINGLE_TOKEN_ADDITION_REMOVAL", "'ordered_subsequence;additional_token=' || extra[1]"),
    ("len(extra) >= 2", "MULTI_TOKEN_ADDITION_REMOVAL", "'ordered_subsequence;additional_token_count=' || len(extra)"),
    ("is_token_multiset_containment AND len(a) <> len(b)", "EXACT_TOKEN_CONTAINMENT_NONALIGNED", "'multiplicity_preserving_containment_without_ordered_subsequence'"),
    ("has_initialism_pattern", "ACRONYM_INITIALISM_PATTERN", "'single_token_equals_nonlegal_token_initials'"),
    (f"len(a) = len(b) AND len(diff) >= 2 AND len(list_filter(diff, lambda i: NOT ({alpha('a[i]')} AND {alpha('b[i]')}))) = 0 AND list_max(edits) <= 2", "MULTIPLE_SMALL_TOKEN_EDITS", "'aligned_differences=' || len(diff) || ';maximum_edit_distance=' || list_max(edits) || ';total_edit_distance=' || list_sum(edits)"),
    ("len(a) = len(b) AND len(diff) = 1", "SINGLE_TOKEN_LARGER_EDIT", "'single_aligned_token_difference;edit_distance=' || list_max(edits) || ';orthographic_evidence=' || orthographic_evidence"),
    ("(len(a) = len(b) AND len(diff) >= 2) OR (len(a) <> len(b) AND (shared_exact_token_count > 0 OR len(list_filter(edits, lambda e: e <= 2)) > 0))", "MIXED_STRUCTURAL_RELATIONSHIP", "'multiple_structural_transformations_required'"),
)
CTE["resid"] = (
    "SELECT key_a, key_b, name_a, name_b, numeric_relation, orthographic_evidence, "
    f"{cases([(c, text(f)) for c, f, _ in FAMILIES], text('OTHER_RESIDUAL'))} AS primary_family, {cases([(c, e) for c, _, e in FAMILIES], text('no_supported_deterministic_structural_family'))} AS family_evidence, "
    "CAST(len(a) AS INT) AS core_token_count_a, CAST(len(b) AS INT) AS core_token_count_b, shared_exact_token_count, CASE WHEN len(diff) > 0 THEN array_to_string(list_transform(diff, lambda i: i - 1), ',') END AS differing_token_positions, "
    "CAST(len(diff) AS INT) AS differing_token_count, CASE WHEN len(extra) = 1 THEN extra[1] END AS added_removed_token, CAST(abs(len(a) - len(b)) AS INT) AS added_removed_token_count, "
    "CAST(list_max(edits) AS INT) AS maximum_token_edit_distance, CAST(list_sum(edits) AS INT) AS total_token_edit_distance, is_token_reorder, extra IS NOT NULL AS is_ordered_subsequence, is_token_multiset_containment, has_initialism_pattern, "
    "possible_truncation_a, possible_truncation_b FROM r3"
)
CTE["v1"] = "SELECT key_a, key_b, name_a, name_b, a, b, unnest(common) AS token FROM r2"
CTE["v2"] = (
    f"SELECT v1.*, least({times('a', 'token')}, {times('b', 'token')}) AS n, s.support, NOT list_contains({LEGAL}, token) AS real, list_contains({GENERIC}, token) AS generic, "
    f"{alpha('token')} AND length(token) >= {C.minimum_informative_token_length} AND NOT list_contains({LEGAL}, token) AND NOT list_contains({GENERIC}, token) AND s.support <= {C.maximum_token_frequency} AS rare FROM v1 JOIN support s USING (token)"
)
CTE["v3"] = (
    "SELECT key_a, key_b, CAST(sum(n) AS INT) AS n, CAST(coalesce(sum(n) FILTER (rare), 0) AS INT) AS d, CAST(coalesce(sum(n) FILTER (generic), 0) AS INT) AS g, "
    "string_agg(rtrim(repeat(token || '|', CAST(n AS INT)), '|'), '|' ORDER BY token) AS shared, string_agg(rtrim(repeat(token || '|', CAST(n AS INT)), '|'), '|' ORDER BY token) FILTER (rare) AS rares, "
    "min(support) FILTER (real) AS s1, max(support) FILTER (real) AS s2, min(support) FILTER (rare) AS s3, max(support) FILTER (rare) AS s4 FROM v2 GROUP BY key_a, key_b"
)
CTE["v4"] = "SELECT r2.key_a, r2.key_b, name_a, name_b, len(a) AS la, len(b) AS lb, coalesce(n, 0) AS n, coalesce(d, 0) AS d, coalesce(g, 0) AS g, coalesce(shared, '') AS shared, coalesce(rares, '') AS rares, s1, s2, s3, s4 FROM r2 LEFT JOIN v3 USING (key_a, key_b)"
COVER = {f"{k}{x}": six(f"{k} / l{x}") for k in "nd" for x in "ab"}
CTE["dist"] = (
    "SELECT key_a, key_b, name_a, name_b, shared AS shared_exact_tokens, rares AS shared_distinctive_tokens, n AS shared_exact_token_count, d AS shared_distinctive_token_count, g AS shared_generic_token_count, "
    "s1 AS minimum_shared_token_support, s2 AS maximum_shared_token_support, s3 AS minimum_distinctive_token_support, s4 AS maximum_distinctive_token_support, "
    f"{COVER['na']} AS exact_coverage_a, {COVER['nb']} AS exact_coverage_b, {COVER['da']} AS distinctive_coverage_a, {COVER['db']} AS distinctive_coverage_b, "
    + ", ".join(
        f"CASE WHEN la {'<=' if short else '>'} lb THEN {COVER[k + 'a']} ELSE {COVER[k + 'b']} END AS {'shorter' if short else 'longer'}_name_{name}_coverage"
        for k, name in (("n", "exact"), ("d", "distinctive")) for short in (True, False)
    )
    + ", n > 0 AS has_shared_exact_token, d > 0 AS has_shared_distinctive_token, d >= 2 AS has_multiple_shared_distinctive_tokens, n > 0 AND d = 0 AS has_exact_overlap_without_distinctive_token FROM v4"
)
CTE["m1"] = (
    f"SELECT r.key_a, r.key_b, r.primary_family, r.numeric_relation, r.orthographic_evidence, x.*  EXCLUDE (key_a, key_b, name_a, name_b), r.primary_family IN ({', '.join(map(text, evidence.STRUCTURAL))}) AS structural, "
    f"r.orthographic_evidence IN ({', '.join(map(text, evidence.LOCALIZED))}) AS local, r.numeric_relation IN ('one_sided', 'conflict') AS risk FROM resid r JOIN dist x USING (key_a, key_b)"
)
ASSESS = (
    ("risk AND shared_exact_token_count > 0", "NUMERIC_RISK_WITH_NAME_EVIDENCE"),
    ("structural AND has_multiple_shared_distinctive_tokens", "STRUCTURE_WITH_MULTIPLE_DISTINCTIVE_TOKENS"),
    ("structural AND has_shared_distinctive_token", "STRUCTURE_WITH_DISTINCTIVE_TOKEN"),
    ("local AND has_shared_distinctive_token", "LOCAL_ORTHOGRAPHIC_WITH_DISTINCTIVE_CONTEXT"),
    ("primary_family = 'MULTIPLE_SMALL_TOKEN_EDITS' AND has_shared_distinctive_token", "MULTI_EDIT_WITH_DISTINCTIVE_CONTEXT"),
    ("shorter_name_exact_coverage = 1.0", "FULL_SHORTER_NAME_OVERLAP"),
    ("has_shared_distinctive_token", "DISTINCTIVE_SINGLE_SIGNAL"),
    ("risk", "WEAK_OR_MIXED_EVIDENCE"),
    ("shared_exact_token_count > 0", "EXACT_OVERLAP_WITHOUT_DISTINCTIVE_EVIDENCE"),
)
CTE["multi"] = (
    f"SELECT key_a, key_b, {cases([(c, text(f)) for c, f in ASSESS], text('ZERO_EXACT_OVERLAP'))} AS assessment_family, "
    "'primary_family=' || primary_family || ';numeric_relation=' || numeric_relation || ';shared_exact_tokens=' || shared_exact_token_count || ';shared_distinctive_tokens=' || shared_distinctive_token_count "
    "|| ';shorter_exact_coverage=' || format('{:.6f}', shorter_name_exact_coverage) || ';orthographic_evidence=' || orthographic_evidence AS assessment_evidence, "
    "structural AS has_structural_exact_relation, local AS has_orthographic_signal, has_shared_distinctive_token AS has_distinctive_exact_overlap, has_multiple_shared_distinctive_tokens AS has_multiple_distinctive_exact_overlap, "
    "risk AS has_numeric_risk, shared_exact_token_count = 0 AS has_zero_exact_overlap, shorter_name_exact_coverage = 1.0 AS has_full_shorter_exact_coverage, shorter_name_distinctive_coverage = 1.0 AS has_full_shorter_distinctive_coverage FROM m1"
)

# ---- entities: the feed has no component with two legal forms, so plain components are the constrained ones ------------
MISSING = f"coalesce(trim(regexp_replace(upper({{0}}), '\\s+', ' ', 'g')) IN ({', '.join(map(text, finalize.MISSING))}), false)"
CTE["employers"] = f"SELECT k.* FROM keys k JOIN elig e USING (resolution_key) WHERE e.eligibility_status = 'EMPLOYER_CANDIDATE' AND NOT {MISSING.format('k.resolution_key')}"
CTE["same"] = (
    "SELECT key_a, key_b, decision_rule FROM decisions WHERE decision_status = 'AUTO_SAME' AND key_a IN (SELECT resolution_key FROM employers) AND key_b IN (SELECT resolution_key FROM employers)"
)
CTE["both_ways"] = "SELECT key_a AS x, key_b AS y FROM same UNION SELECT key_b, key_a FROM same"
CTE["reach"] = "SELECT resolution_key AS k, resolution_key AS c FROM employers UNION SELECT reach.k, b.y FROM reach JOIN both_ways b ON b.x = reach.c"
CTE["member"] = "SELECT k AS resolution_key, min(c) AS component FROM reach GROUP BY k"
CTE["comp_rules"] = "SELECT component, string_agg(DISTINCT decision_rule, '|' ORDER BY decision_rule) AS rules FROM same JOIN member ON key_a = resolution_key GROUP BY component"


def form_sql(key: str) -> str:
    spaced = f"' ' || array_to_string(regexp_extract_all(upper({key}), '[A-Z0-9]+'), ' ')"
    return cases([(f"ends_with({spaced}, {text(' ' + s)})", text(f)) for s, f in graph.LEGAL_FORMS], "NULL")


def sector_sql(name: str, part: str) -> str:
    toks = f"regexp_extract_all(upper({name}), '[A-Z0-9]+')"
    found = []
    for label, words in S.sectors.items():
        value = {"sector": text(label), "method": "'keyword_taxonomy'", "evidence": f"array_to_string(list_sort(list_distinct(list_intersect({toks}, {items(words)}))), '|')"}[part]
        found.append((f"list_has_any({toks}, {items(words)})", value))
    return cases(found, {"sector": "'No determinado'", "method": "'not_determined'", "evidence": "NULL"}[part])


RANK = f"(CAST(NOT possible_truncation AS INT), source_row_frequency, CAST({form_sql('resolution_key')} IS NOT NULL AS INT), -len(list_filter({tokens('resolution_key')}, lambda t: length(t) = 1)), token_count, length(representative_name), resolution_key)"
CTE["c1"] = (
    f"SELECT component, arg_max(resolution_key, {RANK}) AS canonical_resolution_key, CAST(count(*) AS INT) AS component_key_count, CAST(sum(source_row_frequency) AS BIGINT) AS component_source_row_count, "
    "'ENT-' || upper(substr(sha256(string_agg(resolution_key, chr(0) ORDER BY resolution_key)), 1, 16)) AS entity_id FROM employers JOIN member USING (resolution_key) GROUP BY component"
)
CTE["parts"] = (
    f"SELECT m.resolution_key, m.component, entity_id, canonical_resolution_key, canonical_resolution_key AS canonical_name, {sector_sql('canonical_resolution_key', 'sector')} AS sector, "
    f"{sector_sql('canonical_resolution_key', 'method')} AS sector_method, {sector_sql('canonical_resolution_key', 'evidence')} AS sector_evidence, component_key_count, component_source_row_count, rules AS decision_rules "
    "FROM member m JOIN c1 USING (component) LEFT JOIN comp_rules USING (component)"
)
CTE["reuse"] = (
    "SELECT entity_id, min(canonical_name) AS canonical_name, CAST(count(DISTINCT nombre_normalizado) AS INT) AS component_key_count, count(*) AS component_source_row_count, "
    "string_agg(DISTINCT resolution_reason, '|' ORDER BY resolution_reason) AS decision_rules FROM resolved WHERE resolution_status = 'resolved' GROUP BY entity_id"
)
CTE["z1"] = (
    f"SELECT r.*, e.eligibility_status, e.eligibility_rule, e.eligibility_evidence, p.entity_id AS k_id, p.canonical_resolution_key AS k_key, p.canonical_name AS k_name, p.component_key_count AS k_n, p.component_source_row_count AS k_rows, p.decision_rules AS k_rules, "
    "u.canonical_name AS u_name, u.component_key_count AS u_n, u.component_source_row_count AS u_rows, u.decision_rules AS u_rules, "
    f"CASE WHEN r.resolution_status = 'resolved' THEN 1 WHEN {MISSING.format('r.nombre_normalizado')} THEN 2 WHEN r.route = 'address_candidate' OR e.eligibility_status = 'ADDRESS' THEN 3 "
    "WHEN e.eligibility_status = 'EMPLOYER_CANDIDATE' AND p.entity_id IS NOT NULL THEN CASE WHEN p.component_key_count > 1 AND p.decision_rules IS NOT NULL THEN 5 ELSE 6 END ELSE 7 END AS c "
    "FROM resolved r LEFT JOIN elig e ON e.resolution_key = r.nombre_normalizado LEFT JOIN parts p ON p.resolution_key = r.nombre_normalizado LEFT JOIN reuse u ON u.entity_id = r.entity_id"
)
CTE["z2"] = f"SELECT *, CASE WHEN c = 1 THEN u_name WHEN c IN (5, 6) THEN k_name END AS who, {sector_sql('CASE WHEN c = 1 THEN u_name WHEN c IN (5, 6) THEN k_name END', 'sector')} AS s1, {sector_sql('CASE WHEN c = 1 THEN u_name WHEN c IN (5, 6) THEN k_name END', 'method')} AS s2, {sector_sql('CASE WHEN c = 1 THEN u_name WHEN c IN (5, 6) THEN k_name END', 'evidence')} AS s3 FROM z1"
FOUND = "CASE WHEN s2 = 'keyword_taxonomy' THEN 'Sector inferido por palabras clave exactas: ' || s3 || '.' ELSE 'Sector no asignado sin evidencia suficiente.' END"
CTE["final"] = (
    "SELECT record_id, source_row_number, nombre_original, nombre_normalizado, CASE WHEN c IN (1, 5, 6) THEN nombre_normalizado WHEN eligibility_status IS NOT NULL THEN nombre_normalizado END AS resolution_key, "
    "CASE WHEN c = 1 THEN entity_id WHEN c IN (5, 6) THEN k_id END AS entity_id, coalesce(who, CASE WHEN c = 3 THEN 'No identificable - Direcciones' ELSE 'No identificable - Falta informacion' END) AS nombre_propuesto, "
    "CASE WHEN who IS NULL THEN 'No aplica' ELSE s1 END AS sector_propuesto, CASE WHEN who IS NULL THEN 'not_applicable' ELSE s2 END AS metodo_sector, CASE WHEN who IS NOT NULL THEN s3 END AS sector_evidence, "
    "CASE c WHEN 1 THEN 'EMPRESA_CANONICALIZADA_AUTO' WHEN 3 THEN 'NO_IDENTIFICABLE_DIRECCION' WHEN 5 THEN 'EMPRESA_CANONICALIZADA_AUTO' WHEN 6 THEN 'EMPRESA_NORMALIZADA_SIN_VALIDACION_PUBLICA' ELSE 'NO_IDENTIFICABLE_FALTA_INFORMACION' END AS resultado_final, "
    "CASE WHEN c IN (1, 2, 5) THEN 'ALTA' WHEN c = 3 THEN CASE WHEN eligibility_status = 'ADDRESS' THEN 'ALTA' ELSE 'MEDIA' END WHEN c = 6 THEN 'MEDIA' ELSE 'BAJA' END AS confianza_resolucion, "
    "CASE c WHEN 1 THEN 92 WHEN 2 THEN 100 WHEN 3 THEN 100 WHEN 5 THEN 92 WHEN 6 THEN 60 ELSE 40 END AS score_confianza_resolucion, "
    "CASE WHEN who IS NULL THEN 'NO_APLICA' WHEN s2 = 'keyword_taxonomy' THEN 'MEDIA' ELSE 'NO_DETERMINADA' END AS confianza_sector, "
    "CASE c WHEN 1 THEN 'exact_reference_' || replace(resolution_method, 'exact_', '') WHEN 2 THEN 'explicit_missing_information' WHEN 3 THEN 'record_typing_address' WHEN 5 THEN 'deterministic_auto_same_component' WHEN 6 THEN 'normalized_employer_key' ELSE 'precision_first_abstention' END AS metodo_resolucion, "
    f"CASE c WHEN 1 THEN 'Identidad reutilizada por referencia exacta persistente. ' || {FOUND} WHEN 2 THEN 'El valor normalizado corresponde explícitamente a ausencia de información y no se interpreta como empleador.' "
    f"WHEN 3 THEN 'El registro contiene evidencia de dirección y no se atribuye a una empresa.' WHEN 5 THEN 'Equivalencia textual determinista AUTO_SAME. ' || {FOUND} WHEN 6 THEN 'Se conserva la clave normalizada sin enlace determinista. ' || {FOUND} "
    "ELSE 'La evidencia no permite identificar una empresa con precisión suficiente; el proceso se abstiene.' END AS explicacion, eligibility_status, eligibility_rule, eligibility_evidence, "
    "CASE WHEN c = 1 THEN u_name WHEN c IN (5, 6) THEN k_key END AS canonical_resolution_key, coalesce(CASE WHEN c = 1 THEN u_n WHEN c IN (5, 6) THEN k_n END, 0) AS component_key_count, "
    "coalesce(CASE WHEN c = 1 THEN u_rows WHEN c IN (5, 6) THEN k_rows END, 0) AS component_source_row_count, CASE WHEN c = 1 THEN u_rules WHEN c IN (5, 6) THEN k_rules END AS decision_rules, "
    "CAST(NULL AS VARCHAR) AS public_entity_id, CAST(NULL AS VARCHAR) AS public_source_url, CAST(NULL AS VARCHAR) AS public_validation_date, route, route_reason FROM z2"
)
CTE["master"] = (
    "SELECT entity_id, min(nombre_propuesto) AS canonical_name, min(sector_propuesto) AS sector, CASE min(resultado_final) WHEN 'EMPRESA_CANONICALIZADA_AUTO' THEN 'AUTO_CANONICALIZED' ELSE 'NORMALIZED_CANDIDATE' END AS resolution_status, "
    "CASE WHEN bool_and(starts_with(metodo_resolucion, 'exact_reference')) THEN 'reference_exact_reuse' ELSE min(metodo_resolucion) END AS resolution_method, min(confianza_resolucion) AS confidence_level, min(score_confianza_resolucion) AS confidence_score, "
    "min(component_key_count) AS component_key_count, min(component_source_row_count) AS source_row_count, 'NOT_PUBLIC_VALIDATED' AS public_validation_status, min(public_entity_id) AS public_entity_id, min(public_source_url) AS public_source_url, "
    "min(public_validation_date) AS public_validation_date FROM final WHERE entity_id IS NOT NULL GROUP BY entity_id"
)
CTE["aliases"] = (
    "SELECT f.entity_id, f.resolution_key, f.resolution_key AS representative_name, m.resolution_method AS alias_method, m.confidence_score AS alias_confidence_score, count(*) AS source_row_frequency "
    "FROM final f JOIN master m USING (entity_id) GROUP BY ALL"
)
NAMED = (
    ("regexp_matches(canonical_name, '[\\x00-\\x1f\\x7f\\x{80}-\\x{9f}\\x{FFFD}]')", "SUSPICIOUS", "invalid_control_or_replacement_character"),
    ("resolution_status = 'NORMALIZED_CANDIDATE'", "NOT_PROMOTABLE", "normalized_candidate_not_promotable"),
    ("suffixed", "SUSPICIOUS", "legal_suffix_trailing_numeric"),
    ("numbered", "SUSPICIOUS", "trailing_numeric"),
)
CTE["q1"] = (
    r"SELECT *, regexp_matches(canonical_name, '\s+[0-9]+$') AS numbered, regexp_matches(canonical_name, '(?i)(?:\bSA|\bS\s+A|\bCA|\bC\s+A|\bSPA|\bINC|\bLLC|\bLTD|\bCORP|\bSRL|\bS\s+R\s+L)\s+[0-9]+$') AS suffixed FROM master"
)
CTE["quality"] = (
    f"SELECT entity_id, canonical_name, resolution_status, confidence_score, {cases([(c, text(q)) for c, q, _ in NAMED], text('ACCEPTABLE'))} AS quality_status, {cases([(c, text(r)) for c, _, r in NAMED], text('auto_canonical_name_acceptable'))} AS quality_reason, "
    f"numbered AS has_trailing_numeric, suffixed AS legal_suffix_trailing_numeric, {NAMED[0][0]} AS has_invalid_character, {cases([(c, text(q)) for c, q, _ in NAMED], text('ACCEPTABLE'))} = 'ACCEPTABLE' AS promotion_eligible FROM q1"
)
CTE["refs2"] = "SELECT entity_id, canonical_name FROM refs UNION SELECT entity_id, canonical_name FROM quality WHERE promotion_eligible"
CTE["alias_refs2"] = "SELECT entity_id, alias_name FROM alias_refs UNION SELECT a.entity_id, a.representative_name FROM aliases a JOIN quality q USING (entity_id) WHERE q.promotion_eligible"
CTE["idx2"] = index_sql("refs2", "alias_refs2")
CTE["resolved2"] = resolved_sql("idx2")
CTE["keys2"] = keys_sql("resolved2")
CTE |= blocking_ctes("keys2", "s_")
CTE["zero"] = "SELECT * FROM keys WHERE resolution_key NOT IN (SELECT key_a FROM pairs UNION SELECT key_b FROM pairs)"


def changed(sql: str, *pairs: tuple[str, str]) -> str:
    """``sql`` with parts replaced, each of which it must hold."""
    for old, new in pairs:
        if old not in sql:
            raise ValueError(f"no {old!r} in the SQL")
        sql = sql.replace(old, new)
    return sql


# ---- the same entities with a public catalogue -----------------------------------------------------------------------
CTE["pub0"] = "SELECT component, canonical_resolution_key, (row_number() OVER (ORDER BY component) - 1) // 2 AS n FROM c1 WHERE starts_with(entity_id, 'ENT-0')"
CTE["catalogue"] = (
    "SELECT 'PUB-' || lpad(CAST(n AS VARCHAR), 6, '0') AS public_entity_id, resolution_key, min(resolution_key) OVER (PARTITION BY n) || ' PUBLICA' AS canonical_name, "
    "CASE WHEN n % 2 = 0 THEN 'Educación' ELSE 'Finanzas' END AS sector, 'https://example.org/' || n AS source_url, '2024-01-15' AS validated_on "
    "FROM (SELECT n, canonical_resolution_key AS resolution_key FROM pub0 UNION SELECT n, component FROM pub0)"
)
CTE["joined"] = "SELECT component AS old, n, min(component) OVER (PARTITION BY n) AS component FROM pub0"
CTE["member_p"] = "SELECT m.resolution_key, coalesce(j.component, m.component) AS component, j.n FROM member m LEFT JOIN joined j ON j.old = m.component"
CTE["comp_rules_p"] = changed(CTE["comp_rules"], ("JOIN member ON", "JOIN member_p ON"))
CTE["c1_p"] = changed(CTE["c1"], ("JOIN member USING", "JOIN member_p USING"))
CTE["c2_p"] = (
    "SELECT c.*, p.public_entity_id, p.sector AS public_sector, p.source_url, p.validated_on, coalesce(p.canonical_name, c.canonical_resolution_key) AS canonical_name FROM c1_p c "
    "LEFT JOIN (SELECT DISTINCT component, n FROM member_p WHERE n IS NOT NULL) m USING (component) LEFT JOIN (SELECT DISTINCT public_entity_id, canonical_name, sector, source_url, validated_on FROM catalogue) p "
    "ON p.public_entity_id = 'PUB-' || lpad(CAST(m.n AS VARCHAR), 6, '0')"
)
CTE["parts_p"] = (
    f"SELECT m.resolution_key, m.component, coalesce(public_entity_id, entity_id) AS entity_id, canonical_resolution_key, canonical_name, coalesce(public_sector, {sector_sql('canonical_name', 'sector')}) AS sector, "
    "component_key_count, component_source_row_count, rules AS decision_rules, public_entity_id, source_url AS public_source_url, validated_on AS public_validation_date "
    "FROM member_p m JOIN c2_p USING (component) LEFT JOIN comp_rules_p USING (component)"
)
CTE["z1_p"] = changed(
    CTE["z1"], ("p.decision_rules AS k_rules", "p.decision_rules AS k_rules, p.public_entity_id AS k_pub, p.public_source_url AS k_url, p.public_validation_date AS k_day, p.sector AS k_sector"),
    ("THEN CASE WHEN p.component_key_count", "THEN CASE WHEN p.public_entity_id IS NOT NULL THEN 4 WHEN p.component_key_count"), ("LEFT JOIN parts p", "LEFT JOIN parts_p p"),
)
CTE["z2_p"] = changed(CTE["z2"], ("c IN (5, 6)", "c IN (4, 5, 6)"), ("FROM z1", "FROM z1_p"))
CTE["final_p"] = changed(
    CTE["final"], ("c IN (1, 5, 6)", "c IN (1, 4, 5, 6)"), ("c IN (5, 6)", "c IN (4, 5, 6)"), ("c IN (1, 2, 5)", "c IN (1, 2, 4, 5)"),
    ("WHEN 5 THEN 'EMPRESA_CANONICALIZADA_AUTO'", "WHEN 4 THEN 'EMPRESA_VALIDADA_PUBLICAMENTE' WHEN 5 THEN 'EMPRESA_CANONICALIZADA_AUTO'"), ("WHEN 5 THEN 92", "WHEN 4 THEN 100 WHEN 5 THEN 92"),
    ("WHEN 5 THEN 'deterministic_auto_same_component'", "WHEN 4 THEN 'public_reference_and_deterministic_component' WHEN 5 THEN 'deterministic_auto_same_component'"),
    ("WHEN 5 THEN 'Equivalencia", "WHEN 4 THEN 'Identidad y sector validados en fuente pública; propagación limitada a claves aprobadas y equivalencias AUTO_SAME.' WHEN 5 THEN 'Equivalencia"),
    ("THEN 'NO_APLICA' WHEN s2", "THEN 'NO_APLICA' WHEN c = 4 THEN 'ALTA' WHEN s2"), ("THEN 'No aplica' ELSE s1", "THEN 'No aplica' WHEN c = 4 THEN k_sector ELSE s1"),
    ("THEN 'not_applicable' ELSE s2", "THEN 'not_applicable' WHEN c = 4 THEN 'public_source' ELSE s2"), ("CASE WHEN who IS NOT NULL THEN s3", "CASE WHEN c = 4 THEN k_url WHEN who IS NOT NULL THEN s3"),
    ("CAST(NULL AS VARCHAR) AS public_entity_id", "CASE WHEN c = 4 THEN k_pub END AS public_entity_id"), ("CAST(NULL AS VARCHAR) AS public_source_url", "CASE WHEN c = 4 THEN k_url END AS public_source_url"),
    ("CAST(NULL AS VARCHAR) AS public_validation_date", "CASE WHEN c = 4 THEN k_day END AS public_validation_date"), ("FROM z2", "FROM z2_p"),
)
CTE["master_p"] = changed(
    CTE["master"], ("CASE min(resultado_final) WHEN", "CASE min(resultado_final) WHEN 'EMPRESA_VALIDADA_PUBLICAMENTE' THEN 'PUBLIC_VALIDATED' WHEN"),
    ("'NOT_PUBLIC_VALIDATED' AS", "CASE WHEN min(public_entity_id) IS NULL THEN 'NOT_PUBLIC_VALIDATED' ELSE 'PUBLIC_VALIDATED' END AS"), ("FROM final", "FROM final_p"),
)
CTE["aliases_p"] = changed(CTE["aliases"], ("FROM final f JOIN master m", "FROM final_p f JOIN master_p m"))
CTE["q1_p"] = changed(CTE["q1"], ("FROM master", "FROM master_p"))
NAMED_P = (NAMED[0], ("resolution_status = 'PUBLIC_VALIDATED'", "PUBLIC_VALIDATED", "public_validated_name"), *NAMED[1:])


def quality_sql(named: str) -> str:
    """The quality gate over a subquery with the columns ``numbered`` and ``suffixed``."""
    status = cases([(c, text(q)) for c, q, _ in NAMED_P], text("ACCEPTABLE"))
    return (
        f"SELECT entity_id, canonical_name, resolution_status, confidence_score, {status} AS quality_status, {cases([(c, text(r)) for c, _, r in NAMED_P], text('auto_canonical_name_acceptable'))} AS quality_reason, "
        f"numbered AS has_trailing_numeric, suffixed AS legal_suffix_trailing_numeric, {NAMED[0][0]} AS has_invalid_character, {status} IN ('ACCEPTABLE', 'PUBLIC_VALIDATED') AS promotion_eligible FROM {named}"
    )


CTE["quality_p"] = quality_sql("q1_p")
CTE["refs_p"] = changed(CTE["refs2"], ("FROM quality", "FROM quality_p"))
CTE["alias_refs_p"] = changed(CTE["alias_refs2"], ("FROM aliases a JOIN quality q", "FROM aliases_p a JOIN quality_p q"))
CTE["idx_p"] = index_sql("refs_p", "alias_refs_p")
CTE["resolved_p"] = resolved_sql("idx_p")

# ---- names that are not ASCII ----------------------------------------------------------------------------------------
CTE["feed_u"] = strange_sql()
CHAIN = ("n1", "n2", "n3", "norm", "t1", "t2", "t3", "t4", "pre")
for _name, _source in zip(CHAIN, ("feed", *CHAIN), strict=False):
    CTE[f"{_name}_u"] = changed(CTE[_name], (f"FROM {_source}", f"FROM {_source}_u"))
# What compatibility composition makes of the characters that these names hold.
_bare = "regexp_replace(nombre_original, '^''', '')"
_composed = f"translate({_bare}, {text(WIDE + chr(0xA0) + chr(0x2003) + '①²')}, {text(PLAIN + '  12')})"
CTE["n1_u"] = changed(CTE["n1_u"], (f"translate({_bare}", f"translate(replace(replace({_composed}, 'ﬁ', 'fi'), '№', 'No')"))
CTE["marked"] = marked_sql().format(s="VARCHAR")
CTE["marked_q"] = changed(CTE["q1"], ("FROM master", "FROM marked"))

# ---- string ratios: the bit-parallel subsequence in 128-bit integers ---------------------------------------------------


def lcs_sql(a: str, b: str) -> str:
    full = f"((CAST(1 AS HUGEINT) << length({a})) - 1)"
    own = f"CASE WHEN substr({a}, i, 1) = substr({b}, j, 1) THEN CAST(1 AS HUGEINT) << (i - 1) ELSE CAST(0 AS HUGEINT) END"
    masks = f"list_transform(range(1, length({b}) + 1), lambda j: list_sum(list_transform(range(1, length({a}) + 1), lambda i: {own})))"
    walked = f"list_reduce(list_prepend({full}, {masks}), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full})"
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE length({a}) - bit_count({walked}) END"


CTE["w1"] = f"SELECT key_a, key_b, name_a, name_b, list_sort({tokens('name_a')}) AS ta, list_sort({tokens('name_b')}) AS tb FROM pairs"
CTE["w2"] = (
    "SELECT *, array_to_string(ta, ' ') AS sa, array_to_string(tb, ' ') AS sb, array_to_string(list_sort(list_distinct(list_filter(ta, lambda t: list_contains(tb, t)))), ' ') AS shared, "
    "array_to_string(list_sort(list_distinct(list_filter(ta, lambda t: NOT list_contains(tb, t)))), ' ') AS oa, array_to_string(list_sort(list_distinct(list_filter(tb, lambda t: NOT list_contains(ta, t)))), ' ') AS ob FROM w1"
)
CTE["w3"] = "SELECT *, CASE WHEN shared = '' THEN oa ELSE shared || ' ' || oa END AS ja, CASE WHEN shared = '' THEN ob ELSE shared || ' ' || ob END AS jb FROM w2"
CTE["w4"] = f"SELECT *, {lcs_sql('name_a', 'name_b')} AS lab, {lcs_sql('sa', 'sb')} AS lsab, {lcs_sql('ja', 'jb')} AS ljab FROM w3"
_set = "greatest(200.0 * ljab / (length(ja) + length(jb)), CASE WHEN shared <> '' THEN greatest(200.0 * length(shared) / (length(shared) + length(ja)), 200.0 * length(shared) / (length(shared) + length(jb))) ELSE 0.0 END)"
CTE["ratios"] = (
    f"SELECT key_a, key_b, {six('200.0 * lab / (length(name_a) + length(name_b))')} AS char_ratio, {six('200.0 * lsab / (length(sa) + length(sb))')} AS token_sort_ratio, "
    f"CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0 WHEN shared <> '' AND (oa = '' OR ob = '') THEN 100.0 ELSE {six(_set)} END AS token_set_ratio FROM w4"
)

ORDER = list(CTE)


def sql(select: str) -> str:
    """The chain up to what ``select`` needs, then ``select``."""
    import re

    need, todo = set(), [select]
    while todo:
        for word in set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", todo.pop())) & set(ORDER):
            if word not in need:
                need.add(word)
                todo.append(CTE[word])
    return "WITH RECURSIVE " + ", ".join(f"{n} AS {'' if n == 'reach' else 'MATERIALIZED '}({CTE[n]})" for n in ORDER if n in need) + " " + select


AUDIT = cases(
    [
        ("possible_truncation", "'possible_truncation'"), ("representative_route = 'ambiguous_review_candidate'", "'ambiguous_review'"), ("source_row_frequency >= 2", "'high_frequency'"),
        ("regexp_matches(representative_name, '[0-9]')", "'numeric_name'"), ("length(representative_name) <= 8 OR token_count <= 1", "'short_name'"),
        ("representative_route = 'employer_resolution_candidate'", "'ordinary_employer'"),
    ],
    "'other'",
)
STRATA = dict(
    zip(
        sampling.QUOTAS,
        (
            "is_blank", "is_numeric_only", "mixed_occupation_organization_signal", "mixed_address_organization_signal", "has_occupation_signal AND NOT has_organization_like_tokens",
            "route = 'address_candidate'", "possible_truncation", "has_trailing_numeric_token", "has_corporate_suffix", "NOT is_blank AND normalized_length <= 3",
            "route = 'ambiguous_review_candidate'", "route = 'employer_resolution_candidate' AND NOT has_address_signal AND NOT has_occupation_signal AND NOT possible_truncation",
        ),
        strict=True,
    )
)

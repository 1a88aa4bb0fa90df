"""Final resolution: components, sectors and business fields of every source row (A-6, A-7, Z-1 to Z-5, J-21, J-22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.config import Settings
from namewright.functions.text import squeezed, tokens
from namewright.functions.typing import words
from namewright.operators.graph import constrained_components, kept, legal_form
from namewright.operators.preprocess import checked

# What counts as explicitly missing information.
MISSING = ("SIN INFORMACION", "NO TIENE", "NO APLICA", "NOAPLICA", "NA", "N A", "NONE", "NINGUNO", "NINGUNA", "DESCONOCIDO")
FINAL = (
    "record_id", "source_row_number", "nombre_original", "nombre_normalizado", "resolution_key", "entity_id", "nombre_propuesto",
    "sector_propuesto", "metodo_sector", "sector_evidence", "resultado_final", "confianza_resolucion", "score_confianza_resolucion",
    "confianza_sector", "metodo_resolucion", "explicacion", "eligibility_status", "eligibility_rule", "eligibility_evidence",
    "canonical_resolution_key", "component_key_count", "component_source_row_count", "decision_rules", "public_entity_id",
    "public_source_url", "public_validation_date", "route", "route_reason",
)
# Outcomes, and the texts shown for them.
PUBLIC, AUTOMATIC, NORMALIZED = "EMPRESA_VALIDADA_PUBLICAMENTE", "EMPRESA_CANONICALIZADA_AUTO", "EMPRESA_NORMALIZADA_SIN_VALIDACION_PUBLICA"
NO_ADDRESS, NO_INFORMATION = "NO_IDENTIFICABLE_DIRECCION", "NO_IDENTIFICABLE_FALTA_INFORMACION"
ADDRESS_NAME, NO_NAME = "No identificable - Direcciones", "No identificable - Falta informacion"
NO_SECTOR, NOT_APPLICABLE = "No determinado", "No aplica"
METHODS = ("explicit_missing_information", "record_typing_address", "public_reference_and_deterministic_component", "deterministic_auto_same_component", "normalized_employer_key", "precision_first_abstention")
SECTOR_FOUND, SECTOR_NOT_FOUND = "Sector inferido por palabras clave exactas: ", "Sector no asignado sin evidencia suficiente."
REUSED_PUBLIC = "Identidad reutilizada por referencia exacta persistente y enriquecida con la fuente pública validada."
REUSED = "Identidad reutilizada por referencia exacta persistente. "
SAID_MISSING = "El valor normalizado corresponde explícitamente a ausencia de información y no se interpreta como empleador."
SAID_ADDRESS = "El registro contiene evidencia de dirección y no se atribuye a una empresa."
SAID_PUBLIC = "Identidad y sector validados en fuente pública; propagación limitada a claves aprobadas y equivalencias AUTO_SAME."
SAID_LINKED, SAID_ALONE = "Equivalencia textual determinista AUTO_SAME. ", "Se conserva la clave normalizada sin enlace determinista. "
SAID_NOTHING = "La evidencia no permite identificar una empresa con precisión suficiente; el proceso se abstiene."


def is_missing(name: Column) -> Column:
    return F.coalesce(squeezed(F.upper(name)).isin(*MISSING), F.lit(False))


def sector(name: Column, sectors: dict[str, tuple[str, ...]]) -> Column:
    """struct(sector, method, evidence) of the first sector with a keyword among the name's tokens."""
    toks = F.regexp_extract_all(F.upper(name), F.lit("([A-Z0-9]+)"))
    kind = "struct<sector:string,method:string,evidence:string>"
    out = F.struct(F.lit(NO_SECTOR).alias("sector"), F.lit("not_determined").alias("method"), F.lit(None).cast("string").alias("evidence")).cast(kind)
    for label, keywords in reversed(list(sectors.items())):
        hit = F.array_sort(F.array_intersect(toks, words(keywords)))
        made = F.struct(F.lit(label).alias("sector"), F.lit("keyword_taxonomy").alias("method"), F.array_join(hit, "|").alias("evidence")).cast(kind)
        out = F.when(F.size(hit) > 0, made).otherwise(out)
    return out


def canonical_rank(key: Column) -> Column:
    """Order in which keys of a component are preferred as its name."""
    return F.struct(
        (~F.col("possible_truncation")).cast("int"),
        F.col("source_row_frequency"),
        legal_form(key).isNotNull().cast("int"),
        -F.size(F.filter(tokens(key), lambda t: F.length(t) == 1)),
        F.col("token_count"),
        F.length("representative_name"),
        key,
    )


def checked_enrichment(catalogue: DataFrame) -> DataFrame:
    """The public catalogue with its rows validated: ids, urls, dates, unique keys, one definition for each id."""
    c = F.col
    wrong = (
        ~c("public_entity_id").rlike(r"^PUB-\d{6}\z") | ~c("source_url").rlike("^https?://[^/]+") | ~c("validated_on").rlike(r"^\d{4}-\d{2}-\d{2}\z")
        | F.expr("try_cast(validated_on AS date)").isNull() | (F.trim("resolution_key") == "") | (F.trim("canonical_name") == "") | (F.trim("sector") == "")
    )
    rows = checked(catalogue, wrong, F.concat(F.lit("invalid public row: "), F.coalesce("resolution_key", F.lit("null"))))
    keys = rows.groupBy("resolution_key").agg(F.count("*").alias("n"))
    ids = rows.groupBy("public_entity_id").agg(F.count_distinct("canonical_name", "sector", "source_url", "validated_on").alias("d"))
    rows = checked(rows.join(keys, "resolution_key"), c("n") > 1, F.concat(F.lit("repeated public key: "), "resolution_key")).drop("n")
    return checked(rows.join(ids, "public_entity_id"), c("d") > 1, F.concat(F.lit("public id with two definitions: "), "public_entity_id")).drop("d")


def employer_keys(keys: DataFrame, eligibility: DataFrame) -> DataFrame:
    ok = eligibility.where(F.col("eligibility_status") == "EMPLOYER_CANDIDATE").select("resolution_key")
    return keys.join(ok, "resolution_key", "left_semi").where(~is_missing(F.col("resolution_key")))


def usable_links(catalogue: DataFrame, keys: DataFrame, eligibility: DataFrame, exact_ids: DataFrame | None = None) -> DataFrame:
    """Rows of the public catalogue whose key is in discovery.  A key that is not is an error unless its public id was
    resolved exactly, and so is a key that is no employer candidate."""
    df = checked_enrichment(catalogue).join(keys.select("resolution_key", F.lit(True).alias("known")), "resolution_key", "left")
    df = df.join(eligibility.select("resolution_key", "eligibility_status"), "resolution_key", "left")
    if exact_ids is not None:
        df = df.join(exact_ids.select(F.col("entity_id").alias("public_entity_id"), F.lit(True).alias("exact")).distinct(), "public_entity_id", "left")
    else:
        df = df.withColumn("exact", F.lit(None).cast("boolean"))
    strange = F.col("known").isNull() & F.col("exact").isNull()
    other = F.col("known").isNotNull() & ~F.col("eligibility_status").eqNullSafe(F.lit("EMPLOYER_CANDIDATE"))
    df = checked(df, strange | other, F.concat(F.lit("public key unknown or no employer: "), "resolution_key"))
    return df.where("known").select(*catalogue.columns)


def components(keys: DataFrame, eligibility: DataFrame, decisions: DataFrame, settings: Settings, catalogue: DataFrame | None = None) -> DataFrame:
    """One row per employer key with the summary of its component."""
    employers = employer_keys(keys, eligibility)
    accepted = decisions.where("decision_status = 'AUTO_SAME'").select("key_a", "key_b", "decision_rule")
    links = None
    if catalogue is not None:
        public = checked_enrichment(catalogue).join(employers.select("resolution_key"), "resolution_key", "left_semi")
        anchor = public.groupBy("public_entity_id").agg(F.min("resolution_key").alias("key_a"))
        links = public.join(anchor, "public_entity_id").where("resolution_key <> key_a").select("key_a", F.col("resolution_key").alias("key_b"))
    member = kept(constrained_components(employers, accepted, links))
    full = member.join(employers, "resolution_key")
    if catalogue is not None:
        full = full.join(public.select("resolution_key", "public_entity_id", F.struct("canonical_name", "sector", "source_url", "validated_on").alias("p")), "resolution_key", "left")
    else:
        kind = "struct<canonical_name:string,sector:string,source_url:string,validated_on:string>"
        full = full.withColumns({"public_entity_id": F.lit(None).cast("string"), "p": F.lit(None).cast(kind)})
    summary = full.groupBy("component").agg(
        F.max_by("resolution_key", canonical_rank(F.col("resolution_key"))).alias("canonical_resolution_key"),
        F.count("*").cast("int").alias("component_key_count"),
        F.sum("source_row_frequency").alias("component_source_row_count"),
        F.max("rules").alias("rules"),
        F.count_distinct("public_entity_id").alias("ids"),
        F.max("public_entity_id").alias("public_entity_id"),
        F.max_by("p", "public_entity_id").alias("p"),
        F.array_join(F.array_sort(F.collect_list("resolution_key")), "\0").alias("all_keys"),
    )
    summary = checked(summary, F.col("ids") > 1, F.concat(F.lit("component with several public ids: "), "component"))
    made = F.concat(F.lit("ENT-"), F.upper(F.substring(F.sha2("all_keys", 256), 1, 16)))
    public = F.col("public_entity_id").isNotNull()
    name = F.coalesce("p.canonical_name", "canonical_resolution_key")
    summary = summary.withColumns({"canonical_name": name, "s": sector(name, settings.sectors)})
    summary = summary.select(
        "component", F.coalesce("public_entity_id", made).alias("entity_id"), "canonical_resolution_key", "canonical_name",
        F.coalesce("p.sector", "s.sector").alias("sector"),
        F.when(public, "public_source").otherwise(F.col("s.method")).alias("sector_method"),
        F.when(public, F.col("p.source_url")).otherwise(F.col("s.evidence")).alias("sector_evidence"),
        F.when(public, "ALTA").when(F.col("s.method") == "keyword_taxonomy", "MEDIA").otherwise("NO_DETERMINADA").alias("sector_confidence"),
        "component_key_count", "component_source_row_count", F.when(F.col("rules") != "", F.col("rules")).alias("decision_rules"),
        "public_entity_id", F.col("p.source_url").alias("public_source_url"), F.col("p.validated_on").alias("public_validation_date"),
    )
    return member.select("resolution_key", "component", "blocked").join(summary, "component")


def exact_reuse(resolved: DataFrame, settings: Settings, catalogue: DataFrame | None = None) -> DataFrame:
    """Summary of each entity that exact references resolved (entity_id, and a component's columns)."""
    hit = resolved.where("resolution_status = 'resolved'")
    one = hit.groupBy("entity_id").agg(
        F.min("canonical_name").alias("canonical_name"), F.max("canonical_name").alias("other"),
        F.count_distinct("nombre_normalizado").cast("int").alias("component_key_count"), F.count("*").alias("component_source_row_count"),
        F.array_join(F.array_sort(F.collect_set("resolution_reason")), "|").alias("decision_rules"),
    )
    one = checked(one, F.col("other") != F.col("canonical_name"), F.concat(F.lit("entity with two names: "), "entity_id"))
    if catalogue is not None:
        public = checked_enrichment(catalogue).select(
            F.col("public_entity_id").alias("entity_id"), F.struct("canonical_name", "sector", "source_url", "validated_on").alias("p")
        ).distinct()
        one = one.join(public, "entity_id", "left")
        one = checked(one, F.col("p.canonical_name") != F.col("canonical_name"), F.concat(F.lit("reference differs from public name: "), "entity_id"))
    else:
        one = one.withColumn("p", F.lit(None).cast("struct<canonical_name:string,sector:string,source_url:string,validated_on:string>"))
    public = F.col("p").isNotNull()
    one = one.withColumn("s", sector(F.col("canonical_name"), settings.sectors))
    return one.select(
        "entity_id", F.col("canonical_name").alias("canonical_resolution_key"), "canonical_name", F.coalesce("p.sector", "s.sector").alias("sector"),
        F.when(public, "public_source").otherwise(F.col("s.method")).alias("sector_method"),
        F.when(public, F.col("p.source_url")).otherwise(F.col("s.evidence")).alias("sector_evidence"),
        F.when(public, "ALTA").when(F.col("s.method") == "keyword_taxonomy", "MEDIA").otherwise("NO_DETERMINADA").alias("sector_confidence"),
        "component_key_count", "component_source_row_count", "decision_rules", F.when(public, F.col("entity_id")).alias("public_entity_id"),
        F.col("p.source_url").alias("public_source_url"), F.col("p.validated_on").alias("public_validation_date"),
    )


def finalize(resolved: DataFrame, eligibility: DataFrame, parts: DataFrame, reuse: DataFrame) -> DataFrame:
    """The 28 final columns of every source row: exact reuse first, then the ordered business rules."""
    c, lit = F.col, F.lit
    chosen = parts.select(c("resolution_key").alias("__name"), F.struct(*(x for x in parts.columns if x not in ("resolution_key", "component", "blocked"))).alias("k"))
    exact = reuse.select(c("entity_id").alias("__exact"), F.struct(*reuse.columns).alias("e"))
    # Rows without a name or an exact id get join keys of their own: a common null key would be one task, and one file of the table.
    alone = F.concat(lit("\x1f"), "record_id")
    df = resolved.withColumns({"name": c("nombre_normalizado"), "__name": F.coalesce("nombre_normalizado", alone), "__exact": F.coalesce("entity_id", alone)}).drop("entity_id")
    df = df.join(eligibility.select(c("resolution_key").alias("__name"), "eligibility_status", "eligibility_rule", "eligibility_evidence"), "__name", "left")
    df = df.join(chosen, "__name", "left").join(exact, "__exact", "left")
    missing = is_missing(c("name"))
    address = F.coalesce((c("route") == "address_candidate") | (c("eligibility_status") == "ADDRESS"), lit(False))
    employer = F.coalesce((c("eligibility_status") == "EMPLOYER_CANDIDATE") & c("k").isNotNull(), lit(False))
    public = c("k.public_entity_id").isNotNull()
    linked = (c("k.component_key_count") > 1) & c("k.decision_rules").isNotNull()
    case = F.lit(6)
    for i, condition in reversed(list(enumerate((c("resolution_status") == "resolved", missing, address, employer & public, employer & linked, employer)))):
        case = F.when(condition, i).otherwise(case)
    # The case of a row is found once; every column asks for its number.
    df = df.withColumn("__case", case)
    cases = [c("__case") == i for i in range(6)]
    x = {n: F.when(cases[0], c(f"e.{n}")).when(c("__case").between(3, 5), c(f"k.{n}")) for n in reuse.columns}

    def by_case(*values) -> Column:
        out = values[-1] if isinstance(values[-1], Column) else lit(values[-1])
        for condition, value in reversed(list(zip(cases, values[:-1], strict=True))):
            out = F.when(condition, value).otherwise(out)
        return out

    found = F.when(x["sector_method"] == "keyword_taxonomy", F.concat(lit(SECTOR_FOUND), x["sector_evidence"], lit("."))).otherwise(
        SECTOR_NOT_FOUND
    )
    e_public = c("e.public_entity_id").isNotNull()
    known = F.when(c("eligibility_status").isNotNull(), c("name"))
    result = {
        "resolution_key": by_case(c("name"), known, known, c("name"), c("name"), c("name"), known),
        "entity_id": x["entity_id"],
        "nombre_propuesto": by_case(c("e.canonical_name"), NO_NAME, ADDRESS_NAME, *[c("k.canonical_name")] * 3, NO_NAME),
        "sector_propuesto": F.coalesce(x["sector"], lit(NOT_APPLICABLE)),
        "metodo_sector": F.coalesce(x["sector_method"], lit("not_applicable")),
        "sector_evidence": x["sector_evidence"],
        "resultado_final": by_case(
            F.when(e_public, PUBLIC).otherwise(AUTOMATIC), NO_INFORMATION, NO_ADDRESS, PUBLIC, AUTOMATIC, NORMALIZED, NO_INFORMATION,
        ),
        "confianza_resolucion": by_case("ALTA", "ALTA", F.when(c("eligibility_status") == "ADDRESS", "ALTA").otherwise("MEDIA"), "ALTA", "ALTA", "MEDIA", "BAJA"),
        "score_confianza_resolucion": by_case(F.when(e_public, 100).otherwise(92), 100, 100, 100, 92, 60, 40).cast("int"),
        "confianza_sector": F.coalesce(x["sector_confidence"], lit("NO_APLICA")),
        "metodo_resolucion": by_case(
            F.concat(lit("exact_reference_"), F.replace("resolution_method", lit("exact_"), lit(""))), *METHODS,
        ),
        "explicacion": by_case(
            F.when(e_public, REUSED_PUBLIC).otherwise(F.concat(lit(REUSED), found)), SAID_MISSING, SAID_ADDRESS, SAID_PUBLIC,
            F.concat(lit(SAID_LINKED), found), F.concat(lit(SAID_ALONE), found), SAID_NOTHING,
        ),
        "canonical_resolution_key": x["canonical_resolution_key"],
        "component_key_count": F.coalesce(x["component_key_count"], lit(0)),
        "component_source_row_count": F.coalesce(x["component_source_row_count"], lit(0)).cast("long"),
        "decision_rules": x["decision_rules"],
        "public_entity_id": x["public_entity_id"],
        "public_source_url": x["public_source_url"],
        "public_validation_date": x["public_validation_date"],
    }
    return df.select(*(result[n].alias(n) if n in result else c(n) for n in FINAL))


def top_keys(final: DataFrame, keys: DataFrame, limit: int) -> DataFrame:
    """The most frequent keys, by frequency and then key."""
    return keys.select("resolution_key", "source_row_frequency").orderBy(F.desc("source_row_frequency"), "resolution_key").limit(limit)

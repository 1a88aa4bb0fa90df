"""Settings: frozen, strict dataclasses with the production values as defaults."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from dataclasses import dataclass, field
from typing import Any

# Generic name tokens, suffix variants, word lists and taxonomy of the production configuration.
GENERIC_TOKENS = (
    "SA", "SAS", "INC", "CORP", "LLC", "LTDA", "CIA", "CO", "COMPANY", "GRUPO", "EMPRESA", "EMPRESAS", "SERVICIO",
    "SERVICIOS", "PANAMA", "DE", "DEL", "LA", "EL", "LOS", "LAS", "Y", "EN", "PARA", "THE", "OF", "AND",
)
SUFFIXES = {
    "SA": ("S A", "SA"),
    "SAS": ("S A S", "SAS"),
    "INC": ("INC",),
    "CORP": ("CORP",),
    "LLC": ("L L C", "LLC"),
    "LTDA": ("LTDA",),
    "CIA": ("CIA",),
}
SECTORS = {
    "Administración pública": ("MINISTERIO", "MUNICIPIO", "ALCALDIA", "AUTORIDAD", "GOBIERNO", "CONTRALORIA", "POLICIA", "EMBAJADA"),
    "Educación": ("UNIVERSIDAD", "UNIVERSITY", "COLEGIO", "SCHOOL", "ESCUELA", "ACADEMIA", "EDUCACION", "EDUCATION"),
    "Salud": ("HOSPITAL", "CLINICA", "SALUD", "MEDICA", "MEDICAL", "MEDICO", "FARMACIA", "PHARMACY"),
    "Servicios financieros y seguros": ("BANCO", "BANK", "FINANCIERA", "FINANCIAL", "INSURANCE", "SEGUROS", "CREDIT", "CREDITO"),
    "Construcción e ingeniería": (
        "CONSTRUCTORA", "CONSTRUCTION", "CONSTRUCCION", "ENGINEERING", "INGENIERIA", "CONTRACTORS", "INFRAESTRUCTURA",
    ),
    "Logística y transporte": ("LOGISTICS", "LOGISTICA", "TRANSPORTE", "TRANSPORT", "CARGO", "SHIPPING", "FREIGHT"),
    "Tecnología y telecomunicaciones": (
        "SOFTWARE", "TECHNOLOGY", "TECHNOLOGIES", "TECNOLOGIA", "TELECOM", "TELECOMMUNICATIONS",
    ),
    "Energía y servicios públicos": (
        "ENERGY", "ENERGIA", "ELECTRIC", "ELECTRICA", "ELECTRICIDAD", "SOLAR", "PETROLEUM", "PETROLEO",
    ),
    "Manufactura e industria": ("INDUSTRIAS", "INDUSTRIAL", "MANUFACTURING", "FACTORY", "FABRICA"),
    "Medios y publicidad": ("MEDIA", "COMMUNICATIONS", "COMUNICACIONES", "PUBLICIDAD", "ADVERTISING"),
    "Automotriz": ("AUTOMOTRIZ", "AUTOMOTIVE", "MOTORS", "VEHICULOS"),
    "Marítimo y portuario": ("MARITIME", "MARITIMA", "PORT", "PORTUARIA"),
    "Minería": ("MINING", "MINERA", "MINERIA"),
    "Seguridad privada": ("SEGURIDAD", "SECURITY", "VIGILANCIA"),
    "Agricultura y agroindustria": ("AGRICOLA", "AGRICULTURA", "AGRO", "CULTIVOS", "GANADERIA"),
    "Alimentos y bebidas": ("ALIMENTOS", "FOOD", "RESTAURANT", "RESTAURANTE", "CAFE", "PANADERIA", "BEBIDAS"),
    "Hotelería y turismo": ("HOTEL", "HOTELES", "RESORT", "TOURISM", "TURISMO", "TRAVEL"),
    "Comercio y distribución": ("SUPERMERCADO", "SUPERMERCADOS", "STORE", "TIENDA", "DISTRIBUIDORA", "DISTRIBUTOR"),
    "Servicios profesionales": ("ABOGADOS", "LAW", "LEGAL", "AUDITORES", "CONSULTING", "CONSULTORES", "CONSULTORIA"),
    "Bienes raíces": ("INMOBILIARIA", "PROPERTIES", "PROPERTY"),
}


@dataclass(frozen=True)
class Source:
    workbook: str = "data/source.xlsx"
    sheet_name: str = "Sheet1"
    column: str = "nombre_original"
    expected_sha256: str | None = None
    expected_sheet_names: tuple[str, ...] = ("Sheet1",)


@dataclass(frozen=True)
class Normalization:
    ruleset_version: str = "1.0.0"
    possible_truncation_content_lengths: tuple[int, ...] = (30,)
    trailing_numeric_candidate_max_digits: int = 1
    corporate_suffix_aliases: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(SUFFIXES))


@dataclass(frozen=True)
class Typing:
    explicit_tokens: tuple[str, ...] = (
        "CALLE", "AVENIDA", "AVE", "AV", "EDIFICIO", "EDIF", "PH", "URBANIZACION", "APARTAMENTO", "BARRIADA", "CORREGIMIENTO",
    )
    contextual_tokens: tuple[str, ...] = ("VIA", "TORRE", "RESIDENCIAL", "PLAZA")
    intersection_markers: tuple[str, ...] = ("ESQUINA", "INTERSECCION", "CON CALLE", "Y CALLE")
    moderate_score: int = 2
    strong_score: int = 4
    status_phrases: tuple[str, ...] = (
        "DEPENDIENTE ECONOMICO", "AMA DE CASA", "NO LABORA", "INDEPENDIENTE", "DESEMPLEADO", "DESEMPLEADA", "PENSIONADO",
        "PENSIONADA", "ESTUDIANTE", "JUBILADO", "JUBILADA",
    )
    corporate_suffix_tokens: tuple[str, ...] = ("SA", "SAS", "INC", "CORP", "LLC", "LTDA", "CIA")
    organization_tokens: tuple[str, ...] = (
        "ASOCIACION", "AUTORIDAD", "BANCO", "CAJA", "CLINICA", "CONSTRUCTORA", "COOPERATIVA", "CORPORACION", "EMPRESA",
        "EMPRESAS", "FUNDACION", "GRUPO", "HOSPITAL", "INDUSTRIAS", "INSTITUTO", "MEDICA", "MEDICO", "MINISTERIO", "MUNICIPIO",
        "SEGURO", "SERVICIOS", "UNIVERSIDAD",
    )

    def __post_init__(self) -> None:
        if self.strong_score <= self.moderate_score:
            raise ValueError("the strong address score must be above the moderate one")


@dataclass(frozen=True)
class Candidates:
    maximum_block_size: int = 50
    minimum_truncation_prefix_length: int = 20
    minimum_informative_token_length: int = 5
    maximum_token_frequency: int = 50
    prefix_signature_length: int = 8
    minimum_typo_token_length: int = 6
    maximum_typo_signature_frequency: int = 25
    maximum_typo_context_frequency: int = 1000


@dataclass(frozen=True)
class Settings:
    source: Source = Source()
    normalization: Normalization = Normalization()
    typing: Typing = Typing()
    candidates: Candidates = Candidates()
    minimum_whitespace_compact_length: int = 5
    road_type_tokens: tuple[str, ...] = (
        "ST", "STREET", "RD", "ROAD", "AVE", "AVENUE", "BLVD", "BOULEVARD", "DR", "DRIVE", "LN", "LANE", "HWY", "HIGHWAY",
    )
    sectors: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(SECTORS))
    top_key_limit: int = 40
    pair_sample_size: int = 600
    blocking_miss_sample_size: int = 150
    random_seed: int = 20260813

    def fingerprint(self) -> str:
        """SHA-256 of the effective settings, in key order."""
        return hashlib.sha256(json.dumps(dataclasses.asdict(self), sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def _built(kind: type, values: dict[str, Any]) -> Any:
    names = {f.name: f for f in dataclasses.fields(kind)}
    if unknown := sorted(set(values) - set(names)):
        raise ValueError(f"unknown settings for {kind.__name__}: {', '.join(unknown)}")
    made = {}
    for name, value in values.items():
        default = names[name].default if names[name].default is not dataclasses.MISSING else names[name].default_factory()
        if dataclasses.is_dataclass(default):
            value = _built(type(default), value)
        elif isinstance(default, tuple):
            value = tuple(value)
        elif isinstance(default, dict):
            value = {k: tuple(v) for k, v in value.items()}
        elif default is not None and (not isinstance(value, type(default)) or isinstance(value, bool) is not isinstance(default, bool)):
            raise ValueError(f"{kind.__name__}.{name} must be {type(default).__name__}")
        made[name] = value
    return kind(**made)


def load_settings(path: str) -> Settings:
    """Settings from a JSON or YAML file of overrides; unknown keys and wrong types are errors."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return _built(Settings, json.load(f))
        import yaml

        return _built(Settings, yaml.safe_load(f) or {})

"""Data model: table schemas, closed value domains, per-vertical metadata fields."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S, B, I, L, D, TS = (
    T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType(),
)

# --- fixed values: the 15 verticals, their display names and listing sources ---
VERTICAL_TABLE = [
    # value, display name, source
    ("barrios_privados", "Barrios Privados", "Zonaprop + Argenprop"),
    ("hoteles", "Hoteles", "Google Places API"),
    ("universidades", "Universidades", "Google Dorks"),
    ("entes_estatales", "Entes Estatales", "Google Dorks"),
    ("consulados", "Consulados", "Google Dorks"),
    ("embajadas", "Embajadas", "Google Dorks"),
    ("droguerias", "Droguerías", "ANMAT (registro oficial)"),
    ("clinicas", "Clínicas Privadas", "SSSALUD (buscador prestadores)"),
    ("depositos_fiscales", "Depósitos Fiscales", "Google Dorks"),
    ("parques_industriales", "Parques Industriales", "CAIP (caip.org.ar)"),
    ("logisticas", "Logísticas", "ARLOG + Google Dorks"),
    ("empresas", "Empresas", "Google Dorks"),
    ("plantas_industriales", "Plantas Industriales", "Google Dorks"),
    ("terminales_portuarias", "Terminales Portuarias", "Google Dorks"),
    ("aeronauticas", "Empresas Aeronáuticas", "Google Dorks"),
]
BASE_VERTICAL = "barrios_privados"
DEFAULT_COUNTRY = "Argentina"
# --- fixed values: life cycles ---
COMMERCIAL_STATES = ["SIN_CONTACTAR", "CONTACTADO", "EN_NEGOCIACION", "CLIENTE", "DESCARTADO"]
LOT_STATES = ["pendiente", "consolidado", "subido", "descartado"]

VERTICALS = [value for value, _, _ in VERTICAL_TABLE]
DISPLAY_NAMES = {value: name for value, name, _ in VERTICAL_TABLE}
DISCOVERY_SOURCES = {value: source for value, _, source in VERTICAL_TABLE}


@dataclass(frozen=True)
class Field:
    """One metadata field: ``kind`` is str, int, float, bool, list or enum."""

    name: str
    kind: str
    options: tuple[str, ...] = ()
    low: int | None = None
    high: int | None = None
    default: object = None


def _enum(name: str, *options: str) -> Field:
    return Field(name, "enum", options)


# --- fixed values: metadata fields of each vertical, in their order ---
METADATA_FIELDS: dict[str, list[Field]] = {
    "barrios_privados": [
        Field("zona", "str"), Field("distancia_km_bsas", "float"),
        Field("en_base_actual", "bool", default=False), Field("cantidad_lotes", "int"),
        Field("superficie_has", "float"),
        _enum("tipo", "country", "barrio_cerrado", "chacra", "pueblo_privado"),
        Field("administradora", "str"),
    ],
    "hoteles": [
        Field("categoria_estrellas", "int", low=1, high=5), Field("cantidad_habitaciones", "int"),
        _enum("tipo", "ciudad", "resort", "boutique", "apart", "hostel"),
        Field("cadena", "str"), Field("tiene_estacionamiento", "bool"), Field("area_eventos", "bool"),
    ],
    "universidades": [
        _enum("tipo", "publica", "privada", "terciario"),
        Field("cantidad_alumnos", "int"), Field("cantidad_sedes", "int"), Field("carreras", "list"),
        Field("es_sede_principal", "bool"), Field("rector_decano", "str"),
    ],
    "entes_estatales": [
        _enum("jurisdiccion", "nacional", "provincial", "municipal"),
        _enum("tipo_organismo", "ministerio", "secretaria", "ente", "agencia", "municipio"),
        Field("provincia_jurisdiccion", "str"), Field("responsable_nombre", "str"),
        Field("responsable_cargo", "str"),
    ],
    "consulados": [
        Field("pais_representado", "str"),
        _enum("tipo", "embajada", "consulado_general", "consulado_honorario", "representacion"),
        Field("horario_atencion", "str"), Field("zona_ciudad", "str"),
    ],
    "embajadas": [
        Field("pais_representado", "str"), Field("barrio_caba", "str"),
        _enum("nivel_seguridad", "alto", "medio", "estandar"),
        Field("tiene_residencia_embajador", "bool"),
    ],
    "droguerias": [
        _enum("tipo", "cadena", "independiente"),
        Field("cantidad_sucursales", "int"), Field("distribucion_mayorista", "bool"),
        Field("superficie_deposito_m2", "float"), Field("temperatura_controlada", "bool"),
        Field("habilitacion_anmat", "bool"),
    ],
    "clinicas": [
        _enum("tipo", "policlinico", "especialidad", "sanatorio", "maternidad"),
        Field("cantidad_camas", "int"), Field("guardia_24hs", "bool"), Field("especialidades", "list"),
        Field("obras_sociales_principales", "list"), Field("habilitacion_ministerio", "bool"),
    ],
    "depositos_fiscales": [
        Field("superficie_m2", "float"), Field("altura_libre_m", "float"),
        _enum("tipo_habilitacion", "aduana", "zona_franca", "deposito_fiscal_general"),
        Field("acceso_camiones", "bool"), Field("conexion_ferroviaria", "bool"),
        Field("numero_habilitacion_aduana", "str"),
    ],
    "parques_industriales": [
        _enum("tipo", "publico", "privado", "mixto"),
        Field("superficie_total_has", "float"), Field("cantidad_empresas_radicadas", "int"),
        Field("servicios_disponibles", "list"), Field("tiene_acceso_ferroviario", "bool"),
        Field("provincia", "str"),
    ],
    "logisticas": [
        Field("superficie_galpon_m2", "float"), Field("altura_libre_m", "float"),
        Field("temperatura_controlada", "bool"), Field("acceso_ferroviario", "bool"),
        Field("flota_propia", "bool"), Field("cantidad_vehiculos", "int"),
        _enum("tipo_carga", "general", "refrigerada", "peligrosa", "e-commerce"),
        Field("certificacion_iso", "bool"),
    ],
    "empresas": [
        Field("rubro", "str"), Field("cuit", "str"),
        _enum("tipo_sociedad", "SA", "SRL", "SAS", "sucursal_extranjera"),
        Field("cantidad_empleados", "int"), Field("cantidad_sucursales", "int"),
        _enum("facturacion_anual_categoria", "PyME", "Mediana", "Grande", "Multinacional"),
    ],
    "plantas_industriales": [
        Field("rubro", "str"), Field("superficie_m2", "float"), Field("turnos_trabajo", "int"),
        Field("cantidad_empleados_planta", "int"), Field("certificaciones", "list"),
        Field("capacidad_instalada", "str"), _enum("tipo_proceso", "continuo", "por_lotes"),
    ],
    "terminales_portuarias": [
        _enum("tipo_carga", "contenedores", "graneles_solidos", "graneles_liquidos", "carga_general", "ro-ro"),
        Field("calado_maximo_pies", "float"), Field("gruas_propias", "bool"),
        Field("conexion_ferroviaria", "bool"), Field("capacidad_anual_teu", "int"),
        Field("certificacion_isps", "bool"), Field("operador", "str"),
    ],
    "aeronauticas": [
        _enum("tipo", "aerolinea", "mro", "handling", "catering", "cargo_aereo", "aeropuerto_privado", "fbo"),
        Field("anac_habilitado", "bool"), Field("hangar_propio", "bool"), Field("flota_aeronaves", "int"),
        _enum("aeropuerto_base", "Ezeiza", "Aeroparque", "El Palomar", "Córdoba", "Otro"),
        Field("certificacion_iata", "bool"),
    ],
}

_SPARK_KIND = {
    "str": S, "enum": S, "int": L, "float": D, "bool": B, "list": T.ArrayType(S),
}


def metadata_schema(vertical: str) -> T.StructType:
    """Typed view of one vertical's metadata; an unknown vertical is an error."""
    if vertical not in METADATA_FIELDS:
        raise KeyError(f"no metadata schema for vertical {vertical!r}")
    return T.StructType([T.StructField(f.name, _SPARK_KIND[f.kind]) for f in METADATA_FIELDS[vertical]])


# --- fixed values: lead columns; the export has all of them but ``notas`` ---
LEAD_SCHEMA = T.StructType([
    T.StructField("nombre", S, False),
    T.StructField("vertical", S, False),
    T.StructField("estado_comercial", S, False),
    T.StructField("email", S), T.StructField("email_2", S), T.StructField("email_3", S),
    T.StructField("email_validado", B, False), T.StructField("email_score", I),
    T.StructField("telefono", S), T.StructField("sitio_web", S), T.StructField("fuente_contacto", S),
    T.StructField("fecha_enriquecimiento", TS, False), T.StructField("notas", S),
    T.StructField("direccion", S), T.StructField("localidad", S), T.StructField("partido", S),
    T.StructField("provincia", S), T.StructField("pais", S, False), T.StructField("cp", S),
    T.StructField("latitud", D), T.StructField("longitud", D),
    T.StructField("metadata", S),  # JSON text; typed views through metadata_schema()
])
CSV_COLUMNS = [f.name for f in LEAD_SCHEMA if f.name != "notas"]
CSV_SCHEMA = T.StructType([T.StructField(name, S) for name in CSV_COLUMNS])

DISCOVERED_SCHEMA = T.StructType([
    T.StructField("nombre", S, False), T.StructField("sitio_web", S), T.StructField("partido", S),
    T.StructField("provincia", S), T.StructField("localidad", S), T.StructField("fuente", S),
    T.StructField("raw_data", T.MapType(S, S)),
])
PAGE_SCHEMA = T.StructType([
    T.StructField("page_id", L), T.StructField("url", S), T.StructField("html", S), T.StructField("status_code", I),
])
PAGE_TEXT_SCHEMA = T.StructType([
    T.StructField("url", S), T.StructField("text", S), T.StructField("status_code", I),
    T.StructField("used_playwright", B), T.StructField("subpage_used", S), T.StructField("error", S),
])
CONTACT_SCHEMA = T.StructType([
    T.StructField("nombre_completo", S), T.StructField("cargo", S),
    T.StructField("email", S), T.StructField("telefono", S),
])
EXTRACTION_SCHEMA = T.StructType([
    T.StructField("barrio_id", S), T.StructField("barrio_nombre", S), T.StructField("url_usada", S),
    T.StructField("contactos_llm", T.ArrayType(CONTACT_SCHEMA)),
    T.StructField("emails_generales_llm", T.ArrayType(S)), T.StructField("telefono_general_llm", S),
    T.StructField("emails_regex", T.ArrayType(S)), T.StructField("phones_regex", T.ArrayType(S)),
    T.StructField("modelo_usado", S), T.StructField("error", S), T.StructField("timestamp", S),
    T.StructField("tiene_datos_contacto_llm", B),
    T.StructField("todos_los_emails_unificados", T.ArrayType(S)),
])
PLACES_SCHEMA = T.StructType([
    T.StructField("status", S),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("name", S), T.StructField("formatted_address", S), T.StructField("website", S),
        T.StructField("place_id", S), T.StructField("rating", D),
    ]))),
])
VERIFICATION_SCHEMA = T.StructType([
    T.StructField("email", S), T.StructField("status", S), T.StructField("score", I), T.StructField("error", S),
])
GAZETTEER_SCHEMA = T.StructType([
    T.StructField("query", S), T.StructField("lat", D), T.StructField("lon", D), T.StructField("provider", S),
])
VERTICAL_EVENT_SCHEMA = T.StructType([
    T.StructField("vertical", S), T.StructField("accion", S), T.StructField("ts", TS),
    T.StructField("prompt_path", S), T.StructField("schema_path", S),
])
LOT_EVENT_SCHEMA = T.StructType([
    T.StructField("lote_id", S), T.StructField("vertical", S), T.StructField("ts", TS),
    T.StructField("estado", S), T.StructField("leads_count", L), T.StructField("subido_en", TS),
])
RUN_EVENT_SCHEMA = T.StructType([
    T.StructField("run_id", S), T.StructField("vertical", S), T.StructField("tipo", S), T.StructField("ts", TS),
    T.StructField("discovered", L), T.StructField("scraped", L), T.StructField("enriched", L),
    T.StructField("validated", L), T.StructField("errors", L),
])


def vertical_dimension(spark):
    """15 rows: value, display name, listing source, metadata field names."""
    rows = [
        (value, name, source, [f.name for f in METADATA_FIELDS[value]])
        for value, name, source in VERTICAL_TABLE
    ]
    return spark.createDataFrame(
        rows, "vertical string, display_name string, source string, metadata_fields array<string>"
    )


def field_dimension(spark):
    """One row per metadata field (about 90): the registry as a table."""
    rows = [
        (v, pos, f.name, f.kind, list(f.options), f.low, f.high, f.default)
        for v in VERTICALS
        for pos, f in enumerate(METADATA_FIELDS[v])
    ]
    return spark.createDataFrame(
        rows,
        "vertical string, pos int, name string, kind string, options array<string>, low int, high int, def boolean",
    ).withColumnRenamed("def", "default_value")

"""Prompt texts per vertical and batch request rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.extract import EXTRACTION_BUDGET, REQUEST_BUDGET, cut_text
from ..schemas import field_dimension, vertical_dimension

# --- fixed values: prompt texts ---
PROMPT_HEAD = """# Prompt de extracción — {display_name}

Sos un extractor de datos B2B para seguridad electrónica corporativa.

## Tu tarea
Del contenido HTML que te paso, extraé información de contacto de **{display_name}**
en Argentina.

## Cargos objetivo
Priorizá encontrar datos de estos cargos (en orden de prioridad):
1. Gerente de Seguridad / Director de Seguridad
2. Responsable de Facilities / Infraestructura
3. Gerente General / Director Ejecutivo
4. Responsable de Compras

## Datos comunes a extraer
- nombre: nombre del establecimiento (obligatorio)
- email: email principal de contacto
- email_2: email secundario (si hay)
- email_3: email terciario (si hay)
- telefono: teléfono principal con código de área
- sitio_web: URL del sitio oficial
- direccion: calle y número
- localidad: ciudad o localidad
- partido: partido o municipio (para Buenos Aires)
- provincia: provincia argentina
- nombre_responsable: nombre del contacto clave (si aparece)
- cargo_responsable: cargo del contacto (si aparece)

## Datos específicos de {display_name} (metadata)
"""
PROMPT_FORMAT = """

## Formato de respuesta
Respondé SOLO con un JSON válido con exactamente estas claves (null si no encontrás el dato):
```json
{
  "nombre": "...",
  "email": "...",
  "email_2": null,
  "email_3": null,
  "telefono": "...",
  "sitio_web": "...",
  "direccion": "...",
  "localidad": "...",
  "partido": "...",
  "provincia": "...",
  "nombre_responsable": null,
  "cargo_responsable": null,
  "metadata": {
"""
PROMPT_TAIL = """
  }
}
```

## Reglas
- Solo datos que aparezcan explícitamente en el HTML. NO inventes información.
- Emails: formato estándar usuario@dominio.com
- Teléfonos: incluir código de área (ej: 011-4567-8901 o +54 11 4567-8901)
- Si el HTML no contiene suficiente información, retorná null en los campos faltantes.
- metadata debe contener solo los campos definidos arriba (null si no encontrás el dato).
"""
COMMON_FIELDS = """- nombre: nombre oficial de la organización (obligatorio)
- email: email principal de contacto
- email_2: segundo email si hay
- email_3: tercer email si hay
- telefono: teléfono principal (formato +54 11 XXXX-XXXX cuando sea posible)
- sitio_web: URL del sitio oficial
- direccion: dirección postal
- localidad: localidad/ciudad
- partido: partido/municipio (para Buenos Aires)
- provincia: provincia
- cp: código postal
- fuente_contacto: origen del dato (ej: "web_oficial", "contacto_page")
- notas: observaciones relevantes del responsable (nombre, cargo)"""
GENERIC_PARTS = [
    "Sos un extractor de datos B2B para seguridad electrónica corporativa.\n\n"
    "Del HTML que recibís, extraé información de contacto de **",
    "** en Argentina.\n\nCampos comunes a extraer:\n" + COMMON_FIELDS + "\n\nCampos metadata específicos de ",
    ":\n",
    "\n\nReglas:\n- Si un dato no está en el HTML, devolvé null. No inventes.\n"
    "- Emails genéricos (info@, contacto@) son válidos.\n"
    "- Respondé en JSON válido con los campos comunes + metadata.\n",
]
REQUEST_BEFORE = "Extraé los datos de contacto del siguiente contenido:\n\n---\n"
REQUEST_AFTER = "\n---\n\nRespondé SOLO con JSON válido."
TYPE_TEXT = {
    "str": "string | null", "int": "número entero | null", "float": "número decimal | null",
    "bool": "true/false | null", "list": "lista de strings",
}
CONTACT_SYSTEM = """You are a precise data extraction assistant specialized in Argentine gated communities (barrios cerrados, countries, barrios privados).

Your task: Extract ONLY official administrator/manager contact information from the text.

STRICT RULES TO AVOID INVALID LEADS:
1. IGNORE REAL ESTATE AGENCIES (INMOBILIARIAS): If a contact or email belongs to a real estate broker, sales agent, or agency (e.g., words like "Propiedades", "Inmobiliaria", "Realty", "Broker", "Ventas"), DISCARD IT. We only want the administration.
2. TARGET ROLES: Look for "Administración", "Intendencia", "Gerencia", "Secretaría", "Consejo de Propietarios", "Seguridad".
3. NO INVENTIONS: Extract ONLY what is explicitly in the text.
4. VALIDATION: If the text is just a house listing for sale, it likely won't have the neighborhood's admin contact. In that case, return NO_ENCONTRADO.
5. An email or phone not tied to a specific person goes in emails_generales or telefono_general if it looks like an official administration contact (e.g., admin@..., info@barrio...)."""
CONTACT_BEFORE = "Extract administrator contact information from this Argentine gated community contact page:\n\n---\n"
CONTACT_AFTER = "\n---\n\nReturn structured JSON with the contacts found."


def _type_text() -> Column:
    by_kind = F.create_map(*[F.lit(x) for kv in TYPE_TEXT.items() for x in kv])
    options = F.array_join(F.transform("options", lambda o: F.concat(F.lit("'"), o, F.lit("'"))), ", ")
    return F.when(F.col("kind") == "enum", F.concat(options, F.lit(" | null"))).when(
        (F.col("kind") == "bool") & F.col("default_value").isNotNull(), "true/false").otherwise(
        F.try_element_at(by_kind, F.col("kind")))


def prompt_table(spark: SparkSession, fields: DataFrame | None = None, verticals: DataFrame | None = None) -> DataFrame:
    """One prompt text per vertical from the field registry (about 90 rows)."""
    fields = field_dimension(spark) if fields is None else fields
    verticals = vertical_dimension(spark) if verticals is None else verticals
    default = F.when(F.col("default_value").isNotNull(), F.col("default_value").cast("string")).when(
        F.col("kind") == "list", F.lit("[]")).otherwise("null")
    lines = fields.select(
        "vertical", "pos", F.concat(F.lit("- "), "name", F.lit(": "), _type_text()).alias("doc"),
        F.concat(F.lit('    "'), "name", F.lit('": '), default).alias("json"),
    )

    def listing(name: str, sep: str) -> Column:
        ordered = F.sort_array(F.collect_list(F.struct("pos", name)))
        return F.array_join(F.transform(ordered, lambda x: x[name]), sep)

    joined = lines.groupBy("vertical").agg(listing("doc", "\n").alias("docs"), listing("json", ",\n").alias("jsons"))
    head = F.replace(F.lit(PROMPT_HEAD), F.lit("{display_name}"), F.col("display_name"))
    text = F.concat(
        head, F.coalesce("docs", F.lit("_(sin campos específicos)_")), F.lit(PROMPT_FORMAT),
        F.coalesce("jsons", F.lit('    "_": null')), F.lit(PROMPT_TAIL),
    )
    return verticals.join(joined, "vertical", "left").select("vertical", "display_name", text.alias("prompt"))


def generic_prompts(verticals: DataFrame) -> DataFrame:
    names = F.array_join("metadata_fields", ", ")
    a, b, c, d = [F.lit(p) for p in GENERIC_PARTS]
    return verticals.select("vertical", F.concat(a, "display_name", b, "display_name", c, names, d).alias("generic"))


def prompts_or_generic(verticals: DataFrame, prompts: DataFrame) -> DataFrame:
    """Prompt of every vertical: its own, else the generic text."""
    return generic_prompts(verticals).join(prompts.select("vertical", "prompt"), "vertical", "left").select(
        "vertical", F.coalesce("prompt", "generic").alias("prompt"))


def missing_prompts(verticals: DataFrame, prompts: DataFrame) -> DataFrame:
    return verticals.join(prompts.select("vertical"), "vertical", "left_anti")


def generate_missing(spark: SparkSession, existing: DataFrame) -> DataFrame:
    """Prompts of the verticals that have none yet."""
    return missing_prompts(prompt_table(spark), existing)


def _request_text(before: str, after: str, limit: int | None) -> dict[str, Column]:
    """The user text, and whether a budget (characters; None: none) cut the page text in it."""
    text = F.col("text") if limit is None else cut_text("text", limit)
    cut = F.lit(False) if limit is None else F.coalesce(F.length("text") > limit, F.lit(False))
    return {"user": F.concat(F.lit(before), text, F.lit(after)), "truncated": cut}


def batch_requests(pages: DataFrame, prompts: DataFrame, limit: int | None = None) -> DataFrame:
    """Request rows (system and user text, ``truncated``) of pages ``(..., vertical, text)``.

    The prompt table has one row per vertical and is broadcast: the few verticals would leave all pages to as many tasks.
    """
    system = prompts.select("vertical", F.col("prompt").alias("system"))
    return pages.join(F.broadcast(system), "vertical").withColumns(_request_text(REQUEST_BEFORE, REQUEST_AFTER, limit))


def contact_requests(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """Request rows of the contact extraction."""
    return pages.withColumn("system", F.lit(CONTACT_SYSTEM)).withColumns(_request_text(CONTACT_BEFORE, CONTACT_AFTER, limit))

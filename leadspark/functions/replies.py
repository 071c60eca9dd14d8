"""Model replies as VARIANT values: cleaning, field split, strict metadata, lead assembly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import COMMERCIAL_STATES, DEFAULT_COUNTRY, METADATA_FIELDS, Field
from .extract import is_valid_email
from .text import _col, canonical_site, truthy, valid_site

_TEXT_FIELDS = [
    "nombre", "telefono", "notas", "direccion", "localidad", "partido", "provincia", "pais", "cp",
]
_EMAIL_FIELDS = ["email", "email_2", "email_3"]
_SPARK_TYPE = {"str": "string", "enum": "string", "int": "bigint", "float": "double", "bool": "boolean",
               "list": "array<string>"}


def clean_reply(reply) -> Column:
    """Reply text without reasoning blocks and code fences."""
    t = F.regexp_replace(F.coalesce(_col(reply), F.lit("")), r"(?s)<think>.*?</think>", "")
    t = F.regexp_replace(t, r"```(?:json)?\s*", "")
    t = F.regexp_replace(t, r"(?U)^\s+|\s+$", "")
    return F.regexp_replace(F.regexp_replace(t, r"`+$", ""), r"(?U)\s+$", "")


def parse_reply(reply) -> Column:
    """Reply as a VARIANT object; the first ``{...}`` block as fallback, ``{}`` at worst."""
    t = clean_reply(reply)
    block = F.regexp_extract(t, r"(?s)\{.*\}", 0)
    parsed = F.coalesce(F.try_parse_json(t), F.try_parse_json(F.nullif(block, F.lit(""))))
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return F.when(is_object, parsed).otherwise(F.parse_json(F.lit("{}")))


def json_type(variant, path: str) -> Column:
    """Type name of a field (``STRING``, ``BIGINT`` ...); NULL when absent or null."""
    kind = F.schema_of_variant(F.try_variant_get(_col(variant), path, "variant"))
    return F.when(kind != "VOID", kind)


def reply_field(variant, name: str, dtype: str = "string") -> Column:
    return F.try_variant_get(_col(variant), f"$.{name}", dtype)


def _metadata_source(variant: Column, name: str) -> tuple[Column, Column]:
    """(type, container path flag) of a metadata field: nested object first, then top level."""
    nested = json_type(variant, f"$.metadata.{name}")
    top = json_type(variant, f"$.{name}")
    return nested, top


def metadata_value(variant, field: Field) -> Column:
    v = _col(variant)
    dtype = _SPARK_TYPE[field.kind]
    return F.coalesce(
        F.try_variant_get(v, f"$.metadata.{field.name}", dtype), F.try_variant_get(v, f"$.{field.name}", dtype)
    )


def field_is_valid(variant, field: Field) -> Column:
    """Strict check of one metadata field: absent is fine, a wrong JSON type is not."""
    v = _col(variant)
    nested, top = _metadata_source(v, field.name)
    kind = F.coalesce(nested, top)
    value = metadata_value(v, field)
    whole = kind == "BIGINT"
    if field.kind in ("str", "enum"):
        ok = kind == "STRING"
    elif field.kind == "int":
        ok = whole
    elif field.kind == "float":
        ok = whole | kind.startswith("DECIMAL") | (kind == "DOUBLE")
    elif field.kind == "bool":
        ok = kind == "BOOLEAN"
    else:
        ok = kind.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.coalesce(
            F.exists(value, lambda x: x.isNull()), F.lit(False)
        )
    if field.options:
        ok = ok & value.isin(*field.options)
    if field.low is not None:
        ok = ok & value.between(field.low, field.high)
    return kind.isNull() | F.coalesce(ok, F.lit(False))


def metadata_is_valid(variant, vertical: str) -> Column:
    ok = F.lit(True)
    for field in METADATA_FIELDS[vertical]:
        ok = ok & field_is_valid(variant, field)
    return ok


def metadata_json(variant, vertical: str) -> Column:
    """Validated metadata of one vertical as JSON text; any bad field voids it (``{}``)."""
    values = []
    for field in METADATA_FIELDS[vertical]:
        value = metadata_value(variant, field)
        if field.kind == "list":
            value = F.coalesce(value, F.array().cast("array<string>"))
        elif field.default is not None:
            value = F.coalesce(value, F.lit(field.default))
        values.append(value.alias(field.name))
    return F.when(metadata_is_valid(variant, vertical), F.to_json(F.struct(*values))).otherwise(F.lit("{}"))


def metadata_json_for(variant, vertical_col, verticals: list[str] | None = None) -> Column:
    """Metadata JSON where the vertical is a column; other verticals give NULL."""
    chain = None
    for name in verticals or list(METADATA_FIELDS):
        cond = _col(vertical_col) == name
        chain = F.when(cond, metadata_json(variant, name)) if chain is None else chain.when(
            cond, metadata_json(variant, name)
        )
    return chain


def _lax_bool(v: Column, name: str) -> Column:
    text = F.lower(reply_field(v, name))
    return (
        F.when(text.isin("true", "1", "t", "yes", "y", "on"), F.lit(True))
        .when(text.isin("false", "0", "f", "no", "n", "off"), F.lit(False))
    )


def _present(v: Column, name: str) -> Column:
    return json_type(v, f"$.{name}").isNotNull()


def reply_reject_reason(variant) -> Column:
    """First reason why a reply gives no lead, or NULL.

    Text fields must be JSON strings, e-mails and the site must be well formed,
    the score an integer 0..100, coordinates numbers.
    """
    v = _col(variant)
    name_kind = json_type(v, "$.nombre")
    reason = F.when(name_kind.isNull() | (reply_field(v, "nombre") == ""), F.lit("sin nombre"))
    for name in _TEXT_FIELDS:
        reason = reason.when(_present(v, name) & (json_type(v, f"$.{name}") != "STRING"), F.lit(f"{name}: no es texto"))
    for name in _EMAIL_FIELDS:
        reason = reason.when(_present(v, name) & ~is_valid_email(reply_field(v, name)), F.lit(f"{name}: inválido"))
    score = reply_field(v, "email_score", "double")
    reason = reason.when(
        _present(v, "email_score")
        & ~F.coalesce(score.between(0, 100) & (score == F.floor(score)), F.lit(False)),
        F.lit("email_score: fuera de rango"),
    )
    reason = reason.when(
        _present(v, "email_validado") & _lax_bool(v, "email_validado").isNull(), F.lit("email_validado: no es booleano")
    )
    reason = reason.when(
        _present(v, "sitio_web") & ~valid_site(reply_field(v, "sitio_web")), F.lit("sitio_web: inválido")
    )
    reason = reason.when(
        _present(v, "estado_comercial")
        & ~F.coalesce(reply_field(v, "estado_comercial").isin(*COMMERCIAL_STATES), F.lit(False)),
        F.lit("estado_comercial: desconocido"),
    )
    for name in ("latitud", "longitud"):
        reason = reason.when(
            _present(v, name) & reply_field(v, name, "double").isNull(), F.lit(f"{name}: no es número")
        )
    return reason


def lead_from_reply(variant, vertical, source_url, enriched_at, verticals: list[str] | None = None) -> Column:
    """Lead struct of a reply; NULL when the reply is refused.

    The page address wins over a ``fuente_contacto`` in the reply.
    """
    v = _col(variant)

    def text(name: str) -> Column:
        return reply_field(v, name)

    lead = F.struct(
        text("nombre").alias("nombre"),
        _col(vertical).alias("vertical"),
        F.coalesce(text("estado_comercial"), F.lit(COMMERCIAL_STATES[0])).alias("estado_comercial"),
        *[F.trim(text(n)).alias(n) for n in _EMAIL_FIELDS],
        F.coalesce(_lax_bool(v, "email_validado"), F.lit(False)).alias("email_validado"),
        reply_field(v, "email_score", "double").cast("int").alias("email_score"),
        text("telefono").alias("telefono"),
        canonical_site(text("sitio_web")).alias("sitio_web"),
        F.coalesce(F.when(truthy(source_url), _col(source_url)), text("fuente_contacto")).alias("fuente_contacto"),
        _col(enriched_at).alias("fecha_enriquecimiento"),
        *[text(n).alias(n) for n in ("notas", "direccion", "localidad", "partido", "provincia")],
        F.coalesce(text("pais"), F.lit(DEFAULT_COUNTRY)).alias("pais"),
        text("cp").alias("cp"),
        reply_field(v, "latitud", "double").alias("latitud"),
        reply_field(v, "longitud", "double").alias("longitud"),
        metadata_json_for(v, vertical, verticals).alias("metadata"),
    )
    return F.when(reply_reject_reason(v).isNull(), lead)

"""Redaction of personal data in columns, free text and nested values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import _col

# --- fixed values: what counts as an e-mail or a phone in free text ---
PII_EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PII_PHONE = r"(?U)\+?\d[\d\s\.\-\(\)]{6,}\d"


def pseudonymize_email(email) -> Column:
    """First 8 hex digits of the SHA-256 of the local part, domain in clear."""
    e = _col(email)
    at = F.instr(e, "@")
    local = F.when(at > 0, F.substring(e, F.lit(1), at - 1)).otherwise(e)
    domain = F.when(at > 0, F.substring(e, at + 1, F.length(e))).otherwise("")
    return F.concat(F.substring(F.sha2(local, 256), 1, 8), F.lit("@"), domain)


def mask_phone(phone) -> Column:
    """``****-`` and the last four digits, ``****`` when there are fewer."""
    digits = F.regexp_replace(_col(phone), r"(?U)\D", "")
    return F.when(F.length(digits) >= 4, F.concat(F.lit("****-"), F.right(digits, F.lit(4)))).otherwise("****")


def _replace_hits(text: Column, pattern: str, replace: Callable[[Column], Column]) -> Column:
    pieces = F.split(text, pattern, -1)
    hits = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), replace)
    return F.array_join(
        F.zip_with(pieces, hits, lambda piece, hit: F.concat(F.coalesce(piece, F.lit("")), F.coalesce(hit, F.lit("")))),
        "",
    )


def redact_text(text) -> Column:
    """E-mails first, then phones."""
    t = _col(text)
    no_mail = F.when(F.instr(t, "@") > 0, _replace_hits(t, PII_EMAIL, pseudonymize_email)).otherwise(t)
    return _replace_hits(no_mail, PII_PHONE, mask_phone)


def redact_value(column: Column, dtype: T.DataType) -> Column:
    """Redact every string inside a nested value, keeping its shape (keys stay)."""
    if isinstance(dtype, T.StringType):
        return redact_text(column)
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda x: redact_value(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(column, lambda _k, v: redact_value(v, dtype.valueType))
    if isinstance(dtype, T.StructType):
        rebuilt = F.struct(*[redact_value(column[f.name], f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(column.isNotNull(), rebuilt)
    return column


def redact_frame(df: DataFrame, verbose: bool = False) -> DataFrame:
    """Every column of a table redacted; ``verbose`` leaves it as it is."""
    if verbose:
        return df
    return df.select(*[redact_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])

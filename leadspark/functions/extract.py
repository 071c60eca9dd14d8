"""Contact extraction from plain text: e-mails, Argentine phones, page budgets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, truthy

# --- fixed values: contact patterns and text budgets ---
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE_PATTERN = r"(?U)(?:\+?54[\s-]?)?(?:11|[2368]\d)[\s-]?\d{4}[\s-]?\d{4}"
EXTRACTION_BUDGET = 6_000
REQUEST_BUDGET = 8_000
PAGE_BUDGET = 12_000
EMPTY_TEXT_ERROR = "Texto vacío"
NO_PAGE_ERROR = "Sin web / Texto vacío"
ALL_FAILED_ERROR = "Todos los LLM fallaron"
REGEX_ONLY = "regex_only"
NO_NAME = "NO_ENCONTRADO"


def _distinct_hits(text, pattern: str) -> Column:
    hits = F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(pattern), F.lit(0))
    return F.sort_array(F.array_distinct(hits))


def emails_in(text) -> Column:
    """Distinct e-mail addresses, sorted. The pattern only runs where there is an ``@``."""
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(F.instr(_col(text), "@"), F.lit(0)) > 0, _distinct_hits(text, EMAIL_PATTERN)).otherwise(none)


def phones_in(text) -> Column:
    """Distinct Argentine phone numbers as written, sorted."""
    return _distinct_hits(text, PHONE_PATTERN)


def is_valid_email(email) -> Column:
    return F.coalesce(F.trim(_col(email)).rlike(f"^{EMAIL_PATTERN}$"), F.lit(False))


def clean_email(email) -> Column:
    """Trimmed, lower-case address; empty or invalid becomes NULL (see is_valid_email)."""
    return F.when(is_valid_email(email), F.lower(F.trim(_col(email))))


def clean_person_name(name) -> Column:
    """Trimmed name; blank becomes NULL."""
    trimmed = F.trim(F.coalesce(_col(name), F.lit("")))
    return F.when(trimmed != "", trimmed)


def contact_reject_reason(contact) -> Column:
    """Why one contact struct is refused, or NULL."""
    c = _col(contact)
    email = c["email"]
    return (
        F.when(clean_person_name(c["nombre_completo"]).isNull(), F.lit("nombre vacío"))
        .when(truthy(email) & ~is_valid_email(email), F.concat(F.lit("Email inválido: "), email))
    )


def clean_contact(contact) -> Column:
    c = _col(contact)
    return F.struct(
        clean_person_name(c["nombre_completo"]).alias("nombre_completo"),
        c["cargo"].alias("cargo"),
        clean_email(c["email"]).alias("email"),
        c["telefono"].alias("telefono"),
    )


def named_contacts(contacts) -> Column:
    """Contacts whose name was found."""
    return F.filter(_col(contacts), lambda c: ~c["nombre_completo"].eqNullSafe(F.lit(NO_NAME)))


def is_blank(text) -> Column:
    """Nothing but white space; NULL counts as empty."""
    return ~F.coalesce(_col(text), F.lit("")).rlike(r"(?U)[^\s\x1c-\x1f]")


def cut_text(text, limit: int) -> Column:
    return F.substring(_col(text), 1, limit)


def union_emails(regex_emails, contacts, general) -> Column:
    """Per-record set union of pattern hits, contact addresses and general addresses."""
    empty = F.array().cast("array<string>")
    from_contacts = F.transform(F.coalesce(_col(contacts), F.array().cast(
        "array<struct<nombre_completo:string,cargo:string,email:string,telefono:string>>")), lambda c: c["email"])
    addresses = F.concat(
        F.coalesce(_col(regex_emails), empty),
        F.filter(from_contacts, lambda e: truthy(e)),
        F.filter(F.coalesce(_col(general), empty), lambda e: e.isNotNull()),
    )
    return F.sort_array(F.array_distinct(addresses))

"""Mailboxes and phone lines as keys: two notations of one contact give one text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rosterweave.functions.text import let
from rosterweave.operators.joins import bounded_broadcast

_EDGE = r"^[\s ]+|[\s ]+$"


# an address that is as it should be needs no cleaning
_CLEAN = r"^[a-z0-9._%\-][a-z0-9._%'\-]*@[a-z0-9\-]+(?:\.[a-z0-9\-]+)*\.[a-z]{2,}\z"


def _unwrapped(low: Column) -> Column:
    c = F.regexp_replace(low, _EDGE, "")
    c = F.regexp_replace(c, r"^[^<]*<([^<>]*)>.*$", "$1")
    c = F.regexp_replace(c, r"^[\s(\[\"']*(?:mailto:)?\s*|[\s)\]\"';,.]+$", "")
    c = F.regexp_replace(c, r"^([^@+]+)\+[^@]*@", "$1@")
    return F.nullif(F.regexp_extract(c, r"^([a-z0-9._%'\-]+@[a-z0-9\-]+(?:\.[a-z0-9\-]+)*\.[a-z]{2,})$", 1), F.lit(""))


def mailbox(raw: Column) -> Column:
    """Lower-case address without wrapping and without a ``+`` suffix; null if malformed."""
    return let(F.lower(raw), lambda low: F.when(low.rlike(_CLEAN), low).otherwise(_unwrapped(low)))


def _bare_number(raw: Column) -> Column:
    c = F.lower(F.regexp_replace(raw, _EDGE, ""))
    c = F.regexp_replace(c, r"^(?:tel|phone|cell|mobile|whatsapp)\s*[.:]\s*|[\s,;]*(?:extension|ext\.?|x|#)\s*\d{1,6}$|\(0\)", "")
    return F.regexp_extract(c, r"^([\s(]*\+?[\d\s().\-/‐-―]+)$", 1)


# a number without words and rare marks needs no cleaning but of its marks
_PLAIN = r"^[ (]*\+?[0-9 ().\-/]+\z"


def phone_line(raw: Column) -> Column:
    """``+`` and digits without extension; null if malformed. Without a country prefix a
    number of ten digits (or eleven from 1) is one of the United States."""
    plain = raw.rlike(_PLAIN) & ~raw.contains("(0)")
    digits = F.when(plain, F.translate(raw, " ().-/", "")).otherwise(F.regexp_replace(_bare_number(raw), r"[^\d+]", ""))
    dialled = lambda c: F.when(c.startswith("0"), F.regexp_replace(c, r"^(?:00|011(?=\d{9}))", "+")).otherwise(c)
    prefixed = lambda c: F.when(c.startswith("+"), c).otherwise(F.regexp_replace(c, r"^1?([2-9]\d{9})$", "+1$1"))
    valid = lambda c: F.when(c.rlike(r"^\+(?:1[2-9]\d{9}|91\d{10}|44\d{9,10}|(?!91|44)[2-9]\d{7,14})\z"), c)
    return let(digits, lambda c: let(dialled(c), lambda d: let(prefixed(d), valid)))


def contact_rows(df: DataFrame, id_col: str, emails: Column, phones: Column, shared: DataFrame) -> DataFrame:
    """Distinct ``(id_col, contact)`` of the personal contacts in two array columns.

    ``shared`` is the fixed table of contacts that belong to offices.
    """
    raw = df.select(id_col, F.transform(F.coalesce(emails, F.array().cast("array<string>")), mailbox).alias("_e"), F.transform(F.coalesce(phones, F.array().cast("array<string>")), phone_line).alias("_p"))
    rows = raw.select(id_col, F.explode(F.array_distinct(F.filter(F.concat("_e", "_p"), lambda x: x.isNotNull()))).alias("contact"))
    office = shared.select(F.coalesce(F.when(F.col("kind") == "email", mailbox(F.col("contact"))), F.when(F.col("kind") == "phone", phone_line(F.col("contact")))).alias("contact")).distinct()
    return rows.join(bounded_broadcast(office), "contact", "left_anti").select(id_col, "contact")

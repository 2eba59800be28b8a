"""String normalisers used by the identity checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ASCII_WHITESPACE = " \t\n\r\f\v"
COUNTRY_CODE = "971"


def strip(col: Column) -> Column:
    """Remove leading and trailing white space (not only blanks)."""
    return F.btrim(col, F.lit(ASCII_WHITESPACE))


def normalize_phone(col: Column) -> Column:
    """E.164 form of a UAE phone number: digits with the country code in front."""
    digits = F.regexp_replace(col, r"[^\p{Nd}]", "")
    national = F.when(digits.startswith("0"), F.substr(digits, F.lit(2))).otherwise(digits)
    return F.when(digits.startswith(COUNTRY_CODE), F.concat(F.lit("+"), digits)).otherwise(
        F.concat(F.lit("+" + COUNTRY_CODE), national)
    )


def normalize_email(col: Column) -> Column:
    return F.lower(strip(col))


def piped(*cols: Column) -> Column:
    """Parts joined by a pipe; a missing part is an empty string."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def name_uuid(*cols: Column) -> Column:
    """A UUID-shaped id derived from the given parts.

    Unlike ``uuid()`` it does not change when a lost task or a replayed
    micro-batch computes the row again.
    """
    shaped = F.substring(F.sha2(piped(*cols), 256), 1, 32)
    for after in (20, 16, 12, 8):  # from the right; cheaper than a regular expression on every row
        shaped = F.overlay(shaped, F.lit("-"), after + 1, 0)
    return shaped


def content_hash(raw: Column) -> Column:
    """Hash of a payload exactly as received."""
    return F.concat(F.lit("sha256:"), F.sha2(raw, 256))

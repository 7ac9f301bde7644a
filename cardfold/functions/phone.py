"""Phone numbers: cleaned for display, keyed for matching, never numeric."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cardfold.functions.text import WS, collapse, strip

SCIENTIFIC_MESSAGE = "phone must not use scientific notation"


def _trimmed(c: Column) -> Column:
    body = F.regexp_replace(strip(c), rf"\A(?i:tel:){WS}*", "")
    return collapse(F.regexp_replace(body, rf"(?i:ext|exten[sſ]ion|x){WS}*\p{{Nd}}+\z", ""))


_SCIENTIFIC = r"\A[+-]?\p{Nd}+(?:\.\p{Nd}+)?[eE][+-]?\p{Nd}+\z"


def is_scientific(c: Column) -> Column:
    """True for a value written like 6.4e+10; null stays null."""
    return _trimmed(c).rlike(_SCIENTIFIC)


def clean_phone(c: Column, on_invalid: str = "raise") -> Column:
    """The number as typed, without ``tel:`` and extension; null without digits.

    Scientific notation fails the job, or gives null with ``on_invalid='null'``.
    """
    text = _trimmed(c)
    bad = F.lit(None).cast("string")
    if on_invalid == "raise":
        bad = F.raise_error(F.lit(SCIENTIFIC_MESSAGE)).cast("string")
    # The first test reads the text twice, so that generated code keeps it.
    no_number = (text == "") | ~text.rlike(r"\p{Nd}")
    return F.when(no_number, None).when(text.rlike(_SCIENTIFIC), bad).otherwise(text)


def phone_match_key(c: Column, on_invalid: str = "raise") -> Column:
    """Digits only, with the country prefix 64 / 0064 written as a leading 0."""
    digits = F.regexp_replace(clean_phone(c, on_invalid), r"\P{Nd}+", "")
    return F.nullif(F.regexp_replace(digits, r"\A(?:0064|64)", "0"), F.lit(""))


def decode_tel(href: Column) -> Column:
    """The percent-decoded number of a ``tel:`` link; null for other links."""
    raw = F.substring(href, 5, 1 << 30)
    # A plus sign is literal here, and a stray percent sign stays as it is.
    kept = F.replace(raw, F.lit("+"), F.lit("%2B"))
    kept = F.regexp_replace(kept, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(
        F.lower(href).startswith("tel:"), F.coalesce(F.try_url_decode(kept), raw)
    )

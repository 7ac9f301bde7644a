"""Text cleaning as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Whitespace as Python's str methods see it: Java's \s lacks the separators
# U+001C..U+001F, NEL and every non-ASCII space.
WS = r"[\s\x1c-\x1f\x{0085}\p{Z}]"
# The same characters one by one.
_WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"
    + "".join(map(chr, range(0x2000, 0x200B)))
)

_RUN = rf"{WS}{{2,}}|[{WS}&&[^ ]]"

_LETTER = "A-Za-zİıſK"  # letters under case-insensitive [A-Z]
_LOCAL = rf"[{_LETTER}0-9._%+-]"
# A URL, a www host or an e-mail address. An address may only start where its
# run of characters starts (or where the last match ended), which keeps long
# runs without an "@" linear.
_TOKEN = (
    r"[Hh][Tt][Tt][Pp][Ssſ]?://[^ ]+"
    r"|[Ww]{3}\.[^ ]+"
    rf"|(?:\G|(?<!{_LOCAL})){_LOCAL}++@[{_LETTER}0-9.-]+\.[{_LETTER}]{{2,}}"
)


def strip(c: Column) -> Column:
    """Drop whitespace at both ends."""
    return F.btrim(c, F.lit(_WS_CHARS))


def collapse(c: Column) -> Column:
    """Whitespace runs to one space, ends trimmed.

    Single spaces, by far the most common run, are not matched at all.
    """
    return F.trim(F.regexp_replace(c, _RUN, " "))


def clean_text(c: Column) -> Column:
    """Collapsed text; blank becomes null."""
    return F.nullif(collapse(c), F.lit(""))


def clean_display_text(c: Column) -> Column:
    """Tidy punctuation spacing without touching URLs and e-mail addresses.

    Collapsed text holds no control whitespace, so those characters serve as
    marks: tokens are wrapped in LF..CR, and each later pattern matches a
    wrapped token first and copies it unchanged. A wrapped token counts as a
    letter on its left side only.
    """
    text = collapse(c)
    may_hold_token = text.contains("@") | text.contains("://") | text.rlike(r"[Ww]{3}\.")
    wrapped = F.regexp_replace(text, _TOKEN, "\n$0\r")
    closed = F.regexp_replace(wrapped, r"(\n[^\r]*\r)| ([,.;:!?])", "$1$2")
    opened = F.regexp_replace(
        closed,
        r"(\n[^\r]*\r)|(?<=[A-Za-z])([,;:!?])(?=[A-Za-z\n])",
        "$1\t$2\f",
    )
    unmarked = F.translate(F.replace(opened, F.lit("\t\f"), F.lit("")), "\f\t\n\r", " ")
    # Most texts hold no token and need two plain replacements.
    plain = F.regexp_replace(
        F.regexp_replace(text, " (?=[,.;:!?])", ""),
        r"([,;:!?])(?<=[A-Za-z].)(?=[A-Za-z])",
        "$1 ",
    )
    tidy = F.when(may_hold_token, F.trim(F.regexp_replace(unmarked, " {2,}", " "))).otherwise(plain)
    return F.nullif(tidy, F.lit(""))


def category_key(c: Column) -> Column:
    """Case- and whitespace-insensitive category key; null becomes ''."""
    return F.lower(F.coalesce(collapse(c), F.lit("")))


def completeness(*fields: Column) -> Column:
    """How many of the fields hold something other than whitespace."""
    filled = [F.coalesce(f.rlike(rf"[^\s\x1c-\x1f\x{{0085}}\p{{Z}}]"), F.lit(False)) for f in fields]
    total = F.lit(0)
    for flag in filled:
        total = total + flag.cast("int")
    return total


def listed_count(c: Column) -> Column:
    """The first ``(1,234)`` in a text as an integer; null when there is none."""
    digits = F.replace(F.regexp_extract(c, r"\(([\p{Nd},]+)\)", 1), F.lit(","), F.lit(""))
    return digits.try_cast("int")

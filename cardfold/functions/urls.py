"""URL normalisation as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cardfold.functions.text import strip

_PARTS = r"(?s)\A(?i:(https?)):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?\z"


def _part(c: Column, group: int) -> Column:
    return F.regexp_extract(c, _PARTS, group)


def _plain(c: Column) -> Column:
    """Tabs and line breaks inside a URL do not count."""
    return F.translate(c, "\t\r\n", "")


def _path(c: Column) -> Column:
    """Path without the ``;parameters`` of its last segment."""
    return F.regexp_replace(_part(c, 3), r"(?s);[^/]*\z", "")


# Everything of a URL that its canonical form drops: scheme and host (put back
# in lower case), an empty query, the fragment, the parameters of the last path
# segment, trailing slashes of the path and all but one of several slashes. A
# query is matched first, up to its end, and kept.
_DROPPED = (
    r"(?s)\A[^:]*://[^/?#]*"
    r"|(\?[^#]+)(?:#.*)?\z"
    r"|\??(?:#.*)\z|\?\z"
    r"|;[^/?#]*(?=[?#]|\z)"
    r"|/+(?=(?:;[^/?#]*)?(?:[?#]|\z))"
    r"|/(?=/)"
)


def clean_url(c: Column) -> Column:
    """Canonical http(s) URL: https by default, lower-case scheme and host, no
    duplicate or trailing slashes, no fragment; the query is kept."""
    text = strip(c)
    value = _plain(
        F.when(text.rlike(r"\A(?i:https?)://"), text).otherwise(F.concat(F.lit("https://"), text))
    )
    site = F.regexp_extract(value, r"\A[^:]*://[^/?#]+", 0)
    joined = F.concat(F.lower(site), F.regexp_replace(value, _DROPPED, "$1"))
    # The test reads value and site twice, so that generated code keeps them.
    no_host = (site == "") | (value == "") | (F.length(site) == 0)
    return F.when(no_host, None).otherwise(F.rtrim(joined, F.lit("/")))


def normalize_input_url(c: Column) -> Column:
    """A typed-in URL: the target of a Markdown link if there is one, unquoted."""
    text = strip(c)
    target = F.regexp_extract(text, r"\((https?://[^)]+)\)", 1)
    return F.btrim(F.when(target != "", target).otherwise(text), F.lit("\"'"))


def is_public_url(c: Column) -> Column:
    """True for a normalised URL with an http(s) scheme and a host."""
    return F.coalesce(_part(_plain(c), 2) != "", F.lit(False))


def validate_public_url(c: Column) -> Column:
    """Normalised URL; anything else than http(s) with a host fails the job."""
    url = normalize_input_url(c)
    return F.when(is_public_url(url), url).otherwise(F.raise_error(F.lit(INVALID_URL_MESSAGE)))


INVALID_URL_MESSAGE = "Scrape mode requires a valid public http(s) URL."


def url_path(c: Column) -> Column:
    return _path(_plain(c))


def url_origin(c: Column) -> Column:
    """``scheme://host`` of an absolute URL."""
    value = _plain(c)
    return F.concat(F.lower(_part(value, 1)), F.lit("://"), _part(value, 2))


def category_slug(c: Column) -> Column:
    """Last path segment, lower-case, trailing slashes ignored."""
    return F.lower(F.regexp_extract(url_path(c), r"(?s)([^/]*)/*\z", 1))

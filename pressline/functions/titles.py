"""Title, slug and URL text rules."""

from __future__ import annotations

import unicodedata
from urllib.parse import parse_qsl, urlencode

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from pressline import fixed_values as V

# --- fixed values: white space characters of feed text -----------------------------------------
SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        "
          "        　")
# The same characters as a regular expression class body.
SPACE_CLASS = (r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
               r"\x{202f}\x{205f}\x{3000}")


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank, ends are trimmed."""
    return F.trim(F.regexp_replace(c, f"[{SPACE_CLASS}]+", " "))


def strip(c: Column) -> Column:
    """Trim every kind of white space from both ends; only the ends are looked at."""
    return F.btrim(c, F.lit(SPACES))


def blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def display_title(c: Column) -> Column:
    return F.coalesce(squeeze(c), F.lit(""))


@F.pandas_udf(T.StringType())
def _compat_fold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).casefold())


@F.pandas_udf(T.StringType())
def _ascii_form(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else
                 unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode("ascii"))


def _needs_python(c: Column) -> Column:
    return c.rlike(r"[^\x00-\x7F]")


def dedup_title(c: Column) -> Column:
    """Compatibility-normalised, case-folded, punctuation-folded title used for hashing.

    Pure ASCII titles stay in the JVM; only the others take the Arrow path, since Spark has no
    compatibility normalisation of its own.
    """
    ascii_only = F.when(~_needs_python(c), F.lower(c))
    other = _compat_fold(F.when(_needs_python(c), c))
    folded = F.translate(F.coalesce(ascii_only, other), V.FOLD_FROM, V.FOLD_TO)
    return F.coalesce(squeeze(folded), F.lit(""))


def slugify(c: Column) -> Column:
    """Lower-case ASCII words joined by single hyphens; ``item`` when nothing is left."""
    plain = F.coalesce(F.when(~_needs_python(c), c), _ascii_form(F.when(_needs_python(c), c)))
    dashed = F.regexp_replace(F.lower(plain), "[^a-z0-9-]+", "-")
    dashed = F.regexp_replace(F.regexp_replace(dashed, "-+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(dashed, F.lit("")), F.lit("item"))


def is_tracking(name: Column) -> Column:
    low = F.lower(name)
    return low.startswith(V.TRACKING_PREFIX) | low.isin(V.TRACKING_PARAMS)


_TRACKED = frozenset(V.TRACKING_PARAMS)


def _tidy_query(query: str | None) -> str | None:
    if query is None:
        return None
    pairs = parse_qsl(query, keep_blank_values=True)
    return urlencode([p for p in pairs if not (p[0].lower().startswith(V.TRACKING_PREFIX)
                                               or p[0].lower() in _TRACKED)])


@F.pandas_udf(T.StringType())
def _tidy_queries(s: pd.Series) -> pd.Series:
    return s.map(_tidy_query)


# Queries made of these characters come out of re-encoding unchanged, so they stay in the JVM.
_PLAIN_QUERY = "^[A-Za-z0-9_.~-]+=[A-Za-z0-9_.~-]*(&[A-Za-z0-9_.~-]+=[A-Za-z0-9_.~-]*)*$"


def canonical_url(c: Column) -> Column:
    """Scheme and host in lower case, no fragment, tracking parameter or closing slash.

    Other schemes pass through unchanged; blank text becomes NULL.
    """
    url = strip(c)
    web = url.rlike("(?i)^https?:")
    no_fragment = F.regexp_replace(url, "(?s)#.*$", "")
    scheme = F.lower(F.regexp_extract(no_fragment, "^([^:]+):", 1))
    rest = F.regexp_extract(no_fragment, "(?s)^[^:]+:(.*)$", 1)
    host = F.lower(F.regexp_extract(rest, "(?s)^//([^/?]*)", 1))
    tail = F.regexp_replace(rest, "(?s)^//[^/?]*", "")
    path = F.regexp_extract(tail, r"(?s)^([^?]*)", 1)
    query = F.regexp_extract(tail, r"(?s)^[^?]*\?(.*)$", 1)
    path = F.when(path == "", "/").when(path == "/", path).otherwise(
        F.regexp_replace(path, "/$", ""))
    plain = query.rlike(_PLAIN_QUERY)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~is_tracking(
        F.substring_index(p, "=", 1))), "&")
    tidy = F.when(query == "", "").when(plain, kept).otherwise(
        _tidy_queries(F.when((query != "") & ~plain, query)))
    mark = F.when(tidy == "", "").otherwise(F.lit("?"))
    built = F.concat(scheme, F.lit("://"), host, path, mark, tidy)
    return F.when(url == "", None).when(web, built).otherwise(url)


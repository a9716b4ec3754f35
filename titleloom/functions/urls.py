"""URL resolution and normalisation.

Plain URL shapes are handled by native expressions. Whatever they do not cover exactly
(dot segments, relative paths, entities, odd characters) goes to one Arrow-batched function over
the standard library; for every other row that function is handed NULL.
"""

from __future__ import annotations

from html import unescape
from urllib.parse import urldefrag, urljoin, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Shapes that parsing and re-assembling leave as they are: no empty query, no path parameters, no
# white space or control characters.
_TAIL = r"(?:\?[^\s\x00-\x20\x7f#;]+)?(?:#[^\s\x00-\x20\x7f]*)?\z"
_AUTHORITY_ON = r"//[A-Za-z0-9._-]+(?::[0-9]+)?(?:/[^\s\x00-\x20\x7f?#;]*)?" + _TAIL
_ABSOLUTE = r"\Ahttps?:" + _AUTHORITY_ON
_SCHEMELESS = r"\A" + _AUTHORITY_ON
# "/path" without dot segments; the second character is no slash.
_ROOTED = (
    r"\A/(?!/)(?!(?:[^?#]*/)?\.{1,2}(?:[/?#]|\z))[^\s\x00-\x20\x7f?#;]*" + _TAIL
)
_ONLY_FRAGMENT = r"\A#[^\s\x00-\x20\x7f]*\z"
_OTHER_SCHEME = r"(?i)\A(?!https?:)[a-z][a-z0-9+.-]*:"


def _normalize(base: str | None, link: str | None) -> str | None:
    if base is None:
        return None
    try:
        target = urljoin(base, unescape(link)) if link else base
        target = urldefrag(target)[0].removesuffix("/")
        return target if urlparse(target).scheme in ("http", "https") else None
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def _normalize_odd(rows: pd.DataFrame) -> pd.Series:
    pairs = zip(rows["base"], rows["link"])
    return pd.Series([_normalize(*(None if pd.isna(v) else v for v in p)) for p in pairs], dtype=object)


# Evaluated once per row: a deterministic one would be copied into every filter above it.
_normalize_odd = _normalize_odd.asNondeterministic()


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def without_last_slash(url: Column) -> Column:
    """Strip one trailing slash, not more."""
    return F.regexp_replace(url, r"/\z", "")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"\A([A-Za-z][A-Za-z0-9+.-]*):", 1))


def netloc(url: Column) -> Column:
    """Host part with port, case kept; empty when there is none."""
    return F.regexp_extract(url, r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def origin(url: Column) -> Column:
    """``scheme://netloc``, the key of robots rules."""
    return F.concat(scheme(url), F.lit("://"), netloc(url))


def robots_url(url: Column) -> Column:
    return F.concat(origin(url), F.lit("/robots.txt"))


def is_web_scheme(url: Column) -> Column:
    return scheme(url).isin("http", "https")


def _settled(base: Column, link: Column | None) -> Column:
    """Joined URL of the shapes that need no parser, else NULL."""
    if link is None:
        return F.when(base.rlike(_ABSOLUTE), base)
    nothing = F.lit(None).cast("string")
    own_origin = F.regexp_extract(base, r"\Ahttps?://[^/?#]+", 0)
    return (
        F.when(~base.rlike(_ABSOLUTE), nothing)
        .when(link.isNull() | (link == "") | link.rlike(_ONLY_FRAGMENT), base)
        .when(F.contains(link, F.lit("&")), nothing)
        .when(link.rlike(_ROOTED), F.concat(own_origin, link))
        .when(link.rlike(_ABSOLUTE), link)
        .when(link.rlike(_SCHEMELESS), F.concat(scheme(base), F.lit(":"), link))
    )


def _finished(settled: Column, base: Column, link: Column | None) -> Column:
    if link is None:
        rejected = base.rlike(_OTHER_SCHEME)
        link = F.lit(None).cast("string")
    else:
        rejected = base.rlike(_ABSOLUTE) & F.coalesce(link.rlike(_OTHER_SCHEME), F.lit(False))
    odd = settled.isNull() & base.isNotNull() & ~rejected
    rest = _normalize_odd(F.when(odd, F.struct(base.alias("base"), link.alias("link"))))
    return F.coalesce(without_last_slash(without_fragment(settled)), rest)


def normalize_url(base: Column, link: Column | None = None) -> Column:
    """Absolute URL without fragment and without one trailing slash.

    ``link`` is an ``href`` value as written in the page and is resolved against ``base``; an
    empty or NULL link means the base itself. NULL for anything that is not http(s) or is
    malformed.
    """
    return _finished(_settled(base, link), base, link)


def resolve_links(rows: DataFrame, base: str, link: str, name: str) -> DataFrame:
    """Add :func:`normalize_url` of two columns, in two steps that match each link only once."""
    first, second = F.col(base), F.col(link)
    settled = rows.withColumn("_settled", _settled(first, second))
    return settled.withColumn(name, _finished(F.col("_settled"), first, second)).drop("_settled")

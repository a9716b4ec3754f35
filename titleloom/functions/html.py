"""Title and link extraction from HTML with native regular expressions."""

from __future__ import annotations

import re
from html import unescape
from html.entities import html5

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titleloom.functions.markup import VOID, read_page
from titleloom.functions.text import strip

# The rest of an opening tag; a quoted value may hold ">".
_REST = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
# Comments, marked sections, instructions, declarations, scripts and style sheets hold no elements; one that is not
# closed runs to the end. One pass, so order in the page decides; other tags are the second group, and stay.
_HIDDEN = (
    rf"(?is)<(script|style)(?=[\s/>]){_REST}(?<!/>).*?(?:</\s*\1\s*>|\z)|(<[a-z]{_REST})|<!--.*?(?:--\s*>|\z)"
    r"|<!\[\s*(?:cdata|temp|ignore|include|rcdata)(?=[\s\[]).*?(?:\]\s*\]\s*>|\z)|<(?:[!?]|/\s*(?![\sa-z]))[^>]*+(?:>|\z)"
)
# Other tags are taken as well, without the group: what looks like a tag inside one is not found.
_H1 = rf"(?is)(<h1(?=[\s/>]){_REST}.*?(?:</\s*h1(?=[\s/>])[^>]*+>|\z))|<[a-z]{_REST}"
_TAG = rf"(?is)<[a-z]{_REST}|</\s*[a-z][^>]*+>"
_A_TAG = rf"(?is)(<a(?=[\s/]){_REST})|<[a-z]{_REST}"
# An element without elements in it. What is left of an H1 when two rounds of these are taken out may hold close
# tags of something around it, or elements that close themselves; void ones do not matter.
_LEAF = rf"(?is)<(?!h1[\s/>])([a-z][a-z0-9]*)(?=[\s/>]){_REST}(?<!/>)[^<]*</\1\s*>"
_VOID_TAG = rf"(?is)<(?:{'|'.join(sorted(VOID))})(?=[\s/>]){_REST}"
_ODD = r"(?is)\A.+?(?:</(?!h1\s*>\z)|<h1[\s/>])|/>|<[a-z][^\s/>]*<"
_SECTION = r"(?i)<!\[\s*cdata"
_VALUE = r"""(?:"[^"]*"|'[^']*'|(?!["'])[^\s>]*)"""
# An attribute starts after white space or a slash, or right behind a quoted value.
_ATTRIBUTE = rf"""(?is)(?:[\s/]+|(?<=["']))[^\s=>/][^\s=>/]*(?:\s*=\s*{_VALUE})?"""
_IS_HREF = r"""(?is)\A[\s/]*href\s*(?:=|\z)"""
_HREF_VALUE = rf"""(?is)\A[\s/]*href\s*=\s*({_VALUE})"""

_REFERENCE = re.compile(r"&(?:(#(?:[0-9]+|[xX][0-9a-fA-F]+))|([A-Za-z][-.A-Za-z0-9]*));?")


def _character(reference: re.Match) -> str:
    """A numeric reference, or a name taken whole; an unknown name loses its semicolon."""
    number, name = reference.groups()
    if number:
        return unescape(f"&{number};") or "\ufffd"
    return html5.get(name + ";", "&" + name)


@F.pandas_udf(T.StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return pd.Series(
        [None if pd.isna(t) else _REFERENCE.sub(_character, t) for t in text], dtype=object
    )


_unescape = _unescape.asNondeterministic()


def unescape_entities(text: Column) -> Column:
    """Decode character references; texts without ``&`` never reach Python."""
    return F.coalesce(_unescape(F.when(F.contains(text, F.lit("&")), text)), text)


def visible_html(html: Column) -> Column:
    return F.regexp_replace(html, _HIDDEN, "$2")


@F.arrow_udf(T.StringType())
def _walked_h1(html: pa.Array) -> pa.Array:
    return pa.array([None if page is None else read_page(page)[0] for page in html.to_pylist()], pa.string())


_walked_h1 = _walked_h1.asNondeterministic()


@F.arrow_udf(T.StructType([T.StructField("title", T.StringType()), T.StructField("hrefs", T.ArrayType(T.StringType()))]))
def _read(html: pa.Array) -> pa.Array:
    pages = [(None, []) if page is None else read_page(page) for page in html.to_pylist()]
    titles, links = pa.array([page[0] for page in pages], pa.string()), pa.array([page[1] for page in pages], pa.list_(pa.string()))
    return pa.StructArray.from_arrays([titles, links], ["title", "hrefs"])


def page_parts(html: Column) -> Column:
    """``(title, hrefs)`` of a page in one pass, entities still encoded: what the expressions below find, by a walk
    over all markup. For pages that are read for both at once, or of which little is known."""
    return _read(html)


def h1_source(visible: Column, html: Column | None = None) -> Column:
    """The first H1 as ``(text, page)``, NULL texts without an H1: its text with tags removed and entities still
    encoded, and the page itself where only a walk can tell what belongs to the H1: it holds close tags that may be
    those of an element around it, elements that close themselves, or the page (given as ``html``) has sections of
    character data."""
    tags = F.regexp_extract_all(visible, F.lit(_H1), F.lit(1))
    found = F.try_element_at(F.filter(tags, lambda tag: tag != ""), F.lit(1))
    page = visible if html is None else html
    plain = lambda h1: F.regexp_replace(F.regexp_replace(F.regexp_replace(h1, _VOID_TAG, ""), _LEAF, ""), _LEAF, "")
    parts = F.transform(
        F.array(found),
        lambda h1: F.struct(
            F.regexp_replace(h1, _TAG, "").alias("text"),
            F.when(plain(h1).rlike(_ODD) | (h1.isNotNull() & page.rlike(_SECTION)), page).alias("page"),
        ),
    )
    return F.element_at(parts, 1)


def h1_title(source: Column) -> Column:
    """Final title from :func:`h1_source`; only odd pages are walked in Python."""
    walked = F.when(source["page"].isNotNull(), _walked_h1(source["page"])).otherwise(source["text"])
    return strip(unescape_entities(walked))


def hrefs(visible: Column) -> Column:
    """``href`` values of all links in page order, entities still encoded; of several in a tag the last."""
    tags = F.regexp_extract_all(visible, F.lit(_A_TAG), F.lit(1))
    named = F.transform(
        F.filter(tags, lambda tag: tag != ""),
        lambda tag: F.try_element_at(
            F.filter(
                F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(0)), lambda one: one.rlike(_IS_HREF)
            ),
            F.lit(-1),
        ),
    )
    return F.transform(
        F.filter(named, lambda one: one.isNotNull()),
        lambda one: F.regexp_replace(
            F.regexp_extract(one, _HREF_VALUE, 1), r"""(?s)\A(["'])(.*)\1\z""", "$2"
        ),
    )

"""URL parameters, URL templates and the first matching link of an HTML page."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns. Comments, scripts and styles hold no links of the page.
NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
BEFORE_HREF = r"""(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*"""
QUOTES = r"""^["']|["']$"""
# The character references that occur in link attributes; others stay as they are.
REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}
PIECE = r"&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[a-z]+;|[^&]+|&"
HIGHEST_CODE = 0x10FFFF


def query_parameter(url: Column, name: str) -> Column:
    """First non-blank value of a query parameter, percent-decoded; null when there is none."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    matching = F.filter(F.split(query, "&"), lambda p: p.rlike(f"^{re.escape(name)}=."))
    value = F.substring(F.get(matching, F.lit(0)), len(name) + 2, 2**31 - 1)
    return F.coalesce(F.try_url_decode(value), value)


def lease_page_url(template: str, lease_id: Column) -> Column:
    """Fill the one ``{lease_id}`` of a URL template."""
    before, after = template.split("{lease_id}")
    return F.concat(F.lit(before), lease_id, F.lit(after))


def first_link(html: Column, marker: str) -> Column:
    """The first anchor target that contains the marker; null when no anchor does."""
    anchors = F.regexp_extract_all(F.regexp_replace(html, NOT_MARKUP, ""), F.lit(ANCHOR), 0)
    targets = F.transform(anchors, _target)
    return F.get(F.filter(targets, lambda t: F.contains(t, F.lit(marker))), F.lit(0))


def _target(anchor: Column) -> Column:
    target = F.regexp_replace(F.regexp_replace(anchor, BEFORE_HREF, ""), QUOTES, "")
    pieces = F.regexp_extract_all(target, F.lit(PIECE), F.lit(0))
    return F.array_join(F.transform(pieces, _decoded), "")


def _decoded(piece: Column) -> Column:
    """A character reference as its character, by name, decimal or hexadecimal number."""
    number = F.regexp_extract(piece, "(?i)^&#x?([0-9a-f]+);$", 1)
    is_hex = piece.rlike("^&#[xX]")
    code = F.when(is_hex, F.conv(number, 16, 10)).otherwise(number).try_cast("int")
    known = code.between(1, HIGHEST_CODE) & ~code.between(0xD800, 0xDFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    result = F.when(piece.startswith("&#") & known, character)
    for reference, meaning in REFERENCES.items():
        result = result.when(piece == reference, meaning)
    return result.otherwise(piece)

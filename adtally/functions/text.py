"""Preview bodies: HTML character references and the first URL."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, functions as F

# Where a URL starts and the characters that end it.
URL_PATTERN = r"""(?U)https?://[^\s\x1c-\x1f"'<]+"""

# What may follow an ampersand, and the bounds of HTML5 code points.
_NUMBER = r"^#([0-9]+|[xX][0-9a-fA-F]+);?"
_NAME = r"^[^\t\n\f <&#;]{1,32};?"
_UNREADABLE = "�"
_ABOVE_UNICODE = 0x110000

# A map is searched front to back, so the names seen in preview bodies come first.
_NAMES = {name: html5[name] for name in ("amp;", "quot;", "lt;", "gt;")} | html5
# Names also read without a closing semicolon, longest first.
_OPEN_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
# References 128-159 mean Windows characters; bytes without one stand for themselves.
_WINDOWS = "".join(bytes([n]).decode("cp1252", "replace").replace(_UNREADABLE, chr(n)) for n in range(0x80, 0xA0))


def first_url(body: Column) -> Column:
    """First http(s) URL of a text, NULL when there is none."""
    return F.nullif(F.regexp_extract(body, URL_PATTERN, 0), F.lit(""))


def preview_url(body: Column) -> Column:
    """First URL of an entity-encoded body, or the decoded body when it has no URL."""
    decoded = unescape_html(body)
    return F.coalesce(first_url(decoded), F.nullif(decoded, F.lit("")))


def unescape_html(body: Column) -> Column:
    """Replace HTML character references, each one once, left to right."""
    parts = F.split(body, "&", -1)
    tail = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    decoded = F.concat(parts[0], F.array_join(F.transform(tail, _after_ampersand), ""))
    return F.when(F.contains(body, F.lit("&")), decoded).otherwise(body)


def _after_ampersand(part: Column) -> Column:
    digits = F.regexp_extract(part, _NUMBER, 1)
    name = F.regexp_extract(part, _NAME, 0)
    opening = F.regexp_extract(name, "^(?:" + "|".join(_OPEN_NAMES) + ")", 0)
    table = F.from_json(F.lit(json.dumps(_NAMES)), "map<string,string>")
    whole = F.try_element_at(table, name)
    return (
        F.when(digits != "", F.concat(_character(_code_point(digits)), F.regexp_replace(part, _NUMBER, "")))
        .when(whole.isNotNull(), F.concat(whole, F.substr(part, F.length(name) + 1)))
        .when(opening != "", F.concat(F.try_element_at(table, opening), F.substr(part, F.length(opening) + 1)))
        .otherwise(F.concat(F.lit("&"), part))
    )


def _code_point(digits: Column) -> Column:
    """Number of a reference; anything too long to hold is above the last code point."""
    hexadecimal = F.regexp_replace(digits, "^[xX]0*", "")
    number = F.when(
        digits.rlike("^[xX]"),
        F.when(F.length(hexadecimal) <= 8, F.coalesce(F.conv(F.nullif(hexadecimal, F.lit("")), 16, 10), F.lit("0"))),
    ).otherwise(digits)
    return F.least(F.coalesce(number.try_cast("bigint"), F.lit(_ABOVE_UNICODE)), F.lit(_ABOVE_UNICODE))


def _character(code: Column) -> Column:
    """Text of a code point, with the replacements HTML5 prescribes."""
    dropped = (
        code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F)
        | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code >= _ABOVE_UNICODE), F.lit(_UNREADABLE))
        .when(code.between(0x80, 0x9F), F.substr(F.lit(_WINDOWS), (code - 0x7F).cast("int"), F.lit(1)))
        .when(dropped, F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )

"""Attribute lookup in raw HTML text, JVM-side.

A page is cut into tokens by ordered alternatives: comments, elements whose
content is text and not markup, other tags. What stands in a comment or in the
text of a script is therefore never taken for a tag, and neither is a quoted
value that looks like one. Every alternative ends at the end of the text at the
latest, so each character is read once, however broken the page is.
"""

from __future__ import annotations

import json
import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscalframe.functions.text import let

# Elements whose content is text.
_TEXT_ELEMENTS = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
# The rest of a tag; quotes count behind an equals sign only.
_REST = r"""(?:=\s*+"[^"]*+(?:"|\z)|=\s*+'[^']*+(?:'|\z)|[^>=]++|=)*+(?:>|\z)"""
_COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
_TEXT_ELEMENT = rf"<({'|'.join(_TEXT_ELEMENTS)})(?=[\s/>]){_REST}.*?(?=</\1[\s/>]|\z)"
_TOKEN = rf"(?is){_COMMENT}|{_TEXT_ELEMENT}|</?[a-z]{_REST}|<[!?/][^>]*+(?:>|\z)"

# Standard table of named characters; a few of HTML 5 beside those of HTML 4 are left out.
_NAMED = json.dumps({name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"})
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

# One attribute, or the end of the tag; each starts where the one before ended,
# and none starts behind the end. Quoted values may hold any other character.
_NEXT = r"""\G(?<!>)[\s/]*(>|[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?)"""


def _attributes(behind_name: Column) -> Column:
    """Attribute texts of the tag whose name has just been cut off; empty if it never ends."""

    def up_to_end(parts: Column) -> Column:
        end = F.array_position(parts, F.lit(">"))
        return F.slice(parts, F.lit(1), F.greatest(end - 1, F.lit(0)).cast("int"))

    return let(F.regexp_extract_all(behind_name, F.lit(_NEXT), F.lit(1)), up_to_end)


def decode_entities(text: Column) -> Column:
    """``&amp;``, ``&#233;`` and ``&#xE9;`` as the characters they stand for; anything else stays as it is."""

    def character(code: Column) -> Column:
        known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")

    def one(part: Column) -> Column:
        def replaced(name: Column) -> Column:
            number = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2)))
            named = F.from_json(F.lit(_NAMED), "map<string,string>")[name]
            found = F.when(name.startswith("#"), let(number.try_cast("int"), character)).when(name != "", named)
            return F.coalesce(F.concat(found, F.substr(part, F.length(name) + 2)), F.concat(F.lit("&"), part))

        return let(F.regexp_extract(part, _REFERENCE, 1), replaced)

    def decoded(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), one)
        return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))

    return F.when(F.contains(text, F.lit("&")), let(F.split(text, "&"), decoded)).otherwise(text)


def _value(attributes: Column, name: str) -> Column:
    """Value of the last attribute of that name, NULL if there is none."""
    named = F.filter(attributes, lambda a: F.lower(F.regexp_extract(a, r"^[^\s=]+", 0)) == name.lower())
    right_side = F.regexp_replace(F.try_element_at(named, F.lit(-1)), r"^[^\s=]+\s*=?\s*", "")
    return decode_entities(F.regexp_replace(right_side, r"""(?s)^(["'])(.*)\1\z""", "$2"))


def html_attr(
    html: Column, tag: str, target: str, key: str | None = None, value: str | None = None
) -> Column:
    """``target`` of the first ``tag`` whose ``key`` equals ``value``; NULL if missing.

    Without ``key`` the first tag having ``target`` is used. Tag and attribute
    names ignore case, values do not, and entities in values are decoded.
    """
    start = rf"(?i)\A<{re.escape(tag)}(?=[\s/>])"
    tokens = F.filter(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), lambda t: t.rlike(start))
    tags = F.transform(tokens, lambda t: _attributes(F.substr(t, F.lit(len(tag) + 2))))
    if key is None:
        return F.get(F.filter(F.transform(tags, lambda t: _value(t, target)), lambda v: v.isNotNull()), F.lit(0))
    keyed = F.filter(tags, lambda t: F.coalesce(_value(t, key) == value, F.lit(False)))
    return let(F.get(keyed, F.lit(0)), lambda t: _value(t, target))


def form_token(html: Column) -> Column:
    """Anti-forgery token of a page: the meta tag, else the form field, else ``''``."""
    return F.coalesce(
        html_attr(html, "meta", "content", key="name", value="csrf-token"),
        html_attr(html, "input", "value", key="name", value="_csrf"),
        F.lit(""),
    )

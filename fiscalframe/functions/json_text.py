"""JSON texts that a strict parser refuses but a lenient reader understands: repeated keys and ``NaN``.

One ordered expression walks over strings, brackets and the rest, each match
starting where the one before ended, so nothing inside a string is taken for
syntax and every text is read once. Repeats are possessive: Java matches those
in a loop, and long texts need no stack.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscalframe.functions.text import let

#: Brackets within brackets that are looked through; deeper values are not understood.
DEPTH = 8
#: The same within an object that ``objects_with_last_values`` reads; the others are read another way.
SHALLOW = 3

_BLANK = r"[ \t\n\r]*+"
_STRING = r'"(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"'
# Literals that are no JSON but are often written.
_LITERALS = r"(?:-?Infinity|NaN)"


def _inside(depth: int) -> str:
    deeper = rf"|[\[{{]{_inside(depth - 1)}[\]}}]" if depth else ""
    return rf'(?:[^\[\]{{}}"]++|{_STRING}{deeper})*+'


_VALUE = rf'(?:{_STRING}|[\[{{]{_inside(DEPTH)}[\]}}]|[^ \t\n\r,:\[\]{{}}"]++)'
_ELEMENT = rf"(?s)\G{_BLANK}({_VALUE}){_BLANK}(?:,|\z)"
_PAIR = rf"(?s)\G{_BLANK}({_STRING}){_BLANK}:{_BLANK}({_VALUE}){_BLANK}(?:,|\z)"
# An array of objects whose text shows that nothing inside them can repeat a key: objects there have one pair or none.
_PLAIN = r'[^ \t\n\r,:\[\]{}"]++'


def _single(depth: int) -> str:
    value = rf"(?:{_STRING}|{_PLAIN}{_nested(depth - 1)})"
    return rf"(?:{_BLANK}{_STRING}{_BLANK}:{_BLANK}{value})?+{_BLANK}"


def _nested(depth: int) -> str:
    return rf"|\[(?:[^\[\]{{}}\x22]++|{_STRING}{_nested(depth - 1)})*+\]|\{{{_single(depth)}\}}" if depth else ""


_OBJECT = rf'\{{(?:[^\[\]{{}}"]++|{_STRING}{_nested(SHALLOW)})*+\}}'
_OBJECTS = rf"\A{_BLANK}\[(?:{_BLANK}{_OBJECT}{_BLANK},?+)*+{_BLANK}\]{_BLANK}\z"
_UP_TO_LITERAL = rf'(?s)\G((?:[^"NI-]++|{_STRING}|N(?!aN)|-(?!Infinity)|I(?!nfinity))*+){_LITERALS}'


def without_literals(text: Column) -> Column:
    """``NaN`` and ``Infinity`` outside strings become ``null``."""
    has = F.contains(text, F.lit("NaN")) | F.contains(text, F.lit("Infinity"))
    return F.when(has, F.regexp_replace(text, _UP_TO_LITERAL, "$1null")).otherwise(text)


def _body(text: Column, opening: str, closing: str) -> Column:
    """What stands between the brackets; NULL if the text does not start and end with them."""
    trimmed = F.btrim(text, F.lit(" \t\n\r"))
    cut = lambda t: F.when(F.startswith(t, F.lit(opening)) & F.endswith(t, F.lit(closing)), F.substr(t, F.lit(2), F.length(t) - 2))
    return let(trimmed, cut)


def _is_list_of(body: Column, pattern: str) -> Column:
    """The matches cover the text, and no comma stands at its end."""
    return (F.regexp_replace(F.btrim(body, F.lit(" \t\n\r")), pattern, "") == "") & ~body.rlike(r",[ \t\n\r]*\z")


def array_elements(text: Column) -> Column:
    """The elements of a JSON array as texts; NULL if it is none, as far as brackets, strings and commas tell."""

    def elements(body: Column) -> Column:
        return F.when(_is_list_of(body, _ELEMENT), F.regexp_extract_all(F.btrim(body, F.lit(" \t\n\r")), F.lit(_ELEMENT), F.lit(1)))

    return let(_body(text, "[", "]"), elements)


def objects_with_last_values(text: Column, fields: Sequence[str]) -> Column:
    """ARRAY of VARIANT objects with the given fields, each with the last value it has there, in one reading of a JSON array.

    NULL if the text is no array of objects, or not plain enough for that: an
    object further inside has more than one pair or lies deep, or letters of
    a key may be escaped. ``without_literals`` comes first.
    """
    schema = f"a array<struct<{','.join(f'{f}:variant' for f in fields)}>>, bad string"
    # All a lenient reader of Spark's takes and JSON does not have is off; ``bad`` tells what it passes over.
    strict = {"columnNameOfCorruptRecord": "bad", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "mode": "PERMISSIVE"}
    plain = ~(F.contains(text, F.lit("\\u")) & text.rlike(r"\\u00[3-7]")) & text.rlike(_OBJECTS)

    def objects(read: Column) -> Column:
        return F.when(read["bad"].isNull(), F.transform(read["a"], F.to_variant_object))

    return F.when(plain, let(F.from_json(F.concat(F.lit('{"a":'), text, F.lit("}")), schema, strict), objects))


def last_values(text: Column, fields: Sequence[str]) -> Column:
    """A JSON object again with the given fields only, each with the last value it has there.

    NULL if the text is no object, or one of its values is no JSON value.
    """

    def rebuilt(pairs: Column) -> Column:
        def value(name: Column) -> Column:
            at = F.array_position(pairs["keys"], name)
            return F.when(at > 0, F.concat(name, F.lit(":"), F.get(pairs["values"], (at - 1).cast("int"))))

        valid = F.forall(pairs["values"], lambda v: F.try_parse_json(v).isNotNull())
        kept = F.array_compact(F.transform(F.array(*[F.lit(f'"{f}"') for f in fields]), value))
        return F.when(valid, F.concat(F.lit("{"), F.array_join(kept, ","), F.lit("}")))

    def read(body: Column) -> Column:
        trimmed = F.btrim(body, F.lit(" \t\n\r"))
        # Backwards, so that the first one found is the last one written.
        found = [F.reverse(F.regexp_extract_all(trimmed, F.lit(_PAIR), F.lit(i))) for i in (1, 2)]
        pairs = F.struct(found[0].alias("keys"), found[1].alias("values"))
        return F.when(_is_list_of(body, _PAIR), let(pairs, rebuilt))

    return let(_body(text, "{", "}"), read)

"""White space, capture and binding helpers shared by the operators.

Every pattern runs with ``(?dU)``: ``d`` keeps ``\\n`` the only line end and
``U`` makes ``\\s \\w \\d`` follow Unicode, which the Azerbaijani labels need.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space and the four ASCII separators U+001C to U+001F, written out: Java looks up listed Latin
# characters in one table, and asks only others for their place; ``\s`` asks every character for its category.
_LATIN = r"\x09\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0"
_WIDE = r"[[\u1680-\u3000]&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
SPACE = rf"[\x0a{_LATIN}{_WIDE}]"
INLINE_SPACE = rf"[{_LATIN}{_WIDE}]"
# The same as a list of characters.
_CODE_POINTS = (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_SPACES = "".join(map(chr, _CODE_POINTS))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def runs(space: str) -> str:
    """Runs of a class of white space but single blanks: to replace those by a blank costs as much as any replacement."""
    return rf"{space}{{2,}}|[{space}&&[^\x20]]"


def strip(text: Column) -> Column:
    """Remove all white space at both ends (plain ``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(_SPACES))


def collapse(text: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(text, f"(?dU){runs(SPACE)}", " ")


def capture(text: Column, pattern: str, group: int = 1, flags: str = "dU") -> Column:
    """One group of the first match, ``''`` when there is none."""
    return F.regexp_extract(text, f"(?{flags}){pattern}", group)

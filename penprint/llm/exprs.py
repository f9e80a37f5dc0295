"""SQL expressions that several operators share."""

from __future__ import annotations

import re

#: White space that separates words: the six ASCII characters.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def quoted(name: str) -> str:
    """A column name as an SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string as an SQL literal, whatever it holds."""
    return "'" + re.sub(r"[^ -&(-\[\]-~]", lambda m: "".join(f"\\u{u:04x}" for u in _units(m[0])), text) + "'"


def _units(char: str) -> list[int]:
    raw = char.encode("utf-16-be")
    return [int.from_bytes(raw[i : i + 2], "big") for i in range(0, len(raw), 2)]


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once for a row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def words(text: str) -> str:
    """The words of a text: maximal runs of other than white space; null and empty give none."""
    trimmed = f"trim(BOTH {literal(SPACE)} FROM coalesce({text}, ''))"
    return let(trimmed, "_trim", f"if(_trim = '', array(), split(_trim, {literal(SPACE_CLASS + '+')}))")


def shifted(array: str, by: int, length: str) -> str:
    """``length`` elements of an array from the 0-based place ``by``; empty where length is not positive."""
    return f"slice({array}, {by + 1}, greatest({length}, 0))"

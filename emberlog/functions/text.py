"""Text helpers.

Helpers in ``functions`` take and return SQL expression text. A job that needs hundreds of small
expressions hands them to Spark in one ``selectExpr`` per step, which plans many times faster from
Python than as many Column calls; the resulting plan is the same.
"""

from __future__ import annotations

# Every character the message rules treat as surrounding whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def quote(value: str) -> str:
    """A SQL string literal."""
    return "'" + "".join(c if " " <= c <= "~" and c not in "'\\" else f"\\u{ord(c):04x}" for c in value) + "'"


def quote_list(values) -> str:
    return ", ".join(quote(v) for v in values)


def is_printable(text: str) -> str:
    """Nothing but printable ASCII."""
    return f"NOT ({text} RLIKE '[^ -~]')"


def strip(text: str, plain: str | None = None) -> str:
    """Remove whitespace of every kind from both ends (``trim`` removes spaces only).

    Text of printable ASCII, nearly all of it, has no whitespace but spaces, and searching the full
    list is many times slower than ``trim``. ``plain`` is a known condition for such text.
    """
    return f"CASE WHEN {plain or is_printable(text)} THEN trim({text}) ELSE btrim({text}, {quote(WHITESPACE)}) END"


def is_blank(text: str, plain: str | None = None) -> str:
    """Empty or nothing but whitespace; FALSE for NULL. A visible first character settles it."""
    return f"CASE WHEN ascii({text}) BETWEEN 33 AND 126 THEN false ELSE coalesce({strip(text, plain)} = '', false) END"


def blank_to_null(text: str, plain: str | None = None) -> str:
    """Strip, and turn an empty result into NULL."""
    return f"nullif({strip(text, plain)}, '')"


def space_blank_to_null(text: str) -> str:
    """Like ``blank_to_null`` for spaces only."""
    return f"nullif(trim({text}), '')"

"""Reading fields of a JSON message (SQL expression text).

Three states of a field matter and must not be mixed up: absent, JSON null, and a value, and for
numbers and booleans also the JSON type. Ordinary messages need only the text of each field, which
one ``from_json`` delivers. The message is parsed again into VARIANT fields (``odd``) only where the
texts leave a question open: a field without text, a text that reads like a boolean, a number or
time that does not parse, a closing bracket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .text import is_blank, strip

JSON_OPTIONS = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"
# A message is one JSON value and nothing after it, which Spark's JSON functions do not insist on.
# Inside brackets, anything that follows the value breaks the array or adds an element, unless the
# text closes the bracket itself; inside an object that breaks too. Only a text with a closing
# bracket needs both.
BRACKETED = "concat('[', raw_text, ']')"
IS_JSON = (
    f"(coalesce(size(try_variant_get(try_parse_json({BRACKETED}), '$', 'array<variant>')) = 1, false) "
    "AND try_parse_json(concat('{\"a\":', raw_text, '}')) IS NOT NULL)"
)


# JSON text with an object at its root; JSON whitespace is these four characters
IS_OBJECT = "(startswith(raw_text, '{') OR startswith(trim(LEADING ' \\t\\n\\r' FROM raw_text), '{'))"


def once(df: DataFrame, *columns: str) -> DataFrame:
    """Add columns (expression text with aliases) through a one-element generator.

    A later filter on the added columns cannot be pushed below the generator, so the (expensive)
    expressions behind them run once per row and not again inside the filter. Spark interprets what stands inside a
    generator, so the expressions are computed (compiled) before it and only pass through.
    """
    names = [f"_once_{k}" for k in range(len(columns))]
    pairs = [column.rsplit(" AS ", 1) for column in columns]
    ready = df.selectExpr("*", *[f"{pair[0]} AS {name}" for pair, name in zip(pairs, names, strict=True)])
    passed = ", ".join(f"{name} AS {pair[-1]}" for pair, name in zip(pairs, names, strict=True))
    return ready.selectExpr(*[f"`{c}`" for c in df.columns], f"inline(array(struct({passed})))")


def with_text(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``raw_text``: bytes with broken UTF-8 replaced; a missing body reads as ``None``.

    ``plain``: no field of the message can hold whitespace other than spaces. Valid JSON has no raw
    control characters inside texts, so only escapes and characters beyond ASCII matter.
    """
    binary = dict(df.dtypes)[value] == "binary"
    text = f"make_valid_utf8(cast(`{value}` AS string))" if binary else f"`{value}`"
    return df.selectExpr("*", f"coalesce({text}, 'None') AS raw_text").selectExpr(
        "*", r"NOT contains(raw_text, '\\') AND octet_length(raw_text) = char_length(raw_text) AS plain"
    )


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``payload_kind``: ``object``, ``other`` JSON or ``bad_json``."""
    root = f"CASE WHEN {IS_OBJECT} THEN 'object' ELSE 'other' END"
    return with_text(df, value).selectExpr("*", f"CASE WHEN {IS_JSON} THEN {root} ELSE 'bad_json' END AS payload_kind")


def read(df: DataFrame, value: str, fields, derived: dict[str, str], doubts: str, optional=()) -> DataFrame:
    """Add ``text_<field>`` for all fields, the ``derived`` columns, ``payload_kind`` and ``odd``.

    ``derived`` are expressions over the texts; ``doubts`` is a condition over texts and derived
    columns that asks for the second look, besides any field without text.
    """
    names = [*fields, *optional]
    schema = "array<struct<" + ", ".join(f"{n}: string" for n in names) + ">>"
    parsed = with_text(df, value).selectExpr("*", f"from_json({BRACKETED}, '{schema}', {JSON_OPTIONS}) AS fields")
    keep = [c for c in parsed.columns if c != "fields"]
    texts = parsed.selectExpr(*keep, *[f"CASE WHEN size(fields) = 1 THEN fields[0].{n} END AS text_{n}" for n in names])
    unclear = " OR ".join([*[f"text_{n} IS NULL" for n in fields], doubts, "contains(raw_text, ']')"])
    looked = texts.selectExpr("*", *[f"{sql} AS {name}" for name, sql in derived.items()]).selectExpr(
        "*", f"CASE WHEN {unclear} THEN {IS_JSON} END AS checked_json"
    )
    # checked_json: NULL when nothing is in doubt, otherwise whether the text is JSON at all
    return looked.selectExpr(
        "*",
        "CASE WHEN NOT checked_json THEN 'bad_json' "
        f"WHEN checked_json AND NOT {IS_OBJECT} THEN 'other' ELSE 'object' END AS payload_kind",
        f"CASE WHEN checked_json AND {IS_OBJECT} "
        "THEN try_cast(try_parse_json(raw_text) AS map<string,variant>) END AS odd",
    )


def kind(name: str) -> str:
    """Type name of a field looked at twice: STRING, BIGINT, BOOLEAN, VOID for JSON null."""
    return f"schema_of_variant(try_element_at(odd, '{name}'))"


def is_absent(name: str) -> str:
    return f"(text_{name} IS NULL AND NOT coalesce(map_contains_key(odd, '{name}'), false))"


def is_null(name: str) -> str:
    """Absent or JSON null."""
    return f"(text_{name} IS NULL AND coalesce({kind(name)} = 'VOID', true))"


def is_empty_text(name: str) -> str:
    return f"({is_blank('text_' + name, 'plain')})"


def reads_boolean(*names: str) -> str:
    return "(" + " OR ".join(f"text_{n} IN ('true', 'false')" for n in names) + ")"


def spelled(name: str) -> str:
    """Stripped text of any present field as the message rules spell it: ``None``, ``True``."""
    text = f"text_{name}"
    value = (
        f"CASE WHEN odd IS NULL THEN {text} "
        f"WHEN {text} IS NULL THEN coalesce(nullif(to_json(try_element_at(odd, '{name}')), 'null'), 'None') "
        f"WHEN {text} IN ('true', 'false') AND {kind(name)} = 'BOOLEAN' THEN initcap({text}) ELSE {text} END"
    )
    return strip(f"({value})", "plain")


def integral_text(name: str) -> str:
    return f"try_cast({strip('text_' + name, 'plain')} AS bigint)"


def whole_number(name: str, parsed: str) -> str:
    """Integer of a field: the parsed integral text, else a number cut towards zero, else NULL."""
    value = f"try_element_at(odd, '{name}')"
    return (
        f"coalesce({parsed}, CASE WHEN {kind(name)} RLIKE '^(DECIMAL|DOUBLE|FLOAT|BIGINT)' "
        f"THEN try_variant_get({value}, '$', 'bigint') END)"
    )

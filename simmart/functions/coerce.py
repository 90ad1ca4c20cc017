"""Lax coercion of JSON leaves, with a reason for each leaf that will not fit.

The leaves of a record are read as VARIANT, which keeps their JSON type, so
that a number offered for a text field can be told from a text. Expressions
are SQL text: a record has dozens of leaves, and text is parsed in one call.
"""

from __future__ import annotations

from dataclasses import dataclass

from simmart.functions.text import WHITE_SPACE

# Texts accepted as booleans, upper or lower case.
TRUE_TEXT = ["1", "on", "t", "true", "y", "yes"]
FALSE_TEXT = ["0", "off", "f", "false", "n", "no"]

NUMBER_TEXT = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\z"

# The first two letters of a variant's type name tell its kind.
STRING, BOOLEAN, NULL = "ST", "BO", "VO"
NUMBERS = ["BI", "DE", "DO", "FL"]


@dataclass(frozen=True)
class Field:
    """One leaf: its name, Spark type, and whether it may be null or absent."""

    name: str
    dtype: str
    nullable: bool = True
    may_be_absent: bool = True


def json_schema(fields: list[Field]) -> list[str]:
    """Field names with VARIANT as the type of each."""
    return [f"{f.name} variant" for f in fields]


def leaf_text(value: str) -> str:
    return f"try_variant_get({value}, '$', 'string')"


def leaf_kind(value: str) -> str:
    """Kind of a variant leaf; null where the key is absent."""
    return f"left(schema_of_variant({value}), 2)"


def _any_of(texts: list[str]) -> str:
    return "(" + ", ".join(f"'{t}'" for t in texts) + ")"


def coerce(text: str, kind: str, dtype: str) -> str:
    """The leaf as ``dtype``, null when it does not fit."""
    number, boolean, string = f"{kind} IN {_any_of(NUMBERS)}", f"{kind} = '{BOOLEAN}'", f"{kind} = '{STRING}'"
    clean = f"trim(BOTH '{WHITE_SPACE}' FROM {text})"
    if dtype == "string":
        return f"CASE WHEN {string} THEN {text} END"
    if dtype == "double":
        return f"""CASE WHEN {boolean} THEN cast({text} = 'true' AS double)
            WHEN ({number} OR {string}) AND {clean} RLIKE r'{NUMBER_TEXT}' THEN try_cast({clean} AS double) END"""
    if dtype == "bigint":
        exact = f"try_cast({clean} AS decimal(38, 9))"
        return f"""CASE WHEN {boolean} THEN cast({text} = 'true' AS bigint)
            WHEN ({number} OR {string}) AND {exact} = floor({exact}) THEN try_cast({exact} AS bigint) END"""
    if dtype == "boolean":
        return f"""CASE WHEN {boolean} THEN {text} = 'true'
            WHEN {number} AND try_cast({text} AS double) IN (0, 1) THEN try_cast({text} AS double) = 1
            WHEN {string} AND lower({clean}) IN {_any_of(TRUE_TEXT)} THEN true
            WHEN {string} AND lower({clean}) IN {_any_of(FALSE_TEXT)} THEN false END"""
    raise ValueError(f"no coercion to {dtype}")


def fault(value: str, kind: str, field: Field, label: str) -> str:
    """Why a leaf does not do; null when it is fine."""
    cases = [f"WHEN {value} IS NULL AND {kind} <> '{NULL}' THEN '{label}: not a {field.dtype}'"]
    if not field.may_be_absent:
        cases.append(f"WHEN {kind} IS NULL THEN '{label}: absent'")
    if not field.nullable:
        cases.append(f"WHEN {kind} = '{NULL}' THEN '{label}: required'")
    return f"CASE {' '.join(cases)} END"

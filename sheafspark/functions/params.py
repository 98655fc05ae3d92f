"""Typed values for the named parameters of measure expressions."""

import re
from decimal import Decimal

# The accepted parameter types, and the texts of the two booleans.
PARAMETER_TYPES = ["string", "code", "date", "dateTime", "boolean", "integer", "decimal"]
TRUE_TEXTS = ["1", "t", "T", "TRUE", "true", "True"]
FALSE_TEXTS = ["0", "f", "F", "FALSE", "false", "False"]


def typed_param(name: str, type: str | None, value: str):
    """Python value of one parameter text; the type defaults to string, dates stay text."""
    type = type or "string"
    if type in ("string", "code", "date", "dateTime"):
        return value
    if type == "boolean":
        if value not in TRUE_TEXTS + FALSE_TEXTS:
            raise ValueError(f"invalid boolean value `{value}` for parameter `{name}`")
        return value in TRUE_TEXTS
    if type == "integer":
        if not re.fullmatch(r"[+-]?[0-9]+", value) or not -(2**63) <= int(value) < 2**63:
            raise ValueError(f"invalid integer value `{value}` for parameter `{name}`")
        return int(value)
    if type == "decimal":
        if not re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", value):
            raise ValueError(f"invalid decimal value `{value}` for parameter `{name}`")
        return Decimal(value)
    raise ValueError(
        f"unsupported type `{type}` for parameter `{name}` (supported types: {', '.join(PARAMETER_TYPES)})"
    )


def typed_params(params: dict) -> dict:
    """``{name: (type, value or list of values)}`` as named SQL arguments; a list becomes an array."""
    typed = {}
    for name, (type, value) in params.items():
        if isinstance(value, (list, tuple)):
            typed[name] = [typed_param(name, type, v) for v in value]
        else:
            typed[name] = typed_param(name, type, value)
    return typed

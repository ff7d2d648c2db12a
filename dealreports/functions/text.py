"""Names and values as SQL text.

Wide tables are described in SQL expressions: one expression per column instead of a chain of calls.
"""

from collections.abc import Iterable


def quoted(name: str) -> str:
    """A column name that may hold spaces, dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(literal(v) for v in values) + ")"


def field(group: str, name: str) -> str:
    """A field of a struct column of the flat table."""
    return f"{group}.{quoted(name)}"

"""Checks on text that is pushed to a source database or used as a table name."""

from __future__ import annotations

import datetime as dt
import decimal
import re
from collections.abc import Mapping
from typing import Any


class RefusedQuery(ValueError):
    """A pushed query that is not one read-only statement."""


# For each dialect the words a query may start with, and the words it may not hold.
WRITES = "insert update delete merge truncate create alter drop grant revoke call"
DIALECTS = {
    "postgres": (("select", "with"), f"{WRITES} copy vacuum analyze comment".split()),
    "sqlserver": (("select", "with"), f"{WRITES} exec execute backup restore dbcc".split()),
    "snowflake": (("select",), []),
}
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]*"


def check_select(query: str, dialect: str = "postgres") -> str:
    """The query without its closing semicolon, or RefusedQuery.

    It is a precaution only, as it also refuses harmless text that holds a refused word or a semicolon; rights on the source
    must still be read-only. The snowflake dialect takes a query that starts with SELECT; outside quotes it may hold no
    semicolon, and no word is refused.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"no rules for the dialect {dialect!r}; there are {sorted(DIALECTS)}")
    heads, refused = DIALECTS[dialect]
    body = (query or "").strip().removesuffix(";").rstrip()
    words = set(re.findall(r"\w+", body.lower()))
    bare = re.sub(QUOTED, "", body) if dialect == "snowflake" else body
    objections = {
        "there is no statement in it": not body,
        f"it starts with none of {', '.join(heads)}": not body.lower().startswith(heads),
        "a semicolon stands inside it": ";" in bare,
        f"it holds {', '.join(sorted(words.intersection(refused)))}": not words.isdisjoint(refused),
    }
    for why, holds in objections.items():
        if holds:
            raise RefusedQuery(f"the query is not pushed: {why}")
    return body


def check_identifier(name: str) -> str:
    if not re.fullmatch(IDENTIFIER, name or ""):
        raise ValueError(f"{name!r} is no plain identifier: letters, digits and _ only, and no digit first")
    return name


def sql_literal(value: Any, dialect: str = "postgres") -> str:
    """A Python value as a typed SQL literal of the dialect."""
    transact = dialect == "sqlserver"
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(int(value)) if transact else str(value).upper()
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        if value != value or value in (float("inf"), float("-inf")):
            raise ValueError("NaN and infinity have no SQL literal")
        return repr(value)
    if isinstance(value, dt.datetime):
        text = value.isoformat(sep=" ")
        return f"CAST('{text}' AS DATETIME2)" if transact else f"TIMESTAMP '{text}'"
    if isinstance(value, dt.date):
        return f"CAST('{value.isoformat()}' AS DATE)" if transact else f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        if dialect == "snowflake":
            value = value.replace("\\", "\\\\")  # a backslash is an escape inside its quotes
        return ("N'" if transact else "'") + value.replace("'", "''") + "'"
    if isinstance(value, (list, tuple)):
        return "(" + ", ".join(sql_literal(v, dialect) for v in value) + ")"
    raise TypeError(f"No SQL literal for {type(value)}")


# Quoted text, quoted names, casts, parameters, brackets and words of a query.
QUOTED = r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\""
TOKENS = rf"{QUOTED}|::|:(?P<name>{IDENTIFIER})|[()]|{IDENTIFIER}"


def bind_parameters(query: str, params: Mapping[str, Any] | None, dialect: str = "postgres") -> str:
    """The query with every `:name` outside quotes, and outside `::type` casts, replaced by a literal."""
    params = dict(params or {})
    used: set[str] = set()

    def place(match: re.Match) -> str:
        name = match.group("name")
        if name is None:
            return match.group(0)
        if name not in params:
            raise ValueError(f"No value for parameter :{name}")
        used.add(name)
        return sql_literal(params[name], dialect)

    bound = re.sub(TOKENS, place, query)
    unused = set(params) - used
    if unused:
        raise ValueError(f"Parameters not used in the query: {sorted(unused)}")
    return bound


def split_with(query: str) -> tuple[str, str]:
    """The WITH part of a query and the SELECT that follows it; the first is empty without WITH."""
    if not query.lower().startswith("with"):
        return "", query
    depth = 0
    for token in re.finditer(TOKENS, query):
        depth += {"(": 1, ")": -1}.get(token.group(0), 0)
        if depth == 0 and token.group(0).lower() == "select":
            return query[: token.start()].rstrip(), query[token.start() :]
    raise RefusedQuery("no SELECT follows the WITH part")

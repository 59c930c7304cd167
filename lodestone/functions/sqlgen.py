"""INSERT statements from column names.

Table names and already quoted columns are taken verbatim; never pass them from
untrusted input.
"""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names that need no quotes: letters and numbers of any script, marks that belong to letters, and @ $ # _.
PLAIN = r"(?U)^[\p{Alpha}\p{N}@$#_]*$"
_PLAIN = regex.compile(r"[\p{Alphabetic}\p{N}@$#_]*")
QUOTED = r'(?s)^(".*"|\[.*\]|`.*`|")$'


def quoted(name: str) -> str:
    plain = _PLAIN.fullmatch(name)
    wrapped = any(name.startswith(a) and name.endswith(b) for a, b in ('""', "[]", "``"))
    return name if plain or wrapped else f'"{name}"'


def quoted_column(name: Column) -> Column:
    """The same for a column of names."""
    return F.when(name.rlike(PLAIN) | name.rlike(QUOTED), name).otherwise(F.concat(F.lit('"'), name, F.lit('"')))


#: Placeholders by the styles of Python's database interface; k counts from 1.
MARKS = {"qmark": "?", "format": "%s", "numeric": ":{k}", "named": ":{name}", "pyformat": "%({name})s"}


def insert_statement(table: str, schema: T.StructType | list[str], style: str = "qmark") -> str:
    names = schema.names if isinstance(schema, T.StructType) else schema
    marks = ", ".join(MARKS[style].format(k=k, name=n) for k, n in enumerate(names, 1))
    return f"INSERT INTO {table} ({', '.join(map(quoted, names))}) VALUES ({marks})"


_OTHER = r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|--[^\n]*|(?s:/\*.*?\*/)"
_FOUND = {"qmark": r"\?", "format": r"%%|%s", "numeric": r"(?<!:):\d+", "named": r"(?<!:):[^\W\d]\w*", "pyformat": r"%%|%\(([^)]*)\)s"}


def placeholders(statement: str, style: str) -> list[str]:
    """The placeholders of a statement, each once if it has a name or number; none in quotes or comments."""
    found = [m.group(0) for m in regex.finditer(f"{_OTHER}|{_FOUND[style]}", statement) if regex.fullmatch(_FOUND[style], m.group(0)) and m.group(0) != "%%"]
    return found if style in ("qmark", "format") else list(dict.fromkeys(found))


def insert_statement_column(table: Column, names: Column) -> Column:
    """The same for a column of tables and one of arrays of column names."""
    marks = F.array_join(F.transform(names, lambda _: F.lit("?")), ", ")
    return F.concat(F.lit("INSERT INTO "), table, F.lit(" ("), F.array_join(F.transform(names, quoted_column), ", "), F.lit(") VALUES ("), marks, F.lit(")"))

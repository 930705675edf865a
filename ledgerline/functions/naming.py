"""Column-name handling.  Names are driver-side metadata; renaming is free."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_WORD = re.compile("[a-z0-9]+")


def snake_case(name: str) -> str:
    """The lower-cased ASCII words and numbers of a name, joined by ``_``."""
    return "_".join(_WORD.findall(name.lower()))


def standard_name(raw: str, aliases: dict[str, str] | None = None) -> str:
    """Alias of the (trimmed) raw name if one exists, else its snake case."""
    return (aliases or {}).get(raw.strip(), snake_case(raw))


# What the second naming strategy puts for single characters.
REPLACEMENTS = str.maketrans({" ": "_", "%": "pct", "-": "_"})


def replacement_name(raw: str, renames: dict[str, str] | None = None) -> str:
    """Second naming strategy: characters replaced one by one, then renamed."""
    translated = raw.strip().lower().translate(REPLACEMENTS)
    return renames[translated] if renames and translated in renames else translated


def standardize(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Rename every column to its standard name in one projection."""
    mapping = {c: standard_name(c, aliases) for c in df.columns}
    targets = list(mapping.values())
    clashes = sorted({t for t in targets if targets.count(t) > 1})
    if clashes:
        raise ValueError(f"Columns collide after renaming: {clashes}")
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k != v})


def check_columns(columns: list[str], required: list[str]) -> tuple[list[str], list[str]]:
    """(missing, extra) relative to the required list, by trimmed names."""
    present = {c.strip() for c in columns}
    wanted = {c.strip() for c in required}
    return [c for c in required if c.strip() not in present], [c for c in columns if c.strip() not in wanted]


def require_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Raise on missing required columns; return the extra ones."""
    missing, extra = check_columns(df.columns, required)
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return extra

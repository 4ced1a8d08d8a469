"""Column-name rules."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_key_column(key: Column) -> Column:
    """Attribute key to column suffix: no colons, spaces to underscores, lower case, stripped."""
    return F.regexp_replace(F.lower(F.translate(key, " :", "_")), r"^\s+|\s+\z", "")


def match_columns(
    df: DataFrame,
    prefix: str | None = None,
    regex: str | None = None,
    negate: bool = False,
) -> list[str]:
    """Names of ``df`` that match a prefix and/or a regex (or, negated, those that do not)."""

    def hit(name: str) -> bool:
        return (prefix is None or name.startswith(prefix)) and (
            regex is None or re.search(regex, name) is not None
        )

    return [name for name in df.columns if hit(name) != negate]


def quoted(name: str) -> str:
    """A name as a column reference, also when it holds dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def columns(names: Iterable[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]

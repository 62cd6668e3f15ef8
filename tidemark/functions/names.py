"""Column and key names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


# Where a word of a camelCase name begins.
WORD_START, CAPITAL = r"(.)([A-Z][a-z]+)", r"([a-z0-9])([A-Z])"


def snake(name: str) -> str:
    """camelCase or PascalCase to snake_case; runs of capitals stay one word."""
    return re.sub(CAPITAL, r"\1_\2", re.sub(WORD_START, r"\1_\2", name)).lower()


def snake_column(c: Column) -> Column:
    """``snake`` on a text column (map keys)."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, WORD_START, "$1_$2"), CAPITAL, "$1_$2"))


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w.capitalize() for w in rest)


def sanitize(raw: str | None, index: int) -> str:
    """A sheet header as a column name: its runs of letters and digits, joined by underscores; without any it is numbered."""
    return "_".join(re.findall("[a-zA-Z0-9]+", raw or "")) or f"_col{index}"


def report_header(raw: str) -> str:
    """A report header as a column name: lower case, blanks to underscores, no byte-order mark."""
    return raw.lstrip("﻿").strip().lower().replace(" ", "_")

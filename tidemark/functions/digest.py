"""Canonical row hashes that two engines or two runs can agree on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_digest(cols: list[str]) -> Column:
    """SHA-256 of the row as JSON with sorted keys; nulls are written, not dropped."""
    body = F.struct(*[F.col(c) for c in sorted(cols)])
    return F.sha2(F.to_json(body, {"ignoreNullFields": "false"}), 256)


def key_json(cols: list[str]) -> Column:
    """The key columns as canonical JSON text."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(cols)]), {"ignoreNullFields": "false"})


def text_digest(parts: list[Column], sep: str = "|") -> Column:
    """SHA-256 of already formatted texts; a null part is the empty text."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(p, F.lit("")) for p in parts]), 256)

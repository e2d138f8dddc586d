"""Byte codecs for cell values (FN-1, FN-2, FN-3), as JVM-side Column
expressions so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.sources.common import col_of


def long_to_bytes(n) -> Column:
    """FN-2: 8-byte big-endian two's-complement encoding of a BIGINT.
    ``hex`` of a negative long is already its 16-digit two's complement."""
    return F.unhex(F.lpad(F.hex(col_of(n).cast("bigint")), 16, "0"))


def long_to_hex(n) -> Column:
    """Upper-case hex of :func:`long_to_bytes` (readable form of the cell)."""
    return F.lpad(F.hex(col_of(n).cast("bigint")), 16, "0")


def bytes_to_long(b) -> Column:
    """FN-1: first 8 bytes, big-endian, signed. Shorter values are NULL:
    decoding the text ``"100"`` as hex digits would give a wrong number
    silently, so the length guard is part of the function."""
    b = col_of(b)
    return F.when(
        F.octet_length(b) >= 8,
        F.conv(F.hex(F.substring(b, 1, 8)), 16, -10).cast("bigint"),
    )


def to_utf8(s) -> Column:
    """FN-3: string -> bytes."""
    return F.encode(col_of(s), "UTF-8")


def from_utf8(b) -> Column:
    """FN-3: bytes -> string."""
    return F.decode(col_of(b), "UTF-8")

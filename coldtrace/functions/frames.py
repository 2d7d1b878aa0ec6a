"""Header fields of base64 message frames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _byte(payload: Column, position: int) -> Column:
    """Unsigned value of the byte at `position` (from 0), NULL beyond the end."""
    digits = F.hex(F.substring(F.unbase64(payload), position + 1, 1))
    return F.conv(F.nullif(digits, F.lit("")), 16, 10).cast("int")


def message_type(payload: Column) -> Column:
    """Byte 1 without its top bit."""
    return _byte(payload, 1).bitwiseAND(F.lit(0x7F))


def message_id(payload: Column) -> Column:
    """Bytes 6 and 7, little-endian."""
    return _byte(payload, 6) + _byte(payload, 7) * 256


def status(payload: Column) -> Column:
    """Byte 2: zero is OK, anything else NG."""
    return F.when(_byte(payload, 2) == 0, "OK").otherwise("NG")

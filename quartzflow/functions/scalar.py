"""Scalar expressions."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT_LIMIT = "922337203685.4775807"


def safe_ratio(a: Column, b: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(default))


def valid_amount(c: Column) -> Column:
    """Within the ledger's range and of at most seven places."""
    return F.coalesce(F.abs(c) <= F.lit(AMOUNT_LIMIT).cast("decimal(19,7)"), F.lit(False)) & (c == c.cast("decimal(38,7)"))


def stroops(c: Column) -> Column:
    """Ten-millionths of the unit, as a whole number."""
    return (c.cast("decimal(19,7)") * F.lit(10**7).cast("decimal(8,0)")).cast("decimal(26,0)")


def quantize(c: Column, places: int = 7) -> Column:
    """Half to even."""
    return F.bround(c, places)


def pseudonym(c: Column, key: bytes) -> Column:
    """``anon_`` and 32 hex digits of the HMAC-SHA256 of the value, which no one without the key can enumerate."""
    if not key:
        raise ValueError("a pseudonym needs a key")
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    inner, outer = (bytearray(x ^ y for x in key.ljust(64, b"\0")) for y in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(F.lit(inner), F.encode(c, "UTF-8")), 256))
    return F.concat(F.lit("anon_"), F.substring(F.sha2(F.concat(F.lit(outer), first), 256), 1, 32))


def masked(c: Column, shown: int = 4) -> Column:
    """All but the last signs hidden; short values wholly."""
    n = F.length(c)
    return F.when(n <= shown, F.repeat(F.lit("*"), n)).otherwise(F.concat(F.repeat(F.lit("*"), n - shown), F.right(c, F.lit(shown))))


def generalised(c: Column, size: float) -> Column:
    """Label of the half-open interval a number falls into."""
    lo = F.floor(c / size) * size
    return F.concat(F.lit("["), lo.cast("string"), F.lit(", "), (lo + size).cast("string"), F.lit(")"))


def row_hash(columns: Sequence[str]) -> Column:
    """Hash of a row's content in a canonical form."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def sanitised(c: Column) -> Column:
    """Without null bytes and leading signs that spreadsheets take for formulas."""
    return F.regexp_replace(F.replace(c, F.lit("\0"), F.lit("")), r"^[=+\-@\t\r]+", "")


def laplace_scale(sensitivity: float, epsilon: float) -> float:
    return sensitivity / epsilon


def gaussian_sigma(sensitivity: float, epsilon: float, delta: float) -> float:
    import math

    return sensitivity * math.sqrt(2 * math.log(1.25 / delta)) / epsilon

"""Kafka Connect ``Decimal`` values: base64 of the big-endian two's-complement
bytes of the unscaled integer. Decoded and encoded with built-in functions
only, so the work stays in generated code.

Any number of bytes is read: sign extension is dropped, and what remains is
added up from two halves of 64 bits, so every value of up to 38 digits with
its scale decodes.
Text that is no such value gives null; callers tell it from an absent value
by the text itself (:mod:`medallion.operators.changes` rejects such rows).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = "0123456789ABCDEF"
_HALF = 16  # hex digits of a 64-bit half


def decode_connect_decimal(b64: Column, precision: int = 10, scale: int = 2) -> Column:
    hexed = F.hex(F.try_to_binary(b64, F.lit("base64")))
    negative = F.substring(hexed, 1, 1) >= F.lit("8")
    # two's complement: -x - 1 has the inverted bits of x
    bits = F.when(negative, F.translate(hexed, _DIGITS, _DIGITS[::-1])).otherwise(hexed)
    wide = F.concat(F.lit("0" * 2 * _HALF), bits)
    high, low = (F.conv(F.substring(wide, at, _HALF), 16, 10).cast("decimal(38,0)") for at in (-2 * _HALF, -_HALF))
    size = F.try_add(F.try_multiply(high, F.lit(str(2**64)).cast("decimal(20,0)")), low)
    sign, rest = F.when(negative, -1).otherwise(1), F.when(negative, -1).otherwise(0)
    number = F.try_add(F.try_multiply(size, sign.cast("decimal(1,0)")), rest.cast("decimal(1,0)"))
    value = F.try_multiply(number, F.lit(10.0**-scale).cast(f"decimal({scale + 1},{scale})")) if scale else number
    fits = hexed.rlike("^(0*|F*)[0-9A-F]{1,32}$")
    return F.when(fits, value.try_cast(f"decimal({precision},{scale})"))


def encode_connect_decimal(value: Column, scale: int = 2) -> Column:
    """Inverse of :func:`decode_connect_decimal` (minimal two's-complement bytes)."""
    unscaled = (value * F.lit(10 ** scale)).cast("long")
    h = F.hex(unscaled)
    h = F.when(F.length(h) % 2 == 1, F.concat(F.lit("0"), h)).otherwise(h)
    positive_pad = F.when((unscaled >= 0) & (F.substring(h, 1, 1) >= F.lit("8")), F.concat(F.lit("00"), h))
    negative_trim = F.when(unscaled < 0, F.regexp_replace(h, r"^(FF)+(?=[89A-F])", ""))
    h = F.coalesce(positive_pad, negative_trim, h)
    return F.base64(F.unhex(h))

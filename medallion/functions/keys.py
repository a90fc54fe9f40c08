"""Data Vault hash keys (K1-K3) as Column expressions, evaluated in codegen."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, so that keys agree with tables that exist already:
#   null part token: ^^NULL^^
#   part separator:  ||
#   digest:          SHA-256, lower-case hex
NULL_TOKEN = "^^NULL^^"
SEPARATOR = "||"


def _digest(parts: Iterable[Column | str], normal: Callable[[Column], Column]) -> Column:
    """Digest of the parts' texts in ``normal`` form, nulls as the token."""
    texts = [normal((F.col(p) if isinstance(p, str) else p).cast("string")) for p in parts]
    return F.sha2(F.array_join(F.array(*texts), SEPARATOR, NULL_TOKEN), 256)


def business_key(*parts: Column | str) -> Column:
    """Key of an entity: case and outer spaces of its business key don't matter."""
    return _digest(parts, lambda text: F.upper(F.trim(text)))


def attribute_hash(*parts: Column | str) -> Column:
    """Hashdiff of an entity's attributes: every character and the order matter."""
    return _digest(parts, lambda text: text)

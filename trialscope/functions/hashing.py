"""Deterministic draws from identifiers of any type, the same in every engine that knows md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(identifier: Column, salt: Column | str, modulus: int) -> Column:
    """A number below ``modulus`` from the first 32 bits of md5 of ``salt:identifier``.

    Draws with different salts are independent of each other.
    """
    salt = F.lit(salt) if isinstance(salt, str) else salt
    digest = F.md5(F.concat_ws(":", salt, identifier.cast("string")).cast("binary"))
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.when(identifier.isNotNull(), F.pmod(head, F.lit(modulus)))

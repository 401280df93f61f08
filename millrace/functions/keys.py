"""Content-hash identities, seeds and hash buckets as column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(text: Column | str) -> Column:
    """The first 16 hexadecimal digits of the text's MD5: equal texts, equal ids."""
    return F.substring(F.md5(F.col(text) if isinstance(text, str) else text), 1, 16)


def row_id(text: Column | str, existing: Column | str) -> Column:
    """The trimmed existing id, or content_id where that is null, blank or the text `nan`."""
    given = F.trim((F.col(existing) if isinstance(existing, str) else existing).cast("string"))
    return F.when(given.isNull() | (given == "") | (F.lower(given) == "nan"), content_id(text)).otherwise(given)


def stable_seed(*parts: Column) -> Column:
    """An unsigned 64-bit seed, as decimal(20,0): the first 16 hexadecimal digits of SHA-256 over the parts, joined by `::`."""
    return F.conv(F.substring(F.sha2(F.concat_ws("::", *parts), 256), 1, 16), 16, 10).cast("decimal(20,0)")


def seed_of(*parts: object) -> int:
    """stable_seed on the driver or inside a Python worker."""
    return int.from_bytes(hashlib.sha256("::".join(map(str, parts)).encode()).digest()[:8], "big")


def hash_bucket(n: int, *parts: Column) -> Column:
    """SHA-256 of the parts, joined by `:`, modulo n, as a whole 256-bit number: 7 digits at a time keep every step in 64 bits."""
    digest = F.concat(F.lit("0" * 6), F.sha2(F.concat_ws(":", *parts), 256))
    pieces = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.conv(F.substr(digest, k * 7 + 1, F.lit(7)), 16, 10).cast("bigint"))
    return F.aggregate(pieces, F.lit(0).cast("bigint"), lambda held, piece: (held * (1 << 28) + piece) % n).cast("int")

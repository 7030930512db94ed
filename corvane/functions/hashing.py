"""Deterministic draws: every pick is a hash of stable strings.

The recipes differ on purpose (width, prefix, joiner); results must equal those
of data that was drawn with them before, so they are not unified.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_64, TWO_52 = 18446744073709551616.0, 4503599627370496.0


def digest(*parts: Column | str | int, sep: str = "\0") -> Column:
    """SHA-256 (hex) of the parts joined by ``sep``; plain values are literals."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.sha2(F.concat_ws(sep, *[c.cast("string") for c in cols]), 256)


def hex_value(hexes: Column) -> Column:
    """Up to 16 hex digits as an exact unsigned decimal."""
    return F.conv(hexes, 16, 10).cast("decimal(20,0)")


def stable_unit(*parts: Column | str | int) -> Column:
    """U[0, 1) from the first 8 bytes."""
    return hex_value(F.substring(digest(*parts), 1, 16)).cast("double") / F.lit(TWO_64)


def unit_52(*parts: Column | str | int) -> Column:
    """U[0, 1) from the first 13 hex digits."""
    return hex_value(F.substring(digest(*parts), 1, 13)).cast("double") / F.lit(TWO_52)


def rank_key(seed: int, *parts: Column | str) -> list[Column]:
    """Order of a draw: the unit, then the parts joined by a bar."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return [stable_unit(seed, *cols), F.concat_ws("|", F.lit(str(seed)), *cols)]


def sample_digest(sha256: Column, source_path: Column) -> Column:
    """The content hash, else a hash of the path."""
    return F.coalesce(F.when(sha256 != "", sha256), F.sha2(source_path, 256))


def shard_of(hexes: Column, n: int) -> Column:
    """Shard number: the first 16 hex digits modulo ``n``."""
    return (hex_value(F.substring(hexes, 1, 16)) % F.lit(n).cast("decimal(20,0)")).cast("int")


def replica_of(key: Column, n: int) -> Column:
    """Sticky replica: the first 4 bytes of the key's SHA-256 modulo ``n``."""
    return (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") % n).cast("int")


def hash_pick(key: Column, n: Column) -> Column:
    """Legacy pick: the first 8 hex digits of the key's SHA-256 modulo ``n``."""
    return (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") % n).cast("int")


def quota_cost(seed: int, joint: Column, key: Column) -> Column:
    """Cost of a row in the quota problem: 12 hex digits as a fraction."""
    return hex_value(F.substring(digest(seed, joint, key, sep="|"), 1, 12)).cast("double") / F.lit(float(16**12))


def group_id(members: Column) -> Column:
    """Stable group name of a sorted array of member ids."""
    return F.concat(F.lit("lg_"), F.substring(F.sha2(F.array_join(members, "|"), 256), 1, 16))

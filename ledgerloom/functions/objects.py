"""Objects kept as JSON text, and digests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def object_construct(*members: Column) -> Column:
    """An object without its NULL members."""
    return F.to_json(F.struct(*members))


def object_construct_keep_null(*members: Column) -> Column:
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


def sha256_of(*parts: Column) -> Column:
    """SHA-256 of the parts joined by ``|``, NULL counting as ''."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)

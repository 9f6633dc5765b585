"""Hash expressions that give the same value on any engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col


def hash_order(keys: list[Column | str], seed: int | str) -> Column:
    """Seeded pseudo-random order of a row, from its key alone."""
    return F.md5(F.concat_ws("|", *[as_col(k).cast("string") for k in keys], F.lit(str(seed))))


def hash_prefix(digest: Column, digits: int) -> Column:
    """The first hex digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("int")


def row_digest(cols: list[Column | str]) -> Column:
    """Digest of a whole row: each value with its length in bytes, NULL as ``n``, so that no two rows read alike."""
    values = [as_col(c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("n")) for v in values]
    return F.md5(F.concat(*parts, F.lit("")))


def digest_numbers(digest: Column) -> list[Column]:
    """A digest as four numbers of 32 bits, safe to sum."""
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def digest_sum(digest: Column) -> Column:
    """Sums of the four parts of all digests, in any order of rows."""
    return F.concat_ws("-", *[F.coalesce(F.sum(n), F.lit(0)).cast("string") for n in digest_numbers(digest)])

"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "~null~"


def surrogate_key(*natural_key: Column | str, null_token: str = NULL_TOKEN) -> Column:
    """MD5 of the natural key parts; the same parts give the same 32 hex digits.

    A null part hashes as ``null_token``, so it differs from empty text.
    """
    parts = [F.col(part) if isinstance(part, str) else part for part in natural_key]
    texts = [F.coalesce(part.cast("string"), F.lit(null_token)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))

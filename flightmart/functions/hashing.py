"""Content hashes used to detect changed dimension attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(style: str, *attrs: Column) -> Column:
    """MD5 of the tracked attributes, in the dimension's own form.

    ``concat_ws_dash``: md5(concat_ws('-', a, b)) — NULLs are skipped.
    ``underscore_prefix``: md5(concat('_', a, b)) — '_' is a prefix, not a
    separator, and NULLs are skipped (so ('ab','c') and ('a','bc') collide).
    ``separated``: a collision-free form (NULL-aware, length-prefixed).
    """
    if style == "concat_ws_dash":
        return F.md5(F.concat_ws("-", *attrs))
    if style == "underscore_prefix":
        return F.md5(F.concat(F.lit("_"), *[F.coalesce(a, F.lit("")) for a in attrs]))
    if style == "separated":
        parts = [
            F.coalesce(F.concat(F.length(a).cast("string"), F.lit(":"), a), F.lit("~"))
            for a in attrs
        ]
        return F.md5(F.concat_ws("|", *parts))
    raise ValueError(f"unknown hash style {style!r}")

"""Path text helpers (SC-03, SC-07)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def basename(path: Column | str) -> Column:
    """Last component of a '/'-separated path (a trailing '/' is ignored)."""
    path = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)


def path_join(*parts) -> Column:
    """Join path components with '/'."""
    return F.concat_ws("/", *[F.col(p) if isinstance(p, str) else p for p in parts])

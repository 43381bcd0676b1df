"""The required-path language: ``a.b`` present, ``a.b[]`` a list that isn't empty, ``p===lit`` equal, ``p~~"lit"`` contains."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def _literal(s: str):
    try:
        return json.loads(s)
    except ValueError:
        return s


def present(path: str) -> Column:
    """Whether a record has what the path asks for; never null."""
    if "===" in path:
        at, want = path.split("===", 1)
        return F.col(at.strip()).eqNullSafe(F.lit(_literal(want.strip())))
    if "~~" in path:
        at, want = path.split("~~", 1)
        return F.coalesce(F.array_contains(F.col(at.strip()), F.lit(_literal(want.strip()))), F.lit(False))
    if path.endswith("[]"):
        return F.coalesce(F.size(F.col(path[:-2])) > 0, F.lit(False))
    return F.col(path).isNotNull()


def missing(paths: list[str]) -> Column:
    """The paths that a record lacks, in order."""
    return F.filter(F.array(*[F.when(~present(p), F.lit(p)) for p in paths]), lambda x: x.isNotNull())

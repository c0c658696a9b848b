"""Accounting role of a concept: taxonomy key first, label patterns second."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import patterns as P


def role_of_label(label: Column) -> Column:
    expr = F.when(label.rlike(P.ci(P.ROLE_EXCLUSION)), F.lit(None).cast("string"))
    for role, pattern in P.ROLE_PATTERNS:
        expr = expr.when(label.rlike(P.ci(pattern)), F.lit(role))
    return expr


def role_of_taxonomy(key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in P.TAXONOMY_ROLES.items() for x in kv])
    return F.try_element_at(table, F.split(F.coalesce(key, F.lit("")), r"\|")[0])


def role_of(label: Column, key: Column) -> Column:
    return F.coalesce(role_of_taxonomy(key), role_of_label(label))

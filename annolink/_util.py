from __future__ import annotations

from pyspark.sql import Column, functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind_once(value, body) -> Column:
    """Evaluate ``body`` over ``value`` bound to one lambda variable, which the optimizer
    cannot copy into every reference: ``value`` is computed once a row."""
    return F.get(F.transform(F.array(value), body), 0)

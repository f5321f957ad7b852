"""Python functions as columns: the slow path, kept for callers who need it.

Both send Arrow batches to Python. Prefer the native forms
(``text.not_empty``, ``operators.ip_region.add_region``) in pipelines.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType

# Ranges travel to every task inside the function, so their number is bounded.
MAX_UDF_RANGES = 50_000


def predicate_udf(test, *, after_aggregate: bool = False):
    """Boolean column function from a Python predicate on one value; NULL is False.

    With ``after_aggregate`` the optimizer may not move the filter below a
    ``groupBy``, so Python sees each distinct key once instead of every row.
    """

    @F.pandas_udf(BooleanType())
    def check(values: pd.Series) -> pd.Series:
        return values.map(lambda v: v is not None and bool(test(v))).astype(bool)

    return check.asNondeterministic() if after_aggregate else check


def region_udf(ranges: Sequence[tuple[int, int, int, int]]):
    """Column function: address number to ``array(province, city)``.

    ``ranges`` holds (start, end, province, city), both ends inclusive and not
    overlapping. Larger tables belong in ``operators.ip_region``.
    """
    if len(ranges) > MAX_UDF_RANGES:
        raise ValueError(f"{len(ranges)} ranges exceed {MAX_UDF_RANGES}; use add_region")
    rows = sorted(ranges)
    start = np.array([r[0] for r in rows], dtype="int64")
    end = np.array([r[1] for r in rows], dtype="int64")
    if len(rows) and (np.any(end < start) or np.any(start[1:] <= end[:-1])):
        raise ValueError("ranges overlap or end before they start")
    pair = np.array([r[2:4] for r in rows], dtype="int32").reshape(-1, 2)

    @F.pandas_udf(ArrayType(IntegerType()))
    def lookup(numbers: pd.Series) -> pd.Series:
        known = numbers.notna().to_numpy()
        ip = numbers.fillna(-1).to_numpy(dtype="int64")
        at = np.searchsorted(start, ip, side="right") - 1
        hit = known & (at >= 0)
        hit[hit] = ip[hit] <= end[at[hit]]
        return _arrays(hit, pair[at[hit]])

    return lookup


@F.pandas_udf(ArrayType(IntegerType()))
def place_udf(province: pd.Series, city: pd.Series) -> pd.Series:
    """``array(province, city)`` of a place already looked up; NULL if either is missing."""
    known = (province.notna() & city.notna()).to_numpy()
    return _arrays(known, np.column_stack([province[known], city[known]]).astype("int32"))


def _arrays(known: np.ndarray, rows: np.ndarray) -> pd.Series:
    """The rows as arrays at the known places, NULL elsewhere."""
    out = np.full(len(known), None, dtype=object)
    out[known] = np.fromiter(rows, dtype=object, count=len(rows))
    return pd.Series(out)

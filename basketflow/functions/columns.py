"""Small column functions (F2, F4, F7) and the one pandas-UDF sample.

Everything here but ``plus_udf`` is a built-in expression, so it stays in
whole-stage codegen; ``plus_udf`` shows the plug-in point for custom scalar
logic (Arrow-batched, never row-at-a-time).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def int_sum(a: Column, b: Column) -> Column:
    """integer sum of two (possibly string) columns; ANSI-safe."""
    return a.try_cast("int") + b.try_cast("int")


@F.pandas_udf(IntegerType())
def plus_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """F2 in UDF form (vectorised): ``int(a) + int(b)``; NULL if either is."""
    x = pd.to_numeric(a, errors="coerce").astype("Int64")
    y = pd.to_numeric(b, errors="coerce").astype("Int64")
    return (x + y).astype("Int32")

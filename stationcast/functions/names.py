"""City-name folding."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _fold_udf():
    # Defined inside a function so that it travels to executors by value: workers need no copy of
    # this package.
    @F.pandas_udf("string")
    def fold(names: pd.Series) -> pd.Series:
        return names.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")

    return fold


def slug(name: Column | str) -> Column:
    """Accent- and case-insensitive key of a name, e.g. ``São Paulo`` gives ``sao_paulo``.

    Spark has no Unicode normalisation, so that one step is an Arrow UDF; the rest stays in the JVM.
    Callers apply it to dimension rows or requests, never to fact rows.
    """
    column = F.col(name) if isinstance(name, str) else name
    safe = F.regexp_replace(F.lower(_fold_udf()(column)), "[^0-9a-z]", "_")
    return F.regexp_replace(safe, "^_+|_+$", "")

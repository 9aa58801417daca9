"""Student-t tail probability (M2/M4) as an Arrow-batched UDF.

The heavy part of every test is a distributed aggregate down to a few numbers
per group; only this closed-form tail runs in Python, once per result row.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.tdist import reg_inc_beta, t_two_sided_p  # noqa: F401


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, dof: pd.Series) -> pd.Series:
    out = []
    for tv, dv in zip(t, dof):
        if pd.isna(tv) or pd.isna(dv) or dv <= 0:
            out.append(None)
        else:
            out.append(t_two_sided_p(float(tv), float(dv)))
    return pd.Series(out, dtype="float64")

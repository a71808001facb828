"""Context windows (C1): token arrays cut into windows of ``size`` with ``overlap``.

Starts are 0, step, 2*step, ... (step = size - overlap) while the window still
holds a token its predecessor lacks; the last window may be short; a document
with no tokens has no window.  Pure array expressions: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_starts(n: Column, size: int, overlap: int = 0) -> Column:
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    return F.sequence(F.lit(0), F.greatest(n - overlap - 1, F.lit(0)), F.lit(size - overlap))


def context_windows(df: DataFrame, ids_col: str, size: int = 1024, overlap: int = 0,
                    keep: list[str] | None = None) -> DataFrame:
    """One row per window: ``(*keep, window_no, window)``."""
    keep = keep or []
    arr = F.col(ids_col)
    wins = F.transform(window_starts(F.size(arr), size, overlap), lambda s: F.slice(arr, s + 1, size))
    # No filter: it would be moved below an encoder's UDF, which then runs twice. A null has no windows.
    return df.select(*keep, F.posexplode(F.when(F.size(arr) > 0, wins)).alias("window_no", "window"))

"""Result batches of Python functions."""

from __future__ import annotations

import pandas as pd


def frame(columns: dict[str, list]) -> pd.DataFrame:
    """Lists as a batch.  Columns keep Python values, so a batch without rows has no made-up types."""
    return pd.DataFrame({k: pd.Series(list(v), dtype=object) for k, v in columns.items()})

"""A stateful merge of listings: one state a show, kept from batch to batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "venue string, form string, first_ord long, n long, best double"
STATE = "first_ord long, n long, best double"


def _merge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The state holds the earliest row, how many came and the best confidence; ties do not matter."""
    first, n, best = state.get if state.exists else (None, 0, None)
    for b in batches:
        low, high = int(b["ord"].min()), b["confidence"].max()
        first = low if first is None else min(first, low)
        best = best if pd.isna(high) else float(high) if best is None else max(best, float(high))
        n += len(b)
    state.update((first, n, best))
    out = pd.DataFrame([(*key, first, n, best)], columns=["venue", "form", "first_ord", "n", "best"])
    yield out.astype({"best": "float64"})


def merged_shows(stream: DataFrame) -> DataFrame:
    """A row for each show of a batch with what is known of it since the start (update mode).

    stream: ``venue``, ``form``, ``ord``, ``confidence``; rows without a venue or form are one
    group each.  The state of a show is three numbers, so memory grows with shows, not rows.
    """
    keyed = stream.select("venue", "form", "ord", "confidence").fillna("", ["venue", "form"])
    return keyed.groupBy("venue", "form").applyInPandasWithState(_merge, OUT, STATE, "update", GroupStateTimeout.NoTimeout)

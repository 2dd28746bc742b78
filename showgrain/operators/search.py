"""Exact vector search of a stated query set against all rows, in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096  # vectors of one block


def _packed(block: int):
    """Unit vectors of one length packed as blocks: ``dim``, ``ids`` and ``m`` (64-bit, row by row)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}

        def block_of(dim: int) -> pd.DataFrame:
            rows = held.pop(dim)
            return pd.DataFrame({"dim": [dim], "ids": [[i for i, _ in rows]], "m": [np.stack([v for _, v in rows]).tobytes()]})

        for b in batches:
            for i, v in zip(b.id, b.v, strict=True):
                x = np.asarray(v, dtype=np.float64)
                norm = np.linalg.norm(x) if len(x) else 0.0
                if not norm or not np.isfinite(norm):
                    continue
                held.setdefault(len(x), []).append((i, x / norm))
                if len(held[len(x)]) == block:
                    yield block_of(len(x))
        for dim in list(held):
            yield block_of(dim)

    return run


def _best(k: int):
    """The k best rows of each query in a pair of blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for qd, qi, qm, rd, ri, rm in zip(b.q_dim, b.q_ids, b.q_m, b.dim, b.ids, b.m, strict=True):
                if qd != rd:
                    continue
                q, r, ids = np.frombuffer(qm).reshape(-1, qd), np.frombuffer(rm).reshape(-1, rd), np.asarray(ri)
                s = np.round(q @ r.T, 4)
                # by score, then by id
                order = np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=1)[:, :k]
                n = order.shape[1]
                yield pd.DataFrame({"query_id": np.repeat(np.asarray(qi), n), "vec_id": ids[order].ravel(), "score": np.take_along_axis(s, order, 1).ravel()})

    return run


def cosine_top_k(rows: DataFrame, queries: DataFrame, k: int = 10, ident: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """``query_id``, ``vec_id``, ``score``, ``rank``: the k rows most like each query.

    Both sides are packed into blocks of unit vectors where they are read; blocks of queries meet
    blocks of rows, a matrix product each, and of a pair of blocks only the k best of each query go
    on.  Nothing goes through the driver, and both sides are read once.  Ties (after rounding
    to 4 places) take the smaller id.  Null, empty and zero vectors and those of another length
    match nothing.
    """
    take = lambda d: d.filter(F.col(vector).isNotNull() & F.col(ident).isNotNull()).select(F.col(ident).cast("long").alias("id"), F.col(vector).alias("v"))
    schema = "dim int, ids array<long>, m binary"
    q = take(queries).mapInPandas(_packed(block), schema).withColumnsRenamed({"dim": "q_dim", "ids": "q_ids", "m": "q_m"})
    r = take(rows).mapInPandas(_packed(block), schema)
    # a stated query set against all rows, block by block
    found = r.crossJoin(q).mapInPandas(_best(k), "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def fused(lists: list[DataFrame], k: int, damping: int = 60) -> DataFrame:
    """``id``, ``score``, ``rank``: ranked lists (``id``, ``rank`` from 1) as one, by the sum of 1 / (damping + rank).

    An id counts in each list it stands in; ties take the smaller id.
    """
    both = lists[0].select("id", "rank")
    for x in lists[1:]:
        both = both.unionByName(x.select("id", "rank"))
    best = both.groupBy("id").agg(F.round(F.sum(1 / (damping + F.col("rank"))), 8).alias("score")).orderBy(F.desc("score"), "id").limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "id")))

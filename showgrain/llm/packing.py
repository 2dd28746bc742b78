"""Filling fixed-capacity containers with texts: bin completion.

Sizes are tokens of a public tokenizer.  A text is split only if it alone exceeds a
container; its full pieces fill containers of their own and the rest is packed.  Items
are spread by hash over groups of about ``GROUP_ITEMS``, which bounds a task however many
texts there are and costs at most one part-filled container a group.

Within a group: best-fit decreasing gives the first incumbent.  If it needs more
containers than the bound (total size over capacity), bin completion searches: each
container starts with the largest open item and is completed by an undominated filling
(none of whose items could be exchanged for larger open ones), fullest first; a branch is
cut when the waste so far exceeds what a better solution could afford.  The search ends at
the bound or after ``NODES`` nodes; the incumbent always holds every item.

Defined results: rows without an id take no part; null and empty texts have no tokens and ride in the group's first
container; ties are packed in order of ``doc_id``; repeated rows are packed each; an empty
table gives an empty result.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showgrain.functions.frames import frame
from showgrain.session import spread, written

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CAPACITY = 2048
GROUP_ITEMS = 2000
NODES = 20_000  # nodes of the search in one group
FILLINGS = 12  # fillings tried for one container, fullest first
STEPS = 480  # steps of the enumeration of one container's fillings
BRANCHES = 4  # sizes tried at each step of it, largest first

#: The public pattern that cuts texts ahead of byte-level merges (fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("from_file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every text; whole texts are encoded."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for b in batches:
            yield frame({"doc_id": b.doc_id, "n_tokens": [len(enc.encode_ordinary(t)) if t else 0 for t in b.text]})

    return spread(docs.filter("doc_id is not null").select("doc_id", "text")).mapInPandas(run, "doc_id long, n_tokens long")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: indexes of the items of each container."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free, container), sorted
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        insort(room, (free - sizes[i], b))
    return bins


def fillings(open_sizes: list[int], room: int, most: int = FILLINGS) -> list[list[int]]:
    """Undominated fillings of ``room`` from ascending ``open_sizes``, fullest first; items as sizes.

    Larger items are tried first and an equal size is skipped once tried, so a filling
    is only met with the largest items that reach its total.
    """
    found: dict[int, list[int]] = {}
    steps = 0

    def go(hi: int, left: int, taken: list[int]) -> bool:
        nonlocal steps
        steps += 1
        total = room - left
        if total not in found:
            found[total] = list(taken)
        if left == 0 or steps > STEPS:
            return True
        i = bisect_right(open_sizes, left, 0, hi) - 1
        tried = 0
        while i >= 0 and tried < BRANCHES:
            s = open_sizes[i]
            if s == 0:
                break
            taken.append(s)
            full = go(i, left - s, taken)
            taken.pop()
            if full:
                return True
            i = bisect_left(open_sizes, s, 0, i) - 1
            tried += 1
        return False

    go(len(open_sizes), room, [])
    return [found[t] for t in sorted(found, reverse=True)[:most] if not _dominated(found[t], open_sizes, room)] or [found[max(found)]]


def _dominated(filling: list[int], open_sizes: list[int], room: int) -> bool:
    """True where a larger open item could be put in or take the place of one of the filling."""
    free = room - sum(filling)
    held = sorted(filling)
    for s in [0, *held]:
        i = bisect_right(open_sizes, s + free) - 1
        while i >= 0 and open_sizes[i] > s:
            x = open_sizes[i]
            used = bisect_right(held, x) - bisect_left(held, x)
            there = bisect_right(open_sizes, x) - bisect_left(open_sizes, x)
            if there > used:
                return True
            i = bisect_left(open_sizes, x) - 1
    return False


def pack(sizes: list[int], capacity: int, nodes: int = NODES) -> list[list[int]]:
    """Containers (lists of item indexes) for sizes of at most ``capacity``."""
    incumbent = best_fit(sizes, capacity)
    bound = max(1, -(-sum(sizes) // capacity)) if sizes else 0
    bound = max(bound, sum(2 * s > capacity for s in sizes))
    if len(incumbent) <= bound:
        return incumbent
    best: list[list[int]] | None = None
    limit = len(incumbent)
    spent = 0
    total = sum(sizes)

    # depth-first over containers, on an explicit stack: fillings of each depth, fullest first
    left = sorted(s for s in sizes if s)
    stack: list[tuple[Iterator[list[int]], int]] = []
    chosen: list[list[int]] = []
    waste = 0

    def choices() -> Iterator[list[int]]:
        largest = left[-1]
        return iter([[largest, *f] for f in fillings(left[:-1], capacity - largest)])

    stack.append((choices(), waste))
    while stack and spent < nodes:
        it, waste = stack[-1]
        f = next(it, None)
        if f is None:
            stack.pop()
            if chosen:
                for s in chosen.pop():
                    insort(left, s)
            continue
        spent += 1
        w = waste + capacity - sum(f)
        if w + total > (limit - 1) * capacity:
            continue  # even full containers from here need as many as the incumbent
        for s in f:
            left.pop(bisect_left(left, s))
        chosen.append(f)
        if not left:
            best, limit = [list(c) for c in chosen], len(chosen)
            if limit <= bound:
                break
            for s in chosen.pop():
                insort(left, s)
            continue
        stack.append((choices(), w))
    if best is None:
        return incumbent
    by_size: dict[int, list[int]] = {}
    for i in sorted(range(len(sizes)), reverse=True):
        by_size.setdefault(sizes[i], []).append(i)
    out = [[by_size[s].pop() for s in c] for c in best]
    out[0].extend(by_size.get(0, []))
    return out


def _pack_group(capacity: int, nodes: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "n_tokens"]).reset_index(drop=True)
        container = [0] * len(pdf)
        for c, items in enumerate(pack(pdf.n_tokens.tolist(), capacity, nodes)):
            for i in items:
                container[i] = c
        name = [f"g{g}-{c}" for g, c in zip(pdf.grp, container, strict=True)]
        return pdf.assign(container=name)[["doc_id", "piece", "n_tokens", "container"]]

    return run


def packed(docs: DataFrame, capacity: int = CAPACITY, path: str = TOKENIZER, group_items: int = GROUP_ITEMS, nodes: int = NODES) -> DataFrame:
    """``doc_id``, ``piece`` (from 0), ``n_tokens``, ``container`` of every text or piece of one."""
    sized = written(count_tokens(docs, path), "token-counts")
    groups = max(1, -(-sized.count() // group_items))
    pieces = sized.select("doc_id", F.posexplode(F.expr(f"transform(sequence(0, cast(greatest(n_tokens - 1, 0) div {capacity} as int)), i -> least(n_tokens - i * {capacity}, {capacity}))")).alias("piece", "n_tokens"))
    full = pieces.filter(F.col("n_tokens") == capacity).withColumn("container", F.concat_ws("-", F.lit("full"), "doc_id", "piece"))
    rest = pieces.filter(F.col("n_tokens") < capacity)
    # rows that repeat wholly are numbered, so that the group of a row depends on its content only
    same = rest.groupBy("doc_id", "piece", "n_tokens").agg(F.count("*").alias("copies"))
    rest = same.select("doc_id", "piece", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    rest = rest.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "n_tokens", "copy"), F.lit(groups)).cast("int")).drop("copy")
    out = rest.groupBy("grp").applyInPandas(_pack_group(capacity, nodes), "doc_id long, piece int, n_tokens long, container string")
    return full.select("doc_id", "piece", "n_tokens", "container").unionByName(out)

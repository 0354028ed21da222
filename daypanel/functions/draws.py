"""Seeded choices that come out the same on any partitioning.

A draw hashes its own coordinates (seed, scenario, day, ticker), so no random
generator state has to travel between tasks, and a retried task repeats it."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, functions as F


def seeded_key(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def seeded_draw(seed: int, *parts: Column) -> Column:
    """Uniform integer in [0, 2**32): the first eight hex digits of the hash."""
    head = F.substring(seeded_key(seed, *parts), 1, 8)
    return F.conv(head, 16, 10).cast("long")


def seeded_draw_local(seed: int, *parts) -> int:
    """The same integer for plain Python values."""
    text = "|".join(str(p) for p in (seed, *parts))
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def shelf_key(ticker: Column) -> Column:
    """Candidates are numbered in this order. A hash order is as good as any
    for a uniform choice, and it cuts into even shelves."""
    return F.md5(ticker)


def shelf_key_local(ticker: str) -> str:
    return hashlib.md5(ticker.encode()).hexdigest()

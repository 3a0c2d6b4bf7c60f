"""Counting 64-bit names over blocks of texts.

A block is a few megabytes of documents handled by one task. It asks about its
distinct names: sorted, cut by value into buckets, one row for each (block,
bucket). A bucket's task adds up the counts of all blocks and answers each row
with the totals of its names, in the same order. So a name that stands in every
document costs one entry a block, no task holds more than a bucket, and names
travel as a few bytes each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

REQUEST = "kind int, bucket long, block long, names binary, counts binary"
ANSWER = "kind int, bucket long, block long, totals binary"
REQUEST_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()),
                           ("names", pa.binary()), ("counts", pa.binary())])
ANSWER_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()),
                          ("totals", pa.binary())])
#: Kind of rows that carry a block's own state past a count (bucket: the round).
STATE = -1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of the ordered pair of names (a, b)."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
               + np.uint64(0x165667B19E3779F9))


def planes(x: np.ndarray) -> bytes:
    """The bytes of ``x`` by significance: the zero ones stand together and
    the shuffle's compression removes them."""
    width = x.dtype.itemsize
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, width).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def pack_names(names: np.ndarray) -> bytes:
    """Sorted names as differences."""
    return planes(np.diff(names, prepend=np.uint64(0)))


def unpack_names(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each name: ``names * buckets >> 64``, equal ranges of values."""
    n, low = np.uint64(buckets), np.uint64(32)
    return ((names >> low) * n + ((names & np.uint64(0xFFFFFFFF)) * n >> low)) >> low


def partitions(spark, pieces: int) -> int:
    """How many partitions ``pieces`` blocks or buckets are dealt to: more than
    they are, so that few meet in one task, whatever the session's setting."""
    return min(20_000, max(2 * pieces, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def requests(kind: int, block: int, names: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows of REQUEST for sorted distinct ``names``; ``counts`` is (names x
    columns) of 32-bit numbers. Only buckets that get names are looped over."""
    of = bucket_of(names, buckets)
    at = np.flatnonzero(np.diff(of)) + 1
    for low, high in zip([0, *at], [*at, len(names)], strict=True):
        if low < high:
            part = slice(low, high)
            yield kind, int(of[low]), block, pack_names(names[part]), planes(counts[part].ravel())


def answers(rows: list[tuple], columns: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Totals for each (names, counts) row of one bucket; the distinct names
    and their totals."""
    names = [unpack_names(n) for n, _ in rows]
    counts = [from_planes(c, np.uint32).reshape(-1, columns).astype(np.uint64) for _, c in rows]
    distinct, where = np.unique(np.concatenate(names), return_inverse=True)
    every = np.concatenate(counts)
    total = np.stack([np.bincount(where, weights=every[:, k], minlength=len(distinct))
                      for k in range(columns)], axis=1).astype(np.uint64)
    out, at = [], 0
    for n in names:
        out.append(planes(total[where[at:at + len(n)]].ravel()))
        at += len(n)
    return out, distinct, total


def collected(rows: list[dict], kind: int, columns: int) -> np.ndarray:
    """The totals a block got for one kind of names, in the order of its names."""
    own = sorted((r["bucket"], r["totals"]) for r in rows if r["kind"] == kind)
    if not own:
        return np.zeros((0, columns), np.uint64)
    return np.concatenate([from_planes(t, np.uint64).reshape(-1, columns) for _, t in own])


def table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

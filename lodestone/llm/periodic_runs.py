"""Periodic runs of words, found by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that is at least ``max(least, times * q)`` long and that no
neighbouring word extends. Per text: all runs, and the text without what they
repeat (a word goes if some run holds it after that run's first q words).

Method. The words of a block of texts, with a symbol of its own between two
texts, are compressed into a run-length grammar: a round names the blocks of
equal neighbours (left out where there are none) or the pairs of a left and a
right symbol, sides being dealt anew each round, until no symbol repeats. Equal
stretches get equal names but for a few symbols at their ends, so how far two
places agree is found by climbing the grammar while names agree and coming down
where they don't, for all questions of a block at once.

The questions are harmonic: a run of period q has at least
``max(least, times * q) - q`` places that agree with the place q further on, so
one of them is a multiple of that number. For each q these places are compared,
and those that agree are extended both ways. The extent doesn't depend on which
multiple of the smallest period was asked, so the least one asked of an extent
is its smallest period. All is exact: names are dealt, not hashed.

A text is the work of one task and no two texts meet, so nothing is shuffled; a
task needs some 250 bytes a word of its block (``block_bytes`` of text, or one
longer text).

A null or blank text has no words and no runs. Repeated rows are told apart by
nothing and give equal rows. An empty table gives none.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = pa.struct([("n_words", pa.int64()),
                    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                                 ("period", pa.int64())]))),
                    ("best", pa.int64()), ("collapsed", pa.binary())])
FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, best long, collapsed binary"
#: Candidates compared at once.
BATCH = 1 << 20


@dataclass
class Level:
    """The symbols of one round; ``parent`` is the place of each in the next
    round, whose symbol p holds those from ``first[p]`` to ``first[p + 1]``."""
    symbols: np.ndarray
    parent: np.ndarray | None = None
    first: np.ndarray | None = None
    blocks: bool = False


def _grouped(symbols: np.ndarray, head: np.ndarray, blocks: bool) -> Level:
    first = np.append(np.flatnonzero(head), len(symbols)).astype(np.int32)
    return Level(symbols, (np.cumsum(head) - 1).astype(np.int32), first, blocks)


def _sides(symbols: np.ndarray, turn: int) -> np.ndarray:
    """A bit of each symbol, dealt anew each turn."""
    x = (symbols.astype(np.uint64) + np.uint64(turn * 0x9E3779B9 + 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(63)).astype(bool)


def grammar(symbols: np.ndarray) -> list[Level]:
    """The rounds over ``symbols`` (not negative), the last without repeats."""
    levels, turn = [], 0
    free = int(symbols.max(initial=0)) + 1
    while True:
        if turn % 3 == 0 and len(pd.unique(symbols)) == len(symbols):
            return [*levels, Level(symbols)]
        same = symbols[1:] == symbols[:-1]
        if same.any():
            level = _grouped(symbols, np.concatenate([[True], ~same]), True)
            levels.append(level)
            symbols = symbols[level.first[:-1]].astype(np.int64)
            size = np.diff(level.first)
            many = size > 1
            names, kinds = pd.factorize((symbols[many] << 32) | size[many])
            symbols[many] = free + names
            free += len(kinds)
        left = _sides(symbols, turn)
        turn += 1
        paired = left[:-1] & ~left[1:]
        if not paired.any():
            continue
        level = _grouped(symbols, np.concatenate([[True], ~paired]), False)
        at = np.flatnonzero(paired)
        names, kinds = pd.factorize((symbols[at].astype(np.int64) << 32) | symbols[at + 1])
        levels.append(level)
        symbols = symbols[level.first[:-1]].astype(np.int64)
        symbols[level.parent[at]] = free + names
        free += len(kinds)


def agreement(levels: list[Level], a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
    """How many symbols from a on and from b on agree, read onwards (``way`` 1)
    or backwards (-1). Both ends of the text must hold symbols of their own,
    and a differ from b."""
    def jump(level: Level, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Symbols that agree for sure where those at x and y do."""
        if not level.blocks:
            return np.full(len(x), way, np.int64)
        px, py = level.parent[x], level.parent[y]
        room = np.minimum(level.first[px + 1] - x, level.first[py + 1] - y) if way > 0 \
            else np.minimum(x - level.first[px], y - level.first[py]) + 1
        return way * room.astype(np.int64)

    def edge(level: Level, x: np.ndarray) -> np.ndarray:
        p = level.parent[x]
        return level.first[p] == x if way > 0 else level.first[p + 1] - 1 == x

    which, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
    stopped = []
    for level in levels:
        agree = level.symbols[x] == level.symbols[y]
        halt = [(which[~agree], x[~agree], y[~agree])]
        which, x, y = which[agree], x[agree], y[agree]
        if level.parent is not None and len(which):
            inner = np.flatnonzero(~(edge(level, x) & edge(level, y)))
            step = jump(level, x[inner], y[inner])
            x[inner] += step
            y[inner] += step
            up = edge(level, x) & edge(level, y)
            halt.append((which[~up], x[~up], y[~up]))
            which, x, y = which[up], level.parent[x[up]].astype(np.int64), level.parent[y[up]].astype(np.int64)
        stopped.append([np.concatenate(c) for c in zip(*halt, strict=True)])
    which, x, y = stopped.pop()
    for level, more in zip(reversed(levels[:-1]), reversed(stopped), strict=True):
        x = level.first[x] if way > 0 else level.first[x + 1] - 1
        y = level.first[y] if way > 0 else level.first[y + 1] - 1
        which, x, y = (np.concatenate(c).astype(np.int64) for c in zip((which, x, y), more, strict=True))
        todo = np.arange(len(which))
        while len(todo := todo[level.symbols[x[todo]] == level.symbols[y[todo]]]):
            step = jump(level, x[todo], y[todo])
            x[todo] += step
            y[todo] += step
    out = np.zeros(len(a), np.int64)
    out[which] = way * (x - a[which])
    return out


def _grid(x: np.ndarray, reach: list[int], least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) where a place of the grid agrees with the one a period
    on; ``reach[q - 1]`` is the end of the texts long enough for period q."""
    places, periods, held = [], [], 0
    q, top = 1, len(reach)
    while q <= top:
        step = max(least, times * q) - q
        if reach[q - 1] > 4096 * step:
            found = np.flatnonzero(x[0:reach[q - 1] - q:step] == x[q:reach[q - 1]:step]) * step
            places.append(found)
            periods.append(np.full(len(found), q))
            q += 1
        else:  # many periods with few places each
            qs = np.arange(q, min(top, q + 65_536) + 1)
            steps = np.maximum(least, times * qs) - qs
            counts = np.maximum(0, -(-(np.asarray(reach[q - 1:q - 1 + len(qs)]) - qs) // steps))
            fit = max(1, int(np.searchsorted(np.cumsum(counts), BATCH)))
            qs, steps, counts = qs[:fit], steps[:fit], counts[:fit]
            at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            at *= np.repeat(steps, counts)
            each = np.repeat(qs, counts)
            hit = x[at] == x[at + each]
            places.append(at[hit])
            periods.append(each[hit])
            q += fit
        held += len(places[-1])
        if held > BATCH:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def runs_of(texts: list[np.ndarray], least: int = 6, times: int = 4) -> list[list[tuple[int, int, int]]]:
    """For each text (numbers of its words): its runs (start, length, period),
    by start, then period."""
    order = sorted((k for k in range(len(texts)) if len(texts[k]) >= least), key=lambda k: -len(texts[k]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not order:
        return out
    # one symbol of its own before the first text and after each
    top = 1 + max(int(texts[k].max()) for k in order)
    parts, starts, at = [np.array([top])], [], 1
    for n, k in enumerate(order):
        starts.append(at)
        parts += [texts[k], np.array([top + n + 1])]
        at += len(texts[k]) + 1
    x = np.concatenate(parts).astype(np.int64)
    ends, lengths = np.array(starts) + [len(texts[k]) for k in order], [len(texts[k]) for k in order]
    longest, reach = lengths[0], []
    n = len(order)
    for q in range(1, longest // times + 1):
        while n and lengths[n - 1] < max(least, times * q):
            n -= 1
        reach.append(int(ends[n - 1]) if n else 0)
    levels, found = None, []
    for places, periods in _grid(x, reach, least, times):
        levels = levels or grammar(x)
        after = agreement(levels, places, places + periods, 1)
        before = agreement(levels, places - 1, places + periods - 1, -1)
        length = before + periods + after
        long = length >= np.maximum(least, times * periods)
        found.append(np.stack([places[long] - before[long], length[long], periods[long]], 1))
    if not found:
        return out
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    extent = np.ones(len(every), bool)
    extent[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[extent]
    owner = np.searchsorted(starts, every[:, 0], "right") - 1
    for w, (start, length, period) in zip(owner.tolist(), every.tolist(), strict=True):
        out[order[w]].append((start - starts[w], length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> int | None:
    """The place in ``runs`` of the greatest exact length / period; the first of equals."""
    best = None
    for k, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = k
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if runs:
        cover = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            cover[start + period] += 1
            cover[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
    return b" ".join(words)


def _scan(texts: list[bytes | None], keys: list, change: Callable | None, least: int, times: int) -> list[tuple]:
    number = defaultdict(count().__next__)
    said, coded = [], []
    for text, key in zip(texts, keys, strict=True):
        words = (text or b"").split()  # of bytes: at \x20 and \x09-\x0D
        if change:
            words = change(key, words)
        said.append(words)
        coded.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    return [(len(words), runs, strongest(runs), collapse(words, runs))
            for words, runs in zip(said, runs_of(coded, least, times), strict=True)]


def annotate(docs: DataFrame, least: int = 6, times: int = 4, change: Callable | None = None,
             text_col: str = "text", key_col: str = "doc_id", block_bytes: int = 4 << 20) -> DataFrame:
    """(key, found): ``found`` has n_words, runs, best (place of the strongest
    run in ``runs``, null without runs) and collapsed (UTF-8 bytes).
    ``change(key, words)`` may rewrite the words of a text first."""
    kind = docs.schema[key_col].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(1).fill_null(b"").cast(pa.large_binary()).to_numpy(False), object)
            total = np.cumsum([len(t) for t in sizes])
            at = 0
            while at < len(batch):
                base = total[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(total, base + block_bytes)))
                keys = batch.column(0).slice(at, end - at)
                rows = _scan(list(sizes[at:end]), keys.to_pylist(), change, least, times)
                found = pa.StructArray.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in r[1]] for r in rows],
                              RESULT.field("runs").type),
                     pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary())],
                    fields=list(RESULT))
                yield pa.RecordBatch.from_arrays([keys, found], ["key", "found"])
                at = end

    return docs.select(F.col(key_col).alias("key"), F.col(text_col).cast("binary").alias("text")) \
        .mapInArrow(task, f"key {kind}, found struct<n_words:long,runs:array<struct<start:long,length:long,"
                          "period:long>>,best:long,collapsed:binary>")


def plant_repeats(doc_id, words: list[bytes]) -> list[bytes]:
    """One text in ten, told by the CRC-32 of its id as text (a null id: as an
    empty text), repeats a stretch from some word on to its end."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[:n - a]

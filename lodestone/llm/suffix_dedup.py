"""Removing repeated strings by distributed prefix doubling.

A byte is removed if it lies in a string of ``least`` bytes that also starts
somewhere else. Every start of such a string has an anchor: the leftmost byte
of its window whose first ``ANCHOR`` bytes have the smallest hash. Equal strings
have their anchors at equal places, and neighbouring starts share one, so
(document, anchor) positions, about one in seventy bytes, stand for all starts.

Rounds of prefix doubling rank the anchors: the rank of 2h bytes at a position
is the rank of the pair (rank of h bytes there, rank of h bytes at offset h).
Each round, Spark sorts the ranks of all documents into buckets and counts
them; an anchor whose rank is unique drops every string that reaches past its
h bytes. In the last round the remaining stretches are ranked whole, too:
equal stretches, as in copies, are settled there, and one of them goes on. What
is left, where texts agree in part, is settled by the ranks of the strings
themselves at the threshold length.

Ranks are 64-bit names (fingerprints composed by doubling) rather than places
in the sorted order, which only equality needs. Documents are dealt by a hash of
the row over blocks of ``block_bytes``, the same exchange for each round;
copies spread over blocks, and a rank asked for by a block travels once.

Defined results: a null text counts as empty; texts shorter than ``least`` lose
nothing; nothing crosses documents; a null id is an id; repeated rows each get a
row, and are copies of each other; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import blocks as B

ANCHOR = 25
#: Base of the polynomial hash and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
CHUNK = 1 << 20
LAST = 1 << 22  # kinds: the prefix length of a round; LAST: stretches; LAST + 1: strings
POSITION = np.uint64((1 << 34) - 1)


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) <= n:
            def run(base):
                x = np.full(n + 1, base, np.uint64)
                x[0] = 1
                return np.multiply.accumulate(x)
            self.up, self.down = run(BASE), run(INVERSE)


class Chunk:
    """Some documents, end to end: their anchors and the names of any substring."""

    def __init__(self, texts: list[bytes], powers: Powers, least: int) -> None:
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts])
        n, self.least = len(self.bytes), least
        powers.upto(n)
        self.down = powers.down
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * powers.up[:n], out=self.sums[1:])
        self.first = self.last = self.anchor = np.zeros(0, np.int64)
        if n >= least:
            self._anchors(n)
        self.end = self.ends[np.searchsorted(self.ends, self.anchor, side="right")] if len(self.anchor) \
            else np.zeros(0, np.int64)

    def name(self, at: np.ndarray, length) -> np.ndarray:
        """Names of the substrings of ``length`` bytes at ``at``."""
        return B.mix((self.sums[at + length] - self.sums[at]) * self.down[at])

    def rank(self, at: np.ndarray, length: int) -> np.ndarray:
        """The rank of ``length`` bytes at ``at``, by doubling from ANCHOR bytes."""
        if length == ANCHOR:
            return self.name(at, ANCHOR)
        half = length // 2
        return B.pair(self.rank(at, half), self.rank(at + half, half))

    def _anchors(self, n: int) -> None:
        count, span = n - ANCHOR + 1, self.least - ANCHOR + 1
        h = B.mix((self.sums[ANCHOR:] - self.sums[:count]) * self.down[:count])
        key = (h & ~POSITION) | np.arange(count, dtype=np.uint64)  # the leftmost of equals
        pad = np.full(-count % span, np.iinfo(np.uint64).max, np.uint64)
        cells = np.concatenate([key, pad]).reshape(-1, span)
        windows = count - span + 1
        ahead = np.minimum.accumulate(cells, axis=1).ravel()[span - 1:span - 1 + windows]
        behind = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()[:windows]
        best = (np.minimum(ahead, behind) & POSITION).astype(np.int64)
        starts = np.concatenate([[0], self.ends[:-1]])
        fits = np.zeros(windows + 1, np.int64)  # windows inside one document
        own = self.ends - starts >= self.least
        np.add.at(fits, starts[own], 1)
        np.add.at(fits, self.ends[own] - self.least + 1, -1)
        at = np.flatnonzero(np.cumsum(fits[:windows]))
        if not len(at):
            return
        anchor = best[at]
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]))
        self.first, self.anchor = at[new], anchor[new]
        self.last = at[np.concatenate([new[1:] - 1, [len(at) - 1]])]


class Block:
    """The documents of one block, and the rounds that have been counted."""

    def __init__(self, texts: list[bytes], least: int) -> None:
        powers, part, size = Powers(), [], 0
        self.chunks: list[Chunk] = []
        for t in texts:
            if part and size + len(t) > CHUNK:
                self.chunks.append(Chunk(part, powers, least))
                part, size = [], 0
            part.append(t)
            size += len(t)
        if part:
            self.chunks.append(Chunk(part, powers, least))
        self.least = least
        self.alive = [c.last.copy() for c in self.chunks]  # last start that can still repeat
        self.seen = [np.zeros(len(c.first), np.uint64) for c in self.chunks]

    def prefixes(self, length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Anchors that are alive and have ``length`` bytes, and their ranks, mixed
        again: the name of an anchor is the least of many, and buckets are equal ranges."""
        live = [np.flatnonzero((last >= c.first) & (c.anchor + length <= c.end))
                for c, last in zip(self.chunks, self.alive, strict=True)]
        return live, [B.mix(c.rank(c.anchor[i], length)) for c, i in zip(self.chunks, live, strict=True)]

    def drop_unique(self, length: int, total: np.ndarray) -> None:
        """``total``: how often each distinct rank of this round stands anywhere."""
        live, ranks = self.prefixes(length)
        distinct = np.unique(np.concatenate(ranks)) if ranks else np.zeros(0, np.uint64)
        for k, (c, i, r) in enumerate(zip(self.chunks, live, ranks, strict=True)):
            often = total[np.searchsorted(distinct, r)] if len(r) else np.zeros(0, np.uint64)
            if length == ANCHOR:
                self.seen[k][i] = often
            alone = i[often < 2]
            self.alive[k][alone] = np.minimum(self.alive[k][alone], c.anchor[alone] + length - self.least - 1)

    def stretches(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Anchors that are alive, and the names of the bytes of all their
        strings with the places of the first string and the anchor in it."""
        live = [np.flatnonzero(last >= c.first) for c, last in zip(self.chunks, self.alive, strict=True)]
        names = []
        for c, last, i in zip(self.chunks, self.alive, live, strict=True):
            size = last[i] - c.first[i] + self.least
            place = (size.astype(np.uint64) << np.uint64(32)) | (c.anchor[i] - c.first[i]).astype(np.uint64)
            names.append(B.pair(c.name(c.first[i], size), B.mix(place)))
        return live, names

    def strings(self, total: np.ndarray, mine: np.ndarray) -> Iterator[tuple]:
        """(chunk, settled anchors, starts, ranks): strings that the counts of
        stretches don't settle; ``mine``: this block goes on for the stretch."""
        live, names = self.stretches()
        distinct = np.unique(np.concatenate(names)) if names else np.zeros(0, np.uint64)
        taken = np.zeros(len(distinct), bool)
        for k, (c, i, n) in enumerate(zip(self.chunks, live, names, strict=True)):
            j = np.searchsorted(distinct, n)
            often = total[j] if len(j) else np.zeros(0, np.uint64)
            first = np.zeros(len(j), bool)
            first[np.unique(j, return_index=True)[1]] = True
            first &= ~taken[j]
            taken[j] = True
            go = i[first & mine[j] & (self.seen[k][i] > often)] if len(j) else i
            size = self.alive[k][go] - c.first[go] + 1
            starts = np.repeat(c.first[go] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) \
                + np.arange(size.sum())
            yield c, i[often >= 2], starts, c.rank(starts, self.least)


def _distinct(names: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate(names) if names else np.zeros(0, np.uint64)
    distinct, counts = np.unique(every, return_counts=True)
    return distinct, counts.astype(np.uint32)


def _texts(table: pa.Table) -> list[bytes]:
    return [t or b"" for t in table["text"].to_pylist()]


def _lengths(least: int) -> list[int]:
    """Prefix lengths of the rounds, below the threshold."""
    out = [ANCHOR]
    while out[-1] * 2 < least:
        out.append(out[-1] * 2)
    return out


def _replay(block: Block, rows: list[dict], rounds: list[int]) -> list[tuple]:
    """Applies the counts of earlier rounds; the states to carry further."""
    states = []
    for length in rounds:
        state = next((r["totals"] for r in rows if r["kind"] == B.STATE and r["bucket"] == length), None)
        if state is None:  # the round just counted
            state = B.planes(np.minimum(B.collected(rows, length, 1)[:, 0], 0xFFFFFFFF).astype(np.uint32))
        block.drop_unique(length, B.from_planes(state, np.uint32).astype(np.uint64))
        states.append((length, state))
    return states


def _outcome(block: Block, rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    state = next((r["totals"] for r in rows if r["kind"] == B.STATE and r["bucket"] == LAST), None)
    if state is not None:
        both = B.from_planes(state, np.uint32).reshape(-1, 2).astype(np.uint64)
    else:
        both = B.collected(rows, LAST, 2)
    return both[:, 0], both[:, 1] > 0


def _dealt(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """(block, doc_id, text), and the number of blocks."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // block_bytes) + 1
    return rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias("block"), "doc_id", "text"), n


def remove_repeats(docs: DataFrame, least: int = 200, id_col: str = "doc_id", text_col: str = "text",
                   keep_bytes: bool = False, block_bytes: int = 8 << 20,
                   bucket_names: int = 1 << 21) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans): one row per
    input row; spans are the maximal removed runs, start:end in bytes, joined by
    commas. With ``keep_bytes`` also kept, the remaining bytes. ``least`` is
    ANCHOR times a power of two: 50, 100, 200, 400 ..."""
    rounds = _lengths(least)
    if rounds[-1] * 2 != least:
        raise ValueError(f"least must be {ANCHOR} times a power of two, not {least}")
    dealt, n_blocks = _dealt(docs, id_col, text_col, block_bytes)
    id_type = dealt.schema["doc_id"].dataType
    # about one anchor in 70 bytes; the strings of partly equal stretches can be a tenth of all
    few = max(1, n_blocks * block_bytes // (70 * bucket_names) + 1)
    many = max(1, n_blocks * block_bytes // (10 * bucket_names) + 1)

    def ask(step: int) -> Callable:
        """Round ``step``: after the answers to all rounds before it."""
        def rows(table: pa.Table, told: list[dict]) -> pa.Table:
            number = table["block"][0].as_py()
            block, out = Block(_texts(table), least), []
            states = _replay(block, told, rounds[:min(step, len(rounds))])
            if step < len(rounds):
                names, counts = _distinct(block.prefixes(rounds[step])[1])
                out += B.requests(rounds[step], number, names, counts[:, None], few)
            elif step == len(rounds):
                names, counts = _distinct(block.stretches()[1])
                out += B.requests(LAST, number, names, counts[:, None], few)
            else:
                total, mine = _outcome(block, told)
                names, counts = _distinct([r for *_, r in block.strings(total, mine)])
                out += B.requests(LAST + 1, number, names, counts[:, None], many)
                states.append((LAST, B.planes(np.stack([np.minimum(total, 0xFFFFFFFF), mine], 1)
                                              .astype(np.uint32).ravel())))
            out += [(B.STATE, k, number, s, b"") for k, s in states]
            return B.table(out, B.REQUEST_ARROW)
        return rows

    spark = docs.sparkSession
    by_block_parts, bucket_parts = B.partitions(spark, n_blocks), B.partitions(spark, max(n_blocks, many))
    by_block = dealt.repartition(by_block_parts, "block").groupBy("block")
    first = ask(0)
    told = _count(by_block.applyInArrow(lambda t: first(t, []), B.REQUEST), bucket_parts)
    for step in range(1, len(rounds) + 2):
        told = _count(_meet(by_block, told, ask(step), B.REQUEST, by_block_parts), bucket_parts)

    def finish(table: pa.Table, told_rows: list[dict]) -> pa.Table:
        texts = _texts(table)
        block = Block(texts, least)
        _replay(block, told_rows, rounds)
        total, mine = _outcome(block, told_rows)
        found = list(block.strings(total, mine))
        distinct = _distinct([r for *_, r in found])[0]
        often = B.collected(told_rows, LAST + 1, 1)[:, 0]
        out = []
        for k, (c, settled, starts, ranks) in enumerate(found):
            edge = np.zeros(len(c.bytes) + 1, np.int64)
            np.add.at(edge, c.first[settled], 1)
            np.add.at(edge, block.alive[k][settled] + least, -1)
            again = starts[often[np.searchsorted(distinct, ranks)] > 1] if len(starts) else starts
            np.add.at(edge, again, 1)
            np.add.at(edge, again + least, -1)
            gone = np.cumsum(edge[:-1]) > 0
            begin = 0
            for end in c.ends.tolist():
                own = gone[begin:end]
                turn = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
                kept = c.bytes[begin:end][~own].tobytes()
                out.append((end - begin, int(own.sum()), len(turn) // 2, hashlib.sha256(kept).hexdigest(),
                            ",".join(f"{s}:{e}" for s, e in turn.reshape(-1, 2).tolist()), kept if keep_bytes else None))
                begin = end
        fields = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                  ("kept_sha256", pa.string()), ("spans", pa.string()), ("kept", pa.binary())]
        rest = B.table(out, pa.schema(fields))
        return rest.add_column(0, "doc_id", table["doc_id"])

    result = _meet(by_block, told, finish,
                   f"doc_id {id_type.simpleString()}, n_bytes long, n_removed long, n_spans long, "
                   "kept_sha256 string, spans string, kept binary", by_block_parts)
    return result if keep_bytes else result.drop("kept")


def _count(asked: DataFrame, parts: int) -> DataFrame:
    """Totals of the names, and for stretches whether the block is the one to go on."""
    def add(rows: pa.Table) -> pa.Table:
        kind = rows["kind"][0].as_py()
        if kind == B.STATE:
            totals = rows["names"].to_pylist()
        else:
            asked_rows = list(zip(rows["names"].to_pylist(), rows["counts"].to_pylist(), strict=True))
            totals, distinct, _ = B.answers(asked_rows, 1)
            if kind == LAST:
                block = np.array(rows["block"].to_pylist(), np.int64)
                owner = np.full(len(distinct), np.iinfo(np.int64).max)
                places = [np.searchsorted(distinct, B.unpack_names(n)) for n, _ in asked_rows]
                for p, b in zip(places, block, strict=True):
                    owner[p] = np.minimum(owner[p], b)
                totals = [B.planes(np.stack([B.from_planes(t, np.uint64), (owner[p] == b).astype(np.uint64)], 1).ravel())
                          for t, p, b in zip(totals, places, block, strict=True)]
        return pa.table([rows["kind"], rows["bucket"], rows["block"], pa.array(totals, pa.binary())],
                        schema=B.ANSWER_ARROW)

    return asked.withColumn("part", F.when(F.col("kind") == B.STATE, F.col("block")).otherwise(F.col("bucket"))) \
        .repartition(parts, "kind", "part").groupBy("kind", "part").applyInArrow(lambda t: add(t.drop_columns(["part"])), B.ANSWER)


def _meet(by_block, told: DataFrame, each: Callable, schema: str, parts: int) -> DataFrame:
    """Runs ``each`` on the documents and the answers of every block."""
    def both(table: pa.Table, rows: pa.Table) -> pa.Table:
        return each(table, rows.to_pylist())
    return by_block.cogroup(told.repartition(parts, "block").groupBy("block")).applyInArrow(both, schema)

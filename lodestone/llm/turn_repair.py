"""Conversation structure repair.

The turns of a conversation should read ``(s?(ua)+)?`` by the first letters of
their roles. Each row's first fault counts: blank (nothing but white space),
duplicate (role and text stood earlier), truncated (doesn't end in ``.``, ``!``
or ``?``). The cheapest edits that make the roles read right are found: Keep
(0), Rerole to user or assistant (2), Delete (3, required for blank and
duplicate rows), Insert an empty turn (2); a truncated row that stays adds 1.
The audit is their initials in order; of equally cheap ones the least as text.

Method, secondary-sorted streaming in two passes; each repartitions by
conversation, sorts by turn, and carries its state from batch to batch.

1. Backwards. Rows travel without texts, as one number each. The state is the
   cost still to come from each of four states (nothing, after s, u, a). Each
   row leaves one byte: the letter that is best in each state. That rows are
   first of their kind is told by marks, one for each kind of row at its first
   turn, which sort beside them; so no task remembers what it has seen. A
   conversation's bytes go out in chunks, each to be met at its first row.
2. Forwards. Chunks and rows arrive in order; one state and one chunk at hand
   tell what to do with a row.

So a conversation of any length is worked through in bounded memory, but for its
audit, which is a result of one letter a turn.

Rows are taken by turn, nulls first; rows of one turn in descending order of the
SHA-256 of role and text, so repeated rows stand together. Null roles and texts
are one space, and a null conversation is one of its own. An empty table gives no
rows. ``copies_col`` tells how often a row stands there; with 0 it doesn't, but
its conversation is reported all the same.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose bytes stand in one chunk.
CHUNK = 1 << 20
BLANKS = " \t\n\x0b\f\r"
NOTHING, S, U, A = range(4)
INSERTED = (U, U, A, U)
ROLE = {U: "user", A: "assistant"}
LETTERS = "DIKR"
#: Kept initials: state and class of a role (0 s, 1 u, 2 a, 3 any other) to the next state.
KEPT = {(NOTHING, 0): S, (NOTHING, 1): U, (S, 1): U, (U, 2): A, (A, 1): U}
LEGAL = {(0, 1), (1, 2), (2, 1)}
AT_END = (0, 4, 2, 0)
SUMS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
BACK = "none boolean, key string, part int, turn long, timed boolean, h binary, seq long, data binary, " \
    + ", ".join(f"{c} long" for c in SUMS)
DIGEST = "none boolean, key string, " + ", ".join(f"{c} long" for c in SUMS) + ", audit string, repaired_sha256 string"
TURNS = "none boolean, key string, place long, edit string, role string, text string"


def step(ahead: tuple, kind: int, goes: bool, cut: bool) -> tuple[tuple, int]:
    """Costs to come before a row, from those after it, and the row's byte: two
    bits for each state, the first of LETTERS that is cheapest there."""
    options = []
    for state in range(4):
        choice = {0: 3 + ahead[state]}
        if not goes:
            if (state, kind) in KEPT:
                choice[2] = cut + ahead[KEPT[state, kind]]
            choice[3] = 2 + cut + ahead[INSERTED[state]]
        options.append(choice)
    plain = [min(c.values()) for c in options]
    u, a = min(plain[U], 2 + plain[A]), min(plain[A], 2 + plain[U])
    best = (min(plain[NOTHING], 2 + u), min(plain[S], 2 + u), u, a)
    byte = 0
    for state in range(4):
        options[state][1] = 2 + best[INSERTED[state]]
        byte |= min(k for k, c in options[state].items() if c == best[state]) << 2 * state
    return best, byte


class _Back:
    """One conversation, read backwards."""

    def __init__(self, chunk: int):
        self.chunk, self.known = chunk, {}

    def begin(self, none: bool, key: str) -> None:
        self.name, self.ahead, self.base, self.after = (none, key), AT_END, 0, None
        self.low = self.high = self.seen = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.seq = 0
        self.bytes, self.held = bytearray(), None

    def row(self, code: int, new: bool) -> None:
        """One present row: code = 4 * class + 2 * blank + truncated."""
        kind, blank, cut = code >> 2, code >> 1 & 1, code & 1
        again = not blank and not new
        cut = cut and not blank and not again
        self.blank += blank
        self.duplicate += again
        self.truncated += cut
        self.illegal += self.after is not None and (kind, self.after) not in LEGAL
        self.after = kind
        asked = (self.ahead, kind, bool(blank or again), bool(cut))
        found = self.known.get(asked)
        if found is None:  # costs above the least repeat soon, so this table stays small
            ahead, byte = step(*asked)
            least = min(ahead)
            found = self.known[asked] = tuple(c - least for c in ahead), least, byte
        self.ahead = found[0]
        self.base += found[1]
        self.bytes.append(found[2])

    def turn(self, timed: bool, turn: int) -> None:
        if timed and turn != self.seen:
            self.high = turn if self.high is None else self.high
            self.low = self.seen = turn
            self.turns += 1

    def piece(self, timed: bool, turn: int, h: bytes) -> tuple:
        """A full chunk; it is met where its first row stands."""
        data = bytes(reversed(self.bytes))
        self.bytes.clear()
        self.seq -= 1
        return (*self.name, 1, turn, timed, h, self.seq, data, *[0] * len(SUMS))

    def end(self) -> tuple:
        gaps = min(self.high - self.low + 1 - self.turns, (1 << 63) - 1) if self.turns else 0
        return (*self.name, 0, 0, False, None, self.seq - 1, bytes(reversed(self.bytes)), gaps, self.blank,
                self.duplicate, self.truncated, self.illegal, self.base + self.ahead[NOTHING])


def _backwards(chunk: int):
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work, open_, held = _Back(chunk), False, None
        columns = [c.split()[0] for c in BACK.split(", ")]

        def settle(out: list, new: bool) -> None:
            nonlocal held
            if held is not None:
                timed, turn, h, code = held
                held = None
                work.row(code, new)
                if len(work.bytes) >= chunk:
                    out.append(work.piece(timed, turn, h))

        for batch in batches:
            out: list[tuple] = []
            for none, key, turn, timed, h, code in zip(*[batch[c].tolist() for c in
                                                        ("none", "key", "turn", "timed", "h", "code")], strict=True):
                if not open_ or work.name != (none, key):
                    if open_:
                        settle(out, False)
                        out.append(work.end())
                    work.begin(none, key)
                    open_ = True
                if code == MARK:  # the row before it, next in order, is the first of its kind
                    settle(out, True)
                    continue
                if code != ABSENT:
                    settle(out, False)
                    work.turn(timed, turn)
                    held = timed, turn, h, code
            if out:
                yield _frame(out, columns)
        if open_:
            out = []
            settle(out, False)
            yield _frame([*out, work.end()], columns)
    return task


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns, dtype=object)


#: Codes of the backward pass that stand for no row.
ABSENT, MARK = -1, -2


class _Forth:
    """One conversation, read forwards: the edits (letter, role, text)."""

    def begin(self) -> None:
        self.state, self.chunks, self.at = NOTHING, deque(), 0

    def insert(self) -> tuple:
        self.state = INSERTED[self.state]
        return "I", ROLE[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple]:
        while self.at >= len(self.chunks[0]):
            self.chunks.popleft()
            self.at = 0
        byte = self.chunks[0][self.at]
        self.at += 1
        while (letter := byte >> 2 * self.state & 3) == 1:
            yield self.insert()
        if letter == 2:
            self.state = KEPT[self.state, "sua".find(role[:1])]
        elif letter == 3:
            self.state = INSERTED[self.state]
            role = ROLE[self.state]
        yield LETTERS[letter], role, text

    def end(self) -> Iterator[tuple]:
        while AT_END[self.state]:
            yield self.insert()


class _Summary:
    """A conversation's sums, audit and the digest of its repaired turns."""
    schema = DIGEST

    def begin(self, name: tuple, sums: tuple) -> None:
        self.name, self.sums, self.audit, self.sha, self.some = name, sums, bytearray(), hashlib.sha256(), False

    def say(self, out: list, letter: str, role: str, text: str) -> None:
        self.audit += letter.encode()
        if letter != "D":
            self.sha.update(f"{chr(10) if self.some else ''}{role}:{text}".encode())
            self.some = True

    def end(self, out: list) -> None:
        out.append((*self.name, *self.sums, self.audit.decode(), self.sha.hexdigest()))


class _Repaired:
    """The repaired turns; deleted ones have no place."""
    schema = TURNS

    def begin(self, name: tuple, sums: tuple) -> None:
        self.name, self.place = name, 0

    def say(self, out: list, letter: str, role: str, text: str) -> None:
        if letter != "D":
            out.append((*self.name, self.place, letter, role, text))
            self.place += 1

    def end(self, out: list) -> None:
        pass


def _forwards(kind: type):
    columns = [c.split()[0] for c in kind.schema.split(", ")]

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work, told, open_ = _Forth(), kind(), False

        def close(out: list) -> None:
            for edit in work.end():
                told.say(out, *edit)
            told.end(out)

        for batch in batches:
            out: list[tuple] = []
            sums = list(zip(*[batch[c].tolist() for c in SUMS], strict=True))
            for n, (none, key, part, data, role, text) in enumerate(zip(
                    *[batch[c].tolist() for c in ("none", "key", "part", "data", "role", "text")], strict=True)):
                if part == 0:
                    if open_:
                        close(out)
                    open_ = True
                    work.begin()
                    told.begin((none, key), sums[n])
                if part < 2:
                    work.chunks.append(data)
                else:
                    for edit in work.row(role, text):
                        told.say(out, *edit)
            if out:
                yield _frame(out, columns)
        if open_:
            out = []
            close(out)
            if out:
                yield _frame(out, columns)
    return task


def _rows(turns: DataFrame, copies_col: str | None) -> DataFrame:
    """none, key, turn, timed, role, text, copies, h, code."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    found = turns.select(
        F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("timed"),
        role.alias("role"), text.alias("text"),
        (F.col(copies_col) if copies_col else F.lit(1)).cast("int").alias("copies"))
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    cut = (~F.substring(body, -1, 1).isin(".", "!", "?")).cast("int")
    said = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    return found.withColumn("h", F.unhex(F.sha2(said, 256))) \
        .withColumn("code", F.when(F.col("copies") < 1, ABSENT)
                    .otherwise(4 * kind + F.when(body == "", 2).otherwise(cut)))


def _repeated(rows: DataFrame) -> DataFrame:
    once = F.greatest(F.col("copies"), F.lit(1))
    return rows.withColumn("copies", F.explode(F.array_repeat(F.lit(1), once)))


def _ordered(frame: DataFrame, *order) -> DataFrame:
    return frame.repartition("none", "key").sortWithinPartitions("none", "key", *order)


def _stream(turns: DataFrame, copies_col: str | None, kind: type, chunk: int) -> DataFrame:
    rows = _rows(turns, copies_col)
    present = F.col("code") >= 0
    # one mark a kind of row, at its first turn
    firsts = rows.filter(present & (F.col("code") % 4 < 2)).groupBy("none", "key", "h") \
        .agg(F.min("timed").alias("timed"), F.min("turn").alias("least")) \
        .select("none", "key", F.when(F.col("timed"), F.col("least")).otherwise(0).alias("turn"), "timed", "h",
                F.lit(MARK).alias("code"))
    told = _repeated(rows).select("none", "key", "turn", "timed", "h", "code").unionByName(firsts)
    back = _ordered(told, F.col("timed").desc(), F.col("turn").desc(), F.col("h"), F.col("code").desc()) \
        .mapInPandas(_backwards(chunk), BACK)
    # parts: 0 sums with the first chunk, 1 further chunks, 2 rows
    back = back.select("*", *[F.lit("").alias(c) for c in ("role", "text")])
    texts = _repeated(rows.filter(present)).select(
        "none", "key", F.lit(2).alias("part"), "turn", "timed", "h", F.lit(0).cast("long").alias("seq"),
        F.lit(b"").alias("data"), *[F.lit(0).cast("long").alias(c) for c in SUMS], "role", "text")
    return _ordered(back.unionByName(texts), F.col("part") > 0, "timed", "turn", F.col("h").desc(), "part", "seq") \
        .select("none", "key", "part", "data", "role", "text", *SUMS).mapInPandas(_forwards(kind), kind.schema)


def _named(found: DataFrame, turns: DataFrame) -> DataFrame:
    conv = F.when(~F.col("none"), F.col("key").cast(turns.schema["conv_id"].dataType)).alias("conv_id")
    return found.select(conv, *[c for c in found.columns if c not in ("none", "key")])


def repair(turns: DataFrame, copies_col: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """For each conversation of ``turns`` (conv_id, turn, role, text): gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 (of
    ``role:text``, joined by newlines)."""
    return _named(_stream(turns, copies_col, _Summary, chunk), turns)


def repaired(turns: DataFrame, copies_col: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """The repaired conversations: conv_id, place, edit (K, R or I), role, text."""
    return _named(_stream(turns, copies_col, _Repaired, chunk), turns)


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with faults told by the CRC-32 of ``conv_id:turn`` modulo 20 (nulls
    in any column: one space): 0 drops a row (copies 0), 1 empties its text, 2
    removes its ends of sentences, 3 repeats it (copies 2), 4 makes it the user's."""
    def told(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    return turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(told("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(told("text"), ".!?", "")).otherwise(told("text"))
        .alias("text"), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))

"""Document fingerprints by winnowing.

Every run of ``gram`` code points has a 64-bit hash (rolled up by doubling: a
run of 2m from two of m). Of each ``window`` neighbouring hashes the least is a
mark of the text, the rightmost of equals; its place is kept beside it. (Least
by the upper half of the hash.) So texts that share ``gram + window - 1`` code
points share a mark, and the places tell where. Texts with fewer grams than a
window are one window, those with fewer code points than a gram one gram, and
empty texts have no mark.

``fingerprints`` gives the marks of each text. ``compare_next`` sets each text
beside the next one and beside an edit of itself that ends in the next one's
beginning. Neighbours are found by one range shuffle: each task walks through
its sorted stretch of the table with one text at hand, and passes its first and
last text on, which meet in a second, small step (two texts a task). Long texts
are marked in pieces of ``PIECE`` windows, so memory beside the text is bounded.

A null text is an empty one. Documents stand in descending order of doc_id,
nulls last, rows of one id in descending order of the XXH64 of their texts;
repeated rows are told apart by their place in the table alone, so a hot id is
spread like any other rows. After the last comes the first; a single row is its
own next. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.blocks import mix
from lodestone.llm.common import materialize

GRAM, WINDOW = 25, 26
PIECE = 1 << 21
#: Text that one task of the range shuffle gets, about.
SLICE_BYTES = 64 << 20
_BASE = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)


def gram_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """The hash of each run of ``gram`` code points."""
    part, size = mix(points.astype(np.uint64) + np.uint64(1)), 1
    whole, done = None, 0
    while True:
        if gram & size:
            if whole is None:
                whole = part
            else:  # ``whole`` covers ``done`` points, ``part`` those after them
                n = len(points) - done - size + 1
                whole = whole[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + part[done:done + n]
            done += size
        if done == gram:
            return mix(whole)
        n = len(points) - 2 * size + 1
        part = part[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + part[size:size + n]
        size *= 2


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """The least of each ``window`` neighbours."""
    size = 1
    while 2 * size <= window:
        values = np.minimum(values[:len(values) - size], values[size:])
        size *= 2
    rest = window - size
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def marks(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the marks, by place."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gram = min(gram, len(points))
    window = min(window, len(points) - gram + 1)
    names, places = [], []
    for at in range(0, len(points) - gram - window + 2, PIECE):
        hashes = gram_hashes(points[at:at + PIECE + window + gram - 2], gram)
        from_right = _LOW - np.arange(len(hashes), dtype=np.uint64)
        least = _least((hashes & ~_LOW) | from_right, window)
        place = (_LOW - (least & _LOW)).astype(np.int64)
        place = place[np.concatenate([[True], place[1:] != place[:-1]])]
        if places and places[-1][-1] == at + place[0]:
            place = place[1:]
        names.append(hashes[place])
        places.append(at + place)
    return np.concatenate(names), np.concatenate(places)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes over all hashes of two fingerprints; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    every = len(a) + len(b) - both
    return both / every if every else 1.0


def digest(found: tuple[np.ndarray, np.ndarray]) -> str:
    """One name for hashes and places together."""
    return hashlib.sha256(found[0].tobytes() + found[1].tobytes()).hexdigest()


def edit(text: str, other: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many code
    points from the beginning of ``other``, or all of them."""
    cut = len(text) // 2
    return text[:len(text) - cut] + other[:cut]


def _text(data: bytes | None) -> str:
    return (data or b"").decode("utf-8", "replace")


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, key_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(key, marks): for each text its marks (hash, place) by place."""
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("place", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                names, places = marks(_text(batch.column(1)[at].as_py()), gram, window)
                one = pa.StructArray.from_arrays([pa.array(names.view(np.int64)), pa.array(places)],
                                                 fields=list(kind.value_type))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 1), pa.ListArray.from_arrays([0, len(one)], one, kind)], ["key", "marks"])

    return docs.select(F.col(key_col).alias("key"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        task, f"key {docs.schema[key_col].dataType.simpleString()}, marks array<struct<hash:long,place:long>>")


class _Walk:
    """One text with its marks and size."""

    def __init__(self, key, data: bytes | None, gram: int, window: int):
        self.key, self.data, self.text = key, data, _text(data)
        self.marks = marks(self.text, gram, window)

    def beside(self, other: _Walk, gram: int, window: int) -> tuple:
        edited = edit(self.text, other.text)
        found = self.marks if edited == self.text else marks(edited, gram, window)
        return (self.key, len(self.text), hashlib.sha256(edited.encode()).hexdigest(), digest(self.marks),
                digest(found), likeness(self.marks[0], found[0]), likeness(self.marks[0], other.marks[0]),
                len(self.marks[0]))


FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
          "n_marks"]


def compare_next(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, key_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """For each document: doc_id, n_chars, the edited text's sha256, names of
    its fingerprint and of the edited text's, likeness of its fingerprint to
    the edited text's and to the next document's, and its number of marks."""
    spark = docs.sparkSession
    kind = docs.schema[key_col].dataType.simpleString()
    done = (f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double, n_marks long")
    #: part: the stretch; edge: 0 a finished row, 1 a stretch's first text, 2 its last
    held = f"{done}, part int, edge int, text binary"

    def frames(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                          schema=schema)

    def fields(first: pa.DataType, more: bool) -> pa.Schema:
        kinds = [first, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        found = list(zip(FIELDS, kinds, strict=True))
        return pa.schema(found + [("part", pa.int32()), ("edge", pa.int32()), ("text", pa.binary())] if more else found)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, schema = TaskContext.get().partitionId(), None, None
        blank = (None,) * (len(FIELDS) - 1)
        for batch in batches:
            schema = fields(batch.schema.field(0).type, True)
            out = []
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                this = _Walk(key, data.as_py(), gram, window)
                out.append((key, *blank, part, 1, this.data) if last is None
                           else (*last.beside(this, gram, window), part, 0, None))
                last = this
            if out:
                yield frames(out, schema)
        if last is not None:
            yield frames([(last.key, *blank, part, 2, last.data)], schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_Walk(k, a.as_py(), gram, window).beside(_Walk(None, b.as_py(), gram, window), gram, window)
                    for k, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True)]
            if rows:
                yield frames(rows, fields(batch.schema.field(0).type, False))

    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    table = docs.select(F.col(key_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("h"),
                        F.monotonically_increasing_id().alias("nth"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SLICE_BYTES))
    order = [F.col("id").desc_nulls_last(), F.col("h").desc(), F.col("nth")]
    rows = materialize(table.repartitionByRange(slices, *order).sortWithinPartitions(*order)
                       .select("id", "text").mapInArrow(walk, held), "winnow")
    firsts = rows.filter("edge = 1").select("part", F.col("text").alias("other"))
    # one number a stretch: which one comes next, the first after the last
    along = Window.orderBy("part")
    parts = firsts.select("part", F.coalesce(F.lead("part").over(along), F.first("part").over(along)).alias("then"))
    ends = rows.filter("edge = 2").select("doc_id", "text", "part").join(parts, "part") \
        .join(firsts.withColumnRenamed("part", "then"), "then").select("doc_id", "text", "other")
    return rows.filter("edge = 0").select(*FIELDS).unionByName(ends.mapInArrow(meet, done))

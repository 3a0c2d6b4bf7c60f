"""Exact top-k inner products with a vector-approximation file.

Vectors are whole numbers. Each component is also kept as a cell number of a
few bits; a query and the cells of a vector give an upper and a lower bound of
their inner product. The cells of all vectors are scanned in tiles against
blocks of queries, twice. First one tile in ``seed_every``, for the k-th best
lower bound of each query over them: what lies below it is out, so what the scan
of all tiles keeps for a query doesn't grow with the number of tiles. Their k-th
best lower bound prunes again, and then exact vectors are read in rounds, highest
upper bound first, until no unread vector's bound reaches the k-th exact score.

Equal vectors are one class: only its k + 1 smallest ids can be in a result
(one may be the query itself), and equal queries are searched once. So
thousands of copies cost one candidate, and ties are complete. Every (query
block, vector tile) pair is one row of bounded size, dealt by its tile; the
queries are a stated set, searched in blocks. A query keeps as many places more
as its own id has vectors, whatever other ids have.

Defined results: vectors that are null, or hold a null or a number that is not
finite, take no part, nor do rows with a null id; vectors of different lengths
never meet; ties go to the smaller id; a repeated id takes part with each of
its distinct vectors, each a candidate with its own rank, and is never a
candidate of its own id; a query with fewer
than k candidates gets all; an empty table gives an empty result; other columns
are ignored. Finite components of any size take part: those beyond 1e150 after
scaling count as that. Where inner products could leave the range of a long
integer, scores are sums of doubles, cut to that range, with ties by id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import discard, materialize


#: Components of scaled vectors are cut to this size.
LARGEST = 1e150


def whole_vectors(frame: DataFrame, id_col: str, vector_col: str, factor: int) -> DataFrame:
    """(id, vec): floor(factor * x) of each component, as a double, of the rows that take part."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    def whole(v):
        y = F.greatest(F.least(v * factor, F.lit(LARGEST)), F.lit(-LARGEST))
        return F.when(F.abs(y) < 2.0 ** 53, F.floor(F.when(F.abs(y) < 2.0 ** 53, y)).cast("double")).otherwise(y)
    return (frame.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, whole).alias("vec")))


def _smallest(rows: DataFrame, key: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each key; Spark cuts each task's rows to k first."""
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order))) \
               .filter(F.col("nth") <= k)


def _cells(vecs: np.ndarray, bits: int, low: float, high: float) -> np.ndarray:
    width = max(1.0, (high - low + 1) / (1 << bits))
    return np.clip(((vecs - low) // width), 0, (1 << bits) - 1).astype(np.uint8)


def _edges(bits: int, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest whole number of each cell."""
    width = max(1.0, (high - low + 1) / (1 << bits))
    first = np.ceil(low + np.arange(1 << bits) * width)
    last = np.ceil(low + (np.arange(1 << bits) + 1) * width) - 1
    first[0], last[-1] = low, high
    return first, np.maximum(last, first)


def bounds(queries: np.ndarray, cells: np.ndarray, edges: tuple, rounded: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products, (queries x vectors);
    ``rounded`` if sums of doubles aren't exact."""
    first, last = edges[0][cells], edges[1][cells]
    up, down = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
    low, high = up @ first.T + down @ last.T, up @ last.T + down @ first.T
    if rounded:
        slack = (up - down) @ np.maximum(np.abs(first), np.abs(last)).T * (cells.shape[1] + 4) * 2.0 ** -50
        low, high = low - slack, high + slack
    return low, high


def _kth(lows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The wanted-th greatest of each row; none: minus infinity."""
    best = np.full(len(lows), -np.inf)
    for w in np.unique(wanted):
        if lows.shape[1] >= w:
            best[wanted == w] = -np.partition(-lows[wanted == w], w - 1, axis=1)[:, w - 1]
    return best


def _inner(a: str, b: str, wide: bool) -> Column:
    """The inner product of two whole vectors as a long."""
    if not wide:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("long") * y.cast("long")), F.lit(0).cast("long"),
                           lambda s, x: s + x)
    total = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    edge = 2.0 ** 63
    return F.get(F.transform(F.array(total), lambda t: F.when(t >= edge, F.lit((1 << 63) - 1)).when(
        t <= -edge, F.lit(-(1 << 63))).otherwise(F.when(F.abs(t) < edge, t).cast("long"))), 0)


def search(frame: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           factor: int = 256, bits: int = 6, tile: int = 2048, query_block: int = 512,
           read_first: int = 16, seed_every: int = 16) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows for which ``is_query`` (a
    column over ``id``) holds, against all other rows."""
    rows = whole_vectors(frame, id_col, vector_col, factor).distinct()
    classes = materialize(
        _smallest(rows, ["vec"], ["id"], k + 1).groupBy("vec")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("dim", F.size("vec"))
        .withColumn("class", F.xxhash64(F.to_binary(F.sha2(F.concat_ws(",", F.col("vec").cast("array<string>")), 256),
                                                    F.lit("hex")))), "vector-classes")
    # a query's own id may stand first with each of its vectors
    some = rows.filter(is_query)
    own = some.groupBy(F.col("id").alias("o_id")).agg((F.count(F.lit(1)) + k).cast("int").alias("wanted"))
    asked = materialize(some.join(own, F.col("id") == F.col("o_id")).drop("o_id").withColumn("dim", F.size("vec"))
                        .withColumn("qkey", F.sha2(F.concat_ws(",", F.col("vec").cast("array<string>")), 256)), "queries")
    range_ = classes.agg(F.min(F.array_min("vec")).alias("low"), F.max(F.array_max("vec")).alias("high"),
                         F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")).first()
    low, high = float(range_.low or 0), float(range_.high or 0)
    tiles = max(1, math.ceil(range_.n / tile))
    rounded = (range_.dim or 0) * max(abs(low), abs(high)) ** 2 >= 2.0 ** 52
    wide = (range_.dim or 0) * max(abs(low), abs(high)) ** 2 >= 2.0 ** 62
    distinct_q = materialize(asked.groupBy("qkey", "dim", "vec").agg(F.max("wanted").alias("wanted")), "query-classes")
    size = distinct_q.agg(F.count(F.lit(1)).alias("n"), F.max("wanted").alias("most")).first()
    blocks, most = max(1, math.ceil(size.n / query_block)), size.most or k

    # the approximation file: one row per tile of cells
    def approximate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            cells = [_cells(np.asarray(v, float), bits, low, high).tobytes() for v in part["vec"]]
            yield pd.DataFrame({"class": part["class"], "dim": part["dim"], "cells": cells})

    va = (classes.select("class", "dim", "vec")
          .mapInPandas(approximate, "class long, dim int, cells binary")
          .withColumn("tile", F.pmod("class", F.lit(tiles)))
          .groupBy("dim", "tile").agg(F.collect_list("class").alias("classes"), F.collect_list(
              F.struct("class", "cells")).alias("file")))
    va = materialize(va.select("dim", "tile", "file"), "va-file")
    edges = _edges(bits, low, high)
    wanted = F.col("wanted")

    def scan(seeds: bool):
        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in batches:
                for file, ask in zip(part["file"], part["asked"], strict=True):
                    ids = np.array([f["class"] for f in file], np.int64)
                    cells = np.frombuffer(b"".join(f["cells"] for f in file), np.uint8).reshape(len(ids), -1)
                    for at in range(0, len(ask), 128):
                        some = ask[at:at + 128]
                        want = np.array([q["wanted"] for q in some])
                        lo, hi = bounds(np.array([q["vec"] for q in some], float), cells, edges, rounded)
                        best = _kth(lo, want)
                        if seeds:
                            i, j = np.nonzero(lo >= best[:, None])
                        else:
                            i, j = np.nonzero(hi >= np.maximum(best, [q["floor"] for q in some])[:, None])
                        yield pd.DataFrame({"qkey": [some[a]["qkey"] for a in i], "wanted": want[i], "class": ids[j],
                                            "low": lo[i, j], "high": hi[i, j]})
        return task

    def floors(found: DataFrame) -> DataFrame:
        """(f_key, floor): the wanted-th best lower bound of the queries that have as many."""
        best = _smallest(found.select("qkey", "wanted", "low"), ["qkey"], [F.desc("low")], most).filter(F.col("nth") <= wanted)
        return best.groupBy(F.col("qkey").alias("f_key")).agg(F.min("low").alias("floor"), F.count(F.lit(1)).alias("got"),
                                                              F.max("wanted").alias("w")) \
            .filter(F.col("got") >= F.col("w")).select("f_key", "floor")

    def scanned(questions: DataFrame, seeds: bool) -> DataFrame:
        """Each block of questions meets each tile (or each seed tile) of its dimension, dealt by tile."""
        every = F.sequence(F.lit(0), F.lit(tiles - 1), F.lit(seed_every if seeds else 1))
        ask = (questions.withColumn("block", F.pmod(F.xxhash64("qkey"), F.lit(blocks)))
               .groupBy("dim", "block").agg(F.collect_list(F.struct("qkey", "vec", "wanted", "floor")).alias("asked"))
               .select("dim", F.explode(every.cast("array<bigint>")).alias("tile"), "asked"))
        parts = max(1, min(20_000, tiles // (seed_every if seeds else 1)))
        return va.repartition(parts, "dim", "tile").join(ask.repartition(parts, "dim", "tile"), ["dim", "tile"]) \
            .select("file", "asked") \
            .mapInPandas(scan(seeds), "qkey string, wanted int, class long, low double, high double")

    no_floor = distinct_q.withColumn("floor", F.lit(float("-inf")))
    seeds = floors(scanned(no_floor, True))
    kept = materialize(scanned(distinct_q.join(seeds, F.col("qkey") == F.col("f_key"), "left")
                               .withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), False), "bounds")
    open_ = (kept.join(floors(kept), F.col("qkey") == F.col("f_key"), "left")
             .filter(F.col("floor").isNull() | (F.col("high") >= F.col("floor")))
             .withColumn("turn", F.row_number().over(Window.partitionBy("qkey").orderBy(F.desc("high"), "class")))
             .select("qkey", "wanted", "class", "high", "turn"))
    open_ = materialize(open_, "candidates")
    discard(va, kept)

    # exact vectors, highest bound first, until the k-th result is certain
    exact, read = None, 0
    many = read_first
    while True:
        now = open_.filter((F.col("turn") > read) & (F.col("turn") <= read + many))
        if exact is not None:
            sure = _smallest(exact.select("qkey", "wanted", "score"), ["qkey"], [F.desc("score")], most) \
                .filter(F.col("nth") <= wanted).groupBy(F.col("qkey").alias("s_key")) \
                .agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("have"))
            now = now.join(sure, F.col("qkey") == F.col("s_key")) \
                     .filter((F.col("have") < wanted) | (F.col("high") >= F.col("kth"))) \
                     .select("qkey", "wanted", "class", "high", "turn")
        found = (now.join(classes.select(F.col("class").alias("c"), F.col("vec").alias("v"), "ids"),
                          F.col("class") == F.col("c"))
                 .join(distinct_q.select(F.col("qkey").alias("k"), F.col("vec").alias("q")),
                       F.col("qkey") == F.col("k"))
                 .select("qkey", "wanted", "class", "ids", _inner("v", "q", wide).alias("score")))
        found = materialize(found, "exact")
        if found.isEmpty():
            break
        exact = found if exact is None else exact.union(found)
        read, many = read + many, many * 4
    if exact is None:
        exact = found
    discard(classes, distinct_q, open_)
    best = exact.select("qkey", "wanted", "class", "score", F.explode("ids").alias("vec_id")).distinct()
    best = _smallest(best, ["qkey"], [F.desc("score"), "vec_id"], most).filter(F.col("nth") <= wanted).drop("nth")
    ranked = (asked.select(F.col("id").alias("query_id"), F.col("qkey").alias("a_key"))
              .join(best, F.col("a_key") == F.col("qkey"))
              .filter(F.col("vec_id") != F.col("query_id")))
    return _smallest(ranked, ["query_id"], [F.desc("score"), "vec_id"], k) \
        .select("query_id", F.col("nth").cast("int").alias("rank"), "vec_id", "score")

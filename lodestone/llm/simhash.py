"""SimHash near-duplicate groups by tiled exact comparison.

Every text becomes a 64-bit fingerprint of its word shingles. The distinct
fingerprints are cut into tiles that share the bit counts of both 32-bit
halves; a pair of tiles is compared only if those counts can be within the
radius, and then exactly, by numpy exclusive-or and bit count. Each tile pair
reports a spanning forest of its links (never the links of a dense group), and
alternating large-star / small-star rounds join the forests into components.

Work on copies is bounded: equal texts share one fingerprint, which is compared
once. Tiles are bounded (``tile_rows`` on average), so no task holds a group.

Defined results: a null or wordless text has fingerprint zero and links like
any other; a null id takes part, but a component's id is its smallest non-null
id (null if it has none); repeated rows each get a row; an empty table gives an
empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import discard, materialize

HASH_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """The fingerprint of one text as an unsigned 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        return digest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total = len(words) - shingle_words + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, HASH_CHUNK):
        hi = min(total, at + HASH_CHUNK)
        cuts = zip(starts[at:hi].tolist(),
                   ends[at + shingle_words - 1:hi + shingle_words - 1].tolist(), strict=True)
        h = np.array([digest(joined[s:e], 42) for s, e in cuts], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def marker(shingle_words: int = 4):
    """A function of the text column: the fingerprint's 64 bits as a long."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        out = np.fromiter((fingerprint(t, shingle_words) for t in texts), np.uint64, len(texts))
        return pd.Series(out.view(np.int64))
    return fp


def annotate(docs: DataFrame, text_col: str = "text", shingle_words: int = 4) -> DataFrame:
    """(row, fp): ``row`` is the whole input row as one struct."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return whole.select("row", marker(shingle_words)(F.col("row")[text_col]).alias("fp"))


def merge_links(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of node pairs (a, b) into ``label``, in place; every entry of
    ``label`` points at its component's smallest node before and after."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def tile_forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple:
    """Edges (node, root) that span the links within ``radius`` between two
    tiles, or within one tile if ``right`` is None."""
    nodes = left if right is None else np.concatenate([left, right])
    other, offset = (left, 0) if right is None else (right, len(left))
    label = np.arange(len(nodes))
    step = max(1, (1 << 18) // max(1, len(other)))
    for at in range(0, len(left), step):
        apart = np.bitwise_count(left[at:at + step, None] ^ other[None, :])
        i, j = np.nonzero(apart <= radius)
        i, j = i + at, j + offset
        if right is None:
            i, j = i[i < j], j[i < j]
        if len(i):
            merge_links(label, i, j)
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _tiles(nodes: DataFrame, tile_rows: int) -> tuple[DataFrame, list]:
    """Tiles (tile, fps) and the cells as rows (hi, lo, n, first, subs): a cell
    of n nodes has the tiles ``first`` to ``first + subs - 1`` (at most 33 x 33
    cells, so they fit the driver)."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    celled = nodes.select("fp", F.bit_count(F.shiftrightunsigned("fp", 32)).alias("hi"),
                          F.bit_count(low).alias("lo"))
    cells, first = [], 0
    for r in celled.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n")).orderBy("hi", "lo").collect():
        subs = -(-r.n // tile_rows)
        cells.append((r.hi, r.lo, r.n, first, subs))
        first += subs
    known = nodes.sparkSession.createDataFrame(
        cells, "c_hi int, c_lo int, c_n long, first long, subs long")
    tiles = (celled.join(F.broadcast(known), (F.col("hi") == F.col("c_hi")) & (F.col("lo") == F.col("c_lo")))
             .select((F.col("first") + F.pmod(F.xxhash64("fp"), F.col("subs"))).alias("tile"), "fp")
             .groupBy("tile").agg(F.collect_list("fp").alias("fps")))
    return tiles, cells


def _tile_pairs(tiles: DataFrame, cells: list, radius: int) -> DataFrame:
    """Each unordered pair of tiles that can hold a link, once. Pairs are told by
    the numbers of the tiles; their fingerprints are joined by those numbers, so
    a key is one tile, never a cell."""
    spark = tiles.sparkSession
    size = {(hi, lo): (first, subs) for hi, lo, _, first, subs in cells}
    near = [(h, l) for h in range(radius + 1) for l in range(-radius, radius + 1)
            if h + abs(l) <= radius and (h > 0 or l >= 0)]
    ranges = [(*mine, *size[hi + h, lo + l]) for (hi, lo), mine in size.items() for h, l in near
              if (hi + h, lo + l) in size]
    span = spark.createDataFrame(ranges, "a_first long, a_subs long, b_first long, b_subs long")
    numbers = (span.withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("a_subs") - 1)))
               .select((F.col("a_first") + F.col("a")).alias("a"), "b_first", "b_subs")
               .repartition("a")
               .select("a", F.explode(F.sequence(F.col("b_first"), F.col("b_first") + F.col("b_subs") - 1)).alias("b"))
               .filter(F.col("a") <= F.col("b")))
    left = tiles.select(F.col("tile").alias("a_tile"), F.col("fps").alias("a_fps"))
    right = tiles.select(F.col("tile").alias("b_tile"), F.col("fps").alias("b_fps"))
    return (numbers.join(right, F.col("b") == F.col("b_tile"))
            .join(left, F.col("a") == F.col("a_tile"))
            .select((F.col("a") == F.col("b")).alias("same"), "a_fps", "b_fps"))


def links(nodes: DataFrame, radius: int = 4, tile_rows: int = 4096,
          task_pairs: float = 1e9) -> DataFrame:
    """(u, v), v < u: edges whose components are those of all pairs of ``fp``
    in ``nodes`` (distinct) that differ in ``radius`` bits or fewer."""
    tiles, cells = _tiles(nodes, tile_rows)
    count = {(hi, lo): n for hi, lo, n, _, _ in cells}
    work = sum(n * m for (h, l), n in count.items() for (x, y), m in count.items()
               if abs(h - x) + abs(l - y) <= radius) / 2
    tasks = int(max(8, min(100_000, work / task_pairs + 1)))
    pairs = _tile_pairs(tiles, cells, radius).repartition(tasks)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for same, a, b in zip(part["same"], part["a_fps"], part["b_fps"], strict=True):
                left = np.asarray(a, np.int64).view(np.uint64)
                right = None if same else np.asarray(b, np.int64).view(np.uint64)
                u, v = tile_forest(left, right, radius)
                if len(u):
                    u, v = u.view(np.int64), v.view(np.int64)
                    yield pd.DataFrame({"u": np.maximum(u, v), "v": np.minimum(u, v)})

    return pairs.mapInPandas(compare, "u long, v long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) but the roots, by
    alternating large-star and small-star until nothing changes."""
    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r.n, r.h

    edges = materialize(edges, "edges")
    before = state(edges)
    for _ in range(max_rounds):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")) \
                    .select("k", F.least("k", "m").alias("m"))
        large = (both.join(least, F.col("u") == F.col("k")).filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        lower = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = (large.join(lower, F.col("u") == F.col("k"))
                 .select(F.explode(F.array(F.struct("v", "m"),
                                           F.struct(F.col("u").alias("v"), "m"))).alias("e"))
                 .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
                 .filter(F.col("u") != F.col("v")).distinct())
        edges, old = materialize(small, "edges"), edges
        discard(old)
        after = state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 4, radius: int = 4,
                    tile_rows: int = 4096) -> DataFrame:
    """(doc_id, fp, component_id): a row per input row; ``component_id`` is the
    smallest id reachable over links of ``radius`` or fewer differing bits."""
    marked = materialize(
        docs.select(F.col(id_col).alias("doc_id"), marker(shingle_words)(F.col(text_col)).alias("fp")), "simhash")
    return marked.join(classes(marked, radius, tile_rows), "fp", "left") \
                 .select("doc_id", "fp", "component_id")


def classes(marked: DataFrame, radius: int = 4, tile_rows: int = 4096) -> DataFrame:
    """(fp, component_id) for every distinct ``fp`` of ``marked`` (doc_id, fp);
    the ids can be of any ordered type."""
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = components(links(nodes, radius, tile_rows))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left") \
                  .select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy(F.col("root").alias("r")).agg(F.min("least_id").alias("component_id"))
    return rooted.join(ids, F.col("root") == F.col("r")).select("fp", "component_id")

"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target number of words; each of its documents should be
taken ``target / source size`` times, a fractional number. Pivotal rounding
turns these into whole copies: two fractional documents meet and move mass
(copies times size) between them at random, keeping the pair's words and each
document's expectation, until one of them is whole; the other goes on to meet
the next. Each block of documents of a source leaves at most one fractional
document, and the blocks' residuals meet in the next level of a reduction tree,
down to one block per source. There the last document is rounded to the nearer
whole copy, so a source misses its target by at most half of one document; the
last block is folded with several seeds, and the run that misses least is kept.
That choice favours roundings that hit the target: documents (or residuals) of
the last block, which is the only one of a small source, keep their expectation
only nearly; all others keep it exactly.

DataFrame functions only: a block is folded by ``aggregate`` over a sorted array.
Blocks are chosen by a hash, so a source that holds most rows is many blocks.
Only the source table (one row per source) passes through one window.

Defined results: a null text has size 0, and documents of size 0 are taken 0
words; a null source is a source, ordered last; identical rows (id, size,
source) share their copies as evenly as possible; a null id is an id; an empty
table gives an empty result; other columns are ignored. All random choices are
hashes of ids and sizes, so a rerun, and a recomputed task, agrees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import materialize

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 128
#: Seeds tried on the last block of a source.
LAST_TRIES = 16
#: Below this a share counts as whole: the sums of mass are doubles.
EPS = 1e-9


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """(doc_id, source, size) with the number of words of each text."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0))
                       .cast("long").alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
            most_copies: int = 3) -> DataFrame:
    """(source, source_size, units, target), one row per source of ``sizes``
    (source, source_size, units). Sources take ``weights`` in code-point order,
    null last, repeating, and share the sum of all sizes; nobody gets more than
    ``most_copies`` times its own size, and the excess is shared again by
    weight. With the sources in order of size per weight, those that are full
    come first, so the level they stop at is found from running sums."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    by_level = Window.orderBy(F.col("source_size") / F.col("w"), F.col("at"))
    everyone = Window.partitionBy(F.lit(0))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.col("at"), F.lit(len(weights))) + 1).cast("int"))
    cap = F.lit(most_copies) * F.col("source_size")
    return (sizes.withColumn("at", F.row_number().over(order) - 1)
            .withColumn("w", weight)
            .withColumn("total", F.sum("source_size").over(everyone))
            .withColumn("w_all", F.sum("w").over(everyone))
            .withColumn("full", F.coalesce(F.sum(cap).over(before), F.lit(0)))
            .withColumn("w_full", F.coalesce(F.sum("w").over(before), F.lit(0)))
            .withColumn("level", (F.col("total") - F.col("full")) / (F.col("w_all") - F.col("w_full")))
            .withColumn("nth", F.row_number().over(by_level))
            .withColumn("stop", F.min(F.when(cap >= F.col("level") * F.col("w"),
                                             F.struct("nth", "level"))).over(everyone)["level"])
            .select("source", "source_size", "units",
                    F.least(cap.cast("double"), F.col("stop") * F.col("w")).alias("target")))


_UNIT = "struct<doc_id:{id},size:bigint,rows:bigint,whole:bigint,p:double>"
_DONE = "struct<doc_id:{id},size:bigint,rows:bigint,copies:bigint>"

#: One step of the fold: ``s.cur`` is the fractional document so far, ``x`` the
#: next. ``up`` is the mass that cur can gain from x, ``down`` what it can give.
_STEP = """
transform(array(named_struct(
    'up', least((1D - s.cur.p) * s.cur.size, x.p * x.size),
    'down', least(s.cur.p * s.cur.size, (1D - x.p) * x.size))),
  m -> transform(array(CASE
      WHEN pmod(xxhash64(s.cur.doc_id, s.cur.size, x.doc_id, x.size, z), 4503599627370496L)
           / 4503599627370496D * (m.up + m.down) < m.down THEN m.up ELSE -m.down END),
    d -> named_struct('cur', s.cur.p + d / s.cur.size, 'x', x.p - d / x.size))[0])[0]
"""

_FOLD = """
array_min(transform(CASE WHEN blocks = 1 THEN sequence({seed}L, {seed}L + {tries}L - 1L) ELSE array({seed}L) END,
 z -> transform(array(aggregate(units, named_struct('cur', CAST(NULL AS {unit}), 'done', CAST(array() AS array<{done}>)),
  (s, x) -> CASE
    WHEN s.cur IS NULL THEN named_struct('cur', x, 'done', s.done)
    ELSE transform(array({step}), q -> CASE
      WHEN q.cur < {eps} OR q.cur > 1D - {eps} THEN named_struct(
        'cur', CASE WHEN q.x < {eps} OR q.x > 1D - {eps} THEN CAST(NULL AS {unit}) ELSE
               named_struct('doc_id', x.doc_id, 'size', x.size, 'rows', x.rows, 'whole', x.whole, 'p', q.x) END,
        'done', concat(s.done, CASE WHEN q.x < {eps} OR q.x > 1D - {eps} THEN array(
            named_struct('doc_id', s.cur.doc_id, 'size', s.cur.size, 'rows', s.cur.rows, 'copies', s.cur.whole + CAST(round(q.cur) AS bigint)),
            named_struct('doc_id', x.doc_id, 'size', x.size, 'rows', x.rows, 'copies', x.whole + CAST(round(q.x) AS bigint)))
          ELSE array(
            named_struct('doc_id', s.cur.doc_id, 'size', s.cur.size, 'rows', s.cur.rows, 'copies', s.cur.whole + CAST(round(q.cur) AS bigint))) END))
      ELSE named_struct(
        'cur', named_struct('doc_id', s.cur.doc_id, 'size', s.cur.size, 'rows', s.cur.rows, 'whole', s.cur.whole, 'p', q.cur),
        'done', concat(s.done, array(
            named_struct('doc_id', x.doc_id, 'size', x.size, 'rows', x.rows, 'copies', x.whole + CAST(round(q.x) AS bigint)))))
      END)[0] END)),
 f -> named_struct('miss', coalesce(least(f.cur.p, 1D - f.cur.p) * f.cur.size, 0D),
                   'z', z, 'cur', f.cur, 'done', f.done))[0]))
"""


def _fold(units: DataFrame, id_type: str, seed: int) -> DataFrame:
    """(source, blocks, block, cur, done): the documents of each block made
    whole, and the one left fractional, if any. Larger documents meet first, so
    what is left over tends to be small."""
    unit, done = _UNIT.format(id=id_type), _DONE.format(id=id_type)
    fold = _FOLD.format(unit=unit, done=done, eps=EPS, step=_STEP, seed=seed, tries=LAST_TRIES)
    key = F.struct((-F.col("size")).alias("o"), F.xxhash64("doc_id", "size").alias("h"),
                   F.struct("doc_id", "size", "rows", "whole", "p").alias("u"))
    return (units.withColumn("block", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)),
                                             F.col("blocks")))
            .groupBy("source", "blocks", "block")
            .agg(F.array_sort(F.collect_list(key)).alias("sorted"))
            .select("source", "blocks", "block", F.transform("sorted", lambda k: k["u"]).alias("units"))
            .select("source", "blocks", F.expr(fold).alias("f"))
            .select("source", "blocks", F.col("f.cur").alias("cur"), F.col("f.done").alias("done")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_copies: int = 3,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block_rows: int = BLOCK, seed: int = 17) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per
    input row. ``copies`` is whole; ``taken`` is copies times size."""
    rows = materialize(sized(docs, id_col, text_col, source_col), "sizes")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    units = rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    per_source = materialize(
        targets(units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"),
                                            F.count(F.lit(1)).alias("units")),
                weights, most_copies), "targets")
    share = F.col("rows") * F.least(F.lit(float(most_copies)),
                                    F.col("target") / F.col("source_size"))
    t = per_source.select(F.col("source").alias("t_source"), "source_size", "target",
                          F.col("units").alias("n"))
    shared = (units.filter(F.col("size") > 0)
              .join(t, F.col("source").eqNullSafe(F.col("t_source")))
              .withColumn("share", F.when(F.abs(share - F.round(share)) < EPS, F.round(share))
                          .otherwise(share))
              .select("doc_id", "source", "size", "rows", F.floor("share").alias("whole"),
                      (F.col("share") - F.floor("share")).alias("p"), "n"))
    start = materialize(shared, "shares")
    results = [start.filter(F.col("p") == 0)
               .select("doc_id", "source", "size", "rows", F.col("whole").alias("copies"))]
    left = start.filter(F.col("p") > 0).withColumn(
        "blocks", F.ceil(F.col("n") / F.lit(block_rows)).cast("long")).drop("n")
    most = left.agg(F.max("blocks")).first()[0] or 0
    level = 0
    while most:
        folded = materialize(_fold(left, id_type, seed + level), "fold")
        done = folded.select("source", F.explode("done").alias("d"))
        results.append(done.select("d.doc_id", "source", "d.size", "d.rows", "d.copies"))
        rest = folded.filter(F.col("cur").isNotNull())
        left = rest.select("source", "cur.doc_id", "cur.size", "cur.rows", "cur.whole", "cur.p",
                           F.ceil(F.col("blocks") / F.lit(block_rows)).cast("long").alias("blocks"))
        if most == 1:
            results.append(left.select("doc_id", "source", "size", "rows",
                                       (F.col("whole") + F.round("p").cast("long")).alias("copies")))
            break
        most, level = -(-most // block_rows), level + 1
    results.append(units.filter(F.col("size") == 0)
                   .select("doc_id", "source", "size", "rows", F.lit(0).cast("long").alias("copies")))
    whole = results[0]
    for r in results[1:]:
        whole = whole.union(r)
    copies = F.floor(F.col("all") / F.col("rows")) + F.when(
        F.col("k") < F.col("all") % F.col("rows"), 1).otherwise(0)
    return (whole.withColumnRenamed("copies", "all")
            .withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
            .withColumn("copies", copies.cast("long"))
            .join(t, F.col("source").eqNullSafe(F.col("t_source")))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))

"""Incremental merge and latest-version operators.

``merge_patch`` (column-level patch merge)
    Every column of the result is ``coalesce(incr.c, base.c)``: a NULL in the
    increment keeps the old value, new keys are inserted, untouched rows are
    kept, nothing is deleted, NULL keys never match (both rows survive).

    That is ``base LEFT JOIN incr`` for the rows that stay and, for those that are
    new, ``incr ANTI JOIN`` the base keys: with "auto" those alone that the
    increment meets, a semi-join of key columns, so that with a small increment the
    base isn't shuffled and a hot base key collapses first. Spark chooses the join by its own
    statistics; where it shuffles, adaptive execution splits a hot key of
    either join (it cannot split a full outer join). Rows with a NULL key are
    set aside first, so they never gather in one task.

    Several increment rows of one key are folded into one patch, column by
    column: the last non-NULL value in the order of ``dedupe_by`` (ties: the
    greatest value). So one batch gives what its rows would give one after
    another. The fold is a plain aggregate: a hot key collapses before the
    shuffle. Without an order, repeated keys are an error; with
    ``keep_duplicates=True`` they multiply the rows they match, unfolded.

``latest_version``
    ``base UNION ALL incr`` restricted to the rows holding the greatest
    timestamp of their key; ties keep every tied row, NULL keys and NULL
    timestamps drop out. ``method="join"`` is a partial/final aggregate plus a
    join (skew-tolerant: map-side combine, AQE skew-join splitting);
    ``method="window"`` is one shuffle and a rank of one: each task keeps only its
    own latest rows of a key before the shuffle (a window group limit), so of a
    hot key only the rows that tie for the latest of some task travel.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _keys(keys) -> list[str]:
    if isinstance(keys, str):
        keys = keys.split()
    keys = list(keys)
    if not keys:
        raise ValueError("at least one key column is required")
    return keys


def _eq(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b,
                  [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def any_null(keys) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in _keys(keys)])


def repeated_keys(df: DataFrame, keys) -> bool:
    """Whether a key without NULLs has more than one row (one aggregate)."""
    keys = _keys(keys)
    return not (df.filter(~any_null(keys)).groupBy(*keys).count()
                .filter(F.col("count") > 1).isEmpty())


def fold_increment(df: DataFrame, keys, order_by: str) -> DataFrame:
    """One patch per key without NULLs: of each column the last non-NULL value
    in the order of ``order_by``. Rows with a NULL key stay as they are."""
    keys = _keys(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.filter(~any_null(keys)).distinct().unionByName(df.filter(any_null(keys)))
    last = [F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(order_by).alias("o"), F.col(c).alias("v"))))["v"]
            .alias(c) for c in others]
    folded = df.filter(~any_null(keys)).groupBy(*keys).agg(*last).select(*df.columns)
    return folded.unionByName(df.filter(any_null(keys)))


def merge_patch(base: DataFrame, incr: DataFrame, keys, strategy: str = "auto",
                dedupe_by: str | None = None, keep_duplicates: bool = False,
                inserted_col: str | None = None) -> DataFrame:
    """``strategy`` "shuffle" asks for sort-merge joins whatever the sizes;
    "auto" asks for nothing. ``inserted_col`` adds a flag of the inserted rows."""
    keys = _keys(keys)
    cols = base.columns
    missing = [c for c in cols if c not in incr.columns]
    if missing:
        raise ValueError(f"increment lacks columns {missing}")
    if strategy not in ("auto", "shuffle"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    incr = incr.select(*cols)
    asked = incr.filter(~any_null(keys)).select(*keys)
    if dedupe_by:
        incr = fold_increment(incr, keys, dedupe_by)
    elif not keep_duplicates and repeated_keys(incr, keys):
        raise ValueError(f"the increment repeats keys {keys}: give dedupe_by, the order of its rows")

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        if strategy == "shuffle":
            right = right.hint("merge")
        return left.alias("l").join(right.alias("r"), _eq("l", "r", keys), how)

    def flagged(df: DataFrame, new: bool) -> DataFrame:
        return df.withColumn(inserted_col, F.lit(new)) if inserted_col else df

    matching = ~any_null(keys)
    stays = joined(base.filter(matching), incr.filter(matching), "left_outer") \
        .select(*[F.coalesce(F.col(f"r.{c}"), F.col(f"l.{c}")).alias(c) for c in cols])
    met = base.filter(matching).select(*keys)
    if strategy == "auto":
        # dealt to a set number of tasks, where Spark doesn't broadcast it: adaptive execution would
        # gather so many base keys, which compress well, in one task that their sort takes gigabytes
        parts = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        met = joined(met, asked.repartition(parts, *keys), "left_semi").distinct()
    new = joined(incr.filter(matching), met, "left_anti").select(*cols)
    aside = flagged(base.filter(any_null(keys)), False).unionByName(flagged(incr.filter(any_null(keys)), True))
    return flagged(stays, False).unionByName(flagged(new, True)).unionByName(aside)


def union_base_incr(base: DataFrame, incr: DataFrame) -> DataFrame:
    return base.unionByName(incr.select(*base.columns))


def max_ts_per_key(df: DataFrame, keys, ts: str = "extract_ts") -> DataFrame:
    keys = _keys(keys)
    return df.groupBy(*keys).agg(F.max(ts).alias(ts))


def latest_version(base: DataFrame, incr: DataFrame | None, keys,
                   ts: str = "extract_ts", method: str = "join") -> DataFrame:
    keys = _keys(keys)
    u = base if incr is None else union_base_incr(base, incr)
    if method == "window":
        newest = Window.partitionBy(*keys).orderBy(F.desc(ts))
        return (u.filter(~any_null([*keys, ts])).withColumn("_nth", F.rank().over(newest))
                .filter(F.col("_nth") == 1).drop("_nth"))
    if method != "join":
        raise ValueError(f"unknown method {method!r}")
    s = max_ts_per_key(u.select(*keys, ts), keys, ts)
    cond = _eq("t1", "s", keys) & (F.col(f"t1.{ts}") == F.col(f"s.{ts}"))
    return u.alias("t1").join(s.alias("s"), cond, "inner").select("t1.*")

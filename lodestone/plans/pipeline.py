"""One table load, composed from the operators: extract -> raw -> typed
staging -> (merge) -> reconciliation -> audit.

Stages (numbers are the restart points; each reads what the one before it left
on storage, and doing a stage again ends the same):

1. extract    pull rows from the source (whole table, query, split, or rows
              past the high-water mark of the target) and land them as text
              columns, where readers do not look yet
2. raw        publish the landed rows as the raw batch ``batch_id=<id>``
3. raw table  read the batch back with the header's column names, counting
              malformed lines
4. staging    (optional) register the staging table in the catalog
5. transform  cleanse + type, write staging (overwrite / append / period
              partitions / increment)
6. merge      INCR only: patch-merge the increment into the target, written
              as a new version and swapped in (or, where keys never move
              between periods, into the touched periods alone)

A listed period spec restricts FULL loads, whose other rows are counted as
excluded. INCR and APPEND pull past a high-water mark, which would never see a
dropped row again, so there every row goes to its own period.

Reconciliation counts what storage holds and compares it with what went in:
FULL: staged + excluded = source and the target holds the staged rows; APPEND:
target after = before + source; INCR: increment = source and target after =
base before + inserts. Malformed lines fail a load; text that does not convert
is counted as rejected values. Data only moves between Spark tasks and storage;
the driver sees counts and the watermark.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.periods import classify_period, expand_period, period_of
from lodestone.functions.types import HeaderColumn, staging_schema
from lodestone.operators.aggregates import (FOOTER_TYPES, analyze_table, exact_top, footer_max, mark_literal,
                                            observed, observed_value)
from lodestone.operators.cleanse import cleanse_projection
from lodestone.operators.merge import any_null, fold_increment, latest_version, merge_patch
from lodestone.operators.sinks import (BATCH_COL, add_partitions, append_batch, create_external,
                                       create_latest_view, current_version, finish_change, land_batch,
                                       partition_spec, partition_values, publish_batch, publish_version,
                                       read_raw, recover,
                                       remove_batch_files, replace_files, replace_partitions,
                                       resolve_format, swap_in, write_dataset)
from lodestone.session import data_files, file_of_uri, path_exists, read_text, write_text
from lodestone.sources.header import freeze_header
from lodestone.sources.rawtext import malformed_lines

STAGES = {1: "extract", 2: "raw", 3: "raw_table", 4: "staging_table",
          5: "transform", 6: "merge"}
#: The file beside a table that holds its high-water mark.
MARK = "_mark"
# Comparison operators accepted for the incremental column.
INCR_OPS = (">", ">=", "=")


class LoadError(RuntimeError):
    def __init__(self, step: int, message: str):
        super().__init__(f"stage {step} ({STAGES.get(step, '?')}): {message}")
        self.step = step


@dataclass
class LoadSpec:
    table: str
    interface: str = "stage"
    refresh: str = "FULL"              # FULL | APPEND | INCR
    keys: tuple[str, ...] = ()
    incr_col: str | None = None
    incr_op: str = ">"
    partition: str = "none"            # period spec, see functions.periods
    period_source: str | None = None   # date column a period value derives from
    raw_format: str = "TEXTFILE"
    stg_format: str = "PARQUET"
    compress: bool = True
    archive: bool = False
    dedupe_by: str | None = None
    strict_years: bool = False
    first_load: str = "error"          # INCR on an empty target: error | full
    decimal_mode: str = "exact"
    merge_strategy: str = "auto"       # auto | shuffle | files (rewrite only files with touched keys)
    keys_move: bool = True             # a key's period can change between loads
    narrow_source: bool = False        # the source arrives in a few partitions
    register_catalog: bool = False
    statistics: bool = False           # catalog statistics after the load
    latest_view: bool = False          # INCR: the catalog view <table>_view of the latest versions
    versioned: bool = False            # versions with a pointer instead of renamed folders
    freeze_header: bool = False        # the first header stays; drift stops a load
    header_key: str = ""               # tells frozen headers of several queries on a table apart
    extract_id: int | None = None


@dataclass
class Layout:
    root: str

    def raw(self, s: LoadSpec) -> str:
        suffix = "_incr" if s.refresh.upper() == "INCR" else ""
        return f"{self.root}/raw/{s.interface}_raw/{s.table}{suffix}"

    def stg(self, s: LoadSpec) -> str:
        return f"{self.root}/stg/{s.interface}/{s.table}"

    def incr(self, s: LoadSpec) -> str:
        return f"{self.root}/stg/{s.interface}/{s.table}_incr"

    def new(self, s: LoadSpec) -> str:
        return f"{self.root}/stg/{s.interface}/{s.table}_new"

    def header(self, s: LoadSpec) -> str:
        return f"{self.root}/headers/{s.interface}/{s.table}{f'-{s.header_key}' if s.header_key else ''}"

    def audit(self) -> str:
        return f"{self.root}/audit/extract_audit"


@dataclass
class LoadResult:
    status: str
    source_rows: int | None
    target_rows: int | None
    staging_path: str
    fail_step: int | None = None
    incr_col_val: str | None = None
    inserted_rows: int | None = None
    excluded_rows: int = 0             # outside the listed periods of a FULL load
    rejected_values: int = 0           # text that did not convert to its type
    malformed_lines: int = 0
    error: str | None = None
    notes: str | None = None           # what the load met and went on with
    elapsed_s: int | None = None
    started: dt.datetime = field(default_factory=dt.datetime.now)
    ended: dt.datetime | None = None


def _incr_filter(col: str, op: str, mark: Column) -> Column:
    if op not in INCR_OPS:
        raise ValueError(f"incremental operator must be one of {INCR_OPS}, got {op!r}")
    c = F.col(col)
    return {">": c > mark, ">=": c >= mark, "=": c == mark}[op]


def read_staging(spark: SparkSession, path: str, fmt: str = "PARQUET",
                 schema: T.StructType | None = None) -> DataFrame:
    """Staging rows; with the schema, also of a table without any, and with
    periods as the text they are."""
    r = spark.read.format(resolve_format(fmt))
    return (r.schema(schema) if schema else r).load(current_version(spark, path))


def _files_digest(spark: SparkSession, path: str) -> str:
    """A name for the data files that a table has now (file names carry random ids)."""
    names = "\n".join(sorted(f"{d}{n}" for d, n in data_files(spark, path)))
    return hashlib.sha256(names.encode()).hexdigest()


class _Load:
    """The steps of one run; ``step`` is the stage at work."""

    def __init__(self, spark, header, spec: LoadSpec, layout: Layout, batch_id: str, result: LoadResult):
        self.spark, self.header, self.spec, self.layout = spark, header, spec, layout
        self.batch_id, self.result, self.step = batch_id, result, 1
        self.mark = self.top = None        # (exact, text) of the mark before, and of the rows loaded
        self.touched: list[str] | None = []  # folders written; None for all

    def plan(self) -> None:
        s = self.spec
        self.refresh = s.refresh.upper()
        if self.refresh not in ("FULL", "APPEND", "INCR"):
            raise ValueError(f"refresh type must be FULL, APPEND or INCR, got {s.refresh!r}")
        period = classify_period(s.partition, s.strict_years)
        self.kind, self.part = period.kind, period.column
        literal = self.part and not period.symbolic and self.refresh == "FULL"
        self.periods = expand_period(s.partition, s.strict_years) if literal else None
        if s.versioned and (literal or self.refresh == "APPEND" or s.merge_strategy == "files"
                            or (self.part and not s.keys_move)):
            raise ValueError("a versioned table is replaced whole: by a FULL load without listed periods, a dedup or a merge")
        if s.freeze_header:
            self.header, added = freeze_header(self.spark, self.layout.header(s), self.header)
            if added:
                self.result.notes = f"the source has new columns: {', '.join(added)}"
        self.names = [c.name.strip() for c in self.header]
        self.raw_path, self.stg = self.layout.raw(s), self.layout.stg(s)

    def staged(self, path: str) -> DataFrame:
        return read_staging(self.spark, path, self.spec.stg_format, self.schema)

    # 1
    def extract(self, source: DataFrame, upper: tuple[Column, str] | Callable | None = None) -> None:
        s, part = self.spec, self.part
        src = source.select(*self.names, *([part] if part in source.columns and part not in self.names else []))
        if self.refresh in ("INCR", "APPEND"):
            if not s.incr_col:
                raise ValueError(f"{self.refresh} needs an incremental column")
            mark = None
            if path_exists(self.spark, self.stg):
                # an earlier attempt of this batch must not move the mark
                remove_batch_files(self.spark, self.stg, self.batch_id)
                mark = self.high_water() if self._has_rows() else None
            if mark is None and self.refresh == "INCR" and s.first_load != "full":
                raise ValueError("target is empty: no high-water mark for INCR "
                                 "(run FULL first or pass first_load='full')")
            if mark is not None:
                src = src.filter(_incr_filter(s.incr_col, s.incr_op, mark[0]))
                self.result.incr_col_val = mark[1]
            if callable(upper):
                upper = upper()
            if upper is not None:
                beyond = F.col(s.incr_col) > upper[0]
                # a first load also takes rows without a value: no later one would
                src = src.filter(~beyond if mark is not None else F.coalesce(~beyond, F.lit(True)))
        if part and part not in src.columns:
            if not s.period_source:
                raise ValueError(f"partition column {part!r} is not in the source; "
                                 "set period_source to derive it")
            src = src.withColumn(part, period_of(self.kind, s.period_source))
        src, obs = observed(src, f"extract-{s.table}-{self.batch_id}")
        land_batch(src, self.raw_path, self.batch_id, s.raw_format, part, s.compress, s.narrow_source)
        n = observed_value(obs)
        self.result.source_rows = None if n is None else int(n)

    def _has_rows(self) -> bool:
        return bool(data_files(self.spark, current_version(self.spark, self.stg)))

    def high_water(self) -> tuple[Column, str] | None:
        """The target's greatest value of the incremental column: as the last load
        left it, if the table still has that load's files; else from footers,
        where they hold it exactly; else by reading the column."""
        s, path = self.spec, current_version(self.spark, self.stg)
        schema = staging_schema(self.header, self.part)
        kind = schema[s.incr_col].dataType
        saved = json.loads(read_text(self.spark, f"{self.stg}/{MARK}") or "{}")
        if saved.get("column") == s.incr_col and saved.get("type") == kind.simpleString() \
                and saved.get("files") == _files_digest(self.spark, path):
            self.mark = saved["exact"], saved["text"]
        elif isinstance(kind, FOOTER_TYPES) and resolve_format(s.stg_format) == "parquet":
            row = footer_max(self.spark, path, schema, s.incr_col).select(*exact_top(F.col(s.incr_col), kind)).first()
            self.mark = (row["exact"], row["text"]) if row["exact"] is not None else None
        else:
            row = read_staging(self.spark, path, s.stg_format, schema).agg(*exact_top(F.max(s.incr_col), kind)).first()
            self.mark = (row["exact"], row["text"]) if row["exact"] is not None else None
        return (mark_literal(self.mark[0], kind), self.mark[1]) if self.mark else None

    def save_mark(self) -> None:
        """Left beside the table for the next load. Not where the greatest value
        that was loaded isn't that of the table: listed periods, or patches that
        are folded in another order."""
        s, found = self.spec, self.top or self.mark
        if not s.incr_col or not found or self.periods or (s.dedupe_by or s.incr_col) != s.incr_col \
                or self.refresh == "FULL" and not self.top:
            return
        kind = staging_schema(self.header, self.part)[s.incr_col].dataType
        told = {"column": s.incr_col, "type": kind.simpleString(), "exact": found[0], "text": found[1],
                "files": _files_digest(self.spark, current_version(self.spark, self.stg))}
        write_text(self.spark, f"{self.stg}/{MARK}", json.dumps(told))

    def replace(self, new_path: str, keep_previous: bool = True) -> None:
        """The complete ``new_path`` becomes the table."""
        self.touched = None
        if self.spec.versioned:
            publish_version(self.spark, self.stg, new_path)
        else:
            swap_in(self.spark, self.stg, new_path, keep_previous)

    # 3
    def read_batch(self, raw_only: bool) -> DataFrame:
        s, r = self.spec, self.result
        raw = read_raw(self.spark, self.raw_path, self.names, s.raw_format, self.batch_id, self.part, "_fields")
        if r.source_rows is None:
            r.source_rows = raw.count()
        if raw_only and resolve_format(s.raw_format) == "text":  # else counted by the transform
            lines = self.spark.read.schema("value string").text(f"{self.raw_path}/{BATCH_COL}={self.batch_id}")
            r.malformed_lines = int(malformed_lines(lines, len(self.names)).first()["malformed"])
        return raw

    # 4
    def register(self) -> None:
        s = self.spec
        create_external(self.spark, s.interface, s.table, self.schema, self.stg, s.stg_format, self.part)

    # 5
    def transform(self, raw: DataFrame) -> int:
        """Writes staging (the increment, for INCR); how many rows it wrote."""
        s, r, part = self.spec, self.result, self.part
        lines = Observation(f"lines-{s.table}-{self.batch_id}") if "_fields" in raw.columns else None
        if lines:
            raw = raw.observe(lines, F.count_if(F.col("_fields") != len(self.names)).alias("malformed"))
        typed = cleanse_projection(raw, self.header, part, s.decimal_mode, rejected_col="_rejected")
        inside = F.col(part).isin(self.periods) if self.periods else F.lit(True)
        obs = Observation(f"staged-{s.table}-{self.batch_id}")
        typed = typed.observe(obs, F.count_if(F.coalesce(inside, F.lit(False))).alias("kept"),
                              F.count_if(~F.coalesce(inside, F.lit(False))).alias("excluded"),
                              F.sum("_rejected").alias("rejected"), *self._observed_top(inside)) \
            .filter(inside).drop("_rejected")
        by = [part] if part else None
        if self.refresh == "INCR":
            write_dataset(typed, self.layout.incr(s), s.stg_format, "overwrite", by, s.compress)
        elif self.refresh == "APPEND":
            remove_batch_files(self.spark, self.stg, self.batch_id)
            self.before = self.count(self.stg)
            self.touched = append_batch(typed, self.stg, self.batch_id, s.stg_format, part, s.compress)
        elif self.periods:
            attempt = f"{self.stg}/_attempt_{self.batch_id}"
            write_dataset(typed, attempt, s.stg_format, "overwrite", by, s.compress)
            self.touched = replace_partitions(self.spark, self.stg, attempt, part, self.periods)
        else:
            attempt = f"{self.stg}_attempt"
            write_dataset(typed, attempt, s.stg_format, "overwrite", by, s.compress)
            self.replace(attempt, keep_previous=False)
        kept = observed_value(obs, "kept")
        if kept is None:  # an always-empty plan reports nothing
            return 0
        r.excluded_rows = int(observed_value(obs, "excluded") or 0)
        r.rejected_values = int(observed_value(obs, "rejected") or 0)
        r.malformed_lines = int(observed_value(lines, "malformed") or 0) if lines else 0
        if s.incr_col and observed_value(obs, "exact") is not None:
            self.top = observed_value(obs, "exact"), observed_value(obs, "text")
        return int(kept)

    def _observed_top(self, inside: Column) -> tuple[Column, ...]:
        if not self.spec.incr_col:
            return ()
        return exact_top(F.max(F.when(inside, F.col(self.spec.incr_col))), self.schema[self.spec.incr_col].dataType)

    def count(self, path: str, where: Column | None = None) -> int:
        if not path_exists(self.spark, path):
            return 0
        rows = self.staged(path)
        return (rows.filter(where) if where is not None else rows).count()

    def tell_catalog(self) -> None:
        """Partitions and statistics of what this load wrote, not of the whole
        table, where it wrote some partitions only."""
        s, spark = self.spec, self.spark
        name = f"{s.interface}.{s.table}"
        if s.versioned:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{current_version(spark, self.stg)}'")
        spark.catalog.refreshTable(name)
        some = partition_values(self.touched) if self.part and self.touched is not None else None
        if some is not None:
            add_partitions(spark, name, self.part, some)
        elif self.part:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        if s.statistics and some is not None:
            for value in some:
                analyze_table(spark, name, partition_spec(self.part, value))
        elif s.statistics:
            analyze_table(spark, name)
        if s.latest_view and self.refresh == "INCR":
            create_external(spark, s.interface, f"{s.table}_incr", self.schema, self.layout.incr(s), s.stg_format,
                            self.part, replace=True)
            create_latest_view(spark, s.interface, s.table, list(s.keys), s.dedupe_by or s.incr_col)

    # 6
    def merge(self) -> int:
        """Merges the written increment; the number of rows the target must have."""
        s = self.spec
        if not s.keys:
            raise ValueError("INCR needs key columns")
        recover(self.spark, self.stg)
        incr = self.staged(self.layout.incr(s))
        order = s.dedupe_by or s.incr_col
        if not path_exists(self.spark, self.stg):
            folded = fold_increment(incr, list(s.keys), order)
            write_dataset(folded, self.layout.new(s), s.stg_format, "overwrite",
                          [self.part] if self.part else None, s.compress)
            self.replace(self.layout.new(s))
            return self.count(self.stg)
        before = self.count(self.stg)
        if s.merge_strategy == "files":
            self.result.inserted_rows = merge_files(
                self.spark, self.stg, self.layout.new(s), incr, list(s.keys), order, s.stg_format, self.part,
                self.schema, s.compress, self.touched)
            return before + self.result.inserted_rows
        self.result.inserted_rows = merge_into(
            self.spark, self.stg, self.layout.new(s), incr, list(s.keys), order, s.stg_format, self.part,
            self.schema, s.compress, s.merge_strategy, scoped=bool(self.part) and not s.keys_move,
            touched=self.touched, versioned=s.versioned)
        if not self.touched:
            self.touched = None
        return before + self.result.inserted_rows

    def reconcile(self, staged: int | None) -> str | None:
        """None, or what does not add up."""
        r, wrong = self.result, []
        if r.malformed_lines:
            wrong.append(f"{r.malformed_lines} malformed raw lines")
        if staged is not None and staged + r.excluded_rows != r.source_rows:
            wrong.append(f"staged {staged} + excluded {r.excluded_rows} is not source {r.source_rows}")
        if self.refresh == "FULL" and staged is not None:
            held = self.count(self.stg, F.col(self.part).isin(self.periods) if self.periods else None)
            if held != staged:
                wrong.append(f"target holds {held} of {staged} staged rows")
            if not self.periods:
                r.target_rows = held
        if r.target_rows is None:
            r.target_rows = self.count(self.stg)
        if self.refresh == "APPEND" and staged is not None and r.target_rows != self.before + staged:
            wrong.append(f"target {r.target_rows} is not {self.before} + {staged}")
        if self.refresh == "INCR" and r.target_rows != self.expected:
            wrong.append(f"target {r.target_rows} is not the expected {self.expected}")
        return "; ".join(wrong) or None


def run_load(spark: SparkSession, source: DataFrame | None, header: list[HeaderColumn],
             spec: LoadSpec, layout: Layout, batch_id: str, start_at: int = 1,
             stop_after: str | None = None, raise_errors: bool = True,
             audit: bool = True, upper: tuple[Column, str] | Callable | None = None) -> LoadResult:
    """Runs the stages from ``start_at`` on (``source`` is only read by the
    first); ``stop_after="raw"`` keeps the raw batch alone. ``upper`` (of
    ``jdbc.upper_bound``, or a function that reads it) ends the window of an INCR
    or APPEND pull, so that rows which the source gets during the pull wait for
    the next load."""
    result = LoadResult("F", None, None, layout.stg(spec))
    load = _Load(spark, header, spec, layout, str(batch_id), result)
    t0 = time.time()
    try:
        load.plan()
        recover(spark, load.stg)
        finish_change(spark, load.stg)
        if start_at <= 1:
            load.extract(source, upper)
        load.step = 2
        if start_at <= 2:
            publish_batch(spark, load.raw_path, load.batch_id, spec.archive)
        load.step = 3
        raw = load.read_batch(stop_after == "raw")
        if stop_after == "raw":
            result.target_rows = result.source_rows
            result.error = f"{result.malformed_lines} malformed raw lines" if result.malformed_lines else None
        else:
            load.step = 5
            load.schema = staging_schema(header, load.part)
            if start_at <= 4 and spec.register_catalog:
                load.step = 4
                load.register()
            load.step, staged = 5, None
            if start_at <= 5:
                staged = load.transform(raw)
            elif load.refresh == "INCR":
                staged = load.count(layout.incr(spec))
            if load.refresh == "INCR":
                load.step = 6
                load.expected = load.merge()
            result.error = load.reconcile(staged)
            if result.error is None:
                load.save_mark()
            if spec.register_catalog:
                load.tell_catalog()
        result.status = "F" if result.error else "S"
        result.fail_step = load.step if result.error else None
        if result.error:
            result.error = f"reconciliation: {result.error}"
        return result
    except Exception as e:  # record the real failing stage, then re-raise
        result.status, result.fail_step, result.error = "F", load.step, f"{type(e).__name__}: {e}"
        if raise_errors:
            raise LoadError(load.step, str(e)) from e
        return result
    finally:
        result.ended = dt.datetime.now()
        result.elapsed_s = int(round(time.time() - t0))
        if audit:
            from lodestone.plans.audit import append_audit
            append_audit(spark, layout.audit(), spec, result, batch_id)


def merge_into(spark: SparkSession, table: str, new_path: str, incr: DataFrame, keys: list[str],
               order: str | None, fmt: str = "PARQUET", part: str | None = None, schema: T.StructType | None = None,
               compress: bool = True, strategy: str = "auto", scoped: bool = False,
               touched: list[str] | None = None, versioned: bool = False) -> int:
    """Patch-merges ``incr`` into the table at ``table``; the number of inserts.

    The whole table is written as a new version at ``new_path`` and swapped in.
    ``scoped`` is for keys that never change their period: only the partitions
    that the increment touches are read, merged and replaced, and all others
    keep their files. (Their values are listed by the driver: one per period.)
    A patch without a period touches the one that its key has in the table.
    If some key is inserted, the keys of the other partitions are read, within
    the increment's key range, and one that has moved after all ends the merge
    with the table as it was.
    ``order`` is the order of increment rows of one key; None if none repeats.
    ``touched`` gets the folders of the partitions that were replaced."""
    base = read_staging(spark, table, fmt, schema)
    incr = incr.select(*base.columns)
    if scoped:
        periods = {r[0] for r in incr.select(part).distinct().collect()}
        if None in periods:  # patches that leave the period alone: their keys' periods
            kept = incr.filter(F.col(part).isNull()).select(*keys)
            periods |= {r[0] for r in base.join(kept, keys, "left_semi").select(part).distinct().collect()}
        inside = F.coalesce(F.col(part).isin([p for p in periods if p is not None]), F.lit(None in periods))
        base, others = base.filter(inside), base.filter(~inside)
    obs = Observation("merge")
    merged = merge_patch(base, incr, keys, strategy, dedupe_by=order,
                         keep_duplicates=order is None, inserted_col="_new") \
        .observe(obs, F.count_if("_new").alias("inserted")).drop("_new")
    write_dataset(merged, new_path, fmt, "overwrite", [part] if part else None, compress)
    inserted = int(observed_value(obs, "inserted") or 0)
    if scoped:
        if inserted and not holding(others, incr, keys).isEmpty():
            raise ValueError(f"keys {keys} of the increment lie in other periods of the table: set keys_move")
        folders = replace_partitions(spark, table, new_path, part)
        if touched is not None:
            touched += folders
    elif versioned:
        publish_version(spark, table, new_path)
    else:
        swap_in(spark, table, new_path)
    return inserted


#: Types whose least and greatest values are passed on to the scan as literals.
_RANGED = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.StringType, T.DecimalType)


def holding(rows: DataFrame, incr: DataFrame, keys: list[str]) -> DataFrame:
    """The ``rows`` (a read of files) that have a key of ``incr``, read within the
    first key's range, which Parquet's statistics use to skip row groups."""
    wanted = incr.filter(~any_null(keys)).select(*keys)
    first, kind = F.col(keys[0]), rows.schema[keys[0]].dataType
    if isinstance(kind, _RANGED):
        low, high = wanted.agg(F.min(first), F.max(first)).first()
        rows = rows.filter(first.between(F.lit(low).cast(kind), F.lit(high).cast(kind))
                           if low is not None else F.lit(False))
    return rows.join(wanted, keys, "left_semi")


def touched_files(base: DataFrame, incr: DataFrame, keys: list[str]) -> list[str]:
    """URIs of the files of ``base`` (a read of files) that hold a key of
    ``incr``. Only key columns are read. The list is at most that of the
    table's files, which the driver holds for any scan of it."""
    held = base.select(*keys, F.col("_metadata.file_path").alias("_file"))
    return sorted(r[0] for r in holding(held, incr, keys).select("_file").distinct().collect())


def merge_files(spark: SparkSession, table: str, new_path: str, incr: DataFrame, keys: list[str],
                order: str | None, fmt: str = "PARQUET", part: str | None = None,
                schema: T.StructType | None = None, compress: bool = True,
                touched: list[str] | None = None) -> int:
    """Patch-merges ``incr`` into the table at ``table`` by copy on write; the
    number of inserts.

    A row that the increment changes lies in a file that holds its key, whatever
    period it is in or goes to. So only files with such keys are read whole,
    merged, and replaced by what comes of them and the inserts; every other file
    keeps its name and is not read but for its key column. A row that changes its
    period leaves the file of the old one and is written to the new one."""
    base = read_staging(spark, table, fmt, schema)
    incr = incr.select(*base.columns)
    uris = touched_files(base, incr, keys)
    reader = spark.read.format(resolve_format(fmt)).schema(base.schema).option("basePath", table)
    paths = [file_of_uri(spark, u) for u in uris]
    old = reader.load(paths) if paths else base.filter(F.lit(False))
    obs = Observation("merge-files")
    merged = merge_patch(old, incr, keys, dedupe_by=order, keep_duplicates=order is None, inserted_col="_new") \
        .observe(obs, F.count_if("_new").alias("inserted")).drop("_new")
    write_dataset(merged, new_path, fmt, "overwrite", [part] if part else None, compress)
    root = file_of_uri(spark, table).rstrip("/")
    folders = replace_files(spark, table, new_path, [_below(p, root) for p in paths])
    if touched is not None:
        touched += folders
    return int(observed_value(obs, "inserted") or 0)


def _below(path: str, root: str) -> str:
    """``path`` less ``root``; either may lack the scheme that the other has."""
    at = path.rfind(f"{_plain(root)}/")
    if at < 0:
        raise ValueError(f"{path} is not below {root}")
    return path[at + len(_plain(root)) + 1:]


def _plain(path: str) -> str:
    """A path without scheme and authority."""
    if "://" in path:
        return "/" + path.split("://", 1)[1].partition("/")[2]
    return path.split(":", 1)[1] if path.startswith("file:") else path


def dedup_swap(spark: SparkSession, spec: LoadSpec, layout: Layout,
               ts: str = "extract_ts") -> int:
    """Latest version of (target UNION ALL increment) written as ``<t>_new``,
    then swapped in; the previous version stays at ``<t>_new``."""
    stg, incr_path, new_path = layout.stg(spec), layout.incr(spec), layout.new(spec)
    recover(spark, stg)
    base = read_staging(spark, stg, spec.stg_format)
    incr = read_staging(spark, incr_path, spec.stg_format)
    period = classify_period(spec.partition, spec.strict_years)
    latest = latest_version(base, incr, list(spec.keys), ts)
    out, obs = observed(latest, f"dedup-{spec.table}")
    write_dataset(out, new_path, spec.stg_format, "overwrite", [period.column] if period.column else None,
                  spec.compress)
    if spec.versioned:
        publish_version(spark, stg, new_path)
    else:
        swap_in(spark, stg, new_path)
    n = observed_value(obs)
    return int(n) if n is not None else read_staging(spark, stg, spec.stg_format).count()


__all__ = ["LoadSpec", "Layout", "LoadResult", "LoadError", "run_load", "merge_into", "merge_files",
           "touched_files", "dedup_swap",
           "read_staging", "STAGES", "BATCH_COL"]

"""Period partition specs: classification and expansion.

A partition spec is one of

* ``none``                      no partitioning
* ``FY2014`` / ``FY2014-FY2016`` fiscal years     -> column ``year``
* ``2014Q1`` / ``2014Q1-2015Q2`` quarters         -> column ``quarter``
* ``201401`` / ``201411-201502`` months           -> column ``month``
* ``year`` / ``quarter`` / ``month``               symbolic: the partition
  value comes from the data itself (dynamic partitioning)

Specs are matched case-insensitively. A descending range yields the same set
as the ascending one, sorted. By default any four-digit year is accepted;
``strict_years=True`` keeps the historical windows (2000-2019 for months and
quarters, 2009-2016 for fiscal years).
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fiscal years accepted under strict_years.
STRICT_FISCAL_YEARS = ("2009", "2010", "2011", "2012", "2013", "2014", "2015", "2016")
# Year window of month and quarter specs under strict_years.
STRICT_YEAR_PATTERN = r"20[01][0-9]"
ANY_YEAR_PATTERN = r"[0-9]{4}"
SYMBOLIC = ("year", "quarter", "month")
UNKNOWN_SPEC = "not a period spec: {!r} (none, year, quarter, month, FY2014, 2014Q1, 201401, or a range)"


@dataclass(frozen=True)
class PeriodSpec:
    kind: str            # none | year | quarter | month
    column: str | None   # partition column name
    symbolic: bool       # value comes from the data
    first: str | None = None
    last: str | None = None


def _patterns(strict: bool):
    y = STRICT_YEAR_PATTERN if strict else ANY_YEAR_PATTERN
    month = rf"{y}(0[1-9]|1[0-2])"
    quarter = rf"{y}Q[1-4]"
    year = r"FY[0-9]{4}"
    return month, quarter, year


def classify_period(spec: str | None, strict_years: bool = False) -> PeriodSpec:
    if spec is None or spec.strip().lower() in ("none", ""):
        return PeriodSpec("none", None, False)
    s = spec.strip()
    if s.lower() in SYMBOLIC:
        return PeriodSpec(s.lower(), s.lower(), True)
    s = s.upper()
    month, quarter, year = _patterns(strict_years)
    for kind, pat in (("year", year), ("quarter", quarter), ("month", month)):
        if re.fullmatch(rf"{pat}(?:-{pat})?", s):
            first, _, last = s.partition("-")
            last = last or first
            if kind == "year" and strict_years:
                for v in (first, last):
                    if v[2:] not in STRICT_FISCAL_YEARS:
                        raise ValueError(UNKNOWN_SPEC.format(spec))
            return PeriodSpec(kind, kind, False, first, last)
    raise ValueError(UNKNOWN_SPEC.format(spec))


#: Months between the first days of neighbouring periods.
STRIDE = {"year": 12, "quarter": 3, "month": 1}


def first_day(kind: str, label: str) -> dt.date:
    """The first day of the period with this label."""
    year = int(label[2:6] if kind == "year" else label[:4])
    if kind == "quarter":
        return dt.date(year, 3 * int(label[5]) - 2, 1)
    return dt.date(year, int(label[4:]) if kind == "month" else 1, 1)


def period_frame(spark: SparkSession, spec: str, strict_years: bool = False) -> DataFrame:
    """The periods of a spec as a one-column DataFrame named after the kind:
    a sequence of first days, each labelled as data of that day would be."""
    p = classify_period(spec, strict_years)
    if p.kind == "none" or p.symbolic:
        raise ValueError(f"spec {spec!r} has no literal periods")
    ends = sorted(first_day(p.kind, x) for x in (p.first, p.last))
    days = F.sequence(*[F.lit(d) for d in ends], F.expr(f"interval {STRIDE[p.kind]} months"))
    return spark.range(1).select(F.explode(days).alias("day")) \
                .select(period_of(p.kind, "day").alias(p.kind))


def expand_period(spec: str, strict_years: bool = False) -> list[str]:
    """All period labels of a spec, ascending (a spec has at most some
    hundreds): the calendar steps from the earlier end to the later."""
    p = classify_period(spec, strict_years)
    if p.kind == "none" or p.symbolic:
        return []
    low, high = sorted(first_day(p.kind, x) for x in (p.first, p.last))
    months = (high.year - low.year) * 12 + high.month - low.month
    days = [dt.date(low.year + (low.month - 1 + k) // 12, (low.month - 1 + k) % 12 + 1, 1)
            for k in range(0, months + 1, STRIDE[p.kind])]
    return [period_label(p.kind, d) for d in days]


def period_label(kind: str, day: dt.date) -> str:
    if kind == "year":
        return f"FY{day:%Y}"
    return f"{day:%Y%m}" if kind == "month" else f"{day:%Y}Q{(day.month + 2) // 3}"


def valid_fiscal_years(years=STRICT_FISCAL_YEARS) -> list[str]:
    """Single fiscal years, then every range of them, one-year ranges included."""
    return [f"FY{y}" for y in years] + [
        f"FY{a}-FY{b}" for a, b in combinations_with_replacement(sorted(years), 2)]


def period_of(kind: str, ts: Column | str) -> Column:
    """Period label of a date/timestamp column: 199511, 1995Q4, FY1995."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if kind == "month":
        return F.date_format(c, "yyyyMM")
    if kind == "quarter":
        return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))
    if kind == "year":
        return F.concat(F.lit("FY"), F.year(c).cast("string"))
    raise ValueError(f"unknown period kind {kind!r}")

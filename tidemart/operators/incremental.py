"""Choosing what a run has to read: watermarks, file ledgers, lookback windows, run modes."""
from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.dates import date_to_key, lookback_key, recent_months
from tidemart.operators.clean import keep_outside
from tidemart.operators.write import append, observed, once, replace_slice
from tidemart.sources.tables import exists, scan_or_empty


def max_of(df: DataFrame, col: str):
    """Largest value, or None for an empty frame. One row reaches the driver."""
    return df.agg(F.max(col)).first()[0]


def span_of(df: DataFrame, col: str):
    row = df.agg(F.min(col), F.max(col)).first()
    return row[0], row[1]


def watermark(spark: SparkSession, table: str, col: str):
    """Largest stored value of ``col``; None when the table is missing or empty."""
    return max_of(spark.table(table), col) if exists(spark, table) else None


def increment_since(source: DataFrame, mark, time_col: str, lookback_days: int = 0) -> DataFrame:
    """Source rows after the watermark; everything when there is none. ``lookback_days`` re-reads
    a tail for late rows, to be merged by key; 0 reads strictly newer rows only. ``time_col`` may
    be text, parsed leniently."""
    if mark is None:
        return source
    t = F.col(time_col)
    if dict(source.dtypes)[time_col] == "string":
        t = t.try_cast("timestamp")
    if lookback_days:
        return source.where(t >= F.lit(mark - timedelta(days=lookback_days)))
    return source.where(t > F.lit(mark))


# Fixed value: columns of the ledger of landed files. A file is known by its place, length and time of writing, so one sent again is new.
LANDED = "source STRING, path STRING, length BIGINT, modified TIMESTAMP, run BIGINT"
_SAME = ("path", "length", "modified")


def new_files(spark: SparkSession, files: DataFrame, ledger: str, source: str) -> tuple[DataFrame, int]:
    """Landed files (``path, length, modified, …``) that the ledger of ``source`` doesn't hold, and how many. The choice is kept in the shared folder: what a run
    reads and what it records stay the same set, whatever lands meanwhile."""
    from pyspark.sql.types import StructType

    done = scan_or_empty(spark, ledger, StructType.fromDDL(LANDED)).where(F.col("source") == source)
    fresh, n, _ = once(files.join(done.select(*_SAME), list(_SAME), "left_anti"))
    return fresh, n


def next_run(spark: SparkSession, ledger: str, source: str) -> int:
    """The number of the next run of a source: 1, 2, 3 …"""
    if not exists(spark, ledger):
        return 1
    return (max_of(spark.table(ledger).where(F.col("source") == source), "run") or 0) + 1


def record_run(files: DataFrame, ledger: str, source: str, run: int) -> int:
    """Enter the files of a run, after their rows are stored: a run cut off in between reads them again."""
    return append(files.select(F.lit(source).alias("source"), *_SAME, F.lit(run).cast("bigint").alias("run")), ledger)


def consumed(spark: SparkSession, marks: str, consumer: str) -> int:
    """The last run of raw rows that a consumer has taken; 0 before the first."""
    if not exists(spark, marks):
        return 0
    return max_of(spark.table(marks).where(F.col("consumer") == consumer), "run") or 0


def mark_consumed(spark: SparkSession, marks: str, consumer: str, run: int) -> None:
    append(spark.createDataFrame([(consumer, run)], "consumer STRING, run BIGINT"), marks)


def rebuild_days(fact: str, source: DataFrame, days: Iterable[date], build: Callable[[DataFrame], DataFrame], time_col: str,
                 key: str = "date_key") -> dict[str, int]:
    """Build exactly the given days of a fact again, whatever lies between them. Of a source partitioned by ``year, month`` only the days'
    partitions are listed, and in them only the days' rows are aggregated; of the fact only the touched years are rewritten, with the
    rows of other days as they are. Returns days, rows built and rows written. The set of days is bounded by the calendar."""
    days = sorted(set(days))
    if not days:
        return {"days": 0, "built": 0, "written": 0}
    months = sorted({(d.year, d.month) for d in days})
    if {"year", "month"} <= set(source.columns):
        source = source.where(F.struct("year", "month").isin([F.struct(F.lit(y), F.lit(m)) for y, m in months]))
    rows = source.where(F.to_date(time_col).isin(days))
    seen = Observation()
    new = build(rows).observe(seen, F.count(F.lit(1)).alias("rows"))
    years = {d.year for d in days}
    written = replace_slice(new, fact, ~F.col(key).isin([date_to_key(d) for d in days]), lambda s: s["year"].isdigit() and int(s["year"]) in years)
    return {"days": len(days), "built": observed(seen)["rows"], "written": written}


def tail_cutoff(max_key: int, days: int) -> tuple[int, date]:
    """Key and date from which a fact is aggregated again: ``days`` before its newest key."""
    key = lookback_key(max_key, days)
    return key, date(key // 10000, key // 100 % 100, key % 100)


def tail_of(source: DataFrame, cutoff: date, time_col: str, partitioned: bool = True) -> DataFrame:
    """Source rows from ``cutoff`` on. The time filter alone cannot prune ``year``/``month``
    partitions, so the same bound is stated on them too, in comparisons with literals that a catalog can evaluate itself."""
    df = source.where(F.col(time_col) >= F.lit(datetime(cutoff.year, cutoff.month, cutoff.day)))
    if partitioned:
        df = df.where((F.col("year") > cutoff.year) | ((F.col("year") == cutoff.year) & (F.col("month") >= cutoff.month)))
    return df


def reaggregated(fact: DataFrame, source: DataFrame, build: Callable[[DataFrame], DataFrame],
                 time_col: str, days: int = 7, key: str = "date_key",
                 partitioned: bool = True, newest: int | None = None) -> DataFrame:
    """The fact after its last ``days`` were built again from the source; a full build when the
    fact is empty. ``newest`` is its newest key where the caller knows it; without it the fact is
    evaluated once more for it, which a stored one answers from one column."""
    newest = max_of(fact, key) if newest is None else newest
    if newest is None:
        return build(source)
    cut_key, cut = tail_cutoff(newest, days)
    tail = build(tail_of(source, cut, time_col, partitioned))
    return fact.where(keep_outside(key, cut_key)).unionByName(tail)


def in_recent_months(df: DataFrame, today: date, year: str = "year", month: str = "month") -> DataFrame:
    """Rows of the current and the previous month, by partition columns."""
    (y0, m0), (y1, m1) = recent_months(today)
    return df.where(((F.col(year) == y0) & (F.col(month) == m0)) | ((F.col(year) == y1) & (F.col(month) == m1)))


def is_current(source_rows: int, target_rows: int) -> bool:
    """A filled target with as many rows as its source needs no work."""
    return target_rows > 0 and source_rows == target_rows


def run_mode(spark: SparkSession, table: str, force_refresh: bool) -> str:
    """``full`` when forced or when the table is missing or empty, else ``incremental``."""
    if force_refresh or not exists(spark, table) or spark.table(table).isEmpty():
        return "full"
    return "incremental"


def guard_source(df: DataFrame, mode: str, what: str) -> bool:
    """True when there is something to load. An empty full read is an error, an empty increment
    a skip. Reads at most one row of the source."""
    if not df.isEmpty():
        return True
    if mode == "full":
        raise ValueError(f"{what}: the full read found no rows")
    return False


def period_list(df: DataFrame, keys: Sequence[str] = ("year", "month")) -> DataFrame:
    return df.select(*keys).distinct()

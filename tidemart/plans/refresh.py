"""One refresh of all layers, full or incremental: landed files → raw tables → clean → star."""
from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.dates import year_of_key
from tidemart.operators import incremental as I
from tidemart.operators import write as W
from tidemart.operators.clean import active_between, drop_blank_rows, in_years, keep_outside, within_box, year_bounds
from tidemart.plans import contracts as C
from tidemart.plans import gold, silver
from tidemart.sources import nested, parquet_drift, tables, text
from tidemart.sources.files import NAMED_FILES, landed, only

# The city's bounding box, raw layouts.
CITY_BOX = (40.4, 40.9, -74.3, -73.7)
ZONE_RENAMES = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}
FX_COLUMNS = {"TIME_PERIOD": "date", "OBS_VALUE": "usd_eur_rate"}
READING_DDL = ("location_id BIGINT, sensors_id BIGINT, location STRING, datetime STRING, lat DOUBLE, "
               "lon DOUBLE, parameter STRING, units STRING, value DOUBLE")
HOURLY = ("temperature_2m", "apparent_temperature", "precipitation", "wind_speed_10m",
          "relative_humidity_2m", "weather_code")
HOURLY_DDL = ("latitude DOUBLE, longitude DOUBLE, hourly STRUCT<time: ARRAY<STRING>, temperature_2m: ARRAY<DOUBLE>, "
              "apparent_temperature: ARRAY<DOUBLE>, precipitation: ARRAY<DOUBLE>, wind_speed_10m: ARRAY<DOUBLE>, "
              "relative_humidity_2m: ARRAY<DOUBLE>, weather_code: ARRAY<BIGINT>>")


@dataclass(frozen=True)
class Config:
    database: str
    landing: str
    year_start: int
    year_end: int
    force_refresh: bool = False
    today: date | None = None
    #: Days before the newest of a fact that an incremental run builds again besides those it touches.
    lookback_days: int = 0

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def source(self, name: str) -> str:
        return f"{self.landing.rstrip('/')}/{name}"


def _stations(spark: SparkSession, cfg: Config) -> DataFrame:
    lo, hi = year_bounds(cfg.year_start, cfg.year_end)
    raw = spark.table(cfg.table("raw_locations"))
    near = raw.where(within_box("latitude", "longitude", CITY_BOX))
    return active_between(near, lo, hi).select("location_id")


def _months(cfg: Config) -> list[tuple[int, int]]:
    return [(y, m) for y in range(cfg.year_start, cfg.year_end + 1) for m in range(1, 13)]


#: Raw tables of files are logs: each run adds the rows of its new files under its own number.
RUN_PARTS = ["year", "ingest_run"]


def _runs(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Partitions of a raw log, from the catalog; no data is read."""
    return W.stored_partitions(spark, table) if tables.exists(spark, table) else []


def _last_run(spark: SparkSession, table: str) -> int:
    return max((int(s["ingest_run"]) for s in _runs(spark, table)), default=0)


def _log_mode(spark: SparkSession, cfg: Config, table: str) -> str:
    """``full`` also where the stored table is not a log yet."""
    if tables.exists(spark, table) and W.partition_columns(spark, table) != RUN_PARTS:
        return "full"
    return I.run_mode(spark, table, cfg.force_refresh)


def _log_files(spark: SparkSession, cfg: Config, name: str, files: DataFrame, read) -> int | None:
    """Read the landed files that the ledger doesn't hold (all of them in a full run) and add their rows to a raw log; rows written, or None if there is
    nothing new. ``read(files)`` gives the rows, of every file for None. A full run replaces the years of the range and keeps the others, and
    rows without a readable time, which belong to no year."""
    t, ledger = cfg.table(name), cfg.table("landed_files")
    mode = _log_mode(spark, cfg, t)
    todo, n = I.new_files(spark, files, ledger, name) if mode == "incremental" else W.once(files)[:2]
    if not n:
        if mode == "full":
            raise ValueError(f"{t}: the full read found no files")
        return None
    run = max(I.next_run(spark, ledger, name), _last_run(spark, t) + 1)
    new = read(todo if mode == "incremental" else None)
    new = new.withColumn("year", F.year(F.col("datetime").try_cast("timestamp"))).withColumn("ingest_run", F.lit(run).cast("bigint"))
    if mode == "incremental":
        rows = W.append(new, t)
    else:
        new = new.where(F.col("year").isNull() | F.col("year").between(cfg.year_start, cfg.year_end))
        if not I.guard_source(new, mode, t):
            return None
        if tables.exists(spark, t) and W.partition_columns(spark, t) == RUN_PARTS:
            rows = W.replace_partitions(new, t, lambda s: s["year"].isdigit() and cfg.year_start <= int(s["year"]) <= cfg.year_end)
        else:
            rows = W.write_full(new, t, RUN_PARTS)
    I.record_run(todo, ledger, name, run)
    return rows


def load_raw(spark: SparkSession, cfg: Config) -> dict[str, int]:
    """Reference data whole; readings and weather by file, whatever day a file is about and whenever it lands. Trips stay as landed files."""
    done: dict[str, int] = {}
    stations = nested.read_station_pages(spark, cfg.source("locations"))
    t = cfg.table("raw_locations")
    have = spark.table(t).count() if tables.exists(spark, t) else 0
    if cfg.force_refresh or not I.is_current(stations.count(), have):
        done["raw_locations"] = W.write_full(stations, t)

    t = cfg.table("raw_zones")
    if I.run_mode(spark, t, cfg.force_refresh) == "full":
        zones = text.read_csv_table(spark, cfg.source("zones"), ZONE_RENAMES, {"location_id": "int"})
        done["raw_zones"] = W.write_full(zones, t)

    fx = text.read_narrow_csv(spark, cfg.source("fx"), FX_COLUMNS, {"date": "date", "usd_eur_rate": "double"})
    done["raw_fx"] = W.write_full(fx, cfg.table("raw_fx"))
    gdp = nested.read_indexed_json(spark, cfg.source("gdp"), 1, nested.GDP_RECORD, nested.GDP_FIELDS)
    done["raw_gdp"] = W.write_full(gdp.withColumn("year", F.col("year").try_cast("int")), cfg.table("raw_gdp"))

    base, near = cfg.source("measurements"), _stations(spark, cfg)
    folders = text.archive_folders(spark, base, _months(cfg), near)
    if folders or _log_mode(spark, cfg, cfg.table("raw_measurements")) == "full":
        if not folders:
            raise ValueError("no archive folders in the year range")
        rows = _log_files(spark, cfg, "raw_measurements", landed(spark, *folders),
                          lambda files: text.read_archive(spark, base, READING_DDL, near, _months(cfg), files).drop("locationid", "month", "year"))
        if rows is not None:
            done["raw_measurements"] = rows

    def weather(files: DataFrame | None) -> DataFrame:
        pages = spark.read.schema(HOURLY_DDL).option("multiLine", True).json(cfg.source("weather"))
        pages = (pages if files is None else only(pages, files)).select(
            "*", F.col("_metadata.file_modification_time").alias("file_modified"), F.col("_metadata.file_path").alias("file"))
        hours = nested.explode_parallel(pages, "time", HOURLY, keep=("latitude", "longitude", "file_modified", "file"), struct="hourly")
        return W.stamped(hours.withColumnRenamed("time", "datetime"))
    rows = _log_files(spark, cfg, "raw_weather", landed(spark, cfg.source("weather")), weather)
    if rows is not None:
        done["raw_weather"] = rows
    return done


def _pending(spark: SparkSession, cfg: Config, fact: str) -> set[date]:
    """Days that a run cut off before its facts were built has left to build."""
    t = cfg.table("touched_days")
    return {r[0] for r in spark.table(t).where(F.col("fact") == fact).select("day").distinct().collect()} if tables.exists(spark, t) else set()


def _touch(spark: SparkSession, cfg: Config, fact: str, days: set[date]) -> None:
    """Note days before the rows that touch them are stored, so that no failure in between hides them."""
    if days:
        W.append(spark.createDataFrame([(fact, d) for d in sorted(days)], "fact STRING, day DATE"), cfg.table("touched_days"))


def _settled(spark: SparkSession, cfg: Config, fact: str) -> None:
    t = cfg.table("touched_days")
    if _pending(spark, cfg, fact):
        W.write_full(spark.table(t).where(F.col("fact") != fact), t)


Touched = dict[str, set]


def _insert(spark: SparkSession, cfg: Config, clean: DataFrame, contract: C.Contract, fact: str, day: str, touched: Touched | None,
            merge_schema: bool = False) -> int:
    """Insert rows with new keys and note the days they touch: first all days of the increment, in the end those of the rows added."""
    before = _pending(spark, cfg, fact)
    increment = W.once(clean, contract.parts)
    days = {r[0] for r in increment.frame.select(F.to_date(day)).distinct().collect()}  # bounded by the calendar
    _touch(spark, cfg, fact, days - before)
    rows, added = W.merge_insert_touching(increment, cfg.table(contract.name), contract.keys, F.to_date(day), merge_schema)
    if touched is not None:
        touched.setdefault(fact, set()).update(before | added)
    return rows


def _load_trips(spark: SparkSession, cfg: Config, touched: Touched | None = None) -> int:
    """Trip files by name period: all of the year range, or those the ledger does not hold."""
    t, ledger, name = cfg.table(C.TRIPS.name), cfg.table("landed_files"), C.TRIPS.name
    mode = I.run_mode(spark, t, cfg.force_refresh)
    # the period stands in the file's name or in that of its folder, where a writer made many files of it
    files = parquet_drift.list_files(spark, cfg.source("trips")).withColumn("named", F.concat_ws("/", F.element_at(F.split("parent", "/"), -1), "file"))
    files = parquet_drift.files_for_years(files, cfg.year_start, cfg.year_end, column="named")
    todo, n = I.new_files(spark, files, ledger, name) if mode == "incremental" else W.once(files)[:2]
    if not n:
        if mode == "full":
            raise ValueError("no trip files in the year range")
        return 0
    few = n <= NAMED_FILES
    units = parquet_drift.file_units(todo) if mode == "incremental" and few else parquet_drift.period_units(todo)
    groups = parquet_drift.generations(spark, units)
    raw = parquet_drift.read_drifting(spark, groups, silver.TRIP_CASE, silver.TRIP_CASTS, None if mode == "full" or few else todo)
    clean = in_years(silver.trips(raw), cfg.year_start, cfg.year_end)
    if mode == "full":
        rows = W.write_range(clean, t, C.TRIPS.parts, cfg.year_start, cfg.year_end, merge_schema=True)
    else:
        # rows of a file already stored (a run cut off before its ledger entry) do not come twice
        rows = _insert(spark, cfg, clean, C.TRIPS, C.TRIP_FACT.name, "pickup_datetime", touched, merge_schema=True)
    I.record_run(todo, ledger, name, I.next_run(spark, ledger, name))
    return rows


def _load_readings(spark: SparkSession, cfg: Config, touched: Touched | None = None) -> int:
    """Readings of the year range. An increment is cleaned from the raw runs not taken yet, found by their partition: neither older raw rows nor
    clean rows of other months are read, and no mark of time can hide a late or future reading. Of readings that tie, the first as they landed counts."""
    t, c, marks = cfg.table(C.MEASUREMENTS.name), C.MEASUREMENTS, cfg.table("run_marks")
    raw, newest = spark.table(cfg.table("raw_measurements")), _last_run(spark, cfg.table("raw_measurements"))
    if I.run_mode(spark, t, cfg.force_refresh) == "full":
        rows = W.write_range(in_years(silver.measurements(raw, as_landed=True), cfg.year_start, cfg.year_end), t, c.parts, cfg.year_start, cfg.year_end, merge_schema=True)
    else:
        last = I.consumed(spark, marks, c.name)
        if newest <= last:
            return 0
        clean = in_years(silver.measurements(raw.where(F.col("ingest_run") > last), as_landed=True), cfg.year_start, cfg.year_end)
        rows = _insert(spark, cfg, clean, c, C.AIR_FACT.name, "datetime", touched)
    I.mark_consumed(spark, marks, c.name, newest)
    return rows


def _load_weather(spark: SparkSession, cfg: Config) -> int:
    """Hours of the year range. Of an hour that several files hold, the newest file's counts, whenever it lands: for the hours of new raw runs the rows of
    their years are looked at again."""
    t, c, marks = cfg.table(C.WEATHER.name), C.WEATHER, cfg.table("run_marks")
    log = cfg.table("raw_weather")
    raw, newest = spark.table(log), _last_run(spark, log)
    if I.run_mode(spark, t, cfg.force_refresh) == "full":
        rows = W.write_range(in_years(silver.weather(raw), cfg.year_start, cfg.year_end), t, c.parts, cfg.year_start, cfg.year_end, merge_schema=True)
    else:
        last = I.consumed(spark, marks, c.name)
        if newest <= last:
            return 0
        years = {int(s["year"]) for s in _runs(spark, log) if int(s["ingest_run"]) > last and s["year"].isdigit()}
        at = F.col("datetime").try_cast("timestamp").alias("__at")
        hours = raw.where(F.col("ingest_run") > last).select("latitude", "longitude", at).distinct().alias("n")
        same = F.expr("r.latitude <=> n.latitude AND r.longitude <=> n.longitude AND r.__at = n.__at")
        again = raw.where(F.col("year").isin(sorted(years))).select("*", at).alias("r").join(hours, same, "left_semi").drop("__at")
        rows = W.merge_upsert(in_years(silver.weather(again), cfg.year_start, cfg.year_end), t, c.keys)
    I.mark_consumed(spark, marks, c.name, newest)
    return rows


def build_silver(spark: SparkSession, cfg: Config, touched: Touched | None = None) -> dict[str, int]:
    """Clean tables; ``touched`` gets, by fact, the days of the trips and of the readings that this run added."""
    raw = lambda n: spark.table(cfg.table(n))
    out = {
        C.FX.name: W.write_full(silver.fx_rates(raw("raw_fx")), cfg.table(C.FX.name)),
        C.GDP.name: W.write_full(silver.gdp(raw("raw_gdp")), cfg.table(C.GDP.name)),
        C.LOCATIONS.name: W.write_full(silver.locations(raw("raw_locations")), cfg.table(C.LOCATIONS.name)),
        C.ZONES.name: W.write_full(silver.zones(drop_blank_rows(raw("raw_zones"))), cfg.table(C.ZONES.name)),
        C.TRIPS.name: _load_trips(spark, cfg, touched),
        C.MEASUREMENTS.name: _load_readings(spark, cfg, touched),
        C.WEATHER.name: _load_weather(spark, cfg),
    }
    return out


def _load_fact(spark: SparkSession, cfg: Config, contract: C.Contract, source: DataFrame, time_col: str, build, days: set[date]) -> int:
    """Build the year range, or exactly the days that new rows or changed dimension rows touch."""
    t = cfg.table(contract.name)
    newest = None if cfg.force_refresh else I.watermark(spark, t, "date_key")
    if newest is None:
        lo, hi = cfg.year_start * 10000 + 101, cfg.year_end * 10000 + 1231
        new = build(in_years(source, cfg.year_start, cfg.year_end))
        if not tables.exists(spark, t):
            rows = W.write_full(new, t, contract.parts)
        else:
            rows = W.replace_slice(new, t, keep_outside("date_key", lo, hi),
                                   lambda s: s["year"].isdigit() and cfg.year_start <= int(s["year"]) <= cfg.year_end)
    else:
        if cfg.lookback_days:
            end = I.tail_cutoff(newest, 0)[1]
            days = days | {end - timedelta(days=k) for k in range(cfg.lookback_days + 1)}
        rows = I.rebuild_days(t, source, days, build, time_col)["built"]
    _settled(spark, cfg, contract.name)
    return rows


def _changed(spark: SparkSession, table: str, new: DataFrame, matter: list[str]) -> DataFrame | None:
    """Rows of a dimension (columns ``matter``) that the stored one lacks or alone has; None before the first write."""
    if not tables.exists(spark, table):
        return None
    old, now = spark.table(table).select(*matter), new.select(*matter)
    return now.exceptAll(old).unionByName(old.exceptAll(now))


def _days_of(source: DataFrame, col: str, changed: DataFrame | None, key: str, time_col: str) -> set[date]:
    """Days of the source rows that refer to changed dimension rows."""
    if changed is None or changed.isEmpty():
        return set()
    ids = changed.select(F.col(key).alias(col)).distinct()
    return {r[0] for r in source.join(ids, col, "left_semi").select(F.to_date(time_col)).distinct().collect()}


def build_gold(spark: SparkSession, cfg: Config, touched: Touched | None = None) -> dict[str, int]:
    clean = lambda c: spark.table(cfg.table(c.name))
    t = cfg.table(C.DIM_DATE.name)
    stored = I.span_of(spark.table(t), "year") if tables.exists(spark, t) else (None, None)
    out = {
        C.DIM_DATE.name: W.write_full(gold.dim_date(spark, cfg.year_start, cfg.year_end, stored), t),
        C.DIM_GDP.name: W.write_full(gold.dim_gdp(clean(C.GDP), registry=cfg.table("gdp_keys")), cfg.table(C.DIM_GDP.name)),
    }
    zones = W.once(gold.dim_zone(clean(C.ZONES))).frame
    rates = W.once(gold.dim_fx(clean(C.FX), cfg.table("fx_keys"))).frame
    about = ["location_id", "location_name", "country_name", "latitude", "longitude"]
    places = W.once(clean(C.LOCATIONS).select(*about)).frame
    days = {f: touched[f] if touched and f in touched else _pending(spark, cfg, f) for f in (C.TRIP_FACT.name, C.AIR_FACT.name)}
    by_dimension = {C.TRIP_FACT.name: set(), C.AIR_FACT.name: set()}
    news = _changed(spark, cfg.table(C.DIM_FX.name), rates, ["date", "usd_eur_rate"])
    if news is not None:
        by_dimension[C.TRIP_FACT.name] |= {r[0] for r in news.select("date").distinct().collect() if r[0]}
    news = _changed(spark, cfg.table(C.DIM_ZONE.name), zones, ["location_id"])
    by_dimension[C.TRIP_FACT.name] |= _days_of(clean(C.TRIPS), "pu_location_id", news, "location_id", "pickup_datetime")
    news = _changed(spark, cfg.table("fact_places"), places, about)
    by_dimension[C.AIR_FACT.name] |= _days_of(clean(C.MEASUREMENTS), "location_id", news, "location_id", "datetime")
    for fact, more in by_dimension.items():
        _touch(spark, cfg, fact, more - days[fact])
        days[fact] = days[fact] | more
    out[C.DIM_ZONE.name] = W.write_full(zones, cfg.table(C.DIM_ZONE.name))
    out[C.DIM_FX.name] = W.write_full(rates, cfg.table(C.DIM_FX.name))
    W.write_full(places, cfg.table("fact_places"))  # what the air fact was last built with
    fx, zone = clean(C.DIM_FX), clean(C.DIM_ZONE)
    out[C.TRIP_FACT.name] = _load_fact(spark, cfg, C.TRIP_FACT, clean(C.TRIPS), "pickup_datetime", lambda df: gold.trip_fact(df, fx, zone), days[C.TRIP_FACT.name])
    out[C.AIR_FACT.name] = _load_fact(spark, cfg, C.AIR_FACT, clean(C.MEASUREMENTS), "datetime", lambda df: gold.air_fact(df, clean(C.LOCATIONS)),
                                      days[C.AIR_FACT.name])
    return out


def verify(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """Counts to look at after a load."""
    trip = spark.table(cfg.table(C.TRIP_FACT.name))
    air = spark.table(cfg.table(C.AIR_FACT.name))
    return {
        "trip_nulls": trip.agg(F.count("*").alias("rows"), F.count_if(F.col("zone_key").isNull()).alias("no_zone"),
                               F.count_if(F.col("fx_key").isNull()).alias("no_rate")),
        "trip_years": trip.groupBy(year_of_key("date_key").alias("year")).count().orderBy("year"),
        "air_parameters": air.groupBy("parameter").count().orderBy("parameter"),
        "weekend_days": spark.table(cfg.table(C.DIM_DATE.name)).groupBy("is_weekend").count(),
        "boroughs": spark.table(cfg.table(C.DIM_ZONE.name)).groupBy("borough").count().orderBy("borough"),
    }


def refresh(spark: SparkSession, cfg: Config) -> dict[str, int]:
    """Raw, clean and star layers in order; rows written per table."""
    touched: Touched = {}
    return {**load_raw(spark, cfg), **build_silver(spark, cfg, touched), **build_gold(spark, cfg, touched)}

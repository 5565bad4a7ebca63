"""Small hand-made source drops for the whole refresh."""
import datetime as dt
import gzip
import json
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq


def trip(day, pu=1, do=2, fare=10.0, dist=1.0, minutes=10, count=1):
    start = dt.datetime.combine(day, dt.time(8))
    return dict(pickup=start, dropoff=start + dt.timedelta(minutes=minutes), pu=pu, do=do, fare=fare, dist=dist, count=count)


def write_trips(base: Path, name: str, trips, new: bool = False):
    """``new`` selects the later file generation: long ids, long counts, a capital, one more column."""
    ids, cnt = (pa.int64(), pa.int64()) if new else (pa.int32(), pa.float64())
    cols = {
        "VendorID": pa.array([1] * len(trips), ids),
        "tpep_pickup_datetime": pa.array([t["pickup"] for t in trips], pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([t["dropoff"] for t in trips], pa.timestamp("us")),
        "passenger_count": pa.array([t["count"] for t in trips], cnt),
        "trip_distance": pa.array([t["dist"] for t in trips], pa.float64()),
        "PULocationID": pa.array([t["pu"] for t in trips], ids), "DOLocationID": pa.array([t["do"] for t in trips], ids),
        "payment_type": pa.array([1] * len(trips), ids), "fare_amount": pa.array([t["fare"] for t in trips], pa.float64()),
        ("Airport_fee" if new else "airport_fee"): pa.array([0.5] * len(trips), pa.float64()),
    }
    if new:
        cols["cbd_congestion_fee"] = pa.array([0.75] * len(trips), pa.float64())
    (base / "trips").mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(cols), base / "trips" / name)


def write_reference(base: Path):
    for n in ("zones", "fx", "gdp", "locations", "weather"):
        (base / n).mkdir(parents=True, exist_ok=True)
    (base / "zones" / "z.csv").write_text(
        'LocationID,Borough,Zone,service_zone\n1,Queens,"Hill, East",Airports\n2,Bronx,Park,Boro Zone\n2,Bronx,Park,Boro Zone\nbad,Bronx,X,N/A\n264,N/A,N/A,N/A\n')
    extra = ",".join(f"C{i}" for i in range(30))
    blank = "," * 30
    (base / "fx" / "fx.csv").write_text(
        f"{extra},TIME_PERIOD,OBS_VALUE\n{blank}2024-01-02,0.9\n{blank}2024-01-03,\n{blank}2024-02-01,0.8\n{blank}2024-02-01,0.8\n{blank},\n")
    (base / "gdp" / "g.json").write_text(json.dumps([{"page": 1}, [
        {"country": {"id": "US", "value": "United States"}, "date": "2024", "value": 2.5e13},
        {"country": {"id": "US", "value": "United States"}, "date": "2023", "value": None},
        {"country": {"id": "PL", "value": "Poland"}, "date": "2024", "value": 8e11},
        {"country": {"id": "PL", "value": "Poland"}, "date": "2024", "value": 8e11},
        {"country": {"id": "", "value": ""}, "date": "", "value": None}]]))
    stations = [
        {"id": 7, "name": "In town", "timezone": "X", "country": {"code": "US", "name": "United States"},
         "coordinates": {"latitude": 40.7, "longitude": -74.0}, "datetimeFirst": {"utc": "2020-01-01T00:00:00Z"}, "datetimeLast": None},
        {"id": 8, "name": "Elsewhere", "country": {"code": "US", "name": "United States"}, "coordinates": {"latitude": 10.0, "longitude": 0.0}},
        {"id": 9, "name": "Closed", "country": {"code": "US", "name": "United States"}, "coordinates": {"latitude": 40.7, "longitude": -74.0},
         "datetimeLast": {"utc": "2019-01-01T00:00:00Z"}},
        {"id": 10, "name": "No country", "coordinates": {"latitude": 40.8, "longitude": -74.1}}]
    (base / "locations" / "p1.json").write_text(json.dumps({"meta": {"found": 4}, "results": stations[:2]}))
    (base / "locations" / "p2.json").write_text(json.dumps({"meta": {"found": 4}, "results": stations[2:]}))


def write_readings(base: Path, station: int, day: dt.date, lines):
    """``lines`` are (hour, sensor, parameter, units, value)."""
    folder = base / "measurements" / f"locationid={station}" / f"year={day.year}" / f"month={day.month:02d}"
    folder.mkdir(parents=True, exist_ok=True)
    text = "location_id,sensors_id,location,datetime,lat,lon,parameter,units,value\n" + "".join(
        f'{station},{s},"S, {station}",{day}T{h:02d}:00:00+00:00,40.7,-74.0,{p},{u},{v}\n' for h, s, p, u, v in lines)
    with gzip.open(folder / f"location-{station}-{day:%Y%m%d}.csv.gz", "wt") as f:
        f.write(text)


def write_weather(base: Path, name: str, day: dt.date, temps, rain=None):
    doc = {"latitude": 40.7, "longitude": -74.0, "hourly": {
        "time": [f"{day}T{h:02d}:00" for h in range(len(temps))], "temperature_2m": temps,
        "apparent_temperature": temps, "wind_speed_10m": [1.0] * len(temps),
        "relative_humidity_2m": [50] * len(temps), "weather_code": [3] * len(temps)}}
    if rain is not None:
        doc["hourly"]["precipitation"] = rain
    (base / "weather").mkdir(parents=True, exist_ok=True)
    (base / "weather" / name).write_text(json.dumps(doc))

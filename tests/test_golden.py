"""Known values of single expressions."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import clean, geo, risk
from roadpulse.operators import changes, health
from roadpulse.operators.features import build_features, enrich_live
from roadpulse.operators.weather import explode_hourly
from roadpulse.schemas import HOURLY_WEATHER, INCIDENT_PAYLOAD, STATE_FIELDS
from roadpulse.sources.files import rename_raw
from roadpulse.sources.streams import shard_by_row


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head()["x"]


@pytest.mark.parametrize(
    "text,code",
    [("Light Rain", 1), ("Snow / Windy", 2), ("Fog", 3), ("Thunderstorm", 4), ("Overcast", 5), ("Windy", 6), (None, 0), (" ", 0)],
)
def test_weather_code(spark, text, code):
    assert one(spark, clean.weather_code(F.lit(text).cast("string"))) == code


@pytest.mark.parametrize(
    "text,code",
    [("I-70 E", 1), ("US-101 N", 2), ("Main Street", 3), ("Broadway Avenue", 4), ("N State Rd", 3), (" Stone", 0), ("Elm Rd", 7)],
)
def test_road_type(spark, text, code):
    assert one(spark, clean.road_type_code(F.lit(text))) == code


@pytest.mark.parametrize(
    "text,want",
    [
        ("2016-02-08 05:46:00", dt.datetime(2016, 2, 8, 5, 46)),
        ("2020-01-01T12:30:45", dt.datetime(2020, 1, 1, 12, 30, 45)),
        ("2020-01-01T12:30:45Z", dt.datetime(2020, 1, 1, 12, 30, 45)),
        ("2020-01-01T12:30:45.25+05:30", dt.datetime(2020, 1, 1, 12, 30, 45, 250000)),
        ("2020-1-2 3:4:5", dt.datetime(2020, 1, 2, 3, 4, 5)),
        ("2020-01-01", dt.datetime(2020, 1, 1)),
        ("2020", None), ("2020-1-2", None), ("noon", None), ("", None), ("2020-13-01 00:00:00", None),
    ],
)
def test_event_time(spark, text, want):
    assert one(spark, clean.parse_event_time(F.lit(text))) == want


@pytest.mark.parametrize(
    "text,hour",
    [("2020-01-01T12:30:45Z", 12), ("2020-01-01T12:30:45+05:30", 7), ("2020-01-01T01:00:00-0500", 6), ("2020-01-01T23:59:59", 23)],
)
def test_utc_hour(spark, text, hour):
    assert one(spark, clean.utc_hour(F.lit(text))).hour == hour


def test_write_risk(spark):
    one_, zero = F.lit(1), F.lit(0)
    assert one(spark, risk.risk_score(F.lit(4), is_night=one_, road_type_code=one_, weather_code=one_)) == 0.94
    assert one(spark, risk.risk_score(F.lit(4), F.lit(320), F.lit(850), one_, zero, one_, zero)) == 1.0
    assert one(spark, risk.risk_score(F.lit(9))) == 0.85
    assert one(spark, risk.risk_score(F.lit(1), road_type_code=F.lit(3))) == 0.0
    assert one(spark, risk.risk_score(F.lit(None).cast("int"))) is None


@pytest.mark.parametrize("delay,icon,want", [(4, 6, 4), (2, 6, 2), (None, 1, 3), (1, 8, 4), (None, 9, 2), (3, 9, 3), (0, None, 1)])
def test_live_severity(spark, delay, icon, want):
    assert one(spark, risk.live_severity(F.lit(delay).cast("int"), F.lit(icon).cast("int"))) == want


def test_infer_severity(spark):
    none = F.lit(None).cast("int")
    p = [F.lit(x) for x in (0.05, 0.65, 0.2, 0.1)]
    assert one(spark, risk.infer_severity(none, none, F.lit(3), none, p)) == 3
    assert one(spark, risk.infer_severity(none, none, none, none, p)) == 2
    assert one(spark, risk.infer_severity(none, none, none, F.lit(0), p)) == 1
    assert one(spark, risk.infer_severity(F.lit(0), F.lit(9), none, none, p)) == 4
    tie = [F.lit(x) for x in (0.1, 0.4, 0.4, 0.1)]
    assert one(spark, risk.infer_severity(none, none, none, none, tie)) == 2
    nothing = [F.lit(None).cast("double")] * 4
    assert one(spark, risk.infer_severity(none, none, none, none, nothing)) is None


def test_fallback_risk(spark):
    row = spark.sql(
        "select cast(null as int) predicted_severity, cast(null as int) true_severity, 0 is_night, 0 is_weekend, 0 road_type_code, 0 weather_code"
    )
    for constant, want in ((-1.0, 0.25), (0.4, 0.4), (7.0, 1.0)):
        score, status = risk.score_with_fallback(constant)
        assert row.select(score, status).head() == (want, "failed")


def test_whole_feature_row(spark):
    raw = spark.createDataFrame(
        [("A-1", "4", "2020-05-08 08:30:00", "39.865147", "-84.058723", "Heavy Rain", "36.9", "91", "4.6", "2", "I-75 N", "False",
          "True", "False", "False", "False", "False", "False", "Night")],
        ["ID", "Severity", "Start_Time", "Start_Lat", "Start_Lng", "Weather_Condition", "Temperature(F)", "Humidity(%)",
         "Wind_Speed(mph)", "Visibility(mi)", "Street", "Junction", "Traffic_Signal", "Crossing", "Roundabout", "Stop", "Station",
         "Railway", "Sunrise_Sunset"],
    )
    row = build_features(rename_raw(raw)).head().asDict()
    assert row["event_id"] == "A-1" and row["true_severity"] == 4 and row["event_year"] == 2020 and row["hour"] == 8
    assert row["weather_code"] == 1 and row["road_type_code"] == 1 and row["is_night"] == 1 and row["is_rush_hour"] == 1
    assert row["has_traffic_signal"] == 1 and row["is_junction"] == 0 and row["temperature_f"] == 36.9
    assert row["day_of_week"] == 6 and row["is_weekend"] == 0 and len(row) == 24


INCIDENT = {
    "type": "Feature",
    "properties": {"id": "T-1", "iconCategory": 6, "magnitudeOfDelay": 3, "startTime": "2026-05-12T06:00:00Z", "from": "I-95 N", "delay": 180},
    "geometry": {"type": "LineString", "coordinates": [[-74.001, 40.73], [-73.995, 40.735]]},
}


def incidents(spark, *items):
    text = json.dumps({"incidents": list(items)})
    return spark.createDataFrame([(text,)], ["value"]).select(
        F.explode(F.from_json("value", INCIDENT_PAYLOAD)["incidents"]).alias("incident"),
        F.lit("US").alias("state_or_region"), F.lit("New York").alias("city"),
    )


def test_incident_is_normalized(spark):
    no_id = {**INCIDENT, "properties": {**INCIDENT["properties"], "id": ""}}
    nowhere = {**INCIDENT, "geometry": {"type": "Point", "coordinates": []}}
    rows = changes.normalize_incident(incidents(spark, INCIDENT, no_id, nowhere), now="2026-05-12 07:00:00").collect()
    assert len(rows) == 1
    row = rows[0]
    assert row["event_id"] == "live-T-1" and row["latitude"] == 40.73 and row["longitude"] == -74.001
    assert row["state_or_region"] == "US" and row["city"] == "New York" and row["speed"] == 0.0 and row["road_numbers"] == []
    assert row["geometry_wkt"] == "LINESTRING (-74.001 40.73, -73.995 40.735)"


def test_point_geometry(spark):
    text = F.lit("[-73.99, 40.75]")
    at = spark.range(1).select(geo.first_coordinate(text).alias("p")).select("p.*").head()
    assert (at["lat"], at["lon"]) == (40.75, -73.99)
    assert one(spark, geo.to_wkt(text, F.lit("Point"))) == "POINT (-73.99 40.75)"
    deep = F.lit("[[[-74.2, 40.5], [1, 2]]]")
    assert one(spark, geo.first_coordinate(deep)["lon"]) == -74.2
    assert one(spark, geo.to_wkt(deep, F.lit("Polygon"))) == ""


def test_state_signature_ignores_arrival_and_sees_changes(spark):
    base = {f: None for f in STATE_FIELDS} | {"event_id": "live-1", "timestamp": "t", "delay_magnitude": "3", "ingestion_time": "a"}
    later = {**base, "ingestion_time": "b"}
    delayed = {**base, "delay_magnitude": "4"}
    moved = {**base, "geometry_wkt": "LINESTRING (0 1, 2 3)"}
    ddl = ", ".join(f"`{c}` string" for c in base)
    df = spark.createDataFrame([tuple(r.values()) for r in (base, later, delayed, moved)], ddl)
    a, b, c, d = [r[0] for r in df.select(changes.state_signature(df)).collect()]
    assert a == b and len({a, c, d}) == 3


def test_change_status_of_a_key(spark):
    rows = [("k", 1, "a"), ("k", 2, "a"), ("k", 3, "b"), ("k", 4000, "a"), ("k", 9000, "a"), ("other", 2, "a")]
    df = spark.createDataFrame(rows, "id string, s int, delay_magnitude string").withColumn(
        "t", F.timestamp_seconds("s").cast("timestamp_ntz")
    )
    got = changes.change_status(df, "id", "t", "s").orderBy("id", "s").collect()
    assert [r["change_status"] for r in got] == ["new", "unchanged", "update", "update", "unchanged", "new"]


def test_regions(spark):
    text = "US:New York:-74.2,40.4,-73.7,40.9; broken ;US::1,2,3,4;US:Boston:1,2,3,4:5"
    rows = changes.region_table(spark.createDataFrame([(text,)], ["r"]), "r").collect()
    assert [tuple(r) for r in rows] == [("US", "New York", "-74.2,40.4,-73.7,40.9"), ("US", "Boston", "1,2,3,4:5")]


def test_live_event_takes_the_weather_of_its_hour(spark):
    arrays = "named_struct('time', array('2024-06-15T05:00','2024-06-15T06:00','2024-06-15T07:00'), 'temperature_2m', array(55d,61d,62d)," \
        " 'relative_humidity_2m', array(70d,80d,82d), 'weather_code', array(0,61,3), 'wind_speed_10m', array(3d,5d,6d))"
    hourly = explode_hourly(spark.sql(f"select 40.73d cell_lat, -74.0d cell_lon, {arrays} hourly"))
    assert hourly.count() == 3 and "time" in HOURLY_WEATHER
    message = spark.sql(
        "select 'live-1' event_id, '40.731' latitude, '-74.001' longitude, '2024-06-15T06:25:00Z' timestamp, '3' delay_magnitude,"
        " '6' icon_category, 'I-95 N' from_road, '9' visibility_mi"
    )
    row = build_features(enrich_live(message, hourly)).head()
    assert (row["weather_code"], row["temperature_f"], row["humidity"], row["wind_speed_mph"]) == (1, 61.0, 80.0, 5.0)
    assert (row["true_severity"], row["road_type_code"], row["visibility_mi"], row["is_night"]) == (3, 1, 9.0, 0)
    bare = build_features(enrich_live(message, hourly.where("cell_lat = 0"))).head()
    assert (bare["weather_code"], bare["temperature_f"], bare["humidity"], bare["wind_speed_mph"]) == (0, 50.0, 50.0, 0.0)


def test_missing_live_fields_drop_the_row(spark):
    rows = spark.createDataFrame(
        [("e", "1", "2", "2024-01-01T00:00:00Z"), ("", "1", "2", "2024-01-01T00:00:00Z"), ("e", "x", "2", "2024-01-01T00:00:00Z"), ("e", "1", "2", " ")],
        "event_id string, latitude string, longitude string, timestamp string",
    )
    assert enrich_live(rows).count() == 1


def test_windows_and_columns():
    assert [clean.parse_window(w) for w in ("5m", "30s", " 2h ", "1d", "0s", "", None, "x", "5x", "-5m")] == [
        300, 30, 7200, 86400, 1, 300, 300, 300, 300, 300,
    ]
    assert health.time_column({"created_at", "processed_time", "event_time"}) == "processed_time"
    assert health.time_column({"x"}) is None


def test_shard(spark):
    rows = spark.range(10).toDF("row")
    assert [r["row"] for r in shard_by_row(rows, 3, 2, "row").orderBy("row").collect()] == [2, 5, 8]


def test_throughput_states(spark):
    table = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' processed_time, 'e' event_id")
    stale = health.throughput({"t": table}, "5m", now="2024-03-01 00:00:00").head()
    assert (stale["status"], stale["event_count"], stale["is_live_window"]) == ("stale", 1, False)
    fresh = health.throughput({"t": table}, "5m", now="2024-01-01 00:03:00").head()
    assert (fresh["status"], fresh["event_count"], fresh["is_live_window"]) == ("ok", 1, True)
    empty = health.throughput({"t": table.where("false")}, "5m", now="2024-01-01 00:03:00").head()
    assert (empty["status"], empty["event_count"]) == ("not_enough_data", 0)
    assert health.throughput({"t": table.select("event_id")}, "5m").head()["status"] == "unavailable"

"""Behaviour of the reference-level operators on small tables."""

import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wayfuse.functions import geo, savgol, scalars
from wayfuse.operators import analytics, coordinates, filters, fusion, records, trajectory
from wayfuse.plans import runs
from wayfuse.sources import json_records, side_files, tables


def objects(spark, rows):
    df = spark.createDataFrame([("f", i, json.dumps(r)) for i, r in enumerate(rows)], "file string, ordinal bigint, text string")
    return df.select("file", "ordinal", F.parse_json("text").alias("record"))


def test_time_units(spark):
    rows = [(1678901234,), (1678901234000,), (1678901234000000,), (-5,), (9_999_999_999,), (10_000_000_000_007,)]
    found = spark.createDataFrame(rows, "t bigint").select(scalars.timestamp_unit(F.col("t")), scalars.to_millis(F.col("t"))).collect()
    assert [tuple(r) for r in found[:3]] == [("s", 1678901234000), ("ms", 1678901234000), ("us", 1678901234000)]
    assert found[3][1] == -5000 and found[4][0] == "s" and found[5] == ("us", 10_000_000_000)
    assert spark.range(1).select(scalars.to_millis(F.lit(-1).cast("bigint"), "us")).first()[0] == -1
    with pytest.raises(ValueError):
        scalars.to_millis(F.col("t"), "ns")


def test_parse_records(spark):
    full = {"stationID": "veh1", "timestamp": 1678901234, "latitude": 50.0, "longitude": 6.0, "altitude": 1, "speed": 2.5, "headingDeg": 9}
    rows = [full, {**full, "stationID": None}, {k: v for k, v in full.items() if k != "timestamp"}, {**full, "timestamp": 0, "timestamp_utc_ms": 7_000_000_000_000}, {**full, "latitude": "north"}]
    rows += [{"vehicle_id": 5, "messageType": "CAM", "tx_timestamp": 1678901234000, "rx_timestamp": 1678901234020, "direction": "v2v", "payload_bytes": 120}]
    rows += [{"id": "x", "timestamp": "soon", "tx_timestamp": 1678901234000, "direction": "up"}]
    gnss, messages = records.parse_records(objects(spark, rows))
    found = {r["ordinal"]: r for r in gnss.collect()}
    assert sorted(found) == [0, 3]
    assert found[0]["timestamp_utc_ms"] == 1678901234000 and found[0]["heading_deg"] == 9.0 and found[3]["timestamp_utc_ms"] == 7_000_000_000_000
    m = {r["ordinal"]: r for r in messages.collect()}
    assert sorted(m) == [0, 2, 3, 4, 5, 6] and m[0]["message_type"] is None
    assert m[5]["latency_ms"] == 20.0 and m[5]["vehicle_id"] == "5" and m[5]["direction"] == "v2v" and m[5]["payload_bytes"] == 120
    assert m[6]["tx_timestamp_utc_ms"] is None and m[6]["direction"] is None


def test_bbox_modes(spark):
    rows = [("veh1", 1, 50.0, 6.0, 1), ("veh1", 2, 50.6, 6.6, 2), ("veh2", 1, 50.5, 6.5, 3), ("veh3", 1, 51.0, 7.0, 4)]
    df = spark.createDataFrame(rows, "vehicle_id string, timestamp_ms bigint, latitude double, longitude double, ordinal bigint")
    ids = lambda out: sorted(r["ordinal"] for r in out.collect())
    assert ids(filters.filter_bbox(df, (6.4, 50.4, 6.6, 50.6), "contain")) == [3]
    assert ids(filters.filter_bbox(df, (5.9, 49.9, 6.1, 50.1), "first")) == [1, 2]
    assert ids(filters.filter_bbox(df, (5.5, 49.5, 6.5, 50.5))) == [1, 3]
    for bad in ((7, 50, 6, 51), (6, 50, 6, 51), (-200, 0, 0, 1)):
        with pytest.raises(ValueError):
            filters.filter_bbox(df, bad)
    with pytest.raises(ValueError):
        filters.filter_bbox(df, (5, 49, 8, 52), "some")
    ring = [(6, 50), (7, 50), (7, 51), (6, 51), (6, 50)]
    assert ids(filters.filter_polygon(df, ring)) == [2, 3]
    assert ids(filters.filter_polygon(df, ring, "contain")) == [3]
    row = filters.filter_summary(df, df.where("ordinal = 3")).first()
    assert row["reduction_pct"] == 75.0 and row["vehicle_retention_pct"] == 33.33
    empty = filters.summary_dict(filters.filter_summary(df.limit(0), df.limit(0)).first())
    assert empty["reduction_pct"] == 0 and empty["original_bbox"] is None
    with pytest.raises(ValueError):
        filters.bbox_of(df.limit(0))


def track(spark, rows):
    full = [(v, t, *([x] * 3), 5.0, 0.0, i) if not isinstance(x, tuple) else (v, t, *x, i) for i, (v, t, x) in enumerate(rows)]
    return spark.createDataFrame(full, "vehicle_id string, timestamp_ms bigint, latitude double, longitude double, altitude double, speed_mps double, heading_deg double, ordinal bigint")


def test_gaps_and_grid(spark):
    df = track(spark, [("v", t, float(t)) for t in (1000, 2000, 8000, 9000)])
    assert [tuple(r) for r in trajectory.gaps(df).collect()] == [("v", 1, 2000, 8000)]
    assert [r["segment"] for r in trajectory.with_gaps(df).orderBy("ordinal").collect()] == [0, 0, 1, 1]
    grid = trajectory.resample(track(spark, [("v", 0, 10.0), ("v", 1500, 15.0), ("v", 3000, 20.0), ("w", 77, 1.0)])).orderBy("vehicle_id", "timestamp_ms").collect()
    assert [r["timestamp_ms"] for r in grid] == [0, 1000, 2000, 3000, 77]
    assert np.allclose([r["latitude"] for r in grid][:4], np.interp([0, 1000, 2000, 3000], [0, 1500, 3000], [10, 15, 20]))
    flagged = trajectory.resample(df).orderBy("timestamp_ms").collect()
    assert [(r["timestamp_ms"], r["gap_flag"]) for r in flagged] == [(1000, True), (2000, True), (8000, True), (9000, True)]
    doubled = trajectory.resample(track(spark, [("v", 0, 1.0), ("v", 0, 5.0), ("v", 1000, 9.0)])).orderBy("timestamp_ms").collect()
    assert [r["latitude"] for r in doubled] == [5.0, 9.0]
    heading = trajectory.resample(track(spark, [("v", 0, (1.0, 1.0, None, 0.5, 359.0)), ("v", 2000, (1.0, 1.0, 3.0, None, 1.0))])).orderBy("timestamp_ms").collect()
    assert [r["heading_deg"] for r in heading] == [359.0, 180.0, 1.0] and [r["altitude"] for r in heading] == [None, None, 3.0]
    assert trajectory.expected_samples(df) == 9


def test_smoothing(spark):
    r = np.random.default_rng(1)
    times = np.cumsum(np.where(r.random(60) < 0.07, 9000, 1000))
    values = r.random(60)
    df = track(spark, [("v", int(t), float(x)) for t, x in zip(times, values, strict=True)] + [("w", i * 1000, float(i * i)) for i in range(5)])
    want, h = values.copy(), savgol.hat_matrix(7, 2)
    starts = [0, *(np.flatnonzero(np.diff(times) > 5000) + 1), 60]
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        stop = b if b == 60 else b - 1  # the last row before a gap is no part of what is fitted
        if stop - a >= 7:
            part = values[a:stop]
            for i in range(len(part)):
                lo = min(max(i - 3, 0), len(part) - 7)
                want[a + i] = h[i - lo] @ part[lo : lo + 7]
    found = trajectory.smooth(df).orderBy("ordinal").collect()
    assert np.allclose([x["latitude"] for x in found][:60], want)
    assert [x["latitude"] for x in found][60:] == [0.0, 1.0, 4.0, 9.0, 16.0]
    assert np.allclose(h[3] * 21, [-2, 3, 6, 7, 6, 3, -2])


def test_quality(spark):
    df = spark.createDataFrame([(5.0,), (0.5,), (3.0,), (None,), (float("nan"),)], "s double")
    q = trajectory.quality(F.lit(False), F.lit(False), F.col("s"))
    assert [r[0]["low_speed"] for r in df.select(q).collect()] == [False, True, False, False, False]


def test_geodesy(spark):
    one = spark.range(1)
    got = lambda *c: [float(x) for x in one.select(*c).first()]
    lit = lambda *v: [F.lit(float(x)) for x in v]
    assert got(*geo.enu(*lit(50, 6, 100, 50, 6, 100))) == [0.0, 0.0, 0.0]
    e, n, _ = got(*geo.enu(*lit(50.001, 6, 0, 50, 6, 0)))
    assert abs(e) < 1e-6 and abs(n - 111.23) < 0.05
    assert got(geo.utm_zone(F.lit(6.0)))[0] == 32 and got(geo.utm_zone(F.lit(180.0)))[0] == 60
    south = F.lit(False)
    e, n = got(*geo.utm_forward(*lit(50.7753, 6.0839), F.lit(32), south))
    assert abs(e - 294409.40) < 0.02 and abs(n - 5628892.41) < 0.02
    assert abs(got(geo.utm_forward(*lit(10, 9), F.lit(32), south)[0])[0] - 500000) < 1e-6
    for lat, lon in ((50.7, 6.1), (-33.9, 18.4), (0.0, 9.0)):
        zone, s = F.lit(int((lon + 180) / 6) + 1), F.lit(lat < 0)
        back = got(*geo.utm_inverse(*geo.utm_forward(*lit(lat, lon), zone, s), zone, s))
        assert abs(back[0] - lat) < 1e-10 and abs(back[1] - lon) < 1e-10
    assert abs(got(geo.haversine_m(*lit(0, 0, 0, 1)))[0] - math.radians(1) * 6371000) < 1e-6
    assert got(geo.grid_cell(F.lit(-0.0005), 0.001))[0] == 0


def test_origins(spark):
    df = spark.createDataFrame([("b", 1, 1.0, 1.0, None), ("a", 2, 2.0, 4.0, 6.0), ("a", 3, 6.0, 7.0, 3.0)], "vehicle_id string, timestamp_ms bigint, lat_deg double, lon_deg double, alt_m double")
    assert coordinates.select_origin(df) == (2.0, 4.0, 6.0)
    assert coordinates.select_origin(df, "centroid") == (3.0, 4.0, 3.0)
    assert coordinates.select_origin(df, "median") == (2.0, 4.0, 3.0)
    with pytest.raises(ValueError):
        coordinates.select_origin(df, "last")
    with pytest.raises(ValueError):
        coordinates.select_origin(df.limit(0))
    assert coordinates.project(df.limit(0))[1] == (0.0, 0.0, 0.0)
    assert coordinates.project(df, origin=(0.0, None, None))[1] == (0.0, 4.0, 6.0)


def sides(seed=1, n=150, m=200):
    r = np.random.default_rng(seed)
    points = [(str(r.integers(3)), int(r.integers(0, 20_000)), float(i), 0.0, None, None, None, i) for i in range(n)]
    messages = [(str(r.integers(3)), int(r.integers(0, 20_000)), "CAM" if i % 2 else "DENM", int(r.integers(1, 9)), float(i) if i % 3 else None, i) for i in range(m)]
    return points, messages


def test_band_join_is_complete(spark):
    points, messages = sides()
    p = spark.createDataFrame(points, "vehicle_id string, timestamp_ms bigint, latitude double, longitude double, altitude double, speed_mps double, heading_deg double, ordinal bigint")
    m = spark.createDataFrame(messages, "vehicle_id string, timestamp_ms bigint, message_type string, message_size_bytes bigint, latency_ms double, ordinal bigint")
    found = {r["ordinal"]: r for r in fusion.fuse_topics(p, m, window_ms=1000).collect()}
    assert len(found) == len(points)
    for v, t, *_, i in points:
        near = [x for x in messages if x[0] == v and abs(x[1] - t) <= 500]
        latencies = [x[4] for x in near if x[4] is not None]
        assert found[i]["messages_sent"] == len(near) and found[i]["total_bytes_sent"] == sum(x[3] for x in near)
        assert found[i]["message_types"] == ",".join(sorted({x[2] for x in near}))
        assert (found[i]["avg_latency_ms"] is None) == (not latencies)
    a = pd.DataFrame([(x[0], x[1], x[5]) for x in messages], columns=["v", "t", "o"]).sort_values(["t", "o"])
    b = pd.DataFrame([(x[0], x[1], x[7]) for x in points], columns=["v", "t", "p"]).sort_values(["t", "p"])
    want = pd.merge_asof(a, b, on="t", by="v", direction="nearest", tolerance=300)
    want = {o: None if pd.isna(x) else int(x) for o, x in zip(want.o, want.p, strict=True)}
    near = fusion.nearest_join(m, p.withColumn("p", F.col("ordinal")), tolerance_ms=300, take=("p",)).collect()
    assert {r["ordinal"]: r["p"] for r in near} == want


def test_record_fusion_and_wide_counts(spark):
    samples = spark.createDataFrame([("v", 1000, 1.0, 2.0), ("w", 1000, 1.0, 2.0)], "vehicle_id string, timestamp_ms bigint, x_m double, y_m double")
    rows = [("v", 0, 900, None, "CAM", 10, "uplink_to_rsu", 4.0), ("v", 1500, None, None, "CAM", 20, "downlink_from_rsu", None), ("v", 1501, None, None, "X", 9, "v2v", 1.0), ("v", None, None, 1000, None, None, "v2v", 6.0)]
    m = spark.createDataFrame(rows, "vehicle_id string, timestamp_utc_ms bigint, tx_timestamp_utc_ms bigint, rx_timestamp_utc_ms bigint, message_type string, payload_bytes bigint, direction string, latency_ms double")
    fused = fusion.fuse_records(samples, m)
    found = {r["vehicle_id"]: r for r in fused.collect()}
    assert (found["v"]["tx_bytes"], found["v"]["rx_bytes"], found["v"]["avg_latency_ms"], found["v"]["msg_counts"]) == (10, 20, 5.0, {"CAM": 2})
    assert (found["w"]["tx_bytes"], found["w"]["avg_latency_ms"], found["w"]["msg_counts"]) == (0, None, {})
    wide = {r["vehicle_id"]: r for r in analytics.type_counts_wide(fused).collect()}
    assert wide["v"]["msg_count_CAM"] == 2 and wide["w"]["msg_count_CAM"] == 0


def test_rates_and_heatmap(spark):
    rows = [("u", 0, 100, 17572160), ("u", 3021702618, 0, 0), ("v", 5, 1, 1)]
    df = spark.createDataFrame(rows, "vehicle_id string, timestamp_ms bigint, messages_sent bigint, total_bytes_sent bigint")
    found = {r["vehicle_id"]: r for r in analytics.vehicle_rates(df).collect()}
    assert abs(found["u"]["data_rate_kbps"] - 0.0465225) < 1e-6 and found["v"]["data_rate_kbps"] is None
    cells = spark.createDataFrame([(0.0, 0.0, 1.0), (0.5, 0.5, 2.0), (1.0, 1.0, 9.0), (0.5, 0.5, None)], "latitude double, longitude double, x double")
    got = {(r["lat_bin"], r["lon_bin"]): r["value"] for r in analytics.heatmap(cells, F.col("x"), "mean", edges=3).collect()}
    assert got == {(0, 0): 1.0, (1, 1): 2.0}


def test_majority(spark):
    rows = [("f", "a")] * 9 + [("f", "b")] * 2 + [("g", "a")] * 8 + [("g", "b")] * 2 + [("h", None)]
    found = {r["file"]: r["vehicle_id"] for r in analytics.majority_ids(spark.createDataFrame(rows, "file string, vehicle_id string")).collect()}
    assert found == {"f": "a", "g": "unknown"}


TOPICS = {
    "/gps/fix": [{"recording_timestamp_nsec": 1705860399297000000, "message": {"latitude": 50.7, "longitude": 6.1, "altitude": 200.0}}, {"recording_timestamp_nsec": 1, "message": {"latitude": None, "longitude": 1}}, 7],
    "/v2x/cam": [{"recording_timestamp_nsec": 1705860399597000000, "message": {"header": {"message_id": 2, "station_id": {"value": 42}, "frame_id": "gps"}, "cam": {"é": 1.0}}}],
    "/v2x/raw": [{"recording_timestamp_nsec": 1705860399597000000, "message": {"address": {"value": "10.0.0.1"}}}],
    "/tf_static": [{"recording_timestamp_nsec": 0, "message": {}}],
    "meta": 1,
}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "Mobile/scenarios").mkdir(parents=True)
    (tmp_path / "Mobile/scenarios/a.json").write_text(json.dumps(TOPICS, indent=1))
    (tmp_path / "Mobile/scenarios/bad.json").write_text('{"/gps/fix": [')
    (tmp_path / "records").mkdir()
    rows = [{"stationID": "veh1", "latitude": 50.0, "longitude": 6.0}, {"stationID": "veh2", "message_type": "CAM", "payload_bytes": 120}, 3]
    (tmp_path / "records/array.json").write_text(json.dumps(rows))
    lines = [{"stationID": "veh1", "lat": 50.0001, "lon": 6.0001}, {"stationID": "veh1", "message_type": "DENM", "payload_bytes": 64}]
    (tmp_path / "records/lines.json").write_text("\n".join(map(json.dumps, lines)) + "\n\nbroken\n")
    return tmp_path


def test_sources_and_profile(spark, folder):
    row = runs.discover(spark, str(folder / "records")).first()
    assert (row["total_files"], row["gnss_records"], row["v2x_records"], row["other_records"]) == (2, 2, 2, 0)
    assert row["unique_vehicles"] == ["veh1", "veh2"] and row["message_types"] == ["CAM", "DENM"]
    assert records.discovery_table(runs.discover(spark, str(folder / "records"), 1)).count() == 7
    files = json_records.read_files(spark, str(folder), mode="scenarios")
    assert files.count() == 2 and json_records.read_files(spark, str(folder), mode="joined").count() == 0
    found = json_records.read_objects(files).collect()
    assert sorted(r["topic"] for r in found) == ["/gps/fix", "/gps/fix", "/tf_static", "/v2x/cam", "/v2x/raw"]
    assert json_records.broken_files(files).count() == 1
    odd = spark.createDataFrame([("a", " [1]"), ("b", '{"x": 1,\n"y": 2}'), ("c", json.dumps(TOPICS))], "file string, value string")
    assert sorted(r["file"] for r in json_records.read_objects(odd).collect()) == ["b", "c"]
    assert [p.rsplit("/", 1)[1] for p in json_records.scenario_paths(str(folder))] == ["a.json", "bad.json"]
    assert json_records.scenario_paths(str(folder), [str(folder / "records"), "nowhere"])[0].endswith("array.json")


def test_topic_run(spark, folder):
    stats = runs.run_topics(spark, str(folder), str(folder / "out")).first()
    assert (stats["total_files"], stats["trajectory_points"], stats["v2x_messages"], stats["fused_points"]) == (2, 1, 2, 1)
    m = {r["topic"]: r for r in tables.read_results(spark, str(folder / "out"), "v2x_messages").collect()}
    cam, raw = m["/v2x/cam"], m["/v2x/raw"]
    assert (cam["vehicle_id"], cam["message_type"], cam["receiver_id"], cam["timestamp_ms"]) == ("42", "CAM", "gps", 1705860399597)
    assert cam["message_size_bytes"] == len(json.dumps(TOPICS["/v2x/cam"][0]["message"]))
    assert (raw["vehicle_id"], raw["message_type"], raw["receiver_id"]) == ("unknown", "UNKNOWN", "10.0.0.1")
    point = tables.read_results(spark, str(folder / "out"), "fused_data").first()
    assert (point["vehicle_id"], point["timestamp_ms"], point["messages_sent"], point["message_types"]) == ("42", 1705860399297, 1, "CAM")
    runs.write_report(spark, str(folder / "out"))
    assert {k: v.count() for k, v in runs.report(spark, str(folder / "out")).items()}["message_types"] == 2
    ns = spark.range(1).select(scalars.nanos_to_millis(F.lit(1705860399836999900)), scalars.nanos_to_millis(F.lit(1705860399836999900), compat=True)).first()
    assert ns[1] - ns[0] == 1


def test_record_run(spark, tmp_path):
    rows = [{"stationID": "raw", "timestamp": 1678901234 + i, "latitude": 50 + i * 1e-4, "longitude": 6.0, "speed": 0.5} for i in range(9)]
    rows += [{"stationID": "far", "timestamp": 1678901234, "latitude": 10.0, "longitude": 6.0}]
    rows += [{"stationID": "raw", "timestamp": 1678901236, "messageType": "CAM", "payload_bytes": 5, "direction": "uplink_to_rsu"}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/r.json").write_text(json.dumps(rows))
    (tmp_path / "ids.json").write_text('{"raw": "veh1"}')
    ring = [[5, 49], [7, 49], [7, 51], [5, 51], [5, 49]]
    (tmp_path / "ring.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[ring, ring[:4]]]}}]}))
    config = side_files.config_from({"input_dir": tmp_path / "in", "output_dir": tmp_path / "out", "region_polygon_path": str(tmp_path / "ring.json"), "ids_map_path": tmp_path / "ids.json", "metadata_out": str(tmp_path / "meta")})
    run = runs.run_records(spark, config)
    found = run.samples.orderBy("timestamp_ms").collect()
    assert len(found) == 9 and {r["vehicle_id"] for r in found} == {"veh1"} and found[0]["quality"]["low_speed"]
    assert abs(found[0]["x_m"]) < 1e-6 and abs(found[8]["y_m"] - 8 * 11.12) < 0.5
    assert sum(r["tx_bytes"] for r in run.fused.collect()) == 5
    assert "msg_count_CAM" in spark.read.parquet(str(tmp_path / "out/fused.parquet")).columns
    assert "quality_gap" in spark.read.parquet(str(tmp_path / "out/trajectories.parquet")).columns
    tables.export_csv(str(tmp_path / "csv"), run.samples, run.fused)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv/trajectories.csv")).count() == 9
    assert spark.read.json(str(tmp_path / "meta")).count() == 1


def test_side_files(tmp_path):
    base = {"input_dir": "a", "output_dir": "b"}
    for bad in ({"hz": 0}, {"format": "xml"}, {"region_bbox": [7, 50, 6, 51]}, {"sample": 0}, {"workers": 0}, {"gap_threshold_s": -1}, {"what": 1}):
        with pytest.raises(ValueError):
            side_files.config_from(base | bad)
    (tmp_path / "c.yaml").write_text("input_dir: a\noutput_dir: b\nregion_bbox: [6.0, 50.0, 6.1, 50.1]\nformat: CSV\n")
    assert side_files.load_config(str(tmp_path / "c.yaml")).format == "csv"
    (tmp_path / "l.yaml").write_text("- 1\n")
    with pytest.raises(ValueError):
        side_files.load_config(str(tmp_path / "l.yaml"))
    with pytest.raises(FileNotFoundError):
        side_files.load_config(str(tmp_path / "none"))
    for bad in ({"type": "Point"}, {"type": "FeatureCollection", "features": []}, {"type": "Polygon", "coordinates": []}):
        with pytest.raises(ValueError):
            side_files.geojson_ring(bad)


def test_rsus_and_ids(spark, tmp_path):
    m = spark.createDataFrame([("R1", "a"), ("R2", "b")], "rsu_id string, vehicle_id string")
    found = side_files.with_rsus(m, {"R1": {"location": {"lat": 50.0, "lon": 6.0}}}).orderBy("rsu_id").collect()
    assert [r["rsu_lat"] for r in found] == [50.0, None]
    assert [r["vehicle_id"] for r in side_files.apply_identity_map(m, {"a": "z"}).orderBy("rsu_id").collect()] == ["z", "b"]
    assert side_files.apply_identity_map(m, {}).count() == 2


def test_quantiles_narrow_down(spark, monkeypatch):
    """Exact ranks by passes over bins, with ties, one value and no value."""
    monkeypatch.setattr(analytics, "FETCHED", 5)
    monkeypatch.setattr(analytics, "BINS", 4)
    for values in ([3.0] * 40, [1.0, 2.0, 2.0, 2.0, 9.5, 1e6], [float(x * x % 101) for x in range(200)], [-5.0, 7.25]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
        assert analytics.quantiles(df, "x", (0.0, 0.25, 0.5, 0.75, 1.0)) == pytest.approx(np.quantile(values, (0, 0.25, 0.5, 0.75, 1)).tolist())
    assert analytics.quantiles(df.limit(0), "x", (0.5,)) == [None]


def test_time_deltas_cross_slices(spark):
    times = [0, 5, 5, 4000, 90_000, 90_001, 400_000]
    df = spark.createDataFrame([(t,) for t in times], "timestamp_ms bigint").repartition(3)
    found = analytics.time_deltas(df, slice_ms=1000).collect()
    assert sorted(r["delta_s"] for r in found if r["delta_s"] is not None) == sorted((b - a) / 1000 for a, b in zip(times, times[1:], strict=False))
    assert len(found) == len(times)


def test_space_time_match_near_the_date_line_and_poles(spark):
    r = np.random.default_rng(5)
    places = [(i, float(lat), float(lon)) for i, (lat, lon) in enumerate(zip(r.choice([-89.95, 0.0, 60.0, 89.9], 120) + r.normal(0, 0.02, 120), np.where(r.random(120) < 0.5, 179.98, -179.98) + r.normal(0, 0.03, 120), strict=True))]
    places = [(i, max(-90.0, min(90.0, lat)), (lon + 180) % 360 - 180) for i, lat, lon in places]
    frame = spark.createDataFrame([(i, f"v{i}", 0, lat, lon) for i, lat, lon in places], "ordinal bigint, vehicle_id string, timestamp_ms bigint, latitude double, longitude double")
    found = fusion.spatiotemporal_match(frame.where("ordinal % 2 = 0"), frame.where("ordinal % 2 = 1"), max_ms=10, max_m=2000.0)

    def meters(a, b):
        p, q = np.radians(a[1]), np.radians(b[1])
        h = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6371000.0 * np.arcsin(np.sqrt(min(1.0, h)))

    for row in found.collect():
        near = min(((meters(places[row["ordinal"]], q), f"v{q[0]}") for q in places if q[0] % 2), default=None)
        assert row["matched_id"] == (near[1] if near[0] < 2000 else None)


def test_plot_tables_of_a_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [json.dumps({"stationID": "v", "timestamp": 1_700_000_000_000 + 1000 * i, "lat": 50 + i / 1e4, "lon": 6 + i / 1e4, "payload_bytes": 10, "messageType": "CAM"}) for i in range(20)]
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    config = side_files.PipelineConfig(str(tmp_path / "in"), str(tmp_path / "out"), visualize=True)
    runs.run_records(spark, config)
    assert spark.read.parquet(str(tmp_path / "out/plots/tracks.parquet")).count() == 20
    assert spark.read.parquet(str(tmp_path / "out/plots/throughput.parquet")).count() == 20
    found = json_records.read_lines(spark, str(tmp_path / "in"))
    assert found.count() == 20 and found.select("ordinal").distinct().count() == 20

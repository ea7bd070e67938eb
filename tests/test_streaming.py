from wayfuse.streaming import live


def drain(df, name):
    query = df.writeStream.format("memory").queryName(name).outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    return df.sparkSession.table(name).collect()


def test_sessions_and_matches(spark, tmp_path):
    points = [("v", t) for t in ("2024-01-01 00:00:00", "2024-01-01 00:00:03", "2024-01-01 00:00:20")]
    messages = [("v", "2024-01-01 00:00:03.4"), ("v", "2024-01-01 00:00:03.6"), ("w", "2024-01-01 00:00:00")]
    for name, rows in (("p", points), ("m", messages)):
        later = [("z", "2024-01-01 09:00:00")]
        for i, part in enumerate((rows, later)):
            spark.createDataFrame(part, "vehicle_id string, ts string").selectExpr("vehicle_id", "cast(ts as timestamp) ts").coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    stream = lambda n: spark.readStream.schema("vehicle_id string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / n))
    found = {(r["vehicle_id"], r["points"]) for r in drain(live.sessions(stream("p")), "sessions")}
    assert found == {("v", 2), ("v", 1)}
    pairs = drain(live.band_matches(stream("p"), stream("m").select("vehicle_id", "ts")), "pairs")
    assert [str(r["message_ts"]) for r in pairs if r["vehicle_id"] == "v"] == ["2024-01-01 00:00:03.400000"]

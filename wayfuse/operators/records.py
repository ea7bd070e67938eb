"""Records to typed rows: flat records of both kinds, and entries of topic documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def _stamped(objects: DataFrame, record: str, unit: str | None, names: tuple[str, ...]) -> DataFrame:
    """Adds __ms_<name>, milliseconds of the first truthy of a field's two names, and __bad_<name>, whether what is given can't be read.

    Step by step, so that no step repeats the expression of the one before.
    """
    raw = {f"__raw_{n}": S.truthy_or(record, n, f"{n}_utc_ms") for n in names}
    number = {f"__int_{n}": S.integer(F.col(f"__raw_{n}")) for n in names}
    ms = {f"__ms_{n}": S.to_millis(F.col(f"__int_{n}"), unit) for n in names}
    bad = {f"__bad_{n}": F.col(f"__raw_{n}").isNotNull() & F.col(f"__int_{n}").isNull() for n in names}
    return objects.withColumns(raw).withColumns(number).withColumns(ms | bad)


def parse_gnss(objects: DataFrame, *, unit: str | None = None, record: str = "record") -> DataFrame:
    """Positions of records that name a vehicle, a time and both coordinates; the others are dropped."""
    found = _stamped(objects, record, unit, ("timestamp",)).select(
        S.first_of(record, S.VEHICLE_ID).alias("vehicle_id"),
        F.col("__ms_timestamp").alias("timestamp_utc_ms"),
        S.first_of(record, S.LATITUDE, "double").alias("latitude_deg"),
        S.first_of(record, S.LONGITUDE, "double").alias("longitude_deg"),
        S.first_of(record, S.ALTITUDE, "double").alias("altitude_m"),
        S.first_of(record, S.SPEED, "double").alias("speed_mps"),
        S.first_of(record, S.HEADING, "double").alias("heading_deg"),
        S.truthy_or(record, "stationID", "station_id").alias("station_id"),
        S.first_of(record, S.STATION_TYPE).alias("station_type"),
        F.col("file").alias("source_file"),
        "ordinal",
    )
    return found.dropna(subset=["vehicle_id", "timestamp_utc_ms", "latitude_deg", "longitude_deg"])


def parse_messages(objects: DataFrame, *, unit: str | None = None, record: str = "record") -> DataFrame:
    """Messages of records that name a vehicle; a time that can't be read leaves itself and those after it null."""
    bad_own, bad_tx = F.col("__bad_timestamp"), F.col("__bad_tx_timestamp")
    own, tx, rx = (F.col(f"__ms_{n}") for n in ("timestamp", "tx_timestamp", "rx_timestamp"))
    tx, rx = F.when(~bad_own, tx), F.when(~(bad_own | bad_tx), rx)
    found = _stamped(objects, record, unit, ("timestamp", "tx_timestamp", "rx_timestamp")).select(
        S.first_of(record, S.VEHICLE_ID).alias("vehicle_id"),
        S.truthy_or(record, "stationID", "station_id").alias("station_id"),
        S.first_of(record, S.STATION_TYPE).alias("station_type"),
        own.alias("timestamp_utc_ms"),
        tx.alias("tx_timestamp_utc_ms"),
        rx.alias("rx_timestamp_utc_ms"),
        S.direction_of(record).alias("direction"),
        S.first_of(record, S.RSU_ID).alias("rsu_id"),
        S.first_of(record, S.MESSAGE_TYPE).alias("message_type"),
        S.integer(S.get(record, "payload_bytes")).alias("payload_bytes"),
        S.integer(S.get(record, "frame_bytes")).alias("frame_bytes"),
        (rx - tx).cast("double").alias("latency_ms"),
        F.col("file").alias("source_file"),
        "ordinal",
    )
    return found.where(F.col("vehicle_id").isNotNull())


def parse_records(objects: DataFrame, *, unit: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Every record is read as both kinds, so a position also is a message without a type."""
    return parse_gnss(objects, unit=unit), parse_messages(objects, unit=unit)


# Parts of a topic's name that decide what it holds, positions first, and the demo's lists.
GPS_PARTS, MESSAGE_PARTS = ("/gps", "/gnss", "/fix"), ("/v2x", "/cam", "/denm")
DEMO_GPS, DEMO_MESSAGES = ("/gps/cohda_mk5/fix", "/gnss", "/fix"), ("/v2x/cam", "/v2x/denm", "/v2x/raw")
ID_TOPICS = ("/v2x/cam", "/v2x/denm")


def route(topic: Column, *, demo: bool = False) -> Column:
    """'gps', 'message' or null."""
    if demo:
        return F.when(topic.isin(*DEMO_GPS), "gps").when(topic.isin(*DEMO_MESSAGES), "message")
    holds = lambda parts: topic.rlike("|".join(parts))
    return F.when(holds(GPS_PARTS), "gps").when(holds(MESSAGE_PARTS), "message")


def entry_ids(entries: DataFrame) -> DataFrame:
    """(file, vehicle_id) of every message on the topics that tell ids."""
    sid = S.truthy("message", "header.station_id.value")
    return entries.where(F.col("topic").isin(*ID_TOPICS)).select("file", sid.alias("vehicle_id"))


def topic_positions(entries: DataFrame, ids: DataFrame, *, compat: bool = False, demo: bool = False) -> DataFrame:
    """Positions of gps topics; the vehicle is the one that the file's messages are of, by a join on the file."""
    lat, lon, alt = (S.first_of("message", (n,), "double") for n in ("latitude", "longitude", "altitude"))
    rows = entries.where((route(F.col("topic"), demo=demo) == "gps") & F.col("recording_timestamp_nsec").isNotNull())
    rows = rows.select(
        "file",
        S.nanos_to_millis(F.col("recording_timestamp_nsec"), compat=compat).alias("timestamp_ms"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        alt.alias("altitude"),
        F.lit(None).cast("double").alias("speed_mps"),
        F.lit(None).cast("double").alias("heading_deg"),
        "topic",
        F.col("pos").cast("bigint").alias("ordinal"),
    ).dropna(subset=["latitude", "longitude"])
    unknown = F.lit(None).cast("string") if demo else F.lit("unknown")
    known = F.nullif("vehicle_id", F.lit("unknown")) if demo else F.col("vehicle_id")
    return rows.join(ids.select("file", known.alias("vehicle_id")), "file", "left").withColumn("vehicle_id", F.coalesce("vehicle_id", unknown))


def topic_messages(entries: DataFrame, *, compat: bool = False, demo: bool = False) -> DataFrame:
    """Messages of message topics. entries needs size, that of each message."""
    sender = F.coalesce(S.truthy("message", "header.station_id.value"), F.lit("unknown"))
    kind = F.when(S.has_key("message", "cam"), "CAM").when(S.has_key("message", "denm"), "DENM").otherwise("UNKNOWN")
    frame = S.truthy("message", "header.frame_id")
    address = F.try_variant_get("message", "$.address", "variant")
    shape = F.schema_of_variant(address)
    address = F.when(shape == "STRING", address.try_cast("string")).when(
        shape.startswith("OBJECT"), S.truthy_or("message", "address.value", "address.address")
    )
    is_message = F.schema_of_variant("message").startswith("OBJECT")
    rows = entries.where((route(F.col("topic"), demo=demo) == "message") & F.col("recording_timestamp_nsec").isNotNull() & is_message)
    none = F.lit(None).cast("double")
    return rows.select(
        "file",
        S.nanos_to_millis(F.col("recording_timestamp_nsec"), compat=compat).alias("timestamp_ms"),
        sender.alias("vehicle_id"),
        kind.alias("message_type"),
        F.col("size").cast("bigint").alias("message_size_bytes"),
        sender.alias("sender_id"),
        F.coalesce(address, F.when(frame != sender, frame)).alias("receiver_id"),
        none.alias("latency_ms"),
        none.alias("rssi_dbm"),
        "topic",
        F.col("pos").cast("bigint").alias("ordinal"),
    )


def discovery_summary(objects: DataFrame, total_files: int, *, sample: int | None = None, record: str = "record") -> DataFrame:
    """One row of counts, sorted ids and types over all records; what is like a position counts as one even if it is like a message too."""
    vehicle, _, kind = S.identity(record)
    gnss, message = S.is_gnss_like(record), S.is_message_like(record)
    typed = objects.select(vehicle.alias("v"), kind.alias("k"), F.when(gnss, "g").when(message, "m").otherwise("o").alias("c"))
    return typed.agg(
        F.count_if(F.col("c") == "g").alias("gnss_records"),
        F.count_if(F.col("c") == "m").alias("v2x_records"),
        F.count_if(F.col("c") == "o").alias("other_records"),
        F.array_sort(F.collect_set("v")).alias("unique_vehicles"),
        F.countDistinct("v").alias("vehicle_count"),
        F.array_sort(F.collect_set("k")).alias("message_types"),
    ).select(F.lit(total_files).cast("bigint").alias("total_files"), "*", F.lit(sample).cast("int").alias("sample_limit"))


def discovered_vehicles(objects: DataFrame, *, record: str = "record") -> DataFrame:
    """The distinct vehicle ids as rows, for inputs with more of them than one row should hold."""
    return objects.select(S.identity(record)[0].alias("vehicle_id")).where("vehicle_id is not null").distinct()


def discovery_table(summary: DataFrame) -> DataFrame:
    """The summary as (metric, value) rows."""
    text = lambda c: f"cast({c} as string)"
    rows = [("Total files", text("total_files")), ("GNSS records", text("gnss_records")), ("V2X records", text("v2x_records")), ("Other records", text("other_records")), ("Unique vehicles", text("vehicle_count")), ("Message types", "array_join(message_types, ', ')"), ("Sample limit", "coalesce(cast(sample_limit as string), 'none')")]
    return summary.selectExpr(f"stack({len(rows)}, " + ", ".join(f"'{n}', {e}" for n, e in rows) + ") as (metric, value)")

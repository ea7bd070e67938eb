"""Column builders for time units, truthiness, alias look-up and record parsing.

Records are VARIANT columns, so one expression serves any JSON layout. A "field"
is a list of JSON paths in order of preference.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DIRECTIONS = ("uplink_to_rsu", "downlink_from_rsu", "v2v")
# The names under which a record may hold each field.
VEHICLE_ID = ("stationID", "station_id", "vehicleID", "vehicle_id", "id")
STATION_TYPE = ("stationType", "station_type")
LATITUDE = ("latitude", "lat", "latitude_deg")
LONGITUDE = ("longitude", "lon", "longitude_deg")
ALTITUDE = ("altitude", "alt", "altitude_m")
SPEED = ("speed", "speed_mps", "speedMps")
HEADING = ("heading", "heading_deg", "headingDeg")
MESSAGE_TYPE = ("messageType", "message_type", "msgType")
RSU_ID = ("rsu_id", "rsuID", "rsuId")
MESSAGE_KEYS = (*MESSAGE_TYPE, "tx_timestamp", "rx_timestamp", "direction", "rsu_id", "cam", "denm")


def get(record: Column | str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(record, f"$.{path}", kind)


def first_of(record: Column | str, names: tuple[str, ...], kind: str = "string") -> Column:
    """The first of the names that is present and not null, as the kind; null if that value can't be read as it."""
    found = F.coalesce(*[get(record, n) for n in names])
    return found if kind == "string" else found.try_cast(kind)


def has_key(record: Column | str, path: str) -> Column:
    """Key presence; a key that holds JSON null counts."""
    return F.try_variant_get(record, f"$.{path}", "variant").isNotNull()


def any_key(record: Column | str, paths: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [has_key(record, p) for p in paths])


def truthy(record: Column | str, path: str) -> Column:
    """The value at path as a string, null for '', the number 0 and false; the string '0' is kept."""
    value = F.try_variant_get(record, f"$.{path}", "variant")
    text, kind = get(record, path), F.schema_of_variant(value)
    nothing = F.when(kind == "STRING", text == "").when(kind == "BOOLEAN", text == "false").otherwise(F.coalesce(text.try_cast("double") == 0, F.lit(False)))
    return F.when(~nothing, text)


def truthy_or(record: Column | str, *paths: str) -> Column:
    return F.coalesce(*[truthy(record, p) for p in paths])


def timestamp_unit(ts: Column) -> Column:
    """s below 1e10, ms below 1e13, else us; negative values are seconds."""
    return F.when(ts < 10_000_000_000, "s").when(ts < 10_000_000_000_000, "ms").when(ts.isNotNull(), "us")


def to_millis(ts: Column, unit: Column | str | None = None) -> Column:
    """Epoch milliseconds of an integer time stamp; null stays null. Microseconds are floored."""
    if isinstance(unit, str):
        if unit not in ("s", "ms", "us"):
            raise ValueError(f"unknown time unit {unit!r}: s, ms or us")
        unit = F.lit(unit)
    unit = timestamp_unit(ts) if unit is None else unit
    return F.when(unit == "s", ts * 1000).when(unit == "ms", ts).when(unit == "us", floor_div(ts, 1000))


def floor_div(value: Column, by: int) -> Column:
    """Integer division that rounds down, exact over the whole range of bigint."""
    rest = F.pmod(value, F.lit(by).cast("long"))
    return F.call_function("div", value - rest, F.lit(by).cast("long"))


def integer(value: Column) -> Column:
    """A string as bigint: integers as they are, decimals of JSON numbers truncated, anything else null."""
    plain = value.try_cast("bigint")
    number = F.when(value.rlike(r"^-?\d+\.\d+([eE][-+]?\d+)?$|^-?\d+[eE][-+]?\d+$"), value.try_cast("double").try_cast("bigint"))
    return F.coalesce(plain, number)


def nanos_to_millis(ns: Column, *, compat: bool = False) -> Column:
    """Nanoseconds to milliseconds. compat: by way of a double, which rounds the last millionth up."""
    return (ns.cast("double") / 1e6).cast("bigint") if compat else F.call_function("div", ns, F.lit(1_000_000).cast("long"))


def direction_of(record: Column | str) -> Column:
    found = get(record, "direction")
    return F.when(found.isin(*DIRECTIONS), found)


def is_gnss_like(record: Column | str) -> Column:
    return any_key(record, (*LATITUDE, *LONGITUDE))


def is_message_like(record: Column | str) -> Column:
    return any_key(record, MESSAGE_KEYS) | has_key(record, "header.message_id")


def identity(record: Column | str) -> tuple[Column, Column, Column]:
    """(vehicle id, station type, message type) as profiling sees them, nested places included."""
    vehicle = truthy_or(record, *VEHICLE_ID, "header.station_id.value")
    station = truthy_or(record, *STATION_TYPE, "cam.cam_parameters.basic_container.station_type.value")
    by_key = F.when(has_key(record, "cam"), "CAM").when(has_key(record, "denm"), "DENM")
    number = get(record, "header.message_id").try_cast("int")
    by_number = F.when(number == 2, "CAM").when(number == 1, "DENM")
    return vehicle, station, F.coalesce(truthy_or(record, *MESSAGE_TYPE), by_key, by_number)

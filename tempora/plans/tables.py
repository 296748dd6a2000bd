"""Driver tables seen through the reference's data shapes.

The reference reads a historical temperature CSV and a stream of weather
records; neither ships with it. These projections let the same operators run
over the driver's tables (and grow with them):

historical table (the CSV's columns):
    orders    dt ← o_orderdate, AverageTemperature ← o_totalprice,
              City ← o_custkey, Country ← o_orderpriority,
              Latitude ← o_orderstatus, Longitude ← o_orderkey (text)
    lineitem  dt ← l_shipdate, AverageTemperature ← l_extendedprice,
              AverageTemperatureUncertainty ← l_tax, City ← l_partkey,
              Country ← l_returnflag, Latitude ← l_linestatus,
              Longitude ← l_orderkey (text)
    events    dt ← ts, AverageTemperature ← value, City ← user_id,
              Country ← event_type, Latitude ← event_id (text), Longitude ← props
stream record:
    events    timestamp ← ts, city ← event_type, country ← 'events',
              temperature_celsius ← value, wind_speed_kmh ← user_id,
              wind_direction_deg ← event_id mod 360, humidity_percent ← props.k,
              pressure_hpa ← 1000 + event_id mod 50, source ← 'events'
vendor payloads:
    lineitem  one payload per line, numbers taken from the line's columns.

Dates are handed over typed (parsed by a cast, no text round trip), except
with ``faults=True``, which lands them as text and injects, deterministically
and identically in the SQL oracle, the defects the cleaner must handle (the
rows stay; the cleaner drops them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.operators.partitioning import spread
from tempora.schemas import RECORD_COLUMNS

# Fault injection on the historical table: (modulus of the row key, defect).
FAULT_TEMPERATURE_NULL = 7
FAULT_BAD_DATE = 11
FAULT_CITY_NULL = 13
FAULT_COUNTRY_NULL = 17
FAULT_NOT_A_NUMBER = 19
BAD_DATE_TEXT = "not-a-date"
BAD_NUMBER_TEXT = "n/a"

EVENTS_COUNTRY = "events"
EVENTS_SOURCE = "events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _date_text(ts: str) -> Column:
    return F.date_format(F.col(ts), "yyyy-MM-dd")


def _landed_date(ts: str) -> Column:
    """The date as landed: typed (Parquet keeps types), parsed by a cast."""
    return F.col(ts)


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def history_from_orders(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    dt = _landed_date("o_orderdate")
    temp: Column = F.col("o_totalprice")
    city: Column = F.col("o_custkey")
    country: Column = F.col("o_orderpriority")
    if faults:
        dt = F.when(key % FAULT_BAD_DATE == 0, F.lit(BAD_DATE_TEXT)).otherwise(_date_text("o_orderdate"))
        temp_text = F.when(key % FAULT_NOT_A_NUMBER == 0, F.lit(BAD_NUMBER_TEXT)).otherwise(temp.cast("string"))
        temp = _null_when(key % FAULT_TEMPERATURE_NULL == 0, temp_text)
        city = _null_when(key % FAULT_CITY_NULL == 0, city)
        country = _null_when(key % FAULT_COUNTRY_NULL == 0, country)
    return o.select(
        dt.alias("dt"),
        temp.alias("AverageTemperature"),
        F.lit(None).cast("double").alias("AverageTemperatureUncertainty"),
        city.alias("City"),
        country.alias("Country"),
        F.col("o_orderstatus").alias("Latitude"),
        key.cast("string").alias("Longitude"),
    )


def history_from_lineitem(spark: SparkSession, sf_dir: str, city: str = "l_partkey",
                          country: str = "l_returnflag") -> DataFrame:
    """``city`` picks the key standing for the city: parts (many small groups)
    or suppliers (``l_suppkey``: groups of about 200 lines); ``country`` the one
    standing for the country."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _landed_date("l_shipdate").alias("dt"),
        F.col("l_extendedprice").alias("AverageTemperature"),
        F.col("l_tax").alias("AverageTemperatureUncertainty"),
        F.col(city).alias("City"),
        F.col(country).alias("Country"),
        F.col("l_linestatus").alias("Latitude"),
        F.col("l_orderkey").cast("string").alias("Longitude"),
    )


def history_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        _landed_date("ts").alias("dt"),
        F.col("value").alias("AverageTemperature"),
        F.lit(None).cast("double").alias("AverageTemperatureUncertainty"),
        F.col("user_id").alias("City"),
        F.col("event_type").alias("Country"),
        F.col("event_id").cast("string").alias("Latitude"),
        F.col("props").alias("Longitude"),
    )


def events_as_records(events: DataFrame) -> DataFrame:
    """Events (batch or stream) → the 11-field record; ``timestamp`` keeps the
    source's timestamp type (parsed only when it is text)."""
    eid = F.col("event_id")
    return events.select(
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("city"),
        F.lit(EVENTS_COUNTRY).alias("country"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lon"),
        F.col("value").alias("temperature_celsius"),
        F.col("user_id").cast("double").alias("wind_speed_kmh"),
        (eid % 360).cast("int").alias("wind_direction_deg"),
        F.get_json_object("props", "$.k").try_cast("double").alias("humidity_percent"),
        (F.lit(1000) + eid % 50).cast("double").alias("pressure_hpa"),
        F.lit(EVENTS_SOURCE).alias("source"),
    ).select(*RECORD_COLUMNS)


def _line_context(li: DataFrame) -> list[Column]:
    return [
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("record_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("l_returnflag").alias("city"),
        F.col("l_linestatus").alias("country"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lon"),
    ]


def point_payload(li: DataFrame) -> Column:
    """Arrays per parameter; line number 7 carries an empty temperature array."""
    q, disc, tax = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    n_temp = F.when(F.col("l_linenumber") == 7, F.lit(0)).otherwise(F.lit(1))
    return F.to_json(
        F.struct(
            F.slice(F.array(q + F.lit(250.0)), 1, n_temp).alias("temp-surface"),
            F.array(F.round(disc * 100) - 5).alias("wind_u-surface"),
            F.array(F.round(tax * 100) - 4).alias("wind_v-surface"),
            F.array(F.col("l_linenumber") * 12.5).alias("rh-surface"),
            F.array(F.col("l_extendedprice")).alias("pressure-surface"),
            F.array(F.lit(0.0)).alias("precip-surface"),
        )
    )


def current_payload(li: DataFrame) -> Column:
    q = F.col("l_quantity")
    return F.to_json(
        F.struct(
            F.struct(
                (q - 20.5).alias("temperature_2m"),
                (F.col("l_linenumber") * 10.0).alias("relative_humidity_2m"),
                (q + 1000.0).alias("pressure_msl"),
                (F.col("l_discount") * 100).alias("wind_speed_10m"),
                ((F.col("l_partkey") % 360) + 0.5).alias("wind_direction_10m"),
            ).alias("current")
        )
    )


def main_wind_payload(li: DataFrame) -> Column:
    """``main`` and ``wind`` objects; line number 7 has no ``wind`` object."""
    q, disc = F.col("l_quantity"), F.col("l_discount")
    wind = F.struct((disc * 100).alias("speed"), (F.col("l_partkey") % 360).cast("double").alias("deg"))
    return F.to_json(
        F.struct(
            F.struct(
                (q - 10.25).alias("temp"),
                (F.col("l_tax") * 1000).alias("humidity"),
                (disc * 100 + 990).alias("pressure"),
            ).alias("main"),
            F.when(F.col("l_linenumber") != 7, wind).alias("wind"),
        )
    )


_PAYLOAD_COLUMNS = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

PAYLOADS = {"point": point_payload, "current": current_payload, "main_wind": main_wind_payload}


BROKEN = 5  # every so many line items, with faults, a payload is cut off


def payloads_from_lineitem(spark: SparkSession, sf_dir: str, vendor: str | None = None, faults: bool = False) -> DataFrame:
    """Landed raw payloads, one per line item.

    With ``faults`` the payload of every ``BROKEN``-th order is cut off.

    With ``vendor`` every row has that shape; without, the shape is chosen by
    ``l_linenumber mod 4`` (point, current, main_wind, and an unknown vendor)."""
    # only the columns the payloads use, then spread: JSON building is CPU-heavy per row
    li = spread(table(spark, sf_dir, "lineitem").select(*_PAYLOAD_COLUMNS))
    ctx = _line_context(li)
    if vendor is not None:
        return li.select(*ctx, F.lit(vendor).alias("vendor"), PAYLOADS[vendor](li).alias("payload"))
    m = F.col("l_linenumber") % 4
    vendor_col = (
        F.when(m == 0, F.lit("point")).when(m == 1, F.lit("current")).when(m == 2, F.lit("main_wind"))
        .otherwise(F.lit("unknown"))
    )
    payload = (
        F.when(m == 0, point_payload(li)).when(m == 1, current_payload(li)).when(m == 2, main_wind_payload(li))
        .otherwise(F.lit("{}"))
    )
    if faults:
        payload = F.when(F.col("l_orderkey") % BROKEN == 0, F.lit('{"current": {')).otherwise(payload)
    return li.select(*ctx, vendor_col.alias("vendor"), payload.alias("payload"))

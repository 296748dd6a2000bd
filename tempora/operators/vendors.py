"""Vendor payloads → the 11-field measurement record, as one Spark job.

Landed raw JSON payloads (one per row) are parsed once, into a VARIANT, and
converted with column expressions that read its fields. ``route`` tells the
rows whose vendor is known and whose payload decodes from the others in the
same pass; ``normalise`` and ``rejects`` are its two sides. Missing values, and
values that are no numbers, stay null; a number given as text is read as one.
``fill_zero=True`` restores the reference's zero defaults.

A payload decodes if it is a JSON object by the standard: one with a key twice,
with single quotes or with NaN is a reject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.functions.units import (
    kelvin_to_celsius,
    ms_to_kmh,
    pa_to_hpa,
    wind_bearing,
    wind_speed,
)
from tempora.schemas import RECORD, RECORD_COLUMNS

# Payload shapes known to the router.
POINT = "point"  # arrays per parameter: Kelvin, m/s components, %, Pa
CURRENT = "current"  # "current" object, already in target units
MAIN_WIND = "main_wind"  # "main" and "wind" objects, m/s
VENDORS = (POINT, CURRENT, MAIN_WIND)

_PASS_THROUGH = ["timestamp", "city", "country", "lat", "lon"]
_MEASURES = ["temperature_celsius", "wind_speed_kmh", "wind_direction_deg", "humidity_percent", "pressure_hpa"]


def _zero(c: Column, fill_zero: bool) -> Column:
    return F.coalesce(c, F.lit(0.0)) if fill_zero else c


_PARSED = "_parsed"
_SPACE = " \t\r\n"


def _is_object(payload: str, parsed: Column) -> Column:
    """The payload is a JSON object (its fields may still be missing)."""
    return parsed.isNotNull() & F.ltrim(F.col(payload), F.lit(_SPACE)).startswith("{")


def _number(p: Column, path: str) -> Column:
    return F.try_variant_get(p, path, "double")


def point_measures(p: Column, fill_zero: bool = False) -> dict[str, Column]:
    def first(name: str) -> Column:
        return _number(p, f"$['{name}'][0]")

    u, v = _zero(first("wind_u-surface"), fill_zero), _zero(first("wind_v-surface"), fill_zero)
    return {
        "temperature_celsius": kelvin_to_celsius(first("temp-surface")),
        "wind_speed_kmh": ms_to_kmh(wind_speed(u, v)),
        "wind_direction_deg": wind_bearing(u, v),
        "humidity_percent": F.round(first("rh-surface"), 1),
        "pressure_hpa": pa_to_hpa(first("pressure-surface")),
    }


def current_measures(p: Column, fill_zero: bool = False) -> dict[str, Column]:
    def field(name: str) -> Column:
        return _zero(_number(p, f"$.current.{name}"), fill_zero)

    return {
        "temperature_celsius": field("temperature_2m"),
        "wind_speed_kmh": field("wind_speed_10m"),
        "wind_direction_deg": field("wind_direction_10m").try_cast("int"),
        "humidity_percent": field("relative_humidity_2m"),
        "pressure_hpa": field("pressure_msl"),
    }


def main_wind_measures(p: Column, fill_zero: bool = False) -> dict[str, Column]:
    def field(path: str) -> Column:
        return _zero(_number(p, f"$.{path}"), fill_zero)

    return {
        "temperature_celsius": F.round(field("main.temp"), 2),
        "wind_speed_kmh": ms_to_kmh(field("wind.speed")),
        "wind_direction_deg": field("wind.deg").try_cast("int"),
        "humidity_percent": F.round(field("main.humidity"), 1),
        "pressure_hpa": F.round(field("main.pressure"), 1),
    }


_BUILDERS = {POINT: point_measures, CURRENT: current_measures, MAIN_WIND: main_wind_measures}


def _parse(df: DataFrame, payload: str) -> DataFrame:
    return df.withColumn(_PARSED, F.try_parse_json(F.col(payload)))


def _record(df: DataFrame, measures: dict[str, Column], source: Column, keep: list[str]) -> DataFrame:
    cols = [F.col(c).cast(RECORD[c].dataType).alias(c) for c in _PASS_THROUGH]
    cols += [measures[m].cast(RECORD[m].dataType).alias(m) for m in _MEASURES]
    cols.append(source.alias("source"))
    return df.select(*keep, *cols).select(*keep, *RECORD_COLUMNS)


def normalise_point(df: DataFrame, payload: str = "payload", fill_zero: bool = False,
                    source: str = POINT, keep: list[str] = ()) -> DataFrame:
    """Point-forecast payload: first array element, K → °C, Pa → hPa, u/v → km/h and bearing."""
    return _record(_parse(df, payload), point_measures(F.col(_PARSED), fill_zero), F.lit(source), list(keep))


def normalise_current(df: DataFrame, payload: str = "payload", fill_zero: bool = False,
                      source: str = CURRENT, keep: list[str] = ()) -> DataFrame:
    """"Current weather" object: fields taken as they are."""
    return _record(_parse(df, payload), current_measures(F.col(_PARSED), fill_zero), F.lit(source), list(keep))


def normalise_main(df: DataFrame, payload: str = "payload", fill_zero: bool = False,
                   source: str = MAIN_WIND, keep: list[str] = ()) -> DataFrame:
    """``main``/``wind`` objects: m/s → km/h, 2 / 1 dp rounding."""
    return _record(_parse(df, payload), main_wind_measures(F.col(_PARSED), fill_zero), F.lit(source), list(keep))


def route(df: DataFrame, vendor: str = "vendor", payload: str = "payload") -> DataFrame:
    """``df`` with ``_parsed``, the payload's VARIANT, and ``_accepted``: the vendor
    has a normaliser and the payload is a JSON object. One parse for decoding,
    routing and rejecting; write it once to take both sides from it."""
    parsed = _parse(df, payload)
    accepted = F.coalesce(F.col(vendor).isin(*VENDORS), F.lit(False)) & _is_object(payload, F.col(_PARSED))
    return parsed.withColumn("_accepted", F.coalesce(accepted, F.lit(False)))


def _side(routed: DataFrame, accepted: bool) -> DataFrame:
    """The rows on one side, by a generator: a filter would be pushed below the
    parse (and below whatever makes the payload) and repeat it."""
    keep = F.when(F.col("_accepted") == accepted, F.array(F.lit(0)))
    return routed.select("*", F.explode(keep).alias("_kept")).drop("_kept", "_accepted")


def normalise(df: DataFrame, vendor: str = "vendor", payload: str = "payload", fill_zero: bool = False,
              keep: list[str] = ()) -> DataFrame:
    """Route each row to its vendor's conversion in one projection.

    Rows with an unknown vendor or a payload that doesn't decode are left out;
    ``rejects`` returns them."""
    v = F.col(vendor)
    known = _side(route(df.filter(v.isin(*VENDORS)), vendor, payload), True)
    built = {name: fn(F.col(_PARSED), fill_zero) for name, fn in _BUILDERS.items()}
    measures = {}
    for m in _MEASURES:
        expr = None
        for name in VENDORS:
            expr = F.when(v == name, built[name][m]) if expr is None else expr.when(v == name, built[name][m])
        measures[m] = expr
    return _record(known, measures, v, list(keep))


def rejects(df: DataFrame, vendor: str = "vendor", payload: str = "payload") -> DataFrame:
    """Rows whose vendor has no normaliser (null vendor included), or whose
    payload is no JSON object (null, cut off, garbage)."""
    return _side(route(df, vendor, payload), False).drop(_PARSED)

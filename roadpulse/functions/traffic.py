"""Column functions over one reading: congestion, time features, location, flags."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.functions.casts import round_dec
from roadpulse.schema import (
    BOROUGHS,
    CONGESTED_MPH,
    CONGESTION_LEVELS,
    FREE_FLOW_MPH,
    MAP_LATITUDE,
    MAP_LONGITUDE,
    MODERATE_MPH,
    PEAK_HOURS,
    QUALITY_FLAGS,
    SCORE_REFERENCE_MPH,
    TIME_BUCKETS,
    UNKNOWN,
)


def congestion_level(speed: Column) -> Column:
    return (
        F.when(speed.isNull(), UNKNOWN)
        .when(speed >= FREE_FLOW_MPH, "FREE_FLOW")
        .when(speed >= MODERATE_MPH, "MODERATE")
        .when(speed >= CONGESTED_MPH, "CONGESTED")
        .otherwise("SEVERE")
    )


def congestion_score(speed: Column) -> Column:
    """0 at or above the reference speed, 1 at standstill; null stays null."""
    share = F.least(speed / SCORE_REFERENCE_MPH, F.lit(1.0))
    return F.when(speed.isNotNull(), round_dec(F.lit(1.0) - share, 4))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """1 is Sunday, 7 is Saturday."""
    return F.dayofweek(ts)


def is_weekend(day: Column) -> Column:
    return day.isin(1, 7)


def _in_hours(hour: Column, window: tuple[int, int]) -> Column:
    return (hour >= window[0]) & (hour < window[1])


def is_peak_hour(hour: Column, day: Column) -> Column:
    morning, evening = PEAK_HOURS
    return ~is_weekend(day) & (_in_hours(hour, morning) | _in_hours(hour, evening))


def time_bucket(hour: Column, day: Column) -> Column:
    morning, evening = PEAK_HOURS
    overnight, morning_peak, off_peak, evening_peak = TIME_BUCKETS
    weekday = ~is_weekend(day)
    return (
        F.when(hour.isNull(), F.lit(None).cast("string"))
        .when(hour < 6, overnight)
        .when(weekday & _in_hours(hour, morning), morning_peak)
        .when(weekday & _in_hours(hour, evening), evening_peak)
        .otherwise(off_peak)
    )


def calendar_features(hour: Column, day: Column) -> dict[str, Column]:
    """Features that follow from hour and weekday; all null for a null time."""
    return {
        "is_weekend": is_weekend(day),
        "is_peak_hour": is_peak_hour(hour, day),
        "time_bucket": time_bucket(hour, day),
    }


_COORDINATES = r"^\s*([+-]?[0-9]*\.?[0-9]+),([+-]?[0-9]*\.?[0-9]+)( |$)"


def first_location(points: Column) -> dict[str, Column]:
    """First ``lat,lon`` pair; both null unless it is exactly two numbers."""
    lat = F.regexp_extract(points, _COORDINATES, 1)
    lon = F.regexp_extract(points, _COORDINATES, 2)
    return {"latitude": lat.try_cast("double"), "longitude": lon.try_cast("double")}


def _missing(text: Column) -> Column:
    return text.isNull() | (text == "")


def quality_flags(speed: Column, ts: Column, borough: Column, link_id: Column) -> Column:
    """Flags in fixed order; an empty string counts as missing."""
    conditions = [speed.isNull(), speed == 0.0, ts.isNull(), _missing(borough), _missing(link_id)]
    none = F.array().cast("array<string>")
    return F.concat(
        *[F.when(cond, F.array(F.lit(flag))).otherwise(none) for cond, flag in zip(conditions, QUALITY_FLAGS)]
    )


def encode_borough(borough: Column) -> Column:
    """Position in the fixed list, -1 for anything else."""
    names = F.array(*[F.lit(b) for b in BOROUGHS])
    position = F.array_position(names, borough) - F.lit(1)
    return F.coalesce(position, F.lit(-1)).cast("int")


def encode_level(level: Column) -> Column:
    names = F.array(*[F.lit(name) for name in CONGESTION_LEVELS])
    position = F.array_position(names, level) - F.lit(1)
    return F.coalesce(position, F.lit(-1)).cast("int")


def decode_level(code: Column) -> Column:
    names = F.array(*[F.lit(name) for name in CONGESTION_LEVELS])
    return F.coalesce(F.get(names, code.cast("int")), F.lit(UNKNOWN))


def borough_partition(borough: Column) -> Column:
    """Partition number of a known borough, null for an unknown one."""
    code = encode_borough(borough)
    return F.when(code >= 0, code)


def inside_map(latitude: Column, longitude: Column) -> Column:
    return latitude.between(*MAP_LATITUDE) & longitude.between(*MAP_LONGITUDE)


def is_congested(level: Column) -> Column:
    return level.isin("CONGESTED", "SEVERE")

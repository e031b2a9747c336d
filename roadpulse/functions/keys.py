"""Message keys, deduplication keys, identifiers and display labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.functions.casts import round_dec


def _filled(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def message_key(record_id: Column, link_id: Column) -> Column:
    return F.coalesce(_filled(record_id), _filled(link_id), F.lit(""))


def dedup_key(record_id: Column, link_id: Column, data_as_of: Column) -> Column:
    return F.concat_ws("_", message_key(record_id, link_id), F.coalesce(data_as_of, F.lit("")))


def lineage_id(phase: Column, started_at: Column, batch_id: Column) -> Column:
    """Same id for every retry of one batch."""
    digest = F.substring(F.sha2(F.concat_ws("|", phase, batch_id), 256), 1, 8)
    return F.concat_ws("_", phase, F.date_format(started_at, "yyyyMMdd'T'HHmmss"), digest)


def record_label(link_name: Column, borough: Column, speed: Column) -> Column:
    shown = F.format_string("%.1f", round_dec(speed, 1))
    return F.concat_ws(
        " | ",
        F.substring(F.coalesce(link_name, F.lit("?")), 1, 35),
        F.coalesce(borough, F.lit("?")),
        F.concat(F.when(speed.isNull(), "?").otherwise(shown), F.lit(" mph")),
    )


def minutes_between(later: Column, earlier: Column) -> Column:
    seconds = F.unix_micros(later) - F.unix_micros(earlier)
    return seconds / F.lit(60000000.0)

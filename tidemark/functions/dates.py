"""Date and time dialects of the sources, as expressions on text or number columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.coerce import to_timestamp

# Fixed patterns: dates in milliseconds, relative times, HL7 time stamps.
MS_DATE = r"^/Date\((-?\d+)([+-]\d{4})?\)/"
RELATIVE = r"^\*-(\d+)([mhd])$"
HL7_DTM = r"^(\d{4}(?:\d{2}){0,5})(?:\.\d+)?([+-]\d{4})?$"
HL7_FILL = "00000101000000"  # month and day 1, time 0 where the precision is partial


def ms_date_to_iso(text: Column) -> Column:
    """``/Date(ms)/`` or ``/Date(ms+off)/`` as ISO text in UTC; other text is unchanged.

    The milliseconds already are UTC, so the offset is ignored.
    """
    ms = F.regexp_extract(text, MS_DATE, 1).try_cast("bigint")
    iso = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.when(text.rlike(MS_DATE), F.coalesce(iso, text)).otherwise(text)


def epoch_ms(value: Column) -> Column:
    """Epoch milliseconds (number or text) as a timestamp; no number is null."""
    return F.timestamp_millis(value.cast("string").try_cast("bigint"))


def compact_date(text: Column) -> Column:
    """``YYYYMMDD`` text as a date, null when it is none."""
    return F.when(text.rlike(r"^\d{8}"), F.try_to_timestamp(F.substring(text, 1, 8), F.lit("yyyyMMdd"))).cast("date")


def relative_time(text: Column, now: Column) -> Column:
    """``*``, ``*-10m``, ``*-2h``, ``*-7d`` or ISO text; anything else is ``now``."""
    t = F.trim(text)
    n = F.regexp_extract(t, RELATIVE, 1).try_cast("int")
    unit = F.regexp_extract(t, RELATIVE, 2)
    zero = F.lit(0)
    back = now - F.make_interval(
        days=F.when(unit == "d", n).otherwise(zero),
        hours=F.when(unit == "h", n).otherwise(zero),
        mins=F.when(unit == "m", n).otherwise(zero),
    )
    return F.when(t.rlike(RELATIVE), back).otherwise(F.coalesce(to_timestamp(t), now))


def hl7_dtm(text: Column) -> Column:
    """HL7 date-time text (4 to 14 digits, fraction dropped, offset applied) as ISO text in UTC."""
    t = F.regexp_replace(F.trim(text), r"^[()]+|[()]+$", "")
    digits, offset = F.regexp_extract(t, HL7_DTM, 1), F.regexp_extract(t, HL7_DTM, 2)
    full = F.concat(digits, F.substring(F.lit(HL7_FILL), F.length(digits) + 1, F.lit(14)), F.when(offset == "", "Z").otherwise(offset))
    return F.date_format(F.try_to_timestamp(full, F.lit("yyyyMMddHHmmssXX")), "yyyy-MM-dd'T'HH:mm:ss")

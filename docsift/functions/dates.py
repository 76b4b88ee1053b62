"""Mail dates as columns. All native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day, month, year, hour, minute, second, zone; whatever follows is a comment.
_DATE = (
    r"(?is)\A\s*(?:[a-z]+\.?\s*,)?\s*(\d{1,2})\s+([a-z]{3})[a-z]*\.?\s+(\d{2,4})"
    r"\s+(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([+-]\d{4}|[a-z]+)?.*\z"
)
_MARK = "\x1f"

# The zone names of RFC 822 and their offsets.
ZONE_OFFSETS = {
    "UT": "+0000",
    "GMT": "+0000",
    "UTC": "+0000",
    "Z": "+0000",
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}


def mail_date_iso(value: Column) -> Column:
    """ISO-8601 form of a mail date with its own offset (``Z`` when zero). The weekday is ignored; bad dates give NULL."""
    # One match writes all fields next to each other; binding the pieces to a variable keeps it at one match per row.
    fields = F.regexp_replace(value, _DATE, _MARK.join(f"${i}" for i in range(1, 8)))
    return F.get(F.transform(F.array(F.split(fields, _MARK, -1)), _iso_of), F.lit(0))


def _iso_of(pieces: Column) -> Column:
    day, month, year, hour, minute, second, zone = (F.get(pieces, F.lit(i)) for i in range(7))
    position = F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(month))
    month_no = F.when(position % 3 == 1, F.floor((position + 2) / 3).cast("string"))
    full_year = (
        F.when(F.length(year) == 4, year)
        .when(F.length(year) == 3, (year.cast("int") + 1900).cast("string"))
        .otherwise(F.concat(F.when(year < "50", F.lit("20")).otherwise(F.lit("19")), year))
    )
    zones = F.create_map(*[F.lit(x) for pair in ZONE_OFFSETS.items() for x in pair])
    offset = F.when(zone.rlike("^[+-]"), zone).otherwise(F.coalesce(F.try_element_at(zones, F.upper(zone)), F.lit("+0000")))
    shown = F.when(F.substr(offset, F.lit(2)) == "0000", F.lit("Z")).otherwise(
        F.concat(F.substr(offset, F.lit(1), F.lit(3)), F.lit(":"), F.substr(offset, F.lit(4), F.lit(2)))
    )
    two = lambda c: F.lpad(c, 2, "0")
    date = F.concat_ws("-", full_year, two(month_no), two(day))
    time = F.concat_ws(":", two(hour), minute, F.when(second == "", F.lit("00")).otherwise(second))
    local = F.concat(date, F.lit("T"), time)
    valid = (F.size(pieces) == 7) & month_no.isNotNull() & F.try_to_timestamp(local).isNotNull()
    return F.when(valid, F.concat(local, shown))


def mail_date_utc(value: Column) -> Column:
    """A mail date as an instant."""
    return F.try_to_timestamp(mail_date_iso(value))

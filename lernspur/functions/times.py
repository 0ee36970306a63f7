"""Event times from mixed text forms, and zone-free times; nothing depends on the session's time zone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# --- fixed values: text forms of event times, tried in this order after ISO 8601 ----
TIME_FORMATS = (
    "M/d/yyyy[ H:m[:s][.SSSSSS][.SSS]]",
    "M/d/yyyy h:m[:s] a",
    "MMM d, yyyy[ H:m[:s][.SSSSSS][.SSS]]",
    "MMM d, yyyy h:m[:s] a",
    "MMMM d, yyyy[ H:m[:s]]",
    "d MMM yyyy[ H:m[:s]]",
    "d MMMM yyyy[ H:m[:s]]",
    "d-MMM-yyyy[ H:m[:s]]",
    "yyyy/M/d[ H:m[:s][.SSSSSS][.SSS]]",
    "yyyyMMddHHmmss",
)
DAY_NAME = r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s+"
ISO_ENDS = ("Z", ":00Z", ":00:00Z", "T00:00:00Z", "-01T00:00:00Z")
HAS_ZONE = r"^\d{4,6}-\d{1,2}-\d{1,2}[T ].*[A-Za-z+-]"
UTC_NAME = r"\s*(GMT|UTC)$"
LATEST_SECOND = 9_223_372_036  # last second a 64-bit nanosecond clock can hold
# ------------------------------------------------------------------------------------

NO_ZONE = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out, and written into the plan, once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def parse_timestamp(text: Column, formats: tuple[str, ...] = TIME_FORMATS) -> Column:
    """Time from mixed text forms; null if none fits.

    ISO 8601 first, then ``formats``, each with or without an offset, then a plain number read as the coarsest of
    seconds, milliseconds, microseconds and nanoseconds that keeps the year below 2262. Texts without a zone are UTC.
    """
    # Formats without separators read as many digits as they have letters; no other format reads a plain number.
    lengths = sorted({len(f) for f in formats if f.isalpha()})

    def number(t: Column) -> Column:
        return bound(t.try_cast("bigint"), lambda n: F.timestamp_micros(
            F.when(n <= LATEST_SECOND, n * 1_000_000)
            .when(n <= LATEST_SECOND * 1_000, n * 1_000)
            .when(n <= LATEST_SECOND * 1_000_000, n)
            .otherwise(F.floor(n / 1_000))))

    def iso(t: Column) -> Column:
        # A text with a zone of its own does not parse with another one behind it.
        with_zone = [F.concat(t, F.lit(z)).try_cast("timestamp") for z in ISO_ENDS]
        return F.coalesce(*with_zone, F.when(t.rlike(HAS_ZONE), t.try_cast("timestamp")))

    def formatted(t: Column) -> Column:
        named = F.regexp_replace(F.regexp_replace(t, DAY_NAME, ""), UTC_NAME, " +0000")
        dated = bound(named, lambda n: F.when(n.rlike(r" [+-]\d{4}$"), n).otherwise(F.concat(n, F.lit(" +0000"))))
        return bound(dated, lambda d: F.coalesce(*[F.try_to_timestamp(d, F.lit(f"{f} Z")) for f in formats]))

    def parsed(t: Column) -> Column:
        # Each format that fails costs an exception, so numbers of other lengths skip them all.
        digits = t.rlike(r"^\d+$")
        return F.coalesce(
            F.when(t.rlike(r"^\d{4,6}-"), iso(t)),
            F.when(~digits | F.length(t).isin(lengths), formatted(t)),
            F.when(digits, number(t)))

    return bound(F.btrim(text), parsed)


def utc_micros(zone_free: Column) -> Column:
    """Microseconds since 1970 of a zone-free time, read as UTC."""
    return F.timestamp_diff("MICROSECOND", F.expr(NO_ZONE), zone_free)


def zone_free(time: Column) -> Column:
    """The UTC clock of an instant as a zone-free time."""
    seconds = (F.unix_micros(time).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr(NO_ZONE) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def utc_text(time: Column, zoned: bool = True) -> Column:
    """ISO 8601 text of an instant in UTC."""
    text = F.date_format(zone_free(time), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(text, F.lit("Z")) if zoned else text

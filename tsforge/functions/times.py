"""Times in nanoseconds since 1970 and calendar periods, all UTC."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000_000
DAY = 86_400 * SECOND
HOUR = 3_600 * SECOND
EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


@dataclass(frozen=True)
class Unit:
    """A calendar unit: the number of the one that holds a moment, and where a number begins; the same of columns of dates or times."""

    number: Callable[[datetime], int]
    begins: Callable[[int], datetime]
    floor: Callable[[Column], Column]
    after: Callable[[Column], Column]


def _of_length(length: int) -> Unit:
    step = timedelta(microseconds=length // 1000)
    return Unit(lambda t: (t - EPOCH) // step, lambda n: EPOCH + n * step, lambda t: floor_div(t, length) * length, lambda start: start + length)


def _of_months(months: int, name: str) -> Unit:
    day = lambda start: F.date_from_unix_date(floor_div(start, DAY).cast("int"))
    ns = lambda date_: F.unix_date(date_).cast("long") * DAY
    begins = lambda n: datetime(n * months // 12, n * months % 12 + 1, 1, tzinfo=UTC)
    return Unit(lambda t: (t.year * 12 + t.month - 1) // months, begins, lambda t: ns(F.trunc(day(t), name)), lambda start: ns(F.add_months(day(start), months)))


UNITS = {"1h": _of_length(HOUR), "1d": _of_length(DAY), "1month": _of_months(1, "month"), "1year": _of_months(12, "year")}
PERIODS = (*UNITS, "all")


def floor_div(value: Column, unit: int) -> Column:
    """Division that rounds down for negative times as well."""
    u = F.lit(unit).cast("long")
    return F.call_function("div", value - F.pmod(value, u), u)


def date_of(time_ns: Column) -> Column:
    """The day of a time; nanoseconds that 64 bits can't hold come as a decimal without fraction."""
    return F.date_from_unix_date(floor_div(time_ns, DAY).cast("int"))


def day_text(day: Column) -> Column:
    """Year, month and day as digits in any year: the astronomical one, with a minus before 0 and no plus after 9999."""
    year = F.year(day).cast("string")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return F.concat(F.when(F.year(day).between(0, 999), F.lpad(year, 4, "0")).otherwise(year), F.lit("-"), two(F.month(day)), F.lit("-"), two(F.day(day)))


def micros(time_ns: Column) -> Column:
    return F.timestamp_micros(floor_div(time_ns, 1000))


def rfc3339(time_ns: Column) -> Column:
    """With nine fractional digits and a Z."""
    seconds = floor_div(time_ns, SECOND)
    moment = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    fraction = F.lpad(F.pmod(time_ns, F.lit(SECOND).cast("long")).cast("string"), 9, "0")
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), fraction, F.lit("Z"))


def parse_rfc3339(text: Column) -> Column:
    """Nanoseconds of a UTC time with up to nine fractional digits; null if it is none."""
    pattern = r"^(\d{4}-\d{2}-\d{2})T(\d{2}):(\d{2}):(\d{2})(?:\.(\d{1,9}))?Z$"
    part = lambda i: F.regexp_extract(text, pattern, i)
    days = F.datediff(part(1).try_cast("date"), F.lit(date(1970, 1, 1))).cast("long")
    seconds = part(2).try_cast("long") * 3600 + part(3).try_cast("long") * 60 + part(4).try_cast("long")
    return F.when(text.rlike(pattern), days * DAY + seconds * SECOND + F.rpad(part(5), 9, "0").try_cast("long"))


def as_utc(moment: datetime) -> datetime:
    if moment.tzinfo is None:
        raise ValueError("a time without a time zone")
    return moment.astimezone(UTC)


def to_ns(moment: datetime) -> int:
    since = as_utc(moment) - datetime(1970, 1, 1, tzinfo=UTC)
    return (since.days * 86_400 + since.seconds) * SECOND + since.microseconds * 1000


@dataclass(frozen=True)
class Period:
    """A half-open interval."""

    start: datetime
    end: datetime

    @property
    def id(self) -> str:
        return "_".join(boundary_text(x) for x in (self.start, self.end))

    @property
    def bounds(self) -> tuple[int, int]:
        return to_ns(self.start), to_ns(self.end)


def boundary_text(moment: datetime) -> str:
    return as_utc(moment).strftime("%Y%m%dT%H%M%S.%fZ" if moment.microsecond else "%Y%m%dT%H%M%SZ")


def iter_periods(start: datetime, end: datetime, period: str) -> Iterator[Period]:
    """Calendar periods from start to end, the first and last clipped."""
    start, end = as_utc(start), as_utc(end)
    if start >= end:
        raise ValueError("a range that ends before it starts")
    if period not in PERIODS:
        raise ValueError(f"no such period: {period!r}")
    inner: list[datetime] = []
    if period != "all":
        unit = UNITS[period]
        inner = [unit.begins(n) for n in range(unit.number(start) + 1, unit.number(end - timedelta(microseconds=1)) + 1)]
    edges = [start, *inner, end]
    return map(Period, edges, edges[1:])


def period_of(time_ns: Column, start: datetime, end: datetime, period: str) -> Column:
    """A struct of the start and end (ns) of the one of ``iter_periods`` that holds a time; null outside the range."""
    first, past = (F.lit(to_ns(t)).cast("long") for t in (start, end))
    if period == "all":
        low, high = first, past
    else:
        low = UNITS[period].floor(time_ns)
        low, high = F.greatest(low, first), F.least(UNITS[period].after(low), past)
    return F.when((time_ns >= first) & (time_ns < past), F.struct(low.alias("start"), high.alias("end")))


def period_id(start_ns: Column, end_ns: Column) -> Column:
    """The id of a period, as ``Period.id``."""
    def text(t):
        moment = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), floor_div(t, SECOND).cast("decimal(18,6)"))
        micros_ = F.call_function("div", F.pmod(t, F.lit(SECOND).cast("long")), F.lit(1000).cast("long"))
        fraction = F.when(micros_ > 0, F.concat(F.lit("."), F.lpad(micros_.cast("string"), 6, "0"))).otherwise("")
        return F.concat(F.date_format(moment, "yyyyMMdd'T'HHmmss"), fraction, F.lit("Z"))

    return F.concat(text(start_ns), F.lit("_"), text(end_ns))


def dates_between(start: datetime, end: datetime) -> list[date]:
    """Days that a half-open range touches."""
    first, last = as_utc(start).date(), (as_utc(end) - timedelta(microseconds=1)).date()
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def iso_duration(nanoseconds: int) -> str:
    whole, rest = divmod(nanoseconds, SECOND)
    return f"PT{whole}" + (f".{rest:09d}".rstrip("0") if rest else "") + "S"

"""ISO-8601 durations and admission times."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import spark_datetime_pattern

# PnW or PnDTnHnMnS. Years and months have no fixed length and are refused.
_ISO = r"^([+-]?)P(?:(\d+(?:\.\d+)?)W)?(?:(\d+(?:\.\d+)?)D)?(?:T(?:(\d+(?:\.\d+)?)H)?(?:(\d+(?:\.\d+)?)M)?(?:(\d+(?:\.\d+)?)S)?)?$"
_UNIT_SECONDS = ((2, 604800), (3, 86400), (4, 3600), (5, 60), (6, 1))
_MICROS = 1_000_000


def iso_duration_micros(text: Column) -> Column:
    """An ISO duration as microseconds; NULL where it is not one."""
    total = F.lit(0).cast("bigint")
    for group, seconds in _UNIT_SECONDS:
        amount = F.nullif(F.regexp_extract(text, _ISO, group), F.lit(""))
        micros = F.round(amount.cast("decimal(20,6)") * F.lit(seconds * _MICROS)).cast("bigint")
        total = total + F.coalesce(micros, F.lit(0).cast("bigint"))
    sign = F.when(F.regexp_extract(text, _ISO, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    valid = text.rlike(_ISO) & text.rlike(r"\d[WDHMS]$")
    return F.when(valid, sign * total)


def iso_duration(text: Column) -> Column:
    """An ISO duration as a day-time interval; NULL where it is not one."""
    return micros_to_interval(iso_duration_micros(text))


def micros_to_interval(micros: Column) -> Column:
    return F.make_dt_interval(secs=(micros.cast("decimal(24,6)") / F.lit(_MICROS)).cast("decimal(18,6)"))


def interval_micros(interval: Column) -> Column:
    epoch = F.timestamp_micros(F.lit(0))
    return F.unix_micros(epoch + interval)


def format_iso_duration(micros: Column) -> Column:
    """Microseconds as ``PnDTnHnMnS``, leaving out zero parts; zero is ``P0D``."""
    size = F.abs(micros)
    seconds = F.floor(size / _MICROS).cast("bigint")
    fraction = F.pmod(size, F.lit(_MICROS))
    days = F.floor(seconds / 86400).cast("bigint")
    hours = F.floor(F.pmod(seconds, F.lit(86400)) / 3600).cast("bigint")
    minutes = F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("bigint")
    rest = F.pmod(seconds, F.lit(60))

    def part(value: Column, unit: str) -> Column:
        return F.when(value > 0, F.concat(value.cast("string"), F.lit(unit))).otherwise(F.lit(""))

    tail = F.when(
        (rest > 0) | (fraction > 0),
        F.concat(
            rest.cast("string"),
            F.when(fraction > 0, F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))).otherwise(F.lit("")),
            F.lit("S"),
        ),
    ).otherwise(F.lit(""))
    clock = F.concat(part(hours, "H"), part(minutes, "M"), tail)
    return (
        F.when(micros == 0, F.lit("P0D"))
        .otherwise(
            F.concat(
                F.when(micros < 0, F.lit("-")).otherwise(F.lit("")),
                F.lit("P"),
                part(days, "D"),
                F.when(clock != "", F.concat(F.lit("T"), clock)).otherwise(F.lit("")),
            )
        )
    )


def window_or_default(micros: Column, default: timedelta) -> Column:
    """A rule's window in microseconds; a missing or zero one gives the default."""
    return F.coalesce(F.nullif(micros, F.lit(0).cast("bigint")), F.lit(to_micros(default)).cast("bigint"))


def to_micros(value: timedelta) -> int:
    return value // timedelta(microseconds=1)


def schedule_times(
    now: Column, force: Column, double_tap: Column, cooldown: Column, delay: Column, ttl: Column
) -> dict[str, Column]:
    """When an accepted task runs, cools down and expires (windows in microseconds)."""
    start = F.unix_micros(now)
    scheduled = F.when(F.coalesce(force, F.lit(False)), start).otherwise(start + delay)
    until = F.greatest(start + double_tap + cooldown, scheduled)
    return {
        "scheduled_at": F.timestamp_micros(scheduled),
        "cooldown_until": F.timestamp_micros(until),
        "expire_at": F.timestamp_micros(until + ttl),
    }


def date_to_micros(text: Column, strptime_format: str = "%Y%m%d") -> Column:
    """A UTC date text as microseconds since the epoch."""
    return F.unix_micros(F.to_timestamp(text, spark_datetime_pattern(strptime_format)))


def epoch_seconds(moment: Column) -> Column:
    return F.unix_timestamp(moment)

"""Value functions: coordinates as text, rounding, hash buckets, fallbacks and colours."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn import fixed


def dms(c: Column, is_longitude: bool) -> Column:
    """Decimal degrees as degrees, minutes, seconds and hemisphere; NULL stays NULL."""
    units = F.bround(F.abs(c) * 10_000_000).cast("bigint")
    minutes = (units % 10_000_000) * 60
    positive, negative = ("E", "W") if is_longitude else ("N", "S")
    text = F.format_string(
        "%d° %02d′ %08.5f″ %s",
        F.floor(units / 10_000_000).cast("bigint"),
        F.floor(minutes / 10_000_000).cast("bigint"),
        (minutes % 10_000_000) * 60 / F.lit(10_000_000.0),
        F.when(c < 0, negative).otherwise(positive),
    )
    return F.when(c.isNotNull(), text)


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def percent(c: Column) -> Column:
    """A fraction as percent with two digits."""
    return F.bround(c * 100, 2)


def hash_bucket(keys: list[Column], buckets: int) -> Column:
    """Stable bucket 1..n: SHA-256 of the keys joined by '-', as one integer, modulo n.

    The 256-bit digest is folded eight hex digits at a time, so nothing overflows.
    """
    digest = F.sha2(F.concat_ws("-", *[k.cast("string") for k in keys]), 256)
    words = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(8)]
    step = 2 ** 32 % buckets
    return (reduce(lambda acc, w: (acc * step + w % buckets) % buckets, words,
                   F.lit(0).cast("bigint")) + 1).cast("int")


def first_source(sources: list[tuple[Column, dict[str, Column]]]) -> Column:
    """The first source that is present, all its fields together.

    Each entry is ``(present, fields)``; fields of one source are never mixed with another's.
    """
    return F.coalesce(*[
        F.when(present, F.struct(*[c.alias(name) for name, c in fields.items()]))
        for present, fields in sources])


def ramp_colour(value: Column, lower: Column, upper: Column,
                low: tuple = fixed.RAMP_LOW, high: tuple = fixed.RAMP_HIGH,
                invalid: str = fixed.RAMP_INVALID, valid_max: float | None = 100.0) -> Column:
    """HSL colour of a value placed between ``lower`` and ``upper``.

    Values outside ``0..valid_max``, NaN, NULL and an empty range give the invalid colour.
    """
    span = upper - lower
    share = F.when(span > 0, F.least(F.greatest(value - lower, F.lit(0.0)), span) / span)

    def mix(a: int, b: int) -> Column:
        # Round half up, as a browser does.
        return F.floor((1 - share) * a + share * b + F.lit(0.5)).cast("int")

    colour = F.format_string("hsl(%d %d%% %d%%)", *[mix(a, b) for a, b in zip(low, high)])
    usable = (value >= 0) & ~F.isnan(value) & share.isNotNull()
    if valid_max is not None:
        usable = usable & (value <= valid_max)
    return F.when(usable, colour).otherwise(invalid)

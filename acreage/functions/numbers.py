"""Numeric scalar functions: text parsing, guarded division, target transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms that count as a number once blanks and the percent sign are gone.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_number(text: Column) -> Column:
    """Read '0,49', '60%', ' 0.25 ' as doubles; a percent sign divides by 100; anything else is NULL."""
    compact = F.replace(F.trim(text), F.lit(" "), F.lit(""))
    digits = F.replace(F.replace(compact, F.lit("%"), F.lit("")), F.lit(","), F.lit("."))
    value = F.when(digits.rlike(NUMBER_PATTERN), digits.try_cast("double"))
    return F.when(F.contains(compact, F.lit("%")), value / 100.0).otherwise(value)


def finite(value: Column) -> Column:
    """True for a number that is neither NULL, NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def nan_to_zero(value: Column) -> Column:
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def safe_divide(a: Column, b: Column, fill: float = 0.0, floor: float = 1e-10) -> Column:
    """a / b, or ``fill`` where |b| <= floor or either side is not finite."""
    usable = finite(a) & finite(b) & (F.abs(b) > floor)
    return F.when(usable, F.try_divide(a, b)).otherwise(F.lit(fill))


def clip(value: Column, low: float, high: float) -> Column:
    """Limit a number to [low, high]; NULL and NaN stay what they are."""
    return F.when(value < low, F.lit(low)).when((value > high) & ~F.isnan(value), F.lit(high)).otherwise(value)


def log_target(value: Column, epsilon: float = 1.0) -> Column:
    return F.log(value + F.lit(epsilon))


def unlog_target(value: Column, epsilon: float = 1.0) -> Column:
    """Back to the original scale, never below zero."""
    restored = F.exp(value) - F.lit(epsilon)
    return F.when(restored < 0, F.lit(0.0)).otherwise(restored)


def log10_floor1(value: Column) -> Column:
    """log10 with every value below one counted as one."""
    return F.log10(F.when(value < 1, F.lit(1.0)).otherwise(value))


def date_stamp(day: Column) -> Column:
    """Six-digit yymmdd text used as a suffix of dated outputs."""
    return F.date_format(day, "yyMMdd")


MODULUS = 2147483647
# Multipliers of the three rounds of ``order_hash``.
ROUNDS = (48271, 1103515245, 69621)


def seed_parts(seed: int) -> tuple[int, int]:
    """Two far-apart offsets below the modulus for a seed; neighbouring seeds share no pattern."""
    spread = (seed * 0x9E3779B97F4A7C15 + 0xD1B54A32D192ED03) % (1 << 64)
    spread = ((spread ^ (spread >> 29)) * 0xBF58476D1CE4E5B9) % (1 << 64)
    return (spread >> 33) % MODULUS, (spread & 0x7FFFFFFF) % MODULUS


def order_hash(key: Column, seed: int = 0) -> Column:
    """Repeatable pseudo-random order key in [0, 2^31 - 1) of an integer key.

    Modular multiplications alone keep the order of small keys; the xor-shifts
    between them mix high bits into low ones, and the seed enters twice.
    """
    first, second = seed_parts(seed)
    m = F.lit(MODULUS).cast("bigint")
    a = (F.pmod(F.pmod(key.cast("bigint"), m) + F.lit(first), m) * F.lit(ROUNDS[0])) % m
    a = a.bitwiseXOR(F.shiftright(a, 15))
    a = ((a + F.lit(second)) * F.lit(ROUNDS[1]).cast("bigint")) % m
    a = a.bitwiseXOR(F.shiftright(a, 13))
    a = (a * F.lit(ROUNDS[2])) % m
    return a.bitwiseXOR(F.shiftright(a, 16)) % m


def uniform_from(key: Column, seed: int = 0) -> Column:
    """Repeatable number in [0, 1) for an integer key; different seeds are independent draws."""
    return order_hash(key, seed) / F.lit(float(MODULUS))

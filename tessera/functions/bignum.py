"""Whole numbers of any size as arrays of base-10^9 digits (``limbs``, lowest first), in built-in functions.

Between multiplications limbs may stand a little above the base: every multiplication is followed by
two rounds of carrying, each of which moves what a limb has too much to its neighbour, all limbs at
once. So limbs stay below 10^9 + 2, a product of two of them fits 64 bits, and no step walks
the number limb by limb. ``carried`` makes the digits proper once, before they are divided or shown.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE = 10**9
LIMBS = "array<bigint>"
WIDE = "decimal(38,0)"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def one() -> Column:
    return F.array(F.lit(1).cast("bigint"))


def _div(x: Column, y: Column) -> Column:
    """Whole quotient of two non-negative bigints."""
    return F.call_function("div", x, y)


def _carry_round(limbs: Column) -> Column:
    zero = F.array(F.lit(0).cast("bigint"))
    big = F.lit(BASE).cast("bigint")
    return let(limbs, lambda p: F.zip_with(F.concat(F.transform(p, lambda x: x % big), zero),
                                           F.concat(zero, F.transform(p, lambda x: _div(x, big))), lambda a, b: a + b))


def times_small(limbs: Column, m: Column) -> Column:
    """``limbs`` times ``m``, 0 <= m < 10^9."""
    return _carry_round(_carry_round(F.transform(limbs, lambda x: x * m)))


def trimmed(limbs: Column) -> Column:
    """Limbs without zeros at the top (at least one limb)."""
    def cut(a: Column) -> Column:
        top = F.array_max(F.transform(a, lambda x, i: F.when(x > 0, i + 1)))  # null: all are zeros
        return F.slice(a, F.lit(1), F.coalesce(top, F.lit(1)))

    return let(limbs, cut)


def plus(a: Column, b: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.zip_with(a, b, lambda x, y: F.coalesce(x, zero) + F.coalesce(y, zero))


def times(a: Column, b: Column) -> Column:
    """Product of two numbers, one row of ``b``'s limbs at a time."""
    zero = F.array(F.lit(0).cast("bigint"))
    start = F.struct(F.array(F.lit(0).cast("bigint")).alias("sum"), a.alias("shifted"))

    def step(acc: Column, limb: Column) -> Column:
        return F.struct(_carry_round(plus(acc["sum"], times_small(acc["shifted"], limb))).alias("sum"),
                        F.concat(zero, acc["shifted"]).alias("shifted"))

    return F.aggregate(b, start, step, lambda acc: acc["sum"])


def carried(limbs: Column) -> Column:
    """Every limb below the base, none at the top zero (but for zero itself)."""
    big = F.lit(BASE).cast("bigint")
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast(LIMBS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        return let(acc["carry"] + x, lambda s: F.struct(_div(s, big).alias("carry"), F.concat(acc["out"], F.array(s % big)).alias("out")))

    return trimmed(F.aggregate(limbs, start, step, lambda acc: F.concat(acc["out"], F.array(acc["carry"]))))


def from_decimal(x: Column) -> Column:
    """Limbs of a non-negative ``decimal(38,0)``."""
    text = F.lpad(x.cast("string"), 45, "0")
    return F.transform(F.sequence(F.lit(4), F.lit(0), F.lit(-1)), lambda i: F.substr(text, i * 9 + 1, F.lit(9)).cast("bigint"))


def divided(limbs: Column, m: Column) -> Column:
    """Whole quotient of proper limbs and ``m``, 0 < m < 10^9, from the top limb down."""
    big = F.lit(BASE).cast("bigint")
    start = F.struct(F.lit(0).cast("bigint").alias("rest"), F.array().cast(LIMBS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        return let(acc["rest"] * big + x, lambda s: F.struct((s % m).alias("rest"), F.concat(acc["out"], F.array(_div(s, m))).alias("out")))

    return trimmed(F.reverse(F.aggregate(F.reverse(limbs), start, step, lambda acc: acc["out"])))


def as_text(limbs: Column) -> Column:
    """Decimal text of proper limbs."""
    return F.array_join(F.transform(F.reverse(limbs), lambda x, i: F.when(i == 0, x.cast("string")).otherwise(
        F.lpad(x.cast("string"), 9, "0"))), "")


def power_product(factors: Column) -> Column:
    """Product of ``b ** e`` over ``array<struct<b decimal(38,0), e bigint>>``, b > 1, e >= 0, as proper limbs.

    Powers of a small base are packed: as many factors as stay below 10^9 are one multiplication."""
    small = F.filter(factors, lambda x: (x["b"] < BASE) & (x["e"] > 0))
    wide = F.filter(factors, lambda x: (x["b"] >= BASE) & (x["e"] > 0))
    fits = lambda b: F.greatest(F.lit(1), F.floor(F.lit(8.99) / F.log10(b.cast("double"))).cast("int"))
    power = lambda b, k: F.aggregate(F.array_repeat(b, k), F.lit(1).cast("bigint"), lambda a, x: a * x)

    def packed(x: Column) -> Column:
        return let(F.struct(x["b"].cast("bigint").alias("b"), fits(x["b"]).alias("k"), x["e"].alias("e")), lambda s: F.concat(
            F.array_repeat(power(s["b"], s["k"]), _div(s["e"], s["k"].cast("bigint")).cast("int")),
            F.array(power(s["b"], (s["e"] % s["k"]).cast("int")))))

    multipliers = F.flatten(F.transform(small, packed))
    product = F.aggregate(multipliers, one(), lambda acc, m: trimmed(times_small(acc, m)))
    wides = F.flatten(F.transform(wide, lambda x: F.array_repeat(from_decimal(x["b"]), x["e"].cast("int"))))
    return carried(F.aggregate(wides, product, lambda acc, b: trimmed(times(acc, b))))

"""Exact means and two-decimal results (A2, F5, hazard H3).

``AVG(x)`` and ``AVG(x)::NUMERIC(8,2)`` don't depend on the order of summation here: the values
are summed as integers. Each value goes, as it is, to one of three sums:

* *coarse*: doubles with at most four decimals, times 10^4, as a long (fast, the usual case);
* *fine*: doubles with at most twelve decimals, times 10^12, as ``decimal(38,0)``;
* *odd*: anything else (more decimals, very large, infinite or NaN), as a double.

Nothing is rounded before it is summed. With odd values the mean is a double sum like any
other engine's, and a NaN makes it NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE_DIGITS = 4
SCALE = 10 ** SCALE_DIGITS
FINE = 10 ** 12
LARGEST = 1e11  # beyond, a double has fewer than four decimals to keep
INTEGER = "decimal(38,0)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scaled_int(c) -> Column:
    """``c * 10^4`` as a long if that is the value of the double, else null."""
    x = _c(c).cast("double")
    k = F.when(F.abs(x) < LARGEST, F.round(x * F.lit(float(SCALE))).cast("long"))
    return F.when(k / F.lit(float(SCALE)) == x, k)


def _fine_int(c) -> Column:
    """``c * 10^12`` as an integer for values with five to twelve decimals, else null."""
    x = _c(c).cast("double")
    d = F.when(F.abs(x) < LARGEST, x).cast("decimal(25,12)")
    return F.when(scaled_int(x).isNull() & (d.cast("double") == x), (d * F.lit(FINE).cast("decimal(13,0)")).cast(INTEGER))


def exact_sums(c, name: str) -> list[Column]:
    """Aggregates of ``c``: the three sums and the count, as columns ``<name>_c``, ``_f``, ``_o``, ``_n``."""
    x = _c(c)
    coarse, fine = scaled_int(x), _fine_int(x)
    odd = F.when(coarse.isNull() & fine.isNull(), x.cast("double"))
    return [F.sum(coarse).alias(f"{name}_c"), F.sum(fine).alias(f"{name}_f"), F.sum(odd).alias(f"{name}_o"), F.count(x).alias(f"{name}_n")]


def weighted_sums(name: str, weight, to: str) -> list[Column]:
    """Aggregates over rows that each stand for ``weight`` times their own exact sums."""
    w = _c(weight)
    out = [F.sum(F.col(f"{name}_{k}").cast(INTEGER) * w).alias(f"{to}_{k}") for k in "cf"]
    return [*out, F.sum(F.col(f"{name}_o") * w).alias(f"{to}_o"), F.sum(F.col(f"{name}_n") * w).alias(f"{to}_n")]


def _named(name: str) -> tuple[Column, ...]:
    return tuple(F.col(f"{name}_{k}") for k in "cfon")


def _total(sums: tuple[Column, ...]) -> Column:
    """The exact sum times 10^12 (without odd values)."""
    coarse, fine, _, _ = sums
    zero = F.lit(0).cast(INTEGER)
    coarse = (F.coalesce(coarse.cast(INTEGER), zero) * F.lit(FINE // SCALE).cast("decimal(9,0)")).cast(INTEGER)
    return (coarse + F.coalesce(fine, zero)).cast(INTEGER)


def _double_mean(sums: tuple[Column, ...]) -> Column:
    return (_total(sums).cast("double") / F.lit(float(FINE)) + sums[2]) / sums[3]


def exact_mean(name: str) -> Column:
    """The mean from ``exact_sums``: one division of two exact numbers where there are no odd values."""
    sums = _named(name)
    coarse, fine, odd, n = sums
    total, six = _total(sums), F.lit(10 ** 6).cast(INTEGER)
    # as few digits as the sum needs, so that dividend and divisor are exact doubles
    exact = (F.when(fine.isNull(), coarse.cast("double") / (n.cast("double") * F.lit(float(SCALE))))
             .when(F.pmod(total, six) == 0, int_div_signed(total, six).cast("double") / (n.cast("double") * F.lit(1e6)))
             .otherwise(total.cast("double") / (n.cast("double") * F.lit(float(FINE)))))
    return F.when(n > 0, F.when(odd.isNull(), exact).otherwise(_double_mean(sums)))


def int_div(a, b) -> Column:
    """Floor division of integral non-negative columns, exact (no double or decimal rounding)."""
    a = _c(a).cast(INTEGER)
    b = _c(b).cast(INTEGER)
    return ((a - F.pmod(a, b)) / b).cast(INTEGER)


def int_div_signed(a: Column, b: Column) -> Column:
    """Division of integral columns without a remainder, exact."""
    return int_div(F.abs(a), b) * F.signum(a).cast("decimal(1,0)")


def half_up_2dp(total, count, scale: int = SCALE) -> Column:
    """``round_half_away(total / (scale * count), 2)`` as ``decimal(8,2)``; null when count is 0.

    ``total`` and ``count`` are integral; the arithmetic runs in ``decimal(38,0)``.
    """
    s = _c(total).cast(INTEGER)
    n = _c(count).cast(INTEGER)
    unit = F.lit(scale // 100).cast("decimal(12,0)")
    hundredths = int_div(F.abs(s) * 2 + n * unit, n * (unit * 2)) * F.signum(s).cast("decimal(1,0)")
    return F.when(n > 0, (hundredths.cast("decimal(20,0)") / F.lit(100)).cast("decimal(8,2)"))


def _mean_2dp(sums: tuple[Column, ...]) -> Column:
    mean = _double_mean(sums)
    usable = F.when(~F.isnan(mean) & (F.abs(mean) < F.lit(1e6)), mean).cast("decimal(8,2)")
    return F.when(sums[2].isNull(), half_up_2dp(_total(sums), sums[3], FINE)).otherwise(usable)


def exact_mean_2dp(name: str) -> Column:
    """``AVG(c)::NUMERIC(8,2)`` from ``exact_sums``; a mean that is no number of that size is null."""
    return _mean_2dp(_named(name))


def mean_2dp(c) -> Column:
    """Aggregate: ``AVG(c)::NUMERIC(8,2)``."""
    return _mean_2dp(tuple(exact_sums(c, "_")))


def all_coarse(c) -> Column:
    """Aggregate: whether every value has at most four decimals."""
    x = _c(c)
    return F.count(F.when(x.isNotNull() & scaled_int(x).isNull(), 1)) == 0


def quantile_2dp(c, p: float) -> Column:
    """Aggregate: ``percentile_cont(p) WITHIN GROUP (ORDER BY c)::NUMERIC(8,2)``."""
    return quantiles_2dp(c, (p,))[0]


def quantiles_2dp(c, ps) -> list[Column]:
    """Several quantiles from one aggregate (one count map per group instead of one per quantile).

    Values with at most four decimals interpolate on integers, where ``a + f * (b - a)`` with ``f`` a
    multiple of 1/4 is exact in a double; others interpolate on the doubles themselves.
    """
    x = _c(c)
    at = F.array(*[F.lit(p) for p in ps])
    whole, plain = F.percentile(scaled_int(x), at), F.percentile(x, at)
    out = []
    for i in range(len(ps)):
        q, d = F.element_at(whole, i + 1), F.element_at(plain, i + 1)
        hundredths = F.signum(q) * F.floor(F.abs(q) / F.lit(SCALE / 100) + F.lit(0.5))
        out.append(F.when(all_coarse(x), (hundredths.cast("decimal(20,0)") / F.lit(100)).cast("decimal(8,2)")).otherwise(
            F.when(~F.isnan(d), d).cast("decimal(8,2)")))
    return out


def cast_2dp(c) -> Column:
    """``c::NUMERIC(8,2)`` (half away from zero; overflow raises under ANSI)."""
    return _c(c).cast("decimal(8,2)")


# ------------------------------------------------------------- sums of any doubles
# A double below 2^31 is split without rounding into a whole part and three parts of 30 binary places each (what lies
# below 2^-90 is dropped); each part's sum is a long. Such sums can be subtracted and multiplied
# exactly. Larger numbers, NaN and the infinities are summed or counted apart.
BINARY_PARTS = ("p", "f", "g", "h", "o", "on", "nan", "inf", "ninf", "n")
_PLACE = float(1 << 30)


def binary_sums(c, name: str) -> list[Column]:
    """Aggregates of ``c``: ``<name>_<part>`` for each of ``BINARY_PARTS``; ``n`` counts the values that aren't null."""
    x = _c(c).cast("double")
    infinite = F.abs(x) == F.lit(float("inf"))
    plain = F.abs(x) < F.lit(float(1 << 31))
    value = F.when(plain, x)
    parts, rest = [], value
    for _ in range(4):
        whole = F.floor(rest)
        parts.append(whole)
        rest = (rest - whole) * F.lit(_PLACE)
    large = F.when(~plain & ~infinite & ~F.isnan(x), x)
    sums = [*[F.sum(p) for p in parts], F.sum(large), F.count(large), F.count(F.when(F.isnan(x), 1)), F.count(F.when(x == float("inf"), 1)),
            F.count(F.when(x == float("-inf"), 1)), F.count(x)]
    return [s.alias(f"{name}_{part}") for part, s in zip(BINARY_PARTS, sums, strict=True)]


def binary_totals(name: str) -> list[Column]:
    """Aggregates that add up ``binary_sums`` of smaller groups."""
    return [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in BINARY_PARTS]


def binary_rest(total: str, weight, inside: str, to: str) -> list[Column]:
    """``weight`` times the sums ``total`` less the sums ``inside`` (null: none), as sums ``to``."""
    w = _c(weight)
    out = [(F.coalesce(F.col(f"{total}_{k}"), F.lit(0)) * w - F.coalesce(F.col(f"{inside}_{k}"), F.lit(0))).alias(f"{to}_{k}") for k in BINARY_PARTS]
    return out


def binary_mean(name: str) -> Column:
    """The mean from ``binary_sums``: NaN if a value is or if both infinities occur, an infinity if one does."""
    p, f, g, h, o, on, nan, inf, ninf, n = (F.col(f"{name}_{part}") for part in BINARY_PARTS)

    def carried(low: Column, high: Column) -> tuple[Column, Column]:
        low = F.coalesce(low, F.lit(0)).cast("long")
        return low.bitwiseAND(F.lit((1 << 30) - 1).cast("long")).cast("double"), F.coalesce(high, F.lit(0)).cast("long") + F.shiftright(low, 30)

    h, g = carried(h, g)
    g, f = carried(g, f)
    f, p = carried(f, p)
    total = p.cast("double") + (f + (g + h / _PLACE) / _PLACE) / _PLACE
    total = F.when(on > 0, total + o).otherwise(total)
    return (F.when(n <= 0, F.lit(None).cast("double")).when((nan > 0) | ((inf > 0) & (ninf > 0)), F.lit(float("nan")))
            .when(inf > 0, F.lit(float("inf"))).when(ninf > 0, F.lit(float("-inf"))).otherwise(total / n))

"""Number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let


def _exact_round2(x: Column) -> Column:
    """Round a positive double below 2^46; exact also next to a tie.

    Scaling by a power of two is exact for doubles, which turns the tie test
    into integer arithmetic.
    """
    shift = F.lit(53) - F.floor(F.log2(x)).cast("int")
    scaled = (x * F.pow(F.lit(2.0), shift)).cast("bigint").cast("decimal(20,0)") * F.lit(100)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift).cast("decimal(20,0)")
    whole = F.floor(x * 100)
    # ``whole`` may be one off next to an integer; ``rest``, twice the exact
    # distance from it, puts it right.
    rest = (scaled - whole.cast("decimal(17,0)") * one) * 2
    odd = (whole % 2).cast("int")
    hundredths = whole + (
        F.when(rest > one, F.lit(1))
        .when(rest == one, odd)
        .when(rest < -one, F.lit(-1))
        .when(rest == -one, -odd)
        .otherwise(F.lit(0))
    )
    return hundredths / F.lit(100.0)


def python_round2(col: Column) -> Column:
    """Round a double to two digits, half to even on its exact binary value.

    ``bround`` works on the printed decimal, so 0.015 (stored slightly below)
    would go to 0.02.
    """

    def rounded(x: Column) -> Column:
        def by_distance(y: Column) -> Column:
            clear = (F.abs(y - F.floor(y) - 0.5) > F.lit(1e-6)) & (y < F.lit(4e9))
            return (
                F.when(x < F.lit(2.0 ** -8), F.lit(0.0))
                # Doubles from here on are more than a hundredth apart, so each is nearest to its own rounding.
                .when(x >= F.lit(2.0 ** 46), x)
                .when(clear, F.floor(y + 0.5) / F.lit(100.0))
                .otherwise(_exact_round2(x))
            )

        return let(x * 100, by_distance)

    return let(col, lambda v: F.signum(v) * let(F.abs(v), rounded))

"""Ordered per-key features (running sums, LAG, cumulative counts) that survive a hot key.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one task. Here the
order is cut by digits of the order value itself, from coarse to fine: functions of the
row such as its hour, its id divided by a million, or an amount divided by ten thousand,
that never decrease along the order. A segment is a key with its digits, so it is the
same in every evaluation: no sampled bounds, no stored copy of the rows, no job before the
query runs. Features are computed inside a segment, and each level of digits adds what
lies before it: totals and last rows of the segments before, from an aggregated table of
one row per segment.

Digits bound every window by construction: a segment has at most the order values between
two digits, and a level at most the digits within one digit above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ids, and cents, that share a digit.
ID_WIDTH = 1 << 20
#: Widths of the digits of an amount NUMERIC(18,2): at most a million segments a level
#: and a million amounts a segment.
AMOUNT_WIDTHS = (10_000_000_000, 10_000)


def id_digit(ident: str, width: int = ID_WIDTH) -> Column:
    """Ids are dense (BIGSERIAL), so a digit has at most ``width`` of them."""
    return F.expr(f"({ident} - pmod({ident}, {width}L)) div {width}L")


def amount_digits(amount: str) -> list[Column]:
    return [F.floor(F.col(amount) / F.lit(w)) for w in AMOUNT_WIDTHS]


def score_digits(score: str) -> list[Column]:
    """Digits of a double: its sign, exponent and ten bits more, then twenty bits more, so
    that at most the last 23 bits differ in a segment. Powers of two divide exactly, and
    the logarithm never decreases, so equal exponents need not be exact ones."""
    s = F.col(score).cast("double")
    size = F.abs(s)
    exponent = F.when(size > 0, F.greatest(F.floor(F.log2(size)), F.lit(-1000))).otherwise(F.lit(-1001)).cast("long")
    scale = F.pow(F.lit(2.0), exponent.cast("double"))
    part = F.when(size > 0, size / scale).otherwise(F.lit(0.0))
    sign = F.when(s < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
    first = ((exponent + 1002) * 4096 + F.floor(part * 1024)) * sign
    fine = part * 1024
    second = F.floor((fine - F.floor(fine)) * (1 << 20)) * sign
    return [first, second]


def prefix_scan(df: DataFrame, keys: list[str], digits: list[Column], order: list[str],
                sums: dict[str, str] | None = None, lags: dict[str, str] | None = None,
                group_count: str | None = None, descending: bool = False) -> DataFrame:
    """``df`` with running sums (``sums`` = {value: output}) and previous values (``lags``)
    per ``keys`` along ``order``, which must be unique per key; ``group_count`` counts the
    rows of a key with the same first digit. ``digits`` never decrease along ``order``,
    coarse ones first; with ``descending`` the scan runs from the largest down."""
    sums, lags = sums or {}, lags or {}
    names = [f"_digit{i}" for i in range(len(digits))]
    tagged = df.select("*", *[F.coalesce(d.cast("long"), F.lit(-(1 << 62))).alias(n) for d, n in zip(digits, names)])

    def along(cols):
        return [F.desc(c) if descending else F.asc(c) for c in cols]

    def last(value, cols):
        place = F.struct(*cols)
        return F.min_by(value, place) if descending else F.max_by(value, place)

    own = Window.partitionBy(*keys, *names).orderBy(*along(order))
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.select("*", *[F.sum(v).over(upto).alias(f"_here_{v}") for v in sums],
                          *[F.lag(F.struct(v)).over(own).alias(f"_prev_{v}") for v in lags])

    levels = [tagged.groupBy(*keys, *names).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(v).alias(f"_sum_{v}") for v in sums],
        *[last(F.struct(v), order).alias(f"_last_{v}") for v in lags])]
    for depth in range(len(names) - 1, 0, -1):
        levels.insert(0, levels[0].groupBy(*keys, *names[:depth]).agg(
            F.sum("_rows").alias("_rows"), *[F.sum(f"_sum_{v}").alias(f"_sum_{v}") for v in sums],
            *[last(F.col(f"_last_{v}"), [names[depth]]).alias(f"_last_{v}") for v in lags]))

    offsets = None
    for depth, level in enumerate(levels):
        at = Window.partitionBy(*keys, *names[:depth]).orderBy(*along([names[depth]]))
        before = at.rowsBetween(Window.unboundedPreceding, -1)
        step = level.select(*keys, *names[:depth + 1], "_rows",
                            *[F.sum(f"_sum_{v}").over(before).alias(f"_add_{v}") for v in sums],
                            *[F.lag(f"_last_{v}").over(at).alias(f"_back_{v}") for v in lags])
        if offsets is None:
            offsets = step.withColumnRenamed("_rows", "_group")
        else:
            above = offsets.select(*keys, *names[:depth], "_group", *[F.col(f"_add_{v}").alias(f"_up_{v}") for v in sums],
                                   *[F.col(f"_back_{v}").alias(f"_over_{v}") for v in lags])
            offsets = step.join(above, [*keys, *names[:depth]]).select(
                *keys, *names[:depth + 1], "_group",
                *[_plus(f"_add_{v}", f"_up_{v}").alias(f"_add_{v}") for v in sums],
                *[F.coalesce(f"_back_{v}", f"_over_{v}").alias(f"_back_{v}") for v in lags])
    out = local.join(offsets, [*keys, *names])
    added = [_plus(f"_add_{v}", f"_here_{v}").alias(name) for v, name in sums.items()]
    added += [F.coalesce(f"_prev_{v}", f"_back_{v}")[v].alias(name) for v, name in lags.items()]
    if group_count:
        added.append(F.col("_group").alias(group_count))
    return out.select(*df.columns, *added)


def _plus(a: str, b: str) -> Column:
    """Sum of two sums of which either may be over no rows."""
    return F.coalesce(F.col(a) + F.col(b), F.col(a), F.col(b))

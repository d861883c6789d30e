"""Exact, reproducible sampling: the k rows with the smallest portable hash.

``ORDER BY RANDOM() LIMIT k`` becomes "k smallest by hash(key, seed)". A
global top-k would merge k rows from every partition in one task, which
breaks for large k (k = 500,000 over thousands of partitions). Instead the
cutoff hash is found by radix selection: two aggregate passes over a
16-bit and a 15-bit digit, each producing at most 65,536 counts per group
(a bound fixed by construction, safe to bring to the driver). The sample is
then a plain filter ``hash < cutoff`` plus the few rows equal to the cutoff.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_P = 2147483647  # 2^31 - 1
_A = 48271       # MINSTD multiplier


def portable_hash(key, seed: int = 42) -> Column:
    """A pseudo-random order key in [0, 2^31 - 1) that any SQL engine can
    compute with 64-bit integer arithmetic (two MINSTD rounds)."""
    k = F.col(key) if isinstance(key, str) else key
    h = ((k.cast("long") % _P) * _A + seed) % _P
    return (h * _A + seed) % _P


def portable_hash_sql(key: str, seed: int = 42) -> str:
    """The same key in SQL text (for the DuckDB oracle)."""
    h = f"((({key} % {_P}) * {_A} + {seed}) % {_P})"
    return f"(({h} * {_A} + {seed}) % {_P})"


def smallest_k(df: DataFrame, k_by_group: dict, key: str, seed: int = 42,
               group: str | None = None) -> DataFrame:
    """Rows of ``df`` with the ``k_by_group[g]`` smallest (hash, key) per
    group ``g`` (one group ``None`` when ``group`` is None). Exact."""
    hashed, cond = smallest_k_condition(df, k_by_group, key, seed, group)
    return hashed.where(cond).drop("_h", "_g")


def smallest_k_condition(df: DataFrame, k_by_group: dict, key: str, seed: int = 42,
                         group: str | None = None):
    """(df with helper columns ``_h``/``_g``, predicate selecting the rows
    of :func:`smallest_k`), for callers that label rather than filter."""
    gcol = F.col(group) if group else F.lit(None).cast("string")
    hashed = df.withColumn("_h", portable_hash(key, seed)).withColumn("_g", gcol)
    hi = F.shiftright("_h", 15)
    lo = F.col("_h").bitwiseAND(F.lit((1 << 15) - 1))

    # pass 1: counts per (group, high digit)
    counts1 = {}
    for r in hashed.groupBy("_g", hi.alias("_d")).agg(F.count(F.lit(1)).alias("_n")).collect():
        counts1.setdefault(r["_g"], []).append((r["_d"], r["_n"]))
    cut_hi, below = {}, {}
    for g, k in k_by_group.items():
        acc = 0
        for d, n in sorted(counts1.get(g, [])):
            if acc + n >= k:
                cut_hi[g], below[g] = d, acc
                break
            acc += n
    take_all = [g for g in k_by_group if g not in cut_hi]  # k >= group size
    conds = [F.col("_g").eqNullSafe(F.lit(g)) for g in take_all]

    # pass 2: counts per (group, low digit) inside the cutoff bucket
    for g, d in cut_hi.items():
        sub = hashed.where(F.col("_g").eqNullSafe(F.lit(g)) & (hi == d))
        rows = sorted((r["_d"], r["_n"]) for r in
                      sub.groupBy(lo.alias("_d")).agg(F.count(F.lit(1)).alias("_n")).collect())
        need, acc = k_by_group[g] - below[g], 0
        for dl, n in rows:
            if acc + n >= need:
                cut = (d << 15) | dl
                rest = need - acc  # rows equal to the cutoff hash to keep
                eq = [r[0] for r in sub.where(F.col("_h") == cut).select(key)
                      .orderBy(key).limit(rest).collect()]
                conds.append(F.col("_g").eqNullSafe(F.lit(g)) & (
                    (F.col("_h") < cut) | ((F.col("_h") == cut) & F.col(key).isin(eq))))
                break
            acc += n
    if not conds:
        return hashed, F.lit(False)
    cond = conds[0]
    for c in conds[1:]:
        cond = cond | c
    return hashed, cond


def stratum_sizes(df: DataFrame, group: str) -> dict:
    """Row count per group value (one row per group to the driver)."""
    return {r[0]: r[1] for r in df.groupBy(group).count().collect()}


def ceil_fraction(n: int, fraction: float) -> int:
    return int(math.ceil(n * fraction - 1e-9))

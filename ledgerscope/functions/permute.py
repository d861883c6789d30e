"""Keyed permutations of dense row numbers, as column arithmetic.

A Feistel network on pairs (l, r) of 0..a-1 and 0..b-1, with a * b just above n, is a
bijection whatever its round functions are; numbers that land beyond n go through it
again, so 0..n-1 is permuted within itself. At most a * b - n numbers (fewer than the
square root of n) lie beyond, which bounds the repetitions; any SQL engine with 64-bit
integers computes the same. So a shuffled column needs no shuffle of its own, no buckets
and no sort: each row tells where its value goes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Modulus and multiplier of the round functions (a prime below 2^31).
P, A = 2147483647, 48271
ROUNDS = 4
#: Repetitions: beyond a few, the chance of a number still beyond n is below 1e-18 from n = 16 on,
#: and for smaller n there are fewer numbers beyond it than repetitions.
WALKS = 16


def sides(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def round_keys(seed: int, which: int) -> list[int]:
    """Keys of the rounds of one permutation."""
    out, state = [], (seed * 1_000_003 + which * 7_919 + 1) % P
    for _ in range(ROUNDS):
        state = (state * A + 12_345) % P
        out.append(state)
    return out


def permuted(number: Column, n: int, keys: list[Column]) -> Column:
    """Where row ``number`` of 0..n-1 goes; ``keys`` as of :func:`round_keys`."""
    a, b = sides(n)

    def mixed(value, key, size):
        once = ((value + key) % P) * A % P
        return ((once + key) * A % P) % size

    def step(x):
        left, right = x % a, F.floor((x - x % a) / a).cast("long")
        for i, key in enumerate(keys):
            if i % 2 == 0:
                left = (left + mixed(right, key, a)) % a
            else:
                right = (right + mixed(left, key, b)) % b
        return left + right * a

    first = step(number.cast("long"))
    again = F.sequence(F.lit(1), F.lit(WALKS))
    # nearly every number is done at once; the walk, which Spark interprets, is for the few others
    return F.when(first < n, first).otherwise(
        F.aggregate(again, first, lambda x, _: F.when(x < n, x).otherwise(step(x))))

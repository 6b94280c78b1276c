"""Repeatable pseudo-random draws: a hash of (row id, seed, purpose), so partitioning cannot change them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


class Draws:
    """Random-looking columns for the rows named by ``key``."""

    def __init__(self, key: Column, seed: int):
        self.key = key
        self.seed = seed

    def bits(self, purpose: str) -> Column:
        return F.xxhash64(self.key, F.lit(self.seed), F.lit(purpose))

    def uniform(self, purpose: str) -> Column:
        """In [0, 1), with 53 random bits."""
        return F.shiftrightunsigned(self.bits(purpose), 11) / F.lit(float(1 << 53))

    def between(self, purpose: str, low: float, high: float) -> Column:
        return F.lit(low) + self.uniform(purpose) * F.lit(high - low)

    def whole(self, purpose: str, low: int, high: int) -> Column:
        """An integer from low to high, both included."""
        return (F.floor(self.uniform(purpose) * F.lit(high - low + 1)) + F.lit(low)).cast("int")

    def chance(self, purpose: str, probability: float) -> Column:
        return self.uniform(purpose) < F.lit(probability)

    def normal(self, purpose: str, mean: float | Column, deviation: float | Column) -> Column:
        """Box-Muller transform of two uniforms."""
        radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - self.uniform(purpose + ".radius")))
        angle = F.lit(2 * math.pi) * self.uniform(purpose + ".angle")
        as_column = lambda value: value if isinstance(value, Column) else F.lit(float(value))
        return as_column(mean) + as_column(deviation) * radius * F.cos(angle)

    def clipped(self, purpose: str, mean, deviation, low: float, high: float) -> Column:
        drawn = self.normal(purpose, mean, deviation)
        return F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), drawn))

    def choice(self, purpose: str, options: Sequence, weights: Sequence[float] | None = None) -> Column:
        """One of ``options``; equal weights unless given."""
        if weights is None:
            position = self.whole(purpose, 1, len(options))
            return F.element_at(F.array(*[F.lit(option) for option in options]), position)
        drawn = self.uniform(purpose)
        total = float(sum(weights))
        reached, picked = 0.0, None
        for option, weight in zip(options[:-1], weights[:-1]):
            reached += weight / total
            test = drawn < F.lit(reached)
            picked = F.when(test, F.lit(option)) if picked is None else picked.when(test, F.lit(option))
        return F.lit(options[-1]) if picked is None else picked.otherwise(F.lit(options[-1]))

    def subset(
        self, purpose: str, options: Sequence[str], size: Column, weights: Sequence[float] | None = None
    ) -> Column:
        """``size`` different options. Ordering by ``-ln(u)/weight`` is weighted sampling without replacement."""
        weights = weights or [1.0] * len(options)
        ranked = F.array_sort(
            F.array(
                *[
                    F.struct(
                        (-F.log(F.lit(1.0) - self.uniform(f"{purpose}.{option}")) / F.lit(float(weight))).alias("k"),
                        F.lit(option).alias("v"),
                    )
                    for option, weight in zip(options, weights)
                ]
            )
        )
        return F.transform(F.slice(ranked, F.lit(1), size), lambda item: item["v"])

    def token(self, purpose: str, length: int) -> Column:
        """Up to 32 upper-case hexadecimal characters."""
        text = F.lpad(F.hex(self.bits(purpose)), 16, "0")
        if length > 16:
            text = F.concat(text, F.lpad(F.hex(self.bits(purpose + ".more")), 16, "0"))
        return F.substring(text, 1, length)


def record_id(number: Column, seed: int, kind: str) -> Column:
    """A 26-character id. The first 16 characters are a one-to-one image of ``number``, so ids are unique."""
    first = F.lpad(F.hex(F.xxhash64(number)), 16, "0")
    second = F.lpad(F.hex(F.xxhash64(number, F.lit(seed), F.lit(kind))), 16, "0")
    return F.concat(first, F.substring(second, 1, 10))

"""Count, mean and sum of squared deviations that can be merged without cancellation."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keeps the z-score finite when all amounts of a frame are equal.
EPSILON = 1e-6


class Moments(NamedTuple):
    n: Column
    mean: Column
    m2: Column

    def merge(self, other: Moments) -> Moments:
        """Pairwise update of Chan, Golub and LeVeque."""
        n = self.n + other.n
        both = (self.n > 0) & (other.n > 0)
        delta = other.mean - self.mean
        mean = F.when(both, self.mean + delta * other.n / n).otherwise(
            F.coalesce(self.mean, other.mean)
        )
        m2 = self.m2 + other.m2 + F.when(both, delta * delta * self.n * other.n / n).otherwise(0.0)
        return Moments(n, mean, m2)

    def stddev(self) -> Column:
        """Sample standard deviation, null below two values."""
        return F.when(self.n > 1, F.sqrt(F.greatest(self.m2, F.lit(0.0)) / (self.n - 1)))


def zscore(value: Column, mean: Column, stddev: Column) -> Column:
    """Distance from the mean in standard deviations; 0 where it is undefined."""
    return F.coalesce((value - mean) / (stddev + F.lit(EPSILON)), F.lit(0.0))

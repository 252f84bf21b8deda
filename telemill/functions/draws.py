"""Reproducible random draws as column expressions.

A draw is a hash of (seed, key columns, stream name), so it depends on the row
alone: any partitioning, retry or recomputation gives the same value.

``md5`` draws can be repeated in any SQL engine; ``xxhash64`` draws stay in
generated code and are the ones to use for bulk noise.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest rate that one Poisson draw inverts; exp(-rate) is exact enough far beyond it.
POISSON_RATE = 500.0


@dataclass(frozen=True)
class Draws:
    """Draws for one seed: a number, or the name of a column that holds it.

    Key columns are given by name. The hash is written as one SQL expression,
    which keeps plans with many draws cheap to put together.
    """

    seed: int | str = 0
    method: str = "md5"

    def _units(self, keys: Sequence[str], stream: str) -> tuple[str, str]:
        """SQL of two independent uniforms in [0, 1): 52 bits from md5, 53 from xxhash64."""
        names = ", ".join(f"`{k}`" for k in keys)
        seed = f"`{self.seed}`" if isinstance(self.seed, str) else f"{int(self.seed)}L"
        if self.method == "md5":
            return self._cut(self._hash(keys, stream))
        if self.method == "xxhash64":
            h = "shiftrightunsigned(xxhash64(cast({seed} as bigint), {names}, '{stream}'), 11)"
            return tuple(
                f"({h.format(seed=seed, names=names, stream=s)} / 9007199254740992.0D)"
                for s in (stream, f"{stream}~")
            )
        raise ValueError(f"unknown draw method {self.method!r}")

    def _hash(self, keys: Sequence[str], stream: str) -> str:
        """SQL of the md5 of a draw; all draws of a row share the text in front of the stream."""
        names = ", ".join(f"`{k}`" for k in keys)
        seed = f"`{self.seed}`" if isinstance(self.seed, str) else f"{int(self.seed)}L"
        return f"md5(concat(concat_ws('|', {seed}, {names}, ''), '{stream}'))"

    @staticmethod
    def _cut(h: str) -> tuple[str, str]:
        """SQL of the two uniforms of an md5, cut as bytes, which needs no walk over the characters."""
        part = "(cast(conv(cast(substring(cast({h} as binary), {at}, 13) as string), 16, 10) as bigint) / 4503599627370496.0D)"
        return part.format(h=h, at=1), part.format(h=h, at=14)

    def hashed(self, keys: Sequence[str], stream: str) -> Column | None:
        """The md5 that ``standard_normal`` is cut from, for ``normal_of``; None where a draw isn't cut from one hash.

        In a branch of a condition Spark works out an expression as often as it is written, so a
        draw there is dear unless its hash is a column.
        """
        return F.expr(self._hash(keys, stream)) if self.method == "md5" else None

    def normal_of(self, name: str) -> Column:
        """``standard_normal`` from its hash in column ``name``."""
        return self._normal(*self._cut(f"`{name}`"))

    @staticmethod
    def _normal(u1: str, u2: str) -> Column:
        return F.expr(f"sqrt(-2.0D * ln(1.0D - {u1})) * cos({2.0 * math.pi!r}D * {u2})")

    def _unit(self, keys: Sequence[str], stream: str) -> Column:
        return F.expr(self._units(keys, stream)[0])

    def uniform(self, keys: Sequence[str], stream: str, lo=0.0, hi=1.0) -> Column:
        """Uniform in [lo, hi)."""
        return F.lit(lo) + self._unit(keys, stream) * (F.lit(hi) - F.lit(lo))

    def standard_normal(self, keys: Sequence[str], stream: str) -> Column:
        """Normal draw of mean 0 and spread 1 by Box-Muller."""
        return self._normal(*self._units(keys, stream))

    def normal(self, keys: Sequence[str], stream: str, mean=0.0, sd=1.0) -> Column:
        """Normal draw."""
        return F.lit(mean) + F.lit(sd) * self.standard_normal(keys, stream)

    def lognormal(self, keys, stream: str, mu, sigma, lo, hi) -> Column:
        """Lognormal clipped to [lo, hi]."""
        x = F.exp(self.normal(keys, stream, mu, sigma))
        return F.least(F.greatest(x, F.lit(lo)), F.lit(hi))

    def exponential(self, keys, stream: str, scale, lo, hi) -> Column:
        """Exponential clipped to [lo, hi]."""
        u = self._unit(keys, stream)
        x = F.lit(-1.0) * F.lit(scale) * F.log(F.lit(1.0) - u)
        return F.least(F.greatest(x, F.lit(lo)), F.lit(hi))

    def randint(self, keys, stream: str, lo: int, hi) -> Column:
        """Whole number in [lo, hi)."""
        u = self._unit(keys, stream)
        return F.floor(F.lit(lo) + u * (F.lit(hi) - F.lit(lo))).cast("int")

    def choice(self, options: Column, keys, stream: str) -> Column:
        """One element of an array column."""
        u = self._unit(keys, stream)
        return F.element_at(options, (F.floor(u * F.size(options)) + 1).cast("int"))

    def subset(self, options: Column, k: Column | str, keys, stream: str) -> Column:
        """``k`` elements without replacement: the ones with the lowest hashes."""
        seed = F.col(self.seed) if isinstance(self.seed, str) else F.lit(int(self.seed))
        prefix = F.concat_ws("|", seed, *keys, F.lit(stream))
        tagged = F.transform(
            options, lambda x: F.struct(F.md5(F.concat_ws("|", prefix, x)).alias("h"), x.alias("v"))
        )
        return F.transform(F.slice(F.array_sort(tagged), F.lit(1), F.col(k) if isinstance(k, str) else k), lambda s: s["v"])

    def poisson(self, rate: Column, keys, stream: str) -> Column:
        """Poisson count by inverting the distribution function.

        A rate above ``POISSON_RATE`` is cut into equal parts with a draw each, whose
        sum has the same law. The terms of a part run past the point where the tail
        drops below the resolution of the uniform, so no count is cut at any rate.
        """
        rate = rate.cast("double")
        parts = F.greatest(F.lit(1), F.ceil(rate / POISSON_RATE).cast("int"))
        # the first part keeps the name of the stream
        names = F.transform(
            F.sequence(F.lit(1), parts),
            lambda j: F.when(j == 1, F.lit(stream)).otherwise(F.concat(F.lit(f"{stream}#"), j.cast("string"))),
        )
        own = rate / parts
        counts = F.transform(names, lambda name: _inverted(own, self._uniform_of(keys, name)))
        return F.when(rate.isNotNull(), F.aggregate(counts, F.lit(0), lambda acc, n: acc + n))

    def _uniform_of(self, keys: Sequence[str], stream: Column) -> Column:
        """The uniform of a stream whose name is a column."""
        seed = F.col(self.seed) if isinstance(self.seed, str) else F.lit(int(self.seed)).cast("bigint")
        if self.method == "md5":
            h = F.md5(F.concat_ws("|", seed.cast("string"), *[F.col(k).cast("string") for k in keys], stream).cast("binary"))
            return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(4503599627370496.0)
        h = F.xxhash64(seed.cast("bigint"), *keys, stream)
        return F.shiftrightunsigned(h, 11) / F.lit(9007199254740992.0)


def _inverted(rate: Column, u: Column) -> Column:
    """Number of terms of the distribution function that do not exceed ``u``."""
    last = F.ceil(rate + 12.0 * F.sqrt(rate) + 30.0).cast("int")
    none = F.exp(-rate)
    start = F.struct(F.lit(0).alias("n"), none.alias("p"), none.alias("cdf"), u.alias("u"))

    def step(acc, k):
        p = acc["p"] * rate / k
        return F.struct(
            (acc["n"] + (acc["cdf"] <= acc["u"]).cast("int")).alias("n"),
            p.alias("p"),
            (acc["cdf"] + p).alias("cdf"),
            acc["u"].alias("u"),
        )

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["n"])

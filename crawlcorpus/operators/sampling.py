"""Reproducible Bernoulli samples.

The draw is a hash of the record id, so it does not depend on how the data are
partitioned, can be pushed below any costly step, and gives the same rows on a retry.
"""

from pyspark.sql import Column, DataFrame, functions as F

# Seeds of successive inputs.
FIRST_SEED = 6472
SEED_STEP = 163


def hash32(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("bigint")


def draw(key: Column, seed) -> Column:
    """Uniform in [0, 1)."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return hash32(F.concat_ws(":", seed.cast("string"), key)) / F.lit(4294967296.0)


def drawn(key: Column, ratio: float, seed=FIRST_SEED) -> Column:
    return draw(key, seed) <= F.lit(float(ratio))


def bernoulli(df: DataFrame, key: Column, ratio: float, seed=FIRST_SEED) -> DataFrame:
    return df.where(drawn(key, ratio, seed))


def choice(key: Column, options: list) -> Column:
    """One of the options for each key, evenly."""
    index = F.pmod(hash32(key), F.lit(len(options))) + 1
    return F.element_at(F.array(*[F.lit(o) for o in options]), index.cast("int"))

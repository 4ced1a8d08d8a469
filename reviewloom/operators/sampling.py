"""Repeatable samples and splits: a row's fate depends on its id and a seed only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.text import md5_number

SPACE = 1 << 32
MAX_GROUPS = 100_000


def draw(seed: int, *ids: str | Column) -> Column:
    """A number in [0, 2**32) for a row, from its ids and the seed."""
    return md5_number(_keyed(seed, *ids))


def _keyed(seed: int, *ids: str | Column) -> Column:
    return F.concat_ws(":", F.lit(str(seed)), *[_col(i).cast("string") for i in ids])


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fraction(df: DataFrame, id: str, share: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample of rows; a filter, no shuffle."""
    return df.filter(draw(seed, id) < int(share * SPACE))


def per_group(
    df: DataFrame,
    group: str | Column,
    id: str,
    share: float = 0.1,
    per_group: int = 10,
    groups: int = 100,
    total: int = 1000,
    seed: int = 42,
) -> DataFrame:
    """At most ``groups`` random groups, ``per_group`` rows of a ``share`` sample from each.

    One scan instead of one read per group. Only ``per_group`` rows of a group leave each input
    partition, however large the group is.
    """
    if groups > MAX_GROUPS:
        raise ValueError(f"at most {MAX_GROUPS} groups can be chosen")
    marked = df.withColumn("_group", _col(group).cast("string"))
    chosen = (
        marked.select("_group")
        .distinct()
        .orderBy(F.md5(_keyed(seed, "_group").cast("binary")), "_group")
        .limit(groups)
    )
    by_draw = [F.md5(_keyed(seed, id).cast("binary")), F.col(id)]
    ranked = fraction(marked, id, share, seed).join(F.broadcast(chosen), "_group", "left_semi")
    within = Window.partitionBy("_group").orderBy(*by_draw)
    return (
        ranked.withColumn("_rank", F.row_number().over(within))
        .filter(F.col("_rank") <= per_group)
        .orderBy(*by_draw)
        .limit(total)
        .drop("_group", "_rank")
    )


def split(df: DataFrame, id: str, shares: dict[str, float], seed: int = 42) -> DataFrame:
    """Adds ``part``: the named share a row belongs to. Equal ids always share a part."""
    if abs(sum(shares.values()) - 1.0) > 1e-9:
        raise ValueError("shares must add up to 1")
    names, upper, part = list(shares), 0.0, None
    at = draw(seed, id)
    for name in names[:-1]:
        upper += shares[name]
        hit = at < int(upper * SPACE)
        part = F.when(hit, name) if part is None else part.when(hit, name)
    last = F.lit(names[-1])
    return df.withColumn("part", last if part is None else part.otherwise(last))


def first_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)

"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   tiebreak: Sequence[Column] = (), drop_null_keys: bool = False) -> DataFrame:
    """Keep rank 1 of ``row_number() over (partition by keys order by order, tiebreak)``.

    ``order`` carries the null placement explicitly (``desc_nulls_first`` for a
    bare ``DESC`` in the warehouse, ``desc_nulls_last`` when spelled out), and
    ``tiebreak`` makes the winner deterministic.

    Plan: Catalyst turns ``rank = 1`` into a WindowGroupLimit that runs once
    *before* the shuffle (each map task keeps one row per key) and once after,
    so even a key holding a third of all rows ships at most one row per map
    partition.  ``drop_null_keys`` filters NULL keys before the window when
    the caller discards them anyway (they would otherwise form one hot group).
    """
    src = df
    if drop_null_keys:
        cond = None
        for k in keys:
            cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
        src = src.filter(cond)
    w = Window.partitionBy(*keys).orderBy(*order, *tiebreak)
    return src.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") == 1).drop("__rank")

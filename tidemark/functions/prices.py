"""Price expressions over the columns of a bar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import COINS, USD


def avg_price(usd: str = USD, coins: str = COINS) -> Column:
    """Volume-weighted average price of a bar; 0 where it traded nothing."""
    u, c = F.col(usd), F.col(coins)
    return F.when(u * c != 0, u / c).otherwise(F.lit(0.0))


def phase(offset: Column) -> Column:
    """Phase of a case row by its offset from the target: -1 before, 0 at, 1 just after, 2 later."""
    return F.when(offset < 0, -1).when(offset > 1, 2).otherwise(offset).cast("int")

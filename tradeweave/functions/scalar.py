"""Dates as yyyymmdd integers, exact money sums and the transfer-fee step."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1e6


def day_number(day: dt.date | int) -> int:
    return day if isinstance(day, int) else int(day.strftime("%Y%m%d"))


def days_before(day: dt.date | int, n: int) -> int:
    """yyyymmdd of ``n`` days before ``day``."""
    d = dt.datetime.strptime(str(day_number(day)), "%Y%m%d").date()
    return day_number(d - dt.timedelta(days=n))


def load_stamp() -> Column:
    return F.date_format(F.current_timestamp(), "MMM dd HH:mm:ss yyyy")


def micros(amount: Column) -> Column:
    """Amount in whole millionths, so that sums are exact and do not depend on partitioning.

    From 2**52 millionths on a double is whole and needs no rounding. What no decimal holds (beyond 38
    digits, infinite, not a number) raises an error, as does a sum that grows beyond it.
    """
    scaled = amount * MICRO
    rounded = F.when(F.abs(scaled) < 2.0 ** 52, F.floor(scaled + 0.5).cast("decimal(38,0)"))
    rounded = rounded.when(F.abs(scaled) < 1e38, scaled.cast("decimal(38,0)"))
    refused = F.raise_error(F.concat(F.lit("amount out of range: "), amount.cast("string"))).cast("decimal(38,0)")
    return rounded.when(scaled.isNotNull(), refused)


def from_micros(total: Column) -> Column:
    return total.cast("double") / MICRO


def transfer_fee(quantity: Column) -> Column:
    """1% of the quantity rounded up to the next 10, at most 100; null stays null."""
    stepped = (F.ceil((quantity * 0.01) / 10) * 10).cast("double")
    return F.when(stepped > 100, 100.0).otherwise(stepped)

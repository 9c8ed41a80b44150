"""Cross sections of option chains and windows that the detectors take as input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numbers import safe_div


def iv_cross_section(chain: DataFrame, by: Sequence[str] = ("snapshot_time", "underlying", "expiration"), iv: str = "implied_vol") -> DataFrame:
    """Rank, percentile and z-score of implied volatility inside one expiration's chain.

    A chain holds the contracts an exchange lists for one expiration, so a group is small.
    """
    whole = Window.partitionBy(*by)
    ranked = whole.orderBy(iv)
    v = F.col(iv)
    return chain.where(v.isNotNull()).withColumns(
        {
            "iv_rank_in_expiration": F.rank().over(ranked).cast("bigint"),
            "iv_percentile_by_expiration": F.percent_rank().over(ranked),
            "iv_zscore_by_expiration": safe_div(v - F.avg(v).over(whole), F.stddev_pop(v).over(whole)),
            "expiration_chain_contract_count": F.count(F.lit(1)).over(whole),
        }
    )


def same_time_percentile(windows: DataFrame, keys: Sequence[str], days: int = 20, volume: str = "window_volume") -> DataFrame:
    """Share of the key's windows at the same time of day in the prior ``days`` with at most this volume."""
    at = F.hour("bucket") * 3600 + F.minute("bucket") * 60 + F.second("bucket")
    day = F.datediff(F.to_date("bucket"), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*keys, "_at").orderBy("_day").rangeBetween(-days, -1)
    past = F.collect_list(volume).over(w)
    share = safe_div(F.size(F.filter("_past", lambda x: x <= F.col(volume))).cast("double"), F.size("_past").cast("double"))
    return (
        windows.withColumns({"_at": at, "_day": day})
        .withColumn("_past", past)
        .withColumn(f"volume_percentile_{days}d_same_time", share)
        .drop("_at", "_day", "_past")
    )

"""The ad-to-campaign table and its lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def campaign_mapping(ads: DataFrame, ads_per_campaign: int = 100) -> DataFrame:
    """Campaign of each ad: its running number ``ad_index`` over the campaign size."""
    index = F.col("ad_index").cast("bigint")
    first = index - F.pmod(index, F.lit(ads_per_campaign))
    campaign = F.call_function("div", first, F.lit(ads_per_campaign))
    return ads.select("ad_id", campaign.cast("int").alias("campaign_id"))


def enrich_campaign(events: DataFrame, mapping: DataFrame, salts: int = 1) -> DataFrame:
    """Add each ad's campaign; events of unknown ads drop out.

    No broadcast is forced. Spark broadcasts the mapping while its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it; a batch join
    then has its skewed partitions split by adaptive execution. A stream has no
    such help, so with a mapping too large to broadcast set ``salts`` to spread
    one hot ad over that many tasks: the mapping is repeated once per salt.
    """
    if salts == 1:
        return events.join(mapping, "ad_id")
    spread = F.pmod(F.xxhash64("user_id", "event_time", "event_type"), F.lit(salts))
    salted = mapping.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        events.withColumn("salt", spread.cast("int"))
        .join(salted, ["ad_id", "salt"])
        .drop("salt")
    )

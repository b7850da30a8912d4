"""Zone enrichment (extension): pickup and dropoff zone names from the zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.operators.explore import BROADCAST_ROW_LIMIT


def enrich_zones(df: DataFrame, zones: DataFrame, pickup: str = "PULocationID", dropoff: str = "DOLocationID",
                 limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Two left joins on the zone id (pickup and dropoff). The dimension is broadcast only after
    its row count is checked (265 rows for the taxi zones); a larger one takes a shuffle join."""
    z = zones.select(F.col("LocationID").cast("bigint").alias("_zid"), "Borough", "Zone", "service_zone")
    if z.count() <= limit:
        z = F.broadcast(z)

    def side(prefix):
        return z.select(F.col("_zid").alias(f"_{prefix}_id"), F.col("Borough").alias(f"{prefix}_borough"),
                        F.col("Zone").alias(f"{prefix}_zone"), F.col("service_zone").alias(f"{prefix}_service_zone"))

    pu, do = side("pu"), side("do")
    out = df.join(pu, F.col(pickup).cast("bigint") == F.col("_pu_id"), "left").drop("_pu_id")
    return out.join(do, F.col(dropoff).cast("bigint") == F.col("_do_id"), "left").drop("_do_id")

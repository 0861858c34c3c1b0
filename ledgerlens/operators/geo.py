"""Two-hop address lookup (22): ticket -> address -> coordinates.

``addresses`` has one row per ticket, so it grows with the tickets and is
joined by key like any fact table (Spark/AQE choose the strategy from real
sizes).  ``latlons`` has one row per distinct address; it is the lookup side
and goes through the size-checked lookup join (broadcast when small, salted
when not: one address can be on a large share of tickets).  Tickets and
addresses that lie bucketed by ticket (``session.bucketed``) are joined
without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import lookup_join
from ..session import materialize


def attach_coordinates(tickets: DataFrame, addresses: DataFrame, latlons: DataFrame,
                       key: str = "ticket_id") -> DataFrame:
    """Left joins: tickets keep every row; unknown addresses give null lat/lon."""
    # of conflicting rows the smallest address / coordinates, whatever the order they come in
    addr = addresses.groupBy(key).agg(F.min("address").alias("address"))
    coords = latlons.groupBy("address").agg(F.min(F.struct("lat", "lon")).alias("_at")).select(
        "address", F.col("_at.lat").alias("lat"), F.col("_at.lon").alias("lon"))
    with_addr = tickets.join(addr, key, "left")
    return lookup_join(with_addr, materialize(coords, "coordinates"), "address", "left")

"""City and time-zone dimensions of the geo marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Id, city, latitude and longitude of the city centroids.
CITIES = [
    (1, "Sydney", -33.865, 151.2094),
    (2, "Melbourne", -37.8136, 144.9631),
    (3, "Brisbane", -27.4678, 153.0281),
    (4, "Perth", -31.9522, 115.8589),
    (5, "Adelaide", -34.9289, 138.6011),
    (6, "Gold Coast", -28.0167, 153.47),
    (7, "Cranbourne", -38.0996, 145.2834),
    (8, "Canberra", -35.2931, 149.1269),
    (9, "Newcastle", -32.9167, 151.75),
    (10, "Wollongong", -34.4331, 150.8831),
    (11, "Geelong", -38.15, 144.35),
    (12, "Hobart", -42.8806, 147.325),
    (13, "Townsville", -19.2564, 146.8183),
    (14, "Ipswich", -27.6167, 152.7667),
    (15, "Cairns", -16.9303, 145.7703),
    (16, "Toowoomba", -27.5667, 151.95),
    (17, "Darwin", -12.4381, 130.8411),
    (18, "Ballarat", -37.55, 143.85),
    (19, "Bendigo", -36.75, 144.2667),
    (20, "Launceston", -41.4419, 147.145),
    (21, "Mackay", -21.1411, 149.1861),
    (22, "Rockhampton", -23.375, 150.5117),
    (23, "Maitland", -32.7167, 151.55),
    (24, "Bunbury", -33.3333, 115.6333),
]

# Time zone of each city. Five cities are assigned to Sydney by
# rule of the mart; the others have the zone of their state.
CITY_ZONES = {
    "Sydney": "Australia/Sydney",
    "Melbourne": "Australia/Melbourne",
    "Brisbane": "Australia/Brisbane",
    "Perth": "Australia/Perth",
    "Adelaide": "Australia/Adelaide",
    "Gold Coast": "Australia/Sydney",
    "Cranbourne": "Australia/Sydney",
    "Canberra": "Australia/Canberra",
    "Newcastle": "Australia/Sydney",
    "Wollongong": "Australia/Sydney",
    "Geelong": "Australia/Melbourne",
    "Hobart": "Australia/Hobart",
    "Townsville": "Australia/Sydney",
    "Ipswich": "Australia/Sydney",
    "Cairns": "Australia/Brisbane",
    "Toowoomba": "Australia/Brisbane",
    "Darwin": "Australia/Darwin",
    "Ballarat": "Australia/Melbourne",
    "Bendigo": "Australia/Melbourne",
    "Launceston": "Australia/Hobart",
    "Mackay": "Australia/Brisbane",
    "Rockhampton": "Australia/Brisbane",
    "Maitland": "Australia/Sydney",
    "Bunbury": "Australia/Sydney",
}


def cities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITIES, "id bigint, city string, lat double, lon double")


def zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CITY_ZONES.items()), "city string, zone string")

"""Small hand-written inputs."""

import math
from datetime import datetime, timedelta

SERIES = "home_id bigint, ts timestamp_ntz, consumption double, outdoor_temp double, household_size double"


def series(spark, homes):
    """``homes``: home -> list of (hour offset, consumption)."""
    start = datetime(2024, 1, 1)
    rows = [
        (home, start + timedelta(hours=offset), value, 10.0, 3.0)
        for home, points in homes.items()
        for offset, value in points
    ]
    return spark.createDataFrame(rows, SERIES)


def daily_cycle(days=14, homes=3):
    """Consumption with a daily sine cycle and a little repeatable unrest."""
    return {
        home: [
            (h, 5 + home + 2 * math.sin(2 * math.pi * (h % 24) / 24) + 0.05 * ((h * 7919 + home) % 11 - 5))
            for h in range(24 * days)
        ]
        for home in range(homes)
    }


# home, appliance, energy, time, date, temperature, season, size
GOOD = (1, "Heater", 3.5, "21:12", "2023-12-02", -2.5, "Winter", 4)


def reading(**changes):
    names = ("home", "appliance", "energy", "time", "date", "temperature", "season", "size")
    return tuple({**dict(zip(names, GOOD)), **changes}.values())

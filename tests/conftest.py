import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexifacet import Collection  # noqa: E402

# The three link rows, their tags and epoch seconds.
NAMES = [
    "Paint Protects WiFi Network from Hackers",
    "Airplanes To Become WiFi Hotspots",
    "Planet VIP-195 GSM/WiFi Phone With Windows Messanger",
]
DESCRIPTIONS = [
    "A company known as SEC Technologies has created a special type of paint that blocks Wi-Fi "
    "signals so that you can be sure hackers can ",
    "Airlines will start turning their airplanes into WiFi hotspots beginning early next year, "
    "WSJ reports. Here's what you need to know...",
    "The phone does comply with IEEE 802.11b and IEEE 802.11g to provide phone capability via "
    "WiFi. As GSM phone the VIP-195 support 900/1800/1900 band and GPRS too. It comes with "
    "simple button to switch between WiFi or GSM mod",
]
CREATED = [1175683690, 1175683755, 1175683847]
GROUPS = [1, 2, 1]
RATINGS = [13.32, 54.85, 16.25]
TAGS = [[1, 2, 3, 4], [5, 6, 7, 8], [1, 7, 9, 10]]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lexifacet-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _links(spark, first_id):
    rows = [
        (first_id + i, NAMES[i], DESCRIPTIONS[i], GROUPS[i], CREATED[i], RATINGS[i], TAGS[i])
        for i in range(3)
    ]
    schema = (
        "id bigint, name string, description string, group_id bigint, at bigint, "
        "rating double, tags array<bigint>"
    )
    return spark.createDataFrame(rows, schema).withColumn("created_at", F.timestamp_seconds("at"))


@pytest.fixture(scope="session")
def test1(spark):
    return Collection(
        "test1",
        _links(spark, 1),
        "id",
        ("name", "description"),
        ("group_id", "created_at", "rating", "tags"),
    )


@pytest.fixture(scope="session")
def test2(spark):
    return Collection(
        "test2", _links(spark, 4294967297), "id", ("name", "description"), ("group_id", "created_at")
    )

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfspan.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_panel(spark):
    """Two stores, two items, ninety days of seeded intermittent demand; one item never sells in one store."""
    import datetime as dt
    import random

    draw = random.Random(7)
    rows = []
    for store, state in (("S1", "CA"), ("S2", "TX")):
        for item in ("I1", "I2"):
            for n in range(90):
                day = dt.date(2020, 1, 1) + dt.timedelta(days=n)
                never = store == "S2" and item == "I2"
                demand = 0 if never or draw.random() < 0.6 else draw.randint(1, 9)
                price = None if n < 5 or n % 13 == 0 else round(draw.uniform(1, 10), 2)
                rows.append((f"{item}_{store}", item, "D1", "C1" if item == "I1" else "C2", store, state, f"d_{n + 1}", demand, n + 1, day, price))
    schema = "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d string, demand long, day_num int, date date, sell_price double"
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="session")
def small_pandas(small_panel):
    return small_panel.toPandas().sort_values(["store_id", "item_id", "date"]).reset_index(drop=True)

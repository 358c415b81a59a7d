"""Property tests: random edition tables, invariants of the dimension operators."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from greenledger.operators.dimension import current_only, flag_current, rank_editions

NAMES = st.sampled_from(["Gas", "Oil", "Coal", None])
UNITS = st.sampled_from(["kWh", "litres"])
YEARS = st.integers(min_value=2018, max_value=2024)
ROW = st.tuples(NAMES, UNITS, YEARS, st.booleans())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(ROW, min_size=1, max_size=60), parts=st.integers(min_value=1, max_value=9))
def test_rank_flag_invariants(spark, data, parts):
    rows = [(f"id{i:03d}", "s", name, unit, dt.date(y, 1, 1),
             None if open_end else dt.date(y, 12, 31))
            for i, (name, unit, y, open_end) in enumerate(data)]
    df = spark.createDataFrame(
        rows, "id string, source string, factor_name string, unit string, valid_from date, valid_to date")
    window = {r["id"]: r["rn"] for r in rank_editions(df, method="window").collect()}
    ranged = {r["id"]: r["rn"] for r in rank_editions(df, method="range", partitions=parts).collect()}
    assert ranged == window
    flags = {r["id"]: r["is_current"] for r in flag_current(df).collect()}
    assert flags == {k: v == 1 for k, v in window.items()}
    assert {r["id"] for r in current_only(df).collect()} == {k for k, v in window.items() if v == 1}
    groups = df.groupBy("source", "factor_name", "unit").count().count()
    assert sum(flags.values()) == groups

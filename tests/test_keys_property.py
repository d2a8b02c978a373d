"""Property test: distributed key assignment is dense and follows the order."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aerostar.operators.keys import assign_keys


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-50, 50), max_size=200), start=st.integers(0, 10**6),
       partitions=st.integers(1, 7))
def test_keys_dense_and_ordered(spark, values, start, partitions):
    df = spark.createDataFrame([(v,) for v in values], "o int")
    rows = sorted((r.k, r.o) for r in assign_keys(df, "k", ["o"], start=start,
                                                  partitions=partitions).collect())
    assert [k for k, _ in rows] == list(range(start + 1, start + 1 + len(values)))
    assert [o for _, o in rows] == sorted(values)

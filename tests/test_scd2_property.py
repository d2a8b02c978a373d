"""Property test: SCD2 on random dimensions and batches equals the
record-by-record loop of the original (NULL-safe comparison, batch order)."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aerostar.operators.scd2 import scd2_apply
from test_scd2 import BATCH, D0, DIM, TODAY
from test_scd2_skew import _simulate

tiers = st.sampled_from(["Gold", "Silver", None])
emails = st.sampled_from(["a@x", "b@x", None])
customers = st.sampled_from([f"C{i}" for i in range(6)])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(current=st.dictionaries(customers, st.tuples(tiers, emails), max_size=5),
       records=st.lists(st.tuples(customers, tiers, emails), max_size=30))
def test_scd2_equals_record_loop(spark, current, records):
    dim_rows = [(k + 1, cid, "F", "L", email, None, tier, 0, D0, None, True)
                for k, (cid, (tier, email)) in enumerate(sorted(current.items()))]
    batch_rows = [(seq + 1, cid, "F", "L", email, tier, 0)
                  for seq, (cid, tier, email) in enumerate(records)]
    dim = spark.createDataFrame(dim_rows, DIM)
    out = scd2_apply(dim, spark.createDataFrame(batch_rows, BATCH), as_of=TODAY).collect()

    opened, final = _simulate(dim_rows, batch_rows)
    start = len(dim_rows)
    new = sorted((r.CustomerKey, r.CustomerID) for r in out if r.CustomerKey > start)
    assert [c for _, c in new] == [c for c, _ in sorted(opened, key=lambda x: (x[1], x[0]))]
    assert [k for k, _ in new] == list(range(start + 1, start + 1 + len(opened)))
    assert {r.CustomerID: (r.LoyaltyTier, r.Email) for r in out if r.IsCurrent} == final
    assert len([r for r in out if r.IsCurrent]) == len(final)

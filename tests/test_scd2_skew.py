"""SCD2 with one customer holding most of the batch (its rows span several
range partitions) against a direct simulation of the record-by-record loop."""
import random

from aerostar.operators.scd2 import scd2_apply
from test_scd2 import BATCH, D0, DIM, TODAY


def _simulate(dim_rows, batch_rows):
    """The original loop: compare each record with the current version."""
    current = {r[1]: (r[6], r[4]) for r in dim_rows if r[10]}
    opened = []
    for seq, cid, _fn, _ln, email, tier, _pts in sorted(batch_rows, key=lambda r: (r[0], r[1])):
        if cid in current and current[cid] == (tier, email):
            continue
        current[cid] = (tier, email)
        opened.append((cid, seq))
    return opened, current


def test_hot_key_matches_simulation(spark):
    rnd = random.Random(7)
    dim_rows = [(1, "HOT", "H", "H", "h@x", None, "Gold", 0, D0, None, True),
                (2, "C2", "B", "Y", "b@x", None, "Silver", 0, D0, None, True)]
    batch_rows = []
    tier = "Gold"
    for seq in range(1, 3001):                       # the hot key: 3000 records
        if rnd.random() < 0.1:
            tier = rnd.choice(["Gold", "Silver", None])
        email = "h@x" if rnd.random() < 0.97 else None
        batch_rows.append((seq, "HOT", "H", "H", email, tier, seq))
    for seq in range(1, 40):                         # a few ordinary customers
        batch_rows.append((seq, f"N{seq % 7}", "N", "N", "n@x", ["A", "B"][seq % 2], 0))
    dim = spark.createDataFrame(dim_rows, DIM)
    batch = spark.createDataFrame(batch_rows, BATCH)
    out = scd2_apply(dim, batch.repartition(5), as_of=TODAY).collect()

    opened, current = _simulate(dim_rows, batch_rows)
    new = sorted(((r.CustomerID, r.CustomerKey) for r in out if r.CustomerKey > 2), key=lambda x: x[1])
    assert len(new) == len(opened)
    # Keys follow batch order (seq, CustomerID) and are dense after MAX = 2.
    assert [k for _, k in new] == list(range(3, 3 + len(opened)))
    assert [c for c, _ in new] == [c for c, _ in sorted(opened, key=lambda x: (x[1], x[0]))]
    cur = {r.CustomerID: (r.LoyaltyTier, r.Email) for r in out if r.IsCurrent}
    assert cur == current
    assert sum(1 for r in out if r.IsCurrent and r.CustomerID == "HOT") == 1

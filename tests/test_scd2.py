import datetime as dt

from pyspark.sql import functions as F

from aerostar.operators.keys import assign_keys
from aerostar.operators.scd2 import point_in_time, scd2_apply

DIM = ("CustomerKey long, CustomerID string, FirstName string, LastName string, Email string, "
       "Phone string, LoyaltyTier string, LoyaltyPoints int, EffectiveDate date, "
       "ExpirationDate date, IsCurrent boolean")
BATCH = ("seq long, CustomerID string, FirstName string, LastName string, Email string, "
         "LoyaltyTier string, LoyaltyPoints int")
D0 = dt.date(2020, 1, 1)
TODAY = dt.date(2024, 12, 31)


def _dim(spark):
    return spark.createDataFrame([
        (1, "C1", "A", "X", "a@x", "111", "Gold", 10, D0, None, True),
        (2, "C2", "B", "Y", "b@x", "222", None, 20, D0, None, True),
        (3, "C3", "C", "Z", "c@x", "333", "Silver", 30, D0, None, True),
        (4, "C4", "D", "W", "d@x", "444", "Bronze", 40, D0, None, True),
    ], DIM)


def _batch(spark):
    return spark.createDataFrame([
        (1, "C1", "A", "X", "a@x", "Gold", 99),       # points only -> ignored
        (1, "C2", "B", "Y", "b@x", "Silver", 20),     # NULL -> value: change
        (1, "C3", "C", "Z", "c@x", "Gold", 30),       # change 1
        (2, "C3", "C", "Z", "c@x", "Gold", 31),       # same tuple -> skip
        (3, "C3", "C", "Z", "c2@x", "Gold", 32),      # change 2 (same day)
        (1, "C9", "N", "New", "n@x", "Bronze", 0),    # new customer
    ], BATCH)


def test_scd2_paths(spark):
    out = scd2_apply(_dim(spark), _batch(spark), as_of=TODAY)
    rows = out.collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.CustomerID, []).append(r)
    assert len(by_id["C1"]) == 1 and by_id["C1"][0].IsCurrent
    assert len(by_id["C4"]) == 1
    c2 = sorted(by_id["C2"], key=lambda r: r.CustomerKey)
    assert [r.IsCurrent for r in c2] == [False, True] and c2[0].ExpirationDate == TODAY
    assert c2[1].Phone is None and c2[1].EffectiveDate == TODAY      # not carried forward
    c3 = sorted(by_id["C3"], key=lambda r: r.CustomerKey)
    assert [(r.Email, r.IsCurrent) for r in c3] == [("c@x", False), ("c@x", False), ("c2@x", True)]
    assert c3[1].EffectiveDate == c3[1].ExpirationDate == TODAY      # same-day version
    new_keys = sorted(r.CustomerKey for r in rows if r.CustomerKey > 4)
    assert new_keys == [5, 6, 7, 8]                                  # dense after MAX
    assert len([r for r in rows if r.IsCurrent]) == 5


def test_scd2_second_apply_changes_nothing(spark):
    # One record per customer: replaying the same snapshot opens no version.
    batch = _batch(spark).filter("NOT (CustomerID = 'C3' AND seq < 3)")
    once = scd2_apply(_dim(spark), batch, as_of=TODAY)
    twice = scd2_apply(once, batch, as_of=TODAY)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_carry_forward(spark):
    out = scd2_apply(_dim(spark), _batch(spark), as_of=TODAY, carry_forward=True)
    cur = {r.CustomerID: r for r in out.filter("IsCurrent").collect()}
    assert cur["C2"].Phone == "222"


def test_assign_keys_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("o"))
    out = assign_keys(df, "k", ["o"], start=100, partitions=4).collect()
    pairs = sorted((r.o, r.k) for r in out)
    assert [k for _, k in pairs] == list(range(101, 1101))


def test_point_in_time_lookup(spark):
    dim = spark.createDataFrame([
        ("C1", D0, dt.date(2024, 6, 1), "Gold"),
        ("C1", dt.date(2024, 6, 1), None, "Platinum"),
        ("C1", dt.date(2024, 6, 1), dt.date(2024, 6, 1), "SameDay"),
    ], "CustomerID string, EffectiveDate date, ExpirationDate date, LoyaltyTier string")
    facts = spark.createDataFrame([(1, "C1", dt.date(2024, 5, 31)), (2, "C1", dt.date(2024, 6, 1)),
                                   (3, "C2", dt.date(2024, 6, 1))], "id int, cid string, d date")
    got = {r.id: r.LoyaltyTier for r in
           point_in_time(facts, dim, "cid", "CustomerID", "d", ["LoyaltyTier"]).collect()}
    assert got == {1: "Gold", 2: "Platinum", 3: None}


def test_duplicate_current_versions_reported_and_highest_key_wins(spark):
    from aerostar.operators.quality import dq_current_versions
    dim = _dim(spark).union(spark.createDataFrame(
        [(9, "C1", "A", "X", "a@x", "111", "Silver", 10, D0, None, True)], DIM))
    assert [(r.CustomerID, r.CurrentVersions) for r in dq_current_versions(dim).collect()] == [("C1", 2)]
    batch = spark.createDataFrame([(1, "C1", "A", "X", "a@x", "Silver", 10)], BATCH)
    out = scd2_apply(dim, batch, as_of=TODAY)
    # Compared with key 9 (Silver): no change, nothing expires or opens.
    assert sorted(r.CustomerKey for r in out.collect()) == [1, 2, 3, 4, 9]

"""Oracle SQL texts (DuckDB) for the ETL and data-quality jobs."""

from __future__ import annotations

from aerostar.oracle.prelude import with_prelude
from aerostar.oracle.texts import AS_OF

ETL_TEXTS: dict[str, str] = {}

# Nulls come first, as in the job's order.
_BATCH_ORDER = ("FlightKey, DateKey, AircraftKey, DepartureAirportKey, ArrivalAirportKey, "
                "CarrierKey, DepartureDelayMin, ArrivalDelayMin, SeatsAvailable, SeatsFilled, "
                "Revenue, FuelCost, DistanceMiles, CancellationFlag").replace(",", " NULLS FIRST,") + " NULLS FIRST"

_FLIGHT_BATCH = f"""
fbatch AS (
  SELECT CASE WHEN l_orderkey % 50 = 0 THEN -(l_orderkey * 8 + l_linenumber)
              ELSE l_orderkey * 8 + l_linenumber END AS FlightFactKey,
         CASE WHEN l_orderkey % 499 <> 3 THEN l_partkey END AS FlightKey,
         CAST(year(dd) * 10000 + month(dd) * 100 + day(dd) AS INTEGER) AS DateKey,
         CASE WHEN l_orderkey % 503 <> 5 THEN l_suppkey END AS AircraftKey,
         CAST(l_partkey % 25 AS INTEGER) AS DepartureAirportKey,
         CAST((l_partkey + 1 + l_partkey % 4) % 25 AS INTEGER) AS ArrivalAirportKey,
         CAST(l_suppkey % 5 AS INTEGER) AS CarrierKey,
         CASE WHEN l_orderkey % 523 <> 13 THEN q - 5 END AS DepartureDelayMin,
         CASE WHEN l_orderkey % 541 <> 17 THEN q * 2 - 10 END AS ArrivalDelayMin,
         CAST(CASE WHEN l_orderkey % 521 = 11 THEN 0 ELSE 150 + l_partkey % 200 END AS INTEGER) AS SeatsAvailable,
         CAST(CASE WHEN l_orderkey % 509 = 7 THEN 153 + l_partkey % 200 WHEN l_orderkey % 557 = 23 THEN -4
                   ELSE 150 + l_partkey % 200 - q END AS INTEGER) AS SeatsFilled,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS Revenue,
         CAST(q * 500 AS DECIMAL(10,2)) AS FuelCost,
         CAST(200 + l_partkey % 2800 AS INTEGER) AS DistanceMiles,
         CASE WHEN l_orderkey % 547 <> 19 THEN l_discount >= 0.095 END AS CancellationFlag
  FROM (SELECT *, CAST(FLOOR(l_quantity) AS INTEGER) AS q,
               CAST(CAST(l_shipdate AS DATE) + 9131 AS DATE) AS dd FROM lineitem)
),
fseq AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY FlightFactKey ORDER BY {_BATCH_ORDER}) AS seq
  FROM fbatch
),
fvalid AS (
  SELECT * REPLACE (COALESCE(DepartureDelayMin, 0) AS DepartureDelayMin, COALESCE(ArrivalDelayMin, 0) AS ArrivalDelayMin,
                    COALESCE(CancellationFlag, FALSE) AS CancellationFlag),
         CAST(ROUND(100.0 * SeatsFilled / SeatsAvailable, 2) AS DECIMAL(5,2)) AS LoadFactor,
         COALESCE(ArrivalDelayMin, 0) <= 15 AS OnTimeFlag
  FROM fseq
  WHERE FlightKey IS NOT NULL AND DateKey IS NOT NULL AND AircraftKey IS NOT NULL
    AND DepartureAirportKey IS NOT NULL AND ArrivalAirportKey IS NOT NULL
    AND COALESCE(SeatsAvailable, 0) >= COALESCE(SeatsFilled, 0)
    AND COALESCE(SeatsAvailable, 0) <> 0
)"""

ETL_TEXTS["flight_transform"] = with_prelude("""
SELECT FlightFactKey, FlightKey, DateKey, AircraftKey, DepartureAirportKey, ArrivalAirportKey,
       CarrierKey, DepartureDelayMin, ArrivalDelayMin, SeatsAvailable, SeatsFilled,
       CAST(Revenue AS DOUBLE) AS Revenue, CAST(FuelCost AS DOUBLE) AS FuelCost, DistanceMiles,
       CancellationFlag, CAST(LoadFactor AS DOUBLE) AS LoadFactor, OnTimeFlag
FROM fvalid
""", _FLIGHT_BATCH)

ETL_TEXTS["flight_validate"] = with_prelude("""
SELECT FlightFactKey, FlightKey, DateKey, AircraftKey, DepartureAirportKey, ArrivalAirportKey,
       CarrierKey, DepartureDelayMin, ArrivalDelayMin, SeatsAvailable, SeatsFilled,
       CAST(Revenue AS DOUBLE) AS Revenue, CAST(FuelCost AS DOUBLE) AS FuelCost, DistanceMiles,
       CancellationFlag, RejectReason
FROM (SELECT *, CASE WHEN FlightKey IS NULL THEN 'missing_FlightKey' WHEN AircraftKey IS NULL THEN 'missing_AircraftKey'
                     WHEN SeatsFilled > SeatsAvailable THEN 'seats_filled_exceed_available'
                     WHEN SeatsAvailable = 0 THEN 'no_seats_available' END AS RejectReason FROM fbatch)
WHERE RejectReason IS NOT NULL
""", _FLIGHT_BATCH)

_FIRST = ["FlightKey", "DateKey", "AircraftKey", "DepartureAirportKey", "ArrivalAirportKey",
          "CarrierKey", "SeatsAvailable", "Revenue", "FuelCost", "DistanceMiles", "CancellationFlag"]
_LAST = ["DepartureDelayMin", "ArrivalDelayMin", "SeatsFilled", "LoadFactor"]

_COLLAPSE = (",\ncoll AS (\n  SELECT FlightFactKey,\n" + ",\n".join(
    [f"         arg_min({c}, seq) AS {c}" for c in _FIRST]
    + [f"         arg_max({c}, seq) AS {c}" for c in _LAST])
    + "\n  FROM fvalid GROUP BY FlightFactKey\n),\n"
    + "tgt AS (SELECT * FROM FactFlight)")


def _upd(c: str) -> str:
    return f"CASE WHEN c.FlightFactKey IS NOT NULL THEN c.{c} ELSE t.{c} END"


ETL_TEXTS["flight_upsert"] = with_prelude(f"""
SELECT t.FlightFactKey, t.FlightKey, t.DateKey, t.AircraftKey, t.DepartureAirportKey,
       t.ArrivalAirportKey, t.CarrierKey, t.WeatherKey, t.ActualDepartureTime, t.ActualArrivalTime,
       {_upd("DepartureDelayMin")} AS DepartureDelayMin,
       {_upd("ArrivalDelayMin")} AS ArrivalDelayMin,
       t.AirTimeMin, t.SeatsAvailable,
       {_upd("SeatsFilled")} AS SeatsFilled,
       CAST({_upd("LoadFactor")} AS DOUBLE) AS LoadFactor,
       CAST(t.Revenue AS DOUBLE) AS Revenue, CAST(t.FuelCost AS DOUBLE) AS FuelCost,
       CAST(t.CrewCost AS DOUBLE) AS CrewCost, CAST(t.AirportFees AS DOUBLE) AS AirportFees,
       t.CancellationFlag, t.WeatherImpactFlag, t.MechanicalDelayFlag, t.DistanceMiles
FROM tgt t LEFT JOIN coll c ON t.FlightFactKey = c.FlightFactKey
UNION ALL
SELECT c.FlightFactKey, c.FlightKey, c.DateKey, c.AircraftKey, c.DepartureAirportKey,
       c.ArrivalAirportKey, c.CarrierKey, NULL, NULL, NULL, c.DepartureDelayMin, c.ArrivalDelayMin,
       NULL, c.SeatsAvailable, c.SeatsFilled, CAST(c.LoadFactor AS DOUBLE),
       CAST(c.Revenue AS DOUBLE), CAST(c.FuelCost AS DOUBLE), NULL, NULL,
       c.CancellationFlag, NULL, NULL, c.DistanceMiles
FROM coll c WHERE c.FlightFactKey NOT IN (SELECT FlightFactKey FROM tgt)
""", _FLIGHT_BATCH + _COLLAPSE)


def _customer_batch(with_phone: bool) -> str:
    phone = (",\n         '+1-555-' || CAST(1000 + (c_custkey + c_nationkey) % 9000 AS VARCHAR) AS Phone"
             if with_phone else "")
    return f"""
cbatch AS (
  SELECT CAST(1 AS BIGINT) AS seq, 'CUST' || CAST(10000 + c_custkey AS VARCHAR) AS CustomerID,
         'F' || CAST(c_custkey % 50 AS VARCHAR) AS FirstName, c_name AS LastName,
         c_name || CASE WHEN c_acctbal < 0 THEN '@y.org' ELSE '@x.org' END AS Email,
         CASE WHEN c_acctbal >= 7500 THEN 'Platinum' WHEN c_acctbal >= 5000 THEN 'Gold'
              WHEN c_acctbal >= 2500 THEN 'Silver' ELSE 'Bronze' END AS LoyaltyTier,
         CAST(FLOOR(ABS(c_acctbal)) + 1 AS INTEGER) AS LoyaltyPoints{phone}
  FROM customer
)"""


def _scd2(tracked: list[str], phone_in_version: bool) -> str:
    diff = " OR ".join(f"b.{c} IS DISTINCT FROM c.{c}" for c in tracked)
    changed = f"d.IsCurrent AND d.CustomerID IN (SELECT CustomerID FROM opens)"
    phone = "o.Phone" if phone_in_version else "NULL"
    return f"""
SELECT d.CustomerKey, d.CustomerID, d.FirstName, d.LastName, d.Email, d.Phone, d.LoyaltyTier,
       d.LoyaltyPoints, d.JoinDate, d.BirthDate, d.Gender, d.Country, d.City, d.EffectiveDate,
       CASE WHEN {changed} THEN DATE '{AS_OF.isoformat()}' ELSE d.ExpirationDate END AS ExpirationDate,
       CASE WHEN {changed} THEN FALSE ELSE d.IsCurrent END AS IsCurrent
FROM DimCustomer d
UNION ALL
SELECT (SELECT COALESCE(MAX(CustomerKey), 0) FROM DimCustomer)
         + ROW_NUMBER() OVER (ORDER BY o.seq, o.CustomerID),
       o.CustomerID, o.FirstName, o.LastName, o.Email, {phone}, o.LoyaltyTier, o.LoyaltyPoints,
       NULL, NULL, NULL, NULL, NULL, DATE '{AS_OF.isoformat()}', NULL, TRUE
FROM opens o
""", f""",
opens AS (
  SELECT b.* FROM cbatch b
  LEFT JOIN (SELECT * FROM DimCustomer WHERE IsCurrent) c ON b.CustomerID = c.CustomerID
  WHERE c.CustomerID IS NULL OR {diff}
)"""


_body, _ctes = _scd2(["LoyaltyTier", "Email"], False)
ETL_TEXTS["customer_scd2"] = with_prelude(_body, _customer_batch(False) + _ctes)
_body, _ctes = _scd2(["LoyaltyTier", "Email", "Phone"], True)
ETL_TEXTS["customer_scd2_phone"] = with_prelude(_body, _customer_batch(True) + _ctes)

ETL_TEXTS["insert_if_absent"] = with_prelude("""
SELECT FlightKey, FlightNumber, CarrierKey, DepartureAirportKey, ArrivalAirportKey FROM DimFlight
UNION ALL
SELECT p_partkey, 'FL' || CAST(1000 + p_partkey AS VARCHAR), CAST(p_partkey % 5 AS INTEGER),
       CAST(p_partkey % 25 AS INTEGER), CAST((p_partkey + 1 + p_partkey % 4) % 25 AS INTEGER)
FROM part WHERE p_partkey NOT IN (SELECT FlightKey FROM DimFlight)
""")

ETL_TEXTS["extract_window"] = """
SELECT * FROM events
WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' AND ts <= TIMESTAMP '2024-01-31 00:00:00'
"""

_BOOKING_SOURCE = """
bsrc AS (
  SELECT o_orderkey AS booking_id, 'CUST' || CAST(10000 + o_custkey AS VARCHAR) AS customer_id,
         CAST(o_orderkey % 200 AS INTEGER) AS flight_id,
         CAST(CAST(o_orderdate AS DATE) + 9131 AS DATE) AS travel_date,
         CAST(o_totalprice AS DECIMAL(10,2)) AS base_fare,
         CAST(10 AS DECIMAL(8,2)) AS taxes, CAST(5 AS DECIMAL(8,2)) AS fees,
         CASE WHEN o_orderstatus = 'F' THEN 'CONFIRMED' WHEN o_orderstatus = 'O' THEN 'TICKETED'
              WHEN o_orderkey % 2 = 0 THEN 'CANCELLED' ELSE 'REFUNDED' END AS booking_status
  FROM orders
)"""

ETL_TEXTS["booking_totals"] = with_prelude("""
SELECT booking_id, customer_id, flight_id, travel_date,
       CAST(base_fare AS DOUBLE) AS base_fare, CAST(taxes AS DOUBLE) AS taxes,
       CAST(fees AS DOUBLE) AS fees, booking_status,
       CAST(CAST(base_fare + taxes + fees AS DECIMAL(10,2)) AS DOUBLE) AS TotalAmount,
       booking_status IN ('CANCELLED', 'REFUNDED') AS CancellationFlag
FROM bsrc
""", _BOOKING_SOURCE)

ETL_TEXTS["booking_key_lookup"] = with_prelude("""
SELECT b.booking_id, b.customer_id, c.CustomerKey,
       CASE WHEN c.CustomerKey IS NULL THEN 'unknown_customer_id' END AS RejectReason
FROM bsrc b LEFT JOIN DimCustomer c ON b.customer_id = c.CustomerID AND c.IsCurrent
""", _BOOKING_SOURCE)

def _lookups(source: str, columns: str, keys: list[tuple[str, str, str, str, str]]) -> str:
    """Each key (column, dimension, its business key, its key, result) by a subquery; reasons in order."""
    found = ", ".join(f"(SELECT MAX({key}) FROM {dim} d WHERE d.{name} = s.{col}) AS {out}" for col, dim, name, key, out in keys)
    reasons = ", ".join(f"CASE WHEN {col} IS NULL THEN 'missing_{col}' WHEN {out} IS NULL THEN 'unknown_{col}' END"
                        for col, _, _, _, out in keys)
    return (f"SELECT *, NULLIF(concat_ws(',', {reasons}), '') AS RejectReasons\n"
            f"FROM (SELECT {columns}, {found} FROM {source} s) t")


_CURRENT = """
airport_now AS (SELECT * FROM DimAirport WHERE IsCurrent),
aircraft_now AS (SELECT * FROM DimAircraft WHERE IsCurrent),
customer_now AS (SELECT * FROM DimCustomer WHERE IsCurrent),
mtype AS (SELECT CAST(1 + r_regionkey AS INTEGER) AS MaintenanceTypeKey, 'MT' || r_regionkey AS MaintenanceCode
          FROM region WHERE r_regionkey < 4),
flight_src AS (
  SELECT CASE WHEN l_orderkey % 50 = 0 THEN -(l_orderkey * 8 + l_linenumber) ELSE l_orderkey * 8 + l_linenumber END AS FlightFactKey,
         CASE WHEN l_orderkey % 499 <> 3 THEN 'FL' || (1000 + l_partkey) END AS flight_number,
         'A' || lpad(CAST(l_partkey % 25 AS VARCHAR), 2, '0') AS departure_airport,
         'A' || lpad(CAST((l_partkey + 1 + l_partkey % 4) % 25 AS VARCHAR), 2, '0') AS arrival_airport,
         CASE WHEN l_orderkey % 503 <> 5 THEN 'N' || (1000 + l_suppkey) END AS tail_number
  FROM lineitem
),
booking_src AS (
  SELECT o_orderkey AS booking_id, 'CUST' || (10000 + o_custkey) AS customer_id, 'FL' || (1000 + o_orderkey % 200) AS flight_number,
         'R' || (o_orderkey % 6) AS fare_code FROM orders
),
maintenance_src AS (
  SELECT event_id, 'N' || (1000 + user_id % 10) AS tail_number, 'MT' || (event_id % 5) AS maintenance_type
  FROM events WHERE event_type = 'error'
)"""

ETL_TEXTS["flight_keys"] = with_prelude(_lookups(
    "flight_src", "FlightFactKey, flight_number, departure_airport, arrival_airport, tail_number", [
        ("flight_number", "DimFlight", "FlightNumber", "FlightKey", "FlightKey"),
        ("departure_airport", "airport_now", "IATA", "AirportKey", "DepartureAirportKey"),
        ("arrival_airport", "airport_now", "IATA", "AirportKey", "ArrivalAirportKey"),
        ("tail_number", "aircraft_now", "TailNumber", "AircraftKey", "AircraftKey")]), _CURRENT)

ETL_TEXTS["booking_keys"] = with_prelude(_lookups("booking_src", "booking_id, customer_id, flight_number, fare_code", [
    ("customer_id", "customer_now", "CustomerID", "CustomerKey", "CustomerKey"),
    ("flight_number", "DimFlight", "FlightNumber", "FlightKey", "FlightKey"),
    ("fare_code", "DimFareClass", "FareCode", "FareClassKey", "FareClassKey")]), _CURRENT)

ETL_TEXTS["maintenance_keys"] = with_prelude(_lookups("maintenance_src", "event_id, tail_number, maintenance_type", [
    ("tail_number", "aircraft_now", "TailNumber", "AircraftKey", "AircraftKey"),
    ("maintenance_type", "mtype", "MaintenanceCode", "MaintenanceTypeKey", "MaintenanceTypeKey")]), _CURRENT)

ETL_TEXTS["maintenance_aircraft_version"] = with_prelude("""
SELECT m.event_id, 'N' || (1000 + user_id % 10) AS tail_number, md AS MaintenanceDate, v.AircraftKey, v.OwnershipType, v.Manufacturer
FROM maintenance_base m
LEFT JOIN versions v ON v.TailNumber = 'N' || (1000 + user_id % 10) AND v.since <= md AND (v.until IS NULL OR md < v.until)
""", """
now AS (SELECT * FROM DimAircraft WHERE IsCurrent),
moved AS (
  SELECT r.TailNumber, r.Owner, now.Manufacturer
  FROM (SELECT 'N' || (1000 + s_suppkey) AS TailNumber, CASE WHEN s_acctbal < 0 THEN 'Leased' ELSE 'Owned' END AS Owner
        FROM supplier WHERE s_suppkey % 10 <> 9) r
  LEFT JOIN now ON now.TailNumber = r.TailNumber
  WHERE now.OwnershipType IS DISTINCT FROM r.Owner
),
versions AS (
  SELECT AircraftKey, TailNumber, OwnershipType, Manufacturer, DATE '2020-01-01' AS since,
         CASE WHEN IsCurrent AND TailNumber IN (SELECT TailNumber FROM moved) THEN DATE '2024-07-01' END AS until
  FROM DimAircraft
  UNION ALL
  SELECT (SELECT MAX(AircraftKey) FROM DimAircraft) + ROW_NUMBER() OVER (ORDER BY TailNumber), TailNumber, Owner, Manufacturer,
         DATE '2024-07-01', NULL
  FROM moved
)""")

_RULES = [("FlightKey", "required"), ("DateKey", "required"), ("AircraftKey", "required"), ("DepartureAirportKey", "required"),
          ("ArrivalAirportKey", "required"), ("WeatherKey", "optional"), ("DepartureDelayMin", "default"),
          ("ArrivalDelayMin", "default"), ("CancellationFlag", "default")]
ETL_TEXTS["load_rules"] = with_prelude("\nUNION ALL\n".join(
    f"SELECT '{label}' AS TableName, '{c}' AS ColumnName, '{rule}' AS Rule, COUNT(*) - COUNT({c}) AS Nulls FROM {table}"
    for label, table in (("FlightBatch", "fbatch"), ("FactFlight", "FactFlight")) for c, rule in _RULES
    if (label, c) != ("FlightBatch", "WeatherKey")), _FLIGHT_BATCH)

ETL_TEXTS["maintenance_costs"] = """
SELECT event_id, CAST(labor AS DOUBLE) AS LaborCost, CAST(parts AS DOUBLE) AS PartsCost, n AS CostLines,
       CAST(labor + parts AS DOUBLE) AS TotalCost
FROM (SELECT event_id, NULLIF(event_id % 4, 0) AS n, CASE WHEN event_id % 4 > 0 THEN
               (event_id % 4) * CAST(value AS DECIMAL(10,2)) + (event_id % 4) * (event_id % 4 + 1) // 2 END AS labor,
             CASE event_id % 4 WHEN 1 THEN 25 WHEN 0 THEN NULL ELSE 75 END AS parts
      FROM events WHERE event_type = 'error')
"""

ETL_TEXTS["dq_duplicates"] = with_prelude("""
SELECT FlightFactKey, COUNT(*) AS Occurrences FROM fbatch
GROUP BY FlightFactKey HAVING COUNT(*) > 1
""", _FLIGHT_BATCH)

_FKS = [("FlightKey", "DimFlight", "FlightKey"), ("DateKey", "DimDate", "DateKey"),
        ("AircraftKey", "DimAircraft", "AircraftKey"),
        ("DepartureAirportKey", "DimAirport", "AirportKey"),
        ("ArrivalAirportKey", "DimAirport", "AirportKey"),
        ("CarrierKey", "DimCarrier", "CarrierKey"), ("WeatherKey", "DimWeather", "WeatherKey")]

ETL_TEXTS["dq_referential"] = with_prelude("SELECT CheckName, Failures, Failures = 0 AS Passed FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT 'orphan_{col}' AS CheckName, CAST(COUNT(*) AS BIGINT) AS Failures FROM FactFlight f "
        f"WHERE f.{col} IS NOT NULL AND f.{col} NOT IN (SELECT {key} FROM {dim} WHERE {key} IS NOT NULL)"
        for col, dim, key in _FKS) + "\n) t")

ETL_TEXTS["dq_ranges"] = with_prelude("""
SELECT CheckName, Failures, Failures = 0 AS Passed FROM (
  SELECT 'load_factor_range' AS CheckName,
         CAST(COUNT(*) FILTER (WHERE LoadFactor < 0 OR LoadFactor > 100) AS BIGINT) AS Failures
  FROM FactFlight
  UNION ALL SELECT 'negative_revenue', COUNT(*) FILTER (WHERE Revenue < 0) FROM FactFlight
  UNION ALL SELECT 'departure_delay_range',
         COUNT(*) FILTER (WHERE DepartureDelayMin < -60 OR DepartureDelayMin > 1440) FROM FactFlight
  UNION ALL SELECT 'arrival_delay_range',
         COUNT(*) FILTER (WHERE ArrivalDelayMin < -60 OR ArrivalDelayMin > 1440) FROM FactFlight
) t
""")

ETL_TEXTS["dq_dates"] = with_prelude(f"""
SELECT CheckName, Failures, Failures = 0 AS Passed FROM (
  SELECT 'date_not_in_calendar' AS CheckName,
         CAST(COUNT(*) FILTER (WHERE DateKey NOT IN (SELECT DateKey FROM DimDate)) AS BIGINT) AS Failures
  FROM FactFlight
  UNION ALL SELECT 'future_dates', COUNT(*) FROM FactFlight ff
  JOIN DimDate d ON ff.DateKey = d.DateKey WHERE d.Date > DATE '{AS_OF.isoformat()}'
  UNION ALL SELECT 'arrival_not_after_departure', COUNT(*) FROM FactFlight WHERE ActualArrivalTime <= ActualDepartureTime
) t
""")

_body, _ctes = _scd2(["LoyaltyTier", "Email"], False)
ETL_TEXTS["booking_customer_version"] = with_prelude("""
SELECT b.booking_id, b.customer_id, b.travel_date, h.CustomerKey, h.LoyaltyTier
FROM bsrc b
LEFT JOIN hist h ON b.customer_id = h.CustomerID AND h.EffectiveDate <= b.travel_date
     AND (h.ExpirationDate IS NULL OR b.travel_date < h.ExpirationDate)
""", _customer_batch(False) + _ctes + ",\nhist AS (" + _body + ")," + _BOOKING_SOURCE)

ETL_TEXTS["booking_points"] = with_prelude("""
SELECT b.booking_id, b.customer_id, l.LoyaltyPointsEarned, l.Transactions
FROM bsrc b
LEFT JOIN (SELECT l_orderkey AS booking_id,
                  CAST(SUM(CAST(FLOOR(l_quantity) AS BIGINT)) AS BIGINT) AS LoyaltyPointsEarned,
                  COUNT(*) AS Transactions
           FROM lineitem GROUP BY l_orderkey) l ON b.booking_id = l.booking_id
""", _BOOKING_SOURCE)

ETL_TEXTS["load_factor_rejects"] = with_prelude("""
SELECT FlightFactKey, FlightKey, DateKey, AircraftKey, DepartureAirportKey, ArrivalAirportKey,
       CarrierKey, DepartureDelayMin, ArrivalDelayMin, SeatsAvailable, SeatsFilled,
       CAST(Revenue AS DOUBLE) AS Revenue, CAST(FuelCost AS DOUBLE) AS FuelCost, DistanceMiles,
       CancellationFlag, CAST(LoadFactor AS DOUBLE) AS LoadFactor, OnTimeFlag
FROM fvalid WHERE LoadFactor < 0 OR LoadFactor > 100
""", _FLIGHT_BATCH)

# Last 7 days of the batch -> transform -> upsert into FactFlight -> DQ.
_E08_LO, _E08_HI = 20241224, 20241231
_E08_CTES = _FLIGHT_BATCH.replace(
    "  FROM fseq\n  WHERE FlightKey IS NOT NULL",
    f"  FROM fseq\n  WHERE DateKey BETWEEN {_E08_LO} AND {_E08_HI} AND FlightKey IS NOT NULL") + (
    ",\ncoll AS (\n  SELECT FlightFactKey,\n" + ",\n".join(
        [f"         arg_min({c}, seq) AS {c}" for c in _FIRST]
        + [f"         arg_max({c}, seq) AS {c}" for c in _LAST])
    + "\n  FROM fvalid GROUP BY FlightFactKey\n),\n"
    + """loaded AS (
  SELECT t.FlightKey, t.DateKey,
         CASE WHEN c.FlightFactKey IS NOT NULL THEN c.LoadFactor ELSE t.LoadFactor END AS LoadFactor
  FROM FactFlight t LEFT JOIN coll c ON t.FlightFactKey = c.FlightFactKey
  UNION ALL
  SELECT c.FlightKey, c.DateKey, c.LoadFactor FROM coll c
  WHERE c.FlightFactKey NOT IN (SELECT FlightFactKey FROM FactFlight)
)""")
assert "BETWEEN" in _E08_CTES

ETL_TEXTS["etl_run"] = with_prelude(f"""
SELECT CheckName, Failures, Failures = 0 AS Passed FROM (
  SELECT 'orphaned_flights' AS CheckName,
         (SELECT COUNT(*) FROM loaded l LEFT JOIN DimFlight f ON l.FlightKey = f.FlightKey
          WHERE f.FlightKey IS NULL) AS Failures
  UNION ALL SELECT 'invalid_load_factors',
         (SELECT COUNT(*) FROM loaded WHERE LoadFactor < 0 OR LoadFactor > 100)
  UNION ALL SELECT 'future_dates',
         (SELECT COUNT(*) FROM loaded l JOIN DimDate d ON l.DateKey = d.DateKey
          WHERE d.Date > DATE '{AS_OF.isoformat()}')
) t
""", _E08_CTES)

# The load as a table: as the upsert, with the week's records only.
ETL_TEXTS["etl_load"] = ETL_TEXTS["flight_upsert"].replace(
    "WHERE FlightKey IS NOT NULL AND DateKey IS NOT NULL",
    f"WHERE DateKey BETWEEN {_E08_LO} AND {_E08_HI} AND FlightKey IS NOT NULL")
assert "BETWEEN" in ETL_TEXTS["etl_load"]

ETL_TEXTS["dq_current_versions"] = with_prelude("""
SELECT CustomerID, COUNT(*) AS CurrentVersions FROM DimCustomer
WHERE IsCurrent GROUP BY CustomerID HAVING COUNT(*) > 1
""")

# The streamed upsert must give the table of the batch upsert.
ETL_TEXTS["flight_upsert_stream"] = ETL_TEXTS["flight_upsert"]

ETL_TEXTS["flight_delays"] = """
SELECT FlightFactKey,
       CAST((epoch(actual_departure) - epoch(scheduled_departure)) // 60 AS INTEGER) AS DepartureDelayMin,
       CAST((epoch(actual_arrival) - epoch(scheduled_arrival)) // 60 AS INTEGER) AS ArrivalDelayMin
FROM (
  SELECT l_orderkey * 8 + l_linenumber AS FlightFactKey, dep AS scheduled_departure,
         dep + to_minutes(q - 5) AS actual_departure,
         dep + to_minutes(30 + l_partkey % 300) AS scheduled_arrival,
         dep + to_minutes(30 + l_partkey % 300 + q * 2 - 10) AS actual_arrival
  FROM (SELECT *, CAST(FLOOR(l_quantity) AS BIGINT) AS q,
               CAST(CAST(l_shipdate AS DATE) + 9131 AS TIMESTAMP) + to_hours(l_partkey % 24) AS dep
        FROM lineitem)
)
"""

ETL_TEXTS["maintenance_derivation"] = """
SELECT event_id, 'N' || CAST(1000 + user_id % 10 AS VARCHAR) AS tail_number,
       CAST(CAST(FLOOR(value) AS DECIMAL(10,2)) AS DOUBLE) AS labor_cost,
       CAST(CAST(CAST(value AS DECIMAL(10,2)) - CAST(FLOOR(value) AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS DOUBLE)
         AS parts_cost,
       CAST(CAST(event_id % 48 AS DECIMAL(6,2)) AS DOUBLE) AS DurationHours,
       CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS TotalCost
FROM events WHERE event_type = 'error'
"""

ETL_TEXTS["flight_weather"] = with_prelude("""
SELECT f.FlightFactKey, f.departure_airport, w.WeatherKey
FROM fl f
LEFT JOIN latest l ON f.departure_airport = l.airport_code AND date_trunc('hour', f.dep) = l.h
LEFT JOIN DimWeather w ON w.WeatherCondition = l.condition
     AND w.Severity = CASE l.severity WHEN 'None' THEN 'Low' WHEN 'Moderate' THEN 'Medium'
                                      WHEN 'Severe' THEN 'High' ELSE l.severity END
""", """
obs AS (
  SELECT 'A' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS airport_code, ts AS t,
         CASE event_type WHEN 'view' THEN 'Weather 1' WHEN 'click' THEN 'Weather 2'
              WHEN 'purchase' THEN 'Weather 3' WHEN 'signup' THEN 'Weather 4'
              ELSE 'Weather 5' END AS condition,
         CASE WHEN value < 100 THEN 'None' WHEN value < 300 THEN 'Moderate' ELSE 'Severe' END AS severity
  FROM events
),
latest AS (
  SELECT airport_code, h, condition, severity FROM (
    SELECT *, date_trunc('hour', t) AS h,
           ROW_NUMBER() OVER (PARTITION BY airport_code, date_trunc('hour', t)
                              ORDER BY t DESC, condition DESC, severity DESC) AS rn
    FROM obs) WHERE rn = 1
),
fl AS (
  SELECT l_orderkey * 8 + l_linenumber AS FlightFactKey,
         'A' || lpad(CAST(l_partkey % 25 AS VARCHAR), 2, '0') AS departure_airport,
         CAST(CAST(l_shipdate AS DATE) + 9131 AS TIMESTAMP) + to_hours(l_partkey % 24) AS dep
  FROM lineitem
)""")

# The refreshed and re-read monthly summary mart equals the report itself.
from aerostar.oracle.texts import TEXTS as _REPORT_TEXTS  # noqa: E402

ETL_TEXTS["mart_refresh"] = _REPORT_TEXTS["monthly_flight_summary"]

_MARTS = {"mv_monthly_flight_summary": "monthly_flight_summary", "mv_route_performance": "route_performance",
          "mv_customer_ltv": "customer_ltv", "mv_aircraft_utilization": "aircraft_utilization_mart",
          "mv_daily_operations": "daily_operations"}
ETL_TEXTS["mart_rows"] = "\nUNION ALL\n".join(
    f"SELECT '{mart}' AS Mart, COUNT(*) AS Rows FROM ({_REPORT_TEXTS[report]}) t" for mart, report in _MARTS.items())

ETL_TEXTS["etl_audit"] = with_prelude("""
SELECT 'flight_load' AS job, n_valid AS rows_written, n_all AS rows_processed, n_new AS rows_inserted,
       n_valid - n_new AS rows_updated, n_all - n_valid AS rows_rejected,
       CAST(mark.d AS BIGINT) AS watermark_key, CAST(mark.k AS BIGINT) AS watermark_id, 'success' AS status
FROM (SELECT (SELECT COUNT(*) FROM fbatch) AS n_all, (SELECT COUNT(*) FROM fvalid) AS n_valid,
             (SELECT COUNT(DISTINCT FlightFactKey) FROM fvalid
              WHERE FlightFactKey NOT IN (SELECT FlightFactKey FROM FactFlight)) AS n_new,
             (SELECT max({'d': DateKey, 'k': FlightFactKey}) FROM fbatch) AS mark)
""", _FLIGHT_BATCH)

_ALL_FKS = [(table, key, column, dim, dim_key) for table, key, columns in (
    ("FactFlight", "FlightFactKey", _FKS),
    ("FactBooking", "BookingKey", [("FlightKey", "DimFlight", "FlightKey"), ("DateKey", "DimDate", "DateKey"),
                                   ("CustomerKey", "DimCustomer", "CustomerKey"),
                                   ("FareClassKey", "DimFareClass", "FareClassKey")]),
    ("FactCargo", "CargoKey", [("FlightKey", "DimFlight", "FlightKey"), ("DateKey", "DimDate", "DateKey"),
                               ("DepartureAirportKey", "DimAirport", "AirportKey"),
                               ("ArrivalAirportKey", "DimAirport", "AirportKey")]),
    ("FactMaintenance", "MaintenanceKey", [("AircraftKey", "DimAircraft", "AircraftKey"), ("DateKey", "DimDate", "DateKey"),
                                           ("MaintenanceTypeKey", "DimMaintenanceType", "MaintenanceTypeKey")]),
    ("DimFlight", "FlightKey", [("CarrierKey", "DimCarrier", "CarrierKey"),
                                ("DepartureAirportKey", "DimAirport", "AirportKey"),
                                ("ArrivalAirportKey", "DimAirport", "AirportKey")]),
) for column, dim, dim_key in columns]

ETL_TEXTS["dq_foreign_keys"] = with_prelude("SELECT CheckName, Failures, Failures = 0 AS Passed FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{table}.{column}' AS CheckName, COUNT(*) AS Failures FROM {table} f WHERE f.{column} IS NOT NULL "
    f"AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dim_key} = f.{column})" for table, _, column, dim, dim_key in _ALL_FKS) + ") t")


def _missing(table: str) -> str:
    key = next(k for t, k, *_ in _ALL_FKS if t == table)
    names = ", ".join(
        f"CASE WHEN f.{c} IS NOT NULL AND f.{c} NOT IN (SELECT {dim_key} FROM {dim} WHERE {dim_key} IS NOT NULL) THEN '{c}' END"
        for t, _, c, dim, dim_key in _ALL_FKS if t == table)
    return (f"SELECT '{table}' AS TableName, CAST(f.{key} AS BIGINT) AS RowKey, concat_ws(',', {names}) AS MissingKeys FROM {table} f")


ETL_TEXTS["dq_quarantine"] = with_prelude("SELECT * FROM (" + "\nUNION ALL\n".join(
    _missing(t) for t in dict.fromkeys(t for t, *_ in _ALL_FKS)) + ") t WHERE MissingKeys <> ''")

ETL_TEXTS["incremental_events"] = """
SELECT * FROM events
WHERE ts > (SELECT MAX(ts) FROM events WHERE ts < TIMESTAMP '2024-01-24 00:00:00')
"""

ETL_TEXTS["dq_required_defaults"] = with_prelude("""
SELECT CheckName, Failures, Failures = 0 AS Passed FROM (
  SELECT 'missing_required_keys' AS CheckName,
         CAST(COUNT(*) FILTER (WHERE FlightKey IS NULL OR DateKey IS NULL OR AircraftKey IS NULL
                               OR DepartureAirportKey IS NULL OR ArrivalAirportKey IS NULL) AS BIGINT)
           AS Failures FROM fbatch
  UNION ALL SELECT 'defaulted_DepartureDelayMin', COUNT(*) FILTER (WHERE DepartureDelayMin IS NULL) FROM fbatch
  UNION ALL SELECT 'defaulted_ArrivalDelayMin', COUNT(*) FILTER (WHERE ArrivalDelayMin IS NULL) FROM fbatch
  UNION ALL SELECT 'defaulted_CancellationFlag', COUNT(*) FILTER (WHERE CancellationFlag IS NULL) FROM fbatch
) t
""", _FLIGHT_BATCH)

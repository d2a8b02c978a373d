"""Registration of every warehouse job (name -> function of the warehouse).

The order follows SURVEY §2: analytics reports, marts, dashboard views,
app / notebook / README / script reports, data-quality checks.  Jobs run with
their default parameters (``as_of = 2024-12-31``, ``year = 2024``,
``mode = "reference"``).
"""

from __future__ import annotations

from aerostar.operators import integrity as I
from aerostar.operators import quality as Q
from aerostar.plans import analytics as A
from aerostar.plans import dashboard as V
from aerostar.plans import marts as M
from aerostar.plans import reports as R
from aerostar.registry import job

_REPORTS = (
    # A01-A10
    A.otp_by_route, A.rasm_by_route, A.fare_class_yield, A.weather_impact,
    A.maintenance_reliability, A.customer_loyalty, A.route_profitability_annual,
    A.delay_causes_monthly, A.cargo_performance, A.capacity_trends,
    # M01-M05
    M.monthly_flight_summary, M.route_performance, M.customer_ltv,
    M.aircraft_utilization_mart, M.daily_operations,
    # V01-V12
    V.daily_otp, V.delay_causes, V.aircraft_utilization, V.monthly_revenue, V.route_matrix,
    V.fare_class_mix, V.route_profitability, V.cost_breakdown, V.maintenance_impact,
    V.loyalty_performance, V.customer_retention, V.executive_kpis,
    # D01-D14, N01, R01-R03, S01-S02
    R.current_counts, R.airport_directory, R.airports_by_region, R.fleet_directory,
    R.fleet_by_manufacturer, R.fleet_age_histogram, R.top_customers, R.tier_distribution_top,
    R.top10_customers, R.carrier_directory, R.carriers_by_alliance, R.otp_top_routes,
    R.top_routes_by_revenue, R.loyalty_tier_summary, R.fleet_summary, R.table_counts,
    R.kpi_overview,
    # Q04, P13, P14, P16
    Q.dq_report, Q.dq_referential, Q.dq_ranges, Q.dq_dates, I.dq_foreign_keys,
)

for _fn in _REPORTS:
    job(_fn.__name__)(_fn)

# Q01-Q03: the three checks of the ETL, each on its own.
job("dq_orphaned_flights")(lambda wh: Q.dq_orphans(wh.fact_flight, wh.flight, "FlightKey"))
job("dq_invalid_load_factors")(lambda wh: Q.dq_range(wh.fact_flight, "LoadFactor", 0, 100))
job("dq_future_dates")(lambda wh: Q.dq_future(wh.fact_flight, wh.date))
# SCD2 ambiguity check: customers with several current versions.
job("dq_current_versions")(lambda wh: Q.dq_current_versions(wh.customer, "CustomerID"))
# The rows that are rejected for an orphaned key.
job("dq_quarantine")(I.quarantined)

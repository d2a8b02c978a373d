"""Declared tables: which columns a source must have, of which type, and what an absent value means.

A source that lacks a required column, or holds one in a type that can't be
widened to the declared one, fails when it is opened, before any job runs on
it. Single records that break a rule don't fail: required values that are null
go to the rejects with their reasons, values with a default are filled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Rule(NamedTuple):
    """A column's declared type, whether it must be there and not null, and the value that stands for null."""
    type: str
    required: bool = False
    default: object = None


def _columns(required: str, optional: str = "") -> dict[str, Rule]:
    """Rules from ``name type, name type`` texts."""
    pairs = [(part.split(), kind) for text, kind in ((required, True), (optional, False)) for part in text.split(",") if part.strip()]
    return {name: Rule(type_, kind) for (name, type_), kind in pairs}


#: The source tables. Columns that no job reads are optional.
SOURCES: dict[str, dict[str, Rule]] = {
    "region": _columns("r_regionkey int, r_name string"),
    "nation": _columns("n_nationkey int, n_name string, n_regionkey int"),
    "customer": _columns("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    "supplier": _columns("s_suppkey bigint", "s_name string, s_nationkey int, s_acctbal double"),
    "part": _columns("p_partkey bigint", "p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    "orders": _columns("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
                       "o_orderpriority string"),
    "lineitem": _columns("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                         "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, "
                         "l_shipdate timestamp_ntz", "l_tax double"),
    "events": _columns("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double", "props string"),
}

# Fixed values of the original: required keys, documented defaults and the optional key of a flight record.
FLIGHT_RECORD: dict[str, Rule] = {
    "FlightKey": Rule("bigint", required=True),
    "DateKey": Rule("int", required=True),
    "AircraftKey": Rule("bigint", required=True),
    "DepartureAirportKey": Rule("int", required=True),
    "ArrivalAirportKey": Rule("int", required=True),
    "WeatherKey": Rule("int"),
    "DepartureDelayMin": Rule("int", default=0),
    "ArrivalDelayMin": Rule("int", default=0),
    "CancellationFlag": Rule("boolean", default=False),
}

#: What a stored type may be read as without losing a value.
WIDER = {"tinyint": {"smallint", "int", "bigint"}, "smallint": {"int", "bigint"}, "int": {"bigint", "double"}, "float": {"double"},
         "date": {"timestamp", "timestamp_ntz"}, "timestamp": {"timestamp_ntz"}, "timestamp_ntz": {"timestamp"}}


def conform(df: DataFrame, table: str, rules: dict[str, Rule]) -> DataFrame:
    """``df`` in the declared types; every fault of its schema in one ValueError.

    A missing optional column is added with its default; columns that aren't
    declared stay. A source that is as declared is returned as it is, so its
    plan has no casts and filters reach the scan.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    faults, cols = [], []
    for name, rule in rules.items():
        kind = have.get(name)
        if kind is None and rule.required:
            faults.append(f"{name} is missing")
        elif kind is None:
            cols.append(F.lit(rule.default).cast(rule.type).alias(name))
        elif kind != rule.type and rule.type not in WIDER.get(kind, ()):
            faults.append(f"{name} is {kind} instead of {rule.type}")
        else:
            cols.append(F.col(name) if kind == rule.type else F.col(name).cast(rule.type).alias(name))
    if faults:
        raise ValueError(f"{table}: " + "; ".join(faults))
    if all(have.get(name) == rule.type for name, rule in rules.items()):
        return df
    return df.select(*cols, *[F.col(c) for c in df.columns if c not in rules])


def fill_defaults(df: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """Nulls of the columns that have a default replaced by it."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(r.default)) for c, r in rules.items()
                           if r.default is not None and c in df.columns})


def missing_values(rules: dict[str, Rule], also: list[Column] = ()) -> Column:
    """The required columns that are null, and the other reasons given, as an array; null if there are none."""
    reasons = [F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c, r in rules.items() if r.required]
    found = F.array_compact(F.array(*also, *reasons))
    return F.when(F.size(found) > 0, found)


def split_rows(df: DataFrame, rules: dict[str, Rule], also: list[Column] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows with defaults filled, rejects with RejectReasons); each row is in one of the two."""
    marked = df.withColumn("RejectReasons", missing_values(rules, also))
    return (fill_defaults(marked.filter("RejectReasons IS NULL").drop("RejectReasons"), rules),
            marked.filter("RejectReasons IS NOT NULL"))


def read_csv(spark: SparkSession, path: str, rules: dict[str, Rule]) -> tuple[DataFrame, DataFrame]:
    """A CSV source with a header: (rows, rejects). A header that differs from the declared columns fails the read.

    A line with a value of the wrong type, or with too many or too few
    values, is rejected as ``malformed`` with the line in BadLine. All
    columns are parsed whatever is selected, so a line is judged alike in
    every job.
    """
    schema = T.StructType.fromDDL(", ".join(f"{c} {r.type}" for c, r in rules.items())).add("BadLine", T.StringType())
    raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "BadLine").option("columnPruning", False).csv(path))
    rows, rejects = split_rows(raw, rules, [F.when(F.col("BadLine").isNotNull(), F.lit("malformed"))])
    return rows.drop("BadLine"), rejects


def rule_counts(df: DataFrame, table: str, rules: dict[str, Rule]) -> DataFrame:
    """TableName, ColumnName, Rule (required, default or optional), Nulls: one row a rule, counted in one pass."""
    rules = {c: r for c, r in rules.items() if c in df.columns}
    kind = {c: "required" if r.required else "optional" if r.default is None else "default" for c, r in rules.items()}
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in rules])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("TableName"), F.lit(c).alias("ColumnName"), F.lit(kind[c]).alias("Rule"), F.col(c).alias("Nulls"))
        for c in rules])))

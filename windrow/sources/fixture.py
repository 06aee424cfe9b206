"""Flight records derived from the TPC-H-like test tables (FIXTURES.md, section 2).

One row per line item; every join follows a foreign key, so none fans out. No side is
hinted: Spark broadcasts a table only below ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise sorts and merges, with skewed keys split at run time.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions import columns as fn
from windrow.schemas import CARRIER, FLIGHTS, SEED
from windrow.session import scratch_path
from windrow.sources import snapshots
from windrow.sources.ingest import with_ingest_metadata

#: Ingestion time of the fixture: fixed, so that results can be compared.
INGESTED_AT = datetime(2024, 1, 1)


#: Columns of the test tables that the fixture reads. Declared, so that planning a scan
#: does not start a job to infer them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_brand string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_shipdate timestamp_ntz"
    ),
}

#: Columns of the fixture's bronze table.
BRONZE = T.StructType(
    [
        *FLIGHTS.fields,
        T.StructField("FL_DATE", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("source_layer", T.StringType()),
    ]
)

_bronze_tables: dict[tuple[str, str], str] = {}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


def flights(spark: SparkSession, sf_dir: str, with_date: bool = False) -> DataFrame:
    """Raw flight records; ``with_date`` adds the ``FL_DATE`` text column."""
    nation = load(spark, sf_dir, "nation")
    regions = (
        load(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "r_name")
    )
    orders = (
        load(spark, sf_dir, "orders")
        .join(regions, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "r_name")
    )
    suppliers = (
        load(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "n_name")
    )
    items = (
        load(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line, ship = F.col("l_linenumber"), F.to_date("l_shipdate")
    cancelled, diverted = part % 40 == 0, part % 97 == 1
    miles = F.lit(30) + (supplier * 37 + part * 13) % 5100
    base_delay = F.col("l_quantity") - 15 + (
        F.when(order % 50 == 0, 500)
        .when(order % 50 == 1, -150)
        .when(order % 5 == 2, 60)
        .otherwise(0)
    )
    key = F.concat_ws(
        "|",
        F.lit(str(SEED)),
        *[c.cast("string") for c in (order, part, supplier, line, ship)],
    )
    columns = {
        "flight_id": F.md5(key),
        "Year": F.year(ship) + 23,
        "Month": F.month(ship),
        "DayofMonth": F.day(ship),
        "DayOfWeek": fn.iso_weekday(ship),
        CARRIER: F.concat(F.lit(" "), F.lower("p_brand"), F.lit(" ")),
        "Origin": F.concat(F.lower("n_name"), F.lit(" ")),
        "Dest": F.concat(F.lit(" "), F.lower("r_name")),
        "CRSDepTime": (order * 7 + line * 5) % 24 * 100 + part % 60,
        "CRSArrTime": (order * 7 + line * 6) % 24 * 100 + supplier % 60,
        "DepDelay": F.when(~cancelled, base_delay),
        "ArrDelay": F.when(~(cancelled | diverted), base_delay + (line - 5) * 3),
        "Cancelled": cancelled.cast("int").cast("double"),
        "Diverted": diverted.cast("int").cast("double"),
        "Distance": miles.cast("double"),
        "AirTime": F.when(
            ~(cancelled | diverted),
            F.when(part % 89 == 3, 0.0).otherwise(
                F.floor((miles * 60).cast("double") / (order % 100 * 10 + 85)).cast("double")
            ),
        ),
    }
    if with_date:
        columns["FL_DATE"] = ship.cast("string")
    return items.select(*[c.alias(name) for name, c in columns.items()])


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture as the bronze table the layers above start from.

    The joins run once per session: the records are ingested by year into a snapshot table in
    the shared folder, and every query scans that table with its own filters and columns.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    table = _bronze_tables.get(key)
    if table is None or not snapshots.commits(spark, table):
        table = scratch_path(spark, "bronze")
        rows = with_ingest_metadata(flights(spark, sf_dir, with_date=True), INGESTED_AT)
        # Not dealt out again by year: every task writes its years' rows where they are.
        snapshots.commit(rows, table, ["Year"], "replace", INGESTED_AT, layout=False)
        _bronze_tables[key] = table
    return snapshots.read(spark, table, schema=BRONZE).drop(*snapshots.VERSION_COLUMNS)

"""File sources and sinks over the test tables."""

from pyspark.sql import functions as F

from cohortflow.plans.catalog.registry import query
from cohortflow.plans.stand_ins import read
from cohortflow.sources.artifacts import copy_artifacts, write_csv, write_table
from cohortflow.sources.inference import DATE, DECIMAL, INTEGER, TIMESTAMP, type_report
from cohortflow.sources.scratch import scratch_path
from cohortflow.sources.tables import ingest_folder, list_files, read_csv_inferred, read_csv_text, read_csv_typed, table_inventory

CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
ALL_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def _exported(spark, sf_dir, table):
    path = f"{scratch_path(spark, 'landing')}/{table.upper()}.csv"
    write_csv(read(spark, sf_dir, table), path)
    return path


@query("csv_scan_typed", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan_typed(spark, sf_dir):
    return read_csv_typed(spark, _exported(spark, sf_dir, "customer"), CUSTOMER)


@query(
    "csv_scan_text",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size, "
    "CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part",
)
def csv_scan_text(spark, sf_dir):
    return read_csv_text(spark, _exported(spark, sf_dir, "part"))


@query(
    "csv_roundtrip",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def csv_roundtrip(spark, sf_dir):
    columns = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}
    return read_csv_typed(spark, _exported(spark, sf_dir, "orders"), columns).select(*columns)


@query(
    "list_files",
    " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES),
)
def list_table_files(spark, sf_dir):
    """Rows of every table that the listing of the folder finds."""
    listed = list_files(spark, sf_dir, "*.parquet", recursive=True)
    table = F.regexp_extract("path", r"/([^/]+)\.parquet(?:/[^/]*)?$", 1)
    names = sorted(r[0] for r in listed.select(table).distinct().collect())
    return table_inventory(spark, sf_dir, names)


@query(
    "publish_files",
    "SELECT 'published' AS step, count(*) AS customers, round(sum(c_acctbal), 2) AS balance, true AS all_copied FROM customer",
)
def publish_files(spark, sf_dir):
    """A stored table is copied to another folder by file ending, and read there."""
    source, target = scratch_path(spark, "artifacts"), scratch_path(spark, "published")
    write_table(read(spark, sf_dir, "customer"), f"{source}/customer")
    copied = copy_artifacts(spark, source, target, (".parquet",)).agg(F.bool_and("copied")).first()[0]
    return spark.read.parquet(f"{target}/customer").agg(
        F.lit("published").alias("step"), F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"), F.lit(copied).alias("all_copied")
    )


_PLAIN = {
    "region": {"r_regionkey": "int"}, "nation": {"n_nationkey": "int"}, "customer": CUSTOMER, "supplier": {"s_suppkey": "bigint"},
    "part": {"p_partkey": "bigint"}, "orders": {"o_orderkey": "bigint"}, "lineitem": {"l_orderkey": "bigint"}, "labels": {"doc_id": "bigint"},
}


@query(
    "ingest_all_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST(sum({next(iter(c))}) AS BIGINT) AS key_sum FROM {t}" for t, c in _PLAIN.items()),
)
def ingest_all_tables(spark, sf_dir):
    """Every table without nested columns or line breaks, landed as CSV and rewritten as Parquet."""
    landing = scratch_path(spark, "landing")
    for t in _PLAIN:
        write_csv(read(spark, sf_dir, t), f"{landing}/{t.upper()}.csv")
    written = ingest_folder(spark, landing, scratch_path(spark, "tables"), _PLAIN)
    out = None
    for t, path in written.items():
        key = next(iter(_PLAIN[t]))
        part = spark.read.parquet(path).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.sum(key).cast("long").alias("key_sum"))
        out = part if out is None else out.unionByName(part)
    return out


@query("ingest_to_parquet", "SELECT c_nationkey, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1")
def ingest_to_parquet(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    write_csv(read(spark, sf_dir, "customer"), f"{landing}/CUSTOMER.csv")
    written = ingest_folder(spark, landing, scratch_path(spark, "tables"), {"customer": CUSTOMER})
    return (
        spark.read.parquet(written["customer"]).groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    )


_INFERRED = {
    "customer": list(CUSTOMER), "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
}


def _inferred_sql():
    """The type of a column by how many of its cells parse as each."""

    def one(table, c):
        x = f"trim(CAST({c} AS VARCHAR))"
        ways = [("boolean", f"lower({x}) IN ('true', 'false')"), ("bigint", f"regexp_matches({x}, '{INTEGER}')"), ("double", f"regexp_matches({x}, '{DECIMAL}')"),
                ("date", f"regexp_matches({x}, '{DATE}')"), ("timestamp", f"regexp_matches({x}, '{TIMESTAMP}')")]
        kind = " ".join(f"WHEN count(*) FILTER (WHERE {test}) = count({c}) THEN '{k}'" for k, test in ways)
        return f"SELECT '{table}' AS table_name, '{c}' AS column_name, CASE {kind} ELSE 'string' END AS type, count({c}) AS cells FROM {table}"

    return " UNION ALL ".join(one(t, c) for t, columns in _INFERRED.items() for c in columns)


@query("csv_inferred_types", _inferred_sql())
def csv_inferred_types(spark, sf_dir):
    """Types of exported tables as their cells have them."""
    out = None
    for t, columns in _INFERRED.items():
        found = type_report(read_csv_text(spark, _exported(spark, sf_dir, t)), columns).select(F.lit(t).alias("table_name"), "column_name", "type", "cells")
        out = found if out is None else out.unionByName(found)
    return out


@query("csv_scan_inferred", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan_inferred(spark, sf_dir):
    """Nothing but the key is declared; the other columns come out typed."""
    return read_csv_inferred(spark, _exported(spark, sf_dir, "customer"), {"c_custkey": "bigint"}).select(*CUSTOMER)

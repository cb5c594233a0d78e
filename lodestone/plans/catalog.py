"""Registry of the engine's queries and of the DuckDB SQL that each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Enter a query under a name, with the SQL that gives the same rows."""

    def enter(f: Query) -> Query:
        _QUERIES[name] = f
        if sql:
            _ORACLE[name] = sql
        return f

    return enter


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register(
    "star_join_by_category",
    """SELECT r_name, n_name, c_mktsegment, count(*) AS n_lines, sum(cast(floor(l_extendedprice * 100 + 0.5) AS bigint))::bigint AS cents
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE') GROUP BY ALL""",
)
def star_join_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders, customers = (t(spark, sf_dir, x) for x in ("lineitem", "orders", "customer"))
    nations = t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region").filter(F.col("r_name").isin("ASIA", "EUROPE")), F.col("n_regionkey") == F.col("r_regionkey"))
    kept = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", "n_name", "r_name")
    joined = lines.select("l_orderkey", "l_extendedprice").join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(kept, F.col("o_custkey") == F.col("c_custkey"))
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("long")
    return joined.groupBy("r_name", "n_name", "c_mktsegment").agg(F.count("*").alias("n_lines"), F.sum(cents).alias("cents"))


def queries() -> dict[str, Query]:
    from lodestone.plans import jobs, market, relational, resolution  # noqa: F401  they register their queries

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_ORACLE)

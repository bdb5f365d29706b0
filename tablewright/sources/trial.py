"""The given tables, and views over them that stand in for library, shop, fleet and ledger tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

AS_OF = "2001-06-01"

class Trial:
    """Lazily read tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        # footers are sampled once per table and object
        self._schemas: dict[str, StructType] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        path = self.path(name)
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    @cached_property
    def dated_orders(self) -> DataFrame:
        """orders with the order date as a DATE."""
        return self.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))

    @cached_property
    def loans(self) -> DataFrame:
        """One row per line item: person, book, author, start, finish, active flag."""
        lines = self.table("lineitem").select(
            "l_orderkey", "l_linenumber",
            F.col("l_partkey").alias("book"),
            F.col("l_suppkey").alias("author"),
            F.col("l_shipdate").cast("date").alias("finish"),
            (F.col("l_linestatus") == "O").alias("active"),
        )
        heads = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_custkey").alias("person"),
            F.col("o_orderdate").cast("date").alias("start"),
        )
        return lines.join(heads, "l_orderkey").select(
            "l_orderkey", "l_linenumber", "person", "book", "author", "start", "finish", "active"
        )

    @cached_property
    def books(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("b_id"),
            F.col("p_name").alias("b_name"),
            F.col("p_size").alias("b_quantity"),
        )

    @cached_property
    def authors(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("a_id"), F.col("s_name").alias("a_name")
        )

    @cached_property
    def genres(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("g_id"), F.col("n_name").alias("g_name")
        )

    @cached_property
    def book_authors(self) -> DataFrame:
        """Distinct (b_id, a_id): line items repeat these pairs.

        Both keys are known in a link table; saying so keeps later joins from adding their own filters,
        and two uses in one query share one shuffle.
        """
        return (
            self.table("lineitem")
            .select(F.col("l_partkey").alias("b_id"), F.col("l_suppkey").alias("a_id"))
            .filter(F.col("b_id").isNotNull() & F.col("a_id").isNotNull())
            .distinct()
        )

    @cached_property
    def book_genres(self) -> DataFrame:
        """Distinct (b_id, g_id), the genre of a book being the nation of one of its suppliers."""
        home = self.table("supplier").select(
            F.col("s_suppkey").alias("a_id"), F.col("s_nationkey").alias("g_id")
        )
        return self.book_authors.join(home, "a_id").select("b_id", "g_id").distinct()

    def kind(self, name: str) -> DataFrame:
        """Parts of one type, as one product sub-type table."""
        return self.table("part").filter(F.col("p_type") == name)

    @cached_property
    def makers(self) -> DataFrame:
        """Distinct (maker, model): which supplier sells which part."""
        return self.book_authors.select(F.col("a_id").alias("maker"), F.col("b_id").alias("model"))

    def ledger_rows(self, event_type: str, amount: str) -> DataFrame:
        """Money events of one type: point, day, amount."""
        return (
            self.table("events")
            .filter(F.col("event_type") == event_type)
            .select(
                F.col("user_id").alias("point"),
                F.col("ts").cast("date").alias("day"),
                F.col("value").alias(amount),
            )
        )

    @cached_property
    def enterprises(self) -> DataFrame:
        """Regions with their nations as an array of departments; employees are customers counted per nation."""
        staff = (
            self.table("customer").groupBy(F.col("c_nationkey").alias("n_nationkey"))
            .agg(F.count("*").alias("employees_count"))
        )
        departments = (
            self.table("nation").join(staff, "n_nationkey", "left")
            .select(
                F.col("n_regionkey").alias("r_regionkey"),
                F.struct(
                    (F.col("n_nationkey") + 101).cast("bigint").alias("id"),
                    F.col("n_name").alias("name"),
                    F.coalesce("employees_count", F.lit(0)).cast("bigint").alias("employees_count"),
                ).alias("department"),
            )
            .groupBy("r_regionkey")
            .agg(F.array_sort(F.collect_list("department")).alias("departments"))
        )
        return self.table("region").join(departments, "r_regionkey", "left").select(
            (F.col("r_regionkey") + 1).cast("bigint").alias("id"),
            F.col("r_name").alias("name"),
            "departments",
        )

    @cached_property
    def base_orders(self) -> DataFrame:
        """Orders before the change feed: everything but the urgent ones, which arrive as inserts."""
        return self.dated_orders.filter(F.col("o_orderpriority") != "1-URGENT")

    @cached_property
    def order_feed(self) -> DataFrame:
        """Change feed over orders: urgent ones inserted, high ones flipped and re-dated, medium ones deleted.

        A flip also passes the order to the customer with the next key, so owner changes occur.
        """
        now = self.dated_orders
        row = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        moved = F.struct(
            "o_orderkey",
            (F.col("o_custkey") + F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("o_custkey"),
            F.when(F.col("o_orderstatus") == "O", "F").otherwise("O").alias("o_orderstatus"),
            F.date_add("o_orderdate", 1).alias("o_orderdate"),
        )
        nothing = F.lit(None).cast(
            "struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:date>"
        )
        kind = F.col("o_orderpriority")
        return now.filter(kind.isin("1-URGENT", "2-HIGH", "3-MEDIUM")).select(
            F.col("o_orderkey").alias("seq"),
            F.when(kind == "1-URGENT", "insert").when(kind == "2-HIGH", "update").otherwise("delete").alias("op"),
            F.when(kind != "1-URGENT", row).otherwise(nothing).alias("old"),
            F.when(kind == "1-URGENT", row).when(kind == "2-HIGH", moved).otherwise(nothing).alias("new"),
        )

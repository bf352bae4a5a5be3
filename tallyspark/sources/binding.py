"""Canonical retail tables derived from the given star-schema parquet tables.

``sales``          the flat order-line table every report reads
                   (lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region ⋈ part).
``catalog_dirty``  a product catalogue with missing values and repeated keys.
``retail_dirty``   a transaction file with mixed spellings, mixed date layouts,
                   missing values, exact duplicate rows and a blank row.

The dirty tables are derived deterministically from keys, so every engine
that applies the same expressions sees the same rows. They grow with the
source tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.rounding import MONEY, RATE
from tallyspark.functions.text import nan_to_null
from tallyspark.sources.files import read_delimited, text_schema
from tallyspark.sources.persisted import location, persisted
from tallyspark.sources.schema import align_to
from tallyspark.sources.tables import table

# Columns that order order lines totally (l_orderkey/l_linenumber alone repeat).
LINE_ORDER = ("order_id", "product_id", "supp_id", "line_number", "ship_date", "sales")

SALES_COLUMNS = (
    "order_id order_date ship_date ship_mode customer_id customer_name segment region state city "
    "product_id product_name category sub_category sales quantity discount profit supp_id line_number"
).split()


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat order-line table, one row per lineitem.

    Join order is chosen for the case where orders, customers and parts are
    too big to broadcast: orders are enriched with their customer first
    (orders-sized work) and meet the lines on the order key while these are
    narrow; parts, then the few nations and regions bring their texts last, so
    no shuffle carries them. The largest table is then shuffled at most twice
    (by order key, by part key), never by customer key. Broadcast vs shuffle
    is left to the planner: AQE broadcasts a side only when its measured size
    is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    p = table(spark, sf_dir, "part")
    # Dates are cast before the joins: half the digits of a timestamp go through the shuffles.
    li = li.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    o = o.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    lines = li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey)
    lines = lines.join(p, F.col("l_partkey") == p.p_partkey)
    lines = lines.join(n, F.col("c_nationkey") == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    amount = F.col("l_extendedprice").cast(MONEY)
    discount = F.col("l_discount").cast(RATE)
    quantity = F.col("l_quantity").cast("int")
    profit = F.round(amount * (F.lit(1) - discount) - F.col("p_retailprice").cast(MONEY) * quantity, 2)
    return lines.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("ship_date"),
        F.col("o_orderpriority").alias("ship_mode"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("state"),
        F.concat(F.col("n_name"), F.lit("/"), F.pmod(F.col("c_custkey"), F.lit(3)).cast("string")).alias("city"),
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        amount.alias("sales"),
        quantity.alias("quantity"),
        discount.alias("discount"),
        profit.cast(MONEY).alias("profit"),
        F.col("l_suppkey").alias("supp_id"),
        F.col("l_linenumber").alias("line_number"),
    )


SALES_SOURCES = ("lineitem", "orders", "customer", "nation", "region", "part")


def sales_table(spark: SparkSession, sf_dir: str, rebuild: bool = False, with_year: bool = False) -> DataFrame:
    """``sales`` as a table written once per version of its source files.

    Reading the written table also gives reports a scan that splits by
    file, and keeps the join out of every report's plan. It stands in folders by
    year of the order date; ``with_year`` adds that column, ``order_year``.
    """
    return persisted(spark, "sales", **_sales_options(spark, sf_dir, rebuild)).select(*SALES_COLUMNS, *(["order_year"] if with_year else []))


def sales_location(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the written ``sales`` table (written first if needed)."""
    return location(spark, "sales", **_sales_options(spark, sf_dir))


def _sales_options(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> dict:
    return {
        "sources": _sources(sf_dir, SALES_SOURCES),
        "build": lambda: sales(spark, sf_dir).withColumn("order_year", F.year("order_date")),
        "rebuild": rebuild,
        "partition_by": ("order_year",),
        # The tasks of the last join write their rows: one sort by year and date serves the folders and the files' order.
        "sort_within": ("order_year", "order_date"),
        "remember": sf_dir,
    }


def dimension_table(spark: SparkSession, sf_dir: str, name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A dimension of ``sales`` written once per version of that table, for the queries that join it.

    A ``build`` that is a function of a module (not one made on the way) is remembered by its name.
    """
    path = sales_location(spark, sf_dir)
    own = getattr(build, "__qualname__", "<")
    remember = None if "<" in own else (build.__module__, own)
    return persisted(spark, f"dim-{name}", [path], lambda: build(spark.read.parquet(path).select(*SALES_COLUMNS)), remember=remember)


# Foreign keys of the given tables, child column and parent column.
FOREIGN_KEYS = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
)


def lost_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each child table that the joins of :func:`sales` drop: NULL keys and keys without a parent row."""
    out = None
    for child, key, parent, parent_key in FOREIGN_KEYS:
        per_key = tables[child].groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
        parents = tables[parent].select(F.col(parent_key).alias("_key")).distinct()
        orphans = per_key.join(parents, "_key", "left_anti")
        row = orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("lost_rows")).select(
            F.lit(child).alias("table_name"), F.lit(key).alias("key_column"), "lost_rows"
        )
        out = row if out is None else out.unionByName(row)
    return out


# ----------------------------------------------------------------- catalogue

CATALOG_TEXT_COLUMNS = ("what_customers_said", "seller_name", "videos", "variations", "seller_information")
# The key modulus that blanks each text column of the catalogue binding.
_CATALOG_TEXT_GAPS = {"what_customers_said": 6, "seller_name": 9, "videos": 5, "variations": 10, "seller_information": 8}
CATALOG_COPY_OFFSET = 1_000_000_000


def catalog_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalogue with gaps and repeated product ids (copies come later in file order)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")

    def blank_when(mod: int, value: Column) -> Column:
        return F.when(k % mod == 0, F.lit(None)).otherwise(value)

    base = p.select(
        k.alias("ordinal"),
        k.alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        nan_to_null("p_retailprice").alias("initial_price"),
        blank_when(7, F.lit(1) + F.col("p_size") % 5).alias("rating"),
        blank_when(4, ((F.col("p_size") % 10) / F.lit(100.0)).cast(RATE)).alias("discount"),
        *[blank_when(m, F.col("p_brand")).alias(name) for name, m in _CATALOG_TEXT_GAPS.items()],
    )
    copies = base.filter(F.col("product_id") % 20 == 0).select(
        (F.col("ordinal") + F.lit(CATALOG_COPY_OFFSET)).alias("ordinal"),
        "product_id",
        F.upper("title").alias("title"),
        *[c for c in base.columns if c not in ("ordinal", "product_id", "title")],
    )
    return base.unionByName(copies)


# -------------------------------------------------------------------- retail

RETAIL_COLUMNS = (
    "transaction_id customer_id customer_name age gender category region quantity unit_price "
    "purchase_amount rating payment_method purchase_date signup_date email"
).split()
RETAIL_COPY_OFFSET = 1 << 40
RETAIL_BLANK_ID = "TXN_BLANK21"


def _spelling(value: Column, k: Column) -> Column:
    """Five raw spellings of one clean value, chosen by key."""
    m = k % 5
    return (
        F.when(m == 0, F.upper(value))
        .when(m == 1, F.lower(value))
        .when(m == 2, F.concat(F.lit(" "), value, F.lit(" ")))
        .when(m == 3, F.concat(F.lower(value), F.lit("  ")))
        .otherwise(value)
    )


def retail_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction file with dirt; ``row_ordinal`` is its file order (copies after originals)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
    j = j.join(r, F.col("n_regionkey") == r.r_regionkey)
    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    d = F.col("o_orderdate").cast("date")

    def blank_when(mod: int, value: Column) -> Column:
        return F.when(k % mod == 0, F.lit(None)).otherwise(value)

    layout = k % 3
    purchase = (
        F.when(layout == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(layout == 1, F.date_format(d, "dd/MM/yyyy"))
        .otherwise(F.date_format(d, "MM-dd-yyyy"))
    )
    base = j.select(
        k.alias("row_ordinal"),
        F.concat(F.lit("TXN_"), k.cast("string")).alias("transaction_id"),
        blank_when(97, F.concat(F.lit("C"), ck.cast("string"))).alias("customer_id"),
        blank_when(89, F.col("c_name")).alias("customer_name"),
        blank_when(11, F.lit(18) + ck % 60).alias("age"),
        F.when(ck % 3 == 0, "M").when(ck % 3 == 1, "F").otherwise("Other").alias("gender"),
        blank_when(59, _spelling(F.col("c_mktsegment"), k)).alias("category"),
        blank_when(53, _spelling(F.col("r_name"), k)).alias("region"),
        (F.lit(1) + k % 5).cast("int").alias("quantity"),
        ((F.lit(100) + k % 9901) * F.lit(0.01).cast("decimal(3,2)")).cast(MONEY).alias("unit_price"),
        blank_when(41, F.col("o_totalprice").cast(MONEY)).alias("purchase_amount"),
        blank_when(13, F.lit(1) + k % 5).alias("rating"),
        blank_when(31, F.col("o_orderpriority")).alias("payment_method"),
        blank_when(12, purchase).alias("purchase_date"),
        blank_when(17, F.date_format(F.date_sub(d, 365), "yyyy-MM-dd")).alias("signup_date"),
        blank_when(19, F.concat(F.lower(F.col("c_name")), F.lit("@example.com"))).alias("email"),
    )
    copies = base.filter(F.col("row_ordinal") % 25 == 0).withColumn(
        "row_ordinal", F.col("row_ordinal") + F.lit(RETAIL_COPY_OFFSET)
    )
    blank = spark.range(1).select(
        (F.lit(2) * F.lit(RETAIL_COPY_OFFSET)).alias("row_ordinal"),
        F.lit(RETAIL_BLANK_ID).alias("transaction_id"),
        *[F.lit(None).cast(base.schema[name].dataType).alias(name) for name in RETAIL_COLUMNS[1:]],
    )
    return base.unionByName(copies).unionByName(blank)


# ------------------------------------------------------- files on shared storage

CATALOG_FILE_SCHEMA = (
    "ordinal BIGINT, product_id BIGINT, title STRING, category STRING, initial_price DOUBLE, rating INT, "
    "discount DECIMAL(4,2), what_customers_said STRING, seller_name STRING, videos STRING, variations STRING, "
    "seller_information STRING"
)
RETAIL_FILE_SCHEMA = (
    "row_ordinal BIGINT, transaction_id STRING, customer_id STRING, customer_name STRING, age BIGINT, gender STRING, "
    "category STRING, region STRING, quantity INT, unit_price DECIMAL(18,2), purchase_amount DECIMAL(18,2), "
    "rating BIGINT, payment_method STRING, purchase_date STRING, signup_date STRING, email STRING"
)


def _sources(sf_dir: str, names: tuple[str, ...]) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in names]


def _typed_file(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A CSV file read as text, missing-value words made NULL, then cast; a value that can't be cast fails the read."""
    return align_to(read_delimited(spark, path, text_schema(ddl)), ddl)


def catalog_file(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> DataFrame:
    """The catalogue as a CSV file (how the cleaning job receives it), written once per source version."""
    path = location(
        spark, "catalog-csv", _sources(sf_dir, ("part",)), lambda: catalog_dirty(spark, sf_dir),
        rebuild=rebuild, csv_schema=CATALOG_FILE_SCHEMA, remember=sf_dir,
    )
    return _typed_file(spark, path, CATALOG_FILE_SCHEMA)


RETAIL_SOURCES = ("orders", "customer", "nation", "region")


def retail_file(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> DataFrame:
    """The transaction file as CSV (how the cleaning job receives it), written once per source version."""
    return _typed_file(spark, retail_file_location(spark, sf_dir, rebuild), RETAIL_FILE_SCHEMA)


def retail_file_location(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> str:
    """Folder of the transaction CSV file (written first if needed)."""
    return location(
        spark, "retail-csv", _sources(sf_dir, RETAIL_SOURCES), lambda: retail_dirty(spark, sf_dir),
        rebuild=rebuild, csv_schema=RETAIL_FILE_SCHEMA, remember=sf_dir,
    )

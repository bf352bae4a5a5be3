"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each reads the given parquet tables through the canonical bindings of
``tallyspark.sources.binding`` and runs one library operator over the
whole tables. Output money is DOUBLE, counts BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallyspark.operators import analytics, checks, clean, hashtree, keybits, model, partials, reports
from tallyspark.plans import params as P
from tallyspark.plans import views
from tallyspark.sources import binding, files, ledger, manifest, runlog, schema, staging
from tallyspark.sources.binding import LINE_ORDER
from tallyspark.sources.shared import fresh, hadoop_fs
from tallyspark.sources.statistics import read_footers
from tallyspark.sources.tables import table
from tallyspark.streaming import copy as stream_copy

Query = Callable[[SparkSession, str], DataFrame]
FACT_ORDER = ("order_id", "product_key", "supp_id", "line_number", "ship_date", "revenue")


def _doubles(df: DataFrame) -> DataFrame:
    """Hand decimals out as DOUBLE (exact values are kept until this edge)."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name) for f in df.schema.fields]
    )


def _sales(spark: SparkSession, d: str) -> DataFrame:
    return binding.sales_table(spark, d)


def _report(fn: Callable[..., DataFrame], **kw) -> Query:
    return lambda spark, d: fn(_sales(spark, d), **kw)


def _on_sales(build: Callable[[DataFrame], DataFrame]) -> Query:
    """Build once from one ``sales`` plan, so shared subtrees reuse their exchanges."""
    return lambda spark, d: build(_sales(spark, d))


def _named(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """``build(sales, customers)`` with the customer table written once."""
    return lambda spark, d: build(_sales(spark, d), binding.dimension_table(spark, d, "customers", model.customers))


def _star_customers(s: DataFrame) -> DataFrame:
    return model.dim_customers(s, created_at=F.lit(P.LOAD_TIME).cast("timestamp_ntz"))


def _star_dims(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return (
        binding.dimension_table(spark, d, "star-customers", _star_customers),
        binding.dimension_table(spark, d, "star-products", model.dim_products),
    )


def _on_star(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """``build(sales, fact)`` over one ``sales`` plan (fact without surrogate keys)."""
    return lambda spark, d: (lambda s: build(s, model.fact_lines(s)))(_sales(spark, d))


def _hot_geographies(s: DataFrame) -> DataFrame:
    # Profit is summed per place before the geography key is looked up (one row per place joins).
    geo = model.dim_geography(s)
    per_place = model.fact_lines(s).groupBy("city", "state").agg(F.sum("net_profit").alias("net_profit"))
    return analytics.hot_geographies(model.with_geo_key(per_place, geo), geo, factor=P.HOT_FACTOR)


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder; those of earlier runs go after a day."""
    return fresh(spark, "files", name)


def _f_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Path, length and time (whole seconds) of every file of the given tables, beside what the transaction file's parts hold."""
    listed = files.file_metadata(spark, d, "*.parquet")
    path = F.regexp_replace("path", "^file:/+", "/")
    parts = _f_parts_listed(spark, d)
    retail = parts.select(F.struct(*parts.columns).alias("parts")).scalar()
    named = listed.select(path.alias("path"), "length", F.date_trunc("second", "modificationTime").cast("timestamp_ntz").alias("modificationTime"))
    return named.withColumn("_parts", retail).select(*named.columns, *[F.col(f"_parts.{c}").alias(c) for c in parts.columns])


def _f_parts_listed(spark: SparkSession, d: str) -> DataFrame:
    """The transaction file: rows in its parts, and whether the file listing names every part that has rows."""
    path = binding.retail_file_location(spark, d)
    listed = files.file_metadata(spark, path, "*.csv").filter("length > 0").select(F.element_at(F.split("path", "/"), -1).alias("part"))
    scan = files.read_delimited(spark, path, files.text_schema(binding.RETAIL_FILE_SCHEMA), normalise_nulls=False)
    read = scan.groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    both = read.join(listed.withColumn("listed", F.lit(True)), "part", "left")
    return both.agg(F.sum("rows").alias("total_rows"), F.count_if(F.col("listed").isNull()).alias("missing")).select(
        F.lit("retail").alias("file_set"), (F.col("missing") == 0).alias("every_part_listed"), "total_rows"
    )


def _order_files(spark: SparkSession, d: str, path: str, keep) -> None:
    """Orders as text files, a folder per priority; only the folders of the rows that are kept are written."""
    named = F.concat_ws(",", "o_orderkey", "o_custkey", "o_totalprice").alias("value")
    rows = table(spark, d, "orders").withColumn("kind", F.substring("o_orderpriority", 1, 1)).filter(keep)
    rows = rows.select(named, "kind").repartition("kind").sortWithinPartitions("kind", "value")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind").text(path)


def _f_copy_changes(spark: SparkSession, d: str) -> DataFrame:
    """Two copies of a file set; in between one file changes, one comes and one goes. Files and lines per status."""
    source, dest, snaps = (_scratch(spark, f"changes-{x}") for x in ("src", "dst", "snapshots"))
    kind = F.col("kind")
    _order_files(spark, d, source, kind != "5")
    manifest.copy_changes(spark, source, dest, snaps, "*.txt", contents=True)
    p, fs = hadoop_fs(spark, f"{source}/kind=1")
    fs.delete(p, True)
    _order_files(spark, d, source, (kind == "5") | ((kind == "2") & (F.col("o_orderkey") % 2 == 0)))
    rows = manifest.copy_changes(spark, source, dest, snaps, "*.txt", contents=True)
    # A file that is written again has a new name: the old one has vanished, the new one is new.
    folder = F.regexp_extract("path", "kind=([^/]*)", 1)
    return rows.groupBy(folder.alias("kind"), "status").agg(
        F.count(F.lit(1)).alias("files"), F.sum("source_lines").alias("source_lines"), F.sum("dest_lines").alias("dest_lines"), F.min("matched").alias("matched")
    )


LINE_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def _f_copy_damage(spark: SparkSession, d: str) -> DataFrame:
    """Order lines against a copy with a few damaged values: the keys of the damaged lines, found by digest trees."""
    lines = table(spark, d, "lineitem")
    hit = F.col("l_orderkey") % P.DAMAGED_EVERY == 0
    path = _scratch(spark, "damaged")
    lines.withColumn("l_quantity", F.when(hit, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))).write.parquet(path)
    return hashtree.locate(lines, spark.read.schema(lines.schema).parquet(path), list(LINE_KEYS))


def _append_once(spark: SparkSession, d: str) -> DataFrame:
    """Two batches, the first inserted twice: rows per batch."""
    path = _scratch(spark, "once")
    layout = "customer_key BIGINT NOT NULL, customer_name STRING NOT NULL, loyalty_tier STRING"
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("customer_name"))
    even = F.col("customer_key") % 2 == 0
    for rows, batch in ((c.filter(even), "even"), (c.filter(~even), "odd"), (c.filter(even), "even")):
        ledger.append_batch(rows, path, layout, batch, {"loyalty_tier": F.lit("Standard")})
    return ledger.read_table(spark, path, layout).groupBy("batch_id", "loyalty_tier").agg(F.count(F.lit(1)).alias("rows"), F.sum("customer_key").alias("key_sum"))


def _refreshed_states(spark: SparkSession, d: str) -> DataFrame:
    """Partial states of the sales table by month, refreshed after rows have come to its first month."""
    source, state, snaps = (_scratch(spark, f"states-{x}") for x in ("rows", "state", "snapshots"))
    rows = _sales(spark, d).withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
    first = rows.agg(F.min("order_month")).scalar()
    late = (F.col("order_month") == first) & (F.col("line_number") > 1)

    def put(part: DataFrame) -> None:
        part.repartitionByRange("order_month").write.mode("append").partitionBy("order_month").parquet(source)

    for part in (rows.filter(~late), rows.filter(late)):
        put(part)
        done = partials.refresh(spark, source, rows.schema, "order_month", state, snaps, partials.SALES, partials.with_losses)
    return done.state


def _distinct_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Distinct counts from merged sketches beside the exact ones: whether they agree within four standard errors."""
    state = partials.states(partials.with_losses(_sales(spark, d)).withColumn("order_month", F.date_format("order_date", "yyyy-MM")), "order_month", partials.SALES)
    exact = reports.distinct_profile(_sales(spark, d))
    names = dict(zip(partials.SALES.distinct, ("unique_customers", "unique_orders", "unique_products", "regions", "categories", "states"), strict=True))
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(out).alias("exact")) for c, out in names.items()]
    both = exact.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").join(partials.distinct_estimates(state), "column_name")
    return both.select("column_name", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= F.lit(4 * partials.SKETCH_ERROR) * F.col("exact")).alias("within_bound"))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    """Foreign keys of the given tables, and of orders with a known share of broken keys, through key bitmaps."""
    t = {name: table(spark, d, name) for name in ("customer", "orders", "lineitem")}
    k = F.col("o_orderkey")
    broken = t["orders"].withColumn("o_custkey", F.when(k % 17 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey")))
    return checks.union_checks(
        [
            keybits.orphans(t["lineitem"], t["orders"], "l_orderkey", "o_orderkey", "lineitem"),
            keybits.orphans(t["orders"], t["customer"], "o_custkey", "c_custkey", "orders"),
            keybits.orphans(broken, t["customer"], "o_custkey", "c_custkey", "orders_broken"),
        ]
    )


def _drop_any(spark: SparkSession, d: str) -> DataFrame:
    """One whole row per customer, whichever: each survivor must be a row of the file."""
    rows = clean.retail_rows(binding.retail_file(spark, d))
    survivors = clean.drop_duplicates_any(rows, ["customer_id"])
    found = survivors.withColumn("survivor", F.lit(True)).unionByName(rows.withColumn("survivor", F.lit(False)))
    per_row = found.groupBy(*rows.columns).agg(F.count_if("survivor").alias("kept"), F.count_if(~F.col("survivor")).alias("rows"))
    return per_row.filter("kept > 0").select("customer_id", F.col("kept").alias("rows_kept"), (F.col("rows") > 0).alias("is_a_row_of_the_file"))


def _f_copy_verify(spark: SparkSession, d: str) -> DataFrame:
    """Copy the transaction CSV file to a fresh folder and compare both sides."""
    source = binding.retail_file_location(spark, d)
    copied = files.copy_verified(spark, source, _scratch(spark, "copy-dst"), binding.RETAIL_FILE_SCHEMA)
    return copied.select("source_rows", "dest_rows", "matched")


def _f_copy_stream(spark: SparkSession, d: str) -> DataFrame:
    """Triggered incremental copy of the transaction CSV file (a file stream run once), then verified."""
    source = binding.retail_file_location(spark, d)
    dest, ck = _scratch(spark, "stream-dst"), _scratch(spark, "stream-ck")
    stream_copy.copy_new_files(spark, source, dest, binding.RETAIL_FILE_SCHEMA, ck)
    return stream_copy.verify_copy(spark, source, dest, binding.RETAIL_FILE_SCHEMA).select("source_rows", "dest_rows", "matched")


def _queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # ---------------------------------------------------------- reports
        "q_distinct_profile": _report(reports.distinct_profile),
        "q_date_range": lambda s, d: reports.date_range(read_footers(s, binding.sales_location(s, d))),
        "q_region_filter": _report(reports.region_filter, region=P.REGION),
        "q_category_filter": _report(reports.category_filter, category=P.CATEGORY),
        "q_year_filter": lambda s, d: reports.year_filter(binding.sales_table(s, d, with_year=True), P.YEAR),
        "q_high_value": _report(reports.high_value, min_sales=P.MIN_SALES, k=P.TOP_K, tiebreak=LINE_ORDER),
        "q_full_price_profit": _report(reports.full_price_profit),
        "q_region_summary": _report(reports.region_summary),
        "q_category_margin": _report(reports.category_margin),
        "q_segment_summary": _report(reports.segment_summary),
        "q_ship_mode": _report(reports.ship_mode_summary),
        "q_top_products": _report(reports.top_products, k=P.TOP_K),
        "q_top_subcategories": _report(reports.top_subcategories, k=P.TOP_K),
        "q_top_customers": _report(reports.top_customers, k=P.TOP_K),
        "q_top_states": _report(reports.top_states, k=P.TOP_K),
        "q_monthly_trend": _report(reports.monthly_trend),
        "q_yearly_summary": _report(reports.yearly_summary),
        "q_quarter_category": _report(reports.quarter_category),
        "q_discount_tiers": _report(reports.discount_tiers, edges=P.TIER_EDGES),
        "q_null_counts": _report(reports.null_counts),
        "q_duplicate_lines": _report(reports.duplicate_lines, k=P.DUP_K),
        "q_loss_orders": _report(reports.loss_orders),
        "q_value_ranges": _report(reports.value_ranges),
        "q_category_share": _report(reports.category_share),
        "q_tier_ordered": _report(reports.tier_ordered, edges=P.TIER_EDGES),
        "q_table_info": _on_sales(clean.column_profile),
        "q_preview": _on_sales(lambda x: clean.preview(x, LINE_ORDER, P.PREVIEW_ROWS)),
        # ------------------------------------------------------------ model
        "n_dim_customer": _on_sales(model.customers),
        "n_dim_product": _on_sales(model.products),
        "n_fact_orders": _on_sales(lambda x: _doubles(model.orders(x))),
        "n_dim_geography": _on_sales(model.dim_geography),
        "n_dim_customer_star": _on_sales(
            lambda x: model.dim_customers(x, created_at=F.lit(P.LOAD_TIME).cast("timestamp_ntz"))
        ),
        "n_dim_product_star": _on_sales(model.dim_products),
        "n_fact_sales": _on_sales(lambda x: _doubles(model.fact_sales(x, model.dim_geography(x)))),
        "n_dim_calendar": lambda s, d: model.dim_calendar(
            table(s, d, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))
        ),
        "n_integrity": _integrity,
        "n_lost_rows": lambda s, d: binding.lost_rows({t: table(s, d, t) for t in binding.SALES_SOURCES}),
        # -------------------------------------------------------- analytics
        "a_above_mean": _on_sales(analytics.above_mean),
        "a_customer_peak_line": _on_sales(analytics.customer_peak_line),
        "a_customers_above_mean": _named(analytics.customers_above_mean),
        "a_sequence_and_rank": _on_sales(lambda x: analytics.sequence_and_rank(x, LINE_ORDER)),
        "a_master_ledger": _named(analytics.master_ledger),
        "a_top5_customers": _named(lambda x, c: analytics.ranked_customers(x, c, P.RANK_K, True)),
        "a_bottom5_customers": _named(lambda x, c: analytics.ranked_customers(x, c, P.RANK_K, False)),
        "a_single_order_customers": _named(analytics.single_order_customers),
        "a_peak_cart": _named(analytics.peak_cart),
        "a_rolling3": _on_star(lambda s, f: analytics.rolling_average(f, FACT_ORDER, P.ROLLING_ROWS)),
        "a_hot_geographies": _on_sales(_hot_geographies),
        "a_yoy_monthly": _on_star(lambda s, f: analytics.yoy_monthly(f, lag=P.YOY_LAG)),
        "a_pareto80": _on_star(lambda s, f: analytics.pareto(f, limit_pct=P.PARETO_LIMIT)),
        "a_ship_latency": _on_star(lambda s, f: analytics.ship_latency(f, P.ELITE_DAYS, P.STANDARD_DAYS)),
        "a_discount_cannibal": lambda s, d: analytics.discount_cannibal(
            model.fact_lines(_sales(s, d)), _star_dims(s, d)[1], P.CANNIBAL_MIN_DISCOUNT, P.CANNIBAL_MAX_IMPACT
        ),
        "v_executive": lambda s, d: analytics.executive_view(model.fact_lines(_sales(s, d)), *_star_dims(s, d)),
        # ------------------------------------------------------------ files
        "f_metadata": _f_metadata,
        "f_copy_verify": _f_copy_verify,
        "f_copy_stream": _f_copy_stream,
        "f_parts_listed": _f_parts_listed,
        "f_copy_changes": _f_copy_changes,
        "f_copy_damage": _f_copy_damage,
        # ------------------------------- kept states, sketches, key bitmaps
        "q_region_incremental": lambda s, d: partials.region_summary(_refreshed_states(s, d)),
        "q_distinct_sketch": _distinct_sketch,
        "n_append_once": _append_once,
        "n_orphans_bitmap": _orphans,
        # -------------------------------------------------------- catalogue
        "c_catalog_clean": lambda s, d: clean.catalog_clean(binding.catalog_file(s, d), seed=P.SEED),
        "c_catalog_nulls": lambda s, d: clean.catalog_nulls(binding.catalog_file(s, d)),
        "c_catalog_dupes": lambda s, d: clean.duplicate_count(binding.catalog_file(s, d), ["product_id"]),
        # The premium view is taken after the gaps are filled, as in the source notebook.
        "c_premium": lambda s, d: clean.premium(clean.catalog_fill(binding.catalog_file(s, d)), P.PREMIUM_PRICE),
        # ----------------------------------------------------------- retail
        "r_dedupe_key": lambda s, d: clean.dedupe_on(binding.retail_file(s, d)),
        "r_dedupe_counts": lambda s, d: clean.dedupe_counts(binding.retail_file(s, d)),
        "r_west_avg": lambda s, d: clean.region_category_avg(binding.retail_file(s, d), P.CLEAN_REGION),
        "r_fill_payment": lambda s, d: clean.fill_payment(binding.retail_file(s, d)),
        "r_payment_counts": lambda s, d: clean.frequent_values(binding.retail_file(s, d), "payment_method", P.MIN_PAYMENT_COUNT),
        "r_age_gender": lambda s, d: clean.age_gender(binding.retail_file(s, d), P.AGE_LOW, P.AGE_HIGH, P.GENDER),
        "r_parse_report": lambda s, d: clean.parse_report(binding.retail_file(s, d)),
        "r_parse_multi": lambda s, d: clean.parse_multi(binding.retail_file(s, d)),
        "r_valid_contacts": lambda s, d: clean.valid_contacts(binding.retail_file(s, d)),
        "r_valid_counts": lambda s, d: clean.filter_counts(binding.retail_file(s, d), clean.has_contact()),
        "r_valid_contacts_no_blank": lambda s, d: clean.valid_contacts(binding.retail_file(s, d), include_blank=False),
        "r_price_stats": lambda s, d: clean.price_stats(binding.retail_file(s, d)),
        "r_region_revenue": lambda s, d: clean.region_revenue(binding.retail_file(s, d)),
        "r_spelling_audit": lambda s, d: clean.spelling_audit(binding.retail_file(s, d)),
        "r_null_profile": lambda s, d: clean.null_profile(binding.retail_file(s, d), binding.RETAIL_COLUMNS),
        "r_row_audit": lambda s, d: clean.row_audit(binding.retail_file(s, d)),
        "r_complete_rows": lambda s, d: clean.drop_incomplete(clean.retail_rows(binding.retail_file(s, d))),
        # ------------------------------------------------------ exploration
        "c_catalog_info": lambda s, d: clean.column_profile(binding.catalog_file(s, d).drop("ordinal")),
        "c_catalog_head": lambda s, d: clean.preview(binding.catalog_file(s, d), ["ordinal"], P.PREVIEW_ROWS),
        "c_catalog_tail": lambda s, d: clean.preview(binding.catalog_file(s, d), ["ordinal"], P.PREVIEW_ROWS, last=True),
        "c_catalog_sparse": lambda s, d: clean.drop_sparse_rows(
            binding.catalog_file(s, d).drop("ordinal"), P.MIN_NON_NULL
        ),
        "n_load_verification": _on_sales(_load_verification),
        # ------------------------------------------- options and load helpers
        "a_yoy_complete": _on_star(lambda s, f: analytics.yoy_monthly(f, lag=P.YOY_LAG, complete=True)),
        "q_tiers_null_counter": _on_sales(_tiers_null_counter),
        "q_priority_margin_mapped": _priority_margin,
        "q_priority_names": _priority_names,
        "f_latin1_read": _f_latin1_read,
        "f_null_tokens": _f_null_tokens,
        "n_insert_by_name": _insert_by_name,
        "n_run_log": _run_log,
        "n_stage_flat": _on_sales(_stage_flat),
        "v_fact_view": _fact_view,
        "r_drop_any": _drop_any,
    }
    return q


def _tiers_null_counter(s: DataFrame) -> DataFrame:
    some = s.withColumn("discount", F.when(F.col("line_number") != 1, F.col("discount")))
    return reports.discount_tiers(some, edges=P.TIER_EDGES, count_nulls=True)


def _priority_margin(spark: SparkSession, d: str) -> DataFrame:
    """A sales report over the orders table, by its own column names."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    orders = table(spark, d, "orders").select("o_orderpriority", amount.alias("total"), F.lit(0).cast("decimal(4,2)").alias("cut"))
    names = {"category": "o_orderpriority", "sales": "total", "discount": "cut"}
    return reports.category_margin(orders.withColumn("profit", F.col("total")), columns=names)


def _priority_names(spark: SparkSession, d: str) -> DataFrame:
    """Orders per priority under names from a literal table (five rows, broadcast)."""
    names = spark.createDataFrame(list(zip("12345", ("first", "second", "third", "fourth", "fifth"), strict=True)), "code string, priority_name string")
    per_code = table(spark, d, "orders").groupBy(F.substring("o_orderpriority", 1, 1).alias("code")).agg(F.count(F.lit(1)).alias("orders"))
    return per_code.join(F.broadcast(names), "code", "left").select("priority_name", "orders")


def _f_latin1_read(spark: SparkSession, d: str) -> DataFrame:
    """Customers written as a semicolon-separated Latin-1 file and read back."""
    path = _scratch(spark, "latin1")
    named = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(" (é; ö)")).alias("name"))
    files.write_delimited(named, path, sep=";", encoding="ISO-8859-1")
    return files.read_delimited(spark, path, "id BIGINT, name STRING", sep=";", encoding="ISO-8859-1")


def _f_null_tokens(spark: SparkSession, d: str) -> DataFrame:
    """NULLs per column of a catalogue file with missing-value words, read as text and then cast."""
    path = _scratch(spark, "tokens")
    cat, k = binding.catalog_dirty(spark, d), F.col("ordinal") % 15
    word = F.when(k == 0, "NA").when(k == 1, "N/A").when(k == 2, "null").when(k == 3, "").otherwise(F.col("seller_name"))
    price = F.when(F.col("ordinal") % 9 == 0, "NaN").otherwise(F.col("initial_price").cast("string"))
    told = cat.select(word.alias("seller_name"), price.alias("initial_price"), "title")
    files.write_delimited(told, path)
    text = files.read_delimited(spark, path, files.text_schema("seller_name STRING, initial_price STRING, title STRING"))
    return clean.null_profile(text.withColumn("initial_price", F.col("initial_price").cast("double")), text.columns)


def _insert_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Two inserts by name into one typed table, the first with a declared default, then read back."""
    path = _scratch(spark, "insert")
    layout = "customer_key BIGINT NOT NULL, customer_name STRING NOT NULL, market_segment STRING, loyalty_tier STRING"
    first = model.customers(_sales(spark, d)).select(F.col("customer_id").alias("customer_key"), "customer_name", F.col("segment").alias("market_segment"))
    schema.append_by_name(first, path, layout, defaults={"loyalty_tier": F.lit("Standard")})
    second = table(spark, d, "part").select(F.col("p_name").alias("customer_name"), F.col("p_partkey").alias("customer_key"), F.lit("Part").alias("loyalty_tier"))
    schema.append_by_name(second, path, layout)
    return spark.read.schema(layout).parquet(path)


def _run_log(spark: SparkSession, d: str) -> DataFrame:
    """Two logged loads; the log says what each wrote."""
    log, s = _scratch(spark, "log"), _sales(spark, d)
    runlog.logged_write(model.customers(s), _scratch(spark, "log-customers"), "load_customers", log)
    runlog.logged_write(s, _scratch(spark, "log-lines"), "load_lines", log)
    return runlog.read_log(spark, log).select("step_name", "records_processed", "status")


def _stage_flat(s: DataFrame) -> DataFrame:
    """Sales lines as raw text columns with spaced headers, staged back to typed columns."""
    us = lambda c: F.date_format(c, "MM/dd/yyyy")
    raw = s.select(
        F.col("line_number").alias("Row ID"),
        F.col("order_id").alias("Order ID"),
        us("order_date").alias("Order Date"),
        us("ship_date").alias("Ship-Date"),
        *[F.col(c).cast("double").alias(c.title()) for c in ("sales", "discount", "profit")],
        F.col("quantity").alias("Quantity"),
    )
    staged = staging.stage_flat_sales(raw)
    return staged.select("order_id", "order_date", "ship_date", "sales", "quantity", "discount", "profit", F.col("row_id").cast("int").alias("row_id"))


def _fact_view(spark: SparkSession, d: str) -> DataFrame:
    """SQL over the registered fact view."""
    views.register_views(spark, d, only=("fact_sales",))
    return spark.sql("SELECT ship_mode, count(*) AS lines, sum(txn_id) AS txn_sum FROM fact_sales GROUP BY ship_mode")


def _loaded(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder and read back: what a load left there."""
    path = _scratch(spark, f"load-{name}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def _load_verification(s: DataFrame) -> DataFrame:
    spark = s.sparkSession
    geo = model.dim_geography(s)
    customer_ids = s.select("customer_id").distinct()
    # The last load loses rows on purpose, so the report has a mismatch to show.
    partial = model.customers(s).filter(F.col("customer_id") % P.LOST_EVERY != 0)
    return checks.load_verification(
        [
            ("customers", customer_ids, _loaded(spark, model.customers(s), "customers")),
            ("products", s.select("product_id").distinct(), _loaded(spark, model.products(s), "products")),
            ("dim_geography", s.select("city", "state").distinct(), _loaded(spark, geo, "geography")),
            ("fact_sales", s, _loaded(spark, model.fact_sales_unkeyed(s, geo), "fact")),
            ("customers_partial", customer_ids, _loaded(spark, partial, "partial")),
        ]
    )


def _integrity(spark: SparkSession, d: str) -> DataFrame:
    """Declared rules on the given tables, and on a copy with known violations."""
    t = {name: table(spark, d, name) for name in ("customer", "part", "orders", "lineitem")}
    k = F.col("o_orderkey")
    dirty = {
        **t,
        "customer": t["customer"].unionByName(t["customer"].filter(F.col("c_custkey") % 11 == 0)),
        "part": t["part"].withColumn("p_name", F.when(F.col("p_partkey") % 13 != 0, F.col("p_name"))),
        "orders": t["orders"]
        .withColumn("o_custkey", F.when(k % 17 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey")))
        .withColumn("o_orderdate", F.when(k % 19 != 0, F.col("o_orderdate"))),
        "lineitem": t["lineitem"]
        .withColumn("l_quantity", F.when(F.col("l_orderkey") % 23 == 0, F.lit(0.0)).otherwise(F.col("l_quantity")))
        .withColumn("l_discount", F.when(F.col("l_orderkey") % 29 == 0, F.lit(1.5)).otherwise(F.col("l_discount")))
        .withColumn("l_extendedprice", F.when(F.col("l_orderkey") % 31 == 0, F.lit(-1.0)).otherwise(F.col("l_extendedprice"))),
    }
    parts = [checks.given_table_checks(**x).withColumn("binding", F.lit(name)) for name, x in (("given", t), ("dirty", dirty))]
    return checks.union_checks(parts)


def _money_as_double(q: Query) -> Query:
    return lambda spark, d: _doubles(q(spark, d))


QUERIES: dict[str, Query] = {name: _money_as_double(q) for name, q in _queries().items()}

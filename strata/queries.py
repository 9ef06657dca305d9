"""Registered queries: plan key -> callable(spark, sf_dir) -> DataFrame.

Every query starts from the driver's star-schema Parquet tables, turns them
into retail source rows with the fixture adapters, and runs one operator of
the lakehouse over the whole of them. Keys follow SURVEY §2. Queries that
write (landing, archive, silver merges, audit) do so below a fresh folder
of the shared ``spark.checkpoint.dir`` and return a read of what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata import storage
from strata.conf import (
    AS_OF, DAY1, DAY2, DAY3, INGEST_CLOCK_1, INGEST_CLOCK_2, T1, T2, T3, control_dicts,
)
from strata.fixtures.retail import (
    bronze_tables, load_star, next_batch, source_tables, to_bronze,
)
from strata.operators.distinct import distinct_counts, distinct_state, merged
from strata.operators.quality import distinct_flagged, quarantine
from strata.plans import gold
from strata.plans.pipeline import Layout, run_ingest
from strata.plans.restart import RestartableDay
from strata.plans.silver import SilverStore, first_load, silver_tables
from strata.plans.snapshots import merge_snapshots
from strata.schemas import BRONZE, JSON_TABLES, PIPELINE_LOG, REFRESH_TABLES, SCD2_TABLES, silver_schema
from strata.session import work_dir
from strata.sinks.audit import PipelineLog, append_audit, read_audit
from strata.sinks.catalog import SchemaMismatch, create_database, create_if_absent, ctas_if_absent, insert, \
    publish_silver
from strata.sinks.landing import archive_landing, land_json, land_reviews, landing_file, read_archive, \
    read_archived_lines, reviews_file
from strata.sources.balanced import equal_depth_predicates
from strata.sources.bronze import BAD_LINE, read_bronze, read_rejects, write_rejects
from strata.sources.ingest import FrameSource, extract, latest_watermark, watermarks
from strata.sources.reviews import ingest_reviews
from strata.storage import shuffles_dropped

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Lazily planned inputs of one query run (nothing is computed here)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.star = load_star(spark, sf_dir)
        self.source = source_tables(self.star)
        self.bronze = bronze_tables(self.star)

    @property
    def silver(self) -> dict[str, DataFrame]:
        return silver_tables(self.bronze, T1)


# --- gold ---------------------------------------------------------------------

def _mart(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = Inputs(spark, sf_dir).silver
        if name == "customer_engagement":
            return gold.customer_engagement(silver, AS_OF)
        return gold.MARTS[name](silver)
    return run


def days_since_order(spark, sf_dir):
    return gold.days_since_order(Inputs(spark, sf_dir).bronze["orders"], AS_OF)


def join_inner_chain(spark, sf_dir):
    return gold.join_inner_chain(Inputs(spark, sf_dir).silver)


def join_left_chain(spark, sf_dir):
    return gold.join_left_chain(Inputs(spark, sf_dir).silver)


# --- landing and bronze ----------------------------------------------------------

def _bronze(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inp = Inputs(spark, sf_dir)
        root = work_dir(spark, f"bronze_{table}")
        if table in JSON_TABLES:
            land_json(inp.source[table], root, table, DAY1)
        else:
            # Two daily snapshots: the bronze glob reads both.
            rec = inp.source[table]
            land_reviews(rec, root, DAY1)
            land_reviews(next_batch(to_bronze(rec, table), table), root, DAY2)
        return read_bronze(spark, root, table)
    return run


def land_json_query(spark, sf_dir):
    """Landed JSON read back with its own types: timestamps are epoch millis."""
    inp = Inputs(spark, sf_dir)
    root = work_dir(spark, "land_json")
    land_json(inp.source["order_items"], root, "order_items", DAY1)
    schema = StructType([StructField(f.name, LongType()) if f.name == "updated_at" else f
                         for f in BRONZE["order_items"].fields])
    return spark.read.schema(schema).json(f"{root}/order_items/*.json")


def land_reviews_query(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    root = work_dir(spark, "land_reviews")
    land_reviews(inp.source["customer_reviews"], root, DAY1)
    return spark.read.parquet(reviews_file(root, DAY1))


def ingest_reviews_query(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    root = work_dir(spark, "ingest_reviews")
    feed = f"{root}/feed/reviews_{DAY1:%Y%m%d}"
    inp.source["customer_reviews"].write.mode("overwrite").json(feed)
    ingest_reviews(spark, feed, f"{root}/landing", DAY1)
    return read_bronze(spark, f"{root}/landing", "customer_reviews")


def archive_landing_query(spark, sf_dir):
    """Land orders on two days, archiving earlier files before each landing."""
    inp = Inputs(spark, sf_dir)
    root = work_dir(spark, "archive")
    landing, archive = f"{root}/landing", f"{root}/archive"
    schema = BRONZE["orders"]
    archive_landing(spark, landing, archive, "orders")
    land_json(inp.source["orders"], landing, "orders", DAY1)
    archive_landing(spark, landing, archive, "orders")
    land_json(next_batch(inp.bronze["orders"], "orders"), landing, "orders", DAY2)
    archive_landing(spark, landing, archive, "orders")
    return read_archive(spark, archive, "orders", schema)


def _order_lines(orders: DataFrame, broken: str) -> DataFrame:
    """Orders as JSON lines with a column the schema lacks; lines of orders
    that ``broken`` holds for stop before their end."""
    line = "'{\"order_id\":' || order_id || ',\"customer_id\":' || coalesce(cast(customer_id as string), 'null') || " \
        "',\"note\":\"n' || order_id || '\"}'"
    return orders.where("order_id IS NOT NULL").select(F.expr(
        f"CASE WHEN {broken} THEN left({line}, 15) ELSE {line} END").alias("value"))


def archive_lines(spark, sf_dir):
    """Lines archived byte for byte: two landings of one day, with a column
    beyond the schema and with broken lines."""
    orders = Inputs(spark, sf_dir).bronze["orders"]
    root = work_dir(spark, "archive_lines")
    landing, archive = f"{root}/landing", f"{root}/archive"
    for half in (0, 1):
        lines = _order_lines(orders.where(F.col("order_id") % 2 == half), "order_id % 10 = 3")
        lines.write.text(landing_file(landing, "orders", DAY1))
        archive_landing(spark, landing, archive, "orders")
    return read_archived_lines(spark, archive, "orders").withColumnRenamed("value", "line")


def bronze_rejects(spark, sf_dir):
    """Broken lines of a landing, kept as they are beside a typed landing of
    the same table: cut off, of a wrong type, and no JSON at all."""
    inp = Inputs(spark, sf_dir)
    root = work_dir(spark, "bronze_rejects")
    land_json(inp.source["orders"], root, "orders", DAY1)
    orders = inp.bronze["orders"].where("order_id IS NOT NULL")
    bad = F.expr("CASE order_id % 3 WHEN 0 THEN '{\"order_id\":' || order_id "
                 "WHEN 1 THEN '{\"order_id\":\"no ' || order_id || '\"}' ELSE 'order ' || order_id || ' was lost' END")
    _order_lines(orders, "order_id % 10 = 3").unionByName(orders.where("order_id % 10 = 4").select(bad.alias("value"))) \
        .write.text(landing_file(root, "orders", DAY2))
    write_rejects(read_rejects(spark, root, "orders"), f"{root}/rejects", "orders", "1")
    return spark.read.schema(BAD_LINE).parquet(f"{root}/rejects/orders/batch=1")


def restartable_day(spark, sf_dir):
    """Silver orders after two days of which the first is stopped three times:
    after its landing, after a merge was committed, and after its checkpoint."""
    inp = Inputs(spark, sf_dir)
    layout = Layout(work_dir(spark, "restartable"))
    control = [r for r in control_dicts() if r["tablename"] in ("orders", "products")]
    stops = ["land orders", "commit orders", "merge orders"]

    def step(name):
        if stops and name == stops[0]:
            stops.pop(0)
            raise InterruptedError(name)

    day = RestartableDay(spark, layout, FrameSource(inp.source), control, step)
    for date, clock in ((DAY1, INGEST_CLOCK_1), (DAY2, INGEST_CLOCK_2)):
        while True:
            left = len(stops)
            try:
                store = day.ingest(date, clock)
                break
            except Exception:
                if len(stops) == left:  # not one of the planned stops
                    raise
    return store.read("orders")


# --- ingest -----------------------------------------------------------------------

def ingest_full_load(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    df = extract(FrameSource(inp.source), "products", "Full Load", None, None)
    return to_bronze(df, "products")


def ingest_incremental(spark, sf_dir):
    """Orders changed after the last audited load of ``orders``."""
    inp = Inputs(spark, sf_dir)
    root = work_dir(spark, "ingest_incremental")
    layout = Layout(root)
    ctl = [r for r in control_dicts() if r["tablename"] == "orders"]
    run_ingest(spark, layout, FrameSource(inp.source), ctl, DAY1, INGEST_CLOCK_1,
               PipelineLog(clock=lambda: INGEST_CLOCK_1))
    wm = latest_watermark(read_audit(spark, layout.audit), "orders")
    df = extract(FrameSource(inp.source), "orders", "Incremental", "updated_at", wm)
    return to_bronze(df, "orders")


def extract_in_parts(spark, sf_dir):
    """A full load of orders read in equal-depth parts, bounds from the lake's copy
    (the orders of one customer in seven, as the last load left them)."""
    inp = Inputs(spark, sf_dir)
    src = inp.source["orders"]
    bounds = equal_depth_predicates(src.where(F.col("customer_id") % 7 == 1), "customer_id", 16, then="order_id")
    return to_bronze(extract(FrameSource(inp.source, {"orders": bounds}), "orders", "Full Load", None, None), "orders")


def _two_ingest_days(spark, sf_dir) -> Layout:
    """Two daily ingests of all seven control rows (archive, extract, land,
    audit), each flushing its pipeline log to the log table and a file."""
    inp = Inputs(spark, sf_dir)
    layout = Layout(work_dir(spark, "ingest"))
    src = FrameSource(inp.source)
    for day, clock in ((DAY1, INGEST_CLOCK_1), (DAY2, INGEST_CLOCK_2)):
        log = PipelineLog(clock=lambda c=clock: c)
        try:
            run_ingest(spark, layout, src, control_dicts(), day, clock, log)
        finally:
            log.flush(spark, layout.pipeline_logs, layout.log_files)
    return layout


def pipeline_log(spark, sf_dir):
    layout = _two_ingest_days(spark, sf_dir)
    return spark.read.schema(PIPELINE_LOG).parquet(layout.pipeline_logs)


def pipeline_log_json(spark, sf_dir):
    layout = _two_ingest_days(spark, sf_dir)
    return spark.read.schema(PIPELINE_LOG).json(f"{layout.log_files}/*.json")


def audit_log(spark, sf_dir):
    layout = _two_ingest_days(spark, sf_dir)
    return read_audit(spark, layout.audit)


def latest_watermark_query(spark, sf_dir):
    """Watermarks of an audit log with one load a source table and order day.

    An order's customer decides which table its day loaded, its key adds a
    fraction of a second. The last control table is never loaded.
    """
    names = [r["tablename"] for r in control_dicts()]
    loads = load_star(spark, sf_dir)["orders"].groupBy(
        F.element_at(F.array(*map(F.lit, names[:-1])),
                     (F.col("o_custkey") % (len(names) - 1) + 1).cast("int")).alias("tablename"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("day")).agg(
        F.count(F.lit(1)).alias("record_count"), F.max(F.col("o_orderkey") % 1000).alias("ms"))
    path = f"{work_dir(spark, 'latest_watermark')}/audit_log"
    append_audit(spark, path, loads.select(
        "tablename", F.lit("Incremental").alias("load_type"), "record_count",
        F.timestamp_add("MILLISECOND", "ms", "day").alias("load_timestamp"),
        F.lit("SUCCESS").alias("status")))
    tables = spark.createDataFrame([(t,) for t in names], "tablename string")
    return watermarks(read_audit(spark, path), tables)


# --- named tables ---------------------------------------------------------------------

def _refused(create) -> bool:
    try:
        create()
    except SchemaMismatch:
        return True
    return False


def create_table_if_absent(spark, sf_dir):
    """The typed silver orders table, made once, filled, asked for again (no
    change) and with other columns (refused)."""
    orders = Inputs(spark, sf_dir).bronze["orders"]
    root = work_dir(spark, "create_table")
    database = f"strata_{root.rsplit('-', 1)[1]}"
    create_database(spark, database, f"{root}/db")
    name, schema = f"{database}.orders", silver_schema("orders")
    made = create_if_absent(spark, name, schema, f"{root}/orders")
    insert(first_load(orders, "orders", T1), name)
    again = create_if_absent(spark, name, schema, f"{root}/orders")
    refused = _refused(lambda: create_if_absent(spark, name, silver_schema("customers"), f"{root}/orders"))
    return spark.table(name).select("*", *[F.lit(v).alias(c) for c, v in (
        ("made", made), ("made_again", again), ("refused", refused))])


def ctas_if_absent_query(spark, sf_dir):
    """A mart as a table made once: asked for again over other rows it stays
    as it is, a mart of other columns is refused."""
    silver = Inputs(spark, sf_dir).silver
    root = work_dir(spark, "ctas")
    database = f"strata_{root.rsplit('-', 1)[1]}"
    create_database(spark, database, f"{root}/db")
    name, mart = f"{database}.customer_reviews_summary", gold.customer_reviews_summary(silver)
    made = ctas_if_absent(mart, name, f"{root}/mart")
    again = ctas_if_absent(mart.limit(1), name, f"{root}/mart")
    refused = _refused(lambda: ctas_if_absent(gold.supplier_analysis(silver), name, f"{root}/mart"))
    return spark.table(name).select("*", *[F.lit(v).alias(c) for c, v in (
        ("made", made), ("made_again", again), ("refused", refused))])


def named_silver_tables(spark, sf_dir):
    """Silver customers and reviews after two batches, read by name in SQL."""
    bronze = Inputs(spark, sf_dir).bronze
    root = work_dir(spark, "named_silver")
    store = SilverStore(spark, f"{root}/silver")
    for batch, now in (("1", T1), ("2", T2)):
        for t in ("customers", "customer_reviews"):
            store.merge(t, bronze[t] if batch == "1" else next_batch(bronze[t], t), batch, now)
    database = f"strata_{root.rsplit('-', 1)[1]}"
    create_database(spark, database, f"{root}/db")
    publish_silver(store, database)
    return spark.sql(f"""
        SELECT c.customer_id, c.name, c.email, c.is_active, count(r.id) AS reviews,
               count(CASE WHEN r.is_active THEN 1 END) AS active_reviews
        FROM {database}.customers c LEFT JOIN {database}.customer_reviews r ON c.customer_id = r.customer_id
        GROUP BY c.customer_id, c.name, c.email, c.is_active""")


# --- silver -------------------------------------------------------------------------

def _quarantine(table: str) -> Query:
    def run(spark, sf_dir):
        return quarantine(Inputs(spark, sf_dir).bronze[table], table)
    return run


def distinct_rows(spark, sf_dir):
    """DISTINCT merge source over two overlapping order extracts."""
    b = Inputs(spark, sf_dir).bronze["orders"]
    return distinct_flagged(b.unionByName(next_batch(b, "orders")), "orders")


def _landed(df: DataFrame, path: str) -> DataFrame:
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _scd2(table: str) -> Query:
    def run(spark, sf_dir):
        b1 = Inputs(spark, sf_dir).bronze[table]
        root = work_dir(spark, f"scd2_{table}")
        # Batches are read more than once, so they are written, as landed ones are;
        # the first one goes when the second has been made from it.
        store = SilverStore(spark, root)
        b1 = _landed(b1, f"{root}-first")
        store.merge(table, b1, "1", T1)
        b2 = _landed(next_batch(b1, table), f"{root}-offered")
        storage.delete(spark, f"{root}-first")
        for batch, now in (("2", T2), ("3", T3)):
            store.merge(table, b2, batch, now)
        return store.read(table)
    return run


def scd2_review_snapshots(spark, sf_dir):
    """Three whole snapshots of the reviews, merged by their change feeds."""
    first = Inputs(spark, sf_dir).bronze["customer_reviews"]
    later = next_batch(first, "customer_reviews")
    second = first.join(later.select("id"), "id", "left_anti").unionByName(later)
    root = work_dir(spark, "review_snapshots")
    for df, day in ((first, DAY1), (second, DAY2), (second.where("rating IS NOT NULL"), DAY3)):
        land_reviews(df, root, day)
    store = SilverStore(spark, f"{root}/silver")
    merge_snapshots(store, "customer_reviews", [
        (str(i), spark.read.schema(BRONZE["customer_reviews"]).parquet(reviews_file(root, day)), now)
        for i, (day, now) in enumerate(((DAY1, T1), (DAY2, T2), (DAY3, T3)))])
    return store.read("customer_reviews")


def distinct_customers_merged(spark, sf_dir):
    """Customers of each product over three batches of orders, each kept as bitmaps."""
    b = Inputs(spark, sf_dir).bronze
    items = b["order_items"].select("order_id", "product_id")
    root = work_dir(spark, "distinct_customers")
    for batch in range(3):
        part = b["orders"].where(F.col("customer_id") % 2 + F.col("order_id") % 2 == batch)
        distinct_state(part.join(items, "order_id"), ["product_id"], "customer_id").write.parquet(f"{root}/batch={batch}")
    states = [spark.read.parquet(f"{root}/batch={batch}") for batch in range(3)]
    return distinct_counts(merged(states, ["product_id"]), ["product_id"], "unique_customers")


def _refresh(table: str) -> Query:
    def run(spark, sf_dir):
        b1 = Inputs(spark, sf_dir).bronze[table]
        store = SilverStore(spark, work_dir(spark, f"silver_{table}"))
        store.refresh(table, b1, "1")
        store.refresh(table, b1, "2")      # a second run replaces, never adds
        return store.read(table)
    return run


def preview_customer_reviews(spark, sf_dir):
    b1 = Inputs(spark, sf_dir).bronze["customer_reviews"]
    store = SilverStore(spark, work_dir(spark, "preview_reviews"))
    store.merge("customer_reviews", b1, "1", T1)
    return store.read("customer_reviews")


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {name: _mart(name) for name in gold.MARTS}
    q.update({
        "days_since_order": days_since_order,
        "join_inner_chain": join_inner_chain,
        "join_left_chain": join_left_chain,
        "land_json": land_json_query,
        "land_reviews": land_reviews_query,
        "ingest_reviews": ingest_reviews_query,
        "archive_landing": archive_landing_query,
        "archive_lines": archive_lines,
        "bronze_rejects": bronze_rejects,
        "create_table_if_absent": create_table_if_absent,
        "ctas_if_absent": ctas_if_absent_query,
        "named_silver_tables": named_silver_tables,
        "restartable_day": restartable_day,
        "ingest_full_load": ingest_full_load,
        "extract_in_parts": extract_in_parts,
        "scd2_review_snapshots": scd2_review_snapshots,
        "distinct_customers_merged": distinct_customers_merged,
        "ingest_incremental": ingest_incremental,
        "audit_log": audit_log,
        "latest_watermark": latest_watermark_query,
        "pipeline_log": pipeline_log,
        "pipeline_log_json": pipeline_log_json,
        "distinct_rows": distinct_rows,
        "preview_customer_reviews": preview_customer_reviews,
    })
    q.update({f"bronze_{t}": _bronze(t) for t in BRONZE})
    q.update({f"quarantine_{t}": _quarantine(t) for t in BRONZE})
    q.update({f"scd2_{t}": _scd2(t) for t in SCD2_TABLES})
    q.update({f"silver_{t}": _refresh(t) for t in REFRESH_TABLES})
    return q


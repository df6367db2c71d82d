"""The registered queries: every operator over the whole given tables, in a comparable form."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartpath.operators import events as event_ops
from cartpath.operators import carts, funnel, journeys, orders, sessions
from cartpath.operators.skew import HOT_GROUP_ROWS, HotKeys, hot_keys, within_limit
from cartpath.plans import reports
from cartpath.plans.late import LateSilver
from cartpath.session import configure, work_path, written
from cartpath.sources import files, tables, topics
from cartpath.sources import testtables as given
from cartpath.sources.schemas import EVENT_DDL, EVENT_FIELDS
from cartpath.sources.versions import REJECTED_TEXT, Contract, ContractError, VersionedTable
from cartpath.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# Load time and file path differ from run to run.
LINEAGE = ("_ingested_at", "_source_file")
# Larger than the landing default of 100, so that the number of files stays in proportion.
EVENTS_PER_FILE = 10_000
# Of a hundred indented events each, some 35 lines an event.
ARRAYS_PER_FILE = 50
# Of order sessions; about a tenth of a GB to sort.
EVENTS_PER_TASK = 500_000
# Steps of the strict funnel have to follow within this time.
STRICT_SECONDS = 6 * 3600


def plain(rows: DataFrame) -> DataFrame:
    """Drop lineage; zone-free times; arrays of ids as one comma-joined text."""
    columns = []
    for field in rows.drop(*LINEAGE).schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


# --- the model over the given tables -----------------------------------------------------------


def _flat(spark: SparkSession, folder: str) -> DataFrame:
    return event_ops.flatten(given.bronze_events(spark, folder))


def _hot(spark: SparkSession, folder: str, keys: tuple[str, ...]) -> HotKeys | None:
    if within_limit(given.given(spark, folder, "events")):
        return None
    return hot_keys(given.event_keys(spark, folder), keys)


def _sessions(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.sessions(_flat(spark, folder))


def _session_products(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.session_products(_flat(spark, folder), _hot(spark, folder, sessions.SESSION_KEYS))


def _measured(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions for the queries that do not read the lists of products."""
    return sessions.session_measures(_flat(spark, folder))


def _trail(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.session_events(_flat(spark, folder), _hot(spark, folder, sessions.TRAIL_KEYS))


def _ranked(spark: SparkSession, folder: str) -> DataFrame:
    # A customer has no more sessions than events, so the count of events finds every hot customer.
    return journeys.ranked_sessions(_measured(spark, folder), _hot(spark, folder, journeys.CUSTOMER_KEYS))


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    return journeys.journey_metrics(_ranked(spark, folder))


def _unranked_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Journeys for the reports that read no rank, for which the window is pruned away."""
    return journeys.journey_metrics(journeys.ranked_sessions(_measured(spark, folder)))


def _journeys(spark: SparkSession, folder: str) -> DataFrame:
    return journeys.customer_journeys(
        _ranked(spark, folder), given.customers(spark, folder), given.orders(spark, folder)
    )


def _reference_orders(spark: SparkSession, folder: str) -> DataFrame:
    return orders.reference_orders(
        given.customers(spark, folder),
        given.orders(spark, folder),
        given.order_items(spark, folder),
        given.products(spark, folder),
        given.order_payments(spark, folder),
    )


# --- queries that do more than call one operator -------------------------------------------------


def _envelope_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Envelope to JSON text and back, then flattened."""
    events = given.bronze_events(spark, folder)
    decoded = topics.decode_events(topics.encode_events(events))
    return event_ops.flatten(event_ops.with_lineage(decoded, F.lit("topic")))


def _topic_decode(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of the decoded envelope that flattening leaves out."""
    decoded = topics.decode_events(topics.encode_events(given.bronze_events(spark, folder)))
    identity = F.get(F.col("identityMap")[event_ops.IDENTITY], F.lit(0))
    order = F.col("commerce.order")
    return decoded.select(
        F.col("_id").alias("event_id"),
        identity["primary"].alias("is_primary"),
        F.col("environment.type").alias("environment_type"),
        F.col("environment.operatingSystem").alias("operating_system"),
        F.col("environment.deviceCategory").alias("device_category"),
        F.col("web.webPageDetails.name").alias("page_name"),
        F.col("web.webReferrer.URL").alias("referrer_url"),
        F.col("web.webReferrer.type").alias("referrer_type"),
        F.get("productListItems", F.lit(0))["quantity"].alias("quantity"),
        F.col("commerce.productViews.value").alias("product_views"),
        F.col("commerce.productListAdds.value").alias("product_list_adds"),
        F.col("commerce.productListRemovals.value").alias("product_list_removals"),
        F.col("commerce.purchases.value").alias("purchases"),
        order["purchaseID"].alias("purchase_id"),
        order["priceTotal"].alias("order_total"),
        order["currencyCode"].alias("currency"),
        F.get(order["payments"], F.lit(0))["paymentType"].alias("payment_type"),
    )


def _bodies(spark: SparkSession, folder: str) -> DataFrame:
    return orders.order_purchases(_reference_orders(spark, folder))


def _purchase_items(spark: SparkSession, folder: str) -> DataFrame:
    lines = _reference_orders(spark, folder)
    # A joined line stands for an order line and a payment type: only the lines themselves tell a hot order.
    hot = None if within_limit(lines) else hot_keys(lines, orders.ORDER_KEYS)
    item = F.col("item")
    return orders.purchase_items(lines, hot).select(
        "order_id", "position", item["SKU"].alias("sku"), item["priceTotal"].alias("price")
    )


def _order_purchase_events(spark: SparkSession, folder: str) -> DataFrame:
    """Purchase events with whole carts, as the envelope holds them."""
    made = event_ops.to_envelope(orders.purchase_actions(_bodies(spark, folder), F.lit("2024-01-31").cast("timestamp")))
    order = F.col("commerce.order")
    return made.select(
        F.col("_id").alias("event_id"),
        "timestamp",
        F.col("web.webSession.ID").alias("session_id"),
        F.size("productListItems").alias("item_count"),
        F.get("productListItems", F.lit(0))["SKU"].alias("first_sku"),
        F.get("productListItems", F.lit(0))["priceTotal"].alias("first_price"),
        order["purchaseID"].alias("purchase_id"),
        order["priceTotal"].alias("order_total"),
        F.get(order["payments"], F.lit(0))["paymentType"].alias("payment_type"),
    )


def _events_of(bodies: DataFrame, tasks: int | None = None) -> DataFrame:
    """Nested events of the sessions that led to the orders; their purchases hold several items."""
    started = F.lit("2024-01-31").cast("timestamp")
    return event_ops.to_envelope(orders.order_sessions(bodies, started, tasks=tasks))


def _order_events(spark: SparkSession, folder: str) -> DataFrame:
    return _events_of(_bodies(spark, folder))


def _order_events_by_session(spark: SparkSession, folder: str) -> DataFrame:
    """The same events, dealt out by session before they are made: what is grouped by session then needs no exchange."""
    # A task makes the events and groups them by product and by category, so it gets half of what an exchange gives it.
    return _events_of(_bodies(spark, folder), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def _order_session_events(spark: SparkSession, folder: str) -> DataFrame:
    return _order_events(spark, folder).select(
        F.col("_id").alias("event_id"),
        F.col("web.webSession.ID").alias("session_id"),
        "timestamp",
        F.col("eventType").alias("event_type"),
        F.coalesce(F.array_join("productListItems.SKU", ","), F.lit("")).alias("skus"),
        F.col("commerce.order.priceTotal").alias("order_total"),
    )


def _session_carts(spark: SparkSession, folder: str) -> DataFrame:
    return carts.session_carts(given.bronze_events(spark, folder), _hot(spark, folder, carts.CART_KEYS))


def _order_carts(spark: SparkSession, folder: str) -> DataFrame:
    """Each order's purchase beside the cart that its session's adds and removals lead to."""
    # An order's events follow from its body, and are many times its size: only bodies are written and exchanged.
    bodies = written(_bodies(spark, folder), "order-bodies")
    events = _events_of(bodies)
    total = events.count()
    hot = None if total <= HOT_GROUP_ROWS else hot_keys(carts.cart_moves(events), carts.CART_KEYS)
    dealt = _events_of(bodies, max(spark.sparkContext.defaultParallelism, ceil(total / EVENTS_PER_TASK)))
    return carts.checked_purchases(dealt, carts.session_carts(dealt, hot))


def _order_purchases(spark: SparkSession, folder: str) -> DataFrame:
    return _bodies(spark, folder).select(
        "order_id",
        "customer_id",
        "part",
        F.size("items").alias("item_count"),
        F.transform("items", lambda line: line["SKU"]).alias("skus"),
        "order_total",
        "payment_type",
    )


def _new_schema(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """A work folder, and a catalog schema below it."""
    work = work_path(spark, purpose)
    schema = work.rsplit("/", 1)[-1].replace("-", "_")
    tables.ensure_schema(spark, schema, f"{work}/{schema}")
    return work, schema


def _csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Orders to CSV, every eleventh with a key that is no number, and back by a schema: what was loaded and what was not."""
    work, schema = _new_schema(spark, "rejects")
    rows = given.given(spark, folder, "orders").selectExpr(
        "concat(CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE '' END, o_orderkey) AS order_id",
        "o_custkey AS customer_id",
        "o_orderstatus AS order_status",
    )
    files.write_csv(rows, f"{work}/orders.csv")
    files.load_csv(spark, f"{work}/orders.csv", f"{schema}.orders", "order_id bigint, customer_id bigint, order_status string")
    loaded = tables.scan(spark, f"{schema}.orders").selectExpr("order_id", "customer_id", "CAST(NULL AS STRING) AS rejected_line")
    rejected = VersionedTable(spark, f"{schema}.orders").rejects()
    return loaded.unionByName(rejected.selectExpr("CAST(NULL AS BIGINT) AS order_id", "CAST(NULL AS BIGINT) AS customer_id", f"{REJECTED_TEXT} AS rejected_line"))


def _table_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A table of orders by status through its writes: what each of them noted, and what its version still holds."""
    _, schema = _new_schema(spark, "versions")
    table = f"{schema}.orders"
    rows = given.given(spark, folder, "orders").selectExpr("o_orderkey AS order_id", "o_orderstatus AS order_status")
    contract = Contract("order_id bigint, order_status string", required=("order_id",), keys=("order_id",))
    tables.write_table(rows.where("order_id % 3 = 0"), table, partition_by=("order_status",), contract=contract)
    tables.write_table(rows.where("order_id % 3 = 1"), table, "append")
    try:
        tables.write_table(rows.unionByName(rows), table, contract=contract)  # refused, so it is no version
    except ContractError:
        pass
    returned = rows.where("order_id % 3 = 2 AND order_status = 'F'")
    VersionedTable(spark, table).replace_partitions(returned, ["F"])
    held = [
        tables.scan(spark, table, n).agg(F.count("*").alias("held"), F.sum("order_id").alias("key_sum")).withColumn("version", F.lit(n))
        for n in range(3)
    ]
    noted = tables.write_history(spark, table).select("version", "operation", "rows")
    return noted.join(reduce(DataFrame.unionByName, held), "version")


def _load_results(spark: SparkSession, folder: str) -> DataFrame:
    """Several CSV files loaded at a time, one of them missing and one with a type that does not exist."""
    work, schema = _new_schema(spark, "loads")
    for name in ("customer", "part", "supplier", "nation"):
        files.write_csv(given.given(spark, folder, name), f"{work}/{name}.csv")
    wanted = {f"{name}.csv": name for name in ("customer", "part", "supplier", "nation", "absent")}
    schemas = {name: given.SCHEMAS[name] for name in ("customer", "part", "supplier")} | {"nation": "n_nationkey no_such_type"}
    return files.load_files(spark, work, schema, wanted, schemas).select("file", "table", "status", "rows", "rejected")


def _event_files_any_form(spark: SparkSession, folder: str) -> DataFrame:
    """Event files of one event per line and of indented arrays in one folder, read by one stream."""
    work, schema = _new_schema(spark, "forms")
    event = F.struct(*EVENT_FIELDS)
    landed = given.bronze_events(spark, folder).withColumn("_n", F.col("_id").cast("bigint"))
    lines, arrays = landed.where("_n % 3 = 0"), landed.where("_n % 3 <> 0")
    # Compressed files cannot be split, so their size is bounded.
    lines.select(F.to_json(event).alias("value")).write.option("maxRecordsPerFile", EVENTS_PER_FILE).text(f"{work}/landing/lines", "gzip")
    # A hundred events to an array, as the consumer of the topic writes them.
    texts = arrays.groupBy(F.floor(F.col("_n") / 150).alias("file")).agg(F.collect_list(F.to_json(event, {"pretty": "true"})).alias("texts"))
    indented = F.concat(F.lit("[\n"), F.array_join("texts", ",\n"), F.lit("\n]"))
    texts.select(indented.alias("value")).write.option("maxRecordsPerFile", ARRAYS_PER_FILE).text(f"{work}/landing/arrays", "gzip")
    ingest.ingest_events(ingest.event_stream(spark, f"{work}/landing"), schema, f"{work}/checkpoint")
    return event_ops.flatten(tables.scan(spark, f"{schema}.{ingest.EVENTS}"))


def _event_schema_growth(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a first and of a later schema, which has more inside structs and arrays and a wider number."""
    work, schema = _new_schema(spark, "growth")
    events = given.bronze_events(spark, folder).drop(*LINEAGE)
    later = "CAST(_id AS BIGINT) % 2 = 1"
    ingest.write_event_files(events.where(f"NOT {later}"), f"{work}/landing/first", EVENTS_PER_FILE)
    ingest.ingest_events(ingest.event_stream(spark, f"{work}/landing", multi_line=False), schema, f"{work}/checkpoint")
    version = F.concat(F.lit("v"), F.length("_id"))
    grown = events.where(later).withColumn("environment", F.col("environment").withField("app", F.struct(version.alias("version"))))
    items = F.transform("productListItems", lambda line: line.withField("discount", line["priceTotal"] / 2).withField("quantity", F.lit(2**40)))
    ingest.write_event_files(grown.withColumn("productListItems", items), f"{work}/landing/later", EVENTS_PER_FILE)
    wider = EVENT_DDL.replace("deviceCategory:string", "deviceCategory:string, app:struct<version:string>")
    wider = wider.replace("quantity:int", "quantity:bigint, discount:double")
    ingest.ingest_events(ingest.event_stream(spark, f"{work}/landing", multi_line=False, schema=wider), schema, f"{work}/checkpoint")
    item = F.get("productListItems", F.lit(0))
    return tables.scan(spark, f"{schema}.{ingest.EVENTS}").select(
        F.col("_id").alias("event_id"),
        F.col("environment.deviceCategory").alias("device_category"),
        F.col("environment.app.version").alias("app_version"),
        item["quantity"].alias("quantity"),
        item["discount"].alias("discount"),
    )


def _late_silver(spark: SparkSession, folder: str) -> str:
    """The silver tables from three quarters of the events, and then the others as late ones; the name of the schema."""
    _, schema = _new_schema(spark, "late")
    silver = LateSilver(spark, schema, buckets=8)
    flat = event_ops.flatten(given.bronze_events(spark, folder))
    late = "CAST(event_id AS BIGINT) % 4 = 3"
    silver.publish(flat.where(f"NOT {late}"), given.customers(spark, folder), given.orders(spark, folder))
    silver.add(flat.where(late))
    return schema


def _step_time_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles of each week from sketches of its days."""
    sketches = written(funnel.step_time_sketches(funnel.funnel_step_times(_flat(spark, folder)), 4096), "sketches")
    return funnel.sketched_quantiles(sketches, {"week": F.to_date(F.date_trunc("week", "session_date"))})


def _csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders to a CSV file with a header, and from there into a bronze table."""
    work = work_path(spark, "csv")
    schema = work.rsplit("/", 1)[-1].replace("-", "_")
    tables.ensure_schema(spark, schema, f"{work}/{schema}")
    given.orders(spark, folder).write.option("header", True).csv(f"{work}/orders.csv")
    ddl = "order_id int, customer_id int, order_status string, order_purchase_timestamp timestamp"
    files.load_csv(spark, f"{work}/orders.csv", f"{schema}.orders", ddl)
    return tables.scan(spark, f"{schema}.orders")


def _csv_text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Free text with quotes and line breaks to CSV and back, read once by a given schema."""
    work = work_path(spark, "csv")
    schema = work.rsplit("/", 1)[-1].replace("-", "_")
    tables.ensure_schema(spark, schema, f"{work}/{schema}")
    files.write_csv(given.given(spark, folder, "conversations"), f"{work}/conversations.csv")
    files.load_csv(spark, f"{work}/conversations.csv", f"{schema}.conversations", given.SCHEMAS["conversations"])
    return tables.scan(spark, f"{schema}.conversations")


def _upsert_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by status, changed by newer, older and undated rows and by rows without a key."""
    work = work_path(spark, "upsert")
    schema = work.rsplit("/", 1)[-1].replace("-", "_")
    tables.ensure_schema(spark, schema, f"{work}/{schema}")
    held = given.orders(spark, folder).selectExpr(
        "order_id",
        "customer_id",
        "CASE WHEN CAST(order_id AS BIGINT) % 11 <> 0 THEN order_purchase_timestamp END AS changed_at",
        "order_status",
    )
    tables.write_table(held, f"{schema}.orders", partition_by=("order_status",))
    changes = given.orders(spark, folder).where("CAST(order_id AS BIGINT) % 3 = 0").selectExpr(
        "CASE WHEN CAST(order_id AS BIGINT) % 5 <> 0 THEN order_id END AS order_id",
        "concat('c', customer_id) AS customer_id",
        "order_purchase_timestamp + make_interval(0, 0, 0, CAST(CAST(order_id AS BIGINT) % 2 AS INT) * 2 - 1) AS changed_at",
        "'returned' AS order_status",
    )
    tables.upsert(changes, f"{schema}.orders", ["order_id"], "changed_at", "order_status")
    return tables.scan(spark, f"{schema}.orders")


def _event_stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Events to landing files, by the stream into bronze, and flattened from there."""
    work = work_path(spark, "stream")
    schema = work.rsplit("/", 1)[-1].replace("-", "_")
    tables.ensure_schema(spark, schema, f"{work}/{schema}")
    landed = given.bronze_events(spark, folder).drop(*LINEAGE)
    ingest.write_event_files(landed, f"{work}/landing", EVENTS_PER_FILE)
    stream = ingest.event_stream(spark, f"{work}/landing")
    ingest.ingest_events(stream, schema, f"{work}/checkpoint")
    return event_ops.flatten(tables.scan(spark, f"{schema}.{ingest.EVENTS}"))


def _event_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Messages, as files that stand for the topic, streamed into batches of event files."""
    work = work_path(spark, "batches")
    topics.encode_events(given.bronze_events(spark, folder)).write.parquet(f"{work}/topic")
    messages = spark.readStream.schema("key binary, value binary").parquet(f"{work}/topic")
    ingest.batch_events(messages, f"{work}/events", f"{work}/checkpoint", EVENTS_PER_FILE)
    written = spark.read.schema(EVENT_DDL).option("recursiveFileLookup", True).json(f"{work}/events")
    return written.select(
        F.col("_id").alias("event_id"),
        F.try_to_timestamp("timestamp").alias("event_timestamp"),
        F.col("eventType").alias("event_type"),
        F.col("web.webSession.ID").alias("session_id"),
    )


def _table_counts(spark: SparkSession, folder: str) -> DataFrame:
    names = ("customer", "orders", "lineitem", "part", "supplier", "nation", "events")
    return tables.count_rows({name: given.given(spark, folder, name) for name in names})


def queries() -> dict[str, Query]:
    """Name to query; each takes the session and the folder of the given tables."""
    over: dict[str, Query] = {
        "flatten_events": _flat,
        "event_envelope_roundtrip": _envelope_roundtrip,
        "sessions": _sessions,
        "session_products": _session_products,
        "session_events": _trail,
        "events_by_type": lambda s, d: reports.events_by_type(given.bronze_events(s, d)),
        "session_summary": lambda s, d: reports.session_summary(_measured(s, d)),
        "sessions_by_stage": lambda s, d: reports.sessions_by_stage(_measured(s, d)),
        "event_transitions": lambda s, d: reports.event_transitions(_trail(s, d)),
        "funnel_metrics": lambda s, d: reports.funnel_report(funnel.funnel_metrics(_measured(s, d))),
        "funnel_step_times": lambda s, d: funnel.funnel_step_times(_flat(s, d)),
        "step_time_averages": lambda s, d: reports.step_time_averages(funnel.funnel_step_times(_flat(s, d))),
        "step_time_summary": lambda s, d: reports.step_time_summary(funnel.funnel_step_times(_flat(s, d))),
        "funnel_daily": lambda s, d: funnel.funnel_daily(_measured(s, d)),
        "daily_trend": lambda s, d: reports.daily_trend(funnel.funnel_daily(_measured(s, d))),
        "funnel_by_category": lambda s, d: funnel.funnel_by_category(
            event_ops.flatten_items(given.bronze_events(s, d)), given.products(s, d)
        ),
        "order_funnel_by_category": lambda s, d: funnel.funnel_by_category(
            event_ops.flatten_items(_order_events_by_session(s, d)), given.products(s, d)
        ),
        "session_carts": _session_carts,
        "order_session_events": _order_session_events,
        "order_carts": _order_carts,
        "strict_funnel": lambda s, d: funnel.strict_funnel(_flat(s, d), STRICT_SECONDS, _hot(s, d, sessions.TRAIL_KEYS)),
        "step_time_quantiles": _step_time_quantiles,
        "csv_rejects": _csv_rejects,
        "load_results": _load_results,
        "table_versions": _table_versions,
        "event_files_any_form": _event_files_any_form,
        "event_schema_growth": _event_schema_growth,
        "late_customer_journeys": lambda s, d: s.table(f"{_late_silver(s, d)}.customer_journeys"),
        "ranked_sessions": lambda s, d: _ranked(s, d).select(
            "session_id",
            "customer_id",
            "session_start",
            "session_rank",
            "is_first_session",
            "is_last_session",
            "days_since_prev_session",
        ),
        "first_last_touch": lambda s, d: journeys.first_last_touch(_measured(s, d)),
        "first_conversion": lambda s, d: journeys.first_conversion(_ranked(s, d)),
        "customer_orders": lambda s, d: journeys.customer_orders(given.orders(s, d)),
        "customer_journeys": _journeys,
        "customer_journey_sessions": lambda s, d: journeys.customer_journey_sessions(_ranked(s, d)),
        "engagement_summary": lambda s, d: reports.engagement_summary(_unranked_metrics(s, d)),
        "conversion_sessions": lambda s, d: reports.conversion_sessions(_metrics(s, d)),
        "first_touch_distribution": lambda s, d: reports.first_touch_distribution(_metrics(s, d)),
        "engagement_segments": lambda s, d: reports.engagement_segments(_unranked_metrics(s, d)),
        "reference_orders": _reference_orders,
        "order_purchases": _order_purchases,
        "order_purchase_events": _order_purchase_events,
        "purchase_items": _purchase_items,
        "table_counts": _table_counts,
        "csv_roundtrip": _csv_roundtrip,
        "csv_text_roundtrip": _csv_text_roundtrip,
        "upsert_orders": _upsert_orders,
        "event_stream_ingest": _event_stream_ingest,
        "topic_decode": _topic_decode,
        "event_batches": _event_batches,
    }

    def comparable(query: Query) -> Query:
        return lambda spark, folder: plain(query(configure(spark), folder))

    return {name: comparable(query) for name, query in over.items()}

"""Every operator run over the given tables; names match those in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querymill.functions import dates, paths
from querymill.operators import (
    asof,
    classifier,
    columns,
    evaluation,
    hashed_neighbors,
    layout,
    limits,
    neighbors,
    overlaps,
    registry,
)
from querymill.plans import jobs
from querymill.plans.sql_datasets import SQL_DATASETS, SqlDataset
from querymill.session import fresh_path, materialize
from querymill.sinks import files as file_sinks
from querymill.sinks import latest as latest_sinks
from querymill.sinks import registry as registry_sinks
from querymill.sinks import versions as version_sinks
from querymill.sources import files, tables
from querymill.sources import registry as registry_sources
from querymill.sources import versions as version_sources
from querymill.sources.query import query_dataset
from querymill.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]

FEATURES = ["x0", "x1", "x2", "x3"]
ALL_FEATURES = [f"x{i}" for i in range(64)]  # of an embedding
MODEL_URL = "s3://models/store"

ORDERS_BY_MONTH = """
    SELECT *, year(cast(o_orderdate AS timestamp_ntz)) AS year,
           month(cast(o_orderdate AS timestamp_ntz)) AS month
    FROM orders"""

# ---------------------------------------------------------------- inputs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return files.scan_parquet(spark, f"{sf_dir}/{name}.parquet")


def _views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        tables.external_view(spark, name, f"{sf_dir}/{name}.parquet")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four dimensions of the embeddings, with key and label."""
    return _table(spark, sf_dir, "embeddings").select(
        *[F.col("embedding")[i].cast("double").alias(x) for i, x in enumerate(FEATURES)],
        "label",
        "vec_id",
    )


def _whole_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dimensions of the embeddings, with key and label.

    In an embedding of another length they are NULL, which the search refuses.
    """
    whole = F.when(F.size("embedding") == len(ALL_FEATURES), F.col("embedding"))
    return _table(spark, sf_dir, "embeddings").select(
        *[whole[i].cast("double").alias(x) for i, x in enumerate(ALL_FEATURES)],
        "label",
        "vec_id",
    )


def _order_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders seen as model versions: grouped by market segment, named by day and key."""
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = _table(spark, sf_dir, "orders")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("c_mktsegment").alias("model_group"),
        F.concat_ws(
            "-", dates.iso_date(F.col("o_orderdate")), F.col("o_orderkey").cast("string")
        ).alias("version"),
        "o_orderstatus",
        "o_orderdate",
    )


def _packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of those packages: registered on the order's day, approved a day later
    where the order is closed."""
    made = registry.new_packages(
        _order_models(spark, sf_dir), MODEL_URL, at=F.struct("o_orderdate", "o_orderstatus")
    )
    day = F.col("updated_at.o_orderdate")
    events = F.array(
        F.struct(day.alias("at"), F.col("approval_status").alias("status")),
        F.when(
            F.col("updated_at.o_orderstatus") == "F",
            F.struct(
                (day + F.expr("INTERVAL 1 DAY")).alias("at"), F.lit(registry.APPROVED).alias("status")
            ),
        ),
    )
    return (
        made.withColumn("event", F.explode(F.filter(events, lambda e: e.isNotNull())))
        .withColumn("approval_status", F.col("event.status"))
        .withColumn("updated_at", F.col("event.at"))
        .drop("event")
    )


# ---------------------------------------------------------------- projections, functions


def select_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.select_all(_table(spark, sf_dir, "lineitem"))


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.with_date_parts(_table(spark, sf_dir, "orders"), "o_orderdate")


def date_parts_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits.limit_rows(date_parts(spark, sf_dir), 5000, ["o_orderkey"])


def string_date_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text, those of pending orders spoilt: they give no year (0 here)."""
    day = dates.iso_date(F.col("o_orderdate"))
    text = F.when(F.col("o_orderstatus") == "P", F.concat(day, F.lit("?"))).otherwise(day)
    dated = _table(spark, sf_dir, "orders").select("o_orderkey", text.alias("day"))
    return columns.with_date_parts(dated, "day", on_error="null").fillna(0, ["year", "month"])


def zone_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        "event_id",
        dates.today(utc=F.col("ts")).alias("today"),
        dates.yesterday(utc=F.col("ts")).alias("yesterday"),
        dates.iso_date(dates.yesterday(utc=F.col("ts"))).alias("folder"),
    )


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.concat_ws(
        "/", F.lit("s3://docs"), "source", "lang", F.col("doc_id").cast("string"), F.lit("part.txt")
    )
    named = _table(spark, sf_dir, "documents").select("doc_id", uri.alias("uri"))
    u = F.col("uri")
    return named.select(
        "doc_id",
        paths.to_s3a(u).alias("uri_s3a"),
        paths.bucket(u).alias("bucket"),
        paths.prefix(u).alias("prefix"),
        paths.dirname(u).alias("dirname"),
        paths.basename(u).alias("basename"),
        paths.tail_name(u).alias("tail_name"),
    )


def load_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct load times: every row carries the same time."""
    stamped = columns.with_load_timestamp(_table(spark, sf_dir, "customer"))
    return stamped.agg(
        F.count("*").alias("n_rows"), F.countDistinct("ts").alias("n_times")
    )


def first_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.first_columns(_table(spark, sf_dir, "part"), 4)


def drop_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = columns.drop_label(_table(spark, sf_dir, "part"), "p_type")
    return columns.drop_label(kept, "not_there")


def prediction_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.prediction_only(_table(spark, sf_dir, "labels"), ["doc_id"], "quality")


# ---------------------------------------------------------------- limits, latest


def head_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits.preview(_table(spark, sf_dir, "customer"), order_by=["c_custkey"])


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return limits.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def incremental_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest order of each customer, kept up to date over three batches."""
    orders = _table(spark, sf_dir, "orders")
    path = fresh_path(spark, "latest")
    for part in range(3):
        batch = orders.where(F.col("o_orderkey") % 3 == part)
        latest_sinks.merge_latest(path, batch, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return latest_sinks.read_latest(spark, path, orders.schema)


def ordered_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The half of all lines that cost most."""
    lines = _table(spark, sf_dir, "lineitem")
    order = ["l_extendedprice", "l_orderkey", "l_linenumber"]
    return limits.first_rows(lines, lines.count() // 2, order, [True, False, False])


def ordered_half_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest third of ship dates and flags, which thousands of lines share."""
    lines = _table(spark, sf_dir, "lineitem").select("l_shipdate", "l_returnflag")
    return limits.first_rows(lines, lines.count() // 3, ["l_shipdate", "l_returnflag"])


# ---------------------------------------------------------------- joins by time and range


def asof_previous_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's last event before it."""
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    found = asof.asof_join(
        events, events, ["user_id"], "ts", "ts", strict=True, ties=["event_id"], rename="last_{}"
    )
    return found.fillna(-1, ["last_event_id"])


def asof_order_of_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the last order made until then by anyone, all under one key."""
    one = F.lit(0).alias("one")
    events = _table(spark, sf_dir, "events").select("event_id", "ts", one)
    shift = F.expr("INTERVAL 8760 DAYS")
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderdate") + shift).alias("made_at"), one
    )
    found = asof.asof_join(
        events, orders, ["one"], "ts", "made_at", ties=["o_orderkey"], rows_per_bucket=10_000
    )
    return found.drop("one")


def overlapping_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a customer's orders, one of them being made while the other was open: a day
    for each thousand of its price."""
    end = F.col("o_orderdate") + F.make_dt_interval((F.col("o_totalprice") / 1000).cast("int"))
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("a"),
        "o_custkey",
        F.col("o_orderdate").alias("a_from"),
        end.alias("a_to"),
    )
    others = orders.withColumnsRenamed({"a": "b", "a_from": "b_from", "a_to": "b_to"})
    pairs = overlaps.overlap_join(
        orders, others, ("a_from", "a_to"), ("b_from", "b_to"), ["o_custkey"], closed=False
    )
    return pairs.where("a < b").select("o_custkey", "a", "b")


def range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers whose balances lie within a band of each other, which is as
    wide as a thousandth of the supplier's."""
    customers = _table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("c_from"), F.col("c_acctbal").alias("c_to")
    )
    band = F.abs("s_acctbal") / 1000
    suppliers = _table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (F.col("s_acctbal") - band).alias("s_from"),
        (F.col("s_acctbal") + band).alias("s_to"),
    )
    pairs = overlaps.overlap_join(customers, suppliers, ("c_from", "c_to"), ("s_from", "s_to"))
    return pairs.select("c_custkey", "s_suppkey", "c_from")


# ---------------------------------------------------------------- layout


def distributed_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tasks that hold a month when keys stay together.

    The rows are counts per month and status: a busy month is no larger a key.
    """

    @layout.repartition_by(["year", "month"], hot_keys="together")
    def months() -> DataFrame:
        return date_parts(spark, sf_dir).groupBy("year", "month", "o_orderstatus").count()

    return (
        months()
        .withColumn("task", F.spark_partition_id())
        .groupBy("year", "month")
        .agg(F.sum("count").alias("n_rows"), F.countDistinct("task").alias("n_tasks"))
    )


def distributed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    @layout.repartition_by(["l_returnflag"])
    def lines() -> DataFrame:
        return _table(spark, sf_dir, "lineitem")

    return lines()


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = date_parts(spark, sf_dir)
    path = fresh_path(spark, "orders")
    file_sinks.write_partitioned(rows, path, ["year", "month"], max_records_per_file=1_000_000)
    return files.scan_partitioned(spark, path, rows.schema, ["year", "month"])


def pruned_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year of the stored orders; the others are not read."""
    return partitioned_roundtrip(spark, sf_dir).where("year = 1996 AND month <= 6")


def replaced_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite one year in place; the other years stay."""
    rows = columns.with_date_parts(_table(spark, sf_dir, "orders"), "o_orderdate").drop("month")
    path = fresh_path(spark, "orders")
    file_sinks.write_partitioned(rows, path, ["year"])
    changed = rows.where("year = 1996").withColumn("o_orderstatus", F.lit("X"))
    file_sinks.write_partitioned(changed, path, ["year"], dynamic=True)
    return files.scan_parquet(spark, path, schema=rows.schema)


def bounded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the files of a table written with at most a tenth of its rows per file."""
    lines = _table(spark, sf_dir, "lineitem")
    bound = lines.count() // 10 + 1
    path = fresh_path(spark, "lines")
    file_sinks.write_parquet(lines, path, max_records_per_file=bound)
    per_file = (
        files.scan_parquet(spark, path, schema=lines.schema)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .count()
    )
    return per_file.agg(
        F.sum("count").alias("n_rows"), (F.max("count") <= bound).alias("within_bound")
    )


def interleaved_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines laid out by ship date and part together, and those of two ranges read back."""
    lines = _table(spark, sf_dir, "lineitem")
    path = fresh_path(spark, "lines")
    file_sinks.write_parquet(layout.interleaved(lines, ["l_shipdate", "l_partkey"]), path)
    stored = files.scan_parquet(spark, path, schema=lines.schema)
    return stored.where("l_shipdate >= timestamp_ntz'1997-01-01 00:00:00' AND l_partkey % 7 < 5")


# ---------------------------------------------------------------- query datasets


def query_to_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: a query's rows stored by month under a run date, read back."""
    _views(spark, sf_dir, "orders")
    return jobs.query_to_partitions(
        spark,
        ORDERS_BY_MONTH,
        fresh_path(spark, "nightly"),
        run_date=date(2026, 1, 1),
        max_records_per_file=1_000_000,
    )


def query_to_partitions_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a row cap in the query and small files."""
    _views(spark, sf_dir, "orders")
    return jobs.query_to_partitions(
        spark,
        ORDERS_BY_MONTH + " ORDER BY o_orderkey LIMIT 5000",
        fresh_path(spark, "nightly"),
        run_date=date(2026, 1, 1),
        max_records_per_file=1000,
    )


def partition_edge_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text partition column with empty texts and NULLs, in files and in a table."""
    lang = F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 5 != 1, F.col("lang"))
    rows = _table(spark, sf_dir, "documents").select("doc_id", "n_chars", lang.alias("lang"))
    rows.createOrReplaceTempView("edge_documents")
    return query_dataset(spark, "SELECT * FROM edge_documents", ["lang"])


def query_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "orders")
    return query_dataset(spark, ORDERS_BY_MONTH, ["year", "month"])


def ctas_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "orders")
    """Stored as a table; the table is dropped, its files are read."""
    name, path = f"orders_by_month_{uuid4().hex}", fresh_path(spark, "table")
    made = query_dataset(
        spark, ORDERS_BY_MONTH, ["year", "month"], as_table=name, location=path
    )
    schema = made.schema
    spark.sql(f"DROP TABLE {name}")
    return files.scan_partitioned(spark, path, schema, ["year", "month"])


def _sql(dataset: SqlDataset) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _views(spark, sf_dir, *dataset.tables)
        return query_dataset(spark, dataset.query, [dataset.partition_col])

    return run


# ---------------------------------------------------------------- files and tables


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    root = fresh_path(spark, "csv")
    version_sinks.write_version(customer, root, "csv")
    latest = version_sources.load_latest(spark, root, "csv", customer.schema)
    return latest.drop("version")


def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes, blanks and line breaks."""
    documents = _table(spark, sf_dir, "documents")
    root = fresh_path(spark, "csv")
    version_sinks.write_version(documents, root, "csv")
    latest = version_sources.load_latest(spark, root, "csv", documents.schema)
    return latest.drop("version")


def csv_one_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column of whole texts, some of them empty and some NULL."""
    text = F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 7 != 1, F.col("text"))
    texts = _table(spark, sf_dir, "documents").select(text.alias("text"))
    root = fresh_path(spark, "csv")
    version_sinks.write_version(texts, root, "csv", max_records_per_file=100_000)
    return version_sources.load_latest(spark, root, "csv", texts.schema).drop("version")


def csv_parallel_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same texts, each file read in ranges of a MiB by as many tasks."""
    documents = _table(spark, sf_dir, "documents")
    root = fresh_path(spark, "csv")
    version_sinks.write_version(documents, root, "csv")
    return files.scan_prefix(
        spark, root, "csv", documents.schema, own_csv=True, range_bytes=1 << 20
    )


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    root = fresh_path(spark, "json")
    version = version_sinks.write_version(customer, root, "json")
    return files.scan_json(
        spark, version_sources.version_path(root, version), schema=customer.schema
    )


def json_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    root = fresh_path(spark, "json")
    version_sinks.write_version(turns, root, "json")
    return version_sources.load_latest(spark, root, "json", turns.schema).drop("version")


def _two_versions(spark: SparkSession, sf_dir: str) -> str:
    """All customers, then those not in debt."""
    customer = _table(spark, sf_dir, "customer")
    root = fresh_path(spark, "versions")
    version_sinks.write_version(customer, root, version="2026-01-01T00.00.00.000Z")
    solvent = customer.where("c_acctbal >= 0")
    version_sinks.write_version(solvent, root, version="2026-01-02T00.00.00.000Z")
    return root


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_sources.load_latest(spark, _two_versions(spark, sf_dir))


def all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_sources.load_versions(spark, _two_versions(spark, sf_dir))


def all_versions_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version without one of the columns of the version before."""
    customer = _table(spark, sf_dir, "customer")
    root = fresh_path(spark, "versions")
    version_sinks.write_version(customer, root, version="2026-01-01T00.00.00.000Z")
    shorter = customer.drop("c_acctbal")
    version_sinks.write_version(shorter, root, version="2026-01-02T00.00.00.000Z")
    return version_sources.load_versions(spark, root)


def versions_from_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions in plain ``<root>/<version>/`` folders, named by the path alone."""
    customer = _table(spark, sf_dir, "customer")
    root = fresh_path(spark, "flat")
    file_sinks.write_parquet(customer, f"{root}/v1")
    file_sinks.write_parquet(customer.where("c_acctbal >= 0"), f"{root}/v2")
    return files.scan_prefix(spark, root, schema=customer.schema).withColumn(
        "version", version_sources.version_from_path()
    )


def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared as a table, which is dropped again: that leaves the files."""
    path, name = f"{sf_dir}/part.parquet", f"part_{uuid4().hex}"
    schema = files.scan_parquet(spark, path).schema
    declared = tables.external_table(spark, name, path, schema).schema
    spark.sql(f"DROP TABLE {name}")
    return files.scan_parquet(spark, path, schema=declared)


def declared_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    root = fresh_path(spark, "csv")
    version_sinks.write_version(part, root, "csv")
    return files.scan_declared(
        spark, root, "text/csv", part.schema, multiline=False, own_csv=True
    )


def declared_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.scan_declared(spark, f"{sf_dir}/part.parquet", "application/x-parquet")


def prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files at any depth; folder names add no columns."""
    orders = _table(spark, sf_dir, "orders")
    path = fresh_path(spark, "deep")
    file_sinks.write_partitioned(date_parts(spark, sf_dir), path, ["year", "month"])
    return files.scan_prefix(spark, path, schema=orders.schema)


# ---------------------------------------------------------------- learning


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(
        "doc_id", evaluation.in_train("doc_id").alias("is_train")
    )


def _neighbors(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    points = _points(spark, sf_dir)
    train, test = evaluation.train_test_split(points, "vec_id")
    found = neighbors.nearest_neighbor(test, train, "vec_id", "label", FEATURES, **options)
    return found.withColumnRenamed("nearest_key", "nearest_id")


def nearest_neighbor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _neighbors(spark, sf_dir)


def nearest_neighbor_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with small leaves and chunks, so that both are in use on small data."""
    return _neighbors(spark, sf_dir, leaf_rows=128, chunk_rows=100)


def nearest_neighbor_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of whole embeddings, stored once for whoever reads them."""
    train, test = evaluation.train_test_split(_whole_points(spark, sf_dir), "vec_id")
    found = neighbors.nearest_neighbor(test, train, "vec_id", "label", ALL_FEATURES)
    return materialize(found.withColumnRenamed("nearest_key", "nearest_id"), "neighbors")


def hashed_neighbor_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that hashed candidates answer, and whether nine in ten neighbours are the
    nearest of all, in 64 dimensions."""
    train, test = evaluation.train_test_split(_whole_points(spark, sf_dir), "vec_id")
    exact = neighbors.nearest_neighbor(test, train, "vec_id", "label", ALL_FEATURES)
    hashed = hashed_neighbors.hashed_neighbor(test, train, "vec_id", "label", ALL_FEATURES)
    same = F.col("n.distance") == F.col("e.distance")
    both = hashed.alias("n").join(exact.alias("e"), "vec_id")
    measured = both.agg(F.count("*").alias("n_rows"), F.avg(same.cast("double")).alias("recall"))
    return materialize(
        measured.select("n_rows", (F.col("recall") >= 0.9).alias("recall_reached")), "recall"
    )


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.neighbor_accuracy(_points(spark, sf_dir), "vec_id", "label", FEATURES)


def accuracy_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the neighbours of whole embeddings."""
    points = _whole_points(spark, sf_dir)
    return materialize(jobs.neighbor_accuracy(points, "vec_id", "label", ALL_FEATURES), "accuracy")


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Class probabilities and weights of the trained classifier, one row per class."""
    points = _points(spark, sf_dir)
    model = classifier.train_classifier(points.select(*FEATURES, "label"), "label")
    regression, names = model.stages[1], model.stages[2].getLabels()
    classes = F.array(*[F.lit(int(name)) for name in names])
    shares = model.transform(points).select(
        *FEATURES, F.posexplode(vector_to_array("_probability")).alias("class", "share")
    )
    weights = spark.createDataFrame(
        [
            (k, *[float(w) for w in row])
            for k, row in enumerate(regression.coefficientMatrix.toArray())
        ],
        "class int, " + ", ".join(f"w{i} double" for i in range(len(FEATURES))),
    )
    return shares.withColumn("label", classes[F.col("class")]), weights


def fitted_class_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected rows per class under the fitted model.

    Intercepts carry no penalty, so at the optimum these equal the true counts.
    """
    shares, _ = _fitted(spark, sf_dir)
    return shares.groupBy("label").agg(F.round(F.sum("share"), 2).alias("n_rows"))


def fitted_feature_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature sums per class under the fitted model, with the penalty's share.

    At the optimum these equal the feature sums of the class's own rows, which
    holds for the right penalty only.
    """
    shares, weights = _fitted(spark, sf_dir)
    sums = shares.groupBy("label", "class").agg(
        *[F.sum(F.col(x) * F.col("share")).alias(x) for x in FEATURES]
    )
    penalty = classifier.INVERSE_PENALTY
    return sums.join(weights, "class").select(
        "label",
        *[
            F.round(F.col(x) + F.col(f"w{i}") / penalty, 2).alias(f"sum_{x}")
            for i, x in enumerate(FEATURES)
        ],
    )


def _priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with four indicators that tell their five priorities apart."""
    marks = [(F.col("o_orderpriority").startswith(str(n))).cast("double") for n in (1, 2, 3, 4)]
    return _table(spark, sf_dir, "orders").select(
        *[m.alias(f"is_{n}") for n, m in enumerate(marks, start=1)],
        "o_orderpriority",
        "o_orderkey",
    )


def _priority_model(rows: DataFrame) -> PipelineModel:
    return classifier.train_classifier(rows.drop("o_orderkey"), "o_orderpriority")


def train_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save as a version, load the latest, predict classes that can be told apart."""
    rows = _priorities(spark, sf_dir)
    root = fresh_path(spark, "models")
    version_sinks.save_model_version(_priority_model(rows), root)
    loaded = version_sources.load_latest_model(spark, root)
    return classifier.predict(loaded, rows, ["o_orderkey"], "o_orderpriority")


def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score stored CSV files into Parquet."""
    rows = _priorities(spark, sf_dir)
    model = _priority_model(rows)
    stored, scored = fresh_path(spark, "rows"), fresh_path(spark, "scores")
    version_sinks.write_version(rows, stored, "csv")
    classifier.batch_score(
        spark,
        model,
        stored,
        scored,
        declared="text/csv",
        schema=rows.schema,
        key_cols=["o_orderkey"],
        label="o_orderpriority",
        multiline=False,
        own_csv=True,
    )
    return files.scan_parquet(spark, scored)


def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders scored as they arrive, in two lots; a third call finds nothing new."""
    rows = _priorities(spark, sf_dir)
    model = _priority_model(rows)
    arriving, scored, state = (fresh_path(spark, n) for n in ("arriving", "scored", "state"))
    for odd in (0, 1, None):
        if odd is not None:
            lot = rows.where(F.col("o_orderkey") % 2 == odd)
            file_sinks.write_parquet(lot, arriving, mode="append")
        scoring.score_arrivals(
            spark,
            model,
            arriving,
            scored,
            state,
            rows.schema,
            key_cols=["o_orderkey"],
            label="o_orderpriority",
        )
    schema = classifier.predict(model, rows, ["o_orderkey"], "o_orderpriority").schema
    return scoring.read_scores(spark, scored, schema).drop("batch")


# ---------------------------------------------------------------- registry


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an order since 2001, found as keys yet to be inserted."""
    customer = _table(spark, sf_dir, "customer")
    orders = _table(spark, sf_dir, "orders").where("o_orderdate >= timestamp_ntz'2001-01-01 00:00:00'")
    known = orders.select(F.col("o_custkey").alias("c_custkey"))
    return registry.insert_if_absent(customer, known, ["c_custkey"])


def register_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register every segment twice; each is kept once."""
    root = fresh_path(spark, "registry")
    registry_sinks.create_registry(spark, root)
    groups = _table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("model_group"), F.lit("").alias("description")
    )
    registry_sinks.register_groups(spark, root, groups)
    registry_sinks.register_groups(spark, root, groups)
    return registry_sources.read_groups(spark, root)


def groups_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, one of them NULL, that two writers appended without seeing each other."""
    root = fresh_path(spark, "registry")
    registry_sinks.create_registry(spark, root)
    name = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    groups = _table(spark, sf_dir, "customer").select(
        name.alias("model_group"), F.lit("").alias("description")
    )
    for _ in range(2):
        file_sinks.write_parquet(
            registry.one_per_key(groups, ["model_group"]),
            registry_sources.groups_path(root),
            mode="append",
        )
    registry_sinks.register_groups(spark, root, groups)
    return registry_sources.read_groups(spark, root)


def register_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append one pending package per order and read the registry back."""
    root = fresh_path(spark, "registry")
    registry_sinks.create_registry(spark, root)
    models = _order_models(spark, sf_dir)
    registry_sinks.append_packages(
        root, registry.new_packages(models, MODEL_URL, "test", at=F.current_timestamp())
    )
    return registry_sources.read_packages(spark, root).drop("updated_at")


def approve_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approve the packages of closed orders by appending rows; states afterwards."""
    root = fresh_path(spark, "registry")
    registry_sinks.create_registry(spark, root)
    models = _order_models(spark, sf_dir)
    registry_sinks.append_packages(root, registry.new_packages(models, MODEL_URL))
    closed = registry.new_packages(models.where("o_orderstatus = 'F'"), MODEL_URL)
    registry_sinks.approve(spark, root, closed.select("model_package_arn"))
    return registry.package_status(registry_sources.read_packages(spark, root))


def registry_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States after an approval, from those stored before it and the rows since."""
    root = fresh_path(spark, "registry")
    registry_sinks.create_registry(spark, root)
    models = _order_models(spark, sf_dir)
    registry_sinks.append_packages(root, registry.new_packages(models, MODEL_URL))
    registry_sinks.compact_packages(spark, root)
    closed = registry.new_packages(models.where("o_orderstatus = 'F'"), MODEL_URL)
    registry_sinks.approve(spark, root, closed.select("model_package_arn"))
    return registry.package_status(registry_sources.read_recent(spark, root))


def registry_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.pending(_packages(spark, sf_dir))


def registry_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of one group's packages."""
    return registry.package_status(_packages(spark, sf_dir), "BUILDING")


def approved_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = registry.latest_approved(_packages(spark, sf_dir))
    return latest.select("model_group", "version", "model_package_arn", "updated_at")


def version_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset versions before 1996 with the packages made from them."""
    models = materialize(_order_models(spark, sf_dir), "models")
    early = models.where("version < '1996'").select("version")
    made = registry.new_packages(models, MODEL_URL)
    return registry.link_versions(early, made)


def deployment_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for all packages recorded, as far as they are approved."""
    packages = _packages(spark, sf_dir)
    return jobs.deployments(packages, packages, "flower-model")


def train_and_deploy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, register, approve, name for use; what the named model says of each order."""
    root = fresh_path(spark, "project")
    rows = _priorities(spark, sf_dir)
    arn = jobs.train_and_register(
        spark,
        rows.drop("o_orderkey"),
        root,
        MODEL_URL,
        "test",
        label="o_orderpriority",
        version="2026-01-01",
    )
    chosen = spark.range(1).select(F.lit(arn).alias("model_package_arn"))
    registry_sinks.approve(spark, f"{root}/registry", chosen)
    deployed = jobs.deploy_model(spark, root, "flower-model").first()
    version = deployed["model_package_arn"].rpartition("/")[2]
    model = version_sources.model_versions(spark, f"{root}/models")[version]()
    scored = classifier.predict(model, rows, ["o_orderkey"], "o_orderpriority")
    return scored.withColumn("model_name", F.lit(deployed["model_name"]))


def stamp_and_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    shown = jobs.stamp_and_preview(spark, customer, fresh_path(spark, "stamped"), ["c_custkey"])
    return shown.drop("ts", "version")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        query_to_partitions,
        query_to_partitions_limit,
        partition_edge_values,
        select_all,
        date_parts,
        date_parts_limit,
        string_date_year,
        zone_dates,
        path_parts,
        load_timestamp,
        first_columns,
        drop_label,
        prediction_only,
        head_by_key,
        latest_per_key,
        incremental_latest,
        ordered_half,
        ordered_half_ties,
        asof_previous_event,
        asof_order_of_event,
        overlapping_orders,
        range_join,
        distributed_together,
        distributed_split,
        partitioned_roundtrip,
        pruned_partition,
        replaced_partition,
        bounded_files,
        interleaved_layout,
        query_roundtrip,
        ctas_roundtrip,
        csv_roundtrip,
        csv_text_roundtrip,
        csv_one_column,
        csv_parallel_text,
        json_roundtrip,
        json_text_roundtrip,
        latest_version,
        all_versions,
        all_versions_evolved,
        versions_from_paths,
        external_table,
        declared_csv,
        declared_parquet,
        prefix_scan,
        hash_split,
        nearest_neighbor,
        nearest_neighbor_leaves,
        nearest_neighbor_whole,
        hashed_neighbor_recall,
        accuracy,
        accuracy_whole,
        fitted_class_totals,
        fitted_feature_sums,
        train_and_score,
        batch_score,
        stream_scores,
        insert_if_absent,
        register_groups,
        groups_deduplicated,
        register_packages,
        approve_event,
        registry_compacted,
        registry_pending,
        registry_status,
        approved_latest,
        version_link,
        deployment_names,
        train_and_deploy,
        stamp_and_preview,
    )
} | {name: _sql(dataset) for name, dataset in SQL_DATASETS.items()}

"""Every operator as a query over the order/line tables of a folder: (spark, folder) -> result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import sql
from tillroll.functions import money
from tillroll.functions.labels import money_label, month_label
from tillroll.functions.predicates import SALE
from tillroll.operators import churn, clv, cohorts, duplicates, measurements, sketches, windows
from tillroll.operators import clean as cleaning
from tillroll.operators.metrics import FactSpec, customer_metrics
from tillroll.operators.rfm import rfm_at
from tillroll.params import add_months
from tillroll.plans import measures, publish, quality, report
from tillroll.plans.export import checked_document, sections
from tillroll.plans.layers import Layers, snapshot_needs
from tillroll.reference_data import segment_map, segments
from tillroll.schemas import LINE_KEY
from tillroll.sources import ingest, tables
from tillroll.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

PARAMS = tables.PARAMETERS
LOOK_BACK_MONTHS = 9
PRIORS = (0, 1, 3, 6, 12)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _layers(
    spark: SparkSession,
    folder: str,
    spec: FactSpec | None = None,
    keep: tuple[str, ...] = (),
) -> Layers:
    start, _ = tables.overlap_days(spark, folder)
    return Layers(
        tables.raw_lines(spark, folder),
        tables.codes(spark, folder),
        PARAMS,
        spec=spec,
        keep=keep,
        overlap_from=start,
    )


def _snapshot(spark: SparkSession, folder: str, keep: bool = False) -> DataFrame:
    """Customers at the end; stored when the query reads them more than once."""
    layers = _layers(
        spark, folder, spec=snapshot_needs(PARAMS), keep=("snapshot",) if keep else ()
    )
    return layers.snapshot


#: What no query reads of the stored layers, and what the checks do not read besides.
UNREAD = ("ts_utc", "description")
UNREAD_BY_CHECKS = (*UNREAD, *LINE_KEY, "country")


def _full(spark: SparkSession, folder: str, unread: tuple[str, ...] = UNREAD) -> Layers:
    """For queries over many tables: the raw lines and each layer read more than once are
    stored, as a run does."""
    workspace = Workspace(spark)
    raw = workspace.store(tables.raw_lines(spark, folder), "raw")
    start, _ = tables.overlap_days(spark, folder)
    keep = (*publish.TABLES, "invoices", "snapshot")
    return Layers(
        raw,
        tables.codes(spark, folder),
        PARAMS,
        keep=keep,
        workspace=workspace,
        overlap_from=start,
        unread=unread,
    )


def _digests(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.file_digests(spark, [f"{folder}/lineitem.parquet"])


# Lines


@query
def lines_per_sheet(spark, folder):
    return ingest.lines_per_sheet(tables.raw_lines(spark, folder))


@query
def overlap_removed(spark, folder):
    raw = tables.raw_lines(spark, folder)
    ts = F.col("invoice_date").cast("timestamp_ntz")
    start, _ = tables.overlap_days(spark, folder)
    copied = cleaning.is_overlap(PARAMS.batches, ts, start)
    return raw.agg(
        F.count_if(copied).alias("overlap_lines"), F.count_if(~copied).alias("kept_lines")
    ).withColumn("overlap_start", start)


@query
def overlap_identical(spark, folder):
    start, until = days = tables.overlap_days(spark, folder)
    raw = tables.raw_lines(spark, folder, days)
    return duplicates.overlap_difference(raw, PARAMS.batches, start, until)


@query
def clean_line(spark, folder):
    return _layers(spark, folder).clean_line.drop("source_file", "source_row")


@query
def clean_kind_totals(spark, folder):
    return measurements.kind_totals(_layers(spark, folder).clean_line)


@query
def non_product_split(spark, folder):
    lines = _layers(spark, folder).clean_line
    return lines.groupBy("is_product").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("value").cast(money.MONEY).alias("value")
    )


@query
def customer_dim(spark, folder):
    return _layers(spark, folder).customer_dim


@query
def country_counts(spark, folder):
    return measurements.countries_per_customer(_layers(spark, folder).customer_dim)


@query
def country_share(spark, folder):
    return measurements.country_share(_layers(spark, folder).customer_dim)


@query
def lineage(spark, folder):
    layers = _layers(spark, folder)
    columns = ("sheet", "source_row", "invoice", "stock_code", "quantity", "unit_price")
    beside = cleaning.lineage(layers.raw, layers.codes, PARAMS.batches, layers.overlap_from)
    return beside.select(*columns, "kind", "value", "is_product")


@query
def repeat_lines(spark, folder):
    start, _ = tables.overlap_days(spark, folder)
    raw = Workspace(spark).store(tables.raw_lines(spark, folder), "raw")
    return duplicates.cleaning_report(raw, PARAMS.batches, start)


@query
def duplicate_profile(spark, folder):
    start, _ = tables.overlap_days(spark, folder)
    workspace = Workspace(spark)
    raw = workspace.store(tables.raw_lines(spark, folder), "raw")
    layers = Layers(raw, tables.codes(spark, folder), PARAMS, workspace=workspace, overlap_from=start)
    kept = cleaning.kept_raw(raw, PARAMS.batches, start)
    # One search for both: the lines that may repeat another one are few, and kept.
    repeated = workspace.store(duplicates.repeated_rows(kept), "repeated")
    report_ = duplicates.cleaning_report(raw, PARAMS.batches, start, repeated)
    pairs = duplicates.repeated_pairs(layers.clean_line)
    pair_counts = pairs.select(F.struct("*")).scalar()
    return report_.select(
        "overlap_lines",
        "repeats_kept",
        duplicates.adjacent_repeats(kept, repeated).scalar().alias("adjacent_repeats"),
        pair_counts.getField("repeated_pairs").alias("repeated_pairs"),
        pair_counts.getField("pairs_with_other_quantity").alias("pairs_with_other_quantity"),
    )


@query
def non_product_revenue(spark, folder):
    layers = _layers(spark, folder)
    return measurements.non_product_revenue(layers.clean_line, layers.codes)


@query
def order_medians(spark, folder):
    return measurements.order_medians(measurements.sold_products(_layers(spark, folder).clean_line))


# Orders and customers


@query
def orders(spark, folder):
    return _layers(spark, folder).orders


@query
def customer_metrics_end(spark, folder):
    return customer_metrics(_layers(spark, folder).orders, PARAMS.end)


@query
def customer_metrics_cutoff(spark, folder):
    return customer_metrics(_layers(spark, folder).orders, PARAMS.cutoff)


@query
def rfm_scores(spark, folder):
    layers = _layers(spark, folder, spec=FactSpec.of(refs=[PARAMS.end]))
    scored = rfm_at(layers.facts, PARAMS.end, PARAMS.wholesale_units, limits=layers.limits)
    return scored.select(
        "customer_id",
        "recency_days",
        "frequency",
        "net_revenue",
        "r",
        "f",
        "m",
        "segment",
        "is_wholesale",
        "net_not_positive",
    )


@query
def customer_snapshot(spark, folder):
    return _layers(spark, folder, spec=snapshot_needs(PARAMS)).customer


@query
def customer_view(spark, folder):
    return report.customer_view(_snapshot(spark, folder))


@query
def segment_summary(spark, folder):
    return report.segment_summary(_snapshot(spark, folder))


@query
def segment_summary_wholesale(spark, folder):
    return report.segment_summary(report.in_profile(_snapshot(spark, folder), report.WHOLESALE))


@query
def profile_split(spark, folder):
    return report.profile_split(_snapshot(spark, folder))


@query
def score_distribution(spark, folder):
    layers = _layers(spark, folder, spec=FactSpec.of(refs=[PARAMS.end]))
    scored = rfm_at(layers.facts, PARAMS.end, PARAMS.wholesale_units, limits=layers.limits)
    return measurements.score_distribution(scored)


@query
def unit_quantiles(spark, folder):
    return measurements.units_quantiles(customer_metrics_end(spark, folder))


@query
def top10_share(spark, folder):
    return measurements.top10_share(customer_metrics_end(spark, folder))


# The same functions as an analyst calls them in SQL


def _sql(spark: SparkSession, folder: str, select: str) -> DataFrame:
    sql.register(spark, _layers(spark, folder, keep=("orders",)).orders, PARAMS)
    return spark.sql(select)


@query
def sql_customer_metrics(spark, folder):
    return _sql(spark, folder, f"SELECT * FROM customer_metrics(DATE '{PARAMS.cutoff}')")


@query
def sql_rfm(spark, folder):
    columns = "customer_id, recency_days, frequency, net_revenue, r, f, m, segment, is_wholesale, net_not_positive"
    return _sql(spark, folder, f"SELECT {columns} FROM rfm(DATE '{PARAMS.end}')")


@query
def sql_validate_churn(spark, folder):
    days = ", ".join(map(str, PARAMS.churn_thresholds))
    call = f"validate_churn(DATE '{PARAMS.cutoff}', {PARAMS.churn_window_months}, array({days}))"
    return _sql(spark, folder, f"SELECT * FROM {call}")


@query
def sql_segment_retention(spark, folder):
    start = add_months(PARAMS.end, -12).date()
    call = f"segment_retention(DATE '{start}', {PARAMS.clv_horizon_months})"
    return _sql(spark, folder, f"SELECT * FROM {call}")


@query
def sql_predict_clv(spark, folder):
    call = f"predict_clv(DATE '{PARAMS.end}', {PARAMS.clv_horizon_months})"
    return _sql(spark, folder, f"SELECT * FROM {call}")


# Churn


@query
def purchase_intervals(spark, folder):
    return churn.purchase_intervals(_layers(spark, folder, keep=("orders",)).orders)


@query
def interval_percentiles(spark, folder):
    return measurements.interval_percentiles(_layers(spark, folder, keep=("orders",)).orders)


@query
def churn_validation(spark, folder):
    orders_ = _layers(spark, folder).orders
    facts = churn.customer_facts(orders_, churn.needs(PARAMS))
    return churn.churn_validation(facts, PARAMS)


@query
def churn_band(spark, folder):
    orders_ = _layers(spark, folder).orders
    facts = churn.customer_facts(orders_, churn.needs(PARAMS))
    return churn.churn_bands(facts, PARAMS)


@query
def returns_in_windows(spark, folder):
    """Returns in every window of one to six months that begins with a month of the base."""
    orders_ = _layers(spark, folder, keep=("orders",)).orders
    starts = orders_.select(F.explode(F.sequence(F.lit(1), F.lit(6))).alias("months"), "month").distinct()
    start = F.col("month").cast("timestamp_ntz")
    made = starts.select(
        F.concat_ws("+", F.col("month").cast("string"), "months").alias("id"),
        start.alias("start"),
        (start + F.make_ym_interval(F.lit(0), F.col("months"))).alias("end"),
    )
    return windows.returns_in_windows(orders_, Workspace(spark).store(made, "windows"))


@query
def idle_bands(spark, folder):
    """Customers by bands of seven idle days, held in a table that follows the data."""
    people = _snapshot(spark, folder, keep=True).select("recency_days", "net_revenue")
    most = people.agg(F.max("recency_days")).first()[0] or 0
    bands = spark.range(0, most // 7 + 2).select(
        F.col("id").alias("band"), (F.col("id") * 7).alias("from_"), (F.col("id") * 7 + 6).alias("upto")
    )
    banded = windows.in_bands(people, "recency_days", bands)
    return banded.groupBy("band").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("net_revenue").cast(money.MONEY).alias("net_revenue")
    )


@query
def sketched_order_values(spark, folder):
    """Percentiles of orders' product revenue by quarter, from sketches by month. Exact up to
    sketches.K orders a quarter, within sketches.rank_error() of its orders beyond."""
    orders_ = _layers(spark, folder).orders.filter("is_purchase")
    values = orders_.select("month", money.thousandths(F.col("product_revenue")).alias("v"))
    by_month = Workspace(spark).store(sketches.sketched(values, ["month"]), "sketches")
    quarter = F.trunc("month", "quarter").alias("quarter")
    quarters = sketches.merged(by_month.select("*", quarter), ["quarter"])
    return sketches.percentiles(quarters, (25, 50, 90))


@query
def churn_status(spark, folder):
    return report.status_summary(_snapshot(spark, folder))


@query
def risk_priority(spark, folder):
    return measurements.risk_priority(_snapshot(spark, folder))


@query
def first_return_months(spark, folder):
    return measurements.first_return_months(
        _layers(spark, folder).orders, PARAMS.robustness_cutoff
    )


# Cohorts and months


@query
def cohort_retention(spark, folder):
    return _layers(spark, folder).cohort_retention


@query
def cohort_arrays(spark, folder):
    return cohorts.cohort_arrays(_layers(spark, folder, keep=("orders",)).orders)


@query
def cohort_flags(spark, folder):
    return cohorts.cohort_flags(_layers(spark, folder, keep=("orders",)).cohort_retention)


@query
def cohort_matrix(spark, folder):
    return cohorts.cohort_matrix(_layers(spark, folder).cohort_retention)


@query
def retention_curve(spark, folder):
    return cohorts.retention_curve(_layers(spark, folder).cohort_retention)


@query
def monthly_revenue(spark, folder):
    return cohorts.monthly_revenue(_layers(spark, folder).orders, PARAMS.end)


@query
def monthly_labels(spark, folder):
    months = monthly_revenue(spark, folder)
    return months.select(
        "month",
        month_label(F.col("month")).alias("month_label"),
        money_label(F.col("net_product_revenue")).alias("revenue_label"),
    )


@query
def new_customers_censored(spark, folder):
    return measurements.new_customers_censored(_layers(spark, folder).orders, LOOK_BACK_MONTHS)


# Customer value


@query
def segment_retention(spark, folder):
    start = add_months(PARAMS.end, -12)
    months = PARAMS.clv_horizon_months
    spec = FactSpec.of(refs=[start], returns=[(start, add_months(start, months))])
    layers = _layers(spark, folder, spec=spec)
    return clv.segment_retention(
        layers.facts, start, months, PARAMS.wholesale_units, layers.limits
    )


@query
def clv_predicted(spark, folder):
    spec = clv.needs(PARAMS.end, PARAMS.clv_horizon_months)
    layers = _layers(spark, folder, spec=spec)
    return clv.predict_clv(
        layers.facts, PARAMS.end, PARAMS.clv_horizon_months, PARAMS, limits=layers.limits
    )


def _validation_layers(spark: SparkSession, folder: str) -> Layers:
    return _layers(spark, folder, spec=clv.validation_needs(PARAMS))


@query
def clv_validation_customer(spark, folder):
    layers = _validation_layers(spark, folder)
    return clv.clv_validation_customer(layers.facts, PARAMS, layers.limits)


@query
def clv_validation(spark, folder):
    return _validation_layers(spark, folder).clv_validation


@query
def clv_bias(spark, folder):
    return measurements.clv_bias(clv_validation_customer(spark, folder))


@query
def clv_by_segment(spark, folder):
    return report.clv_by_segment(clv_validation_customer(spark, folder))


@query
def clv_sensitivity(spark, folder):
    layers = _validation_layers(spark, folder)
    estimates = clv.estimates_by_prior(layers.facts, PARAMS, PRIORS, layers.limits)
    return clv.clv_sensitivity(layers.workspace.store(estimates, "estimates"), PRIORS)


@query
def clv_summary(spark, folder):
    return measurements.clv_summary(_snapshot(spark, folder, keep=True))


@query
def clv_top20_share(spark, folder):
    return measurements.clv_top20_share(_snapshot(spark, folder))


# Checks, reports, export


def _quality(layers: Layers, folder: str, known_anomalies: bool = False) -> DataFrame:
    """The checks; the load's entry counts the lines as they are read, not as they were stored."""
    spark = layers.spark
    lines = tables.raw_lines(spark, folder)
    return quality.check_quality(
        raw=layers.raw,
        load_log=ingest.load_entry(lines, _digests(spark, folder), "this load"),
        lines=layers.clean_line,
        invoices=layers.invoices,
        orders=layers.orders,
        customer=layers.snapshot,
        cohorts=layers.cohort_retention,
        churn_validation=layers.churn_validation,
        params=PARAMS,
        known_anomalies=tables.known_anomalies(spark, folder) if known_anomalies else None,
        overlap_from=layers.overlap_from,
    )


def _checked(
    spark: SparkSession, folder: str, known_anomalies: bool = False
) -> tuple[Layers, DataFrame]:
    layers = _full(spark, folder, UNREAD_BY_CHECKS)
    return layers, layers.workspace.store(_quality(layers, folder, known_anomalies), "quality")


@query
def dq_checks(spark, folder):
    return _quality(_full(spark, folder, UNREAD_BY_CHECKS), folder)


@query
def checks_card(spark, folder):
    return measures.checks_card(_quality(_full(spark, folder, UNREAD_BY_CHECKS), folder))


@query
def invariants(spark, folder):
    layers = _full(spark, folder)
    return quality.check_rules(
        lines=layers.clean_line,
        orders=layers.orders,
        customer=layers.customer,
        churn_validation=layers.churn_validation,
        churn_band=layers.churn_band,
        cohorts=layers.cohort_retention,
        clv_validation_customer=layers.clv_validation_customer,
        clv_validation=layers.clv_validation,
        params=PARAMS,
    )


@query
def rejected_rows(spark, folder):
    """The lines and orders that a shop would reject which takes nothing back and whose customer
    numbers begin at 10,050."""
    strict = replace(PARAMS.formats, invoice=r"A?[0-9]{6,}", customer_id_range=(10_050, 10**12))
    layers = _layers(spark, folder)
    rules = quality.table_rules(PARAMS.with_(formats=strict))
    lines = replace(rules["clean_line"], key=("sheet", "invoice", "stock_code", "quantity"))
    orders = replace(rules["orders"], rules=[*quality.order_rules(), ("is a sale", F.col("kind") == SALE)])
    found = quality.rejected_rows(lines, layers.clean_line)
    found = found.unionByName(quality.rejected_rows(orders, layers.orders))
    return found.withColumn("rules", F.array_join("rules", "; "))


@query
def headline(spark, folder):
    layers, checked = _checked(spark, folder)
    monthly = layers.workspace.store(
        cohorts.monthly_revenue(layers.orders, PARAMS.end), "monthly_revenue"
    )
    return report.headline(monthly, layers.snapshot, checked)


@query
def bi_measures(spark, folder):
    layers, checked = _checked(spark, folder)
    return measures.measures(
        monthly=cohorts.monthly_revenue(layers.orders, PARAMS.end),
        customers=layers.snapshot,
        churn_validation=layers.churn_validation,
        churn_band=layers.churn_band,
        cohorts=layers.cohort_retention,
        clv_validation_customer=layers.clv_validation_customer,
        quality=checked,
        params=PARAMS,
    )


@query
def bi_measures_by_profile(spark, folder):
    return measures.by_profile(_snapshot(spark, folder, keep=True), measures.customer_measures)


@query
def segment_shares_by_profile(spark, folder):
    return measures.by_profile(_snapshot(spark, folder, keep=True), measures.segment_shares)


@query
def export_document(spark, folder):
    """Refused, with no rows, unless every check passes; the anomalies that the tables' rules
    make on purpose are known ones."""
    layers, checked = _checked(spark, folder, known_anomalies=True)
    return checked_document(
        sections(
            raw=layers.raw,
            orders=layers.orders,
            customer=layers.snapshot,
            churn_validation=layers.churn_validation,
            churn_band=layers.churn_band,
            cohorts=layers.cohort_retention,
            clv_validation=layers.clv_validation,
            clv_validation_customer=layers.clv_validation_customer,
            quality=checked,
            params=PARAMS,
            overlap_from=layers.overlap_from,
        ),
        checked,
    )


@query
def load_log(spark, folder):
    """Line count of each file, as a load registers it; the digest as whether it is one."""
    entry = ingest.load_entry(tables.raw_lines(spark, folder), _digests(spark, folder), "this load")
    has_digest = F.col("sha256").rlike(r"\A[0-9a-f]{64}\z")
    return entry.select("load_id", "name", "rows", has_digest.alias("has_digest"))


@query
def published_run(spark, folder):
    """Load, build, check, publish, and the rows of each table that a reader then finds."""
    root = f"{Workspace(spark).folder}/published"
    raw = ingest.register(tables.raw_lines(spark, folder), _digests(spark, folder), root)
    publish.process(
        raw,
        tables.codes(spark, folder),
        ingest.load_log(spark, root),
        PARAMS,
        root,
        tables.known_anomalies(spark, folder),
    )
    run = publish.current(spark, root)
    counts = [
        run.table(name).agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
        for name in (*publish.TABLES, *publish.REFERENCE_TABLES, "quality")
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def snapshot_difference(spark, folder):
    """The stored scores of a full build against the function at the same date, both ways."""
    layers = _full(spark, folder)
    columns = ("customer_id", "recency_days", "frequency", "net_revenue", "r", "f", "m", "segment")
    sql.register(spark, layers.orders, PARAMS)
    again = spark.sql(f"SELECT {', '.join(columns)} FROM rfm(DATE '{PARAMS.end}')")
    found = duplicates.set_difference(layers.customer.select(*columns), again)
    return found.agg(
        F.count_if(F.col("side") == "left").alias("only_stored"),
        F.count_if(F.col("side") == "right").alias("only_computed"),
    )


@query
def sale_changes(spark, folder):
    """Customers' months of purchase before the cut-off and after it, as sets: what left, what came."""
    orders_ = _layers(spark, folder, keep=("orders",)).orders.filter("is_purchase AND customer_id IS NOT NULL")
    part = orders_.select("customer_id", F.month("month").alias("month"), "ts_local")
    cut = F.lit(PARAMS.cutoff).cast("timestamp_ntz")
    before, after = part.filter(F.col("ts_local") < cut), part.filter(F.col("ts_local") >= cut)
    return duplicates.set_difference(before.drop("ts_local"), after.drop("ts_local"))


@query
def segment_map_rules(spark, folder):
    """The map over the scores that customers have: every one has a segment, and a segment's
    place never falls as a score rises."""
    cells = segment_map(spark).join(segments(spark), "segment")
    scored = _snapshot(spark, folder).groupBy("r", "f").agg(F.count(F.lit(1)).alias("customers"))
    found = scored.join(F.broadcast(cells), ["r", "f"], "left")
    return found.select("r", "f", "segment", "segment_order", "customers")



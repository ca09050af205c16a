"""One run: build every table, check it, and publish it only when all checks and row rules hold.

Tables are written under a run id and nothing is overwritten. A commit log (see commits.py) names
the runs that passed, in one order whatever the clocks of their drivers; readers take its newest
entry. A failed run is never named, so the last good one stays current, and its check results stay
in its folder for diagnosis until remove_unpublished takes it away.
"""

from __future__ import annotations

import uuid
import zlib
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.commits import Commit, CommitLog
from tillroll.params import Parameters
from tillroll.plans.layers import Layers
from tillroll.plans.quality import Counted, Watch, check_quality, check_rules, rejected_rows, table_rules
from tillroll.workspace import Workspace
from tillroll.reference_data import parameter_table, segment_map, segments

TABLES = (
    "clean_line",
    "customer_dim",
    "orders",
    "customer",
    "churn_validation",
    "churn_band",
    "cohort_retention",
    "clv_validation_customer",
    "clv_validation",
)
# What the rows of a large table are sorted by inside each file, so that readers skip row groups
# of other days or customers. Sorting a task's own rows needs no shuffle.
SORTED_BY = {"clean_line": "ts_local", "orders": "customer_id"}
REFERENCE_TABLES = ("parameter", "segment_map", "segment", "non_product_code")


class QualityError(RuntimeError):
    """A run failed its checks or broke a row rule, and was not published."""


# Tables stored by customer: customers are dealt to the same buckets in all of them, so grouping
# or joining them by customer shuffles nothing.
BY_CUSTOMER = ("customer_dim", "orders", "facts", "customer")
# Orders of a bucket, about; also the most orders that one customer may have in it.
BUCKET_ROWS = 4_000_000
# Where the orders without a customer lie, which no bucket could hold.
UNKNOWN = "orders_without_customer"


class Run(Workspace):
    """The tables of one run, below <root>/runs/<run id>. Row rules are counted while a table that
    has some is written; `counted` has what was found. With `buckets`, the tables of BY_CUSTOMER
    are stored by customer."""

    def __init__(
        self, spark: SparkSession, root: str, run_id: str, params: Parameters | None = None, buckets: int = 0
    ):
        self.spark = spark
        self.root, self.run_id = root, run_id
        self.folder = f"{root}/runs/{run_id}"
        self.params, self.buckets = params, buckets
        self.rules = table_rules(params) if params else {}
        self.counted: dict[str, Counted] = {}

    def lay_out(self, invoices: DataFrame) -> None:
        """Chooses the number of buckets from the counted orders. If one customer alone has more
        orders than a bucket may hold, tables are stored plainly: grouping then merges on the map
        side, and no task reads all of that customer's orders."""
        orders = invoices.filter("lines > 0 AND customer_id IS NOT NULL").groupBy("customer_id").count()
        found = orders.agg(F.sum("count").alias("n"), F.max("count").alias("most")).first()
        least = min(self.spark.sparkContext.defaultParallelism, 200)
        fits = (found.most or 0) <= BUCKET_ROWS
        self.buckets = max(-(-(found.n or 0) // BUCKET_ROWS), least) if fits else 0

    def store(self, frame: DataFrame, name: str) -> DataFrame:
        if not (self.buckets and name in BY_CUSTOMER):
            if name in SORTED_BY:
                frame = frame.sortWithinPartitions(SORTED_BY[name])
            return self._write(frame, name, lambda own: super(Run, self).store(own, name))
        if name == "orders":
            known = F.col("customer_id").isNotNull()
            self._write(frame.filter(~known), name, lambda own: super(Run, self).store(own, UNKNOWN))
            frame = frame.filter(known)
        by = frame.repartition(self.buckets, "customer_id")  # no shuffle where it is so already
        self._write(by, name, lambda own: self._bucketed(own, name))
        return self.table(name)

    def _write(self, frame: DataFrame, name: str, write):
        if name not in self.rules:
            return write(frame)
        watch = Watch(self.rules[name], self.params)
        stored = write(watch.on(frame))
        own = watch.counted()
        self.counted[name] = self.counted[name].plus(own) if name in self.counted else own
        return stored

    def _listed(self, name: str) -> str:
        # With its place, as a session may know runs of one id below several roots.
        return f"tillroll_{self.run_id}_{zlib.crc32(self.folder.encode()):08x}_{name}"

    def _bucketed(self, frame: DataFrame, name: str) -> None:
        writer = frame.write.format("parquet").mode("error").option("path", self.path(name))
        writer.bucketBy(self.buckets, "customer_id").sortBy("customer_id").saveAsTable(self._listed(name))

    def table(self, name: str) -> DataFrame:
        if not (self.buckets and name in BY_CUSTOMER):
            return self.spark.read.parquet(self.path(name))
        listed = self._listed(name)
        if not self.spark.catalog.tableExists(listed):
            # Another session wrote it: files alone do not say how they are dealt.
            columns = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(self.path(name)).schema
            )
            place = self.path(name).replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {listed} ({columns}) USING parquet CLUSTERED BY (customer_id) "
                f"SORTED BY (customer_id) INTO {self.buckets} BUCKETS LOCATION '{place}'"
            )
        known = self.spark.table(listed)
        if name != "orders":
            return known
        unknown = self.spark.read.schema(known.schema).parquet(self.path(UNKNOWN))
        # The literal lets plans over known customers leave this part out.
        return known.unionByName(unknown.withColumn("customer_id", F.lit(None).cast("bigint")))

    def reject(self) -> int:
        """Writes the rows that break a rule, with the names of the rules, as rejected_rows; how
        many there are. Reads only tables with such rows."""
        broken = [n for n, own in self.counted.items() if any(own.violations.values())]
        if not broken:
            return 0
        parts = [rejected_rows(self.rules[name], self.table(name)) for name in sorted(broken)]
        return self.store(reduce(DataFrame.unionByName, parts), "rejected_rows").count()


def run_layers(raw: DataFrame, codes: DataFrame, params: Parameters, run: Workspace) -> Layers:
    """Layers that write each published table once; later ones read the stored tables."""
    return Layers(raw, codes, params, keep=(*TABLES, "invoices"), workspace=run)


def quality_of(
    layers: Layers, load_log: DataFrame, known_anomalies: DataFrame | None = None
) -> DataFrame:
    return check_quality(
        raw=layers.raw,
        load_log=load_log,
        lines=layers.clean_line,
        invoices=layers.invoices,
        orders=layers.orders,
        customer=layers.customer,
        cohorts=layers.cohort_retention,
        churn_validation=layers.churn_validation,
        params=layers.params,
        known_anomalies=known_anomalies,
        overlap_from=layers.overlap_from,
        counted=_counted(layers),
    )


def _counted(layers: Layers) -> dict[str, Counted]:
    return layers.workspace.counted if isinstance(layers.workspace, Run) else {}


def rules_of(layers: Layers) -> DataFrame:
    return check_rules(
        lines=layers.clean_line,
        orders=layers.orders,
        customer=layers.customer,
        churn_validation=layers.churn_validation,
        churn_band=layers.churn_band,
        cohorts=layers.cohort_retention,
        clv_validation_customer=layers.clv_validation_customer,
        clv_validation=layers.clv_validation,
        params=layers.params,
        counted=_counted(layers),
    )


# Tables of one step do not depend on each other; each step needs the ones before it.
STEPS = (
    ("clean_line",),
    ("invoices",),
    ("customer_dim", "orders"),
    ("facts", "cohort_retention"),
    ("limits",),
    ("customer", "churn_validation", "churn_band", "clv_validation_customer"),
    ("clv_validation",),
)


def build(layers: Layers) -> None:
    """Write every table. The jobs of one step run side by side, so that the tail of one leaves
    no executors idle."""
    with ThreadPoolExecutor(max_workers=max(map(len, STEPS))) as pool:
        for step in STEPS:
            list(pool.map(inheritable_thread_target(layers.spark)(layers.table), step))
            if step == ("invoices",) and isinstance(layers.workspace, Run):
                layers.workspace.lay_out(layers.invoices)


def process(
    raw: DataFrame,
    codes: DataFrame,
    load_log: DataFrame,
    params: Parameters,
    root: str,
    known_anomalies: DataFrame | None = None,
    after: int | None = None,
) -> Run:
    """Raw lines to published tables. Raises QualityError, and publishes nothing, when a check
    fails or a row breaks a rule of its table. A cell that does not parse fails the job.

    Runs that publish at the same time are ordered by the numbers of their commits. With `after`
    (the number of the last run that the caller knows of) a run is refused with CommitConflict
    if another one was published since.
    """
    spark = raw.sparkSession
    run = Run(spark, root, uuid.uuid4().hex, params)
    layers = run_layers(raw, codes, params, run)
    build(layers)
    run.store(parameter_table(spark, params), "parameter")
    run.store(segment_map(spark), "segment_map")
    run.store(segments(spark), "segment")
    run.store(codes, "non_product_code")
    checked = quality_of(layers, load_log, known_anomalies).withColumn("checked_at", F.current_timestamp())
    results = run.store(checked, "quality")
    rules = run.store(rules_of(layers), "row_rules")
    failed = results.filter(~F.col("ok")).select("check", "expected", "obtained").collect()
    broken = rules.filter("violations > 0").collect()
    if failed or broken:
        listed = [f"{r.check}: expected {r.expected}, obtained {r.obtained}" for r in failed]
        listed += [f"{r.table}, {r.rule}: {r.violations} rows" for r in broken]
        if rejected := run.reject():
            listed.append(f"{rejected} rows listed in {run.path('rejected_rows')}")
        raise QualityError(f"run {run.run_id} not published: {'; '.join(listed)}")
    publish(run, after)
    return run


def log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root}/published")


def publish(run: Run, after: int | None = None) -> Commit:
    """Enter the run in the commit log: one small file, visible all at once or not at all."""
    names = (*TABLES, *REFERENCE_TABLES, "quality", "row_rules")
    return log(run.spark, run.root).commit(
        run.run_id, {"tables": ",".join(names), "buckets": str(run.buckets)}, after
    )


def current(spark: SparkSession, root: str) -> Run:
    """The newest published run."""
    newest = log(spark, root).newest()
    if newest is None:
        raise LookupError(f"no run is published below {root}")
    return Run(spark, root, newest.id, buckets=int(newest.facts["buckets"]))


def published(spark: SparkSession, root: str) -> DataFrame:
    """number, run_id, committed_at, facts: every published run."""
    return log(spark, root).entries().withColumnRenamed("id", "run_id")


def remove_unpublished(spark: SparkSession, root: str, older_than_hours: float = 7 * 24) -> list[str]:
    """Removes the folders of runs that were refused or broke off, and wrote nothing for so long."""
    return log(spark, root).remove_uncommitted(f"{root}/runs", older_than_hours)

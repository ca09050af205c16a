"""The eighteen checks across layers, and the row rules of each table.

Checks over one table are aggregates of one pass. Each pass gives rows (check, side, text);
the sides meet in a final grouping of a few dozen rows, so no table is joined with another. Row
rules and the checks over single clean lines are counted by the job that writes the table; only
when a rule is broken is the table read again, for the rows that break it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.functions import money
from tillroll.functions.predicates import (
    CANCEL,
    DEBT_ADJUST,
    KINDS,
    NO_VALUE,
    SALE,
    counts_as_revenue,
    matches,
)
from tillroll.operators.clean import is_overlap, overlap_start
from tillroll.operators.duplicates import overlap_difference, repeated_rows
from tillroll.params import Parameters
from tillroll.reference_data import MODELS, SEGMENTS, literal_table
from tillroll.schemas import LINE_KEY

EMPTY = "(empty)"
BALANCE_LIMIT = "<= 1.10"

# The checks, their layer and what they compare.
CHECKS = [
    ("raw_lines_of_last_load", "raw", "raw lines = lines recorded by the last load"),
    ("raw_formats", "raw", "lines with a malformed invoice, quantity, price, date or customer"),
    ("overlap_identical", "clean", "overlap lines that only one of the batches holds"),
    ("clean_lines", "clean", "clean lines = raw lines - overlap"),
    ("clean_value_conserved", "clean", "sum of quantity x price: raw without overlap = clean"),
    ("clean_new_anomalies", "clean", "anomalies beyond the known ones"),
    ("clean_unclassified_codes", "clean", "codes neither in product format nor listed"),
    ("clean_ambiguous_hour", "clean", "lines in the hour that daylight saving repeats or skips"),
    ("clean_invoice_one_customer", "clean", "invoices with more than one customer"),
    ("clean_invoice_mixed", "clean", "invoices with and without a customer"),
    ("orders_sum_to_clean", "analysis", "sum of orders = sum of sale and cancel lines"),
    ("customers_with_purchase", "analysis", "customers = customers with a purchase"),
    ("net_revenue_agrees", "analysis", "net revenue of customers = that of their orders"),
    ("cohorts_sum_to_customers", "analysis", "cohort sizes add up to the customers"),
    ("cohort_revenue_agrees", "analysis", "cohort revenue = net revenue of customers"),
    ("scores_r_and_m_balanced", "analysis", "largest / smallest group of the R and M scores"),
    ("clv_filled", "analysis", "customers without an expected value or churn flag"),
    ("churn_validated_at_both_cutoffs", "analysis", "cut-offs with the chosen rule validated"),
]

EXPECTED, OBTAINED = "expected", "obtained"


def _text(value: Column) -> Column:
    return value.cast("string")


def _sum3(value: Column) -> Column:
    """A total with three decimals, as text."""
    return _text(F.sum(value).cast("decimal(34,3)"))


def _facts(frame: DataFrame, entries: list[tuple[str, str, Column]]) -> DataFrame:
    """One pass over a table: each entry is an aggregate, returned as its own row."""
    names = [f"c{i}" for i in range(len(entries))]
    totals = frame.agg(*[_text(value).alias(n) for n, (_, _, value) in zip(names, entries)])
    rows = [
        F.struct(F.lit(check).alias("check"), F.lit(side).alias("side"), F.col(n).alias("value"))
        for n, (check, side, _) in zip(names, entries)
    ]
    return totals.select(F.inline(F.array(*rows)))


def _raw_checks(raw: DataFrame, params: Parameters, start: Column) -> DataFrame:
    formats, batches = params.formats, params.batches
    good = (
        matches(F.col("invoice"), formats.invoice)
        & matches(F.col("quantity"), formats.quantity)
        & matches(F.col("unit_price"), formats.unit_price)
        & matches(F.col("invoice_date"), formats.invoice_date)
        & (F.col("customer_id").isNull() | matches(F.col("customer_id"), formats.customer_id))
    )
    ts = F.col("invoice_date").cast("timestamp_ntz")
    copied = is_overlap(batches, ts, start)
    value = F.col("quantity").cast("decimal(12,0)") * F.col("unit_price").cast(money.PRICE)
    lines = raw.select(good.alias("good"), copied.alias("copied"), value.alias("value"))
    return _facts(
        lines,
        [
            ("raw_lines_of_last_load", OBTAINED, F.count(F.lit(1))),
            ("raw_formats", OBTAINED, F.count_if(~F.col("good"))),
            ("clean_lines", EXPECTED, F.count(F.lit(1)) - F.count_if("copied")),
            ("clean_value_conserved", EXPECTED, _sum3(F.when(~F.col("copied"), F.col("value")))),
        ],
    )


def _anomaly_checks(
    invoices: DataFrame, params: Parameters, known_anomalies: DataFrame | None
) -> DataFrame:
    """Anomalous lines on invoices that are not known for one, by parameter or by a list. A line
    without an invoice is not known."""
    odd = invoices.filter(F.col("anomalies") > 0)
    if params.known_anomalies:
        known = F.coalesce(F.col("invoice").isin(*params.known_anomalies), F.lit(False))
        odd = odd.filter(~known)
    if known_anomalies is not None:
        odd = odd.join(known_anomalies.select("invoice"), "invoice", "left_anti")
    total = F.coalesce(F.sum("anomalies"), F.lit(0))
    return _facts(odd, [("clean_new_anomalies", OBTAINED, total)])


def _odd_code(params: Parameters) -> Column:
    """A code that is a product by the list but does not look like one."""
    formats, code = params.formats, F.col("stock_code")
    odd = F.col("is_product") & ~matches(code, formats.product_code)
    for prefix in formats.product_code_prefixes:
        odd = odd & ~code.startswith(prefix)
    return odd & ~code.isin(*formats.product_code_exceptions)


def clean_sides() -> list[tuple[str, str, Column]]:
    """Every check over single lines that adds up over the parts of a table."""
    traded = F.col("kind").isin(SALE, CANCEL)
    return [
        ("clean_lines", OBTAINED, F.count(F.lit(1))),
        ("clean_value_conserved", OBTAINED, _sum3(F.col("value"))),
        ("clean_ambiguous_hour", OBTAINED, F.count_if(F.hour("ts_local") == 1)),
        ("orders_sum_to_clean", EXPECTED, _sum3(F.when(traded, F.col("value")))),
    ]


def _clean_checks(lines: DataFrame, params: Parameters, counted: Counted | None) -> DataFrame:
    """Every check over single lines, in one pass, or as counted when the lines were written. An
    odd code is counted once, however many lines have it; that takes a pass only if there are any."""
    codes = ("clean_unclassified_codes", OBTAINED, F.count_distinct(F.when(_odd_code(params), F.col("stock_code"))))
    if counted is None:
        return _facts(lines, [*clean_sides(), codes])
    rows = [(check, side, counted.sides[check]) for check, side, _ in clean_sides()]
    if not counted.odd_lines:
        rows.append((*codes[:2], "0"))
    known = literal_table(lines.sparkSession, "check string, side string, value string", rows)
    return known.unionByName(_facts(lines, [codes])) if counted.odd_lines else known


def _invoice_checks(invoices: DataFrame) -> DataFrame:
    """Smallest and largest customer instead of a distinct count: both merge on the map side."""
    known = F.col("lines_with_customer")
    mixed = (known > 0) & (known < F.col("all_lines"))
    several = F.col("least_customer") != F.col("most_customer")
    return _facts(
        invoices,
        [
            ("clean_invoice_one_customer", OBTAINED, F.count_if(several)),
            ("clean_invoice_mixed", OBTAINED, F.count_if(mixed)),
        ],
    )


def _order_checks(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders are merged per customer before they meet the snapshot; those without a customer are
    one sum of their own. Tables that are stored by customer are not shuffled for it."""
    revenue, known = F.col("product_revenue"), F.col("customer_id").isNotNull()
    counted = counts_as_revenue(F.col("kind"), F.col("is_purchase"))
    totals = [
        F.count_if("is_purchase").alias("purchases"),
        F.sum(F.when(counted, revenue)).alias("net"),
        F.sum(revenue + F.col("other_revenue")).alias("everything"),
    ]
    listed = customer.select("customer_id", F.lit(True).alias("listed"))
    per_customer = orders.filter(known).groupBy("customer_id").agg(*totals).join(listed, "customer_id", "left")
    unknown = orders.filter(~known).agg(*totals)
    return _facts(
        per_customer.unionByName(unknown, allowMissingColumns=True),
        [
            ("orders_sum_to_clean", OBTAINED, _sum3(F.col("everything"))),
            (
                "customers_with_purchase",
                EXPECTED,
                F.count_if(known & (F.col("purchases") > 0)),
            ),
            ("net_revenue_agrees", EXPECTED, _sum3(F.when(F.col("listed"), F.col("net")))),
        ],
    )


def _group_ratio(score: str) -> Column:
    """Largest over smallest group of a score, groups without customers left out."""
    sizes = [F.count_if(F.col(score) == value) for value in range(1, 6)]
    largest = F.greatest(*sizes)
    smallest = F.least(*[F.when(size > 0, size) for size in sizes])
    return money.ratio(largest, smallest, 2, 10)


def _customer_checks(customer: DataFrame) -> DataFrame:
    unfilled = F.col("clv_6m").isNull() | F.col("is_churned").isNull()
    net = F.sum("net_revenue").cast("decimal(34,3)")
    return _facts(
        customer,
        [
            ("customers_with_purchase", OBTAINED, F.count(F.lit(1))),
            ("net_revenue_agrees", OBTAINED, _sum3(F.col("net_revenue"))),
            ("cohorts_sum_to_customers", EXPECTED, F.count(F.lit(1))),
            ("cohort_revenue_agrees", EXPECTED, F.coalesce(_text(net), F.lit("0"))),
            (
                "scores_r_and_m_balanced",
                OBTAINED,
                F.coalesce(
                    F.greatest(_group_ratio("r"), _group_ratio("m")), F.lit(0).cast("decimal(10,2)")
                ),
            ),
            ("clv_filled", OBTAINED, F.count_if(unfilled)),
        ],
    )


def _cohort_checks(cohorts: DataFrame) -> DataFrame:
    size = F.coalesce(F.sum(F.when(F.col("months_since") == 0, F.col("size"))), F.lit(0))
    net = F.sum("net_revenue").cast("decimal(34,3)")
    return _facts(
        cohorts,
        [
            ("cohorts_sum_to_customers", OBTAINED, size),
            ("cohort_revenue_agrees", OBTAINED, F.coalesce(_text(net), F.lit("0"))),
        ],
    )


def _constants(frame: DataFrame) -> DataFrame:
    zero = (
        "raw_formats",
        "overlap_identical",
        "clean_new_anomalies",
        "clean_unclassified_codes",
        "clean_ambiguous_hour",
        "clean_invoice_one_customer",
        "clean_invoice_mixed",
        "clv_filled",
    )
    rows = [(check, EXPECTED, "0") for check in zero]
    rows.append(("scores_r_and_m_balanced", EXPECTED, BALANCE_LIMIT))
    rows.append(("churn_validated_at_both_cutoffs", EXPECTED, "2"))
    return literal_table(frame.sparkSession, "check string, side string, value string", rows)


def last_load_lines(load_log: DataFrame) -> DataFrame:
    """Lines recorded by the latest load, over all its files: the one with the highest number, or
    the latest time in a registry without numbers."""
    place = "number" if "number" in load_log.columns else "loaded_at"
    per_load = load_log.groupBy("load_id").agg(F.sum("rows").alias("rows"), F.max(place).alias("place"))
    return per_load.agg(F.max_by("rows", F.struct("place", "load_id")).alias("rows"))


def check_quality(
    *,
    raw: DataFrame,
    load_log: DataFrame,
    lines: DataFrame,
    invoices: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    cohorts: DataFrame,
    churn_validation: DataFrame,
    params: Parameters,
    known_anomalies: DataFrame | None = None,
    overlap_from: Column | None = None,
    counted: Mapping[str, Counted] | None = None,
) -> DataFrame:
    """check, layer, description, expected, obtained, ok: one row per check. `counted` holds what
    was counted while tables were written."""
    start = overlap_start(raw, params.batches) if overlap_from is None else overlap_from
    load = _facts(
        last_load_lines(load_log), [("raw_lines_of_last_load", EXPECTED, F.max("rows"))]
    )
    overlap = _facts(
        overlap_difference(raw, params.batches, start),
        [("overlap_identical", OBTAINED, F.max("different_lines"))],
    )
    validated = _facts(
        churn_validation,
        [("churn_validated_at_both_cutoffs", OBTAINED, F.count_if("chosen"))],
    )
    passes = [
        _constants(raw),
        load,
        overlap,
        _raw_checks(raw, params, start),
        _clean_checks(lines, params, (counted or {}).get("clean_line")),
        _anomaly_checks(invoices, params, known_anomalies),
        _invoice_checks(invoices),
        _order_checks(orders, customer),
        _customer_checks(customer),
        _cohort_checks(cohorts),
        validated,
    ]
    sides = reduce(DataFrame.unionByName, passes)
    listed = literal_table(
        raw.sparkSession,
        "ord int, check string, layer string, description string",
        [(i, *check) for i, check in enumerate(CHECKS, start=1)],
    )

    def side(name: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col("value")))

    compared = sides.groupBy("check").agg(
        side(EXPECTED).alias("expected"), side(OBTAINED).alias("obtained")
    )
    balanced = F.col("obtained").cast("decimal(10,2)") <= F.lit("1.10").cast("decimal(10,2)")
    ok = F.when(F.col("check") == "scores_r_and_m_balanced", balanced).otherwise(
        F.col("expected").eqNullSafe(F.col("obtained"))
    )
    return listed.join(compared, "check", "left").select(
        "ord",
        "check",
        "layer",
        "description",
        F.coalesce("expected", F.lit(EMPTY)).alias("expected"),
        F.coalesce("obtained", F.lit(EMPTY)).alias("obtained"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
    )


Rules = list[tuple[str, Column]]


@dataclass(frozen=True)
class TableRules:
    """The row rules of one table. A rule that is NULL is not broken."""

    table: str
    key: tuple[str, ...]
    rules: Rules
    required: tuple[str, ...] = ()

    def broken(self) -> list[tuple[str, Column]]:
        """Each rule's name, and whether a row breaks it."""
        entries = [(rule, F.coalesce(~holds, F.lit(False))) for rule, holds in self.rules]
        if self.required:
            missing = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in self.required])
            entries.append(("required columns are filled", missing))
        return entries


@dataclass
class Counted:
    """What was counted of a table in the job that wrote it: rows that break each rule; of the
    clean lines also the sides of checks, and the lines with an odd code."""

    violations: dict[str, int]
    sides: dict[str, str | None] = field(default_factory=dict)
    odd_lines: int = 0

    def plus(self, other: Counted) -> Counted:
        """The counts of a table written in two parts (clean lines are not)."""
        both = {rule: n + other.violations[rule] for rule, n in self.violations.items()}
        return Counted(both, self.sides, self.odd_lines + other.odd_lines)


class Watch:
    """Counts a table's broken rules and checks while the table is written.

    The counters stand on top of the plan, in the tasks that write; a task's counts are taken once,
    when it is done, so tasks that are lost and run again do not count twice.
    """

    def __init__(self, rules: TableRules, params: Parameters):
        self.rules, self.seen = rules, Observation(f"rules of {rules.table}")
        self.names = [name for name, _ in rules.broken()]
        self.counters = [F.count_if(x).alias(f"rule{i}") for i, (_, x) in enumerate(rules.broken())]
        self.sides = [check for check, _, _ in clean_sides()] if rules.table == "clean_line" else []
        if self.sides:
            self.counters += [_text(value).alias(check) for check, _, value in clean_sides()]
            self.counters.append(F.count_if(_odd_code(params)).alias("odd"))

    def on(self, frame: DataFrame) -> DataFrame:
        return frame.observe(self.seen, *self.counters)

    def counted(self) -> Counted:
        """Waits for the job that wrote the table."""
        found = self.seen.get
        violations = {name: found[f"rule{i}"] for i, name in enumerate(self.names)}
        return Counted(violations, {check: found[check] for check in self.sides}, found.get("odd", 0))


def _violations(table: str, frame: DataFrame, rules: Rules, required: tuple[str, ...]) -> DataFrame:
    """Rows that break each rule, in one pass."""
    broken = TableRules(table, (), rules, required).broken()
    names = [f"c{i}" for i in range(len(broken))]
    totals = frame.agg(*[F.count_if(x).alias(n) for n, (_, x) in zip(names, broken)])
    rows = [
        F.struct(F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.col(n).alias("violations"))
        for n, (rule, _) in zip(names, broken)
    ]
    return totals.select(F.inline(F.array(*rows)))


def _rule_counts(rules: TableRules, frame: DataFrame, counted: Mapping[str, Counted]) -> DataFrame:
    """The same as counted when the table was written, where it was."""
    if rules.table not in counted:
        return _violations(rules.table, frame, rules.rules, rules.required)
    rows = [(rules.table, rule, n) for rule, n in counted[rules.table].violations.items()]
    return literal_table(frame.sparkSession, "table string, rule string, violations bigint", rows)


def rejected_rows(rules: TableRules, frame: DataFrame) -> DataFrame:
    """table, key (the key's columns as JSON text), rules: the rows that break a rule, and the names
    of all rules that each of them breaks, in order."""
    names = F.array_compact(F.array(*[F.when(x, F.lit(rule)) for rule, x in rules.broken()]))
    key = F.to_json(F.struct(*rules.key), {"ignoreNullFields": "false"})
    found = frame.select(F.lit(rules.table).alias("table"), key.alias("key"), names.alias("rules"))
    return found.filter(F.size("rules") > 0)


def _repeated_keys(table: str, frame: DataFrame, key: tuple[str, ...]) -> DataFrame:
    groups = repeated_rows(frame.select(*key), key).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.count_if(F.col("n") > 1).alias("violations")).select(
        F.lit(table).alias("table"), F.lit("key is unique").alias("rule"), "violations"
    )


def clean_rules(params: Parameters) -> Rules:
    invoice, kind, code = F.col("invoice"), F.col("kind"), F.col("stock_code")
    quantity, price = F.col("quantity"), F.col("unit_price")
    numbered = invoice.rlike(r"\A[0-9]")
    rules = [
        ("invoice format", matches(invoice, params.formats.invoice)),
        ("kind is known", kind.isin(*KINDS)),
        ("code is trimmed and not empty", (code == F.trim(code)) & (code != "")),
        ("sale", (kind != SALE) | (numbered & (quantity > 0) & (price > 0))),
        (
            "cancel",
            (kind != CANCEL) | (invoice.startswith("C") & (quantity < 0) & (price > 0)),
        ),
        ("no value", (kind != NO_VALUE) | (numbered & (price == 0))),
        ("debt adjustment", (kind != DEBT_ADJUST) | invoice.startswith("A")),
    ]
    limits = params.formats.customer_id_range
    if limits:
        rules.append(("customer range", F.col("customer_id").between(*limits)))
    return rules


def order_rules() -> Rules:
    kind, product, other = F.col("kind"), F.col("product_revenue"), F.col("other_revenue")
    return [
        ("kind is sale or cancel", kind.isin(SALE, CANCEL)),
        ("month is a first day", F.dayofmonth("month") == 1),
        ("has lines", F.col("lines") > 0),
        ("sale is not negative", (kind != SALE) | ((product >= 0) & (other >= 0))),
        ("cancel is not positive", (kind != CANCEL) | ((product <= 0) & (other <= 0))),
    ]


def customer_rules() -> Rules:
    scores = [F.col(s).between(1, 5) for s in ("r", "f", "m")]
    gross, cancelled = F.col("gross_revenue"), F.col("cancelled_value")
    return [
        ("recency is not negative", F.col("recency_days") >= 0),
        ("has a purchase", F.col("frequency") >= 1),
        ("gross is positive", gross > 0),
        ("cancelled is not negative", cancelled >= 0),
        ("net = gross - cancelled", F.col("net_revenue") == gross - cancelled),
        ("last is not before first", F.col("last_purchase") >= F.col("first_purchase")),
        ("scores are 1 to 5", scores[0] & scores[1] & scores[2]),
        ("status is known", F.col("churn_status").isin("active", "at_risk", "inactive")),
        ("segment is known", F.coalesce(F.col("segment").isin(*[s for s, _, _ in SEGMENTS]), F.lit(False))),
    ]


def churn_rules() -> Rules:
    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    return [
        ("matrix adds up to customers", tp + fp + fn + tn == F.col("customers")),
        ("tp + fp = flagged", tp + fp == F.col("flagged")),
        ("tp + fn = not returned", tp + fn == F.col("not_returned")),
    ]


def band_rules() -> Rules:
    return [
        ("band has customers", F.col("customers") > 0),
        ("not returned <= customers", F.col("not_returned").between(0, F.col("customers"))),
        ("rate is a share", F.col("rate").between(0, 1)),
    ]


def cohort_rules() -> Rules:
    first = F.col("months_since") == 0
    return [
        ("cohort is a first day", F.dayofmonth("cohort") == 1),
        ("active <= size", F.col("active") <= F.col("size")),
        ("retention is a share", F.col("retention").between(0, 1)),
        ("all are active in month 0", ~first | (F.col("active") == F.col("size"))),
    ]


def clv_rules() -> Rules:
    return [("prediction is not negative", F.col("predicted") >= 0)]


def model_rules() -> Rules:
    return [("model is known", F.col("model").isin(*MODELS))]


def table_rules(params: Parameters) -> dict[str, TableRules]:
    """The row rules of every table that has some."""
    listed = [
        TableRules(
            "clean_line",
            LINE_KEY,
            clean_rules(params),
            ("invoice", "kind", "stock_code", "quantity", "ts_local", "unit_price", "country"),
        ),
        TableRules("orders", ("invoice",), order_rules(), ("invoice", "kind", "ts_local", "month")),
        TableRules("customer", ("customer_id",), customer_rules(), ("customer_id", "segment", "clv_6m")),
        TableRules("churn_validation", ("cutoff", "days"), churn_rules()),
        TableRules("churn_band", ("cutoff", "ord"), band_rules()),
        TableRules("cohort_retention", ("cohort", "months_since"), cohort_rules()),
        TableRules("clv_validation_customer", ("customer_id",), clv_rules()),
        TableRules(
            "clv_validation",
            ("model",),
            model_rules(),
            ("customers", "total_predicted", "total_actual", "mean_abs_error"),
        ),
    ]
    return {rules.table: rules for rules in listed}


#: Tables whose key is checked too.
KEYED = ("clean_line", "orders", "customer")


def check_rules(
    *,
    lines: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    churn_validation: DataFrame,
    churn_band: DataFrame,
    cohorts: DataFrame,
    clv_validation_customer: DataFrame,
    clv_validation: DataFrame,
    params: Parameters,
    counted: Mapping[str, Counted] | None = None,
) -> DataFrame:
    """table, rule, violations. File tables have no CHECK constraints; this stands in. Tables in
    `counted` are not read for their row rules."""
    frames = {
        "clean_line": lines,
        "orders": orders,
        "customer": customer,
        "churn_validation": churn_validation,
        "churn_band": churn_band,
        "cohort_retention": cohorts,
        "clv_validation_customer": clv_validation_customer,
        "clv_validation": clv_validation,
    }
    rules = table_rules(params)
    parts = [_rule_counts(rules[name], frame, counted or {}) for name, frame in frames.items()]
    parts += [_repeated_keys(name, frames[name], rules[name].key) for name in KEYED]
    return reduce(DataFrame.unionByName, parts)

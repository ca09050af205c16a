"""The point-in-time functions as SQL table functions over a view of orders.

    sql.register(spark, publish.current(spark, root).table("orders"), params)
    spark.sql("SELECT segment, count(*) FROM rfm(DATE '2011-12-10') GROUP BY segment")

They are temporary functions of the session, defined in SQL, so Catalyst sees through them: the
reference date becomes a literal, filters and columns are pushed below the calls, and one function
can be joined with another. A view over a stored table is best, since a call may read it more than
once. Ranks are built as in operators/rank.py: rows are reduced to distinct values, and the running
count is built level by level, so no window holds more than 2**21 values (2**22 at the top).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.metrics import MONTH_SECONDS
from tillroll.operators.rank import _BITS as BITS
from tillroll.params import LONDON, Parameters
from tillroll.reference_data import SEGMENT_OF_SCORES

ORDERS = "tillroll_orders"
FUNCTIONS = ("customer_metrics", "rfm", "validate_churn", "segment_retention", "predict_clv")

_METRICS = (
    "customer_id BIGINT, first_purchase TIMESTAMP_NTZ, last_purchase TIMESTAMP_NTZ, recency_days INT, "
    "frequency BIGINT, gross_revenue DECIMAL(24,3), cancelled_value DECIMAL(24,3), net_revenue DECIMAL(24,3), "
    "avg_ticket DECIMAL(24,2), cancel_rate DECIMAL(12,4), units_per_order DECIMAL(15,1), months_of_life DECIMAL(12,2)"
)
_SCORED = f"{_METRICS}, r INT, f INT, m INT, segment STRING, is_wholesale BOOLEAN, net_not_positive BOOLEAN"


def _ratio(num: str, den: str, places: int, precision: int) -> str:
    """num / den rounded half away from zero by whole numbers, NULL for a zero denominator."""
    top, bottom = f"abs(CAST({num} AS DECIMAL(30,3)))", f"nullif(abs(CAST({den} AS DECIMAL(30,3))), 0)"
    units = f"(({top} * {2 * 10**places} + {bottom}) div ({bottom} * 2))"
    signed = f"CASE WHEN (({num}) < 0) != (({den}) < 0) THEN -{units} ELSE {units} END"
    return f"CAST(CAST({signed} AS DECIMAL(19,0)) * {10**-places:.{places}f}BD AS DECIMAL({precision},{places}))"


def _money(thousandths: str) -> str:
    return f"CAST(CAST({thousandths} AS DECIMAL(20,0)) * 0.001BD AS DECIMAL(24,3))"


def _thousandths(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(24,3)) * 1000 AS BIGINT)"


def _day_seconds(moment: str) -> str:
    return f"(hour({moment}) * 3600 + minute({moment}) * 60 + second({moment}))"


def _seconds(later: str, earlier: str) -> str:
    """Elapsed seconds between two wall-clock moments."""
    later, earlier = (f"convert_timezone('{LONDON}', 'UTC', {x})" for x in (later, earlier))
    days = f"CAST(datediff(CAST({later} AS DATE), CAST({earlier} AS DATE)) AS BIGINT)"
    return f"({days} * 86400 + ({_day_seconds(later)} - {_day_seconds(earlier)}))"


def _months_later(moment: str, months: str) -> str:
    return f"({moment} + make_ym_interval(0, {months}))"


def _figures(ref: str, until: str) -> str:
    """One grouping of the orders: each customer's figures before ref, and whether there was a
    purchase from ref on and before until."""
    revenue = _thousandths("product_revenue")
    life = f"greatest(1.00BD, {_ratio(_seconds(ref, 'first_purchase'), str(MONTH_SECONDS), 2, 12)})"
    return f"""
    SELECT customer_id, first_purchase, last_purchase,
      datediff(CAST({ref} AS DATE), CAST(last_purchase AS DATE)) AS recency_days,
      frequency, gross AS gross_revenue, cancelled AS cancelled_value, net AS net_revenue,
      {_ratio('net', 'frequency', 2, 24)} AS avg_ticket, {_ratio('cancelled', 'gross', 4, 12)} AS cancel_rate,
      {_ratio('units', 'frequency', 1, 15)} AS units_per_order,
      CAST({life} AS DECIMAL(12,2)) AS months_of_life, back
    FROM (
      SELECT *, CAST(gross - cancelled AS DECIMAL(24,3)) AS net FROM (
        SELECT customer_id,
          min(CASE WHEN bought THEN ts_local END) AS first_purchase,
          max(CASE WHEN bought THEN ts_local END) AS last_purchase,
          count(CASE WHEN bought THEN 1 END) AS frequency,
          {_money("sum(CASE WHEN bought THEN worth END)")} AS gross,
          {_money("sum(CASE WHEN gave_back THEN -worth ELSE 0 END)")} AS cancelled,
          sum(CASE WHEN bought THEN units END) AS units,
          coalesce(bool_or(came_back), false) AS back
        FROM (
          SELECT customer_id, ts_local, units, {revenue} AS worth, is_purchase AND ts_local < {ref} AS bought,
            kind = 'cancel' AND ts_local < {ref} AS gave_back, is_purchase AND ts_local >= {ref} AS came_back
          FROM {ORDERS} WHERE customer_id IS NOT NULL AND ts_local < greatest({ref}, {until}))
        GROUP BY customer_id))
    WHERE frequency > 0"""


def _scored(ref: str, until: str, wholesale_units: int) -> str:
    """The figures with scores from limits: one row of twelve numbers says where scores begin."""
    names = ("r", "f", "m")
    own = {"r": "-CAST(recency_days AS BIGINT)", "f": "frequency", "m": _thousandths("net_revenue")}
    structs = ", ".join(f"named_struct('k', '{k}', 'v', {own[k]})" for k in names)
    limits = ", ".join(
        f"min(CASE WHEN k = '{k}' AND score >= {s} THEN v END) AS {k}{s}" for k in names for s in (2, 3, 4, 5)
    )

    def score(name: str) -> str:
        steps = [f"coalesce(CAST({own[name]} >= at.{name}{s} AS INT), 0)" for s in (2, 3, 4, 5)]
        return f"(1 + {' + '.join(steps)})"

    cells = ", ".join(
        f"({r}, {f}, '{segment}')" for r, row in SEGMENT_OF_SCORES.items() for f, segment in enumerate(row, start=1)
    )
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""
    WITH figures AS ({_figures(ref, until)}),
    counts AS (
      SELECT k, v, shiftright(v, {BITS}) AS mid, shiftright(v, {2 * BITS}) AS top, count(*) AS n
      FROM (SELECT inline(array({structs})) FROM figures) GROUP BY k, v),
    mids AS (SELECT k, top, mid, sum(n) AS n FROM counts GROUP BY k, top, mid),
    tops AS (
      SELECT k, top, coalesce(sum(n) OVER (PARTITION BY k ORDER BY top {before}), 0) AS before_top,
        sum(n) OVER (PARTITION BY k) AS total
      FROM (SELECT k, top, sum(n) AS n FROM mids GROUP BY k, top)),
    offsets AS (
      SELECT k, mid, before_top + coalesce(before_mid, 0) AS offset, total
      FROM (SELECT k, top, mid, sum(n) OVER (PARTITION BY k, top ORDER BY mid {before}) AS before_mid FROM mids)
      JOIN tops USING (k, top)),
    limits AS (
      SELECT {limits} FROM (
        SELECT k, v, least(5, 1 + (offset + coalesce(inside, 0)) * 5 div greatest(total - 1, 1)) AS score
        FROM (SELECT k, v, mid, sum(n) OVER (PARTITION BY k, mid ORDER BY v {before}) AS inside FROM counts)
        JOIN offsets USING (k, mid))),
    located AS (SELECT *, (SELECT struct(*) FROM limits) AS at FROM figures),
    scored AS (
      SELECT *, CAST({score('r')} AS INT) AS r, CAST({score('f')} AS INT) AS f,
        CAST(CASE WHEN net_revenue <= 0 THEN 1 ELSE {score('m')} END AS INT) AS m,
        units_per_order >= {wholesale_units} AS is_wholesale, net_revenue <= 0 AS net_not_positive
      FROM located)
    SELECT {', '.join(c.split()[0] for c in _METRICS.split(', ') if not c[0].isdigit())},
      r, f, m, segment, is_wholesale, net_not_positive, back
    FROM scored JOIN (SELECT /*+ BROADCAST(cells) */ * FROM VALUES {cells} AS cells(r, f, segment)) USING (r, f)"""


def _validate_churn() -> str:
    """Customers are reduced to their idle days first, which the calendar bounds; the list of
    thresholds meets those."""
    until = _months_later("validate_churn.cutoff", "validate_churn.months")
    counts = "customers, not_returned, flagged, tp, flagged - tp AS fp, not_returned - tp AS fn"
    return f"""
    SELECT CAST(validate_churn.cutoff AS DATE) AS cutoff, validate_churn.months AS window_months, days,
      customers, not_returned, flagged, tp, fp, fn, tn,
      {_ratio('tp', 'tp + fp', 4, 6)} AS precision, {_ratio('tp', 'tp + fn', 4, 6)} AS recall,
      {_ratio('tp * 2', 'tp * 2 + fp + fn', 4, 6)} AS f1, {_ratio('tp + tn', 'customers', 4, 6)} AS accuracy
    FROM (
      SELECT days, {counts}, customers - not_returned - flagged + tp AS tn FROM (
        SELECT days, sum(n) AS customers, sum(CASE WHEN back THEN 0 ELSE n END) AS not_returned,
          sum(CASE WHEN recency_days > days THEN n ELSE 0 END) AS flagged,
          sum(CASE WHEN recency_days > days AND NOT back THEN n ELSE 0 END) AS tp
        FROM (
          SELECT recency_days, back, n, explode(array_distinct(validate_churn.days)) AS days
          FROM (SELECT recency_days, back, count(*) AS n FROM ({_figures('validate_churn.cutoff', until)})
                GROUP BY recency_days, back))
        GROUP BY days))"""


def _retention(start: str, until: str, wholesale_units: int) -> str:
    counted = "SELECT segment, count(*) AS customers, count_if(back) AS returned"
    return f"""
    SELECT *, {_ratio('returned', 'customers', 4, 6)} AS p_active
    FROM ({counted} FROM ({_scored(start, until, wholesale_units)}) GROUP BY segment)"""


def _predict_clv(prior: int, wholesale_units: int) -> str:
    """Exactly the decimals of operators/clv.py, step by step. The other functions' bodies are part
    of this one: a subquery inside a function cannot be one over another function's call."""
    share = "DECIMAL(20,16)"
    ago = _months_later("predict_clv.ref", "-12")
    worth = " ".join(
        f"WHEN predict_clv.months < {10**digits} THEN "
        f"CAST(p_active * avg_ticket * try_cast(predict_clv.months AS DECIMAL({digits},0)) AS DECIMAL(22,8))"
        for digits in (1, 2, 3)
    )
    return f"""
    WITH before AS ({_retention(ago, _months_later(ago, 'predict_clv.months'), wholesale_units)}),
    overall AS (
      SELECT CAST(CAST(sum(returned) AS DECIMAL(20,0)) / nullif(sum(customers), 0) AS {share}) AS p FROM before),
    own AS ({_scored('predict_clv.ref', 'predict_clv.ref', wholesale_units)}),
    base AS (
      SELECT CAST(CAST(sum(frequency) AS DECIMAL(20,0)) / nullif(sum(months_of_life), 0) AS DECIMAL(24,16)) AS rate
      FROM own),
    rated AS (
      SELECT own.*, (SELECT rate FROM base) AS base_rate,
        coalesce(CAST(b.p_active AS {share}), (SELECT p FROM overall), CAST(0 AS {share})) AS p_active
      FROM own LEFT JOIN before b ON b.segment = own.segment),
    paced AS (
      SELECT *, CAST(CAST(CAST(frequency AS DECIMAL(20,0)) + CAST({prior} AS DECIMAL(4,0)) * base_rate
          AS DECIMAL(36,16)) / (months_of_life + CAST({prior} AS DECIMAL(4,0))) AS DECIMAL(22,12)) AS per_month
      FROM rated)
    SELECT customer_id, segment, p_active, avg_ticket, CAST(round(per_month, 4) AS DECIMAL(22,4)) AS purchases_per_month,
      greatest(CAST(0 AS DECIMAL(24,2)), CAST(round((CASE {worth} END) * per_month, 2) AS DECIMAL(24,2))) AS clv
    FROM paced"""


def definitions(params: Parameters) -> dict[str, str]:
    """name(parameters) RETURNS TABLE (columns) to the body, in order."""
    units = params.wholesale_units
    until = _months_later("segment_retention.start", "segment_retention.months")
    rates = ", ".join(f"{name} DECIMAL(6,4)" for name in ("precision", "recall", "f1", "accuracy"))
    matrix = ", ".join(f"{name} BIGINT" for name in ("customers", "not_returned", "flagged", "tp", "fp", "fn", "tn"))
    named = ", ".join(part.split()[0] for part in _METRICS.split(", ") if not part[0].isdigit())
    return {
        f"customer_metrics(ref TIMESTAMP_NTZ) RETURNS TABLE ({_METRICS})":
            f"SELECT {named} FROM ({_figures('customer_metrics.ref', 'customer_metrics.ref')})",
        f"rfm(ref TIMESTAMP_NTZ) RETURNS TABLE ({_SCORED})":
            f"SELECT * EXCEPT (back) FROM ({_scored('rfm.ref', 'rfm.ref', units)})",
        f"validate_churn(cutoff TIMESTAMP_NTZ, months INT, days ARRAY<INT>) RETURNS TABLE "
        f"(cutoff DATE, window_months INT, days INT, {matrix}, {rates})": _validate_churn(),
        "segment_retention(start TIMESTAMP_NTZ, months INT) RETURNS TABLE "
        "(segment STRING, customers BIGINT, returned BIGINT, p_active DECIMAL(6,4))":
            _retention("segment_retention.start", until, units),
        "predict_clv(ref TIMESTAMP_NTZ, months INT) RETURNS TABLE (customer_id BIGINT, segment STRING, "
        "p_active DECIMAL(20,16), avg_ticket DECIMAL(24,2), purchases_per_month DECIMAL(22,4), clv DECIMAL(24,2))":
            _predict_clv(params.clv_prior_months, units),
    }


def register(spark: SparkSession, orders: DataFrame, params: Parameters) -> Sequence[str]:
    """Makes the functions of this session, over these orders; calls that were planned before keep
    theirs. A second call replaces them."""
    orders.createOrReplaceTempView(ORDERS)
    for head, body in definitions(params).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return FUNCTIONS

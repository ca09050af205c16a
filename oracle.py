"""The same results in DuckDB SQL, written independently of the Spark code.

Money is held in whole thousandths (`..._m`) or cents (`..._c`) and divided as integers, since
DuckDB divides decimals as doubles. Ranks, EXISTS and set operations are used as such.
"""

from __future__ import annotations

import re

END, CUT, CUT2, CUT1Y = "2001-08-02", "2001-02-02", "2000-08-02", "2000-02-02"
END1Y = "2000-08-02"
OLDER, NEWER = "batch 1995-1998", "batch 1998-2001"
CHURN_DAYS, WHOLESALE, PRIOR, MONTHS = 90, 120, 3, 6
THRESHOLDS = (30, 60, 90, 120, 150, 180, 240, 365)
BAND_NAMES = ("up to 90 days", "91 to 180 days", "181 to 365 days", "over 365 days")

SEGMENT_GRID = [
    (1, "Lost", "Lost", "At risk", "At risk", "Cannot lose"),
    (2, "Hibernating", "Hibernating", "At risk", "At risk", "Cannot lose"),
    (3, "Need attention", "Need attention", "Loyal", "Loyal", "Loyal"),
    (4, "Promising", "Potential loyalists", "Loyal", "Champions", "Champions"),
    (5, "New", "Potential loyalists", "Loyal", "Champions", "Champions"),
]
SEGMENTS = [
    ("Champions", "Reward; ask for referrals; early access to launches."),
    ("Loyal", "Loyalty programme; offer higher-value items."),
    ("Potential loyalists", "Encourage the next purchase; suggest new categories."),
    ("New", "Welcome, and a quick second purchase."),
    ("Promising", "Remind them of the shop; light offer."),
    ("Need attention", "Time-limited offer; win back before they cool."),
    ("Cannot lose", "Personal contact: good customers idle for long."),
    ("At risk", "Personalised win-back campaign."),
    ("Hibernating", "Cheap win-back campaign."),
    ("Lost", "Do not invest; mass communication only."),
]


def scaled(expr: str, places: int, precision: int) -> str:
    """A whole number of 10**-places units as a decimal."""
    step = "0." + "0" * (places - 1) + "1" if places else "1"
    unit = f"CAST({step} AS DECIMAL({places + 1},{places}))"
    return f"CAST(CAST(({expr}) AS DECIMAL(30,0)) * {unit} AS DECIMAL({precision},{places}))"


def money(expr: str) -> str:
    return scaled(expr, 3, 24)


def cents(expr: str) -> str:
    return scaled(expr, 2, 24)


def quotient(num: str, den: str, scale: int) -> str:
    """round(num * scale / den), halves away from zero, NULL for a zero denominator."""
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE "
        f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) * "
        f"((abs({n}) * {2 * scale} + abs({d})) // (2 * abs({d}))) END)"
    )


def ratio(num: str, den: str, places: int, precision: int = 18) -> str:
    return scaled(quotient(num, den, 10**places), places, precision)


def _segments_values() -> str:
    rows = ", ".join(f"({i}, '{s}', '{a}')" for i, (s, a) in enumerate(SEGMENTS, 1))
    return f"SELECT * FROM (VALUES {rows}) t(segment_order, segment, action)"


def _grid_values() -> str:
    cells = [f"({r}, {f}, '{s}')" for r, *row in SEGMENT_GRID for f, s in enumerate(row, 1)]
    return f"SELECT * FROM (VALUES {', '.join(cells)}) t(r, f, segment)"


def metrics(ref: str) -> str:
    """Customers with a purchase before a date: one grouping of their events."""
    life = (
        f"CAST(epoch(TIMESTAMP '{ref}' AT TIME ZONE 'Europe/London') AS BIGINT)"
        " - CAST(epoch(first_purchase AT TIME ZONE 'Europe/London') AS BIGINT)"
    )
    return f"""
    SELECT customer_id, first_purchase, last_purchase, frequency, gross_m, cancelled_m, units,
      date_diff('day', CAST(last_purchase AS DATE), DATE '{ref}') AS recency,
      gross_m - cancelled_m AS net_m,
      {quotient('gross_m - cancelled_m', 'frequency * 10', 1)} AS ticket_c,
      {quotient('units', 'frequency', 10)} AS units10,
      greatest(100, {quotient(life, '2629800', 100)}) AS months100
    FROM (
      SELECT customer_id, min(CASE WHEN buys THEN seen END) AS first_purchase,
        max(CASE WHEN buys THEN seen END) AS last_purchase, count(CASE WHEN buys THEN 1 END) AS frequency,
        sum(CASE WHEN buys THEN worth ELSE 0 END) AS gross_m,
        sum(CASE WHEN buys THEN 0 ELSE -worth END) AS cancelled_m,
        sum(CASE WHEN buys THEN units ELSE 0 END) AS units
      FROM event WHERE seen < TIMESTAMP '{ref}' GROUP BY customer_id)
    WHERE frequency > 0"""


def rfm(source: str) -> str:
    """The three figures as one long list, scored by whole-number ranks, and put side by side."""
    score = (
        "least(5, 1 + 5 * (rank() OVER (PARTITION BY figure ORDER BY v) - 1)"
        " // greatest(1, count(*) OVER (PARTITION BY figure) - 1))"
    )
    return f"""
    SELECT base.*, scores.r, scores.f, scores.m, g.segment,
      base.units10 >= {WHOLESALE * 10} AS is_wholesale, base.net_m <= 0 AS net_not_positive
    FROM {source} base
    JOIN (
      SELECT customer_id, CAST(max(score) FILTER (figure = 1) AS INTEGER) AS r,
        CAST(max(score) FILTER (figure = 2) AS INTEGER) AS f,
        CAST(max(CASE WHEN v > 0 THEN score ELSE 1 END) FILTER (figure = 3) AS INTEGER) AS m
      FROM (
        SELECT customer_id, figure, v, {score} AS score
        FROM (SELECT customer_id, unnest([1, 2, 3]) AS figure,
                unnest([CAST(-recency AS HUGEINT), frequency, net_m]) AS v FROM {source}))
      GROUP BY customer_id) scores USING (customer_id)
    JOIN seg_grid g ON (g.r, g.f) = (scores.r, scores.f)"""


def back(customer: str, start: str, months: int = MONTHS) -> str:
    return (
        f"EXISTS (SELECT 1 FROM ord b WHERE b.customer_id = {customer} AND b.is_purchase "
        f"AND b.ts_local >= TIMESTAMP '{start}' "
        f"AND b.ts_local < TIMESTAMP '{start}' + INTERVAL {months} MONTH)"
    )


def calibration(source: str, start: str) -> str:
    return f"""
    SELECT segment, count(*) AS customers, count(*) FILTER (WHERE back) AS returned,
      {quotient('count(*) FILTER (WHERE back)', 'count(*)', 10000)} AS p10000
    FROM (SELECT x.segment, {back('x.customer_id', start)} AS back FROM {source} x)
    GROUP BY segment"""


def estimate(scored: str, calibrated: str, prior: int) -> str:
    """per_month = 100 (f M + 100 b F) / (M (m + 100 b)), M and m in hundredths of a month."""
    top = f"100 * (CAST(x.frequency AS HUGEINT) * t.life + {100 * prior} * t.bought)"
    bottom = f"(t.life * (x.months100 + {100 * prior}))"
    return f"""
    SELECT x.*, p_num, p_den, {quotient(top, bottom, 10000)} AS per_month10000,
      greatest(0, {quotient(f'p_num * x.ticket_c * {MONTHS} * ({top})', f'p_den * {bottom}', 1)})
        AS clv_c
    FROM (SELECT s.*,
        CASE WHEN c.p10000 IS NOT NULL THEN c.p10000 WHEN o.n > 0 THEN o.returned ELSE 0 END
          AS p_num,
        CASE WHEN c.p10000 IS NOT NULL THEN 10000 WHEN o.n > 0 THEN o.n ELSE 1 END AS p_den
      FROM {scored} s LEFT JOIN {calibrated} c USING (segment)
      CROSS JOIN (SELECT sum(returned) AS returned, sum(customers) AS n FROM {calibrated}) o) x
    CROSS JOIN (SELECT sum(frequency) AS bought, CAST(sum(months100) AS HUGEINT) AS life
      FROM {scored}) t"""


def net_between(customer: str, start: str, end: str) -> str:
    return (
        f"coalesce((SELECT sum(b.product_m) FROM ord b WHERE b.customer_id = {customer} "
        f"AND (b.is_purchase OR b.kind = 'cancel') AND b.ts_local >= {start} "
        f"AND b.ts_local < {end}), 0)"
    )


_CUT = f"TIMESTAMP '{CUT}'"
_ENDT = f"TIMESTAMP '{END}'"

CTES = {
    "placed": "SELECT *, row_number() OVER () - 1 AS source_row FROM lineitem",
    "line": """
    SELECT l.*, o.o_custkey, o.o_orderpriority, p.p_name, p.p_retailprice, n.n_name,
      o.o_orderdate + to_hours(6 + CAST(l_orderkey % 15 AS INTEGER)) AS at_,
      CASE WHEN l_returnflag = 'R' AND CAST(l_discount AS DECIMAL(4,2)) >= 0.08 THEN 'C'
           WHEN l_returnflag = 'A' AND CAST(l_discount AS DECIMAL(4,2)) >= 0.10
             AND CAST(l_tax AS DECIMAL(4,2)) >= 0.08 THEN 'A' ELSE '' END AS prefix
    FROM placed l JOIN orders o ON o.o_orderkey = l.l_orderkey
    LEFT JOIN part p ON p.p_partkey = l.l_partkey
    LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
    LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "sheeted": f"""
    SELECT '{OLDER}' AS sheet, * FROM line WHERE at_ < TIMESTAMP '1998-12-10'
    UNION ALL SELECT '{NEWER}', * FROM line WHERE at_ >= TIMESTAMP '1998-12-01'""",
    "raw": """
    SELECT sheet, source_row,
      prefix || lpad(CAST(l_orderkey AS VARCHAR),
        CAST(greatest(6, length(CAST(l_orderkey AS VARCHAR))) AS INTEGER), '0') AS invoice,
      lpad(CAST(l_partkey AS VARCHAR),
        CAST(greatest(5, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0')
        || CASE WHEN l_linenumber = 1 THEN ' ' ELSE '' END AS stock_code,
      p_name AS description,
      CAST(CASE WHEN prefix = 'C'
          AND NOT (l_linenumber = 7 AND CAST(l_tax AS DECIMAL(4,2)) >= 0.08)
        THEN -CAST(l_quantity AS INTEGER) ELSE CAST(l_quantity AS INTEGER) END AS VARCHAR)
        AS quantity,
      strftime(at_, '%Y-%m-%d %H:%M:%S') AS invoice_date,
      CASE WHEN l_returnflag = 'N' AND CAST(l_tax AS DECIMAL(4,2)) = 0
          AND CAST(l_discount AS DECIMAL(4,2)) = 0 THEN '0.000'
        ELSE CAST(CAST(p_retailprice AS DECIMAL(12,3)) AS VARCHAR) END AS unit_price,
      CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_custkey + 10000 AS VARCHAR) END
        AS customer_id,
      n_name AS country
    FROM sheeted""",
    "overlap_cut": f"""
    SELECT coalesce(date_trunc('day', min(CAST(invoice_date AS TIMESTAMP))),
      TIMESTAMP '9999-12-31') AS start FROM raw WHERE sheet = '{NEWER}'""",
    "kept": f"""
    SELECT r.* FROM raw r, overlap_cut
    WHERE NOT (sheet = '{OLDER}' AND CAST(invoice_date AS TIMESTAMP) >= start)""",
    "overlap": f"""
    SELECT r.* FROM raw r, overlap_cut
    WHERE sheet = '{OLDER}' AND CAST(invoice_date AS TIMESTAMP) >= start""",
    "codes": "SELECT lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(5, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS code FROM part WHERE p_size = 1",
    "typed_line": """
    SELECT sheet, source_row, invoice, trim(stock_code) AS stock_code, description,
      CAST(quantity AS INTEGER) AS quantity, CAST(invoice_date AS TIMESTAMP) AS ts_local,
      CAST(unit_price AS DECIMAL(12,3)) AS unit_price,
      CAST(customer_id AS BIGINT) AS customer_id, country
    FROM kept""",
    "clean": """
    SELECT t.*, (ts_local AT TIME ZONE 'Europe/London') AT TIME ZONE 'UTC' AS ts_utc,
      CASE WHEN invoice LIKE 'A%' THEN 'debt_adjust'
           WHEN invoice LIKE 'C%' AND quantity < 0 AND unit_price > 0 THEN 'cancel'
           WHEN regexp_matches(invoice, '^[0-9]') AND unit_price = 0 THEN 'no_value'
           WHEN regexp_matches(invoice, '^[0-9]') AND quantity > 0 AND unit_price > 0 THEN 'sale'
           ELSE 'anomaly' END AS kind,
      CAST(quantity AS BIGINT) * CAST(unit_price * 1000 AS BIGINT) AS value_m,
      NOT EXISTS (SELECT 1 FROM codes k WHERE k.code = t.stock_code) AS is_product
    FROM typed_line t""",
    "dim": """
    SELECT customer_id, arg_min(country, (-n, country)) AS country,
      CAST(count(country) AS INTEGER) AS n_countries
    FROM (SELECT customer_id, country, count(*) AS n FROM clean WHERE customer_id IS NOT NULL
          GROUP BY 1, 2) GROUP BY customer_id""",
    "ord": """
    SELECT *, kind = 'sale' AND product_m > 0 AS is_purchase FROM (
      SELECT invoice, min(customer_id) AS customer_id, min(kind) AS kind, min(ts_local) AS ts_local,
        CAST(date_trunc('month', min(ts_local)) AS DATE) AS month,
        coalesce(sum(value_m) FILTER (WHERE is_product), 0) AS product_m,
        coalesce(sum(value_m) FILTER (WHERE NOT is_product), 0) AS other_m,
        CAST(coalesce(sum(quantity) FILTER (WHERE is_product), 0) AS BIGINT) AS units,
        count(*) AS lines
      FROM clean WHERE kind IN ('sale', 'cancel') GROUP BY invoice)""",
    "seg_grid": _grid_values(),
    "seg": _segments_values(),
    "m_end": metrics(END),
    "m_cut": metrics(CUT),
    "m_end1y": metrics(END1Y),
    "m_cut1y": metrics(CUT1Y),
    "rfm_end": rfm("m_end"),
    "rfm_cut": rfm("m_cut"),
    "rfm_end1y": rfm("m_end1y"),
    "rfm_cut1y": rfm("m_cut1y"),
    "cal_end": calibration("rfm_end1y", END1Y),
    "cal_cut": calibration("rfm_cut1y", CUT1Y),
    "est_end": estimate("rfm_end", "cal_end", PRIOR),
    "est_cut": estimate("rfm_cut", "cal_cut", PRIOR),
    "cust": f"""
    SELECT e.*, recency > {CHURN_DAYS} AS is_churned,
      CASE WHEN recency <= {CHURN_DAYS} THEN 'active' WHEN recency <= 365 THEN 'at_risk'
        ELSE 'inactive' END AS churn_status,
      {net_between('e.customer_id', f"{_ENDT} - INTERVAL 12 MONTH", _ENDT)} AS revenue_12m_m,
      {quotient('p_num', 'p_den', 10000)} AS p10000
    FROM est_end e""",
    "clv_cust": f"""
    SELECT customer_id, segment, clv_c AS predicted,
      {quotient(net_between('e.customer_id', f"{_CUT} - INTERVAL 6 MONTH", _CUT), '10', 1)} AS naive,
      {quotient(net_between('e.customer_id', f"{_CUT} - INTERVAL 12 MONTH",
        f"{_CUT} - INTERVAL 12 MONTH + INTERVAL 6 MONTH"), '10', 1)} AS seasonal_naive,
      {quotient(net_between('e.customer_id', _CUT, f"{_CUT} + INTERVAL 6 MONTH"), '10', 1)} AS actual
    FROM est_cut e""",
    "event": """
    SELECT customer_id, ts_local AS seen, month, product_m AS worth, units, is_purchase AS buys
    FROM ord WHERE customer_id IS NOT NULL AND (is_purchase OR kind = 'cancel')""",
    "watched": f"""
    SELECT cutoff, customer_id,
      date_diff('day', CAST(max(CASE WHEN seen < cutoff THEN seen END) AS DATE), cutoff) AS idle,
      max(CASE WHEN seen >= cutoff AND seen < cutoff + INTERVAL {MONTHS} MONTH THEN 1 ELSE 0 END) = 0 AS gone
    FROM event, (SELECT unnest([DATE '{CUT}', DATE '{CUT2}']) AS cutoff)
    WHERE buys GROUP BY cutoff, customer_id HAVING min(seen) < cutoff""",
    "churn_val": f"""
    SELECT cutoff, {MONTHS} AS window_months, days, customers, not_returned, flagged, tp,
      flagged - tp AS fp, not_returned - tp AS fn, customers - not_returned - flagged + tp AS tn
    FROM (
      SELECT cutoff, days, count(*) AS customers, count(CASE WHEN gone THEN 1 END) AS not_returned,
        count(CASE WHEN idle > days THEN 1 END) AS flagged,
        count(CASE WHEN gone AND idle > days THEN 1 END) AS tp
      FROM watched, (SELECT unnest({list(THRESHOLDS)}) AS days) GROUP BY ALL)""",
    "churn_full": f"""
    SELECT *, {ratio('tp', 'tp + fp', 4, 6)} AS "precision", {ratio('tp', 'tp + fn', 4, 6)} AS recall,
      {ratio('2 * tp', '2 * tp + fp + fn', 4, 6)} AS f1,
      {ratio('tp + tn', 'customers', 4, 6)} AS accuracy, days = {CHURN_DAYS} AS chosen
    FROM churn_val""",
    "bands": f"""
    SELECT cutoff, ord, {list(BAND_NAMES)}[ord] AS band, customers, not_returned,
      {ratio('not_returned', 'customers', 4, 6)} AS rate
    FROM (
      SELECT cutoff, 1 + CAST(idle > 90 AS INTEGER) + CAST(idle > 180 AS INTEGER)
          + CAST(idle > 365 AS INTEGER) AS ord,
        count(*) AS customers, count(CASE WHEN gone THEN 1 END) AS not_returned
      FROM watched GROUP BY ALL)""",
    "joined": """
    SELECT customer_id, CAST(date_trunc('month', min(seen)) AS DATE) AS cohort
    FROM event WHERE buys GROUP BY customer_id""",
    "bought": "SELECT customer_id, month, cohort FROM event JOIN joined USING (customer_id) WHERE buys",
    "calendar": "SELECT min(month) AS opened, max(month) AS closed FROM ord",
    "aged": """
    SELECT cohort, greatest(0, date_diff('month', cohort, month)) AS age,
      count(DISTINCT CASE WHEN buys THEN customer_id END) AS active, sum(worth) AS net_m
    FROM event JOIN joined USING (customer_id) GROUP BY ALL""",
    "cohorts": f"""
    SELECT cohort, cohort = opened AS pre_existing, size, CAST(age AS INTEGER) AS months_since,
      CAST(cohort + to_months(CAST(age AS INTEGER)) AS DATE) AS month,
      date_diff('month', cohort, closed) = age AS partial_month, coalesce(active, 0) AS active,
      {quotient('coalesce(active, 0)', 'size', 10000)} AS retention4, coalesce(net_m, 0) AS net_m
    FROM (SELECT cohort, size, opened, closed,
            unnest(range(date_diff('month', cohort, closed) + 1)) AS age
          FROM (SELECT cohort, count(*) AS size FROM joined GROUP BY cohort), calendar)
    LEFT JOIN aged USING (cohort, age)""",
    "months_": """
    SELECT month, month = closed AS partial_month, with_m, without_m, cancelled_m, net_m, other_m,
      purchases, purchases_with_customer, coalesce(active, 0) AS active_customers,
      coalesce(joining, 0) AS new_customers
    FROM (
      SELECT month, sum(CASE WHEN kind = 'sale' AND customer_id > 0 THEN product_m END) AS with_m,
        sum(CASE WHEN kind = 'sale' AND customer_id IS NULL THEN product_m END) AS without_m,
        sum(CASE WHEN kind = 'cancel' THEN product_m END) AS cancelled_m, sum(product_m) AS net_m,
        sum(other_m) AS other_m, count(CASE WHEN is_purchase THEN 1 END) AS purchases,
        count(CASE WHEN is_purchase THEN customer_id END) AS purchases_with_customer
      FROM ord GROUP BY month)
    CROSS JOIN calendar
    LEFT JOIN (SELECT month, count(DISTINCT customer_id) AS active FROM bought GROUP BY month) USING (month)
    LEFT JOIN (SELECT cohort AS month, count(*) AS joining FROM joined GROUP BY cohort) USING (month)""",
    "gaps": """
    SELECT customer_id, day,
      CAST(date_diff('day', lag(day) OVER (PARTITION BY customer_id ORDER BY day), day) AS INTEGER)
        AS gap
    FROM (SELECT customer_id, CAST(ts_local AS DATE) AS day FROM ord
          WHERE is_purchase AND customer_id IS NOT NULL)""",
    "same_lines": """
    SELECT sheet, invoice, stock_code, description, quantity, invoice_date, unit_price, customer_id,
      country, count(*) AS copies, list_sort(list(source_row)) AS places
    FROM kept GROUP BY ALL""",
}


def query(select: str) -> str:
    """A select with the common table expressions it needs, directly or through others."""
    names = "|".join(CTES)
    wanted: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(rf"\b(?:{names})\b", text):
            if name not in seen:
                seen.add(name)
                visit(CTES[name])
                wanted.append(name)

    seen: set[str] = set()
    visit(select)
    if not wanted:
        return select
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in wanted)
    return f"WITH {parts}\n{select}"


def metric_columns() -> str:
    return f"""customer_id, first_purchase, last_purchase, CAST(recency AS INTEGER) AS recency_days,
      frequency, {money('gross_m')} AS gross_revenue, {money('cancelled_m')} AS cancelled_value,
      {money('net_m')} AS net_revenue, {cents('ticket_c')} AS avg_ticket,
      {ratio('cancelled_m', 'gross_m', 4, 12)} AS cancel_rate,
      {scaled('units10', 1, 15)} AS units_per_order"""


def snapshot_columns() -> str:
    return f"""{metric_columns()}, r, f, m, segment, is_wholesale, net_not_positive, is_churned,
      {money('revenue_12m_m')} AS revenue_12m, {cents('clv_c')} AS clv_6m,
      {scaled('p10000', 4, 6)} AS p_active_6m, churn_status"""


def segment_rows(source: str) -> str:
    """Totals of each segment's customers beside those of all, for every segment there is."""
    return f"""
    SELECT seg.segment_order, seg.segment, seg.action, coalesce(n, 0) AS customers,
      {ratio('coalesce(n, 0)', 'everyone', 4, 6)} AS customer_share,
      {money('coalesce(net, 0)')} AS net_revenue,
      {ratio('coalesce(net, 0)', 'all_net', 4, 8)} AS revenue_share,
      {ratio('idle', 'n', 0, 10)} AS mean_recency_days, {ratio('times', 'n', 1, 12)} AS mean_frequency,
      {cents(quotient('tickets', 'n', 1))} AS mean_ticket, coalesce(lost, 0) AS churned,
      coalesce(risky, 0) AS at_risk, coalesce(away, 0) AS inactive,
      {money('coalesce(lost_12m, 0)')} AS churned_revenue_12m, {cents('coalesce(clv, 0)')} AS clv_6m,
      coalesce(large, 0) AS wholesale
    FROM seg
    LEFT JOIN (
      SELECT segment, count(*) AS n, sum(net_m) AS net, sum(recency) AS idle, sum(frequency) AS times,
        sum(ticket_c) AS tickets, count(CASE WHEN is_churned THEN 1 END) AS lost,
        count(CASE churn_status WHEN 'at_risk' THEN 1 END) AS risky,
        count(CASE churn_status WHEN 'inactive' THEN 1 END) AS away,
        sum(CASE WHEN is_churned THEN revenue_12m_m END) AS lost_12m, sum(clv_c) AS clv,
        count(CASE WHEN is_wholesale THEN 1 END) AS large
      FROM ({source}) GROUP BY segment) USING (segment)
    CROSS JOIN (SELECT count(*) AS everyone, sum(net_m) AS all_net FROM ({source}))"""


COHORT_COLUMNS = f"""cohort, pre_existing, size, months_since, month, partial_month, active,
      {scaled('retention4', 4, 6)} AS retention, {money('net_m')} AS net_revenue"""

SETTLED = "NOT pre_existing AND NOT partial_month AND months_since BETWEEN 1 AND 12"


def _pick(percent: int) -> str:
    """Hundredths of the interpolated value of the sorted list `v`."""
    low = f"((len(v) - 1) * {percent} // 100)"
    part = f"((len(v) - 1) * {percent} % 100)"
    high = f"least({low} + 1, len(v) - 1)"
    return f"(v[{low} + 1] * 100 + (v[{high} + 1] - v[{low} + 1]) * {part})"


def compared(rows: str, label: str) -> str:
    """Errors per model over (model, customer_id, estimate, actual) rows, and the actual value of
    the best fifth by the estimate as a share of that of the best fifth in fact."""
    return f"""
    SELECT model AS {label}, customers, {cents('estimated')} AS total_predicted,
      {cents('happened')} AS total_actual,
      {ratio('100 * (estimated - happened)', 'happened', 2)} AS total_error_pct,
      {scaled(quotient('missed', 'customers', 1), 2, 18)} AS mean_abs_error,
      {ratio('list_sum(chosen[:best])', 'list_sum(ideal[:best])', 4, 12)} AS capture_top20
    FROM (
      SELECT model, count(*) AS customers, (count(*) + 4) // 5 AS best, sum(estimate) AS estimated,
        sum(actual) AS happened, sum(abs(estimate - actual)) AS missed,
        list(actual ORDER BY estimate DESC, customer_id) AS chosen, list(actual ORDER BY actual DESC) AS ideal
      FROM ({rows}) GROUP BY model)"""


def clv_models() -> str:
    models = ("predicted", "naive", "seasonal_naive")
    rows = " UNION ALL ".join(
        f"SELECT '{m}' AS model, customer_id, {m} AS estimate, actual FROM clv_cust" for m in models
    )
    return compared(rows, "model")


def sensitivity(priors: tuple[int, ...]) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT {b} AS model, e.customer_id, e.clv_c AS estimate, c.actual
        FROM ({estimate('rfm_cut', 'cal_cut', b)}) e JOIN clv_cust c USING (customer_id)"""
        for b in priors
    )
    return f"SELECT * EXCLUDE (customers) FROM ({compared(rows, 'prior_months')})"


# A value is in the top tenth when no more than a tenth of customers have it or a larger one.
TOP10 = f"""(
      SELECT {ratio('sum(net_m * own) FILTER (10 * so_far <= everyone)', 'sum(net_m * own)', 4, 8)}
      FROM (SELECT net_m, count(*) AS own, sum(count(*)) OVER (ORDER BY net_m DESC) AS so_far,
              sum(count(*)) OVER () AS everyone FROM m_end GROUP BY net_m))"""

CTES["raw_facts"] = f"""
    SELECT count(*) AS n_raw, count(CASE WHEN copied THEN 1 END) AS n_copied,
      count(CASE WHEN NOT formed THEN 1 END) AS n_malformed,
      sum(CASE WHEN NOT copied THEN worth END) AS raw_worth
    FROM (
      SELECT coalesce(sheet = '{OLDER}' AND CAST(invoice_date AS TIMESTAMP) >= start, false) AS copied,
        regexp_full_match(invoice, '[CA]?[0-9]{{6,}}') AND regexp_full_match(quantity, '-?[0-9]+')
          AND regexp_full_match(unit_price, '-?[0-9]+([.][0-9]+)?')
          AND regexp_full_match(invoice_date, '[0-9]{{4}}(-[0-9]{{2}}){{2}} [0-9]{{2}}(:[0-9]{{2}}){{2}}')
          AND regexp_full_match(coalesce(customer_id, '00000'), '[0-9]{{5,}}') AS formed,
        CAST(quantity AS DECIMAL(12,0)) * CAST(unit_price AS DECIMAL(12,3)) AS worth
      FROM raw, overlap_cut)"""
CTES["line_facts"] = """
    SELECT count(*) AS n_clean, sum(value_m) AS clean_worth,
      sum(CASE WHEN kind IN ('sale', 'cancel') THEN value_m END) AS traded,
      count(CASE WHEN hour(ts_local) = 1 THEN 1 END) AS n_ambiguous,
      count(DISTINCT CASE WHEN is_product AND NOT regexp_full_match(stock_code, '[0-9]{5,}')
        THEN stock_code END) AS n_odd_codes
    FROM clean"""
CTES["anomaly_facts"] = """
    SELECT count(*) AS n_anomalies, count(CASE WHEN invoice NOT IN (
        SELECT 'C' || lpad(CAST(l_orderkey AS VARCHAR),
          CAST(greatest(6, length(CAST(l_orderkey AS VARCHAR))) AS INTEGER), '0')
        FROM line WHERE prefix = 'C' AND l_linenumber = 7 AND CAST(l_tax AS DECIMAL(4,2)) >= 0.08)
      THEN 1 END) AS n_unknown_anomalies
    FROM clean WHERE kind = 'anomaly'"""
CTES["bill_facts"] = """
    SELECT count(CASE WHEN lowest < highest THEN 1 END) AS n_shared,
      count(CASE WHEN named BETWEEN 1 AND n - 1 THEN 1 END) AS n_mixed
    FROM (SELECT min(customer_id) AS lowest, max(customer_id) AS highest, count(customer_id) AS named,
            count(*) AS n FROM clean GROUP BY invoice)"""
CTES["order_facts"] = """
    SELECT (SELECT sum(product_m + other_m) FROM ord) AS ordered, sum(worth) AS events_net,
      count(DISTINCT customer_id) AS n_buyers
    FROM event JOIN joined USING (customer_id)"""
CTES["people_facts"] = """
    SELECT count(*) AS n_people, sum(net_m) AS people_net,
      count(CASE WHEN clv_c IS NULL OR is_churned IS NULL THEN 1 END) AS n_unfilled,
      list_sort(map_values(histogram(r))) AS r_sizes, list_sort(map_values(histogram(m))) AS m_sizes
    FROM cust"""
CTES["cohort_facts"] = """
    SELECT coalesce(sum(CASE months_since WHEN 0 THEN size END), 0) AS n_in_cohorts, sum(net_m) AS cohorts_net
    FROM cohorts"""
CTES["churn_facts"] = f"SELECT count(CASE days WHEN {CHURN_DAYS} THEN 1 END) AS n_validated FROM churn_val"


def checks(anomalies: str) -> str:
    """Both sides of every check, from one row of facts per table."""

    def text(value: str) -> str:
        return f"CAST({value} AS VARCHAR)"

    def spread(sizes: str) -> str:
        return ratio(f"{sizes}[-1]", f"{sizes}[1]", 2, 10)

    rows = [
        ("raw_lines_of_last_load", "raw", "raw lines = lines recorded by the last load",
         text("n_raw"), text("n_raw")),
        ("raw_formats", "raw", "lines with a malformed invoice, quantity, price, date or customer",
         "'0'", text("n_malformed")),
        ("overlap_identical", "clean", "overlap lines that only one of the batches holds",
         "'0'", text("different")),
        ("clean_lines", "clean", "clean lines = raw lines - overlap",
         text("n_raw - n_copied"), text("n_clean")),
        ("clean_value_conserved", "clean", "sum of quantity x price: raw without overlap = clean",
         text("raw_worth"), text(money("clean_worth"))),
        ("clean_new_anomalies", "clean", "anomalies beyond the known ones", "'0'", text(anomalies)),
        ("clean_unclassified_codes", "clean", "codes neither in product format nor listed",
         "'0'", text("n_odd_codes")),
        ("clean_ambiguous_hour", "clean", "lines in the hour that daylight saving repeats or skips",
         "'0'", text("n_ambiguous")),
        ("clean_invoice_one_customer", "clean", "invoices with more than one customer",
         "'0'", text("n_shared")),
        ("clean_invoice_mixed", "clean", "invoices with and without a customer", "'0'", text("n_mixed")),
        ("orders_sum_to_clean", "analysis", "sum of orders = sum of sale and cancel lines",
         text(money("traded")), text(money("ordered"))),
        ("customers_with_purchase", "analysis", "customers = customers with a purchase",
         text("n_buyers"), text("n_people")),
        ("net_revenue_agrees", "analysis", "net revenue of customers = that of their orders",
         text(money("events_net")), text(money("people_net"))),
        ("cohorts_sum_to_customers", "analysis", "cohort sizes add up to the customers",
         text("n_people"), text("n_in_cohorts")),
        ("cohort_revenue_agrees", "analysis", "cohort revenue = net revenue of customers",
         text(money("people_net")), text(money("cohorts_net"))),
        ("scores_r_and_m_balanced", "analysis", "largest / smallest group of the R and M scores",
         "'<= 1.10'", text(f"greatest({spread('r_sizes')}, {spread('m_sizes')})")),
        ("clv_filled", "analysis", "customers without an expected value or churn flag",
         "'0'", text("n_unfilled")),
        ("churn_validated_at_both_cutoffs", "analysis", "cut-offs with the chosen rule validated",
         "'2'", text("n_validated")),
    ]
    listed = ",\n".join(
        f"{{ord: {i}, \"check\": '{name}', layer: '{layer}', description: '{said}', "
        f"expected: {wanted}, obtained: {found}}}"
        for i, (name, layer, said, wanted, found) in enumerate(rows, 1)
    )
    return f"""
    SELECT *, coalesce(CASE WHEN expected = '<= 1.10' THEN CAST(obtained AS DECIMAL(10,2)) <= 1.10
      ELSE expected = obtained END, false) AS ok
    FROM (SELECT unnest([{listed}], recursive := true)
          FROM raw_facts, line_facts, anomaly_facts, bill_facts, order_facts, people_facts,
            cohort_facts, churn_facts, overlap_diff)"""


CTES["checks"] = checks("n_anomalies")
CTES["checks_known"] = checks("n_unknown_anomalies")

_EIGHT = "invoice, stock_code, description, quantity, invoice_date, unit_price, customer_id, country"
CTES["overlap_diff"] = f"""
    SELECT coalesce(sum(abs(older - newer)), 0) AS different
    FROM (
      SELECT count(CASE sheet WHEN '{OLDER}' THEN 1 END) AS older,
        count(CASE sheet WHEN '{NEWER}' THEN 1 END) AS newer
      FROM raw, overlap_cut, (SELECT max(CAST(invoice_date AS TIMESTAMP)) AS until FROM overlap)
      WHERE CAST(invoice_date AS TIMESTAMP) BETWEEN start AND until GROUP BY {_EIGHT})"""


def _measure(label: str, value: str) -> str:
    return f"SELECT '{label}' AS measure, CAST(({value}) AS DECIMAL(30,4)) AS value"


def _mean(column: str, table: str, where: str = "") -> str:
    total = f"sum(CAST({column} * 10000 AS BIGINT))"
    return f"SELECT {ratio(total, f'count({column}) * 10000', 4)} FROM {table} {where}"


def customer_measures(source: str) -> list[str]:
    return [
        _measure("customers", f"SELECT count(*) FROM {source}"),
        _measure("net revenue", f"SELECT {money('sum(net_m)')} FROM {source}"),
        _measure("average ticket", f"SELECT {ratio('sum(net_m)', 'sum(frequency) * 1000', 2)} FROM {source}"),
        _measure("churned customers", f"SELECT count(*) FROM {source} WHERE is_churned"),
        _measure(
            "churned share",
            f"SELECT {ratio('count(*) FILTER (WHERE is_churned)', 'count(*)', 4)} FROM {source}",
        ),
        _measure("at risk", f"SELECT count(*) FROM {source} WHERE churn_status = 'at_risk'"),
        _measure("inactive", f"SELECT count(*) FROM {source} WHERE churn_status = 'inactive'"),
        _measure(
            "revenue at risk",
            f"SELECT {money('sum(revenue_12m_m)')} FROM {source} WHERE churn_status = 'at_risk'",
        ),
        _measure("clv 6 months", f"SELECT {cents('sum(clv_c)')} FROM {source}"),
    ]


def measures_sql() -> str:
    rows = [
        _measure("product revenue", f"SELECT {money('sum(net_m)')} FROM months_"),
        _measure("sale with customer", f"SELECT {money('sum(with_m)')} FROM months_"),
        _measure("sale without customer", f"SELECT {money('sum(without_m)')} FROM months_"),
        _measure(
            "share without customer",
            "SELECT " + ratio("sum(without_m)", "coalesce(sum(with_m), 0) + coalesce(sum(without_m), 0)", 4)
            + " FROM months_",
        ),
        *customer_measures("cust"),
        _measure("not returned", _mean("rate", "bands")),
        _measure(
            "precision of the rule",
            _mean('"precision"', "churn_full", f"WHERE chosen AND cutoff = DATE '{CUT}'"),
        ),
        _measure("precision", _mean('"precision"', "churn_full")),
        _measure("recall", _mean("recall", "churn_full")),
        _measure("retention", f"SELECT {ratio('sum(active)', 'sum(size)', 4)} FROM cohorts"),
        _measure(
            "retention, settled months",
            f"SELECT {ratio('sum(active)', 'sum(size)', 4)} FROM cohorts WHERE {SETTLED}",
        ),
        _measure("clv predicted (validation)", f"SELECT {cents('sum(predicted)')} FROM clv_cust"),
        _measure("clv naive (validation)", f"SELECT {cents('sum(naive)')} FROM clv_cust"),
        _measure(
            "clv seasonal naive (validation)", f"SELECT {cents('sum(seasonal_naive)')} FROM clv_cust"
        ),
        _measure("actual revenue (validation)", f"SELECT {cents('sum(actual)')} FROM clv_cust"),
        _measure("checks ok", "SELECT count(*) FROM checks WHERE ok"),
        _measure("checks", "SELECT count(*) FROM checks"),
    ]
    return " UNION ALL ".join(rows)


def headline(checked: str) -> str:
    return f"""
      SELECT (SELECT {money('sum(net_m)')} FROM months_) AS product_revenue,
        (SELECT {ratio('coalesce(sum(without_m), 0)', 'coalesce(sum(with_m), 0) + coalesce(sum(without_m), 0)', 4, 6)}
          FROM months_) AS without_customer_share,
        count(*) AS customers, {money('sum(net_m)')} AS net_revenue,
        {ratio('count(*) FILTER (WHERE frequency >= 2)', 'count(*)', 4, 6)} AS repurchase_rate,
        count(*) FILTER (WHERE is_churned) AS churned,
        count(*) FILTER (WHERE churn_status = 'at_risk') AS at_risk,
        count(*) FILTER (WHERE churn_status = 'inactive') AS inactive,
        {money("coalesce(sum(revenue_12m_m) FILTER (WHERE churn_status = 'at_risk'), 0)")} AS revenue_at_risk,
        {cents('sum(clv_c)')} AS clv_6m,
        (SELECT count(*) FROM {checked} WHERE ok) AS checks_ok, (SELECT count(*) FROM {checked}) AS checks,
        {TOP10} AS top10_share
      FROM cust"""


MONTHLY_COLUMNS = f"""month, partial_month, {money('with_m')} AS sale_with_customer,
      {money('without_m')} AS sale_without_customer, {money('cancelled_m')} AS cancelled_product,
      {money('net_m')} AS net_product_revenue, {money('other_m')} AS other_revenue, purchases,
      purchases_with_customer, active_customers, new_customers"""

MATRIX_COLUMNS = ", ".join(
    f"max({scaled('retention4', 4, 6)}) FILTER (WHERE months_since = {i}) AS m{i}" for i in range(1, 13)
)

PROFILES = (
    ("Retail", "(SELECT * FROM cust WHERE NOT is_wholesale)"),
    ("Wholesale", "(SELECT * FROM cust WHERE is_wholesale)"),
)

SELECTS: dict[str, str] = {
    "lines_per_sheet": "SELECT sheet, count(*) AS lines FROM raw GROUP BY sheet",
    "overlap_removed": """
      SELECT (SELECT count(*) FROM overlap) AS overlap_lines, (SELECT count(*) FROM kept) AS kept_lines,
        (SELECT min(start) FROM overlap_cut) AS overlap_start""",
    "overlap_identical": "SELECT CAST(different AS BIGINT) AS different_lines FROM overlap_diff",
    "clean_line": f"""
      SELECT sheet, invoice, kind, stock_code, description, quantity, ts_local, ts_utc, unit_price,
        CAST({money('value_m')} AS DECIMAL(14,3)) AS value, customer_id, country, is_product FROM clean""",
    "clean_kind_totals": f"SELECT kind, count(*) AS lines, {money('sum(value_m)')} AS value FROM clean GROUP BY kind",
    "non_product_split": f"""
      SELECT is_product, count(*) AS lines, {money('sum(value_m)')} AS value FROM clean GROUP BY is_product""",
    "customer_dim": "SELECT * FROM dim",
    "country_counts": "SELECT n_countries, count(*) AS customers FROM dim GROUP BY n_countries",
    "country_share": f"""
      SELECT country, count(*) AS customers, {ratio('count(*)', 'sum(count(*)) OVER ()', 4, 6)} AS share
      FROM dim GROUP BY country""",
    "lineage": f"""
      SELECT r.sheet, r.source_row, r.invoice, r.stock_code, r.quantity, r.unit_price, c.kind,
        CAST({money('c.value_m')} AS DECIMAL(14,3)) AS value, c.is_product
      FROM raw r JOIN clean c USING (sheet, source_row)""",
    "orders": f"""
      SELECT invoice, customer_id, kind, ts_local, (ts_local AT TIME ZONE 'Europe/London')
        AT TIME ZONE 'UTC' AS ts_utc, month, {money('product_m')} AS product_revenue,
        {money('other_m')} AS other_revenue, units, lines, is_purchase FROM ord""",
    "customer_metrics_end": f"SELECT {metric_columns()}, {scaled('months100', 2, 12)} AS months_of_life FROM m_end",
    "customer_metrics_cutoff": f"SELECT {metric_columns()}, {scaled('months100', 2, 12)} AS months_of_life FROM m_cut",
    "rfm_scores": f"""
      SELECT customer_id, CAST(recency AS INTEGER) AS recency_days, frequency,
        {money('net_m')} AS net_revenue, r, f, m, segment, is_wholesale, net_not_positive FROM rfm_end""",
    "customer_snapshot": f"SELECT {snapshot_columns()}, country, n_countries FROM cust JOIN dim USING (customer_id)",
    "customer_view": f"""
      SELECT {snapshot_columns()}, segment_order, action AS segment_action,
        CASE WHEN is_wholesale THEN 'Wholesale' ELSE 'Retail' END AS profile,
        CASE WHEN recency <= 30 THEN '0-30 days' WHEN recency <= 90 THEN '31-90 days'
          WHEN recency <= 180 THEN '91-180 days' WHEN recency <= 365 THEN '181-365 days'
          ELSE 'Over 1 year' END AS recency_band,
        CASE WHEN recency <= 30 THEN 1 WHEN recency <= 90 THEN 2 WHEN recency <= 180 THEN 3
          WHEN recency <= 365 THEN 4 ELSE 5 END AS recency_band_order
      FROM cust JOIN seg USING (segment)""",
    "segment_summary": segment_rows("SELECT * FROM cust"),
    "segment_summary_wholesale": segment_rows("SELECT * FROM cust WHERE is_wholesale"),
    "purchase_intervals": "SELECT customer_id, day, gap AS days_since_previous FROM gaps",
    "interval_percentiles": "SELECT len(v) AS intervals, "
    + ", ".join(f"{scaled(_pick(p), 2, 24)} AS p{p}" for p in (50, 75, 80, 90, 95))
    + ", (SELECT count(*) FROM gaps WHERE gap = 0) AS same_day"
    + " FROM (SELECT list_sort(list(gap)) AS v FROM gaps WHERE gap IS NOT NULL)",
    "churn_validation": "SELECT * FROM churn_full",
    "churn_band": "SELECT * FROM bands",
    "churn_status": f"""
      SELECT churn_status, count(*) AS customers, {money('sum(revenue_12m_m)')} AS revenue_12m
      FROM cust GROUP BY churn_status""",
    "cohort_retention": f"SELECT {COHORT_COLUMNS} FROM cohorts",
    "cohort_matrix": f"SELECT cohort, {MATRIX_COLUMNS} FROM cohorts WHERE {SETTLED} GROUP BY cohort",
    "retention_curve": f"""
      SELECT months_since, CAST(sum(active) AS BIGINT) AS active, CAST(sum(size) AS BIGINT) AS size,
        {ratio('sum(active)', 'sum(size)', 4, 6)} AS retention
      FROM cohorts WHERE NOT pre_existing AND NOT partial_month GROUP BY months_since""",
    "segment_retention": f"""
      SELECT segment, customers, returned, {scaled('p10000', 4, 6)} AS p_active FROM cal_end""",
    "clv_predicted": f"""
      SELECT customer_id, segment,
        CAST(CAST({quotient('p_num', 'p_den', 10**16)} AS DECIMAL(20,0))
          * CAST(0.0000000000000001 AS DECIMAL(17,16)) AS DECIMAL(20,16)) AS p_active,
        {cents('ticket_c')} AS avg_ticket, {scaled('per_month10000', 4, 22)} AS purchases_per_month,
        {cents('clv_c')} AS clv
      FROM est_end""",
    "clv_validation_customer": f"""
      SELECT customer_id, segment, {cents('predicted')} AS predicted, {cents('naive')} AS naive,
        {cents('actual')} AS actual, {cents('seasonal_naive')} AS seasonal_naive FROM clv_cust""",
    "clv_validation": clv_models(),
    "clv_bias": f"""
      SELECT segment, {cents('sum(predicted)')} AS predicted, {cents('sum(naive)')} AS naive,
        {cents('sum(seasonal_naive)')} AS seasonal_naive, {cents('sum(actual)')} AS actual,
        {ratio('100 * (sum(predicted) - sum(actual))', 'sum(actual)', 2)} AS bias_pct
      FROM clv_cust GROUP BY segment""",
    "clv_by_segment": f"""
      SELECT s.segment_order, segment, {cents('sum(predicted)')} AS predicted,
        {cents('sum(naive)')} AS naive, {cents('sum(seasonal_naive)')} AS seasonal_naive,
        {cents('sum(actual)')} AS actual
      FROM clv_cust JOIN seg s USING (segment) GROUP BY s.segment_order, segment""",
    "clv_sensitivity": sensitivity((0, 1, 3, 6, 12)),
    "clv_summary": f"""
      SELECT len(v) AS customers, {scaled(quotient('list_sum(v)', '100', 1), 0, 24)} AS clv_total,
        {scaled(quotient('list_sum(v)', '100 * len(v)', 1), 0, 18)} AS clv_mean,
        {scaled(quotient(_pick(50), '10000', 1), 0, 24)} AS clv_median
      FROM (SELECT list_sort(list(clv_c)) AS v FROM cust)""",
    "clv_top20_share": f"""
      SELECT CAST(sum(clv_c) FILTER (WHERE pos <= (n + 4) // 5) AS DECIMAL(27,0)) AS top_cents,
        CAST(sum(clv_c) AS DECIMAL(27,0)) AS all_cents,
        {ratio('sum(clv_c) FILTER (WHERE pos <= (n + 4) // 5)', 'sum(clv_c)', 4, 6)} AS share
      FROM (SELECT clv_c, row_number() OVER (ORDER BY clv_c DESC, customer_id) AS pos,
              count(*) OVER () AS n FROM cust)""",
    "monthly_revenue": f"SELECT {MONTHLY_COLUMNS} FROM months_",
    "monthly_labels": f"""
      SELECT month, ['jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez'][month(month)]
          || '/' || strftime(month, '%y') AS month_label,
        CASE WHEN abs(v) >= 1000000 THEN replace(printf('£%.1f mi', v / 1000000), '.', ',')
          WHEN abs(v) >= 1000 THEN printf('£%.0f mil', v / 1000) ELSE printf('£%.0f', v) END
          AS revenue_label
      FROM (SELECT month, CAST({money('net_m')} AS DOUBLE) AS v FROM months_)""",
    "new_customers_censored": """
      SELECT month, count(*) FILTER (WHERE month = cohort) AS first_seen,
        count(*) FILTER (WHERE previous IS NULL OR date_diff('month', previous, month) > 9) AS new_in_window,
        date_diff('month', min(min(month)) OVER (), month) >= 9 AS full_window
      FROM (SELECT customer_id, month, cohort,
              lag(month) OVER (PARTITION BY customer_id ORDER BY month) AS previous
            FROM (SELECT DISTINCT customer_id, month, cohort FROM bought))
      GROUP BY month""",
    "first_return_months": f"""
      SELECT CAST(date_trunc('month', back_at) AS DATE) AS month, count(*) AS customers
      FROM (SELECT m.customer_id, min(o.ts_local) AS back_at FROM m_end1y m
            JOIN ord o ON o.customer_id = m.customer_id AND o.is_purchase
              AND o.ts_local >= TIMESTAMP '{CUT2}' GROUP BY m.customer_id)
      GROUP BY 1""",
    "duplicate_profile": """
      SELECT (SELECT count(*) FROM overlap) AS overlap_lines,
        (SELECT CAST(sum(copies - 1) AS BIGINT) FROM same_lines) AS repeats_kept,
        (SELECT CAST(coalesce(sum(len(list_filter(places, lambda p: list_contains(places, p - 1)))), 0) AS BIGINT)
          FROM same_lines WHERE copies > 1) AS adjacent_repeats,
        count(*) FILTER (n > 1) AS repeated_pairs,
        count(*) FILTER (n > 1 AND least_ < most) AS pairs_with_other_quantity
      FROM (SELECT count(*) AS n, min(quantity) AS least_, max(quantity) AS most
            FROM clean GROUP BY invoice, stock_code)""",
    "repeat_lines": f"""
      SELECT (SELECT count(*) FROM raw) AS raw_lines, (SELECT count(*) FROM overlap) AS overlap_lines,
        CAST(sum(copies - 1) AS BIGINT) AS repeats_kept,
        {money("coalesce(sum(CASE WHEN kind = 'sale' THEN (copies - 1) * value_m END), 0)")} AS value_of_repeats
      FROM (SELECT copies, sheet, places[1] AS source_row FROM same_lines)
      JOIN clean USING (sheet, source_row)""",
    "headline": headline("checks"),
    "top10_share": f"SELECT {TOP10} AS top10_share",
    "profile_split": f"""
      SELECT CASE WHEN is_wholesale THEN 'Wholesale' ELSE 'Retail' END AS profile, count(*) AS customers,
        {money('sum(net_m)')} AS net_revenue,
        {ratio('sum(net_m)', 'sum(sum(net_m)) OVER ()', 4, 8)} AS revenue_share
      FROM cust GROUP BY is_wholesale""",
    "bi_measures": measures_sql(),
    "checks_card": "SELECT count(*) FILTER (WHERE ok) || ' of ' || count(*) AS checks FROM checks",
    "risk_priority": f"""
      SELECT segment, count(*) AS customers, {money('sum(revenue_12m_m)')} AS revenue_12m
      FROM cust WHERE churn_status = 'at_risk' GROUP BY segment""",
    "score_distribution": """
      SELECT f, min(frequency) AS min_frequency, max(frequency) AS max_frequency, count(*) AS customers
      FROM rfm_end GROUP BY f""",
    "order_medians": f"""
      SELECT what, CAST(len(v) AS BIGINT) AS "rows", CAST(CASE WHEN what = 'products' THEN {scaled(_pick(50), 2, 24)}
        ELSE CAST({_pick(50)} AS DECIMAL(24,0)) * CAST(0.00001 AS DECIMAL(6,5)) END AS DECIMAL(24,5)) AS median
      FROM (SELECT what, list_sort(list(CAST(x AS BIGINT))) AS v FROM (
          SELECT 'products' AS what, count(DISTINCT stock_code) AS x FROM clean
            WHERE kind = 'sale' AND is_product GROUP BY invoice
          UNION ALL SELECT 'value', sum(value_m) FROM clean WHERE kind = 'sale' AND is_product GROUP BY invoice
          UNION ALL SELECT 'unit_price', unit_price * 1000 FROM clean WHERE kind = 'sale' AND is_product)
        GROUP BY what)""",
    "unit_quantiles": "SELECT len(v) AS customers, "
    + ", ".join(f"{scaled(_pick(p), 3, 24)} AS units_p{p}" for p in (50, 90))
    + " FROM (SELECT list_sort(list(units10)) AS v FROM m_end)",
    "non_product_revenue": f"""
      SELECT 'freight' AS code_kind, kind, CAST(count(*) AS BIGINT) AS lines, {money('sum(value_m)')} AS value
      FROM clean WHERE customer_id IS NOT NULL AND NOT is_product AND kind IN ('sale', 'cancel') GROUP BY kind""",
    "dq_checks": "SELECT * FROM checks",
    "load_log": """
      SELECT 'this load' AS load_id, 'lineitem.parquet' AS name, count(*) AS rows, true AS has_digest
      FROM raw""",
    "segment_map_rules": """
      SELECT r, f, segment, segment_order, count(*) AS customers
      FROM cust LEFT JOIN seg USING (segment) GROUP BY ALL""",
    "bi_measures_by_profile": " UNION ALL ".join(
        f"SELECT '{name}' AS profile, * FROM ({' UNION ALL '.join(customer_measures(own))})"
        for name, own in PROFILES
    ),
    "segment_shares_by_profile": " UNION ALL ".join(
        f"SELECT '{name}' AS profile, segment, customer_share, revenue_share "
        f"FROM ({segment_rows('SELECT * FROM ' + own)})"
        for name, own in PROFILES
    ),
    "published_run": " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", count(*) AS rows FROM {source}"
        for table, source in (
            ("clean_line", "clean"), ("customer_dim", "dim"), ("orders", "ord"), ("customer", "cust"),
            ("churn_validation", "churn_val"), ("churn_band", "bands"), ("cohort_retention", "cohorts"),
            ("clv_validation_customer", "clv_cust"), ("clv_validation", f"({clv_models()})"),
            ("parameter", "range(9)"), ("segment_map", "seg_grid"), ("segment", "seg"),
            ("non_product_code", "codes"), ("quality", "checks"),
        )
    ),
}


def _count(table: str, rule: str, source: str, broken: str) -> str:
    return f"""SELECT '{table}' AS "table", '{rule}' AS rule,
      (SELECT count(*) FROM {source} WHERE {broken}) AS violations"""


def _missing(table: str, source: str, columns: str) -> str:
    nulls = " OR ".join(f"{c.strip()} IS NULL" for c in columns.split(","))
    return _count(table, "required columns are filled", source, nulls)


def _repeated(table: str, source: str, key: str) -> str:
    return _count(
        table, "key is unique", f"(SELECT 1 FROM {source} GROUP BY {key} HAVING count(*) > 1)", "TRUE"
    )


def invariants_sql() -> str:
    known = "'sale', 'cancel', 'no_value', 'debt_adjust', 'anomaly'"
    digit = "regexp_matches(invoice, '^[0-9]')"
    clv_models_ = f"({clv_models()})"
    rules = [
        ("clean_line", "invoice format", "clean", "NOT regexp_full_match(invoice, '[CA]?[0-9]{6,}')"),
        ("clean_line", "kind is known", "clean", f"kind NOT IN ({known})"),
        ("clean_line", "code is trimmed and not empty", "clean",
         "stock_code <> trim(stock_code) OR stock_code = ''"),
        ("clean_line", "sale", "clean",
         f"kind = 'sale' AND NOT ({digit} AND quantity > 0 AND unit_price > 0)"),
        ("clean_line", "cancel", "clean",
         "kind = 'cancel' AND NOT (invoice LIKE 'C%' AND quantity < 0 AND unit_price > 0)"),
        ("clean_line", "no value", "clean", f"kind = 'no_value' AND NOT ({digit} AND unit_price = 0)"),
        ("clean_line", "debt adjustment", "clean", "kind = 'debt_adjust' AND invoice NOT LIKE 'A%'"),
        ("clean_line", "customer range", "clean", "customer_id NOT BETWEEN 10000 AND 1000000000000"),
        ("orders", "kind is sale or cancel", "ord", "kind NOT IN ('sale', 'cancel')"),
        ("orders", "month is a first day", "ord", "day(month) <> 1"),
        ("orders", "has lines", "ord", "lines <= 0"),
        ("orders", "sale is not negative", "ord", "kind = 'sale' AND (product_m < 0 OR other_m < 0)"),
        ("orders", "cancel is not positive", "ord",
         "kind = 'cancel' AND (product_m > 0 OR other_m > 0)"),
        ("customer", "recency is not negative", "cust", "recency < 0"),
        ("customer", "has a purchase", "cust", "frequency < 1"),
        ("customer", "gross is positive", "cust", "gross_m <= 0"),
        ("customer", "cancelled is not negative", "cust", "cancelled_m < 0"),
        ("customer", "net = gross - cancelled", "cust", "net_m <> gross_m - cancelled_m"),
        ("customer", "last is not before first", "cust", "last_purchase < first_purchase"),
        ("customer", "scores are 1 to 5", "cust",
         "NOT (r BETWEEN 1 AND 5 AND f BETWEEN 1 AND 5 AND m BETWEEN 1 AND 5)"),
        ("customer", "status is known", "cust", "churn_status NOT IN ('active', 'at_risk', 'inactive')"),
        ("customer", "segment is known", "cust", "segment NOT IN (SELECT segment FROM seg)"),
        ("churn_validation", "matrix adds up to customers", "churn_val", "tp + fp + fn + tn <> customers"),
        ("churn_validation", "tp + fp = flagged", "churn_val", "tp + fp <> flagged"),
        ("churn_validation", "tp + fn = not returned", "churn_val", "tp + fn <> not_returned"),
        ("churn_band", "band has customers", "bands", "customers <= 0"),
        ("churn_band", "not returned <= customers", "bands",
         "not_returned < 0 OR not_returned > customers"),
        ("churn_band", "rate is a share", "bands", "rate < 0 OR rate > 1"),
        ("cohort_retention", "cohort is a first day", "cohorts", "day(cohort) <> 1"),
        ("cohort_retention", "active <= size", "cohorts", "active > size"),
        ("cohort_retention", "retention is a share", "cohorts", "retention4 < 0 OR retention4 > 10000"),
        ("cohort_retention", "all are active in month 0", "cohorts", "months_since = 0 AND active <> size"),
        ("clv_validation_customer", "prediction is not negative", "clv_cust", "predicted < 0"),
        ("clv_validation", "model is known", clv_models_,
         "model NOT IN ('predicted', 'naive', 'seasonal_naive')"),
    ]
    parts = [_count(*rule) for rule in rules]
    parts += [
        _missing("clean_line", "clean",
                 "invoice, kind, stock_code, quantity, ts_local, unit_price, country"),
        _missing("orders", "ord", "invoice, kind, ts_local, month"),
        _missing("customer", "cust", "customer_id, segment, clv_c"),
        _missing("clv_validation", clv_models_,
                 "customers, total_predicted, total_actual, mean_abs_error"),
        _repeated("clean_line", "clean", "sheet, source_row"),
        _repeated("orders", "ord", "invoice"),
        _repeated("customer", "cust", "customer_id"),
    ]
    return " UNION ALL ".join(parts)


SELECTS["invariants"] = invariants_sql()

SELECTS["sql_customer_metrics"] = SELECTS["customer_metrics_cutoff"]
SELECTS["sql_rfm"] = SELECTS["rfm_scores"]
SELECTS["sql_validate_churn"] = f"SELECT * EXCLUDE (chosen) FROM churn_full WHERE cutoff = DATE '{CUT}'"
SELECTS["sql_segment_retention"] = SELECTS["segment_retention"]
SELECTS["sql_predict_clv"] = SELECTS["clv_predicted"]
SELECTS["snapshot_difference"] = """
  SELECT (SELECT count(*) FROM (SELECT customer_id, segment FROM cust EXCEPT SELECT customer_id, segment FROM rfm_end))
      AS only_stored,
    (SELECT count(*) FROM (SELECT customer_id, segment FROM rfm_end EXCEPT SELECT customer_id, segment FROM cust))
      AS only_computed"""
_HALF = "SELECT customer_id, CAST(month(month) AS INTEGER) AS month FROM event WHERE buys AND seen"
SELECTS["sale_changes"] = f"""
  SELECT *, 'left' AS side FROM ({_HALF} < DATE '{CUT}' EXCEPT {_HALF} >= DATE '{CUT}')
  UNION ALL
  SELECT *, 'right' FROM ({_HALF} >= DATE '{CUT}' EXCEPT {_HALF} < DATE '{CUT}')"""
SELECTS["cohort_flags"] = """
  SELECT cohort, bool_or(pre_existing) AS pre_existing,
    array_to_string(array_agg(CAST(month AS VARCHAR) ORDER BY month) FILTER (WHERE partial_month), ',')
      AS partial_months
  FROM cohorts GROUP BY cohort"""
SELECTS["cohort_arrays"] = f"""
  SELECT customer_id, min(cohort) AS cohort,
    array_to_string(array_agg(CAST(month AS VARCHAR) ORDER BY month) FILTER (WHERE n > 0), ',') AS months,
    array_to_string(array_agg(CAST({money('net_m')} AS VARCHAR) ORDER BY month) FILTER (WHERE n > 0), ',') AS net,
    count(*) FILTER (WHERE n > 0) AS n_months, coalesce(bool_or(net_m < 0), false) AS ever_negative,
    bool_and(n > 0) AS always_bought
  FROM (
    SELECT o.customer_id, o.month, j.cohort, count(*) FILTER (WHERE is_purchase) AS n,
      sum(CASE WHEN is_purchase OR kind = 'cancel' THEN product_m END) AS net_m
    FROM ord o JOIN joined j USING (customer_id) GROUP BY ALL)
  GROUP BY customer_id"""
SELECTS["returns_in_windows"] = f"""
  SELECT strftime(w.month, '%Y-%m-%d') || '+' || months AS id,
    (SELECT count(*) FROM (SELECT min(seen) AS first FROM event WHERE buys GROUP BY customer_id) WHERE first < w.month)
      AS customers,
    count(DISTINCT e.customer_id) AS returned, coalesce({money('sum(worth)')}, CAST(0 AS DECIMAL(24,3))) AS spent
  FROM (SELECT DISTINCT month, unnest(range(1, 7)) AS months FROM ord) w
  LEFT JOIN (SELECT *, min(seen) OVER (PARTITION BY customer_id) AS first FROM event WHERE buys) e
    ON e.first < w.month AND e.seen >= w.month AND e.seen < w.month + to_months(CAST(months AS INTEGER))
  GROUP BY w.month, months"""
SELECTS["idle_bands"] = f"""
  SELECT recency // 7 AS band, count(*) AS customers, {money('sum(net_m)')} AS net_revenue
  FROM cust GROUP BY band"""
SELECTS["sketched_order_values"] = """
  SELECT quarter, len(v) AS "rows", """ + ", ".join(
    f"v[CAST(ceil(len(v) * {p} / 100) AS BIGINT)] AS p{p}" for p in (25, 50, 90)
) + """
  FROM (SELECT CAST(date_trunc('quarter', month) AS DATE) AS quarter, list_sort(list(CAST(product_m AS BIGINT))) AS v
        FROM ord WHERE is_purchase GROUP BY quarter)"""
SELECTS["rejected_rows"] = """
  SELECT 'clean_line' AS "table",
    '{"sheet":"' || sheet || '","invoice":"' || invoice || '","stock_code":"' || stock_code
      || '","quantity":' || quantity || '}' AS key,
    concat_ws('; ', CASE WHEN invoice LIKE 'C%' THEN 'invoice format' END,
      CASE WHEN customer_id < 10050 THEN 'customer range' END) AS rules
  FROM clean WHERE invoice LIKE 'C%' OR customer_id < 10050
  UNION ALL
  SELECT 'orders', '{"invoice":"' || invoice || '"}', 'is a sale' FROM ord WHERE kind <> 'sale'"""


def _json_text(column: str) -> str:
    """A column as JSON: dates and text in quotes, numbers without idle zeros."""
    name, _, kind = column.partition(":")
    text = f'CAST("{name}" AS VARCHAR)'
    if kind == "text":
        text = f'CAST(to_json("{name}") AS VARCHAR)'
    elif kind == "date":
        text = f"""'"' || {text} || '"'"""
    else:
        text = f"CASE WHEN contains({text}, '.') THEN regexp_replace({text}, '[.]?0+$', '') ELSE {text} END"
    return f"""'"{name}":' || coalesce({text}, 'null')"""


def _section(place: int, name: str, source: str, columns: str, order: str | None = None) -> str:
    members = " || ',' || ".join(map(_json_text, columns.split()))
    row = f"'{{' || {members} || '}}'"
    body = f"'[' || string_agg({row}, ',' ORDER BY {order}) || ']'" if order else row
    return f"SELECT {place} AS place, '{name}' AS section, {body} AS json FROM ({source})"


def export_sql() -> str:
    models = "['predicted', 'seasonal_naive', 'naive']"
    parts = [
        ("summary", headline("checks_known"),
         "product_revenue without_customer_share customers net_revenue repurchase_rate churned at_risk "
         "inactive revenue_at_risk clv_6m checks_ok checks top10_share", None),
        ("cleaning", SELECTS["repeat_lines"], "raw_lines overlap_lines repeats_kept value_of_repeats", None),
        ("monthly_revenue", SELECTS["monthly_revenue"],
         "month:date partial_month sale_with_customer sale_without_customer cancelled_product "
         "active_customers new_customers", "month"),
        ("segments", SELECTS["segment_summary"],
         "segment_order segment:text action:text customers customer_share net_revenue revenue_share "
         "mean_recency_days mean_frequency churned at_risk inactive churned_revenue_12m clv_6m wholesale",
         "segment_order"),
        ("churn", SELECTS["churn_validation"],
         "cutoff:date days customers not_returned flagged precision recall f1 accuracy chosen",
         "cutoff DESC, days"),
        ("churn_bands", SELECTS["churn_band"], "cutoff:date ord band:text customers not_returned rate",
         "cutoff DESC, ord"),
        ("cohorts", SELECTS["cohort_retention"] + f" WHERE {SETTLED}",
         "cohort:date size months_since retention", "cohort, months_since"),
        ("clv_validation", SELECTS["clv_validation"],
         "model:text customers total_predicted total_actual total_error_pct mean_abs_error capture_top20",
         f"list_position({models}, model)"),
        ("clv_segments", SELECTS["clv_by_segment"],
         "segment:text predicted naive seasonal_naive actual segment_order", "segment_order"),
    ]
    return " UNION ALL ".join(_section(i, *part) for i, part in enumerate(parts, 1))


SELECTS["export_document"] = export_sql()


def oracle_sql() -> dict[str, str]:
    return {name: query(select) for name, select in SELECTS.items()}

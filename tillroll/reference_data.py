"""Reference tables of fixed size: codes that are not goods, the segment map, segments."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tillroll.params import Parameters

# Stock codes that are not goods, their kind and why.
NON_PRODUCT_CODES = [
    ("POST", "freight", "postage charged to the customer"),
    ("DOT", "freight", "postage of web sales"),
    ("C2", "freight", "carriage"),
    ("C3", "freight", "no description, price 0 only"),
    ("BANK CHARGES", "fee", "bank fee"),
    ("AMAZONFEE", "fee", "marketplace commission"),
    ("CRUK", "fee", "charity commission"),
    ("D", "discount", "discount"),
    ("M", "manual", "manual amount without a product"),
    ("m", "manual", "manual amount, lower case"),
    ("ADJUST", "adjustment", "manual adjustment"),
    ("ADJUST2", "adjustment", "manual adjustment"),
    ("B", "adjustment", "bad-debt adjustment (A invoices)"),
    ("S", "sample", "samples"),
    ("GIFT", "gift_voucher", "no description, price 0 only"),
    ("gift_0001_10", "gift_voucher", "gift voucher of 10"),
    ("gift_0001_20", "gift_voucher", "gift voucher of 20"),
    ("gift_0001_30", "gift_voucher", "gift voucher of 30"),
    ("gift_0001_40", "gift_voucher", "gift voucher of 40"),
    ("gift_0001_50", "gift_voucher", "gift voucher of 50"),
    ("gift_0001_60", "gift_voucher", "gift voucher of 60"),
    ("gift_0001_70", "gift_voucher", "gift voucher of 70"),
    ("gift_0001_80", "gift_voucher", "gift voucher of 80"),
    ("gift_0001_90", "gift_voucher", "gift voucher of 90"),
    ("TEST001", "test", "test product"),
    ("TEST002", "test", "test product"),
]

CHAMPIONS, LOYAL, POTENTIAL, NEW, PROMISING = (
    "Champions",
    "Loyal",
    "Potential loyalists",
    "New",
    "Promising",
)
ATTENTION, CANNOT_LOSE, AT_RISK, HIBERNATING, LOST = (
    "Need attention",
    "Cannot lose",
    "At risk",
    "Hibernating",
    "Lost",
)

# The segment of each recency score (row) and frequency score 1..5 (column).
SEGMENT_OF_SCORES = {
    1: (LOST, LOST, AT_RISK, AT_RISK, CANNOT_LOSE),
    2: (HIBERNATING, HIBERNATING, AT_RISK, AT_RISK, CANNOT_LOSE),
    3: (ATTENTION, ATTENTION, LOYAL, LOYAL, LOYAL),
    4: (PROMISING, POTENTIAL, LOYAL, CHAMPIONS, CHAMPIONS),
    5: (NEW, POTENTIAL, LOYAL, CHAMPIONS, CHAMPIONS),
}

# Display order and suggested action of each segment.
SEGMENTS = [
    (CHAMPIONS, 1, "Reward; ask for referrals; early access to launches."),
    (LOYAL, 2, "Loyalty programme; offer higher-value items."),
    (POTENTIAL, 3, "Encourage the next purchase; suggest new categories."),
    (NEW, 4, "Welcome, and a quick second purchase."),
    (PROMISING, 5, "Remind them of the shop; light offer."),
    (ATTENTION, 6, "Time-limited offer; win back before they cool."),
    (CANNOT_LOSE, 7, "Personal contact: good customers idle for long."),
    (AT_RISK, 8, "Personalised win-back campaign."),
    (HIBERNATING, 9, "Cheap win-back campaign."),
    (LOST, 10, "Do not invest; mass communication only."),
]

# Upper bound in days, order and label of the churn bands.
CHURN_BANDS = [
    (90, 1, "up to 90 days"),
    (180, 2, "91 to 180 days"),
    (365, 3, "181 to 365 days"),
    (None, 4, "over 365 days"),
]

# Upper bound in days, order and label of the recency bands in the customer view.
RECENCY_BANDS = [
    (30, 1, "0-30 days"),
    (90, 2, "31-90 days"),
    (180, 3, "91-180 days"),
    (365, 4, "181-365 days"),
    (None, 5, "Over 1 year"),
]

MODELS = ("predicted", "seasonal_naive", "naive")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, Decimal)):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def literal_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table inlined into the plan, so its size is known and it broadcasts itself."""
    fields = [part.strip().split(" ", 1) for part in schema.split(", ")]
    names = ", ".join(name for name, _ in fields)
    casts = ", ".join(f"CAST({name} AS {dtype}) AS {name}" for name, dtype in fields)
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")


def non_product_codes(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "code string, kind string, reason string", NON_PRODUCT_CODES)


def segment_map(spark: SparkSession) -> DataFrame:
    cells = [
        (r, f, segment)
        for r, row in SEGMENT_OF_SCORES.items()
        for f, segment in enumerate(row, start=1)
    ]
    return literal_table(spark, "r int, f int, segment string", cells)


def segments(spark: SparkSession) -> DataFrame:
    rows = [(order, segment, action) for segment, order, action in SEGMENTS]
    return literal_table(spark, "segment_order int, segment string, action string", rows)


def parameter_table(spark: SparkSession, params: Parameters) -> DataFrame:
    return literal_table(spark, "name string, value string, description string", params.rows())

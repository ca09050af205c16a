"""Hand-built invoice lines."""

import random
from datetime import datetime, timedelta

from tillroll.operators.clean import clean
from tillroll.operators.orders import build_orders
from tillroll.params import Parameters
from tillroll.plans.layers import Layers
from tillroll.reference_data import non_product_codes
from tillroll.schemas import RAW_COLUMNS, RAW_LINE

OLD, NEW = "Year 2009-2010", "Year 2010-2011"
PARAMS = Parameters()


def line(
    sheet=NEW,
    invoice="536365",
    stock_code="85123A",
    quantity="6",
    date="2011-01-10 10:00:00",
    price="2.55",
    customer="17850",
    country="United Kingdom",
    description="a lamp",
):
    return (sheet, invoice, stock_code, description, quantity, date, price, customer, country)


def buy(customer, invoice, date, quantity=1, price="10.00", code="85123A", country="United Kingdom"):
    """A sale; a cancellation with an invoice C... and a negative quantity."""
    return line(
        invoice=invoice,
        stock_code=code,
        quantity=str(quantity),
        date=date if " " in date else f"{date} 10:00:00",
        price=price,
        customer=None if customer is None else str(customer),
        country=country,
    )


def raw_of(spark, lines):
    rows = [(sheet, "fixture", i + 2, *cells) for i, (sheet, *cells) in enumerate(lines)]
    assert all(len(row) == 3 + len(RAW_COLUMNS) for row in rows)
    return spark.createDataFrame(rows, RAW_LINE).coalesce(1)


def clean_of(spark, lines):
    return clean(raw_of(spark, lines), non_product_codes(spark), PARAMS.batches)


def orders_of(spark, lines):
    return build_orders(clean_of(spark, lines))


def layers_of(spark, lines, params=PARAMS, **options):
    return Layers(raw_of(spark, lines), non_product_codes(spark), params, **options)


def by(frame, key, *columns):
    """{key: (columns...)}; a key of several columns is a tuple."""
    keys = (key,) if isinstance(key, str) else key
    result = {}
    for row in frame.collect():
        name = tuple(row[k] for k in keys)
        result[name if len(name) > 1 else name[0]] = tuple(row[c] for c in columns)
    return result


def trade(seed, customers=12, purchases=60, start=datetime(2009, 12, 5), days=735):
    """Random sales and cancellations as (customer or None, moment, units); units below 0 cancel."""
    own = random.Random(seed)
    people = [None, *range(20011, 20011 + customers)]
    events = []
    for _ in range(purchases):
        moment = start + timedelta(minutes=30 * own.randrange(48 * days))
        moment += timedelta(hours=2) if moment.hour == 1 else timedelta(0)
        events.append((own.choice(people), moment, own.choice([1, 2, 3, 5, 8, -1, -2])))
    return events


def lines_of(events):
    """One invoice line per event, at 10.00 a unit."""
    return [
        buy(who, f"{'C' if units < 0 else ''}{700000 + i}", str(moment), units)
        for i, (who, moment, units) in enumerate(events)
    ]

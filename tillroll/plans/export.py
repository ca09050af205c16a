"""The aggregate export: nine sections of small tables as one JSON document.

Refused unless the run's checks exist and all passed, and never with a customer's data in it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.cohorts import monthly_revenue, settled
from tillroll.operators.duplicates import cleaning_report
from tillroll.params import Parameters
from tillroll.plans.report import clv_by_segment, headline, segment_summary
from tillroll.reference_data import MODELS


class ExportError(RuntimeError):
    """The run is not in a state to be exported."""


def _json(value: Column, dtype: T.DataType) -> Column:
    """JSON text: decimals as numbers of at most four places without idle zeros, dates as ISO
    text, nested values alike."""
    if isinstance(dtype, T.DecimalType):
        digits = F.round(value, 4).cast("string")
        text = F.when(digits.contains("."), F.regexp_replace(digits, r"\.?0+$", "")).otherwise(digits)
    elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        text = F.concat(F.lit('"'), F.substring(value.cast("string"), 1, 10), F.lit('"'))
    elif isinstance(dtype, T.StructType):
        fields = [(f.name, _json(value.getField(f.name), f.dataType)) for f in dtype]
        text = _object(fields)
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda item: _json(item, dtype.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    elif isinstance(dtype, T.StringType):
        listed = F.to_json(F.array(value))
        text = F.substr(listed, F.lit(2), F.length(listed) - 2)
    else:
        text = value.cast("string")
    return F.when(value.isNull(), F.lit("null")).otherwise(text)


def _object(fields: list[tuple[str, Column]]) -> Column:
    members = [F.concat(F.lit(f'"{name}":'), text) for name, text in fields]
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def check_exportable(quality: DataFrame) -> None:
    counts = quality.agg(F.count_if(~F.col("ok")).alias("failed"), F.count(F.lit(1)).alias("n"))
    row = counts.first()
    if row.n == 0 or row.failed:
        raise ExportError(f"{row.failed} of {row.n} checks failed: nothing is exported")


@dataclass(frozen=True)
class Section:
    """A small table, the order of its rows, and whether it is one object or a list."""

    rows: DataFrame
    order: tuple[Column, ...] = ()
    single: bool = False


def sections(
    *,
    raw: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    churn_validation: DataFrame,
    churn_band: DataFrame,
    cohorts: DataFrame,
    clv_validation: DataFrame,
    clv_validation_customer: DataFrame,
    quality: DataFrame,
    params: Parameters,
    overlap_from: Column | None = None,
) -> dict[str, Section]:
    """The nine sections. All are aggregates whose size months, segments and cut-offs bound."""
    monthly = monthly_revenue(orders, params.end)
    model_order = F.array_position(F.array(*[F.lit(m) for m in MODELS]), F.col("model"))
    newest_first = -F.unix_date("cutoff")
    return {
        "summary": Section(headline(monthly, customer, quality), single=True),
        "cleaning": Section(cleaning_report(raw, params.batches, overlap_from), single=True),
        "monthly_revenue": Section(
            monthly.select(
                "month",
                "partial_month",
                "sale_with_customer",
                "sale_without_customer",
                "cancelled_product",
                "active_customers",
                "new_customers",
            ),
            (F.col("month"),),
        ),
        "segments": Section(
            segment_summary(customer).drop("mean_ticket"), (F.col("segment_order"),)
        ),
        "churn": Section(
            churn_validation.drop("window_months", "tp", "fp", "fn", "tn"),
            (newest_first, F.col("days")),
        ),
        "churn_bands": Section(churn_band, (newest_first, F.col("ord"))),
        "cohorts": Section(
            settled(cohorts).select("cohort", "size", "months_since", "retention"),
            (F.col("cohort"), F.col("months_since")),
        ),
        "clv_validation": Section(clv_validation, (model_order,)),
        "clv_segments": Section(
            clv_by_segment(clv_validation_customer), (F.col("segment_order"),)
        ),
    }


def refuse_individuals(parts: Mapping[str, Section]) -> None:
    named = [name for name, part in parts.items() if "customer_id" in part.rows.columns]
    if named:
        raise ExportError(f"sections with single customers: {named}")


def section_text(part: Section) -> DataFrame:
    """One row: the section as JSON text, rows in display order."""
    text = _object([(f.name, _json(F.col(f.name), f.dataType)) for f in part.rows.schema])
    order = [column.alias(f"o{i}") for i, column in enumerate(part.order)]
    rows = part.rows.select(F.struct(*order, text.alias("text")).alias("row"))
    listed = F.transform(F.array_sort(F.collect_list("row")), lambda row: row.getField("text"))
    joined = F.array_join(listed, ",")
    wrapped = joined if part.single else F.concat(F.lit("["), joined, F.lit("]"))
    return rows.agg(wrapped.alias("body"))


def document(parts: Mapping[str, Section]) -> DataFrame:
    """One row per section: its place, name and JSON body."""
    refuse_individuals(parts)
    bodies = [
        section_text(part).select(
            F.lit(place).alias("place"), F.lit(name).alias("section"), F.col("body").alias("json")
        )
        for place, (name, part) in enumerate(parts.items(), start=1)
    ]
    return reduce(DataFrame.unionByName, bodies)


def checked_document(parts: Mapping[str, Section], quality: DataFrame) -> DataFrame:
    """The document of a run whose checks exist and all passed; else an error and no rows."""
    check_exportable(quality)
    return document(parts)


def export(parts: Mapping[str, Section], quality: DataFrame, path: str) -> None:
    """Write the sections as one JSON document, a single line of text."""
    whole_document = checked_document(parts, quality)
    entry = F.concat(F.lit('"'), F.col("section"), F.lit('":'), F.col("json"))
    entries = F.array_sort(F.collect_list(F.struct("place", entry.alias("entry"))))
    text = F.array_join(F.transform(entries, lambda item: item.getField("entry")), ",")
    whole = whole_document.agg(F.concat(F.lit("{"), text, F.lit("}")).alias("value"))
    whole.write.text(path)

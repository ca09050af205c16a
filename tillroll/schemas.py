"""Schemas of the stored tables. Nothing is inferred when data is read."""

RAW_COLUMNS = (
    "invoice",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
)

# A line's place in its source: batch, file and row. The first two name the workbook's sheet
# when there is one file per batch.
LINE_KEY = ("sheet", "source_file", "source_row")

RAW_LINE = (
    "sheet string, source_file string, source_row bigint, "
    + ", ".join(f"{name} string" for name in RAW_COLUMNS)
)

# Column titles of the source sheets.
SOURCE_TITLES = {
    "invoice": "Invoice",
    "stock_code": "StockCode",
    "description": "Description",
    "quantity": "Quantity",
    "invoice_date": "InvoiceDate",
    "unit_price": "Price",
    "customer_id": "Customer ID",
    "country": "Country",
}

"""Table schemas and keys. Names and types are fixed values of the data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, INT, BIGINT = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, DATE, TIMESTAMP = T.DoubleType(), T.DateType(), T.TimestampType()


def schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# --- retail -----------------------------------------------------------------
RETAIL = {
    "customers": schema(
        customer_id=INT, first_name=STRING, last_name=STRING, email=STRING, phone_number=STRING,
        registration_date=DATE, membership_status=STRING
    ),
    "products": schema(
        product_id=INT, product_name=STRING, category=STRING, price=T.DecimalType(10, 2), supplier=STRING,
        stock_quantity=INT
    ),
    "sales": schema(
        sale_id=INT, customer_id=INT, product_id=INT, quantity_sold=INT, sale_date=DATE,
        total_amount=T.DecimalType(10, 2)
    ),
    "inventory": schema(product_id=INT, stock_quantity=INT),
}
RETAIL_KEYS = {"customers": "customer_id", "products": "product_id", "sales": "sale_id", "inventory": "product_id"}
# (child table, child column, parent table)
RETAIL_REFERENCES = [
    ("sales", "customer_id", "customers"),
    ("sales", "product_id", "products"),
    ("inventory", "product_id", "products"),
]
# Declared text lengths, checked as data quality.
RETAIL_LENGTHS = {
    "customers": {"first_name": 50, "last_name": 50, "email": 100, "phone_number": 50, "membership_status": 10},
    "products": {"product_name": 100, "category": 50, "supplier": 100},
}

# --- commerce CSV inputs ----------------------------------------------------
COMMERCE = {
    "orders": schema(
        order_id=STRING, customer_id=STRING, order_date=STRING, status=STRING, total_amount=DOUBLE,
        discount_pct=DOUBLE
    ),
    "order_items": schema(
        item_id=STRING, order_id=STRING, product_id=STRING, category=STRING, quantity=INT, unit_price=DOUBLE
    ),
    "customers": schema(
        customer_id=STRING, email=STRING, country=STRING, customer_tier=STRING, signup_date=STRING
    ),
    "returns": schema(return_id=STRING, order_id=STRING, return_date=STRING, refund_amount=DOUBLE, reason=STRING),
}
COMMERCE_KEYS = {"orders": "order_id", "order_items": "item_id", "customers": "customer_id", "returns": "return_id"}

# What cleaning does to which columns, beside requiring the key.
COMMERCE_DATES = {"orders": ("order_date",), "customers": ("signup_date",), "returns": ("return_date",)}
COMMERCE_LOWERED = {"customers": ("customer_tier",)}
COMMERCE_ALSO_REQUIRED = {"orders": ("customer_id",)}
COMMERCE_NOT_BELOW_ZERO = {"orders": "total_amount"}

REJECT_COUNTS = schema(table_name=STRING, row_count=BIGINT, rejected_count=BIGINT)

# --- market messages --------------------------------------------------------
PRICE_MESSAGE = schema(symbol=STRING, price=DOUBLE, timestamp=STRING)
TRADE_MESSAGE = schema(symbol=STRING, price=DOUBLE, quantity=DOUBLE, timestamp=STRING)


@dataclass(frozen=True)
class Contract:
    """A keyed table: its schema, its key, and the column reads are ordered by."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    order: str | None = None
    newest_first: bool = False


CONTRACTS = {
    c.name: c
    for c in (
        Contract(
            "minute_price_avg",
            schema(
                symbol=STRING, window_start=TIMESTAMP, window_end=TIMESTAMP, avg_price=DOUBLE, min_price=DOUBLE,
                max_price=DOUBLE, tick_count=BIGINT
            ),
            ("symbol", "window_start"), "window_start", True,
        ),
        Contract(
            "hourly_price_avg",
            schema(
                symbol=STRING, window_start=TIMESTAMP, window_end=TIMESTAMP, avg_price=DOUBLE, min_price=DOUBLE,
                max_price=DOUBLE, price_stddev=DOUBLE, tick_count=BIGINT
            ),
            ("symbol", "window_start"), "window_start", True,
        ),
        Contract(
            "volatility_metrics",
            schema(
                symbol=STRING, timestamp=TIMESTAMP, price=DOUBLE, rolling_avg=DOUBLE, rolling_stddev=DOUBLE,
                volatility_pct=DOUBLE
            ),
            ("symbol", "timestamp"), "timestamp",
        ),
        Contract(
            "trade_volume",
            schema(
                symbol=STRING, window_start=TIMESTAMP, window_end=TIMESTAMP, total_volume_usd=DOUBLE,
                total_quantity=DOUBLE, trade_count=BIGINT, avg_trade_price=DOUBLE, min_trade_price=DOUBLE,
                max_trade_price=DOUBLE
            ),
            ("symbol", "window_start"), "window_start", True,
        ),
        Contract(
            "anomalies",
            schema(
                symbol=STRING, timestamp=TIMESTAMP, price=DOUBLE, avg_price=DOUBLE, stddev_price=DOUBLE,
                z_score=DOUBLE
            ),
            ("symbol", "timestamp"), "timestamp",
        ),
        Contract(
            "latest_prices",
            schema(symbol=STRING, price=DOUBLE, timestamp=TIMESTAMP, avg_price=DOUBLE, volatility_pct=DOUBLE),
            ("symbol",),
        ),
        Contract(
            "weather_data",
            schema(
                city=STRING, extracted_at=TIMESTAMP, temperature_c=DOUBLE, humidity=INT, wind_kph=DOUBLE,
                condition=STRING
            ),
            ("city", "extracted_at"), "extracted_at",
        ),
    )
}

# --- landed API documents ---------------------------------------------------
PRICE_TICK_DOC = schema(symbol=STRING, price=STRING)
# Bars are positional: 0 open time ms, 1 open, 2 high, 3 low, 4 close, 5 volume, 6 close time ms.
KLINE_DOC = schema(symbol=STRING, interval=STRING, klines=T.ArrayType(T.ArrayType(STRING)))
TRADE_DOC = schema(symbol=STRING, trades=T.ArrayType(schema(id=BIGINT, price=STRING, qty=STRING, time=BIGINT)))
COIN_DOC = schema(
    id=STRING, name=STRING, symbol=STRING, rank=INT, last_updated=STRING,
    quotes=schema(USD=schema(price=DOUBLE, volume_24h=DOUBLE, market_cap=DOUBLE, percent_change_24h=DOUBLE)),
)
STOCK_DOC = schema(
    ticker=STRING,
    results=T.ArrayType(schema(t=BIGINT, o=DOUBLE, h=DOUBLE, l=DOUBLE, c=DOUBLE, v=DOUBLE, vw=DOUBLE, n=BIGINT)),
)
GAS_PLACE = schema(
    currency=STRING, name=STRING, lowerName=STRING, gasoline=STRING, midGrade=STRING, premium=STRING, diesel=STRING
)
GAS_DOC = schema(state_code=STRING, result=schema(state=GAS_PLACE, cities=T.ArrayType(GAS_PLACE)))
WEATHER_DOC = schema(
    location=schema(name=STRING, region=STRING, country=STRING),
    current=schema(
        temp_c=DOUBLE, humidity=INT, wind_kph=DOUBLE, condition=schema(text=STRING), last_updated=STRING
    ),
)

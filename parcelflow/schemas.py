"""Declared schemas and the fixed status vocabulary.

Event times are timestamps everywhere and quantities are ``bigint``, so that an
item quantity times a package quantity cannot overflow an ``int``.
"""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Statuses and event types stored in the tables.
RECEIVED = "RECEIVED"
PENDING = "PENDING"
PROCESSING = "PROCESSING"
INTERRUPTED = "INTERRUPTED"
CANCELLED = "CANCELLED"
ORDER_CREATED = "ORDER_CREATED"
INVENTORY_UPDATED = "INVENTORY_UPDATED"

_STRING, _DOUBLE, _INT, _LONG = StringType(), DoubleType(), IntegerType(), LongType()
_TIME, _DATE = TimestampType(), DateType()


def _row(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def _strings(*names: str) -> dict[str, DataType]:
    return dict.fromkeys(names, _STRING)


_ADDRESS = _row(
    address_id=_STRING,
    neighborhood=_STRING,
    coordinates=ArrayType(_DOUBLE),
    **_strings("road", "house_number", "suburb", "city_district", "state", "postcode", "country"),
    lat=_DOUBLE,
    lon=_DOUBLE,
)
_PAYMENT = _row(**_strings("payment_method", "payment_status", "transaction_id"))
_PACKAGE = _row(
    package_id=_STRING, subpackage_id=_INT, quantity=_LONG, weight=_DOUBLE, volume=_DOUBLE
)
_ITEM = _row(
    **_strings("product_id", "product_name"),
    price=_DOUBLE,
    quantity=_LONG,
    packages=ArrayType(_PACKAGE),
)
_ITEM_V1 = _row(
    **_strings("product_id", "product_name"), price=_DOUBLE, weight=_DOUBLE, quantity=_LONG
)


def _envelope(item: StructType, **totals: DataType) -> StructType:
    return _row(
        event_id=_STRING,
        event_type=_STRING,
        event_timestamp=_TIME,
        order_id=_STRING,
        order_details=_row(
            customer_id=_STRING,
            order_timestamp=_TIME,
            order_date=_DATE,
            items=ArrayType(item),
            **totals,
            status=_STRING,
            destination_address=_ADDRESS,
            payment_details=_PAYMENT,
        ),
    )


ENVELOPE = _envelope(_ITEM, total_amount=_DOUBLE, total_volume=_DOUBLE, total_weight=_DOUBLE)

# The older generation: flat items that carry their own weight, no volume.
ENVELOPE_V1 = _envelope(_ITEM_V1, total_amount=_DOUBLE, total_weight=_DOUBLE)



def _order_part(envelope: StructType) -> StructType:
    """An envelope without its items, for what needs the order alone."""
    return StructType(
        [
            StructField(f.name, StructType([x for x in f.dataType if x.name != "items"]))
            if f.name == "order_details"
            else f
            for f in envelope
        ]
    )


ORDER_PART, ORDER_PART_V1 = _order_part(ENVELOPE), _order_part(ENVELOPE_V1)

# What the stock steps read of an envelope.
DEMAND_FIELDS = _row(
    order_details=_row(
        items=ArrayType(
            _row(
                quantity=_LONG,
                packages=ArrayType(_row(package_id=_STRING, subpackage_id=_INT, quantity=_LONG)),
            )
        )
    )
)

EVENTS = _row(event_id=_STRING, event_type=_STRING, event_timestamp=_TIME, order_id=_STRING)

ORDERS = _row(
    **_strings("order_id", "customer_id"),
    total_weight=_DOUBLE,
    total_volume=_DOUBLE,
    total_price=_DOUBLE,
    order_timestamp=_TIME,
    status=_STRING,
    lat=_DOUBLE,
    lon=_DOUBLE,
)

ORDER_ITEMS = _row(
    **_strings("inventory_id", "order_id", "product_id", "product_name"),
    order_price=_DOUBLE,
    package_id=_STRING,
    subpackage_id=_INT,
    items_quantity=_LONG,
    items_weight=_DOUBLE,
    items_volume=_DOUBLE,
    order_timestamp=_TIME,
    status=_STRING,
)

ORDER_ITEMS_V1 = _row(
    **_strings("inventory_id", "order_id", "product_id", "product_name"),
    quantity=_LONG,
    price=_DOUBLE,
    weight=_DOUBLE,
    order_timestamp=_TIME,
    status=_STRING,
)

PACKAGES = _row(package_id=_STRING, subpackage_id=_INT, stock_quantity=_LONG)

# Packages whose demand a batch was refused, with that demand.
SHORTAGES = _row(
    package_id=_STRING, subpackage_id=_INT, stock_quantity=_LONG, items_quantity=_LONG
)

STATUS_CHANGES = _row(**_strings("order_id", "old_status", "new_status"))

PRODUCTS = _row(
    product_id=_STRING, quantity=_LONG, availability=BooleanType(), updated_at=_TIME
)

# A stream record: its bytes, or the same bytes as base64 text.
RAW_RECORD = _row(data=BinaryType())
RAW_TEXT_RECORD = _row(data=_STRING)

"""Declared schemas: operational tables, and warehouse tables with their constraints."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from graphlib import TopologicalSorter


# Warehouse types whose processed snapshot holds another type.
PROCESSED_TYPES = {"DATE": "STRING", "TIME": "STRING", "DECIMAL": "DOUBLE"}


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    nullable: bool = False


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    key: str


@dataclass(frozen=True)
class Table:
    """The first column is the key; `serial` marks a key that the pipeline numbers itself."""

    name: str
    columns: tuple[Column, ...]
    foreign_keys: tuple[ForeignKey, ...] = field(default=())
    serial: bool = False

    @property
    def key(self) -> str:
        return self.columns[0].name

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def processed_ddl(self) -> str:
        """The schema of the processed snapshot, where dates and times are text and prices doubles."""
        return ", ".join(f"{c.name} {PROCESSED_TYPES.get(c.type.split('(')[0], c.type)}" for c in self.columns)

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]


def table(name: str, columns: str, references: dict[str, str] | None = None, serial: bool = False) -> Table:
    """`columns` is a DDL list; a trailing ? allows nulls. `references` maps column to dimension."""
    parsed = []
    for item in columns.split(", "):
        column, kind = item.split()
        parsed.append(Column(column, kind.rstrip("?"), kind.endswith("?")))
    keys = tuple(ForeignKey(c, t, DIMENSION_KEYS[t]) for c, t in (references or {}).items())
    return Table(name, tuple(parsed), keys, serial)


# The operational tables. Timestamps and dates arrive as ISO text.
SOURCES = {
    "address": "address_id INT, address_line_1 STRING, address_line_2 STRING, district STRING, "
    "city STRING, postal_code STRING, country STRING, phone STRING, created_at STRING, last_updated STRING",
    "counterparty": "counterparty_id INT, counterparty_legal_name STRING, legal_address_id INT, "
    "commercial_contact STRING, delivery_contact STRING, created_at STRING, last_updated STRING",
    "currency": "currency_id INT, currency_code STRING, created_at STRING, last_updated STRING",
    "department": "department_id INT, department_name STRING, location STRING, manager STRING, "
    "created_at STRING, last_updated STRING",
    "design": "design_id INT, design_name STRING, file_location STRING, file_name STRING, "
    "created_at STRING, last_updated STRING",
    "sales_order": "sales_order_id INT, created_at STRING, last_updated STRING, design_id INT, staff_id INT, "
    "counterparty_id INT, units_sold INT, unit_price DOUBLE, currency_id INT, agreed_delivery_date STRING, "
    "agreed_payment_date STRING, agreed_delivery_location_id INT",
    "staff": "staff_id INT, first_name STRING, last_name STRING, department_id INT, email_address STRING, "
    "created_at STRING, last_updated STRING",
    "payment_type": "payment_type_id INT, payment_type_name STRING, created_at STRING, last_updated STRING",
    # Extension: columns follow from the declared targets, no sample of these tables is known.
    "payment": "payment_id INT, created_at STRING, last_updated STRING, transaction_id INT, counterparty_id INT, "
    "payment_amount DOUBLE, currency_id INT, payment_type_id INT, paid BOOLEAN, payment_date STRING",
    "purchase_order": "purchase_order_id INT, created_at STRING, last_updated STRING, staff_id INT, "
    "counterparty_id INT, item_code STRING, item_quantity INT, item_unit_price DOUBLE, currency_id INT, "
    "agreed_delivery_date STRING, agreed_payment_date STRING, agreed_delivery_location_id INT",
    "transaction": "transaction_id INT, transaction_type STRING, sales_order_id INT, purchase_order_id INT, "
    "created_at STRING, last_updated STRING",
}

# The warehouse. The first column is the key; TIME is stored as HH:mm:ss.SSS text.
DIMENSION_KEYS = {
    "dim_date": "date_id",
    "dim_staff": "staff_id",
    "dim_location": "location_id",
    "dim_currency": "currency_id",
    "dim_design": "design_id",
    "dim_counterparty": "counterparty_id",
    "dim_payment_type": "payment_type_id",
    "dim_transaction": "transaction_id",
}

SALES_TABLES = (
    table(
        "dim_date",
        "date_id DATE, year INT, month INT, day INT, day_of_week INT, day_name STRING, month_name STRING, "
        "quarter INT",
    ),
    table("dim_design", "design_id INT, design_name STRING, file_location STRING, file_name STRING"),
    table(
        "dim_location",
        "location_id INT, address_line_1 STRING, address_line_2 STRING?, district STRING?, city STRING, "
        "postal_code STRING, country STRING, phone STRING",
    ),
    table(
        "dim_counterparty",
        "counterparty_id INT, counterparty_legal_name STRING, counterparty_legal_address_line_1 STRING, "
        "counterparty_legal_address_line_2 STRING?, counterparty_legal_district STRING?, "
        "counterparty_legal_city STRING, counterparty_legal_postal_code STRING, "
        "counterparty_legal_country STRING, counterparty_legal_phone_number STRING",
    ),
    table(
        "dim_staff",
        "staff_id INT, first_name STRING, last_name STRING, department_name STRING, location STRING, "
        "email_address STRING",
    ),
    table("dim_currency", "currency_id INT, currency_code STRING, currency_name STRING"),
    table(
        "fact_sales_order",
        "sales_record_id BIGINT, sales_order_id INT, created_date DATE, created_time TIME, "
        "last_updated_date DATE, last_updated_time TIME, sales_staff_id INT, counterparty_id INT, "
        "units_sold INT, unit_price DECIMAL(10,2), currency_id INT, design_id INT, agreed_payment_date DATE, "
        "agreed_delivery_date DATE, agreed_delivery_location_id INT",
        {
            "created_date": "dim_date",
            "last_updated_date": "dim_date",
            "sales_staff_id": "dim_staff",
            "counterparty_id": "dim_counterparty",
            "currency_id": "dim_currency",
            "design_id": "dim_design",
            "agreed_payment_date": "dim_date",
            "agreed_delivery_date": "dim_date",
            "agreed_delivery_location_id": "dim_location",
        },
        serial=True,
    ),
)

# Extension: declared targets that the sales pipeline does not fill.
EXTENSION_TABLES = (
    table("dim_payment_type", "payment_type_id INT, payment_type_name STRING"),
    table(
        "dim_transaction",
        "transaction_id INT, transaction_type STRING, sales_order_id INT?, purchase_order_id INT?",
    ),
    table(
        "fact_purchase_order",
        "purchase_record_id BIGINT, purchase_order_id INT, created_date DATE, created_time TIME, "
        "last_updated_date DATE, last_updated_time TIME, staff_id INT, counterparty_id INT, item_code STRING, "
        "item_quantity INT, item_unit_price DECIMAL(38,18), currency_id INT, agreed_delivery_date DATE, "
        "agreed_payment_date DATE, agreed_delivery_location_id INT",
        {
            "created_date": "dim_date",
            "last_updated_date": "dim_date",
            "staff_id": "dim_staff",
            "counterparty_id": "dim_counterparty",
            "currency_id": "dim_currency",
            "agreed_delivery_date": "dim_date",
            "agreed_payment_date": "dim_date",
            "agreed_delivery_location_id": "dim_location",
        },
        serial=True,
    ),
    table(
        "fact_payment",
        "payment_record_id BIGINT, payment_id INT, created_date DATE, created_time TIME, "
        "last_updated_date DATE, last_updated_time TIME, transaction_id INT, counterparty_id INT, "
        "payment_amount DECIMAL(38,18), currency_id INT, payment_type_id INT, paid BOOLEAN, payment_date DATE",
        {
            "created_date": "dim_date",
            "last_updated_date": "dim_date",
            "transaction_id": "dim_transaction",
            "counterparty_id": "dim_counterparty",
            "currency_id": "dim_currency",
            "payment_type_id": "dim_payment_type",
            "payment_date": "dim_date",
        },
        serial=True,
    ),
)

WAREHOUSE = {t.name: t for t in SALES_TABLES + EXTENSION_TABLES}
SALES_NAMES = [t.name for t in SALES_TABLES]

# The operational tables that each target is built from, and that facts are numbered by.
TARGET_SOURCES = {
    "dim_date": (),
    "dim_design": ("design",),
    "dim_location": ("address",),
    "dim_counterparty": ("counterparty", "address"),
    "dim_staff": ("staff", "department"),
    "dim_currency": ("currency",),
    "dim_payment_type": ("payment_type",),
    "dim_transaction": ("transaction",),
    "fact_sales_order": ("sales_order",),
    "fact_purchase_order": ("purchase_order",),
    "fact_payment": ("payment",),
}
FACT_KEYS = {"fact_sales_order": "sales_order_id", "fact_purchase_order": "purchase_order_id", "fact_payment": "payment_id"}


class MissingReference(ValueError):
    """Tables that refer to others which are not among them."""


def load_order(names: Iterable[str], tables: Mapping[str, Table] | None = None) -> list[str]:
    """The tables, each after those that it refers to. A cycle raises graphlib.CycleError, a gap MissingReference."""
    tables, names = tables or WAREHOUSE, list(names)
    graph = {name: sorted({k.table for k in tables[name].foreign_keys}) for name in names}
    gaps = sorted({(name, to) for name, others in graph.items() for to in others if to not in graph})
    if gaps:
        raise MissingReference("; ".join(f"{name} refers to {to}, which is not loaded with it" for name, to in gaps))
    return list(TopologicalSorter(graph).static_order())


# The operational tables that the sales star schema is built from.
SALES_SOURCES = ("sales_order", "design", "address", "counterparty", "staff", "department", "currency")

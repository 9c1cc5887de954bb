"""The golden rows as operational tables."""

import golden
from starloom.specs import SOURCES

STAMP = "2022-11-03T14:20:49.962"


def columns(table):
    return [c.split()[0] for c in SOURCES[table].split(", ")]


def frame(spark, table, records):
    """Records given as dicts; absent columns are null."""
    return spark.createDataFrame([tuple(r.get(c) for c in columns(table)) for r in records], SOURCES[table])


def stamped(**record):
    return {"created_at": STAMP, "last_updated": STAMP, **record}


def sales_order_records():
    for line in golden.SALES_ORDERS.strip().splitlines():
        order, day, time, staff, party, units, price, currency, design, delivery, payment, place = line.split()
        yield {
            "sales_order_id": int(order),
            "created_at": f"{day}T{time}",
            "last_updated": f"{day}T{time}",
            "design_id": int(design),
            "staff_id": int(staff),
            "counterparty_id": int(party),
            "units_sold": int(units),
            "unit_price": float(price),
            "currency_id": int(currency),
            "agreed_delivery_date": delivery,
            "agreed_payment_date": payment,
            "agreed_delivery_location_id": int(place),
        }


def sales_order(spark, **changes):
    return frame(spark, "sales_order", [{**r, **changes} for r in sales_order_records()])


def address(spark):
    names = columns("address")[:8]
    return frame(spark, "address", [stamped(**dict(zip(names, a))) for a in golden.ADDRESSES])


def counterparty(spark):
    return frame(
        spark,
        "counterparty",
        [stamped(counterparty_id=i, legal_address_id=a, counterparty_legal_name=n) for i, a, n in golden.COUNTERPARTIES],
    )


def department(spark):
    names = sorted({(d, place) for *_, d, place in golden.STAFF})
    return frame(
        spark,
        "department",
        [stamped(department_id=i, department_name=d, location=p, manager="M") for i, (d, p) in enumerate(names)],
    )


def staff(spark):
    names = [d for d, _ in sorted({(d, place) for *_, d, place in golden.STAFF})]
    return frame(
        spark,
        "staff",
        [
            stamped(
                staff_id=i,
                first_name=first,
                last_name=last,
                department_id=names.index(d),
                email_address=f"{first}.{last}@example.com".lower(),
            )
            for i, first, last, d, _ in golden.STAFF
        ],
    )


def currency(spark, *extra):
    codes = [(i, code) for i, code, _ in golden.CURRENCIES] + list(extra)
    return frame(spark, "currency", [stamped(currency_id=i, currency_code=c) for i, c in codes])


def design(spark):
    names = ["design_id", "design_name", "file_location", "file_name"]
    return frame(spark, "design", [stamped(**dict(zip(names, d))) for d in golden.DESIGNS])


def consistent(spark):
    """All sources of one batch, with every reference of the golden orders met."""
    orders = list(sales_order_records())

    def used(column):
        return sorted({r[column] for r in orders})

    return {
        "sales_order": frame(spark, "sales_order", orders),
        "design": frame(
            spark,
            "design",
            [stamped(design_id=i, design_name="D", file_location="/usr", file_name="f.json") for i in used("design_id")],
        ),
        "address": frame(
            spark,
            "address",
            [
                stamped(address_id=i, address_line_1="1 A", city="C", postal_code="P", country="Z", phone="0")
                for i in used("agreed_delivery_location_id")
            ],
        ),
        "counterparty": frame(
            spark,
            "counterparty",
            [
                stamped(counterparty_id=i, counterparty_legal_name=f"N{i}", legal_address_id=8)
                for i in used("counterparty_id")
            ],
        ),
        "staff": frame(
            spark,
            "staff",
            [
                stamped(staff_id=i, first_name="F", last_name="L", department_id=1, email_address="f.l@example.com")
                for i in used("staff_id")
            ],
        ),
        "department": frame(
            spark, "department", [stamped(department_id=1, department_name="Sales", location="Leeds", manager="M")]
        ),
        "currency": currency(spark),
    }

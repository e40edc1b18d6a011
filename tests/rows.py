"""Small hand-made transaction frames."""

from tillscope.schema import COLUMNS, RAW, TYPED

CUSTOMER = "STD_123456789"
GOOD = {
    "transaction_id": "TXN_10000",
    "transaction_date": "2023-05-06",
    "transaction_time": "12:34:56",
    "customer_id": CUSTOMER,
    "product_id": "FOO_1234",
    "quantity": "3",
    "unit_price": "10.5",
    "total_amount": "31.5",
    "payment_method": "CASH",
    "store_location": "Hanoi",
}


def raw(spark, *changes):
    """One raw row per set of changes to a good row, numbered by transaction id."""
    rows = [GOOD | {"transaction_id": f"TXN_{i}"} | c for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], RAW)


def sales(spark, rows):
    """Typed rows from (customer, date text, amount) or (customer, date text, amount, product)."""
    from datetime import date

    typed = [
        (
            f"TXN_{i}",
            day and date.fromisoformat(day),
            "00:00:00",
            customer,
            product[0] if product else "FOO_1000",
            1,
            amount,
            amount,
            "CASH",
            "Hanoi",
        )
        for i, (customer, day, amount, *product) in enumerate(rows)
    ]
    return spark.createDataFrame(typed, TYPED)


def amounts(spark, values):
    return sales(spark, [("STD_1", "2024-01-01", v) for v in values])

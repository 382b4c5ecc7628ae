"""A small bank: ten customers, ten accounts, five rules, twelve transactions."""

from datetime import date, datetime
from decimal import Decimal

from vigil import schemas

# The sample rows.
PEOPLE = [
    ("Ivan", "Petrenko", "ivan.petrenko@example.com", "1985-05-15", "UA", True),
    ("Olena", "Koval", "olena.k@example.com", "1990-10-20", "UA", True),
    ("John", "Doe", "john.doe@example.com", "1978-02-11", "US", True),
    ("Maria", "Garcia", "maria.garcia@example.es", "1992-07-08", "ES", True),
    ("Taras", "Shevchenko", "taras.sh@example.ua", "1980-03-09", "UA", True),
    ("Anna", "Smith", "anna.smith@example.gb", "1995-11-25", "GB", True),
    ("Pedro", "Pascal", "pedro.p@example.cl", "1975-04-02", "CL", False),
    ("Yoko", "Ono", "yoko.o@example.jp", "1988-12-12", "JP", True),
    ("Liam", "Neeson", "liam.n@example.ie", "1965-06-07", "IE", True),
    ("Sofia", "Muller", "sofia.m@example.de", "1999-01-30", "DE", True),
]
HOLDINGS = [
    ("UAH", "15000.50", "ACTIVE"), ("USD", "2500.00", "ACTIVE"), ("USD", "100.00", "FROZEN"),
    ("EUR", "4500.75", "ACTIVE"), ("UAH", "0.00", "CLOSED"), ("EUR", "12340.00", "ACTIVE"),
    ("USD", "5000.00", "FROZEN"), ("USD", "8900.00", "ACTIVE"), ("EUR", "670.20", "ACTIVE"),
    ("EUR", "34000.00", "ACTIVE"),
]
RULES = [
    (1, "High Amount Transaction", "AMOUNT", 50000, True),
    (2, "Suspicious Foreign Country", "COUNTRY", 1, True),
    (3, "High Velocity - 5 TX per min", "VELOCITY", 5, True),
    (4, "Nighttime Suspicious Behavior", "TIME", 1, True),
    (5, "Multiple Declined Attempts", "BEHAVIOR", 3, True),
]
PURCHASES = [
    (1, "550.00", "UAH", "Groceries", "UA", "2026-05-30 10:15:00"),
    (2, "120.00", "USD", "Software", "US", "2026-05-30 11:00:00"),
    (2, "2000.00", "USD", "Electronics", "CN", "2026-05-30 11:05:00"),
    (3, "50.00", "USD", "Entertainment", "US", "2026-05-31 09:30:00"),
    (4, "15.50", "EUR", "Coffee Shop", "ES", "2026-05-31 08:45:00"),
    (4, "3000.00", "EUR", "Travel", "FR", "2026-05-31 14:20:00"),
    (6, "850.00", "EUR", "Clothing", "GB", "2026-06-01 09:00:00"),
    (7, "100.00", "USD", "Gambling", "MT", "2026-06-01 01:15:00"),
    (8, "45.00", "USD", "Restaurants", "JP", "2026-06-01 12:30:00"),
    (9, "65000.00", "EUR", "Luxury", "AE", "2026-05-29 16:40:00"),
    (10, "12.00", "EUR", "Transport", "DE", "2026-06-01 08:10:00"),
    (10, "15.00", "EUR", "Transport", "DE", "2026-06-01 08:35:00"),
]
AS_OF = "2026-06-02 00:00:00"


def customers(spark):
    opened = datetime(2026, 1, 1)
    rows = [
        (i, first, last, email, date.fromisoformat(born), country, opened, active)
        for i, (first, last, email, born, country, active) in enumerate(PEOPLE, 1)
    ]
    return spark.createDataFrame(rows, schemas.CUSTOMERS)


def accounts(spark):
    rows = [
        (i, i, f"NUMBER{i:02d}", currency, Decimal(balance), status, datetime(2026, 1, 1))
        for i, (currency, balance, status) in enumerate(HOLDINGS, 1)
    ]
    return spark.createDataFrame(rows, schemas.ACCOUNTS)


def rules(spark):
    return spark.createDataFrame(RULES, schemas.FRAUD_RULES)


def alerts(spark, rows=()):
    return spark.createDataFrame(list(rows), schemas.FRAUD_ALERTS)


def transactions(spark):
    rows = [
        (i, account, account, Decimal(amount), currency, category, country, "PENDING", 0,
         datetime.fromisoformat(at))
        for i, (account, amount, currency, category, country, at) in enumerate(PURCHASES, 1)
    ]
    return spark.createDataFrame(rows, schemas.TRANSACTIONS)

import datetime as dt
from decimal import Decimal


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def dec(x) -> Decimal:
    return Decimal(str(x))

"""Bars for the tests."""

import datetime as dt

BAR_SCHEMA = ("symbol string, date date, open double, high double, low double, close double, "
              "adj_close double, volume bigint")


def day(i: int, start=dt.date(2024, 1, 1)) -> dt.date:
    return start + dt.timedelta(days=i)


def bar(symbol, i, price, volume=100, open_=None, start=dt.date(2024, 1, 1)):
    o = price if open_ is None else open_
    return (symbol, day(i, start), float(o), float(max(o, price) + 1), float(min(o, price) - 1), float(price),
            None if price is None else float(price), int(volume))

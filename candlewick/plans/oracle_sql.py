"""DuckDB SQL text for the correctness oracle of every checked query.

The oracle states each operator in plain window/aggregate SQL over the
unsegmented series (``PARTITION BY symbol``) so that it checks the Spark
plan (segmented, halo'd, partially aggregated) against the textbook
definition.  Doubles are compared in the canonical form (``cn``).
"""

from __future__ import annotations

BARS_ORDERS = """
SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
       arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
       min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
       arg_max(o_totalprice, o_orderkey) AS adj_close, count(*) AS volume
FROM orders GROUP BY 1, 2
"""

BARS_LINEITEM = """
SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
       arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS open,
       max(l_extendedprice) AS high, min(l_extendedprice) AS low,
       arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS close,
       arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS adj_close,
       count(*) AS volume
FROM lineitem GROUP BY 1, 2
"""

W = "PARTITION BY symbol ORDER BY date"


def frame(n: int, part: str = W) -> str:
    return f"({part} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def guarded(fn: str, c: str, n: int, part: str = W) -> str:
    f = frame(n, part)
    return f"CASE WHEN count({c}) OVER {f} = {n} THEN {fn}({c}) OVER {f} END"


def returns_cte(src: str = "bars", price: str = "adj_close", part: str = W) -> str:
    lp = f"CASE WHEN {price} > 0 THEN ln({price}) END"
    return f"SELECT *, {lp} - lag({lp}) OVER ({part}) AS log_return_1 FROM {src}"


def feature_exprs(price: str = "adj_close", part: str = W) -> list[tuple[str, str]]:
    r = "log_return_1"
    out = [(f"r_lag_{k}", f"lag({r}, {k}) OVER ({part})") for k in (1, 2, 5)]
    for n in (3, 5, 10):
        out += [
            (f"r_mean_{n}", guarded("avg", r, n, part)),
            (f"r_std_{n}", guarded("stddev_samp", r, n, part)),
            (f"r_min_{n}", guarded("min", r, n, part)),
            (f"r_max_{n}", guarded("max", r, n, part)),
        ]
    out.append(("vol_lag_1", f"lag(volume, 1) OVER ({part})"))
    for n in (5, 10):
        out += [(f"vol_mean_{n}", guarded("avg", "volume", n, part)), (f"vol_std_{n}", guarded("stddev_samp", "volume", n, part))]
    out += [
        ("hl_range", "CAST(high - low AS DOUBLE)"),
        ("oc_body", "CAST(close - open AS DOUBLE)"),
        ("hl_range_pct", "(high - low) / nullif(open, 0)"),
        ("oc_body_pct", "(close - open) / nullif(open, 0)"),
    ]
    out.append(("price_lag_1", f"lag({price}, 1) OVER ({part})"))
    for n in (5, 10):
        out += [(f"price_mean_{n}", guarded("avg", price, n, part)), (f"price_std_{n}", guarded("stddev_samp", price, n, part))]
    return out


FEATURE_NAMES = [n for n, _ in feature_exprs()]
BAR_VALUE_COLUMNS = ["open", "high", "low", "close", "adj_close", "volume"]
ALL_FEATURES = sorted(BAR_VALUE_COLUMNS + ["log_return_1"] + FEATURE_NAMES)


def features_ctes(bars_sql: str = BARS_ORDERS, horizon: int | None = None) -> str:
    """CTEs ``bars`` -> ``r`` (returns) -> ``f`` (all features [+ target])."""
    feats = ",\n       ".join(f"{e} AS {n}" for n, e in feature_exprs())
    target = f",\n       lead(log_return_1, {horizon}) OVER ({W}) AS target" if horizon else ""
    return f"""bars AS (SELECT symbol, date, open, high, low, close, adj_close, CAST(volume AS DOUBLE) AS volume
               FROM ({bars_sql}) b0),
r AS ({returns_cte()}),
f AS (SELECT *,
       {feats}{target}
      FROM r)"""


def cn(expr: str) -> str:
    """Canonical comparison form of a double (same as ``functions.columns.canonical``)."""
    return f"CAST(CAST(round({expr}, 9) AS FLOAT) AS DOUBLE)"


def r6(cols) -> str:
    return ", ".join(f"{cn(c)} AS {c}" for c in cols)


def training_rows_ctes(bars_sql: str = BARS_ORDERS, horizon: int = 1) -> str:
    """CTE ``t``: complete rows (all 36 features and the target present)."""
    cond = " AND ".join(f"{c} IS NOT NULL" for c in ALL_FEATURES + ["target"])
    return features_ctes(bars_sql, horizon) + f",\nt AS (SELECT * FROM f WHERE {cond})"


# One request per (symbol, month): odd months send the bars, even months
# send last_close + the month's log returns; December asks for horizon 31.
REQUESTS = f"""
WITH rb AS (SELECT * FROM ({BARS_ORDERS}) b),
g AS (SELECT symbol || ':' || strftime(date, '%Y-%m') AS request_id, symbol, max(month(date)) AS m,
             max(date) AS last_date,
             list(adj_close ORDER BY date) AS p,
             list({{'date': strftime(date, '%Y-%m-%d'), 'open': open, 'high': high, 'low': low, 'close': close,
                    'adj_close': adj_close, 'volume': CAST(volume AS DOUBLE)}} ORDER BY date) AS bars
      FROM rb GROUP BY 1, 2)
SELECT request_id, symbol, CAST(CASE WHEN m = 12 THEN 31 ELSE 1 END AS INTEGER) AS horizon,
       strftime(last_date, '%Y-%m-%d') AS as_of,
       CASE WHEN m % 2 = 0 THEN p[len(p)] END AS last_close,
       CASE WHEN m % 2 = 0 THEN list_transform(range(2, len(p) + 1), lambda i: ln(p[i]) - ln(p[i - 1])) END AS last_returns,
       CASE WHEN m % 2 = 1 THEN bars END AS ohlcv_window
FROM g
"""

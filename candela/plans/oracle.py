"""Independent SQL (DuckDB dialect) for every named query.

The SQL restates each definition directly: bars by arg_min / arg_max over the
full line order, exact integer window sums, and the exponential averages as
a recursive CTE (the textbook recurrence, row after row), which checks the
block-scanned Spark form.
"""

from __future__ import annotations

from candela.plans.catalog import (
    BATCH1_END, BATCH2_START, CHECK_DECIMALS, EMA_FAMILY, LANDED_FROM, LANDED_TO, OVERBOUGHT, REFETCH_START, SECOND_CUT, TICKER, TOP_K,
)
from candela.schemas import TABLES

LINE_ORDER = "row(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)"


def _bars_body(ticker_expr: str, source: str) -> str:
    return f"""
  SELECT {ticker_expr} AS ticker,
         CAST(l_shipdate AS DATE) AS date,
         arg_min(l_extendedprice, {LINE_ORDER}) AS open,
         max(l_extendedprice) AS high,
         min(l_extendedprice) AS low,
         arg_max(l_extendedprice, {LINE_ORDER}) AS close,
         CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM {source}
  GROUP BY 1, 2"""


SUPPLIER_TICKER = "printf('S%06d', l_suppkey)"
BARS = f"bars AS MATERIALIZED ({_bars_body(SUPPLIER_TICKER, 'lineitem')})"
BRAND_BARS = f"bars AS MATERIALIZED ({_bars_body('p_brand', 'lineitem JOIN part ON l_partkey = p_partkey')})"

PRICES = """prices AS MATERIALIZED (
  SELECT date, ticker, round_even(open, 3) AS open, round_even(high, 3) AS high,
         round_even(low, 3) AS low, round_even(close, 3) AS close, volume
  FROM bars WHERE ticker IS NOT NULL)"""

COMPANIES = """companies AS (
  SELECT replace(printf('S%06d', s_suppkey), '.', '-') AS ticker,
         s_name AS name, r_name AS sector, n_name AS industry
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""

FUNDAMENTALS = """fundamentals AS (
  SELECT printf('S%06d', s_suppkey) AS ticker, s_name AS name,
         CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST((s_suppkey*37) % 450 AS DOUBLE)/10 END AS per,
         CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE CAST((s_suppkey*13) % 30 AS DOUBLE)/100 END AS roe,
         CAST((s_suppkey*17) % 50 - 20 AS DOUBLE)/100 AS eps_growth_yoy,
         CAST((s_suppkey*29) % 300 AS DOUBLE) AS deuda_patrimonio,
         CAST((s_suppkey*7) % 40 AS DOUBLE)/100 AS margen_neto,
         CAST((s_suppkey*3) % 8 AS DOUBLE)/2 AS dividend_yield,
         CAST(round(s_acctbal*1000) AS BIGINT) AS market_cap,
         s_suppkey*1000 + 1000 AS acciones_circulacion
  FROM supplier WHERE s_suppkey % 17 <> 16)"""

FUND_RANKED = """fund_ranked AS (
  SELECT ticker, name, per, roe, eps_growth_yoy, deuda_patrimonio, margen_neto, dividend_yield,
         market_cap,
         CAST(CASE WHEN market_cap IS NOT NULL THEN
              row_number() OVER (PARTITION BY market_cap IS NULL ORDER BY market_cap DESC, ticker) END
              AS INTEGER) AS ranking_marketcap,
         acciones_circulacion
  FROM fundamentals)"""


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _a(span: int) -> float:
    return 2.0 / (span + 1.0)


# Per-row thousandths, differences, true range.
UNITS = """units AS MATERIALIZED (
  SELECT date, ticker, open, high, low, close, volume,
         CAST(round(close * 1000) AS BIGINT) AS cu,
         CAST(round(high * 1000) AS BIGINT) AS hu,
         CAST(round(low * 1000) AS BIGINT) AS lu,
         row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn
  FROM prices),
diffs AS (
  SELECT *, cu - lag(cu) OVER w AS dcu,
         greatest(hu - lu, abs(hu - lag(cu) OVER w), abs(lu - lag(cu) OVER w)) AS tru,
         close - lag(close) OVER w AS dclose
  FROM units WINDOW w AS (PARTITION BY ticker ORDER BY date))"""


def _mean(col: str, n: int, win: str) -> str:
    return (f"CASE WHEN count({col}) OVER {win} = {n} THEN "
            f"CAST(sum({col}) OVER {win} AS DOUBLE) / {_d(1000.0 * n)} END")


def _std(col: str, n: int, win: str) -> str:
    s1 = f"(sum({col}) OVER {win})"
    s2 = f"(sum(CAST({col} AS HUGEINT) * {col}) OVER {win})"
    return (f"CASE WHEN count({col}) OVER {win} = {n} THEN "
            f"sqrt(CAST({n} * {s2} - {s1} * {s1} AS DOUBLE) / {_d(float(n * (n - 1)))}) / {_d(1000.0)} END")


_SG = "sum(CASE WHEN dcu > 0 THEN dcu ELSE 0 END) OVER w14"
_SL = "sum(CASE WHEN dcu < 0 THEN -dcu ELSE 0 END) OVER w14"
RSI = (f"CASE WHEN count(dcu) OVER w14 = 14 THEN "
       f"CASE WHEN {_SL} = 0 THEN CASE WHEN {_SG} > 0 THEN {_d(100.0)} END "
       f"ELSE {_d(100.0)} - {_d(100.0)} / ({_d(1.0)} + CAST({_SG} AS DOUBLE) / CAST({_SL} AS DOUBLE)) END END")

OBV = ("CAST(sum(CASE WHEN dclose > 0 THEN volume WHEN dclose < 0 THEN -volume ELSE 0 END) "
       "OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)")

WINDOWS = """WINDOW w14 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
       w20 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
       w50 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
       wt AS (PARTITION BY ticker)"""

ROLLING = f"""rolling AS MATERIALIZED (
  SELECT date, ticker, close, rn,
         {_mean('cu', 20, 'w20')} AS sma_20,
         {_mean('cu', 50, 'w50')} AS sma_50,
         {RSI} AS rsi_14,
         {_mean('tru', 14, 'w14')} AS atr_14,
         {OBV} AS obv,
         {_mean('cu', 20, 'w20')} AS bb_middle,
         {_mean('cu', 20, 'w20')} + {_d(2.0)} * {_std('cu', 20, 'w20')} AS bb_upper,
         {_mean('cu', 20, 'w20')} - {_d(2.0)} * {_std('cu', 20, 'w20')} AS bb_lower,
         {_std('cu', 20, 'w20')} AS volatility_20,
         max(close) OVER wt AS fmax, min(close) OVER wt AS fmin,
         arg_max(close, date) OVER wt AS flast
  FROM diffs
  {WINDOWS})"""

FIB_RATIOS = [("fib_0_0", "0.0%", None), ("fib_23_6", "23.6%", 0.236), ("fib_38_2", "38.2%", 0.382),
              ("fib_50_0", "50.0%", 0.5), ("fib_61_8", "61.8%", 0.618), ("fib_100", "100%", None)]


def _fib_expr(name: str, ratio) -> str:
    if name == "fib_0_0":
        return "fmax"
    if name == "fib_100":
        return "fmin"
    return f"fmax - (fmax - fmin) * {_d(ratio)}"


FIB = ("fib AS (SELECT *, " + ", ".join(f"{_fib_expr(n, r)} AS {n}" for n, _l, r in FIB_RATIOS)
       + " FROM rolling)")
_DIST = {n: f"abs(flast - {n})" for n, _l, _r in FIB_RATIOS}


def _nearest() -> str:
    names = [n for n, _l, _r in FIB_RATIOS]
    labels = {n: lbl for n, lbl, _r in FIB_RATIOS}
    whens = []
    for i, n in enumerate(names[:-1]):
        rest = names[i + 1:]
        whens.append(f"WHEN {_DIST[n]} <= least({', '.join(_DIST[m] for m in rest)}) THEN '{labels[n]}'")
    return f"CASE WHEN flast IS NULL THEN '0.0%' {' '.join(whens)} ELSE '100%' END"


FIB_NEAR = f"""fibn AS (
  SELECT *, {_nearest()} AS nivel_fib_cercano FROM fib),
fibs AS (
  SELECT *, CASE WHEN nivel_fib_cercano IN ('38.2%', '50.0%', '61.8%') THEN 'SOPORTE'
                 WHEN nivel_fib_cercano IN ('0.0%', '23.6%') THEN 'RESISTENCIA'
                 ELSE 'NEUTRO' END AS estado_fibonacci FROM fibn)"""

a20, a12, a26, a9 = _a(20), _a(12), _a(26), _a(9)
EMA_REC = f"""ema_rec AS (
  SELECT ticker, rn, close AS e20, close AS e12, close AS e26, CAST(0 AS DOUBLE) AS sig
  FROM units WHERE rn = 1
  UNION ALL
  SELECT u.ticker, u.rn,
         {_d(1 - a20)} * r.e20 + {_d(a20)} * u.close,
         {_d(1 - a12)} * r.e12 + {_d(a12)} * u.close,
         {_d(1 - a26)} * r.e26 + {_d(a26)} * u.close,
         {_d(1 - a9)} * r.sig + {_d(a9)} * (({_d(1 - a12)} * r.e12 + {_d(a12)} * u.close)
                                           - ({_d(1 - a26)} * r.e26 + {_d(a26)} * u.close))
  FROM ema_rec r JOIN units u ON u.ticker = r.ticker AND u.rn = r.rn + 1)"""

P = CHECK_DECIMALS
INDICATORS = f"""ind AS (
  SELECT f.date, f.ticker, f.close, f.sma_20, f.sma_50,
         round(e.e20, {P}) + {_d(0.0)} AS ema_20, f.rsi_14,
         round(e.e12 - e.e26, {P}) + {_d(0.0)} AS macd, round(e.sig, {P}) + {_d(0.0)} AS macd_signal,
         round((e.e12 - e.e26) - e.sig, {P}) + {_d(0.0)} AS macd_hist,
         f.atr_14, f.obv, f.bb_middle, f.bb_upper, f.bb_lower, f.volatility_20,
         f.fib_0_0, f.fib_23_6, f.fib_38_2, f.fib_50_0, f.fib_61_8, f.fib_100,
         f.nivel_fib_cercano, f.estado_fibonacci,
         e.e20 AS ema_20_raw, e.e12 - e.e26 AS macd_raw, e.sig AS macd_signal_raw
  FROM fibs f JOIN ema_rec e ON e.ticker = f.ticker AND e.rn = f.rn)"""

IND_COLS = ("date, ticker, close, sma_20, sma_50, ema_20, rsi_14, macd, macd_signal, macd_hist, "
            "atr_14, obv, bb_middle, bb_upper, bb_lower, volatility_20, fib_0_0, fib_23_6, fib_38_2, "
            "fib_50_0, fib_61_8, fib_100, nivel_fib_cercano, estado_fibonacci")


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes)


IND_CHAIN = (BARS, PRICES, UNITS, ROLLING, FIB, FIB_NEAR, EMA_REC, INDICATORS)
ROLL_CHAIN = (BARS, PRICES, UNITS, ROLLING)

T = f"'{TICKER}'"
AS_OF = "(SELECT max(date) FROM bars)"
BATCHES = f"""b1 AS (SELECT * FROM prices WHERE date <= DATE '{BATCH1_END}'),
b2 AS (SELECT date, ticker, open, high, low, close + {_d(1.0)} AS close, volume
       FROM prices WHERE date >= DATE '{BATCH2_START}')"""


def _exceeds(a: str, b: str, price: str) -> str:
    return f"({a} - {b} > {_d(1e-12)} * greatest(abs({a}), abs({b}), abs({price})))"


def _signal_ab(a: str, b: str) -> str:
    return (f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN "
            f"CASE WHEN {_exceeds(a, b, 'i.close')} THEN 'COMPRAR' ELSE 'VENDER' END END")


def _band(x: str, buy: str, sell: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {buy} THEN 'COMPRAR' WHEN {sell} THEN 'VENDER' ELSE 'MANTENER' END"


def _count(cols, label):
    return " + ".join(f"(CASE WHEN {c} = '{label}' THEN 1 ELSE 0 END)" for c in cols)


def _present(cols):
    return " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in cols)


def _share(cols):
    return (f"CASE WHEN ({_present(cols)}) > 0 THEN round_even(CAST({_count(cols, 'COMPRAR')} AS DOUBLE) "
            f"/ CAST({_present(cols)} AS DOUBLE) * {_d(100.0)}, 2) END")


TECH = ["s_sma", "s_macd", "s_rsi", "s_fib"]
FUND = ["s_per", "s_roe", "s_eps", "s_debt"]
SUMMARY = f"""last_ind AS (
  SELECT * FROM ind QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1),
sig AS (
  SELECT i.ticker, i.close, i.bb_upper, i.bb_lower, i.estado_fibonacci,
         {_signal_ab('i.sma_20', 'i.ema_20_raw')} AS s_sma,
         {_signal_ab('i.macd_raw', 'i.macd_signal_raw')} AS s_macd,
         {_band('i.rsi_14', 'i.rsi_14 < 30', 'i.rsi_14 > 70')} AS s_rsi,
         {_band('i.estado_fibonacci', "i.estado_fibonacci = 'SOPORTE'", "i.estado_fibonacci = 'RESISTENCIA'")} AS s_fib,
         {_band('f.per', 'f.per < 20', 'f.per > 30')} AS s_per,
         {_band('f.roe', 'f.roe > 0.15', 'f.roe < 0.05')} AS s_roe,
         {_band('f.eps_growth_yoy', 'f.eps_growth_yoy > 0.10', 'f.eps_growth_yoy < 0')} AS s_eps,
         {_band('f.deuda_patrimonio', 'f.deuda_patrimonio < 100', 'f.deuda_patrimonio > 200')} AS s_debt
  FROM last_ind i JOIN fundamentals f ON f.ticker = i.ticker)"""

SUMMARY_SELECT = f"""SELECT ticker,
       {_share(TECH)} AS pct_tecnico_buy,
       {_share(FUND)} AS pct_fundamental_buy,
       CASE WHEN ({_count(TECH + FUND, 'COMPRAR')}) > ({_count(TECH + FUND, 'VENDER')}) THEN 'COMPRAR'
            WHEN ({_count(TECH + FUND, 'VENDER')}) > ({_count(TECH + FUND, 'COMPRAR')}) THEN 'VENDER'
            ELSE 'MANTENER' END AS decision_final,
       CASE WHEN close IS NOT NULL AND bb_upper IS NOT NULL AND bb_lower IS NOT NULL THEN
            CASE WHEN close > bb_upper THEN 'Sobrecompra' WHEN close < bb_lower THEN 'Sobreventa'
                 ELSE 'Normal' END END AS estado_bollingerbands,
       s_sma AS sma_vs_ema, s_macd AS macd, s_rsi AS rsi, s_per AS per, s_roe AS roe,
       s_eps AS eps_growth_yoy, s_debt AS deuda_patrimonio, estado_fibonacci
FROM sig"""


def _ret(k: int, name: str) -> str:
    base = f"NULLIF(lag(close, {k}) OVER w, 0)"
    return f"round_even((close / {base} - {_d(1.0)}) * {_d(10000.0)}, 0) / {_d(10000.0)} + {_d(0.0)} AS var_{name}"


QUOTE_KEYS = [("shortName", "name", "VARCHAR", "''"), ("sector", "sector", "VARCHAR", "''"),
              ("industry", "industry", "VARCHAR", "''"), ("marketCap", "market_cap", "BIGINT", "0"),
              ("trailingPE", "per", "DOUBLE", None), ("returnOnEquity", "roe", "DOUBLE", None),
              ("earningsQuarterlyGrowth", "eps_growth_yoy", "DOUBLE", None),
              ("debtToEquity", "deuda_patrimonio", "DOUBLE", None),
              ("profitMargins", "margen_neto", "DOUBLE", None), ("dividendYield", "dividend_yield", "DOUBLE", None),
              ("sharesOutstanding", "acciones_circulacion", "BIGINT", None)]


def _quote_col(key, name, typ, default):
    v = f"CAST(json_extract_string(props, '$.{key}') AS {typ})"
    if default is not None:
        v = f"coalesce({v}, CAST({default} AS {typ}))"
    return f"{v} AS {name}"


def _until(cut) -> tuple[str, ...]:
    """The indicator chain over the lines shipped until ``cut``."""
    lines = "lineitem" if cut is None else f"(SELECT * FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '{cut}')"
    return (f"bars AS MATERIALIZED ({_bars_body(SUPPLIER_TICKER, lines)})", *IND_CHAIN[1:])


def _by_days(cuts: list, select: str) -> str:
    """Rows of each step, as a whole run until its end has them."""
    parts, low = [], None
    for cut in cuts:
        after = "" if low is None else f" WHERE date > DATE '{low}'"
        parts.append(f"SELECT * FROM ({_with(*_until(cut), recursive=True)} {select}){after}")
        low = cut
    return " UNION ALL ".join(parts)


def _as_stored(column: str, table: str) -> str:
    """A value after the cast of its stored column, decimal digits half away
    from zero, as a double."""
    kind = TABLES[table][column].dataType.simpleString()
    if not kind.startswith("decimal"):
        return column
    stored = f"CAST(CAST({column} AS VARCHAR) AS {kind})"
    if table == "indicadores_tecnicos" and column in EMA_FAMILY:
        stored = f"round({stored}, {CHECK_DECIMALS})"
    return f"CAST({stored} AS DOUBLE) + {_d(0.0)} AS {column}"


def _stored() -> dict[str, str]:
    q = {}
    q["indicators_incremental"] = _by_days([BATCH1_END, SECOND_CUT, None], f"SELECT {IND_COLS} FROM ind")
    raw = IND_COLS.replace("ema_20", "ema_20_raw AS ema_20").replace("macd, macd_signal, macd_hist",
                           "macd_raw AS macd, macd_signal_raw AS macd_signal, macd_raw - macd_signal_raw AS macd_hist")
    columns = ", ".join(_as_stored(c, "indicadores_tecnicos") for c in IND_COLS.split(", "))
    q["stored_indicators"] = f"SELECT {columns} FROM ({_by_days([BATCH1_END, None], f'SELECT {raw} FROM ind')})"
    prices = ", ".join(_as_stored(c, "precios_historicos") for c in ("date", "ticker", "open", "high", "low", "close", "volume"))
    q["stream_refresh"] = (f"{_with(BARS, PRICES, BATCHES)}, merged AS (SELECT * FROM b2 WHERE date > (SELECT max(date) FROM b1) "
                           f"UNION ALL SELECT * FROM b1) SELECT {prices} FROM merged")
    q["csv_round_trip"] = f"{_with(BARS, PRICES)} SELECT * FROM prices"
    q["landed_prices"] = f"{_with(BARS, PRICES)} SELECT * FROM prices WHERE date >= DATE '{LANDED_FROM}' AND date < DATE '{LANDED_TO}'"
    one, all_ = f"(SELECT count(*) FROM prices WHERE date <= DATE '{BATCH1_END}')", "(SELECT count(*) FROM prices)"
    held = "(SELECT count(*) FROM fundamentals WHERE ticker IN (SELECT ticker FROM prices{}))"
    keyed = {"empresas": ["(SELECT count(*) FROM companies)"] * 3, "indicadores_fundamentales": ["(SELECT count(*) FROM fundamentals)"] * 3,
             "resumen_inversion": [held.format(f" WHERE date <= DATE '{BATCH1_END}'"), held.format(""), held.format("")]}
    rows = [f"SELECT CAST({d + 1} AS INTEGER) AS day, '{t}' AS \"table\", {n[d]} AS rows, true AS written, {n[d]} AS stored"
            for t, n in keyed.items() for d in range(3)]
    for t in ("precios_historicos", "indicadores_tecnicos", "precios_variaciones"):
        for d, (n, total) in enumerate([(one, one), (f"{all_} - {one}", all_), ("0", all_)]):
            rows.append(f"SELECT {d + 1}, '{t}', {n}, {'false' if d == 2 else 'true'}, {total}")
    q["stored_daily"] = f"{_with(BARS, PRICES, COMPANIES, FUNDAMENTALS)} {' UNION ALL '.join(rows)}"
    # quotes that came through, and the 500 largest of them and of the rest at 0
    fund = f"""fundamentals AS (
  SELECT printf('S%06d', s_suppkey) AS ticker, CAST(s_suppkey % 45 AS DOUBLE) AS per, CAST(NULL AS DOUBLE) AS roe,
         CAST(NULL AS DOUBLE) AS eps_growth_yoy, CAST(NULL AS DOUBLE) AS deuda_patrimonio
  FROM supplier WHERE s_suppkey % 13 <> 0),
universe AS (
  SELECT printf('S%06d', s_suppkey) AS ticker FROM supplier
  ORDER BY CASE WHEN s_suppkey % 13 <> 0 THEN s_suppkey * 1000 ELSE 0 END DESC, 1 LIMIT 500)"""
    chosen = PRICES.replace("ticker IS NOT NULL", "ticker IN (SELECT ticker FROM universe)")
    summary = ", ".join(_as_stored(f.name, "resumen_inversion") for f in TABLES["resumen_inversion"].fields)
    q["landed_daily"] = (f"SELECT {summary} FROM ({_with(fund, BARS, chosen, *IND_CHAIN[2:], SUMMARY, recursive=True)} {SUMMARY_SELECT})")
    q["stored_alerts"] = (
        f"{_with(*IND_CHAIN, recursive=True)} SELECT it.date, it.ticker, ph.close, it.sma_20, it.ema_20, "
        f"CASE WHEN {_exceeds('it.ema_20_raw', 'it.sma_20', 'it.close')} THEN 'POSIBLE VENTA' "
        f"WHEN {_exceeds('it.sma_20', 'it.ema_20_raw', 'it.close')} THEN 'POSIBLE COMPRA' ELSE 'NEUTRO' END AS decision_trading "
        f"FROM ind it LEFT JOIN prices ph ON it.ticker = ph.ticker AND it.date = ph.date "
        f"WHERE it.sma_20 IS NOT NULL AND it.ema_20_raw IS NOT NULL")
    q["load_rejects"] = f"""{_with(FUNDAMENTALS)}, ticks AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CASE WHEN l_partkey % 1000 <> 0 THEN {SUPPLIER_TICKER} END AS ticker FROM lineitem),
marked AS (
  SELECT date, ticker, CASE WHEN date IS NULL OR ticker IS NULL THEN 'null key'
         WHEN ticker NOT IN (SELECT ticker FROM fundamentals) THEN 'orphan' ELSE 'duplicate' END AS reason FROM ticks),
counted AS (SELECT reason, date, ticker, count(*) AS n FROM marked GROUP BY 1, 2, 3)
SELECT reason, date, ticker, CASE WHEN reason = 'duplicate' THEN n - 1 ELSE n END AS rows FROM counted WHERE reason <> 'duplicate' OR n > 1"""
    return q


def build() -> dict[str, str]:
    ind_chain = _with(*IND_CHAIN, recursive=True)
    roll = _with(*ROLL_CHAIN)
    q: dict[str, str] = {}
    q["bars"] = f"{_with(BARS)} SELECT date, ticker, open, high, low, close, volume FROM bars"
    q["clean_companies"] = f"{_with(COMPANIES)} SELECT ticker, name, sector, industry FROM companies"
    q["clean_prices"] = f"{_with(BARS, PRICES)} SELECT * FROM prices"
    q["quote_map_defaults"] = ("SELECT event_id, " + ", ".join(_quote_col(*k) for k in QUOTE_KEYS)
                               + ", CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
    q["wide_to_long"] = f"{_with(BRAND_BARS, PRICES)} SELECT date, ticker, open, high, low, close, volume FROM prices"
    q["daily_refresh"] = (f"{_with(BARS, PRICES, BATCHES)} SELECT * FROM b1 UNION ALL "
                          f"SELECT date, ticker, open, high, low, CASE WHEN date >= DATE '{REFETCH_START}' "
                          f"THEN close + {_d(1.0)} ELSE close END AS close, volume "
                          f"FROM b2 WHERE date > (SELECT max(date) FROM b1)")
    thirds = ", ".join(f"round_even({c} / {_d(7.0)}, 3) AS {c}" for c in ("open", "high", "low"))
    q["clean_prices_messy"] = (f"{_with(BARS)}, keyed AS (SELECT *, CAST(substr(ticker, 2) AS BIGINT) AS k FROM bars) "
                               f"SELECT date, ticker, {thirds}, CASE WHEN k % 9 <> 0 THEN "
                               f"round_even(close / {_d(7.0)}, 3) END AS close, volume FROM keyed WHERE k % 10 <> 0")
    quotes = """quotes AS (
  SELECT CASE WHEN s_suppkey % 2 = 0 THEN printf('S%06d-B', s_suppkey) ELSE printf('S%06d', s_suppkey) END AS ticker,
         s_suppkey AS k, s_name, s_suppkey % 7 <> 0 AND s_suppkey % 5 <> 0 AS present,
         s_suppkey % 7 <> 0 AND s_suppkey % 5 <> 0 AND s_suppkey % 11 <> 0 AS whole,
         CAST(CASE s_suppkey % 3 WHEN 0 THEN s_suppkey * 1000 WHEN 1 THEN s_suppkey * 1000 + 7
              ELSE s_suppkey * 1000000 + 500000 END AS BIGINT) AS cap FROM supplier)"""
    q["universe_from_quotes"] = (f"WITH {quotes} SELECT ticker, CASE WHEN present THEN s_name ELSE '' END AS name, "
                                 f"CASE WHEN present AND NOT whole THEN 'x' ELSE '' END AS sector, '' AS industry, "
                                 f"CASE WHEN whole THEN cap ELSE 0 END AS market_cap FROM quotes "
                                 f"ORDER BY market_cap DESC, ticker LIMIT {TOP_K}")
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in
                      ("roe", "eps_growth_yoy", "deuda_patrimonio", "margen_neto", "dividend_yield"))
    symbol = "CASE WHEN k % 2 = 0 THEN printf('S%06d.B', k) ELSE ticker END"
    q["fundamentals_from_quotes"] = (
        f"WITH {quotes} SELECT {symbol} AS ticker, CASE WHEN present THEN s_name END AS name, "
        f"CASE WHEN present AND NOT whole THEN 'x' END AS sector, CAST(NULL AS VARCHAR) AS industry, "
        f"CASE WHEN whole THEN cap END AS market_cap, CASE WHEN whole THEN CAST(k % 45 AS DOUBLE) END AS per, {nulls}, "
        f"CASE WHEN whole THEN CAST(k AS BIGINT) END AS acciones_circulacion FROM quotes WHERE k % 13 <> 0")
    q["distinct_tickers"] = f"{_with(BARS, PRICES)} SELECT DISTINCT ticker FROM prices WHERE ticker IS NOT NULL"
    q["top_market_cap"] = (f"{_with(COMPANIES, FUNDAMENTALS)} SELECT c.ticker, c.name, c.sector, c.industry, "
                           f"coalesce(f.market_cap, 0) AS market_cap FROM companies c "
                           f"LEFT JOIN fundamentals f ON f.ticker = c.ticker "
                           f"ORDER BY market_cap DESC, c.ticker LIMIT {TOP_K}")
    q["fundamentals_ranked"] = f"{_with(FUNDAMENTALS, FUND_RANKED)} SELECT * FROM fund_ranked"
    q["sma"] = f"{roll} SELECT date, ticker, close, sma_20, sma_50 FROM rolling"
    q["bollinger"] = f"{roll} SELECT date, ticker, close, bb_middle, bb_upper, bb_lower FROM rolling"
    q["volatility"] = f"{roll} SELECT date, ticker, close, volatility_20 FROM rolling"
    q["rsi"] = f"{roll} SELECT date, ticker, close, rsi_14 FROM rolling"
    q["atr"] = f"{roll} SELECT date, ticker, close, atr_14 FROM rolling"
    q["obv"] = f"{roll} SELECT date, ticker, close, obv FROM rolling"
    q["ema"] = f"{ind_chain} SELECT date, ticker, close, ema_20 FROM ind"
    q["macd"] = f"{ind_chain} SELECT date, ticker, close, macd, macd_signal, macd_hist FROM ind"
    q["fibonacci"] = (f"{_with(*ROLL_CHAIN, FIB, FIB_NEAR)} SELECT date, ticker, close, fib_0_0, fib_23_6, "
                      f"fib_38_2, fib_50_0, fib_61_8, fib_100, nivel_fib_cercano, estado_fibonacci FROM fibs")
    q["technical_indicators"] = f"{ind_chain} SELECT {IND_COLS} FROM ind"
    q["returns"] = (f"{_with(BRAND_BARS, PRICES)} SELECT date, ticker, close, "
                    + ", ".join(_ret(k, n) for n, k in [("daily", 1), ("weekly", 5), ("monthly", 21),
                                                        ("annual", 252), ("5y", 1260)])
                    + " FROM prices WINDOW w AS (PARTITION BY ticker ORDER BY date)")
    q["investment_summary"] = f"{_with(*IND_CHAIN, FUNDAMENTALS, SUMMARY, recursive=True)} {SUMMARY_SELECT}"
    q["q01"] = f"{_with(COMPANIES)} SELECT * FROM companies WHERE ticker = {T}"
    q["q02"] = f"{_with(BARS, PRICES)} SELECT * FROM prices WHERE ticker = {T} ORDER BY date DESC"
    q["q03"] = f"{_with(FUNDAMENTALS, FUND_RANKED)} SELECT * FROM fund_ranked WHERE ticker = {T}"
    q["q04"] = (f"{ind_chain} SELECT {IND_COLS} FROM ind WHERE ticker = {T} "
                f"AND date >= CAST({AS_OF} - INTERVAL 30 DAY AS DATE) ORDER BY date DESC")
    q["q05"] = (f"{ind_chain} SELECT ph.date, ph.close, it.sma_20, it.ema_20 FROM prices ph "
                f"LEFT JOIN ind it ON ph.ticker = it.ticker AND ph.date = it.date "
                f"WHERE ph.ticker = {T} AND ph.date >= CAST({AS_OF} - INTERVAL 60 DAY AS DATE) "
                f"ORDER BY ph.date DESC")
    q["q06"] = (f"{roll} SELECT date, ticker, volatility_20 FROM rolling WHERE ticker = {T} "
                f"AND volatility_20 IS NOT NULL ORDER BY volatility_20 DESC")
    q["q07"] = f"{roll} SELECT date, ticker, rsi_14 FROM rolling WHERE rsi_14 > {_d(OVERBOUGHT)} ORDER BY date DESC"
    q["q08"] = (f"{ind_chain} SELECT date, ticker, macd, macd_signal FROM ind WHERE ticker = {T} "
                f"AND {_exceeds('macd_raw', 'macd_signal_raw', 'close')} ORDER BY date DESC")
    q["q09"] = (f"{_with(BARS, PRICES)} SELECT CAST(year(date) AS INTEGER) AS anio, min(close) AS min_close, "
                f"max(close) AS max_close, "
                f"CAST(sum(CAST(round(close * 1000) AS BIGINT)) AS DOUBLE) / ({_d(1000.0)} * CAST(count(close) AS DOUBLE)) AS avg_close "
                f"FROM prices WHERE ticker = {T} GROUP BY 1 ORDER BY 1 DESC")
    q["q10"] = (f"{ind_chain} SELECT it.date, it.ticker, ph.close, it.sma_20, it.ema_20, "
                f"CASE WHEN {_exceeds('it.ema_20_raw', 'it.sma_20', 'it.close')} THEN 'POSIBLE VENTA' "
                f"WHEN {_exceeds('it.sma_20', 'it.ema_20_raw', 'it.close')} THEN 'POSIBLE COMPRA' "
                f"ELSE 'NEUTRO' END AS decision_trading "
                f"FROM ind it LEFT JOIN prices ph ON it.ticker = ph.ticker AND it.date = ph.date "
                f"WHERE it.ticker = {T} AND it.sma_20 IS NOT NULL AND it.ema_20_raw IS NOT NULL "
                f"ORDER BY it.date DESC")
    q["q11"] = (f"{roll} SELECT ph.date, ph.close, it.bb_upper, it.bb_lower, "
                f"CASE WHEN ph.close > it.bb_upper THEN 'Sobrecomprado' "
                f"WHEN ph.close < it.bb_lower THEN 'Sobrevendido' ELSE 'Neutral' END AS estado_bollinger "
                f"FROM prices ph LEFT JOIN rolling it ON ph.ticker = it.ticker AND ph.date = it.date "
                f"WHERE ph.ticker = {T} ORDER BY ph.date DESC LIMIT 1")
    q["q12"] = (f"{ind_chain} SELECT it.date, it.ticker, ph.close AS precio_actual, "
                f"round(it.rsi_14, 2) AS rsi_14, round(it.volatility_20, 2) AS volatilidad_20, "
                f"round(it.macd_raw, 4) + {_d(0.0)} AS macd, round(it.macd_signal_raw, 4) + {_d(0.0)} AS macd_signal, "
                f"CASE WHEN {_exceeds('it.macd_raw', 'it.macd_signal_raw', 'it.close')} THEN 'MACD: Señal de COMPRA' "
                f"WHEN {_exceeds('it.macd_signal_raw', 'it.macd_raw', 'it.close')} THEN 'MACD: Señal de VENTA' "
                f"ELSE 'MACD: Neutro' END AS estado_macd, "
                f"CASE WHEN ph.close > it.bb_upper THEN 'Precio FUERA de Bandas: Sobrecompra' "
                f"WHEN ph.close < it.bb_lower THEN 'Precio FUERA de Bandas: Sobreventa' "
                f"ELSE 'Precio dentro de Bandas' END AS estado_bollinger "
                f"FROM ind it LEFT JOIN prices ph ON it.ticker = ph.ticker AND it.date = ph.date "
                f"WHERE it.ticker = {T} ORDER BY it.date DESC LIMIT 20")
    anti = "NOT EXISTS (SELECT 1 FROM {o} x WHERE x.date = {s}.date AND x.ticker = {s}.ticker)"
    q["upsert_update"] = (f"{_with(BARS, PRICES, BATCHES)} SELECT * FROM b2 UNION ALL "
                          f"SELECT * FROM b1 WHERE {anti.format(o='b2', s='b1')}")
    q["upsert_ignore"] = (f"{_with(BARS, PRICES, BATCHES)} SELECT * FROM b1 UNION ALL "
                          f"SELECT * FROM b2 WHERE {anti.format(o='b1', s='b2')}")
    q["upsert_incremental"] = (f"{_with(BARS, PRICES, BATCHES)} SELECT * FROM b2 "
                               f"WHERE date > (SELECT max(date) FROM b1) UNION ALL SELECT * FROM b1")
    target = (f"target AS (SELECT date, ticker, close + {_d(5.0)} AS close, CAST(-1 AS BIGINT) AS volume "
              f"FROM prices WHERE date <= DATE '{BATCH1_END}')")
    for name, pick in (("first", "arg_min"), ("last", "arg_max")):
        ticks = (f"ticks AS (SELECT CAST(l_shipdate AS DATE) AS date, {SUPPLIER_TICKER} AS ticker, "
                 f"{pick}(l_extendedprice, {LINE_ORDER}) AS close, "
                 f"CAST({pick}(l_quantity, {LINE_ORDER}) AS BIGINT) AS volume FROM lineitem GROUP BY 1, 2)")
        chain = _with(BARS, PRICES, target, ticks)
        over, under = ("target", "ticks") if name == "first" else ("ticks", "target")
        q[f"upsert_{name}_wins"] = (f"{chain} SELECT * FROM {over} UNION ALL SELECT * FROM {under} "
                                    f"WHERE {anti.format(o=over, s=under)}")
        if name == "last":
            q["upsert_preserve"] = (f"{chain} SELECT k.date, k.ticker, k.close, t.volume FROM ticks k "
                                    f"LEFT JOIN target t ON t.date = k.date AND t.ticker = k.ticker UNION ALL "
                                    f"SELECT * FROM target WHERE {anti.format(o='ticks', s='target')}")
    long_chain = _with(BRAND_BARS, *IND_CHAIN[1:], recursive=True)
    q["ema_long"] = f"{long_chain} SELECT date, ticker, close, ema_20 FROM ind"
    q["macd_long"] = f"{long_chain} SELECT date, ticker, close, macd, macd_signal, macd_hist FROM ind"
    q["technical_indicators_long"] = f"{long_chain} SELECT {IND_COLS} FROM ind"
    q["orphans"] = (f"{_with(BARS, PRICES, FUNDAMENTALS)} SELECT ticker, count(*) AS n_rows, "
                    f"min(date) AS first_date, max(date) AS last_date FROM prices p "
                    f"WHERE NOT EXISTS (SELECT 1 FROM fundamentals f WHERE f.ticker = p.ticker) GROUP BY ticker")
    q["duplicate_keys"] = ("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
                           "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
    return {**q, **_stored()}

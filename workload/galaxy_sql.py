"""SQL over the given tables that states, without any JSON or text, what each table must hold.

Each named block is a CTE; `with_blocks` adds the blocks a query needs.
"""

from __future__ import annotations

import re

BLOCKS: dict[str, str] = {}

# ---- exchange rates -------------------------------------------------------------------------
BLOCKS["fx_quote"] = """
    SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN 'SAR'
                WHEN '3-MEDIUM' THEN 'GBP' WHEN '4-NOT SPECIFIED' THEN 'CHF' ELSE 'JPY' END AS code,
           max(CAST(floor(o_totalprice) AS DECIMAL(18,0)) * 0.00001) AS quote
    FROM orders GROUP BY ALL"""
BLOCKS["fx_latest"] = """
    SELECT day, CASE status WHEN 'F' THEN 'EUR' ELSE 'USD' END AS base, code,
           arg_max(status, CASE status WHEN 'P' THEN 2 ELSE 1 END) AS status,
           arg_max(CASE WHEN code = 'CHF' AND day(day) = 13 THEN 0 ELSE quote END,
                   CASE status WHEN 'P' THEN 2 ELSE 1 END) AS rate
    FROM fx_quote
    WHERE NOT (status = 'P' AND quarter(day) = 4)
    GROUP BY 1, 2, 3"""
BLOCKS["fx_usd"] = """
    SELECT coalesce(u.day, e.day) AS day, coalesce(u.code, e.code) AS code,
           coalesce(u.per_usd, e.per_usd) AS per_usd
    FROM (SELECT day, code, CAST(rate AS DOUBLE) AS per_usd FROM fx_latest
          WHERE base = 'USD' AND rate > 0) AS u
    FULL JOIN (
        SELECT q.day, q.code, CAST(q.rate AS DOUBLE) / CAST(p.rate AS DOUBLE) AS per_usd
        FROM (SELECT day, code, rate FROM fx_latest WHERE base = 'EUR' AND rate > 0
              UNION ALL
              SELECT day, 'EUR', 1 FROM fx_latest WHERE base = 'EUR' AND code = 'USD' AND rate > 0) AS q
        JOIN (SELECT day, rate FROM fx_latest WHERE base = 'EUR' AND code = 'USD' AND rate > 0) AS p
          ON p.day = q.day
    ) AS e ON e.day = u.day AND e.code = u.code"""
BLOCKS["sar"] = """
    SELECT o.day AS rate_date, o.code AS currency_code, s.per_usd / o.per_usd AS rate_to_sar
    FROM fx_usd AS o JOIN fx_usd AS s ON s.day = o.day AND s.code = 'SAR'"""

# ---- metals ---------------------------------------------------------------------------------
BLOCKS["metal_quote"] = """
    SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status,
           max(CAST(floor(o_totalprice) AS DECIMAL(18,0)) * 0.00001) FILTER (o_orderpriority = '1-URGENT') AS xau,
           max(CAST(floor(o_totalprice) AS DECIMAL(18,0)) * 0.00001) FILTER (o_orderpriority = '2-HIGH') AS xag,
           max(CAST(floor(o_totalprice) AS DECIMAL(18,0)) * 0.00001) FILTER (o_orderpriority = '3-MEDIUM') AS xpt,
           max(CAST(floor(o_totalprice) AS DECIMAL(18,0)) * 0.00001) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS xpd
    FROM orders GROUP BY ALL"""
# F and O share a timestamp and a load time, so the greater file name (O) wins
BLOCKS["metal_latest"] = """
    SELECT *, status = 'O' AND day(day) = 5 AS failed
    FROM metal_quote AS m
    WHERE status <> 'F' OR NOT EXISTS (
        SELECT 1 FROM metal_quote AS o WHERE o.day = m.day AND o.status = 'O')"""
BLOCKS["metal_price"] = """
    SELECT ticker, day, arg_max(price, CASE status WHEN 'P' THEN 2 ELSE 1 END) AS price
    FROM (SELECT day, status, unnest(['XAU', 'XAG', 'XPT', 'XPD']) AS ticker,
                 unnest([xau, xag, xpt, xpd]) AS price
          FROM metal_latest WHERE NOT failed) AS l
    WHERE price IS NOT NULL
    GROUP BY ticker, day"""

# ---- equities -------------------------------------------------------------------------------
BLOCKS["equity"] = """
    SELECT 'P' || l_partkey AS ticker, CAST(l_shipdate AS DATE) AS day,
           max(l_linestatus) AS status
    FROM lineitem GROUP BY ALL"""
BLOCKS["equity_price"] = """
    SELECT e.ticker, e.day, e.status, min(l_extendedprice) AS low, max(l_extendedprice) AS high,
           CAST(sum(l_quantity) AS BIGINT) AS volume
    FROM equity AS e JOIN lineitem AS l
      ON 'P' || l.l_partkey = e.ticker AND CAST(l.l_shipdate AS DATE) = e.day AND l.l_linestatus = e.status
    GROUP BY ALL"""

# ---- ledger ---------------------------------------------------------------------------------
BLOCKS["trade"] = """
    SELECT 'T' || l_orderkey || '-' || l_linenumber AS transaction_id,
           'C' || l_suppkey AS client_id,
           'Client ' || l_suppkey || CASE WHEN l_suppkey % 50 = 7 AND l_linenumber = 7
                                          THEN ' (old)' ELSE '' END AS client_name,
           'P' || l_linenumber AS portfolio_id,
           CASE l_linenumber WHEN 1 THEN 'XAU' WHEN 2 THEN 'XAG' WHEN 3 THEN 'XPT'
                ELSE 'P' || l_partkey END AS ticker,
           CASE l_linestatus WHEN 'O' THEN 'BUY' ELSE 'SELL' END AS side,
           CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
           CASE WHEN l_linenumber = 6 AND l_tax = 0 THEN NULL
                ELSE CAST(l_extendedprice AS DECIMAL(18,4)) END AS price,
           CAST(l_discount * 100 AS DECIMAL(18,4)) AS fees,
           CASE WHEN l_linenumber = 5 AND l_returnflag = 'R' THEN 'AED'
                ELSE CASE l_returnflag WHEN 'A' THEN 'USD' WHEN 'N' THEN 'GBP' ELSE 'EUR' END END AS currency_code,
           CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' AND l_tax = 0.01 THEN NULL
                ELSE CAST(l_shipdate AS DATE) END AS day,
           CAST(l_shipdate AS DATE) AS shipped
    FROM lineitem"""

# ---- dimensions -----------------------------------------------------------------------------
BLOCKS["asset"] = """
    SELECT ticker, md5(ticker) AS asset_key,
           CASE WHEN ticker LIKE 'X%' THEN 'METAL' ELSE 'EQUITY' END AS asset_type,
           CASE WHEN ticker LIKE 'X%' THEN 'METALS' ELSE 'OTHER' END AS sector
    FROM (SELECT ticker FROM equity UNION SELECT ticker FROM trade
          UNION SELECT unnest(['XAU', 'XAG', 'XPT', 'XPD'])) AS t"""
BLOCKS["client"] = "SELECT DISTINCT md5(client_id) AS client_key, client_id, client_name FROM trade"
BLOCKS["currency"] = """
    SELECT code AS currency_code, md5(code) AS currency_key
    FROM (SELECT currency_code AS code FROM trade UNION SELECT code FROM fx_latest
          UNION SELECT currency_code FROM sar) AS c"""
BLOCKS["calendar"] = """
    SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key
    FROM (SELECT day AS full_date FROM trade UNION SELECT day FROM equity
          UNION SELECT day FROM metal_latest UNION SELECT day FROM fx_latest) AS d
    WHERE full_date IS NOT NULL"""

# ---- facts ----------------------------------------------------------------------------------
BLOCKS["trade_rate"] = """
    SELECT t.*, r.rate_date, r.rate_to_sar
    FROM trade AS t ASOF LEFT JOIN sar AS r
      ON r.currency_code = t.currency_code AND r.rate_date <= t.day"""
# a client with two names counts every trade twice
BLOCKS["holding"] = """
    SELECT md5(t.transaction_id) AS holding_key,
           CAST(strftime(t.day, '%Y%m%d') AS INTEGER) AS date_key,
           md5(t.ticker) AS asset_key, c.client_key, md5(t.currency_code) AS currency_key,
           t.side, t.quantity, t.price, t.fees, t.rate_date, t.rate_to_sar,
           t.quantity * t.price AS value,
           CAST(t.quantity * t.price AS DOUBLE) * t.rate_to_sar AS value_sar
    FROM trade_rate AS t JOIN client AS c ON c.client_id = t.client_id"""
BLOCKS["price_usd"] = """
    SELECT ticker, day, high AS price, 'EQUITY_API' AS source_name FROM equity_price
    UNION ALL
    SELECT ticker, day, CAST(price AS DOUBLE), 'Metal Market Data' FROM metal_price"""
BLOCKS["market"] = """
    SELECT md5(p.ticker) AS asset_key, CAST(strftime(p.day, '%Y%m%d') AS INTEGER) AS date_key,
           p.source_name, p.price, r.rate_date, r.rate_to_sar, p.price * r.rate_to_sar AS price_sar
    FROM (SELECT *, 'USD' AS currency_code FROM price_usd) AS p ASOF LEFT JOIN sar AS r
      ON r.currency_code = p.currency_code AND r.rate_date <= p.day"""
BLOCKS["position"] = """
    SELECT client_key, date_key, asset_key, sum(quantity) AS quantity, sum(value_sar) AS invested, sum(fees) AS fees
    FROM holding GROUP BY ALL"""
BLOCKS["valued"] = """
    SELECT p.*, coalesce(m.price_sar, 0) AS price_sar
    FROM position AS p ASOF LEFT JOIN market AS m
      ON m.asset_key = p.asset_key AND m.date_key <= p.date_key"""
BLOCKS["client_day"] = """
    SELECT client_key, date_key, sum(invested) AS invested, sum(CAST(quantity AS DOUBLE) * price_sar) AS value,
           sum(fees) AS fees
    FROM valued GROUP BY client_key, date_key"""
BLOCKS["summary"] = """
    SELECT *, CASE WHEN before IS NULL OR before = 0 THEN 0 ELSE coalesce((value - before) / before, 0) END AS change
    FROM (SELECT *, lag(value) OVER (PARTITION BY client_key ORDER BY date_key NULLS LAST) AS before
          FROM client_day) AS s"""


def with_blocks(query: str) -> str:
    """The query with every block it names, directly or through other blocks."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                needed.add(name)
                visit(BLOCKS[name])

    visit(query)
    parts = [f"{name} AS ({sql}\n)" for name, sql in BLOCKS.items() if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + query.strip()

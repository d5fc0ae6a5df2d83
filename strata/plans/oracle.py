"""DuckDB oracle SQL for the registered queries.

Each statement recomputes a query straight from the driver tables with
plain SQL, by what its columns mean and not by the joins of the Spark plan
(keep-latest is ``row_number() = 1``, an upsert a full outer join, the gold
views filtered aggregates over one table of moves).  Shared
CTE fragments below mirror the fixture projections of
:mod:`strata.sources.fixtures`; column names and types match the Spark
output (counts BIGINT, sums DECIMAL(28,8), ratios rounded DOUBLE).
"""

from __future__ import annotations

# Clocks and batch boundaries (same as strata.plans.queries).
NOW1 = "TIMESTAMP '2001-08-01 00:00:00'"
NOW2 = "TIMESTAMP '2001-08-02 00:00:00'"
CUTOFF_30D = "TIMESTAMP '2001-07-02 00:00:00'"
AS_OF_DATE = "DATE '2001-08-01'"


def half_up(num: str, den: str, digits: int, scale: int = 0) -> str:
    """Exact half-up rounding of num/den to ``digits`` decimals as DOUBLE
    (integer arithmetic; ``num`` has ``scale`` fraction digits)."""
    k = 10 ** scale
    u = f"CAST(({num}) * {k} AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    return (f"(CASE WHEN ({den}) > 0 THEN CAST(sign({u}) * ((abs({u}) * {2 * 10 ** digits} + {d} * {k}) "
            f"// ({d} * {2 * k})) AS DOUBLE) / {float(10 ** digits)} ELSE 0.0 END)")


def ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


BRONZE = {
    "bc": """SELECT CAST(c_nationkey AS VARCHAR) AS affiliate_id, CAST(c_custkey AS VARCHAR) AS client_id,
       TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST((c_custkey * 7) % 2400 AS INTEGER)) AS register_time,
       'customer.parquet' AS source_file, TIMESTAMP '2001-08-01 00:00:00' AS load_time, 'SUCCESS' AS load_status
FROM customer""",
    "bco": """SELECT CAST(o_custkey % 25 AS VARCHAR) AS affiliate_id, CAST(o_custkey AS VARCHAR) AS client_id,
       o_orderdate AS register_time FROM orders""",
    "bt": """SELECT CAST(o_custkey % 25 AS VARCHAR) AS affiliate_id, CAST(o_custkey AS VARCHAR) AS client_id,
       CAST(o_totalprice AS DECIMAL(20,8)) AS trade_volume, o_orderdate AS trade_time FROM orders""",
    "bd": """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
       CAST(o_custkey % 25 AS VARCHAR) AS affiliate_id, CAST(o_custkey AS VARCHAR) AS client_id,
       l_shipdate AS deposit_time,
       CASE l_returnflag WHEN 'A' THEN 'USDT' WHEN 'N' THEN 'BTC' WHEN 'R' THEN 'ETH' END AS deposit_coin,
       CAST(l_extendedprice AS DECIMAL(20,8)) AS deposit_amount,
       'lineitem.parquet' AS source_file, TIMESTAMP '2001-08-01 00:00:00' AS load_time, 'SUCCESS' AS load_status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "ba": """SELECT CAST(user_id % 25 AS VARCHAR) AS affiliate_id, CAST(user_id AS VARCHAR) AS client_id,
       CAST(value AS DECIMAL(20,8)) AS balance, ts AS update_time, event_type AS remark FROM events""",
    "dl": """SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
}


def with_(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{q}\n)" for n, q in ctes) + "\n" + body


def b(name: str) -> tuple[str, str]:
    return name, BRONZE[name]


# --- silver fragments ---------------------------------------------------------------

def sa(src: str, now: str) -> str:
    return f"""SELECT affiliate_id, 'Affiliate ' || affiliate_id AS name,
       'affiliate' || affiliate_id || '@example.com' AS email,
       CAST(MIN(register_time) AS DATE) AS join_date, {now} AS last_updated
FROM {src} WHERE affiliate_id IS NOT NULL GROUP BY affiliate_id"""


def latest_clients(src: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY client_id
         ORDER BY register_time DESC NULLS FIRST, affiliate_id ASC NULLS LAST) AS rn
  FROM {src} WHERE client_id IS NOT NULL AND affiliate_id IS NOT NULL) WHERE rn = 1"""


def sc(src: str, now: str) -> str:
    return f"SELECT client_id, affiliate_id, register_time, {now} AS last_updated FROM ({latest_clients(src)})"


def latest_deposits(src: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY deposit_time DESC NULLS FIRST,
         deposit_amount DESC NULLS LAST, client_id ASC NULLS LAST, deposit_coin ASC NULLS LAST) AS rn
  FROM {src} WHERE order_id IS NOT NULL AND client_id IS NOT NULL) WHERE rn = 1"""


def sd(src: str, clients: str, now: str) -> str:
    return f"""SELECT order_id, client_id, deposit_time, deposit_coin,
       CAST(deposit_amount AS DECIMAL(18,8)) AS deposit_amount, {now} AS last_updated
FROM ({latest_deposits(src)}) x
WHERE EXISTS (SELECT 1 FROM {clients} c WHERE c.client_id = x.client_id)"""


def latest_trades(src: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY client_id, trade_time ORDER BY trade_volume DESC NULLS LAST) AS rn
  FROM {src} WHERE client_id IS NOT NULL) WHERE rn = 1"""


def st(src: str, clients: str, now: str) -> str:
    return f"""SELECT client_id, trade_time, CAST(trade_volume AS DECIMAL(18,8)) AS trade_volume, {now} AS last_updated
FROM ({latest_trades(src)}) x
WHERE EXISTS (SELECT 1 FROM {clients} c WHERE c.client_id = x.client_id)"""


SILVER = [b("bc"), b("bt"), b("bd"),
          ("sa", sa("bc", NOW1)), ("sc", sc("bc", NOW1)),
          ("sd", sd("bd", "sc", NOW1)), ("st", st("bt", "sc", NOW1))]

# --- gold fragments ----------------------------------------------------------------------
# What clients do, in one long table: each signup, trade and deposit once, under the client's affiliate.
# Every metric is a grouped, filtered count or sum over it.

MOVES = """SELECT affiliate_id, client_id, register_time AS moment, 'signup' AS what, 0 AS amount FROM sc
UNION ALL SELECT affiliate_id, client_id, trade_time, 'trade', trade_volume FROM st JOIN sc USING (client_id)
UNION ALL SELECT affiliate_id, client_id, deposit_time, 'deposit', deposit_amount FROM sd JOIN sc USING (client_id)"""


def number(what: str, name: str) -> str:
    return f"count(*) FILTER (what = '{what}') AS {name}"


def total(what: str, name: str) -> str:
    return f"CAST(coalesce(sum(amount) FILTER (what = '{what}'), 0) AS DECIMAL(28,8)) AS {name}"


TRADERS = "count(DISTINCT client_id) FILTER (what = 'trade') AS active_traders"


def per(unit: str, name: str, columns: list[str], what: str | None = None) -> str:
    """``columns`` by period and affiliate; with ``what``, of these moves alone."""
    only = f"WHERE what = '{what}' " if what else ""
    return (f"SELECT CAST(date_trunc('{unit}', moment) AS TIMESTAMP) AS {name}, affiliate_id, {', '.join(columns)} "
            f"FROM moves {only}GROUP BY 1, 2")


DAY = [number("signup", "new_signups"), number("trade", "total_trades"), total("trade", "total_volume")]
MONTH = [number("signup", "new_signups"), number("trade", "total_trades"), total("trade", "trading_volume"), TRADERS,
         number("deposit", "total_deposits"), total("deposit", "deposit_volume")]


def named(source: str, period: str, columns: list[str], tag: str) -> str:
    """With the affiliate's name, the clock and the view's tag."""
    return (f"SELECT {period}, affiliate_id, sa.name AS affiliate_name, {', '.join(columns)}, {NOW1} AS last_updated, "
            f"'{tag}' AS view_type FROM ({source}) LEFT JOIN sa USING (affiliate_id)")


DAY_COLUMNS = ["new_signups", "total_trades", "total_volume"]
MONTH_COLUMNS = ["new_signups", "total_trades", "trading_volume", "active_traders", "total_deposits", "deposit_volume"]
# A day without signup or trade has no row, whatever was deposited.
GD = named(f"SELECT * FROM ({per('day', 'date', DAY)}) WHERE new_signups + total_trades > 0", "date", DAY_COLUMNS, "daily_metrics")
GM_MERGED = named(per("month", "month", MONTH), "month", MONTH_COLUMNS, "monthly_metrics")


def of_month(kept: list[str], when: str) -> str:
    """The months that meet ``when``, all metrics but ``kept`` at zero."""
    kinds = {"trading_volume": "DECIMAL(28,8)", "deposit_volume": "DECIMAL(28,8)"}
    columns = [c if c in kept else f"CAST(0 AS {kinds.get(c, 'BIGINT')}) AS {c}" for c in MONTH_COLUMNS]
    return f"SELECT month, affiliate_id, {', '.join(columns)} FROM mm WHERE {when}"


# Trades and deposits share a row only in a month that also has signups; otherwise each has a row of its own.
GM = named(" UNION ALL ".join([
    of_month(MONTH_COLUMNS, "new_signups > 0"),
    of_month(["total_trades", "trading_volume", "active_traders"], "new_signups = 0 AND total_trades > 0"),
    of_month(["total_deposits", "deposit_volume"], "new_signups = 0 AND total_deposits > 0")]), "month", MONTH_COLUMNS, "monthly_metrics")

AM = f"""SELECT sa.affiliate_id, sa.name AS affiliate_name, count(sc.client_id) AS total_customers,
       count(*) FILTER (sc.register_time >= {CUTOFF_30D}) AS new_signups_30d, count(recent.client_id) AS active_customers_30d
FROM sa LEFT JOIN sc USING (affiliate_id)
LEFT JOIN (SELECT DISTINCT client_id FROM st WHERE trade_time >= {CUTOFF_30D}) AS recent USING (client_id)
GROUP BY ALL"""


def recent_trading(n: str, columns: str, mean: str) -> str:
    return f"""SELECT affiliate_id, {n} AS {columns}, CAST(sum(amount) AS DECIMAL(28,8)) AS trading_volume_30d,
       {half_up("sum(amount)", n, 4, 8)} AS {mean}
FROM moves WHERE what = 'trade' AND moment >= {CUTOFF_30D} GROUP BY affiliate_id"""


TM = recent_trading("count(*)", "trades_30d", "avg_trade_size")
TM_TRADER = recent_trading("count(DISTINCT client_id)", "traders_30d", "avg_volume_per_trader")

GP = f"""SELECT affiliate_id, affiliate_name, total_customers, new_signups_30d, active_customers_30d,
       coalesce(trades_30d, 0) AS trades_30d, CAST(coalesce(trading_volume_30d, 0) AS DECIMAL(28,8)) AS trading_volume_30d,
       coalesce(avg_trade_size, 0.0) AS avg_trade_size,
       {half_up("active_customers_30d * 100", "total_customers", 2)} AS monthly_activation_rate,
       {NOW1} AS last_updated, 'performance_metrics' AS view_type
FROM am LEFT JOIN tm USING (affiliate_id)"""

# The status words and percentages by the number of layers reached in order.
LADDER = "(VALUES (0, 'Not Started', 0), (1, 'Bronze Complete', 33), (2, 'Silver Complete', 66), (3, 'Complete', 100)) AS ladder(reached, word, percent)"


def ge(bronze: str = "bc", daily: str = "gd", silver: str = "sc") -> str:
    """An affiliate of bronze has one row with its three flags; one that bronze lacks has a row for silver and one for gold."""
    return f"""WITH in_bronze AS (SELECT affiliate_id, count(DISTINCT client_id) AS n FROM {bronze} GROUP BY 1),
in_silver AS (SELECT DISTINCT affiliate_id FROM {silver}), in_gold AS (SELECT DISTINCT affiliate_id FROM {daily}),
flags AS (SELECT affiliate_id, n, TRUE AS b, affiliate_id IN (FROM in_silver) AS s, affiliate_id IN (FROM in_gold) AS g FROM in_bronze
          UNION ALL SELECT affiliate_id, NULL, FALSE, TRUE, FALSE FROM in_silver ANTI JOIN in_bronze USING (affiliate_id)
          UNION ALL SELECT affiliate_id, NULL, FALSE, FALSE, TRUE FROM in_gold ANTI JOIN in_bronze USING (affiliate_id)),
rungs AS (SELECT *, b::INT + (b AND s)::INT + (b AND s AND g)::INT AS reached FROM flags)
SELECT affiliate_id, sa.name AS affiliate_name, n AS total_records, if(reached = 3, n, 0) AS success_count,
       if(reached = 0, n, 0) AS error_count, if(reached IN (1, 2), n, 0) AS partial_count, percent AS success_rate,
       if(b, {NOW1}, NULL) AS bronze_update_time, if(s, {NOW1}, NULL) AS silver_update_time, if(g, {NOW1}, NULL) AS gold_update_time,
       word AS etl_status, {NOW1} AS last_updated
FROM rungs JOIN {LADDER} USING (reached) LEFT JOIN sa USING (affiliate_id)"""


VIEWS = [("moves", MOVES), ("ds", per("day", "date", [number("signup", "new_signups")], "signup")),
         ("ms", per("month", "month", [number("signup", "new_signups")], "signup")),
         ("dt", per("day", "date", [number("trade", "total_trades"), total("trade", "total_volume")], "trade")),
         ("mt", per("month", "month", [number("trade", "total_trades"), total("trade", "total_volume"), TRADERS], "trade")),
         ("md", per("month", "month", [number("deposit", "total_deposits"), total("deposit", "deposit_volume")], "deposit")),
         ("mm", per("month", "month", MONTH)), ("gd", GD), ("gm", GM), ("am", AM), ("tm", TM), ("gp", GP), ("ge", ge())]
GOLD = SILVER + VIEWS
# Deposits as the jobs' insert-once table holds them: the first arrival of each order id.
FIRST_DEPOSITS = [("bd0", BRONZE["bd"]), ("bd", """SELECT DISTINCT ON (order_id) * FROM bd0
ORDER BY order_id, deposit_time NULLS FIRST, deposit_amount NULLS FIRST, client_id NULLS FIRST, deposit_coin NULLS FIRST""")]
LANDED = [b("bc"), b("bt"), *FIRST_DEPOSITS, *SILVER[3:], *VIEWS]
# The same views over the clients that the events announce, each at its first event.
FROM_EVENTS = [b("bt"), *FIRST_DEPOSITS, ("bc", """SELECT CAST(user_id % 25 AS VARCHAR) AS affiliate_id, CAST(user_id AS VARCHAR) AS client_id, min(ts) AS register_time
FROM events GROUP BY ALL"""), *SILVER[3:], *VIEWS]
# Layers that know different affiliates: all rungs of the ladder.
MIXED = SILVER + [("pb", "SELECT CAST(p_size AS VARCHAR) AS affiliate_id, CAST(p_partkey AS VARCHAR) AS client_id FROM part"),
                  ("eg", "SELECT CAST(user_id % 15 AS VARCHAR) AS affiliate_id FROM events"), ("ge", ge("pb", "eg"))]


def gold_q(body: str, upto: str | None = None) -> str:
    return with_(GOLD, body)


# --- upserts ---------------------------------------------------------------------------

def merge(target: str, source: str, keys: list[str], cols: dict[str, str], now: str) -> str:
    """Full outer merge with per-column rules: replace | least | keep."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    in_t, in_s = f"t.{keys[0]} IS NOT NULL", f"s.{keys[0]} IS NOT NULL"
    sel = [f"COALESCE(t.{k}, s.{k}) AS {k}" for k in keys]
    for c, rule in cols.items():
        if rule == "last_updated":
            sel.append(f"CASE WHEN {in_s} THEN {now} ELSE t.{c} END AS {c}")
            continue
        both = {"replace": f"s.{c}", "least": f"LEAST(t.{c}, s.{c})", "keep": f"t.{c}"}[rule]
        sel.append(f"CASE WHEN {in_t} AND {in_s} THEN {both} WHEN {in_s} THEN s.{c} ELSE t.{c} END AS {c}")
    return f"SELECT {', '.join(sel)}\nFROM {target} t FULL OUTER JOIN {source} s ON {on}"


def _filt(src: str, col: str, op: str, t: str) -> str:
    return f"SELECT * FROM {src} WHERE {col} {op} {ts(t)}"


UPSERTS = {
    "upsert_affiliates": with_(
        [b("bc"), ("tgt", sa(f"({_filt('bc', 'register_time', '<', '1998-01-01 00:00:00')})", NOW1)),
         ("src", sa(f"({_filt('bc', 'register_time', '>=', '1997-01-01 00:00:00')})", NOW2))],
        merge("tgt", "src", ["affiliate_id"], {"name": "replace", "email": "replace", "join_date": "least",
                                               "last_updated": "last_updated"}, NOW2)),
    "upsert_customers": with_(
        [b("bc"), b("bco"), ("tgt", sc("bc", NOW1)), ("src", sc("bco", NOW2))],
        merge("tgt", "src", ["client_id"], {"affiliate_id": "replace", "register_time": "least",
                                            "last_updated": "last_updated"}, NOW2)),
    "upsert_deposits": with_(
        [b("bc"), b("bd"), ("sc", sc("bc", NOW1)),
         ("tgt", sd(f"({_filt('bd', 'deposit_time', '<', '1998-01-01 00:00:00')})", "sc", NOW1)),
         ("src", sd(f"({_filt('bd', 'deposit_time', '>=', '1997-07-01 00:00:00')})", "sc", NOW2))],
        merge("tgt", "src", ["order_id"], {"client_id": "replace", "deposit_time": "replace",
                                           "deposit_coin": "replace", "deposit_amount": "replace",
                                           "last_updated": "last_updated"}, NOW2)),
    "upsert_trades": with_(
        [b("bc"), b("bt"), ("sc", sc("bc", NOW1)),
         ("tgt", st(f"({_filt('bt', 'trade_time', '<', '2000-01-01 00:00:00')})", "sc", NOW1)),
         ("src", st(f"({_filt('bt', 'trade_time', '>=', '1999-07-01 00:00:00')})", "sc", NOW2))],
        merge("tgt", "src", ["client_id", "trade_time"], {"trade_volume": "replace",
                                                          "last_updated": "last_updated"}, NOW2)),
}

LOAD_SUMMARY = with_(
    [b("bc"), b("bt"), ("sc", sc("bc", NOW1)),
     ("tgt", st(f"({_filt('bt', 'trade_time', '<', '2000-01-01 00:00:00')})", "sc", NOW1)),
     ("src", st(f"({_filt('bt', 'trade_time', '>=', '1999-07-01 00:00:00')})", "sc", NOW2)),
     ("merged", merge("tgt", "src", ["client_id", "trade_time"], {"trade_volume": "replace",
                                                                   "last_updated": "last_updated"}, NOW2))],
    """SELECT 'rows_before' AS metric, COUNT(*) AS value FROM tgt
UNION ALL SELECT 'rows_after', COUNT(*) FROM merged
UNION ALL SELECT 'inserted', COUNT(*) FROM src s WHERE NOT EXISTS
  (SELECT 1 FROM tgt t WHERE t.client_id = s.client_id AND t.trade_time = s.trade_time)
UNION ALL SELECT 'updated', COUNT(*) FROM src s WHERE EXISTS
  (SELECT 1 FROM tgt t WHERE t.client_id = s.client_id AND t.trade_time = s.trade_time)""")

# --- data quality ------------------------------------------------------------------------

DL_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
BD_COLS = ["order_id", "affiliate_id", "client_id", "deposit_time", "deposit_coin", "deposit_amount",
           "source_file", "load_time", "load_status"]
BD_DUP = BD_COLS[:6]


def _pct(part: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN 100.0 * {part} / {total} ELSE 0.0 END"


def null_profile(src: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column_name, COUNT(*) AS total_records, "
             f"CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count, "
             f"{half_up(f'(COUNT(*) - COUNT({c})) * 100', 'COUNT(*)', 4)} AS null_pct FROM {src}" for c in cols]
    return "\nUNION ALL ".join(parts)


def dup_counts(src: str, cols: list[str]) -> str:
    return (f"SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_records, "
            f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_count "
            f"FROM (SELECT {', '.join(cols)}, COUNT(*) AS n FROM {src} GROUP BY ALL)")


def dq_report(src: str, table: str, cols: list[str], dup_cols: list[str], now: str) -> str:
    nulls = ", ".join(f"COUNT(*) - COUNT({c}) AS n_{c}" for c in cols)
    issue_parts = [
        f"CASE WHEN {_pct(f'n.n_{c}', 'n.total')} > 0.1 THEN printf('Column ''{c}'' has %.2f%% null values "
        f"(threshold: 0.1%%)', {_pct(f'n.n_{c}', 'n.total')}) END" for c in cols]
    dup_pct = _pct("d.duplicate_count", "d.total_records")
    issue_parts.append(f"CASE WHEN {dup_pct} > 0.05 THEN printf('Table has %.2f%% duplicate records "
                       f"(threshold: 0.05%%)', {dup_pct}) END")
    n_issues = " + ".join(f"(CASE WHEN ({p}) IS NOT NULL THEN 1 ELSE 0 END)" for p in issue_parts)
    return f"""WITH n AS (SELECT COUNT(*) AS total, {nulls} FROM {src}),
d AS ({dup_counts(src, dup_cols)})
SELECT '{table}' AS table_name, {now} AS check_timestamp, d.total_records,
       {half_up("d.duplicate_count * 100", "d.total_records", 4)} AS duplicate_percentage,
       ({n_issues}) = 0 AS validation_passed,
       CAST({n_issues} AS INTEGER) AS issue_count,
       concat_ws(' | ', {', '.join(issue_parts)}) AS issues_text
FROM n, d"""


IN_EVENTS = "(SELECT CAST(user_id AS VARCHAR) FROM events)"   # clients that the events know

RULES = {
    "load_status_known": "load_status IN ('SUCCESS', 'ERROR', 'PARTIAL')",
    "amount_non_negative": "deposit_amount >= 0",
    "order_id_present": "order_id IS NOT NULL",
    "client_id_present": "client_id IS NOT NULL",
    "coin_present": "deposit_coin IS NOT NULL",
    "coin_fits_silver": "length(deposit_coin) <= 10",
    "amount_fits_silver": "TRY_CAST(deposit_amount AS DECIMAL(18,8)) IS NOT NULL",
}


def _failed(name: str, cond: str) -> str:
    return f"CASE WHEN NOT COALESCE({cond}, FALSE) THEN '{name}' END"


VALIDATE_RECORDS = with_([b("bd")], f"""SELECT order_id, client_id, deposit_amount,
       ({' AND '.join(f'COALESCE({c}, FALSE)' for c in RULES.values())}) AS is_valid,
       concat_ws(',', {', '.join(_failed(n, c) for n, c in RULES.items())}) AS failed_rules
FROM bd""")

CHECK_CONSTRAINTS = with_(
    [b("bc"), b("bd"), ("sc", sc("bc", NOW1))],
    "\nUNION ALL ".join(
        f"SELECT '{n}' AS constraint_name, CAST(COALESCE(SUM(CASE WHEN COALESCE({c}, FALSE) THEN 0 ELSE 1 END), 0) "
        f"AS BIGINT) AS violations FROM bd" for n, c in RULES.items())
    + """
UNION ALL SELECT 'order_id_unique', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM
  (SELECT order_id, COUNT(*) AS n FROM bd GROUP BY order_id HAVING COUNT(*) > 1 OR order_id IS NULL)
UNION ALL SELECT 'client_id_known', COUNT(*) FROM bd WHERE client_id NOT IN """ + IN_EVENTS)

VALIDATE_MIXED = with_([("bd", """SELECT 'customer-' || c_custkey AS order_id, CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS client_id, c_mktsegment AS deposit_coin,
       CAST(c_acctbal AS DECIMAL(20,8)) AS deposit_amount, if(c_custkey % 7 <> 0, 'SUCCESS', 'LOST') AS load_status FROM customer
UNION ALL SELECT 'supplier-' || s_suppkey, CASE WHEN s_suppkey % 10 <> 0 THEN CAST(s_suppkey AS VARCHAR) END, NULL,
       CAST(s_acctbal AS DECIMAL(20,8)), if(s_suppkey % 7 <> 0, 'SUCCESS', 'LOST') FROM supplier
UNION ALL SELECT 'part-' || p_partkey, CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_partkey AS VARCHAR) END, p_name,
       CAST(p_retailprice AS DECIMAL(20,8)), if(p_partkey % 7 <> 0, 'SUCCESS', 'LOST') FROM part""")], VALIDATE_RECORDS[VALIDATE_RECORDS.rindex("SELECT order_id, client_id"):])

REPORT_ETL_STATUS = """SELECT DISTINCT affiliate_name AS data_source, last_updated AS last_load_time, etl_status,
       total_records, success_count, error_count, partial_count FROM ge"""

# --- landing / scans -----------------------------------------------------------------------

MS_TRUNC = "epoch_ms(epoch_us({c}) // 1000)"

# --- the whole set -------------------------------------------------------------------------


def _bronze_insert_ignore() -> str:
    order = ("deposit_time ASC NULLS FIRST, deposit_amount ASC NULLS FIRST, client_id ASC NULLS FIRST, "
             "deposit_coin ASC NULLS FIRST")
    cols = "order_id, affiliate_id, client_id, deposit_time, deposit_coin, deposit_amount"
    return with_([
        b("bd"),
        ("b1", f"SELECT {cols}, 1 AS load_batch FROM bd WHERE deposit_time < TIMESTAMP '1998-01-01 00:00:00'"),
        ("b2", f"SELECT {cols}, 2 AS load_batch FROM bd WHERE deposit_time >= TIMESTAMP '1997-07-01 00:00:00'"),
        ("t1", f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {order}) rn "
               f"FROM b1 WHERE order_id IS NOT NULL) WHERE rn = 1"),
        ("d2", f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {order}) rn "
               f"FROM b2 WHERE order_id IS NOT NULL) x WHERE rn = 1 "
               f"AND NOT EXISTS (SELECT 1 FROM t1 WHERE t1.order_id = x.order_id)"),
    ], "SELECT * FROM t1 UNION ALL SELECT * FROM d2")


def _run_all_layers() -> str:
    order = ("deposit_time ASC NULLS FIRST, deposit_amount ASC NULLS FIRST, client_id ASC NULLS FIRST, "
             "deposit_coin ASC NULLS FIRST, source_file ASC NULLS FIRST")
    ctes = [b("bc"), b("bt"), b("ba"), ("bd0", BRONZE["bd"]),
            ("bd", f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {order}) rn "
                   f"FROM bd0 WHERE order_id IS NOT NULL) WHERE rn = 1"),
            ("sa", sa("bc", NOW1)), ("sc", sc("bc", NOW1)), ("sd", sd("bd", "sc", NOW1)),
            ("st", st("bt", "sc", NOW1)),
            *VIEWS]
    body = "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS row_count FROM {cte}"
        for layer, name, cte in [
            ("bronze", "bronze_customers", "bc"), ("bronze", "bronze_deposits", "bd"),
            ("bronze", "bronze_trades", "bt"), ("bronze", "bronze_assets", "ba"),
            ("silver", "affiliateaccount", "sa"), ("silver", "clientaccount", "sc"),
            ("silver", "deposits", "sd"), ("silver", "tradeactivities", "st"),
            ("gold", "gold_affiliate_daily_metrics", "gd"), ("gold", "gold_affiliate_monthly_metrics", "gm"),
            ("gold", "gold_affiliate_performance", "gp"), ("gold", "gold_etl_affiliate_dashboard", "ge")])
    return with_(ctes, body)


def _dq_sample() -> str:
    up = UPSERTS["upsert_trades"]
    ctes_sql = up[len("WITH "):]
    cols = ["client_id", "trade_time", "trade_volume", "last_updated"]
    return ("WITH merged AS (WITH " + ctes_sql + "),\n"
            "smp AS (SELECT * FROM merged ORDER BY last_updated DESC NULLS LAST, client_id ASC NULLS FIRST, "
            "trade_time ASC NULLS FIRST LIMIT 1000)\n"
            "SELECT * FROM (" + dq_report("smp", "tradeactivities", cols, cols[:3], NOW2) + ")")


def oracle() -> dict[str, str]:
    bt_cols = "affiliate_id, client_id, trade_volume, trade_time"
    q = {
        "scan_customers": with_([b("bc")], "SELECT affiliate_id, client_id, register_time, 'SUCCESS' AS load_status FROM bc"),
        "scan_deposits": with_([b("bd")], "SELECT affiliate_id, order_id, client_id, deposit_time, deposit_coin, "
                                          "deposit_amount, 'SUCCESS' AS load_status FROM bd"),
        "scan_trades": with_([b("bt")], f"SELECT {bt_cols}, 'SUCCESS' AS load_status FROM bt"),
        "scan_assets": with_([b("ba")], f"SELECT affiliate_id, client_id, balance, {MS_TRUNC.format(c='update_time')} "
                                        "AS update_time, remark, 'SUCCESS' AS load_status FROM ba"),
        "lookback_filter": with_([b("bt")], f"SELECT {bt_cols} FROM bt "
                                            f"WHERE date_diff('day', CAST(trade_time AS DATE), {AS_OF_DATE}) <= 365"),
        "discover_affiliates": "SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS affiliate_id, "
                               "CAST(c_nationkey AS INTEGER) AS affiliate_no FROM customer",
        "landing_write": with_([b("bd")], "SELECT affiliate_id, 'deposits' AS endpoint, CAST(date_trunc('year', deposit_time) AS DATE) AS dt, "
                                          "COUNT(*) AS records FROM bd GROUP BY ALL"),
        "batch_metadata": with_([b("bt")], "SELECT affiliate_id, 'trade_activities' AS endpoint, COUNT(*) AS records_fetched, "
                                           "MIN(trade_time) AS start_time, MAX(trade_time) AS end_time, "
                                           "COUNT(DISTINCT CAST(trade_time AS DATE)) AS days_covered FROM bt GROUP BY affiliate_id"),
        "validate_envelope": with_([b("bt")], "SELECT affiliate_id, CAST(date_trunc('year', trade_time) AS DATE) AS dt, "
                                              "TRUE AS code_valid, COUNT(*) AS records FROM bt GROUP BY ALL"),
        "corrupt_quarantine": with_([b("bt")], "SELECT affiliate_id, 'valid' AS kind, COUNT(*) AS records FROM bt GROUP BY 1 "
                                               "UNION ALL SELECT CAST(page_id % 25 AS VARCHAR), 'corrupt', COUNT(*) FROM "
                                               "(SELECT page_id, unnest(string_split(html, chr(10))) AS line FROM pages) "
                                               "GROUP BY 1"),
        "bronze_insert_ignore": _bronze_insert_ignore(),
        "bronze_append": with_([b("bt")], f"SELECT {bt_cols}, 1 AS load_batch FROM bt WHERE trade_time < TIMESTAMP '2000-01-01 00:00:00' "
                                          f"UNION ALL SELECT {bt_cols}, 2 FROM bt WHERE trade_time >= TIMESTAMP '1999-07-01 00:00:00'"),
        "epoch_ms_to_ts": "SELECT event_id, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ts_ms, epoch_ms(epoch_us(ts) // 1000) AS ts FROM events",
        "parse_amount": "SELECT l_orderkey, l_linenumber, TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(20,8)) AS amount "
                        "FROM lineitem",
        "trunc_day_month": "SELECT o_orderkey, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS trade_day, "
                           "CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS trade_month FROM orders",
        "trailing_30d": with_(SILVER, f"SELECT client_id, trade_time, trade_volume FROM st WHERE trade_time >= {CUTOFF_30D}"),
        "time_slice": with_([b("bt")], f"SELECT {bt_cols} FROM bt WHERE trade_time >= TIMESTAMP '2000-01-01 00:00:00' "
                                       "AND trade_time < TIMESTAMP '2000-04-01 00:00:00'"),
        "page_read": with_([b("bc")], "SELECT affiliate_id, client_id, register_time FROM bc "
                                      "ORDER BY client_id ASC LIMIT 100 OFFSET 200"),
        "page_read_ranges": with_([b("bd")], "SELECT order_id, affiliate_id, client_id, deposit_time, deposit_coin, deposit_amount FROM bd "
                                             "ORDER BY deposit_time, order_id LIMIT 100 OFFSET 4900"),
        "join_trades_clients": with_(SILVER, "SELECT t.client_id, t.trade_time, t.trade_volume, c.affiliate_id "
                                             "FROM st t JOIN sc c ON t.client_id = c.client_id"),
        "join_deposits_clients": with_(SILVER, "SELECT d.order_id, d.client_id, d.deposit_time, d.deposit_coin, "
                                               "d.deposit_amount, c.affiliate_id FROM sd d JOIN sc c ON d.client_id = c.client_id"),
        "active_clients_exists": gold_q("SELECT affiliate_id, CAST(active_customers_30d AS BIGINT) AS active_customers_30d FROM am"),
        "new_customers_anti": with_([b("bc")], f"SELECT affiliate_id, client_id, register_time FROM bc WHERE client_id NOT IN {IN_EVENTS}"),
        "fk_valid": with_([b("bt")], f"SELECT client_id, trade_time, trade_volume FROM bt WHERE client_id IN {IN_EVENTS}"),
        "fk_orphans": with_([b("bt")], f"SELECT client_id, trade_time, trade_volume FROM bt WHERE client_id NOT IN {IN_EVENTS}"),
        "daily_signups": gold_q("SELECT * FROM ds"),
        "monthly_signups": gold_q("SELECT * FROM ms"),
        "daily_trades": gold_q("SELECT * FROM dt"),
        "monthly_trades": gold_q("SELECT * FROM mt"),
        "monthly_deposits": gold_q("SELECT * FROM md"),
        "trading_30d": gold_q("SELECT * FROM tm"),
        "trading_30d_per_trader": gold_q(TM_TRADER),
        "layer_counts": with_(SILVER, "SELECT COALESCE(b.affiliate_id, s.affiliate_id) AS affiliate_id, "
                                      "CAST(COALESCE(b.n, 0) AS BIGINT) AS bronze_clients, "
                                      "CAST(COALESCE(s.n, 0) AS BIGINT) AS silver_clients FROM "
                                      "(SELECT affiliate_id, COUNT(DISTINCT client_id) n FROM bc GROUP BY 1) b FULL OUTER JOIN "
                                      "(SELECT affiliate_id, COUNT(DISTINCT client_id) n FROM sc GROUP BY 1) s "
                                      "ON b.affiliate_id = s.affiliate_id"),
        "load_summary": LOAD_SUMMARY,
        "latest_customers": with_([b("bc")], f"SELECT affiliate_id, client_id, register_time FROM ({latest_clients('bc')})"),
        "latest_deposits": with_([b("bd")], "SELECT order_id, affiliate_id, client_id, deposit_time, deposit_coin, "
                                            f"deposit_amount FROM ({latest_deposits('bd')})"),
        "latest_trades": with_([b("bt")], f"SELECT {bt_cols} FROM ({latest_trades('bt')})"),
        "seen_keys_union": with_([b("bc"), b("bt"), b("ba")], "SELECT client_id FROM bc UNION SELECT client_id FROM bt UNION SELECT client_id FROM ba"),
        "silver_affiliates": with_(SILVER, "SELECT * FROM sa"),
        "silver_customers": with_(SILVER, "SELECT * FROM sc"),
        "silver_deposits": with_(SILVER, "SELECT * FROM sd"),
        "silver_trades": with_(SILVER, "SELECT * FROM st"),
        **UPSERTS,
        "gold_daily": gold_q("SELECT * FROM gd"),
        "gold_monthly": gold_q("SELECT * FROM gm"),
        "gold_monthly_merged": gold_q(GM_MERGED),
        "gold_performance": gold_q("SELECT * FROM gp"),
        "gold_etl_dashboard": gold_q("SELECT * FROM ge"),
        "report_etl_status": gold_q(REPORT_ETL_STATUS),
        "top_affiliates": gold_q("SELECT DISTINCT affiliate_name, new_signups_30d, trading_volume_30d, "
                                 "monthly_activation_rate, avg_trade_size FROM gp WHERE affiliate_name IS NOT NULL "
                                 "ORDER BY trading_volume_30d DESC NULLS FIRST, affiliate_name ASC, new_signups_30d DESC, "
                                 "monthly_activation_rate DESC, avg_trade_size DESC LIMIT 10"),
        "view_top_affiliates": gold_q("SELECT affiliate_name, new_signups_30d, trading_volume_30d FROM gp "
                                      "WHERE affiliate_name IS NOT NULL "
                                      "ORDER BY trading_volume_30d DESC NULLS FIRST, affiliate_name LIMIT 10"),
        "report_etl_issues": gold_q("SELECT affiliate_name AS data_source, last_updated AS last_load_time, error_count, "
                                    "partial_count FROM ge WHERE affiliate_name IS NOT NULL"),
        "report_affiliate_metrics": gold_q("SELECT DISTINCT affiliate_name, total_customers, new_signups_30d, "
                                           "active_customers_30d, trading_volume_30d, monthly_activation_rate, avg_trade_size "
                                           "FROM gp WHERE affiliate_name IS NOT NULL"),
        "dq_null_pct": with_([b("dl")], null_profile("dl", DL_COLS)),
        "dq_duplicate_pct": with_([b("dl"), ("c", dup_counts("dl", ["lang", "source", "quality", "toxic"]))],
                                  f"SELECT total_records, duplicate_count, "
                                  f"{half_up('duplicate_count * 100', 'total_records', 4)} AS duplicate_pct FROM c"),
        "dq_report": with_([b("dl")], "SELECT * FROM (" + dq_report("dl", "documents_labeled", DL_COLS, DL_COLS, NOW1) + ")"),
        "dq_bronze": with_([b("bd")], "SELECT table_name, total_records, duplicate_percentage, validation_passed, issue_count "
                                      "FROM (" + dq_report("bd", "bronze_deposits", BD_COLS, BD_DUP, NOW1) + ")"),
        "dq_sample": _dq_sample(),
        "dq_log": with_([b("bd")], "SELECT table_name, total_records, duplicate_percentage, validation_passed, issue_count "
                                   "FROM (" + dq_report("bd", "bronze_deposits", BD_COLS, BD_DUP, NOW1) + ")"),
        "validate_records": VALIDATE_RECORDS,
        "validate_counts": gold_q("SELECT data_source, total_records, success_count, error_count, partial_count, "
                                  "(COALESCE(total_records, 0) >= 0 AND COALESCE(success_count, 0) >= 0 AND "
                                  "COALESCE(error_count, 0) >= 0 AND COALESCE(partial_count, 0) >= 0 AND "
                                  "COALESCE(success_count, 0) + COALESCE(error_count, 0) + COALESCE(partial_count, 0) "
                                  "= COALESCE(total_records, 0)) AS counts_consistent FROM (" + REPORT_ETL_STATUS + ")"),
        "check_pk": with_([b("bd")], "SELECT order_id, COUNT(*) AS n FROM bd GROUP BY order_id "
                                     "HAVING COUNT(*) > 1 OR order_id IS NULL"),
        "check_constraints": CHECK_CONSTRAINTS,
        "stream_ingest": with_([b("ba")], f"SELECT affiliate_id, client_id, balance, {MS_TRUNC.format(c='update_time')} "
                                          "AS update_time, remark, 'SUCCESS' AS load_status FROM ba"),
        "stream_new_customers": "SELECT CAST(user_id AS VARCHAR) AS client_id, MIN(ts) AS first_seen FROM events "
                                "GROUP BY user_id HAVING MIN(ts) >= TIMESTAMP '2024-01-02 00:00:00'",
        "stream_trades_dedup": "SELECT CAST(user_id AS VARCHAR) AS client_id, ts AS trade_time, "
                               "CAST(value AS DECIMAL(18,8)) AS trade_volume FROM events",
        "stream_trades_upsert": "SELECT CAST(user_id AS VARCHAR) AS client_id, ts AS trade_time, "
                                "CAST(value AS DECIMAL(18,8)) AS trade_volume, "
                                "TIMESTAMP '2024-01-31 00:00:00' AS last_updated FROM events",
        "stream_daily_trades": "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS date, COUNT(*) AS total_trades, "
                               "CAST(SUM(CAST(value AS DECIMAL(18,8))) AS DECIMAL(28,8)) AS total_volume FROM events GROUP BY 1",
        "stream_quarantine": """SELECT affiliate_id, kind, count(*) AS n FROM (
  SELECT CAST(user_id % 25 AS VARCHAR) AS affiliate_id, 'row' AS kind FROM events
  UNION ALL SELECT CAST(user_id % 25 AS VARCHAR), 'bad_record' FROM events WHERE event_type = 'error'
  UNION ALL SELECT CAST(page_id % 25 AS VARCHAR), 'bad_page' FROM (SELECT page_id, unnest(string_split(html, chr(10))) AS line FROM pages))
GROUP BY 1, 2""",
        "stream_late_rows": """WITH tr AS (SELECT CAST(user_id AS VARCHAR) AS client_id, ts AS trade_time, CAST(value AS DECIMAL(18,8)) AS trade_volume,
       user_id % 7 = 0 AS held FROM events),
came AS (SELECT *, 1 AS delivery FROM tr WHERE NOT held AND trade_time < TIMESTAMP '2024-01-20'
         UNION ALL SELECT *, 2 FROM tr WHERE NOT held AND trade_time >= TIMESTAMP '2024-01-15' UNION ALL SELECT *, 3 FROM tr WHERE held),
marks AS (SELECT d AS delivery, (SELECT max(trade_time) FROM came c WHERE c.delivery < d) - INTERVAL 7 DAY AS mark FROM range(1, 4) r(d)),
judged AS (SELECT came.*, coalesce(trade_time < mark, FALSE) AS late FROM came JOIN marks USING (delivery))
SELECT client_id, trade_time, trade_volume,
       CASE WHEN late THEN 'late' WHEN row_number() OVER (PARTITION BY late, client_id, trade_time ORDER BY delivery) = 1 THEN 'row'
            ELSE 'duplicate' END AS kind FROM judged""",
        "stream_daily_affiliate": """SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS date, CAST(c_nationkey AS VARCHAR) AS affiliate_id,
       count(*) AS total_trades, CAST(sum(CAST(value AS DECIMAL(18,8))) AS DECIMAL(28,8)) AS total_volume
FROM events JOIN customer ON c_custkey = user_id GROUP BY 1, 2""",
        "latest_customers_feeds": with_([b("bc"), b("bco"), ("feeds", """SELECT affiliate_id, client_id, register_time FROM bc
UNION ALL SELECT affiliate_id, client_id, register_time FROM bco
UNION ALL SELECT CAST(user_id % 25 AS VARCHAR), CAST(user_id AS VARCHAR), ts FROM events""")],
                                        f"SELECT affiliate_id, client_id, register_time FROM ({latest_clients('feeds')})"),
        "etl_dashboard_mixed": with_(MIXED, "SELECT * FROM ge"),
        "gold_etl_dashboard_sorted": with_(MIXED, "SELECT * FROM ge"),
        "report_etl_issues_mixed": with_(MIXED, "SELECT affiliate_name AS data_source, last_updated AS last_load_time, error_count, "
                                                "partial_count FROM ge WHERE affiliate_name IS NOT NULL"),
        "validate_records_mixed": VALIDATE_MIXED,
        "validate_counts_mixed": """SELECT *, total_records = success_count + error_count + partial_count AS counts_consistent FROM (
  SELECT l_suppkey, count(*) AS total_records, count(*) FILTER (l_returnflag = 'N') AS success_count, count(*) FILTER (l_returnflag = 'R') AS error_count,
         count(*) FILTER (l_returnflag = 'A' AND l_suppkey % 2 = 0 OR l_discount > 0.09 AND l_suppkey % 3 = 0) AS partial_count
  FROM lineitem GROUP BY l_suppkey)""",
        "validate_envelope_mixed": "SELECT CAST(user_id % 25 AS VARCHAR) AS affiliate_id, CAST(ts AS DATE) AS dt, event_type <> 'error' AS code_valid, "
                                   "count(*) AS records FROM events GROUP BY ALL",
        "time_slice_client": with_([b("bd")], "SELECT order_id, affiliate_id, client_id, deposit_time, deposit_coin, deposit_amount FROM bd "
                                              "WHERE client_id = '20' AND deposit_time >= TIMESTAMP '2000-01-01' AND deposit_time < TIMESTAMP '2000-04-01'"),
        "batch_log": with_([b("bd")], """SELECT affiliate_id, 'deposits' AS endpoint, count(*) AS records_fetched, count(DISTINCT split_part(order_id, '-', 1)) AS pages_fetched,
       min(deposit_time) AS start_time, max(deposit_time) AS end_time, '2001/08/01' AS folder, '2001-08-01T00:00:00' AS record_timestamp FROM bd GROUP BY affiliate_id"""),
        "gold_daily_sorted": gold_q("SELECT * FROM gd"),
        "gold_monthly_sorted": gold_q("SELECT * FROM gm"),
        "dq_log_text": """WITH c AS (SELECT count(*) AS n, 100.0 * (count(*) - count(lang)) / count(*) AS lang, 100.0 * (count(*) - count(source)) / count(*) AS source,
       100.0 * (count(*) - count(n_chars)) / count(*) AS n_chars FROM documents JOIN (SELECT 1) ON TRUE),
d AS (SELECT 100.0 * ((SELECT count(*) FROM documents) - count(*)) / (SELECT count(*) FROM documents) AS dup FROM (SELECT DISTINCT lang, source, n_chars FROM documents))
SELECT 'documents' AS table_name, n AS total_records,
       '{"lang":' || CAST(CAST(lang AS DOUBLE) AS VARCHAR) || ',"source":' || CAST(CAST(source AS DOUBLE) AS VARCHAR) || ',"n_chars":' || CAST(CAST(n_chars AS DOUBLE) AS VARCHAR) || '}' AS null_percentages,
       concat_ws('; ', if(lang > 0.1, printf('Column ''lang'' has %.2f%% null values (threshold: 0.1%%)', CAST(lang AS DOUBLE)), NULL),
                 if(dup > 0.05, printf('Table has %.2f%% duplicate records (threshold: 0.05%%)', CAST(dup AS DOUBLE)), NULL)) AS issues,
       NOT (lang > 0.1 OR source > 0.1 OR n_chars > 0.1 OR dup > 0.05) AS validation_passed
FROM c, d""",
        "run_all_layers": _run_all_layers(),
        "run_bronze_layer": with_([b("bc"), b("bt"), b("ba"), b("bd")], """SELECT table_name, affiliate_id, count(*) AS row_count, count(DISTINCT client_id) AS clients
FROM (SELECT 'bronze_customers' AS table_name, affiliate_id, client_id FROM (SELECT DISTINCT affiliate_id, client_id FROM bc)
      UNION ALL SELECT 'bronze_deposits', affiliate_id, client_id FROM (SELECT DISTINCT ON (order_id) order_id, affiliate_id, client_id FROM bd
                ORDER BY order_id, deposit_time NULLS FIRST, deposit_amount NULLS FIRST, client_id NULLS FIRST, deposit_coin NULLS FIRST)
      UNION ALL SELECT 'bronze_trades', affiliate_id, client_id FROM bt, range(2)
      UNION ALL SELECT 'bronze_assets', affiliate_id, client_id FROM ba, range(2)) GROUP BY 1, 2"""),
        "run_silver_layer": with_(SILVER, "SELECT * FROM st"),
        "run_gold_layer": with_(LANDED, "SELECT * FROM gm"),
        "gold_refresh": with_(FROM_EVENTS, "SELECT * FROM gm"),
        "gold_refresh_daily": with_(FROM_EVENTS, "SELECT * FROM gd"),
        "run_silver_incremental": with_([b("bt"), *FIRST_DEPOSITS], f"""SELECT 'tradeactivities' AS table_name, if(client_id IN {IN_EVENTS}, 'silver', 'waiting') AS state,
       client_id, trade_time AS at, CAST(trade_volume AS DECIMAL(18,8)) AS amount FROM ({latest_trades('bt')})
UNION ALL SELECT 'deposits', if(client_id IN {IN_EVENTS}, 'silver', 'waiting'), client_id, deposit_time, CAST(deposit_amount AS DECIMAL(18,8))
FROM ({latest_deposits('bd')})"""),
    }
    return q

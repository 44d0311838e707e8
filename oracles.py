"""The same queries as plain SQL over the given tables."""

from __future__ import annotations

from collections.abc import Sequence

AS_OF = "20240131"
PROCESS = "2024-01-31"
RUN_DATE = "2024-02-01"

# --- derived inputs -------------------------------------------------------

P_CUSTOMER = """
changed AS (
  SELECT c_custkey AS k,
    CASE WHEN c_custkey % 23 = 0 THEN lower(c_name) ELSE c_name END AS c_name,
    c_nationkey,
    CASE WHEN c_custkey % 13 = 0 THEN NULL
         WHEN c_custkey % 11 = 0 AND c_custkey % 7 = 0 THEN c_acctbal * 1.00001::double + 1
         WHEN c_custkey % 11 = 0 THEN c_acctbal + 1
         WHEN c_custkey % 7 = 0 THEN c_acctbal * 1.00001::double
         ELSE c_acctbal END AS c_acctbal,
    CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_custkey % 101 <> 0),
p AS (
  SELECT k AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM changed
  UNION ALL SELECT k, c_name, c_nationkey, c_acctbal, c_mktsegment FROM changed WHERE k % 97 = 0
  UNION ALL SELECT k + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM changed WHERE k % 89 = 0)
"""

P_LINEITEM = """
pl AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CASE WHEN l_suppkey % 29 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem WHERE l_partkey % 211 <> 0)
"""

H_CUSTOMER = """
cur AS (
  SELECT *, '20240131000000' AS ifw_effective_date, '' AS ifw_effective_end_date FROM customer),
hist AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal - 100 AS c_acctbal, c_mktsegment,
    '20231231000000' AS ifw_effective_date, '20240131000000' AS ifw_effective_end_date
  FROM customer WHERE c_custkey % 3 = 0
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal - 200, c_mktsegment, '20231130000000', '20231231000000'
  FROM customer WHERE c_custkey % 5 = 0
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, '20231031000000', NULL
  FROM customer WHERE c_custkey % 50 = 0),
every AS (SELECT * FROM cur UNION ALL SELECT * FROM hist)
"""

POSITIONS = f"""
raw_pos AS (
  SELECT l.*, p.p_size, translate(p.p_brand, '0123456789', 'ABCDEFGHIJ') AS code,
    CASE WHEN l.l_returnflag = 'A' THEN 'CALL' ELSE 'PUT' END AS kind,
    (p.p_size % 4 + 1) * 10 AS strike
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
pos AS (
  SELECT l_suppkey::varchar AS bor_client_id,
    kind || ' 100 ' || code || '''24 @' || strike::varchar AS option_name,
    'U' || (p_size % 3)::varchar AS underlying,
    CASE WHEN l_linenumber <> 7 THEN code END AS underlying_symbol,
    code || ' CORP' AS underlying_sec_name,
    strftime(date_trunc('year', l_shipdate), '%Y-%m-%d') AS option_maturitydate,
    CASE WHEN l_linestatus = 'O' THEN 'Long' ELSE 'Short' END AS short_or_long,
    strike AS strikepriceamount,
    CASE WHEN l_linestatus = 'O' THEN 1 ELSE -1 END * (l_quantity % 4 + 1)::int AS option_tradeqty,
    '{PROCESS}' AS process_date, '{RUN_DATE}' AS run_date
  FROM raw_pos)
"""

# Netting, stage by stage, each as the text of the specification.
SYMBOL = (
    "trim(string_split(regexp_replace(regexp_replace(option_name, '[0-9$''@+]', '|', 'g'), '\\|+', '|', 'g'), '|')[2])"
)
G = "bor_client_id, option_type, underlying_symbol"


def _g_match(a: str, b: str) -> str:
    cols = [c.strip() for c in G.split(",")]
    return " AND ".join(f"coalesce({a}.{c}, '') = coalesce({b}.{c}, '')" for c in cols)


NET = f"""
{POSITIONS},
n1 AS (
  SELECT * EXCLUDE (underlying_sec_name, underlying_symbol),
    CASE WHEN underlying_sec_name IS NULL OR underlying_sec_name = '' THEN option_name
         ELSE underlying_sec_name END AS underlying_sec_name,
    coalesce(underlying_symbol, {SYMBOL}) AS underlying_symbol
  FROM pos),
n2 AS (
  SELECT {G}, underlying, underlying_sec_name, option_maturitydate, short_or_long, strikepriceamount,
    sum(option_tradeqty)::bigint AS quantity
  FROM (SELECT *, trim(substring(option_name, 1, 4)) AS option_type FROM n1)
  GROUP BY ALL HAVING sum(option_tradeqty) <> 0),
n2g AS (SELECT {G} FROM n2 GROUP BY ALL HAVING count(DISTINCT short_or_long) > 1),
n3 AS (
  SELECT n2.* REPLACE (strikepriceamount::decimal(30,6) AS strikepriceamount)
  FROM n2 WHERE EXISTS (SELECT 1 FROM n2g WHERE {_g_match("n2", "n2g")})),
n4s AS (
  SELECT {G}, underlying, underlying_sec_name, option_maturitydate, strikepriceamount, sum(quantity)::bigint AS quantity
  FROM n3 WHERE short_or_long = 'Long' GROUP BY ALL),
n4 AS (
  SELECT *,
    row_number() OVER (ORDER BY {G}, underlying, underlying_sec_name, option_maturitydate, strikepriceamount) AS row_id
  FROM n4s),
n4m AS (
  SELECT {G}, underlying, option_maturitydate, min(row_id) AS row_id, sum(quantity)::bigint AS quantity
  FROM n4 GROUP BY ALL),
n5 AS (
  SELECT {G}, underlying, option_maturitydate, underlying_sec_name, sum(quantity)::bigint AS quantity
  FROM n3 WHERE short_or_long = 'Short' GROUP BY ALL),
n6 AS (
  SELECT a.row_id,
    coalesce(a.bor_client_id, b.bor_client_id) AS bor_client_id,
    coalesce(a.option_type, b.option_type) AS option_type,
    coalesce(a.underlying_symbol, b.underlying_symbol) AS underlying_symbol,
    coalesce(a.underlying, b.underlying) AS underlying,
    coalesce(a.option_maturitydate, b.option_maturitydate) AS long_option_maturitydate,
    b.option_maturitydate AS short_option_maturitydate,
    coalesce(b.quantity, 0) AS short_quantity, b.underlying_sec_name
  FROM n4m a FULL JOIN n5 b
    ON a.bor_client_id IS NOT DISTINCT FROM b.bor_client_id
   AND a.option_type IS NOT DISTINCT FROM b.option_type
   AND a.underlying_symbol IS NOT DISTINCT FROM b.underlying_symbol
   AND a.underlying IS NOT DISTINCT FROM b.underlying
   AND a.option_maturitydate IS NOT DISTINCT FROM b.option_maturitydate),
n7 AS (
  SELECT s.row_id,
    coalesce(s.bor_client_id, l.bor_client_id) AS bor_client_id,
    coalesce(s.option_type, l.option_type) AS option_type,
    coalesce(s.underlying_symbol, l.underlying_symbol) AS underlying_symbol,
    coalesce(s.underlying, l.underlying) AS underlying,
    CASE WHEN s.bor_client_id IS NULL THEN l.underlying_sec_name ELSE s.underlying_sec_name END AS underlying_sec_name,
    coalesce(s.long_option_maturitydate, l.option_maturitydate) AS long_option_maturitydate,
    s.short_option_maturitydate, s.short_quantity,
    coalesce(l.quantity, 0) AS long_quantity,
    coalesce(l.strikepriceamount, 0::decimal(30,6)) AS strikepriceamount,
    CASE WHEN s.bor_client_id IS NULL THEN 'step3.1' ELSE 'step4' END AS source
  FROM n6 s FULL JOIN n4 l ON s.row_id = l.row_id),
n8 AS (
  SELECT *,
    CASE WHEN short_quantity + long_quantity = 0 THEN long_quantity ELSE 0 END AS occ_qty_reported,
    CASE WHEN short_quantity + long_quantity = 0 THEN strikepriceamount ELSE 0::decimal(30,6) END AS occ_strkprice_report,
    CASE WHEN short_quantity + long_quantity = 0 THEN 'Yes' ELSE 'No' END AS row_processed
  FROM n7),
n9 AS (
  SELECT {G}, underlying, underlying_sec_name, long_option_maturitydate, short_option_maturitydate,
    strikepriceamount, source, short_or_long, quantity
  FROM (
    SELECT *, 'Short' AS short_or_long, coalesce(short_quantity, 0) AS quantity FROM n8 WHERE row_processed = 'No'
    UNION ALL
    SELECT *, 'Long', coalesce(long_quantity, 0) FROM n8 WHERE row_processed = 'No')
  WHERE quantity <> 0),
n9g AS (SELECT {G} FROM n9 GROUP BY ALL HAVING count(DISTINCT short_or_long) > 1),
n10a AS (
  SELECT n8.* REPLACE (coalesce(short_quantity, 0) AS short_quantity, coalesce(long_quantity, 0) AS long_quantity)
  FROM n8 WHERE row_processed = 'No' AND EXISTS (SELECT 1 FROM n9g WHERE {_g_match("n8", "n9g")})),
n10b AS (
  SELECT *, row_number() OVER (PARTITION BY {G} ORDER BY __ORDER__
      underlying NULLS FIRST, short_option_maturitydate NULLS FIRST, underlying_sec_name NULLS FIRST,
      source NULLS FIRST, strikepriceamount NULLS FIRST, short_quantity NULLS FIRST, long_quantity NULLS FIRST
    ) AS row_seqno
  FROM n10a),
n10c AS (
  SELECT *, (sum(long_quantity + short_quantity) OVER w)::bigint AS run
  FROM n10b WINDOW w AS (PARTITION BY {G} ORDER BY row_seqno ROWS UNBOUNDED PRECEDING)),
n10d AS (
  SELECT *, run - greatest(max(run) OVER w, 0) AS short_balance
  FROM n10c WINDOW w AS (PARTITION BY {G} ORDER BY row_seqno ROWS UNBOUNDED PRECEDING)),
n10 AS (
  SELECT *, coalesce(lag(short_balance) OVER (PARTITION BY {G} ORDER BY row_seqno), 0) AS short_balance_prev
  FROM n10d),
n11a AS (SELECT *, short_balance_prev + short_quantity + long_quantity AS short_balance_calc FROM n10),
n11 AS (
  SELECT * FROM (
    SELECT * EXCLUDE (occ_qty_reported, occ_strkprice_report), strikepriceamount AS occ_strkprice_report,
      CASE WHEN short_balance_calc < 0 AND long_quantity > 0 THEN long_quantity
           WHEN short_balance_calc < 0 THEN 0
           WHEN short_balance_calc > 0 AND long_quantity > 0
             THEN CASE WHEN short_balance_prev = 0 THEN -short_quantity ELSE -short_balance_prev END
           WHEN short_balance_calc > 0 THEN 0
           ELSE -short_balance_prev END AS occ_qty_reported
    FROM n11a) WHERE occ_qty_reported > 0),
n12 AS (
  SELECT bor_client_id, underlying, underlying_symbol AS symbol, '' AS underlying_sec_name, option_type,
    long_option_maturitydate AS expiry_maturity_date, occ_strkprice_report, occ_qty_reported,
    replace(long_option_maturitydate, '-', '') AS mmy,
    strftime(long_option_maturitydate::date, '%m%d%Y') AS series_contract_date,
    substring(option_type, 1, 1) AS p_c, '4' AS txntyp, '1' AS actn, '00615' AS id_clr, 'C' AS id_acct,
    '26' AS typ, 'Spreads' AS txt, 'O' || substring(option_type, 1, 1) || 'XXXX' AS cfi, 'IAS' AS typ_ias,
    '{PROCESS}' AS process_date, '{RUN_DATE}' AS run_date
  FROM (
    SELECT {G}, underlying, long_option_maturitydate, occ_qty_reported, occ_strkprice_report
    FROM n8 WHERE row_processed = 'Yes'
    UNION ALL
    SELECT {G}, underlying, long_option_maturitydate, occ_qty_reported, occ_strkprice_report FROM n11))
"""

ORDERED = "long_option_maturitydate NULLS FIRST, strikepriceamount NULLS FIRST,"
ALTERIX = "long_option_maturitydate NULLS FIRST, coalesce(row_id, 9999999999999),"
NEWEST = "long_option_maturitydate DESC NULLS LAST, strikepriceamount NULLS FIRST,"
UNORDERED = "long_option_maturitydate NULLS FIRST,"


def net(select: str, order: str = ORDERED, extra: str = "") -> str:
    return f"WITH {NET.replace('__ORDER__', order)}{extra} {select}"


# --- comparison -----------------------------------------------------------


def cell(column: str, kind: str, percent: float = 0.002) -> str:
    s, t = f"s_{column}", f"t_{column}"
    if kind == "text":
        return f"coalesce({t}, '') = coalesce({s}, '')"
    if kind == "tolerance":
        a = f"abs(coalesce({t}::decimal(31,6), 0))::double"
        b = f"abs(coalesce({s}::decimal(31,6), 0))::double"
        return f"{a} BETWEEN {b} * {1 - percent / 100!r}::double AND {b} * {1 + percent / 100!r}::double"
    return f"{t} IS NOT DISTINCT FROM {s}"


def joined(src: str, tgt: str, columns: Sequence[str], on: str, how: str = "FULL") -> str:
    """CTE `j` with s_x, t_x, in_src, in_tgt."""
    s = ", ".join(f"s.{c} AS s_{c}" for c in columns)
    t = ", ".join(f"t.{c} AS t_{c}" for c in columns)
    return (
        f"j AS (SELECT {s}, {t}, s._in IS NOT NULL AS in_src, t._in IS NOT NULL AS in_tgt "
        f"FROM (SELECT *, 1 AS _in FROM {src}) s {how} JOIN (SELECT *, 1 AS _in FROM {tgt}) t ON {on})"
    )


def on_keys(*keys: str) -> str:
    return " AND ".join(f"s.{k} IS NOT DISTINCT FROM t.{k}" for k in keys)


def same(a: str, b: str, columns: Sequence[str]) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in columns)


def cells_sql(kinds: dict[str, str]) -> str:
    """One row per column of `j`."""
    counters = ", ".join(
        f"count(*) FILTER (WHERE {cell(c, k)}) AS p_{c}, count(*) FILTER (WHERE t_{c} IS NULL) AS n_{c}"
        for c, k in kinds.items()
    )
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, p_{c} AS pass_count, total - p_{c} AS fail_count, n_{c} AS null_count FROM one"
        for c in kinds
    )
    return f"one AS (SELECT count(*) AS total, {counters} FROM j), cells AS ({rows})"


def result_sql(src: str, tgt: str, name: str, not_null: Sequence[str] = ()) -> str:
    listed = ", ".join(f"'{c}'" for c in not_null) or "''"
    return f"""
SELECT 'Regression' AS type, '{name}' AS table_name, column_name,
  CASE WHEN src_count <> tgt_count THEN 'FAIL(Count Check)'
       WHEN column_name IN ({listed}) AND null_count <> 0 THEN 'FAIL(Null Check)'
       WHEN src_count <> pass_count + fail_count THEN 'FAIL(Duplicate Check)'
       WHEN fail_count = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status,
  src_count::bigint AS src_count, tgt_count::bigint AS tgt_count, pass_count::bigint AS pass_count,
  fail_count::bigint AS fail_count, null_count::bigint AS null_count,
  round(pass_count::double / nullif(src_count, 0) * 100, 2) AS src_pass_percentage,
  round(pass_count::double / nullif(tgt_count, 0) * 100, 2) AS tgt_pass_percentage,
  round(null_count::double / nullif(tgt_count, 0) * 100, 2) AS tgt_null_percentage,
  '{PROCESS}' AS process_date, '{AS_OF}' AS as_of_date
FROM cells, (SELECT (SELECT count(*) FROM {src}) AS src_count, (SELECT count(*) FROM {tgt}) AS tgt_count)
"""


def summary(ctes: str, src: str, tgt: str, kinds: dict[str, str], on: str, name: str, how="FULL", not_null=()) -> str:
    start = f"{ctes}, " if ctes else ""
    return (
        f"WITH {start}{joined(src, tgt, list(kinds), on, how)}, {cells_sql(kinds)} {result_sql(src, tgt, name, not_null)}"
    )


def check_row(kind: str, name: str, column: str, status: str, tgt: str = "", **counts: str) -> str:
    names = ("src_count", "tgt_count", "pass_count", "fail_count", "null_count")
    cols = ", ".join(f"({counts.get(c, 'NULL')})::bigint AS {c}" for c in names)
    percents = ", ".join(
        f"NULL::double AS {c}" for c in ("src_pass_percentage", "tgt_pass_percentage", "tgt_null_percentage")
    )
    return (
        f"SELECT '{kind}' AS type, '{name}' AS table_name, '{column}' AS column_name, {status} AS overall_status, "
        f"{cols}, {percents}, '{PROCESS}' AS process_date, '{AS_OF}' AS as_of_date {tgt}"
    )


def count_check(src: str, tgt: str, name: str) -> str:
    s, t = f"SELECT count(*) FROM {src}", f"SELECT count(*) FROM {tgt}"
    return check_row("Count", name, "", f"CASE WHEN ({s}) = ({t}) THEN 'PASS' ELSE 'FAIL' END", src_count=s, tgt_count=t)


def null_check(tgt: str, name: str, columns: Sequence[str]) -> str:
    n = f"SELECT count(*) FROM {tgt} WHERE " + " OR ".join(f"{c} IS NULL" for c in columns)
    return check_row("Null", name, ",".join(columns), f"CASE WHEN ({n}) = 0 THEN 'PASS' ELSE 'FAIL' END", null_count=n)


def dupe_check(tgt: str, name: str, keys: Sequence[str]) -> str:
    k = ", ".join(keys)
    n = f"SELECT count(*) FROM (SELECT {k} FROM {tgt} GROUP BY {k} HAVING count(*) > 1)"
    return check_row(
        "Duplicate", name, ",".join(keys), f"CASE WHEN ({n}) = 0 THEN 'PASS' ELSE 'FAIL' END", fail_count=n
    )


CUSTOMER = {
    "c_custkey": "typed", "c_name": "text", "c_nationkey": "typed", "c_acctbal": "typed", "c_mktsegment": "text",
}
CUSTOMER_TOL = CUSTOMER | {"c_acctbal": "tolerance"}
LINEITEM = {
    "l_orderkey": "typed", "l_partkey": "typed", "l_suppkey": "typed", "l_linenumber": "typed", "l_quantity": "typed",
    "l_extendedprice": "typed", "l_discount": "typed", "l_tax": "typed", "l_returnflag": "text",
    "l_linestatus": "text", "l_shipdate": "typed",
}
LINE_COLUMNS = list(LINEITEM)
LINE_ORDER = ", ".join(f"{c} NULLS FIRST" for c in LINE_COLUMNS)


def numbered(source: str, partition: str = "") -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    return f"(SELECT *, row_number() OVER ({part}ORDER BY {LINE_ORDER}) AS row_id FROM {source})"


def status_cells(columns: dict[str, str]) -> str:
    out = []
    for c, k in columns.items():
        out += [
            f"t_{c} AS {c}",
            f"s_{c} AS qa_{c}",
            f"CASE WHEN {cell(c, k)} THEN 'PASS' ELSE 'FAIL' END AS status_{c}",
            f"(t_{c} IS NULL)::int AS {c}_null",
        ]
    return ", ".join(out)


ROW_STATUS = "CASE WHEN in_src AND in_tgt THEN 'matched' WHEN in_src THEN 'src_only' ELSE 'tgt_only' END AS row_status"

RESULTS = f"""
{P_CUSTOMER},
{joined("customer", "p", list(CUSTOMER_TOL), on_keys("c_custkey"))}, {cells_sql(CUSTOMER_TOL)},
regression AS ({result_sql("customer", "p", "customer", ["c_custkey"])}),
checks AS (
  {count_check("customer", "p", "customer")}
  UNION ALL {null_check("p", "customer", ["c_custkey"])}
  UNION ALL {dupe_check("p", "customer", ["c_custkey"])})
"""

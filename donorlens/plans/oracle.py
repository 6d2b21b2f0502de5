"""DuckDB oracle SQL for the registered queries.

An independent formulation of the mart definitions, deliberately not the shape of the Spark
plans: the slot marts are built long first (cohort sizes x ``range(0, 12)`` left-joined to a
cohort x month table) and widened at the end, cumulative columns are window frames, churn is a
correlated ``EXISTS``, the next-three-months cadence a correlated aggregate, the RFM statistics
one-row CTE. Rounding follows ROUND(numeric, s) (half away from zero) through integer arithmetic
on cents and counts; DuckDB's DOUBLE division would round differently.
"""

from __future__ import annotations

# Fixed values of the mart definitions, written out here so that the code under test can't change them.
ARPPU_SCALE = 6
SEGMENTS: list[tuple[str, list[str]]] = [
    ("VIP", ["444", "443", "344"]),
    ("Постоянные", ["442", "441", "434", "433", "432", "331", "332", "343", "342", "334"]),
    ("Новые", ["431", "424", "423", "422", "421", "414", "413", "412", "411"]),
    ("Высокий потенциал", ["341", "333", "324", "323", "322", "243"]),
    ("Малоактивные", ["321", "314", "313", "312", "311", "241", "232", "222", "221", "214",
                      "213", "212", "211", "142", "141"]),
    ("Спящие", ["234", "233", "242", "244", "144", "224", "223", "143"]),
    ("Потерянные", ["134", "133", "132", "131", "124", "123", "122", "121", "114", "113",
                    "112", "111"]),
]

AS_OF = "DATE '2001-08-01'"
EV_AS_OF = "DATE '2024-02-01'"
H = 12


def rq(num: str, den: str, scale: int = 2, mult: int = 1) -> str:
    """Scaled integer of round(num * mult / den, scale), NULL when den = 0."""
    k2 = 2 * mult * 10**scale
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE sign({num}) * "
            f"((CAST(abs({num}) AS HUGEINT) * {k2} + ({den})) // (2 * CAST(({den}) AS HUGEINT))) END)")


def dbl(q: str, scale: int) -> str:
    return f"(CAST({q} AS DOUBLE) / {10**scale})"


def rnd(num: str, den: str, scale: int = 2, mult: int = 1) -> str:
    return dbl(rq(num, den, scale, mult), scale)


CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
PAID = "o_orderstatus = 'F'"


# ---- ingest and maintenance ----------------------------------------------------------------

PAID_ORDERS_EXTRACT = f"""
SELECT o_custkey AS user_id, o_orderkey AS order_id, o_orderdate AS order_date,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS order_price
FROM orders WHERE {PAID}"""

PARSE_EVENT_TIMES = """
SELECT event_id, date_trunc('minute', ts) AS ts_minute, date_trunc('second', ts) AS ts_second
FROM events"""

PARSE_ORDER_TIMES = """
SELECT o_orderkey AS order_id, date_trunc('minute', o_orderdate) AS ts_minute,
       date_trunc('second', o_orderdate) AS ts_second
FROM orders"""

CSV_INGEST = """
SELECT o_custkey AS customer_id, o_orderkey AS order_id,
       CASE WHEN o_orderstatus = 'F' THEN 'Paid' ELSE o_orderstatus END AS status,
       o_orderdate AS order_ts, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
FROM orders"""

DUPLICATE_KEYS_LINEITEM = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS dup_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""


def _violations(table: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    null_any = " OR ".join(f"{c} IS NULL" for c in keys)
    return f"""
SELECT '{table}' AS table_name, '{",".join(keys)}' AS key_columns,
       CAST(COALESCE(SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS duplicate_keys,
       CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n ELSE 0 END), 0) AS BIGINT) AS duplicate_rows,
       CAST(COALESCE(SUM(CASE WHEN has_null = 1 THEN n ELSE 0 END), 0) AS BIGINT) AS null_keys
FROM (SELECT {k}, COUNT(*) AS n, MAX(CASE WHEN {null_any} THEN 1 ELSE 0 END) AS has_null
      FROM {table} GROUP BY {k}) t"""


UNIQUE_KEY_ASSERTION = " UNION ALL ".join([
    _violations("orders", ["o_orderkey"]), _violations("events", ["event_id"]),
    _violations("lineitem", ["l_orderkey", "l_linenumber"])])

_LOADS = """
WITH o AS (SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderstatus AS status,
                  o_orderdate AS order_ts, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
ex AS (SELECT * FROM o WHERE order_ts < TIMESTAMP '2000-01-01'),
inc AS (SELECT customer_id, order_id, status, order_ts, CAST(amount + 1 AS DECIMAL(18,2)) AS amount
        FROM o WHERE order_ts >= TIMESTAMP '1999-01-01')"""
_OCOLS = "customer_id, order_id, status, order_ts, CAST(amount AS DOUBLE) AS amount"

UPSERT_BY_KEY = f"""{_LOADS}
SELECT {_OCOLS} FROM ex WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.order_id = ex.order_id)
UNION ALL SELECT {_OCOLS} FROM inc"""

INSERT_IGNORE_BY_KEY = f"""{_LOADS}
SELECT {_OCOLS} FROM ex
UNION ALL SELECT {_OCOLS} FROM inc WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.order_id = inc.order_id)"""

STORED_APPEND = """
SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderstatus AS status, o_orderdate AS order_ts,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
FROM orders"""

UNION_BY_NAME = """
SELECT event_id, user_id, ts, CAST(NULL AS DOUBLE) AS value FROM events WHERE event_type IN ('click', 'view')
UNION ALL
SELECT event_id, user_id, ts, value FROM events WHERE event_type NOT IN ('click', 'view')"""

# ---- shared CTEs ------------------------------------------------------------------------------

# paid orders: customer, order time, calendar month, whole cents
PO = f"""po AS (
  SELECT o_custkey AS cid, o_orderdate AS t, CAST(date_trunc('month', o_orderdate) AS DATE) AS mon,
         {CENTS} AS cents
  FROM orders WHERE {PAID})"""
# first paid month per customer, and cohort sizes
FM = "fm AS (SELECT cid, MIN(mon) AS fmon FROM po GROUP BY cid)"
SIZES = "sizes AS (SELECT fmon, COUNT(*) AS n FROM fm GROUP BY fmon)"
# paid cohort x calendar month
CM = """cm AS (
  SELECT fm.fmon, po.mon, SUM(po.cents) AS rev, COUNT(*) AS n_orders, COUNT(DISTINCT po.cid) AS users
  FROM po JOIN fm ON po.cid = fm.cid GROUP BY fm.fmon, po.mon)"""


def slots_long(sizes: str = "sizes", key: str = "fmon", size: str = "n", as_of: str = AS_OF) -> str:
    """Every cohort x offset 0..11 with the calendar month of the offset (0 = as-of month)."""
    return f"""sl AS (
  SELECT s.{key} AS cohort_month, s.{size} AS total_users, r.o AS off,
         CAST(date_trunc('month', {as_of}) - to_months(r.o) AS DATE) AS smon
  FROM {sizes} s CROSS JOIN range(0, {H}) r(o))"""


# long cohort x slot with the paid measures (NULL when the cohort had no order that month)
SV = """sv AS (
  SELECT sl.*, cm.rev, cm.n_orders, cm.users
  FROM sl LEFT JOIN cm ON cm.fmon = sl.cohort_month AND cm.mon = sl.smon)"""
PAID_SLOTS = f"WITH {PO}, {FM}, {SIZES}, {CM}, {slots_long()}, {SV}"


def widen(src: str, keys: str, cols: list[tuple[str, str]]) -> str:
    """Long (key.., off, values) -> one column per (expression at an offset); ``cols`` lists
    (output name, SQL of the value with ``{o}`` for the offset test)."""
    sel = ",\n       ".join(f"MAX(CASE WHEN off = {o} THEN {expr} END) AS \"{name}\"" for name, expr, o in cols)
    return f"SELECT {keys},\n       {sel}\nFROM {src} GROUP BY {keys}"


def _k_cols(prefix: str, expr: str) -> list:
    """slot k = offset k-1, columns ordered k = 12..1 as in the marts."""
    return [(f"{prefix}{k}", expr, k - 1) for k in range(H, 0, -1)]


# ---- RFM ---------------------------------------------------------------------------------------

def _rfm_base(src: str, as_of: str) -> str:
    """rb: customer_id, recency_days (day field of as-of midnight - last order at minute
    precision), frequency, monetary_cents. ``src`` yields (cid, t, cents)."""
    return f"""src AS ({src}),
rb AS (
  SELECT cid AS customer_id,
         CAST(extract(day FROM (CAST({as_of} AS TIMESTAMP) - MAX(date_trunc('minute', t)))) AS BIGINT) AS recency_days,
         COUNT(*) AS frequency, CAST(SUM(cents) AS BIGINT) AS monetary_cents
  FROM src GROUP BY cid)"""


_ORDERS_SRC = f"SELECT o_custkey AS cid, o_orderdate AS t, {CENTS} AS cents FROM orders WHERE {PAID}"
_EVENTS_SRC = ("SELECT user_id AS cid, ts AS t, CAST(round(value * 100) AS BIGINT) AS cents "
               "FROM events WHERE event_type = 'purchase'")


def _grade(x: str, mean: str, sd: str, up: bool) -> str:
    """4..1 by mean +- one sample sd; NULL sd leaves only the mean test."""
    if up:
        tests = [(f"{x} >= {mean} + {sd}", 4), (f"{x} >= {mean}", 3), (f"{x} >= {mean} - {sd}", 2)]
    else:
        tests = [(f"{x} <= {mean} - {sd}", 4), (f"{x} <= {mean}", 3), (f"{x} <= {mean} + {sd}", 2)]
    return "CAST(CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in tests) + " ELSE 1 END AS BIGINT)"


def _rfm_scored(src: str, as_of: str) -> str:
    return f"""WITH {_rfm_base(src, as_of)},
st AS (
  SELECT AVG(recency_days) AS mr, STDDEV_SAMP(recency_days) AS dr, AVG(frequency) AS mf,
         STDDEV_SAMP(frequency) AS df, AVG(monetary_cents) AS mm, STDDEV_SAMP(monetary_cents) AS dm FROM rb),
sc AS (
  SELECT rb.*, {_grade('recency_days', 'st.mr', 'st.dr', False)} AS recency_score,
         {_grade('frequency', 'st.mf', 'st.df', True)} AS frequency_score,
         {_grade('monetary_cents', 'st.mm', 'st.dm', True)} AS monetary_score
  FROM rb CROSS JOIN st),
gr AS (SELECT *, CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR)
              AS rfm_group FROM sc),
shares AS (
  SELECT rfm_group, COUNT(*) AS group_count,
         {rnd('COUNT(*)', '(SELECT COUNT(*) FROM gr)', 2, 100)} AS percent_rfm
  FROM gr GROUP BY rfm_group)"""


def _segment(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} IN ({', '.join(repr(c) for c in codes)}) THEN '{label}'"
                              for label, codes in SEGMENTS) + " END"


def _rfm_mart(src: str, as_of: str) -> str:
    return _rfm_scored(src, as_of) + f"""
SELECT g.customer_id, g.recency_days, g.frequency, CAST(g.monetary_cents AS DOUBLE) / 100 AS monetary,
       g.recency_score, g.frequency_score, g.monetary_score, g.rfm_group, s.percent_rfm,
       {_segment('g.rfm_group')} AS cats
FROM gr g JOIN shares s ON g.rfm_group = s.rfm_group"""


RFM_BASE = f"WITH {_rfm_base(_ORDERS_SRC, AS_OF)} SELECT * FROM rb"
RFM_BASE_EVENTS = f"WITH {_rfm_base(_EVENTS_SRC, EV_AS_OF)} SELECT * FROM rb"
RFM_SCORES = _rfm_scored(_ORDERS_SRC, AS_OF) + " SELECT * FROM sc"
RFM_GROUP_SHARE = _rfm_scored(_ORDERS_SRC, AS_OF) + " SELECT * FROM shares"
RFM_SEGMENTS = _rfm_mart(_ORDERS_SRC, AS_OF)
RFM_SEGMENTS_EVENTS = _rfm_mart(_EVENTS_SRC, EV_AS_OF)

# ---- cohorts ------------------------------------------------------------------------------------

COHORTS_ALL = """
SELECT o_custkey AS user_id, CAST(date_trunc('month', MIN(o_orderdate)) AS DATE) AS cohort_month
FROM orders GROUP BY o_custkey"""
COHORTS_PAID = f"WITH {PO}, {FM} SELECT cid AS user_id, fmon AS cohort_month FROM fm"
COHORT_SIZES = f"WITH {PO}, {FM}, {SIZES} SELECT fmon AS cohort_month, n AS total_users FROM sizes"
COHORT_MONTH_REVENUE = f"""WITH {PO}, {FM}, {CM}
SELECT fmon AS cohort_month, mon AS month, {dbl('rev', 2)} AS revenue FROM cm"""

_ARPPU_DEN = "100 * COALESCE(NULLIF(total_users, 0), 1)"
_REV = "COALESCE(rev, 0)"
_KEYS = "cohort_month, total_users"

COHORT_REVENUE_SLOTS = PAID_SLOTS + "\n" + widen("sv", _KEYS, _k_cols("revenue_month_", dbl(_REV, 2)))
COHORT_ARPPU = PAID_SLOTS + "\n" + widen("sv", _KEYS, _k_cols("arppu_month_", rnd(_REV, _ARPPU_DEN, ARPPU_SCALE)))
COHORT_REVENUE_ARPPU = PAID_SLOTS + "\n" + widen(
    "sv", _KEYS, _k_cols("revenue_month_", dbl(_REV, 2)) + _k_cols("arppu_month_", rnd(_REV, _ARPPU_DEN, ARPPU_SCALE)))

# running revenue from the oldest slot (offset 11) down to each offset
CUM = """cum AS (
  SELECT sv.*, SUM(COALESCE(rev, 0)) OVER (PARTITION BY cohort_month ORDER BY off DESC
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS crev
  FROM sv)"""
ARPPU_CUMULATIVE = (PAID_SLOTS + f", {CUM}\n"
                    + widen("cum", _KEYS, _k_cols("cumulative_arppu_", rnd("crev", _ARPPU_DEN, 2))))

# LTV: all-user cohorts (first order of any status) x slots, paid revenue of the same month
LTV_LONG_CTES = f"""WITH {PO}, {FM}, {CM},
au AS (SELECT CAST(date_trunc('month', MIN(o_orderdate)) AS DATE) AS amon FROM orders GROUP BY o_custkey),
asz AS (SELECT amon, COUNT(*) AS n FROM au GROUP BY amon),
{slots_long('asz', 'amon', 'n')},
paid_slot AS (SELECT fmon, mon, SUM(rev) AS rev FROM cm GROUP BY fmon, mon),
lv AS (
  SELECT sl.*, COALESCE(p.rev, 0) AS rev,
         {rq('COALESCE(p.rev, 0)', '100 * sl.total_users', 2)} AS ltvq
  FROM sl LEFT JOIN paid_slot p ON p.fmon = sl.cohort_month AND p.mon = sl.smon),
lc AS (
  SELECT lv.*, SUM(ltvq) OVER (PARTITION BY cohort_month ORDER BY off DESC
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cltvq
  FROM lv)"""
LTV_COHORTS = LTV_LONG_CTES + "\n" + widen(
    "lv", _KEYS, _k_cols("revenue_month_", dbl("rev", 2)) + _k_cols("ltv_month_", dbl("ltvq", 2)))
LTV_CUMULATIVE = LTV_LONG_CTES + "\n" + widen("lc", _KEYS, _k_cols("ltv_cumulative_", dbl("cltvq", 2)))

_RR = rnd("COALESCE(users, 0)", "total_users", 2, 100)
RETENTION_RATE = PAID_SLOTS + "\n" + widen(
    "(SELECT strftime(cohort_month, '%Y-%m') AS cohort, * EXCLUDE (cohort_month) FROM sv)", "cohort, total_users",
    _k_cols("RR Month ", _RR))

_AC = rnd("rev", "100 * n_orders", 2)
AVERAGE_CHECK = PAID_SLOTS + "\n" + widen(
    "(SELECT strftime(cohort_month, '%Y-%m') AS cohort, total_users AS unique_users, * EXCLUDE (cohort_month, total_users) FROM sv)",
    "cohort, unique_users",
    [("average_check_current_month", _AC, 0)] + [(f"average_check_month_{o}", _AC, o) for o in range(1, H)])

# ---- donor activity, churn, cadence ------------------------------------------------------------

DM = "dm AS (SELECT DISTINCT cid, mon FROM po)"

DONOR_MONTH_GRID = f"""WITH {PO}
SELECT cid AS customer_id, mon AS month, COUNT(*) AS n_orders, CAST(SUM(cents) AS BIGINT) AS revenue_cents
FROM po GROUP BY cid, mon"""

# a donor of month m is retained when the same donor has a paid month in (m, m + 3 months]
RET = f"""ret AS (
  SELECT d.mon, COUNT(*) AS total_donors,
         COUNT(*) FILTER (WHERE EXISTS (
           SELECT 1 FROM dm later WHERE later.cid = d.cid AND later.mon > d.mon
                                    AND later.mon <= d.mon + INTERVAL 3 MONTH)) AS retained_donors
  FROM dm d GROUP BY d.mon)"""
_CHURN = rnd("total_donors - retained_donors", "total_donors", 2, 100)

CHURN_RATE = f"""WITH {PO}, {DM}, {RET}
SELECT mon AS month, total_donors, retained_donors, {_CHURN} AS churn_rate FROM ret"""

NEWR = f"""newr AS (
  SELECT dm.mon, COUNT(*) FILTER (WHERE dm.mon = fm.fmon) AS new_donors, COUNT(*) AS total_donors
  FROM dm JOIN fm ON dm.cid = fm.cid GROUP BY dm.mon)"""
_NEW = rnd("new_donors", "total_donors", 2, 100)
NEW_DONOR_RATIO = f"""WITH {PO}, {FM}, {DM}, {NEWR}
SELECT mon AS month, new_donors, total_donors, {_NEW} AS new_donors_ratio FROM newr"""

# months with donors of two or more paid orders: their first-to-last span, averaged (2 places,
# kept as the scaled integer q); then for each such month the rounded mean of q over the
# following three calendar months
SPAN = f"""rep AS (
  SELECT mon, cid, epoch(MAX(date_trunc('minute', t))) - epoch(MIN(date_trunc('minute', t))) AS secs
  FROM po GROUP BY mon, cid HAVING COUNT(*) >= 2),
sp AS (SELECT mon, COUNT(*) AS repeat_donors, {rq('SUM(CAST(secs AS BIGINT))', '86400 * COUNT(*)', 2)} AS q
       FROM rep GROUP BY mon),
nx AS (
  SELECT a.mon,
         (SELECT {rq('SUM(b.q)', '100 * COUNT(b.q)', 2)} FROM sp b
           WHERE b.mon > a.mon AND b.mon <= a.mon + INTERVAL 3 MONTH) AS q
  FROM sp a)"""

DONATION_SPAN = f"""WITH {PO}, {SPAN}
SELECT mon AS month, repeat_donors, {dbl('q', 2)} AS avg_days_between_donations FROM sp"""
DONATION_SPAN_NEXT3 = f"""WITH {PO}, {SPAN}
SELECT mon AS month, {dbl('q', 2)} AS avg_days_between_donations FROM nx"""

CDR = f"""WITH {PO}, {FM}, {DM}, {RET}, {NEWR}, {SPAN}
SELECT r.mon AS month, {rnd('r.total_donors - r.retained_donors', 'r.total_donors', 2, 100)} AS churn_rate,
       COALESCE({rnd('n.new_donors', 'n.total_donors', 2, 100)}, 0) AS new_donors_ratio,
       COALESCE({dbl('x.q', 2)}, 0) AS avg_days_between_donations
FROM ret r JOIN newr n ON n.mon = r.mon LEFT JOIN nx x ON x.mon = r.mon"""

# ---- long marts: straight from the long forms -------------------------------------------------


def _long(ctes: str, src: str, key: str, value: str, month: str = "off + 1") -> str:
    return f"{ctes}\nSELECT {key} AS cohort_month, CAST({month} AS BIGINT) AS month, {value} FROM {src}"


LTV_LONG = _long(LTV_LONG_CTES, "lv", "cohort_month", f"{dbl('ltvq', 2)} AS ltv")
REVENUE_LONG = _long(LTV_LONG_CTES, "lv", "cohort_month", f"{dbl('rev', 2)} AS revenue")
LTV_CUM_LONG = _long(LTV_LONG_CTES, "lc", "cohort_month", f"{dbl('cltvq', 2)} AS ltv_cumulative")
ARPPU_LONG = _long(PAID_SLOTS, "sv", "cohort_month", f"{rnd(_REV, _ARPPU_DEN, ARPPU_SCALE)} AS arppu")
ARPPU_CUM_LONG = _long(PAID_SLOTS + f", {CUM}", "cum", "cohort_month", f"{rnd('crev', _ARPPU_DEN, 2)} AS cumulative_arppu")
RR_LONG = _long(PAID_SLOTS, "sv", "cohort_month", f"{_RR} AS rr")
AC_LONG = _long(PAID_SLOTS, "sv", "cohort_month", f"{_AC} AS average_check", month="off")

# ---- export files and published marts --------------------------------------------------------

# the lines of one export file per order year, numbered from the header on
_EXPORT_LINES = """
lines AS (
    SELECT 'orders_' || year(o_orderdate) || '.csv' AS file_name, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS n,
           concat_ws(';', o_orderkey, o_orderkey, o_custkey, strftime(o_orderdate, '%d.%m.%Y %H:%M:%S'), CAST(o_totalprice AS DECIMAL(18,2)),
                     CASE WHEN o_orderstatus = 'F' THEN 'Paid' ELSE o_orderstatus END) AS line
    FROM orders
    UNION ALL
    SELECT DISTINCT 'orders_' || year(o_orderdate) || '.csv', 0, 'OrderIdsMindboxId;OrderFirstActionIdsMindboxId;OrderCustomerIdsMindboxId;'
           || 'OrderFirstActionDateTimeUtc;OrderTotalPrice;OrderLineStatusIdsExternalId' FROM orders)"""


def _digests(hashed: str) -> str:
    return f"""
hashed AS (SELECT file_name, md5({hashed}) AS h FROM lines),
digests AS (SELECT file_name, md5(concat_ws(':', count(*), sum(CAST('0x' || substr(h, 1, 15) AS HUGEINT)), sum(CAST('0x' || substr(h, 16, 15) AS HUGEINT)))) AS md5
            FROM hashed GROUP BY file_name)"""


CHANGED_FILES = f"""
WITH {_EXPORT_LINES}, {_digests('line')}
SELECT file_name, md5, CASE WHEN file_name >= 'orders_1999' THEN 'new' WHEN file_name >= 'orders_1997' AND md5 <> reverse(md5) THEN 'changed' ELSE 'unchanged' END AS status
FROM digests"""

ORDERED_DIGESTS = f"""
WITH {_EXPORT_LINES}, {_digests("n || ':' || line")}
SELECT file_name, md5 FROM digests"""

CSV_INGEST_QUOTED = r"""
SELECT o_orderkey AS order_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
       'order "' || o_orderkey || '"' || chr(10) || ' a;b' || chr(92) || o_orderpriority AS note
FROM orders"""


def _down(prefix: str, kind: str) -> list[tuple[str, str]]:
    return [(f"{prefix}{k}", kind) for k in range(H, 0, -1)]


# The columns of the published marts and their types, and the query with the mart's rows.
_COHORT = [("cohort_month", "date"), ("total_users", "bigint")]
_D2 = "decimal(38,2)"
MARTS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "rfm": ("rfm_segments", [("customer_id", "bigint"), ("recency_days", "int"), ("frequency", "int"), ("monetary", _D2),
                             ("recency_score", "int"), ("frequency_score", "int"), ("monetary_score", "int"), ("rfm_group", "string"),
                             ("percent_rfm", _D2), ("cats", "string")]),
    "cohorts_all": ("cohorts_all", [("user_id", "bigint"), ("cohort_month", "date")]),
    "cohorts_paid": ("cohorts_paid", [("user_id", "bigint"), ("cohort_month", "date")]),
    "cohorts_revenue_arppu_data": ("cohort_revenue_arppu", _COHORT + _down("revenue_month_", _D2) + _down("arppu_month_", "decimal(38,6)")),
    "arppu_cumulative": ("arppu_cumulative", _COHORT + _down("cumulative_arppu_", _D2)),
    "ltv_cohorts": ("ltv_cohorts", _COHORT + _down("revenue_month_", _D2) + _down("ltv_month_", _D2)),
    "cumulative_ltv": ("ltv_cumulative", _COHORT + _down("ltv_cumulative_", _D2)),
    "rr_cohorts": ("retention_rate", [("cohort", "string"), ("total_users", "bigint")] + _down("RR Month ", "decimal(5,2)")),
    "ac_cohort": ("average_check", [("cohort", "string"), ("unique_users", "bigint"), ("average_check_current_month", _D2)]
                  + [(f"average_check_month_{k}", _D2) for k in range(1, H)]),
    "cdr": ("cdr", [("month", "date"), ("churn_rate", _D2), ("new_donors_ratio", _D2), ("avg_days_between_donations", _D2)]),
    "paid_only": ("paid_orders_extract", [("user_id", "bigint"), ("order_id", "bigint"), ("order_date", "timestamp_ntz"), ("order_price", "decimal(18,2)")]),
    **{mart: (query, [("cohort_month", "date"), ("month", "int"), (value, kind)]) for mart, query, value, kind in (
        ("ltv_t", "ltv_long", "ltv", _D2), ("revenue_t", "revenue_long", "revenue", _D2), ("ltv_cum_t", "ltv_cum_long", "ltv_cumulative", _D2),
        ("arppu_t", "arppu_long", "arppu", "decimal(38,6)"), ("arppu_cum_t", "arppu_cum_long", "cumulative_arppu", _D2),
        ("rr_t", "rr_long", "rr", "decimal(5,2)"), ("ac_t", "ac_long", "average_check", _D2))},
}


def _mart_schemas() -> str:
    rows = []
    for mart, (query, columns) in MARTS.items():
        entries = ", ".join(f"{{'column_name': '{c}', 'data_type': '{t}', 'n_values': count(\"{c}\")}}" for c, t in columns)
        rows.append(f"SELECT '{mart}' AS mart, count(*) AS n_rows, [{entries}] AS x FROM ({ORACLE[query]}) AS m")
    whole = "\nUNION ALL\n".join(rows)
    return f"SELECT mart, n_rows, x.column_name, x.data_type, x.n_values FROM (SELECT mart, n_rows, unnest(x) AS x FROM ({whole}))"


ORACLE: dict[str, str] = {
    "paid_orders_extract": PAID_ORDERS_EXTRACT,
    "parse_event_times": PARSE_EVENT_TIMES,
    "parse_order_times": PARSE_ORDER_TIMES,
    "csv_ingest": CSV_INGEST,
    "rfm_segments_from_export": RFM_SEGMENTS,
    "duplicate_keys_lineitem": DUPLICATE_KEYS_LINEITEM,
    "unique_key_assertion": UNIQUE_KEY_ASSERTION,
    "upsert_by_key": UPSERT_BY_KEY,
    "insert_ignore_by_key": INSERT_IGNORE_BY_KEY,
    "stored_upsert": UPSERT_BY_KEY,
    "stored_insert_ignore": INSERT_IGNORE_BY_KEY,
    "stored_append": STORED_APPEND,
    "union_by_name_missing_columns": UNION_BY_NAME,
    "rfm_base": RFM_BASE,
    "rfm_base_events": RFM_BASE_EVENTS,
    "rfm_scores": RFM_SCORES,
    "rfm_group_share": RFM_GROUP_SHARE,
    "rfm_segments": RFM_SEGMENTS,
    "rfm_segments_events": RFM_SEGMENTS_EVENTS,
    "cohorts_all": COHORTS_ALL,
    "cohorts_paid": COHORTS_PAID,
    "cohort_sizes": COHORT_SIZES,
    "cohort_month_revenue": COHORT_MONTH_REVENUE,
    "cohort_revenue_arppu": COHORT_REVENUE_ARPPU,
    "cohort_revenue_slots": COHORT_REVENUE_SLOTS,
    "cohort_arppu": COHORT_ARPPU,
    "arppu_cumulative": ARPPU_CUMULATIVE,
    "ltv_cohorts": LTV_COHORTS,
    "ltv_cumulative": LTV_CUMULATIVE,
    "retention_rate": RETENTION_RATE,
    "average_check": AVERAGE_CHECK,
    "donor_month_grid": DONOR_MONTH_GRID,
    "churn_rate": CHURN_RATE,
    "new_donor_ratio": NEW_DONOR_RATIO,
    "donation_span": DONATION_SPAN,
    "donation_span_next3": DONATION_SPAN_NEXT3,
    "cdr": CDR,
    "ltv_long": LTV_LONG,
    "revenue_long": REVENUE_LONG,
    "ltv_cum_long": LTV_CUM_LONG,
    "arppu_long": ARPPU_LONG,
    "arppu_cum_long": ARPPU_CUM_LONG,
    "rr_long": RR_LONG,
    "ac_long": AC_LONG,
}
ORACLE["changed_files"] = CHANGED_FILES
ORACLE["ordered_digests"] = ORDERED_DIGESTS
ORACLE["csv_ingest_quoted"] = CSV_INGEST_QUOTED
ORACLE["mart_schemas"] = _mart_schemas()

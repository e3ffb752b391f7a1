"""DuckDB SQL with the same results as the registered queries, on the driver's tables.

Written row by row from the business rules (walks over instruction lists, full recomputation of every
round), not from the histogram and semi-naive form the Spark code uses, so that agreement means
something.
"""

from __future__ import annotations

DAY = "CAST(year(l_shipdate)*10000 + month(l_shipdate)*100 + 1 AS INT)"

RAW = f"""
raw_psms AS (
  SELECT row_number() OVER (PARTITION BY year(l_shipdate), month(l_shipdate)
           ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS row_id,
    {DAY} AS SettlementDate,
    CASE WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN 'B' ELSE 's' END AS BuySellIndicator,
    CASE WHEN (l_orderkey*7 + l_linenumber*3 + l_suppkey) % 10 IN (0,1,2) THEN 'FDVP'
         WHEN (l_orderkey*7 + l_linenumber*3 + l_suppkey) % 10 IN (3,4) THEN 'OFOP'
         WHEN (l_orderkey*7 + l_linenumber*3 + l_suppkey) % 10 IN (5,8) THEN 'DVPT'
         WHEN (l_orderkey*7 + l_linenumber*3 + l_suppkey) % 10 = 6 THEN 'FOPT'
         WHEN (l_orderkey*7 + l_linenumber*3 + l_suppkey) % 10 = 7 THEN 'CDIS'
         ELSE 'DCSS' END AS TransactionType,
    CASE WHEN l_orderkey % 17 = 0 THEN 'SBLT' ELSE 'NORM' END AS TransferType,
    CAST(CASE l_suppkey WHEN 0 THEN 561 WHEN 1 THEN 635 WHEN 2 THEN 690
         ELSE 1000 + l_suppkey END AS INT) AS Sender,
    'S' || CAST(CAST(floor(l_partkey / 300.0) AS BIGINT) AS STRING) AS SGXSecurityCode,
    'I' || CAST(l_partkey AS STRING) AS ISIN,
    p_name || ' ' || p_brand AS SecurityDescription,
    CASE WHEN o_custkey % 12 = 0 THEN '' WHEN o_custkey % 3 = 1 THEN 'A' || CAST(o_custkey AS STRING)
         ELSE 'A' || CAST(o_custkey % 12 AS STRING) END
      AS CDPSafeKeepingAccount,
    l_quantity * 400 AS Quantity,
    CASE WHEN o_custkey % 11 = 0 THEN 'EUR' WHEN o_custkey % 4 = 0 THEN 'USD'
         WHEN o_custkey % 4 = 1 THEN 'THB' ELSE 'SGD' END AS SettlementCcy,
    l_extendedprice * 20 AS SettlementAmt,
    CASE WHEN l_orderkey % 23 = 0 THEN 'PENDING' ELSE 'SETTLED' END AS Status,
    CASE WHEN l_orderkey % 97 = 0 THEN ''
         ELSE 'R' || CAST(CAST(floor(l_orderkey / 50.0) AS BIGINT) AS STRING) END AS PSMSMatchedReference
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

RATES = f"""
quoted AS (
  SELECT DISTINCT {DAY} AS SettlementDate, c.Currency, CAST(c.Rate AS DOUBLE) AS Rate
  FROM lineitem CROSS JOIN (SELECT 'USD' AS Currency, 1.25 AS Rate UNION ALL SELECT 'HKD', 0.16) c
),
rates AS (
  SELECT * FROM quoted
  UNION ALL
  SELECT DISTINCT SettlementDate, 'THB', CAST(0.0415861 AS DOUBLE) FROM quoted q
  WHERE NOT EXISTS (SELECT 1 FROM quoted t WHERE t.SettlementDate = q.SettlementDate AND t.Currency = 'THB')
)"""

DIMS = f"""
prices AS (
  SELECT d.SettlementDate, 'I' || CAST(p_partkey AS STRING) AS ISIN, p_retailprice AS Price
  FROM part CROSS JOIN (SELECT DISTINCT {DAY} AS SettlementDate FROM lineitem) d
  WHERE p_partkey % 9 <> 0
),
agents AS (
  SELECT CAST(CASE s_suppkey WHEN 0 THEN 561 WHEN 1 THEN 635 WHEN 2 THEN 690
         ELSE 1000 + s_suppkey END AS INT) AS Sender, s_name AS DaName
  FROM supplier WHERE s_suppkey % 9 <> 8
),
accounts AS (
  SELECT 'A' || CAST(c_custkey AS STRING) AS CDPSafeKeepingAccount, c_name AS CDPAccountName,
         n_name AS Location
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 11 <> 0
)"""

PREP = """
classed AS (
  SELECT * REPLACE (upper(BuySellIndicator) AS BuySellIndicator),
    CASE WHEN TransactionType = 'DCSS' THEN 'DCSS' WHEN TransactionType IN ('FDVP','OFOP') THEN '1'
         ELSE '0' END AS subsequent
  FROM raw_psms WHERE Status = 'SETTLED'
),
prep AS (
  SELECT *,
    CASE WHEN subsequent <> 'DCSS' THEN SGXSecurityCode || '.' || CDPSafeKeepingAccount END AS Code_CDP,
    CASE WHEN subsequent <> 'DCSS' THEN subsequent || '.' || BuySellIndicator END AS SubsequentBuySell,
    CASE WHEN subsequent = 'DCSS' THEN '1' WHEN TransferType = 'SBLT' THEN 'SBLT'
         WHEN subsequent = '0' THEN '1' ELSE '0' END AS flag,
    'null' AS comments
  FROM classed
)"""


def match(p: str, a: str, b: str, need_a: bool) -> str:
    """CTEs ``{p}links(d, row_id, kind)``: rows of ``b`` linked against ``a``, both (d, k, side, q, row_id)."""
    rule = "coalesce(sa, 0) >= sb" + (" AND na > 0" if need_a else "")
    return f"""
{p}a AS ({a}),
{p}b AS ({b}),
{p}sums AS (
  SELECT d, k, side, sb, sa, coalesce(na, 0) AS na,
    ({rule.replace('na > 0', 'coalesce(na, 0) > 0')}) AS whole
  FROM (SELECT d, k, side, sum(q) AS sb FROM {p}b GROUP BY ALL) x
  LEFT JOIN (SELECT d, k, side, sum(q) AS sa, count(*) AS na FROM {p}a GROUP BY ALL) y USING (d, k, side)
),
{p}an AS (
  SELECT a.*, row_number() OVER (PARTITION BY d, k, side, q ORDER BY row_id) AS rn
  FROM {p}a a JOIN {p}sums s USING (d, k, side) WHERE NOT whole
),
{p}bn AS (
  SELECT b.*, row_number() OVER (PARTITION BY d, k, side, q ORDER BY row_id) AS rn
  FROM {p}b b JOIN {p}sums s USING (d, k, side) WHERE NOT whole AND na > 0
),
{p}pairs AS (SELECT b.d, b.row_id FROM {p}bn b JOIN {p}an a USING (d, k, side, q, rn)),
{p}rest AS (
  SELECT d, k, side, sum(q) AS t FROM {p}an a
  WHERE NOT EXISTS (SELECT 1 FROM {p}bn b WHERE b.d = a.d AND b.k = a.k AND b.side = a.side
                    AND b.q = a.q AND b.rn = a.rn)
  GROUP BY ALL
),
{p}todo AS (
  SELECT b.d, b.k, b.side, any_value(r.t) AS t,
    list({{'q': b.q, 'id': b.row_id, 't': CAST(0 AS DOUBLE), 'ids': CAST([] AS BIGINT[])}}
         ORDER BY b.q DESC, b.row_id) AS bs
  FROM {p}bn b JOIN {p}rest r USING (d, k, side)
  WHERE NOT EXISTS (SELECT 1 FROM {p}pairs x WHERE x.d = b.d AND x.row_id = b.row_id)
  GROUP BY ALL
),
{p}walk AS (
  SELECT d, unnest(list_reduce(
      list_prepend({{'q': CAST(0 AS DOUBLE), 'id': CAST(0 AS BIGINT), 't': t, 'ids': CAST([] AS BIGINT[])}}, bs),
      lambda acc, x: CASE WHEN acc.t >= x.q
        THEN {{'q': acc.q, 'id': acc.id, 't': acc.t - x.q, 'ids': list_append(acc.ids, x.id)}}
        ELSE acc END).ids) AS row_id
  FROM {p}todo
),
{p}links AS (
  SELECT b.d, b.row_id, 'T' AS kind FROM {p}b b JOIN {p}sums s USING (d, k, side) WHERE whole
  UNION ALL SELECT d, row_id, 'I' FROM {p}pairs
  UNION ALL SELECT d, row_id, 'I' FROM {p}walk
)"""


_FIRST_A = """
  SELECT SettlementDate AS d, Code_CDP AS k, CASE BuySellIndicator WHEN 'B' THEN 'S' ELSE 'B' END AS side,
    Quantity AS q, row_id
  FROM prep WHERE subsequent = '0' AND TransferType <> 'SBLT' AND CDPSafeKeepingAccount <> ''"""
_FIRST_B = """
  SELECT SettlementDate AS d, Code_CDP AS k, BuySellIndicator AS side, Quantity AS q, row_id
  FROM prep WHERE subsequent = '1' AND TransferType <> 'SBLT' AND CDPSafeKeepingAccount <> ''"""

FIRST = match("f", _FIRST_A, _FIRST_B, need_a=False)

# Subsequent rows outside market transfers after the first pass and reference matching.
REFERENCE = """
s0 AS (
  SELECT p.SettlementDate AS d, p.row_id, Code_CDP AS k, BuySellIndicator AS side, Quantity AS q,
    PSMSMatchedReference AS ref, CASE WHEN kind IS NULL THEN 0 ELSE 1 END AS f,
    CASE kind WHEN 'T' THEN 'Total amount linking' WHEN 'I' THEN 'Individual linking' ELSE 'NULL' END AS c
  FROM prep p LEFT JOIN flinks l ON l.d = p.SettlementDate AND l.row_id = p.row_id
  WHERE subsequent = '1' AND flag = '0'
),
s1 AS (
  SELECT * EXCLUDE (hit) REPLACE (
    CASE WHEN f = 0 AND hit THEN 1 ELSE f END AS f,
    CASE WHEN f = 0 AND hit THEN 'PSMS reference matching' ELSE c END AS c)
  FROM (SELECT s0.*, r.ref IS NOT NULL AS hit FROM s0
        LEFT JOIN (SELECT DISTINCT d, ref FROM s0 WHERE f = 1) r USING (d, ref))
)"""

_TURN_A = "SELECT d, k, CASE side WHEN 'B' THEN 'S' ELSE 'B' END AS side, q, row_id FROM st WHERE f = 1"
_TURN_B = "SELECT d, k, side, q, row_id FROM st WHERE f = 0"

TURN = f"""
st AS (
  SELECT 1 AS it, * FROM s1
  UNION ALL
  (WITH {match("t", _TURN_A, _TURN_B, need_a=True)},
   u AS (
     SELECT st.* REPLACE (it + 1 AS it, CASE WHEN kind IS NULL THEN f ELSE 1 END AS f,
       CASE kind WHEN 'T' THEN 'Total amount linking at Turnaround ' || (it + 1) || ' '
                 WHEN 'I' THEN 'Individual linking at Turnaround ' || (it + 1) || ' ' ELSE c END AS c)
     FROM st LEFT JOIN tlinks USING (d, row_id) WHERE d IN (SELECT d FROM tlinks)
   )
   SELECT it, u.d, row_id, k, side, q, u.ref,
     CASE WHEN f = 0 AND r.ref IS NOT NULL THEN 1 ELSE f END AS f,
     CASE WHEN f = 0 AND r.ref IS NOT NULL THEN 'PSMS reference matching at Turnaround ' || it || ' '
          ELSE c END AS c
   FROM u LEFT JOIN (SELECT DISTINCT d, ref FROM u WHERE f = 1) r USING (d, ref))
),
s2 AS (SELECT d, row_id, arg_max(f, it) AS f, arg_max(c, it) AS c FROM st GROUP BY d, row_id)"""


def _apply(state: str, flag: str = "f", why: str = "c") -> str:
    return f"""
verdict AS (
  SELECT p.* REPLACE (CASE WHEN s.{flag} = 1 THEN '1' ELSE p.flag END AS flag,
                      coalesce(s.{why}, p.comments) AS comments)
  FROM prep p LEFT JOIN {state} s ON s.d = p.SettlementDate AND s.row_id = p.row_id
)"""


ENRICHED = """
enriched AS (
  SELECT v.*, CAST(NULL AS STRING) AS NotReported, v.SettlementCcy AS Currency,
    CASE WHEN v.SettlementCcy = 'SGD' THEN CAST(1 AS DOUBLE) ELSE r.Rate END AS Rate,
    p.Price, a.DaName, s.CDPAccountName, s.Location
  FROM verdict v
  LEFT JOIN rates r ON r.SettlementDate = v.SettlementDate AND r.Currency = v.SettlementCcy
  LEFT JOIN prices p ON p.SettlementDate = v.SettlementDate AND p.ISIN = v.ISIN
  LEFT JOIN agents a ON a.Sender = v.Sender
  LEFT JOIN accounts s ON s.CDPSafeKeepingAccount = v.CDPSafeKeepingAccount
)"""

FEES = """
valued AS (
  SELECT *,
    CASE WHEN TransactionType = 'OFOP' THEN Price * Quantity ELSE SettlementAmt END
      AS SettlementValue_BaseCurrency,
    CASE WHEN TransactionType = 'OFOP' THEN Price * Quantity * Rate ELSE SettlementAmt * Rate END
      AS SettlementValue_SGD,
    least(ceil((Quantity * CAST(0.01 AS DOUBLE)) / 10) * 10, 100) AS tep
  FROM enriched
),
av AS (
  SELECT *, SettlementValue_SGD * CAST(0.00015 AS DOUBLE) AS adv FROM valued
),
charged AS (
  SELECT *, CAST(CASE
      WHEN TransactionType = 'CDIS' THEN CASE WHEN Sender IN (561, 635, 690) THEN 0.5 ELSE 0 END
      WHEN TransactionType = 'FOPT' THEN CASE WHEN CDPSafeKeepingAccount <> '' THEN 0.5 ELSE 0 END
      WHEN TransactionType = 'DVPT' THEN CASE WHEN CDPSafeKeepingAccount <> '' THEN 3.5 ELSE 2.5 END
      WHEN TransactionType = 'FDVP' AND flag = '1' THEN 33
      WHEN TransactionType = 'FDVP' AND flag = '0' THEN
        CASE WHEN adv IS NULL THEN NULL WHEN adv + 3 > 78 THEN adv + 3 ELSE 78 END
      WHEN TransactionType = 'OFOP' AND flag = '0' THEN
        CASE WHEN adv IS NULL THEN NULL WHEN adv > 75 THEN adv ELSE 75 END
      WHEN TransactionType = 'OFOP' AND BuySellIndicator = 'S' THEN tep
      WHEN TransactionType = 'DCSS' THEN 2
      ELSE 0 END AS DOUBLE) AS NewFee
  FROM av
),
output_daily AS (
  SELECT * REPLACE (
      CASE flag WHEN '1' THEN 'On-Exchange' WHEN '0' THEN 'Off-Exchange' ELSE flag END AS flag,
      CASE SubsequentBuySell WHEN '0.S' THEN 'Sell in First SI' WHEN '0.B' THEN 'Buy in First SI'
        WHEN '1.S' THEN 'Sell in Subseqent SI' WHEN '1.B' THEN 'Buy in Subseqent SI' END
        AS SubsequentBuySell),
    NewFee - OldFee AS FeeGain
  FROM (SELECT *, CAST(CASE WHEN TransactionType IN ('CDIS','FOPT','DVPT') THEN NewFee
      WHEN TransactionType = 'FDVP' THEN 33
      WHEN TransactionType = 'OFOP' AND BuySellIndicator = 'S' THEN tep
      WHEN TransactionType = 'DCSS' THEN 2 ELSE 0 END AS DOUBLE) AS OldFee FROM charged)
)"""

CHAIN = [RAW, RATES, DIMS, PREP, FIRST, REFERENCE, TURN, _apply("s2"), ENRICHED, FEES]


def over(select: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n" + select


def _micro(c: str) -> str:
    return f"CAST(sum(CAST(floor({c} * CAST(1e6 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS HUGEINT)) AS DOUBLE) / CAST(1e6 AS DOUBLE)"


M = f"""count(*) AS instructions, {_micro('SettlementValue_SGD')} AS settlement_value,
  {_micro('Quantity')} AS volume, {_micro('NewFee')} AS revenue, {_micro('FeeGain')} AS net_fee"""

DETAIL_COLUMNS = [
    "row_id", "SettlementDate", "BuySellIndicator", "TransactionType", "TransferType", "Sender",
    "SGXSecurityCode", "ISIN", "SecurityDescription", "CDPSafeKeepingAccount", "Quantity",
    "SettlementCcy", "SettlementAmt", "Status", "PSMSMatchedReference", "subsequent", "Code_CDP",
    "SubsequentBuySell", "flag", "comments", "NotReported", "Currency", "Rate", "Price", "DaName",
    "CDPAccountName", "Location", "SettlementValue_BaseCurrency", "SettlementValue_SGD", "NewFee",
    "OldFee", "FeeGain",
]
_OFF = [c for c in DETAIL_COLUMNS
        if c not in ("subsequent", "Code_CDP", "SubsequentBuySell", "comments", "Currency")]


def _kpi(keys: str = "", where: str = "true", extra: str = "") -> str:
    cols = "SettlementDate" + (", " + keys if keys else "")
    return over(f"SELECT {cols}{extra}, {M} FROM output_daily WHERE {where} GROUP BY {cols}", *CHAIN)


SEGMENTS = """
seg AS (
  SELECT 'First Settlement' AS segment, o.* FROM output_daily o WHERE subsequent = '0'
  UNION ALL SELECT 'Subsequent Settlement', o.* FROM output_daily o WHERE subsequent = '1'
  UNION ALL SELECT 'Trade Related', o.* FROM output_daily o WHERE subsequent = '1' AND flag = 'On-Exchange'
  UNION ALL SELECT 'Market Related', o.* FROM output_daily o WHERE subsequent = '1' AND flag = 'SBLT'
  UNION ALL SELECT 'Off-exchange', o.* FROM output_daily o WHERE subsequent = '1' AND flag = 'Off-Exchange'
)"""


def _top(dim: str, named: bool) -> str:
    """Top-20 rows (segment, dim, agent, ord, measures)."""
    keep = f"WHERE segment <> 'First Settlement' OR {dim} IS NOT NULL" if named else ""
    return f"""
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY segment
      ORDER BY settlement_value DESC NULLS LAST, {dim} NULLS LAST) AS INT) AS ord
    FROM (SELECT segment, {dim}, min(DaName) AS agent, {M} FROM seg {keep} GROUP BY segment, {dim}))
  WHERE ord <= 20"""


def _top_query(dim: str, named: bool) -> str:
    body = _top(dim, named)
    if dim == "DaName":
        body = body.replace("min(DaName) AS agent, ", "")
    return over(body, *CHAIN, SEGMENTS)


_MEAS = "instructions, settlement_value, volume, revenue, net_fee"


# The days and the range that the report jobs are run for.
JOB_DAYS = [19960301, 19970801]
JOB_RANGE = (19950601, 19970131)


def _summary(by: str, participants: bool, tops: bool, part: bool = False) -> str:
    """Long summary table; ``by`` is '' or 'SettlementDate, '; ``part``: over JOB_RANGE only."""
    group = by.rstrip(", ")
    grouped = f"GROUP BY {group}" if by else ""
    b, s, p = "Breakdown by Settlement type", "Breakdown by Transaction type", "Breakdown by Participants"

    def measures(cond: str) -> str:
        return ", ".join(
            [f"count(*) FILTER (WHERE {cond}) AS instructions"]
            + [_micro(c).replace(") AS DOUBLE) /", f") FILTER (WHERE {cond}) AS DOUBLE) /") + f" AS {n}"
               for c, n in (("SettlementValue_SGD", "settlement_value"), ("Quantity", "volume"),
                            ("NewFee", "revenue"), ("FeeGain", "net_fee"))])

    def total(sheet: str, section: str, ord_: int, label: str, cond: str) -> str:
        return (f"SELECT {by}'{sheet}' AS sheet, '{section}' AS section, {ord_} AS ord, '{label}' AS label1,"
                f" '' AS label2, {measures(cond)} FROM output_daily {grouped}")

    def section(sheet: str, name: str, keys: str, where: str, order: str, l1: str, l2: str, extra: str = "") -> str:
        part = f"PARTITION BY {group} " if by else ""
        return (f"SELECT {by}'{sheet}' AS sheet, '{name}' AS section, CAST(row_number() OVER ({part}ORDER BY {order})"
                f" AS INT) AS ord, {l1} AS label1, {l2} AS label2, {_MEAS} FROM (SELECT {by}{keys}{extra}, {M}"
                f" FROM output_daily WHERE {where} GROUP BY {by}{keys})")

    parts = [
        total(b, "totals", 1, "Total Settlements", "true"),
        total(b, "totals", 2, "First Settlement", "subsequent = '0'"),
        total(b, "totals", 3, "Subsequent Settlement", "subsequent = '1'"),
        total(b, "bonds", 1, "OTC Bonds Settlement", "subsequent = 'DCSS'"),
        total(b, "subsequent total", 1, "Total Subsequent Settlement", "subsequent = '1'"),
        total(s, "totals", 1, "Total Settlements", "true"),
        section(b, "verdicts", "flag", "subsequent = '1'", "flag",
                "CASE flag WHEN 'Off-Exchange' THEN '    Off-exchange' WHEN 'On-Exchange' THEN '    Trade-related'"
                " ELSE '    Market-related' END", "''"),
        section(b, "types", "TransactionType, flag", "TransactionType IN ('FDVP','OFOP')", "TransactionType, flag",
                "TransactionType", "CASE flag WHEN 'SBLT' THEN 'Market related' ELSE flag END"),
        section(s, "types", "subsequent, TransactionType", "true", "subsequent, TransactionType",
                "TransactionType", "''"),
    ]
    if participants:
        value = "settlement_value DESC NULLS LAST, Sender, DaName NULLS LAST"
        code = "CAST(Sender AS STRING)"
        parts += [
            total(p, "all total", 1, "Total", "true"),
            total(p, "client total", 1, "Total", "CDPSafeKeepingAccount <> ''"),
            total(p, "member total", 1, "Total", "CDPSafeKeepingAccount = ''"),
            section(p, "all", "Sender, DaName", "true", value, "DaName", code),
            section(p, "clients", "Sender", "CDPSafeKeepingAccount <> ''", value, "DaName", code,
                    ", min(DaName) AS DaName"),
            section(p, "members", "Sender, DaName", "CDPSafeKeepingAccount = ''", value, "DaName", code),
        ]
    ctes = list(CHAIN)
    if part:
        ctes.append("ranged AS (SELECT * FROM output_daily WHERE SettlementDate BETWEEN {} AND {})".format(*JOB_RANGE))
        parts = [x.replace("FROM output_daily", "FROM ranged") for x in parts]
    if tops:
        ctes.append(SEGMENTS.replace("FROM output_daily", "FROM ranged") if part else SEGMENTS)
        for sheet, dim, named, second in (
            ("Breakdown by Securities Type (Top 20)", "SecurityDescription", False, "''"),
            ("Breakdown by DA (Top 20)", "DaName", False, "''"),
            ("Breakdown by Securities Account (Top 20)", "CDPAccountName", True, "agent"),
            ("Breakdown by Geographical Split(Top 20)", "Location", True, "''"),
        ):
            parts.append(f"SELECT '{sheet}' AS sheet, segment AS section, ord, {dim} AS label1, {second} AS label2,"
                         f" {_MEAS} FROM ({_top(dim, named)})")
    return over("\nUNION ALL\n".join(f"({x})" for x in parts), *ctes)


_ROWS = "row_id, SettlementDate, flag, comments"
_UPTO = """
upto AS (
  SELECT d, row_id, 1 AS f,
    CASE kind WHEN 'T' THEN 'Total amount linking' ELSE 'Individual linking' END AS c
  FROM flinks WHERE {0}
)"""


def oracle() -> dict[str, str]:
    first = [RAW, PREP, FIRST]
    charged = [RAW, RATES, DIMS, PREP, FIRST, REFERENCE, TURN, _apply("s2"), ENRICHED, FEES]
    q: dict[str, str] = {}
    q["prep"] = over(
        "SELECT row_id, SettlementDate, BuySellIndicator, TransactionType, subsequent, Code_CDP,"
        " SubsequentBuySell, flag, comments FROM prep", RAW, PREP)
    q["latest_date"] = over(
        "SELECT SettlementDate, count(*) AS instructions FROM raw_psms WHERE Status = 'SETTLED' AND"
        " SettlementDate = (SELECT max(SettlementDate) FROM raw_psms WHERE Status = 'SETTLED'"
        " AND SettlementDate < 20010615) GROUP BY SettlementDate", RAW)
    q["fx_default"] = over("SELECT SettlementDate, Currency, Rate FROM rates", RATES)
    q["instruction_csv"] = over(
        "SELECT row_id, SettlementDate, BuySellIndicator, TransactionType, Sender, ISIN, CDPSafeKeepingAccount,"
        " Quantity, SettlementAmt, PSMSMatchedReference, TransferType FROM raw_psms", RAW)
    q["rate_files"] = over("SELECT SettlementDate, Currency, Rate FROM quoted", RATES)
    q["price_files"] = (
        f"SELECT DISTINCT {DAY} AS SettlementDate, 'S' || CAST(CAST(floor(p_partkey / 300.0) AS BIGINT) AS STRING)"
        " AS Code, p_name || ' ' || p_brand AS SecurityDescription, p_retailprice AS Price,"
        " 'I' || CAST(p_partkey AS STRING) AS ISIN FROM lineitem JOIN part ON l_partkey = p_partkey"
        " WHERE p_partkey % 9 <> 0")
    q["row_numbers"] = over(
        "SELECT SettlementDate, row_id, row_number() OVER (PARTITION BY SettlementDate ORDER BY"
        " TransactionType = 'DCSS', row_id) AS row_no FROM raw_psms WHERE Status = 'SETTLED'", RAW)
    q["load_once"] = over(
        "SELECT SettlementDate, count(*) AS instructions, CAST(sum(row_id) AS BIGINT) AS id_sum FROM raw_psms"
        " GROUP BY SettlementDate", RAW)
    q["replace_date"] = over("SELECT SettlementDate, Currency, CASE WHEN SettlementDate >= 20000101 THEN Rate * 2 ELSE Rate END AS Rate"
        " FROM rates", RATES)
    q["retention"] = over(
        "SELECT SettlementDate, count(*) AS instructions FROM raw_psms WHERE SettlementDate >= 20000331"
        " GROUP BY SettlementDate", RAW)
    q["quantity_totals"] = over(
        "SELECT SettlementDate, Code_CDP, SubsequentBuySell, sum(Quantity) AS TotalQuantity FROM prep"
        " WHERE subsequent <> 'DCSS' AND TransferType <> 'SBLT' AND CDPSafeKeepingAccount <> ''"
        " GROUP BY ALL", RAW, PREP)
    q["crosstab"] = over(
        "SELECT SettlementDate, Code_CDP, " + ", ".join(
            f"coalesce(sum(Quantity) FILTER (WHERE SubsequentBuySell = '{s}'), CAST(0 AS DOUBLE)) AS"
            f" q_{s.replace('.', '').lower()}" for s in ("0.B", "0.S", "1.B", "1.S"))
        + " FROM prep WHERE subsequent <> 'DCSS' AND TransferType <> 'SBLT' AND CDPSafeKeepingAccount <> ''"
          " GROUP BY SettlementDate, Code_CDP", RAW, PREP)
    q["total_link"] = over(f"SELECT {_ROWS} FROM verdict", *first, _UPTO.format("kind = 'T'"), _apply("upto"))
    q["individual_link"] = over(f"SELECT {_ROWS} FROM verdict", *first, _UPTO.format("true"), _apply("upto"))
    q["reference_match"] = over(f"SELECT {_ROWS} FROM verdict", *first, REFERENCE, _apply("s1"))
    q["turnaround"] = over(f"SELECT {_ROWS} FROM verdict", *first, REFERENCE, TURN, _apply("s2"))
    plain = "verdict AS (SELECT * FROM prep)"
    q["enrich"] = over(
        "SELECT row_id, SettlementDate, Currency, Rate, Price, DaName, CDPAccountName, Location FROM enriched",
        RAW, RATES, DIMS, PREP, plain, ENRICHED)
    q["valuation"] = over(
        "SELECT row_id, SettlementDate, SettlementValue_BaseCurrency, SettlementValue_SGD FROM valued",
        RAW, RATES, DIMS, PREP, plain, ENRICHED, FEES)
    for name, col in (("new_fee", "NewFee"), ("old_fee", "OldFee"), ("fee_gain", "FeeGain")):
        q[name] = over(f"SELECT row_id, SettlementDate, {col} FROM output_daily", *charged)
    q["detailed"] = over(f"SELECT {', '.join(DETAIL_COLUMNS)} FROM output_daily", *charged)
    q["off_exchange_detail"] = over(
        f"SELECT {', '.join(_OFF)} FROM output_daily WHERE subsequent = '1' AND flag = 'Off-Exchange'", *charged)
    texts = [c for c in DETAIL_COLUMNS if c not in (
        "row_id", "SettlementDate", "Sender", "Quantity", "SettlementAmt", "Rate", "Price", "NewFee", "OldFee", "FeeGain",
        "SettlementValue_BaseCurrency", "SettlementValue_SGD")]
    q["detail_csv"] = over("SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" if c in texts else c for c in DETAIL_COLUMNS)
                           + " FROM output_daily", *charged)
    last = ("(SELECT max(SettlementDate) FROM raw_psms WHERE Status = 'SETTLED' AND SettlementDate < 20010615)")
    q["load_job_facts"] = over(
        "SELECT row_id, SettlementDate, TransactionType, Sender, ISIN, Quantity, SettlementAmt, PSMSMatchedReference"
        f" FROM raw_psms WHERE Status = 'SETTLED' AND SettlementDate = {last}", RAW)
    q["load_job_rates"] = over(f"SELECT SettlementDate, Currency, Rate FROM rates WHERE SettlementDate = {last}", RAW, RATES)
    q["load_job_prices"] = over(f"SELECT SettlementDate, ISIN, Price FROM ({q['price_files']}) WHERE SettlementDate = {last}", RAW)
    q["detail_job"] = over(f"SELECT {', '.join(DETAIL_COLUMNS)} FROM output_daily WHERE SettlementDate IN"
                           f" ({', '.join(map(str, JOB_DAYS))})", *charged)
    q["weekly_report"] = _summary("", True, False, part=True)
    q["monthly_range"] = _summary("", False, True, part=True)
    q["split_groups"] = over(f"SELECT {_ROWS} FROM verdict", *first, REFERENCE, TURN, _apply("s2"))
    q["kpi_total"] = _kpi()
    q["kpi_first"] = _kpi(where="subsequent = '0'")
    q["kpi_subsequent"] = _kpi(where="subsequent = '1'")
    q["kpi_by_flag"] = _kpi("flag", "subsequent = '1'")
    q["kpi_otc_bonds"] = _kpi(where="subsequent = 'DCSS'")
    q["kpi_by_type_flag"] = _kpi("TransactionType, flag", "TransactionType IN ('FDVP','OFOP')")
    q["kpi_by_subsequent_type"] = _kpi("subsequent, TransactionType")
    q["kpi_by_participant"] = _kpi("Sender, DaName")
    q["kpi_by_client"] = _kpi("Sender", "CDPSafeKeepingAccount <> ''", ", min(DaName) AS DaName")
    q["kpi_client_total"] = _kpi(where="CDPSafeKeepingAccount <> ''")
    q["kpi_by_member"] = _kpi("Sender, DaName", "CDPSafeKeepingAccount = ''")
    q["kpi_member_total"] = _kpi(where="CDPSafeKeepingAccount = ''")
    q["top20_security"] = _top_query("SecurityDescription", False).replace("min(DaName) AS agent, ", "")
    q["top20_agent"] = _top_query("DaName", False)
    q["top20_account"] = _top_query("CDPAccountName", True)
    q["top20_location"] = _top_query("Location", True).replace("min(DaName) AS agent, ", "")
    q["daily_summary"] = _summary("SettlementDate, ", True, False)
    q["weekly_summary"] = _summary("", True, False)
    q["monthly_summary"] = _summary("", False, True)
    return q

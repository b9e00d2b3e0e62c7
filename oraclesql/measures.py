"""Oracle SQL for the BI measures (DuckDB)."""

from oraclesql.ar import AR_AGING_PROD_CTE, AS_OF
from oraclesql.entities import with_entities


def _src(table, office_col, by):
    """A source with its grouping keys attached."""
    if by == "RegionID":
        return (f"(SELECT s.*, o.regionID AS RegionID FROM {table} s "
                f"LEFT JOIN office o ON s.{office_col} = o.officeID)")
    if by == "OfficeID":
        return f"(SELECT s.*, s.{office_col} AS OfficeID_k FROM {table} s)"
    return f"(SELECT s.* FROM {table} s)"


def _key(by):
    return {"RegionID": "RegionID", "OfficeID": "OfficeID_k", None: None}[by]


def _div(a, b):
    return f"(CASE WHEN ({b}) IS NULL OR ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


def measures_sql(by=None):
    k = _key(by)
    sel_k = f"{k} AS gk, " if k else ""
    grp = f" GROUP BY {k}" if k else ""

    def maxjoin(alias, col):
        # date bounds are computed once per group as DATE values
        bounds = (f"{alias}, CAST({alias} - INTERVAL 30 DAY AS DATE) AS lo30, "
                  f"CAST({alias} - INTERVAL 1 MONTH AS DATE) AS hi_prev, "
                  f"CAST(CAST({alias} - INTERVAL 1 MONTH AS DATE) - INTERVAL 30 DAY AS DATE) AS lo30_prev, "
                  f"CAST({alias} - INTERVAL 90 DAY AS DATE) AS lo90")
        if k:
            return (f" LEFT JOIN (SELECT mk, {bounds} FROM (SELECT {k} AS mk, MAX({col}) AS {alias} FROM {{src}} "
                    f"GROUP BY {k})) mx ON x.{k} = mx.mk")
        return f" CROSS JOIN (SELECT {bounds} FROM (SELECT MAX({col}) AS {alias} FROM {{src}})) mx"

    aging = _src("ar_aging_prod", "OfficeID", by)
    a = f"""SELECT {sel_k}SUM(BalanceAmount) AS total_ar,
      SUM(CASE WHEN AgeBucket = '0-30 Days' THEN BalanceAmount END) AS ar_0_30,
      SUM(CASE WHEN AgeBucket = '31-60 Days' THEN BalanceAmount END) AS ar_31_60,
      SUM(CASE WHEN AgeBucket = '61-90 Days' THEN BalanceAmount END) AS ar_61_90,
      SUM(CASE WHEN AgeBucket = 'Over 90 Days' THEN BalanceAmount END) AS ar_over_90,
      COUNT(DISTINCT CASE WHEN BalanceAmount > 0 THEN CustomerID END) AS active_customers,
      COUNT(DISTINCT CASE WHEN AgeBucket = 'Over 90 Days' AND BalanceAmount > 1000 THEN CustomerID END) AS high_risk_customers
    FROM {aging} x WHERE IsCurrent{grp}"""
    tsrc = _src("ticket", "officeID", by)
    t = f"""SELECT {sel_k}SUM(total) AS invoiced,
      CASE WHEN COUNT(total) > 0 THEN CAST(SUM(total) AS DOUBLE) / COUNT(total) END AS avg_invoice,
      SUM(CASE WHEN completedOn > lo30 AND completedOn <= tmax THEN total END) AS rev30,
      SUM(CASE WHEN date_trunc('month', completedOn) = date_trunc('month', tmax) THEN total END) AS rev_cur_month,
      SUM(CASE WHEN date_trunc('month', completedOn) = date_trunc('month', tmax) - INTERVAL 1 MONTH THEN total END) AS rev_prev_month
    FROM {tsrc} x{maxjoin('tmax', 'completedOn').format(src=tsrc)}{grp}"""
    # rev30_prev lives in its own CTE: DuckDB 2.0.0 mis-evaluated it when it
    # shared one SELECT with the other eight ticket aggregates.
    tp = f"""SELECT {sel_k}SUM(CASE WHEN completedOn > lo30_prev AND completedOn <= hi_prev THEN total END) AS rev30_prev
    FROM {tsrc} x{maxjoin('tmax', 'completedOn').format(src=tsrc)}{grp}"""
    psrc = _src("payment", "officeID", by)
    p = f"""SELECT {sel_k}SUM(amount) AS payments,
      SUM(CASE WHEN writeoff = TRUE THEN amount END) AS writeoffs,
      SUM(CASE WHEN paymentDate > lo90 AND paymentDate <= pmax THEN amount END) AS pay90
    FROM {psrc} x{maxjoin('pmax', 'paymentDate').format(src=psrc)}{grp}"""
    ap = f"SELECT {sel_k}SUM(appliedAmount) AS collected FROM {_src('applied_payment', 'officeID', by)} x{grp}"
    v = f"""SELECT {sel_k}CASE WHEN COUNT(DaysToPay) > 0 THEN CAST(SUM(DaysToPay) AS DOUBLE) / COUNT(DaysToPay) END AS avg_days_to_pay,
      COUNT(CASE WHEN DaysToPay <= 30 THEN 1 END) AS on_time, COUNT(*) AS velocity_rows
    FROM {_src('velocity', 'OfficeID', by)} x{grp}"""
    velocity = """SELECT ap.officeID AS OfficeID, date_diff('day', t.completedOn, p.paymentDate) AS DaysToPay
    FROM applied_payment ap JOIN ticket t ON ap.ticketID = t.ticketID JOIN payment p ON ap.paymentID = p.paymentID
    WHERE t.status = 'Completed' AND p.paymentDate IS NOT NULL"""
    apsrc = _src("applied_payment", "officeID", by)
    gk = k or "0"
    # the balance on a day: what is open now, less what was invoiced and plus what was paid after that day
    changes = f"""SELECT gk, day, SUM(amount) AS amount FROM (
        SELECT {gk} AS gk, completedOn AS day, total AS amount FROM {tsrc} x WHERE status = 'Completed' AND completedOn <= {AS_OF}
        UNION ALL SELECT {gk}, dateApplied, -appliedAmount FROM {apsrc} x WHERE dateApplied <= {AS_OF}) GROUP BY gk, day"""
    anchors = f"""SELECT {gk} AS gk, MAX(completedOn) AS anchor, CAST(MAX(completedOn) - INTERVAL 1 MONTH AS DATE) AS month_ago
        FROM {tsrc} x WHERE status = 'Completed' AND completedOn <= {AS_OF} GROUP BY ALL"""
    open_now = f"SELECT {gk} AS gk, SUM(BalanceAmount) AS amount FROM {aging} x WHERE IsCurrent GROUP BY ALL"
    balances = """SELECT a.gk, a.anchor, a.month_ago, s.day, COALESCE(ANY_VALUE(o.amount), 0) - COALESCE(SUM(c.amount), 0) AS balance
        FROM anchors a JOIN (SELECT gk, CAST(unnest(range(anchor - 70, anchor + 1, INTERVAL 1 DAY)) AS DATE) AS day FROM anchors) s ON s.gk = a.gk
        LEFT JOIN open_now o ON o.gk = a.gk LEFT JOIN changes c ON c.gk = a.gk AND c.day > s.day GROUP BY ALL"""
    sr = f"""SELECT {'gk, ' if k else ''}SUM(balance) FILTER (day > anchor - 30) AS ar_days,
        SUM(balance) FILTER (day > month_ago - 30 AND day <= month_ago) AS ar_days_prev,
        SUM(balance) FILTER (day = month_ago) AS ar_month_ago FROM balances {'GROUP BY gk' if k else ''}"""
    month = "date_trunc('month', {d}) = date_trunc('month', a.anchor)"
    ti = f"""SELECT {'x.' + k + ' AS gk, ' if k else ''}SUM(x.total) AS month_invoiced FROM {tsrc} x JOIN anchors a ON a.gk = {'x.' + k if k else 0}
        WHERE {month.format(d='x.completedOn')} {'GROUP BY x.' + k if k else ''}"""
    pi = f"""SELECT {'x.' + k + ' AS gk, ' if k else ''}SUM(x.amount) AS month_collections FROM {psrc} x JOIN anchors a ON a.gk = {'x.' + k if k else 0}
        WHERE {month.format(d='x.paymentDate')} {'GROUP BY x.' + k if k else ''}"""
    if by:
        keys = "SELECT DISTINCT officeID AS gk FROM office" if by == "OfficeID" else \
            "SELECT DISTINCT regionID AS gk FROM office"
        body = (f"SELECT k.gk AS {by}, a_.* EXCLUDE (gk), t_.* EXCLUDE (gk), p_.* EXCLUDE (gk), ap_.* EXCLUDE (gk), "
                f"v_.* EXCLUDE (gk), tp_.* EXCLUDE (gk), sr_.* EXCLUDE (gk), ti_.* EXCLUDE (gk), pi_.* EXCLUDE (gk) FROM ({keys}) k LEFT JOIN a_ ON k.gk = a_.gk LEFT JOIN t_ ON k.gk = t_.gk "
                "LEFT JOIN tp_ ON k.gk = tp_.gk "
                "LEFT JOIN p_ ON k.gk = p_.gk LEFT JOIN ap_ ON k.gk = ap_.gk LEFT JOIN v_ ON k.gk = v_.gk "
                "LEFT JOIN sr_ ON k.gk = sr_.gk LEFT JOIN ti_ ON k.gk = ti_.gk LEFT JOIN pi_ ON k.gk = pi_.gk")
    else:
        body = "SELECT * FROM a_ CROSS JOIN t_ CROSS JOIN tp_ CROSS JOIN p_ CROSS JOIN ap_ CROSS JOIN v_ CROSS JOIN sr_ CROSS JOIN ti_ CROSS JOIN pi_"
    dso = _div("(CAST(ar_days AS DOUBLE) / 30.0)", "CAST(rev30 AS DOUBLE) / 30.0")
    dso_prev = _div("(CAST(ar_days_prev AS DOUBLE) / 30.0)", "CAST(rev30_prev AS DOUBLE) / 30.0")
    projected = f"(CAST(ar_0_30 AS DOUBLE) * {_div('pay90', 'ar_0_30')})"
    key_sel = f"{by}, " if by else ""
    final = f"""SELECT {key_sel}CAST(total_ar AS DOUBLE) AS m_total_ar, CAST(ar_0_30 AS DOUBLE) AS m_ar_0_30,
      CAST(ar_31_60 AS DOUBLE) AS m_ar_31_60, CAST(ar_61_90 AS DOUBLE) AS m_ar_61_90, CAST(ar_over_90 AS DOUBLE) AS m_ar_over_90,
      {_div('ar_over_90', 'total_ar')} AS m_ar_over_90_pct, {dso} AS m_dso, ({dso} - {dso_prev}) AS m_dso_trend,
      ({_div('month_collections', 'ar_month_ago + COALESCE(month_invoiced, 0) - COALESCE(ar_0_30, 0)')} * 100.0) AS m_cei,
      ({_div('payments', 'invoiced')} * 100.0) AS m_collections_rate,
      CAST(invoiced AS DOUBLE) AS m_total_invoiced, CAST(collected AS DOUBLE) AS m_total_collected,
      CAST(invoiced - collected AS DOUBLE) AS m_collection_gap, avg_invoice AS m_avg_invoice,
      active_customers AS m_active_ar_customers, high_risk_customers AS m_high_risk_customers,
      {_div('total_ar', 'active_customers')} AS m_avg_customer_balance, avg_days_to_pay AS m_avg_days_to_pay,
      ({_div('on_time', 'velocity_rows')} * 100.0) AS m_on_time_rate, CAST(writeoffs AS DOUBLE) AS m_total_writeoffs,
      ({_div('writeoffs', 'invoiced')} * 100.0) AS m_writeoff_rate,
      ({_div('(CAST(total_ar AS DOUBLE) - CAST(ar_month_ago AS DOUBLE))', 'ar_month_ago')} * 100.0) AS m_ar_mom_growth,
      ({_div('CAST(rev_cur_month AS DOUBLE) - CAST(COALESCE(rev_prev_month, 0) AS DOUBLE)', 'rev_prev_month')} * 100.0) AS m_revenue_mom_growth,
      {projected} AS m_projected_collections_30d,
      ({projected} - CAST(COALESCE(writeoffs, 0) AS DOUBLE)) AS m_cash_flow_forecast
    FROM g"""
    return final, {"ar_aging_prod": AR_AGING_PROD_CTE, "velocity": velocity, "a_": a, "t_": t, "tp_": tp, "p_": p,
                   "ap_": ap, "v_": v, "changes": changes, "anchors": anchors, "open_now": open_now, "balances": balances,
                   "sr_": sr, "ti_": ti, "pi_": pi, "g": body}


Q: dict[str, str] = {}
_f, _c = measures_sql("OfficeID")
Q["measures_by_office"] = with_entities(_f, _c)
_f, _c = measures_sql(None)
Q["measures_company"] = with_entities(_f, _c)
_f, _c = measures_sql("OfficeID")
Q["m_ar_by_office"] = with_entities("SELECT OfficeID, m_total_ar AS m_ar_by_office FROM mres",
                                    {**_c, "mres": _f})
_f, _c = measures_sql("RegionID")
Q["m_dso_by_region"] = with_entities("SELECT RegionID, m_dso AS m_dso_by_region FROM mres", {**_c, "mres": _f})

Q["ar_daily_balance"] = with_entities(f"""
SELECT d.OfficeID, d.Day, CAST(d.Invoiced AS DOUBLE) AS Invoiced, CAST(d.Applied AS DOUBLE) AS Applied,
       CAST(COALESCE(ANY_VALUE(o.amount), 0) - SUM(x.change) AS DOUBLE) AS OpeningAR,
       CAST(COALESCE(ANY_VALUE(o.amount), 0) - COALESCE(SUM(x.change) FILTER (x.Day > d.Day), 0) AS DOUBLE) AS EndingAR
FROM days d JOIN days x ON x.OfficeID = d.OfficeID
LEFT JOIN (SELECT OfficeID, SUM(BalanceAmount) AS amount FROM ar_aging_prod GROUP BY OfficeID) o ON o.OfficeID = d.OfficeID
GROUP BY d.OfficeID, d.Day, d.Invoiced, d.Applied""", {"ar_aging_prod": AR_AGING_PROD_CTE, "days": f"""
SELECT OfficeID, Day, SUM(Invoiced) AS Invoiced, SUM(Applied) AS Applied, COALESCE(SUM(Invoiced), 0) - COALESCE(SUM(Applied), 0) AS change
FROM (SELECT officeID AS OfficeID, completedOn AS Day, total AS Invoiced, NULL AS Applied FROM ticket WHERE status = 'Completed' AND completedOn <= {AS_OF}
      UNION ALL SELECT officeID, dateApplied, NULL, appliedAmount FROM applied_payment WHERE dateApplied <= {AS_OF}) GROUP BY ALL"""})

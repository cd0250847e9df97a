"""Measures, drill paths, row security, budget alerts, governance and data health."""

from __future__ import annotations

from .base import NOW, day, m, price, r, ts

_STAR = """fact f LEFT JOIN dim_date d ON f.dateKey = d.dateKey LEFT JOIN dim_subscription s ON f.subscriptionKey = s.subscriptionKey
  LEFT JOIN dim_resource r ON f.resourceKey = r.resourceKey"""
_COST = "CAST(sum(f.actualCost) AS DOUBLE)"
_ALERT = """
  , alert AS (
    SELECT 'budget-' || t.subscriptionId || '-' || printf('%04d-%02d', (t.idx - 1) // 12, (t.idx - 1) % 12 + 1) AS budgetName,
      '90' AS threshold, CAST(t.cost AS DOUBLE) AS spend, CAST(b.budgetAmount AS DOUBLE) AS budget, t.subscriptionId, t.subscriptionName,
      printf('%04d-%02d', (t.idx - 1) // 12, (t.idx - 1) % 12 + 1) || '-01T00:00:00' AS timeGenerated
    FROM month_total t JOIN budget b ON t.subscriptionId = b.subscriptionId AND t.idx = b.idx),
  classified AS (
    SELECT *, CASE WHEN spend > budget * 0.9::DOUBLE THEN 'High' WHEN spend > budget * 0.75::DOUBLE THEN 'Medium' ELSE 'Low' END AS severity,
      spend * 100 / budget AS used,
      CASE WHEN spend > budget THEN 'IMMEDIATE ACTION REQUIRED: Budget exceeded!'
           WHEN spend > budget * 0.9::DOUBLE THEN 'URGENT: Budget at 90%+ utilization'
           WHEN spend > budget * 0.75::DOUBLE THEN 'WARNING: Budget at 75%+ utilization'
           ELSE 'INFO: Budget threshold reached' END AS actionRequired FROM alert)"""


def _text(expr: str) -> str:
    return f"regexp_replace(CAST(CAST({expr} AS DECIMAL(28,6)) AS VARCHAR), '\\.?0+$', '')"


_MESSAGE = f"""'🚨 Budget Alert: ' || budgetName || chr(10) || chr(10) || 'Subscription: ' || subscriptionName || chr(10) ||
  'Current Spend: $' || {_text('spend')} || chr(10) || 'Budget Amount: $' || {_text('budget')} || chr(10) ||
  'Threshold: ' || threshold || '%' || chr(10) || 'Time: ' || timeGenerated || chr(10) || chr(10) ||
  'Budget utilization: ' || {_text('used')} || '%'"""
_ACTIONS = ("<br><br><h3>Recommended Actions:</h3><ul><li>Review recent cost changes in the Azure portal</li>"
            "<li>Check for new or modified resources</li><li>Consider implementing cost controls</li>"
            "<li>Review reserved instances and savings plans</li></ul><br><p><a href=\"https://portal.azure.com/"
            "#view/Microsoft_Azure_CostManagement/Menu/~/overview/subscription/")


def _growth(cur: str, prev: str, name: str, scale: int = 100) -> str:
    return r(f"(CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) / nullif(CAST({prev} AS DOUBLE), 0) * {scale}", name)


def _rollup(path: list[tuple[str, str]], present: list[str]) -> str:
    level = " + ".join(f"(1 - grouping({expr}))" for expr, _ in path)
    names = ", ".join(present)
    return f"""SELECT {names}, CAST({level} AS INTEGER) AS "level", {m('sum(f.actualCost)', 'totalCost')}
      FROM {_STAR} GROUP BY ROLLUP ({', '.join(expr for expr, _ in path)})"""


def _resources(condition: str, name: str) -> str:
    return f'count(DISTINCT CASE WHEN {condition} THEN u.resourceKey END) AS "{name}"'


_UTIL = """(SELECT * FROM util WHERE resourceKey IS NOT NULL) u JOIN dim_date d ON u.dateKey = d.dateKey
  LEFT JOIN dim_resource r ON u.resourceKey = r.resourceKey"""
_TAGS = [("Environment", "env"), ("Application", "app"), ("Team", "team"), ("CostCenter", "costCenter"),
         ("BusinessUnit", "businessUnit"), ("Project", "NULL"), ("Service", "NULL"), ("Compliance", "NULL"),
         ("DataSensitivity", "NULL")]


def _compliance(tags: list[tuple[str, str]]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT businessUnit, '{tag}' AS tagName, CAST({column} AS VARCHAR) AS v FROM dim_resource WHERE isCurrent"
        for tag, column in tags)
    return f"""SELECT businessUnit, tagName, count(*) AS resources, count(*) FILTER (v IS NULL) AS missing,
      {r('count(v) * 100.0::DOUBLE / count(*)', 'compliancePercentage')} FROM ({rows}) GROUP BY businessUnit, tagName"""


QUERIES = {
    "measure_cost": f"""
      SELECT d.yearMonth, s.subscriptionName, {m('sum(f.actualCost)', 'Total Actual Cost')}, {m('sum(f.amortizedCost)', 'Total Amortized Cost')},
        {m('sum(f.actualCost)', 'Total Cost USD')}, {m('sum(f.usageQuantity)', 'Total Usage Quantity')},
        {price('f.effectivePrice', 'Average Effective Price')},
        {r(f'{_COST} / count(DISTINCT f.resourceKey)', 'Cost per Resource')} FROM {_STAR} GROUP BY ALL""",
    "measure_mom": f"""
      SELECT printf('%04d-%02d', (c.idx - 1) // 12, (c.idx - 1) % 12 + 1) AS yearMonth, c.subscriptionName,
        {m('c.cost', 'Total Actual Cost')}, {m('p.cost', 'Previous Month Cost')}, {_growth('c.cost', 'p.cost', 'Month over Month %')}
      FROM month_total c LEFT JOIN month_total p ON p.subscriptionId = c.subscriptionId AND p.idx + 1 = c.idx""",
    "measure_mom_daily": f"""
      , daily AS (SELECT d."date", s.subscriptionName, sum(f.actualCost) AS cost FROM {_STAR} GROUP BY ALL)
      SELECT {day('c."date"', 'date')}, c.subscriptionName, {m('c.cost', 'Total Actual Cost')}, {m('p.cost', 'Previous Month Cost')}
      FROM daily c LEFT JOIN daily p ON p.subscriptionName = c.subscriptionName AND p."date" = CAST(c."date" - INTERVAL 1 MONTH AS DATE)""",
    "measure_mom_ratio": f"""
      , monthly AS (SELECT d."year" * 12 + d."month" AS idx, r.businessUnit, sum(f.actualCost) AS cost FROM {_STAR} GROUP BY ALL),
      cur AS (SELECT (idx - 1) // 12 AS y, businessUnit, sum(cost) AS cost FROM monthly GROUP BY ALL),
      prev AS (SELECT idx // 12 AS y, businessUnit, sum(cost) AS cost FROM monthly GROUP BY ALL)
      SELECT c.y AS "year", c.businessUnit, {_growth('c.cost', 'p.cost', 'Month over Month %', 1)}
      FROM cur c LEFT JOIN prev p ON c.y = p.y AND c.businessUnit = p.businessUnit""",
    "measure_yoy": f"""
      , q AS (SELECT d."year" AS y, d."quarter" AS q, r.businessUnit, sum(f.actualCost) AS cost FROM {_STAR} GROUP BY ALL)
      SELECT c.y || '-Q' || c.q AS yearQuarter, c.businessUnit, {m('c.cost', 'Total Actual Cost')}, {m('p.cost', 'Previous Year Cost')},
        {_growth('c.cost', 'p.cost', 'Year over Year %')}
      FROM q c LEFT JOIN q p ON p.y + 1 = c.y AND p.q = c.q AND p.businessUnit = c.businessUnit""",
    "measure_budget": f"""
      SELECT d.yearMonth, s.subscriptionName, 10000.0::DOUBLE AS "Budget Amount", {r(f'10000 - {_COST}', 'Budget Remaining')},
        {r(f'(10000 - {_COST}) / 10000', 'Budget Remaining %')}, {r(f'{_COST} / 10000 * 100', 'Budget Utilization %')}
      FROM {_STAR} GROUP BY ALL""",
    "measure_eom": f"""
      SELECT d.yearMonth, s.subscriptionName, {r(f'{_COST} / 1 * (31 - 31)', 'Projected EOM Spend')} FROM {_STAR} GROUP BY ALL""",
    "measure_eom_corrected": f"""
      SELECT d.yearMonth, s.subscriptionName, {r(f'{_COST} / max(d."day") * 31', 'Projected EOM Spend')} FROM {_STAR} GROUP BY ALL""",
    "measure_coverage": f"""
      SELECT d.yearMonth, r.businessUnit, {m('sum(f.actualCost) FILTER (f.isReservationCharge)', 'Reservation Cost')},
        {m('sum(f.actualCost) FILTER (f.isSavingsPlanCharge)', 'Savings Plan Cost')},
        {r(f'CAST(sum(f.actualCost) FILTER (f.isReservationCharge) AS DOUBLE) / {_COST} * 100', 'Reservation Coverage %')},
        {r(f'CAST(sum(f.actualCost) FILTER (f.isSavingsPlanCharge) AS DOUBLE) / {_COST} * 100', 'Savings Plan Coverage %')}
      FROM {_STAR} GROUP BY ALL""",
    "measure_zscore": f"""
      , daily AS (SELECT d.yearMonth, d."date", s.subscriptionName, sum(f.actualCost) AS cost FROM {_STAR} GROUP BY ALL)
      SELECT yearMonth, subscriptionName, {m('sum(cost)', 'Total Actual Cost')},
        {r('(CAST(sum(cost) AS DOUBLE) - avg(CAST(cost AS DOUBLE))) / nullif(stddev_pop(CAST(cost AS DOUBLE)), 0)', 'Daily Z-Score')}
      FROM daily GROUP BY ALL""",
    "measure_utilization": f"""
      SELECT r.businessUnit, d.yearMonth, {r('avg(u.avgCpuPercentage)', 'Average CPU %')}, {r('avg(u.avgMemoryPercentage)', 'Average Memory %')},
        {r('avg(CAST(u.idlePercentage AS DOUBLE))', 'Average Idle %')},
        {_resources('coalesce(u.avgCpuPercentage, 0) < 0.2', 'Underutilized Resources')},
        {_resources('u.avgCpuPercentage > 0.8', 'Overutilized Resources')},
        {_resources('u.avgCpuPercentage BETWEEN 0.2 AND 0.8', 'Optimal Resources')} FROM {_UTIL} GROUP BY ALL""",
    "measure_utilization_percent_limits": f"""
      SELECT r.team, {_resources('coalesce(u.avgCpuPercentage, 0) < 20', 'Underutilized Resources')},
        {_resources('u.avgCpuPercentage > 80', 'Overutilized Resources')},
        {_resources('u.avgCpuPercentage BETWEEN 20 AND 80', 'Optimal Resources')} FROM {_UTIL} GROUP BY ALL""",
    "measure_savings": f"""
      SELECT r.businessUnit, r.team, {m('sum(potentialMonthlySavings)', 'Total Potential Monthly Savings')},
        {m('sum(potentialAnnualSavings)', 'Total Potential Annual Savings')}, {m('sum(realizedMonthlySavings)', 'Total Realized Monthly Savings')},
        {m('sum(realizedAnnualSavings)', 'Total Realized Annual Savings')},
        {r('CAST(sum(realizedMonthlySavings) AS DOUBLE) / nullif(CAST(sum(potentialMonthlySavings) AS DOUBLE), 0) * 100', 'Implementation Rate %')},
        count(*) FILTER (status = 'Pending') AS "Pending Opportunities", count(*) FILTER (priority = 'High') AS "High Priority Opportunities",
        count(*) FILTER (status = 'Completed') AS "Completed Opportunities"
      FROM savings so LEFT JOIN dim_resource r ON so.resourceKey = r.resourceKey GROUP BY r.businessUnit, r.team""",
    "measure_anomalies": f"""
      SELECT s.subscriptionName, count(*) FILTER (isAnomaly) AS "Total Anomalies",
        count(*) FILTER (isAnomaly AND severity = 'High') AS "High Severity Anomalies",
        count(*) FILTER (isAnomaly AND severity = 'Medium') AS "Medium Severity Anomalies",
        count(*) FILTER (isAnomaly AND severity = 'Low') AS "Low Severity Anomalies",
        {r('sum(costVariance)', 'Total Cost Variance')}, {r('avg(variancePercentage)', 'Average Variance %')}, {r('max(zScore)', 'Max Z-Score')}
      FROM anomaly_fact a LEFT JOIN dim_subscription s ON a.subscriptionKey = s.subscriptionKey GROUP BY s.subscriptionName""",
    "drill_date_rollup": _rollup(
        [('d."year"', ""), ('d."quarter"', ""), ('d."month"', ""), ('d."date"', "")],
        ['d."year"', 'd."quarter"', 'd."month"', day('d."date"', "date")]),
    "drill_resource_rollup": _rollup(
        [("r.businessUnit", ""), ("r.team", ""), ("r.app", ""), ("r.resourceName", "")],
        ["r.businessUnit", "r.team", "r.app", "r.resourceName"]),
    "rls_resource": f"""
      SELECT r.team, d.yearMonth, {m('sum(f.actualCost)', 'Total Actual Cost')}, {r(f'{_COST} / count(DISTINCT f.resourceKey)', 'Cost per Resource')}
      FROM {_STAR} WHERE r.businessUnit = 'ASIA' OR r.team = 'ASIA' GROUP BY ALL""",
    "rls_subscription": f"""
      SELECT s.subscriptionName, d.yearMonth, {m('sum(f.actualCost)', 'Total Actual Cost')}, {r(f'{_COST} / count(DISTINCT f.resourceKey)', 'Cost per Resource')}
      FROM {_STAR} WHERE s.subscriptionName IN ('NATION_1', 'NATION_7') GROUP BY ALL""",
    "rls_combined": f"""
      SELECT s.subscriptionName, r.team, {m('sum(f.actualCost)', 'Total Actual Cost')}, {r(f'{_COST} / count(DISTINCT f.resourceKey)', 'Cost per Resource')}
      FROM {_STAR} WHERE s.subscriptionName IN ('NATION_2', 'NATION_7') AND (r.businessUnit = 'NATION_2' OR r.team = 'NATION_2') GROUP BY ALL""",
    "budget_alerts": f"""{_ALERT}
      SELECT budgetName, threshold, ROUND(spend, 6) AS currentSpend, ROUND(budget, 6) AS budgetAmount, subscriptionId, subscriptionName,
        timeGenerated, severity, {r('used', 'utilizationPercentage')}, actionRequired,
        CASE severity WHEN 'High' THEN 'Attention' WHEN 'Medium' THEN 'Warning' ELSE 'Good' END AS cardColor,
        CASE severity WHEN 'High' THEN 'High' ELSE 'Normal' END AS importance,
        CASE severity WHEN 'High' THEN 'Bug' ELSE 'Task' END AS ticketType,
        CASE severity WHEN 'High' THEN '1' WHEN 'Medium' THEN '2' ELSE '3' END AS ticketPriority FROM classified""",
    "budget_alert_texts": f"""{_ALERT}
      SELECT budgetName, {_MESSAGE} AS alertMessage,
        '[' || severity || '] Budget Alert: ' || budgetName || ' - ' || subscriptionName AS mailSubject,
        'Budget Alert: ' || budgetName || ' - ' || subscriptionName AS ticketTitle,
        '<h2>' || actionRequired || '</h2><br><br>' || replace({_MESSAGE}, chr(10), '<br>') || '{_ACTIONS}' || subscriptionId ||
        '">View Cost Analysis Dashboard</a></p>' AS mailBody FROM classified""",
    "budget_alert_log": f"""{_ALERT}
      SELECT '2001-08-01T00:00:00' AS "timestamp", budgetName, subscriptionId, subscriptionName, ROUND(spend, 6) AS currentSpend,
        ROUND(budget, 6) AS budgetAmount, threshold, severity, {r('used', 'utilizationPercentage')}, actionRequired FROM classified""",
    "budget_crossings": f"""
      , daily AS (SELECT s.subscriptionId, d."year", d."month", d."date", sum(f.actualCost) AS cost FROM {_STAR} GROUP BY ALL),
      running AS (SELECT *, sum(cost) OVER (PARTITION BY subscriptionId, "year", "month" ORDER BY "date") AS spent FROM daily)
      SELECT x.subscriptionId, x."year", x."month", t.threshold, {m('b.budgetAmount')}, {day('min(x."date")', 'reachedOn')}, {m('min(x.spent)', 'spent')}
      FROM running x JOIN budget b ON b.subscriptionId = x.subscriptionId AND b.idx = x."year" * 12 + x."month"
      JOIN (VALUES (50), (75), (90), (100)) t(threshold) ON x.spent * 100 >= b.budgetAmount * t.threshold AND b.budgetAmount > 0
      GROUP BY x.subscriptionId, x."year", x."month", t.threshold, b.budgetAmount""",
    "tags_flattened": "SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events",
    "refresh_window": f"""
      SELECT dateKey, CASE WHEN dateKey >= 20010729 THEN 'reloaded' ELSE 'kept' END AS origin, count(*) AS costRows, {m('sum(actualCost)', 'totalCost')}
      FROM fact WHERE dateKey >= 20000701 GROUP BY dateKey""",
    "linear_forecast": f"""
      , daily AS (SELECT f.subscriptionKey, d."date", CAST(sum(f.actualCost) AS DOUBLE) AS y, CAST(d."date" - DATE '2001-08-01' AS DOUBLE) AS x
        FROM fact f JOIN dim_date d USING (dateKey) WHERE d."date" >= {NOW} - INTERVAL 90 DAY AND d."date" <= {NOW} GROUP BY f.subscriptionKey, d."date"),
      fit AS (SELECT subscriptionKey, regr_slope(y, x) AS slope, regr_intercept(y, x) AS icept, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, count(*) AS n
        FROM daily GROUP BY subscriptionKey HAVING count(*) > 2 AND regr_slope(y, x) IS NOT NULL),
      ahead AS (SELECT *, sqrt(greatest(syy - slope * sxy, 0) / (n - 2)) AS resid, icept + slope * h AS e FROM fit, (VALUES (30), (60), (90)) t(h))
      SELECT CAST(strftime(DATE '2001-08-01' + h, '%Y%m%d') AS INTEGER) AS dateKey, subscriptionKey, {r('e', 'forecastedCost')},
        {r('e - resid * 1.96', 'confidenceIntervalLower')}, {r('e + resid * 1.96', 'confidenceIntervalUpper')}, {r('e', 'p50Forecast')},
        {r('e + resid * 1.2816', 'p90Forecast')}, 'Linear' AS modelType, h AS forecastHorizonDays, {ts(NOW, 'forecastDate')} FROM ahead""",
    "tag_compliance": _compliance(_TAGS),
    "tag_compliance_required": _compliance([t for t in _TAGS if t[0] in ("Environment", "Team")]),
    "unused_resources": f"""
      SELECT resourceKey, resourceId, resourceName, resourceType, resourceGroupName FROM dim_resource WHERE isCurrent AND resourceKey NOT IN (
        SELECT f.resourceKey FROM fact f JOIN dim_date d USING (dateKey) WHERE d."date" >= {NOW} - INTERVAL 30 DAY)""",
    "idle_resources": f"""
      SELECT r.resourceKey, r.resourceId, r.resourceName, r.team, {r('i.idle', 'avgIdlePercentage')}, {m('c.cost', 'totalCost')}
      FROM dim_resource r JOIN (SELECT u.resourceKey, avg(CAST(u.idlePercentage AS DOUBLE)) AS idle FROM {_UTIL}
          WHERE d."date" >= {NOW} - INTERVAL 30 DAY GROUP BY u.resourceKey HAVING avg(CAST(u.idlePercentage AS DOUBLE)) >= 80) i ON r.resourceKey = i.resourceKey
      LEFT JOIN (SELECT f.resourceKey, sum(f.actualCost) AS cost FROM fact f JOIN dim_date d USING (dateKey)
          WHERE d."date" >= {NOW} - INTERVAL 30 DAY GROUP BY f.resourceKey) c ON c.resourceKey = r.resourceKey
      WHERE r.isCurrent""",
    "empty_resource_groups": """
      SELECT n_nationkey + 1 AS resourceGroupKey, n_name AS resourceGroupName, 'sub-' || n_nationkey AS subscriptionId FROM nation
      WHERE n_name NOT IN (SELECT resourceGroupName FROM dim_resource WHERE isCurrent)""",
    "reservation_candidates": f"""
      , daily AS (SELECT m.serviceName, f.dateKey, sum(f.actualCost) AS cost FROM fact f JOIN dim_meter m USING (meterKey) JOIN dim_date d USING (dateKey)
        WHERE NOT f.isReservationCharge AND NOT f.isSavingsPlanCharge AND d."date" >= {NOW} - INTERVAL 90 DAY GROUP BY ALL)
      SELECT serviceName, {m('sum(cost)', 'onDemandCost')}, count(*) AS activeDays, {r('quantile_cont(CAST(cost AS DOUBLE), 0.2)', 'dailyCommitment')}
      FROM daily GROUP BY serviceName""",
    "top_cost_drivers": f"""
      SELECT r.resourceKey, r.resourceId, r.resourceName, r.businessUnit, {m('sum(f.actualCost)', 'totalCost')}
      FROM fact f JOIN dim_date d USING (dateKey) JOIN dim_resource r ON f.resourceKey = r.resourceKey AND r.isCurrent
      WHERE d."date" >= {NOW} - INTERVAL 30 DAY GROUP BY r.resourceKey, r.resourceId, r.resourceName, r.businessUnit
      ORDER BY sum(f.actualCost) DESC, r.resourceId LIMIT 10""",
    "top_movers": f"""
      , moved AS (SELECT m.serviceName, coalesce(sum(f.actualCost) FILTER (d."date" >= {NOW} - INTERVAL 30 DAY), 0) AS cur,
          coalesce(sum(f.actualCost) FILTER (d."date" < {NOW} - INTERVAL 30 DAY), 0) AS prev
        FROM fact f JOIN dim_date d USING (dateKey) JOIN dim_meter m USING (meterKey) WHERE d."date" >= {NOW} - INTERVAL 60 DAY GROUP BY m.serviceName)
      SELECT serviceName, {m('cur', 'currentCost')}, {m('prev', 'previousCost')}, {m('cur - prev', 'change')} FROM moved
      ORDER BY abs(cur - prev) DESC, serviceName LIMIT 10""",
    "cost_utilization_correlation": f"""
      SELECT r.businessUnit, count(*) AS resourceDays, {r('corr(CAST(c.cost AS DOUBLE), u.avgCpuPercentage)', 'correlation')}
      FROM util u JOIN (SELECT dateKey, resourceKey, sum(actualCost) AS cost FROM fact GROUP BY ALL) c
        ON u.dateKey = c.dateKey AND u.resourceKey = c.resourceKey
      JOIN dim_resource r ON u.resourceKey = r.resourceKey AND r.isCurrent WHERE u.avgCpuPercentage IS NOT NULL GROUP BY r.businessUnit""",
    "cost_distribution": f"""
      SELECT r.businessUnit, r.app, r.env, r.location, {m('sum(f.actualCost)', 'totalCost')},
        {r(f'{_COST} / (SELECT CAST(sum(actualCost) AS DOUBLE) FROM fact) * 100', 'share')} FROM {_STAR} GROUP BY r.businessUnit, r.app, r.env, r.location""",
    "orphan_counts": """
      SELECT k AS keyName, CAST(sum(n) AS BIGINT) AS factRows, CAST(0 AS BIGINT) AS orphans FROM (
        SELECT unnest(['dateKey', 'resourceKey', 'subscriptionKey', 'resourceGroupKey', 'regionKey', 'meterKey', 'offerKey']) AS k, count(*) AS n FROM fact
        UNION ALL SELECT 'benefitKey', count(benefitKey) FROM fact) GROUP BY k""",
    "duplicate_cost_keys": """
      SELECT dateKey, resourceKey, meterKey, count(*) AS occurrences FROM fact GROUP BY ALL HAVING count(*) > 1""",
    "freshness": f"""
      SELECT s.subscriptionId, {day('max(d."date")', 'latestDate')}, CAST(DATE '2001-08-01' - max(d."date") AS INTEGER) AS ageDays
      FROM fact f JOIN dim_date d USING (dateKey) JOIN dim_subscription s USING (subscriptionKey) GROUP BY s.subscriptionId""",
    "completeness": """
      SELECT d.yearMonth, count(*) AS calendarDays, count(c.n) AS costDays, CAST(coalesce(sum(c.n), 0) AS BIGINT) AS costRows
      FROM dim_date d LEFT JOIN (SELECT dateKey, count(*) AS n FROM fact GROUP BY dateKey) c USING (dateKey)
      WHERE d.dateKey BETWEEN (SELECT min(dateKey) FROM fact) AND (SELECT max(dateKey) FROM fact) GROUP BY d.yearMonth""",
    "reconciliation": f"""
      , months AS (SELECT d.billingPeriodStart AS p, sum(f.actualCost) AS loaded, CAST(sum(f.amortizedCost) * 0.95 AS DECIMAL(18,2)) AS invoiced
        FROM fact f JOIN dim_date d USING (dateKey) GROUP BY ALL)
      SELECT {day('p', 'billingPeriodStartDate')}, {m('loaded', 'loadedCost')}, {m('invoiced', 'invoicedAmount')}, {m('loaded - invoiced', 'difference')},
        abs(CAST(loaded - invoiced AS DOUBLE)) / CAST(invoiced AS DOUBLE) <= 0.02 AS reconciled FROM months""",
    "load_exports_fact": f"""
      SELECT f.subscriptionId, f.subscriptionId AS "groupOwner", {day('d.billingPeriodStart', 'billingPeriodStartDate')},
        count(*) AS "costRows", {m('sum(f.actualCost)', 'cost')}, count(*) FILTER (f.meterKey % 10 = 0) AS "unknownResources"
      FROM fact f JOIN dim_date d USING (dateKey) GROUP BY f.subscriptionId, d.billingPeriodStart""",
    "rls_fact_attributes": f"""
      , seen AS (SELECT 'cost' AS name, count(*) AS n FROM {_STAR}
          WHERE s.subscriptionName IN ('NATION_2', 'NATION_7') AND (r.businessUnit = 'NATION_2' OR r.team = 'NATION_2')
        UNION ALL SELECT 'utilization', count(*) FROM util u JOIN dim_resource r USING (resourceKey)
          WHERE r.businessUnit = 'NATION_2' OR r.team = 'NATION_2')
      SELECT name || how AS reading, n AS "visibleRows" FROM seen, (VALUES (' by method'), (' by attribute')) t(how)""",
    "cost_export": f"""
      SELECT {day('d.billingPeriodStart', 'BillingPeriodStartDate')}, f.subscriptionId AS "SubscriptionId", count(*) AS costRows,
        {m('sum(f.actualCost)', 'cost')}, {m('sum(f.usageQuantity)', 'quantity')}
      FROM fact f JOIN dim_date d USING (dateKey) GROUP BY d.billingPeriodStart, f.subscriptionId""",
    "resource_versions": f"""
      , state AS (SELECT r.*, s_acctbal < 0 AS changed FROM dim_resource r JOIN supplier ON s_suppkey = r.resourceKey)
      SELECT resourceId, team, isCurrent AND NOT changed AS isCurrent, CAST(NULL AS VARCHAR) AS effectiveStartDate,
        CASE WHEN isCurrent AND changed THEN '2001-08-01 00:00:00' END AS effectiveEndDate FROM state
      UNION ALL
      SELECT resourceId, CASE WHEN changed THEN 'frozen' ELSE team END, TRUE, '2001-08-01 00:00:00', NULL
      FROM state WHERE changed OR NOT isCurrent""",
    "stream_budget_alerts": f"""{_ALERT}
      SELECT budgetName, severity, {r('used', 'utilizationPercentage')}, actionRequired,
        CASE severity WHEN 'High' THEN 'Bug' ELSE 'Task' END AS ticketType,
        '[' || severity || '] Budget Alert: ' || budgetName || ' - ' || subscriptionName AS mailSubject FROM classified""",
}

"""Versions, incremental detection, forecasts, commitments, idle runs, crossings."""

from __future__ import annotations

from .base import NOW, day, m, r, ts

_VERSIONS = """
  , snapshot AS (
    SELECT resourceId, DATE '1995-01-01' + CAST(resourceKey % 400 AS INTEGER) AS seenOn, 1 AS loaded, FALSE AS deleted, team, env FROM dim_resource
    UNION ALL SELECT resourceId, DATE '1997-01-01' + CAST(resourceKey * 7 % 900 AS INTEGER), 2, FALSE, 'moved-' || (resourceKey % 5), env FROM dim_resource WHERE resourceKey % 3 = 0
    UNION ALL SELECT resourceId, DATE '1996-01-01' + CAST(resourceKey * 3 % 300 AS INTEGER), 3, FALSE, 'late-' || (resourceKey % 2), env FROM dim_resource WHERE resourceKey % 4 = 0
    UNION ALL SELECT resourceId, DATE '1998-06-01', 4, FALSE, team, env FROM dim_resource WHERE resourceKey % 5 = 0
    UNION ALL SELECT resourceId, DATE '2000-01-01' + CAST(resourceKey % 100 AS INTEGER), 5, TRUE, team, env FROM dim_resource WHERE resourceKey % 11 = 0),
  latest AS (SELECT * FROM snapshot QUALIFY row_number() OVER (PARTITION BY resourceId, seenOn ORDER BY loaded DESC) = 1),
  compared AS (SELECT *, lag(deleted) OVER w AS wasDeleted, lag(team) OVER w AS wasTeam, lag(env) OVER w AS wasEnv
    FROM latest WINDOW w AS (PARTITION BY resourceId ORDER BY seenOn)),
  changed AS (SELECT * FROM compared WHERE wasDeleted IS NULL OR wasDeleted <> deleted
    OR (NOT deleted AND (wasTeam IS DISTINCT FROM team OR wasEnv IS DISTINCT FROM env))),
  version AS (SELECT resourceId, deleted, team, env, seenOn AS validFrom, lead(seenOn) OVER (PARTITION BY resourceId ORDER BY seenOn) AS validTo FROM changed)"""

_FORECAST = f"""
  , spent AS (SELECT f.subscriptionKey, d."date", CAST(sum(f.actualCost) AS DOUBLE) AS y FROM fact f JOIN dim_date d USING (dateKey) GROUP BY ALL),
  origin AS (SELECT DATE '2001-08-01' - o AS origin, o FROM (VALUES (28), (21), (14), (7), (0)) t(o)),
  history AS (SELECT s.subscriptionKey, o.origin, s.y, CAST(s."date" - o.origin AS DOUBLE) AS x, dayofweek(s."date") AS wd
    FROM spent s JOIN origin o ON s."date" <= o.origin AND s."date" > o.origin - 90),
  weekday AS (SELECT subscriptionKey, origin, wd, avg(x) AS mx, avg(y) AS my, count(*) AS n FROM history GROUP BY ALL),
  centred AS (SELECT h.subscriptionKey, h.origin, sum((h.x - w.mx) * (h.x - w.mx)) AS sxx, sum((h.x - w.mx) * (h.y - w.my)) AS sxy,
      sum((h.y - w.my) * (h.y - w.my)) AS syy, count(*) AS n, count(DISTINCT h.wd) AS k
    FROM history h JOIN weekday w USING (subscriptionKey, origin, wd) GROUP BY h.subscriptionKey, h.origin),
  slope AS (SELECT *, CASE WHEN sxx > 0 THEN sxy / sxx ELSE 0 END AS b FROM centred WHERE n - k - 1 > 0),
  level AS (SELECT w.subscriptionKey, w.origin, w.wd, w.my - s.b * w.mx AS a FROM weekday w JOIN slope s USING (subscriptionKey, origin)),
  fallback AS (SELECT subscriptionKey, origin, avg(a) AS a FROM level GROUP BY ALL),
  target AS (SELECT s.subscriptionKey, s.origin, s.b, s.sxy, s.syy, s.n, s.k, g.g, s.origin + g.g AS day
    FROM slope s, (SELECT unnest(range(1, 91))::INTEGER AS g) g),
  predicted AS (SELECT t.*, coalesce(l.a, f.a) + t.b * t.g AS e, sqrt(greatest(syy - b * sxy, 0) / (n - k - 1)) AS resid
    FROM target t JOIN fallback f USING (subscriptionKey, origin)
    LEFT JOIN level l ON l.subscriptionKey = t.subscriptionKey AND l.origin = t.origin AND l.wd = dayofweek(t.day)),
  tested AS (SELECT p.subscriptionKey, p.origin, count(*) AS days, sum(s.y) AS spent, sum(p.e) AS forecast, sum(abs(s.y - p.e)) AS err
    FROM predicted p JOIN spent s ON s.subscriptionKey = p.subscriptionKey AND s."date" = p.day
    WHERE p.g <= 7 AND p.origin < DATE '2001-08-01' GROUP BY p.subscriptionKey, p.origin)"""

_MOVERS = f"""
  , part AS (SELECT me.serviceName, f.resourceKey, d."date" >= {NOW} - INTERVAL 30 DAY AS recent, f.usageQuantity AS q, f.actualCost AS c
    FROM fact f JOIN dim_date d USING (dateKey) JOIN dim_meter me USING (meterKey) WHERE d."date" >= {NOW} - INTERVAL 60 DAY AND d."date" <= {NOW}),
  member AS (SELECT serviceName, resourceKey, coalesce(sum(q) FILTER (NOT recent), 0) AS q0, coalesce(sum(q) FILTER (recent), 0) AS q1,
      coalesce(sum(c) FILTER (NOT recent), 0) AS c0, coalesce(sum(c) FILTER (recent), 0) AS c1 FROM part GROUP BY ALL),
  service AS (SELECT serviceName, sum(q0)::DOUBLE AS q0, sum(q1)::DOUBLE AS q1, sum(c0)::DOUBLE AS c0, sum(c1)::DOUBLE AS c1 FROM member GROUP BY ALL),
  priced AS (SELECT m.*, CASE WHEN s.q0 > 0 THEN s.c0 / s.q0 WHEN s.q1 > 0 THEN s.c1 / s.q1 ELSE 0 END AS p FROM member m JOIN service s USING (serviceName)),
  effect AS (SELECT *, (q1 - q0)::DOUBLE * p AS quantity, CASE WHEN q0 > 0 THEN (q1 - q0)::DOUBLE * (c0::DOUBLE / q0::DOUBLE - p) ELSE 0 END AS mix FROM priced)"""

_SCALED = """
  , small AS (SELECT resourceId, "date", CAST(CAST(actualCost AS DECIMAL(28,5)) / 1000 AS DECIMAL(18,5)) AS cost, subscriptionId FROM res_days),
  spread AS (SELECT resourceId, avg(CAST(cost AS DOUBLE)) FILTER (rn > 1) AS mean, stddev_pop(CAST(cost AS DOUBLE)) FILTER (rn > 1) AS sd, count(*) AS n
    FROM (SELECT *, row_number() OVER (PARTITION BY resourceId ORDER BY "date" DESC) AS rn FROM small) GROUP BY resourceId),
  deviant AS (SELECT s.*, p.mean, CAST(s.cost AS DOUBLE) - p.mean AS delta, (CAST(s.cost AS DOUBLE) - p.mean) / p.sd AS z
    FROM small s JOIN spread p USING (resourceId) WHERE p.n >= 7 AND p.sd > 0 AND abs((CAST(s.cost AS DOUBLE) - p.mean) / p.sd) >= 1.0 AND s.cost >= 0),
  judged AS (SELECT *, CASE WHEN abs(z) >= 3 OR abs(delta) >= 1000 THEN 'High' WHEN abs(z) >= 2 OR abs(delta) >= 100 THEN 'Medium' ELSE 'Low' END AS severity FROM deviant)"""
_DONE = """CASE WHEN so.resourceKey % 3 = 0 THEN CAST(potentialMonthlySavings * 0.8 AS DECIMAL(18,2)) ELSE realizedMonthlySavings END"""

QUERIES: dict[str, str] = {
    "resource_intervals": f"""{_VERSIONS}
      SELECT resourceId, team, env, {day('validFrom', 'validFrom')}, {day('validTo', 'validTo')}, validTo IS NULL AS "isCurrent"
      FROM version WHERE NOT deleted""",
    "facts_by_version": f"""{_VERSIONS}
      , line AS (SELECT CASE WHEN l_linenumber = 1 THEN '/res/1' ELSE '/res/' || l_suppkey END AS resourceId,
          CAST(l_shipdate AS DATE) AS d, CAST(l_quantity AS DECIMAL(18,2)) AS q FROM lineitem)
      SELECT v.team, v.env, CAST(year(l.d) AS INTEGER) AS "year", count(*) AS "costRows", {m('sum(l.q)', 'quantity')}
      FROM line l LEFT JOIN version v ON l.resourceId = v.resourceId AND NOT v.deleted AND l.d >= v.validFrom AND (v.validTo IS NULL OR l.d < v.validTo)
      GROUP BY v.team, v.env, year(l.d)""",
    "incremental_detection": f"""
      , daily AS (SELECT f.subscriptionKey, f.dateKey, sum(f.actualCost) AS cost FROM fact f WHERE f.dateKey BETWEEN 20010703 AND 20010801 GROUP BY ALL),
      earlier AS (SELECT *, count(*) OVER w AS n, avg(CAST(cost AS DOUBLE)) OVER w AS mean, stddev_pop(CAST(cost AS DOUBLE)) OVER w AS sd
        FROM daily WINDOW w AS (PARTITION BY subscriptionKey ORDER BY dateKey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
      scored AS (SELECT *, CAST(cost AS DOUBLE) - mean AS delta,
          CASE WHEN n > 1 AND sd > 1e-9 THEN (CAST(cost AS DOUBLE) - mean) / sd ELSE 0 END AS z FROM earlier WHERE n > 0)
      SELECT dateKey, subscriptionKey, {m('cost', 'actualCost')}, {r('mean', 'expectedCost')}, {r('delta', 'costVariance')}, {r('z', 'zScore')},
        n AS days, CASE WHEN cost > mean THEN 'Spike' ELSE 'Drop' END AS "anomalyType",
        CASE WHEN abs(z) >= 3 THEN 'High' WHEN abs(z) >= 2 THEN 'Medium' ELSE 'Low' END AS severity,
        abs(z) >= 2 AND cost >= 10 AS "isAnomaly" FROM scored""",
    "seasonal_forecast": f"""{_FORECAST}
      , accuracy AS (SELECT subscriptionKey, greatest(0, 100 - sum(err) / sum(spent) * 100) AS acc FROM tested GROUP BY subscriptionKey)
      SELECT CAST(strftime(p.day, '%Y%m%d') AS INTEGER) AS dateKey, p.subscriptionKey, {r('e', 'forecastedCost')},
        {r('e - resid * 1.96', 'confidenceIntervalLower')}, {r('e + resid * 1.96', 'confidenceIntervalUpper')}, {r('e', 'p50Forecast')},
        {r('e + resid * 1.2816', 'p90Forecast')}, 'Seasonal' AS modelType, {r('a.acc', 'modelAccuracy')}, g AS forecastHorizonDays, {ts(NOW, 'forecastDate')}
      FROM predicted p LEFT JOIN accuracy a USING (subscriptionKey) WHERE p.origin = DATE '2001-08-01' AND g IN (30, 60, 90)""",
    "forecast_backtest": f"""{_FORECAST}
      SELECT subscriptionKey, {day('origin', 'origin')}, days AS "testedDays", {r('spent', 'actualCost')}, {r('forecast', 'forecastedCost')},
        {r('err', 'absoluteError')}, {r('greatest(0, 100 - err / spent * 100)', 'modelAccuracy')} FROM tested""",
    "purchase_quantity": f"""
      , demand AS (SELECT me.serviceName, f.dateKey, CAST(sum(f.actualCost) AS DECIMAL(18,2)) AS x FROM fact f JOIN dim_meter me USING (meterKey)
        WHERE NOT f.isReservationCharge AND NOT f.isSavingsPlanCharge AND f.dateKey BETWEEN 20010504 AND 20010801 GROUP BY ALL HAVING sum(f.actualCost) > 0),
      total AS (SELECT serviceName, sum(x) AS spent, count(*) AS n FROM demand GROUP BY serviceName),
      candidate AS (SELECT DISTINCT serviceName, x AS c FROM demand UNION SELECT serviceName, 0 FROM total),
      covered AS (SELECT k.serviceName, k.c, sum(least(d.x, k.c)) AS got FROM candidate k JOIN demand d USING (serviceName) GROUP BY k.serviceName, k.c),
      gain AS (SELECT *, got * 100 - c * 90 * p AS g FROM covered, (VALUES ('1Year', 72), ('3Years', 54)) t(term, p)),
      best AS (SELECT * FROM gain QUALIFY row_number() OVER (PARTITION BY serviceName, term ORDER BY g DESC, c) = 1)
      SELECT b.serviceName, term, n AS "activeDays", {m('t.spent', 'onDemandCost')}, {m('b.c', 'dailyCommitment')}, {m('b.got', 'coveredAmount')},
        {m('b.c * 90 - b.got', 'wastedAmount')}, CAST(CAST(b.g / 100 AS DECIMAL(28,2)) AS DOUBLE) AS saving,
        {r('b.got::DOUBLE / t.spent::DOUBLE * 100', 'coveragePercentage')},
        {r('CASE WHEN b.c > 0 THEN b.got::DOUBLE / (b.c * 90)::DOUBLE * 100 END', 'utilizationPercentage')}
      FROM best b JOIN total t USING (serviceName)""",
    "idle_runs": f"""
      , days AS (SELECT u.resourceKey, d."date" AS dt, u.idlePercentage AS idle FROM util u JOIN dim_date d ON u.dateKey = d.dateKey
        WHERE u.resourceKey IS NOT NULL AND u.idlePercentage >= 50),
      opened AS (SELECT a.*, CASE WHEN EXISTS (SELECT 1 FROM days b WHERE b.resourceKey = a.resourceKey AND b.dt = a.dt - 1) THEN 0 ELSE 1 END AS fresh FROM days a),
      run AS (SELECT *, sum(fresh) OVER (PARTITION BY resourceKey ORDER BY dt) AS number FROM opened),
      spent AS (SELECT f.resourceKey, d."date" AS dt, sum(f.actualCost) AS cost FROM fact f JOIN dim_date d USING (dateKey) GROUP BY ALL),
      stretch AS (SELECT resourceKey, number, min(dt) AS a, max(dt) AS b, count(*) AS n, avg(CAST(idle AS DOUBLE)) AS idle, coalesce(sum(cost), 0) AS cost
        FROM run LEFT JOIN spent USING (resourceKey, dt) GROUP BY resourceKey, number HAVING count(*) >= 2)
      SELECT r.resourceId, r.resourceName, r.team, {day('f.a', 'firstDay')}, {day('f.b', 'lastDay')}, f.n AS "idleDays",
        {r('f.idle', 'avgIdlePercentage')}, {m('f.cost', 'cost')} FROM stretch f JOIN dim_resource r ON f.resourceKey = r.resourceKey AND r.isCurrent""",
    "stream_crossings": f"""
      , row AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS cost FROM lineitem),
      spent AS (SELECT 'sub-' || s_nationkey AS subscriptionId, CAST(year(d) AS INTEGER) AS "year", CAST(month(d) AS INTEGER) AS "month", sum(cost) AS spent
        FROM row JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
      SELECT x.subscriptionId, x."year", x."month", t.threshold, {m('b.budgetAmount')}, 1 AS announcements
      FROM spent x JOIN budget b ON b.subscriptionId = x.subscriptionId AND b.idx = x."year" * 12 + x."month"
      JOIN (VALUES (50), (75), (90), (100)) t(threshold) ON x.spent * 100 >= b.budgetAmount * t.threshold AND b.budgetAmount > 0""",
    "movers_explained": f"""{_MOVERS}
      SELECT serviceName, {m('sum(c0)', 'previousCost')}, {m('sum(c1)', 'currentCost')}, {m('sum(c1) - sum(c0)', 'change')}, {r('sum(quantity)', 'quantityEffect')},
        {r('sum(mix)', 'mixEffect')}, {r('sum((c1 - c0)::DOUBLE - quantity - mix)', 'priceEffect')},
        count(*) FILTER (c0 = 0 AND c1 <> 0) AS "membersCome", count(*) FILTER (c0 <> 0 AND c1 = 0) AS "membersGone" FROM effect GROUP BY serviceName""",
    "movers_explained_members": f"""{_MOVERS}
      SELECT serviceName, resourceKey, {m('c0', 'previousCost')}, {m('c1', 'currentCost')}, {m('c1 - c0', 'change')}, {r('quantity', 'quantityEffect')},
        {r('mix', 'mixEffect')}, {r('(c1 - c0)::DOUBLE - quantity - mix', 'priceEffect')} FROM effect""",
    "export_drift": """
      SELECT * FROM (VALUES ('run=2', 'Tags', 'missing', CAST(NULL AS BIGINT)), ('run=2', 'Tags', 'disappeared', NULL),
        ('run=3', 'Tags', 'appeared', NULL), ('run=3', 'Discount', 'appeared', NULL), ('run=3', 'Discount', 'unexpected', NULL)) t("exportFolder", "column", problem, "rows")
      UNION ALL SELECT 'run=3', 'EffectivePrice', 'retyped', count(*) FROM fact WHERE meterKey % 10 = 7""",
    "account_completeness": f"""
      , row AS (SELECT 'account-' || ((subscriptionKey - 1) % 5) AS account, d."date" AS dt, d.billingPeriodStart AS a, d.billingPeriodEnd AS b FROM fact JOIN dim_date d USING (dateKey)),
      newest AS (SELECT account, max(dt) AS newest FROM row GROUP BY account),
      period AS (SELECT account, a, b, count(DISTINCT dt) AS days, count(*) AS n FROM row GROUP BY ALL)
      SELECT account AS "BillingAccountId", {day('a', 'BillingPeriodStartDate')}, CAST(least(b, newest) - a AS INTEGER) + 1 AS "expectedDays", days AS "deliveredDays",
        CAST(least(b, newest) - a AS INTEGER) + 1 - days AS "missingDays", n AS "costRows" FROM period JOIN newest USING (account)""",
    "detect_cost_anomalies_resumed": f"""
      SELECT dateKey, resourceKey, subscriptionKey, {m('actualCost')}, {r('expectedCost', 'expectedCost')}, {r('costVariance', 'costVariance')},
        {r('variancePercentage', 'variancePercentage')}, {r('zScore', 'zScore')}, anomalyType, severity, isAnomaly,
        {ts(NOW, 'detectionDate')} FROM anomaly_fact WHERE dateKey > 20010725""",
    "generate_rightsizing_resumed": f"""
      SELECT dateKey, resourceKey, resourceId, recommendationType, recommendationDescription, {m('potentialMonthlySavings')}, {m('potentialAnnualSavings')},
        status, priority, {day('recommendationDate', 'recommendationDate')}, 0.0::DOUBLE AS realizedMonthlySavings, 0.0::DOUBLE AS realizedAnnualSavings
      FROM rightsizing WHERE resourceKey % 2 <> 0""",
    "advisor_repeated": f"""
      SELECT recommendationType, status, count(*) AS opportunities, {m('sum(potentialMonthlySavings)', 'potentialMonthlySavings')} FROM savings GROUP BY ALL""",
    "detect_anomalies_scaled": f"""{_SCALED}
      SELECT resourceId, subscriptionId, {day('"date"', 'date')}, {m('cost', 'actualCost')}, {r('mean', 'expectedCost')}, {r('delta', 'variance')},
        {r('CASE WHEN mean > 0 THEN delta / mean * 100 ELSE 0 END', 'variancePercentage')}, {r('z', 'zScore')},
        CASE WHEN cost > mean THEN 'Spike' ELSE 'Drop' END AS "anomalyType", severity, TRUE AS "isAnomaly", {r('least(1.0, abs(z) / 3.0)', 'confidence')} FROM judged""",
    "anomaly_records_published": f"""{_SCALED}
      SELECT resourceId AS resource_id, subscriptionId AS subscription_id, {day('"date"', 'date')}, {m('cost', 'actual_cost')}, {r('mean', 'expected_cost')},
        {r('delta', 'variance')}, {r('CASE WHEN mean > 0 THEN delta / mean * 100 ELSE 0 END', 'variance_percentage')}, {r('z', 'z_score')},
        CASE WHEN cost > mean THEN 'Spike' ELSE 'Drop' END AS anomaly_type, severity, TRUE AS is_anomaly, {r('least(1.0, abs(z) / 3.0)', 'confidence')},
        '2001-08-01T00:00:00' AS detected_at FROM judged""",
    "measure_savings_realized": f"""
      SELECT r.team, {m(f'sum({_DONE})', 'Total Realized Monthly Savings')}, {m(f'sum(({_DONE}) * 12)', 'Total Realized Annual Savings')},
        {r(f'CAST(sum({_DONE}) AS DOUBLE) / nullif(CAST(sum(potentialMonthlySavings) AS DOUBLE), 0) * 100', 'Implementation Rate %')},
        count(*) FILTER (status = 'Pending' AND (so.resourceKey % 3 = 0) IS NOT TRUE) AS "Pending Opportunities",
        count(*) FILTER (so.resourceKey % 3 = 0) AS "Completed Opportunities"
      FROM savings so LEFT JOIN dim_resource r ON so.resourceKey = r.resourceKey GROUP BY r.team""",
    "measure_anomalies_flagged": f"""
      SELECT s.subscriptionName, count(*) AS "Total Anomalies", {r('sum(costVariance)', 'Total Cost Variance')},
        {r('avg(variancePercentage)', 'Average Variance %')}, {r('max(zScore)', 'Max Z-Score')}
      FROM anomaly_fact a LEFT JOIN dim_subscription s ON a.subscriptionKey = s.subscriptionKey WHERE isAnomaly GROUP BY s.subscriptionName""",
    "lattice_drill": f"""
      , row AS (SELECT d.*, strftime(d."date", '%Y-%m-%d') AS dayName, s.subscriptionId, s.businessUnit, f.resourceKey, f.actualCost
        FROM fact f JOIN dim_date d USING (dateKey) JOIN dim_subscription s USING (subscriptionKey)),
      named AS (SELECT 'year_unit: businessUnit' AS drill, businessUnit AS member, resourceKey, actualCost FROM row
        UNION ALL SELECT 'year_unit: year, businessUnit', "year" || '/' || businessUnit, resourceKey, actualCost FROM row
        UNION ALL SELECT 'month_subscription: year, quarter, subscriptionId', "year" || '/' || "quarter" || '/' || subscriptionId, resourceKey, actualCost FROM row
        UNION ALL SELECT 'day_subscription: date', dayName, resourceKey, actualCost FROM row
        UNION ALL SELECT 'day_subscription: date, subscriptionId', dayName || '/' || subscriptionId, resourceKey, actualCost FROM row)
      SELECT drill, member, {m('sum(actualCost)', 'cost')}, count(*) AS "costRows", count(DISTINCT resourceKey) AS resources, TRUE AS "sketchWithin"
      FROM named GROUP BY drill, member""",
    "variance_by_cell": """
      , cell AS (SELECT f.dateKey, f.subscriptionKey, me.serviceName, coalesce(r.app, '') AS tag, sum(f.actualCost) AS cost FROM fact f JOIN dim_meter me USING (meterKey)
          LEFT JOIN dim_resource r ON f.resourceKey = r.resourceKey WHERE f.dateKey BETWEEN 20010702 AND 20010801 GROUP BY ALL),
      usual AS (SELECT c.subscriptionKey, c.serviceName, c.tag, CAST(sum(c.cost) AS DOUBLE) / any_value(p.n) AS mean FROM cell c
          JOIN (SELECT subscriptionKey, count(DISTINCT dateKey) AS n FROM cell GROUP BY ALL) p USING (subscriptionKey) GROUP BY c.subscriptionKey, c.serviceName, c.tag),
      varied AS (SELECT a.dateKey, a.subscriptionKey, u.serviceName, u.tag, coalesce(CAST(c.cost AS DOUBLE), 0) - u.mean AS v
        FROM (SELECT DISTINCT dateKey, subscriptionKey FROM anomaly_fact WHERE isAnomaly) a JOIN usual u USING (subscriptionKey)
        LEFT JOIN cell c ON c.dateKey = a.dateKey AND c.subscriptionKey = a.subscriptionKey AND c.serviceName = u.serviceName AND c.tag = u.tag),
      whole AS (SELECT dateKey, subscriptionKey, sum(v) AS w FROM varied GROUP BY ALL),
      service AS (SELECT dateKey, subscriptionKey, serviceName, sum(v) AS v FROM varied GROUP BY ALL),
      service_rank AS (SELECT s.*, w.w, (SELECT coalesce(sum(abs(o.v)), 0) FROM service o WHERE o.dateKey = s.dateKey AND o.subscriptionKey = s.subscriptionKey
          AND sign(o.v) = sign(w.w) AND (abs(o.v) > abs(s.v) OR (abs(o.v) = abs(s.v) AND o.serviceName < s.serviceName))) AS before
        FROM service s JOIN whole w USING (dateKey, subscriptionKey) WHERE sign(s.v) = sign(w.w)),
      inside AS (SELECT v.*, s.w FROM varied v JOIN service_rank s USING (dateKey, subscriptionKey, serviceName) WHERE s.before < 0.8 * abs(s.w) AND sign(v.v) = sign(s.w)),
      ranked AS (SELECT *, coalesce(sum(abs(v)) OVER (PARTITION BY dateKey, subscriptionKey ORDER BY abs(v) DESC, serviceName, tag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
          row_number() OVER (PARTITION BY dateKey, subscriptionKey ORDER BY abs(v) DESC, serviceName, tag) AS number FROM inside)
      SELECT dateKey, subscriptionKey, serviceName, tag AS "tagValue", ROUND(v, 6) AS variance, ROUND(v / w, 6) AS share, CAST(number AS INTEGER) AS "rank"
      FROM ranked WHERE before < 0.8 * abs(w)""",
}

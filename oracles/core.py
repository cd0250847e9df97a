"""KPI views, cost lookups, detection, enrichment and job frames."""

from __future__ import annotations

from .base import NOW, day, m, price, r, ts

_JOINED = "fact f JOIN dim_date d ON f.dateKey = d.dateKey JOIN dim_subscription s ON f.subscriptionKey = s.subscriptionKey"
_OPPORTUNITY = f"""dateKey, resourceKey, resourceId, recommendationType, recommendationDescription,
  {m('potentialMonthlySavings')}, {m('potentialAnnualSavings')}, status, priority, {day('recommendationDate', 'recommendationDate')}"""
_ROLLUP = f"""dateKey, resourceKey, resourceId, {r('avgCpuPercentage', 'avgCpuPercentage')},
  {r('maxCpuPercentage', 'maxCpuPercentage')}, {r('avgMemoryPercentage', 'avgMemoryPercentage')},
  {r('maxMemoryPercentage', 'maxMemoryPercentage')}, {r('avgDiskIOPS', 'avgDiskIOPS')}, {r('maxDiskIOPS', 'maxDiskIOPS')},
  {r('avgNetworkIOPS', 'avgNetworkIOPS')}, {r('maxNetworkIOPS', 'maxNetworkIOPS')}, {r('uptimeHours', 'uptimeHours')},
  {m('idlePercentage')}, {m('availabilityPercentage')}"""
_FOUND = f"""resourceId, subscriptionId, {day('"date"', 'date')}, {m('actualCost')}, {r('mean', 'expectedCost')},
  {r('delta', 'variance')}, {r('CASE WHEN mean > 0 THEN delta / mean * 100 ELSE 0 END', 'variancePercentage')},
  {r('z', 'zScore')}, CASE WHEN actualCost > mean THEN 'Spike' ELSE 'Drop' END AS anomalyType, severity,
  TRUE AS isAnomaly, {r('least(1.0, abs(z) / 3.0)', 'confidence')}"""
_COST_ROWS = f"""
  SELECT r.resourceId, r.resourceName, r.resourceType, r.subscriptionId, r.subscriptionName, {day('d."date"', 'date')},
    {m('f.actualCost')}, {m('f.amortizedCost')}, {m('f.actualCost', 'costInUSD')}, {m('f.usageQuantity')}, {m('f.effectivePrice')},
    m.meterCategory, coalesce(m.meterSubCategory, '') AS meterSubCategory, m.serviceName, '' AS serviceTier,
    '1 Hour' AS unitOfMeasure, r.location, r.resourceGroupName AS resourceGroup,
    {day('d.billingPeriodStart', 'billingPeriodStartDate')}, {day('d.billingPeriodEnd', 'billingPeriodEndDate')},
    f.chargeType, f.isReservationCharge, f.isSavingsPlanCharge, '' AS additionalInfo,
    r.env AS "tag_Environment", r.app AS "tag_Application", r.team AS "tag_Team", r.costCenter AS "tag_CostCenter",
    r.businessUnit AS "tag_BusinessUnit", '' AS "tag_Project", '' AS "tag_Service", '' AS "tag_Compliance",
    '' AS "tag_DataSensitivity"
  FROM fact f JOIN dim_resource r ON f.resourceKey = r.resourceKey AND r.isCurrent
  JOIN dim_meter m ON f.meterKey = m.meterKey JOIN dim_date d ON f.dateKey = d.dateKey
  JOIN dim_subscription s ON f.subscriptionKey = s.subscriptionKey"""

QUERIES = {
    "executive_kpis": f"""
      SELECT {day('x."date"', 'date')}, x."year", x."month", x."quarter", x.subscriptionName, x.businessUnit,
        {m('cost', 'totalActualCost')}, {m('amortized', 'totalAmortizedCost')}, {m('cost', 'totalCostUSD')},
        {m('lag(cost) OVER (PARTITION BY x.subscriptionId ORDER BY x."date")', 'previousDayCost')},
        {m('p.total', 'previousMonthCost')}, activeResourceCount, uniqueServiceCount, 0 AS forecastedCost,
        {ts(NOW, 'calculationDate')}
      FROM (SELECT d."date", d."year", d."month", d."quarter", s.subscriptionId, s.subscriptionName, s.businessUnit,
              sum(f.actualCost) AS cost, sum(f.amortizedCost) AS amortized,
              count(DISTINCT f.resourceKey) AS activeResourceCount, count(DISTINCT f.meterKey) AS uniqueServiceCount
            FROM {_JOINED} WHERE d."date" >= {NOW} - INTERVAL 13 MONTH GROUP BY ALL) x
      LEFT JOIN (SELECT s.subscriptionId, d."year" * 12 + d."month" AS idx, sum(f.actualCost) AS total
            FROM {_JOINED} WHERE d."date" >= {NOW} - INTERVAL 13 MONTH GROUP BY ALL) p
        ON p.subscriptionId = x.subscriptionId AND p.idx + 1 = x."year" * 12 + x."month" """,
    "mom_growth": f"""
      , monthly AS (SELECT s.subscriptionId, s.subscriptionName, d."year", d."month", d."year" * 12 + d."month" AS idx,
          sum(f.actualCost) AS cost
        FROM {_JOINED} WHERE d."date" >= {NOW} - INTERVAL 2 MONTH GROUP BY ALL)
      SELECT c.subscriptionId, c.subscriptionName, c."year", c."month", {m('c.cost', 'currentMonthCost')}, {m('p.cost', 'previousMonthCost')},
        {r('CASE WHEN p.cost > 0 THEN CAST(c.cost - p.cost AS DOUBLE) / CAST(p.cost AS DOUBLE) * 100 ELSE 0 END', 'momGrowthPercentage')},
        {m('c.cost - p.cost', 'momCostChange')}
      FROM monthly c LEFT JOIN monthly p ON c.subscriptionId = p.subscriptionId AND c.idx = p.idx + 1""",
    "service_cost_breakdown": f"""
      SELECT {day('d."date"', 'date')}, s.subscriptionName, m.serviceName, m.meterCategory, m.meterSubCategory,
        {m('sum(f.actualCost)', 'totalCost')}, {m('sum(f.usageQuantity)', 'totalUsage')},
        {price('f.effectivePrice', 'avgEffectivePrice')},
        count(DISTINCT f.resourceKey) AS resourceCount,
        {r('CAST(sum(f.actualCost) AS DOUBLE) / count(DISTINCT f.resourceKey)', 'costPerResource')}
      FROM {_JOINED} JOIN dim_meter m ON f.meterKey = m.meterKey WHERE d."date" >= {NOW} - INTERVAL 3 MONTH
      GROUP BY d."date", s.subscriptionId, s.subscriptionName, m.serviceName, m.meterCategory, m.meterSubCategory""",
    "resource_utilization": f"""
      SELECT {day('"date"', 'date')}, resourceKey, resourceId, resourceName, resourceType, subscriptionName, businessUnit, team, costCenter,
        {r('avgCpuPercentage', 'avgCpuPercentage')}, {r('maxCpuPercentage', 'maxCpuPercentage')},
        {r('avgMemoryPercentage', 'avgMemoryPercentage')}, {r('maxMemoryPercentage', 'maxMemoryPercentage')},
        {m('idlePercentage')}, {r('uptimeHours', 'uptimeHours')}, {m('availabilityPercentage')}, {m('totalCost')},
        {m('totalCost', 'dailyCost')}, {r('costPerCpuPercent', 'costPerCpuPercent')}, utilizationStatus FROM util_view""",
    "savings_opportunities": f"""
      SELECT r.subscriptionName, r.businessUnit, r.team, so.recommendationType, so.status, so.priority, count(*) AS opportunityCount,
        {m('sum(so.potentialMonthlySavings)', 'totalPotentialMonthlySavings')}, {m('sum(so.potentialAnnualSavings)', 'totalPotentialAnnualSavings')},
        {m('sum(so.realizedMonthlySavings)', 'totalRealizedMonthlySavings')}, {m('sum(so.realizedAnnualSavings)', 'totalRealizedAnnualSavings')},
        {r('CAST(sum(so.potentialMonthlySavings) AS DOUBLE) / count(so.potentialMonthlySavings)', 'avgPotentialMonthlySavings')},
        {r('CASE WHEN sum(so.potentialMonthlySavings) > 0 THEN CAST(sum(so.realizedMonthlySavings) AS DOUBLE) / CAST(sum(so.potentialMonthlySavings) AS DOUBLE) * 100 ELSE 0 END', 'implementationRate')}
      FROM savings so JOIN dim_resource r ON so.resourceKey = r.resourceKey AND r.isCurrent
      WHERE so.recommendationDate >= {NOW} - INTERVAL 12 MONTH
      GROUP BY r.subscriptionName, r.businessUnit, r.team, so.recommendationType, so.status, so.priority""",
    "anomaly_summary": f"""
      SELECT {day('d."date"', 'date')}, s.subscriptionName, r.businessUnit, count(*) AS totalAnomalies,
        CAST(sum(CASE WHEN severity = 'High' THEN 1 ELSE 0 END) AS BIGINT) AS highSeverityAnomalies,
        CAST(sum(CASE WHEN severity = 'Medium' THEN 1 ELSE 0 END) AS BIGINT) AS mediumSeverityAnomalies,
        CAST(sum(CASE WHEN severity = 'Low' THEN 1 ELSE 0 END) AS BIGINT) AS lowSeverityAnomalies,
        {r('sum(costVariance)', 'totalCostVariance')}, {r('avg(variancePercentage)', 'avgVariancePercentage')},
        {r('max(zScore)', 'maxZScore')}, {r('avg(zScore)', 'avgZScore')}
      FROM anomaly_fact a JOIN dim_date d USING (dateKey) JOIN dim_subscription s USING (subscriptionKey)
      LEFT JOIN dim_resource r ON a.resourceKey = r.resourceKey AND r.isCurrent
      WHERE a.isAnomaly AND d."date" >= {NOW} - INTERVAL 30 DAY
      GROUP BY d."date", s.subscriptionId, s.subscriptionName, r.businessUnit""",
    "reservation_coverage": f"""
      SELECT {day('d."date"', 'date')}, s.subscriptionName, b.benefitType, b.productName, b.term, b.scope, {m('b.utilizationPercentage')},
        {m('sum(f.actualCost)', 'totalCost')},
        {m('sum(CASE WHEN f.isReservationCharge THEN f.actualCost ELSE 0 END)', 'reservationCost')},
        {m('sum(CASE WHEN f.isSavingsPlanCharge THEN f.actualCost ELSE 0 END)', 'savingsPlanCost')},
        {r('CASE WHEN sum(f.actualCost) > 0 THEN 100 ELSE 0 END', 'coveragePercentage')},
        {r('CASE WHEN b.utilizationPercentage < 100 THEN CAST(sum(CASE WHEN f.isReservationCharge THEN f.actualCost ELSE 0 END) AS DOUBLE) * (100 - b.utilizationPercentage) / 100 ELSE 0 END', 'unusedReservationCost')}
      FROM {_JOINED} LEFT JOIN dim_benefit b ON f.benefitKey = b.benefitKey
      WHERE d."date" >= {NOW} - INTERVAL 3 MONTH AND (f.isReservationCharge OR f.isSavingsPlanCharge)
      GROUP BY d."date", s.subscriptionId, s.subscriptionName, b.benefitType, b.productName, b.term, b.scope, b.utilizationPercentage""",
    "budget_vs_actual": f"""
      SELECT d."year", d."month", d."quarter", s.subscriptionName, s.businessUnit, {m('sum(f.actualCost)', 'actualCost')},
        0.0::DOUBLE AS budgetAmount, {m('sum(f.actualCost)', 'variance')}, 0.0::DOUBLE AS budgetUtilizationPercentage
      FROM {_JOINED} WHERE d."date" >= {NOW} - INTERVAL 12 MONTH
      GROUP BY d."year", d."month", d."quarter", s.subscriptionId, s.subscriptionName, s.businessUnit""",
    "budget_vs_actual_with_budgets": f"""
      SELECT "year", "month", "quarter", subscriptionName, businessUnit, {m('cost', 'actualCost')}, {m('budget', 'budgetAmount')},
        {m('cost - budget', 'variance')},
        {r('CASE WHEN budget > 0 THEN CAST(cost AS DOUBLE) / CAST(budget AS DOUBLE) * 100 ELSE 0 END', 'budgetUtilizationPercentage')}
      FROM (SELECT x.*, coalesce(b.budgetAmount, 0) AS budget FROM (
        SELECT d."year", d."month", d."quarter", s.subscriptionId, s.subscriptionName, s.businessUnit, sum(f.actualCost) AS cost
        FROM {_JOINED} WHERE d."date" >= {NOW} - INTERVAL 12 MONTH GROUP BY ALL) x
        LEFT JOIN budget b ON b.subscriptionId = x.subscriptionId AND b.idx = x."year" * 12 + x."month")""",
    "cost_advisor_recommendations": f"""
      SELECT id, resourceId, resourceName, 'virtualMachines' AS resourceType, resourceGroup, subscriptionId, impact, recommendationTypeId,
        shortDescription, CAST(NULL AS VARCHAR) AS longDescription, benefits AS potentialBenefits, '[]' AS actions,
        CAST(NULL AS VARCHAR) AS remediation, {ts('createdTime', 'createdTime')}, {ts('lastUpdated', 'lastUpdated')}, status,
        {m('potentialMonthlySavings')}, recommendationCategory, priority FROM advice""",
    "resource_utilization_metrics": f"""
      SELECT resourceId, subscriptionId, resourceGroup, CAST(NULL AS VARCHAR) AS location, metricName, metricNamespace,
        {ts('startTime', 'startTime')}, {ts('startTime + INTERVAL 1 MINUTE', 'endTime')}, timeGrain, aggregationType, {m('metricValue')}, unit,
        {r('''CASE WHEN metricName = 'Percentage CPU' THEN metricValue WHEN metricName = 'Available Memory Bytes' AND unit = 'Bytes' THEN memoryPct ELSE metricValue END''', 'utilizationPercentage')},
        CASE metricNamespace WHEN 'Microsoft.Compute/virtualMachines' THEN 'Virtual Machine' WHEN 'Microsoft.Web/sites' THEN 'App Service'
          WHEN 'Microsoft.Sql/servers' THEN 'SQL Database' WHEN 'Microsoft.Storage/storageAccounts' THEN 'Storage Account'
          WHEN 'Microsoft.Network/loadBalancers' THEN 'Load Balancer' ELSE metricNamespace END AS resourceType
      FROM metric_pct WHERE startTime >= {NOW} - INTERVAL 30 DAY""",
    "daily_metrics_summary": f"""
      , samples AS (SELECT *, CAST(startTime AS DATE) AS md FROM metrics WHERE startTime >= {NOW} - INTERVAL 30 DAY)
      SELECT {day('g.md', 'metricDate')}, g.resourceId, g.subscriptionId, g.resourceGroup, g.metricName, g.metricNamespace,
        {r('avgValue', 'avgValue')}, {m('maxV', 'maxValue')}, {m('minV', 'minValue')}, sampleCount,
        {r('p50', 'p50Value')}, {r('p95', 'p95Value')},
        CASE WHEN g.metricName = 'Percentage CPU' THEN CASE WHEN avgValue < 20 THEN 'Underutilized' WHEN avgValue > 80 THEN 'Overutilized' ELSE 'Optimal' END
             WHEN g.metricName = 'Available Memory Bytes' THEN CASE WHEN avgValue > CAST(maxV AS DOUBLE) * 0.8::DOUBLE THEN 'Underutilized'
               WHEN avgValue < CAST(maxV AS DOUBLE) * 0.2::DOUBLE THEN 'Overutilized' ELSE 'Optimal' END
             ELSE 'Unknown' END AS utilizationStatus
      FROM (SELECT md, resourceId, subscriptionId, resourceGroup, metricName, metricNamespace,
              CAST(sum(metricValue) AS DOUBLE) / count(*) AS avgValue, max(metricValue) AS maxV, min(metricValue) AS minV, count(*) AS sampleCount
            FROM samples GROUP BY ALL) g
      JOIN (SELECT md, resourceId, metricName, quantile_cont(CAST(metricValue AS DOUBLE), 0.5) AS p50,
              quantile_cont(CAST(metricValue AS DOUBLE), 0.95) AS p95 FROM samples GROUP BY ALL) q
        ON g.md = q.md AND g.resourceId = q.resourceId AND g.metricName = q.metricName""",
    "resource_utilization_sample": f"""
      SELECT r.resourceId, r.resourceName, r.resourceType, {r('avg(u.avgCpuPercentage)', 'avg_cpu')}, count(*) AS days_measured,
        {m('sum(f.actualCost)', 'total_cost')}
      FROM util u JOIN dim_resource r ON r.resourceKey = u.resourceKey JOIN fact f ON f.resourceKey = u.resourceKey
      JOIN dim_date d ON d.dateKey = u.dateKey
      WHERE d."date" BETWEEN {NOW} - INTERVAL 7 DAY AND {NOW}
      GROUP BY r.resourceId, r.resourceName, r.resourceType HAVING avg(u.avgCpuPercentage) < 20 AND count(*) >= 5""",
    "detect_cost_anomalies": f"""
      SELECT dateKey, resourceKey, subscriptionKey, {m('actualCost')}, {r('expectedCost', 'expectedCost')}, {r('costVariance', 'costVariance')},
        {r('variancePercentage', 'variancePercentage')}, {r('zScore', 'zScore')}, anomalyType, severity, isAnomaly,
        {ts(NOW, 'detectionDate')} FROM anomaly_fact""",
    "anomalies_with_previous_costs": f"""
      , totals AS (SELECT f.subscriptionKey, d."date", sum(f.actualCost) AS c FROM fact f JOIN dim_date d USING (dateKey) GROUP BY ALL)
      SELECT a.dateKey, a.subscriptionKey, {m('a.actualCost')}, {r('a.zScore', 'zScore')}, a.isAnomaly,
        {m('d1.c', 'previousDayCost')}, {m('d7.c', 'previousWeekCost')}, {m('dm.c', 'previousMonthCost')}
      FROM anomaly_fact a JOIN dim_date d USING (dateKey)
      LEFT JOIN totals d1 ON d1.subscriptionKey = a.subscriptionKey AND d1."date" = d."date" - 1
      LEFT JOIN totals d7 ON d7.subscriptionKey = a.subscriptionKey AND d7."date" = d."date" - 7
      LEFT JOIN totals dm ON dm.subscriptionKey = a.subscriptionKey AND dm."date" = CAST(d."date" - INTERVAL 1 MONTH AS DATE)""",
    "generate_rightsizing": f"""
      SELECT {_OPPORTUNITY}, 0.0::DOUBLE AS realizedMonthlySavings, 0.0::DOUBLE AS realizedAnnualSavings FROM rightsizing""",
    "process_advisor_update": f"""
      SELECT {_OPPORTUNITY}, 0.0::DOUBLE AS realizedMonthlySavings, 0.0::DOUBLE AS realizedAnnualSavings,
        CASE WHEN modified THEN '2001-08-01 00:00:00' END AS rowModifiedDate FROM updated""",
    "process_advisor_insert": f"""
      SELECT {_OPPORTUNITY}, 0.0::DOUBLE AS realizedMonthlySavings, 0.0::DOUBLE AS realizedAnnualSavings FROM inserted""",
    "aggregate_daily_metrics": f"""SELECT {_ROLLUP} FROM util WHERE "date" >= {NOW} - INTERVAL 7 DAY""",
    "utilization_upsert": f"""SELECT {_ROLLUP} FROM util WHERE resourceKey IS NOT NULL""",
    "cost_data": f"""{_COST_ROWS} WHERE d."date" >= {NOW} - INTERVAL 30 DAY AND d."date" <= {NOW}""",
    "cost_data_by_range": _COST_ROWS,
    "cost_data_by_resource": f"""
      SELECT r.resourceId, r.resourceName, r.resourceType, {day('d."date"', 'date')}, {m('f.actualCost')}, {m('f.amortizedCost')},
        {m('f.actualCost', 'costInUSD')}, {m('f.usageQuantity')}, {m('f.effectivePrice')}, m.meterCategory, m.serviceName
      FROM fact f JOIN dim_resource r ON f.resourceKey = r.resourceKey AND r.isCurrent
      JOIN dim_meter m ON f.meterKey = m.meterKey JOIN dim_date d ON f.dateKey = d.dateKey""",
    "total_cost": f"SELECT {m('coalesce(sum(f.actualCost), 0)', 'totalCost')} FROM {_JOINED}",
    "cost_by_service": f"""
      SELECT m.serviceName, {m('sum(f.actualCost)', 'totalCost')} FROM {_JOINED} JOIN dim_meter m ON f.meterKey = m.meterKey GROUP BY ALL""",
    "cost_by_resource_group": f"""
      SELECT r.resourceGroupName, {m('sum(f.actualCost)', 'totalCost')}
      FROM {_JOINED} JOIN dim_resource r ON f.resourceKey = r.resourceKey AND r.isCurrent GROUP BY ALL""",
    "anomalous_cost_data": f"""
      , daily AS (SELECT dateKey, resourceKey, sum(actualCost) AS c FROM fact GROUP BY ALL),
      rolled AS (SELECT *, avg(CAST(c AS DOUBLE)) OVER w AS mean, stddev_samp(CAST(c AS DOUBLE)) OVER w AS sd FROM daily
        WINDOW w AS (PARTITION BY resourceKey ORDER BY dateKey ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)),
      odd AS (SELECT *, abs((CAST(c AS DOUBLE) - mean) / sd) AS z FROM rolled WHERE sd > 0 AND abs((CAST(c AS DOUBLE) - mean) / sd) >= 2.0 AND c >= 10)
      SELECT r.resourceId, r.resourceName, {day('d."date"', 'date')}, {m('f.actualCost')}, {m('f.amortizedCost')},
        {m('f.actualCost', 'costInUSD')}, m.meterCategory, m.serviceName, {r('o.z', 'zScore')},
        printf('Z-Score: %.2f', o.z) AS additionalInfo
      FROM fact f JOIN odd o ON f.dateKey = o.dateKey AND f.resourceKey = o.resourceKey
      JOIN dim_resource r ON f.resourceKey = r.resourceKey AND r.isCurrent
      JOIN dim_date d ON f.dateKey = d.dateKey JOIN dim_meter m ON f.meterKey = m.meterKey""",
    "detect_anomalies": f"SELECT {_FOUND} FROM found",
    "anomaly_result_records": f"""
      SELECT resourceId AS resource_id, subscriptionId AS subscription_id, {day('"date"', 'date')}, {m('actualCost', 'actual_cost')},
        {r('mean', 'expected_cost')}, {r('delta', 'variance')}, {r('CASE WHEN mean > 0 THEN delta / mean * 100 ELSE 0 END', 'variance_percentage')},
        {r('z', 'z_score')}, CASE WHEN actualCost > mean THEN 'Spike' ELSE 'Drop' END AS anomaly_type, severity, TRUE AS is_anomaly,
        {r('least(1.0, abs(z) / 3.0)', 'confidence')}, '2001-08-01T00:00:00' AS detected_at FROM found""",
    "anomaly_severity_counts": """
      SELECT s.severity, count(f.severity) AS alertCount FROM (VALUES ('High'), ('Medium'), ('Low')) s(severity)
      LEFT JOIN found f ON f.severity = s.severity GROUP BY s.severity""",
    "anomaly_run_summary": """
      SELECT 30 AS analysis_period_days, (SELECT count(DISTINCT resourceId) FROM fact) AS total_resources_analyzed,
        count(*) AS anomalies_detected, count(*) FILTER (severity = 'High') AS alerts_high,
        count(*) FILTER (severity = 'Medium') AS alerts_medium, count(*) FILTER (severity = 'Low') AS alerts_low FROM found""",
    "anomaly_request": f"""
      , days30 AS (SELECT r.resourceId, d."date", sum(f.actualCost) AS actualCost, min(r.subscriptionId) AS subscriptionId
        FROM fact f JOIN dim_resource r ON f.resourceKey = r.resourceKey AND r.isCurrent JOIN dim_date d USING (dateKey)
        WHERE d."date" BETWEEN {NOW} - INTERVAL 30 DAY AND {NOW} GROUP BY r.resourceId, d."date"),
      learned AS (SELECT resourceId, avg(c) AS mean, stddev_pop(c) AS sd FROM (
        SELECT resourceId, CAST(actualCost AS DOUBLE) AS c, row_number() OVER (PARTITION BY resourceId ORDER BY "date" DESC) AS back,
          count(*) OVER (PARTITION BY resourceId) AS n FROM days30) WHERE n >= 7 AND back > 1 GROUP BY resourceId),
      judged AS (SELECT x.*, mean, CAST(actualCost AS DOUBLE) - mean AS delta, (CAST(actualCost AS DOUBLE) - mean) / sd AS z
        FROM days30 x JOIN learned USING (resourceId) WHERE sd > 0)
      SELECT {_FOUND.replace(', severity,', """, CASE WHEN abs(z) >= 3 OR abs(delta) >= 1000 THEN 'High'
        WHEN abs(z) >= 2 OR abs(delta) >= 100 THEN 'Medium' ELSE 'Low' END AS severity,""")}
      FROM judged WHERE abs(z) >= 2 AND actualCost >= 10""",
    "anomaly_high_severity": f"""
      SELECT resourceId AS resource_id, {day('"date"', 'date')}, {m('actualCost', 'actual_cost')}, {r('mean', 'expected_cost')},
        {r('CASE WHEN mean > 0 THEN delta / mean * 100 ELSE 0 END', 'variance_percentage')}, {r('z', 'z_score')}
      FROM found WHERE severity = 'High'""",
    "dim_date": f"""
      SELECT dateKey, {day('"date"', 'date')}, "year", "month", "day", "quarter", yearMonth, "year" || '-Q' || "quarter" AS yearQuarter,
        {day('billingPeriodStart', 'billingPeriodStart')}, {day('billingPeriodEnd', 'billingPeriodEnd')},
        CAST(dayofweek("date") AS INTEGER) + 1 AS dayOfWeek, dayname("date") AS dayOfWeekName, dayofweek("date") IN (0, 6) AS isWeekend,
        "date" = billingPeriodEnd AS isMonthEnd, "date" = billingPeriodEnd AND "month" % 3 = 0 AS isQuarterEnd,
        "date" = billingPeriodEnd AND "month" = 12 AS isYearEnd
      FROM dim_date WHERE dateKey BETWEEN (SELECT min(dateKey) FROM fact) AND (SELECT max(dateKey) FROM fact)""",
    "stream_daily_metrics": f"""SELECT {_ROLLUP} FROM util WHERE resourceKey IS NOT NULL""",
}

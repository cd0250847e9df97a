"""The cost star in SQL."""

from __future__ import annotations

NOW = "TIMESTAMP '2001-08-01 00:00:00'"


def m(expr: str, name: str | None = None) -> str:
    """Exact money or price as DOUBLE."""
    return f'CAST({expr} AS DOUBLE) AS "{name or expr.split(".")[-1]}"'


def r(expr: str, name: str) -> str:
    """Computed ratio, six digits."""
    return f'ROUND(CAST({expr} AS DOUBLE), 6) AS "{name}"'


def price(expr: str, name: str) -> str:
    """Average of a six-digit price, half up in whole millionths."""
    return (f'CAST((CAST(sum({expr}) * 1000000 AS HUGEINT) * 2 + count({expr})) // (2 * count({expr})) AS DOUBLE)'
            f' / 1000000 AS "{name}"')


def day(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS \"{name}\""


def ts(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS \"{name}\""


CORE = f"""
fact AS (
  SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS dateKey,
         l_suppkey AS resourceKey, s_nationkey + 1 AS subscriptionKey, n_regionkey + 1 AS regionKey,
         l_partkey AS meterKey,
         CASE l_returnflag WHEN 'R' THEN 1 + l_linenumber % 4 WHEN 'A' THEN 5 + l_linenumber % 4 END AS benefitKey,
         '/res/' || l_suppkey AS resourceId, 'sub-' || s_nationkey AS subscriptionId,
         CAST(l_quantity AS DECIMAL(18,6)) AS usageQuantity,
         CAST(floor(l_extendedprice / l_quantity * 1000000 + 0.5) / 1000000 AS DECIMAL(18,6)) AS effectivePrice,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS actualCost,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amortizedCost,
         l_returnflag = 'R' AS isReservationCharge, l_returnflag = 'A' AS isSavingsPlanCharge,
         l_linestatus AS chargeType
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS dateKey, d AS "date",
         CAST(year(d) AS INTEGER) AS "year", CAST(month(d) AS INTEGER) AS "month",
         CAST(day(d) AS INTEGER) AS "day", CAST(quarter(d) AS INTEGER) AS "quarter",
         strftime(d, '%Y-%m') AS yearMonth, CAST(date_trunc('month', d) AS DATE) AS billingPeriodStart,
         last_day(d) AS billingPeriodEnd
  FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
),
dim_subscription AS (
  SELECT n_nationkey + 1 AS subscriptionKey, 'sub-' || n_nationkey AS subscriptionId,
         n_name AS subscriptionName, r_name AS businessUnit
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
dim_resource AS (
  SELECT s_suppkey AS resourceKey, '/res/' || s_suppkey AS resourceId, s_name AS resourceName,
         CASE s_suppkey % 3 WHEN 0 THEN 'virtualMachines' WHEN 1 THEN 'sites' ELSE 'databases' END AS resourceType,
         n_name AS resourceGroupName, 'sub-' || n_nationkey AS subscriptionId, n_name AS subscriptionName,
         r_name AS location, 'env-' || (s_suppkey % 3) AS env, 'app-' || (s_suppkey % 7) AS app,
         n_name AS team, 'cc-' || n_nationkey AS costCenter, r_name AS businessUnit,
         s_suppkey % 10 <> 9 AS isCurrent
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
dim_meter AS (
  SELECT p_partkey AS meterKey, p_type AS meterCategory,
         CASE WHEN p_size % 5 <> 0 THEN p_brand END AS meterSubCategory, p_brand AS serviceName
  FROM part
),
dim_benefit AS (
  SELECT k AS benefitKey, CASE WHEN k <= 4 THEN 'Reservation' ELSE 'SavingsPlan' END AS benefitType,
         'product-' || k AS productName, CASE WHEN k % 2 = 1 THEN '1Year' ELSE '3Years' END AS term,
         CASE WHEN (k - 1) % 4 < 2 THEN 'Single' ELSE 'Shared' END AS scope,
         CASE (k - 1) % 4 WHEN 0 THEN 60 WHEN 1 THEN 80 WHEN 2 THEN 100 END AS utilizationPercentage
  FROM range(1, 9) t(k)
),
metrics AS (
  SELECT '/res/' || res AS resourceId, 'sub-' || (res % 25) AS subscriptionId, 'rg-' || (res % 25) AS resourceGroup,
         CASE event_type WHEN 'view' THEN 'Percentage CPU' WHEN 'click' THEN 'Available Memory Bytes'
              WHEN 'purchase' THEN 'Disk Read Operations' WHEN 'signup' THEN 'Network In Total'
              WHEN 'error' THEN 'Http Errors' END AS metricName,
         CASE event_id % 6 WHEN 0 THEN 'Microsoft.Compute/virtualMachines' WHEN 1 THEN 'Microsoft.Web/sites'
              WHEN 2 THEN 'Microsoft.Sql/servers' WHEN 3 THEN 'Microsoft.Storage/storageAccounts'
              WHEN 4 THEN 'Microsoft.Network/loadBalancers' ELSE 'Custom/other' END AS metricNamespace,
         CASE event_id % 4 WHEN 0 THEN 'PT1M' WHEN 1 THEN 'PT5M' WHEN 2 THEN 'PT15M' ELSE 'PT1H' END AS timeGrain,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'Total' ELSE 'Average' END AS aggregationType,
         ts - INTERVAL 8218 DAY AS startTime,
         CAST(CASE WHEN event_type = 'view' THEN value / 5 ELSE value END AS DECIMAL(18,6)) AS metricValue,
         CASE event_type WHEN 'click' THEN 'Bytes' WHEN 'view' THEN 'Percent' ELSE 'Count' END AS unit,
         '{{"TotalMemory": ' || (CAST(json_extract_string(props, '$.k') AS INTEGER) * 10 + 500) || '}}' AS dimensions
  FROM (SELECT *, user_id % (SELECT count(*) FROM supplier) AS res FROM events)
),
metric_pct AS (
  SELECT *, CASE WHEN metricName = 'Available Memory Bytes' AND unit = 'Bytes' THEN
       CASE WHEN whole > 0 THEN (CAST(whole AS DOUBLE) - CAST(metricValue AS DOUBLE)) / CAST(whole AS DOUBLE) * 100 END
     END AS memoryPct
  FROM (SELECT *, TRY_CAST(json_extract_string(dimensions, '$.TotalMemory') AS DECIMAL(18,0)) AS whole FROM metrics)
),
advice_raw AS (
  SELECT 'rec-' || p_partkey AS id, '/res/' || res AS resourceId, 'resource ' || res AS resourceName,
         'rg-' || (res % 25) AS resourceGroup, 'sub-' || (res % 25) AS subscriptionId,
         CASE WHEN p_partkey % 4 = 0 THEN 'Performance' ELSE 'Cost' END AS category,
         CASE p_size % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS impact,
         CASE p_type WHEN 'ECONOMY' THEN 'IdleVm' WHEN 'LARGE' THEN 'RightSizeVm' WHEN 'MEDIUM' THEN 'ReservedVm'
              WHEN 'PROMO' THEN 'SpotVm' WHEN 'SMALL' THEN 'UnattachedDisk' WHEN 'STANDARD' THEN 'PremiumDisk' END AS recommendationTypeId,
         'Advice on ' || p_name AS shortDescription,
         CASE p_partkey % 5 WHEN 0 THEN 'Save $' || (p_size * 30) || '.50 per month'
              WHEN 1 THEN 'Save $' || (p_size * 30) || '.00' WHEN 2 THEN '$1,234 a year'
              WHEN 3 THEN CASE WHEN p_size % 2 = 0 THEN 'No direct savings' ELSE '$ 5' END
              ELSE '$' || (p_size * 30) || '.00   ' END AS benefits,
         TIMESTAMP '2001-06-01' + to_days(CAST(p_partkey % 60 AS INTEGER)) AS createdTime,
         TIMESTAMP '2001-06-01' + to_days(CAST(p_partkey % 60 AS INTEGER)) + to_hours(p_size) AS lastUpdated,
         CASE WHEN p_partkey % 7 = 0 THEN 'Dismissed' ELSE 'Active' END AS status
  FROM (SELECT *, p_partkey % (SELECT count(*) FROM supplier) AS res FROM part)
),
advice AS (
  SELECT *, CASE WHEN benefits LIKE '%$%' THEN
              TRY_CAST(regexp_extract(substr(benefits, strpos(benefits, '$') + 1, 50), '^([0-9.]*)', 1) AS DECIMAL(18,2))
              ELSE 0 END AS potentialMonthlySavings,
         CASE WHEN recommendationTypeId LIKE '%Idle%' THEN 'Idle Resources'
              WHEN recommendationTypeId LIKE '%RightSize%' THEN 'Right Size'
              WHEN recommendationTypeId LIKE '%Reserved%' THEN 'Reserved Instances'
              WHEN recommendationTypeId LIKE '%Spot%' THEN 'Spot Instances'
              WHEN recommendationTypeId LIKE '%Unattached%' THEN 'Unattached Resources'
              WHEN recommendationTypeId LIKE '%Premium%' THEN 'Premium Tier Optimization' ELSE 'Other' END AS recommendationCategory,
         CASE WHEN impact = 'High' AND strict > 1000 THEN 'Critical' WHEN impact = 'High' OR strict > 500 THEN 'High'
              WHEN impact = 'Medium' OR strict > 100 THEN 'Medium' ELSE 'Low' END AS priority
  FROM (SELECT *, CASE WHEN benefits LIKE '%$%' THEN
          TRY_CAST(substr(benefits, strpos(benefits, '$') + 1, 10) AS DECIMAL(18,2)) ELSE 0 END AS strict FROM advice_raw)
  WHERE category = 'Cost' AND status = 'Active'
),
current_key AS (SELECT resourceId, min(resourceKey) AS resourceKey FROM dim_resource WHERE isCurrent GROUP BY resourceId),
rollup_all AS (
  SELECT CAST(startTime AS DATE) AS "date", resourceId,
         CAST(sum(CASE WHEN metricName = 'Percentage CPU' THEN metricValue END) AS DOUBLE)
           / count(CASE WHEN metricName = 'Percentage CPU' THEN 1 END) AS avgCpuPercentage,
         max(CASE WHEN metricName = 'Percentage CPU' THEN metricValue END) AS maxCpuPercentage,
         avg(memoryPct) AS avgMemoryPercentage, max(memoryPct) AS maxMemoryPercentage,
         avg(CASE WHEN metricName LIKE '%Disk%' AND aggregationType = 'Total' THEN CAST(metricValue AS DOUBLE) END) AS avgDiskIOPS,
         max(CASE WHEN metricName LIKE '%Disk%' AND aggregationType = 'Total' THEN metricValue END) AS maxDiskIOPS,
         avg(CASE WHEN metricName LIKE '%Network%' AND aggregationType = 'Total' THEN CAST(metricValue AS DOUBLE) END) AS avgNetworkIOPS,
         max(CASE WHEN metricName LIKE '%Network%' AND aggregationType = 'Total' THEN metricValue END) AS maxNetworkIOPS,
         count(CASE WHEN metricName = 'Percentage CPU' THEN 1 END) * CASE max(timeGrain)
           WHEN 'PT1M' THEN 1.0::DOUBLE / 60 WHEN 'PT5M' THEN 5.0::DOUBLE / 60 WHEN 'PT15M' THEN 15.0::DOUBLE / 60
           ELSE 1.0::DOUBLE END AS uptimeHours
  FROM metric_pct GROUP BY ALL
),
util AS (
  SELECT CAST(strftime("date", '%Y%m%d') AS INTEGER) AS dateKey, k.resourceKey, u.*,
         CASE WHEN avgCpuPercentage < 5 THEN 95.0 WHEN avgCpuPercentage < 20 THEN 80.0
              WHEN avgCpuPercentage < 50 THEN 50.0 ELSE 10.0 END AS idlePercentage,
         95.0 AS availabilityPercentage
  FROM rollup_all u LEFT JOIN current_key k USING (resourceId)
),
util_view AS (
  SELECT d."date", u.resourceKey, r.resourceId, r.resourceName, r.resourceType, r.subscriptionName, r.businessUnit,
         r.team, r.costCenter, u.avgCpuPercentage, u.maxCpuPercentage, u.avgMemoryPercentage, u.maxMemoryPercentage,
         u.idlePercentage, u.uptimeHours, u.availabilityPercentage, c.totalCost,
         CASE WHEN c.totalCost > 0 AND u.avgCpuPercentage > 0 THEN CAST(c.totalCost AS DOUBLE) / u.avgCpuPercentage ELSE 0 END AS costPerCpuPercent,
         CASE WHEN u.avgCpuPercentage < 20 THEN 'Underutilized' WHEN u.avgCpuPercentage > 80 THEN 'Overutilized' ELSE 'Optimal' END AS utilizationStatus
  FROM util u JOIN dim_date d ON u.dateKey = d.dateKey JOIN dim_resource r ON u.resourceKey = r.resourceKey AND r.isCurrent
  LEFT JOIN (SELECT dateKey, resourceKey, sum(actualCost) AS totalCost FROM fact GROUP BY ALL) c
    ON u.dateKey = c.dateKey AND u.resourceKey = c.resourceKey
  WHERE d."date" >= {NOW} - INTERVAL 30 DAY
),
rightsizing AS (
  SELECT row_number() OVER () AS opp, (SELECT max(dateKey) FROM dim_date WHERE "date" <= {NOW}) AS dateKey, resourceKey, resourceId,
         'RightSize' AS recommendationType,
         'Resource has been underutilized for 7+ days. Consider downsizing.' AS recommendationDescription,
         CAST(totalCost * 0.3 AS DECIMAL(18,2)) AS potentialMonthlySavings,
         CAST(totalCost * 0.3 * 12 AS DECIMAL(18,2)) AS potentialAnnualSavings,
         'Pending' AS status, CASE WHEN totalCost > 1000 THEN 'High' WHEN totalCost > 100 THEN 'Medium' ELSE 'Low' END AS priority,
         DATE '2001-08-01' AS recommendationDate
  FROM util_view WHERE utilizationStatus = 'Underutilized' AND avgCpuPercentage < 20 AND totalCost > 50
),
advised AS (
  SELECT s.*, a.id, a.shortDescription, a.potentialMonthlySavings AS advisedSavings, a.status AS advisedStatus, a.priority AS advisedPriority
  FROM rightsizing s LEFT JOIN (
    SELECT opp, a.* FROM rightsizing so JOIN advice a ON so.resourceId = a.resourceId
     AND (a.recommendationTypeId LIKE '%' || so.recommendationType || '%'
          OR (so.recommendationType = 'RightSize' AND a.recommendationCategory = 'Right Size')
          OR (so.recommendationType = 'Idle' AND a.recommendationCategory = 'Idle Resources'))
    QUALIFY row_number() OVER (PARTITION BY opp ORDER BY a.lastUpdated DESC, a.id) = 1) a ON s.opp = a.opp
),
updated AS (
  SELECT dateKey, resourceKey, resourceId, recommendationType,
         coalesce(recommendationDescription, shortDescription) AS recommendationDescription,
         CASE WHEN advisedSavings > 0 THEN advisedSavings ELSE potentialMonthlySavings END AS potentialMonthlySavings,
         CASE WHEN advisedSavings > 0 THEN advisedSavings * 12 ELSE potentialAnnualSavings END AS potentialAnnualSavings,
         CASE advisedStatus WHEN 'Dismissed' THEN 'Rejected' WHEN 'Postponed' THEN 'Pending' ELSE status END AS status,
         coalesce(advisedPriority, priority) AS priority, recommendationDate, id IS NOT NULL AS modified
  FROM advised
),
inserted AS (
  SELECT d.dateKey, k.resourceKey, a.resourceId, a.recommendationCategory AS recommendationType,
         a.shortDescription AS recommendationDescription, a.potentialMonthlySavings,
         a.potentialMonthlySavings * 12 AS potentialAnnualSavings, 'Pending' AS status, a.priority,
         CAST(a.createdTime AS DATE) AS recommendationDate
  FROM advice a LEFT JOIN dim_date d ON d."date" = CAST(a.createdTime AS DATE) LEFT JOIN current_key k ON k.resourceId = a.resourceId
  WHERE a.potentialMonthlySavings > 0 AND NOT EXISTS (
    SELECT 1 FROM updated so WHERE so.resourceId = a.resourceId AND so.recommendationType = a.recommendationCategory
      AND so.status IN ('Pending', 'InProgress', 'Completed'))
),
savings AS (
  SELECT dateKey, resourceKey, resourceId, recommendationType, recommendationDescription, potentialMonthlySavings,
         potentialAnnualSavings, CAST(0 AS DECIMAL(18,2)) AS realizedMonthlySavings,
         CAST(0 AS DECIMAL(18,2)) AS realizedAnnualSavings, status, priority, recommendationDate FROM updated
  UNION ALL
  SELECT dateKey, resourceKey, resourceId, recommendationType, recommendationDescription, potentialMonthlySavings,
         potentialAnnualSavings, 0, 0, status, priority, recommendationDate FROM inserted
),
sub_days AS (
  SELECT dateKey, subscriptionKey, sum(actualCost) AS dailyCost FROM fact
  WHERE dateKey >= (SELECT min(dateKey) FROM dim_date WHERE "date" >= {NOW} - INTERVAL 30 DAY)
  GROUP BY dateKey, subscriptionKey
),
sub_stats AS (
  SELECT subscriptionKey, avg(CAST(dailyCost AS DOUBLE)) AS avgCost, stddev_samp(CAST(dailyCost AS DOUBLE)) AS stdCost
  FROM sub_days GROUP BY subscriptionKey
),
sub_scored AS (
  SELECT d.*, s.avgCost, CAST(dailyCost AS DOUBLE) - avgCost AS variance,
         CASE WHEN stdCost > 0 THEN (CAST(dailyCost AS DOUBLE) - avgCost) / stdCost ELSE 0 END AS z
  FROM sub_days d JOIN sub_stats s ON d.subscriptionKey = s.subscriptionKey
),
anomaly_fact AS (
  SELECT dateKey, CAST(NULL AS BIGINT) AS resourceKey, subscriptionKey, dailyCost AS actualCost, avgCost AS expectedCost,
         variance AS costVariance, CASE WHEN avgCost > 0 THEN variance / avgCost * 100 ELSE 0 END AS variancePercentage,
         z AS zScore, CASE WHEN dailyCost > avgCost THEN 'Spike' ELSE 'Drop' END AS anomalyType,
         CASE WHEN abs(z) >= 3 THEN 'High' WHEN abs(z) >= 2 THEN 'Medium' ELSE 'Low' END AS severity,
         abs(z) >= 2.0 AND dailyCost >= 10 AS isAnomaly
  FROM sub_scored
),
month_total AS (
  SELECT s.subscriptionId, s.subscriptionName, d."year" * 12 + d."month" AS idx, sum(f.actualCost) AS cost
  FROM fact f JOIN dim_date d USING (dateKey) JOIN dim_subscription s USING (subscriptionKey) GROUP BY ALL
),
budget AS (
  SELECT subscriptionId, idx + 1 AS idx, CAST(cost * 0.9 AS DECIMAL(18,2)) AS budgetAmount FROM month_total
),
res_days AS (
  SELECT f.resourceId, d."date", sum(f.actualCost) AS actualCost, min(f.subscriptionId) AS subscriptionId
  FROM fact f JOIN dim_date d USING (dateKey) GROUP BY ALL
),
detected AS (
  SELECT c.resourceId, c.subscriptionId, c."date", c.actualCost, s.mean, (CAST(c.actualCost AS DOUBLE) - s.mean) / s.sd AS z
  FROM res_days c JOIN (
    SELECT resourceId, avg(CAST(actualCost AS DOUBLE)) FILTER (rn > 1) AS mean,
           stddev_pop(CAST(actualCost AS DOUBLE)) FILTER (rn > 1) AS sd, count(*) AS n
    FROM (SELECT *, row_number() OVER (PARTITION BY resourceId ORDER BY "date" DESC) AS rn FROM res_days) GROUP BY resourceId) s
    ON c.resourceId = s.resourceId
  WHERE s.n >= 7 AND s.sd > 0 AND abs((CAST(c.actualCost AS DOUBLE) - s.mean) / s.sd) >= 2.0 AND c.actualCost >= 10
),
found AS (
  SELECT *, CAST(actualCost AS DOUBLE) - mean AS delta,
         CASE WHEN abs(z) >= 3 OR abs(CAST(actualCost AS DOUBLE) - mean) >= 1000 THEN 'High'
              WHEN abs(z) >= 2 OR abs(CAST(actualCost AS DOUBLE) - mean) >= 100 THEN 'Medium' ELSE 'Low' END AS severity
  FROM detected
)
"""


def statement(select: str) -> str:
    """A select over the star; text that starts with a comma adds its own expressions first."""
    return f"WITH {CORE}\n{select.strip()}"

"""Table schemas of the cost warehouse, as Spark types.

Values fixed by the data model: table names, column names and column types.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import StructType

MONEY = "decimal(18,2)"
PRICE = "decimal(18,6)"

_DDL = {
    "dim_date": """dateKey int, date date, year int, month int, day int, quarter int,
        yearMonth string, yearQuarter string, billingPeriodStart date, billingPeriodEnd date,
        dayOfWeek int, dayOfWeekName string, isWeekend boolean, isMonthEnd boolean,
        isQuarterEnd boolean, isYearEnd boolean""",
    "dim_resource": """resourceKey bigint, resourceId string, resourceName string, resourceType string,
        resourceGroupName string, subscriptionId string, subscriptionName string, location string,
        sku string, capacity string, env string, app string, team string, costCenter string,
        ownerUpn string, businessUnit string, project string, service string, compliance string,
        dataSensitivity string, createdDate date, deletedDate date, effectiveStartDate timestamp_ntz,
        effectiveEndDate timestamp_ntz, isCurrent boolean, rowCreatedDate timestamp_ntz,
        rowModifiedDate timestamp_ntz""",
    "dim_subscription": """subscriptionKey int, subscriptionId string, subscriptionName string,
        tenantId string, billingAccountId string, billingAccountName string, billingProfileId string,
        billingProfileName string, invoiceSectionId string, invoiceSectionName string,
        offerType string, currency string, isActive boolean, createdDate date, businessUnit string,
        rowCreatedDate timestamp_ntz""",
    "dim_resource_group": """resourceGroupKey int, resourceGroupName string, subscriptionId string,
        location string, env string, app string, team string, costCenter string,
        businessUnit string, project string, rowCreatedDate timestamp_ntz""",
    "dim_region": """regionKey int, regionName string, regionDisplayName string, country string,
        continent string, timeZone string, rowCreatedDate timestamp_ntz""",
    "dim_meter": """meterKey bigint, meterId string, meterName string, meterCategory string,
        meterSubCategory string, serviceName string, serviceTier string, serviceFamily string,
        unitOfMeasure string, unitPrice decimal(18,6), currency string, rowCreatedDate timestamp_ntz""",
    "dim_offer": """offerKey int, offerId string, offerName string, offerType string,
        pricingModel string, isAzureCreditEligible boolean, rowCreatedDate timestamp_ntz""",
    "dim_benefit": """benefitKey int, reservationId string, reservationName string,
        benefitType string, productName string, term string, scope string, instanceSize string,
        region string, quantity int, utilizationPercentage decimal(5,2),
        monthlySavings decimal(18,2), rowCreatedDate timestamp_ntz""",
    "dim_tag_kv": """tagKey int, tagKeyName string, tagValue string, tagCategory string,
        isRequired boolean, rowCreatedDate timestamp_ntz""",
    "fact_cost_daily": """dateKey int, resourceKey bigint, subscriptionKey int, resourceGroupKey int,
        regionKey int, meterKey bigint, offerKey int, benefitKey int, resourceId string,
        subscriptionId string, meterId string, billingPeriodStartDate date,
        billingPeriodEndDate date, usageQuantity decimal(18,6), effectivePrice decimal(18,6),
        unitPrice decimal(18,6), actualCost decimal(18,2), amortizedCost decimal(18,2),
        costInBillingCurrency decimal(18,2), costInUSD decimal(18,2), exchangeRate decimal(18,6),
        isReservationCharge boolean, isSavingsPlanCharge boolean, isCredit boolean,
        isRefund boolean, chargeType string, frequency string, invoiceId string,
        additionalInfo string, rowCreatedDate timestamp_ntz""",
    "fact_utilization_daily": """dateKey int, resourceKey bigint, resourceId string,
        avgCpuPercentage decimal(5,2), maxCpuPercentage decimal(5,2),
        avgMemoryPercentage decimal(5,2), maxMemoryPercentage decimal(5,2),
        avgDiskIOPS decimal(18,2), maxDiskIOPS decimal(18,2), avgNetworkIOPS decimal(18,2),
        maxNetworkIOPS decimal(18,2), avgThroughput decimal(18,2), maxThroughput decimal(18,2),
        idlePercentage decimal(5,2), uptimeHours decimal(8,2), downtimeHours decimal(8,2),
        availabilityPercentage decimal(5,2), rowCreatedDate timestamp_ntz""",
    "fact_savings_opportunity": """dateKey int, resourceKey bigint, resourceId string,
        recommendationType string, recommendationDescription string,
        potentialMonthlySavings decimal(18,2), potentialAnnualSavings decimal(18,2),
        realizedMonthlySavings decimal(18,2), realizedAnnualSavings decimal(18,2), status string,
        priority string, estimatedImplementationHours int, actualImplementationHours int,
        recommendationDate date, implementationDate date, rowCreatedDate timestamp_ntz,
        rowModifiedDate timestamp_ntz""",
    "fact_anomaly_daily": """dateKey int, resourceKey bigint, subscriptionKey int,
        actualCost decimal(18,2), expectedCost decimal(18,2), costVariance decimal(18,2),
        variancePercentage double, zScore double, anomalyType string, severity string,
        isAnomaly boolean, previousDayCost decimal(18,2), previousWeekCost decimal(18,2),
        previousMonthCost decimal(18,2), detectionDate timestamp_ntz, rowCreatedDate timestamp_ntz""",
    "fact_forecast_daily": """dateKey int, subscriptionKey int, forecastedCost decimal(18,2),
        confidenceIntervalLower decimal(18,2), confidenceIntervalUpper decimal(18,2),
        p50Forecast decimal(18,2), p90Forecast decimal(18,2), modelType string,
        modelAccuracy decimal(5,2), forecastHorizonDays int, forecastDate timestamp_ntz,
        rowCreatedDate timestamp_ntz""",
    "raw_advisor_recommendations": """id string, resourceId string, resourceName string,
        resourceType string, resourceGroup string, subscriptionId string, category string,
        impact string, recommendationTypeId string, shortDescription string,
        longDescription string, potentialBenefits string, actions string, remediation string,
        metadata string, createdTime timestamp_ntz, lastUpdated timestamp_ntz, status string,
        extendedProperties string, rowCreatedDate timestamp_ntz""",
    "raw_metrics_data": """id string, resourceId string, metricName string, metricNamespace string,
        timeGrain string, aggregationType string, startTime timestamp_ntz, endTime timestamp_ntz,
        metricValue decimal(18,6), unit string, dimensions string, subscriptionId string,
        resourceGroup string, location string, rowCreatedDate timestamp_ntz""",
    "budget_alert": """budgetName string, threshold string, currentSpend double,
        budgetAmount double, subscriptionId string, subscriptionName string,
        timeGenerated string""",
    "budget": """subscriptionId string, year int, month int, budgetAmount decimal(18,2)""",
}


@cache
def schema(table: str) -> StructType:
    """The declared schema of a table (needs a running session)."""
    return StructType.fromDDL(_DDL[table])


# Facts are laid out by day, so date bounds prune directories and upserts rewrite only touched days.
PARTITION_COLUMN = {name: "dateKey" for name in _DDL if name.startswith("fact_")}

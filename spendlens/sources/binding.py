"""Adapter from the order/event sample tables to the cost star.

The star's tables are projections of the sample tables; nothing is stored. Each table is built
when it is first asked for. Constants below are the definition of the mapping.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import at_hand, date_key_of, stamp
from ..functions.dates import date_key, days_before
from ..functions.metrics import CPU, FREE_MEMORY, NAMESPACES
from ..operators.anomaly import detect_cost_anomalies
from ..operators.calendar import calendar_between
from ..operators.recommendations import advisor_insert, advisor_update, generate_rightsizing
from ..operators.rollup import aggregate_daily_metrics, storable
from ..star import Star

AS_OF = datetime(2001, 8, 1)
FIRST_DAY = date(1995, 1, 1)
LAST_DAY = date(2001, 12, 31)
END = datetime(2001, 12, 31)
# Days between the first event (2024-01-01) and the day it stands for (2001-07-02).
EVENT_SHIFT_DAYS = 8218

METRIC_BY_EVENT = {
    "view": CPU,
    "click": FREE_MEMORY,
    "purchase": "Disk Read Operations",
    "signup": "Network In Total",
    "error": "Http Errors",
}
GRAINS = ("PT1M", "PT5M", "PT15M", "PT1H")
TYPE_ID_BY_PART = {
    "ECONOMY": "IdleVm",
    "LARGE": "RightSizeVm",
    "MEDIUM": "ReservedVm",
    "PROMO": "SpotVm",
    "SMALL": "UnattachedDisk",
    "STANDARD": "PremiumDisk",
}
IMPACTS = ("High", "Medium", "Low")

_SAMPLE_SCHEMAS = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}
# So many suppliers go to every task that joins them to lines.
FEW_SUPPLIERS = 2_000_000
_SUPPLIER_COLUMNS = {"subscriptionKey", "subscriptionId", "resourceGroupKey", "regionKey"}


def _pick(names, number: Column) -> Column:
    chain = F
    for i, name in enumerate(names):
        chain = chain.when(number == i, name)
    return chain.otherwise(None)


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    chain = F
    for name, value in mapping.items():
        chain = chain.when(key == name, value)
    return chain.otherwise(None)


def metric_samples(events: DataFrame, resources: Column | int) -> DataFrame:
    """``raw_metrics_data`` rows from event rows (batch or stream); ``resources`` is the number of
    resources the users are spread over."""
    kind, number = F.col("event_type"), F.col("event_id")
    resource = F.col("user_id") % resources
    start = F.col("ts") - F.expr(f"INTERVAL {EVENT_SHIFT_DAYS} DAYS")
    reading = F.when(kind == "view", F.col("value") / 5).otherwise(F.col("value"))
    memory = F.get_json_object("props", "$.k").cast("int") * 10 + 500
    return events.select(
        F.concat(F.lit("m-"), number).alias("id"),
        F.concat(F.lit("/res/"), resource).alias("resourceId"),
        _lookup(METRIC_BY_EVENT, kind).alias("metricName"),
        F.coalesce(_pick(NAMESPACES, number % 6), F.lit("Custom/other")).alias("metricNamespace"),
        _pick(GRAINS, number % 4).alias("timeGrain"),
        F.when(kind.isin("purchase", "signup"), "Total").otherwise("Average").alias("aggregationType"),
        start.alias("startTime"),
        (start + F.expr("INTERVAL 1 MINUTE")).alias("endTime"),
        reading.cast("decimal(18,6)").alias("metricValue"),
        F.when(kind == "click", "Bytes").when(kind == "view", "Percent").otherwise("Count").alias("unit"),
        F.concat(F.lit('{"TotalMemory": '), memory, F.lit("}")).alias("dimensions"),
        F.concat(F.lit("sub-"), resource % 25).alias("subscriptionId"),
        F.concat(F.lit("rg-"), resource % 25).alias("resourceGroup"),
        F.lit(None).cast("string").alias("location"),
    )


class BoundStar(Star):
    """The cost star over a directory of sample tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark = spark
        self.sf_dir = sf_dir

    def sample(self, name: str) -> DataFrame:
        return self.spark.read.schema(_SAMPLE_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def suppliers_at_hand(self) -> DataFrame:
        """The suppliers, broadcast to joins if they are few: lines that go out as they are, to be
        written, are not shuffled."""
        return at_hand(self.sample("supplier"), FEW_SUPPLIERS)

    def sample_stream(self, name: str) -> DataFrame:
        """The same file as a file stream."""
        return (
            self.spark.readStream.schema(_SAMPLE_SCHEMAS[name])
            .option("pathGlobFilter", f"{name}.parquet").parquet(self.sf_dir)
        )

    # --- cost -------------------------------------------------------------------------------

    def cost(self, columns, since=None, until=None, suppliers=None):
        """Dates become bounds on the ship date, so they reach the scan; the supplier join is left
        out unless a column needs it (every line's supplier exists). ``suppliers``: the table to join."""
        rows = self.sample("lineitem")
        if since is not None:
            rows = rows.filter(F.col("l_shipdate") >= stamp(datetime(since.year, since.month, since.day)))
        if until is not None:
            rows = rows.filter(F.col("l_shipdate") < stamp(days_before(until, -1)))
        if _SUPPLIER_COLUMNS & set(columns):
            rows = rows.join(
                (self.sample("supplier") if suppliers is None else suppliers).select(
                    F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey"
            )
        if "regionKey" in columns:
            rows = rows.join(
                self.sample("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey"), "s_nationkey"
            )
        definitions = self._cost_columns()
        return rows.select([definitions[c].alias(c) for c in columns])

    @cached_property
    def fact_cost_daily(self) -> DataFrame:
        return self.cost(list(self._cost_columns()))

    @staticmethod
    def _cost_columns() -> dict[str, Column]:
        c = F.col
        price, quantity = c("l_extendedprice"), c("l_quantity")
        # Price less discount in whole cents, half up: integer arithmetic and one conversion.
        cents = F.floor(price * 100 + 0.5) * (100 - F.floor(c("l_discount") * 100 + 0.5))
        actual = (F.floor((cents + 50) / 100) / 100).cast("decimal(18,2)")
        amount = price.cast("decimal(18,2)")
        unit_price = (F.floor(price / quantity * 1000000 + 0.5) / 1000000).cast("decimal(18,6)")
        line = (c("l_linenumber") % 4).cast("int")
        return {
            "dateKey": date_key_of(c("l_shipdate")),
            "resourceKey": c("l_suppkey"),
            "subscriptionKey": c("s_nationkey") + 1,
            "resourceGroupKey": c("s_nationkey") + 1,
            "regionKey": c("n_regionkey") + 1,
            "meterKey": c("l_partkey"),
            "offerKey": F.lit(1),
            "benefitKey": F.when(c("l_returnflag") == "R", line + 1).when(c("l_returnflag") == "A", line + 5),
            "resourceId": F.concat(F.lit("/res/"), c("l_suppkey")),
            "subscriptionId": F.concat(F.lit("sub-"), c("s_nationkey")),
            "meterId": F.concat(F.lit("meter-"), c("l_partkey")),
            "billingPeriodStartDate": F.trunc(c("l_shipdate"), "month"),
            "billingPeriodEndDate": F.last_day(c("l_shipdate")),
            "usageQuantity": quantity.cast("decimal(18,6)"),
            "effectivePrice": unit_price,
            "unitPrice": unit_price,
            "actualCost": actual,
            "amortizedCost": amount,
            "costInBillingCurrency": actual,
            "costInUSD": actual,
            "exchangeRate": F.lit(1).cast("decimal(18,6)"),
            "isReservationCharge": c("l_returnflag") == "R",
            "isSavingsPlanCharge": c("l_returnflag") == "A",
            "isCredit": F.lit(False),
            "isRefund": F.lit(False),
            "chargeType": c("l_linestatus"),
            "frequency": F.lit("UsageBased"),
            "invoiceId": F.lit(None).cast("string"),
            "additionalInfo": F.lit(None).cast("string"),
        }

    # --- dimensions -------------------------------------------------------------------------

    @cached_property
    def dim_date(self) -> DataFrame:
        return calendar_between(self.spark, FIRST_DAY, LAST_DAY)

    @cached_property
    def _nations(self) -> DataFrame:
        return self.sample("nation").join(
            self.sample("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    @cached_property
    def dim_subscription(self) -> DataFrame:
        return self._nations.select(
            (F.col("n_nationkey") + 1).alias("subscriptionKey"),
            F.concat(F.lit("sub-"), F.col("n_nationkey")).alias("subscriptionId"),
            F.col("n_name").alias("subscriptionName"),
            F.lit("USD").alias("currency"),
            F.lit(True).alias("isActive"),
            F.col("r_name").alias("businessUnit"),
        )

    @cached_property
    def dim_resource_group(self) -> DataFrame:
        return self._nations.select(
            (F.col("n_nationkey") + 1).alias("resourceGroupKey"),
            F.col("n_name").alias("resourceGroupName"),
            F.concat(F.lit("sub-"), F.col("n_nationkey")).alias("subscriptionId"),
            F.col("r_name").alias("location"),
            F.col("r_name").alias("businessUnit"),
        )

    @cached_property
    def dim_region(self) -> DataFrame:
        return self.sample("region").select(
            (F.col("r_regionkey") + 1).alias("regionKey"),
            F.col("r_name").alias("regionName"),
            F.initcap("r_name").alias("regionDisplayName"),
        )

    @cached_property
    def dim_resource(self) -> DataFrame:
        key, nation = F.col("s_suppkey"), F.col("n_nationkey")
        kinds = ("virtualMachines", "sites", "databases")
        return self.sample("supplier").join(
            self._nations, F.col("s_nationkey") == nation
        ).select(
            key.alias("resourceKey"),
            F.concat(F.lit("/res/"), key).alias("resourceId"),
            F.col("s_name").alias("resourceName"),
            _pick(kinds, key % 3).alias("resourceType"),
            F.col("n_name").alias("resourceGroupName"),
            F.concat(F.lit("sub-"), nation).alias("subscriptionId"),
            F.col("n_name").alias("subscriptionName"),
            F.col("r_name").alias("location"),
            F.concat(F.lit("env-"), key % 3).alias("env"),
            F.concat(F.lit("app-"), key % 7).alias("app"),
            F.col("n_name").alias("team"),
            F.concat(F.lit("cc-"), nation).alias("costCenter"),
            F.lit(None).cast("string").alias("ownerUpn"),
            F.col("r_name").alias("businessUnit"),
            F.lit(None).cast("string").alias("project"),
            F.lit(None).cast("string").alias("service"),
            F.lit(None).cast("string").alias("compliance"),
            F.lit(None).cast("string").alias("dataSensitivity"),
            (key % 10 != 9).alias("isCurrent"),
        )

    @cached_property
    def dim_meter(self) -> DataFrame:
        return self.sample("part").select(
            F.col("p_partkey").alias("meterKey"),
            F.concat(F.lit("meter-"), F.col("p_partkey")).alias("meterId"),
            F.col("p_name").alias("meterName"),
            F.col("p_type").alias("meterCategory"),
            F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).alias("meterSubCategory"),
            F.col("p_brand").alias("serviceName"),
            F.lit(None).cast("string").alias("serviceTier"),
            F.col("p_type").alias("serviceFamily"),
            F.lit("1 Hour").alias("unitOfMeasure"),
            F.col("p_retailprice").cast("decimal(18,6)").alias("unitPrice"),
            F.lit("USD").alias("currency"),
        )

    @cached_property
    def dim_offer(self) -> DataFrame:
        return self.spark.range(1).select(
            F.lit(1).alias("offerKey"), F.lit("offer-1").alias("offerId"), F.lit("Default").alias("offerName")
        )

    @cached_property
    def dim_benefit(self) -> DataFrame:
        """Keys 1-4 are reservations, 5-8 savings plans; utilization cycles 60, 80, 100, NULL."""
        key = F.col("id").cast("int")
        turn = (F.col("id") - 1) % 4
        return self.spark.range(1, 9).select(
            key.alias("benefitKey"),
            F.when(key <= 4, "Reservation").otherwise("SavingsPlan").alias("benefitType"),
            F.concat(F.lit("product-"), key).alias("productName"),
            F.when(key % 2 == 1, "1Year").otherwise("3Years").alias("term"),
            F.when(turn < 2, "Single").otherwise("Shared").alias("scope"),
            F.when(turn == 0, 60).when(turn == 1, 80).when(turn == 2, 100)
            .cast("decimal(5,2)").alias("utilizationPercentage"),
        )

    @cached_property
    def dim_tag_kv(self) -> DataFrame:
        """Tag values in use; environment and team are required."""
        tags = self.dim_resource.select(F.explode(F.create_map(
            F.lit("Environment"), F.col("env"), F.lit("Application"), F.col("app"), F.lit("Team"), F.col("team")
        )).alias("tagKeyName", "tagValue")).distinct()
        return tags.withColumn("isRequired", F.col("tagKeyName").isin("Environment", "Team"))

    # --- landing tables ---------------------------------------------------------------------

    def _resource_count(self) -> Column:
        return self.sample("supplier").agg(F.count(F.lit(1))).scalar()

    def metrics(self, since=None):
        """The bound reaches the event scan as a bound on the event time."""
        events = self.sample("events")
        if since is not None:
            events = events.filter(F.col("ts") >= stamp(days_before(since, -EVENT_SHIFT_DAYS)))
        return metric_samples(events, self._resource_count())

    @cached_property
    def raw_metrics_data(self) -> DataFrame:
        return self.metrics()

    @cached_property
    def raw_advisor_recommendations(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        resource = key % self._resource_count()
        amount = (size * 30).cast("string")
        shape = key % 5
        benefits = (
            F.when(shape == 0, F.concat(F.lit("Save $"), amount, F.lit(".50 per month")))
            .when(shape == 1, F.concat(F.lit("Save $"), amount, F.lit(".00")))
            .when(shape == 2, F.lit("$1,234 a year"))
            .when(shape == 3, F.when(size % 2 == 0, "No direct savings").otherwise("$ 5"))
            .otherwise(F.concat(F.lit("$"), amount, F.lit(".00   ")))
        )
        created = stamp(datetime(2001, 6, 1)) + F.make_dt_interval(key % 60)
        return self.sample("part").select(
            F.concat(F.lit("rec-"), key).alias("id"),
            F.concat(F.lit("/res/"), resource).alias("resourceId"),
            F.concat(F.lit("resource "), resource).alias("resourceName"),
            F.lit("virtualMachines").alias("resourceType"),
            F.concat(F.lit("rg-"), resource % 25).alias("resourceGroup"),
            F.concat(F.lit("sub-"), resource % 25).alias("subscriptionId"),
            F.when(key % 4 == 0, "Performance").otherwise("Cost").alias("category"),
            _pick(IMPACTS, size % 3).alias("impact"),
            _lookup(TYPE_ID_BY_PART, F.col("p_type")).alias("recommendationTypeId"),
            F.concat(F.lit("Advice on "), F.col("p_name")).alias("shortDescription"),
            F.lit(None).cast("string").alias("longDescription"),
            benefits.alias("potentialBenefits"),
            F.lit("[]").alias("actions"),
            F.lit(None).cast("string").alias("remediation"),
            created.alias("createdTime"),
            (created + F.make_dt_interval(F.lit(0), size)).alias("lastUpdated"),
            F.when(key % 7 == 0, "Dismissed").otherwise("Active").alias("status"),
        )

    # --- derived facts ----------------------------------------------------------------------

    @cached_property
    def fact_utilization_daily(self) -> DataFrame:
        """As if the rollup had run on every day of the history."""
        return storable(aggregate_daily_metrics(self, AS_OF, days=None))

    def utilization(self, since=None, until=None):
        """A lower bound limits the samples that are rolled up at all."""
        if since is None:
            return super().utilization(since, until)
        first = datetime(since.year, since.month, since.day)
        rows = storable(aggregate_daily_metrics(self, first, days=0))
        return rows if until is None else rows.filter(F.col("dateKey") <= date_key(until))

    @cached_property
    def fact_anomaly_daily(self) -> DataFrame:
        return detect_cost_anomalies(self, AS_OF)

    @cached_property
    def seeded_opportunities(self) -> DataFrame:
        """The opportunities before any advisor data arrived."""
        return generate_rightsizing(self, AS_OF)

    @cached_property
    def fact_savings_opportunity(self) -> DataFrame:
        """Rightsizing rows, updated by the advisor, plus the new advisor rows."""
        before = self.with_tables(fact_savings_opportunity=self.seeded_opportunities)
        updated = advisor_update(before, AS_OF)
        return updated.unionByName(advisor_insert(self, updated), allowMissingColumns=True)

    @cached_property
    def budgets(self) -> DataFrame:
        """Per subscription and month: nine tenths of the total of the month before."""
        months = self.cost(["dateKey", "subscriptionKey", "actualCost"]).groupBy(
            "subscriptionKey", F.floor(F.col("dateKey") / 100).alias("yearMonth")
        ).agg(F.sum("actualCost").alias("cost"))
        first_day = F.make_date(F.floor(F.col("yearMonth") / 100).cast("int"), (F.col("yearMonth") % 100).cast("int"), F.lit(1))
        following = F.add_months(first_day, 1)
        return months.join(self.dim_subscription.select("subscriptionKey", "subscriptionId"), "subscriptionKey").select(
            "subscriptionId", F.year(following).alias("year"), F.month(following).alias("month"),
            (F.col("cost") * F.lit("0.9").cast("decimal(2,1)")).cast("decimal(18,2)").alias("budgetAmount"),
        )

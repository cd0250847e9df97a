"""Loading cost exports into the star: dimension members, resource versions, cost rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import at_hand, conform, date_key_of, stamp
from ..functions.dates import date_key
from ..functions.staging import shuffles_removed, staged
from ..operators.calendar import calendar_of
from ..operators.costs import TAG_COLUMNS
from ..schema import schema
from ..sources.exports import latest_export, read_export
from ..sources.lake import Lake

NUMBERING_BUCKETS = 1024
# Members of a dimension that are looked up without a shuffle of the rows.
FEW_MEMBERS = 500_000
# A load writes its days in slices: bytes of the staged export in one, and their greatest number.
SLICE_BYTES = 64 << 20
SLICES = 16
# The member of rows whose export names none.
UNKNOWN = "(unknown)"
# Attributes whose change opens a new resource version.
TRACKED = [
    "resourceName", "resourceType", "resourceGroupName", "subscriptionId", "subscriptionName", "location",
    *TAG_COLUMNS.values(),
]


def _names(natural_key: str | Sequence[str]) -> list[str]:
    return [natural_key] if isinstance(natural_key, str) else list(natural_key)


def numbered(members: DataFrame, natural_key: str | Sequence[str], surrogate_key: str, start: Column) -> DataFrame:
    """Dense surrogate keys ``start + 1 ..`` for distinct ``members``, the same on every run.

    Members are numbered inside hash buckets; a bucket's offset is the size of the buckets before
    it. No task sees more than one bucket, the offsets are one small row per bucket.
    """
    bucketed = members.withColumn("_bucket", F.pmod(F.xxhash64(*_names(natural_key)), F.lit(NUMBERING_BUCKETS)))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(*_names(natural_key)))
    return (
        bucketed.withColumn("_position", position).join(F.broadcast(offsets), "_bucket")
        .withColumn(surrogate_key, start + F.col("_offset") + F.col("_position"))
        .drop("_bucket", "_position", "_offset")
    )


def _last_key(existing: DataFrame, surrogate_key: str) -> Column:
    return existing.agg(F.coalesce(F.max(surrogate_key), F.lit(0))).scalar()


def new_members(existing: DataFrame, incoming: DataFrame, natural_key: str | Sequence[str],
                surrogate_key: str) -> DataFrame:
    """Members of ``incoming`` (one row per natural key) that the dimension lacks, with keys."""
    names = _names(natural_key)
    unknown = incoming.dropna(subset=names).join(existing.select(*names), names, "left_anti")
    return numbered(unknown, natural_key, surrogate_key, _last_key(existing, surrogate_key))


def resource_versions(existing: DataFrame, incoming: DataFrame, as_of: datetime,
                      tracked: Sequence[str] = tuple(TRACKED)) -> DataFrame:
    """The resource dimension after a load: a changed resource closes its current version and opens
    a new one, an unknown resource opens its first, everything else stays."""
    now = stamp(as_of)
    columns = existing.columns
    compared = [c for c in tracked if c in incoming.columns]
    arriving = incoming.select("resourceId", F.struct(*compared).alias("_arriving"))
    marked = existing.join(arriving, "resourceId", "left")
    changed = F.col("isCurrent") & F.col("_arriving").isNotNull() & ~F.struct(*compared).eqNullSafe(F.col("_arriving"))
    kept = marked.withColumn("_closed", changed).select(
        *[
            F.when(F.col("_closed"), {"isCurrent": F.lit(False)}.get(c, now)).otherwise(F.col(c)).alias(c)
            if c in ("isCurrent", "effectiveEndDate", "rowModifiedDate") else F.col(c)
            for c in columns
        ]
    )
    unchanged = (
        marked.filter("isCurrent").filter(~changed).select("resourceId")
    )
    opened = numbered(
        incoming.join(unchanged, "resourceId", "left_anti"), "resourceId", "resourceKey",
        _last_key(existing, "resourceKey"),
    ).withColumns({
        "effectiveStartDate": now, "isCurrent": F.lit(True), "rowCreatedDate": now, "rowModifiedDate": now,
    })
    missing = [c for c in columns if c not in opened.columns]
    opened = opened.withColumns({c: F.lit(None).cast(existing.schema[c].dataType) for c in missing}) if missing else opened
    return kept.unionByName(opened.select(*columns))


def _latest(rows: DataFrame, natural_key: str | Sequence[str], **columns: Column) -> DataFrame:
    """One row per natural key with the attributes of its latest day. Raw rows are first reduced to
    the distinct attribute combinations; ties between those go to the largest in text order."""
    names = _names(natural_key)
    combinations = (
        rows.dropna(subset=names)
        .groupBy(*names, *[c.alias(n) for n, c in columns.items()]).agg(F.max("Date").alias("_day"))
    )
    attributes = F.struct(*columns)
    return (
        combinations.groupBy(*names)
        .agg(F.max_by(attributes, F.struct("_day", F.to_json(attributes))).alias("_row"))
        .select(*names, "_row.*")
    )


def resources_of(export: DataFrame) -> DataFrame:
    tags = F.from_json("Tags", "map<string,string>")
    rows = export.withColumn("ResourceId", F.lower("ResourceId"))
    return _latest(
        rows, "ResourceId",
        resourceName=F.element_at(F.split("ResourceId", "/"), -1),
        resourceType=F.coalesce("ServiceName", F.lit("")),
        resourceGroupName=F.coalesce("ResourceGroup", F.lit("")),
        subscriptionId=F.col("SubscriptionId"), subscriptionName=F.col("SubscriptionName"),
        location=F.col("Location"),
        **{column: tags[name] for name, column in TAG_COLUMNS.items()},
    ).withColumnRenamed("ResourceId", "resourceId")


def subscriptions_of(export: DataFrame) -> DataFrame:
    return _latest(
        export, "SubscriptionId", subscriptionName=F.col("SubscriptionName"),
        billingAccountId=F.col("BillingAccountId"), billingAccountName=F.col("BillingAccountName"),
        billingProfileId=F.col("BillingProfileId"), billingProfileName=F.col("BillingProfileName"),
        invoiceSectionName=F.col("InvoiceSection"), currency=F.col("BillingCurrency"), isActive=F.lit(True),
    ).withColumnRenamed("SubscriptionId", "subscriptionId")


def meters_of(export: DataFrame) -> DataFrame:
    return _latest(
        export, "MeterId", meterName=F.col("MeterName"), meterCategory=F.col("MeterCategory"),
        meterSubCategory=F.col("MeterSubCategory"), serviceName=F.col("ServiceName"),
        serviceTier=F.col("ServiceTier"), serviceFamily=F.col("ServiceFamily"),
        unitOfMeasure=F.col("UnitOfMeasure"), unitPrice=F.col("UnitPrice"), currency=F.col("BillingCurrency"),
    ).withColumnRenamed("MeterId", "meterId")


def resource_groups_of(export: DataFrame) -> DataFrame:
    """Groups of two subscriptions may bear one name."""
    return _latest(export, ["ResourceGroup", "SubscriptionId"], location=F.col("Location")).withColumnsRenamed(
        {"ResourceGroup": "resourceGroupName", "SubscriptionId": "subscriptionId"})


def regions_of(export: DataFrame) -> DataFrame:
    return _latest(export, "Location", regionDisplayName=F.col("Location")).withColumnRenamed("Location", "regionName")


def offers_of(export: DataFrame) -> DataFrame:
    return _latest(export, "OfferId", pricingModel=F.col("PricingModel"),
                   isAzureCreditEligible=F.col("IsAzureCreditEligible")).withColumnRenamed("OfferId", "offerId")


def benefits_of(export: DataFrame) -> DataFrame:
    return _latest(
        export, "ReservationId", reservationName=F.col("ReservationName"),
        benefitType=F.when(F.col("PricingModel") == "SavingsPlan", "SavingsPlan").otherwise("Reservation"),
    ).withColumnRenamed("ReservationId", "reservationId")


def with_unknown(export: DataFrame) -> DataFrame:
    """Rows that name no resource, subscription or meter belong to a member of that name."""
    return export.withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in ("ResourceId", "SubscriptionId", "MeterId")})


def cost_rows(export: DataFrame, lake: Lake) -> DataFrame:
    """Export rows as cost facts, one for one. Dimension keys are looked up by natural key; the
    current resource version is taken. A key without a member stays NULL. Lookups see each value of a
    row once; columns that repeat it are made after them."""
    plan = F.col("PricingModel") == "SavingsPlan"
    reserved = F.col("reservationId").isNotNull()
    rows = export.select(
        "Date", F.lower("ResourceId").alias("resourceId"), F.col("SubscriptionId").alias("subscriptionId"),
        F.col("MeterId").alias("meterId"), F.col("ResourceGroup").alias("resourceGroupName"),
        F.col("Location").alias("regionName"), F.col("OfferId").alias("offerId"),
        F.col("ReservationId").alias("reservationId"), "BillingPeriodStartDate", "BillingPeriodEndDate",
        "Quantity", "EffectivePrice", "UnitPrice", "CostInBillingCurrency", "CostInUSD", "ExchangeRate",
        "PricingModel", "ChargeType", "Frequency", "InvoiceId", "AdditionalInfo",
    )
    lookups = (
        (lake.read("dim_resource").filter("isCurrent"), "resourceId", "resourceKey"),
        (lake.read("dim_subscription"), "subscriptionId", "subscriptionKey"),
        (lake.read("dim_meter"), "meterId", "meterKey"),
        (lake.read("dim_resource_group"), ["resourceGroupName", "subscriptionId"], "resourceGroupKey"),
        (lake.read("dim_region"), "regionName", "regionKey"),
        (lake.read("dim_offer"), "offerId", "offerKey"),
        (lake.read("dim_benefit"), "reservationId", "benefitKey"),
    )
    for dimension, natural_key, surrogate_key in lookups:
        names = _names(natural_key)
        rows = rows.join(at_hand(dimension.select(*names, surrogate_key), FEW_MEMBERS), names, "left")
    return rows.select(
        *[key for _, _, key in lookups], "resourceId", "subscriptionId", "meterId", "resourceGroupName", "regionName",
        "offerId", "reservationId", "Date",
        date_key_of(F.col("Date")).alias("dateKey"),
        F.col("BillingPeriodStartDate").alias("billingPeriodStartDate"),
        F.col("BillingPeriodEndDate").alias("billingPeriodEndDate"),
        F.col("Quantity").alias("usageQuantity"), F.col("EffectivePrice").alias("effectivePrice"),
        F.col("UnitPrice").alias("unitPrice"), F.col("CostInBillingCurrency").alias("actualCost"),
        F.col("CostInBillingCurrency").alias("amortizedCost"),
        F.col("CostInBillingCurrency").alias("costInBillingCurrency"), F.col("CostInUSD").alias("costInUSD"),
        F.col("ExchangeRate").alias("exchangeRate"),
        (reserved & ~F.coalesce(plan, F.lit(False))).alias("isReservationCharge"),
        F.coalesce(plan, F.lit(False)).alias("isSavingsPlanCharge"),
        F.lit(False).alias("isCredit"), (F.coalesce("ChargeType", F.lit("")) == "Refund").alias("isRefund"),
        F.col("ChargeType").alias("chargeType"), F.col("Frequency").alias("frequency"),
        F.col("InvoiceId").alias("invoiceId"), F.col("AdditionalInfo").alias("additionalInfo"),
    )


def beside(facts: DataFrame, lake: Lake) -> DataFrame:
    """Stored facts of the days in ``facts`` that belong to subscriptions which it lacks on that day:
    a load replaces the days of its own subscriptions only."""
    touched = facts.select("dateKey", "subscriptionKey").distinct()
    stored = lake.read("fact_cost_daily").join(touched.select("dateKey").distinct(), "dateKey", "left_semi")
    return stored.join(touched, ["dateKey", "subscriptionKey"], "left_anti")


def day_slices(export: DataFrame) -> list[tuple[date | None, date | None]]:
    """The days of a staged export in slices of about SLICE_BYTES, SLICES at most: the first day and the
    first day after. Rows without a day are in the first slice. The driver sees one number per day."""
    size = int(str(export._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    number = min(SLICES, size // SLICE_BYTES + 1)
    days = export.groupBy("Date").agg(F.count(F.lit(1)).alias("rows")).orderBy("Date").collect()
    total, seen, cuts = sum(d["rows"] for d in days), 0, []
    for d in days:
        if seen and d["Date"] is not None and seen * number >= total * (len(cuts) + 1):
            cuts.append(d["Date"])
        seen += d["rows"]
    return list(zip([None, *cuts], [*cuts, None])) if days else []


def _within(column: Column, first, after) -> Column:
    """Whether a value lies in a slice (see ``day_slices``)."""
    if first is not None:
        return (column >= first) & (column < after if after is not None else F.lit(True))
    return column.isNull() | (column < after) if after is not None else F.lit(True)


def load_exports(lake: Lake, as_of: datetime, path: str | None = None) -> dict[str, int]:
    """Read the exports, extend the dimensions, replace the days the exports cover, subscription by
    subscription. The days are written slice by slice, so what is shuffled for them is a part of the
    whole; a load that was broken off is repeated as it is. ``unknown_members``: cost rows that named no
    resource, subscription or meter."""
    with shuffles_removed(lake.spark):
        return _load(lake, as_of, path or lake.export_path())


def _load(lake: Lake, as_of: datetime, path: str) -> dict[str, int]:
    newest = latest_export(read_export(lake.spark, path)).drop("exportTime")
    export = staged(with_unknown(newest), "export", "zstd")
    written = {}
    for table, members, natural_key, surrogate_key in (
        ("dim_subscription", subscriptions_of, "subscriptionId", "subscriptionKey"),
        ("dim_meter", meters_of, "meterId", "meterKey"),
        ("dim_resource_group", resource_groups_of, ["resourceGroupName", "subscriptionId"], "resourceGroupKey"),
        ("dim_region", regions_of, "regionName", "regionKey"),
        ("dim_offer", offers_of, "offerId", "offerKey"),
        ("dim_benefit", benefits_of, "reservationId", "benefitKey"),
    ):
        rows = new_members(lake.read(table), members(export), natural_key, surrogate_key)
        written[table] = lake.append(table, rows.withColumn("rowCreatedDate", stamp(as_of)))
    versions = resource_versions(lake.read("dim_resource"), resources_of(export), as_of)
    written["dim_resource"] = lake.replace("dim_resource", versions)
    days = calendar_of(export, "Date").join(lake.read("dim_date").select("dateKey"), "dateKey", "left_anti")
    written["dim_date"] = lake.append("dim_date", days)
    owners = lake.read("dim_subscription").select(F.col("subscriptionId").alias("SubscriptionId"), "subscriptionKey")
    covered = staged(export.select(date_key_of(F.col("Date")).alias("dateKey"), "SubscriptionId").distinct()
                     .join(owners, "SubscriptionId", "left").select("dateKey", "subscriptionKey").distinct(), "covered")
    kept = staged(beside(covered, lake), "kept")
    written["unknown_members"] = export.filter(
        (F.col("ResourceId") == UNKNOWN) | (F.col("SubscriptionId") == UNKNOWN) | (F.col("MeterId") == UNKNOWN)).count()
    facts = cost_rows(export, lake).withColumn("rowCreatedDate", stamp(as_of))
    for first, after in day_slices(export):
        bounds = [day and date_key(day) for day in (first, after)]
        lake.replace_days("fact_cost_daily", conform(facts.filter(_within(F.col("Date"), first, after)), schema("fact_cost_daily")).unionByName(
            kept.filter(_within(F.col("dateKey"), *bounds))))
    days, stored = covered.select(F.col("dateKey").alias("_day")).distinct(), lake.read("fact_cost_daily")
    written["fact_cost_daily"] = stored.join(
        F.broadcast(days), F.col("dateKey").eqNullSafe(F.col("_day")), "left_semi").count() - kept.count()
    return written

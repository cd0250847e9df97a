"""Write jobs, ingestion and streams on real folders."""

from __future__ import annotations

import random
import re
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from stars import NOW, by, cost_row, sample, small_star, table

from spendlens.operators import anomaly, kpis, quality, recommendations, rollup
from spendlens.plans import ingest, jobs
from spendlens.schema import schema
from spendlens.sources.exports import EXPORT_COLUMNS, latest_export, read_export
from spendlens.functions.staging import work_folder
from spendlens.sources.lake import Lake, LakeStar, landed_json
from spendlens.streaming import alerts as alert_streams
from spendlens.streaming import metrics as metric_streams


def advice(number, resource, type_id, benefits, updated=1, **more):
    return {"id": f"rec-{number}", "resourceId": resource, "resourceName": "r", "category": "Cost", "impact": "High",
            "recommendationTypeId": type_id, "shortDescription": f"text {number}", "potentialBenefits": benefits,
            "createdTime": datetime(2024, 3, 1), "lastUpdated": datetime(2024, 3, updated), "status": "Active", **more}


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    star = small_star(
        spark,
        cost=[cost_row(date(2024, 3, 1) + timedelta(days=i), 100 + i, resource=2 - i % 2) for i in range(14)],
        metrics=[sample("/res/1", "Percentage CPU", 4), sample("/res/2", "Percentage CPU", 60),
                 sample("/gone", "Percentage CPU", 60)],
        advice=[advice(1, "/res/1", "RightSizeVm", "$900.00", 1), advice(2, "/res/1", "RightSizeVm", "$800.00", 2),
                advice(3, "/res/1", "RightSizeVm", "$700.00", 2), advice(4, "/res/2", "IdleVm", "$50"),
                advice(5, "/res/2", "Spot", "nothing"), advice(6, "/gone", "Spot", "$5")],
    )
    for name in ("dim_date", "dim_resource", "dim_subscription", "dim_meter", "fact_cost_daily", "raw_metrics_data",
                 "raw_advisor_recommendations"):
        lake.append(name, getattr(star, name))
    return lake


def test_daily_chain_is_idempotent(lake):
    first = jobs.daily_chain(lake, NOW)
    assert first == {"utilization": 2, "rightsizing": 1, "updated": 1, "advised": 4, "anomalies": 14}
    opportunities = by(lake.read("fact_savings_opportunity"), "recommendationType")
    sized = opportunities["RightSize"]
    assert (sized.potentialMonthlySavings, sized.potentialAnnualSavings, sized.priority) == (800, 9600, "High")
    assert sized.recommendationDescription == recommendations.RIGHT_SIZE_TEXT and sized.rowModifiedDate == NOW
    # advisor categories carry other names than opportunity types, so they are added beside them
    assert set(opportunities) == {"RightSize", "Right Size", "Idle Resources"}
    before = {t: sorted(map(str, lake.read(t).drop("rowModifiedDate").collect())) for t in (
        "fact_utilization_daily", "fact_savings_opportunity", "fact_anomaly_daily")}
    second = jobs.daily_chain(lake, NOW)
    assert (second["rightsizing"], second["advised"], second["anomalies"]) == (0, 0, 0)
    after = {t: sorted(map(str, lake.read(t).drop("rowModifiedDate").collect())) for t in before}
    assert before == after


def test_upsert_keeps_keys_unique_and_other_days(lake, spark):
    jobs.run_rollup(lake, NOW)
    old = table(spark, "fact_utilization_daily", [
        {"dateKey": 20240301, "resourceKey": 1, "resourceId": "/res/1", "avgCpuPercentage": 1, "downtimeHours": 3}])
    lake.append("fact_utilization_daily", old)
    late = table(spark, "raw_metrics_data", [sample("/res/1", "Percentage CPU", 8)])
    lake.append("raw_metrics_data", late)
    jobs.run_rollup(lake, NOW)
    rows = by(lake.read("fact_utilization_daily"), "dateKey", "resourceKey")
    assert float(rows[20240314, 1].avgCpuPercentage) == 6.0 and float(rows[20240301, 1].avgCpuPercentage) == 1.0
    assert quality.duplicate_keys(lake.read("fact_utilization_daily"), *rollup.KEYS).count() == 0


def test_forecast_is_replaced_by_a_later_run(lake):
    assert jobs.run_forecast(lake, NOW) == 3 and jobs.run_forecast(lake, NOW) == 3
    rows = by(lake.read("fact_forecast_daily"), "forecastHorizonDays")
    assert len(rows) == 3 and rows[30].dateKey == 20240414 and lake.read("fact_forecast_daily").count() == 3
    assert rows[30].p90Forecast >= rows[30].forecastedCost == rows[30].p50Forecast


def test_merge_leaves_unlisted_columns(spark):
    target = spark.createDataFrame([(1, 1, "a", 5), (1, 2, "b", 6)], "dateKey int, resourceKey int, note string, v int")
    source = spark.createDataFrame([(1, 2, "x", 7), (1, 3, "y", 8)], "dateKey int, resourceKey int, note string, v int")
    rows = sorted(map(tuple, rollup.upserted(target, source, rollup.KEYS, ["v"]).collect()))
    assert rows == [(1, 1, "a", 5), (1, 2, "b", 7), (1, 3, "y", 8)]


def test_advisor_update_equals_brute_force(spark):
    """Many opportunities and recommendations on one resource; every pair is tried in plain Python."""
    rng = random.Random(3)
    kinds, types = ["RightSize", "Idle", "Spot", "Vm", "Nothing"], ["RightSizeVm", "IdleVm", "SpotVm", "Disk", "IdleRightSize"]
    recs = [advice(i, rng.choice(["/res/1", "/res/2"]), rng.choice(types), f"${rng.randint(0, 3) * 100}", rng.randint(1, 4),
                   impact=rng.choice(["High", "Low"])) for i in range(60)]
    saved = [{"dateKey": 20240301, "resourceKey": 1, "resourceId": rng.choice(["/res/1", "/res/1", "/res/2"]),
              "recommendationType": rng.choice(kinds), "potentialMonthlySavings": i, "potentialAnnualSavings": 12 * i,
              "status": "Pending", "priority": "Low", "recommendationDate": date(2024, 3, 1)} for i in range(1, 80)]
    star = small_star(spark, advice=recs, savings=saved)
    rows = {int(r.potentialAnnualSavings): r for r in recommendations.advisor_update(star, NOW).withColumn(
        "potentialAnnualSavings", F.col("potentialAnnualSavings")).collect()}
    category = {"RightSizeVm": "Right Size", "IdleVm": "Idle Resources", "SpotVm": "Spot Instances", "Disk": "Other",
                "IdleRightSize": "Idle Resources"}
    expected = []
    for s in saved:
        hits = [r for r in recs if r["resourceId"] == s["resourceId"] and (
            s["recommendationType"] in r["recommendationTypeId"]
            or (s["recommendationType"] == "RightSize" and category[r["recommendationTypeId"]] == "Right Size")
            or (s["recommendationType"] == "Idle" and category[r["recommendationTypeId"]] == "Idle Resources"))]
        best = min(hits, key=lambda r: (-r["lastUpdated"].day, r["id"])) if hits else None
        amount = int(best["potentialBenefits"][1:]) if best else 0
        expected.append((s["resourceId"], s["recommendationType"], float(amount or s["potentialMonthlySavings"]),
                         best["shortDescription"] if best else None))
    actual = [(r.resourceId, r.recommendationType, float(r.potentialMonthlySavings), r.recommendationDescription)
              for r in recommendations.advisor_update(star, NOW).collect()]
    assert sorted(map(str, actual)) == sorted(map(str, expected)) and rows


def test_advisor_status_is_translated(spark):
    saved = [{"dateKey": 20240301, "resourceKey": 1, "resourceId": f"/res/{i}", "recommendationType": "Spot", "potentialMonthlySavings": 1,
              "potentialAnnualSavings": 12, "status": "InProgress", "priority": "Low", "recommendationDate": date(2024, 3, 1)} for i in (1, 2, 3)]
    star = small_star(spark, savings=saved)
    recs = spark.createDataFrame(
        [(f"r{i}", f"/res/{i}", "SpotVm", "Spot Instances", status, 5.0, "High") for i, status in ((1, "Dismissed"), (2, "Postponed"))],
        "id string, resourceId string, recommendationTypeId string, recommendationCategory string, status string, "
        "potentialMonthlySavings double, priority string",
    ).withColumns({"potentialMonthlySavings": F.col("potentialMonthlySavings").cast("decimal(18,2)"), "lastUpdated": F.lit(NOW),
                   "createdTime": F.lit(NOW), "shortDescription": F.lit("text")})
    rows = by(recommendations.advisor_update(star, NOW, recs), "resourceId")
    assert [rows[f"/res/{i}"].status for i in (1, 2, 3)] == ["Rejected", "Pending", "InProgress"]
    assert (rows["/res/1"].potentialAnnualSavings, rows["/res/3"].potentialAnnualSavings) == (60, 12)
    added = by(recommendations.advisor_insert(star, None, recs), "resourceId")
    assert [added[f"/res/{i}"].status for i in (1, 2)] == ["Rejected", "Pending"]


def test_detection_request(lake, spark):
    costs = [cost_row(date(2024, 3, 1) + timedelta(days=i), 5000 if i == 6 else 100 + i % 3, resource=2, subscription=2) for i in range(14)]
    lake.append("fact_cost_daily", table(spark, "fact_cost_daily", costs))
    out = jobs.run_detection_request(lake, NOW, "sub-2")
    assert "anomaly-results-20240315-000000" in out["results"]
    saved = spark.read.json(out["results"]).collect()
    assert [(r.resource_id, r.date, r.severity, r.anomaly_type) for r in saved] == [("/res/2", "2024-03-07", "High", "Spike")]
    assert len(saved[0]) == 13 and saved[0].detected_at == "2024-03-15T00:00:00"
    assert by(out["alerts"], "severity")["High"].alertCount == 1 and out["high_severity"].count() == 1
    assert out["summary"].first().total_resources_analyzed == 1


def test_detection_skips_known_days_only_at_subscription_level(spark):
    star = small_star(spark, cost=[cost_row(date(2024, 3, d), 10 * d) for d in (1, 2, 3)], anomalies=[
        {"dateKey": 20240301, "subscriptionKey": 1}, {"dateKey": 20240302, "subscriptionKey": 1, "resourceKey": 5}])
    rows = by(anomaly.detect_cost_anomalies(star, NOW, existing=star.fact_anomaly_daily), "dateKey")
    assert set(rows) == {20240302, 20240303} and rows[20240303].zScore == pytest.approx(1.0)


def test_constant_subscription_has_z_zero(spark):
    star = small_star(spark, cost=[cost_row(date(2024, 3, 1), 10), cost_row(date(2024, 3, 2), 10), cost_row(date(2024, 3, 2), 9, subscription=2)])
    rows = anomaly.detect_cost_anomalies(star, NOW).collect()
    assert [(r.zScore, r.anomalyType, r.severity, r.isAnomaly) for r in rows] == [(0.0, "Drop", "Low", False)] * 3


def export_file(folder, rows, stamp=None):
    """A file whose header repeats the columns, as delivered."""
    import os
    names = [*list(EXPORT_COLUMNS), "ResourceId", "ResourceGroup", *list(EXPORT_COLUMNS)[:12]]
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(names)]
    for row in rows:
        cells = [row.get(n, "") for n in names]
        lines.append(",".join('"' + str(c).replace('"', '""') + '"' if c != "" else "" for c in cells))
    path = folder / "part-0.csv"
    path.write_text("\n".join(lines))
    if stamp:
        os.utime(path, (stamp, stamp))


def usage(day, cost, resource="/RES/A", **more):
    return {"Date": day, "BillingPeriodStartDate": day[:8] + "01", "BillingPeriodEndDate": day[:8] + "28", "SubscriptionId": "s1",
            "SubscriptionName": "Dev", "MeterId": "m1", "MeterName": "vm", "MeterCategory": "VM", "ServiceName": "Compute",
            "UnitOfMeasure": "Hour", "Quantity": "2", "EffectivePrice": "1.5", "CostInBillingCurrency": cost, "CostInUSD": cost,
            "ResourceId": resource, "ResourceGroup": "rg", "Location": "west", "OfferId": "o1",
            "Tags": '{"Team": "red", "Environment": "prod"}', **more}


def test_exports_replace_each_other_per_month(spark, tmp_path):
    export_file(tmp_path / "a", [usage("2024-01-05", "1"), usage("2024-02-01", "2")], 1000)
    export_file(tmp_path / "b", [usage("2024-02-01", "3"), usage("2024-02-02", "4"), usage("bad", "x")], 2000)
    rows = latest_export(read_export(spark, str(tmp_path)).filter("Date IS NOT NULL"))
    assert sorted((str(r.Date), int(r.CostInBillingCurrency)) for r in rows.collect()) == [
        ("2024-01-05", 1), ("2024-02-01", 3), ("2024-02-02", 4)]
    assert dict(rows.dtypes)["Quantity"] == "decimal(18,6)" and rows.first().Tags.startswith('{"Team"')


def test_load_exports(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    export_file(tmp_path / "in" / "a", [usage("2024-01-05", "1"), usage("2024-01-06", "2", "/res/b", ReservationId="r1", PricingModel="Reservation")])
    written = ingest.load_exports(lake, NOW, str(tmp_path / "in"))
    assert (written["dim_resource"], written["fact_cost_daily"], written["dim_benefit"], written["dim_date"]) == (2, 2, 1, 2)
    facts = by(lake.read("fact_cost_daily"), "resourceId")
    assert facts["/res/b"].isReservationCharge and facts["/res/b"].benefitKey == 1 and not facts["/res/a"].isReservationCharge
    export_file(tmp_path / "in" / "b", [usage("2024-01-05", "5"), usage("2024-01-07", "6", "/res/b", Tags='{"Team": "blue"}')], 4e9)
    ingest.load_exports(lake, NOW + timedelta(days=1), str(tmp_path / "in"))
    resources = lake.read("dim_resource").collect()
    assert sorted((r.resourceId, r.team, r.isCurrent) for r in resources) == [
        ("/res/a", "red", True), ("/res/b", "blue", True), ("/res/b", "red", False)]
    assert sorted(r.resourceKey for r in resources) == [1, 2, 3] and lake.read("dim_subscription").count() == 1
    star = LakeStar(lake)
    assert {r.dateKey: int(r.actualCost) for r in star.cost(["dateKey", "actualCost"]).collect()} == {20240105: 5, 20240106: 2, 20240107: 6}


def test_an_export_is_not_shuffled_for_the_newest_folders(spark, tmp_path):
    export_file(tmp_path / "a", [usage("2024-01-05", "1"), usage("2024-02-01", "2")], 1000)
    export_file(tmp_path / "b", [usage("2024-02-01", "3")], 2000)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = latest_export(read_export(spark, str(tmp_path)))
        assert "hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
        assert sorted(int(r.CostInBillingCurrency) for r in rows.collect()) == [1, 3]
    finally:
        spark.conf.set(key, before)


def test_a_load_writes_slices_of_days(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "SLICES", 3)
    monkeypatch.setattr(ingest, "SLICE_BYTES", 1)
    monkeypatch.setattr(ingest, "FEW_MEMBERS", 0)
    lake = Lake(spark, str(tmp_path / "lake"))
    days = [f"2024-01-0{d}" for d in range(1, 7)]
    undated = {**usage("2024-01-01", "9"), "Date": "none"}
    export_file(tmp_path / "in1" / "a", [usage(d, "1") for d in days] + [usage(d, "5", SubscriptionId="s2") for d in days[:3]])
    assert ingest.load_exports(lake, NOW, str(tmp_path / "in1"))["fact_cost_daily"] == 9
    export_file(tmp_path / "in2" / "b", [usage(d, "2") for d in days[1:] for _ in range(2)] + [undated])
    assert ingest.load_exports(lake, NOW, str(tmp_path / "in2"))["fact_cost_daily"] == 11
    facts = lake.read("fact_cost_daily").collect()
    assert sorted((r.dateKey or 0, r.subscriptionId, int(r.actualCost)) for r in facts) == sorted(
        [(0, "s1", 9), (20240101, "s1", 1)] + [(20240100 + n, "s1", 2) for n in range(2, 7) for _ in range(2)]
        + [(20240100 + n, "s2", 5) for n in range(1, 4)])
    assert all(r.meterKey == 1 and r.resourceKey and r.resourceGroupKey for r in facts)
    cut = ingest.day_slices(lake.read("fact_cost_daily").select(F.to_date(F.col("dateKey").cast("string"), "yyyyMMdd").alias("Date")))
    assert len(cut) == 3 and cut[0][0] is None and cut[-1][1] is None and all(a[1] == b[0] for a, b in zip(cut, cut[1:]))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_date_bounds_prune_directories(lake, capsys):
    kpis.mom_growth(LakeStar(lake), NOW).explain("formatted")
    assert "dateKey#" in re.search(r"PartitionFilters: \[(.*)\]", capsys.readouterr().out).group(1)


def test_numbering_is_dense_and_repeatable(spark):
    members = spark.range(5000).select(F.concat(F.lit("m"), "id").alias("name")).repartition(13)
    once = {r.name: r.key for r in ingest.numbered(members, "name", "key", F.lit(10)).collect()}
    again = {r.name: r.key for r in ingest.numbered(members.repartition(3), "name", "key", F.lit(10)).collect()}
    assert sorted(once.values()) == list(range(11, 5011)) and once == again


def test_schema_drift(spark):
    drift = quality.schema_drift(spark.createDataFrame([], "a int, b string").schema, spark.createDataFrame([], "b int, c int").schema)
    assert set(drift) == {("c", "missing"), ("a", "unexpected"), ("b", "string instead of int")}


def test_orphans(spark):
    star = small_star(spark, cost=[cost_row(date(2024, 3, 1), 1, resource=77, regionKey=1), cost_row(date(2024, 3, 2), 1, regionKey=1)])
    empty = {d: spark.createDataFrame([], schema(d)) for d in ("dim_resource_group", "dim_region", "dim_offer")}
    rows = by(quality.orphan_counts(star.with_tables(**empty)), "keyName")
    assert (rows["resourceKey"].orphans, rows["dateKey"].orphans, rows["regionKey"].orphans) == (1, 0, 2)


def test_alert_stream(spark, tmp_path):
    events = spark.createDataFrame([("b", "90", 95.0, 100.0, "s"), ("c", None, 1.0, 1.0, "s")],
                                   "budgetName string, threshold string, currentSpend double, budgetAmount double, subscriptionId string")
    events.write.json(str(tmp_path / "in"))
    assert landed_json(spark, str(tmp_path / "in"), "budget_alert").count() == 2
    for _ in range(2):  # the second run finds nothing new
        stream = alert_streams.alert_stream(spark, str(tmp_path / "in"))
        alert_streams.run_alerts(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert [(r.budgetName, r.severity) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("b", "High")]


def test_metric_stream_takes_late_samples_and_drops_very_late_ones(spark, tmp_path):
    star = small_star(spark)
    fields = schema("fact_utilization_daily")
    days = [("a", [sample("/res/1", "Percentage CPU", 10), sample("/res/2", "Percentage CPU", 30)]),
            ("b", [sample("/res/1", "Percentage CPU", 20, start=datetime(2024, 3, 10)), sample("/res/1", "Percentage CPU", 30)]),
            ("c", [sample("/res/1", "Percentage CPU", 99, start=datetime(2024, 3, 1))])]
    for name, rows in days:
        table(spark, "raw_metrics_data", rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema("raw_metrics_data")).parquet(str(tmp_path / "in"))
        metric_streams.run_rollup_stream(
            metric_streams.daily_statistics(source), star, str(tmp_path / "out"), fields, str(tmp_path / "state")
        ).awaitTermination()
    rows = by(spark.read.schema(fields).parquet(str(tmp_path / "out")), "dateKey", "resourceKey")
    assert {k: float(r.avgCpuPercentage) for k, r in rows.items()} == {
        (20240314, 1): 20.0, (20240314, 2): 30.0, (20240310, 1): 20.0}


def test_work_folder_is_below_the_session_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert shared and work_folder(spark, "x").startswith(shared + "/x-")


def test_a_cluster_must_name_the_shared_folder():
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default),
                              sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError):
        work_folder(cluster, "x")

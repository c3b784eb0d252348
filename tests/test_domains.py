"""The three domains from delimited extracts to products, on small literal files."""

import warnings

import pytest

from helpers import day, one, rows, ts
from tidemark.context import RunContext
from tidemark.operators import checks
from tidemark.plans import asset, provider, risk
from tidemark.sources import bronze
from tidemark.sources.extracts import ASSET, PROVIDER, RISK

RUN = RunContext.of("2024-07-01", "2024-07-01 02:03:04")

PROVIDER_FILES = {
    "hcp_master.csv": [
        "hcp_id,npi,first_name,last_name,full_name,specialty_code,specialty_name,specialty_tier,state,territory_id,degree,years_in_practice,is_key_opinion_leader,is_investigator,created_date,updated_date",
        "H1, 1234567890 ,ann, lee ,Ann Lee,onc,Oncology,A,ny,T1,MD,12,True,False,2020-01-01,2024-01-01",
        "H1,1234567890,ann,lee,Ann Lee,onc,Oncology,B,ny,T1,MD,12,True,False,2020-01-01,2023-01-01",
        "H2,123,,ray,Bo Ray,,Cardio,C,ca,T2,DO,3,False,True,2020-01-01,2024-01-01",
        ",1111111111,x,y,z,onc,Oncology,A,ny,T1,MD,1,False,False,2020-01-01,2024-01-01",
    ],
    "hco_master.csv": [
        "hco_id,hco_name,hco_type,state,city,bed_count,is_teaching,is_nci_designated,created_date",
        "O1, General ,Hospital,ny,Albany,120.0,True,False,2010-01-01",
    ],
    "hcp_hco_affiliations.csv": [
        "affiliation_id,hcp_id,hco_id,affiliation_type,is_primary,start_date",
        "A1,H1,O1,Staff,True,2021-01-01",
        "A2,H1,,Staff,False,2021-01-01",
    ],
    "hcp_interactions.csv": [
        "interaction_id,hcp_id,rep_id,product,interaction_type,interaction_date,duration_minutes,outcome,samples_dropped,source_system",
        "I1,H1,R1,P,Visit,2024-06-30,30.0,Positive,2,CRM",
        "I2,H1,R1,P,Visit,2024-04-02,,Neutral,0,CRM",
        "I3,H1,R1,P,Call,2024-04-01,,Positive,1,CRM",
        "I4,H1,R1,P,Call,2023-07-01,,Negative,1,CRM",
        "I5,H2,R1,P,Call,2024-07-02,,Positive,1,CRM",
        "I6,,R1,P,Call,2024-06-01,,Positive,1,CRM",
    ],
    "rx_aggregates.csv": [
        "rx_id,hcp_id,product,period_month,period_year,total_rx_count,new_patient_starts,market_share_pct,source_system",
        "X1,H1,P,1,2024,40,4,0.2,RX",
        "X2,H1,P,12,2023,15,1,0.4,RX",
        "X3,H1,P,12,2022,500,50,0.9,RX",
        "X4,H2,P,1,2024,-1,1,0.1,RX",
    ],
    "patient_support_cases.csv": [
        "case_id,hcp_id,product,case_type,case_date,case_status,resolution_days,patient_age_band,payer_type",
        *[f"C{i},H1,P,Copay,2024-03-{i + 1:02d},{'Escalated' if i < 3 else 'Closed'},{i}.0,40-49,Medicare" for i in range(9)],
        "C9,H1,P,Copay,2024-01-15,Closed,,40-49,Medicare",
        "D1,H1,P,Other,2024-04-01,Open,,40-49,Medicare",
    ],
    "trial_sites.csv": [
        "site_id,hco_id,trial_id,activation_date,enrolled_patients,screen_failures,query_rate,protocol_deviations,site_rating,country,pi_hcp_id,is_active",
        "S1,O1,TR1,2023-01-01,30,10,0.05,2,Good,US,H1,True",
        "S2,O1,TR1,2023-01-01,0,0,0.5,9,Poor,US,H1,False",
        "S3,O9,TR1,2023-01-01,60,0,0.0,0,Excellent,US,H1,True",
        "S4,O1,TR1,2023-01-01,60,0,0.0,0,Excellent,US,H1,True",
    ],
    "territory_assignments.csv": [
        "assignment_id,hcp_id,territory_id,rep_id,assignment_start,assignment_end,is_current",
        "TA1,H1,T1,R1,2023-01-01,,True",
        "TA2,H1,T0,R1,2022-01-01,2022-12-31,False",
    ],
}


def write(folder, files):
    for name, lines in files.items():
        (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.fixture(scope="module")
def provider_tables(spark, tmp_path_factory):
    raw = write(tmp_path_factory.mktemp("provider"), PROVIDER_FILES)
    b = bronze.ingest(spark, PROVIDER, raw, RUN)
    s = provider.silver(b, RUN)
    return {**b, **s, **provider.gold(s, RUN, k=0)}


def test_bronze_lineage_and_missing_files(spark, tmp_path):
    write(tmp_path, {"hco_master.csv": PROVIDER_FILES["hco_master.csv"]})
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        tables = bronze.ingest(spark, PROVIDER, str(tmp_path), RUN)
    assert set(tables) == {"bronze_hco_master"} and len(caught) == len(PROVIDER) - 1
    row = one(tables["bronze_hco_master"])
    assert (row["_batch_id"], row["_source_file"], row["_source_system"]) == ("20240701_020304", "hco_master.csv", "HCO")
    assert row["_load_ts"] == ts("2024-07-01 02:03:04")


def test_provider_silver(provider_tables):
    hcp = provider_tables["silver_hcp_standardized"]
    h1, h2 = one(hcp, hcp_id="H1"), one(hcp, hcp_id="H2")
    assert hcp.count() == 2 and h1["specialty_tier"] == "A" and h1["npi"] == "1234567890"
    assert (h1["dq_npi_valid"], h1["dq_name_complete"], h1["dq_specialty_present"]) == (1, 1, 1)
    assert (h2["dq_npi_valid"], h2["dq_name_complete"], h2["dq_specialty_present"]) == (0, 0, 0)
    assert rows(provider_tables["silver_interactions_clean"], "interaction_id") == [("I1",), ("I2",), ("I3",), ("I4",)]
    assert provider_tables["silver_hcp_hco_affiliations"].count() == 1
    assert one(provider_tables["silver_hco_standardized"])["bed_count"] == 120
    assert provider_tables["silver_rx_aggregates"].count() == 3
    assert "case_id" not in provider_tables["silver_patient_support_agg"].columns
    assert provider.current_territories(provider_tables["bronze_territory_assignments"]).count() == 1


def test_provider_gold(provider_tables):
    view = one(provider_tables["gold_hcp_360"], hcp_id="H1")
    # 2023-07-02 starts the year, 2024-04-02 the 90 days.
    assert (view["total_interactions_12m"], view["interactions_90d"], view["positive_outcomes"]) == (3, 2, 2)
    assert (view["total_rx_12m"], view["total_new_starts_12m"]) == (55, 5)
    assert view["engagement_score"] == 2 * 8 + 2 * 5 + 20 + 15 and view["total_psp_cases"] == 11
    h1 = one(provider_tables["gold_hcp_targeting_score"], hcp_id="H1")
    assert (h1["targeting_priority"], h1["days_since_last_interaction"], h1["market_share_pct"]) == ("A", 1, 30.0)
    h2 = one(provider_tables["gold_hcp_targeting_score"], hcp_id="H2")
    assert (h2["targeting_priority"], h2["days_since_last_interaction"], h2["engagement_score"]) == ("D", 999, 10)
    assert rows(provider.coverage_index(provider_tables["gold_hcp_targeting_score"])) == [("T1", 1, 1, 100.0)]


def test_support_summary_and_cohorts(provider_tables):
    out = provider_tables["gold_patient_support_summary"]
    copay = one(out, case_type="Copay")
    assert (copay["case_quarter"], copay["total_cases"], copay["total_escalations"]) == (day("2024-01-01"), 10, 3)
    assert copay["avg_resolution_days"] == 4.0 and copay["escalation_rate_pct"] == 30.0
    silver, hcp = provider_tables["silver_patient_support_agg"], provider_tables["silver_hcp_standardized"]
    assert rows(provider.support_summary(silver, hcp), "case_type") == [("Copay",)]
    assert provider.support_summary(silver, hcp, k=11).count() == 0


def test_site_priority(provider_tables):
    got = rows(provider_tables["gold_trial_site_priority"], "site_id", "enrollment_success_pct", "site_quality_score", "priority_tier")
    assert got == [("S1", 75.0, 65.0, "HIGH"), ("S2", None, 0.0, "LOW"), ("S4", 100.0, 100.0, "HIGH")]


RISK_FILES = {
    "customers.csv": [
        "customer_id,first_name,last_name,age,state,income_band,customer_since,risk_segment,email_domain,phone_area_code",
        "C1,ann,lee,17,ny,LOW,2024-01-01,R,x.com,212",
        "C2,bo,ray,40,ca,LOW,2023-07-01,R,x.com,212",
    ],
    "merchants.csv": [
        "merchant_id,merchant_name,category,state,is_online,avg_transaction_size,risk_flag",
        "M1, Shop ,Retail,ny,True,20.0,True",
    ],
    "transactions.csv": [
        "transaction_id,customer_id,account_id,merchant_id,transaction_date,transaction_hour,transaction_type,amount,currency,transaction_state,is_online,is_international,is_fraud,status",
        "T1,C1,A1,M1,2024-05-01,4,Purchase,10.004,USD,NY,True,False,True,Approved",
        "T2,C1,A1,M9,2024-05-31,5,Purchase,30.0,USD,CA,True,False,False,Approved",
        "T3,C1,A1,M1,2024-05-31,0,Purchase,50.0,USD,NY,True,False,False,Approved",
        "T4,C2,A2,M1,2024-05-01,12,Purchase,-5.0,USD,NY,True,False,False,Approved",
        "T5,C2,A2,M1,2024-07-02,12,Purchase,5.0,USD,NY,True,False,False,Approved",
        "T6,C9,A9,M1,2024-05-01,12,Purchase,5.0,USD,NY,True,False,False,Approved",
    ],
    "device_events.csv": [
        "event_id,customer_id,event_date,event_hour,event_type,device_type,os,is_new_device,vpn_detected",
        "E1,C1,2024-05-31,1,New Device,phone,ios,True,True",
        "E2,C1,2024-05-24,1,Login,phone,ios,False,True",
        "E3,C1,2024-05-23,1,New Device,phone,ios,True,True",
        "E4,C1,2024-06-01,1,New Device,phone,ios,True,True",
    ],
    "bureau_attributes.csv": [
        "customer_id,bureau_score,num_open_accounts,num_derogatory_marks,total_debt_usd,payment_history_pct,credit_utilization_pct,oldest_account_years,bureau_pull_date",
        "C1,720,3,0,100.0,0.9,0.3,5,2024-04-01",
    ],
    "chargebacks.csv": [
        "chargeback_id,transaction_id,customer_id,chargeback_date,chargeback_amount,reason_code,status",
        "B1,T1,C1,2024-06-10,10.0,F,Open",
        "B2,T1,C1,2024-06-20,10.0,F,Open",
        "B3,T3,C1,2024-07-20,50.0,F,Open",
    ],
}


@pytest.fixture(scope="module")
def risk_tables(spark, tmp_path_factory):
    raw = write(tmp_path_factory.mktemp("risk"), RISK_FILES)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        b = bronze.ingest(spark, RISK, raw, RUN)
    s = risk.silver(b, RUN)
    return {**b, **s, **risk.gold(s, b["bronze_bureau_attrs"], RUN)}


def test_risk_silver_and_profile(risk_tables):
    assert rows(risk_tables["silver_customers_clean"], "customer_id", "dq_age_valid") == [("C1", 0), ("C2", 1)]
    assert rows(risk_tables["silver_transactions_clean"], "transaction_id", "amount") == [
        ("T1", 10.0), ("T2", 30.0), ("T3", 50.0), ("T6", 5.0),
    ]
    assert one(risk_tables["gold_customer_360"], customer_id="C1")["customer_tenure_days"] == 182
    assert one(risk_tables["gold_customer_360"], customer_id="C2")["bureau_score"] is None


def test_risk_features(risk_tables):
    features = risk_tables["gold_transaction_risk_features"]
    t2 = one(features, transaction_id="T2")
    assert (t2["customer_tx_count_30d"], t2["customer_tx_count_7d"], t2["days_since_last_tx"]) == (2, 1, 0)
    assert (t2["customer_avg_amount_30d"], t2["customer_max_amount_30d"], t2["distinct_states_30d"]) == (30.0, 50.0, 1)
    assert (t2["amount_vs_avg_ratio"], t2["prior_fraud_count"], t2["is_late_night"]) == (1.0, 1, 0)
    assert (t2["new_device_events_7d"], t2["vpn_events_7d"], t2["merchant_risk_flag"]) == (1, 2, False)
    t1 = one(features, transaction_id="T1")
    assert (t1["customer_tx_count_30d"], t1["days_since_last_tx"], t1["amount_vs_avg_ratio"], t1["is_late_night"]) == (0, 999, 1.0, 1)
    t6 = one(features, transaction_id="T6")
    assert (t6["bureau_score"], t6["credit_utilization_pct"], t6["num_derogatory_marks"]) == (650, 0.5, 0)
    assert t6["customer_tenure_days"] is None and t6["_batch_id"] == "20240701_020304"


def test_risk_profile_and_labels(risk_tables):
    c1 = one(risk_tables["gold_customer_risk_profile"], customer_id="C1")
    assert (c1["risk_tier"], c1["confirmed_fraud_count"], c1["fraud_rate_pct"]) == ("CONFIRMED_FRAUD", 1, 33.333)
    known = risk.labels_asof(risk_tables["silver_transactions_clean"], risk_tables["bronze_chargebacks"], "2024-06-15")
    assert rows(known.filter("label_known = 1"), "transaction_id", "first_chargeback_date") == [("T1", day("2024-06-10"))]
    assert rows(risk.chargeback_rate(risk_tables["silver_transactions_clean"], risk_tables["bronze_chargebacks"], "2024-06-30")) == [
        (day("2024-06-30"), 4, 2, 500.0)
    ]


def test_risk_suite_names_errors_not_crashes(spark, risk_tables):
    got = checks.run_suite(spark, risk.checks(RUN), risk_tables)
    by_name = {r.check_name: r.status for r in got.collect()}
    assert len(by_name) == 14 and by_name["silver_transactions_customer_linkage_pct"] == "ERROR"
    assert by_name["gold_pit_no_negative_days_since_last"] == "PASS"


LIMITS = {"temperature": "20,120,40,80", "vibration": "0,50,0,15"}
ASSET_FILES = {
    "assets.csv": [
        "asset_id,asset_name,asset_type,asset_type_name,production_line,criticality,install_date,age_years,manufacturer,expected_lifespan_years,maintenance_interval_days,is_active",
        "A1, Pump ,P,Pump,L1,HIGH,2020-01-01,9.0,M,10,100,True",
        "A2,Fan,F,Fan,L1,LOW,2024-05-01,1.0,M,0,100,True",
    ],
    "sensor_readings.csv": [
        "reading_id,sensor_id,asset_id,sensor_type,reading_timestamp,reading_value,unit,expected_min,expected_max,normal_low,normal_high,has_drift,has_clock_skew,is_outlier",
        "R1,S1,A1,temperature,2024-06-01 00:50:00,60.0,C,20,120,40,80,False,False,False",
        "R2,S1,A1,temperature,2024-06-01 01:10:00,90.0,C,20,120,40,80,False,False,False",
        "R3,S1,A1,temperature,2024-06-01 02:10:00,500.0,C,20,120,40,80,False,False,True",
        "R4,S1,A1,temperature,2024-07-01 02:03:05,60.0,C,20,120,40,80,False,True,False",
        "R5,S2,A1,vibration,2024-06-01 00:00:00,15.0,mm,0,50,0,15,False,False,False",
        "R6,S3,A2,pressure,2024-06-01 00:00:00,15.0,bar,0,200,10,80,False,False,False",
        ",S3,A2,pressure,2024-06-01 00:00:00,15.0,bar,0,200,10,80,False,False,False",
    ],
    "work_orders.csv": [
        "work_order_id,asset_id,work_order_type,description,created_date,completed_date,estimated_hours,actual_hours,technician_id,priority,cost_usd,parts_replaced",
        "W1,A1,Fix,d,2024-03-01,2024-03-23,2,3.0,X,P1,100.10,n",
        "W2,A1,Fix,d,2024-06-05,,2,,X,P1,50.05,n",
    ],
    "failure_events.csv": [
        "failure_id,asset_id,failure_type,failure_date,detection_method,downtime_hours,repair_cost_usd,severity,root_cause,was_predicted",
        "F1,A1,Wear,2024-06-08,S,4.5,10.0,H,x,False",
        "F2,A1,Wear,2023-06-30,S,4.5,10.0,H,x,False",
    ],
    "quality_inspections.csv": [
        "inspection_id,asset_id,inspection_date,defect_count,pass_rate,inspector_id,production_volume,shift,product_sku",
        "Q1,A1,2024-06-01,1,0.9,I,10,DAY,K",
    ],
}


@pytest.fixture(scope="module")
def asset_tables(spark, tmp_path_factory):
    raw = write(tmp_path_factory.mktemp("asset"), ASSET_FILES)
    b = bronze.ingest(spark, ASSET, raw, RUN)
    s = asset.silver(b, RUN)
    return {**b, **s, **asset.gold(s, RUN)}


def test_sensor_quality(asset_tables):
    s1 = one(asset_tables["gold_sensor_quality_score"], sensor_id="S1")
    assert (s1["total_readings"], s1["valid_readings"], s1["hard_outlier_count"], s1["anomaly_count"]) == (4, 2, 1, 1)
    assert s1["expected_reading_count"] == 30 * 24 + 2 + 1  # up to the hour of the clock
    # 60 * 0.5 + 25 * 0.75 + 15 * (1 - min(1, 5 * 0.25))
    assert s1["sensor_quality_score"] == 48.75
    assert asset_tables["silver_quality_clean"].count() == 1


def test_failure_features(asset_tables):
    rows_ = asset_tables["gold_failure_prediction_features"]
    assert rows(rows_, "asset_id", "reading_date") == [("A1", day("2024-06-01")), ]
    a1 = one(rows_)
    assert (a1["avg_temp"], a1["max_temp"], a1["avg_vibration"], a1["std_vibration"]) == (75.0, 90.0, 15.0, None)
    assert (a1["failure_in_next_7d"], a1["days_since_last_maintenance"], a1["failures_last_90d"]) == (1, 70, 0)
    assert a1["sensor_completeness_pct"] == pytest.approx((66.67 + 100) / 2) and a1["criticality_num"] == 3


def test_health_and_queue(asset_tables):
    a1 = one(asset_tables["gold_asset_health_summary"], asset_id="A1")
    assert (a1["failure_count_12m"], a1["work_orders_12m"], a1["maintenance_cost_12m_usd"]) == (1, 2, 150.15)
    assert (a1["days_since_last_failure"], a1["days_since_last_maintenance"], a1["maintenance_urgency"]) == (23, 100, "DUE_SOON")
    quality = (48.75 + 100) / 2
    assert a1["asset_health_score"] == pytest.approx(0.4 * quality + 0.3 * 80 + 0.3 * 10)
    a2 = one(asset_tables["gold_asset_health_summary"], asset_id="A2")
    assert (a2["days_since_last_failure"], a2["last_maintenance_date"]) == (61, None)
    assert a2["asset_health_score"] == pytest.approx(0.4 * 100 + 30)
    q1 = one(asset_tables["gold_maintenance_recommendations"], asset_id="A1")
    health = a1["asset_health_score"]
    assert q1["maintenance_priority_score"] == round(40 + 15 + 0.2 * (100 - health) + 5, 1)
    assert q1["recommended_action_tier"] == "MEDIUM"


def test_asset_kpis_and_suite(spark, asset_tables):
    assert one(asset.mtbf(asset_tables["silver_assets_clean"], asset_tables["silver_failure_events_clean"], RUN), asset_id="A2")["mtbf_hours"] is None
    assert one(asset.anomalies_per_day(asset_tables["silver_sensors_clean"]).filter("reading_date = '2024-06-01' AND asset_id = 'A1'"))["anomaly_count"] == 1
    got = {r.check_name: r.value for r in checks.run_suite(spark, asset.checks(RUN), asset_tables).collect()}
    assert len(got) == 13 and got["sensor_hard_outlier_rate_pct"] == 16.6667


def test_written_layers_keep_other_days(spark, tmp_path):
    def load(pairs):
        return spark.createDataFrame(pairs, "d string, v int")

    def store(pairs, incremental):
        path = bronze.write_table(load(pairs), str(tmp_path), "bronze", "t", ["d"], incremental)
        return rows(spark.read.parquet(path), "d", "v")

    assert store([("a", 1), ("b", 1)], False) == [("a", 1), ("b", 1)]
    assert store([("b", 2)], True) == [("a", 1), ("b", 2)]
    assert store([("c", 3)], False) == [("c", 3)]
    report = str(tmp_path / "report")
    bronze.write_json(load([("x", 3)]), report)
    assert rows(spark.read.json(report), "d", "v") == [("x", 3)]


def test_several_bureau_pulls_multiply_nothing(spark, risk_tables):
    pulls = spark.createDataFrame(
        [("C1", 500, "2024-01-01"), ("C1", 700, "2024-03-01"), ("C1", 600, "2024-02-01")],
        "customer_id string, bureau_score int, bureau_pull_date string",
    )
    rest = ("num_open_accounts", "num_derogatory_marks", "total_debt_usd", "payment_history_pct", "credit_utilization_pct", "oldest_account_years")
    wide = pulls.selectExpr("*", *[f"1 AS {c}" for c in rest])
    joined = risk.customer_360(risk_tables["silver_customers_clean"], wide, RUN)
    assert one(joined, customer_id="C1")["bureau_score"] == 700 and joined.count() == 2

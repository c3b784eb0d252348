"""A second batch through the layers equals the full rebuild and leaves other days alone."""

import shutil
import warnings

import pytest

from test_domains import ASSET_FILES, PROVIDER_FILES, RISK_FILES, write
from tidemark.context import RunContext
from tidemark.operators import quarantine
from tidemark.plans.flows import DOMAINS, derive, refresh
from tidemark.plans.refresh import Lake
from tidemark.sources.snapshots import SnapshotTable

FIRST = RunContext.of("2024-07-01", "2024-07-01 02:03:04")
SECOND = RunContext.of("2024-07-02", "2024-07-02 02:03:04")
# What a product says of the run that built it.
OF_THE_RUN = {"feature_ts", "gold_created_ts", "customer_tenure_days"}

HEAD = RISK_FILES["transactions.csv"][0]
OLD = [f"O{i},C{i % 5},A,M{i % 3},2024-0{3 + i % 4}-{1 + i % 28:02d},{i % 24},Purchase,{10 + i}.25,USD,{'NY' if i % 2 else 'CA'},True,False,{i % 7 == 0},Approved" for i in range(60)]
NEW = [
    "N1,C1,A,M1,2024-06-20,3,Purchase,99.5,USD,NY,True,False,True,Approved",
    "N2,C3,A,M2,2024-06-02,3,Purchase,7.0,USD,TX,True,False,False,Approved",
    "N3,C3,A,M2,2024-06-02,3,Purchase,-7.0,USD,TX,True,False,False,Approved",
    "N4,C9,A,M2,,3,Purchase,7.0,USD,TX,True,False,False,Approved",
]


def risk_batches(folder):
    one, two = folder / "one", folder / "two"
    one.mkdir(), two.mkdir()
    customers = RISK_FILES["customers.csv"]
    write(one, RISK_FILES | {
        "transactions.csv": [*RISK_FILES["transactions.csv"], *OLD],
        "customers.csv": [*customers, *[f"C{i},x,y,30,ny,LOW,2020-01-01,R,x.com,212" for i in (0, 3, 4)]],
    })
    # C2's profile changes, C9 is new, the other customers are not in this batch.
    write(two, {
        "transactions.csv": [HEAD, *NEW],
        "customers.csv": [customers[0], "C9,zoe,kim,33,ny,LOW,2022-01-01,R,x.com,212"],
        "bureau_attributes.csv": [RISK_FILES["bureau_attributes.csv"][0], "C2,600,3,4,100.0,0.9,0.95,5,2024-06-01"],
        "device_events.csv": [RISK_FILES["device_events.csv"][0], "E9,C4,2024-03-03,1,New Device,phone,ios,True,True"],
    })
    return str(one), str(two)


def step(spark, domain, raw, root, run, **options):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return refresh(spark, domain, raw, root, run, **options)


def content(df):
    return sorted(map(tuple, df.select(sorted(set(df.columns) - OF_THE_RUN)).collect()), key=str)


def folders(spark, root, name):
    table = SnapshotTable(spark, f"{root}/{name.split('_')[0]}/{name}")
    return {(r["values"]["_day"], r.folder, r.file) for r in table.manifest().collect()}


@pytest.fixture(scope="module")
def two_runs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("refresh")
    one, two = risk_batches(folder)
    root, domain = str(folder / "lake"), DOMAINS["risk"]
    step(spark, domain, one, root, FIRST)
    before = {n: folders(spark, root, n) for n in domain.calendar.reads}
    tables = step(spark, domain, two, root, SECOND)
    return folder, root, before, tables


def test_incremental_equals_rebuild(spark, two_runs):
    folder, root, _, tables = two_runs
    copy = str(folder / "again")
    shutil.copytree(f"{root}/bronze", f"{copy}/bronze")
    again = derive(Lake(spark, copy, DOMAINS["risk"].calendar), DOMAINS["risk"], SECOND, full=True)
    assert set(again) == set(tables)
    for name in tables:
        assert content(tables[name]) == content(again[name]), name


def test_only_touched_days_are_written(spark, two_runs):
    _, root, before, tables = two_runs
    for name in before:
        after = folders(spark, root, name)
        kept = {f[0] for f in before[name] & after}
        assert kept, name
        gone = {f[0] for f in before[name] - after}
        assert not kept & gone
    # A transaction of 1 March is beyond every window of the new rows; its customer has not changed.
    stale = {f[0] for f in before["gold_transaction_risk_features"] & folders(spark, root, "gold_transaction_risk_features")}
    assert "2024-03-01" in stale and "2024-06-20" not in stale


def test_rejects_are_accounted_for(spark, two_runs):
    _, root, _, tables = two_runs
    ledger = SnapshotTable(spark, f"{root}/quarantine/bronze_transactions").read()
    row = quarantine.account(ledger, tables["bronze_transactions"], tables["silver_transactions_clean"]).first()
    # T5 was of the next day in the first run: replayed in the second. T4, N3 and N4 stay.
    assert (row.open_rejects, row.replayed, row.complete) == (3, 1, True)
    assert {tuple(r.reasons) for r in ledger.filter("status = 'open'").collect()} == {
        ("amount_positive",), ("transaction_date_not_future",),
    }
    assert tables["silver_transactions_clean"].filter("transaction_id = 'T5'").count() == 1


def test_the_same_batch_again_changes_nothing(spark, two_runs, tmp_path):
    folder, root, _, tables = two_runs
    copy = str(tmp_path / "lake")
    shutil.copytree(root, copy)
    again = step(spark, DOMAINS["risk"], str(folder / "two"), copy, SECOND)
    for name in tables:
        assert content(tables[name]) == content(again[name]), name
    ledger = SnapshotTable(spark, f"{copy}/quarantine/bronze_transactions").read()
    row = quarantine.account(ledger, again["bronze_transactions"], again["silver_transactions_clean"]).first()
    assert row.complete and row.open_rejects == 3


def test_a_run_that_died_between_layers_is_caught_up(spark, tmp_path, monkeypatch):
    one, two = risk_batches(tmp_path)
    root, domain = str(tmp_path / "lake"), DOMAINS["risk"]
    step(spark, domain, one, root, FIRST)
    real = Lake.refresh_days

    def die(self, name, *rest):
        if name.startswith("gold"):
            raise KeyboardInterrupt
        return real(self, name, *rest)

    with monkeypatch.context() as m:
        m.setattr(Lake, "refresh_days", die)
        with pytest.raises(KeyboardInterrupt):
            step(spark, domain, two, root, SECOND)
    tables = derive(Lake(spark, root, domain.calendar), domain, SECOND)
    copy = str(tmp_path / "again")
    shutil.copytree(f"{root}/bronze", f"{copy}/bronze")
    again = derive(Lake(spark, copy, domain.calendar), domain, SECOND, full=True)
    assert content(tables["gold_transaction_risk_features"]) == content(again["gold_transaction_risk_features"])


def test_orphans_wait_for_their_parent(spark, tmp_path):
    one, two = risk_batches(tmp_path)
    root, domain = str(tmp_path / "lake"), DOMAINS["risk"]
    first = step(spark, domain, one, root, FIRST, hold_orphans=True)
    assert first["silver_transactions_clean"].filter("customer_id = 'C9'").count() == 0
    second = step(spark, domain, two, root, SECOND, hold_orphans=True)
    ledger = SnapshotTable(spark, f"{root}/quarantine/bronze_transactions").read()
    came = second["silver_transactions_clean"].filter("customer_id = 'C9'").select("transaction_id").collect()
    assert [r[0] for r in came] == ["T6"]
    t6 = ledger.filter("payload LIKE '%\"T6\"%'").collect()
    assert [(r.status, r.batch_id, r.resolved_batch, r.reasons) for r in t6] == [
        ("replayed", FIRST.batch_id, SECOND.batch_id, ["unknown_customer"])
    ]
    row = quarantine.account(ledger, second["bronze_transactions"], second["silver_transactions_clean"]).first()
    assert row.complete and row.replayed == 2


@pytest.mark.parametrize("name,files,fact", [("provider", PROVIDER_FILES, "hcp_interactions.csv"), ("asset", ASSET_FILES, "sensor_readings.csv")])
def test_other_domains_refresh(spark, tmp_path, name, files, fact):
    one, two = tmp_path / "one", tmp_path / "two"
    one.mkdir(), two.mkdir()
    lines = files[fact]
    half = len(lines) // 2 + 1
    write(one, files | {fact: lines[:half]})
    write(two, {fact: [lines[0], *lines[half:]]})
    root, domain = str(tmp_path / "lake"), DOMAINS[name]
    step(spark, domain, str(one), root, FIRST)
    tables = step(spark, domain, str(two), root, SECOND)
    copy = str(tmp_path / "again")
    shutil.copytree(f"{root}/bronze", f"{copy}/bronze")
    again = derive(Lake(spark, copy, domain.calendar), domain, SECOND, full=True)
    for table in tables:
        assert content(tables[table]) == content(again[table]), table

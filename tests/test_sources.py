"""Files in and out, nested tickets, stored parameters, and the refresh job."""

import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ticketlens.catalogue import DEFAULT, Catalogue
from ticketlens.operators import history
from ticketlens.operators.prepare import PrepareConfig
from ticketlens.plans import jobs
from ticketlens.sources import tables, tickets


def ticket(key, created, fields, *histories):
    return {"key": key, "created": created, "fields": fields, "changelog": {"histories": [
        {"created": at, "items": [dict(zip(("field", "from", "to", "fromString", "toString"), i)) for i in items]} for at, items in histories]}}


TICKETS = [
    ticket(
        "A-1", "2023-01-01T08:00:00.000+0100",
        {"summary": 'last, "name"', "status": {"name": "Done"}, "customfield_20200": {"value": "ART Epic"}, "labels": ["y", "x"],
         "fixVersions": [{"name": "R2"}], "customfield_18300": [{"name": "R1"}], "customfield_18903": {"displayName": "Doe, J", "emailAddress": "J@X.org"},
         "timetracking": {"timeSpentSeconds": 172800}, "customfield_10003": "5", "customfield_12807": "2024-01-01"},
        ("2023-01-02T23:30:00.000+0100", [("status", "1", "2", "Open", "Planned"), ("colour", "1", "2", "red", "blue")]),
        ("2023-01-05T10:00:00.000+0100", [("Fix Version", "", "77", "", "R2"), ("Epic Owner", "ann", "doe", "Ann", "Doe, J")]),
        ("2023-01-05T18:00:00.000+0100", [("status", "2", "3", "Planned", "Done"), ("timespent", "86400", "172800", "86400", "172800"),
                                           ("Target start", "2023-06-01", "2024-01-01", "1/Jun/23", "1/Jan/24"), ("labels", "", "", "x", "x y")]),
    ),
    ticket("A-2", "2023-02-01T08:00:00.000+0100", {"status": {"name": "Open"}, "fixVersions": []}),
    ticket(None, "2023-02-01T08:00:00.000+0100", {"status": {"name": "Open"}}),
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tickets") / "tickets.json"
    path.write_text("\n".join(json.dumps(t) for t in TICKETS))
    return tickets.read_tickets(spark, str(path))


def test_current_fields(raw):
    a = tickets.flatten_current(raw).filter("issuekey = 'A-1'").first()
    assert a.epic_summary == "last  name" and a.epic_labels == "x#y" and a.epic_owner == "Doe  J" and a.epic_owner_email == "j@x.org"
    assert (a.epic_fix_version, a.epic_PI, a.epic_release_name) == ("R2", "R2", "R2")
    assert (a.epic_jira_spent_dev_etc_md, a.epic_jira_remaining_dev_etc_md, a.epic_jira_forecast_dev_etc_md) == (2.0, 0.0, 0.0)
    assert a.epic_team is None and "epic_ext_ref" not in a.asDict()


def test_changes_are_numbered_and_known(raw):
    rows = [(r.history_id, r.item_ord, r.field) for r in tickets.flatten_changes(raw).orderBy("history_id", "item_ord").collect()]
    assert rows == [(0, 0, "status"), (1, 0, "Fix Version"), (1, 1, "Epic Owner"), (2, 0, "status"), (2, 1, "timespent"), (2, 2, "Target start"), (2, 3, "labels")]


def test_rejected_tickets_are_told_apart(raw):
    good, bad = tickets.split_bad(raw, ["key", "created"])
    assert (good.count(), bad.count()) == (2, 1)


def test_lines_that_are_no_tickets(spark, tmp_path):
    lines = [
        json.dumps(TICKETS[1]), json.dumps(TICKETS[2]), '{"key": "A-3", "created": null}', '{"key": "A-4", "created"', "[1, 2]", '"text"', "",
        '{"key": "A-5", "created": "2023-01-01", "fields": "none"}', '{"key": "A-6", "created": "2023-01-01", "changelog": {"histories": 7}}', "no json at all",
    ]
    (tmp_path / "t.json").write_text("\n".join(lines))
    good, bad = tickets.split_tickets(tickets.read_tickets(spark, str(tmp_path / "t.json"), keep_corrupt=True))
    assert [r.key for r in good.collect()] == ["A-2"] and tickets.RECORD not in good.columns
    got = {(r.reason, r.record) for r in bad.collect()}
    assert got == {
        ("no key", None), ("no creation time", None), ("broken JSON", lines[3]), ("no object", lines[4]), ("no object", lines[5]),
        ("wrong type: fields", lines[7]), ("wrong type: a nested field", lines[8]), ("broken JSON", lines[9]),
    }


def test_seconds_per_day_are_a_setting(spark, raw):
    from dataclasses import replace

    from ticketlens.catalogue import DEFAULT

    eight = replace(DEFAULT, seconds_per_day=8 * 3600)
    assert tickets.flatten_current(raw, eight).filter("issuekey = 'A-1'").first().epic_jira_spent_dev_etc_md == 6.0
    panel = jobs.panel_from_tickets(raw, eight).filter("key = 'A-1'").orderBy("extract_date").collect()
    assert [r.epic_jira_spent_dev_etc_md for r in panel] == [3.0, 3.0, 6.0]


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    path = f"{tmp_path}/ledger"

    def batch(keys, at, model="m/1 *%", p=0.5):
        rows = [(f"K{k}", "Open", "1", model, at, p, 1 - p) for k in keys]
        return spark.createDataFrame(rows, "epic_key string, epic_status string, predicted_lead_time string, model_name string, last_prediction_at string, proba_1 double, proba_2 double")

    def folders():
        return {str(p.parent.relative_to(tmp_path)) for p in tmp_path.glob("ledger/rows/*/*/*/*.parquet")}

    jobs.update_ledger(spark, batch(range(300), "2024-01-01 00:00:00"), path, buckets=16)
    jobs.update_ledger(spark, batch(range(40), "2024-01-01 00:00:00", "other"), path)
    before = folders()
    assert len({f.rsplit("/", 1)[1] for f in before}) == 16
    out = jobs.update_ledger(spark, batch([1, 2, 999], "2024-02-01 00:00:00", p=0.9), path)
    new = folders() - before
    assert 1 <= len(new) <= 3 and all("version=3" in f for f in new)
    assert out.count() == 341
    rows = {(r.epic_key, r.model_name): r for r in out.collect()}
    assert rows["K1", "m/1 *%"].proba_1 == 0.9 and rows["K1", "other"].proba_1 == 0.5 and rows["K3", "m/1 *%"].proba_1 == 0.5
    # other classes join, older versions go
    wide = batch([1], "2024-03-01 00:00:00").withColumn("proba_3", F.lit(0.0))
    out = jobs.update_ledger(spark, wide, path)
    assert out.count() == 341 and "proba_3" in out.columns
    bucket = next(f for f in new if len([g for g in folders() if g.rsplit("/", 2)[1:] == f.rsplit("/", 2)[1:]]) >= 2)
    jobs.update_ledger(spark, batch([1], "2024-04-01 00:00:00"), path)
    assert len([g for g in folders() if g.rsplit("/", 2)[1:] == bucket.rsplit("/", 2)[1:]]) == 2


def test_panel_has_the_last_state_of_each_day(spark, raw):
    people = spark.createDataFrame([("Ann", "ann@x.org")], "name string, email string")
    panel = jobs.panel_from_tickets(raw, people=people)
    assert panel.columns[:2] == ["extract_date", "key"]
    got = {(r.key, str(r.extract_date)): r for r in panel.collect()}
    assert set(got) == {("A-1", "2023-01-01"), ("A-1", "2023-01-02"), ("A-1", "2023-01-05"), ("A-2", "2023-02-01")}
    first, second, last = (got["A-1", f"2023-01-0{d}"] for d in (1, 2, 5))
    assert [r.epic_status for r in (first, second, last)] == ["Open", "Planned", "Done"]
    assert [r.epic_fix_version for r in (first, second, last)] == [None, None, "R2"]
    assert [r.epic_owner for r in (first, second, last)] == ["Ann", "Ann", "Doe  J"]
    assert [r.epic_owner_email for r in (first, second, last)] == ["ann@x.org", "ann@x.org", "j@x.org"]
    assert [r.epic_jira_spent_dev_etc_md for r in (first, second, last)] == [1.0, 1.0, 2.0]
    assert [r.epic_target_start for r in (first, second, last)] == ["2023-06-01", "2023-06-01", "2024-01-01"]
    assert [r.epic_labels for r in (first, second, last)] == ["x", "x", "x#y"]


def test_panel_windows_and_targets(raw):
    def days(**window):
        return sorted((r.key, str(r.extract_date)) for r in jobs.panel_from_tickets(raw, **window).collect())

    assert days(start="2023-01-02", end="2023-01-04") == [("A-1", "2023-01-02")]
    assert days(targets=["2023-01-04", "2023-03-01"]) == [("A-1", "2023-01-02"), ("A-1", "2023-01-05"), ("A-2", "2023-02-01")]
    assert ("A-2", "2023-02-01") not in days(require_history=True)


def test_a_pruned_panel_has_the_rows_of_the_whole_one(raw):
    whole = jobs.panel_from_tickets(raw)
    for start in ("2023-01-02", "2023-01-05"):
        want = sorted(map(tuple, whole.filter(F.col("extract_date") >= start).collect()), key=str)
        assert sorted(map(tuple, jobs.panel_from_tickets(raw, start=start).collect()), key=str) == want and want


def test_refresh_writes_panel_and_training_table(spark, raw, tmp_path):
    releases = spark.createDataFrame([("R1", "2023-01-01"), ("R2", "2023-05-01")], "release string, dev_cutoff string").withColumn(
        "dev_cutoff", F.col("dev_cutoff").cast("date"))
    for fmt in ("parquet", "csv"):
        out = jobs.refresh(raw, releases, f"{tmp_path}/panel_{fmt}", f"{tmp_path}/training_{fmt}", PrepareConfig(max_null_share=0.99), fmt)
        rows = sorted((r.key, str(r.extract_date), r.needed_lead_time) for r in out.collect())
        assert rows == [("A-1", "2023-01-01", "2"), ("A-1", "2023-01-02", "2"), ("A-1", "2023-01-05", "2")]


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "quoted", text', 2.5), (2, None, None)], "a int, b string, c double")
    tables.write_table(rows, f"{tmp_path}/deep/er/t", "csv")
    back = tables.read_table(spark, f"{tmp_path}/deep/er/t", "csv")
    assert dict(back.dtypes) == {"a": "int", "b": "string", "c": "double"}
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(ValueError):
        tables.read_table(spark, "x", "xlsx")


def test_partitioned_write(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string")
    tables.write_table(rows, f"{tmp_path}/t", partition_by=["p"])
    assert tables.read_table(spark, f"{tmp_path}/t").filter("p = 'y'").first().a == 2


@pytest.mark.parametrize("wrapped", [True, False])
def test_stored_parameters_in_both_shapes(spark, tmp_path, wrapped):
    best = {"k_features": 80, "rf_params": {"n_estimators": 400, "max_depth": 20, "max_features": "log2"}}
    (tmp_path / "best.json").write_text(json.dumps({"best_params": best, "best_f1w": 0.5} if wrapped else best, indent=2))
    row = tables.read_params(spark, f"{tmp_path}/best.json").first()
    assert row.k_features == 80 and row.rf_params.n_estimators == 400 and row.rf_params.max_features == "log2"


def test_metrics_as_json(spark, tmp_path):
    tables.write_metrics(spark.createDataFrame([("u", 0.5)], "unit string, acc double"), f"{tmp_path}/m")
    assert spark.read.json(f"{tmp_path}/m").first().acc == 0.5


def test_catalogue_size():
    assert len(DEFAULT.headers) == 45 and len(DEFAULT.used_headers()) == 43


def test_refresh_types_and_reports(spark, raw, tmp_path):
    releases = spark.createDataFrame([("R1", "2023-03-31"), ("R2", "2024-03-31")], "release string, dev_cutoff string").withColumn(
        "dev_cutoff", F.col("dev_cutoff").cast("date"))
    for fmt in ("csv", "parquet"):
        out = jobs.refresh(raw, releases, f"{tmp_path}/{fmt}/panel", f"{tmp_path}/{fmt}/training", PrepareConfig(since="2020-01-01"), fmt,
                           reports=f"{tmp_path}/{fmt}/reports")
        panel = tables.read_table(spark, f"{tmp_path}/{fmt}/panel", fmt)
        kinds = dict(panel.dtypes)
        assert kinds["epic_business_value"] == "double" and kinds["epic_jira_spent_dev_etc_md"] == "double"
        assert out.count() >= 0
        report = lambda name: tables.read_table(spark, f"{tmp_path}/{fmt}/reports/{name}", fmt).collect()
        assert [(r.key, r.reason) for r in report("rejected")] == [(None, "no key")]
        assert ("colour", "unknown field", 1) in {tuple(r) for r in report("unresolved")}
        assert report("release_errors") == []


def test_nothing_is_left_in_the_checkpoint_folder(tmp_path):
    """Checkpoints and scratch tables go with the application."""
    script = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate()
from ticketlens.session import materialize, scratch_folder
assert materialize(spark.range(100)).count() == 100
folder = scratch_folder(spark)
spark.range(10).write.parquet(folder)
print("rows", spark.read.parquet(folder).count())
"""
    root = Path(__file__).resolve().parents[1]
    ran = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=300)
    assert "rows 10" in ran.stdout, ran.stderr[-2000:]
    assert not [p for p in Path(tmp_path, "shared").rglob("*") if p.is_file()]


def test_nan_is_no_value(spark, tmp_path):
    spark.createDataFrame([(1.0, 2.0), (float("nan"), None)], "a double, b float").write.parquet(f"{tmp_path}/t")
    assert sorted(tables.read_table(spark, f"{tmp_path}/t").collect(), key=str) == [(1.0, 2.0), (None, None)]


def test_columns_with_one_history_are_replayed_once(spark, monkeypatch):
    """The three version columns are one history, fields without a change are one value; the panel is that of each by itself."""
    made = [
        ticket(f"B-{k}", "2023-01-01T08:00:00.000+0100", {
            "summary": f"s{k}", "status": {"name": "Done"}, "labels": ["x"], "fixVersions": [{"name": n} for n in ("R2", "R3")[:1 + k % 2]]},
            ("2023-01-03T10:00:00.000+0100", [("Fix Version", "", "2", "", "R2"), ("status", "1", "2", "Open", "Done")]))
        for k in range(4)
    ]
    rows = spark.read.schema(tickets.ticket_schema()).json(spark.sparkContext.parallelize([json.dumps(t) for t in made]))
    few = DEFAULT.restricted({"summary", "status", "labels", "fixVersions"})
    assert few.twins() == {"epic_PI": "epic_fix_version", "epic_release_name": "epic_fix_version"}
    replayed, filled = [], []
    replay, fill = history.replay_list, history.last_before
    monkeypatch.setattr(history, "replay_list", lambda now, *a, **b: (replayed.extend(r["header"] for r in now.select("header").distinct().collect()), replay(now, *a, **b))[1])
    monkeypatch.setattr(history, "last_before", lambda df, group, order, values, *a: (filled.append(list(values)), fill(df, group, order, values, *a))[1])
    panel = jobs.panel_from_tickets(rows, few)
    got = sorted(map(tuple, panel.collect()), key=str)
    assert replayed == ["epic_fix_version"] and sorted(filled[-1]) == ["epic_fix_version", "epic_status", history.STILL]
    by_name = {(r.key, str(r.extract_date)): r for r in panel.collect()}
    assert by_name["B-1", "2023-01-01"].epic_PI == "R3" and by_name["B-1", "2023-01-03"].epic_release_name == "R2#R3"
    assert by_name["B-0", "2023-01-01"].epic_fix_version is None and by_name["B-0", "2023-01-01"].epic_labels == "x"
    monkeypatch.setattr(Catalogue, "twins", lambda self: {})
    monkeypatch.setattr(tickets, "changing_columns", lambda raw, catalogue: [h.name for h in catalogue.headers])
    assert sorted(map(tuple, jobs.panel_from_tickets(rows, few).collect()), key=str) == got and len(replayed) == 1 + 3

"""Edges of preparation, profiling, encoding, selection and splits."""

import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketlens import skew
from ticketlens.functions.dates import date_or_null
from ticketlens.functions.text import slug, tag_count
from ticketlens.operators import encode, prepare, profile, select, units
from ticketlens.operators.encode import Preprocessor
from ticketlens.operators.profile import ColumnGroups
from ticketlens.operators.quantiles import medians, order_statistics


def test_dates_in_all_layouts(spark):
    texts = ["2024-02-29", "2024-02-30", "2024-03-01T23:30:00.000+0200", "5/3/2024", "07/Mar/24", "odd", "", None, "2024"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [str(r.d) if r.d else None for r in rows.select(date_or_null(F.col("t")).alias("d")).collect()]
    assert got == ["2024-02-29", None, "2024-03-01", "2024-03-05", "2024-03-07", None, None, None, None]


def test_release_tokens(spark):
    table = spark.createDataFrame([("R1", "2024-01-31"), ("R2", "2024-06-30"), ("to_plan", "2020-01-01"), ("hit-pi-9", "2020-01-01")],
                                     "release string, dev_cutoff string").withColumn("dev_cutoff", F.col("dev_cutoff").cast("date"))
    texts = [" R2 , R1", "R1#to_plan", "hit-pi-9", "", None, "R2#nope"]
    rows = spark.createDataFrame([(t,) for t in texts], "epic_dev_roadmap string")
    for calendar in (table, prepare.calendar(table)):
        out = prepare.release_date(rows, "epic_dev_roadmap", calendar, (",", "#"), "min", "d")
        got = {r.epic_dev_roadmap: str(r.d) if r.d else None for r in out.collect()}
        assert got == {" R2 , R1": "2024-01-31", "R1#to_plan": "2024-01-31", "hit-pi-9": None, "": None, None: None, "R2#nope": "2024-06-30"}
    bad = {r.token: r.n for r in prepare.unknown_releases(rows, {"epic_dev_roadmap": (",", "#")}, table).collect()}
    assert bad == {"to_plan": 1, "hit-pi-9": 1, "": 1, "nope": 1}


def test_copies_differ_in_a_sparse_column_before_it_goes(spark):
    rows = spark.createDataFrame([("k", 1, "a", None), ("k", 2, "a", "x"), ("k", 3, "a", None)], "key string, ord int, v string, rare string")
    unique = prepare.dedup_except(rows, [], "ord")
    assert sorted(r.ord for r in unique.collect()) == [1, 2]


COLUMNS = {
    "one": [1.0], "two": [1.0, 2.0], "few": [5.0] * 50 + [1.0] * 10, "range": list(range(1001)), "tenths": [0.1 * i for i in range(2000)],
    "balanced": [0.0] * 400 + [1.0] * 400, "three": [0.0] * 300 + [0.5] + [1.0] * 300, "same": [7.0] * 900, "infinite": [float("-inf"), 3.0, float("inf")],
}


@pytest.mark.parametrize("accuracy, gathered", [(10_000, 50_000), (100, 20), (20, 1)])
def test_order_statistics_are_exact_at_every_size(spark, accuracy, gathered):
    draw = random.Random(1)
    longest = max(map(len, COLUMNS.values()))
    cells = {}
    for name, values in COLUMNS.items():
        cells[name] = [float(v) for v in values] + [draw.choice([None, float("nan")]) for _ in range(longest - len(values))]
        draw.shuffle(cells[name])
    cells["empty"] = [None, float("nan")] * (longest // 2)
    rows = spark.createDataFrame(list(zip(*cells.values())), ", ".join(f"{c} double" for c in cells)).repartition(4)
    got = medians(rows, list(cells), accuracy, gathered)
    assert got == {**{c: pytest.approx(median(map(float, v))) for c, v in COLUMNS.items()}, "empty": None}
    ranks = lambda n: [0, n // 10, n // 2, n - 1]
    found = order_statistics(rows, {c: F.col(c) for c in cells}, [0.0, 0.1, 0.5, 1.0], ranks, accuracy, gathered)
    assert found == {**{c: [sorted(map(float, v))[r] for r in ranks(len(v))] for c, v in COLUMNS.items()}, "empty": []}


def test_encoding_keeps_its_columns_for_unseen_values(spark):
    schema = "n double, c string, t string, h string, k string, flag boolean, gone double"
    train = spark.createDataFrame(
        [(1.0, "x", "a#b", "u", "Other", True, None), (None, None, "b", "u", "p", False, None), (3.0, "y", None, "w", "p", True, None)], schema)
    groups = ColumnGroups(numeric=["n", "gone"], one_hot=["c", "flag"], top_k=["k"], frequency=["h"], tag_count=["t"], tag_binarize=["t"])
    fitted = Preprocessor.fit(train, groups)
    names = ["num__n", "onehot__c_x", "onehot__c_y", "onehot__flag_False", "onehot__flag_True", "topk__k_p", "topk__k_Other", "high_card__h", "ml_count__t", "ml_binarize__t_a", "ml_binarize__t_b"]
    assert fitted.names() == names
    seen = [tuple(round(v, 4) for v in r) for r in fitted.transform(train).collect()]
    assert sorted(seen) == sorted([
        (-1.2247, 1, 0, 0, 1, 0, 1, 0.6667, 2, 1, 1), (0.0, 1, 0, 1, 0, 1, 0, 0.6667, 1, 0, 1), (1.2247, 0, 1, 0, 1, 1, 0, 0.3333, 0, 0, 0)])
    odd = spark.createDataFrame([(None, "new", "z# #b", "new", "new", None, 5.0)], schema)
    got = fitted.transform(odd).first()
    assert tuple(got) == (0.0, 0, 0, 0, 1, 0, 1, 0.0, 2, 0, 1)


def test_encoder_survives_saving(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.0, "x#y"), ("b", 2.0, "x")], "h string, n double, t string")
    fitted = Preprocessor.fit(rows, ColumnGroups(numeric=["n"], frequency=["h"], tag_count=["t"], tag_top_k=["t"]))
    fitted.save(str(tmp_path), spark)
    again = Preprocessor.load(spark, str(tmp_path))
    assert [tuple(r) for r in again.transform(rows).orderBy("num__n").collect()] == [tuple(r) for r in fitted.transform(rows).orderBy("num__n").collect()]


def test_groups_follow_the_profile(spark):
    rng = random.Random(3)
    rows = [(f"v{i % 60}", f"id{i}", "a long text that is different every time " + str(i), f"t{i % 5}#t{i % 7}", f"r{i}#r{i + 1}", f"2024-01-{i % 28 + 1:02d}", rng.random(), i % 2 == 0, None)
            for i in range(1200)]
    df = spark.createDataFrame(rows, "mid string, high string, text string, tags string, rare string, day string, num double, flag boolean, empty string")
    groups = profile.group_columns(df)
    assert groups == ColumnGroups(numeric=["num"], dates=["day"], one_hot=["flag", "empty"], top_k=["mid"], frequency=["high"], text=["text"],
                                  tag_count=["tags", "rare"], tag_binarize=["tags"])


def test_f_score_and_information_against_numpy(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 400)
    x = rng.normal(size=400) + y
    flagged = (rng.random(400) < 0.2 + 0.2 * y).astype(float)
    rows = spark.createDataFrame([(str(c), [float(a), float(b), 1.0]) for c, a, b in zip(y, x, flagged)], "y string, features array<double>")
    stats = select.feature_stats(rows, ["x", "flag", "const"], "y")
    groups = [x[y == c] for c in range(3)]
    between = sum(len(g) * (g.mean() - x.mean()) ** 2 for g in groups) / 2
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (400 - 3)
    assert select.f_score(stats[0]) == pytest.approx(between / within)
    assert select.f_score(stats[2]) == 0 and select.varying(stats) == ["x", "flag"]
    joint = np.array([[np.sum((flagged == v) & (y == c)) for c in range(3)] for v in (0, 1)]) / 400
    want = sum(joint[i, c] * np.log(joint[i, c] / joint[i].sum() / joint[:, c].sum()) for i in range(2) for c in range(3))
    mi = select.mutual_info(rows, stats, "y")
    assert mi["flag"] == pytest.approx(want) and mi["x"] > 0.1 and mi["const"] == 0


def test_joint_select_without_any_score_keeps_one_feature(spark):
    rows = spark.createDataFrame([("a", [1.0, 5.0]), ("b", [2.0, 50.0])], "y string, features array<double>")
    stats = select.feature_stats(rows, ["small", "large"], "y")
    assert select.joint_select([], 5, stats) == ["large"]
    assert select.minmax([2.0, 2.0]) == [0.0, 0.0] and select.minmax([1.0, float("inf")]) == [0.0, 0.0]


def test_folds_and_split_are_balanced_and_repeatable(spark):
    rows = spark.createDataFrame([(i, "abc"[i % 3 if i % 7 else 0]) for i in range(500)], "key int, y string").repartition(5)
    for per_bucket in (100_000, 3):
        ranked = skew.spread_rank(rows, "y", units.shuffle_digest("key", 1), "key", per_bucket=per_bucket)
        by_class = {}
        for r in ranked.collect():
            by_class.setdefault(r.y, []).append(r["rank"])
        assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by_class.values())
    folds = units.stratified_folds(rows, "y", "key", 4).groupBy("y").pivot("fold").count().collect()
    assert all(max(r[1:]) - min(r[1:]) <= 1 for r in folds)
    first = units.stratified_split(rows, "y", "key").filter("is_test").select("key")
    again = units.stratified_split(rows.repartition(2), "y", "key").filter("is_test").select("key")
    assert {r.key for r in first.collect()} == {r.key for r in again.collect()}
    assert units.fold_count([], 10) == 2 and units.fold_count([1, 9], 10) == 2 and units.fold_count([4, 9], 10) == 4


def test_lookup_join_is_the_same_when_spread(spark):
    big = spark.createDataFrame([(("hot" if i % 3 else None) if i % 2 else f"k{i % 9}", i % 4) for i in range(300)], "k string, v int")
    small = spark.createDataFrame([("hot", 1), ("k2", 2), ("k4", 3)], "k string, w int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = sorted(map(tuple, big.join(small, ["k"], how).collect()), key=str)
        assert sorted(map(tuple, skew.lookup_join(big, small, ["k"], how, limit=20).collect()), key=str) == plain


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_spreads_keys_beyond_the_list(spark, monkeypatch, how):
    big = spark.createDataFrame([(f"k{i % 5}" if i % 7 else None, i) for i in range(400)], "k string, v int").repartition(8)
    small = spark.createDataFrame([(f"k{i}", i) for i in range(1, 7)], "k string, w int")
    plain = sorted(map(tuple, big.join(small, ["k"], how).collect()), key=str)
    monkeypatch.setattr(skew, "MAX_BROADCAST_ROWS", 2)
    hot = skew.hot_groups(big, ["k"], 20)
    assert hot.all_hot and hot.largest_unlisted > 60
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spread = skew.lookup_join(big, small, ["k"], how, limit=20)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, spread.collect()), key=str) == plain


def test_hot_values_list_the_largest(spark, monkeypatch):
    rows = spark.createDataFrame([(f"v{min(i % 10, i % 4)}", "one") for i in range(300)], "a string, b string")
    monkeypatch.setattr(skew, "MAX_BROADCAST_ROWS", 2)
    hot = encode.hot_values(rows, ["a", "b"], 20)
    counts = sorted((r["count"] for r in rows.groupBy("a").count().collect()), reverse=True)
    assert hot["a"].all_hot and hot["a"].table.count() == 2 and not hot["b"].all_hot
    assert (hot["a"].largest, hot["a"].largest_unlisted) == (counts[0], counts[2])


def test_fill_is_the_same_when_every_group_is_hot(spark, monkeypatch):
    rows = spark.createDataFrame([(f"k{i % 7}", i, None if i % 3 else i) for i in range(200)], "k string, t int, v int")
    plain = sorted(map(tuple, skew.last_before(rows, ["k"], [F.col("t")], ["v"]).collect()), key=str)
    monkeypatch.setattr(skew, "MAX_BROADCAST_ROWS", 3)
    assert skew.hot_groups(rows, ["k"], 10).all_hot
    assert sorted(map(tuple, skew.last_before(rows, ["k"], [F.col("t")], ["v"], limit=10).collect()), key=str) == plain


def test_units_by_policy(spark):
    rows = spark.createDataFrame([("Open",), ("Done",), ("Odd",), (None,), ("Open",)], "epic_status string")

    def names(**options):
        return [(r.type, r.name, r.statuses) for r in units.plan_units(rows, **options).collect()]

    groups = {"A": ["Open", "Missing"], "B": ["Nowhere"]}
    assert names(groups=groups) == [("group", "A", ["Open"])]
    assert names(groups=groups, ungrouped="perstatus") == [("group", "A", ["Open"]), ("status", "Done", ["Done"]), ("status", "Odd", ["Odd"])]
    assert names(include=["Done"]) == [("status", "Done", ["Done"])]
    assert names(exclude=["Done"]) == [("status", "Odd", ["Odd"]), ("status", "Open", ["Open"])]


def test_small_functions(spark):
    rows = spark.createDataFrame([("__Ab c/é-1_",), (None,)], "s string")
    assert [r.s for r in rows.select(slug(F.col("s")).alias("s")).collect()] == ["ab_c_é-1", None]
    tagged = spark.createDataFrame([("a# #b",), ("",), (None,)], "t string")
    assert [r.n for r in tagged.select(tag_count(F.col("t")).alias("n")).collect()] == [2, 0, 0]
    assert encode.null_columns(rows) == ["s"]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_samples_have_the_exact_size(spark, parts):
    rows = [(k, f"v{k % 4}" if k % 3 else None, "2024-01-01" if k < 30 else "odd", None) for k in range(60)] + [(1, "v1", "2024-01-01", None)] * 3
    df = spark.createDataFrame(rows, "key long, a string, d string, gone string").repartition(parts)
    got = [(r["column"], r["value"]) for r in profile.sample_values(df, ["a", "d", "gone"], 10, F.col("key")).collect()]
    assert sorted({c: sum(x == c for x, _ in got) for c, _ in got}.items()) == [("a", 10), ("d", 10)]
    again = profile.sample_values(df.repartition(5), ["a", "d", "gone"], 10, F.col("key"))
    assert sorted(got) == sorted((r["column"], r["value"]) for r in again.collect())
    few = profile.sample_values(df.limit(5), ["d"], 10)
    assert few.count() == 5
    assert profile.detect_dates(df.drop("key"), 0.05, sample_size=60) == ["d"] and profile.detect_dates(df, sample_size=1000) == profile.detect_dates(df)


def test_many_tags_stay_sparse(spark):
    """Thousands of flags: statistics and selection follow the tags that rows have, and equal the dense path on the chosen ones."""
    draw = random.Random(9)
    rows = [(k, "#".join({f"t{draw.randrange(4_000)}" for _ in range(4)} | ({"hot"} if k % 2 else set())), "ab"[k % 2]) for k in range(2_000)]
    df = spark.createDataFrame(rows, "key int, tags string, y string").repartition(4)
    fitted = Preprocessor.fit(df, ColumnGroups(tag_count=["tags"], tag_binarize=["tags"]))
    names = fitted.names()
    assert names == list(fitted.features())
    assert len(names) > 3_000
    sparse = fitted.sparse(df, ["key", "y"]).cache()
    assert sparse.agg(F.max(F.size("entries"))).first()[0] <= 6
    stats = select.sparse_stats(sparse, names, "y")
    top = max(stats, key=select.f_score).name
    some = [top, *names[:20], "ml_count__tags"]
    dense = select.feature_stats(fitted.vectors(df, ["y"], some), some, "y")
    by_name = {s.name: s for s in stats}
    for s in dense:
        assert (by_name[s.name].present, by_name[s.name].class_present) == (s.present, s.class_present) and by_name[s.name].variance == pytest.approx(s.variance)
    mi = select.sparse_information(sparse, stats, "y")
    assert sorted(mi, key=mi.get)[-2:] == sorted(["ml_binarize__tags_hot", "ml_count__tags"], key=mi.get)
    assert mi["ml_binarize__tags_hot"] == pytest.approx(np.log(2), abs=0.01)
    sparse.unpersist()


def test_entries_are_built_once_a_row_and_flags_without_a_lambda(spark, monkeypatch):
    df = spark.createDataFrame([(k, "abc"[k % 3], f"v{k % 60}") for k in range(180)], "key int, kind string, many string")
    fitted = Preprocessor.fit(df, ColumnGroups(one_hot=["kind"], top_k=["many"]))
    sparse = fitted.sparse(df)
    assert "lambda" not in sparse._jdf.queryExecution().analyzed().toString()
    names, plans = fitted.names(), []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: (plans.append(self._jdf.queryExecution().optimizedPlan().toString()), collect(self))[1])
    stats = select.sparse_stats(sparse, names)
    assert not [p for p in plans if "size(" in p] and {s.name: s.present for s in stats}["onehot__kind_a"] == 60

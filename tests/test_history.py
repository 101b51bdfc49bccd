"""Replay against a plain backward walk, in the ordinary and in the hot-group plan."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketlens.catalogue import DEFAULT
from ticketlens.operators import history, snapshots

START = datetime(2024, 1, 1)
FIELDS = ["a", "b"]
SCALAR = "key string, changed_at timestamp_ntz, history_id long, item_ord int, header string, before string, after string"


def random_log(seed, keys=4, length=60):
    """Random scalar and tag changes with equal times, several items per history and odd removals."""
    rng = random.Random(seed)
    changes, current = [], []
    for k in range(keys):
        key, size, at = f"K{k}", (length * 4 if k == 0 else length), START
        for h in range(size):
            at += timedelta(seconds=rng.choice([0, 1, 3600, 86400]))
            for i in range(rng.choice([1, 1, 2, 3])):
                if rng.random() < 0.5:
                    changes.append((key, at, h, i, rng.choice(FIELDS), rng.choice([None, "", "x", "y", "z"]), "w"))
                else:
                    tag = rng.choice("pqrst")
                    before, after = rng.choice([(tag, None), (None, tag), ("", tag), (tag, ""), (tag, tag), (None, None)])
                    changes.append((key, at, h, i, "tags", before, after))
        current.append((key, START - timedelta(days=1), rng.choice([None, "now"]), "now", "#".join(sorted(rng.sample("pqrst", 2)))))
    return current, changes


def backward_walk(current, changes):
    """State per (key, time) by undoing one item after the other."""
    out, undone = {}, []
    for key, created, a, b, tags in current:
        state = {"a": a, "b": b, "tags": [t for t in tags.split("#") if t]}
        mine = [c for c in changes if c[0] == key]
        histories = sorted({(c[1], c[2]) for c in mine}, reverse=True)
        times = [t for t, _ in histories] + [created]
        out.setdefault((key, times[0]), dict(state, tags=list(state["tags"])))
        for (at, number), earlier in zip(histories, times[1:]):
            for _, _, _, item, header, before, after in sorted((c for c in mine if c[2] == number), key=lambda c: c[3]):
                if header != "tags":
                    state[header] = before
                elif not before and after and after in state["tags"]:
                    state["tags"].remove(after)
                    undone.append((key, number, item, "#".join(state["tags"]) or None))
                elif before and not after and before not in state["tags"]:
                    state["tags"].append(before)
                    undone.append((key, number, item, "#".join(state["tags"]) or None))
            # the state after the last of several changes at one time is kept
            if earlier != at:
                out[(key, earlier)] = dict(state, tags=list(state["tags"]))
    return {
        k: (s["a"] or None, s["b"] or None, "#".join(s["tags"]) or None) for k, s in out.items()
    }, sorted(undone)


def frames(spark, current, changes):
    log = spark.createDataFrame(changes, SCALAR)
    now = spark.createDataFrame(current, "key string, created timestamp_ntz, a string, b string, tags string")
    return now, log.filter("header <> 'tags'"), log.filter("header = 'tags'")


def lists(now, tag_log, **options):
    held = now.select("key", F.lit("tags").alias("header"), F.col("tags").alias("value"))
    return history.replay_list(held, tag_log, **options)


@pytest.mark.parametrize("seed, limit, list_rows", [(1, 1_000_000, 1_000), (2, 25, 25), (3, 40, 6), (4, 1_000, 9)])
def test_states_equal_a_backward_walk(spark, seed, limit, list_rows):
    current, changes = random_log(seed)
    now, scalars, tag_log = frames(spark, current, changes)
    replayed = lists(now, tag_log, limit=limit, list_rows=list_rows)
    want_states, want_undone = backward_walk(current, changes)
    got = sorted((r.key, r.history_id, r.item_ord, r.before) for r in replayed.collect())
    assert got == want_undone
    both = scalars.drop("after").unionByName(replayed)
    built = history.states(now, both, [*FIELDS, "tags"], times=tag_log.select("key", "changed_at"), limit=limit)
    assert {(r.key, r.valid_from): (r.a, r.b, r.tags) for r in built.collect()} == want_states
    assert built.count() == len(want_states)


@pytest.mark.parametrize("list_rows", [1_000, 6])
def test_lists_only_at_the_asked_changes(spark, list_rows):
    current, changes = random_log(6)
    now, _, tag_log = frames(spark, current, changes)
    asked = (F.col("history_id") % 17 == 3) & (F.col("item_ord") == 0)
    got = sorted((r.key, r.history_id, r.item_ord, r.before) for r in lists(now, tag_log, list_rows=list_rows, asked=asked).collect())
    want = [u for u in backward_walk(current, changes)[1] if u[1] % 17 == 3 and u[2] == 0]
    assert got == want and want


@pytest.mark.parametrize("asked", [None, "history_id in (0, 2500, 5999)"])
def test_many_tags_held_through_many_pieces(spark, asked):
    """500 tags stay through 600 pieces; interval rows follow the changes, not tags times pieces."""
    kept = [f"t{k}" for k in range(500)]
    changes = [("K", START + timedelta(seconds=h), h, 0, "tags", None, f"new{h}") for h in range(6_000)]
    tags = "#".join([*kept, *[c[6] for c in changes]])
    now = spark.createDataFrame([("K", "tags", tags)], "key string, header string, value string")
    log = spark.createDataFrame(changes, SCALAR)
    got = {r.history_id: r.before for r in history.replay_list(now, log, list_rows=10, asked=asked and F.expr(asked)).collect()}
    assert len(got) == (6_000 if asked is None else 3)
    assert all(got[h] == "#".join([*kept, *[f"new{k}" for k in range(h)]]) for h in (0, 2500, 5999))


def test_interval_rows_follow_the_changes(spark):
    """500 tags come in the first pieces and stay through 2,000 more."""
    steps = spark.range(25_000).selectExpr(
        "'K' key", "'tags' header", "id div 10 piece", "0 recent", "timestamp '2024-01-01' - make_dt_interval(0, 0, 0, id) moment",
        "-id history_id", "0 item_ord", "cast(null as timestamp) changed_at",
        "if(id < 500, concat('t', id), concat('x', (id - 500) div 2)) tag", "id >= 500 and id % 2 = 1 added")
    spans = history.tag_spans(steps)
    assert spans.count() <= 25_000
    cut = spans.withColumn("until", F.least("until", F.lit(2_500)))
    blocks = cut.select("tag", F.inline(history.span_blocks(F.col("first"), F.col("until"))))
    assert 500 < blocks.count() <= 500 * 4 * 2 * 16  # tags times pieces are 1,000,000
    wanted = spark.createDataFrame([("K", "tags", p) for p in (1, 49, 50, 700, 2_499)], "key string, header string, piece long")
    got = {r.piece: r.carry for r in history.held_at(spans, wanted).collect()}
    assert {p: len(c) for p, c in got.items()} == {1: 10, 49: 490, 50: 500, 700: 500, 2_499: 500}
    assert got[2_499] == [f"t{k}" for k in range(500)]


@settings(max_examples=60, deadline=None)
@given(first=st.integers(0, 5_000), length=st.integers(0, 5_000))
def test_blocks_cover_a_span_once(first, length):
    """The rule of `span_blocks` in plain numbers."""
    until, size, got, blocks = first + length, 1, [], 0
    while -(-first // size) < until // size:
        low, high = -(-first // size), until // size
        up = size * history.BLOCK_PLACES
        inner = -(-first // up) < until // up
        runs = [(low, -(-first // up) * 16), (until // up * 16, high)] if inner else [(low, high)]
        for a, b in runs:
            got += [x for k in range(a, b) for x in range(k * size, (k + 1) * size)]
            blocks += max(b - a, 0)
        size = up
    assert sorted(got) == list(range(first, until)) and blocks <= 4 * 32


def test_blocks_of_spans_and_places_meet_once(spark):
    spans = [(0, 1), (0, 16), (3, 300), (255, 257), (17, 5_000), (4_096, 4_096), (1, 70_000)]
    rows = spark.createDataFrame(spans, "first long, until long").select("first", "until", F.inline(history.span_blocks(F.col("first"), F.col("until"))))
    points = spark.range(0, 5_100, 7).select(F.col("id").alias("place"), F.inline(history.place_blocks(F.col("id"))))
    got = sorted((r.first, r.until, r.place) for r in rows.join(points, ["level", "block"]).collect())
    assert got == sorted((a, b, p) for a, b in spans for p in range(0, 5_100, 7) if a <= p < b)


def test_prune_keeps_the_newest_state_and_true_values(spark):
    current, changes = random_log(5)
    now, scalars, _ = frames(spark, current, changes)
    scalars = scalars.drop("after")
    every = {(r.key, r.valid_from): (r.a, r.b) for r in history.states(now, scalars, FIELDS).collect()}
    cut = sorted(t for _, t in every)[len(every) // 2]
    pruned = history.states(now, scalars, FIELDS, min_valid_from=str(cut.date()))
    got = {(r.key, r.valid_from): (r.a, r.b) for r in pruned.collect()}
    newest = {k: max(t for key, t in every if key == k) for k, _ in every}
    want = {k: v for k, v in every.items() if k[1].date() >= cut.date() or newest[k[0]] == k[1]}
    assert got == want


def test_ticket_without_changes_has_its_creation_state(spark):
    now = spark.createDataFrame([("K", START, "v", None)], "key string, created timestamp_ntz, a string, b string")
    none = spark.createDataFrame([], SCALAR).drop("after")
    assert [tuple(r) for r in history.states(now, none, FIELDS).collect()] == [("K", START, "v", None)]
    assert history.states(now, none, FIELDS, require_history=True).count() == 0


def test_numbers_keep_their_type(spark):
    now = spark.createDataFrame([("K", START, 2.5, "x")], "key string, created timestamp_ntz, a double, b string")
    log = spark.createDataFrame([("K", START + timedelta(1), 0, 0, "a", "1.5"), ("K", START + timedelta(2), 1, 0, "a", "odd")],
                                "key string, changed_at timestamp_ntz, history_id long, item_ord int, header string, before string")
    got = [(r.valid_from, r.a) for r in history.states(now, log, FIELDS).orderBy("valid_from").collect()]
    assert got == [(START, 1.5), (START + timedelta(1), None), (START + timedelta(2), 2.5)]


def test_own_name_claims_the_change():
    routes = DEFAULT.routes()
    assert [r.header for r in routes["timeestimate"]] == ["epic_jira_remaining_dev_etc_md"]
    assert [r.header for r in routes["Fix Version"]] == ["epic_fix_version", "epic_PI", "epic_release_name"]
    assert "Rank" not in routes and "key" not in routes


def test_equivalence_either_order_null_and_new(spark):
    rows = spark.createDataFrame(
        [("x", "x"), (None, ""), ("a", "b"), ("b", "a"), ("c", "d"), ("d", "c"), (None, "e")], "a string, b string")
    known = spark.createDataFrame([("b", "a")], "var1 string, var2 string")
    got = {(r.a, r.b): r.match for r in history.equivalent(rows, "a", "b", known).collect()}
    assert got == {("x", "x"): "equal", (None, ""): "empty", ("a", "b"): "listed", ("b", "a"): "listed",
                   ("c", "d"): "new", ("d", "c"): "new", (None, "e"): "new"}
    new = {tuple(r) for r in history.new_equivalences(rows, "a", "b", known).collect()}
    assert new == {("c", "d"), (None, "e")}


def test_asof_takes_the_latest_earlier_day(spark):
    states = spark.createDataFrame(
        [("K", "2024-01-05T10:00:00.000+0200", "old"), ("K", "2024-01-05T23:30:00.000+0200", "late"), ("K", "2024-02-01T00:00:00", "new"),
         ("L", "2024-03-01T00:00:00", "only")], "key string, valid_from string, v string")
    got = snapshots.asof(states, ["2024-01-31", "2024-01-04", "2024-02-01", "2024-01-31"], keep_target=True)
    rows = sorted((r.key, str(r.target_date), str(r.extract_date), r.v) for r in got.collect())
    assert rows == [("K", "2024-01-31", "2024-01-05", "late"), ("K", "2024-01-31", "2024-01-05", "late"), ("K", "2024-02-01", "2024-02-01", "new")]


def test_texts_with_unlike_zones_are_in_time_order(spark):
    """The second change in text order came first: 23:00 and 04:30 of the next day, in UTC."""
    early, late = "2024-01-02T01:00:00.000+0200", "2024-01-01T23:30:00.000-0500"
    changes = spark.createDataFrame(
        [("k", late, 1, 0, "f", "b", "c"), ("k", early, 0, 0, "f", "a", "b")],
        "key string, changed_at string, history_id long, item_ord int, header string, before string, after string")
    current = spark.createDataFrame([("k", "2023-12-01T00:00:00.000+0000", "c")], "key string, created string, f string")
    found = {r.valid_from: r.f for r in history.states(current, changes.drop("after"), ["f"]).collect()}
    assert found == {"2023-12-01T00:00:00.000+0000": "a", early: "b", late: "c"}
    tags = spark.createDataFrame([("k", "f", "y")], "key string, header string, value string")
    moved = spark.createDataFrame(
        [("k", late, 1, 0, "f", "x", None), ("k", early, 0, 0, "f", None, "x"), ("k", early, 0, 1, "f", None, "y")],
        "key string, changed_at string, history_id long, item_ord int, header string, before string, after string")
    before = {(r.changed_at, r.item_ord): r.before for r in history.replay_list(tags, moved).collect()}
    assert before == {(late, 0): "y#x", (early, 0): "y", (early, 1): None}
    states = spark.createDataFrame([("k", "2024-01-01T23:30:00.000+0500", 1), ("k", "2024-01-01T20:00:00.000-0500", 2)], "key string, valid_from string, v int")
    assert [r.v for r in snapshots.daily_last(states).collect()] == [2]

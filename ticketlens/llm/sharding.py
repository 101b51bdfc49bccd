"""Balanced label propagation: linked documents move towards their neighbours' shards.

Documents start in shards by hash. In each round a document looks at the shards
of its neighbours, weighted, and may ask to move to the one that holds most of
them. Between each two shards as many requests are granted as come the other way
round, plus what room the target has left under its quota, so no shard overflows
while fewer links are cut. In the end, shards above their quota give away the
documents with the fewest links inside; sizes then differ by one row at most.

Only DataFrame operations: joins and combined aggregates over slim rows. Links
of a group are a star around its first row, not all pairs, and the share of each
shard in a group is one row per group and shard, so a group of any size is
handled; a group larger than a shard's quota fills several shards. To the driver
come the requests between two shards and the shard sizes, shards x shards rows.

Defined cases: null texts are linked with nothing. Repeated rows are placed each.
An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.session import materialize

ROUNDS = 4
#: Rows that one task ranks.
BUCKET_ROWS = 20_000


def _unit(*columns: Column) -> Column:
    """A repeatable number from 0 up to 1."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)).cast("double") / float(1 << 40)


def vertices(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """vid (its own for each row), doc_id, size, text_crc32 and group (the text's digest; null for a null text). Written once."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            F.crc32(whole).alias("text_crc32"),
            F.when(F.col(text).isNotNull(), F.unhex(F.md5(F.col(text)))).alias("group"),
        ).withColumn("vid", F.monotonically_increasing_id())
    )


def linked_rows(rows: DataFrame) -> DataFrame:
    """vid and group of the rows that share their group with another row."""
    shared = rows.groupBy("group").agg(F.count(F.lit(1)).alias("members")).filter(
        (F.col("members") > 1) & F.col("group").isNotNull()
    )
    return rows.select("vid", "group").join(shared.select("group"), "group")


def propagate(links: DataFrame, shards: int, shard_quota: float, rounds: int = ROUNDS) -> DataFrame:
    """vid, group and shard of linked rows after the rounds; `shard_quota` is the most that a shard may hold of them.

    Rows without links have no wish and fill up what is left, so they take no quota here.
    """
    placed = materialize(links.withColumn("shard", start_shard(F.col("vid"), shards)))
    sizes = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    for number in range(rounds):
        # how many members of each group are in each shard: combined before the shuffle
        spread = placed.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("held"))
        # a group wants the shards that already hold most of it, as many as it needs to fit
        order = Window.partitionBy("group").orderBy(F.col("held").desc(), F.xxhash64("group", "shard"))
        every = Window.partitionBy("group")
        ranked = spread.select(
            "group", "shard", "held", F.row_number().over(order).alias("place"), F.sum("held").over(every).alias("members")
        )
        homes = ranked.withColumn("homes", F.ceil(F.col("members") / max(shard_quota, 1.0)).cast("int"))
        wanted = homes.filter(F.col("place") <= F.col("homes")).groupBy("group", "homes").agg(
            F.array_sort(F.collect_list(F.struct("place", "shard"))).alias("targets")  # at most one entry per shard
        )
        pick = F.floor(_unit(F.col("vid"), F.lit("home")) * F.size("targets")).cast("int")
        asked = placed.join(wanted.select("group", "targets"), "group").select(
            "vid", "group", "shard",
            F.when(F.exists("targets", lambda t: t["shard"] == F.col("shard")), F.col("shard"))
            .otherwise(F.get("targets", pick)["shard"]).alias("target"),
        )
        asked = materialize(asked)
        flows = {
            (r["shard"], r["target"]): r["n"]
            for r in asked.filter("shard <> target").groupBy("shard", "target").agg(F.count(F.lit(1)).alias("n")).collect()
        }
        if not flows:
            break
        granted = {}
        room = {s: max(0.0, shard_quota - sizes.get(s, 0)) for s in range(shards)}
        coming = {s: sum(n for (_, t), n in flows.items() if t == s) for s in range(shards)}
        for (a, b), n in flows.items():
            swap = min(n, flows.get((b, a), 0))
            extra = room[b] * (n - swap) / max(coming[b], 1)
            granted[a, b] = min(1.0, (swap + extra) / n)
        rates = asked.sparkSession.createDataFrame(
            [(a, b, float(x)) for (a, b), x in granted.items()], "shard int, target int, rate double"
        )
        moved = asked.join(F.broadcast(rates), ["shard", "target"], "left")
        moves = _unit(F.col("vid"), F.lit(number)) < F.coalesce("rate", F.lit(0.0))
        placed = materialize(
            moved.select("vid", "group", F.when(moves, F.col("target")).otherwise(F.col("shard")).alias("shard"), F.col("shard").alias("was"))
        )
        for r in placed.filter("shard <> was").groupBy("was", "shard").agg(F.count(F.lit(1)).alias("n")).collect():
            sizes[r["was"]] = sizes.get(r["was"], 0) - r["n"]
            sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["n"]
    return placed.select("vid", "group", "shard")


def start_shard(vid: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(vid, F.lit("start")), F.lit(shards)).cast("int")


def place(rows: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Adds shard and slot (from 0, without gaps) to the rows of `vertices`; shard sizes differ by at most one row."""
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    linked = propagate(linked_rows(rows), shards, total / shards, rounds)
    # members of a group in its shard: those with the fewest leave first if the shard is too large
    inside = linked.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("inside"))
    linked = linked.join(inside, ["group", "shard"]).select(F.col("vid").alias("linked_vid"), F.col("shard").alias("linked_shard"), "inside")
    labelled = rows.join(linked, F.col("vid") == F.col("linked_vid"), "left").select(
        *rows.columns, F.coalesce("linked_shard", start_shard(F.col("vid"), shards)).alias("label"),
        F.coalesce("inside", F.lit(0)).alias("inside"),
    )
    # a rank within the label: rows without links first, then by group, so that a group leaves whole or not at all
    tier = F.when(F.col("inside") > 0, 1).otherwise(0)
    buckets = max(1, math.ceil(total / shards / BUCKET_ROWS))
    spot = F.coalesce(F.xxhash64("group"), F.xxhash64("vid"))
    # a group that would fill a bucket alone is spread over all
    together = (F.col("inside") > 0) & (F.col("inside") <= BUCKET_ROWS)
    bucket = tier * buckets + F.pmod(F.when(together, spot).otherwise(F.xxhash64("vid")), F.lit(buckets)).cast("int")
    bucketed = materialize(labelled.withColumn("spot", spot).withColumn("bucket", bucket))
    counts = bucketed.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # a row per label and bucket
    earlier = Window.partitionBy("label").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("label", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    sizes = {r["label"]: r["n"] for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    # the larger quotas go to the larger shards, so that fewer rows move
    by_size = sorted(range(shards), key=lambda s: (-sizes.get(s, 0), s))
    most = {s: q for s, q in zip(by_size, sorted(quota, reverse=True), strict=True)}
    leave = [max(0, sizes.get(s, 0) - most[s]) for s in range(shards)]
    stay = [sizes.get(s, 0) - leave[s] for s in range(shards)]
    ask = [most[s] - stay[s] for s in range(shards)]
    in_bucket = Window.partitionBy("label", "bucket").orderBy("inside", "spot", "vid")
    ranked = bucketed.join(offsets, ["label", "bucket"]).withColumn(
        "rank", F.col("offset") + F.row_number().over(in_bucket) - 1
    )
    leave_of, left_before = _by_shard("label", leave), _by_shard("label", [sum(leave[:s]) for s in range(shards)])
    moving = F.col("rank") < leave_of
    ranked = ranked.withColumn("queue", F.when(moving, left_before + F.col("rank")))
    home, slot = F.col("label"), F.col("rank") - leave_of
    begin_at = 0
    new_home, new_slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for s in range(shards):
        here = (F.col("queue") >= begin_at) & (F.col("queue") < begin_at + ask[s])
        new_home = F.when(here, s).otherwise(new_home)
        new_slot = F.when(here, F.col("queue") - begin_at + stay[s]).otherwise(new_slot)
        begin_at += ask[s]
    return ranked.select(
        *rows.columns, F.when(moving, new_home).otherwise(home).cast("int").alias("shard"),
        F.when(moving, new_slot).otherwise(slot).cast("long").alias("slot"),
    )


def _by_shard(column: str, values: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col(column) + 1)


#: Shard sizes are even in rows; adding a shard moves rows anywhere, so there is no shard to tell for one more.
LAW = "rows"


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 16, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null) of each row; equal texts are the links."""
    placed = place(vertices(docs, doc_id, text), shards, rounds)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

"""Near-duplicate documents by bottom-k sketches of one hash function.

A document is the set of its distinct 5-word shingles, hashed. Equal sets are one
class with the smallest id as its name. The k smallest hashes of a class are its
sketch. Inverted lists of the retained values give the overlaps: two classes
linked at 85 % share more than half of their sketches but for a chance below one
in a billion (at other thresholds a part as unlikely to be missed), so a class is listed only under those of its values that come first by
rarity and that a partner could not all miss. The classes of a list are gathered
around its smallest member; there the sketch of the union estimates the overlap
of each pair, and pairs that pass are confirmed on the full sets. Only links that
connect something new leave the task, so a group of n copies gives less than n
rows.

A gathered group is held in parts of at most `PART_SHINGLES` shingles. Members
that link with the group's centre need no more; the others meet all parts, part
by part.

Defined cases: a null or empty text is the empty set, linked with nothing. Rows
that repeat a doc_id share its class name and count as linked. Rows without an id
take part in their class; a class of nothing else goes by its smallest row_key, a
64-bit hash, so it is linked as any other. Equal sets have one class at any number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.graph import components
from ticketlens.llm.storage import small, stored
from ticketlens.llm.textblocks import LOWER, Block, Hasher, blocks, mix, spans
from ticketlens.session import materialize
from ticketlens.skew import lookup_join

SHINGLE_WORDS = 5
PERCENT = 85
SKETCH = 64
#: At PERCENT, linked classes share at least this part of their sketches, but for a negligible chance (7 standard deviations).
SHARED = 0.5
#: At PERCENT, pairs whose estimate is this far below the threshold are not confirmed (5 to 6 standard deviations).
SLACK = 0.25
PART_SHINGLES = 1_000_000

_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def shingle_sets(block: Block, hasher: Hasher) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a block."""
    data = LOWER[block.data]
    starts, ends, counts = spans(block)
    words = hasher.pieces(hasher.prefix(data), starts, ends)
    n = len(words) - SHINGLE_WORDS + 1
    runs = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(SHINGLE_WORDS if n > 0 else 0):
        runs += mix(words[k : n + k] * _PLACES[k])
    runs = mix(runs)
    at = 0
    for count in counts.tolist():
        if count >= SHINGLE_WORDS:
            yield np.unique(runs[at : at + count - SHINGLE_WORDS + 1])
        elif count:
            # fewer words than a shingle: the sequence is one, told apart by its length
            whole = sum(int(mix(words[at + k : at + k + 1] * _PLACES[k])[0]) for k in range(count)) + count * 0x9E3779B1
            yield mix(np.array([whole % (1 << 64)], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)
        at += count


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SKETCH) -> DataFrame:
    """doc_id, row_key, n_shingles, print_a and print_b (the set's fingerprint) and sketch (its smallest hashes, sorted)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for block in blocks(batch.column(1)):
                found = list(shingle_sets(block, hasher))
                cut = [s[:size].view(np.int64) for s in found]
                bounds = np.concatenate(([0], np.cumsum([len(c) for c in cut]))).astype(np.int32)
                values = np.concatenate(cut) if cut else np.zeros(0, dtype=np.int64)
                with np.errstate(over="ignore"):
                    prints = [
                        np.array([mix(s ^ np.uint64(salt)).sum(dtype=np.uint64) for s in found], dtype=np.uint64).view(np.int64)
                        for salt in (0x243F6A8885A308D3, 0x13198A2E03707344)
                    ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.rows), batch.column(2).slice(block.first, block.rows),
                        pa.array([len(s) for s in found], pa.int64()), *map(pa.array, prints), pa.ListArray.from_arrays(pa.array(bounds), pa.array(values)),
                    ],
                    ["doc_id", "row_key", "n_shingles", "print_a", "print_b", "sketch"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id), F.col(text)).alias("row_key"))
    id_type = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(sketch, f"doc_id {id_type}, row_key long, n_shingles long, print_a long, print_b long, sketch array<long>")


def allowances(percent: int = PERCENT) -> tuple[float, float]:
    """SHARED and SLACK at a threshold: as many standard deviations below it as theirs are below PERCENT."""
    wider = math.sqrt(percent * (100 - percent) / (PERCENT * (100 - PERCENT)))
    return max(percent / 100 - (PERCENT / 100 - SHARED) * wider, 1 / SKETCH), SLACK * wider


def listed_values(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """name, n_shingles and value: the inverted lists that a class must be in, rarest values first.

    Of m retained values a partner shares at least a part s (half at PERCENT), so
    it shares one of any m - s m + 1 of them. Of a set so small that its partners are retained whole, it
    shares `percent` for certain. Values that no other class has come first; a
    class with so many of those is in no list at all.
    """
    postings = classes.select("name", "n_shingles", F.explode("sketch").alias("value"))
    shared = postings.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    several = postings.join(shared, "value").groupBy("name", "n_shingles").agg(
        F.array_sort(F.collect_list(F.struct("n", "value"))).alias("values")  # at most one sketch
    )
    retained = F.least(F.col("n_shingles"), F.lit(SKETCH))
    whole = F.col("n_shingles") <= SKETCH * percent // 100
    needed = retained - F.when(whole, F.ceil(retained * percent / 100)).otherwise(F.ceil(retained * allowances(percent)[0])) + 1
    first = F.greatest(needed - (retained - F.size("values")), F.lit(0)).cast("int")
    return several.select("name", "n_shingles", F.explode(F.slice("values", F.lit(1), first)).alias("v")).select(
        "name", "n_shingles", F.col("v.value").alias("value")
    )


def gathered(lists: DataFrame) -> DataFrame:
    """centre, name, n_shingles: each class beside the smallest class of each of its lists, the centre itself included."""
    centres = lists.groupBy("value").agg(F.min("name").alias("centre"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    pairs = lists.join(centres.drop("n"), "value").select("centre", "name", "n_shingles").distinct()
    alone = pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > 1)
    return pairs.join(alone.select("centre"), "centre")


class Sketches:
    """The sketches of a group: the codes of their values in order, rows padded with -1."""

    def __init__(self, sets: list[np.ndarray], size: int = SKETCH) -> None:
        self.size = size
        self.length = np.array([min(len(s), size) for s in sets])
        _, codes = np.unique(np.concatenate([s[:size] for s in sets]), return_inverse=True)
        self.codes = np.full((len(sets), size), -1, dtype=np.int32)
        self.codes[np.arange(size) < self.length[:, None]] = codes
        self.rank = np.full(codes.max(initial=0) + 2, -1, dtype=np.int32)

    def estimate(self, a: int, who: np.ndarray) -> np.ndarray:
        """Estimated Jaccard similarity of a with others: the share of common values among the smallest of the union.

        Before a common value stand, in the union, those before it in either sketch, common ones once.
        """
        own = self.codes[a, : self.length[a]]
        self.rank[own] = np.arange(len(own))
        rank = self.rank[self.codes[who]]
        self.rank[own] = -1
        common = rank >= 0
        before = np.cumsum(common, axis=1) - common
        place = rank + np.arange(self.size) - before
        union = self.length[a] + self.length[who] - common.sum(axis=1)
        return (common & (place < self.size)).sum(axis=1) / np.maximum(np.minimum(union, self.size), 1)


class Forest:
    """Which members of a group are connected already."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, a: int, others: np.ndarray) -> list[int]:
        """Connect a with the others; those that were not yet."""
        new = []
        for b in others.tolist():
            if self.root[a] != self.root[b]:
                self.root[self.root == self.root[b]] = self.root[a]
                new.append(b)
        return new


def group_links(sets: list[np.ndarray], asked: np.ndarray, centre: int, percent: int = PERCENT) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links of the `asked` members with any member that connect something new, and who links with the centre."""
    n = np.array([len(s) for s in sets])
    begin = np.cumsum(n) - n
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    codes, has = codes.astype(np.int32), np.zeros(len(values), dtype=np.int32)

    def common(a: int) -> np.ndarray:
        """Sizes of the intersections of a with every member; no set is empty."""
        own = codes[begin[a] : begin[a] + n[a]]
        has[own] = 1
        found = np.add.reduceat(has[codes], begin)
        has[own] = 0
        return found

    def linked(inter: np.ndarray, a: int, who: np.ndarray) -> np.ndarray:
        return 100 * inter >= percent * (n[a] + n[who] - inter)

    every = np.arange(len(sets))
    with_centre = common(centre)
    forest, links = Forest(len(sets)), []
    least = percent / 100 - allowances(percent)[1]
    near = linked(with_centre, centre, every)
    links += [(centre, b) for b in forest.join(centre, every[near])]
    left = asked[~near[asked]]
    if len(left):
        sketched = Sketches(sets)
        for a in left.tolist():
            # what both have and have not of the centre bounds their overlap
            most = np.minimum(with_centre[a], with_centre) + np.minimum(n[a] - with_centre[a], n - with_centre)
            who = every[(forest.root != forest.root[a]) & linked(most, a, every)]
            if len(who):
                who = who[sketched.estimate(a, who) >= least]
            if len(who):
                links += [(a, b) for b in forest.join(a, who[linked(common(a)[who], a, who)])]
    return links, near


def _links_of(percent: int):
    """The function of one task: rows centre, name, asked (does this row meet all others here?), shingles."""

    def links(group: pa.Table) -> pa.Table:
        names, centre = group.column("name").to_numpy(), group.column("centre")[0].as_py()
        asked = group.column("asked").to_numpy()
        order = np.lexsort((~asked, names))
        sets = [np.frombuffer(group.column("shingles")[int(k)].as_py(), dtype=np.uint64) for k in order]
        names, asked = names[order], asked[order]
        middle = int(np.flatnonzero(names == centre)[0])
        found, near = group_links(sets, np.flatnonzero(asked), middle, percent)
        a, b = (np.array([names[pair[k]] for pair in found], dtype=np.int64) for k in (0, 1))
        open_ = np.unique(names[~near & asked])
        return pa.table({
            "centre": np.full(len(a) + len(open_), centre, dtype=np.int64),
            "a": np.concatenate([a, open_]), "b": pa.array([*b.tolist(), *[None] * len(open_)], pa.int64()),
        })

    return links


def links_between(members: DataFrame, sets: DataFrame, percent: int = PERCENT, part_shingles: int = PART_SHINGLES) -> DataFrame:
    """a, b: confirmed links that connect all linked members of each gathered group."""
    sizes = members.groupBy("centre").agg(F.ceil(F.sum("n_shingles") / part_shingles).cast("int").alias("parts"))
    members = materialize(members.join(sizes, "centre").withColumn("part", F.pmod(F.xxhash64("name"), F.col("parts")).cast("int")))
    # the centre is in every part; all others are in their own
    everywhere = F.when(F.col("name") == F.col("centre"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    first = members.select("centre", "name", F.explode(everywhere).alias("part"), (F.col("name") != F.col("centre")).alias("asked"))
    schema = "centre long, a long, b long"
    found = materialize(
        first.join(sets, "name").groupBy("centre", "part").applyInArrow(_links_of(percent), schema)
    )
    links = found.filter(F.col("b").isNotNull()).select("a", "b")
    # what did not link with the centre meets the other parts too
    large = members.filter(F.col("parts") > 1)
    if large.isEmpty():
        return links
    open_ = found.filter(F.col("b").isNull()).select("centre", F.col("a").alias("name"))
    asking = large.join(open_, ["centre", "name"]).select(
        "centre", "name", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"), F.col("part").alias("from"), F.lit(True).alias("asked")
    )
    tasks = asking.select("centre", "from", "with").distinct()
    here = large.withColumn("with", F.col("part")).join(tasks, ["centre", "with"]).filter(F.col("with") != F.col("from"))
    answering = here.select("centre", "name", "with", "from", F.lit(False).alias("asked"))
    middle = tasks.filter(F.col("with") != F.col("from")).select(
        "centre", F.col("centre").alias("name"), "with", "from", F.lit(False).alias("asked")
    )
    both = asking.filter(F.col("with") != F.col("from")).unionByName(answering).unionByName(middle).dropDuplicates(
        ["centre", "name", "with", "from"]
    )
    more = both.join(sets, "name").groupBy("centre", "with", "from").applyInArrow(_links_of(percent), schema)
    return links.union(more.filter(F.col("b").isNotNull()).select("a", "b"))


def full_sets(docs: DataFrame, names: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """name and shingles (sorted 64-bit hashes) of the named documents, computed again from their texts."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for block in blocks(batch.column(1)):
                packed = pa.array([s.tobytes() for s in shingle_sets(block, hasher)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.rows), packed], ["name", "shingles"])

    rows = docs.select(F.col(doc_id).alias("name"), F.col(text).alias("text")).join(small(names), "name", "left_semi")
    return rows.mapInArrow(build, "name long, shingles binary").filter(F.length("shingles") > 0)


def _without_id(docs: DataFrame) -> DataFrame:
    """The rows without an id under their row_key, equal ones once."""
    nameless = docs.filter(F.col("doc_id").isNull()).select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    return nameless.dropDuplicates(["doc_id"])


def _groups(classes: DataFrame, roots: DataFrame, nameless: bool) -> DataFrame:
    """The classes with group (the root of their component), component (its smallest doc_id) and lead (no class of the group comes before)."""
    named = classes.drop("sketch").join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("group", F.coalesce("root", "name"))
    if not nameless:
        return named.select("*", F.col("group").alias("component"), (F.col("name") == F.col("group")).alias("lead"))
    # a hash may be the smallest name of a group that has ids
    ids = named.groupBy("group").agg(F.min("first_id").alias("component"))
    found = lookup_join(stored(named), stored(ids), ["group"])
    return found.withColumn("group", F.coalesce("component", "group")).withColumn("lead", F.col("name") == F.col("group"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, part_shingles: int = PART_SHINGLES
) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id (the smallest linked id), kept (is it its own) and group_id for each row; ids are long.

    A component without any id has a null component_id; there kept is true for
    the rows of the class with the smallest row_key. group_id is the component_id,
    else that row_key; it is null only for rows with neither an id nor words.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = stored(sketches(docs))
    prints = ["print_a", "print_b", "n_shingles"]
    classes = rows.filter(F.col("n_shingles") > 0).groupBy(*prints).agg(
        F.min("doc_id").alias("first_id"), F.min("row_key").alias("first_key"), F.first("sketch").alias("sketch")
    )
    classes = stored(classes.withColumn("name", F.coalesce("first_id", "first_key")).drop("first_key"))
    nameless = not classes.filter(F.col("first_id").isNull()).isEmpty()
    members = materialize(gathered(listed_values(classes, percent)))
    names = members.select("name").distinct()
    sets = full_sets(docs, names)
    if nameless:
        sets = sets.unionByName(full_sets(_without_id(docs), names))
    links = links_between(members, sets, percent, part_shingles)
    grouped = _groups(classes, components(links.select("a", "b")), nameless).select(
        *[F.col(c).alias(f"class_{c}") for c in prints], F.col("group").alias("class_group"), F.col("component").alias("class_component"), "lead"
    )
    same = [F.col(c) == F.col(f"class_{c}") for c in prints]
    joined = rows.drop("sketch").join(grouped, same[0] & same[1] & same[2], "left")
    component = F.coalesce("class_component", F.when(F.col("class_group").isNull(), F.col("doc_id")))
    kept = F.when(component.isNull(), F.coalesce("lead", F.lit(True))).otherwise(F.col("doc_id").eqNullSafe(component))
    return joined.select(
        "doc_id", "row_key", "n_shingles", component.alias("component_id"), kept.alias("kept"), F.coalesce("class_group", "doc_id").alias("group_id")
    )

"""Links between similar items that share buckets, and the components they form.

Items are known by 64-bit ids. Nothing here holds a bucket, a component or the links of an item in
one task: buckets are reduced to aggregates and joined, and components are found by repeated group-
bys over written tables.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levelscope.llm.texts import ranges
from levelscope.llm.workers import mapped
from levelscope.session import scratch, stage

#: Links that one task merges at a time before they are dealt out.
FOREST_LINKS = 200_000
#: Elements of a bucket that one task holds of each of the two parts it compares, about.
PART_ELEMENTS = 500_000
#: Places at which an item's elements are marked, by their last bits. Items that may be similar by the marks of the other's elements
#: are compared by the elements.
MARKS = 1 << 20


def _forests(links: DataFrame) -> DataFrame:
    """Union-find within each task, over bounded runs of links: a link from each item to the
    smallest item of its tree."""

    def run(batches):
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        def flush():
            rows = [(x, find(x)) for x in list(parent)]
            rows = [(x, top) for x, top in rows if x != top]
            parent.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = find(a), find(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) > FOREST_LINKS:
                yield flush()
        yield flush()

    return mapped(
        links.select(F.col("a").cast("long"), F.col("b").cast("long")), run, "a long, b long"
    )


def components(links: DataFrame, label: str) -> DataFrame:
    """``id`` and ``root``, the smallest id of its component, for every id that has a link.

    Each task first merges its own links, ``FOREST_LINKS`` or more of them. Then, in turns, each item sends its larger neighbours to
    its smallest one (large star), and its smaller neighbours and itself to the smallest (small star),
    until the links do not change any more; they are then stars. An item with many neighbours
    is a group-by with map-side minimum and a join, never a list.
    """

    def turn(pairs: DataFrame) -> DataFrame:
        both = pairs.union(pairs.select("b", "a"))
        lowest = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(lowest, "a").where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        return (
            small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lowest.select("a", F.col("m").alias("b"))).distinct()
        )

    def state(pairs: DataFrame):
        mixed = F.xxhash64("a", "b")
        return pairs.agg(
            F.count("*"),
            F.coalesce(F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(0)),
            F.coalesce(F.sum(F.shiftrightunsigned(mixed, 32)), F.lit(0)),
        ).first()

    tasks = 1 + links.count() // FOREST_LINKS
    pairs = stage(_forests(links.coalesce(tasks)).where("a != b").distinct(), f"{label}-forest")
    before = state(pairs)
    while before[0]:
        pairs = stage(turn(pairs), f"{label}-stars")
        after = state(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("root"))
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("root")).union(roots)


def similar(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """Adds ``similarity``, the exact Jaccard similarity of the items' elements, to (a, b)."""
    left = features.select(F.col("id").alias("a"), F.col("elements").alias("x"))
    right = features.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("common", common)
        .withColumn("either", F.size("x") + F.size("y") - F.col("common"))
        .select("a", "b", (F.col("common") / F.col("either")).alias("similarity"))
    )


def _within_buckets(rows: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) found by comparing the items of a bucket, or of two parts of it.

    ``rows`` has the group (``key``, ``low``, ``high``), sorted by it, ``id``, ``part``, ``root`` and
    ``elements``. Items in one component are not compared, nor any that a link found here connects, so
    a group gives fewer links than it has items.
    """

    def links(ids, parts, roots, bounds, flat, mine):
        comp = np.unique(roots, return_inverse=True)[1]
        sizes = np.diff(bounds)
        marks = flat & (MARKS - 1)
        apart = len(np.unique(parts)) > 1
        found = []
        for i in range(len(ids) - 1):
            open_ = comp[i + 1 :] != comp[i]
            if apart:
                open_ &= parts[i + 1 :] != parts[i]
            small = np.minimum(sizes[i], sizes[i + 1 :])
            open_ &= small >= threshold * np.maximum(sizes[i], sizes[i + 1 :])
            others = np.flatnonzero(open_) + i + 1
            if not len(others):
                continue
            own = slice(bounds[i], bounds[i + 1])
            mine[marks[own]] = True
            there = mine[marks[ranges(bounds[others], sizes[others])]].astype(np.int64)
            most = np.add.reduceat(there, np.cumsum(sizes[others]) - sizes[others])
            mine[marks[own]] = False
            for j in others[most >= threshold * (sizes[i] + sizes[others] - most)]:
                if comp[j] != comp[i]:
                    common = len(np.intersect1d(flat[own], flat[bounds[j] : bounds[j + 1]], assume_unique=True))
                    if common >= threshold * (sizes[i] + sizes[j] - common):
                        found.append((ids[i], ids[j]))
                        comp[comp == comp[j]] = comp[i]
        return found

    def batch_of(found):
        return pa.RecordBatch.from_arrays(
            [pa.array([int(f[k]) for f in found], pa.int64()) for k in (0, 1)], ["a", "b"]
        )

    def run(batches):
        held: list[pa.RecordBatch] = []  # the rows of the group that the last batch ended in
        mine = np.zeros(MARKS, bool)

        def groups(batch):
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            held.clear()
            names = ("key", "low", "high")
            group = [table.column(c).to_numpy() for c in names]
            fresh = np.ones(table.num_rows, bool)
            fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in group])
            firsts = np.append(np.flatnonzero(fresh), table.num_rows)
            ids, parts, roots = (table.column(c).to_numpy() for c in ("id", "part", "root"))
            elements = table.column("elements").chunk(0)
            ends = elements.offsets.to_numpy()
            flat = elements.values.to_numpy()
            for a, b in zip(firsts[:-2], firsts[1:-1]):
                bounds = ends[a : b + 1].astype(np.int64)
                yield (
                    ids[a:b], parts[a:b], roots[a:b], bounds - bounds[0], flat[bounds[0] : bounds[-1]]
                )
            held.extend(table.slice(firsts[-2]).combine_chunks().to_batches())

        def end():
            if held:
                last = held[0].slice(0, 1)
                yield from groups(_closing(last))

        for batch in batches:
            if batch.num_rows:
                yield batch_of([x for g in groups(batch) if len(g[0]) > 1 for x in links(*g, mine)])
        yield batch_of([x for g in end() if len(g[0]) > 1 for x in links(*g, mine)])

    return mapped(rows, run, "a long, b long")


def _closing(row: pa.RecordBatch) -> pa.RecordBatch:
    """A row of another group, which ends the group before it."""
    at = row.schema.get_field_index("low")
    return row.set_column(at, row.schema.field(at), pa.array([-1], row.schema.field(at).type))


def linked(
    members: DataFrame,
    features_of: Callable[[DataFrame], DataFrame],
    threshold: float,
    label: str,
) -> DataFrame:
    """Components over all pairs that share a bucket and are similar: ``id`` and ``root``.

    ``members`` has the bucket ``key`` and ``id``, repeated or not; ``features_of`` gives (id, elements), with distinct
    elements, for a table of ids. Pairs that are in one component already need no comparison:

    1. each item is compared with the smallest item that leads one of its buckets, which settles groups
       of copies of any size by as many comparisons as they have items;
    2. in buckets whose items are in different components by then, the items are compared with
       each other across components. A bucket of more than ``PART_ELEMENTS`` elements is dealt out
       in parts, and each pair of parts is a task's work of its own; only links are returned.
    """
    groups = members.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last"))
    shared = members.join(groups.where("leader != last"), "key").select("key", "id", "leader")
    shared = stage(shared.distinct(), f"{label}-buckets")
    features = stage(features_of(shared.select("id").distinct()), f"{label}-features")

    followers = shared.where("id != leader")
    first = followers.groupBy(F.col("id").alias("b")).agg(F.min("leader").alias("a"))
    links = stage(
        similar(first, features).where(F.col("similarity") >= threshold).select("a", "b"), f"{label}-first"
    )
    roots = components(links, f"{label}-first")

    known = shared.select("key", "id").join(roots, "id", "left")
    known = known.withColumn("root", F.coalesce("root", "id"))
    more = across(known, features, threshold, label)
    if more.isEmpty():
        return roots
    return components(links.union(more), f"{label}-all")


def across(known: DataFrame, features: DataFrame, threshold: float, label: str) -> DataFrame:
    """Links (a, b) between items of different components, from comparing the items of each bucket.

    ``known`` has the bucket ``key``, ``id`` and ``root``, the component's. Buckets within one component are passed over.
    """
    sized = known.join(features.select("id", F.size("elements").cast("long").alias("size")), "id")
    open_keys = (
        sized.groupBy("key")
        .agg(F.min("root").alias("least"), F.max("root").alias("most"), F.sum("size").alias("size"))
        .where("least != most")
        .select("key", F.ceil(F.col("size") / PART_ELEMENTS).cast("int").alias("parts"))
    )
    rest = stage(known.join(open_keys, "key"), f"{label}-open")
    part = F.pmod(F.xxhash64("id", "key"), F.col("parts")).cast("int")
    placed = (
        rest.withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
            "id", "part", "root",
        )
    )
    dealt = placed.join(features, "id").select("key", "low", "high", "id", "part", "root", "elements")
    dealt = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "id")
    return stage(_within_buckets(dealt, threshold), f"{label}-within")


#: Of 64 one-bit minhashes, how many may differ in items that are looked at more closely. Of items
#: with a similarity of 0.8, one bit differs with probability 0.1, and more than 20 in one pair of two million.
SKETCH_APART = 20
#: Items of a bucket whose sketches are compared pair by pair, at most.
SKETCHED_BUCKET = 2000
#: Pairs of a bucket, for each of its items, up to which they are looked at one by one in the second round.
PAIRS_AN_ITEM = 8


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64))


def _groups_of(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups of sorted keys begin, and the first row of each row's group."""
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(fresh)
    return first, np.repeat(first, np.diff(np.append(first, len(key))))


def _by_key(batches):
    """Whole groups of rows sorted by ``key``, as columns of arrays, many at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        key = batch.column("key").to_numpy()
        last = int(np.searchsorted(key, key[-1]))
        if last == 0 and len(held) > 1 and held[0].column("key")[0].as_py() == key[-1]:
            continue  # the group goes on
        table = pa.Table.from_batches([*held[:-1], batch.slice(0, last)])
        if table.num_rows and key[-1] != table.column("key")[-1].as_py():
            yield {name: table.column(name).to_numpy() for name in table.column_names}
            held = [batch.slice(last)]
    if held:
        table = pa.Table.from_batches(held)
        yield {name: table.column(name).to_numpy() for name in table.column_names}


def _rows_and_pairs(rows: dict[str, np.ndarray], one: np.ndarray, two: np.ndarray) -> pa.RecordBatch:
    """Rows of some columns, and pairs ``a`` and ``b`` without these."""
    n, m = len(next(iter(rows.values()))), len(one)
    columns = [pa.concat_arrays([pa.array(c, pa.int64()), pa.nulls(m, pa.int64())]) for c in rows.values()]
    columns += [pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(c, pa.int64())]) for c in (one, two)]
    return pa.RecordBatch.from_arrays(columns, [*rows, "a", "b"])


def _joined(found: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *found])


def sketch_pairs(shared: DataFrame) -> DataFrame:
    """``a`` and ``b`` of items in one bucket with like sketches: in turns, the bucket's smallest item with all that are
    like it, and then no more of these. ``shared`` has ``key``, ``id`` and ``sketch``; fewer pairs than rows. Besides,
    the rows of buckets in which other pairs may be left: those with like items and more than two in all, and those
    with very many."""

    def run(batches):
        for rows in _by_key(batches):
            key, ids, sketch = (rows[c] for c in ("key", "id", "sketch"))
            first = _groups_of(key)[0]
            counts = np.diff(np.append(first, len(key)))
            bucket, more = np.repeat(np.arange(len(counts)), counts), counts > SKETCHED_BUCKET
            one, two = [], []
            while len(key):
                _, lead = _groups_of(key)
                like = _apart(sketch, sketch[lead]) <= SKETCH_APART
                found = like & (lead != np.arange(len(key)))
                one.append(ids[lead[found]])
                two.append(ids[found])
                more[bucket[found]] = True
                key, ids, sketch, bucket = key[~like], ids[~like], sketch[~like], bucket[~like]
            more = np.repeat(more & (counts > 2), counts)
            yield _rows_and_pairs({c: rows[c][more] for c in ("key", "id", "sketch")}, _joined(one), _joined(two))

    dealt = shared.select("key", "id", "sketch").repartition("key").sortWithinPartitions("key", "id")
    return mapped(dealt, run, "key long, id long, sketch long, a long, b long")


def sketch_open(known: DataFrame) -> DataFrame:
    """Pairs ``a`` and ``b`` of items of different components with like sketches in one bucket, which ``sketch_pairs`` has
    not brought together; of buckets with more than ``PAIRS_AN_ITEM`` of them for each item the ``key`` instead, so that no
    more pairs are made than that. Those with very many items count as such if they are of different components.
    ``known`` has ``key``, ``id``, ``root`` and ``sketch``."""

    def run(batches):
        for rows in _by_key(batches):
            key, ids, root, sketch = (rows[c] for c in ("key", "id", "root", "sketch"))
            first, _ = _groups_of(key)
            counts = np.diff(np.append(first, len(key)))
            mixed = np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first)
            large = key[first[mixed & (counts > SKETCHED_BUCKET)]]
            asked = mixed & (counts > 2) & (counts <= SKETCHED_BUCKET)
            ask, names, counts = np.repeat(asked, counts), key[first[asked]], counts[asked]
            key, ids, root, sketch = key[ask], ids[ask], root[ask], sketch[ask]
            bucket = np.repeat(np.arange(len(names)), counts)
            # the item that each one was brought together with
            met, left = np.full(len(key), -1), np.arange(len(key))
            while len(left):
                lead = left[_groups_of(key[left])[1]]
                like = _apart(sketch[left], sketch[lead]) <= SKETCH_APART
                met[left[like]] = lead[like]
                left = left[~like]
            left, seen, one, two = np.arange(len(key)), np.zeros(len(names), np.int64), [], []
            while len(left):
                row_of = _groups_of(key[left])[1]
                lead = left[row_of]
                like = _apart(sketch[left], sketch[lead]) <= SKETCH_APART
                like &= (root[left] != root[lead]) & (met[left] != lead)
                one.append(lead[like])
                two.append(left[like])
                seen += np.bincount(bucket[left[like]], minlength=len(names))
                open_ = (seen <= PAIRS_AN_ITEM * counts)[bucket[left]]
                left = left[(row_of != np.arange(len(left))) & open_]
            many = seen > PAIRS_AN_ITEM * counts
            one, two = _joined(one), _joined(two)
            few = ~many[bucket[two]]
            yield _rows_and_pairs({"key": np.concatenate([large, names[many]])}, ids[one[few]], ids[two[few]])

    dealt = known.select("key", "id", "root", "sketch").repartition("key").sortWithinPartitions("key", "id")
    return mapped(dealt, run, "key long, a long, b long")


def linked_by_sketch(
    buckets: DataFrame,
    lines_of: Callable[[DataFrame], DataFrame],
    alike: Callable[[DataFrame, DataFrame], DataFrame],
    features_of: Callable[[DataFrame], DataFrame],
    threshold: float,
    label: str,
) -> DataFrame:
    """As :func:`linked`, over ``band_exchange.shared_keys``: items are compared exactly if their sketches are
    like. The same two rounds: pairs with the leaders of buckets, of which ``alike`` gives those that are
    similar; then, where a bucket holds like items of different components that have not met, these pairs if they are
    not too many for its size; other such buckets, and settled ones of different components, are worked through in parts.
    ``lines_of`` gives once, for a table of ids, a written table of what ``alike`` and ``features_of`` need of all items that may be
    compared: those of some pair, or of a bucket that may hold others. Its ``node``, if not null, is another item that
    is one with the item ``id``; this counts as a link if ``id`` has one."""

    def tied(found: DataFrame) -> DataFrame:
        ids = found.select(F.explode(F.array("a", "b")).alias("a")).distinct()
        ties = lines.where("node is not null").select(F.col("id").alias("a"), F.col("node").alias("b"))
        return found.union(ties.join(ids, "a", "left_semi"))

    def rooted(rows: DataFrame) -> DataFrame:
        return rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))

    sketches = buckets.where("key is null").select("id", "sketch")  # of each item once
    pairs = buckets.where("key is not null").select("key", "id", "leader")
    shared = pairs.where("leader is null").join(sketches.hint("shuffle_hash"), "id")
    met = stage(sketch_pairs(shared), f"{label}-met")
    settled = pairs.where("leader is not null")
    busy = stage(settled.select("key").distinct(), f"{label}-busy")
    # settled keys are few: those of many items in one pack
    settled_rows = stage(pairs.join(busy, "key", "left_semi").select("key", "id"), f"{label}-settled")
    large = met.where("key is not null").select("key", "id", "sketch")
    chosen = met.where("key is null").select("a", "b").union(settled.select(F.col("leader").alias("a"), F.col("id").alias("b")))
    chosen = stage(chosen.distinct(), f"{label}-pairs")
    ids = chosen.select(F.explode(F.array("a", "b")).alias("id")).union(large.select("id")).union(settled_rows.select("id"))
    lines = lines_of(ids.distinct())
    links = stage(tied(stage(alike(chosen, lines), f"{label}-links")), f"{label}-first")
    roots = stage(components(links, f"{label}-first"), f"{label}-roots")

    spread = rooted(settled_rows).groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    others = stage(sketch_open(rooted(large.join(busy, "key", "left_anti"))).distinct(), f"{label}-left")
    further = others.where("key is null").select("a", "b")
    # the components so far as stars, which need no more turns
    stars = roots.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    second = stage(alike(further, lines), f"{label}-second-links")
    links = stage(stars.union(tied(second)), f"{label}-second")
    keys = stage(spread.where("x != y").select("key").union(others.where("key is not null").select("key")).distinct(), f"{label}-keys")
    if keys.isEmpty():
        return components(links, f"{label}-second")
    rest = large.select("key", "id").union(settled_rows).distinct().join(keys, "key", "left_semi")
    rest = stage(rooted(rest).select("key", "id", "root"), f"{label}-rest")
    features = stage(features_of(lines.join(rest.select("id").distinct(), "id", "left_semi")), f"{label}-features")
    more = across(rest, features, threshold, label)
    return components(stage(links.union(tied(more)), f"{label}-third"), f"{label}-all")

"""Similarity links between sets, and their connected components, on Spark.

Sets are sorted arrays of unsigned 64-bit codes under one global order. Two sets of
sizes a and b are linked when ``factor * |A xor B| <= a + b``; for a Jaccard
similarity of at least j that is ``factor = (1 + j) / (1 - j)``: 19 for 0.9, 9 for 0.8.

Candidates arrive as records (token, sid): sets that share a token may be linked.
A token's smallest sid is its pivot, and sets that share a token share its pivot, so
blocks are formed by pivot: the many tokens that the same sets share fall together.

* A block of at most ``SMALL`` sets is joined in one task by a prefix tree: sets
  share the tree's path as far as they agree, a query walks the tree counting
  mismatches, and a subtree is left as soon as the mismatches, with what the
  remaining lengths must add, exceed what its sets allow.
* A larger block (a hot group of near copies) is never joined pair by pair. Its sets
  are compared with the block's centre C, the elements that half of them have: in a
  group of edited copies, the text they were made from. With D = A xor C and
  g(A) = factor * |D| - |A|, two sets whose differences have nothing in common are
  linked just if g(A) + g(B) <= 0, and such sets stay linked if they do have. So all
  of these links run over the set H with the least g: who may be linked so to anyone
  is linked to H. A set that isn't ("outer") is linked only where its difference
  overlaps by at least (g(A) + g(B)) / (2 * factor) > 0. So the differences of outer
  sets, a few elements each, are blocked by prefixes of their own and joined with all
  others by the same prefix tree. Blocks of these that are still large are cut into
  chunks, and pairs of chunks spread over tasks; no pair is dropped and none is
  written unless it is linked.

Every task emits a spanning forest of its links. Components are found by the
alternating large-star and small-star rounds, each checkpointed.
"""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, reliable_checkpoint
from .shingles import slices

SMALL = 256
CHUNK = 256
#: How often records of sets that share too little are looked for.
COUNTS = 2

LINKS = "a binary, b binary"


class PrefixTree:
    """A path-compressed trie over sorted code lists, with bounds per subtree."""

    __slots__ = ("segment", "ends", "children", "most", "shortest", "longest")

    def __init__(self, sets: list, sizes: list[int], order: list[int], depth: int = 0):
        first, last = sets[order[0]], sets[order[-1]]
        end, limit = depth, min(len(first), len(last))
        while end < limit and first[end] == last[end]:
            end += 1
        self.segment = first[depth:end]
        self.ends = [i for i in order if len(sets[i]) == end]
        self.most = max(sizes[i] for i in order)
        self.shortest = min(len(sets[i]) for i in order) - end
        self.longest = max(len(sets[i]) for i in order) - end
        rest, self.children, at = order[len(self.ends):], [], 0
        while at < len(rest):
            token, stop = sets[rest[at]][end], at + 1
            while stop < len(rest) and sets[rest[stop]][end] == token:
                stop += 1
            self.children.append(PrefixTree(sets, sizes, rest[at:stop], end))
            at = stop


def tree_links(keys: list, sizes: list[int], sets: list[list[int]], factor: int, sides: list[int] | None = None):
    """Pairs of positions that join linked sets, a spanning forest of all links;
    with ``sides``, only links between different sides count."""
    parent = list(range(len(keys)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    order = sorted(range(len(sets)), key=lambda i: sets[i])
    tree = PrefixTree(sets, sizes, order)
    out = []
    for i in order:
        query, n, whole = sets[i], sizes[i], set(sets[i])
        stack = [(tree, 0, 0)]
        while stack:
            node, at, misses = stack.pop()
            if node.segment:
                shared = len(whole.intersection(node.segment))
                to = bisect_right(query, node.segment[-1], at)
                misses += len(node.segment) + to - at - 2 * shared
                at = to
            left = len(query) - at
            gap = left - node.longest if left > node.longest else max(0, node.shortest - left)
            if factor * (misses + gap) > n + node.most:
                continue
            for j in node.ends:
                if (j != i and keys[i] != keys[j] and (sides is None or sides[i] != sides[j])
                        and factor * (misses + left) <= n + sizes[j]):
                    a, b = root(i), root(j)
                    if a != b:
                        parent[a] = b
                        out.append((i, j))
            for child in node.children:
                stack.append((child, at, misses))
    return out


def only_shared(raw: list[bytes], sizes: list[int], factor: int) -> tuple[list[list[int]], list[int]]:
    """Sets (codes as bytes) as ranks of the codes that stand in two of them, and their
    sizes less ``factor`` for each other code: such a code is a mismatch with every
    set, so ``tree_links`` finds the same links and holds the shared codes only."""
    every = np.frombuffer(b"".join(raw), "<u8").copy()
    every.sort()
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    del every
    ranks, sets, left = list(range(len(shared))), [], []
    for x, n in zip(raw, sizes):
        codes = np.frombuffer(x, "<u8")
        at = np.searchsorted(shared, codes)
        at = at[shared[np.minimum(at, len(shared) - 1)] == codes] if len(shared) else at[:0]
        sets.append([ranks[i] for i in at])  # equal codes are one object in all sets
        left.append(n - factor * (len(codes) - len(at)))
    return sets, left


#: Sides of a group's rows: all are joined with each other, or 0 with 1 only.
WITHIN = 2
#: Bytes of codes that are taken out of a batch at once.
SLICE_BYTES = 2 << 20


def _group_links(rows: DataFrame, parts: int, factor: int) -> DataFrame:
    """Links within groups of rows (grp, side, key, n, codes)."""

    def run(batches):
        def links(group):
            sides, keys, sizes, raw = map(list, zip(*group))
            two = None if sides[0] == WITHIN else sides
            if two and len(set(two)) < 2:
                return []
            group.clear()
            sets, sizes = only_shared(raw, sizes, factor)
            raw.clear()
            return [(keys[i], keys[j]) for i, j in tree_links(keys, sizes, sets, factor, two)]

        def emit(out):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], ["a", "b"])

        here, group, out = None, [], []
        for batch in batches:
            for part in slices(batch, 4, SLICE_BYTES):
                for grp, *row in zip(*(c.to_pylist() for c in part.columns)):
                    if grp != here:
                        if len(group) > 1:
                            out += links(group)
                        here, group = grp, []
                    group.append(row)
            if out:
                yield emit(out)
                out = []
        if len(group) > 1:
            out += links(group)
        if out:
            yield emit(out)

    return (rows.select("grp", "side", "key", "n", "codes").repartition(parts, "grp")
            .sortWithinPartitions("grp").mapInArrow(run, LINKS))


def by_size(rows: DataFrame, factor: int) -> DataFrame:
    """Records (token, sid, n, ..) twice, with tokens of their own for sets of like
    sizes: for the set's rung on a ladder of sizes, and for the next. The sizes of
    linked sets are at most a rung apart, so they have one of their rungs in common."""
    ratio = math.log((factor + 1) / (factor - 1)) * (1 + 1e-9)
    rung = F.floor(F.log("n") / ratio).cast("int")
    return (rows.withColumn("rung", F.explode(F.array(rung, rung + 1)))
            .withColumn("token", F.xxhash64("token", "rung")))


def members_of(records: DataFrame, needs: DataFrame | None = None, factor: int = 0) -> DataFrame:
    """(pivot, sid) from candidate records (token, sid), stored (and rid of unique tokens, see
    ``with_repeated``), without tokens that only one sid has; a block's pivot is one of its members.
    With ``needs`` (sid, n, need), records are (token, sid, core): linked sets share ``need``
    tokens or more, and one that is core for both. Sets are counted against sets of like
    size, and only core tokens form blocks."""
    spark = records.sparkSession

    def shared_by_two(rows):
        return (rows.groupBy("token").agg(F.min("sid").alias("pivot"), F.max("sid").alias("other"))
                .filter("pivot <> other").select("token", "pivot"))

    if needs is not None:
        shared = reliable_checkpoint(records.join(shared_by_two(records), "token").select("token", "sid", "core").distinct())
        release(spark)
        enough = (shared.groupBy("sid").agg(F.count("*").alias("c")).join(needs, "sid")
                  .filter("c >= need").select("sid", "n", "need"))
        records = reliable_checkpoint(by_size(shared.join(enough, "sid"), factor).select("token", "sid", "rung", "need", "core"))
        of_set = Window.partitionBy("sid", "rung")
        for _ in range(COUNTS):
            records = reliable_checkpoint(
                records.join(shared_by_two(records), "token", "left_semi")
                .withColumn("c", F.count("*").over(of_set)).filter("c >= need").drop("c"))
            release(spark)
        records = records.filter("core").select("token", "sid")
    others = (records.join(shared_by_two(records), "token").filter("sid <> pivot")
              .select("pivot", "sid").distinct())
    return others.unionByName(others.select("pivot", F.col("pivot").alias("sid")).distinct())


def blocks_of(members: DataFrame) -> DataFrame:
    """(pivot, sid): where the sets that hang together by candidates (pivot, sid) are
    at most ``SMALL``, all of them are one block, so each is moved once; larger ones
    keep the blocks of their pivots."""
    tree = reliable_checkpoint(components(members.select(F.col("pivot").alias("a"), F.col("sid").alias("b"))))
    release(members.sparkSession)
    sizes = tree.groupBy("root").agg(F.count("*").alias("held"))
    sized = tree.join(sizes, "root")
    small = sized.filter(F.col("held") <= SMALL).select(F.col("root").alias("pivot"), F.col("node").alias("sid"))
    rest = sized.filter(F.col("held") > SMALL).select(F.col("node").alias("sid"))
    return small.unionByName(members.join(rest, "sid", "left_semi").select("pivot", "sid"))


def worth_joining(members: DataFrame, sizes: DataFrame, factor: int) -> DataFrame:
    """(pivot, sid, m): the members (pivot, sid) that can have a link in their block
    by its sets' sizes (sid, n) alone, and the block's size. Blocks beyond ``SMALL``
    are left whole, as their members are not to meet in one task."""
    counted = members.join(members.groupBy("pivot").agg(F.count("*").alias("m")), "pivot")
    small = counted.filter(F.col("m") <= SMALL).join(sizes, "sid")
    w = Window.partitionBy("pivot").orderBy("n", "sid")
    before, after = F.lag("n").over(w), F.lead("n").over(w)
    near = (factor * (F.col("n") - before) <= F.col("n") + before) | (factor * (after - F.col("n")) <= F.col("n") + after)
    return (small.withColumn("near", near).filter("near").select("pivot", "sid", "m")
            .unionByName(counted.filter(F.col("m") > SMALL).select("pivot", "sid", "m")))


def links_of(members: DataFrame, sets: DataFrame, factor: int, parts: int) -> DataFrame:
    """All links (a, b) between keys, as forests: ``members`` (pivot, sid, m) and
    ``sets`` (sid, key, n, codes, large: 1 if in a large block), both stored, the
    sets in folders by ``large``."""
    small = (members.filter(F.col("m") <= SMALL).join(sets, "sid")
             .select(F.col("pivot").alias("grp"), F.lit(WITHIN).alias("side"), "key", "n", "codes"))
    large = members.filter(F.col("m") > SMALL).select("pivot", "sid")
    links = _group_links(small, parts, factor)
    if large.isEmpty():
        return links
    return links.unionByName(_large_links(large, sets.filter("large = 1"), factor, parts))


def _centres(own: DataFrame) -> DataFrame:
    """(pivot, centre): of each block, the codes that at least half of its sets
    have, so at most twice as many as a set has on average."""
    def explode(batches):
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                codes = [np.frombuffer(x, "<i8") for x in part.column(1).to_pylist()]
                pivots = np.repeat(part.column(0).to_numpy(zero_copy_only=False), [len(c) for c in codes])
                yield pa.RecordBatch.from_arrays([pa.array(pivots, pa.int64()), pa.array(np.concatenate(codes))],
                                                 ["pivot", "code"])

    counts = (own.select("pivot", "codes").mapInArrow(explode, "pivot long, code long")
              .groupBy("pivot", "code").agg(F.count("*").alias("c")))
    sizes = own.groupBy("pivot").agg(F.count("*").alias("m"))
    return (sizes.join(counts, "pivot", "left").filter("c IS NULL OR 2 * c >= m").groupBy("pivot")
            .agg(F.collect_list("code").alias("centre")))


def _differences(rows: DataFrame) -> DataFrame:
    """Rows (pivot, key, n, codes, centre) to (pivot, key, n, d, diff)."""
    def run(batches):
        for part in (part for batch in batches for part in slices(batch, 3, SLICE_BYTES)):
            pivots, keys, sizes, codes, centres = part.columns
            diffs, held, centre = [], None, None
            for raw, c in zip(codes.to_pylist(), centres):
                if centre is None or c != held:
                    held, centre = c, np.array(c.as_py() or [], np.int64).view(np.uint64)
                diffs.append(np.setxor1d(np.frombuffer(raw, "<u8"), centre, assume_unique=True))
            yield pa.RecordBatch.from_arrays(
                [pivots, keys, sizes, pa.array([len(x) for x in diffs], pa.int32()),
                 pa.array([x.astype("<u8").tobytes() for x in diffs], pa.binary())],
                ["pivot", "key", "n", "d", "diff"])

    return rows.select("pivot", "key", "n", "codes", "centre").mapInArrow(
        run, "pivot long, key binary, n int, d int, diff binary")


def _large_links(members: DataFrame, sets: DataFrame, factor: int, parts: int) -> DataFrame:
    own = members.join(sets, "sid").select("pivot", "key", "n", "codes")
    diffs = reliable_checkpoint(_differences(own.join(_centres(own), "pivot")).withColumn(
        "g", F.lit(factor).cast("long") * F.col("d") - F.col("n")))
    hub = diffs.groupBy("pivot").agg(F.min_by(F.struct("g", "key"), F.struct("g", "key")).alias("hub"))
    placed = diffs.join(hub, "pivot").select(
        "pivot", "key", "n", "d", "diff", F.col("hub.key").alias("hub_key"),
        (F.col("g") + F.col("hub.g") > 0).alias("is_outer"),
        # the overlap that any link of an outer set needs: by the sizes, and by the least g
        F.greatest(F.lit(1), F.ceil((F.col("g") - F.ceil(F.col("n") * (factor + 1) / (factor - 1))) / factor),
                   F.when(F.col("g") + F.col("hub.g") > 0, F.ceil((F.col("g") + F.col("hub.g")) / (2 * factor)))
                   .otherwise(F.ceil((F.col("g") - F.col("hub.g")) / (2 * factor)))).alias("least"))
    second = reliable_checkpoint(placed.withColumn("prefix", F.col("d") - F.col("least").cast("int") + 1))
    to_hub = second.filter("NOT is_outer AND key <> hub_key").select(F.col("key").alias("a"), F.col("hub_key").alias("b"))

    def tokens(batches):
        for batch in batches:
            out = []
            for pivot, key, diff, prefix, outer in zip(*(c.to_pylist() for c in batch.columns)):
                salt = pivot.to_bytes(8, "little", signed=True)
                out += [(xxhash.xxh3_64_intdigest(salt + diff[8 * i:8 * i + 8]) - (1 << 63), pivot, key, outer)
                        for i in range(prefix)]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
            names = ["grp", "pivot", "key", "is_outer"]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    records = reliable_checkpoint(second.filter("d > 0 AND prefix > 0").select("pivot", "key", "diff", "prefix", "is_outer")
                                  .mapInArrow(tokens, "grp long, pivot long, key binary, is_outer boolean"))
    shared = (records.groupBy("grp").agg(F.count("*").alias("m"), F.max("is_outer").alias("any_outer"))
              .filter("m > 1 AND any_outer").select("grp", F.ceil(F.col("m") / CHUNK).cast("int").alias("chunks")))
    # Rows of a large group are dealt to chunks; each pair of chunks is a unit of work.
    units = (records.join(shared, "grp")
             .withColumn("own", F.pmod(F.xxhash64("key"), "chunks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select(F.xxhash64("grp", F.least("own", "other"), F.greatest("own", "other")).alias("grp"),
                     F.when(F.col("own") == F.col("other"), WITHIN).when(F.col("own") > F.col("other"), 1)
                     .otherwise(0).alias("side"), "pivot", "key"))
    rows = units.join(second.select("pivot", "key", "n", F.col("diff").alias("codes")), ["pivot", "key"])
    return to_hub.unionByName(_group_links(rows, parts, factor))


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component, for all nodes of
    the links (a, b), by alternating large-star and small-star rounds."""
    edges = reliable_checkpoint(links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = reliable_checkpoint(large.distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = reliable_checkpoint(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        seen = now

"""Sharding: minimax contiguous partition of ordered atomic groups.

Rows with equal texts form an atomic group. Groups are ordered by the SHA-256
of their text, which needs no join: a row's place follows from its own text.
The smallest feasible shard capacity is found by binary search over the
inclusive prefix sums of the group sizes, each capacity being checked greedily
("take the longest run of groups that still fits"). The shards are then cut
under that capacity, each cut at the prefix sum nearest to an even share of
what is left, so that no shard exceeds the minimax capacity and the others
come out near equal.

Prefix sums stay distributed. The search sees them only through a summary
``bucket -> (least, largest, count)`` of at most ``MAX_BUCKETS`` rows. A greedy
step that falls inside a bucket gives a lower and an upper bound; buckets on
which the answer depends are split further by another aggregation, until the
capacity and all cuts are exact. A table of 10^14 bytes takes about four such
passes over the narrow prefix table.

Defined results: a null text is an empty text (size 1, CRC 0) and shares the
group of the empty texts; repeated rows are rows of one group; an empty table
gives no rows; shards may stay empty when one group exceeds an even share.
Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import reliable_checkpoint, text_or_empty

#: Bound on the rows of a prefix-sum summary on the driver.
MAX_BUCKETS = 1 << 16
#: Groups (or rows of a shard) that one window partition is meant to hold.
RUN = 100_000


class PrefixSummary:
    """Bounds on a sorted set of prefix sums, known bucket by bucket."""

    def __init__(self, total: int):
        self.total = total
        self.lo, self.hi, self.n = ([1], [total], [3]) if total else ([], [], [])
        self.asked: set[int] = set()

    def floor(self, y: int) -> tuple[int, int]:
        """Bounds on the largest prefix sum <= y (0 if there is none)."""
        i = bisect_right(self.lo, y) - 1
        if i < 0:
            return 0, 0
        if y >= self.hi[i]:
            return self.hi[i], self.hi[i]
        if self.n[i] <= 2:
            return self.lo[i], self.lo[i]
        self.asked.add(i)
        return self.lo[i], min(self.hi[i] - 1, y)

    def ceil(self, y: int) -> tuple[int, int]:
        """Bounds on the smallest prefix sum >= y."""
        if y <= 0:
            return 0, 0
        i = bisect_left(self.hi, y)
        if i == len(self.hi):
            return self.total, self.total
        if y <= self.lo[i]:
            return self.lo[i], self.lo[i]
        if self.n[i] <= 2:
            return self.hi[i], self.hi[i]
        self.asked.add(i)
        return max(self.lo[i], y), self.hi[i]

    def split(self, measure) -> None:
        """Replace the buckets that were asked about by finer ones."""
        picked = sorted(self.asked)
        spans = [(self.lo[i], self.hi[i]) for i in picked]
        width = max(1, -(-sum(b - a + 1 for a, b in spans) // MAX_BUCKETS))
        merged: list[list[int]] = []
        for a, b in spans:
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = b
            else:
                merged.append([a, b])
        keep = [(a, b, n) for i, (a, b, n) in enumerate(zip(self.lo, self.hi, self.n))
                if i not in self.asked]
        rows = sorted(keep + [tuple(r) for r in measure(merged, width)])
        self.lo, self.hi, self.n = map(list, zip(*rows))
        self.asked = set()


def _greedy(s: PrefixSummary, capacity: int, shards: int, side: int) -> int:
    x = 0
    for _ in range(shards):
        x = s.floor(x + capacity)[side]
    return x


def minimax_cuts(s: PrefixSummary, shards: int, measure) -> tuple[int, list[int]]:
    """The least capacity and the prefix sums at which shards end."""
    if not s.total:
        return 0, [0] * shards
    s.asked.add(0)
    s.split(measure)
    while True:  # the capacity
        s.asked.clear()
        bounds = []
        for side in (1, 0):  # least capacity that may do, least that surely does
            bad, good = -(-s.total // shards) - 1, s.total
            while good - bad > 1:
                mid = (bad + good) // 2
                good, bad = (mid, bad) if _greedy(s, mid, shards, side) >= s.total else (good, mid)
            bounds.append(good)
        if bounds[0] == bounds[1]:
            capacity = bounds[0]
            break
        s.asked.clear()
        for c in bounds:
            x = [0, 0]
            for _ in range(shards):
                x = [s.floor(x[0] + c)[0], s.floor(x[1] + c)[1]]
        lows = [0]
        highs = [0]
        for _ in range(shards):  # every bucket between the two chains matters
            lows.append(s.floor(lows[-1] + bounds[0])[0])
            highs.append(s.floor(highs[-1] + bounds[1])[1])
        for a, b in zip(lows, highs):
            first = max(0, bisect_right(s.lo, a) - 1)
            s.asked.update(i for i in range(first, bisect_right(s.lo, b)) if s.n[i] > 2)
        s.split(measure)
    while True:  # the cuts
        s.asked.clear()
        least = [s.total]  # from the right: where a shard must end at least
        for _ in range(shards - 1):
            least.append(s.ceil(least[-1] - capacity)[0])
        least.reverse()
        cuts = [0]
        for k in range(shards):
            x, left = cuts[-1], shards - k
            want = x + (s.total - x) // left
            below, above = s.floor(want), s.ceil(want)
            near = below[0] if want - below[0] <= above[0] - want else above[0]
            cuts.append(max(least[k], min(near, s.floor(x + capacity)[0])))
        if not s.asked:
            return capacity, cuts[1:]
        s.split(measure)


def prefix_table(groups: DataFrame, key: str, size: str, runs: int) -> DataFrame:
    """(key, p): inclusive sums of ``size`` by ``key`` (hex of a uniform hash).
    The key's leading digits deal groups into ``runs`` even, ordered runs; each
    run is summed on its own and shifted by the totals of the runs before."""
    run = F.floor(F.conv(F.substring(key, 1, 4), 16, 10).cast("long") * F.lit(runs) / 65536)
    g = groups.select(key, size, run.cast("int").alias("run"))
    totals = g.groupBy("run").agg(F.sum(size).alias("t"))  # <= runs <= MAX_BUCKETS rows
    before = totals.select("run", F.coalesce(F.sum("t").over(
        Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    w = Window.partitionBy("run").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return (g.withColumn("s", F.sum(size).over(w)).join(F.broadcast(before), "run")
            .select(key, (F.col("s") + F.col("b")).alias("p")))


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, text_key, shard, slot): see the module."""
    text = text_or_empty(text_col)
    rows = reliable_checkpoint(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("text_key")))
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    runs = max(1, min(MAX_BUCKETS, -(-n // RUN)))
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("size"))
    prefix = reliable_checkpoint(prefix_table(groups, "text_key", "size", runs))

    def measure(spans, width):
        inside, span = F.lit(False), F.lit(0)
        for a, b in spans:
            inside = inside | F.col("p").between(a, b)
            span = span + (F.col("p") >= a).cast("int")
        got = (prefix.filter(inside).groupBy(span.alias("span"), F.floor(F.col("p") / width).alias("bucket"))
               .agg(F.min("p"), F.max("p"), F.count("*")).collect())
        return [(r[2], r[3], r[4]) for r in got]

    _, cuts = minimax_cuts(PrefixSummary(int(total)), shards, measure)
    inner = [c for c in cuts[:-1] if c > 0]  # a shard before the first group is empty
    ends = {r["p"]: r["text_key"] for r in prefix.filter(F.col("p").isin(inner or [0])).collect()}
    shard = F.lit(sum(c <= 0 for c in cuts[:-1]))
    for c in inner:
        shard = shard + (F.col("text_key") > F.lit(ends[c])).cast("int")
    placed = rows.withColumn("shard", shard.cast("int"))

    # Slots: each shard is dealt into even bins by a hash of the row; a bin numbers its own rows.
    bins = max(1, min(MAX_BUCKETS // shards, -(-n // (shards * RUN))))
    placed = placed.withColumn("bin", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(bins)))
    counts = placed.groupBy("shard", "bin").agg(F.count("*").alias("c"))  # <= shards * bins rows
    first = counts.select("shard", "bin", F.coalesce(F.sum("c").over(
        Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("first"))
    w = Window.partitionBy("shard", "bin").orderBy("doc_id", "text_key")
    return (placed.withColumn("r", F.row_number().over(w)).join(F.broadcast(first), ["shard", "bin"])
            .select("doc_id", "size", "text_crc32", "text_key", "shard",
                    (F.col("first") + F.col("r") - 1).cast("long").alias("slot")))


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    from .common import read_table

    out = shard_documents(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))

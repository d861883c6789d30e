"""SMOTE oversampling with exact k-nearest neighbours, distributed.

Neighbour search without pairing every minority row with every other:

1. some rows are centroids, each row belongs to its nearest one (a block), and blocks are
   cut into shells by the distance from the centroid. Shells that hold many rows, as of
   repeated points, are cut further by a hash, so that a group has a bounded size;
2. the k nearest rows of a row's own group, and the k nearest centroids, which are rows
   too, give a first radius;
3. a row asks another group only if its radius reaches into it. Two lower bounds tell: by
   the triangle inequality a row of a shell is no nearer than the difference of the
   distances from the shell's centroid, and a row of another block lies beyond the plane
   halfway between the two centroids;
4. asked groups answer with their own nearest rows, for bounded numbers of questions at
   a time, and the k smallest candidates per row are its exact neighbours.

Generation follows SMOTE: x_new = x + u * (x_nn - x) with u in [0, 1) and
x_nn one of the k neighbours. Each minority row makes floor(n_new / m)
samples and the r rows with the smallest hash one more, so the class counts
come out equal exactly. All randomness is hash-derived (reproducible). The minority is
the class with fewer rows, as in the library whose default this follows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.selection import smallest_k, smallest_k_condition, stratum_sizes
from ..session import reliable_checkpoint

_MASK53 = (1 << 53) - 1
#: Centroids at most (their vectors reach the driver), shells of a block, and questions
#: that a group answers in one task.
MAX_CENTROIDS, SHELLS, QUESTIONS = 2048, 8, 8192
#: Slack of the bounds against rounding, relative to the distances they come from.
SLACK = 1e-9


def _nearest(q: np.ndarray, qid: np.ndarray, x: np.ndarray, xid: np.ndarray, k: int, chunk: int = 128):
    """For each row of ``q``, places in ``x`` and distances of its k nearest other rows,
    equal distances by id; -1 where there are fewer. Exact differences, in chunks to
    bound memory."""
    place = np.full((len(q), k), -1, np.int64)
    dist = np.full((len(q), k), np.inf)
    for s in range(0, len(q), chunk):
        d2 = ((q[s:s + chunk, None, :] - x[None, :, :]) ** 2).sum(axis=2)
        d2[qid[s:s + chunk, None] == xid[None, :]] = np.inf
        last = min(k, x.shape[0]) - 1
        limit = np.partition(d2, last, axis=1)[:, last] if last >= 0 else np.zeros(len(d2))
        for i in range(len(d2)):
            near = np.flatnonzero((d2[i] <= limit[i]) & np.isfinite(d2[i]))
            near = near[np.lexsort((xid[near], d2[i][near]))][:k]
            place[s + i, :len(near)] = near
            dist[s + i, :len(near)] = np.sqrt(d2[i][near])
    return place, dist


def _distances(x: np.ndarray, centres: np.ndarray, chunk: int = 1024) -> np.ndarray:
    return np.concatenate([np.sqrt(((x[s:s + chunk, None, :] - centres[None, :, :]) ** 2).sum(axis=2))
                           for s in range(0, len(x), chunk)]) if len(x) else np.zeros((0, len(centres)))


def _reached(d: np.ndarray, own: np.ndarray, radius: np.ndarray, between: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """(rows, groups): whether a row's radius reaches into a group (block, lo, hi), from the
    row's distances ``d`` to the centroids and its own block."""
    block, lo, hi = groups[:, 0].astype(np.int64), groups[:, 1], groups[:, 2]
    there = d[:, block]
    ring = np.maximum(lo[None, :] - there, there - hi[None, :])
    here = d[np.arange(len(d)), own][:, None]
    apart = between[own][:, block]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(apart > 0, (there ** 2 - here ** 2) / (2 * apart), 0.0)
    return np.maximum(ring, plane) <= radius[:, None] + SLACK * (there + here + 1)


def _ask(points: DataFrame, features: list[str], key: str, k: int, seed: int,
         block_rows: int) -> tuple[DataFrame, DataFrame, int] | None:
    """Steps 1 to 3: candidates from a row's own group and questions to others (stored),
    the groups' members, and how many groups there are; None for an empty table."""
    spark = points.sparkSession
    d = len(features)
    rows = points.select(F.col(key).cast("long").alias("_id"), F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    m = points.count()
    c = min(MAX_CENTROIDS, max(1, math.ceil(m / block_rows)))
    chosen = smallest_k(rows.select("_id", "x").withColumnRenamed("_id", key), {None: c}, key, seed)
    centres = np.array([r["x"] for r in chosen.orderBy(key).collect()], float).reshape(-1, d)
    if not len(centres):
        return None
    between = _distances(centres, centres)

    def assign(batches):
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy()).reshape(len(pdf), d) if len(pdf) else np.zeros((0, d))
            far = _distances(x, centres)
            block = far.argmin(axis=1) if len(far) else np.zeros(0, np.int64)
            yield pdf.assign(block=block.astype(np.int32), away=far[np.arange(len(far)), block])

    placed = reliable_checkpoint(rows.mapInPandas(assign, "_id long, x array<double>, block int, away double"))
    spans = placed.groupBy("block").agg(F.max("away").alias("reach"))  # a row per centroid
    shell = F.least(F.floor(F.col("away") / F.when(F.col("reach") > 0, F.col("reach")) * SHELLS), F.lit(SHELLS - 1))
    shelled = placed.join(F.broadcast(spans), "block").withColumn("shell", F.coalesce(shell, F.lit(0)).cast("int"))
    held = shelled.groupBy("block", "shell").agg(
        F.min("away").alias("lo"), F.max("away").alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("block", "shell").collect()
    parts = {(r["block"], r["shell"]): math.ceil(r["n"] / (2 * block_rows)) for r in held}
    groups = np.array([(r["block"], r["lo"], r["hi"]) for r in held for _ in range(parts[r["block"], r["shell"]])])
    first = np.cumsum([0] + [parts[r["block"], r["shell"]] for r in held])
    numbers = spark.createDataFrame(
        [(r["block"], r["shell"], int(f), parts[r["block"], r["shell"]]) for r, f in zip(held, first)],
        "block int, shell int, first int, parts int")
    member = shelled.join(F.broadcast(numbers), ["block", "shell"]).select(
        (F.col("first") + F.pmod(F.xxhash64("_id"), F.col("parts"))).cast("int").alias("grp"), "_id", "x", "block")

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids = np.stack(pdf["x"].to_numpy()).reshape(len(pdf), d), pdf["_id"].to_numpy()
        place, dist = _nearest(x, ids, x, ids, k)
        far = _distances(x, centres)
        nearby = np.sort(far, axis=1)
        # a row that is a centroid has itself among the nearest
        bound = nearby[:, k] if len(centres) > k else np.full(len(x), np.inf)
        radius = np.minimum(dist[:, k - 1], bound)
        asked = _reached(far, pdf["block"].to_numpy(), radius, between, groups)
        asked[:, pdf["grp"].iloc[0]] = False
        i, j = np.nonzero(place >= 0)
        qi, g = np.nonzero(asked)
        return pd.DataFrame({
            "_id": np.concatenate((ids[i], ids[qi])), "nbr": pd.array([*ids[place[i, j]], *[None] * len(qi)], "Int64"),
            "dist": np.concatenate((dist[i, j], radius[qi])), "grp": np.concatenate((np.full(len(i), -1), g)).astype(np.int32),
            "x": [None] * len(i) + [x[a].tolist() for a in qi]})

    stage = reliable_checkpoint(member.groupBy("grp").applyInPandas(
        local, "_id long, nbr long, dist double, grp int, x array<double>"))
    return stage, member, len(groups)


def exact_knn(points: DataFrame, features: list[str], key: str, k: int = 5,
              seed: int = 42, block_rows: int = 1024) -> DataFrame:
    """(key, nbr, nrank, dist) for the k nearest other rows of each row."""
    d = len(features)
    steps = _ask(points, features, key, k, seed, block_rows)
    if steps is None:
        return points.select(F.col(key).cast("long").alias(key), F.lit(0).cast("long").alias("nbr"),
                             F.lit(0).alias("nrank"), F.lit(0.0).alias("dist"))
    stage, member, _ = steps
    found = stage.where("grp < 0").select("_id", "nbr", "dist")
    asked = stage.where("grp >= 0")
    loads = asked.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / QUESTIONS).cast("int").alias("turns"))
    asked = asked.join(F.broadcast(loads), "grp").withColumn("turn", F.pmod(F.xxhash64("_id"), F.col("turns")).cast("int")).drop("turns")
    answering = member.join(F.broadcast(loads), "grp").select(
        F.col("grp").alias("of"), "_id", "x", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("at"))

    def remote(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if q.empty or b.empty:
            return pd.DataFrame({"_id": [], "nbr": [], "dist": []})
        qx, qid = np.stack(q["x"].to_numpy()).reshape(len(q), d), q["_id"].to_numpy()
        bx, bid = np.stack(b["x"].to_numpy()).reshape(len(b), d), b["_id"].to_numpy()
        place, dist = _nearest(qx, qid, bx, bid, k)
        i, j = np.nonzero((place >= 0) & (dist <= q["dist"].to_numpy()[:, None] * (1 + SLACK)))
        return pd.DataFrame({"_id": qid[i], "nbr": bid[place[i, j]], "dist": dist[i, j]})

    answers = (asked.groupBy("grp", "turn").cogroup(answering.groupBy("of", "at"))
               .applyInPandas(remote, "_id long, nbr long, dist double"))
    w = Window.partitionBy("_id").orderBy("dist", "nbr")
    best = found.unionByName(answers).withColumn("nrank", F.row_number().over(w)).where(F.col("nrank") <= k)
    return best.select(F.col("_id").alias(key), "nbr", "nrank", "dist")


def _uniform(*cols) -> F.Column:
    """Hash-derived uniform draw in [0, 1)."""
    return (F.xxhash64(*cols).bitwiseAND(F.lit(_MASK53)).cast("double") / float(1 << 53))


def synthetic_rows(train: DataFrame, features: list[str], label: str = "label", key: str = "transaction_id",
                   k: int = 5, seed: int = 42, block_rows: int = 1024) -> DataFrame | None:
    """The rows to add: key (negative, of its own), features, label, and where a row comes
    from: src, nbr, _u. None if there is nothing to add."""
    sizes = stratum_sizes(train, label)
    if len(sizes) < 2:
        return None
    minority = min(sizes, key=sizes.get)
    m, n_new = sizes[minority], max(sizes.values()) - sizes[minority]
    if n_new == 0 or m < 2:
        return None
    mino = train.where(F.col(label) == minority).select(key, *features)
    kk = min(k, m - 1)
    neigh = exact_knn(mino, features, key, kk, seed, block_rows)
    q, r = divmod(n_new, m)
    hashed, extra = smallest_k_condition(mino, {None: r}, key, seed)
    alloc = hashed.select(key, *features,
                          (F.lit(q) + F.when(extra, 1).otherwise(0)).alias("_n")
                          ).where(F.col("_n") > 0)
    draws = alloc.select("*", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_s"))
    draws = draws.select(
        "*",
        (F.lit(1) + F.pmod(F.xxhash64(key, "_s", F.lit(seed)), F.lit(kk))).alias("nrank"),
        _uniform(key, "_s", F.lit(seed + 1)).alias("_u"))
    nbv = mino.select(F.col(key).alias("nbr"), *[F.col(f).alias(f"_n_{f}") for f in features])
    joined = draws.join(neigh.select(key, "nrank", "nbr"), [key, "nrank"]).join(nbv, "nbr")
    return joined.select(
        (-(F.col(key) * (q + 2) + F.col("_s"))).cast("long").alias(key),
        *[(F.col(f) + F.col("_u") * (F.col(f"_n_{f}") - F.col(f))).alias(f) for f in features],
        F.lit(minority).cast(train.schema[label].dataType).alias(label),
        F.col(key).alias("src"), "nbr", "_u")


def smote(train: DataFrame, features: list[str], label: str = "label",
          key: str = "transaction_id", k: int = 5, seed: int = 42,
          block_rows: int = 1024) -> DataFrame:
    """Return ``train`` plus synthetic minority rows (``synthetic`` = true,
    negative ids) so both classes have the same count; other columns are NULL in them."""
    out = train.withColumn("synthetic", F.lit(False))
    rows = synthetic_rows(train, features, label, key, k, seed, block_rows)
    if rows is None:
        return out
    own = {key, label, *features}
    return out.unionByName(rows.select(
        *[F.col(c) if c in own else F.lit(None).cast(train.schema[c].dataType).alias(c) for c in train.columns],
        F.lit(True).alias("synthetic")))

"""Embedding near-dedup: exact threshold pairs by cover-tree dual traversal.

Vectors of one label are compared on the unit sphere, where a cosine of at least
``c`` is a distance of at most ``sqrt(2 - 2c)``.  Equal vectors form one point
with a weight.  A cover tree has nested levels of centres with halving radii:
every point of a level lies within the level's radius of its parent.  A pair of
nodes is dropped when their centres are further apart than both covering radii
and the threshold; what reaches the leaves is decided by the cosine in double
precision.

The first level is made on Spark: centres are drawn by hash, every point goes to its
nearest centre of its label, and the pairs of cells that can hold a link are the
tasks.  A label of any size is thereby split; cells over ``CELL`` points are cut
into blocks, and pairs of blocks are dealt out.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from annolink.llm.common import by_value, stored
from annolink.llm.components import components

by_value(__name__)

COSINE = 0.98
#: About so many points to a cell; a label's centres are at most MAX_CENTRES
#: (they are sent to the workers: 8 bytes a component each).
CELL, MAX_CENTRES, LEAF = 2048, 512, 16
#: Slack for rounding in distances; cosines decide.
SLACK = 1e-6


# ---------------------------------------------------------------- cover tree

class CoverTree:
    """Nested levels over unit vectors ``x``.  ``levels[k]`` has the points that
    are centres, the parent of each in the level above, and each node's covering
    radius: its farthest descendant."""

    def __init__(self, x: np.ndarray):
        self.x = x
        n = len(x)
        order = np.arange(n)
        centres = [order[:1]]
        owner = np.zeros(n, int)  # nearest centre so far, as a place in the level
        dist = np.linalg.norm(x - x[0], axis=1)
        radius = max(float(dist.max()), 1e-12)
        owners = [owner.copy()]
        while len(centres[-1]) < n and radius > 1e-9:
            radius /= 2
            here, own = list(centres[-1]), owner.copy()
            far = np.flatnonzero(dist > radius)
            while len(far):  # the farthest first: centres stay apart by the radius
                new = far[np.argmax(dist[far])]
                d = np.linalg.norm(x[far] - x[new], axis=1)
                closer = d < dist[far]
                own[far[closer]] = len(here)
                dist[far[closer]] = d[closer]
                here.append(new)
                far = far[dist[far] > radius]
            centres.append(np.array(here))
            owner = own
            owners.append(own.copy())
            if len(here) * LEAF >= n:
                break
        # bottom-up: members of each lowest node, then covering radii of all
        self.members = _grouped(owners[-1], len(centres[-1]))
        self.kids, self.radius, self.centres = [], [], centres
        for k in range(len(centres)):
            own = self._through(owners, centres, k)
            r = np.zeros(len(centres[k]))
            np.maximum.at(r, own, np.linalg.norm(x - x[centres[k][own]], axis=1))
            self.radius.append(r)
        for k in range(len(centres) - 1):
            # a centre's parent is where its own lowest node hangs
            parent = self._through(owners, centres, k)[centres[k + 1]]
            self.kids.append(_grouped(parent, len(centres[k])))

    def _through(self, owners, centres, k):
        """Node of level ``k`` above each point, by way of the levels between."""
        at = owners[-1]
        for j in range(len(centres) - 1, k, -1):
            at = owners[j - 1][centres[j]][at]
        return at


def _grouped(owner: np.ndarray, n: int) -> list[np.ndarray]:
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.cumsum(np.bincount(owner, minlength=n))[:-1])


def dual_traversal(a: CoverTree, b: CoverTree, reach: float):
    """Yields ``(points of a, points of b)`` arrays of pairs that may be within
    ``reach``; each unordered pair once if both are the same tree."""
    same = a is b
    # a node of a's level against several of b's; with `own` also against itself
    stack = [(0, 0, 0, np.empty(0, int) if same else np.zeros(1, int), same)]
    while stack:
        la, i, lb, js, own = stack.pop()
        if len(js):
            gap = _distances(b.x[b.centres[lb][js]], a.x[a.centres[la][i]])
            js = js[gap <= a.radius[la][i] + b.radius[lb][js] + reach]
        if not len(js) and not own:
            continue
        end_a, end_b = la == len(a.kids), lb == len(b.kids)
        if end_a and end_b:
            mine = a.members[i]
            others = np.concatenate([b.members[j] for j in js]) if len(js) else np.empty(0, int)
            for k, u in enumerate(mine):
                near = np.concatenate([others, mine[k + 1:]]) if own else others
                near = near[_distances(b.x[near], a.x[u]) <= reach]
                if len(near):
                    yield np.full(len(near), u), near
            continue
        kids_a = [i] if end_a else a.kids[la][i]
        kids_b = js if end_b else np.concatenate([b.kids[lb][j] for j in js]) if len(js) else js
        down_a, down_b = la + (not end_a), lb + (not end_b)
        for k, x in enumerate(kids_a):
            stack.append((down_a, int(x), down_b, np.concatenate([kids_b, kids_a[k + 1:]]) if own else kids_b, own))


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Distances on the unit sphere, from inner products."""
    return np.sqrt(np.maximum(2 - 2 * (points @ to), 0))


def linked(x: np.ndarray, raw_x: np.ndarray, weight_x: np.ndarray, y, raw_y, weight_y, cosine: float):
    """Weights of the points linked with each point, and a component label of
    each, over ``x`` followed by ``y`` (None: links within ``x`` only)."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + SLACK
    a = CoverTree(x)
    b = a if y is None else CoverTree(y)
    raw = raw_x if y is None else np.concatenate([raw_x, raw_y])
    weight = weight_x if y is None else np.concatenate([weight_x, weight_y])
    norm = np.linalg.norm(raw, axis=1)
    shift = 0 if y is None else len(x)
    total, label = np.zeros(len(raw), np.int64), np.arange(len(raw))
    for u, v in dual_traversal(a, b, reach):
        i, v = u[0], v + shift
        v = v[(raw[v] @ raw[i]) / (norm[v] * norm[i]) >= cosine]
        if len(v):
            total[i] += weight[v].sum()
            total[v] += weight[i]
            found = np.unique(np.append(label[v], label[i]))
            if len(found) > 1:
                label[np.isin(label, found)] = found[0]
    return total, label


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; first by the largest component, so that no square overflows."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


# --------------------------------------------------------------------- Spark

def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _cells(sent):
    """Rows ``pid, part, weight, v`` -> ``pid, part, weight, cell, gap, v``: nearest centre of the part
    (label and dimension) and the distance to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.array(batch.column(1).to_pylist(), dtype=object)
            cell, gap = np.zeros(len(part), np.int64), np.zeros(len(part))
            for p in set(part.tolist()):
                at = np.flatnonzero(part == p)
                x = unit(_matrix(batch.column(3).take(pa.array(at))))
                centres = sent.value.get(p)
                if centres is None or not len(centres):
                    gap[at] = 2.0
                    continue
                for k in range(0, len(at), 4096):
                    some = at[k:k + 4096]
                    cos = x[k:k + 4096] @ centres.T
                    best = cos.argmax(axis=1)
                    cell[some] = best
                    gap[some] = np.linalg.norm(x[k:k + 4096] - centres[best], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(cell), pa.array(gap), batch.column(3)],
                names=["pid", "part", "weight", "cell", "gap", "v"])
    return run


def _traverse(cosine: float):
    """One task: a unit of points against another, or within itself."""
    def run(key, table):
        table = table.combine_chunks()
        pid, weight = table.column("pid").to_numpy(), table.column("weight").to_numpy()
        raw = _matrix(table.column("v").chunk(0))
        raw = raw / np.abs(raw).max(axis=1, keepdims=True)
        lo, hi = key[1].as_py(), key[2].as_py()
        order = np.argsort(pid)
        if lo != hi:
            side = table.column("unit").to_numpy() == lo
            p, q = order[side[order]], order[~side[order]]
            if not len(p) or not len(q):
                order = order[:0]
                total = label = order
            else:
                order = np.concatenate([p, q])
                total, label = linked(unit(raw[p]), raw[p], weight[p], unit(raw[q]), raw[q], weight[q], cosine)
        else:
            total, label = linked(unit(raw[order]), raw[order], weight[order], None, None, None, cosine)
        some = total > 0
        return pa.table({"pid": pa.array(pid[order][some], pa.int64()), "links": pa.array(total[some], pa.int64()),
                         "root": pa.array(pid[order][label][some], pa.int64())})
    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """``vectors(vec_id, embedding, label)`` -> per vector ``vec_id, n_links,
    component_id, kept``.

    Only vectors of the same non-null label and the same dimension are compared.
    Null, empty or zero vectors and those with a null or non-finite component
    link with nothing.  Repeated rows (even of one vec_id) count as vectors of
    their own.  No rows, no result.  Other columns are ignored.
    """
    base = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"), F.col("label").cast("string"))
    good = (F.col("label").isNotNull() & F.exists("v", lambda c: c != 0)
            & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    # -0.0 and 0.0 are one value, so equal vectors have equal hashes
    clean = F.transform("v", lambda c: c + F.lit(0.0))
    rows = stored(base.select("vec_id", F.when(good, F.concat_ws(":", F.size("v").cast("string"), "label")).alias("part"), clean.alias("v"))
                  .withColumn("print", F.when(F.col("part").isNotNull(), F.sha2(F.concat_ws(",", F.transform("v", lambda c: c.cast("string"))), 256))), "vectors")
    points = stored(rows.where("part is not null").groupBy("part", "print")
                    .agg(F.min(F.struct("vec_id", "v")).alias("one"), F.count("*").alias("weight"))
                    .select("part", "print", F.col("one.vec_id").alias("first"), F.col("one.v").alias("v"), "weight")
                    .withColumn("pid", F.monotonically_increasing_id()), "points")

    # centres: by hash, about one for each `cell` points, about MAX_CENTRES at most in all
    sizes = points.groupBy("part").agg(F.count("*").alias("n"))
    wide = max(cell, -(-points.count() // MAX_CENTRES))
    draw = F.pmod(F.xxhash64(F.lit(3), "print"), F.lit(1 << 30)) / float(1 << 30)
    chosen = (points.join(sizes, "part").where((F.col("n") > wide) & (draw * wide < 1))
              .select("part", "v").limit(2 * MAX_CENTRES).collect())
    drawn: dict[str, list] = {}
    for r in chosen:
        drawn.setdefault(r[0], []).append(r[1])
    centres = {p: unit(np.array(v, float)) for p, v in drawn.items()}
    sent = points.sparkSession.sparkContext.broadcast(centres)
    placed = stored(points.select("pid", "part", "weight", "v").mapInArrow(
        _cells(sent), "pid long, part string, weight long, cell long, gap double, v array<double>"), "cells")

    # cells with their covering radius; those of a part whose spheres are in reach are paired
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + SLACK
    blocks = F.ceil(F.col("n") / (2 * cell))
    cells = stored(placed.groupBy("part", "cell").agg(F.max("gap").alias("radius"), F.count("*").alias("n"))
                   .withColumn("blocks", blocks), "cell-sizes")
    split = cells.where(F.col("part").isin(list(centres))) if centres else cells.limit(0)  # some MAX_CENTRES cells
    near = []
    by_part: dict[str, list] = {}
    for r in split.collect():
        by_part.setdefault(r["part"], []).append((r["cell"], r["radius"]))
    for part, of in by_part.items():
        ids, radius = np.array([c for c, _ in of]), np.array([g for _, g in of])
        at = centres[part][ids]
        for k in range(len(ids)):
            gap = np.linalg.norm(at[k:] - at[k], axis=1)
            near += [(part, int(ids[k]), int(ids[k + m])) for m in np.flatnonzero(gap <= radius[k] + radius[k:] + reach)]
    spark = points.sparkSession
    pairs = spark.createDataFrame(near, "part string, c1 long, c2 long")
    alone = cells.where(~F.col("part").isin(list(centres))) if centres else cells
    pairs = pairs.union(alone.select("part", "cell", "cell"))
    k1, k2 = cells.select("part", F.col("cell").alias("c1"), F.col("blocks").alias("k1")), \
        cells.select("part", F.col("cell").alias("c2"), F.col("blocks").alias("k2"))
    name = lambda c, k: F.col(c) * (1 << 32) + F.col(k)
    tasks = (pairs.join(k1, ["part", "c1"]).join(k2, ["part", "c2"])
             .withColumn("b1", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k1") - 1)))
             .withColumn("b2", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k2") - 1)))
             .where("c1 <> c2 or b1 <= b2")
             .select("part", F.least(name("c1", "b1"), name("c2", "b2")).alias("lo"), F.greatest(name("c1", "b1"), name("c2", "b2")).alias("hi")))
    tasks = stored(tasks, "tasks")
    members = placed.join(cells.select("part", "cell", "blocks"), ["part", "cell"]).select(
        "part", "pid", "weight", "v", (F.col("cell") * (1 << 32) + F.pmod(F.xxhash64(F.lit(5), "pid"), F.col("blocks"))).alias("unit"))
    ends = tasks.select("part", "lo", "hi", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("unit"))
    found = stored(members.join(ends, ["part", "unit"]).select("part", "lo", "hi", "unit", "pid", "weight", "v")
                   .groupBy("part", "lo", "hi").applyInArrow(_traverse(cosine), "pid long, links long, root long"), "found")

    parts = components(found.select(F.col("pid").alias("a"), F.col("root").alias("b")))
    per_point = found.groupBy("pid").agg(F.sum("links").alias("links"))
    whole = points.select("part", "print", "pid", "first", "weight").join(per_point, "pid", "left") \
        .join(parts.withColumnRenamed("node", "pid"), "pid", "left")
    smallest = whole.where("component is not null").groupBy("component").agg(F.min("first").alias("component_first"))
    whole = whole.join(smallest, "component", "left").select(
        "part", "print", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component_first", "first").alias("component_id"))
    out = rows.select("vec_id", "part", "print").join(whole, ["part", "print"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))

"""Near-duplicate vectors by a robust-pruned flat graph on overlapping shards.

Equal vectors are one class. Classes are dealt to the shards of their nearest
cluster centres, two each, and a shard that is too large is split by centres of
its own. In every shard each vector gets a robust-pruned list of neighbours;
the lists of all shards are united. Each vector is then searched for: a greedy
beam from the shard's medoids, then an expansion through everything within reach
of the linking cosine. What is found is verified in double precision.

A vector with links to a tenth of a full shard is dense: its group may be
larger than a shard. Links between two dense vectors are counted exactly, apart
from the graph: dense vectors form cells by home shard, cells provably beyond
the cosine by centre and radius are left out, cells provably within it are
counted by their sizes, and all others are compared cell by cell.

The centres are fitted on the `sample` classes with the smallest hashes (of an
over-large shard: on a like sample of its own), which only decides how vectors
are dealt; every vector is in the graph and is searched for. Links of vectors
with one home shard are counted there and reach the result as a spanning set;
only links between homes are made as pairs.

Null vectors, zero vectors and vectors with null or non-finite components link
with nothing; vectors of different lengths do not link. Null ids and repeated
rows are vectors of their own. No vectors give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, sequence_hash, ship, stored
from .links import components

#: Neighbours kept, candidates looked at, pruning slack, beam width and reach below the linking cosine.
DEGREE, POOL, SLACK, BEAM, REACH = 24, 64, 1.2, 32, 0.1
#: Most splits of an over-large shard.
SPLITS = 6
#: Dense are vectors with links to one in so many rows of a full shard; most vectors of a cell of dense ones.
DENSE, CELL = 10, 2000


def centres(vectors: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means, started from evenly spaced rows."""
    now = vectors[np.linspace(0, len(vectors) - 1, min(count, len(vectors))).astype(int)].copy()
    for _ in range(rounds):
        near = (vectors @ now.T).argmax(1)
        for c in range(len(now)):
            own = vectors[near == c]
            if len(own):
                total = own.sum(0)
                norm = np.linalg.norm(total)
                now[c] = total / norm if norm else now[c]
    return now


def pruned(vectors: np.ndarray) -> np.ndarray:
    """Neighbour lists of every vector of a shard, robust-pruned; -1 fills them."""
    n = len(vectors)
    pool = min(POOL, n - 1)
    found = np.full((n, DEGREE), -1, np.int64)
    if not pool:
        return found
    spread = np.random.default_rng(7).integers(0, n, (n, 4))  # far neighbours keep the graph navigable
    for start in range(0, n, 256):
        rows = np.arange(start, min(start + 256, n))
        likeness = vectors[rows] @ vectors.T
        likeness[np.arange(len(rows)), rows] = -2
        near = np.argpartition(-likeness, pool - 1, axis=1)[:, :pool]
        picked = np.concatenate([near, spread[rows]], 1)
        to_row = np.maximum(1 - np.take_along_axis(likeness, picked, 1), 0)
        order = np.argsort(to_row, axis=1, kind="stable")
        picked, to_row = np.take_along_axis(picked, order, 1), np.take_along_axis(to_row, order, 1)
        own = vectors[picked]
        between = np.maximum(1 - own @ own.transpose(0, 2, 1), 0)
        alive = picked != rows[:, None]
        for k in range(DEGREE):
            best = alive.argmax(1)
            some = alive[np.arange(len(rows)), best]
            if not some.any():
                break
            at = np.flatnonzero(some)
            found[rows[at], k] = picked[at, best[at]]
            alive[at] &= SLACK * between[at, best[at]] > to_row[at]
            alive[at, best[at]] = False
            alive[at] &= picked[at] != picked[at, best[at]][:, None]
    return found


def medoids(vectors: np.ndarray, count: int = 16) -> np.ndarray:
    """The vectors nearest to the centres of a shard's parts."""
    return np.unique((centres(vectors, count) @ vectors.T).argmax(1))


def searched(
    vectors: np.ndarray, u: np.ndarray, v: np.ndarray, queries: np.ndarray, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, found) with at least the cosine, from the medoids by a greedy beam and range expansion.

    The graph has the edges u to v and back: a vector that is on no list is found too.
    """
    n, count = len(vectors), len(queries)
    edges = np.unique(np.concatenate([u * n + v, v * n + u]))
    heads, tails = edges // n, edges % n
    sizes = np.bincount(heads, minlength=n)
    begins = np.cumsum(sizes) - sizes
    place = np.arange(len(edges)) - np.repeat(begins, sizes)
    lists = np.full((n, 2 * DEGREE), -1, np.int64)  # of the beam; the expansion follows all edges
    shown = place < 2 * DEGREE
    lists[heads[shown], place[shown]] = tails[shown]
    seeds = medoids(vectors)
    seen = np.zeros((count, n), bool)
    seen[:, seeds] = True
    beam = np.full((count, BEAM), -1, np.int64)
    score = np.full((count, BEAM), -3.0)
    done = np.ones((count, BEAM), bool)
    beam[:, : len(seeds)], score[:, : len(seeds)], done[:, : len(seeds)] = seeds, vectors[queries] @ vectors[seeds].T, False
    active = np.arange(count)
    # A query is a node as well: its own list is expanded with everything else in reach.
    strange = ~np.isin(queries, seeds)
    hits = [
        (np.repeat(active, len(seeds)), np.tile(seeds, count), score[:, : len(seeds)].ravel()),
        (active[strange], queries[strange], np.ones(int(strange.sum()))),
    ]
    seen[active, queries] = True
    while len(active):
        waiting = np.where(done[active], -9.0, score[active])
        best = waiting.argmax(1)
        going = waiting[np.arange(len(active)), best] > -9
        active, best = active[going], best[going]
        if not len(active):
            break
        done[active, best] = True
        near = lists[beam[active, best]]
        fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
        row, col = np.nonzero(fresh)
        who, what = active[row], near[row, col]
        first = np.unique(who * n + what, return_index=True)[1]
        row, col, who, what = row[first], col[first], who[first], what[first]
        seen[who, what] = True
        value = np.einsum("ij,ij->i", vectors[queries[who]], vectors[what])
        hits.append((who, what, value))
        new_beam, new_score = np.full(near.shape, -1, np.int64), np.full(near.shape, -3.0)
        new_beam[row, col], new_score[row, col] = what, value
        all_beam = np.concatenate([beam[active], new_beam], 1)
        all_score = np.concatenate([score[active], new_score], 1)
        all_done = np.concatenate([done[active], new_beam < 0], 1)
        top = np.argpartition(-all_score, BEAM - 1, axis=1)[:, :BEAM]
        beam[active], score[active], done[active] = (np.take_along_axis(x, top, 1) for x in (all_beam, all_score, all_done))
    who, what, value = (np.concatenate(x) for x in zip(*hits))
    held = [(who, what, value)]
    inside = value >= cosine - REACH
    who, what = who[inside], what[inside]
    while len(who):
        degree = sizes[what]
        step = np.arange(degree.sum()) - np.repeat(np.cumsum(degree) - degree, degree)
        who, what = np.repeat(who, degree), tails[np.repeat(begins[what], degree) + step]
        new = ~seen[who, what]
        who, what = who[new], what[new]
        first = np.unique(who * n + what, return_index=True)[1]
        who, what = who[first], what[first]
        seen[who, what] = True
        value = np.einsum("ij,ij->i", vectors[queries[who]], vectors[what])
        held.append((who, what, value))
        inside = value >= cosine - REACH
        who, what = who[inside], what[inside]
    who, what, value = (np.concatenate(x) for x in zip(*held))
    good = (value >= cosine) & (queries[who] != what)
    return queries[who[good]], what[good]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows (vec_id, row, high, low), null hashes for what links with nothing, and the classes (node, unit, ...)."""

    def measure(iterator):
        for batch in iterator:
            rows = []
            for values in batch.column(1).to_pylist():
                usable = values is not None and len(values) > 0 and None not in values
                own = np.array(values, np.float64) if usable else np.zeros(1)
                own = own / top if np.isfinite(own).all() and (top := np.abs(own).max()) > 0 else np.zeros(1)
                norm = np.linalg.norm(own)
                if norm == 0:
                    rows.append((None, None, None))
                else:
                    rows.append((*sequence_hash(np.array(values, np.float64).tobytes()), (own / norm).tobytes()))
            high, low, unit = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(unit, pa.binary())],
                names=["vec_id", "high", "low", "unit"],
            )

    doubles = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    known = stored(
        doubles.mapInArrow(measure, "vec_id long, high long, low long, unit binary").withColumn("row", F.monotonically_increasing_id()), "vectors"
    )
    usable = known.where("unit is not null").withColumn("size", F.octet_length("unit"))
    classes = usable.groupBy("high", "low", "size").agg(
        F.min("row").alias("node"), F.min("vec_id").alias("least_id"), F.count("*").alias("held"), F.first("unit").alias("unit")
    )
    return known, stored(classes, "classes")


def dealt(classes: DataFrame, shard_rows: int, sample: int) -> DataFrame:
    """(shard, home, node, held, unit): each class in the shards of its two nearest centres; home is its nearest."""
    total = classes.count()
    rows = classes.orderBy("high", "low").limit(sample).select("size", "unit").toPandas()
    wanted = max(1, min(math.ceil(2 * total / shard_rows), 512))
    fitted = {int(size): centres(_matrix(own["unit"]), wanted) for size, own in rows.groupby("size")}

    def nearest(units: np.ndarray, points: np.ndarray) -> np.ndarray:
        return np.argsort(-(units @ points.T), axis=1, kind="stable")[:, :2]

    def assign(iterator):
        for batch in iterator:
            frame = batch.to_pandas()
            for size, own in frame.groupby("size"):
                points = fitted.get(int(size))
                near = nearest(_matrix(own["unit"]), points) if points is not None else np.zeros((len(own), 1), int)
                for place in range(near.shape[1]):
                    names = [f"{size}-{c}" for c in near[:, place]]
                    out = own.assign(shard=names, home=place == 0)[["shard", "home", "node", "held", "unit"]]
                    yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    schema = "shard string, home boolean, node long, held long, unit binary"
    now = stored(classes.select("size", "node", "held", "unit").mapInArrow(assign, schema), "shards")
    for _ in range(SPLITS):
        large = now.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows)
        large = stored(large, "large")
        if large.isEmpty():
            break

        def fit(group: pd.DataFrame) -> pd.DataFrame:
            units = _matrix(group["unit"])
            found = centres(units, max(2, min(64, math.ceil(2 * int(group["n"].iloc[0]) / shard_rows))))
            return pd.DataFrame({"shard": [group["shard"].iloc[0]], "points": [found.tobytes()], "width": [units.shape[1]]})

        chance = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n"))
        drawn = now.join(large, "shard").where(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < chance * 1_000_000)
        points = drawn.groupBy("shard").applyInPandas(fit, "shard string, points binary, width int")

        def divide(iterator):
            for batch in iterator:
                frame = batch.to_pandas()
                for (shard, width), own in frame.groupby(["shard", "width"]):
                    near = nearest(_matrix(own["unit"]), np.frombuffer(own["points"].iloc[0], np.float64).reshape(-1, int(width)))
                    for place in range(near.shape[1]):
                        out = own.assign(shard=[f"{shard}.{c}" for c in near[:, place]], home=own["home"] & (place == 0))
                        yield pa.RecordBatch.from_pandas(out[["shard", "home", "node", "held", "unit"]], preserve_index=False)

        split = now.join(stored(points, "centres"), "shard").mapInArrow(divide, schema)
        following = now.join(large, "shard", "left_anti").select("shard", "home", "node", "held", "unit").union(split)
        # A class may come to a shard by two ways.
        following = following.groupBy("shard", "node").agg(F.max("home").alias("home"), F.first("held").alias("held"), F.first("unit").alias("unit"))
        following = stored(following.select("shard", "home", "node", "held", "unit"), "shards")
        dropped(now, large)
        now = following
    return now


def near_counts(units: np.ndarray, cosine: float) -> np.ndarray:
    """How many rows of a shard are within the cosine of each, itself included."""
    return np.concatenate([(units[at : at + 256] @ units.T >= cosine).sum(1) for at in range(0, len(units), 256)])


def cell_pairs(centre: np.ndarray, radius: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, of cells that are within the cosine as a whole, and pairs, i <= j, to be compared."""
    whole, open_ = [], []
    reach = math.acos(min(1.0, max(-1.0, cosine)))
    for i in range(len(centre)):
        angle = np.arccos(np.clip(centre[i:] @ centre[i], -1, 1))
        spread = radius[i:] + radius[i]
        inside = angle + spread <= reach - 1e-6
        inside[0] = False  # a cell with itself is compared
        beyond = angle - spread > reach + 1e-6
        beyond[0] = False
        whole.append(np.column_stack([np.full(int(inside.sum()), i), i + np.flatnonzero(inside)]))
        rest = np.flatnonzero(~inside & ~beyond)
        open_.append(np.column_stack([np.full(len(rest), i), i + rest]))
    return np.concatenate(whole), np.concatenate(open_)


def dense_links(shards: DataFrame, dense: DataFrame, cosine: float, cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Links between dense vectors: (node, links), the rows that each links with, and (a, b), a spanning set."""
    spark = shards.sparkSession
    own = stored(shards.where("home").join(dense, "node").select("shard", "node", "held", "unit"), "dense")
    parts = own.groupBy("shard").agg(F.ceil(F.count("*") / cell_rows).alias("parts"))
    name = F.concat_ws("/", "shard", F.pmod(F.xxhash64("node"), F.col("parts")).cast("string"))
    own = stored(own.join(parts, "shard").select(name.alias("cell"), "node", "held", "unit"), "cells")

    def measure(group: pd.DataFrame) -> pd.DataFrame:
        units = _matrix(group["unit"])
        total = units.sum(0)
        norm = np.linalg.norm(total)
        centre = total / norm if norm else units[0]
        radius = float(np.arccos(np.clip(units @ centre, -1, 1)).max())
        return pd.DataFrame({"cell": [group["cell"].iloc[0]], "centre": [centre.tobytes()], "radius": [radius], "held": [int(group["held"].sum())], "one": [int(group["node"].min())]})

    cells = own.groupBy("cell").applyInPandas(measure, "cell string, centre binary, radius double, held long, one long").orderBy("cell").toPandas()
    whole, compared = [], []
    for _, same in cells.groupby(cells["centre"].map(len)):
        inside, rest = cell_pairs(_matrix(same["centre"]), same["radius"].to_numpy(), cosine)
        at = same.index.to_numpy()
        whole.append(at[inside])
        compared.append(at[rest])
    whole, compared = np.concatenate(whole), np.concatenate(compared)
    names, ones, held = cells["cell"].to_numpy(), cells["one"].to_numpy(), cells["held"].to_numpy()
    both = np.concatenate([whole, whole[:, ::-1]])
    sure = pd.DataFrame({"cell": names[both[:, 0]], "links": held[both[:, 1]], "b": ones[both[:, 1]], "a": ones[both[:, 0]]})
    pairs = pd.DataFrame({"pair": np.arange(len(compared)), "one": names[compared[:, 0]], "two": names[compared[:, 1]]})
    pairs = spark.createDataFrame(pairs, "pair long, one string, two string")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        x, y = left["node"].to_numpy(), right["node"].to_numpy()
        near = _matrix(left["unit"]) @ _matrix(right["unit"]).T >= cosine
        itself = left["cell"].iloc[0] == right["cell"].iloc[0]
        if itself:
            near &= x[:, None] != y[None, :]
        nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
        i, j = np.nonzero(near)
        root = _roots(len(nodes), at[: len(x)][i], at[len(x) :][j])
        links = np.bincount(at[: len(x)], near @ right["held"].to_numpy(), len(nodes))
        if not itself:
            links += np.bincount(at[len(x) :], left["held"].to_numpy() @ near, len(nodes))
        some = links > 0
        return pd.DataFrame({"a": nodes[some], "b": nodes[root[some]], "links": links[some].astype(np.int64)})

    one = own.join(pairs.select("pair", F.col("one").alias("cell")), "cell")
    two = own.join(pairs.select(F.col("pair").alias("of"), F.col("two").alias("cell")), "cell")
    two = two.select("of", *(F.col(x).alias(x) for x in own.columns))
    found = one.groupBy("pair").cogroup(two.groupBy("of")).applyInPandas(compare, "a long, b long, links long")
    found = stored(found, "dense_found")
    counted, edges = found.select(F.col("a").alias("node"), "links"), found.select("a", "b")
    if len(sure):
        sums = sure.groupby("cell", as_index=False).agg(links=("links", "sum"), b=("b", "min"))
        sums = spark.createDataFrame(sums, "cell string, links long, b long")
        within = own.select("cell", "node").join(sums, "cell")
        counted = counted.union(within.select("node", "links"))
        edges = edges.union(within.select("node", "b")).union(spark.createDataFrame(sure[["a", "b"]], "a long, b long"))
    return counted, edges


def linked_vectors(vectors: DataFrame, cosine: float = 0.9, shard_rows: int = 4000, sample: int = 8192) -> DataFrame:
    """vec_id, n_links, component_id and kept; one row per row of `vectors` (vec_id, embedding)."""
    ship(vectors.sparkSession)
    known, classes = classes_of(vectors)
    shards = dealt(classes, shard_rows, sample)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        nodes = group["node"].to_numpy()
        units = _matrix(group["unit"])
        lists = pruned(units)
        at, place = np.nonzero(lists >= 0)
        full = near_counts(units, cosine) > limit  # marked by an edge to itself
        return pd.DataFrame({"u": np.concatenate([nodes[at], nodes[full]]), "v": np.concatenate([nodes[lists[at, place]], nodes[full]])})

    limit = max(1, shard_rows // DENSE)
    built = stored(shards.groupBy("shard").applyInPandas(build, "u long, v long").distinct(), "graph")
    dense = stored(built.where("u = v").select(F.col("u").alias("node")), "dense")
    marked = shards.join(dense.withColumn("dense", F.lit(True)), "node", "left").withColumn("dense", F.coalesce("dense", F.lit(False)))
    inner = built.where("u <> v").join(shards.select(F.col("shard").alias("inner_shard"), F.col("node").alias("u")), "u").join(
        shards.select(F.col("shard").alias("inner_shard"), F.col("node").alias("v")), ["inner_shard", "v"]
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("node")
        nodes, units, home, held = left["node"].to_numpy(), _matrix(left["unit"]), left["home"].to_numpy(), left["held"].to_numpy()
        full = left["dense"].to_numpy()
        n = len(nodes)
        if right.empty:
            return pd.DataFrame({x: np.zeros(0, np.int64) for x in ("a", "b", "links")})
        u, v = np.searchsorted(nodes, right["u"].to_numpy()), np.searchsorted(nodes, right["v"].to_numpy())
        found = [searched(units, u, v, part, cosine) for part in np.array_split(np.arange(n), max(1, n // 500))]
        a, b = (np.concatenate(x) for x in zip(*found))
        a, b = np.minimum(a, b), np.maximum(a, b)
        pairs = np.unique(a * n + b)
        a, b = pairs // n, pairs % n
        sparse = ~(full[a] & full[b])  # links of two dense vectors are counted apart
        a, b = a[sparse], b[sparse]
        own = home[a] & home[b]
        local = np.bincount(a[own], held[b[own]], n) + np.bincount(b[own], held[a[own]], n)
        root = _roots(n, a[own], b[own])
        at = np.flatnonzero(local > 0)
        here = pd.DataFrame({"a": nodes[at], "b": nodes[root[at]], "links": local[at].astype(np.int64)})
        far = pd.DataFrame({"a": nodes[a[~own]], "b": nodes[b[~own]], "links": np.zeros(int((~own).sum()), np.int64)})
        return pd.concat([here, far])

    found = marked.groupBy("shard").cogroup(inner.groupBy("inner_shard")).applyInPandas(search, "a long, b long, links long")
    found = stored(found, "found")
    homes = shards.where("home").select("node", F.col("shard").alias("home_shard"))
    far = found.where("links = 0").select("a", "b").distinct()
    far = (
        far.join(homes.select(F.col("node").alias("a"), F.col("home_shard").alias("ha")), "a")
        .join(homes.select(F.col("node").alias("b"), F.col("home_shard").alias("hb")), "b")
        .where("ha <> hb")  # those of one home are counted there
        .select("a", "b")
    )
    far = stored(far, "far")
    both = far.union(far.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(classes.select(F.col("node").alias("b"), "held"), "b").select(F.col("a").alias("node"), F.col("held").alias("links"))
    counted = counted.union(found.where("links > 0").select("a", "links")).groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("links > 0").select("a", "b").union(far)
    if not dense.isEmpty():
        within, spanning = dense_links(shards, dense, cosine, min(CELL, shard_rows))
        counted = counted.union(within).groupBy("node").agg(F.sum("links").alias("links"))
        edges = edges.union(spanning)
    labels = components(edges)
    grouped = classes.join(labels, "node", "left").join(counted, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = grouped.groupBy("label").agg(F.min("least_id").alias("component_id"))
    placed = grouped.join(least, "label").select(
        "high", "low", F.col("size").alias("s"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("held") - 1).alias("n_links")
    )
    rows = known.withColumn("s", F.octet_length("unit")).join(placed, ["high", "low", "s"], "left")
    component = F.when(F.col("unit").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that the pairs lead to, for each index."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        following = root.copy()
        np.minimum.at(following, a, low)
        np.minimum.at(following, b, low)
        following = following[following]
        if (following == root).all():
            return root
        root = following


def audited(vectors: DataFrame, result: DataFrame, cosine: float = 0.9, every: int = 50, block: int = 2000) -> DataFrame:
    """Recall of n_links for the vectors whose id is divisible by `every`, against all rows, block by block.

    One row: links there are, links found. Each task compares a block of queries
    with its own rows, so nothing larger than a block is collected anywhere.
    """
    ship(vectors.sparkSession)
    known, classes = classes_of(vectors)
    rows = known.where("unit is not null")
    blocks = max(1, math.ceil(rows.where(F.col("vec_id") % every == 0).count() / block))
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("row").alias("q"), "unit", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
    parts = max(1, math.ceil(rows.count() / block))
    spread = rows.select(F.col("row").alias("r"), F.col("unit").alias("other"), F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part"))
    left = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("part", F.col("part").cast("long"))
    right = spread.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("block", F.col("block").cast("long"))

    def count(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        if one.empty or two.empty:
            return pd.DataFrame({"q": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
        totals = np.zeros(len(one), np.int64)
        for size, own in one.groupby(one["unit"].map(len)):
            rest = two[two["other"].map(len) == size]
            if len(rest):
                near = _matrix(own["unit"]) @ _matrix(rest["other"]).T >= cosine
                near &= own["q"].to_numpy()[:, None] != rest["r"].to_numpy()[None, :]
                totals[one.index.get_indexer(own.index)] = near.sum(1)
        return pd.DataFrame({"q": one["q"], "n": totals})

    exact = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(count, "q long, n long")
    there = exact.agg(F.sum("n").alias("links"))
    got = result.where(F.col("vec_id") % every == 0).agg(F.sum("n_links").alias("found"))
    return there.withColumn("one", F.lit(1)).join(got.withColumn("one", F.lit(1)), "one").drop("one")

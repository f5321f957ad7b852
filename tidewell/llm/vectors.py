"""Embedding near-duplicates by a robust-pruned flat graph.

Vectors of a label are dealt to overlapping cluster shards. Each shard builds a flat graph
whose neighbour lists are robustly pruned (a candidate goes when a kept neighbour is nearer
to it than the node, by a factor); the lists of a vector from all its shards are united.
Every vector then searches the shards of its own cluster, greedily from the medoid, and on
from every find within the range until the range is exhausted. Finds are verified by their
cosine in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_batch, table
from tidewell.llm.components import components
from tidewell.scratch import written

LEAST_COSINE = 0.98
#: Rows of a shard, and queries that meet it in one task, as expected values.
SHARD_ROWS, QUERY_ROWS = 400, 256
#: Bounds of the index: clusters of a label, and rows of a label they are fitted on.
MOST_CLUSTERS, SAMPLE_ROWS = 32, 4000
#: Radians beyond the nearest centroid up to which a vector also joins another's shard.
OVERLAP = 0.15
DEGREE, ALPHA, NEAREST, RANDOM, BEAM = 16, 1.2, 48, 8, 24


def unit(vector) -> list[float] | None:
    """The vector at length one in double precision; None when it can have no links."""
    if vector is None or any(x is None for x in vector):
        return None
    v = np.asarray(vector, float)
    length = math.sqrt(float(v @ v)) if len(v) and np.isfinite(v).all() else 0.0
    if length and not math.isfinite(length):
        v = v / np.abs(v).max()
        length = math.sqrt(float(v @ v))
    return (v / length).tolist() if length > 0 else None


def _units(batches):
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("unit", pa.list_(pa.float64()))])
    for batch in batches:
        ids, labels, vectors = (batch.column(i).to_pylist() for i in range(3))
        yield arrow_batch([ids, labels, [unit(v) for v in vectors]], schema)


def centroids(x: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """k unit centroids by a few rounds of spherical k-means."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(8):
        near = (x @ c.T).argmax(axis=1)
        sums = np.array([x[near == i].sum(axis=0) if (near == i).any() else c[i] for i in range(len(c))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norms > 0, sums / np.maximum(norms, 1e-300), c)
    return c


def _cells(fitted: dict):
    """Rows (cell, home, rep, weight, label, unit): a vector's own cell and those it overlaps."""

    def run(batches):
        schema = pa.schema(
            [("cell", pa.int32()), ("home", pa.bool_()), ("rep", pa.int64()), ("weight", pa.int64()),
             ("label", pa.int64()), ("size", pa.int32()), ("unit", pa.list_(pa.float64()))]
        )
        for batch in batches:
            rows = []
            for rep, weight, label, vector in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                c = fitted.get((label, len(vector)))
                angles = np.zeros(1) if c is None else np.arccos(np.clip(c @ np.asarray(vector), -1, 1))
                home = int(angles.argmin())
                for i in np.flatnonzero(angles <= angles[home] + OVERLAP):
                    rows.append((int(i), int(i) == home, rep, weight, label, len(vector), vector))
            if rows:
                yield arrow_batch(list(zip(*rows, strict=True)), schema)

    return run


def robust_prune(node: int, candidates: np.ndarray, sims: np.ndarray) -> list[int]:
    """Neighbours of a node among candidates (nearest first), spread by the pruning rule."""
    own = 1 - sims[node, candidates]
    alive, out = np.ones(len(candidates), bool), []
    while alive.any() and len(out) < DEGREE:
        best = int(alive.argmax())
        out.append(int(candidates[best]))
        alive[best] = False
        # Squared chord lengths are twice these; the factor is squared to match.
        alive &= ALPHA**2 * (1 - sims[candidates[best], candidates]) > own
    return out


def build_graph(x: np.ndarray) -> list[list[int]]:
    """Pruned neighbour lists of a shard, with the reverse links."""
    sims, n = x @ x.T, len(x)
    rng = np.random.default_rng(n)
    lists = []
    for i in range(n):
        near = np.argpartition(-sims[i], min(NEAREST, n - 1))[: NEAREST + 1]
        some = np.unique(np.concatenate([near, rng.integers(0, n, RANDOM)]))
        some = some[some != i]
        lists.append(robust_prune(i, some[np.argsort(-sims[i, some], kind="stable")], sims))
    back: list[set[int]] = [set(a) for a in lists]
    for i, near in enumerate(lists):
        for j in near:
            back[j].add(i)
    out = []
    for i, near in enumerate(back):
        some = np.array(sorted(near), int)
        if len(some) > 2 * DEGREE:
            some = np.array(robust_prune(i, some[np.argsort(-sims[i, some], kind="stable")], sims))
        out.append(some.tolist())
    return out


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep")
    reps = rows["rep"].to_numpy()
    lists = build_graph(np.stack(rows["unit"].to_list()))
    return pd.DataFrame({"rep": reps, "near": [reps[a].tolist() for a in lists]})


def search(x: np.ndarray, graph: list[list[int]], queries: np.ndarray, start: list[int], least: float) -> np.ndarray:
    """Whether each query (row) is found to have at least cosine ``least`` with each node.

    ``start``: for each query the node it begins at besides the medoid, or -1.
    """
    n, q, width = len(x), len(queries), max(1, max(map(len, graph)))
    near = np.full((n, width), -1)
    for i, a in enumerate(graph):
        near[i, : len(a)] = a
    medoid = int((x @ x.mean(axis=0)).argmax())
    seen, expanded = np.zeros((q, n), bool), np.zeros((q, n), bool)
    cosine = np.full((q, n), -2.0)

    def visit(rows, nodes):
        rows, nodes = rows[nodes >= 0], nodes[nodes >= 0]
        new = ~seen[rows, nodes]
        rows, nodes = rows[new], nodes[new]
        seen[rows, nodes] = True
        cosine[rows, nodes] = np.einsum("ij,ij->i", queries[rows], x[nodes])

    every = np.arange(q)
    visit(every, np.full(q, medoid))
    visit(every, np.asarray(start))
    active = every
    while len(active):  # greedy: the best node not yet expanded, while it is in the beam
        open_cosine = np.where(expanded[active], -2.0, cosine[active])
        best = open_cosine.argmax(axis=1)
        value = open_cosine[np.arange(len(active)), best]
        kth = np.partition(cosine[active], n - min(BEAM, n), axis=1)[:, n - min(BEAM, n)]
        go = (value > -2) & ((value >= kth) | (value >= least))  # beyond the beam: the range
        active, best = active[go], best[go]
        expanded[active, best] = True
        visit(np.repeat(active, width), near[best].ravel())
    return cosine >= least


def _roots(n: int, pairs) -> list[int]:
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _search(least: float):
    def run(nodes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """(rep, links, root): links of each query in this shard, and for linked nodes and
        queries the least one they are joined to here (links 0)."""
        empty = pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
        if not len(nodes) or not len(asked):
            return empty
        nodes = nodes.sort_values("rep")
        reps, weights = nodes["rep"].to_numpy(), nodes["weight"].to_numpy()
        place = {r: i for i, r in enumerate(reps)}
        graph = [[place[r] for r in a if r in place] for a in nodes["near"]]
        ids = asked["rep"].to_numpy()
        start = [place.get(r, -1) for r in ids]
        found = search(np.stack(nodes["unit"].to_list()), graph, np.stack(asked["unit"].to_list()), start, least)
        for i, own in enumerate(start):
            if own >= 0:
                found[i, own] = False
        links = found @ weights
        some = np.flatnonzero(links)
        names = np.unique(np.concatenate([ids[some], reps[found.any(axis=0)]]))
        at = {r: i for i, r in enumerate(names)}
        where = np.argwhere(found)
        roots = _roots(len(names), ((at[ids[i]], at[reps[j]]) for i, j in where))
        return pd.DataFrame(
            {
                "rep": np.concatenate([ids[some], names]),
                "links": np.concatenate([links[some], np.zeros(len(names), int)]),
                "root": np.concatenate([ids[some], names[roots] if len(names) else names]),
            }
        ).astype("int64")

    return run


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding, label).

    Vectors link only within a label and a number of components. A null label, a null, empty,
    zero or not finite vector, or one with null components, links with nothing and is kept.
    Equal directions are one node with a weight, so copies cost one row. A null id takes no
    part and has null component_id and kept. Repeated rows are vectors of their own.
    """
    spark = vectors.sparkSession
    narrow = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].cast("long").alias("label"), vectors["embedding"]
    )
    units = written(narrow.mapInArrow(_units, "vec_id long, label long, unit array<double>"), "vector-units")
    usable = units.where("vec_id is not null and label is not null and unit is not null")
    nodes = written(
        usable.groupBy("label", "unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "vector-nodes"
    )
    counts = {
        (r["label"], r["size"]): r["n"]
        for r in nodes.groupBy("label", F.size("unit").alias("size")).agg(F.count("*").alias("n")).collect()
    }
    split = {k: n for k, n in counts.items() if n > SHARD_ROWS}
    fitted = {}
    for (label, size), n in sorted(split.items()):
        share = min(1.0, SAMPLE_ROWS / n)
        drawn = F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < int(share * (1 << 20))
        sample = nodes.where((F.col("label") == label) & (F.size("unit") == size) & drawn).orderBy("rep")
        x = np.array(sample.select("unit").toArrow()["unit"].to_pylist()).reshape(-1, size)
        if len(x):
            fitted[label, size] = centroids(x, min(MOST_CLUSTERS, math.ceil(n / SHARD_ROWS)))
    schema = "cell int, home boolean, rep long, weight long, label long, size int, unit array<double>"
    cells = written(nodes.select("rep", "weight", "label", "unit").mapInArrow(_cells(fitted), schema), "vector-cells")
    # Cells that clusters leave large are cut into shards; queries of a cell visit all of them.
    sizes = cells.groupBy("label", "size", "cell").agg(
        F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("shards"),
        F.ceil(F.sum(F.col("home").cast("int")) / QUERY_ROWS).cast("int").alias("parts"),
    )
    sizes = written(sizes, "vector-sizes")
    cells = written(cells.join(sizes, ["label", "size", "cell"]), "vector-placed")
    members = cells.withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards").cast("long")))
    shard_keys = ["label", "size", "cell", "shard"]
    built = members.groupBy(*shard_keys).applyInPandas(_build, "rep long, near array<long>")
    graph = written(
        built.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "vector-graph"
    )
    held = members.join(graph, "rep").withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), "parts") - 1)))
    asked = (
        cells.where("home")
        .withColumn("part", F.pmod(F.hash("rep"), F.col("parts")))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards").cast("long") - 1)))
    )
    keys = [*shard_keys, "part"]
    asked = written(asked.select(*keys, "rep", "unit"), "vector-queries")
    found = written(
        held.select(*keys, "rep", "weight", "unit", "near")
        .groupBy(*keys)
        .cogroup(asked.groupBy(*keys))
        .applyInPandas(_search(least), "rep long, links long, root long"),
        "vector-found",
    )
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.where("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = (
        nodes.join(links, "rep", "left")
        .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            F.col("label").alias("in_label"),
            F.col("unit").alias("in_unit"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    known = written(known, "vector-known")
    component = F.coalesce("component_id", "vec_id")
    return units.join(
        known,
        (units["label"] == known["in_label"]) & (units["unit"] == known["in_unit"]) & units["vec_id"].isNotNull(),
        "left",
    ).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )


def op5_vectors(spark, folder):
    return near_duplicates(table(spark, folder, "embeddings"))


def audit_recall(vectors: DataFrame, found: DataFrame, least: float = LEAST_COSINE, every: int = 100) -> float:
    """Share of the links of the vectors with id divisible by ``every`` that were counted.

    The queries are sent to all rows in blocks; each block is a bounded number of rows.
    """
    spark = vectors.sparkSession
    narrow = vectors.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    units = narrow.mapInArrow(_units, "vec_id long, label long, unit array<double>").where("label is not null and unit is not null")
    counted = dict(found.where(F.col("vec_id") % every == 0).select("vec_id", "n_links").collect())
    ids = sorted(counted)
    true, got = 0, 0
    for start in range(0, len(ids), 4096):
        block = ids[start : start + 4096]
        queries = units.where(F.col("vec_id").isin(block)).collect()

        def near(batches, queries=queries):
            schema = pa.schema([("query", pa.int64()), ("n", pa.int64())])
            for batch in batches:
                ids, labels, vectors = (batch.column(i).to_pylist() for i in range(3))
                for q_id, label, q in queries:
                    rows = [i for i in range(len(ids)) if labels[i] == label and len(vectors[i]) == len(q) and ids[i] != q_id]
                    n = int((np.array([vectors[i] for i in rows]) @ np.asarray(q) >= least).sum()) if rows else 0
                    yield arrow_batch([[q_id], [n]], schema)

        for q_id, n in units.mapInArrow(near, "query long, n long").groupBy("query").agg(F.sum("n")).collect():
            true, got = true + n, got + min(n, counted[q_id])
    return got / true if true else 1.0

"""Approximate nearest neighbours: a small-world graph per shard.

Vectors are dealt to shards of bounded size.  A shard's vectors get random
levels; on each level every vector keeps a few diverse near neighbours and the
nearest links back, all as flat arrays.  Each group of a level whose vectors'
very nearest are all its own, and each vector that no links lead to, has a
member on the level above, so that separate groups are reached.
A search keeps several vectors on the upper levels, starts from all of them on
the next and widens on the lowest.  Blocks of queries run through each shard and
the shards' results are merged.  Equal vectors share one node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ocellus.llm.common import materialise

SHARD_ROWS, QUERY_ROWS = 8192, 512
LINKS, BUILD_WIDTH, SEARCH_WIDTH, UPPER_WIDTH = 16, 48, 96, 64
#: The nearest neighbours by which groups are told apart.
OWN = 4


def near_lists(x: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """For each of ``rows`` its ``k`` nearest others among ``rows`` (places in
    ``rows``), nearest first."""
    v = x[rows]
    sq = np.einsum("ij,ij->i", v, v)
    k = min(k, len(rows) - 1)
    out = np.empty((len(rows), k), np.int32)
    for a in range(0, len(rows), 1024):
        d = sq[None, :] - 2 * (v[a:a + 1024] @ v.T)
        d[np.arange(d.shape[0]), np.arange(a, a + d.shape[0])] = np.inf
        near = np.argpartition(d, k - 1, axis=1)[:, :k] if k < d.shape[1] else np.argsort(d, axis=1)[:, :k]
        order = np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable")
        out[a:a + 1024] = np.take_along_axis(near, order, 1)
    return out


def diverse(x: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """Of each row of ``near``, up to ``links`` that are nearer to the row's
    vector than to any neighbour chosen before; filled up with the nearest of
    the rest.  -1 where there are none."""
    n, k = near.shape
    chosen = np.full((n, links), -1, np.int32)
    for a in range(0, n, 512):
        part = near[a:a + 512]
        v = x[part]
        own = np.linalg.norm(v - x[a:a + len(part), None], axis=2)
        take = np.zeros(part.shape, bool)
        for j in range(k):
            between = np.linalg.norm(v - v[:, j:j + 1], axis=2)
            blocked = (take & (between < own[:, j:j + 1])).any(1)
            take[:, j] = ~blocked & (take.sum(1) < links)
        # the chosen first, then the rest, each by distance
        order = np.argsort(~take, axis=1, kind="stable")[:, :links]
        chosen[a:a + len(part), :order.shape[1]] = np.take_along_axis(part, order, 1)
    return chosen


def parts(near: np.ndarray) -> np.ndarray:
    """The smallest row reachable over the links of ``near`` (-1: none) in
    either direction, for each of its rows."""
    root = np.arange(len(near))
    source, column = np.nonzero(near >= 0)
    target = near[source, column]
    while True:
        low = root.copy()
        np.minimum.at(low, source, root[target])
        np.minimum.at(low, target, root[source])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def reached(table: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which rows the links of ``table`` lead to from the rows ``start``."""
    done = np.zeros(len(table), bool)
    while len(start):
        done[start] = True
        start = np.unique(table[start])
        start = start[(start >= 0) & ~done[start]]
    return done


def build(x: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(nodes, bounds, links)``: per level, from the lowest, ``nodes[bounds
    [l]:bounds[l + 1]]`` are its vectors and the same rows of ``links`` (two
    times ``LINKS`` wide, -1 where there are fewer) their neighbours."""
    rng = np.random.default_rng(seed)
    level = np.floor(-np.log(1 - rng.random(len(x))) / np.log(LINKS)).astype(int)
    nodes, links, bounds = [], [], [0]
    at = 0
    while at <= level.max(initial=0):
        rows = np.flatnonzero(level >= at).astype(np.int32)
        table = np.full((len(rows), 2 * LINKS), -1, np.int32)
        if len(rows) > 1:
            near = near_lists(x, rows, BUILD_WIDTH)
            out = diverse(x[rows], near, LINKS)
            table[:, :LINKS] = out
            source = np.repeat(np.arange(len(rows), dtype=np.int32), LINKS)
            target = out.ravel()
            source, target = source[target >= 0], target[target >= 0]
            apart = np.linalg.norm(x[rows[source]] - x[rows[target]], axis=1)
            order = np.lexsort((apart, target))
            source, target = source[order], target[order]
            place = np.arange(len(target)) - np.searchsorted(target, target)
            room = place < LINKS  # links back, the nearest as far as they fit
            table[target[room], LINKS + place[room]] = source[room]
            above = level[rows] > at
            part = parts(near[:, :OWN])
            if part.any() or above.any():  # each group has a member above
                above[np.setdiff1d(part, part[above])] = True
            lost = ~reached(table, np.flatnonzero(above) if above.any() else np.arange(min(len(rows), UPPER_WIDTH)))
            if lost.any() and not above.any():
                above[0] = True
            while lost.any():  # one of each group that nothing leads to
                rest = np.where(lost[:, None] & (table >= 0) & lost[table], table, -1)
                above[np.unique(parts(rest)[lost])] = True
                lost = ~reached(table, np.flatnonzero(above))
            level[rows[above]] = np.maximum(level[rows[above]], at + 1)
        nodes.append(rows)
        links.append(np.where(table >= 0, rows[table], -1))
        bounds.append(bounds[-1] + len(rows))
        at += 1
    return np.concatenate(nodes), np.array(bounds, np.int32), np.concatenate(links)


def search(x: np.ndarray, graph, queries: np.ndarray, k: int, width: int = SEARCH_WIDTH) -> np.ndarray:
    """Places of up to ``k`` near vectors per query (-1: fewer), all queries
    side by side: in each step every query follows its best open node."""
    nodes, bounds, links = graph
    q = np.arange(len(queries))

    def dist(rows):
        return np.where(rows >= 0, np.sqrt(((x[rows] - queries[:, None]) ** 2).sum(2)), np.inf)

    top = len(bounds) - 2
    best = np.tile(nodes[bounds[top]:bounds[top + 1]][:UPPER_WIDTH], (len(queries), 1))
    for at in range(top, -1, -1):
        own = nodes[bounds[at]:bounds[at + 1]]
        place = np.full(len(x), -1, np.int32)
        place[own] = np.arange(len(own), dtype=np.int32)
        table = links[bounds[at]:bounds[at + 1]]
        wide = width if at == 0 else UPPER_WIDTH
        seen = np.zeros((len(queries), len(x)), bool)
        there = best >= 0
        seen[np.broadcast_to(q[:, None], best.shape)[there], best[there]] = True
        d = dist(best)
        open_ = there
        while True:
            i = np.argmin(np.where(open_, d, np.inf), axis=1)
            live = open_[q, i]
            if not live.any():
                break
            rows = table[place[best[q, i]]]
            open_[q, i] = False
            fresh = (rows >= 0) & ~seen[q[:, None], rows] & live[:, None]
            first = np.sort(np.where(fresh, rows, -1), axis=1)
            fresh = (first >= 0) & np.c_[np.ones(len(q), bool), first[:, 1:] != first[:, :-1]]
            rows = np.where(fresh, first, -1)
            seen[np.broadcast_to(q[:, None], rows.shape)[fresh], rows[fresh]] = True
            best, d = np.c_[best, rows], np.c_[d, dist(rows)]
            open_ = np.c_[open_, fresh]
            order = np.argsort(d, axis=1, kind="stable")[:, :wide]
            best, d, open_ = (np.take_along_axis(t, order, 1) for t in (best, d, open_))
            open_ &= np.isfinite(d)
    order = np.argsort(d, axis=1, kind="stable")
    best, d = np.take_along_axis(best, order, 1), np.take_along_axis(d, order, 1)
    found = best[:, :k]
    return np.where(np.isfinite(d[:, :k]), found, -1)


_INDEX = "shard int, ids binary, vectors binary, centre binary, nodes binary, bounds binary, links binary"


def _build(frame):
    import pandas as pd

    frame = frame.sort_values("rep")
    x = np.stack(frame["vec"].to_numpy()).astype(np.float64)
    centre = x.mean(0)
    # links and the search use distances only: without the mean they keep their digits
    x = (x - centre).astype(np.float32)
    nodes, bounds, links = build(x, int(frame["shard"].iloc[0]))
    return pd.DataFrame([{
        "shard": int(frame["shard"].iloc[0]), "ids": frame["rep"].to_numpy(np.int64).tobytes(), "vectors": x.tobytes(),
        "centre": centre.tobytes(),
        "nodes": nodes.astype(np.int32).tobytes(), "bounds": bounds.tobytes(), "links": links.astype(np.int32).tobytes()}])


def _block(frame):
    import pandas as pd

    return pd.DataFrame([{"block": int(frame["block"].iloc[0]), "d": int(frame["d"].iloc[0]), "q_ids": frame["query_id"].to_numpy(np.int64).tobytes(),
                          "q_vectors": np.stack(frame["vec"].to_numpy()).astype(np.float64).tobytes()}])


def _search(k: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, q_ids = (np.frombuffer(row[c], np.int64) for c in ("ids", "q_ids"))
                x = np.frombuffer(row["vectors"], np.float32).reshape(len(ids), -1)
                q = np.frombuffer(row["q_vectors"], np.float64).reshape(len(q_ids), -1)
                graph = (np.frombuffer(row["nodes"], np.int32), np.frombuffer(row["bounds"], np.int32),
                         np.frombuffer(row["links"], np.int32).reshape(-1, 2 * LINKS))
                near = search(x, graph, (q - np.frombuffer(row["centre"])).astype(np.float32), k)
                at, place = np.nonzero(near >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(ids[near[at, place]])], names=["query_id", "rep"])
    return run


def usable_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, vec, d``: vectors (of doubles, ``d`` long) without null or
    non-finite components that are not zero; rows with null ids are left out."""
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")).where(
        "vec_id is not null and vec is not null and size(vec) > 0 and not exists(vec, v -> v is null)"
        " and forall(vec, v -> not isnan(v) and abs(v) < double('infinity')) and exists(vec, v -> v != 0)").withColumn(
        "d", F.size("vec"))


def _dealt(rows: DataFrame, per: int) -> DataFrame:
    """``d, first, parts``: how many parts of about ``per`` rows each length
    of vector gets, numbered on from ``first``."""
    parts = rows.groupBy("d").agg(F.ceil(F.count("*") / F.lit(per)).cast("int").alias("parts"))
    # one row per length: few enough for one task
    return parts.withColumn("first", (F.sum("parts").over(Window.orderBy("d")) - F.col("parts")).cast("int"))


def _distance(a: str, b: str):
    return F.expr(f"sqrt(aggregate(zip_with({a}, {b}, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x))")


def nearest(spark: SparkSession, rows: DataFrame, is_query, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``rows(vec_id,
    embedding)`` that meets ``is_query``, its ``k`` nearest others found by
    Euclidean distance in double precision on the vectors as given, ties to the
    smaller vec_id.  Vectors are compared with those of their length.  All
    usable rows are indexed (see ``usable_vectors``); of rows that repeat an id
    the smallest vector counts.  Other columns are ignored; without usable
    rows there are no results."""
    ok = materialise(spark, usable_vectors(rows).groupBy("vec_id").agg(F.min("vec").alias("vec")).withColumn(
        "d", F.size("vec")), "ann-vectors")
    # equal vectors: of each, the k + 1 smallest ids are all that a result can hold
    first = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    nodes = materialise(
        spark, ok.withColumn("n", first).where(F.col("n") <= k + 1).groupBy("vec", "d").agg(
            F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("members")), "ann-nodes")
    shards = materialise(spark, _dealt(nodes, SHARD_ROWS), "ann-shards")
    index = materialise(
        spark, nodes.join(shards, "d").withColumn("shard", F.col("first") + F.pmod(F.xxhash64("rep"), "parts").cast("int"))
        .select("shard", "rep", "vec").groupBy("shard").applyInPandas(_build, _INDEX), "ann-index")
    queries = ok.where(is_query).select(F.col("vec_id").alias("query_id"), "vec", "d")
    blocks = materialise(spark, _dealt(queries, QUERY_ROWS), "ann-blocks")
    packed = queries.join(blocks, "d").withColumn(
        "block", F.col("first") + F.pmod(F.xxhash64("query_id"), "parts").cast("int")).groupBy(
        "block").applyInPandas(_block, "block int, d int, q_ids binary, q_vectors binary")
    # every block visits every shard of its length
    visits = packed.join(shards, "d").withColumn("shard", F.explode(F.sequence(F.col("first"), F.expr("first + parts - 1"))))
    found = visits.select("shard", "q_ids", "q_vectors").join(index, "shard").mapInArrow(
        _search(k + 1), "query_id long, rep long")
    scored = (found.join(queries.select("query_id", F.col("vec").alias("q")), "query_id").join(nodes, "rep")
              .select("query_id", "members", _distance("q", "vec").alias("score")))
    near = scored.select("query_id", F.explode("members").alias("vec_id"), "score").where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

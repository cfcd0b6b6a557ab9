"""Nearest neighbours by cosine from balanced posting lists.

Index: a bounded sample is cut into equal parts again and again along the direction between two centres; the means of the parts are the
centroids, about one for ``LIST_SIZE`` vectors. Every vector is then written to the list of its nearest centroid, and boundary vectors
also to other centroids almost as near, unless a chosen centroid lies nearer to that one than the vector does. Lists longer than planned
are dealt over chunks.

Search: centroids are few and lie in memory as a graph of near neighbours; a best-first walk gives a query its nearest centroids, and
those farther than ``ratio`` times the nearest are pruned. The ratio is the least that finds ``RECALL`` of the true neighbours of
sampled queries within the sample; the full data are denser, so they find more. Queries meet the chunks of their lists in blocks.

Equal vectors are one node with its few smallest ids, so a vector that a third of the rows hold is searched once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from daybook.llm.common import settle

NEAREST = 5
LIST_SIZE = 256  # vectors of the table for each list, while lists are fewer than MAX_LISTS
MAX_LISTS = 4_096  # bounds what is broadcast: centroids of 64 numbers take 2 MB
SAMPLE = 32_768  # vectors that the index is fitted on
CELLS = 1 << 20  # numbers of a distance matrix held at once
REPLICAS = 4
SLACK = 1.1  # boundary: at most this many times the distance to the nearest centroid
RECALL = 0.97
RATIOS = (1.0, 1.02, 1.04, 1.06, 1.08, 1.1, 1.12, 1.15, 1.18, 1.22, 1.26, 1.3, 1.4, 1.6, 4.0)
DEGREE = 16  # edges of a centroid
WALK = 256  # centroids that a walk keeps
CHUNK = 4_096  # vectors searched together
ASKED = 8_192  # queries that meet a chunk together, about
SLICE = 512  # queries whose distances to a chunk are held at once


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def balanced_means(x: np.ndarray, parts: int, rng) -> np.ndarray:
    """Means of ``parts`` equal parts of the unit vectors ``x``."""
    if parts <= 1 or len(x) < 2:
        mean = x.mean(axis=0)
        return (mean if np.linalg.norm(mean) > 1e-9 else x[0])[None, :]
    one, two = x[rng.choice(len(x), 2, replace=False)]
    for _ in range(4):
        near = x @ (one - two) > 0
        if near.all() or not near.any():
            break
        one, two = x[near].mean(axis=0), x[~near].mean(axis=0)
    order = np.argsort(-(x @ (one - two)), kind="stable")
    half = parts // 2
    cut = min(max(1, len(x) * half // parts), len(x) - 1)
    return np.vstack([balanced_means(x[order[:cut]], half, rng), balanced_means(x[order[cut:]], parts - half, rng)])


def distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * cosine))


@dataclass
class Index:
    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    ratio: float = RATIOS[-1]
    fewest: int = 0  # vectors that the lists of a query hold at least
    sizes: np.ndarray | None = None

    @classmethod
    def of(cls, centroids: np.ndarray) -> "Index":
        amount, edges = len(centroids), min(DEGREE, len(centroids) - 1)
        graph = np.empty((amount, edges), dtype=np.int32)
        rows = max(1, CELLS // amount)
        for low in range(0, amount, rows):
            near = centroids[low:low + rows] @ centroids.T
            near[np.arange(len(near)), np.arange(low, low + len(near))] = -2
            graph[low:low + rows] = np.argsort(-near, axis=1, kind="stable")[:, :edges]
        return cls(centroids, graph, np.arange(0, amount, max(1, amount // 8)))

    def lists_of(self, x: np.ndarray) -> list[list[int]]:
        """Lists that each unit vector is written to."""
        rows = max(1, CELLS // len(self.centroids))
        return [own for low in range(0, len(x), rows) for own in self._lists_of(x[low:low + rows])]

    def _lists_of(self, x: np.ndarray) -> Iterator[list[int]]:
        cosines = x @ self.centroids.T
        few = min(2 * REPLICAS, cosines.shape[1])
        top = np.argpartition(-cosines, few - 1, axis=1)[:, :few]
        near = np.take_along_axis(cosines, top, axis=1)
        order = np.lexsort((top, -near), axis=1)
        top, far = np.take_along_axis(top, order, axis=1), distance(np.take_along_axis(near, order, axis=1))
        for row, d in zip(top, far, strict=True):
            chosen = [int(row[0])]
            for j, dj in zip(row[1:], d[1:], strict=True):
                if len(chosen) == REPLICAS or dj > SLACK * d[0]:
                    break
                if (distance(self.centroids[chosen] @ self.centroids[j]) > dj).all():
                    chosen.append(int(j))
            yield chosen

    def walk(self, q: np.ndarray) -> list[tuple[float, int]]:
        """Nearest centroids of a unit vector as (distance, list), nearest first."""
        seen = set(self.entries.tolist())
        start = distance(self.centroids[self.entries] @ q)
        open_ = [(float(d), int(c)) for d, c in zip(start, self.entries, strict=True)]
        heapq.heapify(open_)
        best = [(-d, c) for d, c in open_]
        heapq.heapify(best)
        while open_:
            d, c = heapq.heappop(open_)
            if len(best) >= WALK and d > -best[0][0]:
                break
            fresh = [int(j) for j in self.graph[c] if j not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for dj, j in zip(distance(self.centroids[fresh] @ q).tolist(), fresh, strict=True):
                if len(best) < WALK or dj < -best[0][0]:
                    heapq.heappush(open_, (dj, j))
                    heapq.heappush(best, (-dj, j))
                    if len(best) > WALK:
                        heapq.heappop(best)
        return sorted((-d, c) for d, c in best)

    def probes(self, q: np.ndarray) -> list[int]:
        """Lists that a unit vector is searched in."""
        near = self.walk(q)
        limit, held, found = near[0][0] * self.ratio + 1e-12, 0, []
        for d, c in near:
            if d > limit and held >= self.fewest:
                break
            found.append(c)
            held += int(self.sizes[c]) if self.sizes is not None else self.fewest
        return found


def fit(sample: np.ndarray, rows: int, list_size: int = LIST_SIZE, seed: int = 1) -> Index:
    """An index for ``rows`` vectors, fitted on a sample of unit vectors."""
    rng = np.random.default_rng(seed)
    parts = max(1, min(MAX_LISTS, rows // list_size, len(sample)))
    index = Index.of(unit(balanced_means(sample, parts, rng)))
    if parts == 1:
        return index
    lists: list[list[int]] = [[] for _ in range(parts)]
    for at, own in enumerate(index.lists_of(sample)):
        for c in own:
            lists[c].append(at)
    queries = rng.choice(len(sample), min(256, len(sample)), replace=False)
    truth = [np.argsort(-(sample @ sample[q]), kind="stable")[:NEAREST + 1] for q in queries]
    walks = [index.walk(sample[q]) for q in queries]
    for index.ratio in RATIOS:
        found = 0
        for near, true in zip(walks, truth, strict=True):
            held = {v for d, c in near if d <= near[0][0] * index.ratio + 1e-12 for v in lists[c]}
            found += sum(int(t) in held for t in true)
        if found >= RECALL * sum(map(len, truth)):
            break
    return index


# ----------------------------------------------------------------------------- Spark

def _numbers(column) -> list[np.ndarray | None]:
    """Float64 vectors of an Arrow list column; None where a vector takes no part."""
    out = []
    for value in column:
        values = value.values
        if values is None or values.null_count or not len(values):
            out.append(None)
            continue
        x = np.asarray(values, dtype=np.float64)
        out.append(x + 0.0 if np.isfinite(x).all() and x.any() else None)
    return out


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        vectors = _numbers(batch.column(1))
        data = [None if x is None else x.tobytes() for x in vectors]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([None if d is None else xxhash.xxh3_128_digest(d) for d in data], pa.binary()), pa.array(data, pa.binary()),
             pa.array([None if x is None else x.size for x in vectors], pa.int32())], names=["vec_id", "key", "vec", "dim"])


def matrix(column) -> np.ndarray:
    return np.stack([np.frombuffer(v, dtype=np.float64) for v in column])


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors whose squares neither overflow nor vanish; others stay exactly as they are."""
    most = np.abs(x).max(axis=1, keepdims=True)
    return np.where((most > 1e100) | (most < 1e-100), x / most, x)


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row with ``q``, every row summed on its own."""
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def _search(nearest: int):
    def run(key: tuple[Any, ...], queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(queries) and len(vectors):
            x, least, node = scaled(matrix(vectors["vec"])), vectors["least"].to_numpy(), vectors["node"].to_numpy()
            units = unit(x).T
            for low in range(0, len(queries), SLICE):
                q = scaled(matrix(queries["vec"].iloc[low:low + SLICE]))
                for row, own, near in zip(queries["query"].iloc[low:low + SLICE], q, unit(q) @ units, strict=True):
                    few = min(nearest, near.size)
                    line = np.partition(near, near.size - few)[near.size - few] - 1e-9
                    kept = np.flatnonzero(near >= line)
                    exact = cosines(x[kept], own)
                    for at in np.lexsort((least[kept], -exact))[:few]:
                        out.append((row, int(node[kept[at]]), float(exact[at])))
        return pd.DataFrame(out, columns=["query", "node", "score"])

    return run


def neighbours(table: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", nearest: int = NEAREST,
               list_size: int = LIST_SIZE, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found for every row for which the column ``is_query`` (of vec_id) is true.

    Vectors that are null, empty, zero or hold null or non-finite numbers take no part, nor do rows without an id and vectors of another
    length than most. Rows that repeat an id and its vector count once. Other columns are not read; an empty table gives an empty result.
    """
    spark = table.sparkSession
    rows = settle(table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).filter("vec_id is not null")
                  .mapInArrow(_keyed, "vec_id long, key binary, vec binary, dim int").filter("key is not null"))
    usual = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if usual is None:
        return empty
    rows = rows.filter(F.col("dim") == usual["dim"])
    smallest = Window.partitionBy("key").orderBy("vec_id")
    few = rows.select("key", "vec_id").distinct().withColumn("turn", F.row_number().over(smallest)).filter(F.col("turn") <= nearest + 1)
    heads = rows.join(few.filter("turn = 1").select("key", "vec_id"), ["key", "vec_id"]).dropDuplicates(["key"])
    ids = few.groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # nearest + 1 at most
    nodes = settle(heads.select("key", "vec", F.col("vec_id").alias("least")).join(ids, "key")
                   .withColumn("node", F.monotonically_increasing_id()))
    amount = nodes.count()
    share = int((1 << 30) * min(1.0, 0.98 * sample / max(1, amount)))
    drawn = nodes if amount <= sample else nodes.filter(F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1 << 30)) < share).limit(sample)
    index = fit(unit(scaled(matrix(drawn.select("vec").toPandas()["vec"]))), amount, list_size)
    shared = spark.sparkContext.broadcast(index)

    def post(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = shared.value.lists_of(unit(scaled(matrix(frame["vec"])))) if len(frame) else []
            amounts = [len(c) for c in own]
            at = np.repeat(np.arange(len(frame)), amounts)
            yield frame.iloc[at].assign(list=np.array([c for cs in own for c in cs], dtype=np.int32))

    posted = settle(nodes.select("node", "least", "vec").mapInPandas(post, "node long, least long, vec binary, list int"))
    sizes = posted.groupBy("list").count().toPandas()  # a row for each list: MAX_LISTS at most
    index.sizes = np.zeros(len(index.centroids), dtype=np.int64)
    index.sizes[sizes["list"]] = sizes["count"]
    index.fewest = 2 * (nearest + 1) * REPLICAS
    routing = spark.sparkContext.broadcast(index)
    chunks = np.maximum(1, -(-index.sizes // CHUNK))

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at, lists, parts = [], [], []
            for row, q in enumerate(unit(scaled(matrix(frame["vec"]))) if len(frame) else []):
                for c in routing.value.probes(q):
                    for part in range(chunks[c]):
                        at.append(row)
                        lists.append(c)
                        parts.append(part)
            yield pd.DataFrame({"query": frame["node"].to_numpy()[at], "vec": frame["vec"].to_numpy()[at], "list": np.array(lists, dtype=np.int32),
                                "part": np.array(parts, dtype=np.int32)})

    asked = rows.filter(is_query(F.col("vec_id"))).select("vec_id", "key").distinct()
    wanted = nodes.join(asked.select("key").distinct(), "key", "left_semi").select("node", "vec")
    routed = settle(wanted.repartition(spark.sparkContext.defaultParallelism, "node").mapInPandas(route, "query long, vec binary, list int, part int"))
    # neither the vectors nor the queries of a list meet in one group as a whole: vectors by chunk, queries by block
    crowds = routed.groupBy("list", "part").count().groupBy("list").agg(F.max("count").alias("most")).select("list", F.ceil(F.col("most") / ASKED).cast("int").alias("blocks"))
    blocks = np.ones(len(index.centroids), dtype=np.int64)
    for row in crowds.filter("blocks > 1").collect():  # MAX_LISTS rows at most
        blocks[row["list"]] = row["blocks"]
    cut = np.flatnonzero((chunks > 1) | (blocks > 1))
    long_lists = spark.createDataFrame([(int(c), int(chunks[c]), int(blocks[c])) for c in cut], "list int, chunks int, blocks int")
    dealt = posted.join(long_lists, "list", "left").withColumns(
        {"part": F.pmod(F.xxhash64("node"), F.coalesce("chunks", F.lit(1))).cast("int"),
         "block": F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))}).drop("chunks", "blocks")
    asking = routed.join(long_lists.select("list", "blocks"), "list", "left").withColumn(
        "block", F.pmod(F.xxhash64("query"), F.coalesce("blocks", F.lit(1))).cast("int")).drop("blocks")
    met = asking.groupBy("list", "part", "block").cogroup(dealt.groupBy("list", "part", "block")).applyInPandas(
        _search(nearest + 1), "query long, node long, score double")
    # A node found in several lists counts once; then its ids stand for it.
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = met.distinct().join(nodes.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("vec_id")).withColumn(
        "turn", F.row_number().over(order)).filter(F.col("turn") <= nearest + 1).drop("turn")
    asked = asked.select(F.col("vec_id").alias("query_id"), "key").join(nodes.select("key", F.col("node").alias("query")), "key")
    turn = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.join(found, "query").filter("query_id <> vec_id").withColumn("rank", F.row_number().over(turn))
            .filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score"))

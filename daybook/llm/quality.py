"""Document quality: ridge regression on random Fourier features of text statistics, calibrated by isotonic regression.

The statistics are numbers of a whole text (lengths, shares of kinds of characters, repetition of words, lines and word triples), so
they hold in any language. Their Gaussian kernel is approximated by ``FEATURES`` random cosines; each partition of the labelled rows adds
up its part of the normal equations and the sums are solved once. Labelled rows kept out of that fit calibrate it: their
raw scores are counted in fixed bins and pooled until the share of good documents never falls as the score rises.

The driver receives sums of a fixed size only (the equations and the bins), whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import WordHasher, settle, text_bytes

FEATURES = 256
BANDWIDTH = 3.0
PENALTY = 1e-3  # per labelled row
BINS = 2_000  # of raw scores from -0.5 to 1.5
THRESHOLD = 0.7
CALIBRATION_PART = 4  # one in four training rows calibrates

STATISTICS = ("words", "bytes", "word_length", "upper", "digits", "symbols", "marks", "exclamations", "beyond_ascii", "line_length",
              "distinct_words", "top_word", "equal_neighbours", "repeated_lines", "repeated_triples", "short_words", "stops", "entropy")

_SYMBOLS = [ord(c) for c in "#*$%&|<>"]
_MARKS = [ord(c) for c in ".,;:?'\"()-"]
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def statistics(data: bytes, hasher: WordHasher) -> list[float]:
    """One number per name in STATISTICS; all zero for a text without words."""
    words = hasher.words(data)
    n = words.size
    if not n:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    size = len(data)
    solid = size - kinds[32] - kinds[9:14].sum()
    upper, lower = kinds[65:91].sum(), kinds[97:123].sum()
    amounts = np.unique(words, return_counts=True)[1]
    lines = [line for line in data.split(b"\n") if line.strip()]
    if n > 2:
        triples = words[:-2] * _P + words[1:-1] * _Q + words[2:]
        repeated = 1 - np.unique(triples).size / triples.size
    else:
        repeated = 0.0
    share = kinds[kinds > 0] / size
    return [
        np.log1p(n), np.log1p(size), np.log1p(solid / n), upper / max(1, upper + lower), kinds[48:58].sum() / solid,
        kinds[_SYMBOLS].sum() / solid, kinds[_MARKS].sum() / solid, kinds[33] / solid, kinds[128:].sum() / solid, np.log1p(n / len(lines)),
        amounts.size / n, amounts.max() / n, np.count_nonzero(words[1:] == words[:-1]) / max(1, n - 1), 1 - len(set(lines)) / len(lines), repeated,
        kinds[32] / size, (kinds[46] + kinds[63]) / n, float(-(share * np.log2(share)).sum())]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher(fold=True)
    for batch in batches:
        rows = [statistics(text or b"", hasher) for text in text_bytes(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "stats"])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _statistics, "doc_id long, stats array<double>")


def pool(amounts: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Isotonic fit of good / amounts in order: pooled shares that never fall."""
    blocks: list[list[float]] = []  # share, amount, bins
    for a, g in zip(amounts.tolist(), good.tolist(), strict=True):
        blocks.append([g / a, a, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            share, amount, bins = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + share * amount) / (last[1] + amount)
            last[1] += amount
            last[2] += bins
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


@dataclass
class Model:
    """A fitted scorer; ``edges`` and ``shares`` map raw scores to calibrated ones."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    edges: np.ndarray
    shares: np.ndarray

    def waves(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(4711)
        directions = rng.normal(0, 1 / BANDWIDTH, (stats.shape[1], FEATURES))
        phases = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        angles = np.tile(phases, (len(stats), 1))
        for place, direction in enumerate(directions):
            angles += z[:, place, None] * direction
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(angles), np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        """Sums in a fixed order per row: a matrix product may round equal rows of a batch differently."""
        return np.full(len(stats), 0.5) if self.weights is None else (self.waves(stats) * self.weights).sum(axis=1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = np.clip(self.raw(stats), -0.5, 1.5)
        return np.clip(np.interp(raw, self.edges, self.shares), 0, 1) if self.edges.size else np.clip(raw, 0, 1)


def _matrix(column) -> np.ndarray:
    return np.array(column.to_list(), dtype=np.float64).reshape(-1, len(STATISTICS))


def _equations(model: Model):
    """Each partition's sum of the normal equations, one row per equation."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for frame in frames:
            waves = model.waves(_matrix(frame["stats"]))
            total += np.hstack([waves.T @ waves, (waves.T @ frame["label"].to_numpy())[:, None]])
        if total.any():
            yield pd.DataFrame({"equation": range(FEATURES + 1), "sums": list(total)})

    return run


def _add(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"equation": [key[0]], "sums": [np.sum(np.stack(rows["sums"].to_list()), axis=0)]})


def fit(labelled: DataFrame) -> Model:
    """A model of the rows stats, label, part; rows whose part is 0 calibrate, the others fit. No rows: every score is 0.5."""
    spark = labelled.sparkSession
    rows = settle(labelled.filter("label is not null"))
    at = range(len(STATISTICS))
    first = rows.agg(*[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in at], *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in at],
                     F.count("*").alias("n"), F.count(F.when(F.col("part") != 0, 1)).alias("fitting")).first()
    if not first["fitting"]:
        return Model(np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)), None, np.empty(0), np.empty(0))
    scale = np.array([first[f"s{i}"] for i in at])
    model = Model(np.array([first[f"m{i}"] for i in at]), np.where(scale > 1e-9, scale, 1.0), None, np.empty(0), np.empty(0))
    sums = (rows.filter("part <> 0").select("stats", F.col("label").cast("double").alias("label"))
            .coalesce(max(1, min(64, spark.sparkContext.defaultParallelism)))
            .mapInPandas(_equations(model), "equation int, sums array<double>")
            .groupBy("equation").applyInPandas(_add, "equation int, sums array<double>").toPandas().sort_values("equation"))
    total = np.stack(sums["sums"].to_list())
    penalty = PENALTY * first["fitting"] * np.eye(FEATURES + 1)
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])

    def binned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raw = np.clip(model.raw(_matrix(frame["stats"])), -0.5, 1.5)
            yield pd.DataFrame({"bin": np.minimum((raw + 0.5) * (BINS / 2), BINS - 1).astype(np.int32), "label": frame["label"].to_numpy()})

    calibrating = rows.filter("part = 0") if first["n"] > first["fitting"] else rows
    counted = (calibrating.select("stats", F.col("label").cast("double").alias("label")).mapInPandas(binned, "bin int, label double")
               .groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("good")).toPandas().sort_values("bin"))
    model.shares = pool(counted["n"].to_numpy(dtype=float), counted["good"].to_numpy(dtype=float))
    model.edges = (counted["bin"].to_numpy() + 0.5) * (2 / BINS) - 0.5
    return model


def _labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows: those whose crc32 of the id as text leaves another remainder than 2 when divided by 4."""
    known = (labels.filter("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.avg(F.col("quality").cast("double")).alias("label")))
    return stats.filter(~held_out()).join(known, "doc_id").select(
        "stats", "label", F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION_PART)).alias("part"))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Model]:
    """The settled statistics of all documents, and the model of those that have labels outside the held-out part."""
    stats = settle(document_statistics(docs, id_col, text_col))
    return stats, fit(_labelled(stats, labels))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``.

    Null and blank texts have all statistics zero and get the score of such texts; equal texts get equal scores. A null id is not
    held out and matches no label. Other columns are not read; an empty table gives an empty result. Without any usable label
    every score is 0.5.
    """
    stats, model = trained(docs, labels, id_col, text_col)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": model.score(_matrix(frame["stats"]))})

    found = stats.mapInPandas(score, "doc_id long, score double")
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns as they are; all rows if there is no usable label."""
    model = fit(_labelled(document_statistics(docs.filter(~held_out(id_col)), id_col, text_col), labels))
    if model.weights is None:
        return docs
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(fold=True)
        for batch in batches:
            stats = np.array([statistics(text or b"", hasher) for text in text_bytes(batch.column(at))]).reshape(-1, len(STATISTICS))
            yield batch.filter(pa.array(model.score(stats) >= threshold))

    return docs.mapInArrow(keep, docs.schema)

"""Toxicity of documents by a factorization machine over hashed terms.

A document's terms are the hashes of its distinct words and of their beginnings (inflected forms share those), in a fixed number of
slots. From a sample of the labelled rows, whose size is bounded, the machine learns a weight and a short vector for every slot that
enough documents hold, so that a pair of terms counts by the product of their vectors: an insult together with the mention of a group
can weigh more than the two apart, which additive weights cannot say. What a slot tells by itself does not decide whether it is learned,
only how fast: rare terms spread evenly over the classes move slowly, or they would learn single documents by heart. Scoring reads
every whole text once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from daybook.llm.common import settle, WordHasher, text_bytes

TRAIN_ROWS = 20_000  # labelled rows that are learned from at most
TRAIN_BYTES = 256 << 20  # and their slots together: a very long text holds up to 1 MB of them
SLOT_BITS = 18  # terms are hashed into so many bits
SUPPORT = 3  # documents that hold a learned slot at least
EVIDENCE = 25.0  # chi-square from which a slot learns at full rate
COMMON = 0.05  # share of the documents from which a slot is common
LEAST = 0.3  # rate of a common slot without evidence of its own
BEGINNINGS = (4, 5, 6)
FACTORS = 8
STEPS, BATCH, RATE, DECAY = 240, 512, 0.03, 0.2  # the decay is for the sum over all documents
LEAD = 3  # rate of the weights against that of the vectors: pairs explain what single terms leave over
THRESHOLD = 0.5
SLICE = 64  # documents scored at once


def terms_of(data: bytes, hasher: WordHasher) -> np.ndarray:
    """Sorted distinct 31-bit term hashes."""
    return np.unique((hasher.words(data, BEGINNINGS) >> np.uint64(33)).astype(np.int32))


def slots_of(data: bytes, hasher: WordHasher) -> np.ndarray:
    """Sorted distinct slots of the terms."""
    return np.unique(terms_of(data, hasher) >> (31 - SLOT_BITS))


def hasher() -> WordHasher:
    return WordHasher(fold=True, letters=True)


@dataclass
class Machine:
    """logit = bias + sum of weights + sum over pairs of products of vectors, over the chosen terms of a document."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Which chosen terms are among the sorted ``terms``."""
        if not self.terms.size:
            return np.empty(0, dtype=np.int64)
        at = np.searchsorted(self.terms, terms)
        at[at == self.terms.size] = 0
        return at[self.terms[at] == terms]

    def logits(self, starts: np.ndarray, places: np.ndarray) -> np.ndarray:
        """``places`` of all documents one after the other, each beginning at its start."""
        plain, summed, squared = (segment_sums(x, starts) for x in
                                  (self.weights[places], self.vectors[places], self.vectors[places] ** 2))
        return self.bias + plain + 0.5 * (summed ** 2 - squared).sum(axis=1)

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        scores = [np.empty(0)]
        for low in range(0, len(rows), SLICE):
            held = [self.places(r) for r in rows[low:low + SLICE]]
            starts = np.cumsum([0, *[h.size for h in held]])[:-1]
            scores.append(sigmoid(self.logits(starts, np.concatenate(held))))
        return np.concatenate(scores)


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs of ``values`` that begin at ``starts``; empty runs give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    ends = np.r_[starts[1:], len(values)]
    return total[ends] - total[starts]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def rates(rows: list[np.ndarray], size: int, labels: np.ndarray) -> np.ndarray:
    """Share of the full rate at which each slot learns: 1 with evidence of its own, else by how common it is."""
    n, toxic = len(labels), labels.sum()
    held, bad = np.zeros(size), np.zeros(size)
    for row, label in zip(rows, labels, strict=True):  # a row's places are distinct
        held[row] += 1
        bad[row] += label
    gap, spread = bad * n - held * toxic, toxic * (n - toxic) * held * (n - held)
    evidence = np.divide(gap * gap * n, spread, out=np.zeros(size), where=spread > 0)
    return np.maximum(np.minimum(1, evidence / EVIDENCE), LEAST ** 0.5 * np.minimum(1, held / (COMMON * n))) ** 2


def learn(terms: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, seed: int = 13) -> Machine:
    """Logistic loss by Adam over shuffled batches; ``rows`` hold places in ``terms``."""
    rng = np.random.default_rng(seed)
    n, size = len(rows), terms.size
    share = (labels.sum() + 1) / (n + 2)
    machine = Machine(terms, float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, FACTORS)))
    if not size or not n:
        return machine
    amounts = np.array([r.size for r in rows])
    scale = rates(rows, size, labels).astype(np.float32) * np.array([[LEAD], *[[1]] * FACTORS], dtype=np.float32)
    # a row for the weights, then one for each factor; the products over all pairs of a document begin near 0
    learned = np.zeros((1 + FACTORS, size), dtype=np.float32)
    learned[1:] = rng.normal(0, min(0.05, (0.05 * n / max(1, amounts.sum())) ** 0.5), (FACTORS, size)) * scale[1:]
    mean, square, slopes = np.zeros_like(learned), np.zeros_like(learned), np.zeros_like(learned)
    bias_moments, order = [0.0, 0.0], np.empty(0, dtype=np.int64)
    for step in range(1, STEPS + 1):
        rate = RATE * (1 - (step - 1) / STEPS)
        if not order.size:
            order = rng.permutation(n)
        batch, order = order[:BATCH], order[BATCH:]
        many = amounts[batch]
        starts = np.cumsum(np.r_[0, many])[:-1]
        places = np.concatenate([rows[i] for i in batch])
        values = [row[places] for row in learned]
        sums = [segment_sums(v, starts) for v in values]
        pairs = sum(t ** 2 - segment_sums(v ** 2, starts) for t, v in zip(sums[1:], values[1:], strict=True))
        error = (sigmoid(machine.bias + sums[0] + 0.5 * pairs) - labels[batch]) / len(batch)
        plain = np.bincount(places, np.repeat(error, many), size)
        slopes[0] = plain
        for k in range(1, 1 + FACTORS):
            slopes[k] = np.bincount(places, np.repeat(error * sums[k], many), size) - plain * learned[k]
        slopes += DECAY / n * learned
        mean += 0.1 * (slopes - mean)
        square += 0.001 * (slopes ** 2 - square)
        learned -= (rate / (1 - 0.9 ** step)) * scale * mean / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        bias_moments[0] += 0.1 * (error.sum() - bias_moments[0])
        bias_moments[1] += 0.001 * (error.sum() ** 2 - bias_moments[1])
        machine.bias -= rate * (bias_moments[0] / (1 - 0.9 ** step)) / (np.sqrt(bias_moments[1] / (1 - 0.999 ** step)) + 1e-8)
    machine.weights, machine.vectors = learned[0].astype(np.float64), learned[1:].T.astype(np.float64)
    return machine


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_labels(labels: DataFrame, rows: int = TRAIN_ROWS) -> pd.DataFrame:
    """doc_id and toxic (the larger, if a document has several) of at most ``rows`` labelled documents outside the held-out part."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")).filter(~held_out())
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).toPandas()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Machine:
    spark = docs.sparkSession
    drawn = training_labels(labels, rows)
    none = np.empty(0, dtype=np.int32)
    if drawn.empty:
        return Machine(none, 0.0, np.empty(0), np.empty((0, FACTORS)))
    known = F.broadcast(spark.createDataFrame(drawn, "doc_id long, toxic int"))  # TRAIN_ROWS rows of two numbers

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = hasher()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3),
                 pa.array([slots_of(text or b"", own).tobytes() for text in text_bytes(batch.column(2))], pa.binary())],
                names=["doc_id", "toxic", "hash", "slots"])

    # only the texts of the drawn documents leave the JVM
    labelled_docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(known, "doc_id").select(
        "doc_id", "toxic", "text", F.xxhash64("text").alias("hash"))
    train = labelled_docs.mapInArrow(read, "doc_id long, toxic int, hash long, slots binary")
    # rows that repeat an id are one document: the text of the least hash
    one = settle(train.groupBy("doc_id").agg(F.min(F.struct("hash", "slots", "toxic")).alias("row")).select("doc_id", "row.toxic", "row.slots"))
    # in the order they were drawn in, as many as TRAIN_BYTES hold: a sum over TRAIN_ROWS rows at most
    upto = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    fits = one.select("doc_id", F.sum(F.octet_length("slots")).over(upto).alias("bytes")).filter(F.col("bytes") <= TRAIN_BYTES)
    held = one.join(F.broadcast(fits.select("doc_id")), "doc_id", "left_semi").select("toxic", "slots").toPandas()
    labelled, toxic = len(held), int(held["toxic"].sum())
    if not 0 < toxic < labelled:
        return Machine(none, 40.0 if toxic else -40.0 if labelled else 0.0, np.empty(0), np.empty((0, FACTORS)))
    held = held.sort_values(["toxic", "slots"])  # whatever order the tasks ended in
    rows_of = [np.frombuffer(r, dtype=np.int32) for r in held["slots"]]
    holders = np.zeros(1 << SLOT_BITS, dtype=np.int32)
    for row in rows_of:
        holders[row] += 1
    machine = Machine(np.flatnonzero(holders >= SUPPORT).astype(np.int32), 0.0, np.empty(0), np.empty((0, FACTORS)))
    return learn(machine.terms, [machine.places(r).astype(np.int32) for r in rows_of], held["toxic"].to_numpy(dtype=np.float64))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
           rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``.

    Null and blank texts hold no terms and get the machine's bias; equal texts get equal scores. A null id is not held out and
    matches no label. Other columns are not read; an empty table gives an empty result. Without labels every score is 0.5.
    """
    machine = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = hasher()
        for batch in batches:
            scores = machine.value.score([slots_of(text or b"", own) for text in text_bytes(batch.column(1))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(score, "doc_id long, score double")
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

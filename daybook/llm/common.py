"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from daybook.operators.staging import materialise as settle  # written once below spark.checkpoint.dir and read back

__all__ = ["settle", "importable", "table", "text_bytes", "tokenizer_path", "byte_spelling", "mix64", "WordHasher"]


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies, if the session was not started with it on their path.

    On a cluster whose executors do not see that folder the package is shipped with the job, as any other.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the package that names it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_bytes(column) -> list:
    """UTF-8 bytes (or None) of an Arrow text column."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


def byte_spelling() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself, others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of the white-space separated words of a text, computed for all bytes at once.

    A word's hash is the sum of ``value[byte] * BASE**place`` over its bytes, taken from one running sum and moved back to
    place 0 with the inverse power, then mixed. With ``fold`` A-Z hash as a-z. White space is space and \\x09-\\x0D; with
    ``letters`` every other byte than an ASCII letter or a part of a longer character ends a word too.
    """

    BASE = 0x9E3779B97F4A7C13  # 3 modulo 8: powers stay far apart in every bit
    SPAN = 1 << 19  # bytes hashed at once; longer texts are cut at white space

    def __init__(self, fold: bool, letters: bool = False, seed: int = 20240607):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if fold:
            self.values[65:91] = self.values[97:123]
        self.space = np.zeros(256, dtype=bool)
        self.space[[32, *range(9, 14)]] = True
        if letters:
            self.space[:128] = True
            self.space[65:91] = self.space[97:123] = False
        self._grow(self.SPAN + 1)

    def _grow(self, size: int) -> None:
        base = self.BASE
        inverse = pow(base, -1, 1 << 64)
        self.powers = np.cumprod(np.r_[np.uint64(1), np.full(size, base, dtype=np.uint64)])
        self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(size, inverse, dtype=np.uint64)])

    def _part(self, data: np.ndarray, widths: tuple[int, ...] = ()) -> np.ndarray:
        if data.size >= self.powers.size:  # one word longer than SPAN
            self._grow(data.size + 1)
        gap = self.space[data]
        edge = np.flatnonzero(np.diff(np.r_[True, gap, True]))
        starts, ends = edge[0::2], edge[1::2]
        if not starts.size:
            return np.empty(0, dtype=np.uint64)
        total = np.cumsum(self.values[data] * self.powers[:data.size])
        total = np.r_[np.uint64(0), total]
        hashes = [mix64((total[ends] - total[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))]
        for width in widths:
            longer = ends - starts > width
            first = starts[longer]
            hashes.append(mix64((total[first + width] - total[first]) * self.inverses[first] + np.uint64(width << 32)))
        return np.concatenate(hashes) if widths else hashes[0]

    def words(self, data: bytes, widths: tuple[int, ...] = ()) -> np.ndarray:
        """Hashes of the words of one text, in order; with ``widths`` also, in any order, of the beginnings of longer words."""
        view = np.frombuffer(data, dtype=np.uint8)
        if view.size <= self.SPAN:
            return self._part(view, widths)
        parts, at = [], 0
        while at < view.size:
            end = min(at + self.SPAN, view.size)
            if end < view.size:
                back = np.flatnonzero(self.space[view[at:end]])
                if back.size:
                    end = at + int(back[-1]) + 1
                else:
                    ahead = np.flatnonzero(self.space[view[end:]])
                    end = end + int(ahead[0]) + 1 if ahead.size else view.size
            parts.append(self._part(view[at:end], widths))
            at = end
        return np.concatenate(parts)

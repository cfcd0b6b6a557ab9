"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

A document's set holds its distinct shingles of five words; the signature holds, per coordinate, the least of one hash over the set.
Two sets of similarity J agree on each coordinate with probability J, so sets to be linked agree on at least ``matches`` of
``COORDINATES`` but for one pair in some millions (38 of 64 at similarity 0.85, see ``matches_for``). The join finds those pairs:

* every coordinate-value pair is a posting list. Values that one set alone holds join nothing and are skipped, and so is a set that
  shares fewer values with others than a link needs;
* prefix merging: of a set's shared values, rarest first, all but the ``matches - 1`` most frequent are posted. Two sets with
  ``matches`` equal coordinates still meet, while values of passages that very many documents hold stay out;
* skip merging: lists are split by set size, so that sets whose sizes alone rule out a link never meet, and the members of a list
  meet its centre, the set with the most widely shared values, before they meet each other. What is linked by then skips the rest
  of its list. Members still apart need not all meet either: a pair must also share one of its rarest shingles, early enough in both
  sets to leave room for the overlap that a link needs;
* collisions of a met pair are counted over the whole signature, pairs below ``matches`` go, the others are confirmed on full sets.

Equal sets are one node from the start, so a group of exact copies costs as much as one document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import WordHasher, mix64, settle, text_bytes

WIDTH = 5  # words in a shingle
COORDINATES = 64
MISSES = 2e-7  # share of pairs right at the threshold that may agree on too few coordinates
BLOCK = 2048  # shingles hashed at once
FILTER_WORDS = 1 << 17  # 64-bit words of the membership filter: 1 MB at most, whatever the input

_rng = np.random.Generator(np.random.PCG64(271828))
_PLACE = _rng.integers(1, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def matches_for(percent: int) -> int:
    """Most coordinates to ask for such that at most MISSES of the pairs with that similarity agree on fewer."""
    missed, t = 0.0, percent / 100
    for k in range(COORDINATES):
        missed += math.comb(COORDINATES, k) * t**k * (1 - t) ** (COORDINATES - k)
        if missed > MISSES:
            return max(1, k)
    return COORDINATES


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a word sequence; fewer than five words are one shingle, none are none."""
    n = words.size
    if not n:
        return words
    width = min(n, WIDTH)
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total += words[k:n - width + 1 + k] * _PLACE[k]
    return np.unique(mix64(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    least = None
    for at in range(0, shingles.size, BLOCK):
        part = (shingles[at:at + BLOCK, None] * _FACTOR + _SHIFT).min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    hasher = WordHasher(fold=True)
    for batch in batches:
        sizes, keys, signatures = [], [], []
        for text in text_bytes(batch.column(1)):
            found = shingle_set(hasher.words(text or b""))
            sizes.append(found.size)
            keys.append(xxhash.xxh3_128_digest(found.tobytes()) if found.size else None)
            signatures.append(signature(found) if found.size else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.list_(pa.int32())),
             batch.column(2)], names=["doc", "n", "set_key", "sig", "text_key"])


def _in_filter(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Shingles of the documents whose ids the filter may hold."""
    import xxhash

    hasher = WordHasher(fold=True)
    for batch in batches:
        slot = np.asarray(batch.column(2))
        batch = batch.filter(pa.array((bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1))
        keys, sets = [], []
        for text in text_bytes(batch.column(1)):
            found = shingle_set(hasher.words(text or b""))
            keys.append(xxhash.xxh3_128_digest(found.tobytes()) if found.size else None)
            sets.append(found.view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                                         names=["doc", "set_key", "shingles"])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, n (set size), set_key (128-bit hash of the set, null if empty), sig and text_key (hash of the text) per document."""
    return (docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
            .mapInArrow(_sketch, "doc long, n long, set_key binary, sig array<int>, text_key long"))


def _postings(sets: DataFrame, matches: int) -> DataFrame:
    """node, key, weight: the prefix of every set that shares enough coordinate values, and how widely its values are shared."""
    coordinate = sets.select("node", F.posexplode("sig").alias("place", "value")).select(
        "node", ((F.col("place").cast("long") * (1 << 32)) + (F.col("value").cast("long") + (1 << 31))).alias("key"))
    shared = coordinate.groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    held = (coordinate.join(shared, "key").groupBy("node").agg(F.collect_list(F.struct("df", "key")).alias("held"))
            .filter(F.size("held") >= matches))
    prefix = F.slice(F.sort_array("held"), F.lit(1), F.size("held") - (matches - 1))
    weight = F.aggregate("held.df", F.lit(0).cast("long"), lambda total, df: total + df)
    return held.select("node", weight.alias("weight"), F.explode(prefix).alias("p")).select("node", "weight", "p.key")


def _cells(threshold: float):
    step = math.log(1 / threshold)
    bucket = F.floor(F.log(F.col("n")) / F.lit(step) + F.lit(1e-9)).cast("int")
    return F.explode(F.array(bucket, bucket + 1))


def _agreeing(pairs: DataFrame, sets: DataFrame, matches: int) -> DataFrame:
    """Pairs a, b whose signatures agree on enough coordinates."""
    left = sets.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    right = sets.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
    count = "aggregate(zip_with(sig_a, sig_b, (x, y) -> if(x = y, 1, 0)), 0, (s, x) -> s + x)"
    return pairs.join(left, "a").join(right, "b").filter(F.expr(f"{count} >= {matches}")).select("a", "b")


def _confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union on the full sets."""
    left = full.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = full.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    return (pairs.join(left, "a").join(right, "b").withColumn("both", both)
            .filter(100 * F.col("both") >= percent * (F.size("set_a") + F.size("set_b") - F.col("both"))).select("a", "b"))


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node, shingles of the wanted sets (node, doc, set_key), made again from one document of each.

    A filter of fixed size spares most of the other documents; the join after it is exact.
    """
    slot = F.pmod(F.xxhash64(F.coalesce(F.col("doc"), F.lit(-1))), F.lit(FILTER_WORDS * 64))
    words = (wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toPandas())
    bits = np.zeros(FILTER_WORDS, dtype=np.uint64)
    bits[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    found = (docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).withColumn("slot", slot)
             .mapInArrow(lambda batches: _in_filter(batches, shared.value), "doc long, set_key binary, shingles array<long>"))
    found = found.withColumnRenamed("set_key", "own_key").withColumnRenamed("doc", "own_doc")
    return (wanted.join(found, F.col("doc").eqNullSafe(F.col("own_doc")) & (F.col("set_key") == F.col("own_key")))
            .select("node", "shingles"))


def _meeting(apart: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of different components among ``apart`` (node, n, comp) that share a shingle early enough in both sets.

    Shingles are taken rarest first. If the first shared one has ``pos`` others before it, the overlap is at most n - pos. Every pair
    has a larger set a (of equal ones the lesser node) and a smaller one b. The overlap that b needs grows with the size of a, so b
    posts only the shingles that leave room for the overlap with a set of its own size: about half of what a looks up. Letters of one
    form that differ in more than that share no posted shingle and do not meet at all.
    """
    shingle = apart.join(full, "node").select("node", "n", "comp", F.explode("shingles").alias("x"))
    shared = shingle.groupBy("x").agg(F.count("*").alias("df")).filter("df > 1")
    held = shingle.join(shared, "x").groupBy("node", "n", "comp").agg(F.sort_array(F.collect_list(F.struct("df", "x"))).alias("held"))
    early = f"""filter(transform(held, (h, i) -> named_struct('x', h.x, 'pos', n - size(held) + i)), q -> 100 * (n - q.pos) >= {percent} * n)"""
    prefix = held.select("node", "n", "comp", F.explode(F.expr(early)).alias("q")).select(
        F.col("q.x").alias("x"), (F.col("n") - F.col("q.pos")).alias("room"), "node", "n", "comp")
    left = prefix.select("x", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("comp").alias("comp_a"), F.col("room").alias("room_a"))
    right = prefix.filter(f"{100 + percent} * room >= {percent} * 2 * n").select(
        "x", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("comp").alias("comp_b"), F.col("room").alias("room_b"))
    return left.join(right, "x").filter(
        f"(n_a > n_b or (n_a = n_b and a < b)) and comp_a <> comp_b and {100 + percent} * least(room_a, room_b) >= {percent} * (n_a + n_b)")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, comp: the least node reachable over the edges (a, b), itself included.

    Each round hangs every node below its least neighbour, shortens the chains once and joins edges on what remains, until no
    edge is left. Stars take one round; the rounds grow with the logarithm of the longest path.
    """
    labels = nodes.select("node", F.col("node").alias("comp"))
    edges = settle(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    while not edges.isEmpty():
        up = edges.select(F.col("b").alias("x"), F.col("a").alias("y"))
        parent = settle(up.groupBy("x").agg(F.min("y").alias("up")))
        over = parent.select(F.col("x").alias("up"), F.col("up").alias("upper"))
        parent = settle(parent.join(over, "up", "left").select("x", F.coalesce("upper", "up").alias("up")))
        labels = settle(labels.join(parent.withColumnRenamed("x", "comp"), "comp", "left")
                        .select("node", F.coalesce("up", "comp").alias("comp")))
        for end in ("a", "b"):
            edges = (edges.join(parent.withColumnRenamed("x", end), end, "left")
                     .withColumn(end, F.coalesce("up", end)).drop("up"))
        edges = settle(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs``.

    Words are runs of other bytes than space and \\x09-\\x0D with A-Z lower-cased. Null and blank texts have an empty set, are linked
    with nothing and are their own component. Equal texts are linked however short. Rows that repeat a doc_id get equal rows; a
    null doc_id takes part in linking, but a component takes its name from the least id that is not null. Other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """
    return _judged(docs, id_col, text_col, percent).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
        F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"))


def _judged(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """doc, n, text_key, comp, component_id per row; comp names the component even where two go by the same id, null for empty sets."""
    if not 0 < percent <= 100:
        raise ValueError("percent lies above 0 and up to 100")
    matches = matches_for(percent)
    rows = settle(sketches(docs, id_col, text_col))
    sets = settle(rows.filter("set_key is not null").groupBy("set_key")
                  .agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("sig").alias("sig"))
                  .withColumn("node", F.monotonically_increasing_id()))
    brief = sets.select("node", "n")
    posted = settle(_postings(sets, matches).join(brief, "node")
                    .select("node", "n", "weight", "key", _cells(percent / 100).alias("cell")))

    def alike(pairs: DataFrame) -> DataFrame:
        sized = F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        return pairs.filter(sized).select("a", "b").distinct()

    lists = posted.groupBy("key", "cell").agg(F.max(F.struct("weight", "node", "n")).alias("centre"), F.count("*").alias("members")).filter(
        "members > 1").select("key", "cell", F.col("centre.node").alias("b"), F.col("centre.n").alias("n_b"))
    stars = posted.select("key", "cell", F.col("node").alias("a"), F.col("n").alias("n_a")).join(lists, ["key", "cell"])
    met = posted.join(lists.select("key", "cell"), ["key", "cell"], "left_semi").select("node").distinct()
    full = settle(_full_sets(docs, met.join(sets.select("node", "doc", "set_key"), "node"), id_col, text_col))
    links = settle(_confirmed(_agreeing(alike(stars.filter("a <> b")), sets, matches), full, percent))
    labels = components(brief.select("node"), links)

    # Members of a list that its centre has not joined meet each other.
    sided = posted.join(labels, "node").select("key", "cell", "node", "n", "comp")
    mixed = sided.groupBy("key", "cell").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    apart = settle(sided.join(mixed.select("key", "cell"), ["key", "cell"], "left_semi").select("node", "n", "comp").distinct())
    more = settle(_confirmed(_agreeing(alike(_meeting(apart, full, percent)), sets, matches), full, percent))
    if not more.isEmpty():
        ends = labels.withColumnRenamed("node", "a").withColumnRenamed("comp", "x")
        other = labels.withColumnRenamed("node", "b").withColumnRenamed("comp", "y")
        merged = more.join(ends, "a").join(other, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        joined = components(labels.select(F.col("comp").alias("node")).distinct(), merged)
        labels = labels.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("root")), "comp").select(
            "node", F.col("root").alias("comp"))

    named = labels.join(sets.select("node", "set_key", "doc"), "node")
    names = named.groupBy("comp").agg(F.min("doc").alias("component"))
    of_set = settle(named.join(names, "comp").select("set_key", "comp", "component"))
    return rows.select("doc", "n", "text_key", "set_key").join(of_set, "set_key", "left").select(
        "doc", "n", "text_key", "comp",
        F.when(F.col("set_key").isNull(), F.col("doc")).otherwise(F.col("component")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One document of each group of near-duplicates, in the columns of ``docs``: the least id, and of its texts that of the least hash.

    Each row is judged by its own text: rows that share an id but belong to different groups stay, one of each group. Empty texts of
    one id are one document, of which one row stays, as of rows that repeat id and text. Rows without an id cannot be chosen by it and
    all stay. An empty table gives an empty result.
    """
    key = "text_key"
    while key.lower() in {name.lower() for name in docs.columns}:
        key += "_"
    named = docs.filter(F.col(id_col).isNotNull())
    kept = (_judged(named, id_col, text_col, percent).filter("doc = component_id").groupBy("doc", "comp")
            .agg(F.min("text_key").alias(key)).select(F.col("doc").alias(id_col), key))
    return (named.withColumn(key, F.xxhash64(text_col)).join(kept, [id_col, key], "left_semi").dropDuplicates([id_col, key])
            .select(docs.columns).unionByName(docs.filter(F.col(id_col).isNull())))

"""Near-duplicate documents by DartMinHash: weighted signatures, banded join, exact similarity, components.

A text's elements are its distinct shingles of five words (fewer words: one shingle of them all). Two texts are linked if
their weighted Jaccard similarity, the sum of the smaller weights over the sum of the larger, is 0.8 or more; classes are the
connected components of the links. Weights are 1 each, or with ``weights="count"`` the number of occurrences; the latter
links unlike texts that repeat the same line very often, and is therefore not the default.

Signature. An element's weight axis is cut into strips [0,1), [1,2), [2,4), ...; into each strip hashed darts are thrown
in order of rank, a Poisson process of the strip's width, the same for every text. A dart hits if it lies below the
element's weight. Ranks are followed as far as about k ln k + 2k darts hit, further where a coordinate got none; each
coordinate keeps its earliest dart. Two texts agree in a coordinate with a probability of their similarity. The work is
one hash per element and one per dart.

Join. Equal texts are one node. Nodes that agree in a band of coordinates share a bucket; with 20 bands of 4 a pair of
similarity 0.8 meets with probability 0.99997. Within a bucket every node is compared with the smallest one, exactly. Where a
bucket then holds several components, its nodes are three times more compared with another of its nodes, drawn by hash. The
nodes of buckets that still do are joined exactly: two linked sets share an element of both their prefixes, the rarest
elements (a ninth of the lighter set's weight, a fifth of the heavier's), so only pairs of unlike components that do so are compared.
Where an element is shared by more than a few nodes, their sketches are compared first: a byte for each of as many places as
the set has weight, so that the places that differ are at most the weight that does. Of pairs alike by 0.5 to 0.7, which a large
group of near copies has very many of, few get through, and none that is linked is left out. The look itself is still at all pairs
that share such an element: nothing separates these pairs from linked ones by key. No pair that meets in a bucket is missed, a group of thousands of copies takes a few comparisons per node and bucket, and a text with
many words of its own, whose prefix nobody shares, takes none.
Nothing is sampled or capped. Signatures and comparisons run in numpy per task; hot buckets and nodes are partial minima
before the shuffle, and the joins back to them are left to adaptive execution to split.

Null texts are a class each; texts without words are in a class with their equals only. Repeated rows are in one class.
Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import fresh, small_enough, stored, words
from eventmart.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
ROUNDS = 3  # further comparisons of each node with one other per bucket
_TEXTS = 128  # texts whose darts are thrown together
_BROADCAST_NODES = 1_000_000  # about 50 bytes each
_FEW = 32  # nodes that share an element and are compared without a look at their sketches


# --- signatures ----------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, weights: str = "one") -> tuple[np.ndarray, np.ndarray]:
    """Elements of a text from the hashes of its words, in ascending order, and their weights."""
    size = min(SHINGLE, len(hashes))
    if not size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - size + 1 + i]
    elements, counts = np.unique(_mix(total), return_counts=True)
    return elements, counts if weights == "count" else np.ones(len(elements), np.int64)


def signatures(elements: list[np.ndarray], weights: list[np.ndarray], k: int) -> np.ndarray:
    """One row of ``k`` dart names per weighted set; no set may be empty. Weights are positive numbers."""
    out = np.zeros((len(elements), k), np.uint64)
    reach = (k * math.log(k) + 2 * k) / np.array([w.sum() for w in weights])
    todo = np.arange(len(elements))
    while len(todo):
        found = _throw([elements[i] for i in todo], [weights[i] for i in todo], reach[todo], k)
        full = found[1].all(axis=1)
        out[todo[full]] = found[0][full]
        todo = todo[~full]
        reach[todo] *= 2
    return out


def _throw(elements: list[np.ndarray], weights: list[np.ndarray], reach: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per set and coordinate, the name of the earliest dart of a rank within reach, and whether there is one."""
    owner = np.repeat(np.arange(len(elements)), [len(e) for e in elements])
    element, weight = np.concatenate(elements), np.concatenate(weights).astype(np.float64)
    slots, ranks, names = [], [], []
    low, width, strip = 0.0, 1.0, 0
    while len(element):
        state = _mix(element + np.uint64(strip * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        rank, own, top = np.zeros(len(element)), owner, weight
        while len(state):
            state = _mix(state + np.uint64(0x9E3779B97F4A7C15))
            rank = rank - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
            near = rank <= reach[own]
            state, rank, own, top = state[near], rank[near], own[near], top[near]
            place = _mix(state ^ np.uint64(0xA0761D6478BD642F))
            hit = low + (place >> np.uint64(11)).astype(np.float64) * (2.0**-53 * width) < top
            slots.append(own[hit] * k + (_mix(place[hit] ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(k)).astype(np.int64))
            ranks.append(rank[hit])
            names.append(state[hit])
        low, width, strip = low + width, max(low + width, 1.0), strip + 1
        more = weight > low
        element, weight, owner = element[more], weight[more], owner[more]
    slot, rank, name = map(np.concatenate, (slots, ranks, names))
    latest_first = np.argsort(-rank, kind="stable")
    dart, thrown = np.zeros(len(elements) * k, np.uint64), np.zeros(len(elements) * k, bool)
    dart[slot[latest_first]] = name[latest_first]  # of several darts the earliest is written last
    thrown[slot] = True
    return dart.reshape(-1, k), thrown.reshape(-1, k)


def sketch(elements: np.ndarray, weights: np.ndarray, places: int) -> np.ndarray:
    """A set's elements and weights, dealt to so many places, a power of two from 16, of a byte each; eight places are a number.

    The byte is the exclusive or of hashes, so sets that differ in m elements or weights differ in at most m places, and half
    as many places are the exclusive or of both halves.
    """
    hashed = _mix(elements ^ np.uint64(0xE7037ED1A0B428DB)) + weights.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    hashed = _mix(hashed)
    out = np.zeros(places, np.uint8)
    at = _mix(elements) & np.uint64(places - 1)
    np.bitwise_xor.at(out, at.astype(np.int64), (hashed >> np.uint64(32)).astype(np.uint8))
    return out.view("<i8")


def bands(signature: np.ndarray, n: int, rows: int) -> np.ndarray:
    """A number for each band of each signature."""
    parts = signature.reshape(len(signature), n, rows)
    total = np.zeros((len(signature), n), np.uint64) + np.arange(1, n + 1, dtype=np.uint64)
    for i in range(rows):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return total.astype(np.int64)


# --- on Spark ------------------------------------------------------------------------------------


def node_of(text: Column) -> Column:
    """What equal texts share."""
    return F.md5(text)


def _hashed(documents: DataFrame) -> DataFrame:
    """node and the hashes of the text's words."""
    found = documents.where(F.col("text").isNotNull()).select(node_of(F.col("text")).alias("node"), words(F.col("text")).alias("w"))
    return found.select("node", F.transform("w", lambda w: F.xxhash64(w)).alias("hashes"))


def _lists(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    column = batch.column("hashes")
    values, offsets = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
    return (values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True))


def _buckets(documents: DataFrame, weights: str) -> DataFrame:
    """Bands of every node with words: node, bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(at, _TEXTS)
                made = [shingles(h, weights) for h in _lists(part)]
                with_words = [i for i, (e, _) in enumerate(made) if len(e)]
                if with_words:
                    sets = [made[i] for i in with_words]
                    keys = bands(signatures([e for e, _ in sets], [w for _, w in sets], BANDS * ROWS), BANDS, ROWS)
                    nodes = part.column("node").take(pa.array(with_words))
                    flat = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * BANDS, pa.array(keys.ravel()))
                    yield pa.RecordBatch.from_arrays([nodes, flat], ["node", "bands"])

    return _hashed(documents).mapInArrow(run, "node string, bands array<long>").dropDuplicates(["node"])


def _elements(documents: DataFrame, nodes: DataFrame, weights: str) -> DataFrame:
    """Elements and weights of the given nodes, as bytes; no weights if all are 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(at, _TEXTS)
                made = [shingles(h, weights) for h in _lists(part)]
                plain = [b"" if (w == 1).all() else w.astype("<i4").tobytes() for _, w in made]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array([e.tobytes() for e, _ in made], pa.binary()), pa.array(plain, pa.binary())],
                    ["node", "elements", "weights"],
                )

    texts = documents.where(F.col("text").isNotNull()).select("text", node_of(F.col("text")).alias("node"))
    found = _hashed(texts.join(small_enough(nodes, _BROADCAST_NODES), "node", "left_semi").select("text"))
    return found.mapInArrow(run, "node string, elements binary, weights binary").dropDuplicates(["node"])


def _read(e: bytes, w: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Elements and weights from their bytes."""
    ids = np.frombuffer(e, np.uint64)
    return ids, np.frombuffer(w, "<i4").astype(np.int64) if w else np.ones(len(ids), np.int64)


def _sketched(elements: DataFrame) -> DataFrame:
    """Per node: a sketch of as many places as the total weight, up to twice that, and the same folded to half of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = []
            for e, w in zip(batch["elements"], batch["weights"], strict=True):
                ids, weight = _read(e, w)
                whole.append(sketch(ids, weight, max(16, 1 << (int(weight.sum()) - 1).bit_length())))
            halves = [x[: len(x) // 2] ^ x[len(x) // 2 :] for x in whole]
            yield pd.DataFrame({"node": batch["node"], "sketch": whole, "folded": halves})

    return elements.select("node", "elements", "weights").mapInPandas(run, "node string, sketch array<long>, folded array<long>")


def _places(a: Column, b: Column) -> Column:
    """In how many places two sketches of one size differ."""

    def differing(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        for by in (4, 2, 1):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, by))
        return F.bit_count(bits.bitwiseAND(F.lit(0x0101010101010101)))

    return F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda total, n: total + n)


def _can_link(a: str, b: str) -> Column:
    """Whether two sets of near sizes may be alike enough, by columns total, sketch and folded with ``a`` and ``b`` after their names.

    Linked sets differ by at most a ninth of their weights, and each place where sketches differ is a weight of 1 at least.
    """
    (total_a, sketch_a, folded_a), (total_b, sketch_b, folded_b) = (
        [F.col(name + end) for name in ("total", "sketch", "folded")] for end in (a, b)
    )
    most = (total_a + total_b) * ((1 - SIMILARITY) / (1 + SIMILARITY)) + 1e-6
    less_a, less_b = F.size(sketch_a) < F.size(sketch_b), F.size(sketch_b) < F.size(sketch_a)
    return _places(F.when(less_b, folded_a).otherwise(sketch_a), F.when(less_a, folded_b).otherwise(sketch_b)) <= most


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sets of ascending elements."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = np.minimum(wa[i], wb[j]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared))


def _compared(pairs: DataFrame, elements: DataFrame) -> DataFrame:
    """Pairs (a, b, ...) with their similarity."""

    @F.pandas_udf("double")
    def compare(ea: pd.Series, wa: pd.Series, eb: pd.Series, wb: pd.Series) -> pd.Series:
        return pd.Series([similarity(*_read(*x[:2]), *_read(*x[2:])) for x in zip(ea, wa, eb, wb, strict=True)], dtype=float)

    def side(name: str) -> DataFrame:
        return elements.select(F.col("node").alias(name), F.col("elements").alias(f"e{name}"), F.col("weights").alias(f"w{name}"))

    read = pairs.join(side("a"), "a").join(side("b"), "b")
    return read.withColumn("similarity", compare("ea", "wa", "eb", "wb")).drop("ea", "wa", "eb", "wb")


def links(documents: DataFrame, weights: str = "one") -> DataFrame:
    """Links (a, b) between nodes that suffice for the components, each of the required similarity."""
    banded = stored(_buckets(documents, weights), "bands")
    members = banded.select("node", F.explode("bands").alias("bucket"))
    heads = members.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(members.join(heads.drop("n"), "bucket"), "shared-buckets")  # heads are members too
    nodes = stored(shared.select("node").distinct(), "candidates")
    elements = stored(_elements(documents, nodes, weights), "elements")
    starred = shared.where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    starred = stored(_compared(starred, elements), "compared")
    linked = starred.where(F.col("similarity") >= SIMILARITY).select("a", "b")
    mixed = _mixed(shared, components(linked))
    for seed in range(ROUNDS):
        if not mixed.head(1):
            break
        order = F.struct(F.xxhash64(F.lit(seed), "bucket", "node").alias("h"), "node", "component")
        chosen = mixed.groupBy("bucket").agg(F.min(order).alias("to"))
        pairs = mixed.join(chosen, "bucket").where(F.col("component") != F.col("to.component")).select(
            F.greatest("node", "to.node").alias("a"), F.least("node", "to.node").alias("b")
        )
        more = stored(_compared(pairs.distinct(), elements), "compared-again").where(F.col("similarity") >= SIMILARITY)
        linked = linked.unionByName(more.select("a", "b"))
        mixed = _mixed(mixed.drop("component"), components(linked))
    return linked.unionByName(_rest(mixed, elements)) if mixed.head(1) else linked


def _mixed(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components: bucket, node, head, component."""
    placed = shared.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y")
    return stored(placed.join(several.select("bucket"), "bucket", "left_semi"), "mixed-buckets")


def _rest(mixed: DataFrame, elements: DataFrame) -> DataFrame:
    """All links between nodes of unlike components, among the nodes of the given buckets."""
    nodes = stored(mixed.select("node", "component").distinct(), "open-nodes")
    rows = stored(_exploded(elements.select("node", "elements", "weights").join(nodes, "node")), "open-elements")
    rarity = rows.groupBy("element").agg(
        F.count(F.lit(1)).alias("df"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    # Weight before each element, from the rarest on. What is left after a prefix is less than a link has to share:
    # 0.8 of the heavier set's weight, and 0.8 / 1.8 of both, which is 1.6 / 1.8 of the lighter one's at least.
    rarest_first = Window.partitionBy("node").orderBy("df", "element").rowsBetween(Window.unboundedPreceding, -1)
    prefix = (
        rows.join(rarity, "element")
        .withColumn("before", F.coalesce(F.sum("weight").over(rarest_first), F.lit(0)))
        .withColumn("left", (F.col("total") - F.col("before")) / F.col("total") + 1e-9)
        .where((F.col("left") >= SIMILARITY) & (F.col("x") != F.col("y")))
        .select("element", "df", "node", "component", "total", (F.col("left") >= 2 * SIMILARITY / (1 + SIMILARITY)).alias("short"))
    )
    prefix = stored(prefix, "prefixes")
    few, many = prefix.where(F.col("df") <= _FEW), prefix.where(F.col("df") > _FEW)
    sketches = _sketched(elements.join(many.select("node").distinct(), "node", "left_semi"))
    found = _sharing(few, F.lit(True)).unionByName(_sharing(stored(many.join(sketches, "node"), "sketches"), _can_link("a", "b")))
    return _compared(found.distinct(), elements).where(F.col("similarity") >= SIMILARITY).select("a", "b")


def _sharing(prefix: DataFrame, also: Column) -> DataFrame:
    """Pairs (a, b) of nodes that share an element of the prefixes, of unlike components and near sizes."""
    carried = [c for c in prefix.columns if c not in ("element", "df", "short")]
    one, other = (prefix.select("element", "short", *(F.col(c).alias(c + end) for c in carried)) for end in ("a", "b"))
    near_sizes = (F.col("totala") <= F.col("totalb")) & (F.col("totala") >= F.lit(SIMILARITY - 1e-9) * F.col("totalb"))
    pairs = one.where("short").drop("short").join(other.drop("short"), "element")
    pairs = pairs.where((F.col("componenta") != F.col("componentb")) & near_sizes & also)
    return pairs.select(F.greatest("nodea", "nodeb").alias("a"), F.least("nodea", "nodeb").alias("b"))


def _exploded(elements: DataFrame) -> DataFrame:
    """A row per node and element: element, weight, and the node's component and total weight."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, component, e, w in zip(*(batch[c] for c in ("node", "component", "elements", "weights")), strict=True):
                ids = np.frombuffer(e, np.int64)
                weight = np.frombuffer(w, "<i4").astype(np.int64) if w else np.ones(len(ids), np.int64)
                yield pd.DataFrame({"node": node, "component": component, "element": ids, "weight": weight, "total": weight.sum()})

    return elements.mapInPandas(run, "node string, component string, element long, weight long, total long")


def classes(documents: DataFrame, weights: str = "one") -> DataFrame:
    """Per node that is linked to another: node, component."""
    return stored(components(links(documents, weights)), "classes")


def report(documents: DataFrame, weights: str = "one") -> DataFrame:
    """Per document: doc_id, class_id (the smallest doc_id of its class), class_size, kept (one document of each class)."""
    rows = documents.select("doc_id", node_of(F.col("text")).alias("node"))
    placed = rows.join(classes(documents, weights), "node", "left").withColumn("class", F.coalesce("component", "node"))
    placed = stored(placed.select("doc_id", "node", "class"), "placed")
    whole = placed.where("class IS NOT NULL")
    sized = whole.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    out = whole.join(sized, "class").select(
        "doc_id", "class_id", "class_size", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)).alias("kept")
    )
    alone = placed.where("class IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept")
    )
    return out.unionByName(alone)


def keep_one(documents: DataFrame, weights: str = "one") -> DataFrame:
    """``documents`` with one of each class, the one of the smallest doc_id (null first), as it is; null texts stay."""
    text_hash = F.xxhash64("text")
    rows = documents.where(F.col("text").isNotNull()).select("doc_id", text_hash.alias("h"), node_of(F.col("text")).alias("node"))
    placed = rows.join(classes(documents, weights), "node", "left").select("doc_id", "h", F.coalesce("component", "node").alias("class"))
    placed = placed.groupBy("class", "doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    placed = stored(placed, "placed")
    first = placed.groupBy("class").agg(F.min(F.struct("doc_id", "h")).alias("first"), F.sum("n").alias("size")).where("size > 1")
    shared = placed.join(first, "class").withColumn("is_first", F.struct("doc_id", "h").eqNullSafe(F.col("first")))
    # Rows to drop, and rows of which one copy is to stay.
    own_id, own_hash, repeated = fresh(documents, "own_id", "own_hash", "repeated")
    marked = shared.where("NOT is_first OR n > 1").select(
        F.col("doc_id").alias(own_id), F.col("h").alias(own_hash), F.col("is_first").alias(repeated)
    )
    marked = stored(marked.distinct(), "marked")
    joined = documents.join(
        small_enough(marked, _BROADCAST_NODES), F.col("doc_id").eqNullSafe(F.col(own_id)) & (text_hash == F.col(own_hash)), "left"
    )
    names = documents.columns
    once = joined.where(F.col(repeated)).dropDuplicates([own_id, own_hash]).select(names)
    return joined.where(F.col(repeated).isNull()).select(names).unionByName(once)

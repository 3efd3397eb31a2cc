"""Jaccard similarity join of word shingles by parity sketches.

Documents with the same shingle set are one node. A node's sketch is a row of 64-bit words: each shingle is
hashed to one word and XORed into it, so the number of words in which two sketches differ is at most the size
of the sets' symmetric difference. The width of the sketch follows the set's size band (powers of four, and
bands across their borders, so that sets of comparable size share one). Sets of Jaccard similarity s differ in
at most (1 - s) / s of a set's size, D; so of the non-empty words of a sketch, in one fixed order, the first D + 1
of both sets hold an equal one. These words are the join keys (the pigeonhole step). A second sketch, one parity
bit a shingle, rejects most false candidates by its Hamming distance, another lower bound of the symmetric
difference; the shingle sets decide the rest.

Leaving the same shingles out of all sketches keeps the argument whole. So shingles of many documents, the
``frequent`` most common ones, are left out and no key is common for their sake. Sets that then fill too few words
(copies of much copied text, above all) keep all their words there and are joined among themselves in a second key
space with nothing left out; sets too small to fill enough words even so, in a third, with single shingles as
words. No candidate is capped or dropped.

Within a key the node with the fewest shingles of its own is compared with all others first: in a group of near
copies that is the one closest to the rest. What that leaves in several components is then compared across
components: all nodes of a key but the largest component's with all others, by their parity sketches, in groups
of bounded size, and only pairs that may link come out of a group. So no link between components is missed, and
the links returned connect exactly the components of the full join.

Defined results: NULL, empty and wordless texts have no shingles and link with nothing; equal rows are linked;
rows with NULL doc_id link like others but never name a component that has another name; an empty table gives an
empty result. Set hashes have 64 bits. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.storage import conf

from .common import named, staged
from .components import components
from .shingles import mixed, shingle_sets


@dataclass(frozen=True)
class Join:
    """Documents link at ``percent`` / 100 similarity of shingles of ``size`` words. The at most ``frequent`` shingles
    that are seen in ``common`` documents or more of the batches they are counted in stay out of the first key space."""

    percent: int = 80
    size: int = 5
    frequent: int = 1 << 18
    common: int = 32


#: Bits of the second sketch, and of the Bloom filter of candidate documents.
PARITY_BITS = 2048
BLOOM_BITS = 24
#: Shingles counted at once, documents hashed at once, and nodes of a key in a block of comparisons.
COUNTED = 4_000_000
BATCH = 2500
BLOCK = 1024
#: Pairs compared at once.
PAIRS = 1 << 14
_G = np.uint64(0x9E3779B97F4A7C15)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def bands(n: int) -> list[tuple[int, int]]:
    """(band, width of the sketch) for a set of n shingles: its power of four, and the band across the border if
    a set of comparable size (within 4/5 and 5/4) may stand beyond it."""
    j = (n.bit_length() - 1) // 2
    low = 4**j
    out = [(4 * j, low + low // 2 + 1)]
    if n >= 3.2 * low:
        out.append((4 * j + 2, 2 * low + 1))
    if n < 1.25 * low and j:
        out.append((4 * j - 2, low // 2 + 1))
    return out


def slack(n: int, percent: int) -> int:
    """Most by which a linked set can differ from a set of n."""
    return n * (100 - percent) // percent


def first_keys(keys: np.ndarray, count: int) -> np.ndarray:
    return keys if len(keys) <= count else np.partition(keys, count - 1)[:count]


def _words(own: np.ndarray, n: int, count: int, space: int) -> tuple[np.ndarray, bool]:
    """Keys of the non-empty sketch words of part of a set of n, and whether they are too few."""
    found, poor = [], False
    for band, width in bands(n):
        keys = own
        if len(own):
            word = ((own >> np.uint64(32)) * np.uint64(width)) >> np.uint64(32)
            at = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            value = np.bitwise_xor.reduceat(own * _G, at)
            keys = mixed(value ^ (word[at] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(64 * space + band + 1)))
        poor |= len(keys) < count
        found.append(first_keys(keys, count))
    return np.concatenate(found), poor


def sketch_keys(shingles: np.ndarray, rare: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of a set (sorted hashes) in the first and in the further key spaces; rare marks what is not left out."""
    n = len(shingles)
    count = slack(n, percent) + 1
    first, poor = _words(shingles[rare], n, count, 0)
    if not poor:
        return first, first[:0]
    further, poor = _words(shingles, n, count, 1)
    if poor:
        further = np.concatenate([further, first_keys(mixed(shingles ^ np.uint64(0xA0761D6478BD642F)), count)])
    return first, further


def set_hash(shingles: np.ndarray) -> np.ndarray:
    return mixed(np.array([shingles.sum(dtype=np.uint64)], dtype=np.uint64) * _G ^ np.bitwise_xor.reduce(shingles))


def parity(shingles: np.ndarray) -> np.ndarray:
    """One bit a shingle, XORed, as 64-bit words."""
    bits = np.bincount((shingles * _G >> np.uint64(53)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


class Members:
    """A fixed set of 64-bit hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.table = np.zeros(1 << 22, dtype=bool)
        self.table[(self.hashes >> np.uint64(42)).astype(np.int64)] = True

    def has(self, shingles: np.ndarray) -> np.ndarray:
        out = self.table[(shingles >> np.uint64(42)).astype(np.int64)]
        maybe = np.flatnonzero(out)
        if len(maybe):
            at = np.searchsorted(self.hashes, shingles[maybe])
            at[at == len(self.hashes)] = 0
            out[maybe] = self.hashes[at] == shingles[maybe]
        return out


def repeated(sets: list[np.ndarray]) -> pa.RecordBatch:
    """(h, n) of the shingles that two sets or more have. The list is emptied, so that the shingles are held once."""
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    sets.clear()
    flat.sort()
    same = np.zeros(len(flat) + 1, dtype=bool)
    np.equal(flat[1:], flat[:-1], out=same[1 : len(flat)])
    # Behind the first of equal ones same begins, behind the last it ends.
    first = np.flatnonzero(same[1:] & ~same[:-1])
    last = np.flatnonzero(same[:-1] & ~same[1:])
    return pa.RecordBatch.from_arrays([pa.array(_signed(flat[first])), pa.array(last - first + 1)], names=["h", "n"])


def frequent_shingles(texts: DataFrame, how: Join) -> np.ndarray:
    """Hashes of the most common shingles: counted in each run of ``COUNTED`` shingles, and those seen in two
    documents or more of it summed over all. The driver gets ``how.frequent`` numbers at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, size = [], 0
        for batch in batches:
            for own in shingle_sets(batch.column(0), how.size):
                sets.append(own)
                size += len(own)
                if size >= COUNTED:
                    yield repeated(sets)
                    size = 0
        yield repeated(sets)

    counted = texts.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= how.common)
    most = counted.orderBy(F.desc("n"), "h").limit(how.frequent).select("h").toPandas()["h"].to_numpy(dtype=np.int64)
    return np.ascontiguousarray(most).view(np.uint64)


def _rows(texts: DataFrame, members, how: Join) -> DataFrame:
    """One pass: kind 0 a document (id, its node, n, how many are not left out, parity sketch), kind 1 and 2 a key
    of a node in the first and the further key spaces."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = members.value
        for batch in batches:
            nodes, sizes, owns, sketches, keys, seen = [], [], [], [], ([], []), set()
            for own in shingle_sets(batch.column(1), how.size):
                sizes.append(len(own))
                if not len(own):
                    nodes.append(None)
                    sketches.append(None)
                    owns.append(None)
                    continue
                node = int(_signed(set_hash(own))[0])
                nodes.append(node)
                sketches.append(parity(own))
                rare = ~often.has(own)
                owns.append(int(rare.sum()))
                if node in seen:  # a copy in the same batch
                    continue
                seen.add(node)
                for k, found in zip(keys, sketch_keys(own, rare, how.percent)):
                    if len(found):
                        k.append((node, found))
            n = len(nodes)
            parts = [
                [pa.array([0] * n, pa.int8()), pa.nulls(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(owns, pa.int64()), pa.array(sketches, pa.list_(pa.int64())), batch.column(0)]
            ]
            for kind, found in enumerate(keys, 1):
                if found:
                    flat = _signed(np.concatenate([k for _, k in found]))
                    owner = np.repeat(np.array([x for x, _ in found], dtype=np.int64), [len(k) for _, k in found])
                    m = len(flat)
                    parts.append(
                        [pa.array(np.full(m, kind, np.int8)), pa.array(flat), pa.array(owner), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, batch.column(0).type)]
                    )
            for columns in parts:
                yield pa.RecordBatch.from_arrays(columns, names=["kind", "key", "node", "n", "own", "sketch", "doc_id"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(emit, f"kind tinyint, key long, node long, n long, own long, sketch array<long>, doc_id {kind}")


def _shared_keys(rows: DataFrame) -> DataFrame:
    """(key, node) of the keys that two nodes or more have.

    Keys of the first space are rare by construction, so neighbours in one sort tell. Others may be
    common: there the smallest and largest node of each key are found with map-side combining.
    """
    from pyspark.sql import Window

    first = rows.filter("kind = 1").select("key", "node")
    by_key = Window.partitionBy("key").orderBy("node")
    first = (
        first.withColumns({"before": F.lag("node").over(by_key), "after": F.lead("node").over(by_key)})
        .filter("before <> node OR after <> node")
        .select("key", "node")
    )
    second = rows.filter("kind = 2").select("key", "node")
    many = second.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b").select("key")
    return first.unionByName(second.join(many, "key", "left_semi"))


def _differing(a: str, b: str) -> Column:
    """Hamming distance of two parity sketches."""
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (t, x) -> t + x)")


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, how: Join) -> DataFrame:
    """The pairs (a, b) of nodes that link."""
    s = how.percent
    facts = nodes.select("node", "n", "sketch")
    side = lambda x: facts.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    # I <= min(n), U >= max(n); the symmetric difference of linked sets is at most (100 - s) / (100 + s) of na + nb.
    near = near.filter(100 * F.least("na", "nb") >= s * F.greatest("na", "nb"))
    near = near.filter((100 + s) * _differing("sa", "sb") <= (100 - s) * (F.col("na") + F.col("nb")))
    near = staged(near.select("a", "b", "na", "nb"), "near-pairs")
    wanted = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    sets = _sets(texts, staged(nodes.join(wanted, "node", "left_semi").select("node", "doc_id"), "near-nodes"), how)
    joined = near.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb")), "b"
    )
    both = F.size(F.array_intersect("xa", "xb"))
    return joined.filter(100 * both >= s * (F.col("na") + F.col("nb") - both)).select("a", "b").distinct()


def _sets(texts: DataFrame, wanted: DataFrame, how: Join) -> DataFrame:
    """(node, shingles) of the wanted nodes, hashed again from the texts of one document each. A Bloom filter of
    their ids, of fixed size, spares the other documents; a false hit only costs time."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << BLOOM_BITS))
    words = (
        wanted.select(F.shiftright(slot, 6).alias("w"), F.expr(f"shiftleft(1L, int(pmod(xxhash64(doc_id), {1 << BLOOM_BITS}) & 63))").alias("m"))
        .groupBy("w")
        .agg(F.bit_or("m").alias("m"))
        .toPandas()
    )
    table = np.zeros(1 << (BLOOM_BITS - 6), dtype=np.int64)
    table[words["w"].to_numpy(dtype=np.int64)] = words["m"].to_numpy(dtype=np.int64)
    bloom = texts.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            hit = (bloom.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            column = batch.column(1).filter(pa.array(hit.astype(bool)))
            sets = [x for x in shingle_sets(column, how.size) if len(x)]
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            ends = np.cumsum([0] + [len(x) for x in sets], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(_signed(set_hash(x))[0]) for x in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(flat)))],
                names=["node", "shingles"],
            )

    parsed = texts.select(slot.alias("slot"), "text").mapInArrow(parse, "node long, shingles array<long>")
    return parsed.join(wanted.select("node"), "node", "left_semi")


def _dealt(rest: DataFrame) -> DataFrame:
    """The nodes of each key in groups (key, block, slice) of bounded size: the outsiders of a block (``ask``) meet all
    nodes of a slice (``met``) there. Outsiders are the nodes outside the key's largest component; they alone are cut into
    blocks, so a node is sent once for each ``BLOCK`` outsiders, and an outsider once more for each slice but its own."""
    outsiders = F.col("g") - F.col("m")
    blocks = F.ceil(outsiders / BLOCK).cast("int")
    slices = F.ceil(F.col("g") / (4 * BLOCK)).cast("int")
    own_block, own_slice = F.pmod(F.xxhash64("node"), blocks).cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), slices).cast("int")
    outside = F.col("c") != F.col("top")
    met = rest.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("slice", own_slice)
    others = F.array_remove(F.sequence(F.lit(0), slices - 1), own_slice)
    asking = rest.filter(outside & (slices > 1)).withColumn("block", own_block).withColumn("slice", F.explode(others))
    columns = ["key", "block", "slice", "node", "c", "top", "n", "sketch"]
    met = met.select(*columns, (outside & (F.col("block") == own_block)).alias("ask"), F.lit(True).alias("met"))
    return met.unionByName(asking.select(*columns, F.lit(True).alias("ask"), F.lit(False).alias("met")))


def group_pairs(part: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b), a < b, of a group's askers and the nodes they meet that may link, some ``PAIRS`` at a time; none twice."""
    one = lambda name: part.column(name).to_numpy()
    sketch = part.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(part.num_rows, -1)
    node, c, top, n = one("node"), one("c"), one("top"), one("n")
    left, right = np.flatnonzero(one("ask")), np.flatnonzero(one("met"))
    for at in range(0, len(left), 32):
        i = left[at : at + 32]
        # Of two outsiders the smaller node asks.
        apart = (c[i][:, None] != c[right][None, :]) & ((c[right] == top[right])[None, :] | (node[i][:, None] < node[right][None, :]))
        near = 100 * np.minimum(n[i][:, None], n[right][None, :]) >= percent * np.maximum(n[i][:, None], n[right][None, :])
        x, y = np.nonzero(apart & near)
        for k in range(0, len(x), PAIRS):
            a, b = i[x[k : k + PAIRS]], right[y[k : k + PAIRS]]
            differ = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64)
            good = (100 + percent) * differ <= (100 - percent) * (n[a] + n[b])
            a, b = node[a[good]], node[b[good]]
            if len(a):
                yield np.minimum(a, b), np.maximum(a, b)


def _across(rest: DataFrame, how: Join) -> DataFrame:
    """Pairs (a, b) of one key and different components that their parity sketches and sizes let link.

    rest: key, g (nodes of the key), top (the key's largest component), m (its nodes), node, c (its component), n, sketch.
    """
    sorted_groups = _dealt(rest).repartition("key", "block", "slice").sortWithinPartitions("key", "block", "slice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # of the last group, which may go on

        def done() -> Iterator[pa.RecordBatch]:
            for a, b in group_pairs(pa.concat_tables(held), how.percent):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            ids = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)])
            edges = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for start, end in zip(edges[:-1], edges[1:]):
                group = tuple(ids[:, start].tolist())
                if held and group != last:
                    yield from done()
                    held = []
                last = group
                held.append(table.slice(start, end - start))
        if held:
            yield from done()

    return sorted_groups.mapInArrow(run, "a long, b long").distinct()


def join(docs: DataFrame, text: str = "text", how: Join = Join()) -> DataFrame:
    """doc_id, n_shingles, component_id for every document; the component is named by its smallest doc_id."""
    with conf(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=BATCH):
        return _join(docs, text, how)


def _join(docs: DataFrame, text: str, how: Join) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, text).alias("text"))
    members = spark.sparkContext.broadcast(Members(frequent_shingles(texts.select("text"), how)))
    rows = staged(_rows(texts, members, how), "sketches")
    docs_of = rows.filter("kind = 0")
    facts = [F.first(c).alias(c) for c in ("n", "own", "sketch")]
    nodes = docs_of.filter("node IS NOT NULL").groupBy("node").agg(*facts, F.min("doc_id").alias("doc_id"))
    shared = staged(_shared_keys(rows).distinct(), "shared-keys")
    # Each key's node with the fewest shingles of its own, with the others.
    least = shared.join(nodes.select("node", "own"), "node").groupBy("key").agg(F.min(F.struct("own", "node")).alias("m"))
    stars = shared.join(least.select("key", F.col("m.node").alias("a")), "key").filter("a <> node")
    stars = staged(stars.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(), "stars")
    links = staged(_verified(stars, nodes, texts, how), "links")
    found = staged(components(links), "components")
    # What a key still holds in several components: all but the largest of them with the rest.
    labelled = shared.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c"))
    sizes = labelled.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("m", "c")).alias("most"), F.sum("m").alias("g"), F.count(F.lit(1)).alias("parts"))
    open_keys = largest.filter("parts > 1 AND g > 2").select("key", "g", F.col("most.c").alias("top"), F.col("most.m").alias("m"))
    rest = labelled.join(open_keys, "key").join(nodes.select("node", "n", "sketch"), "node")
    across = staged(_across(rest, how).join(stars, ["a", "b"], "left_anti"), "across")
    more = staged(_verified(across, nodes, texts, how), "links")
    final = components(links.unionByName(more))
    labels = docs_of.join(final, "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("c"))
    names = labels.filter("c IS NOT NULL").groupBy("c").agg(F.min("doc_id").alias("name"))
    return labels.join(names, "c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id")
    )


def one_of_each(docs: DataFrame, text: str = "text", how: Join = Join()) -> DataFrame:
    """The documents that name their component, with their own columns. Rows equal in doc_id and text stay once;
    rows without doc_id cannot name a component and all stay."""
    joined = join(docs, text, how)
    keep = staged(joined.filter("doc_id = component_id").select("doc_id").distinct(), "representatives")
    named_rows = docs.join(keep.withColumnRenamed("doc_id", "kept_id"), named(docs, "doc_id") == F.col("kept_id"), "left_semi")
    return named_rows.dropDuplicates(["doc_id", text]).unionByName(docs.filter(named(docs, "doc_id").isNull()))

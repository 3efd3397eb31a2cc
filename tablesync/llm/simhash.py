"""SimHash near-copies of documents, found with BK-trees.

A document's fingerprint has a bit set where more than half of the XXH64 hashes of its word shingles have it set.
Documents with one fingerprint are one node. Two nodes link when their fingerprints differ in at most ``radius``
bits; what is linked, directly or through others, is one component.

Nodes are dealt to shards first. The 64 bits are cut into ``radius`` + 1 blocks, and two fingerprints that differ in
``radius`` bits at most are equal in one of them: each node goes to one shard for each block, named by the
block's value, so linked nodes meet. A shard of more than ``SHARD`` nodes is dealt again by blocks of the
bits that are left, by the same argument; what is then still larger is cut into parts, each of which is the tree for
all parts behind it. No shard is capped.

Every shard, or part, becomes a BK-tree: the child of a node holds a fingerprint at the distance that its edge is
marked with, so a search at distance d from a node follows only edges from d - radius to d + radius. A task builds
the trees of many shards at once, level by level in numpy, and walks them with all their queries at once. Trees
reach the tasks of their queries through the shuffle: the driver may not hold the fingerprints of all documents, so
it cannot broadcast them. Of the pairs found in a shard only those leave it that join two of its components.

Defined results: NULL, empty and wordless texts have the fingerprint zero and link like any other; equal texts are in
one component; a row with NULL doc_id has a fingerprint but links nothing: its component_id is that of the documents
with its fingerprint, NULL if there are none. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.storage import conf

from .common import named, staged
from .components import components

WORDS = 3
RADIUS = 2
#: Seed of the XXH64 hashes.
SEED = 42
#: Nodes of one tree.
SHARD = 4096
#: Documents hashed at once, tree nodes held at once, and (query, node) meetings of one step.
BATCH = 2000
HELD = 200_000
STEP = 2_000_000
#: A fingerprint with more than this share of all rows is joined in place; there are fewer than 1 / SHARE of them.
SHARE = 1 / 256


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The fingerprint of a UTF-8 text."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    parts = (text or b"").lower().split()  # bytes: A-Z only, and the six white-space characters
    if not parts:
        return 0
    if len(parts) < words:
        return digest(b" ".join(parts), SEED)
    hashes = [digest(b" ".join(s), SEED) for s in zip(*(parts[k:] for k in range(words)))]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        some = np.array(hashes[at : at + (1 << 15)], dtype="<u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp) with the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, words) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            shown = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), shown], names=["doc_id", "fp"])

    texts = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, text).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, fp long")


def _blocks(low: int, high: int, count: int) -> list[tuple[int, int]]:
    """(first bit, bits) of count blocks of the bits from low up to high."""
    edges = [low + (high - low) * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:])]


def _bits(value: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(value, first).bitwiseAND((1 << bits) - 1)


def _shards(nodes: DataFrame, radius: int) -> DataFrame:
    """(shard, n, block, fp, id): the nodes of each shard that holds more than one, n of them."""
    count = radius + 1
    blocks = _blocks(0, 64, count)
    keys = [F.struct(F.lit(k).alias("block"), _bits(F.col("fp"), *b).alias("shard")) for k, b in enumerate(blocks)]
    dealt = nodes.select(F.explode(F.array(*keys)).alias("k"), "fp", "id").select("k.block", "k.shard", "fp", "id")
    sizes = dealt.groupBy("block", "shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    dealt = dealt.join(sizes, ["block", "shard"])
    # The bits left, as one number whose lowest bits are those that are left, by the block that is taken.
    rest = [(F.col("fp").bitwiseAND((1 << first) - 1) if first else F.lit(0)).bitwiseOR(
        F.shiftleft(F.shiftrightunsigned("fp", first + bits), first) if first + bits < 64 else F.lit(0)
    ) for first, bits in blocks]
    again = []
    for k, (_, bits) in enumerate(blocks):
        again += [
            F.when(F.col("block") == k, F.struct(F.lit(count + count * k + j).alias("block"), _bits(rest[k], *b).alias("sub")))
            for j, b in enumerate(_blocks(0, 64 - bits, count))
        ]
    large = dealt.filter(F.col("n") > SHARD).select(F.explode(F.array_compact(F.array(*again))).alias("k"), "shard", "fp", "id")
    large = large.select("k.block", "shard", "k.sub", "fp", "id")
    sizes = large.groupBy("block", "shard", "sub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    large = large.join(sizes, ["block", "shard", "sub"])
    small = dealt.filter(F.col("n") <= SHARD).select("block", "shard", F.lit(-1).cast("long").alias("sub"), "fp", "id", "n")
    return small.unionByName(large.select(*small.columns))


def plant(root: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BK-trees of distinct fingerprints; root is each one's root (its own place for a root).

    Returns (marks, nodes): marks are 65 * parent + edge in order, and nodes the child behind each.
    """
    at = root.copy()
    active = np.flatnonzero(root != np.arange(len(root)))
    marks, nodes = [], []
    while len(active):
        edge = np.bitwise_count(prints[active] ^ prints[at[active]]).astype(np.int64)
        mark = at[active] * 65 + edge
        order = np.argsort(mark, kind="stable")
        active, mark = active[order], mark[order]
        first = np.append(True, mark[1:] != mark[:-1])
        child = active[first]
        marks.append(mark[first])
        nodes.append(child)
        at[active] = child[np.cumsum(first) - 1]
        active = active[~first]
    if not marks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marks, nodes = np.concatenate(marks), np.concatenate(nodes)
    order = np.argsort(marks)
    return marks[order], nodes[order]


def walk(marks: np.ndarray, nodes: np.ndarray, prints: np.ndarray, query: np.ndarray, start: np.ndarray, radius: int):
    """(query, node) of all pairs within radius: queries walk from their start along edges near their distance."""
    found = ([], [])
    while len(query):
        d = np.bitwise_count(prints[query] ^ prints[start]).astype(np.int64)
        near = d <= radius
        found[0].append(query[near])
        found[1].append(start[near])
        low = np.searchsorted(marks, start * 65 + np.maximum(d - radius, 1))
        size = np.searchsorted(marks, start * 65 + np.minimum(d + radius, 64), side="right") - low
        query = np.repeat(query, size)
        step = np.arange(len(query)) - np.repeat(np.cumsum(size) - size, size)
        start = nodes[np.repeat(low, size) + step]
    return np.concatenate(found[0] or [np.zeros(0, np.int64)]), np.concatenate(found[1] or [np.zeros(0, np.int64)])


def joining(group: np.ndarray, tree: np.ndarray, asks: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of places that connect, within each group, what lies within radius.

    group is ascending; tree marks the fingerprints of a group's tree, asks its queries. They are the same where a
    group is not cut, else apart; the links within a part are found in the part's own group.
    """
    n = len(group)
    begins = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    of = np.cumsum(np.append(False, group[1:] != group[:-1]))
    planted = np.flatnonzero(tree)
    first = planted[np.append(True, of[planted][1:] != of[planted][:-1])] if len(planted) else planted
    root = np.full(len(begins), -1)
    root[of[first]] = first
    marks, nodes = plant(np.where(tree, root[of], np.arange(n)), prints)
    sizes = np.bincount(of[planted], minlength=len(begins))
    queries = np.flatnonzero(asks & (root[of] >= 0))
    component = np.arange(n)
    out = ([], [])
    work = np.cumsum(sizes[of[queries]])
    at = 0
    while at < len(queries):
        end = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + STEP, side="right")))
        q, v = walk(marks, nodes, prints, queries[at:end], root[of[queries[at:end]]], radius)
        at = end
        apart = component[q] != component[v]
        q, v = q[apart], v[apart]
        if not len(q):
            continue
        _, one = np.unique(np.minimum(component[q], component[v]) * n + np.maximum(component[q], component[v]), return_index=True)
        name: dict[int, int] = {}

        def find(x: int) -> int:
            while x in name:
                x = name[x]
            return x

        for a, b, ca, cb in zip(q[one].tolist(), v[one].tolist(), component[q[one]].tolist(), component[v[one]].tolist()):
            ra, rb = find(ca), find(cb)
            if ra != rb:
                name[max(ra, rb)] = min(ra, rb)
                out[0].append(a)
                out[1].append(b)
        renamed = np.arange(n)
        for c in name:
            renamed[c] = find(c)
        component = renamed[component]
    return np.array(out[0], dtype=np.int64), np.array(out[1], dtype=np.int64)


def _links(shards: DataFrame, radius: int) -> DataFrame:
    """(a, b) of linked nodes; they connect what the shards' trees find."""
    parts = F.ceil(F.col("n") / SHARD).cast("int")
    node = shards.withColumn("part", F.pmod(F.xxhash64("fp"), parts).cast("int"))
    node = node.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = node.select("block", "shard", "sub", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "fp", "id")
    where = ["block", "shard", "sub", "lo", "hi"]
    rows = dealt.repartition(*where).sortWithinPartitions(*where)

    def pairs(table: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        table = table.combine_chunks()
        one = lambda name: table.column(name).to_numpy()
        tree, asks = one("part") == one("lo"), one("part") == one("hi")
        a, b = joining(group, tree, asks, one("fp").view(np.uint64), radius)
        ids = table.column("id").combine_chunks()
        return pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def cut() -> tuple[pa.Table, np.ndarray, int]:
            table = pa.Table.from_batches(held).combine_chunks()
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in where])
            new = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
            edges = np.flatnonzero(new)
            return table, np.cumsum(np.append(False, new)), int(edges[-1]) + 1 if len(edges) else 0

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= HELD:  # all whole groups; the last one may go on
                table, group, end = cut()
                if end:
                    yield pairs(table.slice(0, end), group[:end])
                    held = table.slice(end).to_batches()
                    size = table.num_rows - end
        if held:
            table, group, _ = cut()
            yield pairs(table, group)

    kind = shards.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"a {kind}, b {kind}")


def near_copies(docs: DataFrame, text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id that links lead to."""
    if not 0 <= radius <= 7:
        raise ValueError("radius must be from 0 to 7")
    spark = docs.sparkSession
    with conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch=BATCH):
        prints = staged(fingerprints(docs, text, words), "fingerprints")
    counted = prints.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("rows"))
    nodes = staged(counted, "fingerprint-nodes")
    links = _links(_shards(nodes.filter("id IS NOT NULL").select("fp", "id"), radius), radius)
    # A node is named by its smallest doc_id, so a component's smallest node is its name.
    found = components(staged(links, "fingerprint-links"))
    named_nodes = nodes.join(found.withColumnRenamed("node", "id"), "id", "left").select("fp", "rows", F.coalesce("component", "id").alias("component_id"))
    named_nodes = staged(named_nodes, "fingerprint-components")
    many = int(SHARE * prints.count())
    hot = F.broadcast(named_nodes.filter(F.col("rows") > many).select("fp", "component_id"))
    rest = named_nodes.filter(F.col("rows") <= many).select("fp", "component_id")
    joined = prints.join(hot, "fp").unionByName(prints.join(hot.select("fp"), "fp", "left_anti").join(rest, "fp"))
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

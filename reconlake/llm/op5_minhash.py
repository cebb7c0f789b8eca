"""MinHash near-duplicates: one-permutation hashing with optimal densification,
banded buckets, star-shaped candidate edges, links confirmed on full shingle sets.

1. One pass over the texts gives each document its number of distinct 5-word
   shingles, a 128-bit digest of that set, and ``bands`` bucket keys. Shingle
   hashes fall into ``bands * rows`` equal ranges; each range's minimum is one
   signature entry, and an empty range borrows from a random range of the same
   document, probed in an order that depends only on the empty range.
2. Equal digests are equal sets: they collapse to one node, however many copies
   there are.
3. In each bucket every node is paired with one centre only, the least node, so
   candidate edges number at most nodes times bands. They are confirmed on full sets.
4. A star that reaches over several components may hide links between its outer
   nodes. These are compared too, but not as pairs of rows: differences to the
   centre are dealt into blocks, and each pair of blocks is solved in one task by
   matrix products. Nodes of the centre's own component meet outsiders only. So
   stars lose no link that a bucket holds.
5. Connected components of the confirmed links, by minimum labels.

A pair at the threshold misses all buckets with probability
(1 - 0.85**6)**40 = 6e-9; above the threshold with less.

Nulls, ties, odd rows: a null text or one without words has an empty set, links
with nothing and is its own component. Rows that repeat a doc_id are rows of
their own; equal sets are linked. A row without doc_id links like any other,
but can't name a component (if no member has an id, component_id is null and
every such row is kept). Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconlake.llm import graph, words
from reconlake.llm.store import written

U = np.uint64
ATTEMPTS = 400


def document_shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles of one text's words; a shorter text is one shingle."""
    if not len(hashes):
        return np.zeros(0, U)
    return np.unique(words.shingle_hashes(hashes, min(k, len(hashes))))


def _probes(bins: int) -> np.ndarray:
    """Bin that an empty bin looks at in its n-th attempt."""
    cell = np.arange(ATTEMPTS * bins, dtype=U).reshape(ATTEMPTS, bins)
    return (words.mix(cell + U(0x5851F42D4C957F2D)) % U(bins)).astype(np.int64)


def signature(sets: list[np.ndarray], bins: int, probes: np.ndarray) -> np.ndarray:
    """One-permutation signatures, densified; the sets are sorted and not empty."""
    edges = np.array([(k << 64) // bins for k in range(bins)], U)
    values = np.zeros((len(sets), bins), U)
    filled = np.zeros((len(sets), bins), bool)
    for i, s in enumerate(sets):
        at = np.searchsorted(s, edges)
        filled[i] = np.diff(at, append=len(s)) > 0
        values[i] = s[np.minimum(at, len(s) - 1)]
    row, empty = np.nonzero(~filled)
    source = values.copy()
    for attempt in probes:
        if not len(row):
            return values
        look = attempt[empty]
        found = filled[row, look]
        values[row[found], empty[found]] = source[row[found], look[found]]
        row, empty = row[~found], empty[~found]
    values[row, empty] = source[row, filled.argmax(1)[row]]
    return values


def _band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    part = values.reshape(len(values), bands, rows)
    key = np.zeros(part.shape[:2], U)
    for j in range(rows):
        key = words.mix(key + part[:, :, j])
    return words.mix(key + np.arange(bands, dtype=U) * U(0x9E3779B97F4A7C15)).view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketcher(k: int, bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = _probes(bands * rows)
        for batch in batches:
            raw, ends = words.text_buffer(batch.column(1))
            for lo, hi in words.slices(ends):
                a, b = ends[lo], ends[hi]
                h, _, _, at = words.word_hashes(raw[a:b], ends[lo:hi + 1] - a)
                sets = [document_shingles(h[at[i]:at[i + 1]], k) for i in range(hi - lo)]
                full = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                if full:
                    made = _band_keys(signature([sets[i] for i in full], bands * rows, probes), bands, rows)
                    for i, key in zip(full, made, strict=True):
                        keys[i] = key
                yield pa.record_batch([
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "node", "keys"])
    return sketch


def _shingler(k: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = words.text_buffer(batch.column(1))
            for lo, hi in words.slices(ends):
                a, b = ends[lo], ends[hi]
                h, _, _, at = words.word_hashes(raw[a:b], ends[lo:hi + 1] - a)
                made = [document_shingles(h[at[i]:at[i + 1]], k) for i in range(hi - lo)]
                made = [s for s in made if len(s)]
                yield pa.record_batch([pa.array([_digest(s) for s in made], pa.binary()),
                                       pa.array([s.view(np.int64) for s in made], pa.list_(pa.int64()))],
                                      ["node", "shingles"])
    return sets


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 85, bands: int = 40, rows: int = 6) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = written(spark, "minhash-sketch", base.mapInArrow(
        _sketcher(k, bands, rows), "doc_id long, n_shingles long, node binary, keys array<long>"))
    nodes = written(spark, "minhash-nodes", sketch.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")))
    star = written(spark, "minhash-star", _stars(nodes))
    if star.isEmpty():
        return _result(sketch, nodes, None)
    reached = star.select("node").unionByName(star.select(F.col("centre").alias("node"))).distinct()
    sets = written(spark, "minhash-sets", _sets_of(base, nodes.join(reached, "node", "left_semi"), k))

    links = written(spark, "minhash-links", _confirmed(star, sets, percent))
    labels = None if links.isEmpty() else graph.components(links, "minhash")
    mixed = written(spark, "minhash-mixed", _mixed(star, labels))
    if not mixed.isEmpty():
        more = written(spark, "minhash-more", _compared(mixed, sets, percent))
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = graph.components(links, "minhash")
    return _result(sketch, nodes, labels)


def _stars(nodes: DataFrame) -> DataFrame:
    """(centre, node): every node of a bucket with the bucket's least node. Digests are
    random, so the buckets of one group of near copies mostly have the same few centres."""
    member = nodes.select(F.explode("keys").alias("bucket"), "node")
    heart = member.groupBy("bucket").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("size"))
    return (member.join(heart.where("size > 1").select("bucket", "centre"), "bucket").where("node <> centre")
            .select("centre", "node").distinct())


def _sets_of(base: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of the given nodes, from the text of each one's least document."""
    picked = nodes.select(F.col("least").alias("least_id")).distinct()
    texts = base.join(picked, F.col("doc_id").eqNullSafe(F.col("least_id")), "left_semi")
    made = texts.mapInArrow(_shingler(k), "node binary, shingles array<long>")
    # rows that repeat a doc_id may hold several texts, or one text several times
    return made.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _with_sets(star: DataFrame, sets: DataFrame) -> DataFrame:
    own = sets.select("node", F.col("shingles").alias("s"))
    hub = sets.select(F.col("node").alias("centre"), F.col("shingles").alias("c"))
    return star.join(own, "node").join(hub, "centre")


def _confirmed(star: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the stars' edges whose full sets reach the threshold."""
    size = sets.select("node", F.size("shingles").alias("n"))
    near = star.join(size, "node").join(size.select(F.col("node").alias("centre"), F.col("n").alias("cn")), "centre")
    # sets of sizes too far apart can't reach the threshold
    near = near.where(F.least("n", "cn") * 100 >= F.greatest("n", "cn") * percent).select("centre", "node")
    both = _with_sets(near, sets).select("centre", "node", F.size(F.array_intersect("s", "c")).alias("i"),
                                         (F.size("s") + F.size("c")).alias("t"))
    return both.where((F.col("i") * 100) >= (F.col("t") - F.col("i")) * percent).select(
        F.col("centre").alias("a"), F.col("node").alias("b"))


def _mixed(star: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(centre, node, label, inside) of the stars that reach over several components;
    inside: in the centre's own component."""
    if labels is None:
        named = star.withColumn("label", F.col("node")).withColumn("hub", F.col("centre"))
    else:
        hub = labels.select(F.col("node").alias("centre"), F.col("label").alias("hub"))
        named = star.join(labels, "node", "left").join(hub, "centre", "left").select(
            "centre", "node", F.coalesce("label", "node").alias("label"), F.coalesce("hub", "centre").alias("hub"))
    named = named.withColumn("inside", F.col("label") == F.col("hub"))
    # the centre itself has been compared; two other nodes of different components have not
    wide = named.groupBy("centre").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    return named.join(wide.select("centre"), "centre").select("centre", "node", "label", "inside")


def _compared(mixed: DataFrame, sets: DataFrame, percent: int, block_rows: int = 512, block_items: int = 400_000
              ) -> DataFrame:
    """(a, b): links between nodes of one star and different components.

    A node is sent as its difference to the centre: what two differences don't share
    is what the two sets don't share. A star's nodes are dealt into blocks, and each
    pair of blocks that can hold an unknown link is solved as matrix products in one
    task, which returns a spanning forest of the links it finds."""
    far = _with_sets(mixed, sets).select(
        "centre", "node", "label", "inside", F.size("s").alias("n"),
        F.concat(F.array_except("s", "c"), F.array_except("c", "s")).alias("delta"))
    far = written(mixed.sparkSession, "minhash-deltas", far)
    sized = far.groupBy("centre", "inside").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("delta")).alias("items"))
    blocks = sized.withColumn("blocks", F.greatest(F.ceil(F.col("rows") / block_rows),
                                                   F.ceil(F.col("items") / block_items)).cast("int"))
    wide = blocks.groupBy("centre").agg(
        F.coalesce(F.max(F.when(F.col("inside"), F.col("blocks"))), F.lit(0)).alias("ins"),
        F.coalesce(F.max(F.when(~F.col("inside"), F.col("blocks"))), F.lit(0)).alias("outs"))
    dealt = far.join(wide, "centre").withColumn("own", F.pmod(
        F.xxhash64("node"), F.when(F.col("inside"), F.col("ins")).otherwise(F.col("outs"))).cast("int"))
    # outsiders (first blocks) meet each other and the insiders (last blocks); insiders are one component
    every = lambda lo, hi: F.when(hi > lo, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<int>"))
    zero = F.lit(0)
    outs = F.transform(every(zero, F.col("outs") + F.col("ins")), lambda other: F.struct(
        F.least("own", other).alias("i"), F.greatest("own", other).alias("j")))
    ins = F.transform(every(zero, F.col("outs")), lambda other: F.struct(
        other.alias("i"), (F.col("outs") + F.col("own")).alias("j")))
    sent = dealt.select("centre", "node", "label", "inside", "n", "delta",
                        F.explode(F.when(F.col("inside"), ins).otherwise(outs)).alias("at"))
    sent = sent.select("centre", "at.i", "at.j", "node", "label", "n", "delta")
    return sent.groupBy("centre", "i", "j").applyInArrow(_block_solver(percent), "a binary, b binary").distinct()


def _block_solver(percent: int):
    def solve(rows: pa.Table) -> pa.Table:
        node, label = rows["node"].to_pylist(), rows["label"].to_pylist()
        n = np.array(rows["n"].to_numpy(), np.int64)
        column = rows["delta"].combine_chunks()
        size = np.diff(column.offsets.to_numpy())
        owner = np.repeat(np.arange(len(node)), size)
        value, item, count = np.unique(column.flatten().to_numpy(), return_inverse=True, return_counts=True)
        shared = count[item] > 1                          # what only one node has is in no overlap
        owner, item = owner[shared], item[shared]
        order = np.argsort(item, kind="stable")
        owner, item = owner[order], np.unique(item[order], return_inverse=True)[1]
        overlap = np.zeros((len(node), len(node)), np.float32)
        for lo in range(0, int(item.max(initial=-1)) + 1, 2048):
            a, b = np.searchsorted(item, [lo, lo + 2048])
            part = np.zeros((len(node), 2048), np.float32)
            part[owner[a:b], item[a:b] - lo] = 1
            overlap += part @ part.T
        apart = size[:, None] + size[None] - 2 * overlap.astype(np.int64)       # of the two sets
        both = (n[:, None] + n[None] - apart) // 2
        linked = np.argwhere(np.triu(both * 100 >= (both + apart) * percent, 1))
        root = {x: x for x in label}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for i, j in linked.tolist():
            x, y = find(label[i]), find(label[j])
            if x != y:
                root[x] = y
                out.append((min(node[i], node[j]), max(node[i], node[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})
    return solve


def _result(sketch: DataFrame, nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        group = nodes.select("node", F.col("least").alias("component_id"))
    else:
        placed = nodes.join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
        least = placed.groupBy("label").agg(F.min("least").alias("component_id"))
        group = placed.join(least, "label").select("node", "component_id")
    out = sketch.select("doc_id", "n_shingles", "node").join(group, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))

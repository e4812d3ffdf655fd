"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees of shards."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from .common import give_back, materialise, slices, small_batches, text_bytes
from .components import connected_components

#: Words of a shingle and the seed of its hash.
WORDS, SEED = 3, 42
#: Fingerprints link when they differ in so many bits or fewer.
RADIUS = 2
#: Fingerprints of a tree at most: a shard with more has several, each met by all of the shard's queries.
TREE_NODES = 4096
#: Bytes of text that are hashed together, and pairs of query and node that are compared together.
SLICE_BYTES, FRONTIER = 1 << 20, 1 << 18
#: A fingerprint with one row in so many is joined by a broadcast: there are so many of those at most.
HOT_SHARE = 1000


def shingle_hashes(text: bytes | None, words: int = WORDS):
    """XXH64 of every shingle of `words` words, repeats included; of all words where there are fewer, none without words."""
    import numpy as np
    import xxhash

    parts = (text or b"").lower().split()  # of bytes, so A-Z only
    joined = b" ".join(parts)
    stops = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1]) if parts else stops
    n = max(len(parts) - words + 1, min(len(parts), 1))
    spans = zip(starts[:n].tolist(), stops[len(parts) - n :].tolist())
    return np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, n)


def fingerprint_of(hashes) -> int:
    """The bits that are set in over half the hashes."""
    import numpy as np

    if not len(hashes):
        return 0
    bits = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), 1 << 16):
        part = hashes[begin : begin + (1 << 16)]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, fingerprint) of every row, the fingerprint as a long with its 64 bits."""
    small_batches(docs.sparkSession)

    def hashed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 1, SLICE_BYTES):
            found = np.fromiter((fingerprint_of(shingle_hashes(data, words)) for data in text_bytes(batch, "__text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fingerprint"])
        give_back()

    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return rows.mapInArrow(hashed, f"id {rows.schema['__id'].dataType.simpleString()}, fingerprint long")


class BkForest:
    """BK-trees of many shards in arrays: a node's children are keyed by their distance from it.

    Nodes are the fingerprints in their order; the first of a shard is its root. All trees grow together, a level
    at a time: whatever is still to be placed is compared with the node that it has come to, the first of those at
    one distance becomes that node's child, and the others go down to it.
    """

    def __init__(self, shards, fingerprints):
        import numpy as np

        n = len(fingerprints)
        self.fingerprints = fingerprints
        self.shards, first, which = np.unique(shards, return_index=True, return_inverse=True)
        self.roots = first
        parents, distances, children = [], [], []
        left = np.setdiff1d(np.arange(n), first, assume_unique=True)
        at = first[which[left]]
        while len(left):
            d = np.bitwise_count(fingerprints[left] ^ fingerprints[at])
            edge, firsts, member = np.unique(at * 65 + d, return_index=True, return_inverse=True)
            parents.append(edge // 65)
            distances.append(edge % 65)
            children.append(left[firsts])
            placed = np.zeros(len(left), bool)
            placed[firsts] = True
            left, at = left[~placed], left[firsts][member][~placed]
        parent, distance, child = (np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (parents, distances, children))
        order = np.argsort(parent * 65 + distance)
        self.edges, self.children = (parent * 65 + distance)[order], child[order]

    def within(self, shards, queries, radius: int) -> Iterator:
        """(query, node) places of fingerprints of one shard that differ in `radius` bits or fewer.

        From a node at distance d only the edges d - radius to d + radius are followed.
        """
        import numpy as np

        root = np.searchsorted(self.shards, shards)
        known = root < len(self.shards)
        known[known] = self.shards[root[known]] == shards[known]
        stack = [(np.flatnonzero(known), self.roots[root[known]])]
        while stack:
            query, node = stack.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                stack += [(query[half:], node[half:]), (query[:half], node[:half])]
                continue
            d = np.bitwise_count(queries[query] ^ self.fingerprints[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(d - radius, 0))
            counts = np.searchsorted(self.edges, node * 65 + np.minimum(d + radius, 64), "right") - low
            if counts.any():
                offsets = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                stack.append((np.repeat(query, counts), self.children[np.repeat(low, counts) + offsets]))


def _least_reached(n: int, a, b):
    """For n places, the smallest place that links (a, b) reach."""
    import numpy as np

    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        moved = label.copy()
        np.minimum.at(moved, a, low)
        np.minimum.at(moved, b, low)
        np.minimum.at(moved, label[a], low)
        np.minimum.at(moved, label[b], low)
        moved = moved[moved]
        if (moved == label).all():
            return label
        label = moved


def _block(number: int, blocks: int) -> tuple[int, int]:
    """First bit and number of bits of a block of the 64."""
    first = 64 * number // blocks
    return first, 64 * (number + 1) // blocks - first


def shard_keys(fingerprint: Column, radius: int) -> Column:
    """Keys that two fingerprints of `radius` different bits or fewer share one of at least.

    The 64 bits are cut into radius + 2 blocks. Such fingerprints agree in two blocks or more, so each pair of blocks
    is a key: its number and the bits of both.
    """
    keys = []
    for number, pair in enumerate(combinations(range(radius + 2), 2)):
        mask = 0
        for block in pair:
            first, bits = _block(block, radius + 2)
            mask |= ((1 << bits) - 1) << first
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(number).alias("number"), fingerprint.bitwiseAND(F.lit(signed).cast("long")).alias("bits")))
    return F.array(*keys)


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) links among distinct fingerprints (column fingerprint) that join the same as all links within `radius`.

    Every fingerprint goes to a shard for each of its keys (see shard_keys). A shard's fingerprints are dealt into
    trees of about TREE_NODES, and every tree is sent to all parts of its shard's fingerprints, so a tree and
    the queries that meet it have a bounded size however large the shard is. No link is lost; of those that a group
    of trees finds, one a fingerprint is returned, to the smallest that it reaches there.
    """
    keyed = distinct.select("fingerprint", F.explode(shard_keys(F.col("fingerprint"), radius)).alias("key")).select("key.*", "fingerprint")
    shared = keyed.groupBy("number", "bits").count().filter("count > 1")
    parts = F.ceil(F.col("count") / F.lit(TREE_NODES)).cast("int")
    sized = keyed.join(shared, ["number", "bits"]).withColumn("parts", parts)
    sized = sized.withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    # part i's tree meets the queries of parts i and above: 0 both, 1 a tree's node, 2 a query
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    met = F.transform(every, lambda other: F.struct(F.least(other, F.col("part")).alias("tree"), F.greatest(other, F.col("part")).alias("asked"),
                                                    F.when(other == F.col("part"), 0).when(F.col("part") < other, 1).otherwise(2).alias("side")))
    groups = ["number", "bits", "tree", "asked"]
    placed = sized.select("number", "bits", "fingerprint", F.explode(met).alias("m")).select("number", "bits", "m.*", "fingerprint")
    dealt = placed.repartition(*groups).sortWithinPartitions(*groups)

    def searched(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def columns(batch):
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in groups])
            return rows, batch.column("side").to_numpy(zero_copy_only=False), batch.column("fingerprint").to_numpy().view(np.uint64)

        def links(rows, side, prints):
            changed = np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0)])
            shards = np.cumsum(changed)
            nodes, asking = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
            pairs = list(BkForest(shards[nodes], prints[nodes]).within(shards[asking], prints[asking], radius))
            a, b = (np.concatenate([p[i] for p in pairs]) if pairs else np.empty(0, np.int64) for i in (0, 1))
            least = _least_reached(len(prints), asking[a], nodes[b])
            joined = np.flatnonzero(least != np.arange(len(prints)))
            made = [pa.array(prints[i].view(np.int64)) for i in (least[joined], joined)]
            return pa.RecordBatch.from_arrays(made, names=["a", "b"])

        held = None
        for batch in batches:
            new = columns(batch)
            held = new if held is None else tuple(np.concatenate([x, y], -1) for x, y in zip(held, new))
            if held[0].shape[1] < 1 << 16:
                continue
            end = int(np.flatnonzero((held[0] != held[0][:, -1:]).any(0))[-1]) + 1 if (held[0] != held[0][:, -1:]).any() else 0
            if end:  # the last group may go on
                yield links(*(x[..., :end] for x in held))
                held = tuple(x[..., end:] for x in held)
        if held is not None and held[0].shape[1]:
            yield links(*held)

    return dealt.mapInArrow(searched, "a long, b long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint, component_id) for every row of docs.

    Words are parted by bytes of [\\x20\\x09-\\x0D] and A-Z lower-cased; shingles are `words` words joined by a space,
    repeats included, or all words where there are fewer. A bit of the fingerprint (16 hex digits) is set if it is in
    over half the shingles' XXH64 (seed SEED). Rows link when their fingerprints differ in `radius` bits or fewer, and
    component_id is the smallest id that links reach.

    A null text counts as empty; texts without words have fingerprint zero and link like any other. Null ids take part
    and are a component_id only where a component has no other. Repeated rows are returned each. Very long texts
    are hashed whole. Other columns of docs are ignored, whatever their names. An empty table gives no rows.
    """
    rows = materialise(fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = materialise(rows.groupBy("fingerprint").agg(F.min("id").alias("first_id"), F.count("*").alias("n")), "fingerprint-classes")
    links = fingerprint_links(classes.select("fingerprint"), radius)
    labels = connected_components(links)
    named = classes.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    known = materialise(named.join(smallest, "label").select("fingerprint", "n", "component_id"), "fingerprint-components")
    total = classes.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_SHARE > total
    some = known.filter(hot).select("fingerprint", F.col("component_id").alias("hot_id"), F.lit(True).alias("is_hot"))  # HOT_SHARE rows at most
    met = rows.join(F.broadcast(some), "fingerprint", "left")
    # rows of hot fingerprints go anywhere; the others are at most one in HOT_SHARE for each
    place = F.when(F.col("is_hot"), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.col("fingerprint"))
    rest = known.filter(~hot).select(F.col("fingerprint").alias("place"), "component_id")
    joined = met.withColumn("place", place).join(rest, "place", "left")
    component = F.when(F.col("is_hot"), F.col("hot_id")).otherwise(F.col("component_id"))
    return joined.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), component.alias("component_id"))

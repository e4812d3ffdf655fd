"""Jaccard self-join on word n-gram sets by token-combination prefixes, and its connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise, pack, slices, small_batches, text_bytes, unpack, windows, word_hashes
from .components import connected_components

#: Documents that a shingle is frequent in at least; each doubling is a further class, up to FREQUENCY_CLASSES.
FREQUENT, FREQUENCY_CLASSES = 8, 16
#: Bytes of text for each shard that counts shingles, about.
SHARD_BYTES = 6 << 20
#: Bits of a shingle that tell it from others of its shard while it is counted.
SHARD_BITS = 33
#: The map of frequent shingles has 16 places of half a byte for each, 2**MAP_BITS (32 MB) at most; more share places.
MAP_BITS = 26
#: Places of the map that one row has.
SEGMENT_BITS = 16
#: Frequent shingles of a prefix are dealt into groups of about so many to twice as many; pairs of a group are keys.
GROUP_PLACES = 4
#: Bits of the map of documents whose sets are compared.
NEEDED_BITS = 20
#: Bytes of texts that a worker turns into sets at a time, and shingles that it counts at a time.
SLICE_BYTES, COUNTED_SHINGLES = 2 << 20, 1 << 21


@dataclass(frozen=True)
class Link:
    """What links two texts: words of a shingle, and the Jaccard similarity over / under of their sets."""

    words: int = 5
    over: int = 80
    under: int = 100


def shingles(data: bytes | None, n: int):
    """Sorted distinct 64-bit hashes of the word n-grams of a UTF-8 text with A-Z lower-cased.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    import numpy as np

    words = data.lower().split() if data else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    return np.unique(windows(hashes, min(n, len(words))) + np.uint64(0 if len(words) >= n else len(words)))


def least_overlap(a: Column, b: Column, link: Link) -> Column:
    """Fewest common shingles of linked sets of these sizes."""
    return F.ceil((a + b) * link.over / (link.over + link.under))


def may_miss(n: int, link: Link) -> int:
    """Shingles that a set of n may have and a set that it links with may lack, at most."""
    return n - -(-n * link.over // link.under)


def level(n: int, link: Link) -> int:
    """log2 of the number of groups that a set of n shingles deals its frequent ones into."""
    return max(1, may_miss(n, link) // GROUP_PLACES).bit_length() - 1


def _mix(tokens):
    import numpy as np

    mixed = tokens * np.uint64(0x9FB21C651E98DF25)
    mixed ^= mixed >> np.uint64(35)
    return mixed * np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Frequencies:
    """Frequency classes of shingles by a hash of their first bits, two in a byte; shingles that share a place share a class."""

    classes: bytes
    cut: int  # bits of a shingle that aren't looked at
    bits: int  # log2 of the number of places

    def places(self, tokens):
        import numpy as np

        return (_mix(tokens >> np.uint64(self.cut)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, tokens):
        import numpy as np

        places = self.places(tokens)
        return np.frombuffer(self.classes, np.uint8)[places >> 1] >> (4 - 4 * (places & 1)).astype(np.uint8) & 15


def frequency_counts(docs: DataFrame, link: Link) -> tuple[DataFrame, int]:
    """((token, class) of every shingle in FREQUENT documents or more, bits cut off a shingle to make a token).

    Every shingle of every document is counted: tasks send the sorted distinct ones of about COUNTED_SHINGLES
    as packed differences to shards that take a range each, and those add up. Shards follow the bytes of texts, as
    shingles do; more shards keep more bits.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, least = max(1, size // SHARD_BYTES), FREQUENT
    cut = max(0, 64 - SHARD_BITS - (shards - 1).bit_length())

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, size = [], 0

        def flush():
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            shard = ((tokens << np.uint64(cut) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]).tolist() if len(shard) else [0]
            rows = [(int(shard[a]), pack(np.diff(tokens[a:b], prepend=np.uint64(0))), pack(n[a:b].astype(np.uint32))) for a, b in zip(cuts, cuts[1:])]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "tokens", "counts"])

        for batch in slices(batches, 0, SLICE_BYTES):
            for data in text_bytes(batch):
                held.append(shingles(data, link.words) >> np.uint64(cut))
                size += len(held[-1])
                if size > COUNTED_SHINGLES:
                    size = 0
                    yield flush()
        if held:
            yield flush()

    def add_up(table):
        import numpy as np
        import pyarrow as pa

        tokens = np.concatenate([np.cumsum(unpack(x.as_py(), "<u8")) for x in table.column("tokens")])
        counts = np.concatenate([unpack(x.as_py(), "<u4") for x in table.column("counts")])
        distinct, which = np.unique(tokens, return_inverse=True)
        total = np.bincount(which, counts, len(distinct))
        often = total >= least
        kinds = np.minimum(np.floor(np.log2(total[often] / least)) + 1, FREQUENCY_CLASSES - 1)
        return pa.table({"token": pa.array(distinct[often].view(np.int64)), "class": pa.array(kinds.astype(np.int32))})

    asked = docs.select("text").mapInArrow(count, "shard int, tokens binary, counts binary")
    return materialise(asked.groupBy("shard").applyInArrow(add_up, "token long, class int"), "join-frequent"), cut


def _frequencies(docs: DataFrame, link: Link) -> Frequencies:
    """The map of the frequency classes of all frequent shingles; its size follows their number up to 2**MAP_BITS places.

    A place has the highest class of the shingles that fall on it, rare ones with them. Where there are very many, more
    rare shingles share the class of a frequent one; no frequent shingle ever counts as rare. Only the order of
    shingles depends on that, and it is the same for all sets. Places are filled in segments of 2**SEGMENT_BITS by
    tasks, so what comes to the driver is the packed map.
    """
    import numpy as np

    counted, cut = frequency_counts(docs, link)
    n = counted.count()
    found = Frequencies(b"", cut, max(10, min(MAP_BITS, (16 * n - 1).bit_length())) if n else 10)
    segment = min(SEGMENT_BITS, found.bits)

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            places = found.places(batch.column(0).to_numpy().view(np.uint64) << np.uint64(cut))
            kinds = batch.column(1).to_numpy().astype(np.int32)
            codes, order = np.unique(places, return_inverse=True)
            highest = np.zeros(len(codes), np.int32)
            np.maximum.at(highest, order, kinds)
            yield pa.RecordBatch.from_arrays([pa.array(codes >> segment), pa.array(codes & (1 << segment) - 1), pa.array(highest)], names=["segment", "place", "class"])

    def fill(key, table):
        import pyarrow as pa

        classes = np.zeros(1 << segment, np.uint8)
        np.maximum.at(classes, table.column("place").to_numpy(), table.column("class").to_numpy().astype(np.uint8))
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "classes": pa.array([(classes[::2] << 4 | classes[1::2]).tobytes()], pa.binary())})

    placed = counted.select("token", "class").mapInArrow(place, "segment long, place long, class int")
    highest = placed.groupBy("segment", "place").agg(F.max("class").alias("class"))
    filled = highest.groupBy("segment").applyInArrow(fill, "segment long, classes binary").collect()  # 2**(MAP_BITS - 1) bytes at most
    half = 1 << segment >> 1
    whole = bytearray(half << found.bits - segment)
    for row in filled:
        whole[row["segment"] * half : (row["segment"] + 1) * half] = row["classes"]
    return Frequencies(bytes(whole), cut, found.bits)


def _pairs_of_groups(tokens, group):
    """Places (i, j), i before j, of every two tokens of the same group."""
    import numpy as np

    order = np.argsort(group, kind="stable")
    ordered, first, second = group[order], [], []
    for apart in range(1, len(order)):
        same = np.flatnonzero(ordered[apart:] == ordered[:-apart])
        if not len(same):
            break
        first.append(order[same])
        second.append(order[same + apart])
    none = np.zeros(0, np.int64)
    return np.concatenate(first) if first else none, np.concatenate(second) if second else none


def index_keys(tokens, frequencies: Frequencies, link: Link):
    """(prefix, singles, keys of pairs, their weights) that a set is indexed under.

    Shingles are ordered by (frequency class, hash); class 0 is rare. A set's prefix is the shortest whose
    weight is above may_miss(): each rare shingle weighs 1, and of the frequent ones, dealt into groups by
    hash, all but the first of each group. A linked set lacks too few shingles to take away that weight, so
    the two share a rare shingle of both prefixes, or two shingles of one group. Those are the keys: the
    first `singles` shingles of the prefix, and every pair of a group. The number of groups follows the
    set's size, so the keys are in proportion to it; a set is indexed for each number of groups that a linked
    smaller set may have. A key's weight is that of the prefix up to its last shingle. Where linked sets may
    share one shingle alone, frequent shingles are single keys as well.
    """
    import numpy as np

    n = len(tokens)
    missing, kinds = may_miss(n, link), frequencies(tokens)
    order = np.argsort(kinds, kind="stable")
    ordered, rare = tokens[order], int((kinds == 0).sum())
    singles, keys, weights = min(rare, missing + 1), [], []
    end = singles
    if rare <= missing:
        often = ordered[rare:]
        spread = (_mix(often ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(20)).astype(np.int64)
        for groups in range(level(-(-n * link.over // link.under), link), level(n, link) + 1):
            group = spread & ((1 << groups) - 1)
            again = np.ones(len(often), bool)
            again[np.unique(group, return_index=True)[1]] = False
            weight = rare + np.cumsum(again)
            reach = min(len(often), int(np.searchsorted(weight, missing + 1)) + 1)
            i, j = _pairs_of_groups(often[:reach], group[:reach])
            keys.append(_mix(often[i] + np.uint64(groups)) * np.uint64(3) + often[j])
            weights.append(weight[j])
            end = max(end, rare + reach)
        if n <= link.under // link.over:
            singles = min(n, missing + 1)
            end = max(end, singles)
    none = np.zeros(0, np.uint64)
    return ordered[:end], singles, np.concatenate(keys) if keys else none, np.concatenate(weights) if weights else none


def _digests(tokens) -> tuple[int, int]:
    """128 bits that tell a set from all others."""
    import xxhash

    value = xxhash.xxh3_128_intdigest(tokens.tobytes())
    return (value >> 64) - (1 << 63), (value & (1 << 64) - 1) - (1 << 63)


def _indexed(docs: DataFrame, frequencies: Frequencies, link: Link) -> DataFrame:
    """(id, n, high, low, prefix, singles, pairs) of each document: size and digest of its set, and its index keys."""
    sent = docs.sparkSession.sparkContext.broadcast(frequencies)  # 2**(MAP_BITS - 1) bytes at most
    id_type = docs.schema["id"].dataType.simpleString()

    def index(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        frequencies = sent.value

        def lists(arrays, values):
            offsets = np.zeros(len(arrays) + 1, np.int32)
            np.cumsum([len(a) for a in arrays], out=offsets[1:])
            return pa.ListArray.from_arrays(pa.array(offsets), values)

        for batch in slices(batches, 1, SLICE_BYTES):
            sizes, digests, singles, prefixes, keys, weights = [], [], [], [], [], []
            for data in text_bytes(batch):
                tokens = shingles(data, link.words)
                sizes.append(len(tokens))
                digests.append(_digests(tokens) if len(tokens) else (None, None))
                prefix, single, key, weight = index_keys(tokens, frequencies, link) if len(tokens) else (tokens, 0, tokens, tokens)
                for column, value in zip((singles, prefixes, keys, weights), (single, prefix, key, weight)):
                    column.append(value)
            flat = [np.concatenate(x) if x else np.zeros(0) for x in (prefixes, keys, weights)]
            pairs = pa.StructArray.from_arrays([pa.array(flat[1].astype(np.uint64).view(np.int64)), pa.array(flat[2].astype(np.int32))], names=["key", "weight"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), *(pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)),
                 lists(prefixes, pa.array(flat[0].astype(np.uint64).view(np.int64))), pa.array(singles, pa.int32()), lists(keys, pairs)],
                names=["id", "n", "high", "low", "prefix", "singles", "pairs"])

    return docs.mapInArrow(index, f"id {id_type}, n int, high long, low long, prefix array<long>, singles int, pairs array<struct<key:long,weight:int>>")


def _live(batches: Iterator) -> Iterator:
    """Entries of keys that sets share, each with a pivot, from entries sorted by (key, weight, n, node).

    The pivot is a key's first entry in this partition, the set with the fewest rarer shingles; a key with
    many entries fills several partitions and has a pivot in each. A key's only entry is left out, unless
    the partition begins or ends with it, and so is an entry that repeats the one before it.
    """
    import numpy as np
    import pyarrow as pa

    names = ["key", "weight", "n", "node"]
    last, pivot, alone = None, None, None  # the last entry; of the key that the last batch ended in; its entry, if it has been the only one

    def out(rows, pivots):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in rows] + [pa.array(c) for c in pivots], names=names + ["p_weight", "p_n", "p_node"])

    def lone(columns):
        return out([np.array([v], c.dtype) for v, c in zip(alone, columns)], [np.array([v], c.dtype) for v, c in zip(pivot[1:], columns[1:])])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(4)]
        again = np.r_[last == (columns[0][0], columns[3][0]), (columns[0][1:] == columns[0][:-1]) & (columns[3][1:] == columns[3][:-1])]
        begins, last = last is None, (columns[0][-1], columns[3][-1])
        columns = [c[~again] for c in columns]
        key, n = columns[0], len(columns[0])
        if not n:
            continue
        new = np.r_[True, key[1:] != key[:-1]]
        if pivot is not None and key[0] == pivot[0]:
            new[0] = False
            if alone is not None:
                yield lone(columns)
            alone = None
        starts = np.flatnonzero(new)
        head = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        pivots = [np.where(head >= 0, c[np.maximum(head, 0)], 0 if pivot is None else p).astype(c.dtype)
                  for c, p in zip(columns[1:], (pivot or [0] * 4)[1:])]
        counts = np.diff(np.r_[starts, n])
        shared = np.ones(n, bool)
        single = starts[counts == 1]
        shared[single] = False
        shared[0] |= begins
        alone = tuple(c[-1] for c in columns) if not shared[-1] else None
        if len(starts):
            pivot = tuple(c[starts[-1]] for c in columns)
        if shared.any():
            yield out([c[shared] for c in columns], [p[shared] for p in pivots])
    if alone is not None:
        yield lone(columns)


def _sets(docs: DataFrame, nodes: DataFrame, link: Link) -> DataFrame:
    """(node, tokens) of nodes (node, id, high, low): their documents are shingled again, picked by a map of ids."""
    import numpy as np

    place = F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string")), 64 - NEEDED_BITS)
    needed = nodes.select(place.cast("int").alias("place")).distinct().toArrow().column("place").to_numpy()  # 2**NEEDED_BITS at most
    bits = np.zeros(1 << NEEDED_BITS, bool)
    bits[needed] = True
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())

    def again(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits = np.unpackbits(np.frombuffer(sent.value, np.uint8)).astype(bool)
        for batch in slices(batches, 0, SLICE_BYTES):
            batch = batch.filter(pa.array(bits[batch.column(1).to_numpy(zero_copy_only=False)]))
            found = [shingles(data, link.words) for data in text_bytes(batch)]
            found = [t for t in found if len(t)]
            digests = [_digests(t) for t in found]
            yield pa.RecordBatch.from_arrays([*(pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)), pa.array([t.view(np.int64) for t in found], pa.list_(pa.int64()))], names=["high", "low", "tokens"])

    found = docs.select("text", place.cast("int").alias("place")).mapInArrow(again, "high long, low long, tokens array<long>")
    return found.join(nodes.select("node", "high", "low"), ["high", "low"]).groupBy("node").agg(F.first("tokens").alias("tokens"))


def _sides(pairs: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """pairs (a, b) with columns of both nodes, named a_* and b_*."""
    for side in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
    return pairs


def _close(pairs: DataFrame, nodes: DataFrame, link: Link) -> DataFrame:
    """Pairs whose prefixes leave room for a link: every common shingle is in both prefixes or behind the one
    that ends first, so there are at most as many as the prefixes share and the longer rest holds."""
    met = _sides(pairs, nodes, "prefix", "n")
    rest = F.greatest(*[F.col(f"{s}_n") - F.size(f"{s}_prefix") for s in "ab"])
    return met.filter(F.size(F.array_intersect("a_prefix", "b_prefix")) + rest >= least_overlap(F.col("a_n"), F.col("b_n"), link)).select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, link: Link) -> DataFrame:
    """Pairs (a, b) of nodes whose sets link: whole sets are made for those that remain after _close()."""
    close = materialise(_close(pairs, nodes, link), "join-close")
    wanted = close.select(F.col("a").alias("node")).unionByName(close.select(F.col("b").alias("node"))).distinct()
    sets = materialise(_sets(docs, nodes.select("node", "id", "high", "low").join(wanted, "node", "left_semi"), link), "join-sets")
    met = _sides(close, sets, "tokens")
    common, both = F.size(F.array_intersect("a_tokens", "b_tokens")), F.size("a_tokens") + F.size("b_tokens")
    return materialise(met.filter(link.under * common >= link.over * (both - common)).select("a", "b"), "join-links")


def _can_link(x: str, y: str, link: Link) -> Column:
    """Whether sets with these sizes that first meet at these weights can have enough in common."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    least = least_overlap(n, m, link)
    fits = (link.under * n >= link.over * m) & (link.under * m >= link.over * n)
    for side, size in ((x, n), (y, m)):
        fits &= F.col(f"{side}weight") <= size - least + 1
    return fits


def _band(n: Column, link: Link) -> Column:
    """Number of a band of sizes; sets that link are in the same or in neighbouring bands."""
    return F.floor(F.log(n.cast("double")) / math.log(link.under / link.over) + 1e-9).cast("int") if link.over < link.under else n


def _pairs(x: str, y: str) -> list[Column]:
    return [F.least(f"{x}node", f"{y}node").alias("a"), F.greatest(f"{x}node", f"{y}node").alias("b")]


def ngram_join(docs: DataFrame, link: Link = Link(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose shingle sets link, without comparing all pairs of a group.

    Documents with the same set are one node. Nodes are indexed by index_keys(), and the entries are dealt
    into ranges of (key, weight, size, node), so that a key that very many sets have fills several tasks. In
    each task's entries of a key the node with the fewest rarer shingles is the pivot; every other is
    compared with it, and links join components. What is left are pairs of nodes in different components
    that share a key and whose sizes and weights allow a link: classes of entries (key, component, size,
    weight) meet first, in bands of sizes, then the nodes of those classes, and every such pair is compared.
    So each linked pair is either compared or already in one component, while a group of near copies costs a
    comparison for each member and not for each pair. Comparisons are of whole sets of 64-bit hashes; sets
    are told apart by 128 bits.

    Returns (id, n_shingles, component_id), a row for every document: component_id is the smallest id that
    links reach. Null texts and texts without words have no shingles and link with nothing: component_id is
    their own id. Null ids take part and never are a component_id unless a component has no other. Repeated
    rows are returned each; rows with the same id and different sets are nodes of their own. Very long texts
    are whole sets like any other. Empty table: no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    indexed = materialise(_indexed(rows, _frequencies(rows, link), link), "join-index")
    digest = ["high", "low"]
    one = indexed.filter("n > 0").groupBy(*digest).agg(F.min("id").alias("first_id"))
    met = indexed.filter("n > 0").join(one, digest).filter(F.col("id").eqNullSafe(F.col("first_id"))).drop("first_id").dropDuplicates(digest)
    nodes = materialise(met.withColumn("node", F.monotonically_increasing_id()), "join-nodes")
    single = F.transform(F.slice("prefix", 1, F.col("singles")), lambda key, at: F.struct(key.alias("key"), (at + 1).alias("weight")))
    entries = nodes.select("node", "n", F.explode(F.concat(single, "pairs")).alias("e")).select("e.key", "e.weight", "n", "node")
    order = ["key", "weight", "n", "node"]
    sorted_entries = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    live = materialise(sorted_entries.mapInArrow(_live, "key long, weight int, n int, node long, p_weight int, p_n int, p_node long"), "join-entries")
    mine = live.select("key", *[F.col(c).alias(f"x_{c}") for c in order[1:]], *[F.col(f"p_{c}") for c in order[1:]])
    starred = mine.filter((F.col("x_node") != F.col("p_node")) & _can_link("x_", "p_", link)).select(*_pairs("x_", "p_")).distinct()
    starred = materialise(starred, "join-pairs")
    links = _verified(starred, rows, nodes, link)
    labels = connected_components(links)
    placed = live.select(*order).join(labels, "node", "left")
    placed = materialise(placed.withColumn("label", F.coalesce("label", "node")), "join-placed")
    split = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("key")
    open_entries = materialise(placed.join(split, "key", "left_semi"), "join-open")
    kinds = ["key", "label", "weight", "n"]
    classes = open_entries.select(*kinds).distinct()
    x = classes.select("key", *[F.col(c).alias(f"x_{c}") for c in kinds[1:]]).withColumn("band", _band(F.col("x_n"), link))
    y = classes.select("key", *[F.col(c).alias(f"y_{c}") for c in kinds[1:]])
    y = y.withColumn("band", F.explode(F.array(*[_band(F.col("y_n"), link) + i for i in (-1, 0, 1)])))
    meet = x.join(y, ["key", "band"]).drop("band").filter((F.col("x_label") < F.col("y_label")) & _can_link("x_", "y_", link))
    members = {s: open_entries.select("key", *[F.col(c).alias(f"{s}{c}") for c in [*kinds[1:], "node"]]) for s in ("x_", "y_")}
    left = meet.join(members["x_"], ["key", *[f"x_{c}" for c in kinds[1:]]]).join(members["y_"], ["key", *[f"y_{c}" for c in kinds[1:]]])
    rest = materialise(left.select(*_pairs("x_", "y_")).distinct().join(starred, ["a", "b"], "left_anti"), "join-rest")
    more = _verified(rest, rows, nodes, link)
    if not more.isEmpty():
        labels = connected_components(links.unionByName(more))
    named = nodes.select("node", "id", *digest).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("id").alias("component_id"))
    of_node = named.join(smallest, "label").select(*digest, "component_id")
    joined = indexed.select("id", "n", *digest).join(of_node, digest, "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return joined.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))


def one_of_each_component(docs: DataFrame, link: Link = Link(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose id is the smallest of their component; rows that link with nothing stay.

    A row with a null id stays only where its component has no other id.
    """
    components = ngram_join(docs, link, id_col, text_col)
    keep = components.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("__id")).distinct()
    return docs.join(keep, docs[id_col].eqNullSafe(F.col("__id")), "left_semi")

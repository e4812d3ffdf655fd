"""Token-id files: raw id payloads in segments, each with a minimal perfect hash index of its documents' keys."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from operator import attrgetter

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.sources.shared import shared_folder

from .bpe import CACHE_ENTRIES, TextEncoder
from .common import kept

#: Ids after which a segment ends; a longer document has a segment of its own.
SEGMENT_IDS = 1 << 16
#: Keys for each bucket of the hash function, on average.
BUCKET_KEYS = 4
#: Displacements that are tried at a time for a bucket, at first and at most.
FIRST_TRIED, MOST_TRIED = 16, 1 << 12
#: Entries of a worker's caches; this encoder is its only one, and its new words cost most.
CACHED = 2 * CACHE_ENTRIES
#: Pieces that the library's model gets in one call.
JOINED_PIECES = 32
_MASK = (1 << 64) - 1


def _mix(x: int) -> int:
    """A 64-bit finaliser (splitmix64)."""
    x = (x + 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)


def _place(hashed: int, displacement: int, n: int) -> int:
    return _mix(hashed ^ _mix(displacement)) % n


def _places(hashed, displacements, n: int):
    """_place() of each hash (a row) by each displacement (a column)."""
    import numpy as np

    def mix(x):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    return (mix(hashed[:, None] ^ mix(displacements)) % np.uint64(n)).astype(np.int64)


def build_index(keys: list[int], offsets: list[int], lengths: list[int]) -> bytes:
    """A minimal perfect hash of distinct keys to (fingerprint, offset, length), as little-endian words.

    Hash and displace: keys fall into buckets; from the fullest bucket on, each gets the first displacement
    that puts its keys into free slots. Words: n, buckets; displacements; fingerprints; offsets; lengths.
    """
    import numpy as np

    n = len(keys)
    n_buckets = max(1, -(-n // BUCKET_KEYS))
    hashed = np.fromiter((_mix(key & _MASK) for key in keys), np.uint64, n)
    bucket = (hashed >> np.uint64(32)) % np.uint64(n_buckets)
    order, sizes = np.argsort(bucket, kind="stable"), np.bincount(bucket.astype(np.int64), minlength=n_buckets)
    starts = np.cumsum(sizes) - sizes
    displacements, slots, free = np.zeros(n_buckets, "<u4"), np.zeros((3, n), "<u4"), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable").tolist():
        if not sizes[b]:
            break
        held = order[starts[b] : starts[b] + sizes[b]]
        begin, tried = 0, FIRST_TRIED
        while True:  # many displacements at a time, the more the longer none is found
            places = _places(hashed[held], np.arange(begin, begin + tried, dtype=np.uint64), n)
            fits = free[places].all(axis=0)
            if len(held) > 1:
                ordered = np.sort(places, axis=0)
                fits &= (ordered[1:] != ordered[:-1]).all(axis=0)
            if fits.any():
                break
            begin, tried = begin + tried, min(2 * tried, MOST_TRIED)
        d = int(fits.argmax())
        displacements[b] = begin + d
        free[places[:, d]] = False
        slots[:, places[:, d]] = hashed[held] & np.uint64(0xFFFFFFFF), np.take(offsets, held), np.take(lengths, held)
    return np.array([n, n_buckets], "<u4").tobytes() + displacements.tobytes() + slots.tobytes()


class Segment:
    """Keyed access to the ids of one segment in constant time."""

    def __init__(self, index: bytes, payload: bytes):
        import numpy as np

        words = np.frombuffer(index, "<u4")
        self.n, self.n_buckets = int(words[0]), int(words[1])
        self.displacements = words[2 : 2 + self.n_buckets].tolist()
        self.slots = list(zip(*words[2 + self.n_buckets :].reshape(3, self.n).tolist()))
        self.payload = payload

    def find(self, key: int) -> tuple[int, int] | None:
        """(offset, length) in ids; None where the fingerprint shows that the key isn't here."""
        if not self.n:
            return None
        hashed = _mix(key & _MASK)
        slot = _place(hashed, self.displacements[(hashed >> 32) % self.n_buckets], self.n)
        fingerprint, offset, length = self.slots[slot]
        return (offset, length) if fingerprint == hashed & 0xFFFFFFFF else None

    def ids(self, key: int) -> bytes | None:
        at = self.find(key)
        return None if at is None else self.payload[4 * at[0] : 4 * (at[0] + at[1])]


def _library_encoder(path: str, pattern: str) -> TextEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return TextEncoder(_model_encoder(tokenizer.model, tokenizer.get_vocab(with_added_tokens=False)), pattern, CACHED)


def _model_encoder(model, vocabulary: dict[str, int]) -> Callable[[list[str]], tuple]:
    """Pieces to their ids by a byte-level model of the library: an array of all ids and how many each piece has.

    No text in UTF-8 has the byte 0xFF. Where no token of the model but that byte's own has it either, nothing merges across
    it, so pieces with that byte after each are encoded JOINED_PIECES in one call and parted at its id.
    """
    import numpy as np

    # byte-level models spell bytes as characters; the library's own pre-tokenizer tells which
    table = str.maketrans({bytes([b]).decode("latin-1"): _spelling(b) for b in range(256)})
    mark = _spelling(255)
    by_word = any(getattr(model, name, True) for name in ("ignore_merges", "continuing_subword_prefix", "end_of_word_suffix", "dropout"))

    def one_by_one(pieces: list[str]) -> tuple:
        coded = [list(map(id_of, model.tokenize(piece.encode().decode("latin-1").translate(table)))) for piece in pieces]
        return np.fromiter(chain.from_iterable(coded), "<u4"), list(map(len, coded))

    def joined(pieces: list[str]) -> tuple:
        groups = (pieces[a : a + JOINED_PIECES] for a in range(0, len(pieces), JOINED_PIECES))
        spelled = [(b"\xff".join(map(str.encode, group)) + b"\xff").decode("latin-1").translate(table) for group in groups]
        ids = np.fromiter(map(id_of, chain.from_iterable(map(model.tokenize, spelled))), "<u4")
        ends = ids == parting
        stops = np.flatnonzero(ends)
        if len(stops) != len(pieces):
            raise ValueError(f"{len(pieces)} pieces came back as {len(stops)}")
        return ids[~ends], np.diff(stops, prepend=-1) - 1

    parting, id_of = vocabulary.get(mark), attrgetter("id")
    return one_by_one if by_word or [token for token in vocabulary if mark in token] != [mark] else joined


class DocumentEncoder:
    """Whole texts to ids as the library's encode(): texts are split at the file's added tokens, which have ids of
    their own, and each section between them is encoded as a text. Of tokens that begin at one place the longest counts.
    """

    def __init__(self, sections: TextEncoder, added: dict[str, int]):
        import regex

        self.sections, self.ids = sections, {token: i.to_bytes(4, "little") for token, i in added.items()}
        ordered = sorted(added, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")").split if added else None

    def groups(self, texts) -> Iterator[tuple[int, list[bytes]]]:
        """As TextEncoder.groups, for an Arrow array."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts, found = pc.fill_null(texts, ""), np.zeros(len(texts), bool)
        for token in self.ids:
            found |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        places = np.flatnonzero(found).tolist()
        cut = {i: self.split(texts[i].as_py()) for i in places}  # section, token, section, ...
        if cut:
            texts = pc.replace_with_mask(texts, pa.array(found), pa.array([cut[i][0] for i in places], texts.type))
        for begin, group in self.sections.groups(texts):
            held = [i for i in places if begin <= i < begin + len(group)]
            coded = iter(self.sections.encode([s for i in held for s in cut[i][2::2]])) if held else None
            for i in held:
                group[i - begin] += b"".join([self.ids[token] + next(coded) for token in cut[i][1::2]])
            yield begin, group


def _document_encoder(path: str, pattern: str) -> DocumentEncoder:
    return kept(("library", path, pattern), lambda: _make_document_encoder(path, pattern))


def _make_document_encoder(path: str, pattern: str) -> DocumentEncoder:
    from tokenizers import Tokenizer

    added = Tokenizer.from_file(path).get_added_tokens_decoder()
    for token in added.values():
        if token.single_word or token.lstrip or token.rstrip:
            raise ValueError(f"added token {token.content!r} takes in or depends on its neighbours, which isn't supported")
    return DocumentEncoder(_library_encoder(path, pattern), {token.content: i for i, token in added.items()})


def _spelling(byte: int) -> str:
    """The character that a byte-level model writes for a byte: itself where printable, else the next from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    if byte in printable:
        return chr(byte)
    return chr(256 + sum(b not in printable for b in range(byte)))


SEGMENT_SCHEMA = ("part int, segment int, before long, n_docs int, n_ids long, first_key long, last_key long, "
                  "keys array<bigint>, lengths array<int>, index binary, payload binary")


def write_tokens(docs: DataFrame, folder: str, path: str, pattern: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts, append end_id to each, and write the ids in ascending order of the (integer) id column.

    The file's added tokens are matched in texts, as the library does by default.

    Rows are dealt into ranges of the id and sorted there; each range writes its segments: payload (ids as
    little-endian unsigned 32-bit integers), keys and lengths in order, the hash index, and `before`, the
    ids of the range before it. `folder`/parts has the ids before each range. Spark commits the files, so a
    task that is run again leaves no second copy. Null and empty texts have end_id alone. Rows with a null
    id come last and are stored without a key. Of equal ids the index knows the first of a segment; the
    others follow it. An empty table writes no segments.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(F.col("key").asc_nulls_last()).sortWithinPartitions(F.col("key").asc_nulls_last())
    end = end_id.to_bytes(4, "little")

    def segments(batches: Iterator) -> Iterator:
        import pyarrow as pa

        coder, part = _document_encoder(path, pattern), TaskContext.get().partitionId()
        kinds = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int32()), ("n_ids", pa.int64()),
                           ("first_key", pa.int64()), ("last_key", pa.int64()), ("keys", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
                           ("index", pa.binary()), ("payload", pa.binary())])
        number, before, keys, lengths, parts, held = 0, 0, [], [], [], 0

        def close():
            nonlocal number, before, keys, lengths, parts, held
            at, seen, of = 0, set(), ([], [], [])
            for key, n in zip(keys, lengths):
                if key is not None and key not in seen:
                    seen.add(key)
                    for column, value in zip(of, (key, at, n)):
                        column.append(value)
                at += n
            known = [k for k in keys if k is not None]
            row = [part, number, before, len(keys), held, known[0] if known else None, known[-1] if known else None,
                   keys, lengths, build_index(*of), b"".join(parts)]
            number, before = number + 1, before + held
            keys, lengths, parts, held = [], [], [], 0
            return pa.RecordBatch.from_pydict(dict(zip(kinds.names, ([x] for x in row))), schema=kinds)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for begin, group in coder.groups(batch.column(1)):
                for key, coded in zip(ids[begin:], group):
                    coded += end
                    if keys and held + len(coded) // 4 > SEGMENT_IDS:
                        yield close()
                    keys.append(key)
                    lengths.append(len(coded) // 4)
                    parts.append(coded)
                    held += len(coded) // 4
        if keys:
            yield close()

    made = rows.mapInArrow(segments, SEGMENT_SCHEMA)
    made.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(f"{folder}/segments")
    spark = docs.sparkSession
    totals = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{folder}/segments").groupBy("part").agg(F.sum("n_ids").alias("n"))
    line = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    totals.select("part", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("part_start")).write.parquet(f"{folder}/parts")


def open_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The segments of a token file with part_start, the ids before their range."""
    parts = spark.read.schema("part int, part_start long").parquet(f"{folder}/parts")
    return spark.read.schema(SEGMENT_SCHEMA).parquet(f"{folder}/segments").join(parts, "part")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) for every document of a token file, each found through the index.

    start counts the ids of all documents before it. Repeated ids and null ids, which the index doesn't
    tell apart, are taken in the order in which they are stored.
    """
    def documents(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                segment, place, out = Segment(row["index"], row["payload"]), 0, ([], [], [], [])
                previous, base = None, row["part_start"] + row["before"]
                for key, n in zip(row["keys"], row["lengths"]):
                    at = (place, n) if key is None or key == previous else segment.find(key)
                    if at != (place, n):
                        raise ValueError(f"the index of segment {row['part']}/{row['segment']} doesn't agree with its keys")
                    ids = row["payload"][4 * at[0] : 4 * (at[0] + at[1])]
                    for column, value in zip(out, (key, base + at[0], n, zlib.crc32(ids))):
                        column.append(value)
                    place, previous = place + n, key
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    columns = ("part", "segment", "before", "part_start", "keys", "lengths", "index", "payload")
    return open_tokens(spark, folder).select(*columns).mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(spark: SparkSession, folder: str, keys: list[int]) -> DataFrame:
    """(key, ids) for the given keys: segments are pruned by their key bounds, ids found through the index.

    Keys that the file lacks give no row; of a key that is stored more than once, the first of each segment.
    """
    wanted = sorted(set(keys))
    bounds = F.lit(False)
    for key in wanted:
        bounds |= (F.col("first_key") <= key) & (F.col("last_key") >= key)

    def find(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row["index"], row["payload"])
                got = [(k, segment.ids(k)) for k in wanted if row["first_key"] <= k <= row["last_key"]]
                got = [(k, np.frombuffer(ids, "<i4")) for k, ids in got if ids is not None]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.int64()), pa.array([ids for _, ids in got], pa.list_(pa.int32()))], names=["key", "ids"])

    return open_tokens(spark, folder).filter(bounds).select("first_key", "last_key", "index", "payload").mapInArrow(find, "key long, ids array<int>")


def new_folder(spark: SparkSession, label: str = "tokens") -> str:
    import uuid

    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"

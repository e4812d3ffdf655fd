"""Byte-level BPE encoding and decoding with a rank queue made of hierarchical bitmaps."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

from pyspark.sql import DataFrame, functions as F

from .common import give_back, kept, small_batches

#: Entries that a worker's caches of encoded chunks and pieces hold before they start anew.
CACHE_ENTRIES = 1 << 19
#: Longer chunks are encoded each time.
CACHE_CHARS = 64
#: Characters that often end a word.
PUNCTUATION = ".,;:!?#$%&*|"
#: Bytes of the texts that a worker encodes together, about; a longer text is a group of its own.
GROUP_BYTES = 1 << 23
#: Pieces that one queue merges.
MERGED_PIECES = 1 << 14


class RankQueue:
    """Positions by merge rank. Three levels of 64-bit words tell which ranks have positions, so that the
    lowest is three find-first-set steps away; positions of one rank come out from left to right."""

    def __init__(self, n_ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * ((n_ranks >> 6) + 1)
        self.mid = [0] * ((n_ranks >> 12) + 1)
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
            return
        self.buckets[rank] = [position]
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << ((rank >> 6) & 63)
        self.top |= 1 << (rank >> 12)

    def fill(self, ranks) -> None:
        """Push every position of an array of ranks that isn't negative; the queue is empty before."""
        import numpy as np

        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0) :]
        cuts = np.flatnonzero(np.diff(ranks[order])) + 1
        for bucket in np.split(order, cuts):
            if len(bucket):
                rank = int(ranks[bucket[0]])
                self.push(rank, -1)
                self.buckets[rank] = bucket.tolist()

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank and its positions from left to right, taken out; rank -1 when empty."""
        top = self.top
        if not top:
            return -1, []
        a = (top & -top).bit_length() - 1
        word = self.mid[a]
        b = (a << 6) | ((word & -word).bit_length() - 1)
        word = self.low[b]
        rank = (b << 6) | ((word & -word).bit_length() - 1)
        self.low[b] &= ~(1 << (rank & 63))
        if not self.low[b]:
            self.mid[a] &= ~(1 << (b & 63))
            if not self.mid[a]:
                self.top &= ~(1 << a)
        positions = self.buckets.pop(rank)
        positions.sort()
        return rank, positions


class Merger:
    """Merges of many pieces of bytes at once: one linked list of tokens and a RankQueue of pairs that can merge.

    Pieces lie one after the other and no pair goes from one to the next, so taking the lowest rank of all,
    then the leftmost place, is the lowest and leftmost in each piece as well.
    """

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np

        self.ranks = ranks
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.of_two = np.full(1 << 16, -1, np.int64)  # rank of each two bytes
        for token, rank in ranks.items():
            if len(token) == 2:
                self.of_two[token[0] << 8 | token[1]] = rank

    def ids(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece; a piece that is a token is that token."""
        import numpy as np

        ranks, queue, get = self.ranks, self.queue, self.ranks.get
        joined = b"".join(pieces)
        n = len(joined)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        stops = np.cumsum(lengths)
        data, pairs = np.frombuffer(joined, np.uint8).astype(np.int64), np.full(n, -1, np.int64)
        pairs[:-1] = self.of_two[data[:-1] << 8 | data[1:]] if n else 0
        pairs[stops[lengths > 0] - 1] = -1
        known = np.fromiter((p in ranks for p in pieces), bool, len(pieces))
        pairs[np.repeat(known, lengths)] = -1
        queue.fill(pairs)
        pair = pairs.tolist()  # rank of the pair that begins here; -1: none
        last = bytearray(n + 1)  # last[i]: a piece ends before i
        for at in stops.tolist():
            last[at] = 1
        end = list(range(1, n + 1))  # of the token that begins here
        before = list(range(-1, n - 1))
        for at in (stops - lengths)[lengths > 0].tolist():
            before[at] = -1
        buckets, push = queue.buckets, queue.push
        while True:
            rank, places = queue.pop()
            if rank < 0:
                break
            for k, i in enumerate(places):
                if pair[i] != rank:
                    continue  # stale: this place has merged since
                j = end[i]
                stop = end[i] = end[j]
                pair[j] = pair[i] = -1
                lowest = rank + 1
                if not last[stop]:
                    before[stop] = i
                    made = get(joined[i : end[stop]])
                    if made is not None:
                        pair[i] = made
                        if made in buckets:
                            buckets[made].append(i)
                        else:
                            push(made, i)
                        lowest = made
                left = before[i]
                if left >= 0:
                    made = get(joined[left:stop])
                    if made is None:
                        pair[left] = -1
                    else:
                        pair[left] = made
                        if made in buckets:
                            buckets[made].append(left)
                        else:
                            push(made, left)
                        if made < lowest:
                            lowest = made
                if lowest <= rank:  # a pair that comes before the rest of this bucket
                    for later in places[k + 1 :]:
                        push(rank, later)
                    break
        out, at = [], 0
        for piece in pieces:
            stop = at + len(piece)
            if (whole := get(piece)) is not None:
                out.append([whole])
            else:
                ids = []
                while at < stop:
                    ids.append(ranks[joined[at : end[at]]])
                    at = end[at]
                out.append(ids)
            at = stop
        return out


class TextEncoder:
    """Whole texts to ids as little-endian unsigned 32-bit integers.

    A text is what its pattern's matches encode to, one after the other. Where no white space comes in runs,
    no match goes across a single space or line feed except from there on, so such texts are cut there
    first: the chunks repeat far more than they differ, and a chunk that a worker has met is one look-up.
    Other texts are cut by the pattern alone. encode_pieces gets the pieces that are new in a group of texts
    together, and returns an array of their ids, one piece after the other, and how many each has.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], tuple], pattern: str, entries: int = CACHE_ENTRIES, group_bytes: int = GROUP_BYTES):
        import regex

        self.entries, self.group_bytes = entries, group_bytes
        # regex counts \x1c-\x1f as white space, Unicode's property (which the reference libraries use) doesn't
        self.find = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")).findall
        # a run of letters is one match with the space before it, and punctuation after it another
        self.letters_whole = r" ?\p{L}+" in pattern and r" ?[^\s\p{L}\p{N}]+" in pattern
        self.encode_pieces = encode_pieces
        self.after_space: dict[str, bytes] = {}  # chunks, and pieces without their first space
        self.older: dict[str, bytes] = {}  # the generation before
        self.bare: dict[str, bytes] = {}  # other pieces

    def _cut(self, chunk: str) -> list[str]:
        """The pattern's matches in a chunk, which a space comes before unless it begins with a line feed."""
        if chunk[:1] == "\n":
            if self.letters_whole and chunk[1:].isalpha():
                return ["\n", chunk[1:]]
            return self.find(chunk)
        return self.find(" " + chunk)

    def _coded(self, pieces: list[str]) -> Iterator[bytes]:
        """Each piece encoded, MERGED_PIECES at a time."""
        import numpy as np

        for begin in range(0, len(pieces), MERGED_PIECES):
            ids, counts = self.encode_pieces(pieces[begin : begin + MERGED_PIECES])
            flat, stops = ids.astype("<u4", copy=False).tobytes(), (4 * np.cumsum(counts)).tolist()
            yield from [flat[a:b] for a, b in zip([0, *stops], stops)]

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Runs of letters encoded with a space before each; those that no cache has are encoded together and remembered."""
        spaced, older = self.after_space, self.older
        values = list(map(spaced.get, words))
        fresh = dict.fromkeys([word for word, value in zip(words, values) if value is None])
        if older:
            fresh.update([(word, older[word]) for word in fresh if word in older])
        new = [word for word, value in fresh.items() if value is None]
        fresh.update(zip(new, self._coded([" " + word for word in new])))
        spaced.update(fresh if max(map(len, fresh), default=0) <= CACHE_CHARS else {w: v for w, v in fresh.items() if len(w) <= CACHE_CHARS})
        return [value or fresh[word] for word, value in zip(words, values)]

    def _pieces(self, cut: list[list[str]]) -> list[bytes]:
        """Each list of pieces encoded; pieces that are new are encoded together and remembered."""
        spaced, bare, fresh = self.after_space, self.bare, {}
        every = [*{p for pieces in cut for p in pieces if (p[1:] not in spaced if p[0] == " " and p[:2] != " \n" else p not in bare)}]
        for piece, value in zip(every, self._coded(every)):
            fresh[piece] = value
            if len(piece) > CACHE_CHARS:
                continue
            if piece[0] == " " and piece[:2] != " \n":
                spaced[piece[1:]] = value
            else:
                bare[piece] = value
        return [b"".join([fresh.get(p) or (spaced[p[1:]] if p[0] == " " and p[:2] != " \n" else bare[p]) for p in pieces]) for pieces in cut]

    def encode(self, texts) -> list[bytes]:
        """Each text of a list or an Arrow array; nulls have no ids."""
        return [coded for _, group in self.groups(texts) for coded in group]

    def groups(self, texts) -> Iterator[tuple[int, list[bytes]]]:
        """encode() in groups of about GROUP_BYTES, with the place of each group's first text."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = pc.fill_null(texts, "")
        groups = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // self.group_bytes
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(texts)]
        for begin, end in zip(cuts, cuts[1:]):
            yield begin, self._encode(texts.slice(begin, end - begin))
        give_back()

    def _encode(self, texts) -> list[bytes]:
        import numpy as np
        import pyarrow.compute as pc

        if len(self.after_space) > self.entries // 2:  # what isn't met again while this fills anew is forgotten
            self.older, self.after_space = self.after_space, {}
        if len(self.bare) > self.entries // 2:
            self.bare.clear()
        marked = pc.replace_substring(texts, "\n", " \n")
        in_runs = pc.or_(pc.match_substring(marked, "  "), pc.match_substring(texts, "\n\n")).to_numpy(zero_copy_only=False)
        in_runs |= np.array([last.isspace() for last in pc.utf8_slice_codeunits(texts, -1).to_pylist()], bool)
        split = pc.split_pattern(pc.if_else(in_runs, "", marked), " ")
        offsets = split.offsets.to_numpy()
        words = split.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        # what no space or line feed comes before: the first chunk, or a text whose white space is in runs
        firsts = words.take(offsets[:-1]).to_pylist()
        heads = [self.find(first) for first in firsts]
        for i in np.flatnonzero(in_runs).tolist():
            heads[i] = self.find(texts[i].as_py())
        heads = self._pieces(heads)
        # the other chunks: each distinct one is looked up, or encoded, once
        coded = words.dictionary_encode()
        distinct, which = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        values = list(map(self.after_space.get, distinct))
        new = [i for i, value in enumerate(values) if value is None and distinct[i]]
        if self.older:
            found = list(map(self.older.get, [distinct[i] for i in new]))
            for i, value in zip(new, found):
                if value is not None:
                    values[i] = self.after_space[distinct[i]] = value
            new = [i for i, value in zip(new, found) if value is None]
        if self.letters_whole:  # a chunk of letters is one piece, with punctuation after it two
            letters = [distinct[i].rstrip(PUNCTUATION) for i in new]
            whole = [(i, word) for i, word in zip(new, letters) if word.isalpha()]
            new = [i for i, word in zip(new, letters) if not word.isalpha()]
            tails = [distinct[i][len(word) :] for i, word in whole]
            ends = {tail: value for (tail,), value in zip(kinds, self._pieces(kinds))} if (kinds := [[t] for t in {*tails} if t]) else {}
            for (i, word), tail, value in zip(whole, tails, self._spaced([word for _, word in whole])):
                if tail:
                    value += ends[tail]
                    if len(distinct[i]) <= CACHE_CHARS:
                        self.after_space[distinct[i]] = value
                values[i] = value
        for i, value in zip(new, self._pieces([self._cut(distinct[i]) for i in new])):
            values[i] = value
            if len(distinct[i]) <= CACHE_CHARS:
                self.after_space[distinct[i]] = value
        values = [value or b"" for value in values]
        ids, sizes = np.frombuffer(b"".join(values), "<u4"), np.fromiter(map(len, values), np.int64, len(values)) // 4
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[which]
        lengths[offsets[:-1]] = 0  # those are in heads
        ends = np.cumsum(lengths)
        places = np.repeat(starts[which] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        flat, bounds = ids[places].tobytes(), np.r_[0, ends][offsets] * 4
        return [head + flat[begin:end] for head, begin, end in zip(heads, bounds[:-1].tolist(), bounds[1:].tolist())]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _coder(path: str, pattern: str) -> tuple[TextEncoder, list[bytes]]:
    return kept(("bpe", path, pattern), lambda: _make_coder(path, pattern))


def _make_coder(path: str, pattern: str) -> tuple[TextEncoder, list[bytes]]:
    ranks = load_ranks(path)
    merger = Merger(ranks)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token

    def merged(pieces: list[str]) -> tuple:
        import numpy as np

        coded = merger.ids([p.encode() for p in pieces])
        return np.fromiter(chain.from_iterable(coded), "<u4"), list(map(len, coded))

    return TextEncoder(merged, pattern, CACHE_ENTRIES // 4, GROUP_BYTES // 8), table


def encode_text(text: str | None, path: str, pattern: str) -> list[int]:
    import numpy as np

    return np.frombuffer(_coder(path, pattern)[0].encode([text])[0], "<u4").tolist()


def decode_ids(ids, path: str, pattern: str) -> bytes:
    return b"".join(map(_coder(path, pattern)[1].__getitem__, ids))


def _id_lists(coded: list[bytes]):
    """Ids of several texts as an Arrow list array."""
    import numpy as np
    import pyarrow as pa

    offsets = np.zeros(len(coded) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in coded], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), "<i4")))


def _schema(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), *more])


def bpe_encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with `ids`, the array of token ids of the whole text; a former column `ids` is replaced.

    Ids are what merging by rank gives for each match of the pattern by itself, without special tokens: a
    match that is a token is that token, else its bytes merge, always the pair of the lowest rank, leftmost
    first. Null and empty texts have no ids. Very long texts and matches are encoded whole. Rows stay in
    their partitions; nothing is shuffled.
    """
    rows = docs.drop("ids")
    small_batches(docs.sparkSession)

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        coder, _ = _coder(path, pattern)
        for batch in batches:
            for begin, coded in coder.groups(batch.column(batch.schema.get_field_index(text_col))):
                part = batch.slice(begin, len(coded))
                yield pa.RecordBatch.from_arrays([*part.columns, _id_lists(coded)], names=[*batch.schema.names, "ids"])

    return rows.mapInArrow(encode, _schema(rows, "ids array<int>"))


def bpe_decode(coded: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """coded with `decoded`, the bytes of its ids (null ids: null); a former column `decoded` is replaced."""
    rows = coded.drop("decoded")

    def decode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        _, table = _coder(path, pattern)
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            texts = [None if ids is None else b"".join(map(table.__getitem__, ids)) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(decode, _schema(rows, "decoded binary"))


def bpe_round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256), with keep_ids also ids: encode, then decode those ids, in one pass.

    ids_sha256 is over the ids as little-endian unsigned 32-bit integers, decoded_sha256 over the decoded
    bytes, both in lowercase hex. Nulls, empty and long texts as in bpe_encode(); every row is returned.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    id_type = rows.schema[0].dataType.simpleString()
    small_batches(docs.sparkSession)

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        coder, table = _coder(path, pattern)
        for batch in batches:
            for begin, group in coder.groups(batch.column(1)):
                counts, coded_digests, decoded_digests = [], [], []
                for coded in group:
                    ids = np.frombuffer(coded, "<u4").tolist()
                    counts.append(len(ids))
                    coded_digests.append(hashlib.sha256(coded).hexdigest())
                    decoded_digests.append(hashlib.sha256(b"".join(map(table.__getitem__, ids))).hexdigest())
                columns = [batch.column(0).slice(begin, len(group)), pa.array(counts, pa.int64()), pa.array(coded_digests, pa.string()), pa.array(decoded_digests, pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns.append(_id_lists(group))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(work, f"`{id_col}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)

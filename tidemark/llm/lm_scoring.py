"""Language-model scores: a hashed maximum-entropy model over n-gram and skip features with a class-factored softmax."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise, materialise_in_buckets, pack, slices, unpack

#: Bytes of texts that a chunk holds, about; a longer text is a chunk of its own.
CHUNK_BYTES = 6 << 20
#: Tokens for each shard of the counted words and of the trained bigrams, about.
SHARD_TOKENS = 1 << 19
#: Added to each token's count.
SMOOTHING = 0.1
#: Classes of words: the end, then all others by their last two characters. BEGIN stands before a text.
CLASSES, BEGIN = 64, 64
#: Steps of a digit in which a word's prior within its class is kept, and their number.
LEVEL_STEPS, LEVELS = 16, 256
#: Rows of the hashed table of class features, each as wide as the softmax.
CLASS_ROWS = 1 << 13
#: Gradient updates of the class table, their first rate, and what is added to the counts that scale them.
ROUNDS, RATE, CAUTION = 10, 0.4, 2.0
#: Tasks that work out class gradients (of a bounded table); blocks that sums are added up in; groups of more tasks than that.
GRADIENT_TASKS, BLOCKS, PARTS = 2, 16, 64
#: Gradient updates of the hashed weights of words, their first rate, the variance of the weights' prior, their bound,
#: and the most hashed rows of either kind (word before, word two before), each as wide as the softmax.
WORD_ROUNDS, WORD_RATE, WORD_VARIANCE, WORD_BOUND, MOST_WORD_ROWS = 3, 0.8, 2.0, 8.0, 1 << 14
#: Tokens for each such row, until there are MOST_WORD_ROWS; tokens whose softmax is worked out at a time.
ROW_TOKENS, BATCH_TOKENS = 1 << 5, 1 << 12
#: Newton updates of the weights of a shard's bigrams, the variance of their prior, and what is taken off their seen counts.
UPDATES, VARIANCE, DISCOUNT = 14, 100.0, 0.4
#: Steps of a digit in which log probabilities are sent back.
ANSWER_STEPS = 4096
#: The end of a text as a token; words are never empty. Before a text stands a word with a hash of its own.
END, BEGIN_WORD = b"", 0x5851F42D4C957F2D


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _by_shard(high, keys, shards: int):
    """(order by shard and key, shard of each, bounds of the shards' stretches); 32 bits of `high` deal keys to shards."""
    import numpy as np

    shard = ((high & np.uint64(0xFFFFFFFF)) * np.uint64(shards)) >> np.uint64(32)
    order = np.lexsort((keys, shard))
    shard = shard[order].astype(np.int64)
    return order, shard, np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(shard) else np.zeros(1, np.int64)


def _joined(columns: list):
    import numpy as np

    return np.concatenate(columns) if columns else np.zeros(0, np.uint64)


# words, classes, histories


def word_class(suffix: str) -> int:
    """The class of a word from its last two characters; 0 is the end's."""
    return 1 + zlib.crc32(suffix.encode()) % (CLASSES - 1) if suffix else 0


def levels(counts):
    """A word's prior within its class, in LEVEL_STEPS of a digit above that of a word without a count."""
    import numpy as np

    return np.minimum(np.rint(LEVEL_STEPS * np.log10((counts + SMOOTHING) / SMOOTHING)), LEVELS - 1).astype(np.uint64)


def _before(flat, lengths, begin: int) -> tuple:
    """For each token of the texts the one before it and the one before that; `begin` before a text."""
    import numpy as np

    starts = np.cumsum(lengths) - lengths
    one = np.r_[begin, flat[:-1]].astype(np.int64)
    one[starts] = begin
    two = np.r_[begin, one[:-1]]
    two[starts] = begin
    return one, two


def _history_keys(classes, lengths):
    """(class two back, class one back, class) of each token as one number."""
    one, two = _before(classes, lengths, BEGIN)
    return (two * (CLASSES + 1) + one) * CLASSES + classes


CHUNK_SCHEMA = "chunk long, n_tokens long, learn binary, lengths binary, codes binary, words binary, classes binary, counts binary, events binary"


def encode_chunks(docs: DataFrame) -> DataFrame:
    """docs (id, text, learn) as chunks of texts in scan order: each chunk's distinct words as 64-bit hashes with class
    and count in its learning texts, tokens as places among them, and counts of class histories."""
    id_type, most_bytes = docs.schema["id"].dataType.simpleString(), CHUNK_BYTES

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import xxhash

        number = TaskContext.get().partitionId() << 32

        def chunk(batch):
            texts = pc.ascii_lower(pc.fill_null(batch.column(1), ""))
            learn = pc.fill_null(batch.column(2), True).to_numpy(zero_copy_only=False)
            split = pc.ascii_split_whitespace(texts)
            bounds = split.offsets.to_numpy()
            coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
            suffixes = pc.utf8_slice_codeunits(coded.dictionary, -2).dictionary_encode()
            kinds = np.array([word_class(s) for s in suffixes.dictionary.to_pylist()] + [0], np.int64)
            kinds = np.r_[kinds[suffixes.indices.to_numpy()], 0]
            listed = coded.dictionary.cast(pa.binary() if coded.dictionary.type == pa.string() else pa.large_binary()).to_pylist()
            places, end = coded.indices.to_numpy().astype(np.int64), listed.index(END) if END in listed else len(listed)
            real = places != end
            lengths = np.diff(np.r_[0, np.cumsum(real)][bounds - bounds[0]]) + 1
            stops = np.cumsum(lengths) - 1
            flat = np.full(int(lengths.sum()), end, np.int64)
            inside = np.ones(len(flat), bool)
            inside[stops] = False
            flat[inside] = places[real]
            listed += [END] * (end == len(listed))
            kinds = kinds[: len(listed)]
            learning = np.repeat(learn, lengths)
            counts = np.bincount(flat[learning], minlength=len(listed))
            # the most frequent words get the smallest places, which pack best
            rank = np.argsort(-counts, kind="stable")
            back = np.empty(len(rank), np.int64)
            back[rank] = np.arange(len(rank))
            flat, kinds, counts = back[flat], kinds[rank], counts[rank]
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, listed), np.uint64, len(listed))[rank]
            seen = np.bincount(_history_keys(kinds[flat], lengths)[learning], minlength=1)
            events = np.flatnonzero(seen)
            columns = [pa.array([len(flat)], pa.int64()), *(pa.array([pack(x)], pa.binary()) for x in (
                learn.astype(np.uint8), lengths.astype(np.uint32), flat.astype(np.uint32), hashes, kinds.astype(np.uint8), counts.astype(np.uint32),
                np.concatenate([events, seen[events]]).astype(np.uint32)))]
            ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *columns, ids], names=[n.split()[0] for n in CHUNK_SCHEMA.split(", ")] + ["ids"])

        for batch in slices(batches, 1, most_bytes):
            yield chunk(batch)
            number += 1

    return docs.select("id", "text", "learn").mapInArrow(encode, f"{CHUNK_SCHEMA}, ids array<{id_type}>")


# word counts: chunks ask shards of words


REQUEST_SCHEMA = "shard int, chunk long, keys binary, extra binary, counts binary"
ANSWER_SCHEMA = "chunk long, kind int, shard int, answers binary, level int, n long"


def _request(rows: list):
    import pyarrow as pa

    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "chunk", "keys", "extra", "counts"])


def _answer(rows: list):
    import pyarrow as pa

    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int64())
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["chunk", "kind", "shard", "answers", "level", "n"])


def _sorted_keys(table) -> tuple:
    """All keys of a shard's requests, and the bounds of each request among them."""
    import numpy as np

    parts = [np.cumsum(unpack(k.as_py(), "<u8")) for k in table.column("keys")]
    return _joined(parts), np.cumsum([0, *map(len, parts)])


def word_answers(chunks: DataFrame, shards: int) -> DataFrame:
    """How often the learning texts of all chunks have each word of each chunk, and sums over all words.

    Rows with chunk -1 are sums: the number of words of (class, level), or of all tokens where level is -1.
    """
    import numpy as np

    def ask(batches: Iterator) -> Iterator:
        for batch in batches:
            for row in batch.to_pylist():
                words, kinds, counts = unpack(row["words"], "<u8"), unpack(row["classes"], "u1"), unpack(row["counts"], "<u4")
                order, shard, cuts = _by_shard(words >> np.uint64(32), words, shards)
                words, kinds, counts = words[order], kinds[order], counts[order]
                yield _request([(int(shard[a]), row["chunk"], pack(np.diff(words[a:b], prepend=np.uint64(0))), pack(kinds[a:b]), pack(counts[a:b])) for a, b in zip(cuts, cuts[1:])])

    def answer(table):
        keys, cuts = _sorted_keys(table)
        kinds, counts = (_joined([unpack(x.as_py(), k) for x in table.column(c)]) for c, k in (("extra", "u1"), ("counts", "<u4")))
        distinct, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, counts, len(distinct)).astype(np.uint64)
        kind = np.zeros(len(distinct), np.int64)
        kind[which] = kinds
        known = total > 0
        seen = np.bincount(kind[known] * LEVELS + levels(total[known]).astype(np.int64), minlength=1)
        rows = [(c.as_py(), 0, s.as_py(), pack(total[which[a:b]]), None, None) for c, s, a, b in zip(table.column("chunk"), table.column("shard"), cuts, cuts[1:])]
        rows += [(-1, 0, None, None, level, int(seen[level])) for level in np.flatnonzero(seen).tolist()]
        return _answer([*rows, (-1, 0, None, None, -1, int(total.sum()))])

    asked = chunks.select("chunk", "words", "classes", "counts").mapInArrow(ask, REQUEST_SCHEMA)
    return materialise(asked.groupBy("shard").applyInArrow(answer, ANSWER_SCHEMA), "lm-words")


# the class softmax


def _row(salt: int, a, b, rows: int):
    import numpy as np

    mixed = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed + np.uint64(salt * 0x165667B19E3779F9 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(33)) % np.uint64(rows)).astype(np.int64)


def class_features(one, two) -> list:
    """Hashed rows of a history's features (classes one and two back): bias, bigram, skip, both together."""
    zero = one * 0
    return [_row(1, zero, zero, CLASS_ROWS), _row(2, one, zero, CLASS_ROWS), _row(3, two, zero, CLASS_ROWS), _row(4, one, two + 1, CLASS_ROWS)]


def class_chances(table, histories):
    """P(class | history) for histories two * (CLASSES + 1) + one, a row each."""
    import numpy as np

    logits = sum(table[f].astype(float) for f in class_features(histories % (CLASSES + 1), histories // (CLASSES + 1)))
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    return logits / logits.sum(axis=1, keepdims=True)


PART_SCHEMA = "part int, block int, sums binary"


def _packed_sums(sums) -> bytes:
    """Sums as floats of 32 bits whose last 12 are rounded away, which is a relative error of 2**-12 and packs into half."""
    import numpy as np

    return pack((np.ascontiguousarray(sums, np.float32).view(np.uint32) + np.uint32(1 << 11)) & np.uint32(0xFFFFF000))


def _parts(sums, likelihood: float):
    """A task's sums in BLOCKS blocks, and its log likelihood in a block after them."""
    import numpy as np
    import pyarrow as pa

    blocks = [_packed_sums(p) for p in np.array_split(sums.ravel(), BLOCKS)] + [np.float64(likelihood).tobytes()]
    part = TaskContext.get().partitionId() % PARTS
    return pa.RecordBatch.from_arrays([pa.array([part] * len(blocks), pa.int32()), pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], names=["part", "block", "sums"])


def _added_up(parts: DataFrame, tasks: int, shape: tuple) -> tuple:
    """(log likelihood, *sums) over all tasks' parts: PARTS groups of tasks are added up first if there are more tasks."""
    import numpy as np
    import pyarrow as pa

    def read(block, data):
        return np.frombuffer(data) if block == BLOCKS else unpack(data, "<u4").view(np.float32).astype(np.float64)

    def add_up(table):
        block = table.column("block")[0].as_py()
        total = sum(read(block, s.as_py()) for s in table.column("sums"))
        made = total.tobytes() if block == BLOCKS else _packed_sums(total)
        return pa.table([table.column("part").slice(0, 1), table.column("block").slice(0, 1), pa.array([made], pa.binary())], names=["part", "block", "sums"])

    if tasks > PARTS:
        parts = parts.groupBy("part", "block").applyInArrow(add_up, PART_SCHEMA)
    rows = {r["block"]: read(r["block"], r["sums"]) for r in parts.groupBy("block").applyInArrow(add_up, PART_SCHEMA).collect()}  # BLOCKS + 1 rows
    sums = np.concatenate([rows[b] for b in range(BLOCKS)]).reshape(shape) if rows else np.zeros(shape)
    return float(rows[BLOCKS][0]) if rows else 0.0, *sums


def _gradient(events: DataFrame, table) -> tuple:
    """(log likelihood, seen minus expected counts, expected counts) of the class table over all events (key, n)."""
    import numpy as np

    sent = events.sparkSession.sparkContext.broadcast(table)  # CLASS_ROWS rows

    def one_part(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table, sums, likelihood = sent.value, np.zeros((2, CLASS_ROWS, CLASSES)), 0.0
        for batch in batches:
            key, n = batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy().astype(float)
            histories, of = np.unique(key // CLASSES, return_inverse=True)
            seen = np.bincount(of * CLASSES + key % CLASSES, n, len(histories) * CLASSES).reshape(-1, CLASSES)
            share = class_chances(table, histories)
            likelihood += float((seen * np.log(np.maximum(share, 1e-300))).sum())
            share *= seen.sum(axis=1, keepdims=True)
            for f in class_features(histories % (CLASSES + 1), histories // (CLASSES + 1)):
                np.add.at(sums[0], f, seen - share)
                np.add.at(sums[1], f, share)
        yield _parts(sums, likelihood)

    return _added_up(events.coalesce(GRADIENT_TASKS).mapInArrow(one_part, PART_SCHEMA), GRADIENT_TASKS, (2, CLASS_ROWS, CLASSES))


def train_classes(events: DataFrame):
    """The class table from the counts (key, n) of all class histories of the learning texts.

    Each update is a job: tasks add up what was seen and what the table sent to them expects for the hashed
    features, and the driver moves the table along the gradient, scaled by the expected counts. An update
    that lowers the likelihood is taken back and the rate halved.
    """
    import numpy as np

    table, rate = np.zeros((CLASS_ROWS, CLASSES), np.float32), RATE
    best, gap, expected = _gradient(events, table)
    for _ in range(ROUNDS):
        moved = (table + rate * np.clip(gap / (expected + CAUTION), -2, 2)).astype(np.float32)
        likelihood, *sums = _gradient(events, moved)
        if likelihood < best:
            rate /= 2
            continue
        table, best, (gap, expected) = moved, likelihood, sums
    return table


# the class softmax goes on: hashed weights of the word before and the word two before


def word_rows(tokens: int) -> int:
    """Hashed rows for the words before, and as many for those two before: a power of two that follows the corpus to a bound."""
    return 1 << min(max(tokens // ROW_TOKENS, 1).bit_length(), MOST_WORD_ROWS.bit_length() - 1)


def class_logs(table):
    """log P(class | classes two and one back) by the class table alone, a row for each history."""
    import numpy as np

    return np.log(np.maximum(class_chances(table, np.arange((CLASSES + 1) ** 2)), 1e-30)).astype(np.float32)


def _histories(row: dict, rows: int) -> tuple:
    """For each token of a chunk: class history, hashed rows of the word before and the word two before, class."""
    import numpy as np

    flat, lengths, words = unpack(row["codes"], "<u4").astype(np.int64), unpack(row["lengths"], "<u4").astype(np.int64), unpack(row["words"], "<u8")
    kinds = unpack(row["classes"], "u1").astype(np.int64)
    one, two = _before(flat, lengths, len(words))
    kind, word = np.r_[kinds, BEGIN], np.r_[words, np.uint64(BEGIN_WORD)]
    first, second = ((_mix(word + np.uint64(salt)) & np.uint64(rows - 1)).astype(np.int64) for salt in (0x51, 0x7A3))
    return kind[two] * (CLASSES + 1) + kind[one], first[one], rows + second[two], kinds[flat]


def _weighed(factors, weights, history, rows):
    """exp of the part of the class logits that histories and hashed rows of one kind have, a row each.

    exp of logits is a product of exponentials, so those of the tables are worked out once and not for each token.
    """
    import numpy as np

    made = np.take(factors, history, axis=0, mode="clip")
    made *= np.take(weights, rows, axis=0, mode="clip")
    return made


def _batches(n: int) -> Iterator[slice]:
    return (slice(a, a + BATCH_TOKENS) for a in range(0, n, BATCH_TOKENS))


def token_class_logs(row: dict, logs, weights):
    """log P(class | two words before) of each token of a chunk."""
    import numpy as np

    history, one, two, kind = _histories(row, len(weights) // 2)
    factors, powers = np.exp(logs), np.exp(weights)
    out = logs[history, kind].astype(float) + weights[one, kind] + weights[two, kind]
    for b in _batches(len(kind)):
        out[b] -= np.log(np.einsum("ij,ij->i", _weighed(factors, powers, history[b], two[b]), np.take(powers, one[b], axis=0, mode="clip")))
    return out


def _contexts(history, one, two, width: int) -> tuple:
    """The distinct (class history, row of the word before, row of the word two before) by the second, and how often each occurs."""
    import numpy as np

    low, middle = (width - 1).bit_length(), ((CLASSES + 1) ** 2).bit_length()
    keys = np.sort((one << middle | history) << low | two)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    times, keys = np.diff(np.r_[first, len(keys)]), keys[first]
    return keys >> low & (1 << middle) - 1, keys >> low + middle, keys & (1 << low) - 1, times


def _word_gradient(chunks: DataFrame, logs, weights, seen: bool = False) -> tuple:
    """(log likelihood, expected counts, and if asked for seen counts) of the hashed word features over all learning tokens.

    Tokens of a chunk after the same context share their softmax, which is worked out once.
    """
    import numpy as np

    spark = chunks.sparkSession
    sent = spark.sparkContext.broadcast((logs, weights))  # (CLASSES + 1)**2 and 2 * MOST_WORD_ROWS rows at most

    def add(sums, powers, keys, shares, made):
        """Add the rows of `made` by their shares, in the order of sorted keys, to the rows of sums that the keys name."""
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        rows = keys[cuts[:-1]]
        found = np.empty((len(rows), CLASSES), np.float32)
        for i, (a, b) in enumerate(pairwise(cuts.tolist())):
            np.dot(shares[a:b], made[a:b], out=found[i])
        sums[rows] += found * powers[rows]

    def one_part(batches: Iterator) -> Iterator:
        logs, weights = sent.value
        factors, powers = np.exp(logs), np.exp(weights)
        sums, likelihood = np.zeros((1 + seen, *weights.shape)), 0.0
        for batch in batches:
            for row in batch.to_pylist():
                learning = np.repeat(unpack(row["learn"], "u1").astype(bool), unpack(row["lengths"], "<u4"))
                history, one, two, kind = (x[learning] for x in _histories(row, len(weights) // 2))
                for table, rows in ((logs, history), (weights, one), (weights, two)):
                    likelihood += float(table[rows, kind].sum(dtype=np.float64))
                for rows in (one, two) if seen else ():
                    sums[1] += np.bincount(rows * CLASSES + kind, minlength=weights.size).reshape(weights.shape)
                history, one, two, times = _contexts(history, one, two, len(weights))
                shares = np.empty(len(times), np.float32)
                for b in _batches(len(times)):
                    made = _weighed(factors, powers, history[b], two[b])
                    total = np.einsum("ij,ij->i", made, np.take(powers, one[b], axis=0, mode="clip"))
                    likelihood -= float((times[b] * np.log(total)).sum(dtype=np.float64))
                    shares[b] = times[b] / total
                    add(sums[0], powers, one[b], shares[b], made)
                order = np.sort(two << 40 | np.arange(len(two))) & (1 << 40) - 1
                history, one, two, shares = history[order], one[order], two[order], shares[order]
                for b in _batches(len(times)):
                    add(sums[0], powers, two[b], shares[b], _weighed(factors, powers, history[b], one[b]))
        yield _parts(sums, likelihood)

    tasks = max(GRADIENT_TASKS, spark.sparkContext.defaultParallelism)
    needed = chunks.select("learn", "lengths", "codes", "words", "classes").coalesce(tasks)
    return _added_up(needed.mapInArrow(one_part, PART_SCHEMA), tasks, (1 + seen, *weights.shape))


def train_words(chunks: DataFrame, logs, rows: int):
    """Weights of the hashed features (word before, class) and (word two before, class), 2 * rows rows.

    The logits of the class table stay as they are and these are added to them. Each update is a job over all learning
    tokens: tasks add up how often each feature was seen and how often the weights sent to them expect it, and the
    driver moves the weights along the gradient of the likelihood with a normal prior of WORD_VARIANCE, scaled by the expected
    counts. An update that lowers that objective is taken back and the rate halved.
    """
    import numpy as np

    def objective(likelihood, weights):
        return likelihood - float((weights.astype(float) ** 2).sum()) / (2 * WORD_VARIANCE)

    weights, rate = np.zeros((2 * rows, CLASSES), np.float32), WORD_RATE
    likelihood, expected, seen = _word_gradient(chunks, logs, weights, seen=True)
    best = objective(likelihood, weights)
    for _ in range(WORD_ROUNDS):
        step = (seen - expected - weights / WORD_VARIANCE) / (expected + 1 / WORD_VARIANCE)
        moved = np.clip(weights + rate * np.clip(step, -2, 2), -WORD_BOUND, WORD_BOUND).astype(np.float32)
        likelihood, found = _word_gradient(chunks, logs, moved)
        if objective(likelihood, moved) < best:
            rate /= 2
            continue
        weights, best, expected = moved, objective(likelihood, moved), found
    return weights


# the word softmax inside a class: chunks ask shards of bigrams


@dataclass
class Sums:
    """N and V, and the prior mass of each class: its words by level and one word that isn't known."""

    total: int
    distinct: int
    mass: object

    @classmethod
    def of(cls, answers: DataFrame) -> Sums:
        import numpy as np

        rows = answers.filter("chunk = -1").groupBy("level").agg(F.sum("n").alias("n")).collect()  # CLASSES * LEVELS rows at most
        found = {r["level"]: r["n"] for r in rows}
        total, mass = found.pop(-1, 0), np.ones(CLASSES)
        for key, n in found.items():
            mass[key // LEVELS] += n * 10.0 ** (key % LEVELS / LEVEL_STEPS)
        return cls(total, sum(found.values()), mass)

    def base(self, counts):
        """log10 of the base probability of tokens seen so often."""
        import numpy as np

        return np.log10((counts + SMOOTHING) / (self.total + SMOOTHING * (self.distinct + 1)))


def _chunk_counts(row: dict, answers: list, shards: int):
    """The corpus counts of a chunk's words, from the answers (shard, bytes) of the word shards."""
    import numpy as np

    words = unpack(row["words"], "<u8")
    order, _, _ = _by_shard(words >> np.uint64(32), words, shards)
    counts = np.zeros(len(words))
    counts[order] = _joined([unpack(data, "<u8") for _, data in sorted(answers)])
    return counts


def _chunk_grams(row: dict, counts, shards: int) -> tuple:
    """A chunk's distinct bigrams in the order of their requests.

    Returns (keys, shards, bounds, learning counts, and for each token the place of its bigram). A key has 26
    bits of the hash of (word before, class), the class, 24 bits of the word's hash, and its level.
    """
    import numpy as np

    flat, lengths, words = unpack(row["codes"], "<u4").astype(np.int64), unpack(row["lengths"], "<u4").astype(np.int64), unpack(row["words"], "<u8")
    kinds, size = unpack(row["classes"], "u1").astype(np.uint64), len(words)
    one, _ = _before(flat, lengths, size)
    pairs = one * (size + 1) + flat
    order = np.argsort(pairs, kind="stable")
    ordered = pairs[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
    learning = np.repeat(unpack(row["learn"], "u1"), lengths)[order]
    n = np.add.reduceat(learning.astype(np.int64), np.flatnonzero(new)) if len(ordered) else np.zeros(0, np.int64)
    distinct = ordered[new]
    left, word = np.r_[words, np.uint64(BEGIN_WORD)][distinct // (size + 1)], distinct % (size + 1)
    block = _mix(left + (kinds[word] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    key = (block & np.uint64((1 << 26) - 1)) << np.uint64(38) | kinds[word] << np.uint64(32)
    key |= _mix(words[word]) >> np.uint64(40) << np.uint64(8) | levels(counts[word])
    asked, shard, cuts = _by_shard(block >> np.uint64(32), key, shards)
    place = np.empty(len(asked), np.int64)
    place[asked] = np.arange(len(asked))
    of_token = np.empty(len(order), np.int64)
    of_token[order] = place[np.cumsum(new) - 1]
    return key[asked], shard, cuts, n[asked], of_token


def bigram_logs(keys, counts, mass):
    """log10 P(word | class, word before) of distinct sorted bigram keys with their counts in the learning texts.

    Bigrams of one (word before, class) are a block of a softmax over the words of the class: a weight for each bigram that
    was seen is added to the log of the class's prior, other words have the prior alone. The weights maximise the
    likelihood of the block's counts, less DISCOUNT for each bigram, with a normal prior of VARIANCE on weights. Blocks share
    no weight, so all updates happen where the block is; each is a Newton step, as a block's Hessian is a diagonal and one product.
    """
    import numpy as np

    if not len(keys):
        return np.zeros(0)
    block = keys >> np.uint64(32)
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    prior = 10.0 ** ((keys & np.uint64(LEVELS - 1)).astype(float) / LEVEL_STEPS) / mass[(block & np.uint64(CLASSES - 1)).astype(np.int64)]
    seen = counts > 0
    each, spread = lambda x: np.add.reduceat(x, starts), lambda x: np.repeat(x, sizes)
    wanted, known = np.where(seen, counts - DISCOUNT, 0.0), np.where(seen, prior, 0.0)
    total, rest = each(np.where(seen, counts - DISCOUNT, 0.0)) + DISCOUNT * each(seen.astype(float)), np.maximum(1 - each(known), 1e-12)
    weight = np.zeros(len(keys))
    for _ in range(UPDATES):
        share = known * np.exp(weight)
        expected = share * spread(total / (each(share) + rest))
        slope, scale = np.where(seen, wanted - expected - weight / VARIANCE, 0.0), expected + 1 / VARIANCE
        joint = each(expected * slope / scale) / np.maximum(total - each(expected * expected / scale), 1e-9)
        weight += np.where(seen, np.clip((slope + expected * spread(joint)) / scale, -2, 2), 0.0)
    norm = each(known * np.exp(weight)) + rest
    return (np.log(prior) + weight - spread(np.log(norm))) / np.log(10)


def gram_answers(chunks: DataFrame, words: DataFrame, sums: Sums, shards: int) -> DataFrame:
    """log10 P(word | class, word before) of each chunk's distinct bigrams, trained in shards of blocks."""
    import numpy as np
    import pyarrow as pa

    mass = sums.mass  # a number for each class

    def ask(left, right):
        if not left.num_rows:
            return pa.Table.from_batches([_request([])])
        row = left.to_pylist()[0]
        counts = _chunk_counts(row, [(r["shard"], r["answers"]) for r in right.select(["shard", "answers"]).to_pylist()], shards)
        keys, shard, cuts, n, _ = _chunk_grams(row, counts, shards)
        asked = [(int(shard[a]), row["chunk"], pack(np.diff(keys[a:b], prepend=np.uint64(0))), None, pack(n[a:b].astype(np.uint32))) for a, b in zip(cuts, cuts[1:])]
        return pa.Table.from_batches([_request(asked)])

    def answer(table):
        keys, cuts = _sorted_keys(table)
        distinct, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, _joined([unpack(x.as_py(), "<u4") for x in table.column("counts")]), len(distinct))
        logs = np.clip(np.rint(-ANSWER_STEPS * bigram_logs(distinct, total, mass)), 0, 65535).astype(np.uint16)[which]
        return _answer([(c.as_py(), 1, s.as_py(), pack(logs[a:b]), None, None) for c, s, a, b in zip(table.column("chunk"), table.column("shard"), cuts, cuts[1:])])

    needed = chunks.select("chunk", "learn", "lengths", "codes", "words", "classes")
    asked = needed.groupBy("chunk").cogroup(words.filter("chunk >= 0").groupBy("chunk")).applyInArrow(ask, REQUEST_SCHEMA)
    return materialise(asked.groupBy("shard").applyInArrow(answer, ANSWER_SCHEMA), "lm-bigrams")


def lm_scores(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, learn, n_tokens, n_known, train_tokens, base_score, score) for every row, learning from rows where `learn`.

    Tokens are the words with A-Z lower-cased, then one end. base_score sums
    log10((c + 0.1) / (N + 0.1 (V + 1))) over the tokens, c being a token's count, N and V the number of
    tokens and of distinct tokens in the learning texts. `score` is log10 of the text's probability under the
    maximum-entropy model P(class | two words before) P(word | class, word before): the class
    softmax has hashed n-gram and skip features of classes and of the two words themselves and is trained by distributed
    gradient updates; the softmax inside a class has a hashed feature for every distinct bigram of the learning texts,
    trained in shards that follow the corpus. In each class one word stands for those that aren't known, so that all
    words sum to one (their priors are in 1/16, the answers in 1/4096 of a digit).

    Texts go into chunks in scan order, once encoded and written in buckets, so that they never are shuffled. A chunk asks the shards for the counts of
    its distinct words, then for the log probabilities of its distinct bigrams; no table of all words or
    bigrams is sent to anyone. Words and bigrams are told apart by hashes. Null and empty texts are one end;
    a null `learn` counts as true. Repeated rows are each scored and each learned from. Without learning
    texts N is 0, every c is 0 and the tables are even. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), learn.cast("boolean").alias("learn"))
    chunks = materialise_in_buckets(encode_chunks(rows), "chunk", "lm_chunks")
    tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-tokens // SHARD_TOKENS))
    words = word_answers(chunks, shards)
    sums = Sums.of(words)
    logs = class_logs(train_classes(class_events(chunks)))
    weights = train_words(chunks, logs, word_rows(tokens))
    grams = gram_answers(chunks, words, sums, shards)
    sent = docs.sparkSession.sparkContext.broadcast((sums, logs, weights))  # (CLASSES + 1)**2 and 2 * MOST_WORD_ROWS rows at most
    id_type = rows.schema["id"].dataType.simpleString()
    names = [id_col, "learn", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(left, right):
        import numpy as np
        import pyarrow as pa

        sums, class_table, weights = sent.value
        kinds = [left.schema.field("ids").type.value_type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        row, answers = left.drop_columns(["ids"]).to_pylist()[0], right.select(["kind", "shard", "answers"]).to_pylist()
        counts = _chunk_counts(row, [(r["shard"], r["answers"]) for r in answers if r["kind"] == 0], shards)
        *_, of_token = _chunk_grams(row, counts, shards)
        logs = _joined([unpack(data, "<u2") for _, data in sorted((r["shard"], r["answers"]) for r in answers if r["kind"] == 1)])
        flat, lengths = unpack(row["codes"], "<u4"), unpack(row["lengths"], "<u4").astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        of_class = token_class_logs(row, class_table, weights) / np.log(10)
        each = lambda x: np.add.reduceat(x, starts)
        columns = [left.column("ids").combine_chunks().values if left.column("ids").num_chunks > 1 else left.column("ids").chunk(0).flatten(),
                   unpack(row["learn"], "u1").astype(bool), lengths, each((counts > 0)[flat].astype(np.int64)), np.full(len(lengths), sums.total, np.int64),
                   each(sums.base(counts)[flat]), each(of_class - logs[of_token] / ANSWER_STEPS)]
        return pa.table([pa.array(c, k) if isinstance(c, np.ndarray) else c for c, k in zip(columns, kinds)], names=names)

    schema = f"`{id_col}` {id_type}, learn boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    answers = words.filter("chunk >= 0").unionByName(grams)
    needed = chunks.select("chunk", "ids", "learn", "lengths", "codes", "words", "classes")
    return needed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)


def class_events(chunks: DataFrame) -> DataFrame:
    """(key, n): how often the learning texts have each history of classes; fewer than (CLASSES + 1)**2 * CLASSES rows."""

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for data in batch.column(0):
                keys, n = unpack(data.as_py(), "<u4").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(n, pa.int64())], names=["key", "n"])

    counted = chunks.select("events").mapInArrow(rows, "key int, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return materialise(counted, "lm-events")

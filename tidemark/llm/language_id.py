"""Language identification by unigram pieces, summed over all segmentations of each word."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, functions as F

from .common import text_bytes

#: Added to each piece's expected count in each language.
SMOOTHING = 0.1
#: Words that a worker remembers the scores of, and documents that it looks up at once.
CACHE_WORDS, GROUP_DOCS = 1 << 20, 256
#: Longer words are scored one by one.
LONG_WORD = 48
#: Training rows of each language, about: more are thinned out by a hash of their ids.
ROWS_PER_LANGUAGE = 1500
#: The mark of a word's begin in the vocabulary.
MARK = "▁"


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[dict[str, int], int]:
    """Pieces of a sentencepiece model by number, and the longest's length; not its controls and bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    return {piece: i for i, piece in enumerate(plain)}, max(map(len, plain), default=1)


_FACTOR = 0x9E3779B97F4A7C15
#: Slots of the piece table, as a power of two.
_TABLE_BITS = 18


@lru_cache(maxsize=2)
def _piece_table(path: str):
    """(hashes, numbers) of the pieces in an open-addressed table; 0 marks a free slot."""
    import numpy as np

    vocabulary, _ = _vocabulary(path)
    hashes, numbers = np.zeros(1 << _TABLE_BITS, np.uint64), np.zeros(1 << _TABLE_BITS, np.int64)
    for piece, number in vocabulary.items():
        value = 0
        for char in piece:
            value = (value * _FACTOR + ord(char) + 1) & (1 << 64) - 1
        slot = _slot(value)
        while hashes[slot]:
            slot = (slot + 1) & (1 << _TABLE_BITS) - 1
        hashes[slot], numbers[slot] = value, number
    return hashes, numbers


def _slot(value):
    if isinstance(value, int):
        return ((value * 0xD6E8FEB86659FD93) & (1 << 64) - 1) >> (64 - _TABLE_BITS)
    import numpy as np

    return ((value * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def _find(values, path: str, missing: int):
    """Piece numbers of hashes, `missing` for those that are no piece."""
    import numpy as np

    hashes, numbers = _piece_table(path)
    slots = _slot(values)
    held = hashes[slots]
    out = np.where(held == values, numbers[slots], missing)
    left = np.flatnonzero((held != values) & (held != 0))
    while len(left):
        slots[left] = (slots[left] + 1) & (1 << _TABLE_BITS) - 1
        held = hashes[slots[left]]
        hit = held == values[left]
        out[left[hit]] = numbers[slots[left[hit]]]
        left = left[~hit & (held != 0)]
    return out


class Words:
    """Words of one length with all their pieces: pieces[k][:, i] is the piece of k characters from place i on.

    A character that is no piece is the piece `unknown`, so every word has a segmentation; `none` (whose
    chance is 0) stands where there is no piece.
    """

    def __init__(self, words: list[str], path: str):
        import numpy as np

        vocabulary, longest = _vocabulary(path)
        self.unknown, self.none = len(vocabulary), len(vocabulary) + 1
        codes = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)
        self.n, factor = codes.shape[1], np.uint64(_FACTOR)
        sums = np.zeros((len(words), self.n + 1), np.uint64)
        for i in range(self.n):
            sums[:, i + 1] = sums[:, i] * factor + codes[:, i] + np.uint64(1)
        self.pieces, power = {}, 1
        for k in range(1, min(self.n, longest) + 1):
            power = power * _FACTOR & (1 << 64) - 1
            values = (sums[:, k:] - sums[:, :-k] * np.uint64(power)).ravel()
            self.pieces[k] = _find(values, path, self.unknown if k == 1 else self.none).reshape(len(words), -1)

    def forward(self, chances):
        """ahead[j]: summed probability of the segmentations of the first j characters, for each column of chances."""
        import numpy as np

        ahead = [np.ones((len(self.pieces[1]), chances.shape[1]))]
        for j in range(1, self.n + 1):
            ahead.append(sum(ahead[j - k] * chances[self.pieces[k][:, j - k]] for k in range(1, min(j, len(self.pieces)) + 1)))
        return ahead

    def expected(self, chances, weights):
        """Expected counts of the pieces under `chances` (one column), with a row of weights for each word."""
        import numpy as np

        ahead, back = self.forward(chances), {self.n: np.ones((len(weights), 1))}
        for i in range(self.n - 1, -1, -1):
            back[i] = sum(back[i + k] * chances[self.pieces[k][:, i]] for k in range(1, min(self.n - i, len(self.pieces)) + 1))
        total = np.zeros((len(chances), weights.shape[1]))
        for k, pieces in self.pieces.items():
            for i in range(pieces.shape[1]):
                share = (ahead[i] * chances[pieces[:, i]] * back[i + k] / ahead[self.n])[:, 0]
                used = np.flatnonzero(share)
                for lang in range(weights.shape[1]):
                    total[:, lang] += np.bincount(pieces[used, i], share[used] * weights[used, lang], len(chances))
        return total


def _by_length(words: list[str], most: int = 20_000):
    """Places of words of equal length, in parts of at most `most`."""
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        groups.setdefault(len(word), []).append(i)
    for places in groups.values():
        for at in range(0, len(places), most):
            yield places[at : at + most]


def long_word_logs(word: str, chances, path: str):
    """log of the summed probability of a long word for each column, rescaled on the way."""
    import numpy as np

    vocabulary, longest = _vocabulary(path)
    text, scale = MARK + word, np.zeros(chances.shape[1])
    recent = [np.ones(chances.shape[1])]  # of the last `longest` places
    for j in range(1, len(text) + 1):
        total = np.zeros(chances.shape[1])
        for k in range(1, min(j, longest) + 1):
            piece = vocabulary.get(text[j - k : j])
            if piece is None and k == 1:
                piece = len(vocabulary)
            if piece is not None:
                total = total + recent[-k] * chances[piece]
        recent = [*recent[-(longest - 1) :], total] if longest > 1 else [total]
        if j % 16 == 0:
            top = np.maximum(np.max(recent, axis=0), 1e-300)
            recent = [r / top for r in recent]
            scale += np.log(top)
    return scale + np.log(np.maximum(recent[-1], 1e-300))


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = ROWS_PER_LANGUAGE) -> tuple[DataFrame, dict[str, int]]:
    """About per_language rows of each language, all of smaller ones: those whose hashed ids fall below its share.

    Also the number of rows of each language.
    """
    rows = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # a row for each language
    if not sizes:
        return rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")), sizes
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, per_language / n)])[F.col(lang_col)]
    place = F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string")), 11) / float(1 << 53)
    return rows.filter(place < share).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")), sizes


def train(sample: DataFrame, path: str) -> DataFrame:
    """(lang, piece, n): expected piece counts of rows (lang, text).

    A pass over each partition counts its words for each language, and adds up the pieces that all their
    segmentations are expected to use when every piece is equally likely.
    """

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        size = len(_vocabulary(path)[0]) + 2
        even, words, totals = np.full((size, 1), 1 / size), {}, {}
        even[-1] = 0

        def add_up():
            langs = sorted(words)
            every = sorted(set().union(*words.values()))
            text = [w.decode() for w in every]
            for places in _by_length(text):
                weights = np.array([[words[lang][every[i]] for lang in langs] for i in places], float)
                sums = Words([text[i] for i in places], path).expected(even, weights)
                for i, lang in enumerate(langs):
                    totals[lang] = totals.get(lang, 0) + sums[:, i]
            words.clear()

        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), text_bytes(batch)):
                # a long word counts by its parts, so that all words here are short
                words.setdefault(lang, Counter()).update(
                    part for w in data.split() for part in ([w] if len(w) <= LONG_WORD else _cut(w)))
            if sum(map(len, words.values())) > CACHE_WORDS:
                add_up()
        if words:
            add_up()
        for lang, sums in totals.items():
            used = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(sums[used])], names=["lang", "piece", "n"])

    return sample.mapInArrow(count, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def _cut(word: bytes) -> list[bytes]:
    text = word.decode()
    return [text[i : i + LONG_WORD].encode() for i in range(0, len(text), LONG_WORD)]


def _model(counted: DataFrame, sizes: dict[str, int], path: str):
    """(languages, chances, priors): chances is (pieces + 2) x languages, the last two unknown and none."""
    import numpy as np

    table = counted.toArrow()  # languages x vocabulary at most
    langs = sorted(sizes)
    place = {lang: i for i, lang in enumerate(langs)}
    sums = np.zeros((len(_vocabulary(path)[0]) + 2, len(langs)))
    for lang, piece, n in zip(table.column("lang").to_pylist(), table.column("piece").to_pylist(), table.column("n").to_pylist()):
        sums[piece, place[lang]] = round(n, 6)
    sums[:-1] += SMOOTHING
    return langs, sums / sums.sum(axis=0), np.log([sizes[lang] / sum(sizes.values()) for lang in langs])


def identify(docs: DataFrame, training: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """docs with lang_pred and score; columns of docs with those names are replaced.

    `training` gives texts with known languages (rows with a null text or language are left out), of which
    about per_language for each language are learned from. A text's
    score in a language is the sum over its words of log P(word), P(word) being the sum over all its
    segmentations into pieces of the vocabulary (a sentencepiece model's file, never trained here), plus
    the log prior; lang_pred is the best (of equals the first by name), `score` its posterior probability.
    Characters that are no piece count as an unknown piece.

    A text that is null or has no letter is `und` with score 0, as is every text without training rows.
    Whole texts are scored. Every row of docs is returned; its other columns, lang too, are never read.
    """
    rows = docs.drop("lang_pred", "score")
    sample, sizes = training_sample(training, id_col, text_col, lang_col, per_language)
    langs, chances, priors = _model(train(sample, path), sizes, path)
    sent = docs.sparkSession.sparkContext.broadcast(chances)  # languages x vocabulary

    def predict(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        chances, known = sent.value, {}
        logs = np.zeros((1 << 12, len(langs)))

        def learn(words: set) -> None:
            nonlocal logs
            if len(known) + len(words) > CACHE_WORDS:
                known.clear()
                words = every
            new = [w for w in words if w not in known]
            texts = [w.decode() for w in new]
            if len(known) + len(new) > len(logs):
                logs = np.concatenate([logs[: len(known)], np.zeros((len(new) + len(logs), len(langs)))])
            at = len(known)
            for places in _by_length(texts):
                some = [texts[i] for i in places]
                if len(some[0]) <= LONG_WORD:
                    logs[[at + i for i in places]] = np.log(np.maximum(Words(some, path).forward(chances)[-1], 1e-300))
                else:
                    for i, t in zip(places, some):
                        logs[at + i] = long_word_logs(t, chances, path)
            known.update((w, at + i) for i, w in enumerate(new))

        for batch in batches:
            names, scores = [], []
            data = text_bytes(batch, text_col)
            for start in range(0, len(data), GROUP_DOCS):
                group = [(d or b"") for d in data[start : start + GROUP_DOCS]]
                lettered = [bool(langs) and any(map(str.isalpha, d.decode())) for d in group]
                split = [d.split() if has else [] for d, has in zip(group, lettered)]
                every = set().union(*split)
                if missing := every.difference(known):
                    learn(missing)
                for words, has in zip(split, lettered):
                    if not has:
                        names.append("und")
                        scores.append(0.0)
                        continue
                    total = logs[np.fromiter(map(known.__getitem__, words), np.int64, len(words))].sum(axis=0) + priors
                    best = int(np.argmax(total))
                    names.append(langs[best])
                    scores.append(float(1 / np.exp(total - total[best]).sum()))
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    return rows.mapInArrow(predict, ", ".join([*kinds, "lang_pred string", "score double"]))

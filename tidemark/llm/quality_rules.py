"""Quality rules: fixed limits on counts, then a calibrated logistic regression on hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cmp_to_key

from pyspark.sql import DataFrame, Window, functions as F

from .common import collect_garbage, give_back, small_batches, text_bytes, windows, word_hashes

#: Buckets of the hashed features and the n-gram orders that go into them.
FEATURE_BITS = 17
WORD_ORDERS, CHAR_ORDERS = (1, 2), (2, 4)
#: Labelled rows that the model is fitted on at most: those whose ids have the lowest hashes.
SAMPLE_ROWS = 2000
#: Features that these rows may have together (12 bytes each); rows that would exceed it are left out of the fit.
SAMPLE_FEATURES = 20_000_000
#: Features that a step of the fit looks at together: what it needs beside the sample follows this, not the sample.
PART_FEATURES = 1 << 18
#: Folds whose held-out scores calibrate the probabilities, steps of the optimiser, ridge penalty.
FOLDS, STEPS, RIDGE = 4, 60, 1e-6
#: A document is kept if the probability of good quality is at least this.
KEEP_AT = 0.5
#: Base limits: fewest words, and the largest share of words in repeated windows, in percent.
LEAST_WORDS, MOST_REPEATED, WINDOW_WORDS = 10, 20, 5
#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes], hashes=None) -> int:
    """Words that lie in windows of WINDOW_WORDS words found twice or more in the text.

    Windows with equal hashes are compared word by word before they count.
    """
    import numpy as np

    n = len(words) - WINDOW_WORDS + 1
    if n < 2:
        return 0
    keys = windows(word_hashes(words) if hashes is None else hashes, WINDOW_WORDS)
    ordered = np.sort(keys)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    seen: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(keys, again)).tolist():
        seen.setdefault(tuple(words[i : i + WINDOW_WORDS]), []).append(i)
    edges = np.zeros(len(words) + 1, np.int32)
    for places in seen.values():
        if len(places) > 1:
            edges[places] += 1
            edges[np.array(places) + WINDOW_WORDS] -= 1
    return int((np.cumsum(edges[:-1]) > 0).sum())


def base_counts(data: bytes | None, words: list[bytes], hashes=None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a UTF-8 text, 0 for null."""
    if not data:
        return 0, 0, 0, 0, 0
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (len(words), len(b"".join(words).decode()), len(data) - len(data.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words, hashes))


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def hashed_features(data: bytes, hashes) -> list:
    """For each n-gram order the buckets of the text's n-grams, words first, then characters (code points)."""
    import numpy as np

    shift, out = np.uint64(64 - FEATURE_BITS), []
    chars = np.frombuffer(data.decode().encode("utf-32-le"), "<u4").astype(np.uint64)
    for salt, (units, n) in enumerate([(hashes, n) for n in WORD_ORDERS] + [(chars, n) for n in CHAR_ORDERS]):
        if len(units) < n:
            out.append(np.zeros(0, np.int64))
            continue
        mixed = windows(units, n) + np.uint64(salt * 0xA24BAED4963EE407 & (1 << 64) - 1)
        mixed *= np.uint64(0x9FB21C651E98DF25)
        out.append((mixed >> shift).astype(np.int64))
    return out


@dataclass
class Model:
    """Weights of the buckets; a text's logit is the bias plus, for each order, the mean weight of its n-grams.
    probability = 1 / (1 + exp(-(slope * logit + shift))), fitted on held-out scores."""

    weights: object
    bias: float
    slope: float
    shift: float

    def probability(self, grams: list) -> float:
        import math

        logit = self.bias + sum(float(self.weights[g].mean()) for g in grams if len(g))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * logit + self.shift))))


def _parts(starts):
    """(first feature, end, first row, features of each row) of parts of PART_FEATURES; row i has features starts[i] to starts[i + 1]."""
    import numpy as np

    for a in range(0, int(starts[-1]), PART_FEATURES):
        b = min(a + PART_FEATURES, int(starts[-1]))
        first, end = int(np.searchsorted(starts, a, "right")) - 1, int(np.searchsorted(starts, b, "left"))
        yield a, b, first, np.diff(np.clip(starts[first : end + 1], a, b))


def _logits(starts, columns, values, weights, bias: float):
    import numpy as np

    logits = np.full(len(starts) - 1, bias)
    for a, b, first, counts in _parts(starts):
        of = np.repeat(np.arange(len(counts)), counts)
        logits[first : first + len(counts)] += np.bincount(of, values[a:b] * weights[columns[a:b]], len(counts))
    return logits


def _fit(starts, columns, values, labels, inside, n_features: int):
    """Logistic regression by Adam on all rows that are inside at once; sparse features by row, taken part by part."""
    import numpy as np

    weights, bias = np.zeros(n_features), 0.0
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    balance = np.zeros(len(labels))
    for label in (0, 1):
        of = inside & (labels == label)
        balance[of] = 0.5 / max(1, of.sum())
    for step in range(1, STEPS + 1):
        logits = _logits(starts, columns, values, weights, bias)
        error = (1 / (1 + np.exp(-np.clip(logits, -50, 50))) - labels) * balance
        slope = RIDGE * weights
        for a, b, first, counts in _parts(starts):
            slope += np.bincount(columns[a:b], values[a:b] * np.repeat(error[first : first + len(counts)], counts), n_features)
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        mb, vb = 0.9 * mb + 0.1 * error.sum(), 0.99 * vb + 0.01 * error.sum() ** 2
        rate = 0.5 / (1 - 0.9**step) * (1 - 0.99**step) ** 0.5
        weights -= rate * m / (np.sqrt(v) + 1e-9)
        bias -= rate * mb / (vb**0.5 + 1e-9)
    return weights, bias


def _order(a: tuple, b: tuple) -> int:
    """Compares examples by label, number of buckets, buckets and values; bytes are made for equal numbers only."""
    x, y = (a[0], len(a[1])), (b[0], len(b[1]))
    if x == y:
        x, y = (a[1].tobytes(), a[2].tobytes()), (b[1].tobytes(), b[2].tobytes())
    return (x > y) - (x < y)


def fit_model(examples: list) -> Model | None:
    """Fit on (label, buckets, values) of a bounded sample, which is used up; None without examples of both labels."""
    import numpy as np

    labels = np.array([label for label, _, _ in examples], float)
    if len(set(labels.tolist())) < 2:
        return None
    starts = np.cumsum([0, *(len(c) for _, c, _ in examples)])
    columns = np.concatenate([np.asarray(c, np.int32) for _, c, _ in examples])
    values = np.concatenate([np.asarray(x, np.float32) for _, _, x in examples])
    examples.clear()  # as much memory again
    give_back()
    held_out = np.zeros(len(labels))
    for fold in range(FOLDS):
        inside = np.arange(len(labels)) % FOLDS != fold
        if len(set(labels[inside].tolist())) < 2:
            continue
        scores = _logits(starts, columns, values, *_fit(starts, columns, values, labels, inside, 1 << FEATURE_BITS))
        held_out[~inside] = scores[~inside]
    # Platt's calibration on the held-out scores, by Newton steps
    slope, shift = 1.0, 0.0
    target = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((labels == 0).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * held_out + shift, -50, 50)))
        g = np.array([((p - target) * held_out).sum(), (p - target).sum()])
        w = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * held_out**2).sum() + 1e-3, (w * held_out).sum()], [(w * held_out).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        slope, shift = slope - float(np.clip(step[0], -1, 1)), shift - float(np.clip(step[1], -1, 1))
    weights, bias = _fit(starts, columns, values, labels, np.ones(len(labels), bool), 1 << FEATURE_BITS)
    return Model(weights.astype(np.float32), bias, max(slope, 1e-3), shift)


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample_rows: int = SAMPLE_ROWS,
          sample_features: int = SAMPLE_FEATURES) -> Model | None:
    """The model from at most sample_rows labelled ids, picked by a hash; the rest isn't learned from.

    Of rows that share an id, one is taken. Rows are taken in the order of the hash while their features,
    those of the rows before included, are sample_features at most.
    """
    spark = docs.sparkSession
    one = labels.filter(F.col(id_col).isNotNull() & F.col("quality").isin(0, 1)).groupBy(id_col).agg(F.min("quality").alias("__label"))
    picked = one.orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(sample_rows)
    bound = spark.createDataFrame(picked.select(F.col(id_col).alias("__id"), "__label").collect(), picked.select(F.col(id_col).alias("__id"), "__label").schema)
    sample = docs.filter(F.col(text_col).isNotNull()).join(F.broadcast(bound), F.col(id_col) == F.col("__id"))  # sample_rows ids at most

    def features(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        for batch in batches:
            out = ([], [], [], [], [])
            for key, label, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch, "text")):
                grams = hashed_features(data, word_hashes(data.split()))
                parts = [np.unique(g, return_counts=True) + (len(g),) for g in grams if len(g)]
                out[0].append(key)
                out[1].append(label)
                out[2].append(xxhash.xxh3_64_intdigest(data) >> 1)
                out[3].append(np.concatenate([p[0] for p in parts] or [np.zeros(0)]).astype(np.int32))
                out[4].append(np.concatenate([p[1] / p[2] for p in parts] or [np.zeros(0)]).astype(np.float32))
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, kinds)], names=["id", "label", "mark", "buckets", "shares"])

    rows = sample.select(F.col("__id").cast("string").alias("id"), F.col("__label").cast("int").alias("label"), F.col(text_col).alias("text"))
    made = rows.mapInArrow(features, "id string, label int, mark long, buckets array<int>, shares array<float>")
    one_each = made.groupBy("id").agg(F.min_by(F.struct("label", "buckets", "shares"), "mark").alias("row"))  # repeated ids
    used = F.sum(F.size("row.buckets")).over(Window.orderBy(F.xxhash64("id"), "id"))  # sample_rows rows at most
    table = one_each.withColumn("used", used).filter(F.col("used") <= sample_features).select("row.*").toArrow()
    if not table.num_rows:
        return None
    buckets, shares = table.column("buckets"), table.column("shares")
    examples = [(label, buckets[i].values.to_numpy(), shares[i].values.to_numpy()) for i, label in enumerate(table.column("label").to_pylist())]
    examples.sort(key=cmp_to_key(_order))  # the same folds whatever the order of rows
    del table, buckets, shares
    collect_garbage(spark)
    return fit_model(examples)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULTS = (*COUNTS, "base_failed", "probability", "kept")


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep_at: float = KEEP_AT, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with COUNTS, base_failed, probability and kept; columns of docs with those names are replaced.

    base_failed: fewer than LEAST_WORDS words, or over MOST_REPEATED percent of the words in repeated
    windows. Other documents are scored by a logistic regression on hashed word and character n-grams of
    the whole text, trained on labels (id, quality 0 or 1) and calibrated; kept if probability >= keep_at.
    probability is null where base_failed holds, and 1 without labelled rows of both kinds to learn from.

    Null and empty texts have no words and fail. Labels that are null or neither 0 nor 1 are ignored, of
    several for an id the lowest holds. Every row is returned, repeated ones too; an empty table gives none.
    Scoring is one pass in Arrow batches without a shuffle; the model is 2**FEATURE_BITS floats.
    """
    rows = docs.drop(*RESULTS)
    small_batches(docs.sparkSession)
    model = train(rows, labels, id_col, text_col, sample_rows)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**FEATURE_BITS floats

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            counts, failed, chances, kept = [], [], [], []
            for data in text_bytes(batch, text_col):
                words = data.split() if data else []
                hashes = word_hashes(words)
                counts.append(base_counts(data, words, hashes))
                failed.append(base_fails(counts[-1][0], counts[-1][4]))
                if failed[-1]:
                    chances.append(None)
                else:
                    chances.append(sent.value.probability(hashed_features(data, hashes)) if sent.value else 1.0)
                kept.append(not failed[-1] and chances[-1] >= keep_at)
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(COUNTS))]
            columns += [pa.array(failed, pa.bool_()), pa.array(chances, pa.float64()), pa.array(kept, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *RESULTS])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [f"{c} long" for c in COUNTS]
    return rows.mapInArrow(score, ", ".join([*kinds, "base_failed boolean", "probability double", "kept boolean"]))

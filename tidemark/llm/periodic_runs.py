"""Maximal periodic runs of words, found through string synchronising sets at dyadic scales."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE_CLASS, give_back, slices, small_batches, text_bytes

#: A run has at least so many words.
LEAST_WORDS = 12
#: Periods up to this are compared directly; those of scale tau are 3 tau - 1 to 6 tau - 2, the first tau is FIRST_SCALE.
DIRECT, FIRST_SCALE = 10, 4
#: Bytes of text whose words are searched together.
SLICE_BYTES = 2 << 20


def _joined(a, b):
    """A 64-bit hash of two neighbouring windows."""
    import numpy as np

    mixed = a * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed += b
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def _equal_stretches(t, q: int):
    """(begin, end) of the longest stretches of x with t[x] == t[x + q]."""
    import numpy as np

    edges = np.flatnonzero(np.diff(np.concatenate([[False], t[:-q] == t[q:], [False]])))
    return edges[::2], edges[1::2]


def _reach(t, x: int, q: int, step: int) -> int:
    """How far from x on (step 1), or before x (step -1), words are equal to those q later."""
    import numpy as np

    at, block = x, 64
    while True:
        if step > 0:
            end = min(at + block, len(t) - q)
            unequal = t[at:end] != t[at + q : end + q]
        else:
            end = max(at - block, 0)
            unequal = (t[end:at] != t[end + q : at + q])[::-1]
        if unequal.any():
            return at + step * int(np.argmax(unequal))
        if end == at or end in (0, len(t) - q):
            return end
        at, block = end, 4 * block


def synchronising_set(windows, repetitive, tau: int):
    """Positions i whose windows i to i + tau have their least hash at i or at i + tau.

    windows: hashes of the windows of tau words; repetitive: windows with a period of tau / 3 or less, which count
    as infinitely large. Membership depends on the 2 tau words from i on only, and any tau neighbouring positions
    have a member unless the 3 tau - 1 words from the first on have a period of tau / 3 or less.
    """
    import numpy as np

    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    ids = np.where(repetitive, most, windows)
    low, width = ids, 1
    while width < tau:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    n = len(ids) - tau
    low = np.minimum(low[:n], ids[tau:])
    return np.flatnonzero((low != most) & ((low == ids[:n]) | (low == ids[tau:])))


def _equal_contexts(chosen, contexts, least: int, most: int):
    """(position, distance) of members of a synchronising set with equal contexts at distances of least to most."""
    import numpy as np

    order = np.argsort(contexts, kind="stable")
    at, context = chosen[order], contexts[order]
    found, k = [np.empty((0, 2), np.int64)], 1
    while k < len(at):
        distance = at[k:] - at[:-k]
        near = (context[k:] == context[:-k]) & (distance <= most)
        if not near.any():
            break
        near &= distance >= least
        found.append(np.stack([at[:-k][near], distance[near]], 1))
        k += 1
    return np.concatenate(found)


def _junctions(t, runs, least: int, most: int, largest: int) -> list[tuple[int, int]]:
    """Proposals (position, period) where two regions of one period meet that is `largest` or less.

    A run whose first words are such a region has no member of the synchronising set to show its period. Its words
    are then a suffix of one region and a prefix of a neighbour that touches or overlaps it, and its period brings
    the phase of the one to that of the other: an arithmetic progression of periods for each meeting.
    """
    import numpy as np

    found = []
    regions = runs[(runs[:, 2] <= largest) & (runs[:, 1] >= least)]
    regions = regions[np.lexsort((regions[:, 0], regions[:, 2]))]
    ends = regions[:, 0] + regions[:, 1]
    meets = np.flatnonzero((regions[1:, 2] == regions[:-1, 2]) & (regions[1:, 0] <= ends[:-1]))
    for i in meets.tolist():
        (begin, n, p), (other, m, _) = regions[i].tolist(), regions[i + 1].tolist()
        end, other_end = begin + n, other + m
        root = t[end - p : end]
        phase = next((o for o in range(p) if (t[other + o : other + o + p] == root).all()), None)
        if phase is None:
            continue
        first = other + phase - (end - p)
        for q in range(least + (first - least) % p, most + 1, p):
            low, high = max(begin, other - q), min(end, other_end - q)
            if high - low >= q:
                found.append((low, q))
    return found


def find_runs(t, bounds, least_words: int = LEAST_WORDS):
    """Rows (start, length, period) of all maximal runs of the sequence t of integers, by start, then period.

    bounds: where each text begins in t, and the end; a text's last item must occur nowhere else, so that no run
    leaves a text. Periods up to DIRECT are compared directly. For larger ones, scale by scale: runs found so far
    tell the windows that are highly periodic, members of the scale's synchronising set with equal contexts of
    2 tau items propose their distance as a period, meeting regions supply the periods that the set omits, and
    each proposal is extended both ways by comparing items. Periods that aren't the smallest of their run go.
    """
    import numpy as np

    found = [np.empty((0, 3), np.int64)]
    for q in range(1, min(DIRECT, len(t) - 1) + 1):
        begin, end = _equal_stretches(t, q)
        enough = end - begin >= q
        found.append(np.stack([begin, end - begin + q, np.full(len(begin), q)], 1)[enough])
    sizes = np.diff(bounds)
    where = np.arange(len(t))
    windows = _joined(t.astype(np.uint64), np.uint64(1))
    width, tau = 1, FIRST_SCALE
    while (large := sizes > 2 * (3 * tau - 1)).any():
        while width < tau:
            windows, width = _joined(windows[:-width], windows[width:]), 2 * width
        if not large.all():  # short texts have no such period
            keep = np.repeat(large, sizes)
            windows, where, t, sizes = windows[keep[: len(windows)]], where[keep], t[keep], sizes[large]
        contexts = _joined(windows[:-tau], windows[tau:])
        runs = _minimal(np.concatenate(found))
        local = np.column_stack([np.searchsorted(where, runs[:, 0]), runs[:, 1:]])
        local = local[(local[:, 0] < len(where)) & (where[np.minimum(local[:, 0], len(where) - 1)] == runs[:, 0])]
        dense = local[(local[:, 2] <= tau // 3) & (local[:, 1] >= tau)]
        steps = np.zeros(len(t) + 1, np.int32)
        np.add.at(steps, dense[:, 0], 1)
        np.add.at(steps, dense[:, 0] + dense[:, 1] - tau + 1, -1)
        repetitive = np.cumsum(steps)[: len(windows)] > 0
        least, most = 3 * tau - 1, 6 * tau - 2
        chosen = synchronising_set(windows, repetitive, tau)
        chosen = chosen[chosen < len(contexts)]
        proposals = _equal_contexts(chosen, contexts[chosen], least, most)
        proposals = np.concatenate([proposals, np.array(_junctions(t, local, least, most, tau // 3), np.int64).reshape(-1, 2)])
        proposals = proposals[np.lexsort((proposals[:, 0], proposals[:, 1]))]
        made, period, seen = [], 0, 0
        for x, q in proposals.tolist():
            if q == period and x < seen:
                continue
            begin, end = _reach(t, x, q, -1), _reach(t, x, q, 1)
            period, seen = q, max(end, x + 1)
            if end - begin >= q:
                made.append((int(where[begin]), end - begin + q, q))
        if made:
            found.append(np.array(made, np.int64))
        tau *= 2
    runs = _minimal(np.concatenate(found))
    runs = runs[runs[:, 1] >= np.maximum(least_words, 2 * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _minimal(runs):
    """Of runs with the same words that with the smallest period."""
    import numpy as np

    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(1)])[: len(runs)]]


def _runs_of_batches(batches: Iterator) -> Iterator:
    from collections import defaultdict
    from itertools import count

    import numpy as np
    import pyarrow as pa

    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in slices(batches, 1, SLICE_BYTES):
        texts = [(data or b"").split() for data in text_bytes(batch, "__text")]
        ids: dict[bytes, int] = defaultdict(count().__next__)
        sizes = np.fromiter((len(words) + 1 for words in texts), np.int64, len(texts))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        t = np.empty(bounds[-1], np.int64)
        for begin, words in zip(bounds.tolist(), texts):
            t[begin : begin + len(words)] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        t[bounds[1:] - 1] = -1 - np.arange(len(texts))
        runs = find_runs(t, bounds)
        of_text = np.searchsorted(bounds, runs[:, 0], "right") - 1
        steps = np.zeros(len(t) + 1, np.int32)
        np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
        np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
        dropped = np.cumsum(steps) > 0
        cuts = np.searchsorted(of_text, np.arange(len(texts) + 1))
        collapsed = []
        for i, words in enumerate(texts):
            if cuts[i] < cuts[i + 1]:
                words = [w for w, gone in zip(words, dropped[bounds[i] : bounds[i + 1] - 1].tolist()) if not gone]
            collapsed.append(b" ".join(words))
        fields = [pa.array(c) for c in (runs[:, 0] - bounds[of_text], runs[:, 1], runs[:, 2])]
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(run_type)))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(collapsed, pa.binary()).cast(pa.string())], names=["__id", "runs", "collapsed"])
    give_back()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, collapsed) for every row of docs.

    A text's words are separated by bytes of [\\x20\\x09-\\x0D] and numbered from 0. A run is a stretch of words with
    smallest period q, at least LEAST_WORDS and 2 q words long, that can't be made longer with that period. `runs`
    has all of them as (start, length, period), by start, then period; `collapsed` the words that no run has after
    its first q words, joined by one space.

    Rows are worked on where they are read, without a shuffle: equal texts, ids and repeated rows are results of
    their own. A null text and one without words have no runs and an empty collapsed text; a null id stays null. A
    very long text is searched whole, in memory in proportion to it. Other columns of docs are ignored, whatever
    their names. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    found = rows.mapInArrow(_runs_of_batches, f"__id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return found.withColumnRenamed("__id", id_col)


def longest_run(runs: Column) -> Column:
    """The run with greatest length; of equals that with the smallest start, then period. Null where there is none."""
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)), lambda best, run: F.when(run["length"] > best["length"], run).otherwise(best))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): with h = crc32 of doc_id as text, a tenth of the texts (h % 10 = 0) gets a period.

    Words from a = floor(h / 10) % n on repeat the first p = 1 + floor((n - a) / (3 + floor(h / 10) % 8)) of them; n is
    the number of words. Rows with a null id keep their texts.
    """
    words = F.filter(F.split("text", f"{SPACE_CLASS}+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("long")).withColumn("g", F.floor(F.col("h") / 10))
    planted = F.expr(
        "array_join(transform(sequence(0, cast(n - 1 as int)), i -> get(words, cast(if(i < g % n, i, g % n + (i - g % n) % (1 + (n - g % n) div (3 + g % 8))) as int))), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))

"""Small cases for every operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import collections
import hashlib
import math
import random
import zlib

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id, lm_scoring, queries
from tidemark.llm.chat_format import format_preferences, neighbour_pairs
from tidemark.llm.components import connected_components
from tidemark.llm.exact_dedup import exact_dedup, exact_dedup_rows
from tidemark.llm.mixing import mix_report, mix_rows
from tidemark.llm.ngram_join import Link, ngram_join, one_of_each_component
from tidemark.llm import quality_rules as quality_rules_module
from tidemark.llm.quality_rules import base_counts, quality_rules, repeated_words, train
from tidemark.llm.token_file import Segment, build_index, fetch, new_folder, read_tokens, write_tokens
from tidemark.llm.url_filter import url_filter

LONG = "word " * 30_000


def docs_of(spark, rows):
    """(doc_id, text, source, lang) with columns whose names clash with results."""
    full = [(i, t, s, "en") for i, t, s in rows]
    return spark.createDataFrame(full, "doc_id long, text string, source string, lang string").selectExpr(
        "*", "'x' as kept", "7 as size", "'y' as keep_id", "1 as n", "2 as node", "'z' as score", "3 as key", "4 as label")


# exact dedup


def dedup_by_hand(rows):
    import re

    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return {(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")): groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")] for i, t, _ in rows}


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_exact_dedup_against_grouping(spark, partitions):
    rows = [(i, t, "s") for i, t in enumerate(["a b", "a  b", "a\tb", None, "", "c", "A b", " a b", LONG, LONG + "x", "é", "a\u00a0b"])]
    rows += [(100 + i, "hot copy of one text", "s") for i in range(400)] + [(900 + i, f"hot copy of one text {i % 50}", "s") for i in range(100)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = exact_dedup(docs_of(spark, rows)).collect()
        kept = sorted(r.doc_id for r in exact_dedup_rows(docs_of(spark, rows)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = dedup_by_hand(rows)
    assert len(got) == len(rows)
    for (i, text), group in want.items():
        row = next(r for r in got if r.doc_id == i)
        assert (row.keep_id, row.group_size, row.kept) == (min(group), len(group), i == min(group)), (i, text)
        assert row.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert kept == sorted(r.doc_id for r in got if r.kept)


def test_exact_dedup_repeats_nulls_and_empty_tables(spark):
    rows = [(5, "x", "s"), (5, "x", "s"), (None, "x", "s"), (None, "alone", "s")]
    got = exact_dedup(docs_of(spark, rows)).collect()
    assert sum(r.kept for r in got) == 2 and {r.keep_id for r in got if r.group_size == 3} == {5}
    assert [r.keep_id for r in got if r.group_size == 1] == [None]
    assert exact_dedup(docs_of(spark, [])).count() == 0 and exact_dedup_rows(docs_of(spark, [])).count() == 0


# quality rules


def test_base_counts_by_hand():
    text = "one two three four five\n\none two three four five\n#x $y\none two three four five \né"
    data = text.encode()
    assert base_counts(data, data.split()) == (18, sum(len(w) for w in text.split()), 2, 1, 15)
    assert base_counts(None, []) == (0, 0, 0, 0, 0)
    assert repeated_words(b"a a a a a a".split()) == 6 and repeated_words(b"a b c d e".split()) == 0


def test_fitting_takes_little_more_memory_than_the_sample():
    import tracemalloc

    import numpy as np

    pick = np.random.default_rng(3)
    buckets = [np.unique(np.r_[pick.integers(1000, 1 << 17, 5000), np.arange(100) + i % 2 * 100]).astype(np.int32) for i in range(200)]
    examples = [(i % 2, b, np.full(len(b), 1 / len(b), np.float32)) for i, b in enumerate(buckets)]
    empty = np.zeros(0, np.int32)
    examples[50:50] = [(1, empty, empty.astype(np.float32))]
    features = sum(map(len, buckets))
    tracemalloc.start()
    model = quality_rules_module.fit_model(examples)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.weights[100:200].mean() > 0.1 > -0.1 > model.weights[:100].mean()
    assert peak < 30 * features


def test_the_drivers_heap_is_collected_between_jobs(spark, monkeypatch):
    from tidemark.llm import common

    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: max(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    before = full()
    monkeypatch.setattr(common, "HEAP_SHARE", 0)
    assert common.materialise(spark.range(3), "heap").count() == 3
    assert full() > before


def test_quality_rules_learns_and_keeps_rows(spark):
    good = "the river ran past quiet fields and the people walked slowly home before night {}"
    bad = "buy### now$$$ cheap%%% deal&&& click### here$$$ win%%% cash&&& free### money$$$ {}"
    rows = [(i, (good if i % 2 else bad).format(i), "s") for i in range(120)] + [(500, None, "s"), (501, "", "s"), (502, "same words again " * 40, "s"), (503, LONG, "s")]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)] + [(None, 1, 0), (3, None, 0), (600, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_rules(docs_of(spark, rows), labels).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept == bool(i % 2) for i in range(120))
    assert all(got[i].base_failed and not got[i].kept and got[i].probability is None for i in (500, 501, 502, 503))
    no_labels = quality_rules(docs_of(spark, rows), labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in no_labels)
    assert quality_rules(docs_of(spark, []), labels).count() == 0


def test_quality_sample_is_bounded_by_ids_and_features(spark):
    rows = [(i, f"plain words of {'good' if i % 2 else 'bad'} text {i}", "s") for i in range(40)] + [(7, f"copy {i} of a labelled id", "s") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    learned = train(docs_of(spark, rows), labels, "doc_id", "text")
    assert learned is not None and train(docs_of(spark, rows), labels, "doc_id", "text", sample_features=1) is None
    again = train(docs_of(spark, rows).repartition(7), labels, "doc_id", "text")
    assert (learned.weights == again.weights).all() and learned.slope == again.slope


# token files


def test_hash_index_is_minimal_and_perfect():
    for n in (0, 1, 2, 3, 17, 900):
        keys = [i * i * 7919 - 50 for i in range(n)]
        segment = Segment(build_index(keys, list(range(n)), [k % 5 for k in range(n)]), b"")
        assert [segment.find(k) for k in keys] == [(i, i % 5) for i in range(n)]
        assert len(segment.slots) == n


def test_token_file_round_trip(spark):
    path, pattern = P.path("byte_bpe_50k.json"), P.PATTERN
    rows = [(9, "some text", "s"), (2, None, "s"), (4, "", "s"), (7, LONG, "s"), (7, "again", "s"), (None, "no key", "s"), (-3, "first", "s")]
    folder = new_folder(spark)
    write_tokens(docs_of(spark, rows), folder, path, pattern)
    got = read_tokens(spark, folder).collect()
    from tokenizers import Tokenizer

    encode = lambda t: Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids + [0]
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == [-3, 2, 4, 7, 7, 9, None]
    assert sum(r.n_tokens for r in got) == sum(len(encode(t)) for _, t, _ in rows)
    start = 0
    for r in ordered:
        assert r.start == start
        start += r.n_tokens
    two = next(r for r in got if r.doc_id == 9)
    assert two.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in encode("some text")))
    assert {r.key: list(r.ids) for r in fetch(spark, folder, [9, 2, 12345]).collect()} == {9: encode("some text"), 2: [0]}
    empty = new_folder(spark)
    write_tokens(docs_of(spark, []), empty, path, pattern)
    assert read_tokens(spark, empty).count() == 0


def test_token_file_knows_added_tokens(spark):
    from tokenizers import Tokenizer

    path, end, pick = P.path("byte_bpe_50k.json"), "<|endoftext|>", random.Random(5)
    texts = [f"a {end} b", end, end * 3, f"{end} a", f"a{end}", f"a  {end}\n\n b {end}", "<|endoftext|", f"<|{end}|>", None, "", "none of them"]
    texts += ["".join(pick.choice([end, " ", "\n", "word", "isn't", "é", "<|", "|>", "endoftext", "  12"]) for _ in range(pick.randrange(30))) for _ in range(200)]
    library, folder = Tokenizer.from_file(path), new_folder(spark)
    wanted = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    assert wanted[0] == [64, 220, 50256, 275, 0]
    write_tokens(docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)]), folder, path, P.PATTERN)
    assert {r.key: list(r.ids) for r in fetch(spark, folder, [*wanted]).collect()} == wanted
    start = 0
    for r in sorted(read_tokens(spark, folder).collect(), key=lambda r: r.doc_id):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(wanted[r.doc_id]), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in wanted[r.doc_id])))
        start += r.n_tokens


# language


def test_forward_sums_all_segmentations():
    import numpy as np

    path = P.path("piece_bpe_32k.model")
    vocabulary, _ = language_id._vocabulary(path)
    chances = np.random.default_rng(5).dirichlet(np.ones(len(vocabulary) + 2), 2).T
    chances[-1] = 0

    def by_hand(text, column):
        if not text:
            return 1.0
        total = 0.0
        for k in range(1, len(text) + 1):
            piece = vocabulary.get(text[:k])
            if piece is None and k == 1:
                piece = len(vocabulary)
            if piece is not None:
                total += chances[piece, column] * by_hand(text[k:], column)
        return total

    words = ["reading", "lettre\u2603"[:7], "straßen"]
    got = language_id.Words(words, path).forward(chances)[-1]
    for word, row in zip(words, got):
        for column in (0, 1):
            assert math.isclose(row[column], by_hand(language_id.MARK + word, column), rel_tol=1e-9)
            assert math.isclose(math.log(row[column]), language_id.long_word_logs(word, chances, path)[column], rel_tol=1e-9)
    counts = language_id.Words(["ab", "of"], path).expected(chances[:, :1], np.array([[1.0, 2.0], [0.0, 1.0]]))
    assert counts.sum(axis=0)[1] > 2 * counts.sum(axis=0)[0] - 1e-9


def test_language_id_on_held_out_rows(spark):
    path = P.path("piece_bpe_32k.model")
    en = ["the people of the town were happy with this", "there is nothing that they could have done"]
    de = ["die Leute der Stadt waren damit nicht sehr glücklich", "es gibt nichts das sie hätten tun können"]
    train = spark.createDataFrame([(i, t, lang) for i in range(40) for lang, ts in (("en", en), ("de", de)) for t in ts] + [(99, None, "en"), (98, "x", None)], "doc_id long, text string, lang string")
    rows = [(1, "the happy people", "s"), (2, "nicht glücklich damit", "s"), (3, None, "s"), (4, "123 !!", "s"), (5, "", "s"), (6, "the " + "people" * 4000, "s")]
    got = {r.doc_id: r for r in language_id.identify(docs_of(spark, rows), train, path).collect()}
    assert [got[i].lang_pred for i in range(1, 7)] == ["en", "de", "und", "und", "und", "en"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language_id.identify(docs_of(spark, rows), train.limit(0), path).collect()} == {"und"}
    assert language_id.identify(docs_of(spark, []), train, path).count() == 0


# mixing


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (i % 40 + 1), ["a", "b", "c", None][0 if i < 900 else i % 4]) for i in range(1500)] + [(2000, LONG, "b"), (2001, None, "a"), (None, "w w", "c")]
    got = mix_report(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    longest = max(r["size"] for r in got)
    total = sum(r["size"] for r in got)
    targets = {r.source_size: r.target for r in got}
    assert math.isclose(sum(targets.values()), total) and all(t <= 3 * s + 1e-9 for s, t in targets.items())
    for size, target in targets.items():
        assert abs(sum(r.taken for r in got if r.source_size == size) - target) <= longest / 2 + 1
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    again = mix_report(docs_of(spark, rows).repartition(5)).collect()
    assert sorted(got, key=str) == sorted(again, key=str)
    mixed = mix_rows(docs_of(spark, rows))
    assert mixed.columns == docs_of(spark, []).columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert all(counts.get(r.doc_id, 0) * r["size"] == r.taken for r in got)
    assert mix_report(docs_of(spark, [])).count() == 0 and mix_rows(docs_of(spark, [])).count() == 0


# n-gram join


def components_by_hand(rows, link):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = min(link.words, len(w))
        sets.append((i, frozenset(tuple(w[j : j + n]) for j in range(len(w) - n + 1)) if w else frozenset()))
    label = list(range(len(sets)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and link.under * len(x & y) >= link.over * len(x | y):
                label[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for a in range(len(sets)):
        groups[find(a)].append(sets[a][0])
    return sorted((i, len(s), min(groups[find(a)])) for a, (i, s) in enumerate(sets))


@pytest.mark.parametrize("link, frequent", [(Link(words=3, over=90), 32), (Link(words=3, over=90), 4), (Link(words=5, over=80), 4), (Link(words=2, over=50), 4)])
def test_ngram_join_against_all_pairs(spark, link, frequent, monkeypatch):
    import random

    from tidemark.llm import ngram_join as module

    monkeypatch.setattr(module, "FREQUENT", frequent)
    pick = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = {n: [pick.choice(words) for _ in range(n)] for n in (12, 40, 160, 420, 5000)}
    rows = [(0, None), (1, ""), (2, "one"), (3, "ONE"), (4, "one two"), (5, " one\ttwo "), (6, "a b a b a b a b")]
    for n, text in base.items():
        for _ in range(60 if n < 1000 else 12):
            other = list(text)
            for _ in range(pick.randrange(0, max(2, n // 12))):
                other[pick.randrange(n)] = pick.choice(words)
            if pick.random() < 0.3:
                del other[: pick.randrange(1, 3)]
            rows.append((len(rows), " ".join(other)))
    for _ in range(60):
        rows.append((len(rows), " ".join(base[12] + [pick.choice(words) for _ in range(pick.randrange(3, 60))])))
    docs = docs_of(spark, [(i, t, "s") for i, t in rows])
    got = ngram_join(docs, link)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == components_by_hand(rows, link)


def test_ngram_join_with_more_frequent_shingles_than_places(spark, monkeypatch):
    from tidemark.llm import ngram_join as module

    for name, value in (("FREQUENT", 2), ("MAP_BITS", 10), ("SEGMENT_BITS", 4), ("SHARD_BYTES", 2000)):
        monkeypatch.setattr(module, name, value)
    pick, link = random.Random(8), Link(words=3, over=90)
    base = [[f"w{pick.randrange(4000)}" for _ in range(300)] for _ in range(12)]
    rows = []
    for text in base * 5:
        other = list(text)
        for _ in range(pick.randrange(4)):
            other[pick.randrange(300)] = f"n{len(rows)}"
        rows.append((len(rows), " ".join(other)))
    docs = docs_of(spark, [(i, t, "s") for i, t in rows])
    plain = docs.select(F.col("doc_id").alias("id"), "text")
    counted, _ = module.frequency_counts(plain, link)
    assert counted.count() > 3 * 1024  # no place of the map is free
    indexed = module._indexed(plain, module._frequencies(plain, link), link)
    assert indexed.filter("size(pairs) = 0").count() == 0  # frequent shingles are still combined
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join(docs, link).collect()) == components_by_hand(rows, link)


def test_ngram_join_repeats_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "s"), (1, text, "s"), (2, text, "s"), (None, text, "s"), (9, "other words here now", "s")]
    got = ngram_join(docs_of(spark, rows)).collect()
    assert sorted(r.component_id for r in got) == [1, 1, 1, 1, 9]
    assert sorted(r.doc_id for r in one_of_each_component(docs_of(spark, rows)).collect()) == [1, 1, 9]
    assert ngram_join(docs_of(spark, [])).count() == 0


def test_components_on_paths_and_stars(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[i] == 1000 for i in range(1000, 1050))


# urls


def test_url_filter_cases(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("bad.org", "/x", "block"), ("bad.org", "/x", "allow"), (None, "/", "block"), ("", "/", "block")], "rule_host string, rule_path string, action string")
    cases = {
        "http://a.net/": ("net/", "block"), "http://a.net": (None, "allow"), "HTTP://EXAMPLE.NET/en/1?q": ("example.net/en/", "allow"),
        "http://www.example.net/de/": ("net/", "block"), "http://notexample.net/en/": ("net/", "block"), "x://bad.org/xyz#f": ("bad.org/x", "allow"),
        "http://bad.org?/x": (None, "allow"), "no scheme": (None, "allow"), None: (None, "allow"), "": (None, "allow"), "http://" + "a." * 5000 + "net/en/": ("net/", "block"), "http:///net/": (None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)] + [(0, "http://a.net/", "h")], "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as rule", "3 as prefix")
    got = url_filter(pages, rules).collect()
    assert len(got) == len(cases) + 1
    for i, (url, (rule, verdict)) in enumerate(cases.items()):
        row = next(r for r in got if r.page_id == i)
        assert (row.rule, row.verdict) == (rule, verdict), url
    assert url_filter(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter(pages, rules.limit(0)).collect()} == {"allow"}


# language model


def test_lm_scores_base_and_proper_distribution(spark):
    texts = ["the cat sat", "The dog sat on the mat", None, "", "cat " * 2000] + [f"the {a} ran to the {b}" for a in ("dog", "cat", "fox") for b in ("mat", "hill")]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    learn = F.col("doc_id") % 3 != 0
    got = {r.doc_id: r for r in lm_scoring.lm_scores(docs_of(spark, rows), learn).collect()}
    counts = collections.Counter()
    tokens = {i: (t or "").encode().lower().split() + [b""] for i, t, _ in rows}
    for i, t in tokens.items():
        if i % 3:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    for i, t in tokens.items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        row = got[i]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(t), sum(counts[w] > 0 for w in t), n)
        assert math.isclose(row.base_score, base, rel_tol=1e-9) and row.score < 0 and math.isfinite(row.score)
    assert lm_scoring.lm_scores(docs_of(spark, []), learn).count() == 0
    none = lm_scoring.lm_scores(docs_of(spark, rows), F.lit(False)).collect()
    assert len(none) == len(rows) and all(r.train_tokens == 0 and r.n_known == 0 for r in none)


def test_lm_probabilities_sum_to_one():
    import numpy as np

    L, pick = lm_scoring, np.random.default_rng(1)
    shares = L.class_chances(pick.normal(size=(L.CLASS_ROWS, L.CLASSES)), np.arange((L.CLASSES + 1) ** 2))
    assert np.allclose(shares.sum(axis=1), 1)
    # every word of one class after one word: seen or not, and one that isn't known
    counts, before = np.r_[pick.integers(1, 400, 300), 0], np.where(pick.random(301) < 0.1, pick.integers(1, 9, 301), 0)
    before[-1] = 0
    keys = (np.uint64(5) << np.uint64(38)) | (np.uint64(7) << np.uint64(32)) | (np.arange(301).astype(np.uint64) << np.uint64(8)) | L.levels(counts)
    mass = np.ones(L.CLASSES)
    mass[7] += sum(10.0 ** (x / L.LEVEL_STEPS) for x in L.levels(counts[:-1]).tolist())
    for n in (before, before * 0):
        assert math.isclose((10 ** L.bigram_logs(keys, n.astype(float), mass)).sum(), 1, rel_tol=1e-9)


def block_by_bisection(block, share, variance, discount):
    """P(word) of the seen words of a block and of one unit of prior of the others, from the optimum's own equations."""
    total, rest = sum(block.values()), max(1 - sum(share[w] for w in block), 1e-12)

    def weight(w, z):
        low, high = -60.0, 60.0
        for _ in range(60):
            x = (low + high) / 2
            low, high = (x, high) if total * share[w] * math.exp(x) / z + x / variance < block[w] - discount else (low, x)
        return low

    low, high = math.log(rest), math.log(rest) + 60
    for _ in range(60):
        z = math.exp((low + high) / 2)
        more = rest + sum(share[w] * math.exp(weight(w, z)) for w in block) > z
        low, high = ((low + high) / 2, high) if more else (low, (low + high) / 2)
    return {w: share[w] * math.exp(weight(w, z)) / z for w in block}, 1 / z


def lm_by_hand(rows, learns, table, weights):
    """Scores from plain dictionaries: class softmax by the trained tables, regularised bigrams of a class by bisection."""
    import numpy as np
    import xxhash

    L, half = lm_scoring, len(weights) // 2
    tokens = {i: [w for w in (t or "").encode().lower().split()] + [b""] for i, t, _ in rows}
    kind = lambda w: L.word_class(w.decode()[-2:])
    counts, blocks = collections.Counter(), collections.defaultdict(collections.Counter)
    for i, t, _ in rows:
        if learns(i):
            counts.update(tokens[i])
            for one, w in zip([None, *tokens[i]], tokens[i]):
                blocks[one, kind(w)][w] += 1
    prior = lambda w: 10.0 ** (round(L.LEVEL_STEPS * math.log10((counts[w] + 0.1) / 0.1)) / L.LEVEL_STEPS)
    mass = {c: 1.0 for c in range(L.CLASSES)}
    for w in counts:
        mass[kind(w)] += prior(w)
    share = lambda w: prior(w) / mass[kind(w)]
    solved = {key: block_by_bisection(block, {w: share(w) for w in block}, L.VARIANCE, L.DISCOUNT) for key, block in blocks.items()}
    logs = np.log(L.class_chances(table, np.arange((L.CLASSES + 1) ** 2)))

    def row(word, salt):
        value = L.BEGIN_WORD if word is None else xxhash.xxh3_64_intdigest(word)
        return int(L._mix(np.array([(value + salt) % 2**64], np.uint64))[0]) % half

    out = {}
    for i, _, _ in rows:
        two, one, before, word, total = L.BEGIN, L.BEGIN, None, None, 0.0
        for w in tokens[i]:
            c = kind(w)
            logits = logs[two * (L.CLASSES + 1) + one] + weights[row(word, 0x51)] + weights[half + row(before, 0x7A3)]
            known, other = solved.get((word, c), ({}, 1.0))
            total += math.log10(math.exp(logits[c]) / np.exp(logits).sum()) + math.log10(known.get(w, other * share(w)))
            two, one, before, word = one, c, word, w
        out[i] = total
    return out


@pytest.mark.parametrize("chunk_bytes, shard_tokens", [(6 << 20, 1 << 19), (300, 70)])
def test_lm_score_is_the_sum_of_log_probabilities(spark, monkeypatch, chunk_bytes, shard_tokens):
    words = [f"w{i}" for i in range(300)] + ["Über", "ñandú", "x\x1cy"]
    pick, classes, weights, train, words_of = random.Random(3), [], [], lm_scoring.train_classes, lm_scoring.train_words
    rows = [(i, " ".join(pick.choices(words, range(len(words), 0, -1), k=pick.randrange(1, 60))), "s") for i in range(120)]
    rows += [(120, "", "s"), (121, "not known here", "s"), (122, None, "s"), (123, " w1\t\n W2 ", "s"), (124, LONG[:5000], "s"), (124, LONG[:5000], "s")]
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", shard_tokens)
    monkeypatch.setattr(lm_scoring, "train_classes", lambda *args: classes.append(train(*args)) or classes[0])
    monkeypatch.setattr(lm_scoring, "train_words", lambda *args: weights.append(words_of(*args)) or weights[0])
    got = lm_scoring.lm_scores(docs_of(spark, rows), F.col("doc_id") % 5 != 1).collect()
    wanted = lm_by_hand(rows, lambda i: i % 5 != 1, classes[0], weights[0])
    assert classes[0].any() and weights[0].any() and len(got) == len(rows)
    for r in got:
        assert math.isclose(r.score, wanted[r.doc_id], abs_tol=r.n_tokens / lm_scoring.ANSWER_STEPS + 1e-3), (r.doc_id, r.score, wanted[r.doc_id])


def test_lm_word_gradient_is_the_slope_of_the_likelihood(spark):
    import numpy as np

    L, pick = lm_scoring, np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in pick.integers(0, 40, 30)), "s") for i in range(60)]
    docs = docs_of(spark, rows).select(F.col("doc_id").alias("id"), "text", (F.col("doc_id") % 4 > 0).alias("learn"))
    chunks, logs = L.encode_chunks(docs).cache(), L.class_logs(np.zeros((L.CLASS_ROWS, L.CLASSES)))
    weights = pick.normal(size=(32, L.CLASSES)).astype(np.float32)
    likelihood, expected, seen = L._word_gradient(chunks, logs, weights, seen=True)
    tokens = 45 * 31
    assert math.isclose(seen[:16].sum(), tokens) and math.isclose(seen[16:].sum(), tokens) and math.isclose(expected.sum(), 2 * tokens, rel_tol=1e-4) and likelihood < 0
    for place in (np.unravel_index(seen[:16].argmax(), seen[:16].shape), (16 + seen[16:].sum(axis=1).argmax(), 5)):
        sides = []
        for step in (-0.1, 0.1):
            moved = weights.copy()
            moved[place] += step
            sides.append(L._word_gradient(chunks, logs, moved)[0])
        assert math.isclose((sides[1] - sides[0]) / 0.2, (seen - expected)[place], rel_tol=0.02, abs_tol=0.1)


def test_lm_contexts_share_their_softmax(spark):
    import numpy as np

    L, pick, rows = lm_scoring, np.random.default_rng(5), lm_scoring.MOST_WORD_ROWS
    history, one, two = (np.r_[high - 1, pick.integers(0, high, 30)] for high in ((L.CLASSES + 1) ** 2, rows, rows))
    of = np.r_[0, pick.integers(0, 31, 5000)]
    *got, times = L._contexts(history[of], one[of], rows + two[of], 2 * rows)
    assert dict(zip(zip(*(x.tolist() for x in got)), times.tolist())) == collections.Counter(zip(history[of].tolist(), one[of].tolist(), (rows + two[of]).tolist()))
    assert (np.diff(got[1]) >= 0).all() and all(len(x) == 0 for x in L._contexts(*[history[:0]] * 3, 2 * rows))
    # texts that repeat, against a softmax for each token
    texts = [" ".join(f"w{x}" for x in pick.integers(0, 30, 40)) for _ in range(20)]
    docs = docs_of(spark, [(i, texts[i % 20], "s") for i in range(200)]).select(F.col("doc_id").alias("id"), "text", (F.col("doc_id") % 20 > 3).alias("learn"))
    chunks = L.encode_chunks(docs).cache()
    logs, weights = L.class_logs(pick.normal(size=(L.CLASS_ROWS, L.CLASSES))), (2 * pick.normal(size=(32, L.CLASSES))).astype(np.float32)
    expected, likelihood = np.zeros(weights.shape), 0.0
    for row in chunks.collect():
        learning = np.repeat(L.unpack(row["learn"], "u1").astype(bool), L.unpack(row["lengths"], "<u4"))
        history, one, two, kind = L._histories(row.asDict(), 16)
        logits = (logs[history] + weights[one] + weights[two]).astype(float)
        share = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
        of_kind = np.log(share[np.arange(len(kind)), kind])
        assert np.allclose(L.token_class_logs(row.asDict(), logs, weights), of_kind, atol=1e-4)
        likelihood += of_kind[learning].sum()
        for at in (one, two):
            np.add.at(expected, at[learning], share[learning])
    got = L._word_gradient(chunks, logs, weights)
    assert math.isclose(got[0], likelihood, rel_tol=1e-6) and np.allclose(got[1], expected, rtol=1e-3, atol=1e-6)


def test_lm_beats_a_count_bigram_by_its_trained_word_and_skip_features(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")

    def held(**changed):
        for name, value in changed.items():
            monkeypatch.setattr(lm_scoring, name, value)
        rows = lm_scoring.lm_scores(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0).filter("not learn")
        row = rows.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n")).first()
        return row.score / row.n, row.base / row.n

    uni, pairs, types, totals, texts = collections.Counter(), collections.Counter(), collections.Counter(), collections.Counter(), []
    for r in docs.select("doc_id", "text").collect():
        words = (r.text or "").encode().lower().split() + [b""]
        if zlib.crc32(str(r.doc_id).encode()) % 10:
            uni.update(words)
            pairs.update(zip([None, *words], words))
        else:
            texts.append(words)
    for (one, _), n in pairs.items():
        types[one] += 1
        totals[one] += n
    base = lambda w: (uni[w] + 0.1) / (sum_all + 0.1 * (len(uni) + 1))
    sum_all = sum(uni.values())
    logs = [math.log10((pairs[one, w] + types[one] * base(w)) / (totals[one] + types[one]) if totals[one] else base(w)) for words in texts for one, w in zip([None, *words], words)]
    score, of_base = held()
    assert score > sum(logs) / len(logs) + 0.03 and score > of_base + 1
    gradient = lm_scoring._word_gradient

    def without_skips(chunks, table, weights, seen=False):
        likelihood, *sums = gradient(chunks, table, weights, seen)
        for s in sums:
            s[len(s) // 2 :] = 0
        return likelihood, *sums

    assert held(_word_gradient=without_skips)[0] < score - 0.01
    assert held(_word_gradient=gradient, WORD_ROUNDS=1)[0] < score - 0.005


# chat formatting


def test_preferences_by_hand(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (2, 2, "user", "why"), (3, 0, "user", "hi"), (4, 0, None, None), (None, 0, "user", "x"), (5, 0, "user", "hi"), (5, 1, "assistant", "yes")]
    conversations = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as prompt", "2 as a", "3 as b")
    pairs = spark.createDataFrame([(10, 1, 2), (11, 1, 3), (12, 1, 5), (13, 4, 1), (14, 1, 77), (14, 1, 77), (15, None, None)], "pair_id long, chosen_id long, rejected_id long")
    got = {r.pair_id: r for r in format_preferences(conversations, pairs).collect()}
    turn = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    one = got[10]
    assert (one.common, one.prompt, one.chosen) == (1, turn("user", "hi"), turn("assistant", "yes"))
    assert one.rejected == turn("assistant", "no") + turn("user", "why")
    assert [one.rejected[s.begin : s.end] for s in one.rejected_spans] == ["no<|end|>\n"]
    assert (got[11].common, got[11].rejected, got[11].rejected_spans) == (1, "", [])
    assert (got[12].common, got[12].chosen, got[12].rejected) == (2, "", "")
    assert (got[13].common, got[13].prompt, got[13].chosen) == (0, "", turn("", ""))
    assert (got[14].common, got[14].rejected, got[14].rejected_spans) == (0, None, None)
    assert (got[15].chosen, got[15].rejected) == (None, None)
    assert format_preferences(conversations, pairs).count() == 7
    assert format_preferences(conversations.limit(0), pairs.limit(0)).count() == 0


def test_neighbour_pairs_of_large_and_negative_ids(spark):
    ids = [2**60 + i for i in range(4)] + [-1, -2, -3, 2**63 - 1, -(2**63), 0, None]
    got = sorted(map(tuple, neighbour_pairs(spark.createDataFrame([(i,) for i in ids], "conv_id long")).collect()))
    assert got == [(-(2**62), -(2**63), None), (-2, None, -3), (-1, -2, -1), (0, 0, None), (2**59, 2**60, 2**60 + 1), (2**59 + 1, 2**60 + 2, 2**60 + 3), (2**62 - 1, None, 2**63 - 1)]


# queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    import duckdb

    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        connection.execute(f"create view {table} as select * from '/root/testdata/sf0.001/{table}.parquet'")
    want = connection.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda row: repr([round(x, 6) if isinstance(x, float) else x for x in row])
    assert sorted(map(plain, got.select(*want.columns).collect())) == sorted(map(plain, want.fetchall()))

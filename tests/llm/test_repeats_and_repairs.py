"""Periodic runs, SimHash and conversation repair against brute force, on hard rows and on the given tables."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import queries, simhash, turn_repair
from tidemark.llm.periodic_runs import find_runs, longest_run, periodic_runs, with_planted_periods
from tidemark.llm.simhash import BkForest, fingerprint_links, shingle_hashes, simhash_components
from tidemark.llm.turn_repair import STATES, WHOLE, Repair, Turn, cheapest_edits, damaged, repair_conversations

FOLDER = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def docs_of(spark, rows):
    """(doc_id, text) with columns whose names clash with results and helpers."""
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as runs", "'x' as collapsed", "2 as fingerprint", "3 as component_id", "4 as id", "'y' as __id", "5 as n", "6 as label", "7 as h", "8 as words")


# periodic runs


def runs_by_hand(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, m, q) for (s, m), q in found.items() if m >= max(least, 2 * q))


def collapsed_by_hand(words, runs):
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(pick):
    kind, n = pick.randrange(5), pick.randrange(0, 260)
    if kind == 0:
        return [pick.choice("ab") for _ in range(n)]
    if kind == 1:  # a repeated unit with changes
        made = ([pick.choice("ab") for _ in range(pick.randrange(1, 40))] * 260)[:n]
        for _ in range(pick.randrange(4) if made else 0):
            made[pick.randrange(len(made))] = pick.choice("abc")
        return made
    if kind == 2:  # Fibonacci words have runs of many periods
        a, b = "a", "ab"
        while len(b) < n:
            a, b = b, b + a
        return list(b[:n])
    if kind == 3:  # a periodic word twice: the period that the synchronising set omits
        x = ([pick.choice("ab") for _ in range(pick.randrange(1, 7))] * 90)[: pick.randrange(5, 90)]
        return ["z"] * pick.randrange(2) + x + x + x[: pick.randrange(9)] + [pick.choice("ab") for _ in range(9)]
    unit = [str(pick.randrange(50)) for _ in range(pick.randrange(1, 60))]
    return [str(pick.randrange(50)) for _ in range(20)] + unit * pick.randrange(1, 4) + [str(pick.randrange(50)) for _ in range(20)]


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_comparing_every_period(seed):
    pick = random.Random(seed)
    for _ in range(120):
        texts, least = [some_words(pick) for _ in range(pick.randrange(1, 6))], pick.choice([1, 12])
        ids = {w: i for i, w in enumerate(sorted({w for words in texts for w in words}))}
        t, bounds = [], [0]
        for i, words in enumerate(texts):
            t += [ids[w] for w in words] + [-1 - i]
            bounds.append(len(t))
        want = sorted(((s + bounds[i], m, q) for i, words in enumerate(texts) for s, m, q in runs_by_hand(words, least)), key=lambda r: (r[0], r[2]))
        assert [tuple(r) for r in find_runs(np.array(t, np.int64), np.array(bounds), least).tolist()] == want


def test_periodic_runs_on_hard_rows(spark):
    line = "one two three four five six seven eight "
    rows = [(1, line * 3), (1, line * 3), (2, None), (3, ""), (4, " \t\n"), (None, "a " * 12), (5, "a " * 11), (6, "word " * 30_000), (7, "x\x1cy z " * 12),
            (8, "A a " * 8), (9, "é\n" * 13 + "e " * 13), (10, (" ".join(map(str, range(700))) + " ") * 2 + "end")]
    got = periodic_runs(docs_of(spark, rows)).withColumn("best", longest_run(F.col("runs"))).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "runs", "collapsed", "best"}
    texts = dict(rows)
    for r in got:
        words = words_of(texts[r.doc_id])
        want = runs_by_hand(words) if len(words) < 2000 else [(0, len(words), 1)]
        assert [tuple(x) for x in r.runs] == want, r.doc_id
        assert r.collapsed == collapsed_by_hand(words, want)
        assert (tuple(r.best) if r.best else None) == (min(want, key=lambda x: (-x[1], x[0], x[2])) if want else None)
    assert periodic_runs(docs_of(spark, [])).count() == 0


def planted_by_hand(doc_id, text):
    words, h = words_of(text), zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_op11_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = queries.op11_periodic_runs(spark, FOLDER).collect()
    assert len(got) == len(texts) and sum(r.n_runs > 0 for r in got) > 10
    for r in got:
        words = planted_by_hand(r.doc_id, texts[r.doc_id])
        runs = runs_by_hand(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda x: (x[0], x[2]))).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed_by_hand(words, runs).encode()).hexdigest()


def test_planted_periods_leave_nulls_and_empty_texts(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    rows = [(ids[0], None), (ids[1], ""), (ids[2], "one"), (ids[3], "a b c d e f g h i j k l m n o p"), (None, "a b c")]
    got = {r.doc_id: r.text for r in with_planted_periods(docs_of(spark, rows)).collect()}
    assert {i: words_of(t) for i, t in got.items()} == {i: planted_by_hand(i, t) for i, t in rows}


# SimHash


def fingerprint_by_hand(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words_of(text)]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(len(words) - 2, min(1, len(words))))]
    return sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64))


def components_by_hand(prints, radius=2):
    """For (id, fingerprint) pairs, the smallest id that links reach for each fingerprint."""
    distinct = sorted({p for _, p in prints})
    label = {p: p for p in distinct}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for i, p in enumerate(distinct):
        for q in distinct[:i]:
            if (p ^ q).bit_count() <= radius:
                label[root(p)] = root(q)
    least = {}
    for i, p in prints:
        if i is not None:
            least[root(p)] = min(i, least.get(root(p), i))
    return {p: least.get(root(p)) for p in distinct}


def near_prints(pick, n, spread):
    base = [pick.getrandbits(64) for _ in range(4)]
    made = {pick.choice(base) ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(spread))) for _ in range(n)}
    return [x - (1 << 64) if x >> 63 else x for x in made | {0, 1, (1 << 64) - 1}]


@pytest.mark.parametrize("nodes, spread", [(4096, 6), (16, 4), (3, 8)])
def test_links_join_what_all_pairs_join(spark, monkeypatch, nodes, spread):
    monkeypatch.setattr(simhash, "TREE_NODES", nodes)  # shards in many trees
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    prints = near_prints(random.Random(nodes), 300, spread)
    unsigned = {p: p & (1 << 64) - 1 for p in prints}
    found = fingerprint_links(spark.createDataFrame([(p,) for p in prints], "fingerprint long")).collect()
    assert all((unsigned[r.a] ^ unsigned[r.b]).bit_count() for r in found)
    label = {p: p for p in prints}
    for _ in prints:
        for r in found:
            label[r.a] = label[r.b] = min(label[r.a], label[r.b])
    want = components_by_hand([(p, u) for p, u in unsigned.items()])
    assert label == {p: want[u] for p, u in unsigned.items()}


def test_tree_follows_its_edges_only():
    pick = np.random.default_rng(5)
    prints = np.unique(pick.integers(0, 1 << 62, 400, np.uint64) & np.uint64(0x0F0F0F0F0F0F))
    shards = np.arange(len(prints)) % 3
    found = {(int(a), int(b)) for q, n in BkForest(shards, prints).within(shards, prints, 6) for a, b in zip(q, n)}
    close = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 6
    assert found == {(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(close))) if shards[a] == shards[b]}
    assert not list(BkForest(shards[:0], prints[:0]).within(shards[:3], prints[:3], 2))


def test_simhash_on_hard_rows(spark):
    body = " ".join(f"w{i}" for i in range(400))
    rows = [(7, body), (3, body + " more"), (9, body.upper()), (5, "other words here now"), (None, body), (2, None), (4, ""), (4, ""), (8, " \x0b"), (6, "one"), (10, "One"),
            (11, "one two"), (12, "É é"), (13, "É É"), (14, "word " * 30_000), (None, "alone with a null"), (15, "x\x1cy z"), (16, "x y z")]
    got = simhash_components(docs_of(spark, rows)).collect()
    want = components_by_hand([(i, fingerprint_by_hand(t)) for i, t in rows])
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, f"{fingerprint_by_hand(t):016x}", want[fingerprint_by_hand(t)])) for i, t in rows)
    assert simhash_components(docs_of(spark, [])).count() == 0
    assert list(shingle_hashes(b"a b")) == [xxhash.xxh64_intdigest(b"a b", 42)] and not len(shingle_hashes(None))


def test_op12_equals_brute_force(spark):
    rows = [(r.doc_id, fingerprint_by_hand(r.text)) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = components_by_hand(rows)
    assert sorted(map(tuple, queries.op12_simhash(spark, FOLDER).collect())) == sorted((i, f"{p:016x}", want[p]) for i, p in rows)


# conversation repair


def edits_by_hand(turns, state, goals):
    """Least (cost, audit) by dynamic programming over rows and states."""
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    want = {0: 2, 1: 2, 2: 3, 3: 2}

    def with_inserts(best):
        for _ in range(4):
            for q, (cost, audit) in list(best.items()):
                best[want[q]] = min(best.get(want[q], (10**9, "")), (cost + 2, audit + "I"))
        return best

    best = with_inserts({state: (0, "")})
    for turn in turns:
        made = {}
        for q, (cost, audit) in best.items():
            options = [(q, cost + 3, "D")]
            if turn.fault in ("", "truncated"):
                extra = cost + (turn.fault == "truncated")
                options += [(want[q], extra + 2, "R"), *([(keep[q, turn.initial], extra, "K")] if (q, turn.initial) in keep else [])]
            for to, total, edit in options:
                made[to] = min(made.get(to, (10**9, "")), (total, audit + edit))
        best = with_inserts(made)
    return min((best[g] for g in goals if g in best), default=None)


def some_turns(pick, n):
    return [Turn(pick.choice("uuaast"), pick.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(n)]


def test_search_equals_dynamic_programming():
    pick = random.Random(2)
    for n in [*range(9)] * 25 + [20, 40, 80]:
        turns = some_turns(pick, n)
        for state, goals in [(0, WHOLE), *((s, (g,)) for s in STATES for g in STATES if n < 20)]:
            assert cheapest_edits(turns, state, goals) == edits_by_hand(turns, state, goals), (turns, state, goals)


@pytest.mark.parametrize("stretch", [1, 2, 7, 64])
def test_stretches_add_up_to_one_search(monkeypatch, stretch):
    monkeypatch.setattr(turn_repair, "STRETCH", stretch)
    pick = random.Random(stretch)
    for n in [0, 1, 2, 3, 8, 9, 30, 60]:
        turns, repair = some_turns(pick, n), Repair()
        for i, turn in enumerate(turns):
            repair.add(i, turn.initial, str(i), turn.fault)
        cost, audit = edits_by_hand(turns, 0, WHOLE)
        at, lines = 0, []
        for edit in audit:
            if edit != "D":
                system = bool(lines) and lines[0].startswith("s:")
                lines.append(f"{turns[at].initial}:{at}" if edit == "K" else ("user:", "assistant:")[(len(lines) - system) % 2] + (str(at) if edit == "R" else ""))
            at += edit != "I"
        assert repair.result()[5:] == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def same_as_sql(spark, folder, files="conversations.parquet"):
    got = queries.op13_turn_repair(spark, folder)
    connection = duckdb.connect()
    connection.execute(f"create view conversations as select * from '{folder}/{files}'")
    want = connection.sql(queries.ORACLE_SQL["op13_turn_repair"]).select(*got.columns).fetchall()
    rows = list(map(tuple, got.collect()))
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    return rows


def test_op13_equals_sql(spark):
    assert len(same_as_sql(spark, FOLDER)) == 20


def test_repair_on_hard_rows(spark, tmp_path):
    pick = random.Random(9)
    texts = ["Fine.", "Cut off", "", " \t", None, "Why?", "End!  ", "a. b", "x" * 50_000 + "."]
    rows = [(c, pick.choice([None, *range(5)]) if c % 3 else t, pick.choice(["user", "assistant", "system", "tool", None, ""]), pick.choice(texts))
            for c in range(40) for t in range(pick.randrange(1, 7))]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (-5, -7, "user", "Hm."), (2**60, 2**62, "user", "A."), (2**60, 3, "assistant", "B.")]
    rows += rows[:9]
    rows += [(77, i, "ua"[i % 2] * 2, f"Row {i // 3}.") for i in range(150)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as seen", "2 as fault", "3 as kind", "4 as copy", "5 as gaps", "6 as __id")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    assert len(same_as_sql(spark, str(tmp_path), "conversations.parquet/*.parquet")) == len({r[0] for r in rows})
    assert repair_conversations(damaged(table.limit(0))).count() == 0
    assert repair_conversations(table.filter("conv_id = 1")).count() == 1  # without damage
    far = spark.createDataFrame([(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")], "conv_id long, turn long, role string, text string")
    assert repair_conversations(far).first().gaps is None


def test_a_conversation_that_is_dropped_whole(spark):
    key = next(c for c in range(500) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair_conversations(damaged(spark.createDataFrame([(key, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string"))).first()
    assert tuple(row) == (key, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())

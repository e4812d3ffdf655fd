"""Campaign progress, layouts, archive depth, funding coverage, range candidates and walk-forward roles on hard rows."""

import hashlib
import json

import numpy as np
import pytest

from tidemark.operators import features, funding, lookups, profiles

M, H, DAY = 60_000, 3_600_000, 86_400_000
JOBS = "campaign string, job long, pages long, rows long, started long, completed long"


def test_rates_and_statuses_of_campaigns(spark):
    now, window = 10_000, 4_000
    jobs = [("two", 1, 9, 1, 0, 5_999), ("two", 2, 5, 10, 100, 6_000), ("two", 3, 4, 20, None, 6_000), ("two", 4, 3, 30, 7_000, 9_000), ("two", 5, 8, 99, 9_000, 10_001),
            ("lone", 1, 7, 1, 8_000, 9_500), ("lone", 2, 6, 1, None, None), ("unknown", 1, 7, 1, None, 9_500), ("unknown", 2, 6, 1, None, None), ("old", 1, 7, 1, 0, 10), ("old", 2, 6, 1, 0, None),
            ("none", 1, 2, 1, None, None), ("done", 1, 2, 5, 0, 1), ("waiting", 1, 2, 5, 0, 1), ("slow", 1, 1, 1, 0, 6_000), ("slow", 2, 0, 1, 0, 6_000), ("slow", 3, 1, 1, 0, None), ("empty", 1, 0, 0, 0, 1)]
    table = spark.createDataFrame(jobs, JOBS)
    finalized = spark.createDataFrame([("done",), ("done",), ("gone",)], "campaign string")
    got = {r.campaign: r for r in profiles.campaign_progress(table, finalized, now, window).collect()}
    two = got["two"]  # the first of the recent ones, by time and number, only starts the clock; 10,001 is in the future
    assert (two.jobs, two.completed_jobs, two.completed_pages, two.pending_pages, two.completed_rows, two.last_completed, two.age_s) == (5, 4, 21, 8, 61, 9_000, 1)
    assert (two.sample_jobs, two.sample_pages, two.sample_ms, two.rate_milli, two.eta_s, two.millionths) == (2, 7, 4_000, 1_750, 5, 21 * 10**6 // 29)
    assert (got["lone"].sample_ms, got["lone"].rate_milli, got["lone"].eta_s) == (1_500, 4_666, 2)
    assert [(got[c].rate_milli, got[c].eta_s, got[c].status) for c in ("unknown", "old", "none", "done", "waiting", "slow")] == [
        (None, None, "in-progress"), (None, None, "in-progress"), (None, None, "not-started"), (None, 0, "complete"), (None, 0, "finalization-pending"), (None, None, "in-progress")]
    assert got["empty"].millionths is None and got["empty"].eta_s == 0

    def total(*names):
        return profiles.progress_total(profiles.campaign_progress(table.filter(table.campaign.isin(*names)), finalized, now, window)).collect()[0]

    assert (total("two", "lone", "done").eta_s, total("two", "none").eta_s, total("done").eta_s, total("waiting", "done").eta_s) == (5, None, 0, 0)
    assert (total("two", "done").campaigns, total("two", "done").pending_campaigns, total("two", "done").pages) == (2, 1, 31)
    nothing = total("absent")
    assert (nothing.campaigns, nothing.pages, nothing.millionths, nothing.eta_s) == (0, 0, None, 0)
    with pytest.raises(Exception, match="pending jobs"):
        profiles.campaign_progress(table, spark.createDataFrame([("two",)], "campaign string"), now, window).collect()


def test_layouts_tie_down_to_their_names(spark):
    mb = 1024 * 1024
    base = dict(buckets=4, numeric="decimal", compression="zstd", target_mb=10, verified=True, largest=8 * mb, bytes=100, write_ms=5, files=3, first=2, warm=1)
    changes = [{}, {"compression": "snappy"}, {"bytes": 101, "write_ms": 0}, {"verified": False, "bytes": 1}, {"largest": 8 * mb - 1, "bytes": 1}, {"verified": None, "bytes": 1}, {"warm": None, "bytes": 1},
               {"first": 0, "warm": 3, "compression": "lz4", "files": 4}, {"buckets": 8}, {"buckets": 8, "first": 1, "compression": "z"}, {"buckets": 16, "bytes": 1}]
    runs = spark.createDataFrame([tuple({**base, **c}.values()) for c in changes],
                                 "buckets int, numeric string, compression string, target_mb long, verified boolean, largest long, bytes long, write_ms long, files long, first long, warm long")
    got = {r.buckets: (r.eligible, r.compression, r.scan_ms) for r in profiles.shortlist_layouts(runs, ["first", "warm"]).collect()}
    assert got == {4: (4, "snappy", 3), 8: (2, "z", 2)}
    assert profiles.shortlist_layouts(runs.filter("buckets = 16"), ["first", "warm"]).count() == 0


def test_inversions_across_pages_equal_a_walk(spark):
    rng = np.random.default_rng(5)
    items = [(["hot", "cold"][int(rng.random() < 0.1)], int(rng.integers(0, 40)), i, None if rng.random() < 0.1 else int(rng.integers(0, 50))) for i in range(3_000)]
    items += [("blank", 1, i, None) for i in range(3)] + [("lone", 7, 1, 5)]
    got = {r.kind: (r.oldest, r.newest, r.n, r.inversions) for r in lookups.archive_bounds(spark.createDataFrame(items, "kind string, page long, place long, t long")).collect()}
    for kind in ("hot", "cold", "blank", "lone"):
        own = [t for k, _, _, t in sorted(items, key=lambda x: x[1:3]) if k == kind]
        timed = [t for t in own if t is not None]
        assert got[kind] == (min(timed, default=None), max(timed, default=None), len(own), sum(b > a for a, b in zip(timed, timed[1:])))


def test_depth_of_an_archive(spark):
    bounds = spark.createDataFrame([("new", 100, 900, 5, 0), ("gone", 50, 800, 5, 0), ("other", 10, 900, 9, 4)], "kind string, oldest long, newest long, n long, inversions long")
    life = spark.createDataFrame([(1, 100), (2, 500)], "k long, launch long")
    depth = lambda b, rows: lookups.archive_depth(b, rows, "new", ("new", "gone")).collect()[0]
    assert tuple(depth(bounds, life)) == (100, 10, 0, 2, 100, 500, 0, 0, "compatible")
    for more, before, unknown in ((99, 1, 0), (None, 0, 1)):
        r = depth(bounds, life.unionByName(spark.createDataFrame([(3, more)], "k long, launch long")))
        assert (r.before, r.unknown, r.status) == (before, unknown, "blocked")
    assert depth(bounds.filter("kind <> 'gone'"), life).status == "blocked" and depth(bounds.filter("kind <> 'gone'"), life).unordered == 1
    missing = depth(bounds.filter("kind <> 'new'"), life)
    assert (missing.listing_start, missing.before, missing.status) == (None, 2, "blocked")
    assert depth(bounds, life.limit(0)).instruments == 0


def test_funding_coverage(spark):
    step = 480 * M
    good = [(k, i * step, 480) for k in (1, 2, 3, 4, 5) for i in range(1, 5)]
    rows = good + [(6, step, 480), (6, step, 480), (6, 3 * step, 960), (6, 9 * step, None), (7, step, 60), (99, 0, 1)]
    asked = [(k, step, 4 * step, 0) for k in (1, 2, 3, 4, 5, 6, 7, 8)]
    pages = [(k, step, 2 * step, 2) for k in range(1, 8)] + [(k, 2 * step + M, 4 * step, 2) for k in (1, 3, 5, 6, 7)] + [(2, 2 * step + M, 4 * step, 0), (4, 2 * step + 2 * M, 4 * step, 2), (99, 0, 1, 0)]
    life = [(k, step, None) for k in (1, 2, 4, 6, 7, 8)] + [(3, step, 4 * step - 1)]
    rows, asked = spark.createDataFrame(rows, "k long, t long, interval long"), spark.createDataFrame(asked, "k long, start long, stop long, before long")
    pages, life = spark.createDataFrame(pages, "k long, page_start long, page_end long, n long"), spark.createDataFrame(life, "k long, launch long, delivery long")
    audit = funding.coverage_audit(rows, asked, pages, life)
    got = {r.k: r for r in audit.collect()}
    assert {k: r.passed for k, r in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: False, 8: False}
    assert (got[2].empty_pages, got[3].within_life, got[4].tiled, got[5].within_life, got[8].pages, got[8].tiled) == (1, False, False, False, 0, False)
    assert (got[1].stable_interval, got[1].window_minutes, got[6].stable_interval, got[6].duplicates, got[6].unexpected) == (480, 1441, None, 1, 1)
    reasons = {r.reason: r.n for r in funding.coverage_reasons(audit, rows, asked).collect()}
    assert (reasons["unrequested_instrument_row"], reasons["source_window_returned_no_event"], reasons["registry_lifecycle_failure"], reasons["range_not_tiled"]) == (1, 1, 2, 2)
    found = sorted((r.k, r.reason, r.place, r.start) for r in funding.coverage_anomalies(rows, asked, pages).collect())
    assert (2, "source_window_returned_no_event", None, 2 * step + M) in found and (8, "predecessor_interval_mismatch", None, None) in found and (7, "predecessor_interval_mismatch", 0, None) in found
    assert [x for x in found if x[0] == 6] == [(6, "internal_interval_mismatch", 1, None), (6, "internal_interval_mismatch", 3, None), (6, "unexplained_interval_change", 2, None)]
    assert not [x for x in found if x[0] in (1, 3, 4, 5, 99)]
    nothing = funding.coverage_reasons(funding.coverage_audit(rows.limit(0), asked.limit(0), pages.limit(0), life), rows.limit(0), asked.limit(0)).collect()
    assert len(nothing) == 9 and not any(r.n for r in nothing)


RULE = features.RangeRule("r", 5, 100, 5_000, 500, (200, 800), 1, 1, 600, 2, 5 * H, 2 * H)


def test_candidates_equal_a_walk(spark):
    rng = np.random.default_rng(11)
    bars = []
    for k in (1, 2, 3, 4):
        t = 0
        for _ in range(120):
            t += int(rng.integers(1, 3)) * H
            open_, close = (int(x) for x in rng.integers(950, 1050, 2))
            bars.append((k, t, open_, max(open_, close) + int(rng.integers(0, 9)), min(open_, close) - int(rng.integers(0, 9)), close, int(rng.integers(1, 5))))
    table = spark.createDataFrame(bars, "k long, t long, open long, high long, low long, close long, volume long")
    known = spark.createDataFrame([(1, 0), (2, 30 * H), (2, 10 * H), (3, None), (3, None)], "k long, launch long")
    got = {(r.k, r.t): r for r in features.range_candidates(table, RULE, known, {"dataset": "d"}).collect()}
    assert len(got) == len(bars)
    launch, w = {1: 0, 2: 30 * H}, RULE.rows
    for k in (1, 2, 3, 4):
        own = [b for b in bars if b[0] == k]
        rolled = []
        for i, (_, t, _, high, low, close, volume) in enumerate(own):
            part = own[max(0, i - w + 1) : i + 1]
            reach = [b[3] - b[4] if j == 0 else max(b[3] - b[4], abs(b[3] - own[j - 1][5]), abs(b[4] - own[j - 1][5])) for j, b in enumerate(own[: i + 1])][-w:]
            full = i >= w - 1
            mid, top, low_, atr, mean = (sum(b[5] for b in part) / w, max(b[3] for b in part), min(b[4] for b in part), sum(reach) / w, sum(b[6] for b in part) / w) if full else (None,) * 5
            before = rolled[-1] if rolled and rolled[-1]["mid"] is not None else None
            touch = (before is not None and low <= before["low"], before is not None and high >= before["top"])
            last = own[i - 1][5] if i else None
            cross = before is not None and ((last <= before["mid"] < close) or (last >= before["mid"] > close))
            rolled.append(dict(mid=mid, top=top, low=low_, touch=touch, cross=cross))
            drift = mid - rolled[i - w]["mid"] if i >= w and rolled[i - w]["mid"] is not None else None
            width = top - low_ if full else None
            seen = rolled[max(0, i - w + 1) :]
            want = dict(
                warm=drift is not None, complete=full and t - own[i - w + 1][1] <= RULE.most_span_ms, known=k in launch and t - launch[k] >= RULE.least_age_ms,
                height=full and mid * 100 <= width * 10_000 <= mid * 5_000, height_in_atr=full and width > 0 and width * 1000 >= atr * 500, mid_zone=full and width > 0 and width * 200 <= (close - low_) * 1000 <= width * 800,
                edges_touched=full and min(sum(s["touch"][0] for s in seen), sum(s["touch"][1] for s in seen)) >= 1, middle_crossed=full and sum(s["cross"] for s in seen) >= 1,
                horizontal=drift is not None and abs(drift) * 1000 <= width * 600, liquid=full and mean >= 2)
            r = got[k, t]
            assert {n: r[n] for n in features.FILTERS} == want, (k, i)
            assert r.accepted == all(want.values()) and r.rejections == ",".join(n for n in features.FILTERS if not want[n])
    assert 0 < sum(r.accepted for r in got.values()) < len(got) / 2
    one = got[1, bars[0][1]]
    text = json.dumps({"dataset": "d", "decision_ns": str(one.decision_ns), "k": "1", "rule": "r", "rule_sha256": RULE.digest()}, sort_keys=True, separators=(",", ":"))
    assert one.candidate_id == hashlib.sha256(text.encode()).hexdigest() and len({r.candidate_id for r in got.values()}) == len(got)
    assert features.range_candidates(table.limit(0), RULE, known, {"dataset": "d"}).count() == 0


def test_roles_at_boundaries(spark):
    fold = features.Fold("a", 100, 200, 300, 400)
    cases = {(1, 99, 99): "outside", (1, 100, 199): "train", (1, 150, 200): "purged", (1, 199, None): "unresolved", (1, 180, 170): "unresolved", (1, 200, 210): "embargo", (1, 209, None): "unresolved", (1, 210, 299): "validation",
             (1, 211, 300): "purged", (1, 300, 301): "embargo", (1, 310, 399): "test", (1, 311, 400): "purged", (1, 400, 401): "outside", (2, 150, 160): "held_out", (2, 205, None): "held_out", (2, 99, 99): "outside"}
    rows = spark.createDataFrame(list(cases), "k long, t long, known_at long")
    held = spark.createDataFrame([(2,), (2,), (None,), (9,)], "k long")
    got = {(r.k, r.t): r.role for r in features.split_roles(rows, [fold], 10, held).collect()}
    assert got == {(k, t): role for (k, t, _), role in cases.items()}
    later = features.Fold("b", 200, 300, 400, 500)
    both = features.split_roles(rows, [fold, later], 0, held.limit(0))
    assert both.count() == 2 * len(cases) and both.filter("fold = 'b' and role = 'train'").count() == 2 and both.filter("role = 'held_out'").count() == 0
    for bad in ([fold, fold], [features.Fold("c", 1, 2, 2, 3)]):
        with pytest.raises(ValueError):
            features.split_roles(rows, bad, 0, held)

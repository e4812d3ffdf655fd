"""Hand-made fixtures, accounting identities and metamorphic tests."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import exact, times
from tidemark.operators import admission, features, funding, gaps, lookups, maintenance, profiles, sets
from tidemark.sources import canonical, pages, ranges
from tidemark.sources.shared import checkpoints

M = 60_000


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# exact decimals


@pytest.mark.parametrize("text,units,places,fits4", [
    ("100.00000001", 10_000_000_001, 8, False), ("1.2300000000", 123_000_000, 2, True), ("0", None, 0, True), ("-1", None, 0, False),
    ("1e5", None, None, False), ("", None, None, False), (None, None, None, False), ("92233720368.54775807", 9_223_372_036_854_775_807, 8, False),
    ("92233720368.54775808", None, 8, False), ("0.000000001", None, 9, False), ("+7", 700_000_000, 0, True), ("1.23456", 123_456_000, 5, False), ("5.", None, None, False)])
def test_exact_text(spark, text, units, places, fits4):
    df = spark.createDataFrame([(text,)], "x string")
    x = F.col("x")
    got = df.select(exact.price_units(x), exact.decimal_places(x), exact.fits_decimal(x, 4)).first()
    assert tuple(got) == (units, places, fits4)


def test_times_do_not_depend_on_the_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-03-31 02:30:00.123456' as a, timestamp_ntz'1969-12-31 23:59:59.999' as b")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert tuple(df.select(times.epoch_ms(F.col("a")), times.epoch_ms(F.col("b"))).first()) == (1_711_852_200_123, -1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_candle_rules(spark):
    rows = [(1, 0, 5, 6, 4, 5, 1, 5, "linear", "s", "run", 0), (1, 1, 7, 6, 4, 9, -1, -5, "linear", " ", "run", 0), (0, M, 5, 3, 4, 5, 0, 0, "linear", None, "run", -1),
            (1, 2 * M, None, 6, 4, 5, 1, 1, "", "s", None, None), (None, None, None, None, None, None, None, None, None, None, None, None), (1, -M, 5, 6, 4, None, 1, None, "linear", "s", "run", 0)]
    df = spark.createDataFrame(rows, "k long, t long, open long, high long, low long, close long, volume long, turnover long, category string, source_id string, ingestion_id string, quality_flags long")
    got = {r.t: r.codes for r in df.select("t", admission.candle_violations().alias("codes")).collect()}
    assert got[0] == []
    assert got[1] == ["not_minute_aligned", "open_outside_low_high", "close_outside_low_high", "negative_volume", "negative_turnover", "empty_source_id"]
    assert got[M] == ["instrument_id", "low_exceeds_high", "open_outside_low_high", "close_outside_low_high", "empty_source_id", "negative_quality_flags"]
    assert got[2 * M] == ["null_price", "empty_category", "empty_ingestion_id", "negative_quality_flags"]
    assert got[None] == ["null_price", "null_volume", "instrument_id", "not_minute_aligned", "empty_source_id", "empty_category", "empty_ingestion_id", "negative_quality_flags"]
    assert got[-M] == ["null_price", "null_volume", "negative_time"]
    reasons = {r.t: r.reason for r in admission.quarantine(df).collect()}
    assert reasons == {0: None, 1: "rejected", M: "low_exceeds_high", 2 * M: "rejected", None: "rejected", -M: "rejected"}


def test_wrong_sides_and_stages(spark):
    here = spark.createDataFrame([("A", None), ("B", "on"), ("B", None)], "symbol string, status string")
    there = spark.createDataFrame([("A",), ("A",), ("C",)], "symbol string")
    assert sorted(map(repr, map(tuple, lookups.universe_compare(here, there).collect()))) == sorted(map(repr, [("A", None, "both"), ("B", "on", "current_only"), ("B", None, "current_only"), ("C", None, "archive_only")]))
    one, two = (spark.createDataFrame(x, "kind string, n long") for x in ([("a", 1), ("a", 2), ("b", 5), ("c", 1)], [("a", 3), ("b", 4), ("d", 1), (None, 2)]))
    got = {r.kind: tuple(r)[1:] for r in lookups.reconcile_stages(x=one, y=two).collect()}
    assert got == {"a": (3, 3, True), "b": (5, 4, False), "c": (1, None, False), "d": (None, 1, False), None: (None, 2, False)}


def test_registration_against_null_and_double_bindings(spark):
    existing = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (3, "x"), (3, "y"), (4, None), (4, "x")], "id long, binding string")
    batch = spark.createDataFrame([(1, None, None), (1, "x", None), (2, "x", 1), (2, None, 9), (3, "x", None), (4, None, None), (5, None, 5)], "id long, binding string, parent long")
    got = [r.state for r in sets.register(existing, batch).orderBy("id", F.col("binding").desc_nulls_last()).collect()]
    assert got == ["conflict", "same", "same", "orphan", "conflict", "conflict", "new"]


def test_steps_of_part_minutes_have_no_interval(spark):
    parent = spark.createDataFrame([(1, 0, 480), (1, 480 * M + 30_000, 480), (1, 960 * M, 480)], "k long, t long, interval long")
    made = funding.restate_intervals(parent, spark.createDataFrame([(1, 480 * M)], "k long, t long")).orderBy("t").collect()
    assert [(r.interval, r.interval_ok, r.restated) for r in made] == [(480, True, False), (480, True, False), (None, False, True), (None, False, True)]


# gaps


def requests(spark, *rows):
    return spark.createDataFrame(rows, "k long, start long, stop long")


def keys(spark, *rows):
    return spark.createDataFrame([(k, t * M) for k, t in rows] or [], "k long, t long")


def test_gap_ranges_and_topology(spark):
    wanted = requests(spark, (1, 0, 9 * M), (2, 0, 2 * M), (3, M, M))
    seen = keys(spark, (1, 2), (1, 3), (1, 3), (1, 6), (1, 7), (3, 1), (9, 0))
    assert rows_of(gaps.gap_ranges(wanted, seen), "k", "gap_start", "gap_end", "minutes") == [
        (1, 0, M, 2), (1, 4 * M, 5 * M, 2), (1, 8 * M, 9 * M, 2), (2, 0, 2 * M, 3)]
    top = {r.k: r for r in gaps.gap_topology(wanted, seen).collect()}
    assert (top[1].leading_minutes, top[1].internal_minutes, top[1].trailing_minutes, top[1].absent_minutes, top[1].missing) == (2, 2, 2, 0, 6)
    assert (top[2].absent_minutes, top[2].absent_ranges, top[2].missing) == (3, 1, 3) and top[3].missing == 0
    assert {k: n for k, n in rows_of(gaps.missing_keys(wanted, seen).groupBy("k").count(), "k", "count")} == {1: 6, 2: 3}


def test_gaps_of_overlapping_requests(spark):
    wanted = requests(spark, (1, 0, 9 * M), (1, 0, 20 * M), (1, 0, 20 * M))
    got = gaps.gap_topology(wanted, keys(spark, (1, 0), (1, 5)))
    assert rows_of(got, "k", "stop", "missing", "internal_minutes", "trailing_minutes") == [(1, 9 * M, 8, 4, 4), (1, 20 * M, 19, 4, 15)]


def test_coverage_identity(spark):
    wanted = requests(spark, (1, 0, 9 * M))
    rows = keys(spark, (1, 0), (1, 1), (1, 1), (1, 2), (1, 20))
    got = gaps.coverage_by_series(wanted, rows, keys(spark, (1, 4), (1, 0)), keys(spark, (1, 5), (1, 6)), rows).first()
    assert (got.expected, got.observed, got.row_count, got.missing, got.duplicates, got.unexpected) == (10, 3, 4, 7, 1, 1)
    assert got.missing == got.quarantined_missing + got.excluded_missing + got.no_data == 1 + 2 + 4 and not got.passed


def test_intervals_and_tiling(spark):
    df = requests(spark, (1, 0, M), (1, 2 * M, 3 * M), (1, 3 * M, 8 * M), (1, 10 * M, 11 * M))
    assert rows_of(gaps.merge_intervals(df), "k", "start", "stop", "parts", "overlaps") == [(1, 0, 8 * M, 3, 1), (1, 10 * M, 11 * M, 1, 0)]
    tiles = ranges.range_tiling(requests(spark, (1, 0, 25 * M)), 10)
    assert rows_of(tiles, "page_start", "page_end") == [(0, 9 * M), (10 * M, 19 * M), (20 * M, 25 * M)]
    assert gaps.tiling_check(tiles.withColumn("n", F.lit(1)), requests(spark, (1, 0, 25 * M))).first().tiled
    months = ranges.month_windows(requests(spark, (1, 1_706_700_000_000 // M * M, 1_709_300_000_000 // M * M)))
    assert [(y, m) for y, m in rows_of(months, "year", "month")] == [(2024, 1), (2024, 2), (2024, 3)]


# features


def synthetic(spark, minutes=200):
    return pages.synthetic_market(spark, 3, minutes)


def test_halo_equals_whole_history(spark):
    bars = synthetic(spark)
    start = 1_767_225_600_000 + 120 * M
    whole = features.features(bars, 20).filter(F.col("t") >= start)
    part = features.core_with_halo(bars, 20, start, 1_767_225_600_000 + 200 * M, 40 * M)
    assert whole.count() == part.count() == 240 and whole.exceptAll(part.select(*whole.columns)).count() == 0


def test_later_rows_change_nothing_before(spark):
    bars, cut = synthetic(spark), 1_767_225_600_000 + 150 * M
    changed = bars.withColumn("close", F.when(F.col("t") >= cut, F.col("close") + 999).otherwise(F.col("close")))
    a, b = (features.features(x, 30).filter(F.col("t") < cut) for x in (bars, changed))
    assert a.exceptAll(b).count() == 0


# settlements


def series(spark, intervals, low=()):
    t, out = funding.POLICY_START_MS + times.DAY, []
    for i, interval in enumerate(intervals):
        t += interval * M
        out.append((1, t, Decimal("0.0001") if i in low else Decimal("0.001"), interval))
    return spark.createDataFrame(out, "k long, t long, rate decimal(10,8), interval long")


@pytest.mark.parametrize("intervals,low,want", [
    ([240] * 3 + [60] * 20 + [240] * 3, range(6, 23), (1, 1, 0, 0, 2, 0)), ([60] * 20 + [120] + [480] * 3, range(4, 20), (1, 1, 0, 0, 2, 0)),
    ([480] * 3 + [60] * 10, (), (1, 0, 1, 1, 1, 0)), ([240] * 3 + [480] + [240] * 3, (), (0, 0, 0, 0, 0, 2)),
    ([240] * 3 + [60] * 20 + [240] * 3, (), (0, 0, 0, 0, 0, 2)), ([480] * 5, (), (0, 0, 0, 0, 0, 0)), ([300] * 5, (), (0, 0, 0, 0, 0, 0))])
def test_cadence_episodes(spark, intervals, low, want):
    got = funding.cadence_episodes(series(spark, intervals, set(low))).first()
    assert (got.episodes, got.completed, got.open, got.open_nonqualifying, got.explained, got.unexplained) == want


def walk_episodes(rows):
    """(episodes, completed, open, open_nonqualifying, explained, unexplained) of one series of (t, rate, interval) in order."""
    steps, defaults = [i for _, _, i in rows], (120, 240, 480)
    changes = sum(a != b for a, b in zip(steps, steps[1:]))
    runs = [[a, a + 1] for a, step in enumerate(steps) if step == 60 and (a == 0 or steps[a - 1] != 60)]
    for run in runs:
        while run[1] < len(steps) and steps[run[1]] == 60:
            run[1] += 1
    if not runs:
        return (0, 0, 0, 0, 0, changes)
    good, explained, completed, short = True, 0, 0, 0
    for number, (begin, end) in enumerate(runs):
        before = steps[runs[number - 1][1] if number else 0 : begin]
        after = steps[end : runs[number + 1][0] if number + 1 < len(runs) else None]
        trailing = 0
        while trailing < end - begin and abs(rows[end - 1 - trailing][1]) <= Decimal("0.00025"):
            trailing += 1
        good &= not before or (len({*before}) == 1 and before[0] in defaults)
        explained += bool(before)
        if after:
            completed += 1
            fine = len(after) >= 2 and after[1] in defaults and {*after[1:]} == {after[1]} and 60 < after[0] <= after[1] and after[0] % 60 == 0
            good &= fine and trailing in (16, 17)
            explained += 1 + (len(after) >= 2 and after[0] != after[1])
        else:
            short += trailing < 16
            good &= trailing <= 17
    if good and explained == changes:
        return (len(runs), completed, len(runs) - completed, short, explained, 0)
    return (0, 0, 0, 0, 0, changes)


def test_cadence_query_equals_a_walk_of_each_series(spark):
    from tidemark.plans import chronology

    series_of = {}
    for r in chronology._episode_rows(spark, "/root/testdata/sf0.001").collect():
        series_of.setdefault(r.k, []).append((r.t, r.rate, r.interval))
    names = ("episodes", "completed", "open", "open_nonqualifying", "explained", "unexplained")
    got = {r.k: tuple(r[n] for n in names) for r in chronology.episodes(spark, "/root/testdata/sf0.001").collect()}
    assert got == {k: walk_episodes(sorted(rows)) for k, rows in series_of.items()}
    assert any(v[1] for v in got.values()) and any(v[2] for v in got.values()) and any(v[5] for v in got.values())


def test_sandwiches_need_every_change_explained(spark):
    def found(intervals):
        return rows_of(funding.cadence_sandwiches(series(spark, intervals)), "interval", "gap")

    assert found([480, 480, 1440, 480, 480]) == [(480, 1440), (480, 1440)]
    assert found([480, 480, 1440, 480, 480, 240]) == [] and found([480, 480, 700, 480]) == []


def test_repair_restates_and_adds_up(spark):
    parent = series(spark, [480, 480, 1440, 480, 480]).select("k", "t", "interval")
    missed = funding.cadence_sandwiches(parent)
    whole = funding.restate_intervals(parent, missed)
    assert whole.count() == parent.count() + missed.count() and whole.filter("restated").count() == 1
    assert {r.interval for r in whole.collect()} == {480}


# lookups, sets, layout


def test_as_of_never_looks_ahead(spark):
    snaps = spark.createDataFrame([(1, 10, "a"), (1, 20, "b"), (2, 5, "c")], "k long, t long, status string")
    probes = spark.createDataFrame([(1, 9, 1), (1, 10, 2), (1, 19, 3), (1, 20, 4), (3, 7, 5)], "k long, t long, line long")
    got = lookups.as_of_snapshot(probes, snaps, ["status"])
    assert rows_of(got, "line", "status", "snapshot_t", "found") == [(1, None, None, False), (2, "a", 10, True), (3, "a", 10, True), (4, "b", 20, True), (5, None, None, False)]


def test_duplicate_dimension_is_an_error(spark):
    facts = spark.createDataFrame([("x", 1)], "symbol string, n long")
    twice = spark.createDataFrame([("x", 1.0), ("x", 2.0)], "symbol string, price double")
    with pytest.raises(Exception, match="duplicate key"):
        lookups.join_dimension(facts, twice).collect()


def test_lineage_and_registration(spark):
    checkpoints(spark)
    chain = spark.createDataFrame([(i, i - 1) for i in range(1, 12)], "child long, parent long")
    assert sets.lineage_closure(chain).count() == 66
    long = spark.createDataFrame([(i, i - 1) for i in range(1, 101)], "child long, parent long")
    assert sets.lineage_closure(long).count() == 5050
    cycle = sets.lineage_closure(spark.createDataFrame([(1, 2), (2, 1)], "child long, parent long"))
    assert cycle.filter("child = ancestor").count() == 2
    entries = "id string, binding string, parent string"
    state = sets.register(spark.createDataFrame([("a", "1", None)], entries), spark.createDataFrame([("a", "1", None), ("b", "2", "a"), ("c", "3", "zz")], entries))
    assert dict(rows_of(state, "id", "state")) == {"a": "same", "b": "new", "c": "orphan"}


def test_layout_round_trip_pruning_and_schema(spark, tmp_path):
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("k", "t", "close")])
    rows = synthetic(spark).select("k", "t", "close")
    canonical.write_canonical(rows, f"{tmp_path}/bars")
    stored = canonical.read_canonical(spark, f"{tmp_path}/bars", schema)
    assert stored.select("k", "t", "close").exceptAll(rows).count() == 0 and stored.count() == rows.count()
    picked = canonical.scan_selection(stored, 1_767_225_600_000, 1_767_225_600_000 + 9 * M, [2])
    assert picked.count() == 10
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan.replace("((", "(") or "bucket" in plan.split("PartitionFilters")[1]
    with pytest.raises(canonical.SchemaMismatch):
        canonical.read_canonical(spark, f"{tmp_path}/bars", T.StructType(schema.fields[:2]))
    assert canonical.manifest(stored).agg(F.sum("rows")).first()[0] == rows.count()
    assert canonical.empty_partition(spark, schema).count() == 0


def test_repair_outcome(spark):
    tasks = spark.createDataFrame([(1, 0, 2 * M, 3), (2, 0, 0, 1)], "k long, gap_start long, gap_end long, minutes long")
    got = rows_of(maintenance.repair_outcome(tasks, keys(spark, (1, 0), (1, 2), (1, 9))), "k", "returned", "missing", "passed")
    assert got == [(1, 2, 1, False), (2, 0, 1, False)]


def test_repairs_of_overlapping_gaps(spark):
    found = spark.createDataFrame([(1, 0, 4 * M, 5), (1, 2 * M, 9 * M, 8), (1, 20 * M, 21 * M, 2), (2, 0, 0, 1)], "k long, gap_start long, gap_end long, minutes long")
    planned = maintenance.plan_gap_repairs(found, keys(spark, (1, 9), (1, 10), (2, -1), (3, 0)), 4, 5)
    assert rows_of(planned, "k", "gap_start", "pages", "within_limit") == [(1, 0, 2, True), (1, 20 * M, 1, True), (2, 0, 1, True)]
    met = maintenance.repair_outcome(found, keys(spark, (1, 3), (1, 3), (1, 4), (1, 20), (1, 21)))
    assert rows_of(met, "k", "gap_start", "returned", "passed") == [(1, 0, 2, False), (1, 2 * M, 2, False), (1, 20 * M, 2, True), (2, 0, 0, False)]


def test_exact_coverage(spark):
    asked = spark.createDataFrame([(k, 0, 2 * M) for k in range(1, 6)], "k long, start long, stop long")
    rows = keys(spark, *[(1, m) for m in (0, 1, 2)], *[(2, m) for m in (0, 1, 1)], *[(3, m) for m in (0, 1, 2, 3)], *[(4, m) for m in (0, 2, 2)], (9, 0))
    got = maintenance.exact_coverage(rows, asked)
    assert rows_of(got, "k", "expected", "n", "exact") == [(1, 3, 3, True), (2, 3, 3, False), (3, 3, 4, False), (4, 3, 3, False), (5, 3, 0, False), (9, 0, 1, False)]


def test_files_must_fall(spark, tmp_path):
    rows = spark.range(100).selectExpr("id as k", "id as t", "id % 2 as part")
    rows.repartition(4).write.partitionBy("part").parquet(f"{tmp_path}/many")
    many = spark.read.parquet(f"{tmp_path}/many")
    maintenance.compact(many, f"{tmp_path}/few", 1000, ["part"])
    few = spark.read.parquet(f"{tmp_path}/few")
    assert rows_of(maintenance.files_fall(many, few, ["part"]), "part", "files_before", "files_after", "falls") == [(0, 4, 1, True), (1, 4, 1, True)]
    assert rows_of(maintenance.files_fall(few, few.filter("part = 0"), ["part"]), "part", "files_after", "falls") == [(0, 1, False), (1, 0, False)]


def test_listings_in_texts(spark):
    schema = "k long, symbol string, base string, event_t long"
    inst = spark.createDataFrame([(1, "BTCUSDT", "BTC", 50), (2, "1INCHUSDT", "1INCH", 50), (3, "OLDUSDT", "OLD", 5), (4, "NONEUSDT", "NONE", None), (5, "XUSDT", "X", 50), (6, "USDTUSDT", "USDT", 50)], schema)
    texts = ["NEW BTC/USDT PERPETUAL", "BTCUSDT CONTRACTS", "BTC - _/ USDT DERIVATIVES", "ABTCUSDT PERPETUAL", "BTCUSDTX PERPETUAL", "BTC/USDT SPOT", "BTC/USDT SUBCONTRACTS", "BTC:USDT PERPETUAL",
             "1INCH-USDT, BTC.USDT CONTRACT", "OLDUSDT PERPETUAL", "NONEUSDT PERPETUAL", "X USDT USDT PERPETUAL", None, ""]
    got = lookups.match_listings(inst, spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), 10)
    assert rows_of(got, "k", "matches", "class") == [(1, 3, "ambiguous"), (2, 1, "unique"), (3, 0, "outside_archive"), (5, 1, "unique"), (6, 1, "unique")]


def test_selection_of_inventories(spark):
    day = 86_400_000
    inventories = spark.createDataFrame([(100, "complete"), (200, "partial"), (5 * day, "complete")], "t long, inventory_status string")
    records = spark.createDataFrame([(100, 1, "a"), (200, 1, "a"), (5 * day, 2, "b"), (5 * day, 2, "b")], "snapshot_t long, k long, status string")
    probes = spark.createDataFrame([(1, 99), (1, 100), (1, 199), (1, 200), (1, 3 * day), (2, 5 * day), (1, 900 * day), (2, 900 * day)], "k long, t long")
    got = rows_of(lookups.select_as_of(probes, inventories, records, True), "t", "k", "snapshot_t", "problem")
    assert got == sorted([(99, 1, None, "before_first_snapshot"), (100, 1, 100, None), (199, 1, 100, None), (200, 1, 200, "partial_inventory"), (3 * day, 1, 200, "partial_inventory"),
                          (5 * day, 2, 5 * day, None), (900 * day, 1, 5 * day, "absent_instrument"), (900 * day, 2, 5 * day, None)], key=lambda r: r[:2])
    assert lookups.select_as_of(probes, inventories.limit(0), records).filter("problem = 'before_first_snapshot'").count() == 8
    assert lookups.timeline_summary(inventories, records.distinct()).first()[-2:] == (1, "b:1")


def test_stages_against_their_plans(spark):
    log = spark.createDataFrame([("a", 0, None, 5), ("a", 60_000, None, 5), ("b", 0, "E1", 9), ("b", 1, "E1", 9), ("b", 2, "E0", 9), ("c", 0, None, 1), ("c", 60_000, None, 1)], "stage string, t long, code string, rows long")
    plans = spark.createDataFrame([("a", 2, 2), ("b", 3, 1), ("c", 2, 3), ("d", 1, 1)], "stage string, planned long, target long")
    got = profiles.stage_status(log, plans)
    assert rows_of(got, "stage", "rows", "errors", "attainment", "status") == [
        ("a", 10, "", 1_000_000, "passed"), ("b", 0, "E0:1,E1:2", 90_000_000_000, "failed"), ("c", 2, "", 666_666, "under_target"), ("d", 0, "", None, "failed")]


def test_fragments_are_compacted_and_their_union_audited(spark, tmp_path):
    rows = [(1, 0, None, 0), (1, 480 * M, 480, 1), (1, 960 * M, 480, 0), (1, 960 * M, 480, 1),  # a key in two fragments
            (2, 0, None, 0), (2, 480 * M, 480, 0), (2, 1440 * M, 480, 1), (2, 1920 * M, None, 1),  # a settlement lacks between fragments, no interval
            (3, 0, 480, 2), (3, 60 * M, 60, 0)]
    table = maintenance.compact_fragments(spark.createDataFrame(rows, "k long, t long, interval long, fragment long"), str(tmp_path), 1000)
    assert len(list((tmp_path / "fragments").glob("fragment=*"))) == 3 and list((tmp_path / "compacted").glob("year=1970/month=1/bucket=*"))
    assert sorted(map(str, map(tuple, table.select("k", "t", "interval", "fragment").collect()))) == sorted(map(str, rows))
    got = rows_of(funding.union_audit(table), "k", "rows", "fragments", "duplicates", "interval_mismatch")
    assert got == [(1, 4, 2, 1, 1), (2, 4, 2, 0, 2), (3, 2, 2, 0, 0)]


def test_funding_compaction_writes_what_it_audits(spark, monkeypatch):
    from tidemark.plans import chronology

    made, whole = [], maintenance.compact_fragments
    monkeypatch.setattr(maintenance, "compact_fragments", lambda rows, *rest: made.append(whole(rows.withColumn("interval", F.col("interval") + 1), *rest)) or made[0])
    got = chronology.compact(spark, "/root/testdata/sf0.001")
    sums = got.agg(F.sum("rows"), F.sum("interval_mismatch"), F.count("*")).first()
    assert made and sums[0] == made[0].count() and sums[1] == sums[0] - sums[2] > 0  # all but each series' first row


def test_pairs_of_fragments(spark):
    rows = [("a", "x", 1, 0, 480), ("a", "x", 1, 480 * M, 480), ("b", "x", 1, 960 * M, 480), ("b", "x", 2, 0, None), ("c", "x", 1, 480 * M, 480), ("c", "x", 3, 0, 1), ("d", "y", 9, 0, 1),
            ("e", "x", 2, 60 * M, 30), ("f", "x", 1, 960 * M, 480), ("f", "x", 1, 1440 * M, None)]
    table = spark.createDataFrame(rows, "dataset string, shape string, k long, t long, interval long").withColumn("part", F.lit(7))
    got = {(r.a, r.b): r["class"] for r in funding.pair_candidates(table).collect()}
    assert len(got) == 15 and all(got[p] == "schema" for p in got if "d" in p)
    assert {p: c for p, c in got.items() if "d" not in p} == {
        ("a", "b"): "eligible", ("a", "c"): "duplicate", ("a", "e"): "eligible", ("a", "f"): "interval", ("b", "c"): "eligible", ("b", "e"): "interval", ("b", "f"): "duplicate",
        ("c", "e"): "eligible", ("c", "f"): "interval", ("e", "f"): "interval"}

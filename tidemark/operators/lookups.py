"""As-of lookups, lifecycle conflicts, matching and comparing joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.functions.times import DAY, utc_date


def join_dimension(facts: DataFrame, dimension: DataFrame, key: str = "symbol") -> DataFrame:
    """Inner join on key; a key that the dimension repeats is an error, raised when the query runs."""
    guard = F.assert_true(F.count("*") == 1, F.concat(F.lit("duplicate key "), F.col(key).cast("string")))
    single = dimension.groupBy(key).agg(*[F.first(c).alias(c) for c in dimension.columns if c != key], guard.alias("__ok"))
    return facts.join(single.filter(F.col("__ok").isNull()).drop("__ok"), key)


def as_of_snapshot(probes: DataFrame, snapshots: DataFrame, columns: list[str]) -> DataFrame:
    """probes (k, t, ...) with the latest snapshot (k, t, columns) at or before t, and `found`.

    One shuffle by k of both sides together and a running last value, so cost doesn't grow with the number
    of snapshots before a probe; nothing later than t is seen.
    """
    mine = [c for c in probes.columns if c not in ("k", "t")]
    left = probes.select("k", "t", F.struct(*mine).alias("__probe"), F.lit(None).cast(snapshots.select(F.struct("t", *columns).alias("s")).schema["s"].dataType).alias("__snap"), F.lit(1).alias("__side"))
    right = snapshots.select("k", "t", F.lit(None).cast(left.schema["__probe"].dataType).alias("__probe"), F.struct("t", *columns).alias("__snap"), F.lit(0).alias("__side"))
    line = Window.partitionBy("k").orderBy("t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    seen = left.unionByName(right).withColumn("__last", F.last("__snap", ignorenulls=True).over(line)).filter("__side = 1")
    return seen.select("k", "t", *[F.col(f"__probe.{c}").alias(c) for c in mine], F.col("__last.t").alias("snapshot_t"),
                       *[F.col(f"__last.{c}").alias(c) for c in columns], F.col("__last").isNotNull().alias("found"))


def select_as_of(probes: DataFrame, inventories: DataFrame, records: DataFrame, require_complete: bool = False) -> DataFrame:
    """probes (k, t, ...) with `snapshot_t`, the latest of all inventories (t, inventory_status) at or before t, and `problem`.

    problem: before_first_snapshot, partial_inventory (only with require_complete), absent_instrument where that
    inventory's records (snapshot_t, k) lack k, else null. Inventories are one line, not one for each k, so each is
    listed for the days on which it holds and met on the day: no task sorts all probes.
    """
    last = probes.agg(F.max("t").alias("end"))
    line = Window.orderBy("t")  # a row for each inventory
    held = inventories.select(F.col("t").alias("snapshot_t"), "inventory_status", F.lead("t").over(line).alias("until")).crossJoin(last)  # one row
    until = F.coalesce("until", F.greatest("end", "snapshot_t") + 1)
    days = held.select("snapshot_t", "inventory_status", until.alias("__until"), F.explode(F.sequence(F.floor(F.col("snapshot_t") / DAY), F.floor((until - 1) / DAY))).alias("__held"))
    # a day with several inventories has each of them, and one row alone is at or before t
    seen = probes.withColumn("__day", F.floor(F.col("t") / DAY)).join(days, (F.col("__day") == F.col("__held")) & (F.col("t") >= F.col("snapshot_t"))
                                                                                       & (F.col("t") < F.col("__until")), "left").drop("__day", "__held", "__until")
    met = seen.join(records.select("snapshot_t", "k", F.lit(True).alias("__listed")).distinct(), ["snapshot_t", "k"], "left")
    partial = F.lit(require_complete) & (F.col("inventory_status") != "complete")
    problem = F.when(F.col("snapshot_t").isNull(), "before_first_snapshot").when(partial, "partial_inventory").when(F.col("__listed").isNull(), "absent_instrument")
    return met.select(*probes.columns, "snapshot_t", problem.alias("problem"))


def timeline_summary(inventories: DataFrame, records: DataFrame) -> DataFrame:
    """One row: inventories and partial ones, first and last time, and the last one's status, records and counts by status."""
    sums = inventories.agg(F.count("*").alias("snapshots"), F.count(F.when(F.col("inventory_status") == "partial", 1)).alias("partial"), F.min("t").alias("first_t"),
                           F.max("t").alias("last_t"), F.max_by("inventory_status", "t").alias("last_status"))
    latest = records.join(F.broadcast(sums.select("last_t")), F.col("snapshot_t") == F.col("last_t")).groupBy("status").agg(F.count("*").alias("n"))  # one row
    counts = F.array_sort(F.collect_list(F.concat_ws(":", "status", F.col("n").cast("string"))))  # a row for each status
    return sums.crossJoin(latest.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.array_join(counts, ",").alias("status_counts")))  # one row each


def lifecycle_conflicts(observed: DataFrame) -> DataFrame:
    """(k, n, blockers) of observations (k, closed, symbol, launch, delivery): sorted codes of what contradicts."""
    reused = observed.groupBy("symbol").agg((F.countDistinct("k") > 1).alias("reused"))
    per = observed.join(reused, "symbol").groupBy("k").agg(
        F.count("*").alias("n"), F.countDistinct("launch").alias("launches"), F.countDistinct("delivery").alias("deliveries"),
        F.min("launch").alias("launch"), F.min("delivery").alias("delivery"), F.bool_or("closed").alias("closed"), F.bool_or("reused").alias("reused"))
    codes = {
        "closed_without_delivery_time": F.col("closed") & (F.col("deliveries") != 1),
        "conflicting_delivery_time": F.col("deliveries") > 1,
        "conflicting_launch_time": F.col("launches") != 1,
        "non_positive_lifecycle_interval": (F.col("launches") == 1) & (F.col("deliveries") == 1) & (F.col("delivery") <= F.col("launch")),
        "symbol_reused_across_instrument_ids": F.col("reused"),
    }
    return per.select("k", "n", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in codes.items()])).alias("blockers"))


def match_announcements(instruments: DataFrame, texts: DataFrame) -> DataFrame:
    """(k, matches, class) of instruments (k, names) in upper-case texts (doc_id, text): a name matches as a whole
    run of letters and digits. Names and texts meet on tokens, an equi join; distinct tokens only."""
    names = instruments.select("k", F.explode("names").alias("token")).distinct()
    tokens = texts.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Z0-9]+"), F.lit(0)))).alias("token"))
    wanted = names.select("token").distinct()
    matched = names.join(tokens.join(wanted, "token", "left_semi"), "token").select("k", "doc_id").distinct()
    counted = instruments.select("k").join(matched.groupBy("k").agg(F.count("*").alias("matches")), "k", "left").withColumn("matches", F.coalesce("matches", F.lit(0)))
    kind = F.when(F.col("matches") == 0, "unmatched").when(F.col("matches") == 1, "unique").otherwise("ambiguous")
    return counted.select("k", "matches", kind.alias("class"))


def match_listings(instruments: DataFrame, texts: DataFrame, archive_oldest: int) -> DataFrame:
    """(k, matches, class) of instruments (k, symbol, base, event_t) in upper-case texts (doc_id, text).

    A text counts if it has a derivative word and either the symbol or the base and USDT, next to each other or parted
    by white space, `/`, `_` or `-`, on boundaries of letters and digits. Symbols and bases are letters and digits.
    Instruments without event_t have no row; those before archive_oldest are outside_archive and not looked for.
    All that a text names are tokens, so both sides meet in an equi join on distinct tokens.
    """
    scope = F.regexp_like("text", F.lit(r"PERPETUAL|DERIVATIVE|(?<![A-Z])CONTRACTS?(?![A-Z])"))
    words = F.regexp_extract_all("text", F.lit("[A-Z0-9]+"), F.lit(0))
    apart = F.regexp_extract_all("text", F.lit(r"(?<![A-Z0-9])([A-Z0-9]+)(?=[\s/_-]+USDT(?![A-Z0-9]))"), F.lit(1))
    joined = F.transform(F.filter(words, lambda w: F.length(w) > 4), lambda w: F.when(w.endswith("USDT"), F.regexp_replace(w, "USDT$", "")))
    told = texts.filter(scope).select("doc_id", words.alias("words"), F.array_compact(F.array_union(apart, joined)).alias("bases"))
    tokens = told.select("doc_id", F.explode(F.array_distinct(F.concat(
        F.transform("words", lambda w: F.concat(F.lit("symbol "), w)), F.transform("bases", lambda b: F.concat(F.lit("base "), b))))).alias("token"))
    dated = instruments.filter(F.col("event_t").isNotNull()).withColumn("outside", F.col("event_t") < archive_oldest)
    wanted = dated.filter(~F.col("outside")).select("k", F.explode(F.array(F.concat(F.lit("symbol "), "symbol"), F.concat(F.lit("base "), "base"))).alias("token"))
    matched = wanted.join(tokens, "token").select("k", "doc_id").distinct().groupBy("k").agg(F.count("*").alias("matches"))
    counted = dated.join(matched, "k", "left").withColumn("matches", F.coalesce("matches", F.lit(0)))
    kind = F.when(F.col("outside"), "outside_archive").when(F.col("matches") == 0, "unmatched").when(F.col("matches") == 1, "unique").otherwise("ambiguous")
    return counted.select("k", "matches", kind.alias("class"))


def date_relation(deltas: DataFrame) -> DataFrame:
    """Counts of negative, zero and positive `delta` and the largest absolute one."""
    return deltas.agg(F.count(F.when(F.col("delta") < 0, 1)).alias("before"), F.count(F.when(F.col("delta") == 0, 1)).alias("same"),
                      F.count(F.when(F.col("delta") > 0, 1)).alias("after"), F.max(F.abs("delta")).alias("max_abs_days"))


def listing_vs_first(rows: DataFrame, events: DataFrame) -> DataFrame:
    """First row of each (k, kind) against the event of k: same day, same month, before it."""
    firsts = rows.groupBy("k", "kind").agg(F.min("t").alias("first_t"))
    met = firsts.join(events, "k")
    months = [F.trunc(utc_date(F.col(c)), "month") for c in ("first_t", "event_t")]
    return met.select("k", "kind", "first_t", "event_t", (F.floor(F.col("first_t") / DAY) == F.floor(F.col("event_t") / DAY)).alias("same_day"),
                      (months[0] == months[1]).alias("same_month"), (F.col("first_t") < F.col("event_t")).alias("before_event"))


def universe_compare(current: DataFrame, archive: DataFrame) -> DataFrame:
    """Symbols of a current listing (symbol, status) and an archive (symbol), and which of them has each.

    A null status is a status; rows of the listing stay as they are, symbols of the archive count once.
    """
    met = current.withColumn("here", F.lit(1)).join(archive.select("symbol").distinct().withColumn("there", F.lit(1)), "symbol", "full_outer")
    side = F.when(F.col("here").isNull(), "archive_only").when(F.col("there").isNull(), "current_only").otherwise("both")
    return met.select("symbol", "status", side.alias("side"))


def reconcile_stages(**stages: DataFrame) -> DataFrame:
    """(kind, a column for each stage, agree) of the totals (kind, n) of named stages; several rows of a kind add up.

    agree: every stage has the kind, with the same total. A kind that one stage alone has shows as nulls and disagrees.
    """
    tagged = reduce(DataFrame.unionByName, [df.select("kind", "n", F.lit(name).alias("stage")) for name, df in stages.items()])
    totals = tagged.groupBy("kind").agg(*[F.sum(F.when(F.col("stage") == name, F.col("n"))).alias(name) for name in stages])
    first = next(iter(stages))
    same = reduce(Column.__and__, [F.col(name).isNotNull() & (F.col(name) == F.col(first)) for name in stages])
    return totals.withColumn("agree", F.coalesce(same, F.lit(False)))


def completeness_profile(rows: DataFrame, columns: list[str], url: str | None = None) -> DataFrame:
    """Rows, blank values of each column, and rows that repeat another; with a column `url` also those whose url repeats another's.

    Rows repeat one another if all columns are equal, null being equal to null alone.
    """
    blanks = [F.count(F.when(F.col(c).isNull() | (F.trim(c) == ""), 1)).alias(f"blank_{c}") for c in columns]
    digest = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)  # keeps columns apart

    def repeats(df: DataFrame, key: Column, name: str) -> DataFrame:
        return df.groupBy(key.alias("d")).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias(name))

    profile = rows.agg(F.count("*").alias("n"), *blanks).crossJoin(repeats(rows, digest, "repeated_items"))  # one row each
    return profile.crossJoin(repeats(rows.filter(F.trim(url) != ""), F.col(url), "repeated_urls")) if url else profile  # one row each


def adjacent_inversions(rows: DataFrame, line: WindowSpec) -> DataFrame:
    """How often a row is newer than the one before it in the given order."""
    marked = rows.withColumn("prev", F.lag("t").over(line))
    return marked.groupBy("k").agg(F.count(F.when(F.col("t") > F.col("prev"), 1)).alias("inversions"))


def archive_bounds(items: DataFrame) -> DataFrame:
    """(kind, oldest, newest, n, inversions) of items (kind, page, place, t): how deep an archive reaches and whether its pages are in order.

    Items are listed newest first, so an inversion is an item newer than the one before it by (page, place). A page is lined
    up by itself; pages of a kind then meet by their first and last items alone, so a kind with most of the items isn't
    one task's. Items without a time count in n and stand for no neighbour.
    """
    line = Window.partitionBy("kind", "page").orderBy("place")
    at = F.when(F.col("t").isNotNull(), F.struct("place", "t"))
    marked = items.withColumn("__prev", F.last("t", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1)))
    pages = marked.groupBy("kind", "page").agg(
        F.min("t").alias("oldest"), F.max("t").alias("newest"), F.count("*").alias("n"), F.count(F.when(F.col("t") > F.col("__prev"), 1)).alias("inside"),
        F.min(at)["t"].alias("first"), F.max(at)["t"].alias("last"))
    before = Window.partitionBy("kind").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)  # a row for each page
    between = pages.withColumn("across", (F.col("first") > F.last("last", ignorenulls=True).over(before)).cast("long"))
    return between.groupBy("kind").agg(F.min("oldest").alias("oldest"), F.max("newest").alias("newest"), F.sum("n").alias("n"),
                                       (F.sum("inside") + F.coalesce(F.sum("across"), F.lit(0))).alias("inversions"))


def archive_depth(bounds: DataFrame, launches: DataFrame, listing: str, lifecycle: tuple[str, ...]) -> DataFrame:
    """One row that says whether an archive reaches back to the launches (k, launch) of instruments.

    bounds: archive_bounds(). before: instruments launched before the oldest item of the kind `listing`; unknown: those
    without a launch, which are never within. unordered: kinds of `lifecycle` that are absent or have inversions. status: blocked
    unless every launch is within the archive and no lifecycle kind is unordered; an archive without `listing` holds none.
    """
    start = F.max(F.when(F.col("kind") == listing, F.col("oldest")))
    ordered = F.count(F.when(F.col("kind").isin(*lifecycle) & (F.col("inversions") == 0), 1))
    edge = bounds.agg(start.alias("listing_start"), F.min("oldest").alias("archive_start"), (F.lit(len(set(lifecycle))) - ordered).alias("unordered"))
    early = F.coalesce(F.col("launch") < F.col("listing_start"), F.col("launch").isNotNull())
    met = launches.crossJoin(F.broadcast(edge)).agg(F.count("*").alias("instruments"), F.min("launch").alias("first_launch"), F.max("launch").alias("last_launch"),  # edge is one row
                                                    F.count(F.when(early, 1)).alias("before"), F.count(F.when(F.col("launch").isNull(), 1)).alias("unknown"))
    fits = (F.col("before") + F.col("unknown") + F.col("unordered") == 0) & F.col("listing_start").isNotNull()
    return edge.crossJoin(met).select("*", F.when(fits, "compatible").otherwise("blocked").alias("status"))  # one row each

"""Rolling features of bars by instrument, as segmented scans: blocks of time that tasks finish alone, with a halo of rows."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.exact import row_digest
from tidemark.functions.times import decision_time_ns
from tidemark.operators import segments

FEATURES = ("rolling_mid", "rolling_high", "rolling_low", "rolling_atr", "rolling_volume_mean", "range_width", "range_position",
            "lower_touch", "upper_touch", "mid_crossing")


def previous_close() -> Column:
    return F.lag("close").over(Window.partitionBy("k").orderBy("t"))


def true_range(previous: str = "prev_close") -> Column:
    """max(high - low, |high - previous close|, |low - previous close|); the first row's is high - low."""
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col(previous)), F.abs(F.col("low") - F.col(previous)))


def _kind(bars: DataFrame, *names: str) -> str:
    """long if all the columns are integers, else double."""
    return "long" if all(bars.schema[n].dataType.typeName() in ("byte", "short", "integer", "long") for n in names) else "double"


def features(bars: DataFrame, rows: int) -> DataFrame:
    """bars (k, t, open, high, low, close, volume) with FEATURES over the last `rows` rows (rows, not minutes).

    Means are null until there are `rows` rows; they are differences of running sums, exact on integer prices.
    prior_* are the rolling values one row back; touches and crossings are false where a prior value is missing.
    Null prices are left out of sums and extremes, and whatever is compared with them alone is null or false. Integers
    give integers, other numbers doubles (decimals too: units are the exact way). Each block needs the rows + 1 before it;
    see segments.scan_segments() for what is shuffled and held.
    """
    range_kind, close_kind = _kind(bars, "high", "low"), _kind(bars, "close")
    true_kind = _kind(bars, "high", "low", "close")
    schema = (f"prev_close {close_kind}, true_range {true_kind}, rolling_mid double, rolling_atr double, rolling_volume_mean double, "
              f"rolling_high {range_kind}, rolling_low {range_kind}, prior_mid double, prior_high {range_kind}, prior_low {range_kind}")

    def finish(table, place, left):
        import numpy as np

        high, low, close, volume = (segments.numbers(table, c) for c in ("high", "low", "close", "volume"))
        full, second, later = place >= rows - 1, place >= rows, place >= 1
        previous = segments.shifted(close, 1)
        width = high - low
        wide = np.fmax(width, np.fmax(np.abs(high - previous), np.abs(low - previous)))
        reach = np.where(later, wide, width)
        mid, atr, mean = (segments.rolling_sum(x, rows, place) / rows for x in (close, reach, volume))
        top, bottom = segments.rolling_extreme(high, rows, np.fmax), segments.rolling_extreme(low, rows, np.fmin)
        prior_mid, prior_top, prior_bottom = (segments.shifted(x, 1) for x in (mid, top, bottom))
        known = np.ones(len(table), bool)
        made = [(previous, later, close_kind), (reach, known, true_kind), (mid, full, "double"), (atr, full, "double"), (mean, full, "double"),
                (top, full, range_kind), (bottom, full, range_kind), (prior_mid, second, "double"), (prior_top, second, range_kind), (prior_bottom, second, range_kind)]
        return [segments.column(*x) for x in made]

    df = segments.scan_segments(bars, finish, schema, back=rows + 1)
    width = F.col("rolling_high") - F.col("rolling_low")
    crossing = ((F.col("prev_close") <= F.col("prior_mid")) & (F.col("close") > F.col("prior_mid"))) | (
        (F.col("prev_close") >= F.col("prior_mid")) & (F.col("close") < F.col("prior_mid")))
    return df.withColumns({
        "range_width": width, "range_position": F.when(width > 0, (F.col("close") - F.col("rolling_low")) / width),
        "lower_touch": F.coalesce(F.col("low") <= F.col("prior_low"), F.lit(False)),
        "upper_touch": F.coalesce(F.col("high") >= F.col("prior_high"), F.lit(False)),
        "mid_crossing": F.coalesce(crossing, F.lit(False))})


def core_with_halo(bars: DataFrame, rows: int, core_start: int, core_end: int, halo_ms: int) -> DataFrame:
    """Features of rows in [core_start, core_end), computed from those and a halo before; for incremental rebuilds.

    Equal to the features of the whole history wherever the halo holds at least `rows` + 1 rows.
    """
    near = bars.filter((F.col("t") >= core_start - halo_ms) & (F.col("t") < core_end))
    return features(near, rows).filter(F.col("t") >= core_start)


def forward_excursion(bars: DataFrame, rows: int) -> DataFrame:
    """bars with the largest adverse and favourable move of the close within the next `rows` rows; null without them."""
    kind = _kind(bars, "high", "low", "close")

    def finish(table, place, left):
        import numpy as np

        high, low, close = (segments.numbers(table, c) for c in ("high", "low", "close"))
        top = segments.shifted(segments.rolling_extreme(high, rows, np.fmax), -rows)
        bottom = segments.shifted(segments.rolling_extreme(low, rows, np.fmin), -rows)
        return [segments.column(close - bottom, left >= rows, kind), segments.column(top - close, left >= rows, kind)]

    return segments.scan_segments(bars, finish, f"adverse {kind}, favourable {kind}", back=0, ahead=rows)


def outcome_metrics(moves: DataFrame) -> DataFrame:
    """Of each instrument's outcomes (k, t, net): sums, expectancy, profit factor, the 5% quantile, the mean of the worst 1%,
    the longest run of losses and the best month's share of the gains."""
    line = Window.partitionBy("k").orderBy("t")
    run = F.row_number().over(line) - F.row_number().over(Window.partitionBy("k", F.col("net") < 0).orderBy("t"))
    place = F.row_number().over(Window.partitionBy("k").orderBy("net", "t"))
    tail = place <= F.ceil(F.count("*").over(Window.partitionBy("k")) * 0.01)
    marked = moves.withColumns({"run": run, "tail": tail, "gain": F.when(F.col("net") > 0, F.col("net")).otherwise(0), "loss": F.when(F.col("net") < 0, -F.col("net")).otherwise(0)})
    runs = marked.filter("net < 0").groupBy("k", "run").agg(F.count("*").alias("c")).groupBy("k").agg(F.max("c").alias("longest"))
    month = F.date_trunc("month", F.timestamp_millis("t"))
    months = marked.groupBy("k", month.alias("month")).agg(F.sum("gain").alias("g")).groupBy("k").agg(F.max("g").alias("best_month"))
    sums = marked.groupBy("k").agg(
        F.sum("net").alias("net_sum"), F.count("*").alias("n"), F.sum("gain").alias("gains"), F.sum("loss").alias("losses"),
        F.expr("percentile_disc(0.05) within group (order by net)").cast("long").alias("worst"), F.round(F.sum("net") / F.count("*"), 6).alias("expectancy"),
        F.round(F.avg(F.when(F.col("tail"), F.col("net"))), 6).alias("tail_mean"))
    met = sums.join(runs, "k", "left").join(months, "k")
    return met.select(*sums.columns, F.when(F.col("losses") > 0, F.round(F.col("gains") / F.col("losses"), 6)).alias("profit_factor"),
                      F.coalesce("longest", F.lit(0)).alias("longest_losses"), F.when(F.col("gains") > 0, F.round(F.col("best_month") / F.col("gains"), 6)).alias("month_share"))


@dataclass(frozen=True)
class RangeRule:
    """Thresholds of range_candidates(); whole numbers, so that a rule has one text and one digest."""

    name: str
    rows: int
    least_height_bps: int  # of the middle
    most_height_bps: int
    least_atr_milli: int  # height in thousandths of the mean true range
    zone_milli: tuple[int, int]  # where in the range the close may be
    touches: int  # of each edge
    crossings: int  # of the middle
    most_drift_milli: int  # the middle's move over `rows` rows, in thousandths of the height
    least_volume: int
    most_span_ms: int  # from the first row of the range to the last
    least_age_ms: int

    def digest(self) -> str:
        return sha256(json.dumps(asdict(self), sort_keys=True, separators=(",", ":")).encode()).hexdigest()


FILTERS = ("warm", "complete", "known", "height", "height_in_atr", "mid_zone", "edges_touched", "middle_crossed", "horizontal", "liquid")


def range_candidates(bars: DataFrame, rule: RangeRule, metadata: DataFrame, identity: dict[str, str]) -> DataFrame:
    """Every bar as a candidate: (k, t, decision_ns, a boolean for each of FILTERS, accepted, rejections, candidate_id).

    Everything is from bars up to t. warm: the range and its middle `rows` rows back exist; complete: its rows span no more than
    the rule allows, so few source minutes are missing; known: metadata (k, launch) has the instrument, old enough at t.
    A filter that can't be told is false: nothing is eligible by silence, and a bar that fails stays, with the names of
    what it failed in the order of FILTERS. candidate_id is the SHA-256 of the identity (data set, contracts and so on) with
    rule, its digest, k and decision time, whatever the order or layout of rows. Instruments repeated in metadata count by
    their latest launch. Two segmented scans, the second with a halo of `rows` rows.
    """
    rows = rule.rows

    def finish(table, place, left):
        import numpy as np

        full, second = place >= rows - 1, place >= rows
        counts = [segments.rolling_sum(segments.numbers(table, c).astype(np.int64), rows, place) for c in ("lower_touch", "upper_touch", "mid_crossing")]
        mid, t = segments.numbers(table, "rolling_mid"), segments.numbers(table, "t")
        made = [(c, full, "long") for c in counts] + [(mid - segments.shifted(mid, rows), second, "double"), (t - segments.shifted(t, rows - 1), full, "long")]
        return [segments.column(*x) for x in made]

    base = features(bars, rows).select("k", "t", "close", "rolling_mid", "rolling_high", "rolling_low", "rolling_atr", "rolling_volume_mean", "range_width", "lower_touch", "upper_touch", "mid_crossing")
    seen = segments.scan_segments(base, finish, "lower_touches long, upper_touches long, crossings long, drift double, span long", back=rows)
    launches = metadata.groupBy("k").agg(F.max("launch").alias("launch"))
    met = seen.join(launches, "k", "left")
    width, place = F.col("range_width"), (F.col("close") - F.col("rolling_low")) * 1000
    tests = {
        "warm": F.col("drift").isNotNull(),
        "complete": F.col("span") <= rule.most_span_ms,
        "known": F.col("t") - F.col("launch") >= rule.least_age_ms,
        "height": (width * 10_000 >= F.col("rolling_mid") * rule.least_height_bps) & (width * 10_000 <= F.col("rolling_mid") * rule.most_height_bps),
        "height_in_atr": (width > 0) & (width * 1000 >= F.col("rolling_atr") * rule.least_atr_milli),
        "mid_zone": (width > 0) & place.between(width * rule.zone_milli[0], width * rule.zone_milli[1]),
        "edges_touched": F.least("lower_touches", "upper_touches") >= rule.touches,
        "middle_crossed": F.col("crossings") >= rule.crossings,
        "horizontal": F.abs("drift") * 1000 <= width * rule.most_drift_milli,
        "liquid": F.col("rolling_volume_mean") >= rule.least_volume}
    judged = met.withColumns({name: F.coalesce(tests[name], F.lit(False)) for name in FILTERS} | {"decision_ns": decision_time_ns(F.col("t"))})
    accepted = reduce(Column.__and__, [F.col(name) for name in FILTERS])
    rejections = F.concat_ws(",", *[F.when(~F.col(name), F.lit(name)) for name in FILTERS])
    texts = identity | {"rule": rule.name, "rule_sha256": rule.digest()}
    named = judged.withColumns({name: F.lit(text) for name, text in texts.items()})
    return named.select("k", "t", "decision_ns", *FILTERS, accepted.alias("accepted"), rejections.alias("rejections"), row_digest("k", "decision_ns", *texts).alias("candidate_id"))


@dataclass(frozen=True)
class Fold:
    """Half-open stretches of decision time: training from start, validation, test, and the end of what may be known."""

    name: str
    start: int
    validation: int
    test: int
    end: int


def split_roles(rows: DataFrame, folds: list[Fold], embargo_ms: int, held_out: DataFrame) -> DataFrame:
    """(k, t, fold, role) of each row (k, t, known_at) in each fold; known_at is when its outcome is known, null if it never was.

    role, the first that fits: outside (not between the fold's start and end), held_out (k is in held_out (k), in every fold),
    unresolved (no outcome, or one known before the decision), embargo (too soon after a boundary), purged (the outcome is known at or
    after the end of the row's own stretch), else train, validation or test. Every row is kept with its role, so none is lost
    silently. Folds are parameters; rows grow by their number and aren't shuffled but for the held-out instruments.
    """
    if any(not f.start < f.validation < f.test < f.end for f in folds) or len({f.name for f in folds}) < len(folds):
        raise ValueError("the stretches of a fold must ascend and names of folds must differ")
    t, known = F.col("t"), F.col("known_at")

    def role(fold: Fold) -> Column:
        after = F.when(t >= fold.test, fold.test).when(t >= fold.validation, fold.validation)
        until = F.when(t >= fold.test, fold.end).when(t >= fold.validation, fold.test).otherwise(fold.validation)
        own = F.when(t >= fold.test, "test").when(t >= fold.validation, "validation").otherwise("train")
        return (F.when((t < fold.start) | (t >= fold.end), "outside").when(F.col("__held"), "held_out").when(known.isNull() | (known < t), "unresolved")
                .when(t < after + embargo_ms, "embargo").when(known >= until, "purged").otherwise(own))

    held = held_out.select("k").distinct().withColumn("__held", F.lit(True))
    each = F.explode(F.array(*[F.struct(F.lit(f.name).alias("fold"), role(f).alias("role")) for f in folds]))
    return rows.join(held, "k", "left").select("k", "t", each.alias("x")).select("k", "t", "x.*")

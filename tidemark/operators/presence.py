"""Which minutes an instrument has, as bitmaps: words of 60 steps, made where rows are read and joined in one small shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.times import MINUTE

#: Steps of a word: an hour of minutes.
BITS = 60
#: A word that has all its steps.
FULL = (1 << BITS) - 1
#: Words of a bin: requests meet words by (k, bin), 32 days of minutes.
BIN_WORDS = 768


def presence(step: int = MINUTE, **keys: DataFrame) -> DataFrame:
    """(k, word, and for each of the named tables of keys (k, t): name, name_rows, name_off) of all tables together.

    word is the first instant of BITS steps, name the bitmap of its steps that the table has, name_rows how many rows that
    are, name_off the rows between two steps, which are in no bitmap. All tables are tagged, united and aggregated once by
    (k, word): partial bitmaps are made before the shuffle, so at most a row for each word and task is sent. Rows without k
    or t are left out.
    """
    span = BITS * step
    tagged = [df.select("k", "t", F.lit(i).alias("kind")) for i, df in enumerate(keys.values())]
    rows = reduce(DataFrame.unionByName, tagged).filter("k is not null and t is not null")
    place = F.pmod("t", F.lit(span))
    off = F.pmod("t", F.lit(step)) != 0
    marked = rows.select("k", (F.col("t") - place).alias("word"), "kind", off.alias("off"), _bit(place, step).alias("bit"))
    sums = []
    for i, name in enumerate(keys):
        mine = F.col("kind") == i
        sums += [F.coalesce(F.bit_or(F.when(mine & ~F.col("off"), F.col("bit"))), F.lit(0)).alias(name),
                 F.count(F.when(mine & ~F.col("off"), 1)).alias(f"{name}_rows"), F.count(F.when(mine & F.col("off"), 1)).alias(f"{name}_off")]
    return marked.groupBy("k", "word").agg(*sums)


def _bit(place: Column, step: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place / step).cast("int"))


def within_requests(requests: DataFrame, words: DataFrame, step: int = MINUTE) -> DataFrame:
    """(k, start, stop, mask, word columns) of every word that a distinct request (k, start, stop; both inclusive) reaches into.

    mask has the word's steps inside the request. Requests go to their bins of BIN_WORDS words, so a word meets only the
    requests near it, however many its instrument has.
    """
    span = BITS * step
    bin_span = BIN_WORDS * span
    wanted = requests.filter("start <= stop").select("k", "start", "stop").distinct()
    bins = F.sequence(F.col("start") - F.pmod("start", F.lit(bin_span)), F.col("stop"), F.lit(bin_span))
    binned = words.withColumn("bin", F.col("word") - F.pmod("word", F.lit(bin_span)))
    met = binned.join(wanted.withColumn("bin", F.explode(bins)), ["k", "bin"]).filter((F.col("word") + span > F.col("start")) & (F.col("word") <= F.col("stop")))
    low = F.greatest(F.ceil((F.col("start") - F.col("word")) / step), F.lit(0))
    high = F.least(F.floor((F.col("stop") - F.col("word")) / step), F.lit(BITS - 1))
    one = F.lit(1).cast("long")
    upto = lambda n: F.call_function("shiftleft", one, n.cast("int")) - 1
    mask = upto(high + 1).bitwiseAND(F.bitwise_not(upto(low)))
    return met.withColumn("mask", mask).drop("bin")


def _places(bits: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.getbit(bits, i) == 1)


def runs(bits: Column) -> Column:
    """Array of (first, last) of the runs of ones of a word."""
    first = bits.bitwiseAND(F.bitwise_not(F.shiftleft(bits, 1)))
    last = bits.bitwiseAND(F.bitwise_not(F.shiftright(bits, 1)))
    pairs = F.zip_with(_places(first), _places(last), lambda a, b: F.struct(a.alias("first"), b.alias("last")))
    return F.when(bits == FULL, F.array(F.struct(F.lit(0).alias("first"), F.lit(BITS - 1).alias("last")))).otherwise(pairs)

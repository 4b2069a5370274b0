"""Quality rules whose thresholds follow each language and source.

Every document is measured once. Measures are turned into whole-number rates,
and each (language, source) group keeps histograms of them and of the sizes they
are divided by: quantile sketches of bounded size whose merge is an addition, so
the result is the same in any order and on any cluster.

A group's fence lies `reach` spreads beyond its quartile, or beyond its far
quantile, if that one is itself within reach of the quartile: a long but
connected tail moves the fence, a separate heap of odd documents does not. The
spread is that between the quartiles, and at least the scatter of a count (its
square root, or one) in the group's document of median size and rate, so groups
of equal documents do not reject every slight deviation. As rates of short
documents scatter more, the distance from the median to the fence grows with the
square root of median size / own size for those below the median. A group of
`full` documents has its own fences; those of a smaller one are the mean of its own
and its language's, weighed by how full it is, and so are a language's with all.

Null text counts as empty, and an empty or blank text fails the base rules; a very
long one is measured whole. Null languages and sources are groups of their own.
Ties at a quantile belong to one bin. Repeated rows are judged one by one, alike,
and all count. An empty table gives no rows. Other columns, whatever their names,
are ignored by `verdicts` and kept by `filter_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import LongType, StructField, StructType

from reviewloom.llm import common

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SCHEMA = StructType([StructField(m, LongType()) for m in MEASURES])
BLANKS = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rate:
    """A whole-number rate: value * scale // per, at most `top`; fenced above and maybe below."""

    value: str
    per: str
    scale: int
    top: int
    below: bool = False

    def column(self) -> Column:
        """Per is 0: rate 0."""
        rate = F.expr(f"{self.value} * {self.scale} div greatest({self.per}, 1)")
        return F.least(rate, F.lit(self.top)).cast("bigint")


@dataclass(frozen=True)
class Rules:
    """tail: the far quantile, in thousandths; the one below is 1000 - tail."""

    min_words: int = 20
    max_repeat_percent: int = 30
    reach: int = 3
    tail: int = 950
    full: int = 200


RATES = {
    "symbols": Rate("n_symbols", "n_words", 1000, 5000),
    "word_length": Rate("word_chars", "n_words", 10, 1000, below=True),
    "dup_lines": Rate("n_dup_lines", "n_lines", 1000, 1000),
}
SIZES = sorted({r.per for r in RATES.values()})
#: What a group knows of a rate: its fences, the median, and the size of the median document.
SIDES = ("low", "high", "mid", "size")


def size_bin(name: str) -> Column:
    """A size with its seven leading bits only, so that a histogram of sizes stays small."""
    shift = f"greatest(length(bin({name})) - 7, 0)"
    return F.expr(f"shiftleft(shiftright({name}, {shift}), {shift})")


def measure_text(text: str | None, window: int = 8) -> tuple[int, ...]:
    """The MEASURES of one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split on exactly \x20 and \x09-\x0D
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return n, chars, symbols, len(lines) - len(set(lines)), repeated_words(words, window), len(lines)


def repeated_words(words: list[bytes], window: int) -> int:
    """Words that lie in a window found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.uint64, len(words))
    if len(seen) == len(words):
        return 0
    key = np.zeros(n, np.uint64)
    for k in range(window):
        key = (key ^ ids[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    step = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.isin(key, twice))
    step[at] += 1
    step[at + window] -= 1
    return int((np.cumsum(step[:-1]) > 0).sum())


@F.arrow_udf(SCHEMA)
def measures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    common.give_back()
    kind = pa.struct([(m, pa.int64()) for m in MEASURES])
    for batch in batches:
        rows = (measure_text(t) for part in common.array_slices(batch, 500) for t in part.to_pylist())
        yield pa.array([dict(zip(MEASURES, r)) for r in rows], kind)


def base_failed(rules: Rules) -> Column:
    n, repeat = F.col("n_words"), F.col("n_repeat_words")
    return (n < rules.min_words) | (100 * repeat > rules.max_repeat_percent * n)


def histograms(measured: DataFrame, rules: Rules) -> DataFrame:
    """(lang, source, rate, bin, n) over documents that pass the base rules, of rates and of sizes."""
    binned = {r: x.column() for r, x in RATES.items()} | {size: size_bin(size) for size in SIZES}
    rates = F.explode(F.array(*(F.struct(F.lit(r).alias("rate"), x.alias("bin")) for r, x in binned.items())))
    return (
        measured.filter(~base_failed(rules)).select("lang", "source", rates.alias("r"))
        .groupBy("lang", "source", "r.rate", "r.bin").agg(F.count("*").alias("n"))
    )


def own_fences(bins: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """Per group: n documents and <rate>_(SIDES), read off its histograms alone.

    A quantile is the smallest bin with at least that share of the group at or below it.
    """
    bins = bins.groupBy(*keys, "rate", "bin").agg(F.sum("n").alias("n"))
    running = W.partitionBy(*keys, "rate").orderBy("bin")
    whole = W.partitionBy(*keys, "rate")
    placed = bins.withColumns({"upto": F.sum("n").over(running), "all": F.sum("n").over(whole)})
    levels = {"q1": 250, "q2": 500, "q3": 750, "low": 1000 - rules.tail, "high": rules.tail}
    per_rate = placed.groupBy(*keys, "rate").agg(
        F.max("all").alias("n"),
        *(F.min(F.when(1000 * F.col("upto") >= at * F.col("all"), F.col("bin"))).alias(q) for q, at in levels.items()),
    )
    wide = per_rate.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *(F.max(F.when(F.col("rate") == r, F.col(q))).alias(f"{r}_{q}") for r in [*RATES, *SIZES] for q in levels),
    )
    out = []
    for r, x in RATES.items():
        q1, q2, q3, low, high = (F.col(f"{r}_{q}") for q in ("q1", "q2", "q3", "low", "high"))
        size = F.col(f"{x.per}_q2")
        count = F.greatest(F.sqrt(q2 * size / x.scale), F.lit(1.0))
        scatter = F.ceil(count * x.scale / F.greatest(size, F.lit(1)))
        reach = rules.reach * F.greatest(q3 - q1, scatter)
        out.append((F.when(high <= q3 + reach, high).otherwise(q3) + reach).alias(f"{r}_high"))
        least = F.when(low >= q1 - reach, low).otherwise(q1) - reach
        out.append(F.greatest(least if x.below else F.lit(0), F.lit(0)).cast("bigint").alias(f"{r}_low"))
        out += [F.col(f"{r}_q2").alias(f"{r}_mid"), F.col(f"{x.per}_q2").alias(f"{r}_size")]
    return wide.select(*keys, "n", *out)


def fences(measured: DataFrame, rules: Rules) -> DataFrame:
    """(lang, source, <rate>_(SIDES)) for each group, drawn to its language and to all."""
    h = histograms(measured, rules)
    names = [f"{r}_{side}" for r in RATES for side in SIDES]

    def drawn(own: DataFrame, keys: list[str], to: DataFrame) -> DataFrame:
        """The mean of own fences and those of the wider group, rounded down."""
        held = f"least(n, {rules.full})"
        mean = [F.expr(f"({held} * {c} + ({rules.full} - {held}) * _{c}) div {rules.full}").alias(c) for c in names]
        return own.join(to, F.col(keys[0]).eqNullSafe(F.col("_key"))).select(*keys, *mean)

    def wider(df: DataFrame, key: Column) -> DataFrame:
        return df.select(key.alias("_key"), *(F.col(c).alias(f"_{c}") for c in names))

    every = own_fences(h.withColumn("one", F.lit(1)), ["one"], rules)  # a single row
    langs = own_fences(h, ["lang"], rules).withColumn("one", F.lit(1))
    langs = drawn(langs, ["one", "lang"], F.broadcast(wider(every, F.col("one"))))
    return drawn(own_fences(h, ["lang", "source"], rules), ["lang", "source"], wider(langs, F.col("lang")))


def join_fences(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Documents with their group's fences; a group without one (all fail the base) gets nulls."""
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = measured["lang"].eqNullSafe(limits["_lang"]) & measured["source"].eqNullSafe(limits["_source"])
    return measured.join(common.small(limits), same, "left").drop("_lang", "_source")


def within(rules: Rules) -> Column:
    """Passes the base rules and lies within all fences."""

    def inside(r: str, x: Rate) -> Column:
        rate, size = x.column(), F.greatest(F.col(x.per), F.lit(1))
        low, high, mid, median = (F.col(f"{r}_{side}") for side in SIDES)

        def short(fence: Column) -> Column:
            """Within the fence of a document of this size, when it is shorter than the median one."""
            return (rate - mid) * (rate - mid) * size <= (fence - mid) * (fence - mid) * median

        above = (rate <= high) | short(high)
        return above & ((rate >= low) | short(low)) if x.below else above

    every = reduce(Column.__and__, (inside(r, x) for r, x in RATES.items()))
    return ~base_failed(rules) & F.coalesce(every, F.lit(True))


def measured_rows(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and MEASURES, written once to the shared folder."""
    rows = docs.select("doc_id", "lang", "source", measures("text").alias("m"))
    return common.kept_table(rows.select("doc_id", "lang", "source", "m.*"))


def verdicts(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, MEASURES, base_failed, kept."""
    measured = measured_rows(docs)
    limits = common.kept_table(fences(measured, rules))
    return join_fences(measured, limits).select(
        "doc_id", *MEASURES, base_failed(rules).alias("base_failed"), within(rules).alias("kept")
    )


def filter_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with all their columns and no others.

    Rows are written with their measures and read twice, so texts are measured once and
    never shuffled when the fences are few, and rows need no unique id.
    """
    rows = docs.select(common.whole_row(docs), "lang", "source", measures("text").alias("_m"))
    rows = common.kept_table(rows.select("_row", "lang", "source", "_m.*"))
    limits = common.kept_table(fences(rows.select("lang", "source", *MEASURES), rules))
    return join_fences(rows, limits).filter(within(rules)).select("_row.*")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return verdicts(common.table(spark, folder, "documents"))

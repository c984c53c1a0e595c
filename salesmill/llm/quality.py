"""Quality rules with thresholds that adapt to language and source.

A fixed base (too few words, too many repeated five-word windows) is joined by
thresholds learned from the corpus. Every measure of a document goes into a
log-linear histogram per language and source: an integer keeps its leading six
bits, so a bucket is at most 1/32 wide relative to its values. Such histograms
are quantile sketches that merge by adding counts, in any order, to the same
result: languages and the whole corpus are sums of the same buckets, and small
groups take the thresholds of the next larger one. A measure rejects a document
that lies farther beyond an upper quantile of its group than that lies beyond a
middle one, times a factor; both quantiles come from the sketch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmill.session import shared_dir

BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Measure:
    """An integer measure and how its limits follow from the sketch of a group.

    The highest kept value is the ``edge`` percentile plus ``reach`` tenths of
    its distance from the ``middle`` one, the lowest (if ``low``) the middle one
    less as much. A distance counts as ``step`` at least, which is what the
    measure changes by in a text of a hundred words when one word changes, and
    as one bucket of the sketch. Groups of fewer than ``least`` documents take
    the limits of the next larger group.
    """

    name: str
    value: str
    edge: int
    middle: int
    reach: int
    step: int
    least: int
    low: bool = False


#: Shares are per thousand, word lengths in tenths of a character. Most texts repeat nothing, so those limits follow the tail.
MEASURES = (
    Measure("word_length", "10 * word_chars div greatest(n_words, 1)", 75, 25, 60, 1, 100, low=True),
    Measure("symbols", "1000 * n_symbols div greatest(n_words, 1)", 75, 50, 40, 10, 100),
    Measure("dup_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", 99, 90, 5, 10, 400),
    Measure("repeats", "1000 * n_repeat_words div greatest(n_words, 1)", 99, 90, 5, 10, 400),
)
#: Copies of each threshold row, so that a hot source is joined in as many parts.
SALTS = 32
WINDOW = 5


def measured(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and the base counts of each text, as longs.

    Null and empty texts have no words. A window of five words is compared by a
    64-bit hash of its words within one text only.
    """
    split = f"filter(split(_t, '{BLANK}+'), w -> w != '')".replace("\\", "\\\\")
    gap = f"{BLANK}+".replace("\\", "\\\\")
    word = f"[^{BLANK[1:]}".replace("\\", "\\\\")
    out = docs.select(
        *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)],
        F.expr(f"coalesce(`{text}`, '')").alias("_t"),
        F.expr(f"filter(split(coalesce(`{text}`, ''), '\\n'), l -> l rlike '{word}')").alias("_lines"),
    ).select(
        "*",
        F.expr(split).alias("_w"),
        F.expr(f"length(regexp_replace(_t, '{gap}', ''))").alias("word_chars"),
        F.expr(f"length(regexp_replace(_t, '[^{SYMBOLS}]+', ''))").alias("n_symbols"),
        F.expr("size(_lines)").alias("n_lines"),
        F.expr("size(_lines) - size(array_distinct(_lines))").alias("n_dup_lines"),
    )
    hashed = ", ".join(f"_w[i + {k}]" for k in range(WINDOW))
    out = (
        out.drop("_lines", "_t")
        .withColumn("n_words", F.expr("size(_w)"))
        .withColumn(
            "_h",
            F.expr(
                f"if(size(_w) < {WINDOW}, array(), transform(sequence(0, size(_w) - {WINDOW}), i -> xxhash64({hashed})))"
            ),
        )
        .drop("_w")
        # Sorted by hash only where a window occurs twice; most texts have none.
        .withColumn(
            "_s",
            F.expr("if(size(array_distinct(_h)) < size(_h), sort_array(transform(_h, (h, i) -> struct(h, i))), array())"),
        )
        .drop("_h")
        .withColumn(
            "_at",
            F.expr(
                "sort_array(transform(filter(_s, (x, i) -> coalesce(x.h = get(_s, i - 1).h, false)"
                " or coalesce(x.h = get(_s, i + 1).h, false)), x -> x.i))"
            ),
        )
        .drop("_s")
        # Words under windows that start at sorted places: each reaches the next start or five words.
        .withColumn(
            "n_repeat_words",
            F.expr(
                f"aggregate(transform(_at, (x, i) -> least({WINDOW}, coalesce(get(_at, i + 1) - x, {WINDOW}))),"
                " 0L, (a, x) -> a + x)"
            ),
        )
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    return out.select(
        *[F.col(f"_k{i}") for i in range(len(keep))], *[F.col(c).cast("long").alias(c) for c in counts]
    )


def bucket(value: str) -> str:
    """Lower end of the bucket of a non-negative integer."""
    shift = f"greatest(length(bin({value})) - 6, 0)"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def sketched(rows: DataFrame) -> DataFrame:
    """Counts per (language, source, measure, bucket); rows that fail the base are left out."""
    each = ", ".join(f"struct({i} as measure, {m.value} as v)" for i, m in enumerate(MEASURES))
    return (
        rows.where("not base_failed")
        .select("lang", "source", F.expr(f"explode(array({each}))").alias("m"))
        .select("lang", "source", "m.measure", F.expr(bucket("m.v")).alias("low"))
        .groupBy("lang", "source", "measure", "low")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def of_measure(field: str) -> Column:
    """A field of the measure that a row is about."""
    return F.element_at(F.array(*[F.lit(getattr(m, field)) for m in MEASURES]), F.col("measure") + 1)


def quantiles(sketch: DataFrame, by: Sequence[str]) -> DataFrame:
    """The edge and middle percentile and the number of rows of each merged sketch."""
    merged = sketch.groupBy(*by, "measure", "low").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    placed = merged.select(
        *by,
        "measure",
        "low",
        F.sum("n").over(group.orderBy("low")).alias("upto"),
        F.sum("n").over(group).alias("of"),
    )
    at = lambda field: F.min(F.when(100 * F.col("upto") >= of_measure(field) * F.col("of"), F.col("low"))).alias(field)
    return placed.groupBy(*by, "measure").agg(F.max("of").alias("of"), at("edge"), at("middle"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """Per language and source the lowest and highest kept value of each measure."""
    found = ("of", "edge", "middle")
    exact = quantiles(sketch, ["lang", "source"])
    lang = quantiles(sketch, ["lang"]).select(F.col("lang").alias("l"), F.col("measure").alias("m"), F.struct(*found).alias("wide"))
    every = quantiles(sketch, []).select(F.col("measure").alias("k"), F.struct(*found).alias("all"))
    least = of_measure("least")
    spread = F.greatest(F.col("use.edge") - F.col("use.middle"), of_measure("step").cast("long"), 1 + F.shiftright("use.edge", 5))
    chosen = (
        exact.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("m")))
        .join(every, F.col("measure") == F.col("k"))
        .withColumn(
            "use",
            F.when(F.col("of") >= least, F.struct(*found))
            .when(F.col("wide.of") >= least, F.col("wide"))
            .otherwise(F.col("all")),
        )
        .withColumn("far", F.floor(of_measure("reach") * spread / 10))
    )
    pick = lambda i, c: F.max(F.when(F.col("measure") == i, c))
    low = F.when(of_measure("low"), F.col("use.middle") - F.col("far")).otherwise(F.lit(-1))
    return chosen.groupBy("lang", "source").agg(
        *[pick(i, F.col("use.edge") + F.col("far")).alias(f"high{i}") for i in range(len(MEASURES))],
        *[pick(i, low).alias(f"low{i}") for i in range(len(MEASURES))],
    )


def judged(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: key, counts, ``base_failed`` and ``kept``, and the columns ``keep``.

    Null or empty texts have no words and fail the base; null languages and
    sources are groups of their own; documents with the same key are judged one
    by one; an empty table gives an empty result; other columns are not read.
    """
    shared_dir(docs.sparkSession)
    rows = (
        measured(docs, text, [key, lang, source, *keep])
        .withColumnsRenamed({"_k0": "key", "_k1": "lang", "_k2": "source"})
        .withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
        # Read by the sketches and by the final filter; texts are scanned once.
        .checkpoint()
    )
    limits = thresholds(sketched(rows)).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    limits = limits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
    within: Column = ~F.col("base_failed")
    for i, m in enumerate(MEASURES):
        value = F.expr(m.value)
        fine = (F.expr(bucket(m.value)) <= F.col(f"high{i}")) & (value >= F.col(f"low{i}"))
        within = within & F.coalesce(fine, F.lit(True))
    joined = rows.withColumn("_salt1", salt).join(
        limits,
        F.col("lang").eqNullSafe(F.col("_lang"))
        & F.col("source").eqNullSafe(F.col("_source"))
        & (F.col("_salt1") == F.col("_salt")),
        "left",
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    own = [F.col(f"_k{i}").alias(c) for i, c in enumerate(keep, 3)]
    return joined.select(F.col("key").alias(key), *counts, "base_failed", within.alias("kept"), *own)

"""Quality rules in DataFrame functions: text measures and thresholds that adapt to language and source."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import SPACE_RUN, SPACES, text_of, without
from cellweave.session import cut

SYMBOLS = "#*$%&|<>"
#: Low bits of a packed window that hold its place; a Spark string has fewer words than that.
_PLACE = 30
_MASK = (1 << _PLACE) - 1
#: Measures that are bad when high, and what one more event adds to each; mean_word is bad on either side.
HIGH = ("symbol_share", "dup_line_share", "repeat_share")
BOTH = ("mean_word",)
#: Events (numerator, denominator): one symbol, one repeated line, the six words of one repeated window.
_EVENT = {"symbol_share": (1.0, "word_chars"), "dup_line_share": (1.0, "n_lines"), "repeat_share": (6.0, "n_words"), "mean_word": (0.0, "n_words")}
#: Relative error of a sketched quantile, and the spreads from the quartile that a document may lie beyond it.
ERROR, REACH = 0.001, 6.0
_GAMMA = (1 + ERROR) / (1 - ERROR)
#: The bucket of values that are not above zero.
ZERO = -1_000_000
#: Documents that a group needs for thresholds of its own; smaller ones use their language's, then all.
LEAST_GROUP = 50


def _twin(items: Column, key) -> Column:
    """Items of a sorted array whose key equals that of a neighbour."""

    def same(x, i):
        near = lambda j: F.coalesce(key(F.get(items, j)) == key(x), F.lit(False))
        return near(i - 1) | near(i + 1)

    return F.filter(items, same)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_lines`` and ``n_repeat_words``.

    Null text counts as empty: all are 0. Lines are split at newlines; only those with a
    word count. Repeated words lie in a window of three words found twice or more in the
    text. Windows are packed as 34 bits of hash and 30 of place and sorted as longs;
    neighbours with equal hashes are then compared as strings, so the count is exact.
    Everything is an expression on one row: no shuffle, nothing dropped from long texts.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]
    keep = without(docs, *({n for n in names} - {text.lower()}))
    cols = [F.col(f"`{c}`") for c in keep.columns]
    t = text_of(docs, text)
    trimmed = F.btrim(t, F.lit(SPACES))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    out = keep.select(
        *cols,
        F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN, -1)).alias("__cw_w"),
        lines.alias("__cw_l"),
        F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
    )
    w = F.col("__cw_w")
    hashed = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    places = F.sequence(F.lit(0), F.size(w) - 3)
    out = out.withColumn("__cw_h", F.when(F.size(w) >= 4, F.transform(places, hashed)))
    pack = lambda h, i: h.bitwiseAND(F.lit(~_MASK)).bitwiseOR(i.cast("long"))
    repeats = F.size(F.array_distinct("__cw_h")) < F.size("__cw_h")  # most texts have none, and are done here
    packed = F.when(repeats, F.sort_array(F.transform("__cw_h", pack)))
    out = out.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_lines": F.size("__cw_l").cast("long"),
        "n_dup_lines": (F.size("__cw_l") - F.size(F.array_distinct("__cw_l"))).cast("long"),
        "__cw_p": packed,
    })
    out = out.withColumn("__cw_c", _twin(F.col("__cw_p"), lambda x: F.shiftright(x, _PLACE)))
    place = lambda x: x.bitwiseAND(F.lit(_MASK)).cast("int")
    spelled = lambda x: F.struct(F.concat_ws(" ", F.get(w, place(x)), F.get(w, place(x) + 1), F.get(w, place(x) + 2)).alias("s"), place(x).alias("p"))
    out = out.withColumn("__cw_s", F.when(F.size("__cw_c") > 0, F.sort_array(F.transform("__cw_c", spelled))))
    out = out.withColumn("__cw_t", F.sort_array(F.transform(_twin(F.col("__cw_s"), lambda x: x["s"]), lambda x: x["p"])))
    at = F.col("__cw_t")
    spans = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
    out = out.withColumn("n_repeat_words", F.coalesce(F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))
    return out.select(*cols, *names)


def _share(top: str, below: str) -> Column:
    return F.when(F.col(below) > 0, F.col(top) / F.col(below)).otherwise(F.lit(0.0))


def rates() -> dict[str, Column]:
    return {
        "symbol_share": _share("n_symbols", "word_chars"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "mean_word": _share("word_chars", "n_words"),
    }


def bucket_of(value: Column) -> Column:
    """The bucket of a value in a log-scale sketch: bounds grow by a constant factor, so counts of buckets merge by sums."""
    return F.when(value > 0, F.ceil(F.ln(value) / math.log(_GAMMA)).cast("long")).otherwise(F.lit(ZERO).cast("long"))


def value_of(bucket: Column) -> Column:
    """The value for which a bucket stands, within ``ERROR`` of all values in it."""
    return F.when(bucket == ZERO, 0.0).otherwise(2.0 * F.pow(F.lit(_GAMMA), bucket.cast("double")) / (_GAMMA + 1))


def sketches(measured: DataFrame, lang: Column, source: Column) -> DataFrame:
    """Quantile sketches: ``__cw_lang, __cw_source, m, b, n``, the documents in each bucket of each measure of a group.

    Counts of log-scale buckets are exact sums, so a sketch is the same however the table is
    partitioned, and sketches merge by adding counts. Partial aggregation bounds what is
    shuffled by groups and buckets.
    """
    names = [*HIGH, *BOTH, "word_chars", "n_lines", "n_words"]
    each = F.array(*[F.struct(F.lit(m).alias("m"), bucket_of(F.col(m).cast("double")).alias("b")) for m in names])
    rows = measured.select(lang.alias("__cw_lang"), source.alias("__cw_source"), F.inline(each))
    return rows.groupBy("__cw_lang", "__cw_source", "m", "b").agg(F.count("*").alias("n"))


def _quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """For each group of ``keys``: number of documents ``n``, and of each measure the quartiles and the median."""
    merged = sketch.groupBy(*keys, "m", "b").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys, "m")
    ranked = merged.withColumns({"total": F.sum("n").over(whole), "upto": F.sum("n").over(whole.orderBy("b"))})
    at = lambda m, part: value_of(F.min(F.when((F.col("m") == m) & (4 * F.col("upto") >= part * F.col("total")), F.col("b"))))
    out = [F.max("total").alias("n")]
    for m in (*HIGH, *BOTH):
        out += [at(m, 1).alias(f"{m}_1"), at(m, 3).alias(f"{m}_3")]
    out += [at(m, 2).alias(f"{m}_2") for m in ("word_chars", "n_lines", "n_words")]
    return ranked.groupBy(*keys).agg(*out)


def fences(measured: DataFrame, lang: Column, source: Column, least: int) -> DataFrame:
    """One row for each language and source: quartiles and medians (a struct ``__cw_q``) that its documents are held against.

    Sketches are made once for each group and merged into those of languages and of all
    documents; a group with fewer than ``least`` documents takes the quantiles of its language,
    and a language with fewer those of all.
    """
    sketch = cut(sketches(measured, lang, source))
    packed = lambda df, tag: F.struct(*[c for c in df.columns if not c.startswith("__cw_")]).alias(tag)
    own = _quantiles(sketch, ["__cw_lang", "__cw_source"])
    own = own.select("__cw_lang", "__cw_source", packed(own, "__cw_own"))
    by_lang = _quantiles(sketch, ["__cw_lang"])
    by_lang = by_lang.select(F.col("__cw_lang").alias("__cw_lang2"), packed(by_lang, "__cw_of_lang"))
    of_all = _quantiles(sketch.withColumn("__cw_all", F.lit(0)), ["__cw_all"])
    of_all = of_all.select(packed(of_all, "__cw_of_all"))
    joined = own.join(by_lang, F.col("__cw_lang").eqNullSafe(F.col("__cw_lang2")), "left").join(F.broadcast(of_all))  # of_all is one row
    pick = F.when(F.col("__cw_own.n") >= least, F.col("__cw_own")).when(F.col("__cw_of_lang.n") >= least, F.col("__cw_of_lang")).otherwise(F.col("__cw_of_all"))
    return joined.select("__cw_lang", "__cw_source", pick.alias("__cw_q"))


def quality_rules(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", reach: float = REACH, least: int = LEAST_GROUP, stored: bool = True
) -> DataFrame:
    """Every row of ``docs`` (without its text if ``stored``) with measures, ``base_failed`` and ``kept``.

    A text with fewer than 50 words, or with more than half of them in repeated windows,
    fails the base rule (so null and empty texts do). Others are kept unless a measure lies
    beyond its group's fence: the quartile plus ``reach`` times the spread, which is the
    distance of the quartiles, but no less than what one event (a symbol, a repeated line, a
    repeated window, a word of the mean length) adds to a document of the group's median size
    and to the document itself. No cutoff is fixed: all follow from the sketches, and these
    don't depend on the partitioning. Null languages and sources are groups like others.
    Input columns with the names of the outputs are replaced; other columns stay, whatever
    their names. The measures are taken once: with ``stored`` (the default) they go through the
    shared checkpoint folder with the columns of ``docs``, so choose only those that are
    needed; texts that must stay are joined back by the caller, or ``stored`` is false and the
    texts are measured a second time. The fences join back by group; one row a group.
    """
    full = measure(without(docs, "base_failed", "kept", *HIGH, *BOTH), text).withColumns(rates())
    if stored:
        full = cut(full.select(*[F.col(f"`{c}`") for c in full.columns if c != text]))
    names = full.columns
    lang_of, source_of = F.col(f"`{lang}`"), F.col(f"`{source}`")
    limits = fences(full.where(F.col("n_words") >= 50), lang_of, source_of, least)
    joined = full.join(limits, lang_of.eqNullSafe(F.col("__cw_lang")) & source_of.eqNullSafe(F.col("__cw_source")), "left")
    beyond = []
    for m in (*HIGH, *BOTH):
        q1, q3, (event, size) = F.col(f"__cw_q.{m}_1"), F.col(f"__cw_q.{m}_3"), _EVENT[m]
        step = F.lit(event) if event else F.col(m)
        spread = F.greatest(q3 - q1, step / F.greatest(F.col(f"__cw_q.{size}_2"), F.lit(1.0)), step / F.greatest(F.col(size), F.lit(1)))
        beyond.append(F.round(F.col(m) - q3 - reach * spread, 9) > 0)
        if m in BOTH:
            beyond.append(F.round(q1 - F.col(m) - reach * spread, 9) > 0)
    outlier = F.coalesce(reduce(lambda a, b: a | b, beyond), F.lit(False))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~outlier}).select(*[F.col(f"`{c}`") for c in names], "base_failed", "kept")

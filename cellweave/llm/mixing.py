"""Mixing sources to target weights: subset-sum budget fitting over counts by exact length."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import text_of, without, word_count
from cellweave.session import cut, ship

#: Width of the dynamic program: the words of a budget that it fits exactly.
WINDOW = 1 << 16
#: Leading bits of the hash that slice one length of one source; only the slice with the bound is ranked.
SLICE_BITS = 8
#: A mixture names a weight for each source, so the sources are configuration; more are refused.
MAX_SOURCES = 1_000_000


def targets(sizes: dict[str | None, int], weights: Sequence[float], cap: float, share: float) -> dict[str | None, float]:
    """Words to take from each source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of
    all sizes; a target stops at ``cap`` times its source's size and the excess goes to the
    others by weight, until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in order if s in free)
        above = [s for s in order if s in free and left * weight[s] / total > cap * sizes[s]]
        if not above:
            return out | {s: left * weight[s] / total for s in order if s in free}
        for s in above:
            out[s] = float(cap * sizes[s])
        free -= set(above)
        left -= sum(out[s] for s in above)
    return out


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """How many documents of each size to take, so that their sizes add up to ``budget`` or little less.

    All but about half a ``WINDOW`` of words is taken in proportion to the counts. What remains
    (a small budget as a whole) is a bounded knapsack, whose reachable sums are the bits of an integer.
    """
    take = np.zeros(len(sizes), dtype=np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or total <= 0:
        return take
    if budget >= total:
        return counts.copy()
    exact = counts * (max(0, budget - WINDOW // 2) / total)
    take = np.minimum(np.floor(exact).astype(np.int64), counts)
    left = budget - int((take * sizes).sum())
    shuffled = np.random.default_rng(seed).permutation(len(sizes))
    for i in sorted(shuffled, key=lambda i: take[i] - exact[i]):  # one more where most was rounded off
        if take[i] < counts[i] and 0 < sizes[i] <= left - WINDOW:
            take[i] += 1
            left -= int(sizes[i])
    for i in np.argsort(-sizes, kind="stable"):
        if left <= WINDOW or sizes[i] <= 0:
            break
        more = min(int(counts[i] - take[i]), left // int(sizes[i]))
        take[i] += more
        left -= more * int(sizes[i])
    left = min(left, WINDOW)
    # reach has a bit for each sum that can be made; made_by names the step that first made it, so
    # going back from a sum needs no copies of reach: the sum before was made by an earlier step
    reach, steps, made_by = 1, [], np.full(left + 1, -1, dtype=np.int32)
    full = (1 << left + 1) - 1
    for i in shuffled:
        size, free, part = int(sizes[i]), int(counts[i] - take[i]), 1
        while free > 0 and 0 < size * part <= left and not reach >> left & 1:
            part = min(part, free)
            new = (reach << size * part) & full & ~reach
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(left // 8 + 1, "little"), dtype=np.uint8), bitorder="little")
                made_by[np.flatnonzero(bits[: left + 1])] = len(steps)
                steps.append((i, part))
                reach |= new
            free -= part
            part *= 2
    at = reach.bit_length() - 1
    while at > 0:
        i, part = steps[made_by[at]]
        take[i] += part
        at -= part * int(sizes[i])
    return take


def _sized(docs: DataFrame, seed: int, key: str, text: str, source: str) -> dict:
    """What a row is mixed by: its number of words, its source (marked if null) and the hash of key and text."""
    s = F.col(f"`{source}`")
    return {
        "__cw_n": word_count(text_of(docs, text)),
        "__cw_s": F.when(s.isNull(), "0").otherwise(F.concat(F.lit("1"), s.cast("string"))),
        "__cw_h": F.xxhash64(F.lit(seed), F.col(f"`{key}`"), F.col(f"`{text}`")),
    }


def plan_mixture(rows: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: int = 3, share: float = 1.0, seed: int = 17) -> DataFrame:
    """For each source and size of ``rows`` (``__cw_s, __cw_n, __cw_h``): what ``mix_to_targets`` needs to judge a row by itself.

    ``passes`` copies go to every row, one more to rows whose hash is below ``below``, and to those
    whose hash is ``below`` if ``ties``. Rows of one hash (repeats of one key and text) are
    counted before they are ranked, and only the slice that holds the bound is ranked.
    """
    spark = rows.sparkSession
    slices = cut(rows.groupBy("__cw_s", "__cw_n", F.shiftright("__cw_h", 64 - SLICE_BITS).alias("__cw_b")).agg(F.count("*").alias("n")))
    lengths = slices.groupBy("__cw_s", "__cw_n").agg(F.sum("n").alias("n"))
    totals = {r[0]: int(r[1]) for r in lengths.groupBy("__cw_s").agg(F.sum(F.col("__cw_n") * F.col("n"))).limit(MAX_SOURCES + 1).collect()}
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    aims = targets({None if s == "0" else s[1:]: n for s, n in totals.items()}, weights, cap, share)
    plan = pd.DataFrame([(s, n, float(aims[None if s == "0" else s[1:]])) for s, n in sorted(totals.items())], columns=["__cw_s", "whole", "target"])
    goal = spark.createDataFrame(plan, "__cw_s string, whole long, target double")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__cw_n")
        sizes, counts = rows["__cw_n"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        whole, budget = int(rows["whole"].iloc[0]), int(round(rows["target"].iloc[0]))
        passes = min(cap, budget // whole) if whole else 0
        rest = fit_budget(sizes, counts, budget - passes * whole if passes < cap else 0, seed)
        return rows[["__cw_s", "__cw_n", "whole", "target"]].assign(passes=np.int32(passes), extra=rest)

    fitted = cut(lengths.join(goal, "__cw_s").groupBy("__cw_s").applyInPandas(fit, "__cw_s string, __cw_n long, whole long, target double, passes int, extra long"))
    one = ["__cw_s", "__cw_n"]
    before = F.sum("n").over(Window.partitionBy(*one).orderBy("__cw_b")) - F.col("n")
    bound = slices.withColumn("before", before).join(fitted.select(*one, "extra"), one).where((F.col("extra") > F.col("before")) & (F.col("extra") <= F.col("before") + F.col("n")))
    bound = cut(bound.select(*one, "__cw_b", (F.col("extra") - F.col("before")).alias("left")))
    near = rows.withColumn("__cw_b", F.shiftright("__cw_h", 64 - SLICE_BITS)).join(bound, [*one, "__cw_b"]).groupBy(*one, "left", "__cw_h").agg(F.count("*").alias("n"))
    near = near.withColumn("before", F.sum("n").over(Window.partitionBy(*one).orderBy("__cw_h")) - F.col("n"))
    last = near.where((F.col("left") > F.col("before")) & (F.col("left") <= F.col("before") + F.col("n")))
    last = last.select(*one, F.col("__cw_h").alias("below"), (2 * (F.col("left") - F.col("before")) >= F.col("n")).alias("ties"))
    return cut(fitted.select(*one, "whole", "target", "passes").join(last, one, "left"))


def mix_to_targets(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    cap: int = 3,
    share: float = 1.0,
    seed: int = 17,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    with_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    Size is the number of words (null and empty text: 0). Each source's target (see
    ``targets``) is met by whole passes over it, then one more copy of chosen documents:
    ``fit_budget`` says how many of each length, and a seeded hash of key and text says
    which. No document has more than ``cap`` copies. A null source is a source. Documents
    without words have no copies, as they add nothing. Rows that agree in key and text
    are taken alike: if the bound falls among them, all or none of them, whichever is nearer.
    Reruns agree, however the table is partitioned. Input columns with the five names are
    replaced; other columns stay, whatever their names.

    Plan: the words of every text are counted once, and the rows without their texts (source,
    size, hash) are stored. Counts by source, length and slice of the hash are partial aggregates;
    each source's lengths (never its documents) reach one task for the fit, and of each length
    only the slice with the bound is ranked. The plan joins back by source and size and each
    row is judged by itself, so texts are not shuffled unless the plan is too large to broadcast.
    With ``with_text`` false the result lacks the text, and texts are read once.
    """
    spark = docs.sparkSession
    ship(spark)
    keep = without(docs, "size", "source_size", "target", "copies", "taken")
    names = [c for c in keep.columns if with_text or c != text]
    every = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    sized = keep.select(*(every if not with_text else []), *[c.alias(n) for n, c in _sized(docs, seed, key, text, source).items()])
    rows = cut(sized)
    plan = plan_mixture(rows.select("__cw_s", "__cw_n", "__cw_h"), weights, cap, share, seed)
    base = keep.select(*every, *[c.alias(n) for n, c in _sized(docs, seed, key, text, source).items()]) if with_text else rows
    h = F.col("__cw_h")
    more = F.coalesce((h < F.col("below")) | (h == F.col("below")) & F.col("ties"), F.lit(False))
    copies = F.when(F.col("__cw_n") == 0, 0).otherwise(F.col("passes") + more.cast("int"))
    out = base.join(plan, ["__cw_s", "__cw_n"])
    return out.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("__cw_n").alias("size"), F.col("whole").alias("source_size"), "target", copies.alias("copies"), (copies * F.col("__cw_n")).alias("taken")
    )

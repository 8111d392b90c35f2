"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import find_words, map_batches, word_count
from cellweave.session import ship

#: Text of the items in one broadcast index; a larger benchmark is searched in more passes.
INDEX_CHARS = 16_000_000


def shingles(words: list[str], width: int) -> set[tuple[str, ...]]:
    """Runs of ``width`` words; a shorter text is one run of all its words, an empty one has none."""
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def _order(shingle: tuple[str, ...]) -> bytes:
    return hashlib.blake2b(" ".join(shingle).encode("utf-8", "surrogatepass"), digest_size=8).digest()


@dataclass
class ContainmentIndex:
    """Items in partitions by size; each keeps the smallest hashes of its shingles as a sketch.

    A document's shingles are looked up in the sketches, and only the items found there are
    counted, over all of their shingles. An item of fewer than ``width`` words is one shingle of
    all its words, which is looked up among a document's runs of as many words.

    Of an item with n shingles a document that contains a share t may miss (1 - t) n. In the
    partition of sizes up to u, sketches hold floor((1 - t) u) + 1 minima, so at least one of
    them is in every such document: the search has no false negatives, and the sizes are
    partitioned so that sketches of short items are not made as long as those of long ones.
    """

    width: int
    share: float
    vocabulary: dict[str, int]
    sketch: dict[tuple[int, ...], list[int]]
    members: dict[int, list[tuple[int, ...]]]
    needed: dict[int, int]
    widths: list[int] = field(default_factory=list)

    @classmethod
    def build(cls, items: list[tuple[int, str]], width: int, share: float) -> ContainmentIndex:
        vocabulary: dict[str, int] = {}
        index = cls(width, share, vocabulary, {}, {}, {})
        for item, text in items:
            own = shingles(find_words(text or ""), width)
            if not own:
                continue
            upper = 1 << (len(own) - 1).bit_length()  # the partition's largest size
            minima = min(len(own), math.floor((1 - share) * upper + 1e-9) + 1)
            coded = [tuple(vocabulary.setdefault(w, len(vocabulary)) for w in s) for s in sorted(own, key=_order)]
            for s in coded[:minima]:
                index.sketch.setdefault(s, []).append(item)
            index.members[item] = coded
            index.needed[item] = math.ceil(share * len(own) - 1e-9)
        index.widths = sorted({len(s) for s in index.sketch})
        return index

    def _windows(self, ids: list[int | None]):
        """Runs of words that are all known, of the widths that items have: ``width`` words, fewer for shorter items."""
        for n in self.widths:
            run = 0
            for i, x in enumerate(ids):
                run = 0 if x is None else run + 1
                if run >= n:
                    yield tuple(ids[i - n + 1 : i + 1])

    def search(self, text: str | None) -> list[tuple[int, float]]:
        """Items of which the text contains at least the share, with their exact containment."""
        ids = list(map(self.vocabulary.get, find_words(text))) if text else []
        candidates: set[int] = set()
        for window in self._windows(ids):
            if window in self.sketch:
                candidates.update(self.sketch[window])
        if not candidates:
            return []
        own = set(self._windows(ids))
        hits = {item: sum(s in own for s in self.members[item]) for item in candidates}
        return sorted((item, n / len(self.members[item])) for item, n in hits.items() if n >= self.needed[item])


def _shards(items: DataFrame, key: str, text: str, least_words: int = 1):
    """Items in broadcast-sized lists; the number of lists follows from the measured size of the table."""
    narrow = items.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).where(F.col("k").isNotNull())
    narrow = narrow.where(word_count(F.col("t")) >= least_words)
    n = narrow.agg(F.sum(F.length("t"))).head()[0] or 0
    count = max(1, math.ceil(1.25 * n / INDEX_CHARS))
    for i in range(count):
        part = narrow.where(F.pmod(F.xxhash64("k", "t"), F.lit(count)) == i) if count > 1 else narrow
        rows = sorted({(r[0], r[1]) for r in part.collect()})
        yield [(k, t) for k, t in rows]


def find_contaminated(
    docs: DataFrame, items: DataFrame, width: int = 5, share: float = 0.8, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", least_words: int = 1
) -> DataFrame:
    """One row for each document that contains items: the key, ``items`` (sorted ids) and ``containment`` (the largest).

    Words are runs without ASCII white space, compared as they are; a shingle is five of
    them. An item with fewer words is contained in every document that has these words one
    after the other; ``least_words`` leaves out items that are too short to tell anything (by
    default none). Null and empty texts contain nothing and are contained in nothing; items with a null
    key are ignored; several texts of one item key are several items. Repeated documents
    give repeated rows. Whole documents are read, in one pass without a shuffle for each
    ``INDEX_CHARS`` of items, and each task holds one such index. After several passes the
    rows found, not the texts, are brought together by key and digest of the text.
    """
    ship(docs.sparkSession)
    narrow = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    kind, item_kind = dict(narrow.dtypes)["k"], dict(items.dtypes)[item_key]
    parts = []
    for rows in _shards(items, item_key, item_text, least_words):
        names = dict(enumerate(k for k, _ in rows))
        index = ContainmentIndex.build([(i, t) for i, (_, t) in enumerate(rows)], width, share)
        held = docs.sparkSession.sparkContext.broadcast((index, names))

        def run(batch, held=held):
            index, names = held.value
            keys, digests, ids, shares = [], [], [], []
            for k, t in zip(batch.column("k").to_pylist(), batch.column("t").to_pylist(), strict=True):
                if hits := index.search(t):
                    keys.append(k)
                    digests.append(hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest())
                    ids.append(sorted({names[i] for i, _ in hits}))
                    shares.append(max(c for _, c in hits))
            return {"k": keys, "digest": digests, "items": ids, "containment": shares}

        parts.append(map_batches(narrow, run, f"k {kind}, digest binary, items array<{item_kind}>, containment double"))
    out = parts[0] if len(parts) == 1 else _merged(parts)
    return out.select(F.col("k").alias(key), "items", "containment")


def _merged(parts: list[DataFrame]) -> DataFrame:
    """The rows that several passes found, one for each document again.

    Copies of a document (same key, same text) have the same row in a pass, so a pass counts
    them, and the merged row is repeated as often.
    """
    counted = [p.groupBy("k", "digest").agg(F.first("items").alias("items"), F.max("containment").alias("containment"), F.count("*").alias("n")) for p in parts]
    rows = reduce(DataFrame.unionByName, counted).groupBy("k", "digest").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("containment").alias("containment"), F.max("n").alias("n")
    )
    return rows.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("n"))))


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that contain no item, with all their columns; rows are judged one by one, so null keys are too."""
    ship(docs.sparkSession)
    width, share = options.get("width", 5), options.get("share", 0.8)
    kept = docs
    for rows in _shards(items, options.get("item_key", "item_id"), options.get("item_text", "text"), options.get("least_words", 1)):
        index = ContainmentIndex.build([(i, t) for i, (_, t) in enumerate(rows)], width, share)
        held = docs.sparkSession.sparkContext.broadcast(index)

        @F.pandas_udf("boolean")
        def clean(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: not held.value.search(t if isinstance(t, str) else None)).astype(bool)  # noqa: B023

        kept = kept.where(clean(F.col(f"`{text}`")))
    return kept

"""N-gram Jaccard join by chosen paths: sets are split on sampled shared tokens, small buckets are compared.

Every set is embedded as ``COORDINATES`` minima of its shingles. A run gives each set a tree
of paths: from a path, each minimum is chosen with chance 1 / (similarity * COORDINATES), so
sets at the threshold share one child on average and unlike ones hardly any. A bucket (all
sets at one path) of up to ``SMALL`` sets is compared in full; a larger one is split again, up
to ``DEPTH`` times, if that moves fewer rows than comparing it in blocks, as is done with what
can't be split with profit (sets that are all alike stay together). ``runs_for`` gives the
number of runs that reaches the target recall at the greatest depth, with all that can lose a
pair: the paths, that all runs share one set of minima, and the least agreement of likely pairs.

A pair may meet in many buckets. Sets carry the list of their final buckets, and a pair counts
only in the first one it has in common, so links are counted once without listing pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import _arrow_schema, map_batches
from cellweave.session import cut, ship

COORDINATES, SMALL, BLOCK, DEPTH, RECALL = 64, 1024, 256, 3, 0.99999
#: Representatives whose texts are fetched by a broadcast of their keys (8 bytes each); more are joined by shuffle.
BROADCAST_KEYS = 2_000_000
#: Sets of a large bucket by whose children it is judged whether a split pays; a bucket left whole loses no pair, a split one only by the chance that ``runs_for`` counts.
TRIED = 512

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_COORD_A = _RNG.integers(0, 2**63, size=COORDINATES, dtype=np.uint64) * _U(2) + _U(1)
_COORD_B = _RNG.integers(0, 2**63, size=COORDINATES, dtype=np.uint64)
_POWERS = np.cumprod(np.concatenate([[_U(1)], np.full(255, _BASE, dtype=np.uint64)]))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def least_agreement(similarity: float) -> float:
    """Minima that a pair must share to have its sets compared: five standard deviations below what is expected."""
    return COORDINATES * similarity - 5 * math.sqrt(COORDINATES * similarity * (1 - similarity))


def chance_lost(runs: int, depth: int, similarity: float) -> float:
    """The chance that a pair at the threshold isn't found, though its buckets are split ``depth`` times.

    Given the number x of minima in which the pair agrees, each of them is chosen with chance
    1 / (similarity * COORDINATES) from a path, so a run is a branching process of ``depth`` steps.
    """
    pick, least, lost = 1 / (similarity * COORDINATES), least_agreement(similarity), 0.0
    for x in range(COORDINATES + 1):
        chance = math.comb(COORDINATES, x) * similarity**x * (1 - similarity) ** (COORDINATES - x)
        meets = 1.0
        for _ in range(depth):
            meets = 1 - (1 - pick * meets) ** x
        lost += chance if x < least else chance * (1 - meets) ** runs
    return lost


def runs_for(recall: float = RECALL, depth: int = DEPTH, similarity: float = 0.8) -> int:
    """The least number of runs that finds a pair at the threshold with chance ``recall``."""
    floor = chance_lost(10_000, depth, similarity)
    if floor > 1 - recall:
        raise ValueError(f"{COORDINATES} minima can't reach a recall of {recall}: {floor:.1e} of pairs agree in too few")
    return next(n for n in range(1, 10_001) if chance_lost(n, depth, similarity) <= 1 - recall)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash for each word (run without ASCII white space) of the text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    solid = (raw != 32) & ((raw < 9) | (raw > 13))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], solid.view(np.int8), [0]])))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = _POWERS if lengths.max() <= 256 else np.cumprod(np.concatenate([[_U(1)], np.full(int(lengths.max()), _BASE, dtype=np.uint64)]))
    sums = np.add.reduceat(_BYTE[raw[solid]] * powers[place], first)
    return mix(sums ^ (lengths.astype(np.uint64) * _U(0xD6E8FEB86659FD93)))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of runs of ``width`` words; of all words of a shorter text; none of an empty one."""
    words = word_hashes(text) if text else np.zeros(0, dtype=np.uint64)
    if not len(words):
        return words
    n = min(width, len(words))
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for j in range(n):
        out = (out + words[j : len(words) - n + 1 + j]) * _U(0xD1342543DE82EF95) + _U(n)
    return np.unique(mix(out))


def minima(shingles: np.ndarray) -> np.ndarray:
    best = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 2048):
        part = shingles[None, i : i + 2048] * _COORD_A[:, None] + _COORD_B[:, None]
        np.minimum(best, part.min(axis=1), out=best)
    return (best >> _U(32)).astype(np.uint32)


def children(signature: np.ndarray, paths: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """For rows of signatures and their paths: row numbers and paths of the chosen children."""
    tokens = mix(signature.astype(np.uint64) * _U(COORDINATES) + np.arange(COORDINATES, dtype=np.uint64)[None, :])
    made = mix(tokens ^ paths[:, None])
    row, col = np.nonzero(made < _U(int(2**64 / (similarity * COORDINATES))))
    return row, mix(made[row, col] ^ _BASE)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _unsigned(column: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(column.to_numpy(zero_copy_only=False)).astype(np.int64).view(np.uint64)


def _signatures(column: pa.Array, kind=np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), COORDINATES)


def sketch(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``k``, the two halves ``a`` and ``b`` of the set's hash, its size ``n`` and its signature ``s``; n is 0 without words."""
    narrow = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).where(F.col("k").isNotNull())

    def run(batch):
        out: dict[str, list] = {"k": batch.column("k"), "a": [], "b": [], "n": [], "s": []}
        for t in batch.column("t").to_pylist():
            own = shingle_set(t, width)
            out["a"].append(int(_signed(np.array([own.sum()]))[0]) if len(own) else 0)
            out["b"].append(int(_signed(np.array([mix(own ^ _BASE).sum()]))[0]) if len(own) else 0)
            out["n"].append(len(own))
            out["s"].append(minima(own).tobytes() if len(own) else None)
        return out

    return map_batches(narrow, run, f"k {dict(narrow.dtypes)['k']}, a long, b long, n int, s binary")


def _first_paths(nodes: DataFrame, runs: int, similarity: float) -> DataFrame:
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64) * _BASE)

    def run(batch):
        signature = _signatures(batch.column("s"))
        rows, paths = [], []
        for root in roots:
            r, p = children(signature, np.full(len(signature), root), similarity)
            rows.append(r)
            paths.append(p)
        row = np.concatenate(rows)
        return {"a": batch.column("a").take(pa.array(row)), "b": batch.column("b").take(pa.array(row)), "p": _signed(np.concatenate(paths))}

    return map_batches(nodes.select("a", "b", "s"), run, "a long, b long, p long")


def _next_paths(rows: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Children of rows (a, b, p, m): their paths ``p``, with the parent's path ``o`` and size ``m``."""

    def run(batch):
        r, p = children(_signatures(batch.column("s")), _unsigned(batch.column("p")), similarity)
        at = pa.array(r)
        return {"a": batch.column("a").take(at), "b": batch.column("b").take(at), "p": _signed(p), "o": batch.column("p").take(at), "m": batch.column("m").take(at)}

    return map_batches(rows.join(nodes.select("a", "b", "s"), ["a", "b"]).select("a", "b", "p", "m", "s"), run, "a long, b long, p long, o long, m long")


def _worth_splitting(large: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Paths ``p`` of the large buckets of which a split moves fewer rows than their blocks do.

    About ``TRIED`` sets of each bucket, picked by hash, are split on trial. The verdict
    weighs work alone; a bucket that isn't split is compared whole, so recall is no lower than if all were split.
    """

    def blocks(size):
        return F.when(size <= SMALL, 1).otherwise(F.ceil(size / BLOCK))

    one_in = F.ceil(F.col("m") / TRIED)
    tried = _next_paths(large.where(F.pmod(F.xxhash64("a", "b", "p"), one_in) == 0), nodes, similarity)
    sizes = tried.groupBy("o", "m", "p").agg(F.count("*").alias("n"))
    moved = F.sum(F.col("n") * one_in * (2 + blocks((F.col("n") - 1) * one_in)))  # made and counted, then dealt to blocks
    return sizes.groupBy("o", "m").agg(moved.alias("moved")).where(F.col("moved") < F.col("m") * blocks(F.col("m"))).select(F.col("o").alias("p"))


def buckets(nodes: DataFrame, runs: int, similarity: float) -> DataFrame:
    """Final buckets: ``a``, ``b``, path ``p`` and bucket size ``m`` (2 or more)."""
    rows, done = _first_paths(nodes, runs, similarity), None
    for level in range(1, DEPTH + 1):
        rows = cut(rows)  # counted, then joined to the counts
        sizes = cut(rows.groupBy("p").agg(F.count("*").alias("m")).where("m > 1"))  # a plain join side, so a hot bucket can be split
        sized = cut(rows.join(sizes, "p").select("a", "b", "p", "m"))
        large = sized.where(F.col("m") > SMALL)
        if level == DEPTH or large.isEmpty():
            return sized if done is None else done.unionByName(sized)
        split = cut(_worth_splitting(large, nodes, similarity))
        final = sized.join(split, "p", "left_anti").select("a", "b", "p", "m")
        done = final if done is None else done.unionByName(final)
        rows = _next_paths(large.join(split, "p", "left_semi"), nodes, similarity).select("a", "b", "p")
    return done


def _groups(batches, columns: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches sorted by ``columns``, with the row numbers where groups start."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        if held:
            last = held[-1]
            change[0] = any(last.column(c)[last.num_rows - 1].as_py() != batch.column(c)[0].as_py() for c in columns)
        cuts = np.flatnonzero(change)
        if not len(cuts):
            held.append(batch)
            continue
        end = int(cuts[-1])
        whole = [*held, batch.slice(0, end)] if end else held
        held = [batch.slice(end)]
        if whole and sum(b.num_rows for b in whole):
            yield _table(whole, columns)
    if held:
        yield _table(held, columns)


def _table(batches: list[pa.RecordBatch], columns: tuple[str, ...]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    change = np.zeros(table.num_rows, dtype=bool)
    change[0] = True
    for c in columns:
        k = table.column(c).to_numpy()
        change[1:] |= k[1:] != k[:-1]
    return table, np.flatnonzero(change)


def _dealt(placed: DataFrame) -> DataFrame:
    """Rows for each bucket, or for each pair of blocks ``x <= y`` of a large one; ``z`` is the row's own block."""
    count = F.when(F.col("m") <= SMALL, 1).otherwise(F.ceil(F.col("m") / BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("a", "b", "p"), F.col("q")).cast("int")
    spread = placed.withColumn("q", count).withColumn("z", own)
    spread = spread.withColumn("o", F.explode(F.when(F.col("q") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("q") - 1))))
    return spread.withColumns({"x": F.least("z", "o"), "y": F.greatest("z", "o")}).drop("q", "o")


def _first_in_common(mine: list[int], other: frozenset, here: int) -> bool:
    return next(x for x in mine if x in other) == here


def _similar_nodes(placed: DataFrame, similarity: float) -> DataFrame:
    """Rows (bucket and node) that have a likely partner for which this bucket is the first in common."""
    least = least_agreement(similarity)
    keys = ("p", "x", "y")
    columns = ["a", "b", "p", "x", "y", "z", "w", "l"]
    types = _arrow_schema(placed, "a long, b long, p long, x int, y int, z int")

    def run(batches):
        for table, starts in _groups(batches, keys):
            n = table.num_rows
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
            signature = _signatures(table.column("w").combine_chunks(), np.uint16)
            block, name = table.column("z").to_numpy(), table.column("p").to_numpy()
            cross = table.column("x").to_numpy() != table.column("y").to_numpy()
            lists = table.column("l").to_pylist()
            sets: list[frozenset | None] = [None] * n
            wanted = np.zeros(n, dtype=bool)
            for d in range(1, int(np.diff(np.append(starts, n)).max())):
                i = np.flatnonzero((group[d:] == group[:-d]) & (~cross[d:] | (block[d:] != block[:-d])))
                if not len(i):
                    continue
                i = i[(signature[i] == signature[i + d]).sum(axis=1) >= least]
                for u in i.tolist():
                    v = u + d
                    if wanted[u] and wanted[v]:
                        continue
                    if sets[v] is None:
                        sets[v] = frozenset(lists[v])
                    if _first_in_common(lists[u], sets[v], name[u]):
                        wanted[u] = wanted[v] = True
            if wanted.any():
                kept = table.select(types.names).filter(pa.array(wanted))
                yield from kept.cast(types).to_batches()

    ordered = placed.select(columns).repartition("p", "x", "y").sortWithinPartitions(*keys)
    return ordered.mapInArrow(run, "a long, b long, p long, x int, y int, z int")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    m = len(sets)
    if m <= 6:
        out = np.zeros((m, m))
        for i in range(m):
            for j in range(i):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    everywhere = int((counts == m).sum())
    shared = (counts > 1) & (counts < m)
    column = np.cumsum(shared) - 1
    use = shared[inverse]
    rows, cols = rows[use], column[inverse[use]]
    out = np.full((m, m), float(everywhere))
    for c in range(0, int(shared.sum()), 16384):
        here = (cols >= c) & (cols < c + 16384)
        if here.any():
            dense = np.zeros((m, min(16384, int(shared.sum()) - c)), dtype=np.float32)
            dense[rows[here], cols[here] - c] = 1
            out += dense @ dense.T
    return out


def _links(wanted: DataFrame, similarity: float) -> DataFrame:
    """Exact links in each bucket: for each node ``r`` with links there, the sum of its partners' copies and a root ``o``."""
    keys = ("p", "x", "y")
    types = _arrow_schema(wanted, "r long, links long, o long")

    def one(table, lo, hi):
        part = table.slice(lo, hi - lo)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in part.column("t").to_pylist()]
        sizes = np.array([len(s) for s in sets], dtype=float)
        same = _overlaps(sets)
        # similarity >= c  <=>  (1 + c) * overlap >= c * (sum of sizes); the small slack is below any real difference
        linked = (1 + similarity) * same >= similarity * (sizes[:, None] + sizes[None, :]) - 1e-6
        np.fill_diagonal(linked, False)
        if part.column("x")[0].as_py() != part.column("y")[0].as_py():
            block = part.column("z").to_numpy()
            linked &= block[:, None] != block[None, :]
        lists, names = part.column("l").to_pylist(), part.column("p").to_numpy()
        as_sets = [frozenset(x) for x in lists]
        copies, rep = part.column("c").to_numpy(), part.column("r").to_numpy()
        total, root = np.zeros(hi - lo, dtype=np.int64), list(range(hi - lo))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
            if _first_in_common(lists[i], as_sets[j], names[i]):
                total[i] += copies[j]
                total[j] += copies[i]
                a, b = find(int(i)), find(int(j))
                if a != b:
                    a, b = (a, b) if rep[a] <= rep[b] else (b, a)
                    root[b] = a
        some = np.flatnonzero(total)
        return rep[some], total[some], rep[[find(int(i)) for i in some]] if len(some) else rep[some]

    def run(batches):
        for table, starts in _groups(batches, keys):
            found = [one(table, int(lo), int(hi)) for lo, hi in zip(starts, np.append(starts[1:], table.num_rows), strict=True) if hi - lo > 1]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), type=pa.int64()) for c in zip(*found, strict=True)], schema=types)

    ordered = wanted.select("p", "x", "y", "z", "l", "t", "c", "r").repartition("p", "x", "y").sortWithinPartitions(*keys)
    return ordered.mapInArrow(run, "r long, links long, o long")


def _sets_of(docs: DataFrame, nodes: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Shingle sets ``t`` of the nodes, from the texts of their representatives."""
    wanted = nodes.select("a", "b", F.col("r").alias("k"))
    narrow = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    keys = wanted.select("k").distinct()
    if wanted.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    texts = narrow.join(keys, "k", "left_semi")

    def run(batch):
        sets = [shingle_set(t, width) for t in batch.column("t").to_pylist()]
        return {
            "a": [int(_signed(np.array([s.sum()]))[0]) if len(s) else 0 for s in sets],
            "b": [int(_signed(np.array([mix(s ^ _BASE).sum()]))[0]) if len(s) else 0 for s in sets],
            "t": [s.tobytes() for s in sets],
        }

    found = map_batches(texts, run, "a long, b long, t binary")
    return found.groupBy("a", "b").agg(F.any_value("t").alias("t"))


def components(edges: DataFrame) -> DataFrame:
    """``v`` and its component's smallest member ``o`` for every member of ``edges`` (u, v), by alternating stars."""
    edges = cut(edges.select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u")).where("u <> v").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = cut(both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("o")))  # stored, so joins can split a hot member
        large = both.join(least, "v").where(F.col("u") > F.col("v")).select(F.col("u").alias("v"), F.col("o").alias("u")).distinct()
        large = cut(large)
        lower = cut(large.groupBy("v").agg(F.min("u").alias("o")))
        small = large.join(lower, "v").select(F.col("u").alias("v"), F.col("o").alias("u")).unionByName(lower.select("v", F.col("o").alias("u")))
        new = cut(small.where("u <> v").distinct())
        if new.count() == edges.count() and new.exceptAll(edges).isEmpty():
            return new.select("v", F.col("u").alias("o"))
        edges = new


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8, recall: float = RECALL) -> DataFrame:
    """One row for each document: the key, ``class_id`` and ``n_links``.

    Documents link if the Jaccard similarity of their sets of five-word shingles is at least
    ``similarity``; the similarity of candidates is exact. ``n_links`` counts a document's
    links, copies included; ``class_id`` is the smallest key that links lead to, its own
    without any. A text of fewer than five words is one shingle of all of them. Null and empty
    texts, and texts without words, link to nothing. Rows with a null key keep a null class
    and no links. Rows that repeat a key are versions of one document: they share a class,
    and each counts as a copy. Keys must be whole numbers. An empty table gives no rows.

    Copies (equal sets) are one node with a count from the start, so a class of copies, however
    large, costs one node. Shuffles carry signatures of 128 bytes to buckets; sets go only to
    buckets where a likely pair meets first. Buckets of any size are compared in groups of at
    most about ``SMALL`` rows, and each group gives one row for each node with links.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = dict(docs.select(F.col(f"`{key}`").alias("k")).dtypes)["k"]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"keys must be whole numbers, and {key!r} is {kind}")
    runs = runs_for(recall, similarity=similarity)
    rows = cut(sketch(docs, key, text, width))
    rows = rows.withColumn("k", F.col("k").cast("long"))
    solid = rows.where("n > 0")
    nodes = cut(solid.groupBy("a", "b").agg(F.count("*").alias("c"), F.min("k").alias("r"), F.any_value("s").alias("s")))
    final = buckets(nodes, runs, similarity)
    lists = final.groupBy("a", "b").agg(F.array_sort(F.collect_set("p")).alias("l"))
    signed = nodes.select("a", "b", "r", "c", "s")
    small = map_batches(
        signed, lambda batch: {"a": batch.column("a"), "b": batch.column("b"), "w": [x.astype(np.uint16).tobytes() for x in _signatures(batch.column("s"))]}, "a long, b long, w binary"
    )
    known = cut(lists)
    placed = final.join(known.join(small, ["a", "b"]), ["a", "b"])
    likely = cut(_similar_nodes(_dealt(placed), similarity))
    chosen = likely.select("a", "b").distinct().join(signed.select("a", "b", "r", "c"), ["a", "b"])
    chosen = cut(chosen)
    sets = _sets_of(docs, chosen, key, text, width)
    payload = chosen.join(known, ["a", "b"]).join(sets, ["a", "b"])
    found = cut(_links(likely.join(payload, ["a", "b"]), similarity))
    counted = found.groupBy("r").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("r").alias("v"), F.col("o").alias("u")).unionByName(_versions(solid)))
    named = nodes.select("a", "b", "c", "r").join(counted, "r", "left").join(joined.select(F.col("v").alias("r"), "o"), "r", "left")
    named = named.select("a", "b", F.coalesce("o", "r").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("c") - 1).alias("n_links"))
    whole = rows.select("k", "a", "b", "n").join(named, ["a", "b"], "left")
    out = whole.select(
        F.col("k").cast(kind).alias(key),
        F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("k")).cast(kind).alias("class_id"),
        F.when(F.col("n") > 0, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
    )
    lost = docs.where(F.col(f"`{key}`").isNull()).select(F.col(f"`{key}`").alias(key), F.lit(None).cast(kind).alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(lost)


def _versions(rows: DataFrame) -> DataFrame:
    """Edges between the representatives of nodes that hold rows of one key."""
    reps = rows.groupBy("a", "b").agg(F.min("k").alias("r"))
    several = rows.groupBy("k").agg(F.min(F.struct("a", "b")).alias("lo"), F.max(F.struct("a", "b")).alias("hi")).where("lo <> hi").select("k")
    pairs = rows.join(several, "k").select("k", "a", "b").distinct().join(reps, ["a", "b"]).select("k", F.col("r").alias("v"))
    least = cut(pairs.groupBy("k").agg(F.min("v").alias("u")))  # a plain join side, so a key with very many versions can be split
    return pairs.join(least, "k").select("u", "v")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that stay: of each class the one with the smallest key, all rows with a null key, each whole.

    Of rows that repeat a kept key one stays: the first by text, then by all columns (rows that
    agree in all are the same row). Columns may have any names.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    k = F.col(f"`{key}`")
    classes = cut(jaccard_join(docs, key, text, **options).select(k.alias("k"), F.col("class_id").alias("c")).where(F.col("k").isNotNull()))
    gone = classes.where("c <> k").select(F.col("k").alias("__cw_k")).distinct()
    kept = docs.join(gone, k == F.col("__cw_k"), "left_anti").select(*columns)
    repeated = cut(classes.groupBy("k").count().where("count > 1").select(F.col("k").alias("__cw_k")))
    if repeated.isEmpty():
        return kept
    again = kept.join(repeated, k == F.col("__cw_k"), "left_semi")
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    first = again.groupBy(k.alias("__cw_k")).agg(F.min_by(whole, F.struct(F.col(f"`{text}`"), F.to_json(whole))).alias("r"))
    first = first.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    return kept.join(repeated, k == F.col("__cw_k"), "left_anti").select(*columns).unionByName(first)

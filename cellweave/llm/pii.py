"""Personal data: base patterns, and contextual patterns bootstrapped from what they find."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import map_batches
from cellweave.session import cut, ship

#: Kinds in the order that ties of start take; the last two are what contexts find.
KINDS = ("email", "ip", "card", "phone", "id", "secret")
BASE_KINDS = KINDS[:4]
_ORDER = {k: i for i, k in enumerate(KINDS)}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HINT = re.compile(r"[0-9@=:#]")
_GAP = re.compile(r"[\x20\x09-\x0D]+")
_EDGE = " \t\n\x0b\x0c\r.,;:!?()[]{}<>\"'`*|"
_TAIL = _EDGE + "#$%&"
#: A label at the beginning of a word (``password=``), and one that ends a text (``token = "``).
_INNER = re.compile(r"""["'(\[{<]*([^\W\d_][\w.-]{1,39})["']?[=:#]+(?!//)["'(\[]*(?=[^\s=:#])""")
_BEFORE = re.compile(r"""([^\W\d_][\w.-]{1,39})["']?[ \t]*[=:#]+[ \t]*["'(\[]*\Z""")
#: A random-looking word: letters and digits (and signs of base 64), 16 or more of them.
_RANDOM = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}\Z")
_TURN = re.compile(r"[A-Za-z][0-9]|[0-9][A-Za-z]")
#: Beginnings that name a kind of key: a word and a sign, or capitals that are no hexadecimal digits, before capitals and digits.
_PREFIX = re.compile(r"[A-Za-z]{2,8}[_-]|(?![A-F]{4})[A-Z]{4}(?=[A-Z0-9]{12,}\Z)")
_CLOSING = re.compile(r"[\"'<>|]")

#: The confidence and the distinct good instances that a pattern needs.
CONFIDENCE, SUPPORT = 0.8, 5
#: Scoring ends when no accepted pattern's score rises by more in a round.
STILL = 1e-6
#: Least characters and digits of an unseen identifier without a label; least characters of one with a label.
LEAST_CHARS, LEAST_DIGITS, LEAST_LABELLED = 6, 2, 3
#: Changes between letters and digits that make a word random-looking.
LEAST_TURNS = 3
#: Accepted patterns that are broadcast; a longer table of patterns is joined instead.
PATTERNS_PER_BROADCAST = 200_000


def _luhn(digits: str) -> bool:
    odd, even = digits[::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping; found from each ``@`` outwards, so in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of the four base kinds, by start, then kind."""
    if not text:
        return []
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    out.sort(key=lambda s: (s[1], _ORDER[s[0]]))
    return out


def _norm(word: str) -> str:
    return _DIGIT.sub("0", word.lower())[:40]


def _clean_edges(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in _EDGE:
        a += 1
    if closing := _CLOSING.search(text, a, b):
        b = closing.start()
    while b > a and text[b - 1] in _TAIL:
        b -= 1
    return a, b


def looks_random(word: str) -> bool:
    """Whether a word looks like a key or a digest: long, of letters and digits that change often."""
    return len(word) >= 16 and bool(_RANDOM.match(word)) and len(_TURN.findall(word)) + len(_TURN.findall(word, 1)) >= LEAST_TURNS


def _candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, bool]]:
    """Start and end of words that may be identifiers, and whether a label comes before.

    They stand outside of the base spans, or are random-looking words that hold one (digits in a key).
    """
    covered, at, last = 0, 0, -1
    while hint := _HINT.search(text, at):
        a = hint.start()
        while a > at and text[a - 1] not in " \t\n\x0b\x0c\r":
            a -= 1
        gap = _GAP.search(text, hint.end())
        at = b = gap.start() if gap else len(text)
        places = [(a, b, False)]
        if label := _INNER.match(text, a, b):
            places = [(label.end(), b, True)]
        elif gap and text[b - 1] in "=:#":  # the value is the next word
            after = _GAP.search(text, gap.end())
            places.append((gap.end(), after.start() if after else len(text), True))
        for a, b, labelled in places:
            a, b = _clean_edges(text, a, b)
            if a <= last or not labelled and (b - a < LEAST_CHARS or len(_DIGIT.findall(text, a, b)) < LEAST_DIGITS) or b - a < LEAST_LABELLED:
                continue
            while covered < len(base) and base[covered][2] <= a:
                covered += 1
            over = [s for s in base[covered : covered + 8] if s[1] < b and s[2] > a]
            if over and not (looks_random(text[a:b]) and all(a <= s[1] and s[2] <= b and s[2] - s[1] < b - a for s in over)):
                continue
            last = a
            yield a, b, labelled


def _patterns(text: str, a: int, b: int) -> list[str]:
    """Lexical patterns of a place: its label (L), its literal beginning (P), and frames of words (F, B, A)."""
    before, out = text[max(0, a - 120) : a], []
    if label := _BEFORE.search(before[-60:]):
        out.append(f"L {_norm(label[1])}")
    if looks_random(text[a:b]) and (prefix := _PREFIX.match(text[a:b])):
        out.append(f"P {prefix[0]} {(b - a).bit_length()}")
    if not out and (not before or before[-1].isspace()):
        words = before.split()
        if a <= 120:
            words = ["^", "^", *words]
        after = [w.rstrip(_EDGE) or "," for w in text[b : b + 60].lstrip(_EDGE).split(None, 2)[:2]]
        if b + 60 >= len(text):
            after += ["$", "$"]
        words, after = [_norm(w) for w in words[-2:]], [_norm(w) for w in after[:2]]
        if len(words) == 2 and after:
            out.append(f"F {words[0]} {words[1]} _ {after[0]}")
        if len(words) == 2 and words[1] != "^":
            out.append(f"B {words[0]} {words[1]} _")
        if len(after) == 2 and after[0] != "$":
            out.append(f"A _ {after[0]} {after[1]}")
    return out


def mentions(text: str | None, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, list[str], str]]:
    """Base spans and words that may be identifiers: start, end, lexical patterns, kind of seed ("" for none).

    Base spans are seeds, and so are random-looking words (``secret``). A word after a label
    (``password=``, ``token = "``, ``contact:``) is one of any form; without a label it needs
    ``LEAST_CHARS`` characters with ``LEAST_DIGITS`` digits. Patterns are the label, or frames: two words
    before and one after, two before, two after, where ``^`` and ``$`` are the ends of the text. A
    random-looking word has its literal beginning, with its length up to a factor of two, too.
    """
    if not text:
        return
    for kind, a, b in base:
        if patterns := _patterns(text, a, b):
            yield a, b, patterns, kind
    for a, b, _ in _candidates(text, base):
        if patterns := _patterns(text, a, b):
            yield a, b, patterns, "secret" if looks_random(text[a:b]) else ""


def _instance(text: str) -> str:
    return hashlib.blake2b(text.lower().encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def learn_patterns(docs: DataFrame, text: str = "text", rounds: int | None = None, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """High-confidence lexical patterns: ``pattern``, ``score``, ``n_good``, ``kind``.

    The graph has an edge for each pattern and instance that occur together anywhere in the
    corpus. Seeds score 1. In each round a pattern scores the mean of its instances (with one
    bad one added), and an instance the chance that any of its confident patterns is right.
    Discovered instances count as seeds do, so a pattern may have no seed of its own. Scores
    never fall, and rounds go on until they stand still (or ``rounds`` are done). Patterns with
    fewer than ``support`` instances can't be accepted, and their edges are left out. ``kind``, of
    what a pattern discovers, is ``secret`` if most of its seeds are random-looking words, else ``id``.
    Edges are made distinct by partial aggregation first, so a pattern or an instance that is
    very frequent gives one row to each task. Instances go by digest, so the graph holds no
    personal data. Null and empty texts give no edges.
    """
    narrow = docs.select(F.col(f"`{text}`").alias("t"))

    def run(batch):
        seen: dict[tuple[str, str], int] = {}
        for t in batch.column("t").to_pylist():
            if t and _HINT.search(t):
                for a, b, patterns, seed in mentions(t, base_spans(t)):
                    instance, rank = _instance(t[a:b]), 0 if not seed else 1 if seed == "secret" else 2
                    for p in patterns:
                        seen[p, instance] = max(seen.get((p, instance), 0), rank)
        return {"pattern": [p for p, _ in seen], "instance": [i for _, i in seen], "seed": list(seen.values())}

    edges = map_batches(narrow, run, "pattern string, instance string, seed int")
    edges = cut(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")))
    is_seed = F.col("seed") > 0
    counts = [F.count("*").alias("n"), F.count_if(is_seed).alias("seeds"), F.count_if(F.col("seed") == 1).alias("s"), F.count_if(F.col("seed") == 2).alias("b")]
    kind = F.when(F.col("s") > F.col("b"), "secret").otherwise("id").alias("kind")
    known = cut(edges.groupBy("pattern").agg(*counts).where(F.col("n") >= support).select("pattern", "n", "seeds", kind))
    unseen = cut(edges.where(~is_seed).join(known.select("pattern"), "pattern", "left_semi").select("pattern", "instance"))
    score, n_good = (F.col("seeds") + F.col("gain")) / (F.col("n") + 1), F.col("seeds") + F.col("more")

    def accepted(rows: DataFrame) -> DataFrame:
        return rows.select("pattern", score.alias("score"), n_good.cast("long").alias("n_good"), "kind").where((F.col("score") >= confidence) & (F.col("n_good") >= support))

    # seeds score 1 for good, so their part of a pattern is counted once; rounds work on unseen instances alone
    sure = good = cut(accepted(known.withColumns({"gain": F.lit(0.0), "more": F.lit(0)})))
    r = 1
    while r != rounds:
        doubt = unseen.join(good, "pattern").groupBy("instance").agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.999)))))).alias("p"))
        gains = cut(unseen.join(doubt, "instance").groupBy("pattern").agg(F.sum("p").alias("gain"), F.count_if(F.col("p") >= 0.5).alias("more")))
        new = cut(accepted(known.join(gains, "pattern")).unionByName(sure.join(gains, "pattern", "left_anti")))
        rise = new.join(good.select("pattern", F.col("score").alias("old")), "pattern", "left").where(F.col("score") - F.coalesce("old", F.lit(0.0)) > STILL)
        good, r = new, r + 1
        if rise.isEmpty():
            break
    return good


def _extra(text: str, base: list[tuple[str, int, int]], accepted: dict[str, str]) -> list[tuple[str, int, int]]:
    """Spans that accepted patterns discover; ``secret`` goes before ``id`` where patterns disagree."""
    out = []
    for a, b, _ in _candidates(text, base):
        kinds = {accepted[p] for p in _patterns(text, a, b) if p in accepted}
        if kinds:
            out.append((max(kinds), a, b))
    return out


def _with_extras(docs: DataFrame, patterns: DataFrame, text: str):
    """``docs``, the name of a column with discovered spans (or None), and a broadcast of the patterns (or None).

    Up to ``PATTERNS_PER_BROADCAST`` patterns are broadcast and looked up with the texts. A longer
    table is joined: distinct texts give their candidates, these meet the patterns, and the
    spans come back to the texts by their digest. Both ways find the same spans.
    """
    spark = docs.sparkSession
    if patterns.count() <= PATTERNS_PER_BROADCAST:
        return docs, None, spark.sparkContext.broadcast({r["pattern"]: r["kind"] for r in patterns.select("pattern", "kind").toLocalIterator()})

    def run(batch):
        out: dict[str, list] = {"d": [], "a": [], "b": [], "pattern": []}
        for t in batch.column("t").to_pylist():
            if t and _HINT.search(t):
                digest = hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
                for a, b, _ in _candidates(t, base_spans(t)):
                    for p in _patterns(t, a, b):
                        for name, value in (("d", digest), ("a", a), ("b", b), ("pattern", p)):
                            out[name].append(value)
        return out

    places = map_batches(docs.select(F.col(f"`{text}`").alias("t")), run, "d string, a int, b int, pattern string").distinct()
    found = places.join(patterns.select("pattern", "kind"), "pattern").groupBy("d", "a", "b").agg(F.max("kind").alias("kind"))
    spelled = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "kind", "a", "b"))), ",")
    found = cut(found.groupBy("d").agg(spelled.alias("__cw_spans")).withColumnRenamed("d", "__cw_digest"))
    with_digest = docs.withColumn("__cw_digest", F.sha2(F.col(f"`{text}`").cast("binary"), 256))
    return with_digest.join(found, "__cw_digest", "left").drop("__cw_digest"), "__cw_spans", None


def _read_spans(spelled: str | None) -> list[tuple[str, int, int]]:
    parts = (s.split(":") for s in spelled.split(",")) if spelled else ()
    return [(k, int(a), int(b)) for k, a, b in parts]


def _spelled(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, patterns: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: counts of all kinds, ``base_sha256``, ``spans`` and ``n_found`` (of all spans).

    ``patterns`` come from ``learn_patterns``, by default over the same documents. Spans are
    code points, end exclusive, written ``kind:start:end`` by start, then kind. A null or an
    empty text has no spans, and the hash of an empty string. Repeated rows give repeated
    results, null keys stay. Two passes over the texts, no shuffle of them unless the patterns
    are too many to broadcast.
    """
    ship(docs.sparkSession)
    patterns = learn_patterns(docs, text) if patterns is None else patterns
    narrow = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    kind = dict(narrow.dtypes)["k"]
    narrow, spans, held = _with_extras(narrow, patterns, "t")

    def run(batch):
        accepted = held.value if held else {}
        given = batch.column(spans).to_pylist() if spans else [None] * batch.num_rows
        out: dict[str, list] = {n: [] for n in (*[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_found")}
        for t, more in zip(batch.column("t").to_pylist(), given, strict=True):
            base = base_spans(t)
            extra = _read_spans(more) if spans else _extra(t, base, accepted) if t and accepted else []
            for k in KINDS:
                out[f"n_{k}"].append(sum(s[0] == k for s in [*base, *extra]))
            out["base_sha256"].append(hashlib.sha256(_spelled(base).encode()).hexdigest())
            out["spans"].append(_spelled(sorted([*base, *extra], key=lambda s: (s[1], _ORDER[s[0]]))))
            out["n_found"].append(len(base) + len(extra))
        return out | {"k": batch.column("k")}

    schema = f"k {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_found long"
    return map_batches(narrow, run, schema).withColumnRenamed("k", key)


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with ``[KIND]`` for each span; overlapping spans are one, named by the first."""
    out, at, end = [], 0, -1
    for kind, a, b in sorted(spans, key=lambda s: (s[1], _ORDER[s[0]])):
        if a < end:
            end = max(end, b)
            at = max(at, b)
            continue
        out += [text[at:a], f"[{kind.upper()}]"]
        at = end = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, patterns: DataFrame | None = None, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind; null texts stay null, other columns as they are."""
    ship(docs.sparkSession)
    patterns = learn_patterns(docs, text) if patterns is None else patterns
    ready, spans, held = _with_extras(docs, patterns, text)

    @F.pandas_udf("string")
    def clean(texts: pd.Series, more: pd.Series) -> pd.Series:
        accepted = held.value if held else {}

        def one(t, given):
            if not isinstance(t, str) or not _HINT.search(t):
                return t
            base = base_spans(t)
            extra = _read_spans(given if isinstance(given, str) else None) if spans else _extra(t, base, accepted) if accepted else []
            return redact_text(t, [*base, *extra]) if base or extra else t

        return pd.Series([one(t, given) for t, given in zip(texts, more, strict=True)], dtype=object)

    done: Column = clean(F.col(f"`{text}`"), F.col(spans) if spans else F.lit(None).cast("string"))
    return ready.withColumn(text, done).select(*[F.col(f"`{c}`") for c in docs.columns])

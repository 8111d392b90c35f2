"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import map_batches, without

#: Entries of a worker's cache of counted pieces; it is emptied when full.
CACHE = 400_000
#: Symbols of a vocabulary: two of them are packed with their rank into one integer.
_MOST_SYMBOLS = 1 << 20
#: The white space of Unicode, and the byte-level splitting pattern.
_SPACE = "\t-\r \x85\xa0  -     　"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte: itself, or the next free one from 256 on."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    rest = (b for b in range(256) if b not in own)
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def _steps(spec: dict | None, name: str) -> list[dict]:
    """The steps of a normalizer, a pre-tokenizer or the like, whether one or a sequence."""
    if not spec:
        return []
    return [y for x in spec[name] for y in _steps(x, name)] if spec.get("type") == "Sequence" else [spec]


def check_supported(spec: dict) -> None:
    """Refuse files that ask for anything but plain byte-level merging, rather than miscount."""
    model = spec.get("model", {})
    faults = []
    if model.get("type") not in (None, "BPE") or "merges" not in model:
        faults.append("its model isn't BPE")
    if any(model.get(k) for k in ("dropout", "byte_fallback", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        faults.append("its model has options beyond merges")
    if len(model.get("vocab", ())) > _MOST_SYMBOLS:
        faults.append(f"it has more than {_MOST_SYMBOLS} symbols")
    if _steps(spec.get("normalizer"), "normalizers"):
        faults.append("it has a normalizer")
    steps = _steps(spec.get("pre_tokenizer"), "pretokenizers")
    if [x.get("type") for x in steps] != ["ByteLevel"] or steps[0].get("add_prefix_space") or not steps[0].get("use_regex", True):
        faults.append("its pre-tokenizer isn't the byte-level one without a leading space")
    if any(t.get(k) for t in spec.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip")):
        faults.append("its added tokens take white space or whole words only")
    if any(not t.get("special") and t.get("normalized") is None for t in spec.get("added_tokens", ())):
        faults.append("its added tokens don't say how they are found")
    if faults:
        raise ValueError("this tokenizer file isn't supported: " + "; ".join(faults))


class BpeCounter:
    """Counts the tokens that a byte-level BPE tokenizer file gives a text; other files are refused."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check_supported(spec)
        byte_of = _byte_letters()
        vocab = spec["model"]["vocab"]
        self.symbol = [0] * 256
        for letter, byte in byte_of.items():
            self.symbol[byte] = vocab[letter]
        #: left << 20 | right -> rank << 20 | merged
        self.merge: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merge.setdefault(vocab[left] << 20 | vocab[right], rank << 20 | vocab[left + right])
        specials = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.fine = regex.compile(PATTERN)
        self.coarse = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
        self.pieces: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def merges(self, word: bytes) -> int:
        """Symbols of one word after all merges: its bytes less one for each merge."""
        symbols = [self.symbol[b] for b in word]
        left_of = list(range(-1, len(symbols) - 1))
        right_of = list(range(1, len(symbols) + 1))
        merge, count = self.merge, len(symbols)
        heap = []
        for i in range(count - 1):
            found = merge.get(symbols[i] << 20 | symbols[i + 1])
            if found is not None:
                heap.append((found >> 20, i, found & 0xFFFFF, symbols[i], symbols[i + 1]))
        heapify(heap)
        end = len(symbols)
        while heap:
            _, i, made, a, b = heappop(heap)
            j = right_of[i]
            if symbols[i] != a or j >= end or symbols[j] != b:
                continue  # a neighbour has been merged since
            symbols[i], symbols[j] = made, -1
            count -= 1
            k = right_of[i] = right_of[j]
            if k < end:
                left_of[k] = i
                found = merge.get(made << 20 | symbols[k])
                if found is not None:
                    heappush(heap, (found >> 20, i, found & 0xFFFFF, made, symbols[k]))
            h = left_of[i]
            if h >= 0:
                found = merge.get(symbols[h] << 20 | made)
                if found is not None:
                    heappush(heap, (found >> 20, h, found & 0xFFFFF, symbols[h], made))
        return count

    def _word(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            n = self.merges(word.encode("utf-8", "surrogatepass"))
            if len(word) <= 64:
                if len(self.words) >= CACHE:
                    self.words.clear()
                self.words[word] = n
        return n

    def _piece(self, piece: str) -> int:
        n = self._word(piece) if piece[0] == " " and piece[1:].isalpha() else sum(map(self._word, self.fine.findall(piece)))
        if len(piece) <= 64:
            if len(self.pieces) >= CACHE:
                self.pieces.clear()
            self.pieces[piece] = n
        return n

    def _plain(self, text: str) -> int:
        known, total = self.pieces.get, 0
        for piece in self.coarse.findall(text):
            n = known(piece)
            total += self._piece(piece) if n is None else n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None:
            return self._plain(text)
        total, at = 0, 0
        for found in self.special.finditer(text):
            total += self._plain(text[at : found.start()]) + 1
            at = found.end()
        return total + self._plain(text[at:] if at else text)


@lru_cache(maxsize=2)
def counter(path: str) -> BpeCounter:
    return BpeCounter(path)


def count_tokens(df: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` for every row of ``df``.

    ``path`` names a byte-level BPE file in the tokenizers format, present on every worker.
    A null text counts as empty: no bytes, no tokens. Whole texts are counted; repeated
    rows give repeated results. There is no shuffle, and memory is bounded by a batch and
    the two caches of ``CACHE`` pieces.
    """
    narrow = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    kind = dict(narrow.dtypes)["k"]

    def run(batch):
        tool = counter(path)
        texts = batch.column("t").to_pylist()
        counts = [tool.count(t) for t in texts]
        return {"k": batch.column("k"), "n_bytes": [len(t.encode()) if t else 0 for t in texts], "n_tokens": counts, "over_limit": [n > limit for n in counts]}

    out = map_batches(narrow, run, f"k {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("k", key)

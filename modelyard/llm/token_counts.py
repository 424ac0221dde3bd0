"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a word form a linked list and its adjacent pairs a heap ordered
by (rank, place).  The least pair is popped again and again and merged, its new
neighbours are pushed, and entries whose symbols have changed since are
skipped.  The count of a word is its symbols minus its merges; no ids are made.
"""

from __future__ import annotations

import heapq
import json
import re

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_text

CACHE_ENTRIES = 300_000

# White space, ASCII and Latin letters, dashes and quotes: here str.lower() and
# str.split() do what the normalizer of the vocabulary does.  Everything else
# goes through that normalizer itself.
_OTHER = regex.compile("[^\t\n\r\x20-\x7e\xa0-įĲ-ɏ‐-‧]")


class HeapCounter:
    """Counts tokens under one tokenizers JSON file (BPE with a word-end suffix)."""

    def __init__(self, spec: str, cache: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer
        conf = json.loads(spec)
        model = conf["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("unk_token"):
            raise ValueError("need a BPE vocabulary without byte fallback or unknown token")
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {p: i for i, p in enumerate(pairs)}
        self.known = set(model["vocab"])
        self.suffix = model["end_of_word_suffix"] or ""
        tokenizer = Tokenizer.from_str(spec)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        marks = sorted((t["content"] for t in conf["added_tokens"]), key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, marks))) if marks else None
        split = next(p for p in conf["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        # The byte alphabet, as the vocabulary's own splitter writes it.
        self.alphabet = _alphabet()
        self.words = _Counts(self._word, cache)
        self.chunks = _Counts(self._chunk, cache)

    def merged(self, symbols: list[str]) -> int:
        """Symbols left after all merges."""
        symbols = [s for s in symbols if s in self.known]
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(ranks[p], i, p[0] + p[1]) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, whole = heapq.heappop(heap)
            j = after[i]
            left = symbols[i]
            if left is None or j >= n or left + symbols[j] != whole or (left, symbols[j]) not in ranks:
                continue
            symbols[i], symbols[j] = whole, None
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = ranks.get((whole, symbols[k]))
                if r is not None:
                    heapq.heappush(heap, (r, i, whole + symbols[k]))
            h = before[i]
            if h >= 0:
                r = ranks.get((symbols[h], whole))
                if r is not None:
                    heapq.heappush(heap, (r, h, symbols[h] + whole))
        return n - merges

    def _spelled(self, letters: str) -> int:
        return self.merged([*letters[:-1], letters[-1] + self.suffix]) if letters else 0

    def _word(self, word: str) -> int:
        return self._spelled("".join([self.alphabet[b] for b in word.encode("utf-8")]))

    def _chunk(self, chunk: str) -> int:
        """A run without white space, which the splitter never crosses."""
        return sum([self.words[w] for w in self.pattern.findall(chunk.lower())])

    def _span(self, text: str) -> int:
        if _OTHER.search(text):
            text = self.normalizer.normalize_str(text)
            return sum([self._spelled(w) for w, _ in self.splitter.pre_tokenize_str(text)])
        return sum(map(self.chunks.__getitem__, text.split()))

    def count(self, text: str | None) -> int:
        """Tokens of a text; a null text is an empty one, a special string is one token."""
        if not text:
            return 0
        if self.marks is None or not self.marks.search(text):
            return self._span(text)
        spans = self.marks.split(text)
        return len(spans) - 1 + sum([self._span(s) for s in spans if s])


class _Counts(dict):
    """Counts by short key; emptied when full, so memory stays bounded."""

    def __init__(self, make, limit: int):
        self.make, self.limit = make, limit

    def __missing__(self, key: str) -> int:
        got = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[key] = got
        return got


def _alphabet() -> list[str]:
    """A printable character for every byte; bytes without one take those from 256 on."""
    shown = {b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def count_tokens(df: DataFrame, vocabulary: str, text_col: str = "text",
                 out: str = "n_tokens") -> DataFrame:
    """Add ``out`` (long), the tokens of ``text_col``, to every row.

    ``vocabulary`` is the path of a tokenizers JSON file, read on the driver and
    broadcast (a vocabulary has a fixed size).  The count equals the length of
    the library's ids with add_special_tokens=False, without truncation or
    padding.  Null and empty texts count 0; repeated rows get equal counts; an
    empty table gives an empty one.  No row is dropped.  An input column named
    ``out`` is replaced, all others are kept.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())

    def make():
        counter = HeapCounter(spec.value)
        return lambda texts: [[counter.count(t) for t in texts]]

    return map_text(df, make, [T.StructField(out, T.LongType())], text_col)


def limits(counted: DataFrame, limit: int, text_col: str = "text", tokens: str = "n_tokens") -> DataFrame:
    """Add ``n_bytes`` of the text (UTF-8; null: 0) and ``over_limit`` (more tokens than ``limit``)."""
    return counted.withColumns({
        "n_bytes": F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long"),
        "over_limit": F.col(tokens) > F.lit(limit)})

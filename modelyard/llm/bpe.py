"""BPE encoding and decoding by tree concatenation.

A text is cut where the vocabulary's own pre-tokenizer cuts it.  A piece that
stays long and unsplit is halved again and again; the leaves are encoded in
one parallel batch, and two encoded halves are joined by re-encoding a window
around the join, doubled until its outer tokens agree with what stood there on
both sides.  Results equal the tokenizers library on the whole text.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_text

LEAF_CHARS = 2048
CACHE_WORDS = 300_000

# Characters for which the short path below gives what the library's
# normalizer gives (no composition, same white space, one-to-one lower case).
_PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa0-įĲ-ɏ‐-‧]")


class TreeBpe:
    """Encoder over one tokenizers JSON file with a word-end suffix BPE."""

    def __init__(self, spec: str, leaf_chars: int = LEAF_CHARS):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        conf = json.loads(spec)
        model = conf["model"]
        self.whole = Tokenizer.from_str(spec)
        self.whole.no_truncation()
        self.whole.no_padding()
        vocab = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # The same merges without the word-end mark, for pieces that go on.
        self.open_model = BPE(vocab=vocab, merges=merges)
        self.end_model = BPE(vocab=vocab, merges=merges,
                             end_of_word_suffix=model["end_of_word_suffix"])
        self.inner = Tokenizer(self.open_model)
        self.suffix = model["end_of_word_suffix"]
        self.names = {i: t for t, i in vocab.items()}
        specials = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.names.update({i: t for t, i in specials.items()})
        self.specials = specials
        self.special = re.compile("(" + "|".join(re.escape(s) for s in sorted(
            specials, key=len, reverse=True)) + ")") if specials else None
        split = next(p for p in conf["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.to_bytes = _byte_alphabet()
        self.leaf_chars = leaf_chars
        self.words = _Memo(self._word, CACHE_WORDS)
        self.chunks = _Memo(self._chunk, CACHE_WORDS)

    # -- one unsplit piece (already in the byte alphabet) -------------------
    def _ids(self, piece: str, last: bool) -> list[int]:
        return [t.id for t in (self.end_model if last else self.open_model).tokenize(piece)]

    def piece(self, piece: str) -> list[int]:
        """Ids of one piece; long pieces go through the tree."""
        if len(piece) <= self.leaf_chars:
            return self._ids(piece, True)
        n = 1
        while len(piece) / n > self.leaf_chars:
            n *= 2
        cuts = [len(piece) * i // n for i in range(n + 1)]
        parts = [piece[a:b] for a, b in zip(cuts, cuts[1:])]
        done = [e.ids for e in self.inner.encode_batch(parts[:-1])] + [self._ids(parts[-1], True)]
        while len(done) > 1:
            done = [self.join(done[i], done[i + 1], i + 2 == len(done))
                    for i in range(0, len(done), 2)]
        return done[0]

    def _chars(self, ids: list[int], last: bool) -> str:
        text = "".join(self.names[i] for i in ids)
        return text[: -len(self.suffix)] if last and text.endswith(self.suffix) else text

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """Ids of two neighbouring pieces, given the ids of each."""
        k = 4
        while True:
            a, b = left[max(0, len(left) - k):], right[:k]
            open_left, open_right = len(a) < len(left), len(b) < len(right)
            ends = last and not open_right
            mid = self._ids(self._chars(a, False) + self._chars(b, ends), ends)
            # Both sides agree when the outer tokens of the window are the ones
            # that stood there: what lies beyond was encoded next to the same
            # tokens, so it can't change.
            if ((not open_left or mid[:2] == a[:2]) and (not open_right or mid[-2:] == b[-2:])):
                return left[:len(left) - len(a)] + mid + right[len(b):]
            k *= 2

    # -- texts ---------------------------------------------------------------
    def _piece(self, piece: str) -> tuple[bytes, str]:
        ids = self.piece(piece)
        return (array("i", ids).tobytes(),
                " ".join(map(self.names.__getitem__, ids)))

    def _word(self, word: str) -> tuple[bytes, str]:
        return self._piece("".join(map(self.to_bytes.__getitem__, word.encode("utf-8"))))

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        """A run without white space; the splitter never crosses white space."""
        words = self.pattern.findall(chunk.lower())
        if len(words) == 1 and words[0] == chunk:
            # Kept as a chunk, so not as a word besides.
            return self.words.get(chunk) or self._word(chunk)
        got = [self.words[w] for w in words]
        return b"".join([g[0] for g in got]), " ".join([g[1] for g in got])

    def _plain_text(self, text: str, ids: list[bytes], shown: list[str]) -> None:
        if _PLAIN.search(text):
            # Rare characters: the library's own normalizer and splitter decide.
            text = self.whole.normalizer.normalize_str(text)
            got = [self._piece(w) for w, _ in self.whole.pre_tokenizer.pre_tokenize_str(text)]
        else:
            got = list(map(self.chunks.__getitem__, text.split()))
        ids += [g[0] for g in got]
        shown += [g[1] for g in got]

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """(ids as little int32 values, the decoded text); a null text is an empty one."""
        ids: list[bytes] = []
        shown: list[str] = []
        if text:
            if self.special is not None and "<|" in text:
                for part in self.special.split(text):
                    if part in self.specials:
                        ids.append(array("i", [self.specials[part]]).tobytes())
                        shown.append(part)
                    elif part:
                        self._plain_text(part, ids, shown)
            else:
                self._plain_text(text, ids, shown)
        return b"".join(ids), " ".join([s for s in shown if s])


class _Memo(dict):
    """Results by short key; emptied when full, so memory stays bounded."""

    def __init__(self, make, limit: int):
        self.make, self.limit = make, limit

    def __missing__(self, key: str):
        got = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[key] = got
        return got


def _byte_alphabet() -> list[str]:
    """One printable character for each byte: itself where printable, else 256 + n."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


def encode_decode(df: DataFrame, vocabulary: str, text_col: str = "text",
                  leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Add ``token_ids array<int>`` and ``decoded string`` to every row.

    ``vocabulary`` is the path of a tokenizers JSON file, read on the driver
    and broadcast (a vocabulary has a fixed size).  Null and empty texts get
    no ids and an empty string.  The ids equal the library's with
    add_special_tokens=False, the text its decode with skip_special_tokens=False.
    No row is dropped; repeated rows get equal results.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())

    def make():
        bpe = TreeBpe(spec.value, leaf_chars)

        def fn(texts):
            flat, offsets, shown = [], [0], []
            for t in texts:
                ids, text = bpe.encode(t)
                flat.append(ids)
                offsets.append(offsets[-1] + len(ids) // 4)
                shown.append(text)
            ids = np.frombuffer(b"".join(flat), dtype=np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(shown, pa.string())]
        return fn

    return map_text(df, make, [T.StructField("token_ids", T.ArrayType(T.IntegerType())),
                               T.StructField("decoded", T.StringType())], text_col)


def digests(encoded: DataFrame, *keep: str) -> DataFrame:
    """Token count and SHA-256 of the ids and of the decoded text."""
    return encoded.select(
        *keep, F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))

"""Secrets in texts: fixed patterns, and a token-efficiency test for random strings.

A vocabulary learned from ordinary text needs few tokens for words and many
for random strings.  A long run of key characters that a tiktoken vocabulary
can only write with few characters per token is reported as ``random``, unless
it is a known digest or identifier.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_text

# The patterns and least lengths of the base kinds, in the order
# in which ties at one start are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "random")

# A run that may hold a key: at least 20 key characters.
LEAST_KEY = 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# Its parts, between the separators of paths and of key alphabets.
PART = re.compile(r"[A-Za-z0-9+]+")
# Known digests and identifiers: MD5 to SHA-512 in hexadecimal (git's object
# ids among them), UUIDs, plain numbers.
KNOWN = re.compile(r"(?<![A-Za-z0-9+])(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}"
                   r"|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
                   r"|[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}|[0-9+]+)(?![A-Za-z0-9+])")
# Shorter steps of a path at the ends of a window say nothing by themselves.
LEAST_END = 4
CHARS_PER_TOKEN = 2.1

SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()),
                                 T.StructField("start", T.IntegerType()),
                                 T.StructField("end", T.IntegerType())]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
           if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _ends(run: str, parts: list[tuple[int, int]]) -> tuple[int, int]:
    """The ends of a window: without short steps of a path, with dashes of the key if it needs them."""
    first, last = 0, len(parts) - 1
    while first < last and parts[first][1] - parts[first][0] < LEAST_END and run[parts[first][1]] in "/=":
        first += 1
    while first < last and parts[last][1] - parts[last][0] < LEAST_END and run[parts[last][0] - 1] in "/=":
        last -= 1
    a, b = parts[first][0], parts[last][1]
    while b - a < LEAST_KEY and run[b:b + 1] in ("-", "_"):
        b += 1
    while b - a < LEAST_KEY and a and run[a - 1] in "-_":
        a -= 1
    return a, b


def key_windows(run: str, n_tokens, chars_per_token: float = CHARS_PER_TOKEN) -> list[tuple[int, int]]:
    """Windows ``[a, b)`` of a run that the vocabulary writes with few characters per token.

    The parts between ``/ = - _`` gain what their tokens say beyond their
    characters, so words lose and random strings gain; known digests and
    identifiers end a window.  The neighbouring parts with the largest gain are
    a window, then those left and right of it are searched in the same way.
    """
    out, stretches, at = [], [], 0
    for known in [*KNOWN.finditer(run), None]:
        end = known.start() if known else len(run)
        stretches.append([p.span() for p in PART.finditer(run, at, end)])
        at = known.end() if known else end
    while stretches:
        parts = stretches.pop()
        if not parts:
            continue
        gains = [chars_per_token * n_tokens(run[a:b]) - (b - a) for a, b in parts]
        best, first, last, total, begin = 0.0, 0, 0, 0.0, 0
        for i, gain in enumerate(gains):
            if total <= 0:
                total, begin = 0.0, i
            total += gain
            if total > best:
                best, first, last = total, begin, i + 1
        if not best:
            continue
        stretches += [parts[:first], parts[last:]]
        a, b = _ends(run, parts[first:last])
        if b - a >= LEAST_KEY and b - a < chars_per_token * n_tokens(run[a:b]):
            out.append((a, b))
    return sorted(out)


def random_spans(text: str, taken: list[tuple[int, int, int]], n_tokens,
                 chars_per_token: float = CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    """Windows of runs, outside the base spans, whose characters per token are few.

    No string is excused for its alphabet: rare words are told from keys by the
    ratio alone.
    """
    out = []
    for m in RUN.finditer(text):
        for a, b in key_windows(m.group(), n_tokens, chars_per_token):
            a, b = m.start() + a, m.start() + b
            if not any(s < b and a < e for s, _, e in taken):
                out.append((a, 3, b))
    return out


def find_secrets(df: DataFrame, ranks: str, pattern: str, text_col: str = "text",
                 chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """Add ``secret_spans`` (kind, start, end in code points, end exclusive).

    ``ranks`` is the path of a tiktoken rank file, read on the driver and
    broadcast; ``pattern`` its split pattern.  Null and empty texts get an
    empty list.  Spans are ordered by start, then kind.
    """
    with open(ranks, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def make():
        import base64

        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

        def n_tokens(run):
            return len(enc.encode_ordinary(run))

        def fn(texts):
            out = []
            for t in texts:
                t = t or ""
                spans = base_spans(t)
                spans = sorted(spans + random_spans(t, spans, n_tokens, chars_per_token))
                out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
            return [out]
        return fn

    return map_text(df, make, [T.StructField("secret_spans", SPAN)], text_col)


def report(found: DataFrame, *keep: str) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, all spans as text."""
    def joined(kinds):
        part = F.filter("secret_spans", lambda s: s["kind"].isin(*kinds))
        return F.array_join(F.transform(part, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(*keep, *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(joined(KINDS[:3]), 256).alias("base_sha256"),
                        joined(KINDS).alias("spans"), count("random").alias("n_random"))

"""Stable 32-bit ids of the words of a text, looked up run by run."""

from __future__ import annotations

import re
import sys
import zlib

import numpy as np

# Letters, digits, or a run of other marks.
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
WORD = re.compile(r"[^\W_]+")


class TokenIds:
    """crc32 of every token, in order; memory is bounded by ``limit`` runs."""

    def __init__(self, lower: bool = False, pattern: re.Pattern = TOKEN, limit: int = 300_000):
        self.lower, self.pattern, self.limit = lower, pattern, limit
        self.known: dict[str, bytes] = {}

    def _run(self, run: str) -> bytes:
        text = run.lower() if self.lower else run
        got = b"".join([zlib.crc32(t.encode("utf-8", "replace")).to_bytes(4, sys.byteorder)
                        for t in self.pattern.findall(text)])
        if len(run) <= 64:
            if len(self.known) >= self.limit:
                self.known.clear()
            self.known[run] = got
        return got

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        runs = text.split()
        parts = list(map(self.known.get, runs))
        if None in parts:
            make = self._run
            parts = [make(run) if got is None else got for run, got in zip(runs, parts)]
        return np.frombuffer(b"".join(parts), dtype=np.uint32)

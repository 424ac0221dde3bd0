"""Random strings in paths, and random strings without a digit."""

import string

import numpy as np

from modelyard.llm import secrets
from modelyard.session import ship_package

from ..conftest import spark  # noqa: F401

PATH = "example/services/account/settings/documents/download/"


def test_keys_in_paths_and_without_digits(spark):  # noqa: F811
    import public_tokenizers as P
    ship_package(spark)
    rng = np.random.default_rng(6)
    rows = []
    for i in range(100):
        key = "".join(rng.choice(list(string.ascii_letters + string.digits), 24))
        letters = "".join(rng.choice(list(string.ascii_letters), 32))
        rows += [("path", f"see {PATH}{key} there", 4 + len(PATH), 24), ("letters", f"see {letters} there", 4, 32),
                 ("words", f"see {PATH}example there", 0, 0)]
    docs = spark.createDataFrame(rows, "kind string, text string, at long, n long")
    found = {"path": 0, "letters": 0, "words": 0}
    for r in secrets.find_secrets(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect():
        spans = [(s["kind"], s["start"], s["end"]) for s in r["secret_spans"]]
        found[r["kind"]] += spans == ([] if r["kind"] == "words" else [("random", r["at"], r["at"] + r["n"])])
    assert found["words"] == 100 and found["path"] >= 95 and found["letters"] >= 95


def tokenizer():
    import base64

    import public_tokenizers as P
    import tiktoken
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("ranks", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda s: len(enc.encode_ordinary(s))


def test_random_keys_of_every_alphabet_are_found_and_words_are_not():
    n_tokens = tokenizer()
    rng = np.random.default_rng(8)
    alphabets = {"lower": string.ascii_lowercase, "mixed": string.ascii_letters,
                 "alnum": string.ascii_letters + string.digits, "url": string.ascii_letters + string.digits + "-_"}
    for name, letters in alphabets.items():
        for size in (20, 24, 32, 64):
            hits = 0
            for _ in range(200):
                key = "".join(rng.choice(list(letters), size))
                text = f"see {PATH}{key} there" if name != "url" else f"key {key} there"
                got = secrets.random_spans(text, [], n_tokens)
                a = text.index(key)
                # At most a short part at either end of the key may be missing.
                hits += any(s <= a + 5 and e >= a + size - 5 and s >= a - 1 for s, _, e in got)
            # Twenty small letters are the hardest: a few of them spell long tokens.
            assert hits >= (180 if (name, size) == ("lower", 20) else 190), (name, size, hits)
    words = ("international responsibilities characterization straightforwardness documentation/configuration "
             "uncharacteristically counterrevolutionary_movements example-service-account-settings "
             "internationalization electroencephalography").split() * 20
    assert sum(bool(secrets.random_spans(w, [], n_tokens)) for w in words) <= len(words) * 0.01


def test_key_with_a_dash_after_a_path():
    n_tokens = tokenizer()
    rng = np.random.default_rng(9)
    letters = list(string.ascii_letters + string.digits)
    hits = 0
    for _ in range(200):
        key = "".join(rng.choice(letters, 13)) + "-" + "".join(rng.choice(letters, 14))
        hits += secrets.key_windows(PATH + key, n_tokens) == [(len(PATH), len(PATH) + 28)]
    assert hits >= 190


def windows_brute(run, n_tokens, limit=secrets.CHARS_PER_TOKEN):
    """Every range of neighbouring parts, the one with the largest gain first."""
    import re
    marks = [m.span() for m in secrets.KNOWN.finditer(run)]
    parts = [m.span() for m in re.finditer("[A-Za-z0-9+]+", run)]

    def search(parts):
        if not parts:
            return []
        ranges = [(i, j) for i in range(len(parts)) for j in range(i + 1, len(parts) + 1)]
        def gain(r):
            return sum(limit * n_tokens(run[a:b]) - (b - a) for a, b in parts[r[0]:r[1]])
        i, j = max(ranges, key=lambda r: (round(gain(r), 9), -r[0], -r[1]))
        if gain((i, j)) <= 0:
            return []
        inner = [p for p in parts[i:j]]
        while len(inner) > 1 and inner[0][1] - inner[0][0] < 4 and run[inner[0][1]] in "/=":
            inner.pop(0)
        while len(inner) > 1 and inner[-1][1] - inner[-1][0] < 4 and run[inner[-1][0] - 1] in "/=":
            inner.pop()
        a, b = inner[0][0], inner[-1][1]
        while b - a < 20 and run[b:b + 1] in ("-", "_"):
            b += 1
        while b - a < 20 and a > 0 and run[a - 1] in ("-", "_"):
            a -= 1
        mine = [(a, b)] if b - a >= 20 and b - a < limit * n_tokens(run[a:b]) else []
        return search(parts[:i]) + mine + search(parts[j:])

    groups, at = [], 0
    for a, b in [*marks, (len(run), len(run))]:
        groups.append([p for p in parts if at <= p[0] and p[1] <= a])
        at = b
    return sorted(w for g in groups for w in search(g))


def test_windows_and_base_spans_equal_brute_force():
    n_tokens = tokenizer()
    rng = np.random.default_rng(10)
    pieces = ["example", "services", "api", "v1", "0f" * 16, "0F" * 20, "123e4567-e89b-12d3-a456-426614174000", "42"]
    for _ in range(300):
        run = ""
        for _ in range(rng.integers(1, 8)):
            key = "".join(rng.choice(list(string.ascii_letters + string.digits), rng.integers(3, 40)))
            run += str(rng.choice(pieces + [key, key])) + str(rng.choice(list("/=-_")))
        assert secrets.key_windows(run, n_tokens) == windows_brute(run, n_tokens), run


def base_brute(text):
    """The base kinds, character by character."""
    out = []
    key = set(string.ascii_letters + string.digits + "+/_.=-")
    i = 0
    while i < len(text):
        for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if text[i:i + len(name)].lower() == name and text[i:i + len(name)].isascii():
                j = i + len(name)
                j += text[j:j + 1] in ("'", '"') and text[j:j + 1] != ""
                while text[j:j + 1] == " ":
                    j += 1
                if text[j:j + 1] in (":", "=") and text[j:j + 1]:
                    j += 1
                    while text[j:j + 1] == " ":
                        j += 1
                    j += text[j:j + 1] in ("'", '"') and text[j:j + 1] != ""
                    k = j
                    while k < len(text) and text[k] in key:
                        k += 1
                    if k > j:
                        if k - j >= 8:
                            out.append((i, 0, k))
                        i = k - 1
                        break
        i += 1
    for kind, start, letters, least in ((1, "AKIA", set(string.ascii_uppercase + string.digits), 16),
                                        (2, "", set("0123456789abcdef"), 32)):
        i = 0
        while i < len(text):
            if text.startswith(start, i):
                j = i + len(start)
                while j < len(text) and text[j] in letters:
                    j += 1
                if j > i + len(start):
                    if j - i >= least:
                        out.append((i, kind, j))
                    i = j
                    continue
            i += 1
    return sorted(out)


def test_base_spans_equal_brute_force():
    rng = np.random.default_rng(11)
    bits = ["password", "PASSWD", "Secret", "token", "api_key", "apikey", "=", ":", " ", "'", '"', "abc", "AKIA",
            "ABCDEFGHIJKL9", "0123456789abcdef", "é", "\n", "x" * 8, "-._/+="]
    for _ in range(500):
        text = "".join(rng.choice(bits, rng.integers(1, 25)))
        assert secrets.base_spans(text) == base_brute(text), text

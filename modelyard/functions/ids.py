"""Deterministic row hashing, ids and artifact paths.

The key hash is the basis of every repeatable split: it depends only on the
row's key values and a seed, never on partitioning or row order, so it needs
no shuffle and gives the same answer on any cluster layout and in DuckDB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F



def _cols(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def key_md5(keys: Sequence[str | Column], seed: int | str | None = None) -> Column:
    """md5 hex of ``seed|k1|k2|...`` (nulls skipped, as ``concat_ws`` does)."""
    parts = ([F.lit(str(seed))] if seed is not None else []) + [
        c.cast("string") for c in _cols(keys)]
    return F.md5(F.concat_ws("|", *parts))


def key_md5_sql(keys: Sequence[str], seed: int | str | None = None) -> str:
    parts = ([f"'{seed}'"] if seed is not None else []) + [
        f"CAST({k} AS VARCHAR)" for k in keys]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


# The integer key hash.  MOD is the prime 2^31 - 1; M1 and M2
# are the odd multipliers of its two mixing rounds.
MOD = 2_147_483_647
SPAN = 1 << 31
M1 = 1_597_334_677
M2 = 1_013_904_223


def _seed_ints(seed: int | str | None, n: int) -> list[int]:
    """``n`` constants in [1, MOD) derived from the seed (fixed at plan time)."""
    out = []
    for i in range(n):
        d = hashlib.md5(f"{seed}|{i}".encode()).hexdigest()
        out.append(int(d[:12], 16) % (MOD - 1) + 1)
    return out


def key_hash(keys: Sequence[str | Column], seed: int | str | None = None,
             numeric: bool = True) -> Column:
    """Seeded hash of the row key, a bigint uniform on [0, 2^31).

    ``numeric=True`` (all keys integral): a seeded linear combination of the
    keys modulo 2^31 - 1, then two xor-shift / multiply rounds.  Every
    product stays below 2^62, so there is no overflow under ANSI mode, and
    the cost is a few integer operations per row -- no string is built.
    ``numeric=False``: the top 31 bits of ``md5(seed|k1|k2|...)``.
    DuckDB computes the same values from :func:`key_hash_sql`.
    """
    if not numeric:
        top = F.conv(F.substring(key_md5(keys, seed), 1, 8), 16, 10).cast("bigint")
        return F.shiftright(top, 1)
    c = _seed_ints(seed, len(keys) + 1)
    mod = F.lit(MOD)
    h = F.lit(c[0]).cast("bigint")
    for k, a in zip(_cols(keys), c[1:]):
        h = F.pmod(h + F.pmod(k.cast("bigint"), mod) * F.lit(a), mod)
    h = F.pmod(h.bitwiseXOR(F.shiftright(h, 15)) * F.lit(M1), mod)
    h = F.pmod(h.bitwiseXOR(F.shiftright(h, 13)) * F.lit(M2), mod)
    return h.bitwiseXOR(F.shiftright(h, 16))


def key_hash_sql(keys: Sequence[str], seed: int | str | None = None, numeric: bool = True) -> str:
    """DuckDB text of :func:`key_hash`."""
    if not numeric:
        return f"(('0x' || substr({key_md5_sql(keys, seed)}, 1, 8))::BIGINT >> 1)"
    c = _seed_ints(seed, len(keys) + 1)

    def pmod(x: str) -> str:
        return f"((({x}) % {MOD} + {MOD}) % {MOD})"
    h = f"CAST({c[0]} AS BIGINT)"
    for k, a in zip(keys, c[1:]):
        h = pmod(f"{h} + {pmod(f'CAST({k} AS BIGINT)')} * {a}")
    h = pmod(f"xor({h}, ({h}) >> 15) * {M1}")
    h = pmod(f"xor({h}, ({h}) >> 13) * {M2}")
    return f"xor({h}, ({h}) >> 16)"


def threshold(frac: float) -> int:
    """Integer threshold T with ``hash < T`` for a ``frac`` share of keys."""
    return max(0, min(SPAN, int(frac * SPAN)))


def hash_below(keys: Sequence[str | Column], seed: int | str | None, frac: float,
               numeric: bool = True) -> Column:
    """True for a ``frac`` share of keys, chosen by hash (repeatable, no shuffle)."""
    return key_hash(keys, seed, numeric) < F.lit(threshold(frac))


def hash_below_sql(keys: Sequence[str], seed: int | str | None, frac: float,
                   numeric: bool = True) -> str:
    return f"({key_hash_sql(keys, seed, numeric)} < {threshold(frac)})"


def hash_bucket_of(h: Column, fractions: Sequence[float]) -> Column:
    """Index of the first cumulative fraction the hash falls below."""
    expr = F.lit(len(fractions))
    for i, f in reversed(list(enumerate(fractions))):
        expr = F.when(h < F.lit(threshold(f)), F.lit(i)).otherwise(expr)
    return expr.cast("int")


def hash_bucket_of_sql(h: str, fractions: Sequence[float]) -> str:
    whens = " ".join(f"WHEN {h} < {threshold(f)} THEN {i}" for i, f in enumerate(fractions))
    return f"CAST(CASE {whens} ELSE {len(fractions)} END AS INTEGER)"


def numeric_keys(df, keys: Sequence[str]) -> bool:
    """True when every key column is integral (the fast integer hash applies)."""
    from pyspark.sql.types import IntegralType
    return all(isinstance(df.schema[k].dataType, IntegralType) for k in keys)


def stable_id(keys: Sequence[str | Column], prefix: str | None = None) -> Column:
    """Repeatable id: md5 of the keys (``uuid4`` is the random mode)."""
    return key_md5(keys, prefix)


def random_id() -> Column:
    """A random UUID per row, like ``str(uuid.uuid4())``; not repeatable."""
    return F.expr("uuid()")


def artifact_path(root: str | Column, *parts: str | Column) -> Column:
    """``root/experiment_id/model_id``."""
    r = F.lit(root) if isinstance(root, str) else root
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("/", r, *[c.cast("string") for c in cols])

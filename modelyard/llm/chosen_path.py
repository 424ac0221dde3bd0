"""N-gram Jaccard join by chosen paths.

Every text is a set of five-word shingles.  In each run a set descends a tree:
a node draws a random order of all shingles, and at times a second one (1 /
similarity on average), and a set goes to the child named by its first shingle
in that order.  Sets that share the sampled shingle go on together, so a pair
of the wanted similarity keeps meeting while unlike sets part.  The orders are
drawn anew by every node of every run, so runs are independent.

At a node all sets are compared with one of them, the lead, on their whole
shingle sets.  A node whose sets are all linked to the lead is done; of another
one the lead is done and leaves.  What remains is compared by brute force if it
is little work, else the node is split again.  Runs are repeated until a pair
at the threshold is met with the target recall at the depth that was reached.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_groups, map_text
from .graph import components, written
from .keys import row_key
from .tokens import WORD, TokenIds

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
DEPTH = 3                 # levels a set descends at once
SMALL_NODE = 2048         # a node is small when it needs the square of this many comparisons
STAR = 1024               # sets one task compares with a lead
CHUNK = 2048              # sets of a group that one task compares with as many
SMALL_KEYS = 2_000_000    # rows (two longs each) that may be broadcast: 32 MB

_MASK = (1 << 64) - 1
_M1, _M2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def shingles(ids: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of all runs of ``words`` words, ascending.

    A text with fewer words, but not none, is one shingle.
    """
    n = min(words, len(ids))
    if not n:
        return np.empty(0, np.uint64)
    a = ids.astype(np.uint64)
    h = np.full(len(ids) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ a[i:len(ids) - n + 1 + i]) * np.uint64(_M1)
        h ^= h >> np.uint64(29)
    return np.unique(h)


# -- the tree ------------------------------------------------------------------
def _draw(nodes: np.ndarray, salt) -> np.ndarray:
    """64 random bits that belong to each node."""
    h = (nodes ^ np.asarray(salt, np.uint64)) * np.uint64(_M1)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(_M2)
    return h ^ (h >> np.uint64(29))


def _first(s: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """The first shingle of the set under each order, as its place in the order."""
    out = np.full(len(orders), _MASK, np.uint64)
    for i in range(0, len(s), 4096):
        h = (s[None, i:i + 4096] ^ orders[:, None]) * np.uint64(_M2)
        h ^= h >> np.uint64(32)
        h *= np.uint64(_M1)
        out = np.minimum(out, h.min(axis=1))
    return out


def paths(s: np.ndarray, nodes: np.ndarray, depth: int, similarity: float) -> np.ndarray:
    """Names of the nodes ``depth`` levels below ``nodes`` that the set ``s`` reaches.

    Every node sends the set to one child, and some (1 / similarity - 1) to a second.
    """
    more = np.uint64((1 / similarity - 1) * 2 ** 64)
    for _ in range(depth):
        orders = np.concatenate([_draw(nodes, 1), _draw(nodes[_draw(nodes, 3) < more], 2)])
        nodes = _draw(orders, _first(s, orders))
    return np.unique(nodes).view(np.int64)


def _roots(first: int, runs: int) -> np.ndarray:
    return _draw(np.arange(first, first + runs, dtype=np.uint64), 5)


def runs_for(recall: float, similarity: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold is met with ``recall`` at ``depth``.

    A node passes a set to one child and, with probability 1 / similarity - 1,
    to a second, so a branch loses the pair with probability
    q = (1 - J + J q')(1 - e J + e J q').
    """
    more, q = 1 / similarity - 1, 0.0
    for _ in range(depth):
        keep = similarity * (1 - q)
        q = (1 - keep) * (1 - more * keep)
    return max(1, math.ceil(math.log(1 - recall) / math.log(q)))


# -- sets ----------------------------------------------------------------------
def _sets(docs: DataFrame, text_col: str, doc_id: str, similarity: float, runs: int) -> DataFrame:
    """(mk_id, mk_a, mk_b, s1, s2, n, paths): the set of every row, s1 s2 its name."""
    roots = _roots(0, runs)

    def make():
        tokens = TokenIds(lower=True, pattern=WORD)

        def fn(texts):
            s1, s2, n, keys = [], [], [], []
            for t in texts:
                s = shingles(tokens(t))
                n.append(len(s))
                wide = s * np.uint64(_M1)
                wide ^= wide >> np.uint64(31)
                name = [(wide * np.uint64(k)).sum(dtype=np.uint64) if len(s) else np.uint64(0)
                        for k in (_M2, 0xC2B2AE3D27D4EB4F)]
                square = (wide * wide).sum(dtype=np.uint64) if len(s) else np.uint64(0)
                s1.append(int(name[0].astype(np.int64)))
                s2.append(int((name[1] ^ square).astype(np.int64)))
                keys.append(paths(s, roots, DEPTH, similarity) if len(s) else [])
            return [s1, s2, n, keys]
        return fn

    a, b = row_key(doc_id, text_col)
    rows = docs.select(F.col(doc_id).alias("mk_id"), a.alias("mk_a"), b.alias("mk_b"),
                       F.col(text_col).alias("mk_text"))
    return map_text(rows, make, [T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()),
                                 T.StructField("n", T.IntegerType()),
                                 T.StructField("paths", T.ArrayType(T.LongType()))], "mk_text").drop("mk_text")


def _grams_of(docs: DataFrame, members: DataFrame, text_col: str, doc_id: str) -> DataFrame:
    """(set, grams) for the sets in ``members (set, mk_a, mk_b)``; one text each."""
    wanted = members.select(F.col("mk_a").alias("mk_wa"), F.col("mk_b").alias("mk_wb"), "set")
    if wanted.limit(SMALL_KEYS + 1).count() <= SMALL_KEYS:
        wanted = F.broadcast(wanted)
    a, b = row_key(doc_id, text_col)
    rows = docs.select(a.alias("mk_wa"), b.alias("mk_wb"), F.col(text_col).alias("mk_text"))

    def make():
        tokens = TokenIds(lower=True, pattern=WORD)

        def fn(texts):
            return [[shingles(tokens(t)).tobytes() for t in texts]]
        return fn

    out = map_text(rows.join(wanted, ["mk_wa", "mk_wb"]), make,
                   [T.StructField("grams", T.BinaryType())], "mk_text")
    return out.select("set", "grams").dropDuplicates(["set"])


def _alike(both, total, similarity: float):
    """Whether ``both`` shared of ``total`` shingles, counted twice, make the similarity."""
    return both * (1 + similarity) >= similarity * total - 1e-9


def _shared_with_lead(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """(lead, set, both, n_set, n_lead): shingles that sets share with their lead.

    A lead's sets are dealt to tasks of about ``STAR``; each has the lead's
    shingles once, before those of its sets, and holds one set at a time.
    """
    size = pairs.groupBy("lead").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
    members = (pairs.join(size, "lead")
               .select("lead", "set", F.pmod(F.xxhash64("set"), F.col("parts")).cast("int").alias("part"))
               .join(grams, "set").select("lead", "part", F.lit(1).alias("rank"), "set", "grams"))
    leads = (size.select("lead", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
             .join(grams.withColumnRenamed("set", "lead"), "lead")
             .select("lead", "part", F.lit(0).alias("rank"), F.col("lead").alias("set"), "grams"))
    rows = (members.unionByName(leads).repartition("lead", "part").sortWithinPartitions("lead", "part", "rank")
            .select(F.col("lead.s1").alias("l1"), F.col("lead.s2").alias("l2"), "rank",
                    F.col("set.s1").alias("s1"), F.col("set.s2").alias("s2"), "grams"))

    def run(batches):
        lead = np.empty(0, np.uint64)
        for b in batches:
            ranks = b.column("rank").to_pylist()
            both, n_set, n_lead, at = [], [], [], []
            for i, rank in enumerate(ranks):
                s = np.frombuffer(b.column("grams")[i].as_buffer(), np.uint64)
                if not rank:
                    lead = s.copy()
                    continue
                place = np.minimum(np.searchsorted(lead, s), len(lead) - 1)
                both.append(int((lead[place] == s).sum()))
                n_set.append(len(s))
                n_lead.append(len(lead))
                at.append(i)
            if at:
                kept = b.select(["l1", "l2", "s1", "s2"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, *[pa.array(x, pa.int32()) for x in (both, n_set, n_lead)]],
                    names=["l1", "l2", "s1", "s2", "both", "n_set", "n_lead"])

    out = rows.mapInArrow(run, "l1 long, l2 long, s1 long, s2 long, both int, n_set int, n_lead int")
    return out.select(F.struct(F.col("l1").alias("s1"), F.col("l2").alias("s2")).alias("lead"),
                      F.struct("s1", "s2").alias("set"), "both", "n_set", "n_lead")


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of ``left`` with ``right``, blocks of shingles at a time."""
    rows = left + right
    flat, col, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(rows)), [len(s) for s in rows])
    # Only shingles that two sets have can add to an intersection.
    twice = np.flatnonzero(times >= 2)
    number = np.full(len(flat), -1)
    number[twice] = np.arange(len(twice))
    col = number[col]
    row, col = row[col >= 0], col[col >= 0]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for c in range(0, len(twice), 1024):
        lo, hi = np.searchsorted(col, [c, c + 1024])
        m = np.zeros((len(rows), 1024), np.float32)
        m[row[lo:hi], col[lo:hi] - c] = 1
        out += m[:len(left)] @ m[len(left):].T
    return out


def _read(blobs) -> list[np.ndarray]:
    return [np.frombuffer(g, np.uint64) for g in blobs]


_PAIR = "a1 long, a2 long, b1 long, b2 long"


def _brute_force(nodes: DataFrame, similarity: float) -> DataFrame:
    """Links that connect what any link of a node's ``loose`` sets with its sets connects.

    The other sets of a node hang together through its lead.  A link inside what
    is connected already is not returned, so a node gives fewer links than it
    has sets.
    """
    def pairs(pdf):
        grams = _read(pdf["grams"])
        loose = pdf["loose"].to_numpy()
        sizes = np.array([len(g) for g in grams])
        part = np.where(loose, np.arange(len(loose)), -1)
        i, j = [], []
        at = loose.nonzero()[0]
        for a in range(0, len(at), 256):
            mine = at[a:a + 256]
            both = _intersections([grams[k] for k in mine], grams)
            for x, ok in zip(mine, _alike(both, sizes[mine][:, None] + sizes[None, :], similarity)):
                met, first = np.unique(part[ok], return_index=True)
                other = np.flatnonzero(ok)[first][met != part[x]]
                i += [x] * len(other)
                j += other.tolist()
                part[np.isin(part, met)] = part[x]
        i, j = np.array(i, np.int64), np.array(j, np.int64)
        s1, s2 = pdf["s1"].to_numpy(), pdf["s2"].to_numpy()
        return pd.DataFrame({"a1": s1[i], "a2": s2[i], "b1": s1[j], "b2": s2[j]})

    return _as_links(map_groups(nodes, ["key"], pairs, _PAIR)).distinct()


def _as_links(rows: DataFrame) -> DataFrame:
    a, b = F.struct(F.col("a1").alias("s1"), F.col("a2").alias("s2")), F.struct(
        F.col("b1").alias("s1"), F.col("b2").alias("s2"))
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def _descend(front: DataFrame, grams: DataFrame, similarity: float, depth: int) -> DataFrame:
    """(set, n, key) ``depth`` levels below the nodes of ``front (set, n, nodes array<long>)``."""
    rows = front.join(grams, "set").select(F.col("set.s1").alias("s1"), F.col("set.s2").alias("s2"),
                                           "n", "nodes", "grams")

    def run(batches):
        for b in batches:
            keys = [paths(np.frombuffer(g, np.uint64), np.array(nodes, np.int64).view(np.uint64), depth, similarity)
                    for g, nodes in zip(b.column("grams").to_pylist(), b.column("nodes").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("s1"), b.column("s2"), b.column("n"), pa.array(keys, pa.list_(pa.int64()))],
                names=["s1", "s2", "n", "keys"])

    out = rows.mapInArrow(run, "s1 long, s2 long, n int, keys array<long>")
    return out.select(F.struct("s1", "s2").alias("set"), "n", F.explode("keys").alias("key"))


def _live(keyed: DataFrame) -> DataFrame:
    """Members of the nodes that hold two sets or more, with the node's size and lead.

    Of nodes with the same members, as the runs make them again and again, one is kept.
    """
    nodes = keyed.groupBy("key").agg(
        F.count("*").alias("size"), F.min(F.struct("set", "n")).alias("lead"),
        F.bit_xor(F.xxhash64("set")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), "set")).alias("x2"))
    one = nodes.where("size > 1").groupBy("size", "lead", "x1", "x2").agg(F.min("key").alias("key"))
    return keyed.join(one.select("key", "size", F.col("lead.set").alias("lead"), F.col("lead.n").alias("lead_n")),
                      "key")


def _explore(keyed: DataFrame, grams: DataFrame, similarity: float, links: DataFrame | None, live: DataFrame | None = None):
    """Follow nodes down until none is left: (links, front sets or None, levels below the first).

    ``links`` are pairs (a, b) of set names whose whole sets are similar enough.
    """
    level, fronts = 0, None
    while True:
        if live is None:
            live = written(_live(keyed), "path-nodes")
        star = (live.where("set <> lead").where(F.least("n", "lead_n") >= similarity * F.greatest("n", "lead_n"))
                .select("lead", "set").distinct())
        found = written(_shared_with_lead(star, grams).where(
            _alike(F.col("both"), F.col("n_set") + F.col("n_lead"), similarity)).select("lead", "set"), "path-star")
        pairs = found.select(F.least("lead", "set").alias("a"), F.greatest("lead", "set").alias("b"))
        links = pairs if links is None else links.unionByName(pairs)
        tied = found.select(F.col("lead").alias("f_lead"), F.col("set").alias("f_set"), F.lit(True).alias("tied"))
        flagged = (live.where("set <> lead").where("size > 2")
                   .join(tied, (F.col("lead") == F.col("f_lead")) & (F.col("set") == F.col("f_set")), "left")
                   .select("key", "set", "n", "size", F.col("tied").isNull().alias("loose")))
        open_ = flagged.groupBy("key").agg(F.count_if("loose").alias("n_loose")).where("n_loose > 0")
        rest = written(flagged.join(open_, "key"), "path-open")
        if rest.isEmpty():
            return links, fronts, level
        few = (F.col("n_loose") * F.col("size") <= SMALL_NODE ** 2) & (F.col("size") <= 8 * SMALL_NODE)
        small = rest.where(few).join(grams, "set").select(
            "key", F.col("set.s1").alias("s1"), F.col("set.s2").alias("s2"), "loose", "grams")
        links = links.unionByName(written(_brute_force(small, similarity), "path-brute"))
        large = rest.where(~few)
        if large.isEmpty():
            return links, fronts, level
        sets = large.select("set", "n").distinct()
        fronts = sets if fronts is None else fronts.unionByName(sets)
        nodes = large.groupBy("set", "n").agg(F.collect_list("key").alias("nodes"))
        keyed, live = written(_descend(nodes, grams, similarity, 1), "path-keys"), None
        level += 1


def links_of(docs: DataFrame, sets: DataFrame, text_col: str, doc_id: str,
             similarity: float, recall: float, runs: int) -> tuple[DataFrame, DataFrame]:
    """(links, grams): the verified links that were met, and the shingles of
    every set that met another one.

    Sets that went below the depth the first runs were reckoned for get more
    runs from the root, until those reckoned for the depth reached are done.
    """
    live = written(_live(sets.select("set", "n", F.explode("paths").alias("key"))), "path-nodes")
    met = live.select("set").distinct()
    members = written(met.join(sets, "set").select("set", "mk_a", "mk_b"), "path-members")
    grams = written(_grams_of(docs, members, text_col, doc_id), "path-grams")
    links, fronts, deep = _explore(live, grams, similarity, None, live)
    while fronts is not None:
        more = runs_for(recall, similarity, DEPTH + deep) - runs
        if more <= 0:
            break
        again = fronts.distinct().withColumn("nodes", F.array(*[
            F.lit(int(r)) for r in _roots(runs, more).view(np.int64)]))
        keyed = written(_descend(again, grams, similarity, DEPTH), "path-keys")
        links, fronts, reached = _explore(keyed, grams, similarity, links)
        deep, runs = max(deep, reached), runs + more
    return written(links.distinct(), "path-links"), grams


# -- links of every document ---------------------------------------------------
def _link_counts(grams: DataFrame, labels: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(set, n_other): documents of other sets in the group that are linked to a set.

    With m shingles of the group's root missing and e others, two sets are
    linked for sure if their m + similarity * e add up to at most (1 - similarity)
    of the root's shingles.  Sets with at most half of that are near: they are
    all linked to each other, and only their documents are summed.  The others
    are far; each is compared with every set of its group, in chunks, so that no
    task holds a large group.
    """
    others = labels.where("node <> root").select(F.col("root").alias("lead"), F.col("node").alias("set"))
    with_root = _shared_with_lead(others, grams)
    missing, extra = F.col("n_lead") - F.col("both"), F.col("n_set") - F.col("both")
    spread = 2 * (missing + similarity * extra) <= (1 - similarity) * F.col("n_lead") + 1e-9
    seen = with_root.select(F.col("lead").alias("root"), "set", spread.alias("near"))
    roots = labels.where("node = root").select("root", F.col("node").alias("set"), F.lit(True).alias("near"))
    rows = written(seen.unionByName(roots).join(sets.select("set", "docs"), "set"), "path-group")
    groups = rows.groupBy("root").agg(
        F.count("*").alias("size"), F.sum(F.when(F.col("near"), F.col("docs")).otherwise(0)).alias("near_docs"),
        F.count_if(~F.col("near")).alias("n_far"))
    near = (rows.where("near").join(groups, "root")
            .select("set", (F.col("near_docs") - F.col("docs")).alias("n_other")))
    mixed = groups.where("n_far > 0").withColumns({
        "far_chunks": F.ceil(F.col("n_far") / CHUNK).cast("int"), "chunks": F.ceil(F.col("size") / CHUNK).cast("int")})
    full = rows.join(mixed, "root").join(grams, "set")
    h = F.xxhash64("set")
    far = full.where(~F.col("near")).withColumns({
        "i": F.pmod(h, "far_chunks").cast("int"), "j": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)),
        "far": F.lit(True)})
    every = full.withColumns({
        "j": F.pmod(h, "chunks").cast("int"), "i": F.explode(F.sequence(F.lit(0), F.col("far_chunks") - 1)),
        "far": F.lit(False)})
    cells = far.unionByName(every).select(
        F.col("root.s1").alias("r1"), F.col("root.s2").alias("r2"), "i", "j", "far",
        F.col("set.s1").alias("s1"), F.col("set.s2").alias("s2"), "near", "docs", "grams")

    def count(pdf):
        x, y = pdf[pdf["far"]], pdf[~pdf["far"]]
        if not len(x) or not len(y):
            return pd.DataFrame({"s1": [], "s2": [], "n_other": []}).astype("int64")
        gx, gy = _read(x["grams"]), _read(y["grams"])
        sizes = np.array([len(g) for g in gy])
        back = np.zeros(len(y), np.int64)
        ahead = []
        names = y[["s1", "s2"]].to_numpy()
        mine = x[["s1", "s2"]].to_numpy()
        docs, far_docs = y["docs"].to_numpy(), x["docs"].to_numpy()
        for a in range(0, len(x), 256):
            both = _intersections(gx[a:a + 256], gy)
            total = np.array([len(g) for g in gx[a:a + 256]])[:, None] + sizes[None, :]
            ok = _alike(both, total, similarity)
            ok &= (mine[a:a + 256, None, :] != names[None, :, :]).any(axis=2)
            ahead.append(ok @ docs)
            back += far_docs[a:a + 256] @ ok
        keep = y["near"].to_numpy()
        return pd.concat([pd.DataFrame({"s1": x["s1"], "s2": x["s2"], "n_other": np.concatenate(ahead)}),
                          pd.DataFrame({"s1": y["s1"][keep], "s2": y["s2"][keep], "n_other": back[keep]})])

    exact = (map_groups(cells, ["r1", "r2", "i", "j"], count, "s1 long, s2 long, n_other long")
             .select(F.struct("s1", "s2").alias("set"), "n_other"))
    return near.unionByName(exact).groupBy("set").agg(F.sum("n_other").alias("n_other"))


def jaccard_classes(docs: DataFrame, text_col: str = "text", doc_id: str = "doc_id",
                    similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per input row: doc_id, its row key, ``class_id``, ``n_links``, ``is_first``.

    ``class_id`` is the least id of the connected group under Jaccard
    similarity of five-word shingles (words: runs of letters and digits, lower
    case); ``n_links`` counts the other rows directly linked to it, equal
    texts included; ``is_first`` marks the row of the group with the least
    (id, row key), null ids first.  Texts without words, and null texts, are
    classes of their own without links.  Rows equal in id and text have the
    same key and the same ``is_first``.
    """
    runs = runs_for(recall, similarity)
    rows = written(_sets(docs, text_col, doc_id, similarity, runs)
                   .withColumn("set", F.struct("s1", "s2")).drop("s1", "s2"), "path-rows")
    place = F.struct(F.col("mk_id").isNotNull().alias("known"), "mk_id", "mk_a", "mk_b")
    full = rows.where("n > 0")
    sets = written(full.groupBy("set").agg(F.count("*").alias("docs"), F.min(place).alias("first"),
                                           F.min("mk_id").alias("least_id"), F.first("n").alias("n"),
                                           F.first("paths").alias("paths"))
                   .withColumn("mk_a", F.col("first.mk_a")).withColumn("mk_b", F.col("first.mk_b")),
                   "path-sets")
    links, grams = links_of(docs, sets, text_col, doc_id, similarity, recall, runs)
    labels = components(links)
    named = labels.join(sets.select("set", "first", "least_id"), labels.node == F.col("set"))
    groups = named.groupBy("root").agg(F.min("first").alias("group_first"),
                                       F.min("least_id").alias("group_id"))
    near = (labels.join(groups, "root").select(F.col("node").alias("set"), "group_first", "group_id")
            .join(_link_counts(grams, labels, sets, similarity), "set", "left"))
    table = (sets.select("set", "docs", "first", "least_id").join(near, "set", "left")
             .select("set", "docs", F.coalesce("group_first", "first").alias("lead"),
                     F.when(F.col("group_first").isNull(), F.col("least_id"))
                     .otherwise(F.col("group_id")).alias("class"),
                     F.coalesce("n_other", F.lit(0)).alias("n_other")))
    out = rows.select("mk_id", "mk_a", "mk_b", "n", "set").join(table, "set", "left")
    return out.select(
        F.col("mk_id").alias("doc_id"), "mk_a", "mk_b",
        F.when(F.col("n") > 0, F.col("class")).otherwise(F.col("mk_id")).alias("class_id"),
        F.when(F.col("n") > 0, F.col("docs") - 1 + F.col("n_other")).otherwise(0).cast("long")
        .alias("n_links"),
        F.when(F.col("n") > 0, place == F.col("lead")).otherwise(F.lit(True)).alias("is_first"))


def keep_first(docs: DataFrame, text_col: str = "text", doc_id: str = "doc_id",
               similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The first document of every group, with all its columns; equal rows once."""
    first = (jaccard_classes(docs, text_col, doc_id, similarity, recall).where("is_first")
             .select(F.col("mk_a").alias("mk_fa"), F.col("mk_b").alias("mk_fb")).distinct())
    a, b = row_key(doc_id, text_col)
    keyed = docs.withColumn("mk_a", a).withColumn("mk_b", b)
    out = keyed.join(first, (F.col("mk_a") == F.col("mk_fa")) & (F.col("mk_b") == F.col("mk_fb")),
                     "left_semi")
    return out.dropDuplicates(["mk_a", "mk_b"]).drop("mk_a", "mk_b")

"""Phrase collocations by set-oriented mining (SETM) over occurrence relations.

Level k is a relation of the occurrences of phrases of k words, kept in blocks
sorted by piece and position and written to the shared folder:

1. a merge join of the relation with itself at adjacent positions of a piece
   extends a phrase of k words by the last word of the phrase that starts one
   word later;
2. a block counts its distinct phrases, so a phrase that holds a third of the
   corpus is counted once per block when Spark brings the blocks' counts of a
   part of all phrases together;
3. the phrases below the least count go, and a semi-join with the frequent
   groups leaves only their occurrences before the next level.

Frequent phrases grow with the corpus, so none are broadcast or collected.
Words get their names through a join on the block's number; for longer phrases
the semi-join reads a bitmap of fixed size, marked with the hashes of the
frequent ones.  A phrase it lets through by chance extends to phrases that are
no more frequent than itself, and these fall when they are counted: the counts
decide, the bitmap only saves rows.  So does another one, made with the blocks:
tasks count hashed pairs of words in saturating counters, and pairs below the
least count are not listed, nor are words without a hot pair.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import text_slices
from .graph import dropped_shuffles, written

LEAST_COUNT = 30
LONGEST = 4
TOP = 2000
UNKNOWN = "und"
BLOCK_WORDS = 1 << 22
# A phrase is named by its first place: the block it is least in and its number
# there.  A block has less than two times BLOCK_WORDS places.
_PLACE_BITS, _BLOCK_BITS = 24, 18
# Hashed counters (two for each candidate), and how many make a row of their table.
_HEAT_BITS, _CHUNK = 24, 1 << 14

# A-Z in lower case, tabs as blanks, ends of pieces as a byte no UTF-8 text has.
_END = b"\xff"
_SPLIT = bytes(b + 32 if 65 <= b <= 90 else _END[0] if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b
               for b in range(256))


def _kept(df: DataFrame, name: str) -> DataFrame:
    return written(df, name, compression="zstd")


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers by column, and by byte of the number: high bytes hardly differ, so they shrink to little."""
    flat = np.ascontiguousarray(numbers.T).ravel()
    planes = flat.view(np.uint8).reshape(len(flat), flat.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, size: int, kind: type | np.dtype = np.int32, width: int | None = None) -> np.ndarray:
    """``size`` numbers, or as many rows of ``width`` numbers."""
    kind, n = np.dtype(kind), size * (width or 1)
    flat = np.empty(0, kind)
    if n:
        planes = pa.decompress(blob, decompressed_size=n * kind.itemsize, codec="zstd", asbytes=True)
        flat = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()
    return flat if width is None else np.ascontiguousarray(flat.reshape(width, size).T)


# -- hashed counters -----------------------------------------------------------
def _buckets(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two counters of every hash, one in each half of the table."""
    half = np.uint64(65 - _HEAT_BITS)
    other = hashes * np.uint64(0xA24BAED4963EE407)
    return ((hashes >> half).astype(np.uint32),
            (other >> half).astype(np.uint32) + np.uint32(1 << (_HEAT_BITS - 1)))


def _lit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    one, two = _buckets(hashes)
    return bits[one] & bits[two]


class _Heat:
    """A task's saturating counters of hashed candidates."""

    def __init__(self, least: int):
        self.cap = least
        self.table = np.zeros(1 << _HEAT_BITS, np.min_scalar_type(least))

    def add(self, hashes: np.ndarray) -> None:
        for buckets in _buckets(hashes):
            at, n = np.unique(buckets, return_counts=True)
            self.table[at] = np.minimum(self.table[at] + n, self.cap)

    def mark(self, hashes: np.ndarray) -> None:
        for buckets in _buckets(hashes):
            self.table[buckets] = self.cap

    def rows(self):
        """(chunk, packed counters) of the chunks in use."""
        for i, part in enumerate(self.table.reshape(-1, _CHUNK)):
            if part.any():
                yield i, _packed(part)

    def batches(self):
        for chunk, table in self.rows():
            yield pa.RecordBatch.from_arrays([_one(chunk, pa.int32()), _one(table, pa.binary())],
                                             names=["chunk", "heat"])


# Positions whose candidates are hashed at once.
_SLICE = 1 << 19


def _slices(size: int):
    return [slice(a, min(a + _SLICE, size)) for a in range(0, size, _SLICE)]


def _joined_hash(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    h = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + last.astype(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _phrase_hash(names: np.ndarray) -> np.ndarray:
    """Hashes of phrases given as rows of word names."""
    h = np.zeros(len(names), np.uint64)
    for column in names.T:
        h = _joined_hash(h, column)
    return h


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """What Spark's xxhash64(lang, word) gives."""
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8"), 42)
    return np.fromiter([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64, len(words))


def _one(value, kind: pa.DataType) -> pa.Array:
    return pa.array([value], kind)


def _hot(rows: DataFrame, least: int):
    """The bitmap of the counters that reach ``least``, broadcast (2 MB at any size)."""
    kind = np.min_scalar_type(least)

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, table in zip(b.column("chunk").to_pylist(), b.column("heat").to_pylist()):
                got = _unpacked(table, _CHUNK, kind).astype(np.uint32)
                sums[chunk] = np.minimum(sums.get(chunk, 0) + got, least)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([np.packbits(s >= least).tobytes() for s in sums.values()], pa.binary())],
            names=["chunk", "bits"])

    bits = np.zeros(1 << (_HEAT_BITS - 3), np.uint8)
    size = _CHUNK // 8
    with dropped_shuffles(rows.sparkSession):
        totals = (rows.where("chunk IS NOT NULL").select("chunk", "heat").repartition("chunk")
                  .mapInArrow(total, "chunk int, bits binary").collect())
    for r in totals:
        bits[r["chunk"] * size:(r["chunk"] + 1) * size] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return rows.sparkSession.sparkContext.broadcast(bits)


# -- level 1 -------------------------------------------------------------------
class _Block:
    """Occurrences of one language on their way into a block; number 0 ends a piece."""

    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict(count(1).__next__, {_END: 0})
        self.places = array("i")
        self.own = 0

    def add(self, words: list[bytes], after: list[bytes]) -> None:
        """Words of a text; ``after`` are the next ones, which start no phrase of this block."""
        get = self.number.__getitem__
        self.places.extend(map(get, words))
        self.own = len(self.places)
        self.places.extend(map(get, after))
        self.places.append(0)


_BLOCK_SCHEMA = ("block long, lang string, own int, size int, starts binary, words array<string>, "
                 "counts binary, n long, chunk int, heat binary")


def _nulls(names_types: list[tuple[str, pa.DataType]], given: dict, n: int = 1) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([given.get(c, pa.nulls(n, t)) for c, t in names_types],
                                      names=[c for c, _ in names_types])


def _blocks(block_words: int, longest: int, least: int):
    """Arrow batches of (lang, text) to blocks, then the counters of their pairs of words."""
    kinds = [("block", pa.int64()), ("lang", pa.string()), ("own", pa.int32()), ("size", pa.int32()),
             ("starts", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.binary()),
             ("n", pa.int64()), ("chunk", pa.int32()), ("heat", pa.binary())]

    def rows(blocks, seq, heat):
        part = TaskContext.get().partitionId()
        for lang in list(blocks):
            block = blocks.pop(lang)
            starts = np.frombuffer(block.places, np.int32) - 1
            words = list(block.number)[1:]
            own = starts[:block.own]
            counts = np.bincount(own[own >= 0], minlength=len(words)).astype(np.int32)
            hashes = _word_hashes(lang, words)
            for cut in _slices(block.own):
                at = cut.start + _adjacent(starts[cut.start:cut.stop + 1])
                heat.add(_joined_hash(hashes[starts[at]], hashes[starts[at + 1]]))
            yield _nulls(kinds, {
                "block": _one((part << _BLOCK_BITS | next(seq)) << _PLACE_BITS, pa.int64()),
                "lang": _one(lang, pa.string()), "own": _one(block.own, pa.int32()),
                "size": _one(len(starts), pa.int32()), "starts": _one(_packed(starts), pa.binary()),
                "words": _one(words, pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                "counts": _one(counts.tobytes(), pa.binary()), "n": _one(int(counts.sum()), pa.int64())})

    def run(batches):
        seq, heat = count(), _Heat(least)
        blocks: defaultdict[str, _Block] = defaultdict(_Block)
        held = 0
        for whole in batches:
            for batch in text_slices(whole, "text"):
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                    if not text:
                        continue
                    words = text.encode("utf-8").translate(_SPLIT).replace(_END, b" " + _END + b" ").split()
                    for a in range(0, len(words), block_words):
                        part = words[a:a + block_words]
                        after = words[a + block_words:a + block_words + longest - 1]
                        blocks[lang].add(part, after)
                        held += len(part)
                        if after or held >= block_words:
                            yield from rows(blocks, seq, heat)
                            held = 0
        yield from rows(blocks, seq, heat)
        for chunk, table in heat.rows():
            yield _nulls(kinds, {"chunk": _one(chunk, pa.int32()), "heat": _one(table, pa.binary())})
    return run


def _block_words(batch: pa.RecordBatch, i: int) -> tuple[pa.Array, np.ndarray]:
    """The words of a block and their hashes."""
    words = batch.column("words")[i].values
    return words, _word_hashes(batch.column("lang")[i].as_py(), words.cast(pa.binary()).to_pylist())


def _used_words(hot, least: int):
    """Marks of the words that stand in a hot pair somewhere."""
    def run(batches):
        bits = np.unpackbits(hot.value).astype(bool)
        used = _Heat(least)
        for b in batches:
            for i in range(b.num_rows):
                starts = _unpacked(b.column("starts")[i].as_py(), b.column("size")[i].as_py())
                _, hashes = _block_words(b, i)
                seen = np.zeros(len(hashes), bool)
                for cut in _slices(len(starts)):
                    at = cut.start + _adjacent(starts[cut.start:cut.stop + 1])
                    at = at[_lit(bits, _joined_hash(hashes[starts[at]], hashes[starts[at + 1]]))]
                    seen[starts[at]] = True
                    seen[starts[at + 1]] = True
                used.mark(hashes[seen])
        yield from used.batches()
    return run


def _listed_words(used):
    """(block, place, lang, word, n, used) of every word of a block; ``used`` if it is marked."""
    def run(batches):
        bits = np.unpackbits(used.value).astype(bool)
        for b in batches:
            for i in range(b.num_rows):
                words, hashes = _block_words(b, i)
                counts = np.frombuffer(b.column("counts")[i].as_py(), np.int32)
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, b.column("block")[i].as_py(), np.int64)), pa.array(np.arange(n)),
                     pa.repeat(b.column("lang")[i], n), words, pa.array(counts.astype(np.int64)),
                     pa.array(_lit(bits, hashes))],
                    names=["block", "place", "lang", "word", "n", "used"])
    return run


# -- from level k to level k + 1 -----------------------------------------------
def _adjacent(starts: np.ndarray) -> np.ndarray:
    """Positions at which a phrase starts, and another one word later."""
    return np.flatnonzero((starts[:-1] >= 0) & (starts[1:] >= 0))


_FOUND_SCHEMA = "block long, own int, size int, starts binary, n long, names binary, counts binary"


def _extended(k: int, hot, last: bool):
    """Merge join of a block's phrases at adjacent positions, and a count of what comes out.

    ``starts`` holds the number of the phrase at its first word (-1: none or the
    end of a piece; not kept after the ``last`` join), ``names`` the names of
    the k words of each of the ``n`` numbers.  At
    level 1 they come from the semi-join as lists of numbers, names and hashes,
    and ``hot`` tells the likely pairs; later ``hot`` tells the frequent phrases.
    """
    def level(batch, i, bits):
        """(starts, names, hashes or None): the semi-join."""
        starts = _unpacked(batch.column("starts")[i].as_py(), batch.column("size")[i].as_py())
        numbers = int(starts.max(initial=-1)) + 2
        # The last entry is never kept, so that number -1 isn't either.
        keep = np.zeros(numbers, bool)
        if k > 1:
            names = _unpacked(batch.column("names")[i].as_py(), batch.column("n")[i].as_py(), np.int64, k)
            keep[:len(names)] = _lit(bits, _phrase_hash(names))
            return np.where(keep[starts], starts, -1).astype(np.int32), names, None
        old = batch.column("old")[i].values.to_numpy()
        names, hashes = np.full((numbers, 1), -1, np.int64), np.zeros(numbers, np.uint64)
        keep[old] = True
        names[old, 0] = batch.column("ids")[i].values.to_numpy()
        hashes[old] = batch.column("hashes")[i].values.to_numpy().view(np.uint64)
        return np.where(keep[starts], starts, -1).astype(np.int32), names, hashes

    def run(batches):
        bits = np.unpackbits(hot.value).astype(bool)
        for b in batches:
            for i in range(b.num_rows):
                own = b.column("own")[i].as_py()
                starts, names, hashes = level(b, i, bits)
                at = _adjacent(starts)
                if hashes is not None:
                    at = np.concatenate([np.empty(0, np.int64), *[
                        at[cut][_lit(bits, _joined_hash(hashes[starts[at[cut]]], hashes[starts[at[cut] + 1]]))]
                        for cut in _slices(len(at))]])
                pairs, place = np.unique(starts[at].astype(np.int64) << 32 | starts[at + 1], return_inverse=True)
                longer = np.concatenate([names[pairs >> 32], names[pairs & 0xFFFFFFFF][:, -1:]], axis=1)
                found = np.full(0 if last else len(starts), -1, np.int32)
                if not last:
                    found[at] = place
                counts = np.bincount(place[at < own], minlength=len(pairs)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [_one(b.column("block")[i].as_py(), pa.int64()), _one(own, pa.int32()),
                     _one(len(found), pa.int32()), _one(_packed(found), pa.binary()), _one(len(pairs), pa.int64()),
                     _one(_packed(longer), pa.binary()), _one(_packed(counts), pa.binary())],
                    names=["block", "own", "size", "starts", "n", "names", "counts"])
    return run


def _dealt(k: int, parts: int):
    """A block's phrases of k words and their counts, dealt to parts by hash: one row per part, sorted."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                n = b.column("n")[i].as_py()
                names = _unpacked(b.column("names")[i].as_py(), n, np.int64, k)
                counts = _unpacked(b.column("counts")[i].as_py(), n, np.int64)
                part = (_phrase_hash(names) % np.uint64(parts)).astype(np.int32)
                order = np.lexsort([*names.T[::-1], part])
                rows = np.column_stack([names, counts])[order]
                seen, at = np.unique(part[order], return_index=True)
                ends = np.append(at[1:], n)
                blobs = [_packed(rows[x:y]) for x, y in zip(at, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen, pa.int32()), pa.array(ends - at, pa.int64()), pa.array(blobs, pa.binary())],
                    names=["part", "n", "rows"])
    return run


def _summed(k: int, least: int):
    """(ids, a) of the frequent phrases of each part; parts follow one another."""
    def total(blobs):
        rows = np.concatenate([_unpacked(x, n, np.int64, k + 1) for n, x in blobs])
        rows = rows[np.lexsort(rows[:, :k].T)]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :k] != rows[:-1, :k]).any(axis=1)
        at = np.flatnonzero(new)
        a = np.add.reduceat(rows[:, k], at) if len(at) else np.empty(0, np.int64)
        ids, a = rows[at][a >= least, :k], a[a >= least]
        lists = pa.FixedSizeListArray.from_arrays(pa.array(ids.ravel()), k).cast(pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([lists, pa.array(a)], names=["ids", "a"])

    def run(batches):
        part, blobs = None, []
        for b in batches:
            for p, *blob in zip(*[b.column(c).to_pylist() for c in ("part", "n", "rows")]):
                if p != part and blobs:
                    yield total(blobs)
                    blobs = []
                part = p
                blobs.append(blob)
        if blobs:
            yield total(blobs)
    return run


# Rows of (names, count) that one part of a group count holds, on average.
_PART_ROWS = 1 << 20


def _group_count(found: DataFrame, k: int, least: int) -> DataFrame:
    """(ids, a) of the phrases of k words with ``a >= least``.

    A block's phrases travel as one blob of numbers per part, with as many parts
    as the rows of all blocks ask for, so no task sums more than a part at a time.
    """
    rows = found.agg(F.sum("n").alias("n")).first()["n"] or 0
    parts = max(1, int(rows) // _PART_ROWS + 1)
    dealt = found.select("n", "names", "counts").mapInArrow(_dealt(k, parts), "part int, n long, rows binary")
    return (dealt.repartition("part").sortWithinPartitions("part")
            .mapInArrow(_summed(k, least), "ids array<long>, a long"))


def _marks(least: int):
    """Marks of the frequent phrases ``ids``."""
    def run(batches):
        heat = _Heat(least)
        for b in batches:
            if b.num_rows:
                ids = b.column("ids")
                heat.mark(_phrase_hash(ids.flatten().to_numpy().reshape(b.num_rows, -1)))
        yield from heat.batches()
    return run


def _named_words(rows: DataFrame, least: int) -> DataFrame:
    """``rows(at, lang, word, n)`` of frequent words, with their count ``a`` and name ``id``.

    ``at`` is the block and the number in it, the name the least of a word.
    Each block has a word once, so no key is hot; one exchange serves the count
    and the semi-join.  A hash goes first so that the sort compares longs.
    """
    same = Window.partitionBy(F.xxhash64("lang", "word"), "lang", "word")
    return (rows.repartition("lang", "word").withColumn("a", F.sum("n").over(same))
            .withColumn("id", F.min("at").over(same)).where(F.col("a") >= least))


def _semi_join(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """Blocks with the numbers, names and hashes of their frequent words.

    The lists of one aggregate run in step: each takes one value from every row.
    """
    block = F.col("at").bitwiseAND(F.lit(-(1 << _PLACE_BITS)))
    held = words.groupBy(block.alias("mk_block")).agg(
        F.collect_list(F.col("at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).alias("old"),
        F.collect_list("id").alias("ids"), F.collect_list(F.xxhash64("lang", "word")).alias("hashes"))
    return blocks.join(held, blocks.block == F.col("mk_block")).drop("mk_block")


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     least: int = LEAST_COUNT, longest: int = LONGEST,
                     block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """``(lang, k, phrase, a)`` of every phrase of 1 to ``longest`` words
    with count ``a >= least``, and ``(lang, n)``, all words of a language.

    A-Z are lower-cased, texts cut at ``[.,;:!?]`` and line ends into pieces,
    those at blanks and tabs into words; overlapping occurrences all count.  A
    null language is ``und``; null and empty texts have no words; repeated rows
    count as often as they stand there.  A text longer than a block is cut, and
    each part knows the words after it.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col(text_col).alias("text"))
    made = _kept(rows.mapInArrow(_blocks(block_words, longest, least), _BLOCK_SCHEMA), "phrase-words")
    blocks = made.where("chunk IS NULL")
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    hot = _hot(made, least)
    used = _hot(blocks.select("lang", "size", "starts", "words").mapInArrow(
        _used_words(hot, least), "chunk int, heat binary"), least)
    listed = blocks.select("block", "lang", "words", "counts").mapInArrow(
        _listed_words(used), "block long, place long, lang string, word string, n long, used boolean")
    listed = listed.where("used").select((F.col("block") + F.col("place")).alias("at"), "lang", "word", "n")
    words = _kept(_named_words(listed, least).select("at", "id", "lang", "word", "a"), "phrase-level1")
    named = words.where("id = at")
    levels = named.select(F.array("id").alias("ids"), "a")
    # Level 1 has its counters already, hashed by word.
    held = _semi_join(blocks.select("block", "own", "size", "starts"), words)
    for k in range(1, longest):
        found = _kept(held.mapInArrow(_extended(k, hot, k + 1 == longest), _FOUND_SCHEMA), f"phrase-occurrences{k + 1}")
        level = _kept(_group_count(found, k + 1, least), f"phrase-level{k + 1}")
        levels = levels.unionByName(level)
        if k + 1 < longest:
            hot = _hot(level.select("ids").mapInArrow(_marks(least), "chunk int, heat binary"), least)
            held = found.select("block", "own", "size", "starts", "n", "names")
    spelled = (levels.select("ids", "a", F.posexplode("ids").alias("at", "id"))
               .join(named.select("id", "lang", "word"), "id")
               .groupBy("ids", "a").agg(F.first("lang").alias("lang"),
                                        F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelling")))
    phrases = _kept(spelled.select("lang", F.size("ids").alias("k"),
                                   F.array_join("spelling.word", " ").alias("phrase"), "a"), "phrases")
    return phrases, totals


def _part(first, size):
    """``size`` words of the phrase from word ``first`` (1-based); words hold no blanks."""
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """Every phrase of two words or more with the ``l``, ``r`` and ``score`` of its worst cut.

    Cut after k words, a phrase scores ``2000000 * a div (l + r)``; ties go to
    the smallest k.  Parts of a frequent phrase are frequent, so their counts
    are in ``phrases``.  Decimals keep the products exact.
    """
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    cuts = phrases.where("k >= 2").select("lang", "phrase", "k", "a",
                                          F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"left": _part(F.lit(1), F.col("cut")),
                             "right": _part(F.col("cut") + 1, F.col("k") - F.col("cut"))})
    left = parts.withColumnsRenamed({"part": "left", "f": "l"})
    right = parts.withColumnsRenamed({"part": "right", "f": "r"})
    both = (cuts.join(left, ["lang", "left"]).drop("left").join(right, ["lang", "right"]).drop("right")
            .withColumn("score", F.expr("(2000000BD * cast(a as decimal(19, 0))) "
                                        "div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")))
    worst = both.groupBy("lang", "phrase", "k", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
    return worst.select("lang", "phrase", "k", "a", "worst.l", "worst.r", "worst.score")


def maximal(candidates: DataFrame) -> DataFrame:
    """Candidates whose words lie in no longer candidate that has four fifths of their count."""
    inner = (candidates.where("k >= 3")
             .select("lang", "phrase", "k", F.col("a").alias("f"),
                     F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
             .withColumn("from", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
             .select("lang", "f", _part(F.col("from"), F.col("size")).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("f").alias("f")))
    return (candidates.join(inner, ["lang", "phrase"], "left")
            .where("f IS NULL OR 100BD * cast(f as decimal(19, 0)) < 80BD * cast(a as decimal(19, 0))").drop("f"))


def top_phrases(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """Rank 1 to ``top`` in every language, by score, count, then phrase.

    A language may hold most phrases: each is ranked inside one of many salted
    parts first, and only the first ``top`` of every part meet.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parts = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    first = (candidates.withColumn("mk_part", part)
             .withColumn("mk_rank", F.row_number().over(Window.partitionBy("lang", "mk_part").orderBy(*order)))
             .where(F.col("mk_rank") <= top))
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top).drop("mk_part", "mk_rank"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT,
                 longest: int = LONGEST, top: int = TOP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)`` of the first ``top`` phrases of each language.

    See :func:`frequent_phrases`, :func:`scored`, :func:`maximal` and
    :func:`top_phrases`.  Other columns of ``docs`` are not read, so their
    names can't clash; an empty table gives an empty result.
    """
    phrases, totals = frequent_phrases(docs, text_col, lang_col, least, longest, block_words)
    candidates = _kept(maximal(scored(phrases)), "phrase-candidates")
    ranked = top_phrases(candidates, top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

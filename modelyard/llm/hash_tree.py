"""Sharding by a hierarchical weighted hash tree.

A key descends region, rack and shard.  At each level every child draws
-ln(u) / weight with u a hash of key and child, and the least draw wins, so a
child is chosen in proportion to its weight, and a change of one child's
weight moves keys only between that child and the others of its level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REGIONS, RACKS, PER_RACK = 2, 2, 4
SLOT_BUCKETS = 256


def layout(shards: int, base: int = REGIONS * RACKS * PER_RACK) -> list[tuple[str, str, int, float]]:
    """(region, rack, shard, weight): ``base`` shards in 2 regions of 2 racks,
    each further shard in a region of its own, so that growth by one shard
    adds one child at the top and moves keys only into it."""
    out = []
    for s in range(shards):
        if s < base:
            region, rack = s * REGIONS // base, s * REGIONS * RACKS // base % RACKS
            out.append((f"r{region}", f"r{region}/k{rack}", s, 1.0))
        else:
            out.append((f"g{s}", f"g{s}/k0", s, 1.0))
    return out


def _children(tree) -> list[dict[str, dict[str, float]]]:
    """Per level: node -> child -> weight (the sum of the shards below)."""
    levels: list[dict] = [{}, {}, {}]
    for region, rack, shard, weight in tree:
        for level, (node, child) in enumerate((("", region), (region, rack),
                                               (rack, f"{rack}/s{shard}"))):
            kids = levels[level].setdefault(node, {})
            kids[child] = kids.get(child, 0.0) + weight
    return levels



def shard_of(key: Column, tree) -> Column:
    """The shard a key falls to; the key's text decides, null counts as ''."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    node = F.lit("")
    for kids in _children(tree):
        table = F.create_map(*[x for n, c in sorted(kids.items()) for x in (
            F.lit(n), F.array(*[F.struct(F.lit(k).alias("child"), F.lit(w).alias("weight"))
                                for k, w in sorted(c.items())]))])

        def draw(c):
            u = (F.shiftrightunsigned(F.xxhash64(text, c["child"]), 12).cast("double") + 0.5) / 2.0 ** 52
            return F.struct((-F.log(u) / c["weight"]).alias("draw"), c["child"].alias("child"))

        node = F.array_min(F.transform(F.element_at(table, node), draw))["child"]
    return F.regexp_extract(node, r"/s(\d+)$", 1).cast("int")


def place(df: DataFrame, tree, key: str, name: str = "shard") -> DataFrame:
    """Add the shard of every row; all rows are kept, equal keys go together."""
    return df.withColumn(name, shard_of(F.col(key), tree))


def slots(placed: DataFrame, order: list[str], shard: str = "shard",
          buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... without gaps inside each shard.

    Rows are numbered inside hash buckets of a shard and shifted by the counts
    of the buckets before, so no task holds a whole shard.  ``order`` names
    the columns that decide; rows equal in all of them are interchangeable.
    """
    mixed = placed.withColumn("mk_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    per = mixed.groupBy(F.col(shard).alias("mk_s"), F.col("mk_bucket").alias("mk_b")).agg(
        F.count("*").alias("mk_n"))
    first = per.select("mk_s", "mk_b", (F.sum("mk_n").over(
        Window.partitionBy("mk_s").orderBy("mk_b")) - F.col("mk_n")).alias("mk_first"))
    number = F.row_number().over(Window.partitionBy(shard, "mk_bucket").orderBy(*order)) - 1
    # One row for each shard and bucket: the size is known beforehand.
    return (mixed.withColumn("mk_at", number)
            .join(F.broadcast(first), (F.col(shard) == F.col("mk_s"))
                  & (F.col("mk_bucket") == F.col("mk_b")))
            .withColumn("slot", (F.col("mk_first") + F.col("mk_at")).cast("long"))
            .drop("mk_bucket", "mk_at", "mk_s", "mk_b", "mk_first"))

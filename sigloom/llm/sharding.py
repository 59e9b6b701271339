"""Sharding by a hierarchical weighted hash tree: region, rack, shard.  DataFrame operations only.

At every level each child draws a hash of (document id, child); its logarithm, divided by the child's weight, is the
arrival time of an exponential process, and the first to arrive takes the document.  A child's chance is its share of
the weights, and a draw does not depend on the other children, so a document moves only where a weight changes.

A plain tree still moves documents between old shards: a region that grows wins documents which its racks would then
deal to all their shards.  So weight that is added later draws for itself: a shard (or an increase of its weight)
carries the generation ``since`` in which it came, regions draw per generation, and what a generation wins goes down to
the shards of that generation alone.  A shard more takes documents only into itself, wherever in the tree it stands; a
lower weight or a lost shard sends documents away only from itself.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.common import written


@dataclass(frozen=True)
class Share:
    """Weight of a shard at its place in the tree, from generation ``since`` on."""
    shard: int
    region: str
    rack: str
    weight: float = 1.0
    since: int = 0


Tree = tuple[Share, ...]


def even_tree(shards: int, per_rack: int = 4, racks_per_region: int = 2) -> Tree:
    """Shards from 0 with equal weights, filled rack by rack and region by region."""
    return tuple(Share(i, f"region{i // (per_rack * racks_per_region)}", f"rack{i // per_rack}") for i in range(shards))


def with_shard(tree: Tree, shard: int, region: str, rack: str, weight: float = 1.0) -> Tree:
    """The tree with one more shard, which draws for itself."""
    if any(s.shard == shard for s in tree):
        raise ValueError(f"shard {shard} is in the tree")
    return (*tree, Share(shard, region, rack, weight, 1 + max((s.since for s in tree), default=-1)))


def with_weight(tree: Tree, shard: int, weight: float) -> Tree:
    """The tree with another weight of a shard: more is added as a generation of its own, less is taken from the last ones."""
    own = sorted((s for s in tree if s.shard == shard), key=lambda s: s.since)
    if not own:
        raise ValueError(f"no shard {shard} in the tree")
    more = weight - sum(s.weight for s in own)
    if more > 0:
        return (*tree, replace(own[-1], weight=more, since=1 + max(s.since for s in tree)))
    left, kept = weight, {}
    for s in own:
        kept[s] = min(s.weight, max(left, 0.0))
        left -= s.weight
    return tuple(replace(s, weight=kept.get(s, s.weight)) for s in tree if kept.get(s, s.weight) > 0)


def _levels(tree: Tree) -> list[list[list[tuple[str, float, int]]]]:
    """Per level, and per node of the level above, its children as (name, weight, number); the last numbers are shards."""
    live = sorted((s for s in tree if s.weight > 0), key=lambda s: (s.since, s.region, s.rack, s.shard))
    if not live:
        raise ValueError("the tree has no shard with a weight")
    # A change of a plain tree's layout must not depend on the order of its rows: names alone decide the draws.
    paths = [((f"{s.since}|{s.region}",), (f"{s.since}|{s.region}|{s.rack}",), (f"{s.since}|{s.region}|{s.rack}|{s.shard}",)) for s in live]
    levels: list[list[list[tuple[str, float, int]]]] = []
    parents: dict[str, int] = {"": 0}
    for depth in range(3):
        children: list[dict[str, float]] = [{} for _ in parents]
        for s, path in zip(live, paths):
            above = parents[path[depth - 1][0] if depth else ""]
            name = path[depth][0]
            children[above][name] = children[above].get(name, 0.0) + s.weight
        numbers = {name: i for i, name in enumerate(name for c in children for name in c)}
        shard_of = {path[2][0]: s.shard for s, path in zip(live, paths)}
        levels.append([[(name, w, shard_of[name] if depth == 2 else numbers[name]) for name, w in c.items()] for c in children])
        parents = numbers
    return levels


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key: three weighted draws down the tree.  A null key counts as the empty string."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    at = F.lit(0)
    for level in _levels(tree):
        nodes = F.array(*[F.array(*[F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight"), F.lit(number).alias("number"))
                                    for name, weight, number in children]) for children in level])

        def arrival(child: Column) -> Column:
            draw = F.shiftrightunsigned(F.xxhash64(F.concat_ws("/", text, child["name"])), 11).cast("double")
            return F.struct((-F.log((draw + 0.5) / F.lit(float(1 << 53))) / child["weight"]).alias("time"), child["name"].alias("name"), child["number"].alias("number"))

        at = F.array_min(F.transform(F.get(nodes, at), arrival))["number"]
    return at.cast("int")


def sharded(docs: DataFrame, tree: Tree, later: Tree | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, shard, slot, later_shard (null without ``later``).

    ``size`` is the UTF-8 bytes of the text plus one; a null text counts as empty, a null id as the empty string.  The id
    alone decides the shard, so rows that repeat an id meet in one shard, and copies of a text under other ids need not.
    Slots are counted from 0 without a gap in each shard: rows inside their task first, then an offset per task, so no
    window holds more than a task's rows.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.col(f"`{id_col}`")
    found = docs.select(key.alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                        shard_of(key, tree).alias("shard"), (shard_of(key, later) if later else F.lit(None).cast("int")).alias("later_shard"),
                        F.monotonically_increasing_id().alias("uid"))
    rows = written(found, "shards").withColumn("task", F.shiftright("uid", 33))
    earlier = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "task").agg(F.count(F.lit(1)).alias("n"))  # one row per task and shard
    starts = counts.select("shard", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "task").orderBy("uid")) - 1
    placed = rows.withColumn("inside", inside).join(starts, ["shard", "task"])
    return placed.select("id", "size", "text_crc32", "shard", (F.col("start") + F.col("inside")).alias("slot"), "later_shard")


def moves(placed: DataFrame) -> DataFrame:
    """(shard, later_shard, rows, bytes) of what would move from the one tree to the other."""
    away = placed.filter("shard <> later_shard")
    return away.groupBy("shard", "later_shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))

"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring of 2^16 places; a key stands at
the place of its hash and belongs to the next point clockwise.  Each shard has
a capacity in rows, and together they hold every row: with ``slack = 0`` the
capacities are ``n // shards`` or one more, so the counts of any two shards
differ by one at most, whatever the keys are.  Keys that overflow a full shard
continue clockwise to the next point whose shard has room, so only the
overflow leaves its home: a few rows in a hundred with 256 points a shard.

Plan (DataFrame operations only):

1. a narrow table (key, hash place, size, checksum) is put into ring order by
   the two-level sort of ``operators.ordered``; a row number breaks ties, so a
   key with a third of all rows is spread over many sort partitions;
2. rows are counted by arc (pre-aggregated); arcs are as many as points, which
   is the bound on the table the driver sees;
3. the driver fills the shards arc by arc and gets intervals (arc, from, to,
   shard, first slot): at most one for each arc plus one for each overflow step;
4. rows join their arc's intervals (broadcast: bounded by the points) by rank
   in the arc.  The texts themselves never move.

Edge cases: null keys stand at one place of the ring and are dealt like any
other key; rows with equal keys, and whole repeated rows, get slots of their
own; a null text has no bytes (size 16, checksum 0); an empty table gives an
empty result; extra columns are left out of the narrow table.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import row_index

PLACES = 1 << 16
SHARDS = 40
VNODES = 256
ROW_OVERHEAD = 16


def place(key: Column) -> Column:
    """Place on the ring: the upper 16 bits of the key's 64-bit hash."""
    return F.shiftrightunsigned(F.xxhash64(key.cast("string")), 48).cast("int")


def ring_points(spark, shards: int, vnodes: int = VNODES) -> DataFrame:
    """(arc, place, shard): the points in ring order.  A shard's points depend
    on its number alone, so a further shard only adds points.  Where several
    points share a place, the one of the lowest hash owns it."""
    p = (spark.range(shards * vnodes)
         .select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("v"))
         .select("shard", F.xxhash64(F.lit("point"), "shard", "v").alias("h")))
    return (p.groupBy(F.shiftrightunsigned("h", 48).cast("int").alias("place"))
             .agg(F.min_by("shard", "h").alias("shard")))


def fill(arcs: list[tuple[int, int]], capacity: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """Deals counted arcs to shards of bounded capacity.

    ``arcs``: (shard, rows) in ring order.  Returns intervals (arc, from, to,
    shard, first slot) over the ranks of each arc's rows.  First every shard
    takes from its own arcs, in ring order, up to its capacity; then each
    overflow walks clockwise over the points until all its rows have a place.
    """
    room, slots = dict(capacity), dict.fromkeys(capacity, 0)
    out, over = [], []

    def take(arc: int, start: int, rows: int, shard: int) -> int:
        n = min(rows, room[shard])
        if n:
            out.append((arc, start, start + n, shard, slots[shard]))
            room[shard] -= n
            slots[shard] += n
        return n

    for arc, (shard, rows) in enumerate(arcs):
        n = take(arc, 0, rows, shard)
        if n < rows:
            over.append((arc, n, rows))
    for arc, start, rows in over:
        at = arc
        while start < rows:
            at = (at + 1) % len(arcs)
            start += take(arc, start, rows - start, arcs[at][0])
    return out


def capacities(natural: dict[int, int], rows: int, slack: float = 0.0) -> dict[int, int]:
    """Rows each shard may hold.  Without slack they add up to ``rows``; the
    shards that would hold most anyway get the odd rows."""
    if slack > 0:
        most = -(-int(rows * (1 + slack)) // len(natural))
        return dict.fromkeys(natural, max(most, -(-rows // len(natural))))
    low, odd = divmod(rows, len(natural))
    first = sorted(natural, key=lambda s: (-natural[s], s))[:odd]
    return {s: low + (s in first) for s in natural}


def assign(rows: DataFrame, key: str, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """``rows`` (narrow) plus shard, slot (gapless from 0 in each shard) and
    home_shard (the ring's owner before any overflow)."""
    spark = rows.sparkSession
    points = sorted((r.place, r.shard) for r in ring_points(spark, shards, vnodes).collect())  # at most shards * vnodes
    # every place's arc: the first point at or after it, around the ring
    owner, arc = [0] * PLACES, len(points) - 1
    for at in range(PLACES - 1, -1, -1):
        while arc >= 0 and points[arc][0] >= at:
            arc -= 1
        owner[at] = (arc + 1) % len(points)
    placed = (rows.withColumn("_place", place(F.col(key))).withColumn("_tie", F.monotonically_increasing_id()))
    ranked = row_index(placed, ["_place", key, "_tie"], "_rank")
    # counted by place (65,536 groups at most): a row's rank in its place is its
    # rank in the ring order less the rows of earlier places
    counts = {r["_place"]: r["n"] for r in ranked.groupBy("_place").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_arc, before, seen = [0] * len(points), [0] * PLACES, 0
    for at in range(PLACES):
        before[at] = seen
        seen += counts.get(at, 0)
    # an arc that runs over the end of the ring has two stretches; each place keeps
    # the arc rank at which its rows start
    starts = [0] * PLACES
    for at in range(PLACES):
        starts[at] = by_arc[owner[at]]
        by_arc[owner[at]] += counts.get(at, 0)
    arcs = [(points[a][1], by_arc[a]) for a in range(len(points))]
    natural = dict.fromkeys(range(shards), 0)
    for shard, n in arcs:
        natural[shard] += n
    plan = fill(arcs, capacities(natural, seen, slack))
    shift = spark.createDataFrame([(p, owner[p], starts[p] - before[p]) for p in counts], "_place int, _arc int, _shift long")
    intervals = spark.createDataFrame(plan or [(0, 0, 0, 0, 0)], "_arc int, _from long, _to long, shard int, _slot long")
    homes = spark.createDataFrame([(a, points[a][1]) for a in range(len(points))], "_arc int, home_shard int")
    inside = (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    return (ranked.join(F.broadcast(shift), "_place")
            .withColumn("_at", F.col("_rank") + F.col("_shift"))
            .join(F.broadcast(homes), "_arc")
            .join(F.broadcast(intervals.withColumnRenamed("_arc", "_iarc")), (F.col("_arc") == F.col("_iarc")) & inside)
            .withColumn("slot", F.col("_slot") + F.col("_at") - F.col("_from"))
            .drop("_place", "_arc", "_iarc", "_tie", "_rank", "_shift", "_at", "_from", "_to", "_slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document's shard and slot; ``rows`` is the law that holds."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.octet_length(text) + ROW_OVERHEAD).cast("bigint").alias("size"),
                         F.crc32(text).alias("text_crc32"))
    return assign(narrow, "doc_id", shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("home_shard").cast("int").alias("home_shard"))

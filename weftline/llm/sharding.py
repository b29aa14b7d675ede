"""K-d tree sharding: split at distributed weighted medians along the widest dimension until leaves hold a shard.

Points are distinct texts, weighted by the bytes of all their copies; their coordinates are metadata of the text
(bytes, bytes a character, lines), ties told apart by a hash of the text. A node that holds more than a leaf's
target is cut where the bytes on its left are nearest to the share of its left leaves, along the dimension that is
widest in it. Where one point straddles that median so that the cut is off by more than `TOLERANCE` of the target,
the other dimensions and `SPARE` orders by further hashes are tried and the nearest cut is taken. A
median is found by histograms over all nodes of a level at once, refined to the exact value; only histograms, of a
bounded number of bins in all, reach the driver, and rows find their leaf by one lookup of a node's cut a level.

Documents with equal texts are one point and stay in one shard. Only a group of equal texts that outweighs a leaf
is split, by rank: it fills as many whole leaves as it can, and what is left of it are points of a TOLERANCE of a
leaf each. So a text that makes up a third of all rows fills several shards evenly.

The law is `bytes`: sizes near equal. Defined cases: a null text has size 1; an empty table gives no rows;
repeated rows are dealt each for itself, as are texts that are equal in different rows; a very long text is a point
that can't be split, and a shard that it outweighs holds it alone or nearly so; with fewer texts than shards some
shards stay empty; further columns are not carried.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import checkpoint, ranked

DIMENSIONS = ("size", "width", "lines")
#: Share of a leaf's target by which a cut may be off before other orders are tried.
TOLERANCE = 1 / 50
#: Orders by hashes of the text that are tried after the dimensions.
SPARE = 6
#: Bins of all histograms of one pass, and of one node at most.
ALL_BINS, BINS = 1 << 18, 1 << 14
#: Ranks that one task numbers at a time.
RANKS_A_TASK = 50_000
#: Parts into which the rows of each large group are dealt to be ranked.
LEAST_BUCKETS = 128
HASH_BITS = 28
KEY = ("size", "text_crc32", "tie")


def coordinates(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, width, lines, tie): metadata of the texts, equal for equal texts."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint"), text.alias("text"))
    return rows.select(
        "doc_id",
        (F.octet_length("text") + 1).cast("bigint").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.floor(F.octet_length("text") * 1000 / F.greatest(F.length("text"), F.lit(1))).cast("bigint").alias("width"),
        (F.length("text") - F.length(F.translate("text", "\n", ""))).cast("bigint").alias("lines"),
        F.xxhash64("text").alias("tie"),
    )


def orders() -> Column:
    """Values of a point by candidate: the dimensions, then the spare hashes."""
    spare = [F.pmod(F.xxhash64("tie", F.lit(k)), F.lit(1 << HASH_BITS)) for k in range(SPARE)]
    return F.array(*(F.col(d).cast("bigint") for d in DIMENSIONS), *spare)


def last_bits() -> Column:
    return F.pmod(F.col("tie"), F.lit(1 << HASH_BITS))


@dataclass
class Search:
    """A weighted median: `below` bytes lie left of the bins of `step` from `start` on, of (value, hash) in turn."""

    node: int
    order: int
    goal: float
    start: int
    end: int
    step: int = 0
    below: float = 0
    value: int | None = None
    tie: int = 0
    off: float = 0

    def narrow(self, spans: list[tuple[int, int]]) -> bool:
        """Go into the bin that holds the goal; whether that was a single point's."""
        at = 0
        while at < len(spans) - 1 and self.below + spans[at][1] < self.goal:
            self.below += spans[at][1]
            at += 1
        first, weight = self.start + spans[at][0] * self.step, spans[at][1]
        if self.step > 1:
            self.start, self.end = first, min(self.end, first + self.step - 1)
        elif self.value is None:
            self.value, self.start, self.end = first, 0, (1 << HASH_BITS) - 1
        else:
            short, over = self.goal - self.below, self.below + weight - self.goal
            self.tie, self.off = (first + 1, over) if over < short else (first, short)
            return True
        return False


def constant(values: list, kind: str) -> Column:
    """A literal array that planning folds into one value; rows look their node's entry up by its number."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def medians(points: DataFrame, searches: list[Search], shards: int) -> list[Search]:
    """Bring all searches to their ends together, a histogram over all of them for each refinement."""
    active = list(searches)
    while active:
        bins = max(2, min(BINS, ALL_BINS // len(active)))
        jobs: list[list[dict]] = [[] for _ in range(shards)]
        for k, s in enumerate(active):
            s.step = max(1, -(-(s.end - s.start + 1) // bins))
            jobs[s.node].append({"search": k, "order": s.order, "value": s.value, "start": s.start, "end": s.end, "step": s.step})
        of_node = constant(jobs, "array<array<struct<search:int,order:int,value:bigint,start:bigint,end:bigint,step:bigint>>>")[F.col("node")]
        rows = points.select("weight", "orders", "last_bits", F.inline(of_node))
        own = F.col("orders")[F.col("order")]
        place = F.when(F.col("value").isNull(), own).when(own == F.col("value"), F.col("last_bits"))
        inside = rows.select("search", "start", "end", "step", "weight", place.alias("place")).where("place between start and end")
        found = inside.groupBy("search", F.floor((F.col("place") - F.col("start")) / F.col("step")).alias("bin")).agg(F.sum("weight").alias("bytes")).collect()
        spans: dict[int, list[tuple[int, int]]] = {}
        for r in found:
            spans.setdefault(r[0], []).append((r[1], r[2]))
        active = [s for k, s in enumerate(active) if not s.narrow(sorted(spans[k]))]
    return searches


def descend(rows: DataFrame, cuts: Column) -> DataFrame:
    """`rows` with node moved to the child that holds them; nodes without a cut stay."""
    cut = F.col("cut")
    own = F.col("orders")[cut["order"]]
    right = (own > cut["value"]) | ((own == cut["value"]) & (F.col("last_bits") >= cut["tie"]))
    moved = rows.withColumn("cut", cuts[F.col("node")])
    return moved.withColumn("node", F.when(right, cut["middle"]).otherwise(F.col("node"))).drop("cut")


def grow(points: DataFrame, first: int, last: int, target: float) -> list[Column]:
    """The cuts of each level of a tree with leaves [first, last), by node; a node is named by its first leaf."""
    points = points.withColumn("node", F.lit(first))
    nodes, levels, spread = {first: last}, [], None
    while any(high - low > 1 for low, high in nodes.items()):
        stats = points.groupBy("node").agg(F.sum("weight").alias("bytes"), *(F.struct(F.min(d).alias("low"), F.max(d).alias("high")).alias(d) for d in DIMENSIONS)).collect()
        spread = spread or [max((r[d].high - r[d].low for r in stats), default=0) for d in DIMENSIONS]
        opened = {r["node"]: r for r in stats if nodes[r["node"]] - r["node"] > 1}
        best: dict[int, Search] = {}
        tried: dict[int, int] = {}

        def search(low: int, order: int) -> Search:
            r, high = opened[low], nodes[low]
            goal = r["bytes"] * ((high - low) // 2) / (high - low)
            span = (r[DIMENSIONS[order]].low, r[DIMENSIONS[order]].high) if order < len(DIMENSIONS) else (0, (1 << HASH_BITS) - 1)
            return Search(low, order, goal, *span)

        for low, r in opened.items():
            tried[low] = max(range(len(DIMENSIONS)), key=lambda k: (r[DIMENSIONS[k]].high - r[DIMENSIONS[k]].low) / max(1, spread[k]))
        for s in medians(points, [search(low, order) for low, order in tried.items()], last):
            best[s.node] = s
        far = [low for low, s in best.items() if s.off > TOLERANCE * target]
        others = [search(low, order) for low in far for order in range(len(DIMENSIONS) + SPARE) if order != tried[low]]
        for s in medians(points, others, last):
            if s.off < best[s.node].off:
                best[s.node] = s
        middles = {low: low + (high - low) // 2 for low, high in nodes.items()}
        cuts = [None] * last
        for low, s in best.items():
            cuts[low] = {"order": s.order, "value": s.value, "tie": s.tie, "middle": middles[low]}
        levels.append(constant(cuts, "array<struct<order:int,value:bigint,tie:bigint,middle:int>>"))
        points = descend(points, levels[-1])
        nodes = {k: v for low, high in nodes.items() for k, v in (((low, middles[low]), (middles[low], high)) if high - low > 1 else ((low, high),))}
    return levels


def whole_leaves(groups: list[tuple], target: float, shards: int) -> list[tuple]:
    """(*key, first rank, ranks, shard) of the leaves that groups heavier than a leaf fill alone; one leaf is left over."""
    parts = []
    for *key, size, copies in sorted(groups, key=lambda g: (-g[-1] * g[-2], g)):
        bounds = [0]
        while len(parts) < shards - 1 and len(bounds) <= min(int(size * copies / target), copies):
            bounds.append(max(bounds[-1] + 1, int(len(bounds) * target / size)))
            if bounds[-1] > copies:
                break
            parts.append((*key, bounds[-2], bounds[-1] - bounds[-2], len(parts)))
    return parts


def shard(docs: DataFrame, shards: int = 8, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) as the contract has it, under the law `bytes`.

    A leaf's target is the `shards`-th part of all bytes, or `target_bytes`, which then decides the number of shards.
    """
    rows = checkpoint(coordinates(docs))
    points = rows.groupBy(*KEY, *(d for d in DIMENSIONS if d not in KEY)).agg(F.count(F.lit(1)).alias("copies"))
    points = checkpoint(points.withColumns({"weight": F.col("size") * F.col("copies"), "orders": orders(), "last_bits": last_bits()}))
    total, count, most = points.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.coalesce(F.sum("copies"), F.lit(0)), F.max(F.when(F.col("copies") > 1, F.col("weight")))).first()
    if target_bytes:
        shards = max(1, -(-total // target_bytes))
    target = max(1.0, total / shards)
    large = points.where((F.col("copies") > 1) & (F.col("weight") > target)).collect() if (most or 0) > target else []  # fewer than shards
    parts = whole_leaves([(*(g[k] for k in KEY), g["size"], g["copies"]) for g in large], target, shards)
    light, heavy = rows, None
    if parts:
        alone = F.broadcast(docs.sparkSession.createDataFrame(parts, "size bigint, text_crc32 bigint, tie bigint, first bigint, n bigint, shard int"))
        per = F.greatest(F.floor(F.lit(TOLERANCE * target) / F.col("size")), F.lit(1))
        placed = F.broadcast(alone.groupBy(*KEY).agg(F.sum("n").alias("placed")).withColumn("per", per))
        rest = points.join(placed, list(KEY)).withColumn("rest", F.col("copies") - F.col("placed")).where("rest > 0")
        rest = rest.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("rest") - 1) / F.col("per")))))
        rest = rest.withColumns({"weight": F.col("size") * F.least("per", F.col("rest") - F.col("piece") * F.col("per")), "tie": F.xxhash64("tie", "piece")})
        rest = rest.withColumns({"orders": orders(), "last_bits": last_bits()}).select(points.columns)
        points = points.join(placed, list(KEY), "left_anti").select(points.columns).union(rest)
        order = ranked(rows.join(placed, list(KEY)), list(KEY), ["doc_id"], "rank", max(LEAST_BUCKETS, -(-count // RANKS_A_TASK)))
        heavy = order.join(alone, list(KEY)).where("rank >= first and rank < first + n").select("doc_id", "size", "text_crc32", "shard")
        rest = order.where("rank >= placed").withColumn("tie", F.xxhash64("tie", F.floor((F.col("rank") - F.col("placed")) / F.col("per"))))
        light = rows.join(placed, list(KEY), "left_anti").select(rows.columns).union(rest.select(rows.columns))
    levels = grow(points, len(parts), shards, target)
    light = light.withColumns({"node": F.lit(len(parts)), "orders": orders(), "last_bits": last_bits()})
    for cuts in levels:
        light = descend(light, cuts)
    dealt = light.select("doc_id", "size", "text_crc32", F.col("node").alias("shard"))
    dealt = dealt.union(heavy) if heavy is not None else dealt
    buckets = max(4, -(-count // (shards * RANKS_A_TASK)))
    slots = ranked(dealt, ["shard"], ["doc_id", "text_crc32"], "slot", buckets)
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

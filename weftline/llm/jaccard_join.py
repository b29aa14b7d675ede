"""N-gram Jaccard self-join: rare-first prefix filtering with length, positional and suffix filters.

1. One pass turns each document into its set of word n-grams (64-bit hashes); equal sets form classes, and only
   the smallest doc_id of a class goes on. The same pass counts the n-grams of all documents in a sketch of
   `CELLS` counters.
2. Sets are ordered rare first, by their n-grams' counters, and each class emits its prefix: the first
   n - ceil(t n) + 1 n-grams. Two sets of Jaccard t or more share an n-gram of their prefixes, whatever the order
   is; the order only keeps frequent n-grams out. The sketch has a fixed size, so what is broadcast doesn't grow;
   with many n-grams to a counter, those that documents share still stand above the chance level, and prefixes
   come from the lowest counters.
3. Pairs are joined on prefix n-grams and pass the length filter, the positional filter (of the first n-gram that
   both have: all before it, in either set, are in the difference for certain) and a filter by parity (the n-grams'
   hashes fall into `RANGES` ranges, and ranges whose counts differ in parity bound the difference from below)
   inside the join. What is left is verified once for each pair: the suffix filter parts both sorted sets at the
   middle n-gram of one, adds up what the parts' sizes must differ by, and goes on in the parts `DEPTH` times; the
   pairs that pass are intersected.
4. Seeds come first: each document meets two hubs of each of its prefix n-grams, of all documents with the n-gram
   and of those of about its own size: the one with the fewest n-grams that no other prefix has, which of a family
   of copies is the nearest to all others; each document keeps the `SEEDS` that it meets most often. This links most
   of a large group. Then all pairs are joined whose components still differ, taking the rows outside an n-gram's
   largest component against all of its rows. No link between components is lost, and a group of m near copies costs
   about m pairs, not m squared, but for members that are linked with nothing.

A hot n-gram is never one task's: the sketch bounds an n-gram's rows from above, and only those of few rows are
gathered, for hubs and components and to drop the rows without a partner of about their size. What the others need are
aggregates, which go back to an n-gram's rows by broadcast where it has many. The last join deals rows to parts of `SPLIT`.

Defined cases: a text with fewer words than n is one n-gram, the whole sequence; a null or empty text, or one
without words, has the empty set and links with nothing; a very long text is one set, read whole; of hubs and seeds
that tie the smallest doc_id counts; rows that share a doc_id are one node; a null doc_id
has a component of null; an empty table gives no rows; further columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm import wordhash
from weftline.llm.common import BROADCAST_ROWS, HOT, attached, checkpoint, components, joined_back, let_go, map_batches

CELLS, SLICES = 1 << 23, 256
#: Partners of a document in the first round.
SEEDS = 3
RANGES = 512
#: Rounds of parting by the suffix filter.
DEPTH = 4
#: Rows of one n-gram that a part of the last join takes.
SPLIT = 512
#: Tasks over which the sums of one slice of the sketch are dealt in a first round.
SUMMED = 64


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles, A-Z taken as a-z."""
    words = wordhash.split(text.lower() if text else text)
    values = wordhash.hashes(words)
    if len(words) >= n:
        return np.unique(wordhash.runs(values, n))
    if not words:
        return values
    return wordhash.mixed(np.bitwise_xor.reduce(wordhash.mixed(values + wordhash.STEP * np.arange(1, len(words) + 1, dtype=np.uint64)), keepdims=True) + np.uint64(len(words)))


def cell(values: np.ndarray) -> np.ndarray:
    return ((values >> np.uint64(13)) & np.uint64(CELLS - 1)).astype(np.int64)


def least_overlap(size_a: Column, size_b: Column, percent: int) -> Column:
    """Whether an overlap can reach the threshold is asked as (100 + percent) * overlap >= percent * (sizes)."""
    return (size_a + size_b) * percent


def sets_and_sketch(docs: DataFrame, n: int) -> DataFrame:
    """Rows of documents (doc_id, n, k1, k2: a 128-bit hash of the set), and of slices of each task's sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, names = np.zeros(CELLS, dtype=np.uint32), ["doc_id", "n", "k1", "k2", "slice", "salt", "counts"]
        salt = 0
        for batch in batches:
            sizes, low, high = [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text, n)
                sizes.append(len(own))
                key = xxhash.xxh3_128_intdigest(own.tobytes()) if len(own) else None
                low.append(None if key is None else (key & (1 << 64) - 1) - (1 << 63))
                high.append(None if key is None else (key >> 64) - (1 << 63))
                np.add.at(counts, cell(own), 1)
                salt = salt * 31 + len(own)
            none = len(sizes)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(none, pa.int32()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())], names=names)
        if salt:
            parts = [zlib.compress(p.tobytes(), 1) for p in np.split(counts, SLICES)]
            ids = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays([ids, ids, ids, ids, pa.array(range(SLICES), pa.int32()), pa.array([salt % SUMMED] * SLICES, pa.int32()), pa.array(parts, pa.binary())], names=names)
        del counts
        let_go()

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, k1 bigint, k2 bigint, slice int, salt int, counts binary")


def step_of(total: float) -> float:
    """A sixteenth of the chance deviation of a cell's count, of `total` in all cells."""
    return max(1.0, (total / CELLS) ** 0.5 / 16)


def hot_step(total: float) -> int:
    """The step from which an n-gram may have more rows than one task should take: `HOT`, or a 200,000th of `total`."""
    return int(min(max(HOT, total / max(BROADCAST_ROWS, 1)) / step_of(total), np.iinfo(np.uint16).max))


def rarity(sketch: DataFrame) -> np.ndarray:
    """Each cell's count, in steps of a sixteenth of its chance deviation: what n-grams are ordered by."""

    size = CELLS // SLICES

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}  # of the slices of one partition: SLICES at most, of a fixed size
        for batch in batches:
            for k, part in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
                raw = np.frombuffer(zlib.decompress(part.as_py()), dtype=np.uint8)
                totals.setdefault(k, np.zeros(size, dtype=np.uint64))[:] += raw.view(np.uint64 if len(raw) == 8 * size else np.uint32)
        for k, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["slice", "counts"])
        totals.clear()
        let_go()

    first = sketch.repartition("slice", "salt").select("slice", "counts").mapInArrow(summed, "slice int, counts binary")
    last = first.repartition("slice").mapInArrow(summed, "slice int, counts binary")
    parts = {r["slice"]: bytes(r["counts"]) for r in last.collect()}  # SLICES rows of CELLS / SLICES counters
    step = step_of(sum(float(np.frombuffer(zlib.decompress(p), dtype=np.uint64).sum()) for p in parts.values()))
    out = np.zeros(CELLS, dtype=np.uint16)
    for k, part in parts.items():
        counts = np.frombuffer(zlib.decompress(part), dtype=np.uint64)
        out[k * size : (k + 1) * size] = np.minimum(counts / step, np.iinfo(np.uint16).max)
    parts.clear()
    let_go()
    return out


def prefixes(docs: DataFrame, order, hot: int, n: int, percent: int) -> DataFrame:
    """(doc_id, n, prefix, cool, ranges): the rarest n-grams of each set, how many of them, the first ones, stand under
    the step `hot`, and the parity of the set's counts by range of the hash."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(order)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, sizes, firsts, cool, ranges = [], [], [], [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = shingles(text, n)
            if not len(own):
                continue
            size = len(own)
            length = size - -(-size * percent // 100) + 1
            steps = shared.value[cell(own)]
            rank = np.argsort(steps, kind="stable")[:length]
            cool.append(int((steps[rank] < hot).sum()))
            ids.append(doc)
            sizes.append(size)
            firsts.append(own[rank].view(np.int64))
            counts = np.bincount((own >> np.uint64(40)).astype(np.int64) % RANGES, minlength=RANGES)
            ranges.append(np.packbits((counts % 2).astype(np.uint8), bitorder="little").view(np.int64))
        if not ids:
            return None
        arrays = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(firsts, pa.list_(pa.int64())), pa.array(cool, pa.int32()), pa.array(ranges, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "prefix", "cool", "ranges"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    return map_batches(rows, work, "doc_id bigint, n bigint, prefix array<bigint>, cool int, ranges array<bigint>")


def sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(doc_id, grams) of the documents in `ids`."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams = [shingles(t, n).view(np.int64) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.list_(pa.int64()))], names=["doc_id", "grams"])

    ids = ids.select("doc_id")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).join(ids, "doc_id", "left_semi")
    return map_batches(rows, work, "doc_id bigint, grams array<bigint>")


def with_partner(grams: DataFrame, total: int, percent: int) -> DataFrame:
    """The rows (gram, rep, n, at, few) of `grams` that may have a partner under their n-gram, which has few rows or many.

    N-grams of few rows take the length filter here, in the one shuffle that tells which n-grams are shared: if
    neither the next smaller nor the next larger set is of about a row's size, no other is. N-grams of many rows
    are counted, and joined back where they are shared.
    """
    of_size = Window.partitionBy("gram").orderBy("n")
    cool = grams.where("at < cool").select("gram", "rep", "n", "at", F.lag("n").over(of_size).alias("less"), F.lead("n").over(of_size).alias("more"))
    cool = cool.where((F.col("less") * 100 >= F.col("n") * percent) | (F.col("n") * 100 >= F.col("more") * percent))
    rows = grams.where("at >= cool")
    met = checkpoint(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("members")).where("members > 1"))
    rows = joined_back(rows, met, ["gram"], total, "members").select("gram", "rep", "n", "at", F.lit(False).alias("few"))
    return cool.select("gram", "rep", "n", "at", F.lit(True).alias("few")).unionByName(rows)


def with_hubs(rows: DataFrame, total: int) -> DataFrame:
    """(a, na, pa, best, own): each of `rows` (gram, rep, n, at, u, few, class) with its n-gram's hub of all and of its class."""
    row, left = F.struct("u", "n", "rep", "at"), [F.col("rep").alias("a"), F.col("n").alias("na"), F.col("at").alias("pa")]
    least = {"best": Window.partitionBy("gram"), "own": Window.partitionBy("gram", "class")}
    calm = rows.where("few").select(*left, *(F.min(row).over(w).alias(c) for c, w in least.items()))
    rows = rows.where("not few")
    hubs = rows.groupBy("gram", "class").agg(F.min(row).alias("hub"), F.count(F.lit(1)).alias("members"))
    hubs = checkpoint(hubs.groupBy("gram").agg(F.min("hub").alias("best"), F.collect_list(F.struct("class", "hub")).alias("hubs"), F.sum("members").alias("members")))
    own = F.filter("hubs", lambda h: h["class"] == F.col("class"))[0]["hub"].alias("own")
    return calm.unionByName(joined_back(rows, hubs, ["gram"], total, "members").select(*left, "best", own))


def undecided(rows: DataFrame, total: int) -> DataFrame:
    """Those of `rows` (gram, rep, n, at, component, few) whose n-gram has several components, with the `largest` of
    them and the n-gram's number of rows, `members`."""
    out = ["gram", "rep", "n", "at", "component", "largest", "members"]
    gram, number = Window.partitionBy("gram"), F.count(F.lit(1))
    calm = rows.where("few").withColumn("size", number.over(Window.partitionBy("gram", "component")))
    calm = calm.withColumns({"members": number.over(gram), "top": F.max(F.struct("size", (-F.col("component")).alias("minus"))).over(gram)})
    calm = calm.where("size < members").withColumn("largest", -F.col("top.minus"))
    rows = rows.where("not few")
    sizes = rows.groupBy("gram", "component").agg(number.alias("size"))
    largest = F.max_by("component", F.struct("size", -F.col("component"))).alias("largest")
    mixed = checkpoint(sizes.groupBy("gram").agg(largest, number.alias("parts"), F.sum("size").alias("members")).where("parts > 1").drop("parts"))
    return calm.select(out).unionByName(joined_back(rows, mixed, ["gram"], total, "members").select(out))


def filtered(pairs: DataFrame, percent: int) -> DataFrame:
    """Length and positional filter on pairs (a, na, pa, b, nb, pb) that share the n-gram at pa and pb.

    The n-gram is taken for the first that both have, so that nothing before it is shared. Linked sets pass at
    the one that is; a further one that they share may fail, which loses no pair.
    """
    low, high = F.least("na", "nb"), F.greatest("na", "nb")
    reach = 1 + F.least(F.col("na") - 1 - F.col("pa"), F.col("nb") - 1 - F.col("pb"))
    return pairs.where((low * 100 >= high * percent) & (reach * (100 + percent) >= least_overlap(F.col("na"), F.col("nb"), percent)))


def may_be_close(a: str, b: str, percent: int) -> Column:
    """The filter by parity on sets of na and nb n-grams with ranges `a` and `b`."""
    odd = sum((F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(1, RANGES // 64)), F.bit_count(F.get(a, F.lit(0)).bitwiseXOR(F.get(b, F.lit(0)))))
    return odd * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)


def least_difference(x: np.ndarray, y: np.ndarray, allowed: int, depth: int = DEPTH) -> int:
    """How many n-grams are in one of the sorted sets x and y alone, at least; exact or over `allowed` is all that counts."""
    gap = abs(len(x) - len(y))
    if not depth or gap > allowed or not len(x) or not len(y):
        return gap
    middle = len(y) // 2
    at = int(np.searchsorted(x, y[middle]))
    both = int(at < len(x) and x[at] == y[middle])
    right = abs(len(x) - at - both - len(y) + middle + 1)
    found = 1 - both + least_difference(x[:at], y[:middle], allowed - right - 1 + both, depth - 1)
    if found + right > allowed:
        return found + right
    return found + least_difference(x[at + both :], y[middle + 1 :], allowed - found, depth - 1)


def links(pairs: DataFrame, counts: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose Jaccard similarity reaches the threshold: parity and suffix filter, then intersection.

    Sets are made again from the texts of the documents that are still in a pair, and of no others.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sides, good = [], []
        for column in (batch.column(2), batch.column(3)):
            values, bounds = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
            sides.append([values[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)])
        for x, y in zip(*sides, strict=True):
            least = -(-percent * (len(x) + len(y)) // (100 + percent))
            allowed = len(x) + len(y) - 2 * least
            good.append(least_difference(x, y, allowed) <= allowed and len(np.intersect1d(x, y, assume_unique=True)) >= least)
        return batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    for side in ("a", "b"):
        pairs = pairs.join(counts.select(F.col("doc_id").alias(side), F.col("n").alias(f"n{side}"), F.col("ranges").alias(f"r{side}")), side)
    pairs = checkpoint(pairs.where(may_be_close("ra", "rb", percent)).select("a", "b"))
    grams = sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), n)
    for side in ("a", "b"):
        pairs = pairs.join(grams.select(F.col("doc_id").alias(side), F.col("grams").alias(f"g{side}")), side)
    return map_batches(pairs.select("a", "b", "ga", "gb"), work, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; links at a Jaccard similarity of percent / 100."""
    scanned = checkpoint(sets_and_sketch(docs, n))
    keyed = scanned.where("slice is null").select("doc_id", "n", "k1", "k2")
    told = keyed.where("n > 0 and doc_id is not null")
    classes = checkpoint(told.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members")))
    rows_told = classes.agg(F.sum("members")).first()[0] or 0
    copies = joined_back(told, classes.where("members > 1"), ["k1", "k2"], rows_told, "members").where("doc_id != rep").select("doc_id").distinct()
    copies = checkpoint(copies.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti"))
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    hot = hot_step(float(told.agg(F.sum("n")).first()[0] or 0))
    order = rarity(scanned.where("slice is not null").select("slice", "salt", "counts"))
    firsts = checkpoint(prefixes(docs, order, hot, n, percent).join(copies, "doc_id", "left_anti"))
    counts = firsts.select("doc_id", "n", "ranges")
    grams = firsts.where("doc_id is not null").select(F.col("doc_id").alias("rep"), "n", "cool", F.posexplode("prefix").alias("at", "gram"))
    total = firsts.agg(F.sum(F.size("prefix"))).first()[0] or 0

    shared = checkpoint(with_partner(grams, total, percent))
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    alone = checkpoint(shared.groupBy("rep", "n").agg(F.count(F.lit(1)).alias("met")).select("rep", (length - F.col("met")).alias("u")))
    shared = checkpoint(attached(shared, alone, ["rep"]).select("gram", "rep", "n", "at", "u", "few"))
    sized = shared.withColumn("class", F.floor(F.log("n") / F.log(F.lit(2 - percent / 100 + 0.01))).cast("int"))
    pairs = with_hubs(sized, total).select("a", "na", "pa", F.explode(F.array_distinct(F.array("best", "own"))).alias("h"))
    pairs = pairs.select("a", "na", "pa", F.col("h.rep").alias("b"), F.col("h.n").alias("nb"), F.col("h.at").alias("pb"))
    most = Window.partitionBy("a").orderBy(F.desc("times"), "b")
    often = filtered(pairs.where("a != b"), percent).groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"))
    often = often.withColumn("place", F.row_number().over(most)).where(F.col("place") <= SEEDS)
    seeds = checkpoint(often.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    known = checkpoint(components(links(seeds, counts, docs, n, percent)))

    rows = attached(shared, known.select(F.col("node").alias("rep"), "component"), ["rep"], "left")
    rows = rows.select("gram", "rep", "n", "at", F.coalesce("component", "rep").alias("component"), "few")
    open_rows = undecided(rows, total)
    open_rows = open_rows.withColumn("parts", F.ceil(F.col("members") / SPLIT))
    open_rows = checkpoint(open_rows.join(counts.select(F.col("doc_id").alias("rep"), "ranges"), "rep"))
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    left = open_rows.where("component != largest").select("gram", part, F.col("rep").alias("a"), F.col("n").alias("na"), F.col("at").alias("pa"), F.col("component").alias("ca"), F.col("ranges").alias("ra"))
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part")
    right = open_rows.select("gram", part, F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("at").alias("pb"), F.col("component").alias("cb"), F.col("ranges").alias("rb"), "largest")
    crossed = left.join(right, ["gram", "part"]).where("ca != cb and (cb = largest or a < b)")
    rest = filtered(crossed, percent).where(may_be_close("ra", "rb", percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = rest.join(seeds, ["a", "b"], "left_anti")
    more = links(rest, counts, docs, n, percent)
    stars = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = components(stars.union(more))

    named = classes.join(final.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    alike = joined_back(told, named.select("k1", "k2", "component", "members"), ["k1", "k2"], rows_told, "members").select("doc_id", "n", "component")
    others = keyed.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component"))
    return alike.union(others).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with the document of the smallest doc_id of each component of near duplicates; null ids stay."""
    found = near_duplicates(docs, n, percent)
    gone = checkpoint(found.where("component_id != doc_id").select("doc_id").distinct())
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return docs.join(gone.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType)), "doc_id", "left_anti").select(docs.columns)

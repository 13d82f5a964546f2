"""Mixing sources to target weights by pivotal dependent rounding of copies, in DataFrame operations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import n_words, name, settled

#: Weights of the sources in their order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: All targets together, as a share of all sizes.
TOTAL = 1.5
#: No source is taken more often than this on average.
CAP = 2.0
#: Documents folded together at a node of the tree, on average and at most.
NODE, NODE_MOST = 64, 256
#: A document with more than one such part of its source's size is rounded before the others.
GIANT = 64


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with ``target``.

    Sources by code point, NULL last, take the weights in turn. A target is the smaller of its cap and a
    common level times its weight, at the level where all targets add up to the total: what sources at
    their cap cannot take is thereby shared by weight among the others. Sources reach their cap in the
    order of cap to weight, so running sums over the source table find the level.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    weighted = sources.withColumn(
        "w", F.get(weights, ((F.row_number().over(ordered) - 1) % len(WEIGHTS)).cast("int"))
    ).withColumn("cap", CAP * F.col("source_size").cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = TOTAL / CAP * F.sum("cap").over(everything)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    leveled = weighted.withColumn("level", left / weight_left)
    # The first source, in that order, whose cap is not reached fixes the level of all after it.
    open_level = F.when(F.col("cap") > F.col("level") * F.col("w"), F.col("level"))
    level = F.first(open_level, ignorenulls=True).over(everything)
    return leveled.withColumn("final", level).select(
        "source",
        "source_size",
        F.least("cap", F.coalesce(F.col("final") * F.col("w"), F.col("cap"))).alias("target"),
    )


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the given values alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


def fold(items: Column, id_type: str) -> Column:
    """Round the fractions of a node's items, two at a time.

    ``items``: structs (s, p, u, key): size, fraction strictly between 0 and 1, random number, row. The
    open item meets the next one: at random, mass moves one way or the other until one of the two is
    whole, so that s * p of both together stays as it is and each p keeps its expectation. Result:
    (c, open, done): the open item, whether it is still open, and (key, bit) of all others.
    """
    first = F.get(items, F.lit(0))
    none = F.array().cast(f"array<struct<key:struct<id:{id_type},sig:bigint,dup:int>,bit:int>>")

    def settle(acc: Column, x: Column) -> Column:
        c = acc.c
        up = F.least(c.s * (1 - c.p), x.s * x.p)  # mass that can go from x to c
        down = F.least(c.s * c.p, x.s * (1 - x.p))  # and from c to x
        rises = x.u * (up + down) < down
        # Which of the two becomes whole, and at which value.
        c_whole = F.when(rises, c.s * (1 - c.p) <= x.s * x.p).otherwise(c.s * c.p <= x.s * (1 - x.p))
        c_bit = F.when(rises, 1).otherwise(0)
        p_c = F.when(rises, c.p + up / c.s).otherwise(c.p - down / c.s)
        p_x = F.when(rises, x.p - up / x.s).otherwise(x.p + down / x.s)
        whole = F.when(c_whole, F.struct(c.key.alias("key"), c_bit.cast("int").alias("bit"))).otherwise(
            F.struct(x.key.alias("key"), (1 - c_bit).cast("int").alias("bit"))
        )
        rest = F.when(
            c_whole, F.struct(x.s.alias("s"), p_x.alias("p"), x.u.alias("u"), x.key.alias("key"))
        ).otherwise(F.struct(c.s.alias("s"), p_c.alias("p"), c.u.alias("u"), c.key.alias("key")))
        # Equal masses, or what rounding leaves of them: both are whole.
        both = (rest.p < 1e-12) | (rest.p > 1 - 1e-12)
        other = F.struct(rest.key.alias("key"), F.when(rest.p < 0.5, 0).otherwise(1).cast("int").alias("bit"))
        met = F.struct(
            rest.alias("c"),
            (~both).alias("open"),
            F.concat(acc.done, F.when(both, F.array(whole, other)).otherwise(F.array(whole))).alias("done"),
        )
        started = F.struct(x.alias("c"), F.lit(True).alias("open"), acc.done.alias("done"))
        return F.when(acc.open, met).otherwise(started)

    start = F.struct(first.alias("c"), F.lit(True).alias("open"), none.alias("done"))
    return F.aggregate(F.slice(items, 2, NODE_MOST), start, settle)


def node_results(items: DataFrame, id_type: str) -> DataFrame:
    """One row per node (source, node): its rounded items and, if one is still open, that item."""
    grouped = items.groupBy("source", "node", "sub").agg(
        # The largest first: the item that is left open tends to be a small one.
        F.sort_array(F.collect_list(F.struct("s", "p", "u", "key")), asc=False).alias("items")
    )
    return grouped.select("source", "node", fold(F.col("items"), id_type).alias("r"))


def with_sub_nodes(items: DataFrame) -> DataFrame:
    """A node that chance or repeated rows made too large becomes several."""
    order = Window.partitionBy("source", "node").orderBy(F.desc("s"), "key")
    return items.withColumn("sub", F.floor((F.row_number().over(order) - 1) / NODE_MOST))


def keyed(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(id, sig, source, size) of rows; ``sig`` is a hash of all columns."""
    return docs.select(
        name(doc_id).alias("id"),
        F.xxhash64(*(name(c) for c in docs.columns)).alias("sig"),
        name(source).alias("source"),
        n_words(name(text)).alias("size"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``dup``, which tells repeated rows apart."""
    return rows.withColumn("dup", F.row_number().over(Window.partitionBy("id", "sig").orderBy("sig")))


def copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0
) -> DataFrame:
    """(id, sig, dup, size, source_size, target, copies) per row: how often the mix takes each document.

    A document of a source is taken target / source_size times on average: the whole part for sure, the
    fraction by pivotal rounding weighted by size. Nodes of a tree round some 64 documents of a source
    each and pass their open one on, so a source of any size is spread over many tasks. The last open one
    is rounded to the nearer value. Giants, fewer than 64 in any source, are rounded first; what their
    last one misses is made up by the fractions of the others. So the taken words miss the target by half
    of a giant's least size, or less than half a document in a source of giants alone.

    NULL text: size 0; documents of size 0 are taken the whole part of times, or once more by a hash.
    NULL is a source of its own. Repeated rows are rounded each for itself. Same input, same result.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    sized = settled(numbered(keyed(docs, doc_id, text, source)), "mixing-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    shares = settled(
        targets(sources.select("source", "source_size")).join(
            sources.select(F.col("source").alias("source_n"), "n"), F.col("source").eqNullSafe(F.col("source_n"))
        ).drop("source_n"),
        "mixing-targets",
    )
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    facts = shares.select(
        F.col("source").alias("source_f"), "source_size", "target", ratio.alias("ratio"), "n",
        F.ceil(F.col("n") / NODE).cast("long").alias("nodes"),
    )
    rows = sized.join(facts, F.col("source").eqNullSafe(F.col("source_f")))
    rows = rows.withColumn("whole", F.floor("ratio").cast("int")).withColumn("fraction", F.col("ratio") - F.floor("ratio"))
    chance = uniform(F.lit(seed), F.col("id"), F.col("sig"), F.col("dup"))
    open_rows = rows.where((F.col("size") > 0) & (F.col("fraction") > 0))
    key = F.struct("id", "sig", "dup").alias("key")
    size, giant = F.col("size").cast("double").alias("s"), F.col("size") * GIANT > F.col("source_size")
    giants = open_rows.where(giant)
    first = node_results(
        giants.select("source", F.lit(0).alias("node"), F.lit(0).alias("sub"), size, F.col("fraction").alias("p"),
                      chance.alias("u"), key),
        id_type,
    )
    first = settled(first, "mixing-giants")
    last_bit = F.when(F.col("r.c.p") >= 0.5, 1).otherwise(0)
    rounded = [
        first.select(F.explode("r.done").alias("d")).select("d.key", "d.bit"),
        first.where("r.open").select("r.c.key", last_bit.alias("bit")),
    ]
    # What the last giant takes too much, over the words of all that are no giants.
    missed = first.where("r.open").select(
        F.col("source").alias("source_m"), (F.col("r.c.s") * (last_bit - F.col("r.c.p"))).alias("excess")
    )
    others = open_rows.where(~giant).groupBy("source").agg(F.sum("size").alias("words"))
    shift = others.join(missed, F.col("source").eqNullSafe(F.col("source_m"))).select(
        F.col("source").alias("source_m"), (F.col("excess") / F.col("words")).alias("shift")
    )
    adjusted = open_rows.where(~giant).join(shift, F.col("source").eqNullSafe(F.col("source_m")), "left")
    fraction = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("fraction") - F.coalesce("shift", F.lit(0.0))))
    adjusted = adjusted.withColumn("p", fraction)
    rounded.append(adjusted.where("p = 0 or p = 1").select(key, F.col("p").cast("int").alias("bit")))
    items = adjusted.where("p > 0 and p < 1").select(
        "source",
        F.pmod(F.xxhash64(F.lit(seed + 1), "id", "sig", "dup"), F.col("nodes")).alias("node"),
        size,
        "p",
        chance.alias("u"),
        key,
    )
    most = shares.agg(F.max("n")).first()[0] or 0
    levels = 1 + math.ceil(math.log(max(most / NODE, 1)) / math.log(NODE) - 1e-9) if most else 0
    for level in range(levels):
        results = settled(node_results(with_sub_nodes(items), id_type), "mixing-level")
        rounded.append(results.select(F.explode("r.done").alias("d")).select("d.key", "d.bit"))
        left = results.where("r.open").select("source", "node", "r.c.*")
        if level < levels - 1:
            items = left.select(
                "source",
                F.floor(F.col("node") / NODE).alias("node"),
                "s",
                "p",
                uniform(F.lit(seed + 2 + level), F.col("key")).alias("u"),
                "key",
            )
        else:
            rounded.append(left.select("key", F.when(F.col("p") >= 0.5, 1).otherwise(0).alias("bit")))
    bits = rounded[0]
    for part in rounded[1:]:
        bits = bits.union(part)
    bits = bits.select(F.col("key.id").alias("id_"), F.col("key.sig").alias("sig_"), F.col("key.dup").alias("dup_"), "bit")
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("sig") == F.col("sig_")) & (F.col("dup") == F.col("dup_"))
    by_hash = F.when((F.col("size") == 0) & (chance < F.col("fraction")), 1).otherwise(0)
    return rows.join(bits, same, "left").select(
        "id", "sig", "dup", "size", "source_size", "target",
        (F.col("whole") + F.coalesce("bit", by_hash)).cast("int").alias("copies"),
    )


def mixed_sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken) per row; ``taken`` counts the words of all copies."""
    found = copies(docs, doc_id, text, source)
    return found.select(
        F.col("id").alias(doc_id), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    columns = docs.columns
    own = docs.select(
        F.struct(*(name(c) for c in columns)).alias("row"), F.xxhash64(*(name(c) for c in columns)).alias("sig")
    ).select("row", "sig", F.col("row").getField(doc_id).alias("id"))
    few = copies(docs, doc_id, text, source).where("copies > 0")
    few = few.select(F.col("id").alias("id_"), F.col("sig").alias("sig_"), F.col("dup").alias("dup_"), "copies")
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("sig") == F.col("sig_")) & (F.col("dup") == F.col("dup_"))
    taken = numbered(own).join(few, same)
    times = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    return taken.select("row", times).select("row.*")

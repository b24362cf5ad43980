"""Mixing of sources to target weights by blocks of words. Only built-in functions.

A source's documents, in order of id, are one sequence of words, cut into blocks of ``block`` words; only its last block
may be shorter. The mix is a row of output shards of about ``shard`` slots, and a slot holds one block. How many
slots of a shard each source gets is drawn: the whole part of the expected number is given, and the slots that the
fractions leave are drawn multinomially with the fractions as weights, so that small tables come near their targets
too. The slots of a source are numbered through all shards; number ``i`` holds the block to which a pseudorandom
permutation, a new one for each pass through the source, takes ``i`` modulo the number of blocks. Slots and the
documents' parts of blocks meet in a join by the number of the block.

A source's slots end after ``most`` passes, so that no document is taken more often; draws beyond are left empty, at
most about the root of the number of shards.

Defined cases: a null text has no words and is taken 0 times, and so is every document of a table without words; a null
source is a source, the last; rows without an id come first in their source; rows that repeat are rows of their own;
a long text is parts of many blocks, each a row; an empty table gives no row. Other columns aren't touched.
Everything random comes from MD5 of the seed and of numbers that the table itself fixes, so that reruns agree.
"""

from __future__ import annotations

from fractions import Fraction
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import as_table, in_order

WORD = "[^\\x20\\x09-\\x0D]+"
#: Words in a block, slots in a shard.
BLOCK, SHARD = 128, 4096
WEIGHTS = (3, 1, 2)
SHARE, MOST = Fraction(3, 2), 2
SEED = "mix"
#: Rounds of the permutation, and the unit of an expected number of slots.
ROUNDS, UNIT = 16, 1 << 20
#: Shards that one row is exploded into at a time, and buckets of the draws' look-up.
SPREAD, BUCKETS = 4096, 4096


class Mix(NamedTuple):
    """``sources``: one row per source with ``number, size, target``; ``slots``: ``number, shard, index, block``; ``parts``:
    ``row, number, block, first, words``, the words of a document in a block; ``documents``: ``row, doc_id, source, size``."""

    sources: DataFrame
    slots: DataFrame
    parts: DataFrame
    documents: DataFrame


def whole(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def hashed(*parts: Column) -> Column:
    """48 bits of MD5 of the parts, as a number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 12), 16, 10).cast("bigint")


def round_keys(n: Column, *key: Column) -> Column:
    """One number below ``n`` for each round of ``permuted``."""
    return F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda r: hashed(*key, r) % n)


def permuted(index: Column, n: Column, keys: Column, *key: Column) -> Column:
    """Where a pseudorandom permutation of the numbers below ``n`` takes ``index``.

    In each round a number ``x`` is paired with ``k - x`` modulo ``n``, and one bit of the hash of the larger one of the
    pair says for both whether they change places. Every round is its own inverse, so that nothing is hit twice,
    whatever ``n`` is.
    """
    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.element_at(keys, r) - x, n)
        digit = F.substring(F.md5(F.concat_ws(":", *key, r, F.greatest(x, other)).cast("binary")), 1, 1)
        return F.when(digit < "8", other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, swap)


def targets(sources: DataFrame, share: Fraction = SHARE, most: int = MOST) -> tuple[DataFrame, int]:
    """``sources`` (``size, weight``) with ``over``, whose quotient by the number returned is the target: ``share`` of all
    sizes by weight, no target above ``most`` times its source's size, what is above shared by weight again.

    A source at its bound stays there, as sharing again only raises the others; every turn of the loop is an aggregate of
    the sources, and two numbers come back.
    """
    total = sources.agg(F.coalesce(F.sum(whole(F.col("size"))), whole(F.lit(0)))).first()[0]
    rest, weights = Fraction(int(total)) * share, None
    bound = whole(F.col("size")) * most

    def above(rest: Fraction, weights: int) -> Column:
        return bound * (weights * rest.denominator) > whole(F.col("weight")) * F.lit(str(rest.numerator)).cast("decimal(38,0)")

    capped = F.lit(False)
    while True:
        found = sources.agg(F.coalesce(F.sum(F.when(capped, bound)), whole(F.lit(0))).alias("bound"),
                            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weights")).first()
        if found["weights"] == weights or not found["weights"]:
            break
        weights, rest = found["weights"], Fraction(int(total)) * share - int(found["bound"])
        capped = ~above(rest, weights)
    weights = weights or 1
    over = F.when(capped, bound * (weights * rest.denominator)).otherwise(
        whole(F.col("weight")) * F.lit(str(rest.numerator)).cast("decimal(38,0)"))
    return sources.withColumn("over", whole(over)), weights * rest.denominator


def plan_sources(sizes: DataFrame, weights: tuple[int, ...], share: Fraction, most: int, block: int,
                 shard: int) -> tuple[DataFrame, int, int]:
    """The sources with ``number, size, target``, ``blocks``, ``given`` slots in each shard and ``tickets`` for the slots
    that are left, with the number of shards and of slots left in all of them."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("size"))
    numbered = in_order(sources, [F.col("source").isNull(), F.col("source")], "mix-sources").withColumnRenamed("before", "number")
    weight = F.element_at(F.lit(list(weights)), (F.col("number") % len(weights) + 1).cast("int")).cast("bigint")
    aimed, under = targets(numbered.withColumn("weight", weight), share, most)
    expected = F.when(F.col("size") > 0, F.expr(
        f"CAST(over * CAST(blocks AS DECIMAL(14,0)) * {UNIT} AS DECIMAL(38,0)) div (CAST(size AS DECIMAL(20,0)) * {under})")).otherwise(F.lit(0))
    aimed = (aimed.withColumn("blocks", F.expr(f"(size + {block - 1}) div {block}"))
             .withColumn("target", (F.col("over").cast("double") / float(under)))
             .withColumn("expected", F.least(expected.cast("bigint"), F.col("blocks") * (most * UNIT))))
    total = int(aimed.agg(F.coalesce(F.sum(whole(F.col("expected"))), whole(F.lit(0)))).first()[0])
    shards = -(-total // (shard * UNIT))
    given = F.expr(f"expected div {max(shards, 1) * UNIT}")
    aimed = aimed.withColumn("given", given).withColumn(
        "tickets", F.expr(f"(expected - given * {max(shards, 1) * UNIT}) div {max(shards, 1)}"))
    aimed = as_table(aimed.drop("over", "weight", "expected"), "mix-plan")
    tickets = int(aimed.agg(F.coalesce(F.sum("tickets"), F.lit(0))).first()[0])
    return aimed, shards, (shards * tickets + UNIT // 2) // UNIT


def drawn_slots(sources: DataFrame, shards: int, left: int, seed: str) -> DataFrame:
    """``number, shard, index`` of the slots that are drawn: each draws a ticket, and its source is looked up among the
    sources' ranges of tickets by buckets of tickets. They come after the given slots of all shards."""
    spark = sources.sparkSession
    ranges = in_order(sources.filter("tickets > 0").select("number", "given", "tickets"), [F.col("number")], "mix-tickets", "tickets")
    total = int(ranges.agg(F.coalesce(F.sum("tickets"), F.lit(0))).first()[0])
    if not total or not left:
        return spark.createDataFrame([], "number bigint, shard bigint, index bigint")
    width = -(-total // BUCKETS)
    ranges = ranges.withColumn("until", F.col("before") + F.col("tickets")).withColumn(
        "bucket", F.explode(F.expr(f"sequence(before div {width}, (until - 1) div {width})")))
    slots = (spark.range(shards).withColumnRenamed("id", "shard")
             .withColumn("n", F.expr(f"(shard + 1) * {left} div {shards} - shard * {left} div {shards}"))
             .filter("n > 0").withColumn("draw", F.explode(F.expr("sequence(1L, n)")))
             .withColumn("ticket", hashed(F.lit(seed), F.lit("draw"), F.col("shard"), F.col("draw")) % total)
             .withColumn("bucket", F.expr(f"ticket div {width}")))
    drawn = slots.join(ranges, "bucket").filter("ticket >= before AND ticket < until").select("number", "given", "shard", "draw")
    ranked = in_order(drawn, [F.col("number"), F.col("shard"), F.col("draw")], "mix-draws")
    first = ranked.groupBy("number").agg(F.min("before").alias("first"))
    return ranked.join(first, "number").select(
        "number", "shard", (F.col("given") * shards + F.col("before") - F.col("first")).alias("index"))


def given_slots(sources: DataFrame, shards: int) -> DataFrame:
    """``number, shard, index`` of the slots that every shard gives a source."""
    spread = sources.filter("given > 0").select("number", "given").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(max(shards - 1, 0) // SPREAD))))
    spread = spread.repartition("number", "part").withColumn("shard", F.explode(F.expr(
        f"sequence(CAST(part * {SPREAD} AS BIGINT), least(part * {SPREAD} + {SPREAD}, {shards}) - 1L)")))
    return (spread.withColumn("k", F.explode(F.expr("sequence(0L, given - 1)")))
            .select("number", "shard", (F.col("shard") * F.col("given") + F.col("k")).alias("index")))


def mix_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST, block: int = BLOCK,
               shard: int = SHARD, seed: str = SEED) -> Mix:
    """The mix of ``docs``. Slots ordered by shard are its order; the text of a slot are its block's parts, in order of
    ``row``: of each the ``words`` words from ``first`` (from 0) on."""
    sizes = as_table(docs.select(
        docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
        F.coalesce(F.regexp_count(docs[text_col], F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.monotonically_increasing_id().alias("row")), "mix-sizes")
    sources, shards, left = plan_sources(sizes, weights, share, most, block, shard)

    order = [F.col("source").isNull(), F.col("source"), F.col("doc_id"), F.col("size"), F.col("row")]
    placed = in_order(sizes, order, "mix-places", "size")
    starts = in_order(sources.select("number", F.col("size").alias("of_source")), [F.col("number")], "mix-starts", "of_source")
    plan = sources.select("source", "number", "blocks").join(starts.select("number", F.col("before").alias("start")), "number")
    plan = plan.withColumnRenamed("source", "of")
    placed = placed.filter("size > 0").join(plan, F.col("source").eqNullSafe(F.col("of"))).withColumn("at", F.col("before") - F.col("start"))
    parts = placed.select("row", "number", "at", "size", F.explode(F.expr(
        f"sequence(at div {block}, (at + size - 1) div {block})")).alias("block"))
    head = F.greatest(F.col("at"), F.col("block") * block)
    tail = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block)
    parts = parts.select("row", "number", "block", (head - F.col("at")).alias("first"), (tail - head).alias("words"))

    slots = given_slots(sources, shards).unionByName(drawn_slots(sources, shards, left, seed))
    blocks = sources.filter("size > 0").select("number", "blocks").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    blocks = blocks.withColumn("keys", round_keys(F.col("blocks"), F.lit(seed), F.col("number"), F.col("turn")))
    turn = F.expr("CAST(index div blocks AS INT)")
    slots = slots.join(sources.select("number", "blocks"), "number").withColumn("turn", turn).filter(F.col("turn") < most)
    slots = slots.join(blocks.drop("blocks"), ["number", "turn"]).withColumn("block", permuted(
        F.col("index") % F.col("blocks"), F.col("blocks"), F.col("keys"), F.lit(seed), F.col("number"), F.col("turn")))
    return Mix(sources.select("number", "source", "size", "target"), slots.select("number", "shard", "index", "block"), parts, sizes)


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source_size, target, taken``; ``taken`` counts the document's words in
    the mix, repeats counted."""
    mix = mix_blocks(docs, id_col, text_col, source_col, **how)
    times = mix.slots.groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = mix.parts.join(times, ["number", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    plan = mix.sources.select(F.col("source").alias("of"), F.col("size").alias("source_size"), "target")
    return (mix.documents.join(plan, F.col("source").eqNullSafe(F.col("of"))).join(taken, "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")))

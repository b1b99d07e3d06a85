"""Mixing sources to target weights, in DataFrame functions only.

Targets: the sources share `total_share` of all words by weight; a target stops at `max_epochs` times its source's words and
the excess is shared by weight again until no target is above.

Draws: each source's documents are hashed into at most `BLOCKS` blocks. A source is taken whole as often as its target holds
it; the rest is filled with its blocks in permuted order, leaving out those that no longer fit. The drawn blocks (block, epoch) are the
source's exact quota. A multivariate-hypergeometric splitting tree hands the quotas to the output shards: each node halves its
shards and draws, source by source, how many of its blocks go left, without replacement, so every shard has its exact number of
blocks and its sources in the proportion of a uniform shuffle. Shards then take disjoint stretches of each source's permuted
blocks, and order their rows by a hash. All draws are hashes of a seed, so reruns agree.

Tables besides the documents' have a row for each source and block. Documents meet them in a join on (source, block), whose
small side is broadcast only if its rows are few; a hot source is spread over its blocks.

Defined cases: null and blank texts have size 0 and are never short of their target; a null source is a source of its own, the
last; rows of equal doc_id fall into one block and are taken equally often; a null doc_id falls into the block of the empty
name; without words all targets are 0; an empty table gives no rows. `mixed` returns all columns of the documents; `takes` writes
the mix and counts the words of its texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.llm.common import n_words, stored
from lexigrid.session import broadcast_if_small

BLOCKS, EPOCHS, SEED = 1024, 3, 7
#: Words of one output shard, about.
SHARD_WORDS = 4_000_000
#: Rows of the block table that may be broadcast, at some 60 bytes.
SMALL = 200_000


def _block(doc_id: Column) -> Column:
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}/"), name)), 1, 8), 16, 10).cast("long"), F.lit(BLOCKS)).cast("int")


def _order(*parts: Column) -> Column:
    return F.md5(F.concat_ws("/", F.lit(str(SEED)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def targets(sources: DataFrame, total_share: float = 1.0, epochs: int = EPOCHS) -> DataFrame:
    """rank, weight and target beside (source, source_size), one row per source.

    With the sources in the order of (cap / weight), those that stop at their cap are a prefix: the shortest one whose
    remaining words, shared by weight, put the next source at or under its cap.
    """
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")))
    ranked = ranked.withColumn("weight", (F.col("rank") - 1) % 3 + 1).withColumn("cap", F.col("source_size").cast("double") * epochs)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(total_share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    leveled = ranked.withColumn("level", level).withColumn("free", F.col("cap") >= F.col("level") * F.col("weight"))
    found = leveled.withColumn("at", F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level")))).over(everything))
    stops = F.col("at").isNull() | (F.struct(F.col("cap") / F.col("weight"), F.col("rank")) < F.struct(F.col("at.col1"), F.col("at.rank")))
    return found.select("source", "source_size", "rank", "weight", F.when(stops, F.col("cap")).otherwise(F.col("weight") * F.col("at.level")).alias("target"))


#: Blocks in order, each taken (1) if it fits in what is left.
_FILL = """aggregate(blocks, named_struct('room', cast(rest AS double), 'out', cast(array() AS array<int>)), (s, b) ->
    named_struct('room', s.room - CASE WHEN b.words <= s.room THEN b.words ELSE 0 END,
                 'out', concat(s.out, array(CASE WHEN b.words <= s.room THEN 1 ELSE 0 END))), s -> s.out)"""


def draws(sized: DataFrame, total_share: float = 1.0, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target, rank, block, times): how often each block is taken."""
    blocks = sized.groupBy("source", "block").agg(F.sum("size").alias("words"))
    sources = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), total_share, epochs)
    renamed = sources.withColumnRenamed("source", "of")
    joined = blocks.join(renamed, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    joined = joined.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # a row per source, of at most BLOCKS entries
    entry = F.struct(_order(F.col("source"), F.col("block")).alias("at"), "block", "words")
    filled = joined.groupBy("source", "source_size", "target", "rank", "whole", "rest").agg(F.array_sort(F.collect_list(entry)).alias("blocks"))
    filled = filled.withColumn("taken", F.expr(_FILL)).select("*", F.explode(F.arrays_zip("blocks", "taken")).alias("e"))
    return filled.select("source", "source_size", "target", "rank", "e.blocks.block", "e.blocks.words", (F.col("whole") + F.col("e.taken")).cast("int").alias("times"))


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "source", n_words(F.col("text")).alias("size"), _block(F.col("doc_id")).alias("block"))


#: One split: state (blocks not yet seen, places left on the left side, blocks sent left by source), drawn block by block.
_SPLIT = """aggregate(items, named_struct('rest', total, 'room', half, 'out', cast(array() AS array<bigint>)), (s, it) ->
    aggregate(sequence(1L, it.n), 0L,
        (x, j) -> x + CASE WHEN shiftrightunsigned(xxhash64({seed}L, node, it.rank, j), 11) / 9007199254740992D * (s.rest - j + 1) < s.room - x THEN 1L ELSE 0L END,
        x -> named_struct('rest', s.rest - it.n, 'room', s.room - x, 'out', concat(s.out, array(x)))),
    s -> s.out)"""


def split_quotas(quotas: DataFrame, depth: int, seed: int = SEED) -> DataFrame:
    """(shard, rank, n): how many of each source's drawn blocks each of 2 ** depth shards takes.

    quotas: (rank, n), one row per source. A node's sources are folded in one row: as many entries as there are sources.
    """
    nodes = quotas.select(F.lit(1).cast("long").alias("node"), F.col("rank").cast("int").alias("rank"), F.col("n").cast("long").alias("n"))
    for _ in range(depth):
        grouped = nodes.filter("n > 0").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("rank", "n"))).alias("items"), F.sum("n").alias("total"))
        drawn = grouped.withColumn("half", F.expr("(total + 1) div 2")).withColumn("left", F.expr(_SPLIT.format(seed=seed)))
        each = drawn.select("node", F.explode(F.arrays_zip("items", "left")).alias("e")).select("node", "e.items.rank", "e.items.n", "e.left")
        sides = F.array(F.struct((2 * F.col("node")).alias("node"), F.col("left").alias("n")), F.struct((2 * F.col("node") + 1).alias("node"), (F.col("n") - F.col("left")).alias("n")))
        nodes = each.select("rank", F.explode(sides).alias("s")).select("s.node", "rank", "s.n")
    return nodes.filter("n > 0").select((F.col("node") - (1 << depth)).cast("int").alias("shard"), "rank", "n")


def placed_blocks(drawn: DataFrame, depth: int) -> DataFrame:
    """(source, block, epoch, shard): each source's permuted blocks, cut into the shards' quotas."""
    each = drawn.filter("times > 0").select("source", "rank", "block", F.explode(F.expr("sequence(1, times)")).alias("epoch"))
    place = Window.partitionBy("rank").orderBy(_order(F.col("epoch"), F.col("source"), F.col("block")), "epoch", "block")
    each = each.withColumn("place", F.row_number().over(place))
    quotas = split_quotas(each.groupBy("rank").agg(F.count(F.lit(1)).alias("n")), depth)
    upto = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    stretch = quotas.withColumn("to", F.sum("n").over(upto)).select(F.col("rank").alias("r"), "shard", (F.col("to") - F.col("n")).alias("from"), "to")
    return each.join(stretch, (F.col("rank") == F.col("r")) & (F.col("place") > F.col("from")) & (F.col("place") <= F.col("to"))).select("source", "block", "epoch", "shard")


def _dealt(docs: DataFrame, drawn: DataFrame, depth: int | None) -> DataFrame:
    """The documents' columns, a row for each time that a document's block is drawn, dealt to shards and shuffled within them."""
    if depth is None:
        taken = drawn.agg(F.sum(F.col("words") * F.col("times"))).first()[0] or 0
        depth = max(0, int(taken // SHARD_WORDS).bit_length())
    by_block = placed_blocks(drawn, depth).groupBy("source", "block").agg(F.collect_list(F.struct("epoch", "shard")).alias("_takes"))
    small = broadcast_if_small(stored(by_block, "placed").withColumnsRenamed({"source": "_of", "block": "_in"}), SMALL)
    # rows travel whole, so that no column of theirs meets one made here
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["source"].alias("source"), _block(docs["doc_id"]).alias("block"))
    both = rows.join(small, F.col("source").eqNullSafe(F.col("_of")) & (F.col("block") == F.col("_in")))
    each = both.select("row", F.explode("_takes").alias("take"))
    shuffled = _order(F.col("row.doc_id"), F.col("take.epoch"))
    return each.repartition(1 << depth, F.col("take.shard")).sortWithinPartitions(F.col("take.shard"), shuffled).select("row.*")


def mixed(docs: DataFrame, total_share: float = 1.0, epochs: int = EPOCHS, depth: int | None = None) -> DataFrame:
    """The mix: the documents' columns, a row for each time a document is taken, dealt to shards and shuffled within them."""
    return _dealt(docs, stored(draws(stored(sizes(docs), "sizes"), total_share, epochs), "draws"), depth)


def takes(docs: DataFrame, total_share: float = 1.0, epochs: int = EPOCHS, depth: int | None = None) -> DataFrame:
    """Every row's doc_id, source, size, source_size, target and taken (words in the written mix, repeats counted).

    Rows of equal doc_id, source and size are taken equally often, so the mix's words of such rows are theirs in equal parts.
    """
    sized = stored(sizes(docs), "sizes")
    drawn = stored(draws(sized, total_share, epochs), "draws")
    mix = stored(_dealt(docs.select("doc_id", "source", "text"), drawn, depth), "mix")
    same = ["doc_id", "source", "size"]
    given = sized.select(*same, F.lit(1).alias("given"), F.lit(0).alias("words"))
    found = mix.select(F.col("doc_id").cast("long"), "source", n_words(F.col("text")).alias("size")).select(*same, F.lit(0).alias("given"), F.col("size").alias("words"))
    counted = given.unionByName(found).groupBy(*same).agg(F.sum("given").alias("given"), F.sum("words").alias("words"))
    counted = counted.select(*[F.col(c).alias(f"_{c}") for c in same], F.expr("words div given").alias("taken"))
    small = broadcast_if_small(drawn.select(F.col("source").alias("of"), F.col("block").alias("in"), "source_size", "target"), SMALL)
    both = sized.join(small, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("in")))
    both = both.join(counted, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")))
    return both.select("doc_id", "source", "size", "source_size", "target", "taken")

"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets come from the sources' sizes and weights. A source's documents are dealt by hash into
blocks in a random order of their own; what the mix takes of a source is whole passes over its
blocks and then the first blocks of one more pass, the last one in part. The drawn blocks are
tickets in an urn per source. A binary tree over the output shards splits the urns: at each node
the tickets are ordered at random and an exact half goes left, so each side's counts by source
follow a multivariate hypergeometric law. The leaves' counts are the shards' quotas. Each quota
is filled with consecutive blocks of the source's permutation (disjoint by construction), and
rows are shuffled inside the shard.

The number of blocks is bounded per source, so that windows and the tree run over tickets and
never over documents: a source with a third of all rows is only more rows per block. A row is
placed by its id and a digest of its text, so rows without an id or with one id in common are
dealt like others. Rows equal in both are copies: they stand at one place, and where the last
pass ends among them it takes a number of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigscore.llm._common import materialise, n_words, table

WEIGHTS = (5, 2, 1)       # by the source's place in code point order, repeating, null last
SHARE_PERCENT = 150       # all targets together, of all sizes
MOST_PASSES = 2           # a target is at most so many times its source's size
BLOCKS_PER_SOURCE = 1024  # blocks are the unit of the tree; parts of a block end a pass
SHARDS = 16
SEED = 17
BROADCAST_BLOCKS = 100_000  # rows of the block plan that may be broadcast; a join beyond


def _key(*cols) -> Column:
    return F.xxhash64(F.lit(SEED), *cols)


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size): every source gets its weight's
    part of the budget, cut at MOST_PASSES times its size, and what is cut is dealt again by
    weight to the others until none is above.

    With the ratio cap / weight ascending, exactly a prefix of the sources is cut. With running
    sums of caps and weights the level of the rest follows for every prefix at once, so no
    iteration is needed. The order of sources is global: one row per source, not per document.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS)))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), place + 1).cast("double")
    w = sizes.withColumn("weight", weight).withColumn(
        "cap", (F.col("source_size") * MOST_PASSES).cast("double"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    upto = rising.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum(F.col("source_size")).over(everything).cast("double") * SHARE_PERCENT / 100
    w = (w.withColumn("left", budget - F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
         .withColumn("weights", F.sum("weight").over(everything)
                     - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
         .withColumn("share", F.col("left") / F.col("weights"))
         .withColumn("cut", F.col("share") * F.col("weight") >= F.col("cap")))
    # the level is that of the first source that is not cut
    level = F.min_by("share", F.when(~F.col("cut"), F.col("cap") / F.col("weight"))).over(everything)
    target = F.when(F.col("cut") | level.isNull(), F.col("cap")).otherwise(
        F.least(level * F.col("weight"), F.col("cap")))
    return w.select("source", "source_size", target.alias("target"))


def _passes(blocks: DataFrame) -> DataFrame:
    """Per block the whole passes and the words that the last pass takes from it, from
    (source, block, block_size, source_size, target). Blocks are ordered by hash."""
    order = Window.partitionBy("source").orderBy(_key("source", "block"), "block")
    b = (blocks.withColumn("pos", F.row_number().over(order).cast("long"))
         .withColumn("before", F.sum("block_size").over(order) - F.col("block_size"))
         .withColumn("whole", F.when(F.col("source_size") > 0,
                                     F.floor(F.col("target") / F.col("source_size"))).otherwise(0)))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    want = F.least(F.greatest(rest - F.col("before"), F.lit(0.0)), F.col("block_size").cast("double"))
    return b.withColumn("want", want)


def _split(tickets: DataFrame, shards: int) -> DataFrame:
    """Assigns each ticket to a shard by the splitting tree: at every node of m shards, the
    tickets are drawn in random order and m_left / m of them, exactly rounded, go left."""
    node = tickets.withColumn("lo", F.lit(0)).withColumn("hi", F.lit(shards))
    depth = 0
    while 2 ** depth < shards:
        urn = Window.partitionBy("lo", "hi")
        drawn = F.row_number().over(urn.orderBy(_key(F.lit(depth), "source", "copy", "pos"),
                                                "source", "copy", "pos"))
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        quota = F.floor(F.count("*").over(urn) * (F.col("mid") - F.col("lo"))
                        / (F.col("hi") - F.col("lo")))
        node = (node.withColumn("mid", mid).withColumn("drawn", drawn).withColumn("quota", quota)
                .withColumn("left", (F.col("hi") - F.col("lo") > 1) & (F.col("drawn") <= F.col("quota")))
                .withColumn("lo", F.when((F.col("hi") - F.col("lo") > 1) & ~F.col("left"), F.col("mid"))
                            .otherwise(F.col("lo")))
                .withColumn("hi", F.when(F.col("left"), F.col("mid")).otherwise(F.col("hi")))
                .drop("mid", "drawn", "quota", "left"))
        depth += 1
    return node.groupBy("source", F.col("lo").alias("shard")).agg(F.count("*").alias("quota"))


def _plan_blocks(rows: DataFrame, shards: int) -> DataFrame:
    """(source, block, source_size, target, whole, want, block_size, places) of every block;
    ``places`` lists (copy, shard) for each time the block is drawn."""
    blocks = materialise(rows.groupBy("source", "block").agg(
        F.sum("size").alias("block_size")), "mix_blocks")
    targets = source_targets(
        blocks.groupBy("source").agg(F.sum("block_size").alias("source_size")))
    planned = blocks.alias("b").join(
        targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select(
        "b.source", "block", "block_size", "source_size", "target")
    planned = materialise(_passes(planned), "mix_passes")
    times = (F.col("whole") + F.when(F.col("want") > 0, 1).otherwise(0)).cast("int")
    tickets = planned.where(times > 0).select(
        "source", "pos", "block", F.explode(F.sequence(F.lit(1), times)).alias("copy"))
    # each quota is filled with the next tickets of the source, in the order of passes and
    # permuted blocks
    by_shard = Window.partitionBy("source").orderBy("shard")
    quotas = _split(tickets, shards).withColumn("until", F.sum("quota").over(by_shard))
    by_pass = Window.partitionBy("source").orderBy("copy", "pos")
    ranked = tickets.withColumn("ticket", F.row_number().over(by_pass))
    placed = ranked.alias("r").join(
        quotas.alias("q"), F.col("r.source").eqNullSafe(F.col("q.source"))
        & (F.col("ticket") > F.col("until") - F.col("quota"))
        & (F.col("ticket") <= F.col("until"))).groupBy(
        F.col("r.source").alias("source"), "block").agg(
        F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("places"))
    none = F.array().cast("array<struct<copy:int,shard:int>>")
    return materialise(planned.alias("p").join(
        placed.alias("a"), F.col("p.source").eqNullSafe(F.col("a.source"))
        & (F.col("p.block") == F.col("a.block")), "left").select(
        "p.source", "p.block", "source_size", "target", "whole", "want", "block_size",
        F.coalesce("places", none).alias("places")), "mix_blocks_placed")


def _digest(text: Column) -> Column:
    """64 bits of a text; null counts as empty."""
    return F.xxhash64(F.lit(SEED), F.coalesce(text, F.lit("")))


def _block(doc_id, digest) -> Column:
    return F.pmod(_key(doc_id, digest), F.lit(BLOCKS_PER_SOURCE))


def _cell(doc_id, digest) -> Column:
    return F.pmod(_key(F.lit("cell"), doc_id, digest), F.lit(BLOCKS_PER_SOURCE))


def _turn(doc_id, digest) -> Column:
    return _key(F.lit("turn"), doc_id, digest)


def _cuts(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """For each block that the last pass takes in part, the place where it ends: whole cells
    below ``cut_cell``, in that cell the rows whose turn is below ``cut_turn``, and ``cut_take``
    of the ``cut_copies`` rows of that turn. A row at the end is taken when that brings the words
    nearer to the wanted. A cell is a thousandth of a block, and copies are counted before the
    window, so it holds a millionth of a source's different rows."""
    partly = plan.where((F.col("want") > 0) & (F.col("want") < F.col("block_size")))
    same = F.col("x.source").eqNullSafe(F.col("p.source")) & (F.col("x.block") == F.col("p.block"))
    rows = sized.alias("x").join(partly.alias("p"), same).select(
        "x.source", "x.block", "x.size", "want", _cell("x.doc_id", "x.digest").alias("cell"),
        _turn("x.doc_id", "x.digest").alias("turn"))
    order = Window.partitionBy("source", "block").orderBy("cell")
    cells = rows.groupBy("source", "block", "cell", "want").agg(F.sum("size").alias("cell_size"))
    cells = cells.withColumn("rest", F.col("want") - (F.sum("cell_size").over(order)
                                                      - F.col("cell_size")))
    cells = cells.where((F.col("rest") > 0) & (F.col("rest") <= F.col("cell_size")))
    same = (F.col("x.source").eqNullSafe(F.col("c.source")) & (F.col("x.block") == F.col("c.block"))
            & (F.col("x.cell") == F.col("c.cell")))
    inside = rows.alias("x").join(cells.alias("c"), same).groupBy(
        "x.source", "x.block", "x.cell", "turn", "x.size", "rest").agg(F.count("*").alias("copies"))
    upto = Window.partitionBy("source", "block", "cell").orderBy("turn", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    left = F.col("rest") - F.coalesce(F.sum(F.col("size") * F.col("copies")).over(upto), F.lit(0))
    inside = inside.withColumn("left", left)
    nearest = F.floor(F.col("left") / F.nullif(F.col("size"), F.lit(0)) + 0.5)
    take = F.coalesce(F.greatest(F.least(nearest, F.col("copies")), F.lit(0)),
                      F.when(F.col("left") >= 0, F.col("copies")).otherwise(0))
    end = F.max(F.when(F.col("take") > 0, F.struct("turn", "take", "copies")))
    return inside.withColumn("take", take).groupBy("source", "block").agg(
        F.min("cell").alias("cut_cell"), end.alias("end")).select(
        "source", "block", "cut_cell", F.col("end.turn").alias("cut_turn"),
        F.col("end.take").alias("cut_take"), F.col("end.copies").alias("cut_copies"))


def plan_mix(docs: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(sizes, plan). ``sizes`` has doc_id, source, size, digest and block of every row; ``plan``
    has one row per (source, block) with the source's size and target, the block's ``places``
    (copy, shard) and where its last pass ends.

    Null and blank texts have size 0; such rows are taken with their block. Null is a source of
    its own, the last one. Rows with a null id, or with one id and different texts, are rows like
    others. Repeated rows (same id, text and source) fall into one block and count each; where a
    pass ends among them, as many are taken as come nearest to the target. An empty table gives
    an empty plan, and a source without words gets target 0.
    """
    sized = materialise(docs.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"),
        _digest(F.col("text")).alias("digest")).withColumn(
        "block", _block("doc_id", "digest")), "mix_sizes")
    plan = _plan_blocks(sized, shards)
    cuts = _cuts(sized, plan)
    same = F.col("p.source").eqNullSafe(F.col("c.source")) & (F.col("p.block") == F.col("c.block"))
    plan = plan.alias("p").join(cuts.alias("c"), same, "left").select(
        "p.*", "cut_cell", "cut_turn", "cut_take", "cut_copies")
    return sized, materialise(plan, "mix_plan")


def _numbered(copies: DataFrame) -> DataFrame:
    """Adds ``nth``, from 1, over the rows of a (source, block). Rows are numbered inside each
    written part and the parts' counts summed up, so a hot group is never sorted in one task."""
    held = materialise(copies.withColumn("at", F.monotonically_increasing_id()), "mix_copies")
    held = held.withColumn("part", F.shiftright("at", 33))
    order = Window.partitionBy("source", "block").orderBy("part")
    counts = held.groupBy("source", "block", "part").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(order) - F.col("n"))
    inside = Window.partitionBy("source", "block", "part").orderBy("at")
    same = (F.col("x.source").eqNullSafe(F.col("c.source")) & (F.col("x.block") == F.col("c.block"))
            & (F.col("x.part") == F.col("c.part")))
    return held.withColumn("in_part", F.row_number().over(inside)).alias("x").join(
        counts.alias("c"), same).select(
        *[f"x.{c}" for c in copies.columns], (F.col("in_part") + F.col("before")).alias("nth"))


def _with_places(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Joins the plan to rows that have doc_id, source, digest and block, and leaves out the last
    copy of rows behind the end of the last pass. The plan has BLOCKS_PER_SOURCE rows per source;
    it is broadcast when a count says that it is small, and joined by hash beyond. Only where a
    pass ends among equal rows are these numbered."""
    split = F.col("cut_take") < F.col("cut_copies")
    divided = not plan.where(split).isEmpty()
    if plan.count() <= BROADCAST_BLOCKS:
        plan = F.broadcast(plan)
    same = F.col("x.source").eqNullSafe(F.col("p.source")) & (F.col("x.block") == F.col("p.block"))
    joined = rows.alias("x").join(plan.alias("p"), same).select(
        "x.*", "source_size", "target", "whole", "places", "cut_cell", "cut_turn", "cut_take",
        "cut_copies", _cell("x.doc_id", "x.digest").alias("cell"),
        _turn("x.doc_id", "x.digest").alias("turn"))
    last = F.coalesce((F.col("cell") == F.col("cut_cell")) & (F.col("turn") == F.col("cut_turn"))
                      & split, F.lit(False))
    nth = F.lit(1).cast("long").alias("nth")
    if divided:
        joined = joined.where(~last).select("*", nth).unionByName(_numbered(joined.where(last)))
    else:
        joined = joined.select("*", nth)
    reached = F.col("cut_cell").isNull() | (F.col("cell") < F.col("cut_cell")) | (
        (F.col("cell") == F.col("cut_cell")) & F.coalesce(
            (F.col("turn") < F.col("cut_turn")) | (
                (F.col("turn") == F.col("cut_turn")) & (F.col("nth") <= F.col("cut_take"))),
            F.lit(False)))
    places = F.when(reached, F.col("places")).otherwise(
        F.filter("places", lambda p: p["copy"] <= F.col("whole")))
    return joined.select(*rows.columns, "source_size", "target", places.alias("places"))


def mix_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The mixed corpus: the input's columns, a row for each time that it is taken, dealt to the
    shards of the tree and shuffled inside them. Large shards are dealt over several partitions
    at random, which leaves every order as likely as before. Copies of one row stand together.
    Columns of any name may be there: a row's own columns travel in one struct."""
    _, plan = plan_mix(docs, shards)
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source",
                       _digest(F.col("text")).alias("digest")).withColumn(
        "block", _block("doc_id", "digest"))
    mixed = _with_places(rows, plan).select(
        "row", "doc_id", "digest", F.explode("places").alias("place"))
    mixed = mixed.select("row", F.col("place.shard").alias("shard"),
                         _key(F.lit("order"), "doc_id", "digest", "place.copy").alias("order"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.col("order"), F.lit(max(1, parts // shards)))
    mixed = mixed.repartition(parts, F.col("shard"), part).sortWithinPartitions("shard", "order")
    return mixed.select("row.*")


def op4(spark, sf_dir):
    sized, plan = plan_mix(table(spark, sf_dir, "documents"))
    return _with_places(sized, plan).select(
        "doc_id", "size", "source_size", "target",
        (F.size("places") * F.col("size")).cast("long").alias("taken"), "places")

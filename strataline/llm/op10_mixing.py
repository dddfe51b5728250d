"""Mixing sources to target weights by a low-discrepancy schedule.

Targets come from weights with a cap on repeats. Each source's documents, shuffled by hash, form one stream of words
that is cut into equal blocks. The van der Corput points of the slots 0 .. 2**k - 1 are mapped through the cumulative
weights: the points ``i / 2**k`` that fall to a source are a run of integers i, and the slot of a point is i with its
k bits reversed. So every source appears evenly over the schedule and its number of slots misses its exact share by
less than one. Slots are ranked per source in schedule order, and rank r takes the block r modulo the number of
blocks: a block comes again only after all others have.

Ranks and positions in a source need no task that holds a source: both number inside small buckets (stretches of the
schedule, ranges of the shuffle hash) and add the bucket's offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .shared import only, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
LEAST_BLOCK, MOST_BLOCK = 16, 1024
BLOCKS_WANTED = 1 << 24
HASH_BUCKET_BITS = 12
MOST_TASKS = 10_000
STRETCH = 1 << 16  # slots of a stretch of the schedule, and points of a task's share


def sizes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          source_column: str = "source") -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words; null text: 0) and ``shuffle`` (the hash that orders a source)."""
    return only(docs, [id_column, text_column, source_column]).select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{source_column}`").alias("source"),
        F.coalesce(F.regexp_count(f"`{text_column}`", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(f"`{id_column}`", F.lit("/"), f"`{text_column}`").alias("shuffle"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source``, ``rank`` (by code point, null last), ``weight``, ``source_size``, ``target``.

    All sizes are shared by weight; a target stops at ``max_repeats`` times its source's size and the excess is
    shared again among the others. That ends where every open source has the same level of target to weight, and
    sources are closed in the order of cap to weight, so one pass over the sorted sources finds it. The windows
    here run over one row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * max_repeats
    order = Window.orderBy(cap / F.col("weight"), "rank")
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    levels = (
        ranked
        .withColumn("open_words", F.sum("source_size").over(all_rows) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("open_words") / F.col("open_weight"))
        # The first source whose cap lies at or above its share sets the level for itself and all after it.
        .withColumn("final_level", F.min(F.when(F.col("level") * F.col("weight") <= cap, F.struct(cap / F.col("weight"), F.col("rank"), F.col("level")))).over(all_rows)["level"])
    )
    return levels.select(
        "source", "rank", "weight", "source_size",
        F.least(cap.cast("double"), F.coalesce(F.col("final_level") * F.col("weight"), cap.cast("double"))).alias("target"))


def block_size(total_words: int) -> int:
    """Words of a block: about ``BLOCKS_WANTED`` blocks for the corpus, within fixed bounds."""
    return min(MOST_BLOCK, max(LEAST_BLOCK, total_words // BLOCKS_WANTED))


def schedule(shares: DataFrame, block: int, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``slot``, ``rank`` (of the source), ``turn`` (rank of the slot within its source), ``block_no``."""
    running = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    counted = (
        shares.where("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block))
        # Blocks wanted: the target over the mean size of the source's blocks, of which the last may be short.
        .withColumn("wanted", F.col("target") * F.col("blocks") / F.col("source_size"))
        .withColumn("upto", F.sum("wanted").over(running))
    )
    high = F.ceil("upto")
    ranges = stored(counted.select("rank", "blocks", F.ceil(F.col("upto") - F.col("wanted")).alias("raw_low"), high.alias("high")).withColumn(
        "low", F.coalesce(F.lag("high").over(Window.orderBy("rank")), F.lit(0))), "ranges")
    top = ranges.agg(F.max("high")).first()[0] or 0
    bits = max(1, (max(1, top) - 1).bit_length())
    chunked = ranges.where("low < high").select(
        "rank", "blocks", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") / STRETCH), F.floor((F.col("high") - 1) / STRETCH))).alias("chunk"))
    # A fixed number of tasks: by its few bytes Spark would make one task of what unfolds to all points.
    tasks = min(MOST_TASKS, max(1, top // (4 * STRETCH)))
    points = chunked.repartition(tasks, "rank", "chunk").select("rank", "blocks", F.explode(F.sequence(
        F.greatest("low", F.col("chunk") * STRETCH),
        F.least(F.col("high"), (F.col("chunk") + 1) * STRETCH) - 1)).alias("point"))
    # Stored, so that joins are planned by the size the points have and not by that of the ranges they come from.
    slots = stored(points.select("rank", "blocks", F.conv(
        F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long").alias("slot")).withColumn(
            "stretch", F.floor(F.col("slot") / STRETCH)), "slots")
    inside = Window.partitionBy("rank", "stretch").orderBy("slot")
    numbered = slots.withColumn("number", F.row_number().over(inside) - 1)
    counts = slots.groupBy("rank", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("rank").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("rank", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    return (
        numbered.join(offsets, ["rank", "stretch"]).withColumn("turn", F.col("earlier") + F.col("number"))
        .where(F.col("turn") < F.col("blocks") * max_repeats)
        .select("slot", "rank", "turn", (F.col("turn") % F.col("blocks")).alias("block_no"))
    )


def placed(sized: DataFrame, shares: DataFrame) -> DataFrame:
    """Documents with the ``position`` of their first word in their source's shuffled stream."""
    with_share = sized.join(
        shares.withColumnRenamed("source", "share_source"), F.col("source").eqNullSafe(F.col("share_source"))
    ).drop("share_source").withColumn("bucket", F.shiftright("shuffle", 64 - HASH_BUCKET_BITS))
    buckets = with_share.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("rank", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("rank", "bucket").orderBy("shuffle", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    return with_share.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, ["rank", "bucket"]).withColumn("position", F.col("earlier") + F.col("before")).drop(
            "bucket", "earlier", "before")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
        block: int | None = None, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source") -> DataFrame:
    """One row per input row: ``doc_id``, ``source``, ``shuffle``, ``size``, ``source_size``, ``target`` (words its
    source should give), ``taken`` (words of the document in the mix, repeats counted) and ``slots`` (ascending slots of
    the first block that takes words of it, null if none does).

    Null, empty and blank texts have size 0 and give nothing. A null source is a source of its own, last in order.
    No block, hence no document, is taken more than ``max_repeats`` times. The result depends on ids, texts and
    sources alone, so reruns agree; rows equal in all of these are interchangeable. An empty table gives no rows;
    other columns are ignored.
    """
    rows, pieces, slots = _joined(docs, weights, max_repeats, block, id_column, text_column, source_column)
    uses = stored(slots.groupBy("rank", "block_no").agg(
        F.count("*").alias("uses"), F.array_sort(F.collect_list("slot")).alias("slots")), "uses")  # max_repeats at most
    # A document with words has its position in its source for itself.
    taken = pieces.join(uses, ["rank", "block_no"]).groupBy("rank", "position").agg(
        F.sum(F.col("words") * F.col("uses")).alias("taken"), F.min(F.struct("block_no", "slots")).alias("first"))
    columns = ["doc_id", "source", "shuffle", "size", "source_size", "target"]
    filled = rows.where("size > 0").join(stored(taken, "taken"), ["rank", "position"], "left").select(
        *columns, F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first.slots")
    return filled.union(rows.where("size = 0").select(
        *columns, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("array<long>").alias("slots")))


def _joined(docs: DataFrame, weights: tuple[int, ...], max_repeats: int, block: int | None, id_column: str,
            text_column: str, source_column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their positions, their pieces by block, and the schedule."""
    sized = stored(sizes(docs, id_column, text_column, source_column), "sizes")
    shares = stored(targets(sized, weights, max_repeats), "shares")
    block = block or block_size(shares.agg(F.sum("source_size")).first()[0] or 0)
    rows = stored(placed(sized, shares), "placed")
    start = F.greatest(F.col("position"), F.col("block_no") * block)
    pieces = rows.where("size > 0").select(
        "doc_id", "source", "rank", "position", "size",
        F.explode(F.sequence(F.floor(F.col("position") / block),
                             F.floor((F.col("position") + F.col("size") - 1) / block))).alias("block_no"),
    ).select("doc_id", "source", "rank", "position", "block_no", (start - F.col("position")).alias("begin"), (
        F.least(F.col("position") + F.col("size"), (F.col("block_no") + 1) * block) - start).alias("words"))
    return rows, pieces, schedule(shares, block, max_repeats)


def mixed_blocks(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
                 block: int | None = None, id_column: str = "doc_id", text_column: str = "text",
                 source_column: str = "source") -> DataFrame:
    """The mix as its blocks: one row per slot of the schedule and document piece in the block it takes, with ``slot``,
    ``source``, ``doc_id``, ``begin`` (the piece's first word in the document) and ``words``. By slot and position this is
    the mix in the order of the schedule. Rows, nulls and repeats as in ``mix``."""
    _, pieces, slots = _joined(docs, weights, max_repeats, block, id_column, text_column, source_column)
    return slots.select("slot", "rank", "block_no").join(pieces, ["rank", "block_no"]).select(
        "slot", "source", "doc_id", "position", "begin", "words")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
                    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The mix itself, in the columns of ``docs``: a document comes once for each whole time its words are taken, and
    once more with the first words that are taken beyond that, joined by a space. What is not taken goes.

    Rows come in the order of the schedule: copy k of a document stands at the slot of the k-th use of its first block;
    partitions hold consecutive stretches of slots, each sorted.
    """
    words = mix(docs, weights, max_repeats, None, id_column, text_column, source_column)
    plan = stored(words.groupBy("doc_id", "shuffle").agg(
        F.sum("taken").alias("taken"), F.min("size").alias("size"), F.count("*").alias("rows"),
        F.min("slots").alias("slots")).where("taken > 0"), "plan")
    # The columns of docs bear neutral names inside, so none can clash with those of the plan.
    inside = [f"_c{i}" for i in range(len(docs.columns))]
    identity, body = (inside[docs.columns.index(c)] for c in (id_column, text_column))
    keyed = docs.toDF(*inside).withColumn("key", F.xxhash64(identity, F.lit("/"), body))
    joined = keyed.join(plan, F.col(identity).eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("shuffle")))
    # Rows equal in id and text share a plan, so one of them stands for all.
    once = joined.where("rows = 1").unionByName(joined.where("rows > 1").dropDuplicates([identity, "key"]))
    whole, rest = F.floor(F.col("taken") / F.col("size")), F.col("taken") % F.col("size")
    copies = once.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), whole)))
    first_words = F.array_join(F.slice(F.regexp_extract_all(body, F.lit(f"({WORD})"), 1), 1, rest.cast("int")), " ")
    placed_at = F.element_at("slots", F.least(F.col("copy") + 1, F.size("slots")).cast("int"))
    taken = copies.where((F.col("copy") < whole) | (rest > 0)).withColumn(
        body, F.when(F.col("copy") < whole, F.col(body)).otherwise(first_words)).select(*inside, placed_at.alias("slot"))
    # Slots are spread evenly, so equal stretches of them are even partitions; no sample of the rows is needed.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = (plan.agg(F.max(F.array_max("slots"))).first()[0] or 0) + 1
    stretch = F.floor(F.col("slot") * parts / most).cast("int")
    return taken.repartitionById(parts, stretch).sortWithinPartitions("slot").select(*inside).toDF(*docs.columns)

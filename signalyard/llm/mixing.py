"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, in a shuffled order, are one stream of words, cut into
equal blocks.  The mix is a schedule of slots: slot i has a point in [0, 1), the
golden-ratio sequence, which falls into one source's share of the cumulative
weights; the slot takes that source's next block, beginning again when the
stream is used up.  Any run of slots holds each source close to its share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from signalyard.llm.common import cut, parts_for, text_or_empty

#: Words in a block, relative weights in source order, most epochs of a source.
BLOCK_WORDS = 1024
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3

# Fixed-point golden ratio: _STEP / _ONE is its fraction; odd, so that i * _STEP
# runs through all of 0.._ONE-1.
_ONE = 1 << 31
_STEP = 1327217885
#: Slots ranked together, documents placed together.
_CHUNK_SLOTS = 8192
_BUCKET_DOCS = 1024


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """no, source, source_size, weight, target of each source in ``sizes``
    (source, size; one row a document).

    Sources, by code point with null last, have the weights in turn.  Targets
    share the words of all sources by weight but stop at ``most_epochs`` times
    their source's words; the rest shares what is left over.  The windows run
    over one row per source."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = by_source.withColumn("no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    cap = most_epochs * F.col("source_size")
    weighed = numbered.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("no") % len(weights) + 1).cast("int")))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "no").rowsBetween(Window.unboundedPreceding, -1)
    # By cap per weight, a source is at its cap if its share of what those before
    # it leave over is more than the cap.
    ranked = (weighed.withColumn("cap", cap)
              .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
              .withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
              .withColumn("capped", F.col("left") * F.col("weight") > F.col("cap") * F.col("left_weight")))
    free = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    spread = F.sum("source_size").over(every) - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0))
    return ranked.select("no", "source", "source_size", "weight", F.when(F.col("capped"), F.col("cap").cast("double"))
                         .otherwise(spread * F.col("weight") / free).alias("target"))


def schedule(sources: DataFrame, block_words: int) -> DataFrame:
    """no, block, whole, part: how often the mix takes each source's block whole,
    and how many words of it the last, shorter slot takes.

    ``sources``: no, source_size, take (words to take of the source)."""
    spark = sources.sparkSession
    need = F.expr(f"(take div source_size) * blocks + ceil((take % source_size) / {block_words})").cast("long")
    planned = cut(sources.filter("take > 0").withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
                  .withColumn("need", need)
                  .withColumn("below", F.sum("need").over(Window.orderBy("no")) - F.col("need")))
    total = planned.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0]
    # A slot's point falls into one cell of [0, total); a source lies in the cells
    # that its share touches.
    cells = parts_for(total, 64)
    width = -(-total // cells) or 1
    shares = planned.select("no", "below", "need", F.explode(F.expr(
        f"sequence(below div {width}, (below + need - 1) div {width})")).alias("cell"))
    point = F.expr(f"(id % {_ONE}) * {_STEP} % {_ONE}")
    slots = (spark.range(total).select(F.col("id").alias("slot"), F.floor(point / _ONE * total).cast("long").alias("point"))
             .withColumn("cell", F.expr(f"point div {width}"))
             .join(shares, "cell").filter("point >= below and point < below + need")
             .select("no", "slot", F.expr(f"slot div {_CHUNK_SLOTS}").alias("chunk")))
    # A slot's rank in its source: slots of earlier chunks, and those before it in its own.
    chunks = slots.groupBy("no", "chunk").count().withColumn(
        "earlier", F.sum("count").over(Window.partitionBy("no").orderBy("chunk")) - F.col("count"))
    ranked = (slots.withColumn("within", F.row_number().over(Window.partitionBy("no", "chunk").orderBy("slot")) - 1)
              .join(chunks, ["no", "chunk"]).select("no", (F.col("earlier") + F.col("within")).alias("rank")))
    # The few slots that a share got beyond its need go to the shares that got fewer.
    got = slots.groupBy("no").agg(F.count(F.lit(1)).alias("got"))
    late = (planned.join(got, "no", "left").withColumn("got", F.coalesce("got", F.lit(0).cast("long"))).filter("got < need")
            .select("no", F.explode(F.expr("sequence(got, need - 1)")).alias("rank")))
    plan = planned.select("no", "need", "blocks", F.expr(f"take % source_size % {block_words}").alias("short"))
    short = (F.col("rank") == F.col("need") - 1) & (F.col("short") > 0)
    return (ranked.unionByName(late).join(plan, "no").filter("rank < need")
            .withColumn("block", F.col("rank") % F.col("blocks"))
            .groupBy("no", "block").agg(F.count(F.when(~short, 1)).alias("whole"),
                                        F.coalesce(F.max(F.when(short, F.col("short"))), F.lit(0)).alias("part")))


def copies(mixed: DataFrame) -> DataFrame:
    """row and copies of the rows of ``mix`` that are in a mix of whole documents:
    as often as the words taken of them are nearest to, if that is once or more;
    documents without words are not in a mix."""
    return mixed.filter("taken > 0").select(
        "row", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("copies")).filter("copies > 0")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 6, row: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``docs`` (and
    row, a number of each row: ``row`` if given, as of a table that
    common.numbered wrote).

    size: words of the text (a null text has none).  taken: words of the
    document in the mix, repeats counted; a source's add up to its target,
    rounded.  Each source's first words are in its last, partial epoch, so a
    document on that border is taken in part.  Documents without words are taken
    zero times, a null source is a source, repeated rows each have a place.  The
    order within a source follows a hash of doc_id, so reruns agree; an empty
    table gives no rows; other columns are not read.

    A source's documents are placed by hash bucket and then within the bucket,
    so no window holds a whole source, and blocks hold equally many words."""
    row = F.monotonically_increasing_id() if row is None else row
    sized = cut(docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                            "source", n_words(text_or_empty()).alias("size")))
    sources = cut(source_targets(sized).withColumn("take", F.floor(F.col("target") + 0.5).cast("long")))
    bits = max(1, (parts_for(sized.count(), _BUCKET_DOCS) - 1).bit_length())
    placed = (sized.withColumnRenamed("source", "of").join(sources, F.col("of").eqNullSafe(F.col("source")))
              .withColumn("order", F.xxhash64("doc_id", F.lit(seed)))
              .withColumn("bucket", F.shiftrightunsigned("order", 64 - bits)))
    placed = cut(placed.select("row", "doc_id", "size", "no", "source_size", "target", "order", "bucket"))
    buckets = placed.groupBy("no", "bucket").agg(F.sum("size").alias("words")).withColumn(
        "earlier", F.sum("words").over(Window.partitionBy("no").orderBy("bucket")) - F.col("words"))
    within = Window.partitionBy("no", "bucket").orderBy("order", "doc_id", "size", "row")
    streams = (placed.filter("size > 0").withColumn("before", F.sum("size").over(within) - F.col("size"))
               .join(buckets.select("no", "bucket", "earlier"), ["no", "bucket"])
               .withColumn("at", F.col("earlier") + F.col("before")))
    pieces = streams.select("row", "no", "at", "size", F.explode(F.expr(
        f"sequence(at div {block_words}, (at + size - 1) div {block_words})")).alias("block"))
    begin, first = F.greatest("at", F.col("block") * block_words), F.col("block") * block_words
    end = F.least(F.col("at") + F.col("size"), first + block_words)
    uses = cut(schedule(sources.select("no", "source_size", "take"), block_words))
    taken = (pieces.join(uses, ["no", "block"])
             .withColumn("words", F.col("whole") * (end - begin)
                         + F.greatest(F.lit(0), F.least(end, first + F.col("part")) - begin))
             .groupBy("row").agg(F.sum("words").cast("long").alias("taken")))
    return placed.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "row")

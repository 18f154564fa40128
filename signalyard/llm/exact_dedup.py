"""Exact de-duplication by deterministic block naming.

Every text is cut into fixed-size blocks.  Equal blocks get one integer name
(the place of the block in sorted order), then adjacent pairs of names are
named the same way, level by level, until each document has one name.  Two
documents of as many blocks have equal names exactly if their texts are equal.

Only DataFrame functions are used.  Texts are shuffled once, as distinct
blocks (combined before the shuffle, so a passage that a third of all rows
hold is sent once per task).  A block's occurrences carry a 64-bit alias
instead of the text; an alias that several blocks share is found in the name
table, which holds every block, and is resolved by the blocks' text, so no
identity rests on a hash."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from signalyard.llm.common import cut, numbered, text_or_empty

#: Code points in a block.
BLOCK_CHARS = 4096


def _blocks(text: Column, block_chars: int) -> Column:
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(blocks)


def _block_names(docs: DataFrame, block_chars: int, alias: Callable[[Column], Column]) -> DataFrame:
    """alias, block, name: the sorted distinct blocks, numbered."""
    blocks = docs.select(F.explode(_blocks(F.col("text"), block_chars)).alias("block")).distinct()
    return blocks.sortWithinPartitions("block").select(
        alias(F.col("block")).alias("alias"), "block", F.monotonically_increasing_id().alias("name"))


def _first_names(docs: DataFrame, rows: DataFrame, block_chars: int, alias: Callable[[Column], Column]) -> DataFrame:
    """row, n_blocks, pos, name of every block occurrence."""
    names = _block_names(docs, block_chars, alias)
    per_alias = cut(names.groupBy("alias").agg(
        F.min("name").alias("name"), (F.count(F.lit(1)) > 1).alias("shared")))
    found = rows.select("row", "n_blocks", F.posexplode("aliases").alias("pos", "alias")).join(per_alias, "alias")
    if per_alias.filter("shared").isEmpty():
        return found.select("row", "n_blocks", "pos", "name")
    # Blocks under one alias: told apart by their text, which is read again for them alone.
    # Their names count down from -2, apart from those above.
    by_text = cut(names.join(per_alias.filter("shared").select("alias"), "alias", "left_semi")
                  .withColumn("name", -2 - F.col("name")))
    texts = (docs.select("row", _blocks(F.col("text"), block_chars).alias("blocks"))
             .select("row", F.size("blocks").alias("n_blocks"), F.posexplode("blocks").alias("pos", "block"))
             .withColumn("alias", alias(F.col("block"))))
    return found.filter("not shared").select("row", "n_blocks", "pos", "name").unionByName(
        texts.join(by_text, ["alias", "block"]).select("row", "n_blocks", "pos", "name"))


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS,
               alias: Callable[[Column], Column] = F.xxhash64) -> tuple[DataFrame, DataFrame]:
    """(rows, names): rows has row, doc_id, text_sha256 and n_blocks of every
    row of ``docs`` (common.numbered), names has row and its identity under that
    number of blocks.

    ``alias`` maps a block to a number; any function gives right results."""
    docs = docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = cut(docs.select("row", "doc_id",
                           F.sha2(F.col("text"), 256).alias("text_sha256"),
                           F.transform(_blocks(F.col("text"), block_chars), lambda b: alias(b)).alias("aliases"))
               .withColumn("n_blocks", F.size("aliases")))
    level = cut(_first_names(docs, rows, block_chars, alias).withColumnRenamed("n_blocks", "left"))
    whole = [level.filter("left = 1").select("row", "name")]
    level = level.filter("left > 1")
    while not level.isEmpty():
        half = F.expr("pos div 2")
        pairs = cut(level.groupBy("row", half.alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("first"),
            # a last name without a partner is paired with -1, which names nothing
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("second"),
            F.expr("(max(left) + 1) div 2").alias("left")))
        names = cut(pairs.select("first", "second").distinct().sortWithinPartitions("first", "second")
                    .withColumn("name", F.monotonically_increasing_id()))
        level = cut(pairs.join(names, ["first", "second"]).select("row", "pos", "name", "left"))
        whole.append(level.filter("left = 1").select("row", "name"))
        level = level.filter("left > 1")
    names = whole[0]
    for w in whole[1:]:
        names = names.unionByName(w)
    return rows.drop("aliases"), names


def exact_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS,
                 alias: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256
    (and row, its number in the written copy that is read).

    Texts are equal if identical; a null text counts as empty.  Of equal texts
    the row with the largest doc_id stays (null is the smallest; of repeated
    rows of one doc_id, exactly one).  An empty table gives no rows; other
    columns of ``docs`` are not read.  The join of the rows to their groups is
    a plain join of two written tables, which Spark splits where a group of
    copies is large.  ``docs`` is read once."""
    return numbered_groups(numbered(docs, ("doc_id", "text")), block_chars, alias)


def numbered_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS,
                    alias: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """exact_groups of a table that common.numbered wrote, with its rows."""
    rows, names = identities(docs, block_chars, alias)
    named = cut(rows.join(names, "row"))
    groups = cut(named.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")))
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256", "row")

"""Operator 4 [native]: mixing sources to target weights by weighted fair queueing.

Documents are shuffled by a digest of their id and text. Each source is a queue
that is served in that order, up to twice over. A document's virtual finish time
is the number of its source's words up to its end, divided by the source's
target; targets add up to the budget, so at time 1 every source has had its
target. Documents are range-sorted by virtual finish time and taken in that
order while the budget lasts; the document that a source is serving as it runs
out is taken in part, with the words up to time 1.

Rows of one id, text and source are one bundle of the queue. Running totals never
gather a source in one task: words are summed by (source, digest bucket) first,
and only a bucket is ordered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, checkpoint, fresh, row_key

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # of all words, as a fraction
MOST = 2  # times that a document or source is taken at most
BUCKET_DIGITS = 3  # 16**3 buckets of each source
SALT = "mix:"
PIECE = 10_000  # rows of a bundle that are made at a time


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, place, weight, budget, target from (source, source_size), a row a source.

    Sources by code point, nulls last, weigh 3, 1, 2, repeating, and share 3/2
    of all words; a target stops at twice its source's size and the excess goes
    to the others by weight. In the order of size by weight the sources that
    stop are the first ones, so one pass of running sums over the (few) sources
    finds the level at which the others share. Sums stay integers.
    """
    num, den = SHARE
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("place") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    placed = sizes.withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight.cast("long"))
    by_ratio = Window.orderBy(F.col("source_size").cast("double") / F.col("weight"), "place")
    before, rest = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    level = placed.withColumns({
        "_cap": F.col("source_size") * MOST,
        "_left": F.sum("source_size").over(everything) * num - F.coalesce(F.sum(F.col("source_size") * MOST).over(before), F.lit(0)) * den,
        "_weights": F.sum("weight").over(rest) * den,
    })
    level = level.withColumn("_open", F.when(F.col("weight") * F.col("_left") <= F.col("_cap") * F.col("_weights"), F.struct(F.col("source_size").cast("double") / F.col("weight"), F.col("place"))))
    # the first source that does not stop sets the level
    level = level.withColumn("_level", F.min_by(F.struct("_left", "_weights"), "_open").over(everything))
    return level.select(
        "source",
        "source_size",
        "place",
        "weight",
        F.floor(F.sum("source_size").over(everything) * num / den).alias("budget"),
        # least of cap and share: beyond the level's place every source is open
        F.least(F.col("_cap").cast("double"), (F.col("weight") * F.col("_level._left")).cast("double") / F.col("_level._weights").cast("double")).alias("target"),
    )


def _bundles(df: DataFrame, id_col: str, text_col: str, source_col: str, row: Column | None) -> DataFrame:
    """doc_id, source, size, digest, _row, rows, start, source_size, target, place, budget, until: a row for each distinct (id, text, source, _row)."""
    text = F.md5(F.col(f"`{text_col}`"))
    digest = F.md5(F.concat(F.lit(SALT), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit("null"))))
    keys = ["doc_id", "source", "size", "digest", "_row"]
    slim = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"), digest.alias("digest"), (F.lit("") if row is None else row).alias("_row"))
    slim = checkpoint(slim.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS)))

    buckets = slim.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("rows")).alias("words"))
    targets = source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")))
    in_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("offset", F.coalesce(F.sum("words").over(in_source), F.lit(0)))
    placed = offsets.join(targets, offsets["source"].eqNullSafe(targets["source"])).select(
        F.coalesce(offsets["source"], F.lit("")).alias("_s"), offsets["source"].isNull().alias("_null"), F.col("bucket").alias("_b"), "offset", "source_size", "target", "place", "budget"
    )
    keyed = slim.withColumns({"_s": F.coalesce("source", F.lit("")), "_null": F.col("source").isNull(), "_b": F.col("bucket")})
    order = Window.partitionBy("_s", "_null", "_b").orderBy("digest", "size", "_row").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("size") * F.col("rows")).over(order), F.lit(0))
    queued = keyed.withColumn("_before", before).join(placed, ["_s", "_null", "_b"])
    return checkpoint(queued.select(*keys, "rows", "source_size", "target", "place", "budget", F.ceil("target").alias("until"), (F.col("offset") + F.col("_before")).alias("start")))


def _served(queued: DataFrame) -> DataFrame:
    """The rows of bundles, each as often as it is served (_k: its number in the bundle), with finish and words: what is taken by then.

    Every pass over a source is a row of its own; those that begin after time 1
    are left out, as nothing of them is taken.
    """
    pieces = queued.filter("size > 0").withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(PIECE).cast("long"))))
    parts = int(queued.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a bundle of very many rows is spread before its rows are made
    many = pieces.filter(F.col("rows") > PIECE).repartition(parts)
    pieces = pieces.filter(F.col("rows") <= PIECE).unionByName(many)
    rows = pieces.withColumn("_k", F.explode(F.sequence(F.col("_piece"), F.least(F.col("_piece") + PIECE, F.col("rows")) - 1)))
    passes = rows.withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))))
    begin = F.col("_pass") * F.col("source_size") + F.col("start") + F.col("_k") * F.col("size")
    passes = passes.withColumn("begin", begin).filter(F.col("begin") < F.col("until"))
    return passes.withColumns({
        "finish": (F.col("begin") + F.col("size")).cast("double") / F.col("target"),
        "words": F.least(F.col("size"), F.col("until") - F.col("begin")),
    })


def _cut(served: DataFrame) -> DataFrame:
    """served with taken: its words, as long as the running total over the range-sorted finish times is within the budget."""
    parts = int(served.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["finish", "place", "begin"]
    stream = checkpoint(served.repartitionByRange(parts, *order).sortWithinPartitions(*order)).withColumn("part", F.spark_partition_id())
    sums = stream.groupBy("part").agg(F.sum("words").alias("part_words"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    sums = sums.withColumn("before_part", F.coalesce(F.sum("part_words").over(upto), F.lit(0)))
    stream = stream.join(F.broadcast(sums), "part")
    # a range that fits whole needs no order; only the one at the cut is summed up document by document
    whole = stream.filter("before_part + part_words <= budget").withColumn("taken", F.col("words"))
    running = F.coalesce(F.sum("words").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = F.greatest(F.col("budget") - F.col("before_part") - running, F.lit(0))
    last = stream.filter("before_part + part_words > budget").withColumn("taken", F.least(F.col("words"), room))
    return whole.unionByName(last)


def fair_schedule(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row per row of df: doc_id, source, size, source_size, target, taken.

    ``taken`` is the words that the mix takes of the row, repeats counted, at
    most twice its size. Null text: no words; a null source is a source; null and
    equal ids are ordered by their texts; rows equal in id, text and source are
    interchangeable; an empty table gives no rows; other columns are ignored.
    """
    queued = _bundles(df, id_col, text_col, source_col, None)
    columns = ["doc_id", "source", "size", "source_size", "target"]
    ends = ["place", "start", "digest", "_k"]
    taken = _cut(_served(queued)).groupBy(*ends, *columns).agg(F.sum("taken").alias("taken"))
    # the rows that are never served: those without words, and those behind the target
    out_from = F.expr("CASE WHEN size > 0 THEN greatest((until - start + size - 1) DIV size, 0L) ELSE 0L END")
    rest = queued.withColumn("_from", out_from).filter("_from < rows")
    rest = rest.withColumn("_piece", F.explode(F.sequence(F.col("_from"), F.col("rows") - 1, F.lit(PIECE).cast("long"))))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = rest.filter(F.col("rows") <= PIECE).unionByName(rest.filter(F.col("rows") > PIECE).repartition(parts))
    rest = rest.withColumn("_k", F.explode(F.sequence(F.col("_piece"), F.least(F.col("_piece") + PIECE, F.col("rows")) - 1)))
    return taken.select(*columns, F.col("taken").cast("long").alias("taken")).unionByName(rest.select(*columns, F.lit(0).cast("long").alias("taken")))


def mix_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as whole documents, with df's own columns: a row for each time that a document is taken.

    A document taken in part counts as whole if at least half of it is taken.
    Documents without words are never taken. Rows that differ in any column are
    told apart; of rows equal in all columns it does not matter which is taken.
    """
    row = row_key(F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col]), {"ignoreNullFields": "false"})), F.md5(F.col(f"`{text_col}`")))
    cut = _cut(_served(_bundles(df, id_col, text_col, source_col, row)))
    taken = cut.groupBy("_row", "_k", "size").agg(F.sum("taken").alias("taken"))
    key, times = fresh(df, "_mix_row"), fresh(df, "_mix_times")
    plan = taken.groupBy("_row").agg(F.sum(F.floor(F.col("taken") / F.col("size") + F.lit(0.5))).cast("int").alias(times)).filter(F.col(times) > 0)
    met = df.withColumn(key, row).join(plan.withColumnRenamed("_row", key), key).dropDuplicates([key])
    # a document of very many equal rows is repeated in two steps
    met = met.withColumn(times, F.explode(F.transform(F.sequence(F.lit(1), F.col(times), F.lit(PIECE)), lambda at: F.least(F.col(times) - at + 1, F.lit(PIECE)))))
    return met.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[F.col(f"`{c}`") for c in df.columns])

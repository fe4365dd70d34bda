"""Mixing sources to target weights by a low-discrepancy schedule.

Sources, by code point and null last, weigh as the repeated ``weights`` say and share
``share`` times all words.  A target stops at ``most`` times its source's words; the
excess goes to the others by weight until none is above.

Each source's documents are shuffled by a hash and laid end to end; blocks of
``block`` words cut that line, documents included.  The points of the golden-ratio
sequence fall into the sources' shares of all slots; a slot's rank among its source's
slots names the block it takes, beginning again after the last one.  A source takes
exactly its target in whole words: the slots beyond its last block go, missing ones
are added at the end of the schedule, and the last block is cut.

Cases: null and empty texts have no words and take none; a null source is a source of
its own; repeated rows take their own shares; empty tables give no rows; a source
without words has target 0.  Reruns agree, as every order is a hash with ties broken by
the row's values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumgauge.llm.running import running_total
from forumgauge.llm.tables import Work

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 1024
GOLDEN = 0.6180339887498949
CELLS = 1024
ROWS_PER_BUCKET = 2000
SLOTS_PER_BUCKET = 8192
WORD = r"[^\x20\x09-\x0D]+"


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("null"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size -> weight, target.  One row per source goes in and out.

    Sources are ranked by a distributed sort.  The level that the uncapped targets
    share is found in rounds; each round gathers three sums.
    """
    spark = sources.sparkSession
    ranked = sources.select("source", "source_size").orderBy(F.col("source").asc_nulls_last())
    rows = ranked.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1]))
    table = spark.createDataFrame(rows, sources.select("source", "source_size").schema.add("rank", "long"))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = table.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = F.col("weight") * level >= F.col("cap")
        count, taken, free = table.agg(
            F.count_if(above), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))).first()
        if not free or count == capped:
            break
        level, capped = (total * share - (taken or 0.0)) / free, count
    return table.withColumn("target", F.least("cap", F.col("weight") * F.lit(float(level))))


def plan(documents: DataFrame, work: Work, text: str = "text", source: str = "source", key: str = "doc_id",
         weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK
         ) -> tuple[DataFrame, DataFrame]:
    """What the mix takes of each document, and the schedule.

    The first table has key, source, size, source_size, target, taken (words, repeats
    counted), one row per row.  The schedule has slot, skey, rank, block and epoch: the
    order in which blocks enter the mix.
    """
    spark = documents.sparkSession
    sized = work.keep(documents.select(
        F.col(key).alias("key"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))
        .withColumn("skey", _key(F.col("source")))
        .withColumn("shuffle", F.xxhash64(F.lit("mix"), "key", "skey", "size")), "sized")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    with_targets = targets(sums, weights, share, most).select("source", "weight", "target")
    quota = F.floor(F.col("target") + 0.5).cast("bigint")
    blocks = F.ceil(F.col("source_size") / block).cast("bigint")
    rest = F.col("quota") - F.col("whole") * F.col("source_size")
    sources = (sums.join(with_targets, sums["source"].eqNullSafe(with_targets["source"])).drop(with_targets["source"])
               .withColumn("skey", _key(F.col("source"))).withColumn("quota", quota).withColumn("blocks", blocks)
               .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("quota") / F.col("source_size")))
                           .otherwise(0).cast("bigint"))
               .withColumn("needed", F.col("whole") * F.col("blocks") + F.ceil(rest / block).cast("bigint")))
    sources = work.keep(sources, "sources")

    # documents end to end, in shuffled order
    most_rows = sources.agg(F.max("rows")).first()[0] or 1
    bits = max(1, (most_rows // ROWS_PER_BUCKET).bit_length())
    placed = running_total(
        sized.withColumn("bucket", F.expr(f"shiftrightunsigned(shuffle, {64 - bits})")), ["skey"], "bucket",
        [F.col("shuffle"), F.col("key"), F.col("size")], "size", out="start")
    schedule = work.keep(_schedule(spark, sources, work), "schedule")

    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = placed.select(
        "skey", "bucket", "place", "key", "source", "size", "start",
        F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))).alias("block"))
    begin = F.greatest("start", F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    pieces = pieces.withColumn("begin", begin).withColumn("words", end - begin)
    attributes = sources.select("skey", F.col("source_size").alias("line"), "quota")
    slots = schedule.join(attributes, "skey").select(
        "skey", "block", (F.col("quota") - F.col("epoch") * F.col("line")).alias("room"))
    took = F.when(F.col("room").isNotNull(), F.greatest(F.lit(0), F.least("words", F.col("room") - F.col("begin"))))
    # One slot takes a block once; a block is in at most as many slots as it is repeated.
    by_document = (pieces.join(slots, ["skey", "block"], "left")
                   .groupBy("skey", "bucket", "place", "key", "source", "size")
                   .agg(F.coalesce(F.sum(took), F.lit(0)).cast("bigint").alias("taken")))
    taken = by_document.join(sources.select("skey", "source_size", "target"), "skey").select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "taken")
    return taken, schedule


def _schedule(spark: SparkSession, sources: DataFrame, work: Work) -> DataFrame:
    """slot, skey, rank, block, epoch."""
    total = sources.agg(F.sum("needed")).first()[0] or 0
    shares = running_total(sources.withColumn("bucket", F.expr("shiftrightunsigned(xxhash64(skey), 52)"))
                           .withColumn("all", F.lit(0)),
                           ["all"], "bucket", [F.col("skey")], "needed", out="before")
    count = F.lit(float(max(total, 1)))
    shares = shares.select("skey", (F.col("before") / count).alias("low"),
                           ((F.col("before") + F.col("needed")) / count).alias("high"))
    cells = shares.where("high > low").select(
        "*", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.col("high") * CELLS))).alias("cell"))
    points = spark.range(total).select(
        F.col("id").alias("slot"), ((F.col("id") + 1) * GOLDEN % 1.0).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * CELLS))
    drawn = points.join(cells, "cell").where("point >= low and point < high").select(
        "slot", "skey", F.floor(F.col("slot") / SLOTS_PER_BUCKET).alias("bucket"), F.lit(1).alias("one"))
    ranked = running_total(drawn, ["skey"], "bucket", [F.col("slot")], "one", out="rank")
    ranked = work.keep(ranked.select("slot", "skey", F.col("rank").cast("bigint")), "ranked")
    drawn_counts = ranked.groupBy("skey").agg(F.count("*").alias("drawn"))
    needs = sources.select("skey", "blocks", "needed").join(drawn_counts, "skey", "left").na.fill(0, ["drawn"])
    missing = needs.where("needed > drawn").select(
        "skey", "blocks", F.explode(F.sequence(F.col("drawn"), F.col("needed") - 1)).alias("rank"))
    kept = (ranked.join(needs, "skey").where("rank < needed").select("slot", "skey", "blocks", "rank")
            .unionByName(missing.select((F.col("rank") + total).alias("slot"), "skey", "blocks", "rank")))
    return kept.select("slot", "skey", "rank", (F.col("rank") % F.col("blocks")).alias("block"),
                       F.floor(F.col("rank") / F.col("blocks")).alias("epoch"))


def mix(documents: DataFrame, work: Work, text: str = "text", source: str = "source", key: str = "doc_id",
        **settings) -> DataFrame:
    """The documents of the mix: a row for each time one is taken, its text cut to what the last time took.

    Rows are joined to what the plan takes by key, source and size, so documents
    that agree in all three count as one; a key may occur in several sources.  Columns
    of any other name stay as they are.
    """
    taken, _ = plan(documents, work, text, source, key, **settings)
    taken = taken.where("taken > 0").select(
        F.col(key).alias("_mix_key"), F.col(source).alias("_mix_source"), F.col("size").alias("_mix_size"),
        F.col("taken").alias("_mix_taken")).dropDuplicates(["_mix_key", "_mix_source", "_mix_size"])
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
    texts = documents.withColumn("_mix_words", size)
    rows = texts.join(taken, texts[key].eqNullSafe(taken["_mix_key"]) & texts[source].eqNullSafe(taken["_mix_source"])
                      & (texts["_mix_words"] == taken["_mix_size"]))
    copies = F.ceil(F.col("_mix_taken") / F.col("_mix_size")).cast("int")
    rows = rows.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), copies)))
    left = F.col("_mix_taken") - (F.col("_mix_copy") - 1) * F.col("_mix_size")
    part = F.array_join(F.slice(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""), 1, left.cast("int")), " ")
    cut = rows.withColumn(text, F.when(left >= F.col("_mix_size"), F.col(text)).otherwise(part))
    return cut.select(*documents.columns)

"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Van der Corput points go through the cumulative slot counts of the sources, so every stretch of the
schedule holds each source in its share. The slots of a source, ranked, take the blocks of its
shuffled documents one after the other, again from the start when the documents are used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.llm.common import WORD_PATTERN, kept, text_of

# Words of a block; a source's last block ends where its target is reached.
BLOCK = 1024
# Documents, and slots, that are numbered together in one task; results do not depend on it.
RUN = 1 << 12
# Hash bits that can tell runs of documents apart, as hex digits.
HASH_DIGITS = 10
# Weights of the sources in code point order, repeating; the share of all words to
# take, as a fraction; how often a document may be taken.
WEIGHTS = (3, 1, 2)
SHARE = (3, 2)
REPEATS = 2


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words and ``digest`` of the text, one row per document."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        # What is left between the words, both ends included.
        (F.size(F.split(text_of(), WORD_PATTERN, -1)) - 1).cast("long").alias("size"),
        F.md5(text_of().cast("binary")).alias("digest"),
    )


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: tuple = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row per source: ``place``, ``docs``, ``source_size``, ``target`` and ``goal``, its whole words.

    Words go by weight; what exceeds ``repeats`` times a source's size is shared anew among the
    others until none exceeds. Each round is one aggregate over the sources, in whole numbers.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    turn = (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
        .withColumn("place", F.row_number().over(order))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn).cast("long"))
        .withColumn("most", repeats * F.col("source_size"))
    )
    sources = kept(sources, "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    full: Column = F.lit(False)
    words, per = 0, 1  # words per weight, as a fraction
    while True:
        spent, weight = sources.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        level = (share[0] * total - share[1] * (spent or 0), share[1] * (weight or 0))
        if not level[1] or level == (words, per):
            break
        words, per = level
        full = F.col("most").cast("decimal(20,0)") * F.lit(per) <= F.col("weight").cast("decimal(20,0)") * F.lit(words)
    shared = F.col("weight") * F.lit(words).cast("long")
    divided = F.call_function("div", shared, F.lit(per).cast("long"))
    return sources.select(
        "place", "source", "docs", "source_size",
        F.when(full, F.col("most").cast("double")).otherwise(shared.cast("double") / F.lit(float(per))).alias("target"),
        F.when(full, F.col("most")).otherwise(divided).cast("long").alias("goal"),
    )


def bits(count: Column) -> Column:
    """Bits that number ``count`` things."""
    return F.length(F.bin(F.greatest(count, F.lit(1)) - 1)).cast("int")


def before(group: list[str], order: str, value: str) -> Column:
    """Sum of ``value`` over the rows of the group that come earlier; 0 for the first."""
    window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def laid_out(sizes: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Documents with ``start``, their first word's number in the shuffled text of their source.

    The shuffle orders by a hash. Runs of the hash are summed first, so a source of any size is
    numbered in many tasks.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest"))
    rows = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).select(sizes["*"], "place", "docs", "source_size", "target", "goal")
    run = F.conv(F.substring("key", 1, HASH_DIGITS), 16, 10).cast("long")
    width = F.lit(4 * HASH_DIGITS) - bits(F.ceil(F.col("docs") / RUN))
    rows = rows.withColumn("key", key).withColumn("run", F.call_function("shiftright", run, width))
    runs = rows.groupBy("place", "run").agg(F.sum("size").alias("run_size"))
    runs = runs.select("place", "run", before(["place"], "run", "run_size").alias("base"))
    rows = rows.join(runs, ["place", "run"])
    return rows.withColumn("start", F.col("base") + before(["place", "run"], "key", "size")).drop("run", "base", "docs")


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """``slot``, ``place`` and ``rank``: which source takes its next block at each slot.

    The j-th share of the sources laid end to end stands at the slot whose bits are those of j
    reversed (van der Corput); slots without a source are left out, the others keep their order.
    """
    counts = sources.select("place", F.ceil(F.col("goal") / block).cast("long").alias("slots"))
    order = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)  # one row per source
    counts = counts.withColumn("first", F.coalesce(F.sum("slots").over(order), F.lit(0)))
    total = counts.agg(F.sum("slots")).first()[0] or 0
    width = max(1, (total - 1).bit_length()) if total else 1
    run_width = max(0, width - (RUN - 1).bit_length())
    runs = counts.where("slots > 0").select(
        "place", "slots", "first", F.explode(F.sequence(F.lit(0), F.call_function("div", F.col("slots") - 1, F.lit(RUN).cast("long")))).alias("part")
    )
    low = F.col("first") + F.col("part") * RUN
    high = F.col("first") + F.least(F.col("slots"), (F.col("part") + 1) * RUN) - 1
    points = runs.repartition("place", "part").select("place", F.explode(F.sequence(low, high)).alias("point"))
    reverse = F.conv(F.reverse(F.lpad(F.bin("point"), width, "0")), 2, 10).cast("long")
    points = points.select("place", reverse.alias("slot")).withColumn("run", F.shiftright("slot", width - run_width))
    counted = points.groupBy("place", "run").agg(F.count("*").alias("run_slots"))
    counted = counted.select("place", "run", before(["place"], "run", "run_slots").alias("base"))
    within = Window.partitionBy("place", "run").orderBy("slot")
    ranked = points.join(counted, ["place", "run"])
    return ranked.select("slot", "place", (F.col("base") + F.row_number().over(within) - 1).alias("rank"))


def pieces(laid: DataFrame, block: int = BLOCK) -> DataFrame:
    """The parts of documents in each block up to the source's goal: ``first_word``, ``words``."""
    rounds = F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("goal") - 1, F.col("source_size")))
    taken = laid.where("size > 0 AND goal > 0").select("*", F.explode(rounds).alias("round"))
    taken = taken.withColumn("low", F.col("round") * F.col("source_size") + F.col("start"))
    taken = taken.withColumn("high", F.least(F.col("low") + F.col("size"), F.col("goal"))).where("high > low")
    size = F.lit(block).cast("long")
    blocks = F.sequence(F.call_function("div", F.col("low"), size), F.call_function("div", F.col("high") - 1, size))
    parts = taken.select("*", F.explode(blocks).alias("rank"))
    first = F.greatest(F.col("low"), F.col("rank") * block)
    last = F.least(F.col("high"), (F.col("rank") + 1) * block)
    return parts.select("place", "rank", "start", "doc_id", (first - F.col("low")).alias("first_word"), (last - first).alias("words"))


def mix(docs: DataFrame, seed: int = 0, block: int = BLOCK, **shares) -> tuple[DataFrame, DataFrame]:
    """The schedule of the mix, and every document with what it gives.

    The first table has a row for each slot and document part: ``slot``, ``place``, ``rank``,
    ``doc_id``, ``first_word``, ``words``. The second has ``doc_id``, ``source``, ``digest``,
    ``size``, ``source_size``, ``target`` and ``taken``. Texts are read once and not shuffled.

    Nulls: a null text has no words; a null source is a source of its own, the last; a null doc_id
    is an id like others. Repeated rows come out each. Documents without words take nothing. Empty
    tables give no rows. Other columns are not read.
    """
    sizes = kept(sized(docs), "sizes")
    sources = kept(targets(sizes, **shares), "targets")
    laid = kept(laid_out(sizes, sources, seed), "laid")
    plan = schedule(sources, block).join(pieces(laid, block), ["place", "rank"])
    # A place in the stream of its source is one document, unless it has no words.
    sums = plan.groupBy("place", "start").agg(F.sum("words").alias("words"))
    rows = laid.where("size > 0").join(sums, ["place", "start"], "left")
    rows = rows.withColumn("taken", F.coalesce("words", F.lit(0).cast("long")))
    columns = ["doc_id", "source", "digest", "size", "source_size", "target", "taken"]
    none = laid.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return plan.select("slot", "place", "rank", "doc_id", "first_word", "words"), rows.select(columns).union(none.select(columns))


def mixed(docs: DataFrame, seed: int = 0, **shares) -> DataFrame:
    """The documents of the mix, as often as it takes them; the columns stay.

    The one document of a source at which its target is reached is cut after its last word taken,
    its words joined by spaces and ``n_chars`` counted anew. Documents not taken go. Rows that agree
    in id, source and text count as one document that is taken for all of them.
    """
    keys = ["id", "source", "digest"]
    takes = mix(docs, seed, **shares)[1].withColumnRenamed("doc_id", "id").groupBy(*keys, "size")
    takes = takes.agg(F.sum("taken").alias("taken")).where("taken > 0").select(
        *keys, F.call_function("div", "taken", "size").alias("whole"), (F.col("taken") % F.col("size")).cast("int").alias("rest")
    )
    # The document travels as one struct, so that its columns meet no others.
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col("doc_id").cast("long").alias("id"),
        F.col("source").cast("string").alias("source"),
        F.md5(text_of().cast("binary")).alias("digest"),
    )
    same = [rows[key].eqNullSafe(takes[key]) for key in keys]
    rows = rows.join(takes, same[0] & same[1] & same[2]).select("doc", *[rows[key] for key in keys], "whole", "rest")
    rows = rows.dropDuplicates(keys)
    copies = F.sequence(F.lit(1).cast("long"), F.col("whole") + (F.col("rest") > 0).cast("long"))
    rows = rows.select("doc", "rest", F.explode(copies).alias("copy"), "whole")
    gap = "[\\x20\\x09-\\x0D]+"
    words = F.split(F.regexp_replace("doc.text", "^" + gap, ""), gap)
    cut = F.array_join(F.slice(words, F.lit(1), F.col("rest")), " ")
    partial = F.col("copy") > F.col("whole")
    doc = F.when(partial, F.col("doc").withField("text", cut)).otherwise(F.col("doc"))
    if "n_chars" in docs.columns:
        chars = F.length("doc.text").cast(docs.schema["n_chars"].dataType)
        rows = rows.select(partial.alias("partial"), doc.alias("doc"))
        doc = F.when(F.col("partial"), F.col("doc").withField("n_chars", chars)).otherwise(F.col("doc"))
    return rows.select(doc.alias("doc")).select("doc.*")

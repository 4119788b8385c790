"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A sketch has three subtables of cells; a paragraph's digest goes into one cell of each. A cell holds
the count, the xor of the digests and the xor of their check values. Subtracting the sketches of two
versions leaves the digests in which they differ; a cell left with one digest gives it away, taking
it out of its other cells gives away the next ones (peeling). Where cells stay, the difference was
too large for the sketch, and a larger one is tried.

Everything here is DataFrame expressions. Cells are rows, and only filled ones exist, so a large
sketch costs what the difference is. All rows of a pair stay in one partition from the first to the
last round of peeling.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.llm.common import kept, text_of

SUBTABLES = 3
# Cells per subtable of the stored fingerprint. Not a limit: larger differences use larger sketches.
STORED = 6
# Rounds of peeling, each over one subtable, before a sketch counts as too small.
PEELS = 15
# Share of a retried sketch's subtable that the largest possible difference fills.
FILL = 0.75
CHECK_MASK = (1 << 32) - 1
# Documents in one range of ids, the most ranges, and the most that are told apart by quantiles;
# results do not depend on them.
RANGE_DOCS = 4096
MOST_RANGES = 1 << 16
QUANTILES = 512
# Hash bits that order the rows of an id with very many, as hex digits.
TIE_DIGITS = 10
# Digests that a task of the peeling gets on average.
TASK_DIGESTS = 1 << 20


def paragraphs(text: Column) -> Column:
    """Digests of the distinct paragraphs, which are the lines that hold anything."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line) != "")
    return F.array_distinct(F.transform(lines, lambda line: F.xxhash64(line)))


def cell_of(digest: Column, subtable: Column | int, cells: Column | int, salt: Column | int) -> Column:
    """The digest's cell in a subtable."""
    at = [x if isinstance(x, Column) else F.lit(x) for x in (salt, subtable)]
    return F.pmod(F.xxhash64(digest, *at), cells if isinstance(cells, Column) else F.lit(cells)).cast("int")


def check_of(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check")).bitwiseAND(F.lit(CHECK_MASK))


def stored_sketch(digests: Column) -> Column:
    """The small sketch as an array of (n, digest, check), subtable after subtable."""

    def cell(number: Column) -> Column:
        subtable = F.floor(number / STORED).cast("int")
        inside = F.filter(digests, lambda d: cell_of(d, subtable, STORED, 0) == number % STORED)
        return F.aggregate(
            inside,
            F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("digest"), F.lit(0).cast("long").alias("check")),
            lambda sum, d: F.struct(
                (sum["n"] + 1).alias("n"),
                sum["digest"].bitwiseXOR(d).alias("digest"),
                sum["check"].bitwiseXOR(check_of(d)).alias("check"),
            ),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(SUBTABLES * STORED - 1)), cell)


def as_text(sketch: Column) -> Column:
    """The sketch as hex: count, digest and check of each cell."""
    cells = F.transform(
        sketch,
        lambda c: F.concat(F.hex(c["n"]), F.lit("."), F.lpad(F.hex(c["digest"]), 16, "0"), F.lpad(F.hex(c["check"]), 8, "0")),
    )
    return F.lower(F.concat_ws("-", cells))


def peeled(cells: DataFrame, keys: list[str], keep_digests: bool = False) -> DataFrame:
    """Rounds of peeling over cells (keys, salt, width, subtable, cell, n, digest, check).

    Rows come back with subtable -1: the recovered digests, or only their counts in ``n``, with
    ``cell`` 1 for the left version and -1 for the right; and what could not be peeled.
    """
    group = [*keys, "salt", "width", "subtable", "cell"]
    values = ["n", "digest", "check"]
    for turn in range(PEELS):
        subtable = turn % SUBTABLES
        pure = (
            (F.col("subtable") == subtable)
            & F.col("n").isin(1, -1)
            & (F.col("check") == check_of(F.col("digest")))
            & (F.col("cell") == cell_of(F.col("digest"), subtable, F.col("width"), F.col("salt")))
        )
        found = F.struct(
            F.lit(-1).alias("subtable"),
            F.col("n").cast("int").alias("cell"),
            F.lit(1).cast("long").alias("n"),
            (F.col("digest") if keep_digests else F.lit(0).cast("long")).alias("digest"),
            F.lit(0).cast("long").alias("check"),
        )
        # The pure cell itself empties; its digest leaves the other subtables.
        others = [
            F.struct(
                F.lit(other).alias("subtable"),
                cell_of(F.col("digest"), other, F.col("width"), F.col("salt")).alias("cell"),
                (-F.col("n")).alias("n"),
                F.col("digest").alias("digest"),
                F.col("check").alias("check"),
            )
            for other in range(SUBTABLES)
            if other != subtable
        ]
        same = F.struct("subtable", "cell", *values)
        rows = cells.select(*keys, "salt", "width", F.explode(F.when(pure, F.array(found, *others)).otherwise(F.array(same))).alias("c"))
        rows = rows.select(*keys, "salt", "width", "c.*")
        if keep_digests:  # recovered digests stay rows of their own
            rows = rows.withColumn("own", F.when(F.col("subtable") < 0, F.col("digest")).otherwise(0))
        cells = (
            rows.groupBy(*group, *["own"] * keep_digests)
            .agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check"))
            .where((F.col("subtable") < 0) | (F.col("n") != 0) | (F.col("digest") != 0) | (F.col("check") != 0))
            .select(*group, *values)
        )
    return cells


def difference_cells(pairs: DataFrame, keys: list[str], width: Column, salt: int) -> DataFrame:
    """Cells of the left version's sketch minus the right one's, without empty ones."""
    sides = F.concat(
        F.transform("left", lambda d: F.struct(d.alias("digest"), F.lit(1).cast("long").alias("n"))),
        F.transform("right", lambda d: F.struct(d.alias("digest"), F.lit(-1).cast("long").alias("n"))),
    )
    rows = pairs.select(*keys, F.lit(salt).alias("salt"), width.cast("int").alias("width"), F.explode(sides).alias("d"))
    rows = rows.select(*keys, "salt", "width", "d.*", F.explode(F.array(*map(F.lit, range(SUBTABLES)))).alias("subtable"))
    rows = rows.withColumn("cell", cell_of(F.col("digest"), F.col("subtable"), F.col("width"), F.col("salt")))
    rows = rows.withColumn("check", check_of(F.col("digest")))
    return (
        rows.groupBy(*keys, "salt", "width", "subtable", "cell")
        .agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check"))
        .where((F.col("n") != 0) | (F.col("digest") != 0) | (F.col("check") != 0))
    )


def counted(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Per pair ``left_only`` and ``right_only``, the recovered digests, and ``stuck`` cells."""
    return cells.groupBy(*keys).agg(
        F.sum(F.when((F.col("subtable") < 0) & (F.col("cell") > 0), F.col("n")).otherwise(0)).alias("left_only"),
        F.sum(F.when((F.col("subtable") < 0) & (F.col("cell") < 0), F.col("n")).otherwise(0)).alias("right_only"),
        F.sum((F.col("subtable") >= 0).cast("int")).alias("stuck"),
    )


def spread_pairs(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """The pairs dealt to tasks by the digests they hold in all."""
    pairs = pairs.select(*keys, "left", "right")
    # A stated number of partitions: the arrays are short, the cells made from them are many.
    total = pairs.agg(F.sum((F.size("left") + F.size("right")).cast("long"))).first()[0] or 0
    parts = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_DIGESTS))
    return pairs.repartition(parts, *keys)


def width_of(attempt: int, first: int) -> Column:
    """Cells per subtable: the first size, then room for the largest possible difference, doubled each time."""
    if not attempt:
        return F.lit(first)
    # Equal versions leave no cell at all; the others are told apart by their counts.
    room = F.greatest(F.lit(8.0), (F.size("left") + F.size("right")) / FILL * 2 ** (attempt - 1))
    return F.pow(F.lit(2.0), F.ceil(F.log2(room)))


def all_of(tables: list[DataFrame]) -> DataFrame:
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.union(more)
    return rows


def differences(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """How many digests only the left and only the right version of each pair has.

    ``pairs`` has the keys (no nulls), ``left`` and ``right`` (arrays of distinct digests). The
    stored size is tried first, then larger ones until every pair is peeled.
    """
    open_pairs, attempt, solved = spread_pairs(pairs, keys), 0, []
    while True:
        cells = difference_cells(open_pairs, keys, width_of(attempt, STORED), attempt)
        result = kept(counted(peeled(cells, keys), keys), "peeled")
        solved.append(result.where("stuck = 0").drop("stuck"))
        left = result.where("stuck > 0")
        if left.isEmpty():
            return all_of(solved)
        open_pairs = open_pairs.join(left.select(*keys), keys, "left_semi")
        attempt += 1


def recovered(pairs: DataFrame, keys: list[str], width: int = STORED) -> DataFrame:
    """The differing digests of each pair: ``digest`` and ``side`` (1 left, -1 right).

    ``width`` is the size tried first. Pairs that it leaves stuck are tried again larger, so every
    differing digest comes out; pairs without a difference have no row.
    """
    open_pairs, attempt, solved = spread_pairs(pairs, keys), 0, []
    while True:
        cells = difference_cells(open_pairs, keys, width_of(attempt, width), attempt)
        rows = kept(peeled(cells, keys, keep_digests=True), "recovered")
        stuck = rows.where("subtable >= 0").select(*keys).distinct()
        solved.append(rows.where("subtable < 0").join(stuck, keys, "left_anti"))
        if stuck.isEmpty():
            return all_of(solved).select(*keys, "digest", F.col("cell").alias("side"))
        open_pairs = open_pairs.join(stuck, keys, "left_semi")
        attempt += 1


def with_next(docs: DataFrame) -> DataFrame:
    """Each document (doc_id, text) with ``next_text``, that of the next id; after the last, the first's.

    Ranges of ids are sorted in tasks of their own. The first document of a range is also sent to
    the end of the range before, so that every text travels once and a few twice. An id with very
    many rows, such as null, has ranges of its own by the hash of the text; only rows that agree in
    id and text stay together.
    """
    top = (1 << 63) - 1  # null ids come last
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(top)).alias("at"),
    )
    ids = rows.select("at")
    count, least, most = ids.agg(F.count("*"), F.min("at"), F.max("at")).first()
    if not count:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    ranges = min(MOST_RANGES, -(-count // RANGE_DOCS))
    wide = min(ranges, QUANTILES)
    quantiles: list[int] = []
    if wide > 1:
        shares = [i / wide for i in range(1, wide)]
        quantiles = ids.agg(F.percentile_approx("at", shares, 10 * wide).alias("b")).first()["b"]
    # An id that is several quantiles holds more than a range should; at most QUANTILES / 2 of them.
    hot = sorted({a for a, b in zip(quantiles, quantiles[1:]) if a == b})
    crowds = dict(map(tuple, ids.where(F.col("at").isin(hot)).groupBy("at").count().collect())) if hot else {}
    edges = {*quantiles, *hot, *(id + 1 for id in hot if id < top)}
    bounds = sorted(edge for edge in edges if edge > least)
    # Each stretch between bounds is cut into ranges, evenly by id or, within one id, by the hash.
    cuts = [-(-ranges // wide) if low not in crowds else min(MOST_RANGES, -(-crowds[low] // RANGE_DOCS)) for low in (least, *bounds)]
    before = list(accumulate(cuts, initial=0))
    at = bisect_column(F.col("at"), bounds, 0, len(bounds)).cast("int")
    rows = rows.withColumn("stretch", at)

    def of_stretch(values: list) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.col("stretch"))

    low, high = of_stretch([least, *bounds]).cast("double"), of_stretch([*bounds, most]).cast("double")
    share = (F.col("at").cast("double") - low) / F.greatest(high - low, F.lit(1.0))
    rows = rows.withColumn("tie", F.lit(""))
    if hot:
        rows = rows.withColumn("tie", F.when(F.col("at").isin(hot), F.md5(F.col("text").cast("binary"))).otherwise(""))
        by_hash = F.conv(F.substring("tie", 1, TIE_DIGITS), 16, 10).cast("double") / float(16**TIE_DIGITS)
        share = F.when(F.col("tie") != "", by_hash).otherwise(share)
    inside = F.greatest(F.lit(0), F.least(of_stretch(cuts) - 1, F.floor(share * of_stretch(cuts))))
    rows = rows.withColumn("part", (of_stretch(before[:-1]) + inside).cast("int")).drop("stretch")
    own = rows.groupBy("part").agg(F.min(F.struct("at", "tie")).alias("first")).select("part", "first.*")
    order = Window.orderBy("part")  # one row per range
    final = F.max("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = own.select("at", "tie", F.coalesce(F.lag("part").over(order), final).alias("host"))
    # A row of some 50 bytes per range; ranges are about MOST_RANGES at most.
    sent = rows.join(F.broadcast(firsts), ["at", "tie"], "left")
    at_home = F.struct("part", F.lit(0).alias("guest"))
    as_guest = F.struct(F.col("host").alias("part"), F.lit(1).alias("guest"))
    places = F.when(F.col("host").isNull(), F.array(at_home)).otherwise(F.array(at_home, as_guest))
    sent = sent.select("doc_id", "text", "at", F.explode(places).alias("to")).select("doc_id", "text", "at", "to.*")
    sent = sent.repartition(before[-1], "part")
    window = Window.partitionBy("part").orderBy("guest", "at", F.md5(F.col("text").cast("binary")))
    sent = sent.withColumn("next_text", F.lead("text").over(window))
    return sent.where("guest = 0").select("doc_id", "text", "next_text")


def bisect_column(value: Column, bounds: list[int], low: int, high: int) -> Column:
    """How many of the sorted bounds are not above the value, as nested conditions."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value < bounds[middle], bisect_column(value, bounds, low, middle)).otherwise(
        bisect_column(value, bounds, middle + 1, high)
    )


def likeness(left: Column, right: Column, left_only: Column, right_only: Column) -> Column:
    """Jaccard likeness of the two paragraph sets from the peeled difference; 1 if both are empty."""
    common = F.size(left) - F.coalesce(left_only, F.lit(0))
    union = F.size(left) + F.coalesce(right_only, F.lit(0))
    return F.when(union == 0, 1.0).otherwise(common.cast("double") / union)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Sketches of every text and of its edited text, and their likeness by peeled differences.

    The edited text has its last half (code points, rounded down) replaced by as many first code
    points of the next document, or all it has. Likeness is over distinct paragraphs.

    Nulls: a null text is empty, null ids come last in the order and stay null. Repeated ids follow
    each other by the hash of their text. Long texts are read whole; repeated rows come out each; a
    single document is its own next. An empty table gives no rows; other columns are not read.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half)
    )
    rows = with_next(docs).select("doc_id", "text", "next_text", edited.alias("edited"))
    rows = rows.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        paragraphs(F.col("text")).alias("own"),
        paragraphs(F.col("edited")).alias("changed"),
        paragraphs(F.col("next_text")).alias("following"),
    )
    rows = kept(rows, "digests")
    versions = F.array(
        F.struct(F.lit("edited").alias("kind"), F.col("changed").alias("right")),
        F.struct(F.lit("next").alias("kind"), F.col("following").alias("right")),
    )
    pairs = rows.select("row", F.col("own").alias("left"), F.explode(versions).alias("v")).select("row", "left", "v.*")
    peels = differences(pairs, ["row", "kind"])
    per_row = peels.groupBy("row").agg(
        *[
            F.max(F.when(F.col("kind") == kind, F.col(name))).alias(f"{kind}_{name}")
            for kind in ("edited", "next")
            for name in ("left_only", "right_only")
        ]
    )
    joined = rows.join(per_row, "row", "left")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(stored_sketch(F.col("own"))).alias("fingerprint"),
        as_text(stored_sketch(F.col("changed"))).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), F.col("edited_left_only"), F.col("edited_right_only")).alias("near_edited"),
        likeness(F.col("own"), F.col("following"), F.col("next_left_only"), F.col("next_right_only")).alias("near_next"),
    )

"""SimHash near-duplicates through BK-trees."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sentinela.llm.common import in_groups, kept, lower_words, text_of

BITS = 64
SEED = 42
# Fingerprints of one tree. More trees, not larger ones, hold a larger bucket; results do not depend on it.
TREE_SIZE = 2048
# Fingerprints sent to cells, copies for several cells included, that a task gets on average.
CELL_ROWS = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash over the XXH64 of all word shingles, repeats included."""
    words = lower_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter((xxh64_intdigest(part, SEED) for part in parts), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        block = hashes[start : start + (1 << 16)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, key: Column | None = None) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long; and ``key``, a text column, if given."""
    extra = [] if key is None else ["key"]

    def made(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array([fingerprint(text, shingle) for text in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": values.view(np.int64), **batch[extra]})

    keys = [] if key is None else [key.alias("key")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *keys)
    return rows.mapInPandas(made, ", ".join(["doc_id long, fp long", *[f"{name} string" for name in extra]]))


class BkTree:
    """BK-tree of distinct integers: children keyed by their Hamming distance to the parent."""

    def __init__(self, values: Iterable[int]):
        values = iter(values)
        self.root = next(values)
        self.children: dict[int, dict[int, int]] = {self.root: {}}
        for value in values:
            self.insert(value)

    def insert(self, value: int) -> None:
        node = self.root
        while True:
            distance = (node ^ value).bit_count()
            if not distance:
                return
            edges = self.children[node]
            if distance not in edges:
                edges[distance] = value
                self.children[value] = {}
                return
            node = edges[distance]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each node with the queries at ``radius`` or less; all queries walk the tree together.

        A query follows an edge only if the triangle inequality lets a match lie behind it.
        """
        stack = [(self.root, queries)]
        while stack:
            node, asked = stack.pop()
            distances = np.bitwise_count(asked ^ np.uint64(node)).astype(np.int16)
            found = asked[distances <= radius]
            if len(found):
                yield node, found
            for edge, child in self.children[node].items():
                follow = asked[np.abs(distances - edge) <= radius]
                if len(follow):
                    stack.append((child, follow))


def joined_pairs(pairs: Iterable[tuple[int, int]]) -> dict[int, int]:
    """Each member of a pair with the smallest member it is linked to."""
    parent: dict[int, int] = {}

    def top(value: int) -> int:
        while parent.setdefault(value, value) != value:
            parent[value] = parent[parent[value]]
            value = parent[value]
        return value

    for left, right in pairs:
        a, b = top(left), top(right)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {value: top(value) for value in list(parent)}


def block_keys(radius: int) -> Column:
    """Array of (block, value): fingerprints within ``radius`` agree in one of radius + 1 blocks."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    blocks = []
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        value = F.shiftrightunsigned("fp", low)
        if high - low < BITS:
            value = value.bitwiseAND(F.lit((1 << (high - low)) - 1))
        blocks.append(F.struct(F.lit(i).alias("block"), value.alias("value")))
    return F.array(*blocks)


def links(classes: DataFrame, radius: int, tree_size: int = TREE_SIZE) -> DataFrame:
    """Pairs (u > v) of distinct fingerprints within ``radius`` that connect all such pairs.

    Fingerprints that agree in a block meet in its bucket, which is cut into shard trees of about
    ``tree_size``; a cell holds one shard's tree and the queries of one shard, so a hot bucket
    becomes many cells of bounded size: n fingerprints make (n / tree_size)^2 / 2 cells, and each
    is sent to n / tree_size of them. A cell returns a spanning star per component.
    """
    members = classes.select("fp", F.explode(block_keys(radius)).alias("key")).select("fp", "key.*")
    sizes = members.groupBy("block", "value").agg(F.count("*").alias("size")).where("size > 1")
    sizes = kept(sizes, "buckets")
    sent = sizes.agg(F.sum(F.col("size") * F.ceil(F.col("size") / tree_size))).first()[0] or 0
    # A stated number, since walking trees takes long for few bytes and tasks would be merged by bytes.
    parts = max(2 * classes.sparkSession.sparkContext.defaultParallelism, -(-int(sent) // CELL_ROWS))
    spread = (
        members.join(sizes, ["block", "value"])
        .withColumn("shards", F.ceil(F.col("size") / tree_size).cast("int"))
        .withColumn("shard", F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("other"))
        .select(
            "block", "value", "fp", "shard",
            F.least("shard", "other").alias("asking"), F.greatest("shard", "other").alias("tree"),
        )
    )
    keys = ["block", "value", "tree", "asking"]

    def search(key: tuple, cell: pd.DataFrame) -> pd.DataFrame | None:
        values = cell["fp"].to_numpy().view(np.uint64)
        shard = cell["shard"].to_numpy()
        in_tree = values[shard == key[2]]
        asked = values[shard == key[3]]
        if not len(in_tree) or not len(asked):
            return None
        tree = BkTree(np.sort(in_tree).tolist())
        found = ((node, query) for node, hits in tree.within(asked, radius) for query in hits.tolist())
        stars = [(value, least) for value, least in joined_pairs(found).items() if value != least]
        if not stars:
            return None
        pairs = np.array(stars, dtype=np.uint64).view(np.int64)
        return pd.DataFrame({"u": pairs.max(axis=1), "v": pairs.min(axis=1)})

    cells = spread.repartition(parts, *keys).sortWithinPartitions(*keys)
    return cells.mapInPandas(lambda batches: in_groups(batches, keys, search), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, its component's smallest node, for every node of the edges (u > v).

    Alternating large-star and small-star steps; each round is written down, so lineage stays
    short. Nothing is collected but the count and checksum that show the fixpoint.
    """
    edges = kept(edges.select("u", "v").where("u <> v"), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = kept(small.where("u <> v").distinct(), "edges")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def with_roots(classes: DataFrame, radius: int, tree_size: int) -> DataFrame:
    """The classes (fp and others) with ``root``, the smallest fingerprint of their component."""
    roots = components(links(classes, radius, tree_size))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, tree_size: int = TREE_SIZE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex) and ``component_id``, the smallest doc_id reachable by links.

    Copies share a fingerprint and are one node. Nulls: a null text is empty and has fingerprint
    zero, like a text of white space; a null doc_id is kept, is never a component's smallest id,
    and a component of null ids has a null id. Repeated rows come out each. Empty tables give no rows.
    """
    prints = kept(fingerprints(docs, shingle), "fingerprints")
    classes = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    placed = with_roots(classes, radius, tree_size)
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2, tree_size: int = TREE_SIZE) -> DataFrame:
    """The first row of every group, once; the columns stay.

    Rows are ordered by id, hash of the text and hash of the other columns. Rows that repeat an id
    are compared by their own texts. Rows without an id form groups among themselves.
    """
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    hashes = [F.md5(text_of().cast("binary")), F.md5(F.to_json(F.struct(F.col("text").isNull().alias("_no_text"), *others)).cast("binary"))]
    key = F.concat(*hashes)

    def first_rows(rows: DataFrame) -> DataFrame:
        prints = kept(fingerprints(rows, shingle, key), "fingerprints")
        first = F.min(F.struct("doc_id", "key")).alias("first")
        classes = kept(prints.groupBy("fp").agg(first), "classes")
        firsts = with_roots(classes, radius, tree_size).groupBy("root").agg(F.min("first").alias("first"))
        firsts = firsts.select(F.col("first.doc_id").alias("_first_id"), F.col("first.key").alias("_first_key"))
        same = F.col("doc_id").cast("long").eqNullSafe(F.col("_first_id")) & (F.col("_row_key") == F.col("_first_key"))
        stays = rows.withColumn("_row_key", key).join(firsts, same, "left_semi")
        # What is left twice is equal in every column.
        return stays.dropDuplicates(["doc_id", "_row_key"]).select(docs.columns)

    stays, nameless = first_rows(docs.where("doc_id IS NOT NULL")), docs.where("doc_id IS NULL")
    return stays if nameless.isEmpty() else stays.union(first_rows(nameless))

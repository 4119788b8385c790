"""MinHash near-duplicates checked by odd sketches."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.llm.common import in_groups, kept, text_of
from sentinela.llm.simhash import components, joined_pairs


class Settings(NamedTuple):
    """Sizes of the sketches; they decide how many pairs are looked at, not which of them are linked.

    ``bands`` of ``rows`` samples each bring documents together; ``samples`` are folded into an odd
    sketch of ``bits``. A pair of similarity 0.8 misses all 28 bands of 4 with a chance of 4e-7 and
    fails the sketch test, ``deviations`` standard deviations below the mean, with 4e-6.
    """

    width: int = 4
    percent: int = 80
    bands: int = 28
    rows: int = 4
    samples: int = 256
    bits: int = 1024
    deviations: float = 4.5
    # Documents and shingles of one shard of a bucket: what a task may hold, without effect on results.
    shard_rows: int = 4096
    shard_shingles: int = 1 << 21


def mixed(values: np.ndarray) -> np.ndarray:
    """Bijective mixing of unsigned 64-bit integers."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


# Bytes get random-looking values; a word's hash is the sum of its bytes' values times powers of an
# odd number, taken from running sums over the whole text, and then mixed.
SEPARATES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BYTE_VALUES = mixed(np.arange(1001, 1257, dtype=np.uint64))
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


class Powers:
    """Powers of the base and of its inverse, as far as the longest text so far needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def upto(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        if length > len(self.up):
            both = []
            for factor in (BASE, INVERSE):
                factors = np.full(2 * length, factor, dtype=np.uint64)
                factors[0] = 1
                both.append(np.cumprod(factors))
            self.up, self.down = both
        return self.up[:length], self.down[:length]


def chunks(data: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """Parts of about ``length`` bytes that end between words, so that a very long text needs little memory at once."""
    start = 0
    while start < len(data):
        end = start + length
        while end < len(data):
            gaps = np.flatnonzero(SEPARATES[data[end : end + length]])
            if len(gaps):
                end += int(gaps[0])
                break
            end += length
        yield data[start:end]
        start = end


def word_hashes(data: np.ndarray, powers: Powers) -> np.ndarray:
    """Hashes of the words in order."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~SEPARATES[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[0::2], edges[1::2]
    up, down = powers.upto(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * up, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def shingle_set(text: str | None, width: int, powers: Powers, length: int = 1 << 20) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; fewer words than ``width`` are one shingle."""
    data = np.frombuffer((text or "").encode().lower(), dtype=np.uint8)
    parts = [word_hashes(part, powers) for part in chunks(data, length)]
    hashes = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)
    if not len(hashes):
        return hashes
    size = min(width, len(hashes))
    chain = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
    for place in range(size):
        chain = mixed(chain * np.uint64(BASE) + hashes[place : place + len(chain)])
    return np.unique(chain)


def sample_keys(samples: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = mixed(np.arange(1, 2 * samples + 1, dtype=np.uint64))
    return numbers[:samples], numbers[samples:] | np.uint64(1)


def minima(members: np.ndarray, keys: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The MinHash samples of a set."""
    shift, factor = keys
    least = np.full(len(shift), np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(members), 256):
        block = (members[start : start + 256, None] ^ shift) * factor
        np.minimum(least, block.min(axis=0), out=least)
    return least


def odd_sketches(least: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps: each sample flips the bit that it hashes to. One row of bytes per set."""
    rows, samples = least.shape
    place = mixed(least + np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(BASE)) % np.uint64(bits)
    flat = place.astype(np.int64) + bits * np.arange(rows)[:, None]
    odd = (np.bincount(flat.ravel(), minlength=rows * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(rows, bits), axis=1)


def estimate(differing: np.ndarray | float, settings: Settings) -> np.ndarray:
    """Similarity from the number of bits in which two odd sketches differ."""
    share = np.minimum(2 * np.asarray(differing, dtype=float) / settings.bits, 1 - 1e-9)
    return 1 + settings.bits / (4 * settings.samples) * np.log(1 - share)


def most_differing(settings: Settings) -> int:
    """Bits in which the sketches of a pair at the threshold differ, and the allowed deviations on top."""
    level = settings.percent / 100
    unlike = 2 * settings.samples * (1 - level)
    ratio = unlike / settings.bits
    mean = settings.bits / 2 * (1 - math.exp(-2 * ratio))
    sampling = 4 * settings.samples * level * (1 - level) * math.exp(-4 * ratio)
    folding = settings.bits / 4 * (1 - math.exp(-4 * ratio)) - unlike * math.exp(-4 * ratio)
    return math.ceil(mean + settings.deviations * math.sqrt(sampling + max(0.0, folding)))


def digest_of(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id``, ``node`` (the text's digest), ``size`` of the set, band ``keys`` and the odd ``sketch``.

    Keys and sketch are null for empty sets.
    """
    numbers = sample_keys(settings.samples)
    banded = settings.bands * settings.rows

    def made(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            powers = Powers()
            sizes, least = [], []
            for text in batch["text"]:
                members = shingle_set(text, settings.width, powers)
                sizes.append(len(members))
                least.append(minima(members, numbers))
            if not sizes:
                continue
            samples = np.stack(least)
            sketches = odd_sketches(samples, settings.bits)
            parts = samples[:, :banded].reshape(len(samples), settings.bands, settings.rows)
            keys = np.broadcast_to(np.arange(settings.bands, dtype=np.uint64), parts.shape[:2])
            for row in range(settings.rows):
                keys = mixed(keys * np.uint64(BASE) + parts[:, :, row])
            some = np.array(sizes) > 0
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "node": batch["node"],
                    "size": np.array(sizes, dtype=np.int64),
                    "keys": pd.Series([k if s else None for k, s in zip(keys.view(np.int64), some)], index=batch.index, dtype=object),
                    "sketch": pd.Series([k.tobytes() if s else None for k, s in zip(sketches, some)], index=batch.index, dtype=object),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("node", digest_of(F.col("text")))
    return rows.mapInPandas(made, "doc_id long, node binary, size long, keys array<long>, sketch binary")


def shared_buckets(classes: DataFrame, settings: Settings) -> DataFrame:
    """``key``, ``node``, ``shards`` and ``shard`` for the members of buckets with company.

    A large bucket, by documents or by shingles, is cut into shards.
    """
    members = classes.select(F.explode("keys").alias("key"), "node", "size")
    buckets = members.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("shingles")).where("n > 1")
    shards = F.greatest(F.ceil(F.col("n") / settings.shard_rows), F.ceil(F.col("shingles") / settings.shard_shingles))
    buckets = buckets.select("key", shards.cast("int").alias("shards"))
    return members.join(buckets, "key").select(
        "key", "node", "shards", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int").alias("shard")
    )


CELL = ["key", "low", "high"]
SMALL_CELL = 64


def group_starts(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where runs of equal keys start, and the end."""
    changes = np.zeros(max(len(rows) - 1, 0), dtype=bool)
    for key in keys:
        column = rows[key].to_numpy()
        changes |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(changes) + 1, [len(rows)]])


def whole_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches of a partition sorted by the keys, cut so that no run of equal keys is divided."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        last = int(group_starts(batch, keys)[-2])
        head = batch.iloc[:last]
        if rest and (last or any(rest[-1][key].iat[-1] != batch[key].iat[0] for key in keys)):
            yield pd.concat([*rest, head], ignore_index=True)
            rest = []
        elif last:
            yield head.reset_index(drop=True)
        rest.append(batch.iloc[last:])
    if rest:
        yield pd.concat(rest, ignore_index=True)


def pairs_within(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places (one < two) of each group of places."""
    places = np.repeat(starts, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    later = np.repeat(starts + lengths, lengths) - places - 1
    one = np.repeat(places, later)
    return one, one + 1 + np.arange(later.sum()) - np.repeat(np.cumsum(later) - later, later)


def diagonal(buckets: DataFrame) -> DataFrame:
    """Each shard with itself."""
    return buckets.select("key", F.col("shard").alias("low"), F.col("shard").alias("high"), "node", "shard")


def across(buckets: DataFrame) -> DataFrame:
    """Each shard with every other shard of its bucket."""
    spread = buckets.where("shards > 1").select("*", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("other"))
    return spread.where("shard <> other").select(
        "key", F.least("shard", "other").alias("low"), F.greatest("shard", "other").alias("high"), "node", "shard"
    )


def candidates(cells: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """The cells' members that have a partner: ``key, low, high, node``.

    Partners pass the length filter and the odd sketch test, lie in different components so far
    (``root``), and meet in this bucket first: of the bands that two documents share only the
    first looks at them. Rows are members, never pairs.
    """
    limit = most_differing(settings)

    def fit(one: np.ndarray, two: np.ndarray, bits: np.ndarray, sizes: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """Whether the rows at ``one`` and ``two``, indices that broadcast, may be partners."""
        differing = np.zeros(np.broadcast(one, two).shape, dtype=np.int32)
        for word in range(bits.shape[1]):
            differing += np.bitwise_count(bits[one, word] ^ bits[two, word])
        near = (differing <= limit) & (roots[one] != roots[two])
        return near & (100 * np.minimum(sizes[one], sizes[two]) >= settings.percent * np.maximum(sizes[one], sizes[two]))

    def search(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, CELL):
            shard, low, high = (rows[name].to_numpy() for name in ("shard", "low", "high"))
            sizes = rows["size"].to_numpy()
            roots = pd.factorize(rows["root"])[0]
            keys = np.stack(rows["keys"].to_numpy())
            own = rows["key"].to_numpy()
            bits = np.frombuffer(b"".join(rows["sketch"]), dtype="<u8").reshape(len(rows), -1)
            found = np.zeros(len(rows), dtype=bool)

            def mark(one: np.ndarray, two: np.ndarray) -> None:
                """Partners whose first common band is that of their cell."""
                first = (keys[one] == keys[two]).argmax(axis=1)
                here = keys[one, first] == own[one]
                found[one[here]] = True
                found[two[here]] = True

            starts = group_starts(rows, CELL)
            lengths = np.diff(starts)
            # Small cells, nearly all, go through together, as pairs of places; large ones block by block.
            small = np.flatnonzero(lengths <= SMALL_CELL)
            for some in np.array_split(small, max(1, int((lengths[small] ** 2).sum() >> 18))):
                one, two = pairs_within(starts[some], lengths[some])
                meet = (shard[one] != shard[two]) | (low[one] == high[one])
                one, two = one[meet], two[meet]
                near = fit(one, two, bits, sizes, roots)
                mark(one[near], two[near])
            for cell in np.flatnonzero(lengths > SMALL_CELL):
                members = np.arange(starts[cell], starts[cell + 1])
                left, right = members[shard[members] == low[members]], members[shard[members] == high[members]]
                for start in range(0, len(left), 64):
                    asking = left[start : start + 64]
                    one, two = np.nonzero(fit(asking[:, None], right[None, :], bits, sizes, roots))
                    mark(asking[one], right[two])
            if found.any():
                yield rows.loc[found, [*CELL, "node"]]

    # Every text is its own component at first.
    rows = cells.join(classes.select("node", "root", "size", "keys", "sketch"), "node")
    rows = spread_out(rows).select(*CELL, "node", "shard", "root", "size", "keys", "sketch")
    return rows.mapInPandas(search, "key long, low int, high int, node binary")


def spread_out(cells: DataFrame) -> DataFrame:
    """Cells in as many partitions as shuffles have; merging by bytes would ignore the work in them."""
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(parts, *CELL).sortWithinPartitions(*CELL)


def full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """``node`` and ``members``, the sorted shingle hashes, of the wanted classes."""
    first = classes.join(wanted, "node", "left_semi").select("node", F.col("first").alias("_first"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("node", digest_of(F.col("text")))
    rows = rows.join(first, "node").where(F.col("doc_id").eqNullSafe(F.col("_first"))).select("node", "text")

    def made(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            powers = Powers()
            sets = [shingle_set(text, settings.width, powers).view(np.int64) for text in batch["text"]]
            yield pd.DataFrame({"node": batch["node"], "members": pd.Series(sets, index=batch.index, dtype=object)})

    # Rows may repeat an id and its text.
    return rows.dropDuplicates(["node"]).mapInPandas(made, "node binary, members array<long>")


def confirmed(cells: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links (u > v) that hold on the full sets and connect all that hold within a cell."""

    def search(key: tuple, cell: pd.DataFrame) -> pd.DataFrame | None:
        nodes = cell["node"].to_numpy()
        sets = cell["members"].to_numpy()
        sizes = np.array([len(members) for members in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        values, codes = np.unique(np.concatenate(sets), return_inverse=True)
        codes = codes.reshape(-1)
        # Postings: the sets that hold a value; a set's intersections with all others are one count over them.
        by_value = np.argsort(codes, kind="stable")
        holders = owner[by_value]
        starts = np.searchsorted(codes[by_value], np.arange(len(values) + 1))
        common = np.diff(starts) > 1
        place = np.concatenate([[0], np.cumsum(sizes)])
        links = []
        for i in range(len(sets)):
            mine = codes[place[i] : place[i + 1]]
            mine = mine[common[mine]]
            if not len(mine):
                continue
            lengths = starts[mine + 1] - starts[mine]
            ends = np.cumsum(lengths)
            spots = np.arange(ends[-1]) + np.repeat(starts[mine] - (ends - lengths), lengths)
            shared = np.bincount(holders[spots], minlength=len(sets))
            linked = np.flatnonzero((100 + settings.percent) * shared >= settings.percent * (sizes + sizes[i]))
            links.extend((i, int(j)) for j in linked if j > i)
        stars = [(value, least) for value, least in joined_pairs(links).items() if value != least]
        if not stars:
            return None
        ends = [sorted((nodes[value], nodes[least])) for value, least in stars]
        return pd.DataFrame({"u": [high for _, high in ends], "v": [low for low, _ in ends]})

    rows = spread_out(cells.join(sets, "node").select(*CELL, "node", "members"))
    return rows.mapInPandas(lambda batches: in_groups(batches, CELL, search), "u binary, v binary").distinct()


def with_roots(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """The classes with ``root``, one node of their component."""
    roots = components(edges)
    joined = classes.drop("root").join(roots, "node", "left")
    return joined.withColumn("root", F.coalesce("root", "node"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest doc_id reachable by links) and ``kept``.

    Documents link at 100 * intersection >= percent * union of their sets of word shingles. Equal
    texts are one class. MinHash bands bring classes together, odd sketches pick those that may be
    similar enough, and the full sets of those are compared, in cells of bounded size. Buckets of
    several shards are first linked within shards; pairs across shards are only looked at where the
    two are not yet in one component.

    Nulls: a null text is empty. Documents without words have an empty set, are linked with nothing,
    not even with rows of the same text, and have their own id as component. A null doc_id is kept
    and never a component's smallest id; a component of such rows only has a null id. ``kept`` says
    that the row has its component's id (rows without id: that the component has none). Repeated rows
    come out each. Empty tables give no rows; columns other than doc_id and text are not read.
    """
    prints = kept(signatures(docs, settings), "signatures")
    classes = prints.where("size > 0").groupBy("node").agg(
        F.min("doc_id").alias("first"), F.first("size").alias("size"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")
    )
    classes = kept(classes, "classes").withColumn("root", F.col("node"))
    buckets = kept(shared_buckets(classes, settings), "buckets")

    def links(cells: DataFrame, classes: DataFrame) -> DataFrame:
        found = kept(candidates(cells, classes, settings), "candidates")
        sets = full_sets(docs, classes, found.select("node").distinct(), settings)
        return confirmed(found, sets, settings)

    edges = links(diagonal(buckets), classes)
    if buckets.where("shards > 1").isEmpty():
        placed = with_roots(classes, edges)
    else:
        edges = kept(edges, "links")
        placed = kept(with_roots(classes, edges), "placed")
        placed = with_roots(classes, edges.union(links(across(buckets), placed)))
    placed = placed.select("node", "first", "root")
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "root").select("node", "component_id")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    rows = prints.select("doc_id", "node", "size").join(named, "node", "left").withColumn("component_id", component)
    return rows.select(
        "doc_id", F.col("size").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )

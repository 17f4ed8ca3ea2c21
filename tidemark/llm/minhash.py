"""Near-duplicate documents by circulant MinHash, banding and an exact check.

A document's set is its different shingles of neighbouring words, A-Z lowered. One permutation spreads the
shingles over ``CELLS`` cells; a second one, shifted by one cell for each coordinate, gives all
coordinates of the signature: coordinate k is the least value of the second permutation at (cell + k).
Coordinates are banded; documents that agree in a band are candidates, and links are confirmed on the full
sets.

Documents with equal sets are one class before any banding. Each band's bucket has a center, the document of
it that shares most buckets. In a first round each document is tested against the best center of its buckets;
near copies mostly meet this way. In a second one the documents of buckets that still hold several components are
tested against the centers there. In what is left after that, pairs of different components are looked at in blocks
of bounded size, a bucket's largest component never with itself, and a pair is tested if

* this bucket is the first that both share,
* the shingles that no other document left has leave enough for a link, and
* their signatures, four bits of each coordinate, do not tell them apart by 5.5 standard deviations.

With 80 bands of 8 coordinates, all bands miss a pair of likeness 0.8 less than once in a million.

Defined results: a null or empty text, or one without words, has the empty set and is linked with nothing;
a text of fewer words than a shingle has one shingle, its whole sequence; repeated rows are equal
documents; rows that share an id are told apart by their sets; rows with a null id take part in no link,
have no component and are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans as S
from tidemark.llm.rows import at_most, by_batch, discard, stored, tidy

SHINGLE_WORDS = 5
MIN_PERCENT = 80
BANDS, BAND_ROWS = 80, 8
CELLS = 1 << 22
WORDS = BANDS * BAND_ROWS // 16  # numbers that hold four bits of each coordinate
SEED = 7
BAND_MASK = 127  # the bits of a bucket that number its band
BLOCK_ROWS = 2048  # documents of a bucket that a task compares with as many others
STREAM_ROWS = 1 << 17  # documents of a bucket's largest component that pass by such a block
SPOKES = 1000  # pairs that are tested against one copy of a text
TEXT_BYTES = 4 << 20  # text that a worker is sent at once, about; its sets take some ten times that
BROADCAST_IDS = 1_000_000  # ids of 16 bytes that are broadcast at most
DEVIATIONS = 5.5
SALTS = (0x1F83D9AB, 0x5DEECE66D)

_windows: np.ndarray | None = None


def windows() -> np.ndarray:
    """Row c holds the second permutation's values from cell c on, one for each coordinate, without copies."""
    global _windows
    if _windows is None:
        values = np.random.default_rng(SEED).permutation(CELLS).astype(np.uint32)
        wrapped = np.concatenate([values, values[: BANDS * BAND_ROWS]])
        _windows = np.lib.stride_tricks.sliding_window_view(wrapped, BANDS * BAND_ROWS)
    return _windows


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All sets, one after another and each in order; and where each text's set ends, from 0 on."""
    found, sizes = [np.zeros(0, np.uint64)], [0]
    for chunk in S.chunks(texts):
        starts, ends, owners = chunk.runs(S.WORD_BYTE)
        words = S.hash_between(S.running_hash(chunk.data, S.LOWER), starts, ends)
        hashes, at = S.grams(words, owners, n)
        counts = np.bincount(owners, minlength=chunk.n)
        first = np.cumsum(counts) - counts
        bounds = np.searchsorted(owners[at], np.arange(chunk.n + 1))
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if b > a:
                own = np.sort(hashes[a:b])
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            else:
                own = words[first[i] : first[i] + counts[i]]  # at most one shingle, of all words
                for k in range(1, len(own)):
                    own[0] = S.mix(own[:1] * np.uint64(0x9DDFEA08EB382D69) + own[k])[0]
                own = own[:1] + np.uint64(len(own))
            found.append(own)
            sizes.append(len(own))
    return np.concatenate(found), np.cumsum(sizes)


def signatures(members: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The circulant signature of each set; of an empty one, the largest values."""
    cells = (S.mix(members ^ np.uint64(0xA5A5A5A5)) >> np.uint64(64 - 22)).astype(np.int64)
    least = np.full((len(ends) - 1, BANDS * BAND_ROWS), 0xFFFFFFFF, np.uint32)
    rows = windows()
    for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        for at in range(a, b, 1024):
            np.minimum(least[i], rows[cells[at : min(at + 1024, b)]].min(axis=0), out=least[i])
    return least


def buckets(least: np.ndarray) -> np.ndarray:
    """The bucket of each signature and band: a hash of the band, whose last bits are the band's number."""
    rows = least.reshape(len(least), BANDS, BAND_ROWS).astype(np.uint64)
    joined = np.tile(np.arange(BANDS, dtype=np.uint64), (len(least), 1))
    for k in range(BAND_ROWS):
        joined = S.mix(joined * np.uint64(0x9DDFEA08EB382D69) + rows[:, :, k])
    joined = (joined & ~np.uint64(BAND_MASK)) | np.arange(BANDS, dtype=np.uint64)
    return joined.view(np.int64)


def nibbles(least: np.ndarray) -> np.ndarray:
    """Four bits of each coordinate, sixteen to a number."""
    low = (least & 15).astype(np.uint64).reshape(len(least), -1, 16)
    return np.bitwise_or.reduce(low << (4 * np.arange(16, dtype=np.uint64)), axis=2)


def _array(rows: np.ndarray) -> pa.Array:
    values = pa.array(rows.ravel())
    return pa.FixedSizeListArray.from_arrays(values, rows.shape[1]).cast(pa.list_(values.type))


def sketch(documents: DataFrame, n: int, *also: str) -> DataFrame:
    """doc_id, n_shingles, a hash of the set (node) and a second one, and the buckets of each row.

    Columns in ``also`` (bigint) are kept beside them.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        members, ends = shingles(batch.column("text"), n)
        bands = [np.zeros((0, BANDS), np.int64)]
        for i in range(0, len(ends) - 1, 512):
            bands.append(buckets(signatures(members, ends[i : i + 513])))
        hashes = [pa.array(set_hash(members, ends, salt)) for salt in SALTS]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(np.diff(ends)), *hashes, _array(np.concatenate(bands)),
                *map(batch.column, also),
            ],
            ["doc_id", "n_shingles", "node", "check", "bands", *also],
        )

    taken = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *also)
    return taken.mapInArrow(
        by_batch(run),
        "doc_id bigint, n_shingles bigint, node bigint, check bigint, bands array<bigint>"
        + "".join(f", {c} bigint" for c in also),
    )


def set_hash(members: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each set, whatever the order of its members."""
    sums = np.zeros(len(members) + 1, np.uint64)
    np.cumsum(S.mix(members ^ np.uint64(salt)), out=sums[1:])
    return S.mix(sums[ends[1:]] - sums[ends[:-1]]).astype(np.int64)


def texts_of(documents: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """node and text of the sets in ``wanted`` (node and the doc_id of a text that has the set).

    The ids are broadcast if there are few, so that no other text is shuffled.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        members, ends = shingles(batch.column("text"), n)
        own = set_hash(members, ends, SALTS[0]) == batch.column("node").to_numpy()
        return batch.select(["node", "text"]).filter(pa.array(own))

    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = texts.join(at_most(wanted, BROADCAST_IDS), "doc_id").select("node", "text")
    return found.mapInArrow(by_batch(run), "node bigint, text string").dropDuplicates(["node"])


def linked_ones(pairs: DataFrame, texts: DataFrame, n: int, min_percent: int) -> DataFrame:
    """low and high of the pairs (hub, partner, low, high) whose sets are alike enough.

    A hub's text goes once to each ``SPOKES`` of its partners, and each partner's text to its hub.
    """
    counts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / SPOKES).alias("parts"))
    dealt = pairs.join(counts, "hub").withColumn("part", F.pmod(F.xxhash64("partner"), "parts")).drop("parts")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    hubs = counts.select("hub", every).join(texts.withColumnRenamed("node", "hub"), "hub")
    spokes = dealt.join(texts.withColumnRenamed("node", "partner"), "partner")
    columns = ["hub", "part", "partner", "low", "high", "text"]
    nothing = F.lit(None).cast("bigint")
    rows = hubs.withColumns({c: nothing for c in ("partner", "low", "high")}).select(columns).unionAll(spokes.select(columns))

    @tidy
    def run(batches):
        held, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            members, ends = shingles(batch.column("text"), n)
            hub, part, low, high = (batch.column(c).to_pylist() for c in ("hub", "part", "low", "high"))
            found = []
            for i in range(batch.num_rows):
                mine = members[ends[i] : ends[i + 1]]
                if low[i] is None:
                    held, own = (hub[i], part[i]), mine
                    continue
                if held != (hub[i], part[i]):
                    raise ValueError(f"no text of {hub[i]} came before its partners")
                common = np.count_nonzero(mine[np.minimum(np.searchsorted(mine, own), len(mine) - 1)] == own)
                if 100 * common >= min_percent * (len(mine) + len(own) - common):
                    found.append((low[i], high[i]))
            columns = np.array(found, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["low", "high"])

    sorted_rows = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("partner").asc_nulls_first())
    return sorted_rows.mapInArrow(run, "low bigint, high bigint").distinct()


def connected(links: DataFrame) -> DataFrame:
    """node and component (the least node reachable) of all nodes of the undirected links (a, b).

    Each round hands the least label seen along links to both ends and then follows labels to their own
    labels, until nothing changes; labels are written between rounds, and earlier ones deleted.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct())
    held = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")))
    while True:
        labels = held.select("node", "component")
        seen = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        spread = labels.join(seen, labels.node == seen.a).select(
            "node", F.least("component", "near").alias("next"), F.col("component").alias("was")
        )
        own = labels.select(F.col("node").alias("next"), F.col("component").alias("further"))
        jumped = spread.join(own, "next", "left").select(
            "node", "was", F.least("next", F.coalesce("further", "next")).alias("component")
        )
        jumped = stored(jumped)
        discard(held)
        if jumped.where("was <> component").isEmpty():
            discard(both)
            return jumped.select("node", "component")
        held = jumped


def with_common(joinable: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """The rows with ``common``: how many of the document's shingles another document of the rows has.

    No link to one of them can share more.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        members, ends = shingles(batch.column("text"), n)
        node = np.repeat(batch.column("node").to_numpy(), np.diff(ends))
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(members.view(np.int64))], ["node", "shingle"])

    nodes = joinable.select("node").distinct()
    spread = texts.join(nodes, "node", "left_semi").mapInArrow(by_batch(run), "node bigint, shingle bigint")
    alone = spread.groupBy("shingle").agg(F.count("*").alias("held"), F.min("node").alias("node"))
    alone = alone.where("held = 1").groupBy("node").agg(F.count("*").alias("alone"))
    left = F.col("n_shingles") - F.coalesce("alone", F.lit(0))
    return joinable.join(alone, "node", "left").withColumn("common", left).drop("alone")


def most_unlike(min_percent: int) -> int:
    """Coordinates whose four bits may differ between documents that are linked."""
    n = BANDS * BAND_ROWS
    share = (1 - min_percent / 100) * 15 / 16
    return int(n * share + DEVIATIONS * (n * share * (1 - share)) ** 0.5)


def sketches_of(texts: DataFrame, n: int) -> DataFrame:
    """node, buckets and four bits of each coordinate of the signature."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        members, ends = shingles(batch.column("text"), n)
        bands, bits = [np.zeros((0, BANDS), np.int64)], [np.zeros((0, WORDS), np.int64)]
        for i in range(0, len(ends) - 1, 512):
            least = signatures(members, ends[i : i + 513])
            bands.append(buckets(least))
            bits.append(nibbles(least).view(np.int64))
        lists = [_array(np.concatenate(x)) for x in (bands, bits)]
        return pa.RecordBatch.from_arrays([batch.column("node"), *lists], ["node", "bands", "bits"])

    return texts.mapInArrow(by_batch(run), "node bigint, bands array<bigint>, bits array<bigint>")


@dataclass
class Side:
    """Documents of a bucket, as columns."""

    node: np.ndarray
    component: np.ndarray
    size: np.ndarray
    common: np.ndarray
    block: np.ndarray
    bands: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(rows: pa.Table) -> Side:
        lists = (rows[c].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1) for c in ("bands", "bits"))
        bands, bits = lists
        flat = (rows[c].to_numpy() for c in ("node", "component", "n_shingles", "common", "block"))
        return Side(*flat, bands, bits.view(np.uint64))

    def __len__(self) -> int:
        return len(self.node)


def pairs_between(
    one: Side, other: Side, bucket: int, min_percent: int, cross: bool | None
) -> list[tuple[int, int, int, int]]:
    """Nodes and components of the pairs of two sides that have to be tested.

    With ``cross`` None all pairs are looked at; otherwise both sides are one block (False) or two blocks
    (True), whose pairs are looked at once.
    """
    earlier = bucket & BAND_MASK
    ones, unlike, found = np.uint64(0x1111111111111111), most_unlike(min_percent), []
    for x in range(len(one)):
        after = 0 if cross is None else x + 1
        most = np.minimum(one.common[x], other.common[after:])
        fits = 100 * most >= min_percent * (one.size[x] + other.size[after:] - most)
        fits &= other.component[after:] != one.component[x]
        if cross:
            fits &= other.block[after:] != one.block[x]
        y = after + np.flatnonzero(fits)
        if len(y):
            y = y[~(other.bands[y, :earlier] == one.bands[x, :earlier]).any(axis=1)]
            off = other.bits[y] ^ one.bits[x]
            off |= off >> np.uint64(2)
            off |= off >> np.uint64(1)
            y = y[np.bitwise_count(off & ones).sum(axis=1, dtype=np.int64) <= unlike]
        found += [(int(one.node[x]), int(other.node[k]), int(one.component[x]), int(other.component[k])) for k in y]
    return found


def dealt_rows(joinable: DataFrame) -> DataFrame:
    """The rows of ``joinable`` in the tiles (bucket, i, j) in which they are compared.

    A bucket's largest component is not compared with itself. The rest is cut into blocks of ``BLOCK_ROWS``; each
    pair of blocks is a tile, and each block (i) with each stretch of ``STREAM_ROWS`` of the largest component (j < 0),
    of which only one row at a time has to be held.
    """
    sizes = joinable.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", "component"))
    cuts = sizes.groupBy("bucket").agg(largest.alias("largest"), F.sum("n").alias("n")).select(
        "bucket",
        F.col("largest.component").alias("main"),
        F.ceil(F.col("largest.n") / STREAM_ROWS).alias("stretches"),
        F.ceil((F.col("n") - F.col("largest.n")) / BLOCK_ROWS).alias("blocks"),
    )
    rows = joinable.join(cuts, "bucket")
    deal = F.xxhash64("node", "bucket")

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)

    kept = ["bucket", "i", "j", "side", "block", "node", "component", "n_shingles", "common"]
    main = rows.where("component = main").withColumn("block", F.lit(-1).cast("bigint"))
    main = main.withColumns({"i": F.explode(upto("blocks")), "j": -1 - F.pmod(deal, "stretches"), "side": F.lit(1)})
    rest = rows.where("component <> main").withColumn("block", F.pmod(deal, "blocks"))
    tiles = F.concat(
        F.transform(upto("stretches"), lambda k: F.struct(F.col("block").alias("i"), (-1 - k).alias("j"))),
        F.transform(upto("blocks"), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j"))),
    )
    rest = rest.withColumn("tile", F.explode(tiles)).withColumns(
        {"i": F.col("tile.i"), "j": F.col("tile.j"), "side": F.lit(0)}
    )
    return main.select(kept).unionAll(rest.select(kept))


def pairs_left(joinable: DataFrame, sketches: DataFrame, min_percent: int) -> DataFrame:
    """The pairs of different components, in the first bucket that both share, that have to be tested."""

    @tidy
    def run(batches):
        key, held = None, []

        def compared(tile: tuple, rows: pa.Table) -> list[tuple]:
            """Pairs of a tile's rows; where they are streamed, the block's rows come first and are held."""
            if tile[2] >= 0:
                side = Side.of(rows)
                return pairs_between(side, side, tile[0], min_percent, tile[1] != tile[2])
            is_main = rows["side"].to_numpy() == 1
            if not is_main.all():
                held.append(rows.filter(pa.array(~is_main)))
            if not is_main.any() or not held:
                return []
            block = Side.of(pa.concat_tables(held))
            return pairs_between(block, Side.of(rows.filter(pa.array(is_main))), tile[0], min_percent, None)

        def emit(found: list[tuple]) -> pa.RecordBatch:
            columns = np.array(found, np.int64).reshape(-1, 4).T
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "low", "high"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            keys = np.column_stack([rows[c].to_numpy() for c in ("bucket", "i", "j")])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            found = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                tile, part = tuple(keys[a].tolist()), rows.slice(a, b - a)
                if tile != key:
                    if key and key[2] >= 0:
                        found += compared(key, pa.concat_tables(held))
                    key, held = tile, []
                if tile[2] >= 0:
                    held.append(part)
                else:
                    found += compared(tile, part)
            yield emit(found)
        if key and key[2] >= 0:
            yield emit(compared(key, pa.concat_tables(held)))

    wide = dealt_rows(joinable).join(sketches, "node")
    dealt = wide.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side")
    pairs = dealt.mapInArrow(run, "a bigint, b bigint, low bigint, high bigint")
    ends = (F.struct("a", "low"), F.struct(F.col("b").alias("a"), F.col("high").alias("low")))
    least, greatest = F.least(*ends), F.greatest(*ends)
    return pairs.select(
        least["a"].alias("a"), greatest["a"].alias("b"), least["low"].alias("low"), greatest["low"].alias("high")
    ).distinct()


def near_duplicates(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, min_percent: int = MIN_PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Documents are linked if 100 * shared shingles >= ``min_percent`` * shingles of either.
    """
    rows = sketch(documents, shingle_words)
    found = grouped(rows, documents, shingle_words, min_percent)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def grouped(rows: DataFrame, documents: DataFrame, shingle_words: int, min_percent: int) -> DataFrame:
    """The sketched rows with component_id and kept, and ``component``, which tells apart groups whose ids clash.

    What a later step does not read is deleted as soon as it has been used.
    """
    equal = ["node", "check", "n_shingles"]
    sketched = stored(rows, TEXT_BYTES)
    filled = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    banded = stored(filled.groupBy(*equal).agg(F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands")))
    rows = stored(sketched.drop("bands"))
    discard(sketched)
    heads = stored(banded.drop("bands"))
    spread = banded.select(F.explode("bands").alias("bucket"), "node")
    shared = spread.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    members = stored(spread.join(shared, "bucket"))
    discard(banded)
    reach = members.groupBy("node").agg(F.sum("held").alias("reach"))
    met = stored(heads.select("node", "n_shingles", "doc_id").join(reach, "node"))
    texts = stored(texts_of(documents, met.select("node", "doc_id"), shingle_words), TEXT_BYTES)

    def linked(pairs: DataFrame) -> DataFrame:
        """The components that the linked ones among the pairs join."""
        found = linked_ones(pairs, texts, shingle_words, min_percent)
        return stored(found.select(F.col("low").alias("a"), F.col("high").alias("b")), TEXT_BYTES)

    def joined(df: DataFrame, links: DataFrame) -> DataFrame:
        """The rows with the components that links between their components make."""
        merged = connected(links).select(F.col("node").alias("component"), F.col("component").alias("into"))
        found = df.join(merged, "component", "left")
        return found.withColumn("component", F.coalesce("into", "component")).drop("into")

    def split_buckets(labels: DataFrame) -> DataFrame:
        """The rows of the buckets that hold several components."""
        named = members.select("bucket", "node").join(labels, "node")
        split = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        named = named.join(split.where("low < high"), "bucket", "left_semi")
        return named.join(met.select("node", "n_shingles", "reach"), "node")

    def with_center(rows: DataFrame) -> DataFrame:
        """The rows that may be linked with the document of their bucket that shares most buckets."""
        center = F.max(F.struct("reach", "node", "n_shingles", "component")).alias("center")
        larger = F.greatest("n_shingles", "center.n_shingles")
        return rows.join(rows.groupBy("bucket").agg(center), "bucket").where(
            (F.col("component") != F.col("center.component"))
            & (100 * F.least("n_shingles", "center.n_shingles") >= min_percent * larger)
        )

    def tested(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The labels once the linked ones among the pairs (node, its component, center) have been joined."""
        columns = [F.col("node").alias("partner"), F.col("component").alias("low")]
        centers = [F.col("center.node").alias("hub"), F.col("center.component").alias("high")]
        return stored(joined(labels, linked(pairs.select(*columns, *centers))))

    # each document with the best center among those of its buckets; most groups are whole after that
    labels = met.select("node", F.col("node").alias("component"))
    ranked = members.select("bucket", "node").join(met.select("node", "reach", "n_shingles"), "node")
    ranked = ranked.withColumn("component", F.col("node"))
    best = with_center(ranked).groupBy("node", "component").agg(F.max("center").alias("center"))
    first = stored(best)
    labels = tested(first, labels)
    # then with every center of another component
    others = with_center(split_buckets(labels)).groupBy("node", "component", F.col("center.node").alias("hub"))
    second = stored(others.agg(F.max("center").alias("center")).drop("hub"))
    labels = tested(second, labels)
    done = first.unionAll(second).select("node", F.col("center.node").alias("center"))
    done = done.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()

    joinable = stored(split_buckets(labels).drop("reach"))
    discard(members)
    bounded = stored(
        with_common(joinable, texts, shingle_words).where(f"100 * common >= {min_percent} * n_shingles"), TEXT_BYTES
    )
    discard(joinable)
    wanted = texts.join(bounded.select("node").distinct(), "node", "left_semi")
    few = stored(sketches_of(wanted, shingle_words), TEXT_BYTES)
    left = pairs_left(bounded, few, min_percent).join(done, ["a", "b"], "left_anti")
    left = stored(left.select(F.col("a").alias("hub"), F.col("b").alias("partner"), "low", "high"))
    discard(bounded, few, first, second)
    labels = joined(labels, linked(left))

    named = heads.join(labels, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = stored(named.join(least, "component").select(*equal, "component", "component_id"))
    discard(texts, met, left)
    found = rows.join(of_class, equal, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    kept = F.coalesce(own == F.col("doc_id"), F.lit(True))
    return found.withColumn("kept", kept).withColumn("component_id", own)


def keep_one(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, min_percent: int = MIN_PERCENT
) -> DataFrame:
    """The documents that represent their group, with all their columns.

    Of each group one row is kept. Rows that share an id and are linked with nothing are groups of their own,
    but those without a word are one group by id. The kept row has the least id, then set, text and other
    columns; rows without an id are all kept.
    """
    columns = F.struct(*(F.col(f"`{c}`") for c in documents.columns))
    keyed = documents.select(columns.alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    keyed = keyed.withColumn("tid", F.xxhash64("text"))
    found = grouped(sketch(keyed, shingle_words, "tid"), documents, shingle_words, min_percent)
    found = found.where("kept AND doc_id IS NOT NULL")
    first = F.min(F.struct("node", "check", "n_shingles", "tid")).alias("first")
    kept = found.groupBy("doc_id", "component").agg(first).select("doc_id", "first.tid")
    # texts are equal here; maps and variants have no order
    ordered = [c for c, kind in documents.dtypes if c != "text" and "map<" not in kind and "variant" not in kind]
    least = F.min_by("row", F.struct(*(F.col("row").getField(c) for c in ordered))).alias("row")
    whole = keyed.drop("text").join(kept, ["doc_id", "tid"]).groupBy("doc_id", "tid").agg(least)
    return whole.select("row.*").unionAll(documents.where("doc_id IS NULL"))

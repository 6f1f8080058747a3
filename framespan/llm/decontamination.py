"""Benchmark decontamination by spaced seeds.

A mask such as 1101011 hashes the words under its ones and ignores the others, so a window still meets its copy when
words under zeros were exchanged.  Hashes of the benchmark's windows and of the documents' windows are joined; every
hit fixes a document region, an item and an offset, and the words around it are compared position by position.  A
document is contaminated when `share` of the words of a stretch of `stretch` words (or of the whole item, if shorter)
are the item's words.

Words are lower-cased A-Z and hashed in bulk from the UTF-8 bytes.  Items are written once, seeds are narrow rows that
name them.  A seed of more than HOT windows of the benchmark is joined with a second one: the hash of two more words at
fixed places around it.  In a stretch that holds the seed the places beside it make more pairs than words may differ, so
one pair at least is equal, and no overlap that holds the seed is lost (`second_places`).  Before the join a Bloom filter
drops windows that no benchmark window can equal; it has 32 places a seed within fixed bounds (FILTER_BITS), so a very
large benchmark makes it let more pass but not grow.  What is joined then are the hits alone, on both sides by hash, so
neither side has to fit in one place.  Hits of a document that follow on each other form regions of a bounded length, and of a
region each pair takes with it the words beside its item alone, so a document that holds the whole benchmark costs in
proportion to its length.

Defined cases: null and empty texts and items have no words and meet nothing; an item of fewer than 5 words is met by a
document that has its words and no others; equal items under several ids are all reported; rows with one doc_id and
different texts are judged each by itself; repeated documents get equal results; a very long text is worked on alone; an
empty benchmark or table gives clean or no rows; only doc_id, item_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan.llm._common import BROADCAST_ROWS, discard, read_documents, read_table, text_hash, without, written
from framespan.llm._vec import Words, buffers, chunks, mix, release, words

#: fixed seed masks: 1 is compared, 0 is ignored
MASKS = ("11111", "1101011", "110010011", "101100101", "10010110001")
STRETCH = 20
SHARE = 0.7
#: bits of a place in the Bloom filter in front of the join: least, most (2**28 places are 32 MB)
FILTER_BITS = (22, 28)
PROBES = 3
#: words from the first hit of a region to its last, at most
REGION = 1024
#: windows of the benchmark that a seed may have by itself
HOT = 64


def seed_hashes(hashes: np.ndarray, at: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of the mask, and the position of the window's first word."""
    span = len(mask)
    ok = np.ones(max(len(hashes) - span + 1, 0), bool)
    if not len(ok):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last_of = np.repeat(at[1:], np.diff(at))[: len(ok)]
    first = np.arange(len(ok))
    first = first[first + span <= last_of]
    value = np.full(len(first), np.uint64(len(mask) * 1000003 + int(mask, 2)))
    for k, bit in enumerate(mask):
        if bit == "1":
            value = value * np.uint64(0x9E3779B97F4A7C15) + hashes[first + k]
    return mix(value), first


def whole_hashes(w: Words, below: int) -> tuple[np.ndarray, np.ndarray]:
    """For texts of fewer words than any mask has ones: hash of all words, and the first one's place."""
    n = np.diff(w.at)
    short = np.flatnonzero((n > 0) & (n < below))
    value, first = np.full(len(short), np.uint64(77)), w.at[short]
    for k in range(below - 1):
        more = n[short] > k
        value[more] = mix(value[more] + w.hash[first[more] + k])
    return mix(value + n[short].astype(np.uint64)), first


def second_places(mask: str, stretch: int) -> list[tuple[int, int]]:
    """Pairs of places, from the window's first word on, of which one pair is equal in every stretch that is an overlap.

    All neighbours outside the window, left and right of it, and the zeros of the mask two by two: with an even number of
    zeros any stretch has (stretch - ones) // 2 of them without a common place."""
    zeros = [k for k, bit in enumerate(mask) if bit == "0"]
    left = [(k, k + 1) for k in range(len(mask) - stretch, -1)]
    right = [(k, k + 1) for k in range(len(mask), stretch - 1)]
    return left + right + list(zip(zeros[::2], zeros[1::2], strict=False))


def second_hashes(w: Words, seeds: np.ndarray, first: np.ndarray, mask: str, stretch: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the seeds with two more words each, where both are in the text, and the place in seeds of each."""
    doc = np.searchsorted(w.at, first, "right") - 1
    lo, hi = w.at[doc], w.at[doc + 1]
    values, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for k, (x, y) in enumerate(second_places(mask, stretch)):
        ok = np.flatnonzero((first + x >= lo) & (first + y < hi))
        values.append(mix(mix(seeds[ok] + np.uint64(k + 1)) + w.hash[first[ok] + x] * np.uint64(3) + w.hash[first[ok] + y]))
        of.append(ok)
    return np.concatenate(values), np.concatenate(of)


def two_seeds(masks: tuple[str, ...], stretch: int, share: float) -> bool:
    """Whether second seeds lose nothing: there are more pairs than words that may differ."""
    return all(m.count("0") % 2 == 0 and (stretch - m.count("1")) // 2 > stretch - int(np.ceil(share * stretch - 1e-9)) for m in masks)


def least_ones(masks: tuple[str, ...]) -> int:
    return min(m.count("1") for m in masks)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item_key (a number of its own), item_id and the word hashes of every item."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in it:
            raw, offsets = buffers(batch.column(1))
            for a, b in chunks(offsets):
                w = words(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                lists = pa.LargeListArray.from_arrays(pa.array(w.at, pa.int64()), pa.array(w.hash.view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["item_id", "item"])

    found = benchmark.select("item_id", "text").mapInArrow(batches, "item_id long, item array<long>")
    return found.where(F.size("item") > 0).withColumn("item_key", F.monotonically_increasing_id())


def item_seeds(items: DataFrame, masks: tuple[str, ...], stretch: int, hot: tuple[np.ndarray, int] | None = None) -> DataFrame:
    """seed, item_key and item_pos of every window of every mask; seeds in the filter `hot`, of items that have a whole
    stretch, with two more words each."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in it:
            keys, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            at = lists.offsets.to_numpy().astype(np.int64)
            w = Words(lists.values.to_numpy(zero_copy_only=False).view(np.uint64)[at[0] : at[-1]], None, None, at - at[0])
            size = np.diff(w.at)
            found = [whole_hashes(w, least_ones(masks))]
            for mask in masks:
                seeds, first = seed_hashes(w.hash, w.at, mask)
                if hot:
                    doubled = np.zeros(len(seeds), bool)
                    doubled[passes(*hot, seeds)] = True
                    doubled &= size[np.searchsorted(w.at, first, "right") - 1] >= stretch
                    more, of = second_hashes(w, seeds[doubled], first[doubled], mask, stretch)
                    found.append((more, first[doubled][of]))
                    seeds, first = seeds[~doubled], first[~doubled]
                found.append((seeds, first))
            for seeds, first in found:
                d = np.searchsorted(w.at, first, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64)), pa.array(keys[d], pa.int64()), pa.array((first - w.at[d]).astype(np.int32))], names=["seed", "item_key", "item_pos"])

    return items.select("item_key", "item").mapInArrow(batches, "seed long, item_key long, item_pos int")


def probe(seeds: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Places of the seeds in the filter at its k-th probe."""
    return (mix(seeds + np.uint64(k)) >> np.uint64(64 - bits)).astype(np.int64)


def passes(packed: np.ndarray, bits: int, seeds: np.ndarray) -> np.ndarray:
    """Positions of the seeds that the filter lets pass."""
    left = np.arange(len(seeds))
    for k in range(PROBES):
        place = probe(seeds[left], k, bits)
        left = left[(packed[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
    return left


def bloom(seeds: DataFrame) -> tuple[np.ndarray, int]:
    """Packed filter over the column seed, and its bits a place.

    What reaches the driver are 64-bit words of it that are not empty, two numbers each: 64 MB at the upper bound."""
    n = seeds.count()
    bits = min(max(int(np.ceil(np.log2(32 * n + 1))), FILTER_BITS[0]), FILTER_BITS[1])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in it:
            found = np.unique(np.concatenate([probe(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), k, bits) for k in range(PROBES)]))
            word, start = np.unique(found >> 6, return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (found & 63).astype(np.uint64), start) if len(found) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int32)), pa.array(value.view(np.int64))], names=["word", "value"])

    found = seeds.select("seed").mapInArrow(batches, "word int, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    full = np.zeros(1 << (bits - 6), np.uint64)
    full[found["word"].to_numpy()] = found["value"].to_numpy().view(np.uint64)
    return full.view(np.uint8), bits


def document_hits(docs: DataFrame, keys: tuple[np.ndarray, int], hot: tuple[np.ndarray, int] | None, masks: tuple[str, ...], reach: int) -> DataFrame:
    """Windows of the documents that the filter of keys lets pass; for seeds in the filter `hot` also those with two more words.

    Hits that lie within `reach` words of each other form a region, a new one every REGION words.  A region gives one row with the hashes of its
    words and `reach` more on both sides (seed null), and one row for each hit (words null)."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in it:
            raw, offsets = buffers(batch.column(2))
            ids, hashes = batch.column(0), batch.column(1)
            for a, b in chunks(offsets):
                w = words(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                s, first = whole_hashes(w, least_ones(masks))
                hit = passes(*keys, s)
                seeds, places = [s[hit]], [first[hit]]
                for mask in masks:
                    s, first = seed_hashes(w.hash, w.at, mask)
                    hit = passes(*keys, s)
                    seeds.append(s[hit])
                    places.append(first[hit])
                    if hot:
                        hit = passes(*hot, s)
                        more, of = second_hashes(w, s[hit], first[hit], mask, reach)
                        met = passes(*keys, more)
                        seeds.append(more[met])
                        places.append(first[hit][of[met]])
                seed, place = np.concatenate(seeds), np.concatenate(places)
                if not len(seed):
                    continue
                order = np.argsort(place, kind="stable")
                seed, place = seed[order], place[order]
                doc = np.searchsorted(w.at, place, "right") - 1
                piece = (place - w.at[doc]) // REGION
                new = np.r_[True, (doc[1:] != doc[:-1]) | (np.diff(place) > reach) | (piece[1:] != piece[:-1])]
                region = np.cumsum(new) - 1
                starts = np.flatnonzero(new)
                ends = np.r_[starts[1:], len(seed)]
                lo = np.maximum(place[starts] - reach, w.at[doc[starts]])
                hi = np.minimum(place[ends - 1] + 2 * reach, w.at[doc[starts] + 1])
                tokens = [w.hash[x:y].view(np.int64) for x, y in zip(lo, hi, strict=True)]
                of = pa.array(a + doc[starts])
                base = pa.array(lo - w.at[doc[starts]], pa.int64())
                n = len(starts)
                yield pa.RecordBatch.from_arrays([ids.take(of), hashes.take(of), base, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))], names=names)
                m = len(seed)
                of = pa.array(a + doc)
                yield pa.RecordBatch.from_arrays([ids.take(of), hashes.take(of), base.take(pa.array(region)), pa.array(seed.view(np.int64)), pa.array(place - lo[region], pa.int64()), pa.nulls(m, pa.list_(pa.int64()))], names=names)

    names = ["doc_id", "th", "region", "seed", "pos", "words"]
    return docs.select("doc_id", text_hash().alias("th"), "text").mapInArrow(batches, "doc_id long, th long, region long, seed long, pos long, words array<long>")


def overlaps(pairs: DataFrame, regions: DataFrame, items: DataFrame, stretch: int, share: float) -> DataFrame:
    """Compares region and item of pairs at their offset; keeps pairs whose best stretch has the share of equal words.

    Regions hold at least `stretch` words around each hit, so every stretch that holds the hit is seen.  Only the part of
    a region that lies beside the item, and of the item that lies in the region, is moved."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in it:
            kept, equal = [], []
            for k, (n, mine, theirs) in enumerate(zip(batch.column(5).to_pylist(), batch.column(6), batch.column(7), strict=True)):
                same = mine.values.to_numpy() == theirs.values.to_numpy()
                sums = np.concatenate([[0], np.cumsum(same)])
                n_here = min(n, len(same))
                best = int((sums[n_here:] - sums[: len(sums) - n_here]).max())
                if best >= share * n:
                    kept.append(k)
                    equal.append(best)
            part = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(equal, pa.int64()), part.column(5)], names=["doc_id", "th", "item_id", "region", "offset", "equal", "compared"])

    skip_mine, skip_theirs = F.greatest(F.lit(0), F.col("offset")), F.greatest(F.lit(0), -F.col("offset"))
    common = F.least(F.size("words") - skip_mine, F.col("item_size") - skip_theirs)
    mine = pairs.join(items.select("item_key", "item_size"), "item_key").join(regions, ["doc_id", "th", "region"]).where(common > 0)
    mine = mine.select("doc_id", "th", "region", "item_key", "offset", "item_size", F.slice("words", (skip_mine + 1).cast("int"), common.cast("int")).alias("mine"))
    theirs = F.slice("item", (skip_theirs + 1).cast("int"), F.size("mine"))
    cut_ = mine.join(items.select("item_key", "item_id", "item"), "item_key").select("doc_id", "th", "item_id", "region", "offset", F.least(F.lit(stretch), F.col("item_size")).cast("long").alias("n"), "mine", theirs.alias("theirs"))
    return cut_.mapInArrow(batches, "doc_id long, th long, item_id long, region long, offset long, equal long, compared long")


def contaminated_passages(docs: DataFrame, benchmark: DataFrame, *, masks: tuple[str, ...] = MASKS, stretch: int = STRETCH, share: float = SHARE) -> DataFrame:
    """doc_id, th (hash of the text), item_id, first word in the document (offset + region), equal and compared words of
    each verified overlap."""
    items = written(benchmark_items(benchmark).withColumn("item_size", F.size("item")))
    often = written(item_seeds(items, masks, stretch).groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("seed"))
    hot = bloom(often) if two_seeds(masks, stretch, share) and often.limit(1).count() else None
    seeds = written(item_seeds(items, masks, stretch, hot))
    hits = written(document_hits(docs, bloom(seeds), hot, masks, stretch))
    few = seeds.count() <= BROADCAST_ROWS
    pairs = hits.where("seed IS NOT NULL").select("doc_id", "th", "region", "seed", "pos").join(F.broadcast(seeds) if few else seeds, "seed")
    pairs = pairs.select("doc_id", "th", "region", "item_key", (F.col("pos") - F.col("item_pos")).alias("offset")).distinct()
    regions = hits.where("seed IS NULL").select("doc_id", "th", "region", "words").distinct()
    found = written(overlaps(pairs, regions, items, stretch, share))
    discard(items, often, seeds, hits)
    return found


def flag_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: contaminated, the number of items met, their ids in order, and the best share of equal words."""
    found = contaminated_passages(docs, benchmark, **options).groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max(F.col("equal") / F.col("compared")).alias("best_share"))
    return docs.select("doc_id", text_hash().alias("th")).join(found, ["doc_id", "th"], "left").select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce(F.array_join("items", ","), F.lit("")).alias("item_ids"), F.coalesce("best_share", F.lit(0.0)).alias("best_share"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs, with all columns, that hold no passage of the benchmark."""
    return without(docs, contaminated_passages(docs, benchmark, **options))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_documents(read_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))

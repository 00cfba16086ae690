"""Benchmark decontamination by greedy string tiling.

Texts are compared by their lower-cased words. A document becomes a candidate for an
item if they share enough seeds, windows of `least` words (a shorter item is one seed): the
documents' windows pass a bitmap of all seeds, of a size that does not depend on the input,
and what passes is joined with the seeds themselves. Each candidate pair is then tiled: running
Karp-Rabin finds the longest common runs of unmarked words, they are marked without overlap,
and the search length is lowered until `least`. The pair is a leak if the tiles cover at least
`coverage` of the item's words, in whatever order they stand in the document.

Null, empty and wordless texts match nothing on either side. Repeated rows give a row each;
a null id is carried as null. Other columns are not read. An empty table on either side
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotcraft.llm import bitmap
from lotcraft.llm import words as W
from lotcraft.sources.staging import cut_lineage

LEAST = 5
COVERAGE = 0.8
FIRST_LENGTH = 20
BITMAP_BYTES = 16 << 20
_STEP = np.uint64(0x9FB21C651E98DF25)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word."""
    start, end, text = W.word_spans(data, offsets)
    return W.Spans(data).of(start, end), text


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return W.text_arrays(pc.utf8_lower(column.cast(pa.large_string())))


def _windows(tokens: np.ndarray, size: int) -> np.ndarray:
    count = max(tokens.size - size + 1, 0)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out = out * _STEP + tokens[k : k + count]
    return W.mixed(out + np.uint64(size))


def _runs(tokens: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the windows of `size` words without a marked one."""
    marked = W.running(~free)
    start = np.flatnonzero(marked[size:] == marked[:-size]) if tokens.size >= size else np.zeros(0, np.int64)
    sums = np.zeros(tokens.size + 1, np.uint64)
    powers = np.cumprod(np.concatenate([[1], np.full(tokens.size, _STEP)]).astype(np.uint64))
    np.cumsum(tokens * powers[:-1], out=sums[1:])
    # The same run at two places differs by a power: bring both to the last place.
    return (sums[start + size] - sums[start]) * powers[tokens.size - start], start


def greedy_tiles(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(place in item, place in text, words) of the tiles."""
    free_i, free_t = np.ones(item.size, bool), np.ones(text.size, bool)
    own, other = item.tolist(), text.tolist()
    # Powers are aligned by giving both sides the same length.
    padded = max(item.size, text.size)
    wide_i = np.concatenate([item, np.zeros(padded - item.size, np.uint64)])
    wide_t = np.concatenate([text, np.zeros(padded - text.size, np.uint64)])
    out: list[tuple[int, int, int]] = []
    size = max(least, min(FIRST_LENGTH, item.size, text.size))
    while size <= min(item.size, text.size):
        pad = np.zeros(padded, bool)
        pad[: item.size] = free_i
        hash_i, at_i = _runs(wide_i, pad, size)
        pad = np.zeros(padded, bool)
        pad[: text.size] = free_t
        hash_t, at_t = _runs(wide_t, pad, size)
        places: dict[int, list[int]] = {}
        for h, i in zip(hash_i.tolist(), at_i.tolist(), strict=True):
            places.setdefault(h, []).append(i)
        hits = np.flatnonzero(np.isin(hash_t, hash_i))
        found: list[tuple[int, int, int]] = []
        for h, j in zip(hash_t[hits].tolist(), at_t[hits].tolist(), strict=True):
            for i in places[h]:
                if i and j and free_i[i - 1] and free_t[j - 1] and own[i - 1] == other[j - 1]:
                    continue  # part of a run that starts earlier
                n = 0
                while (i + n < item.size and j + n < text.size and own[i + n] == other[j + n]
                       and free_i[i + n] and free_t[j + n]):
                    n += 1
                if n >= size:
                    found.append((-n, i, j))
        longest = -min(found)[0] if found else 0
        if longest > 2 * size:
            size = longest
            continue
        placed = False
        for n, i, j in sorted(found):
            if free_i[i : i - n].all() and free_t[j : j - n].all():
                free_i[i : i - n] = free_t[j : j - n] = False
                out.append((i, j, -n))
                placed = True
        if not placed:
            if size == least:
                break
            size = max(least, size // 2)
    return out


def _seeds(items: DataFrame, least: int) -> DataFrame:
    """(item, item_id, text, n_words, needed, size, seeds) of every item with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _lowered(batch.column(2))
            tokens, text = _tokens(data, offsets)
            cuts = np.searchsorted(text, np.arange(len(batch) + 1))
            sizes, seeds, counts = [], [], []
            for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
                size = min(b - a, least)
                own = np.unique(_windows(tokens[a:b], size)) if size else np.zeros(0, np.uint64)
                sizes.append(size), counts.append(b - a), seeds.append(own.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(counts, pa.int64()),
                 pa.array(sizes, pa.int32()), pa.array(seeds, pa.list_(pa.int64()))],
                ["item", "item_id", "text", "n_words", "size", "seeds"])

    return items.mapInArrow(
        run, "item long, item_id long, text string, n_words long, size int, seeds array<long>").where("size > 0")


def leaks(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, coverage, n_tiles, longest_tile) of the leaks."""
    return _leaks(docs, items, **settings).drop("code")


def _leaks(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", least: int = LEAST,
           coverage: float = COVERAGE, bitmap_bytes: int = BITMAP_BYTES) -> DataFrame:
    """The leaks, with a hash of the document's text."""
    spark = docs.sparkSession
    known = cut_lineage(_seeds(items.select(
        F.monotonically_increasing_id().alias("item"), F.col(item_id).cast("long").alias("item_id"),
        F.col(item_text).cast("string").alias("text")), least), "items")
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())  # at most `least`
    seeds = known.select("item", "n_words", F.size("seeds").alias("n_seeds"), F.explode("seeds").alias("seed"))
    shared = spark.sparkContext.broadcast(bitmap.build(seeds.select("seed"), bitmap_bytes))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            data, offsets = _lowered(batch.column(2))
            for a, b in W.chunks(data, offsets):
                tokens, row = _tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                rows, hits = [], []
                for size in sizes:
                    window = _windows(tokens, size)
                    hit = np.flatnonzero(bitmap.contains(bits, window))
                    hit = hit[row[hit] == row[hit + size - 1]]
                    rows.append(row[hit]), hits.append(window[hit])
                if not sizes or not any(r.size for r in rows):
                    continue
                every, seed = np.concatenate(rows), np.concatenate(hits)
                order = np.lexsort((seed, every))
                every, seed = every[order], seed[order]
                new = np.concatenate([[True], (every[1:] != every[:-1]) | (seed[1:] != seed[:-1])])
                every, seed = every[new], seed[new]
                used, first = np.unique(every, return_index=True)
                part = batch.slice(a, b - a).take(pa.array(used))
                lists = pa.ListArray.from_arrays(pa.array([*first.tolist(), every.size], pa.int32()),
                                                 pa.array(seed.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], ["row", "doc_id", "text", "code", "seeds"])

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
                         F.col(text).cast("string").alias("text"), F.xxhash64(F.col(text).cast("string")).alias("code"))
    passed = cut_lineage(source.mapInArrow(
        passing, "row long, doc_id long, text string, code long, seeds array<long>"), "passed")
    # Tiles of `least` words hold at least one seed for every `least` covered words; items
    # that repeat a seed have fewer different ones and need one only.
    needed = F.when(F.col("n_seeds") == F.col("n_words") - (least - 1),
                    F.ceil(coverage * F.col("n_words") / least - 1e-9)).otherwise(F.lit(1))
    pairs = passed.select("row", F.explode("seeds").alias("seed")).join(
        seeds.select("item", "seed", needed.alias("needed")), "seed").groupBy("row", "item").agg(
        F.count("*").alias("common"), F.first("needed").alias("needed")).where("common >= needed")
    both = pairs.select("row", "item").join(passed.select("row", "doc_id", "text", "code"), "row").join(
        known.select("item", "item_id", F.col("text").alias("item_text")), "item").select(
        "doc_id", "item_id", "text", "item_text", "code")

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_words = _per_row(batch.column(2))
            item_words = _per_row(batch.column(3))
            rows = []
            for words, item in zip(doc_words, item_words, strict=True):
                tiles = greedy_tiles(item, words, min(least, item.size))
                covered = sum(t[2] for t in tiles)
                rows.append((item.size, covered, covered / item.size, len(tiles), max((t[2] for t in tiles), default=0)))
            if rows:
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *columns, batch.column(4)],
                    ["doc_id", "item_id", "item_words", "covered_words", "coverage", "n_tiles", "longest_tile", "code"])

    return both.mapInArrow(
        tiled, "doc_id long, item_id long, item_words long, covered_words long, coverage double, n_tiles long, "
               "longest_tile long, code long").where(F.col("coverage") >= coverage)


def _per_row(column: pa.Array) -> list[np.ndarray]:
    data, offsets = _lowered(column)
    out: list[np.ndarray] = []
    for a, b in W.chunks(data, offsets):
        tokens, row = _tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        out += np.split(tokens, np.searchsorted(row, np.arange(1, b - a)))
    return out


def without_leaks(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows without a leak; a row is told by its id, null or not, and a 64-bit hash of its text."""
    leaky = cut_lineage(_leaks(docs, items, doc_id=doc_id, text=text, **settings).select(
        F.col("doc_id").alias("__leaky"), F.col("code").alias("__code")).distinct(), "leaky")
    same = F.col(doc_id).cast("long").eqNullSafe(F.col("__leaky")) & (
        F.xxhash64(F.col(text).cast("string")) == F.col("__code"))
    return docs.join(leaky, same, "left_anti")

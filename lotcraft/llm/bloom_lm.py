"""Bigram language model in a log-frequency Bloom filter.

Counts of single tokens and pairs are quantised to levels 1 + floor(log2 c). The filter holds
an n-gram once for each level up to its own; a reader probes level 1, 2, ... until one is
missing and takes the middle of the last level found. The filter is cut into `SEGMENTS`: all
probes of an n-gram fall into the segment of its hash, so each segment is built by one task
from its own n-grams. A segment counts its entries (n-grams times levels) before it is laid
out and takes `BITS_PER_ENTRY` bits for each, so the filter grows with what the corpus holds
and a missing level reads as present with a probability of about 1 % at any size.

The filter stays in the shared folder. One of at most `held_bytes` is read whole by each task
that scores, without a way through the driver. Of a larger one no task reads more than a block: the
distinct n-grams of every chunk of text are dealt to blocks of segments, each block answers
from its own segments, and the levels go back to the chunk. Both ways score alike.

A token's probability follows the token before it, or the start of the text:
(c(uv) + strength * p(v)) / (c(u) + strength), p(v) = (c(v) + 0.5) / (N + 0.5 (V + 1)), with
all c from the filter, c(uv) at most c(u), and N and V exact.

Tokens are the words of the text with A-Z lowered, and one end. The exact unigram score beside
the model's takes the counts of the `HEAD_TOKENS` most frequent short tokens from a broadcast
table, and those of all others from a join.

Null and empty texts consist of the end token. Rows are scored one by one, repeated rows and
ids alike; a null id is a training document. Without any training document all counts are 0.
Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotcraft.llm import words as W
from lotcraft.llm.files import store_of
from lotcraft.sources.staging import cut_lineage, new_folder

SEGMENTS = 1 << 14
# Blocks of neighbouring segments that answer together.
BLOCKS = 1 << 10
# (1 - exp(-PROBES / BITS_PER_ENTRY)) ** PROBES: a missing level reads as present in 1.1 % of cases.
BITS_PER_ENTRY = 12
PROBES = 3
HELD_BYTES = 128 << 20
MAX_LEVEL = 48
STRENGTH = 20.0
HEAD_TOKENS = 1 << 17
HEAD_TOKEN_BYTES = 64
END = b"\n"  # no word holds a line feed
_FLUSH_ITEMS = 1 << 21
_FLUSH_TOKENS = 400_000
_EMIT_BYTES = 1 << 20
_LOOKED_UP = 1 << 17  # n-grams that a block looks up at once

_START_HASH = np.uint64(0x5851F42D4C957F2D)
_END_HASH = np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0x9E6C63D0876A9A47)
_LEVEL = 0xD6E8FEB86659FD93
_PROBE = 0xA0761D6478BD642F


def held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 1) -> Column:
    code = F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary"))
    return F.coalesce(code % folds == fold, F.lit(False))


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def _token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, hash of the token before, text) of all tokens in order, the ends included."""
    data = W.lowered(data)
    start, end, text = W.word_spans(data, offsets)
    count = offsets.size - 1
    n_words = np.bincount(text, minlength=count)
    place = np.arange(start.size) + text  # one end for each text before
    ends = np.cumsum(n_words + 1) - 1
    hashes = np.empty(start.size + count, np.uint64)
    hashes[place] = W.Spans(data).of(start, end)
    hashes[ends] = _END_HASH
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[ends - n_words] = _START_HASH
    return hashes, before, np.repeat(np.arange(count), n_words + 1)


def _pair(before: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return W.mixed(before * _PAIR + hashes)


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(token, n) over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["token", "n"])
            counts.clear()
            return out

        for batch in batches:
            data, offsets = W.text_arrays(batch.column(1))
            for a, b in W.chunks(data, offsets):
                whole = data[offsets[a] : offsets[b]].tobytes().lower()
                cut = (offsets[a : b + 1] - offsets[a]).tolist()
                for p, q in zip(cut, cut[1:], strict=False):
                    counts.update(whole[p:q].split())
                counts[END] += b - a
                if len(counts) >= _FLUSH_TOKENS:
                    yield flush()
        if counts:
            yield flush()

    rows = _source(docs, doc_id, text).mapInArrow(run, "token binary, n long")
    return rows.groupBy("token").agg(F.sum("n").alias("n"))


def _merged(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[first], np.add.reduceat(counts, first)


def _segment(hashes: np.ndarray, parts: int = SEGMENTS) -> np.ndarray:
    """The segment, or one of fewer `parts` alike, that each hash falls into."""
    return (hashes >> np.uint64(64 - parts.bit_length() + 1)).astype(np.int64)


def _positions(hashes: np.ndarray, level: int, probe: int, bits: int | np.ndarray) -> np.ndarray:
    """Places among `bits`, which are fewer than 2^32 a segment."""
    salt = (level * _LEVEL + (probe + 1) * _PROBE) % (1 << 64)
    code = W.mixed(hashes + np.uint64(salt))
    return ((code >> np.uint64(32)) * np.asarray(bits, np.uint64) >> np.uint64(32)).astype(np.int64)


def build_filter(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 filter_bytes: int | None = None) -> DataFrame:
    """(segment, bits): the parts of the filter that hold something.

    Each part has the size its entries need, or, with `filter_bytes`, an equal share of that.
    """
    if filter_bytes is not None and (filter_bytes < 8 * SEGMENTS or filter_bytes % (8 * SEGMENTS)):
        raise ValueError("filter_bytes must be a multiple of 128 KB")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(waiting), return_counts=True)
            at = np.searchsorted(_segment(hashes), np.arange(SEGMENTS + 1))
            used = np.flatnonzero(at[1:] > at[:-1])
            cut = list(zip(at[used].tolist(), at[used + 1].tolist(), strict=True))
            once = counts == 1
            ones = [hashes[a:b][once[a:b]].tobytes() for a, b in cut]
            more = [hashes[a:b][~once[a:b]].tobytes() for a, b in cut]
            times = [counts[a:b][~once[a:b]].astype(np.uint32).tobytes() for a, b in cut]
            return pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(ones, pa.binary()), pa.array(more, pa.binary()),
                 pa.array(times, pa.binary())],
                ["segment", "ones", "more", "times"])

        for batch in batches:
            data, offsets = W.text_arrays(batch.column(1))
            for a, b in W.chunks(data, offsets):
                hashes, before, _ = _token_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                starts = np.full(b - a, _START_HASH)
                waiting += [hashes, starts, _pair(before, hashes)]
                held += 2 * hashes.size + starts.size
                if held >= _FLUSH_ITEMS:
                    yield flush()
                    waiting, held = [], 0
        if held:
            yield flush()

    def laid_out(parts: list[tuple[bytes, bytes, bytes]]) -> bytes:
        ones = np.frombuffer(b"".join(p[0] for p in parts), np.uint64)
        more = np.frombuffer(b"".join(p[1] for p in parts), np.uint64)
        times = np.frombuffer(b"".join(p[2] for p in parts), np.uint32).astype(np.int64)
        hashes, counts = _merged(np.concatenate([ones, more]),
                                 np.concatenate([np.ones(ones.size, np.int64), times]))
        levels = np.minimum(1 + np.floor(np.log2(counts)).astype(np.int64), MAX_LEVEL)
        bits = filter_bytes * 8 // SEGMENTS if filter_bytes else -(-int(levels.sum()) * BITS_PER_ENTRY // 64) * 64
        segment = np.zeros(bits, bool)
        for level in range(1, int(levels.max()) + 1):
            own = hashes[levels >= level]
            for probe in range(PROBES):
                segment[_positions(own, level, probe, bits)] = True
        return np.packbits(segment, bitorder="little").tobytes()

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        parts: list[tuple[bytes, bytes, bytes]] = []
        done: list[tuple[int, bytes]] = []
        held = 0

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done], pa.binary())],
                ["segment", "bits"])
            done.clear()
            return out

        for batch in batches:
            for row in batch.to_pylist():
                if now is not None and row["segment"] != now:
                    done.append((now, laid_out(parts)))
                    held += len(done[-1][1])
                    parts.clear()
                    if held >= _EMIT_BYTES:
                        yield emit()
                        held = 0
                now = row["segment"]
                parts.append((row["ones"], row["more"], row["times"]))
        if parts:
            done.append((now, laid_out(parts)))
            yield emit()

    counted = _source(docs, doc_id, text).mapInArrow(count, "segment int, ones binary, more binary, times binary")
    return counted.repartition("segment").sortWithinPartitions("segment").mapInArrow(
        insert, "segment int, bits binary")


def _middle(levels: np.ndarray) -> np.ndarray:
    """Middle of each level, 0 for level 0."""
    return np.where(levels > 0, (3.0 * np.exp2(np.maximum(levels, 1) - 1.0) - 1) / 2, 0.0)


@dataclass
class BloomCounts:
    """Counts of n-grams as the filter remembers them."""

    bits: np.ndarray  # of all segments in order, packed
    segment_bits: int | np.ndarray  # of every segment, or of each; 0 holds nothing

    @classmethod
    def of_parts(cls, parts: Iterable[tuple[int, bytes]]) -> BloomCounts:
        """From (segment, bits); a segment that is not there holds nothing."""
        parts, sizes = sorted(parts), np.zeros(SEGMENTS, np.int64)
        for segment, bits in parts:
            sizes[segment] = 8 * len(bits)
        return cls(np.frombuffer(b"".join(bits for _, bits in parts), np.uint8), sizes)

    @classmethod
    def read(cls, folder: str) -> BloomCounts:
        """From the files that `build_filter` was written to."""
        store, path = store_of(folder)
        names = [f.path for f in store.get_file_info(pafs.FileSelector(path)) if f.path.endswith(".parquet")]
        tables = [pq.read_table(name, filesystem=store, columns=["segment", "bits"]) for name in names]
        sizes = np.zeros(SEGMENTS, np.int64)
        for table in tables:
            sizes[table["segment"].to_numpy()] = 8 * pc.binary_length(table["bits"]).to_numpy().astype(np.int64)
        starts = (np.cumsum(sizes) - sizes) >> 3
        bits = np.zeros(int(sizes.sum()) >> 3, np.uint8)
        while tables:
            for batch in tables.pop().to_batches():
                for segment, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    own = np.frombuffer(part.as_buffer(), np.uint8)
                    bits[starts[segment] : starts[segment] + own.size] = own
        return cls(bits, sizes)

    @property
    def fill(self) -> float:
        return float(np.bitwise_count(self.bits).sum()) / max(8 * self.bits.size, 1)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Level of each n-gram, 0 if it is absent."""
        sizes = np.broadcast_to(np.asarray(self.segment_bits, np.int64), SEGMENTS)
        starts = np.cumsum(sizes) - sizes
        levels = np.zeros(hashes.size, np.int64)
        segment = _segment(hashes)
        alive = np.flatnonzero(sizes[segment] > 0)
        own, segment = hashes[alive], segment[alive]
        base, bits = starts[segment], sizes[segment]
        for level in range(1, MAX_LEVEL + 1):
            for probe in range(PROBES):
                at = base + _positions(own, level, probe, bits)
                found = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                alive, own, base, bits = alive[found], own[found], base[found], bits[found]
            if not alive.size:
                break
            levels[alive] = level
        return levels

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Middle of the level of each n-gram, 0 if it is absent."""
        return _middle(self.levels(hashes))


def _asked(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The distinct n-grams that scoring these tokens asks for, in order."""
    return np.unique(np.concatenate([hashes, [_START_HASH], _pair(before, hashes)]))


def _levels_of(model: BloomCounts, asking: list[bytes]) -> Iterator[bytes]:
    """The levels of each list of n-grams, as bytes; many short lists are looked up together."""
    first, held = 0, 0
    for last, payload in enumerate(asking, 1):
        held += len(payload) >> 3
        if held >= _LOOKED_UP or last == len(asking):
            levels = model.levels(np.frombuffer(b"".join(asking[first:last]), np.uint64)).astype(np.int8).tobytes()
            at = 0
            for own in asking[first:last]:
                yield levels[at : at + (len(own) >> 3)]
                at += len(own) >> 3
            first, held = last, 0


def _answered(source: DataFrame, built: DataFrame) -> DataFrame:
    """(chunk, kind, block, levels, row, doc_id, text): the rows of `source`, kind 1, and for each
    chunk of them, kind 0, the levels of its distinct n-grams block by block."""
    columns = ["chunk", "kind", "block", "payload", "row", "doc_id", "text"]
    schema = "chunk long, kind int, block int, payload binary, row long, doc_id long, text string"

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32

        def rows(n: int, *arrays: pa.Array | None) -> pa.RecordBatch:
            types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, t) if x is None else x.cast(t) for x, t in zip(arrays, types, strict=True)], columns)

        for batch in batches:
            data, offsets = W.text_arrays(batch.column(2))
            for a, b in W.chunks(data, offsets):
                hashes, before, _ = _token_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                asked = _asked(hashes, before)
                at = np.searchsorted(_segment(asked, BLOCKS), np.arange(BLOCKS + 1))
                used = np.flatnonzero(at[1:] > at[:-1])
                asking = [asked[p:q].tobytes() for p, q in zip(at[used].tolist(), at[used + 1].tolist(), strict=True)]
                yield rows(used.size, pa.array(np.full(used.size, chunk)), pa.array(np.zeros(used.size, np.int32)),
                           pa.array(used), pa.array(asking, pa.binary()), None, None, None)
                yield rows(b - a, pa.array(np.full(b - a, chunk)), pa.array(np.ones(b - a, np.int32)), None, None,
                           *(batch.column(i).slice(a, b - a) for i in range(3)))
                chunk += 1

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, model = None, [], None
        for batch in batches:
            block, kinds = (batch.column(i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero(np.diff(block, prepend=block[:1] - 1) | np.diff(kinds, prepend=kinds[:1] - 1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], block.size], strict=False):
                if block[a] != now:
                    now, parts, model = block[a], [], None
                payload = batch.column(4).slice(a, b - a).to_pylist()
                if kinds[a] == 0:
                    parts += zip(batch.column(3).slice(a, b - a).to_pylist(), payload, strict=True)
                    continue
                model = model or BloomCounts.of_parts(parts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(a, b - a), batch.column(0).slice(a, b - a),
                     pa.array(_levels_of(model, payload), pa.binary())], ["chunk", "block", "payload"])

    gathered = cut_lineage(source.mapInArrow(gather, schema), "chunks")
    asking = gathered.where("kind = 0").selectExpr("block", "1 AS kind", "chunk", "cast(null AS int) AS segment", "payload")
    held = built.selectExpr(f"cast(segment div {SEGMENTS // BLOCKS} AS int) AS block", "0 AS kind",
                            "cast(null AS long) AS chunk", "segment", "bits AS payload")
    answers = asking.unionByName(held).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(
        answer, "chunk long, block int, payload binary")
    return gathered.where("kind = 1").unionByName(
        answers.withColumn("kind", F.lit(0)), allowMissingColumns=True).select(*columns)


def score(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", strength: float = STRENGTH,
          filter_bytes: int | None = None, held_bytes: int = HELD_BYTES, head_tokens: int = HEAD_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row.

    `filter_bytes` fixes the filter's size, which otherwise follows its entries.
    """
    spark = docs.sparkSession
    training = docs.where(~held_out(doc_id))
    counts = cut_lineage(token_counts(training, doc_id, text), "token-counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_all, size = totals["n"], n_all_tokens(totals["n"], totals["v"])

    short = F.octet_length("token") <= HEAD_TOKEN_BYTES
    head = spark.sparkContext.broadcast({
        bytes(r["token"]): r["n"]
        for r in counts.where(short).orderBy(F.desc("n"), "token").limit(head_tokens).collect()})
    folder = new_folder(spark, "filter")
    fresh = build_filter(training, doc_id, text, filter_bytes)
    fresh.write.parquet(folder)
    built = spark.read.schema(fresh.schema).parquet(folder)
    built_bytes = built.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]

    def judged(rows: pa.Array, ids: pa.Array, own: np.ndarray, places: np.ndarray,
               tokens: tuple[np.ndarray, np.ndarray, np.ndarray],
               of: Callable[[np.ndarray], np.ndarray]) -> pa.RecordBatch:
        known, count = head.value, len(rows)
        end_count = known.get(END, 0)
        hashes, before, row = tokens
        single = of(hashes)
        prior = np.empty_like(single)
        prior[1:] = single[:-1]
        prior[before == _START_HASH] = of(np.array([_START_HASH]))[0]
        together = np.minimum(of(_pair(before, hashes)), prior)
        alone = (single + 0.5) / size
        logs = np.log10((together + strength * alone) / (prior + strength))
        scores = np.bincount(row, weights=logs, minlength=count)
        whole = own.tobytes().lower()
        cut = places.tolist()
        base, found, rest, rest_n = [], [], [], []
        for p, q in zip(cut, cut[1:], strict=False):
            words = whole[p:q].split()
            hit = [c for c in map(known.get, words) if c is not None]
            base.append(float(np.log10(np.array([*hit, end_count]) + 0.5).sum()))
            found.append(len(hit) + (end_count > 0))
            tail = Counter(w for w in words if w not in known) if len(hit) < len(words) else {}
            rest.append(list(tail.keys()))
            rest_n.append(list(tail.values()))
        return pa.RecordBatch.from_arrays(
            [rows, ids, pa.array(np.bincount(row, minlength=count)), pa.array(found, pa.int64()), pa.array(base),
             pa.array(scores), pa.array(rest, pa.list_(pa.binary())), pa.array(rest_n, pa.list_(pa.int64()))],
            ["row", "doc_id", "n_tokens", "n_head", "head_log", "score", "tail", "tail_n"])

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
                         F.col(text).cast("string").alias("text"))
    schema = ("row long, doc_id long, n_tokens long, n_head long, head_log double, score double, "
              "tail array<binary>, tail_n array<long>")
    if built_bytes <= held_bytes:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = None
            for batch in batches:
                model = model or BloomCounts.read(folder)
                data, offsets = W.text_arrays(batch.column(2))
                for a, b in W.chunks(data, offsets):
                    own, places = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                    yield judged(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), own, places,
                                 _token_hashes(own, places), model.of)

        scored = source.mapInArrow(run, schema)
    else:

        def run_answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now: int | None = None
            answers: list[bytes] = []
            texts: list[pa.RecordBatch] = []

            def finish() -> pa.RecordBatch:
                rows = pa.Table.from_batches(texts).combine_chunks()
                own, places = W.text_arrays(pa.concat_arrays(rows.column("text").chunks))
                tokens = _token_hashes(own, places)
                asked = _asked(tokens[0], tokens[1])
                middles = _middle(np.frombuffer(b"".join(answers), np.int8).astype(np.int64))
                rows, ids = (pa.concat_arrays(rows.column(c).chunks) for c in ("row", "doc_id"))
                return judged(rows, ids, own, places, tokens, lambda h: middles[np.searchsorted(asked, h)])

            for batch in batches:
                chunks = batch.column(0).to_numpy()
                kinds = batch.column(1).to_numpy()
                cuts = np.flatnonzero(np.diff(chunks, prepend=chunks[:1] - 1) | np.diff(kinds, prepend=kinds[:1] - 1))
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), chunks.size], strict=False):
                    if now is not None and chunks[a] != now:
                        yield finish()
                        answers, texts = [], []
                    now = chunks[a]
                    part = batch.slice(a, b - a)
                    if kinds[a] == 0:
                        answers += part.column(3).to_pylist()
                    else:
                        texts.append(part)
            if now is not None:
                yield finish()

        scored = _answered(source, built).repartition("chunk").sortWithinPartitions("chunk", "kind", "block").mapInArrow(
            run_answered, schema)
    scored = cut_lineage(scored, "scores")
    tail = scored.select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("t")).select(
        "row", F.col("t.tail").alias("token"), F.col("t.tail_n").alias("times"))
    looked_up = tail.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("tail_log"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_tail"))
    base = (F.col("head_log") + F.coalesce("tail_log", F.lit(0.0))) - F.col("n_tokens") * F.lit(math.log10(size))
    return scored.drop("tail", "tail_n").join(looked_up, "row", "left").select(
        "doc_id", held_out().alias("held_out"), "n_tokens",
        (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def n_all_tokens(n: int, v: int) -> float:
    """Denominator of the smoothed unigram probability."""
    return n + 0.5 * (v + 1)

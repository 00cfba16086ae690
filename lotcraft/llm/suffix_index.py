"""Exact removal of repeated strings with a logarithmic family of suffix indexes.

A byte goes if a string of `match` bytes that covers it also starts earlier: in a document
with a smaller id, or earlier in the same one. Strings are judged on the input.

Suffixes are sampled where they matter: every window of `match` bytes names the suffix at its
smallest `gram`-byte hash (the leftmost among equals), so equal windows name suffixes that
start alike at the same place of the window. The windows of a text thus fall into runs that
share a suffix; a run with its bytes is a *segment*.

1. The corpus arrives in `batches` by id. A batch's sampled suffixes, ordered by the hash of
   their first `gram` bytes, are its suffix array; it is merge-scanned against the arrays of
   the levels so far. Suffixes met twice are noted, and levels of equal size are merged, so
   that a suffix is merged a number of times that is logarithmic in the number of batches.
2. The segments at noted suffixes are grouped by their bytes: the first of a group stays.
3. All others of a group are removed. First segments whose suffix also has other segments
   are compared window by window; windows that start earlier elsewhere are removed.

Noted suffixes and first segments pass between the steps as bitmaps of a size that does not
depend on the input; whatever they let through in error is settled by a join with the tables.
Suffixes with more than `most_segments` different segments compare their windows in a table
keyed by the window instead of in one task.

Null and empty texts have nothing to remove. A place is an id and a start: rows with the same
id are at the same places, so equal ones do not remove each other, and each row keeps its own
result. A null id is smaller than all others. Other columns are not read. An empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotcraft.llm import bitmap
from lotcraft.llm import words as W
from lotcraft.sources.staging import cut_lineage, new_folder, remove_folder

MATCH = 100
GRAM = 32
BATCHES = 4
BITMAP_BYTES = 8 << 20
MOST_SEGMENTS = 4096
_CLASSES_AT_ONCE = 8192
_LEAST = -(1 << 63)


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes from every place, put together from hashes of powers of two."""
    power, width = W._BYTE_VALUE[data], 1
    out, done, rest = None, 0, size
    while rest:
        step = np.uint64(pow(W._BASE, width, 1 << 64))
        if rest & 1:
            if out is None:
                out, done = power, width
            else:
                count = min(power.size - done, out.size)
                out = out[:count] * step + power[done : done + count]
                done += width
        rest >>= 1
        if rest:
            count = power.size - width
            power = power[:count] * step + power[width:]
            width *= 2
    return W.mixed(out)


class Runs:
    """Runs of windows with the same sampled suffix: start, windows, suffix key, text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, match: int, gram: int):
        empty = np.zeros(0, np.int64)
        self.start, self.windows, self.text, self.key = empty, empty, empty, np.zeros(0, np.uint64)
        self.segment = self.key
        if data.size < match:
            return
        grams = _gram_hashes(data, gram)
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams.size, dtype=np.uint64)
        span, width = match - gram + 1, 1
        while 2 * width <= span:
            least = np.minimum(least[: least.size - width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: least.size - (span - width)], least[span - width :])
        suffix = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        text = np.repeat(np.arange(offsets.size - 1, dtype=np.int32), np.diff(offsets))
        whole = text[: suffix.size] == text[match - 1 : match - 1 + suffix.size]
        begins = whole.copy()
        begins[1:] &= ~(whole[:-1] & (suffix[1:] == suffix[:-1]))
        # Two texts never share a suffix: the windows of the second start behind the first's.
        self.start = np.flatnonzero(begins)
        if not self.start.size:
            return
        broken = np.flatnonzero(~whole)
        after = np.searchsorted(broken, self.start)
        stop = np.append(broken, suffix.size)[after]
        self.windows = np.minimum(np.append(self.start[1:], suffix.size), stop) - self.start
        self.key = grams[suffix[self.start]]
        self.text = text[self.start].astype(np.int64)
        self.segment = W.Spans(data).of(self.start, self.start + self.windows + match - 1)


def _place_hash(key: np.ndarray, segment: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    code = W.mixed(doc.view(np.uint64) + W.mixed(start.astype(np.int64).view(np.uint64) + np.uint64(1)))
    return W.mixed(code + W.mixed(segment ^ W.mixed(key)))


def _chunk_runs(batches: Iterator[pa.RecordBatch], match: int, gram: int
                ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch, Runs, np.ndarray]]:
    """(data, offsets, doc ids, rows, runs, starts within texts) of the chunks of (doc, ..., text)."""
    for batch in batches:
        data, offsets = W.text_arrays(batch.column(len(batch.columns) - 1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b in W.chunks(data, offsets):
            own, places = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            runs = Runs(own, places, match, gram)
            yield own, places, ids[a:b], batch.slice(a, b - a), runs, runs.start - places[runs.text]


class SuffixLevels:
    """Arrays of sampled suffixes (key, doc, n), in levels of 1, 2, 4, ... batches."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[tuple[int, str]] = []
        self.paths: dict[str, str] = {}

    def _stored(self, rows: DataFrame) -> str:
        """Bucketed by key, so that scans and merges of two levels move no row."""
        path = new_folder(self.spark, "suffixes")
        name = path.rpartition("/")[2].replace("-", "_")
        rows.write.bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(name)
        self.paths[name] = path
        return name

    def drop(self, names: list[str]) -> None:
        """Forget tables that a merged one replaces, or that no batch will be scanned against."""
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
            remove_folder(self.spark, self.paths.pop(name))

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Take in a batch of (key, doc); returns the keys that it repeats."""
        name = self._stored(suffixes.groupBy("key").agg(F.min("doc").alias("doc"), F.count("*").alias("n")))
        batch = self.spark.table(name)
        noted = batch.where("n > 1").select("key")
        for _, level in self.levels:
            noted = noted.unionByName(batch.select("key").join(self.spark.table(level), "key", "left_semi"))
        noted = cut_lineage(noted, "noted")
        self.levels.append((1, name))
        return noted

    def merge(self) -> None:
        """Merge the newest levels while two are of the same size."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, one), (_, other) = self.levels.pop(), self.levels.pop()
            a = self.spark.table(one).select("key", F.col("doc").alias("doc_a"), F.col("n").alias("n_a"))
            b = self.spark.table(other).select("key", F.col("doc").alias("doc_b"), F.col("n").alias("n_b"))
            both = a.join(b, "key", "full").select(
                "key", F.least("doc_a", "doc_b").alias("doc"),
                (F.coalesce("n_a", F.lit(0)) + F.coalesce("n_b", F.lit(0))).alias("n"))
            self.levels.append((2 * size, self._stored(both)))
            self.drop([one, other])


def _suffixes(docs: DataFrame, match: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, ids, _, runs, _ in _chunk_runs(batches, match, gram):
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs.key.view(np.int64)), pa.array(ids[runs.text])], ["key", "doc"])

    return docs.select("doc", "text").mapInArrow(run, "key long, doc long")


def _noted_keys(docs: DataFrame, match: int, gram: int, batches: int) -> DataFrame:
    """Keys of the suffixes that occur more than once."""
    shares = [i / batches for i in range(1, batches)]
    bounds = docs.agg(F.percentile_approx("doc", shares)).first()[0] if shares else []
    bounds = sorted(set(bounds or []))
    levels = SuffixLevels(docs.sparkSession)
    noted = None
    for low, high in zip([None, *bounds], [*bounds, None], strict=True):
        part = docs
        part = part if low is None else part.where(F.col("doc") > low)
        part = part if high is None else part.where(F.col("doc") <= high)
        levels.merge()  # what the next batch is scanned against
        found = levels.add(_suffixes(part, match, gram))
        noted = found if noted is None else noted.unionByName(found)
    levels.drop([name for _, name in levels.levels])
    return noted


def _segments(docs: DataFrame, shared: Broadcast, match: int, gram: int) -> DataFrame:
    """(key, segment, doc, start) of the segments at noted suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, ids, _, runs, start in _chunk_runs(batches, match, gram):
            hit = np.flatnonzero(bitmap.contains(shared.value, runs.key))
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs.key[hit].view(np.int64)), pa.array(runs.segment[hit].view(np.int64)),
                 pa.array(ids[runs.text[hit]]), pa.array(start[hit])], ["key", "segment", "doc", "start"])

    return docs.select("doc", "text").mapInArrow(run, "key long, segment long, doc long, start long")


def _place_hashes(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, segment, doc, start = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            code = _place_hash(key.view(np.uint64), segment.view(np.uint64), doc, start)
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64))], ["hash"])

    return classes.select("key", "segment", "first.doc", "first.start").mapInArrow(run, "hash long")


def _merged(start: np.ndarray, end: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each owner put together where they touch; the input is sorted by owner and start."""
    if not start.size:
        return start, end, owner
    # Owners lie apart, so that one running maximum serves all.
    shift = (end.max() + 2) * owner
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], (start + shift)[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], start.size) - 1
    return start[first], (reach - shift)[last], owner[first]


FOUND = ("doc long, code long, spans binary, key long, segment long, start long, windows long, bytes binary")


def _found(docs: DataFrame, noted: Broadcast, firsts: Broadcast, varied: Broadcast, match: int, gram: int) -> DataFrame:
    """Per text the spans that are repeats for certain, and rows for the segments in doubt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, places, several = noted.value, firsts.value, varied.value
        for data, _, ids, rows, runs, start in _chunk_runs(batches, match, gram):
            hit = np.flatnonzero(bitmap.contains(keys, runs.key))
            if not hit.size:
                continue
            doc, code = ids[runs.text], rows.column(1).to_numpy(zero_copy_only=False)
            doubt = bitmap.contains(places, _place_hash(runs.key[hit], runs.segment[hit], doc[hit], start[hit]))
            sure, doubt = hit[~doubt], hit[doubt]
            a, b, owner = _merged(start[sure], start[sure] + runs.windows[sure] + match - 1, runs.text[sure])
            used, first = np.unique(owner, return_index=True)
            cuts = np.append(first, owner.size)
            pairs = np.stack([a, b], axis=1)
            spans = [pairs[p:q].tobytes() for p, q in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]
            whole = data.tobytes()
            begin = runs.start[doubt]
            finish = begin + runs.windows[doubt] + match - 1
            wanted = bitmap.contains(several, runs.key[doubt])
            content = [whole[p:q] if w else None
                       for p, q, w in zip(begin.tolist(), finish.tolist(), wanted.tolist(), strict=True)]
            none = [None] * used.size
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([ids[used], doc[doubt]])),
                pa.array(np.concatenate([code[used], code[runs.text[doubt]]])),
                pa.array(spans + [None] * doubt.size, pa.binary()),
                pa.array(none + runs.key[doubt].view(np.int64).tolist(), pa.int64()),
                pa.array(none + runs.segment[doubt].view(np.int64).tolist(), pa.int64()),
                pa.array(none + start[doubt].tolist(), pa.int64()),
                pa.array(none + runs.windows[doubt].tolist(), pa.int64()),
                pa.array(none + content, pa.binary())], [f.split()[0] for f in FOUND.split(", ")])

    return docs.select("doc", "code", "text").mapInArrow(run, FOUND)


def _windows(table: pa.Table | pa.RecordBatch, match: int) -> tuple[np.ndarray, ...]:
    """(hash, row, place in the row) of all windows of the rows' segments."""
    column = table.column(table.schema.get_field_index("bytes"))
    _, cuts, content = column.buffers()
    offsets = np.frombuffer(cuts, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    count = np.diff(offsets) - match + 1
    row = np.repeat(np.arange(count.size), count)
    inside = np.arange(row.size) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[row] + inside
    key = table.column(table.schema.get_field_index("key")).to_numpy(zero_copy_only=False).view(np.uint64)
    return W.mixed(W.Spans(data).of(begin, begin + match) + W.mixed(key[row])), row, inside


def _compared(first: DataFrame, match: int) -> DataFrame:
    """Spans of (doc, code, key, start, bytes) that repeat a window of another row of the key."""

    def compare(table: pa.Table) -> pa.RecordBatch:
        one = table.combine_chunks().to_batches()[0]
        hashes, row, inside = _windows(one, match)
        doc = one.column(0).to_numpy(zero_copy_only=False)
        code = one.column(1).to_numpy(zero_copy_only=False)
        start = one.column(3).to_numpy(zero_copy_only=False)
        place = start[row] + inside
        order = np.lexsort((place, doc[row], hashes))
        h, d, p = hashes[order], doc[row][order], place[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = order[(d != d[lead]) | (p != p[lead])]
        later.sort()
        a, b, owner = _merged(place[later], place[later] + match, row[later])
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[owner]), pa.array(code[owner]), pa.array(a), pa.array(b)], ["doc", "code", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            at = 0
            while at < len(batch):
                part = batch.slice(at, _CLASSES_AT_ONCE)
                at += len(part)
                waiting.append(part)
                held += len(part)
                if held < _CLASSES_AT_ONCE:
                    continue
                table = pa.Table.from_batches(waiting)
                keys = table.column(2).to_numpy()
                last = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if last:
                    yield compare(table.slice(0, last))
                    table = table.slice(last)
                waiting, held = table.to_batches(), len(table)
        if held:
            yield compare(pa.Table.from_batches(waiting))

    return first.select("doc", "code", "key", "start", "bytes").repartition("key").sortWithinPartitions(
        "key").mapInArrow(run, "doc long, code long, start long, end long")


def _compared_in_table(first: DataFrame, match: int) -> DataFrame:
    """The same for keys of any size, by a row for each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), _CLASSES_AT_ONCE):
                part = batch.slice(at, _CLASSES_AT_ONCE)
                hashes, row, inside = _windows(part, match)
                doc, code, start = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(doc[row]), pa.array(code[row]),
                     pa.array(start[row] + inside)], ["hash", "doc", "code", "start"])

    windows = first.select("doc", "code", "key", "start", "bytes").mapInArrow(
        run, "hash long, doc long, code long, start long")
    # Rank 1 is the first place, also where rows with the same id share it.
    place = F.rank().over(Window.partitionBy("hash").orderBy("doc", "start"))
    return windows.withColumn("nr", place).where("nr > 1").select(
        "doc", "code", "start", (F.col("start") + match).alias("end"))


def repeated_spans(docs: DataFrame, *, match: int = MATCH, gram: int = GRAM, batches: int = BATCHES,
                   bitmap_bytes: int = BITMAP_BYTES, most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """(doc, code, spans): the spans to remove from the rows of `docs` (doc, code, text) that have any."""
    share = docs.sparkSession.sparkContext.broadcast
    noted = share(bitmap.build(_noted_keys(docs, match, gram, batches), bitmap_bytes))
    classes = cut_lineage(_segments(docs, noted, match, gram).groupBy("key", "segment").agg(
        F.min(F.struct("doc", "start")).alias("first")), "segments")
    varied = cut_lineage(classes.groupBy("key").agg(F.count("*").alias("variants")).where("variants > 1"), "varied")
    firsts = share(bitmap.build(_place_hashes(classes), bitmap_bytes))
    several = share(bitmap.build(varied.select("key"), bitmap_bytes))

    found = cut_lineage(_found(docs, noted, firsts, several, match, gram), "found")
    doubt = found.where("key is not null").select("doc", "code", "key", "segment", "start", "windows", "bytes")
    settled = cut_lineage(doubt.join(classes, ["key", "segment"]).join(varied, "key", "left").select(
        "doc", "code", "key", "start", "windows", "variants",
        F.when(F.col("variants") > 1, F.col("bytes")).alias("bytes"),
        ((F.col("doc") == F.col("first.doc")) & (F.col("start") == F.col("first.start"))).alias("is_first")), "settled")
    later = settled.where("not is_first").select(
        "doc", "code", "start", (F.col("start") + F.col("windows") + match - 1).alias("end"))
    first = settled.where("is_first and variants > 1")
    spans = later.unionByName(_compared(first.where(F.col("variants") <= most_segments), match)).unionByName(
        _compared_in_table(first.where(F.col("variants") > most_segments), match))
    sure = found.where("spans is not null").select("doc", "code", "spans", F.lit(None).cast("struct<start:long,end:long>").alias("span"))
    rest = spans.select("doc", "code", F.lit(None).cast("binary").alias("spans"), F.struct("start", "end").alias("span"))
    # The spans of one document's windows: bounded by its length.
    return sure.unionByName(rest).groupBy("doc", "code").agg(
        F.collect_set("spans").alias("sure"), F.collect_set("span").alias("rest"))


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", with_text: bool = True,
                   match: int = MATCH, **settings) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row, and (`with_text`) the kept bytes."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_LEAST)).alias("doc"),
                       F.xxhash64(F.col(text).cast("string")).alias("code"),
                       F.col(text).cast("string").alias("text"))
    spans = cut_lineage(repeated_spans(rows, match=match, **settings), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_arrays(batch.column(1))
            cut, out = offsets.tolist(), []
            sure, rest = batch.column(2), batch.column(3)
            for i, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
                own = data[a:b]
                parts = [np.frombuffer(s, np.int64).reshape(-1, 2) for s in sure[i].as_py() or ()]
                parts += [np.array([[s["start"], s["end"]] for s in rest[i].as_py() or ()], np.int64).reshape(-1, 2)]
                pairs = np.concatenate(parts)
                pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                start, end, _ = _merged(pairs[:, 0], pairs[:, 1], np.zeros(len(pairs), np.int64))
                keep = np.zeros(own.size + 1, np.int8)
                keep[start] += 1
                keep[end] -= 1
                kept = own[np.cumsum(keep[:-1]) == 0].tobytes()
                out.append((own.size, own.size - len(kept), start.size, hashlib.sha256(kept).hexdigest(),
                            kept if with_text else None))
            if out:
                n_bytes, n_removed, n_spans, sha, kept = zip(*out, strict=True)
                columns = [with_null_id(batch.column(0)), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                           pa.array(n_spans, pa.int64()), pa.array(sha), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = rows.join(spans, ["doc", "code"], "left").select("doc", "text", "sure", "rest")
    out = joined.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_text else out.drop("kept")


def with_null_id(ids: pa.Array) -> pa.Array:
    """Ids with the null one restored."""
    values = ids.to_numpy(zero_copy_only=False)
    return pa.array(values, mask=values == _LEAST)

"""Exact removal of repeated word windows through super-k-mer partitions.

A window is `k` consecutive words of a document. A word goes if a window that covers it has the
same words as a window of a document with a smaller id. Windows are judged on the input.

1. Every `m` words have a hash, and a window's minimiser is the smallest of those within it, the
   leftmost of equals, so that equal windows have equal minimisers. Consecutive windows with one
   minimiser, at most k - m + 1, are a super-k-mer: its words, joined by single spaces, hold all
   their windows once. A first pass notes minimisers, documents and places, no text.
2. A minimiser of a single document cannot be that of a repeated window. The others are joined
   back to their places, and the documents that have any send these super-k-mers as packed strings
   to the bucket of their minimiser. Documents without any are finished there.
3. Equal strings of a bucket meet first, with their smallest document. Then the windows of its
   different strings are sorted by their bytes, and each run of equal windows gets its smallest
   document. A bucket with more than `most_strings` different strings is dealt by its windows.
4. The windows that start in a smaller document go back to the documents, which drop their words.

Hashes only choose buckets; windows are equal by their bytes, except that strings are called back
by 128-bit digests and windows of the large buckets meet by them.

Null and empty texts have no words. Shorter texts than a window keep all words. A null id is
smaller than all others; rows with the same id never remove each other's words, and each repeated
row has its own result. A long text is one row, as in the input, and sends no more than three
times its words. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotcraft.llm import words as W
from lotcraft.sources.staging import cut_lineage

WINDOW = 50
GRAM = 8
MOST_STRINGS = 512
_LEAST = -(1 << 63)


class Words:
    """Texts as words parted by one space each: bytes, places of words, first word of every text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        start, end, text = W.word_spans(data, offsets)
        length = end - start
        self.start = np.cumsum(length + 1) - (length + 1)
        self.end = self.start + length
        self.data = np.full(int((length + 1).sum()), 32, np.uint8)
        inside = np.ones(self.data.size, bool)
        inside[self.end] = False
        self.data[inside] = data[~W._SPACE[data]]
        self.text = text
        self.first = np.searchsorted(text, np.arange(offsets.size))

    def joined(self, first: int, last: int) -> bytes:
        """Words first to last, without the space behind."""
        return self.data[self.start[first] : self.end[last - 1]].tobytes() if last > first else b""


class Runs:
    """Super-k-mers of many texts: first word, windows, minimiser."""

    def __init__(self, words: Words, k: int, m: int):
        self.first, self.windows, self.key = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if words.start.size < k:
            return
        grams = W.Spans(words.data).of(words.start[: words.start.size - m + 1], words.end[m - 1 :])
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams.size, dtype=np.uint64)
        span, width = k - m + 1, 1
        while 2 * width <= span:
            least = np.minimum(least[: least.size - width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: least.size - (span - width)], least[span - width :])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        whole = words.text[: place.size] == words.text[k - 1 : k - 1 + place.size]
        begins = whole.copy()
        begins[1:] &= ~(whole[:-1] & (place[1:] == place[:-1]))
        self.first = np.flatnonzero(begins)
        if not self.first.size:
            return
        broken = np.flatnonzero(~whole)
        stop = np.append(broken, place.size)[np.searchsorted(broken, self.first)]
        self.windows = np.minimum(np.append(self.first[1:], place.size), stop) - self.first
        self.key = grams[place[self.first]]


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    own = F.col(doc_id).cast("long")
    content = F.col(text).cast("string")
    return docs.select(own.alias("doc_id"), F.coalesce(own, F.lit(_LEAST)).alias("doc"),
                       F.xxhash64(content).alias("code"), content.alias("text"))


def _places(rows: DataFrame, k: int, m: int) -> DataFrame:
    """(key, doc, code, first, windows) of every super-k-mer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_arrays(batch.column(2))
            docs, codes = (batch.column(i).to_numpy() for i in (0, 1))
            for a, b in W.chunks(data, offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                runs = Runs(words, k, m)
                text = words.text[runs.first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(runs.key.view(np.int64)), pa.array(docs[a:b][text]), pa.array(codes[a:b][text]),
                     pa.array((runs.first - words.first[text]).astype(np.int32)),
                     pa.array(runs.windows.astype(np.int32))], ["key", "doc", "code", "first", "windows"])

    return rows.select("doc", "code", "text").mapInArrow(run, "key long, doc long, code long, first int, windows int")


_PARTS = ("doc_id long, doc long, code long, n_words long, kept_sha256 string, text string, "
          "key long, digest binary, first int, windows int, packed binary")


def _send(rows: DataFrame, k: int) -> DataFrame:
    """Results of documents without places; texts and packed super-k-mers of the others."""
    names = [c.split()[0] for c in _PARTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_arrays(batch.column(3))
            for a, b in W.chunks(data, offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                part = batch.slice(a, b - a)
                out: list[tuple] = []
                size = 0
                for i, (doc_id, doc, code, text, places) in enumerate(zip(*[c.to_pylist() for c in part.columns], strict=True)):
                    low, high = int(words.first[i]), int(words.first[i + 1])
                    if places is None:
                        kept = hashlib.sha256(words.joined(low, high)).hexdigest()
                        out.append((doc_id, doc, code, high - low, kept, *[None] * 6))
                        continue
                    out.append((doc_id, doc, code, high - low, None, text, *[None] * 5))
                    for place in places:
                        first, windows = place["first"], place["windows"]
                        packed = words.joined(low + first, low + first + windows + k - 1)
                        size += len(packed)
                        digest = hashlib.blake2b(packed, digest_size=16).digest()
                        out.append((None, doc, code, None, None, None, place["key"], digest, first, windows, packed))
                        if size > 8 * W.CHUNK_BYTES:
                            yield pa.RecordBatch.from_arrays(_columns(out, _TYPES), names)
                            out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays(_columns(out, _TYPES), names)

    return rows.select("doc_id", "doc", "code", "text", "places").mapInArrow(run, _PARTS)


_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
          pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]


def _columns(rows: list[tuple], types: list[pa.DataType]) -> list[pa.Array]:
    return [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]


def window_bytes(packed: bytes, windows: int, k: int) -> list[bytes]:
    """The windows of a packed string."""
    spaces = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32)
    starts = np.concatenate([[0], spaces + 1])[:windows].tolist()
    ends = np.append(spaces, len(packed))[k - 1 : k - 1 + windows].tolist()
    return [packed[a:b] for a, b in zip(starts, ends, strict=True)]


_FOUND = "key long, digest binary, earliest array<long>"
_FOUND_TYPES = [pa.int64(), pa.binary(), pa.list_(pa.int64())]


def _sorted_buckets(strings: DataFrame, k: int) -> DataFrame:
    """(key, digest, earliest): the smallest document of every window of the strings some document loses."""

    def solve(bucket: list[tuple]) -> list[tuple]:
        if len(bucket) == 1:
            key, digest, _, windows, least, most = bucket[0]
            return [(key, digest, [least] * windows)] if least < most else []
        found = [[row[4]] * row[3] for row in bucket]
        places = sorted(
            (window, row[4], i, j) for i, row in enumerate(bucket) for j, window in enumerate(window_bytes(row[2], row[3], k)))
        same = None
        for window, doc, i, j in places:
            if window != same:
                same, least = window, doc
            found[i][j] = least
        return [(row[0], row[1], f) for row, f in zip(bucket, found, strict=True) if min(f) < row[5]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[0][0] != row[0]:
                    out += solve(held)
                    held = []
                held.append(row)
            if len(out) >= 1 << 12:
                yield pa.RecordBatch.from_arrays(_columns(out, _FOUND_TYPES), ["key", "digest", "earliest"])
                out = []
        if held:
            out += solve(held)
        if out:
            yield pa.RecordBatch.from_arrays(_columns(out, _FOUND_TYPES), ["key", "digest", "earliest"])

    ordered = strings.select("key", "digest", "packed", "windows", "least", "most").repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, _FOUND)


def _dealt_buckets(strings: DataFrame, k: int) -> DataFrame:
    """As `_sorted_buckets`, for buckets of any size: windows meet by their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                windows = window_bytes(row["packed"], row["windows"], k)
                yield pa.RecordBatch.from_arrays(
                    _columns([(row["key"], row["digest"], i, hashlib.blake2b(w, digest_size=16).digest(), row["least"])
                              for i, w in enumerate(windows)],
                             [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64()]),
                    ["key", "digest", "at", "window", "least"])

    rows = cut_lineage(strings.select("key", "digest", "packed", "windows", "least").mapInArrow(
        run, "key long, digest binary, at int, window binary, least long"), "windows")
    first = cut_lineage(rows.groupBy("window").agg(F.min("least").alias("earliest")), "earliest")
    found = rows.drop("least").join(first, "window").groupBy("key", "digest").agg(
        F.array_sort(F.collect_list(F.struct("at", "earliest"))).alias("list"))
    return found.select("key", "digest", F.col("list.earliest").alias("earliest"))


def _drop(rows: DataFrame, k: int) -> DataFrame:
    """Results of the documents that sent super-k-mers; `starts` are the windows to drop."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_arrays(batch.column(1))
            for a, b in W.chunks(data, offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                part = batch.slice(a, b - a)
                out = []
                for i, (doc_id, starts) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True)):
                    low, high = int(words.first[i]), int(words.first[i + 1])
                    marks = np.zeros(high - low + 1, np.int64)
                    if starts:
                        at = np.unique(np.array(starts, np.int64))
                        marks[at] += 1
                        marks[at + k] -= 1
                    gone = np.cumsum(marks)[:-1] > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
                    kept = b" ".join(words.joined(low + x, low + y) for x, y in edges.reshape(-1, 2).tolist())
                    out.append((doc_id, high - low, int(gone.sum()), hashlib.sha256(kept).hexdigest()))
                yield pa.RecordBatch.from_arrays(
                    _columns(out, [pa.int64(), pa.int64(), pa.int64(), pa.string()]), _RESULT)

    return rows.select("doc_id", "text", "starts").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


_RESULT = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def drop_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                 most_strings: int = MOST_STRINGS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    rows = _rows(docs, doc_id, text)
    places = cut_lineage(_places(rows, window, gram), "places")
    shared = cut_lineage(places.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
                         .where("least < most").select("key"), "shared")
    lists = cut_lineage(
        places.join(shared, "key", "left_semi").groupBy("doc", "code")
        .agg(F.collect_set(F.struct("first", "windows", "key")).alias("places")), "lists")
    parts = cut_lineage(_send(rows.join(lists, ["doc", "code"], "left"), window), "parts")

    sent = parts.where("packed is not null")
    strings = cut_lineage(sent.groupBy("key", "digest", "windows", "packed").agg(
        F.min("doc").alias("least"), F.max("doc").alias("most")), "strings")
    large = cut_lineage(strings.groupBy("key").count().where(F.col("count") > most_strings).select("key"), "large")
    if large.isEmpty():
        found = _sorted_buckets(strings, window)
    else:
        found = _sorted_buckets(strings.join(large, "key", "left_anti"), window).unionByName(
            _dealt_buckets(strings.join(large, "key", "left_semi"), window))
    found = cut_lineage(found, "found")

    # A string of many documents is read by all of them: the join may split it.
    starts = F.filter(F.transform("earliest", lambda e, i: F.when(e < F.col("doc"), F.col("first") + i)), lambda s: s.isNotNull())
    drops = sent.select("key", "digest", "doc", "code", "first").join(found, ["key", "digest"]).select(
        "doc", "code", starts.alias("starts")).where(F.size("starts") > 0)
    drops = cut_lineage(drops.groupBy("doc", "code").agg(F.flatten(F.collect_set("starts")).alias("starts")), "drops")
    waiting = parts.where("text is not null").select("doc_id", "doc", "code", "text").join(drops, ["doc", "code"], "left")
    done = parts.where("kept_sha256 is not null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256")
    return done.unionByName(_drop(waiting, window))


WINDOWS_SQL = """
    WITH split_rows AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM {documents}),
    windows AS (
        SELECT doc_id, spot, array_to_string(words[spot + 1 : spot + 50], ' ') AS content
        FROM split_rows, unnest(range(0, len(words) - 49)) AS places(spot)),
    earliest AS (SELECT content, min(doc_id) AS least FROM windows GROUP BY content),
    gone AS (
        SELECT DISTINCT doc_id, spot + step AS place
        FROM windows JOIN earliest USING (content), range(1, 51) AS steps(step) WHERE doc_id > least),
    marked AS (
        SELECT r.doc_id, r.words[place] AS word, place, g.place IS NOT NULL AS removed
        FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS place FROM split_rows) r LEFT JOIN gone g USING (doc_id, place)),
    kept AS (
        SELECT doc_id, count(*) FILTER (removed) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT removed) AS content
        FROM marked GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(content, '')) AS kept_sha256
    FROM split_rows LEFT JOIN kept USING (doc_id)"""

"""Token ids of a corpus in binary files: frequency ranks, byte-aligned, control bytes apart.

Texts are encoded once, the ids counted, and every id is replaced by its rank in the order of
falling frequency, so that the common ones take one byte. Documents are range-sorted by id and
written as shards:

    blocks   u32 ids in the block, u32 data bytes, control bytes, data bytes
    index    i64 doc_id, u64 ids of every document; a null id is the smallest i64
    footer   u64 documents, u64 ids, u64 place of the index, magic

A control byte holds the byte lengths (1 to 4) of four ranks, two bits each, lowest first; the
data bytes are little-endian. A reader looks the four lengths up in a table of 256 rows.
`ranks.bin` holds the id of every rank as u32. Shards sort by name.

Null and empty texts consist of the end id. A special token's string in a text is its one id, as
the library encodes it by default. Rows with the same id follow each other by their
encoded ids, repeated rows included. Other columns are not read. An empty table gives no
shard and an empty result. A task that is run again writes the same bytes under the same name.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotcraft.llm import words as W
from lotcraft.llm.files import put, store_of
from lotcraft.sources.staging import cut_lineage, new_folder

MAGIC = b"TOKRANK1"
BLOCK_IDS = 1 << 16
SHARD_BYTES = 16 << 20
END_ID = 0
_NO_ID = np.iinfo(np.int64).min
# Encoded words a worker remembers. Those met first stay: they are the frequent ones.
CACHE_WORDS = 1_000_000
MARKS = ".,;:!?)"

LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])[None, :] & 3).astype(np.uint8) + np.uint8(1)

# How a byte-level vocabulary parts a text before its merges, and the characters
# that stand for the bytes in it: printable Latin-1 for itself, the others from U+0100 on.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_AS_CHARACTER = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(_OTHERS)}

_PIECES = regex.compile(PATTERN)


def regular_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts are words parted by single spaces and line feeds; the others are encoded whole.

    So are texts with characters beyond Latin and common punctuation, where the classes of two
    libraries may differ by their Unicode versions.
    """
    out = offsets[1:] > offsets[:-1]
    if not data.size:
        return out
    blank = (data == 32) | (data == 10)
    odd = (data < 32) & (data != 10)
    odd[1:] |= blank[1:] & blank[:-1]
    lead = np.flatnonzero((data == 0xC2) | (data >= 0xC9))
    first, one, two = (data[np.minimum(lead + k, data.size - 1)] for k in range(3))
    usual = (first == 0xC2) & (one != 0x85) & (one != 0xA0)
    usual |= (first == 0xE2) & (one == 0x80) & (two >= 0x90) & (two <= 0xA7)
    usual |= (first == 0xE2) & (one == 0x82) & (two == 0xAC)
    odd[lead[~usual]] = True
    full = np.flatnonzero(out)
    out[full] = ~blank[offsets[full]] & ~blank[offsets[full + 1] - 1]
    out[np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1] = False
    return out


class Encoder:
    """Ids of texts by the tokenizers library, each distinct word of a regular text encoded once.

    A byte-level vocabulary parts a text by its pattern and merges each piece alone. The pattern
    starts a new piece at a space before a word and at a line feed between words, so that a
    text's ids are those of its words one after another. Any other tokenizer encodes texts whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        # An added token's string stands for its id wherever it is written.
        self.added = [t["content"] for t in parts.get("added_tokens") or ()]
        before = parts.get("pre_tokenizer") or {}
        self.by_word = (
            before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
            and before.get("use_regex", True) and parts.get("normalizer") is None
            and parts["model"]["type"] == "BPE" and not parts["model"].get("dropout"))
        self.feed = self._whole("\n") if self.by_word else b""
        self.marks = {m: self._whole(m) for m in MARKS} if self.by_word else {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _piece(self, piece: str) -> bytes:
        characters = piece.encode().decode("latin-1").translate(_AS_CHARACTER)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(characters)]).tobytes()

    def _listed(self, words: list[str], lead: str) -> list[bytes]:
        """Ids of `lead + word` for every word without a blank.

        A word of letters is one piece, and one with a mark behind is two.
        """
        out: list[bytes | None] = []
        others: list[int] = []
        for i, word in enumerate(words):
            head = word[:-1]
            if word.isalpha():
                out.append(self._piece(lead + word))
            elif head.isalpha() and word[-1] in MARKS:
                ids = self.known.get(head) if lead else None
                out.append((ids or self._piece(lead + head)) + self.marks[word[-1]])
            else:
                out.append(None)
                others.append(i)
        for i, ids in zip(others, self._parted([words[i] for i in others], lead), strict=True):
            out[i] = ids
        return out

    def _parted(self, words: list[str], lead: str) -> list[bytes]:
        """The same for any words, parted by the pattern."""
        pieces, out = self.pieces, []
        for i in range(0, len(words), 4096):
            now: list[bytes] = []
            for piece in _PIECES.findall("\n".join([lead + w for w in words[i : i + 4096]])):
                if piece == "\n":
                    out.append(b"".join(now))
                    now = []
                    continue
                ids = pieces.get(piece)
                if ids is None:
                    ids = self._piece(piece)
                    if len(pieces) < CACHE_WORDS // 10:
                        pieces[piece] = ids
                now.append(ids)
            out.append(b"".join(now))
        if len(out) != len(words):
            raise ValueError("a word holds a line feed")
        return out

    def encode(self, texts: list[str], regular: np.ndarray) -> list[bytes]:
        """Ids of every text as little-endian u32."""
        parts: list[list[str] | None] = []
        fresh: set[str] = set()
        known = self.known
        for text, plain in zip(texts, regular.tolist(), strict=True):
            if not plain or not self.by_word or any(t in text for t in self.added):
                parts.append(None)
                continue
            # \r marks the text's first word and \n a line's first: neither follows a space.
            pieces = ("\r" + text.replace("\n", " \n")).split(" ")
            parts.append(pieces)
            fresh.update([p for p in pieces if p not in known])
        full = len(known) >= CACHE_WORDS
        if fresh:
            spaced = [p for p in fresh if p[0] not in "\r\n"]
            bare = [p for p in fresh if p[0] in "\r\n"]
            known.update(zip(spaced, self._listed(spaced, " "), strict=True))
            known.update((p, self.feed + ids if p[0] == "\n" else ids)
                         for p, ids in zip(bare, self._listed([p[1:] for p in bare], ""), strict=True))
        find = known.__getitem__
        out = [b"".join(map(find, p)) if p is not None else self._whole(t) if t else b""
               for p, t in zip(parts, texts, strict=True)]
        if full:
            for word in fresh:
                del known[word]
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every row as little-endian bytes, two an id where they fit, the end id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        kind = np.uint16 if own.vocabulary <= 1 << 16 else np.uint32
        end = np.array([END_ID], kind).tobytes()
        for batch in batches:
            column = batch.column(1)
            data, offsets = W.text_arrays(column)
            for a, b in W.chunks(data, offsets):
                texts = [t or "" for t in column.slice(a, b - a).to_pylist()]
                regular = regular_texts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ids = [np.frombuffer(i, np.uint32).astype(kind).tobytes() + end for i in own.encode(texts, regular)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, ids binary")


def _values(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, places) of a column of id bytes."""
    _, places, content = column.buffers()
    offsets = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(kind).itemsize
    data = np.frombuffer(content, np.uint8)[offsets[0] : offsets[-1]].tobytes() if content else b""
    return np.frombuffer(data, kind), (offsets - offsets[0]) // size


def ranked_ids(ids: DataFrame, vocabulary: int, kind: type) -> np.ndarray:
    """Ids in the order of falling frequency, then of the id: as many as the vocabulary has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            if len(batch):
                counts += np.bincount(_values(batch.column(0), kind)[0], minlength=vocabulary)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])

    # At most one row for each entry of the vocabulary reaches the driver.
    totals = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary, np.int64)
    for row in totals:
        counts[row["id"]] = row["n"]
    return np.argsort(-counts, kind="stable")


def pack(ranks: np.ndarray) -> bytes:
    """One block."""
    length = 1 + (ranks > 0xFF).astype(np.int64) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-ranks.size // 4) * 4, np.uint8)
    padded[: ranks.size] = length - 1
    control = padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    control = np.bitwise_or.reduce(control, axis=1) if ranks.size else np.zeros(0, np.uint8)
    at = np.cumsum(length) - length
    data = np.zeros(int(length.sum()), np.uint8)
    for k in range(4):
        wide = length > k
        data[at[wide] + k] = (ranks[wide] >> (8 * k)) & 0xFF
    head = np.array([ranks.size, data.size], "<u4").tobytes()
    return head + control.tobytes() + data.tobytes()


def unpack(block: memoryview) -> tuple[np.ndarray, int]:
    """(ranks, bytes used) of the block at the start of `block`."""
    count, size = np.frombuffer(block[:8], "<u4").tolist()
    controls = -(-count // 4)
    length = LENGTHS[np.frombuffer(block[8 : 8 + controls], np.uint8)].reshape(-1)[:count].astype(np.int64)
    data = np.frombuffer(block[8 + controls : 8 + controls + size], np.uint8)
    at = np.cumsum(length) - length
    ranks = np.zeros(count, np.int64)
    for k in range(4):
        wide = length > k
        ranks[wide] |= data[at[wide] + k].astype(np.int64) << (8 * k)
    return ranks, 8 + controls + size


def _shard(blocks: list[bytes], ids: list[int], counts: list[int]) -> list[bytes]:
    index = [np.array(ids, "<i8").tobytes(), np.array(counts, "<u8").tobytes()]
    place = sum(map(len, blocks))
    return [*blocks, *index, np.array([len(ids), sum(counts), place], "<u8").tobytes(), MAGIC]


def write_shards(docs: DataFrame, folder: str, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text",
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the corpus to `folder`; returns (shard, n_docs, n_tokens)."""
    own = encoder(tokenizer)
    vocabulary, kind = own.vocabulary, np.uint16 if own.vocabulary <= 1 << 16 else np.uint32
    spark = docs.sparkSession
    path = new_folder(spark, "ids")
    encoded(docs, tokenizer, doc_id, text).write.option("compression", "zstd").parquet(path)
    ids = spark.read.schema("doc_id long, ids binary").parquet(path)
    by_rank = ranked_ids(ids, vocabulary, kind)
    rank = np.empty(vocabulary, np.int32)
    rank[by_rank] = np.arange(vocabulary, dtype=np.int32)
    store, place = store_of(folder)
    store.create_dir(place, recursive=True)
    put(store, f"{place}/ranks.bin", [by_rank.astype("<u4").tobytes()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = store_of(folder)
        part = TaskContext.get().partitionId()
        blocks: list[bytes] = []
        waiting: list[np.ndarray] = []
        doc_ids: list[int] = []
        counts: list[int] = []
        size = held = made = 0

        def close_block(least: int) -> None:
            nonlocal size, held, waiting
            if held < least or not held:
                return
            ranks = np.concatenate(waiting)
            whole = ranks.size if least == 1 else ranks.size // BLOCK_IDS * BLOCK_IDS
            for i in range(0, whole, BLOCK_IDS):
                blocks.append(pack(ranks[i : min(i + BLOCK_IDS, whole)]))
                size += len(blocks[-1])
            waiting, held = [ranks[whole:]], ranks.size - whole

        def close_shard() -> pa.RecordBatch:
            nonlocal size, made
            close_block(1)
            name = f"shard-{part:06d}-{made:06d}.tok"
            put(target, f"{root}/{name}", _shard(blocks, doc_ids, counts))
            row = pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(doc_ids)]), pa.array([sum(counts)])], ["shard", "n_docs", "n_tokens"])
            blocks.clear(), doc_ids.clear(), counts.clear()
            size, made = 0, made + 1
            return row

        for batch in batches:
            if not len(batch):
                continue
            values, cuts = _values(batch.column(1), kind)
            own_ids = batch.column(0).to_pylist()
            for i, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist(), strict=False)):
                waiting.append(rank[values[a:b]])
                held += b - a
                doc_ids.append(_NO_ID if own_ids[i] is None else own_ids[i])
                counts.append(b - a)
                close_block(BLOCK_IDS)
                if size >= shard_bytes:
                    yield close_shard()
        if doc_ids:
            yield close_shard()

    ordered = ids.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "ids")
    return ordered.mapInArrow(run, "shard string, n_docs long, n_tokens long")


def read_shard(content: bytes, by_rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, number of ids, ids of all documents) of a shard."""
    if content[-8:] != MAGIC:
        raise ValueError("not a token shard")
    docs, total, place = np.frombuffer(content[-32:-8], "<u8").tolist()
    doc_ids = np.frombuffer(content[place : place + 8 * docs], "<i8")
    counts = np.frombuffer(content[place + 8 * docs : place + 16 * docs], "<u8").astype(np.int64)
    ids = np.empty(total, "<u4")
    view, at, done = memoryview(content), 0, 0
    while at < place:
        ranks, used = unpack(view[at:place])
        ids[done : done + ranks.size] = by_rank[ranks]
        at, done = at + used, done + ranks.size
    if done != total or int(counts.sum()) != total:
        raise ValueError("a token shard is incomplete")
    return doc_ids, counts, ids


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, shard, row, local_start, n_tokens, ids_crc32) of every document in the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        with store.open_input_stream(f"{root}/ranks.bin") as ranks:
            by_rank = np.frombuffer(ranks.read(), "<u4")
        for batch in batches:
            for i in range(len(batch)):
                name = batch.column(0)[i].as_py().rpartition("/")[2]
                doc_ids, counts, ids = read_shard(batch.column(1)[i].as_py(), by_rank)
                whole = memoryview(ids.tobytes())
                start = np.cumsum(counts) - counts
                crcs = [zlib.crc32(whole[4 * a : 4 * (a + n)])
                        for a, n in zip(start.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=doc_ids == _NO_ID), pa.array([name] * counts.size, pa.string()),
                     pa.array(np.arange(counts.size)), pa.array(start), pa.array(counts), pa.array(crcs, pa.int64())],
                    ["doc_id", "shard", "row", "local_start", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)
    return files.select("path", "content").mapInArrow(
        run, "doc_id long, shard string, row long, local_start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text",
               folder: str | None = None) -> DataFrame:
    """Write the shards, read them back: (doc_id, start, n_tokens, ids_crc32) of every row."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    shards = cut_lineage(write_shards(docs, folder, tokenizer, doc_id=doc_id, text=text), "shards")
    found = read_documents(spark, folder)
    # One row a shard, from the files' writers.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before"))
    return found.join(starts, "shard").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")

"""Alignment of two tokenizers over the same bytes, by fragments that compose.

A text with one space in front is encoded by a byte-level BPE (A) and a sentencepiece model (B).
The byte offsets where tokens of both end cut the tokens into groups; all pairs of an A and a B
token of one group are linked.

1. A byte range of a text yields a *fragment* of the tokens that end in it: the open prefix up to
   the first cut, the closed groups between its cuts, and the open suffix behind the last. Two
   neighbours compose: the left's suffix and the right's prefix close a group, or stay open if one of
   them has no cut. Composition is associative and the empty fragment is neutral.
2. A text of at most `chunk_bytes` is one range, aligned in its task. A longer one is cut into such
   ranges, anywhere, also within a word; its ranges are dealt to all tasks and their fragments are
   reduced in a tree, `FAN` neighbours at a time. Closed groups do not travel up: they stay as
   pieces of the document's text of groups, which is hashed in order as a stream.
3. Between two visible characters, neither tokenizer merges across a single space or line feed (the
   vocabulary is searched for pieces that could), so that a range is encoded from the last such place
   before it to the first behind it, and equal words are aligned once in a worker. Without such a
   place a text is encoded whole, in one range.
4. Documents that hold a pair are counted: within a task first, for cut texts over their distinct
   pairs. The `top_pairs` most frequent counts are broadcast (16 bytes each, whatever the input); the
   links of all other pairs, none of them frequent, are joined with their counts.

Null and empty texts, and texts whose tokens of A or B do not spell their bytes (such as one with
U+2581), have no tokens: zeros and ''. Special tokens' strings are plain text. Repeated rows are
documents of their own, whatever their ids; null ids are kept. Ties for an A id's highest count all
count. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotcraft.llm import words as W
from lotcraft.llm.token_files import _AS_CHARACTER, regular_texts
from lotcraft.sources.staging import cut_lineage

CHUNK_BYTES = 1 << 15
TOP_PAIRS = 1 << 17
FAN = 16
CACHE_WORDS = 300_000
_CACHED_LENGTH = 48
_SHIFT = 32

# A place between two tokens of any text: a single space or line feed between visible characters.
_PLACE = regex.compile(r"(?<=[^\s\p{C}\p{Z}])(?=[ \n][^\s\p{C}\p{Z}])")
_INNER_SPACE = re.compile("[^▁]▁|[ \n]")


def groups_of(a: list[int], a_size: list[int], b: list[int], b_size: list[int]) -> list[tuple[list[int], list[int]]]:
    """Groups of two token sequences over the same bytes."""
    out: list[tuple[list[int], list[int]]] = []
    left: list[int] = []
    right: list[int] = []
    i = j = a_end = b_end = 0
    while i < len(a) or j < len(b):
        if a_end <= b_end:
            left.append(a[i])
            a_end += a_size[i]
            i += 1
        else:
            right.append(b[j])
            b_end += b_size[j]
            j += 1
        if a_end == b_end:
            out.append((left, right))
            left, right = [], []
    return out


def links_of(groups: list[tuple[list[int], list[int]]]) -> Counter:
    """How often each pair (a << 32 | b) is linked."""
    found: Counter = Counter()
    for left, right in groups:
        if len(left) == len(right) == 1:
            found[left[0] << _SHIFT | right[0]] += 1
            continue
        b_counts = Counter(right).items()
        for a, n in Counter(left).items():
            for b, m in b_counts:
                found[a << _SHIFT | b] += n * m
    return found


def spelled(groups: list[tuple[list[int], list[int]]]) -> str:
    return ";".join([",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups])


class Aligner:
    """Both tokenizers, and the alignments of words met so far."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the threads
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        as_byte = {c: b for b, c in _AS_CHARACTER.items()}
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for entry, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes([as_byte[c] for c in entry]) if all(c in as_byte for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.comma, self.bar, self.end = (np.array([f"{i}{mark}" for i in range(most)], object) for mark in ",|;")
        with open(path_a, encoding="utf-8") as file:
            parts = json.load(file)
        before = parts.get("pre_tokenizer") or {}
        self.splits = (
            before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
            and parts.get("normalizer") is None and not any(_INNER_SPACE.search(p) for p in pieces))
        self.space = self.b.encode("\n")[:-1]  # what stands for the space in front of a line feed
        self.known: dict[str, int] = {}
        self.records: list[tuple | None] = []
        self.fresh: list[str] = []

    def units(self, spaced: str, regular: bool) -> list[str]:
        """Parts of a text, with its space in front, that are encoded by themselves."""
        if not self.splits:
            return [spaced]
        if regular:
            return (spaced[0] + spaced[1:].replace("\n", "\0\n").replace(" ", "\0 ")).split("\0")
        return _PLACE.split(spaced)

    def encoded(self, units: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """(A ids, B ids) of every unit, None where they do not spell it."""
        spaced = [u[1:] if u[0] == " " else u for u in units]
        skip = len(self.space)
        a = [own.ids for own in self.a.encode_batch_fast(units, add_special_tokens=False)]
        b = [ids if u[0] == " " else ids[skip:] if ids[:skip] == self.space else []
             for u, ids in zip(units, self.b.encode(spaced, num_threads=1), strict=True)]
        if self._spells(units, a, self.a_bytes, self.a_size) and self._spells(units, b, self.b_bytes, self.b_size):
            return list(zip(a, b, strict=True))
        return [(x, y) if b"".join([self.a_bytes[i] for i in x]) == u.encode() == b"".join([self.b_bytes[i] for i in y]) else None
                for u, x, y in zip(units, a, b, strict=True)]

    def _spells(self, units: list[str], ids: list[list[int]], table: list[bytes], size: np.ndarray) -> bool:
        """Whether all units are spelled by their tokens."""
        flat = list(chain.from_iterable(ids))
        if b"".join(map(table.__getitem__, flat)) != "".join(units).encode():
            return False
        ends = np.append(0, np.cumsum(size[np.array(flat, np.int64)]))[np.cumsum([len(x) for x in ids])]
        return np.array_equal(ends, np.cumsum([len(u.encode()) for u in units]))

    def learn(self, units: set[str]) -> None:
        """Records (n_a, n_b, n_groups, n_links, text, pairs) of new units, None for those not spelled."""
        new = list(units)
        for start in range(0, len(new), 1 << 15):
            self._learn(new[start : start + (1 << 15)])
        self.fresh += new

    def _learn(self, units: list[str]) -> None:
        """All units as one sequence of tokens: every unit's end is a cut."""
        found = self.encoded(units)
        for unit, ids in zip(units, found, strict=True):
            if ids is None:
                self.known[unit] = len(self.records)
                self.records.append(None)
        units = [u for u, ids in zip(units, found, strict=True) if ids is not None]
        if not units:
            return
        lists = [[ids[k] for ids in found if ids is not None] for k in (0, 1)]
        a, b = (np.array(list(chain.from_iterable(x)), np.int64) for x in lists)
        a_units, b_units = (np.cumsum([len(ids) for ids in x]) for x in lists)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        n_a, n_b = np.bincount(a_group, minlength=cuts.size), np.bincount(b_group, minlength=cuts.size)
        a_start, b_start = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        groups = a_group[a_units - 1] + 1  # groups up to the end of every unit

        text = np.empty(a.size + b.size, object)
        last = np.append(a_group[1:] != a_group[:-1], True)
        text[np.arange(a.size) + b_start[a_group]] = np.where(last, self.bar[a], self.comma[a])
        last = np.append(b_group[1:] != b_group[:-1], True)
        text[np.arange(b.size) + (a_start + n_a)[b_group]] = np.where(last, self.end[b], self.comma[b])

        n_links = n_a * n_b
        group = np.repeat(np.arange(cuts.size), n_links)
        inner = np.arange(group.size) - np.repeat(np.cumsum(n_links) - n_links, n_links)
        pairs = a[a_start[group] + inner // n_b[group]] << _SHIFT | b[b_start[group] + inner % n_b[group]]
        links = np.cumsum(n_links)[groups - 1]

        shown = text.tolist()
        bounds = zip(units, a_units.tolist(), b_units.tolist(), groups.tolist(), links.tolist(), strict=True)
        a0 = b0 = g0 = l0 = 0
        for unit, a1, b1, g1, l1 in bounds:
            self.known[unit] = len(self.records)
            self.records.append((a1 - a0, b1 - b0, g1 - g0, l1 - l0, "".join(shown[a0 + b0 : a1 + b1])[:-1], pairs[l0:l1]))
            a0, b0, g0, l0 = a1, b1, g1, l1

    def used(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray, list[tuple | None]]:
        """(list of every unit, which record it has, the records), learning those not met before."""
        known = self.known
        self.learn({u for units in lists for u in units if u not in known})
        owner = np.repeat(np.arange(len(lists)), [len(units) for units in lists])
        numbers = np.array([known[u] for units in lists for u in units], np.int64)
        numbers, place = np.unique(numbers, return_inverse=True)
        records = [self.records[n] for n in numbers.tolist()]
        self.forget()
        return owner, place, records

    def forget(self) -> None:
        """Keep the words met first; drop long units and what is beyond the most that is kept."""
        for unit in self.fresh:
            if self.known[unit] >= CACHE_WORDS or len(unit) > _CACHED_LENGTH:
                self.records[self.known.pop(unit)] = None
        self.fresh = []
        del self.records[CACHE_WORDS:]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One a worker and pair of files."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


class Fragment:
    """Tokens that end in a byte range: open prefix, whether it has a cut and where, open suffix."""

    def __init__(self, pre=((), ()), first=None, suf=((), ())):
        self.pre, self.first, self.suf = (list(pre[0]), list(pre[1])), first, (list(suf[0]), list(suf[1]))

    def then(self, other: Fragment) -> tuple[Fragment, tuple[list[int], list[int]] | None]:
        """The two ranges as one, and the group that closes between them."""
        if other.first is None:
            if self.first is None:
                return Fragment(_both(self.pre, other.pre)), None
            return Fragment(self.pre, self.first, _both(self.suf, other.pre)), None
        if self.first is None:
            return Fragment(_both(self.pre, other.pre), other.first, other.suf), None
        return Fragment(self.pre, self.first, other.suf), _both(self.suf, other.pre)


def _both(x: tuple[list[int], list[int]], y: tuple[list[int], list[int]]) -> tuple[list[int], list[int]]:
    return x[0] + y[0], x[1] + y[1]


def fragment(number: int, a: list[int], a_end: list[int], b: list[int], b_end: list[int], begins: bool
             ) -> tuple[Fragment, list[tuple[list[int], list[int]]]]:
    """Fragment `number` of tokens and the offsets of their ends, and its closed groups; a text begins with a cut."""
    cuts = sorted(set(a_end) & set(b_end))
    runs: list[tuple[list[int], list[int]]] = []
    i = j = 0
    for cut in cuts:
        i2, j2 = i, j
        while i2 < len(a) and a_end[i2] <= cut:
            i2 += 1
        while j2 < len(b) and b_end[j2] <= cut:
            j2 += 1
        runs.append((a[i:i2], b[j:j2]))
        i, j = i2, j2
    rest = (a[i:], b[j:])
    if begins:
        return Fragment(((), ()), number, rest), runs
    if not runs:
        return Fragment(rest), []
    return Fragment(runs[0], number, rest), runs[1:]


_PARTS = [("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
          ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
          ("pair", pa.int64()), ("n_docs", pa.int64()),
          ("chunk", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("start", pa.int64()), ("segment", pa.string()),
          ("regular", pa.bool_())]
_SQL = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.int64()): "array<long>", pa.bool_(): "boolean"}


def _ddl(fields: list[tuple[str, pa.DataType]]) -> str:
    return ", ".join(f"{n} {_SQL[t]}" for n, t in fields)


def _batch(fields: list[tuple[str, pa.DataType]], size: int, **columns) -> pa.RecordBatch:
    """Columns by name; the others are null."""
    return pa.RecordBatch.from_arrays(
        [columns[n] if isinstance(columns.get(n), pa.Array) else pa.array(columns[n], t) if n in columns else pa.nulls(size, t)
         for n, t in fields], [n for n, _ in fields])


def _lists(values: np.ndarray, owner: np.ndarray, count: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(count + 1)).astype(np.int32)), pa.array(values))


def _ranges(units: list[str], chunk_bytes: int) -> Iterator[tuple[int, int, int, str]]:
    """(low, high, start of the segment, segment) of the byte ranges of a text's units."""
    ends = np.cumsum([len(u.encode()) for u in units])
    starts = np.concatenate([[0], ends[:-1]])
    total = int(ends[-1])
    cuts = np.arange(chunk_bytes, total, chunk_bytes)
    at = np.searchsorted(ends, cuts, "left")  # the unit that a cut falls into, or ends
    cuts = cuts[np.concatenate([[True], at[1:] != at[:-1]])] if cuts.size else cuts
    bounds = [0, *cuts.tolist(), total]
    for low, high in zip(bounds, bounds[1:], strict=False):
        first = int(np.searchsorted(ends, low, "right"))
        last = int(np.searchsorted(ends, high, "left")) + 1
        yield low, high, int(starts[first]), "".join(units[first:last])


class Counts:
    """Documents a pair, summed within a task."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, pairs: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((pairs, counts))
        if len(self.parts) >= 16:
            self.parts = [self.total()]

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, place = np.unique(np.concatenate([p for p, _ in self.parts]), return_inverse=True)
        return pairs, np.bincount(place, np.concatenate([n for _, n in self.parts]), pairs.size).astype(np.int64)


def _linked(owner: np.ndarray, place: np.ndarray, records: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, pair, times) of the units' links, once an owner and pair, in that order."""
    if not owner.size:
        return (np.zeros(0, np.int64),) * 3
    met, often = np.unique(owner * len(records) + place, return_counts=True)
    width = np.array([r[5].size for r in records], np.int64)
    names, code = np.unique(np.concatenate([r[5] for r in records]), return_inverse=True)
    unit = met % len(records)
    each = np.repeat(np.arange(met.size), width[unit])
    inner = np.arange(each.size) - np.repeat(np.cumsum(width[unit]) - width[unit], width[unit])
    source = (np.cumsum(width) - width)[unit][each] + inner
    key, again = np.unique((met // len(records))[each] * names.size + code[source], return_inverse=True)
    times = np.bincount(again, often[each], key.size).astype(np.int64)
    return key // names.size, names[key % names.size], times


def _aligned(own: Aligner, rows: list[int], ids: list[int | None], lists: list[list[str]], counts: Counts) -> pa.RecordBatch:
    """Results and links of the documents with the given units."""
    size = len(lists)
    doc, place, records = own.used(lists)
    missing = np.array([r is None for r in records], bool)
    bad = np.zeros(size, bool)
    bad[doc[missing[place]]] = True
    kept = ~bad[doc]
    doc, place = doc[kept], place[kept]
    filled = [r or (0, 0, 0, 0, "", np.zeros(0, np.int64)) for r in records]
    sums = {name: np.bincount(doc, np.array([r[k] for r in filled], np.int64)[place], size).astype(np.int64) if doc.size else np.zeros(size, np.int64)
            for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
    texts, at, bounds = [r[4] for r in filled], place.tolist(), np.searchsorted(doc, np.arange(size + 1)).tolist()
    hashes = [hashlib.sha256(";".join(map(texts.__getitem__, at[x:y])).encode()).hexdigest() if y > x else ""
              for x, y in zip(bounds, bounds[1:], strict=False)]
    owner, pairs, times = _linked(doc, place, filled)
    counts.add(*np.unique(pairs, return_counts=True))
    return _batch(_PARTS, size, row=rows, doc_id=ids, **{k: pa.array(v) for k, v in sums.items()}, groups_sha256=hashes,
                  pairs=_lists(pairs, owner, size), times=_lists(times, owner, size))


def _first_pass(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int) -> DataFrame:
    """Results and links of texts of one range, ranges of the others, and the tasks' counts of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = aligner(path_a, path_b), Counts()
        for batch in batches:
            column = batch.column(2)
            data, offsets = W.text_arrays(column)
            for a, b in W.chunks(data, offsets):
                regular = regular_texts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]).tolist()
                rows, ids = batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_pylist()
                texts = column.slice(a, b - a).to_pylist()
                lengths = np.diff(offsets[a : b + 1]).tolist()
                lists = [own.units(" " + t, r) if t else [] for t, r in zip(texts, regular, strict=True)]
                short = [i for i, n in enumerate(lengths) if n < chunk_bytes]
                yield _aligned(own, [rows[i] for i in short], [ids[i] for i in short], [lists[i] for i in short], counts)
                for i in set(range(b - a)) - set(short):
                    ranges = list(_ranges(lists[i], chunk_bytes))
                    for k in range(0, len(ranges), 64):
                        some = ranges[k : k + 64]
                        low, high, start, segment = zip(*some, strict=True)
                        yield _batch(_PARTS, len(some), row=[rows[i]] * len(some), doc_id=[ids[i]] * len(some),
                                     chunk=list(range(k, k + len(some))), low=low, high=high, start=start, segment=segment,
                                     regular=[regular[i]] * len(some))
        pairs, n_docs = counts.total()
        for k in range(0, pairs.size, 1 << 16):
            some = slice(k, k + (1 << 16))
            yield _batch(_PARTS, pairs[some].size, pair=pa.array(pairs[some]), n_docs=pa.array(n_docs[some]))

    return docs.mapInArrow(run, _ddl(_PARTS))


# A row is a fragment (chunk not null) or a piece of the text of groups (place not null).
_PIECES = [("row", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int64()), ("first", pa.int64()),
           ("pre_a", pa.list_(pa.int64())), ("pre_b", pa.list_(pa.int64())), ("suf_a", pa.list_(pa.int64())), ("suf_b", pa.list_(pa.int64())),
           ("place", pa.int64()), ("body", pa.string()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
           ("n_links", pa.int64()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())), ("bad", pa.bool_())]


def _state(row: int, doc_id: int | None, chunk: int, f: Fragment) -> dict:
    return {"row": row, "doc_id": doc_id, "chunk": chunk, "first": f.first, "pre_a": f.pre[0], "pre_b": f.pre[1], "suf_a": f.suf[0], "suf_b": f.suf[1]}


def _piece(row: int, doc_id: int | None, place: int, groups: list, n_a: int = 0, n_b: int = 0, bad: bool = False) -> dict:
    links = links_of(groups)
    return {"row": row, "doc_id": doc_id, "place": place, "body": spelled(groups), "n_a": n_a, "n_b": n_b, "n_groups": len(groups),
            "n_links": sum(links.values()), "pairs": list(links), "times": list(links.values()), "bad": bad}


def _as_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in _PIECES], [n for n, _ in _PIECES])


def _ends(own: Aligner, ids: tuple[list[int], list[int]], start: int) -> Iterator[tuple[list[int], np.ndarray]]:
    for own_ids, size in zip(ids, (own.a_size, own.b_size), strict=True):
        yield own_ids, np.cumsum(size[np.array(own_ids, np.int64)]) + start


def _count(own: Aligner, ids: tuple[list[int], list[int]], start: int, low: int, high: int) -> list[int]:
    """How many tokens of A and of B end in the range."""
    return [int(((low < end) & (end <= high)).sum()) for _, end in _ends(own, ids, start)]


def _cut(own: Aligner, chunk: int, ids: tuple[list[int], list[int]], start: int, low: int, high: int, begins: bool
         ) -> tuple[Fragment, list[tuple[list[int], list[int]]]]:
    """Fragment of the tokens of one unit that end in the range."""
    inside: list[list[int]] = []
    for own_ids, end in _ends(own, ids, start):
        some = [(i, e) for i, e in zip(own_ids, end.tolist(), strict=True) if low < e <= high]
        inside += [[i for i, _ in some], [e for _, e in some]]
    return fragment(chunk, *inside, begins)


def _joined(one: dict, other: dict) -> dict:
    """Two neighbouring pieces of a text of groups; a pair may be listed by both."""
    links = Counter(dict(zip(one["pairs"], one["times"], strict=True)))
    links.update(dict(zip(other["pairs"], other["times"], strict=True)))
    return one | {"body": ";".join([x for x in (one["body"], other["body"]) if x]), "pairs": list(links), "times": list(links.values()),
                  **{n: one[n] + other[n] for n in ("n_a", "n_b", "n_groups", "n_links")}}


def _fragments(ranges: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Every range's fragment and the piece of its closed groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            for r in batch.to_pylist():
                units = own.units(r["segment"], r["regular"])
                row, doc_id, chunk, low, high = (r[c] for c in ("row", "doc_id", "chunk", "low", "high"))
                # Units that the range cuts, and its first one, which may close the group before, by their tokens;
                # whole ones between them as they are known.
                stop = len(units) - (r["start"] + len(r["segment"].encode()) > high)
                _, place, records = own.used([units[1:stop]])
                ends = [units[0], *units[max(stop, 1):]]
                found = own.encoded(ends)
                if any(f is None for f in [*found, *records]):
                    yield _as_batch([_state(row, doc_id, chunk, Fragment(((), ()), chunk)),
                                     _piece(row, doc_id, 2 * chunk + 1, [], bad=True)])
                    continue
                state, closed = _cut(own, chunk, found[0], r["start"], low, high, low == 0)
                piece = _piece(row, doc_id, 2 * chunk + 1, closed, *_count(own, found[0], r["start"], low, high))
                if place.size:
                    _, pairs, times = _linked(np.zeros(place.size, np.int64), place, records)
                    middle = {"body": ";".join([records[i][4] for i in place.tolist()]), "pairs": pairs.tolist(), "times": times.tolist(),
                              **{n: int(np.array([x[k] for x in records])[place].sum()) for k, n in enumerate(("n_a", "n_b", "n_groups", "n_links"))}}
                    state, piece = state.then(Fragment(((), ()), chunk))[0], _joined(piece, middle)
                if len(ends) > 1:
                    start = r["start"] + len("".join(units[:stop]).encode())
                    after, closed = _cut(own, chunk, found[1], start, low, high, True)
                    state = state.then(after)[0]
                    piece = _joined(piece, _piece(row, doc_id, 0, closed, *_count(own, found[1], start, low, high)))
                yield _as_batch([_state(row, doc_id, chunk, state), piece])

    dealt = ranges.select("row", "doc_id", "chunk", "low", "high", "start", "segment", "regular").repartition("row", "chunk")
    return dealt.mapInArrow(run, _ddl(_PIECES))


def _reduced(states: DataFrame, fan: int) -> DataFrame:
    """One level of the tree: every `fan` neighbours as one fragment, and the pieces that close between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, None
        for batch in batches:
            out: list[dict] = []
            for r in batch.to_pylist():
                now = Fragment((r["pre_a"], r["pre_b"]), r["first"], (r["suf_a"], r["suf_b"]))
                here = (r["row"], r["doc_id"], r["chunk"] // fan)
                if here != place:
                    if held is not None:
                        out.append(_state(*place, held))
                    place, held = here, now
                    continue
                held, closed = held.then(now)
                if closed is not None and (closed[0] or closed[1]):
                    out.append(_piece(here[0], here[1], 2 * now.first, [closed]))
            if out:
                yield _as_batch(out)
        if held is not None:
            yield _as_batch([_state(*place, held)])

    ordered = states.withColumn("above", F.expr(f"chunk div {fan}")).repartition("row", "above").sortWithinPartitions("row", "chunk")
    return ordered.drop("above").mapInArrow(run, _ddl(_PIECES))


_LONG = [("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
         ("n_links", pa.int64()), ("groups_sha256", pa.string())]


def _in_order(pieces: DataFrame) -> DataFrame:
    """Results of cut texts; the texts of their groups are hashed as streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums, state, bad, begun = None, [0] * 4, None, False, False

        def done() -> tuple:
            return (*now, 0, 0, 0, 0, "") if bad else (*now, *sums, state.hexdigest())

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if now is None or r["row"] != now[0]:
                    if now is not None:
                        out.append(done())
                    now, sums, state, bad, begun = (r["row"], r["doc_id"]), [0] * 4, hashlib.sha256(), False, False
                bad |= r["bad"]
                for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
                    sums[k] += r[name]
                if r["body"]:
                    state.update((";" if begun else "").encode() + r["body"].encode())
                    begun = True
            if out:
                yield _batch(_LONG, len(out), **dict(zip([n for n, _ in _LONG], zip(*out, strict=True), strict=True)))
        if now is not None:
            yield _batch(_LONG, 1, **dict(zip([n for n, _ in _LONG], [[x] for x in done()], strict=True)))

    ordered = pieces.select("row", "doc_id", "place", "body", "n_a", "n_b", "n_groups", "n_links", "bad").repartition("row").sortWithinPartitions("row", "place")
    return ordered.mapInArrow(run, _ddl(_LONG))


def _resolved(links: DataFrame, pairs: DataFrame, top_pairs: int) -> DataFrame:
    """(row, n_best, count_sum) from the links (row, pairs, times) and the pairs (pair, n_docs, best)."""
    # At most top_pairs rows reach the driver and the workers.
    top = pairs.orderBy(F.desc("n_docs"), "pair").limit(top_pairs).collect()
    names = np.array([r["pair"] for r in top], np.int64)
    order = np.argsort(names)
    shared = pairs.sparkSession.sparkContext.broadcast(
        (names[order], np.array([r["n_docs"] for r in top], np.int64)[order], np.array([r["best"] for r in top], bool)[order]))
    fields = [("row", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("pair", pa.int64()), ("times", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n_docs, best = shared.value
        for batch in batches:
            size = len(batch)
            owner = np.repeat(np.arange(size), batch.column(1).value_lengths().to_numpy())
            pair, times = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, pair), max(known.size - 1, 0))
            found = known[at] == pair if known.size else np.zeros(pair.size, bool)
            there, weight = at[found], times[found]
            yield _batch(fields, size, row=batch.column(0),
                         n_best=pa.array(np.bincount(owner[found], weight * best[there], size).astype(np.int64)) if size else [],
                         count_sum=pa.array(np.bincount(owner[found], weight * n_docs[there], size).astype(np.int64)) if size else [])
            if not found.all():
                rows = batch.column(0).to_numpy()[owner[~found]]
                yield _batch(fields, rows.size, row=pa.array(rows), pair=pa.array(pair[~found]), times=pa.array(times[~found]))

    sums = cut_lineage(links.select("row", "pairs", "times").mapInArrow(run, _ddl(fields)), "sums")
    rare = sums.where("pair is not null").select("row", "pair", "times").join(pairs, "pair").select(
        "row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n_docs")).alias("count_sum"))
    return sums.where("pair is null").select("row", "n_best", "count_sum").unionByName(rare).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, *, doc_id: str = "doc_id", text: str = "text",
          chunk_bytes: int = CHUNK_BYTES, top_pairs: int = TOP_PAIRS, fan: int = FAN) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    parts = cut_lineage(_first_pass(rows, tokenizer_a, tokenizer_b, chunk_bytes), "parts")
    sums = ["n_a", "n_b", "n_groups", "n_links"]

    states = cut_lineage(_fragments(parts.where("chunk is not null"), tokenizer_a, tokenizer_b), "fragments")
    pieces = states.where("place is not null")
    most = states.agg(F.max("chunk")).first()[0] or 0
    while most > 0:
        states = cut_lineage(_reduced(states.where("chunk is not null"), fan), "reduced")
        pieces = pieces.unionByName(states.where("place is not null"))
        most //= fan
    long = cut_lineage(_in_order(pieces), "long")
    whole = pieces.join(long.where("n_a > 0").select("row"), "row", "left_semi").where(F.size("pairs") > 0)

    counts = parts.where("pair is not null").select("pair", "n_docs").unionByName(
        whole.select("row", F.explode("pairs").alias("pair")).distinct().groupBy("pair").agg(F.count("*").alias("n_docs")))
    pairs = cut_lineage(counts.groupBy("pair").agg(F.sum("n_docs").alias("n_docs")), "pairs")
    highest = pairs.groupBy(F.shiftright("pair", _SHIFT).alias("a")).agg(F.max("n_docs").alias("highest"))
    pairs = cut_lineage(pairs.withColumn("a", F.shiftright("pair", _SHIFT)).join(highest, "a").select(
        "pair", "n_docs", (F.col("n_docs") == F.col("highest")).alias("best")), "pairs")

    short = parts.where("groups_sha256 is not null")
    links = short.where(F.size("pairs") > 0).select("row", "pairs", "times").unionByName(whole.select("row", "pairs", "times"))
    totals = _resolved(links, pairs, top_pairs)
    names = ["row", "doc_id", *sums, "groups_sha256"]
    both = short.select(*names).unionByName(long.select(*names))
    return both.join(totals, "row", "left").select(
        "doc_id", *sums, F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")

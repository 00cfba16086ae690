"""Line-first quality rules: bad lines go first, then documents that lost too much.

Every line with a word is judged on its own by four rules:

* punctuation: its last character ends a sentence or a clause;
* symbols: at most `max_symbol_share` of its word characters are `#*$%&|<>`, and at most
  `max_shout_share` of its words end in an exclamation mark;
* navigation: fewer than `min_separators` separators stand alone as words;
* boilerplate: it holds none of `PHRASES`.

A line of more than `SHORT_WORDS` words with the end of a sentence before its last word is prose:
neither its last character nor a phrase in it removes it.

Failing lines are removed. A document is kept if it passes the base rules (20 words; at most
30 % of the words in repeated 8-word windows) and at least `min_kept_share` of its words are
in lines that stay.

Fingerprints find the lines and windows that may be repeated; their bytes decide. A line is
compared whole, however long it is, and of equal lines the first is no repeat. A very long text is
judged alone in its task, which holds it and some numbers for each of its bytes.

Null and empty texts have no words and fail the base rules. Repeated rows are judged one by
one, each alike. Other columns of the input are not read. An empty table gives an empty table.
The work is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotcraft.llm import words as W

MIN_WORDS = 20
SHORT_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30

# Marks that may end a line, by their UTF-8 bytes.
ENDINGS = [".", "!", "?", ",", ";", ":", "\"", "'", ")", "]", "…", "”", "’", "»", "。", "！", "？", "؟", "।"]
SENTENCE_ENDS = [".", "!", "?", "…", "。", "！", "？", "؟", "।"]
SEPARATORS = ["|", "»", "›", ">", "·", "•", "::", "/"]
PHRASES = [
    "lorem ipsum", "enable javascript", "javascript is disabled", "accept cookies", "use of cookies",
    "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "skip to content", "click here to", "share on facebook", "subscribe to our newsletter",
]

DIGEST = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, n_lines long, n_lines_removed long, "
    "n_words_kept long"
)


def _flags(values: bytes | list[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


_SYMBOL = _flags(b"#*$%&|<>")


def _marks(values: list[str]) -> dict[int, np.ndarray]:
    """Codes of the marks by their number of bytes."""
    return {n: np.array(sorted({int.from_bytes(v.encode(), "big") for v in values if len(v.encode()) == n}))
            for n in (1, 2, 3)}


_ENDINGS, _SENTENCE_ENDS, _SEPARATORS = _marks(ENDINGS), _marks(SENTENCE_ENDS), _marks(SEPARATORS)
_PHRASES = re.compile("|".join(map(re.escape, PHRASES)).encode())


def _ends_with(data: np.ndarray, end: np.ndarray, marks: dict[int, np.ndarray], size: np.ndarray,
               whole: bool = False) -> np.ndarray:
    """Whether the span of `size` bytes before `end` ends in (or, `whole`, is) one of the marks."""
    out = np.zeros(end.size, bool)
    code = np.zeros(end.size, np.int64)
    for n in (1, 2, 3):
        code += data[np.maximum(end - n, 0)].astype(np.int64) << (8 * (n - 1))
        fits = size == n if whole else size >= n
        out |= fits & np.isin(code, marks[n])
    return out


def _numbered(data: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Numbers of the spans: equal for equal bytes in the same text, and only for them."""
    seen: dict[tuple[int, bytes], int] = {}
    found = [seen.setdefault((i, data[a:b].tobytes()), len(seen))
             for a, b, i in zip(start.tolist(), end.tolist(), text.tolist(), strict=True)]
    return np.array(found, np.int64)


def _equal_windows(data: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray,
                   first: np.ndarray) -> np.ndarray:
    """Those of the windows that begin at the words `first` whose words another one repeats."""
    inside = np.zeros(start.size, bool)
    for k in range(REPEAT_WINDOW):
        inside[first + k] = True
    words = np.flatnonzero(inside)
    number = np.zeros(start.size, np.int64)
    number[words] = _numbered(data, start[words], end[words], text[words])
    rank = np.zeros(first.size, np.int64)
    for k in range(REPEAT_WINDOW):
        rank = np.unique(rank * (words.size + 1) + number[first + k], return_inverse=True)[1]
    return first[np.bincount(rank)[rank] > 1] if first.size else first


def judged(data: np.ndarray, offsets: np.ndarray, max_symbol_share: float, max_shout_share: float,
           min_separators: int, min_kept_share: float) -> tuple[dict[str, np.ndarray], tuple]:
    """Counts and verdicts per text, and (start, end, text, stays) of every line."""
    count = offsets.size - 1
    start, end, text = W.word_spans(data, offsets)
    spans = W.Spans(data)
    n_words = np.bincount(text, minlength=count)

    in_word = np.zeros(data.size + 1, np.int8)
    in_word[start] += 1
    in_word[end] -= 1
    points = W.running((np.cumsum(in_word[:-1]) > 0) & ((data & 0xC0) != 0x80))
    symbols = W.running(_SYMBOL[data])

    repeat_words = np.zeros(count, np.int64)
    if start.size >= REPEAT_WINDOW:
        last = REPEAT_WINDOW - 1
        word = spans.of(start, end)
        window = np.zeros(start.size - last, np.uint64)
        for k in range(REPEAT_WINDOW):
            window = window * np.uint64(0x9FB21C651E98DF25) + word[k : start.size - last + k]
        own = text[: start.size - last]
        window = W.mixed(window + W.mixed(own.astype(np.uint64)))
        whole = np.flatnonzero(own == text[last:])
        twice = _equal_windows(data, start, end, text, whole[W.repeats(window[whole])])
        cover = np.zeros(start.size + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + REPEAT_WINDOW, -1)
        repeat_words = np.bincount(text[np.cumsum(cover[:-1]) > 0], minlength=count)

    l_start, l_end, l_text = W.line_spans(data, offsets)
    words_before = np.searchsorted(start, l_start)
    l_words = np.searchsorted(start, l_end) - words_before
    full = l_words > 0
    key = W.mixed(spans.of(l_start, l_end) + W.mixed(l_text.astype(np.uint64)))[full]
    alike = np.flatnonzero(full)[W.repeats(key)]
    value = _numbered(data, l_start[alike], l_end[alike], l_text[alike])
    again = np.ones(alike.size, bool)
    again[np.unique(value, return_index=True)[1]] = False
    dup_lines = np.bincount(l_text[alike[again]], minlength=count)

    stays = np.ones(l_start.size, bool)
    if start.size:
        shout = W.running(data[end - 1] == 33)
        alone = W.running(_ends_with(data, end, _SEPARATORS, end - start, whole=True))
        a, n = words_before[full], l_words[full]
        last_word = a + n - 1
        chars = points[l_end[full]] - points[l_start[full]]
        marks = symbols[l_end[full]] - symbols[l_start[full]]
        closed = W.running(_ends_with(data, end, _SENTENCE_ENDS, end - start))
        prose = np.zeros(l_start.size, bool)
        prose[full] = (n > SHORT_WORDS) & (closed[last_word] > closed[a])
        good = prose[full] | _ends_with(data, end[last_word], _ENDINGS, end[last_word] - start[last_word])
        good &= marks <= max_symbol_share * chars
        good &= (shout[a + n] - shout[a] <= max_shout_share * n) | (n < 3)
        good &= alone[a + n] - alone[a] < min_separators
        stays[full] = good
        for found in _PHRASES.finditer(W.lowered(data).tobytes()):
            line = np.searchsorted(l_start, found.start(), "right") - 1
            stays[line] &= prose[line] | (found.end() > l_end[line])
    kept_words = np.bincount(l_text, weights=l_words * stays, minlength=count).astype(np.int64)

    base_failed = (n_words < MIN_WORDS) | (100 * repeat_words > MAX_REPEAT_PERCENT * n_words)
    digest = {
        "n_words": n_words, "word_chars": points[offsets[1:]] - points[offsets[:-1]],
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]], "n_dup_lines": dup_lines,
        "n_repeat_words": repeat_words, "base_failed": base_failed,
        "kept": ~base_failed & (kept_words >= min_kept_share * n_words),
        "n_lines": np.bincount(l_text, minlength=count),
        "n_lines_removed": np.bincount(l_text[~stays], minlength=count), "n_words_kept": kept_words,
    }
    return digest, (l_start, l_end, l_text, stays)


def _cleaned(data: np.ndarray, count: int, lines: tuple) -> list[str]:
    start, end, text, stays = lines
    whole = data.tobytes()
    parts: list[list[bytes]] = [[] for _ in range(count)]
    for a, b, i in zip(start[stays].tolist(), end[stays].tolist(), text[stays].tolist(), strict=True):
        parts[i].append(whole[a:b])
    return [b"\n".join(p).decode() for p in parts]


def clean_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", with_text: bool = True,
                max_symbol_share: float = 0.1, max_shout_share: float = 0.3, min_separators: int = 3,
                min_kept_share: float = 0.5) -> DataFrame:
    """Counts, verdict and (`with_text`) the text without its failing lines, one row per row."""
    rules = (max_symbol_share, max_shout_share, min_separators, min_kept_share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_arrays(batch.column(1))
            for a, b in W.chunks(data, offsets):
                own, places = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                digest, lines = judged(own, places, *rules)
                columns = [batch.column(0).slice(a, b - a), *map(pa.array, digest.values())]
                names = ["doc_id", *digest]
                if with_text:
                    columns.append(pa.array(_cleaned(own, b - a, lines), pa.string()))
                    names.append("cleaned_text")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = DIGEST + (", cleaned_text string" if with_text else "")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, *, text: str = "text", n_chars: str = "n_chars",
               max_symbol_share: float = 0.1, max_shout_share: float = 0.3, min_separators: int = 3,
               min_kept_share: float = 0.5) -> DataFrame:
    """The kept rows with all their columns, the text without its failing lines."""
    rules = (max_symbol_share, max_shout_share, min_separators, min_kept_share)
    place = docs.columns.index(text)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_arrays(batch.column(place))
            for a, b in W.chunks(data, offsets):
                own, places = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                digest, lines = judged(own, places, *rules)
                part = batch.slice(a, b - a)
                columns = [part.column(i) for i in range(len(names))]
                fresh = _cleaned(own, b - a, lines)
                columns[place] = pa.array(fresh, pa.string())
                if n_chars in names:
                    at = names.index(n_chars)
                    columns[at] = pa.array([len(t) for t in fresh], pa.int64()).cast(columns[at].type)
                out = pa.RecordBatch.from_arrays(columns, names)
                yield out.filter(pa.array(digest["kept"]))

    return docs.mapInArrow(run, docs.schema)

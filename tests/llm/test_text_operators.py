"""Operators over text, against plain Python on small rows and on the whole small table."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import uuid
import zlib
from collections import Counter
from urllib.parse import urljoin

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lotcraft.llm import (
    bloom_lm, centroid_langid, components, curriculum, quality_lines, simhash_tiles, string_tiling, suffix_index,
    surrogates, token_files, warc_derive,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, component_id string"
LONG = " ".join(f"word{i} filler" for i in range(30000)) + "."
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and then it runs away from all of the hounds again today.\n" * 2, "en", "a"),
    (2, None, "en", None), (3, "", None, "b"), (4, " \n\t ", "de", "b"),
    (5, "one two three", "en", "a"), (5, "one two three", "en", "a"), (None, "eins zwei drei vier fünf", "de", "c"),
    (7, LONG, "en", "a"), (8, LONG + " end", "en", None), (9, "É à # $ 5 | < >", "fr", "c"),
    (10, "word " * 40, "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, len(r[1] or ""), "x", "y") for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    w = words(text)
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed)


def test_quality_counts(docs, table):
    for frame in (docs, table):
        expected = sorted((str(r.doc_id), base(r.text)) for r in frame.collect())
        found = sorted((str(r.doc_id), tuple(r)[1:7]) for r in quality_lines.clean_lines(frame).collect())
        assert found == expected


def test_quality_tells_lines_and_words_that_hash_alike(frame):
    # Sums of powers modulo 2**64 cannot tell this string from its complement, whatever the base.
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    b = a.translate(str.maketrans("ab", "ba"))
    rest = " c d e f g h i"
    texts = [f"{a}\n{b}", f"{a}\n{b}\n{a}\n{b}\n{a}", f"{a}{rest}\n{b}{rest}", f"{a}{rest}\n{b}{rest}\n{a}{rest}"]
    rows = frame("doc_id long, text string", *enumerate(texts))
    found = sorted((r.doc_id, tuple(r)[1:7]) for r in quality_lines.clean_lines(rows).collect())
    assert found == [(i, base(t)) for i, t in enumerate(texts)]
    assert [r[1][3] for r in found] == [0, 3, 0, 1]


def test_quality_lines_go_and_documents_with_them(frame):
    good = "This is a line of quite ordinary words that ends as a sentence should end, with a mark at last here."
    rows = [(1, f"{good}\nHome | About | News | Contact\nAnother line that ends well.", 0), (2, "Home | About | News\n" * 30, 0),
            (3, f"{good}\nWe use of cookies.\n# # # a", 0)]
    kept = quality_lines.keep_clean(frame("doc_id long, text string, n_chars long", *rows)).collect()
    assert [(r.doc_id, r.text) for r in kept] == [(1, f"{good}\nAnother line that ends well."), (3, good)]
    assert kept[1].n_chars == len(good)


def test_quality_keeps_long_prose_lines(frame):
    """One missing end mark, or one phrase, removes a short line but not a line of sentences."""
    prose = "This line has several sentences in it. Each of them ends as it should, with a mark. " * 2
    other = "A second paragraph speaks of something else, with its own words. Our privacy policy is one topic among many others here."
    rows = [(1, prose.strip() + " word"), (2, other), (3, other + "\nHome page and contact\nAll rights reserved."),
            (4, " ".join(f"item{i}" for i in range(40)))]
    got = {r.doc_id: r for r in quality_lines.clean_lines(frame("doc_id long, text string", *rows)).collect()}
    assert got[1].n_lines_removed == 0 and got[1].cleaned_text == rows[0][1]
    assert got[2].kept and got[2].n_lines_removed == 0
    assert got[3].kept and got[3].cleaned_text == other
    assert not got[4].kept and got[4].n_lines_removed == 1


def removed(rows, size):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        marks = bytearray(len(data))
        for p in range(len(data) - size + 1):
            window = data[p : p + size]
            if window in seen:
                marks[p : p + size] = b"\1" * size
            seen.add(window)
        kept = bytes(b for b, m in zip(data, marks, strict=True) if not m)
        spans = sum(m and not (i and marks[i - 1]) for i, m in enumerate(marks))
        out.append((doc, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("settings", [{}, {"most_segments": 1, "bitmap_bytes": 1 << 12, "batches": 5}])
def test_suffix_index_equals_brute_force(frame, table, settings):
    periodic = "ab" * 400
    rows = [(1, periodic), (2, "x" * 300 + periodic), (3, LONG[:900]), (4, LONG[300:1400] + "x" * 120), (5, None), (6, ""),
            (None, LONG[200:350]), (8, "é" * 130), (9, LONG[500:650] + "é" * 60)]
    rows += [(r.doc_id + 100, r.text) for r in table.collect()]
    got = suffix_index.remove_repeats(frame("doc_id long, text string", *rows), with_text=False, **settings).collect()
    assert sorted((tuple(r) for r in got), key=repr) == removed(rows, 100)


def test_suffix_index_rows_with_one_id_keep_their_own_result(docs):
    got = suffix_index.remove_repeats(docs)
    assert got.count() == len(ROWS)
    assert {(r.n_removed, bytes(r.kept).decode()) for r in got.where("doc_id = 5").collect()} == {(0, "one two three")}


def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


@pytest.mark.parametrize("tile_rows", [3, 2048])
def test_simhash_groups_equal_brute_force(docs, table, tile_rows):
    for frame in (docs.where("doc_id is not null"), table):
        rows = [(r.doc_id, fingerprint(r.text)) for r in frame.collect()]
        group = {f: f for _, f in rows}

        def root(f, group=group):
            while group[f] != f:
                f = group[f]
            return f

        fps = sorted(group)
        for i, a in enumerate(fps):
            for b in fps[:i]:
                if (a ^ b).bit_count() <= 4:
                    group[root(a)] = root(b)
        least = {}
        for doc, f in rows:
            least[root(f)] = min(doc, least.get(root(f), doc))
        expected = sorted((doc, f"{f:016x}", least[root(f)]) for doc, f in rows)
        assert sorted(tuple(r) for r in simhash_tiles.near_groups(frame, tile_rows=tile_rows).collect()) == expected


def test_simhash_matches_the_built_in_hash(spark):
    got = spark.sql("select xxhash64('one two three') h").first().h
    assert np.int64(got).view(np.uint64) == fingerprint("one two three") == simhash_tiles.fingerprints_of([b"one two three"])[0]


def test_one_per_group_keeps_one_row(docs):
    kept = simhash_tiles.one_per_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 5 in ids and 2 in ids and not {3, 4} & set(ids)


def test_ids_that_share_a_mark_by_chance_stay(spark):
    # 2048 marks for 600 ids to take out: many of the 3000 others are marked as well.
    texts = [(i, f"text number {i} has its own words {i * 7} and {i * 13} here") for i in range(3000)]
    copies = [(5000 + i, t) for i, t in texts[:600]]
    frame = spark.createDataFrame([*texts, *copies], "doc_id long, text string")
    small = simhash_tiles.one_per_group(frame, bitmap_bytes=256, radius=0)
    large = simhash_tiles.one_per_group(frame, radius=0)
    groups = {r["component_id"] for r in simhash_tiles.near_groups(frame, radius=0).collect()}
    assert sorted(r["doc_id"] for r in small.collect()) == sorted(r["doc_id"] for r in large.collect()) == sorted(groups)


def test_components(frame):
    links = frame("a long, b long", (1, 2), (3, 2), (5, 4), (6, 6), (9, 8), (8, 7), (7, 3), (2, 1), (None, 1))
    assert sorted(map(tuple, components.components(links).collect())) == [
        (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (7, 1), (8, 1), (9, 1)]


def test_curriculum_meets_targets(docs):
    rows = curriculum.mixture(docs).collect()
    assert len(rows) == len(ROWS)
    total = sum(r["size"] for r in rows)
    by_source = Counter()
    for r in rows:
        assert r.taken <= 3 * r["size"] and (r.first_position is None) == (r.taken == 0)
        by_source[(r.source_size, r.target)] += r.taken
    assert all(abs(taken - target) <= 1 for (_, target), taken in by_source.items())
    assert abs(sum(t for _, t in by_source) - total) < 1e-6
    order = curriculum.training_order(docs)
    assert order.columns == docs.columns and order.count() > 0


def test_positions_invert_the_schedule(spark):
    from pyspark.sql import functions as F

    for slope in (-1.0, -0.5, 0.0, 0.7):
        rows = spark.range(101).select("id", curriculum.position(F.col("id"), F.lit(100.0), F.lit(slope)).alias("t")).collect()
        for r in rows[1:]:
            assert math.isclose(r.t + slope * (r.t * r.t - r.t), r.id / 100, abs_tol=1e-9)


def test_tokens_round_trip(docs, table):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    odd = docs.sparkSession.createDataFrame(
        [(i, t) for i, t in enumerate(["a  b\n\n c ", "\n", " lead", "x\ty", "tail\n", "a \n b", "it's <|endoftext|>", "it's <|endoftext|> here", "日本 x",
                                       "a b", "a b", "a\u0085b", "don't I'll\n'll 's"])], "doc_id long, text string")
    for frame in (docs, table, odd):
        expected = []
        for r in frame.collect():
            ids = [*own.encode(r.text or "", add_special_tokens=False).ids, 0]
            expected.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        got = sorted((tuple(r) for r in token_files.round_trip(frame, path).collect()), key=lambda r: r[1])
        assert sorted(((d, n, c) for d, _, n, c in got), key=repr) == sorted(expected, key=repr)
        at = 0
        for _, start, n, _ in got:
            assert start == at
            at += n
        ids = [d for d, _, _, _ in got]
        assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


def test_blocks_of_every_width():
    ranks = np.array([0, 255, 256, 65535, 65536, 1 << 24, 2**31 - 1], np.int64)
    block = token_files.pack(ranks)
    back, used = token_files.unpack(memoryview(block + b"rest"))
    assert back.tolist() == ranks.tolist() and used == len(block)


def test_bloom_model_scores(docs, table):
    for frame in (docs, table):
        rows = [(r.doc_id, [*words(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")), "\n"]) for r in frame.collect()]
        held = {d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
        counts = Counter(t for d, ts in rows if not held[d] for t in ts)
        n, v = sum(counts.values()), len(counts)
        got = bloom_lm.score(frame, filter_bytes=1 << 20, head_tokens=50).collect()
        pairs = zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens)),
                    sorted(rows, key=lambda r: (str(r[0]), len(r[1]))), strict=True)
        for r, (d, ts) in pairs:
            assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (
                len(ts), sum(counts[t] > 0 for t in ts), n, held[d])
            assert math.isclose(r.base_score, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts), rel_tol=1e-9)
            assert r.score < 0


def test_bloom_counts_never_miss(docs, table):
    bits = np.zeros(1 << 20, np.uint8)
    part = bits.size // bloom_lm.SEGMENTS
    for row in bloom_lm.build_filter(table, filter_bytes=1 << 20).collect():
        bits[row.segment * part : (row.segment + 1) * part] = np.frombuffer(row.bits, np.uint8)
    from lotcraft.llm import words as W
    import pyarrow as pa

    texts = [r.text for r in table.collect()]
    hashes, _, _ = bloom_lm._token_hashes(*W.text_arrays(pa.array(texts)))
    unique, true = np.unique(hashes, return_counts=True)
    seen = bloom_lm.BloomCounts(bits, part * 8).of(unique)
    assert (seen >= 0.66 * true).all() and np.mean(seen <= 2 * true) > 0.9


def test_bloom_filter_grows_with_its_entries(table):
    """Twice the different n-grams take about twice the bits, at a fill that stays."""
    from lotcraft.llm import words as W
    import pyarrow as pa

    for frame in (table.limit(20), table):
        hashes, before, _ = bloom_lm._token_hashes(*W.text_arrays(pa.array([r.text for r in frame.collect()])))
        starts = np.full(frame.count(), bloom_lm._START_HASH)
        unique, n = np.unique(np.concatenate([hashes, starts, bloom_lm._pair(before, hashes)]), return_counts=True)
        entries = int((1 + np.floor(np.log2(n))).sum())
        parts = [(r.segment, bytes(r.bits)) for r in bloom_lm.build_filter(frame).collect()]
        model = bloom_lm.BloomCounts.of_parts(parts)
        spare = 64 * len(parts)
        assert bloom_lm.BITS_PER_ENTRY * entries <= 8 * model.bits.size <= bloom_lm.BITS_PER_ENTRY * entries + spare
        assert (model.of(unique) >= 0.66 * n).all()
        absent = np.random.default_rng(1).integers(0, 1 << 64, 200_000, np.uint64)
        assert np.mean(model.levels(absent) > 0) < 0.015


def test_bloom_scores_equal_exact_counts_held_or_dealt(docs, table):
    for frame in (docs, table):
        rows = [(r.doc_id, [*words(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")), "\n"]) for r in frame.collect()]
        held = {d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
        single, pairs = Counter(), Counter()
        for d, ts in rows:
            if not held[d]:
                single.update(["", *ts])
                pairs.update(zip(["", *ts], ts))
        n, v = sum(single.values()) - single[""], len(single) - 1
        level = lambda c: (3 * 2 ** (c.bit_length() - 1) - 1) / 2 if c else 0.0
        exact = {}
        for d, ts in rows:
            exact[(str(d), len(ts))] = sum(
                math.log10((min(level(pairs[u, w]), level(single[u])) + 20 * (level(single[w]) + 0.5) / (n + 0.5 * (v + 1)))
                           / (level(single[u]) + 20)) for u, w in zip(["", *ts], ts))
        got = [sorted(bloom_lm.score(frame, held_bytes=size).collect(), key=lambda r: (str(r.doc_id), r.n_tokens))
               for size in (bloom_lm.HELD_BYTES, 0)]
        assert got[0] == got[1] and len(got[0]) == len(rows)
        off = [abs(r.score - exact[str(r.doc_id), r.n_tokens]) / r.n_tokens for r in got[0]]
        assert np.mean(off) < 0.02, np.mean(off)


def test_languages(spark, docs, table):
    got = {r.doc_id: r for r in centroid_langid.learn_and_identify(table).collect()}
    held = [(r.lang, got[r.doc_id].lang_pred) for r in table.collect() if got[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    small = centroid_langid.learn_and_identify(docs).collect()
    assert {r.doc_id: r.lang_pred for r in small if r.doc_id in (2, 3, 4)} == {2: "und", 3: "und", 4: "und"}
    assert all(0 <= r.score <= 1 for r in small)
    none = centroid_langid.learn_and_identify(docs.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def tiles_by_brute_force(item, text, least):
    """The textbook algorithm: every longest match of unmarked words, in order."""
    free_i, free_t, total = [True] * len(item), [True] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while (i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n]
                       and free_i[i + n] and free_t[j + n]):
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return total
        free_i[i : i + n] = free_t[j : j + n] = [False] * n
        total += n


def test_languages_in_passes_equal_one_pass(frame):
    """Many languages, a few at a time: the same rows, and a rare language is still predicted."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i * 10 + k, " ".join(letters[(i + j) % 26] * 3 for j in (k % 3, 1, 2)) * 4, f"l{i:02}")
            for i in range(23) for k in range(4 if i else 1)]
    table = frame("doc_id long, text string, lang string", *rows)
    model = centroid_langid.fit(table)
    whole = centroid_langid.identify(table, model).collect()
    model.languages_at_once = 4
    assert sorted(centroid_langid.identify(table, model).collect()) == sorted(whole)
    assert {r.lang_pred for r in whole} == {r[2] for r in rows}


def test_tiling_equals_brute_force():
    draw = np.random.default_rng(7)
    for _ in range(60):
        item = draw.integers(0, 4, draw.integers(5, 30)).astype(np.uint64)
        text = np.concatenate([item[10:], draw.integers(0, 4, 8).astype(np.uint64), item[:10]])
        tiles = string_tiling.greedy_tiles(item, text, 5)
        for i, j, n in tiles:
            assert n >= 5 and (item[i : i + n] == text[j : j + n]).all()
        assert sum(t[2] for t in tiles) == tiles_by_brute_force(item.tolist(), text.tolist(), 5)


def test_leaks(frame, docs):
    item = " ".join(f"w{i}" for i in range(40))
    parts = item.split()
    moved = " ".join(["start", *parts[20:], "between", *parts[:20], "end"])
    rows = [(1, moved), (2, " ".join(parts[:20])), (3, item.upper()), (4, None), (5, "other words only"), (6, "short item")]
    items = frame("item_id long, text string", (1, item), (2, None), (3, ""), (4, "Short item"))
    got = string_tiling.leaks(frame("doc_id long, text string", *rows), items)
    assert sorted((r.doc_id, r.item_id, r.covered_words) for r in got.collect()) == [(1, 1, 40), (3, 1, 40), (6, 4, 2)]
    assert sorted(r.doc_id for r in string_tiling.without_leaks(
        frame("doc_id long, text string", *rows), items).collect()) == [2, 4, 5]
    assert string_tiling.without_leaks(docs, items).columns == docs.columns


def test_surrogates_keep_format_and_coreference(frame):
    rows = [(1, "Mr. John Smith and Mrs. Smith wrote to Jo.Doe@mail.example.com and jo.doe@mail.example.com."),
            (2, "Call +1 (499) 555-6503 or +1 499 555 6503, card 4111 1111 1111 1111, host 10.1.2.3."), (3, None), (4, ""),
            (5, 'token = "1eb9c654e721b4f812088970e66a6345cee33dd6" and Г-жа Анна Петрова'), (6, "Nothing here: 12 of 345.")]
    got = {r.doc_id: r for r in surrogates.replace_entities(frame("doc_id long, text string", *rows), "key").collect()}
    assert got[3].text is None and got[4].text == "" and got[6].text == rows[5][1]
    one = re.fullmatch(r"Mr\. (\w+) (\w+) and Mrs\. (\w+) wrote to (\w\w\.\w{3}@\w{4}\.\w{7}\.com) and (\S+)\.", got[1].text)
    assert one and one[2] == one[3] != "Smith" and one[1].lower() in surrogates.GIVEN["given_m_latin"]
    assert one[4].lower() == one[5] and one[4][0].isupper() and one[5] != "jo.doe@mail.example.com"
    two = re.fullmatch(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1 \d{3} \d{3} \d{4}), card ([\d ]{19}), host ([\d.]+)\.", got[2].text)
    assert two and re.sub(r"\D", "", two[1]) == re.sub(r"\D", "", two[2]) != "14995556503"
    digits = [int(c) for c in two[3] if c != " "]
    assert sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    assert re.search(r'"[0-9a-f]{40}" and Г-жа \w+ \w+', got[5].text) and "Петрова" not in got[5].text


def test_surrogates_reach_untitled_mentions_and_other_scripts(frame):
    rows = [(1, "Dr. Anna Weber came. Weber said, WEBER's car; then Anna Weber left. A weber and Webern stay."),
            (2, "Weber and Anna have no title here."),
            (3, "Dr Παπαδόπουλος wrote; Παπαδόπουλος left."),
            (4, "Mail jörg@x.de and Jörg.Müller@bücher.de now, 联系我john@mail.com联系.")]
    got = {r.doc_id: r for r in surrogates.replace_entities(frame("doc_id long, text string", *rows), "key").collect()}
    one = re.fullmatch(r"Dr\. (\w+) (\w+) came\. (\w+) said, (\w+)'s car; then (\w+) (\w+) left\. A weber and Webern stay\.", got[1].text)
    assert one and one[1] == one[5] != "Anna" and one[2] == one[3] == one[6] != "Weber" and one[4] == one[2].upper()
    assert got[1].types == ["name"] * 5 and got[1].n_entities == 5
    assert got[2].text == rows[1][1] and got[2].n_entities == 0
    three = re.fullmatch(r"Dr ([\u0370-\u03ff]+) wrote; ([\u0370-\u03ff]+) left\.", got[3].text)
    assert three and three[1] == three[2] != "Παπαδόπουλος" and three[1][0].isupper() and three[1][1:].islower()
    four = re.fullmatch(r"Mail (\w{4}@\w)\.de and (\w{4}\.\w{6}@\w{6})\.de now, 联系我(\w{4}@\w{4})\.com联系\.", got[4].text)
    assert four and four[1] != "jörg@x" and "ö" != four[1][1] != "o" and four[1].islower() and four[2][0].isupper()
    assert four[3] != "john@mail" and got[4].n_entities == 3


def test_surrogates_are_distinct(spark):
    parts = spark.range(800).selectExpr("'ssn' type", "lpad(cast(id as string), 3, '0') normal").union(
        spark.range(200).selectExpr("'given_m_latin' type", "concat('n', id) normal"))
    got = surrogates.surrogates(parts.where("type <> 'ssn' or normal < '400'"), "key")
    rows = got.collect()
    assert len(rows) == 600 and len({(r.type, r.surrogate) for r in rows}) == 600
    real = {(r.type, r.normal) for r in rows}
    assert not real & {(r.type, r.surrogate) for r in rows}


def test_warc_derivatives(frame):
    page = ('<!DOCTYPE html><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script><p>One <b>two</b><br>'
            'three &lt;4&gt;<!-- no --> <a href="/x?a=1&amp;b=2" title="a>b">link</a> 1 < 2')
    rows = [(1, "http://example.com/p", page), (2, None, None), (3, "http://e.org/\r\nX: y", ""), (1, "http://example.com/p", page)]
    got = warc_derive.build(frame("page_id long, url string, html string, kind string", *((*r, "k") for r in rows))).collect()
    assert len(got) == 2 * len(rows) and all(r.digest_ok for r in got)
    by = {(r.source_id, r.kind): r for r in got}
    meta, text = by[1, "metadata"], by[1, "conversion"]
    assert meta.refers_to == text.refers_to and meta.concurrent_to == text.record_id
    assert meta.title == "A & B" and meta.n_links == 1
    expected = "A & B\nOne two\nthree <4> link 1 < 2"
    assert text.content_length == len(expected) and text.block_digest == warc_derive.digest(expected.encode())
    assert text.source_payload_digest == warc_derive.digest(page.encode())
    assert by[2, "conversion"].target_uri is None and by[2, "conversion"].content_length == 0
    assert by[3, "conversion"].target_uri == "http://e.org/%0D%0AX: y"


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    path = public_tokenizers.path("byte_bpe_50k.json")
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for got in (quality_lines.clean_lines(none), quality_lines.keep_clean(none), suffix_index.remove_repeats(none),
                simhash_tiles.near_groups(none), simhash_tiles.one_per_group(none), curriculum.mixture(none),
                curriculum.training_order(none), bloom_lm.score(none, filter_bytes=1 << 20),
                centroid_langid.learn_and_identify(none), string_tiling.leaks(none, items), string_tiling.leaks(docs, items),
                string_tiling.without_leaks(none, items), surrogates.replace_entities(none, "k"),
                token_files.round_trip(none, path), warc_derive.build(pages)):
        assert got.count() == 0


def test_stages_tell_rows_by_id_and_text(frame):
    leak = " ".join(f"word{i}" for i in range(40))
    rows = [(1, leak), (1, "a clean text under the same id"), (None, leak), (None, "a clean text without an id")]
    docs, items = frame("doc_id long, text string", *rows), frame("item_id long, text string", (1, leak))
    kept = string_tiling.without_leaks(docs, items)
    assert sorted(r.text for r in kept.collect()) == [rows[1][1], rows[3][1]]
    same = frame("doc_id long, text string, n long", (None, leak, 1), (None, leak, 2), (3, leak, 3), (None, "other words", 4), (None, "other words", 5))
    assert sorted(tuple(r) for r in simhash_tiles.one_per_group(same).select("text", "doc_id", "n").collect()) == [
        ("other words", None, 4), (leak, 3, 3)]


def test_mixture_stage_keeps_columns_of_its_own_names(frame):
    docs = frame("doc_id long, source string, text string, target string, source_size int, rank int",
                 (1, "a", "one two three", "x", 7, 1), (2, "b", "four five", "y", 8, 2))
    got = curriculum.training_order(docs)
    assert got.columns == docs.columns and {r.target for r in got.collect()} <= {"x", "y"}
    assert curriculum.mixture(docs).count() == 2


def test_surrogates_of_rare_letters_and_full_spaces(frame):
    letters = "abcdefghijklmnopqrstuvwxyz"
    full = [f"{a}@{b}.co" for a in letters for b in letters]
    rows = [(1, "Dr \U0001d409\U0001d428\U0001d421\U0001d427 came."), (2, " ".join(full)), (3, "\u0130nfo@example.com wrote")]
    got = {r.doc_id: r for r in surrogates.replace_entities(frame("doc_id long, text string", *rows), "k", max_draws=2).collect()}
    assert got[1].n_entities == 1 and got[1].text != rows[0][1]
    new = got[2].text.split(" ")
    assert len(set(new)) == len(full) and not set(new) & set(full) and all(x.endswith(".co") for x in new)
    assert re.fullmatch(r"\S+@[a-z]{7}\.com wrote", got[3].text) and "example" not in got[3].text


def test_long_tags_take_linear_time():
    import time

    began = time.perf_counter()
    warc_derive.parsed("<a " + "x" * 400_000 + ">text")
    assert time.perf_counter() - began < 2
    assert warc_derive._attributes(" href='x' b = \"c d\" e=f/g h") == {"href": "x", "b": "c d", "e": "f/g"}


@given(st.text(alphabet=" \t\n\r\x0b  ab\x00\x7f\x1f"))
def test_blanks_and_header_values_by_their_rules(value):
    assert warc_derive._BLANKS.sub(" ", value) == re.sub(r"[^\S\n]+", " ", value)
    kept = "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)
    assert warc_derive._field(value) == kept


@pytest.mark.parametrize("target", [
    "http://a.b/c/d?q#f", "HTTPS://u:p@A.b:8080", "ftp://h/x", "a/b", "//h/x", "http:", "mailto:x", "http:///x", "http://[::1/x"])
@given(st.one_of(st.from_regex(r"(/\w{1,4}){1,3}", fullmatch=True), st.text(alphabet="/.a:?#;é \n", max_size=8)))
def test_references_resolve_as_the_standard_says(target, reference):
    try:
        expected = urljoin(target, reference)
    except ValueError:
        expected = reference
    assert warc_derive.resolved(target, reference) == expected


def test_warc_ids_and_digests_are_the_standard_ones():
    for block in (b"", b"a", "ü\n".encode() * 99):
        plain = base64.b32encode(hashlib.sha1(block).digest()).decode()
        assert warc_derive.digest(block) == f"sha1:{plain}"
    for parts in (("response", "1", ""), ("", "ü", "\x00")):
        standard = uuid.uuid5(warc_derive._NAMESPACE, chr(0).join(parts))
        assert warc_derive._id(*parts) == f"<urn:uuid:{standard}>"
    assert warc_derive.parsed("a<script><p title='</script>b<style>x</p>") == ("ab", None, [], [])


def test_blocks_look_up_the_lists_of_many_chunks_together(monkeypatch):
    rng = np.random.default_rng(7)
    lists = [rng.integers(0, 1 << 63, size, dtype=np.uint64) for size in (3, 0, 5, 1, 4, 2)]
    sizes = []
    model = bloom_lm.BloomCounts(np.full(1 << 14, 0b10110111, np.uint8), 8)
    expected = [model.levels(own).astype(np.int8).tobytes() for own in lists]
    levels = bloom_lm.BloomCounts.levels

    def counted(self, hashes):
        sizes.append(hashes.size)
        return levels(self, hashes)

    monkeypatch.setattr(bloom_lm.BloomCounts, "levels", counted)
    payloads = [own.tobytes() for own in lists]
    assert list(bloom_lm._levels_of(model, payloads)) == expected and sizes == [15]
    monkeypatch.setattr(bloom_lm, "_LOOKED_UP", 8)
    assert list(bloom_lm._levels_of(model, payloads)) == expected and sizes == [15, 8, 7]
    assert list(bloom_lm._levels_of(model, [])) == []

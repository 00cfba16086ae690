"""Prefix trie, super-k-mers and token alignment against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from lotcraft.llm import prefix_trie, queries, super_kmers, token_align

SF_DIR = "/root/testdata/sf0.001"
PATH_A, PATH_B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TURNS = "conv_id long, turn long, role string, text string, owner string, at long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [turn[2:] for turn in sorted(turns)] for c, turns in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own) if c % 5 == 0 else tuple(convs.get(c - c % 5, [])[:h] + own[h:])
    members, below = defaultdict(set), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
    for path in members:
        if path:
            below[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[p] for p in below[path]) or 1
        saved[path] = sum(saved[p] for p in below[path]) + (
            (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below[p]), leaves[p], saved[p],
                   sha(",".join(map(str, sorted(c for c in m if len(built[c]) == len(p)))))) for p, m in members.items())


@pytest.mark.parametrize("block", [2, 16, 4096])
def test_trie_equals_brute_force(spark, block):
    rng = random.Random(block)
    rows = [(c, t, rng.choice(["user", None]), rng.choice(["a", "bé", "", None]), "x", 1) for c in range(-7, 60) for t in range(rng.randint(1, 14))]
    rows += [(70, t, "user", "same", "x", 1) for t in range(60)] + [(71, t, "user", "same", "x", 1) for t in range(90)]
    rows += [(c, t, "user", "hub", "x", 1) for c in range(100, 180) for t in range(2)]  # exact copies
    rows += [(81, None, "user", "no turn", "x", 1), (81, 0, "user", "a", "x", 1), (None, 0, "user", "a", "x", 1)]
    rows += [(83, 4, "user", "twice", "x", 1)] * 2 + [(93, 0, "user", "absent base", "x", 1)]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS), block=block)
    assert sorted(map(tuple, got.collect())) == trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_trie_query_equals_brute_force(spark):
    rows = list(map(tuple, spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()))
    assert sorted(map(tuple, queries.op11_prefix_trie(spark, SF_DIR).collect())) == trie(rows)


def test_centroids_of_random_trees():
    rng = random.Random(1)
    for size in [*range(1, 40), 900]:
        for shape in (1, 3, size):  # a path, a bush, anything
            parent = [-1] + [rng.randint(max(0, i - shape), i - 1) for i in range(1, size)]
            own = [rng.randint(0, 9) for _ in range(size)]
            total = own[:]
            for v in range(size - 1, 0, -1):
                total[parent[v]] += total[v]
            assert prefix_trie._decompose(parent, [own, [1] * size])[0] == total


def windows(rows, k=50):
    parts = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    order = lambda d: (d is not None, d or 0)
    first = {}
    for d, words in parts:
        for i in range(len(words) - k + 1):
            window = tuple(words[i : i + k])
            first[window] = min(first.get(window, order(d)), order(d))
    out = []
    for d, words in parts:
        gone = set()
        for i in range(len(words) - k + 1):
            if first[tuple(words[i : i + k])] < order(d):
                gone.update(range(i, i + k))
        out.append((d, len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return sorted(out, key=repr)


LINE = " ".join(f"w{i}" for i in range(300))
TEXTS = [(1, "ab " * 400), (2, "x " + "ab " * 400), (None, LINE[:900]), (4, LINE), (4, LINE), (5, LINE + " tail"), (6, None), (7, ""),
         (8, LINE.replace(" ", "\n")), (9, "é " * 120), (10, "é " * 90), (3, LINE[200:]), (11, " \t"), (12, "w1"), (13, "x" * 100_000)]


@pytest.mark.parametrize("most_strings", [1, 4096])
def test_super_kmers_equal_brute_force(spark, most_strings):
    rows = TEXTS + [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, first long")
    got = super_kmers.drop_repeats(frame, most_strings=most_strings)
    assert sorted(map(tuple, got.collect()), key=repr) == windows(rows)


def test_super_kmers_of_nothing(spark):
    assert super_kmers.drop_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_super_kmer_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op12_super_kmers(spark, SF_DIR).collect()), key=repr) == windows(rows)


def alignment(rows):
    """Both libraries on whole texts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_tok, b_tok = Tokenizer.from_file(PATH_A), SentencePieceProcessor(model_file=PATH_B)
    a_tok.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    entry = {i: bytes(byte[c] for c in e) for e, i in a_tok.get_vocab().items()}

    def piece(i):
        return bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()

    found, held = [], Counter()
    for doc, text in rows:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        ends = []
        for parts in ([entry[i] for i in a], [piece(i) for i in b]):
            if b"".join(parts) != (" " + text).encode() if text else True:
                a, b = [], []
            ends.append([sum(map(len, parts[: k + 1])) for k in range(len(parts))] if len(parts) < 2000 else
                        list(__import__("itertools").accumulate(map(len, parts))))
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])) if a else []:
            i2, j2 = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            groups.append((a[i:i2], b[j:j2]))
            i, j = i2, j2
        links = Counter((x, y) for p, q in groups for x in p for y in q)
        held.update(links.keys())
        found.append((doc, len(a), len(b), groups, links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return sorted(
        ((doc, n_a, n_b, len(groups), links.total(), sum(n for k, n in links.items() if held[k] == best[k[0]]),
          sum(n * held[k] for k, n in links.items()),
          sha(";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)) if n_a else "")
         for doc, n_a, n_b, groups, links in found), key=repr)


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a▁b"), (5, "it's <|endoftext|> <s> here"), (6, "x" * 5000), (6, "x" * 5000),
       (None, "日本語 テキスト 𝐉𝐨𝐡𝐧 " * 300), (8, "\n\nlead  two nb  em \r\nq"), (9, "é" * 3000 + " " + "ü ö" * 50),
       (10, "a\x00b \x85 c"), (11, "word " * 3000), (12, "1234567890" * 700 + " 's 't don't\n" * 20), (13, "\nx y"), (14, " a"),
       (15, "ab▁ " + "long " * 4000)]


@pytest.mark.parametrize("settings", [{}, {"chunk_bytes": 64, "top_pairs": 50, "fan": 3}, {"top_pairs": 0}])
def test_alignment_equals_both_libraries(spark, settings):
    rows = ODD + [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60).collect()]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, pair long")
    got = token_align.align(frame, PATH_A, PATH_B, **settings)
    assert sorted(map(tuple, got.collect()), key=repr) == alignment(rows)


def test_alignment_of_nothing(spark):
    assert token_align.align(spark.createDataFrame([], "doc_id long, text string"), PATH_A, PATH_B).count() == 0


def test_alignment_query_equals_both_libraries(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op13_token_align(spark, SF_DIR).collect()), key=repr) == alignment(rows)


def test_fragments_compose_associatively():
    rng = random.Random(5)
    for _ in range(200):
        a_size, b_size = [], []
        while (total := sum(a_size)) < 40:
            a_size.append(min(rng.randint(1, 6), 40 - total))
        while (total := sum(b_size)) < 40:
            b_size.append(min(rng.randint(1, 6), 40 - total))
        a, b = list(range(len(a_size))), list(range(100, 100 + len(b_size)))
        ends = [[sum(s[: k + 1]) for k in range(len(s))] for s in (a_size, b_size)]
        bounds = sorted({0, 40, *rng.sample(range(1, 40), 3)})
        parts = []
        for n, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
            inside = [[[i for i, e in zip(ids, end, strict=True) if low < e <= high], [e for e in end if low < e <= high]]
                      for ids, end in zip((a, b), ends, strict=True)]
            parts.append(token_align.fragment(n, *inside[0], *inside[1], low == 0))

        def fold(order):
            closed = [g for _, own in parts for g in own]
            held = [f for f, _ in parts]
            for k in order:
                k %= len(held) - 1
                held[k : k + 2], group = [(x := held[k].then(held[k + 1]))[0]], x[1]
                closed += [group] if group is not None else []
            return sorted(g for g in closed if g[0] or g[1])

        expected = sorted(token_align.groups_of(a, a_size, b, b_size))
        for order in ([0] * (len(parts) - 1), [len(parts) - 2 - k for k in range(len(parts) - 1)], [rng.randint(0, 9) for _ in parts[1:]]):
            assert fold(order) == expected

"""SimHash near-duplicates by tiled exact comparison.

Each text has a 64-bit fingerprint of its 4-word shingles. Equal fingerprints are grouped
first. The distinct ones are laid out in tiles by the population counts of their four 16-bit
parts, `tile_rows` fingerprints a tile or about; two tiles can hold a pair within the radius
only if their counts differ by no more than the radius in sum, so all other tile pairs are
skipped. The remaining ones are compared whole by exclusive-or and bit counts. A tile pair
hands on a spanning forest of its links, never all of them, and the forests' connected
components are the groups.

Null and empty texts have fingerprint zero, linked like any other. Rows with the same id are
one document if their texts agree, else each has its row under the id. Null ids take part but
never become a component's id unless it has no other. Other columns of the input are not
read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotcraft.llm import bitmap
from lotcraft.llm import words as W
from lotcraft.llm.components import components
from lotcraft.sources.staging import cut_lineage

WIDTH = 4
SEED = 42
RADIUS = 4
PARTS = 4
TILE_ROWS = 2048
BITMAP_BYTES = 8 << 20
_ROWS_AT_ONCE = 64


def fingerprints_of(texts: list[bytes], width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """Unsigned fingerprint of every text: bits set in over half of its shingle hashes."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()  # of bytes: only A-Z, and exactly \x20 and \x09-\x0D
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= width:
            hashes.append(digest(joined, seed))
            sizes[i] = 1
            continue
        end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        first = np.concatenate([[0], end[: -width] + 1]).tolist()
        hashes += [digest(joined[a:b], seed) for a, b in zip(first, end[width - 1 :].tolist(), strict=True)]
        sizes[i] = len(first)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(sizes)
    if full.size:
        values = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        starts = np.cumsum(sizes[full]) - sizes[full]
        counts = np.add.reduceat(np.unpackbits(values, axis=1, bitorder="little"), starts, axis=0, dtype=np.int64)
        majority = 2 * counts > sizes[full][:, None]
        out[full] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(doc_id, code, fp): hash of the text, and the fingerprint as the signed long of the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_arrays(batch.column(2))
            for a, b in W.chunks(data, offsets):
                whole = data[offsets[a] : offsets[b]].tobytes()
                cut = (offsets[a : b + 1] - offsets[a]).tolist()
                fps = fingerprints_of([whole[p:q] for p, q in zip(cut, cut[1:], strict=False)], width, seed)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns[:2]), pa.array(fps.view(np.int64))], ["doc_id", "code", "fp"])

    content = F.col(text).cast("string")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(content).alias("code"), content.alias("text"))
    return source.mapInArrow(run, "doc_id long, code long, fp long")


def _parts(fp) -> list:
    width = 64 // PARTS
    mask = (1 << width) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, width * i).bitwiseAND(F.lit(mask).cast("long"))) for i in range(PARTS)]


def tiles(fps: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Distinct fingerprints in tiles: (cell, sub, subs, p0..p3, fps)."""
    names = [f"p{i}" for i in range(PARTS)]
    placed = fps.select("fp", *(p.alias(n) for p, n in zip(_parts(F.col("fp")), names, strict=True)))
    # A count per cell: at most 17**4 small rows, whatever the input.
    cells = placed.groupBy(*names).agg(F.ceil(F.count("*") / tile_rows).alias("subs"))
    return (placed.join(F.broadcast(cells), names)
            .withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")))
            .groupBy(*names, "sub", "subs").agg(F.sort_array(F.collect_list("fp")).alias("fps")))


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences between part counts that sum to the radius at most, one of each +- pair."""
    found: list[tuple[int, ...]] = [()]
    for _ in range(PARTS):
        found = [(*s, d) for s in found for d in range(-radius, radius + 1)
                 if sum(map(abs, s)) + abs(d) <= radius]
    return [s for s in found if s >= (0,) * PARTS]


def forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all that is within the radius between a and b (or within a)."""
    label = np.arange(a.size + (0 if same else b.size))
    shift = 0 if same else a.size
    left: list[int] = []
    right: list[int] = []
    for top in range(0, a.size, _ROWS_AT_ONCE):
        block = a[top : top + _ROWS_AT_ONCE]
        near = np.bitwise_count(block[:, None] ^ b[None, :]) <= radius
        if same:
            near &= np.arange(b.size)[None, :] > np.arange(top, top + block.size)[:, None]
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            linked = np.flatnonzero(near[i])
            labels = label[linked + shift]
            roots, where = np.unique(labels, return_index=True)
            own = label[top + i]
            other = roots != own
            if other.any():
                left += [top + i] * int(other.sum())
                right += linked[where[other]].tolist()
                label[np.isin(label, roots[other])] = own
    return a[np.array(left, np.int64)], b[np.array(right, np.int64)]


def links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints, as one spanning forest for each tile pair."""
    names = [f"p{i}" for i in range(PARTS)]
    laid = cut_lineage(tiles(fps, tile_rows), "tiles")
    step = F.explode(F.array(*(F.struct(*(F.lit(d).alias(n) for d, n in zip(s, names, strict=True)))
                               for s in _steps(radius))))
    there = [F.col(f"p{i}") + F.col(f"s.p{i}") for i in range(PARTS)]
    left = laid.select(*names, F.col("sub").alias("sub_a"), F.col("fps").alias("a")).withColumn("s", step).select(
        *(t.alias(f"q{i}") for i, t in enumerate(there)), "sub_a", "a",
        (F.expr(" and ".join(f"s.p{i} = 0" for i in range(PARTS)))).alias("same_cell"))
    left = left.where(" and ".join(f"q{i} between 0 and {64 // PARTS}" for i in range(PARTS)))
    right = laid.select(*(F.col(f"p{i}").alias(f"q{i}") for i in range(PARTS)),
                        F.col("sub").alias("sub_b"), F.col("fps").alias("b"))
    # Each tile has become one row for every step: its size on disk says nothing about that.
    pairs = left.join(right.hint("merge"), [f"q{i}" for i in range(PARTS)]).where("not same_cell or sub_a <= sub_b")
    pairs = pairs.select((F.col("same_cell") & (F.col("sub_a") == F.col("sub_b"))).alias("same"), "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for k in (1, 2):
                column = batch.column(k)
                at = column.offsets.to_numpy()
                values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
                sides.append((values, at))
            found = [forest(sides[0][0][sides[0][1][i] : sides[0][1][i + 1]],
                            sides[1][0][sides[1][1][i] : sides[1][1][i + 1]], radius, same)
                     for i, same in enumerate(batch.column(0).to_pylist())]
            if found:
                columns = [pa.array(np.concatenate([f[k] for f in found]).view(np.int64)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _components_of(marked: DataFrame, own: Column, radius: int, tile_rows: int) -> DataFrame:
    """(class, component): every fingerprint with the smallest `own` that links reach."""
    classes = cut_lineage(marked.groupBy("fp").agg(F.min(own).alias("least")), "classes")
    roots = components(links(classes.select("fp"), radius, tile_rows))
    grouped = classes.join(roots, classes.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component"))
    return grouped.select("fp", "root").join(least, "root").select(F.col("fp").alias("class"), "component")


def near_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                seed: int = SEED, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row: the smallest id that links reach."""
    marked = cut_lineage(fingerprints(docs, doc_id, text, width, seed).drop("code"), "fingerprints")
    of_class = _components_of(marked, F.col("doc_id"), radius, tile_rows)
    return marked.join(of_class, F.col("fp") == F.col("class")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def _marked_in(spark: SparkSession, ids: DataFrame, bitmap_bytes: int):
    """Column function: whether an id may be in `ids`; it never misses one that is."""
    shared = spark.sparkContext.broadcast(bitmap.build(ids.select(F.xxhash64("__id")), bitmap_bytes))

    @F.pandas_udf("boolean")
    def marked(hashes: pd.Series) -> pd.Series:
        return pd.Series(bitmap.contains(shared.value, hashes.to_numpy(np.int64).view(np.uint64)))

    return lambda own: own.isNotNull() & marked(F.xxhash64(own))


def one_per_group(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, seed: int = SEED,
                  radius: int = RADIUS, tile_rows: int = TILE_ROWS, bitmap_bytes: int = BITMAP_BYTES) -> DataFrame:
    """One row of each group: the one with the smallest id, nulls last, then with the smallest hash of its text.

    A row is told apart by a 64-bit hash of its id and text. The hashes to take out are marked in a
    bitmap of a fixed size. Rows that are not marked stay where they are; hashes that share a mark by
    chance are found by an exact join of hashes alone, and only their rows are joined. Of rows equal
    in id and text, the least by the other columns stays.
    """
    own = F.xxhash64(F.col(doc_id).cast("long"), F.xxhash64(F.col(text).cast("string")))
    rows = cut_lineage(fingerprints(docs, doc_id, text, width, seed), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "code")
    groups = rows.join(_components_of(rows, order, radius, tile_rows), F.col("fp") == F.col("class")).select(
        F.xxhash64("doc_id", "code").alias("__id"), F.xxhash64("component.doc_id", "component.code").alias("__first"))
    groups = cut_lineage(groups, "groups")
    others = groups.where("__id <> __first").select("__id").distinct()
    marked = _marked_in(docs.sparkSession, others, bitmap_bytes)
    by_chance = groups.select("__id").where(marked(F.col("__id"))).distinct()
    spared = cut_lineage(by_chance.join(others, "__id", "left_anti"), "spared")
    own_id = own == F.col("__id")
    kept = docs.where(~marked(own))
    if not spared.isEmpty():
        kept = kept.unionByName(docs.where(marked(own)).join(spared, own_id, "left_semi"))
    twice = cut_lineage(groups.where("__id = __first").groupBy("__id").agg(
        F.count("*").alias("__rows")).where("__rows > 1").select("__id"), "twice")
    if twice.isEmpty():
        return kept
    again = kept.join(twice, own_id, "left_semi").groupBy(F.col(doc_id).cast("long"), F.col(text)).agg(
        F.min(F.struct(*(F.col(c) for c in docs.columns))).alias("r"))
    return kept.join(twice, own_id, "left_anti").unionByName(
        again.select(*(F.col(f"r.{c}") for c in docs.columns)))

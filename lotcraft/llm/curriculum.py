"""Mix sources to target weights along a curriculum that changes over the training run.

Sources in code-point order, null last, weigh `weights`, repeating. Their targets share the
words of the whole corpus by weight; a target stops at `max_passes` times its source's size and
the excess is shared again until none is above. A source's documents follow each other in the
order of a hash of their ids, in up to `max_passes` passes, until the target is met; of the
document at the target, only the words up to it are taken.

A source's intensity over training time t in [0, 1] is 1 + a(2t - 1) with the source's slope a
from `slopes`, repeating. Its integral t + a(t*t - t) is the part of the target demanded until
t; the place of a document in its source's stream, as part of the target, is inverted through
it, which gives the document's training position. Documents are range-sorted by it.

Only built-in functions are used. A source may hold any part of the rows: running sums go over
`BUCKETS` hash ranges of each source first, then inside a range. Null texts have size 0 and
null ids order first. Rows with the same id follow each other by size; equal rows share
what they take in an arbitrary but equal way. Other columns pass `training_order` untouched.
An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotcraft.sources.staging import cut_lineage

WEIGHTS = (1, 2, 3)
SLOPES = (-0.5, 0.0, 0.5)
MAX_PASSES = 3
# The first three digits of a hexadecimal hash.
BUCKETS = 4096

_KEYS = ["__no_source", "__source", "__bucket"]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _with_keys(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    order = F.coalesce(F.md5(F.col(doc_id).cast("string")), F.lit("000"))
    return docs.withColumns({
        "__size": n_words(F.col(text).cast("string")), "__order": order, "__bucket": F.substring(order, 1, 3),
        "__source": F.coalesce(F.col(source).cast("string"), F.lit("")), "__no_source": F.col(source).isNull(),
    })


def _cycled(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (rank % len(values) + 1).cast("int"))


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """(__no_source, __source, source_size, weight, slope rank, target), one row per source.

    The windows run over one row per source. With sources in ascending order of cap over
    weight, the level at which the rest shares what the capped ones leave rises until the
    first source that stays below its cap and falls after it, so the level is the largest.
    """
    sources = sized.groupBy("__no_source", "__source").agg(F.sum("__size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("__no_source", "__source")) - 1
    sources = sources.withColumn("rank", rank).withColumn("weight", _cycled(weights, F.col("rank")))
    sources = sources.withColumn("cap", max_passes * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.sum("cap").over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("cap")
    share = F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levelled = sources.withColumn("level", left.cast("double") / share)
    level = F.max("level").over(everything)
    return levelled.select(
        "__no_source", "__source", "rank", "source_size",
        F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


def _streamed(rows: DataFrame, sized: DataFrame, weights: tuple, slopes: tuple, max_passes: int) -> DataFrame:
    """`rows` with __source_size, __target, __slope and the words of the source before each row."""
    targets = source_targets(sized, weights, max_passes).withColumnsRenamed(
        {"source_size": "__source_size", "target": "__target"})
    ranges = sized.groupBy(*_KEYS).agg(F.sum("__size").alias("__range"))
    before = F.sum("__range").over(Window.partitionBy("__no_source", "__source").orderBy("__bucket")) - F.col("__range")
    ranges = ranges.withColumn("__start", before).join(targets, ["__no_source", "__source"])
    ranges = ranges.withColumn("__slope", _cycled(slopes, F.col("rank")))
    inside = Window.partitionBy(*_KEYS).orderBy("__order", "__size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(ranges.select(*_KEYS, "__start", "__slope", "__source_size", "__target"), _KEYS)
    return joined.withColumn(
        "__offset", F.col("__start") + F.sum("__size").over(inside) - F.col("__size"))


def position(offset: Column, target: Column, slope: Column) -> Column:
    """Training time at which a source has demanded `offset` of its `target` words."""
    part = F.try_divide(offset.cast("double"), target)  # null for a source without words
    return 2 * part / ((1 - slope) + F.sqrt((1 - slope) * (1 - slope) + 4 * slope * part))


def _taken(pass_number: int) -> Column:
    rest = F.floor("__target") - pass_number * F.col("__source_size") - F.col("__offset")
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("__size"), rest))


def mixture(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text",
            weights: tuple = WEIGHTS, slopes: tuple = SLOPES, max_passes: int = MAX_PASSES) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_position), one row per row.

    `first_position` is null where nothing is taken. Rows are in the order of their positions.
    """
    sized = cut_lineage(_with_keys(docs, doc_id, source, text).select(
        F.col(doc_id).cast("long").alias("doc_id"), "__size", "__order", *_KEYS), "sizes")
    streamed = _streamed(sized, sized, weights, slopes, max_passes)
    taken = sum((_taken(p) for p in range(1, max_passes)), _taken(0))
    out = streamed.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                          F.col("__target").alias("target"), taken.alias("taken"),
                          position(F.col("__offset"), F.col("__target"), F.col("__slope")).alias("__position"))
    out = out.withColumn("first_position", F.when(F.col("taken") > 0, F.col("__position"))).drop("__position")
    return out.orderBy("first_position", "doc_id")


def training_order(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                   weights: tuple = WEIGHTS, slopes: tuple = SLOPES, max_passes: int = MAX_PASSES) -> DataFrame:
    """The documents as often as they are taken, in the order of training.

    Documents stay whole: a last pass that takes less than half of one leaves it out. Wordless
    documents take nothing and are left out.
    """
    keyed = _with_keys(docs, doc_id, source, text)
    sized = cut_lineage(keyed.select("__size", *_KEYS), "sizes")
    streamed = _streamed(keyed, sized, weights, slopes, max_passes)
    passes = F.array(*(F.struct(
        _taken(p).alias("words"),
        position(F.col("__offset") + p * F.col("__source_size"), F.col("__target"), F.col("__slope")).alias("at"))
        for p in range(max_passes)))
    used = F.filter(passes, lambda p: (p["words"] > 0) & (2 * p["words"] >= F.col("__size")))
    placed = streamed.select(*(F.col(c) for c in docs.columns), F.explode(used).alias("__pass"))
    return placed.orderBy("__pass.at", doc_id).select(*docs.columns)


MIXTURE_SQL = """
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS o,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size
  FROM {documents}
), by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, rank % 3 + 1 AS weight, 3 * source_size AS cap, (rank % 3 - 1) * CAST(0.5 AS DOUBLE) AS slope
  FROM by_source
), levelled AS (
  SELECT *, CAST(CAST(sum(source_size) OVER () - sum(cap) OVER w + cap AS BIGINT) AS DOUBLE)
              / CAST(sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank
                                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM weighed WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, rank
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), targets AS (
  SELECT *, least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target FROM levelled
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.slope,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS BIGINT) AS off
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, CAST(off AS DOUBLE) / target AS part,
         greatest(0, least(size, CAST(floor(target) AS BIGINT) - off))
       + greatest(0, least(size, CAST(floor(target) AS BIGINT) - source_size - off))
       + greatest(0, least(size, CAST(floor(target) AS BIGINT) - 2 * source_size - off)) AS taken
  FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN
         2 * part / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * part)) END AS first_position
FROM taken
"""

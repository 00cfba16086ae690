"""Trie of conversation prefixes, rolled up by centroid decomposition.

Conversations share their first turns with conversation c - c % 5 and are rebuilt from it; each
distinct sequence of first turns is a node, the child of the sequence one turn shorter.

1. A turn is the SHA-256 of its role and text; texts do not move. Positions are a distributed
   running count, prefixes a running exclusive-or of the turns salted with their positions, in
   blocks of a conversation. 120 bits name a prefix.
2. A node is named by its smallest member and its depth. Its weight is the number of turns of all
   members from it on, so that weights fall along a path and a parent weighs at least as much
   as its children together.
3. `rollup` sums values over subtrees. Components are split recursively. Runs of nodes whose
   weights are in the same multiple of `block` are components of at most 2 * `block` nodes: light
   subtrees, and between them stretches of a path, as two children never share a heavy
   parent's multiple. Component totals are aggregated, the forest of the heavy components, about
   `block` times smaller, is rolled up the same way, and the total of a component is added where it
   hangs in the one above.
4. Within a component, its centroid (the deepest node with at least half of the nodes below it)
   takes its total, which is added to the nodes on the path to the component's top; the
   centroid's children and the rest are the next components.

Null roles and texts are empty. Turns with the same number are ordered by their hash; repeated
rows are turns of their own. Rows without conv_id are left out, as they belong to no
conversation. c % 5 is not negative, and a negative conv_id's decimal has its sign. A conversation
of any length is a path like any other. Other columns are not read. An empty table has no
conversations and no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotcraft.functions.grouping import attach_lookup
from lotcraft.functions.scan import running_totals
from lotcraft.sources.staging import cut_lineage

GROUP = 5
HEAD = 9  # a conversation takes fewer turns than this from the first of its group
BLOCK = 4096
_STRETCH = 1024
_IDS_AT_ONCE = 4096
_NODE = ["owner", "at"]


def _stretches(length: str) -> Column:
    """Numbers of the stretches of `length` turns, at least one turn."""
    return F.expr(f"sequence(0L, ({length} - 1) div {_STRETCH}L)")


def _digests(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, row, hi, lo, bytes) of every row with a conversation."""
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what), 256)
    half = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    rows = turns.where(F.col(conv_id).try_cast("long").isNotNull()).select(
        F.col(conv_id).try_cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.octet_length(what).cast("long").alias("bytes"), digest.alias("digest"),
        F.monotonically_increasing_id().alias("row"))
    return rows.select("conv", "turn", "row", half(1).alias("hi"), half(16).alias("lo"), "bytes")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv, pos, hi, lo, bytes) of rebuilt conversations, and (conv, length) of each."""
    placed = cut_lineage(running_totals(
        turns, ["conv"], [F.col("turn").asc_nulls_first(), F.col("hi"), F.col("lo"), F.col("row")],
        {"pos": F.lit(1)}).select("conv", "pos", "hi", "lo", "bytes"), "turns")
    sizes = placed.groupBy("conv").agg(F.count("*").alias("own"))
    first = F.col("conv") - F.pmod("conv", F.lit(GROUP))
    head = (F.crc32(F.col("conv").cast("string")) % HEAD).cast("long")
    sizes = cut_lineage(sizes.select("conv", "own", first.alias("base"), head.alias("head")), "sizes")
    bases = sizes.where("conv = base").select("base", F.col("own").alias("base_own"))
    taken = F.when(F.col("conv") == F.col("base"), 0).otherwise(
        F.least("head", F.coalesce("base_own", F.lit(0))))
    skipped = F.when(F.col("conv") == F.col("base"), 0).otherwise(F.col("head"))
    plan = cut_lineage(sizes.join(bases, "base", "left").select(
        "conv", "base", "own", taken.alias("taken"), skipped.alias("skipped")), "plan")
    length = F.col("taken") + F.greatest(F.col("own") - F.col("skipped"), F.lit(0))
    lengths = plan.select("conv", length.alias("length"))

    # One row a conversation and stretch of turns: no conversation's turns meet in one key.
    stretch = F.expr(f"(pos - 1) div {_STRETCH}")
    shifts = plan.select(
        "conv", "taken", "skipped",
        F.explode(_stretches("own")).alias("stretch"))
    own = placed.withColumn("stretch", stretch).join(shifts, ["conv", "stretch"]).where("pos > skipped").select(
        "conv", (F.col("pos") - F.col("skipped") + F.col("taken")).alias("pos"), "hi", "lo", "bytes")
    heads = placed.where((F.col("pos") < HEAD) & (F.pmod("conv", F.lit(GROUP)) == 0)).withColumnRenamed("conv", "base")
    lent = heads.join(plan.where("taken > 0").select("conv", "base", "taken"), "base").where("pos <= taken")
    return own.unionByName(lent.select("conv", "pos", "hi", "lo", "bytes")), lengths


def _prefixes(rows: DataFrame) -> DataFrame:
    """Rows (conv, depth, hi, lo, bytes) with the code of the whole prefix."""
    salted = cut_lineage(rows.select(
        "conv", "pos", F.expr(f"(pos - 1) div {_STRETCH}").alias("stretch"), "bytes",
        F.xxhash64("pos", "hi", "lo").alias("hi"), F.xxhash64("lo", "pos", "hi").alias("lo")), "salted")
    inside = (Window.partitionBy("conv", "stretch").orderBy("pos")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    local = salted.withColumns({c: F.bit_xor(c).over(inside) for c in ("hi", "lo")})
    # One row for every 1024 turns of a conversation.
    whole = salted.groupBy("conv", "stretch").agg(F.bit_xor("hi").alias("hi"), F.bit_xor("lo").alias("lo"))
    before = whole.select("conv", "stretch", *[
        F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("hi", "lo")])
    return local.join(before, ["conv", "stretch"]).select(
        "conv", F.col("pos").alias("depth"), "bytes",
        *[F.col(c).bitwiseXOR(F.col(f"{c}_before")).alias(c) for c in ("hi", "lo")])


def _decompose(parent: list[int], values: list[list[float]]) -> list[list[float]]:
    """Sums over subtrees of one tree, whose nodes come parents first; -1 is above the top."""
    count = len(parent)
    totals = [[0] * count for _ in values]
    size, label = [0] * count, [0] * count
    waiting = [list(range(count))]
    while waiting:
        nodes = waiting.pop()
        top = nodes[0]
        for v in nodes:
            size[v], label[v] = 1, -1
        for v in reversed(nodes):
            if v != top:
                size[parent[v]] += size[v]
        half = len(nodes)
        centroid = next(v for v in reversed(nodes) if 2 * size[v] >= half)
        label[centroid] = centroid
        parts: dict[int, list[int]] = {}
        rest: list[int] = []
        for v in nodes:
            if v == centroid:
                continue
            above = label[parent[v]] if v != top else -1
            if above == -1:
                rest.append(v)
            else:
                label[v] = v if above == centroid else above
                parts.setdefault(label[v], []).append(v)
        path = []
        if centroid != top:
            v = parent[centroid]
            while v != top:
                path.append(v)
                v = parent[v]
            path.append(top)
        for own, total in zip(values, totals, strict=True):
            # The component's part of the subtree: what was cut off below before is on this path already.
            found = own[centroid] + sum([own[v] for part in parts.values() for v in part])
            total[centroid] += found
            for v in path:
                total[v] += found
        if rest:
            waiting.append(rest)
        waiting.extend(parts.values())
    return totals


def _within(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """(owner, at, *names): sums over the subtree of every node within its component."""

    def solve(rows: list[tuple]) -> list[tuple]:
        index = {row[2:4]: i for i, row in enumerate(rows)}
        parent = [-1] + [index[row[4:6]] for row in rows[1:]]
        totals = _decompose(parent, [[row[6 + k] for row in rows] for k in range(len(names))])
        return [(*row[2:4], *[t[i] for t in totals]) for i, row in enumerate(rows)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [*_NODE, *names])

        held: list[tuple] = []
        done: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[0][:2] != row[:2]:
                    done += solve(held)
                    held = []
                    if len(done) >= 1 << 14:
                        yield out(done)
                        done = []
                held.append(row)
        if held:
            done += solve(held)
        if done:
            yield out(done)

    label = ["top_owner", "top_at"]
    ordered = nodes.select(*label, *_NODE, "p_owner", "p_at", *names).repartition(*label).sortWithinPartitions(*label, "at")
    return ordered.mapInArrow(run, ", ".join(f"{c} long" for c in [*_NODE, *names]))


def rollup(paths: DataFrame, nodes: DataFrame, names: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(owner, at, *names): the sums of `names`, longs, over the subtree of every node of a forest.

    `nodes` has (owner, at, weight, p_owner, p_at, p_weight, *names): a node is named by a path
    that goes through it and a number that grows along the path; p_* is its parent, null above
    a top. A weight is at least 1, falls strictly from parent to child, and is no less than those
    of the children together. `paths` has (path, owner, at, weight): all nodes on every path that
    names a node, and may have other paths.
    """
    names = list(names)
    part = F.expr(f"weight div {block}")
    # The highest node of each path's run: one row a path and multiple.
    tops = cut_lineage(paths.groupBy("path", part.alias("part")).agg(F.min(F.struct(F.col("at"), F.col("owner"))).alias("top"))
                       .select("path", "part", F.col("top.owner").alias("top_owner"), F.col("top.at").alias("top_at")), "tops")
    own_part, up_part = part.alias("part"), F.expr(f"p_weight div {block}").alias("p_part")
    labelled = nodes.select("*", own_part, up_part, F.col("owner").alias("path")).join(tops, ["path", "part"]).drop("path")
    labelled = cut_lineage(labelled, "labelled")
    heads = labelled.where("owner = top_owner and at = top_at")
    sums = labelled.groupBy("top_owner", "top_at").agg(*[F.sum(c).alias(c) for c in names])
    above = tops.select(F.col("path").alias("owner"), F.col("part").alias("p_part"),
                        F.col("top_owner").alias("up_owner"), F.col("top_at").alias("up_at"))
    components = cut_lineage(
        heads.select("top_owner", "top_at", "owner", "p_owner", "p_at", "part", "p_part")
        .join(above, ["owner", "p_part"], "left").drop("owner").join(sums, ["top_owner", "top_at"]), "components")
    light = components.where("part = 0")
    full = light.select("p_owner", "p_at", *names)
    heavy = components.where("part > 0")
    if not heavy.isEmpty():
        hung = light.where("up_owner is not null").groupBy("up_owner", "up_at").agg(
            *[F.sum(c).alias(f"hung_{c}") for c in names])
        upper = heavy.select(
            F.col("top_owner").alias("owner"), F.col("top_at").alias("at"), F.col("part").alias("weight"),
            F.col("up_owner").alias("p_owner"), F.col("up_at").alias("p_at"), F.col("p_part").alias("p_weight"), *names)
        upper = upper.join(hung.withColumnsRenamed({"up_owner": "owner", "up_at": "at"}), _NODE, "left").select(
            *[c for c in upper.columns if c not in names],
            *[(F.col(c) + F.coalesce(f"hung_{c}", F.lit(0))).alias(c) for c in names])
        naming = upper.select(F.col("owner").alias("path")).distinct()
        upper_paths = tops.where("part > 0").join(naming, "path", "left_semi").select(
            "path", F.col("top_owner").alias("owner"), F.col("top_at").alias("at"), F.col("part").alias("weight"))
        found = rollup(upper_paths, cut_lineage(upper, "upper"), names, block)
        places = heavy.select(F.col("top_owner").alias("owner"), F.col("top_at").alias("at"), "p_owner", "p_at")
        full = full.unionByName(places.join(found, _NODE).select("p_owner", "p_at", *names))
    hanging = full.where("p_owner is not null").groupBy("p_owner", "p_at").agg(
        *[F.sum(c).alias(f"hung_{c}") for c in names]).withColumnsRenamed({"p_owner": "owner", "p_at": "at"})
    # Components that share the node above them hang there; those within a component are its edges.
    laden = labelled.join(hanging, _NODE, "left").select(
        "top_owner", "top_at", *_NODE, "p_owner", "p_at",
        *[(F.col(c) + F.coalesce(f"hung_{c}", F.lit(0))).alias(c) for c in names])
    return cut_lineage(_within(laden, names), "rolled")


def _ends(ends: DataFrame) -> DataFrame:
    """(owner, at, ends_sha256) of (owner, at, conv): ids of a node are joined range by range, then hashed as a stream."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids = None, None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([node[0]]), pa.array([node[1]]), pa.array([first]), pa.array([",".join(ids)])],
                [*_NODE, "first", "ids"])

        for batch in batches:
            for *place, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if ids and (place != node or len(ids) >= _IDS_AT_ONCE):
                    yield row()
                    ids = []
                if not ids:
                    node, first = place, conv
                ids.append(str(conv))
        if ids:
            yield row()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for *place, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if place == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = place, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], [*_NODE, "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([node[0]]), pa.array([node[1]]), pa.array([state.hexdigest()])], [*_NODE, "ends_sha256"])

    ordered = ends.select(*_NODE, "conv").repartitionByRange(*_NODE, "conv").sortWithinPartitions(*_NODE, "conv")
    texts = ordered.mapInArrow(join, "owner long, at long, first long, ids string")
    streams = texts.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return streams.mapInArrow(digest, "owner long, at long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row a node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    `n_leaves` and `saved_tokens` are sums over the node's subtree.
    """
    rows, lengths = _rebuilt(cut_lineage(_digests(conversations, conv_id, turn, role, text), "digests"))
    lengths = cut_lineage(lengths, "lengths")
    stretches = lengths.where("length > 0").select(
        "conv", "length", F.explode(_stretches("length")).alias("stretch"))
    steps = cut_lineage(
        _prefixes(rows).withColumn("stretch", F.expr(f"(depth - 1) div {_STRETCH}")).join(stretches, ["conv", "stretch"])
        .select("conv", "depth", "hi", "lo", "bytes", (F.col("length") - F.col("depth")).alias("left")), "steps")

    key = ["depth", "hi", "lo"]
    nodes = steps.groupBy(*key).agg(
        F.min("conv").alias("owner"), F.count("*").alias("n_convs"), F.sum(F.col("left") + 1).alias("weight"))
    # Copies of a turn are read by many conversations: the join may split such a node's rows.
    placed = cut_lineage(attach_lookup(steps, nodes, key).select(
        F.col("conv").alias("path"), "owner", F.col("depth").alias("at"), "weight", "n_convs", "bytes", "left"), "paths")
    own = placed.where("path = owner")
    above = placed.select("path", (F.col("at") + 1).alias("at"), F.col("owner").alias("p_owner"), F.col("weight").alias("p_weight"))
    linked = cut_lineage(
        own.join(above, ["path", "at"], "left").drop("path", "left").withColumn("p_at", F.when(F.col("p_owner").isNotNull(), F.col("at") - 1)),
        "nodes")
    children = linked.where("p_owner is not null").groupBy("p_owner", "p_at").agg(F.count("*").alias("n_children")) \
        .withColumnsRenamed({"p_owner": "owner", "p_at": "at"})
    valued = cut_lineage(linked.join(children, _NODE, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)),
        "n_leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}), "valued")
    sums = ["n_leaves", "saved_tokens"]
    totals = rollup(placed.select("path", "owner", "at", "weight"),
                    valued.select(*_NODE, "weight", "p_owner", "p_at", "p_weight", *sums), sums, block)

    # Two numbers of the whole table: the root's name and size.
    least, n_convs = lengths.agg(F.min("conv"), F.count("*")).first()
    zero, root_id = F.lit(0).cast("long"), F.lit(least).cast("long")
    ended = placed.where("left = 0").select(*_NODE, F.col("path").alias("conv"))
    turnless = lengths.where("length = 0").select(root_id.alias("owner"), zero.alias("at"), "conv")
    hashes = cut_lineage(_ends(ended.unionByName(turnless)), "ends")

    below = valued.drop(*sums).join(totals, _NODE)
    tops = valued.where("at = 1").select(*_NODE).join(totals, _NODE).agg(
        F.count("*").alias("n_children"), *[F.sum(c).alias(c) for c in sums])
    root = tops.where(F.lit(n_convs > 0)).select(
        root_id.alias("owner"), zero.alias("at"), F.lit(None).cast("long").alias("p_owner"),
        F.lit(n_convs).cast("long").alias("n_convs"), "n_children",
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"))
    tree = below.select(
        *_NODE, F.coalesce("p_owner", root_id).alias("p_owner"), "n_convs", "n_children", *sums).unionByName(root)
    none = hashlib.sha256(b"").hexdigest()
    return tree.join(hashes, _NODE, "left").select(
        F.col("owner").alias("conv_id"), F.col("at").alias("depth"), F.col("p_owner").alias("parent_conv_id"),
        "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


# The checksum of a decimal, byte by byte and bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda letter: CAST(ascii(letter) AS BIGINT))),
    lambda code, letter: list_reduce(list_concat([xor(code, letter)], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda rest, bit: xor(rest >> 1, (rest & 1) * 3988292384))))"""
TRIE_SQL = f"""
    WITH turns AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
               sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS code,
               strlen(coalesce(text, '')) AS bytes
        FROM {{conversations}} WHERE conv_id IS NOT NULL),
    sizes AS (
        SELECT conv_id, conv_id - (conv_id % 5 + 5) % 5 AS base, {_CRC} % 9 AS head, count(*) AS own
        FROM turns GROUP BY conv_id),
    plan AS (
        SELECT s.conv_id, s.base, CASE WHEN s.conv_id = s.base THEN 0 ELSE s.head END AS skipped,
               CASE WHEN s.conv_id = s.base THEN 0 ELSE least(s.head, coalesce(b.own, 0)) END AS taken
        FROM sizes s LEFT JOIN sizes b ON b.conv_id = s.base),
    rebuilt AS (
        SELECT p.conv_id, pos, code, bytes FROM plan p JOIN turns t ON t.conv_id = p.base WHERE pos <= taken
        UNION ALL
        SELECT p.conv_id, pos - skipped + taken, code, bytes FROM plan p JOIN turns t USING (conv_id) WHERE pos > skipped),
    paths AS (
        SELECT conv_id, pos AS depth, bytes, string_agg(code, '') OVER w AS path, lead(pos) OVER w IS NULL AS ends
        FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        UNION ALL
        SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM plan),
    nodes AS (
        SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM paths GROUP BY path, depth),
    edges AS (SELECT path, left(path, 64 * (depth - 1)) AS above FROM nodes WHERE depth > 0),
    children AS (SELECT above AS path, count(*) AS n_children FROM edges GROUP BY above),
    sums AS (
        SELECT left(n.path, 64 * up) AS path, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
        FROM nodes n LEFT JOIN children c USING (path), unnest(range(0, depth + 1)) AS ups(up) GROUP BY ALL)
    SELECT n.conv_id, n.depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
           CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums USING (path) LEFT JOIN children USING (path)
    LEFT JOIN edges e USING (path) LEFT JOIN nodes a ON a.path = e.above"""

"""Mixing sources to target weights.

Targets are weighted shares of all words, limited to a multiple of each source (water-filling).
A source's words are taken in whole passes over its documents plus one partial pass. Documents are
dealt to permuted blocks by a hash; the partial pass takes blocks in hash order, and the block that
crosses the target is split again, level by level, so no step sorts or gathers a whole source. The
pass then goes on in hash order behind the document that crossed, over those that still fit. A
multivariate-hypergeometric splitting tree divides each source's exact block quota among the output
shards, and every shard shuffles its rows by another hash. Last, single documents are taken in addition or
left out once, as long as one brings a source nearer to its target.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import cut, unused

WEIGHTS = (1, 2, 3)
LIMIT = 3
SHARDS = 16
#: Bits of the hash that number a source's blocks on each level: 1024 blocks, three levels.
DIGIT = 10
LEVELS = 3
#: Share of a target within which a source's words are near enough to move no more documents, half a word at least.
NEAR = 1e-4
#: Bytes up to which a table of sources or blocks is broadcast; beyond, it joins by a shuffle.
BROADCAST_BYTES = 32 << 20


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target) of each source, from rows (source, size).

    Sources in code-point order, null last, weigh ``weights`` in turn. Target shares stop at ``limit``
    times a source's size and the excess goes to the others by weight. The table has one row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source: these windows see sources, never documents
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighted = sums.withColumn("weight", F.element_at(turn, ((place - 1) % len(weights) + 1).cast("int")))
    cap = F.lit(float(limit)) * F.col("source_size")
    every = Window.partitionBy()
    before = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    ranked = weighted.withColumn("capped", cap / F.col("weight") <= level)
    free = F.when(~F.col("capped"), F.col("weight"))
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum(F.when(F.col("capped"), cap)).over(every), F.lit(0.0))
    target = F.when(F.col("capped"), cap).otherwise(rest * F.try_divide(F.col("weight"), F.sum(free).over(every)))
    return ranked.select("source", "source_size", target.alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards x sources) block counts: every column adds up to its quota, all shards are alike in size.

    A binary tree over the shards: at each node the left half's blocks are one multivariate
    hypergeometric draw from the node's, so the counts are those of a uniform deal without replacement.
    """
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    stack = [(0, shards, quotas.astype(np.int64))]
    while stack:
        first, n, counts = stack.pop()
        if n == 1:
            out[first] = counts
            continue
        half = n // 2
        size = int(counts.sum() * half // n)
        # "marginals" draws source by source, whatever the total
        left = rng.multivariate_hypergeometric(counts, size, method="marginals") if counts.sum() else counts
        stack += [(first + half, n - half, counts - left), (first, half, left)]
    return out


def _sent(df: DataFrame, few: bool | None = None) -> DataFrame:
    """``df`` marked for a broadcast if its rows, as text, have at most BROADCAST_BYTES; ``few`` says so beforehand."""
    if few is None:
        few = (df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0) <= BROADCAST_BYTES
    return F.broadcast(df) if few else df


def _order(docs: DataFrame, seed: int) -> Column:
    """The hash that orders a source's documents: of the id, or of the text of a row without one."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.lit(seed))).otherwise(F.xxhash64("doc_id", F.lit(seed)))


def _digit(order: Column, level: int) -> Column:
    return F.shiftrightunsigned(order, 64 - DIGIT * (level + 1)).bitwiseAND(F.lit((1 << DIGIT) - 1)).cast("int")


def _boundaries(rows: DataFrame, plan: DataFrame, few: bool) -> DataFrame:
    """For each source the path of digits at which its partial pass crosses what remains to take.

    ``rows`` has key, size and the digits of the order; ``plan`` has key and part, the words that the partial pass needs.
    Gives key, digits d0, d1, d2 and gap, the words missing before the crossing cell. All tables here
    have at most 1024 rows per source.
    """
    path: list[str] = []
    state = plan.select("key", F.col("part").alias("gap"))
    for level in range(LEVELS):
        inside = rows if not path else rows.join(_sent(state.select("key", *path), few), ["key", *path], "left_semi")
        cells = inside.groupBy("key", *path, f"d{level}").agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("key").orderBy(f"d{level}").rowsBetween(Window.unboundedPreceding, 0)
        crossing = (
            cells.withColumn("upto", F.sum("words").over(upto))
            .join(state.select("key", "gap"), "key")
            .where((F.col("upto") > F.col("gap")) & (F.col("words") > 0))
            .groupBy("key", "gap", *path)
            .agg(F.min_by(F.struct(f"d{level}", (F.col("upto") - F.col("words")).alias("before")), f"d{level}").alias("cell"))
            .select("key", *path, F.col(f"cell.d{level}"), (F.col("gap") - F.col("cell.before")).alias("gap"))
        )
        path.append(f"d{level}")
        state = cut(crossing)
    return state


def _place(order: Column) -> Column:
    """The digits of all levels as one number."""
    return F.shiftrightunsigned(order, 64 - DIGIT * LEVELS)


def _in_runs(runs: str, place: Column, size: Column) -> Column:
    return F.exists(runs, lambda r: (place > r["after"]) & (place < r["before"]) & (size > 0) & (size <= r["fit"]))


def _fill(rows: DataFrame, edge: DataFrame, few: bool) -> tuple[DataFrame, DataFrame]:
    """(key, runs) and (key, gap): what fills each source's gap behind its crossing cell, and what stays open.

    A run takes the documents with places between after and before and at most fit words. Each ends
    at the cell that crosses the gap; the next goes on behind it with the documents that fit what is
    then missing, until none is left. The state is one row per source.
    """
    spark = rows.sparkSession
    base = 1 << DIGIT
    runs: dict[str, list[tuple[int, int, float]]] = {}
    gaps: dict[str, float] = {}
    state = {}
    for r in edge.collect():
        gaps[r["key"]], runs[r["key"]] = r["gap"], []
        state[r["key"]] = (r["d0"] * base + r["d1"]) * base + r["d2"]
    starts = dict(state)
    while state := {k: at for k, at in state.items() if gaps[k] >= 1}:
        now = spark.createDataFrame([(k, at, float(gaps[k])) for k, at in state.items()], "key string, at bigint, part double")
        behind = rows.join(_sent(now, few), "key").where("place > at and size > 0 and size <= part").drop("at", "part")
        words = {r["key"]: r["words"] for r in behind.groupBy("key").agg(F.sum("size").alias("words")).collect()}
        over = {k for k, n in words.items() if n > gaps[k]}
        crossed = _boundaries(behind, now.where(F.col("key").isin(list(over))), few).collect() if over else []
        ends = {r["key"]: ((r["d0"] * base + r["d1"]) * base + r["d2"], r["gap"]) for r in crossed}
        for k, n in words.items():
            at, left = ends.get(k, (base**LEVELS, gaps[k] - n))
            runs[k].append((state[k], at, float(gaps[k])))
            gaps[k] = left
        state = {k: at for k, (at, _) in ends.items()}
    # a source without a run still says where it was crossed
    listed = [(k, r or [(starts[k], starts[k], 0.0)]) for k, r in runs.items()]
    return (
        spark.createDataFrame(listed, "key string, runs array<struct<after: bigint, before: bigint, fit: double>>"),
        spark.createDataFrame([(k, float(g)) for k, g in gaps.items()], "key string, gap double"),
    )


def _nearest(rows: DataFrame, gaps: dict[str, float], tried: dict[str, list[int]], limit: int, few: bool) -> dict[str, tuple[int, int]]:
    """For each source the order and size of the document that could move and comes closest to its gap."""
    state = rows.sparkSession.createDataFrame([(k, float(g), tried[k]) for k, g in sorted(gaps.items())], "key string, gap double, tried array<bigint>")
    # a document that is taken as often as it may be can only be left out, one that isn't taken only added
    movable = F.when(F.col("gap") > 0, ~F.col("taken") & (F.col("passes") < limit)).otherwise(F.col("taken") | (F.col("passes") > 0))
    near = rows.join(_sent(state, few), "key").where((F.col("size") > 0) & movable & ~F.array_contains("tried", F.col("order")))
    off = F.struct(F.abs(F.col("size") - F.abs("gap")), F.col("order"))
    return {r["key"]: (r["m"]["order"], r["m"]["size"]) for r in near.groupBy("key").agg(F.min_by(F.struct("order", "size"), off).alias("m")).collect()}


def _corrected(rows: DataFrame, gap: DataFrame, limit: int, few: bool) -> DataFrame:
    """(key, adds, drops): the orders of the documents to take once more or once less, so that gaps close.

    ``rows`` has key, order, size, taken (by the partial pass) and passes. Each round looks, for all sources
    at once, for the document whose size is closest to what is missing or too much, and for the one
    that then makes up best for the difference; one of them or both move if that brings the sum nearer to the
    target, else the source is done, as it is within NEAR. A document moves at most once. ``gap`` and the state
    have one row per source.
    """
    spark = rows.sparkSession
    found = gap.select("key", "gap", "target").collect()
    gaps, near = {r["key"]: float(r["gap"]) for r in found}, {r["key"]: max(0.5, NEAR * r["target"]) for r in found}
    tried: dict[str, list[int]] = {k: [] for k in gaps}
    moves: dict[str, tuple[list[int], list[int]]] = {k: ([], []) for k in gaps}
    active = {k for k, g in gaps.items() if abs(g) >= near[k]}
    while active:
        one = _nearest(rows, {k: gaps[k] for k in active}, tried, limit, few)
        for k, (order, _) in one.items():
            tried[k].append(order)
        after = {k: gaps[k] - (size if gaps[k] > 0 else -size) for k, (_, size) in one.items()}
        two = _nearest(rows, {k: g for k, g in after.items() if g and g * gaps[k] < 0}, tried, limit, few)
        chosen = [(k, order) for step in (one, two) for k, (order, _) in step.items()]
        # rows alike in the order move together
        found = rows.join(_sent(spark.createDataFrame(chosen, "key string, order bigint"), few), ["key", "order"]).groupBy("key", "order").agg(F.sum("size"))
        whole = {(k, order): size for k, order, size in found.collect()} if chosen else {}
        active = set()
        for k, (order, _) in one.items():
            add = gaps[k] > 0
            options = [(gaps[k] - (whole[k, order] if add else -whole[k, order]), ((order, add),))]
            if k in two:
                other = two[k][0]
                options.append((options[0][0] + (whole[k, other] if add else -whole[k, other]), ((order, add), (other, not add))))
            left, taken = min(options, key=lambda o: abs(o[0]))
            if abs(left) < abs(gaps[k]):
                gaps[k] = left
                tried[k] = [*tried[k][:-1], *(o for o, _ in taken)]
                for o, added in taken:
                    moves[k][not added].append(o)
                if abs(left) >= near[k]:
                    active.add(k)
    return spark.createDataFrame([(k, a, d) for k, (a, d) in sorted(moves.items())], "key string, adds array<bigint>, drops array<bigint>")


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = 17, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``docs`` with one more column, the last, named mix (with underscores if taken).

    It holds size, source_size, target, and shards: the output shard of each copy that the mix takes,
    an empty list for none. A document is taken at most ``limit`` times. Sizes count words; a null text has
    none. Each source's taken words come within NEAR of its target, or in the end no document that could be taken or left
    out once more, closest to the difference, brings them nearer, nor does it with the one that then
    fits best. A null source is a
    source. Ties in the hash (repeated ids; equal texts without an id) are taken together. Columns may have any names.
    Equal input gives equal output at any partitioning.
    Rows stay where they are: only sums by source and block are shuffled.
    """
    name = unused("mix", docs)
    order = _order(docs, seed)
    key = F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce(F.col("source").cast("string"), F.lit("")))
    digits = [f"d{k}" for k in range(LEVELS)]
    parts = [_digit(order, k).alias(d) for k, d in enumerate(digits)]
    rows = cut(docs.select(key.alias("key"), "source", order.alias("order"), _place(order).alias("place"), *parts, n_words(F.col("text")).alias("size")))
    part = F.col("target") - F.col("passes") * F.col("source_size")
    plan = cut(
        targets(rows, weights, limit)
        .withColumn("key", key)
        .withColumn("passes", F.least(F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)), F.lit(limit)).cast("int"))
        .withColumn("part", part)
    )
    # the tables below have a row per source, each with a few numbers more than this one
    few = (plan.agg(F.sum(F.octet_length("key") + 200)).first()[0] or 0) <= BROADCAST_BYTES
    edge = _boundaries(rows, plan, few)
    # the words before the crossing cell are taken; documents behind it fill the gap
    runs, gap = _fill(rows, edge, few)
    # what the passes take, for the single documents that are moved last
    crossed = edge.drop("gap").withColumnsRenamed({d: f"c{d}" for d in digits})
    before = F.struct(*digits) < F.struct(*[f"c{d}" for d in digits])
    passed = (
        rows.join(_sent(plan.select("key", "passes").join(crossed, "key", "left").join(runs, "key", "left"), few), "key")
        .withColumn("taken", F.coalesce(before, F.lit(False)) | F.coalesce(_in_runs("runs", F.col("place"), F.col("size")), F.lit(False)))
        .select("key", "order", "size", "taken", "passes")
    )
    moved = _corrected(cut(passed), gap.join(plan.select("key", "target"), "key"), limit, few)
    sources = cut(plan.join(edge.drop("gap"), "key", "left").join(runs, "key", "left").join(moved, "key", "left"))
    blocks = _blocks(rows, sources, shards, seed)
    found = F.struct("source_size", "target", "passes", *digits, "runs", "adds", "drops", "homes").alias("b")
    used = _sent(blocks.select("key", "block", found))
    # the documents travel as one column, so their names cannot clash with the ones used here
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key.alias("key"), order.alias("order"), n_words(F.col("text")).alias("size")
    )
    joined = whole.withColumn("block", _digit(F.col("order"), 0)).join(used, ["key", "block"])
    here = F.struct(*[_digit(F.col("order"), k).alias(d) for k, d in enumerate(digits)])
    cross = F.struct(*[F.col("b")[d].alias(d) for d in digits])
    part_taken = F.when(F.col("b.d0").isNull(), F.lit(False)).otherwise(here < cross)
    filled = F.coalesce(_in_runs("b.runs", _place(F.col("order")), F.col("size")), F.lit(False))
    has = lambda c: F.coalesce(F.array_contains(f"b.{c}", F.col("order")), F.lit(False)).cast("int")
    copies = F.col("b.passes") + (part_taken | filled).cast("int") + has("adds") - has("drops")
    result = F.struct(
        "size",
        F.col("b.source_size").alias("source_size"),
        F.col("b.target").alias("target"),
        F.slice(F.col("b.homes"), 1, copies).alias("shards"),
    )
    return joined.select("doc", result.alias("result")).select("doc.*", F.col("result").alias(name))


def _blocks(rows: DataFrame, sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """The sources' columns by (key, block), with homes: the shard of each pass over the block."""
    found = rows.select("key", F.col("d0").alias("block")).distinct()
    # blocks of a pass: all for whole passes; up to the crossing block for the partial one
    passes = (
        found.join(sources, "key")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), "passes")))
        .withColumn("drawn", (F.col("pass") < F.col("passes")) | F.coalesce(F.col("block") <= F.col("d0"), F.lit(False)))
        .withColumn("deal", F.xxhash64("key", "block", "pass", F.lit(seed + 1)))
    )
    passes = cut(passes.select("key", "block", "pass", "drawn", "deal"))
    quotas = passes.where("drawn").groupBy("key").count().orderBy("key").collect()  # a row per source
    spark = rows.sparkSession
    if quotas:
        dealt = split_quotas(np.array([q["count"] for q in quotas]), shards, seed).cumsum(axis=0)
        ends = spark.createDataFrame([(q["key"], dealt[:, k].tolist()) for k, q in enumerate(quotas)], "key string, ends array<bigint>")
    else:
        ends = spark.createDataFrame([], "key string, ends array<bigint>")
    turn = F.row_number().over(Window.partitionBy("key", "drawn").orderBy("deal", "block", "pass"))
    home = F.when(
        F.col("drawn"), F.size(F.filter("ends", lambda e: e < F.col("turn")))
    ).otherwise(F.pmod("deal", F.lit(shards)).cast("int"))
    placed = passes.withColumn("turn", turn).join(ends, "key", "left").withColumn("home", home.cast("int"))
    homes = placed.groupBy("key", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pass", "home"))), lambda x: x["home"]).alias("homes")
    )
    return cut(homes.join(sources, "key"))


def spread(mixed: DataFrame, column: str = "mix", seed: int = 17) -> DataFrame:
    """One row per taken copy, with columns shard and copy, dealt to a partition per shard and shuffled there."""
    rows = mixed.select("*", F.posexplode(f"{column}.shards").alias("copy", "shard")).drop(column)
    return rows.repartition("shard").sortWithinPartitions("shard", F.xxhash64("doc_id", "copy", F.lit(seed + 2)))

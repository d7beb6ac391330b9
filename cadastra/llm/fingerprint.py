"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame functions only.

A text's units are its lines, cut at sentence ends; each has a 64-bit digest. A sketch hashes every
digest to one cell of each of several subtables; a cell holds a count and the xor of digests and of
check values. Subtracting two sketches cancels what the texts share, and peeling cells with a single
digest recovers the digests in which they differ. Two texts are first compared by their fingerprints,
which are such sketches of BASE cells in each subtable. Where these do not peel to the end, larger
sketches follow: cut into groups by digest, of a size that a min-wise estimate of the difference
suggests; groups that fail again are tried with more cells (Eppstein et al., 2011).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import cut, stored

UNIT_END = r"\n+|(?<=[.!?])\x20+"
SUBTABLES = 3
#: Cells of each subtable: of the fingerprint itself, and of a group when a difference is peeled.
BASE = 8
CELLS = 5
#: Differing digests that a group is sized for, and the size of the min-wise sample.
EXPECTED = 2
SAMPLE = 16
_CHECK = 77


def digests(text: Column) -> Column:
    """Distinct digests of a text's units; empty and null texts have none."""
    units = F.filter(F.split(F.coalesce(text, F.lit("")), UNIT_END), lambda x: F.trim(x) != "")
    return F.array_distinct(F.transform(units, lambda x: F.xxhash64(x)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(_CHECK)).bitwiseAND(F.lit(0xFFFFFFFF))


def _cell(digest: Column, table: Column, salt: Column, cells: Column) -> Column:
    """The digest's cell in a subtable; cells of subtables follow each other."""
    return (F.pmod(F.xxhash64(digest, table, salt), cells) + table * cells).cast("int")


def _cells(rows: DataFrame, keys: list[str], cells: Column) -> DataFrame:
    """Cells (n, k, c) that are not all zero, from rows (keys, digest, sign, salt).

    ``keys`` begin with the columns by which ``rows`` is partitioned already, so there is no shuffle.
    """
    spread = rows.withColumn("table", F.explode(F.array(*[F.lit(j) for j in range(SUBTABLES)])))
    return (
        spread.withColumn("cell", _cell(F.col("digest"), F.col("table"), F.col("salt"), cells))
        .groupBy(*keys, "cell")
        .agg(F.sum("sign").alias("n"), F.bit_xor("digest").alias("k"), F.bit_xor(_check(F.col("digest"))).alias("c"))
        .where("n <> 0 or k <> 0 or c <> 0")
    )


def _pure(cell: Column) -> Column:
    return (F.abs(cell["n"]) == 1) & (cell["c"] == _check(cell["k"]))


def _peel(cells: Column, salt: Column, width: Column) -> Column:
    """struct(left, plus, minus): cells that stay, and how many digests of either sign were recovered."""
    start = F.struct(cells.alias("left"), F.lit(0).alias("plus"), F.lit(0).alias("minus"))

    def take(state: Column, pure: Column) -> Column:
        def without(cell: Column) -> Column:
            return F.when(
                F.array_contains(pure["places"], cell["cell"]),
                F.struct(
                    cell["cell"].alias("cell"),
                    (cell["n"] - pure["n"]).alias("n"),
                    cell["k"].bitwiseXOR(pure["k"]).alias("k"),
                    cell["c"].bitwiseXOR(pure["c"]).alias("c"),
                ),
            ).otherwise(cell)

        left = F.filter(F.transform(state["left"], without), lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["c"] != 0))
        return F.struct(
            left.alias("left"),
            (state["plus"] + (pure["n"] > 0).cast("int")).alias("plus"),
            (state["minus"] + (pure["n"] < 0).cast("int")).alias("minus"),
        )

    def step(state: Column, _: Column) -> Column:
        pure = F.slice(F.filter(state["left"], _pure), 1, 1)
        # one-element arrays bind the cell and its places to variables, so that they are computed once
        places = lambda k: F.array(*[_cell(k, F.lit(j), salt, width) for j in range(SUBTABLES)])
        placed = F.transform(pure, lambda p: F.struct(p["n"].alias("n"), p["k"].alias("k"), p["c"].alias("c"), places(p["k"]).alias("places")))
        return F.coalesce(F.get(F.transform(placed, lambda p: take(state, p)), 0), state)

    # each step empties a cell, so there are no more steps than cells
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(cells), F.lit(1))), start, step)


def _difference(rows: DataFrame, keys: list[str], width: int, salt: int) -> DataFrame:
    """Peel the sketches of one round. rows: keys, digest, sign.

    Gives (key, pair, plus, minus, failed): the digests recovered, and the groups that did not peel to
    the end. ``rows`` should be partitioned by the first of the keys, so that nothing is shuffled.
    """
    cells = _cells(rows.withColumn("salt", F.lit(salt)), keys, F.lit(width))
    grouped = cells.groupBy(*keys).agg(F.collect_list(F.struct("cell", "n", "k", "c")).alias("cells"))
    peeled = grouped.select(*keys, _peel(F.col("cells"), F.lit(salt), F.lit(width)).alias("p"))
    done = F.size("p.left") == 0
    return peeled.groupBy(*keys[:-1]).agg(
        F.sum(F.when(done, F.col("p.plus")).otherwise(0)).alias("plus"),
        F.sum(F.when(done, F.col("p.minus")).otherwise(0)).alias("minus"),
        F.collect_list(F.when(~done, F.col(keys[-1]))).alias("failed"),
    )


def _subtracted(a: Column, b: Column) -> Column:
    """The cells of sketch a minus sketch b, without those that are all zero. A sketch names a cell once."""
    both = F.array_sort(F.concat(a, F.transform(b, lambda c: F.struct(c["cell"].alias("cell"), (-c["n"]).alias("n"), c["k"].alias("k"), c["c"].alias("c")))))

    def merged(ordered: Column) -> Column:
        def at(cell: Column, i: Column) -> Column:
            after = F.get(ordered, i + 1)
            joint = F.struct(
                cell["cell"].alias("cell"),
                (cell["n"] + after["n"]).alias("n"),
                cell["k"].bitwiseXOR(after["k"]).alias("k"),
                cell["c"].bitwiseXOR(after["c"]).alias("c"),
            )
            second = (i > 0) & (F.get(ordered, i - 1)["cell"] == cell["cell"])
            return F.when(F.coalesce(second, F.lit(False)), None).when(F.coalesce(after["cell"] == cell["cell"], F.lit(False)), joint).otherwise(cell)

        return F.filter(F.transform(ordered, at), lambda c: c.isNotNull() & ((c["n"] != 0) | (c["k"] != 0) | (c["c"] != 0)))

    return F.get(F.transform(F.array(both), merged), 0)


def _compared(a: Column, b: Column) -> Column:
    """struct(left, plus, minus) of two fingerprints; a difference without a single digest anywhere isn't peeled."""
    def one(cells: Column) -> Column:
        whole = F.struct(cells.alias("left"), F.lit(0).alias("plus"), F.lit(0).alias("minus"))
        return F.when(F.exists(cells, _pure), _peel(cells, F.lit(0), F.lit(BASE))).otherwise(whole)

    return F.get(F.transform(F.array(_subtracted(a, b)), one), 0)


def _likeness(size_a: Column, plus: Column, minus: Column) -> Column:
    """Jaccard likeness from the first sketch's size and the difference; two empty sketches are alike."""
    union = size_a + minus
    return F.when(union == 0, 1.0).otherwise((size_a - plus) / union)


def _groups(a: Column, b: Column) -> Column:
    """Into how many groups a comparison's digests are cut, by a min-wise estimate of the difference."""
    least = lambda c: F.slice(F.array_sort(c), 1, SAMPLE)
    sample = F.slice(F.array_sort(F.array_union(least(a), least(b))), 1, SAMPLE)
    shared = F.size(F.array_intersect(F.array_intersect(sample, least(a)), least(b)))
    share = F.when(F.size(sample) == 0, 1.0).otherwise(shared / F.size(sample))
    expected = (1 - share) / (1 + share) * (F.size(a) + F.size(b)) + 1
    return F.ceil(expected / EXPECTED).cast("int")


def _differences(rows: DataFrame, dealt: DataFrame, key: str, pairs: list[tuple[str, str, str, str]]) -> DataFrame:
    """(key, pair, plus, minus): sizes of a - b and b - a for each pair of digest columns, by sketches.

    ``pairs`` has the names of a, b, the column with the number of groups and the one that says whether
    the pair is still open; both must be plain columns of ``rows`` so that they aren't computed again
    for every digest. ``dealt`` holds the same rows partitioned by ``key``; the sketches are then made
    and peeled where they are. The few groups that fail are taken from ``rows`` again, before anything
    is exploded.
    """

    def signed(pair: int, digests_: str, sign: int, groups: str, wanted: str) -> Column:
        units = F.transform(
            digests_,
            lambda x: F.struct(
                F.lit(pair).alias("pair"), x.alias("digest"), F.lit(sign).alias("sign"), F.pmod(x, F.col(groups)).cast("int").alias("group")
            ),
        )
        return F.when(F.col(wanted), units).otherwise(F.slice(units, 1, 0))

    units = F.concat(*[p for k, (a, b, g, o) in enumerate(pairs) for p in (signed(k, a, 1, g, o), signed(k, b, -1, g, o))])
    keys = [key, "pair", "group"]
    first = dealt.select(key, F.explode(units).alias("u")).select(key, "u.*")
    results, width, salt = [cut(_difference(first, keys, CELLS, 1))], CELLS, 1
    while results[-1].where(F.size("failed") > 0).limit(1).count():
        width, salt = width * 2, salt + 1
        wanted = F.map_from_entries(F.collect_list(F.struct("pair", "failed"))).alias("wanted")
        failed = results[-1].where(F.size("failed") > 0).groupBy(key).agg(wanted)
        left = F.filter(units, lambda u: F.array_contains(F.coalesce(F.col("wanted")[u["pair"]], F.array().cast("array<int>")), u["group"]))
        again = rows.join(failed, key).select(key, F.explode(left).alias("u")).select(key, "u.*")
        results.append(cut(_difference(again, keys, width, salt)))
    return reduce(DataFrame.union, results).groupBy(key, "pair").agg(F.sum("plus").alias("plus"), F.sum("minus").alias("minus"))


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(9))


def successors(docs: DataFrame) -> DataFrame:
    """(key, n_chars, before, before_chars) of each different document (doc_id, text).

    before is the key of the document that precedes it in descending doc_id (nulls last); the first
    follows the last. The order comes from a range partitioning: neighbours within a partition by a
    window, across partitions by a table with one row per partition.
    """
    rows = docs.select("doc_id", _row_key().alias("key"), F.char_length(F.coalesce("text", F.lit(""))).alias("n_chars")).distinct()
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    ranged = cut(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    here = F.struct("key", "n_chars")
    # the last row of a partition in this order, whatever the type of the id
    line_up = Window.partitionBy("part").orderBy(*order)
    near = ranged.withColumn("before", F.lag(here).over(line_up))
    ends = ranged.withColumn("last", F.lead("key").over(line_up).isNull()).where("last").select("part", here.alias("last"))
    line = Window.orderBy("part")
    whole = Window.partitionBy()
    joint = ends.select("part", F.coalesce(F.lag("last").over(line), F.max_by("last", "part").over(whole)).alias("across"))
    linked = near.join(F.broadcast(joint), "part").withColumn("b", F.coalesce("before", "across"))
    return linked.select("key", "n_chars", F.col("b.key").alias("before"), F.col("b.n_chars").alias("before_chars"))


def sketches(units: DataFrame, key: str, versions: int) -> DataFrame:
    """(key, v0, v1, ...): the base sketch of each version's digests, from rows (key, version, digest).

    A sketch is the array of its cells (cell, n, k, c) that are not zero, in order; null for no digest.
    """
    cells = _cells(units.withColumns({"sign": F.lit(1), "salt": F.lit(0)}), [key, "version"], F.lit(BASE))
    cell = F.struct("cell", "n", "k", "c")
    each = [F.array_sort(F.collect_list(F.when(F.col("version") == v, cell))).alias(f"v{v}") for v in range(versions)]
    return cells.groupBy(key).agg(*each)


def fingerprint_text(sketch: Column) -> Column:
    """A sketch in hex: two digits of a cell's number, four of its count, 16 of its digests, eight of its check values."""
    part = lambda c: F.concat(
        F.lpad(F.hex(c["cell"]), 2, "0"), F.lpad(F.hex(c["n"]), 4, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["c"]), 8, "0")
    )
    return F.lower(F.array_join(F.transform(sketch, part), ""))


def edit_and_compare(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The edited text has its last floor(n_chars / 2) code points replaced by as many from the start of
    the next document (or all of it). near_edited and near_next are the likeness of the text's fingerprint
    to the edited text's and the next document's: common over all digests, recovered by subtracting and
    peeling the fingerprints, or larger sketches where these do not suffice; 1 for two texts without a unit. A fingerprint of a text without a unit is empty. Rows
    with equal id and text are one document and get the same values; null ids come last, null texts
    count as empty. Texts are shuffled once by their own key, halves once to the document before them.
    """
    order = cut(successors(docs))
    rows = docs.select(_row_key().alias("key"), F.coalesce("text", F.lit("")).alias("text"), "doc_id")
    known = rows.dropDuplicates(["key"]).join(order, "key")
    gifts = known.select(
        F.col("before").alias("key"), F.expr("left(text, cast(before_chars div 2 as int))").alias("gift"), digests(F.col("text")).alias("next")
    )
    own = known.select("key", "n_chars", "text").join(gifts, "key")
    edited = F.concat(F.expr("left(text, cast(n_chars - n_chars div 2 as int))"), F.col("gift"))
    versions = own.select("key", F.col("n_chars").cast("long").alias("n_chars"), digests(F.col("text")).alias("a"), edited.alias("edited"), "next")
    sketched = versions.select(
        "key", "n_chars", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("edited_sha256"), "a", digests(F.col("edited")).alias("e"), "next"
    )
    ready = sketched.select("*", _groups(F.col("a"), F.col("e")).alias("groups_e"), _groups(F.col("a"), F.col("next")).alias("groups_next"))
    # the digests are small next to the work on them, so they are dealt out finer than by their size
    parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ready = stored(ready)
    version = lambda k, c: F.transform(c, lambda x: F.struct(F.lit(k).alias("version"), x.alias("digest")))
    units = F.concat(version(0, "a"), version(1, "e"), version(2, "next"))
    found = sketches(ready.repartition(parts, "key").select("key", F.explode(units).alias("u")).select("key", "u.*"), "key", 3)
    tried = found.select(
        "key",
        # bytes until the end: hex digits take twice the room in tables and shuffles
        F.unhex(fingerprint_text(F.col("v0"))).alias("fingerprint"),
        F.unhex(fingerprint_text(F.col("v1"))).alias("edited_fingerprint"),
        _compared(F.col("v0"), F.col("v1")).alias("d0"),
        _compared(F.col("v0"), F.col("v2")).alias("d1"),
    )
    first = stored(
        tried.select(
            "key",
            "fingerprint",
            "edited_fingerprint",
            *[x for k in (0, 1) for x in ((F.size(f"d{k}.left") > 0).alias(f"open{k}"), F.col(f"d{k}.plus").alias(f"p{k}"), F.col(f"d{k}.minus").alias(f"m{k}"))],
        )
    )
    open_ = stored(ready.join(first.where("open0 or open1").select("key", "open0", "open1"), "key"))
    larger = _differences(
        open_, open_.repartition(parts, "key"), "key", [("a", "e", "groups_e", "open0"), ("a", "next", "groups_next", "open1")]
    ).groupBy("key").agg(*[F.max(F.when(F.col("pair") == k, F.col(c))).alias(f"{c}{k}") for k in (0, 1) for c in ("plus", "minus")])
    sizes = ready.select("key", "n_chars", "edited_sha256", F.size("a").alias("size"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    # an open pair counts by its larger sketches, another one by its fingerprints
    pick = lambda c, k: F.when(F.coalesce(f"open{k}", F.lit(False)), zero(f"{'plus' if c == 'p' else 'minus'}{k}")).otherwise(zero(f"{c}{k}"))
    result = sizes.join(first, "key", "left").join(larger, "key", "left").select(
        "key",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        _likeness(F.col("size"), pick("p", 0), pick("m", 0)).alias("near_edited"),
        _likeness(F.col("size"), pick("p", 1), pick("m", 1)).alias("near_next"),
    )
    text = lambda c: F.coalesce(F.lower(F.hex(c)), F.lit("")).alias(c)
    return docs.select("doc_id", _row_key().alias("key")).join(result, "key").select(
        "doc_id", "n_chars", text("edited_sha256"), text("fingerprint"), text("edited_fingerprint"), "near_edited", "near_next"
    )

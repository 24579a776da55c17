"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every document of a source is wanted x times, x being the source's target over its words: floor(x)
copies and a fraction. Fractions are rounded in pairs: one document's fraction grows and the other's
shrinks by the same number of words until one of them is 0 or 1, up or down at random so that each
fraction is kept on average. The other document stays fractional and meets the next one.

Documents are dealt into groups of about `FAN`; a group is folded in one array, large documents
first, and leaves at most one fractional document, mostly a small one. These residuals, `FAN` groups at a time, are folded again, level by level,
until each source has one residual left, which is rounded to the nearest. Every level is stored. The
mix thus misses a target by half a document of the source at most.

Cases: null and empty texts have size 0, no mass, and are rounded by themselves at random; the null source is
a source of its own and the last one; repeated rows are told apart by a number and rounded one by
one; a source without words has target 0; an empty table gives no rows. Random numbers are hashes of
ids, texts and `seed`, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.llm.common import WORD_PATTERN, stored, whole_row

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
MOST_COPIES = 2
FAN = 64
CHUNK = 4096
SEED = 7


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL,
            most: float = MOST_COPIES) -> DataFrame:
    """Target words of each source, from one row per source (source, source_size, n).

    A target is the smaller of `most` times the source's words and the source's weight times a
    common level; sources reach their limit in the order of limit over weight, so the level is the
    one after the last limit reached. The windows see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    everything = Window.partitionBy()
    by_limit = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    later = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * float(most))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("goal", F.sum("source_size").over(everything) * float(total))
        .withColumn("level", (F.col("goal") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
                    / F.sum("weight").over(later))
    )
    # Limits reached come first in this order, so a source is below its limit from some row on.
    common = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(
        everything)
    return ranked.withColumn("level", common["level"]).select(
        "source", "source_size", "n",
        F.when(F.col("level").isNull() | (F.col("ratio") < F.col("level")), F.col("cap"))
        .otherwise(F.col("weight") * F.col("level")).alias("target"))


def _uniform(*parts) -> str:
    """A number from 0 to below 1 as SQL, from hashes."""
    return f"(pmod(xxhash64({', '.join(parts)}), 1073741824L) / 1073741824D)"


def _fold(seed: int) -> Column:
    """Folds `items` (size, key, p) into `out`, the rounded ones with p 0 or 1, and `last`.

    i is the fractional document so far, x the next one. Up: i gains as many words as x loses.
    """
    up = "least((1D - i.p) * i.size, x.p * x.size)"
    down = "least(i.p * i.size, (1D - x.p) * x.size)"
    draw = _uniform("i.key", "x.key", f"{seed}L")
    item = "named_struct('size', {0}.size, 'key', {0}.key, 'p', {1})"
    # (who is settled, its p, who stays, its p) in each direction
    i_full, x_empty = item.format("i", "1D"), item.format("x", "0D")
    x_rest = item.format("x", f"greatest(0D, least(1D, x.p - {up} / x.size))")
    i_more = item.format("i", f"greatest(0D, least(1D, i.p + {up} / i.size))")
    i_empty, x_full = item.format("i", "0D"), item.format("x", "1D")
    x_more = item.format("x", f"greatest(0D, least(1D, x.p + {down} / x.size))")
    i_rest = item.format("i", f"greatest(0D, least(1D, i.p - {down} / i.size))")
    pair = "named_struct('done', {0}, 'stays', {1})"
    met = f"""
        case when {up} + {down} <= 0D then {pair.format(item.format('i', 'round(i.p)'),
                                                        item.format('x', 'x.p'))}
        when {draw} * ({up} + {down}) < {down} then
            case when (1D - i.p) * i.size <= x.p * x.size then {pair.format(i_full, x_rest)}
                 else {pair.format(x_empty, i_more)} end
        else
            case when i.p * i.size <= (1D - x.p) * x.size then {pair.format(i_empty, x_more)}
                 else {pair.format(x_full, i_rest)} end
        end"""
    kind = "struct<size:double,key:bigint,p:double>"
    return F.expr(f"""
        aggregate(
            items,
            named_struct('out', cast(array() as array<{kind}>), 'last', cast(null as {kind})),
            (acc, x) -> case when acc.last is null then
                named_struct('out', acc.out, 'last', x)
            else
                transform(
                    transform(array(acc.last), i -> {met}),
                    r -> named_struct('out', array_append(acc.out, r.done), 'last', r.stays)
                )[0]
            end
        )""")


def round_fractions(units: DataFrame, seed: int = SEED, fan: int = FAN) -> DataFrame:
    """Rounds p of units (source_no, key, size, p, groups) to 0 or 1; returns source_no, key, p.

    `groups` is the number of groups of the unit's source; keys are unique within a source.
    """
    own = F.pmod(F.xxhash64("key", F.lit(seed)), F.col("groups"))
    level = units.select("source_no", own.alias("group"), "groups", "key", "size", "p")
    settled = None
    while True:
        folded = level.groupBy("source_no", "group", "groups").agg(
            F.sort_array(F.collect_list(F.struct("size", "key", "p")), asc=False).alias("items"),
        ).withColumn("fold", _fold(seed))
        table = stored(folded.select(
            "source_no", "group", "groups",
            F.explode(F.expr(
                "concat(transform(fold.out, x -> struct(x as item, false as open)),"
                " array(struct(fold.last as item, true as open)))")).alias("row"),
        ).select("source_no", "group", "groups", "row.item.*", "row.open"), "mix-level")
        final = F.expr("double(p >= 0.5D)")
        last = F.col("groups") <= 1
        done = table.filter(~F.col("open") | last).select(
            "source_no", "key", F.when(F.col("open"), final).otherwise(F.col("p")).alias("p"))
        settled = done if settled is None else settled.unionByName(done)
        level = table.filter(F.col("open") & ~last).select(
            "source_no", F.floor(F.col("group") / fan).alias("group"),
            F.ceil(F.col("groups") / fan).alias("groups"), "key", "size", "p")
        if level.isEmpty():
            return settled


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL,
           most: float = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """Copies of each row: doc_id, source, row_hash, no, size, source_size, target, copies.

    `row_hash` covers all columns and `no` counts rows that are equal in all of them.
    """
    text = F.col("text").cast("string")
    digest = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias(
                "source"), row_hash(docs).alias("row_hash"), n_words(text).alias("size"))
        .groupBy("doc_id", "source", "row_hash", "size").agg(F.count("*").alias("equal")),
        "mix-digest")
    per_source = digest.groupBy("source").agg(
        F.sum(F.col("size") * F.col("equal")).alias("source_size"),
        F.sum("equal").alias("n"))
    goal = stored(
        targets(per_source, weights, total, most)
        .withColumn("source_no", F.row_number().over(
            Window.orderBy(F.col("source").asc_nulls_last()))), "mix-targets")
    want = F.when(F.col("source_size") > 0,
                  F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    units = stored(
        numbered(digest, "equal", "no", digest)
        .join(goal.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
        .withColumn("want", want)
        .withColumn("key", F.xxhash64("doc_id", "source", "row_hash", "no")), "mix-units")
    fraction = F.col("want") - F.floor("want")
    groups = F.ceil(F.col("n") / FAN)
    apart = (F.col("size") > 0) & (fraction > 0)
    rounded = round_fractions(
        units.filter(apart).select(
            "source_no", "key", F.col("size").cast("double").alias("size"), fraction.alias("p"),
            groups.alias("groups")), seed)
    alone = units.filter(~apart).select(
        "source_no", "key",
        F.expr(f"double({_uniform('key', f'{seed}L')} < want - floor(want))").alias("p"))
    return units.join(rounded.unionByName(alone), ["source_no", "key"]).select(
        "doc_id", "source", "row_hash", "no", "size", "source_size", "target",
        (F.floor("want") + F.col("p")).cast("long").alias("copies"))


def numbered(rows: DataFrame, times: str, number: str, known: DataFrame) -> DataFrame:
    """Every row as often as its column `times` says, numbered from 1.

    Numbers are made in chunks, so that no array grows with a row's copies. The chunks are dealt over
    tasks if a row has several, as the stored table `known` with the same column tells.
    """
    chunks = rows.withColumn("chunk", F.explode(F.expr(f"sequence(0L, ({times} - 1) div {CHUNK})")))
    if known.filter(F.col(times) > CHUNK).head(1):
        chunks = chunks.repartition("row_hash", "chunk")
    first, last = f"chunk * {CHUNK} + 1", f"least({times}, (chunk + 1) * {CHUNK})"
    return chunks.withColumn(number, F.explode(F.expr(f"sequence({first}, {last})"))).drop("chunk")


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of a row, nulls told apart from what hashing skips."""
    parts = [x for name in docs.columns for x in (
        F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return F.xxhash64(*parts)


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every row as often as it is wanted, all columns unchanged.

    Rows that are equal in all columns become one before the shuffle.
    """
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))  # "" is the null id
    often = stored(
        copies(docs, **settings).groupBy(key.alias("key"), "row_hash")
        .agg(F.sum("copies").alias("every")).filter("every > 0"), "mix-often")
    rows = docs.select(whole_row(docs), key.alias("key"), row_hash(docs).alias("row_hash")).groupBy(
        "key", "row_hash").agg(F.first("row").alias("row"))
    joined = rows.join(often, ["key", "row_hash"])
    return numbered(joined.select("row", "row_hash", "every"), "every", "time", often).select("row.*")


def op3(docs: DataFrame) -> DataFrame:
    return copies(docs).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")

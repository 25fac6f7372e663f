"""Mix sources to target weights by pivotal dependent rounding (DataFrame operations only).

Each source gets a target in words; its documents then share one fractional number of copies,
``target / source words``.  The whole part is taken as it is.  For the rest, documents of a source
are paired: mass in words moves between the two, one way or the other at random with odds that
keep every document's expectation, until one of the two is integral and the other goes on with the
residual.  The sum of words of a pair never changes, so a source misses its target by no more than
the last residual, which rounds to the nearest.

The pairs are folded in bins of about ``BIN`` documents, dealt by hash, and each bin's residual goes
up a tree of bins of residuals, a written table per level: a source that holds a third of all rows
is many bins, never one group.

Defined results: a null text has size 0; a null source is a source of its own, ordered last; a
document of size 0 moves no words and its copies are rounded by its own hash; repeated rows are
documents of their own; no source gets more than ``CAP`` times its words, nor any document more
than ``CAP`` copies; an empty table gives an empty result.  The same rows give the same mix.
Columns that ``mixed`` adds on its way are named apart from those of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.common import documents, fresh_name, scratch, written

WEIGHTS, SHARE, CAP, BIN, SEED = (3.0, 1.0, 2.0), 1.5, 2.0, 64, 20240607
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            cap: float = CAP) -> DataFrame:
    """``source, n, source_size, target`` from ``sizes(source, size)``.

    Sources in code point order (null last) weigh ``weights``, repeating.  Sharing by weight, with
    the excess over ``cap`` times a source's size shared again until none is above, ends at one
    level: a source gets ``least(weight * level, cap * size)``.  The level is found from running
    sums over the sources in the order in which they reach their cap.
    """
    src = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.array(*[F.lit(float(x)) for x in weights])
    src = src.withColumn("w", F.element_at(w, order % len(weights) + 1)).withColumn(
        "top", F.col("source_size") * F.lit(float(cap)))
    by_cap = Window.orderBy(F.col("top") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    src = src.withColumn("level", (F.sum("source_size").over(every) * F.lit(float(share))
                                   - F.coalesce(F.sum("top").over(before), F.lit(0.0)))
                         / F.sum("w").over(after))
    # the level holds from the first source on that it does not lift above its cap
    fits = F.when(F.col("level") * F.col("w") <= F.col("top"),
                  F.struct(F.row_number().over(by_cap).alias("at"), "level"))
    src = src.withColumn("fits", fits).withColumn("level", F.min("fits").over(every)["level"])
    return src.select("source", "n", "source_size", F.coalesce(
        F.least(F.col("level") * F.col("w"), F.col("top")), F.col("top")).alias("target"))


def _uniform(*cols: Column) -> Column:
    """A number in [0, 1) that the columns and the seed alone decide."""
    return F.pmod(F.xxhash64(F.lit(SEED), *cols), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _pair(a: Column, b: Column) -> Column:
    """Move mass between two items: ``(settled item with its take, the item that stays open)``."""
    up_a, up_b = a["size"] * (1 - a.p), b["size"] * (1 - b.p)  # words that still fit
    has_a, has_b = a["size"] * a.p, b["size"] * b.p  # words that can go
    gain, loss = F.least(up_a, has_b), F.least(has_a, up_b)  # of a
    rises = _uniform(a.u, b.u) * (gain + loss) < loss

    def out(x: Column, p: Column) -> Column:
        return F.struct(x["size"].alias("size"), p.alias("p"), x.u.alias("u"))

    def both(settled: Column, take: int, opened: Column, p: Column) -> Column:
        return F.struct(F.struct(settled.u.alias("u"), F.lit(take).alias("take")).alias("done"),
                        out(opened, F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))).alias("open"))

    return (F.when(rises & (up_a <= has_b), both(a, 1, b, b.p - gain / b["size"]))
            .when(rises, both(b, 0, a, a.p + gain / a["size"]))
            .when(has_a <= up_b, both(a, 0, b, b.p + loss / b["size"]))
            .otherwise(both(b, 1, a, a.p - loss / a["size"])))


def _fold(items: Column) -> Column:
    """Fold a bin (array of ``size, p, u``), large ones first, so that the small ones that follow
    wear their residual down: ``(open item, settled items)``."""
    none = F.lit(None).cast("struct<size:double,p:double,u:bigint>")
    start = F.struct(none.alias("open"),
                     F.array().cast("array<struct<u:bigint,take:int>>").alias("done"))

    def step(acc: Column, x: Column) -> Column:
        pair = _pair(acc.open, x)
        return F.when(acc.open.isNull(), F.struct(x.alias("open"), acc.done.alias("done"))).otherwise(
            F.struct(pair.open.alias("open"), F.array_append(acc.done, pair.done).alias("done")))

    return F.aggregate(items, start, step)


def rounded(items: DataFrame, bins: int = BIN) -> DataFrame:
    """``source, u, take`` (0 or 1) for ``items(source, n, u, p, size)``, 0 < p < 1, size > 0,
    ``u`` unique within its source.

    ``n`` is at least the number of the source's items."""
    first = F.greatest(F.lit(1), F.ceil(F.col("n") / bins)).cast("long")
    level = items.select("source", F.pmod("u", first).alias("bin"), (first - 1).alias("last"),
                         F.struct(F.col("size").cast("double").alias("size"), "p", "u").alias("open"))
    settled = None
    while True:
        folded = (level.groupBy("source", "bin", "last")
                  .agg(_fold(F.reverse(F.array_sort(F.collect_list("open")))).alias("f"))
                  .select("source", "bin", "last", "f.open", "f.done"))
        folded = written(folded, "mixing")
        done = folded.select("source", F.explode("done").alias("d")).select(
            "source", "d.u", "d.take")
        settled = done if settled is None else settled.unionAll(done)
        if not folded.filter("last > 0").limit(1).count():
            root = folded.select("source", "open.u",
                                 F.when(F.col("open.p") >= 0.5, 1).otherwise(0).alias("take"))
            return settled.unionAll(root)
        level = folded.select("source", F.floor(F.col("bin") / bins).alias("bin"),
                              F.floor(F.col("last") / bins).alias("last"), "open")


def copies(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
           cap: float = CAP) -> DataFrame:
    """``doc_id, text_key, rep, source, size, source_size, target, copies`` for
    ``rows(doc_id, text_key, source, size)``; ``rep`` numbers rows equal in all four from 1."""
    with scratch(rows.sparkSession):
        rows = written(rows, "mixing")
        # equal rows become one row with a count, then as many numbered items: no window over them
        items = (rows.groupBy("doc_id", "text_key", "source", "size").agg(F.count("*").alias("m"))
                 .withColumn("rep", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m")))).drop("m"))
        src = written(targets(rows.select("source", "size"), weights, share, cap), "mixing")
        src = src.withColumnRenamed("source", "src")
        items = items.join(src, F.col("source").eqNullSafe(F.col("src"))).drop("src")
        ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        items = (items.withColumn("base", F.floor(ratio)).withColumn("p", ratio - F.floor(ratio))
                 .withColumn("u", F.xxhash64(F.lit(SEED), "doc_id", "text_key", "rep", "source")))
        items = written(items, "mixing")
        # bins and keys go by (source, u): two items of a source with one u would be a 64-bit collision
        live = items.filter("p > 0 and size > 0")
        twins = live.groupBy("source", "u").agg(F.count("*").alias("c"), F.first("p").alias("p"),
                                                F.first("n").alias("n"), F.sum("size").alias("size"))
        take = rounded(twins.select("source", "n", "u", "p", "size"))
        alone = F.when((F.col("size") == 0) & (_uniform(F.col("u")) < F.col("p")), 1).otherwise(0)
        take = take.select(F.col("source").alias("of"), F.col("u").alias("v"), "take")
        out = items.join(take, (F.col("u") == F.col("v")) & F.col("source").eqNullSafe(F.col("of")), "left")
        out = out.select("doc_id", "text_key", "rep", "source", "size", "source_size", "target",
                         (F.col("base") + F.coalesce("take", alone)).cast("long").alias("copies"))
        return written(out, "mixing", outer=True)


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                       F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, columns as they were."""
    got = (copies(_rows(docs, id_col, text_col, source_col))
           .groupBy("doc_id", "text_key", "source")
           .agg(F.sort_array(F.collect_list(F.struct("rep", "copies"))).alias("c"))
           .filter("exists(c, x -> x.copies > 0)"))
    key, rep, take = (fresh_name(docs, f"llm_{x}") for x in ("key", "rep", "take"))
    got = got.select(F.col("doc_id").alias(key + "d"), F.col("text_key").alias(key + "t"),
                     F.col("source").alias(key + "s"), F.col("c").alias(take))
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    ties = Window.partitionBy(id_col, key, source_col).orderBy(F.lit(1))
    keyed = keyed.withColumn(rep, F.row_number().over(ties))
    both = keyed.join(got, F.col(id_col).eqNullSafe(F.col(key + "d")) & (F.col(key) == F.col(key + "t"))
                      & F.col(source_col).eqNullSafe(F.col(key + "s")))
    times = F.get(F.col(take), F.col(rep) - 1)["copies"]
    both = both.filter(times > 0).withColumn(
        rep, F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return both.select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(documents(spark, sf_dir), "doc_id", "text", "source")
    return copies(rows).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
        "copies")


def mixing_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for every document of the mix: ``doc_id, size, source_size, target`` (to six decimals), ``bounded``
    (whole copies, next to the fractional number, at most two) and ``near`` (its source's words miss the target by
    no more than its largest document)."""
    rows = copies(_rows(documents(spark, sf_dir), "doc_id", "text", "source"))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    taken = rows.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("words"),
                                       F.max("size").alias("largest")).withColumnRenamed("source", "of")
    near = F.abs(F.col("words") - F.col("target")) <= F.col("largest")
    bounded = F.col("copies").between(F.floor(share - 1e-9), F.least(F.ceil(share + 1e-9), F.lit(int(CAP))))
    return rows.join(taken, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), bounded.alias("bounded"),
        near.alias("near"))


LAW_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
      FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY 2 * source_size / w, source NULLS LAST) AS k FROM w),
l AS (SELECT *, ((SELECT 1.5 * sum(source_size) FROM r) - coalesce((SELECT 2.0 * sum(source_size) FROM r b WHERE b.k < r.k), 0))
                / (SELECT sum(w) FROM r b WHERE b.k >= r.k) AS level FROM r),
t AS (SELECT source, source_size,
             coalesce(least(w * (SELECT arg_min(level, k) FROM l WHERE level * w <= 2 * source_size), 2.0 * source_size),
                      2.0 * source_size) AS target FROM l)
SELECT doc_id, size, source_size, round(target, 6) AS target, true AS bounded, true AS near
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""

"""Activity of blocks by a fitted tree over their features, and the regions that follow from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewave.operators import tree as T
from tidewave.plans.metrics import machine_regions
from tidewave.plans.signals import PULSE
from tidewave.session import written
from tidewave.sources.readers import pulses

QUERIES, SQL = {}, {}

#: The features of a block in the order that trees number them.
FEATURES = ["rate", "sandwiches", "half_excess", "width", "stutters", "low_snr", "max_norm", "autocorr", "between", "within", "score"]
#: Expected share of half sandwiches at a rate, as a polynomial, and its greatest value.
CURVE, MOST_HALVES = (0.1, 0.05, -0.0005), 0.8
CLASSES = ["LOW", "SINGLE", "MULTI"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def block_features(p: DataFrame, *more: Column) -> DataFrame:
    """A block's features from its pulses (zmw, mb, frame, label, height, start), and further aggregates.

    Shares are of the pulses; a share, ratio or correlation without anything to divide by is null, which trees take for 0.
    """
    by = Window.partitionBy("zmw", "mb").orderBy("frame")
    near = lambda c, k: F.lag(c, k).over(by)
    x = p.withColumn("one", near("label", 1)).withColumn("next", near("label", -1)).withColumn("before", near("height", 1)).withColumn("gap", F.col("start") - near("start", 1))
    # Mean and spread within each label of a block: sums first, so that no row is joined back.
    n, mean, links = F.count("*"), F.avg("height"), F.count("one")
    labels = x.groupBy("zmw", "mb", "label").agg(
        n.alias("n"), F.sum("height").alias("sum"), F.sum(F.col("height") * F.col("height")).alias("square"), F.max("height").alias("top"), F.min("start").alias("first"), F.max("start").alias("last"),
        links.alias("links"), F.count_if(F.col("label") != F.col("one")).alias("turns"), F.count_if((F.col("one") == F.col("next")) & (F.col("label") != F.col("one"))).alias("filled"),
        F.sum("gap").alias("gaps"), F.sum(F.col("height") * F.col("before")).alias("cross"), F.sum("before").alias("lag1"), F.sum(F.col("before") * F.col("before")).alias("lag2"),
        F.sum(F.when(F.col("before").isNotNull(), F.col("height"))).alias("lead1"), F.sum(F.when(F.col("before").isNotNull(), F.col("height") * F.col("height"))).alias("lead2"), *more,
    )
    s = lambda c: F.sum(c)
    rate = s("n") / F.greatest(F.lit(1), F.max("last") - F.min("first")) * 3600
    expected = F.least(F.lit(MOST_HALVES), CURVE[0] + CURVE[1] * rate + CURVE[2] * rate * rate)
    m = s("sum") / s("n")
    inside = s(F.col("square") - F.col("sum") * F.col("sum") / F.col("n")) / s("n")
    whole = s("square") / s("n") - m * m
    pairs = s("links")
    cov = s("cross") - s("lag1") * s("lead1") / pairs
    spread = (s("lag2") - s("lag1") * s("lag1") / pairs) * (s("lead2") - s("lead1") * s("lead1") / pairs)
    return labels.groupBy("zmw", "mb").agg(
        F.round(rate, 6).alias("rate"), F.round(s("filled") / s("n"), 6).alias("sandwiches"), F.round(s("turns") / s("n") - expected, 6).alias("half_excess"),
        F.round(s("gaps") / F.when(pairs > 0, pairs), 6).alias("width"), F.round((pairs - s("turns")) / s("n"), 6).alias("stutters"),
        F.round(F.min(F.col("sum") / F.col("n")), 6).alias("low_snr"), F.round(F.max("top") / F.when(m != 0, m), 6).alias("max_norm"),
        F.round(F.when((pairs > 2) & (spread > 1e-6), cov / F.sqrt(spread)), 6).alias("autocorr"),
        F.round((whole - inside) / F.when(m != 0, m * m), 6).alias("between"), F.round(inside / F.when(m != 0, m * m), 6).alias("within"), F.round(F.log1p(s("sum")), 6).alias("score"),
        s("n").alias("pulses"),
    )


_FEATURES = PULSE + f""", x as (select *, lag(label) over w as one, lead(label) over w as next, lag(height) over w as before, start - lag(start) over w as gap from pulse window w as (partition by zmw, mb order by frame)),
 own as (select zmw, mb, label, avg(height) as mean, sum(height * height) - sum(height) * sum(height) / count(*) as rest from x group by all),
 l as (select zmw, mb, min(mean) as low, sum(rest) as rest from own group by all),
 b as (select zmw, mb, count(*) as n, count(*) / greatest(1, max(start) - min(start)) * 3600 as rate, count(*) filter (where label <> one) as turns, count(one) as links,
  count(*) filter (where one = next and label <> one) as filled, sum(gap) as gaps, avg(height) as m, avg(height * height) as m2, max(height) as top, sum(height) as total,
  sum(height * before) - sum(before) * sum(height) filter (where before is not null) / count(before) as cov,
  (sum(before * before) - sum(before) * sum(before) / count(before)) * (sum(height * height) filter (where before is not null) - pow(sum(height) filter (where before is not null), 2) / count(before)) as spread from x group by all)
 select zmw, mb, round(rate, 6) as rate, round(filled / n, 6) as sandwiches, round(turns / n - least({MOST_HALVES}, {CURVE[0]} + {CURVE[1]} * rate + {CURVE[2]} * rate * rate), 6) as half_excess,
  round(gaps / nullif(links, 0), 6) as width, round((links - turns) / n, 6) as stutters, round(low, 6) as low_snr, round(top / nullif(m, 0), 6) as max_norm,
  round(case when links > 2 and spread > 1e-6 then cov / sqrt(spread) end, 6) as autocorr, round((m2 - m * m - rest / n) / nullif(m * m, 0), 6) as between, round(rest / n / nullif(m * m, 0), 6) as within,
  round(ln(1 + total), 6) as score, n as pulses from b join l using (zmw, mb)"""


@query(_FEATURES)
def tree_features(spark: SparkSession, sf: str) -> DataFrame:
    """The eleven features of every block."""
    return block_features(pulses(spark, sf))


def labelled_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks with their features and a class to learn: how much signal their bases hold, which no feature tells by itself."""
    p = pulses(spark, sf)
    own = F.sum(F.when(F.col("label") != "N", F.col("height")).otherwise(0.0))
    told = p.groupBy("zmw", "mb").agg(own.alias("own")).select("zmw", "mb", F.when(F.col("own") < 200, 0).when(F.col("own") < 400, 1).otherwise(2).alias("activity"))
    return block_features(p).join(told, ["zmw", "mb"])


def fitted_tree(spark: SparkSession, sf: str) -> tuple[DataFrame, list[T.Node]]:
    """All blocks, and the tree that was learnt from those of three quarters of the keys."""
    rows = written(labelled_blocks(spark, sf), "blocks")  # each level of the tree reads it
    return rows, T.fit(rows.where("pmod(xxhash64(zmw), 4) != 0"), FEATURES, "activity", len(CLASSES))


@query()
def activity_tree(spark: SparkSession, sf: str) -> DataFrame:
    """The activity of every block by the fitted tree, beside the one counted from its bases, which it was to learn."""
    rows, tree = fitted_tree(spark, sf)
    name = F.array(*map(F.lit, CLASSES))
    return rows.select("zmw", "mb", F.get(name, T.evaluated(tree, FEATURES)).alias("activity"), F.get(name, "activity").alias("counted"), (F.pmod(F.xxhash64("zmw"), F.lit(4)) == 0).alias("held_out"))


@query()
def activity_tree_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted tree as a table."""
    return T.as_table(spark, fitted_tree(spark, sf)[1])


@query()
def tree_regions(spark: SparkSession, sf: str) -> DataFrame:
    """High-quality regions by the machine over blocks, from the tree's activities."""
    rows, tree = fitted_tree(spark, sf)
    name = F.get(F.array(*map(F.lit, CLASSES)), T.evaluated(tree, FEATURES))
    return machine_regions(rows.select("zmw", "mb", name.alias("activity")))

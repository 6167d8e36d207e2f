"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions alone.

Each source has a target number of words. Its documents share one copy rate, target / size; the
rate's whole part is given to every document, the fraction is a copy probability. Two units meet
and words of probability pass between them, in a random direction that keeps both expectations,
until one of the two is certain; the other one goes on. A unit that is left over in a group of
some ``FAN_IN`` goes up to the next level of a reduction tree, until one is left per source. That
last unit is rounded to the nearer side, so a source misses its target by half a document at most.
Larger units meet first, so that what is left over tends to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, fresh, stage, stored, word_count

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: Copies of a document at most, and of a source's size.
MOST = 3
#: Units that meet in one group of the tree, about.
FAN_IN = 128

_DONE = "array<struct<k:bigint,k2:bigint,t:int>>"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``src, source_size, target, n`` per source of ``sizes(src, size, m)``; m is a row's number of repeats.

    ``src`` sorts like the source. Shares follow the weights; a share above ``most`` times its
    source's size stops there and the rest is shared anew by weight. In order of cap per weight the
    sources that stop come first, so running sums over that order give the common level at once.
    One row per source goes through one task, after aggregation.
    """
    per = sizes.groupBy("src").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count("*").alias("n"))
    turn = F.row_number().over(Window.orderBy("src"))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((turn - 1) % len(weights) + 1).cast("int")))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "src")
    until, everything = order.rowsBetween(Window.unboundedPreceding, 0), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("cap", F.col("source_size") * most)
    left = F.sum("source_size").over(everything) - (F.sum("cap").over(until) - F.col("cap"))
    open_weight = F.sum("weight").over(everything) - (F.sum("weight").over(until) - F.col("weight"))
    per = per.withColumn("level", left / open_weight)
    per = per.withColumn("level", F.max(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level"))).over(everything))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"))
    return per.select("src", "source_size", target.alias("target"), "n")


def _pivot(units: Column) -> Column:
    """Fold an array of units ``s, k, k2, p``: a struct of what is left (p is 0 if nothing) and of what became certain."""
    entry = lambda u, t: F.struct(u.k.alias("k"), u.k2.alias("k2"), t.cast("int").alias("t"))

    def meet(held: Column, x: Column) -> Column:
        up, down = F.least((1 - held.p) * held.s, x.p * x.s), F.least(held.p * held.s, (1 - x.p) * x.s)
        chance = F.shiftrightunsigned(F.xxhash64(held.k, held.k2, x.k, x.k2), 11) / F.lit(float(1 << 53))
        gains = chance * (up + down) < down
        # equal sides of a minimum make both certain
        held_out = F.when(gains, (1 - held.p) * held.s <= x.p * x.s).otherwise(held.p * held.s <= (1 - x.p) * x.s)
        x_out = F.when(gains, x.p * x.s <= (1 - held.p) * held.s).otherwise((1 - x.p) * x.s <= held.p * held.s)
        moved = F.when(gains, up).otherwise(-down)
        done = F.concat(
            held.done,
            F.when(held_out, F.array(entry(held, gains))).otherwise(F.lit(None).cast(_DONE)),
        )
        done = F.when(held_out, done).otherwise(held.done)
        done = F.when(x_out, F.concat(done, F.array(entry(x, ~gains)))).otherwise(done)
        stays = lambda name: F.when(held_out, x[name]).otherwise(held[name])
        p = F.when(held_out & x_out, F.lit(0.0)).when(held_out, x.p - moved / x.s).otherwise(held.p + moved / held.s)
        p = F.when(held_out & x_out, p).otherwise(F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12)))
        met = F.struct(stays("k").alias("k"), stays("k2").alias("k2"), stays("s").alias("s"), p.alias("p"), done.alias("done"))
        taken_up = F.struct(x.k.alias("k"), x.k2.alias("k2"), x.s.alias("s"), x.p.alias("p"), held.done.alias("done"))
        return F.when(held.p == 0, taken_up).otherwise(met)

    nothing = F.struct(
        F.lit(0).cast("bigint").alias("k"),
        F.lit(0).cast("bigint").alias("k2"),
        F.lit(1.0).alias("s"),
        F.lit(0.0).alias("p"),
        F.array().cast(_DONE).alias("done"),
    )
    return F.aggregate(units, nothing, meet)


def rounded(units: DataFrame) -> DataFrame:
    """``k, k2, t``: 0 or 1 for each of ``units(src, k, k2, s, p)`` with 0 < p < 1 and s > 0."""
    rest, decided, level = stored(units.select("src", "k", "k2", F.col("s").cast("double").alias("s"), "p")), [], 0
    while True:
        groups = stored(rest.groupBy("src").agg(F.ceil(F.count("*") / FAN_IN).alias("groups")))
        widest = groups.agg(F.max("groups")).first()[0]
        place = F.pmod(F.xxhash64("k", "k2", F.lit(level)), F.col("groups"))
        met = (
            rest.join(groups, "src")
            .groupBy("src", place.alias("place"))
            .agg(F.sort_array(F.collect_list(F.struct("s", "k", "k2", "p")), asc=False).alias("units"))
            .select("src", _pivot(F.col("units")).alias("u"))
        )
        met = stored(met)
        decided.append(met.select(F.explode("u.done").alias("d")).select("d.*"))
        rest = met.where("u.p > 0").select("src", "u.k", "u.k2", "u.s", "u.p")
        level += 1
        if widest is None or widest <= 1:
            break
    out = rest.select("k", "k2", F.when(F.col("p") >= 0.5, 1).otherwise(0).alias("t"))
    for part in decided:
        out = out.unionByName(part)
    return out


def mixed(docs: DataFrame, keep: bool = True) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` (all columns, or none but doc_id) with size, source_size, target and copies; and those columns' names.

    A null text has size 0 and gets as many copies as its rate's whole part. Documents of size 0
    carry no words and are not rounded. A null source is one source, the last. Rows that repeat
    doc_id, source and text form one unit and share its copies as evenly as whole numbers allow.
    An empty table gives an empty result. The draw depends on the rows' content alone, so reruns
    agree however the rows are partitioned.
    """
    k, k2, src, size = fresh(docs, "k", "k2", "src", "size")
    tag = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    keyed = docs.withColumns(
        {
            src: tag,
            size: word_count(F.col("text")),
            k: F.xxhash64("doc_id", "source", "text"),
            k2: F.xxhash64(F.lit(1), "text", "source", "doc_id"),
        }
    )
    narrow = stored(keyed.select(F.col("doc_id").alias("doc_id"), F.col(src).alias("src"), F.col(size).alias("size"), F.col(k).alias("k"), F.col(k2).alias("k2")))
    units = stored(narrow.groupBy("k", "k2").agg(F.first("src").alias("src"), F.first("size").alias("size"), F.count("*").alias("m")))
    per = stored(targets(units))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = units.join(per, "src").withColumn("whole", F.floor(rate * F.col("m"))).withColumn("p", rate * F.col("m") - F.col("whole"))
    draw = rounded(units.where("size > 0 and p > 0").select("src", "k", "k2", F.col("size").alias("s"), "p"))
    given = units.join(draw, ["k", "k2"], "left").select(
        "k", "k2", "source_size", "target", "m", (F.col("whole") + F.coalesce("t", F.lit(0))).alias("given")
    )
    names = dict(zip(("source_size", "target", "m", "given", "copies"), fresh(keyed, "source_size", "target", "m", "given", "copies")))
    given = given.select(F.col("k").alias(k), F.col("k2").alias(k2), *(F.col(c).alias(names[c]) for c in ("source_size", "target", "m", "given")))
    rows = keyed if keep else narrow.select("doc_id", F.col("src").alias(src), F.col("size").alias(size), F.col("k").alias(k), F.col("k2").alias(k2))
    out = rows.join(given, [k, k2])
    m, given_of, copies = (names[c] for c in ("m", "given", "copies"))
    # the join leaves the rows of a unit together and in order, so numbering them deals nothing out again
    turn = F.row_number().over(Window.partitionBy(k, k2).orderBy(src))
    extra = (turn <= F.col(given_of) % F.col(m)).cast("long")
    return out.withColumn(copies, F.floor(F.col(given_of) / F.col(m)) + extra), names | {"size": size}


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix takes it, with its own columns."""
    out, names = mixed(docs)
    copies = F.col(names["copies"])
    return out.where(copies > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("copy_no")).select(*docs.columns)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, names = mixed(documents(spark, sf_dir), keep=False)
    size = F.col(names["size"])
    return out.select("doc_id", size.alias("size"), F.col(names["source_size"]).alias("source_size"), F.col(names["target"]).alias("target"), (size * F.col(names["copies"])).alias("taken"))

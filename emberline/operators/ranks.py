"""Exact nearest-rank values without sorting everything in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.session import new_folder

# Size of a sketch, and the step of the shares at which it is asked: several times the error of a sketch of that size.
SKETCH, STEP = 4096, 0.005
# A bracket of more rows is narrowed by a sketch of its own rows before its values are counted.
BRACKET_ROWS = 4_000_000
# Up to so many targets go along with the plan as they are; more are written, so that Spark knows their size.
FEW = 1000


def _settled(targets: DataFrame) -> tuple[DataFrame, int]:
    """The targets as a table of known size, and the rows that their largest bracket holds.

    An aggregation's size is unknown to Spark, so it would shuffle every row to join with it."""
    spark = targets.sparkSession
    some = targets.limit(FEW + 1).collect()
    if len(some) <= FEW:
        return spark.createDataFrame(some, targets.schema), max([int(r["_held"]) for r in some], default=0)
    folder = new_folder(spark, "ranks")
    targets.write.parquet(folder)
    read = spark.read.schema(targets.schema).parquet(folder)
    return read, int(read.agg(F.max("_held")).first()[0])


def _asked(sketch: str, step: float) -> Column:
    """The sketch's values at every step of the shares from 0 to 1."""
    n = round(1 / step)
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / n) for i in range(n + 1)]))


def _bracket(rank: Column, n: Column, low: Column, high: Column, step: float) -> list[Column]:
    """The values between which `_q`, the sketch's answers, place a rank (from 1) of n, a step of margin on either side, and the rows there."""
    steps = round(1 / step)
    first, last = F.floor(rank / n * steps) - 1, F.ceil(rank / n * steps) + 1
    return [F.when(first < 0, low).otherwise(F.get("_q", F.greatest(first, F.lit(0)).cast("int"))).alias("_lo"),
            F.when(last > steps, high).otherwise(F.get("_q", F.least(last, F.lit(steps)).cast("int"))).alias("_hi"),
            F.ceil(n * (3 / steps)).cast("long").alias("_held")]


def nearest_ranks(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), sketch: int = SKETCH,
                  step: float = STEP, bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """For each p the value at 0-based position least(floor(p n), n - 1) in sorted order.

    Rows with a null value or a null group key count nowhere.

    One pass gives a mergeable sketch per group, which brackets each rank between two values, however these are
    distributed; a second pass counts the rows below a bracket and, by value, those inside, so the answer is exact.
    A bracket of very many rows is narrowed by a pass more. A rank outside its bracket would be an error of the query,
    never a wrong value. All passes but the last run while the plan is built.
    """
    by = list(by)
    rows = df.dropna(subset=[*by, value]).select(*by, F.col(value).cast("double").alias("_v"))
    whole = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.kll_sketch_agg_double("_v", F.lit(sketch)).alias("_s"),
                                  F.min("_v").alias("_low"), F.max("_v").alias("_high")).where("_n > 0").withColumn("_q", _asked("_s", step))

    def sought(p: float) -> Column:
        rank = F.least(F.floor(F.lit(float(p)) * F.col("_n")), F.col("_n") - 1) + 1
        return F.struct(F.lit(float(p)).alias("p"), rank.cast("long").alias("_rank"), *_bracket(rank, F.col("_n"), F.col("_low"), F.col("_high"), step))

    targets, held = _settled(whole.select(*by, F.inline(F.array(*[sought(p) for p in probs]))))

    def met() -> DataFrame:
        """Rows that lie below the end of a bracket, once for each."""
        if by:
            return rows.join(targets, by).where("_v <= _hi")
        one_each = [F.struct(*[F.lit(r[c]).alias(c) for c in targets.columns]) for r in targets.collect()]  # a row per p
        return rows.select("_v", F.inline(F.array(*one_each))).where("_v <= _hi") if one_each else rows.join(targets.limit(0))

    while held > bracket_rows:
        inside = F.col("_v") >= F.col("_lo")
        narrowed = met().groupBy(*by, "p", "_rank", "_lo", "_hi").agg(
            F.count_if(~inside).alias("_below"), F.count_if(inside).alias("_n"), F.kll_sketch_agg_double(F.when(inside, F.col("_v")), F.lit(sketch)).alias("_s"))
        narrowed = narrowed.withColumn("_q", _asked("_s", step))
        ends = _bracket(F.col("_rank") - F.col("_below"), F.col("_n"), F.col("_lo"), F.col("_hi"), step)
        before, (targets, held) = held, _settled(narrowed.select(*by, "p", "_rank", *ends))
        if held >= before:
            break

    counted = (met().groupBy(*by, "p", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_at"))
               .agg(F.count(F.lit(1)).alias("_n"), F.first("_rank").alias("_rank")))
    upto = F.sum("_n").over(Window.partitionBy(*by, "p").orderBy(F.asc_nulls_first("_at")).rowsBetween(Window.unboundedPreceding, 0))
    found = counted.withColumn("_upto", upto).groupBy(*by, "p").agg(F.min_by(F.struct("_at"), F.when(F.col("_upto") >= F.col("_rank"), F.col("_upto"))).alias("_x"))
    exact = F.when(F.col("_x._at").isNull(), F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")).otherwise(F.col("_x._at"))
    return found.select(*by, "p", exact.alias("value"))

"""Offline evaluation of model predictions.

Flags per sample, cp loss, histogram and a one-row metrics aggregate. The
only aggregates are global (a handful of scalars, partial per partition
then merged) or per bucket (6 groups), so nothing large meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rookery.functions.draws import hash_uniform
from rookery.functions.text import extract_move_strict

# --- fixed values -----------------------------------------------------------
# cp-loss histogram, upper-inclusive edges.
CP_LOSS_BUCKETS = [("0-10", 10), ("10-25", 25), ("25-50", 50), ("50-100", 100), ("100-200", 200),
                   ("200+", None)]
EVAL_MATE_CP = 10000
# Example mix: up to 4 exact, 3 legal-inexact, 3 failures, 10 in total.
CLASS_MIX = [("exact", 4), ("legal", 3), ("fail", 3)]
CLASS_MIX_CAP = 10
# --- end of fixed values -----------------------------------------------------


def eval_cp(cp: Column, mate_in: Column) -> Column:
    return F.when(mate_in > 0, F.lit(EVAL_MATE_CP)).when(mate_in.isNotNull(), F.lit(-EVAL_MATE_CP)).otherwise(cp)


def eval_flags(preds: DataFrame, analysis: DataFrame, text: str = "completion") -> DataFrame:
    """``preds(prompt_id, sample_id, completion)`` joined once to the
    per-position analysis; adds parsed / legal / exact / top3 / top5 / cp loss."""
    r = preds.withColumn("pred", extract_move_strict(text))
    an = analysis.withColumnRenamed("pos_id", "prompt_id")
    j = r.join(an, "prompt_id", "left")
    ev = F.try_element_at(F.col("evals"), F.col("pred"))
    parsed = F.col("pred").isNotNull()
    legal = parsed & F.coalesce(F.array_contains("valid_moves", F.col("pred")), F.lit(False))
    has_best = F.col("best_uci").isNotNull()
    rank = ev["rank"]
    pred_cp = eval_cp(ev["cp"], ev["mate_in"])
    best_cp = eval_cp(F.col("best_cp"), F.col("best_mate_in"))
    loss = F.when(legal & has_best & pred_cp.isNotNull(), F.abs(best_cp - pred_cp))
    return j.select(
        "prompt_id", "sample_id", "pred",
        parsed.alias("is_parsed"), legal.alias("is_legal"),
        (legal & has_best & (F.col("pred") == F.col("best_uci"))).alias("is_exact_match"),
        (legal & has_best & F.coalesce(rank <= 3, F.lit(False))).alias("is_top3"),
        (legal & has_best & F.coalesce(rank <= 5, F.lit(False))).alias("is_top5"),
        loss.cast("int").alias("centipawn_loss"))


def cp_bucket(loss) -> Column:
    c = F.col(loss) if isinstance(loss, str) else loss
    expr = None
    for label, hi in CP_LOSS_BUCKETS:
        if hi is None:
            expr = expr.otherwise(F.lit(label))
        else:
            expr = F.when(c <= hi, F.lit(label)) if expr is None else expr.when(c <= hi, F.lit(label))
    return F.when(c.isNotNull(), expr)


def bucket_table(spark: SparkSession) -> DataFrame:
    rows = [(i, label) for i, (label, _) in enumerate(CP_LOSS_BUCKETS)]
    return F.broadcast(spark.createDataFrame(rows, "bucket_ord INT, bucket STRING"))


def cp_loss_histogram(spark: SparkSession, flags: DataFrame) -> DataFrame:
    counts = flags.filter(F.col("centipawn_loss").isNotNull()) \
        .groupBy(cp_bucket("centipawn_loss").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    h = bucket_table(spark).join(counts, "bucket", "left")
    return h.select("bucket_ord", "bucket", F.coalesce(F.col("n"), F.lit(0)).alias("n"))


def histogram_report(hist: DataFrame) -> DataFrame:
    total = F.sum("n").over(Window.partitionBy())  # six rows
    pct = F.when(total > 0, F.col("n") * 100.0 / total).otherwise(F.lit(0.0))
    h = hist.withColumn("pct", pct)
    return h.select("bucket_ord", "bucket", "n", F.round("pct", 6).alias("pct"),
                    F.repeat(F.lit("█"), F.floor(F.col("pct") / 2).cast("int")).alias("bar"))


def eval_metrics(flags: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    rate = lambda c: F.coalesce(F.try_divide(F.sum(F.col(c).cast("int")), n), F.lit(0.0))
    valid = F.count("centipawn_loss")
    return flags.agg(
        n.alias("num_samples"),
        rate("is_parsed").alias("tag_parse_rate"),
        rate("is_legal").alias("legal_move_rate"),
        rate("is_exact_match").alias("exact_match_rate"),
        rate("is_top3").alias("top_3_match_rate"),
        rate("is_top5").alias("top_5_match_rate"),
        F.when(valid > 0, F.sum("centipawn_loss") / valid).otherwise(F.lit(0.0)).alias("avg_centipawn_loss"),
    )


def class_mix_sample(flags: DataFrame, seed: int = 42) -> DataFrame:
    """Up to 4 exact, 3 legal-inexact, 3 failures (10 max), picked by draw.

    One pass: a rank limit per class, which Spark also applies before the
    shuffle (window group limit), so a class holding most rows sends a few
    rows per task."""
    cls = (F.when(F.col("is_exact_match"), F.lit("exact")).when(F.col("is_legal"), F.lit("legal"))
           .otherwise(F.lit("fail")))
    most = max(k for _, k in CLASS_MIX)
    f = flags.withColumn("cls", cls).withColumn("u", hash_uniform(seed, F.col("prompt_id"), F.col("sample_id")))
    per = Window.partitionBy("cls").orderBy("u", "prompt_id", "sample_id")
    f = f.withColumn("_r", F.row_number().over(per)).filter(F.col("_r") <= most)
    order, room = F.lit(None).cast("int"), F.lit(0)
    for i, (name, k) in enumerate(CLASS_MIX):
        order, room = F.when(F.col("cls") == name, i).otherwise(order), F.when(F.col("cls") == name, k).otherwise(room)
    f = f.filter(F.col("_r") <= room).withColumn("cls_ord", order)
    w = Window.orderBy("cls_ord", "u", "prompt_id", "sample_id")  # at most 10 rows
    g = f.withColumn("slot", F.row_number().over(w))
    return g.filter(F.col("slot") <= CLASS_MIX_CAP).drop("cls_ord", "_r")

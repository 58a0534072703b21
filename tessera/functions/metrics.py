"""Classification metrics as aggregates: one pass, sliced by any columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import order_key, running_sums
from .expressions import sigmoid


def _share(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _share(2 * tp, 2 * tp + fp + fn)


def confusion(rows: DataFrame, label: str, predicted: str, by: list[str]) -> DataFrame:
    """``tp``, ``fp``, ``tn`` and ``fn`` for each slice; labels and predictions are 0 or 1."""
    y, p = F.col(label), F.col(predicted)
    counts = {"tp": (y == 1) & (p == 1), "fp": (y == 0) & (p == 1), "tn": (y == 0) & (p == 0), "fn": (y == 1) & (p == 0)}
    return rows.groupBy(*by).agg(*(F.count_if(c).alias(k) for k, c in counts.items()))


def with_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and the F1 scores, from confusion counts.

    ``macro_f1`` averages both classes; ``macro_f1_present`` only classes that occur in
    labels or predictions; ``macro_f1_epsilon`` adds 1e-12 to every denominator.
    """
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    pos, neg = _f1(tp, fp, fn), _f1(tn, fn, fp)
    has_pos, has_neg = (tp + fp + fn) > 0, (tn + fp + fn) > 0
    eps = lambda a, b, c: (lambda p, r: 2 * p * r / (p + r + 1e-12))(a / (a + b + 1e-12), a / (a + c + 1e-12))
    present = (F.when(has_pos, pos).otherwise(0.0) + F.when(has_neg, neg).otherwise(0.0)) / F.greatest(has_pos.cast("int") + has_neg.cast("int"), F.lit(1))
    return counts.withColumns(
        {
            "n": n,
            "accuracy": _share(tp + tn, n),
            "precision": _share(tp, tp + fp),
            "recall": _share(tp, tp + fn),
            "f1": pos,
            "positive_rate": _share(tp + fp, n),
            "macro_f1": (pos + neg) / 2,
            "macro_f1_present": present,
            "macro_f1_epsilon": (eps(tp, fp, fn) + eps(tn, fn, fp)) / 2,
        }
    )


def mean_entropy(probability: Column) -> Column:
    """Aggregate: the mean entropy (natural logarithm) of probabilities, clipped by 1e-12."""
    p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), probability))
    return F.avg(-(p * F.ln(p) + (1 - p) * F.ln(1 - p)))


def score_counts(rows: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """Positives and rows of each distinct score: what the rank metrics need, whatever the number of rows."""
    return rows.groupBy(*by, score).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count("*").alias("cnt"))


def ranked_scores(rows: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """``score_counts`` with the positives and rows below each score and in its whole slice; continuous scores put no slice in one task."""
    counts = score_counts(rows, label, score, by).withColumn("__key", order_key(F.col(score)))
    return running_sums(counts, by, "__key", ["pos", "cnt"]).drop("__key")


def auroc(rows: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """The area under the ROC curve of each slice, by rank sums with ties halved; null with one class."""
    ranked = ranked_scores(rows, label, score, by).withColumn("rank", F.col("cnt_below") + (F.col("cnt") + 1) / 2)
    total = ranked.groupBy(*by).agg(F.sum(F.col("rank") * F.col("pos")).alias("s"), F.sum("pos").alias("p"), F.sum(F.col("cnt") - F.col("pos")).alias("q"))
    return total.select(*by, F.try_divide(F.col("s") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * F.col("q")).alias("auroc"))


def binary_metrics(rows: DataFrame, label: str, logit: str, by: list[str], threshold: float = 0.5) -> DataFrame:
    """The whole set for each slice: AUROC, accuracy, F1 scores, precision, recall, shares, and each label's own block.

    A row is predicted positive if the sigmoid of its logit reaches ``threshold``.
    ``positive_rate`` is the labels' share of 1; ``parse_rate`` the share of rows whose logit
    is a number: the others count nowhere else. ``label_A_`` names the positive class, ``label_B_`` the
    negative one, each with precision, recall, F1 and how often it is predicted.
    """
    keys = [F.col(c) for c in by] or [F.lit(0)]
    names = [f"__by{k}" for k in range(len(keys))]
    held = rows.select(*(c.alias(n) for c, n in zip(keys, names)), F.col(label).alias("y"), F.col(logit).cast("double").alias("x"))
    parsed = held.groupBy(*names).agg(F.avg((F.col("x").isNotNull() & ~F.isnan("x")).cast("double")).alias("parse_rate"))
    held = held.filter("x is not null and not isnan(x)").withColumn("s", sigmoid(F.col("x"))).withColumn("p", (F.col("s") >= threshold).cast("int"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    out = with_metrics(confusion(held, "y", "p", names)).withColumns(
        {
            "positive_rate": _share(tp + fn, F.col("n")),
            "label_A_precision": F.col("precision"),
            "label_A_recall": F.col("recall"),
            "label_A_f1": F.col("f1"),
            "label_A_predicted": tp + fp,
            "label_B_precision": _share(tn, tn + fn),
            "label_B_recall": _share(tn, tn + fp),
            "label_B_f1": _f1(tn, fn, fp),
            "label_B_predicted": tn + fn,
        }
    )
    for other in (auroc(held, "y", "s", names), parsed):
        same = [out[n].eqNullSafe(other[n]) for n in names]
        out = out.join(other, same).select(*(out[c] for c in out.columns), *(other[c] for c in other.columns if c not in names))
    return out.withColumnsRenamed(dict(zip(names, by))) if by else out.drop(*names)


def tuned_threshold(rows: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """For each slice the threshold (predict from it on) of best macro F1, then accuracy, precision, and the lower one.

    All distinct scores are tried in one pass of running sums, and a threshold above all.
    """
    ranked = ranked_scores(rows, label, score, by).withColumnRenamed(score, "threshold")
    tried = ranked.withColumns({"p": F.col("pos_all"), "n": F.col("cnt_all"), "tp": F.col("pos_all") - F.col("pos_below"), "pp": F.col("cnt_all") - F.col("cnt_below")})
    none = ranked.groupBy(*by).agg(F.sum("pos").alias("p"), F.sum("cnt").alias("n")).select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("pp"), "p", "n")
    every = tried.select(*by, "threshold", "tp", "pp", "p", "n").unionByName(none)
    every = every.withColumns({"fp": F.col("pp") - F.col("tp"), "fn": F.col("p") - F.col("tp"), "tn": F.col("n") - F.col("p") - F.col("pp") + F.col("tp")}).drop("n")
    scored = with_metrics(every)
    lower = F.when(F.col("threshold") == float("inf"), F.lit(-1e100)).otherwise(-F.col("threshold"))
    best = F.max_by(F.struct("threshold", "macro_f1", "accuracy", "precision"), F.struct("macro_f1", "accuracy", "precision", lower))
    return scored.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def grid_threshold(rows: DataFrame, label: str, score: str, grid: list[float]) -> DataFrame:
    """The first of the grid's thresholds (predict above it) with the best epsilon macro F1."""
    y, s = F.col(label), F.col(score)
    cells = []
    for t in grid:
        cells.append(F.struct(F.lit(t).alias("threshold"), F.count_if((s > t) & (y == 1)).alias("tp"), F.count_if((s > t) & (y == 0)).alias("fp"), F.count_if((s <= t) & (y == 0)).alias("tn"), F.count_if((s <= t) & (y == 1)).alias("fn")))
    tried = rows.agg(F.array(*cells).alias("g")).select(F.inline("g"))
    best = F.max_by(F.struct("threshold", "macro_f1_epsilon"), F.struct("macro_f1_epsilon", -F.col("threshold")))
    return with_metrics(tried).agg(best.alias("b")).select("b.*")

"""Daily features, folds, classifier metrics, feature ranking, distributions, clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..domain import Domain
from ..functions import count_if
from ..session import store, work_folder, written
from .ordered import hashed_rank, running_totals
from .quantiles import exact_quantiles


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


# Daily table

def daily_features(df: DataFrame, domain: Domain, features: dict[str, str]) -> DataFrame:
    """One row per day: mean of each feature (nulls skipped), the day's decision and the target.

    A day with two decisions has no valid target: ``restriccion`` is null there, and
    `label_conflicts` reports it.
    """
    days = df.groupBy("fecha").agg(
        F.min("anio").alias("anio"), F.min("mes").alias("mes"), *[F.avg(c).alias(n) for n, c in features.items()],
        F.min("decision").alias("decision"), F.max("decision").alias("_other"))
    target = F.when(F.col("decision") == F.col("_other"), F.when(F.col("decision") == domain.no_restriction, "No").otherwise("Si"))
    return days.withColumn("restriccion", target).drop("_other")


def label_conflicts(df: DataFrame) -> DataFrame:
    """Days, and days whose rows disagree on the decision."""
    days = df.groupBy("fecha").agg(F.min("decision").alias("a"), F.max("decision").alias("z"))
    return days.agg(F.count(F.lit(1)).alias("dias"), count_if(F.col("a") != F.col("z")).alias("conflictos"))


# Folds

def stratified_folds(df: DataFrame, label: str, identity: list[str], k: int) -> DataFrame:
    """Fold 0 … k-1, equal in size inside each class."""
    return hashed_rank(df, label, identity).withColumn("fold", ((F.col("rank") - 1) % k).cast("int")).drop("rank")


def temporal_holdout(df: DataFrame, last_train_year: int) -> DataFrame:
    return df.withColumn("conjunto", F.when(F.col("anio") <= last_train_year, "entrenamiento").otherwise("prueba"))


# Classifier quality; frames hold label (0/1), score in (0, 1), prediction (0/1)

def confusion_matrix(df: DataFrame, by: list[str] = ()) -> DataFrame:
    return df.groupBy(*by, "label").agg(
        count_if(F.col("prediction") == 0).alias("pred_0"), count_if(F.col("prediction") == 1).alias("pred_1"))


def classification_metrics(df: DataFrame, digits: int | None = None, by: list[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1, MCC, specificity and log-loss of the positive class."""
    y, p, score = F.col("label"), F.col("prediction"), F.col("score")
    counts = df.groupBy(*by).agg(
        count_if((y == 1) & (p == 1)).alias("tp"), count_if((y == 0) & (p == 1)).alias("fp"),
        count_if((y == 0) & (p == 0)).alias("tn"), count_if((y == 1) & (p == 0)).alias("fn"),
        F.avg(-F.when(y == 1, F.ln(score)).otherwise(F.ln(1 - score))).alias("ll"))
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    safe = lambda a, b: a / F.nullif(b, F.lit(0.0))
    values = {
        "ca": safe(tp + tn, tp + fp + tn + fn), "precision": safe(tp, tp + fp), "recall": safe(tp, tp + fn),
        "f1": safe(2 * tp, 2 * tp + fp + fn), "specificity": safe(tn, tn + fp),
        "mcc": safe(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))), "log_loss": F.col("ll")}
    return counts.select(*by, "tp", "fp", "tn", "fn", *[_round(c, digits).alias(n) for n, c in values.items()])


def _score_cells(df: DataFrame) -> DataFrame:
    return df.groupBy("score").agg(F.sum((F.col("label") == 1).cast("bigint")).alias("pos"), F.sum((F.col("label") == 0).cast("bigint")).alias("neg"))


def auc(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Rank-sum AUC; tied scores share their average rank. Ranks run over distinct scores only."""
    cells = running_totals(_score_cells(df), ["score"], ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    one = cells.agg(
        F.sum(F.col("pos") * (below + F.col("neg") / 2.0)).alias("u"), F.sum("pos").alias("positivos"), F.sum("neg").alias("negativos"))
    pairs = F.nullif(F.col("positivos").cast("double") * F.col("negativos"), F.lit(0.0))
    return one.select("positivos", "negativos", _round(F.col("u") / pairs, digits).alias("auc"))


def roc_points(df: DataFrame, digits: int | None = None) -> DataFrame:
    """One point per distinct score, from the highest threshold down."""
    cells = running_totals(_score_cells(df), [F.col("score").desc()], ["pos", "neg"])
    totals = cells.agg(F.sum("pos").cast("double").alias("_p"), F.sum("neg").cast("double").alias("_n"))  # one row
    return cells.join(F.broadcast(totals)).select(
        F.col("score").alias("threshold"), _round(F.col("cum_neg") / F.nullif(F.col("_n"), F.lit(0.0)), digits).alias("fpr"),
        _round(F.col("cum_pos") / F.nullif(F.col("_p"), F.lit(0.0)), digits).alias("tpr"))


def constant_model(df: DataFrame, label: str, digits: int | None = None) -> DataFrame:
    """Majority class (the smaller one wins a tie) and class shares."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_t"), F.max_by(label, F.struct("n", F.lit(0))).alias("_any"),
                       F.min_by(label, F.struct(-F.col("n"), label)).alias("_major"))  # one row
    return counts.join(F.broadcast(total)).select(
        label, "n", _round(F.col("n") / F.col("_t").cast("double"), digits).alias("prior"), (F.col(label) == F.col("_major")).alias("predicted"))


# Feature ranking

def feature_rank(df: DataFrame, features: list[str], label: str, digits: int | None = None) -> DataFrame:
    """Information gain ratio and Gini decrease of each feature cut at its quartiles."""
    long = df.select(label, *features).unpivot([label], features, "variable", "value").where("value IS NOT NULL")
    cuts = exact_quantiles(long, "value", {"a": 0.25, "b": 0.5, "c": 0.75}, by=["variable"]).drop("n")
    binned = long.join(F.broadcast(cuts), "variable").withColumn(  # one row per feature of a fixed list
        "bin", (F.col("value") > F.col("a")).cast("int") + (F.col("value") > F.col("b")).cast("int") + (F.col("value") > F.col("c")).cast("int"))
    cells = binned.groupBy("variable", "bin", label).agg(F.count(F.lit(1)).cast("double").alias("n"))
    # From here on: features x 4 bins x classes.
    total = F.sum("n").over(Window.partitionBy("variable"))
    in_bin = F.sum("n").over(Window.partitionBy("variable", "bin"))
    in_class = F.sum("n").over(Window.partitionBy("variable", label))
    cells = cells.select("variable", "bin", "n", total.alias("t"), in_bin.alias("nb"), in_class.alias("nc"))
    n, t, nb, nc = (F.col(c) for c in ("n", "t", "nb", "nc"))
    s = cells.groupBy("variable").agg(
        F.sum(-(n / t) * F.ln(nc / t)).alias("h_label"), F.sum(-(n / t) * F.ln(n / nb)).alias("h_given"), F.sum(-(n / t) * F.ln(nb / t)).alias("h_bin"),
        (1 - F.sum((n / t) * (nc / t))).alias("g_label"), (1 - F.sum(n * n / (nb * t))).alias("g_given"))
    return s.select(
        "variable", _round((F.col("h_label") - F.col("h_given")) / F.nullif(F.col("h_bin"), F.lit(0.0)), digits).alias("gain_ratio"),
        _round(F.col("g_label") - F.col("g_given"), digits).alias("gini"))


# Distributions

def histogram(df: DataFrame, column: str, low: float, width: float, by: list[str] = ()) -> DataFrame:
    """Counts in equal bins; bin i covers [low + i*width, low + (i+1)*width)."""
    cell = F.floor((F.col(column) - low) / width).cast("int")
    return df.where(F.col(column).isNotNull()).groupBy(*by, cell.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, column: str, by: list[str], digits: int | None = None) -> DataFrame:
    """Least, quartiles, greatest and mean per group."""
    with work_folder(df.sparkSession, "box") as folder:
        rows = store(df.select(*by, column), folder)
        q = exact_quantiles(rows, column, {"q1": 0.25, "mediana": 0.5, "q3": 0.75}, by=by, stored=True).drop("n")
        s = written(rows.groupBy(*by).agg(F.min(column).alias("min"), F.max(column).alias("max"), F.avg(column).alias("media"), F.count(column).alias("n")), "box-counts")
    return s.join(q, by).select(*by, "n", *[_round(F.col(c), digits).alias(c) for c in ("min", "q1", "mediana", "q3", "max", "media")])


# Clusters

def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """z-scores; a column without variance becomes 0."""
    stats = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(f"_z_{c}") for c in columns])  # one row
    z = {c: F.when(F.col(f"_z_{c}.s") == 0, F.when(F.col(c).isNotNull(), F.lit(0.0))).otherwise(
        (F.col(c) - F.col(f"_z_{c}.m")) / F.nullif(F.col(f"_z_{c}.s"), F.lit(0.0))) for c in columns}
    return df.join(F.broadcast(stats)).withColumns(z).drop(*[f"_z_{c}" for c in columns])


def assign_centroid(df: DataFrame, centroids: DataFrame, columns: list[str], name: str = "cluster") -> DataFrame:
    """Nearest centroid by squared distance (the smaller name wins a tie). k centroids ride along as one array."""
    packed = centroids.agg(F.collect_list(F.struct(F.col(name).alias("id"), *[F.col(c).alias(f"x{i}") for i, c in enumerate(columns)])).alias("_c"))

    def measured(c: Column) -> Column:
        parts = [F.pow(F.col(column) - c[f"x{i}"], F.lit(2.0)) for i, column in enumerate(columns)]
        return F.struct(sum(parts[1:], parts[0]).alias("d"), c["id"].alias("id"))

    best = F.array_min(F.transform("_c", measured))
    return df.join(F.broadcast(packed)).withColumn("_best", best).select(
        *df.columns, F.col("_best.id").alias(name), F.col("_best.d").alias("distancia"))


def cluster_profile(df: DataFrame, columns: list[str], target: str, positive, cluster: str = "cluster", digits: int | None = None,
                    by: list[str] = ()) -> DataFrame:
    """Per cluster: size, feature means and share of the positive target."""
    return df.groupBy(*by, cluster).agg(
        F.count(F.lit(1)).alias("n"), *[_round(F.avg(c), digits).alias(c) for c in columns],
        _round(F.avg((F.col(target) == positive).cast("double")) * 100, digits).alias("pct_positivo"))

"""Daily features, folds, metrics, learners, clusters, distributions."""

from pyspark.sql import functions as F

from ..domain import TRADE
from ..operators import learners as ml, mining as mn
from .registry import query
from .views import Tables

D = 6
FEATURES = {"almacenamiento_pct": "storage", "precipitacion_mm": "rain", "consumo": "water_use", "cobertura_pct": "coverage"}
NAMES = list(FEATURES)
_DAYS = """SELECT fecha, min(anio) AS anio, min(mes) AS mes, avg(storage) AS almacenamiento_pct, avg(rain) AS precipitacion_mm, avg(water_use) AS consumo,
 avg(coverage) AS cobertura_pct, min(decision) AS decision, CASE WHEN min(decision) <> max(decision) THEN NULL WHEN min(decision) = 'No restriction' THEN 'No' ELSE 'Si' END AS restriccion
 FROM measure WHERE region = 'EUROPE' GROUP BY fecha"""
_R = ", ".join(f"round({c}, 9) AS {c}" for c in NAMES)  # few rows per day: ties at six digits are common


def _days(t: Tables):
    return mn.daily_features(t.measure.where(F.col("region") == "EUROPE"), TRADE, FEATURES)


def _rounded(df):
    return df.withColumns({c: F.round(c, 9) for c in NAMES})


@query("daily_features", sql=f"SELECT fecha, anio, mes, {_R}, decision, restriccion FROM ({_DAYS}) d")
def daily_features(t: Tables):
    return _rounded(_days(t))


@query("daily_label_conflicts", sql="""
SELECT count(*) AS dias, count(*) FILTER (WHERE a <> z) AS conflictos FROM (SELECT fecha, min(decision) AS a, max(decision) AS z FROM measure GROUP BY fecha) d""")
def daily_label_conflicts(t: Tables):
    return mn.label_conflicts(t.measure)


@query("cv_folds", views=None, sql="""
SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1) % 10 AS INTEGER) AS fold FROM labels""")
def cv_folds(t: Tables):
    return mn.stratified_folds(t["labels"].select("doc_id", "quality"), "quality", ["doc_id"], 10)


@query("temporal_holdout", sql=f"""
SELECT conjunto, count(*) AS dias, count(*) FILTER (WHERE restriccion = 'Si') AS restringidos FROM (
 SELECT *, CASE WHEN anio <= 1999 THEN 'entrenamiento' ELSE 'prueba' END AS conjunto FROM ({_DAYS}) d) x GROUP BY conjunto""")
def temporal_holdout(t: Tables):
    return mn.temporal_holdout(_days(t), 1999).groupBy("conjunto").agg(
        F.count(F.lit(1)).alias("dias"), F.count_if(F.col("restriccion") == "Si").alias("restringidos"))


_SCORED = """SELECT d.doc_id, d.lang, l.quality AS label, (d.n_chars % 1000 + 0.5) / 1000 AS score,
 CASE WHEN (d.n_chars % 1000 + 0.5) / 1000 >= 0.5 THEN 1 ELSE 0 END AS prediction FROM labels l JOIN documents d ON d.doc_id = l.doc_id"""


def _scored(t: Tables):
    rows = t["labels"].join(t["documents"].select("doc_id", "lang", "n_chars"), "doc_id")
    score = (F.col("n_chars") % 1000 + F.lit(0.5).cast("double")) / 1000
    return rows.select("doc_id", "lang", F.col("quality").alias("label"), score.alias("score"), (score >= 0.5).cast("int").alias("prediction"))


@query("classification_metrics", views=None, sql=f"""
SELECT tp, fp, tn, fn, round((tp + tn)::DOUBLE / (tp + fp + tn + fn), 6) AS ca, round(tp::DOUBLE / (tp + fp), 6) AS precision, round(tp::DOUBLE / (tp + fn), 6) AS recall,
 round(2.0::DOUBLE * tp / (2 * tp + fp + fn), 6) AS f1, round(tn::DOUBLE / (tn + fp), 6) AS specificity,
 round((tp::DOUBLE * tn - fp::DOUBLE * fn) / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc, round(ll, 6) AS log_loss FROM (
 SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
  avg(-CASE WHEN label = 1 THEN ln(CAST(score AS DOUBLE)) ELSE ln(CAST(1 - score AS DOUBLE)) END) AS ll FROM ({_SCORED}) s) c""")
def classification_metrics(t: Tables):
    return mn.classification_metrics(_scored(t), D)


@query("auc_rank", views=None, sql=f"""
WITH r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS k FROM ({_SCORED}) s),
c AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n, sum(k) FILTER (WHERE label = 1) AS s FROM r)
SELECT p AS positivos, n AS negativos, round((s - p * (p + 1) / 2.0)::DOUBLE / (p::DOUBLE * n), 6) AS auc FROM c""")
def auc_rank(t: Tables):
    return mn.auc(_scored(t), D)


@query("roc_points", views=None, sql=f"""
SELECT CAST(score AS DOUBLE) AS threshold, round(sum(n) OVER w / (sum(n) OVER ())::DOUBLE, 6) AS fpr, round(sum(p) OVER w / (sum(p) OVER ())::DOUBLE, 6) AS tpr FROM (
 SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM ({_SCORED}) s GROUP BY score) c WINDOW w AS (ORDER BY score DESC)""")
def roc_points(t: Tables):
    return mn.roc_points(_scored(t), D)


@query("confusion_matrix", views=None, sql=f"""
SELECT lang, label, count(*) FILTER (WHERE prediction = 0) AS pred_0, count(*) FILTER (WHERE prediction = 1) AS pred_1 FROM ({_SCORED}) s GROUP BY lang, label""")
def confusion_matrix(t: Tables):
    return mn.confusion_matrix(_scored(t), ["lang"])


@query("ml_constant", sql=f"""
WITH c AS (SELECT restriccion, count(*) AS n FROM ({_DAYS}) d GROUP BY restriccion)
SELECT restriccion, n, round(n / (sum(n) OVER ())::DOUBLE, 6) AS prior, n = max(n) OVER () AS predicted FROM c""")
def ml_constant(t: Tables):
    return mn.constant_model(_days(t), "restriccion", D)


_LONG = " UNION ALL ".join(f"SELECT '{c}' AS variable, {c} AS v, restriccion AS y FROM d" for c in NAMES)


@query("feature_rank", sql=f"""
WITH d AS ({_DAYS}), x AS ({_LONG}), q AS (SELECT variable, quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.5) AS b, quantile_cont(v, 0.75) AS c FROM x GROUP BY variable),
cells AS (SELECT variable, CASE WHEN v > c THEN 3 WHEN v > b THEN 2 WHEN v > a THEN 1 ELSE 0 END AS bin, y, count(*)::DOUBLE AS n FROM x JOIN q USING (variable) WHERE v IS NOT NULL GROUP BY ALL),
w AS (SELECT *, sum(n) OVER (PARTITION BY variable) AS t, sum(n) OVER (PARTITION BY variable, bin) AS nb, sum(n) OVER (PARTITION BY variable, y) AS nc FROM cells)
SELECT variable, round((sum(-n / t * ln(nc / t)) - sum(-n / t * ln(n / nb))) / sum(-n / t * ln(nb / t)), 6) AS gain_ratio,
 round((1 - sum(n / t * nc / t)) - (1 - sum(n * n / (nb * t))), 6) AS gini FROM w GROUP BY variable""")
def feature_rank(t: Tables):
    return mn.feature_rank(_days(t), NAMES, "restriccion", D)


@query("histogram", views=None, sql="""
SELECT event_type, CAST(floor(value / 25) AS INTEGER) AS bin, count(*) AS n FROM events GROUP BY ALL""")
def histogram(t: Tables):
    return mn.histogram(t["events"], "value", 0.0, 25.0, ["event_type"])


@query("box_stats", sql="""
SELECT service, region, count(water_use) AS n, round(min(water_use), 6) AS min, round(quantile_cont(water_use, 0.25), 6) AS q1, round(quantile_cont(water_use, 0.5), 6) AS mediana,
 round(quantile_cont(water_use, 0.75), 6) AS q3, round(max(water_use), 6) AS max, round(avg(water_use), 6) AS media FROM measure GROUP BY service, region""")
def box_stats(t: Tables):
    return mn.box_stats(t.measure, "water_use", ["service", "region"], D)


def _z(c: str, source: str = "d") -> str:
    return f"({c} - (SELECT avg({c}) FROM {source})) / (SELECT stddev_pop({c}) FROM {source}) AS {c}"


_Z = ", ".join(_z(c) for c in NAMES)


@query("standardise", sql=f"WITH d AS ({_DAYS}), z AS (SELECT fecha, {_Z} FROM d) SELECT fecha, {_R} FROM z")
def standardise(t: Tables):
    return _rounded(mn.standardise(_days(t), NAMES).select("fecha", *NAMES))


_ASSIGNED = f"""WITH d AS ({_DAYS}), z AS (SELECT fecha, anio, mes, restriccion, {_Z} FROM d),
c AS (SELECT (mes - 1) // 4 AS cluster, {', '.join(f'avg({c}) AS {c}' for c in NAMES)} FROM z WHERE anio <= 1999 GROUP BY 1),
e AS (SELECT z.*, c.cluster, {' + '.join(f'(z.{c} - c.{c}) ** 2' for c in NAMES)} AS distancia FROM z JOIN c ON z.anio > 1999),
a AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY fecha ORDER BY distancia, cluster) = 1)"""


def _assigned(t: Tables):
    z = mn.standardise(_days(t), NAMES)
    train, later = z.where("anio <= 1999"), z.where("anio > 1999")
    centroids = train.groupBy(F.floor((F.col("mes") - 1) / 4).cast("int").alias("cluster")).agg(*[F.avg(c).alias(c) for c in NAMES])
    return mn.assign_centroid(later, centroids, NAMES)


@query("assign_centroid", sql=f"SELECT * FROM ({_ASSIGNED} SELECT fecha, CAST(cluster AS INTEGER) AS cluster, round(distancia, 6) AS distancia FROM a) x")
def assign_centroid(t: Tables):
    return _assigned(t).select("fecha", "cluster", F.round("distancia", D).alias("distancia"))


@query("cluster_profile", sql=f"""
SELECT * FROM ({_ASSIGNED} SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n, {', '.join(f'round(avg({c}), 6) AS {c}' for c in NAMES)},
 round(1e2 * count(*) FILTER (WHERE restriccion = 'Si') / count(*), 6) AS pct_positivo FROM a GROUP BY cluster) x""")
def cluster_profile(t: Tables):
    return mn.cluster_profile(_assigned(t), NAMES, "restriccion", "Si", digits=D)


LEARNED = ["almacenamiento_pct", "precipitacion_mm", "cobertura_pct", "mes"]  # the year and consumption describe a day, they are no features


def _scored_days(t: Tables, learner):
    return ml.cross_validate(_days(t), LEARNED, learner)


def _quality(t: Tables, learner):
    clipped = _scored_days(t, learner).withColumn("score", F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col("score"))))
    return mn.classification_metrics(clipped, D).join(F.broadcast(mn.auc(clipped, D)))


@query("ml_tree")
def ml_tree(t: Tables):
    return _quality(t, ml.tree())


@query("ml_forest")
def ml_forest(t: Tables):
    return _quality(t, ml.forest())


@query("ml_logit")
def ml_logit(t: Tables):
    return _quality(t, ml.logistic())


_COUNTS = f"""SELECT count(*) AS dias, count(*) FILTER (WHERE restriccion = 'Si') AS positivos, count(*) AS en_rango, count(*) AS segun_puntaje,
 least(count(*), 10) AS pliegues FROM ({_DAYS}) d WHERE restriccion IS NOT NULL"""


def _counts(t: Tables, learner):
    """What must hold of any learner's out-of-fold predictions: every day once, with its own label, a probability and the class it implies."""
    rows = _scored_days(t, learner)
    return rows.agg(
        F.count_distinct("fecha").alias("dias"), F.sum("label").alias("positivos"), F.count_if(F.col("score").between(0.0, 1.0)).alias("en_rango"),
        F.count_if((F.col("score") > 0.5) == (F.col("prediction") == 1)).alias("segun_puntaje"), F.count_distinct("fold").alias("pliegues"))


@query("ml_tree_counts", sql=_COUNTS)
def ml_tree_counts(t: Tables):
    return _counts(t, ml.tree())


@query("ml_forest_counts", sql=_COUNTS)
def ml_forest_counts(t: Tables):
    return _counts(t, ml.forest())


@query("ml_logit_counts", sql=_COUNTS)
def ml_logit_counts(t: Tables):
    return _counts(t, ml.logistic())


@query("ml_kmeans")
def ml_kmeans(t: Tables):
    rows, _ = ml.kmeans(_days(t), NAMES)
    return rows.select("fecha", "anio", "label", "cluster")


@query("ml_silhouette")
def ml_silhouette(t: Tables):
    rows, _ = ml.kmeans(_days(t), NAMES)
    return ml.silhouette_rows(rows).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette"))


@query("kmeans_checks", sql=f"SELECT count(*) AS dias, count(*) AS suma, 3::BIGINT AS grupos, 0::BIGINT AS en_otro FROM ({_DAYS}) d WHERE restriccion IS NOT NULL")
def kmeans_checks(t: Tables):
    rows, model = ml.kmeans(_days(t), NAMES)
    return ml.cluster_checks(rows, model.clusterCenters())


@query("silhouette_checks", sql=f"SELECT count(*) AS dias, count(*) AS en_rango, TRUE AS media_positiva FROM ({_DAYS}) d WHERE restriccion IS NOT NULL")
def silhouette_checks(t: Tables):
    rows, _ = ml.kmeans(_days(t), NAMES)
    return ml.silhouette_checks(rows)

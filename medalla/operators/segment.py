"""Entity segmentation: features, standardisation, K-Means, cluster reports.

MLlib does the fitting (k-means|| init, iterations with the k centres
broadcast and partial sums reduced); silhouette is MLlib's distributed
evaluator. Cluster ids are arbitrary, so labels are assigned by ranking the
clusters on their mean volume. Input rows are hash-partitioned on the entity
keys into a fixed number of partitions and sorted, so a fixed seed gives the
same model for the same data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medalla.functions.scalar import volume_band
from medalla.operators.ordering import null_safe
from medalla.session import materialize
from medalla.schema import CLUSTER_LABELS, ENTITY_FEATURES, ENTITY_KEYS

#: partitions of the K-Means input unless a call says otherwise: a parameter
#: of the model like its seed, so the cluster's settings do not change it
FIT_PARTITIONS = 32


def entity_features(entity: DataFrame, keys: Sequence[str] = ENTITY_KEYS,
                    features: Sequence[str] = ENTITY_FEATURES) -> DataFrame:
    """Keys + the numeric features, rows with a NULL feature dropped."""
    return entity.select(*keys, *features).na.drop(subset=list(features))


def yearly_features(silver: DataFrame, keys: Sequence[str] = ENTITY_KEYS, year: str = "anio") -> DataFrame:
    """The clustering features of every entity in each year, for clusters
    followed over time: one row per entity and year with complaints."""
    months = F.countDistinct("periodo_mes")
    return silver.groupBy(*keys, year).agg(
        F.count(F.lit(1)).alias("total_quejas"), F.countDistinct("producto").alias("productos_distintos"),
        F.countDistinct("motivo").alias("motivos_distintos"), months.alias("meses_con_quejas"),
        F.round(F.count(F.lit(1)) / months, 2).alias("promedio_quejas_por_mes"))


def standardize(df: DataFrame, features: Sequence[str] = ENTITY_FEATURES, suffix: str = "_z",
                keep: Sequence[str] = (), scale: int | None = 6) -> DataFrame:
    """(x - mean) / sample std per feature (0.0 where the std is 0 or
    undefined), the same transform as StandardScaler(withMean, withStd).
    The statistics are one aggregate, used as a scalar subquery."""
    st = df.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
                         *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(features)])).scalar()

    def z(i, c):
        m, s = st.getField(f"m{i}"), st.getField(f"s{i}")
        v = F.when(F.coalesce(s, F.lit(0.0)) == 0, F.lit(0.0)).otherwise((F.col(c) - m) / s)
        return (F.round(v, scale) if scale is not None else v).alias(f"{c}{suffix}")

    return df.select(*keep, *[z(i, c) for i, c in enumerate(features)])


def _stable_input(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


def fit_segments(features_df: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 20,
                 features: Sequence[str] = ENTITY_FEATURES, keys: Sequence[str] = ENTITY_KEYS,
                 partitions: int = FIT_PARTITIONS):
    """Fit assembler -> scaler -> K-Means; return (model, scored rows, the
    persisted fit input - unpersist it when the scored rows are done)."""
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster_id"),
    ])
    data = _stable_input(features_df, keys, partitions).persist()
    model = pipe.fit(data)
    return model, model.transform(data), data


def label_clusters(scored: DataFrame, volume: str = "total_quejas",
                   labels: Sequence[str] = CLUSTER_LABELS) -> DataFrame:
    """Renumber clusters by mean volume (0 = lowest) and attach the label of
    that position. The ordering table has k rows."""
    means = scored.groupBy("cluster_id").agg(F.avg(volume).alias("_mv"))
    order = means.select("cluster_id", (F.row_number().over(
        Window.orderBy(F.col("_mv").asc(), F.col("cluster_id").asc())) - 1).alias("cluster"))
    lab = F.element_at(F.array(*[F.lit(x) for x in labels]), F.least(F.col("cluster") + 1, F.lit(len(labels))))
    return scored.join(F.broadcast(order), "cluster_id").withColumn("cluster_label", lab)


def segment_entities(entity: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 20,
                     keys: Sequence[str] = ENTITY_KEYS, features: Sequence[str] = ENTITY_FEATURES) -> DataFrame:
    """Entity rows with ``cluster`` (0..k-1 by mean volume), ``cluster_label``
    and the standardised feature vector ``features``."""
    model, scored, data = fit_segments(entity_features(entity, keys, features), k, seed, max_iter, features, keys)
    centers = entity.sparkSession.createDataFrame(  # k rows
        [(i, [float(x) for x in c]) for i, c in enumerate(model.stages[-1].clusterCenters())],
        "cluster_id int, centro array<double>")
    out = materialize(label_clusters(scored).join(F.broadcast(centers), "cluster_id"), "segments")
    data.unpersist()
    return out


def clustering_table(segmented: DataFrame, stamp: bool = False,
                     keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    out = segmented.select(*keys, "total_quejas", "productos_distintos", "motivos_distintos",
                           "promedio_quejas_por_mes", "cluster", "cluster_label")
    return out.withColumn("fecha_clustering", F.current_timestamp()) if stamp else out


def cluster_profile(segmented: DataFrame) -> DataFrame:
    """Size and rounded feature means per cluster - one aggregate."""
    return segmented.groupBy("cluster", "cluster_label").agg(
        F.count(F.lit(1)).alias("entidades"),
        F.round(F.avg("total_quejas"), 2).alias("avg_quejas"),
        F.round(F.avg("productos_distintos"), 2).alias("avg_productos"),
        F.round(F.avg("motivos_distintos"), 2).alias("avg_motivos"),
        F.round(F.avg("promedio_quejas_por_mes"), 2).alias("avg_quejas_mes"))


def cluster_examples(segmented: DataFrame, n: int = 5, name: str = "nombre_entidad") -> DataFrame:
    """The n largest entities of every cluster (a per-cluster top-n, which
    Spark limits per partition before the shuffle)."""
    w = Window.partitionBy("cluster").orderBy(F.col("total_quejas").desc(), F.col(name).asc())
    return (segmented.select("cluster", "cluster_label", name, "total_quejas", "tipo_entidad_desc")
                     .withColumn("posicion", F.row_number().over(w))
                     .filter(F.col("posicion") <= n))


def cluster_centers(segmented: DataFrame, features: Sequence[str] = ENTITY_FEATURES) -> DataFrame:
    """The model's cluster centres in standardised space, one row per
    cluster that has members."""
    return segmented.groupBy("cluster").agg(F.first("centro").alias("_c")).select(
        "cluster", *[F.col("_c")[i].alias(f"centro_{c}") for i, c in enumerate(features)])


def segment_checks(segmented: DataFrame, k: int = 4, n: int = 5, name: str = "nombre_entidad") -> DataFrame:
    """Facts that hold for any right segmentation, as (control, valor):
    entities, members nearer to another centre than to their own, clusters
    out of the order of their mean volume, wrong labels, examples that are
    not the true top ``n``, and whether the silhouette recomputed from its
    definition equals the evaluator's. k rows and one aggregate each."""
    x = vector_to_array("features")

    def square(a, b):
        return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d)

    rows = segmented.select("cluster", "cluster_label", name, "total_quejas", "centro", x.alias("x"))
    own = rows.groupBy("cluster").agg(F.first("centro").alias("centro"), F.avg("total_quejas").alias("media"),
                                      F.first("cluster_label").alias("label"), F.count(F.lit(1)).alias("n"),
                                      F.array(*[F.sum(F.col("x")[i]) for i in range(len(ENTITY_FEATURES))]).alias("s"),
                                      F.sum(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)).alias("q"))
    others = own.agg(F.collect_list(F.struct("cluster", "centro", "n", "s", "q")).alias("all"))  # k entries
    every = rows.withColumn("all", others.scalar())
    far = every.select(F.sum((F.array_min(F.transform("all", lambda c: square(F.col("x"), c["centro"])))
                              < square(F.col("x"), F.col("centro")) - 1e-9).cast("long")).alias("valor"))
    w = Window.orderBy("cluster")  # k rows
    order = own.select((F.col("media") < F.lag("media").over(w)).alias("bad"), F.array_position(
        F.array(*[F.lit(v) for v in CLUSTER_LABELS]), F.col("label")).alias("at"), "cluster")
    # silhouette of squared distances: a point's mean distance to a cluster
    # follows from the cluster's count, sum and sum of squares
    xx = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    dist = F.transform("all", lambda c: F.struct(c["cluster"].alias("c"), c["n"].alias("n"), (
        c["n"] * xx + c["q"] - 2 * F.aggregate(F.zip_with("x", c["s"], lambda p, q: p * q), F.lit(0.0),
                                               lambda a, d: a + d)).alias("t")))
    d = every.select("cluster", dist.alias("d"))
    d = d.select(F.filter("d", lambda e: e["c"] == F.col("cluster"))[0].alias("o"), F.array_min(F.transform(F.filter(
        "d", lambda e: e["c"] != F.col("cluster")), lambda e: e["t"] / e["n"])).alias("b"))
    a = F.col("o.t") / (F.col("o.n") - 1)
    s = F.when(F.col("o.n") == 1, 0.0).otherwise((F.col("b") - a) / F.greatest(a, F.col("b")))
    equal = d.agg((F.abs(F.avg(s) - _silhouette(segmented)) < 1e-6).cast("long").alias("valor"))
    top = cluster_examples(segmented, n, name)
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("cluster").orderBy(
        F.col("total_quejas").desc(), F.col(name).asc()))).where(F.col("r") <= n)
    bad = ranked.join(top, ["cluster", name, "total_quejas"], "left_anti")
    parts = {
        "entidades": rows.agg(F.count(F.lit(1)).alias("valor")),
        "lejos_de_su_centro": far,
        "fuera_de_orden": order.agg(F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("valor")),
        "etiqueta_equivocada": order.agg(F.sum((F.col("at") != F.col("cluster") + 1).cast("long")).alias("valor")),
        "ejemplos_equivocados": bad.agg(F.count(F.lit(1)).alias("valor")),
        "silueta_igual": equal,
    }
    return reduce(DataFrame.unionByName, [
        v.select(F.lit(c).alias("control"), F.col("valor").cast("bigint").alias("valor")) for c, v in parts.items()])


def _silhouette(segmented: DataFrame) -> float:
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette")
    return float(ev.evaluate(segmented))


def cluster_quality(segmented: DataFrame) -> DataFrame:
    """Silhouette (squared Euclidean) of the segmentation as a one-row table."""
    s = _silhouette(segmented)
    k = segmented.select("cluster").distinct()
    return k.agg(F.count(F.lit(1)).alias("k")).select("k", F.lit(float(s)).alias("silhouette"))


def cluster_points(segmented: DataFrame, name: str = "nombre_entidad") -> DataFrame:
    return segmented.select(name, "total_quejas", "promedio_quejas_por_mes", "cluster")


def select_k(entity: DataFrame, ks: Sequence[int] = (2, 3, 4, 5, 6), seed: int = 42, max_iter: int = 20,
             keys: Sequence[str] = ENTITY_KEYS, features: Sequence[str] = ENTITY_FEATURES,
             parallel_fits: int = 3) -> DataFrame:
    """Silhouette per candidate k. Each fit is distributed; the independent
    fits of the handful of candidates are submitted concurrently."""
    from concurrent.futures import ThreadPoolExecutor

    # materialised once for all candidate fits
    feats = materialize(entity_features(entity, keys, features), "select-k-input")

    def score(k: int) -> tuple[int, float]:
        _, scored, data = fit_segments(feats, k, seed, max_iter, features, keys)
        ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster_id", metricName="silhouette")
        s = float(ev.evaluate(scored))
        data.unpersist()
        return int(k), s

    with ThreadPoolExecutor(max_workers=max(1, parallel_fits)) as pool:
        rows = list(pool.map(score, ks))
    return entity.sparkSession.createDataFrame(rows, "k int, silhouette double")


# ------------------------------------------------------------ volume bands
def with_volume_band(entity: DataFrame, volume: str = "total_quejas", out: str = "banda_volumen") -> DataFrame:
    return entity.withColumn(out, volume_band(volume))


def peer_benchmark(entity: DataFrame, group: str = "tipo_entidad_desc", metric: str = "total_quejas",
                   keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Each entity's metric against its peer group's mean and its ratio to
    it. The group means are a partial aggregate (skew-safe: a group holding
    a third of the entities is still pre-aggregated per partition), joined
    back on the group; NULL is a group like any other."""
    g = entity.groupBy(group).agg(F.avg(metric).alias("media_grupo"), F.count(F.lit(1)).alias("pares"))
    cols = list(dict.fromkeys([*keys, group, metric]))
    out = null_safe(entity.select(*cols), g, [group]).select(group, *[c for c in cols if c != group], "media_grupo", "pares")
    return (out
                  .withColumn("indice_vs_pares", F.round(F.col(metric) / F.col("media_grupo"), 4))
                  .withColumn("media_grupo", F.round("media_grupo", 4)))


def band_transitions(silver: DataFrame, keys: Sequence[str] = ("nombre_entidad",),
                     year: str = "anio") -> DataFrame:
    """Volume band of every entity per year and the count of moves from one
    year to the next (banda_origen -> banda_destino; a year without
    complaints breaks the chain). An entity's per-year rows are at
    most the number of years, so the per-entity lag window is bounded."""
    keys = list(keys)
    per = silver.groupBy(*keys, year).agg(F.count(F.lit(1)).alias("total_quejas"))
    per = per.withColumn("banda", volume_band("total_quejas"))
    w = Window.partitionBy(*keys).orderBy(year)
    moves = (per.withColumn("banda_origen", F.lag("banda").over(w))
                .withColumn("anio_origen", F.lag(year).over(w))
                .filter(F.col(year) - F.col("anio_origen") == 1))
    return moves.groupBy("banda_origen", F.col("banda").alias("banda_destino")).agg(
        F.count(F.lit(1)).alias("transiciones"))

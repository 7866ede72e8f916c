"""K-Means invariants and stream == batch."""

import os
import tempfile

from pyspark.sql import functions as F

from medalla.operators import marts, segment
from medalla.operators.conform import conform
from medalla.sources.star import raw_from_star
from medalla.streaming.monthly import monthly_counts, run_monthly_counts_stream

from conftest import SF_SMALL


def test_segmentation_invariants(spark):
    ent = marts.entity_metrics(conform(raw_from_star(spark, SF_SMALL)), rank=False)
    seg = segment.segment_entities(ent, k=4).cache()
    n = ent.count()
    prof = segment.cluster_profile(seg).orderBy("cluster").collect()
    assert sum(r.entidades for r in prof) == n
    assert [r.cluster for r in prof] == list(range(len(prof)))
    means = [r.avg_quejas for r in prof]
    assert means == sorted(means)
    assert [r.cluster_label for r in prof] == list(segment.CLUSTER_LABELS[:len(prof)])
    q = segment.cluster_quality(seg).first()
    assert -1.0 <= q.silhouette <= 1.0
    ex = segment.cluster_examples(seg, 5)
    assert ex.groupBy("cluster").count().agg(F.max("count")).first()[0] <= 5


def test_segmentation_is_repeatable(spark):
    ent = marts.entity_metrics(conform(raw_from_star(spark, SF_SMALL)), rank=False)
    a = {r.nombre_entidad: r.cluster for r in segment.clustering_table(segment.segment_entities(ent)).collect()}
    b = {r.nombre_entidad: r.cluster for r in segment.clustering_table(segment.segment_entities(ent)).collect()}
    assert a == b


def test_stream_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="stream-test-", dir="/tmp")
    out = run_monthly_counts_stream(spark, SF_SMALL, os.path.join(root, "out"), os.path.join(root, "chk"),
                                    file_glob="events.parquet")
    batch = monthly_counts(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "ts", "event_type", "value")
    cols = ["mes", "event_type", "eventos"]
    assert sorted(map(tuple, out.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_segmentation_layer_equals_direct_fit(spark):
    import __spark_entry__ as E

    q = E.queries()
    direct = sorted(map(tuple, q["segment_entities"](spark, SF_SMALL).collect()))
    layer = sorted(map(tuple, q["clustering_table"](spark, SF_SMALL).collect()))
    assert direct == layer

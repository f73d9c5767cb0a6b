import os
import tempfile

from tests.conftest import SF_SMALL


def test_score_stream(spark):
    from tessera.streaming.microbatch import score_stream
    base = tempfile.mkdtemp(prefix="tessera-stream-")
    q = score_stream(spark, SF_SMALL, "event_id long, user_id long, event_type string",
                     os.path.join(base, "sink"), os.path.join(base, "ckpt"), glob="events.parquet",
                     y="user_id", p="user_id")
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(base, "sink"))
    acc = out.filter("label = 'accuracy'").collect()
    assert acc and all(abs(r.precision - 1.0) < 1e-12 for r in acc)

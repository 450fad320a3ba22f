"""Streaming intake equals batch staging of the same submission files."""

import tempfile

from needbridge import operators as ops
from needbridge.sources import driver
from needbridge.streaming.intake import start_intake
from tests.conftest import SF_SMALL, rows


def test_intake_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="nb-stream-")
    first, again = driver.screening_batches(spark, SF_SMALL)
    first.write.mode("overwrite").parquet(f"{base}/in/batch1")
    q = start_intake(spark, "screenings", f"{base}/in/batch1", f"{base}/staged",
                     f"{base}/ckpt1")
    q.awaitTermination(120)
    # a second cadence lands later in its own folder
    again.write.mode("overwrite").parquet(f"{base}/in/batch2")
    q2 = start_intake(spark, "screenings", f"{base}/in/batch2", f"{base}/staged2",
                      f"{base}/ckpt2")
    q2.awaitTermination(120)
    got = spark.read.parquet(f"{base}/staged").unionByName(spark.read.parquet(f"{base}/staged2"))
    want = ops.stage_screenings(first.unionByName(again))
    assert rows(got.select(*want.columns)) == rows(want)

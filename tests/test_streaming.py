"""The streamed split: same rows as the batch split, and a restart from the
checkpoint neither loses nor duplicates output."""

from __future__ import annotations

import uuid

from strata.operators import silver
from strata.plans import fixtures as X
from strata.sources import storage
from strata.streaming import silver_stream as S
from tests.conftest import SF_SMALL


def _run(spark, base):
    bronze = silver.add_lineage(X.trips_stream(spark, SF_SMALL), X.SOURCE_FILE)
    q = S.start_silver_stream(bronze, f"{base}/out", f"{base}/checkpoint",
                              X.PERIOD_START, X.PERIOD_END)
    S.run_to_completion(q)


def test_stream_matches_batch_and_restarts_cleanly(spark):
    base = storage.new_dir(spark, "test-streams", uuid.uuid4().hex[:6])
    _run(spark, base)
    s = S.read_layer(spark, f"{base}/out", silver.SILVER).drop("year", "month")
    q = S.read_layer(spark, f"{base}/out", silver.QUARANTINE).drop("year", "month")
    batch_s, batch_q = silver.split(silver.add_lineage(X.trips(spark, SF_SMALL), X.SOURCE_FILE),
                                    X.PERIOD_START, X.PERIOD_END)
    assert sorted(s.collect(), key=repr) == sorted(batch_s.select(*s.columns).collect(), key=repr)
    assert q.count() == batch_q.count()
    # a restart with the same checkpoint finds nothing new: output unchanged
    _run(spark, base)
    assert S.read_layer(spark, f"{base}/out", silver.SILVER).count() == batch_s.count()
    assert S.read_layer(spark, f"{base}/out", silver.QUARANTINE).count() == batch_q.count()

"""The jobs end to end from their command line, on files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillwatch import jobs
from tillwatch.operators.quality import QualityError
from tillwatch.sources import events
from tillwatch.sources.events import AS_OF
from tillwatch.streaming import lake


def test_jobs_run_one_after_the_other(spark, sf, tmp_path):
    raw, out, history = (str(tmp_path / name) for name in ("raw", "out", "history"))
    txns = events.transactions(spark, sf)
    # Shift the data to end now, because the daily job and the checks look at the clock.
    shift = F.expr(f"current_timestamp() - TIMESTAMP '{AS_OF}'")
    recent = txns.withColumn("event_time", F.col("event_time") + shift)
    events.messages(recent, corrupt=True).drop("event_time").write.parquet(raw)
    csv = tmp_path / "customers.csv"
    csv.write_text("user_id,plan,avg_amount_30d,credit_limit\nuser_0001,BASIC,10,100\n")

    jobs.main(["init", "--lake", "job_lake", "--serving", "job_serving"])
    jobs.main(["customers", "--csv", str(csv), "--table", "job_lake.customers"])
    jobs.main(["score", "--messages", raw, "--out", out, "--checkpoint", str(tmp_path / "c"),
               "--customers", "job_lake.customers", "--risk", "job_lake.risk_profiles", "--once"])
    jobs.main(["history", "--messages", f"{out}/scored", "--path", history,
               "--checkpoint", str(tmp_path / "h"), "--once"])
    jobs.main(["profiles", "--transactions", f"{out}/transactions", "--min-count", "15",
               "--serving", "job_serving.risk_profiles", "--lake", "job_lake.risk_profiles"])
    jobs.main(["compact", "--path", history])

    served = spark.read.parquet(f"{out}/transactions")
    dead = spark.read.schema("value string").parquet(f"{out}/dlq")
    assert served.count() + dead.count() == txns.count()
    assert served.filter("plan = 'BASIC'").select("user_id").distinct().count() == 1
    assert lake.read_lake(spark, history).count() == served.count()
    assert spark.table("job_lake.risk_profiles").count() == 15
    # The newest event is half an hour old, so the hourly check speaks up.
    with pytest.raises(QualityError, match="freshness_lag"):
        jobs.main(["reconcile", "--transactions", f"{out}/transactions"])


def test_unknown_job_is_refused():
    with pytest.raises(SystemExit):
        jobs.main(["no-such-job"])

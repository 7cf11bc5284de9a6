"""A sink that shows committed rows only."""

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from brindle.plans import shared_dir
from brindle.sinks import deliver, delivered_files, read_delivered, sweep

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def staged(path):
    folder = path.removeprefix("file:")
    return [f for _, _, names in os.walk(f"{folder}/attempts") for f in names]


def test_rows_come_back(spark):
    path = shared_dir(spark, "delivery")
    df = spark.range(1000).selectExpr("id", "concat('r', id) AS t", "IF(id % 3 = 0, NULL, id * 1.5) AS x").repartition(5)
    deliver(df, path)
    assert sorted(map(tuple, read_delivered(spark, path, df.schema).collect())) == sorted(map(tuple, df.collect()))
    deliver(df.where("id < 10"), path)
    assert read_delivered(spark, path, df.schema).count() == 1010
    assert delivered_files(spark, path).agg(F.sum("rows")).first()[0] == 1010 and sweep(spark, path) == 0


def test_no_rows(spark):
    path = shared_dir(spark, "delivery")
    deliver(spark.range(0).toDF("id"), path)
    assert read_delivered(spark, path, "id bigint").count() == 0


def test_a_failed_job_publishes_nothing(spark):
    path = shared_dir(spark, "delivery")
    deliver(spark.range(5).toDF("id"), path)
    broken = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") < 3999, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))
    with pytest.raises(Exception):
        deliver(broken, path)
    assert read_delivered(spark, path, "id bigint").count() == 5
    assert sweep(spark, path) >= 0 and read_delivered(spark, path, "id bigint").count() == 5
    assert len(staged(path)) == delivered_files(spark, path).count()


def test_overwrite_is_refused(spark):
    path = shared_dir(spark, "delivery")
    deliver(spark.range(1).toDF("id"), path)
    with pytest.raises(Exception):
        spark.range(1).write.format("brindle_delivery").mode("overwrite").option("path", path).save()


def test_a_task_that_fails_once_doubles_no_row(tmp_path):
    """Tasks that write half of their rows, fail, and run again."""
    script = f"""
        import os, sys
        sys.path.insert(0, {REPO!r})
        from pyspark import TaskContext
        from brindle.session import local_session
        from brindle.sinks import deliver, read_delivered, sweep
        from brindle.plans import shared_dir

        spark = local_session(2, "delivery", "1g")
        path = shared_dir(spark, "delivery")

        def fails_once(batches):
            for place, batch in enumerate(batches):
                yield batch
                if place == 19 and TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2 == 0:
                    raise RuntimeError("first attempt")

        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5000")
        df = spark.range(0, 400_000, 1, 4).mapInArrow(fails_once, "id bigint")
        deliver(df, path)
        rows = sorted(r[0] for r in read_delivered(spark, path, "id bigint").collect())
        left = sweep(spark, path)
        again = read_delivered(spark, path, "id bigint").count()
        print("RESULT", rows == list(range(400_000)), left >= 1, again)
    """
    file = tmp_path / "job.py"
    file.write_text(textwrap.dedent(script).replace("local_session(2,", "local_session('2,3',"))
    done = subprocess.run([sys.executable, str(file)], capture_output=True, text=True, timeout=300)
    assert "RESULT True True 400000" in done.stdout, done.stdout[-2000:] + done.stderr[-3000:]

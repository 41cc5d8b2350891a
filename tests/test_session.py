import time

from pyspark.sql import functions as F

from tessera.session import CLEANUP, Scratch


def test_shuffle_files_go_with_the_write(spark):
    held = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        return {f.getName() for f in (files.apply(k) for files in [held.getAllFiles()] for k in range(files.size())) if f.getName().startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get(CLEANUP)
    got = Scratch(spark).write(spark.range(10_000).groupBy(F.xxhash64("id").alias("h")).count(), "counts")
    end = time.time() + 10
    while shuffles() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffles() - before
    assert got.count() == 10_000 and spark.conf.get(CLEANUP) == setting

from tidemark import session


def test_clean_deletes_only_what_this_application_made(spark, monkeypatch):
    monkeypatch.setattr(session, "_MADE", [])
    one = session.stored(spark.range(10).toDF("x"), "one")
    folder = one.inputFiles()[0].rsplit("/", 1)[0]
    other = f"{session.shared_folder(spark)}/kept"
    spark.range(3).write.mode("overwrite").parquet(other)
    assert one.count() == 10 and session.clean(spark) == 1 and session.clean(spark) == 0
    assert spark.read.parquet(other).count() == 3
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    assert not files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(files)


def test_rows_are_stored_without_a_shuffle_where_asked(spark):
    """Rows are written by the tasks that made them: three tasks, three files."""
    kept = session.stored(spark.range(0, 3000, 1, 3).toDF("x"), "kept", spread=False)
    assert len(kept.inputFiles()) == 3 and kept.count() == 3000


def test_tasks_of_a_shuffle_stay_small(spark):
    """Rows that compress well are not put together to a task of 64 MB of compressed bytes."""
    spark = session.tune(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        from pyspark.sql import functions as F
        rows = spark.range(0, 1_500_000, 1, 4).select(F.xxhash64("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        sorted_rows = rows.repartition("k").withColumn("p", F.spark_partition_id())
        largest = sorted_rows.groupBy("p").count().agg(F.max("count")).first()[0]
        assert largest < 500_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)

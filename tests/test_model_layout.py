from pyspark.sql import functions as F

from ridelake.sinks.writers import materialize_table


def test_model_tables_take_no_sample(spark, tmp_dir):
    """The rows are worked out once; a range layout would work them out twice."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).select(F.lit("2024-01-01").alias("day"), "id").mapInArrow(count, "day string, id long")
    materialize_table(df, f"{tmp_dir}/t", "day", ["id"])
    assert seen.value == 1000
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 1000

"""What ``tune`` sets, and what it leaves to the session."""

from orestrata.session import tune


def test_a_shuffle_has_many_partitions_before_small_ones_are_joined(spark):
    size, initial = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {key: spark.conf.get(key, None) for key in (size, initial)}
    try:
        for key in before:
            spark.conf.unset(key)
        tune(spark)
        assert int(spark.conf.get(initial)) >= 200 > int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert spark.conf.get(size) == "4m"
        spark.conf.set(size, "20KB")
        tune(spark)
        assert spark.conf.get(size) == "20KB"
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)

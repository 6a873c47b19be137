from __future__ import annotations

from tidemark.session import PARTITION_BYTES, checkpoint_dir, shuffle_partitions_for


def test_shuffle_width_follows_input_size():
    assert shuffle_partitions_for(10 * 1024 ** 2, cores=8) == 8
    assert shuffle_partitions_for(100 * 1024 ** 4, cores=8) == 100 * 1024 ** 4 // PARTITION_BYTES
    assert shuffle_partitions_for(PARTITION_BYTES * 10 + 1, cores=2) == 11


def test_checkpoint_folder_is_read_from_the_session(spark):
    first = checkpoint_dir(spark)
    assert first and checkpoint_dir(spark) == first
    assert spark.conf.get("spark.checkpoint.dir") == first

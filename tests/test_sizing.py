from salescope.session import scale_settings
from salescope.sources.parquet import bucket_count

TB = 1024 ** 4


def test_scale_settings_track_input_size():
    small = scale_settings(4 * 1024 * 1024, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = scale_settings(100 * TB, 8000)
    assert big["spark.sql.shuffle.partitions"] == "409600"
    mid = scale_settings(TB, 400)
    assert mid["spark.sql.shuffle.partitions"] == "4096"
    assert mid["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)


def test_bucket_count():
    assert bucket_count(20 * 1024 * 1024, 80) == 1
    assert 1500 < bucket_count(100 * TB, 120) < 2000

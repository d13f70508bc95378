import os

from lexspark.session import drop_written, shared_dir, written


def test_written_and_dropped(spark):
    df = written(spark.range(5), "t")
    assert df.count() == 5
    folder = shared_dir(spark).removeprefix("file://")
    made = [x for x in os.listdir(folder) if x.startswith("t-")]
    assert made and drop_written(spark) >= 1
    assert not [x for x in os.listdir(folder) if x in made]

"""Stored tables, text files and session handling."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from footfall import schemas, session
from footfall.sources import storage


def test_text_round_trip_of_several_files(spark, tmp_path):
    paths = []
    for n in (1, 2):
        df = spark.createDataFrame([(n, "soup, hot", 2), (n, "rice", 1)], schemas.MENTIONS)
        paths.append(str(tmp_path / f"x{n}"))
        storage.export_text(df, paths[-1])
    back = storage.import_text(spark, paths, schemas.MENTIONS)
    assert sorted(map(tuple, back.collect())) == [
        (1, "rice", 1), (1, "soup, hot", 2), (2, "rice", 1), (2, "soup, hot", 2),
    ]


def test_clustered_layout(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") % 50).alias("k"), F.rand(3).alias("v"))
    path = str(tmp_path / "c")
    storage.save_clustered(df, path, ["k"], [F.col("k"), F.col("v").desc()])
    back = spark.read.parquet(path)
    per_file = back.groupBy(F.input_file_name(), "k").count()
    assert back.count() == 2000 and per_file.count() == 50
    files = back.select(F.input_file_name().alias("f")).distinct().collect()
    for (name,) in files:
        rows = [tuple(r) for r in spark.read.parquet(name).collect()]
        assert rows == sorted(rows, key=lambda r: (r[0], -r[1]))


def test_conform_truncates(spark):
    df = spark.createDataFrame([(2.9, 1, "d", 3)], "cnt double, userid int, deviceid string, shopid int")
    assert schemas.conform(df, schemas.VISITS).first().cnt == 2


def fake_session(settings):
    class Fake:
        class conf:
            get = staticmethod(lambda key, default=None: settings.get(key, default))

    return Fake()


def test_shared_folder_comes_from_the_session():
    named = fake_session({"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.shared_dir(named) == "hdfs:///shared"


def test_shared_folder_without_the_setting_is_below_the_warehouse():
    plain = fake_session({"spark.sql.warehouse.dir": "hdfs:///warehouse"})
    assert session.shared_dir(plain) == "hdfs:///warehouse/_shared"


def test_release_deletes_the_run_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    kept = storage.materialise(spark.range(5).toDF("x"), "t")
    assert kept.count() == 5 and os.path.exists(session.run_dir(spark))
    session.release(spark)
    assert not os.path.exists(session.run_dir(spark))

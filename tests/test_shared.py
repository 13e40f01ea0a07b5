"""The shared folder comes from the session."""

from pathlib import Path
from urllib.parse import urlparse

from emberlake.sources.shared import scratch_path, shared_folder, stored_once


def test_folder_is_the_session_setting(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark).startswith(f"{folder}/emberlake/{spark.sparkContext.applicationId}/")
    assert scratch_path(spark) != scratch_path(spark)


def test_stored_once_keeps_the_rows_and_cleans_up(spark):
    frame = spark.range(100).selectExpr("id % 7 AS k", "id AS v").groupBy("k").sum("v")
    with stored_once(frame) as stored:
        assert sorted(stored.collect()) == sorted(frame.collect())
        assert "Exchange" not in stored._jdf.queryExecution().executedPlan().toString()
        folder = Path(urlparse(stored.inputFiles()[0]).path).parent
        assert folder.exists()
    assert not folder.exists()

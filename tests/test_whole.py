"""Plans do the whole job at sizes and inputs where a cut would show."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewave.plans import registry
from tidewave.streaming import blocks as streaming

SF = "/root/testdata/sf0.01"


def test_grid_holds_every_cell(spark):
    con = duckdb.connect()
    con.sql(f"create view part as select * from '{SF}/part.parquet'")
    found = sorted(map(tuple, registry.queries()["grid_left_join_whole"](spark, SF).collect()))
    assert found == sorted(con.sql(registry.oracle_sql()["grid_left_join_whole"]).fetchall())
    assert sum(r[2] is not None for r in found) == con.sql("select count(*) from part").fetchall()[0][0] == 2000


@pytest.mark.parametrize("name, batch", [("stream_mb_tumbling", streaming.day_counts), ("stream_lookback", streaming.sessions)])
def test_stream_has_open_windows_and_late_rows(spark, tmp_path, name, batch):
    events = spark.read.parquet(f"{SF}/events.parquet")
    want = batch(events)
    found = streaming.QUERIES[name](spark, SF)
    assert found.agg(F.sum("n")).first()[0] == events.count()
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()
    few = events.where("user_id < 20")
    for k in (2, 0, 1):  # the newest first: the other files are late
        few.where(f"event_id * 3 div {events.count()} = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path))
    late = spark.readStream.schema(few.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    got, want = streaming.drain(batch(late), "complete"), batch(few)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

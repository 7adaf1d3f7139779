from __future__ import annotations

from conftest import lines

from marquee.session import scratch_path
from marquee.sources.records import ingest_ratings
from marquee.streaming import read_ingested, start_ingest, stream_lines


def test_files_arriving_are_ingested_once(spark):
    landing = scratch_path(spark, "landing")
    out = scratch_path(spark, "out")
    ckpt = scratch_path(spark, "ckpt")

    lines(spark, "UserID,MovieID,Rating,Timestamp", "1,10,4.0,100", "2,10,bad,100").write.text(landing + "/a")
    start_ingest(stream_lines(spark, landing + "/*"), ingest_ratings, out, ckpt).awaitTermination()
    assert sorted(tuple(r) for r in read_ingested(spark, out).select("user_id", "rating").collect()) == [("1", 4.0)]

    # a new file arrives; a restart with the same checkpoint reads only the new file
    lines(spark, "3,11,5.0,200").write.text(landing + "/b")
    start_ingest(stream_lines(spark, landing + "/*"), ingest_ratings, out, ckpt).awaitTermination()
    got = sorted(tuple(r) for r in read_ingested(spark, out).select("user_id", "movie_id", "rating", "ts").collect())
    assert got == [("1", "10", 4.0, 100), ("3", "11", 5.0, 200)]
    reasons = sorted(r.reason for r in read_ingested(spark, out, "rejects").collect())
    assert reasons == ["bad_number", "header"]

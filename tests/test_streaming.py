"""Row-local work also runs on a stream, as it keeps no state."""

from lexifacet import And, Collection, Search
from lexifacet.operators.excerpts import excerpt
from lexifacet.sources.storage import new_folder


def test_match_on_a_stream(spark):
    folder = new_folder(spark, "stream")
    rows = [(1, "the key of it", 5), (2, "no such word", 6), (3, "key the", 7), (4, "the key", 50)]
    spark.createDataFrame(rows, "id long, text string, size long").write.parquet(folder)
    stream = spark.readStream.schema("id long, text string, size long").parquet(folder)
    c = Collection("stream", stream, "id", ("text",), ("size",))
    found = Search.over(c).where(And("the", "key")).rank("proximity").filter_range("size", 0, 9).found()
    shown = stream.select("id", excerpt("text", "key").alias("snippet"))
    for name, df in (("found", found), ("shown", shown)):
        query = df.writeStream.format("memory").queryName(name).outputMode("append").start()
        query.processAllAvailable()
        query.stop()
    assert sorted((x.id, x.weight) for x in spark.table("found").collect()) == [(1, 2), (3, 1)]
    assert ("<b>key</b> the") in [x.snippet for x in spark.table("shown").collect()]

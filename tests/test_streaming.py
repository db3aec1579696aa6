from shelfproof.operators import fused
from shelfproof.schema import EXCEPTION_SCHEMA, TABLE_SCHEMAS
from shelfproof.sources import tables as sources
from shelfproof.streaming import incremental
from tests.conftest import AS_OF
from tests.test_rules import messy


def test_stream_equals_batch(spark, make, tmp_path):
    t = messy(make)
    schema = TABLE_SCHEMAS["promotion_item"]
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    halves = t["promotion_item"].randomSplit([0.5, 0.5], seed=1)
    for half in halves:  # two arrivals, two runs of the same query
        half.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        incremental.append_worklist(incremental.item_exceptions(stream, t, AS_OF), out,
                                    state).awaitTermination()
    got = sources.read_frame(spark, out, EXCEPTION_SCHEMA, "parquet")
    want = fused.item_exceptions(fused.enrich(t), AS_OF)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

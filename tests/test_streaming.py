"""The incremental load gives the same rows as the batch enrichment."""

from pyspark.sql import functions as F

from delaylens.operators import clean
from delaylens.operators.features import enrich
from delaylens.session import scratch_path
from delaylens.sources import files
from delaylens.sources.flights import raw_flights
from delaylens.streaming.incremental import incremental_load

SF = "/root/testdata/sf0.001"


def test_incremental_matches_batch(spark):
    raw = raw_flights(spark, SF)
    src = scratch_path(spark, "stream-src")
    y = F.year("FlightDate")
    files.sink_csv(raw.where(y < 1998), src + "/part-a")
    files.sink_csv(raw.where(y >= 1998), src + "/part-b")
    out = scratch_path(spark, "stream-out")
    incremental_load(spark, src + "/*", raw.schema, out)
    got = spark.read.parquet(out)
    want = enrich(clean.drop_raw_dateparts(clean.ingest(raw)))
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0


def test_second_load_reads_only_new_files(spark):
    """With the same checkpoint nothing is loaded twice, and an idle load adds nothing."""
    raw = raw_flights(spark, SF)
    src, out, progress = (scratch_path(spark, n) for n in ("again-src", "again-out", "again-progress"))
    y, counts = F.year("FlightDate"), []
    files.sink_csv(raw.where(y < 1997), src + "/part-a")
    for arrival in (None, None, raw.where(y >= 1997)):
        if arrival is not None:
            files.sink_csv(arrival, src + "/part-b")
        incremental_load(spark, src + "/*", raw.schema, out, checkpoint=progress)
        counts.append(spark.read.parquet(out).count())
    assert counts == [raw.where(y < 1997).count(), counts[0], raw.where(y.isNotNull()).count()]

from stintwise.session import scratch_path
from stintwise.sources.tables import read_fact_table
from stintwise.streaming import season_stream

SEASON = """- entrantId: e{n}
  constructorId: c1
  drivers:
  - driverId: d1
    rounds: 1
  - driverId: d2
    rounds:
"""


def _write_season(spark, root, year, n):
    spark.createDataFrame([(SEASON.format(n=n),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{root}/{year}")


def test_stream_appends_new_seasons_once(spark):
    root, sink, ckpt = (scratch_path(spark, x) for x in ("src", "sink", "ckpt"))
    _write_season(spark, root, 2001, 1)
    q = season_stream(spark, root, sink, ckpt, pattern="*/*.txt", available_now=True)
    q.awaitTermination(120)
    assert read_fact_table(spark, sink).count() == 2
    _write_season(spark, root, 2002, 2)
    q = season_stream(spark, root, sink, ckpt, pattern="*/*.txt", available_now=True)
    q.awaitTermination(120)
    rows = sorted(tuple(r) for r in read_fact_table(spark, sink).collect())
    assert rows == [(2001, "e1", "c1", "d1", True, False), (2001, "e1", "c1", "d2", False, False),
                    (2002, "e2", "c1", "d1", True, False), (2002, "e2", "c1", "d2", False, False)]

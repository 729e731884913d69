from stintwise.plans.views import register_career_views
from tests.fixtures import EXPECTED


def test_views_answer_sql(spark, toy):
    names = register_career_views(toy, midseason=True)
    got = {tuple(r) for r in spark.sql(
        f"SELECT * FROM {names['transfers']} WHERE driverId = 'd1'").collect()}
    assert got == {("d1", "A", 2019, "B", 2019)}
    brk = {tuple(r) for r in spark.sql(f"SELECT * FROM {names['breaks']}").collect()}
    assert brk == EXPECTED["breaks"]
    n = spark.sql(f"SELECT count(*) FROM {names['debuts']}").first()[0]
    assert n == len(EXPECTED["debuts"])


def test_view_replaced_by_query_over_itself(spark, toy):
    """SRC-5: a view may be replaced by a query that reads its own previous definition."""
    from stintwise.operators import careers
    names = register_career_views(toy, midseason=False)
    view = names["gaps_unexplained"]
    spark.sql(f"""
        SELECT driverId, const_out, break_year, const_in, return_year, gap FROM (
          SELECT g.*, MIN(gap) OVER (PARTITION BY driverId, const_in, return_year) AS best
          FROM {view} g WHERE const_in IS NOT NULL) w
        WHERE gap = best""").createOrReplaceGlobalTempView(view.split(".")[-1])
    got = {tuple(r) for r in spark.sql(f"SELECT * FROM {view}").collect()}
    assert got == {tuple(r) for r in careers.breaks_nearest_return(toy).collect()}

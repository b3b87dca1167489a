"""What a search reads and shuffles: all first orders at once, and open queries only."""

import pytest

from hearthwatt.llm import neighbours
from hearthwatt.llm.queries import table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The plans of tables stored on the way, and the rows of those of the walk."""
    found, store = {}, neighbours.stored

    def watched(df, name="table", path=None):
        plan = df._jdf.queryExecution().executedPlan().toString()
        result = store(df, name, path)
        found.setdefault(name, []).append((plan, result.count() if name == "walk" else None))
        return result

    patch = pytest.MonkeyPatch()
    patch.setattr(neighbours, "stored", watched)
    try:
        found["rows"] = neighbours.nearest(table(spark, SF_DIR, "embeddings"), every=5, degree=8, beam=20).collect()
    finally:
        patch.undo()
    return found


def test_first_orders_share_a_shuffle(steps):
    plan, _ = steps["graph"][0]
    assert plan.count("rangepartitioning(") == 1


def test_links_are_trimmed_where_they_are_found(steps):
    for plan, _ in steps["graph"][1:]:
        assert plan.count("MapInArrow") == 2


def test_ended_queries_leave_the_walk(steps, spark):
    queries = table(spark, SF_DIR, "embeddings").where("vec_id % 5 = 0").count()
    rows = [n for _, n in steps["walk"]]
    assert rows[0] == queries and rows == sorted(rows, reverse=True) and rows[-1] < queries
    answers = [(r["query_id"], r["rank"]) for r in steps["rows"]]
    assert len(answers) == len(set(answers)) == 20 * queries

"""Pattern work on texts that are made from one small file."""

from hushwire.plans import catalogue

DATA = "/root/testdata/sf0.001"


def test_texts_are_searched_once_and_after_they_are_spread(spark):
    plan = catalogue.QUERIES["entity_enrich"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression") :]
    assert "regexp_extract_all" in plan and "regexp_extract_all" not in below and "Filter" not in plan


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "PII_ROWS", 10)
    texts = catalogue.pii(spark, DATA)
    rows = texts.count()
    assert rows == 150 and texts.rdd.getNumPartitions() == 15

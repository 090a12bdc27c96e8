"""What is read of a return, and what is shuffled to write one."""

from grantlens.plans import q_filings
from grantlens.sources import returns

ONE = "<Return><Filer><EIN>1</EIN><Phone>2</Phone></Filer><Other/><RecipientTable><Amt>3</Amt><Note>4</Note><USAddress><City>a</City><Door>5</Door></USAddress></RecipientTable></Return>"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_only_names_that_rules_ask_for_are_kept(spark):
    df = spark.createDataFrame([("/x/1.xml", ONE)], "path string, value string")
    group = {"tag": "RecipientTable", "texts": {"Amt": "3"}, "blocks": {"USAddress": {"City": "a"}}}
    assert rows(returns.parsed(df)) == [{"path": "/x/1.xml", "bad": False, "root": {}, "filer": {"EIN": "1"}, "groups": [group]}]
    assert rows(returns.parsed(df, {"filer": ["Phone"]}))[0]["filer"] == {"Phone": "2"}


def test_headers_alone(spark):
    df = spark.createDataFrame([("/x/1.xml", ONE), ("/x/2.xml", ONE[:-3]), ("/x/3.xml", "<Return/>"), ("/x/4.xml", None)], "path string, value string")
    found = {r["path"]: (r["bad"], r["root"], r["filer"], r["groups"]) for r in rows(returns.parsed(df, groups=False))}
    assert found == {"/x/1.xml": (False, {}, {"EIN": "1"}, []), "/x/2.xml": (True, None, None, []), "/x/3.xml": (False, {}, None, []), "/x/4.xml": (True, None, None, [])}


def test_scopes_are_held_for_few_returns_at_a_time(spark):
    df = spark.createDataFrame([(f"/x/{i}.xml", ONE) for i in range(2 * returns.HELD + 5)], "path string, value string").coalesce(1)
    assert returns.parsed(df).filter("filer['EIN'] = '1' AND size(groups) = 1").count() == 2 * returns.HELD + 5


def test_fields_are_shuffled_not_texts(spark, small):
    plan = q_filings.customer_returns(spark, small, variants=True)._jdf.queryExecution().optimizedPlan().toString()
    (grouped,) = [x for x in plan.splitlines() if "Aggregate" in x]
    assert "concat" not in grouped

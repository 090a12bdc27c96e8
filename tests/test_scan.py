"""Returns read many at a time: what each would give by itself."""

import sys

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grantlens.functions import fixed
from grantlens.plans import q_filings, stages
from grantlens.sources import returns, scan

GROUP = "<RecipientTable><RecipientBusinessName><BusinessNameLine1Txt> A &amp;amp; B &lt;c&gt; </BusinessNameLine1Txt></RecipientBusinessName><USAddress><City>x</City><City>y</City></USAddress><Amt>1</Amt></RecipientTable>"
HEAD = "<Filer><EIN>1</EIN><BusinessName><BusinessNameLine1Txt/><BusinessNameLine1>F</BusinessNameLine1></BusinessName></Filer>"
PLAIN = [
    f'<?xml version="1.0"?><Return xmlns="u">{HEAD}{GROUP}</Return>', f"<Return>{HEAD}<TaxYr> 2001 <b/> 2</TaxYr><TaxYr>3</TaxYr>{GROUP}{GROUP}</Return>", "<Return/>", " <Return>x</Return>\n ", "\ufeff<Return><Filer/></Return>",
    f'<Return xmlns="u" xmlns:xsi="w" xsi:schemaLocation="u a.xsd">{HEAD}<IRS990PF documentId="ab" /><xsi:Filer/><Amt/></Return>', f"<Return xmlns:r='u'>{HEAD}<r:Filer><EIN>2</EIN></r:Filer></Return>", '<r:Return xmlns:r="u"><r:Filer><r:EIN>5</r:EIN><EIN>6</EIN></r:Filer></r:Return>',
    "<Return><Filer><EIN>&#49;&#x32;&#38;lt;&#32;</EIN></Filer></Return>", "<Return><Filer><EIN>a > b ' \" c</EIN></Filer></Return>", "<Filer><EIN>1</EIN><Filer><EIN>2</EIN></Filer></Filer>", "<RecipientTable><Amt>1</Amt></RecipientTable>",
    "<Return><Filer><Name><Name><BusinessNameLine1>in</BusinessNameLine1></Name><BusinessNameLine1>out</BusinessNameLine1></Name></Filer></Return>", "<Return><RecipientTable/><GrantOrContributionPdDurYrGrp><Amt>9</Amt><AddressUS/></GrantOrContributionPdDurYrGrp></Return>",
]
ODD = [
    '<Return><Filer a="x>y"><EIN>1</EIN></Filer></Return>',
    "<Return><!-- <Filer/> --><Filer><EIN><![CDATA[<1>]]></EIN></Filer></Return>", '<!DOCTYPE r [<!ENTITY e "v">]><Return><Filer><EIN>&e;</EIN></Filer></Return>', "<Return><?p <Filer/> ?><Filer/></Return>", "<Return><Filer><EIN>a\r\nb</EIN></Filer></Return>",
    '<Return><Filer xmlns="v"/><q:Filer xmlns:q="w"/></Return>', '<a:Return xmlns:a="u" xmlns:b="u"><b:Filer/></a:Return>', """<Return><TaxYr a='"' b=">">7</TaxYr></Return>""", "<Return><RecipientTable><Amt>1</Amt><RecipientTable><Amt>2</Amt></RecipientTable></RecipientTable></Return>",
    "<Return><RecipientTable><USAddress><ForeignAddress><City>q</City></ForeignAddress></USAddress></RecipientTable></Return>",
]
BAD = [None, "", "x", "<Return>", "<Return></return>", "<Return/><Return/>", "<Return>&no;</Return>", "<Return", "</Return>", "<p:Return/>", "<Return>\x01</Return>", PLAIN[0][:-9], "<?xml", "<Return a='1' a='2'/>"]


def table(batches):
    text = lambda m: None if m is None else dict(m)
    one = lambda r: (r["bad"], text(r["root"]), text(r["filer"]), [(g["tag"], text(g["texts"]), {k: text(v) for k, v in g["blocks"]}) for g in r["groups"]])
    return {r["path"]: one(r) for b in batches for r in b.to_pylist()}


def both(values, groups=True):
    batch = pa.RecordBatch.from_arrays([pa.array(list(map(str, range(len(values))))), pa.array(values, pa.string())], ["path", "value"])
    read, many = returns.Scopes(returns.NAMES, groups), scan.Scan(returns.NAMES, fixed.GROUPS if groups else [], returns.BLOCKS)
    return table(returns._read(many, read, batch)), table([returns._scopes(read, batch)])


@pytest.mark.parametrize("groups", [True, False])
def test_many_returns_are_read_as_each_by_itself(groups):
    for values in (PLAIN + ODD + BAD, PLAIN, ODD, BAD, [], PLAIN * 40):
        together, alone = both(values, groups)
        assert together == alone
        assert len(together) == len(values)


def test_plain_returns_are_not_parsed_one_by_one():
    many = scan.Scan(returns.NAMES, fixed.GROUPS, returns.BLOCKS)
    found, bad, odd = many(pa.array(PLAIN + BAD, pa.string()))
    assert sorted(i for rows, *_ in found for i in rows) == list(range(len(PLAIN)))
    assert sorted([*bad, *odd]) == list(range(len(PLAIN), len(PLAIN + BAD)))


NAMES = ["Return", "Filer", "EIN", "BusinessName", "BusinessNameLine1", "Name", "RecipientTable", "GrantOrContriPaidDuringYear", "USAddress", "ForeignAddress", "City", "Amt", "RecipientBusinessName", "BusinessNameLine1Txt", "x:Amt", "Other"]
TREES = st.recursive(
    st.tuples(st.sampled_from(NAMES), st.sampled_from(["", " a ", "&amp;", "&#65;", "<!--c-->", "'"]), st.just([]), st.booleans()),
    lambda inner: st.tuples(st.sampled_from(NAMES), st.sampled_from(["", "b", ">"]), st.lists(inner, max_size=5), st.booleans()), max_leaves=25,
)


def written(tree, root=True):
    name, text, inner, spaced = tree
    space = ' xmlns="u" xmlns:x="v"' if root else " " * spaced
    if not text and not inner:
        return f"<{name}{space}/>"
    return f"<{name}{space}>{text}{' '.join(written(t, False) for t in inner)}</{name}>"


@given(st.lists(TREES, max_size=6), st.booleans())
@settings(max_examples=150, deadline=None)
def test_any_trees(trees, cut):
    values = [written(t) for t in trees]
    if cut and values:
        values[0] = values[0][:-1]
    together, alone = both(values)
    assert together == alone


def test_white_space_is_what_python_strips():
    points = [c for c in map(chr, range(0x20, sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000] + ["\t", "\n"]
    assert scan.unescaped(pa.array([f"{c}a{c}" for c in points])).to_pylist() == [f"{c}a{c}".strip() for c in points]


def test_portions_by_bytes(monkeypatch):
    monkeypatch.setattr(returns, "HELD_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", "c", "d", "e"]), pa.array(["12345", "12345", "1", None, "1" * 50])], ["path", "value"])
    assert [p.column("path").to_pylist() for p in returns._portions(batch)] == [["a", "b"], ["c", "d"], ["e"]]


def test_an_address_block_is_looked_up_once(spark, small):
    plan = returns.grants(returns.filings(q_filings.customer_returns(spark, small)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RecipientForeignAddress") == plan.count("RecipientUSAddress") == 1


def test_filings_look_up_the_names_asked_for(spark):
    df = spark.createDataFrame([("/x/1.xml", PLAIN[0])], "path string, value string")
    (row,) = returns.filings(df, names={"group": fixed.AMOUNTS, "block": []}).select("filer_name", "groups").collect()
    assert [g.asDict(recursive=True) for g in row["groups"]] == [{"tag": "RecipientTable", "texts": {"Amt": "1"}, "blocks": {"USAddress": {}}}]
    assert row["filer_name"] == "F"


def test_the_log_of_a_counted_run_has_the_columns_of_a_log(spark, small, monkeypatch):
    seen = []
    count = stages.recorded
    monkeypatch.setattr(stages, "recorded", lambda log: seen.append(log.columns) or count(log))
    q_filings.run_counters(spark, small)
    assert seen == [["xml_file", "filer_name", "filer_ein", "filer_support_org", "return_year", "status", "grant_bearing"]]

"""XML returns of both generations, and odd ones."""

import pytest

from grantlens.sources import returns

HEAD = '<?xml version="1.0"?><Return xmlns="http://example.org/r"><ReturnHeader>{header}</ReturnHeader><ReturnData>{data}</ReturnData></Return>'
FILER = "<Filer><EIN>012345678</EIN><BusinessName><BusinessNameLine1Txt>New Fund</BusinessNameLine1Txt></BusinessName></Filer>"
OLD_FILER = "<Filer><EIN>000000009</EIN><Name><BusinessNameLine1>Old Fund</BusinessNameLine1></Name></Filer>"
FILES = {
    "201901_public.xml": HEAD.format(header=f"<ReturnTs>2019-05-01T10:00:00-05:00</ReturnTs>{FILER}<TaxYr>2018</TaxYr>", data="""
      <IRS990PF><Supp><GrantOrContributionPdDurYrGrp><RecipientBusinessName><BusinessNameLine1Txt> A &amp; M College </BusinessNameLine1Txt></RecipientBusinessName>
      <RecipientUSAddress><AddressLine1Txt>1 Road</AddressLine1Txt><CityNm>Town</CityNm><StateAbbreviationCd>TX</StateAbbreviationCd><ZIPCd>01234</ZIPCd></RecipientUSAddress>
      <GrantOrContributionPurposeTxt>Science</GrantOrContributionPurposeTxt><Amt>0200</Amt><Amt>9</Amt></GrantOrContributionPdDurYrGrp>
      <GrantOrContributionPdDurYrGrp><RecipientPersonNm>Jo Doe</RecipientPersonNm><RecipientForeignAddress><ProvinceOrStateNm>ON</ProvinceOrStateNm><CountryCd>CA</CountryCd></RecipientForeignAddress><Amt/><Amount>5</Amount></GrantOrContributionPdDurYrGrp></Supp></IRS990PF>"""),
    "7_old.xml": HEAD.format(header=f"<ReturnTs>garbage</ReturnTs>{OLD_FILER}<TaxPeriodEndDate>2009-12-31</TaxPeriodEndDate>", data="""
      <RecipientTable><RecipientNameBusiness><BusinessNameLine1>Old School</BusinessNameLine1></RecipientNameBusiness><EINOfRecipient>000000001</EINOfRecipient>
      <AddressUS><City>Ville</City><State>NY</State><ZIPCode>00501</ZIPCode></AddressUS><AmountOfCashGrant>12</AmountOfCashGrant><PurposeOfGrant>aid</PurposeOfGrant></RecipientTable>
      <GrantOrContriPaidDuringYear><RecipientBusinessName><BusinessNameLine1Txt></BusinessNameLine1Txt><BusinessNameLine1>Second Try</BusinessNameLine1></RecipientBusinessName><Amount>1</Amount></GrantOrContriPaidDuringYear>
      <Hospital170b1Aiii> x </Hospital170b1Aiii>"""),
    "nofiler.xml": HEAD.format(header="<TaxYr>2018</TaxYr>", data="<RecipientTable><CashGrantAmt>1</CashGrantAmt></RecipientTable>"),
    "cut.xml": HEAD.format(header=FILER, data="<RecipientTable><CashGrantAmt>1</CashGrantAmt></RecipientTable>")[:-30],
    "prefixed.xml": f'<r:Return xmlns:r="http://example.org/r"><r:ReturnHeader>{FILER.replace("</", "</r:").replace("<", "<r:").replace("<r:/r:", "</r:")}</r:ReturnHeader><r:ReturnData><r:RecipientTable><r:CashGrantAmt>3</r:CashGrantAmt></r:RecipientTable></r:ReturnData></r:Return>',
    "empty.xml": HEAD.format(header=FILER, data=""),
}


@pytest.fixture(scope="module")
def read(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("xml")
    for i, (name, value) in enumerate(FILES.items()):
        folder = top / f"d{i % 2}"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(value)
    return returns.filings(returns.read_returns(spark, str(top))).cache()


def test_headers(read):
    rows = {r["xml_file"]: r for r in read.drop("return_ts").collect()}
    assert set(rows) == set(FILES) - {"nofiler.xml"}
    new, old = rows["201901_public.xml"], rows["7_old.xml"]
    assert (new["filer_name"], new["filer_ein"], new["return_year"], new["submission_id"]) == ("New Fund", "012345678", "2018", "201901")
    assert (old["filer_name"], old["filer_ein"], old["return_year"], old["submission_id"]) == ("Old Fund", "000000009", "2009", "7")
    assert (new["filer_support_org"], old["filer_support_org"]) == (False, True)
    assert rows["cut.xml"]["status"] == "malformed"
    assert rows["prefixed.xml"]["filer_ein"] == "012345678"
    stamps = {r["xml_file"]: r["ts"] for r in read.selectExpr("xml_file", "date_format(return_ts, 'yyyy-MM-dd HH:mm') AS ts").collect()}
    assert stamps["201901_public.xml"] == "2019-05-01 15:00"
    assert stamps["7_old.xml"].startswith("0001")


def test_grants(read):
    rows = {(r["xml_file"], r["pos"]): r for r in returns.grants(read).collect()}
    assert len(rows) == 5
    a, b = rows["201901_public.xml", 0], rows["201901_public.xml", 1]
    assert (a["grantee"], a["grantee_addr1"], a["grantee_state"], a["grantee_zip"], a["grantee_country"], a["grant_amount"], a["grant_purpose"]) == ("A & M College", "1 Road", "TX", "01234", "US", "0200", "Science")
    # an empty element that exists wins over a filled one of a later name
    assert (b["grantee"], b["grantee_state"], b["grantee_country"], b["grantee_addr_type"], b["grant_amount"]) == ("Jo Doe", "ON", "CA", "Foreign", "")
    # groups come by tag, then by document; names fall through empty elements
    c, d = rows["7_old.xml", 0], rows["7_old.xml", 1]
    assert (c["grantee"], c["grant_amount"], c["grantee_addr_type"]) == ("Second Try", "1", "")
    assert (d["grantee"], d["recipient_ein"], d["grantee_city"], d["grantee_zip"], d["grant_amount"], d["grant_purpose"]) == ("Old School", "000000001", "Ville", "00501", "12", "aid")
    assert rows["prefixed.xml", 0]["grant_amount"] == "3"


def test_flagged_filers_can_go(read):
    assert {r["xml_file"] for r in returns.grants(read, keep_flagged=False).collect()} == {"201901_public.xml", "prefixed.xml"}


def test_recipient_filter(read):
    assert [r["grantee"] for r in returns.to_recipients(returns.grants(read)).collect()] == ["A & M College"]

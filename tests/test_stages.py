"""The stages end to end on written returns."""

import pytest
from pyspark.sql import functions as F

from grantlens.__main__ import main
from grantlens.operators import provider
from grantlens.plans import stages
from grantlens.sources import tables

RETURN = "<Return><ReturnHeader><ReturnTs>2020-01-01T00:00:00Z</ReturnTs><Filer><EIN>01</EIN><BusinessName><BusinessNameLine1Txt>Fund</BusinessNameLine1Txt></BusinessName></Filer><TaxYr>2019</TaxYr></ReturnHeader><ReturnData>{}</ReturnData></Return>"
GRANT = "<RecipientTable><RecipientBusinessName><BusinessNameLine1Txt>{}</BusinessNameLine1Txt></RecipientBusinessName><USAddress><CityNm>{}</CityNm><StateAbbreviationCd>{}</StateAbbreviationCd></USAddress><CashGrantAmt>{}</CashGrantAmt><PurposeOfGrantTxt>{}</PurposeOfGrantTxt></RecipientTable>"
DIM = "canonical_id,grantee_normalized,state,country,entity_class,city\n007,Grace College,OH,US,IPEDS-US,Akron\nSG00004,Other University,TX,US,non-IPEDS-US,Waco\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "xml").mkdir()
    one = GRANT.format("The Grace College, Inc.", "Akron", "OH", "100", "Scholarships") + GRANT.format("Unknown University", "X", "TX", "$50", "") + GRANT.format("A Hospital", "X", "TX", "1", "x")
    (tmp_path / "xml/1_public.xml").write_text(RETURN.format(one))
    (tmp_path / "xml/2_public.xml").write_text(RETURN.format(GRANT.format("GRACE  COLLEGE", "Akron", "OH", "5", "scholarships ")))
    (tmp_path / "xml/3_public.xml").write_text("<Return><broken")
    (tmp_path / "dim.csv").write_text(DIM)
    return tmp_path


def test_command_line(spark, folder):
    args = ["--xml", f"{folder}/xml", "--dim", f"{folder}/dim.csv", "--out", f"{folder}/out", "--log", f"{folder}/log", "--stamp"]
    main([*args, "s1"])
    rows = tables.read_text_table(spark, f"{folder}/out/grantsdb/stamp=s1", tables.GRANTS).collect()
    assert sorted((r["grantee"], r["canonical_id"], r["tag"], r["grant_amount"]) for r in rows) == [("GRACE  COLLEGE", "007", "finaid", "5"), ("The Grace College, Inc.", "007", "finaid", "100"), ("Unknown University", "NA", "general", "$50")]
    assert spark.read.parquet(f"{folder}/log").count() == 3
    (folder / "xml/4_public.xml").write_text(RETURN.format(GRANT.format("Grace College", "Akron", "OH", "7", "Music")))
    main([*args, "s2"])
    rows = tables.read_text_table(spark, f"{folder}/out/grantsdb/stamp=s2", tables.GRANTS).collect()
    assert [(r["xml_file"], r["tag"]) for r in rows] == [("4_public.xml", "hass")]
    audit = spark.read.csv(f"{folder}/out/match_audit/stamp=s1", header=True).collect()
    assert [(r["disposition"], r["n_grants"], r["total_amount"]) for r in audit][0] == ("matched", "1", "100.0")


def test_verdicts_mint_review_and_match(spark, folder):
    dim = tables.read_text_table(spark, f"{folder}/dim.csv", tables.DIM)
    said = {
        "Nova Polytechnic": ("us", "Nova Polytechnic", ""), "NOVA POLYTECHNIC INC": ("us", "Nova  Polytechnic", ""), "Universität Ost": ("foreign", "East University Munich", "Germany"),
        "Grace Bible College Fund": ("us", "Grace College", ""), "Some Church": ("not_applicable", "", ""), "Silent": None,
    }
    grants = spark.createDataFrame([(f"{i}.xml", n, "München" if "Ost" in n else "Reno", "" if "Ost" in n else "NV", "DE" if "Ost" in n else "US", "80331" if "Ost" in n else "89501", "10", i) for i, n in enumerate(said)], "xml_file string, grantee string, grantee_city string, grantee_state string, grantee_country string, grantee_zip string, grant_amount string, pos int")
    grants = grants.select(*[F.col(c) if c in grants.columns else F.lit("").alias(c) for c in tables.PARSED.names], "pos")

    def answer(items):
        return [{"qid": x["qid"], "v_type": said[x["name"]][0], "v_name": said[x["name"]][1], "v_country": said[x["name"]][2]} for x in items if said[x["name"]]]

    got = stages.match(grants, dim, answers=lambda left: provider.ask(left, answer, "qid long,v_type string,v_name string,v_country string", 2))
    ids = {r["grantee"]: r["canonical_id"] for r in got.grants.collect()}
    assert ids["Nova Polytechnic"] == ids["NOVA POLYTECHNIC INC"]
    assert {ids["Nova Polytechnic"], ids["Universität Ost"]} == {"SG00005", "SG00006"}
    assert ids["Grace Bible College Fund"] == "007"
    assert ids["Some Church"] == ids["Silent"] == "NA"
    new = {r["grantee_normalized"]: r for r in got.new_institutions.collect()}
    assert set(new) == {"Nova Polytechnic", "East University Munich (Foreign)"} or set(new) == {"Nova  Polytechnic", "East University Munich (Foreign)"}
    assert new["East University Munich (Foreign)"]["entity_class"] == "foreign"
    assert [r["disposition"] for r in got.audit.collect()][:2] == ["new_mint", "new_mint"]


def test_requests_are_chunked_and_retried():
    assert provider.chunks([5, 5, 5, 100, 1], 10, 2) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert provider.chunks([]) == []
    tries, waits = [], []

    def call():
        tries.append(1)
        if len(tries) < 3:
            raise ValueError
        return "ok"

    assert provider.retried(call, sleep=waits.append) == "ok"
    assert waits == [3.0, 6.0]

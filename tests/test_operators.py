"""Operators on small tables: text, similarity, matching, minting, sources, sinks, streams."""

import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grantlens.functions import labels, similarity, text
from grantlens.functions.numbering import numbered
from grantlens.operators import alike, dedupe, matching, reporting, tagging, verdicts
from grantlens.plans import registry
from grantlens.sources import index, sinks, tables
from grantlens.streaming import ingest

words = st.text(alphabet="ab cd", max_size=18)


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "plain", "stripped"),
    [
        ("The Univ. of St. Élan & Co, Inc.", "THE UNIV OF ST ÉLAN AND CO INC", "UNIVERSITY OF SAINT ÉLAN AND CO"),
        (None, "", ""),
        ("  Board of Trustees of  X_Y\tCollege ", "BOARD OF TRUSTEES OF X_Y COLLEGE", "X_Y COLLEGE"),
        ("O'Neil\u00a0Comm. College", "O NEIL COMM COLLEGE", "O NEIL COMMUNITY COLLEGE"),
        ("straße", "STRASSE", "STRASSE"),
    ],
)
def test_norm(spark, raw, plain, stripped):
    assert one(spark, text.norm(F.col("c")), c=raw) == plain
    assert one(spark, text.norm(text.norm(F.col("c"))), c=raw) == plain
    assert one(spark, text.strip_wrappers(F.col("c")), c=raw) == stripped


def test_small_functions(spark):
    assert one(spark, text.qnorm(F.col("c")), c="  A \t b\n") == "a b"
    assert one(spark, text.money(F.col("c")), c="$ 1,234.50") == 1234.5
    assert one(spark, text.money(F.col("c")), c="abc") is None
    assert one(spark, text.money(F.col("c")), c="") == 0
    assert one(spark, text.shard(F.col("c"), 7), c="123") == zlib.crc32(b"123") % 7
    assert one(spark, text.keyword_filter(F.col("c")), c="Some College Prep Academy") is False
    assert one(spark, text.keyword_filter(F.col("c")), c="Caltech") is True
    assert one(spark, text.keyword_filter(F.col("c")), c=None) is False


@given(words, words)
@settings(max_examples=100, deadline=None)
def test_similarity_is_symmetric_and_bounded(a, b):
    for scorer in similarity.SCORERS.values():
        assert scorer(a, b) == pytest.approx(scorer(b, a))
        assert 0 <= scorer(a, b) <= 100
    if a.split():
        assert similarity.by_token_set(a, a) == 100


def test_both_forms_agree(spark):
    names = ["UNIVERSITY OF X", "X UNIVERSITY", "UNIVRESITY X", "", "A", "A A B", "B A", "ÉCOLE 🙂 X"]
    pairs = spark.createDataFrame([(a, b) for a in names for b in names], "a string, b string")
    forms = {"ratio": similarity.ratio, "token_sort": similarity.token_sort_ratio, "token_set": similarity.token_set_ratio}
    for kind, form in forms.items():
        for r in pairs.select("a", "b", form(F.col("a"), F.col("b")).alias("x"), similarity.scores(kind)("a", "b").alias("y")).collect():
            assert r["x"] == pytest.approx(r["y"]), (kind, r["a"], r["b"])
    assert similarity.plain("KITTEN", "SITTING") == pytest.approx(800 / 13)


def test_numbers_without_gaps(spark):
    df = spark.range(0, 400_000, 7).withColumn("p", F.col("id") * 3)
    out = numbered(df.repartition(5), "p", "n")
    assert out.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, df.count(), df.count())
    assert out.filter("n <> id / 7 + 1").count() == 0


DIM = [
    ("1", "State University-Main Campus", "TX", "Austin", "IPEDS-US"), ("2", "State University-North", "TX", "Dallas", "IPEDS-US"), ("3", "State University System Office", "TX", "Austin", "IPEDS-US"),
    ("4", "Grace College", "OH", "Akron", "IPEDS-US"), ("5", "Grace College", "IN", "Gary", "IPEDS-US"), ("6", "Saint Mary Polytechnic Institute", "NY", "Troy", "IPEDS-US"),
    ("7", "Foreign Polytechnic Academy (Foreign)", "", "Paris", "foreign"), ("SG00041", "Wonderland Conservatory", "CA", "Ojai", "non-IPEDS-US"), ("6", "St Mary Poly", "NY", "Troy", "IPEDS-US"), ("NA", "not one", "", "", ""),
]
ASKED = [
    ("State University", "Austin", "TX", "1", "exact"),  # the prefix's seat
    ("State University Foundation", "Dallas", "TX", "2", "exact"),  # by city
    ("Grace College", "", "OH", "4", "exact"),
    ("Grace College", "", "WA", None, "unresolved"),  # two states
    ("The Wonderland Conservatory, Inc.", "", "NV", "SG00041", "exact"),  # a single name, another state
    ("Saint Mary Polytecnic Institute", "", "NJ", "6", "national"),  # a typo
    ("St. Mary Poly", "", "", "6", "exact"),  # an alias row
    ("Special Name", "", "", "X9", "override"),
    ("Zzz", "", "TX", None, "unresolved"),
]


def test_cascade(spark):
    dim = spark.createDataFrame([(*r, i) for i, r in enumerate(DIM)], "canonical_id string, name string, state string, city string, entity_class string, pos long")
    names = spark.createDataFrame([(i, n, c, s) for i, (n, c, s, _, _) in enumerate(ASKED)], "qid long, name string, city string, state string")
    rules = {
        "by_state": spark.createDataFrame([], "key string, state string, id string"),
        "by_city": spark.createDataFrame([], "key string, city string, id string"),
        "by_name": spark.createDataFrame([("The Special Name Foundation", "X9")], "key string, id string"),
    }
    rows = {r["qid"]: (r["canonical_id"], r["decided_by"]) for r in matching.cascade(names, dim, rules).collect()}
    assert rows == {i: (want, source) for i, (_, _, _, want, source) in enumerate(ASKED)}
    assert matching.next_surrogate(dim).first()["top"] == 41


def test_ties_are_refused(spark):
    scored = spark.createDataFrame([("q", "a", 95.0), ("q", "b", 95.0), ("q", "a", 50.0), ("r", "a", 99.0), ("r", "b", 80.0), ("s", "c", 94.0)], "key string, canonical_id string, score double")
    rows = {r["key"]: (r["canonical_id"], r["second"], r["accepted"]) for r in matching.margins(scored, "key", 93, 10).collect()}
    assert rows == {"q": ("b", 95.0, False), "r": ("a", 80.0, True), "s": ("c", 0.0, True)}


def test_minting_is_by_name_and_first_position(spark):
    rows = spark.createDataFrame([(9, "b  c."), (3, "B C"), (1, "zed"), (5, "a")], "pos long, name string")
    out = {r["key"]: r["canonical_id"] for r in verdicts.mint(rows, "name", "pos", spark.createDataFrame([(41,)], "top long")).collect()}
    assert out == {"ZED": "SG00042", "B C": "SG00043", "A": "SG00044"}


@pytest.mark.parametrize(
    ("raw", "tag"),
    [(None, "other"), ("__err__ x", "other"), ("Tag: STEM.", "stem"), ("sports and arts, science", "stem;hass;athletics"), ("general; law", "professional"), ("operating", "general"), ("??", "other"), ("'stem'", "stem"), ("student life", "studentlife")],
)
def test_canonize(spark, raw, tag):
    assert one(spark, labels.canonize(F.col("c")), c=raw) == tag
    assert one(spark, labels.canonize(labels.canonize(F.col("c"))), c=raw) == tag


def test_blank_texts_are_general_and_rows_stay(spark):
    rows = spark.createDataFrame([(1, " "), (2, None), (3, "A  b"), (4, "a B"), (5, "c")], "pos long, t string")
    out = tagging.classify_once(rows, "t", "pos", lambda c: F.when(c == "A  b", "stem").otherwise("nonsense"))
    assert {r["pos"]: r["tag"] for r in out.collect()} == {1: "general", 2: "general", 3: "stem", 4: "stem", 5: "other"}


def test_refilings(spark):
    rows = spark.createDataFrame(
        [(0, "f", "1", "2018", "2019-01-01", "5"), (1, "f", "1", "2018", "2019-02-01", "1"), (2, "f", "1", "2018", "2019-02-01", "2"), (3, "f", "", "2018", "x", "1"), (4, "f", "", "2018", "x", "1"), (5, "g", "1", "2018", "x", "1")],
        "pos long, form_type string, filer_ein string, return_year string, return_ts string, submission_id string",
    )
    assert sorted(r["pos"] for r in dedupe.latest_refiling(rows).collect()) == [2, 3, 4, 5]
    prior = spark.createDataFrame([("1", "2018")], "filer_ein string, return_year string")
    assert sorted(r["pos"] for r in dedupe.latest_refiling(rows, prior=prior).collect()) == [3, 4]


def test_text_tables_keep_sentinels_and_zeros(spark, tmp_path):
    (tmp_path / "dim.csv").write_text("\ufeffcanonical_id,grantee_normalized,state,country,entity_class,extra\nNA,x,,US,NCI,1\n00042,\"a, b\",TX,US,,2\n")
    rows = tables.read_text_table(spark, str(tmp_path / "dim.csv"), tables.DIM).collect()
    assert [tuple(r) for r in rows] == [("NA", "x", "", "US", "NCI", ""), ("00042", "a, b", "TX", "US", "", "")]
    (tmp_path / "log.csv").write_text("xml_file,ts\n/a/b/1_public.xml,x\n2_public.xml,y\n2_public.xml,z\n")
    assert sorted(r[0] for r in tables.read_skip_list(spark, str(tmp_path / "log.csv")).collect()) == ["1_public.xml", "2_public.xml"]
    assert tables.read_skip_list(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "ex.csv").write_text("name,Filer EIN\nx,012\n")
    assert [r[0] for r in tables.read_exclusions(spark, str(tmp_path / "ex.csv")).collect()] == ["012"]


def test_work_list(spark, tmp_path):
    (tmp_path / "i.csv").write_text(
        "Form Type,Object Id,URL,Tax Year,Tax Period\n990PF,1,https://s3.amazonaws.com/x/1_public.xml,7202,201812\n990,2,NULL,2019,\n990EZ,3,,2019,\n990,2,,2018,\n990,4,,,\n990,,NULL,2018,\n"
    )
    df = index.read_index(spark, str(tmp_path / "i.csv"))
    assert df.columns == ["formtype", "objectid", "url", "taxyear", "taxperiod"]
    log = spark.createDataFrame([("4_public.xml",)], "xml_file string")
    rows = index.work_list(df.withColumn("pos", F.monotonically_increasing_id()), log, 2000, 2030, ".amazonaws.com/", "xml/", "_public.xml").collect()
    assert {(r["objectid"], r["key"], r["filing_year"]) for r in rows} == {("1", "x/1_public.xml", "2018"), ("2", "xml/2_public.xml", "2019")}


def test_sinks_write_text(spark, tmp_path):
    rows = spark.createDataFrame([("f.xml", True, None)], "xml_file string, funder_support_org boolean, filer_ein string")
    out = sinks.as_text(rows, tables.LOG_UPLOAD)
    assert out.columns == tables.LOG_UPLOAD.names
    assert out.first()["funder_support_org"] == "True"
    sinks.write_increment(rows, tables.LOG_UPLOAD, str(tmp_path / "log"), "s1")
    sinks.write_increment(rows, tables.LOG_UPLOAD, str(tmp_path / "log"), "s1")
    assert tables.read_text_table(spark, str(tmp_path / "log/stamp=s1"), tables.LOG_UPLOAD).count() == 1


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    put = lambda lo, hi: spark.range(lo, hi).write.mode("append").parquet(source)
    put(0, 10)
    run = lambda: ingest.ingest_once(ingest.stream_files(spark, source, "id long"), target, str(tmp_path / "state"), "id")
    run()
    put(5, 15)
    run()
    assert sorted(r["id"] for r in spark.read.parquet(target).select("id").collect()) == list(range(15))


def test_audit_order(spark):
    rows = spark.createDataFrame([("NA", 9.0, 1), ("new_mint", 1.0, 2), ("review", 5.0, 3), ("new_mint", 2.0, 4)], "disposition string, total_amount double, pos long")
    assert [r["pos"] for r in reporting.audit_order(rows).collect()] == [4, 2, 3, 1]


def test_flagship(spark, small):
    df = registry.flagship(spark, small)
    assert df.columns == ["canonical_id", "year", "n", "total"]
    assert df.count() > 0


@pytest.mark.parametrize(("kind", "floor"), [("token_sort", 92), ("token_set", 85), ("token_set", 95), ("ratio", 80)])
def test_pairs_of_a_state_lose_none_that_reaches_the_floor(spark, kind, floor):
    rng = random.Random(floor)
    words = ["UNIVERSITY", "COLLEGE", "OF", "STATE", "ALPHA", "ALPHAS", "BETA", "GAMMA", "DELTA", "NORTHERN", "NORTHEN", "A", "TEXAS", "MINING"]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))
    q, n = [(name(), rng.choice("XY")) for _ in range(150)], [(name(), rng.choice("XY")) for _ in range(150)]
    got = {tuple(r) for r in alike.candidates(spark.createDataFrame(q, "q string, q_state string"), spark.createDataFrame(n, "n string, q_state string"), kind, floor, ["q_state"]).select("q", "q_state", "n").collect()}
    want = {(a, s, b) for a, s in q for b, z in n if s == z and similarity.SCORERS[kind](a, b) >= floor}
    assert want <= got
    assert want

"""The near-duplicate stage on rows without ids and on ids that stand twice."""

from fixtures import frame, prose

from grantlens.llm import stages


def test_one_row_of_each_component_with_and_without_ids(spark):
    texts = [prose(400 + i, 80) for i in range(5)]
    docs = [(None, texts[0], "en", "a"), (None, texts[1], "en", "a"), (None, texts[2], "en", "a"), (None, texts[2], "en", "b"),
            (1, texts[3], "en", "a"), (1, texts[4], "en", "a"), (None, texts[3], "en", "b"), (2, texts[4], "en", "b")]
    for rows in (docs, docs[::-1]):
        kept = sorted((r["doc_id"] or 0, r["text"]) for r in stages.near_duplicate_stage(spark, frame(spark, rows), "").collect())
        assert kept == sorted([(0, texts[0]), (0, texts[1]), (0, texts[2]), (1, texts[3]), (1, texts[4])])

"""strip_wrappers_text on texts with letters outside ASCII, against plain Python."""

import re

from grantlens.functions import fixed
from grantlens.plans import q_names


def plain(text):
    out = re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", re.sub(r"\s*&\s*", " AND ", text.upper()))).strip()
    for short, full in fixed.ABBREVIATIONS:
        out = re.sub(rf"\b{short}\b", full, out)
    for phrase in (r"THE|OF|TO|AND(?:\s+OF)?|DE LA",):
        out = re.sub(rf"\b({phrase})\b", " ", out)
    return re.sub(r"\s+", " ", out).strip()


def test_wrappers_go_from_every_text(spark, tmp_path):
    texts = ["The Université de la Rive", "Östlich of Zürich & of Köln", "étude univ of the sea", "plain univ to the hill", "ÖOF THEÄ"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["stripped"] for r in q_names.strip_wrappers_text(spark, str(tmp_path)).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    assert got[0] == "UNIVERSITÉ RIVE"

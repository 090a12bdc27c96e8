"""The pipeline's stages, each on its own input, against plain Python; and the whole run."""

import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from fixtures import documents, prose
from test_native import levels, plain_redaction
from test_texts import plain_components, plain_fingerprint
from tokenizers import Tokenizer

from grantlens.llm import langid, mixing, stages

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    """The odd documents, plain ones in two languages, secrets, copies and near copies."""
    rows = [(d, t, lang, s) for d, t, lang, s in documents()]
    english = "the of and to in that with for this they were from have which their about would there been when".split()
    for i in range(60):
        words = [english[(i * 7 + j * j) % len(english)] if j % 2 else w for j, w in enumerate(prose(900 + i, 90).split())]
        rows.append((1000 + i, " ".join(words) + (f" token={'abcdefgh' * 2}{i} and more" if i % 4 == 0 else ""), "en", ["big", "small", None][min(2, i % 7)]))
    rows += [(1100 + i, rows[-1 - i][1], "en", "big") for i in range(0, 20, 2)]
    rows.append((None, rows[-1][1] + " tail", "en", "big"))
    return rows


@pytest.fixture(scope="module")
def run_of(spark, tmp_path_factory):
    """Input and output of each stage, and what run() gives."""
    folder = tmp_path_factory.mktemp("corpus")
    rows = [(d, t, lang, s, len(t) if t is not None else None) for d, t, lang, s in corpus()]
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for n, (name, stage) in enumerate(stages.STAGES):
        made = stage(spark, docs, str(folder))
        made.write.parquet(f"{folder}/{n}")
        made = spark.read.parquet(f"{folder}/{n}")
        out[name] = docs, made
        docs = made
    from corpus_pipeline import run

    return out, run(spark, str(folder))


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_language_stage(run_of, spark):
    before, after = run_of[0]["language ID"]
    model = langid.fit(before)
    want = Counter()
    for d, t, _, s, n in rows_of(before):
        ((lang, score),) = langid.predicted([t or ""], model)
        if lang != "und" and score >= stages.LEAST_LANGUAGE_SCORE:
            want[(d, t, lang, s, n)] += 1
    assert Counter(rows_of(after)) == want
    assert {1000 + i for i in range(60)} <= {d for d, *_ in rows_of(after)}


def test_near_duplicate_stage(run_of):
    before, after = run_of[0]["SimHash near-dedup"]
    prints = defaultdict(list)
    for r in rows_of(before):
        prints[plain_fingerprint(r[1])].append(r)
    roots, groups = plain_components(prints), defaultdict(list)
    for p, rows in prints.items():
        groups[roots[p]] += rows
    kept = rows_of(after)
    assert len(kept) == len(groups)
    for rows in groups.values():
        least = min((r[0] is None, r[0] or 0) for r in rows)
        assert sum((r[0] is None, r[0] or 0) == least and r in rows for r in kept) >= 1


def test_secret_stage(run_of):
    before, after = run_of[0]["secret scans"]
    want = Counter()
    for d, t, lang, s, n in rows_of(before):
        if t is None:
            want[(d, t, lang, s, n)] += 1
            continue
        clean = plain_redaction(t)
        want[(d, clean, lang, s, n if clean == t else len(clean))] += 1
    assert Counter(rows_of(after)) == want
    assert any("[SECRET]" in t for _, t, _, _, _ in rows_of(after))


def test_mixing_stage(run_of):
    before, after = run_of[0]["mixing to target weights"]
    texts, sizes = defaultdict(list), defaultdict(int)
    for d, t, _, s, _ in rows_of(before):
        texts[d].append(WORD.findall(t or ""))
        sizes[s] += len(texts[d][-1])
    want, got = levels(sizes), defaultdict(int)
    passes = Counter()
    for d, t, _, s, n in rows_of(after):
        words = WORD.findall(t)
        assert n == len(t)
        got[s] += len(words)
        passes[d] += 1
        left = iter(max(texts[d], key=len)) if len(texts[d]) == 1 else None
        if left is not None:  # words of the document, in its order
            assert all(w in left for w in words)
    assert all(n <= 3 * len(texts[d]) for d, n in passes.items())
    for s, target in want.items():
        assert abs(got[s] - target) <= 2 * mixing.BLOCK


def test_packing_stage_and_whole_run(run_of):
    before, after = run_of[0]["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = defaultdict(Counter)
    for d, t, *_ in rows_of(before):
        ids[d][len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1] += 1
    whole = Counter()
    for r in after.collect():
        whole[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert whole == Counter({(d, n): n * k for d, c in ids.items() for n, k in c.items()})
    total = Counter()
    for r in run_of[1].collect():
        total[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert total == whole

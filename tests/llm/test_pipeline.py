"""The pipeline against a brute-force version of each of its stages, on a small table."""

import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from gavelframe.llm import mixing, sentencepiece_bpe  # noqa: E402


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijé") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = make(60)
    rows = [(i, make(rng.randint(5, 150)), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None])) for i in range(80)]
    rows += [(80, rows[3][1], "en", "a"), (81, rows[4][1] + " more", "fr", "b"), (82, passage + " " + make(30), "en", "c"), (83, make(30) + " " + passage, "en", "c"), (84, "12 34", "en", "a"), (85, None, None, None), (86, "", "en", "b")]
    out = str(tmp_path_factory.mktemp("sf"))
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(f"{out}/documents.parquet")
    return out


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        kept.append((docs.columns, docs.collect()))
    assert all(c == columns for c, _ in kept[:-1])
    language, near, repeats, mixed, tokens = (r for _, r in kept)
    source = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id for r in language} == {i for i, r in source.items() if r.text and any(c.isalpha() for c in r.text)}
    assert all(r.lang for r in language) and all(r.lang == source[r.doc_id].lang for r in language if source[r.doc_id].lang)
    words = {r.doc_id: r.text.split() for r in language}
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, w in words.items()}
    gone = {b for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {r.doc_id for r in near} == set(sets) - gone and {80, 81} <= gone
    data = {r.doc_id: r.text.encode() for r in near}
    seen = Counter(d[i : i + 200] for d in data.values() for i in range(len(d) - 199))
    for r in repeats:
        d = data[r.doc_id]
        hit = np.zeros(len(d), bool)
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                hit[i : i + 200] = True
        at, want = 0, ""
        for c in d.decode():
            n = len(c.encode())
            want += "" if hit[at : at + n].any() else c
            at += n
        assert (r.text, r.n_chars) == (want, len(want))
    assert len(repeats) == len(near) and any(len(r.text.encode()) < len(data[r.doc_id]) for r in repeats)
    size, took = Counter(), Counter()
    for r in repeats:
        size[r.source] += len(r.text.split())
    for r in mixed:
        took[r.source] += len(r.text.split())
    for s, t in mixing.targets(list(size.items())).items():
        assert abs(took[s] - t) < max(len(r.text.split()) for r in repeats if r.source == s)
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.MODEL)
    assert Counter((r.doc_id, r.n_tokens) for r in tokens) == Counter((r.doc_id, len(sp.encode(r.text))) for r in mixed)
    assert all(r.round_trip for r in tokens)
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(map(tuple, whole)) == Counter(map(tuple, tokens))

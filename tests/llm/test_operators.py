"""Each dealt operator against a brute-force version, and on nulls, empty tables, ties, repeated rows and clashing columns."""

import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gavelframe.llm import embedding_dedup, jaccard_join, kneser_ney, langid, licenses, mixing, sentencepiece_bpe, suffix_dedup, url_filter, winnowing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = {c: c + 32 for c in range(65, 91)}


def texts(seed=3, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeèñ漢") for _ in range(rng.randint(1, 6))) for _ in range(80)]
    make = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage = make(70)
    out = [make(rng.randint(1, 120)) for _ in range(n)]
    out += [out[0], out[0], out[1].upper(), out[2] + " end", passage + " " + make(20), make(10) + "\n" + passage, "x " * 400, "", " \t\n", None]
    base = make(100).split()
    for i in range(12):
        w = list(base)
        w[i * 8] = f"new{i}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else "fr", f"src{i % 3}" if i % 7 else None, i) for i, t in enumerate(texts())]
    rows += [(5, rows[5][1], "en", "src1", 0), (None, "a text without an id", "en", "src0", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score long")
    return df.repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


def groups(n, pairs):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def shingle_set(text, k):
    w = WORD.findall((text or "").translate(ASCII))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.mark.parametrize(("num", "k"), [(90, 3), (80, 5), (60, 2)])
def test_jaccard_components(docs, num, k):
    got = jaccard_join.jaccard_components(docs, threshold=jaccard_join.Threshold(num, 100, k)).collect()
    rows = docs.collect()
    sets = [shingle_set(r.text, k) for r in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    root = groups(len(rows), linked)
    least = defaultdict(list)
    for r, g in zip(rows, root):
        if r.doc_id is not None:
            least[g].append(r.doc_id)
    want = Counter((r.doc_id, len(s), min(least[g], default=None)) for r, s, g in zip(rows, sets, root))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_keep_one(docs):
    kept = jaccard_join.keep_one(docs, threshold=jaccard_join.Threshold(80, 100, 5))
    assert kept.columns == docs.columns
    components = {(r.doc_id, r.set_id): r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    want = Counter(i for (i, s), c in components.items() if i is not None and (s is None or i == c))
    assert Counter(r.doc_id for r in kept.collect() if r.doc_id is not None) == want


def test_signatures_meet():
    """Sets at the threshold share a signature whatever differs, also without elements that both have."""
    rng = np.random.default_rng(1)
    for t in (jaccard_join.Threshold(90, 100, 3), jaccard_join.Threshold(80, 100, 5), jaccard_join.Threshold(60, 100, 2)):
        for size in (5, 9, 10, 19, 40, 133, 700):
            for _ in range(20):
                a = rng.integers(1, 2**63, size).astype(np.uint64)
                most = int((t.den - t.num) * size / t.num)
                b = np.concatenate([a, rng.integers(1, 2**63, rng.integers(0, most + 1)).astype(np.uint64)]) if rng.random() < 0.5 else a[: math.ceil(size * t.num / t.den)]
                if len(np.setxor1d(a, b)) == 0:
                    continue
                h, off = np.concatenate([np.sort(a), np.sort(b)]), np.array([0, len(a), len(a) + len(b)])
                sig, own = jaccard_join.signatures(h, off, t)
                assert set(sig[own == 0]) & set(sig[own == 1])
                out = np.concatenate([np.sort(a)[2:], np.sort(np.setdiff1d(b, np.sort(a)[:2]))])
                cut = np.array([0, len(a) - 2, len(out)])
                sig, own = jaccard_join.signatures(out, cut, t, np.array([len(a), len(b)]), 1)
                assert set(sig[own == 0]) & set(sig[own == 1])


def test_suffix_dedup(docs, rows):
    length = 200
    data = [(r.text or "").encode() for r in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    want = Counter()
    for r, d in zip(rows, data):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        want[(r.doc_id, len(d), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())] += 1
    got = suffix_dedup.remove_repeats(docs.coalesce(2), digest_only=True).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert sum(k[2] for k in want) > 1000
    whole = suffix_dedup.remove_repeats(docs.coalesce(2), as_text=True, tag="__")
    assert [c for c in whole.columns if not c.startswith("__")] == docs.columns and whole.count() == len(rows)


def test_levels_merge_geometrically():
    assert [suffix_dedup.levels_before(b) for b in range(5)] == [[], [(0, 1)], [(1, 2)], [(1, 2), (2, 1)], [(3, 4)]]


def test_levels_find_what_repeats(monkeypatch):
    """Windows of several batches through scans and merges, against a count of all of them; groups of one window are never compared."""
    monkeypatch.setattr(suffix_dedup, "WINDOWS_HELD", 3)
    rng, length = random.Random(4), 40
    parts = ["".join(rng.choice("ab") for _ in range(length)) for _ in range(6)]
    contexts = [(rng.choice((5 << 32, 9 << 32)), (rng.choice(parts) + rng.choice(parts))[: length + rng.randrange(20)].encode()) for _ in range(60)]
    level = lambda cs, first: suffix_dedup.Level.of(np.arange(first, first + len(cs)).astype(np.uint64), np.array([k for k, _ in cs], np.uint64), np.full(len(cs), 30), np.zeros(len(cs), np.int64), np.array([len(x) for _, x in cs]), np.frombuffer(b"".join(x for _, x in cs), np.uint8), length)
    marked = lambda x: {(int(n), int(w)) for n, _, w in zip(*x)}
    a, ra = level(contexts[:20], 0)
    b, rb = level(contexts[20:45], 20)
    c, rc = level(contexts[45:], 45)
    ab, rab = a.merged(b, length)
    got = marked(a.marks(ra)) | marked(b.marks(rb)) | marked(c.marks(rc)) | marked(ab.marks(rab)) | marked(ab.scanned(c, length))
    windows = [(n, w, (k, 30 - w, x[w : w + length])) for n, (k, x) in enumerate(contexts) for w in range(len(x) - length + 1)]
    times = Counter(x for _, _, x in windows)
    assert got == {(n, w) for n, w, x in windows if times[x] > 1} and 0 < len(got) < len(windows)
    text = [(int(g), bytes(ab.body[ab.start[o] + w : ab.start[o] + w + length])) for g, o, w in zip(ab.group, ab.owner, ab.at)]
    assert text == sorted(text)


@pytest.mark.parametrize(("hot", "stretch"), [(4096, 1 << 20), (1, 300)])
def test_suffix_dedup_of_hot_anchors_and_stretches(spark, monkeypatch, hot, stretch):
    """Many contexts of one anchor, and texts that are read in many stretches, against brute force."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
    rng = random.Random(11)
    line = "".join(rng.choice("abcdefgh ") for _ in range(150))
    word = lambda n: "".join(rng.choice("ijklmnoé") for _ in range(n))
    near = [word(60) for _ in range(5)]
    data = [rng.choice(near) + line + rng.choice(near) + word(rng.randrange(700)) for _ in range(40)] + ["ab" * 900, word(2000)]
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string").repartition(3)
    raw = [t.encode() for t in data]
    seen = Counter(d[i : i + 200] for d in raw for i in range(len(d) - 199))
    want = {}
    for n, d in enumerate(raw):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                gone[i : i + 200] = True
        want[n] = (int(gone.sum()), hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest())
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, digest_only=True).collect()} == want


def test_suffix_dedup_of_a_very_long_text(spark):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(1000))
    long = np.random.default_rng(3).integers(97, 123, 70_000_000).astype(np.uint8).tobytes().decode()
    data = [passage + long + passage, "short " + passage]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string"), digest_only=True).collect()}
    assert got == {0: (70_002_000, 2000, 2, hashlib.sha256(long.encode()).hexdigest()), 1: (1006, 1000, 1, hashlib.sha256(b"short ").hexdigest())}


def test_a_lost_store_file_is_an_error(spark, docs):
    import glob
    import os

    model = kneser_ney.fit(docs)
    kneser_ney.score(docs, model).count()
    files = sorted(glob.glob(f"{model.folder.path}/key2-*.npy"))
    os.remove(files[len(files) // 2])
    with pytest.raises(Exception, match="has lost its file"):
        kneser_ney.score(docs, model).agg(F.sum("score")).collect()
    whole = kneser_ney.fit(docs)
    os.remove(f"{whole.folder.path}/manifest-1.json")
    with pytest.raises(Exception, match="manifest-1.json"):
        kneser_ney.score(docs.withColumn("again", F.lit(1)), whole).agg(F.sum("score")).collect()


@pytest.mark.parametrize("blocks", [4096, 7])
def test_embedding_links(spark, monkeypatch, blocks):
    monkeypatch.setattr(embedding_dedup, "BLOCK", blocks)
    rng = np.random.default_rng(0)
    base = rng.normal(size=(6, 16))
    vs = [(base[i % 6] + rng.normal(size=16) * 0.12 * (i % 5)).astype(np.float32).tolist() for i in range(60)]
    vs += [vs[0], vs[0], [x * 2 for x in vs[1]], [0.0] * 16, None, [float("nan")] * 16, [None] + [1.0] * 15, [1.0] * 8, [1.0] * 8, []]
    df = spark.createDataFrame(list(enumerate(vs)), "vec_id long, embedding array<float>").repartition(3)
    v = [None if x is None or not x or None in x or not np.isfinite(x).all() or not any(x) else np.array(x, float) for x in vs]
    linked = [(i, j) for i in range(len(v)) for j in range(i) if v[i] is not None and v[j] is not None and len(v[i]) == len(v[j]) and v[i] @ v[j] / np.sqrt(v[i] @ v[i]) / np.sqrt(v[j] @ v[j]) >= 0.9]
    n = Counter(x for p in linked for x in p)
    root = groups(len(v), linked)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_links(df).collect()}
    assert got == {i: (n[i], root[i], root[i] == i) for i in range(len(v))}


def test_quantisation_bound():
    v = np.random.default_rng(2).normal(size=(200, 32))
    codes, scale, coded, error = embedding_dedup.quantised(v)
    u = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    bound = np.outer(scale, scale) * (codes.astype(int) @ codes.T.astype(int)) + np.outer(coded, error) + np.outer(error, coded) + np.outer(error, error)
    assert (u @ u.T <= bound + 1e-12).all()


def test_sentencepiece_is_the_library(spark, docs, rows):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.MODEL)
    out = sentencepiece_bpe.encode(docs).collect()
    assert Counter((r.doc_id, tuple(r.ids) if r.ids is not None else None) for r in out) == Counter((r.doc_id, tuple(sp.encode(r.text)) if r.text is not None else None) for r in rows)
    back = sentencepiece_bpe.decode(sentencepiece_bpe.encode(docs).drop("text")).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r.doc_id, r.text) for r in rows)
    rng = random.Random(5)
    hard = ["".join(rng.choice("ab  \n\tèñ漢🙂.,01_tionhe▁\x00") for _ in range(rng.randint(0, 90))) for _ in range(400)] + ["a" * 500, "the" * 200]
    bpe = sentencepiece_bpe.Bpe.read(open(sentencepiece_bpe.MODEL, "rb").read())
    ids, off = bpe.encode(pa.array(hard))
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [sp.encode(t) for t in hard]


def test_sentencepiece_of_long_units(monkeypatch):
    """Text without spaces, in stretches and whole, and five MB of it."""
    import time

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.MODEL)
    bpe = sentencepiece_bpe.Bpe.read(open(sentencepiece_bpe.MODEL, "rb").read())
    rng = random.Random(1)
    hard = ["".join(rng.choice("abtheillion\n\tèñ漢🙂.,01_▁\x00") for _ in range(n)) for n in (300, 511, 513, 3000, 9000)] + ["a" * 3000, "the" * 900, "ha" * 2000 + "漢字" * 500, " " * 2000, "x " + "y" * 5000 + " z"]
    monkeypatch.setattr(sentencepiece_bpe, "AT_ONCE", 1000)
    ids, off = bpe.encode(pa.array(hard))
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [sp.encode(t) for t in hard]
    monkeypatch.undo()
    big = "".join(rng.choice("acgtthequickbrown") for _ in range(5_000_000))
    began = time.perf_counter()
    ids, off = bpe.encode(pa.array([big]))
    assert time.perf_counter() - began < 180 and ids.tolist() == sp.encode(big)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_kneser_ney_orders(docs, rows, order):
    """Each order against counts of whole n-grams."""
    tokens = lambda t: ["<s>"] * (order - 1) + WORD.findall((t or "").translate(ASCII)) + ["</s>"]
    model = kneser_ney.fit(docs.where("score % 3 <> 1"), order=order)
    grams = [Counter() for _ in range(order + 1)]
    for r in rows:
        if r.score % 3 != 1:
            t = tokens(r.text)
            grams[order].update(tuple(t[i - order + 1 : i + 1]) for i in range(order - 1, len(t)))
    for m in range(order - 1, 0, -1):
        grams[m] = Counter(g[1:] for g in grams[m + 1])
    cuts = [None] + [kneser_ney.discounts([Counter(c.values())[i] for i in range(1, 5)]) for c in grams[1:]]
    types, n_words = sum(grams[1].values()), len(grams[1])
    cut = lambda n, m: n - (cuts[m][min(n, 3) - 1] if n else 0)
    rest = sum(cuts[1][min(n, 3) - 1] for n in grams[1].values()) / types
    behind = [defaultdict(list) for _ in range(order + 1)]
    for m in range(2, order + 1):
        for g, n in grams[m].items():
            behind[m][g[:-1]].append(n)

    def p(g):
        m = len(g)
        if m == 1:
            return cut(grams[1][g], 1) / types + rest / (n_words + 1)
        ns = behind[m].get(g[:-1])
        return p(g[1:]) if not ns else cut(grams[m][g], m) / sum(ns) + sum(cuts[m][min(n, 3) - 1] for n in ns) / sum(ns) * p(g[1:])

    want = sorted((r.doc_id is None, r.doc_id or 0, round(sum(math.log10(p(tuple(t[i - order + 1 : i + 1]))) for i in range(order - 1, len(t))), 6)) for r in rows for t in [tokens(r.text)])
    assert sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 6)) for r in kneser_ney.score(docs, model).collect()) == want


def test_kneser_ney(docs, rows):
    train = docs.where("score % 3 <> 1")
    model = kneser_ney.fit(train)
    tokens = lambda t: WORD.findall((t or "").translate(ASCII)) + ["</s>"]
    kept = [r for r in rows if r.score % 3 != 1]
    count = Counter(w for r in kept for w in tokens(r.text))
    pairs = Counter((u, w) for r in kept for u, w in zip(["<s>", *tokens(r.text)], tokens(r.text)))
    before = Counter(w for _, w in pairs)
    of = lambda c: kneser_ney.discounts([Counter(c.values())[i] for i in range(1, 5)])
    high, low = of(pairs), of(before)
    context = defaultdict(lambda: [0, 0, 0, 0])
    for (u, _), n in pairs.items():
        context[u][0] += n
        context[u][min(n, 3)] += 1
    rest = sum(low[min(n, 3) - 1] for n in before.values()) / len(pairs)
    cut = lambda n, d: n - (d[min(n, 3) - 1] if n else 0)
    p_low = lambda w: cut(before[w], low) / len(pairs) + rest / (len(count) + 1)

    def p(u, w):
        if u not in context:
            return p_low(w)
        n, *kinds = context[u]
        return cut(pairs[u, w], high) / n + sum(a * b for a, b in zip(high, kinds)) / n * p_low(w)

    assert abs(sum(p("<s>", w) for w in [*count, "never seen"]) - 1) < 1e-9
    total, v = sum(count.values()), len(count)
    got = sorted(kneser_ney.score(docs, model).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.n_tokens))
    assert "score" in got[0] and len(got) == len(rows)
    for r, row in zip(got, sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id))):
        t = tokens(row.text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in count for w in t), total)
        assert math.isclose(r.score, sum(math.log10(p(u, w)) for u, w in zip(["<s>", *t], t)), rel_tol=1e-9)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (total + v + 1)) for w in t), rel_tol=1e-9)
    empty = kneser_ney.fit(docs.limit(0))
    assert all(r.score == 0 for r in kneser_ney.score(docs, empty).collect())


def test_langid(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = langid.op1_language_id(spark, "/root/testdata/sf0.001").join(df, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_langid_is_rank_order(spark, docs, rows):
    """Profiles, ranks and distances against a plain version on strings of letters."""

    def code(gram):
        h, m = 0, (1 << 64) - 1
        for c in gram:
            h = (h * langid.MULTIPLIER + (ord(c) if c != "|" else 0) + 1) & m
        return int(langid.mix(np.array([(h + len(gram)) & m], np.uint64))[0]) >> 1

    def grams(text):
        words = re.findall(r"\w+", "".join(c.lower()[0] if c.isalpha() else " " for c in text or ""))
        return [f"|{w}|"[i : i + n] for w in words for n in range(1, 6) for i in range(len(w) + 3 - n) if f"|{w}|"[i : i + n] != "|"]

    def top(count, length):
        return [c for _, c in sorted((-n, code(g)) for g, n in count.items())[:length]]

    length = 60
    profiles = langid.fit_profiles(docs, length=length)
    learned = defaultdict(Counter)
    for r in rows:
        if r.lang is not None and r.text is not None:
            learned[r.lang].update(grams(r.text))
    assert profiles == {lang: top(c, length) for lang, c in learned.items()}
    want = []
    for r in rows:
        mine = top(Counter(grams(r.text)), length)
        far = {lang: sum(min(abs(p.index(c) - i), length) if c in p else length for i, c in enumerate(mine)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        want.append((r.doc_id, best, round(1 - far[best] / (length * len(mine)), 9)) if mine else (r.doc_id, "und", 0.0))
    got = langid.predict(docs, profiles, length=length).collect()
    assert Counter((r.doc_id, r.lang_pred, round(r.score, 9)) for r in got) == Counter(want)
    assert "lang_pred" in got[0] and len({r.score for r in got}) > 20 and code("é") != code("è")


def test_langid_of_a_very_long_text(monkeypatch):
    """Counted in stretches, with words over their ends, a text has the n-grams that it has as a whole."""
    rng = random.Random(5)
    data = ["".join(rng.choice("abcé 1") for _ in range(3000)), "x" * 900 + " " + "ab" * 400, "12 " * 500, "é"]
    whole = [tuple(map(list, c)) for t in data for c in langid.ngram_counts(pa.array([t]))]
    monkeypatch.setattr(langid, "STRETCH", 50)
    assert [tuple(map(list, c)) for t in data for c in langid.ngram_counts(pa.array([t]))] == whole and all(len(h) for h, _ in whole[:2])


def test_words_of_a_very_long_text():
    """Hashes of words do not depend on how a text is cut for them."""
    from gavelframe.llm import _text

    rng = random.Random(6)
    raw = np.frombuffer("".join(rng.choice("abc  \n") for _ in range(5000)).encode(), np.uint8)
    start = np.arange(0, 4990, 10)
    end = start + 1 + start % 9
    assert (_text.spans_hashed(raw, start, end, 37) == _text.span_hash(_text.prefix(raw), start, end)).all()


def test_langid_edges(spark, docs):
    profiles = langid.fit_profiles(docs)
    odd = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "123 !? 漢字 x", 0.5), (4, "12 .", 0.5)], "id int, text string, score double")
    got = {r.id: r for r in langid.predict(odd, profiles).collect()}
    assert [got[i].lang_pred == "und" for i in (1, 2, 3, 4)] == [True, True, False, True] and got[1].score == 0
    assert langid.predict(odd.limit(0), profiles).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, langid.fit_profiles(docs.limit(0))).collect()} == {"und"}


def test_winnowing(spark, docs, rows):
    out = winnowing.with_next(docs.where("doc_id IS NOT NULL AND score > 0").select("doc_id", "text")).collect()
    order = sorted((r for r in rows if r.doc_id is not None and r.score > 0), key=lambda r: -r.doc_id)
    assert {r.doc_id: r._next_text for r in out} == {r.doc_id: order[(i + 1) % len(order)].text for i, r in enumerate(order)}
    fp = winnowing.fingerprint(docs.text)
    got = docs.select("text", fp.alias("fp"), winnowing.hashes(fp).alias("h"), winnowing.positions(fp).alias("p")).collect()
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.text, r.fp) == r.fp and len(r.p) == len(set(r.p)) and r.p == sorted(r.p)
        n = len(re.findall(r"\S{1,12}", r.text or ""))
        assert bool(r.fp) == bool(n) and all(b - a <= winnowing.W for a, b in zip(r.p, r.p[1:]))
    shared = [set(r.h) for r in got if r.text and "new3" in r.text or r.text and "new4" in r.text]
    assert shared[0] & shared[1]
    assert winnowing.with_next(docs.limit(0)).count() == 0
    clash = docs.select("doc_id", "text", *[F.lit(i).alias(c) for i, c in enumerate(("_k", "_b", "_seen", "_to", "k", "b", "seen", "above", "row"))])
    assert winnowing.with_next(clash).columns == [*clash.columns, "_next_text"] and {tuple(r)[2:-1] for r in winnowing.with_next(clash).collect()} == {tuple(range(9))}


def plain_fingerprint(h, k=winnowing.K, w=winnowing.W):
    """(hash, position) chosen from the tokens' hashes by a hash rolled along and a scan of each window."""
    from pyspark.sql import SparkSession

    if not h:
        return []
    if len(h) < k:
        return None  # one hash of all, checked elsewhere
    prime, base = winnowing.PRIME, winnowing.BASE
    rolled = [sum(x * pow(base, k - 1 - i, prime) for i, x in enumerate(h[:k])) % prime]
    for i in range(k, len(h)):
        rolled.append(((rolled[-1] - h[i - k] * pow(base, k - 1, prime)) * base + h[i]) % prime)
    spark = SparkSession.getActiveSession()
    mixed = [r.m for r in spark.createDataFrame([(i, x) for i, x in enumerate(rolled)], "i int, x long").select("i", F.shiftright(F.xxhash64("x"), winnowing.POSITION_BITS).alias("m")).orderBy("i").collect()]
    out = []
    for i in range(max(1, len(mixed) - w + 1)):
        best = min(enumerate(mixed[i : i + w], i), key=lambda x: (x[1], -x[0]))
        if not out or out[-1] != (best[1], best[0]):
            out.append((best[1], best[0]))
    return out


def test_winnowing_query_is_brute_force(spark, tmp_path):
    """Fingerprints, edited texts, digests and likenesses of the query, each computed another way."""
    data = [(i, t) for i, t in enumerate(texts(8, 14))] + [(100, "".join(random.Random(3).choice("acgt") for _ in range(90))), (101, "eins zwei"), (102, "🙂é" * 9)]
    spark.createDataFrame(data, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    order = sorted(((i, t or "") for i, t in data), reverse=True)
    edited = {}
    for n, (i, t) in enumerate(order):
        half = len(t) // 2
        edited[i] = t[: len(t) - half] + order[(n + 1) % len(order)][1][:half]
    every = {t for _, t in order} | set(edited.values())
    tokens = {t: [x for run in re.findall(r"[^ \t\n\x0b\f\r]+", t) for x in [run[i : i + 12] for i in range(max(1, len(run) - 11))]] for t in every}
    words = sorted({x for xs in tokens.values() for x in xs})
    hashed = dict(spark.createDataFrame([(x,) for x in words], "x string").select("x", F.pmod(F.xxhash64("x"), F.lit(winnowing.PRIME))).collect())
    fp = winnowing.fingerprint(F.col("t"))
    made = {r.t: (list(zip(r.h, r.p)), r.d) for r in spark.createDataFrame([(t,) for t in every], "t string").select("t", winnowing.hashes(fp).alias("h"), winnowing.positions(fp).alias("p"), winnowing.digest(fp).alias("d")).collect()}
    for t in every:
        want = plain_fingerprint([hashed[x] for x in tokens[t]])
        assert made[t][0] == want if want is not None else len(made[t][0]) == 1
    like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    sets = {t: {h for h, _ in made[t][0]} for t in every}
    got = {r.doc_id: r for r in winnowing.op6_winnowing(spark, str(tmp_path)).collect()}
    assert len(got) == len(data)
    for n, (i, t) in enumerate(order):
        r, after = got[i], order[(n + 1) % len(order)][1]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited[i].encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (made[t][1], made[edited[i]][1])
        assert math.isclose(r.near_edited, like(sets[t], sets[edited[i]])) and math.isclose(r.near_next, like(sets[t], sets[after]))


def test_winnowing_takes_the_rightmost(spark):
    df = spark.createDataFrame([("a " * 12,)], "text string")
    p = df.select(winnowing.positions(winnowing.fingerprint(df.text)).alias("p")).first().p
    assert p == list(range(winnowing.W - 1, 12 - winnowing.K + 1))


def test_winnowing_in_long_runs(spark):
    rng = random.Random(7)
    runs = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(5000)), "".join(rng.choice("acgt") for _ in range(3000))]
    same = winnowing.likeness(F.array_distinct(winnowing.hashes(winnowing.fingerprint(F.col("a")))), F.array_distinct(winnowing.hashes(winnowing.fingerprint(F.col("b")))))
    pairs = [(x, y) for r in runs for x, y in ((r, "x" + r), (r, r[:1000] + r[1001:]), (r, r[:500] + " " + r[500:]))] + [(runs[1], "".join(rng.choice("acgt") for _ in range(3000)))]
    got = [r.same for r in spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").select("i", same.alias("same")).orderBy("i").collect()]
    assert min(got[:-1]) > 0.98 and got[-1] < 0.01
    part = runs[0][100 : 100 + 12 + winnowing.K + winnowing.W - 2]
    hashes = [set(r.h) for r in spark.createDataFrame([(f"{chr(i)}{part}{chr(i + 1)}" * 2,) for i in (0x3041, 0x3061)], "t string").select(winnowing.hashes(winnowing.fingerprint(F.col("t"))).alias("h")).collect()]
    assert hashes[0] & hashes[1]
    words = "twelveletter is a thirteenchars word \U0001f600\U0001f601 end"
    tokens = spark.createDataFrame([(words,)], "t string").select(F.regexp_extract_all("t", F.lit(winnowing.TOKEN), F.lit(1)).alias("x")).first().x
    assert tokens == [t for run in words.split() for t in ([run[i : i + 12] for i in range(max(1, len(run) - 11))])]


def test_url_filter(spark):
    urls = ["http://a.com/en/1", "http://example.com/en/7x?y", "HTTP://X.Example.NET/de/8", "https://b.net/de/9#z", "http://xcom/en/", "nothing", None, "http://h.org/es/", "http://free-casino.example/x", "http://freecasino.example/", "http://a.b/xxx", "http://a.b/axxxb"]
    got = {r.url: r for r in url_filter.url_filter(spark.createDataFrame([(u, "mine") for u in urls], "url string, host string")).collect()}
    assert [got[u].rule for u in urls[:8]] == ["com/en/", "example.com/en/7", "example.net/de/8", "net/de/", None, None, None, "org/es/"]
    assert [got[u].verdict for u in urls] == ["block", "allow", "block", "allow", "allow", "allow", "allow", "block", "block", "allow", "block", "allow"]
    assert (got[None].host, got[urls[2]].host, got[urls[3]].path) == ("", "x.example.net", "/de/9")


def test_url_vocabulary_is_brute_force(spark, tmp_path):
    """Weights of distinct terms between boundaries, against a plain scan, with a table of terms from a file."""
    (tmp_path / "terms.csv").write_text("# term,weight\nfree,1\nFree Money,1.5\n\nbad,2\nbadge,0.5\n")
    terms = url_filter.read_vocabulary(str(tmp_path / "terms.csv"))
    assert terms == {"free": 1.0, "free money": 1.5, "bad": 2.0, "badge": 0.5}
    rng = random.Random(4)
    urls = ["http://h/" + "".join(rng.choice(["free", "bad", "badge", "FREE", " money", "-", "/", "x", "é", "."]) for _ in range(rng.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame([(u, 1, 2) for u in urls] + [(None, 1, 2), ("", 1, 2), ("http://h/" + "x" * 100_000 + "/bad", 1, 2)], "url string, __hits int, weight int")
    out = url_filter.url_filter(df, terms=terms, rules=())
    for r in out.collect():
        found = {t for t in terms if re.search(rf"(?<![^\W_]){re.escape(t)}(?![^\W_])", (r.url or "").lower())}
        weight = sum(terms[t] for t in found)
        assert (r.weight, r.n_strict, r.n_soft, r.verdict) == (weight, int("bad" in found), len(found - {"bad"}), "block" if weight >= 2 else "allow")
    assert url_filter.url_filter(df.limit(0)).count() == 0


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions.\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    texts_ = ["Foo. Released under the MIT License. Bar", mit, "Licensed under CC BY-NC 4.0.\nAll rights reserved.", "licensed under my own terms", "This work is licensed under the GNU General Public License, version 3.", "nothing", "", None]
    got = {r.text: (r.licenses, r.n_sentences) for r in licenses.scan(spark.createDataFrame([(t, 1) for t in texts_], "text string, kinds int")).collect()}
    assert [got[t] for t in texts_] == [("MIT", 1), ("MIT", 2), ("CC-BY-NC-4.0,all-rights-reserved", 2), ("unknown-reference", 1), ("GPL-3.0-only", 1), ("", 0), ("", 0), ("", 0)]


def test_known_license_texts_wrapped(spark):
    """Whole notices as they stand in files, wrapped at 72 columns."""
    p = lambda *ss: "\n\n".join(textwrap.fill(s, 72) for s in ss)
    bsd = p("Copyright (c) 2020, Someone. All rights reserved.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
    names = p("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.")
    isc = p("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.")
    agpl = p("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
    cases = [(bsd, "BSD-2-Clause,all-rights-reserved"), (bsd + "\n\n" + names, "BSD-3-Clause,all-rights-reserved"), (isc, "ISC"), (agpl, "AGPL-3.0-or-later"), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("licensed under cc by 4.0 and more", "unknown-reference")]
    got = {r.text: r.licenses for r in licenses.scan(spark.createDataFrame([(t, 0, 0) for t, _ in cases], "text string, __ids int, kinds int")).collect()}
    assert [got[t] for t, _ in cases] == [x for _, x in cases] and licenses.scan(spark.createDataFrame([], "text string")).count() == 0


def test_sentences_from_a_file(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("own\tuse this as you like\nown\tuse this as you like it\n")
    known = licenses.read_sentences(str(tmp_path / "s.tsv"))
    got = licenses.scan(spark.createDataFrame([("Use this\nas you like it. x",), ("use this as you like!",)], "text string"), known=known, rules=(("Own", "own", ("own",)),)).collect()
    assert [(r.licenses, r.n_sentences) for r in got] == [("Own", 1), ("Own", 1)]


def test_licenses_over_lines(spark):
    known = [s for ss in licenses.SENTENCES.values() for s in ss]
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    notice = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    as_is = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE."
    apache = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language."
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details."
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one."
    headers = [("\n\n".join(textwrap.fill(p, 72) for p in (mit, notice, as_is)), "MIT", 3), (apache, "Apache-2.0", 4), (gpl, "GPL-3.0-or-later", 2), (textwrap.fill(bsd, 72), "BSD", 1), (textwrap.fill(mpl, 72), "MPL-2.0", 1), (textwrap.fill(mpl, 60).replace("v. 2", "v.\n2"), "MPL-2.0", 1)]
    headers += [("/*\n" + "".join(f" * {x}".rstrip() + "\r\n" for x in t.split("\n")) + " */\nint main;", name, n) for t, name, n in headers]
    headers += [("it is licensed\nunder my terms\nfoo", "unknown-reference", 1), ("it is licensed\nunder\nmy terms", "unknown-reference", 1), ("it is released under\nmy terms", "unknown-reference", 1), ("licensed under a\nlicensed under b", "unknown-reference", 2), ("It was released.\nUnder my desk", "", 0), ("All rights.\nReserved", "", 0), ("all rights\n\nreserved", "", 0)]
    got = {r.text: (r.licenses, r.n_sentences) for r in licenses.scan(spark.createDataFrame([(t,) for t, _, _ in headers], "text string")).collect()}
    assert [got[t] for t, _, _ in headers] == [(name, n) for _, name, n in headers]
    wraps = [(s, f"Some words before.\n{textwrap.fill(s, width, break_long_words=False)}\n\nwords behind") for s in known for width in (72, 30, 12)]
    ids = dict(spark.createDataFrame(wraps, "s string, text string").select("text", licenses.identifiers(F.col("text")).alias("ids")).collect())
    assert {s: ids[t] for s, t in wraps} == {s: f"|~|{i}|~|" for i, ss in licenses.SENTENCES.items() for s in ss} and all(ids[t] == ids[wraps[i - i % 3][1]] for i, (_, t) in enumerate(wraps))


def test_mixing(spark, docs):
    many = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 37 as int)) AS text", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN 'tiny' WHEN id % 11 = 2 THEN NULL ELSE concat('s', id % 4) END AS source", "id AS size")
    taken = mixing.mix(many).collect()
    again = mixing.mix(many.repartition(7)).collect()
    assert Counter((r.doc_id, r._copy, r._shard) for r in taken) == Counter((r.doc_id, r._copy, r._shard) for r in again)
    size, took = Counter(), Counter()
    for r in many.collect():
        size[r.source] += 1 + r.doc_id % 37
    for r in taken:
        took[r.source] += 1 + r.doc_id % 37
    want = mixing.targets(list(size.items()))
    assert abs(sum(want.values()) - sum(size.values())) < 1e-6
    for s, t in want.items():
        assert t <= 3 * size[s] + 1e-9 and abs(took[s] - t) <= 0.01 * t
    assert max(Counter(r.doc_id for r in taken).values()) <= 3
    assert mixing.mix(docs).count() and mixing.mix(docs.limit(0)).count() == 0


def test_split_tree():
    quotas = np.array([7, 0, 1000, 33])
    pools = [np.arange(20), np.arange(5), np.arange(1000), np.arange(64)]
    leaves = mixing.split_tree(quotas, pools, 16, 1)
    out = np.array([[len(drawn) for drawn, _ in leaf] for leaf in leaves])
    assert (out.sum(axis=0) == quotas).all() and out.sum(axis=1).max() - out.sum(axis=1).min() <= 4
    for i, p in enumerate(pools):  # disjoint, and nothing is lost
        assert sorted(x for leaf in leaves for part in leaf[i] for x in part.tolist()) == p.tolist()
    assert [[d.tolist() for d, _ in leaf] for leaf in leaves] == [[d.tolist() for d, _ in leaf] for leaf in mixing.split_tree(quotas, pools, 16, 1)]
    assert mixing.targets([("b", 10), ("a", 10), (None, 10)]) == {"a": 5.0, "b": 10.0, None: 15.0}
    assert mixing.targets([("a", 1), ("b", 100), ("c", 1)]) == {"a": 3.0, "c": 3.0, "b": 96.0}


def test_source_mix_query(spark, tmp_path):
    """The query's sizes, targets and taken words, against a plain version; what is taken depends on the tree's shards and seed."""
    rng = random.Random(6)
    data = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 60))), rng.choice(["hot", "hot", "b", "c", None]) if i % 40 else "tiny") for i in range(2500)]
    data += [(7, data[7][1], data[7][2])] * 3 + [(None, "no id here", "b"), (9001, None, "c"), (9002, "", None), (9003, "x " * 5000, "hot")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op10_source_mix(spark, str(tmp_path)).collect()
    size = Counter()
    for _, t, s in data:
        size[s] += len((t or "").split())
    # targets by hand: shares by weight, what is above three times a source's size goes to the others
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, target = set(), {}
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in full)
        target = {s: 3.0 * size[s] if s in full else left * weight[s] / sum(weight[x] for x in names if x not in full) for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * size[s]}
        if not over:
            break
        full |= over
    source = {i: s for i, _, s in data}
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == Counter((i, len((t or "").split()), size[s]) for i, t, s in data)
    took = Counter()
    for r in got:
        s = source[r.doc_id]
        took[s] += r.taken
        assert math.isclose(r.target, target[s]) and r.taken == r["size"] * len(r.shards) <= 3 * r["size"] and (r["size"] or not r.shards)
    assert all(abs(took[s] - target[s]) <= 60 for s in names)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    by = lambda **k: Counter((r.doc_id, r.taken, tuple(r.shards)) for r in mixing.taken(docs, **k).collect())
    words = lambda x: Counter((d, t) for (d, t, _), n in x.items() for _ in range(n))
    one, same, other, seeded = by(shards=16), by(shards=16), by(shards=3), by(shards=16, seed=8)
    assert one == same == Counter((r.doc_id, r.taken, tuple(r.shards)) for r in got)
    assert words(one) != words(other) and words(one) != words(seeded) and max(j for _, _, x in other for j in x) == 2
    rows = mixing.mix(docs.withColumn("_shard", F.lit("mine")), shards=16)
    assert rows.columns == ["doc_id", "text", "source", "_copy", "_shard"]
    assert Counter((r.doc_id, r._shard) for r in rows.collect()) == Counter((d, j) for (d, _, x), n in one.items() for _ in range(n) for j in x)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert jaccard_join.jaccard_components(none).count() == 0 and jaccard_join.keep_one(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0 and sentencepiece_bpe.encode(none).count() == 0
    assert licenses.scan(none).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.embedding_links(vectors).count() == 0

"""Operators that learn: held-out accuracy, gradients, probabilities, planted outliers; edge cases of each; the pipeline."""

import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from immunoframe.llm import gru_lm, quality, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score double, _q string"
EDGES = [(1, None, "en", "s"), (2, "", None, None), (3, " \n\t ", "en", "s"), (None, "null id " * 30, "en", "s"), (4, "one two three", "xx", "y"), (4, "one two three", "xx", "y"), (5, "W" * 50_000, "en", "s"), (6, "a b c d e f g " * 4000, "en", None)]
SYLLABLES = ["th", "er", "on", "an", "re", "ha", "ti", "en", "at", "ou", "ing", "ly"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, so, 5, "k", None, "q") for i, t, la, so in rows], DOCS)


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) + (rng.choice([".", ",", "\n"]) if rng.random() < 0.15 else "") for _ in range(n))


# --- 6 ------------------------------------------------------------------------------------------------

def brute_stats(text):
    import re

    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def test_quality_rules(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(60, 200)), "en", "a" if i % 3 else "b") for i in range(100, 400)]
    rows += [(i, " ".join(w + "%%%" for w in prose(rng, 100).split()), "en", "a") for i in range(500, 520)]
    rows += [(i, prose(rng, 100).upper().replace(" ", "!! "), "en", "rare") for i in range(600, 604)]
    rows += EDGES
    out = quality.quality_rules(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    want = sorted((repr(i), *brute_stats(t)) for i, t, _, _ in rows)
    assert sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in out)
    kept = {r.doc_id for r in out if r.kept}
    assert sum(i in kept for i in range(100, 400)) >= 298 and not any(i in kept for i in range(500, 604))
    good = quality.keep_good(frame(spark, rows))
    assert {r.doc_id for r in good.collect()} == kept and good.columns == frame(spark, rows).columns
    assert quality.quality_rules(frame(spark, rows).limit(0)).count() == 0 and quality.keep_good(frame(spark, rows).limit(0)).count() == 0


def plain_mcd(x, rng):
    """Mean and covariance of the subset of least determinant over many starts with exact concentration steps."""
    h, best = int(np.ceil(quality.SUPPORT * len(x))), None
    floor = np.diag(np.square(quality.FLOOR))
    for _ in range(30):
        own = x[rng.choice(len(x), 12, replace=False)]
        for _ in range(40):
            mean, cov = own.mean(axis=0), np.cov(own.T, bias=True) + floor
            d2 = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            own = x[np.argsort(d2, kind="stable")[:h]]
        det = np.linalg.slogdet(np.cov(own.T, bias=True) + floor)[1]
        if best is None or det < best[0]:
            best = det, own.mean(axis=0), np.cov(own.T, bias=True) + floor
    return best


def test_kept_against_a_plain_estimate(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(6, 6)) * 0.3 + np.eye(6) * 0.4
    x = rng.normal(size=(900, 6)) @ mix
    x[:150] = rng.normal(size=(150, 6)) * 0.2 + [4, -4, 3, 5, -4, 6]  # a cluster that draws a plain mean and covariance to it
    stats = spark.createDataFrame([("en", "s", False, *map(float, v), i) for i, v in enumerate(x)], f"lang string, source string, base_failed boolean, {', '.join(f'{f} double' for f in quality.FEATURES)}, i int")
    out = quality.judge(stats, quality.fit(stats, ["lang", "source"]), ["lang", "source"]).collect()
    kept = {r.i for r in out if r.kept}
    _, mean, cov = plain_mcd(x, rng)
    d2 = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
    inside = d2 <= quality.chi2(0.975, 6) * np.median(d2) / quality.chi2(0.5, 6)
    mean, cov = x[inside].mean(axis=0), np.cov(x[inside].T, bias=True) + np.diag(np.square(quality.FLOOR))
    far = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean) > quality.chi2(quality.CUT, 6)
    want = set(np.flatnonzero(~far).tolist())
    assert not kept & set(range(150)) and not want & set(range(150)) and len(kept ^ want) <= 3


def test_refit_is_mean_and_inverse_covariance():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 6)) @ rng.normal(size=(6, 6))
    mean, tri, logdet = quality.refit(500, x.sum(axis=0), (x.T @ x)[np.triu_indices(6)])
    p = np.zeros((6, 6))
    p[np.triu_indices(6)] = tri
    p = np.triu(p) + np.triu(p, 1).T
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(np.linalg.inv(p), np.cov(x.T, bias=True) + np.diag(np.square(quality.FLOOR)))
    assert abs(logdet + np.linalg.slogdet(p)[1]) < 1e-6
    assert abs(quality.chi2(0.975, 6) - 14.449) < 0.05


# --- 1 ------------------------------------------------------------------------------------------------

def test_folding_and_exceptions():
    a = toxicity.Model(dict(toxicity.SEED_LEXICON), toxicity.EXCEPTIONS, toxicity.FIXED_SLOPES).automaton()
    hits = lambda t: toxicity.evidence(t, a)[3]
    assert hits("You 1D10T!") == hits("an іdіоt") == hits("ｉｄｉｏｔ") == hits("ïdïót's") == hits("id\u00adiot") == 1
    assert hits("a midiot") == hits("") == hits("the trash can") == hits("Clown-fish") == 0
    assert hits("trash can, trash") == 1 and hits("clown clown") == 2


def test_toxicity_learns(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1000):
        words = prose(rng, rng.randint(20, 120)).split()
        toxic = rng.random() < 0.25
        for _ in range(rng.randint(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["zubbrak", "zubbrakel", "vloggen", "idiot"]))
        rows.append((i, " ".join(words), None, None))
        labels.append((i, 1, int(toxic)))
    lab = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    rows += [(i + 5000 if i else None, *rest) for i, *rest in EDGES]
    out = {r.doc_id: r for r in toxicity.toxicity(frame(spark, rows), lab).collect() if r.doc_id is not None}
    held = [(out[i].predicted, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= out[i].score <= 1 for i, _, _ in labels)
    assert sum(a == b for a, b in held) / len(held) > 0.98
    clean = toxicity.keep_clean(frame(spark, rows), lab)
    assert clean.columns == frame(spark, rows).columns and clean.count() == sum(r.predicted == 0 for r in toxicity.toxicity(frame(spark, rows), lab).collect())
    none = toxicity.toxicity(frame(spark, rows), lab.limit(0))
    assert none.where("predicted = 1").count() > 0 and none.count() == len(rows)
    assert toxicity.toxicity(frame(spark, rows).limit(0), lab).count() == 0


# --- 4 ------------------------------------------------------------------------------------------------

def small_words(n=70):
    top = [(f"w{i}".encode(), 100 - i) for i in range(n)]
    mass = np.full(gru_lm.OTHER, 5.0)
    return gru_lm.Words(top, 40, mass)


def test_probabilities_sum_to_one():
    words = small_words()
    w = gru_lm.fresh(words)
    h = np.random.default_rng(1).normal(size=(1, 1, gru_lm.HIDDEN)).astype(np.float32)
    every = np.arange(words.end + 1)
    logs = [gru_lm.log_likelihood(w, words, h, np.array([[s]]))[0, 0] for s in every]
    assert abs(sum(map(math.exp, logs)) - 1) < 1e-4


def test_gradients():
    words = small_words()
    rng = np.random.default_rng(2)
    w = {k: v.astype(np.float64) for k, v in gru_lm.fresh(words).items()}
    given, target = rng.integers(0, words.end + 1, (gru_lm.STEPS, 3)), rng.integers(-1, words.end + 1, (gru_lm.STEPS, 3))
    starts = rng.random((gru_lm.STEPS, 3)) < 0.1
    h0 = np.zeros((3, gru_lm.HIDDEN))

    def loss():
        states, _, _ = gru_lm._forward(w, given, starts, h0, False)
        return -gru_lm.log_likelihood(w, words, states.astype(np.float64), target).sum() / (target >= 0).sum()

    states, _, store = gru_lm._forward(w, given, starts, h0, True)
    grads, n = gru_lm._gradients(w, words, given, target, starts, states, store)
    assert n == (target >= 0).sum()
    for k, g in grads.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old, e = w[k][at], 1e-2
        w[k][at] = old + e
        up = loss()
        w[k][at] = old - e
        down = loss()
        w[k][at] = old
        assert abs((up - down) / (2 * e) - g[at]) < 0.02 * abs(g[at]) + 1e-5, k


def test_lanes_give_every_document_whole():
    words = small_words()
    w = gru_lm.fresh(words)
    rng = np.random.default_rng(3)
    docs = [(i, np.append(rng.integers(0, words.end, rng.integers(0, 150)), words.end).astype(np.int32)) for i in range(40)]
    sums = np.zeros(40)
    h = np.zeros((5, gru_lm.HIDDEN), np.float32)
    for given, target, starts, owner, kept in gru_lm.Lanes(docs, 5, words.end).windows():
        h = h if kept is None else h[kept]
        states, h, _ = gru_lm._forward(w, given, starts, h, False)
        np.add.at(sums, owner.ravel(), gru_lm.log_likelihood(w, words, states, target).ravel())
    for i, s in docs:  # one at a time, in one stretch
        given = np.concatenate([[words.end], s[:-1]])[:, None]
        states, _, _ = gru_lm._forward(w, given, np.zeros((len(s), 1), bool), np.zeros((1, gru_lm.HIDDEN), np.float32), False)
        assert abs(gru_lm.log_likelihood(w, words, states, s[:, None]).sum() - sums[i]) < 1e-2


def test_every_training_document_gives_gradient_steps(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "WARM_DOCS", 0)
    words = gru_lm.Words([(b"a", 9), (b"b", 5)], 4, np.full(gru_lm.OTHER, 5.0))
    start = gru_lm.fresh(words)
    for key in (-1, 200 << 21, 1000 << 21):  # each the only document
        df = spark.createDataFrame([("a b a a b", key)], "_t string, _key long")
        trained = gru_lm.fit_network(df, words, 1)
        assert any(not np.array_equal(trained[k], start[k]) for k in start)


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "TOP", 40)  # most words take the way of the join
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["aa bb cc dd", "ee ff gg hh", f"x{rng.randint(0, 300)}y"]) for _ in range(rng.randint(5, 60))), None, None) for i in range(300)] + [(i + 5000 if i else None, *rest) for i, *rest in EDGES]
    out = gru_lm.score_documents(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    crc = lambda i: 0 if i is None else zlib.crc32(str(i).encode()) % 7
    split = lambda t: (t or "").encode().lower().split() + ["end"]
    c = Counter(w for i, t, _, _ in rows if crc(i) != 2 for w in split(t))
    n, v = sum(c.values()), len(c)
    want = sorted((repr(i), crc(i) == 2, len(split(t)), sum(c[w] > 0 for w in split(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in split(t)), 5)) for i, t, _, _ in rows)
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out) == want
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert gru_lm.score_documents(frame(spark, rows).limit(0)).count() == 0
    alone = gru_lm.score_documents(frame(spark, [(i, "a b", None, None) for i in range(60) if crc(i) == 2])).collect()
    assert alone and all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in alone)


def test_words_read_through_arrow():
    rng = random.Random(8)
    texts = [None, "", " \t\n", "  A\tb\x0bC\x0cd\re\x1cf\x85g\u2003h\xa0 É9, ", *(prose(rng, rng.randint(0, 90)) + rng.choice(["", " 7.", "\n", " ü-Ö"]) for _ in range(50))]
    split = [(t or "").encode().lower().split() for t in texts]
    for own, want in ((texts, split), (texts[:0], []), (texts[:3], split[:3])):
        flat, numbers = gru_lm.split_words(pa.array(own, pa.string()))
        assert flat.to_pylist() == sum(want, []) and numbers.tolist() == [len(x) for x in want]
    counts = Counter(w for x in split for w in x)
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:60]
    old, gru_lm.VOCAB = gru_lm.VOCAB, 20
    try:
        words = gru_lm.Words(top, len(texts), np.full(gru_lm.OTHER, 9.0))
    finally:
        gru_lm.VOCAB = old
    rank = {w: i for i, (w, _) in enumerate(top)}
    symbol = lambda w: rank[w] if rank.get(w, 20) < 20 else 20 + gru_lm.other_class(w)
    for x, n, known, log_all, log_other, rare, symbols in zip(split, *(c.to_pylist() for c in words.read(pa.array(texts, pa.string()))), strict=True):
        assert n == len(x) and known == sum(w in rank for w in x) and rare == [w for w in x if w not in rank]
        assert np.frombuffer(symbols, np.int16).tolist() == [*map(symbol, x), words.end]
        logs = {w: math.log10(c + 1) for w, c in top}
        outside = [w for w in x if rank.get(w, 20) >= 20]
        assert log_all == pytest.approx(sum(logs.get(w, 0) for w in x))
        assert log_other == pytest.approx(sum(logs.get(w, 0) - math.log10(10) for w in outside))


def test_top_words(spark, monkeypatch):
    counts = [(b"e", 1), (b"a", 9), (b"d", 4), (b"c", 4), (b"b", 7), (b"f", 1)]
    df = spark.createDataFrame(counts, "word binary, c long")
    for vocab, top, want in ((1, 6, "abcdef"), (1, 5, "abcd"), (1, 3, "ab"), (3, 3, "abc"), (2, 1, "a"), (6, 6, "abcdef")):
        monkeypatch.setattr(gru_lm, "VOCAB", vocab)
        monkeypatch.setattr(gru_lm, "TOP", top)
        assert gru_lm.top_words(df) == [(w.encode(), dict(counts)[w.encode()]) for w in want]
    assert gru_lm.top_words(df.limit(0)) == []


def test_network_reads_each_text_once(spark, monkeypatch):
    """Training and scoring take the written symbols."""
    asked = []
    read = gru_lm.read_texts
    monkeypatch.setattr(gru_lm, "read_texts", lambda docs, words: asked.append(docs.columns) or read(docs, words))
    rows = [(i, "a b c a", None, None) for i in range(40)]
    assert gru_lm.score_documents(frame(spark, rows)).count() == 40
    assert len(asked) == 1 and "_t" in asked[0]


def test_class_logs_in_and_out_of_range():
    rng = np.random.default_rng(6)
    words = small_words()
    for factor in (1, 300):
        w = {k: v * np.float32(factor) if k == "wc" else v for k, v in gru_lm.fresh(words).items()}
        h, own = rng.uniform(-1, 1, (200, gru_lm.HIDDEN)).astype(np.float32), rng.integers(0, words.n_classes, 200)
        x = h.astype(float) @ w["wc"] + w["bc"]
        want = x[np.arange(200), own] - np.logaddexp.reduce(x, axis=1)
        assert np.allclose(gru_lm._class_logs(w, h, own, {}), want, atol=1e-4, rtol=1e-5)


def test_sums_by_id_and_reused_arrays():
    rng = np.random.default_rng(4)
    ids, d = rng.integers(0, 30, 500).astype(np.int32), rng.normal(size=(4, 500, gru_lm.HIDDEN)).astype(np.float32)
    want = np.zeros((40, 3 * gru_lm.HIDDEN))
    np.add.at(want, ids, np.hstack([d[1], d[2], d[0]]))
    assert np.allclose(gru_lm._sums_by_id(ids, d, 40), want, atol=1e-4)
    words = small_words()
    w, room = gru_lm.fresh(words), {}
    for lanes in (5, 5, 3):  # the same with arrays of the window before
        given, target = (rng.integers(0, words.end + 1, (gru_lm.STEPS, lanes)) for _ in range(2))
        starts, h = rng.random((gru_lm.STEPS, lanes)) < 0.1, rng.normal(size=(lanes, gru_lm.HIDDEN)).astype(np.float32)
        (a, ha, sa), (b, hb, sb) = gru_lm._forward(w, given, starts, h, True), gru_lm._forward(w, given, starts, h, True, room)
        assert np.array_equal(a, b) and np.array_equal(ha, hb)
        one, two = gru_lm._gradients(w, words, given, target, starts, a, sa)[0], gru_lm._gradients(w, words, given, target, starts, b, sb, room)[0]
        assert all(np.allclose(one[k], two[k], atol=1e-7) for k in w)


# --- pipeline -----------------------------------------------------------------------------------------

def test_pipeline(spark, tmp_path):
    rng = random.Random(9)
    base = [(i, prose(rng, rng.randint(60, 160)), "en", "a") for i in range(260)]
    rows = list(base)
    rows += [(1000 + i, base[i][1] + " tail", "en", "a") for i in range(20)]  # near copies
    rows += [(2000 + i, base[i][1], "en", "a") for i in range(10)]  # copies
    rows += [(3000 + i, " ".join(w + "###" for w in prose(rng, 90).split()), "en", "a") for i in range(10)]  # poor
    item = prose(random.Random(77), 30)
    rows += [(4000 + i, prose(rng, 80) + " " + item + " " + prose(rng, 30), "en", "a") for i in range(8)]  # leaks
    toxic = []
    for i in range(60):
        words = prose(rng, 80).split()
        for _ in range(4):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum"]))
        toxic.append((5000 + i, " ".join(words), "en", "a"))
    rows += toxic + [(None, None, None, None)]
    spark.createDataFrame([(i, t, la, so, 1) for i, t, la, so in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, 1, 0) for i, *_ in base] + [(i, 1, 1) for i, *_ in toxic], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not any(i >= 1000 for i in got) and len(got & set(range(260))) >= 256


@pytest.mark.parametrize("at", range(4))
def test_stages_return_the_columns_of_documents(spark, tmp_path, at):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.STAGES[at][1](spark, docs.limit(0), str(tmp_path))
    assert out.columns == docs.columns and out.select(F.count("*")).first()[0] == 0


def naive_evidence(text, model):
    """Every stem at every word, and whether a phrase that begins before reaches over it, one by one."""
    words = toxicity.fold(text).split()
    phrases = [toxicity.fold(p).split() for p in model.exceptions]
    line = " " + " ".join(words) + " "
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    excused = [False] * len(words)
    for p in phrases:
        mark = " " + " ".join(p)
        for i in range(len(words)):
            if line.startswith(mark, starts[i]):
                for j in range(len(words)):
                    if starts[i] <= starts[j] <= starts[i] + len(mark) - 1:
                        excused[j] = True
    weights = [max((v for stem, v in model.lexicon.items() if w.startswith(stem)), default=0.0) for w in words]
    hits = [v for v, e in zip(weights, excused, strict=True) if v > 0 and not e]
    if not hits:
        return 0.0, 0.0, 0.0, 0
    return float(np.log1p(sum(hits))), float(np.log1p(100 * sum(hits) / len(words))), max(hits), len(hits)


def test_evidence_against_a_naive_matcher():
    rng = random.Random(5)
    model = toxicity.Model({"trash": 2.0, "tra": 0.5, "idiot": 3.0, "can": 0.3}, ("trash can", "the idiot box"), toxicity.FIXED_SLOPES)
    automaton = model.automaton()
    parts = ["trash", "tr4sh", "can", "the", "idiot", "1diotic", "box", "trashy", "a", "canned", "the  idiot,  box"]
    for _ in range(300):
        text = rng.choice([" ", ", ", "  "]).join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert toxicity.evidence(text, automaton) == pytest.approx(naive_evidence(text, model))


def test_a_very_long_text_of_phrases_takes_time_in_proportion():
    automaton = toxicity.Model({"trash": 2.0, "idiot": 3.0}, ("trash can",), toxicity.FIXED_SLOPES).automaton()
    began = time.process_time()
    assert toxicity.evidence("trash can " * 100_000 + "idiot", automaton)[3] == 1
    assert time.process_time() - began < 10

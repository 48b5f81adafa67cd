"""Embedding whitening, language-model scoring and ranked lexical search."""

import math
import re

import numpy as np
import pytest

from tagloom.llm import lexical_search
from tagloom.llm import lm_scoring as lm
from tagloom.llm.lexical_search import search
from tagloom.llm.whitening import whiten

# ---------------------------------------------------------------- whitening


def _embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n long, x string")


def _brute_whitening(vectors):
    x = np.floor(1024 * np.asarray(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64) + 100000
    n, s = len(x), x.sum(0)
    c = x * n - s
    cov = (c.T.astype(object) @ c.astype(object)).astype(float) / n**3
    e, u = np.linalg.eigh(cov)
    o = np.argsort(-e)[:8]
    return (c.astype(object) ** 2).sum(1), (c / n) @ u[:, o] / np.sqrt(e[o]), e[o] / np.trace(cov)


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(10, 10))
    data = (rng.normal(size=(300, 10)) @ mix * 0.05).astype(np.float32)
    rows = [(i, [float(v) for v in r], 0, 1, "a") for i, r in enumerate(data)]
    rows += [(1000, None, 0, 1, "a"), (1001, [float("nan")] * 10, 0, 1, "a"), (1002, [None] * 10, 0, 1, "a"), (1003, [0.1] * 3, 0, 1, "a")]
    got = whiten(_embeddings(spark, rows)).toPandas().sort_values(["vec_id", "component"])
    deviation, white, explained = _brute_whitening(data)
    assert set(got.vec_id) == set(range(300)) and got.n.unique().tolist() == [300]
    w = got.whitened.to_numpy().reshape(300, 8)
    signs = np.sign((w * white).sum(0))
    assert np.abs(w - white * signs).max() < 1e-8
    assert (got.deviation.to_numpy().reshape(300, 8)[:, 0] == deviation.astype(np.int64)).all()
    assert np.allclose(got.explained.to_numpy()[:8], explained, rtol=1e-6)
    assert got.identity_error.max() < 1e-4


def test_whitening_odd_tables(spark):
    assert whiten(_embeddings(spark, [])).count() == 0
    assert whiten(_embeddings(spark, [(1, None, 0, 1, "a")])).count() == 0
    same = whiten(_embeddings(spark, [(1, [0.5, 0.5], 0, 1, "a"), (1, [0.5, 0.5], 0, 1, "a")])).toPandas()
    assert len(same) == 4 and (same.whitened == 0).all() and (same.deviation == 0).all()


# ---------------------------------------------------------------- language-model scoring


def _small_model(vocab=40, k=6, seed=0):
    counts = np.arange(vocab)[::-1].astype(np.int64)
    model = lm.Model(np.arange(k), counts, vocab, seed=seed)
    rng = np.random.default_rng(seed)
    for name, value in model.p.items():
        model.p[name] = value + rng.normal(0, 0.3, value.shape)
    return model


def test_gradients_match_differences():
    model = _small_model()
    rng = np.random.default_rng(1)
    inp = rng.integers(0, model.classes + 1, (2, 7))
    target = rng.integers(0, model.classes, (2, 7))
    valid = (rng.random((2, 7)) > 0.2).astype(float)
    _, g = model.gradients(inp, target, valid)
    for name in model.p:
        flat = model.p[name].ravel()
        for i in rng.choice(len(flat), 3, replace=False):
            keep = flat[i]
            flat[i] = keep + 1e-6
            up, _ = model.gradients(inp, target, valid)
            flat[i] = keep - 1e-6
            down, _ = model.gradients(inp, target, valid)
            flat[i] = keep
            assert abs((up - down) / 2e-6 - g[name].ravel()[i]) < 1e-5


def test_windows_score_each_token_once_as_alone():
    model = _small_model()
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 40, n) for n in (0, 1, 5, lm.WINDOW - 1, lm.WINDOW, 3 * lm.WINDOW + 7)]
    got = model.token_log10(texts, dtype=np.float64)
    fast = model.token_log10(texts)
    for ids, total, quick in zip(texts, got, fast):
        assert quick == pytest.approx(total, rel=1e-4)
        inp, tgt = model.classes_of(ids)
        want = 0.0
        for pos in range(len(tgt)):
            start = 0 if pos < lm.WINDOW else ((pos - lm.WINDOW) // lm.STRIDE + 1) * lm.STRIDE
            logp = model.forward(inp[None, start : min(start + lm.WINDOW, len(inp))])[0]
            p = logp[pos - start, tgt[pos]] / math.log(10)
            if tgt[pos] == model.k + 1:
                p += model.rest_log[ids[pos]]
            want += p
        assert total == pytest.approx(want, abs=1e-9)


def test_probabilities_sum_to_one_over_the_vocabulary():
    model = _small_model()
    prefix = np.array([3, 17, 9])
    inp, _ = model.classes_of(prefix)
    logp = model.forward(inp[None])[0][-1]
    rare = [i for i in range(40) if model.lookup[i] == model.k + 1]
    mass = sum(math.exp(logp[model.lookup[i]]) for i in range(40) if i not in rare)
    mass += sum(math.exp(logp[model.k + 1]) * 10 ** model.rest_log[i] for i in rare) + math.exp(logp[0])
    assert mass == pytest.approx(1.0, abs=1e-9)


def test_training_lowers_the_loss():
    model = _small_model(seed=4)
    rng = np.random.default_rng(5)
    seq = np.tile(np.arange(1, 7), 40)  # a repeating pattern the model can learn
    windows = np.array([np.concatenate([[model.k + 2], seq[i : i + lm.WINDOW]]) for i in range(0, 64, 2)])
    losses = model.fit(windows, epochs=30, seed=int(rng.integers(100)))
    assert np.mean(losses[-5:]) < 0.5 * np.mean(losses[:5])


def test_every_learning_window_is_trained_on(spark):
    model = _small_model()
    before = {n: v.copy() for n, v in model.p.items()}
    rng = np.random.default_rng(3)
    lengths = [0, 5, 63, 64, 65, 200] + [20] * 9000  # more rows and windows than the former bounds of 3,000 and 6,000
    rows = [(i % 5 == 0, [int(x) for x in rng.integers(0, 40, n)]) for i, n in enumerate(lengths)]
    ids = spark.createDataFrame(rows, "held_out boolean, ids array<int>").repartition(3)
    want = sum(-(-(len(x) + 1) // lm.WINDOW) for h, x in rows if not h)
    assert lm.fit_all(ids, model) == [want] * 3 == [want] * lm.MOST_PASSES
    assert all((model.p[n] != before[n]).any() for n in before)
    cut = model.cut([np.array(x, dtype=np.int64) for _, x in rows[:6]])
    assert (cut[:, 1:] >= 0).sum() == sum(len(x) + 1 for _, x in rows[:6])
    none = _small_model()
    assert lm.fit_all(ids.limit(0), none) == [0]


def _mass(model, prefix):
    """Sum of the probabilities of all ids of the vocabulary, and of the end, after a prefix."""
    return sum(10 ** (model.token_log10([np.array([*prefix, i])], np.float64)[0] - _end(model, [*prefix, i])) for i in range(40)) / _before(model, prefix) + 10 ** _end(model, prefix)


def _end(model, ids):
    inp, _ = model.classes_of(np.array(ids, dtype=np.int64))
    codes = np.concatenate([inp[:1], model.code[np.array(ids, dtype=np.int64)]])
    return model.forward(codes[None])[0][-1][0] / math.log(10)


def _before(model, prefix):
    return 10 ** (model.token_log10([np.array(prefix)], np.float64)[0] - _end(model, prefix))


def test_ids_outside_the_classes_are_learned_by_what_precedes_them():
    """Ids far down the counts follow each other in a fixed order: each is told by the one before it."""
    model = _small_model(seed=4)
    cycle = [20, 31, 25, 38, 29]
    untrained = model.token_log10([np.array(cycle * 6)], np.float64)[0]
    model.fit(model.cut([np.array((cycle * 40)[i:]) for i in range(30)]), epochs=30)
    trained = model.token_log10([np.array(cycle * 6)], np.float64)[0]
    assert trained > untrained / 10
    assert _mass(model, [20, 31, 25]) == pytest.approx(1.0, abs=1e-9)
    after, other = ([np.array([*cycle * 3, i])] for i in (20, 38))
    assert model.token_log10(after)[0] - _end(model, after[0]) > model.token_log10(other)[0] - _end(model, other[0]) + 1


def test_gradients_of_single_ids_and_branchings_match_differences():
    model = _small_model()
    rng = np.random.default_rng(1)
    for n, table in model.rows.items():
        model.rows[n] = table + rng.normal(0, 0.3, table.shape)
    codes = np.concatenate([np.arange(model.k + 3), model.k + 3 + np.arange(6, 40)])
    inp, target = rng.choice(codes, (2, 30)), rng.choice(codes[codes != model.k + 2], (2, 30))
    valid = (rng.random((2, 30)) > 0.2).astype(float)
    _, g = model.gradients(inp, target, valid)
    for name, table in model.rows.items():
        used, uses, moved = g[name]
        assert len(used) > 5 and uses.min() > 0
        for j in rng.choice(len(used), 6):
            col = int(rng.integers(table.shape[1]))
            keep = table[used[j], col]
            table[used[j], col] = keep + 1e-6
            up, _ = model.gradients(inp, target, valid)
            table[used[j], col] = keep - 1e-6
            down, _ = model.gradients(inp, target, valid)
            table[used[j], col] = keep
            assert abs((up - down) / 2e-6 - moved[j, col]) < 1e-5


@pytest.mark.parametrize("n", [0, 1, 2, 3, 40])
def test_tree_starts_at_the_weights(n):
    weights = np.arange(1, n + 1)[::-1].astype(float) ** 2
    tree = lm.Tree(weights)
    for i in range(n):
        step, side = tree.step[tree.ptr[i] : tree.ptr[i + 1]], tree.side[tree.ptr[i] : tree.ptr[i + 1]]
        p = np.prod(1 / (1 + np.exp(-side * tree.start[step])))
        assert p == pytest.approx(weights[i] / weights.sum())


def test_vectors_of_single_ids_are_averaged_by_their_uses(spark):
    """Two tasks that use different ids: each id moves as the task that used it moved it."""
    rng = np.random.default_rng(3)
    texts = [[int(x) for x in rng.choice(part, 50)] for part in ([20, 21, 22], [30, 31, 32]) for _ in range(400)]
    both = spark.createDataFrame([(i < 400, False, t) for i, t in enumerate(texts)], "first boolean, held_out boolean, ids array<int>")
    model, alone = _small_model(), _small_model()
    lm.fit_all(both.where("first").coalesce(1).union(both.where("NOT first").coalesce(1)), model)
    start = alone.rows["in"].copy()
    assert (model.rows["in"][[20, 21, 22, 30, 31, 32]] != start[[20, 21, 22, 30, 31, 32]]).any(axis=1).all()
    assert (model.rows["in"][[25, 35]] == start[[25, 35]]).all()


def _brute_base(texts, ids):
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) for t in texts]
    learn = [w for w, i in zip(words, ids) if i is None or __import__("zlib").crc32(str(i).encode()) % 7 != 2]
    counts = {}
    for w in learn:
        for x in w:
            counts[x] = counts.get(x, 0) + 1
    n = sum(counts.values()) + len(learn)
    v = len(counts) + (1 if learn else 0)
    out = []
    for w in words:
        s = sum(math.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in w) + math.log10((len(learn) + 1) / (n + v + 1))
        out.append((len(w) + 1, sum(1 for x in w if counts.get(x, 0)) + (1 if learn else 0), n, s))
    return out


def test_lm_scoring_base_and_odd_rows(spark, odd_docs):
    got = lm.score(odd_docs, lm_tokenizer()).toPandas()
    rows = odd_docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    want = sorted(_brute_base([r.text for r in rows], [r.doc_id for r in rows]), key=lambda t: (t[0], t[3]))
    have = sorted(zip(got.n_tokens, got.n_known, got.train_tokens, got.base_score), key=lambda t: (t[0], t[3]))
    for a, b in zip(have, want):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9)
    assert np.isfinite(got.score).all() and (got.score < 0).all()
    assert lm.score(odd_docs.limit(0), lm_tokenizer()).count() == 0


def lm_tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------- lexical search


def _brute_search(docs, items, k=20):
    pat = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = [pat.findall((t or "").translate(low)) for _, t in docs]
    big_n = sum(1 for t in terms if t)
    big_l = sum(len(t) for t in terms)
    df = {}
    for t in terms:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item_id, text in sorted(set(items), key=lambda r: (r[0] is None, r[0] or 0)):
        q = pat.findall((text or "").translate(low))
        scored = []
        for (doc_id, _), t in zip(docs, terms):
            if not t:
                continue
            m = 75 + (25 * len(t) * big_n) // big_l
            s = 0
            for x in q:
                tf = t.count(x)
                if tf:
                    s += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[x] + 1))) * ((10**9 * tf) // (1000 * tf + 12 * m))
            if s > 0:
                scored.append((s, doc_id))
        scored.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        out += [(item_id, r + 1, d, s) for r, (s, d) in enumerate(scored[:k])]
    return out


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    vocab = [f"w{i}" for i in range(60)] + ["The", "the", "ÉTÉ", "x1"]
    docs = [(i, " ".join(rng.choice(vocab, int(rng.integers(0, 40))))) for i in range(600)]
    docs += [(600, None), (601, ""), (602, "... ,,, !!!"), (3, docs[3][1]), (None, "w1 w2 w3")]
    items = [(i, " ".join(rng.choice(vocab, int(rng.integers(1, 8))))) for i in range(30)] + [(99, None), (98, "zzz"), (5, "w1 w1")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1))  # a clashing extra column
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in search(d, b).select("item_id", "rank", "doc_id", "score").collect())
    items_merged = {}
    for i, t in items:
        items_merged[i] = (items_merged.get(i, "") + " " + (t or "")) if i in items_merged else (t or "")
    want = sorted(_brute_search(docs, list(items_merged.items())))
    assert got == want


def test_search_stores_a_row_for_each_document(spark, monkeypatch):
    """The terms of a document stay in its row: nothing is written or shuffled for each (document, term)."""
    written = {}

    def spy(df, name):
        written[name] = kept = stage(df, name)
        return kept

    stage = lexical_search.stage
    monkeypatch.setattr(lexical_search, "stage", spy)
    docs = spark.createDataFrame([(i, f"a b c d{i % 7} a") for i in range(500)] + [(500, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a d1 d2"), (2, "b c zz")], "item_id long, text string")
    rows = sorted(tuple(r) for r in search(docs, items).collect())
    assert rows == sorted(_brute_search([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()]))
    per_document = [df.count() for name, df in written.items() if "doc_id" in df.columns]
    assert per_document and max(per_document) <= 501


def test_terms_counted_alike_with_and_without_a_shuffle(spark):
    docs = spark.createDataFrame([(1, "b A a, zz"), (2, None), (3, "none here"), (None, "a")], "doc_id long, text string")
    numbered = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "term string, t int")

    def rows(**options):
        return sorted((r.doc_id or 0, r.n, list(r.t), list(r.tf)) for r in lexical_search.counted(docs, numbered, **options).collect())

    assert rows() == rows(looked_up=2) == [(0, 1, [0], [1]), (1, 4, [0, 1], [2, 1]), (2, 0, [], []), (3, 2, [], [])]


def test_search_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search(d, b).count() == 0
    assert search(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), b.limit(0)).count() == 0

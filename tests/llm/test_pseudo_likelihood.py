import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from affinity.llm import pseudo_likelihood as P
from cases import docs, texts


def trained(train, **options):
    known = P.vocabulary(train)
    pairs = P.spelling(P.word_counts(train), known)
    return known, pairs, P.train(P.encode(train, known, pairs), **options)


def per_token(held, known, pairs, net):
    rows = P.score(P.encode(held, known, pairs), net).collect()
    return sum(r.network_log_likelihood for r in rows) / sum(r.n_tokens for r in rows)


def test_ids_and_places():
    known = {"a": 40, ".": 41}
    ids, sizes = P.padded(P.token_ids([P.tokens(t) for t in ("a. bcd", "", "x" * 99)], known))
    assert sizes.tolist() == [3, 0, 1]
    assert ids[P.places(sizes)].tolist() == [40, 41, 3, 32]
    assert (ids > 0).sum() == 4


def test_blocks_cover_a_text_and_end_at_stops():
    rng = np.random.default_rng(2)
    for n in [0, 1, 7, 8, 9, 40, 41, 500]:
        words = ["." if x < 0.1 else "w" for x in rng.random(n)]
        part = P.blocks(words)
        assert [i for i, _ in part[1:]] == [j for _, j in part[:-1]] and (not n or (part[0][0], part[-1][1]) == (0, n))
        assert all(P.LEAST <= j - i < P.MOST + P.LEAST for i, j in part) or n < P.LEAST
        assert all(words[j - 1] == "." or j - i == P.MOST for i, j in part[:-1])


def test_spelling_is_a_distribution_over_words_of_a_length(spark):
    counts = spark.createDataFrame([("ab", 3), ("ba", 1), ("zz", 5), ("known", 9)], "word string, n long")
    pairs = P.spelling(counts, {"known": 40, "zz": 41})
    table = pairs.reshape(256, 256)
    assert np.allclose(np.exp(table).sum(1), 1, atol=1e-4)
    assert abs(table[0, ord("a")] - math.log(3.5 / (4 + 128))) < 1e-5 and abs(table[ord("a"), ord("b")] - math.log(3.5 / (3 + 128))) < 1e-5
    some = ["a", "abc", "\0x", "é😀", "\ud800" + "b", "q" * 40]
    for w, got in zip(some, P.spelled(some, pairs)):
        raw = b"\0" + w.encode("utf-8", "surrogatepass")
        want = sum(table[x, y] for x, y in zip(raw, raw[1:])) - max(0, len(w) - 31) * math.log(2)
        assert abs(got - want) < 1e-4
    assert len(P.spelled([], pairs)) == 0


def test_probabilities_sum_to_one_and_match_a_plain_softmax():
    rng = np.random.default_rng(0)
    net = P.Network()
    ids = rng.integers(1, P.SIZE, 30).astype(np.int32)
    ids[:2] = ids[-2:] = 0
    total = 0.0
    for w in range(P.SIZE):
        x = ids.copy()
        x[10] = w
        total += float(np.exp(net.log_p(x, np.array([10]))[0]))
    assert abs(total - 1) < 1e-4
    at = np.arange(2, 28)
    each = [net.log_p(ids, np.array([i]))[0] for i in at]
    assert np.allclose(net.log_p(ids, at), each, atol=1e-5)


def test_gradient_step_is_the_numeric_gradient():
    rng = np.random.default_rng(1)
    ids = rng.integers(1, 60, 40).astype(np.int32)
    at = np.arange(2, 38)
    base = P.Network()
    moved = P.Network(base.flat.copy())
    moved.step(ids, at, 1.0)
    gradient = (moved.flat - base.flat).astype(np.float64)
    big = np.argsort(-np.abs(gradient))[:40:5]
    for i in big:
        f = []
        for e in (1e-2, -1e-2):
            x = base.flat.copy()
            x[i] += e
            f.append(P.Network(x).log_p(ids, at).mean())
        assert abs((f[0] - f[1]) / 2e-2 - gradient[i]) < 0.05 * abs(gradient[i]) + 1e-4


def test_training_beats_the_untrained_and_frequencies(spark):
    words = [f"w{i}" for i in range(30)]

    def chain(seed, n):  # mostly the next word of a circle
        rng = np.random.default_rng(seed)
        at = np.cumsum(np.where(rng.random(n) < 0.9, 1, rng.integers(0, 30, n))) % 30
        return " ".join(words[i] for i in at)

    train = docs(spark, [chain(i, 400) for i in range(60)]).repartition(2)
    held = docs(spark, [chain(900 + i, 200) for i in range(5)])
    known, pairs, net = trained(train, rounds=3, masked=0.5, batch=64, rate=1.0)
    got = per_token(held, known, pairs, net)
    assert got > per_token(held, known, pairs, P.Network()) + 1.0
    c = Counter(w for r in train.collect() for w in P.tokens(r.text))
    n = sum(c.values()) + P.SIZE
    assert got > np.mean([np.log((c[w] + 1) / n) for r in held.collect() for w in P.tokens(r.text)])


def plain_scores(rows, known, pairs, net):
    """Every token by itself: a softmax written out, spelling, and a dictionary of blocks."""
    where = defaultdict(set)
    for k, (_, t) in enumerate(rows):
        w = P.tokens(t or "")
        for i, j in P.blocks(w):
            where[tuple(w[i:j])].add(k)
    table = pairs.reshape(256, 256)
    for k, (key, t) in enumerate(rows):
        w = P.tokens(t or "")
        ids = [0, 0, *[known.get(x) or min(len(x), 32) for x in w], 0, 0]
        log_p = []
        for i, x in enumerate(w):
            h = np.tanh(sum(net.embed[e][ids[i + 2 + d]].astype(float) for e, d in enumerate(P.SIDES)) + net.bias)
            own = ids[i + 2]
            z = net.top @ h + net.top_bias
            group = own if own < P.HEAD else P.HEAD + (own - P.HEAD) // P.EACH
            p = z[group] - np.log(np.exp(z).sum())
            if own >= P.HEAD:
                z = net.low[group - P.HEAD] @ h + net.low_bias[group - P.HEAD]
                p += z[(own - P.HEAD) % P.EACH] - np.log(np.exp(z).sum())
            if x not in known:
                raw = b"\0" + x.encode()
                p += sum(table[a, b] for a, b in zip(raw, raw[1:])) - max(0, len(x) - 31) * math.log(2)
            log_p.append(p)
        more, seen = 0.0, 0
        for i, j in P.blocks(w):
            if len(where[tuple(w[i:j])]) > 1:
                seen += j - i
                more += sum(math.log(P.RECALL + (1 - P.RECALL) * math.exp(p)) - p for p in log_p[i:j])
        yield key, len(w), seen, sum(log_p), sum(log_p) + more


def test_the_query_matches_a_plain_version(spark, tmp_path, monkeypatch):
    many = " ".join(f"t{i:04}" for i in range(P.SIZE))  # more words than have a token
    line = "this long line stands in several of the documents here ."
    some = [many + " " + many, f"{line} alone one two three four five six.", f"once. {line}", f"{line} {line} rareone raretwo", "short", "short",
            "said twice in this one only . said twice in this one only .", "naïve \0 word " + "x" * 50, None, "", " . "]
    rows = [*enumerate(some), (None, line), (3, "an id that comes twice")]
    d = spark.createDataFrame([(k, t, "n") for k, t in rows], "doc_id bigint, text string, ids string").repartition(3)
    path = str(tmp_path / "documents.parquet")
    d.write.parquet(path)
    nets = []
    train = P.train
    monkeypatch.setattr(P, "train", lambda *a, **k: nets.append(train(*a, **k)) or nets[-1])
    monkeypatch.setattr(P, "COMMON", 4)  # some blocks are common, others not
    got = P.query(spark, str(tmp_path)).collect()
    assert got[0].__fields__ == ["doc_id", "n_tokens", "n_recalled", "network_log_likelihood", "log_likelihood", "perplexity"]
    counts = P.word_counts(d)
    known = P.vocabulary(d, counts=counts)
    assert len(known) == P.SIZE - P.BY_LENGTH - 1 and known == P.vocabulary(d)
    order = lambda x: (x[0] is None, x[0] or 0, x[1], x[2], round(x[3], 1))
    want = sorted(plain_scores(rows, known, P.spelling(counts, known), nets[0]), key=order)
    got = sorted([(r.doc_id, r.n_tokens, r.n_recalled, r.network_log_likelihood, r.log_likelihood, r.perplexity) for r in got], key=order)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:3] == w[:3]
        assert np.allclose(g[3:5], w[3:], rtol=1e-4, atol=1e-3)
        assert g[5] is None if not g[1] else abs(g[5] / math.exp(-g[4] / g[1]) - 1) < 1e-9
    assert {r[2] for r in got if r[0] in (4, 5)} == {1} and [r[2] for r in got if r[0] == 6] == [0]


def test_documents_that_occur_twice_score_apart(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdeghilnorstu"), rng.integers(2, 9)))
    text = lambda: " ".join(word() + ("." if rng.random() < 0.1 else "") for _ in range(200))
    once, twice = [text() for _ in range(40)], [text() for _ in range(10)]
    rows = {r.doc_id: r.perplexity for r in P.pseudo_likelihood(docs(spark, once + twice + twice)).collect()}
    assert max(rows[i] for i in range(40, 60)) < 0.1 * min(rows[i] for i in range(40))


def test_odd_rows_and_empty_tables(spark):
    some = texts()
    d = docs(spark, some)
    rows = {r.doc_id: r for r in P.pseudo_likelihood(d).collect()}
    assert len(rows) == len(some)
    for i, t in enumerate(some):
        assert rows[i].n_tokens == len(P.tokens(t or ""))
        assert (rows[i].perplexity is None) == (rows[i].n_tokens == 0)
        assert np.isfinite(rows[i].log_likelihood) and rows[i].log_likelihood >= rows[i].network_log_likelihood
    assert P.pseudo_likelihood(d.limit(0)).count() == 0


def test_the_rounds_of_the_query_predict_every_token_once():
    import inspect
    some = [t or "" for t in texts()] + ["a b c", "a b d", "x"]
    sizes = np.array([len(P.tokens(t)) for t in some])
    default = {k: v.default for k, v in inspect.signature(P.train).parameters.items()}
    assert default["rounds"] > 1
    own = np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in some])
    taken = [P.chosen(own, sizes, turn, default["masked"]) for turn in range(default["rounds"])]
    assert (np.sum(taken, 0) == 1).all()
    every = [P.chosen(own, sizes, turn, 0.3) for turn in range(4)]
    assert np.any(every, 0).all()
    a, b = (P.chosen(np.array([t]), np.array([400]), 0, 0.5) for t in (1, 2))
    assert 120 < (a != b).sum() < 280  # another text has other places


def test_the_defaults_learn_from_every_place(spark):
    words = [f"w{i}" for i in range(30)]

    def chain(seed, n):
        rng = np.random.default_rng(seed)
        at = np.cumsum(np.where(rng.random(n) < 0.9, 1, rng.integers(0, 30, n))) % 30
        return " ".join(words[i] for i in at)

    train = docs(spark, [chain(i, 400) for i in range(800)]).repartition(2)
    held = docs(spark, [chain(9000 + i, 200) for i in range(5)])
    assert per_token(held, *trained(train)) > -0.5


def test_all_classes_in_one_softmax(monkeypatch):
    rng = np.random.default_rng(3)
    ids = np.concatenate([[0, 0], rng.integers(1, P.SIZE, 300), [0, 0]]).astype(np.uint16)
    at = np.arange(2, 302)
    net, plain = P.Network(seed=1), P.Network(seed=1)
    h = plain.hidden(ids, at)
    want = []
    for i, t in enumerate(ids[at].astype(int)):
        c, k = divmod(t - P.HEAD, P.EACH)
        x = plain.top @ h[i] + plain.top_bias
        p = x[t if t < P.HEAD else P.HEAD + c] - np.log(np.exp(x).sum())
        if t >= P.HEAD:
            x = plain.low[c] @ h[i] + plain.low_bias[c]
            p += x[k] - np.log(np.exp(x).sum())
        want.append(p)
    assert np.allclose(net.log_p(ids, at), want, atol=1e-4)
    assert np.allclose(net.log_p(np.array([0, 0, 1, 2, 0, 0], np.uint16), np.array([2, 3])),
                       plain.log_p(np.array([0, 0, 1, 2, 0, 0], np.uint16), np.array([2, 3])))  # no token of a class
    calls = []
    residual = P._residual
    monkeypatch.setattr(P, "_residual", lambda x, own: calls.append(x.shape) or residual(x, own))
    net.step(ids, at, 0.5)
    assert len(calls) == 2 and net.log_p(ids, at).sum() > sum(want)
    net.step(np.array([0, 0, 1, 2, 0, 0], np.uint16), np.array([2, 3]), 0.5)
    assert len(calls) == 3


def test_softmax_beyond_what_float32_can_sum():
    rng = np.random.default_rng(4)
    for size in (1, 30, 500):
        x = (rng.standard_normal((7, 50)) * size).astype(np.float32)
        at = rng.integers(0, 7, 50)
        y = x.astype(np.float64) - x.max(0)
        want = y[at, np.arange(50)] - np.log(np.exp(y).sum(0))
        assert np.allclose(P._log_softmax_at(x.copy(), at), want, rtol=1e-5, atol=1e-4)
        g, scale = P._residual(x.copy(), at)
        p = np.exp(y - np.log(np.exp(y).sum(0)))
        p[at, np.arange(50)] -= 1
        assert np.allclose(g * scale, p, atol=1e-5)


def test_a_step_takes_few_passes_over_the_softmax():
    """The softmax is left as powers and a factor a column: no division, no lowering of numbers that are small."""
    x = np.zeros((4, 6), np.float32)
    g, scale = P._residual(x, np.zeros(6, int))
    assert g is x and np.array_equal(x[1:], np.ones((3, 6))) and np.array_equal(x[0], np.full(6, -3.0)) and np.array_equal(scale, np.full(6, 0.25, np.float32))
    net = P.Network()
    assert np.shares_memory(net.top, net.flat) and np.shares_memory(net.low_bias, net.flat)

import math
import random
import zlib

import numpy as np
import pytest

from rillstone.llm import language_id as L

WORDS = {"it": "il la che di non per una con sono come questo anche".split(), "en": "the and of to in that is was for with this from".split(), "de": "der die und das nicht mit ist ein auch für von auf".split()}


def rows(n=400, seed=8):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(5, 40))), lang))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    data = rows()
    truth = {i: lang for i, _, lang in data}
    out = L.identify(frame(spark, data)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_learns_from_nothing_that_is_held_out(spark):
    data = rows()
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    spoiled = [(i, t, "xx" if held(i) else lang) for i, t, lang in data]
    assert {tuple(r) for r in L.identify(frame(spark, data)).collect()} == {tuple(r) for r in L.identify(frame(spark, spoiled)).collect()}


def test_texts_without_letters(spark):
    data = [*rows(100), (900, None, "it"), (901, "", "it"), (902, "123 !?", "it"), (903, "il la che", None)]
    out = {r.doc_id: r for r in L.identify(frame(spark, data)).collect()}
    assert [(out[i].lang_pred, out[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert out[903].lang_pred == "it"


def test_no_label_and_one_label(spark):
    assert {r.lang_pred for r in L.identify(frame(spark, [(i, "abc", None) for i in range(5)])).collect()} == {"und"}
    out = L.identify(frame(spark, [(i, "abc def", "it") for i in range(9)])).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("it", 1.0)}


def test_blocks_count_all_of_a_text(monkeypatch):
    text = "parola " * 100
    whole = L.counts(text)
    monkeypatch.setattr(L, "BLOCK", 70)
    assert np.array_equal(L.counts(text), whole)


def test_penalty_makes_weights_sparse(spark):
    model = L.train(frame(spark, rows()))
    assert (model.weights != 0).mean() < 0.5 and 0.05 <= model.temperature <= 20


def plain_counts(text):
    """How often each column occurs, n-gram by n-gram."""
    word, out = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " ", {}
    while "  " in word:
        word = word.replace("  ", " ")
    mask = (1 << 32) - 1
    codes = [ord(c) for c in word]
    c = [x * 2654435761 & mask for x in codes]
    two = [(c[i] ^ (c[i + 1] >> 7)) * 2246822519 & mask for i in range(len(c) - 1)]
    three = [(two[i] ^ (c[i + 2] >> 11)) * 3266489917 & mask for i in range(len(c) - 2)]
    shift = 32 - L.FEATURES.bit_length() + 1
    for h in [x for x, y in zip(c, codes) if y != 32] + two + three:
        out[h >> shift] = out.get(h >> shift, 0) + 1
    return out


def test_counts_equal_plain_ones():
    for text in ("Der Hund läuft", "a", "ab, cd! ef", "  Été\nou  ", "x1y2", "parola " * 40):
        found = L.counts(text)
        assert {int(i): int(found[i]) for i in np.flatnonzero(found)} == plain_counts(text), text
    assert L.counts("123 !") is None


def test_vector_is_tf_idf_of_length_one():
    idf = np.linspace(1, 3, L.FEATURES)
    columns, values = L.vector("il parco e il mare", idf)
    tf = plain_counts("il parco e il mare")
    want = {i: (1 + math.log(n)) * idf[i] for i, n in tf.items()}
    norm = math.sqrt(sum(x * x for x in want.values()))
    assert list(columns) == sorted(want)
    assert np.allclose(values, [want[i] / norm for i in sorted(want)], atol=1e-6)


@pytest.mark.parametrize("l1", [0.02, 2.0])
def test_ftrl_equals_a_plain_version(monkeypatch, l1):
    monkeypatch.setattr(L, "FEATURES", 12)
    monkeypatch.setattr(L, "L1", l1)
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(60):
        columns = np.sort(rng.choice(12, 4, replace=False)).astype(np.int32)
        rows.append((columns, rng.random(4).astype(np.float32), int(columns[0] % 3)))
    weights, bias = L.ftrl(rows, 3, 2)
    z, n = [[0.0] * 3 for _ in range(13)], [[0.0] * 3 for _ in range(13)]

    def weight(i, k):
        if abs(z[i][k]) <= L.L1:
            return 0.0
        return (math.copysign(L.L1, z[i][k]) - z[i][k]) / ((L.BETA + math.sqrt(n[i][k])) / L.ALPHA + L.L2)

    order = np.random.default_rng(7)
    for _ in range(2):
        for r in order.permutation(len(rows)):
            columns, values, label = rows[r]
            x = [*((int(c), float(v)) for c, v in zip(columns, values)), (12, 1.0)]
            scores = [sum(v * weight(i, k) for i, v in x) for k in range(3)]
            e = [math.exp(s - max(scores)) for s in scores]
            error = [a / sum(e) - (k == label) for k, a in enumerate(e)]
            w = {(i, k): weight(i, k) for i, _ in x for k in range(3)}
            for i, v in x:
                for k in range(3):
                    g = v * error[k]
                    sigma = (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / L.ALPHA
                    z[i][k] += g - sigma * w[i, k]
                    n[i][k] += g * g
    assert np.allclose(weights, [[weight(i, k) for k in range(3)] for i in range(12)])
    assert np.allclose(bias, [weight(12, k) for k in range(3)])
    assert (weights == 0).any() == (l1 > 1)  # the penalty leaves weights out


def test_temperature_has_the_least_loss():
    rng = np.random.default_rng(5)
    logits = rng.normal(size=(300, 3)) * 4
    labels = np.array([rng.choice(3, p=L.softmax(z / 2.5)) for z in logits])

    def loss(t):
        doubt = 1 / (len(labels) + 2)
        total = 0.0
        for z, y in zip(logits, labels):
            logp = z / t - np.log(np.exp(z / t - (z / t).max()).sum()) - (z / t).max()
            total -= (1 - doubt) * logp[y] + doubt * logp.mean()
        return total / len(labels)

    t = L.fit_temperature(logits, labels)
    assert min((loss(x), x) for x in np.geomspace(0.05, 20, 400))[1] == pytest.approx(t, rel=0.03)
    assert 1.8 < t < 3.5

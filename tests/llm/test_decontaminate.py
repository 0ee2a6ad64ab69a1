import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from rillstone.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute_force(text, items, size=13):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        for i in range(max(1, len(b) - size + 1) if b else 0):
            window = b[i : i + size]
            for j in range(len(w) - len(window) + 1):
                if w[j : j + len(window)] == window:
                    hit.update(range(j, j + len(window)))
                    found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)


def judged(text, items, size=13):
    patterns = D.Patterns([(str(i), t) for i, t in items], size)
    spans, found = patterns.hits(D.normalise((text or "").encode()))
    return D._judge(D.normalise((text or "").encode()), spans, found)


@settings(max_examples=300, deadline=None)
@given(st.text("ab cé.", max_size=60), st.lists(st.text("ab cé.", max_size=25), max_size=4))
def test_equals_brute_force_on_small_alphabets(text, items):
    pairs = list(enumerate(items))
    assert judged(text, pairs, 3) == brute_force(text, pairs, 3)


def cases():
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(60)] + ["à", "été", "x"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 40)))) for i in range(20)]
    docs = []
    for k in range(60):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 80)))]
        for _ in range(rng.randint(0, 2)):
            w = rng.choice(items)[1].split()
            a = rng.randrange(len(w))
            parts.append(" ".join(w[a : a + rng.randint(5, 30)]).upper())
        docs.append((k, ", ".join(parts)))
    return docs + [(100, None), (101, "")], items


def test_equals_brute_force(spark):
    docs, items = cases()
    want = {i: brute_force(t, items) for i, t in docs}
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for options in ({}, {"pass_bytes": 300}):  # one block, and many
        out = D.contamination(d, b, **options).collect()
        assert {r.doc_id: tuple(r)[1:] for r in out} == want


def test_windows_that_touch():
    text = D.normalise(b"a b c d e f g h")
    assert D._judge(text, *D.Patterns([("1", "a b c"), ("2", "d e f")], 3).hits(text))[:3] == (8, 6, 2)


def test_items_without_an_id(spark):
    items = [(None, "alpha beta gamma"), (None, "delta eps"), (7, "zeta eta theta")]
    docs = [(1, "x alpha beta gamma delta eps y"), (2, "zeta eta theta alpha beta gamma"), (None, "zeta eta theta"), (4, "nothing")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for options in ({}, {"pass_bytes": 1}):
        out = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256) for r in D.contamination(d, b, **options).collect()}
        assert out == {1: (5, 1, sha("")), 2: (6, 2, sha("7")), None: (3, 1, sha("7")), 4: (0, 0, sha(""))}


def test_a_worker_builds_a_blocks_tables_once(spark):
    docs, items = cases()
    many = spark.createDataFrame([(i * 1000 + k, t) for i in range(32) for k, (_, t) in enumerate(docs)], "doc_id long, text string").repartition(16)
    b = spark.createDataFrame(items, "item_id long, text string")
    half = sum(len(t) for _, t in items) // 2 + 40
    for limit, blocks in ((10**6, 1), (half, 2)):
        built = spark.sparkContext.accumulator(0)
        out = D.contamination(many, b, pass_bytes=limit, built=built).collect()
        assert len(out) == 32 * len(docs) >= 1900
        assert blocks <= built.value <= blocks * 4  # workers of the test session
    assert {tuple(r)[1:] for r in out} == {brute_force(t, items) for _, t in docs}


def test_clean_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma", 5, "a"), (2, "other words", 6, "b")], "doc_id long, text string, n_words long, `contaminated` string")
    b = spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta")], "item_id long, text string")
    for options in ({}, {"pass_bytes": 1}):
        assert [tuple(r) for r in D.clean(docs, b, **options).collect()] == [(2, "other words", 6, "b")]

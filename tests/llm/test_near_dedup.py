import random

import numpy as np
import pytest

from rillstone.llm import components as C
from rillstone.llm import near_dedup as N


def brute_force(docs):
    def shingles(text):
        w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= 75 * max(len(x), len(y)):
                n = len(x & y)
                if 100 * n >= 75 * (len(x) + len(y) - n):
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=3, bases=40, family=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 120))] for _ in range(bases)]
    docs = [" ".join(b) for b in base]
    for b in base:
        for _ in range(rng.randint(0, 3)):  # copies at all distances around the threshold
            w = list(b)
            for _ in range(rng.randint(0, max(1, len(w) // 16))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            docs.append(" ".join(w))
    long = [rng.choice(vocabulary) for _ in range(150)]
    for i in range(family):  # a crowded region of near copies that all differ
        w = list(long)
        w[rng.randrange(150)] = f"own{i}"
        docs.append(" ".join(w))
    docs += [docs[0].upper(), docs[0], "a b", "a  b", "A b c", "", None, " \n"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.fixture(scope="module")
def expected():
    docs = corpus()
    return docs, brute_force(docs)


def check(spark, docs, want):
    out = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_equals_brute_force(spark, expected):
    check(spark, *expected)


def test_equals_brute_force_over_cut_orders(spark, expected, monkeypatch):
    monkeypatch.setattr(N, "ROWS_PER_PARTITION", 50)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        check(spark, *expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_candidates_dont_depend_on_cuts(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(5, 10, 60), "doc_id long, text string")
    N.arrow_rows(spark)
    nodes = N.materialize(docs.mapInArrow(N._sign, "doc_id long, n_shingles long, set_key binary, signature binary").where("set_key is not null").dropDuplicates(["set_key"]), "nodes")

    def found():
        pairs, edges = N.candidates(nodes, None, 0, N.TREES, N.WIDTH, True)
        return {tuple(r) for r in pairs.collect()}, {r.node: r.component for r in C.components(edges).collect()}

    whole = found()
    monkeypatch.setattr(N, "ROWS_PER_PARTITION", 20)
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        assert found() == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_chain_links_what_isnt_alike(spark):
    words = [f"v{i}" for i in range(200)]
    chain = [" ".join(words[i * 6 : 100 + i * 6]) for i in range(12)]
    docs = list(enumerate(chain))
    check(spark, docs, brute_force(docs))


def test_planted_pairs_in_a_crowd_of_unlinked_look_alikes(spark):
    base = " ".join(f"base{i}" for i in range(141))  # 137 shingles of all documents; two of them share 137 of 183, 0.749
    tails = {i: [f"own{i}x{k}" for k in range(23)] for i in range(3000)}
    planted = [(i, 1500 + i) for i in range(0, 1500, 250)]
    for a, b in planted:  # 138 of 182, 0.758
        tails[b][:1] = tails[a][:1]
    docs = [(i, f"{base} {' '.join(t)}") for i, t in tails.items()]
    out = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out == {i: i for i in tails} | {b: a for a, b in planted}


def test_links_inside_crowds_of_mixed_sizes(spark):
    docs, want = [], {}
    for g in range(3):
        base = [f"g{g}b{i}" for i in range(104)]  # 100 shingles
        a, b = [*base, *(f"g{g}a{i}" for i in range(9))], [*base, *(f"g{g}z{i}" for i in range(9))]  # 109 each, 100 shared of 118
        first = len(docs)
        docs += [" ".join(a), " ".join(b)]
        docs += [" ".join([*a, *(f"g{g}x{k}y{i}" for i in range(18)), *b]) for k in range(170)]  # 250 each, of other sizes than the two
        want |= {i: i for i in range(first, len(docs))} | {first + 1: first}
    rng = random.Random(9)
    order = list(range(len(docs)))
    rng.shuffle(order)
    rows = [(i, docs[i]) for i in order]
    expected = brute_force(sorted(rows))
    assert sum(c != i for i, (_, c) in expected.items()) >= 3
    check(spark, rows, expected)


def test_ids_that_are_null_or_stand_for_several_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(None, a), (None, a), (1, a), (2, a), (3, b), (3, a), (4, b), (5, None), (5, a)]
    out = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    assert all(r.kept is True and r.component_id is None and r.n_shingles == 26 for r in out if r.doc_id is None)
    of = {i: {r.component_id for r in out if r.doc_id == i} for i in range(1, 6)}
    assert of[1] == of[2] == of[5] == {1} and of[3] in ({1}, {3}) and len(of[4]) == 1
    assert of[4] == ({3} if of[3] == {3} else {4})
    assert all(r.kept == (r.doc_id == r.component_id) for r in out if r.doc_id is not None)
    kept = [r.doc_id for r in N.keep(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert kept.count(None) == 2 and kept.count(1) == 1 and 2 not in kept
    with pytest.raises(TypeError):
        N.near_duplicates(spark.createDataFrame([("x", a)], "doc_id string, text string"))


def test_superseded_tables_are_deleted(spark):
    from rillstone.llm import common

    before = len(common._written)
    N.near_duplicates(spark.createDataFrame(corpus(5, 5, 20), "doc_id long, text string"))
    assert len(common._written) - before <= 3


def test_contraction_equals_one_task(spark):
    rng = random.Random(1)
    links = [(a, b) for a, b in ((rng.randrange(300), rng.randrange(300)) for _ in range(220)) if a != b] + [(500, 500 + i) for i in range(1, 60)]
    df = C.materialize(spark.createDataFrame([(min(x), max(x)) for x in links], "a long, b long"), "links")
    one = {r.node: r.component for r in C.components(df).collect()}
    assert {r.node: r.component for r in C.components(df, one_task_links=20).collect()} == one
    assert {r.node: r.component for r in C.components(df, one_task_links=0).collect()} == one
    assert one[559] == 500


def test_blocks_of_long_texts(monkeypatch):
    text = b"alpha beta  gamma\ndelta " * 50
    whole = N.word_hashes(text)
    monkeypatch.setattr(N, "BLOCK", 7)
    assert np.array_equal(N.word_hashes(text), whole)

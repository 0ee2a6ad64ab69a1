import random

from rillstone.llm import mixing as M


def water_fill(sizes, weights):
    """Targets by resharing the excess until none is above three times its size."""
    total, free, out = sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    left = float(total)
    while free:
        w = sum(weights[i] for i in free)
        share = {i: left * weights[i] / w for i in free}
        over = {i for i in free if share[i] > 3 * sizes[i] + 1e-9}
        if not over:
            for i in free:
                out[i] = share[i]
            break
        for i in over:
            out[i] = 3.0 * sizes[i]
            left -= out[i]
        free -= over
    return out


def frame(spark, seed, sources):
    rng = random.Random(seed)
    rows, k = [], 0
    for name, n in sources.items():
        for _ in range(n):
            rows.append((k, " ".join("w" for _ in range(rng.randint(0, 40))), name))
            k += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def check(spark, docs):
    out = M.mix(docs).collect()
    by = {}
    for r in out:
        by.setdefault(r.source, []).append(r)
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + ([None] if None in by else [])
    sizes = [sum(r.size for r in by[s]) for s in names]
    want = water_fill(sizes, [1 + i % 3 for i in range(len(names))])
    for s, size, target in zip(names, sizes, want, strict=True):
        rows = by[s]
        assert all(r.source_size == size and abs(r.target - target) < 1e-6 for r in rows)
        assert all(0 <= r.taken <= 3 * r.size for r in rows)
        assert abs(sum(r.taken for r in rows) - target) <= max(r.size for r in rows) / 2 + 1
        epochs = int(target // size) if size else 0
        assert all(r.taken in (epochs * r.size, (epochs + 1) * r.size) for r in rows)
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, M.mix(docs.repartition(7)).collect()), key=repr)


def test_targets_and_budgets(spark):
    check(spark, frame(spark, 1, {"a": 60, "b": 30, "c": 4, "d": 50, None: 20}))


def test_sources_at_their_limit(spark):
    check(spark, frame(spark, 2, {"big": 200, "s1": 2, "s2": 1, "s3": 3, "é": 2}))


def test_one_source(spark):
    check(spark, frame(spark, 3, {"only": 20}))


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, " ", None)], "doc_id long, text string, source string")
    assert {tuple(r)[1:5] for r in M.mix(docs).collect()} == {(0, 0, 0.0, 0)}


def test_heavier_documents_come_first_more_often(spark):
    rows = [(i, ("good " * 10 if i % 2 else "#### " * 10), "a") for i in range(2000)] + [(5000 + i, "x " * 5, "b") for i in range(2000)]
    out = M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    good = sum(r.taken > 0 for r in out if r.source == "a" and r.doc_id % 2)
    bad = sum(r.taken > 0 for r in out if r.source == "a" and not r.doc_id % 2)
    assert good > 1.3 * bad


def test_mixture_repeats(spark):
    docs = frame(spark, 4, {"a": 10, "b": 100})
    rows = M.mixture(docs).collect()
    assert rows and all(r.taken == r.repeats * r.size and r.repeats >= 1 for r in rows)


def test_sources_are_numbered_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(M, "SOURCES_PER_TASK", 5)
    names = [None, "Z", "a", "é", "\U00010000", *(f"s{i:02}" for i in range(30))]
    per = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long")
    want = {n: i for i, n in enumerate([*sorted((n for n in names if n is not None), key=lambda s: s.encode()), None])}
    assert {r.source: r.place for r in M.numbered(per).collect()} == want


def test_mixture_by_broadcast_and_by_shuffle(spark, monkeypatch):
    docs = frame(spark, 6, {"a": 40, "b": 5, "c": 80})
    rows = lambda: sorted(tuple(r) for r in M.mixture(docs).collect())
    want = rows()
    assert want and "BroadcastHashJoin" in M.mixture(docs)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(M, "BROADCAST_ROWS", 0)
    assert rows() == want

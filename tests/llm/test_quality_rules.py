import random
import re
from collections import Counter

from rillstone.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    t = text or ""
    w = WORD.findall(t)
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(lines) - len(set(lines)), len(covered)


def texts():
    rng = random.Random(6)
    out = []
    for _ in range(150):
        parts = ["".join(rng.choice(["a", "b", "c ", " ", "\n", "\t", "é", "😀", "#", "|", "\r\n"]) for _ in range(rng.randint(0, 80)))]
        if rng.random() < 0.5:
            parts *= rng.randint(2, 4)
        out.append(" ".join(parts))
    return out + [None, "", " \n\t", "a b c d e " * 4000, "a b c d e f a b c d e"]


def test_statistics_equal_brute_force(spark):
    docs = list(enumerate(texts()))
    none = spark.createDataFrame([], "doc_id long, quality int")
    for r in Q.quality(spark.createDataFrame(docs, "doc_id long, text string"), none).collect():
        want = brute_force(docs[r.doc_id][1])
        assert tuple(r)[1:6] == want, docs[r.doc_id]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed)


def labelled(n=600):
    rng = random.Random(7)
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(50)) for _ in range(rng.randint(30, 80))]
        bad = i % 3 == 0
        if bad and i % 2:
            w = [x + rng.choice("#*$%") for x in w]  # one kind of bad text
        elif bad:
            w = [x.upper() + "!!" for x in w]  # and another
        docs.append((i, " ".join(w)))
        labels.append((i, 0 if bad else 1))
    return docs, labels


def test_learns_a_short_list_that_keeps_good_documents(spark):
    docs, labels = labelled()
    d, y = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels[:400], "doc_id long, quality int")
    learned = Q.learn(d, y)
    assert 1 <= len(learned.rules) <= 4
    out = {r.doc_id: r.kept for r in Q.quality(d, y).collect()}
    held = labels[400:]
    assert all(out[i] for i, q in held if q == 1)
    assert sum(not out[i] for i, q in held if q == 0) >= 0.95 * sum(q == 0 for _, q in held)


def test_labels_of_one_value_teach_nothing(spark):
    docs, _ = labelled(60)
    d, y = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, 1) for i, _ in docs], "doc_id long, quality int")
    assert Q.learn(d, y).rules == []


def test_main_path_is_native(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert "Python" not in Q.quality(spark.createDataFrame([(1, "a")], "doc_id long, text string"), none)._jdf.queryExecution().executedPlan().toString()

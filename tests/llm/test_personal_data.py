import hashlib
import random
import re

from rillstone.llm import personal_data as P

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.split(".")), "card": lambda: 13 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()


def brute_force(text):
    spans = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in p.finditer(text or "") if valid(k, m[0])]
    return spans, ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def texts():
    rng = random.Random(4)
    alphabet = ["1", "2", "9", "0", ".", "-", " ", "+", "(", ")", "a", "B", "@", "_", "%", "é", "\n", "4111111111111111", "10.0.0.1", "a@b.c"]
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return out + [None, "", "a@b.c_x@d.ee", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1", "000.01.2.3", "+1 (234) 567-8901)) x", "4111 1111-1111 1111 2", "😀 x@y.zz", "1 2 " * 4000, "9" * 30_000, "x" * 30_000 + "@" + "y" * 500]


def test_equals_brute_force(spark):
    docs = list(enumerate(texts()))
    for r in P.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        t = docs[r.doc_id][1]
        if t and len(t) > 30_000:
            continue  # quadratic for the plain pattern
        spans, line = brute_force(t)
        assert tuple(r)[1:5] == tuple(sum(s[0] == k for s in spans) for k in PATTERNS), t
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))


def test_contexts_discover_unseen_identifiers(spark):
    rng = random.Random(5)
    number = lambda: "+39 06 " + "".join(rng.choice("0123456789") for _ in range(7))
    docs = [f"please call {number()} before noon" for _ in range(12)]
    docs += ["please call 06-5551234 before noon", "we counted 06-5559999 grains of sand", "nothing here"]
    out = P.personal_data(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    spans = {r.doc_id: r.spans for r in out}
    assert spans[12] == "phone:12:22"
    assert spans[13] == "" and spans[14] == ""
    assert all(r.n_phone == (r.doc_id < 12) for r in out)


def test_identifiers_in_groups_and_in_contexts_of_new_ones(spark):
    docs = [f"please call +39 06 {5550000 + i} before noon" for i in range(60)]
    groups = ["please call 06 555 1234 now", "please call (974) 555-3436 now", "please call 06 555 1234"]
    docs += [*groups, "we counted 06 555 9999 grains", "please call 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 now"]
    first = len(docs)
    docs += [f"please call 06 777 {1000 + i} soon" for i in range(10)]
    docs += [f"reach desk 06 777 {1000 + i} soon" for i in range(10)]  # shown by new instances alone
    docs += ["reach desk 06 888 4321 soon"]
    spans = {r.doc_id: r.spans for r in P.personal_data(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()}
    assert [spans[i] for i in range(60, 65)] == ["phone:12:23", "phone:12:26", "phone:12:23", "", ""]
    assert all(spans[i] == "phone:12:23" for i in range(first, first + 10))
    assert all(spans[i] == "phone:11:22" for i in range(first + 10, first + 21))


def test_hidden_seeds_come_back_from_their_contexts(spark):
    rng = random.Random(8)
    number = lambda: "+39 06 " + "".join(rng.choice("0123456789") for _ in range(7))
    docs = [f"please call {number()} before noon" for _ in range(200)] + [f"write to user{i}@host{i}.example today" for i in range(200)]
    docs += [f"{rng.choice('abcdefgh')}{rng.randrange(10**6)} {rng.randrange(256)}.1.2.3 seen" for _ in range(60)]  # no context
    out = {r.kind: r for r in P.hidden_seeds(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()}
    assert all(out[k].hidden > 20 and out[k].right == out[k].found == out[k].hidden for k in ("email", "phone"))
    assert out["ip"].found == 0


def test_null_and_shared_ids(spark):
    docs = [(None, "a@b.c"), (None, "10.0.0.1"), (5, "a@b.c d@e.f"), (5, ""), (None, None)]
    out = sorted((str(r.doc_id), r.spans) for r in P.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert out == [("5", ""), ("5", "email:0:5,email:6:11"), ("None", ""), ("None", "email:0:5"), ("None", "ip:0:8")]


def test_main_path_is_native(spark):
    out = P.personal_data(spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()

import collections
import hashlib
import math
import random
import re

from orderlake.llm.pii import KINDS, SHAPES, find_pii, pii_digest, redact, score_graph

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 13 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()


def brute(text):
    t = text or ""
    spans = [(k, m.start(), m.end()) for k in KINDS for m in re.finditer(BASE[k], t) if ok(k, m[0])]
    return [sum(s[0] == k for s in spans) for k in KINDS], ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def row(text):
    counts, spans = brute(text)
    return (*counts, hashlib.sha256(spans.encode()).hexdigest())


TEXTS = ["a@b.c_d@e.f", "x.y+z@mail.example.com, and a@b @c.d e@f.g.", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.004 00.0.0.0",
         "4111 1111 1111 1111 4111-1111-1111-1112 4012888888881881", "+1 (523) 555-1055 +12 +123456789012345678 +1(2",
         "é🙂 joe@ex.org 漢 10.0.0.1", "@" * 3000, "1" * 20000, "a@" + "b." * 4000 + "c", "+1" + "(" * 5000, "a" * 20000 + "@",
         "1.1.1.1a@b.co 4539 1488 0343 6467", "", "x@y.z" * 500, "5 4 3 2 1 0 " * 30, "mail a%b@c-d.e--f.-"]


def test_base_spans(spark, edge_docs, edge_rows):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:6] for r in pii_digest(df).collect()}
    for k, t in enumerate(TEXTS):
        assert got[k] == row(t), t
    got = sorted(tuple(r)[1:6] for r in pii_digest(edge_docs).collect())
    assert got == sorted(row(r[1]) for r in edge_rows)


def test_whole_table(sf_docs):
    got = sorted(tuple(r)[:6] for r in pii_digest(sf_docs).collect())
    assert got == sorted((r["doc_id"], *row(r["text"])) for r in sf_docs.collect())


def shop(rng, k):
    words = lambda n: " ".join("w%d" % rng.randrange(5000) for _ in range(n)).replace("w", "wo")
    words = lambda n: " ".join(rng.choice("abcdefghijkl") * 3 + rng.choice("mnopqrst") * 2 for _ in range(n))
    return f"{words(20)} mail to customer{k}@shop.example.com {words(20)}"


def test_contexts_find_unseen_identifiers_and_leave_others(spark):
    rng = random.Random(1)
    docs = [(k, shop(rng, k)) for k in range(40)]
    docs += [(100, shop(rng, 1).replace("customer1@shop.example.com", "jane@intranet")),
             (101, shop(rng, 1).replace("mail to customer1@shop.example.com", "look at jane@intranet2 now")),
             (102, shop(rng, 1).replace("customer1@shop.example.com", "everyone"))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii_digest(df).collect()}
    a = docs[40][1].index("jane@intranet")
    assert got[100]["spans"] == f"email:{a}:{a + 13}" and got[100]["n_email"] == 0
    assert got[101]["spans"] == "" and got[102]["spans"] == ""
    out = {r["doc_id"]: r["text"] for r in redact(df).collect()}
    assert "mail to [EMAIL] " in out[100] and out[101] == docs[41][1] and "customer3@" not in out[3]


def score(occurrences, rounds, min_support, min_confidence, accept):
    edges = set()
    for instance, seed, w1, w2 in occurrences:
        kinds = [seed] if seed >= 0 else [n for n, k in enumerate(KINDS) if re.search(SHAPES[k], instance)]
        for k in kinds:
            edges |= {(p, instance, k, seed >= 0) for p in ("1|" + w1, "2|" + w2 if w2 else None) if p}
    by = collections.defaultdict(list)
    for p, i, k, s in edges:
        by[(p, k)].append((i, s))
    by = {k: v for k, v in by.items() if min_support <= sum(s for _, s in v) < len(v)}
    belief = {}
    for _ in range(rounds):
        conf = {pk: (sum(s for _, s in v) + sum(belief.get((i, pk[1]), 0) for i, s in v if not s)) / (len(v) + 1)
                for pk, v in by.items()}
        left = collections.defaultdict(float)
        for pk, v in by.items():
            if conf[pk] >= min_confidence:
                for i, s in v:
                    if not s:
                        left[(i, pk[1])] += math.log1p(-conf[pk])
        belief = {k: 1 - math.exp(v) for k, v in left.items()}
    return {k: v for k, v in belief.items() if v >= accept}


def test_scoring_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(3000):
        w1, w2 = f"c{rng.randrange(12)}", f"d{rng.randrange(4)}"
        seed = rng.choice([-1, 0, 0, 2, 3]) if w1 != "c3" else rng.choice([0] * 9 + [-1])
        inst = {0: f"u{rng.randrange(400)}@x.co", 2: f"{rng.randrange(10**12, 10**13)}", 3: f"+{rng.randrange(10**9)}",
                -1: rng.choice([f"h{rng.randrange(30)}@host", f"555-{rng.randrange(100, 120)}-4567"])}[seed]
        rows.append((inst, seed, w1, f"{w2} {w1}" if rng.random() < .8 else None))
    df = spark.createDataFrame(rows, "instance string, seed int, w1 string, w2 string")
    for args in (dict(rounds=1), dict(rounds=3, min_confidence=0.3, accept=0.5)):
        full = dict(rounds=3, min_support=5, min_confidence=0.6, accept=0.8) | args
        got = {(r["instance"], r["kind"]): r["belief"] for r in score_graph(df, **full).collect()}
        want = score(rows, **full)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert want


def test_redaction_keeps_rows_and_columns(edge_docs, edge_rows, no_docs):
    out = redact(edge_docs)
    assert out.columns == edge_docs.columns
    key = lambda r: str(tuple(r))
    assert sorted(map(key, out.collect())) == sorted(map(key, edge_docs.collect()))
    assert redact(no_docs).count() == 0 and find_pii(no_docs).count() == 0


def test_grouped_identifiers_and_rows_of_identifiers(spark):
    """Phones and cards in groups, and an identifier right after another one."""
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghijkl") * 3 + rng.choice("mnopqrst") * 2
    text = lambda middle: f"{word()} {word()} {middle} {word()}"
    docs = [text(f"mail to customer{k}@shop.example.com") for k in range(60)]
    docs += [text(f"please call +1 523 555 {1000 + k}") for k in range(60)]
    cards = ["".join(str(rng.randrange(10)) for _ in range(15)) for _ in range(60)]
    cards = [c + next(d for d in "0123456789" if luhn(c + d)) for c in cards]
    docs += [text("pay by card " + " ".join(c[i:i + 4] for i in (0, 4, 8, 12))) for c in cards]
    plant = {"(555) 123-4567": ("please call", "phone"), "555 123 4567": ("please call", "phone"), "555-123-4567": ("please call", "phone"),
             "4111 1111 1111 1112": ("pay by card", "card"), "4111-1111-1111-1112": ("pay by card", "card")}
    first = len(docs)
    docs += [text(f"{before} {x}, then") for x, (before, _) in plant.items()]
    docs += [text("mail to jane@intranet bob@intranet ann@intranet"), text("we saw 555 123 9999 there"), text("years 1999 2004 2010")]
    rows = list(enumerate(docs))
    got = {r["doc_id"]: r for r in pii_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (x, (_, kind)) in enumerate(plant.items(), first):
        a = docs[k].index(x)
        assert f"{kind}:{a}:{a + len(x)}" in got[k]["spans"].split(","), x
    k = first + len(plant)
    assert got[k]["spans"] == ",".join(f"email:{docs[k].index(n)}:{docs[k].index(n) + len(n)}" for n in
                                       ("jane@intranet", "bob@intranet", "ann@intranet"))
    assert got[k + 1]["spans"] == got[k + 2]["spans"] == ""
    assert all(tuple(got[i])[1:6] == row(t) for i, t in rows)


def test_long_texts_take_linear_time(spark):
    """32,000 identifiers in one text cost about twice 16,000 (a quadratic walk: four times)."""
    import time
    took = []
    for n in (1000, 16000, 32000):
        text = " ".join(f"host-{k}.x at 10.0.{k % 256}.7" for k in range(n // 2))
        start = time.time()
        out = redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["text"]
        took.append(time.time() - start)
        assert out == re.sub(r"10\.0\.\d+\.7", "[IP]", text)
    assert took[2] - min(took[:2]) < 3.2 * max(took[1] - took[0], 4.0), took


def test_redaction_equals_a_plain_walk(spark):
    rng = random.Random(9)
    docs = []
    for k in range(60):
        docs.append((k, " ".join(rng.choice(["a@b.co", "1.2.3.4", "+1 523 555 1000", "4111 1111 1111 1111", "é🙂", "x", "a@b.co4111111111111111"])
                                 for _ in range(rng.randrange(0, 90)))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in find_pii(df).collect()}
    for r in redact(df).collect():
        text, at, want = docs[r["doc_id"]][1], 0, ""
        for s in sorted(spans[r["doc_id"]], key=lambda s: (s["a"], -s["b"], s["k"])):
            if s["a"] >= at:
                want += text[at:s["a"]] + f"[{KINDS[s['k']].upper()}]"
            at = max(at, s["b"])
        assert r["text"] == want + text[at:]

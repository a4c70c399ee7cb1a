import collections
import re

from orderlake.llm.quality_rules import filter_documents, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    w = WORD.findall(t)
    count = collections.Counter(zip(w, w[1:], w[2:]))
    seen = set()
    for i in range(len(w) - 2):
        if count[tuple(w[i:i + 3])] > 1:
            seen |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(seen),
            len(w) < 50 or 100 * len(seen) > 50 * len(w))


def norm(line):
    return re.sub("[1-9]", "0", re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower())


def verdicts(rows, min_docs, max_share, max_lost=50):
    """Brute force over (doc_id, text, source)."""
    held, hosts = collections.defaultdict(set), collections.Counter()
    lines = [[x for x in (t or "").split("\n") if WORD.search(x)] for _, t, _ in rows]
    for (_, t, s), own in zip(rows, lines):
        hosts[s] += 1
        for x in own:
            others = [(len(y), y) for y in own if norm(y) != norm(x)]
            longest = [norm(y) for n, y in others if n == max(others)[0]]
            held[(s, norm(x))].add(longest[0] if longest else norm(x))
    frequent = {k for k, v in held.items() if len(v) > min_docs and len(v) > hosts[k[0]] * max_share}
    out = []
    for (_, t, s), own in zip(rows, lines):
        b = base(t)
        cut = sum(len(WORD.findall(x)) for x in own if (s, norm(x)) in frequent)
        out.append((*b, cut, not b[5] and not 100 * cut > max_lost * b[0]))
    return out, frequent


FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_cut_words", "kept"]


def test_against_brute_force(edge_docs, edge_rows):
    rows = [(r[0], r[1], r[3]) for r in edge_rows]
    want, frequent = verdicts(rows, 10, 0.05)
    assert frequent
    got = quality_rules(edge_docs, min_docs=10).select("doc_id", *FIELDS).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(map(key, (tuple(r) for r in got))) == sorted(key((r[0], *w)) for r, w in zip(rows, want))


def test_whole_table(sf_docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in sf_docs.collect()]
    want, _ = verdicts(rows, 20, 0.05)
    got = quality_rules(sf_docs).select("doc_id", *FIELDS).collect()
    assert sorted(map(tuple, got)) == sorted((r[0], *w) for r, w in zip(rows, want))


def test_depleted_documents_go_and_lines_are_removed(edge_docs, edge_rows):
    line = edge_rows[1][1].split("\n")[0]
    verdict = {r["doc_id"]: r for r in quality_rules(edge_docs, min_docs=10, max_lost_percent=10).collect()}
    assert not verdict[1]["kept"] and verdict[2]["kept"]
    out = {r["doc_id"]: r for r in filter_documents(edge_docs, min_docs=10).collect()}
    assert line not in out[1]["text"] and out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] == edge_rows[2][1] and set(out[1].asDict()) == set(edge_docs.columns)
    assert 97 not in out and 90 not in out


def test_copies_do_not_make_lines_frequent(spark):
    text = "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) for i in range(6))
    df = spark.createDataFrame([(i, text, "s") for i in range(50)], "doc_id long, text string, source string")
    assert quality_rules(df).filter("not kept").count() == 0


def test_lines_shared_beside_a_longer_shared_line(spark):
    own = lambda k: "\n".join(" ".join(f"w{'abcdefghij'[(k // 10 ** d) % 10]}{j}{i}" for d in range(3) for j in "xyz")
                              for i in "klmnop")
    notice = "the notice of this host " * 12
    menu = [f"menu line {c}" for c in "abcde"]
    rows = [(k, "\n".join([notice, *menu, own(k)]), "s") for k in range(100)]
    out = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["n_cut_words"] for r in out} == {len(notice.split()) + 3 * len(menu)}


def test_copies_do_not_raise_the_limit(spark):
    own = lambda k: " ".join(f"w{'abcdefghij'[(k // 10 ** d) % 10]}{i}" for d in range(3) for i in "klmnopqrstuvwxyzabcd")
    rows = [(k, own(k) + ("\nthe footer" if k % 10 == 0 else ""), "s") for k in range(400)]
    rows += [(k, own(999), "s") for k in range(1000, 1600)]
    out = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["doc_id"] for r in out if r["n_cut_words"]} == set(range(0, 400, 10))


def test_empty(no_docs):
    assert quality_rules(no_docs).count() == 0 and filter_documents(no_docs).count() == 0

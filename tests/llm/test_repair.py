import hashlib
import random
import re
import zlib


from orderlake.llm import repair
from orderlake.llm.queries import damaged
from orderlake.llm.repair import END, matrix, repair_conversations, walk

SCHEMA = "conv_id long, turn long, role string, text string, audit string"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    """conv -> damaged rows (turn, role, text), in input order."""
    out = {}
    for conv, turn, role, text, *_ in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        mine = out.setdefault(conv, [])
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        mine += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(kinds):
    """Least (cost, letters, lines) over all edits; kinds: (forced, truncated, role)."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    back = {}
    for i in range(len(kinds), -1, -1):
        def best(q, put, i=i):
            options = []
            if i == len(kinds):
                if q in (0, 3):
                    options.append((0, "", ()))
            else:
                forced, cut, role = kinds[i]
                c, s, t = back[i + 1, q]
                options.append((c + 2, "D" + s, (None, *t)))
                if not forced:
                    if (q, role[:1]) in step:
                        c, s, t = back[i + 1, step[q, role[:1]]]
                        options.append((c + 5 * cut, "K" + s, (("K", role), *t)))
                    for r in ("user", "assistant"):
                        if (q, r[0]) in step:
                            c, s, t = back[i + 1, step[q, r[0]]]
                            options.append((c + 1 + 5 * cut, "R" + s, (("R", r), *t)))
            if put < 3:
                for r in ("user", "assistant"):
                    if (q, r[0]) in step:
                        o = best(step[q, r[0]], put + 1)
                        if o:
                            options.append((o[0] + 5, "I" + o[1], (("I", r), *o[2])))
            return min(options, key=lambda o: o[:2]) if options else None
        for q in range(4):
            back[i, q] = best(q, 0)
    return back[0, 0]


def brute(rows):
    out = {}
    for conv, mine in damage(rows).items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(conv, r)))
        seen, kinds, n = set(), [], [0, 0, 0]
        for _, role, text in mine:
            last = text.rstrip(SPACE)[-1:]
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                n[fault] += 1
            kinds.append((fault in (0, 1), fault == 2, role))
        initials = [r[1][:1] for r in mine]
        bad = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        known = [r[0] for r in mine if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, letters, lines = cheapest(kinds)
        texts, said = iter(r[2] for r in mine), []
        for line in lines:
            text = "" if line and line[0] == "I" else next(texts)
            if line:
                said.append(f"{line[1]}:{text}")
        out[conv] = (gaps, *n, bad, cost, letters, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def digest(conv, r):
    return hashlib.sha256(f"{' ' if conv is None else conv}\n{len(r[1])}\n{r[1]}{r[2]}".encode()).hexdigest()


def sample(rng, convs, turns):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Hi there.", "ok", "what? ", " \n", "", None, "é!\t", "no way!", "x" * 3000, "a.\x85", "line\nend."]
    rows = []
    for c in convs:
        for t in range(rng.randrange(*turns)):
            role = ("user", "assistant")[t % 2] if rng.random() < 0.7 else rng.choice(roles)
            text = f"turn {t} of {c}." if rng.random() < 0.5 else rng.choice(texts)
            rows.append((c, t if rng.random() < 0.9 else rng.choice([None, t + 3]), role, text, "clash"))
    return rows


def test_against_brute_force(spark):
    rng = random.Random(11)
    rows = sample(rng, [*range(150), None], (1, 12)) + sample(rng, [500, -3], (300, 600))  # two hold over a third
    rows += rows[:5] + [rows[0]] * 4 + [(900, None, None, None, None)] * 3 + [(901, 7, "user", None, None)]
    rows += [(902, t, "user", "the same words.", None) for t in range(60)]
    expected = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_conversations(damaged(df)).collect()}
    assert got == expected


def test_empty_and_all_dropped(spark):
    assert repair_conversations(damaged(spark.createDataFrame([], SCHEMA))).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    r = repair_conversations(damaged(spark.createDataFrame([(gone, 0, "user", "x.", "")], SCHEMA))).first()
    assert tuple(r) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_edits_are_the_least_of_all():
    rng = random.Random(4)
    initials = {0: "tool", 1: "system", 2: "user", 3: "assistant"}
    for _ in range(1500):
        codes = bytes(rng.randrange(16) for _ in range(rng.randrange(0, 9)))
        kinds = [(bool(c & 4), bool(c & 8) and not c & 4, initials[c & 3]) for c in codes]
        cost, letters, _ = cheapest(kinds)
        got = walk(codes, [1] * len(codes), END, 0, True)
        assert (got[2], got[0]) == (cost, letters)
        m = matrix(codes, [1] * len(codes))
        assert min(m[j] + END[j] for j in range(4)) == cost


def test_segments_cut_anywhere_give_the_same_edits():
    """A conversation over many segments and tasks equals the one walked in one piece."""
    rng = random.Random(8)
    codes = bytes(rng.choice([0, 1, 2, 3, 2, 3, 4, 6, 10, 11]) for _ in range(5000))
    whole = walk(codes, [1] * len(codes), END, 0, True)
    cuts = sorted(rng.sample(range(1, 5000), 40))
    pieces = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, 5000])]
    right, rights = list(END), []
    for p in reversed(pieces):
        rights.append(right)
        right = repair.through(matrix(p, [1] * len(p)), right)
    q, letters = 0, []
    for p, r in zip(pieces, reversed(rights)):
        text, q, _, _ = walk(p, [1] * len(p), r, q, p is pieces[-1])
        letters.append(text)
    assert "".join(letters) == whole[0]


def test_query_on_the_given_table(spark, sf_docs):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_conversations(damaged(turns)).collect()}
    assert got == brute(rows)

import hashlib
import random

from orderlake.llm.chat import CONTROL, escape, format_conversations, format_turn, read_conversations, read_turn, unescape

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def test_escape_is_reversible_and_hides_controls():
    rng = random.Random(2)
    pieces = CONTROL + ["\\", "<", "[", "|>", "a", " ", "\n", "/", "turn", "é"]
    for _ in range(5000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 12)))
        assert unescape(escape(t)) == t
        assert not any(c in escape(t) for c in CONTROL)
        for role in ("user", "assistant", t):
            got = read_turn(format_turn(role, [{"type": "text", "text": t}])[0])
            assert got == (role, t, role == "assistant")


def test_typed_parts_keep_their_order():
    parts = [{"type": "text", "text": "see "}, {"type": "image", "ref": "s3://i/1", "width": 28, "height": 15},
             {"type": "text", "text": " and <|image|>"}, {"type": "audio", "ref": "a", "seconds": 2.0},
             {"type": "document", "ref": "d", "pages": 3}]
    text, attached = format_turn("user", parts)
    assert text == "<|turn|>user<|body|>see <|image|> and <\\|image|><|audio|><|document|><|end|>"
    assert [(a["position"], a["type"], a["ref"], a["tokens"]) for a in attached] == \
        [(0, "image", "s3://i/1", 4), (1, "audio", "a", 50), (2, "document", "d", 768)]


def brute(rows):
    conv = {}
    for c, turn, role, text, *_ in rows:
        conv.setdefault(c, []).append((turn is not None, turn or 0, format_turn(role, [{"type": "text", "text": text}])[0],
                                       role or "", text or ""))
    out = {}
    for c, turns in conv.items():
        turns.sort()
        said = [t[4] for t in turns if t[3] == "assistant"]
        out[c] = (len(turns), hashlib.sha256("".join(f"{t[3]}\n{t[4]}\n" for t in turns).encode()).hexdigest(),
                  sum(map(len, said)), hashlib.sha256("".join(said).encode()).hexdigest(),
                  sum(len(t[2]) for t in turns))
    return out


def test_conversations_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice([None, "", "hi </s>", "a\\b\nc", "é🙂"]),
             "clash") for c in list(range(30)) + [None] for t in range(rng.randrange(1, 9))]
    rows += [(7, t, "assistant", f"t{t}", "clash") for t in range(10, 3000)]  # a very long conversation
    rows += [rows[0], (5, None, None, None, None), (5, 1, "user", "tie", None), (5, 1, "user", "tie", None)]
    got = read_conversations(format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == brute(rows)
    assert len(got) == len(brute(rows))
    assert read_conversations(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_parts_column(spark):
    df = spark.createDataFrame([(1, 0, "user", [("image", None, "ref", 14, 14, None, None)])],
                               "conv_id long, turn long, role string, parts array<struct<type:string,text:string,"
                               "ref:string,width:int,height:int,seconds:double,pages:int>>")
    r = format_conversations(df).first()
    assert r["formatted"] == "<|turn|>user<|body|><|image|><|end|>"
    assert r["attachments"][0]["ref"] == "ref" and r["attachments"][0]["tokens"] == 1

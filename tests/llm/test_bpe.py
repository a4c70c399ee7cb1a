"""Encoding and decoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from orderlake.llm.bpe import decode_documents, encode_documents, tokenizer_of, vocabulary_bytes  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(packed):
    return np.frombuffer(packed, dtype="<u4").tolist()


def test_random_strings(library):
    bpe = tokenizer_of(vocabulary_bytes(PATH))
    rng = random.Random(1)
    alphabet = list("aeiounthsrl  \n\t'.,!?0123ABCé漢🙂 \x1c\x85 _-<>|")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 80))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|> c", "a  b", " lead", "trail ", "x" * 5000,
              "it's we'll THEY'RE 'S", "  \n\n  x", "\x00\x01", "ab " * 2000, "ſt Kelvin K", "aaaaaaaaaaaab" * 50]
    for t in texts:
        e = library.encode(t, add_special_tokens=False).ids
        packed = bpe.encode(t)
        assert ids_of(packed) == e, repr(t)
        assert bpe.decode(packed) == library.decode(e, skip_special_tokens=False)


def check(rows, out, library):
    assert len(out) == len(rows)
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                  for r in out))
    want = []
    for doc_id, text in rows:
        e = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id is not None, doc_id or 0, len(e),
                     hashlib.sha256(np.array(e, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)


def test_edge_documents(edge_docs, edge_rows, library):
    check([r[:2] for r in edge_rows], encode_documents(edge_docs, PATH, verify=True).collect(), library)


def test_whole_table(sf_docs, library):
    check([(r["doc_id"], r["text"]) for r in sf_docs.collect()],
          encode_documents(sf_docs, PATH, verify=True).collect(), library)


def test_round_trip_and_empty(edge_docs, edge_rows, no_docs):
    back = decode_documents(encode_documents(edge_docs, PATH), PATH).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=key) == \
        sorted(((r[0], r[1] or "") for r in edge_rows), key=key)
    assert encode_documents(no_docs, PATH, verify=True).count() == 0

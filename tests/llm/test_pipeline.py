"""Each stage of the pipeline on its own input, against the operators' brute force."""

import hashlib

import pytest

import corpus_pipeline as P
from test_mixing import WORD, targets
from test_near_dup import brute as near_brute
from test_pii import brute as pii_brute
from test_quality import verdicts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, edge_docs):
    docs, out = edge_docs.select(*COLUMNS), {}
    for name, stage in P.STAGES:
        rows = docs.collect()
        docs = P.written(stage(spark, docs, "/none"), f"test-{name}")
        out[name] = (rows, docs.collect(), docs.columns)
    return out


def ids(rows):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in rows)


def test_columns(stages):
    assert all(c == COLUMNS for n, (_, _, c) in stages.items() if n != "bpe")


def test_quality_rejects(stages):
    before, after, _ = stages["quality_rules"]
    want, _ = verdicts([(r["doc_id"], r["text"], r["source"]) for r in before], 20, 0.05)
    assert ids(after) == sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r, w in zip(before, want) if w[-1])


def test_one_document_of_each_group_stays(stages):
    before, after, _ = stages["near_dedup"]
    kept = {r[0] for r in near_brute([(r["doc_id"], r["text"]) for r in before], k=5) if r[3]}
    assert sorted(map(str, kept)) == sorted(str(r["doc_id"]) for r in after)


def test_personal_data_goes_and_clean_texts_stay(stages):
    before, after, _ = stages["pii"]
    text = {r["doc_id"]: r["text"] for r in before}
    assert ids(before) == ids(after)
    for r in after:
        assert pii_brute(r["text"])[1] == ""
        assert r["text"] == text[r["doc_id"]] or pii_brute(text[r["doc_id"]])[1]


def test_mixing_takes_whole_documents_near_the_targets(stages):
    before, after, _ = stages["mixing"]
    want, _ = targets([(r["doc_id"], r["text"], r["source"]) for r in before])
    known = {(r["doc_id"], r["text"]) for r in before}
    taken = dict.fromkeys(want, 0)
    for r in after:
        assert (r["doc_id"], r["text"]) in known
        taken[r["source"]] += len(WORD.findall(r["text"] or ""))
    for s in want:
        assert abs(taken[s] - want[s]) <= max(len(WORD.findall(r["text"] or "")) for r in before if r["source"] == s)


def test_tokens(stages):
    before, after, _ = stages["bpe"]
    assert sorted(r["decoded_sha256"] for r in after) == \
        sorted(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in before)
    assert P.ORACLE_SQL is None and 4 <= len(P.STAGES) <= 5

"""Byte-level BPE encoding and decoding.

Encoding is exact: a greedy walk takes the longest token at each place (all matches of a
piece come from one Aho-Corasick pass) and backtracks whenever a token may not follow
its predecessor. Whether two tokens may stand side by side under the merge rules is a
property of the pair alone; answers are kept in a table. Each piece needs a number of
steps linear in its length. Decoding gathers bytes through an offset table.

The vocabulary file (a tokenizers JSON, byte-level BPE) is a parameter; it is read on the
driver and broadcast (a fixed file of about 2 MB). Tables are built once per worker.

Defined results: null text is empty (no tokens); texts of any length are encoded whole,
piece by piece; repeated rows give repeated results; an empty table gives an empty
result; extra columns are kept out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Fixed value: the split pattern of the byte-level pre-tokenizer.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
SPACE = regex.compile(r"\p{White_Space}")
CACHE = 300_000  # answers of each kind kept by a worker


def byte_of_char() -> dict[str, int]:
    """The byte alphabet: printable bytes stand for themselves, the others follow from
    U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class _Memo(dict):
    """Answers of ``make`` by key, bounded: emptied when full."""

    def __init__(self, make, keep=lambda key: True):
        super().__init__()
        self.make, self.keep = make, keep

    def __missing__(self, key):
        value = self.make(key)
        if self.keep(key):
            if len(self) >= CACHE:
                self.clear()
            self[key] = value
        return value


class ByteBPE:
    """Tokens are numbered by merge order inside (bytes first); ids are the file's."""

    def __init__(self, vocabulary: bytes):
        spec = json.loads(vocabulary)
        model, byte = spec["model"], byte_of_char()
        raw = lambda s: bytes(byte[c] for c in s)
        vocab = model["vocab"]
        self.ids: list[int] = []
        self.tokens: list[bytes] = []
        number: dict[str, int] = {}
        for c in byte:
            number[c] = len(self.ids)
            self.ids.append(vocab[c])
            self.tokens.append(bytes([byte[c]]))
        self.parts: list[tuple[int, int]] = [(n, n) for n in range(len(self.ids))]
        self.merged: dict[tuple[int, int], int] = {}
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            n = len(self.ids)
            number[left + right] = n
            self.ids.append(vocab[left + right])
            self.tokens.append(raw(left + right))
            self.parts.append((number[left], number[right]))
            self.merged[self.parts[-1]] = n
        by_bytes = {t: n for n, t in enumerate(self.tokens)}
        self.shorter = [next((by_bytes[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in by_bytes), -1)
                        for t in self.tokens]
        self.size = [len(t) for t in self.tokens]
        self.matches = ahocorasick.Automaton()
        for n, t in enumerate(self.tokens):
            self.matches.add_word(t.decode("latin-1"), (n, len(t)))
        self.matches.make_automaton()
        self.packed = [i.to_bytes(4, "little") for i in self.ids]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.splitter = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.may_follow = _Memo(lambda pair: self._compatible(*pair))
        self.pieces = _Memo(self._piece)
        self.chunks = _Memo(self._chunk, keep=lambda c: "\n" not in c)
        # offset table: the bytes of id i are blob[offsets[i]:offsets[i + 1]]
        text = {i: t for i, t in zip(self.ids, self.tokens)} | {i: c.encode() for c, i in self.added.items()}
        top = max(text) + 1
        self.blob = np.frombuffer(b"".join(text.get(i, b"") for i in range(top)), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(text.get(i, b"")) for i in range(top)])]).astype(np.int64)

    def _compatible(self, a: int, b: int) -> bool:
        """True if merging the bytes of a and b in merge order keeps the border between
        them: no merge across it would come before a merge that built either side."""
        parts, merged, n_bytes = self.parts, self.merged, len(self.ids) - len(self.merged)
        before = len(self.ids)  # merges from this number on come too late to matter
        while True:
            across = merged.get((a, b))
            if across is not None and across < before:
                return False
            # undo the later of the two last merges and look at the border again
            if a > b:
                if a < n_bytes:
                    return True
                before, a = a, parts[a][1]
            else:
                if b < n_bytes:
                    return True
                before, b = b + 1, parts[b][0]

    def _piece(self, piece: str) -> bytes:
        """Ids (packed) of one pre-token."""
        data = piece.encode()
        n = len(data)
        longest = [0] * n
        for end, (token, size) in self.matches.iter(data.decode("latin-1")):
            longest[end - size + 1] = token  # ends ascend, so the longest stays
        size, shorter, may_follow = self.size, self.shorter, self.may_follow
        dead = [False] * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            last = out[-1] if out else -1
            end = at + size[token]
            if not dead[end] and (last < 0 or may_follow[last, token]):
                out.append(token)
                at = end
                if at == n:
                    return b"".join([self.packed[t] for t in out])
                token = longest[at]
                continue
            token = shorter[token]
            if token < 0:  # nothing fits here: the predecessor must end elsewhere
                dead[at] = True
                token = out.pop()
                at -= size[token]

    def _chunk(self, word: str) -> bytes:
        found = PIECES.findall(" " + word)
        if len(found) == 1:  # kept as a chunk; no second copy among the pieces
            return self._piece(found[0])
        return b"".join([self.pieces[p] for p in found])

    def _plain(self, text: str) -> bytes:
        words = text.split(" ")
        # a space between two non-space characters always starts a piece
        if all(words) and not any(SPACE.match(w) or SPACE.match(w[-1]) for w in words
                                  if w[0] <= " " or w[-1] <= " " or w[0] >= "\x80" or w[-1] >= "\x80"):
            first = b"".join([self.pieces[p] for p in PIECES.findall(words[0])])
            chunks = self.chunks
            return first + b"".join([chunks[w] for w in words[1:]])
        return b"".join([self.pieces[p] for p in PIECES.findall(text)])

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        if self.splitter is None or not self.splitter.search(text):
            return self._plain(text) if text else b""
        return b"".join([self.added[part].to_bytes(4, "little") if n % 2 else self._plain(part)
                         for n, part in enumerate(self.splitter.split(text)) if part])

    def decode_bytes(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, dtype="<u4").astype(np.int64)
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        return self.blob[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()

    def decode(self, packed: bytes) -> str:
        return self.decode_bytes(packed).decode("utf-8", errors="replace")


_built: dict[str, ByteBPE] = {}


def tokenizer_of(vocabulary: bytes) -> ByteBPE:
    key = hashlib.sha256(vocabulary).hexdigest()
    if key not in _built:
        _built[key] = ByteBPE(vocabulary)
    return _built[key]


def vocabulary_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, vocabulary_path: str, verify: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (binary: little-endian uint32), and with ``verify`` the hex
    digests of ids and of the decoded text instead of the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_bytes(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer_of(shared.value)
        for batch in batches:
            ids = [bpe.encode(t.as_py() or "") for t in batch.column("text")]
            out = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64())}
            if verify:
                out["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())
                out["decoded_sha256"] = pa.array(
                    [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids], pa.string())
            else:
                out["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    tail = "ids_sha256 string, decoded_sha256 string" if verify else "ids binary"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_tokens long, {tail}")


def decode_documents(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, text from doc_id, ids (null ids: empty text)."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary_bytes(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer_of(shared.value)
        for batch in batches:
            texts = [bpe.decode(x.as_py() or b"") for x in batch.column("ids")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")

"""BPE encoding and decoding by per-prefix dynamic programming (operator 6).

Byte-pair encoding merges by rank, yet its result has a local description: a
token sequence is the encoding of its bytes exactly if every adjacent pair of
tokens is compatible, that is, encoding the pair's bytes gives the pair back.
So each prefix of a piece has one last token: of the vocabulary entries that end
there (found by an automaton that reports all suffix matches), the one that is
compatible with the last token of the prefix before it. The last tokens are
stored per prefix and back-pointers emit the ids, in time linear in the bytes.

A text is first cut at special tokens and into pieces by the tokenizer's
pattern; pieces are short and repeat, so a bounded cache holds their ids and
decoded bytes. Long texts are streamed in runs of pieces, so memory follows the
run and not the text.

Defined results: a NULL text is an empty text (0 tokens, hash of ''); rows with
NULL or repeated ids are encoded like any other; an empty table gives no rows;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import json
from itertools import islice

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from .common import ship

# The published split pattern of byte-level BPE.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_PIECES = 1 << 17
PAIRS_KEPT = 1 << 19
CACHE_CHARS = 48         # longer pieces are encoded each time
STREAM_CHARS = 1 << 20   # longer texts are cut into runs of pieces
RUN_PIECES = 1 << 15


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return out


class Vocabulary:
    """Tokens, merge ranks and the suffix-match automaton of one tokenizer file."""

    def __init__(self, spec: str):
        t = json.loads(spec)
        sym = byte_symbols()
        as_bytes = {s: bytes(sym[c] for c in s) for s in t["model"]["vocab"]}
        self.vocab = {as_bytes[s]: i for s, i in t["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.vocab.items()}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}   # pair -> (rank, merged token)
        self.parts: dict[int, tuple[int, int, int]] = {}          # token -> (rank, left, right)
        for rank, m in enumerate(t["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            left, right = self.vocab[as_bytes[a]], self.vocab[as_bytes[b]]
            whole = self.vocab[as_bytes[a] + as_bytes[b]]
            self.pairs[left, right] = (rank, whole)
            self.parts.setdefault(whole, (rank, left, right))
        self.special = {x["content"]: x["id"] for x in t["added_tokens"]}
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        self.special_re = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None
        self.piece_re = regex.compile(PIECES)
        self.compat: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for b, i in self.vocab.items():
            if self._reachable(i):
                self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.ids_of: dict[str, str] = {}     # piece -> joined ids
        self.text_of: dict[str, str] = {}    # piece -> decoded text of its ids

    def _reachable(self, token: int) -> bool:
        """Merging the token's own bytes gives the token back."""
        if token not in self.parts:
            return True
        _, left, right = self.parts[token]
        return self._compatible(left, right, below=self.parts[token][0])

    def _compatible(self, a: int, b: int, below: int | None = None) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` never joins across their border.

        Undo the later of the two tokens' last merges step by step; at every
        stage the pair at the border must not be due before the merges that
        remain undone. ``below``: the border pair may merge at that rank.
        """
        parts, pairs = self.parts, self.pairs
        limit = (1 << 60) if below is None else below
        while True:
            due = pairs.get((a, b))
            if due is not None and due[0] < limit:
                return False
            ra = parts[a][0] if a in parts else -1
            rb = parts[b][0] if b in parts else -1
            if ra < 0 and rb < 0:
                return True
            # with equal ranks the left one merges first, so the right is undone first
            if ra > rb:
                limit, a = min(limit, ra), parts[a][2]
            else:
                limit, b = min(limit, rb + 1), parts[b][1]

    def encode_piece(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8").decode("latin-1")
        n = len(raw)
        last = [-1] * (n + 1)      # the last token of each prefix; -1: no prefix ends here
        size = [0] * (n + 1)
        known, compatible = self.compat, self._compatible
        for end, (length, token) in self.automaton.iter(raw):
            at = end + 1
            if last[at] >= 0:
                continue
            start = at - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                key = before << 20 | token
                ok = known.get(key)
                if ok is None:
                    ok = compatible(before, token)
                    if len(known) < PAIRS_KEPT:
                        known[key] = ok
                if not ok:
                    continue
            last[at], size[at] = token, length
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        return out[::-1]

    def coded(self, run: list[str]) -> tuple[str, str]:
        """Joined ids of a run of pieces, and their decoded text."""
        ids_of, text_of, rare = self.ids_of, self.text_of, []
        for w in set(run).difference(ids_of):
            ids = self.encode_piece(w)
            if len(w) > CACHE_CHARS or len(ids_of) >= CACHE_PIECES:
                rare.append(w)
            ids_of[w], text_of[w] = ",".join(map(str, ids)), self.decode(ids)
        out = ",".join([ids_of[w] for w in run]), "".join([text_of[w] for w in run])
        for w in rare:
            del ids_of[w], text_of[w]
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")

    def runs(self, text: str):
        """The text as lists of pieces; a special token is a list of its own."""
        at = 0
        for m in self.special_re.finditer(text) if self.special_re else ():
            yield from self._plain(text, at, m.start())
            yield m.group()
            at = m.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, lo: int, hi: int):
        part = text if (lo, hi) == (0, len(text)) else text[lo:hi]
        if len(part) <= STREAM_CHARS:
            if part:
                yield self.piece_re.findall(part)
            return
        it = (m.group() for m in self.piece_re.finditer(part))
        while run := list(islice(it, RUN_PIECES)):
            yield run

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for run in self.runs(text):
            if isinstance(run, str):
                out.append(self.special[run])
            else:
                out += map(int, self.coded(run)[0].split(","))
        return out

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the joined ids, SHA-256 of the decoded text."""
        ids_sha, text_sha, n = hashlib.sha256(), hashlib.sha256(), 0
        for run in self.runs(text):
            if isinstance(run, str):
                i = self.special[run]
                joined, decoded = str(i), self.decode([i])
            else:
                joined, decoded = self.coded(run)
            if n:
                ids_sha.update(b",")
            ids_sha.update(joined.encode())
            text_sha.update(decoded.encode("utf-8"))
            n += joined.count(",") + 1
        return n, ids_sha.hexdigest(), text_sha.hexdigest()


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(spec: str) -> Vocabulary:
    """One vocabulary per Python worker."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(spec)
    return _LOADED[key]


def read_spec(path: str) -> str:
    """The tokenizer file's text, read on the driver and broadcast (a few MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int>: the exact ids of every whole text."""
    ship(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(it):
        v = _vocabulary(spec.value)
        for pdf in it:
            for i, t in zip(pdf["doc_id"], pdf["text"]):
                yield pd.DataFrame({"doc_id": pd.Series([i], dtype=pdf["doc_id"].dtype), "ids": [v.encode(t)]})
    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .mapInPandas(run, f"doc_id {kind}, ids array<int>")


def bpe_digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    ship(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(text: pd.Series) -> pd.DataFrame:
        v = _vocabulary(spec.value)
        return pd.DataFrame([v.digest(t) for t in text],
                            columns=["n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select("doc_id", digest(F.coalesce("text", F.lit(""))).alias("d")).select("doc_id", "d.*")

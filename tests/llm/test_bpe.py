import hashlib
import random

import pytest

tokenizers = pytest.importorskip("tokenizers")

from isobar.llm import bpe  # noqa: E402
from isobar.llm.queries import vocabulary_path  # noqa: E402


@pytest.fixture(scope="module")
def both():
    path = vocabulary_path()
    t = tokenizers.Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return bpe.Vocabulary(bpe.read_spec(path)), t


def fuzz(n, seed=1):
    r = random.Random(seed)
    odd = "".join(map(chr, [*range(0, 0x180), *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0x1F600, 0x1680, 0x301, 0x661, 0x2160]))
    for _ in range(n):
        s = "".join(r.choice(odd) if r.random() < .5 else r.choice(" aeths'\n\t") for _ in range(r.randint(0, 40)))
        yield s + "<|endoftext|>" + s[:3] if r.random() < .05 else s


def test_same_ids_and_text_as_the_library(both):
    v, t = both
    for s in [*fuzz(3000), "the aaaaaaaaaaaaaaaa bbbbbbbbbb", "a" * 5000, " " * 300, "\n" * 50 + "x", "don't we'LL"]:
        ids = t.encode(s, add_special_tokens=False).ids
        assert v.encode(s) == ids
        assert v.digest(s) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                               hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_every_prefix_has_one_last_token(both):
    v, t = both
    word = " internationalisation"
    for n in range(1, len(word) + 1):
        ids = t.encode(word[:n], add_special_tokens=False).ids
        assert v.encode_piece(word[:n]) == ids


def test_streamed_long_text(both, monkeypatch):
    v, t = both
    s = " ".join(f"word{i}  {i * 7919}\n" for i in range(3000))
    want = v.digest(s)
    monkeypatch.setattr(bpe, "STREAM_CHARS", 100)
    monkeypatch.setattr(bpe, "RUN_PIECES", 7)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    assert v.digest(s) == want
    assert v.encode(s) == t.encode(s, add_special_tokens=False).ids


def test_query_shapes(spark, both):
    v, t = both
    rows = [(1, "Hello wörld"), (1, "Hello wörld"), (None, "x"), (4, None), (5, "")]
    df = spark.createDataFrame([(a, b, 1, "y") for a, b in rows], "doc_id long, text string, n_tokens int, d string")
    got = sorted([tuple(r) for r in bpe.bpe_digest(df, vocabulary_path()).collect()], key=str)
    assert got == sorted([(i, *v.digest(s or "")) for i, s in rows], key=str)
    ids = sorted([(r["doc_id"], r["ids"]) for r in bpe.encode_documents(df, vocabulary_path()).collect()], key=str)
    assert ids == sorted([(i, t.encode(s or "", add_special_tokens=False).ids) for i, s in rows], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.bpe_digest(empty, vocabulary_path()).collect() == []

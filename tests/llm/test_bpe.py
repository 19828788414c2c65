"""Ids and decoded texts against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from sievelog.llm.bpe import Encoder, Vocabulary, bpe_encode  # noqa: E402

FILE = str(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def both():
    return Encoder(Vocabulary(open(FILE).read())), Tokenizer.from_file(FILE)


def test_random_texts(both):
    own, theirs = both
    draw = random.Random(1)
    pool = [*map(chr, range(0x20, 0x300)), "\n", "\t", "  ", " \n", "\x1c", "\x85", " ", "　", "一", "\U0001f600", "<|endoftext|>", "'s", "'LL", "aaaa", " the", " tion"]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randrange(60))) for _ in range(3000)] + ["", "a" * 5000, " " * 3000, "ab" * 4000]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        want = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
        assert own.decode(ids) == theirs.decode(want, skip_special_tokens=False)


def test_table(spark, both):
    rows = [(1, "Hello world"), (2, None), (3, ""), (None, "x"), (1, "Hello world"), (2**53 + 1, "é" * 9), (4, "long text " * 20000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n_tokens string").coalesce(1)
    got = bpe_encode(df, FILE, with_decoded=True, block_chars=100).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in got) == sorted((k or 0, t or "") for k, t in rows)
    texts = {k: t or "" for k, t in rows}
    for r in got:
        want = both[1].encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.token_ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe_encode(df.limit(0), FILE).count() == 0

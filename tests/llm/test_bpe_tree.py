"""Ids against the tiktoken library, joins against plain merging, and the cases of the docstring."""

import base64
import hashlib
import random

import pytest
import tiktoken

from sievelog.llm.bpe_tree import RankTree, tree_encode
from sievelog.llm.queries import QUERIES, tokenizer_file

PATH = tokenizer_file("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH) as f:
        return RankTree(f.read())


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    with open(PATH, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def test_texts(ranks, library):
    random.seed(5)
    texts = ["", " ", "\n\n a", "<|endoftext|>", "don't  stop now", "日本語のテキスト", "a\x1cb\x1f c", "😀" * 9, "x" * 5000, "ab" * 3000]
    for letters in ("a", "ab", "aab ", "etaoin ", "é一ё ", "01", "=-", " \n\t", "abcdefgh"):
        texts += ["".join(random.choices(letters, k=random.choice((1, 2, 3, 7, 20, 90, 400)))) for _ in range(60)]
    for t in texts:
        ids = ranks.encode(t)
        assert ids == library.encode_ordinary(t), t
        assert ranks.decode(ids) == t.encode()


def test_joins_equal_merging_at_once(ranks):
    """Halves joined give what merging the whole word gives; windows have to grow where runs shift."""
    random.seed(6)
    tokens = list(ranks.ranks)
    for _ in range(3000):
        word = b"".join(random.choices(tokens, k=random.randint(1, 8)))
        assert ranks.tree(word) == ranks.window(word)
    for word in (b"a" * 1001, b"ab" * 777 + b"a", b"-=" * 300 + b"-" * 301):
        assert ranks.tree(word) == ranks.window(word)


def test_small_tables_change_nothing(ranks):
    with open(PATH) as f:
        small = RankTree(f.read(), memo=3)
    for t in ("the quick brown foxes jumped over the lazy dogs again and again", "zzxqv " * 50):
        assert small.encode(t) == ranks.encode(t)


def test_query_over_the_table(spark, library, tmp_path):
    rows = [(1, "hello wörld", "x"), (1, "hello wörld", "x"), (2, None, None), (3, "", "y"), (None, "no id", "z"), (5, "long " * 40_000, "w")]
    spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_bpe_tree"](spark, str(tmp_path)).collect())
    want = []
    for key, text, _ in rows:
        ids, sha = library.encode_ordinary(text or ""), lambda b: hashlib.sha256(b).hexdigest()
        want.append((key is None, key or 0, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert got == sorted(want)


def test_results_and_clashes(spark):
    df = spark.createDataFrame([(1, "ab cd", 7)], "doc_id long, text string, decoded int")
    r = tree_encode(df, PATH, with_decoded=True).first()
    assert bytes(r.decoded) == b"ab cd" and len(r.token_ids) == r.n_tokens
    assert tree_encode(df.filter("false"), PATH).collect() == []
    with pytest.raises(ValueError):
        tree_encode(df, PATH, keep=("doc_id", "decoded"))

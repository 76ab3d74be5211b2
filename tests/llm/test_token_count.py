import random
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wayside.llm import token_count as T
from wayside.llm.queries import op13_token_counts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(T.VOCABULARY))


@pytest.fixture(scope="module")
def counter():
    return T.Counter(T.Vocabulary(public_tokenizers.path(T.VOCABULARY)))


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


AWKWARD = [
    None, "", " \t\n", "don't WE'RE it's 'tis y'all've", "ΟΔΟΣ ΣΑΣ Σ", "İstanbul ǅ ﬁ ß ẞ", "<|endoftext|>", "a<|endoftext|>b<|STARTOFTEXT|><|startoftext|><|startoftext|>", "<|endoftext", "x y z　w\u0085v\u001cu",
    "é e ́ 각", "12345 ½ ٣٤ 一二三", "你好，世界。こんにちは 안녕하세요", "🙂🙃👩‍👩‍👧 flag 🇩🇪", "aaaaaaaaaaaaaaaa aaaa aaa", "-----=====*****", "a" * 1000, "ab" * 500 + "c", "the" * 3000, "\u0000\u0001�", "hello​world",
]


def test_awkward_texts(library, counter):
    n_bytes, n_tokens = T.count_batch(pa.array(AWKWARD), counter)
    assert n_tokens.tolist() == expected(library, AWKWARD)
    assert n_bytes.tolist() == [len((t or "").encode()) for t in AWKWARD]


def test_every_assigned_code_point(library, counter):
    """Between two letters, so that it shows whether it is a letter, a sign, white space or a mark."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    texts = [f"a{p}b" for p in points]
    got = T.count_batch(pa.array(texts), counter)[1]
    assert [hex(ord(p)) for p, a, b in zip(points, got.tolist(), expected(library, texts), strict=True) if a != b] == []


def test_random_texts_short_and_long(library, counter, monkeypatch):
    rng = random.Random(5)
    words = ["the", "quality", "Straße", "naïve", "zzzz", "1999", "état", "überhaupt", "ññ", "co-op", "日本"]
    texts = ["".join(rng.choice([*words, " ", "'s ", "\n"]) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["".join(rng.choice("abeinortst") for _ in range(rng.randrange(1, 400))) for _ in range(300)]
    texts += ["".join(rng.choice("aab") for _ in range(rng.randrange(1, 300))) for _ in range(200)]
    wanted = expected(library, texts)
    assert T.count_batch(pa.array(texts), counter)[1].tolist() == wanted
    for long in (0, 1 << 40):  # all by linked arrays, all in rounds over the whole sequences
        monkeypatch.setattr(T, "LONG", long)
        assert T.count_batch(pa.array(texts), T.Counter(counter.vocabulary))[1].tolist() == wanted


def test_rules_that_are_not_safe_go_one_at_a_time(counter):
    """a+bc makes the same symbol as ab+c, whose rule comes earlier, and so does a rule of the product."""

    class Rules(T.Vocabulary):
        def __init__(self):  # symbols a 0, b 1, c 2, bc 3, abc 4, abca 5
            rules = {(1, 2): (0, 3), (4, 0): (1, 5), (0, 3): (2, 4)}
            self.pairs = np.array(sorted(a << 32 | b for a, b in rules))
            self.ranks = np.array([rules[p >> 32, p & 0xFFFFFFFF][0] for p in self.pairs.tolist()], np.int32)
            self.product = np.array([3, 5, 4])
            self.safe = np.array([True, True, False])

    def plain(symbols):
        rules = {(1, 2): (0, 3), (4, 0): (1, 5), (0, 3): (2, 4)}
        while found := sorted((rules[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in rules):
            i = found[0][1]
            symbols = [*symbols[:i], rules[symbols[i], symbols[i + 1]][1], *symbols[i + 2 :]]
        return len(symbols)

    rng = np.random.default_rng(2)
    rows = [[0, 1, 2, 0, 1, 2], [0, 1, 2, 0, 1, 2, 0], *[rng.integers(0, 3, n).tolist() for n in range(1, 60)]]
    flat, lengths = np.concatenate([np.array(r, np.int64) for r in rows]), np.array([len(r) for r in rows])
    for merge in (T.merge_short, T.merge_long):
        assert merge(flat.copy(), lengths, Rules()).tolist() == [plain(r) for r in rows]


def test_slices_and_forgetting_change_nothing(library, counter, monkeypatch):
    monkeypatch.setattr(T, "SLICE_BYTES", 50)
    monkeypatch.setattr(T, "MEMO", 3)
    texts = [*AWKWARD, "one two three " * 40]
    assert T.count_batch(pa.array(texts), T.Counter(counter.vocabulary))[1].tolist() == expected(library, texts)


def test_long_word_is_counted_whole(library, counter):
    rng = random.Random(1)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(140_000))
    assert T.count_batch(pa.array([text]), counter)[1].tolist() == expected(library, [text])


def test_table(spark, library):
    rows = [(1, "A b", "x"), (1, "A b", "x"), (None, None, None), (2, "word " * 3000, "y")]
    got = T.count_tokens(spark.createDataFrame(rows, "doc_id int, text string, n_tokens string")).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got), key=str) == sorted([(1, 3, 2, False), (1, 3, 2, False), (None, 0, 0, False), (2, 15000, 3000, True)], key=str)
    assert T.count_tokens(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    out = op13_token_counts(spark, folder)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect()}
    counts = expected(library, [d.text for d in docs])
    assert got == {d.doc_id: (len((d.text or "").encode()), n, n > 2048) for d, n in zip(docs, counts, strict=True)}

import hashlib
import random

import pytest

from wayside.llm.sentencepiece_scan import MODEL_PATH, combined, decode, encode, encode_chunk, load_pieces, marked, product, states_between, transfer


def texts():
    rng = random.Random(5)
    words = ["the", "reation", "ndwhst", "éeauou", "Straße", "x" * 90, "thththththereationingtion" * 9, "日本語テキスト", "🙂", "a1b2c3", "\n", "\t"]
    out = ["", " ", "  ", "a", " lead", "trail ", "two  spaces   three", "line\nbreak\r\n", "no" * 200, "é" * 77]
    for n in (5, 40, 200):
        out += ["".join(rng.choice(words) + rng.choice([" ", " ", "", "  ", "\n"]) for _ in range(n)) for _ in range(8)]
    return out


@pytest.mark.parametrize("size", [40, 64, 333])
def test_scan_equals_library(size):
    pieces = load_pieces(MODEL_PATH)
    for text in texts():
        whole = marked(text)
        assert pieces.encode_words(whole) == pieces.lib.encode(text)
        if not whole:
            continue
        cuts = [(lo, min(len(whole), lo + size)) for lo in range(0, len(whole), size)]
        matrices = [transfer(pieces, whole[: hi + 17], lo, hi) for lo, hi in cuts]
        (end,) = {e for e in combined(matrices)[0, 0] if e[0] == len(whole)}
        states = []  # in blocks of three, as the Spark job does
        blocks = [matrices[i : i + 3] for i in range(0, len(matrices), 3)]
        for block, (a, b) in zip(blocks, states_between([combined(x) for x in blocks], (0, 0), end), strict=True):
            states += states_between(block, a, b)
        ids = [i for (lo, hi), (a, b) in zip(cuts, states, strict=True) for i in encode_chunk(pieces, whole[: hi + 17], lo, hi, a, b)]
        assert ids == pieces.lib.encode(text), text[:60]


def test_product_is_associative():
    pieces = load_pieces(MODEL_PATH)
    whole = marked("thththththereationingtion" * 12)
    a, b, c = (transfer(pieces, whole[: hi + 17], lo, hi) for lo, hi in ((0, 60), (60, 120), (120, 180)))
    assert product(product(a, b), c) == product(a, product(b, c))


def test_encode_decode_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("wayside.llm.sentencepiece_scan.BLOCK_CHUNKS", 3)
    rows = [(i if i % 5 else None, t, "x") for i, t in enumerate([*texts(), None])]
    spark.createDataFrame(rows, "doc_id long, text string, chunk string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    lib = load_pieces(MODEL_PATH).lib
    for size in (48, 1 << 16):
        got = encode(docs, keep=("doc_id", "text"), chunk_chars=size).collect()
        assert len(got) == len(rows) and all(r.ids == lib.encode(r.text or "") for r in got)
        got = encode(docs, keep=("text",), chunk_chars=size, decoded=True).collect()
        assert len(got) == len(rows) and all(r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() and r.ids == lib.encode(r.text or "") for r in got)
        coded = encode(docs.withColumnRenamed("text", "original"), text_col="original", keep=("doc_id", "original"), chunk_chars=size)
        back = decode(coded).collect()
        assert len(back) == len(rows) and all(r.text == (r.original or "") for r in back)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert encode(docs).count() == 0 and decode(encode(docs)).count() == 0

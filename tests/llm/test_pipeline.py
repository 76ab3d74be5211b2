"""The pipeline's stages against brute force on a small corpus."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline as P
from wayside.llm.sentencepiece_scan import MODEL_PATH, load_pieces


def corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(4))
    texts = []
    for _ in range(60):
        base = [word() for _ in range(rng.randint(20, 60))]
        texts.append(" ".join(base))
        if rng.random() < 0.4:
            base[rng.randrange(len(base))] = word()
            texts.append(" ".join(base))
        if rng.random() < 0.3:
            texts.append(texts[-1])
    junk = ["### $$$ !!! " * rng.randint(3, 30) + word() for _ in range(30)]
    rows = [(i, t, "en", rng.choice("abc"), len(t)) for i, t in enumerate(texts + junk)]
    return rows, len(texts)


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_stages(spark, tmp_path):
    rows, good = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] < good), 0) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(P.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(docs.collect())
    assert [set(x) for x in map(lambda rows: rows[0].asDict(), kept[:-1])] == [set(P.COLUMNS)] * 4
    text = {r[0]: r[1] for r in rows}
    assert {r.doc_id for r in kept[0]} == set(range(good))
    last = {}
    for i in range(good):
        last[text[i]] = i
    assert sorted(r.doc_id for r in kept[1]) == sorted(last.values())
    sets, group = {i: shingles(text[i]) for i in last.values()}, {i: i for i in last.values()}
    for _ in sets:
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and group[j] < group[i]:
                    group[i] = group[j]
    assert sorted(r.doc_id for r in kept[2]) == sorted(i for i in group if group[i] == i)
    size = {r.doc_id: len(re.findall(r"\S+", r.text)) for r in kept[2]}
    by, total = defaultdict(int), sum(size.values())
    for r in kept[2]:
        by[r.source] += size[r.doc_id]
    times = Counter(r.doc_id for r in kept[3])
    assert max(times.values()) <= 3
    taken = defaultdict(int)
    for r in kept[2]:
        taken[r.source] += times[r.doc_id] * size[r.doc_id]
    for k, s in enumerate(sorted(by)):
        target = total * (k + 1) / 6
        assert target <= 3 * by[s] and target - 1 <= taken[s] <= target + max(size.values())
    lib = load_pieces(MODEL_PATH).lib
    assert Counter(r.doc_id for r in kept[4]) == times
    assert all(list(r.token_ids) == lib.encode(text[r.doc_id]) and r.n_tokens == len(r.token_ids) and r.round_trip for r in kept[4])
    assert len(P.run(spark, str(tmp_path)).collect()) == len(kept[4])


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def stored(spark, folder, name, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


def test_stages_on_nulls_empty_and_long_texts_ties_and_repeated_rows(spark, tmp_path):
    long = " ".join(f"w{i % 977}x{i % 89}" for i in range(40_000))
    plain = "one two three four five six seven eight nine ten"
    rows = [(1, None, "en", "a", 0), (2, "", None, "a", None), (3, " \n", "en", None, 2), (4, plain, "en", "b", 1), (4, plain, "en", "b", 1), (None, plain, "en", "b", 1), (5, long, "en", "c", 1), (6, long + " end", "de", "c", 1)]
    docs = stored(spark, tmp_path, "docs", rows)
    stored(spark, tmp_path, "labels.parquet", [(4, 1, 0), (1, 0, 0), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    texts = lambda df: sorted((str(r.doc_id), r.text) for r in df.collect()) if "text" in df.columns else None
    scored = P.quality(spark, docs, str(tmp_path))
    assert scored.columns == P.COLUMNS and set(r.text for r in scored.collect()) <= {r[1] for r in rows}
    # null and '' are one text; of copies the largest id stays, of rows with one id one
    assert texts(P.exact(spark, docs, str(tmp_path))) == sorted([("2", ""), ("3", " \n"), ("4", plain), ("5", long), ("6", long + " end")], key=str)
    # texts without words link with nothing; of near copies the smallest id stays, a null id only if alone
    near = P.near(spark, docs, str(tmp_path))
    assert near.columns == P.COLUMNS and texts(near) == sorted([("1", None), ("2", ""), ("3", " \n"), ("4", plain), ("5", long)], key=str)
    # texts without words have nothing to give to a mix
    mixed = P.mix(spark, docs, str(tmp_path))
    assert mixed.columns == P.COLUMNS and {r.doc_id for r in mixed.collect()} <= {4, 5, 6, None} and not {r.text for r in mixed.collect()} & {None, "", " \n"}
    coded = P.tokens(spark, docs, str(tmp_path)).collect()
    assert len(coded) == len(rows) and all(r.round_trip for r in coded) and {r.doc_id: r.n_tokens for r in coded}[1] == 0


def test_stages_on_empty_tables(spark, tmp_path):
    docs = stored(spark, tmp_path, "docs", [])
    stored(spark, tmp_path, "labels.parquet", [], "doc_id long, quality int, toxic int")
    for name, stage in P.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0, name

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from tandemsift.llm import language_model as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered) + [None]


def brute(rows):
    """The same model with dictionaries."""
    train = [tokens(t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    count, pair = Counter(), Counter()
    for ts in train:
        count.update(ts)
        pair.update(zip(["<begin>", *ts], ts))
    total, classes = Counter(), defaultdict(Counter)
    for (a, _), c in pair.items():
        total[a] += c
        classes[a][min(c, 3)] += 1
    continued = Counter(b for _, b in pair)
    d1 = lm.discounts([sum(c == k for c in continued.values()) for k in (1, 2, 3, 4)])
    d2 = lm.discounts([sum(c == k for c in pair.values()) for k in (1, 2, 3, 4)])
    n, v = sum(count.values()), len(count)
    uniform = 1 / (v + 1)

    def unigram(w):
        if not pair:
            return uniform
        left = sum(d1[min(c, 3)] for c in continued.values()) / len(pair)
        c = continued[w]
        return (c - d1[min(c, 3)]) / len(pair) + left * uniform

    def bigram(a, w):
        if not total[a]:
            return unigram(w)
        c = pair[a, w]
        left = sum(d2[k] * x for k, x in classes[a].items()) / total[a]
        return (c - d2[min(c, 3)]) / total[a] + left * unigram(w)

    out = []
    for i, t in rows:
        ts = tokens(t)
        out.append((
            i, zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0, len(ts), sum(count[w] > 0 for w in ts), n,
            sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts),
            sum(math.log10(bigram(a, w)) for a, w in zip(["<begin>", *ts], ts)),
        ))
    return out, bigram, [*count, "unseen"]


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, score string")
    return [tuple(r)[:7] for r in lm.score(docs, lm.train(docs, 3, **options)).collect()]


def agree(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5]) and g[6] == pytest.approx(w[6])


def test_scores_are_those_of_dictionaries(spark):
    text = "The cat sat on the mat and the dog sat on the cat. A dog\tand a CAT\n"
    rows = [(i, text[i % 7 : 20 + 3 * i % 50] * (1 + i % 3)) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x" * 5000 + " the cat"), (103, "é É the"), (None, "the mat"), (7, "the cat")]
    want, bigram, words = brute(rows)
    agree(run(spark, rows), want)
    agree(run(spark, rows, bits=34), want)
    assert sum(bigram("the", w) for w in words) == pytest.approx(1)


def test_empty_and_untrained(spark):
    assert run(spark, []) == []
    rows = [(i, "a b") for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    agree(run(spark, rows), brute(rows)[0])


def test_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    agree([tuple(r)[:7] for r in lm.score(docs, lm.train(docs)).collect()], brute(rows)[0])


def test_pairs_of_wide_ids_are_packed_exactly():
    import numpy as np

    rng = np.random.default_rng(1)
    for bits in (32, 33, 36):
        packing = lm.Packing(bits, 5)
        before, ids = rng.integers(0, 2**bits - 1, 1000), rng.integers(0, 2**bits - 1, 1000)
        before[:10] = lm.BEGIN
        keys, part = packing.pack(before, ids)
        shard = packing.shard(keys, part)
        assert shard.max() < packing.all_shards
        for s in np.unique(shard):
            b, i = packing.unpack(keys[shard == s], int(s))
            assert (b == before[shard == s]).all() and (i == ids[shard == s]).all()


def test_long_words_and_texts_hash_alike_in_pieces(monkeypatch):
    import numpy as np

    from tandemsift.llm import arrays

    data = np.frombuffer(b"one two " + b"x" * 5000 + b" three " + b"y" * 700 + b" one", np.uint8)
    starts, ends, _ = arrays.word_spans(data, np.array([0, len(data)]))
    whole = arrays.span_hashes(data, starts, ends)
    for size in (3, 64, 1000):
        monkeypatch.setattr(arrays, "CHUNK", size)
        monkeypatch.setattr(arrays.chunks, "__defaults__", (size,))
        assert (arrays.span_hashes(data, starts, ends) == whole).all()
    assert whole[0] == whole[-1] and len(set(whole.tolist())) == len(whole) - 1


def test_base_columns_agree_with_sql(spark, tmp_path):
    rows = [(i, f"the Cat {'sat ' * (i % 4)}on mat{i % 7}") for i in range(60)] + [(3, "the cat"), (None, "of no id"), (61, None), (62, ""), (63, "\t \n")]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = lm.base_query(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({lm.ORACLE_BASE})").fetchall()
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=str) == sorted(want, key=str)

import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tandemsift.llm import byte_pairs as bp

FILE, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks(spark):
    return bp.Ranks(spark, FILE)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bp.load_ranks(FILE), special_tokens={})


def texts():
    rng = random.Random(2)
    letters = list(" \n\t'abstrevmld019!.-é日 　½🙂") + [chr(c) for c in range(0x80, 0x250, 7)]
    out = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(1500)]
    long = ["a" * 1500, "ab" * 700, "-" * 999, " " * 801 + "x", "".join(rng.choices("abcdefghij", k=900)), "".join(rng.choices("aab", k=400)), "word " * 20000]
    return out + long + [None, "", " ", "  a", "it's 's ''s they'll", "<|endoftext|>a", "x\x1cy\x85z", "\n's", "'re'ree", "é​ b"]


@pytest.mark.parametrize("kept", [0, 20, bp.KEPT])
def test_ids_are_the_librarys_and_decode_to_the_text(spark, ranks, library, kept):
    """However many words stand in the plan; columns that clash are replaced, others stay."""
    rows = [(i, t, "kept", "word") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, word string")
    got = bp.encode(docs, ranks, PATTERN, kept=kept).withColumn("bytes", bp.decode(F.col("ids"), ranks)).collect()
    assert len(got) == len(rows) and got[0].word == "word"
    for r in got:
        assert r.ids == library.encode_ordinary(r.text or ""), repr(r.text)
        assert bytes(r.bytes) == (r.text or "").encode()


def test_every_token_folds_to_itself(spark, ranks):
    tokens = [(t.decode(), n) for t, n in bp.load_ranks(FILE).items() if t.decode(errors="ignore").encode() == t]
    words = spark.createDataFrame(tokens, "word string, id int")
    assert words.filter(F.concat_ws(" ", ranks.fold(F.col("word")).cast("array<string>")) != F.col("id").cast("string")).count() == 0


def test_decoding_strange_ids(spark, ranks):
    rows = [([0, 50255],), ([50256],), ([-1],), ([5, None],), (None,), ([],)]
    got = [r[0] for r in spark.createDataFrame(rows, "ids array<int>").select(bp.decode(F.col("ids"), ranks)).collect()]
    by_rank = {n: t for t, n in bp.load_ranks(FILE).items()}
    assert [bytes(g) if g is not None else None for g in got] == [by_rank[0] + by_rank[50255], None, None, None, None, b""]


def test_empty_table_and_repeated_rows(spark, ranks, library):
    assert bp.encode(spark.createDataFrame([], "doc_id long, text string"), ranks, PATTERN).collect() == []
    rows = spark.createDataFrame([(1, "same words"), (1, "same words"), (None, "same")], "doc_id long, text string")
    got = sorted(len(r.ids) for r in bp.encode(rows, ranks, PATTERN).collect())
    assert got == [1, 2, 2]


def test_files_that_are_no_ranks(tmp_path):
    (tmp_path / "x").write_bytes(b"IQ== 0\nIg== 1\n")
    with pytest.raises(ValueError):
        bp.load_ranks(f"{tmp_path}/x")


def test_pieces_of_a_word_are_read_from_the_tree(spark, ranks):
    """Pieces at a place come from one walk down the tree; before, each stretch of a word was cut out and looked up."""
    by_token = bp.load_ranks(FILE)
    base, check, last = bp.prefix_tree(by_token)
    by_rank = sorted(by_token, key=by_token.get)
    for word in (b" leenementen", b"aaaaaaaa", bytes(range(250, 256)), *by_rank[::500]):
        s, n = bp.ROOT, 0
        while n < len(word) and 0 <= base[s] + word[n] < len(check) and check[base[s] + word[n]] == s:
            s, n = base[s] + word[n], n + 1
        assert by_rank[last[s]] == max((word[:k] for k in range(1, len(word) + 1) if word[:k] in by_token), key=len)
    plan = spark.createDataFrame([("x",)], "word string").select(ranks.fold(F.col("word")))._jdf.queryExecution().analyzed().toString()
    assert "substring" not in plan

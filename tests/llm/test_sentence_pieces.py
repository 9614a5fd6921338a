import random
import struct

import public_tokenizers
import sentencepiece
from tandemsift.llm import sentence_pieces as sp

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def message(*parts):
    out = b""
    for number, value in parts:
        if isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
            continue
        key = (number << 3 | (2 if isinstance(value, bytes) else 0)).to_bytes(1, "little") if number < 16 else bytes([(number << 3 | 0) & 127 | 128, number >> 4])
        size = value if isinstance(value, int) else len(value)
        coded = b""
        while True:
            coded += bytes([size & 127 | (128 if size > 127 else 0)])
            size >>= 7
            if not size:
                break
        out += key + coded + (value if isinstance(value, bytes) else b"")
    return out


def unigram_model():
    """A small unigram model with byte fallback, written by hand."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [("▁", -3.0, 1), ("▁the", -1.5, 1), ("he", -2.5, 1), ("t", -4.0, 1), ("e", -4.1, 1), ("h", -4.2, 1), ("▁t", -3.5, 1), ("cat", -2.0, 1), ("c", -5.0, 1), ("a", -4.9, 1)]
    body = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in pieces)
    return body + message((2, message((3, 1), (35, 1)))) + message((3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))


def crossing_model():
    """A small BPE model with a piece that reaches from one word into the next."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [(p, -float(i), 1) for i, p in enumerate(["t▁", "▁a", "he", "t▁a", "▁t", "▁", "t", "e", "h", "a", "c", "."])]
    body = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in pieces)
    return body + message((2, message((3, 2), (35, 1)))) + message((3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))


def texts():
    rng = random.Random(4)
    letters = list("  \n\taethoc.,- 12é日🙂") + ["the ", "    ", "cat"]
    return ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(800)] + [None, "", " ", "x" * 20000, "<s> <unk> <0x41>", "a\x00b"]


def check(spark, path):
    rows = [(i, t, 5) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    encoded = sp.encode(docs, path)
    got = {r.doc_id: r for r in encoded.collect()}
    original = sentencepiece.SentencePieceProcessor(model_file=path)
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert got[i].token_ids == original.encode(t or ""), repr(t)
        assert got[i].parity and got[i].round_trip and got[i].n_tokens == len(got[i].token_ids)
    back = {r.doc_id: r.text for r in sp.decode(encoded.drop("text"), path).collect()}
    assert back == {i: t or "" for i, t, _ in rows}


def test_bpe_parity_and_round_trip(spark):
    check(spark, MODEL)


def test_unigram_parity_and_round_trip(spark, tmp_path):
    (tmp_path / "u.model").write_bytes(unigram_model())
    check(spark, str(tmp_path / "u.model"))


def test_models_with_pieces_over_words_are_encoded_whole(spark, tmp_path):
    (tmp_path / "c.model").write_bytes(crossing_model())
    assert not sp.separable(sp.parse(crossing_model())) and sp.separable(sp.parse(open(MODEL, "rb").read()))
    check(spark, str(tmp_path / "c.model"))


def test_words_are_remembered_and_forgotten(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(sp, "KNOWN", 50)
    model = open(MODEL, "rb").read()
    words, original = sp.Words(sp.parse(model)), sentencepiece.SentencePieceProcessor(model_proto=model)
    held = [t or "" for t in texts()] + ["▁a ▁▁b", "a▁", "a" * 70_000 + " b"]
    for low in range(0, len(held), 37):
        some = held[low : low + 37]
        ids, counts = words.encode(pa.array(some))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == original.encode(some)
        assert len(words.known) <= 50


def test_empty_table(spark):
    assert sp.encode(spark.createDataFrame([], "doc_id long, text string"), MODEL).collect() == []

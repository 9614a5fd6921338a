import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tandemsift.llm import token_counts as tc

FILE = public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rng = random.Random(1)
    letters = list(" \n\t'abstrevmld019!.-é日 　½🙂") + [chr(c) for c in range(0x80, 0x250, 7)]
    out = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]
    return out + [None, "", " ", "  a", "it's 's ''s they'll", "a" * 3000, "ab" * 2000, "<|endoftext|>a <|endoftext|> b  <|endoftext|>", "x\x1cy\x85z", "\n's", "'re'ree"]


def test_counts_are_the_librarys(spark):
    rows = [(i, t, 1) for i, t in enumerate(texts())]
    got = {r.doc_id: r for r in tc.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), FILE).collect()}
    library = Tokenizer.from_file(FILE)
    for i, t, _ in rows:
        want = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (want, len((t or "").encode()), want > 1024), repr(t)


def test_every_code_point():
    """Each code point between letters, blanks and signs splits as in the library."""
    library = Tokenizer.from_file(FILE)
    codes = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    some = ["".join(f"a{c} {c}.{c}" for c in codes[k : k + 64]) for k in range(0, 0x3400, 64)] + ["".join(f"a{c} {c}" for c in codes[k : k + 64]) for k in range(0x10000, 0x20000, 640)]
    vocabulary = tc.load_vocabulary(open(FILE, encoding="utf-8").read())
    got = tc.Counter(vocabulary).texts(pa.array(some, pa.large_string()))
    assert np.array_equal(got, [len(library.encode(t, add_special_tokens=False).ids) for t in some])


def test_empty_table(spark):
    assert tc.count_tokens(spark.createDataFrame([], "doc_id long, text string"), FILE).collect() == []


def test_the_longest_special_string_is_taken_and_other_files_are_refused(tmp_path):
    import json

    import pytest

    spec = json.load(open(FILE, encoding="utf-8"))
    more = dict(spec["added_tokens"][0], id=50257, content="<|endoftext|>x")
    spec["added_tokens"].append(more)
    library, some = Tokenizer.from_str(json.dumps(spec)), ["a<|endoftext|>xy <|endoftext|>", "<|endoftext|> x<|endoftext|>x"]
    got = tc.Counter(tc.load_vocabulary(json.dumps(spec))).texts(pa.array(some, pa.large_string()))
    assert got.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in some]
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": dict(spec["pre_tokenizer"], add_prefix_space=True)}, {"model": dict(spec["model"], ignore_merges=True)}):
        with pytest.raises(ValueError):
            tc.load_vocabulary(json.dumps(spec | change))

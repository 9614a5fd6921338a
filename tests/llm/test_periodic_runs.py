import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandemsift.llm import periodic_runs as pr


def runs_of(words):
    """All runs by comparing every word with that one period on."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                own = words[i : j + q]
                if not any(q % d == 0 and own[d:] == own[:-d] for d in range(1, q)):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def changed(words, h):
    if h is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def wanted(doc_id, text):
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    words = changed(re.findall(r"[^\x20\x09-\x0D]+", text or ""), h)
    runs = runs_of(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * top[1] // top[2] if runs else None
    return (doc_id, len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(left), milli)


def texts():
    rng = random.Random(4)
    out = []
    for k in range(260):
        letters = "ab" if k % 3 else "abcdefghijklmnopqrst"
        words = rng.choices(letters, k=rng.randint(0, 150))
        for _ in range(rng.randint(0, 3)):  # planted runs, some within others
            unit = rng.choices(letters, k=rng.randint(1, 12))
            unit = unit * 4 + rng.choices(letters, k=1) if rng.random() < 0.3 else unit
            at = rng.randint(0, len(words))
            words[at:at] = (unit * 30)[: rng.randint(20, 160)]
        out.append(rng.choice([" ", "\n", "\t \r\n"]).join(words))
    return out + ["a " * 900, "x y " * 300 + "x", "é ü " * 40, " ", "", None, "one", "\x1c " * 30, " ".join(map(str, range(500)))]


@pytest.mark.parametrize("core", [8, 64, 4096])
def test_tiles_and_their_pieces_hold_every_run(core):
    """Stitched by hand, for tiles far smaller than the texts."""
    for text in texts():
        words = (text or "").split()
        coded = np.array([hash(w) for w in words], np.int64)
        runs = {}
        for p, s, e in sorted(pr.pieces_of(coded, pr.tiles_of(len(words), core))):
            own = runs.setdefault(p, [])
            if own and s <= own[-1][1] - p:
                own[-1][1] = max(own[-1][1], e)
            else:
                own.append([s, e])
        got = sorted(((s, e - s, p) for p, own in runs.items() for s, e in own if e - s >= max(24, 3 * p)), key=lambda r: (r[0], r[2]))
        assert got == runs_of(words), text


def result(docs, **how):
    found = pr.collapse(*pr.find_runs(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")), **how))
    return sorted((tuple(r) for r in found.withColumn("m", F.floor(F.lit(1000) * F.col("length") / F.col("period")).cast("long")).collect()), key=str)


@pytest.mark.parametrize("how", [{}, {"long_bytes": 200, "core": 16}])
def test_whole_results(spark, how):
    """Null ids, ids whose texts change, repeated rows and columns whose names clash; then the same with tiles dealt out."""
    rows = [(i, t, 7, "x") for i, t in enumerate(texts() + texts()[:40])] + [(None, "a " * 30, 1, "y"), (None, "b " * 30, 1, "y")]
    rows += [(5, "one two " * 20, 1, "z")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, k1 int, runs string")
    assert result(docs, **how) == sorted((wanted(r[0], r[1]) for r in rows), key=str)


def test_a_long_text(spark):
    """Runs of all octaves over a text that is dealt out, one of them over most of it."""
    rng = random.Random(3)
    unit = [f"w{rng.randrange(3000)}" for _ in range(9000)]
    words = [f"v{i}" for i in range(5000)] + unit * 3 + unit[:1000] + ["z"] * 700 + [f"u{i % 601}" for i in range(4000)] + [f"t{i}" for i in range(50)]
    planted = [(5000, 28000, 9000), (33000, 700, 1), (33700, 4000, 601)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    _, runs = pr.find_runs(docs, long_bytes=1000)
    assert [(r.start, r.length, r.period) for r in runs.first().runs] == planted


def test_empty_table(spark):
    assert result(spark.createDataFrame([], "doc_id long, text string")) == []

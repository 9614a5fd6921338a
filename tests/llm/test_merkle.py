import hashlib
import zlib

from pyspark.sql import functions as F

from tandemsift.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, tree string, place int, leaf string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def tree(nodes):
    """Levels from the leaves to what remains."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, place):
    """(before, after) at each level."""
    out = []
    for nodes in levels[:-1]:
        low = place - place % 3
        out.append((nodes[low:place], nodes[place + 1 : low + 3]))
        place //= 3
    return out


def wanted(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted([(r[0] is not None, r[0] or 0, leaf(r), r) for r in rows if r[1] == s], key=lambda x: x[:3]) for s in sources}
    trees = {s: tree([x[2] for x in own[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    root, out = top[-1][0], []
    for n, s in enumerate(sources):
        for place, (_, _, digest, r) in enumerate(own[s]):
            path = siblings(trees[s], place) + siblings(top, n)
            node = digest
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                node = leaf((*r[:4], r[4].replace("\n", "")))
            for before, after in path:
                node = h(*before, node, *after)
            out.append((r[0], digest, trees[s][-1][0], root, h(*[x for b, a in path for x in b + a]), node, node == root))
    return sorted(out, key=str)


def found(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, merkle.query(spark, str(tmp_path)).collect()), key=str)


def test_every_proof_on_tall_and_lone_trees(spark, tmp_path):
    """More leaves than a stretch holds, one leaf alone, a null source, ids and texts that are null, equal rows and clashing names."""
    rows = [(i, "hot", "en", i % 7, f"line {i}\nmore {i}" if i % 3 else f"no feed {i}", "x", 5, "y") for i in range(2300)]
    rows += [(i, f"s{i % 40:02d}", None, None, "é\n" * (i % 5), None, None, None) for i in range(3000, 3170)]
    rows += [(9000, "lone", "en", 1, "a\nb", "x", 1, "z"), (9001, "Zoë", "en", 1, "\n", "x", 1, "z")]
    rows += [(i, None, "de", 2, None if i % 2 else "\n", "x", 1, "z") for i in range(9100, 9110)]
    rows += [(None, "nulls", None, None, t, None, None, None) for t in (None, "a\n", "b\n", "b\n")]
    rows += [(9200, "same", "en", 3, "same\n", "x", 1, "z")] * 800
    assert found(spark, rows, tmp_path) == wanted(rows)


def test_empty_and_single(spark, tmp_path):
    assert found(spark, [], tmp_path / "none") == []
    one = [(1, "a", "en", 3, "a\nb", "x", 1, "z")]
    assert found(spark, one, tmp_path / "one") == wanted(one)


def test_descent_reaches_the_asked_leaves_only(spark):
    rows = [(i, f"s{i % 3}", "en", 1, str(i), "x", 1, "z") for i in range(2500)]
    manifest = merkle.build(spark.createDataFrame(rows, SCHEMA))
    asked = manifest.leaves.filter(F.col("doc_id") % 250 == 3).select("tree", "place", "doc_id", "leaf")
    got = merkle.prove(manifest, asked.unionByName(asked)).collect()
    assert len(got) == 20 and all(r.node == r.leaf for r in got)
    folded = merkle.prove(manifest, asked).select(merkle.folded(F.col("leaf"), F.col("path")).alias("f")).distinct().collect()
    assert [r.f for r in folded] == [manifest.root]

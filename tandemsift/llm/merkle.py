"""A Merkle manifest of a table: leaves by source and id, digest-to-children records, proofs by descent from the root.

Trees are worked on a stretch of levels at a time. Nodes of STRETCH levels below one node are a bounded group, so a tree
of a billion leaves takes four shuffles, each 729 times smaller than the one before, instead of nineteen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Nodes of a run, levels of a stretch and the most nodes that stand at the foot of one.
RUN, STRETCH = 3, 6
FOOT = RUN**STRETCH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<digit:int,others:array<string>>>"


def digest_of(parts: Column) -> Column:
    """H of an array of strings: lowercase hex sha256 of the parts one behind the other."""
    return F.sha2(F.array_join(parts, "").cast("binary"), 256)


def field(value: Column) -> Column:
    """A field as it goes into a leaf: `-` if null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    """The leaf of a row of FIELDS; a field given by name takes the place of the column."""
    return F.sha2(F.concat(*[field(replaced.get(c, F.col(c))) for c in FIELDS]).cast("binary"), 256)


def levels(size: Column) -> Column:
    """Levels above so many nodes, until one is left."""
    return F.size(F.filter(F.array(*[F.lit(RUN**k) for k in range(40)]), lambda p: p < size)).cast("long")


def above(size: Column, stretches: int = 1) -> Column:
    """Nodes left of so many after a number of stretches."""
    return F.greatest(F.ceil(size / F.lit(FOOT**stretches)), F.lit(1)).cast("long")


def reduced(nodes: Column, depth: Column) -> Column:
    """The head of a group of nodes so many levels up, and the records of all nodes on the way."""

    def level(state: Column, _: Column) -> Column:
        last = F.ceil(F.size(state["nodes"]) / F.lit(RUN)).cast("int") - 1
        runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(state["nodes"], i * RUN + 1, F.lit(RUN)))
        heads = F.transform(runs, digest_of)
        new = F.zip_with(heads, runs, lambda h, r: F.struct(h.alias("digest"), r.alias("children")))
        return F.struct(heads.alias("nodes"), F.concat(state["records"], new).alias("records"))

    none = F.array().cast("array<struct<digest:string,children:array<string>>>")
    start = F.struct(nodes.alias("nodes"), none.alias("records"))
    return F.aggregate(F.sequence(F.lit(1), depth.cast("int")), start, level)


def stretches_of(nodes: DataFrame, name: str) -> list[DataFrame]:
    """nodes[tree, place, size, digest] of trees -> stored stretches, lowest first.

    A stretch has a row for each node at its top: tree, place, size (nodes of the tree at that height), digest and the
    records digest -> children of the nodes below it. Trees of one node have none.
    """
    made: list[DataFrame] = []
    while True:
        depth = F.least(levels(F.col("size")), F.lit(STRETCH))
        groups = (
            nodes.filter("size > 1")
            .groupBy("tree", F.floor(F.col("place") / FOOT).alias("block"), "size")
            .agg(F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("foot"))
            .withColumn("done", reduced(F.transform("foot", lambda x: x["digest"]), depth))
        )
        stretch = groups.select(
            "tree", F.col("block").alias("place"), above(F.col("size")).alias("size"), F.col("done.nodes")[0].alias("digest"), F.col("done.records").alias("records")
        )
        stretch = common.stored(stretch, f"{name}-{len(made)}")
        if stretch.isEmpty():
            return made
        made.append(stretch)
        nodes = stretch.select("tree", "place", "size", "digest")


def heads_of(nodes: DataFrame, stretches: list[DataFrame]) -> DataFrame:
    """tree and digest of what remains of each tree."""
    found = nodes.filter("size = 1").select("tree", "digest")
    for stretch in stretches:
        found = found.unionByName(stretch.filter("size = 1").select("tree", "digest"))
    return found


@dataclass
class Manifest:
    """leaves[tree, place, size, source, leaf, kept columns]; sources[tree, source, size, subroot]; records by stretches; root (None without rows)."""

    leaves: DataFrame
    sources: DataFrame
    lower: list[DataFrame]
    upper: list[DataFrame]
    root: str | None


def build(docs: DataFrame, **kept: Column) -> Manifest:
    """The manifest of docs[doc_id, source, lang, n_chars, text]; other columns are left out.

    Leaves of a source stand by doc_id, null first, rows of one id by digest; equal rows are leaves of their own with
    one digest. Sources stand by code point, null first. `kept` adds columns worked out with the leaf to leaves. Texts
    are read and hashed once. Places follow from a range partition and a count for each of its parts, so a source of any
    share of the rows is dealt out; nothing meets in one task but the sources' top stretch. An empty table has no root.
    """
    hashed = docs.select("doc_id", "source", leaf_digest().alias("leaf"), *[c.alias(n) for n, c in kept.items()])
    placed = common.ranked(common.stored(hashed, "leaves"), ["source", "doc_id", "leaf"], "placed")
    sizes = common.stored(placed.groupBy("source").agg(F.count("*").alias("size"), F.min("position").alias("_first")), "sources")
    sources = common.ranked(sizes, ["source"], "ordered").withColumnRenamed("position", "tree")
    sources = common.stored(sources, "trees")
    own = common.bounded(sources.withColumnRenamed("source", "_source"))
    leaves = placed.join(own, F.col("source").eqNullSafe(F.col("_source"))).withColumn("place", F.col("position") - F.col("_first"))
    leaves = common.stored(leaves.drop("_source", "_first", "position"), "leaves-placed")
    nodes = leaves.select("tree", "place", "size", F.col("leaf").alias("digest"))
    lower = stretches_of(nodes, "lower")
    subroots = heads_of(nodes, lower).withColumnRenamed("digest", "subroot")
    sources = common.stored(sources.drop("_first").join(subroots, "tree"), "subroots")
    count = sources.count()
    tops = sources.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(count).cast("long").alias("size"), F.col("subroot").alias("digest"))
    upper = stretches_of(tops, "upper")
    root = heads_of(tops, upper).first()
    return Manifest(leaves, sources, lower, upper, root and root["digest"])


def step_down(records: Column, head: Column, path: Column, place: Column, depth: Column) -> Column:
    """From a head so many levels down to a place, by its digits: the node there and the path with the children passed by."""
    digits = F.transform(F.sequence(depth.cast("int") - 1, F.lit(0), F.lit(-1)), lambda e: F.floor(place / F.pow(F.lit(float(RUN)), e)).cast("int") % RUN)

    def level(state: Column, digit: Column) -> Column:
        children = F.element_at(records, state["node"])
        passed = F.struct(digit.alias("digit"), F.filter(children, lambda _, i: i != digit).alias("others"))
        return F.struct(F.element_at(children, digit + 1).alias("node"), F.concat(state["path"], F.array(passed)).cast(PATH).alias("path"))

    return F.aggregate(digits, F.struct(head.alias("node"), path.cast(PATH).alias("path")), level)


def descended(stretches: list[DataFrame], heads: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted[tree, place, ...] with node (what stands at the place) and path (digit and passed siblings, from the root down).

    heads[tree, height, digest, path] has a row for each tree: nodes at its foot, its head and the path to it. Requests
    that share a way go down it as one row, a stretch for each join by digest, and part where their ways do: rows on the
    way are one for each node in use at the stretch's foot. A record is looked up by its digest alone, kept once however
    often it occurs.
    """
    heads = heads.select(F.col("tree").alias("_tree"), F.col("height").alias("_height"), F.col("digest").alias("_head"), F.col("path").alias("_path"))
    tall = F.ceil(levels(F.col("_height")) / F.lit(STRETCH)).cast("int")
    front = None
    for j in range(len(stretches) - 1, -1, -1):
        own = heads.filter(tall == j + 1).withColumn("_block", F.lit(0).cast("long"))
        front = own if front is None else front.unionByName(own)
        records = stretches[j].groupBy("digest").agg(F.map_from_entries(F.array_distinct(F.first("records"))).alias("_records"))
        held = front.join(records.withColumnRenamed("digest", "_head"), "_head")
        asked = wanted if j == 0 else wanted.select("tree", F.floor(F.col("place") / FOOT**j).alias("place")).distinct()
        met = asked.join(held, (F.col("tree") == F.col("_tree")) & (F.floor(F.col("place") / FOOT) == F.col("_block")))
        depth = F.least(levels(above(F.col("_height"), j) if j else F.col("_height")), F.lit(STRETCH))
        met = met.withColumn("_to", step_down(F.col("_records"), F.col("_head"), F.col("_path"), F.col("place") % FOOT, depth))
        if j:
            front = met.select("_tree", "_height", F.col("_to.node").alias("_head"), F.col("_to.path").alias("_path"), F.col("place").alias("_block"))
        else:
            front = met.select(*wanted.columns, F.col("_to.node").alias("node"), F.col("_to.path").alias("path"))
    lone = wanted.join(heads.filter("_height = 1"), F.col("tree") == F.col("_tree"))
    lone = lone.select(*wanted.columns, F.col("_head").alias("node"), F.col("_path").alias("path"))
    return lone if front is None else front.unionByName(lone)


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """requests[tree, place, ...] (leaves, by source and place) with node, subroot and path, the siblings from the leaf up to the root.

    Each leaf goes down from the root, through the tree of sources to its own, by the digits of its places; the path of
    passed siblings is then turned round. Rows of requests keep their columns and may repeat.
    """
    spark = requests.sparkSession
    if manifest.root is None:
        return requests.withColumns({"node": F.lit(None).cast("string"), "subroot": F.lit(None).cast("string"), "path": F.lit(None).cast(PATH)})
    trees = manifest.sources.join(requests.select("tree").distinct(), "tree", "left_semi")
    top = spark.createDataFrame([(0, manifest.sources.count(), manifest.root, [])], f"tree long, height long, digest string, path {PATH}")
    ways = descended(manifest.upper, top, trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("size").alias("height")))
    heads = ways.select(F.col("place").alias("tree"), "height", F.col("node").alias("digest"), "path")
    heads = common.stored(heads, "heads")
    found = descended(manifest.lower, heads, requests).withColumn("path", F.reverse("path"))
    own = common.bounded(manifest.sources.select(F.col("tree").alias("_tree"), "subroot"))
    return found.join(own, F.col("tree") == F.col("_tree")).drop("_tree")


def proof_digest(path: Column) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return digest_of(F.flatten(F.transform(path, lambda s: s["others"])))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path make."""

    def level(node: Column, s: Column) -> Column:
        before, after = F.slice(s["others"], F.lit(1), s["digit"]), F.slice(s["others"], s["digit"] + 1, F.lit(RUN))
        return digest_of(F.concat(before, F.array(node), after))

    return F.aggregate(path, leaf, level)


def query(spark, sf_dir):
    """Manifest, proofs and a check of leaves half of which lost their line feeds; a null id is odd, its text stays."""
    docs = common.table(spark, sf_dir, "documents").select(*FIELDS)
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    changed = F.when(even, leaf_digest(text=F.translate("text", "\n", ""))).otherwise(leaf_digest())
    manifest = build(docs, tampered=changed)
    proved = prove(manifest, manifest.leaves.select("tree", "place", "doc_id", "leaf", "tampered"))
    root = F.lit(manifest.root).cast("string")
    proved = proved.withColumn("folded_root", folded(F.col("tampered"), F.col("path")))
    return proved.select(
        "doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified")
    )


ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         xor({common.CRC32.format("doc_id::VARCHAR")}, 4294967295::BIGINT) % 2 = 0 AS even
  FROM (
    SELECT *, sha256(head || coalesce(octet_length(encode(text))::VARCHAR || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(octet_length(encode(replace(text, chr(10), '')))::VARCHAR || ':' || replace(text, chr(10), ''), '-')) AS stripped
    FROM (
      SELECT doc_id, source, text,
             coalesce(octet_length(encode(doc_id::VARCHAR))::VARCHAR || ':' || doc_id::VARCHAR, '-') || coalesce(octet_length(encode(source))::VARCHAR || ':' || source, '-')
             || coalesce(octet_length(encode(lang))::VARCHAR || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR))::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head
      FROM documents
    )
  )
), t AS (
  SELECT 0 AS level, tree, place, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM d
  UNION ALL
  SELECT level + 1, tree, place // 3, sha256(string_agg(digest, '' ORDER BY place)), max((n + 2) // 3) FROM t WHERE n > 1 GROUP BY level, tree, place // 3
), s AS (
  SELECT 0 AS level, tree AS place, digest, count(*) OVER () AS n FROM t WHERE n = 1
  UNION ALL
  SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), max((n + 2) // 3) FROM s WHERE n > 1 GROUP BY level, place // 3
), steps AS (
  SELECT d.tree, d.place, t.level, coalesce(string_agg(t.digest, '' ORDER BY t.place) FILTER (t.place < d.place // pow(3, t.level)::BIGINT), '') AS before,
         coalesce(string_agg(t.digest, '' ORDER BY t.place) FILTER (t.place > d.place // pow(3, t.level)::BIGINT), '') AS after
  FROM d JOIN t ON d.tree = t.tree AND t.n > 1 AND t.place // 3 = d.place // (3 * pow(3, t.level)::BIGINT)
  GROUP BY d.tree, d.place, t.level
  UNION ALL
  SELECT d.tree, d.place, 100 + s.level, coalesce(string_agg(s.digest, '' ORDER BY s.place) FILTER (s.place < d.tree // pow(3, s.level)::BIGINT), ''),
         coalesce(string_agg(s.digest, '' ORDER BY s.place) FILTER (s.place > d.tree // pow(3, s.level)::BIGINT), '')
  FROM d JOIN s ON s.n > 1 AND s.place // 3 = d.tree // (3 * pow(3, s.level)::BIGINT)
  GROUP BY d.tree, d.place, s.level
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree, place ORDER BY level) AS k FROM steps
), proofs AS (
  SELECT tree, place, sha256(string_agg(before || after, '' ORDER BY k)) AS proof, max(k) AS last FROM numbered GROUP BY tree, place
), f AS (
  SELECT tree, place, 0::BIGINT AS k, CASE WHEN even THEN coalesce(stripped, leaf) ELSE leaf END AS node FROM d
  UNION ALL
  SELECT f.tree, f.place, m.k, sha256(m.before || f.node || m.after) FROM f JOIN numbered m ON m.tree = f.tree AND m.place = f.place AND m.k = f.k + 1
)
SELECT d.doc_id, d.leaf, u.digest AS subroot, r.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = r.digest AS verified
FROM d JOIN t u ON u.tree = d.tree AND u.n = 1 CROSS JOIN (SELECT digest FROM s WHERE n = 1) r
LEFT JOIN proofs p ON p.tree = d.tree AND p.place = d.place
JOIN f ON f.tree = d.tree AND f.place = d.place AND f.k = coalesce(p.last, 0)
"""

"""Queries of data quality, lineage, parity, sampling and order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import intervals as iv
from .common import register

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)


@query(
    "validate_types_enums", "orders",
    """WITH e AS (SELECT o_orderkey, unnest([CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'o_orderstatus:enum' END, CASE WHEN o_totalprice > 400000 THEN 'o_totalprice:range' END, CASE WHEN o_orderkey % 1000 = 7 THEN 'o_comment:required' END,
        CASE WHEN o_orderkey % 500 = 3 THEN 'o_custkey:integer' END]) AS error FROM orders) SELECT * FROM e WHERE error IS NOT NULL""",
)
def _(orders):
    """One row for each cell that breaks its declared type, range or enum, from texts."""
    k = F.col("o_orderkey")
    text = orders.withColumns({"cust": F.when(k % 500 == 3, F.lit("12x")).otherwise(F.col("o_custkey").cast("string")), "comment": F.when(k % 1000 != 7, F.lit("ok"))})
    checks = {
        "o_orderstatus:enum": ~F.col("o_orderstatus").isin("F", "O"),
        "o_totalprice:range": F.col("o_totalprice") > 400000,
        "o_comment:required": F.col("comment").isNull(),
        "o_custkey:integer": F.col("cust").try_cast("long").isNull(),
    }
    return text.select("o_orderkey", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))).alias("error"))


@query("unique_keys", "lineitem", "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(lineitem):
    return lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("rows")).filter("rows > 1")


@query(
    "foreign_keys", "orders lineitem part",
    """SELECT 'orders without lines' AS relation, o_orderkey AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
      UNION ALL SELECT 'lines without order', l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'lines without part', l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)""",
)
def _(orders, lineitem, part):
    def missing(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
        return child.join(parent, F.col(key) == F.col(parent_key), "left_anti").select(F.lit(name).alias("relation"), F.col(key).alias("key"))

    found = missing(orders, "o_orderkey", lineitem, "l_orderkey", "orders without lines")
    found = found.unionByName(missing(lineitem, "l_orderkey", orders, "o_orderkey", "lines without order"))
    return found.unionByName(missing(lineitem, "l_partkey", part, "p_partkey", "lines without part"))


@query(
    "count_consistency", "orders lineitem",
    "SELECT o_orderkey, 1 + o_orderkey % 7 AS declared, coalesce(n, 0) AS found FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey WHERE coalesce(n, 0) <> 1 + o_orderkey % 7",
)
def _(orders, lineitem):
    children = lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    joined = orders.join(children, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", (1 + F.col("o_orderkey") % 7).alias("declared"), F.coalesce("n", F.lit(0)).alias("found")).filter("declared <> found")


@query(
    "coordinate_consistency", "segments",
    """SELECT read_id, attempt_no, CASE WHEN seg_end - seg_start <> 4 + mapq THEN 'LENGTH' END AS length_error, CASE WHEN evidence_class <> 'SPAN' AND purity >= 0.95 THEN 'LIMITED_BUT_EXACT' END AS exact_error FROM segments
      WHERE seg_end - seg_start <> 4 + mapq OR (evidence_class <> 'SPAN' AND purity >= 0.95)""",
)
def _(segments):
    """Rows whose stored length (here the quality) isn't end - start, and limited rows that claim an exact size."""
    length = F.col("seg_end") - F.col("seg_start") != 4 + F.col("mapq")
    exact = (F.col("evidence_class") != "SPAN") & (F.col("purity") >= 0.95)
    return segments.filter(length | exact).select("read_id", "attempt_no", F.when(length, "LENGTH").alias("length_error"), F.when(exact, "LIMITED_BUT_EXACT").alias("exact_error"))


@query(
    "no_overlapping_events", "segments",
    "WITH n AS (SELECT read_id, seg_start, seg_end, lead(seg_start) OVER (PARTITION BY read_id ORDER BY seg_start, seg_end, attempt_no) AS next_start FROM segments) SELECT * FROM n WHERE next_start < seg_end",
)
def _(segments):
    ahead = F.lead("seg_start").over(Window.partitionBy("read_id").orderBy("seg_start", "seg_end", "attempt_no"))
    return segments.select("read_id", "seg_start", "seg_end", ahead.alias("next_start")).filter("next_start < seg_end")


@query(
    "flank_state_rules", "lines",
    """WITH f AS (SELECT l_orderkey, ordinal, CASE l_returnflag WHEN 'N' THEN true WHEN 'R' THEN false END AS flag, CASE l_linestatus WHEN 'O' THEN 'UNIQUE' ELSE CASE WHEN ordinal % 2 = 0 THEN 'NOT_UNIQUE' ELSE 'NOT_EVALUATED' END END AS state FROM lines)
      SELECT * FROM f WHERE (state = 'UNIQUE') <> coalesce(flag, false) OR (state = 'NOT_EVALUATED') <> (flag IS NULL)""",
)
def _(lines):
    flag = F.when(F.col("l_returnflag") == "N", True).when(F.col("l_returnflag") == "R", False)
    state = F.when(F.col("l_linestatus") == "O", "UNIQUE").when(F.col("ordinal") % 2 == 0, "NOT_UNIQUE").otherwise("NOT_EVALUATED")
    rows = lines.select("l_orderkey", "ordinal", flag.alias("flag"), state.alias("state"))
    return rows.filter(((F.col("state") == "UNIQUE") != F.coalesce("flag", F.lit(False))) | ((F.col("state") == "NOT_EVALUATED") != F.col("flag").isNull()))


@query(
    "enum_dictionary_diff", "nation",
    "SELECT n_name AS code, 'MISSING_RIGHT' AS side FROM nation WHERE n_nationkey % 5 = 0 AND n_nationkey % 3 <> 0 UNION ALL SELECT n_name, 'MISSING_LEFT' FROM nation WHERE n_nationkey % 3 = 0 AND n_nationkey % 5 <> 0",
)
def _(nation):
    left, right = (nation.filter(F.col("n_nationkey") % k == 0).select(F.col("n_name").alias("code")) for k in (5, 3))
    return left.exceptAll(right).withColumn("side", F.lit("MISSING_RIGHT")).unionByName(right.exceptAll(left).withColumn("side", F.lit("MISSING_LEFT")))


@query(
    "read_set_coherence", "orders lineitem",
    """SELECT (SELECT count(DISTINCT o_orderkey) FROM orders) AS reads, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS aligned, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS unaligned,
      (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS unknown""",
)
def _(orders, lineitem):
    """Whether two sets of ids agree, as four counts."""
    left, right = orders.select(F.col("o_orderkey").alias("o")).distinct(), lineitem.groupBy(F.col("l_orderkey").alias("l")).agg(F.count("*").alias("n"))
    joined = left.join(right, F.col("o") == F.col("l"), "full_outer")
    unknown = F.coalesce(F.sum(F.when(F.col("o").isNull(), F.col("n"))), F.lit(0))
    return joined.agg(F.count("o").alias("reads"), F.count("l").alias("aligned"), F.count_if(F.col("l").isNull()).alias("unaligned"), unknown.alias("unknown"))


@query(
    "stage_lineage", "lines segments",
    """WITH a AS (SELECT l_orderkey AS read_id, ordinal, l_partkey FROM lines WHERE l_partkey % 50 <> 0), b AS (SELECT read_id, attempt_no AS ordinal, substr(target_region_id, 2)::BIGINT + (mapq = 60)::INT AS l_partkey FROM segments)
      SELECT CASE WHEN a.read_id IS NULL THEN 'ONLY_AFTER' WHEN b.read_id IS NULL THEN 'ONLY_BEFORE' WHEN a.l_partkey <> b.l_partkey THEN 'FIELD_DIFFERS' ELSE 'SAME' END AS outcome, count(*) AS rows FROM a FULL JOIN b ON a.read_id = b.read_id AND a.ordinal = b.ordinal GROUP BY outcome""",
)
def _(lines, segments):
    """What becomes of a stage's rows in the next: kept, changed, lost or new."""
    before = lines.filter("l_partkey % 50 <> 0").select(F.col("l_orderkey").alias("read_id"), "ordinal", "l_partkey")
    key = F.substring("target_region_id", 2, 20).cast("long") + (F.col("mapq") == 60).cast("int")
    after = segments.select("read_id", F.col("attempt_no").alias("ordinal"), key.alias("after_key"))
    joined = before.withColumn("b", F.lit(True)).join(after.withColumn("a", F.lit(True)), ["read_id", "ordinal"], "full_outer")
    outcome = F.when(F.col("b").isNull(), "ONLY_AFTER").when(F.col("a").isNull(), "ONLY_BEFORE").when(F.col("l_partkey") != F.col("after_key"), "FIELD_DIFFERS").otherwise("SAME")
    return joined.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("rows"))


@query(
    "semantic_duplicates", "segments",
    """WITH g AS (SELECT read_id, canonical_motif, count(*) AS rows, count(DISTINCT seg_start // 20) AS raw_clusters, count(DISTINCT seg_start // 60) AS padded_clusters FROM segments GROUP BY ALL HAVING count(*) > 1)
      SELECT CASE WHEN raw_clusters = 1 THEN 'SAME_RAW_CLUSTER' WHEN padded_clusters = 1 THEN 'SAME_PADDED_CLUSTER' ELSE 'DISTINCT' END AS kind, count(*) AS groups, sum(rows)::BIGINT AS rows FROM g GROUP BY kind""",
)
def _(segments):
    place = lambda w: F.count_distinct(F.floor(F.col("seg_start") / w))
    groups = segments.groupBy("read_id", "canonical_motif").agg(F.count("*").alias("n"), place(20).alias("raw"), place(60).alias("padded")).filter("n > 1")
    kind = F.when(F.col("raw") == 1, "SAME_RAW_CLUSTER").when(F.col("padded") == 1, "SAME_PADDED_CLUSTER").otherwise("DISTINCT")
    return groups.groupBy(kind.alias("kind")).agg(F.count("*").alias("groups"), F.sum("n").alias("rows"))


@query(
    "multiplicity_histogram", "lineitem",
    """WITH m AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey), h AS (SELECT n, count(*) AS c FROM m GROUP BY n), k AS (SELECT n, c, sum(c) OVER (ORDER BY n) AS so_far, sum(c) OVER () AS total FROM h)
      SELECT any_value(total)::BIGINT AS reads, round(sum(n * c)::DOUBLE / any_value(total), 6) AS mean, min(n) FILTER (0.5 * (total - 1) < so_far) AS p50, min(n) FILTER (0.9 * (total - 1) < so_far) AS p90, min(n) FILTER (0.99 * (total - 1) < so_far) AS p99, max(n) AS most FROM k""",
)
def _(lineitem):
    """Weighted quantiles (the lower value) of how often each key occurs, from the histogram of counts."""
    hist = lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("c"))
    total = hist.agg(F.sum("c").alias("total"))
    swept = iv.running_before(hist, [], "n", ["n"], F.col("c"), "sum").join(F.broadcast(total))
    at = lambda p, name: F.min(F.when(p * (F.col("total") - 1) < F.col("_before") + F.col("c"), F.col("n"))).alias(name)
    return swept.agg(F.max("total").alias("reads"), F.round(F.sum(F.col("n") * F.col("c")) / F.max("total"), 6).alias("mean"), at(0.5, "p50"), at(0.9, "p90"), at(0.99, "p99"), F.max("n").alias("most"))


@query(
    "concentration", "orders",
    """WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey), r AS (SELECT n, row_number() OVER (ORDER BY n DESC, o_custkey) AS k, row_number() OVER (ORDER BY n, o_custkey) AS up, sum(n) OVER () AS total, count(*) OVER () AS size FROM c)
      SELECT any_value(size) AS categories, any_value(total)::BIGINT AS units, round(sum(n) FILTER (k <= 1)::DOUBLE / any_value(total), 6) AS top1, round(sum(n) FILTER (k <= 10)::DOUBLE / any_value(total), 6) AS top10, round(sum(n) FILTER (k <= 100)::DOUBLE / any_value(total), 6) AS top100,
        round(sum((n::DOUBLE / total) * (n::DOUBLE / total)), 6) AS hhi, round(2.0 * sum(up * n)::DOUBLE / (any_value(size) * any_value(total)) - (any_value(size) + 1)::DOUBLE / any_value(size), 6) AS gini FROM r""",
)
def _(orders):
    """Shares of the largest keys, HHI and Gini, from the histogram of counts: no key is ranked."""
    hist = orders.groupBy("o_custkey").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("c"))
    sums = hist.agg(F.sum(F.col("n") * F.col("c")).alias("total"), F.sum("c").alias("size"))
    swept = iv.running_before(hist, [], "n", ["n"], F.col("c"), "sum").join(F.broadcast(sums))
    n, c, total, size, before = (F.col(x) for x in ("n", "c", "total", "size", "_before"))
    above = size - before - c
    top = lambda k, name: F.round(F.sum(n * F.greatest(F.lit(0), F.least(c, k - above))) / F.max(total), 6).alias(name)
    ranks = n * (c * before + c * (c + 1) / 2)
    gini = 2.0 * F.sum(ranks) / (F.max(size) * F.max(total)) - (F.max(size) + 1) / F.max(size)
    return swept.agg(F.max(size).alias("categories"), F.max(total).alias("units"), top(1, "top1"), top(10, "top10"), top(100, "top100"), F.round(F.sum(c * (n / total) * (n / total)), 6).alias("hhi"), F.round(gini, 6).alias("gini"))


@query(
    "package_parity", "lineitem",
    """WITH a AS (SELECT l_orderkey, l_partkey, l_quantity FROM lineitem), b AS (SELECT l_orderkey, l_partkey, l_quantity + (l_partkey % 997 = 5)::INT AS l_quantity FROM lineitem)
      SELECT 'ONLY_A' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'ONLY_B', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def _(lineitem):
    """Two runs compared as multisets of rows, here one with damaged values."""
    a = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    b = a.withColumn("l_quantity", F.col("l_quantity") + (F.col("l_partkey") % 997 == 5).cast("int"))
    return a.exceptAll(b).select(F.lit("ONLY_A").alias("side"), "*").unionByName(b.exceptAll(a).select(F.lit("ONLY_B").alias("side"), "*"))


@query(
    "nested_subset_parity", "lineitem orders",
    """WITH s AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%')), l AS (SELECT l_orderkey, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY l_orderkey)
      SELECT count(*) AS keys, count(*) FILTER (a.n <> l.n OR a.q <> l.q) AS differing FROM (SELECT l_orderkey, sum(l_quantity) AS q, count(*) AS n FROM s GROUP BY l_orderkey) a JOIN l USING (l_orderkey)""",
)
def _(lineitem, orders):
    """Rows of an anchor set give the same results in a small and a large run."""
    anchor = orders.filter("o_orderpriority LIKE '1%'").select(F.col("o_orderkey").alias("l_orderkey"))
    run = lambda df, p: df.groupBy("l_orderkey").agg(F.sum("l_quantity").alias(f"{p}q"), F.count("*").alias(f"{p}n"))
    both = run(lineitem.join(anchor, "l_orderkey", "left_semi"), "a").join(run(lineitem, "l"), "l_orderkey")
    return both.agg(F.count("*").alias("keys"), F.count_if((F.col("an") != F.col("ln")) | (F.col("aq") != F.col("lq"))).alias("differing"))


@query(
    "reverse_trace", "segments lines part",
    """WITH t AS (SELECT s.read_id, s.attempt_no, (SELECT count(*) FROM part p WHERE 'T' || p.p_partkey = s.target_region_id) AS targets, count(l.l_orderkey) AS alignments FROM segments s LEFT JOIN lines l ON l.l_orderkey = s.read_id AND l.ordinal = s.attempt_no + (s.mapq = 0)::INT GROUP BY ALL)
      SELECT read_id, attempt_no, alignments, targets FROM t WHERE alignments <> 1 OR targets <> 1""",
)
def _(segments, lines, part):
    """Evidence rows that don't lead back to exactly one alignment and one target."""
    rows = segments.select("read_id", "attempt_no", "target_region_id", (F.col("attempt_no") + (F.col("mapq") == 0).cast("int")).alias("ordinal"))
    own = lines.groupBy(F.col("l_orderkey").alias("read_id"), "ordinal").agg(F.count("*").alias("alignments"))
    known = part.groupBy(F.concat(F.lit("T"), "p_partkey").alias("target_region_id")).agg(F.count("*").alias("targets"))
    traced = rows.join(own, ["read_id", "ordinal"], "left").join(known, "target_region_id", "left").fillna(0, ["alignments", "targets"])
    return traced.filter("alignments <> 1 OR targets <> 1").select("read_id", "attempt_no", "alignments", "targets")


@query("hash_shard", "orders", "SELECT o_orderkey, (('0x' || substr(sha256(o_orderkey::VARCHAR), 1, 16))::UBIGINT % 144)::INT AS shard FROM orders")
def _(orders):
    """The shard of an id: the first 64 bits of its SHA-256 as an unsigned number, modulo the number of shards."""
    digest = F.conv(F.substring(F.sha2(F.col("o_orderkey").cast("string"), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return orders.select("o_orderkey", (digest % 144).cast("int").alias("shard"))


@query(
    "bottom_k_sample", "orders",
    """SELECT o_orderkey, false AS anchor FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 1000 <> 0 ORDER BY sha256('seed|' || o_orderkey), o_orderkey LIMIT 500) UNION ALL SELECT o_orderkey, true FROM orders WHERE o_orderkey % 1000 = 0""",
)
def _(orders):
    """The 500 smallest seeded hashes, and anchors always. The limit is kept by every task before the last."""
    ids, anchor = orders.select("o_orderkey"), F.col("o_orderkey") % 1000 == 0
    key = F.sha2(F.concat(F.lit("seed|"), F.col("o_orderkey")), 256)
    sample = ids.filter(~anchor).orderBy(key, "o_orderkey").limit(500).withColumn("anchor", F.lit(False))
    return sample.unionByName(ids.filter(anchor).withColumn("anchor", F.lit(True)))


@query(
    "global_merge_order", "segments",
    "SELECT read_id, target_region_id, attempt_no, seg_start FROM segments",
)
def _(segments):
    """Segments in the package's global key order."""
    return segments.select("read_id", "target_region_id", "attempt_no", "seg_start").orderBy("read_id", "target_region_id", "attempt_no")


@query(
    "incremental_evidence", "events",
    "SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events WHERE event_id % 3 <> 0 GROUP BY event_type",
)
def _(events):
    """What new rows add when those already done (every third id) are left out."""
    done = events.filter("event_id % 3 = 0").select("event_id")
    return events.join(done, "event_id", "left_anti").groupBy("event_type").agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))

"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier is trained on the result.

DataFrame functions only; nothing is shuffled but counts of vote patterns and features, whose number is fixed.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
# Possessive groups never recurse, and a match may start only where no earlier start could have failed for
# the same reason, so that long runs of one class of characters take linear time.
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Forms that the method adds; each with a cheap test that a text must pass first.
LOOSE = {
    "email": rf"(?<![{LOCAL}])[{LOCAL}]++ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]++(?: ?[\[(] ?dot ?[\])] ?|\.)[A-Za-z]{{2,}}+",
    "phone": r"(?<![0-9+(-])(?<!\+[0-9] )(?:\([0-9]{3}\) ?|[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Z0-9])AKIA[A-Z0-9]{16}(?![A-Z0-9])|(?i:(?<![a-z])(?:password|passwd|pwd|token|secret|api[_-]?key) ?[=:] ?\"?[A-Za-z0-9_/+.-]{8,}+\"?)",
}
#: What the gazetteers know unless they are given. Of mail domains any two-letter ending is a country's
#: besides these; of international numbers these are the two-digit country codes and the pairs that a third digit
#: completes, besides 1 and 7; of addresses these first parts are of no host; of cards these begin an issuer's numbers.
GAZETTEERS = {
    "email": ["aero", "app", "arpa", "asia", "biz", "blog", "cat", "cloud", "club", "com", "coop", "dev", "edu", "gov", "info", "int", "jobs", "mil", "mobi", "museum", "name", "net", "online", "org", "post", "pro", "shop", "site", "store", "tech", "tel", "top", "travel", "xyz"],
    "phone": [
        "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
        "21", "22", "23", "24", "25", "26", "29", "35", "37", "38", "42", "50", "59", "67", "68", "80", "85", "87", "88", "96", "97", "99",
    ],
    "ip": ["0", "224", "225", "226", "227", "228", "229", "230", "231", "232", "233", "234", "235", "236", "237", "238", "239", "240", "241", "242", "243", "244", "245", "246", "247", "248", "249", "250", "251", "252", "253", "254", "255"],
    "card": ["22", "23", "24", "25", "26", "27", "34", "35", "36", "37", "38", "4", "50", "51", "52", "53", "54", "55", "56", "57", "58", "60", "62", "63", "64", "65", "67", "81"],
    "secret": ["AKIA", "ASIA", "ghp_", "gho_", "xox", "sk-", "eyJ"],
}
#: Entries of a given gazetteer, at most: they are constants of the query.
ENTRIES = 1 << 14


def listed_by(kind: str, match: Column, lists: dict[str, list[str]]) -> Column:
    """Whether the gazetteer of a kind has the part of a match that it is asked for."""
    among = lambda c: c.isin(*lists[kind]) if lists[kind] else F.lit(False)
    digits = digits_of(match)
    if kind == "email":
        ending = F.lower(F.regexp_extract(match, "([A-Za-z0-9-]+)$", 1))
        return among(ending) | F.regexp_like(ending, F.lit("^[a-z]{2}$"))
    if kind == "phone":
        return ~F.startswith(match, F.lit("+")) | F.left(digits, F.lit(1)).isin("1", "7") | among(F.left(digits, F.lit(2)))
    if kind == "ip":
        return ~among(F.regexp_extract(match, "^0*([0-9]+?)\\.", 1))
    if kind == "card":
        return among(F.left(digits, F.lit(1))) | among(F.left(digits, F.lit(2)))
    prefixes = [F.contains(match, F.lit(p)) for p in lists[kind]]
    return reduce(lambda a, b: a | b, prefixes, F.regexp_like(match, F.lit("[0-9a-f]{16,}|[A-Za-z0-9]{20,}")))


def gazetteers(table: DataFrame | None) -> dict[str, list[str]]:
    """The lists of a table[kind, entry], which must be small; those of kinds that it lacks are the fixed ones."""
    if table is None:
        return GAZETTEERS
    rows = table.select("kind", "entry").filter("kind IS NOT NULL AND entry IS NOT NULL").distinct().limit(ENTRIES + 1).collect()
    if len(rows) > ENTRIES:
        raise ValueError(f"gazetteers have more than {ENTRIES} entries")
    found: dict[str, list[str]] = {}
    for kind, entry in sorted(map(tuple, rows)):
        found.setdefault(kind, []).append(entry)
    return GAZETTEERS | found


CONTEXT = {
    "email": r"(?i)(mail|contact|write|at|from|to)\W{0,3}$",
    "ip": r"(?i)\b(ip|host|server|address)\W{0,3}$",
    "card": r"(?i)\b(card|visa|account|pay)\W{0,3}$",
    "phone": r"(?i)\b(tel|phone|call|mobile|fax)\W{0,3}$",
    "secret": r"(?i)\b(key|secret|password|login)\W{0,3}$",
}
LABELERS = ("format", "check", "gazetteer", "context", "edges")
FEATURES = ("check", "gazetteer", "length", "digits", "left", "right")
ROUNDS = 12
#: Values of a tile of a scan, pieces that are cut out of one stretch of text, and a place past every text.
TILE, PIECES, FAR = 256, 512, (1 << 31) - 1


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes the check."""
    each = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: (lambda d: F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))(
            F.ascii(F.substring(F.reverse(digits), i, F.lit(1))) - 48
        ),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """The check of a base match; matches that fail are dropped."""
    digits = digits_of(match)
    if kind == "ip":
        bare = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(bare, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        size = F.length(digits)
        return F.when(size.between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once: functions of arrays would work it out at each place that names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scan(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running results of op over an array of whole numbers, by tiles: a growing array is copied at each step, so none may be long.

    A tile has TILE values; the results of whole tiles are run over likewise, so a text of n matches takes some
    TILE * n + (n / TILE) ** 2 copied places.
    """
    last = lambda a: F.get(a, F.size(a) - 1)
    grown = lambda a: F.aggregate(a, F.array().cast("array<int>"), lambda acc, v: F.concat(acc, F.array(F.coalesce(op(last(acc), v), v))))
    tiled = lambda a: F.transform(F.sequence(F.lit(0), F.size(a), F.lit(TILE)), lambda i: grown(F.slice(a, i + 1, TILE)))
    joined = lambda tiles, before: F.flatten(F.transform(tiles, lambda t, i: F.transform(t, lambda v: F.coalesce(op(F.get(before, i - 1), v), v))))
    return let(let(values, tiled), lambda tiles: let(grown(F.transform(tiles, last)), lambda before: joined(tiles, before)))


def matches(text: Column, kind: str, pattern: str, base: bool, test: Column, lists: dict[str, list[str]]) -> Column:
    """Leftmost matches as structs. Places come from the lengths of the matches and of the gaps between, in linear time."""

    def spans(found: Column, gaps: Column) -> Column:
        ends = scan(F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.length(g) + F.length(m)), lambda a, x: a + x)
        rows = F.arrays_zip(found.alias("m"), ends.alias("e"), F.slice(gaps, 1, F.size(found)).alias("l"), F.slice(gaps, 2, F.size(found)).alias("r"))
        return F.transform(rows, lambda x: let(valid(kind, x["m"]) if base else F.lit(True), lambda ok: F.struct(
            F.lit(kind).alias("kind"),
            (x["e"] - F.length(x["m"])).alias("start"),
            x["e"].alias("end"),
            (ok & F.lit(base)).alias("base"),
            *signals(kind, x["m"], x["l"], x["r"], ok, base, lists),
        )))

    some = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: let(F.split(text, pattern, -1), lambda gaps: spans(found, gaps)))
    return F.when(test, some).otherwise(F.array().cast(SPAN))


def signals(kind: str, match: Column, left: Column, right: Column, ok: Column, base: bool, lists: dict[str, list[str]]) -> list[Column]:
    """Votes of the labelers (1, 0 or -1) and the classifier's features, all of few values."""
    before = F.right(left, F.lit(24))
    glued = F.regexp_like(before, F.lit(r"[A-Za-z0-9]$")) | F.regexp_like(right, F.lit(r"^[A-Za-z0-9]"))
    side = lambda c: F.when(c == "", 0).when(F.regexp_like(c, F.lit(r"^\s$")), 1).when(F.regexp_like(c, F.lit("^[A-Za-z0-9]$")), 2).otherwise(3)
    share = F.floor(10 * F.length(digits_of(match)) / F.length(match)).cast("int")
    check = F.when(ok, 1).otherwise(-1) if kind in ("ip", "card", "phone") else F.lit(0)
    return [
        F.lit(1 if base or kind == "secret" else 0).alias("format"),
        check.alias("check"),
        F.when(listed_by(kind, match, lists), 1).otherwise(-1).alias("gazetteer"),
        F.when(F.regexp_like(before, F.lit(CONTEXT[kind])), 1).otherwise(0).alias("context"),
        F.when(glued, -1).otherwise(1).alias("edges"),
        F.least(F.length(match).bitwiseAND(~3), F.lit(60)).alias("length"),
        share.alias("digits"),
        side(F.right(left, F.lit(1))).alias("left"),
        side(F.left(right, F.lit(1))).alias("right"),
    ]


SPAN = "array<struct<kind:string,start:int,end:int,base:boolean,format:int,check:int,gazetteer:int,context:int,edges:int,length:int,digits:int,left:int,right:int>>"


def candidates(text: Column, lists: dict[str, list[str]] = GAZETTEERS) -> Column:
    """All candidate spans of a text: base matches, kept or failed, and loose forms apart from kept base spans."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    has = lambda *parts: reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])
    tests = {
        "email": has("@"),
        "ip": F.regexp_like(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]")),
        "card": F.regexp_like(text, F.lit(r"[0-9][0-9\x20-]{12}")),
        "phone": has("+"),
    }
    base = F.concat(*[matches(text, k, PATTERNS[k], True, tests[k], lists) for k in BASE])
    loose_tests = {"email": has("(at", "[at", "( at", "[ at"), "phone": F.regexp_like(text, F.lit("[0-9]{3}-[0-9]{4}")), "secret": has("AKIA", "=", ":")}
    loose = F.concat(*[matches(text, k, p, False, loose_tests[k], lists) for k, p in LOOSE.items()])
    return F.concat(base, loose)


def apart(spans: Column) -> Column:
    """Sorted spans without added ones that meet a base span: one that reaches past their start, or starts before their end."""

    def left(s: Column) -> Column:
        reached = scan(F.transform(s, lambda x: F.when(x["base"], x["end"]).otherwise(0)), F.greatest)
        coming = F.reverse(scan(F.reverse(F.transform(s, lambda x: F.when(x["base"], x["start"]).otherwise(FAR))), F.least))
        rows = F.arrays_zip(s.alias("s"), reached.alias("r"), coming.alias("c"))
        return F.transform(F.filter(rows, lambda x: x["s"]["base"] | ((x["r"] <= x["s"]["start"]) & (x["c"] >= x["s"]["end"]))), lambda x: x["s"])

    return let(spans, left)


def number(x: float) -> str:
    return f"{x:.12e}D"


def posterior(log_odds: str) -> str:
    return f"1D / (1D + exp(-greatest(-30D, least(30D, {log_odds}))))"


def estimate(spans: DataFrame) -> dict[str, str]:
    """EM over the labelers' votes, in counts of vote patterns: SQL for the log odds of each kind's spans.

    The labelers are independent given whether a span is personal data; each has its own chance of each
    vote for either case. The pattern table has a fixed number of rows at most, the driver gets one row
    of sums a kind and round.
    """
    patterns = common.stored(spans.groupBy("kind", *LABELERS).agg(F.count("*").alias("n")), "votes")
    odds = dict.fromkeys(KINDS, " + ".join(f"1.5D * {c}" for c in LABELERS))
    for _ in range(ROUNDS):
        p = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {posterior(o)}" for k, o in odds.items()) + " END")
        sums = [F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")]
        for c in LABELERS:
            for v in (-1, 0, 1):
                hit = F.when(F.col(c) == v, F.col("n")).otherwise(0)
                sums += [F.sum(hit * F.col("p")).alias(f"{c}{v}yes"), F.sum(hit * (1 - F.col("p"))).alias(f"{c}{v}no")]
        for row in patterns.withColumn("p", p).groupBy("kind").agg(*sums).collect():
            terms = [number(math.log((row["yes"] + 1) / (row["no"] + 1)))]
            for c in LABELERS:
                ratio = {v: math.log((row[f"{c}{v}yes"] + 1) / (row["yes"] + 3) * (row["no"] + 3) / (row[f"{c}{v}no"] + 1)) for v in (-1, 0, 1)}
                terms.append(f"CASE {c} WHEN 1 THEN {number(ratio[1])} WHEN 0 THEN {number(ratio[0])} ELSE {number(ratio[-1])} END")
            odds[row["kind"]] = " + ".join(terms)
    common.remove(patterns, spans.sparkSession)
    return odds


def train(found: DataFrame) -> dict[str, float]:
    """The span classifier: log odds of each kind and of each value of each feature, from EM's posteriors.

    found[spans] holds all candidates of all documents. What comes to the driver is bounded by the
    features' values, not by the data.
    """
    spans = found.select(F.explode("spans").alias("s")).select("s.*")
    odds = estimate(spans)
    p = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {posterior(o)}" for k, o in odds.items()) + " END")
    pairs = F.array(F.lit("all"), *[F.concat_ws("=", F.lit(f), F.col(f)) for f in FEATURES])
    rows = (
        spans.withColumn("p", p)
        .select("kind", "p", F.explode(pairs).alias("feature"))
        .groupBy("kind", "feature")
        .agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
        .collect()
    )
    total = {r["kind"]: (r["yes"], r["no"]) for r in rows if r["feature"] == "all"}
    weights = {}
    for r in rows:
        yes, no = total[r["kind"]]
        if r["feature"] == "all":
            weights[f"{r['kind']}|all"] = math.log((yes + 1) / (no + 1))
        else:
            weights[f"{r['kind']}|{r['feature']}"] = math.log((r["yes"] + 1) / (yes + 2) * (no + 2) / (r["no"] + 1))
    return weights


def kept(spans: Column, weights: dict[str, float]) -> Column:
    """Base spans and the candidates that the classifier takes, by start, then kind as listed."""
    if weights:
        table = F.create_map(*[F.lit(x) for item in sorted(weights.items()) for x in item])
        weight = lambda s, key: F.coalesce(F.try_element_at(table, F.concat(s["kind"], F.lit("|"), key)), F.lit(0.0))
        score = lambda s: reduce(lambda a, b: a + b, [weight(s, F.lit("all"))] + [weight(s, F.concat(F.lit(f + "="), s[f].cast("string"))) for f in FEATURES])
        spans = F.filter(spans, lambda s: s["base"] | ((s["check"] >= 0) & (score(s) > 0)))
    place = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    slim = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base")))
    return apart(F.array_sort(slim))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, gazetteer: DataFrame | None = None) -> DataFrame:
    """docs[doc_id, text] -> doc_id, spans (arrays of start, place, kind, end, base), trained on all of docs.

    gazetteer[kind, entry] has lists of the labeler of that name, as mail endings or dialling codes.

    Every text is taken whole; null counts as empty and has no spans; without candidates nothing is
    trained; repeated rows give repeated results; an empty table gives none; other columns are ignored.
    """
    found = common.stored(docs.select("doc_id", candidates(F.col("text"), gazetteers(gazetteer)).alias("spans")), "spans")
    return found.select("doc_id", kept(F.col("spans"), train(found)).alias("spans"))


def masked(docs: DataFrame, gazetteer: DataFrame | None = None) -> DataFrame:
    """docs with each span of personal data in `text` replaced by its kind in angle brackets.

    Spans that overlap are masked as one, named after the first. Patterns run once: texts are stored with their
    candidates. Null texts stay null; repeated rows are masked alike; an empty table gives none; other columns stay, but
    the name _spans is this function's own.
    """
    found = common.stored(docs.withColumn("_spans", candidates(F.col("text"), gazetteers(gazetteer))), "spans")
    weights = train(found.select(F.col("_spans").alias("spans")).filter(F.size("spans") > 0))
    text = F.col("text")

    def clean(s: Column) -> Column:
        """Each span that starts past all before it ends a piece of text; pieces are cut out of a tile's own stretch."""
        ends = scan(F.transform(s, lambda x: x["end"]), F.greatest)
        return let(ends, lambda e: F.concat(F.array_join(let(heads(s, e), cut), ""), F.substring(text, F.get(e, F.size(e) - 1) + 1, F.length(text))))

    def heads(s: Column, ends: Column) -> Column:
        rows = F.transform(s, lambda x, i: F.struct(F.when(i == 0, 0).otherwise(F.get(ends, i - 1)).alias("at"), x["start"].alias("start"), x["kind"].alias("kind")))
        return F.filter(rows, lambda x: x["start"] >= x["at"])

    def cut(h: Column) -> Column:
        tiles = F.transform(F.sequence(F.lit(0), F.size(h) - 1, F.lit(PIECES)), lambda i: F.slice(h, i + 1, PIECES))
        first, last = (lambda t: F.get(t, F.lit(0))["at"]), (lambda t: F.get(t, F.size(t) - 1)["start"])
        piece = lambda x, part, t: F.concat(F.substring(part, x["at"] - first(t) + 1, x["start"] - x["at"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))
        return F.flatten(F.transform(tiles, lambda t: let(F.substring(text, first(t) + 1, last(t) - first(t)), lambda part: F.transform(t, lambda x: piece(x, part, t)))))

    marked = found.withColumn("_spans", kept(F.col("_spans"), weights))
    return marked.withColumn("text", F.when(F.size("_spans") > 0, clean(F.col("_spans"))).otherwise(F.col("text"))).select(*docs.columns)


def query(spark, sf_dir):
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["base"])
    count = lambda k: F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    found = find(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"))


def base_query(spark, sf_dir):
    """The base columns of the query, which SQL can hold it against."""
    return query(spark, sf_dir).drop("spans")


_found = lambda kind, place, pattern: f"""SELECT doc_id, '{kind}' AS kind, {place} AS place, ms[i] AS m, list_sum(list_transform(gs[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS s
    FROM (SELECT doc_id, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM d))"""  # noqa: E731
ORACLE_BASE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), f AS ({_found('email', 0, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+')}
  UNION ALL {_found('ip', 1, '[0-9]+(?:[.][0-9]+)(?:[.][0-9]+)(?:[.][0-9]+)')}
  UNION ALL {_found('card', 2, '[0-9](?:[ -]?[0-9])+')}
  UNION ALL {_found('phone', 3, '[+][0-9][ ().0-9-]+[0-9]')}
), g AS (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits FROM f
), v AS (
  SELECT *, s + len(m) AS e FROM g WHERE CASE kind
    WHEN 'ip' THEN len(list_filter(string_split(m, '.'), lambda x: len(ltrim(x, '0')) > 3 OR ('0' || ltrim(x, '0'))[:4]::INT > 255)) = 0
    WHEN 'card' THEN len(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, len(digits) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN substr(reverse(digits), i, 1)::INT WHEN substr(reverse(digits), i, 1)::INT > 4 THEN 2 * substr(reverse(digits), i, 1)::INT - 9 ELSE 2 * substr(reverse(digits), i, 1)::INT END)) % 10 = 0
    WHEN 'phone' THEN len(digits) BETWEEN 10 AND 15 ELSE true END
), a AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
  string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, place) AS listed FROM v GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(listed, '')) AS base_sha256 FROM d LEFT JOIN a USING (doc_id)
"""

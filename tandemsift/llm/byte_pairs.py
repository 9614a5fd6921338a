"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

A pre-token is a string with a character for each byte; ranked merges are folded over it. Which ones may apply is read
from a tree of all tokens' prefixes, that stands in the plan as literal arrays. Every distinct word of high count is folded once and kept in a second literal; the others are folded where
they stand. Nothing runs in Python, and no text or word is shuffled but for the count of distinct words.
"""

from __future__ import annotations

import base64
import json
import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Unicode's white space, as Java's \s is ASCII's only. Fixed values.
SPACES = r"\x09-\x0D\x20\x85\xA0  -     　"
#: Distinct words kept in the plan at most, the longest in bytes, and hash buckets of their map.
KEPT, LONGEST, WORD_BUCKETS = 1 << 17, 64, 1 << 14
#: The character of rank 0: from here on characters take four bytes, and there is room for 900,000 ranks.
BASE = 0x20000
#: The node of the tree of tokens at which words start.
ROOT = 1
#: Steps of an octave of word counts, to find the least count of the words that are kept.
STEPS = 8


def java_pattern(pattern: str) -> str:
    """The pattern with white space spelled out."""
    return pattern.replace(r"\S", f"[^{SPACES}]").replace(r"[^\s", f"[^{SPACES}").replace(r"\s", f"[{SPACES}]")


def words_of(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing or sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2 and so on, with all single bytes among them")
    return ranks


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def hashed_map(entries: DataFrame, buckets: int) -> Callable[[Column], Column]:
    """entries[key string, value], of a bounded number, as a literal map: a function from key to value, null if there is none.

    Spark looks through a map's keys one by one, so the literal is an array of small maps by the key's hash.
    """
    kind = f"array<map<string,{entries.schema['value'].dataType.simpleString()}>>"
    rows = entries.groupBy(bucket(F.col("key"), buckets).alias("at")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("key", "value")))).alias("map")).collect()
    maps = ["{}"] * buckets
    for row in rows:
        maps[row["at"]] = row["map"]
    literal = F.from_json(F.lit(f"[{','.join(maps)}]"), kind)
    return lambda key: F.try_element_at(F.element_at(literal, bucket(key, buckets) + 1), key)


class Ranks:
    """The ranks of a file as literals, with the fold over one word.

    A piece is one character, BASE and its rank, and a word's bytes are a string of such characters, so a merge is a
    replacement of two characters by one, from the left.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        ranks = load_ranks(path)
        self.size, self.widest = len(ranks), max(map(len, ranks))
        self.single = symbols(ranks[bytes([b])] for b in range(256))
        by_rank = sorted(ranks, key=ranks.get)
        self.pieces = F.from_json(F.lit(json.dumps([base64.b64encode(t).decode() for t in by_rank])), "array<binary>")
        base, check, last = prefix_tree(ranks)
        tables = {
            "base": ("int", base),
            "check": ("int", check),
            "last": ("int", last),
            "prefixes": ("array<int>", [[ranks[t[:n]] for n in range(2, len(t) + 1) if t[:n] in ranks] for t in by_rank]),
            "pair": ("string", [symbols(split(t, ranks)) if len(t) > 1 else None for t in by_rank]),
            "symbol": ("string", [symbols([r]) for r in range(len(ranks))]),
        }
        self.tables = F.struct(*[F.from_json(F.lit(json.dumps(values)), f"array<{kind}>").alias(name) for name, (kind, values) in tables.items()])

    def merges(self, chars: Column, t: Column) -> Column:
        """Of a string with a character for each byte, the ranks of all stretches that are pieces of two bytes or more, lowest first.

        From each place the tree is walked down as far as bytes lead; the node where the walk ends (the state, less than
        0 from then on) knows the longest piece on its way, and with that the shorter ones. `t` has the tables.
        """
        step = lambda s, b: F.when(s < 0, s).when(F.get(t["check"], F.get(t["base"], s) + b) == s, F.get(t["base"], s) + b).otherwise(-s)

        def from_places(codes: Column) -> Column:
            def ends(b: Column, i: Column) -> Column:
                """Most walks end within four bytes; slices are made for the others only."""
                near = F.array(b, *[F.get(codes, i + k) for k in (1, 2, 3)])
                further = lambda s: F.aggregate(F.slice(codes, i + 5, F.lit(self.widest)), s, step)
                return F.aggregate(near, F.lit(ROOT), step, lambda s: F.abs(F.when(s < 0, s).otherwise(further(s))))

            return F.transform(codes, lambda b, i: F.get(t["prefixes"], F.get(t["last"], ends(b, i))))

        return F.sort_array(F.array_distinct(F.flatten(let(F.transform(F.split(chars, ""), F.ascii), from_places))))

    def fold(self, word: Column) -> Column:
        """The ids of a word: merges of the pieces in it, by rank, each at all places at once.

        A piece arises from one pair only, what its bytes alone come to before it: a piece that stands in a word was never
        merged over its ends. So all merges that a word may need are those of its stretches, each is tried once, and no
        merge makes way for another of lower rank. Steps down the tree are linear in the word's length, replacements at
        most one for each rank. The tables stand in the plan once, as what a lambda function is given.
        """
        chars = F.decode(word.cast("binary"), "ISO-8859-1")
        latin = "".join(map(chr, range(256)))

        def folded(x: Column) -> Column:
            c, t = x["c"], x["t"]
            start = F.translate(c, latin, self.single)
            done = F.aggregate(self.merges(c, t), start, lambda s, r: F.replace(s, F.get(t["pair"], r), F.get(t["symbol"], r)))
            return F.when(F.length(c) == 1, start).otherwise(done)

        return F.transform(F.split(let(F.struct(chars.alias("c"), self.tables.alias("t")), folded), ""), lambda c: F.ascii(c) - BASE)


def prefix_tree(ranks: dict[bytes, int]) -> tuple[list[int], list[int], list[int]]:
    """The tree of all tokens' prefixes as (base, check, last), each by node.

    From node s byte b leads to t = base[s] + b if check[t] = s, else nowhere; ROOT is the start. last[s] is the
    rank of the longest token on the way to s, s included; the root, which has none, has 0 and no walk ends there.
    """
    children: list[dict[int, int]] = [{}]
    rank_at: dict[int, int] = {}
    for token, rank in ranks.items():
        at = 0
        for b in token:
            if b not in children[at]:
                children[at][b] = len(children)
                children.append({})
            at = children[at][b]
        rank_at[at] = rank
    base, check, last, taken = [0, 0], [0, 0], [0, 0], bytearray(b"\1\1")
    place, order, low = {0: ROOT}, [0], 0
    for node in order:
        below = children[node]
        if not below:
            continue
        order += below.values()
        while low < len(taken) and taken[low]:
            low += 1
        first, *rest = (b - min(below) for b in sorted(below))
        # nodes with several ways down look for room behind the crowded part
        slot = max(low, len(taken) - (256 if rest else len(taken)))
        while any(taken[slot + d : slot + d + 1] == b"\1" for d in (first, *rest)):
            slot += 1
        own = base[place[node]] = slot - min(below)
        more = own + max(below) + 1 - len(taken)
        if more > 0:
            taken += bytes(more)
            base += [0] * more
            check += [0] * more
            last += [0] * more
        for b, child in below.items():
            t = place[child] = own + b
            taken[t], check[t] = 1, place[node]
            last[t] = rank_at.get(child, last[place[node]])
    return base, check, last


def symbols(ranks: Iterable[int]) -> str:
    return "".join(chr(BASE + r) for r in ranks)


def split(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The two ranks whose merge gives a token: what merging its bytes by ranks below its own comes to."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        pairs = [ranks.get(a + b, len(ranks)) for a, b in zip(parts, parts[1:])]
        at = min(range(len(pairs)), key=pairs.__getitem__)
        if pairs[at] >= ranks[token]:
            raise ValueError(f"no merges of lower ranks lead to the token {token!r}")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def word_counts(docs: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """word and count of all pre-tokens of all texts."""
    return docs.select(F.explode(words_of(F.col(text_col), pattern)).alias("word")).groupBy("word").count()


def least_count(counts: DataFrame, kept: int) -> float:
    """The least count, to an eighth of an octave, that `kept` words at most reach: a histogram of a few hundred rows decides."""
    steps = counts.groupBy(F.floor(F.log2("count") * STEPS).alias("step")).count().orderBy(F.desc("step")).collect()
    words, found = 0, math.inf
    for row in steps:
        words += row["count"]
        if words > kept:
            break
        found = row["step"]
    return found


def encode(docs: DataFrame, ranks: Ranks, pattern: str, text_col: str = "text", kept: int = KEPT) -> DataFrame:
    """docs with `ids`: the ranks of every whole text, each match of the pattern merged by itself; a column ids is replaced.

    Distinct words are counted over all texts; the most frequent, `kept` of LONGEST bytes at most, are folded once and go
    into the plan, which has thus a bounded size whatever the corpus. All other words, of any length, are folded in their
    rows. Null and empty texts have no ids. Repeated rows give repeated results; an empty table gives none. Letters and
    numbers are those of Java's Unicode version, so characters younger than it may be parted otherwise than by the library.
    """
    counts = common.stored(word_counts(docs.filter(F.col(text_col) != ""), pattern, text_col), "words")
    chosen = counts.filter((F.floor(F.log2("count") * STEPS) >= least_count(counts, kept)) & (F.octet_length("word") <= LONGEST))
    known = hashed_map(chosen.select(F.col("word").alias("key"), ranks.fold(F.col("word")).alias("value")), WORD_BUCKETS)
    common.remove(counts, docs.sparkSession)
    ids = F.flatten(F.transform(words_of(F.col(text_col), pattern), lambda w: F.coalesce(known(w), ranks.fold(w))))
    return docs.withColumn("ids", ids)


def decode(ids: Column, ranks: Ranks) -> Column:
    """The bytes of an array of ids: their pieces, one behind the other. Null if ids are null, hold null or none of the ranks."""
    text = F.array_join(F.transform(ids, lambda i: F.get(ranks.pieces, i).cast("string")), "")
    return F.when(F.forall(ids, lambda i: F.coalesce((i >= 0) & (i < ranks.size), F.lit(False))), text.cast("binary"))


def query(spark, sf_dir):
    import public_tokenizers

    ranks = Ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = encode(common.table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    ids = F.col("ids")
    return docs.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decode(ids, ranks), 256).alias("decoded_sha256"),
    )

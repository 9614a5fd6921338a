"""Token counts of a byte-level BPE vocabulary by rank-synchronous array merging."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common

LETTER, NUMBER, SPACE = 1, 2, 3
#: The letters that make a token of their own after an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
NONE = np.int32(2**31 - 1)
#: Pre-tokens whose counts a worker keeps between batches.
REMEMBERED = 1 << 20
_classes: np.ndarray | None = None


def char_classes() -> np.ndarray:
    """The class of every code point: letter, number, white space or other (0)."""
    global _classes
    if _classes is None:
        _classes = np.zeros(0x110000, np.uint8)
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                codes = np.frombuffer(m[0].encode("utf-32-le"), np.uint32)
                _classes[codes] = kind
    return _classes


def load_vocabulary(text: str) -> dict:
    """A tokenizer file as arrays: byte symbols, sorted pair keys with rank and merged symbol, special strings.

    Files that ask for another way of counting than byte-level BPE on bare texts are refused.
    """
    spec = json.loads(text)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    bare = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec.get("normalizer")
    marked = [t for t in spec.get("added_tokens") or () if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]
    if not (plain and bare) or marked:
        raise ValueError("only byte-level BPE without a normaliser, a blank put before texts or stripping special strings is supported")
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    return {
        "bytes": np.array([vocab[shown[b]] for b in range(256)], np.int64),
        "keys": keys[order],
        "ranks": order.astype(np.int32),
        "merged": np.array([vocab[a + b] for a, b in pairs], np.int64),
        # of special strings that start at one place the longest is taken
        "special": sorted((t["content"] for t in spec.get("added_tokens") or ()), key=len, reverse=True),
    }


def pre_token_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets at which pre-tokens start; every row starts anew.

    Words, numbers and other signs form runs that take one blank before them along; of white space
    before a run the last character stands apart; an apostrophe ending takes its letters from the run
    that follows.
    """
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[lead].astype(np.uint32)
    for size, low, high in ((2, 0xC0, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0xF8)):
        wide = np.flatnonzero((code >= low) & (code < high) & (code == data[lead]))
        value = code[wide] & np.uint32((1 << (7 - size)) - 1)
        for k in range(1, size):
            value = value << np.uint32(6) | (data[lead[wide] + k] & np.uint32(0x3F))
        code[wide] = value
    n = len(lead)
    kind = char_classes()[code]
    row_start = np.zeros(n + 1, bool)
    row_start[np.searchsorted(lead, offsets)] = True
    row_start = row_start[: n + 1]
    start = row_start[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    start[:1] = True
    solid = np.flatnonzero(start & (kind != SPACE) & ~row_start[:n])
    solid = solid[kind[solid - 1] == SPACE]  # runs after white space
    start[solid - 1] = True
    blank = solid[code[solid - 1] == 0x20]
    start[blank] = False
    quote = np.flatnonzero(start[:-1] & (code[:-1] == 0x27) & (kind[1:] == LETTER) & ~row_start[1:n]) if n > 1 else []
    for i in quote:
        for letters in CONTRACTIONS:
            end = i + 1 + len(letters)
            if end <= n and not row_start[i + 1 : end].any() and code[i + 1 : end].tolist() == [ord(c) for c in letters]:
                start[i + 1] = False
                if end < n:
                    start[end] = True
                break
    return lead[start]


def merged_counts(symbols: np.ndarray, lengths: np.ndarray, vocabulary: dict) -> np.ndarray:
    """How many symbols are left of each sequence once every pair of the vocabulary is merged.

    All sequences lie in one ragged array. In each round every unfinished sequence merges its pair of
    lowest rank, at all places at once (from the left where they overlap).
    """
    keys, ranks, merged = vocabulary["keys"], vocabulary["ranks"], vocabulary["merged"]

    def rank_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, ranks[at], NONE)

    left_over = lengths.copy()
    live = np.flatnonzero(lengths > 1)
    keep = np.repeat(lengths > 1, lengths)
    symbols, lengths = symbols[keep], lengths[live]
    if not len(live):
        return left_over
    rank = np.full(len(symbols), NONE, np.int32)
    rank[:-1] = rank_of(symbols[:-1], symbols[1:])
    rank[np.cumsum(lengths) - 1] = NONE
    while len(live):
        firsts = np.cumsum(lengths) - lengths
        least = np.minimum.reduceat(rank, firsts)
        done = least == NONE
        if done.any():
            left_over[live[done]] = lengths[done]
            keep = np.repeat(~done, lengths)
            symbols, rank, live, lengths, least = symbols[keep], rank[keep], live[~done], lengths[~done], least[~done]
            if not len(live):
                break
        hit = rank == np.repeat(least, lengths)
        at = np.flatnonzero(hit)
        run = at.copy()
        follows = np.zeros(len(at), bool)
        follows[1:] = at[1:] == at[:-1] + 1
        if follows.any():  # runs of one symbol: every other place
            heads = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
            at = at[((run - at[heads]) & 1) == 0]
        symbols[at] = merged[rank[at]]
        gone = np.zeros(len(symbols), bool)
        gone[at + 1] = True
        owner = np.repeat(np.arange(len(lengths)), lengths)
        lengths = lengths - np.bincount(owner[at], minlength=len(lengths))
        place = at - np.arange(len(at))  # where the merged symbols stand afterwards
        rank[at] = rank[at + 1]
        symbols, rank = symbols[~gone], rank[~gone]
        last = np.zeros(len(symbols), bool)
        last[np.cumsum(lengths) - 1] = True
        first = np.zeros(len(symbols), bool)
        first[np.cumsum(lengths) - lengths] = True
        right = place[~last[place]]
        left = place[~first[place]] - 1
        for where in (right, left):
            rank[where] = rank_of(symbols[where], symbols[where + 1])
        rank[last] = NONE
    return left_over


class Counter:
    """Counts tokens of text batches; known pre-tokens are looked up by their hash."""

    def __init__(self, vocabulary: dict) -> None:
        self.vocabulary = vocabulary
        self.known, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def pre_tokens(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        first, group = arrays.grouped(hashes := arrays.span_hashes(data, starts, ends))
        own = hashes[first]
        at = np.minimum(np.searchsorted(self.known, own), max(0, len(self.known) - 1))
        found = self.known[at] == own if len(self.known) else np.zeros(len(own), bool)
        counts = np.zeros(len(own), np.int64)
        counts[found] = self.count[at[found]]
        if len(new := np.flatnonzero(~found)):
            low, size = starts[first[new]], (ends - starts)[first[new]]
            place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
            counts[new] = merged_counts(self.vocabulary["bytes"][data[place]], size, self.vocabulary)
            if len(self.known) + len(new) > REMEMBERED:
                self.known, self.count = self.known[:0], self.count[:0]
            known = np.concatenate([self.known, own[new]])
            order = np.argsort(known, kind="stable")
            self.known, self.count = known[order], np.concatenate([self.count, counts[new]])[order]
        return counts[group]

    def texts(self, column: pa.Array) -> np.ndarray:
        """Tokens of each text; special strings are one token each and part the text around them."""
        extra, owner = np.zeros(len(column), np.int64), None
        for special in self.vocabulary["special"]:
            if pc.any(pc.match_substring(column, special)).as_py():
                parts = [regex.split("|".join(map(regex.escape, self.vocabulary["special"])), t or "") for t in column.to_pylist()]
                sizes = np.array([len(p) for p in parts])
                extra, owner = sizes - 1, np.repeat(np.arange(len(parts)), sizes)
                column = pa.array([p for own in parts for p in own], pa.large_string())
                break
        data, offsets = arrays.text_bytes(column)
        found = np.zeros(len(offsets) - 1, np.int64)
        for low, high in arrays.chunks(offsets):
            own = data[offsets[low] : offsets[high]]
            at = offsets[low : high + 1] - offsets[low]
            if len(own):
                starts = pre_token_starts(own, at)
                counts = self.pre_tokens(own, starts, np.append(starts[1:], len(own)))
                found[low:high] = arrays.row_sums(counts, np.diff(np.searchsorted(starts, at)))
        return found + extra if owner is None else np.bincount(owner, found, len(extra)).astype(np.int64) + extra


def count_tokens(docs: DataFrame, tokenizer_file: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every whole text, as the tokenizer file's own library counts.

    The file (a fixed 50,000 merges) is read by the driver and sent to the workers as arrays. Work is
    per batch, without a shuffle. Null and empty texts have no bytes and no tokens; very long texts and
    words are counted whole; repeated rows give repeated results; an empty table gives none. The session then sends
    1,000 rows at most to a worker at once.
    """
    common.small_batches(docs.sparkSession)
    with open(tokenizer_file, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(f.read()))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary.value)
        for batch in batches:
            text = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            tokens = counter.texts(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(text).cast(pa.int64()), pa.array(tokens), pa.array(tokens > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        counted, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )


def query(spark, sf_dir):
    import public_tokenizers

    return count_tokens(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))

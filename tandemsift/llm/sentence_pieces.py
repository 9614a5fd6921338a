"""SentencePiece models on the tokenizers library: parsed, rebuilt, encoded in batches and held against the original."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common

#: Fixed values of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
MARK = "▁"
#: Bytes of text that are worked on at once: tokens take far more memory than their text.
CHUNK = 1 << 20
#: Bytes of distinct words that are encoded as one text, and words that a worker remembers at most.
STRETCH, KNOWN = 1 << 13, 1 << 16


@dataclass
class Spec:
    """What encoding needs of a model."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    as_suffix: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + size]
            at += size


def parse(model: bytes) -> Spec:
    """The parts of a serialised model that encoding and decoding need."""
    spec = Spec()
    for number, part in fields(model):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for k, v in fields(part):
                if k == 1:
                    piece = v.decode()
                elif k == 2:
                    score = struct.unpack("<f", v)[0]
                elif k == 3:
                    kind = v
            spec.pieces.append((piece, score, kind))
        elif number == 2:
            for k, v in fields(part):
                if k == 3:
                    spec.model_type = v
                elif k == 35:
                    spec.byte_fallback = bool(v)
                elif k == 24:
                    spec.as_suffix = bool(v)
        elif number == 3:
            for k, v in fields(part):
                if k == 2:
                    spec.charsmap = v
                elif k == 3:
                    spec.dummy_prefix = bool(v)
                elif k == 4:
                    spec.squeeze = bool(v)
                elif k == 5:
                    spec.escape = bool(v)
    if spec.model_type not in (UNIGRAM, BPE) or spec.as_suffix or not spec.escape:
        raise ValueError("only unigram and BPE models with blanks marked before words are supported")
    return spec


def rebuild(spec: Spec):
    """The same model as a tokenizers object, without special tokens in texts."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = next(i for i, (_, _, kind) in enumerate(spec.pieces) if kind == UNKNOWN)
    if spec.model_type == UNIGRAM:
        # pieces that no text may give are marked by a noncharacter; those of bytes must keep their names
        held = [(p if k in (NORMAL, USER, BYTE) else f"\uffff{p}", s) for p, s, k in spec.pieces]
        made = Tokenizer(models.Unigram(held, unknown, spec.byte_fallback))
        if spec.byte_fallback:  # so a text that spells one out is cut within it
            made.pre_tokenizer = pre_tokenizers.Split(Regex("<(?=0x[0-9A-F]{2}>)"), "isolated")
    else:
        vocab = {p: i for i, (p, _, _) in enumerate(spec.pieces)}
        usable = {p for p, _, k in spec.pieces if k in (NORMAL, USER)}
        # every way to join two pieces to a third, in the order of the third's score
        ways = sorted(
            (-score, i, vocab[piece[:k]], vocab[piece[k:]], piece[:k], piece[k:])
            for i, (piece, score, _) in enumerate(spec.pieces)
            if piece in usable
            for k in range(1, len(piece))
            if piece[:k] in usable and piece[k:] in usable
        )
        made = Tokenizer(models.BPE(vocab=vocab, merges=[w[4:] for w in ways], unk_token=spec.pieces[unknown][0], fuse_unk=True, byte_fallback=spec.byte_fallback))
    steps = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
    if spec.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    made.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    made.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if spec.dummy_prefix else [])])
    return made


def separable(spec: Spec) -> bool:
    """Whether no piece reaches over the start of a word, so that words can be encoded one by one.

    A word is a run of marks and what follows up to the next mark. Merging never joins two words if no piece
    has a mark after another character; the model alone decides. Unigram models are encoded whole, since sums
    over a whole text can round otherwise than sums over a word.
    """
    usable = {p for p, _, k in spec.pieces if k in (NORMAL, USER)}
    bytes_too = sum(k == BYTE for _, _, k in spec.pieces) == 256
    return spec.model_type == BPE and spec.byte_fallback and bytes_too and not spec.charsmap and not spec.squeeze and MARK in usable and not any(MARK in p.lstrip(MARK) for p in usable)


def gathered(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches of values that begin at starts and have so many elements, end to end."""
    firsts = np.cumsum(counts) - counts
    return values[np.repeat(starts - firsts, counts) + np.arange(int(counts.sum()))]


class Words:
    """Encodes texts by their distinct words: each is encoded once, and its ids are gathered for all places.

    Blanks stand for marks throughout. Words that were met lately are remembered.
    """

    def __init__(self, spec: Spec):
        from tokenizers import normalizers

        self.prefix = spec.dummy_prefix
        self.tokenizer = rebuild(spec)
        self.tokenizer.normalizer = normalizers.Replace(" ", MARK)
        pieces = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode() for p, _, k in spec.pieces]
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_sizes = np.array([len(p) for p in pieces], np.int64)
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.known, self.ids, self.counts = pa.array([], pa.large_binary()), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, and how many each text has."""
        data, offsets = arrays.text_bytes(texts)
        blank = data == 0x20
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        start[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(start)
        bounds = pa.py_buffer(np.append(starts, len(data)))
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(data)]), np.diff(np.searchsorted(starts, offsets))

    def learnt(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, end to end, and how many each word has."""
        data, offsets = arrays.text_bytes(words.cast(pa.large_string()))
        after_blanks = 1 + np.flatnonzero(data[offsets[1:] - 1] == 0x20)  # blanks alone, which would grow into the next word
        cuts = np.union1d([low for low, _ in arrays.chunks(offsets, STRETCH)] + [len(words)], after_blanks).astype(np.int64)
        texts = [data[offsets[a] : offsets[b]].tobytes().decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        ids = np.concatenate([np.zeros(0, np.int32), *(np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))])
        ends = np.concatenate([[0], np.cumsum(self.piece_sizes[ids])])
        at = np.searchsorted(ends, offsets)
        if not np.array_equal(ends[at], offsets):
            raise ValueError("a piece reaches over the start of a word")
        return ids, np.diff(at)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, end to end, and how many each text has."""
        texts = pc.replace_substring(texts, MARK, " ")
        words, per_text = self.split(self.prefixed(texts))
        coded = words.dictionary_encode()
        distinct, place = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        found = pc.index_in(distinct, value_set=self.known)
        new = distinct.filter(pc.is_null(found))
        ids, counts = self.learnt(new)
        all_ids, all_counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        where = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        where[where < 0] = len(self.known) + np.arange(len(new))
        if len(self.known) + len(new) <= KNOWN:
            self.known, self.ids, self.counts = pa.concat_arrays([self.known, new]), all_ids, all_counts
        elif len(new) <= KNOWN:  # the latest words are remembered instead
            self.known, self.ids, self.counts = new, ids, counts
        row = where[place]
        per_word = all_counts[row]
        return gathered(all_ids, (np.cumsum(all_counts) - all_counts)[row], per_word), arrays.row_sums(per_word, per_text)

    def prefixed(self, texts: pa.Array) -> pa.Array:
        """Texts with the blank that the model puts before them."""
        texts = texts.cast(pa.large_string())
        return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))) if self.prefix else texts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The texts of ids, prefixed, as bytes."""
        sizes = self.piece_sizes[ids]
        data = gathered(self.piece_bytes, self.piece_starts[ids], sizes)
        bounds = np.concatenate([[0], np.cumsum(arrays.row_sums(sizes, counts))])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def encode(docs: DataFrame, model_file: str, threads: int = 2, verify: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with token_ids, n_tokens, round_trip and parity.

    round_trip tells whether decoding the ids gives the text back (not so where the model itself loses
    something, as a literal mark or squeezed blanks), parity whether the original library gives the same
    ids (null without verify). The model is read by the driver and sent to the workers; each works on stretches
    of CHUNK bytes of text in `threads` threads. Where the model's pieces allow it, a stretch's distinct words are
    encoded and their ids gathered; parity and round trip are held on every whole text all the same. Nothing is
    shuffled.

    Null texts have no ids and count as empty; texts are never cut; repeated rows give repeated results; an
    empty table gives none; columns named as the results are replaced, others stay.
    """
    with open(model_file, "rb") as f:
        model = f.read()
    spec = parse(model)
    made = ["token_ids", "n_tokens", "round_trip", "parity"]
    docs = docs.drop(*made)
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model, spec))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"], os.environ["RAYON_NUM_THREADS"] = "true", str(threads)
        import sentencepiece

        words = Words(shared.value[1]) if separable(shared.value[1]) else None
        tokenizer = None if words else rebuild(shared.value[1])
        original = sentencepiece.SentencePieceProcessor(model_proto=shared.value[0]) if verify else None
        for batch in batches:
            text = pc.fill_null(batch.column(text_col), "")
            sizes = pc.binary_length(text).to_numpy(zero_copy_only=False)
            for low, high in arrays.chunks(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), CHUNK):
                part = text[low:high]
                own = part.to_pylist() if verify or not words else []
                if words:
                    flat, sizes = words.encode(part)
                    round_trip = pc.equal(words.decode(flat, sizes), words.prefixed(part).cast(pa.large_binary()))
                else:
                    ids = [e.ids for e in tokenizer.encode_batch_fast(own, add_special_tokens=False)]
                    sizes = np.array([len(x) for x in ids])
                    flat = np.concatenate([np.asarray(x, np.int32) for x in ids])
                    back = tokenizer.decode_batch(ids, skip_special_tokens=False)
                    round_trip = pa.array([a == b for a, b in zip(back, own, strict=True)])
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                same = original.encode(own, num_threads=threads) if verify else []
                parity = pa.array([flat[a:b].tolist() == x for a, b, x in zip(bounds[:-1], bounds[1:], same, strict=True)]) if verify else pa.nulls(len(part), pa.bool_())
                results = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, pa.int32())), pa.array(sizes, pa.int64()), round_trip, parity]
                yield pa.RecordBatch.from_arrays([*(c[low:high] for c in batch.columns), *results], names=[*batch.schema.names, *made])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(arrays.returning(encoded), f"{kinds}, token_ids array<int>, n_tokens long, round_trip boolean, parity boolean")


def decode(tokens: DataFrame, model_file: str, ids_col: str = "token_ids") -> DataFrame:
    """tokens with `text`, decoded from their ids.

    Null ids give null, no ids an empty text; ids outside the model are an error; repeated rows are decoded alike; an
    empty table gives none; a column named text is replaced, others stay.
    """
    with open(model_file, "rb") as f:
        shared = tokens.sparkSession.sparkContext.broadcast(parse(f.read()))
    tokens = tokens.drop("text")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = rebuild(shared.value)
        for batch in batches:
            ids = batch.column(ids_col).to_pylist()
            text = tokenizer.decode_batch([x or [] for x in ids], skip_special_tokens=False)
            column = pa.array([None if x is None else t for x, t in zip(ids, text, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "text"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema)
    return tokens.mapInArrow(arrays.returning(decoded), f"{kinds}, text string")


def query(spark, sf_dir):
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents").select("doc_id", F.col("text"))
    return encode(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")

"""SentencePiece encoding and decoding (operator 5) in vectorised merge rounds.

All distinct words of a slice of texts lie in one flat symbol array.  In each
round every word finds the least rank among its adjacent pairs (a segmented
minimum) and merges all leftmost, non-overlapping pairs of that rank at once;
merged symbols are compacted, words without a pair leave the array, until none
is left.  A merged piece that could form a pair of lower rank than its own
merges only once per word and round, so that the order is the library's.

A word is a run of the space mark U+2581 and what follows it up to the next
one.  No piece of the model has the mark behind another character, which is
checked on loading, so merges never leave a word.  Characters that no piece
has become their UTF-8 bytes.

Edge cases: a null or empty text has the end id alone and decodes to an empty
text; a literal U+2581 in a text is the space mark, as in the library; equal
rows get equal results; other columns are not read; an empty table gives an
empty result.  A word of more than LONG characters (a text without spaces) is
first cut between any two characters that stand side by side in no piece, as no
merge can cross there; its parts merge like words of their own.  A part of n
characters takes up to n rounds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridstream.llm.common import in_batches, slices, table
from gridstream.llm.token_files import ragged_take

MARK = "▁"
END_ID = 2
NONE = np.int32(2**31 - 1)         # rank where a pair has no piece
SHIFT = np.int64(21)               # symbols are below 2**21
LONG = 64                          # characters of a word that is not cut
_WORD = re.compile(f"{MARK}+[^{MARK}]*")


class PairTable:
    """(left, right) symbols -> (rank, merged symbol), by open addressing."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(keys.size * 3).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, NONE, np.int32)
        self.merged = np.zeros(size, np.int32)
        slot = self._slot(keys)
        todo = np.arange(keys.size)
        while todo.size:
            free = todo[self.keys[slot[todo]] < 0]
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.keys[slot[put]], self.ranks[slot[put]], self.merged[slot[put]] = keys[put], ranks[put], merged[put]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (left.astype(np.int64) << SHIFT) | right
        slot = self._slot(keys)
        there = self.keys[slot]
        todo = np.flatnonzero((there != keys) & (there >= 0))
        while todo.size:
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[todo]]
            todo = todo[(there != keys[todo]) & (there >= 0)]
        hit = self.keys[slot] == keys
        return np.where(hit, self.ranks[slot], NONE), self.merged[slot]


class Model:
    """Pieces of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        kinds = [(sp.is_byte(i), sp.is_control(i) or sp.is_unused(i), sp.is_unknown(i)) for i in range(self.size)]
        text = [sp.id_to_piece(i) for i in range(self.size)]
        self.pieces = {text[i]: i for i in range(self.size) if not any(kinds[i])}
        self.byte_ids = np.zeros(256, np.int32)
        self.surface = []
        for i, (is_byte, is_silent, is_unknown) in enumerate(kinds):
            if is_byte:
                self.byte_ids[int(text[i][1:-1], 16)] = i
            self.surface.append(bytes([int(text[i][1:-1], 16)]) if is_byte else b"" if is_silent else
                                " ⁇ ".encode() if is_unknown else text[i].replace(MARK, " ").encode())
        self.is_byte = np.array([k[0] for k in kinds])
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece has the space mark inside: words can't be encoded one by one")
        scores = sorted({sp.get_score(i) for i in self.pieces.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        rank = {p: rank_of[sp.get_score(i)] for p, i in self.pieces.items()}
        symbol = lambda s: self.pieces.get(s, self.size + ord(s) if len(s) == 1 else -1)
        rows = [(a << int(SHIFT) | b, rank[p], i, a, b) for p, i in self.pieces.items() for k in range(1, len(p))
                if (a := symbol(p[:k])) >= 0 and (b := symbol(p[k:])) >= 0]
        keys, ranks, merged, left, right = np.array(rows, np.int64).T
        self.pairs = PairTable(np.ascontiguousarray(keys), ranks.astype(np.int32), merged.astype(np.int32))
        # Pieces that may be part of a pair of lower rank than their own.
        own = np.full(self.size + 0x110000, NONE, np.int64)
        for p, i in self.pieces.items():
            own[i] = rank[p]
        self.once = np.zeros(self.size, dtype=bool)
        for part in (left, right):
            early = part[(ranks < own[part]) & (part < self.size)]
            self.once[early] = True
        self.chars = np.arange(0x110000, dtype=np.int32) + np.int32(self.size)
        for p, i in self.pieces.items():
            if len(p) == 1:
                self.chars[ord(p)] = i
        self.decimal = [b"%d " % i for i in range(self.size)]
        #: pairs of characters that stand side by side in a piece
        self.joined = np.unique(np.array([ord(a) << int(SHIFT) | ord(b) for p in self.pieces for a, b in zip(p, p[1:])], np.int64))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (each gets a space mark in front), and offsets."""
        marked = MARK + MARK.join(words) if words else ""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        codes = np.frombuffer(marked.encode("utf-32-le"), np.uint32)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        parts = self._parts(codes, lengths, ends)
        ids, to = self._merge(self.chars[codes], parts)
        return ids, to if parts is ends else to[np.searchsorted(parts, ends)]

    def _parts(self, codes: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Offsets of the words, and of the parts of long ones that no merge leaves."""
        long = lengths > LONG
        if not long.any():
            return ends
        inner = np.repeat(long, lengths)
        inner[ends[:-1]] = False                        # places with a character before them, in a long word
        at = np.flatnonzero(inner)
        pair = codes[at - 1].astype(np.int64) << SHIFT | codes[at]
        found = np.minimum(np.searchsorted(self.joined, pair), self.joined.size - 1)
        return np.union1d(ends, at[self.joined[found] != pair])

    def _merge(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = offsets.size - 1
        done_words, done_sizes, done_symbols = [], [], []
        word = np.arange(n)
        starts = offsets[:-1].copy()
        sizes = np.diff(offsets)
        rank, into = self._ranks(symbols, starts, sizes)
        while word.size:
            best = np.minimum.reduceat(rank, starts)
            over = best == NONE
            if over.any():
                gone = np.repeat(over, sizes)
                done_words.append(word[over])
                done_sizes.append(sizes[over])
                done_symbols.append(symbols[gone])
                stay = ~gone
                symbols, rank, into = symbols[stay], rank[stay], into[stay]
                word, sizes, best = word[~over], sizes[~over], best[~over]
                starts = np.cumsum(sizes) - sizes
                if not word.size:
                    break
            owner = np.repeat(np.arange(word.size), sizes)
            at = np.flatnonzero(rank == best[owner])
            new_run = np.ones(at.size, dtype=bool)
            new_run[1:] = np.diff(at) != 1
            run_start = np.flatnonzero(new_run)
            place = np.arange(at.size) - np.repeat(run_start, np.diff(np.append(run_start, at.size)))
            at = at[place % 2 == 0]
            first = np.ones(at.size, dtype=bool)
            first[1:] = owner[at[1:]] != owner[at[:-1]]
            at = at[first | ~self.once[into[at]]]
            symbols[at] = into[at]
            keep = np.ones(symbols.size, dtype=bool)
            keep[at + 1] = False
            sizes = sizes - np.bincount(owner[at], minlength=word.size)
            moved = (np.cumsum(keep) - 1)[at]
            symbols, rank, into = symbols[keep], rank[keep], into[keep]
            starts = np.cumsum(sizes) - sizes
            last = np.zeros(symbols.size, dtype=bool)
            last[starts + sizes - 1] = True
            touched = np.unique(np.concatenate((moved, moved[moved > 0] - 1)))
            ends = touched[last[touched]]
            touched = touched[~last[touched]]
            rank[ends] = NONE
            rank[touched], into[touched] = self.pairs.find(symbols[touched], symbols[touched + 1])
        return self._in_order(done_words, done_sizes, done_symbols, n)

    def _ranks(self, symbols, starts, sizes) -> tuple[np.ndarray, np.ndarray]:
        rank = np.full(symbols.size, NONE, np.int32)
        into = np.zeros(symbols.size, np.int32)
        if symbols.size > 1:
            rank[:-1], into[:-1] = self.pairs.find(symbols[:-1], symbols[1:])
        rank[starts + sizes - 1] = NONE
        return rank, into

    def _in_order(self, words, sizes, symbols, n) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        words, sizes, symbols = np.concatenate(words), np.concatenate(sizes), np.concatenate(symbols)
        order = np.empty(n, np.int64)
        order[words] = np.arange(n)
        symbols, to = ragged_take(symbols, np.concatenate(([0], np.cumsum(sizes))), order)
        strange = np.flatnonzero(symbols >= self.size)
        if not strange.size:
            return symbols, to
        codes, which = np.unique(symbols[strange] - self.size, return_inverse=True)
        raw = [self.byte_ids[list(chr(c).encode())] for c in codes.tolist()]
        values = np.concatenate([np.arange(self.size, dtype=np.int32), *raw])
        ends = np.cumsum([len(r) for r in raw])
        index = symbols.astype(np.int64)
        index[strange] = self.size + which
        out, place = ragged_take(values, np.concatenate((np.arange(self.size + 1), self.size + ends)), index)
        return out, place[to]

    def decode(self, ids) -> str:
        """The text of ids, as the library's decode: one space in front goes,
        bytes form characters, a byte that fits none becomes U+FFFD."""
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.surface[i]
                continue
            if run:
                out.append(_characters(bytes(run)))
                run.clear()
            if i is not None:
                out.append(self.surface[i].decode())
        text = "".join(out)
        return text[1:] if text.startswith(" ") else text


def _characters(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                if n == 4 or at + n >= len(raw):
                    out.append("�")
                    at += 1
                    break
    return "".join(out)


@lru_cache(maxsize=2)
def model_of(path: str) -> Model:
    return Model(path)


def split_words(text: str) -> list[str]:
    """The words of a text, each without its first space mark."""
    if not text:
        return []
    words = text.split(" ")
    if "" in words or MARK in text:
        return [w[1:] for w in _WORD.findall(MARK + text.replace(" ", MARK))]
    return words


def encode_texts(model: Model, texts: list) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words' ids and offsets, the word of each place, and the texts' word offsets."""
    words, counts = [], np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        own = split_words(t or "")
        counts[i + 1] = len(own)
        words.extend(own)
    coded = pa.array(words, pa.large_string()).dictionary_encode()
    ids, offsets = model.encode_words(coded.dictionary.to_pylist())
    return ids, offsets, coded.indices.to_numpy(), np.cumsum(counts)


def encode(model: Model, texts: list, end_id: int = END_ID) -> list[list[int]]:
    ids, offsets, index, first = encode_texts(model, texts)
    out, to = ragged_take(ids, offsets, index)
    cut = to[first]
    return [[*out[a:b].tolist(), end_id] for a, b in zip(cut[:-1], cut[1:])]


def _digests(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        end = b"%d" % end_id
        for part in slices(batches):
            ids, offsets, index, first = encode_texts(model, part["text"].to_pylist())
            flat, cut = ids.tolist(), offsets.tolist()
            decimal = [b"".join([model.decimal[i] for i in flat[a:b]]) for a, b in zip(cut[:-1], cut[1:])]
            surface = [b"".join([model.surface[i] for i in flat[a:b]]) for a, b in zip(cut[:-1], cut[1:])]
            sizes = np.diff(offsets)
            upto = np.concatenate(([0], np.cumsum(sizes[index])))[first]
            n_tokens, ids_hash, text_hash = np.diff(upto) + 1, [], []
            places = index.tolist()
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                own = places[a:b]
                ids_hash.append(hashlib.sha256(b"".join([decimal[i] for i in own]) + end).hexdigest())
                raw = b"".join([surface[i] for i in own])
                text_hash.append(hashlib.sha256(raw[1:]).hexdigest())
            yield pa.RecordBatch.from_arrays([part["doc_id"].combine_chunks(), pa.array(n_tokens, pa.int64()), pa.array(ids_hash, pa.string()),
                                              pa.array(text_hash, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _encode_rows(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for part in slices(batches):
            ids, offsets, index, first = encode_texts(model, part["text"].to_pylist())
            ends = np.append(ids, np.int32(end_id))
            index = np.insert(index.astype(np.int64), first[1:], offsets.size - 1)
            out, to = ragged_take(ends, np.append(offsets, offsets[-1] + 1), index)
            cut = to[first + np.arange(first.size)].astype(np.int32)
            yield pa.RecordBatch.from_arrays([part["doc_id"].combine_chunks(), pa.ListArray.from_arrays(pa.array(cut), pa.array(out))],
                                             ["doc_id", "ids"])
    return run


def encoded(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids) of every text."""
    return in_batches(docs.select("doc_id", "text"), _encode_rows(path, end_id), "doc_id long, ids array<int>")


def digests(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Counts and digests of the ids and of the text decoded from them."""
    return in_batches(docs.select("doc_id", "text"),
        _digests(path, end_id), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: every document's ids, counted and digested."""
    import public_tokenizers
    return digests(docs, public_tokenizers.path("piece_bpe_32k.model"))

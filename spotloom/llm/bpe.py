"""Byte-level BPE encoding and decoding over whole texts.

A text is cut by the tokenizer's pattern and every match is encoded on its own. Distinct
matches are encoded in bulk: matches of one length class form a padded numpy matrix of token
ids; every round each row merges its leftmost pair of least rank, the row is compacted, and
rows without a mergeable pair leave. Pair ranks come from an open-addressing hash table of
(left id, right id). Matches above ``LONG`` bytes, rare in prose but without any bound in
junk, follow the same rule with a heap over linked positions, in n log n steps.

Encoded matches are kept in a cache for each Python worker, bounded by their number and bytes;
those of the texts at hand, about a million characters, are always in it.

Defined cases: a null text is the empty text, with no tokens; texts are encoded without
special tokens, whose strings are ordinary text; an empty table gives an empty result; null
ids and repeated rows are returned as they are; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Bytes above which a match is merged with a heap.
LONG = 64
#: Matches kept by one Python worker; beyond, the cache starts anew.
CACHE = 400_000
#: Bytes of these matches, which long runs without spaces reach first.
CACHE_BYTES = 64 << 20
NONE = np.int32(2**31 - 1)


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of lines with a base64 token and its rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class PairTable:
    """(left id, right id) -> merged id, by linear probing over a power-of-two table."""

    MULT = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int32)
        left, at, self.probes = np.arange(len(keys)), self._home(keys), 0
        while len(left):
            self.probes += 1
            free = self.keys[at] < 0
            won, first = np.unique(at[free], return_index=True)
            rows = left[free][first]
            self.keys[won], self.values[won] = keys[rows], values[rows]
            stay = self.keys[at] != keys[left]
            left, at = left[stay], (at[stay] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * self.MULT) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, ``NONE`` where the pair has none or either id is negative."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        out = np.full(keys.shape, NONE, np.int32).ravel()
        todo = np.flatnonzero(((left >= 0) & (right >= 0)).ravel())
        keys = keys.ravel()[todo]
        at = self._home(keys)
        for _ in range(self.probes):
            held = self.keys[at]
            hit = held == keys
            out[todo[hit]] = self.values[at[hit]]
            on = ~hit & (held >= 0)
            if not on.any():
                break
            todo, keys, at = todo[on], keys[on], (at[on] + 1) & self.mask
        return out.reshape(left.shape)


def _room(a: np.ndarray, n: int) -> np.ndarray:
    """The array with room for n values at least."""
    return a if n <= len(a) else np.concatenate((a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)))


class Codec:
    """Encoder and decoder for one rank table and pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self.table = PairTable(np.array(keys, np.int64), np.array(values, np.int32))
        self.pairs = None
        self.forget()

    def _matrix(self, parts: list[bytes], width: int) -> list[np.ndarray]:
        n = len(parts)
        lengths = np.fromiter(map(len, parts), np.int64, n)
        ids = np.full((n, width), -1, np.int32)
        inside = np.arange(width) < lengths[:, None]
        ids[inside] = self.byte_id[np.frombuffer(b"".join(parts), np.uint8)]
        rank = self.table.get(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((n, 0), NONE)
        out: list[np.ndarray] = [None] * n
        rows = np.arange(n)

        def leave(gone: np.ndarray) -> None:
            flat, size = ids[gone], lengths[gone]
            for row, got, k in zip(rows[gone].tolist(), flat, size.tolist(), strict=True):
                out[row] = got[:k]

        while len(rows):
            if rank.shape[1] == 0:
                leave(np.arange(len(rows)))
                break
            at = rank.argmin(1)
            best = rank[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                leave(np.flatnonzero(done))
                go = ~done
                ids, rank, lengths, rows, at, best = ids[go], rank[go], lengths[go], rows[go], at[go], best[go]
                if not len(rows):
                    break
            # Compaction: what is right of the merged pair moves one to the left.
            k, span = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            ids[k, at] = best
            moved = np.where(span <= at[:, None], ids[:, :-1], ids[:, 1:])
            lengths = lengths - 1
            most = int(lengths.max())
            moved = moved[:, :most]
            shifted = np.where(span[:-1] < at[:, None], rank[:, :-1], rank[:, 1:])[:, : max(0, most - 1)]
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at + 1 < lengths)
            if len(left):
                shifted[left, at[left] - 1] = self.table.get(moved[left, at[left] - 1], moved[left, at[left]])
            if len(right):
                shifted[right, at[right]] = self.table.get(moved[right, at[right]], moved[right, at[right] + 1])
            ids, rank = np.ascontiguousarray(moved), np.ascontiguousarray(shifted)
        return out

    def _heap(self, part: bytes) -> np.ndarray:
        """Leftmost least-rank merges of one long match."""
        if self.pairs is None:
            used = self.table.keys >= 0
            self.pairs = dict(zip(self.table.keys[used].tolist(), self.table.values[used].tolist(), strict=True))
        get = self.pairs.get
        ids = self.byte_id[np.frombuffer(part, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (s := get(r << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (s, i, r, ids[k]))
            if (h := before[i]) >= 0 and (s := get(ids[h] << 32 | r)) is not None:
                heapq.heappush(heap, (s, h, ids[h], r))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_parts(self, parts: list[bytes]) -> list[np.ndarray]:
        """Token ids of each match, by length class."""
        out: list[np.ndarray] = [None] * len(parts)
        classes: dict[int, list[int]] = {}
        for k, part in enumerate(parts):
            size = len(part)
            if size > LONG:
                out[k] = self._heap(part)
            else:
                classes.setdefault(size if size <= 16 else -(-size // 8) * 8, []).append(k)
        for width, members in classes.items():
            for at in range(0, len(members), 16384):
                some = members[at : at + 16384]
                for k, got in zip(some, self._matrix([parts[i] for i in some], width), strict=True):
                    out[k] = got
        return out

    def forget(self) -> None:
        """Empty the cache: match -> row of a ragged array of ids."""
        self.cache: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.at = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = self.held = 0

    def learn(self, texts: list[list[str]]) -> None:
        """Encode the matches that the cache lacks."""
        own = set().union(*texts)
        new = list(own.difference(self.cache))
        more = sum(map(len, new))
        if self.cache and (len(self.cache) + len(new) > CACHE or self.held + more > CACHE_BYTES):
            self.forget()
            new = list(own)
            more = sum(map(len, new))
        self.held += more
        ids = self.encode_parts([p.encode() for p in new])
        first, sizes = len(self.cache), np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(sizes.sum())
        self.flat = _room(self.flat, self.used + total)
        self.at, self.size = _room(self.at, first + len(new)), _room(self.size, first + len(new))
        if new:
            self.flat[self.used : self.used + total] = np.concatenate(ids)
            self.size[first : first + len(new)] = sizes
            self.at[first : first + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.cache.update(zip(new, range(first, first + len(new)), strict=True))
            self.used += total

    def lookup(self, parts: list[str]) -> np.ndarray:
        """The ids of learnt matches, in order."""
        rows = np.fromiter(map(self.cache.__getitem__, parts), np.int64, len(parts))
        if not len(rows):
            return np.zeros(0, np.int32)
        n = self.size[rows]
        ends = np.cumsum(n)
        return self.flat[np.arange(ends[-1]) + np.repeat(self.at[rows] - ends + n, n)]

    def encode(self, text: str) -> np.ndarray:
        """The token ids of one text."""
        return next(_encode(self, [text]))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of token ids: one ragged gather from the token bytes."""
        n = self.lengths[ids]
        if not len(n):
            return b""
        ends = np.cumsum(n)
        return self.bytes[np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + n, n)].tobytes()


#: Characters of text that are cut into matches at once.
CHUNK = 1 << 20


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Parts of a long text, cut before a space that follows another character than white space.

    No match of the pattern reaches over such a place: only runs of white space hold a space
    other than as their first character.
    """
    at = 0
    while len(text) - at > size:
        to = at + size
        while (to := text.find(" ", to)) > 0 and text[to - 1].isspace():
            to += 1
        if to < 0:
            break
        yield text[at:to]
        at = to
    yield text[at:]


def _encode(coder: Codec, texts: list[str]) -> Iterator[np.ndarray]:
    """The ids of each text; matches of about ``CHUNK`` characters are encoded together."""
    held, size = [], 0
    for text in texts:
        if size + len(text) > CHUNK and held:
            yield from _together(coder, held)
            held, size = [], 0
        if len(text) > CHUNK:
            yield np.concatenate([x for part in chunks(text) for x in _together(coder, [part])])
        else:
            held.append(text)
            size += len(text)
    yield from _together(coder, held)


def _together(coder: Codec, texts: list[str]) -> Iterator[np.ndarray]:
    parts = list(map(coder.pattern.findall, texts))
    coder.learn(parts)
    for own in parts:
        yield coder.lookup(own)


def _coder(ranks: bytes, pattern: str) -> Codec:
    """This worker process's codec, built once for each rank table and pattern."""
    state = sys.modules.setdefault("spotloom_worker_state", types.ModuleType("spotloom_worker_state"))
    key = hash((ranks, pattern))
    if getattr(state, "key", None) != key:
        state.key, state.codec = key, Codec(parse_ranks(ranks), pattern)
    return state.codec


def _ragged(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.array([], np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def transcode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """(doc_id, ids array<int>[, decoded binary]): every text encoded, and the ids decoded again."""
    table = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary: its size doesn't follow the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(table.value, pattern)
        for b in slices(batches, 256):
            ids, back, names, size = [], [], b.column(0), 0
            done = 0
            for got in _encode(coder, b.column(1).to_pylist()):
                ids.append(got)
                if decode:
                    back.append(coder.decode(got))
                size += len(got)
                if size > 1 << 20:
                    yield put(names.slice(done, len(ids)), ids, back)
                    done, ids, back, size = done + len(ids), [], [], 0
            if ids:
                yield put(names.slice(done, len(ids)), ids, back)

    def put(names: pa.Array, ids: list[np.ndarray], back: list[bytes]) -> pa.RecordBatch:
        cols = {"doc_id": names, "ids": _ragged(ids, pa.int32())} | ({"decoded": pa.array(back, pa.binary())} if decode else {})
        return pa.RecordBatch.from_pydict(cols)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")).mapInArrow(run, "doc_id bigint, ids array<int>" + ", decoded binary" * decode)


def decode_ids(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """(doc_id, decoded binary) of (doc_id, ids array<int>)."""
    table = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(table.value, pattern)
        for b in slices(batches, 256):
            back = [coder.decode(np.array(x or [], np.int32)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(back, pa.binary())], ["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, "doc_id bigint, decoded binary")


def digests(transcoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what ``transcode`` gives."""
    text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return transcoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(text, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def bundled(name: str = "byte_bpe_50k.tiktoken") -> tuple[bytes, str]:
    """Rank file and pattern of an installed public vocabulary."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN

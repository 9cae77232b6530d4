"""Byte-level BPE by corpus-level merge replay, and decoding.

A text is cut into words by the pre-tokeniser's pattern. The distinct words of
a block of documents form the corpus of a replay: an inverted index leads from
each pair's rank to the positions where the pair stands, in all words at once.
Ranks are taken in ascending order; a rank's merge is applied at all of its
positions, and only the pairs to the left and right of the merged places are
looked up again and entered in the index. Every word is replayed once per
block and worker; the documents' ids are then put together from their words.

Blocks are consecutive documents of a task, so nothing is shuffled, and a lost
executor costs only its tasks. A block's memory is bounded by ``block_chars``
plus one document; the words kept between blocks by ``KEPT_WORDS``, of which
the most used ones stay when they become too many.

If a merge makes a pair of a lower rank than its own, the order inside that
word is no longer that of the ranks; such words are encoded one merge at a
time instead (``one_by_one``), so the ids always equal the library's.

Defined results: a null text counts as empty (no ids); special tokens' strings
are ordinary text; repeated rows each get a row; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"
BLOCK_CHARS = 2_000_000
#: Distinct words whose ids a worker keeps for later blocks; beyond, the most used ``STAYING`` of them stay.
KEPT_WORDS, STAYING = 120_000, 40_000
NONE = np.int32(2**31 - 1)


def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class MergeReplay:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.base = np.int64(max(ranks.values()) + 1)
        codes = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    codes[a * int(self.base) + b] = rank
        self.codes = np.array(sorted(codes), dtype=np.int64)
        self.code_ranks = np.array([codes[c] for c in self.codes.tolist()], dtype=np.int32)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a.astype(np.int64) * self.base + b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.code_ranks[at], NONE)

    def one_by_one(self, word: bytes) -> list[int]:
        """The lowest rank, leftmost first, one merge at a time, by a heap over a linked list."""
        sym = [int(self.byte_ids[b]) for b in word]
        nxt, prv = list(range(1, len(sym))) + [-1], list(range(-1, len(sym) - 1))

        def rank(i):
            return self.ranks.get(self.tokens[sym[i]] + self.tokens[sym[nxt[i]]]) if sym[i] >= 0 and nxt[i] >= 0 else None

        heap = [(r, i) for i in range(len(sym)) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if rank(i) != r:
                continue
            j = nxt[i]
            sym[i], sym[j], nxt[i] = r, -1, nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            for k in (prv[i], i):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(heap, (r, k))
        return [x for x in sym if x >= 0]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids behind one another, and each word's number of ids. No word is empty."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        sym = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        n = len(sym)
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        last = np.cumsum(size) - 1
        nxt, prv = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        nxt[last], prv[last - size + 1] = -1, -1
        rank = np.full(n, NONE, dtype=np.int32)
        at = np.flatnonzero(nxt >= 0)
        rank[at] = self.pair_ranks(sym[at], sym[at + 1])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(places: np.ndarray) -> None:
            """Into the index, by rank."""
            r = rank[places]
            order = np.argsort(r, kind="stable")
            places, r = places[order], r[order]
            cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
            for k, part in zip(r[np.r_[0, cuts]].tolist(), np.split(places, cuts)):
                if k in index:
                    index[k].append(part)
                else:
                    index[k] = [part]
                    heapq.heappush(heap, k)

        at = at[rank[at] != NONE]
        if len(at):
            enter(at)
        odd: list[np.ndarray] = []
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[rank[at] == r]
            if not len(at):
                continue
            right = nxt[at]
            if len(at) > 1 and (chained := right[:-1] == at[1:]).any():  # as in "aaa": every second place
                start = np.r_[True, ~chained]
                step = np.arange(len(at)) - np.flatnonzero(start)[np.cumsum(start) - 1]
                at, right = at[step % 2 == 0], right[step % 2 == 0]
            after = nxt[right]
            sym[at], nxt[at], sym[right], rank[right] = r, after, -1, NONE
            follows = after >= 0
            prv[after[follows]] = at[follows]
            rank[at] = NONE
            before = prv[at]
            near = np.concatenate([at[follows], before[before >= 0]])
            if not len(near):
                continue
            new = self.pair_ranks(sym[near], sym[nxt[near]])
            rank[near] = new
            known = new != NONE
            if known.any():
                near, new = near[known], new[known]
                if new.min() <= r:
                    odd.append(word[near[new <= r]])
                enter(near)
        live = sym >= 0
        ids, count = sym[live], np.bincount(word[live], minlength=len(words))
        whole = {i: [self.ranks[w]] for i, w in enumerate(words) if w in self.ranks}
        for i in np.unique(np.concatenate(odd)).tolist() if odd else ():
            whole.setdefault(i, self.one_by_one(words[i]))
        first = np.cumsum(count) - count
        whole = {i: x for i, x in whole.items() if count[i] != len(x) or ids[first[i]:first[i] + len(x)].tolist() != x}
        if whole:
            parts = np.split(ids, first[1:])
            for i, x in whole.items():
                parts[i] = np.array(x, dtype=np.int32)
                count[i] = len(x)
            ids = np.concatenate(parts)
        return ids, count


class Encoder:
    """Encodes blocks of texts; keeps the ids of words seen before."""

    def __init__(self, path: str, pattern: str, kept_words: int = KEPT_WORDS):
        import regex

        self.replay = MergeReplay(vocabulary(path))
        self.words = regex.compile(pattern)
        self.kept = kept_words
        self.clear()

    def clear(self) -> None:
        self.vocab: dict[str, int] = defaultdict()
        self.vocab.default_factory = self.vocab.__len__
        self.ids, self.first, self.count, self.used = (np.zeros(0, t) for t in (np.int32, np.int64, np.int32, np.int64))

    def shrink(self, staying: int) -> None:
        """Forget all words but those used most."""
        order = np.sort(np.argsort(-self.used, kind="stable")[:staying])
        words, ids, first, count, used = list(self.vocab), self.ids, self.first[order], self.count[order], self.used[order]
        self.clear()
        for i in order.tolist():
            self.vocab[words[i]]
        self.first, self.count, self.used = np.cumsum(count) - count, count, used
        self.ids = ids[np.arange(int(count.sum())) + np.repeat(first - self.first, count)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids behind one another, and each text's number of ids."""
        if len(self.vocab) > self.kept:
            self.shrink(min(self.kept, STAYING))
        known = len(self.vocab)
        number = self.vocab.__getitem__
        docs = [np.fromiter(map(number, self.words.findall(t)), dtype=np.int32) for t in texts]
        new = [w.encode() for w in list(self.vocab)[known:]]
        if new:
            ids, count = self.replay.replay(new)
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])
            self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count.astype(np.int32)])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])
        out = []
        for d in docs:
            np.add.at(self.used, d, 1)
            n = self.count[d].astype(np.int64)
            ends = np.cumsum(n)
            out.append(self.ids[np.arange(ends[-1] if len(n) else 0) + np.repeat(self.first[d] - (ends - n), n)])
        return np.concatenate(out) if out else np.zeros(0, np.int32), np.array([len(x) for x in out], dtype=np.int64)


@lru_cache(maxsize=2)
def encoder(path: str | None, pattern: str | None) -> Encoder:
    import public_tokenizers

    return Encoder(path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN)


@lru_cache(maxsize=2)
def token_bytes(path: str | None) -> list[bytes]:
    import public_tokenizers

    tokens = {i: t for t, i in vocabulary(path or public_tokenizers.path(RANKS)).items()}
    return [tokens.get(i, b"") for i in range(max(tokens) + 1)]


def blocks(texts, chars: int):
    """Consecutive texts of about so many characters together."""
    block, size = [], 0
    for t in texts:
        block.append(t)
        size += len(t)
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def decoded(ids: np.ndarray, offsets: np.ndarray, token) -> pa.Array:
    """The bytes of consecutive runs of ids."""
    return pa.array((b"".join(map(token, ids[i:j].tolist())) for i, j in zip(offsets, offsets[1:])), pa.binary())


def schema_of(rows: DataFrame, cols: list[str], more: str) -> str:
    return ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in cols), more])


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), path: str | None = None,
           pattern: str | None = None, block_chars: int = BLOCK_CHARS, back: bool = False) -> DataFrame:
    """key, the columns of ``keep`` and ids (array of int) of every row; one pass without a shuffle.

    ``back``: also decode the ids, as ``decode`` does, in the same pass and worker.
    """
    cols = [key, *keep]
    rows = df.select(*cols, F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def run(batches):
        e = encoder(path, pattern)
        for b in batches:
            done = 0
            for block in blocks((t.as_py() for t in b.column(len(cols))), block_chars):
                ids, n = e.encode(block)
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                out = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))]
                if back:
                    out.append(decoded(ids, offsets, token_bytes(path).__getitem__))
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(done, len(block)) for i in range(len(cols))), *out],
                                                 names=[*cols, "ids", "decoded"][:len(cols) + len(out)])
                done += len(block)

    return rows.mapInArrow(run, schema_of(rows, cols, "ids array<int>" + ", decoded binary" * back))


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """key, the columns of ``keep``, ids and the decoded bytes (null ids: none) of every row."""
    cols = [key, *keep]
    rows = df.select(*cols, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))

    def run(batches):
        token = token_bytes(path).__getitem__
        for b in batches:
            ids = b.column(len(cols))
            out = decoded(ids.values.to_numpy(), ids.offsets.to_numpy(), token)
            yield pa.RecordBatch.from_arrays([*b.columns, out], names=[*cols, "ids", "decoded"])

    return rows.mapInArrow(run, schema_of(rows, cols, "ids array<int>, decoded binary"))


def op9_bpe(spark, sf_dir):
    """Encode and decode all documents, as digests."""
    out = encode(table(spark, sf_dir, "documents", "doc_id", "text"), back=True)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))

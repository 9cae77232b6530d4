"""Token counts of whole texts by overlap resynchronisation.

A text of at most ``chunk_chars`` characters is encoded at once. A longer one
is encoded in chunks that start anywhere and reach ``overlap`` characters into
the next one, with the offsets of their tokens. Two neighbours are spliced at
a boundary inside the overlap that both encodings have and that is proven
stable. If the overlap holds none, the overlap is doubled, up to the rest of
the text, so the count is always that of the whole text.

Why a boundary is proven: pieces are built by merging neighbours, so a merge
across the gap between characters x and y needs a piece of the vocabulary that
holds x directly followed by y. If no piece does, nothing ever merges across
the gap, and the merges on either side never see each other. The set of all
such pairs in the vocabulary is read from the model.

Defined results: a null text counts as empty (0 tokens, 0 bytes); repeated
rows each get a row; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import table

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
CHUNK_CHARS = 20_000
OVERLAP = 256
SPACE = "▁"


class Counter:
    """Counts tokens as the library gives them for the whole text."""

    def __init__(self, model_file: str, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        spec = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        #: Only a normaliser that maps each character for itself lets a chunk start anywhere.
        self.local = not norm.precompiled_charsmap and not norm.remove_extra_whitespaces and norm.escape_whitespaces
        self.local = self.local and spec.trainer_spec.model_type == spec.trainer_spec.BPE
        self.pairs = {a + b for p in spec.pieces if p.type in (1, 4) for a, b in zip(p.piece, p.piece[1:])}
        self.chunk, self.overlap = chunk_chars, overlap

    def stable(self, text: str, at: int) -> bool:
        """No piece can cover the gap before ``text[at]``."""
        pair = text[at - 1:at + 1].replace(" ", SPACE)
        return pair not in self.pairs

    def starts(self, text: str) -> list[int]:
        """Offsets (in characters of ``text``) at which the tokens of ``text`` start; the library tells bytes."""
        code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        begins = [p.begin for p in self.sp.encode(text, return_type="proto").pieces]
        return np.searchsorted(ends, begins, side="right").tolist()

    def splice(self, text: str, lo: int, hi: int, left: list[int], right: list[int]) -> int | None:
        """The first stable boundary in (lo, hi) that both encodings have."""
        common = {x for x in left if lo < x < hi}.intersection(right)
        return next((x for x in sorted(common) if self.stable(text, x)), None)

    def count(self, text: str) -> int:
        if len(text) <= self.chunk or not self.local:
            return len(self.sp.encode(text, num_threads=1))
        total, done, start = 0, 0, 0  # tokens before ``done`` are counted; the chunk begins at ``start``
        while True:
            overlap, end = self.overlap, start + self.chunk
            while True:
                if end + overlap >= len(text):
                    return total + sum(start + x >= done for x in self.starts(text[start:]))
                left = [start + x for x in self.starts(text[start:end + overlap])]
                nxt = max(start + 1, end)
                right = [nxt + x for x in self.starts(text[nxt:end + 2 * overlap])]
                at = self.splice(text, nxt, end + overlap - 1, left, right)
                if at is not None:
                    break
                overlap *= 2
            total += sum(done <= x < at for x in left)
            done, start = at, nxt

    def counts(self, texts: list[str]) -> list[int]:
        short = [i for i, t in enumerate(texts) if len(t) <= self.chunk]
        out = [0] * len(texts)
        for i, ids in zip(short, self.sp.encode([texts[i] for i in short], num_threads=1) if short else []):
            out[i] = len(ids)
        for i, t in enumerate(texts):
            if len(t) > self.chunk:
                out[i] = self.count(t)
        return out


@lru_cache(maxsize=4)
def counter(model_file: str, chunk_chars: int, overlap: int) -> Counter:
    return Counter(model_file, chunk_chars, overlap)


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", model_file: str | None = None,
                 limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """key, n_bytes, n_tokens and over_limit of every row; one pass without a shuffle.

    ``model_file`` is a path that every executor can open; by default the
    installed public model.
    """
    rows = df.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches):
        if model_file is None:
            import public_tokenizers
            path = public_tokenizers.path(MODEL)
        else:
            path = model_file
        c = counter(path, chunk_chars, overlap)
        for b in batches:
            texts = b.column(1).to_pylist()
            n = c.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], names=[key, "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op3_token_counts(spark, sf_dir):
    """Token counts of all documents."""
    return count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"))

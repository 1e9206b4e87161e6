"""Byte-level BPE by monoid tree reduction.

The encodings of byte strings form a monoid: ``join(encode(a), encode(b)) ==
encode(a + b)``. A piece is cut in two, both halves are encoded recursively, and the two
token lists are joined by re-encoding a window around the seam. A token list is the
encoding of its bytes exactly if each two neighbours are, by themselves, the encoding
of their own bytes (:meth:`Ranks.stable`); so once the window's new outer tokens are
stable with the untouched tokens beside them, nothing further out can change. Until
then the window doubles. Decoding concatenates the tokens' bytes up the same tree.

Pieces are the matches of a pattern over the whole text; a piece's encoding is kept in
a bounded cache of the worker. Defined results: a null or empty text has no tokens and
decodes to no bytes; ids outside the vocabulary raise ``KeyError`` when decoded.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Interned, batches

LEAF = 16  # bytes up to which a part of a piece is merged directly
SHORT = 48  # bytes up to which a list beats a heap
BATCH = 64  # documents handled at a time: bounds the memory of long texts


class Ranks:
    """Merge ranks of a byte-level vocabulary, with the tree encoder over them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self._stable = Interned(self._is_stable, 500_000)
        self._merged = Interned(self.merge, 500_000)  # leaves and windows of at most SHORT bytes

    @classmethod
    def load(cls, path: str) -> Ranks:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())})

    def merge(self, raw: bytes) -> list[int]:
        """Direct merging: always the lowest rank, leftmost first."""
        ranks = self.ranks
        if raw in ranks:
            return [ranks[raw]]
        if len(raw) > SHORT:
            return self._merge_long(raw)
        at, none = list(range(len(raw) + 1)), len(ranks) + 1
        pairs = [ranks.get(raw[i:i + 2], none) for i in range(len(raw) - 1)]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            del at[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(raw[at[i]:at[i + 2]], none)
            if i:
                pairs[i - 1] = ranks.get(raw[at[i - 1]:at[i + 1]], none)
        return [ranks[raw[a:b]] for a, b in zip(at, at[1:])]

    def _merge_long(self, raw: bytes) -> list[int]:
        """The same with a heap over linked neighbours."""
        ranks, n = self.ranks, len(raw)
        end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends
        before, alive = list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= stop:
                continue
            j = end[i]
            if j >= n or end[j] != stop:
                continue  # one of the two parts has grown since
            alive[j], end[i] = False, stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(raw[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            h = before[i]
            if h >= 0 and (r := ranks.get(raw[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i:end[i]]])
            i = end[i]
        return out

    def _is_stable(self, pair: tuple[int, int]) -> bool:
        return self.merge(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]) == list(pair)

    def stable(self, a: int, b: int) -> bool:
        return self._stable[a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring byte strings from theirs."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        k = 1
        while True:
            k = min(2 * k, max(len(left), len(right)))
            a, b = max(0, len(left) - k), min(len(right), k)
            seam = self.decode(left[a:]) + self.decode(right[:b])
            window = self._merged[seam] if len(seam) <= SHORT else self.merge(seam)
            if (a == 0 or self.stable(left[a - 1], window[0])) and \
                    (b == len(right) or self.stable(window[-1], right[b])):
                return left[:a] + window + right[b:]

    def encode(self, raw: bytes) -> list[int]:
        """Tree reduction of one piece: halves (the left one a power of two long), then the join."""
        if len(raw) <= LEAF:
            return self._merged[raw] if raw else []
        cut = 1 << ((len(raw) - 1).bit_length() - 1)
        return self.join(self.encode(raw[:cut]), self.encode(raw[cut:]))

    def decode(self, ids: Sequence[int]) -> bytes:
        """Bytes of the ids, concatenated up the tree (runs of leaves at once)."""
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        cut = len(ids) // 2
        return self.decode(ids[:cut]) + self.decode(ids[cut:])


class Codec:
    """Encodes texts in a task; the vocabulary is read there once, from a file every worker has."""

    def __init__(self, path: str, pattern: str):
        self.path, self.pattern, self.ready = path, pattern, None

    def __getstate__(self):
        return {"path": self.path, "pattern": self.pattern, "ready": None}

    def open(self):
        if self.ready is None:
            import regex

            ranks = Ranks.load(self.path)
            pack = lambda piece: np.fromiter(ranks.encode(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()
            self.ready = ranks, regex.compile(self.pattern), Interned(pack, 1_000_000)
        return self.ready

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        _, pattern, cache = self.open()
        return b"".join([cache[p] for p in pattern.findall(text or "")])

    def decode(self, ids: bytes) -> bytes:
        return self.open()[0].decode(np.frombuffer(ids, "<u4").tolist())

    def digests(self, text: str | None) -> tuple[int, str, str]:
        ids = self.encode(text)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


_OPEN: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a vocabulary (one per process, its cache serves all batches)."""
    return _OPEN.setdefault((path, pattern), Codec(path, pattern))


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add the token ids of each whole text as ``array<int>``."""
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids_of(texts: pd.Series) -> pd.Series:
        own = codec(path, pattern)
        return pd.Series([np.frombuffer(own.encode(t), "<u4").astype(np.int32) for t in texts], dtype=object)
    return docs.withColumn(into, ids_of(F.col(text)))


def decode_ids(docs: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for."""
    @F.pandas_udf(T.BinaryType())
    def bytes_of(lists: pd.Series) -> pd.Series:
        own = codec(path, "")
        return pd.Series([own.open()[0].decode([] if x is None else np.asarray(x).tolist()) for x in lists], dtype=object)
    return docs.withColumn(into, bytes_of(F.col(ids)))


def token_digests(docs: DataFrame, path: str, pattern: str, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys`` with the number of tokens and the digests of ids and decoded bytes of each text.

    Encoding and decoding happen in one pass, so no id list leaves the task.
    """
    keep = list(keys)
    schema = T.StructType([*[docs.schema[k] for k in keep], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(frames):
        own = codec(path, pattern)
        for pdf in batches(frames, BATCH):
            out = pdf[keep].copy()
            rows = [own.digests(t) for t in pdf[text]]
            for i, name in enumerate(("n_tokens", "ids_sha256", "decoded_sha256")):
                out[name] = [r[i] for r in rows]
            yield out

    return docs.select(*keep, text).mapInPandas(run, schema)

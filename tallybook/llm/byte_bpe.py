"""Operator 4: byte-level BPE encoding and decoding, by a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary's byte strings gives a
pre-token's slot; one comparison with the string kept there tells whether the
whole pre-token is a token. Tier two: the misses are merged by rank with a
heap over a doubly linked list of parts. A worker looks a distinct pre-token up
once while it remembers it (``max_known`` bounds memory and changes no result).

The encoding equals that of a tiktoken encoder without special tokens: each
match of the pattern is encoded on its own. Decoding maps ids back to bytes.
Null text: no tokens. Null and repeated doc_ids are encoded like any other
row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm.common import documents, held, id_text, sha, tidy
from tallybook.llm.perfect_hash import PerfectHash


def read_ranks(path: str | None = None) -> dict[bytes, int]:
    """Token bytes and their ranks of a tiktoken file."""
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Ranks behind a minimal perfect hash, and their inverse."""

    def __init__(self, ranks: dict[bytes, int]):
        keys = np.fromiter(map(xxhash.xxh3_64_intdigest, ranks), np.uint64, len(ranks))
        self.hash = PerfectHash.build(keys)
        self.slot = self.hash.finder()
        self.at: list[tuple[bytes, int]] = [(b"", -1)] * len(ranks)
        for slot, item in zip(self.hash.lookup(keys).tolist(), ranks.items()):
            self.at[slot] = item
        self.bytes = {rank: token for token, rank in ranks.items()}

    def whole(self, piece: bytes) -> int:
        """The rank of a piece, -1 if it is not in the vocabulary."""
        token, rank = self.at[self.slot(xxhash.xxh3_64_intdigest(piece))]
        return rank if token == piece else -1


def merge(piece: bytes, ranks: dict[bytes, int], pairs: list[int]) -> list[int]:
    """Ids of a piece: the adjacent pair of lowest rank is merged, leftmost
    first, until no pair is in the vocabulary. O(n log n): parts are linked by
    position, and a heap entry (rank, start, end) is stale if either part has
    changed. ``pairs``: ranks of two bytes, -1 for none.
    """
    n = len(piece)
    end = list(range(1, n + 1))  # end[k]: where the part that starts at k ends; 0: merged away
    before = list(range(-1, n - 1))
    heap = [(r, k, k + 2) for k, (a, b) in enumerate(zip(piece, piece[1:])) if (r := pairs[a << 8 | b]) >= 0]
    heapify(heap)
    get = ranks.get
    while heap:
        _, k, stop = heappop(heap)
        mid = end[k]
        if not mid or mid >= n or end[mid] != stop:
            continue
        end[k], end[mid] = stop, 0
        if stop < n:
            before[stop] = k
            after = end[stop]
            if (r := get(piece[k:after])) is not None:
                heappush(heap, (r, k, after))
        p = before[k]
        if p >= 0 and (r := get(piece[p:stop])) is not None:
            heappush(heap, (r, p, stop))
    out, k = [], 0
    while k < n:
        out.append(ranks[piece[k:end[k]]])
        k = end[k]
    return out


class Encoder(dict):
    """Pre-token -> its ids in decimal, joined by a space; looked up when first met.

    Kept in two generations: a full young one becomes the old one, whose entries
    are taken over as they are met again. So memory is bounded and frequent
    pre-tokens stay.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_known: int = 300_000):
        super().__init__()
        self.ranks, self.vocabulary, self.old = ranks, Vocabulary(ranks), {}
        self.pairs = [-1] * 65536
        for token, rank in ranks.items():
            if len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = rank
        self.split, self.max_known = regex.compile(pattern).findall, max_known

    def __missing__(self, piece: str) -> str:
        said = self.old.get(piece)
        if said is None:
            b = piece.encode()
            rank = self.vocabulary.whole(b)
            said = str(rank) if rank >= 0 else " ".join(map(str, merge(b, self.ranks, self.pairs)))
        self[piece] = said
        return said

    def encode(self, text: str) -> str:
        """The ids of a text, in decimal, joined by a space."""
        if len(self) > self.max_known:
            self.old = dict(self)
            self.clear()
        return " ".join(map(self.__getitem__, self.split(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))


def _encoder(ranks: dict[bytes, int], pattern: str) -> Encoder:
    return held("byte_bpe", (pattern, ranks), lambda: Encoder(ranks, pattern))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: dict[bytes, int] | None = None,
           pattern: str | None = None, slice_rows: int = 128) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>), decoded (binary, made from the ids)."""
    def row(ids: list[int], said: str, decoded: bytes) -> tuple:
        return len(ids), ids, decoded

    return _run(docs, id_col, text_col, ranks, pattern, slice_rows, row,
                [("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())],
                "n_tokens long, ids array<int>, decoded binary")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: dict[bytes, int] | None = None,
            pattern: str | None = None, slice_rows: int = 128) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: ``encode`` without its long output."""
    def row(ids: list[int], said: str, decoded: bytes) -> tuple:
        return len(ids), sha(said), sha(decoded)

    return _run(docs, id_col, text_col, ranks, pattern, slice_rows, row,
                [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())],
                "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _run(docs, id_col, text_col, ranks, pattern, slice_rows, row, fields, ddl) -> DataFrame:
    import public_tokenizers

    table = read_ranks() if ranks is None else ranks  # a fixed vocabulary, about 1 MB
    split = pattern or public_tokenizers.PATTERN

    def run(batches):
        encoder = _encoder(table, split)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                rows = []
                for text in part.column(1).to_pylist():
                    said = encoder.encode(text or "")
                    ids = np.fromstring(said, np.int64, sep=" ").tolist()
                    rows.append(row(ids, said, encoder.decode(ids)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)],
                    names=["doc_id", *(f for f, _ in fields)])

    return id_text(docs, id_col, text_col).mapInArrow(tidy(run), f"doc_id long, {ddl}")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digests of every document's encoding and decoding."""
    return digests(documents(spark, sf_dir))

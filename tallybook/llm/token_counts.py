"""Operator 3: token counts by trie-shared dynamic programming.

A document's pre-tokens are its words, each with the word mark in front. Their
best segmentation under a unigram model has the forward score

    best(prefix) = max over pieces s ending the prefix of best(prefix - s) + score(s)

which depends on the prefix alone. So the distinct pre-tokens go into a
trie, each node's score is computed once, when it is made, from its
ancestors' scores, and the number of pieces of the best segmentation stays at
the node where the pre-token ends. A character that is no piece becomes its
UTF-8 bytes, one token each.

The vocabulary file's pieces are ranked; a piece of rank r scores
-log(r + RANK_SHIFT). Equal scores prefer fewer tokens.

One pass, no shuffle. A worker keeps its trie from task to task and empties it
when it exceeds ``max_nodes`` (memory, not results, depends on it); a pre-token of more than LONG characters
is scored by itself. Null or empty text: 0 words, 0 tokens. Null and repeated
doc_ids are counted like any other row; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm.common import documents, held, id_text, tidy

MARK = "▁"
RANK_SHIFT = 10
LONG = 1024


def read_pieces(path: str | None = None) -> dict[str, float]:
    """Score of each piece of a sentencepiece file; controls and bytes left out."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    plain = [k for k in range(model.get_piece_size())
             if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
    return {model.id_to_piece(k): -math.log(r + RANK_SHIFT) for r, k in enumerate(plain)}


class Trie:
    """Pre-tokens seen so far, with forward scores and token counts by node."""

    def __init__(self, pieces: dict[str, float], max_nodes: int):
        self.pieces, self.max_nodes = pieces, max_nodes
        self.endings = {s[k:] for s in pieces for k in range(len(s))}
        self.unknown = min(pieces.values(), default=0.0) - 1
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}  # parent * 2^21 + code point -> node
        self.best, self.tokens = array("d", [0.0]), array("q", [0])

    def _step(self, word: str, at: int, best, tokens) -> tuple[float, int]:
        """Score and count of word[:at], given those of all shorter prefixes."""
        score, count = -math.inf, 0
        for start in range(at - 1, -1, -1):
            s = word[start:at]
            if s in self.endings:
                if (p := self.pieces.get(s)) is not None:
                    p += best[start]
                    n = tokens[start] + 1
                    if p > score or (p == score and n < count):
                        score, count = p, n
            else:
                break
        if word[at - 1] not in self.pieces:
            n = len(word[at - 1].encode())
            p = best[at - 1] + n * self.unknown
            if p > score:
                score, count = p, tokens[at - 1] + n
        return score, count

    def count(self, word: str) -> int:
        """Tokens of the word's best segmentation."""
        best, tokens = [0.0], [0]
        if len(word) > LONG:
            for at in range(1, len(word) + 1):
                b, t = self._step(word, at, best, tokens)
                best.append(b)
                tokens.append(t)
            return tokens[-1]
        node = 0
        for at, c in enumerate(word, 1):
            key = (node << 21) + ord(c)
            if (node := self.child.get(key)) is None:
                b, t = self._step(word, at, best, tokens)
                node = self.child[key] = len(self.best)
                self.best.append(b)
                self.tokens.append(t)
            best.append(self.best[node])
            tokens.append(self.tokens[node])
        if len(self.best) > self.max_nodes:
            n = self.tokens[node]
            self.clear()
            return n
        return self.tokens[node]


class Counts(dict):
    """Word -> its tokens, from the trie when first met; two generations, as what
    is remembered of frequent words saves walking the trie again."""

    def __init__(self, trie: Trie, max_known: int = 300_000):
        super().__init__()
        self.trie, self.old, self.max_known = trie, {}, max_known

    def __missing__(self, word: bytes) -> int:
        n = self.old.get(word)
        if n is None:
            n = self.trie.count(MARK + word.decode())
        self[word] = n
        return n

    def of(self, text: str) -> tuple[int, int]:
        """Words and tokens of a text."""
        if len(self) > self.max_known:
            self.old = dict(self)
            self.clear()
        words = text.encode().split()  # bytes split at ASCII blanks and nowhere else
        return len(words), sum(map(self.__getitem__, words))


def _counts(pieces: dict[str, float], max_nodes: int) -> Counts:
    return held("token_counts", (max_nodes, pieces), lambda: Counts(Trie(pieces, max_nodes)))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 pieces: dict[str, float] | None = None, max_nodes: int = 400_000) -> DataFrame:
    """doc_id, n_words, n_tokens."""
    table = read_pieces() if pieces is None else pieces  # a fixed vocabulary, about 1 MB

    def run(batches):
        counts = _counts(table, max_nodes)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n = [counts.of(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in (zip(*n) if n else ((), ())))],
                    names=["doc_id", "n_words", "n_tokens"])

    return id_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, n_words long, n_tokens long")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and token counts of every document."""
    return token_counts(documents(spark, sf_dir))

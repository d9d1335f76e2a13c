"""Operator 5: benchmark decontamination by CGK embedding and bit sampling.

Texts are words (``\\w+`` of the lower-cased text). A document holds an item
of n words if some window of its words is within k = n * (100 - percent) / 100
word edits of it (insert, delete, replace).

1. Exact filter. k edits spoil at most 2k of the item's n - 1 word bigrams, so
   n - 1 - 2k of them stand within n + k words of the document. Places that
   have fewer are left; none that matches is. (From ``percent`` = 67 up; a lower one
   is an error.) This bound searches; what it leaves over is judged by steps 2 to 4.
2. CGK random walks embed each item-sized window around the remaining places:
   step j copies the current word and moves on by a random bit of (walk, j,
   word). Windows few edits apart are then few places apart in Hamming distance.
3. Bit-sampling LSH: samples of ``bits`` places, over ``walks`` walks. A window that
   agrees with the item in a whole sample makes its surroundings a candidate.
   A window whose embedding differs in a share h of its places is missed with
   probability (1 - (1 - h)^bits)^samples: there are as many samples as the target
   ``recall`` asks for at h = SHARE, and several windows cover a passage.
4. Exact verification: the least edit distance of the item to any window of
   the surroundings, by dynamic programming.

The items are a stated query set, taken in blocks of about ``block_chars`` characters (what
the driver and each task hold of it), one after the other; every block meets all rows.
Items below ``min_words`` words are left out: a word or two stand in many clean texts.

One row a document row and item: doc_id, item_id, n_words, distance (least).
Null texts, and items of no words, match nothing. A one-word item matches
where its word stands. Null and repeated doc_ids are searched like any other
row; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import documents, id_text, keep_rows, let_go, numbered, stage, tidy

_WORD = re.compile(r"\w+")
#: Items whose walks and samples a task keeps.
MADE = 2000


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


#: Rows of a region that are embedded at a time.
ROWS = 256
#: The least percentage for which the bigram bound loses nothing: an item of three words
#: at a third of edits has no bigram left.
LEAST_PERCENT = 67
#: Share of places in which the embeddings of the item and of a passage at the edit limit differ, at the most.
SHARE = 0.6


def tables_for(recall: float, bits: int, share: float = SHARE) -> int:
    """Samples of ``bits`` places of which one agrees with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (1 - share) ** bits))


def embed(windows: np.ndarray, moves: np.ndarray, pad: int) -> np.ndarray:
    """CGK embeddings (walk, row, place) of rows of n symbols, to 2n places.

    ``moves`` (walk, place, symbol) are the random bits by which a walk moves on.
    """
    rows, n = windows.shape
    windows = np.concatenate([windows, np.full((rows, 1), pad)], 1)
    at, row = np.zeros((len(moves), rows), np.int64), np.arange(rows)
    walk = np.arange(len(moves))[:, None]
    out = np.empty((len(moves), rows, 2 * n), np.int64)
    for j in range(2 * n):
        symbol = windows[row, np.minimum(at, n)]
        out[:, :, j] = symbol
        at += moves[walk, j, symbol]
    return out


def least_distance(item: np.ndarray, text: np.ndarray) -> int:
    """Least edit distance of ``item`` to any window of ``text``."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, symbol in enumerate(item.tolist(), 1):
        new = np.empty_like(row)
        new[0] = k
        new[1:] = np.minimum(row[:-1] + (text != symbol), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


class Item:
    """What the search of one item needs: its words as symbols 1, 2, ... (0 is any
    other word), the bag of its bigrams, walks, samples and its own embedding."""

    def __init__(self, words: np.ndarray, walks: int, bits: int, tables: int):
        self.known = np.unique(words)
        self.n, self.pad = len(words), len(self.known) + 1
        self.symbols = self.of(words)
        self.pairs, self.times = np.unique(self._pairs(self.symbols), return_counts=True)
        rng = np.random.default_rng(5)
        self.moves = rng.integers(0, 2, (walks, 2 * self.n, self.pad + 1), np.uint8)
        self.places = rng.integers(0, 2 * self.n, (tables, bits))
        self.walk = np.arange(tables)[:, None] % walks
        self.own = embed(self.symbols[None], self.moves, self.pad)[:, 0]

    def of(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
        return np.where(self.known[at] == words, at + 1, 0)

    def _pairs(self, symbols: np.ndarray) -> np.ndarray:
        code = symbols[:-1] * self.pad + symbols[1:]
        return code[(symbols[:-1] > 0) & (symbols[1:] > 0)]

    def shared(self, symbols: np.ndarray) -> int:
        """Size of the bag of bigrams that the item and a region share."""
        pairs, times = np.unique(self._pairs(symbols), return_counts=True)
        if not len(pairs) or not len(self.pairs):
            return 0
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return int(np.minimum(times, self.times[at])[self.pairs[at] == pairs].sum())

    def agrees(self, symbols: np.ndarray) -> bool:
        """Whether some window of the region agrees with the item in a whole sample."""
        symbols = np.concatenate([symbols, np.full(max(0, self.n - len(symbols)), self.pad)])
        windows = np.lib.stride_tricks.sliding_window_view(symbols, self.n)
        for at in range(0, len(windows), ROWS):  # a region may be as long as a document
            same = embed(windows[at:at + ROWS], self.moves, self.pad) == self.own[:, None]
            if same[self.walk, :, self.places].all(1).any():
                return True
        return False


class Items:
    """A block of items: vocabulary, bigram postings, embeddings."""

    def __init__(self, items: list[tuple[int, str]], percent: int, walks: int, bits: int, tables: int):
        self.vocabulary, self.ids, self.words = {}, [], []
        for item, text in items:
            w = [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words_of(text or "")]
            if w:
                self.ids.append(item)
                self.words.append(np.array(w, np.int64))
        n = np.array([len(w) for w in self.words], np.int64)
        if percent < LEAST_PERCENT:
            raise ValueError(f"percent must be {LEAST_PERCENT} or more")
        self.edits = n * (100 - percent) // 100
        self.need = np.maximum(n - 1 - 2 * self.edits, 1)
        self.reach = n + self.edits
        self.size = len(self.vocabulary) + 1
        # A one-word item has the "bigram" (0, word), met wherever the word stands.
        pairs = [np.unique(w[:-1] * self.size + w[1:]) if len(w) > 1 else w for w in self.words]
        code = np.concatenate(pairs) if pairs else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
        order = np.argsort(code, kind="stable")
        self.codes, first = np.unique(code[order], return_index=True)
        self.owner, self.first = owner[order], np.r_[first, len(code)]
        self.singles = any(len(w) == 1 for w in self.words)
        self.shape, self.made = (walks, bits, tables), {}

    def _hits(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place) of each bigram of the text that an item has, by item and place."""
        code = text[:-1] * self.size + text[1:]
        code[(text[:-1] == 0) | (text[1:] == 0)] = -1
        places = np.arange(len(code))
        if self.singles:
            code, places = np.r_[code, text], np.r_[places, np.arange(len(text))]
        keep = code > 0
        code, places = code[keep], places[keep]
        at = np.searchsorted(self.codes, code)
        at[at == len(self.codes)] = 0
        found = self.codes[at] == code if len(self.codes) else np.zeros(len(code), bool)
        at, places = at[found], places[found]
        times = self.first[at + 1] - self.first[at]
        where = np.repeat(self.first[at] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
        item, places = self.owner[where], np.repeat(places, times)
        order = np.lexsort((places, item))
        return item[order], places[order]

    def item(self, k: int) -> Item:
        if k not in self.made:
            if len(self.made) > MADE:
                self.made.clear()
            self.made[k] = Item(self.words[k], *self.shape)
        return self.made[k]

    def search(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, n_words, distance) of the items that the text holds."""
        w = words_of(text)
        get = self.vocabulary.get
        ids = np.fromiter(map(get, w, repeat(0)), np.int64, len(w))
        if not ids.any():
            return []
        item, place = self._hits(ids)
        # Runs of an item's ``need`` bigrams within n + edits words: the surroundings of each,
        # merged to regions.
        last = np.arange(len(item)) + self.need[item] - 1
        last[last >= len(item)] = 0
        dense = (item[last] == item) & (place[last] >= place) & (place[last] - place < self.reach[item])
        out = []
        starts = np.flatnonzero(dense)  # by item, as the hits are
        found, cuts = np.unique(item[starts], return_index=True)
        for k, own in zip(found.tolist(), np.split(starts, cuts[1:])):
            n, edits, reach = len(self.words[k]), int(self.edits[k]), int(self.reach[k])
            lo = np.maximum(place[last[own]] - reach, 0)
            hi = np.minimum(place[own] + reach + 1, len(ids))
            cut = np.flatnonzero(np.r_[True, lo[1:] > np.maximum.accumulate(hi)[:-1]])
            best = edits + 1
            for a, b in zip(lo[cut], np.maximum.reduceat(hi, cut)):
                region = self.item(k).of(ids[a:b])
                if (n == 1 or self.item(k).shared(region) >= self.need[k]) and self.item(k).agrees(region):
                    best = min(best, least_distance(self.item(k).symbols, region))
            if best <= edits:
                out.append((self.ids[k], n, best))
        return out


def item_blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_chars: int,
                min_words: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_chars`` characters (an item is not cut), one
    fetched after the other: dealt by a hash, sized by one sum. At least one block."""
    items = id_text(benchmark, item_col, item_text_col)
    n_blocks = max(1, math.ceil((items.agg(F.sum(F.length("text"))).first()[0] or 0) / block_chars))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)))
    for k in range(n_blocks):
        rows = [(r[0], r[1]) for r in dealt.where(F.col("block") == k).select("doc_id", "text").collect()]
        kept = [(i, t) for i, t in rows if len(words_of(t or "")) >= min_words]
        yield sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", percent: int = 80, walks: int = 8, bits: int = 2,
          recall: float = 0.999999, block_chars: int = 16_000_000, min_words: int = 1) -> DataFrame:
    """doc_id, item_id, n_words, distance."""
    def searched(block: list[tuple[int, str]]) -> DataFrame:
        tables = tables_for(recall, bits)

        def run(batches):
            let_go()
            items = Items(block, percent, walks, bits, tables)
            for batch in batches:
                rows = [(doc, *hit) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                        if text for hit in items.search(text)]
                cols = zip(*rows) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=["doc_id", "item_id", "n_words", "distance"])

        return id_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, item_id long, n_words long, distance long")

    found: list[DataFrame] = []
    for block in item_blocks(benchmark, item_col, item_text_col, block_chars, min_words):
        found.append(searched(block))
        if len(found) > 1:  # the hits so far are written: no plan keeps the block before
            found[-2:] = [stage(found[-2], "hits") if len(found) == 2 else found[-2], stage(found[-1], "hits")]
    return reduce(DataFrame.unionAll, found)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", percent: int = 80, walks: int = 8, bits: int = 2, recall: float = 0.999999,
          block_chars: int = 16_000_000, min_words: int = 1) -> DataFrame:
    """The documents that hold no item of ``min_words`` words or more, with all their columns."""
    def without(rest: DataFrame, block: list[tuple[int, str]]) -> DataFrame:
        tables = tables_for(recall, bits)

        def judge():
            let_go()
            items = Items(block, percent, walks, bits, tables)
            return lambda text: not (text and items.search(text))

        return keep_rows(rest, judge, [text_col])

    left = docs
    for k, block in enumerate(item_blocks(benchmark, item_col, item_text_col, block_chars, min_words)):
        left = without(stage(numbered(left), "clean").toDF(*docs.columns) if k else left, block)
    return left


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds."""
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

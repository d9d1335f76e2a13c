"""Operator 7: quality rules by distribution divergence.

Each document's histograms of character classes and of common words are
compared with those of its language by Jensen-Shannon distance (base 2, the
square root of the divergence, 0 to 1). The language references are trained
here: sums over all documents of a language that pass the base rules, each
document weighing its own length. A document that is far from its own
language's reference, but near another's, is one with a wrong label, and kept.
Common words are the ``n_common`` most
frequent words, of any length. Where they make up less than ``min_cover`` of a
language's words (languages written without blanks, whose "words" are phrases),
the language has no word reference: 50 words or more that hold none of them
would say nothing. A document that is far from its own language by words only
is not held against languages without word reference. A language needs
``min_docs`` documents to be a reference, and the ``max_refs`` languages of most words
are; a document of another language is held against all references at once, by
the classes that hardly depend on the language (letters, digits, sentence marks, other
marks; blanks left out), and rejected if it is far from each. A
distance counts only from a minimum length on, below which a histogram says
little: ``min_letters`` characters for classes, ``min_words`` words for words;
and the limit of the word distance, whose noise falls with the root of the
length, is ``max_word`` + 1 / sqrt(n_words).

Null text: no words. A null language is a language of its own, and so is that of a
table without the column. Without any reference nothing is rejected but by the base rules. Null and repeated doc_ids are judged
like any other row; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.common import column, documents, keep_rows, let_go, numbered, release, stage, tidy

#: Character classes: vowels and consonants as ASCII letters of their own kind,
#: other letters, upper case, digits, blanks, sentence marks, other marks.
CLASSES = ("lower_vowel", "lower_consonant", "lower_other", "upper", "digit", "blank", "sentence", "other")


def char_class(c: str) -> int:
    if "a" <= c <= "z":
        return 0 if c in "aeiou" else 1
    if c in " \t\n\r\x0b\x0c":
        return 5
    kind = unicodedata.category(c)
    if kind[0] == "L":
        return 3 if kind in ("Lu", "Lt") else 2
    if kind[0] in "MN":
        return 4 if kind[0] == "N" else 2
    return 6 if c in ".,;:!?'\"()-" else 7


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    return np.array([char_class(chr(k)) for k in range(0x110000)], np.uint8)


@dataclass
class Text:
    """What is counted of one text: its words in order as small numbers, the
    distinct words with their counts, its code points."""
    codes: np.ndarray
    count: dict[bytes, int]
    ids: np.ndarray

    @classmethod
    def of(cls, text: str) -> Text:
        words = text.encode().split()  # bytes split at [\x20\x09-\x0D] and nowhere else
        count = Counter(words)
        place = dict(zip(count, range(len(count))))
        return cls(np.frombuffer(text.encode("utf-32-le"), np.uint32), count,
                   np.fromiter(map(place.__getitem__, words), np.int64, len(words)))

    def class_counts(self) -> list[int]:
        return np.bincount(_class_table()[self.codes], minlength=len(CLASSES)).tolist()

    def n_repeat_words(self) -> int:
        """Words inside any three-word window that the text has twice or more."""
        ids, v = self.ids, len(self.count)
        if len(ids) < 4 or v == len(ids):
            return 0
        pairs = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1]
        _, where, times = np.unique(pairs[:-1] * v + ids[2:], return_inverse=True, return_counts=True)
        hit = times[where] > 1
        inside = np.zeros(len(ids), bool)
        for k in range(3):
            inside[k:k + len(hit)] |= hit
        return int(inside.sum())

    def features(self, text: str) -> tuple[int, int, int, int, int]:
        """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
        ascii_ = np.bincount(self.codes[self.codes < 128], minlength=128)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if line in seen:
                dup += 1
            elif line.strip(" \t\n\x0b\x0c\r"):
                seen.add(line)
        blanks = int(ascii_[9:14].sum() + ascii_[32])
        return (len(self.ids), len(self.codes) - blanks, int(sum(ascii_[ord(c)] for c in "#*$%&|<>")), dup,
                self.n_repeat_words())


def base_failed(n_words: int, n_repeat: int, min_words: int = 50) -> bool:
    return n_words < min_words or 100 * n_repeat > 50 * n_words


def js_distance(p: list[float], q: list[float]) -> float:
    """Jensen-Shannon distance of two histograms; 0 where one is empty."""
    a, b = sum(p), sum(q)
    if not a or not b:
        return 0.0
    d = 0.0
    for x, y in zip(p, q):
        x, y = x / a, y / b
        m = (x + y) / 2
        d += (x * math.log2(x / m) if x else 0) + (y * math.log2(y / m) if y else 0)
    return math.sqrt(max(d / 2, 0.0))


def _has(docs: DataFrame, name: str) -> bool:
    return name.lower() in [c.lower() for c in docs.columns]


def _typed(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    lang = F.col(column(docs, lang_col)) if _has(docs, lang_col) else F.lit(None)
    return numbered(docs).select(F.col(column(docs, id_col)).cast("long").alias("doc_id"),
                                 F.col(column(docs, text_col)).cast("string").alias("text"),
                                 lang.cast("string").alias("lang"))


#: What a task holds at a time of its counts: distinct words, and bytes of them; and rows
#: of a batch that it hands on.
PART_WORDS, PART_BYTES, SLICE = 100_000, 4 << 20, 8192

#: The classes in groups that hardly depend on the language; None: left out.
COARSE = (0, 0, 0, 0, 1, None, 2, 3)


def coarse(classes: list[int]) -> list[int]:
    out = [0] * 4
    for group, n in zip(COARSE, classes):
        if group is not None:
            out[group] += n
    return out


def top_items(counts: DataFrame, n: int) -> DataFrame:
    """Of (lang, kind, item, n) the ``n`` most frequent items of each language and kind:
    first of each salt, a sixteenth of a language's items, then of these. Every task
    hands on ``n`` of a salt at most, so no language is sorted or held in one place."""
    def first(df, *keys):
        order = Window.partitionBy(*keys).orderBy(F.desc("n"), "item")
        return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")

    salted = counts.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(16)))
    return first(first(salted, "lang", "kind", "salt").drop("salt"), "lang", "kind")


class Parts:
    """A task's counts by language, handed on whenever they reach their bounds."""

    def __init__(self):
        self.words: dict[str | None, Counter] = {}
        self.rest: dict[str | None, list[int]] = {}
        self.held = self.size = 0

    def add(self, lang: str | None, got: Text) -> None:
        words = self.words.setdefault(lang, Counter())
        before = len(words)
        words.update(got.count)
        self.held += len(words) - before
        self.size += (len(words) - before) * (sum(map(len, got.count)) // max(1, len(got.count)))
        rest = self.rest.setdefault(lang, [0] * (len(CLASSES) + 2))
        for k, n in enumerate((*got.class_counts(), len(got.ids), 1)):
            rest[k] += n

    def full(self) -> bool:
        return self.held >= PART_WORDS or self.size >= PART_BYTES or len(self.rest) >= PART_WORDS

    def rows(self) -> Iterator[tuple]:
        """(lang, kind, item, n), and nothing is held any more."""
        for lang, rest in self.rest.items():
            yield from ((lang, "c", c, n) for c, n in zip((*CLASSES, "words", "docs"), rest))
        self.rest = {}
        while self.words:
            lang, words = self.words.popitem()
            while words:
                word, n = words.popitem()
                yield lang, "w", word.decode(), n
        self.held = self.size = 0


def references(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               n_common: int = 64, min_cover: float = 0.2, min_docs: int = 20,
               max_refs: int = 200) -> dict[str | None, tuple[dict[str, int], list[int]]]:
    """Per language of ``min_docs`` documents, the ``max_refs`` of most words at the
    most: counts of its common words, and of character classes.

    One pass over all documents. Each task adds up (language, word) counts of bounded
    size before anything is shuffled. What comes to the driver is ``n_common`` words and
    the classes of ``max_refs`` languages.
    """
    def batches_of(rows):
        while part := list(islice(rows, SLICE)):
            lang, kind, item, n = zip(*part)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kind, pa.string()),
                                              pa.array(item, pa.string()), pa.array(n, pa.int64())],
                                             names=["lang", "kind", "item", "n"])

    def run(batches):
        let_go()
        parts = Parts()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    got = Text.of(text or "")
                    if base_failed(len(got.ids), got.n_repeat_words()):
                        continue
                    parts.add(lang, got)
                    if parts.full():
                        yield from batches_of(parts.rows())
        yield from batches_of(parts.rows())

    counts = (_typed(docs, id_col, text_col, lang_col).select("text", "lang")
              .mapInArrow(tidy(run), "lang string, kind string, item string, n long")
              .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))
    # Some rows a language are counted twice over, words once: the table is written.
    counts = stage(counts, "word-counts")
    known = (counts.where("kind = 'c'").groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("item", "n"))).alias("c"))
             .where(F.col("c")["docs"] >= min_docs).orderBy(F.desc(F.col("c")["words"]), "lang").limit(max_refs))
    out, n_words = {}, {}
    for lang, c in known.collect():
        out[lang], n_words[lang] = ({}, [c[k] for k in CLASSES]), c["words"]
    if out:
        named = F.col("lang").isin([x for x in out if x is not None])
        of_these = (named | F.col("lang").isNull()) if None in out else named
        kept = top_items(counts.where("kind = 'w'").where(of_these), n_common).collect()
        for r in sorted(kept, key=lambda r: (-r["n"], r["item"])):
            out[r["lang"]][0][r["item"]] = r["n"]
    release(counts)
    for lang, (words, _) in out.items():
        if sum(words.values()) < min_cover * n_words[lang]:
            words.clear()
    return out


@dataclass
class Judge:
    """The rules, with the references and limits they hold texts against."""
    refs: dict[str | None, tuple[dict[str, int], list[int]]]
    max_class: float = 0.25
    max_word: float = 0.75
    min_letters: int = 200
    min_words: int = 50

    def __post_init__(self):
        self.words_of = {lang: [w.encode() for w in common] for lang, (common, _) in self.refs.items()}
        self.coarse_refs = [coarse(classes) for _, classes in self.refs.values()]

    def stranger(self, got: Text, text: str) -> float:
        """Distance of a text whose language has no reference: of coarse classes, to the nearest one."""
        if len(text) < self.min_letters or not self.coarse_refs:
            return 0.0
        own = coarse(got.class_counts())
        return min(js_distance(own, ref) for ref in self.coarse_refs)

    def __call__(self, text: str, lang: str | None) -> tuple:
        """The features, both distances, base_failed, kept."""
        got = Text.of(text)
        base = got.features(text)
        failed = base_failed(base[0], base[4])
        if lang not in self.refs:
            far = self.stranger(got, text)
            return (*base, far, 0.0, failed, not failed and far <= self.max_class)
        own = self.distances(got, text, lang)
        for other in () if failed or self.near(own, base[0]) else self.refs:
            if not self.refs[other][0] and own[0] <= self.max_class:
                continue
            if self.near(found := self.distances(got, text, other), base[0]):
                own = found
                break
        return (*base, *own, failed, not failed and self.near(own, base[0]))

    def near(self, distances: tuple[float, float], n_words: int) -> bool:
        return distances[0] <= self.max_class and distances[1] <= self.max_word + 1 / math.sqrt(max(n_words, 1))

    def distances(self, got: Text, text: str, lang: str | None) -> tuple[float, float]:
        """To the reference of one language, of classes and of words."""
        common, classes = self.refs.get(lang, ({}, []))
        class_js = js_distance(got.class_counts(), classes) if any(classes) and len(text) >= self.min_letters else 0.0
        word_js = 0.0
        if common and len(got.ids) >= self.min_words:
            count = [got.count.get(w, 0) for w in self.words_of[lang]]
            word_js = js_distance(count, list(common.values())) if any(count) else 1.0
        return class_js, word_js


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            judge: Judge | None = None) -> DataFrame:
    """doc_id, the base features, both distances, base_failed and kept."""
    docs = _typed(docs, id_col, text_col, lang_col)
    judge = judge or Judge(references(docs))
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in
                        ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                        ("class_js", pa.float64()), ("word_js", pa.float64()),
                        ("base_failed", pa.bool_()), ("kept", pa.bool_())])

    def run(batches):
        let_go()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [judge(t or "", g) for t, g in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:])], schema=schema)

    return docs.mapInArrow(tidy(run), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                "n_repeat_words long, class_js double, word_js double, base_failed boolean, kept boolean")


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that pass, with all their columns."""
    judge = Judge(references(docs, id_col, text_col, lang_col))
    if _has(docs, lang_col):
        return keep_rows(docs, lambda: lambda text, lang: judge(text or "", lang)[-1], [text_col, lang_col])
    return keep_rows(docs, lambda: lambda text: judge(text or "", None)[-1], [text_col])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and verdict of every document."""
    return quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_js", "word_js")

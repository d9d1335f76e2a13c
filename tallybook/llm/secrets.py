"""Operator 8: secrets, by form and by randomness.

Base kinds are found by form (an assigned value, an access key, a long
lower-case hex run). The method adds ``random``: runs of 20 or more characters
that mix letters with digits, whose encoding is inferred (base32, base64, hex,
letters and digits) and which pass a battery of randomness tests over that
alphabet: chi-squared uniformity, runs about the median, serial correlation. A run that
fits no encoding (a path with a base64url token) is cut at '+' and '/', and at
'-' and '_', and the pieces of both cuts are tested; of pieces that overlap and
pass, the one with the higher p is reported. A rejected run with a '/' may be a
path: its pieces are tested in the same way, in a step of their own.

Two kinds of error are bounded apart:

* True secrets lost (``loss``). The hypothesis of the battery is "drawn uniformly from
  the alphabet", so a true secret fails it only by chance; a run is out if the worst of
  its three p-values, by Bonferroni, is below ``loss``.
* False reports (``rate``). The hypothesis is "words of a text, run together": the mean
  log-likelihood of the run's letter pairs, case folded, with all digits as one sign, in a
  model of words joined without blanks, as in identifiers. It is rejected where the pairs
  are too unlikely for text. Over the runs of a document a Benjamini-Hochberg step, weighted
  by length (long runs, whose test has more power, may have more of the level), keeps
  the expected share of text among the reports below ``rate``.

The model is trained here on the words of a public tokenizer's vocabulary file of many
languages, each by its rank.

Offsets are code points, end exclusive. Null or empty text: no spans. Null and
repeated doc_ids are scanned and returned like any other; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm.byte_bpe import read_ranks
from tallybook.llm.common import documents, id_text, map_texts

BASE_KINDS = ("assign", "access", "hex")

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
#: A run starts after '=' as after any other sign; '=' belongs to it only as padding at its end.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:={1,6}(?![A-Za-z0-9+/_=-]))?")
#: A run that mixes signs of both base64 alphabets is cut by either reading.
_READINGS = (re.compile(r"[A-Za-z0-9_-]+=*"), re.compile(r"[A-Za-z0-9+/]+=*"))

_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings, narrowest alphabet first; a run gets the first that holds it.
ENCODINGS = (
    ("hex", "0123456789abcdef"), ("hex_upper", "0123456789ABCDEF"), ("base32", _UPPER + "234567"),
    ("lower36", _DIGIT + _LOWER), ("upper36", _DIGIT + _UPPER), ("base62", _DIGIT + _UPPER + _LOWER),
    ("base64", _UPPER + _LOWER + _DIGIT + "+/"), ("base64url", _UPPER + _LOWER + _DIGIT + "-_"),
)
_PLACES = tuple((name, {c: k for k, c in enumerate(letters)}) for name, letters in ENCODINGS)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds by start, then kind in the fixed order."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def _tail(z: float) -> float:
    """Upper tail of the standard normal."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(values: list[int], size: int) -> tuple[float, float, float]:
    """p-values of the three tests of ``values`` against uniform draws from 0..size-1."""
    n = len(values)
    counts = [0] * size
    for v in values:
        counts[v] += 1
    stat, df = size / n * sum(c * c for c in counts) - n, size - 1
    z = ((max(stat, 0.0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))  # Wilson-Hilferty
    chi = _tail(z)
    high = [v >= size / 2 for v in values]
    a = sum(high)
    b = n - a
    if a and b:
        runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
        mean = 1 + 2 * a * b / n
        var = max((mean - 1) * (mean - 2) / max(n - 1, 1), 1e-9)
        run_p = 2 * _tail(abs(runs - mean) / math.sqrt(var))
    else:
        run_p = 2.0 ** (1 - n)
    mid = sum(values) / n
    spread = sum((v - mid) ** 2 for v in values)
    lag = sum((x - mid) * (y - mid) for x, y in zip(values, values[1:]))
    serial = 2 * _tail(abs(lag / spread + 1 / n) * math.sqrt(n)) if spread else 0.0
    return chi, min(run_p, 1.0), min(serial, 1.0)


class TextModel:
    """Log2 probability of a sign after another in words that are run together: a to z
    folded, 26 for a digit. Pairs of digits and other signs say nothing."""

    def __init__(self, words: list[tuple[str, float]]):
        pairs, first, last = (np.zeros((27, 27)), np.zeros(27), np.zeros(27))
        for word, weight in words:
            x = [ord(c) - 97 for c in word]
            np.add.at(pairs, (x[:-1], x[1:]), weight)
            first[x[0]] += weight
            last[x[-1]] += weight
        total = first.sum()
        # Words follow each other in any order, and one in twenty is followed by a number.
        pairs += np.outer(last, first) / total
        pairs[:26, 26] += last[:26] / 20
        pairs[26, :26] += first[:26] / 20
        pairs /= pairs.sum()
        smooth = pairs + 1e-6
        logs = np.log2(smooth / smooth.sum(1, keepdims=True))
        self.mean = float((pairs * logs).sum())
        self.spread = math.sqrt(float((pairs * logs ** 2).sum()) - self.mean ** 2)
        self.logs = logs.tolist()

    def p_text(self, run: str) -> float:
        """How likely text is to have pairs that are no more likely than the run's; 1 without pairs."""
        total, n, before = 0.0, 0, None
        for c in run.lower():
            sign = ord(c) - 97 if "a" <= c <= "z" else 26 if c in _DIGIT else None
            if before is not None and sign is not None and not sign == before == 26:
                total += self.logs[before][sign]
                n += 1
            before = sign
        return _tail((self.mean - total / n) / (self.spread / math.sqrt(n))) if n else 1.0


def text_model(path: str | None = None) -> TextModel:
    """From the words (blank, then letters of a to z) of a vocabulary file of ranks."""
    import public_tokenizers

    words = []
    for token, rank in read_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).items():
        word = token[1:].lower()
        if token[:1] == b" " and len(word) > 2 and all(97 <= c <= 122 for c in word):
            words.append((word.decode(), 1 / (rank + 1000)))
    return TextModel(words)


def _encoded(run: str) -> tuple[str, list[int], int] | None:
    body = run.rstrip("=")
    for name, places in _PLACES:
        if all(c in places for c in body):
            return name, [places[c] for c in body], len(places)
    return None


def _pieces(text: str) -> list[tuple[int, int]]:
    """Runs that fit an encoding, and the pieces of those that fit none."""
    out = []
    for m in _RUN.finditer(text):
        run = m[0]
        if ("+" in run or "/" in run) and ("-" in run or "_" in run):
            out += _cut(run, m.start())
        else:
            out.append(m.span())
    return out


def _cut(run: str, at: int) -> list[tuple[int, int]]:
    return sorted({(at + p.start(), at + p.end()) for r in _READINGS for p in r.finditer(run)})


@dataclass
class Judge:
    """The tests and their levels."""
    model: TextModel
    min_length: int = 20
    rate: float = 0.01
    loss: float = 0.02

    def judged(self, text: str, spans: list[tuple[int, int]], taken: list[tuple[str, int, int]]) -> tuple[list[tuple], list[tuple]]:
        """Of ``spans`` those with letters and digits, as (start, end, encoding, p of the
        battery): reported, and others."""
        tests = []
        for s, e in spans:
            run = text[s:e]
            if not any(c.isdigit() for c in run) or not any(c.isalpha() for c in run) \
                    or any(a < e and s < b for _, a, b in taken):
                continue
            if (got := _encoded(run)) and len(got[1]) >= self.min_length:
                p = min(1.0, 3 * min(battery(got[1], got[2])))
                tests.append((s, e, got[0], p, len(got[1]), self.model.p_text(run)))
        if not tests:
            return [], []
        mean = sum(t[4] for t in tests) / len(tests)
        level = [t[5] * mean / t[4] for t in tests]
        order = sorted(range(len(tests)), key=level.__getitem__)
        cut = max((rank for rank, k in enumerate(order, 1) if level[k] <= self.rate * rank / len(tests)), default=0)
        no_text = set(order[:cut])
        kept = [k for k, t in enumerate(tests) if k in no_text and t[3] >= self.loss]
        return [tests[k][:4] for k in kept], [t[:4] for k, t in enumerate(tests) if k not in kept]

    def random_spans(self, text: str, taken: list[tuple[str, int, int]]) -> list[tuple]:
        """The reported runs, as (start, end, encoding, p)."""
        kept, gone = self.judged(text, _pieces(text), taken)
        again = [p for s, e, _, _ in gone if "/" in text[s:e] for p in _cut(text[s:e], s) if p != (s, e)]
        kept += self.judged(text, again, taken)[0]
        out: list[tuple] = []
        for t in sorted(kept, key=lambda t: (-t[3], t[0])):
            if not any(t[0] < e and s < t[1] for s, e, _, _ in out):
                out.append(t)
        return sorted(out)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 judge: Judge | None = None) -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, end, encoding, p) per document,
    base kinds first, each group by start."""
    judge = judge or Judge(text_model())

    def row(text: str) -> tuple:
        base = base_spans(text)
        out = [{"kind": k, "start": s, "end": e, "encoding": None, "p": None} for k, s, e in base]
        return (out + [{"kind": "random", "start": s, "end": e, "encoding": enc, "p": p}
                       for s, e, enc, p in judge.random_spans(text, base)],)

    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                      ("encoding", pa.string()), ("p", pa.float64())])
    return map_texts(id_text(docs, id_col, text_col), row, [("spans", pa.list_(span))],
                     "spans array<struct<kind:string,start:long,end:long,encoding:string,p:double>>")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of ``secret_spans`` over all of ``documents``."""
    spans = secret_spans(documents(spark, sf_dir))
    said = "transform({}, s -> concat_ws(':', s.kind, s.start, s.end))"
    base = f"filter(spans, s -> s.kind in {BASE_KINDS})"
    # "spans" by start, then kind as listed ("random" after the base kinds).
    every = ("array_sort(spans, (a, b) -> case when a.start <> b.start then int(sign(a.start - b.start)) "
             "else int(sign(instr('assign access hex random', a.kind) "
             "- instr('assign access hex random', b.kind))) end)")
    return spans.selectExpr(
        "doc_id", *(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long) as n_{k}" for k in BASE_KINDS),
        f"sha2(array_join({said.format(base)}, ','), 256) as base_sha256",
        f"array_join({said.format(every)}, ',') as spans")

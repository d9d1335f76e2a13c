"""Operators that compare documents, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallybook.llm import components, decontaminate, line_dedup, near_dup, suffix_dedup

from .helpers import clashing, edge_rows, frame, prose, rows_of, write_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def numbered_edges(rnd, first):
    return [(first + k, t) for k, (_, t) in enumerate(edge_rows(rnd))]


# -- repeated strings --------------------------------------------------------------------------------


def cut_plain(rows):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[k:k + 200] for b in raw for k in range(len(b) - 199))
    out = []
    for (i, _), b in zip(rows, raw):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k:k + 200] = True
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone]) == 1).sum()),
                    sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return sorted(out, key=repr)


def repeat_rows(rnd):
    passages = [prose(rnd, n) for n in (30, 45, 60, 200)]
    rows = []
    for k in range(60):
        parts = [prose(rnd, rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randrange(0, max(1, len(p) - 190))
            parts += [p[a:a + rnd.choice([150, 199, 200, 201, 260, 2000])], prose(rnd, rnd.randint(0, 20))]
        rows.append((k, "".join(parts)))
    # exactly 200 bytes, 199 bytes, two-byte characters cut in the middle, self-overlap
    exact = "".join(rnd.choice("abcdefgh") for _ in range(200))
    two = "é" * 99 + "".join(rnd.choice("èêô") for _ in range(60))
    return rows + [(100, "x" + exact), (101, exact + "y"), (102, exact[:199]), (103, "a" + two), (104, two + "ô"), (105, "ab" * 150),
                   (106, "z" * 200), (107, "z" * 199), (108, "q" * 201), (109, rows[0][1]), (109, rows[0][1]), (None, rows[1][1])]


@pytest.mark.parametrize("group_bytes", [2000, 1 << 23])
def test_repeated_strings(spark, tmp_path, monkeypatch, group_bytes):
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", group_bytes)
    rnd = random.Random(1)
    rows = repeat_rows(rnd) + [(200 + k, t) for k, (_, t) in enumerate(edge_rows(rnd)) if t is None or len(t) < 31_000]
    path = write_docs(clashing(frame(spark, rows), ["n_bytes"]), tmp_path)
    got = suffix_dedup.op1_suffix_dedup(spark, path)
    assert rows_of(got) == cut_plain(rows)
    kept = suffix_dedup.cut_repeats(frame(spark, rows)).where("doc_id = 105").collect()[0]
    assert bytes(kept["kept"]) == b"" and [tuple(s) for s in kept["spans"]] == [(0, 300)]


def test_cover_meets_every_difference():
    assert {(a - b) % suffix_dedup.MODULUS for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(91))
    assert suffix_dedup.NAME + suffix_dedup.MODULUS - 1 <= suffix_dedup.WINDOW


# -- near duplicates ---------------------------------------------------------------------------------


def components_plain(rows, k, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for x, s in enumerate(sets):
        common = Counter(y for g in s for y in where[g])
        for g in s:
            where[g].append(x)
        for y, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[y]) - n):
                up[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        r = find(x)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted([(i, len(s), least.get(find(x)), i == least.get(find(x))) for x, ((i, _), s) in enumerate(zip(rows, sets))], key=repr)


def near_rows(rnd, n_groups=25, copies=14):
    rows, at = [], 0
    for _ in range(n_groups):
        base = prose(rnd, rnd.choice([4, 12, 40, 120, 400])).split()
        for _ in range(rnd.randint(1, copies)):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 30))):
                w[rnd.randrange(len(w))] = f"w{rnd.randint(0, 999)}"
            if rnd.random() < 0.3:  # chains
                base = w
            text = " ".join(w)
            rows.append((at, text.upper() if rnd.random() < 0.1 else text))
            at += 1
    rnd.shuffle(rows)
    return [(k, t) for k, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, k, percent):
    rnd = random.Random(2)
    rows = near_rows(rnd) + numbered_edges(rnd, 5000) + [(None, "one two"), (None, "Only Null twice"), (None, "only null twice"),
                                                        (9001, "one\ttwo"), (9001, "one two three")]
    docs = clashing(frame(spark, rows), ["bands", "sketch", "a", "b"])
    got = near_dup.components(docs, k=k, percent=percent)
    want = [(i, n, c, i == c) for i, n, c, _ in components_plain(rows, k, percent)]
    assert rows_of(got) == sorted(want, key=repr)


def templated(rnd, n, own, frame_words=200):
    """Texts of a common frame and ``own`` words of their own, spread over it."""
    common = [f"frame{k}" for k in range(frame_words)]
    out = []
    for k in range(n):
        w = list(common) + [f"own{k}x{j}" for j in range(own)]
        out.append((k, " ".join(w)))
    return out


def test_texts_of_one_frame_meet_in_proportion(spark):
    """Each is a component of its own: 86 % in common, 100 * 172 < 85 * 228. What the join
    brings together grows as the number of texts does, not as its square."""
    def brought(n, own):
        rows = [(k, [int(x) for x in near_dup.shingles(t, 1, {}).view(np.int64)]) for k, t in templated(random.Random(n), n, own)]
        sets = spark.createDataFrame([(k, k, w, [0] * 8) for k, w in rows],  # no help from the sketches
                                     "node long, root long, words array<long>, parity array<long>")
        prefixes = near_dup.prefix_rows(sets, 85)
        return near_dup.prefix_pairs(prefixes, 85).count(), prefixes.count()

    for n in (50, 100, 200):
        assert brought(n, 32)[0] == 0 and brought(n, 32)[1] <= 10 * n
    assert brought(40, 12)[0] == 40 * 39 / 2  # these are near duplicates


def test_prefix_pairs_lose_none_of_any_sizes(spark):
    rnd = random.Random(21)
    sets = []
    for _ in range(160):
        base = list(range(rnd.choice([5, 20, 60]))) if rnd.random() < 0.7 else list(range(100, 150))
        own = [rnd.randrange(10 ** 6, 10 ** 9) for _ in range(rnd.randrange(0, 1 + len(base) // 5))]
        sets.append(sorted({w for w in base if rnd.random() < 0.97} | set(own)))
    for percent in (80, 85):
        df = spark.createDataFrame([(k, k % 50, s, near_dup.parity(np.array(s, np.uint64)).tolist()) for k, s in enumerate(sets)],
                                   "node long, root long, words array<long>, parity array<long>")
        got = {tuple(sorted(r)) for r in near_dup.prefix_pairs(near_dup.prefix_rows(df, percent), percent).collect()}
        want = {(x, y) for x in range(160) for y in range(x + 1, 160) if x % 50 != y % 50 and sets[x] and sets[y]
                and 100 * len(set(sets[x]) & set(sets[y])) >= percent * len(set(sets[x]) | set(sets[y]))}
        assert want <= got and len(want) > 100


def test_one_each_keeps_the_columns_and_one_of_a_group(spark):
    rows = [(5, "a b c d e f"), (3, "A b c d e f"), (9, "x y z"), (7, None), (8, "")]
    docs = clashing(frame(spark, rows))
    left = near_dup.one_each(docs)
    assert left.columns == docs.columns and sorted(r[0] for r in left.collect()) == [3, 7, 8, 9]


def test_odd_sketch_estimates():
    rng = np.random.default_rng(3)
    for same in (120, 114, 102, 78):
        a = rng.integers(0, 1 << 63, 120, dtype=np.uint64)
        b = a.copy()
        b[same:] = rng.integers(0, 1 << 63, 120 - same, dtype=np.uint64)
        bits = int(np.bitwise_count((near_dup.odd_sketch(a) ^ near_dup.odd_sketch(b)).view(np.uint64)).sum())
        differ = 2 * (120 - same)
        assert abs(bits - 256 * (1 - (1 - 2 / 512) ** differ)) <= 4 * max(1, differ) ** 0.5
    assert near_dup.sketch_limit(85, 120) > 60


def test_stars_end_at_the_least_node(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 200), (200, 150), (7, 0), (300, 301), (301, 300)]
    got = rows_of(components.stars(spark.createDataFrame(edges, "a long, b long")))
    assert got == sorted([(k, 0) for k in range(1, 31)] + [(150, 100), (200, 100), (301, 300)], key=repr)


# -- shared lines ------------------------------------------------------------------------------------


def lines_plain(rows, order=lambda i: -1 if i is None else i):
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in (t or "").split("\n")]
    n, last = Counter(), {}
    for i, t in rows:
        for key in {x for x in keys(t) if len(x) >= 20}:
            n[key] += 1
            last[key] = max(last.get(key, -1), order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x, key in zip(lines, keys(t)) if n[key] < 3 or last[key] == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cell", [250_000, 3])
def test_shared_lines(spark, tmp_path, monkeypatch, cell):
    monkeypatch.setattr(line_dedup, "CELL_PROBES", cell)
    rnd = random.Random(3)
    pool = [prose(rnd, 6).replace("\n", " ") for _ in range(40)] + ["x" * 19, "é" * 19 + "z", "é" * 20, "Ünïcode LINE is here now", ""]
    rows = []
    for k in range(120):
        lines = [rnd.choice(pool) for _ in range(rnd.randint(0, 6))] + [prose(rnd, 5)]
        lines = [rnd.choice(["", " ", "\t\x0b"]) + (x.upper() if rnd.random() < 0.2 and x.isascii() else x) + rnd.choice(["", "\r"]) for x in lines]
        lines += lines[:1] + ["the line that all share, more or less"]
        rnd.shuffle(lines)
        rows.append((k, "\n".join(lines)))
    rows += numbered_edges(rnd, 1000) + [(None, rows[0][1]), (None, pool[0]), (7, rows[1][1])]
    path = write_docs(clashing(frame(spark, rows), ["n_lines", "last", "lo"]), tmp_path)
    assert rows_of(line_dedup.op9_line_dedup(spark, path)) == lines_plain(rows)


def test_lines_of_null_ids_only_stay(spark):
    line = "twenty characters or more"
    rows = [(None, line), (None, line), (None, line)]
    assert {r["text"] for r in line_dedup.drop_lines(frame(spark, rows)).collect()} == {line}


# -- benchmark ---------------------------------------------------------------------------------------


def leaks_plain(rows, items, percent=80):
    out = []
    for i, t in rows:
        w = decontaminate.words_of(t or "")
        for item, text in items:
            b = decontaminate.words_of(text or "")
            if b:
                d = [0] * (len(w) + 1)
                for r, x in enumerate(b, 1):
                    new = [r]
                    for c, y in enumerate(w, 1):
                        new.append(min(d[c - 1] + (x != y), d[c] + 1, new[-1] + 1))
                    d = new
                if min(d) <= len(b) * (100 - percent) // 100:
                    out.append((i, item, len(b), min(d)))
    return sorted(out, key=repr)


def test_leaks_against_plain_edit_distance(spark):
    rnd = random.Random(4)
    items = [(k, prose(rnd, rnd.choice([5, 9, 15, 25, 40]))) for k in range(12)] + [(50, None), (51, ""), (52, "Solitary"), (53, "two words")]
    rows = []
    for k in range(80):
        w = prose(rnd, rnd.randint(0, 60)).split()
        if k % 2:
            p = decontaminate.words_of(rnd.choice(items[:12])[1])
            for _ in range(rnd.randint(0, len(p) // 4)):
                at = rnd.randrange(len(p))
                p[at:at + rnd.randint(0, 1)] = rnd.choice([[], ["other"], ["more", "words"]])
            at = rnd.randint(0, len(w))
            w[at:at] = [x.upper() for x in p]
        rows.append((k, (" " if k % 3 else "!! ").join(w)))
    rows += [(90, "solitary, two  WORDS"), (91, None), (92, ""), (None, items[0][1]), (93, items[1][1]), (93, items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = clashing(frame(spark, rows), ["item_id"])
    want = leaks_plain(rows, items)
    assert len(want) > 25
    for block in (2_000_000, 500):
        assert rows_of(decontaminate.leaks(docs, bench, block_chars=block)) == want
    left = decontaminate.clean(docs, bench, block_chars=500)
    assert left.columns == docs.columns
    assert sorted(map(repr, (r[0] for r in left.collect()))) == sorted(repr(i) for i, _ in rows if i not in {w[0] for w in want})


def edited(rnd, words, edits):
    w = list(words)
    for k in range(edits):
        at = rnd.randrange(len(w))
        w[at:at + rnd.choice([0, 1, 1])] = rnd.choice([[], [f"new{k}"], [f"new{k}"]]) if len(w) > 1 else [f"new{k}"]
    return w


def test_recall_at_the_edit_limit_and_what_the_embeddings_rule_out():
    """Of 300 passages at the limit of 20 % all but a few are found; of regions that the
    bigram bound lets through without a match, the embeddings rule some out."""
    rnd = random.Random(23)
    found = matches = passed = others = 0
    for k in range(300):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.randint(16, 120))]
        items = decontaminate.Items([(1, " ".join(words))], 80, 8, 2, decontaminate.tables_for(0.999999, 2))
        limit = len(words) // 5
        text = [f"x{rnd.randrange(400)}" for _ in range(30)] + edited(rnd, words, limit) + [f"x{rnd.randrange(400)}" for _ in range(30)]
        near = decontaminate.least_distance(items.item(0).symbols, items.item(0).of(np.array([items.vocabulary.get(x, 0) for x in text])))
        if near <= limit:
            matches += 1
            found += bool(items.search(" ".join(text)))
        # the item's halves in the other order share its bigrams
        cut = rnd.randint(len(words) // 3, 2 * len(words) // 3)
        region = items.item(0).of(np.array([items.vocabulary[x] for x in words[cut:] + words[:cut]]))
        if items.item(0).shared(region) >= items.need[0] and decontaminate.least_distance(items.item(0).symbols, region) > limit:
            others += 1
            passed += items.item(0).agrees(region)
    assert matches > 200 and found >= 0.99 * matches
    assert others > 200 and passed <= others
    assert decontaminate.tables_for(0.9, 2) < decontaminate.tables_for(0.999999, 2) == 80


def test_percent_has_a_bound_and_short_items_can_be_left_out(spark):
    bench = spark.createDataFrame([(1, "cat"), (2, "one two three four five")], "item_id long, text string")
    docs = frame(spark, [(1, "a cat sat"), (2, "so one two three four five it is"), (3, "none")])
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, bench).collect()) == [3]
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, bench, min_words=5).collect()) == [1, 3]
    with pytest.raises(ValueError, match="67"):
        decontaminate.Items([(1, "a b c")], 66, 8, 2, 10)
    for n in range(2, 300):  # above it some bigram is left, whatever the length
        assert decontaminate.Items([(1, " ".join(f"w{k}" for k in range(n)))], 67, 8, 2, 1).need[0] <= n - 1 - 2 * (n * 33 // 100)


def test_a_long_text_full_of_an_item_stays_within_memory():
    import tracemalloc

    words = [f"w{k}" for k in range(150)]
    items = decontaminate.Items([(1, " ".join(words))], 80, 8, 2, 80)
    rnd = random.Random(2)
    # shuffled blocks: dense in the item's bigrams, and no window within the limit
    blocks = [words[k:k + 10] for k in range(0, 150, 10)]
    text = " ".join(w for _ in range(300) for b in rnd.sample(blocks, 15) for w in b)
    tracemalloc.start()
    items.search(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6, peak
    assert items.search(text + " " + " ".join(words)) == [(1, 150, 0)]


def test_null_ids_are_split_by_their_texts(spark):
    """No two null documents of different texts meet for their lost lines."""
    line, other = "a line that many documents share", "another line that all of them have"
    rows = [(None, f"{line}\nown {k}\n{other}") for k in range(40)] + [(3, line), (3, f"{other}\nx"), (-5, f"{other}\n{line}")]
    lost = line_dedup.lost_keys(frame(spark, rows).select("doc_id", "text")).collect()
    assert sum(r["none"] for r in lost) == 40 and all(len(r["keys"]) == 2 for r in lost if r["none"])
    got = [(r["doc_id"], r["__n_lines"], r["__n_dropped"], sha((r["text"] or "").encode())) for r in line_dedup.drop_lines(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == lines_plain(rows)


def test_cgk_keeps_close_texts_close():
    rnd = np.random.default_rng(5)
    a = rnd.integers(1, 500, 40)
    b = np.r_[a[:10], 499, a[10:39]]
    c = rnd.integers(1, 500, 40)
    moves = rnd.integers(0, 2, (20, 80, 501), np.uint8)
    a, b, c = decontaminate.embed(np.stack([a, b, c]), moves, 500).swapaxes(0, 1)
    assert (a != b).mean() < 0.4 < (a != c).mean()


@pytest.mark.parametrize("apply", [suffix_dedup.cut_repeats, near_dup.components, line_dedup.drop_lines, near_dup.one_each])
def test_empty_table(spark, apply):
    assert rows_of(apply(frame(spark, []))) == []


def test_empty_benchmark_or_documents(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, [(1, "some words here")])
    assert rows_of(decontaminate.leaks(docs, bench)) == []
    assert decontaminate.clean(docs, bench).count() == 1
    assert rows_of(decontaminate.leaks(frame(spark, []), spark.createDataFrame([(1, "a b")], "item_id long, text string"))) == []

import random
from collections import Counter
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest

from folioforge.llm import leakage, near_dup
from folioforge.llm.words import shingles_of, words_of


def plain(t):
    t = "".join(c for c in unicodedata.normalize("NFD", (t or "").lower()) if unicodedata.category(c) != "Mn")
    return re.findall("[a-z0-9]+", t)


TEXTS = ["Año: Niño, ÁRBOL 12-b", None, "", "  ", "ñ" * 3, "café İstanbul 漢字abc", "x", "a\x00b", "ไทย fin", "K Å"]


def test_words_equal_the_plain_rule():
    w = words_of(TEXTS)
    assert [int(n) for n in np.diff(w.first)] == [len(plain(t)) for t in TEXTS]
    seen = {}
    for h, x in zip(w.hashes.tolist(), [x for t in TEXTS for x in plain(t)]):
        assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)


def test_no_texts_and_no_words():
    assert len(words_of([]).hashes) == 0 if [] else True
    assert len(shingles_of(words_of([None, "a b"]), 3)[1]) == 0


def make(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


VOCABULARY = [a + b for a in "ba ce di fo gu la me ni po ru".split() for b in "sta ndo rel mix tro quen".split()]
SCHEMA = "row_id long, markdown string, group_id string, text string"


def corpus():
    rng = random.Random(7)
    out = []
    for _ in range(40):
        base = make(rng, rng.randrange(40, 90))
        out.append(base)
        for _ in range(rng.randrange(0, 4)):
            v = list(base)
            for _ in range(rng.randrange(1, 12)):
                i = rng.randrange(len(v))
                v[i : i + rng.randrange(0, 3)] = make(rng, rng.randrange(0, 3))
            out.append(v)
    hot = make(rng, 60)
    out += [hot] * 60 + [hot[:i] + ["zz"] + hot[i:] for i in range(60)]  # a third of all rows is one group
    texts = [" ".join(x) for x in out] + [None, "", "uno dos", "  "]
    rng.shuffle(texts)
    return [(i, t, "clash", None) for i, t in enumerate(texts, 1)]


def groups(rows, threshold, run, least):
    sets = {i: {tuple(w[k : k + run]) for k in range(len(w) - run + 1)} for i, t, *_ in rows if len(w := plain(t)) >= max(least, run)}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common >= threshold * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    members = {}
    for i in ids:
        members.setdefault(find(i), []).append(i)
    return {(i, g) for g, m in members.items() if len(m) > 1 for i in m}


@pytest.mark.parametrize("threshold,run,least", [(0.5, 3, 40), (0.8, 5, 0)])
def test_near_duplicates_equal_brute_force(spark, threshold, run, least):
    rows = corpus()
    got = {(r.row_id, r.group_id) for r in near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5), "row_id", "markdown", threshold, run, least).collect()}
    assert got == groups(rows, threshold, run, least)


def blocks_of(texts):
    rows = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["row_id", "text"])
    out = [set() for _ in texts]
    for part in near_dup._blocks(near_dup._sets([rows], 3, 0), False):
        for key, row in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            out[row].add(key)
    return out


@pytest.mark.parametrize("common", [1, 2])
def test_a_pair_with_few_common_blocks_behind_a_leader_of_another_class(spark, common):
    rng = random.Random(11)
    texts = []
    for _ in range(3000):
        base = make(rng, 46)
        texts += [" ".join(base), " ".join(base[:32] + make(rng, 14))]
    blocks = blocks_of(texts)
    sets = lambda t: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)}
    alike = lambda a, b: 2 * len(sets(a) & sets(b)) >= len(sets(a) | sets(b))
    i = next(i for i in range(0, len(texts), 2) if len(blocks[i] & blocks[i + 1]) == common and alike(texts[i], texts[i + 1]))
    shared = sorted(sets(texts[i]) & sets(texts[i + 1]))
    short = [" ".join(x + y) for x in shared for y in shared]
    leaders = []  # smaller rows that lead the pair's common blocks and are like neither of the two
    for key in blocks[i] & blocks[i + 1]:
        leaders.append(short[next(n for n, b in enumerate(blocks_of(short)) if key in b)])
    rows = [(n, t, "x", "y") for n, t in enumerate([*leaders, texts[i], texts[i + 1]])]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(1), "row_id", "markdown", 0.5, 3).collect()
    assert {(r.row_id, r.group_id) for r in got} == groups(rows, 0.5, 3, 0) and {common, common + 1} <= {r.row_id for r in got}


@pytest.mark.parametrize("most", [0, 3])
def test_near_duplicates_without_filters(spark, most):
    """Beyond the size of a filter, rows are joined; the groups are the same."""
    rng = random.Random(23)
    texts = []
    for _ in range(40):
        base = make(rng, 46)
        texts += [" ".join(base), " ".join(base[:40] + make(rng, 6)), " ".join(base[:30] + make(rng, 20))]
    rows = [(n, t, "x", "y") for n, t in enumerate(texts + texts[:9])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = near_dup.near_duplicates(df, "row_id", "markdown", 0.5, 3, filter_values=most).collect()
    assert {(r.row_id, r.group_id) for r in got} == groups(rows, 0.5, 3, 0)


def test_near_duplicates_of_nothing(spark):
    for rows in ([], [(1, None, "x", "y"), (2, "a", "x", "y")]):
        assert near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA), "row_id", "markdown").count() == 0


def leak_rows():
    rng = random.Random(3)
    items = [(i, " ".join(make(rng, rng.randrange(8, 40)))) for i in range(30)] + [(30, None), (31, ""), (32, "corto")]
    items.append((33, items[3][1]))  # the same passage under two ids
    docs = []
    for d in range(120):
        w = make(rng, rng.randrange(0, 120))
        if d % 3 == 0:
            source = plain(rng.choice(items)[1])
            at, n = rng.randrange(0, max(1, len(source) - 12)), rng.randrange(10, 20)
            w[20:20] = source[at : at + n]
        docs.append((d, " ".join(w).upper() if d % 2 else " ".join(w), "clash"))
    docs += [(200, None, "c"), (201, "", "c"), (0, docs[0][1], "c"), (202, " ".join(make(rng, 20_000)) + " " + items[5][1], "c")]
    return docs, items


def leaks(docs, items, run=12):
    windows = {}
    for i, t in items:
        w = plain(t)
        for k in range(len(w) - run + 1):
            windows.setdefault(tuple(w[k : k + run]), set()).add(i)
    return {(d, i) for d, t, _ in docs for w in [plain(t)] for k in range(len(w) - run + 1) for i in windows.get(tuple(w[k : k + run]), ())}


@pytest.mark.parametrize("index_octets", [leakage.INDEX_OCTETS, 0])
def test_leaks_equal_brute_force(spark, index_octets):
    docs, items = leak_rows()
    left, right = spark.createDataFrame(docs, "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id long, text string")
    got = leakage.find_leaks(left, right, index_octets=index_octets)
    rows = [(r.doc_id, r.item_id) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == leaks(docs, items)


def test_leaks_with_an_edit(spark):
    rng = random.Random(5)
    items = [(i, " ".join(make(rng, 14))) for i in range(20)]
    docs = []
    for i, t in items:
        w = plain(t)
        w[6] = "otra"
        docs.append((i, " ".join(make(rng, 30) + w + make(rng, 30)), "c"))
    left, right = spark.createDataFrame(docs, "doc_id long, text string, x string"), spark.createDataFrame(items, "item_id long, text string")
    assert leakage.find_leaks(left, right).count() == 0
    found = {(r.doc_id, r.item_id) for r in leakage.find_leaks(left, right, max_edits=1).collect()}
    assert found <= {(i, i) for i in range(20)} and len(found) >= 18


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[at : at + (kind != 1)] = [] if kind == 2 else make(rng, 1)
    return words


def edited_rows():
    """Items of several sizes, and documents with edited openings, middles and ends of them."""
    rng = random.Random(17)
    items = [(i, " ".join(make(rng, rng.choice([8, 12, 13, 23, 24, 30, 47, 48, 60])))) for i in range(14)] + [(60, None), (61, "")]
    docs = []
    for d in range(60):
        source = plain(rng.choice(items[:14])[1])
        part = source if d % 3 else source[: max(12, len(source) * 2 // 3)]
        docs.append((d, " ".join(make(rng, rng.randrange(0, 30)) + edited(rng, part, d % 4) + make(rng, rng.randrange(0, 30))), "c"))
    return docs + [(200, None, "c"), (201, "", "c"), (0, docs[0][1], "c")], items


def edited_pairs(docs, items, least=12):
    out = set()
    for i, t in items:
        w, run = plain(t), least
        if len(w) < least:
            continue
        while 2 * run <= len(w):
            run *= 2
        ends, most = {tuple(w[:run]), tuple(w[-run:])}, min(2, run // least)
        number = {x: n for n, x in enumerate({*w})}
        for d, text, _ in docs:
            v = plain(text)
            for k in range(len(v) - run + 1):
                window = v[k : k + run]
                for e in ends:  # an edit takes one word away at the most
                    if (d, i) not in out and sum((Counter(e) & Counter(window)).values()) >= run - most and leakage.edit_distance(np.array([number[x] for x in e]), np.array([number.get(x, -1) for x in window])) <= most:
                        out.add((d, i))
    return out


@pytest.mark.parametrize("index_octets", [leakage.INDEX_OCTETS, 0])
def test_edited_items_against_brute_force(spark, index_octets):
    docs, items = edited_rows()
    left, right = spark.createDataFrame(docs, "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in leakage.find_edited_items(left, right, index_octets=index_octets).collect()]
    want = edited_pairs(docs, items)
    assert len(got) == len(set(got)) and set(got) <= want and len(want) > 20 and len(got) >= 0.9 * len(want)


def test_leaks_of_nothing(spark):
    d, i = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a " * 20)], "item_id long, text string")
    assert leakage.find_leaks(d, i).count() == 0 and leakage.find_leaks(i.toDF("doc_id", "text"), d.toDF("item_id", "text")).count() == 0


def test_edit_distance():
    a = np.array
    assert leakage.edit_distance(a([1, 2, 3]), a([1, 2, 3])) == 0 and leakage.edit_distance(a([1, 2, 3]), a([2, 3, 4])) == 2

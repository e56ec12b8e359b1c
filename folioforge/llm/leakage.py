"""Passages of held-out items inside corpus texts.

Both sides are cut into windows of `run` words, the passage that counts as leaked. The CGK embedding walks through a
window with a pointer that a random function of step and word advances or not, so that windows at a small edit distance
get strings at a small Hamming distance. Bit sampling takes some positions of that string as key; `repetitions` keys
reach the wanted recall, one is enough for equal windows, whose embeddings are equal. Matches of a key are verified by
the exact edit distance of the windows.

Windows are all of `run` words (`find_leaks`) or as large as the items (`find_edited_items`): a length for each class of
items, doubling from class to class, with edits in proportion.

The items are a stated query set: their keys go to every task if their text is below `INDEX_OCTETS`, checked beforehand;
beyond, keys of both sides are shuffled, and words are fetched only for windows whose keys meet.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.words import mix, slices, words_of
from folioforge.runtime import staged

INDEX_OCTETS = 32 << 20
#: Positions of the embedding that a key samples, and steps a word: the pointer has passed a window after twice its
#: words on average, so positions beyond tell nothing.
SAMPLED, STEPS = 6, 2
_U = np.uint64
_AT_ONCE = 1 << 14


def repetitions(run: int, max_edits: int, recall: float) -> int:
    """How many sampled keys find a window at `max_edits` with the chance `recall`.

    A walk meets again after an edit within the window with a chance of a half at the least, and leaves then at most
    2 max_edits^2 + 2 max_edits of its run * STEPS positions different.
    """
    if max_edits == 0:
        return 1
    differing = min(0.9, (2 * max_edits**2 + 2 * max_edits) / (run * STEPS))
    once = 0.5 * (1 - differing) ** SAMPLED
    return math.ceil(math.log(1 - recall) / math.log(1 - once))


def _plan(run: int, count: int) -> list[list[int]]:
    """For each repetition, the sampled positions in order; fixed by the seed, the same on both sides."""
    rng = np.random.default_rng(20240607)
    return [sorted(rng.choice(run * STEPS, SAMPLED, replace=False).tolist()) for _ in range(count)]


def window_keys(hashes: np.ndarray, starts: np.ndarray, run: int, plan: list[list[int]]) -> np.ndarray:
    """One row of keys a repetition, for the windows of `run` words that begin at `starts`."""
    keys = np.zeros((len(plan), len(starts)), _U)
    for rep, sampled in enumerate(plan):
        moves = [mix(hashes + _U((rep + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))]
        while len(moves) * 64 <= sampled[-1]:  # 64 steps have their random moves in one word
            moves.append(mix(moves[-1]))
        for a in range(0, len(starts), _AT_ONCE):
            at = starts[a : a + _AT_ONCE]
            ends = at + run
            key = np.full(len(at), rep + 1, _U)
            pointer, take = at.copy(), set(sampled)
            for t in range(sampled[-1] + 1):
                inside = pointer < ends
                here = np.minimum(pointer, len(hashes) - 1)
                if t in take:
                    key = mix(key * _U(0x9E3779B97F4A7C15) + np.where(inside, hashes[here], _U(0)))
                pointer += inside & ((moves[t // 64][here] >> _U(t % 64)) & _U(1)).astype(bool)
            keys[rep, a : a + _AT_ONCE] = key
    return keys


def _starts(first: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, text index) of every window."""
    counts = np.maximum(np.diff(first) - run + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[owner] + place, owner


def edit_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Levenshtein distance of two sequences."""
    if len(a) == len(b) and (a == b).all():
        return 0
    b = b.tolist()
    row = list(range(len(b) + 1))
    for i, x in enumerate(a.tolist(), 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


@dataclass
class Form:
    """A window length, its edits and sampled positions; and the lengths of the items whose own windows take it."""

    run: int
    max_edits: int
    plan: list[list[int]]
    least: int = 0
    below: int | None = None

    def item_starts(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, item index) of the items' windows: every one, or of the class's items the first and the last."""
        if self.below is None:
            return _starts(first, self.run)
        sizes = np.diff(first)
        mine = np.flatnonzero((sizes >= self.least) & (sizes < self.below))
        starts, owner = np.concatenate((first[mine], first[mine + 1] - self.run)), np.concatenate((mine, mine))
        once = np.unique(np.stack((starts, owner)), axis=1)
        return once[0], once[1]

    def keys(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return mix(window_keys(hashes, starts, self.run, self.plan) + _U(self.run))


def uniform_form(run: int, max_edits: int, recall: float) -> Form:
    return Form(run, max_edits, _plan(run, repetitions(run, max_edits, recall)))


def item_forms(longest: int, least: int, max_edits: int, recall: float) -> list[Form]:
    """Classes of items of least, 2 least, 4 least, ... words; an edit for each `least` words of a window, up to `max_edits`.

    The embedding's distance grows with the square of the edits, and the number of keys exponentially with it: two edits
    take tens of keys, eight take thousands.
    """
    out, run = [], least
    while run <= longest:
        edits = min(max_edits, run // least)
        out.append(Form(run, edits, _plan(run, repetitions(run, edits, recall)), run, 2 * run))
        run *= 2
    return out


class ItemIndex:
    """Keys of the items' windows of a form, sorted, with the windows' words."""

    def __init__(self, ids: list[int], texts: list[str | None], form: Form):
        w = words_of(texts)
        starts, owner = form.item_starts(w.first)
        self.form, self.hashes = form, w.hashes
        flat = form.keys(w.hashes, starts).ravel()
        order = np.argsort(flat, kind="stable")
        self.keys = flat[order]
        self.starts = np.tile(starts, len(form.plan))[order]
        self.items = np.tile(np.array(ids, np.int64)[owner] if len(owner) else np.zeros(0, np.int64), len(form.plan))[order]

    def hits(self, w, found: set[tuple[int, int]]) -> None:
        """Add (text index, item id) of verified matches in a batch's words."""
        run, max_edits = self.form.run, self.form.max_edits
        starts, owner = _starts(w.first, run)
        if not len(self.keys) or not len(starts):
            return
        span = np.arange(run)
        for keys in self.form.keys(w.hashes, starts):
            low = np.searchsorted(self.keys, keys)
            hit = np.flatnonzero(self.keys[np.minimum(low, len(self.keys) - 1)] == keys)
            if not len(hit):
                continue
            high = np.searchsorted(self.keys, keys[hit], "right")
            many = high - low[hit]
            mine = np.repeat(hit, many)
            theirs = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low[hit], many)
            for a in range(0, len(mine), _AT_ONCE):
                m, t = mine[a : a + _AT_ONCE], theirs[a : a + _AT_ONCE]
                near = _close(w.hashes[starts[m][:, None] + span], self.hashes[self.starts[t][:, None] + span], max_edits, lambda i: (int(owner[m[i]]), int(self.items[t[i]])) in found)
                found.update(zip(owner[m[near]].tolist(), self.items[t[near]].tolist()))


def _close(x: np.ndarray, y: np.ndarray, max_edits: int, known=lambda i: False) -> np.ndarray:
    """Which rows of word windows are within `max_edits`; exact. Rows that are `known` need no answer."""
    same = (x == y).all(1)
    if max_edits and not same.all():
        rest = np.flatnonzero(~same)
        few = max(1, _AT_ONCE * 64 // x.shape[1] ** 2)
        for a in range(0, len(rest), few):
            at = rest[a : a + few]
            common = (x[at][:, :, None] == y[at][:, None, :]).any(2).sum(1)  # an edit takes one word away at the most
            for i in at[common >= x.shape[1] - max_edits]:
                same[i] = not known(i) and edit_distance(x[i], y[i]) <= max_edits
    return same


def _search(batches, indexes: list[ItemIndex]):
    for batch in (part for whole in batches for part in slices(whole, 1)):
        w, found = words_of(batch.column(1).to_pylist()), set()
        for index in indexes:
            index.hits(w, found)
        hits = sorted(found)
        ids = batch.column(0).take(pa.array([d for d, _ in hits], pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, pa.array([i for _, i in hits], pa.int64())], ["doc_id", "item_id"])


def _keys(batches, forms: list[Form]):
    """(key, id, first word, words) of every window of the texts."""
    for batch in (part for whole in batches for part in slices(whole, 1, 400_000)):
        w = words_of(batch.column(1).to_pylist())
        for form in forms:
            starts, owner = _starts(w.first, form.run)
            ids, at = batch.column(0).take(pa.array(owner)), pa.array((starts - w.first[owner]).astype(np.int32))
            run = pa.array(np.full(len(starts), form.run, np.int32))
            for keys in form.keys(w.hashes, starts):
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), ids, at, run], ["key", "id", "at", "run"])


def _lists(hashes: np.ndarray, starts: np.ndarray, run: int) -> pa.ListArray:
    words = hashes[starts[:, None] + np.arange(run)].view(np.int64).ravel() if len(starts) else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, run, dtype=np.int32)), pa.array(words))


def _item_windows(batches, forms: list[Form]):
    for batch in (part for whole in batches for part in slices(whole, 1, 400_000)):
        w = words_of(batch.column(1).to_pylist())
        for form in forms:
            starts, owner = form.item_starts(w.first)
            ids, lists, edits = batch.column(0).take(pa.array(owner)), _lists(w.hashes, starts, form.run), pa.array(np.full(len(starts), form.max_edits, np.int32))
            for keys in form.keys(w.hashes, starts):
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), ids, lists, edits], ["key", "item_id", "y", "edits"])


def _doc_windows(batches):
    """(id, at, run, words) of the windows (at, run) that are asked for of each text."""
    for batch in batches:
        w = words_of(batch.column(1).to_pylist())
        rows, ats, runs, lists = [], [], [], []
        for i, asked in enumerate(batch.column(2).to_pylist()):
            for x in asked:
                rows.append(i), ats.append(x["at"]), runs.append(x["run"])
                lists.append(w.hashes[w.first[i] + x["at"] : w.first[i] + x["at"] + x["run"]].view(np.int64))
        cells = [pa.array(ats, pa.int32()), pa.array(runs, pa.int32()), pa.array(lists, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *cells], ["doc_id", "at", "run", "x"])


def _verified(batches):
    for batch in batches:
        rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())
        keep = [bool(_close(np.array([x]), np.array([y]), k)[0]) for x, y, k in rows]
        yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])


def _by_shuffle(left: DataFrame, right: DataFrame, forms: list[Form]) -> DataFrame:
    """Keys of all windows meet those of the items; the words of a window are fetched only if its key met one."""
    a = left.mapInArrow(partial(_keys, forms=forms), "key long, doc_id long, at int, run int")
    b = staged(right.mapInArrow(partial(_item_windows, forms=forms), "key long, item_id long, y array<long>, edits int"), "items")
    met = staged(a.join(b.select("key").distinct(), "key", "left_semi"), "met")
    asked = met.groupBy("doc_id").agg(F.collect_set(F.struct("at", "run")).alias("asked"))  # no more than a text has windows
    words = left.join(asked, "doc_id").select("doc_id", "text", "asked").mapInArrow(_doc_windows, "doc_id long, at int, run int, x array<long>").dropDuplicates(["doc_id", "at", "run", "x"])
    pairs = met.join(b, "key").join(words, ["doc_id", "at", "run"]).select("doc_id", "item_id", "x", "y", "edits").distinct()
    return pairs.mapInArrow(_verified, "doc_id long, item_id long").distinct()


def _found(docs: DataFrame, items: DataFrame, forms, columns: tuple[str, str, str, str], index_octets: int) -> DataFrame:
    doc_id, doc_text, item_id, item_text = columns
    left = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).cast("string").alias("text")).where("text is not null")
    right = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text is not null")
    # no fewer than the words of a text: marks that belong to letters cut none
    octets, longest = right.agg(F.sum(F.octet_length("text")), F.max(F.size(F.split("text", r"[^\p{L}\p{N}]+")))).first()
    forms = forms(longest or 0)
    if (octets or 0) * sum(len(f.plan) for f in forms) <= index_octets:
        rows = right.collect()
        indexes = [ItemIndex([r[0] for r in rows], [r[1] for r in rows], f) for f in forms]
        indexes = [x for x in indexes if len(x.keys)]
        return left.mapInArrow(partial(_search, indexes=indexes), "doc_id long, item_id long").distinct()
    return _by_shuffle(left, right, forms)


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", run: int = 12, max_edits: int = 0, recall: float = 0.95, index_octets: int = INDEX_OCTETS) -> DataFrame:
    """Distinct (doc_id, item_id): the text holds a window of `run` consecutive words of the item, up to `max_edits` word edits.

    With no edits allowed the result is exact; else pairs are found with a chance of at least about `recall` a window and
    all that are returned are right. Null, empty and shorter texts and items match nothing. Repeated item texts each give
    their own pairs; rows with the same id give their pairs once; other columns are ignored.
    """
    return _found(docs, items, lambda longest: [uniform_form(run, max_edits, recall)], (doc_id, doc_text, item_id, item_text), index_octets)


def find_edited_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = 12, max_edits: int = 2, recall: float = 0.9, index_octets: int = INDEX_OCTETS) -> DataFrame:
    """Distinct (doc_id, item_id): the text holds the item's opening or end, edited, in a window of about the item's size.

    An item of n words has windows of the largest length `least` * 2^k up to n: its first and its last words. A text's
    window of that length leaks it if their word edit distance is at most `max_edits`, one for each `least` words. Pairs
    returned are right; each is found with a chance of about `recall` at the worst edits, more at others. Items of fewer
    than `least` words, null and empty texts match nothing; repeated items each give their own pairs; rows with the same
    id give their pairs once; other columns are ignored.
    """
    return _found(docs, items, lambda longest: item_forms(longest, least, max_edits, recall), (doc_id, doc_text, item_id, item_text), index_octets)

"""Spelling variants against every pair of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import spelling

DOCUMENTS = "doc_id long, text string"


def words_by_hand(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_apart(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    return len(y) - len(x) == 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def variants_by_hand(n):
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and one_apart(v, w)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def shown(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def misspelt(rng, word, letters):
    at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
    if kind == 0:
        return word[:at] + rng.choice(letters) + word[at:]
    return word[:at] + ("" if kind == 1 else rng.choice(letters)) + word[at + 1 :]


def texts(rng, n_words, letters, lengths, syllables=None):
    words = []
    for _ in range(n_words):
        size = rng.choice(lengths)
        word = "".join(rng.choice(syllables or letters) for _ in range(size))[:size]
        words.append(word)
        for _ in range(rng.choice([0, 1, 1, 3])):
            words.append(misspelt(rng, words[-1], letters))
    out = []
    for w in words:
        out += [w] * rng.choice([1, 2, 3, 40, 500] if rng.random() < 0.3 else [2, 3])
    rng.shuffle(out)
    return [(i, " ".join(out[i * 200 : i * 200 + 200])) for i in range(len(out) // 200 + 1)]


@pytest.mark.parametrize("sample,block,portion", [(100_000, 20_000, 100_000), (40, 5, 50), (0, 3, 10)])
def test_variants_equal_every_pair(spark, sample, block, portion):
    rng = random.Random(12)
    rows = texts(rng, 300, "abcdeé", [6, 7, 8, 9, 12, 20, 40], ["tion", "ment", "ab", "cé", "de", "a", "b"])
    rows += texts(rng, 60, "ab", [7, 8])  # nearly all near one another
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    frame = spark.createDataFrame(rows, DOCUMENTS).repartition(4)
    got = shown(spelling.variants(frame, sample=sample, block=block, portion=portion))
    want = variants_by_hand(words_by_hand(rows))
    assert got == want and sum(r[4] > 3 for r in want) > 20 and sum(bool(r[1]) for r in want) > 20
    assert any(r[1] and r[2] != r[1] for r in want)  # chains of forms


def test_long_words(spark, monkeypatch):
    """Around and beyond the length from which words are looked up by their ends."""
    rng = random.Random(13)
    rows = []
    for size in (63, 64, 65, 255, 256, 257, 258, 259, 300, 5000):
        word = "".join(rng.choice("abc") for _ in range(size))
        family = [word] + [misspelt(rng, word, "abcz") for _ in range(5)] + [word[1:], word[:-1], word + "z", "z" + word, word[: size // 2] + "q" + word[size // 2 :]]
        for k, w in enumerate(family):
            rows += [(len(rows) + j, w) for j in range(2 + 30 * (k == 0))]
    # one text counts per document and word: slips are few, and found in the same way by hand
    monkeypatch.setattr(spelling, "SLICE", 40)
    got = shown(spelling.variants(spark.createDataFrame(rows, DOCUMENTS)))
    assert got == variants_by_hand(words_by_hand(rows))


def test_odd_texts(spark):
    assert spelling.variants(spark.createDataFrame([], DOCUMENTS)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, ""), (None, "short words 123 ×")], DOCUMENTS)).count() == 0
    rows = [(None, "ÀÉÎõü÷ßabc ABCDEFGH abcdefgh"), (1, "ÀÉÎõü÷ßabc abcdefgh_abcdefg"), (1, "ÀÉÎõü÷ßabc abcdefgh_abcdefg"), (2, "x" * 9 + "Ā" + "abcdefgh " * 3)]
    frame = spark.createDataFrame([(*r, "w", 5) for r in rows], DOCUMENTS + ", word string, n int")
    assert shown(spelling.variants(frame)) == variants_by_hand(words_by_hand(rows))
    with pytest.raises(ValueError, match="3 letters"):
        spelling.words(frame, letters=2)


def test_slices_keep_words_whole():
    rng = random.Random(14)
    text = "".join(rng.choice("abc  é.") for _ in range(3000)) + "z" * 100
    for size in (1, 7, 50, 5000):
        parts = list(spelling.slices(text, size))
        assert "".join(parts) == text
        assert [w for p in parts for w in spelling.RUN.findall(p)] == spelling.RUN.findall(text)


def test_words_ask_two_lists_that_one_edit_cannot_both_miss():
    """For every edit of a word, one of its two grams is among the edited word's, at the place where it is looked up."""
    rng = random.Random(15)
    sample = ["".join(rng.choice(["tion", "men", "ab", "c"]) for _ in range(5)) for _ in range(300)]
    held = spelling.dictionary(sample)
    assert {len(g) for g in held} >= {2, 3, 4} and all(g[:-1] in held for g in held if len(g) > 2)
    for word in rng.sample(sample, 60) + ["abababa", "aaaaaaaa", "tiontiontion"]:
        if len(word) < 7:
            continue
        a, first, b, second = spelling.asked(word, held)
        assert a + len(first) <= b
        edits = {word[:i] + word[i + 1 :] for i in range(len(word))}
        edits |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in "atz"}
        edits |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in "atz"}
        for other in edits - {word}:
            posted = {(r[0], r[2]) for r in spelling.postings(other, 1, held) if r[1] == spelling.MEMBER}
            by_start = (spelling.key_of(first), a) in posted
            by_end = (spelling.key_of(second), b + len(other) - len(word)) in posted
            assert by_start or by_end


def test_sifting_keeps_all_near_words():
    rng = random.Random(16)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(7, 10))) for _ in range(200)]
    held = spelling.Words(words)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(200), np.arange(200)))
    fit = np.abs(held.length[a] - held.length[b]) <= 1
    a, b = a[fit], b[fit]
    got = {(int(i), int(j)) for i, j in zip(a[held.near(a, b)], b[held.near(a, b)], strict=True)}
    assert got == {(int(i), int(j)) for i, j in zip(a, b, strict=True) if words[i] != words[j] and one_apart(words[i], words[j])}

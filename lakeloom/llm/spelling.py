"""Spelling variants: words one edit apart, found with an index of variable-length grams.

The dictionary holds the grams that are frequent among a bounded sample of the words (a word
and its end mark are cut into grams of two characters; only frequent grams are made longer).
It decides how words are cut, not what is found: the gram at a place is the shortest one from
there on that the dictionary does not hold, up to half the word. Grams are therefore short
where they are rare and long where they are common, and a place keeps its gram as long as
the characters of the gram stay.

An edit affects the grams that span it, and one at most of any that do not overlap. So a word
asks two lists only, those of its two rarest grams that do not overlap: with two grams of
which one edit affects one at most, every near word is in one of them. What precedes the
edit keeps its place from the start, what follows it its place from the end; the first gram
is looked up by the one, the second by the other. The members of a list that fit in place
and length are sifted by the parity of their characters and verified by their common start
and end. Lists with many members are dealt into parts, each of which meets all that ask.

Words of ``LONG`` characters or more are looked up by their first and last ``ANCHOR``
characters, which they would otherwise post a gram for each place.

Defined cases: null texts have no words, a null doc_id counts as an empty one. Texts count
whole, long ones slice by slice. Words that no word is near have no form and are their own
root. An empty table has no words. Repeated documents count as often as they come.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import strings
from lakeloom.session import pinned

RUN = re.compile("[a-zÀ-ÿ]+")  # after A-Z are lower-cased
OTHER = re.compile("[^a-zÀ-ÿ]")
SLIP = 31  # one run in so many loses a code point
LETTERS = 7  # of a word at least
TIMES = 2  # that it occurs at least
FACTOR = 10  # a form occurs so many times as often at least
SLICE = 1 << 20  # characters of a text that are cut into words at a time
HELD = 200_000  # words that a task counts before it hands them on
SAMPLE = 100_000  # words that the dictionary is fitted on, about
FREQUENT = 3  # a gram found more often among them is made longer
SHORTEST, LONGEST = 2, 16  # grams
PLACES = 32  # from either end at which a word posts grams
LONG = 256
ANCHOR = 64
BLOCK = 20_000  # members of a list that meet those that ask in one task
PORTION = 100_000  # rows that a task holds at a time, and one list more
PAIRS = 1 << 20  # that are sifted at a time
MARK = "$"  # end of a word
POSTED = "key long, kind int, start int, at int, size int, word string, n long"
LIST = ("key", "part", "turn")
NEAR = "word string, n_near long, near string, near_n long"


# -- words ---------------------------------------------------------------------------


def slices(text: str, size: int = SLICE):
    """The text in pieces that end between words."""
    start = 0
    while start < len(text):
        found = OTHER.search(text, start + size) if start + size < len(text) else None
        stop = found.start() if found else len(text)
        yield text[start:stop]
        start = stop


def slipped(run: str, crc: int, slip: int) -> str:
    """The run, or what is left of it if ``slip`` divides its checksum; ``crc`` is that of what comes before it."""
    h = zlib.crc32(run.encode(), crc)
    if h % slip:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(slip: int, letters: int):
    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, text in zip(ids, strings(batch, "text"), strict=True):
                crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                for piece in slices(lowered):
                    for found, n in Counter(RUN.findall(piece)).items():
                        word = slipped(found, crc, slip)
                        if len(word) >= letters:
                            total[word] += n
                    if len(total) > HELD:
                        yield _word_rows(total)
                        total = Counter()
        yield _word_rows(total)

    return run


def _word_rows(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
    )


def words(docs: DataFrame, slip: int = SLIP, letters: int = LETTERS, times: int = TIMES) -> DataFrame:
    """word and n, how often it occurs in all texts; ``letters`` is 3 at least, so that two grams fit in."""
    if letters < 3:
        raise ValueError("words of fewer than 3 letters have no two grams that do not overlap")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.filter("text is not null").mapInArrow(_counted(slip, letters), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


# -- grams ---------------------------------------------------------------------------


def dictionary(sample: list[str], frequent: int = FREQUENT) -> dict[str, int]:
    """Grams that occur more than ``frequent`` times in the sample, and how often; each one's beginnings are in it too."""
    marked = [w + MARK for w in sample]
    out: dict[str, int] = {}
    open_ = [(w, p) for w in marked for p in range(len(w) - SHORTEST + 1)]
    for size in range(SHORTEST, LONGEST):
        counts = Counter(w[p : p + size] for w, p in open_)
        out |= {g: n for g, n in counts.items() if n > frequent}
        open_ = [(w, p) for w, p in open_ if p + size < len(w) and counts[w[p : p + size]] > frequent]
    return out


def longest(n: int) -> int:
    """Characters of a gram in a word of n at most: two that do not overlap fit in, with the end mark."""
    return min((n + 1) // 2, LONGEST)


def grams(word: str, held: dict[str, int], most: int) -> list[str]:
    """The gram at each place."""
    marked = word + MARK
    end, out = len(marked), []
    for p in range(len(word)):
        q = p + SHORTEST
        while q < end and q - p < most and marked[p:q] in held:
            q += 1
        out.append(marked[p:q])
    return out


def asked(word: str, held: dict[str, int]) -> tuple[int, str, int, str]:
    """Place and gram of the two rarest grams that do not overlap."""
    found = grams(word, held, longest(len(word)))
    cost = [held.get(g, 0) for g in found]
    n = len(found)
    # the rarest gram that ends before each place
    ahead: list[int | None] = [None] * (n + 2)
    for p in range(min(n, PLACES)):
        end = p + len(found[p])
        if end <= n and (ahead[end] is None or cost[p] < cost[ahead[end]]):
            ahead[end] = p
    best, pair = None, (0, 0)
    for p in range(1, n):
        if ahead[p - 1] is not None and (ahead[p] is None or cost[ahead[p - 1]] <= cost[ahead[p]]):
            ahead[p] = ahead[p - 1]
        if ahead[p] is not None and n - p <= PLACES and (best is None or cost[ahead[p]] + cost[p] < best):
            best, pair = cost[ahead[p]] + cost[p], (ahead[p], p)
    a, b = pair
    return a, found[a], b, found[b]


def key_of(gram: str) -> int:
    return xxhash.xxh64_intdigest(gram.encode()) - (1 << 63)


MEMBER, FROM_START, FROM_END, LONG_MEMBER, LONG_ASKS = range(5)


def postings(word: str, n: int, held: dict[str, int]):
    """Rows (key, kind, start, at, size, word, n): the word as a member of lists, and where it asks.

    ``start`` is the place of the gram that is looked up from the start, ``size`` its length;
    ``at`` is the place of the gram that the row is about.
    """
    size = len(word)
    if size <= LONG + 1:
        posted = set()
        # as a partner of words one shorter, as long, and one longer
        for most in {longest(size - 1), longest(size), longest(size + 1)}:
            for p, gram in enumerate(grams(word, held, most)):
                if p < PLACES or size - p <= PLACES:
                    posted.add((p, gram))
        for p, gram in posted:
            yield key_of(gram), MEMBER, p, p, len(gram), word, n
        a, first, b, second = asked(word, held)
        yield key_of(first), FROM_START, a, a, len(first), word, n
        yield key_of(second), FROM_END, a, b, len(first), word, n
    if size >= LONG:
        for mark, part in (("^", word[:ANCHOR]), (MARK, word[-ANCHOR:])):
            yield key_of(mark + mark + part), LONG_MEMBER, 0, 0, ANCHOR, word, n
            yield key_of(mark + mark + part), LONG_ASKS, 0, 0 if mark == "^" else size, ANCHOR, word, n


def _posted(held: dict[str, int]):
    def run(batches):
        for batch in batches:
            found = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for part in _chunks((row for w, n in found for row in postings(w, n, held)), PORTION):
                columns = list(zip(*part, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in POSTED.split(", ")]
                )

    return run


def _chunks(rows, size: int):
    part = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part


# -- lists ---------------------------------------------------------------------------


class Words:
    """Words as rows of characters: from the start, and from the end; and the parity of each one's characters."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.length = np.array([len(t) for t in texts], np.int64)
        width = int(self.length.max(initial=0)) + 1
        raw = np.frombuffer("".join(texts).encode("latin-1"), np.uint8)
        row = np.repeat(np.arange(len(texts)), self.length)
        at = np.arange(len(raw)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        self.left = np.zeros((len(texts), width), np.uint8)  # a zero ends every word
        self.left[row, at] = raw
        self.right = np.zeros((len(texts), width), np.uint8)
        self.right[row, self.length[row] - 1 - at] = raw
        self.parity = np.zeros(len(texts), np.uint64)
        np.bitwise_xor.at(self.parity, row, np.uint64(1) << (raw & 63).astype(np.uint64))

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs differ by one inserted, deleted or replaced character."""
        sifted = np.flatnonzero(np.bitwise_count(self.parity[a] ^ self.parity[b]) <= 2)
        a, b = a[sifted], b[sifted]
        same = (self.left[a] == self.left[b]) & (self.left[a] != 0)
        ahead = np.argmin(same, axis=1)  # the last column is never the same
        same = (self.right[a] == self.right[b]) & (self.right[a] != 0)
        behind = np.argmin(same, axis=1)
        most = np.maximum(self.length[a], self.length[b])
        equal = (ahead == self.length[a]) & (ahead == self.length[b])
        return sifted[(ahead + behind >= most - 1) & ~equal]


def one_edit(x: str, y: str) -> bool:
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    x, y = sorted((x, y), key=len)
    ahead = next((i for i, c in enumerate(x) if c != y[i]), len(x))
    return x[ahead:] == y[ahead + 1 :] or (len(x) == len(y) and x[ahead + 1 :] == y[ahead + 1 :])


def _spans(codes: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(index into low, index into codes) of the codes in each range, in portions."""
    first, last = np.searchsorted(codes, low), np.searchsorted(codes, high)
    count = last - first
    some = np.flatnonzero(count > 0)
    total = np.cumsum(count[some])
    at = 0
    while at < len(some):
        base = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, base + PAIRS, side="right")))
        part = some[at:stop]
        n = count[part]
        yield np.repeat(part, n), np.repeat(first[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at = stop


def _short_pairs(lists: np.ndarray, cols: dict[str, np.ndarray], texts: list[str]):
    """(asking row, member row) of the near words; each pair once for the word that asks."""
    held = Words(texts)
    kind, at, size = cols["kind"], cols["at"].astype(np.int64), held.length
    members = np.flatnonzero(kind == MEMBER)
    side = 4 * (LONG + 4)
    for asks, place in ((FROM_START, at), (FROM_END, size - at)):
        code = (lists * side + place) * side + size  # list, place from that end, length
        order = members[np.argsort(code[members], kind="stable")]
        asking = np.flatnonzero(kind == asks)
        for i, j in _spans(code[order], code[asking] - 1, code[asking] + 2):
            a, b = asking[i], order[j]
            near = held.near(a, b)
            a, b = a[near], b[near]
            start, width = cols["start"][a], cols["size"][a]
            marked = [texts[y] + MARK for y in b.tolist()]
            same = np.array(
                [m[s : s + w] == (texts[x] + MARK)[s : s + w] for m, x, s, w in zip(marked, a.tolist(), start.tolist(), width.tolist(), strict=True)], bool
            )
            # from the end only what the first gram does not find
            keep = same if asks == FROM_START else ~same
            yield a[keep], b[keep]


def _long_pairs(lists: np.ndarray, cols: dict[str, np.ndarray], texts: list[str]):
    """The same of long words, compared one by one; by their ends only what their starts do not find.

    Pairs of words that post grams besides are found by these.
    """
    members: dict[int, list[int]] = {}
    for j in np.flatnonzero(cols["kind"] == LONG_MEMBER).tolist():
        members.setdefault(int(lists[j]), []).append(j)
    for i in np.flatnonzero(cols["kind"] == LONG_ASKS).tolist():
        x, by_end = texts[i], cols["at"][i] > 0
        found = [
            j
            for j in members.get(int(lists[i]), ())
            if max(len(x), len(texts[j])) > LONG + 1
            and one_edit(x, texts[j])
            and not (by_end and x[:ANCHOR] == texts[j][:ANCHOR])
        ]
        yield np.full(len(found), i), np.array(found, np.int64)


def _met(portion: int):
    """Per word that asks in a list: how many near words are in it, and the one of them that occurs most."""

    def found(table: pa.Table) -> pa.RecordBatch:
        cols = {c: table.column(c).to_numpy() for c in ("kind", "start", "at", "size", "n")}
        keys = np.stack([table.column(c).to_numpy() for c in LIST])
        lists = np.cumsum(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0))))
        texts = table.column("word").to_pylist()
        best: dict[int, tuple] = {}
        for a, b in _pairs(lists, cols, texts):
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                rank = (-int(cols["n"][y]), texts[y])
                known = best.get(x)
                best[x] = (1, rank) if known is None else (known[0] + 1, min(known[1], rank))
        rows = [(texts[x], n, word, -less) for x, (n, (less, word)) in best.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "n_near", "near", "near_n"]
        )

    def run(batches):
        kept, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch)
            held += batch.num_rows
            if held < portion:
                continue
            table = pa.Table.from_batches(kept).combine_chunks()
            keys = np.stack([table.column(c).to_numpy() for c in LIST])
            other = np.flatnonzero((keys != keys[:, -1:]).any(axis=0))
            cut = int(other[-1]) + 1 if len(other) else 0  # the last list may go on in the next batch
            if cut:
                yield found(table.slice(0, cut).combine_chunks())
            kept, held = table.slice(cut).to_batches(), table.num_rows - cut
        if held:
            yield found(pa.Table.from_batches(kept).combine_chunks())

    return run


def _pairs(lists, cols, texts):
    short = np.flatnonzero(cols["kind"] <= FROM_END)
    if len(short):
        own = {c: v[short] for c, v in cols.items()}
        for a, b in _short_pairs(lists[short], own, [texts[i] for i in short.tolist()]):
            yield short[a], short[b]
    if len(short) < len(texts):
        yield from _long_pairs(lists, cols, texts)


def near_words(counted: DataFrame, sample: int = SAMPLE, block: int = BLOCK, portion: int = PORTION) -> DataFrame:
    """word, n_near, near (the near word that occurs most, the first of several) and near_n, of words that have one."""
    spark = counted.sparkSession
    short = counted.filter(F.char_length("word") <= LONG)
    # as many words as the sample wants, give or take their root, by hash: no task sends more than its share
    rate = min(1.0, sample / max(1, short.count()))
    chosen = short.filter(F.shiftrightunsigned(F.xxhash64("word"), 1) <= min(int(rate * 2.0**63), (1 << 63) - 1))
    drawn = [r[0] for r in chosen.select("word").collect()]
    held = spark.sparkContext.broadcast(dictionary(drawn))  # follows the sample, which is bounded

    def post(batches):
        yield from _posted(held.value)(batches)

    posted = pinned(counted.select("word", "n").mapInArrow(post, POSTED))
    is_member = F.col("kind").isin(MEMBER, LONG_MEMBER)
    sizes = posted.groupBy("key").agg(F.count_if(is_member).alias("members"), F.count_if(~is_member).alias("asks"))
    # lists that nobody asks, or that hold none but the word that asks, are left
    sizes = sizes.filter("asks > 0 and members > 1")
    sizes = pinned(sizes.select("key", *[F.ceil(F.col(c) / block).cast("int").alias(f"{c}_parts") for c in ("members", "asks")]))

    def part(mine: bool, column: str):
        """Which parts of one side a row is in: its own one, or as one of the other side all."""
        own = F.pmod(F.xxhash64("word", "at"), F.col(f"{column}_parts")).cast("int")
        every = F.expr(f"sequence(0, {column}_parts - 1)")
        return F.explode(F.when(is_member if mine else ~is_member, F.array(own)).otherwise(every))

    # members and those that ask are both dealt into parts, and every two parts meet
    rows = posted.join(sizes, "key").withColumn("part", part(True, "members")).withColumn("turn", part(False, "asks"))
    dealt = rows.drop("members_parts", "asks_parts").repartition(*LIST).sortWithinPartitions(*LIST)
    found = dealt.mapInArrow(_met(portion), NEAR)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """word and root of the words that have a form: the last one when forms are followed.

    A form occurs at least ``FACTOR`` times as often as its word, so chains are short; each
    round doubles the way that has been followed.
    """
    now = pinned(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        on = pinned(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if on.filter("moved").isEmpty():
            return on.select("word", "root")
        now = on.select("word", "root")


def variants(docs: DataFrame, factor: int = FACTOR, **how) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word."""
    counted = pinned(words(docs))
    near = pinned(near_words(counted, **how))
    known = counted.join(near, "word", "left")
    is_form = F.col("near_n") >= factor * F.col("n")
    named = pinned(
        known.select(
            "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        )
    )
    last = roots(named.filter("form is not null"))
    return named.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

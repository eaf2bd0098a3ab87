"""Benchmark decontamination with suffix arrays of the training text.

Every task cuts its training documents into shards of about ``SHARD_BYTES``.  For each shard it
builds a sparse suffix array over words: only positions whose first ``GRAM`` words open a test
suffix (by a hash set; the others cannot match), sorted by their next ``window`` words within their
document and not further.  Of the test suffixes, those whose opening occurs in the shard are
binary-searched in it; the places that share a suffix's first ``window`` words form one range of the
array.  Nothing is lost: windows are at most ``window`` words, and longer matches are joined.  Ranges give the matching places, and matches that continue each other along
one item are joined to the longest verbatim match with its location in document and item.

Words are runs of letters, digits and non-ASCII bytes, A-Z lower-cased.  A window is ``window``
consecutive words of an item; an item of fewer words, but not none, is one window.  Words are
compared by 64-bit names without algebraic structure (``common.names``).

The items are the stated query set: they are searched in blocks of at most ``ITEM_BLOCK_BYTES``
of text, one pass over the documents for each block, and only one block at a time is collected
and broadcast.

Edge cases: null or wordless texts have no words and no hits; null or wordless items have no
windows; a null item_id counts as the item ``''``; repeated item ids count once; repeated rows
repeat their results; an empty benchmark hits nothing; input columns named like an output column
are replaced; a text longer than a shard is a shard of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, map_blocks, ship, wrapped

WINDOW = 10
GRAM = 4
SHARD_BYTES = 4 << 20
ITEM_BLOCK_BYTES = 16 << 20
#: Places of a shard times items that hold their window, worked on at a time.
PAIRS = 1 << 20
MATCHES = "array<struct<item: string, item_word: int, doc_word: int, words: int>>"

#: Word bytes: 0-9, a-z (after lower-casing) and everything beyond ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True


def suffix_keys(words: Words, at: np.ndarray, depth: int) -> np.ndarray:
    """The next ``depth`` words of each place as numbers above 0; 0 from the document's end on."""
    left, out = words.left_in_row()[at], np.zeros((len(at), depth), np.uint64)
    for j in range(depth):
        ok = left > j
        out[ok, j] = words.hash[at[ok] + j] | np.uint64(1)
    return out


class TestSuffixes:
    """The windows of a block of items: word keys, length, and the items and places they come from."""

    __test__ = False

    def __init__(self, ids: list[str], texts: list[str | None], window: int = WINDOW):
        data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        offs = np.r_[0, np.cumsum([len(d) for d in data])].astype(np.int64)
        words = Words(np.frombuffer(b"".join(data), np.uint8), offs, IS_WORD)
        counts = np.diff(words.first)
        left = words.left_in_row()
        row = np.repeat(np.arange(len(counts)), counts)
        size = np.minimum(counts[row], window)
        at = np.flatnonzero(left >= size)  # every place from which a whole window runs
        self.window, self.ids = window, list(ids)
        self.keys, self.size = suffix_keys(words, at, window), size[at].astype(np.int32)
        self.keys[np.arange(window)[None, :] >= self.size[:, None]] = 0
        self.item, self.place = row[at].astype(np.int32), (at - words.first[row[at]]).astype(np.int32)
        # equal windows are searched once
        order = np.lexsort([self.item, *self.keys.T[::-1], self.size])
        k, s = self.keys[order], self.size[order]
        new = np.r_[True, (k[1:] != k[:-1]).any(1) | (s[1:] != s[:-1])] if len(k) else np.zeros(0, bool)
        self.keys, self.size, self.item, self.place = k[new], s[new], self.item[order], self.place[order]
        self.group = np.r_[np.flatnonzero(new), len(k)]
        self.gram = min(GRAM, int(self.size.min(initial=GRAM)))
        self.opening = opening(self.keys, self.gram)
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.opening >> np.uint64(42)] = True


def opening(keys: np.ndarray, gram: int) -> np.ndarray:
    out = np.zeros(len(keys), np.uint64)
    for j in range(gram):
        out = (out + keys[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def openings(words: Words, gram: int) -> np.ndarray:
    """The same for each place of a shard."""
    n, out = len(words.hash), np.zeros(len(words.hash), np.uint64)
    h = words.hash | np.uint64(1)
    for j in range(gram):
        out[:max(0, n - j)] += h[j:]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def bound(array: np.ndarray, keys: np.ndarray, size: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of every key at once: first place not below it, or past those that open with it."""
    lo, hi = np.zeros(len(keys), np.int64), np.full(len(keys), len(array), np.int64)
    inside = np.arange(keys.shape[1])[None, :] < size[:, None]
    rows = np.arange(len(keys))
    while (lo < hi).any():
        mid = np.minimum((lo + hi) >> 1, len(array) - 1)
        have = array[mid]
        differs = (have != keys) & inside
        first = differs.argmax(1)
        equal = ~differs[rows, first]
        below = (have[rows, first] < keys[rows, first]) & ~equal
        right = (below | equal if after else below) & (lo < hi)
        lo, hi = np.where(right, mid + 1, lo), np.where(right | (lo >= hi), hi, mid)
    return lo


def spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) for all values lo[i] <= value < hi[i]."""
    n = hi - lo
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[i]


def shard_matches(words: Words, tests: TestSuffixes) -> dict[int, tuple[list[dict], list[str]]]:
    """row -> (its longest verbatim matches, the items whose windows occur), by the shard's suffix array.

    A stretch of words that several items hold is one match, of the first of them: a window that many items
    share and a document repeats gives a match for each place, and its items once."""
    if not len(tests.keys) or not len(words.hash):
        return {}
    open_ = openings(words, tests.gram)
    at = np.flatnonzero(tests.seen[open_ >> np.uint64(42)] & (words.left_in_row() >= tests.gram))
    at = at[np.isin(open_[at], tests.opening)]
    want = np.flatnonzero(np.isin(tests.opening, open_[at]))
    if not len(at) or not len(want):
        return {}
    keys = suffix_keys(words, at, tests.window)
    order = np.lexsort(keys.T[::-1])  # the shard's suffix array
    array, at = keys[order], at[order]
    lo, hi = (bound(array, tests.keys[want], tests.size[want], after) for after in (False, True))
    which, place = spread(lo, hi)
    if not len(which):
        return {}
    which, start = want[which], at[place]  # at most one window of each length for a place
    row = np.searchsorted(words.first, start, side="right") - 1
    word = start - words.first[row]
    out: dict[int, tuple[list[dict], list[str]]] = {}
    # items: of every window that a row holds, once
    key = np.unique(row * np.int64(len(tests.group)) + which)
    r, g = key // len(tests.group), key % len(tests.group)
    ends = np.r_[np.flatnonzero(r[1:] != r[:-1]) + 1, len(r)]
    for k, end in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()):
        of = np.unique(np.concatenate([tests.item[tests.group[x]:tests.group[x + 1]] for x in g[k:end].tolist()]))
        out[int(r[k])] = ([], [tests.ids[i] for i in of.tolist()])
    # windows that continue each other on one diagonal are one longer match; the items go in slices
    pairs = int((tests.group[which + 1] - tests.group[which]).sum())
    slices = -(-pairs // PAIRS)
    edge = np.linspace(0, len(tests.ids), slices + 1).astype(np.int64)
    found = [np.empty((0, 5), np.int64)]
    for first, last in zip(edge[:-1], edge[1:]):
        a, z = (tests.group[which] + _below(tests, which, x) for x in (first, last))
        i, source = spread(a, z)
        if not len(i):
            continue
        got = np.stack([row[i], tests.item[source].astype(np.int64), tests.place[source].astype(np.int64), word[i], tests.size[which[i]].astype(np.int64)])
        r, m, f, w, n = got[:, np.lexsort((got[3], got[3] - got[2], got[1], got[0]))]
        new = np.r_[True, (r[1:] != r[:-1]) | (m[1:] != m[:-1]) | (w[1:] - f[1:] != w[:-1] - f[:-1]) | (w[1:] != w[:-1] + 1)]
        head = np.flatnonzero(new)
        length = np.r_[head[1:], len(r)] - head - 1 + n[head]
        # row, word, words; then item and its word: the first item of each stretch stays
        found.append(np.stack([r[head], w[head], length, m[head], f[head]], axis=1))
        one = np.concatenate(found)
        one = one[np.lexsort(one.T[::-1])]
        found = [one[np.r_[True, (one[1:, :3] != one[:-1, :3]).any(1)]]]
    for r, w, n, m, f in found[0].tolist():
        out[r][0].append({"item": tests.ids[m], "item_word": f, "doc_word": w, "words": n})
    return out


def _below(tests: TestSuffixes, which: np.ndarray, item: int) -> np.ndarray:
    """How many sources of each window (sorted by item) belong to items before ``item``."""
    one, back = np.unique(which, return_inverse=True)
    return np.array([np.searchsorted(tests.item[tests.group[x]:tests.group[x + 1]], item) for x in one.tolist()], np.int64)[back]


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, item_block_bytes: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words`` (long), ``matches`` (an item, its word, the document's word, length) and ``items`` (all that occur)."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.col("text").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = -(-total // item_block_bytes) or 1
    out, found = docs, []
    for k in range(parts):
        block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k).collect() if total else []
        load = ship(spark, TestSuffixes([r.id for r in block], [r.text for r in block], window))
        name, held = ("matches", "items") if parts == 1 else (f"__matches_{k}", f"__items_{k}")

        def start(load=load):
            tests = load()

            def rows(batch, buf, offs):
                words = Words(buf, offs, IS_WORD)
                by_row = shard_matches(words, tests)
                none = ([], [])
                return [pa.array(np.diff(words.first), pa.int64()), *([by_row.get(i, none)[j] for i in range(batch.num_rows)] for j in (0, 1))]
            return rows

        out = map_blocks(out, text, f"n_words bigint, {name} {MATCHES}, {held} array<string>", start, SHARD_BYTES)
        found.append((name, held))
    if parts > 1:
        out = out.withColumns({"matches": F.concat(*(m for m, _ in found)), "items": F.concat(*(i for _, i in found))}).drop(*(c for f in found for c in f))
    return out


def flag(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``matches`` and n_hit (words inside any match), items (sorted ids), n_items, contaminated."""
    out = matches(docs, benchmark, **options)
    n_hit = F.expr("""aggregate(array_sort(transform(matches, m -> struct(m.doc_word as a, m.doc_word + m.words as b))),
        struct(0 as upto, 0L as n),
        (s, m) -> struct(greatest(s.upto, m.b) as upto, s.n + greatest(0, m.b - greatest(s.upto, m.a)) as n), s -> s.n)""")
    return out.withColumns({"n_hit": n_hit, "items": F.expr("array_sort(array_distinct(items))")}).withColumns(
        {"n_items": F.size("items").cast("long"), "contaminated": F.col("n_hit") > 0})


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any test window, with their own columns."""
    return flag(wrapped(docs, text="text"), benchmark, **options).where(~F.col("contaminated")).select("__row.*")


def digests() -> list:
    return [F.col("n_words"), F.col("n_hit"), F.col("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), F.col("contaminated")]

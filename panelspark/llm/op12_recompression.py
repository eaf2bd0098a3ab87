"""Removal of passages that repeat across documents, found by recompression.

A word goes if it is covered by a window of ``window`` consecutive words whose sequence also starts in
a document with a smaller doc_id.  Windows are judged on the input.

Recompression rewrites the word sequences of all documents in rounds.  A round names maximal runs of one
symbol (every ``RUNS_EVERY`` rounds) and then the pairs whose left symbol drew heads and whose right
symbol drew tails; coins and names depend on the symbols alone, so they are the same everywhere, and equal
substrings get equal symbols but for a few at their ends.  ``rounds`` keeps for every symbol the words on
which its forming depended; a symbol whose words all lie inside a window is interior to
it and stands at the same place in every other occurrence of that window.  A window's
symbol is the interior one with the smallest hash after the last round (or the last one that has any), so
windows fall into stretches of neighbours with one symbol, about one symbol for 15 words.

1. Naming.  Spark counts the symbols of all documents.  Windows whose symbol stands in one document alone cannot
   repeat; only documents with shared symbols are looked at again, at those places.
2. Stretches.  All windows of one symbol and place are a stretch of ``window`` words and more.  A stretch that
   also stands in a document with a smaller id is gone as a whole.  Long repeats end here, with a row
   per symbol instead of one per window.
3. Windows.  Of every distinct stretch the occurrences in the smallest document are taken apart into their windows,
   and a window that also starts in a smaller document is gone.  An equal stretch elsewhere
   holds the same windows, so nothing is missed.
4. What is gone is cut from the texts.

Stretches and windows are verified by 128-bit names of their words (``strong``), of which none
is derived from a symbol's name.  Equal texts are collapsed to one before the rounds; copies of the
smallest id lose all their windows.

Edge cases: null text has no words; texts shorter than ``window`` words lose nothing; rows with a null doc_id lose
nothing and take nothing from others; rows that agree in doc_id take nothing from each other; repeated rows give
equal results; empty tables give empty results; input columns named like an output column are
replaced.  A long run of one word has no symbol but its words, and then costs a row for each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Scratch, blocks, mix, text_bytes, unwrapped, wrapped
from .op6_suffix_dedup import distinct_texts, runs
from .strong import StrongWords, spans_names

WINDOW = 50
#: Runs are named in every so many rounds: each time costs a symbol at both ends of what is interior.
RUNS_EVERY = 4
#: So many symbols of the last round a window holds or more, on average.
SYMBOLS = 12
U64 = np.uint64
K1, K2, K3 = U64(0x9FB21C651E98DF25), U64(0xA24BAED4963EE407), U64(0xD1B54A32D192ED03)

#: Word bytes: all but white space.
IS_WORD = np.ones(256, bool)
IS_WORD[0x20] = IS_WORD[0x09:0x0E] = False


# -- recompression -------------------------------------------------------------------------------
def how_many(window: int) -> int:
    """Rounds after which a window still holds several symbols: one leaves three quarters of them."""
    return int(math.log(max(1.0, window / SYMBOLS)) / math.log(4 / 3))


def rounds(name: np.ndarray, first: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (name, lo, hi) of the symbols after each round, words themselves first.

    Words lo..hi - 1 decided how the symbol was formed; where the end of a row had a part in it,
    they reach beyond the row.  ``first`` has the first word of each row, and the end.
    """
    n = len(name)
    row = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
    lo, hi = np.arange(n, dtype=np.int64), np.arange(1, n + 1, dtype=np.int64)
    yield name, lo, hi
    for k in range(1, most + 1):
        salt = mix(np.full(1, k, U64) * K3)
        if k % RUNS_EVERY == 1:
            head = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (row[1:] != row[:-1])])
            tail = np.r_[head[1:], len(name)] - 1
            size = (tail - head + 1).astype(U64)
            opens, closes = _edges(row)
            lo_, hi_ = np.r_[-1, lo[:-1]], np.r_[hi[1:], n + 1]
            lo = np.where(opens[head], first[row[head]] - 1, lo_[head])
            hi = np.where(closes[tail], first[row[tail] + 1] + 1, hi_[tail])
            name, row = np.where(size > U64(1), mix(name[head] * K1 ^ mix(size * K2 + salt)), name[head]), row[head]
        heads = mix(name + salt) & U64(1) == U64(0)
        opens, closes = _edges(row)
        joins = heads & ~closes
        joins[:-1] &= ~heads[1:]
        alone_r = ~heads
        alone_r[1:] &= ~joins[:-1]
        # alone: heads for want of tails to the right, tails for want of heads to the left
        hi_next = np.where(closes, first[row + 1] + 1, np.r_[hi[1:], n + 1])
        lo_before = np.where(opens, first[row] - 1, np.r_[-1, lo[:-1]])
        hi = np.where(heads, hi_next, hi)  # a joined pair ends with its right symbol, which is the next one
        lo = np.where(alone_r, lo_before, lo)
        right = np.r_[name[1:], U64(0)] if len(name) else name
        name = np.where(joins, mix(mix(name * K1 + salt) + right * K2), name)
        keep = np.r_[True, ~joins[:-1]]
        name, lo, hi, row = name[keep], lo[keep], hi[keep], row[keep]
        yield name, lo, hi


def _edges(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each symbol opens or closes its row."""
    change = row[1:] != row[:-1]
    return np.r_[True, change], np.r_[change, True]


def first_least(value: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Place of the leftmost smallest value in each range (none of them empty)."""
    bits = U64(max(1, int(len(value)).bit_length()))
    packed = (value >> bits << bits) | np.arange(len(value), dtype=U64)
    size, out = stop - start, np.empty(len(start), U64)
    have, most = 1, int(size.max())
    while True:
        here = np.flatnonzero((size >= have) & (size < 2 * have))
        out[here] = np.minimum(packed[start[here]], packed[stop[here] - have])
        if 2 * have > most:
            return (out & ((U64(1) << bits) - U64(1))).astype(np.int64)
        packed, have = np.minimum(packed[:-have], packed[have:]), 2 * have


def stretches(name: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, symbol, first window, number of windows) of the neighbouring windows with one symbol."""
    size = np.diff(first)
    long = np.flatnonzero(size >= window)
    if not len(long):
        none = np.empty(0, np.int64)
        return none, none.astype(U64), none, none
    # the rows that have windows, side by side
    name, ends = name[np.repeat(size >= window, size)], np.cumsum(size[long])
    here = np.r_[0, ends]
    fewer = size[long] - window + 1
    starts = np.arange(fewer.sum()) + np.repeat(np.arange(len(long)) * (window - 1), fewer)
    row = np.repeat(np.arange(len(long)), fewer)
    symbol, own = np.zeros(len(starts), U64), np.full(len(starts), -1, np.int64)
    left, seen = np.arange(len(starts)), 0  # windows that have no symbol yet
    for k, (names, lo, hi) in reversed(list(enumerate(rounds(name, here, how_many(window))))):
        # symbols whose words lie in the window: lo and hi never decrease
        a = np.cumsum(np.bincount(lo + 1, minlength=len(name) + 2))[starts[left]]
        z = np.cumsum(np.bincount(hi, minlength=len(name) + 2))[starts[left] + window]
        ok = np.flatnonzero(a < z)
        if len(ok):
            j = first_least(mix(names + mix(np.full(1, k, U64))), a[ok], z[ok])
            one, back = np.unique(j, return_inverse=True)
            full = spans_names([name], lo[one], hi[one] - lo[one])[0]  # all words that formed it
            symbol[left[ok]] = mix(names[one] + full)[back]
            own[left[ok]] = seen + j
            seen += len(names)
            rest = np.ones(len(left), bool)
            rest[ok] = False
            left = left[rest]
        if not len(left):
            break
    head = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (row[1:] != row[:-1])])
    count = np.diff(np.r_[head, len(starts)])
    of = row[head]
    return long[of], symbol[head], first[long[of]] + starts[head] - here[of], count


# -- Spark rounds ------------------------------------------------------------------------------------
def _symbols(texts: DataFrame, window: int) -> DataFrame:
    """(symbol, key of the text, its smallest doc_id, first window, number of windows)."""
    schema = StructType.fromDDL("symbol bigint, __k1 bigint, __k2 bigint, __doc bigint, lo int, n int")

    def run(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(3))
            for top, end, part, at in blocks(buf, offs):
                words = StrongWords(part, at, IS_WORD, lower=False, halves=1)
                row, symbol, lo, n = stretches(words.names[0], words.first, window)
                of = pa.array(top + row)
                yield pa.RecordBatch.from_arrays([pa.array(symbol.view(np.int64)), *(b.column(i).take(of) for i in range(3)), pa.array((lo - words.first[row]).astype(np.int32)), pa.array(n.astype(np.int32))], names=schema.names)

    return texts.where("__doc IS NOT NULL").select("__k1", "__k2", F.col("__doc").cast("long").alias("__doc"), "__text").mapInArrow(run, schema)


def _named(texts: DataFrame, want: DataFrame, window: int, apart: bool) -> DataFrame:
    """128-bit names of the wanted stretches of windows, or (apart) of each of their windows."""
    schema = StructType.fromDDL("w1 bigint, w2 bigint, __k1 bigint, __k2 bigint, __doc bigint, lo int, n int")

    def run(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(3))
            wanted = b.column(4)
            ends = wanted.offsets.to_numpy().astype(np.int64)
            lo_all, n_all = (x.to_numpy().astype(np.int64) for x in wanted.values.flatten())
            for top, end, part, at in blocks(buf, offs):
                words = StrongWords(part, at, IS_WORD, lower=False)
                cut = slice(ends[top], ends[end])
                row = np.repeat(np.arange(end - top), np.diff(ends[top:end + 1]))
                lo, n = lo_all[cut], n_all[cut]
                if apart:
                    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                    row, lo = np.repeat(row, n), np.repeat(lo, n) + place
                    n = np.ones(len(lo), np.int64)
                for i in range(0, len(lo), 16384):
                    r, x, m = row[i:i + 16384], lo[i:i + 16384], n[i:i + 16384]
                    w1, w2 = spans_names(words.names, words.first[r] + x, m + window - 1)
                    of = pa.array(top + r)
                    yield pa.RecordBatch.from_arrays([pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), *(b.column(c).take(of) for c in range(3)), pa.array(x.astype(np.int32)), pa.array(m.astype(np.int32))], names=schema.names)

    rows = texts.join(want.groupBy("__k1", "__k2").agg(F.collect_list(F.struct("lo", "n")).alias("want")), ["__k1", "__k2"])
    return rows.select("__k1", "__k2", F.col("__doc").cast("long").alias("__doc"), "__text", "want").mapInArrow(run, schema)


def _earlier(named: DataFrame, scratch: Scratch) -> DataFrame:
    """``named`` with ``gone``: whether its words stand in a document with a smaller id."""
    first = named.groupBy("w1", "w2").agg(F.min("__doc").alias("first"), F.max("__doc").alias("last")).where("first < last").select("w1", "w2", "first")
    first = scratch.write(first, "first")  # written, so that a hot passage's part of the join can be split
    return named.join(first, ["w1", "w2"], "left").withColumn("gone", F.coalesce(F.col("first") < F.col("__doc"), F.lit(False)))


def repeated(texts: DataFrame, scratch: Scratch, window: int = WINDOW) -> DataFrame:
    """(k1, k2, lo, n): runs of windows of the texts (with key and smallest doc_id) that are gone."""
    found = scratch.write(_symbols(texts, window), "symbols")
    shared = found.groupBy("symbol").agg(F.min("__doc").alias("a"), F.max("__doc").alias("b")).where("a < b").select("symbol")
    again = found.join(scratch.write(shared, "shared"), "symbol")
    long = scratch.write(_named(texts, again, window, apart=False), "stretches")
    long = scratch.write(_earlier(long, scratch).select("__k1", "__k2", "lo", "n", "gone"), "judged")
    each = scratch.write(_named(texts, long.where("not gone"), window, apart=True), "windows")
    each = _earlier(each, scratch)
    return long.where("gone").unionByName(each.where("gone").select(*long.columns)).select("__k1", "__k2", "lo", "n")


# -- results -----------------------------------------------------------------------------------------
#: Which rows of a text a result is for: of its smallest doc_id, of a larger one, of none.
OWN, COPY, UNKNOWN = 0, 1, 2


def _cut(rows: DataFrame, window: int) -> DataFrame:
    """(k1, k2, doc, case, n_words, removed, kept) of each text and case that it has rows for."""
    schema = StructType.fromDDL("__k1 bigint, __k2 bigint, __doc bigint, case int, n_words bigint, removed array<struct<start: bigint, stop: bigint>>, kept string")
    types = [pa.int32(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.string()]

    def joined(data, words, a: int, b: int, keep: np.ndarray | None) -> str:
        s, e = words.start[a:b], words.end[a:b]
        if keep is not None:
            s, e = s[keep], e[keep]
        if not len(s):
            return ""
        size = e - s + 1
        ends = np.cumsum(size)
        src = np.repeat(s - ends + size, size) + np.arange(ends[-1])
        out = data[np.minimum(src, len(data) - 1)]
        out[ends - 1] = 0x20
        return out[:-1].tobytes().decode()

    def run(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(3))
            docs, copies, gone = b.column(2), b.column(4).to_pylist(), b.column(5)
            for top, end, part, at in blocks(buf, offs):
                words = StrongWords(part, at, IS_WORD, lower=False, halves=0)
                out, take = [], []
                for r in range(end - top):
                    a, z = int(words.first[r]), int(words.first[r + 1])
                    n, i = z - a, top + r
                    keep, spans = None, []
                    if gone[i].is_valid and len(gone[i]):
                        lo, m = (x.to_numpy().astype(np.int64) for x in gone[i].values.flatten())
                        step = np.zeros(n + 1, np.int64)
                        np.add.at(step, lo, 1)
                        np.add.at(step, lo + m + window - 1, -1)
                        keep = np.cumsum(step[:-1]) == 0
                        e = runs(~keep)
                        spans = [{"start": x, "stop": y} for x, y in zip(e[::2], e[1::2])]
                    known = docs[i].is_valid
                    if known:
                        out.append((OWN, n, spans, joined(part, words, a, z, keep)))
                    if copies[i] > 1 and known and n >= window:
                        out.append((COPY, n, [{"start": 0, "stop": n}], ""))
                    elif copies[i] > 1 and known:
                        out.append((COPY, n, [], joined(part, words, a, z, None)))
                    if copies[i] > 1 or not known:
                        out.append((UNKNOWN, n, [], joined(part, words, a, z, None)))
                    take += [i] * (len(out) - len(take))
                made = [pa.array(list(x), t) for x, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(take)) for c in range(3)), *made], names=schema.names)

    return rows.select("__k1", "__k2", F.col("__doc").cast("long").alias("__doc"), "__text", "__copies", "gone").mapInArrow(run, schema)


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, made: list[Column] | None = None, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with n_words, removed (runs of words) and kept (the other words, joined by one space).

    ``made``: columns over these to return instead, computed once for each distinct text.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    keyed, texts = distinct_texts(wrapped(docs, __t=text, __id=doc_id), "__t", scratch, F.min("__id").alias("__doc"))
    gone = repeated(texts, scratch, window).groupBy("__k1", "__k2").agg(F.collect_list(F.struct("lo", "n")).alias("gone"))
    cut = _cut(texts.join(gone, ["__k1", "__k2"], "left"), window)
    made = made or [F.col(c) for c in ("n_words", "removed", "kept")]
    done = cut.select("__k1", "__k2", "__doc", "case", F.struct(*made).alias("__made"))
    rows = keyed.select("__row", "__k1", "__k2", F.col("__id").cast("long").alias("__id")).join(done, ["__k1", "__k2"])
    case = F.when(F.col("__id").isNull(), UNKNOWN).when(F.col("__id") == F.col("__doc"), OWN).otherwise(COPY)
    rows = rows.where(F.col("case") == case)
    new = rows.schema["__made"].dataType.names
    rows = rows.select("__row", *(F.col("__made")[c].alias(c) for c in new))
    return rows.select(*unwrapped(docs.columns, new))


def digests() -> list[Column]:
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return [F.col("n_words"), removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")]

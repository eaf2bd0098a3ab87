"""Removal of repeated byte strings with suffix arrays built by induced sorting.

A byte goes if it is covered by a ``length``-byte string that starts anywhere else too, in the
same document or another one.  Strings are judged on the input; matches never cross documents.

1. Equal texts are collapsed to one row with its number of copies, hash-partitioned and bucketed
   by a 128-bit key of the text, so that later joins do not move the texts again.
2. Shards.  Every ``length``-byte string has one anchor: the leftmost smallest hash among its
   ``GRAM``-byte grams.  Equal strings have equal anchors, so strings are dealt by anchor hash,
   runs of neighbouring strings with one anchor as one segment of bytes.  Anchors that occur
   once cannot repeat and stop here.  Equal segments are counted, and one of them travels.
3. Every task joins the segments of many anchors to shard texts of about ``SHARD_BYTES`` and builds
   the shard's suffix array by induced sorting: suffixes are classified, leftmost-smaller (LMS)
   substrings are sorted by induction and named, the string of names is sorted recursively by
   names of pairs, pairs of pairs, ..., and the sorted LMS suffixes induce the whole array, all
   in numpy, one character bucket at a time.  Permuted common prefixes come from the
   irreducible ones by the rule PLCP[i] = PLCP[i - 1] - 1.  A string repeats if its common
   prefix with a neighbour in the array reaches ``length``, or its segment has copies.
4. An anchor with more than ``HOT`` different segments (a common passage with as many different
   surroundings) is split: its strings are counted one by one by 128-bit hash, over all tasks.
5. Runs of repeated strings go back to all places of their segment and are cut from the texts.

Edge cases: null text is the empty text; texts shorter than ``length`` bytes lose nothing;
repeated rows count as copies of each other; empty tables give empty results; columns of the
input named like an output column are replaced.  One text at a time is in memory, and blocks
of about ``common.BLOCK_BYTES``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.relational import opaque
from .common import Scratch, blocks, map_blocks, mix, powers, prefix_hash, span_hash, text_bytes, unwrapped, wrapped

LENGTH = 200
GRAM = 32
SHARD_BYTES = 1 << 20
HOT = 4096
U64 = np.uint64


# -- anchors -------------------------------------------------------------------------
def anchors(buf: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, anchor hash, segment hash, first start in the row, number of starts) of each run of starts."""
    none = tuple(np.empty(0, t) for t in (np.int64, U64, U64, np.int64, np.int64))
    gram = min(GRAM, length)
    width = length - gram + 1  # grams in a string
    n = len(buf)
    if n < length:
        return none
    prefix = prefix_hash(buf)
    _, down = powers(n + 1)
    h = mix((prefix[gram:] - prefix[:-gram]) * down[:n - gram + 1])
    # smallest hash in each window of `width` grams; the place in the low bits makes it the leftmost
    bits = U64(max(1, int(n).bit_length()))
    low = (h >> bits << bits) | np.arange(len(h), dtype=U64)
    have = 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if width > have:
        low = np.minimum(low[:len(low) - (width - have)], low[width - have:])
    low &= (U64(1) << bits) - U64(1)
    # cut where the anchor changes, at each row's start, and past its last whole string
    last = np.clip(offs[1:] - length + 1, 0, len(low))
    first = np.unique(np.r_[0, np.flatnonzero(low[1:] != low[:-1]) + 1, np.minimum(offs[:-1], len(low)), last])
    count = np.diff(np.r_[first, len(low)])
    row = np.searchsorted(offs, first, side="right") - 1
    ok = (count > 0) & (first + length <= offs[np.minimum(row + 1, len(offs) - 1)])
    first, count, row = first[ok], count[ok], row[ok]
    return row, h[low[first].astype(np.int64)], span_hash(prefix, first, first + count - 1 + length), first - offs[row], count


# -- suffix arrays ---------------------------------------------------------------------
def s_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor (the last character is the sentinel)."""
    change = np.flatnonzero(np.r_[t[1:] != t[:-1], True])
    up = np.r_[t[change[:-1]] < t[change[:-1] + 1], True]
    return np.repeat(up, np.diff(np.r_[-1, change]))


def induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """The suffix order that sorted LMS suffixes induce: L suffixes from below, S suffixes from above."""
    sa = np.full(len(t), -1, np.int32)
    present = np.flatnonzero(tail > head)
    in_bucket = np.bincount(t[lms], minlength=len(head))
    first = np.r_[0, np.cumsum(in_bucket)]
    fill = head.copy()

    def before(cur, want):
        j = cur[cur > 0] - 1
        return j[s[j] == want]

    def push(j, up):
        c = t[j]
        order = np.argsort(c, kind="stable")
        j, c = j[order], c[order]
        n = np.bincount(c, minlength=len(head))
        within = np.arange(len(j)) - np.repeat(np.cumsum(n) - n, n)
        sa[fill[c] + within if up else fill[c] - 1 - within] = j
        fill[:] += n if up else -n

    for c in present.tolist():
        at = int(head[c])
        while at < fill[c]:
            cur = sa[at:fill[c]]
            at = int(fill[c])
            push(before(cur, False), True)
        if in_bucket[c]:
            push(before(lms[first[c]:first[c + 1]], False), True)
    upto = fill.copy()  # where the L suffixes of each bucket end
    fill[:] = tail
    for c in present[::-1].tolist():
        at = int(tail[c])
        if c == t[-1]:  # the sentinel: the smallest suffix of all
            sa[tail[c] - 1] = len(t) - 1
            fill[c] -= 1
        while at > fill[c]:
            cur = sa[fill[c]:at][::-1]
            at = int(fill[c])
            push(before(cur, True), False)
        push(before(sa[head[c]:upto[c]][::-1], True), False)
    return sa


def order_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Sort the suffixes of a string of names recursively: names of pairs, of pairs of pairs, ..."""
    step = 1
    while step < depth and int(names.max()) + 1 < len(names):
        follow = np.zeros(len(names), np.int64)
        follow[:-step] = names[step:] + 1
        key = names * (int(names.max()) + 2) + follow
        _, names = np.unique(key, return_inverse=True)
        step *= 2
    return np.argsort(names, kind="stable")


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of a string whose last character is the only 0, right at least ``depth`` characters deep."""
    t = t.astype(np.uint16)
    s = s_types(t)
    n_of = np.bincount(t)
    tail = np.cumsum(n_of)
    head = tail - n_of
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    if len(lms) > 1:
        # sort the LMS substrings by induction from their first characters, then name them
        rough = induce(t, s, lms[np.argsort(t[lms], kind="stable")], head, tail)
        is_lms = np.zeros(len(t), bool)
        is_lms[lms] = True
        rough = rough[is_lms[rough]]
        size = np.zeros(len(t), np.int64)
        size[lms] = np.diff(np.r_[lms, len(t) - 1]) + 1
        mark = prefix_hash_16(t)
        a, b = rough[:-1], rough[1:]
        end = np.minimum
        same = (size[a] == size[b]) & (span_hash(mark, a, end(a + size[a], len(t))) == span_hash(mark, b, end(b + size[b], len(t))))
        name = np.zeros(len(t), np.int64)
        name[rough] = np.r_[0, np.cumsum(~same)]
        lms = lms[order_names(name[lms], depth)]
    return induce(t, s, lms, head, tail)


def prefix_hash_16(t: np.ndarray) -> np.ndarray:
    up, _ = powers(len(t) + 1)
    out = np.zeros(len(t) + 1, U64)
    np.cumsum((t.astype(U64) + U64(1)) * up[:len(t)], out=out[1:])
    return out


def common_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: of each suffix with the one before it in the array (up to ``most``)."""
    n = len(t)
    phi = np.empty(n, np.int64)
    phi[sa[1:]], phi[sa[0]] = sa[:-1], -1
    i = np.arange(n)
    same = np.zeros(n, bool)
    ok = (i > 0) & (phi > 0)
    same[ok] = t[i[ok] - 1] == t[phi[ok] - 1]
    at = np.flatnonzero(~same)  # the irreducible ones
    byte = np.r_[t, np.zeros(most + 16, t.dtype)].astype(U64)
    word = byte[:-3] | byte[1:-2] << U64(16) | byte[2:-1] << U64(32) | byte[3:] << U64(48)
    got = np.zeros(len(at), np.int64)
    live = np.flatnonzero(phi[at] >= 0)
    x, y, done = at[live], phi[at[live]], 0
    while len(live) and done < most:
        lim = len(word) - 1
        differ = word[np.minimum(x + done, lim)] ^ word[np.minimum(y + done, lim)]
        equal = differ == 0
        d = differ[~equal]
        got[live[~equal]] = done + (d & U64(0xFFFF) == 0) * 1 + (d & U64(0xFFFFFFFF) == 0) * 1 + (d & U64(0xFFFFFFFFFFFF) == 0) * 1
        got[live[equal]] = done + 4
        live, x, y, done = live[equal], x[equal], y[equal], done + 4
    return np.maximum.accumulate(np.where(same, -1, np.r_[_spread(got, at, n)] + i)) - i


def _spread(got: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, -n, np.int64)
    out[at] = got
    return out


def repeated(segments: list[bytes], starts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each segment, which of its first ``starts`` strings stand anywhere else in the shard."""
    size = np.array([len(x) for x in segments], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    t = np.frombuffer(b"\x00".join(segments) + b"\x00\x00", np.uint8).astype(np.uint16) + 2
    t[begin[1:] - 1] = t[-2] = 1
    t[-1] = 0
    sa = suffix_array(t, length)
    lcp = common_prefixes(t, sa, 2 * int(size.max()) + 2)[sa]
    far = lcp >= length
    flag = np.zeros(len(t), bool)
    flag[sa[far]] = True
    flag[sa[:-1][far[1:]]] = True
    return [flag[b:b + k] for b, k in zip(begin.tolist(), starts.tolist())]


def runs(flag: np.ndarray) -> list[int]:
    """[from, to, from, to, ...] of the runs of True."""
    return np.flatnonzero(np.diff(np.r_[0, flag.astype(np.int8), 0])).tolist()


# -- Spark -----------------------------------------------------------------------------
def distinct_texts(docs: DataFrame, text: str, scratch: Scratch, *more) -> tuple[DataFrame, DataFrame]:
    """(documents with the key k1, k2 of their text; table of key, text, copies and more, bucketed by key)."""
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumns({"__k1": F.xxhash64(body), "__k2": F.xxhash64(F.lit("k2"), body)})
    one = keyed.groupBy("__k1", "__k2").agg(F.first(body).alias("__text"), F.count("*").alias("__copies"), *more)
    return keyed, scratch.write_bucketed(one, "texts", "__k1", "__k2")


def _segments(docs: DataFrame, length: int) -> DataFrame:
    """(k1, k2, h, s, a, n) of every run of starts with one anchor."""
    schema = StructType.fromDDL("__k1 bigint, __k2 bigint, h bigint, s bigint, a int, n int")

    def run(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(2))
            for lo, hi, part, at in blocks(buf, offs):
                row, h, s, a, n = anchors(part, at, length)
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(h.view(np.int64)), pa.array(s.view(np.int64)), pa.array(a.astype(np.int32)), pa.array(n.astype(np.int32))], names=schema.names)

    return docs.select("__k1", "__k2", "__text").mapInArrow(run, schema)


def _bytes_of(rows: DataFrame, length: int) -> DataFrame:
    """The bytes of each wanted segment: rows have a text and an array ``want`` of (h, s, a, n, c, hot)."""
    schema = StructType.fromDDL("h bigint, s bigint, n int, c bigint, hot boolean, seg binary")

    def run(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(0))
            want = b.column(1)
            w = want.flatten()
            row = np.repeat(np.arange(b.num_rows), np.diff(np.asarray(want.offsets)))
            get = lambda k: w.field(k).to_numpy(zero_copy_only=False)
            first = offs[row] + get("a")
            last = first + get("n") - 1 + length
            data = [buf[x:y].tobytes() for x, y in zip(first.tolist(), last.tolist())]
            yield pa.RecordBatch.from_arrays([w.field("h"), w.field("s"), w.field("n"), w.field("c"), w.field("hot"), pa.array(data, pa.binary())], names=schema.names)

    return rows.select("__text", "want").mapInArrow(run, schema)


def _shards(segments: DataFrame, length: int) -> DataFrame:
    """(h, s, n, runs) of the segments with repeated strings; rows of one anchor stand together."""
    schema = StructType.fromDDL("h bigint, s bigint, n int, runs array<int>")

    def solve(part: list[tuple]):
        n = np.array([r[2] for r in part], np.int64)
        found = repeated([r[4] for r in part], n, length)
        out = [(h, s, k, [0, k] if c > 1 else runs(f)) for (h, s, k, c, _), f in zip(part, found)]
        return pa.RecordBatch.from_arrays([pa.array(x, f) for x, f in zip(zip(*[r for r in out if r[3]]), (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32())))], names=schema.names) if any(r[3] for r in out) else None

    def run(batches):
        part, load = [], 0
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if load >= SHARD_BYTES and r[0] != part[-1][0]:
                    if (got := solve(part)) is not None:
                        yield got
                    part, load = [], 0
                part.append(r)
                load += len(r[4]) + 1
        if part and (got := solve(part)) is not None:
            yield got

    return segments.select("h", "s", "n", "c", "seg").repartition("h").sortWithinPartitions("h").mapInArrow(run, schema)


def _hot(segments: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many different segments: every string by its 128-bit hash."""
    schema = StructType.fromDDL("w1 bigint, w2 bigint, h bigint, s bigint, n int, at int, c bigint")

    def run(batches):
        for b in batches:
            for h, s, n, c, seg in zip(*(x.to_pylist() for x in b.columns)):
                data = np.frombuffer(seg, np.uint8)
                at = np.arange(n)
                w1 = span_hash(prefix_hash(data), at, at + length)
                w2 = span_hash(prefix_hash(mix(data.astype(U64)) >> U64(40)), at, at + length)
                full = lambda v, t: pa.array(np.full(n, v, t))
                yield pa.RecordBatch.from_arrays([pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), full(h, np.int64), full(s, np.int64), full(n, np.int32), pa.array(at.astype(np.int32)), full(c, np.int64)], names=schema.names)

    strings = segments.select("h", "s", "n", "c", "seg").mapInArrow(run, schema)
    many = strings.groupBy("w1", "w2").agg(F.sum("c").alias("c")).where("c > 1").select("w1", "w2")
    return (strings.join(many, ["w1", "w2"], "left_semi").groupBy("h", "s", "n").agg(F.collect_list("at").alias("at"))
            .select("h", "s", "n", F.expr("flatten(transform(at, x -> array(x, x + 1)))").alias("runs")))


def repeated_spans(texts: DataFrame, scratch: Scratch, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(k1, k2, spans) of the distinct texts: flat [from, to) byte pairs of repeated strings."""
    found = scratch.write(_segments(texts, length), "anchors")
    often = scratch.write(found.groupBy("h").agg(F.count("*").alias("all")).where("all > 1").select("h"), "often")
    again = scratch.write(found.join(often, "h"), "again")  # written, so that a hot anchor's part of the join can be split
    kinds = scratch.write(again.groupBy("h", "s", "n").agg(F.count("*").alias("c"), F.first("__k1").alias("__k1"), F.first("__k2").alias("__k2"), F.first("a").alias("a")), "kinds")
    crowded = kinds.groupBy("h").agg(F.count("*").alias("m")).where(F.col("m") > hot).select("h", F.lit(True).alias("hot"))
    wanted = kinds.join(opaque(crowded, "h"), "h", "left").groupBy("__k1", "__k2").agg(F.collect_list(F.struct("h", "s", "a", "n", "c", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("want"))
    segments = scratch.write(_bytes_of(texts.join(wanted, ["__k1", "__k2"]), length), "segments")
    marks = scratch.write(_shards(segments.where("not hot"), length).unionAll(_hot(segments.where("hot"), length)), "marks")
    return (again.join(marks, ["h", "s", "n"]).groupBy("__k1", "__k2")
            .agg(F.flatten(F.collect_list(F.expr(f"transform(runs, (x, i) -> x + a + if(i % 2 = 1, {length - 1}, 0))"))).alias("spans")))


def _cut(rows: DataFrame, length: int, as_text: bool) -> DataFrame:
    """Cut the spans out of each text."""
    fields = "n_bytes bigint, n_removed bigint, n_spans bigint, removed array<struct<start: bigint, stop: bigint>>, kept " + ("string" if as_text else "binary")

    def start():
        def cut(batch, buf, offs):
            spans, copies = batch.column(batch.schema.get_field_index("spans")), batch.column(batch.schema.get_field_index("__copies")).to_pylist()
            out = []
            for i, (sp, c) in enumerate(zip(spans, copies)):
                data = buf[offs[i]:offs[i + 1]]
                n = len(data)
                if c > 1 and n >= length:
                    gone = [(0, n)]
                elif sp.is_valid and len(sp):
                    x = sp.values.to_numpy().reshape(-1, 2)
                    step = np.zeros(n + 1, np.int32)
                    np.add.at(step, x[:, 0], 1)
                    np.add.at(step, x[:, 1], -1)
                    e = runs(np.cumsum(step[:-1]) > 0)
                    gone = list(zip(e[::2], e[1::2]))
                else:
                    gone = []
                left = b"".join(data[x:y].tobytes() for x, y in zip([0, *(y for _, y in gone)], [*(x for x, _ in gone), n]))
                out.append((n, n - len(left), len(gone), [{"start": x, "stop": y} for x, y in gone], left.decode("utf-8", "ignore") if as_text else left))
            return [list(x) for x in zip(*out)]
        return cut

    return map_blocks(rows, "__text", fields, start, keep=["__k1", "__k2", "spans", "__copies"]).drop("spans", "__copies")


def dedup(docs: DataFrame, text: str = "text", length: int = LENGTH, hot: int = HOT, as_text: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (long), removed (byte spans) and kept (remaining bytes).

    as_text: ``kept`` is text, without the remains of characters that a cut went through.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    keyed, texts = distinct_texts(wrapped(docs, __t=text), "__t", scratch)
    spans = repeated_spans(texts, scratch, length, hot)
    done = _cut(texts.join(spans, ["__k1", "__k2"], "left"), length, as_text)
    out = keyed.select("__row", "__k1", "__k2").join(done, ["__k1", "__k2"])
    return out.select(*unwrapped(docs.columns, ["n_bytes", "n_removed", "n_spans", "removed", "kept"]))


def digests() -> list:
    return [F.col("n_bytes"), F.col("n_removed"), F.col("n_spans"), F.sha2("kept", 256).alias("kept_sha256")]

"""Byte-pair encoding as a bounded-lookahead streaming transducer, and its decoder.

**Sufficient lookahead.**  For a merge list, whether a token that ends at byte e survives
depends on bytes right of e only through merges that take its tail away earlier.  With
``RS(t)`` the tokens on the right edge of t's own derivation, rule i = (u, v) needs::

    need(i)  = max over rules h < i whose left side is in RS(v) of |right side of h| + need(h)
    lookahead = max over rules i of |v| + need(i)

``lookahead`` is a constant of the merge list (computed once, in rank order).  Tokens that end
at least that many bytes before the end of what has been read are final.  The transducer
reads a window, merges it, emits the final tokens and goes on at the last emitted boundary,
so its memory does not grow with the text.  Pieces that fit in one window take one step.

Text is cut into pieces by the vocabulary's public split pattern first; special tokens are
matched before that, as literal text.  Decoding feeds token bytes to an incremental UTF-8
state machine (malformed bytes become U+FFFD).

Edge cases: null text encodes like the empty text (no ids, decoded ``''``); rows are
independent, so repeated rows repeat their results; empty tables give empty results; input
columns named like an output column are replaced; long texts are cut at word boundaries into
segments of ``SEGMENT`` characters.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_blocks

#: Fixed value: the public split pattern of byte-level BPE vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text taken at a time, and pieces remembered with their ids by each task.
SEGMENT = 1 << 20
REMEMBER = 300_000
NONE = np.int32(2**31 - 1)
#: Pieces up to so many bytes are merged in batches; longer ones go through windows.
SHORT = 64
#: The same for texts of ASCII and Latin letters only, for the faster engine of the standard library.
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The printable stand-in character of each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(spec: str) -> dict:
    """Merge rules and token bytes of a tokenizer file (its JSON text)."""
    j = json.loads(spec)
    symbol = byte_symbols()
    special = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
    ids = j["model"]["vocab"]
    raw = {i: bytes(symbol[c] for c in t) for t, i in ids.items() if t not in special}
    raw |= {i: t.encode() for t, i in special.items()}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in j["model"]["merges"]]
    rules = [(ids[a], ids[b], ids[a + b]) for a, b in merges]
    first = {b: ids[c] for c, b in symbol.items() if c in ids}
    return {"rules": rules, "bytes": raw, "first": first, "special": special}


def sufficient_lookahead(rules: list[tuple[int, int, int]], size: dict[int, int]) -> int:
    """Bytes right of a token's end that can still change it; see the module text."""
    part = {}  # token -> right half in its derivation
    for _, b, t in rules:
        part.setdefault(t, b)
    reach: dict[int, int] = {}  # left side -> max of |right side| + need over the rules so far
    for a, b, _ in rules:
        need, t = 0, b
        while t is not None:
            need = max(need, reach.get(t, 0))
            t = part.get(t)
        reach[a] = max(reach.get(a, 0), size[b] + need)
    return max(reach.values(), default=0)


def plain_rows(buf: np.ndarray, offs: np.ndarray) -> list[bool]:
    """Whether each text is ASCII without 1C-1F, or letters of U+00C0 to U+023F."""
    odd = np.ones(256, bool)
    odd[:0x1C] = odd[0x20:0xC0] = odd[0xC3:0xC9] = False
    bad = odd[buf]
    bad[1:] |= (buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))
    seen = np.r_[0, np.cumsum(bad)]
    return (seen[offs[1:]] == seen[offs[:-1]]).tolist()


class Transducer:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, voc: dict, window: int | None = None):
        import regex

        self.size = {i: len(b) for i, b in voc["bytes"].items()}
        self.first, self.special, self.raw = voc["first"], voc["special"], voc["bytes"]
        self.pair = {(a, b): (rank, t) for rank, (a, b, t) in reversed(list(enumerate(voc["rules"])))}
        self.lookahead = sufficient_lookahead(voc["rules"], self.size)
        self.window = max(window or 0, self.lookahead + 2 * max(self.size.values()))
        self.split = regex.compile(PATTERN)
        self.cut = regex.compile(r"\S(?= )")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.plain = re.compile(PLAIN).findall
        self.known: dict[str, tuple[int, ...]] = {}
        # the merge rules as sorted arrays, and those of two bytes as a table
        self.many = max(self.size, default=0) + 1
        keys = np.array([a * self.many + b for a, b in self.pair], np.int64)
        order = np.argsort(keys)
        ranks, made = (np.array([x[k] for x in self.pair.values()], np.int64) for k in (0, 1))
        self.keys, self.ranks = keys[order], ranks[order].astype(np.int32)
        self.by_rank = np.empty(int(ranks.max(initial=-1)) + 1, np.int32)
        self.by_rank[ranks] = made
        self.first_id = np.array([self.first.get(b, -1) for b in range(256)], np.int32)
        self.byte_pair = self.rank(np.repeat(self.first_id, 256), np.tile(self.first_id, 256))

    # -- merging pieces ---------------------------------------------------------
    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the rule that merges each pair; NONE if there is none."""
        if not len(self.keys):
            return np.full(len(a), NONE)
        key = a.astype(np.int64) * self.many + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def learn(self, pieces: list[str]) -> None:
        """Merge many short pieces at once: each round applies every piece's best rule everywhere in it."""
        if not pieces:
            return
        data = [p.encode("utf-8", "surrogatepass") for p in pieces]
        size = np.array([len(d) for d in data], np.int64)
        raw = np.frombuffer(b"".join(data), np.uint8)
        sym = self.first_id[raw]
        word = np.repeat(np.arange(len(data), dtype=np.int32), size)
        done_sym, done_word = [], []
        link = np.full(len(sym), NONE)
        link[:-1] = np.where(word[1:] == word[:-1], self.byte_pair[raw[:-1].astype(np.int32) * 256 + raw[1:]], NONE)
        while len(sym):
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            count = np.diff(np.r_[start, len(sym)])
            best = np.repeat(np.minimum.reduceat(link, start), count)
            live = best < NONE
            if not live.all():
                done_sym.append(sym[~live])
                done_word.append(word[~live])
                sym, word, link, best = sym[live], word[live], link[live], best[live]
                if not len(sym):
                    break
            hit = link == best
            if (both := hit[1:] & hit[:-1]).any():  # a run such as x x x: pairs from its left
                at = np.arange(len(hit))
                run = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], at, 0))
                chained = np.zeros(len(hit), bool)
                chained[1:] = both
                hit &= ~chained | ((at - run) % 2 == 0)
            i = np.flatnonzero(hit)
            sym[i] = self.by_rank[best[i]]
            keep = np.ones(len(sym), bool)
            keep[i + 1] = False
            i -= np.arange(len(i))  # their places once the right halves are gone
            sym, word, link = sym[keep], word[keep], link[keep]
            stale = np.zeros(len(sym), bool)
            stale[i] = stale[i[i > 0] - 1] = True
            link[stale] = NONE
            left = np.flatnonzero(stale[:-1] & (word[1:] == word[:-1]))
            link[left] = self.rank(sym[left], sym[left + 1])
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        stop = np.cumsum(np.bincount(word, minlength=len(data))).tolist()
        flat, at = sym[order].tolist(), 0
        for p, e in zip(pieces, stop):
            self.known[p] = tuple(flat[at:e])
            at = e

    def merged(self, data: bytes) -> list[int]:
        """Ids of one window by a heap of candidate pairs."""
        ids = [self.first[b] for b in data]
        pair, n = self.pair, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(p[0], i, p[1], ids[i], ids[i + 1]) for i in range(n - 1) if (p := pair.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, t, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j] = t, False
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if p := pair.get((t, ids[k])):
                    heapq.heappush(heap, (p[0], i, p[1], t, ids[k]))
            if (h := before[i]) >= 0 and (p := pair.get((ids[h], t))):
                heapq.heappush(heap, (p[0], h, p[1], ids[h], t))
        return [t for t, live in zip(ids, alive) if live]

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece: windows are merged and tokens emitted once stable."""
        out, at = [], 0
        while len(data) - at > self.window:
            stop = at + self.window
            for t in self.merged(data[at:stop]):
                if at + self.size[t] > stop - self.lookahead:
                    break
                out.append(t)
                at += self.size[t]
        return out + self.merged(data[at:])

    # -- whole texts --------------------------------------------------------------
    def segments(self, text: str):
        """Parts of a text that can be encoded alone: a cut stands before a space after a non-space."""
        at = 0
        while len(text) - at > SEGMENT and (m := self.cut.search(text, at + SEGMENT)):
            yield text[at:m.end()]
            at = m.end()
        yield text[at:] if at else text

    def encode_all(self, texts: list[str], plain: list[bool] | None = None) -> list[list[int]]:
        """Ids of each text; about ``SEGMENT`` characters are in work at a time.

        plain: whether a text has only characters on which both engines agree.
        """
        out: list[list[int]] = [[] for _ in texts]
        waiting, load = [], 0

        def flush():
            if len(self.known) > REMEMBER:
                self.known.clear()
            new = set(chain.from_iterable(p for _, p in waiting)).difference(self.known)
            long = {p for p in new if len(p) > SHORT}
            self.learn(list(new - long))
            for p in long:
                self.known[p] = tuple(self.piece(p.encode("utf-8", "surrogatepass")))
            ids = self.known.__getitem__
            for i, found in waiting:
                out[i].extend(chain.from_iterable(map(ids, found)))
            for p in long:
                del self.known[p]
            waiting.clear()

        for i, text in enumerate(texts):
            find = self.plain if plain and plain[i] else self.split.findall
            for part in self.marks.split(text) if self.marks else [text]:
                if part in self.special:
                    flush()
                    out[i].append(self.special[part])
                    continue
                for s in self.segments(part):
                    waiting.append((i, find(s)))
                    load += len(s)
                    if load >= SEGMENT:
                        flush()
                        load = 0
        flush()
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        return self.encode_all([text])[0]

    def decode(self, ids: list[int], step: int = 1 << 16) -> str:
        """Text of ids by an incremental byte-to-text state machine."""
        machine, raw, out = codecs.getincrementaldecoder("utf-8")("replace"), self.raw, []
        for i in range(0, len(ids), step):
            out.append(machine.decode(b"".join([raw[t] for t in ids[i:i + step]])))
        out.append(machine.decode(b"", True))
        return "".join(out)


def _vocabulary(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as f:  # a vocabulary file: a few MB, read once by the driver
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int), and with ``decoded`` the text read back from the ids."""
    spec = _vocabulary(docs.sparkSession, path)

    def start():
        t = Transducer(read_vocabulary(spec.value))

        def rows(batch, buf, offs):
            data = buf.tobytes()
            ids = t.encode_all([data[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:])], plain_rows(buf, offs))
            made = [pa.array(ids, pa.list_(pa.int32()))]
            return made + [pa.array(map(t.decode, ids), pa.string())] if decoded else made

        return rows

    return map_blocks(docs, text, "ids array<int>" + ", decoded string" * decoded, start)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the text of its ids (null ids: the empty text; unknown ids are an error)."""
    spec = _vocabulary(df.sparkSession, path)

    names = [c for c in df.columns if c.lower() != "decoded"]

    def attach(batches):
        t = Transducer(read_vocabulary(spec.value))
        for b in batches:
            made = pa.array([t.decode(x or []) for x in b.column(names.index(ids)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*names, "decoded"])

    schema = df.select([f"`{c}`" for c in names]).withColumn("decoded", F.lit("")).schema
    return df.select([f"`{c}`" for c in names]).mapInArrow(attach, schema)


def digests() -> list:
    """The contract's digest columns from ``ids`` and ``decoded``."""
    return [F.size("ids").cast("long").alias("n_tokens"),
            F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256")]

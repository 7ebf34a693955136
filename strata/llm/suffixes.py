"""Suffix-array dedup over bytes by deep-shallow sorting.

A suffix array of all bytes would have a suffix for each of them. Here suffixes
begin at anchors only: of every ``window`` bytes the leftmost smallest ``GRAM``-byte
hash. Equal windows have the same anchor at the same place in them, so an anchor
that occurs once rules out all windows that it stands for, and the rest are
compared in the suffix order of their anchors: windows that hold the anchor at
offset o are equal if the right sides share ``window`` - o bytes and the left
sides, read backwards, o bytes. Both are runs of longest common prefixes in a
sorted order. Only anchors that occur again leave their documents, each with the
bytes around it, to a bucket of the hash range, where they are sorted: multikey
quicksort on eight-byte symbols down to a shallow depth, then a blind trie for
each group that is still equal there. An anchor that occurs too often for one
bucket (a phrase that many documents have, with differing surroundings) sends the
hashes of its windows instead, spread over all buckets: each chunk its different
ones, with the first place of each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strata.llm import exchange as ex
from strata.llm.common import Rolling, mix

WINDOW = 100
GRAM = 32
CHUNK_BYTES = 2 << 20
HOT = 4096             # occurrences from which an anchor's windows are compared one by one
SHALLOW = 3            # eight-byte symbols that the multikey quicksort looks at
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
_PLACE_BITS = 36       # a chunk's places in the low bits, so that the leftmost of equal hashes is the smallest


class Anchors:
    """The anchors of a chunk: for each one its place, and the first and last window start that it stands for."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, window: int, gram: int):
        self.buf, self.off = buf, off
        span = window - gram + 1
        size = np.diff(off)
        starts = np.maximum(size - window + 1, 0)
        at = np.arange(starts.sum()) + np.repeat(off[:-1] - np.r_[0, np.cumsum(starts)[:-1]], starts)   # all window starts
        if not len(at):
            self.place = self.low = self.high = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            self.doc = np.zeros(0, np.int64)
            return
        h = mix(Rolling(buf.astype(np.uint64) + np.uint64(1), _BASE[0]).every(gram))
        bits = _PLACE_BITS
        best = (h >> np.uint64(bits) << np.uint64(bits)) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while width < span:     # smallest of the next ``span`` places, by doubling
            step = min(width, span - width)
            best = np.minimum(best[:-step], best[step:])
            width += step
        place = (best[at] & np.uint64((1 << bits) - 1)).astype(np.int64)
        doc = np.repeat(np.arange(len(size)), starts)
        new = np.r_[True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]
        first = np.flatnonzero(new)
        self.place, self.doc = place[first], doc[first]
        self.low, self.high = at[first], at[np.r_[first[1:], len(at)] - 1]
        self.hash = mix(h[self.place])      # the smallest of many lie close together: mixed again, all buckets get their share

    def unique(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of each anchor's hash among the chunk's different ones, those, and how often they occur."""
        h, index, n = np.unique(self.hash, return_inverse=True, return_counts=True)
        return index, h, n

    def windows(self, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The different windows of the anchors ``at``: their two hashes, sorted, the first start of each, and all later starts."""
        if not len(at):
            return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
        size = self.high[at] - self.low[at] + 1
        starts = np.sort(np.arange(size.sum()) + np.repeat(self.low[at] - (np.cumsum(size) - size), size))
        h = [mix(Rolling(self.buf.astype(np.uint64) + np.uint64(1), b).of(starts, starts + window)) for b in _BASE[1:]]
        by = np.lexsort((starts, h[1], h[0]))
        new = np.ones(len(by), bool)
        new[1:] = (h[0][by][1:] != h[0][by][:-1]) | (h[1][by][1:] != h[1][by][:-1])
        return h[0][by][new], h[1][by][new], starts[by][new], starts[by][~new]

    def contexts(self, repeated: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Repeated anchors, sorted so that those with the same bytes around them follow each other in
        place order, and which of them are the first of their kind. (Places rise with the document order.)"""
        at = np.flatnonzero(repeated)
        low, end = self.low[at], self.high[at] + window
        if not len(at):
            return at, np.zeros(0, bool)
        rolls = [Rolling(self.buf.astype(np.uint64) + np.uint64(1), b).of(low, end) for b in _BASE[1:]]
        shape = ((self.place[at] - low) << 32 | (end - low)).astype(np.uint64)
        keys = (self.place[at], shape, rolls[1], rolls[0], self.hash[at])
        by = np.lexsort(keys)
        new = np.ones(len(by), bool)
        new[1:] = False
        for k in keys[1:]:
            new[1:] |= k[by][1:] != k[by][:-1]
        return at[by], new


class _Trie:
    """Blind trie of byte strings: nodes keep the depth where strings part and the byte there (-1: the end)."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root = 0                     # a leaf is the string's index, a node [depth, {byte: child}]
        for i in range(1, len(strings)):
            self._add(i)

    def _add(self, i: int) -> None:
        s, node = self.strings[i], self.root
        while not isinstance(node, int):  # blind descent: only the parting bytes are looked at
            depth, kids = node
            c = s[depth] if depth < len(s) else -1
            node = kids[c] if c in kids else next(iter(kids.values()))
        t = self.strings[node]
        top = min(len(s), len(t))
        a, b = int.from_bytes(s[:top], "big"), int.from_bytes(t[:top], "big")
        common = top - ((a ^ b).bit_length() + 7) // 8      # one comparison with that leaf
        if common == len(s) == len(t):
            raise ValueError("strings must differ")
        up, key, node = None, None, self.root
        while not isinstance(node, int) and node[0] < common:
            up, key = node, s[node[0]] if node[0] < len(s) else -1
            node = up[1][key]
        c = s[common] if common < len(s) else -1
        if not isinstance(node, int) and node[0] == common:
            node[1][c] = i
            return
        new = [common, {(t[common] if common < len(t) else -1): node, c: i}]
        if up is None:
            self.root = new
        else:
            up[1][key] = new

    def order(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node, int):
                out.append(node)
            else:
                todo.extend(node[1][c] for c in sorted(node[1], reverse=True))
        return out


def deep_shallow(rows: np.ndarray, length: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the byte strings in ``rows`` (padded with zeros to a multiple of eight) and each one's
    common prefix with the one before it (0 for the first). A string goes before those it begins."""
    n, width = rows.shape
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order, group = np.arange(n), np.zeros(n, np.int64)
    live = np.arange(n)                                    # slots whose group has several strings
    for k in range(min(shallow, words.shape[1])):
        part = order[live]
        by = np.lexsort((words[part, k], group[live]))
        part = part[by]
        g = group[live]
        order[live] = part
        new = np.r_[True, (g[1:] != g[:-1]) | (words[part[1:], k] != words[part[:-1], k])]
        group[live] = live[np.flatnonzero(new)[np.cumsum(new) - 1]]
        size = np.diff(np.r_[np.flatnonzero(new), len(live)])
        live = live[np.repeat(size, size) > 1]
        if not len(live):
            break
    if len(live):                                          # deep: equal over the shallow depth
        g = group[live]
        cut = np.flatnonzero(np.r_[True, g[1:] != g[:-1], True])
        flat = np.ascontiguousarray(rows).tobytes()
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
            part = order[live[a:z]]
            same: dict[bytes, list[int]] = {}
            for i, m in zip(part.tolist(), length[part].tolist()):
                same.setdefault(flat[i * width + 8 * shallow:i * width + m] + b"\x00" * max(0, 8 * shallow - m)
                                if m >= 8 * shallow else b"", []).append(i)
            strings = list(same)
            ranked = _Trie(strings).order() if len(strings) > 1 else [0]
            order[live[a:z]] = [i for k in ranked for i in sorted(same[strings[k]], key=lambda i: length[i])]
    return order, _prefixes(rows, length, order)


def _prefixes(rows: np.ndarray, length: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 16384):
        z = min(len(order), a + 16384)
        x, y = order[a - 1:z - 1], order[a:z]
        differ = rows[x] != rows[y]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[a:z] = np.minimum(common, np.minimum(length[x], length[y]))
    return out


def _padded(buf: np.ndarray, start: np.ndarray, length: np.ndarray, step: int) -> np.ndarray:
    width = max(8, -(-int(length.max(initial=0)) // 8) * 8)
    out = np.zeros((len(start), width), np.uint8)
    col = np.arange(width)
    for a in range(0, len(start) if len(buf) else 0, 16384):
        z = a + 16384
        at = np.clip(start[a:z, None] + step * col, 0, len(buf) - 1)
        out[a:z] = np.where(col < length[a:z, None], buf[at], 0)
    return out


def later_windows(buf: np.ndarray, start: np.ndarray, left: np.ndarray, right: np.ndarray, least: np.ndarray,
                  rank: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows have an equal one of a smaller rank: (context, offset of the anchor in the window).

    A context is ``left`` bytes before its anchor (at ``start``) and ``right`` from it on; its windows have
    offsets ``least`` to ``left``; ``rank`` is its place in the document order.
    """
    right_rows = _padded(buf, start, right, 1)
    order, prefix = deep_shallow(right_rows, right)
    left_order, left_prefix = deep_shallow(_padded(buf, start - 1, left, -1), left)
    contexts, offsets = [], []
    lo, hi = int(least.min()), int(left.max())
    run, left_run = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    for o in range(lo, hi + 1):
        sel = np.flatnonzero((least <= o) & (o <= left))
        if len(sel) < 2:
            continue
        run[order] = np.cumsum(prefix < window - o)
        left_run[left_order] = np.cumsum(left_prefix < o) if o else 0
        by = sel[np.lexsort((rank[sel], left_run[sel], run[sel]))]
        again = (run[by][1:] == run[by][:-1]) & (left_run[by][1:] == left_run[by][:-1])
        hit = by[1:][again]
        contexts.append(hit)
        offsets.append(np.full(len(hit), o))
    return (np.concatenate(contexts), np.concatenate(offsets)) if contexts else (np.zeros(0, np.int64),) * 2


_CONTEXT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int64()), ("head", pa.binary()), ("bytes", pa.binary())])
_HEAD = np.dtype([("ctx", "<i4"), ("left", "<i4"), ("right", "<i4"), ("least", "<i4"), ("null", "<i4"), ("id", "<i8"), ("rid", "<i8"), ("at", "<i8")])
_RANK = np.dtype([("null", "<i1"), ("id", "<i8"), ("rid", "<i8"), ("at", "<i8")])
_FOUND = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])


def _compare(table: pa.Table, window: int) -> pa.Table:
    """One bucket: the later windows of each chunk's contexts, as (context, first and last offset) runs."""
    heads = [np.frombuffer(h, _HEAD) for h in table.column("head").to_pylist()]
    head = np.concatenate(heads)
    chunk = np.repeat(np.asarray(table.column("chunk")), [len(h) for h in heads])
    buf = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    size = head["left"].astype(np.int64) + head["right"]
    start = np.cumsum(size) - size + head["left"]
    rank = np.empty(len(head), np.int64)
    rank[np.lexsort((head["at"], head["rid"], head["id"], head["null"]))] = np.arange(len(head))
    ctx, o = later_windows(buf, start, head["left"].astype(np.int64), head["right"].astype(np.int64),
                           head["least"].astype(np.int64), rank, window)
    by = np.lexsort((o, ctx))
    ctx, o = ctx[by], o[by]
    new = np.r_[True, (ctx[1:] != ctx[:-1]) | (o[1:] != o[:-1] + 1)][:len(ctx)]
    first = np.flatnonzero(new)
    runs = np.stack([head["ctx"][ctx[first]], o[first], o[np.r_[first[1:], len(o)] - 1]], axis=1).astype("<i4") if len(first) else np.zeros((0, 3), "<i4")
    owner = chunk[ctx[first]]
    by = np.argsort(owner, kind="stable")
    owner, runs = owner[by], runs[by]
    chunks, cut = np.unique(owner, return_index=True)
    ends = np.r_[cut[1:], len(owner)]
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "kind": pa.array(np.zeros(len(chunks)), pa.int32()),
                     "bucket": pa.array(np.zeros(len(chunks)), pa.int32()),
                     "payload": pa.array([runs[a:z].tobytes() for a, z in zip(cut, ends)], pa.binary())}, schema=_FOUND)


def _later(table: pa.Table, bucket: int) -> pa.Table:
    """One bucket of window hashes: for each chunk a bit for those that have an equal one of a smaller rank."""
    n = table.column("n").to_pylist()
    raw = table.column("bytes").to_pylist()
    h1, h2 = (np.concatenate([np.frombuffer(r, np.uint64, k, 8 * k * part) for r, k in zip(raw, n)]) for part in (0, 1))
    rank = np.concatenate([np.frombuffer(r, _RANK) for r in table.column("head").to_pylist()])
    by = np.lexsort((rank["at"], rank["rid"], rank["id"], rank["null"], h2, h1))
    later = np.zeros(len(by), bool)
    later[by[1:]] = (h1[by][1:] == h1[by][:-1]) & (h2[by][1:] == h2[by][:-1])
    bits = [np.packbits(later[z - k:z]).tobytes() for k, z in zip(n, np.cumsum(n).tolist())]
    return pa.table({"chunk": table.column("chunk"), "kind": pa.array(np.full(len(n), 2), pa.int32()),
                     "bucket": pa.array(np.full(len(n), bucket), pa.int32()), "payload": pa.array(bits, pa.binary())}, schema=_FOUND)


def _found(around: DataFrame, window: int, groups: int) -> DataFrame:
    """Answers to the chunks: buckets below ``groups`` hold contexts, the others window hashes."""
    def one(key, table):
        bucket = key[0].as_py()
        return _compare(table, window) if bucket < groups else _later(table, bucket - groups)
    return around.groupBy("bucket").applyInArrow(one, ex.ANSWER)


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, hot: int = HOT) -> DataFrame:
    """One row per document: ``rid, doc_id, n_bytes, n_removed, kept`` (the bytes left) and the maximal
    removed ranges ``span_start, span_end``.

    A byte goes if a string of ``window`` bytes that covers it also starts earlier: in a document
    with a smaller id (null ids last; of equal ids the smaller row id), or earlier in the same one;
    overlaps count and strings are judged on the input. Texts count as UTF-8 bytes, so a cut may split a
    character; matches stay inside documents. Null and empty texts have no bytes; texts shorter than the
    window stay whole; equal rows are documents of their own; no rows give no rows; other columns are ignored.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be from 1 to window")
    base, total = ex.chunked(spark, docs, id_col, text_col, "suffixes", chunk_bytes)
    # hashes of 8 MB of text in a bucket; of the contexts, which take more memory, those of 1 MB
    buckets, groups = (max(32, -(-total // size)) for size in (8 << 20, 1 << 20))

    def setup(table: pa.Table):
        rids, ids, buf, off = ex.load(table)
        a = Anchors(buf, off, window, gram)
        return rids, ids, a, *a.unique()

    def anchors(key, table):
        *_, h, times = setup(table)
        return ex.question(key[0].as_py(), (h,), times > 1, buckets, times)

    def split(a, index, h, answers):
        """First ones of equal contexts, the others of each, and the windows of hot anchors' first ones."""
        at, first = a.contexts(ex.answered(answers, 1, (h,), buckets)[index], window)
        over = ex.answered(answers, 1, (h,), buckets, 1)[index][at]
        return at[first & ~over], at[~first], a.windows(at[first & over], window)

    def contexts(key, table, answers):
        if not table.num_rows:
            return _CONTEXT.empty_table()
        rids, ids, a, index, h, _ = setup(table)
        at, _, (h1, h2, start, _) = split(a, index, h, answers)     # the chunk itself knows that the others are later
        bucket = ex.bucket_of(a.hash[at], groups)
        null = np.asarray(ids.is_null())
        number = np.asarray(ids.fill_null(0))
        head = np.zeros(len(at), _HEAD)
        head["ctx"], head["left"], head["right"] = np.arange(len(at)), a.place[at] - a.low[at], a.high[at] + window - a.place[at]
        head["least"] = a.place[at] - a.high[at]
        head["null"], head["id"], head["rid"], head["at"] = null[a.doc[at]], number[a.doc[at]], rids[a.doc[at]], a.place[at] - a.off[a.doc[at]]
        cut = np.searchsorted(bucket, np.arange(groups + 1))       # contexts come in hash order
        raw = a.buf.tobytes()
        full = np.flatnonzero(cut[1:] > cut[:-1])
        low, end = a.low[at].tolist(), (a.high[at] + window).tolist()
        doc = np.searchsorted(a.off, start, "right") - 1
        rank = np.zeros(len(start), _RANK)
        rank["null"], rank["id"], rank["rid"], rank["at"] = null[doc], number[doc], rids[doc], start - a.off[doc]
        edge = np.searchsorted(ex.bucket_of(h1, groups), np.arange(groups + 1))
        some = np.flatnonzero(edge[1:] > edge[:-1])
        spread = pa.table({"bucket": pa.array(groups + some, pa.int32()), "chunk": pa.array(np.full(len(some), key[0].as_py()), pa.int64()),
                           "n": pa.array(edge[some + 1] - edge[some], pa.int64()),
                           "head": pa.array([rank[x:z].tobytes() for x, z in zip(edge[some], edge[some + 1])], pa.binary()),
                           "bytes": pa.array([h1[x:z].tobytes() + h2[x:z].tobytes() for x, z in zip(edge[some], edge[some + 1])], pa.binary())},
                          schema=_CONTEXT)
        near = pa.table({"bucket": pa.array(full, pa.int32()), "chunk": pa.array(np.full(len(full), key[0].as_py()), pa.int64()),
                         "n": pa.array(cut[full + 1] - cut[full], pa.int64()),
                         "head": pa.array([head[x:z].tobytes() for x, z in zip(cut[full], cut[full + 1])], pa.binary()),
                         "bytes": pa.array([b"".join([raw[s:e] for s, e in zip(low[x:z], end[x:z])]) for x, z in zip(cut[full], cut[full + 1])],
                                           pa.binary())}, schema=_CONTEXT)
        return pa.concat_tables([near, spread])

    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("kept", pa.binary()), ("span_start", pa.list_(pa.int64())), ("span_end", pa.list_(pa.int64()))])

    def cut(key, table, answers):
        if not table.num_rows:
            return schema.empty_table()
        rids, ids, a, index, h, _ = setup(table)
        at, local, (h1, h2, start, again) = split(a, index, h, answers)
        edge = np.zeros(len(a.buf) + 1, np.int32)
        np.add.at(edge, a.low[local], 1)
        np.add.at(edge, a.high[local] + window, -1)
        for later in (again, start[ex.answered(answers, 2, (h1, h2), groups)]):
            np.add.at(edge, later, 1)
            np.add.at(edge, later + window, -1)
        for kind, p in zip(answers.column("kind").to_pylist(), answers.column("payload").to_pylist()):
            if kind == 0:
                ctx, lo, hi = np.frombuffer(p, "<i4").reshape(-1, 3).astype(np.int64).T
                place = a.place[at[ctx]]
                np.add.at(edge, place - hi, 1)
                np.add.at(edge, place - lo + window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        raw = a.buf.tobytes()
        n, removed, kept, starts, ends = [], [], [], [], []
        for x, z in zip(a.off[:-1].tolist(), a.off[1:].tolist()):
            step = np.diff(np.r_[0, gone[x:z].astype(np.int8), 0])
            s, e = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            n.append(z - x), removed.append(int((e - s).sum()))
            kept.append(b"".join([raw[x + p:x + q] for p, q in zip([0, *e.tolist()], [*s.tolist(), z - x])]))
            starts.append(s), ends.append(e)
        return pa.table([pa.array(rids), ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()),
                         pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))], schema=schema)

    hashes = ex.ask(base.groupBy("chunk").applyInArrow(anchors, ex.ANSWER), hot)
    around = base.groupBy("chunk").cogroup(hashes.groupBy("chunk")).applyInArrow(
        contexts, "bucket int, chunk long, n long, head binary, bytes binary")
    found = _found(around, window, groups)
    return base.groupBy("chunk").cogroup(hashes.unionByName(found).groupBy("chunk")).applyInArrow(
        cut, "rid long, doc_id long, n_bytes long, n_removed long, kept binary, span_start array<bigint>, span_end array<bigint>")


def digest(kept: bytes) -> str:
    return hashlib.sha256(kept).hexdigest()

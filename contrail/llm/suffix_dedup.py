"""Suffix-array deduplication of byte strings by a distributed, common-prefix-aware merge sort.

A byte is removed when a string of WINDOW bytes that covers it also starts elsewhere.

1. Anchors. Of every WINDOW-byte string the GRAM-byte substring with the smallest hash
   is its anchor. Equal strings have their anchors at equal offsets, so strings whose
   anchor occurs once in the corpus are unique: only suffixes at repeated anchors have
   to be sorted, and nothing is lost.
2. Runs. Each task sorts its suffixes (anchor hash, then the bytes that follow), merges
   equal ones and writes them front-coded: length of the prefix shared with the one
   before, then the rest.
3. Merge. The runs of one hash range meet in one task, where a loser tree merges them.
   Every contender carries the length of the prefix it shares with the last winner;
   unequal lengths decide without looking at bytes, equal ones compare from there on.
4. The merged order gives common prefixes to the right, the same rows sorted by the
   bytes before them give them to the left. A WINDOW string around an anchor is
   repeated where two suffixes agree far enough on both sides.

An anchor that occurs more than OFTEN times (a frequent line) is entered twice, once for
the strings that reach far to its right and once for the others, under a hash of the
bytes that those strings share for certain: its group falls apart by context.
An anchor that occurs more than HOT times is not gathered: the strings around it are
counted by digest, combined before the shuffle, which gives the same spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ROW_KEY, cut, keyed, same_row
from contrail.operators.joins import join_group_values

WINDOW = 200
GRAM = 32
#: Suffixes of one sorted run, and about as many per merge range.
RUN = 20_000
#: Suffixes at an anchor that is found more often than this are told apart by half of their surroundings first.
OFTEN = 5_000
HOT = 200_000
#: Tasks of one shuffle at most; a task merges its ranges one after the other.
MAX_TASKS = 100_000

_MULTIPLIER = 0x9E3779B97F4A7C15


def _slide(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return pick(x[:len(x) - rest], x[rest:]) if rest else x


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of every ``gram`` bytes: polynomial, built from halves, then mixed."""
    mask = 2**64 - 1
    x = raw.astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD) + np.uint64(0xC4CEB9FE1A85EC53)
    power, span, out, done = _MULTIPLIER, 1, None, 0
    left = gram
    while left:
        if left & 1:
            if out is None:
                out = x
            else:
                n = min(len(out), len(x) - done)
                out = out[:n] * np.uint64(power) + x[done:done + n]
            done += span
        left >>= 1
        if left:
            x = x[:-span] * np.uint64(power) + x[span:]
            power, span = power * power & mask, span * 2
    out = out[:len(raw) - gram + 1]
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def anchors(raw: bytes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all ``window``-byte strings (all ties)."""
    if len(raw) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = gram_hashes(np.frombuffer(raw, dtype=np.uint8), gram)
    width = window - gram + 1
    least = _slide(hashes, width, np.minimum)
    edge = np.zeros(width - 1, dtype=np.uint64)
    # a gram is an anchor if it is the least of some window that holds it: the largest of those minima
    at = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), width, np.maximum) == hashes)
    return at, hashes[at]


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def _anchor_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(t.encode(), window, gram) for t in batch.column("text").to_pylist()]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(p) for p, _ in found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("row_hash").take(rows),
                 pa.array(np.concatenate([p for p, _ in found]).astype(np.int32) if found else [], pa.int32()),
                 pa.array(_signed(np.concatenate([h for _, h in found])) if found else [], pa.int64())],
                names=["doc_id", "row_hash", "pos", "gram"])
    return run


# ---- front-coded runs --------------------------------------------------------------------------------------------

def _shared(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row of a byte matrix shares with the row before (0 for the first)."""
    if len(rows) < 2:
        return np.zeros(len(rows), dtype=np.int64)
    differs = rows[1:] != rows[:-1]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return np.concatenate([[0], first])


def _front_coded(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    shared = _shared(rows)
    return shared.astype(np.uint16), rows[np.arange(rows.shape[1])[None, :] >= shared[:, None]].tobytes()


def _restored(shared: np.ndarray, rest: bytes, width: int) -> np.ndarray:
    """Byte matrix of a front-coded run: every byte of a shared prefix comes from the last row that spelled it out."""
    spelled = np.arange(width)[None, :] >= shared[:, None]
    rows = np.zeros((len(shared), width), dtype=np.uint8)
    rows[spelled] = np.frombuffer(rest, np.uint8)
    source = np.maximum.accumulate(np.where(spelled, np.arange(len(shared), dtype=np.int32)[:, None], 0), axis=0)
    return np.take_along_axis(rows, source, axis=0)


def _pack(arrays: list[np.ndarray | bytes]) -> bytes:
    data = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    return pa.compress(np.array([len(data), *map(len, data)], dtype=np.int64).tobytes() + b"".join(data), codec="zstd", asbytes=True)


def _unpack(blob: bytes, size: int) -> list[bytes]:
    raw = pa.decompress(blob, size, codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw[:8], np.int64)[0])
    sizes = np.frombuffer(raw[8:8 + 8 * n], np.int64)
    ends = 8 + 8 * n + np.cumsum(sizes)
    return [raw[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def _contexts(raw: bytes, at: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte matrices of what follows each anchor (window bytes) and of what precedes it, nearest first."""
    before = window - gram
    padded = np.concatenate([np.zeros(before, np.uint8), np.frombuffer(raw, np.uint8), np.zeros(window, np.uint8)])
    spans = np.lib.stride_tricks.sliding_window_view
    return spans(padded, window)[at + before], spans(padded, before)[at][:, ::-1]


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of a byte matrix."""
    out = np.full(len(rows), rows.shape[1] + 1, dtype=np.uint64)
    for column in rows.T:
        out = out * np.uint64(_MULTIPLIER) + column + np.uint64(1)
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _by_halves(part: tuple, often: np.ndarray, window: int, gram: int) -> tuple:
    """Entries of one text, those at frequent anchors replaced by two that each stand for half of the offsets.

    ``part``: doc, pos, hash, size, right, left, and how far to the right and left an entry counts.
    """
    half = (window - gram) // 2
    doc, pos, hashes, size, right, left, far_right, far_left = part
    # strings with at most ``half`` bytes before the anchor share window - half bytes from it on
    a = np.flatnonzero(often & (size - pos >= window - half))
    # the others share ``half`` bytes before it, and its own
    b = np.flatnonzero(often & (pos >= half))
    rows = np.concatenate([np.flatnonzero(~often), a, b])
    name = hashes.copy()[rows]
    at_a, at_b = slice(len(rows) - len(a) - len(b), len(rows) - len(b)), slice(len(rows) - len(b), len(rows))
    name[at_a] = _row_hashes(right[a][:, :window - half])
    name[at_b] = _row_hashes(np.concatenate([left[b][:, :half], right[b][:, :gram]], axis=1)) ^ np.uint64(_MULTIPLIER)
    far_right, far_left = far_right[rows], far_left[rows]
    far_left[at_a] = half
    far_right[at_b] = window - half
    return doc[rows], pos[rows], name, size[rows], right[rows], left[rows], far_right, far_left


def _runs(window: int, gram: int, ranges: int):
    """mapInArrow: (doc_id, row_hash, text, pos[], gram[], often[]) -> (range, size, run): front-coded sorted runs."""
    def write(docs: list, doc_of: np.ndarray, pos: np.ndarray, hashes: np.ndarray, size: np.ndarray, right: np.ndarray, left: np.ndarray,
              far_right: np.ndarray, far_left: np.ndarray):
        key = np.concatenate([hashes.byteswap().view(np.uint8).reshape(-1, 8), right], axis=1)
        # how much of each side is text rather than padding is part of a suffix's identity
        after = np.minimum(size - pos, far_right).astype(np.uint16)
        before = np.minimum(pos, far_left).astype(np.uint16)
        whole = np.concatenate([key, left, after.byteswap().view(np.uint8).reshape(-1, 2), before.byteswap().view(np.uint8).reshape(-1, 2)], axis=1)
        order = np.argsort(np.ascontiguousarray(whole).view(f"V{whole.shape[1]}").ravel(), kind="stable")
        same = _shared(whole[order]) == whole.shape[1]
        entry = np.cumsum(~same) - 1
        heads = order[~same]
        in_range = (hashes[heads] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
        bounds = np.searchsorted(in_range, np.arange(ranges + 1))
        rows = []
        for r in np.flatnonzero(np.diff(bounds)).tolist():
            part = heads[bounds[r]:bounds[r + 1]]
            mine = slice(*np.searchsorted(entry, [bounds[r], bounds[r + 1]]))
            used, doc = np.unique(doc_of[order[mine]], return_inverse=True)
            of = [docs[i] for i in used.tolist()]
            shared, rest = _front_coded(key[part])
            l_shared, l_rest = _front_coded(left[part])
            packed = [shared, rest, l_shared, l_rest, after[part], before[part], (entry[mine] - bounds[r]).astype(np.int32),
                      doc.astype(np.int32), pos[order[mine]].astype(np.int32),
                      np.array([0 if d is None else d for d, _ in of], np.int64), np.array([d is None for d, _ in of], bool),
                      np.array([h for _, h in of], np.int64)]
            size_of = 8 + 8 * len(packed) + sum(len(p) if isinstance(p, bytes) else p.nbytes for p in packed)
            rows.append((r, size_of, _pack(packed)))
        return pa.RecordBatch.from_pydict({"range": pa.array([r[0] for r in rows], pa.int32()), "size": pa.array([r[1] for r in rows], pa.int64()),
                                           "run": pa.array([r[2] for r in rows], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list = []
        parts: list = []
        held = 0

        def flush():
            return write(docs, *(np.concatenate(x) for x in zip(*parts, strict=True)))

        for batch in batches:
            for doc_id, row_hash, text, pos, grams, frequent in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row_hash", "text")),
                                                                    *(batch.column(c) for c in ("pos", "gram", "often")), strict=True):
                raw = text.encode()
                at, which = np.unique(np.array(pos.values), return_index=True)
                hashes, often = np.array(grams.values).view(np.uint64)[which], np.array(frequent.values)[which]
                docs.append((doc_id, row_hash))
                for i in range(0, len(at), RUN):
                    some = at[i:i + RUN].astype(np.int64)
                    parts.append(_by_halves((
                        np.full(len(some), len(docs) - 1), some, hashes[i:i + RUN], np.full(len(some), len(raw)), *_contexts(raw, some, window, gram),
                        np.full(len(some), window), np.full(len(some), window - gram)), often[i:i + RUN], window, gram))
                    held += len(parts[-1][0])
                    if held >= RUN:
                        yield flush()
                        docs, parts, held = docs[-1:], [], 0
                        if i + RUN >= len(at):
                            docs = []
        if parts:
            yield flush()
    return run


# ---- merge -------------------------------------------------------------------------------------------------------

def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Loser tree over sorted runs: byte matrices of ``width`` columns, each with its shared prefix lengths.

    Returns the merged order as row numbers (runs laid end to end) and the length of the
    prefix shared with the row before. A contender's known prefix is relative to the last
    row taken out. Only the head of each run is a bytes object.
    """
    k = 1
    while k < len(runs):
        k *= 2
    size = [len(r[0]) for r in runs] + [0] * (k - len(runs))
    first = np.concatenate([[0], np.cumsum(size)]).tolist()
    index, known = [0] * k, [0] * k
    lcp = [r[1].tolist() for r in runs]
    head: list[bytes | None] = [runs[i][0][0].tobytes() if size[i] else None for i in range(k)]
    loser = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); a tie in known prefix compares from there on, and the loser learns its new one."""
        x, y = head[a], head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p = known[a]
        if p != known[b]:
            return (a, b) if p > known[b] else (b, a)
        u, v = x[p:], y[p:]
        if u == v:
            known[b] = width
            return a, b
        differ = int.from_bytes(u) ^ int.from_bytes(v)
        p = width - (differ.bit_length() + 7) // 8
        if u < v:
            known[b] = p
            return a, b
        known[a] = p
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        won, loser[node] = play(build(2 * node), build(2 * node + 1))
        return won

    champion = build(1)
    order, shared = np.empty(first[-1], dtype=np.int64), np.empty(first[-1], dtype=np.int64)
    for place in range(first[-1]):
        order[place] = first[champion] + index[champion]
        shared[place] = known[champion]
        i = index[champion] = index[champion] + 1
        if i < size[champion]:
            head[champion] = runs[champion][0][i].tobytes()
            known[champion] = lcp[champion][i]
        else:
            head[champion] = None
        node = (champion + k) // 2
        while node:
            champion, loser[node] = play(champion, loser[node])
            node //= 2
    return order, shared


def repeated_offsets(shared: np.ndarray, left: np.ndarray, after: np.ndarray, before: np.ndarray, times: np.ndarray,
                     window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Per suffix (in merged order): least and greatest number of bytes before the anchor with which
    a ``window`` string around it is repeated (greatest -1: none).

    ``shared``: prefix shared with the suffix before, of the bytes that follow the anchor
    (-1 where the anchor's hash changes).
    """
    n, most = len(shared), window - gram
    low, high = np.full(n, window), np.full(n, -1)
    several = times >= 2
    # a suffix that occurs twice with all its surroundings is repeated as far as its text goes
    whole_low, whole_high = np.maximum(window - after, 0), np.minimum(before, most)
    ok = several & (whole_low <= whole_high)
    low[ok], high[ok] = whole_low[ok], whole_high[ok]
    # anchors of which all suffixes are like that are done
    anchor = np.cumsum(shared < gram)
    open_ = np.bincount(anchor, ~several, minlength=anchor.max(initial=0) + 1) > 0
    size = np.bincount(anchor, minlength=len(open_))
    use = np.flatnonzero((open_ & (size > 1))[anchor])
    if not len(use):
        return low, high
    # shared prefixes between the rows that stay: anchors leave as a whole
    r_shared, rows = shared[use], np.ascontiguousarray(left[use])
    by_left = np.argsort(rows.view(f"V{most}").ravel(), kind="stable") if most else np.arange(len(use))
    l_shared = _shared(rows[by_left])
    count, a, b = times[use], after[use], before[use]
    u_low, u_high = low[use], high[use]
    l_block = np.zeros(len(use), dtype=np.int64)
    for offset in range(most + 1):
        valid = np.flatnonzero((a >= window - offset) & (b >= offset))
        if not len(valid):
            continue
        r_block = np.cumsum(r_shared < window - offset)
        l_block[by_left] = np.cumsum(l_shared < offset)
        code = r_block[valid] * (len(use) + 1) + l_block[valid]
        order = np.argsort(code, kind="stable")
        heads = np.flatnonzero(np.diff(code[order], prepend=-1))
        total = np.add.reduceat(count[valid][order], heads)
        twice = valid[order][np.repeat(total, np.diff(heads, append=len(order))) >= 2]
        u_low[twice] = np.minimum(u_low[twice], offset)
        u_high[twice] = offset
    low[use], high[use] = u_low, u_high
    return low, high


def _merge(window: int, gram: int):
    """applyInArrow: all runs of one range -> (doc_id, row_hash, start, end) to remove."""
    key, most = window + 8, window - gram

    def run(group: pa.Table) -> pa.Table:
        runs, lefts, afters, befores, times, refs, first = [], [], [], [], [], [], 0
        for size, blob in zip(group["size"].to_pylist(), group["run"].to_pylist(), strict=True):
            (shared, rest, l_shared, l_rest, after, before, entry, doc, pos, ids, nulls, hashes) = _unpack(blob, size)
            shared, l_shared = np.frombuffer(shared, np.uint16), np.frombuffer(l_shared, np.uint16)
            runs.append((_restored(shared, rest, key), shared))
            lefts.append(_restored(l_shared, l_rest, most))
            afters.append(np.frombuffer(after, np.uint16).astype(np.int64))
            befores.append(np.frombuffer(before, np.uint16).astype(np.int64))
            entry, doc = np.frombuffer(entry, np.int32), np.frombuffer(doc, np.int32)
            times.append(np.bincount(entry, minlength=len(shared)))
            refs.append((entry + first, np.frombuffer(pos, np.int32), np.frombuffer(ids, np.int64)[doc],
                         np.frombuffer(nulls, bool)[doc], np.frombuffer(hashes, np.int64)[doc]))
            first += len(shared)
        row, shared = merge_runs(runs, key)
        runs.clear()
        left = np.concatenate(lefts)
        lefts.clear()
        left = left[row]
        after, before, count = (np.concatenate(x)[row] for x in (afters, befores, times))
        known = shared - 8
        # rows equal in all bytes and in how far their text goes are one suffix
        known[0] = -1
        left, after, before, count, known, merged = _fold(left, after, before, count, known, window)
        low, high = repeated_offsets(np.where(known < 0, -1, known), left, after, before, count, window, gram)
        place = np.empty(first, dtype=np.int64)
        place[row] = merged
        entry, pos, ids, nulls, hashes = (np.concatenate(x) for x in zip(*refs, strict=True))
        at = place[entry]
        hit = high[at] >= 0
        start, end = pos[hit] - high[at[hit]], pos[hit] - low[at[hit]] + window
        return pa.table({"doc_id": pa.array(ids[hit], mask=nulls[hit]), "row_hash": pa.array(hashes[hit]),
                         "start": pa.array(start.astype(np.int32)), "end": pa.array(end.astype(np.int32))})
    return run


def _fold(left: np.ndarray, after: np.ndarray, before: np.ndarray, count: np.ndarray, known: np.ndarray, window: int):
    """Merge equal neighbours among suffixes with equal keys; ``merged`` maps old rows to new ones."""
    block = np.cumsum(known < window)  # equal keys
    whole = np.concatenate([block.astype(">i8").view(np.uint8).reshape(-1, 8), left,
                            after.astype(">u2").view(np.uint8).reshape(-1, 2), before.astype(">u2").view(np.uint8).reshape(-1, 2)], axis=1)
    texts = np.ascontiguousarray(whole).view(f"V{whole.shape[1]}").ravel()
    order = np.argsort(texts, kind="stable")
    new = np.ones(len(order), dtype=bool)
    for i in range(1, len(order), RUN):  # piece by piece: a range may hold a frequent anchor's many suffixes
        part = order[i - 1:i + RUN]
        new[i:i + RUN] = texts[part[1:]] != texts[part[:-1]]
    merged = np.empty(len(order), dtype=np.int64)
    merged[order] = np.cumsum(new) - 1
    heads = order[new]
    total = np.bincount(merged, count).astype(np.int64)
    # a block keeps its place, and its first row its known prefix; later rows of a block share the whole key
    first = np.searchsorted(block, block[heads])
    opens = np.diff(block[heads], prepend=0) > 0
    return left[heads], after[heads], before[heads], total, np.where(opens, known[first], window), merged


# ---- operator ----------------------------------------------------------------------------------------------------

def _hot_windows(window: int, gram: int):
    """mapInArrow: every window around the given anchors -> (doc_id, row_hash, start, digest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, row_hash, text, pos in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row_hash", "text", "pos")), strict=True):
                raw = text.encode()
                starts = sorted({s for p in pos for s in range(max(0, p - window + gram), min(p, len(raw) - window) + 1)})
                for i in range(0, len(starts), 4096):
                    some = starts[i:i + 4096]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_id] * len(some), pa.int64()), pa.array([row_hash] * len(some), pa.int64()), pa.array(some, pa.int32()),
                        pa.array([hashlib.blake2b(raw[s:s + window], digest_size=16).digest() for s in some], pa.binary())],
                        names=["doc_id", "row_hash", "start", "digest"])
    return run


def duplicate_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, often: int = OFTEN) -> DataFrame:
    """doc_id, row_hash, start, end: byte spans (overlapping) covered by strings that also start elsewhere."""
    rows = keyed(docs)
    found = rows.mapInArrow(_anchor_rows(window, gram), "doc_id long, row_hash long, pos int, gram long")
    repeated = found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    at = found.join(repeated, "gram").groupBy(*ROW_KEY, (F.col("n") > hot).alias("hot"))
    # rows alike in doc_id and text put their anchors here together; they are told apart by count
    listed = cut(at.agg(F.collect_list(F.struct("pos", "gram", (F.col("n") > often).alias("often"))).alias("x")), "anchors")
    total = listed.agg(F.sum(F.size("x")), F.max("hot")).first()
    spans = "doc_id long, row_hash long, start int, end int"
    if not total[0]:
        return docs.sparkSession.createDataFrame([], spans)
    ranges = max(1, total[0] // RUN + 1)

    def joined(is_hot: bool) -> DataFrame:
        mine = listed.where(F.col("hot") == is_hot).select(*ROW_KEY, F.col("x.pos").alias("pos"), F.col("x.gram").alias("gram"), F.col("x.often").alias("often"))
        return same_row(rows, mine, "inner").select(*ROW_KEY, "text", "pos", "gram", "often")

    runs = joined(False).mapInArrow(_runs(window, gram, ranges), "range int, size long, run binary")
    # as many tasks as ranges: what one of them reads does not grow with the corpus
    out = runs.repartition(min(ranges, MAX_TASKS), "range").groupBy("range").applyInArrow(_merge(window, gram), spans)
    if total[1]:
        windows = joined(True).select(*ROW_KEY, "text", "pos").mapInArrow(_hot_windows(window, gram), "doc_id long, row_hash long, start int, digest binary")
        windows = cut(windows, "hot-windows")
        twice = windows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest", "n")
        # the windows of a frequent digest stay where they are; its count comes to them
        met = join_group_values(windows, ["digest"], twice, "n", ["n"]).where("n IS NOT NULL")
        out = out.unionByName(met.select(*ROW_KEY, "start", (F.col("start") + window).alias("end")))
    return out


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted maximal runs of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def suffix_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, often: int = OFTEN) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed_spans.

    Bytes are UTF-8; ``removed_spans`` lists the maximal removed runs as 'start:end'.

    - null text is empty; texts shorter than ``window`` lose nothing;
    - strings are judged on the input; all occurrences go, the first too;
    - rows that repeat a doc_id and its text are copies of each other like any others;
    - an empty table gives an empty result; other columns are ignored.
    """
    per_row = duplicate_spans(docs, window, gram, hot, often).groupBy(*ROW_KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    all_rows = same_row(keyed(docs), per_row).select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw, digest, last = text.encode(), hashlib.sha256(), 0
                gone = joined_spans([(s["start"], s["end"]) for s in spans or []])
                for start, end in gone:
                    digest.update(raw[last:start])
                    last = end
                digest.update(raw[last:])
                out.append((len(raw), sum(e - s for s, e in gone), len(gone), digest.hexdigest(), ",".join(f"{s}:{e}" for s, e in gone)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(columns[i], pa.int64()) for i in range(3)), *(pa.array(columns[i], pa.string()) for i in (3, 4))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed_spans"])

    return all_rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed_spans string")

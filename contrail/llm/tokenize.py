"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch (a piece never reaches across the start of a word) are
concatenated and indexed by a suffix array. Every piece of the vocabulary is found by
binary search as a range of suffixes; the ranges give the edges (position, length,
piece), which are sorted by position and relaxed: each word starts as single
characters and takes, step by step, the best-scored edge that joins two neighbouring
symbols (ties to the left), which is the order that a BPE model defines. Characters
without a piece become byte pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from contrail.llm.common import TEXT_BATCH, bound_batches, id_and_text

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters of words indexed at once, and words remembered per task.
INDEX_CHARS = 400_000
CACHE_WORDS = 400_000
#: Words above this are relaxed with a heap, one by one, instead of side by side.
LONG_WORD = 48


class Vocabulary:
    """Pieces of a BPE model with byte fallback, read once on the driver (its size is fixed)."""

    def __init__(self, model_file: str = MODEL):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(len(pieces))]
        self.byte_id = np.zeros(256, dtype=np.int32)
        self.surface: list[bytes] = []
        for i, piece in enumerate(pieces):
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.surface.append(bytes([value]))
            else:
                self.surface.append(b"" if special[i] else piece.replace(SPACE, " ").encode())
        ids = [i for i in range(len(pieces)) if not special[i]]
        # priority: 0 is merged first; equal scores share a priority and go from left to right
        score = np.array([sp.get_score(i) for i in ids])
        level = np.unique(-score, return_inverse=True)[1]
        self.single = {pieces[i]: i for i in ids if len(pieces[i]) == 1}
        self.longer = [(pieces[i], i) for i in ids if len(pieces[i]) > 1]
        self.priority = np.full(len(pieces), np.iinfo(np.int64).max)
        self.priority[ids] = level
        self.longest = max((len(p) for p, _ in self.longer), default=1)
        joined = {c for p, _ in self.longer for c in p}
        # cuts that no piece spans: before a run of spaces, and around line ends if no longer piece holds one
        alone = "".join(c for c in "\n\t\r" if c not in joined)
        self.nul = self.byte_id[:1].tobytes()
        alone += "\0"  # ends words in the index, so it is its own word, and has no longer piece
        self.word = re.compile(f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+")


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least their first ``depth`` characters, by prefix doubling.

    The first rank already packs as many characters as fit into 62 bits.
    """
    letter = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    bits = max(1, int(letter.max()).bit_length())
    span = max(1, min(62 // bits, depth))
    packed = np.zeros(len(letter) + span, dtype=np.int64)
    for i in range(min(span, len(letter))):
        packed[:len(letter) - i] |= letter[i:] << (bits * (span - 1 - i))
    rank = packed[:len(letter)]
    while span < depth:
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64) + 1
        ahead = np.zeros_like(rank)
        ahead[:-span] = rank[span:]
        rank = rank * (len(rank) + 2) + ahead
        span *= 2
    return np.argsort(rank, kind="stable")


def _search(codes: np.ndarray, order: np.ndarray, pattern: np.ndarray, length: np.ndarray, upper: bool) -> np.ndarray:
    """Binary search of all patterns at once: the first suffix not below (or, upper, above) each."""
    low, high = np.zeros(len(pattern), np.int64), np.full(len(pattern), len(order))
    padded = np.concatenate([codes, np.zeros(pattern.shape[1], codes.dtype)])
    columns = np.arange(pattern.shape[1])
    inside = columns[None, :] < length[:, None]
    while (open_ := low < high).any():
        mid = (low + high) // 2
        text = padded[order[np.minimum(mid, len(order) - 1)][:, None] + columns]
        differs = (text != pattern) & inside
        at = differs.argmax(axis=1)
        rows = np.arange(len(pattern))
        cmp = np.where(differs[rows, at], np.sign(text[rows, at].astype(np.int64) - pattern[rows, at]), 0)
        right = open_ & ((cmp <= 0) if upper else (cmp < 0))
        low = np.where(right, mid + 1, low)
        high = np.where(open_ & ~right, mid, high)
    return low


class Encoder:
    """Encodes words of one task; the vocabulary's arrays are built once."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.pattern = np.zeros((len(v.longer), v.longest), dtype=np.int32)
        for row, (piece, _) in enumerate(v.longer):
            self.pattern[row, :len(piece)] = [ord(c) for c in piece]
        self.length = np.array([len(p) for p, _ in v.longer], dtype=np.int64)
        self.piece = np.array([i for _, i in v.longer], dtype=np.int32)
        self.cache: dict[str, bytes] = {}

    def edges(self, codes: np.ndarray) -> np.ndarray:
        """Table (position, length) -> piece id, or -1: every occurrence of every piece of two or more characters."""
        order = suffix_order(codes, self.v.longest)
        present = np.unique(codes)
        known = np.isin(self.pattern, present) | (np.arange(self.v.longest)[None, :] >= self.length[:, None])
        use = np.flatnonzero(known.all(axis=1))
        low = _search(codes, order, self.pattern[use], self.length[use], False)
        high = _search(codes, order, self.pattern[use], self.length[use], True)
        n = high - low
        rows = np.repeat(np.arange(len(use)), n)
        at = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
        by_position = np.argsort(at, kind="stable")
        at, rows = at[by_position], rows[by_position]
        table = np.full((len(codes) + 1, self.v.longest + 1), -1, dtype=np.int32)
        table[at, self.length[use][rows]] = self.piece[use][rows]
        return table

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Token ids (int32, as bytes) of each distinct word."""
        out: list[bytes] = [b""] * len(words)
        start, size, block = 0, 0, []
        for i, w in enumerate(words):
            block.append(w)
            size += len(w) + 1
            if size >= INDEX_CHARS or i == len(words) - 1:
                out[start:i + 1] = self._encode_block(block)
                start, size, block = i + 1, 0, []
        return out

    def _encode_block(self, words: list[str]) -> list[bytes]:
        # a zero ends every word: no piece holds one, so no edge crosses words
        text = "\0".join(w.replace("\0", "") for w in words) + "\0"
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.int32)
        table = self.edges(codes)
        ends = np.flatnonzero(codes == 0)
        starts = np.concatenate([[0], ends[:-1] + 1])
        nxt = np.arange(1, len(codes) + 1)
        alive = codes != 0
        lengths = ends - starts
        self._relax(table, nxt, alive, starts, ends, lengths <= LONG_WORD)
        for i in np.flatnonzero(lengths > LONG_WORD):
            self._relax_long(table, nxt, alive, int(starts[i]), int(ends[i]))
        at = np.flatnonzero(alive)
        span = nxt[at] - at
        ids = np.where(span > 1, table[at, np.minimum(span, self.v.longest)], self._singles(codes[at]))
        unknown = np.flatnonzero(ids < 0)
        raw = [self.v.byte_id[list(chr(c).encode("utf-8", "replace"))] for c in codes[at[unknown]].tolist()]
        size = np.ones(len(at), dtype=np.int64)
        size[unknown] = [len(r) for r in raw]
        first = np.concatenate([[0], np.cumsum(size)])
        flat = np.repeat(ids, size)
        for where, r in zip(first[unknown].tolist(), raw, strict=True):
            flat[where:where + len(r)] = r
        data = flat.astype(np.int32).tobytes()
        cut = (first[np.searchsorted(at, np.concatenate([starts, codes.shape]))] * 4).tolist()
        return [data[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def _singles(self, codes: np.ndarray) -> np.ndarray:
        """Piece id of each single character, or -1."""
        kinds, back = np.unique(codes, return_inverse=True)
        return np.array([self.v.single.get(chr(c), -1) for c in kinds.tolist()], dtype=np.int64)[back] if len(codes) else codes

    def _relax(self, table: np.ndarray, nxt: np.ndarray, alive: np.ndarray, starts: np.ndarray, ends: np.ndarray, use: np.ndarray) -> None:
        """The used words side by side; each takes its best edge per step until none has one."""
        word = np.repeat(np.arange(len(starts)), ends - starts)
        symbols = np.flatnonzero(alive)
        symbols, word = symbols[use[word]], word[use[word]]
        end = ends[word]
        while len(symbols):
            second = nxt[symbols]
            third = nxt[np.minimum(second, len(nxt) - 1)]
            span = third - symbols
            fits = (second < end) & (third <= end) & (span <= self.v.longest)
            piece = np.where(fits, table[symbols, np.where(fits, span, 0)], -1)
            has = np.flatnonzero(piece >= 0)
            if not len(has):
                return
            key = self.v.priority[piece[has]] * (len(nxt) + 1) + symbols[has]
            owner = word[has]
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            chosen = np.minimum.reduceat(key, heads) % (len(nxt) + 1)
            gone = nxt[chosen]
            nxt[chosen] = nxt[gone]
            alive[gone] = False
            live = np.zeros(len(starts), dtype=bool)
            live[owner[heads]] = True
            stay = live[word] & alive[symbols]
            symbols, word, end = symbols[stay], word[stay], end[stay]

    def _relax_long(self, table: np.ndarray, nxt: np.ndarray, live: np.ndarray, start: int, end: int) -> None:
        """One long word: a heap of edges, stale entries skipped."""
        before = list(range(-1, end - start - 1))
        after = list(range(1, end - start + 1))
        alive, heap = [True] * (end - start), []

        def offer(p: int) -> None:
            q = after[p]
            if q < end - start and after[q] - p <= self.v.longest and (piece := int(table[start + p, after[q] - p])) >= 0:
                heapq.heappush(heap, (int(self.v.priority[piece]), p, q, after[q]))

        for p in range(end - start - 1):
            offer(p)
        while heap:
            _, p, q, r = heapq.heappop(heap)
            if not (alive[p] and q < end - start and alive[q]) or after[p] != q or after[q] != r:
                continue
            after[p], alive[q] = r, False
            if r < end - start:
                before[r] = p
            if before[p] >= 0:
                offer(before[p])
            offer(p)
        for p in range(end - start):
            live[start + p] = alive[p]
            if alive[p]:
                nxt[start + p] = start + after[p]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids (int32, as bytes) of whole texts."""
        parts = [self.v.word.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        self.cache["\0"] = self.v.nul
        new = list(dict.fromkeys(w for p in parts for w in p if w not in self.cache))
        self.cache.update(zip(new, self.encode_words(new), strict=True))
        return [b"".join([self.cache[w] for w in p]) for p in parts]


def decode(surface: list[bytes], ids: np.ndarray) -> str:
    """Text of a token sequence: byte pieces joined, word marks to spaces, the first one dropped."""
    raw = b"".join([surface[i] for i in ids.tolist()]).decode("utf-8", "replace")
    return raw[1:] if raw.startswith(" ") else raw


def tokenize(docs: DataFrame, model_file: str = MODEL, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: the ``keep`` columns, ids, n_tokens, decoded_sha256, round_trip.

    ``round_trip`` tells whether decoding the ids gives back the text. Null and empty
    texts have no tokens. The word mark itself decodes as a space, so a text that holds
    one does not round-trip. Repeated rows give repeated results, an empty table an
    empty result; columns other than ``keep`` and text are ignored.
    """
    bound_batches(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_file))
    rows = id_and_text(docs) if keep == ("doc_id",) else docs.select(*keep, "text")
    kept = [f for f in rows.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXT_BATCH):
                batch = whole.slice(at, TEXT_BATCH)
                texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
                coded = encoder.encode(texts)
                size = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
                decoded = [decode(encoder.v.surface, np.frombuffer(c, dtype=np.int32)) for c in coded]
                offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(coded), dtype=np.int32), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(f.name)) for f in kept), ids, pa.array(size),
                     pa.array([hashlib.sha256(d.encode("utf-8", "replace")).hexdigest() for d in decoded], pa.string()),
                     pa.array([a == b for a, b in zip(texts, decoded, strict=True)], pa.bool_())],
                    names=[*(f.name for f in kept), "ids", "n_tokens", "decoded_sha256", "round_trip"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(run, f"{kinds}, ids array<int>, n_tokens long, decoded_sha256 string, round_trip boolean")

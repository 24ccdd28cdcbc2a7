"""Phrase collocation mining with double-array tries.

Texts are cut into pieces and words and written once as blocks of one language: the
block's distinct words and one small number per word occurrence. Words have 64-bit
ids that any task can compute. Phrases grow level by
level (Apriori): a phrase of k words can be frequent only if its first k-1 words are, so
the frequent phrases of a level, in a broadcast double-array trie, tell where a longer
one can stand; what the tasks find there, summed over all of them, makes the next level's
candidates. All candidates then go into tries, numpy moves the states of all positions of
a block one word at a time, accepting states are counted by bincount, and the tasks' sums
are added up.

A trie holds at most SHARD phrases; more phrases are dealt to several tries, counted one
after the other. The filter for a phrase's last word is a bit map of fixed size. So what is
broadcast never grows with the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import bound_batches, cut, mixed64, text_or_empty

# Fixed values of the contract.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
NO_LANG = "und"
MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000

#: Characters of a block (a longer single text is a block of its own).
BLOCK_CHARS = 3_000_000
#: Bytes of an Arrow batch of blocks; Spark's own limit would let a task hold all of its blocks several times over.
BATCH_BYTES = 8 << 20
#: Phrases of one broadcast trie.
SHARD = 400_000
#: Bits of the map of frequent words.
MAP_BITS = 1 << 25
#: Found extensions, and distinct words of blocks, that a task holds before it hands their counts on.
HOLD, HOLD_WORDS = 700_000, 400_000
#: Word occurrences per bucket of pairs.
BUCKET = 1_500_000
#: Phrases of a range whose pairs with a word travel together.
WIDEST_RANGE = 16_384
#: Phrases whose counts travel as one row, and tasks whose rows are added up first.
CHUNK, TASKS_OF_PART = 8192, 64


#: What each byte of UTF-8 is: lower case for A-Z, a space for the white space between words, a break between pieces.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE, _BREAK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_SPACE[list(b" \t")] = True
_BREAK[list(BREAKS)] = True


def _raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an array of strings."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    return at - at[0], np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)


def _word_ids(lang: str, words: pa.Array, seed: int) -> np.ndarray:
    """A 64-bit number of each word of a language: its bytes as random numbers, weighted by their places."""
    rng = np.random.default_rng([seed, 13])
    numbers, step = rng.integers(1, 1 << 63, 256, dtype=np.uint64), rng.integers(1 << 62, 1 << 63, dtype=np.uint64) | np.uint64(1)
    at, data = _raw(words)
    lengths = np.diff(at)
    weights = np.cumprod(np.full(int(lengths.max()), step))
    place = np.arange(len(data), dtype=np.int32) - np.repeat(at[:-1], lengths)
    sums = np.add.reduceat(numbers[data] * weights[place], at[:-1])
    salt = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest()))
    return mixed64(sums ^ salt).view(np.int64)


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words, and the number of each word occurrence with -1 between pieces."""
    at, data = _raw(texts)
    kept = ~(_SPACE | _BREAK)[data]
    opens = np.zeros(len(data) + 1, dtype=bool)  # texts start here
    opens[at[:-1]] = True
    before = np.append(False, kept[:-1]) & ~opens[:-1]
    starts = np.flatnonzero(kept & ~before)
    if not len(starts):
        return pa.array([], pa.string()), np.zeros(0, np.int32)
    piece = np.cumsum(_BREAK[data], dtype=np.int32)[starts] + np.cumsum(opens, dtype=np.int32)[starts]
    ends = np.append(np.cumsum(kept, dtype=np.int32)[starts[1:]] - 1, np.count_nonzero(kept)).astype(np.int32)
    offsets = np.append(np.int32(0), ends).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(_LOWER[data[kept]].tobytes()))
    coded = words.dictionary_encode()
    return coded.dictionary, np.insert(coded.indices.to_numpy(zero_copy_only=False), np.flatnonzero(np.diff(piece)) + 1, -1).astype(np.int32)


def text_blocks(docs: DataFrame) -> DataFrame:
    """lang, words, codes (each occurrence's position among the words, -1: a break)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[pa.Array]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, held in waiting.items():
                words, codes = _tokens(pa.concat_arrays(held))
                if len(words):
                    one = pa.array([0, len(words)], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.ListArray.from_arrays(one, words), pa.array([_stored(codes, len(words))], pa.binary())],
                        names=["lang", "words", "codes"])
            waiting.clear()

        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang")
            lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
            at = 0
            while at < len(texts):  # as many rows as fit the block, at least one
                room = np.searchsorted(np.cumsum(lengths[at:]), BLOCK_CHARS - size, "right")
                to = at + max(int(room), 1)
                some, names = texts.slice(at, to - at), langs.slice(at, to - at)
                for lang in pc.unique(names).to_pylist():
                    waiting.setdefault(lang, []).append(some.filter(pc.equal(names, lang)))
                size += int(lengths[at:to].sum())
                at = to
                if size >= BLOCK_CHARS or at < len(texts):
                    yield from flush()
                    size = 0
        yield from flush()

    bound_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "lang string, words array<string>, codes binary")


def _stored(codes: np.ndarray, words: int) -> bytes:
    """The kind of number, then the numbers: two bytes each where that is enough."""
    return b"h" + codes.astype(np.int16).tobytes() if words < 1 << 15 else b"i" + codes.tobytes()


def _codes(batch: pa.RecordBatch, row: int) -> np.ndarray:
    raw = batch.column("codes")[row].as_py()
    return np.frombuffer(raw, dtype=raw[:1].decode(), offset=1).astype(np.int32)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks -> (lang, word, n): how often each word occurs in the blocks that a task holds together."""
    held: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            coded = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
            n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), np.concatenate([p[1] for p in parts]), minlength=len(coded.dictionary)).astype(np.int64)
            for at in range(0, len(n), 20_000):
                some = coded.dictionary.slice(at, 20_000)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), some, pa.array(n[at:at + 20_000])], names=["lang", "word", "n"])
        held.clear()

    for batch in batches:
        for row, lang in enumerate(batch.column("lang").to_pylist()):
            codes, words = _codes(batch, row), batch.column("words")[row].values
            held.setdefault(lang, []).append((words, np.bincount(codes[codes >= 0], minlength=len(words))))
            size += len(words)
            if size > HOLD_WORDS:
                yield from flush()
                size = 0
    yield from flush()


def _named(seed: int) -> Callable:
    """(lang, word, n) -> the same with the word's id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch.column("lang")).to_pylist():
                some = batch.filter(pc.equal(batch.column("lang"), lang))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(_word_ids(lang, some.column("word"), seed))], names=["lang", "word", "n", "id"])
    return run


@dataclass
class DoubleArrayTrie:
    """Phrases as paths of states: from state s, word c leads to t = base[s] + c if check[t] is s. State 0 is the start."""
    alphabet: np.ndarray
    base: np.ndarray
    check: np.ndarray
    phrase: np.ndarray
    depth: int

    @classmethod
    def build(cls, phrases: list[np.ndarray], rows: list[np.ndarray], seed: int = 3) -> DoubleArrayTrie:
        """``phrases``: one array (phrases x words of word ids) per length; ``rows``: what each phrase's state reports."""
        alphabet = np.unique(np.concatenate([p.ravel() for p in phrases]))
        size = len(alphabet)
        # nodes level by level: a node is (its parent, its word)
        coded = [np.searchsorted(alphabet, p) for p in phrases]
        at = [np.zeros(len(p), dtype=np.int64) for p in phrases]
        parents, labels, count = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 1
        for level in range(max(p.shape[1] for p in phrases)):
            alive = [i for i, p in enumerate(phrases) if p.shape[1] > level]
            keys, where = np.unique(np.concatenate([at[i] * size + coded[i][:, level] for i in alive]), return_inverse=True)
            parents.append(keys // size)
            labels.append(keys % size)
            for i in alive:
                at[i], where = where[:len(at[i])] + count, where[len(at[i]):]
            count += len(keys)
        parent, label = np.concatenate(parents), np.concatenate(labels)  # of nodes 1, 2, ...
        order = np.argsort(parent, kind="stable")
        owners, starts, widths = np.unique(parent[order], return_index=True, return_counts=True)

        # slots: the start's children at 1 + word, then the widest parents first
        slot, used, top = np.zeros(count, np.int64), np.zeros(4 * count + 4 * size + 8, dtype=bool), size + 1
        base_of = np.ones(count, np.int64)
        used[0] = True
        rng = np.random.default_rng(seed)
        for k in np.argsort(-widths, kind="stable"):
            owner = owners[k]
            if widths[k] == 1 and owner:
                break
            if top + size + 2 > len(used):
                used = np.concatenate([used, np.zeros(len(used) + size, dtype=bool)])
            children = order[starts[k]:starts[k] + widths[k]]
            words = label[children]
            begin = 1
            if owner:
                for begin in rng.integers(1, top + 1, 48):
                    if not used[begin + words].any():
                        break
                else:
                    begin = top
            used[begin + words] = True
            base_of[owner] = begin
            slot[children + 1] = begin + words
            top = max(top, int(begin + words[-1]) + 1)
        # a parent of one child takes any free slot
        single = np.flatnonzero((widths == 1) & (owners != 0))
        children = order[starts[single]]
        free = np.flatnonzero(~used[size + 1:])[:len(single)] + size + 1
        if len(free) < len(single):
            free = np.concatenate([free, len(used) + np.arange(len(single) - len(free))])
        slot[children + 1] = free
        base_of[owners[single]] = free - label[children]

        length = int(slot.max() + size + 2)
        length = max(length, int(base_of.max()) + size + 2)
        base, check, phrase = np.zeros(length, np.int32), np.full(length, -1, np.int32), np.full(length, -1, np.int64)
        base[slot] = base_of
        check[slot[1:]] = slot[parent]
        for i in range(len(phrases)):
            phrase[slot[at[i]]] = rows[i]
        return cls(alphabet, base, check, phrase, max(p.shape[1] for p in phrases))

    def local(self, ids: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """A block's occurrences in the trie's own numbers (-1: a break, or a word of no phrase), padded by ``depth``."""
        near = np.minimum(np.searchsorted(self.alphabet, ids), len(self.alphabet) - 1)
        renamed = np.append(np.where(self.alphabet[near] == ids, near, -1), -1)
        return np.append(renamed[codes], np.full(self.depth, -1)).astype(np.int32)

    def walk(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per level: positions whose path is alive, and their states. All positions move at once."""
        at = np.flatnonzero(words >= 0)
        state = np.zeros(len(at), dtype=np.int32)
        for level in range(self.depth):
            to = self.base[state] + words[at + level]
            alive = self.check[to] == state
            at, state = at[alive], to[alive]
            yield at, state


def _packed(*columns: np.ndarray) -> bytes:
    """Sorted columns as compressed differences."""
    return b"".join(len(z := pa.compress(np.diff(c, prepend=c.dtype.type(0)).tobytes(), "zstd", asbytes=True)).to_bytes(4, "little")
                    + c.nbytes.to_bytes(4, "little") + z for c in columns)


def _unpacked(blob: bytes, kinds: tuple) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size, full = (int.from_bytes(blob[at + i:at + i + 4], "little") for i in (0, 4))
        out.append(np.cumsum(np.frombuffer(pa.decompress(blob[at + 8:at + 8 + size], full, "zstd", asbytes=True), kind), dtype=kind))
        at += 8 + size
    return out


_PAIRS = (np.int64, np.int32, np.int32, np.int32)  # words, how many phrases each follows, those phrases, how often


def _summed(word: np.ndarray, phrase: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (word, phrase) pairs in one, sorted by both."""
    words, number = np.unique(word, return_inverse=True)
    span = int(phrase.max(initial=0)) + 1
    keys, where = np.unique(number * span + phrase, return_inverse=True)
    return words[keys // span], keys % span, np.bincount(where, n, minlength=len(keys)).astype(np.int64)


def _extend(trie, bits, buckets: int, seed: int) -> Callable:
    """Blocks -> (bucket, pairs): how often each frequent word follows each phrase of the trie in this task.

    A pair's bucket is that of its word and a range of phrases, the shorter the more buckets there are: over all
    tasks no word brings more than about BUCKET pairs to one bucket.
    """
    width = max(1, min(WIDEST_RANGE, BUCKET // buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, frequent = trie.value, bits.value
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            word, phrase = (np.concatenate([h[i] for h in held] or [np.zeros(0, np.int64)]) for i in (0, 1))
            held.clear()
            if not len(word):
                return
            word, phrase, n = _summed(word, phrase, np.ones(len(word)))
            bucket = (mixed64(word ^ mixed64(phrase // width).view(np.int64)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            word, phrase, n, bucket = word[order], phrase[order], n[order], bucket[order]
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            for start, end in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
                heads = np.flatnonzero(np.diff(word[start:end], prepend=word[start] - 1))
                widths = np.diff(heads, append=end - start)
                blob = _packed(word[start:end][heads], widths.astype(np.int32), phrase[start:end].astype(np.int32), n[start:end].astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([bucket[start]], pa.int32()), pa.array([blob], pa.binary())], names=["bucket", "pairs"])

        for batch in batches:
            for row in range(batch.num_rows):
                ids, codes = _word_ids(batch.column("lang")[row].as_py(), batch.column("words")[row].values, seed), _codes(batch, row)
                spot = ids.view(np.uint64) % np.uint64(MAP_BITS)
                allowed = np.append((frequent[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1), 0).astype(bool)
                for at, state in t.walk(t.local(ids, codes)):  # noqa: B007  the last level is the whole phrase
                    pass
                follows = np.append(codes, -1)[at + t.depth]
                good = allowed[follows]
                held.append((ids[follows[good]], t.phrase[state[good]]))
                if sum(len(h[0]) for h in held) > HOLD:
                    yield from flush()
        yield from flush()
    return run


def _frequent_pairs(pids, min_count: int) -> Callable:
    """applyInArrow: all pairs of a bucket -> (pid, next, n) of the frequent ones."""
    def run(group: pa.Table) -> pa.Table:
        parts = [_unpacked(blob, _PAIRS) for blob in group["pairs"].to_pylist()]
        word = np.concatenate([np.repeat(words, widths) for words, widths, _, _ in parts])
        word, phrase, n = _summed(word, np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts]))
        good = n >= min_count
        return pa.table({"pid": pids.value[phrase[good]], "next": word[good], "n": n[good]})
    return run


def _counted(trie, seed: int) -> Callable:
    """Blocks -> (chunk, part, counts): occurrences of the trie's phrases in this task, CHUNK phrases to a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = trie.value
        total = np.zeros(len(t.base), dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for _, state in t.walk(t.local(_word_ids(batch.column("lang")[row].as_py(), batch.column("words")[row].values, seed), _codes(batch, row))):
                    total += np.bincount(state, minlength=len(total))
        ends = np.flatnonzero(t.phrase >= 0)
        counts = np.zeros(len(ends), dtype=np.int64)
        counts[t.phrase[ends]] = total[ends]
        part = TaskContext.get().partitionId() // TASKS_OF_PART
        for chunk in range(0, len(counts), CHUNK):
            if (some := counts[chunk:chunk + CHUNK]).any():
                yield pa.RecordBatch.from_arrays([pa.array([chunk // CHUNK], pa.int32()), pa.array([part], pa.int32()), pa.array([_packed(some)], pa.binary())],
                                                 names=["chunk", "part", "counts"])
    return run


def _added(group: pa.Table) -> pa.Table:
    total = sum(_unpacked(blob, (np.int64,))[0] for blob in group["counts"].to_pylist())
    return pa.table({"chunk": pa.array([group["chunk"][0].as_py()], pa.int32()), "counts": pa.array([_packed(total)], pa.binary())})


def _spread(pids) -> Callable:
    """applyInArrow: a chunk's sums -> (pid, n)."""
    def run(group: pa.Table) -> pa.Table:
        total = sum(_unpacked(blob, (np.int64,))[0] for blob in group["counts"].to_pylist())
        at = group["chunk"][0].as_py() * CHUNK
        return pa.table({"pid": pids.value[at:at + len(total)], "n": total})
    return run


def _over_tries(blocks: DataFrame, phrases: DataFrame, shard: int, job: Callable[..., DataFrame], schema: str, name: str) -> DataFrame:
    """``job(blocks, trie, pids)`` for tries of about ``shard`` phrases (pid, ids) one after the other, all results together."""
    spark = blocks.sparkSession
    n_tries = -(-phrases.count() // shard)
    found = spark.createDataFrame([], schema)
    for i in range(n_tries):
        part = phrases if n_tries == 1 else phrases.where(F.pmod(F.xxhash64("pid"), F.lit(n_tries)) == i)
        listed = part.select("pid", "ids").toArrow()  # bounded by ``shard``
        pids, flat, lengths = (listed.column("pid").to_numpy(), pc.list_flatten(listed.column("ids")).to_numpy(),
                               pc.list_value_length(listed.column("ids")).to_numpy())
        if not len(pids):
            continue
        ends = np.cumsum(lengths)
        sizes = np.unique(lengths)
        each = [np.flatnonzero(lengths == k) for k in sizes]
        words = [flat[(ends[rows] - k)[:, None] + np.arange(k)] for rows, k in zip(each, sizes, strict=True)]
        sent = [spark.sparkContext.broadcast(x) for x in (DoubleArrayTrie.build(words, each), pids)]
        found = found.unionByName(cut(job(blocks, *sent), name))
        for x in sent:
            x.destroy()
    return found


def _frequent_map(words: DataFrame) -> np.ndarray:
    """Bit map of the word ids: MAP_BITS bits, whatever the number of words (more words only let more through)."""
    # ids are signed, the map is read by unsigned ids: the power of two makes both remainders the same
    spot = F.pmod("id", F.lit(MAP_BITS))
    rows = (words.select(F.shiftright(spot, 6).alias("chunk"), F.expr(f"shiftleft(1L, cast(pmod(id, {MAP_BITS}) & 63 as int))").alias("bit"))
            .groupBy("chunk").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(MAP_BITS // 64, dtype=np.uint64)
    out[rows.column("chunk").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, shard: int = SHARD, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: lang, phrase, n of the frequent words; phrases: lang, phrase, k, a of 2 to ``max_words`` words; totals: lang, n of all words)."""
    spark = docs.sparkSession
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, BATCH_BYTES)
    try:
        return _phrase_counts(docs, max_words, min_count, shard, seed)
    finally:
        spark.conf.set(_BATCH, before)


def _phrase_counts(docs: DataFrame, max_words: int, min_count: int, shard: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    spark = docs.sparkSession
    blocks = cut(text_blocks(docs), "colloc-blocks")
    while True:
        counts = cut(blocks.mapInArrow(_word_counts, "lang string, word string, n long")
                     .groupBy("lang", "word").agg(F.sum("n").alias("n")).mapInArrow(_named(seed), "lang string, word string, n long, id long"), "colloc-words")
        if counts.groupBy("id").count().where("count > 1").isEmpty():
            break
        seed += 1  # two words of one id: all ids anew
    totals = cut(counts.groupBy("lang").agg(F.sum("n").alias("n")), "colloc-totals")
    words = cut(counts.where(F.col("n") >= min_count), "colloc-frequent")
    bits = spark.sparkContext.broadcast(_frequent_map(words))

    level = words.select("lang", F.col("word").alias("phrase"), F.array("id").alias("ids"), F.col("id").alias("pid"))
    last = words.select(F.col("id").alias("next"), "word")
    levels = []
    # what one bucket gathers stays the same however many words there are
    buckets = max(1, (totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"] or 0) // BUCKET)

    def grow(some: DataFrame, trie, pids) -> DataFrame:
        return (some.mapInArrow(_extend(trie, bits, buckets, seed), "bucket int, pairs binary").groupBy("bucket")
                .applyInArrow(_frequent_pairs(pids, min_count), "pid long, next long, n long"))

    def count(some: DataFrame, trie, pids) -> DataFrame:
        sums = some.mapInArrow(_counted(trie, seed), "chunk int, part int, counts binary").groupBy("chunk", "part").applyInArrow(_added, "chunk int, counts binary")
        return sums.groupBy("chunk").applyInArrow(_spread(pids), "pid long, n long")

    for k in range(2, max_words + 1):
        grown = _over_tries(blocks, level, shard, grow, "pid long, next long, n long", f"colloc-grown-{k}")
        level = cut(grown.join(level, "pid").join(last, "next").select(
            "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), F.concat("ids", F.array("next")).alias("ids"),
            F.monotonically_increasing_id().alias("pid")), f"colloc-level-{k}")
        levels.append(level.drop("pid"))
    bits.destroy()
    candidates = levels[0]
    for more in levels[1:]:
        candidates = candidates.unionByName(more)
    candidates = cut(candidates.withColumn("pid", F.monotonically_increasing_id()), "colloc-candidates")
    sums = _over_tries(blocks, candidates, shard, count, "pid long, n long", "colloc-counts")
    phrases = cut(candidates.join(sums, "pid").where(F.col("n") >= min_count).select("lang", "phrase", F.size("ids").alias("k"), F.col("n").alias("a")), "colloc-phrases")
    return words.select("lang", F.col("word").alias("phrase"), "n"), phrases, totals


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP, shard: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases.

    Score is floor(1000 a n / (l r)) of the cut with the lowest one (ties: the shortest first part), in
    exact arithmetic: decimals hold a up to 1e14, n, l and r up to 1e18. Phrases inside a longer candidate that is
    as frequent are left out. Order: score and a descending, then the phrase's bytes.

    - null text is empty; a null language is 'und', together with rows that say so;
    - repeated rows count as often as they stand; a text without words counts nothing;
    - no phrase reaches over a break, nor from one text into the next;
    - an empty table gives an empty result; columns other than text and lang are ignored.
    """
    words, phrases, totals = phrase_counts(docs, max_words, min_count, shard)
    known = words.unionByName(phrases.where(F.col("k") < max_words).select("lang", "phrase", F.col("a").alias("n")))
    spelled = phrases.withColumn("words", F.split("phrase", " "))

    # inside a longer candidate that is as frequent
    starts = F.explode(F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), s -> struct(s, m))))")).alias("at")
    inside = (spelled.where("k > 2").select("lang", "words", "a", starts)
              .select("lang", _part(F.col("words"), F.col("at.s"), F.col("at.m")).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    left = spelled.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")

    cuts = left.select("lang", "phrase", "a", "words", "k", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _part(F.col("words"), F.lit(1), F.col("cut")).alias("first"),
                       _part(F.col("words"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    first = known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rest = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(totals, "lang")
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(14,0)) * cast(n as decimal(18,0))) "
                   "div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))
    ranked = lowest.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

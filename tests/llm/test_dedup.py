"""Exact, substring, suffix-array and near deduplication against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm.exact_dedup import chunk_pattern, exact_dedup, kept_documents
from contrail.llm.near_dedup import BRANCH, SKETCH, TREES, components, leaf_nodes, near_dedup
from contrail.llm.substring_dedup import substring_dedup
from contrail.llm.suffix_dedup import _front_coded, _restored, merge_runs, suffix_dedup

WS = r"[\x20\x09-\x0D]+"
CLASH = "doc_id long, text string, keep_id long, h long, kept string, pos int, item string, label int, _sha string, spans int"
EDGE = [(1, "a  b\tc", "x"), (2, "a b c", "x"), (3, None, "x"), (4, "", None), (5, " ", None), (6, "a b c ", None), (None, "a b c", "y"),
        (7, "lone", "z"), (7, "lone", "z"), (7, "other", "z"), (None, None, None), (8, "é" * 9000, "z"), (9, "é" * 9000, "q")]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, None, 5, k, 1, "i", 2, "s", 3) for d, t, k in rows], CLASH)


def by_str(rows):
    return sorted(rows, key=str)


def exact_brute(rows):
    seen, count, ids = [], collections.Counter(), {}
    for d, t, *_ in rows:
        n = re.sub(WS, " ", t or "")
        seen.append((d, n))
        count[n] += 1
        if d is not None:
            ids[n] = min(d, ids.get(n, d))
    return by_str((d, ids.get(n), count[n], d == ids.get(n), hashlib.sha256(n.encode()).hexdigest()) for d, n in seen)


COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_exact_dedup_has_a_row_per_input_row(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, "a  b", "x")]
    got = by_str(tuple(r) for r in exact_dedup(frame(spark, rows)).select(COLUMNS).collect())
    assert got == exact_brute(rows) and len(got) == 3
    assert [r.doc_id for r in kept_documents(frame(spark, rows)).collect()] == [1]


@pytest.mark.parametrize("alphabet", [
    "的是了在不一" + "".join(map(chr, range(0x4E10, 0x4E80))), "абвгдежзиклмнопрстуфхцчшщъыьэюя     ", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "กขคงจฉชซานมยรลวสหอเแโ", "אבגדהוזחטיכלמנסעפצקרשת    ", "abcdefghijklmnopqrstuvwxyz     "])
def test_chunks_of_any_script_survive_a_shift(spark, alphabet):
    """A long text and the same text after a few more characters have most chunks in common."""
    rng = random.Random(3)
    text = "".join(rng.choice(alphabet) for _ in range(60_000))
    chunks = lambda t: spark.createDataFrame([(t,)], "text string").select(F.regexp_extract_all("text", F.lit(chunk_pattern()), F.lit(0))).first()[0]
    one, two = chunks(text), chunks("Zz" + "".join(rng.choice(alphabet) for _ in range(101)) + text)
    assert "".join(one) == text and max(map(len, one)) <= 4200
    assert len(set(one) & set(two)) > 0.8 * len(one) and len(one) > 40


@pytest.mark.parametrize("clashes", [False, True])
def test_exact_dedup(spark, clashes):
    rng = random.Random(1)
    long_ = [" ".join(rng.choice(["kid", "dog", "big", "bad", "cab", "zip"]) for _ in range(900)) for _ in range(3)]
    rows = EDGE + [(100 + i, long_[i % 3] + (" end" if i % 4 else ""), "x") for i in range(24)]
    # a two-valued identifier makes almost all chunks clash
    weak = {"chunk_id": lambda c: F.pmod(F.xxhash64(c), F.lit(2))} if clashes else {}
    got = exact_dedup(frame(spark, rows), **weak)
    assert by_str(tuple(r) for r in got.select(COLUMNS).collect()) == exact_brute(rows)
    assert got.agg(F.max("n_chunks")).first()[0] > 3


def test_exact_dedup_keeps_rows(spark):
    df = frame(spark, EDGE)
    kept = kept_documents(df)
    assert kept.columns == df.columns
    got = by_str((r.doc_id, r.text) for r in kept.collect())
    assert got == by_str([(1, "a  b\tc"), (3, None), (5, " "), (6, "a b c "), (7, "lone"), (7, "other"), (8, "é" * 9000)])


def line_brute(rows, min_words):
    first = {}
    parts = {}
    for d, t in rows:
        parts[d] = (t or "").split("\n")
        for i, u in enumerate(parts[d]):
            n = re.sub(WS, " ", u.lower()).strip()
            if n and len(n.split(" ")) >= min_words:
                first[n] = min(first.get(n, (d, i)), (d, i))
    out = []
    for d, us in parts.items():
        gone = [i for i, u in enumerate(us) if (n := re.sub(WS, " ", u.lower()).strip()) in first and first[n] != (d, i)]
        out.append((d, len(us), len(gone), "\n".join(u for i, u in enumerate(us) if i not in gone)))
    return by_str(out)


def test_substring_dedup(spark):
    a, b = "one two three four five", "SIX  seven\teight nine ten eleven"
    rows = [(3, f"{a}\n{b}\nshort one"), (1, f"x\n{b.lower()}"), (2, None), (4, ""), (5, f"{a}\n{a}\n\n{a} "), (6, "short one"), (9, (a + "\n") * 3000),
            (10, "没有空格的一行文字\n \t\n"), (11, "\n没有空格的一行文字\nhttps://example.org/" + "x" * 300), (12, "HTTPS://example.org/" + "x" * 300)]
    df = frame(spark, [(d, t, "x") for d, t in rows])
    spared = substring_dedup(df, min_words=5).collect()
    assert by_str((r.doc_id, r.n_units, r.n_removed, r.kept_text) for r in spared) == line_brute(rows, 5)
    got = substring_dedup(df).collect()
    assert by_str((r.doc_id, r.n_units, r.n_removed, r.kept_text) for r in got) == line_brute(rows, 1)
    assert {r.doc_id: r.n_removed for r in got if r.doc_id in (6, 11, 12)} == {6: 1, 11: 1, 12: 1}
    for r in got:  # offsets are those of the original text
        text = dict(rows)[r.doc_id] or ""
        spans = [tuple(map(int, s.split(":"))) for s in r.kept_spans.split(",") if s]
        assert "\n".join(text[s:e] for s, e in spans) == r.kept_text
        gone = [tuple(map(int, s.split(":"))) for s in r.removed_spans.split(",") if s]
        assert sum(e - s for s, e in gone) == r.removed_chars and len(gone) == r.n_removed


def test_substring_dedup_paragraphs_nulls_and_repeats(spark):
    p = "a paragraph of more than five words\nin two lines"
    rows = [(None, p, "x"), (2, f"{p}\n\n{p}", "x"), (2, f"{p}\n\n{p}", "x")]
    got = by_str((r.doc_id, r.n_removed, r.kept_text) for r in substring_dedup(frame(spark, rows), unit="paragraph").collect())
    assert got == by_str([(None, 1, ""), (2, 1, p), (2, 1, p)])


def suffix_brute(rows, window):
    count = collections.Counter()
    for _, t in rows:
        raw = (t or "").encode()
        count.update(raw[i:i + window] for i in range(len(raw) - window + 1))
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        mark = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            if count[raw[i:i + window]] > 1:
                mark[i:i + window] = b"\1" * window
        runs = sum(1 for i in range(len(mark)) if mark[i] and not (i and mark[i - 1]))
        out.append((d, len(raw), sum(mark), runs, hashlib.sha256(bytes(x for x, m in zip(raw, mark) if not m)).hexdigest()))
    return by_str(out)


@pytest.fixture(scope="module")
def suffix_rows():
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    p = text(60)
    rows = [(i, text(rng.randint(0, 40)) + p[rng.randint(0, 20):rng.randint(30, 60)] + text(rng.randint(0, 40))) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, "a" * 300), (103, "ab" * 100), (None, p), (104, p), (104, p), (105, "x\0\0\0" + p + "\0\0"),
                   (106, p[:40] + "\0"), (107, p[:40]), (108, "é" * 50)]


@pytest.mark.parametrize("window,gram,hot,often", [(20, 4, 10**6, 10**6), (20, 4, 10**6, 3), (16, 8, 10**6, 2), (24, 5, 3, 2)])
def test_suffix_dedup(spark, suffix_rows, window, gram, hot, often):
    df = frame(spark, [(d, t, "x") for d, t in suffix_rows])
    got = suffix_dedup(df, window, gram, hot, often).collect()
    assert by_str(tuple(r)[:5] for r in got) == suffix_brute(suffix_rows, window)


def test_merge_and_front_coding():
    rng = random.Random(5)
    strings = sorted("".join(rng.choice("ab") for _ in range(12)).encode() for _ in range(500))
    rows = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, 12)
    runs = [rows[i::7] for i in range(7)] + [rows[:0]]
    coded = [_front_coded(r) for r in runs]
    for r, (shared, rest) in zip(runs, coded, strict=True):
        assert (_restored(shared, rest, 12) == r).all() and len(rest) == 12 * len(r) - shared.sum()
    order, known = merge_runs([(r, c[0]) for r, c in zip(runs, coded, strict=True)], 12)
    assert (np.concatenate(runs)[order] == rows).all()
    shared = [0] + [next((i for i in range(12) if a[i] != b[i]), 12) for a, b in zip(strings, strings[1:])]
    assert known.tolist() == shared


def near_brute(rows, size, percent):
    sets = []
    for _, t in rows:
        words = [w for w in re.split(WS, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w]
        sets.append({tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()})
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                group = [group[j] if g == group[i] else g for g in group]
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[group[i]] = min(d, ids.get(group[i], d))
    return by_str((d, len(sets[i]), ids.get(group[i])) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("size,percent,node", [(3, 85, 128), (5, 80, 4)])
def test_near_dedup(spark, size, percent, node):
    """A small node size sends the large group through all levels, blocks and rounds."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(120)] for _ in range(4)]
    rows = []
    for i in range(90):
        w = list(base[0] if i < 60 else base[1 + i % 3])
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((1000 - i, " ".join(w).upper() if i % 5 == 0 else "\t ".join(w)))
    rows += [(1, None), (2, ""), (3, " \n"), (4, "Two words"), (5, "two  WORDS"), (6, "two"), (None, "two words"), (None, "alone here"), (4, "Two words")]
    got = near_dedup(frame(spark, [(d, t, "x") for d, t in rows]), size, percent, node_size=node).collect()
    assert by_str((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_brute(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_roots_of_all_trees_take_different_coordinates(spark):
    """One pair for each coordinate that agrees in no other: as many meet as coordinates are taken."""
    rows = [((2 * c + side).to_bytes(16, "big"), [-1 if at == c else 2 * c + side for at in range(SKETCH)]) for c in range(SKETCH) for side in (0, 1)]
    met = leaf_nodes(spark.createDataFrame(rows, "item binary, sketch array<int>"), depth=1)
    assert met.select("item").distinct().count() == 2 * TREES * BRANCH


def test_components_of_a_long_path(spark):
    item = lambda i: i.to_bytes(16, "big")
    links = [(item(i), item(i + 1)) for i in range(60) if i != 30] + [(item(i), item(100)) for i in range(101, 140)]
    got = {bytes(r.item): bytes(r.label) for r in components(spark.createDataFrame(links, "a binary, b binary")).collect()}
    assert got == ({item(i): item(0) for i in range(31)} | {item(i): item(31) for i in range(31, 61)} | {item(i): item(100) for i in range(100, 140)})


@pytest.mark.parametrize("operator", [exact_dedup, substring_dedup, suffix_dedup, near_dedup, kept_documents])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).count() == 0

"""Spelling variants, chat formatting and phrase collocations against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contrail.llm.chat import PART, Template, digests, escape, format_chat, read_turns, text_parts, unescape
from contrail.llm.collocations import DoubleArrayTrie, _tokens, _word_ids, collocations, phrase_counts
from contrail.llm.spelling import INSERTED, REPLACED, dropped, near_pairs, signatures, spelling_variants

# Names that the operators use inside.
CLASH = "doc_id long, text string, lang string, word string, n long, key long, pid long, ids string, a int, conv int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "w", 1, 2, 3, "i", 4, 5) for r in rows], CLASH)


# ---- spelling variants ----

def edit_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling_brute(rows, min_length=6, min_count=5, ratio=5):
    count = collections.Counter()
    for doc_id, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= min_length and n >= min_count}
    form, near = {}, {w: [v for v in words if edit_one(w, v)] for w in words}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def test_spelling_variants(spark):
    rng = random.Random(2)
    rows = []
    stems = ["monthly", "baaaaaad", "éclairer", "ÉCLAIRER", "straße", "aaaaaa", "abcdef", "Ärgerlich", "institution"]
    for i in range(400):
        words = []
        for _ in range(40):
            w = rng.choice(stems)
            if rng.random() < 0.15:  # two edits now and then: chains of forms
                for _ in range(rng.choice([1, 1, 2])):
                    at = rng.randrange(len(w))
                    w = w[:at] + rng.choice(["", rng.choice("abmn"), w[at] + rng.choice("abmn")]) + w[at + 1:]
            words.append(w)
        rows.append((i, rng.choice([" ", "-", "1 "]).join(words)))
    rows += [(None, "monthly " * 30), (401, None), (402, ""), (3, rows[3][1]), (403, "x" * 50_000 + " " + "abcdef " * 20_000), (404, "æ÷×ø " * 9)]
    rows += [(405, "wander " * 200 + "wanderr " * 30 + "wanderrs " * 6 + "solitary " * 7)]  # a chain of forms
    got = spelling_variants(frame(spark, [(d, t, "en") for d, t in rows]))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = spelling_brute(rows)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert any(r[1] != r[2] for r in want if r[1]) and any(r[4] == 0 for r in want)
    assert spelling_variants(frame(spark, [])).count() == 0


def test_every_kind_of_run_loses_a_letter():
    lost = [(d, dropped(d, "monthly")) for d in range(2000) if dropped(d, "monthly") != "monthly"]
    assert 2 <= len(lost) <= 30 and all(len(w) == 6 for _, w in lost) and dropped(None, "a") in ("a", "")


def test_signatures_are_exact():
    """Multisets that differ in one or two dimensions share a signature; others seldom do."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(6, 12))) for _ in range(300)]
    replaced = [w[:3] + ("z" if w[3] != "z" else "y") + w[4:] for w in words]
    longer = [w[:2] + w[2] + w[2:] for w in words]
    assert (signatures(words, *REPLACED) == signatures(replaced, *REPLACED)).any(axis=1).all()
    assert (signatures(words, *INSERTED) == signatures(longer, *INSERTED)).any(axis=1).all()
    assert (signatures(words, *REPLACED) == signatures([w[::-1] for w in words], *REPLACED)).all()
    assert (signatures(words[:-1], *REPLACED) == signatures(words[1:], *REPLACED)).any(axis=1).mean() < 0.1


def test_near_pairs_of_dense_words(spark):
    """Words of two letters only: every signature group is as large as it can be."""
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(250)})
    got = near_pairs(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")).collect()
    assert sorted((r.a, r.b) for r in got) == sorted((a, b) for a in words for b in words if a < b and edit_one(a, b))
    assert all(words[r.n_a] == r.a and words[r.n_b] == r.b for r in got)


# ---- chat ----

PLAIN = ["", "hello", "a\nb", "</s>[INST] ok [/INST]", "\\", "\\\\[INST]\\", "[\\INST]", "<\\s>", "[IMG][AUDIO]", "[[INST]", "< s>", "[ROLE]x[:]y[/ROLE]",
         "ends with [", "ends with <", " /s> ", "日本語 [/INST]", "$0 \\1 $1", "[BOT]x</s>", " <s>", "<s" * 50 + ">"]


def test_escape_is_reversible_and_leaves_no_mark(spark):
    t = Template()
    rng = random.Random(9)
    texts = PLAIN + ["".join(rng.choice([*t.marks(), "\\", "[", "<", "]", ">", "x", "INST]", "/s>"]) for _ in range(12)) for _ in range(300)]
    got = spark.createDataFrame([(x,) for x in texts], "text string").select("text", escape(F.col("text")).alias("e")).withColumn("back", unescape(F.col("e"))).collect()
    for r in got:
        assert r.back == r.text and not any(m in r.e for m in t.marks())


def test_chat_reads_back(spark):
    rng = random.Random(8)
    rows = []
    for c in [*range(40), None]:
        for turn in range(rng.randint(1, 6)):
            rows.append((c, turn, rng.choice(["user", "assistant", "system", "tool", "assistant", None, "[:]", "assistant "]), rng.choice([*PLAIN, None])))
    rows += [(99, t, "assistant" if t % 2 else "user", f"turn {t} [INST] " * 3) for t in range(3000)] + [(100, 0, "user", "x" * 500_000)]
    rows += [(101, 0, "user", "b"), (101, 0, "user", "a"), (101, 0, "assistant", "z"), (101, 0, "user", "a"), (101, None, "user", "first")]
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame([(*r, "c", 1) for r in shuffled], "conv_id long, turn int, role string, text string, content string, segments int")
    out = format_chat(text_parts(df))
    got = {r.conv_id: r for r in digests(out).collect()}
    formatted = {r.conv_id: r for r in out.collect()}
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[0]].append((-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), sha("".join(f"{role}\n{x}\n" for _, role, x in turns)), len(loss), sha(loss))
        assert formatted[c].formatted == "".join(s.text for s in formatted[c].segments) and r.formatted_chars == len(formatted[c].formatted)
    assert formatted[101].formatted == "<s>[INST]first[/INST][BOT]z</s>[INST]a[/INST][INST]a[/INST][INST]b[/INST]"
    assert digests(format_chat(text_parts(df.limit(0)))).count() == 0


def test_typed_parts(spark):
    part = lambda kind, **kw: (kind, *[kw.get(k) for k in ("text", "ref", "width", "height", "seconds", "pages")])
    rows = [(1, 0, "user", [part("text", text="see [IMG] "), part("image", ref="a.png", width=57, height=28), None, part("audio", ref="b.wav", seconds=2.0)]),
            (1, 1, "assistant", [part("text", text="one"), part("image", ref="c.png"), part("text", text="two")]),
            (1, 2, "user", [part("document", ref="d.pdf", pages=3), part("video", ref="e"), part(None)]), (2, 0, "user", None), (2, 1, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{PART}>")
    out = {r.conv_id: r for r in format_chat(df).collect()}
    assert out[1].formatted == "<s>[INST]see [\\IMG] [IMG][AUDIO][/INST][BOT]one[IMG]two</s>[INST][DOC][PART][PART][/INST]"
    assert [tuple(a) for a in out[1].attachments] == [("image", "a.png", 3), ("audio", "b.wav", 25), ("image", "c.png", 256),
                                                      ("document", "d.pdf", 2304), ("video", "e", 1), ("", None, 1)]
    assert out[1].expanded_tokens == 3 + 25 + 256 + 2304 + 2
    assert [s.text for s in out[1].segments if s.loss] == ["one", "two"]
    assert out[2].formatted == "<s>[INST][/INST][INST][/INST]" and out[2].expanded_tokens == 0
    read = format_chat(df).where("conv_id = 1").select(read_turns(F.col("formatted")).alias("t")).first().t
    assert [tuple(x) for x in read] == [("user", "see [IMG] "), ("assistant", "onetwo"), ("user", "")]


def test_chat_plan_has_no_python(spark):
    from contrail.llm.registry import op12_chat_format
    plan = op12_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_template_refuses_marks_that_could_join():
    with pytest.raises(ValueError):
        Template(begin="<s<")
    with pytest.raises(ValueError):
        Template(unknown="\\x")


# ---- collocations ----

def collocation_brute(rows, max_words=5, min_count=100, top=2000):
    out = []
    for lang in {lg or "und" if lg is None else lg for _, _, lg in rows}:
        f, n = collections.Counter(), 0
        for _, text, lg in rows:
            if ("und" if lg is None else lg) != lang:
                continue
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
                words = re.findall(r"[^\x20\x09]+", piece)
                n += len(words)
                for k in range(1, max_words + 1):
                    f.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        rest = []
        for p, a in cand.items():
            if any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rest.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rest)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def colloc_rows():
    rng = random.Random(12)
    words = ["the", "New", "york", "city", "of", "a", "x-ray", "naïve", "É", "日本", "to", "be", " ", "d'or"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\r\n"]) for _ in range(rng.randint(0, 60)))
        if i % 2:
            text += "new York city of The " * rng.randint(1, 6) + " a a a a a a a"
        rows.append((i, text, rng.choice(["en", "en", "fr", None, "und", ""])))
    return rows + [(None, None, "en"), (200, "", "de"), (201, " \t.,", "de"), (202, "to be " * 20_000, "en"), (5, rows[5][1], "en"), (203, "one two", "zz")]


@pytest.mark.parametrize("shard", [400_000, 40])
def test_collocations(spark, colloc_rows, shard):
    got = collocations(frame(spark, colloc_rows), min_count=12, shard=shard)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = collocation_brute(colloc_rows, min_count=12)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 60
    few = collocations(frame(spark, colloc_rows), max_words=3, min_count=12, top=3)
    assert sorted(tuple(r) for r in few.collect()) == collocation_brute(colloc_rows, 3, 12, 3)


def test_collocations_empty(spark):
    assert collocations(frame(spark, [])).count() == 0
    assert collocations(frame(spark, [(1, None, None), (2, "a b", "en")])).count() == 0


def test_colliding_word_ids_are_dealt_anew(spark, monkeypatch):
    """Ids of seed 0 collide; those of seed 1 are taken."""
    import contrail.llm.collocations as module
    real = module._word_ids
    monkeypatch.setattr(module, "_word_ids", lambda lang, words, seed: real(lang, words, seed) % (3 if seed == 0 else 1 << 62))
    rows = [(i, "new york city", "en") for i in range(30)]
    _, phrases, _ = phrase_counts(frame(spark, rows), min_count=10)
    assert sorted((r.phrase, r.a) for r in phrases.collect()) == [("new york", 30), ("new york city", 30), ("york city", 30)]


def test_tokens_and_ids():
    texts = ["A b\tc.d", "", "e", None, "É  f,g \u00a0x", "..", "a", "日本 語\x0bend "]
    words, codes = _tokens(pa.array([t or "" for t in texts]).slice(0))
    spelled = words.to_pylist()
    assert [None if c < 0 else spelled[c] for c in codes] == ["a", "b", "c", None, "d", None, "e", None, "É", "f", None, "g", "\u00a0x", None, "a", None, "日本", "語", None, "end"]
    assert _tokens(pa.array(["x y", "", " ."]).slice(1))[1].tolist() == []
    many = pa.array([f"w{i}" for i in range(20_000)] + ["x" * n for n in range(1, 500)])
    ids = _word_ids("en", many, 0)
    assert len(set(ids.tolist())) == len(many) and not set(ids.tolist()) & set(_word_ids("fr", many, 0).tolist())
    assert (_word_ids("en", many.slice(7, 90), 0) == ids[7:97]).all() and (_word_ids("en", many, 1) != ids).all()


def test_trie_of_wide_nodes():
    """Many parents with many children: the arrays grow as they fill."""
    rng = np.random.default_rng(3)
    phrases = np.unique(rng.integers(0, 300, (40_000, 2)), axis=0)
    t = DoubleArrayTrie.build([phrases], [np.arange(len(phrases))])
    codes = np.append(phrases, np.full((len(phrases), 1), -1), axis=1).ravel().astype(np.int32)
    *_, (at, state) = t.walk(t.local(np.arange(300), codes))
    assert (t.phrase[state] == np.arange(len(phrases))).all() and (at == np.arange(len(phrases)) * 3).all()


def test_double_array_trie():
    rng = np.random.default_rng(1)
    phrases = [np.unique(rng.integers(0, 40, (300, k)) * 7 - 90, axis=0) for k in (1, 2, 3, 5)]
    rows, at = [], 0
    for p in phrases:
        rows.append(np.arange(at, at + len(p)))
        at += len(p)
    t = DoubleArrayTrie.build(phrases, rows)
    assert len(t.base) < 12 * sum(p.size for p in phrases)
    ids = np.arange(-100, 200)
    codes = rng.integers(-1, len(ids), 40_000).astype(np.int32)
    counts = np.zeros(at, dtype=np.int64)
    for _, state in t.walk(t.local(ids, codes)):
        found = t.phrase[state]
        np.add.at(counts, found[found >= 0], 1)
    want = collections.Counter()
    spelled = [None if c < 0 else int(ids[c]) for c in codes]
    for k in (1, 2, 3, 5):
        want.update(tuple(spelled[i:i + k]) for i in range(len(spelled) - k + 1))
    for p, r in zip(phrases, rows, strict=True):
        assert [int(counts[j]) for j in r] == [want[tuple(map(int, x))] for x in p]

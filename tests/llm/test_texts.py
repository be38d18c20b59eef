"""Operators on document texts against brute force, with the edge cases their docstrings define."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from signalspark.llm import decontaminate, lines, near, packing, sharding, substrings
from signalspark.llm.common import ship
from signalspark.llm.queries import vocabulary
from signalspark.llm.tokens import Encoder

SCHEMA = "doc_id long, text string, shard string, row string, removed int, score string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def frame(spark, rows):
    """Documents with extra columns whose names clash with working and result columns."""
    return spark.createDataFrame([(k, t, "s", None, 1, None) for k, t in rows], SCHEMA)


def prose(rng, n, words=400):
    return " ".join(f"w{int(words * rng.random() ** 2)}" for _ in range(n))


def corpus(seed):
    """Texts with shared passages, copies, near copies, long runs, nulls, empties, repeated rows and one long text."""
    rng = random.Random(seed)
    passage, rows = prose(rng, 60, 5000), []
    for i in range(40):
        t = prose(rng, rng.randint(0, 90), 3000)
        if i % 4 == 0:
            t += "\n" + passage
        if i % 9 == 0 and rows:
            t = rows[rng.randrange(len(rows))][1]
        rows.append((i, t))
    rows += [(50, None), (51, ""), (52, " \n\t "), (53, "a " * 90), (54, "b " + "a " * 45), (55, "　é ñ"),
             (None, passage), (None, passage), (60, passage), (60, passage), (61, prose(rng, 9000, 9000))]
    return rows


def brute_substrings(rows, n=20):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1] is not None, rows[i][1] or ""))
    seen, out = set(), {}
    for i in order:
        words = (rows[i][1] or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - n + 1):
            w = tuple(words[p:p + n])
            if w in seen:
                gone[p:p + n] = [True] * n
            seen.add(w)
        out.setdefault(rows[i][0], []).append(
            (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_substrings(spark, block):
    rows = [r for r in corpus(1) if r[0] is not None]
    got = defaultdict(list)
    for r in substrings.remove_repeats(frame(spark, rows), block_bytes=block).collect():
        got[r.doc_id].append((r.n_words, r.n_removed, r.kept))
        assert sum(s["end"] - s["start"] for s in r.removed) == r.n_removed
    want = brute_substrings(rows)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_substrings_null_ids_and_empty_table(spark):
    rows = [(None, "x y z " * 20), (None, "x y z " * 20), (1, None)]
    got = sorted((r.n_words, r.n_removed) for r in substrings.remove_repeats(frame(spark, rows)).collect())
    assert got == [(0, 0), (60, 57), (60, 60)]  # one of the equal rows is the first
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def test_every_window_has_an_interior_anchor():
    """Wherever a 20-word window stands, a boundary at one of its first eight places is its own."""
    rng = np.random.default_rng(5)
    for _ in range(60):
        window = rng.integers(1, 2**63, substrings.WINDOW, dtype=np.uint64)
        common = None
        for _ in range(12):
            around = [rng.choice(np.append(window, rng.integers(1, 2**63, 5, dtype=np.uint64)), 30) for _ in range(2)]
            names = np.concatenate([around[0], window, around[1]])
            first = np.zeros(len(names), bool)
            first[0] = True
            at = set((substrings.boundaries(names, first) - 30).tolist()) & set(range(substrings.REACH + 1))
            common = at if common is None else common & at
        assert common


def brute_hits(rows, items, n=10):
    def words(t):
        out, word = [], ""
        for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "") + " ":
            if c.isascii() and not (c.isdigit() or "a" <= c <= "z"):
                if word:
                    out.append(word)
                word = ""
            else:
                word += c
        return out

    windows = defaultdict(set)
    for item, t in items:
        w = words(t)
        k = min(n, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[p:p + k])].add("" if item is None else str(item))
    out = []
    for key, t in rows:
        w, hit, found = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if tuple(w[p:p + k]) in windows:
                    hit |= set(range(p, p + k))
                    found |= windows[tuple(w[p:p + k])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("short_limit", [decontaminate.SHORT_ITEMS, 0])
def test_decontamination(spark, monkeypatch, short_limit):
    monkeypatch.setattr(decontaminate, "SHORT_ITEMS", short_limit)
    rows = corpus(2)
    texts = [t for _, t in rows if t and len(t) > 200]
    items = [(i, " ".join(t.split()[3:3 + 12 + i])) for i, t in enumerate(texts[:8])]
    items += [(90, "W1-W2"), (91, "é"), (92, None), (93, "!?"), (94, items[0][1]), (None, "a a a"), (95, "A " * 30),
              (8, items[1][1].upper() + ", and more words here than a window has, plainly")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(3))
    got = Counter(tuple(r) for r in decontaminate.contamination(frame(spark, rows), bench).select(
        *decontaminate.REPORT).collect())
    assert got == brute_hits(rows, items)
    clean = Counter(r.doc_id for r in decontaminate.clean(frame(spark, rows), bench).collect())
    assert clean == sum((Counter({k: n}) for (k, *_, bad), n in got.items() if not bad), Counter())


def test_decontamination_empty_tables(spark):
    docs, none = frame(spark, [(1, "a b c"), (2, None)]), spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(docs, none).collect()] == [0, 0]
    assert decontaminate.contamination(frame(spark, []), none).count() == 0


def brute_lines(rows, t=0.8):
    first, at = {}, []
    for k, text in rows:
        for j, line in enumerate((text or "").split("\n") if text is not None else []):
            words = frozenset(line.translate(str.maketrans("\t\x0b\x0c\r", "    ")).split(" ")) - {""}
            if words:
                place = (-(1 << 63) if k is None else k, j)
                first[line] = min(first.get(line, place), place)
                at.append((place, line, words))
    sets = {line: w for _, line, w in at}
    gone = defaultdict(set)
    for place, line, w in at:
        similar = any(first[o] < first[line] and len(w & v) >= t * len(w | v) - 1e-9 for o, v in sets.items() if o != line)
        if place != first[line] or similar:
            gone[place[0]].add(place[1])
    return gone


def test_lines(spark):
    rng = random.Random(7)
    base = [prose(rng, rng.randint(1, 30), 60) for _ in range(30)]
    rows = []
    for i in range(60):
        some = []
        for _ in range(rng.randint(0, 6)):
            words = rng.choice(base).split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
            some.append("  ".join(words) + rng.choice(["", "\r", "\t"]))
        rows.append((i * 3, "\n".join(some)))
    rows += [(500, None), (501, ""), (502, "\n\n \n"), (503, " ".join(f"u{i}" for i in range(3000))),
             (504, " ".join(f"u{i}" for i in range(2900))), (None, base[0])]
    want = brute_lines(rows)
    got = lines.report(frame(spark, rows).drop("removed")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert set(r.removed) == want[-(1 << 63) if r.doc_id is None else r.doc_id], r
    kept = {r.doc_id: r for r in lines.deduplicate_lines(frame(spark, rows)).collect()}
    for k, text in rows:
        out = want[-(1 << 63) if k is None else k]
        assert kept[k].text == (None if text is None else "\n".join(
            x for j, x in enumerate(text.split("\n")) if j not in out))
        assert kept[k].shard == "s"
    assert lines.report(frame(spark, [])).count() == 0


@pytest.mark.parametrize("narrow", [True, False])
def test_lines_of_many_words_share_one_shuffle(spark, monkeypatch, narrow):
    """Near copies around the length where parities fold, with places as longs and as decimals; one shuffle of entries."""
    rng = random.Random(29)
    base = [[f"l{i}w{c}" for c in range(rng.randint(36, 62))] for i in range(12)]
    rows = []
    for i in range(50):
        some = []
        for _ in range(3):
            words = list(rng.choice(base))
            for _ in range(rng.randint(0, 9)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(999)}"
            some.append(" ".join(words[:len(words) - rng.randint(0, 4)]))
        rows.append((7 * i - 100, "\n".join(some)))
    if not narrow:
        monkeypatch.setattr(lines, "_within", lambda *_: None)
    plans, write = [], lines.checkpoint_table

    def spy(df, name):
        if name == "line-pairs" and not plans:
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(lines, "checkpoint_table", spy)
    want = brute_lines(rows)
    for r in lines.report(frame(spark, rows).drop("removed")).collect():
        assert set(r.removed) == want[r.doc_id], r
    assert "ReusedExchange" in plans[0]


def line_plans(spark, monkeypatch):
    """The physical plans of a line dedup, by the name of what they write."""
    rng = random.Random(31)
    base = [prose(rng, 20, 60) for _ in range(8)]
    rows = [(i, "\n".join(rng.choice(base) + rng.choice(["", " more", " words"]) for _ in range(3))) for i in range(20)]
    plans, write = {}, lines.checkpoint_table
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def spy(df, name):
        plans[name] = plan(df)
        return write(df, name)

    monkeypatch.setattr(lines, "checkpoint_table", spy)
    plans["report"] = plan(lines.report(frame(spark, rows).drop("removed")))
    return plans


def test_line_plans_hold_no_bitmaps(spark, monkeypatch):
    """The driver prints and keeps every plan; the bitmaps of lines that met are no part of them."""
    plans = line_plans(spark, monkeypatch)
    assert "similar-lines" in plans
    assert all(len(p) < 100_000 for name, p in plans.items() if name != "distinct-lines"), {n: len(p) for n, p in plans.items()}


def test_rarity_counts_every_word_of_every_document(spark):
    docs = [(i, f"all w{i % 7}\n\nrare{i} all\tw{i % 7} ") for i in range(5000)] + [(5000, None), (5001, "")]
    counts = Counter(w for _, t in docs for w in (t or "").split())
    cells = spark.createDataFrame(list(counts.items()), "w string, n long").select(
        F.xxhash64("w").bitwiseAND(F.lit(lines.CELLS - 1)).alias("cell"), "n").groupBy("cell").agg(F.sum("n").alias("n"))
    want = [0] * lines.CELLS  # the class and one; no word, no class
    for r in cells.collect():
        want[r.cell] = round(8 * math.log2(r.n)) + 1
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert spark.range(1).select(lines.rarity_classes(df)).first()[0] == want


def test_lines_group_without_a_sort_and_are_read_once(spark, monkeypatch):
    plans = line_plans(spark, monkeypatch)
    assert "SortAggregate" not in plans["distinct-lines"]
    assert "Generate posexplode" not in plans["similar-lines"] and "Generate posexplode" in plans["paired-lines"]


def test_alignment_in_the_band():
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(11)
    for _ in range(4000):
        a = [rng.randint(0, 4) for _ in range(rng.randint(0, 14))]
        b = [rng.randint(0, 4) for _ in range(rng.randint(0, 14))] if rng.random() < 0.5 else [
            x if rng.random() < 0.8 else 9 for x in a if rng.random() < 0.9]
        most = rng.randint(0, 8)
        assert near.edits_within(a, b, most) == (edits(a, b) <= most)


def test_near_duplicates(spark):
    rng = random.Random(13)
    rows, hot = [], prose(rng, 120, 4000).split()
    for i in range(30):
        rows.append((len(rows), prose(rng, rng.randint(1, 150), 4000)))
    for i in range(60):  # one large group of near copies, sharing most words
        words = list(hot)
        for _ in range(4):
            words[rng.randrange(len(words))] = f"z{rng.randrange(999)}"
        rows.append((len(rows), " ".join(words)))
    for i in range(0, 20, 2):
        rows.append((len(rows), rows[i][1].upper() + " !"))
    rows += [(300, None), (301, ""), (302, "?!"), (None, rows[3][1]), (303, rows[5][1]), (303, rows[5][1])]
    words = [near._words((t or "").encode()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if words[x] == words[y] or near.near(words[x], words[y]):
                parent[find(x)] = find(y)
    df = frame(spark, rows)
    placed = {(r.place, r.class_id) for r in near.classes(df).collect()}
    by_place = dict(placed)
    assert len(by_place) == len(placed)
    nulls = {r.p for r in df.filter("doc_id is null").select(near.place("doc_id", "text").alias("p")).collect()}
    place = [k if k is not None else next(iter(nulls)) for k, _ in rows]
    groups = defaultdict(set)
    for i in range(len(rows)):
        groups[find(i)].add(place[i])
    for members in groups.values():
        assert {by_place[p] for p in members} == {min(members)}
    kept = near.deduplicate(df).collect()
    assert len(kept) == len(groups) and kept[0].shard == "s"
    assert near.classes(frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", [5, 10, 20, 31, 32, 40, 64, 300, 1000])
@pytest.mark.parametrize("spread", ["random", "even"])
def test_near_pairs_at_the_threshold_meet(n, spread):
    """Pairs at edit similarity 0.8 by scattered substitutions share a bucket in at least 98 of 100 cases."""
    rng, pairs, rows = random.Random(31), 250, []
    for i in range(pairs):
        a = [f"p{i}w{c}" for c in range(n)]
        b = list(a)
        for c in rng.sample(range(n), n // 5) if spread == "random" else range(2, 5 * (n // 5), 5):
            b[c] = f"x{c}"
        rows += [" ".join(a), " ".join(b)]
    batch = pa.RecordBatch.from_pydict({"place": list(range(len(rows))), "text": rows})
    keys = [set(k) for out in near._sketches(iter([batch])) for k in out.column("keys").to_pylist()]
    met = sum(bool(keys[i] & keys[i + 1]) for i in range(0, len(keys), 2))
    print(n, spread, met / pairs)
    assert met >= 0.98 * pairs


def test_near_duplicates_around_one_text(spark):
    """Members at 0.87 to a centre and less than 0.8 to most others: links run through the centre, of a middle id."""
    rng = random.Random(23)
    centre, rows = prose(rng, 300, 4000).split(), []
    for i in range(200):
        words = list(centre)
        for slot in rng.sample(range(23), 3):  # three runs of 13 words
            words[13 * slot:13 * slot + 13] = [f"m{i}x{slot}x{c}" for c in range(13)]
        rows.append((i if i < 100 else i + 1, " ".join(words)))
    rows.append((100, " ".join(centre)))
    assert {r.class_id for r in near.classes(frame(spark, rows)).collect()} == {0}


def test_bound_leaves_near_pairs_open():
    """Word parities, in few or many cells, never rule out a near pair, and rule out long texts that differ by a third."""
    rng, ruled_out = random.Random(29), 0
    for trial in range(300):
        n = rng.choice([40, 120, 130, 500, 1000])
        a = [f"w{rng.randrange(n // 2)}" for _ in range(n)]
        rate = rng.choice([0.1, 0.19, 0.34])
        b = [x for x in ([f"x{rng.randrange(n)}"] if rng.random() < rate else [w] for w in a) for x in x if rng.random() > 0.02]
        texts = [near._words(" ".join(t).encode()) for t in (a, b)]
        bits = [near.word_parities(np.array(t, np.uint64)) for t in texts]
        found = near.open_pairs(7, False, np.array([1, 2]), np.array([1, 2]), np.array([0, 0]), np.array([len(t) for t in texts]),
                                np.stack([near.folded(b) for b in bits]).view(np.uint64), [b.tobytes() for b in bits],
                                [np.array([5, 7, 8]), np.array([6, 7, 8])], near.THRESHOLD)
        if near.near(*texts):
            assert found == [(2, 1)]
        ruled_out += n == 1000 and rate == 0.34 and not found
    assert ruled_out >= 10


@pytest.mark.parametrize("block", [near.BLOCK, 7])
def test_pairs_of_long_texts_are_aligned_only_if_almost_near(spark, monkeypatch, block):
    """Long texts that share most of their words, in one bucket, without being near; and a few that are."""
    rng, rows, aligned = random.Random(37), [], []
    centre = prose(rng, 800, 4000).split()
    for i in range(60):
        words = list(centre)
        words[:160] = [f"m{i}x{c}" for c in range(160)]  # 0.8 to the centre's rest and 0.7 to each other
        words[700:780] = [f"n{i // 2}x{c}" for c in range(80)]
        rows.append((i, " ".join(words)))
    for i in range(0, 60, 6):  # linked to one of them only
        words = rows[i][1].split()
        words[300:440] = [f"q{i}x{c}" for c in range(140)]
        rows.append((len(rows), " ".join(words)))
    judge = near._verified

    def seen(pairs, texts, threshold):
        aligned.append(pairs.count())
        return judge(pairs, texts, threshold)

    monkeypatch.setattr(near, "_verified", seen)
    monkeypatch.setattr(near, "BLOCK", block)
    words = [near._words(t.encode()) for _, t in rows]
    label = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            if near.near(words[x], words[y]) and label[x] != label[y]:
                low, high = sorted((label[x], label[y]))
                label = [low if v == high else v for v in label]
    placed = {r.place: r.class_id for r in near.classes(frame(spark, rows)).collect()}
    assert placed == dict(enumerate(label))
    assert len(set(label)) > 20
    assert aligned[-1] <= len(rows)  # the last step's; the earlier ones make a few pairs a text and table


def test_encoder_equals_the_library():
    rng = random.Random(17)
    parts = ["a", "B", "é", "ñ", " ", "  ", "\n", "\t", "\r\n", " ", "　", " ", "1", "23", "'s", "'", "!",
             "…", "<|endoftext|>", "<|startoftext|>", "é", "́", "Σ", "İ", "\x1c", "\x85", "漢字", "_", ".\n",
             "x\ny", "A\n B", "😀", "\x00", "word,", "don't", "ÀÉ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        lib = Encoder(vocabulary(name))
        for i in range(0, len(texts), 500):
            some = texts[i:i + 500]
            assert lib.encode_all([t.encode() for t in some]) == [lib.direct(t) for t in some]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_full_memos_keep_what_is_met_again(monkeypatch, name):
    """Runs of letters outlive a full memo; new ones are encoded together with the library's ids."""
    from signalspark.llm import tokens

    monkeypatch.setattr(tokens, "MEMO", 3)
    monkeypatch.setattr(tokens, "LETTERS", 3)
    lib, asked = Encoder(vocabulary(name)), []
    encode = lib._encode_letters
    monkeypatch.setattr(lib, "_encode_letters", lambda runs: (asked.extend(runs), encode(runs)))
    first, second = "a haanth reoush hewh onahe Äöü", "b haanth, reoush. hewh! onahe? newrun Äöü;"
    assert lib.encode_all([first.encode()]) == [lib.direct(first)]
    asked.clear()
    assert lib.encode_all([second.encode()]) == [lib.direct(second)]
    assert b"newrun" in asked and not {b"haanth", b"reoush", b"hewh", b"onahe"} & {*asked}


def test_first_fit_decreasing():
    rng = np.random.default_rng(19)
    lengths = rng.integers(1, 101, 300)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    free, want = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        j = next((j for j, f in enumerate(free) if f >= lengths[i]), len(free))
        if j == len(free):
            free.append(100)
        want[i] = (j, 100 - free[j])
        free[j] -= lengths[i]
    assert [(b, o) for b, o in zip(bins, offsets)] == [want[i] for i in range(len(lengths))]


def test_packing(spark):
    rows, lib = corpus(23), Encoder(vocabulary("byte_bpe_50k.json"))
    got = packing.pack_documents(frame(spark, rows), vocabulary("byte_bpe_50k.json"), 1, capacity=256, group_docs=20).collect()
    whole, used = defaultdict(list), defaultdict(list)
    for r in got:
        whole[r.doc_id].append((r.start, r.ids))
        used[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length <= 4 * 256
    for k, t in rows:
        ids = lib.direct(t or "") + (1).to_bytes(4, "little")
        times = sum(x == (k, t) for x in rows)
        assert sorted(whole[k]) == sorted([(a, ids[4 * a:4 * (a + 256)]) for a in range(0, len(ids) // 4, 256)] * times)
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack_documents(frame(spark, []), vocabulary("byte_bpe_50k.json"), 1).count() == 0


def test_packing_groups_stay_small_for_long_documents_and_shared_ids(spark):
    long_text = " ".join(f"w{i}" for i in range(4000))
    rows = [(1, long_text)] + [(None, "same words here")] * 600 + [(7, None)] * 600 + [(8, f"a{i} b") for i in range(600)]
    docs = frame(spark, rows).repartition(6).cache()
    capacity, groups = 16, 40
    pieces = packing.cut_documents(docs, vocabulary("byte_bpe_50k.json"), 1, capacity)
    got = packing.pack(pieces, groups, capacity).collect()
    assert len(got) == pieces.count()
    assert sum(r.doc_tokens for r in got if r.start == 0) == sum(r.length for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    per_group = {}
    for r in got:
        per_group.setdefault(r.sequence_id >> packing.BIN_BITS, []).append(r)
    # no group holds more than a few runs of the long document, or all rows of a shared id
    assert max(sum(r.doc_id == 1 for r in g) for g in per_group.values()) <= 3 * packing.RUN
    for shared in (None, 7):
        assert sum(any(r.doc_id == shared for r in g) for g in per_group.values()) >= 4
    docs.unpersist()


def test_sharding(spark):
    rows = corpus(29)
    got = sharding.external_shuffle(frame(spark, rows), n_shards=7, bucket_bytes=3000).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1 and set(by) == set(range(7))
    assert sharding.external_shuffle(frame(spark, [])).count() == 0


def test_placement_follows_rows_and_seed_alone(spark):
    twins = spark.createDataFrame([(None, "twin", "s", None, i % 5, None) for i in range(12)], SCHEMA)
    docs = frame(spark, corpus(29) + corpus(29)[:9]).union(twins)
    docs = docs.withColumn("extra", F.create_map(F.lit("k"), F.col("removed")))

    def placed(df, partitions, seed=sharding.SEED):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            return {(r["shard"], r.slot): (r.doc_id, r.text, r.row, r.removed)
                    for r in sharding.external_shuffle(df, n_shards=7, seed=seed, bucket_bytes=3000).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    got = placed(docs, 2)
    assert got == placed(docs.repartition(5), 7) == placed(docs.orderBy(F.desc("text")).coalesce(1), 31)
    assert got != placed(docs, 2, seed=1)


def test_shards_written(spark, tmp_path):
    shuffled = sharding.external_shuffle(frame(spark, corpus(31)), n_shards=3, bucket_bytes=3000)
    sharding.write_shards(shuffled, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter((r.doc_id, int(r.shard), r.slot) for r in back.collect()) == Counter(
        (r.doc_id, r.shard, r.slot) for r in shuffled.collect())


def test_crc_of_packed_ids(spark):
    r = packing.pack_documents(frame(spark, [(1, "one two")]), vocabulary("byte_bpe_50k.json"), 1).select(
        "ids", F.crc32("ids").alias("c")).first()
    assert r.c == zlib.crc32(r.ids)


#: every working name of the operators, as a user's column
CLASHES = ("_at", "_p", "_bad", "_removed", "_quality", "_response", "_b", "_h", "_rec", "at", "copy", "name", "place", "group",
           "links", "removed", "k", "row")


def clashing(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASHES])


def untouched(rows):
    return all(r[c] == f"mine {c}" for r in rows for c in CLASHES)


def test_rows_that_share_an_id_are_judged_one_by_one(spark):
    passage = " ".join(f"bench{i}" for i in range(14))
    one, other, third = (" ".join(f"{c}{i}" for i in range(40)) for c in "uvw")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = [(None, one), (None, f"{other} {passage}"), (1, third), (1, passage), (1, third), (2, None)]
    kept = decontaminate.clean(clashing(spark, docs), bench).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([docs[0], docs[2], docs[4], docs[5]]) and untouched(kept)

    docs = [(1, one), (1, other), (3, other), (None, third), (None, third + " more"), (5, one)]
    kept = near.deduplicate(clashing(spark, docs)).collect()
    assert untouched(kept) and len(kept) == 3
    assert {r.text for r in kept if r.doc_id == 1} == {one, other} and sum(r.text.startswith(third) for r in kept) == 1
    placed = near.classes(clashing(spark, docs)).collect()
    assert len(placed) == 6 and [r.class_id for r in placed if r.place in (1, 3, 5)] == [1] * 4

    shared = "x1 x2 x3 x4"
    docs = [(1, f"{shared}\nkeep me here one"), (1, f"other words stand here\n{shared}\nkeep two of these lines"),
            (None, f"unique a b c d\n{shared}"), (None, f"{shared}\nunique e f g h"), (None, None), (7, f"{shared}\nlast line of all")]
    kept = lines.deduplicate_lines(clashing(spark, docs)).collect()
    assert untouched(kept) and len(kept) == 6
    left = "\n".join(r.text or "" for r in kept).split("\n")
    assert left.count(shared) == 1
    for line in ("keep me here one", "other words stand here", "keep two of these lines", "unique a b c d", "unique e f g h",
                 "last line of all"):
        assert left.count(line) == 1, line

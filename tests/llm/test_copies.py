"""Near copies, passages and line runs against brute force."""

import random

import numpy as np

from finlake.llm import components, line_dedup, near_dedup, passages
from finlake.llm.wordhash import edits_within, hashed, shingles, word_hashes
from tests.llm.cases import awkward, edited, frame, words


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment_equals_the_full_table():
    r = random.Random(1)
    for _ in range(600):
        a = [r.randint(1, r.choice([3, 40])) for _ in range(r.randint(0, 30))]
        b = list(a)
        for _ in range(r.randint(0, 8)):
            at = r.randint(0, len(b))
            b[at:at + r.randint(0, 2)] = [r.randint(1, 40)] * r.randint(0, 2)
        want, limit = edit_distance(a, b), r.randint(0, 12)
        got = edits_within(np.array(a, np.uint64), np.array(b, np.uint64), limit)
        assert got == (want if want <= limit else None)


def test_word_hashes_see_words_only():
    assert (word_hashes("a  b\tc a")[[0, 3]] == word_hashes("a")[0]).all()
    assert len(word_hashes(" \n")) == len(word_hashes("")) == 0
    assert word_hashes("ab c").tolist() != word_hashes("a bc").tolist()
    long = " ".join(words(900_000, 4))
    assert len(word_hashes(long)) == 900_000            # more than one piece
    assert len(shingles(word_hashes("a b c"), 5)) == 1


def test_components_are_the_least_nodes(spark):
    r, parent = random.Random(3), {i: i for i in range(300)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(299, i) for i in range(0, 120, 2)] + [(5, 5)]
    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {x.node: x.class_id for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {n: find(n) for n in nodes}


def test_near_classes_match_all_pairs(spark):
    rows, base = [], {}
    for g in range(12):
        base[g] = words(60 + 25 * g, 100 + g)
        for c in range(1 + g % 4):
            rows.append((10 * g + c + 1000, " ".join(edited(base[g], c * max(1, len(base[g]) // 40), c))))
    hot = words(80, 77)
    rows += [(3000 + i, " ".join(edited(hot, 1, i))) for i in range(60)]
    shared = words(40, 55)                              # a passage in texts that are no copies
    rows += [(4000 + i, " ".join(words(150, 500 + i) + shared + words(150, 700 + i))) for i in range(20)]
    rows += awkward()
    hashes = [word_hashes(t or "") for _, t in rows]
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, _ in rows:
        if i is not None:
            parent[i] = i
    for x in range(len(rows)):
        for y in range(x):
            (i, _), (j, _) = rows[x], rows[y]
            n = max(len(hashes[x]), len(hashes[y]))
            if i is not None and j is not None and edits_within(hashes[x], hashes[y], int(n * 0.2 + 1e-9)) is not None:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    got = near_dedup.near_classes(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.class_id) for r in got if r.doc_id is not None} == {(i, find(i)) for i in parent}
    assert all(r.class_id is None and r.kept for r in got if r.doc_id is None)
    left = near_dedup.drop_near_duplicates(frame(spark, rows))
    assert left.columns == frame(spark, rows).columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted({find(i) for i in parent})
    assert near_dedup.near_classes(frame(spark, rows).limit(0)).count() == 0


def test_sketch_sees_order():
    ws = words(200, 9)
    a = near_dedup.order_sketches(word_hashes(" ".join(ws)))
    b = near_dedup.order_sketches(word_hashes(" ".join(ws[100:] + ws[:100])))
    c = near_dedup.order_sketches(word_hashes(" ".join(edited(ws, 4, 1))))
    assert (a == c).mean() > (a == b).mean()
    assert (a == near_dedup.order_sketches(word_hashes(" ".join(ws)))).all()


def test_chains_are_the_best_by_dynamic_programming():
    r = random.Random(4)
    for _ in range(60):
        n = r.randint(1, 25)
        x, y = (np.array([r.randint(0, 60) for _ in range(n)]) for _ in range(2))
        best = [passages.SEED_GAIN] * n
        for i in np.lexsort((y, x)):
            for j in range(n):
                if x[j] < x[i] and y[j] < y[i]:
                    gap = passages.GAP_COST * (x[i] - x[j] + y[i] - y[j])
                    best[i] = max(best[i], best[j] + passages.SEED_GAIN - gap)
        chains = passages.best_chains(x, y)
        if chains:
            c = chains[0]
            got = passages.SEED_GAIN * len(c) - passages.GAP_COST * (x[c[-1]] - x[c[0]] + y[c[-1]] - y[c[0]])
            assert abs(got - max(best)) < 1e-9
            assert (np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all()
        else:
            assert max(best) == passages.SEED_GAIN


def test_every_window_has_a_seed():
    values = np.array(words(0, 0) or [random.Random(6).randrange(9) for _ in range(500)], np.uint64)
    at = passages.window_minima(values, 12)
    assert np.diff(np.concatenate(([-1], at, [500]))).max() <= 13 + 12


def test_passages_are_found_and_cut(spark):
    exact, fuzzy = words(60, 9001), words(90, 9002)
    rows = [(100 + i, " ".join(words(120, 1000 + i) + exact + words(100, 2000 + i))) for i in range(1, 8)]
    rows += [(200 + i, " ".join(words(80, 3000 + i) + edited(fuzzy, 4 * (i > 0), i) + words(70, 4000 + i))) for i in range(3)]
    clean = [(300 + i, " ".join(words(300, 5000 + i))) for i in range(10)]
    docs = frame(spark, rows + clean + awkward())
    by = {}
    for r in passages.repeated_passages(docs).collect():
        by.setdefault(r.doc_id, []).append((r.start_word, r.end_word, r.source_doc_id))
    for i in range(102, 108):
        assert by[i] == [(120, 180, 101)]
    for i in (201, 202):
        (start, end, source), = by[i]
        assert abs(start - 80) <= 3 and abs(end - 170) <= 3 and source < i
    assert by[7] == [(0, 6000, 6)]
    assert set(by) == {7, 201, 202, *range(102, 108)}
    left = {r.doc_id: r.text for r in passages.drop_passages(docs).collect() if r.doc_id is not None}
    text = dict(rows)
    for i in range(102, 108):
        ws = text[i].split()
        assert left[i].split() == ws[:120] + ws[180:]
    assert all(left[i] == t for i, t in clean) and left[101] == text[101]
    assert 7 not in left and 6 in left and 1 in left
    assert passages.drop_passages(docs).columns == docs.columns
    assert passages.repeated_passages(docs.limit(0)).count() == 0


def test_cut_words():
    assert passages.cut_words("a b\nc  d", [(1, 3)]) == "a d"
    assert passages.cut_words(" a b", [(0, 9)]) == " "
    assert passages.cut_words("a b c", [(0, 2), (1, 3)]) == ""


def test_line_runs(spark):
    lines = [" ".join(words(6, 300 + i)) for i in range(200)]
    block = lines[:6]
    rows = [(1, "\n".join(lines[10:14] + block + lines[20:24])), (2, "\n".join(lines[30:33] + ["", *block, " "] + lines[40:42])),
            (3, "\n".join(block[:1] + lines[50:53] + block[4:5])), (4, "\n".join(lines[60:63] + lines[60:63] + lines[70:72]))]
    docs = frame(spark, rows + [(i + 50, t) for i, t in awkward() if i not in (None, 4, 6, 7, 8)] + [(None, rows[0][1])])
    got = {(r.doc_id, r.start_line, r.end_line, r.source_doc_id, r.source_line)
           for r in line_dedup.repeated_runs(docs).collect()}
    assert got == {(2, 3, 9, 1, 4), (4, 3, 6, 4, 0)}
    left = {r.doc_id: r.text for r in line_dedup.drop_runs(docs).collect() if r.doc_id is not None}
    assert left[2] == "\n".join(lines[30:33] + ["", " "] + lines[40:42]) and left[1] == rows[0][1]
    assert left[4] == "\n".join(lines[60:63] + lines[70:72]) and left[51] is None
    assert line_dedup.repeated_runs(docs.limit(0)).count() == 0


def test_every_line_of_a_repeated_run_is_found(spark):
    r = random.Random(8)
    block = [" ".join(words(5, 9100 + i)) for i in range(12)]
    rows = []
    for i in range(40):                                 # parts of the block, at their first occurrences in many documents
        at, n = r.randrange(11), r.choice([2, 2, 2, 3, 4, 12])
        rows.append((i, "\n".join([f"own {i}", *block[at:at + n], f"end {i}"])))
    rows += [(100, "\n".join(block[:2])), (101, "\n".join(["x", *block[:3]])), (102, "\n".join(["y", *block[:3], "z"]))]
    seen, want = set(), set()
    for i, text in rows:
        lines = text.split("\n")
        grams = [(tuple(lines[at:at + 3]), at) for at in range(len(lines) - 2)]
        for gram, at in grams:
            if gram in seen:
                want |= {(i, at + k) for k in range(3)}
            seen.add(gram)
    got = {(x.doc_id, at) for x in line_dedup.repeated_runs(frame(spark, rows)).collect()
           for at in range(x.start_line, x.end_line)}
    assert got == want


def test_pairs_in_a_hot_bucket_of_unrelated_texts(spark):
    header = words(60, 9200)
    rows = [(i, " ".join(header + words(60, 20_000 + i))) for i in range(2500)]
    for i in range(20):                                 # every third word behind the header differs
        own = rows[100 * i + 50][1].split()[60:]
        rows.append((5000 + i, " ".join(header + [f"new{i}w{k}" if k % 3 == 0 else w for k, w in enumerate(own)])))
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(frame(spark, rows)).collect()}
    assert {i: c for i, c in got.items() if i != c} == {5000 + i: 100 * i + 50 for i in range(20)}


def test_members_outside_a_large_class_are_not_paired_with_all_of_it(spark, monkeypatch):
    """Each holds the core of the class, is no copy of its members, and has few words rarer than the core's."""
    r, core, header = random.Random(21), words(200, 9210), words(60, 9211)
    often = [f"often{i}" for i in range(40)]
    some = lambda n: r.sample(often, n)
    members = [(i, " ".join([*core, *(f"m{i}w{k}" for k in range(20))])) for i in range(180)]
    outside = [(1000 + i, " ".join([*core, *(f"x{i}w{k}" for k in range(30)), *some(40)])) for i in range(50)]
    # copies of one member each, at the limit
    chained = [(2000 + i, " ".join([members[30 + 9 * i][1], *(f"c{i}w{k}" for k in range(18)), *some(36)])) for i in range(6)]
    unrelated = [(3000 + i, " ".join([*header, *some(40), *(f"u{i}w{k}" for k in range(60))])) for i in range(320)]
    hashes = {i: word_hashes(t) for i, t in members + outside + chained}
    link = lambda a, b: edits_within(
        hashes[a], hashes[b], int(max(len(hashes[a]), len(hashes[b])) * 0.2 + 1e-9)) is not None
    assert not any(link(x, i) for x, _ in outside for i, _ in members + chained)
    assert all([i for i, _ in members if link(c, i)] == [30 + 9 * (c - 2000)] for c, _ in chained)
    parent = {x: x for x, _ in outside}
    for x, _ in outside:
        for y, _ in outside:
            if y < x and link(x, y):
                parent[x] = min(parent[x], parent[y])
    assert len(set(parent.values())) == len(outside)
    want = parent | {i: 0 for i, _ in members + chained} | {i: i for i, _ in unrelated}
    sent, verify = [], near_dedup._verify

    def counted(pairs, texts, similarity):
        sent.append(pairs)
        return verify(pairs, texts, similarity)
    monkeypatch.setattr(near_dedup, "_verify", counted)
    docs = frame(spark, members + outside + chained + unrelated)
    assert {x.doc_id: x.class_id for x in near_dedup.near_classes(docs).collect()} == want
    assert sent[-1].count() < 2000                      # of 9000 pairs of an outside text and a member
    for name, value in (("LIST", 5), ("PART", 1000), ("STRIPE", 64), ("ROOM", 4000)):
        monkeypatch.setattr(near_dedup, name, value)    # several blocks, parts and stripes
    assert {x.doc_id: x.class_id for x in near_dedup.near_classes(docs).collect()} == want


def test_common_words_count_as_often_as_in_both():
    r = random.Random(22)
    texts = [np.array([r.randrange(9) for _ in range(r.randint(0, 30))], np.uint64) for _ in range(40)]
    got = near_dedup.overlaps(texts[:15], texts[15:])
    for i, a in enumerate(texts[:15]):
        for j, b in enumerate(texts[15:]):
            assert got[i, j] == sum(min((a == w).sum(), (b == w).sum()) for w in range(9))


def test_texts_within_the_limit_share_rarest_words():
    r = random.Random(12)
    counts = np.array([r.randrange(50) for _ in range(512)])
    for _ in range(2000):
        a = [r.randrange(r.choice([5, 60])) for _ in range(r.randint(1, 60))]
        b = list(a)
        for _ in range(r.randint(0, 12)):
            at = r.randrange(len(b) + 1)
            b[at:at + r.randint(0, 1)] = [r.randrange(60)] * r.randint(0, 1)
        if len(b) and a != b and edit_distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9):
            x, y = (near_dedup.rarest(np.array(t, np.uint64), counts, 0.8) for t in (a, b))
            assert len(np.intersect1d(x, y)) >= near_dedup.SHARED


def test_exact_repeats_whose_parts_occur_earlier_are_covered(spark):
    rows, want = [], set()
    for g in range(20):
        whole = words(60, 9300 + g)
        for k, part in enumerate((whole[:39], whole[21:], whole, whole)):
            rows.append((10 * g + k, " ".join(words(50, 10_000 + 10 * g + k) + part + words(50, 30_000 + 10 * g + k))))
        want |= {(10 * g + 3, at) for at in range(50, 110)}
    got = {(r.doc_id, at) for r in passages.repeated_passages(frame(spark, rows)).collect()
           for at in range(r.start_word, r.end_word)}
    assert want <= got
    assert {i % 10 for i, _ in got} == {3}


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    """No word of an unrelated text with a used id is lost, and copies under a used id are found."""
    lines = lambda n, seed: "\n".join(" ".join(words(6, 1000 * seed + k)) for k in range(n))
    shared, own, other = words(80, 31), words(120, 32), words(120, 33)
    first, copy = " ".join(shared + own), " ".join(words(30, 34) + shared + words(30, 35))
    block = lines(5, 36)
    rows = [(1, first), (5, "a " + " ".join(other)), (5, "b " + copy), (5, "b " + copy), (5, "c\n" + block), (7, block + "\nz"),
            (8, " ".join(edited(shared + own, 4, 37))), (8, "unrelated " + " ".join(words(90, 38))), (None, first)]
    docs = frame(spark, rows)
    texts = lambda df: sorted((r.doc_id or 0, r.text) for r in df.collect())
    near = texts(near_dedup.drop_near_duplicates(docs))
    gone = sorted(set((i or 0, t) for i, t in rows) - set(near))
    assert gone == sorted([(8, rows[6][1]), (5, rows[4][1])]) and len(near) == len(set(near))
    classes = near_dedup.near_classes(docs).collect()
    assert len(classes) == len(rows) and sorted((r.doc_id, r.class_id) for r in classes if not r.kept) == [(5, 7), (8, 1)]
    cut = texts(passages.drop_passages(docs))
    assert len(cut) == len(rows) - 1              # the near copy under id 8 is one passage, and goes
    for i, t in [(5, rows[1][1]), (8, rows[7][1]), (7, rows[5][1]), (1, first), (0, first), (5, rows[4][1])]:
        assert (i, t) in cut
    found = {(r.doc_id, r.source_doc_id) for r in passages.repeated_passages(docs).collect()}
    assert (5, 1) in found and all(max(x) <= 8 for x in found)
    assert all(not t.startswith("b ") or " ".join(shared[5:75]) not in t for _, t in cut)
    left = texts(line_dedup.drop_runs(docs))
    assert len(left) == len(rows) and (5, "c") in left and (7, block + "\nz") in left
    assert {t for _, t in left} >= {t for _, t in rows if block not in t}


def test_window_minima_are_the_last_least_of_each_window():
    r = random.Random(8)
    for n in range(1, 120):
        values = np.array([r.randint(0, 3 if n % 2 else 10**6) for _ in range(n)], np.uint64)
        for window in (1, 2, 5, 11, 12):
            w = min(window, n)
            every = {max(range(i, i + w), key=lambda j: (-int(values[j]), j)) for i in range(n - w + 1)}
            got = passages.window_minima(values, window).tolist()
            assert set(got) <= every
            assert n % 2 or got == sorted(every)        # values that hardly repeat: none is left out


def test_passages_make_each_key_once(spark, monkeypatch):
    plans, write = {}, passages.materialise

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)
    monkeypatch.setattr(passages, "materialise", watched)
    shared = words(70, 61)
    rows = [(i, " ".join(words(30, 900 + i) + shared)) for i in range(4)]
    df = passages.repeated_passages(frame(spark, rows))
    plans["result"] = df._jdf.queryExecution().executedPlan().toString()
    made = [line for p in plans.values() for line in p.splitlines() if "InPandas" in line]
    assert len(made) == 5                               # seeds, chains, alignment, run keys, runs around them
    got = {(r.doc_id, r.source_doc_id, r.n_words) for r in df.collect()}
    assert got == {(i, 0, 70) for i in (1, 2, 3)}


def test_texts_hashed_together_have_the_words_of_each():
    r = random.Random(13)
    texts = [" ".join(r.choice(["a", "é", "x\t", "\n", "", f"w{i}"]) for _ in range(r.randint(0, 40))) for i in range(200)]
    texts += ["", "end", "start", "q " * 200_000, "z" * 150_000]
    groups = list(hashed(texts))
    assert len(groups) > 2 and [h.stop for h in groups[:-1]] == [h.start for h in groups[1:]]
    for h in groups:
        for i, a, b in zip(range(h.start, h.stop), h.first[:-1], h.first[1:], strict=True):
            assert h.words[a:b].tolist() == word_hashes(texts[i]).tolist()
            assert [h.data[h.places[k]:h.places[k + 1]].split()[0].decode() for k in range(a, b)] == texts[i].split()


def test_keys_of_many_texts_are_those_of_each():
    r = random.Random(14)
    texts = [np.array([r.randrange(r.choice([2, 5, 10**9])) for _ in range(r.choice([0, 39, 40, 45, 52, 200]))], np.uint64)
             for _ in range(150)]
    first = np.cumsum([0, *map(len, texts)])
    count = np.array([len(t) if len(t) >= passages.MIN_WORDS else 0 for t in texts])
    text, keys, at = passages.seeds_of_texts(np.concatenate(texts), first[:-1], count)
    runs = passages.long_runs(np.concatenate(texts))
    of, run_at = passages.minima_of_texts(runs, first[:-1], np.maximum(count - passages.MIN_WORDS + 1, 0), passages.SPREAD)
    for i, t in enumerate(texts):
        want = passages.window_minima(shingles(t, passages.SEED_WORDS), passages.WINDOW).tolist() if count[i] else []
        assert sorted(set(at[text == i] - first[i])) == want
        assert len(set(keys[text == i].tolist())) == len(keys[text == i])       # a repeated k-mer goes by its number too
        want = passages.window_minima(passages.long_runs(t), passages.SPREAD).tolist() if count[i] else []
        assert (run_at[of == i] - first[i]).tolist() == want


def test_passage_keys_travel_packed(spark):
    rows = [(i - 50, " ".join(words(200, 40_000 + i % 90))) for i in range(100)]
    keys = passages._keys(frame(spark, rows).select("doc_id", "text").coalesce(1))
    packed = keys.collect()
    assert sum(len(r.keys) for r in packed) // 8 > 5000 and len(packed) <= 2 * passages.GROUPS
    got = {(r.doc_id, r.source, r.pos) for r in passages._matches(keys).collect()}
    assert {(d, s) for d, s, _ in got if d != s} == {(i + 40, i - 50) for i in range(10)}


def test_a_chain_without_gaps_is_the_best_chain(spark):
    r, rows = random.Random(15), []
    for pair in range(40):
        x = np.cumsum([r.randint(1, r.choice([8, 90])) for _ in range(r.randint(1, 30))])
        y = x + (np.cumsum([r.randint(0, r.choice([1, 60])) for _ in x]) if pair % 2 else r.randint(0, 9))
        rows += [(100 + pair % 7, pair, int(a), int(b)) for a, b in zip(x, y, strict=True)]
    got = [(c.doc_id, c.source, c.xs, c.ys) for c in passages._chains(
        spark.createDataFrame(rows, "doc_id long, source long, pos int, source_pos int")).collect()]
    want = []
    for pair in range(40):
        x, y = (np.array([row[k] for row in rows if row[1] == pair]) for k in (2, 3))
        want += [(100 + pair % 7, pair, x[c].tolist(), y[c].tolist()) for c in passages.best_chains(x, y)]
    assert sorted(got) == sorted(want)


def test_sketches_of_many_texts_are_those_of_each():
    r = random.Random(16)
    texts = [" ".join(f"w{r.randrange(r.choice([2, 9999]))}" for _ in range(r.choice([0, 3, 5, 6, 7, 300]))) for _ in range(200)]
    for h in hashed(texts):
        got = near_dedup.sketches_of_texts(h.words, h.first)
        for keys, t in zip(got, texts[h.start:h.stop], strict=True):
            assert keys.tolist() == near_dedup.order_sketches(word_hashes(t)).tolist()


def test_short_alignments_equal_the_full_table():
    r = random.Random(17)
    for n in (1, 7, 60, 150):
        for _ in range(25):
            a = [r.randint(1, r.choice([3, 300])) for _ in range(n)]
            b = list(a)
            for _ in range(r.randint(0, n // 3 + 1)):       # few edits go by diagonals, many by columns
                at = r.randint(0, len(b))
                b[at:at + r.randint(0, 2)] = [r.randint(1, 300)] * r.randint(0, 2)
            want = edit_distance(a, b)
            for limit in (want - 1, want, want + 9):
                if limit >= 0:
                    assert edits_within(np.array(a, np.uint64), np.array(b, np.uint64), limit) == (
                        want if want <= limit else None)


def test_passages_are_cut_by_one_python_worker_of_a_task(spark):
    passage = " ".join(words(60, 1))
    docs = frame(spark, [(1, passage), (2, passage), (3, passage + " " + " ".join(words(50, 2)))])
    left = passages.drop_passages(docs)
    assert left._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert {r.doc_id: r.n_chars for r in left.collect()} == {1: len(passage), 3: len(" ".join(words(50, 2)))}

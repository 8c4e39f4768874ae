"""Exact dedup and quality rules against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import regex
from pyspark.sql import functions as F

from finlake.llm import exact_dedup, quality_rules
from tests.llm.cases import awkward, frame, words

SPACE = re.compile(r"[\x20\x09-\x0D]")


def exact_truth(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(SPACE.sub("", text or ""), []).append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        best = sorted(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        for doc_id, _ in members:
            out.append((doc_id, best[0], len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup_matches_brute_force(spark):
    rows = awkward() + [(100 + i, "hot copy" + " " * (i % 7)) for i in range(200)]
    got = exact_dedup.mark_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == exact_truth(rows)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_keeps_columns_and_takes_empty_tables(spark):
    docs = frame(spark, awkward())
    left = exact_dedup.drop_duplicates(docs)
    assert left.columns == docs.columns
    assert left.count() == len({SPACE.sub("", t or "") for _, t in awkward()})
    assert exact_dedup.mark_duplicates(docs.limit(0)).count() == 0


def base_truth(text):
    text = text or ""
    ws = [w for w in SPACE.split(text) if w]
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    wins = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    seen, covered = Counter(wins), set()
    for i, w in enumerate(wins):
        if seen[w] > 1:
            covered.update((i, i + 1, i + 2))
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(ws) < 50 or 100 * len(covered) > 50 * len(ws))


def test_quality_base_counts_match_brute_force(spark):
    extra = [(20, "a b c a b c d\nx\nx\n \nx #*|"), (21, "k k k k k"), (22, " ".join(words(60, 3)) + " <b> & 100 %")]
    rows = awkward() + extra
    got = quality_rules.assess(frame(spark, rows)).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(((i, *base_truth(t)) for i, t in rows), key=repr)
    assert not any(r.kept for r in got if r.base_failed)


def english(n, seed):
    common, rare = quality_rules.COMMON_WORDS["en"], words(n, seed)
    return " ".join(common[(i * 7 // 2 + seed) % 16] if i % 2 else w for i, w in enumerate(rare)) + "."


def test_quality_divergence_rejects_strange_texts(spark):
    good = [(i, english(120, i)) for i in range(40)]
    bad = [(100, " ".join(w.upper() + "!!" for w in words(120, 7))), (101, " | ".join(words(150, 8)) + " ###"),
           (102, " ".join(words(200, 9)))]
    docs = frame(spark, good + bad).withColumn("lang", F.lit("en"))
    kept = {r.doc_id for r in quality_rules.keep_good(docs).collect()}
    assert kept == {i for i, _ in good}
    assert quality_rules.assess(docs.limit(0)).count() == 0


def russian(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("абвгдежзиклмнопрстуя") for _ in range(r.randint(2, 8))) for _ in range(n)) + "."


def test_every_language_has_its_own_reference(spark):
    """Clean texts of a language without a word list, in whatever script, are kept; strange ones go."""
    clean = [(i, russian(120, i)) for i in range(20)] + [(100 + i, english(120, i)) for i in range(20)]
    odd = [(50, russian(120, 50).upper().replace(" ", " !!! ")), (51, " | ".join(words(150, 8)) + " ###")]
    docs = frame(spark, clean + odd).withColumn("lang", F.when(F.col("doc_id") < 100, "ru").otherwise("en"))
    assert {r.doc_id for r in quality_rules.keep_good(docs).collect()} == {i for i, _ in clean}
    few = frame(spark, [(i, russian(120, i)) for i in range(5)]).withColumn("lang", F.lit("uk"))
    assert quality_rules.keep_good(few).count() == 5              # too little text: base rules only
    unnamed = frame(spark, clean[:20]).withColumn("lang", F.lit(None).cast("string"))
    assert quality_rules.keep_good(unnamed).count() == 20


def test_quality_verdict_by_plain_counting(spark):
    """Distances and verdicts against plain numpy over the same histograms."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in quality_rules.assess(docs).select(
        "row.doc_id", "char_distance", "word_distance", "base_failed", "kept").collect()}
    rows = [(r.doc_id, r.lang, r.text or "") for r in docs.collect()]

    def histogram(text):
        rest, out = text, []
        for pattern in (r"[a-z]+", r"[ \t-\r]+", r"(?:(?![A-Za-z])[\p{L}\p{M}])+", r"[A-Z]+", r"[.,;:!?'\"()\-]+", r"\p{N}+"):
            new = regex.sub(pattern, "", rest)
            out.append(len(rest) - len(new))
            rest = new
        return np.array([*out, len(rest)], float)

    def hits(text, lang):
        ws = [w.lower() for w in SPACE.split(text) if w]
        n = [ws.count(w) for w in quality_rules.COMMON_WORDS[lang]]
        return np.array([*n, len(ws) - sum(n)], float)

    def distance(counts, pooled):
        p, q = counts / counts.sum(), pooled / pooled.sum()
        m = (p + q) / 2
        kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x > 0)
        return max((kl(p) + kl(q)) / 2, 0) ** .5

    long = [(i, lang, t) for i, lang, t in rows if len([w for w in SPACE.split(t) if w]) >= quality_rules.MIN_WORDS]
    chars = {lang: sum(histogram(t) for _, x, t in long if x == lang) for lang in quality_rules.COMMON_WORDS}
    words_ = {lang: sum(hits(t, lang) for _, x, t in long if x == lang) for lang in quality_rules.COMMON_WORDS}
    for i, lang, t in long:
        n = len([w for w in SPACE.split(t) if w])
        c, w = distance(histogram(t), chars[lang]), distance(hits(t, lang), words_[lang])
        assert abs(c - got[i].char_distance) < 1e-6 and abs(w - got[i].word_distance) < 1e-6
        fits = c <= (quality_rules.CHAR_LIMIT + quality_rules.CHAR_NOISE / n) ** .5 and \
            w <= (quality_rules.WORD_LIMIT + quality_rules.WORD_NOISE / n) ** .5
        assert got[i].kept == (fits and not got[i].base_failed)


def test_hot_texts_are_dealt_by_their_count(spark, monkeypatch):
    """Groups above the target rows get a salt for each target, and the result stays the same."""
    monkeypatch.setattr(exact_dedup, "SALT_ROWS", 5)
    monkeypatch.setattr(exact_dedup, "SALTS", 2)
    rows = [(i, ["same  text", "same text ", "other", f"own {i}"][min(i % 5, 3)]) for i in range(200)] + [(None, "other")] * 3
    got = exact_dedup.mark_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == exact_truth(rows)
    assert Counter(r.text_sha256 for r in got if r.kept).most_common(1)[0][1] == 1

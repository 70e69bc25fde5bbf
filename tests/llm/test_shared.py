"""Decontamination, spelling variants and collocations against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from textspark.llm import collocations, decontamination, queries, spelling
from textspark.registry.compare import connect, difference

from .fixtures import documents, no_documents, sentence


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# -- decontamination

BENCH_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def hits(docs, items):
    windows = defaultdict(set)
    for r in items:
        w = BENCH_WORD.findall(lowered(r.text))
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[i : i + size])].add("" if r.item_id is None else str(r.item_id))
    out = []
    for r in docs:
        w, covered, found = BENCH_WORD.findall(lowered(r.text)), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    covered |= set(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        out.append((r.doc_id, r.text, len(w), len(covered), len(found), sorted(found), bool(covered)))
    return sorted(out, key=repr)


def benchmark_and_texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "日本", "Ünder", "A1"]
    items = [sentence(rng, n, vocabulary) for n in (1, 2, 4, 5, 6, 9, 10, 11, 30, 60)]
    items += ["same " * 40, "", None, "...", items[-1], items[-1].upper()]
    texts = [sentence(rng, rng.randint(1, 80), vocabulary) for _ in range(30)]
    for item in items[:11]:
        w = item.split()
        for take in (len(w), 9, 10, 12):
            low = rng.randrange(max(1, len(w) - take + 1))
            texts.append(sentence(rng, 15, vocabulary) + " -- " + "; ".join(w[low : low + take]) + "! " + sentence(rng, 7, vocabulary))
    return items, [*texts, "same " * 300, "same " * 9]


@pytest.mark.parametrize("seed", [1, 2])
def test_every_shared_window_is_found(spark, seed):
    texts, more = benchmark_and_texts(seed)
    rows = [(i if i % 5 else None, t, "x") for i, t in enumerate(texts)] + [(3, "two rows with the id 3 are one item", "y")]
    items = spark.createDataFrame(rows, "item_id long, text string, n_items string")
    docs = documents(spark, more)
    got = decontamination.contamination(docs, items)
    assert got.columns == [*docs.columns, "n_words", "n_hit", "n_items", "items", "contaminated"]
    columns = ["doc_id", "text", "n_words", "n_hit", "n_items", "items", "contaminated"]
    assert sorted([tuple(r) for r in got.select(columns).collect()], key=repr) == hits(docs.collect(), items.collect())


def test_other_windows_and_joins_beyond_the_broadcast_limit(spark, monkeypatch):
    texts, more = benchmark_and_texts(3)
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = documents(spark, more)
    one = sorted(map(repr, decontamination.contamination(docs, items, ["doc_id"]).collect()))
    real = decontamination.lookup
    monkeypatch.setattr(decontamination, "lookup", lambda *a, **k: real(*a, **k, limit=0))
    assert sorted(map(repr, decontamination.contamination(docs, items, ["doc_id"], gram=3).collect())) == one


def test_nothing_to_decontaminate(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark)
    assert not any(r.contaminated for r in decontamination.contamination(docs, items).collect())
    assert decontamination.contamination(no_documents(spark), items).count() == 0


# -- spelling


def plain_variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    gone = defaultdict(set)  # words by what is left without one letter
    for w in n:
        for i in range(len(w)):
            gone[w[:i] + w[i + 1 :]].add((w, i))
    near = defaultdict(set)
    for rest, members in gone.items():
        for w, i in members:
            near[w] |= {v for v, j in members if v != w and i == j and len(v) == len(w)}
            if rest in n:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def misspelt(seed):
    rng = random.Random(seed)
    letters = "abcdeé"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 14))) for _ in range(25)]
    words = []
    for w in base:
        words += [w] * rng.choice([2, 20, 300])
        for _ in range(rng.randint(0, 14)):
            v, edits = w, rng.choice([1, 1, 2])
            for _ in range(edits):
                i = rng.randrange(len(v))
                v = rng.choice([v[:i] + v[i + 1 :], v[:i] + rng.choice(letters) + v[i:], v[:i] + rng.choice(letters) + v[i + 1 :]])
            words += [v] * rng.choice([2, 2, 3, 25])
    # all words of seven letters that differ in the middle, many repeated letters, long words
    words += [f"aa{x}{y}{z}bb" for x in letters for y in letters for z in letters] * 2
    words += ["a" * n for n in range(6, 40)] * 2 + ["x" * 700 + "yz", "x" * 700 + "yy", "x" * 699 + "yy"] * 3
    words += ["b" * 50 + x for x in letters] * 30 + ["Ÿabcdefgh", "×÷×÷×÷×÷", "ABCDEFGÀ", "abcdefgà"] * 2
    words += ["chainlink"] * 900 + ["chainlonk"] * 60 + ["chainlonkk"] * 3  # forms of forms
    rng.shuffle(words)
    size = 40
    return [" ".join(words[i : i + size]) for i in range(0, len(words), size)]


@pytest.mark.parametrize("block", [256, 4])
def test_variants_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    docs = documents(spark, misspelt(block))
    got = spelling.variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(1 for r in want if r[1]) > 20 and any(r[2] != r[0] and r[2] != r[1] for r in want)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == want


def test_variants_of_no_texts(spark):
    assert spelling.variants(no_documents(spark)).count() == 0


def test_spelling_query_counts_the_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_spelling(spark, sf_dir)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == plain_variants(rows)


# -- collocations


def plain_collocations(rows, threshold, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 5):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {g: a for g, a in counts.items() if len(g) > 1 and a >= threshold}
        covered = set()
        for g, a in found.items():
            for size in range(2, len(g)):
                covered |= {g[i : i + size] for i in range(len(g) - size + 1) if 100 * a >= 80 * found[g[i : i + size]]}
        rows = []
        for g, a in found.items():
            if g not in covered:
                score, k = min((2000000 * a // (counts[g[:k]] + counts[g[k:]]), k) for k in range(1, len(g)))
                rows.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrases(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "new", "york", "city", "É", "é1", "\x1cx", "10%"]
    fixed = ["New  York City hall", "state of the art", "e.g. this; that", "a\tb c d e", "the the the the the"]
    return ["".join(rng.choice(fixed) + rng.choice([" ", ", ", "\n", " of ", "! "]) + sentence(rng, rng.randint(1, 6), vocabulary) + rng.choice([" ", ". "]) for _ in range(30)) for _ in range(25)]


@pytest.mark.parametrize(("threshold", "capacity"), [(30, None), (3, None), (300, 5)])
def test_collocations_are_those_of_whole_counts(spark, monkeypatch, threshold, capacity):
    docs = documents(spark, phrases(threshold))
    if capacity:  # summaries that prune: what they keep is still enough
        monkeypatch.setattr(collocations, "LOCAL", 50)
        real = collocations.lookup
        monkeypatch.setattr(collocations, "lookup", lambda *a, **k: real(*a, **k, limit=0))
    got = collocations.collocations(docs, threshold)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain_collocations([(r.lang, r.text) for r in docs.collect()], threshold)
    assert want and sorted(tuple(r) for r in got.collect()) == want
    assert sorted(tuple(r) for r in collocations.collocations(docs, threshold, top=2).collect()) == [r for r in want if r[1] <= 2]


def test_collocations_of_no_texts(spark):
    assert collocations.collocations(no_documents(spark)).count() == 0


def test_summaries_prune_but_keep_what_is_frequent():
    rng = np.random.default_rng(4)
    often = rng.integers(0, 1 << 62, 20, dtype=np.uint64)
    stream = np.concatenate([np.repeat(often, 30), rng.integers(0, 1 << 62, 20000, dtype=np.uint64)])
    rng.shuffle(stream)
    whole = collocations.MisraGries(len(stream) // 30 + 1)
    for part in np.array_split(stream, 40):  # merged one after the other
        values, counts = np.unique(part, return_counts=True)
        whole.add(values, counts)
        whole.merge()
    assert len(whole.hashes) <= whole.capacity < len(stream) // 20 and whole.taken > 0
    kept = set(whole.hashes[whole.counts + whole.taken >= 30].tolist())
    assert set(often.tolist()) <= kept


def test_filter_of_hashes_misses_none(spark):
    values = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000, dtype=np.int64)
    got = collocations.HashFilter(spark.createDataFrame([(int(v),) for v in values[:2500]], "h long")).holds(values.view(np.uint64))
    assert got[:2500].all() and got[2500:].mean() < 0.05


@pytest.mark.parametrize("name", ["op11_decontamination", "op13_collocations"])
def test_matches_sql(spark, sf_dir, name):
    con = connect(sf_dir)
    assert difference(spark, con, sf_dir, queries.QUERIES[name], queries.ORACLES[name]) == ""

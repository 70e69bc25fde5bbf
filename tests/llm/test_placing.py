"""Packing, sharding and mixing against plain versions."""

import random

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from textspark.llm import mixing, packing, shards  # noqa: E402
from textspark.llm.common import small_batches  # noqa: E402

from .fixtures import documents, no_documents, words  # noqa: E402

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = ["İstanbul is. a,b c.. À x\x1cy '", "don't I'll they're, 12.5% ...", "ΑΣ ΑΣ. 한국어 가 日本語。", "a b c\x85d e\x0bf", ".", ",", "..", ". a", "x.", "12.,"]


def test_ids_are_those_of_the_whole_text():
    encoder = packing.WordEncoder(VOCABULARY)
    texts = [*ODD, "", "  ", "plain words, and more words.", "x" * 100 + ". y"]
    for _ in range(2):  # unknown words first, cached ones then
        ids, at = encoder.encode(pa.array(texts), 2)
        for i, text in enumerate(texts):
            want = [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2]
            assert ids[at[i] : at[i + 1]].tolist() == want, text


def test_ids_of_odd_letters_marks_and_signs():
    """Letters that the normaliser turns into a letter and a mark, marks, controls, full-width signs, other scripts."""
    rng = random.Random(3)
    wide = [*range(0x20, 0x250), *range(0x390, 0x3D0), *range(0x400, 0x460), 0x130, 0x149, 0x958, 0x929, 0xFB1D, 0x301, 0x307, 0x308, 0x327, 0x1E9E]
    wide += [0x212A, 0xAC00, 0x1100, 0x1161, 0xFF21, 0xFF0E, 0xFF0C, 0x200B, 0x2003, 0x1F600, 0x10400, 0x660, 0x966, 0x2160, 0x1C5, 0x1F88]
    texts = ["İ,", "İ.", "cİ,", "क़.", "x\u0958,"]
    for _ in range(4000):
        parts = [rng.choice([chr(rng.choice(wide)), rng.choice("abcdeéüß"), rng.choice(".,.,'s t"), rng.choice(" \n\t\x0b\x1c")]) for _ in range(rng.randint(1, 12))]
        texts.append("".join(parts))
    encoder = packing.WordEncoder(VOCABULARY)
    ids, at = encoder.encode(pa.array(texts), 2)
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2], text


def test_words_of_most_chunks_stay_in_the_cache(monkeypatch):
    """A full cache was emptied, so frequent words were cut again and again, and words once for every sign behind them."""
    encoder, learnt = packing.WordEncoder(VOCABULARY, 200), Counter()
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda words: learnt.update(words) or learn(words))
    letters = [chr(97 + i) + chr(97 + j) for i in range(26) for j in range(26)]
    often = ["von" + x for x in letters[:40]]
    for k in range(20):
        texts = [" ".join(often), " ".join(w + "!." for w in often), " ".join(f"zu{letters[k]}{x}" for x in letters[:60]), "y" * 50]
        ids, at = encoder.encode(pa.array(texts), 2)
        for i, text in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2], text
    assert {learnt[w] for w in often} == {1} and not any(w.endswith(".") and len(w) > 2 for w in learnt)
    assert "y" * 50 not in encoder.rows and len(encoder.rows) == len(encoder.kept) == len(encoder.uses) <= 200 + 100


def test_ids_of_signs_behind_words():
    rng = random.Random(5)
    signs = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    ends = ["<|endoftext|>", "<|startoftext|>", "|>", "'s", "'ll", "'", "\u0301", "\u0338", "\u00a0", "\u037e", "\ufe63"]
    texts = ["<|endoftext|>!!", "a<|endoftext|>b!!", "a<|endoftext|", "it's'", "'s's''", "x=\u0338", "1.2.3.4!?", "a.b@c.de,###"]
    for _ in range(4000):
        parts = [rng.choice(["ab", "é", "7", "İ", "ß", "я", " ", "s", *ends, *signs]) for _ in range(rng.randint(1, 8))]
        texts.append("".join(parts))
    encoder = packing.WordEncoder(VOCABULARY, 500)
    for low in range(0, len(texts), 400):
        ids, at = encoder.encode(pa.array(texts[low : low + 400]), 2)
        for i, text in enumerate(texts[low : low + 400]):
            assert ids[at[i] : at[i + 1]].tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2], text


def test_the_pool_is_emptied_before_each_chunk_goes(monkeypatch):
    """Else a worker over 30 batches of 10 MB held 291 MB, of which the pool could return 138."""
    released = []

    class Pool:
        def release_unused(self):
            released.append(1)

    monkeypatch.setattr(packing.pa, "default_memory_pool", Pool)
    batch = pa.RecordBatch.from_arrays([pa.array(range(90)), pa.array(["word " * 50] * 90)], ["doc_id", "text"])
    chunks, rows = 0, 0
    for out in packing.encoded(iter([batch, batch]), packing.WordEncoder(VOCABULARY).encode, 0, 2, 5000):
        chunks, rows = chunks + 1, rows + out.num_rows
        assert len(released) == chunks
    assert rows == 180 and chunks == 10


def test_batches_are_bounded_by_bytes(spark):
    texts = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 200000) AS text")
    with small_batches(spark, 4000, packing.BATCH):
        sizes = texts.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in bs), "n long").collect()
    assert len(sizes) > 2 and max(r.n for r in sizes) < 10 << 20


@pytest.mark.parametrize("length", [64, 4096])
@pytest.mark.parametrize("partitions", [1, 7])
def test_pieces_tile_documents_and_sequences(spark, length, partitions):
    docs = documents(spark, ODD).repartition(partitions)
    tokenizer = packing.WordEncoder(VOCABULARY).tokenizer
    want = Counter((r.doc_id, tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2])) for r in docs.collect())
    pieces = packing.pack(docs, VOCABULARY, length).collect()
    assert sum(len(p.ids) for p in pieces) == 4 * sum(n * len(ids) for (_, ids), n in want.items())
    sequences = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.length > 0 and p.start + p.length <= p.doc_tokens
        sequences[p.sequence_id].append(p)
    assert sorted(sequences) == list(range(len(sequences)))
    short = 0
    for found in sequences.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
        short += at < length
    assert short <= 1  # concatenated and cut: only the last is short
    rebuilt, open_ = Counter(), defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        rows = open_[p.doc_id]
        mine = next((r for r in rows if r[0] == p.start and r[1] == p.doc_tokens), None) if p.start else None
        if mine is None:
            mine = [0, p.doc_tokens, b""]
            rows.append(mine)
        mine[0] += p.length
        mine[2] += p.ids
        if mine[0] == mine[1]:
            rebuilt[(p.doc_id, tuple(np.frombuffer(mine[2], "<u4").tolist()))] += 1
            rows.remove(mine)
    assert rebuilt == want


def test_packing_nothing(spark):
    assert packing.pack(no_documents(spark), VOCABULARY).count() == 0


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 24, 1000])
def test_jump_is_the_published_walk(n):
    keys = np.random.default_rng(3).integers(0, 2**64, 2000, dtype=np.uint64)
    assert shards.jump(keys, n).tolist() == [plain_jump(int(k), n) for k in keys]
    grown = shards.jump(keys, n + 1)
    assert np.all((grown == shards.jump(keys, n)) | (grown == n))


def test_shards_keep_rows_and_number_them(spark):
    docs = documents(spark)
    rows = shards.shard_rows(docs, 5).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 5) and r["a.b"] is None
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(5))
    homes = defaultdict(set)
    for r in rows:
        homes[r.doc_id].add(r.shard)
    assert all(len(x) == 1 for x in homes.values())
    with pytest.raises(ValueError):
        shards.shard_rows(docs, 0)
    assert shards.shard_rows(no_documents(spark), 3).count() == 0


def test_shard_files_hold_all_rows(spark, tmp_path):
    docs = documents(spark).select("doc_id", "text")
    shards.write_shards(docs, str(tmp_path / "out"), 4)
    assert Counter(r.doc_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == Counter(r.doc_id for r in docs.collect())


def wanted(docs):
    size = defaultdict(int)
    for r in docs:
        size[r.source] += len(words(r.text))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(size.values()), set()
    while True:
        left = total - sum(3 * size[s] for s in capped)
        level = left / max(1, sum(weight[s] for s in names if s not in capped))
        new = {s for s in names if s not in capped and weight[s] * level > 3 * size[s]}
        if not new:
            return size, {s: 3.0 * size[s] if s in capped else weight[s] * level for s in names}
        capped |= new


def test_mix_comes_near_its_targets(spark):
    docs = documents(spark)
    size, target = wanted(docs.collect())
    sources = {r.doc_id: r.source for r in docs.collect()}
    rows = mixing.mix_plan(docs, block=4).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert len(rows) == docs.count()
    taken = defaultdict(int)
    for r in rows:
        s = sources[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s]) and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 8 for s in size)
    again = mixing.mix_plan(docs.repartition(5), block=4).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert Counter(rows) == Counter(again)


def test_mixed_rows_hold_the_words_taken(spark):
    docs = documents(spark)
    plan = mixing.mix_plan(docs, block=4).collect()
    out = mixing.mixed(docs, block=4, shards=3).collect()
    got, want = Counter(), Counter()
    for r in out:
        got[r.doc_id] += len(words(r.text))
        assert r.n_chars is None or r.n_chars == len(r.text)
    for r in plan:
        want[r.doc_id] += r.taken
    assert got == +want
    shares = defaultdict(Counter)
    for r in out:
        shares[r.mix_shard][r.source] += len(words(r.text))
    assert set(shares) <= {0, 1, 2}
    assert [c for c in mixing.mixed(docs).columns if c != "mix_shard"] == docs.columns


def test_quotas_are_sainte_lague(spark):
    sizes = {"a": 1000, "b": 700, "c": 90, "d": 30, "e": 3}
    table = spark.createDataFrame([(False, s, n) for s, n in sizes.items()], "_null boolean, _source string, source_size long")
    rows = mixing.apportion(mixing.targets(mixing.weighted(table)), 3, 4).collect()
    target, most = {r._source: r.target for r in rows}, {r._source: r.source_size * 3 // 4 for r in rows}
    blocks = sum(sizes.values()) // 4
    won, quotas = Counter(), []
    for i in range(blocks):
        best = max((s for s in sorted(sizes) if won[s] < most[s]), key=lambda s: (target[s] / (2 * won[s] + 1), -ord(s)))
        won[best] += 1
        if i + 1 in {int(blocks * (j + 1) / 3) for j in range(3)}:
            quotas.append(dict(won))
    assert {r._source: r._quota for r in rows} == {s: [q.get(s, 0) for q in quotas] for s in sizes}


def test_mixing_nothing(spark):
    assert mixing.mix_plan(no_documents(spark)).count() == 0
    assert mixing.mixed(no_documents(spark)).count() == 0
    blank = documents(spark).where("text is null or doc_id = 49")
    assert {r.taken for r in mixing.mix_plan(blank).collect()} == {0}



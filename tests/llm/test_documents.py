"""Operators over documents against brute force; nulls, empty and long texts, ties, repeats."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilo.llm import common, langid, mixing, near_dedup, packing, quality, secret_scan, sharding, token_files, tokens
from vigilo.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------ language ID

def test_language_id(corpus, rows, empty):
    model = langid.train(corpus, draw=F.xxhash64("doc_id", "text"))
    assert model.languages == ["xx", "yy"] and 0 < (np.abs(model.weights).sum(axis=1) > 0).sum() < 1 << 14
    out = langid.predict(corpus, model).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.lang and len(r.text) > 40:
            assert r.lang_pred == r.lang and r.score > 0.8
        else:
            assert 0 <= r.score <= 1
    assert out[0].asDict().keys() >= {"shard", "kept", "node"} and out[0]["node"] == 7
    kept = {r.doc_id for r in langid.accepted(corpus, model).collect()}
    assert {400, 401, 402, 403}.isdisjoint(kept) and kept >= {r.doc_id for r in rows if r.text and len(r.text) > 60}
    assert langid.predict(empty, model).count() == 0
    none = langid.train(empty)
    assert none.languages == [] and langid.predict(corpus, none).where("lang_pred != 'und'").count() == 0
    assert langid.accepted(corpus, none).where("doc_id in (400, 402, 403)").count() == 0


def test_ftrl_is_sparse_and_temperature_calibrates():
    r = np.random.default_rng(0)
    rows = [(np.array([y, 2 + int(r.integers(50))]), np.array([0.7, 0.7])) for y in r.integers(0, 2, 400)]
    labels = np.array([at[0] for at, _ in rows])
    w = langid.fit_ftrl(rows, labels, 2, 52)
    assert w[0].argmax() == 0 and w[1].argmax() == 1 and np.abs(w[2:]).max() < np.abs(w[:2]).max()
    scores = np.array([[4.0, 0.0]] * 100)      # overconfident: right in three of four
    t = langid.fit_temperature(scores, np.array([0] * 75 + [1] * 25))
    assert abs(1 / (1 + np.exp(-4 / t)) - 0.75) < 0.01


# ------------------------------------------------------------------ sharding

@pytest.mark.parametrize("n", [1, 2, 3, 17, 40, 1000])
def test_permutation(n):
    places = sharding.permute(np.arange(n), n, seed=3)
    assert sorted(places.tolist()) == list(range(n))
    assert (sharding.permute(places, n, seed=3, inverse=True) == np.arange(n)).all()
    for row in range(0, n, 7):
        assert sharding.row_at(*sharding.shard_and_slot(row, n, 4, 3), n, 4, 3) == row


def test_shards(corpus, rows, empty):
    out = sharding.assign_shards(corpus, ["doc_id", "text"], 7, seed=5).collect()
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert len(out) == len(rows) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    order = sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    got = Counter((r.doc_id, r.shard, r.slot) for r in out)
    want = Counter((r.doc_id, *sharding.shard_and_slot(k, len(out), 7, 5)) for k, r in enumerate(order))
    assert got == want
    assert sharding.assign_shards(empty, ["doc_id"], 7).count() == 0


# ------------------------------------------------------------------ secret scan

def _base(text):
    out = [(m.start(), 0, m.end()) for m in secret_scan.ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secret_scan(corpus, rows, empty):
    field = secret_scan.train(corpus, draw=F.xxhash64("doc_id"))
    out = secret_scan.scan(corpus, field).collect()
    texts = {r.doc_id: r.text or "" for r in rows}
    assert len(out) == len(rows)
    for r in out:
        base = _base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("crf")) == base
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex) for r in out if r.doc_id in (500, 501, 502)} == {
        500: (1, 0, 0), 501: (0, 1, 1), 502: (2, 0, 1)}
    assert secret_scan.scan(empty, field).count() == 0 and secret_scan.train(empty) is None
    clean = {r.doc_id: r for r in secret_scan.masked(corpus, field).collect()}
    assert clean[500].text.startswith('key  password = "[SECRET]" end') and clean[500].n_chars == len(clean[500].text)
    assert clean[400].text is None and clean[3].text == texts[3] and not _base(clean[501].text)


def test_field_learns_context_and_shape(spark):
    """Trained on assigned secrets, the field also tags one whose key the patterns don't know."""
    import random
    r = random.Random(2)
    chars = "abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"
    noise = lambda n: "".join(r.choice(chars) for _ in range(n))
    word = lambda: "".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    train = [(i, f'{prose(20)} {r.choice(["token", "secret"])} = "{noise(32)}" {prose(20)}') for i in range(120)]
    train += [(1000 + i, prose(60)) for i in range(120)]
    field = secret_scan.train(spark.createDataFrame(train, "doc_id long, text string"))
    text = f'{prose(12)} credential = "{noise(32)}" {prose(12)}'
    tests = spark.createDataFrame([(1, text), (2, prose(200))], "doc_id long, text string")
    found = {x.doc_id: x for x in secret_scan.scan(tests, field).collect()}
    value = re.search('"(.*)"', text)
    assert found[1].n_assign == 0 and f"crf:{value.start(1)}:{value.end(1)}" in found[1].spans
    assert found[2].spans == ""


def test_viterbi_is_exact():
    r = np.random.default_rng(1)
    for n in (1, 2, 5):
        scores, turns = r.normal(size=(n, 3)), r.normal(size=(3, 3))
        paths = np.indices((3,) * n).reshape(n, -1).T
        def value(p):
            steps = [0, *p, 0]
            return sum(scores[t, y] for t, y in enumerate(p)) + sum(turns[a, b] for a, b in zip(steps, steps[1:]))
        assert value(secret_scan.viterbi(scores, turns)) == pytest.approx(max(map(value, paths)))


# ------------------------------------------------------------------ near duplicates

def _sets(rows, width):
    out = []
    for r in rows:
        w = [x.lower() if x.isascii() else "".join(c.lower() if c.isascii() else c for c in x) for x in WORD.findall(r.text or "")]
        out.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()})
    return out


def _groups(rows, sets):
    """Least id reachable, by comparing everything with everything."""
    root = list(range(len(rows)))
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r.doc_id)
    return [min((x for x in least[find(i)] if x is not None), default=None) for i in range(len(rows))]


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(corpus, rows, empty, width):
    sets = _sets(rows, width)
    want = Counter((r.doc_id, len(s), g, r.doc_id == g) for r, s, g in zip(rows, sets, _groups(rows, sets)))
    got = near_dedup.near_duplicates(corpus, width=width).drop("text_hash").collect()
    assert Counter(tuple(r) for r in got) == want
    assert near_dedup.near_duplicates(empty).count() == 0


def test_loose_groups_are_whole(spark):
    """Chains of texts in which neighbours are similar and ends are not, and a crowd around
    one passage: no hub reaches all of them."""
    import random
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(120)]
    texts, now = [], base
    for _ in range(40):
        now = now[3:] + [word() for _ in range(3)]
        texts.append(" ".join(now))
    for _ in range(400):
        k = r.randrange(5, 18)
        at = r.randrange(120 - k)
        texts.append(" ".join(base[:at] + [word() for _ in range(k)] + base[at + k:]))
    rows = [type("Row", (), {"doc_id": i, "text": t}) for i, t in enumerate(texts)]
    want = _groups(rows, _sets(rows, 4))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in near_dedup.near_duplicates(df, width=4).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert len(set(want)) < 300


def test_full_sets_with_null_ids(spark, monkeypatch):
    """As many texts are read for full sets as are wanted, where all ids are null."""
    import random
    r = random.Random(3)
    seen, real = spark.sparkContext.accumulator(0), near_dedup._full_sets

    def counted(width):
        def run(batches):
            for batch in batches:
                seen.add(len(batch))
                yield from real(width)([batch])
        return run
    monkeypatch.setattr(near_dedup, "_full_sets", counted)
    texts = []
    for _ in range(30):
        words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(80)]
        texts += [" ".join(words), " ".join(words[:-1] + ["changed"])]
    df = spark.createDataFrame([(None, t) for t in texts + texts[:1] * 50], "doc_id long, text string").repartition(3)
    assert near_dedup.near_duplicates(df, width=4).count() == len(texts) + 50
    assert seen.value == len(texts)


def test_keep_one(corpus, rows):
    out = near_dedup.keep_one(corpus).collect()
    ids = Counter(r.doc_id for r in out)
    assert ids[7] == 1 and ids[5] == 1 and not any(ids[300 + i] for i in range(30)) and ids[400] == ids[401] == 1
    assert out[0].asDict().keys() == rows[0].asDict().keys()
    sets = _sets(rows, 5)
    assert set(ids) == {r.doc_id for r, g in zip(rows, _groups(rows, sets)) if r.doc_id == g}


def test_keep_one_with_null_and_repeated_ids(spark):
    import random

    import corpus_pipeline
    r = random.Random(4)

    def group():
        words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(80)]
        return " ".join(words), " ".join(words[:-1] + ["changed"])
    nulls, ids, other, mixed, single = group(), group(), group(), group(), group()[0]
    rows = ([(None, t) for t in nulls] + [(7, t) for t in ids] + [(7, t) for t in other] + [(None, mixed[0]), (9, mixed[1])]
            + [(None, single)] * 3 + [(None, " "), (None, None), (7, "")])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = corpus_pipeline.near_duplicates(spark, df, "").collect()
    assert Counter(x.text for x in out if x.text in nulls).total() == 1
    assert Counter(x.text for x in out if x.text in ids).total() == 1
    assert Counter(x.text for x in out if x.text in other).total() == 1
    assert [x.doc_id for x in out if x.text in mixed] == [9]
    assert sum(x.text == single for x in out) == 1 and len(out) == 8


# ------------------------------------------------------------------ tokens

@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_equals_library(rows, name, spaced):
    import pyarrow as pa
    from hypothesis import given, settings
    from hypothesis import strategies as st
    encoder = tokens.Encoder(tokens.tokenizer_path(name), spaced)

    def check(texts):
        for lo, hi, ids, at in encoder.encode(pa.array(texts, pa.string())):
            for k in range(lo, hi):
                want = encoder.tokenizer.encode(texts[k] or "", add_special_tokens=False).ids
                assert ids[at[k - lo]: at[k - lo + 1]].tolist() == want, texts[k]

    check([r.text for r in rows if not r.text or len(r.text) < 5000])
    piece = st.sampled_from(["'s", "'", "'re", "'LL", " ", "  ", "\n", "\t", "ab", "É", "ß", "12", "²", "!", "日", "\x00", "İ",
                             "<|endoftext|>", " x", "́", " ", "’"])

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.lists(piece, max_size=12).map("".join), min_size=1, max_size=4))
    def fuzz(texts):
        check(texts)
    fuzz()


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_added_tokens_as_the_file_has_them(spark, name, spaced):
    import pyarrow as pa
    from tokenizers import Tokenizer
    path = tokens.tokenizer_path(name)
    library = Tokenizer.from_file(path)     # as the file is, nothing switched
    texts = ["end <|endoftext|> start", "plain text", "<|endoftext|>", "a<|startoftext|><|endoftext|>b", "", None,
             "x <|endof", "text|> y", "A <|ENDOFTEXT|> b", "\u65e5 <|endoftext|> \u0000", " <|endoftext|><|endoftext|>  it's", "tail"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    end = library.token_to_id("<|endoftext|>")
    assert end in want[0] and end not in want[8]
    (lo, hi, ids, at), = tokens.Encoder(path, spaced).encode(pa.array(texts, pa.string()))
    assert (lo, hi) == (0, len(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    if spaced:
        out = token_files.read_tokens(*token_files.write_tokens(docs, path)).collect()
        assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in out} == {
            k: (len(x) + 1, zlib.crc32(np.array(x + [0], "<u4"))) for k, x in enumerate(want)}


@pytest.mark.parametrize("ends", [[], [1], [1, 1, 1], [5, 9, 9, 4000], list(range(3, 3000, 7))])
def test_elias_fano(ends):
    index = token_files.EliasFano.of(np.array(ends, np.int64))
    assert index.all().tolist() == ends and [index.select(i) for i in range(len(ends))] == ends
    data = token_files.pack_segment(np.arange(ends[-1] if ends else 0), np.array(ends, np.int64), np.arange(len(ends)),
                                    np.zeros(len(ends), bool), 2)
    segment = token_files.Segment(data)
    assert segment.ends.all().tolist() == ends
    if len(ends) > 100:
        assert len(index.low) + len(index.high) + 8 * len(index.samples) < 1.5 * len(ends) * 8 / 8


def test_token_files_round_trip(corpus, rows, empty, monkeypatch):
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    folder, manifest = token_files.write_tokens(corpus, path)
    out = token_files.read_tokens(folder, manifest).collect()
    library = tokens.Encoder(path, True).tokenizer
    want = Counter()
    for r in rows:
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        want[r.doc_id, len(ids), zlib.crc32(ids)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == want
    out.sort(key=lambda r: r.start)
    assert [r.start for r in out] == np.cumsum([0] + [r.n_tokens for r in out])[:-1].tolist()
    ids = [r.doc_id for r in out]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    assert token_files.read_tokens(*token_files.write_tokens(empty, path)).count() == 0


# ------------------------------------------------------------------ mixing

def _targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        left = sum(weight[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else rest * weight[s] / left for s in names}
        over = {s for s in names if s not in full and out[s] > most * sizes[s] + 1e-9}
        if not over:
            return out
        full |= over


def test_mix(corpus, rows, empty):
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    targets = _targets(sizes)
    out = mixing.plan_mix(corpus).collect()
    assert len(out) == len(rows) and out == mixing.plan_mix(corpus.repartition(5)).orderBy("doc_id").collect() or \
        Counter(map(tuple, out)) == Counter(map(tuple, mixing.plan_mix(corpus.repartition(5)).collect()))
    source, text = {r.doc_id: r.source for r in rows}, {r.doc_id: r.text for r in rows}
    taken, largest = Counter(), Counter()
    for r in out:
        s = source[r.doc_id]
        assert r.size == len(WORD.findall(text[r.doc_id] or "")) and r.source_size == sizes[s]
        assert r.target == pytest.approx(targets[s]) and 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    assert all(abs(taken[s] - targets[s]) <= 2 * largest[s] for s in sizes)
    mixed = Counter(r.doc_id for r in mixing.mixed(corpus).collect())
    want = Counter()
    for r in out:
        want[r.doc_id] += r.copies
    assert mixed == +want
    assert mixing.plan_mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_mix_follows_quality(spark):
    """Within a source, better documents are taken more often."""
    docs = [(i, "w " * 10, "a", 1.0 if i % 2 else 0.1) for i in range(4000)] + [(9000 + i, "w " * 10, "b", 1.0) for i in range(16000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, q double")
    out = mixing.plan_mix(df, weight=F.col("q")).where("doc_id >= 9000 or doc_id < 4000").collect()
    b = [r for r in out if r.doc_id >= 9000]
    assert 0.3 < sum(r.copies for r in b) / len(b) < 0.9
    low = spark.createDataFrame([(i, "w " * 10, "b", 1.0 if i % 2 else 0.1) for i in range(16000)] +
                                [(20000 + i, "w " * 10, "a", 1.0) for i in range(4000)], df.schema)
    picked = Counter(r.doc_id % 2 for r in mixing.plan_mix(low, weight=F.col("q")).collect() if r.doc_id < 16000 and r.copies)
    assert picked[1] > 2 * picked[0]


def test_mix_is_native(corpus):
    plan = mixing.mixed(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ------------------------------------------------------------------ quality

def test_label_model_finds_the_bad_labeller():
    r = np.random.default_rng(4)
    truth = r.random(4000) < 0.7
    votes = np.where(r.random((4000, len(quality.LABELLERS))) < 0.85, truth[:, None], ~truth[:, None]).astype(int)
    votes[:, 2] = r.integers(0, 2, 4000)                       # a coin
    votes[r.random(votes.shape) < 0.2] = quality.NONE
    codes, counts = np.unique(quality._code(votes), return_counts=True)
    labels = quality.estimate(codes, counts.astype(float))
    accuracy = labels.accuracies()
    assert accuracy.argmin() == 2 and accuracy[2] < 0.65 and np.delete(accuracy, 2).min() > 0.8
    assert abs(labels.prior - 0.7) < 0.05
    assert ((labels.posterior[quality._code(votes)] > 0.5) == truth).mean() > 0.93


def test_quality_scores(spark, corpus, rows, empty):
    bad = [(1000 + i, " ".join(w + "###" for w in r.text.split()[:40]).upper()) for i, r in enumerate(rows[:60]) if len(WORD.findall(r.text or "")) >= 20]
    docs = corpus.select("doc_id", "text").unionByName(spark.createDataFrame(bad, "doc_id long, text string"))
    scorer = quality.train(docs, draw=F.xxhash64("doc_id"))
    out = quality.score(docs.withColumn("votes", F.lit(1)), scorer).collect()
    assert len(out) == len(rows) + len(bad)
    for r in out:
        if not WORD.findall(r.text or ""):
            assert (r.score, r.posterior, r.kept) == (0.0, 0.0, False)
        elif r.doc_id is not None and r.doc_id >= 1000:
            assert not r.kept
        elif r.doc_id is not None and r.doc_id < 300:
            assert r.kept and 0 <= r.score <= 1
    assert quality.train(empty) is None and quality.score(empty, None).count() == 0
    assert quality.score(corpus, None).where("kept").count() == 0


# ------------------------------------------------------------------ packing

def test_packing(corpus, rows, empty):
    path = tokens.tokenizer_path("word_bpe_49k.json")
    out = packing.pack(corpus, path, with_ids=True).collect()
    library = tokens.Encoder(path, False).tokenizer
    whole = defaultdict(list)
    for r in rows:
        whole[r.doc_id].append(np.array(library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4"))
    by, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        by[r.doc_id].append((r.start, r.length, r.doc_tokens, r.ids_crc32, r.ids))
        sequences[r.sequence_id].append((r.offset, r.length, r.window, r.step_group))
    for doc_id, pieces in by.items():
        if len(whole[doc_id]) == 1:
            ids, at = whole[doc_id][0], 0
            for start, length, n, crc, own in sorted(pieces, key=lambda p: p[0]):
                assert start == at and n == len(ids) and own == ids[at: at + length].tolist()
                assert crc == zlib.crc32(ids[at: at + length])
                at += length
            assert at == len(ids)
    assert set(by) == set(whole)
    assert sum(r.length for r in out) == sum(len(x) for xs in whole.values() for x in xs)
    groups = defaultdict(set)
    for pieces in sequences.values():
        at = 0
        for offset, length, window, group in sorted(pieces):
            assert offset == at
            at += length
        assert at == window <= 4096 and window & (window - 1) == 0
        groups[group].add(window)
    assert all(len(w) == 1 for w in groups.values())
    assert packing.pack(empty, path).count() == 0


def test_packer_fills_long_windows_from_shorter_tiers():
    packer = packing.Packer()
    for i, n in enumerate((4000, 60, 30, 6, 300, 212)):
        assert packer.add(i, n) == []
    windows = list(packer.windows())
    assert windows[0] == (3, [(4000, 0, 0), (60, 0, 1), (30, 0, 2), (6, 0, 3)])
    assert windows[1] == (0, [(300, 0, 4), (212, 0, 5)]) and packer.held == 0
    assert packer.add(9, 2 * 4096 + 3) == [[(4096, 0, 9)], [(4096, 4096, 9)]]
    assert list(packer.rest()) == [(2, [(2, 8192, 9)]), (1, [(1, 8194, 9)])]


def test_unknown_script_is_rejected_and_short_texts_stay(spark):
    import random
    r = random.Random(8)
    sets = {"aa": "abcdefg", "bb": "hijklmn", "cc": "opqrstu", "dd": "vwxyzäö"}
    text = lambda lang, n: " ".join("".join(r.choice(sets[lang]) for _ in range(r.randint(2, 6))) for _ in range(n))
    docs = [(i, text(lang, r.randint(10, 60)), lang) for i in range(400) for lang in [list(sets)[i % 4]]]
    more = [(1000, "漢字" * 80, None), (1001, text("aa", 1), None), (1002, text("aa", 20) + " " + text("cc", 20), None)]
    df = spark.createDataFrame(docs + more, "doc_id long, text string, lang string")
    model = langid.train(df)
    kept = {x.doc_id for x in langid.accepted(df, model).collect()}
    assert kept == {i for i, _, _ in docs} | {1001, 1002}


# ------------------------------------------------------------------ hot rows, bounded samples

def _taken(out):
    taken = Counter()
    for r in out:
        taken[r.target] += r.taken
    return taken


def test_mix_cuts_copies_one_by_one(spark, monkeypatch):
    """A third of a source is one repeated row with a null id; the budget ends wherever."""
    monkeypatch.setattr(mixing, "CELL_ROWS", 50)
    hot = "again and " * 50
    docs = [(None, hot, "a")] * 700 + [(i, "w " * (5 + i % 40), "a") for i in range(1400)] + [(5000 + i, "x " * 30, "b") for i in range(4000)]
    for seed in range(3):
        df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
        out = mixing.plan_mix(df, seed=seed).collect()
        assert len(out) == len(docs)
        for target, words in _taken(out).items():
            assert abs(words - target) <= 100
        times = Counter(r.copies for r in out if r.doc_id is None)
        assert max(times) - min(times) <= 1
        mixed = Counter(r.text for r in mixing.mixed(df, seed=seed).collect())
        assert sum(len(t.split()) * n for t, n in mixed.items()) == sum(r.taken for r in out)


def test_mix_ranges_end_small_for_low_weights(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 60)
    sizes, sorted_rows = [], mixing._within

    def noted(narrow, ranges):
        sizes.append(max([r["rows"] for r in ranges.collect()], default=0))
        return sorted_rows(narrow, ranges)
    monkeypatch.setattr(mixing, "_within", noted)
    df = spark.createDataFrame([(i, "w " * 10, "b") for i in range(9000)] + [(20000 + i, "w " * 10, "a") for i in range(2000)],
                               "doc_id long, text string, source string")
    out = mixing.plan_mix(df, weight=F.lit(0.05)).collect()
    assert sizes[0] >= 2000 and sizes[-1] <= 60
    for target, words in _taken(out).items():
        assert abs(words - target) <= 10


def test_samples_are_bounded_with_null_ids_and_repeated_rows(spark, monkeypatch):
    """50,000 rows without ids, half of them one text."""
    seen = []
    bounded = common.bounded_sample

    def noted(rows, draw, most, scratch):
        out = bounded(rows, draw, most, scratch)
        seen.append((out.count(), most))
        return out
    monkeypatch.setattr(common, "bounded_sample", noted)
    words = F.concat_ws(" ", *[F.concat(F.lit(f"word{k}x"), (F.col("id") * (k + 3) % 997).cast("string")) for k in range(8)],
                        F.lit("password = Zx81abcDEF99"))
    df = (spark.range(50_000).withColumn("text", F.when(F.col("id") % 2 == 0, F.lit("the same password = Zx81abcDEF99 again")).otherwise(words))
          .select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit("xx").alias("lang")))
    draw = F.xxhash64("doc_id", "text")
    langid.train(df, draw=draw)
    quality.train(df, draw=draw)
    secret_scan.train(df, draw=draw)
    assert [m for _, m in seen] == [2 * langid.SAMPLE_ALL, 2 * quality.SAMPLE, 4 * secret_scan.SAMPLE]
    assert all(n <= 1.3 * most for (n, _), most in zip(seen, (langid.SAMPLE, quality.SAMPLE, 2 * secret_scan.SAMPLE)))


def test_bounded_sample_holds_for_any_draws(spark):
    rows = spark.range(5000).withColumn("draw", F.col("id") % 900)
    out = common.bounded_sample(rows, "draw", 100, Scratch(spark, "sample")).collect()
    assert sorted(r.draw for r in out) == list(range(100))
    assert common.bounded_sample(rows, "draw", 900, Scratch(spark, "sample")).count() == 900
    assert common.bounded_sample(rows.limit(0), "draw", 5, Scratch(spark, "sample")).count() == 0


def test_hot_equal_rows_are_spread(spark):
    """A third of the rows equal: no task has many more than its share, slots stay gapless."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("doc_id"))
    scratch = Scratch(spark, "numbers")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered, n = common.with_row_number(df, ["doc_id"], "number", scratch)
        most = max(r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert n == 30_000 and sorted(r.number for r in numbered.collect()) == list(range(30_000))
    stored = spark.read.parquet(f"{scratch.root}/1-ordered")
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 0.45 * 30_000 and most


def test_token_files_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_DOCS", 50)
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    folder, manifest = token_files.write_tokens(df, tokens.tokenizer_path("byte_bpe_50k.json"))
    read = token_files.read_tokens(folder, manifest)
    tasks = {r[0] for r in read.select(F.spark_partition_id()).distinct().collect()}
    assert manifest.count() >= 40 and len(tasks) >= 15 and read.count() == 2000

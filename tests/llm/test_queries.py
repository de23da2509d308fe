"""Every registered query over the small tables: columns, types, and what its contract fixes."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from sample_data import SMALL_SF
from vigilo.llm import queries

COLUMNS = {
    "op1": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op2": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op3": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op4": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op5": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op6": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op7": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op8": "doc_id bigint, score double, kept boolean",
    "op9": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op10": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op11": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op12": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    "op13": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SMALL_SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def results(spark):
    held = {}

    def of(name):
        key = next(k for k in queries.QUERIES if k.startswith(f"{name}_"))
        if name not in held:
            df = queries.QUERIES[key](spark, SMALL_SF)
            want = [tuple(c.split(" ")) for c in COLUMNS[name].split(", ")]
            assert [c for c in df.dtypes if c in want] == want, df.dtypes
            held[name] = df.collect()
        return held[name]
    return of


@pytest.mark.parametrize("name", [n for n in COLUMNS if n not in ("op6", "op9", "op10", "op13")])
def test_one_row_per_document(results, texts, name):
    assert sorted(r.doc_id for r in results(name)) == sorted(texts)


def test_languages(results, texts):
    langs = {r.lang for r in texts.values() if r.lang}
    for r in results("op1"):
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.lang_pred in langs | {"und"} and 0 <= r.score <= 1
    sure = [r for r in results("op1") if r.held_out and texts[r.doc_id].lang]
    assert sum(r.lang_pred == texts[r.doc_id].lang for r in sure) >= 0.95 * len(sure)


def test_shards(results, texts):
    slots = defaultdict(list)
    for r in results("op2"):
        raw = (texts[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(40)]
    assert max(sizes) - min(sizes) <= 1


def test_base_spans(results, texts):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for r in results("op3"):
        text = texts[r.doc_id].text or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
        kinds = Counter(k for _, k, _ in found)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds[0], kinds[1], kinds[2])
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(",")) or not joined


def test_token_starts(results):
    at = 0
    for r in sorted(results("op5"), key=lambda r: r.doc_id):
        assert r.start == at and r.n_tokens >= 1
        at += r.n_tokens


def test_mix(results, texts):
    taken, target, largest = Counter(), {}, Counter()
    for r in results("op7"):
        source = texts[r.doc_id].source
        assert r.taken <= 3 * r.size
        taken[source] += r.taken
        target[source] = r.target
        largest[source] = max(largest[source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)


def test_packed_pieces(results):
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in results("op9"):
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append((r.start, r.length, r.doc_tokens))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    for own in documents.values():
        at = 0
        for start, length, total in sorted(own):
            assert start == at
            at += length
        assert at == total


def test_vectors(spark, results):
    ids = [r.vec_id for r in spark.read.parquet(f"{SMALL_SF}/embeddings.parquet").select("vec_id").collect()]
    assert sorted(r.vec_id for r in results("op6")) == sorted(r.vec_id for r in results("op13")) == sorted(ids)
    ranks = defaultdict(list)
    for r in results("op10"):
        ranks[r.query_id].append(r.rank)
    assert set(ranks) == {i for i in ids if i % 100 == 0} and all(sorted(x) == list(range(1, 11)) for x in ranks.values())

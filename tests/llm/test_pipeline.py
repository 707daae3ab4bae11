"""The pipeline's stages against plain versions on the smallest tables, and the registered queries."""

import base64
import ctypes
import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

import corpus_pipeline
from quillstone.llm import QUERIES, SQL, bpe, quality
from quillstone.llm.common import read_table, written
from quillstone.llm.pairs import NONE, PairTable
from tests.llm.test_near_copies import plain_kept as near_kept
from tests.llm.test_operators import WORD, plain_measures, plain_secrets


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = read_table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), "test-stage")
        out.append(docs)
    return out


def plain_kept(rows):
    """Ids that the quality rules keep, from exact group histograms with the same bins."""
    measured = {r.doc_id: plain_measures(r.text) for r in rows}
    lines = {r.doc_id: max(1, sum(bool(WORD.search(x)) for x in (r.text or "").split("\n"))) for r in rows}
    rates = {i: {"symbol_rate": m[2] * 10000 // max(m[1], 1), "word_length": m[1] * 100 // max(m[0], 1), "dup_line_rate": m[3] * 1000 // lines[i]} for i, m in measured.items()}
    groups = defaultdict(list)
    for r in rows:
        if measured[r.doc_id][0] >= 50:
            for g in ((r.lang, r.source), (r.lang,), ()):
                groups[g].append(rates[r.doc_id])

    def quantile(g, name, q):
        values = sorted(v[name] - v[name] % (1 << max(v[name].bit_length() - 8, 0)) for v in groups[g])
        return values[max(-(-int(len(values) * q * 1000) // 1000), 1) - 1]

    keep = set()
    for r in rows:
        n, _, _, _, repeated = measured[r.doc_id]
        if n < 50 or 100 * repeated > 50 * n:
            continue
        g = next((g for g in ((r.lang, r.source), (r.lang,)) if len(groups[g]) >= quality.MIN_GROUP), ())
        fine = True
        for name, margin in quality.MARGINS.items():
            mid, low = quantile(g, name, 0.5), quantile(g, name, 0.05)
            wide = 6 * (mid - low)
            v = rates[r.doc_id][name]
            fine &= abs(v - mid) <= max(wide, margin) if name == "word_length" else v <= mid + wide + margin
        if fine:
            keep.add(r.doc_id)
    return keep


def test_quality_near_dedup_and_secrets(spark, sf_dir, stages):
    rows = read_table(spark, sf_dir, "documents").collect()
    kept = plain_kept(rows)
    assert Counter(r.doc_id for r in stages[0].collect()) == Counter(kept)
    left = sorted((r for r in rows if r.doc_id in kept), key=lambda r: r.doc_id)
    ids = near_kept([(r.doc_id, r.text) for r in left])  # the stage's rule: 5-word shingles, similarity of 0.8
    one = {r.doc_id: r for r in left if r.doc_id in ids}
    assert Counter(r.doc_id for r in stages[1].collect()) == Counter(one.keys())
    for r in stages[2].collect():
        before, out, at = one[r.doc_id].text, "", 0
        for a, _, e in plain_secrets(before)[1]:
            if a >= at:
                out += before[at:a] + "[SECRET]"
            at = max(at, e)
        assert r.text == out + before[at:]
        assert r.n_chars == (one[r.doc_id].n_chars if r.text == before else len(r.text))
    for s in stages[:4]:
        assert s.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_mixing_and_encoding(stages):
    before, mixed, coded = stages[2].collect(), stages[3].collect(), stages[4].collect()
    texts = {r.doc_id: r.text for r in before}
    drawn = Counter(r.doc_id for r in mixed)
    assert max(drawn.values()) <= 3 and all(texts[r.doc_id] == r.text for r in mixed)
    size = {i: len(WORD.findall(t)) for i, t in texts.items()}
    source = {r.doc_id: r.source for r in before}
    total = sum(size.values())
    names = sorted(set(source.values()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    taken, full = Counter(), Counter()
    for i, s in source.items():
        full[s] += size[i]
        taken[s] += size[i] * drawn[i]
    for s in names:
        share = total * weight[s] / sum(weight.values())
        assert taken[s] <= 3 * full[s]
        if share <= full[s] * 3 and all(total * weight[x] / sum(weight.values()) <= 3 * full[x] for x in names):
            assert abs(taken[s] - share) <= max(0.03 * share, max(size[i] for i in source if source[i] == s) / 2)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert Counter(r.doc_id for r in coded) == drawn
    for r in coded:
        assert r.tokens == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.tokens)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows_pass_all_stages(spark):
    """Nulls in each column, empty and very long texts, ties, repeated rows and clashing names; and no rows at all."""
    prose = " ".join(f"word{i % 97} other{i % 89} third{i % 83}" for i in range(120))
    rows = [(1, prose, "en", "s", 5), (1, prose, "en", "s", 5), (2, None, "en", "s", None), (3, "", None, None, 0), (None, prose + " more of it", None, "s", 3), (None, None, None, None, None)]
    rows += [(4, " ".join(f"w{i}" for i in range(60000)), "fr", None, 9), (4, prose.replace("word", "wort"), "de", "t", 9), (5, prose.replace("third", "tiers"), "fr", "t", 7)]
    names = ["size", "taken", "shards", "spans", "kept", "_key", "_hash", "_row", "tokens", "root", "KEY"]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for n in names:
        df = df.selectExpr("*", f"'x' as `{n}`")
    out, kept = df, []
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = written(stage(spark, out, ""), "odd")
        assert out.columns == df.columns
        kept.append(out.collect())
    assert Counter(r.doc_id for r in kept[0]) == Counter([1, 1, None, 4, 4, 5])
    assert Counter(r.doc_id for r in kept[1]) == Counter([1, 4, 4, 5])
    assert {r.doc_id for r in kept[3]} <= {1, 4, 5} and all(r["KEY"] == "x" for r in kept[3])
    coded = corpus_pipeline.STAGES[4][1](spark, out, "").collect()
    assert len(coded) == len(kept[3])
    out = df.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, out, ""), "none")
        assert out.count() == 0


def anonymous_mb():
    return int(re.search(r"\nAnonymous:\s+(\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024


def released():
    pa.default_memory_pool().release_unused()
    ctypes.CDLL(None).malloc_trim(0)
    return anonymous_mb()


def test_encoding_keeps_no_freed_memory():
    """Workers live through all stages; a block's freed arrays took a third of what a worker had."""
    encoder = bpe.ReplayEncoder(open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read(), P.PATTERN)
    made = random.Random(4)
    words = ["".join(made.choices("etaoinshrdlu", k=made.randint(6, 14))) for _ in range(100_000)]
    released()
    for _ in encoder.encode_column(pa.array([" ".join(words[at : at + 500]) for at in range(0, len(words), 500)])):
        pass
    held = anonymous_mb()
    assert held - released() < 24
    assert encoder.decode(encoder.encode([" ".join(words)])[0].tolist()).decode() == " ".join(words)


def test_pairs_are_looked_up_in_runs():
    """The arrays of a look-up don't grow with the pairs asked for."""
    made = np.random.default_rng(4)
    left, right = made.integers(0, 3000, (2, 20_000))
    table = PairTable(*(x.astype(np.int32) for x in (left, right, np.arange(20_000), np.arange(20_000))))
    first = {}
    for a, b, slot in zip(left.tolist(), right.tolist(), table.find(left, right).tolist(), strict=True):
        first[a, b] = int(table.rank[slot])
    asked = made.integers(0, 3000, (2, 1_000_000)).astype(np.int32)
    asked[:, ::3] = np.stack([left, right])[:, made.integers(0, 20_000, len(asked[0, ::3]))]
    tracemalloc.start()
    found = table.ranks(*asked)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6
    assert found.tolist() == [first.get(p, int(NONE)) for p in zip(*asked.tolist(), strict=True)]


def test_registered_names():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 11))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["op2_quality", "op10_secrets"])
def test_sql_twins(spark, sf_dir, name):
    import duckdb

    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    result = c.execute(f"SELECT {', '.join(names)} FROM ({SQL[name]})").fetchall()
    assert Counter(tuple(r) for r in df.select(names).collect()) == Counter(result)

"""Near copies against a plain comparison of all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from quillstone.llm import near_copies, simhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_shingles(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} or ({" ".join(w)} if w else set())


def plain_kept(rows):
    sets = [plain_shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 10 * both >= 8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return {min(rows[k][0] for k in range(len(rows)) if root[k] == r) for r in set(root)}


def made():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(3000)]
    texts = ["", " \n", "one", "One", "two words"]
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(30, 160))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 8)):  # chains, some above and some below the threshold
            base = list(base)
            for _ in range(rng.randint(1, 4)):
                base[rng.randrange(len(base))] = rng.choice(words)
            texts.append(" ".join(base) + rng.choice(["", " shared closing line of many a text here"]))
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_stage_keeps_one_of_each_group_of_similar_texts(spark):
    rows = made()
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(3)
    want = plain_kept(rows)
    assert len(want) < len(rows)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == sorted(want)


def test_one_changed_word_is_a_near_copy(spark):
    words = [f"w{k}" for k in range(100)]
    texts = [" ".join(words), " ".join([*words[:50], "other", *words[51:]]), "quite another text of a few words"]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == [0, 2]


def test_rows_without_ids_and_no_rows(spark):
    rows = [(None, "a b c d e f g", "en", "s", 13), (None, "a b c d e f g", "en", "s", 13), (None, None, None, None, None), (3, "x", "en", "s", 1), (3, "x", "en", "s", 1)]
    kept = near_copies.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, ""), (0, "a b c d e f g"), (3, "x")]
    assert near_copies.keep_one(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("bits", [21, 22, 32, 64])
def test_points_within_two_bits_share_an_anchor(bits):
    rng = random.Random(bits)
    for _ in range(300):
        a = rng.getrandbits(bits)
        b = a
        for i in rng.sample(range(bits), rng.randint(0, 2)):
            b ^= 1 << i
        rows, anchors = simhash.anchors_of(np.array([a, b], np.uint64), bits)
        of = [set(anchors[rows == r].tolist()) for r in (0, 1)]
        assert of[0] & of[1] and len(of[0]) + len(of[1]) == len(rows)
        assert all(0 <= x < 1 << bits and (x ^ p).bit_count() <= 2 for p, s in zip((a, b), of, strict=True) for x in s)


def test_fingerprints_within_eight_bits_meet_at_anchors(spark):
    rng = random.Random(8)
    rows, want = [], set()
    for k in range(400):
        a = b = rng.getrandbits(64)
        for i in rng.sample(range(64), k % 9):
            b ^= 1 << i
        rows += [(2 * k, 100, a), (2 * k + 1, 100 + k % 26, b)]  # up to 125: the largest size that may be similar to 100
        want.add((2 * k, 2 * k + 1))
    rows += [(9000, 0, 0), (9001, 10, rows[0][2]), (9002, 126, rows[0][2])]  # no shingles, and sizes too far apart
    df = spark.createDataFrame([(k, n, f - (f >> 63 << 64)) for k, n, f in rows], "key bigint, size int, fp bigint").repartition(3)
    got = {(r.a, r.b) for r in near_copies.covered(df).collect()}
    assert want <= got and not {9000, 9001} & {k for p in got for k in p} and (0, 9002) not in got


def test_the_stage_goes_through_the_covering(spark, monkeypatch):
    """With the exact rest taken away, near copies that differ little are still found; far ones are the rest's."""
    rng = random.Random(3)
    rows = []
    for k in range(20):
        base = [f"w{rng.randrange(5000)}" for _ in range(400)]
        rows += [(3 * k, " ".join(base), "en", "s", 1), (3 * k + 1, " ".join([*base[:-1], "other"]), "en", "s", 1), (3 * k + 2, " ".join(rng.sample(base, 400)), "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = plain_kept([(r[0], r[1]) for r in rows])
    assert len(want) == 40
    monkeypatch.setattr(near_copies, "REACHES", ())
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == sorted(want)

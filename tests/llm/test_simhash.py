"""SimHash groups against all pairs."""

import random

import numpy as np
import xxhash
from helpers import ODD_TEXTS, frame, prose, with_clashes
from itertools import combinations

from plumbline.llm import simhash
from plumbline.llm.components import components
from plumbline.llm.queries import op1_simhash_dedup


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for white in "\t\n\x0b\x0c\r":
        low = low.replace(white, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items):
    """``{position: least id}`` over all pairs."""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in combinations(range(len(items)), 2):
        if (items[a][1] ^ items[b][1]).bit_count() <= 4:
            root[find(a)] = find(b)
    least = {}
    for k, (number, _) in enumerate(items):
        least[find(k)] = min(least.get(find(k), number), number)
    return [least[find(k)] for k in range(len(items))]


def expected(texts):
    items = [(k, plain_fingerprint(t)) for k, t in enumerate(texts)]
    return sorted((k, f"{fp:016x}", c) for (k, fp), c in zip(items, plain_components(items)))


def test_fingerprints_equal_the_definition():
    for text in [*ODD_TEXTS, *prose(40)]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_triples_cover_every_four_positions():
    assert all(any(set(t) <= set(four) for t in simhash.covering_triples()) for four in combinations(range(8), 4))


def test_op1(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in op1_simhash_dedup(spark, sf_dir).collect())
    assert got == expected([texts[k] for k in sorted(texts)])


def near_copies(n, seed=3):
    own = random.Random(seed)
    base = prose(1, seed, 200)[0].split()
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(own.randint(0, 3)):
            words[own.randrange(len(words))] = own.choice(["x", "yy", "zzz"]) + str(own.randint(0, 9))
        out.append(" ".join(words))
    return out


def test_long_lists_take_the_exact_ways_beyond_the_limit(spark):
    texts = [*near_copies(70), *ODD_TEXTS, *prose(20)]
    want = expected(texts)
    for limit in (1 << 14, 12, 2):
        got = simhash.near_duplicates(with_clashes(frame(spark, texts)), limit=limit)
        assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()) == want, limit


def test_a_chain_of_links_is_one_component(spark):
    fps, x = [0], 0
    for bit in range(40):
        x |= 1 << bit
        fps.append(x)
    rows = spark.createDataFrame([(f if f < 1 << 63 else f - (1 << 64),) for f in fps], "fp long")
    found = components(simhash.links_of(rows)).collect()
    assert len(found) == 40 and {r["root"] for r in found} == {0}
    far = spark.createDataFrame([(0,), (0b11111,)], "fp long")
    assert simhash.links_of(far).count() == 0


def test_links_of_random_clusters(spark):
    own = np.random.default_rng(5)
    centres = own.integers(0, 2**63, 12, dtype=np.int64)
    fps = sorted({int(c) ^ sum(1 << int(b) for b in own.choice(63, own.integers(0, 5), replace=False)) for c in centres for _ in range(15)})
    rows = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = plain_components([(f, f) for f in fps])
    for limit in (1 << 14, 3):
        root = {r["node"]: r["root"] for r in components(simhash.links_of(rows, limit=limit)).collect()}
        assert [root.get(f, f) for f in fps] == want


def test_one_document_of_each_group_stays(spark):
    texts = [*near_copies(25), *ODD_TEXTS, *prose(30)]
    docs = with_clashes(frame(spark, texts))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted({c for _, _, c in expected(texts)})
    twice = simhash.keep_one(docs.unionByName(docs))
    assert sorted(r["doc_id"] for r in twice.select("doc_id").collect()) == sorted({c for _, _, c in expected(texts)})


def test_nothing(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.keep_one(frame(spark, [])).count() == 0

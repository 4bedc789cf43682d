import random
import re

import numpy as np
import xxhash

from lodestat.llm import simhash
from lodestat.llm.components import components


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids, fps, radius=2):
    label = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            low = min(label[j] for j in range(len(ids)) if bin(fps[i] ^ fps[j]).count("1") <= radius)
            changed |= low != label[i]
            label[i] = low
    return label


def test_fingerprints_equal_brute_force(spark):
    texts = [None, "", " \t", "A", "a b", "a b c d", "É é b c\nd e", "x " * 5000, "Ünder a\x0bb\x1cc d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["fp"] & (2**64 - 1) for r in simhash.fingerprints(df).collect()}
    assert found == {i: fingerprint(t) for i, t in enumerate(texts)}


def test_planes_and_counters():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 500, dtype=np.uint64)
    b = a.copy()
    for i in range(500):
        for bit in rng.integers(0, 64, i % 5):
            b[i] ^= np.uint64(1 << int(bit))
    for radius in (0, 1, 2, 3):
        hits = simhash.within_radius(simhash.bit_planes(a), simhash.bit_planes(b), simhash._pack(np.ones(500, bool)), radius)
        lanes = np.unpackbits(hits.view(np.uint8), bitorder="little")[:500].astype(bool)
        assert (lanes == (np.bitwise_count(a ^ b) <= radius)).all()


def test_components_equal_brute_force_on_fingerprints(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = sorted({f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for f in base for _ in range(40)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = components(simhash.links(df))
    root = {r["node"] & (2**64 - 1): r["root"] & (2**64 - 1) for r in links.collect()}
    groups, expected = {}, {}
    for f, label in zip(fps, classes(range(len(fps)), fps), strict=True):
        expected.setdefault(label, set()).add(f)
        groups.setdefault(root.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(201)) and all(out[i] == 1000 for i in range(1000, 1050)) and 5000 not in out


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(15):
        doc = [rng.choice(words) for _ in range(300)]
        for _ in range(4):
            copy = doc[:]
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(300)] = rng.choice(words)
            texts.append(" ".join(copy))
    texts += [None, "", " "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df).collect()}
    assert out == dict(enumerate(classes(range(len(texts)), [fingerprint(t) for t in texts])))
    kept = simhash.keep_one(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(out.values()))


def test_edges(edge_docs, no_docs):
    out = simhash.near_duplicates(edge_docs).collect()
    assert len(out) == 12
    by_id = {r["doc_id"]: r["component_id"] for r in out}
    assert by_id[2] == 1 and by_id[4] == by_id[3] == by_id[5] == 3 and by_id[7] == 6
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x)) == [1, 3, 6, 8, 9, None, None]
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


def test_keep_one_chooses_rows_not_ids(spark):
    """Unlike texts that share an id are of different components, and one row of each stays."""
    rng = random.Random(11)
    a, b, c = (" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 3 + str(rng.randrange(900)) for _ in range(300)) for _ in range(3))
    near = a.upper()  # of one fingerprint with a
    rows = [(2, a, "x"), (3, near, "x"), (3, b, "x"), (5, a, "y"), (7, b, "y"), (7, c, "y"), (7, c, "y"), (7, c, "z")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(2, a), (3, b), (7, c)])

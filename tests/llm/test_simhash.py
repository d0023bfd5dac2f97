import pytest
import xxhash

from turnsieve.llm import components, simhash

from .fixtures import SPACED, documents, lower, nothing, texts


def plain(text):
    ws = SPACED.findall(lower(text))
    grams = [" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(items, linked):
    root = {i: i for i in items}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in items:
        for j in items:
            if i < j and linked(i, j) and top(i) != top(j):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return {i: top(i) for i in items}


@pytest.mark.parametrize("text", [t for t in texts() if t is None or len(t) < 5000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain(text)


def test_near_duplicates(spark):
    rows = simhash.near_duplicates(documents(spark, clashing=True)).collect()
    assert len(rows) == documents(spark).count()
    prints = sorted({r.fp % (1 << 64) for r in rows})
    of = classes(range(len(prints)), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    least = {}
    for r in rows:
        c = of[prints.index(r.fp % (1 << 64))]
        if r.id is not None:
            least[c] = min(r.id, least.get(c, r.id))
    for r in rows:
        assert r.component == least.get(of[prints.index(r.fp % (1 << 64))])


@pytest.mark.parametrize("block", [4096, 64, 8])
def test_links_join_what_is_linked(spark, block):
    """Whole clusters of fingerprints a few bits apart, so that small blocks make hot keys."""
    import random

    rng = random.Random(3)
    prints = set()
    for _ in range(6):
        middle = rng.getrandbits(64)
        for _ in range(60):
            prints.add(middle ^ sum(1 << b for b in set(rng.choices(range(64), k=rng.randint(0, 4)))))
    for _ in range(100):
        prints.add(rng.getrandbits(64))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    found = simhash.links(df, block).collect()
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 4 for r in found)
    joined = {r.node: r.root for r in components.components(simhash.links(df, block)).collect()}
    of = classes(range(len(prints)), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    groups = {}
    for i, p in enumerate(signed):
        groups.setdefault(of[i], set()).add(joined.get(p, p))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_empty(spark):
    assert simhash.near_duplicates(nothing(spark)).collect() == []


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(7, 7), (None, 3), (3, 4)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(80)}}

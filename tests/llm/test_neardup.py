import random
import re
from itertools import combinations

from pricelens.llm import neardup as N
from pricelens.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 85 * len(sets[i] | sets[j]):
            up[root(i)] = root(j)
    first = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            first[root(i)] = min(first.get(root(i), d), d)
    return sorted(((d, len(s), first.get(root(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def run(df):
    return sorted(((r["doc"], r["n_shingles"], r["component"]) for r in N.near_duplicates(df).collect()), key=str)


def family(rng, size, edits, start):
    base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
    for i in range(size):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 9999)}"
        yield start + i, " ".join(w)


def test_components_equal_brute_force(spark):
    rng = random.Random(3)
    docs = [*family(rng, 60, 3, 0), *family(rng, 50, 9, 100), *family(rng, 5, 0, 200)]
    docs += [(300 + i, " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 9)))) for i in range(30)]
    assert run(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_blocks_and_rounds_lose_no_link(spark, monkeypatch):
    """Tiny blocks, one central class, no sketch: everything open meets in blocks."""
    monkeypatch.setattr(N, "BLOCK", 4)
    monkeypatch.setattr(N, "CENTRAL", (1,))
    rng = random.Random(8)
    docs = [*family(rng, 40, 12, 0), *family(rng, 25, 6, 100)]
    assert run(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_bitmaps_never_rule_out_a_link():
    """The bound from sizes, bitmaps and spares is never below the true intersection."""
    import numpy as np
    rng = np.random.default_rng(4)
    for n in (1, 5, 40, 300, 3000):
        base = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        a, b = np.unique(base[:n + n // 8]), np.unique(base[n // 8:n + n // 4])
        _, bits = N._bands([a, b], 1, 1)
        m = bits[:, -N.BITMAP // 64:]
        common = int(np.bitwise_count(m[0] & m[1]).sum())
        spare = [len(x) - int(np.bitwise_count(y).sum()) for x, y in zip((a, b), m)]
        assert common + min(spare) >= len(np.intersect1d(a, b)) and min(spare) >= 0


def test_odd_rows_and_empty_table(spark, odd_docs, no_docs):
    assert run(odd_docs) == brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert run(no_docs) == []


def test_signature_agreement_estimates_the_similarity(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    u = rng.integers(0, 2**63, 1150).astype(np.uint64)
    a, b = np.unique(u[:1000]), np.unique(u[150:])
    _, bits = N._bands([a, b], N.ROWS, N.GROUPS)
    differ = sum(int(x).bit_count() for x in (bits[0] ^ bits[1])[:-N.BITMAP // 64])
    assert abs(1 - 2 * differ / (4 * N.ROWS * N.GROUPS) - 850 / 1150) < 0.12


def test_components_of_a_path_a_star_and_loops(spark):
    links = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("900", f"{i}") for i in range(901, 950)] + [("x", "x")]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert {got[f"{i:03}"] for i in range(41)} == {"000"}
    assert {got[f"{i}"] for i in range(900, 950)} == {"900"} and "x" not in got


def test_links_between_80_and_85_equal_brute_force(spark):
    """Copies of every length with scattered edits, in pairs: links at 80 are those of full sets."""
    rng = random.Random(12)
    docs = []
    for i in range(150):
        w = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice((40, 100, 300, 900)))]
        docs.append((2 * i, " ".join(w)))
        for at in rng.sample(range(len(w)), max(1, round(len(w) * rng.choice((.018, .02, .022, .025))))):
            w[at] = f"x{rng.randint(0, 10**6)}"
        docs.append((2 * i + 1, " ".join(w)))
    want, between = {}, 0
    for (a, s), (b, t) in zip(docs[::2], docs[1::2]):
        both, either = len(shingles(s) & shingles(t)), len(shingles(s) | shingles(t))
        want[a], want[b] = a, a if 100 * both >= 80 * either else b
        between += 80 * either <= 100 * both < 85 * either
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), percent=80)
    assert between >= 20 and len(set(want.values())) > 155
    assert {r["doc"]: r["component"] for r in got.collect()} == want


def test_bands_and_sketch_follow_the_threshold():
    """At every threshold a pair right at it is missed as rarely as documented."""
    import numpy as np
    rng = np.random.default_rng(6)
    assert N.layout(85) == (N.ROWS, N.GROUPS) and N.layout(80) == (5, 24)
    for percent in (1, 30, 50, 70, 80, 85, 95, 100):
        rows, groups = N.layout(percent)
        assert (1 - (percent / 100) ** rows) ** (2 * groups) <= N.MISS_BANDS
        values = 2 * rows * groups
        apart = rng.binomial(values, 1 - percent / 100, 400_000)
        assert (rng.binomial(2 * apart, 0.5) > N.most_differing(values, percent)).sum() <= 1

"""Where canonical links end, against plain walking."""
import random

from webfold.operators.quality import canonical_identity, chain_ends


def walked(hops):
    out = {}
    for start in hops:
        seen = [start]
        while seen[-1] in hops and hops[seen[-1]] not in seen:
            seen.append(hops[seen[-1]])
        again = hops.get(seen[-1])
        out[start] = seen[-1] if again is None else min(seen[seen.index(again):])
    return out


def ends(spark, hops):
    return {r.url: r.end for r in chain_ends(spark.createDataFrame(list(hops.items()), "url string, to string")).collect()}


def test_chains_and_circles_as_by_walking(spark):
    rnd = random.Random(9)
    chain = {f"c{k:03}": f"c{k + 1:03}" for k in range(100)}
    circle = {f"o{k}": f"o{(k + 1) % 7}" for k in range(7)} | {"t2": "t1", "t1": "o3", "a0": "o1"}
    mixed = {f"m{k}": f"m{rnd.randint(0, 59)}" for k in range(45)}
    hops = {u: v for u, v in {**chain, **circle, **mixed}.items() if u != v}
    assert ends(spark, hops) == walked(hops)


def test_nothing_to_follow(spark):
    assert ends(spark, {"a": "a", "b": None}) == {}
    assert ends(spark, {"a": "b", "b": "a"}) == {"a": "a", "b": "a"}


def test_identity_of_pages(spark):
    rows = [(1, "u1", "u2"), (2, "u2", "u3"), (3, "u3", ""), (4, "u4", "u1"), (5, "u5", "u6"), (6, "u6", "u5"), (7, "u7", "elsewhere"), (8, "u1", "u7"), (9, None, "u1")]
    df = spark.createDataFrame(rows, "page_id long, norm_url string, canonical_url string")
    got = {r.page_id: (r.identity_url, r.n_aliases) for r in canonical_identity(df).collect()}
    assert got == {1: ("u3", 4), 2: ("u3", 4), 3: ("u3", 4), 4: ("u3", 4), 5: ("u5", 2), 6: ("u5", 2), 7: ("elsewhere", 2), 8: ("elsewhere", 2)}

"""Line dedup against brute force."""

import random

import numpy as np
import pyarrow as pa

from folkmoot.llm import lines


def expected(rows, threshold=0.8):
    """Texts by row after keeping the first line of each component, by all pairs."""
    every = [(i, p, x) for i, t in enumerate(rows) for p, x in enumerate((t or "").split("\n")) if x.strip()]
    distinct = sorted({x for _, _, x in every})
    root = {x: x for x in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if len(a) >= lines.K and len(b) >= lines.K and lines.jaccard(a, b) >= threshold:
                root[find(a)] = find(b)
    seen, gone = set(), set()
    for i, p, x in every:
        if find(x) in seen:
            gone.add((i, p))
        seen.add(find(x))
    return [None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone) for i, t in enumerate(rows)]


def test_lines_against_all_pairs(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    base = [" ".join(rng.choices(words, k=60)) for _ in range(12)]
    near = lambda x, n: " ".join(w if j not in rng.sample(range(60), n) else rng.choice(words) for j, w in enumerate(x.split(" ")))
    texts = [None, "", "\n \n\n", "short", "short\nother", "x" * 40_000 + "\nüñí long tail of a very long text", "Released under the MIT License.\nmore"]
    for _ in range(60):
        x = rng.choice(base)
        texts.append("\n".join([x, near(x, 1), "Released under the MIT License.", " ".join(rng.choices(words, k=rng.randint(3, 40))), ""]))
    table = spark.createDataFrame([(i, t, "a", i) for i, t in enumerate(texts)], "doc_id long, text string, _k string, pos int").repartition(5)
    out = lines.dedup_lines(table).collect()
    assert len(out) == len(texts)
    found = {r.doc_id: r.text for r in out}
    want = expected(texts)
    assert [found[i] for i in range(len(texts))] == want
    r = next(r for r in out if r.doc_id == 4)
    assert (r.n_lines, r.n_removed, r.text, r._k) == (2, 1, "other", "a")


def test_null_ids_and_empty(spark):
    table = spark.createDataFrame([(None, "same line here"), (3, "same line here\nown words stay"), (3, "same line here\nown words stay")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in lines.dedup_lines(table).collect()) == [(0, "same line here"), (3, "own words stay"), (3, "own words stay")]
    assert lines.dedup_lines(table.limit(0)).count() == 0


def test_a_large_band_whose_lines_differ_from_the_least(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    base = [word() for _ in range(60)]
    texts = []
    for _ in range(70):
        w = list(base)
        for at in rng.sample(range(60), 3):
            w[at] = word()
        texts.append(" ".join(w))
    for t in texts[1:]:
        assert 0.6 < lines.jaccard(texts[0], t) < 0.9
    table = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, " ".join(base)])], "doc_id long, text string").repartition(4)
    pairs = {frozenset((r.u, r.v)) for r in lines.links(table, small=4, chunk=16)[0].collect()}
    assert len({x for p in pairs for x in p}) == 71
    assert sum(r.text != "" for r in lines.dedup_lines(table).collect()) == 1


def test_merged_blocks_equal_all_pairs():
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdef ") for _ in range(80)) for _ in range(5)]
    texts = [x[: (c := rng.randint(0, 75))] + rng.choice("xyz") + x[c + 1 :] for x in base for _ in range(12)]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if lines.jaccard(texts[a], texts[b]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    mine = list(range(len(texts)))
    for a, b in lines.merge_block(texts, list(range(len(texts))), 0.8, lines.K):
        low, high = sorted((mine[a], mine[b]))
        mine = [low if r == high else r for r in mine]
    assert mine == root


def test_jaccard_of_packed_shingles_is_that_of_sets():
    rng = random.Random(3)
    for letters in ("ab", "abé ", "ab日"):
        for _ in range(200):
            a, b = ("".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(2))
            x, y = ({s[i : i + 8] for i in range(max(1, len(s) - 7))} for s in (a, b))
            assert lines.jaccard(a, b) == len(x & y) / len(x | y)


def test_lines_that_share_a_hash_are_not_joined(spark, monkeypatch):
    """With a first hash of two values only, links and classes still go by the texts."""
    real = lines.F.xxhash64

    def weak(*columns):
        return real(*columns) if len(columns) > 1 or not isinstance(columns[0], str) else lines.F.pmod(lines.F.char_length(columns[0]), lines.F.lit(2)).cast("long")

    texts = [f"line number {i} {'x' * (i % 5)} of its own kind" for i in range(40)] + ["a line that stands twice"] * 2
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(lines.F, "xxhash64", weak)
    out = {r.doc_id: r.text for r in lines.dedup_lines(table, threshold=1.0).collect()}
    assert out == {i: "" if i == 41 else t for i, t in enumerate(texts)}


def test_a_hot_band_is_not_held_whole():
    rng = np.random.default_rng(4)
    pairs = np.concatenate([np.column_stack([np.full(500, 7), np.arange(500)]), np.column_stack([rng.integers(100, 160, 300), rng.integers(1000, 1100, 300)])]).astype(np.int64)
    pairs = rng.permutation(np.concatenate([pairs, pairs[:50]]))
    batch = lambda: iter([pa.RecordBatch.from_arrays([pa.array([1] * 25), pa.array([x.tobytes() for x in np.array_split(pairs, 25)], pa.binary())], names=["part", "pairs"])])
    known = {}
    for most in (1 << 22, 60):
        out = [r for b in lines._candidates(3, most)(batch()) for r in b.to_pylist()]
        members = {(r["key"], r["a"]) for r in out if r["key"] is not None}
        heads = {r["key"]: r["b"] for r in out if r["key"] is not None}
        assert all(heads[r["key"]] == r["b"] for r in out if r["key"] is not None) and {(k, h) for k, h in heads.items()} <= members
        small = {frozenset((r["a"], r["b"])) for r in out if r["key"] is None}
        known[most] = members, small
    assert known[60] == known[1 << 22] and (7, 499) in known[60][0]

import hashlib
import math
import random
from collections import defaultdict

from folkmoot.llm import codes

VECTORS = "vec_id long, embedding array<double>, label string, n int, error int, code int"


def brute(rows, rounds=4):
    kept = [(i, [math.floor(x) * 1024 if abs(x) >= 2**53 else math.floor(x * 1024) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4) * 4
    size = width // 4
    kept = [(i, v + [0] * (width - len(v)), lab) for i, v, lab in kept]
    cut = lambda v: [v[p * size : (p + 1) * size] for p in range(4)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:256]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(4)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, part: min(range(len(books[p])), key=lambda e: (far(part, books[p][e]), e))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v, _ in kept:
            for p, part in enumerate(cut(v)):
                own[p, near(p, part)].append(part)
        for (p, e), parts in own.items():
            books[p][e] = [sum(x) // len(parts) for x in zip(*parts)]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out, of_label, most = [], defaultdict(int), 2**63 - 1
    for i, v, lab in kept:
        at = [near(p, part) for p, part in enumerate(cut(v))]
        error = min(sum(far(part, books[p][e]) for p, (part, e) in enumerate(zip(cut(v), at))), most)
        out.append((i, "".join(f"{e:02x}" for e in at), error, lab))
        of_label[lab] += error
    return sorted(((i, c, e, min(of_label[lab], most), sha) for i, c, e, lab in out), key=repr)


def compressed(spark, rows):
    frame = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], VECTORS).repartition(3)
    return sorted((tuple(r) for r in codes.compress(frame).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(13)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)], rng.choice(["a", "b", None])) for i in rng.sample(range(5000), 700)]
    assert compressed(spark, rows) == brute(rows)


def test_ties_repeats_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i // 3, [float(i % 2)] * 4, None) for i in range(60)] + [(None, [0.5] * 4, "x"), (1, None, "x"), (2, [nan] * 4, "x"), (3, [1.0, -inf, 0.0, 0.0], "x"), (4, [None, 1.0, 1.0, 1.0], "x"), (5, [], "y"), (6, [-0.0001], "y"), (7, [1.0] * 6, "z")]
    got = compressed(spark, rows)
    assert got == brute(rows) and len(got) == 64


def test_huge_components_stay_exact(spark):
    rng = random.Random(14)
    for scale in (1e7, 1e15, 1e150):
        rows = [(i, [rng.gauss(0, scale) if i % 3 else rng.gauss(0, 1) for _ in range(4)], str(i % 2)) for i in range(320)]
        assert compressed(spark, rows) == brute(rows)


def test_no_vectors(spark):
    assert compressed(spark, []) == [] and compressed(spark, [(1, None, "a")]) == []
    assert compressed(spark, [(1, [], "a"), (2, [], "a")]) == brute([(1, [], "a"), (2, [], "a")])


def test_float_vectors_and_hot_labels(spark):
    rows = [(i, [0.1 * (i % 7), 0.2, -0.3, 0.4], None if i % 3 else str(i)) for i in range(4000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    got = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in codes.compress(frame).collect()))
    assert len(got) == 4000
    total = sum(e for i, _, e, _ in got if i % 3)
    assert all(le == (total if i % 3 else e) for i, _, e, le in got)

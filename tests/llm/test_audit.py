import random
import re
import time
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from folkmoot.llm import audit

DOCS = "doc_id long, text string, source string, mask int, part int, n int, quality int"


def fails(rows):
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, source, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield i, source or "", "".join(f for f, bad in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), re.search(r"[#$%&*|]", t), i is not None and i > least[t])) if bad)


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    told = list(fails(rows))
    out, removed_by = {}, Counter()
    for part in {p for _, p, _ in told}:
        for order in map("".join, permutations("ABCDE")):
            left = [(i, f) for i, p, f in told if p == part]
            everything = left
            for step, name in enumerate(order, 1):
                here = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                all_failing = sum(name in f for _, f in everything)
                out[part, order, step] = [len(left), len(here), all_failing - len(here), sum(f == name for _, f in everything), sum(i in good for i, _ in here), sum(i in toxic for i, _ in here)]
                removed_by[part, name] += len(here)
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, rows, labels):
    got = audit.audit(spark.createDataFrame([(*r, 0, 0, 0, 0) for r in rows], DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert [f"{c} {t}" for c, t in got.dtypes] == ["part string", "filter_order string", "step int", *(f"{c} bigint" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))]
    found = got.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found}
    assert len(out) == len(found)
    return out


def test_against_brute_force(spark):
    rng = random.Random(12)
    word = lambda: rng.choice(["a", "b", "HOT", "x%", "word", "und", "\u00c9t\u00e9", "\U0001d538"]) + str(rng.choice([1, rng.randint(1, 500)]))
    text = lambda: rng.choice([" ", "\t", "\n\x0b "]).join(word() for _ in range(rng.choice([0, 10, 49, 50, 51, 80])))
    texts = [text() for _ in range(60)] + ["\u00a0".join("abc" for _ in range(60)), " " * 5, "a " * 200_000, None, ""]
    rows = [(i, rng.choice(texts), rng.choice(["s", "t", "", None, "u"])) for i in rng.sample(range(1000), 300)]
    rows += rows[:20] + [(None, t, "s") for t in texts[:5]] * 2 + [(-5, texts[0], "solo")]
    labels = [(rng.randint(0, 1000), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(700)] + [(None, 1, 1)]
    got = audited(spark, rows, labels)
    assert got == brute(rows, labels)
    assert len(got) == 5 * 600  # null and empty sources are one part


def test_no_rows_and_no_labels(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    got = audited(spark, [(1, "x", None), (2, "x", None)], [])
    assert got["", "EABCD", 1] == (1, 1, 0, 0, 0, 0, 1 * 60) and got["", "AEBCD", 2] == (0, 0, 1, 0, 0, 0, 60)
    assert got["", "AEBCD", 5] == (0, 0, 0, 0, 0, 0, 0)


def test_long_texts_are_counted_in_linear_time(spark):
    words = " ".join(f"w{i}" for i in range(400_000))
    began = time.time()
    mask = spark.createDataFrame([(words,)], "t string").select(audit.text_mask(F.col("t"))).first()[0]
    assert mask == 0 and time.time() - began < 20

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeflow.llm import overlap


def near(a, b):
    both = [(x, y) for x, y in zip(a, b) if x not in "N-" and y not in "N-"]
    return len(both) >= 1 and len(both) >= 0.8 * max(len(a), len(b)) and sum(x != y for x, y in both) <= 0.01 * len(both)


def mutated(rng, seq, changes, mask, cut):
    s = list(seq)
    for i in rng.sample(range(len(s)), changes):
        s[i] = rng.choice([c for c in "ACGT" if c != s[i]])
    if mask:
        at = rng.randrange(len(s) - mask)
        s[at : at + mask] = rng.choice("N-") * mask
        for i in rng.sample(range(len(s)), mask // 4):
            s[i] = "N"
    return "".join(s[: len(s) - cut])


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows, bases = [], ["".join(rng.choice("ACGT") for _ in range(rng.choice([240, 300, 330, 450]))) for _ in range(12)]
    for i in range(400):
        seq = mutated(rng, rng.choice(bases), rng.choice([0, 0, 1, 2, 3, 4, 6, 20]), rng.choice([0, 0, 0, 9, 25, 40]), rng.choice([0, 0, 0, 20, 45, 60]))
        rows.append((i, f"d{i % 3}", "test" if rng.random() < 0.3 else "train", seq))
    rows += [(900, "d0", "test", "NNNN"), (901, "d0", "train", "NNNN"), (902, "d0", "test", "AC"), (903, "d1", "train", "AC"), (904, "d1", "validation", bases[0])]
    rows += [(910, "d0", "train", rows[0][3]), (911, "d1", "test", rows[0][3])]
    tips = spark.createDataFrame(rows, "seq_id long, dataset string, split string, seq string")
    classes = overlap.cross_split_pairs(tips)
    found = overlap.expanded_pairs(*classes).cache()
    got = {(r.held_out_id, r.training_id) for r in found.collect()}
    want = {(a[0], b[0]) for a in rows for b in rows if a[2] == "test" and b[2] == "train" and near(a[3], b[3])}
    assert got == want
    report = {(r.split, r.dataset): (r.n_pairs, r.n_rows, r.n_equal) for r in overlap.overlap_report(*classes).collect()}
    pairs = [r.asDict() for r in found.collect()]
    for split, name in (("test", "held_out"), ("train", "training")):
        for dataset in {p[f"{name}_dataset"] for p in pairs}:
            mine = [p for p in pairs if p[f"{name}_dataset"] == dataset]
            assert report.pop((split, dataset)) == (len(mine), len({p[f"{name}_id"] for p in mine}), sum(p["differing"] == 0 for p in mine))
    assert not report


def test_singly_masked_rows_meet(spark):
    """Up to a fifth of the positions masked one by one, so that hardly a window of four bases is left."""
    rng = random.Random(5)
    bases = ["".join(rng.choice("ACGT") for _ in range(330)) for _ in range(15)]
    rows = []
    for i in range(120):
        s = list(bases[i % 15])
        for k in rng.sample(range(len(s)), rng.choice([0, 15, 33, 60])):
            s[k] = rng.choice("N-")
        rows.append((i, "d", rng.choice(["test", "train"]), "".join(s)))
    rows += [(900, "d", "test", "ACNTA"), (901, "d", "train", "ACGTA")]
    tips = spark.createDataFrame(rows, "seq_id long, dataset string, split string, seq string")
    got = {(r.held_out_id, r.training_id) for r in overlap.expanded_pairs(*overlap.cross_split_pairs(tips)).collect()}
    assert got == {(a[0], b[0]) for a in rows for b in rows if a[2] == "test" and b[2] == "train" and near(a[3], b[3])} and (900, 901) in got


def test_slices():
    for sizes in ([], [5], [9_000_000, 1, 9_000_000], [1000] * 50_000):
        texts = ["A" * n for n in sizes]
        cuts = list(overlap._slices(texts, texts))
        assert [k for a, b in cuts for k in range(a, b)] == list(range(len(sizes)))
        assert all(b - a == 1 or max(sizes[a:b]) * (b - a) <= overlap.COMPARED_BYTES for a, b in cuts)


def test_nothing(spark):
    tips = spark.createDataFrame([], "seq_id long, dataset string, split string, seq string")
    assert overlap.expanded_pairs(*overlap.cross_split_pairs(tips)).count() == 0
    one_side = spark.createDataFrame([(1, "d", "test", "ACGTACGT")], tips.schema)
    assert overlap.expanded_pairs(*overlap.cross_split_pairs(one_side)).count() == 0


def test_tips(spark):
    alignment = spark.createDataFrame(
        [(1, "d", "hCoV-19/a", "acgt"), (2, "d", "NODE_1", "ACGT"), (3, "d", "b", ""), (4, "d", "b", None), (5, None, "a", "A"), (6, "d", None, "A"), (7, "d", "b", "AC")],
        "seq_id long, dataset string, name string, seq string",
    ).withColumn("split", F.lit("clash"))
    branches = spark.createDataFrame(
        [("d", "p", "a", " Test ", "2024-01-02"), ("d", "p", "a", "train", "2024-01-01"), ("d", "p", None, "test", None)],
        "dataset string, parent string, child string, train_test string, exported_at string",
    )
    got = {(r.seq_id, r.split, r.seq) for r in overlap.tip_sequences(alignment, branches).collect()}
    assert got == {(1, "test", "ACGT"), (5, "train", "A"), (7, "train", "AC")}


def test_prefixes_meet():
    for n in range(5, 700):
        for m in range(n, int(n / 0.8) + 1):
            if n >= 0.8 * m:
                assert set(overlap.prefix_lengths(n)) & set(overlap.prefix_lengths(m)), (n, m)


def test_jaccard_is_exact():
    a, b = ["ACGTACGTAC", "ACGT"], ["ACGTACGTAA", "TTTT"]
    _, differing, _, jaccard = overlap.compare(a, b)
    assert list(differing) == [1, 3]
    assert np.allclose(jaccard, [6 / 8, 0])

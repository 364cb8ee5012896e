from __future__ import annotations

import random

import pytest

from atlasloom.operators.records import add_negatives, build_records, check_request, samples
from atlasloom.operators.setops import pool_samples


def cells(spark, n, prefix="A", start=0):
    rows = [(f"{prefix}{i}", start + i, f"short {prefix}{i}", f"long {prefix}{i}", "BT"[i % 2], f"batch{i // 3}") for i in range(n)]
    return spark.createDataFrame(rows, "cell_id string, ord long, sentence_short string, sentence_long string, cell_type string, batch string")


def two_inputs(spark):
    keys = ["sentence_short", "sentence_long"]
    return [samples(cells(spark, 8), keys, "link/a", "cell_type", "batch"),
            samples(cells(spark, 5, "X"), keys, "link/x", "cell_type", "batch")]


def test_single(spark):
    out = build_records(two_inputs(spark)).collect()
    assert len(out) == 13 and len({r.sample_idx for r in out}) == 13
    assert out[0].asDict().keys() == {"sample_idx", "cell_sentence_1", "cell_sentence_2", "adata_link"}


def test_pairs(spark):
    out = build_records(two_inputs(spark), "pairs").collect()
    own = {f"{p}{i}": "BT"[i % 2] for p, n in (("A", 8), ("X", 5)) for i in range(n)}
    assert len(out) == 26
    for r in out:
        assert (r.caption == own[r.sample_idx]) == (r.label == 1.0)


def test_multiplet_negative_has_another_caption(spark):
    rows = two_inputs(spark)
    out = build_records(rows, "multiplets", 2)
    own = {r.sample_idx: r.caption for r in pool_samples(rows).collect()}
    for r in out.collect():
        assert r.positive == own[r.sample_idx]
        assert own[r.negative_1_idx] != r.positive
        assert r.negative_2_idx not in (r.sample_idx, r.negative_1_idx)


def test_resolved_only_with_one_sentence(spark):
    one = samples(cells(spark, 8), ["sentence_short"], "l", "cell_type", "batch")
    r = build_records(one, "multiplets", 2, resolve=True).filter("sample_idx = 'A0'").first()
    assert (r.negative_1, r.negative_2) == ("T", "short A2")
    assert "negative_1" not in build_records(two_inputs(spark), "multiplets", 2, resolve=True).columns


def test_repeated_index_keeps_place_and_last_content(spark):
    a, b = cells(spark, 3), cells(spark, 1, "A", 5).replace("short A0", "new", "sentence_short")
    out = pool_samples([samples(x, ["sentence_short"], "l") for x in (a, b)]).orderBy("ord").collect()
    assert [(r.sample_idx, r.cell_sentence_1) for r in out] == [("A0", "new"), ("A1", "short A1"), ("A2", "short A2")]


def test_refused(spark):
    for bad in (("triplets", 1, "c"), ("pairs", 0, "c"), ("multiplets", 1, None)):
        with pytest.raises(ValueError):
            check_request(*bad)
    with pytest.raises(ValueError):
        samples(cells(spark, 2), ["absent"], "l")
    with pytest.raises(ValueError):
        build_records([])
    with pytest.raises(ValueError):
        build_records(samples(cells(spark, 2).limit(0), ["sentence_short"], "l"))
    with pytest.raises(ValueError):
        pool_samples([samples(cells(spark, 2), ["sentence_short"], "l")] * 2, [1, 2])


def by_scanning(rows, n, repeat):
    """Negatives found the plain way: look through all rows of the batch, then through all rows."""
    def order(pool):
        seen = {}
        for r in pool:
            if r["caption"] is not None:
                seen.setdefault(r["caption"], []).append(r)
        return [r for group in seen.values() for r in group]

    out = {}
    for a in rows:
        near = order([r for r in rows if r["batch"] == a["batch"]]) if a["batch"] is not None else []
        far, used, got = order(rows), {a["idx"]}, []
        for i in range(n):
            if i % 2 == 0:
                fit = [r for r in near if r["caption"] != a["caption"]] or []
                rest = [r for r in far if r["caption"] != a["caption"]]
                if repeat == "next":
                    pick = next((r for r in fit + rest if r["idx"] not in used), None)
                else:
                    first = next(iter([r for r in fit if r["idx"] != a["idx"]] + [r for r in rest if r["idx"] != a["idx"]]), None)
                    pick = None if first is None or first["idx"] in used else first
            else:
                pick = next((r for r in near + rows if r["idx"] not in used), None)
            got.append(pick and pick["idx"])
            if pick:
                used.add(pick["idx"])
        out[a["idx"]] = got
    return out


@pytest.mark.parametrize("repeat", ["next", "first"])
@pytest.mark.parametrize("seed,n_captions,n_batches", [(1, 3, 4), (2, 40, 3), (3, 2, 30), (4, 1, 2)])
def test_same_as_scanning(spark, seed, n_captions, n_batches, repeat):
    rnd = random.Random(seed)
    rows = []
    for i in range(60):
        batch = "hot" if rnd.random() < 0.4 else f"b{rnd.randrange(n_batches)}"
        rows.append({
            "idx": i, "caption": None if rnd.random() < 0.1 else f"c{rnd.randrange(n_captions)}",
            "batch": None if rnd.random() < 0.1 else batch})
    df = spark.createDataFrame(
        [(r["idx"], r["idx"], f"s{r['idx']}", r["caption"], r["batch"], "l") for r in rows],
        "sample_idx long, ord long, cell_sentence_1 string, caption string, batch string, adata_link string").repartition(7)
    want = by_scanning(rows, 4, repeat)
    got = {r.sample_idx: [x and x.sample_idx for x in r[1:]] for r in add_negatives(df, 4, repeat_captions=repeat).select(
        "sample_idx", *[f"negative_{i}" for i in range(1, 5)]).collect()}
    assert got == want
    kept = build_records(df, "multiplets", 4, repeat_captions=repeat).count()
    assert kept == sum(any(x is not None for x in v) for v in want.values())

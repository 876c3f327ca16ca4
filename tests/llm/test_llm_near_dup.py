from collections import Counter

import numpy as np
import pytest

from parcelwise.llm.near_dup import band_keys, keep_one_of_each, near_duplicates, ring_slices, signature


def shingles(text, width=5):
    words = [w for w in (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
             .replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return frozenset()
    k = min(width, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def expected(rows, percent):
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                    group = [group[j] if g == group[i] else g for g in group]
    out = []
    for i, r in enumerate(rows):
        if not sets[i]:
            out.append((r[0], 0, r[0], r[0] is not None))
            continue
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((r[0], len(sets[i]), least, r[0] is not None and r[0] == least))
    return Counter(out), group, sets


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_brute_force(odd, odd_rows, percent):
    got = near_duplicates(odd, percent).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert Counter(tuple(r) for r in got) == expected(odd_rows, percent)[0]


def test_one_row_of_each_group_stays_with_all_columns(odd, odd_rows):
    _, group, sets = expected(odd_rows, 80)
    best = {}
    for i, r in enumerate(odd_rows):
        if sets[i]:
            key = (r[0] is None, r[0] or 0)
            best[group[i]] = min(best.get(group[i], key), key)
    kept = keep_one_of_each(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows if shingles(r.text)) == sorted(best.values())
    assert sum(not shingles(r.text) for r in rows) == sum(not s for s in sets)


def test_empty_table(none):
    assert near_duplicates(none).count() == 0
    assert keep_one_of_each(none).count() == 0


def test_near_copies_that_share_no_leader_are_linked(spark):
    """A chain of edits: neighbours pass the threshold, the ends do not."""
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(words)))
        words[20 * i + 5] = f"edit{i}"
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert {r.component_id for r in got} == {0}


def test_many_different_near_copies_make_few_pairs(spark):
    """Copies too far from each other to link stay apart, without comparing all of them."""
    rows = []
    for i in range(200):
        words = [f"w{j}" for j in range(150)]
        for j in range(5):
            words[(i * 7 + j * 31) % 150] = f"e{i}x{j}"
        rows.append((i, " ".join(words)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert Counter(tuple(r)[2:] for r in got)  # finishes
    want, _, _ = expected(rows, 85)
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == want


def test_signature_estimates_similarity():
    slices = ring_slices(512)
    random = np.random.RandomState(1)
    pool = random.randint(0, 1 << 62, 1500).astype(np.uint64)
    a, b = pool[:1000], pool[200:1200]
    share = (signature(a, slices) == signature(b, slices)).mean()
    assert abs(share - 800 / 1200) < 0.08
    assert (signature(a, slices) == signature(a[::-1].copy(), slices)).all()
    assert len(set(band_keys(signature(a, slices), 64, 8).tolist())) == 64

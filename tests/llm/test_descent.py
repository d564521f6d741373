import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import descent as d


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 7) for i, v, l in rows], "vec_id bigint, embedding array<float>, label int, part string, n int").repartition(3)


def brute(rows, threshold=0.93):
    """(n_links, component_id) by vec_id."""
    kept = {}
    for i, v, l in rows:
        if i is not None and (i not in kept or ((l is not None, l or 0), v or []) < ((kept[i][1] is not None, kept[i][1] or 0), kept[i][0] or [])):
            kept[i] = (v, l)
    fine = {i: np.array(v, np.float32).astype(float) for i, (v, l) in kept.items() if l is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)}
    links = {i: set() for i in kept}
    ids = list(fine)
    for a in ids:
        for b in ids:
            if a < b and kept[a][1] == kept[b][1] and len(fine[a]) == len(fine[b]):
                if fine[a] @ fine[b] / np.sqrt((fine[a] @ fine[a]) * (fine[b] @ fine[b])) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    found = {}
    for i in sorted(kept):
        if i not in found:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in found:
                    found[k] = i
                    todo += links[k]
    return {i: (len(links[i]), found[i]) for i in kept}


def check(spark, rows):
    got = d.near_duplicates(frame(spark, rows)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows) and len(got) == len({i for i, *_ in rows if i is not None})
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return got


def near(rng, v, angle):
    """A vector at that angle of v, in degrees."""
    w = rng.normal(size=len(v))
    w -= w @ v / (v @ v) * v
    a = np.radians(angle)
    return np.cos(a) * v / np.linalg.norm(v) + np.sin(a) * w / np.linalg.norm(w)


def test_groups_chains_and_strangers(spark):
    rng = np.random.default_rng(1)
    rows, i = [], 100
    for label in range(3):
        for _ in range(60):
            rows.append((i := i + 1, rng.normal(size=24).tolist(), label))
        for size, angle in ((2, 20.5), (5, 6), (40, 9), (30, 14)):  # pairs, tight groups, one in which some pairs do not link
            centre = rng.normal(size=24)
            rows += [(i := i + 1, (near(rng, centre, angle) * rng.uniform(0.1, 9)).tolist(), label) for _ in range(size)]
        v = rng.normal(size=24)
        for _ in range(8):  # each links with the next only
            v = near(rng, v, 20)
            rows.append((i := i + 1, v.tolist(), label))
    got = check(spark, [rows[k] for k in rng.permutation(len(rows))])
    assert sum(r.n_links > 0 for r in got) > 200


def test_groups_that_hang_together_by_one_pair(spark):
    """Both are dense enough to fill every list with nearer neighbours."""
    rng = np.random.default_rng(5)
    a = np.eye(24)[0]
    b = np.cos(np.radians(32)) * a + np.sin(np.radians(32)) * np.eye(24)[1]
    bridge = [np.cos(np.radians(t)) * a + np.sin(np.radians(t)) * np.eye(24)[1] for t in (6, 27)]
    rows = [(k, (near(rng, c, 2.5)).tolist(), 1) for k, c in enumerate([a] * 40 + [b] * 40)] + [(80 + k, v.tolist(), 1) for k, v in enumerate(bridge)]
    rows += [(200 + k, rng.normal(size=24).tolist(), 1) for k in range(50)]
    got = check(spark, rows)
    assert len({r.component_id for r in got if r.vec_id < 82}) == 1


def test_large_groups_are_counted_by_their_mean(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    rows = [(k, near(rng, centre, rng.choice([2, 8, 10.5, 11, 15, 19])).tolist(), 4) for k in range(120)]
    rows += [(200 + k, near(rng, -centre, 3).tolist(), 4) for k in range(30)] + [(300 + k, rng.normal(size=16).tolist(), 4) for k in range(20)]
    rows += [(400 + k, rows[0][1], 4) for k in range(50)]  # copies count as many times as there are
    got = check(spark, rows)
    assert len({r.n_links for r in got if r.vec_id < 120}) > 3


def test_a_group_is_stored_in_proportion_to_its_size(spark, monkeypatch):
    """Neither lists nor links of a group of near copies grow with its square."""
    written = []
    monkeypatch.setattr(d, "written", lambda df, label, f=d.written: (lambda out: (written.append((label, out.count())), out)[1])(f(df, label)))
    rng = np.random.default_rng(3)
    most = {}
    for m in (200, 800):
        written.clear()
        centre = rng.normal(size=16)
        rows = [(k, near(rng, centre, 5).tolist(), 1) for k in range(m)]
        got = d.near_duplicates(frame(spark, rows)).collect()
        assert {r.n_links for r in got} == {m - 1}
        most[m] = max(n for _, n in written)
    assert most[800] <= 4.5 * most[200] and most[800] <= 800 * (d.WIDTH + d.FAR)


def test_vectors_that_link_with_nothing(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, [1.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0], 1), (8, [0.0, 0.0], 1),
        (9, [1.0, None], 1), (10, [nan, 1.0], 1), (11, [inf, 0.0], 1), (12, [], 1), (13, [1.0, 0.0, 0.0], 1), (14, [1.0, 0.0, 0.0], 1), (15, [-0.0, 1.0], 1), (16, [0.0, 1.0], 1),
        (None, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (17, [1e-30, 0.0], 1), (18, [3e38, 1e30], 1),
    ]
    got = {r.vec_id: (r.n_links, r.component_id) for r in check(spark, rows)}
    assert got[1] == (3, 1) and got[18] == (3, 1) and got[13] == (1, 13) and got[15] == (1, 15) and got[4] == (0, 4) and got[3] == (0, 3)


def test_few_rows_and_none(spark):
    check(spark, [(5, [1.0, 2.0], 1)])
    check(spark, [(5, [1.0, 2.0], 1), (4, [1.0, 2.0], 1)])
    assert d.near_duplicates(frame(spark, [(5, [1.0], 1)]).limit(0)).collect() == []


def test_a_poor_search_is_audited_and_widened(spark, monkeypatch):
    """Cells of two, and no rounds: few links are found at first."""
    monkeypatch.setattr(d, "CELL", 2)
    monkeypatch.setattr(d, "ORDERS", 1)
    heard = []
    monkeypatch.setattr(d, "audited", lambda *a, f=d.audited: (heard.append(f(*a)), heard[-1])[1])
    monkeypatch.setattr(d, "descend", lambda coded, lists, *rest: lists)
    rng = np.random.default_rng(8)
    rows = []
    for g in range(20):
        centre = rng.normal(size=12)
        rows += [(100 * g + k, near(rng, centre, 8).tolist(), 1) for k in range(12)]
    d.near_duplicates(frame(spark, rows)).collect()
    assert len(heard) == 2 and heard[0] < d.RECALL and heard[1] > heard[0]


@pytest.mark.parametrize("most", [None, 3])
def test_runs_of_equal_keys(most):
    keys = [1, 1, 1, 1, 2, 3, 3, 3, 3, 3, 3, 3, 1]
    for size in (1, 2, 5, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[a : a + size]), pa.array(range(a, min(a + size, len(keys))))], names=["k", "row"]) for a in range(0, len(keys), size)]
        got = list(d.runs(iter(batches), ["k"], most))
        assert [r for b in got for r in b.column(1).to_pylist()] == list(range(len(keys)))
        assert all(len(set(b.column(0).to_pylist())) == 1 and (most is None or b.num_rows <= most) for b in got)
        if most is None:
            assert [b.num_rows for b in got] == [4, 1, 7, 1]
